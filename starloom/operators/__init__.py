"""DataFrame-to-DataFrame steps of a warehouse build."""
