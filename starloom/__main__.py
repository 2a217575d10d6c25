"""``python -m starloom job.toml [--check]``"""

import sys

from .plans.job import main

sys.exit(main(sys.argv[1:]))
