"""The calendar and territory files: pipe-separated, without a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns of both files by position.
CALENDAR_FILE_COLUMNS = (
    "date_key int, full_date_alternate_key date, day_number_of_week smallint, "
    "day_name_of_week string, spanish_day_name_of_week string, french_day_name_of_week string, "
    "day_number_of_month smallint, day_number_of_year smallint, week_number_of_year smallint, "
    "month_name string, spanish_month_name string, french_month_name string, "
    "month_number_of_year smallint, calendar_quarter smallint, calendar_year smallint, "
    "calendar_semester smallint, fiscal_quarter smallint, fiscal_year smallint, fiscal_semester smallint"
)
TERRITORY_FILE_COLUMNS = (
    "row_key int, sales_territory_alternate_key int, sales_territory_region string, "
    "sales_territory_country string, sales_territory_group string, X string"
)


def read_calendar_csv(spark: SparkSession, path: str) -> DataFrame:
    """The UTF-8 calendar file with its nineteen columns named and typed."""
    return spark.read.csv(path, schema=CALENDAR_FILE_COLUMNS, sep="|", header=False, encoding="UTF-8")


def read_territory_csv(spark: SparkSession, path: str) -> DataFrame:
    """The UTF-16 territory file, without its first column.

    ``multiLine`` makes Spark decode a file as a whole; split by lines, UTF-16
    text is cut between the two bytes of a line end.
    """
    whole = spark.read.csv(
        path, schema=TERRITORY_FILE_COLUMNS, sep="|", header=False, encoding="UTF-16", multiLine=True
    )
    return whole.select(*whole.columns[1:])


def read_flat_dimensions(
    spark: SparkSession, folder: str, calendar: str = "DimDate.csv", territory: str = "DimSalesTerritory.csv"
) -> dict[str, DataFrame]:
    """Both flat-file dimensions of a folder.

    A missing file raises here, when the path is resolved, rather than turning
    into an empty table that fails later.
    """
    return {
        "dim_date": read_calendar_csv(spark, f"{folder}/{calendar}"),
        "dim_sales_territory": read_territory_csv(spark, f"{folder}/{territory}"),
    }
