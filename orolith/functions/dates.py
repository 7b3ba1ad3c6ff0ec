"""Dates in paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orolith import schema

# How dates stand in paths.
UTM_DATE = r"_utm\d{1,2}_([0-9]{4,8})"
PATH_YEAR = r"/(2[0-9]{3})/"


def _in_window(year: Column) -> Column:
    """Of four digits, or none; compared as text, since a cast that fails throws and catches."""
    return (F.length(year) == 4) & year.between(str(schema.FIRST_YEAR), str(schema.LAST_YEAR))


def choose_date(utm: Column, path_year: Column) -> Column:
    """The 4 to 8 digits after the first zone mark if their year is in the window, else the first path year if it is."""
    return F.when(_in_window(F.substring(utm, 1, 4)), utm).when(_in_window(path_year), path_year)


def date_text(url: Column) -> Column:
    """The date in a path as its digits, or null."""
    return choose_date(F.regexp_extract(url, UTM_DATE, 1), F.regexp_extract(url, PATH_YEAR, 1))


def parse_date(text: Column) -> Column:
    """Eight digits are a day, four the first of a year; other lengths and impossible days are null."""
    return F.when(F.length(text) == 8, F.try_to_timestamp(text, F.lit("yyyyMMdd"))).when(F.length(text) == 4, F.try_to_timestamp(text, F.lit("yyyy")))


def is_bad_date(text: Column, at: Column | None = None) -> Column:
    """Eight digits that are no day; at: the date parsed already."""
    return F.coalesce((F.length(text) == 8) & (parse_date(text) if at is None else at).isNull(), F.lit(False))


def rfc3339(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def with_dates(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds date_text, datetime (text), datetime_unknown, date_error and date_status.

    date_status: unknown without a date in the path, bad_date for an impossible day, error
    for a date of 5 to 7 digits, else built. The regular expressions run in a projection of
    their own, so each runs once a row.
    """
    parts = df.withColumns({"_utm": F.regexp_extract(url, UTM_DATE, 1), "_year": F.regexp_extract(url, PATH_YEAR, 1)})
    dated = parts.withColumn("date_text", choose_date(F.col("_utm"), F.col("_year"))).drop("_utm", "_year").withColumn("_at", parse_date(F.col("date_text")))
    unknown, error = F.col("date_text").isNull(), is_bad_date(F.col("date_text"), F.col("_at"))
    return dated.withColumns({
        "datetime": F.when(unknown, F.lit(schema.UNKNOWN_DATE)).otherwise(rfc3339(F.col("_at"))), "datetime_unknown": unknown, "date_error": error,
        "date_status": F.when(unknown, "unknown").when(error, "bad_date").when(F.col("_at").isNull(), "error").otherwise("built"),
    }).drop("_at")
