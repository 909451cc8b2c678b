"""Column functions for quote files: names, dates, numbers, file paths."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Date layouts and file-name layout of the quote and forecast files.
DATE_FORMATS = ("MM/dd/yyyy", "yyyy-MM-dd")
QUOTE_FILE_DAY = r"_(\d{2}_\d{2}_\d{4})\.csv$"
FORECAST_FILE = r"/([^/]+)/([^/]+)/([^/]+)_\1_(\d{2}_\d{2}_\d{4})\.csv(?:/[^/]+)?$"


def series_from_path(path: Column) -> Column:
    """Name of the folder holding a file, lower case, runs of blanks as one underscore."""
    return F.lower(F.regexp_replace(F.element_at(F.split(path, "/"), -2), r"\s+", "_"))


def decoded_path(path: Column) -> Column:
    """A file path as ``_metadata.file_path`` gives it, with its percent escapes undone."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def file_order(path: Column) -> Column:
    """Delivery order of quote files: the day in the name, then the path; files without a day come first."""
    day = F.try_to_timestamp(F.regexp_extract(path, QUOTE_FILE_DAY, 1), F.lit("dd_MM_yyyy")).cast("date")
    return F.struct(day.alias("day"), path.alias("path"))


def parse_day(text: Column, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """Date in the first layout that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])


def parse_number(text: Column) -> Column:
    """Double from text with thousands commas and blanks, null if it is no number."""
    return F.trim(F.replace(text, F.lit(","), F.lit(""))).try_cast("double")


def plain_names(names: Iterable[str]) -> list[str]:
    """Column names reduced to letters and digits; two names that become one are an error."""
    cleaned = [re.sub(r"[^A-Za-z0-9]", "", n) for n in names]
    seen: dict[str, int] = {}
    for name in cleaned:
        seen[name.lower()] = seen.get(name.lower(), 0) + 1
    clashes = [n for n, count in seen.items() if count > 1 or not n]
    if clashes:
        raise ValueError(f"column names clash or vanish after cleaning: {clashes}")
    return cleaned


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*plain_names(df.columns))


def calendar_columns(df: DataFrame, day: str = "date") -> DataFrame:
    return df.withColumns({"year": F.year(day).cast("bigint"), "month": F.month(day).cast("bigint")})


def forecast_file_facets(path: Column) -> dict[str, Column]:
    """Kind, model, table and day from ``.../{kind}/{model}/{table}_{kind}_{dd_MM_yyyy}.csv``, a file or a folder of parts."""
    return {
        "kind": F.regexp_extract(path, FORECAST_FILE, 1),
        "model": F.lower(F.regexp_extract(path, FORECAST_FILE, 2)),
        "table": F.regexp_extract(path, FORECAST_FILE, 3),
        "run_date": F.try_to_timestamp(F.regexp_extract(path, FORECAST_FILE, 4), F.lit("dd_MM_yyyy")).cast("date"),
    }


def tidy(value: Column, digits: int) -> Column:
    """Rounded double without a negative zero.

    A value halfway between two results goes up: the last bit of a mean depends on the order of its sum, so a tiny amount
    is added first.
    """
    return F.round(value + F.lit(10.0 ** -(digits + 4)), digits) + F.lit(0.0)
