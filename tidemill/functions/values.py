"""Dates, codes, numbers and labels as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions.text import literal_array

# Weekday numbers, event codes and quality codes.
WEEKDAY_NUMBERS = {
    "Monday": 1, "Tuesday": 2, "Wednesday": 3, "Thursday": 4, "Friday": 5, "Saturday": 6, "Sunday": 7,
}
EVENT_CODES = {"无活动": 0, "Chinese New Year": 1, "Honor Of King": 2, "Cool Summer": 3, "Halloween Horror Night": 4}
QUALITY_CODES = {
    "合格": "GENIUNE", "残次": "DEFECTIVE", "待检": "GRADE",
    "GENIUNE": "GENIUNE", "DEFECTIVE": "DEFECTIVE", "GRADE": "GRADE",
}


def code_of(column: Column, codes: Mapping[str, object], default: Column | None = None) -> Column:
    """Looks a value up in a small fixed map; unknown values give ``default``."""
    mapping = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    found = F.try_element_at(mapping, column)
    return found if default is None else F.coalesce(found, default)


def normalize_quality(column: Column) -> Column:
    """Spoken quality names to codes; unknown names pass through and empty text becomes null."""
    given = F.nullif(column, F.lit(""))
    return code_of(given, QUALITY_CODES, given)


def weekday_number(name: Column) -> Column:
    return code_of(name, WEEKDAY_NUMBERS)


def event_code(name: Column) -> Column:
    return code_of(name, EVENT_CODES, F.lit(0))


def days_since(date: Column, reference: str = "2023-01-01") -> Column:
    return F.datediff(F.to_date(date), F.lit(reference).cast("date"))


def day_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def ratio_percent(part: Column, whole: Column) -> Column:
    """Part of whole in percent; null when the whole is zero."""
    return F.try_divide(part, whole) * 100


def rate_per_100k(cases: Column, population: Column, places: int | None = 2) -> Column:
    rate = F.try_divide(cases, population) * 100000
    return rate if places is None else F.bround(rate, places)


def whole_number_text(x: Column) -> Column:
    return F.format_number(x, 0)


def one_decimal_text(x: Column) -> Column:
    return F.format_string("%.1f", x.cast("double"))


def encode_label(label: Column, labels: Sequence[str]) -> Column:
    """Position in the label list, -1 for a label that is not in it."""
    return (F.coalesce(F.array_position(literal_array(labels), label), F.lit(0)) - 1).cast("int")


def decode_label(code: Column, labels: Sequence[str], unknown: str = "unknow") -> Column:
    return F.when(code == -1, F.lit(unknown)).otherwise(F.try_element_at(literal_array(labels), code + 1))


def one_hot(code: Column, n_labels: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n_labels - 1)), lambda i: (i == code).cast("int"))


def hash_order(key: Column, seed: int = 100) -> Column:
    """A number in [0, 2^32) fixed by key and seed: the order of a repeatable shuffle."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def in_fraction(key: Column, fraction: float, seed: int = 100) -> Column:
    """True for about ``fraction`` of the keys; needs no shuffle at all."""
    return hash_order(key, seed) < int(fraction * 2**32)


def split_sku_argument(argument: Column) -> Column:
    """``"sku,bin"`` to a struct; a missing or empty bin is null."""
    parts = F.split(argument, ",")
    return F.struct(
        F.trim(F.try_element_at(parts, F.lit(1))).alias("sku"),
        F.nullif(F.trim(F.try_element_at(parts, F.lit(2))), F.lit("")).alias("bin"),
    )
