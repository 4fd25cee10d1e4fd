"""Expressions on numbers with units, names and lists inside text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimal units of bytes, and seconds of time units.
BYTE_UNITS = {"B": 1.0, "KB": 1e3, "MB": 1e6, "GB": 1e9, "TB": 1e12}
TIME_UNITS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0, "d": 86400.0}


def _lookup(units: dict[str, float], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in units.items() for x in pair]), key)


def parse_bytes(text: Column) -> Column:
    """``1.5 GB`` in bytes, decimal units; 0 if it is none, null for a null."""
    form = r"(?i)^\s*([\d.]+)\s*([KMGT]?B)\s*$"
    size = F.regexp_extract(text, form, 1).try_cast("double") * _lookup(BYTE_UNITS, F.upper(F.regexp_extract(text, form, 2)))
    return F.when(text.isNotNull(), F.coalesce(size, F.lit(0.0)))


def parse_seconds(text: Column) -> Column:
    """``1h 2m 3s 4ms`` in seconds; null without a number and unit."""
    form = F.lit(r"([\d.]+)\s*(ms|d|h|m|s)(?![a-z])")
    numbers, units = F.regexp_extract_all(text, form, 1), F.regexp_extract_all(text, form, 2)
    each = F.zip_with(numbers, units, lambda n, u: n.try_cast("double") * _lookup(TIME_UNITS, u))
    return F.when(F.size(numbers) > 0, F.aggregate(each, F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0.0))))


def parse_percent(text: Column) -> Column:
    """The number of ``350%`` or ``350``; null if there is none."""
    return F.regexp_extract(text, r"^\s*([\d.]+)\s*%?\s*$", 1).try_cast("double")


def process_name(text: Column) -> Column:
    """What stands before `` (``, after the last colon."""
    return F.substring_index(F.substring_index(text, " (", 1), ":", -1)


def raw_file_name(path: Column) -> Column:
    """A file's name without folders and extension."""
    return F.regexp_replace(F.substring_index(F.replace(path, F.lit("\\"), F.lit("/")), "/", -1), r"\.[^.]*$", "")


def human_size(size: Column) -> Column:
    """In binary units, with one decimal."""
    out = F.when(size < 1024, F.format_string("%.1f B", size.cast("double")))
    for k, unit in enumerate(("KiB", "MiB", "GiB", "TiB"), 1):
        scaled = F.format_string("%.1f " + unit, size / F.lit(float(1024**k)))
        out = out.otherwise(scaled) if unit == "TiB" else out.when(size < 1024 ** (k + 1), scaled)
    return out


def sorted_join(values: Column) -> Column:
    """Distinct, trimmed, not empty, sorted, joined by ``;``."""
    trimmed = F.transform(values, lambda x: F.trim(x))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(trimmed, lambda x: x != ""))), ";")


def strict_bool(text: Column) -> Column:
    """true/1/yes/y/on and false/0/no/n/off; anything else is an error."""
    low = F.lower(F.trim(text))
    return F.when(low.isin("true", "1", "yes", "y", "on"), True).when(low.isin("false", "0", "no", "n", "off"), False).otherwise(F.raise_error(F.concat(F.lit("no truth value: "), F.coalesce(text, F.lit("null")))))


def natural_key(text: Column) -> Column:
    """A sort key: digits by number, letters without case."""
    parts = F.regexp_extract_all(F.lower(text), F.lit(r"(\d+|\D+)"), 1)
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike(r"^\d"), F.lpad(x, 20, "0")).otherwise(x)), "")


def neg_log10(q: Column) -> Column:
    """-log10 of a false-discovery rate, at most 50."""
    return F.least(F.lit(50.0), -F.log10(F.greatest(q, F.lit(1e-50))))


def missing_to_null(text: Column) -> Column:
    """Null for the marks that stand for a missing value."""
    return F.when(~F.upper(F.trim(text)).isin("", ".", "NA", "N/A", "NULL", "NONE", "NAN"), text)


def observed(**fields: Column) -> Column:
    """``K=V;K=V`` of a row's evidence; a null value is empty."""
    return F.concat_ws(";", *[F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit(""))) for k, v in fields.items()])
