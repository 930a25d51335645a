"""Text, date, number and array helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def key(text: Column) -> Column:
    return F.lower(F.trim(text))


def taxon_id(text: Column) -> Column:
    """The first eight characters in upper case after the prefix; an empty id stays empty."""
    return F.when(text != "", F.concat(F.lit("avibase-"), F.upper(F.substring(text, 1, 8)))).otherwise(text)


def title(text: Column) -> Column:
    return F.initcap(F.lower(text))


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def human_size(n: Column) -> Column:
    """Bytes as B, KB, MB, GB or TB with two decimals."""
    x = n.cast("double")
    shown = lambda k, unit: F.format_string(f"%.2f {unit}", F.bround(x / F.lit(1024.0**k), 2))  # noqa: E731  halves to even
    out = shown(4, "TB")
    for k, unit in reversed(list(enumerate(("B", "KB", "MB", "GB")))):
        out = F.when(x < 1024.0 ** (k + 1), shown(k, unit)).otherwise(out)
    return out


def human_duration(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("long")
    m, s = F.pmod(F.floor(whole / 60), F.lit(60)), F.pmod(whole, F.lit(60))
    h = F.floor(whole / 3600)
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, s)).when(m > 0, F.format_string("%dm %ds", m, s)).otherwise(F.format_string("%ds", s))


def decade(date_text: Column) -> Column:
    return F.concat(F.substring(date_text, 1, 3), F.lit("0")).try_cast("int")


def month(date_text: Column) -> Column:
    return F.substring(date_text, 6, 2).try_cast("int")


def looked_up(values: dict, column: Column, default: Column) -> Column:
    """A small map's value for the column, else the default."""
    flat = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*flat), column), default)


def ratio(part: Column, whole: Column, scale: float = 100.0) -> Column:
    """part / whole * scale, and 0 where whole is 0."""
    return F.when(whole != 0, part / whole * scale).otherwise(F.lit(0.0))
