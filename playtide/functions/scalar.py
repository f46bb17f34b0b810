"""Scalar column expressions over payload fields."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.schemas import DEFAULT_MARKET

__all__ = [
    "present", "all_present", "ms_to_mmss", "seconds", "join_names", "join_present_names",
    "pick", "market_used", "int_or_zero", "composite_key", "present_values", "utc_now_iso",
    "numeric_or_null", "nan_to_null", "camelot_code",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str) -> Column:
    """True for a value that is neither null nor the empty string; never null."""
    c = _col(c)
    return c.isNotNull() & (c.cast("string") != "")


def all_present(cols: Iterable[Column | str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & present(c)
    return out


def int_or_zero(c: Column | str) -> Column:
    """Whole number, 0 for null and for text that is not a number."""
    return F.coalesce(_col(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def seconds(ms: Column | str) -> Column:
    """Whole seconds in ``ms`` milliseconds, rounded down; null counts as 0."""
    ms = int_or_zero(ms)
    return F.call_function("div", ms - F.pmod(ms, F.lit(1000)), F.lit(1000))


def ms_to_mmss(ms: Column | str) -> Column:
    """``mm:ss``; minutes run past 59 instead of turning into hours."""
    s = seconds(ms)
    rest = F.pmod(s, F.lit(60))
    return F.format_string("%02d:%02d", F.call_function("div", s - rest, F.lit(60)), rest)


def join_names(people: Column | str, missing: str = "?") -> Column:
    """Names in an array of ``{id, name}``, comma-separated; a missing list gives ''."""
    names = F.transform(_col(people), lambda p: p["name"])
    return F.coalesce(F.array_join(names, ", ", missing), F.lit(""))


def join_present_names(people: Column | str) -> Column:
    """As ``join_names`` but without missing and empty names."""
    return F.coalesce(F.array_join(present_values(people, "name"), ", "), F.lit(""))


def present_values(people: Column | str, field: str) -> Column:
    """One field of an array of structs, without missing and empty values."""
    values = F.filter(F.transform(_col(people), lambda p: p[field]), present)
    return F.coalesce(values, F.array().cast("array<string>"))


def pick(document: Column | str, key: str, nested: str = "audio_features") -> Column:
    """``document.key``, or ``document.nested.key`` where the first is null."""
    document = _col(document)
    return F.coalesce(document[key], document[nested][key])


def market_used(override: Column | str, country: Column | str,
                default: str = DEFAULT_MARKET) -> Column:
    """Market override, else the profile's country, else ``default``; '' is absent."""
    blank = F.lit("")
    return F.coalesce(F.nullif(F.trim(_col(override)), blank),
                      F.nullif(_col(country), blank), F.lit(default))


def composite_key(*cols: Column | str) -> Column:
    """Plain concatenation, null as soon as one part is null."""
    return F.concat(*[_col(c).cast("string") for c in cols])


def utc_now_iso(now: Column | None = None) -> Column:
    """ISO-8601 UTC text with microseconds, e.g. ``2024-01-01T00:00:00.000000+00:00``."""
    now = F.current_timestamp() if now is None else now
    utc = F.to_utc_timestamp(now, F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def numeric_or_null(json_text: Column | str, path: str) -> Column:
    """A field of a JSON text if it is a JSON number or boolean, as double, else null.

    Quoted numbers are text and give null; booleans count as 1 and 0.
    """
    document = F.try_parse_json(_col(json_text))
    kind = F.schema_of_variant(F.try_variant_get(document, path, "variant"))
    is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | kind.startswith("DECIMAL")
    return F.when(is_number, F.try_variant_get(document, path, "double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """All float columns with NaN replaced by null."""
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    return df.select(*[
        F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns
    ])


def camelot_code(key: Column | str, mode: Column | str) -> Column:
    """Position 1..12 on the Camelot wheel for a pitch class 0..11 and a mode (1 major, 0 minor).

    Neighbouring fifths are neighbouring positions: C major is 8B, A minor is 8A.
    """
    key, mode = _col(key).cast("int"), _col(mode).cast("int")
    relative_major = F.when(mode == 1, key).otherwise(F.pmod(key + 3, F.lit(12)))
    return F.pmod(relative_major * 7 + 7, F.lit(12)) + 1
