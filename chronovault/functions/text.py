"""Normalising and classifying text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed

# A full ISO date, extended or basic, then a time of hours, minutes or seconds with a fraction, and an offset.
# Groups: year, month, day, hour, minute, second, offset sign, offset hour, offset minute.
ISO_INSTANT = (
    r"^(?:(?=\d{4}-\d\d-\d\d|\d{8}))(\d{4})-?(\d\d)-?(\d\d)"
    r"(?:[Tt ](\d\d)(?::?(\d\d)(?::?(\d\d)(?:[.,]\d{1,9})?)?)?(?:Z|([+-])(\d\d):?(\d\d)?)?)?$"
)


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(pairs: dict[str, str] | dict[str, tuple[str, ...]], fields: tuple[str, ...] = ()) -> Column:
    """A constant map column, of text or of structs with the given fields.

    Catalyst folds it to one literal, so a small lookup needs no join.
    """

    def value(v: str | tuple[str, ...]) -> str:
        if not fields:
            return _quoted(v)
        return "named_struct(" + ", ".join(f"'{f}', {_quoted(x)}" for f, x in zip(fields, v)) + ")"

    return F.expr("map(" + ", ".join(f"{_quoted(k)}, {value(v)}" for k, v in pairs.items()) + ")")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def metric_name(c: Column) -> Column:
    """Vendor column name to canonical metric name; unknown names keep their snake form."""
    key = F.replace(F.lower(strip(c)), F.lit(" "), F.lit("_"))
    return F.coalesce(F.try_element_at(literal_map(fixed.METRIC_NAMES), key), key)


def symbol(c: Column) -> Column:
    return F.upper(strip(c))


def asset_tokens(c: Column) -> Column:
    """``"btcusd, aapl msft"`` to ``[BTCUSD, AAPL, MSFT]``."""
    return F.filter(F.split(F.upper(c), r"[,\s]+"), lambda token: token != "")


def date_part(c: Column) -> Column:
    """The text before ``T``; null for null or empty text."""
    return F.when(c != "", F.split_part(c, F.lit("T"), F.lit(1)))


def parse_flag(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c)).isin("1", "true", "yes", "on"), F.lit(False))


def iso_instant(c: Column) -> Column:
    """ISO text to a UTC timestamp cut to the second; null if it is not ISO."""
    text = strip(c)

    def part(group: int, default: str) -> Column:
        found = F.regexp_extract(text, ISO_INSTANT, group)
        return F.when(found == "", F.lit(default)).otherwise(found)

    local = F.concat(
        part(1, "0"), F.lit("-"), part(2, "0"), F.lit("-"), part(3, "0"), F.lit("T"), part(4, "00"), F.lit(":"), part(5, "00"), F.lit(":"),
        part(6, "00"), part(7, "+"), part(8, "00"), F.lit(":"), part(9, "00"),
    )
    return F.when(text.rlike(ISO_INSTANT), F.date_trunc("second", F.try_to_timestamp(local)))


def business_year(c: Column) -> Column:
    """The year of a date, or of text that starts with one; null if there is none."""
    return F.substring(c.cast("string"), 1, 4).try_cast("int")


def asset_class(sym: Column) -> Column:
    """One of six classes; unknown symbols are forex if they end in USD, else equity."""
    known = literal_map({s: cls for cls, syms in fixed.CLASS_SYMBOLS.items() for s in syms})
    s = symbol(sym)
    return F.coalesce(
        F.try_element_at(known, s),
        F.when(s.endswith("USD"), F.lit("forex")).otherwise(F.lit("equity")),
    )


def provider(cls: Column) -> Column:
    """The provider settings of an asset class, as a struct."""
    fields = ("dataset_root", "source_identifier", "display_name", "description", "asset_type")
    return F.try_element_at(literal_map(fixed.PROVIDERS, fields), cls)


def asset_metadata(sym: Column, cls: Column) -> Column:
    """Type, description, region and instrument class, with defaults for unknown symbols."""
    known = F.try_element_at(literal_map(fixed.INSTRUMENTS, ("description", "region", "instrument_class")), symbol(sym))
    return F.struct(
        provider(cls)["asset_type"].alias("asset_type"),
        F.coalesce(known["description"], F.concat(symbol(sym), F.lit(" financial instrument."))).alias("description"),
        F.coalesce(known["region"], F.lit("Unknown")).alias("region"),
        F.coalesce(known["instrument_class"], cls).alias("instrument_class"),
    )


def number_text(c: Column) -> Column:
    """A double in positional notation with at least one decimal, as in ``99200.0``."""
    plain = F.regexp_replace(c.cast("decimal(38,10)").cast("string"), r"0+$", "")
    positional = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    small = (F.abs(c) >= 1e-3) & (F.abs(c) < 1e7) | (c == 0)
    return F.when(small, c.cast("string")).otherwise(positional)
