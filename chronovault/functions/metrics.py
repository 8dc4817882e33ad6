"""Building and reshaping metric maps, attribute lists and provenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..fixed import CLOSE_DERIVED
from .text import metric_name

METRICS = "map<string,double>"


def metric(df: DataFrame, name: str) -> Column:
    """A metric of a fact row: the typed column when the table has one, else the map entry."""
    return F.col(name) if name in df.columns else F.try_element_at(F.col("metrics"), F.lit(name))


def price(df: DataFrame, *names: str) -> Column:
    """The first non-null of the named metrics, e.g. ``close_price`` then ``close``."""
    return F.coalesce(*(metric(df, n) for n in names))


def metric_layout(columns: Column) -> Column:
    """Where each metric stands in a row: (name, place) entries for all columns but the date.

    When two headers share a canonical name the later column counts. A layout belongs to a
    page, so it is computed once per page and not per row.
    """

    def last_places(names: Column) -> Column:
        placed = F.transform(names, lambda name, i: F.struct(name.alias("name"), (i + 1).alias("place")))
        later = lambda e: F.slice(names, e["place"] + 1, F.size(names))
        return F.filter(placed, lambda e: F.array_position(later(e), e["name"]) == 0)

    names = F.transform(F.slice(columns, 2, F.greatest(F.size(columns), F.lit(1))), metric_name)
    # the one-element array binds the names, which are used several times
    return F.get(F.transform(F.array(names), last_places), F.lit(0))


def zip_metrics(layout: Column, row: Column) -> Column:
    """A row array to a metric map; a value that is no number or is missing becomes null."""
    return F.map_from_entries(
        F.transform(layout, lambda e: F.struct(e["name"], F.get(row, e["place"]).try_cast("double")))
    )


def derive_metrics(m: Column) -> Column:
    """Add the derived prices whose key is absent; a key with a null value counts as present."""

    def has(key: str) -> Column:
        return F.map_contains_key(m, key)

    def copied(target: str, source: str, when: Column) -> Column:
        entry = F.create_map(F.lit(target), F.try_element_at(m, F.lit(source)))
        return F.when(when & ~has(target), entry).otherwise(F.create_map().cast(METRICS))

    return F.map_concat(
        m,
        *(copied(target, "close_price", has("close_price")) for target in CLOSE_DERIVED),
        copied("quoted_price", "open_price", has("open_price") & ~has("close_price")),
    )


def omit_metrics(m: Column, omit: Sequence[str]) -> Column:
    return F.map_filter(m, lambda key, _: ~key.isin(*omit)) if omit else m


def redact_parameters(params: Column) -> Column:
    """Query parameters without the API key, whatever its letter case; never null."""
    kept = F.map_filter(params, lambda key, _: F.lower(key) != "api_key")
    return F.coalesce(kept, F.create_map().cast("map<string,string>"))


def provenance(**fields: Column) -> Column:
    """The provenance struct with the given fields; the others are null."""
    unknown = set(fields) - set(schemas.PROVENANCE.names)
    if unknown:
        raise ValueError(f"not provenance fields: {sorted(unknown)}")
    return F.struct(*(
        fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.PROVENANCE.fields
    ))


def metric_keys(m: Column) -> Column:
    return F.array_sort(F.map_keys(m))


def attribute_list(columns: Column) -> Column:
    """``business_date`` and the canonical names of the non-date columns."""
    others = F.filter(columns, lambda name: F.lower(name) != "date")
    return F.concat(F.array(F.lit("business_date")), F.transform(others, metric_name))


def drop_attributes(attributes: Column, omit: Sequence[str]) -> Column:
    return F.filter(attributes, lambda name: ~name.isin(*omit)) if omit else attributes
