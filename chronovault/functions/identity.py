"""Content identity of a fact version."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas


def sorted_map(m: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(m)))


#: where a row stood in its landing and when it was read; neither makes it another version
_PLACE = ("captured_at", "query_parameters", "page_number", "page_row_index", "row_index", "next_cursor_id")


def ingest_id(
    asset: Column, source: Column, business_date: Column, metrics: Column, provenance: Column, landing: Column | None = None
) -> Column:
    """SHA-256 of the row's canonical JSON.

    ``landing`` is the time that tells one landing from the next: the page file's time, or a marker's system date. With it, a
    value that comes back is a version of its own, while reading the same landing again gives the same id and the insert
    becomes a no-op. A row's place in the landing stays out of the hash.
    """
    described = [provenance[f.name].alias(f.name) for f in schemas.PROVENANCE.fields if f.name not in _PLACE]
    payload = F.struct(
        asset.alias("asset_id"),
        business_date.alias("business_date"),
        source.alias("data_source_id"),
        sorted_map(metrics).alias("metrics"),
        F.struct(*described).alias("provenance"),
        (F.lit(None).cast("long") if landing is None else F.unix_micros(landing.cast("timestamp"))).alias("landing"),
    )
    return F.sha2(F.to_json(payload, {"ignoreNullFields": "false"}), 256)
