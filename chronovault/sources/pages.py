"""Landed vendor pages to fact batches."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed, schemas
from ..functions.identity import ingest_id
from ..functions.metrics import (
    attribute_list, derive_metrics, drop_attributes, metric_keys, metric_layout, omit_metrics, provenance,
    redact_parameters, zip_metrics,
)
from ..functions.text import asset_class, asset_metadata, provider, symbol
from ..operators.versions import top_versions
from ..session import materialise

_NO_PARAMETERS = "map<string,string>"
#: the whole text of a response that is no page; null for a page
_UNREADABLE = T.StructField("unreadable", T.StringType())


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON responses: ``<path>/asset_symbol=<symbol>/page_number=<n>/*.json``.

    A file that is no JSON, or no page, keeps its text in ``unreadable``. A file without a byte is no page at all: a walk ends before it.
    """
    schema = T.StructType([*schemas.PAGES.fields, _UNREADABLE])
    landed = spark.read.schema(schema).json(path, multiLine=True, columnNameOfCorruptRecord=_UNREADABLE.name)
    return landed.withColumns({"landed_at": F.col("_metadata.file_modification_time"), "landed_path": F.col("_metadata.file_path")})


def parse_pages(responses: DataFrame) -> DataFrame:
    """Responses that landed as rows with their text in ``body``, as ``read_pages`` gives those that landed as files.

    A text that is no page stays in ``unreadable``; a null or blank one counts as such, as an empty text.
    """
    own = [f for f in schemas.PAGES.fields if f.name not in ("asset_symbol", "page_number")]
    text = F.coalesce(F.col("body"), F.lit(""))
    page = F.from_json(text, T.StructType([*own, _UNREADABLE]), {"columnNameOfCorruptRecord": _UNREADABLE.name})
    taken = {f.name for f in own} | {"_page", "body"}
    return responses.withColumn("_page", page).select(
        *(c for c in responses.columns if c not in taken), *(F.col(f"_page.{f.name}").alias(f.name) for f in own),
        F.when(F.trim(text) == "", F.lit("")).otherwise(F.col(f"_page.{_UNREADABLE.name}")).alias(_UNREADABLE.name),
    )


def _given(pages: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in pages.columns else F.lit(None).cast(kind)


def problem(unreadable: Column) -> Column:
    """What is wrong with a response, or null for a page."""
    return F.when(unreadable.isNotNull(), F.when(F.try_parse_json(unreadable).isNull(), "no JSON").otherwise("no page"))


def request_parameters(cursor: Column | None = None) -> Column:
    """The parameters a page was asked for, without the key."""
    rows = F.create_map(F.lit("rows"), F.lit(str(fixed.ROWS_PER_PAGE)))
    if cursor is None:
        return rows
    with_cursor = F.map_concat(rows, F.create_map(F.lit("cursor_id"), cursor))
    return F.when(cursor.isNotNull(), with_cursor).otherwise(rows)


def normalise_pages(pages: DataFrame) -> DataFrame:
    """Pages with asset_id, row arrays, next cursor, redacted request parameters, and what
    its rows need of the header: lower-case columns, attribute list, metric layout.

    A page that was landed more than once counts in its latest form, readable or not: ``problem`` says what is wrong with it, and
    ``unreadable`` is its text.
    """
    columns = F.coalesce("dataset.column_names", F.array().cast("array<string>"))
    params = F.col("query_parameters") if "query_parameters" in pages.columns else request_parameters()
    unreadable = _given(pages, _UNREADABLE.name, "string")
    normal = pages.select(
        symbol(F.col("asset_symbol")).alias("asset_id"),
        F.col("page_number").cast("int").alias("page_number"),
        F.transform(columns, F.lower).alias("columns"),
        attribute_list(columns).alias("attributes"),
        metric_layout(columns).alias("layout"),
        F.coalesce("dataset.data", F.array().cast("array<array<string>>")).alias("rows"),
        # an empty cursor is none
        F.coalesce(F.nullif("datatable.next_cursor_id", F.lit("")), F.nullif("next_cursor_id", F.lit(""))).alias("next_cursor_id"),
        redact_parameters(params).alias("query_parameters"),
        _given(pages, "landed_at", "timestamp").alias("landed_at"),
        _given(pages, "landed_path", "string").alias("landed_path"),
        problem(unreadable).alias("problem"),
        unreadable.alias("unreadable"),
    ).where(F.col("asset_id") != "")
    order = [F.desc("landed_at"), F.desc(F.size("rows")), F.desc("next_cursor_id")]
    return top_versions(normal, ["asset_id", "page_number"], order)


def _bound(name: str, value: int | None) -> int | None:
    """A bound of the walk: None for no bound, else a positive whole number."""
    if value is not None and (not isinstance(value, int) or isinstance(value, bool) or value < 1):
        raise ValueError(f"{name} must be a positive whole number or None, not {value!r}")
    return value


def reached_pages(pages: DataFrame, max_pages: int | None = None, max_rows: int | None = None) -> DataFrame:
    """The pages a cursor walk visits: it stops at a page without a cursor, at the first number that does not follow
    the one before it, and at the caps that are given.

    Adds ``first_row``, the rows on earlier pages. The walk sees a narrow row for each page; bodies join it at the end.
    """
    return pages.join(walk(pages, max_pages, max_rows).select("asset_id", "page_number", "first_row"), ["asset_id", "page_number"])


def walk(pages: DataFrame, max_pages: int | None = None, max_rows: int | None = None) -> DataFrame:
    """(asset_id, page_number, problem, n_rows, first_row) of the pages that ``reached_pages`` gives; no page's rows are moved.

    An unreadable page has no cursor, so a walk ends with it."""
    by_number = Window.partitionBy("asset_id").orderBy("page_number")
    earlier = by_number.rowsBetween(Window.unboundedPreceding, -1)
    narrow = pages.select("asset_id", "page_number", "problem", F.size("rows").alias("n_rows"), F.col("next_cursor_id").isNull().alias("_last"))
    if _bound("max_pages", max_pages) is not None:
        narrow = narrow.where(F.col("page_number") <= max_pages)
    walked = (
        narrow.withColumns({
            "first_row": F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)),
            "_ended": F.coalesce(F.max("_last").over(earlier), F.lit(False)),
            "_skipped": F.col("page_number") - F.row_number().over(by_number) - F.coalesce(F.min("page_number").over(earlier), "page_number") + 1,
        })
        .where(~F.col("_ended") & (F.col("_skipped") == 0))
        .drop("_ended", "_skipped", "_last")
    )
    return walked if _bound("max_rows", max_rows) is None else walked.where(F.col("first_row") < max_rows)


def number_pages(pages: DataFrame) -> DataFrame:
    """Landed pages that have no number, numbered by their cursors: from 1, the page that was asked for without one.

    ``cursor_id`` is the cursor a page was asked for with; an empty one is none. A walk ends at a page without a next cursor, at a
    cursor whose page has not landed, and before a page that it has been on. Pages no walk reaches are left out, and so is an asset
    whose first page has not landed. Where a page landed more than once, the walk goes on from its latest form; all forms get the
    number, and ``normalise_pages`` keeps the latest.

    Pages are ranked by pointer doubling: turn k joins the pages reached so far to those 2^k pages on, so a chain of n pages takes
    log2(n) turns, on rows of (asset, cursor, next cursor) alone; the pages themselves are joined once at the end.
    """
    spark = pages.sparkSession
    cursor = F.coalesce("cursor_id", F.lit(""))
    following = F.coalesce(F.nullif("datatable.next_cursor_id", F.lit("")), F.nullif("next_cursor_id", F.lit("")))
    landed = _given(pages, "landed_at", "timestamp")
    narrow = pages.select(symbol(F.col("asset_symbol")).alias("asset_id"), cursor.alias("at"), following.alias("to"), landed.alias("landed_at"))
    newest = [F.desc("landed_at"), F.desc("to")]
    links = materialise(spark, top_versions(narrow.where("asset_id <> ''"), ["asset_id", "at"], newest).select("asset_id", "at", "to"), "cursors")
    # where to is not null: the page ``steps`` pages on has the cursor ``to``
    known = links.select("asset_id", F.col("at").alias("to"))
    jumps = materialise(spark, links.where("to IS NOT NULL").join(known, ["asset_id", "to"], "left_semi").select("asset_id", "at", "to"), "jumps")
    reached = materialise(spark, links.where("at = ''").select("asset_id", "at", F.lit(0).cast("long").alias("rank")), "reached")
    steps = 1
    while True:
        onward = jumps.join(reached, ["asset_id", "at"]).select("asset_id", F.col("to").alias("at"), (F.col("rank") + steps).alias("rank"))
        # a page that was reached before ends the walk there; ranks before it stay
        fresh = materialise(spark, onward.join(reached.select("asset_id", "at"), ["asset_id", "at"], "left_anti").groupBy("asset_id", "at").agg(F.min("rank").alias("rank")), "fresh")
        if fresh.isEmpty():
            break
        reached = materialise(spark, reached.unionByName(fresh), "reached")
        second = jumps.select("asset_id", F.col("at").alias("to"), F.col("to").alias("_further"))
        jumps = materialise(spark, jumps.join(second, ["asset_id", "to"]).select("asset_id", "at", F.col("_further").alias("to")), "jumps")
        steps *= 2
    ranks = reached.select(F.col("asset_id").alias("_asset"), F.col("at").alias("_at"), (F.col("rank") + 1).cast("int").alias("page_number"))
    same = (symbol(F.col("asset_symbol")) == F.col("_asset")) & (cursor == F.col("_at"))
    return pages.drop("page_number").join(ranks, same).drop("_asset", "_at")


def page_rows(pages: DataFrame) -> DataFrame:
    """One row per data row of each reached page, with its 0-based place on the page and in the walk."""
    return pages.select(
        "asset_id", "page_number", "columns", "attributes", "layout", "next_cursor_id", "query_parameters", "first_row",
        "landed_at", F.posexplode("rows").alias("page_row_index", "row"),
    ).withColumn("row_index", (F.col("first_row") + F.col("page_row_index")).cast("int")).drop("first_row")


def cap_rows(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The first rows of each asset's walk; all of them for ``None``."""
    return rows if _bound("max_rows", max_rows) is None else rows.where(F.col("row_index") < max_rows)


def _as_batch(rows: DataFrame, omit: Sequence[str], now: Column) -> DataFrame:
    """Rows with metrics, provenance and metadata to a batch in fact layout plus the metadata."""
    batch = rows.withColumn("metrics", omit_metrics(derive_metrics(F.col("metrics")), omit))
    attributes = F.col("source_metadata.attributes")
    return batch.withColumns({
        "system_date": now,
        "attributes": F.when(F.size(attributes) > 0, attributes).otherwise(metric_keys(F.col("metrics"))),
        "ingest_id": ingest_id(
            F.col("asset_id"), F.col("data_source_id"), F.col("business_date"), F.col("metrics"), F.col("provenance"), F.col("_landing")
        ),
        "deleted": F.lit(None).cast("boolean"),
    }).select(*schemas.FACTS.names, "asset_metadata", "source_metadata")


def _source_metadata(display: Column, description: Column, attributes: Column) -> Column:
    return F.struct(
        display.alias("display_name"), description.alias("description"), attributes.alias("attributes"),
        F.lit(fixed.VENDOR_ID).alias("vendor_id"), F.lit(fixed.VENDOR_NAME).alias("vendor_name"),
        F.lit(fixed.VENDOR_DESCRIPTION).alias("vendor_description"),
    )


def display_texts(asset: Column, source: Column) -> tuple[Column, Column]:
    """Display name and description of an asset's feed."""
    return (
        F.concat(source["display_name"], F.lit(" ("), asset, F.lit(")")),
        F.concat(source["description"], F.lit(fixed.INGESTED_ASSET), asset, F.lit(".")),
    )


def vendor_batch(rows: DataFrame, omit: Sequence[str] = (), now: Column | None = None) -> DataFrame:
    """Canonical facts of vendor rows (``page_rows``), with asset and source metadata."""
    now = F.date_trunc("second", F.current_timestamp()) if now is None else now
    cls = asset_class(F.col("asset_id"))
    source = F.col("_source")
    display, description = display_texts(F.col("asset_id"), source)
    url = F.concat(F.lit(fixed.VENDOR_BASE_URL + "/"), source["dataset_root"], F.lit("/"), F.col("asset_id"), F.lit(".json"))
    described = (
        rows.withColumns({"_class": cls, "_source": provider(cls)})
        .select(
            "asset_id",
            source["source_identifier"].alias("data_source_id"),
            F.get("row", F.lit(0)).try_cast("date").alias("business_date"),
            zip_metrics(F.col("layout"), F.col("row")).alias("metrics"),
            provenance(
                source_name=F.lit(fixed.VENDOR_NAME), source_url=url,
                query_parameters=F.col("query_parameters"), page_number=F.col("page_number"),
                page_row_index=F.col("page_row_index"), row_index=F.col("row_index"),
                next_cursor_id=F.col("next_cursor_id"),
                columns=F.col("columns"), captured_at=now,
            ).alias("provenance"),
            F.col("landed_at").alias("_landing"),
            asset_metadata(F.col("asset_id"), F.col("_class")).alias("asset_metadata"),
            _source_metadata(display, description, drop_attributes(F.col("attributes"), omit)).alias("source_metadata"),
        )
    )
    return _as_batch(described, omit, now)


def template_batch(assets: DataFrame, omit: Sequence[str] = (), now: Column | None = None) -> DataFrame:
    """The three template days for each asset; the template is a literal array, no join."""
    now = F.date_trunc("second", F.current_timestamp()) if now is None else now
    days = F.array(*(
        F.struct(
            F.lit(day).cast("date").alias("day"),
            F.map_from_arrays(
                F.array(*map(F.lit, fixed.TEMPLATE_COLUMNS)), F.array(*map(F.lit, values))
            ).alias("metrics"),
        )
        for day, *values in fixed.TEMPLATE_ROWS
    ))
    cls = asset_class(F.col("asset_id"))
    source = F.col("_source")
    attributes = F.array(*map(F.lit, fixed.TEMPLATE_ATTRIBUTES))
    display = F.concat(source["display_name"], F.lit(fixed.TEMPLATE_NAME))
    before, after = fixed.TEMPLATE_DESCRIPTION
    described = (
        assets.select(symbol(F.col("asset_id")).alias("asset_id"))
        .withColumns({"_class": cls, "_source": provider(cls)})
        .select("asset_id", "_class", "_source", F.posexplode(days).alias("_row_index", "_day"))
        .select(
            "asset_id",
            source["source_identifier"].alias("data_source_id"),
            F.col("_day.day").alias("business_date"),
            F.col("_day.metrics").alias("metrics"),
            provenance(
                source_name=display, query_parameters=F.create_map().cast(_NO_PARAMETERS),
                row_index=F.col("_row_index"),
                columns=F.array(*map(F.lit, fixed.TEMPLATE_COLUMNS)), captured_at=now,
            ).alias("provenance"),
            F.lit(None).cast("timestamp").alias("_landing"),  # the template is always the same
            asset_metadata(F.col("asset_id"), F.col("_class")).alias("asset_metadata"),
            _source_metadata(
                F.concat(display, F.lit(" ("), F.col("asset_id"), F.lit(")")),
                F.concat(F.lit(before), source["display_name"], F.lit(after)),
                drop_attributes(attributes, omit),
            ).alias("source_metadata"),
        )
    )
    return _as_batch(described, omit, now)


def normalise_requests(requested: DataFrame) -> DataFrame:
    """Distinct normalised asset ids of a request table, without blanks."""
    return requested.select(symbol(F.col("asset_id")).alias("asset_id")).where(F.col("asset_id") != "").distinct()


def without_data(requested: DataFrame, reached: DataFrame) -> DataFrame:
    """Requested assets without a landed page, or whose walk (see ``walk``) met an empty page."""
    usable = reached.groupBy("asset_id").agg(F.min("n_rows").alias("_least")).where("_least > 0")
    return requested.select("asset_id").distinct().join(usable, "asset_id", "left_anti")


class Ingest(NamedTuple):
    """One ingest run before it is stored: its facts, the assets whose walk failed, the unreadable pages, and counts of pages."""

    batch: DataFrame
    failures: DataFrame
    unreadable: DataFrame
    counts: Observation


def prepare_ingest(
    pages: DataFrame, requested: DataFrame | None = None, omit: Sequence[str] = (),
    max_pages: int | None = None, max_rows: int | None = None,
    fallback: bool = True, now: Column | None = None, fallback_on_failure: bool = False,
) -> Ingest:
    """Reads and walks landed pages once for the requested assets, those of the pages without a request.

    An asset whose walk meets an unreadable page fails: it gets no vendor rows, and template rows only with ``fallback_on_failure``.
    ``failures`` has its id and a reason. ``unreadable`` has every unreadable page of the requested assets, reached or not. ``counts``
    are taken while the pages are written, without a pass of their own. All landed pages and rows of a walk count unless a cap is given.
    """
    spark, counts = pages.sparkSession, Observation()
    # landed pages are read and put in order once; the walk and the rows are then reads of some columns of these
    counted = normalise_pages(pages).observe(
        counts, F.count(F.lit(1)).alias("pages"), F.count("problem").alias("unreadable_pages"), F.sum(F.size("rows").cast("long")).alias("landed_rows"))
    normal = materialise(spark, counted, "pages")
    requested = normalise_requests(normal if requested is None else requested)
    own = normal.join(requested, "asset_id", "left_semi")
    walked = materialise(spark, walk(own, max_pages, max_rows), "walk")
    failures = walked.where("problem IS NOT NULL").select(
        "asset_id", F.concat(F.lit("page "), F.col("page_number").cast("string"), F.lit(" is "), F.col("problem")).alias("reason"))
    empty = without_data(requested, walked)
    reached = normal.join(walked.join(empty, "asset_id", "left_anti").select("asset_id", "page_number", "first_row"), ["asset_id", "page_number"])
    batch = vendor_batch(cap_rows(page_rows(reached), max_rows), omit, now)
    if fallback:
        templates = empty if fallback_on_failure else empty.join(failures, "asset_id", "left_anti")
        batch = batch.unionByName(template_batch(templates, omit, now))
    unreadable = own.where("problem IS NOT NULL").select(
        "asset_id", "page_number", "landed_at", "landed_path", "problem", F.col("unreadable").alias("body"))
    return Ingest(batch, failures, unreadable, counts)


def ingest_batch(
    pages: DataFrame, requested: DataFrame | None = None, omit: Sequence[str] = (),
    max_pages: int | None = None, max_rows: int | None = None,
    fallback: bool = True, now: Column | None = None, fallback_on_failure: bool = False,
) -> DataFrame:
    """All facts of one ingest run: vendor rows, and template rows where the vendor gave none. See ``prepare_ingest``."""
    return prepare_ingest(pages, requested, omit, max_pages, max_rows, fallback, now, fallback_on_failure).batch


def ingest_status(requested: DataFrame, batch: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """``ingested`` or ``error`` per requested asset, with its number of rows.

    With ``failures`` (asset_id, reason) their assets are errors, whatever rows they have, and there is a ``reason``: that of the
    failure, ``no rows`` for an asset without rows, null where all went well.
    """
    requested = normalise_requests(requested)
    counts = batch.groupBy("asset_id").agg(F.count(F.lit(1)).alias("_n"))
    rows = F.coalesce("_n", F.lit(0).cast("long"))
    if failures is None:
        return requested.join(counts, "asset_id", "left").select(
            "asset_id", F.when(rows > 0, "ingested").otherwise("error").alias("status"), rows.alias("rows")
        )
    reason = F.coalesce("reason", F.when(rows == 0, "no rows"))
    reasons = failures.groupBy("asset_id").agg(F.min("reason").alias("reason"))
    return requested.join(counts, "asset_id", "left").join(reasons, "asset_id", "left").select(
        "asset_id", F.when(reason.isNull(), "ingested").otherwise("error").alias("status"), rows.alias("rows"), reason.alias("reason")
    )
