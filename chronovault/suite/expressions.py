"""Scalar functions over text and maps that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions import identity, metrics as m, text
from ..sources.pages import display_texts
from . import views as v
from .registry import query

HEADERS = ["Open", " High", "LOW ", "close", "Volume", "Adj Close", "Adjusted_Close", "quoted", "Ask Size", "Last", "VWAP"]
SYMBOLS = [s for syms in fixed.CLASS_SYMBOLS.values() for s in syms] + ["abcusd", " aapl ", "XUSD ", "gold", "btcusd", "ZZZ"]
FLAGS = ["1", "true", " YES ", "on", "0", "false", "", "no", "On", "t"]


def pick(values: list[str], by: str = "event_id"):
    """One of the values for each row."""
    return F.element_at(F.array(*map(F.lit, values)), (F.col(by) % len(values) + 1).cast("int"))


def sql_pick(values: list[str], by: str = "event_id") -> str:
    quoted = ", ".join("'" + value.replace("'", "''") + "'" for value in values)
    return f"list_extract([{quoted}], CAST({by} % {len(values)} + 1 AS INTEGER))"


def sql_case(on: str, cases: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{value}'" for k, value in cases.items())
    return f"CASE {on} {whens} ELSE {default} END"


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def events(spark, sf):
    return v.table(spark, sf, "events")


_KEY = f"replace(lower({sql_strip('raw')}), ' ', '_')"


@query("str1_metric_names", f"""
    SELECT event_id, raw, {sql_case(_KEY, fixed.METRIC_NAMES, _KEY)} AS metric_name
    FROM (SELECT event_id, {sql_pick(HEADERS)} AS raw FROM events)""")
def str1(spark, sf):
    raw = events(spark, sf).select("event_id", pick(HEADERS).alias("raw"))
    return raw.withColumn("metric_name", text.metric_name(F.col("raw")))


@query("str2_symbols", """SELECT c_custkey, upper(c_name) AS symbol FROM customer WHERE c_mktsegment <> 'MACHINERY'""")
def str2(spark, sf):
    """Machinery customers get a blank name, which is dropped."""
    padded = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(" \t")).otherwise(
        F.concat(F.lit(" "), F.lower("c_name"), F.lit("\t "))
    )
    symbols = v.table(spark, sf, "customer").select("c_custkey", text.symbol(padded).alias("symbol"))
    return symbols.where(F.col("symbol") != "")


@query("str3_asset_list", """
    SELECT l_orderkey, l_linenumber, 'P' || l_partkey || '|S' || l_suppkey || '|' || l_returnflag AS tokens,
           CAST(3 AS BIGINT) AS token_count FROM lineitem""")
def str3(spark, sf):
    listed = F.concat(
        F.lit(" ,p"), F.col("l_partkey").cast("string"), F.lit(", s"), F.col("l_suppkey").cast("string"),
        F.lit("  \n"), F.lower("l_returnflag"), F.lit(","),
    )
    tokens = text.asset_tokens(listed)
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array_join(tokens, "|").alias("tokens"),
        F.size(tokens).cast("long").alias("token_count"),
    )


_CLASS = sql_case(
    "sym", {s: cls for cls, syms in fixed.CLASS_SYMBOLS.items() for s in syms},
    "CASE WHEN sym LIKE '%USD' THEN 'forex' ELSE 'equity' END",
)
_CLASSIFIED = f"""(SELECT *, {_CLASS} AS asset_class
    FROM (SELECT event_id, raw, upper({sql_strip('raw')}) AS sym FROM (SELECT event_id, {sql_pick(SYMBOLS)} AS raw FROM events)))"""


def classified(spark, sf):
    raw = events(spark, sf).select("event_id", pick(SYMBOLS).alias("raw"))
    return raw.withColumn("asset_class", text.asset_class(F.col("raw")))


def _provider_sql(at: int) -> str:
    return sql_case("asset_class", {cls: values[at] for cls, values in fixed.PROVIDERS.items()}, "NULL")


def _instrument_sql(at: int, default: str) -> str:
    return sql_case("sym", {s: values[at] for s, values in fixed.INSTRUMENTS.items()}, default)


@query("str4_classify", f"SELECT event_id, raw, asset_class, {_provider_sql(1)} AS source_identifier FROM {_CLASSIFIED}")
def str4(spark, sf):
    return classified(spark, sf).withColumn("source_identifier", text.provider(F.col("asset_class"))["source_identifier"])


@query("str5_metadata_defaults", f"""
    SELECT event_id, {_provider_sql(4)} AS asset_type,
           {_instrument_sql(0, "sym || ' financial instrument.'")} AS description,
           {_instrument_sql(1, "'Unknown'")} AS region, {_instrument_sql(2, 'asset_class')} AS instrument_class
    FROM {_CLASSIFIED}""")
def str5(spark, sf):
    described = text.asset_metadata(F.col("raw"), F.col("asset_class"))
    return classified(spark, sf).select("event_id", described.alias("d")).select("event_id", "d.*")


@query("str7_date_part", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date_part FROM events")
def str7(spark, sf):
    day = F.col("ts").cast("date").cast("string")
    stamped = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    raw = F.when(F.col("event_id") % 3 == 0, day).otherwise(stamped)
    return events(spark, sf).select("event_id", text.date_part(raw).alias("date_part"))


def legacy_dates(spark, sf):
    """Events with their time as text in ten forms, one of them unreadable."""
    at = F.col("ts").cast("timestamp")
    form = F.col("event_id") % 10
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    return events(spark, sf).select(
        "event_id",
        F.when(form == 0, F.concat(stamp, F.lit("Z")))
        .when(form == 1, F.concat(stamp, F.lit("+02:00")))
        .when(form == 2, F.concat(stamp, F.lit(".250Z")))
        .when(form == 3, F.date_format(at, "yyyy-MM-dd"))
        .when(form == 4, F.concat(F.lit("  "), F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(" ")))
        .when(form == 5, F.date_format(at, "yyyy-MM-dd'T'HH"))
        .when(form == 6, F.date_format(at, "yyyyMMdd'T'HHmmss"))
        .when(form == 7, F.date_format(at, "yyyy-MM-dd't'HH:mm:ss"))
        .when(form == 8, F.concat(F.date_format(at, "yyyyMMdd'T'HHmm"), F.lit("-0130")))
        .otherwise(F.concat(F.lit("about "), stamp)).alias("system_date"),
    )


LEGACY_SQL = """SELECT event_id, CASE event_id % 10
        WHEN 1 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
        WHEN 3 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
        WHEN 5 THEN date_trunc('hour', ts)
        WHEN 8 THEN date_trunc('minute', ts) + INTERVAL 90 MINUTE
        WHEN 9 THEN NULL ELSE date_trunc('second', ts) END AS system_date FROM events"""


@query("str8_iso_normalise", LEGACY_SQL)
def str8(spark, sf):
    return legacy_dates(spark, sf).select(
        "event_id", text.iso_instant(F.col("system_date")).cast("timestamp_ntz").alias("system_date")
    )


@query("str9_year", """SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN CAST(year(ts) AS INTEGER) END AS business_year FROM events""")
def str9(spark, sf):
    raw = F.when(F.col("event_id") % 4 == 0, F.lit("n/a")).otherwise(F.col("ts").cast("date").cast("string"))
    return events(spark, sf).select("event_id", text.business_year(raw).alias("business_year"))


@query("str10_bool", f"""
    SELECT event_id, lower({sql_strip('raw')}) IN ('1', 'true', 'yes', 'on') AS flag
    FROM (SELECT event_id, {sql_pick(FLAGS)} AS raw FROM events)""")
def str10(spark, sf):
    return events(spark, sf).select("event_id", text.parse_flag(pick(FLAGS)).alias("flag"))


_ID_JSON = """'{"asset_id":"U' || user_id || '","business_date":"' || CAST(ts AS DATE) || '","data_source_id":"S' || (event_id % 3) * 60
    || '","metrics":{' || CASE WHEN event_type = 'error' THEN '' ELSE '"close_price":' || value || ',"volume":'
        || CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS VARCHAR) END
    || '},"provenance":{"source_name":"feed","source_url":null,"columns":["date","close"],"note":null,"reason":null,"source":null},'
    || '"landing":' || epoch_us(date_trunc('second', ts)) || '}'"""


@query("str11_ingest_id", f"SELECT event_id, sha256({_ID_JSON}) AS ingest_id FROM events")
def str11(spark, sf):
    described = m.provenance(
        source_name=F.lit("feed"), query_parameters=F.create_map(F.lit("rows"), F.lit("100")),
        row_index=(F.col("event_id") % 100).cast("int"),
        columns=F.array(F.lit("date"), F.lit("close")), captured_at=F.current_timestamp(),
    )
    rows = v.facts(spark, sf).withColumn("provenance", described)
    parts = ("asset_id", "data_source_id", "business_date", "metrics", "provenance")
    return rows.select("event_id", identity.ingest_id(*(F.col(c) for c in parts), F.col("system_date")).alias("ingest_id"))


@query("str12_display", f"""
    SELECT event_id, {_provider_sql(2)} || ' (' || sym || ')' AS display_name,
           {_provider_sql(3)} || ' Ingested asset: ' || sym || '.' AS description FROM {_CLASSIFIED}""")
def str12(spark, sf):
    rows = classified(spark, sf)
    display, description = display_texts(text.symbol(F.col("raw")), text.provider(F.col("asset_class")))
    return rows.select("event_id", display.alias("display_name"), description.alias("description"))


# Price rows as header and value arrays; "Adj Close" and "Adjusted_Close" share a canonical name.
_COLUMNS = ["Date", "Open", "Adj Close", "Adjusted_Close", "Volume"]


def _zipped(spark, sf):
    number = F.col("value").cast("string")
    row = F.array(
        F.col("ts").cast("date").cast("string"), number, F.lit("1.5"),
        (F.col("value") * 2).cast("string"),
        F.when(F.col("event_type") == "view", F.lit("n/a")).otherwise(F.get_json_object("props", "$.k")),
    )
    layout = m.metric_layout(F.array(*map(F.lit, _COLUMNS)))
    return events(spark, sf).select("event_id", m.zip_metrics(layout, row).alias("metrics"))


def _entry(name: str, alias: str | None = None):
    return F.try_element_at("metrics", F.lit(name)).alias(alias or name)


def keys_text():
    return F.array_join(m.metric_keys(F.col("metrics")), ",").alias("keys")


@query("map1_zip_metrics", """
    SELECT event_id, value AS open_price, value * 2 AS adjusted_close_price,
           CASE WHEN event_type <> 'view' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS volume,
           'adjusted_close_price,open_price,volume' AS keys FROM events""")
def map1(spark, sf):
    return _zipped(spark, sf).select(
        "event_id", _entry("open_price"), _entry("adjusted_close_price"), _entry("volume"), keys_text()
    )


def _sparse_metrics(spark, sf):
    """Maps with and without close and open, and with a null under a present key."""
    kind, value = F.col("event_type"), F.col("value")
    none = F.lit(None).cast("double")
    return events(spark, sf).select(
        "event_id", "event_type",
        F.when(kind == "view", F.create_map(F.lit("close_price"), value))
        .when(kind == "click", F.create_map(F.lit("open_price"), value))
        .when(kind == "purchase", F.create_map(F.lit("close_price"), value, F.lit("quoted_price"), none))
        .when(kind == "signup", F.create_map(F.lit("close_price"), value, F.lit("open_price"), value + 1,
                                             F.lit("current_price"), value + 2))
        .otherwise(F.create_map().cast(m.METRICS)).alias("metrics"),
    )


_ALL = "adjusted_close_price,close_price,current_price"


@query("map2_derive_metrics", f"""
    SELECT event_id, CASE event_type WHEN 'signup' THEN value + 2 WHEN 'view' THEN value WHEN 'purchase' THEN value END AS current_price,
           CASE WHEN event_type IN ('view', 'purchase', 'signup') THEN value END AS adjusted_close_price,
           CASE WHEN event_type IN ('view', 'signup', 'click') THEN value END AS quoted_price,
           CASE event_type WHEN 'view' THEN '{_ALL},quoted_price' WHEN 'purchase' THEN '{_ALL},quoted_price'
                WHEN 'signup' THEN '{_ALL},open_price,quoted_price' WHEN 'click' THEN 'open_price,quoted_price' ELSE '' END AS keys
    FROM events""")
def map2(spark, sf):
    rows = _sparse_metrics(spark, sf).withColumn("metrics", m.derive_metrics(F.col("metrics")))
    return rows.select("event_id", _entry("current_price"), _entry("adjusted_close_price"), _entry("quoted_price"), keys_text())


@query("map3_omit_metrics", """
    SELECT event_id, CASE event_type WHEN 'view' THEN 'close_price' WHEN 'purchase' THEN 'close_price'
                     WHEN 'signup' THEN 'close_price,current_price' ELSE '' END AS keys FROM events""")
def map3(spark, sf):
    rows = _sparse_metrics(spark, sf)
    return rows.withColumn("metrics", m.omit_metrics(F.col("metrics"), ["open_price", "quoted_price"])).select("event_id", keys_text())


@query("map4_redact", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN '' WHEN event_type = 'view' THEN 'cursor_id,rows' ELSE 'rows' END AS keys
    FROM events""")
def map4(spark, sf):
    kind = F.col("event_type")
    secret = F.concat(F.lit("k"), F.col("event_id").cast("string"))
    params = (
        F.when(kind == "view", F.create_map(F.lit("rows"), F.lit("100"), F.lit("Api_Key"), secret, F.lit("cursor_id"), secret))
        .when(kind != "error", F.create_map(F.lit("API_KEY"), secret, F.lit("rows"), F.lit("100")))
    )
    return events(spark, sf).select("event_id", m.redact_parameters(params).alias("metrics")).select("event_id", keys_text())


@query("map5_provenance", """
    SELECT event_id, 'feed ' || event_type AS source_name, CAST(event_id % 5 + 1 AS INTEGER) AS page_number,
           'date,open' AS columns, CAST(NULL AS VARCHAR) AS note FROM events""")
def map5(spark, sf):
    described = m.provenance(
        source_name=F.concat(F.lit("feed "), "event_type"), page_number=F.col("event_id") % 5 + 1,
        columns=F.transform(F.array(F.lit("Date"), F.lit("Open")), F.lower),
    )
    return events(spark, sf).select("event_id", described.alias("p")).select(
        "event_id", "p.source_name", "p.page_number", F.array_join("p.columns", ",").alias("columns"), "p.note"
    )


@query("map6_attributes", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE 'close_price,volume' END AS attributes FROM events""")
def map6(spark, sf):
    return v.facts(spark, sf).select("event_id", F.array_join(m.metric_keys(F.col("metrics")), ",").alias("attributes"))


@query("arr1_attr_except", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE 'close_price' END AS attributes FROM events""")
def arr1(spark, sf):
    kept = m.drop_attributes(F.col("attributes"), ["volume", "open_price"])
    return v.facts(spark, sf).select("event_id", F.array_join(kept, ",").alias("attributes"))


@query("arr2_attr_list", f"""
    SELECT event_id, 'business_date,' || {sql_case(_KEY, fixed.METRIC_NAMES, _KEY)} || ',volume' AS attributes
    FROM (SELECT event_id, {sql_pick(HEADERS)} AS raw FROM events)""")
def arr2(spark, sf):
    columns = F.array(F.lit("Date"), pick(HEADERS), F.lit("Volume"))
    return events(spark, sf).select("event_id", F.array_join(m.attribute_list(columns), ",").alias("attributes"))
