from pyspark.sql import functions as F

from chronovault.functions import metrics as m
from chronovault.functions.identity import ingest_id
from tests.helpers import value


def array(*items):
    return F.array(*map(F.lit, items)).cast("array<string>")


def metric_map(**entries):
    if not entries:
        return F.create_map().cast(m.METRICS)
    return F.create_map(*(F.lit(x) for kv in entries.items() for x in kv)).cast(m.METRICS)


def test_zip_skips_the_date_and_the_later_duplicate_wins(spark):
    zipped = value(spark, m.zip_metrics(m.metric_layout(array("Date", "Open", "Adj Close", "Adjusted_Close")), array("2024-01-01", "1", "2", "3.5")))
    assert zipped == {"open_price": 1.0, "adjusted_close_price": 3.5}


def test_zip_of_short_and_odd_rows(spark):
    assert value(spark, m.zip_metrics(m.metric_layout(array("Date", "Open", "Close")), array("2024-01-01", "n/a"))) == {
        "open_price": None, "close_price": None,
    }
    assert value(spark, m.zip_metrics(m.metric_layout(array("Date")), array("2024-01-01"))) == {}
    three = array("Date", "Close", "close", " CLOSE ", "Open")
    assert value(spark, m.zip_metrics(m.metric_layout(three), array("2024-01-01", "1", "2", "3", "4"))) == {
        "close_price": 3.0, "open_price": 4.0,
    }


def test_derive_tests_the_key_not_the_value(spark):
    assert value(spark, m.derive_metrics(metric_map(close_price=5.0))) == {
        "close_price": 5.0, "current_price": 5.0, "adjusted_close_price": 5.0, "quoted_price": 5.0,
    }
    assert value(spark, m.derive_metrics(metric_map(close_price=5.0, quoted_price=None)))["quoted_price"] is None
    assert value(spark, m.derive_metrics(metric_map(open_price=4.0))) == {"open_price": 4.0, "quoted_price": 4.0}
    assert value(spark, m.derive_metrics(metric_map(close_price=None, open_price=4.0))) == {
        "close_price": None, "open_price": 4.0, "current_price": None, "adjusted_close_price": None, "quoted_price": None,
    }
    assert value(spark, m.derive_metrics(metric_map())) == {}


def test_omit_and_redact(spark):
    assert value(spark, m.omit_metrics(metric_map(a=1.0, b=2.0), ["b", "c"])) == {"a": 1.0}
    params = F.create_map(F.lit("rows"), F.lit("1"), F.lit("Api_KEY"), F.lit("x"))
    assert value(spark, m.redact_parameters(params)) == {"rows": "1"}
    assert value(spark, m.redact_parameters(F.lit(None).cast("map<string,string>"))) == {}


def test_attribute_lists(spark):
    assert value(spark, m.attribute_list(array("Date", "Open", "Close"))) == ["business_date", "open_price", "close_price"]
    assert value(spark, m.drop_attributes(array("a", "b", "c"), ["b"])) == ["a", "c"]
    assert value(spark, m.metric_keys(metric_map(b=1.0, a=2.0))) == ["a", "b"]


def test_ingest_id_ignores_place_and_capture_time_but_sees_nulls_and_landings(spark):
    def identity(metrics, landing=None, **prov):
        return value(spark, ingest_id(F.lit("A"), F.lit("S"), F.lit("2024-01-01").cast("date"), metrics, m.provenance(**prov), landing))

    base = identity(metric_map(a=1.0, b=2.0), captured_at=F.lit("2024-01-01").cast("timestamp"))
    assert len(base) == 64
    assert base == identity(metric_map(b=2.0, a=1.0), captured_at=F.lit("2025-01-01").cast("timestamp"))
    assert base == identity(metric_map(a=1.0, b=2.0), row_index=F.lit(1), page_number=F.lit(3))
    assert base != identity(metric_map(a=1.0, b=2.0), F.lit("2024-01-01").cast("timestamp"))
    assert base != identity(metric_map(a=1.0, b=2.0), note=F.lit("x"))
    assert identity(metric_map(a=None)) != identity(metric_map())
