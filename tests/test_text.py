from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chronovault.functions import text
from tests.helpers import value


@pytest.mark.parametrize("raw,name", [
    ("Open", "open_price"), (" Adj Close ", "adjusted_close_price"), ("adjusted_close", "adjusted_close_price"),
    ("Last\t", "current_price"), ("Ask Size", "ask_size"), ("VWAP 30", "vwap_30"), ("", ""),
])
def test_metric_name(spark, raw, name):
    assert value(spark, text.metric_name(F.lit(raw))) == name


@pytest.mark.parametrize("raw,tokens", [
    ("btcusd, aapl msft", ["BTCUSD", "AAPL", "MSFT"]), (" ,, a\n\tb ,", ["A", "B"]), ("", []), (None, None),
])
def test_asset_tokens(spark, raw, tokens):
    assert value(spark, text.asset_tokens(F.lit(raw).cast("string"))) == tokens


@pytest.mark.parametrize("sym,cls", [
    ("BTCUSD", "crypto"), (" eurusd ", "forex"), ("ABCUSD", "forex"), ("CL=F", "commodity"), ("US10Y", "fixed_income"),
    ("SPXOPT", "derivative"), ("aapl", "equity"), ("NEWCO", "equity"),
])
def test_asset_class(spark, sym, cls):
    assert value(spark, text.asset_class(F.lit(sym))) == cls


def test_metadata_defaults(spark):
    known = value(spark, text.asset_metadata(F.lit("us10y"), F.lit("fixed_income")))
    assert tuple(known) == ("fixed_income", "10-year U.S. Treasury note", "US", "bond")
    unknown = value(spark, text.asset_metadata(F.lit(" newco"), F.lit("equity")))
    assert tuple(unknown) == ("equity", "NEWCO financial instrument.", "Unknown", "equity")


@pytest.mark.parametrize("raw,parsed", [
    ("2024-01-20T12:00:00Z", datetime(2024, 1, 20, 12)), ("2024-01-20T12:00:00.999999", datetime(2024, 1, 20, 12)),
    ("2024-01-20T14:00:00+02:00", datetime(2024, 1, 20, 12)), (" 2024-01-20 ", datetime(2024, 1, 20)),
    ("2024-01-20 12:00", datetime(2024, 1, 20, 12)), ("2024-01-20T12", datetime(2024, 1, 20, 12)),
    ("20240120T120000", datetime(2024, 1, 20, 12)), ("2024-01-20t12:00:00", datetime(2024, 1, 20, 12)), ("20240120", datetime(2024, 1, 20)),
    ("2024-01-20T14:00:00,5+02", datetime(2024, 1, 20, 12)), ("2024-0120", None), ("2024-01-20T", None), ("2024", None), ("2024-13-01", None), ("yesterday", None), ("", None),
    (None, None),
])
def test_iso_instant(spark, raw, parsed):
    assert value(spark, text.iso_instant(F.lit(raw).cast("string")).cast("timestamp_ntz")) == parsed


@pytest.mark.parametrize("raw,flag", [("1", True), (" TRUE ", True), ("on", True), ("y", False), ("", False), (None, False)])
def test_parse_flag(spark, raw, flag):
    assert value(spark, text.parse_flag(F.lit(raw).cast("string"))) is flag


def test_date_part_and_year(spark):
    assert value(spark, text.date_part(F.lit("2024-01-20T10:00:00Z"))) == "2024-01-20"
    assert value(spark, text.date_part(F.lit(""))) is None
    assert value(spark, text.business_year(F.lit("2024-01-20"))) == 2024
    assert value(spark, text.business_year(F.lit("n/a"))) is None


@pytest.mark.parametrize("number,shown", [
    (99200.0, "99200.0"), (98266.67, "98266.67"), (12345678.0, "12345678.0"), (0.0, "0.0"), (0.0005, "0.0005"), (-1.5, "-1.5"),
])
def test_number_text(spark, number, shown):
    assert value(spark, text.number_text(F.lit(number))) == shown
