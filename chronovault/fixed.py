"""Lookup tables and constants results depend on, stated as they are."""

from __future__ import annotations

# The symbols of each asset class.
CLASS_SYMBOLS = {
    "equity": ["AAPL", "MSFT", "GOOGL", "TSLA", "AMZN"],
    "fixed_income": ["US10Y", "US30Y", "CORP1"],
    "derivative": ["OILFUT", "GOLDFUT", "SPXOPT"],
    "forex": ["EURUSD", "USDJPY", "GBPUSD"],
    "commodity": ["CL=F", "GC=F", "NG=F"],
    "crypto": ["BTCUSD", "ETHUSD", "LTCUSD"],
}

# The vendor all classes are served by.
VENDOR_ID = "NASDAQ"
VENDOR_NAME = "Nasdaq Data Link"
VENDOR_DESCRIPTION = (
    "Nasdaq provides market data through its Nasdaq Data Link API "
    "for financial instruments and exchange feeds."
)
VENDOR_BASE_URL = "https://data.nasdaq.com/api/v3/datasets"

# Fixed values per class: dataset_root, source_identifier, display_name, description, asset_type.
PROVIDERS = {
    "crypto": (
        "BITFINEX", "NASDAQ-DATA-LINK.QDL/BITFINEX", "Nasdaq Data Link / Bitfinex",
        "Nasdaq Data Link feed for cryptocurrency market data.", "cryptocurrency",
    ),
    "equity": (
        "EOD", "NASDAQ-DATA-LINK.EOD", "Nasdaq Data Link / EOD",
        "Nasdaq Data Link end-of-day equity dataset for public stocks.", "equity",
    ),
    "fixed_income": (
        "WIKI", "NASDAQ-DATA-LINK.WIKI", "Nasdaq Data Link / Fixed Income",
        "Nasdaq Data Link dataset for bond and fixed-income price history.", "fixed_income",
    ),
    "derivative": (
        "WIKI", "NASDAQ-DATA-LINK.WIKI", "Nasdaq Data Link / Derivatives",
        "Nasdaq Data Link dataset for derivative contract data.", "derivative",
    ),
    "forex": (
        "WIKI", "NASDAQ-DATA-LINK.WIKI", "Nasdaq Data Link / Forex",
        "Nasdaq Data Link dataset for foreign exchange contracts.", "forex",
    ),
    "commodity": (
        "WIKI", "NASDAQ-DATA-LINK.WIKI", "Nasdaq Data Link / Commodities",
        "Nasdaq Data Link dataset for commodity market prices.", "commodity",
    ),
}

# Fixed values per symbol: description, region, instrument_class.
INSTRUMENTS = {
    "BTCUSD": ("Bitcoin digital currency", "Global", "cryptocurrency"),
    "ETHUSD": ("Ethereum digital currency", "Global", "cryptocurrency"),
    "LTCUSD": ("Litecoin digital currency", "Global", "cryptocurrency"),
    "AAPL": ("Apple Inc. common stock", "US", "equity"),
    "MSFT": ("Microsoft Corp. common stock", "US", "equity"),
    "GOOGL": ("Alphabet Inc. Class A common stock", "US", "equity"),
    "TSLA": ("Tesla Inc. common stock", "US", "equity"),
    "AMZN": ("Amazon.com Inc. common stock", "US", "equity"),
    "US10Y": ("10-year U.S. Treasury note", "US", "bond"),
    "US30Y": ("30-year U.S. Treasury bond", "US", "bond"),
    "CORP1": ("Corporate bond instrument", "US", "bond"),
    "OILFUT": ("Crude oil futures contract", "Global", "derivative"),
    "GOLDFUT": ("Gold futures contract", "Global", "derivative"),
    "SPXOPT": ("S&P 500 index option contract", "US", "derivative"),
    "EURUSD": ("Euro / U.S. dollar foreign exchange pair", "Global", "forex"),
    "USDJPY": ("U.S. dollar / Japanese yen foreign exchange pair", "Global", "forex"),
    "GBPUSD": ("British pound / U.S. dollar foreign exchange pair", "Global", "forex"),
    "CL=F": ("Crude oil commodity future", "Global", "commodity"),
    "GC=F": ("Gold commodity future", "Global", "commodity"),
    "NG=F": ("Natural gas commodity future", "Global", "commodity"),
}

# Vendor column name -> canonical metric name.
METRIC_NAMES = {
    "open": "open_price",
    "high": "high_price",
    "low": "low_price",
    "close": "close_price",
    "volume": "volume",
    "adj_close": "adjusted_close_price",
    "adjusted_close": "adjusted_close_price",
    "quoted": "quoted_price",
    "ask_size": "ask_size",
    "last": "current_price",
}

# The indicators of the common-indicator query.
COMMON_INDICATORS = [
    "current_price", "open_price", "close_price", "adjusted_close_price",
    "quoted_price", "ask_size", "volume",
]

# The metrics of a gap-filled day, in order.
DAILY_METRICS = [
    "open_price", "high_price", "low_price", "close_price", "volume",
    "current_price", "adjusted_close_price", "quoted_price",
]

# Metrics derived from the close.
CLOSE_DERIVED = ["current_price", "adjusted_close_price", "quoted_price"]

# Template rows for an asset the vendor has nothing for
# (date, then the template columns), newest first.
TEMPLATE_COLUMNS = ["open_price", "close_price", "high_price", "low_price", "volume"]
TEMPLATE_ROWS = [
    ("2026-06-05", 98500.0, 99200.0, 99600.0, 98100.0, 34500.0),
    ("2026-06-04", 97200.0, 98450.0, 98900.0, 96800.0, 29800.0),
    ("2026-06-03", 96100.0, 97150.0, 97500.0, 95400.0, 41200.0),
]

# The attributes of a template feed, and the texts of feeds.
TEMPLATE_ATTRIBUTES = [
    "business_date", "open_price", "high_price", "low_price", "close_price", "volume",
    "current_price", "adjusted_close_price", "quoted_price",
]
TEMPLATE_NAME = " Fallback"
TEMPLATE_DESCRIPTION = ("Fallback sample data for the ", " ingestion pipeline.")
INGESTED_ASSET = " Ingested asset: "

# Rows asked for per page. The bounds below are never a default: a caller who wants them passes them.
ROWS_PER_PAGE = 100
MAX_PAGES = 5
MAX_ROWS = 5
SERIES_LIMIT = 100
LINEAGE_LIMIT = 200
MIN_TRAINING_POINTS = 3
RIDGE_PENALTY = 0.1

# Markers and provenance texts.
DELETE_SOURCE = "SYSTEM.DELETE"
DELETE_REASON = "soft delete marker"
BULK_DELETE_REASON = "bulk soft delete marker"
DELETE_WRITER = "warehouse repository"
BACKFILL_SOURCE_NAME = "BACKFILL"
BACKFILL_NOTE = "backfilled from nearest existing record"
