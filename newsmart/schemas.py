"""Record schemas, closed vocabularies and the company dimension."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _TS, _D, _L = T.StringType(), T.TimestampType(), T.DoubleType(), T.LongType()
_STRINGS = T.ArrayType(_S)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


# ``raw_metadata`` is an arbitrary JSON object, kept as JSON text.
RAW_NEWS = _struct(
    ("event_id", _S),
    ("timestamp", _TS),
    ("source", _S),
    ("source_url", _S),
    ("title", _S),
    ("content", _S),
    ("tickers", _STRINGS),
    ("raw_metadata", _S),
)

PROCESSED_NEWS = T.StructType(
    RAW_NEWS.fields
    + _struct(("companies", _STRINGS), ("content_hash", _S), ("processed_at", _TS)).fields
)

ENTITY = _struct(("name", _S), ("entity_type", _S), ("relevance_score", _D))

ANALYSIS = _struct(
    ("article_event_id", _S),
    ("summary", _S),
    ("sentiment", _S),
    ("sentiment_confidence", _D),
    ("entities", T.ArrayType(ENTITY)),
    ("key_topics", _STRINGS),
    ("analyzed_at", _TS),
    ("model_id", _S),
    ("analysis_version", _S),
)

# What a model is asked to return.  Numbers are read as text: one in quotes
# ("0.9") still counts as a number.
ANALYSIS_REPLY = _struct(
    ("summary", _S),
    ("sentiment", _S),
    ("sentiment_confidence", _S),
    (
        "entities",
        T.ArrayType(_struct(("name", _S), ("entity_type", _S), ("relevance_score", _S))),
    ),
    ("key_topics", _STRINGS),
)

# What a model answered, kept as it came.
REPLY = _struct(
    ("article_event_id", _S),
    ("reply", _S),
    ("error", _S),
    ("analyzed_at", _TS),
    ("model_id", _S),
    ("analysis_version", _S),
)

TICKER_AGGREGATE = _struct(
    ("ticker", _S),
    ("company_name", _S),
    ("window_start", _TS),
    ("window_end", _TS),
    ("article_count", _L),
    ("avg_sentiment_score", _D),
    ("dominant_sentiment", _S),
)

# A market response is read in two steps: the response with its items left as
# JSON text, then each item on its own, so one bad item costs one item.
MARKET_RESPONSE = _struct(("items", _S), ("feed", _STRINGS))

# The score is read as text: one in quotes still counts as a number.
MARKET_ITEM = _struct(
    ("title", _S),
    ("url", _S),
    ("summary", _S),
    ("source", _S),
    ("time_published", _S),
    ("authors", _STRINGS),
    ("overall_sentiment_score", _S),
    ("overall_sentiment_label", _S),
    (
        "ticker_sentiment",
        T.ArrayType(
            _struct(
                ("ticker", _S),
                ("relevance_score", _S),
                ("ticker_sentiment_score", _S),
                ("ticker_sentiment_label", _S),
            )
        ),
    ),
)

FILING_ENTRY = _struct(
    ("title", _S),
    ("link", T.ArrayType(_struct(("_href", _S), ("_rel", _S), ("_type", _S)))),
    ("id", _S),
    ("updated", _S),
    ("published", _S),
    ("summary", _S),
)

# A topic record: what a broker hands over, or what a landing folder holds.
ENVELOPE = _struct(("topic", _S), ("key", _S), ("value", _S))

# A record that could not be stored, as it came, and why.
DEAD_LETTER = _struct(("topic", _S), ("value", _S), ("reason", _S))

LAKE_COLUMNS = (
    "event_id",
    "timestamp",
    "source",
    "source_url",
    "title",
    "content",
    "tickers",
    "companies",
    "content_hash",
    "processed_at",
)

ARTICLE_VIEW = (
    "event_id",
    "timestamp",
    "source",
    "source_url",
    "title",
    "content",
    "tickers",
    "companies",
    "processed_at",
)

# Topic names.
RAW_TOPIC = "raw-financial-news"
DEAD_LETTER_TOPIC = "raw-financial-news-dlq"
PROCESSED_TOPIC = "processed-financial-news"
ANALYSIS_TOPIC = "llm-analysis-results"
AGGREGATION_TOPIC = "aggregation-results"

# Closed vocabularies and defaults.
SOURCES = ("alpha_vantage", "sec_edgar", "synthetic")
SENTIMENTS = ("bullish", "bearish", "neutral", "mixed")
ENTITY_TYPES = ("company", "person", "sector", "index", "commodity", "currency")
ANALYSIS_VERSION = "1.0"
NO_TICKER = "UNKNOWN"
NO_TICKER_FILING = "SEC-8K"
UNTITLED_FILING = "Untitled SEC Filing"
FILING_TYPE = "8-K"
PROMPT_CONTENT_CHARS = 3000
DEFAULT_WATCHLIST = ("AAPL", "MSFT", "GOOGL", "AMZN", "TSLA")

# Ticker symbol to company name.
COMPANIES = {
    "AAPL": "Apple Inc.",
    "MSFT": "Microsoft Corporation",
    "GOOGL": "Alphabet Inc.",
    "GOOG": "Alphabet Inc.",
    "AMZN": "Amazon.com Inc.",
    "META": "Meta Platforms Inc.",
    "NVDA": "NVIDIA Corporation",
    "TSLA": "Tesla Inc.",
    "TSM": "Taiwan Semiconductor Manufacturing",
    "AVGO": "Broadcom Inc.",
    "ORCL": "Oracle Corporation",
    "ADBE": "Adobe Inc.",
    "CRM": "Salesforce Inc.",
    "NFLX": "Netflix Inc.",
    "AMD": "Advanced Micro Devices Inc.",
    "INTC": "Intel Corporation",
    "CSCO": "Cisco Systems Inc.",
    "IBM": "International Business Machines",
    "QCOM": "Qualcomm Inc.",
    "UBER": "Uber Technologies Inc.",
    "JPM": "JPMorgan Chase & Co.",
    "V": "Visa Inc.",
    "MA": "Mastercard Inc.",
    "BAC": "Bank of America Corporation",
    "WFC": "Wells Fargo & Company",
    "GS": "Goldman Sachs Group Inc.",
    "MS": "Morgan Stanley",
    "C": "Citigroup Inc.",
    "AXP": "American Express Company",
    "BLK": "BlackRock Inc.",
    "UNH": "UnitedHealth Group Inc.",
    "JNJ": "Johnson & Johnson",
    "LLY": "Eli Lilly and Company",
    "PFE": "Pfizer Inc.",
    "ABBV": "AbbVie Inc.",
    "MRK": "Merck & Co. Inc.",
    "TMO": "Thermo Fisher Scientific Inc.",
    "WMT": "Walmart Inc.",
    "PG": "Procter & Gamble Company",
    "KO": "Coca-Cola Company",
    "PEP": "PepsiCo Inc.",
    "COST": "Costco Wholesale Corporation",
    "HD": "Home Depot Inc.",
    "DIS": "Walt Disney Company",
    "MCD": "McDonald's Corporation",
    "NKE": "Nike Inc.",
    "SBUX": "Starbucks Corporation",
    "XOM": "Exxon Mobil Corporation",
    "CVX": "Chevron Corporation",
    "BA": "Boeing Company",
    "CAT": "Caterpillar Inc.",
    "GE": "General Electric Company",
}
