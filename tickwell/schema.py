"""Message, topic and table shapes."""

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Names, literals, limits and workload constants that results depend on.
TOPIC = "stockprice"
TABLE = "stock_prices"
CONSUMER_GROUP = "stock_price_consumer_group"
PRODUCER_MARKET = "NASDAQ"
DEFAULT_MARKET = "UNKNOWN"
LIMITS = {"symbol": 10, "company": 100, "market": 50}
POLL_SECONDS = 12
POLL_ITERATIONS = 20

#: Current message, in wire order.
TICK_V2 = StructType(
    [
        StructField("price", DoubleType()),
        StructField("symbol", StringType()),
        StructField("company", StringType()),
        StructField("market", StringType()),
    ]
)

#: Legacy message; ``Timestamp`` is epoch milliseconds.
TICK_V1 = StructType(
    [
        StructField("Price", DoubleType()),
        StructField("Name", StringType()),
        StructField("Timestamp", LongType()),
    ]
)

#: What Spark's Kafka source yields; the file-backed topic stores the same.
TOPIC_RECORD = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

PRICE_COLUMNS = ["symbol", "price", "timestamp", "company", "market"]
PRICE_KEY = ["symbol", "timestamp"]

#: Position of a message in its topic; also its arrival order.
LINEAGE = ["topic", "partition", "offset"]

#: Why a record may not be stored.
REASONS = [
    "malformed",
    "not_object",
    "missing_symbol",
    "missing_price",
    "bad_price",
    "bad_symbol",
    "bad_company",
    "bad_market",
    "bad_timestamp",
    "null_symbol",
    *[f"too_long_{name}" for name in LIMITS],
    "null_timestamp",
    "duplicate_key",
]

#: Columns of the reject table.
REJECT_COLUMNS = [*LINEAGE, "value", "reason"]


def price_columns_ddl() -> str:
    """Column list of the price table. The key is enforced by the operators in ``operators.keys``."""
    return (
        f"symbol VARCHAR({LIMITS['symbol']}), price DOUBLE, timestamp TIMESTAMP_NTZ, "
        f"company VARCHAR({LIMITS['company']}), market VARCHAR({LIMITS['market']})"
    )
