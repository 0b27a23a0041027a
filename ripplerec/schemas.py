"""Schemas of the event model and the result tables."""

from pyspark.sql import types as T

# A decoded event: raw or dense ids, event time, a tie-break id.
RECORD = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("item_id", T.IntegerType(), False),
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("event_id", T.LongType(), False),
])

# Behaviour CSV: column 0 user, 1 item, 2 unused, 3 time (epoch ms), 4 free text.
EVENT_CSV = T.StructType([
    T.StructField("user_id", T.IntegerType(), True),
    T.StructField("item_id", T.IntegerType(), True),
    T.StructField("c2", T.StringType(), True),
    T.StructField("time_ms", T.LongType(), True),
    T.StructField("c4", T.StringType(), True),
])

# Target table `record`: PK (user, item).
RECORD_TABLE = T.StructType([
    T.StructField("user", T.IntegerType(), False),
    T.StructField("item", T.IntegerType(), False),
    T.StructField("time", T.StringType(), False),
])

# Target table `top`: PK (item, rank), rank stored as text of at most 5 chars.
TOP_TABLE = T.StructType([
    T.StructField("item", T.IntegerType(), False),
    T.StructField("rank", T.StringType(), False),
])

# Per-user consumed sets.
USER_CONSUMED = T.StructType([
    T.StructField("user", T.LongType(), False),
    T.StructField("consumed", T.ArrayType(T.IntegerType()), False),
    T.StructField("time", T.ArrayType(T.StringType()), False),
])

# Recommendation rows.
RECOMMENDATION = T.StructType([
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("item_rec", T.ArrayType(T.IntegerType()), False),
    T.StructField("time", T.StringType(), False),
    T.StructField("last_reward", T.IntegerType(), False),
])

# Dimension tables.
ID_MAP = T.StructType([
    T.StructField("raw_id", T.LongType(), False),
    T.StructField("dense_id", T.IntegerType(), False),
])

EMBEDDING = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("vec", T.ArrayType(T.FloatType()), False),
])
