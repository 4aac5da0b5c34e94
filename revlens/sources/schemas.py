"""Explicit schemas (no inference passes)."""

from pyspark.sql import types as T

RAW_REVIEW = T.StructType(
    [
        T.StructField("Id", T.IntegerType()),
        T.StructField("ProductId", T.StringType()),
        T.StructField("UserId", T.StringType()),
        T.StructField("ProfileName", T.StringType()),
        T.StructField("HelpfulnessNumerator", T.IntegerType()),
        T.StructField("HelpfulnessDenominator", T.IntegerType()),
        T.StructField("Score", T.IntegerType()),
        T.StructField("Time", T.LongType()),
        T.StructField("Summary", T.StringType()),
        T.StructField("Text", T.StringType()),
    ]
)

RAW_COLUMNS = [f.name for f in RAW_REVIEW.fields]

SCORED_REVIEW = T.StructType(
    RAW_REVIEW.fields
    + [
        T.StructField("predicted_sentiment", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("processed_at", T.TimestampNTZType()),
    ]
)

SCORED_COLUMNS = [f.name for f in SCORED_REVIEW.fields]

# A scored-review message as the stream carries it (stand-in model output
# travels with the raw fields when scoring happened upstream).
SCORED_MESSAGE = T.StructType(RAW_REVIEW.fields + [
    T.StructField("predicted_sentiment", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])

MODEL_RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("model_path", T.StringType()),
    ]
)
