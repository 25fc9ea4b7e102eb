"""The stateless stages over unbounded input: files that arrive are cleaned, filtered and redacted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quern.operators.clean import CleanRules, score_clean
from quern.operators.pii import redact


def arriving(spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def cleaned(stream: DataFrame, rules: CleanRules | None = None) -> DataFrame:
    """Kept documents with structured personal data replaced; no state, so late data is no matter."""
    return redact(score_clean(stream, rules).where("kept"))


def drop_counts(stream: DataFrame, ts_col: str, delay: str = "10 minutes", window: str = "5 minutes", rules: CleanRules | None = None) -> DataFrame:
    """Documents by verdict in event-time windows; the watermark bounds the state."""
    scored = score_clean(stream.withWatermark(ts_col, delay), rules)
    return scored.groupBy(F.window(ts_col, window).alias("w"), "drop_reason").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "drop_reason", "n")


def write(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet directory exactly once, then stop when what is there is done."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
