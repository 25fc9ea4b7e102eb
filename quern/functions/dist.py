"""Helpers that keep plans safe on a cluster: lineage cuts and skew-proof lookups."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one key that a single task may be asked to hold in a lookup.
ROWS_PER_SLICE = 200_000
#: Hot keys up to this number are broadcast; more of them are met by a shuffle.
MOST_HOT = 100_000


def shared_dir(spark: SparkSession) -> str:
    """A folder of this session in the shared one that ``spark.checkpoint.dir`` names; a private one only in local mode."""
    sc = spark.sparkContext
    set_dir = sc._jsc.sc().getCheckpointDir()
    shared = spark.conf.get("spark.checkpoint.dir", None) or (set_dir.get() if set_dir.isDefined() else None)
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="quern-shared-")
        atexit.register(shutil.rmtree, shared, True)
        spark.conf.set("spark.checkpoint.dir", shared)
    path = f"{shared.rstrip('/')}/quern-{sc.applicationId}"
    fs, root = hadoop(spark, path)
    if not fs.exists(root):
        fs.mkdirs(root)
        fs.deleteOnExit(root)
    return path


def hadoop(spark: SparkSession, path: str):
    """(file system, path) of a path in any file system that Spark knows."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder, and go on from there.

    Such a table survives the loss of executors, and its size is known to the
    optimiser, which broadcasts what is small and shuffles what is not. Only narrow
    tables (ids, counts, hashes, tokens) should pass through here, never whole texts.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables written by ``cut`` that no plan needs any more."""
    for t in tables:
        path = getattr(t, "_written", None)
        if path:
            fs, root = hadoop(t.sparkSession, path)
            fs.delete(root, True)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row, however many later expressions use them.

    Catalyst inlines a projection into the filters and projections above it, and
    a costly expression with it. Nothing is inlined through a generator, so a
    one-element explode keeps the values as plain attributes; it runs inside the
    same stage.
    """
    rest = [c for c in df.columns if c not in columns]
    held = df.select(*rest, F.explode(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))).alias("_once"))
    return held.select(*rest, *[F.col(f"_once.{k}").alias(k) for k in columns])


def spread(scan: DataFrame) -> DataFrame:
    """Give every core a part of a scan that has fewer splits than there are cores.

    A small file with one row group is one split, which leaves a costly map stage
    to one core. Larger inputs have more splits than cores and are not shuffled;
    neither is anything but a plain scan, whose splits are known without running it.
    """
    if scan.isStreaming or "Exchange" in scan._jdf.queryExecution().executedPlan().toString():
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def _bytes(df: DataFrame) -> int:
    """The optimiser's estimate, which is never below the truth for written tables."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def salted_lookup(
    big: DataFrame,
    key: str,
    small: DataFrame,
    how: str = "left",
    rows_per_slice: int = ROWS_PER_SLICE,
    counts: str | None = None,
) -> DataFrame:
    """Join ``big`` to ``small`` (unique on ``key``) where one key may hold a third of ``big``.

    Keys with more than ``rows_per_slice`` rows are counted with a map-side
    combine, unless ``counts`` names a column of ``small`` that has the number of
    rows already (it is dropped). Each such key is split over
    ``ceil(rows / rows_per_slice)`` salts and only its own row of ``small`` is
    repeated. A ``small`` below the broadcast threshold is broadcast, which knows no
    hot keys. Else the list of such keys is counted first: none, and the join is plain;
    up to MOST_HOT, and it is broadcast; more, and it is joined by a shuffle of its
    own. Null keys never match; with ``how="left"`` their rows stay.
    """
    spark = big.sparkSession
    if _bytes(small) <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold():
        return big.join(small.drop(counts) if counts else small, key, how)  # Spark broadcasts it, by its size
    if counts:
        many = small.select(F.col(key).alias("_hot"), F.col(counts).alias("_n"))
        small = small.drop(counts)
    else:
        many = big.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    hot = many.where(F.col("_n") > rows_per_slice).select("_hot", F.ceil(F.col("_n") / rows_per_slice).cast("int").alias("_fan"))
    found = hot.limit(MOST_HOT + 1).collect()
    if not found:
        return big.join(small, key, how)
    if len(found) <= MOST_HOT:
        hot = F.broadcast(spark.createDataFrame(found, hot.schema))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in big.columns])
    left = (
        big.join(hot, F.col(key) == F.col("_hot"), "left")
        .withColumn("_salt", F.when(F.col("_fan").isNull(), F.lit(0)).otherwise(F.pmod(row, F.col("_fan")).cast("int")))
        .drop("_hot", "_fan")
    )
    right = (
        small.join(hot, F.col(key) == F.col("_hot"), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_fan"), F.lit(1)) - 1)))
        .drop("_hot", "_fan")
    )
    return left.join(right, [key, "_salt"], how).drop("_salt")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
