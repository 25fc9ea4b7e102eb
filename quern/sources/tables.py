"""Parquet sources and sinks, token shards, binary export and JSON."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from fnmatch import fnmatch
from glob import glob

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.dist import hadoop

UINT16_MAX = 65_535


def _entries(path: str, pattern: str) -> list[tuple[str, int]]:
    """(path, bytes) of the matching files directly in a directory of any file system, in order."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return sorted((f, os.path.getsize(f)) for f in glob(os.path.join(path, pattern)))
    fs, root = hadoop(spark, path)
    if not fs.exists(root):
        return []
    found = ((str(s.getPath().toString()), s.getLen()) for s in fs.listStatus(root) if s.isFile())
    return sorted((p, n) for p, n in found if fnmatch(p.rsplit("/", 1)[-1], pattern))


def directory_stats(path: str, pattern: str = "*.parquet") -> tuple[int, int]:
    """(files, bytes) directly in a directory; (0, 0) if it is missing."""
    files = _entries(path, pattern)
    return len(files), sum(n for _, n in files)


def read_parquet(spark: SparkSession, path: str, limit: int = 0, columns: list[str] | None = None) -> DataFrame:
    """A directory of Parquet files; a missing one is an error before any job runs."""
    fs, root = hadoop(spark, path)
    if not fs.exists(root):
        raise FileNotFoundError(path)
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    return in_file_order(df, df.columns).orderBy("_file", "_row").limit(limit).drop("_file", "_row") if limit else df


def in_file_order(df: DataFrame, columns: list[str]) -> DataFrame:
    """(*columns, _file, _row): a Parquet scan with the place of every row, which orders files by path and rows as stored."""
    return df.select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def write_parquet(df: DataFrame, path: str) -> tuple[int, int]:
    """Replace the directory; (files, bytes) written."""
    df.write.mode("overwrite").parquet(path)
    return directory_stats(path)


def write_split(scored: DataFrame, kept_path: str, dropped_path: str, flag: str = "kept") -> None:
    """Kept and dropped rows to two directories from one pass over the input.

    One job writes both, partitioned by the flag, and each half is then moved to
    its place, so the plan above runs once and nothing needs to be cached.
    """
    spark = scored.sparkSession
    staging = kept_path.rstrip("/") + "_staging"
    scored.withColumn("_flag", F.col(flag)).write.mode("overwrite").partitionBy("_flag").parquet(staging)
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(staging)
    fs = root.getFileSystem(conf)
    for value, target in (("true", kept_path), ("false", dropped_path)):
        source, to = jvm.org.apache.hadoop.fs.Path(f"{staging}/_flag={value}"), jvm.org.apache.hadoop.fs.Path(target)
        fs.delete(to, True)
        if fs.exists(source):
            fs.rename(source, to)
        else:
            scored.limit(0).write.mode("overwrite").parquet(target)
    fs.delete(root, True)


#: Partitions of an ordered write at most; more shards share one.
MOST_PARTITIONS = 10_000


def _in_shards(df: DataFrame, shard: str, shards: int) -> DataFrame:
    """Rows by the number of their shard, contiguous and in order, without a sample of the rows to find ranges."""
    parts = max(1, min(shards, MOST_PARTITIONS))
    return df.repartitionById(parts, F.floor(F.col(shard) * parts / max(1, shards)).cast("int")).sortWithinPartitions(shard, "chunk_id")


def write_chunks(chunks: DataFrame, path: str, seq_len: int, per_shard: int = 2048, compression: str = "zstd", shards: int | None = None) -> None:
    """Packed chunks in order, ``per_shard`` to a file; a chunk of another length is an error.

    ``shards`` is their number if it is known; else a job of its own finds the last chunk.
    """
    ids = F.when(F.size("input_ids") == seq_len, F.col("input_ids")).otherwise(F.raise_error(F.lit(f"a chunk is not {seq_len} tokens long")))
    out = chunks.withColumn("input_ids", ids).withColumn("_shard", F.floor(F.col("chunk_id") / per_shard))
    if shards is None:
        shards = (chunks.agg(F.max(F.floor(F.col("chunk_id") / per_shard))).first()[0] or 0) + 1
    _in_shards(out, "_shard", shards).drop("_shard").write.mode("overwrite").option("compression", compression).option("maxRecordsPerFile", per_shard).parquet(path)


def reshard(df: DataFrame, path: str, order: str | list[str], shards: int, compression: str = "zstd") -> None:
    """Contiguous shards in order."""
    keys = [order] if isinstance(order, str) else order
    df.repartitionByRange(max(1, shards), *keys).sortWithinPartitions(*keys).write.mode("overwrite").option("compression", compression).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    fs, root = hadoop(spark, path)
    fs.delete(root, True)


def token_stats(chunks: DataFrame, *more: Column) -> DataFrame:
    """One row: chunks, tokens, the largest id, and what other aggregates give."""
    top = F.array_max("input_ids")
    return chunks.agg(F.count(F.lit(1)).alias("chunks"), F.coalesce(F.sum(F.size("input_ids")), F.lit(0)).alias("tokens"), F.coalesce(F.max(top), F.lit(-1)).alias("largest_id"), *more)


def write_binary(chunks: DataFrame, path: str, dtype: str = "uint16", force: bool = False, per_part: int = 2048, limit_parts: int = 0, single: bool = True) -> dict:
    """All tokens in chunk order as flat little-endian numbers; the facts of what was written.

    Executors write ordered parts side by side into a folder of any file system
    that Spark knows, ``path`` + ``.parts``, one row of bytes in each; a part ends
    with one line feed that is no token, as the facts say. With ``single`` the
    parts are then joined to one file by the file system's own streams, without a
    token passing through Python, and removed; else they stay, with ``manifest.json``
    beside them. An id that does not fit 16 bits is an error unless ``force`` lets
    it wrap.
    """
    if dtype not in ("uint16", "int32"):
        raise ValueError(dtype)
    spark = chunks.sparkSession
    facts = token_stats(chunks, F.max("chunk_id").alias("last_id")).first()
    if dtype == "uint16" and facts["largest_id"] > UINT16_MAX and not force:
        raise ValueError(f"token id {facts['largest_id']} does not fit uint16")
    kind, wide = ("<u2", 2) if dtype == "uint16" else ("<i4", 4)
    parts_dir = path + ".parts"

    def pack_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}

        def close(part: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([b"".join(held.pop(part))], pa.binary())], ["_part", "bytes"])

        for b in batches:
            for part, ids in zip(b.column("_part").to_pylist(), b.column("input_ids")):
                if part not in held:
                    for done in list(held):
                        yield close(done)
                    held[part] = []
                held[part].append(ids.values.to_numpy(zero_copy_only=False).astype(kind).tobytes() if ids.is_valid else b"")
        for done in list(held):
            yield close(done)

    staged = chunks.select("chunk_id", "input_ids", F.floor(F.col("chunk_id") / per_part).alias("_part"))
    if limit_parts:
        staged = staged.where(F.col("_part") < limit_parts)
    staged = _in_shards(staged, "_part", (facts["last_id"] or 0) // per_part + 1)
    rows = staged.select("_part", "input_ids").mapInArrow(pack_parts, "_part long, bytes binary")
    # one row is one file; bytes pass through the text writer as they are
    rows.sortWithinPartitions("_part").select(F.col("bytes").cast("string")).write.mode("overwrite").option("maxRecordsPerFile", 1).text(parts_dir)
    # by number of the task, then of the file within it
    entries = sorted(_entries(parts_dir, "part-*"), key=lambda e: [int(x) for x in re.search(r"part-(\d+)-.*-c(\d+)", e[0]).groups()])
    size = sum(max(0, n - 1) for _, n in entries)
    out = {"rows": facts["chunks"], "tokens": size // wide, "bytes": size, "dtype": dtype}
    if not single:
        return update_json(parts_dir + "/manifest.json", out | {"parts": [{"file": p.rsplit("/", 1)[-1], "bytes": n - 1} for p, n in entries], "line_feed_after_each_part": True})
    fs, target = hadoop(spark, path)
    stream = fs.create(target, True)
    copy = spark._jvm.org.apache.commons.io.IOUtils.copyLarge
    for p, n in entries:
        source = fs.open(hadoop(spark, p)[1])
        copy(source, stream, 0, n - 1)
        source.close()
    stream.close()
    remove(spark, parts_dir)
    return out


def update_json(path: str, values: dict) -> dict:
    """Merge into a JSON file of any file system that Spark knows, new keys last; the merged content."""
    spark = SparkSession.getActiveSession()
    fs, target = hadoop(spark, path)
    old = json.loads(_read(spark, path)) if fs.exists(target) else {}
    merged = old | values
    out = fs.create(target, True)
    out.write(bytearray(json.dumps(merged, indent=2, ensure_ascii=False, default=str).encode()))
    out.close()
    return merged


def _read(spark: SparkSession, path: str) -> str:
    fs, source = hadoop(spark, path)
    stream = fs.open(source)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
