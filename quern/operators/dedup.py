"""Near-duplicate clustering: LSH bands, edges, components and one canonical document each."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.dist import cut, salted_lookup
from quern.functions.text import unsigned_text
from quern.operators.graph import components

log = logging.getLogger("quern")

ROWS_PER_BAND = 4


def band_hash(values: Column) -> Column:
    """SHA-1 of the comma-joined unsigned decimals of a band."""
    return F.sha1(F.array_join(F.transform(values, unsigned_text), ","))


def with_signature_column(df: DataFrame) -> DataFrame:
    """Accept the older column name ``minhash_sig``, with a warning; without either, an error."""
    if "signature" in df.columns:
        return df
    if "minhash_sig" in df.columns:
        log.warning("column minhash_sig is read as signature")
        return df.withColumnRenamed("minhash_sig", "signature")
    raise ValueError("no signature column")


def metadata(df: DataFrame) -> DataFrame:
    """(doc_id, ts, length): ts 0 if unknown, length from the text if there is no column for it."""
    length = F.col("length") if "length" in df.columns else F.length("text") if "text" in df.columns else F.lit(0)
    ts = F.col("ts") if "ts" in df.columns else F.lit(0)
    return df.select("doc_id", F.coalesce(ts, F.lit(0)).cast("long").alias("ts"), F.coalesce(length, F.lit(0)).cast("long").alias("length"))


def band_rows(df: DataFrame, rows_per_band: int = ROWS_PER_BAND, k: int = 128) -> DataFrame:
    """(doc_id, band_id, band_hash): one row for each band of each signature; null signatures are an error."""
    if k % rows_per_band:
        raise ValueError(f"{rows_per_band} rows a band do not divide {k}")
    sig = F.when(F.col("signature").isNull() | (F.size("signature") != k), F.raise_error(F.lit(f"a signature is missing or not of {k} values"))).otherwise(F.col("signature"))
    bands = F.transform(F.sequence(F.lit(0), F.lit(k // rows_per_band - 1)), lambda i: F.slice("_s", i * rows_per_band + 1, rows_per_band))
    return df.select("doc_id", sig.alias("_s")).select("doc_id", F.posexplode(bands).alias("band_id", "_v")).select("doc_id", "band_id", band_hash(F.col("_v")).alias("band_hash"))


def edges(bands: DataFrame) -> DataFrame:
    """(u, v) distinct: each document of a bucket with the bucket's smallest.

    A star has the components of all pairs at a size linear in the bucket. The
    heads are found by a map-side combine, so a bucket that a third of all
    documents share is split over many tasks.
    """
    heads = bands.groupBy("band_id", "band_hash").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("_last"), F.count(F.lit(1)).alias("_rows")).where("head <> _last")
    key = F.concat_ws(":", "band_id", "band_hash")
    hits = salted_lookup(bands.select("doc_id", key.alias("_key")), "_key", heads.select(key.alias("_key"), "head", "_rows"), "inner", counts="_rows")
    return hits.where("doc_id <> head").select(F.col("head").alias("u"), F.col("doc_id").alias("v")).distinct()


def bucket_pairs(bands: DataFrame) -> DataFrame:
    """One row: buckets with two documents or more, and the pairs inside them, counted without listing them."""
    n = bands.distinct().groupBy("band_id", "band_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return n.agg(F.count(F.lit(1)).alias("buckets"), F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0)).cast("long").alias("pairs"))


def labelled(df: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, ts, length, component): documents without a link are their own component."""
    found = components(links).withColumnRenamed("node", "doc_id")
    return metadata(df).join(found, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def canonical(members: DataFrame) -> DataFrame:
    """(component, doc_id): of each component the document with the largest (ts, length, doc_id)."""
    return members.groupBy("component").agg(F.max(F.struct("ts", "length", "doc_id")).alias("_m")).select("component", F.col("_m.doc_id").alias("doc_id"))


def keep(df: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of kept documents; all rows of a repeated doc_id survive together."""
    return df.join(kept.select("doc_id"), "doc_id", "left_semi")


class Clustering:
    """The whole step: ``result``, ``stats`` (one row) and ``sample`` (the first 50 edges).

    ``stats`` counts documents, kept and removed ones, the pairs that share a
    bucket (a pair that shares several counts in each) and the distinct links.
    """

    def __init__(self, df: DataFrame, rows_per_band: int = ROWS_PER_BAND, k: int = 128):
        df = with_signature_column(df)
        bands = band_rows(df, rows_per_band, k)
        self.edges = cut(edges(bands))
        self.pairs = bucket_pairs(bands)
        self.members = cut(labelled(df, self.edges))
        self.kept = canonical(self.members)
        self.result = keep(df, self.kept)
        total = self.members.agg(F.countDistinct("doc_id").alias("total_docs"), F.countDistinct("component").alias("kept"))
        rate = F.when(F.col("total_docs") > 0, F.col("removed") / F.col("total_docs")).otherwise(F.lit(0.0))
        # one row each, met on a constant
        one = F.lit(1).alias("_one")
        stats = total.withColumn("removed", F.col("total_docs") - F.col("kept")).withColumn("dedup_rate", rate).select("*", one)
        links = self.edges.agg(F.count(F.lit(1)).alias("links")).select("links", one)
        self.stats = stats.join(self.pairs.select(F.col("pairs").alias("total_candidate_pairs"), one), "_one").join(links, "_one").drop("_one")
        self.sample = self.edges.orderBy("u", "v").limit(50)

    def check(self, rows_kept: int) -> bool:
        """Whether the rows written are those of the kept documents; a warning if they are more, as ids repeat, or fewer."""
        kept = self.kept.count()
        if rows_kept != kept:
            log.warning("%d rows were kept for %d kept documents", rows_kept, kept)
        return rows_kept == kept
