"""Problem 9: documents of several sources in target shares of the total size.

Weights are propagated through a tree domain - language - source. A leaf can give
at most its size times its number of repeats; what a leaf lacks is given to its
siblings first, and only what a whole branch lacks goes to the branch's siblings
further up. A leaf's budget is then taken from seeded epochs: whole passes over
its documents, and of one more pass, ordered by a hash of seed, epoch and id, the
prefix that fills the rest.

Sizes are tokens of a public tokenizer whose file is a parameter. Per source only
sums leave the executors. The prefix needs no sort of a whole source: sums over
hash buckets find the bucket in which the budget ends, and only that bucket's
documents are ordered.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.dist import cut, spread
from quern.llm.langlabels import language_of

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pre-tokens of byte-level BPE as published with the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Documents of a source whose budget ends among them that one task orders.
ROWS_PER_BUCKET = 20_000
#: mix_targets is a fixed table of settings; a larger one is an error.
MAX_TARGETS = 100_000


def token_counts(path: str = TOKENIZER):
    """A vectorised UDF: tokens of each text, 0 for null."""

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        coder = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for s in texts:
            yield pd.Series([0 if t is None else len(coder.encode_ordinary(t)) for t in s], dtype="int64")

    return count


def source_key(source: Column) -> Column:
    """One name for variants in case, spaces, ``-`` and ``_``; null stays null, blank becomes null."""
    key = F.regexp_replace(F.lower(source), r"[\s\-_ 　]+", "_")
    key = F.regexp_replace(key, "^_+|_+$", "")
    return F.when(key != "", key)


def water_fill(weights: list[float], caps: list[float], budget: float) -> list[float]:
    """Split ``budget`` by weight, no share above its cap, shortages going to the others by weight."""
    got = [0.0] * len(weights)
    open_ = [i for i in range(len(weights)) if weights[i] > 0 and caps[i] > 0]
    while open_ and budget > 1e-9:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if caps[i] <= budget * weights[i] / total]
        if not full:
            for i in open_:
                got[i] = budget * weights[i] / total
            break
        for i in full:
            got[i] = caps[i]
        budget -= sum(caps[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return got


def tree_budgets(leaves: list[dict], budget: float) -> dict[str, float]:
    """Tokens for each leaf: {"path": (domain, language, source), "weight", "cap"} by source.

    A node's weight is that of its leaves together and its cap the sum of theirs;
    on each level, siblings make up for each other before the level above does.
    """

    def spend(part: list[dict], depth: int, amount: float) -> dict[str, float]:
        if depth == len(part[0]["path"]):
            return {part[0]["path"][-1]: min(amount, part[0]["cap"])}
        children: dict[str, list[dict]] = {}
        for leaf in part:
            children.setdefault(leaf["path"][depth], []).append(leaf)
        names = sorted(children)
        shares = water_fill([sum(x["weight"] for x in children[n]) for n in names], [sum(x["cap"] for x in children[n] if x["weight"] > 0) for n in names], amount)
        return {k: v for n, s in zip(names, shares) for k, v in spend(children[n], depth + 1, s).items()}

    return spend(leaves, 0, budget) if leaves else {}


class Mixture:
    """``selected``: (doc_id, source_key, n_tokens, copies); ``shares``: a row for each source.

    ``total`` is the size to reach in tokens. "corpus": the size of all documents
    whose source has a target; there, small sources run out of repeats and their
    shortage goes to siblings and ancestors. "exact": the largest size at which every
    source that has documents reaches its share, so shares come out as asked for.
    Documents without text, source or target are not selected; they are no error.
    A source that is named twice in ``targets`` has the sum of its weights and the
    larger number of repeats; null, negative or NaN weights count as 0, null
    repeats as 1. A doc_id that repeats is selected as a document each time.
    """

    def __init__(self, documents: DataFrame, targets: DataFrame, total: int | str = "corpus", seed: int = 7, tokenizer: str = TOKENIZER):
        spark = documents.sparkSession
        docs = spread(documents.select("doc_id", source_key(F.col("source")).alias("source_key"), language_of(F.col("lang")).alias("language"), "text"))
        docs = docs.select("doc_id", "source_key", "language", token_counts(tokenizer)("text").alias("n_tokens"))
        docs = cut(docs.where("source_key is not null"))  # ids and numbers only; texts are tokenised once
        weight = F.when(F.isnan("weight") | (F.col("weight") < 0), 0.0).otherwise(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)))
        wanted = targets.select(source_key(F.col("source")).alias("source_key"), weight.alias("weight"), F.coalesce(F.col("max_repeats"), F.lit(1)).alias("max_repeats")).where("source_key is not null").groupBy("source_key").agg(F.sum("weight").alias("weight"), F.greatest(F.max("max_repeats"), F.lit(0)).alias("max_repeats"))
        if wanted.count() > MAX_TARGETS:
            raise ValueError(f"more than {MAX_TARGETS} targets")
        sizes = docs.groupBy("source_key", "language").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).groupBy("source_key").agg(F.max_by("language", F.struct("tokens", "language")).alias("language"), F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))
        rows = wanted.join(sizes, "source_key", "left").collect()  # one row a target
        leaves = [{"path": (r["source_key"].split("_")[0], r["language"] or "", r["source_key"]), "weight": r["weight"], "cap": float((r["tokens"] or 0) * r["max_repeats"])} for r in rows]
        have = {r["source_key"]: r["tokens"] or 0 for r in rows}
        if total == "corpus":
            total = sum(r["tokens"] or 0 for r in rows if r["weight"] > 0)
        elif total == "exact":
            parts = tree_budgets([x | {"cap": float("inf") if x["cap"] > 0 else 0.0} for x in leaves], 1.0)
            total = min((x["cap"] / parts[x["path"][-1]] for x in leaves if parts.get(x["path"][-1])), default=0)
        budgets = tree_budgets(leaves, float(total))
        plan = [(k, int(b // have[k]), float(b - b // have[k] * have[k])) for k, b in budgets.items() if have.get(k) and b > 0]
        chosen = F.broadcast(spark.createDataFrame(plan, "source_key string, epochs int, rest double"))
        self.selected = self._select(docs.join(chosen, "source_key"), max((r["docs"] or 0 for r in rows), default=0), seed)
        asked = sum(r["weight"] for r in rows) or 1.0
        facts = [(r["source_key"], r["weight"] / asked, r["max_repeats"], r["tokens"] or 0, float(budgets.get(r["source_key"], 0.0))) for r in rows]
        got = self.selected.groupBy("source_key").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.count(F.lit(1)).alias("docs"), F.max("copies").alias("most_copies"))
        out = spark.createDataFrame(facts, "source_key string, target_share double, max_repeats int, source_tokens long, budget double").join(F.broadcast(got), "source_key", "left").withColumn("_all", F.sum("mixed_tokens").over(Window.partitionBy(F.lit(0))))
        self.shares = out.select("source_key", "target_share", "max_repeats", "source_tokens", "budget", F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"), F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.coalesce(F.col("mixed_tokens") / F.col("_all"), F.lit(0.0)).alias("actual_share"))

    @staticmethod
    def _select(docs: DataFrame, largest: int, seed: int) -> DataFrame:
        n = max(1, -(-largest // ROWS_PER_BUCKET))
        order = F.xxhash64(F.lit(seed), F.col("epochs"), F.col("doc_id"))
        docs = docs.where("n_tokens > 0").withColumn("_order", order).withColumn("_bucket", F.floor((F.shiftrightunsigned(F.col("_order"), 1)) / F.lit(2.0**63) * n).cast("int"))
        ahead = Window.partitionBy("source_key").orderBy("_bucket")
        sums = docs.groupBy("source_key", "_bucket").agg(F.sum("n_tokens").alias("_sum")).withColumn("_start", F.sum("_sum").over(ahead) - F.col("_sum")).withColumnRenamed("_sum", "_size")
        docs = docs.join(sums, ["source_key", "_bucket"])
        inside = (F.col("_start") < F.col("rest")) & (F.col("_start") + F.col("_size") > F.col("rest"))
        whole = docs.where(~inside).withColumn("_more", (F.col("_start") < F.col("rest")).cast("int"))
        upto = F.sum("n_tokens").over(Window.partitionBy("source_key", "_bucket").orderBy("_order", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
        # the document in which the budget ends is taken if most of it fits
        edge = docs.where(inside).withColumn("_upto", F.col("_start") + upto).withColumn("_more", (F.col("_upto") - F.col("n_tokens") / 2 <= F.col("rest")).cast("int")).drop("_upto")
        both = whole.unionByName(edge).withColumn("copies", F.col("epochs") + F.col("_more"))
        return both.where("copies > 0").select("doc_id", "source_key", "n_tokens", "copies")
