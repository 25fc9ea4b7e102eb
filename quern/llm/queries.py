"""The queries of the training-data problems, pN_..., over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.dist import read_table as table
from quern.llm import langid, personal, prose
from quern.llm.components import connected_groups
from quern.llm.leakage import leak_report, leaks
from quern.llm.mixing import Mixture
from quern.llm.packing import pack_items, packed_sequences, packing_checks, packing_report
from quern.llm.repetition import ablations, fails, stored_ledger
from quern.llm.spans import passages, shared_share, sharing_documents
from quern.llm.survivor import chosen_bundles, survivors

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return stored_ledger(table(spark, d, "documents")).where(fails("found")).select("doc_id")


def p1_ledger(spark: SparkSession, d: str) -> DataFrame:
    return stored_ledger(table(spark, d, "documents"))


def p1_ablations(spark: SparkSession, d: str) -> DataFrame:
    return ablations(stored_ledger(table(spark, d, "documents")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    model = personal.train(table(spark, d, "given_names"), table(spark, d, "lang_samples"))
    return personal.items(table(spark, d, "documents"), model).select("doc_id", "kind", "line_no").distinct()


def p2_redacted(spark: SparkSession, d: str) -> DataFrame:
    model = personal.train(table(spark, d, "given_names"), table(spark, d, "lang_samples"))
    return personal.redact(table(spark, d, "documents"), model)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return prose.not_prose(p3_statistics(spark, d)).select("doc_id")


def p3_statistics(spark: SparkSession, d: str) -> DataFrame:
    return prose.statistics(table(spark, d, "documents"), table(spark, d, "common_words"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return connected_groups(table(spark, d, "dup_edges"))


def p4_group_sizes(spark: SparkSession, d: str) -> DataFrame:
    return p4_found(spark, d).groupBy("group_id").agg(F.count(F.lit(1)).alias("n_ids"))


def p5_packed(spark: SparkSession, d: str) -> DataFrame:
    return pack_items(table(spark, d, "token_samples"))


def p5_sequences(spark: SparkSession, d: str) -> DataFrame:
    return packed_sequences(table(spark, d, "token_samples"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return packing_report(pack_items(table(spark, d, "token_samples")))


def p5_checks(spark: SparkSession, d: str) -> DataFrame:
    """One row that SQL can foretell: pieces, tokens, and whether the packing keeps what it must."""
    return packing_checks(pack_items(table(spark, d, "token_samples")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.mislabelled(p6_languages(spark, d))


def p6_languages(spark: SparkSession, d: str) -> DataFrame:
    model = langid.train(table(spark, d, "lang_samples"), table(spark, d, "common_words"))
    return langid.languages(table(spark, d, "documents"), model)


def p6_segments(spark: SparkSession, d: str) -> DataFrame:
    model = langid.train(table(spark, d, "lang_samples"), table(spark, d, "common_words"))
    return langid.segments(table(spark, d, "documents"), model)


def p7_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivors(table(spark, d, "minhash_docs"), connected_groups(table(spark, d, "dup_edges")))


def p7_bundles(spark: SparkSession, d: str) -> DataFrame:
    return chosen_bundles(p7_survivors(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_survivors(spark, d).select("group_id", "doc_id")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return leak_report(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """As many tokens as the corpus has: shortages of small sources move through the tree."""
    return Mixture(table(spark, d, "documents"), table(spark, d, "mix_targets")).selected


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return Mixture(table(spark, d, "documents"), table(spark, d, "mix_targets")).shares


def p9_mixture_exact(spark: SparkSession, d: str) -> DataFrame:
    """The largest mixture in which every source that has documents has its target share."""
    return Mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"), total="exact").selected


def p9_shares_exact(spark: SparkSession, d: str) -> DataFrame:
    return Mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"), total="exact").shares


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sharing_documents(table(spark, d, "documents"))


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    return shared_share(table(spark, d, "documents"))


def p10_passages(spark: SparkSession, d: str) -> DataFrame:
    return passages(table(spark, d, "documents"))


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k.startswith("p") and k[1:2].isdigit()}
