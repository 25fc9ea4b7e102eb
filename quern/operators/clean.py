"""Cleaning: normalised text, explainable metrics and a first-failure verdict for each document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.dist import once, spread
from quern.functions.text import CJK_CHARS, WORD_CHARS, WS_CHARS, count_in, normalise, ratio, strip

REASONS = ("too_short", "too_long", "too_sparse", "low_language_signal", "too_much_punct", "dup_lines", "ok")
METRICS = ("m_non_ws", "m_alpha_cjk", "m_punct", "m_dup_line")


@dataclass(frozen=True)
class CleanRules:
    min_chars: int = 200
    max_chars: int = 200_000
    min_non_ws_ratio: float = 0.7
    min_alpha_cjk_ratio: float = 0.4
    max_punct_ratio: float = 0.25
    max_dup_line_ratio: float = 0.35


def dup_line_ratio(text: Column) -> Column:
    """Share of the non-blank lines whose stripped text occurs more than once; 0 below five lines.

    Lines are sorted within the row, so equal ones are neighbours and one fold
    counts them: no shuffle, and O(n log n) for a document of n lines.
    """
    lines = F.array_sort(F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != ""))
    start = F.struct(F.lit(None).cast("string").alias("prev"), F.lit(0).alias("run"), F.lit(0).alias("dup"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        same = F.coalesce(acc["prev"] == x, F.lit(False))
        return F.struct(
            x.alias("prev"),
            F.when(same, acc["run"] + 1).otherwise(F.lit(1)).alias("run"),
            (acc["dup"] + F.when(~same, 0).when(acc["run"] == 1, 2).otherwise(1)).alias("dup"),
            (acc["n"] + 1).alias("n"),
        )

    return F.aggregate(lines, start, step, lambda acc: F.when(acc["n"] >= 5, acc["dup"] / acc["n"]).otherwise(F.lit(0.0)))


def score_clean(df: DataFrame, rules: CleanRules | None = None, text_col: str = "text") -> DataFrame:
    """Overwrite the text with its normalised form and add ``kept``, ``drop_reason`` and the metrics.

    Rows that fail before a metric is reached carry 0 in it; a null text counts
    as empty. Columns of the same names are replaced.
    """
    r = rules or CleanRules()
    rest = [c for c in df.columns if c not in ("kept", "drop_reason", *METRICS, text_col)]
    out = once(spread(df).select(*rest, text_col), **{text_col: normalise(F.col(text_col))})
    t = F.col(text_col)
    n = F.length(t)
    out = once(
        out,
        _n=n,
        _non_ws=ratio(n - count_in(t, WS_CHARS), n),
        _alpha=ratio(count_in(t, f"A-Za-z{CJK_CHARS}"), n),
        _punct=ratio(n - count_in(t, f"{WORD_CHARS}{WS_CHARS}{CJK_CHARS}"), n),
    )
    early = (
        F.when(F.col("_n") < r.min_chars, "too_short")
        .when(F.col("_n") > r.max_chars, "too_long")
        .when(F.col("_non_ws") < r.min_non_ws_ratio, "too_sparse")
        .when(F.col("_alpha") < r.min_alpha_cjk_ratio, "low_language_signal")
        .when(F.col("_punct") > r.max_punct_ratio, "too_much_punct")
    )
    # lines are only looked at in texts that pass everything else
    out = out.withColumn("_early", early)
    out = once(out, m_dup_line=F.when(F.col("_early").isNull(), dup_line_ratio(t)).otherwise(F.lit(0.0)))
    reason = F.when(F.col("_early").isNotNull(), F.col("_early")).when(F.col("m_dup_line") > r.max_dup_line_ratio, "dup_lines").otherwise("ok")
    sized = ~F.col("drop_reason").isin("too_short", "too_long")
    out = out.withColumn("drop_reason", reason).withColumns({m: F.when(sized, F.col(x)).otherwise(F.lit(0.0)) for m, x in (("m_non_ws", "_non_ws"), ("m_alpha_cjk", "_alpha"), ("m_punct", "_punct"))})
    return out.withColumn("kept", F.col("drop_reason") == "ok").select(*df.drop("kept", "drop_reason", *METRICS).columns, "kept", "drop_reason", *METRICS)


def split_clean(df: DataFrame, rules: CleanRules | None = None, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): two filters over one scored plan."""
    scored = score_clean(df, rules, text_col)
    return scored.where("kept"), scored.where("not kept")
