"""Every core query over whole tables, with its SQL twin where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.dist import read_table as table
from quern.functions.dist import shared_dir
from quern.functions.text import flatten_space, fold, normalise, unsigned_text
from quern.operators import clean, dedup, minhash, pack, pii, quality, tokenize
from quern.operators.graph import components
from quern.sources import wet
from quern.sources.tables import token_stats

Query = Callable[[SparkSession, str], DataFrame]
#: A public SentencePiece model; its path is a parameter.
SENTENCEPIECE = "/opt/tokenizers/piece_bpe_32k.model"
BPE_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


# --- SQL building blocks (RE2 patterns) ---------------------------------------------------

_C = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A[{_C}]+|[{_C}]+\z', '', 'g')"


def _sql_normalise(x: str) -> str:
    feeds = rf"regexp_replace(coalesce({x}, ''), '\r\n?', chr(10), 'g')"
    return rf"regexp_replace({_sql_strip(feeds)}, '\n{{3,}}', chr(10) || chr(10), 'g')"


_SCORED = rf"""
WITH a AS (SELECT doc_id, {_sql_normalise("text")} AS t FROM documents),
b AS (SELECT doc_id, t, length(t) AS n,
  CASE WHEN length(t) > 0 THEN length(regexp_replace(t, '[{_C}]+', '', 'g')) / length(t)::DOUBLE ELSE 0.0 END AS non_ws,
  CASE WHEN length(t) > 0 THEN (length(t) - length(regexp_replace(t, '[A-Za-z\x{{4e00}}-\x{{9fff}}]+', '', 'g'))) / length(t)::DOUBLE ELSE 0.0 END AS alpha,
  CASE WHEN length(t) > 0 THEN length(regexp_replace(t, '[\p{{L}}\p{{N}}_{_C}\x{{4e00}}-\x{{9fff}}]+', '', 'g')) / length(t)::DOUBLE ELSE 0.0 END AS punct FROM a),
l AS (SELECT doc_id, {_sql_strip("unnest(string_split(t, chr(10)))")} AS line FROM b),
k AS (SELECT doc_id, line, count(*) AS c FROM l WHERE line <> '' GROUP BY ALL),
d AS (SELECT doc_id, CASE WHEN sum(c) >= 5 THEN sum(CASE WHEN c > 1 THEN c ELSE 0 END) / sum(c)::DOUBLE ELSE 0.0 END AS dup FROM k GROUP BY doc_id),
e AS (SELECT b.*, coalesce(d.dup, 0.0) AS dup,
  CASE WHEN n < 200 THEN 'too_short' WHEN n > 200000 THEN 'too_long' WHEN non_ws < 0.7 THEN 'too_sparse' WHEN alpha < 0.4 THEN 'low_language_signal'
       WHEN punct > 0.25 THEN 'too_much_punct' WHEN coalesce(d.dup, 0.0) > 0.35 THEN 'dup_lines' ELSE 'ok' END AS drop_reason
  FROM b LEFT JOIN d USING (doc_id)),
scored AS (SELECT doc_id, t AS text, drop_reason = 'ok' AS kept, drop_reason,
  CASE WHEN drop_reason IN ('too_short', 'too_long') THEN 0.0 ELSE non_ws END AS m_non_ws,
  CASE WHEN drop_reason IN ('too_short', 'too_long') THEN 0.0 ELSE alpha END AS m_alpha_cjk,
  CASE WHEN drop_reason IN ('too_short', 'too_long') THEN 0.0 ELSE punct END AS m_punct,
  CASE WHEN drop_reason IN ('ok', 'dup_lines') THEN dup ELSE 0.0 END AS m_dup_line FROM e)
"""


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")


# --- cleaning -----------------------------------------------------------------------------


@query(_SCORED + "SELECT drop_reason, count(*) AS n FROM scored GROUP BY drop_reason")
def clean_reasons(spark: SparkSession, d: str) -> DataFrame:
    return clean.score_clean(_documents(spark, d)).groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))


@query(_SCORED + "SELECT doc_id, kept, drop_reason, round(m_non_ws, 9) AS m_non_ws, round(m_alpha_cjk, 9) AS m_alpha_cjk, round(m_punct, 9) AS m_punct, round(m_dup_line, 9) AS m_dup_line FROM scored")
def clean_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = clean.score_clean(_documents(spark, d)).drop("text")
    return out.withColumns({m: F.round(m, 9) for m in clean.METRICS})


@query(_SCORED + "SELECT doc_id, text FROM scored WHERE kept")
def clean_kept(spark: SparkSession, d: str) -> DataFrame:
    return clean.split_clean(_documents(spark, d))[0].select("doc_id", "text")


@query(_SCORED + "SELECT doc_id, drop_reason FROM scored WHERE NOT kept")
def clean_dropped(spark: SparkSession, d: str) -> DataFrame:
    return clean.split_clean(_documents(spark, d))[1].select("doc_id", "drop_reason")


@query(_SCORED + "SELECT doc_id, round(dup, 9) AS dup FROM e")
def dup_line_ratio(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).select("doc_id", F.round(clean.dup_line_ratio(normalise(F.col("text"))), 9).alias("dup"))


@query(f"SELECT doc_id, source_path, sha1(coalesce(source_path, '') || chr(10) || coalesce(url, '') || chr(10) || coalesce(warc_date, '') || chr(10) || coalesce(doc_id, '')) AS new_id, length({_sql_normalise('text')}[1:200000]) AS n_chars FROM ingest_pages WHERE length({_sql_normalise('text')}) >= 200")
def ingest_documents(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "ingest_pages").withColumnRenamed("doc_id", "record_id")
    return wet.as_documents(pages, wet.IngestRules(), ["record_id"]).select(F.col("record_id").alias("doc_id"), "source_path", F.col("doc_id").alias("new_id"), F.length("text").cast("long").alias("n_chars"))


@query(f"SELECT {_sql_strip("regexp_replace(coalesce(url, ''), '[\\r\\n]+', ' ', 'g')")} AS url, {_sql_strip("regexp_replace(coalesce(warc_date, ''), '[\\r\\n]+', ' ', 'g')")} AS warc_date, sha1({_sql_normalise('text')}[1:200000]) AS text_sha1 FROM ingest_pages WHERE length({_sql_normalise('text')}) >= 200")
def wet_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Pages written as web-archive files and read back, through any file system that Spark knows."""
    root = f"{shared_dir(spark)}/wet-{uuid.uuid4().hex}"
    wet.write_pages(table(spark, d, "ingest_pages"), root)
    paths = wet.discover(root, "*.gz", spark=spark)
    return wet.read_wet(spark, paths).select("url", "warc_date", F.sha1("text").alias("text_sha1"))


@query(f"SELECT doc_id, {_sql_strip(rf"regexp_replace(coalesce(text, ''), '[{_C}]+', ' ', 'g')")} AS flat FROM documents")
def flattened_text(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).select("doc_id", flatten_space(F.col("text")).alias("flat"))


# --- language and quality -----------------------------------------------------------------


@query("SELECT lang, count(*) AS n FROM clean_scores GROUP BY lang")
def language_distribution(spark: SparkSession, d: str) -> DataFrame:
    return quality.language_counts(table(spark, d, "clean_scores"))


@query("SELECT lang, CAST(quality_keep AS VARCHAR) AS quality_keep, count(*) AS n FROM clean_scores GROUP BY lang, quality_keep")
def language_quality_distribution(spark: SparkSession, d: str) -> DataFrame:
    return quality.keep_counts(table(spark, d, "clean_scores")).withColumn("quality_keep", F.col("quality_keep").cast("string"))


@query("SELECT doc_id, lang, lang_score, coalesce(lang IN ('__label__zh', '__label__en') AND lang_score >= 0.4, false) AS quality_keep FROM clean_scores")
def quality_keep_rule(spark: SparkSession, d: str) -> DataFrame:
    keep = quality.LanguageFilter()
    return table(spark, d, "clean_scores").select("doc_id", "lang", "lang_score", keep.keep(F.col("lang"), F.col("lang_score")).alias("quality_keep"))


@query("SELECT count(*) AS total, coalesce(sum(CASE WHEN quality_keep THEN 1 ELSE 0 END), 0)::BIGINT AS kept, round(coalesce(sum(CASE WHEN quality_keep THEN 1 ELSE 0 END), 0) / count(*)::DOUBLE, 9) AS rate FROM clean_scores")
def quality_keep_rate(spark: SparkSession, d: str) -> DataFrame:
    return quality.keep_rate(table(spark, d, "clean_scores")).withColumn("rate", F.round("rate", 9))


@query()
def language_identified(spark: SparkSession, d: str) -> DataFrame:
    model = quality.TrigramModel.train(table(spark, d, "lang_samples"))
    keep = quality.LanguageFilter(model, ("zh", "en"), 0.4)
    return keep.apply(_documents(spark, d)).select("doc_id", "lang", "lang_score", "quality_keep")


@query()
def quality_classified(spark: SparkSession, d: str) -> DataFrame:
    """Scores of a classifier that learns the logged quality decisions (the last one of each document)."""
    last = table(spark, d, "clean_scores").where("quality_keep is not null").groupBy("doc_id").agg(F.max_by("quality_keep", F.struct("loaded_at", "quality_keep")).alias("keep"))
    docs = _documents(spark, d)
    labelled = docs.join(last, "doc_id").select("text", F.when(F.col("keep"), "good").otherwise("bad").alias("label"))
    return quality.QualityFilter("good", max_rows=5_000).fit(labelled).score(docs).select("doc_id", "quality_score", "quality_pass")


# --- personal data ------------------------------------------------------------------------

_RE = {k: p for k, (p, _) in pii.PATTERNS.items()}
_SQL_REDACTED = "text"
for _pattern, _mark in pii.PATTERNS.values():
    _SQL_REDACTED = f"regexp_replace({_SQL_REDACTED}, '{_pattern}', '{_mark}', 'g')"
_SQL_FLAGS = ", ".join(f"coalesce(regexp_matches(text, '{p}'), false) AS pii_has_{k}" for k, p in _RE.items())
_SQL_NEED = " OR ".join([f"pii_has_{k}" for k in _RE] + ["coalesce(contains(text, '@'), false)", f"coalesce(regexp_matches(text, '{pii.CONTACT}'), false)", f"coalesce(regexp_matches(text, '{pii.NAME_SHAPE}'), false)"])


@query(f"SELECT doc_id, {_SQL_FLAGS} FROM documents")
def pii_flags(spark: SparkSession, d: str) -> DataFrame:
    return pii.redact(_documents(spark, d), keep_stats=True).select("doc_id", *pii.FLAGS)


@query(f"SELECT doc_id, {_SQL_REDACTED} AS text FROM documents")
def pii_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redact(_documents(spark, d))


@query(
    f"WITH a AS (SELECT doc_id, text, lang, {_SQL_FLAGS}, {_SQL_REDACTED} AS r FROM documents) SELECT doc_id, {_SQL_NEED} AS need_ner, "
    r"CASE WHEN length(regexp_replace(lang, '^__label__', '')) >= 2 THEN lower(substring(regexp_replace(lang, '^__label__', ''), 1, 2)) WHEN regexp_matches(r, '[\x{4e00}-\x{9fff}]') THEN 'zh' ELSE 'en' END AS ner_lang FROM a"
)
def pii_routing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return pii.redact(docs, lang_col="lang", keep_routing=True).select("doc_id", "need_ner", "ner_lang")


@query(
    f"WITH a AS (SELECT doc_id, text, lang, {_SQL_FLAGS}, {_SQL_REDACTED} AS r FROM documents), "
    r"b AS (SELECT doc_id, r, " + _SQL_NEED + r" AS need, CASE WHEN length(regexp_replace(lang, '^__label__', '')) >= 2 THEN lower(substring(regexp_replace(lang, '^__label__', ''), 1, 2)) WHEN regexp_matches(r, '[\x{4e00}-\x{9fff}]') THEN 'zh' ELSE 'en' END AS l FROM a), "
    r"p AS (SELECT lower(substring(regexp_replace(lang, '^__label__', ''), 1, 2)) AS l, string_agg(DISTINCT given_name, '|' ORDER BY given_name) AS names FROM given_names GROUP BY 1) "
    r"SELECT doc_id, CASE WHEN need AND b.l = 'zh' THEN regexp_replace(r, '[\x{4e00}-\x{9fff}](?:' || names || ')', '<NAME>', 'g') WHEN need AND b.l = 'en' THEN regexp_replace(r, '\b(?:' || names || "
    r"""') (?:[A-Z]\. ?)*(?:(?:de|da|di|del|van|von|der) )*(?:[A-Z][''’])?[A-Z][A-Za-zÀ-ÖØ-öø-ÿ]+(?:[''’-][A-Z]?[A-Za-zÀ-ÖØ-öø-ÿ]+)*', '<NAME>', 'g') ELSE r END AS text FROM b LEFT JOIN p ON b.l = p.l"""
)
def pii_names_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Structured kinds, then person names by listed given names, on the rows routed to that stage."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return pii.redact(docs, lang_col="lang", names=pii.name_patterns(table(spark, d, "given_names"))).select("doc_id", "text")


# --- near-duplicates ----------------------------------------------------------------------

_BANDS = """
WITH RECURSIVE s AS (SELECT doc_id, signature, unnest(range(32)) AS band_id FROM minhash_docs),
bands AS (SELECT doc_id, band_id::INTEGER AS band_id, sha1(array_to_string(list_transform(signature[band_id * 4 + 1 : band_id * 4 + 4],
  lambda x: CAST(CASE WHEN x < 0 THEN x::HUGEINT + 18446744073709551616 ELSE x::HUGEINT END AS VARCHAR)), ',')) AS band_hash FROM s)
"""
_EDGES = _BANDS + """, heads AS (SELECT band_id, band_hash, min(doc_id) AS head FROM bands GROUP BY ALL),
links AS (SELECT DISTINCT head AS u, doc_id AS v FROM bands JOIN heads USING (band_id, band_hash) WHERE head <> doc_id)
"""
_CLUSTERS = _EDGES + """, both_ways AS (SELECT u AS a, v AS b FROM links UNION SELECT v, u FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM (SELECT DISTINCT doc_id FROM minhash_docs) UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
g AS (SELECT a AS doc_id, min(b) AS component FROM reach GROUP BY a)
"""


def _signed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "minhash_docs").select("doc_id", "ts", "length", "signature")


@query(_BANDS + "SELECT doc_id, band_id, band_hash FROM bands")
def lsh_band_rows(spark: SparkSession, d: str) -> DataFrame:
    return dedup.band_rows(_signed(spark, d))


@query(_EDGES + "SELECT u, v FROM links")
def lsh_edges(spark: SparkSession, d: str) -> DataFrame:
    return dedup.edges(dedup.band_rows(_signed(spark, d)))


@query(_EDGES + "SELECT u, v FROM links ORDER BY u, v LIMIT 50")
def lsh_edge_sample(spark: SparkSession, d: str) -> DataFrame:
    """Top-k is the feature here: the first 50 edges as a report."""
    return lsh_edges(spark, d).orderBy("u", "v").limit(50)


@query(_BANDS + ", n AS (SELECT count(DISTINCT doc_id) AS n FROM bands GROUP BY band_id, band_hash HAVING count(DISTINCT doc_id) > 1) SELECT count(*) AS buckets, coalesce(sum(n * (n - 1) // 2), 0)::BIGINT AS pairs FROM n")
def lsh_bucket_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.bucket_pairs(dedup.band_rows(_signed(spark, d)))


@query(_CLUSTERS + "SELECT doc_id, component FROM g")
def cluster_labels(spark: SparkSession, d: str) -> DataFrame:
    return dedup.Clustering(_signed(spark, d)).members.select("doc_id", "component").distinct()


@query(_CLUSTERS + ", m AS (SELECT g.component, x.doc_id, row_number() OVER (PARTITION BY g.component ORDER BY coalesce(ts, 0) DESC, coalesce(length, 0) DESC, x.doc_id DESC) AS r FROM minhash_docs x JOIN g USING (doc_id)) SELECT component, doc_id FROM m WHERE r = 1")
def cluster_canonical(spark: SparkSession, d: str) -> DataFrame:
    return dedup.Clustering(_signed(spark, d)).kept


@query(_CLUSTERS + ", m AS (SELECT g.component, x.doc_id, row_number() OVER (PARTITION BY g.component ORDER BY coalesce(ts, 0) DESC, coalesce(length, 0) DESC, x.doc_id DESC) AS r FROM minhash_docs x JOIN g USING (doc_id)) SELECT doc_id, coalesce(ts, 0) AS ts, coalesce(length, 0) AS length FROM minhash_docs WHERE doc_id IN (SELECT doc_id FROM m WHERE r = 1)")
def cluster_kept(spark: SparkSession, d: str) -> DataFrame:
    return dedup.Clustering(_signed(spark, d)).result.select("doc_id", F.coalesce("ts", F.lit(0).cast("long")).alias("ts"), F.coalesce("length", F.lit(0)).alias("length"))


@query(_CLUSTERS + "SELECT count(DISTINCT doc_id) AS total_docs, count(DISTINCT component) AS kept, count(DISTINCT doc_id) - count(DISTINCT component) AS removed, round((count(DISTINCT doc_id) - count(DISTINCT component)) / count(DISTINCT doc_id)::DOUBLE, 9) AS dedup_rate, (SELECT coalesce(sum(n * (n - 1) // 2), 0)::BIGINT FROM (SELECT count(DISTINCT doc_id) AS n FROM bands GROUP BY band_id, band_hash)) AS total_candidate_pairs, (SELECT count(*) FROM links) AS links FROM g")
def cluster_stats(spark: SparkSession, d: str) -> DataFrame:
    return dedup.Clustering(_signed(spark, d)).stats.withColumn("dedup_rate", F.round("dedup_rate", 9))


@query("WITH RECURSIVE e AS (SELECT u AS a, v AS b FROM dup_edges WHERE u IS NOT NULL AND v IS NOT NULL UNION SELECT v, u FROM dup_edges WHERE u IS NOT NULL AND v IS NOT NULL), reach(a, b) AS (SELECT a, a FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a) SELECT a AS node, min(b) AS component FROM reach GROUP BY a")
def edge_components(spark: SparkSession, d: str) -> DataFrame:
    return components(table(spark, d, "dup_edges"))


@query()
def minhash_signatures(spark: SparkSession, d: str) -> DataFrame:
    return minhash.with_signatures(_documents(spark, d)).select("doc_id", "signature", "length")


@query(f"WITH f AS (SELECT doc_id, {_sql_strip(rf"regexp_replace(lower(coalesce(text, '')), '[{_C}]+', ' ', 'g')")} AS t FROM documents), h AS (SELECT sha1(t) AS h, doc_id FROM f) SELECT min(doc_id) AS first_id, count(*) AS copies FROM h GROUP BY h HAVING count(*) > 1")
def exact_copies(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose folded text is the same."""
    same = _documents(spark, d).select("doc_id", F.sha1(fold(F.col("text"))).alias("h"))
    return same.groupBy("h").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("h")


@query("SELECT doc_id, CAST(CASE WHEN signature[1] < 0 THEN signature[1]::HUGEINT + 18446744073709551616 ELSE signature[1]::HUGEINT END AS VARCHAR) AS first_value FROM minhash_docs")
def unsigned_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "minhash_docs").select("doc_id", unsigned_text(F.col("signature")[0]).alias("first_value"))


# --- tokens -------------------------------------------------------------------------------


@query(f"SELECT doc_id, {_sql_strip(r"regexp_replace(substring(text, 1, 5000), '\n', ' ', 'g')")} AS line FROM documents WHERE text IS NOT NULL AND {_sql_strip('text')} <> '' AND {_sql_strip(r"regexp_replace(substring(text, 1, 5000), '\n', ' ', 'g')")} <> ''")
def corpus_lines(spark: SparkSession, d: str) -> DataFrame:
    """Training lines of at most 5,000 characters: the cut is the feature, it is the trainer's input format."""
    return tokenize.corpus_lines(_documents(spark, d), keep=["doc_id"])


@query("SELECT doc_id, coalesce(strlen(text), 0)::INTEGER AS length FROM documents")
def byte_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.tokenised(_documents(spark, d), tokenize.byte_encoder()).select("doc_id", "length")


@query()
def sentencepiece_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.tokenised(_documents(spark, d), tokenize.sentencepiece_encoder(SENTENCEPIECE)).select("doc_id", "length")


@query()
def token_length_comparison(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.compare_lengths(_documents(spark, d), tokenize.sentencepiece_encoder(SENTENCEPIECE), tokenize.bpe_encoder(BPE_RANKS))


@query()
def vocabulary_head(spark: SparkSession, d: str) -> DataFrame:
    """The first 500 pieces of a vocabulary: a report."""
    return tokenize.vocabulary(spark, SENTENCEPIECE)


_STREAM = """
WITH s AS (SELECT row_number() OVER (ORDER BY sample_id, doc_id NULLS FIRST) AS rn, CASE WHEN input_ids[-1] <> 2 THEN list_append(input_ids, 2) ELSE input_ids END AS ids FROM token_samples WHERE len(input_ids) > 0),
p AS (SELECT rn, ids, sum(len(ids)) OVER (ORDER BY rn) - len(ids) AS st FROM s),
u AS (SELECT rn, st + unnest(range(len(ids))) AS pos, unnest(ids) AS tok FROM p),
chunks AS (SELECT pos // 4096 AS chunk_id, count(*) AS n, sum(tok) AS token_sum, sum(tok * (pos % 4096)) AS weighted_sum, count(DISTINCT rn) AS parts FROM u GROUP BY ALL HAVING count(*) = 4096)
"""


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return pack.pack(table(spark, d, "token_samples"), ["sample_id", "doc_id"])


@query(_STREAM + "SELECT chunk_id::BIGINT AS chunk_id, n::INTEGER AS n, token_sum::BIGINT AS token_sum, weighted_sum::BIGINT AS weighted_sum, parts::INTEGER AS parts FROM chunks")
def packed_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Checksums over the packed tokens and their places."""
    ids = F.transform("input_ids", lambda x: x.cast("long"))
    zero = F.lit(0).cast("long")
    return _chunks(spark, d).select(
        "chunk_id", F.size("input_ids").alias("n"), F.aggregate(ids, zero, lambda a, x: a + x).alias("token_sum"),
        F.aggregate(F.transform(ids, lambda x, i: x * i), zero, lambda a, x: a + x).alias("weighted_sum"), F.size("seq_lens").alias("parts"),
    )


@query(_STREAM + ", r AS (SELECT pos // 4096 AS chunk_id, rn, count(*) AS run_len, min(pos % 4096) AS run_start FROM u WHERE pos // 4096 IN (SELECT chunk_id FROM chunks) GROUP BY ALL) SELECT chunk_id::BIGINT AS chunk_id, (row_number() OVER (PARTITION BY chunk_id ORDER BY run_start) - 1)::INTEGER AS seq_no, run_len::INTEGER AS run_len, run_start::INTEGER AS run_start FROM r")
def packed_runs(spark: SparkSession, d: str) -> DataFrame:
    """Lengths and offsets of the samples in each chunk."""
    runs = F.arrays_zip(F.col("seq_lens").alias("l"), F.slice("offsets", 1, F.size("seq_lens")).alias("o"))
    return _chunks(spark, d).select("chunk_id", F.posexplode(runs).alias("seq_no", "r")).select("chunk_id", "seq_no", F.col("r")["l"].alias("run_len"), F.col("r")["o"].alias("run_start"))


@query(_STREAM + "SELECT count(DISTINCT pos // 4096) AS chunks, count(*) AS tokens, max(tok)::INTEGER AS largest_id FROM u WHERE pos // 4096 IN (SELECT chunk_id FROM chunks)")
def export_stats(spark: SparkSession, d: str) -> DataFrame:
    return token_stats(_chunks(spark, d))


# --- relational primitives ----------------------------------------------------------------


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 4) AS qty, round(avg(l_discount), 9) AS avg_disc, max(l_extendedprice) AS top_price FROM lineitem GROUP BY l_returnflag, l_linestatus")
def hash_aggregate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("qty"), F.round(F.avg("l_discount"), 9).alias("avg_disc"), F.max("l_extendedprice").alias("top_price"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)")
def semi_join(spark: SparkSession, d: str) -> DataFrame:
    big = table(spark, d, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").join(big, "o_orderkey", "left_semi").select("o_orderkey", "o_orderstatus")


@query("SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def equi_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))


@query("SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").distinct()


@query("SELECT o_custkey, max(struct_pack(p := o_totalprice, k := o_orderkey)).k AS best_order FROM orders GROUP BY o_custkey")
def arg_max(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("best_order"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def count_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def top_k(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("SELECT name, nation FROM (SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier)")
def union_all(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    return c.unionByName(table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
