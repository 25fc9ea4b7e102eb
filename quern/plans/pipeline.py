"""The pipeline: named steps from Parquet to Parquet, run in order, resumable, with statistics."""

from __future__ import annotations

import argparse
import logging
import os
import time
from collections.abc import Callable
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quern.functions.dist import cut, discard
from quern.operators import clean, dedup, minhash, pack, pii, quality, tokenize
from quern.sources import tables, wet

log = logging.getLogger("quern")
_LOG_FORMAT = "%(asctime)s %(name)s %(levelname)s %(message)s"

STEPS = ("ingest", "clean", "quality", "pii", "minhash", "clustering", "train_tokenizer", "tokenize", "export")
#: Directories whose names do not follow ``<step>_parquet`` (fixed values).
DIRECTORIES = {"clean": "cleaned_parquet", "clustering": "deduped_parquet", "tokenize": "token_packing_parquet", "train_tokenizer": "tokenizers", "export": "final.bin"}
BEFORE = {"clean": "ingest", "quality": "clean", "pii": "quality", "minhash": "pii", "clustering": "minhash", "train_tokenizer": "clustering", "tokenize": "clustering", "export": "tokenize"}


@dataclass
class PipelineConfig:
    output_base: str = "outputs/dev"
    data_dir: str = "./data/commoncrawl/"
    pattern: str = "*.wet.gz"
    max_files: int = 0
    limit: int = 0
    input: str | None = None
    # ingest and clean
    min_text_chars: int = 200
    max_text_chars: int = 200_000
    max_docs_per_file: int = 0
    min_chars: int = 200
    max_chars: int = 200_000
    min_non_ws_ratio: float = 0.7
    min_alpha_cjk_ratio: float = 0.4
    max_punct_ratio: float = 0.25
    max_dup_line_ratio: float = 0.35
    # quality
    langs: str = "zh,en"
    threshold: float = 0.4
    lang_samples: str | None = None
    language_model: quality.LanguageModel | None = field(default=None, repr=False)
    # personal data
    text_col: str = "text"
    lang_col: str = ""
    keep_stats: bool = False
    enable_ner: bool = False
    supported_langs: str = "en,zh"
    given_names: str | None = None
    name_stage: Callable | None = field(default=None, repr=False)
    # clustering
    rows_per_band: int = 4
    # tokenizer, packing, export
    vocab_size: int = 32_000
    model_type: str = "bpe"
    character_coverage: float = 0.9995
    input_sentence_size: int = 5_000_000
    num_shards: int = 256
    train_max_chars: int = 5_000
    spm_model: str | None = None
    seq_len: int = 4096
    shard_chunks: int = 2048
    add_eos: bool = True
    ensure_eos: bool = True
    drop_remainder: bool = True
    emit_seq_id: bool = False
    emit_seq_lens_offsets: bool = False
    compression: str = "zstd"
    dtype: str = "uint16"
    force_dtype: bool = False
    output_file: str | None = None

    @classmethod
    def from_args(cls, args: argparse.Namespace) -> PipelineConfig:
        own = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in vars(args).items() if k in own and v is not None})

    def path(self, step: str) -> str:
        return os.path.join(self.output_base, DIRECTORIES.get(step, f"{step}_parquet"))

    def source(self, step: str) -> str:
        return self.input or self.path(BEFORE[step])


def _run(step: str, config: PipelineConfig, spark: SparkSession, work: Callable[[DataFrame], DataFrame]) -> dict:
    """Read, transform, write; rows are counted on the way, not by running the plan again."""
    seen, made = Observation(f"{step}_in"), Observation(f"{step}_out")
    count = F.count(F.lit(1)).alias("rows")
    df = tables.read_parquet(spark, config.source(step), config.limit).observe(seen, count)
    files, size = tables.write_parquet(work(df).observe(made, count), config.path(step))
    return {"rows_in": seen.get["rows"], "rows_out": made.get["rows"], "files": files, "bytes": size, "output": config.path(step)}


def ingest(config: PipelineConfig, spark: SparkSession) -> dict:
    paths = wet.discover(config.data_dir, config.pattern.rsplit("/", 1)[-1], config.max_files, spark)
    if not paths:
        log.warning("no files match %s below %s", config.pattern, config.data_dir)
    rules = wet.IngestRules(min_chars=config.min_text_chars, max_chars=config.max_text_chars, max_docs_per_file=config.max_docs_per_file)
    df = wet.read_wet(spark, paths, rules) if paths else spark.createDataFrame([], wet.SCHEMA)
    if config.limit:
        df = df.limit(config.limit)
    made = Observation("ingest_out")
    files, size = tables.write_parquet(df.observe(made, F.count(F.lit(1)).alias("rows")), config.path("ingest"))
    return {"files_in": len(paths), "rows_out": made.get["rows"], "files": files, "bytes": size, "output": config.path("ingest")}


def run_clean(config: PipelineConfig, spark: SparkSession) -> dict:
    rules = clean.CleanRules(**{f.name: getattr(config, f.name) for f in fields(clean.CleanRules)})
    seen = Observation("clean")
    df = tables.read_parquet(spark, config.source("clean"), config.limit)
    scored = clean.score_clean(df, rules, config.text_col).observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.col("kept").cast("long")).alias("kept"))
    dropped = os.path.join(config.output_base, "dropped_parquet")
    tables.write_split(scored, config.path("clean"), dropped)
    rows, kept = seen.get["rows"], seen.get["kept"] or 0
    return {"rows_in": rows, "rows_out": kept, "rows_dropped": rows - kept, "output": config.path("clean"), "dropped": dropped}


def run_quality(config: PipelineConfig, spark: SparkSession) -> dict:
    model = config.language_model
    if model is None:
        if not config.lang_samples:
            raise RuntimeError("quality needs a language model or --lang-samples, a Parquet table of labelled texts")
        model = quality.TrigramModel.train(tables.read_parquet(spark, config.lang_samples))
    keep = quality.LanguageFilter(model, tuple(x for x in config.langs.split(",") if x), config.threshold)
    return _run("quality", config, spark, lambda df: keep.apply(df, config.text_col).where("quality_keep"))


def run_pii(config: PipelineConfig, spark: SparkSession) -> dict:
    names = config.name_stage if config.enable_ner else None
    if config.enable_ner and names is None and config.given_names:
        names = pii.name_patterns(tables.read_parquet(spark, config.given_names))
    if config.enable_ner and names is None:
        log.warning("neither a name stage nor --given-names, a Parquet table of given names: person names pass through")
    langs = tuple(config.supported_langs.split(","))
    return _run("pii", config, spark, lambda df: pii.redact(df, config.text_col, config.lang_col or None, config.keep_stats, names=names, name_langs=langs))


def run_minhash(config: PipelineConfig, spark: SparkSession) -> dict:
    return _run("minhash", config, spark, lambda df: minhash.with_signatures(df, config.text_col))


def run_clustering(config: PipelineConfig, spark: SparkSession) -> dict:
    facts: dict = {}

    def work(df: DataFrame) -> DataFrame:
        c = dedup.Clustering(df, config.rows_per_band)
        facts.update(c.stats.first().asDict(), edge_sample=[tuple(r) for r in c.sample.collect()])
        facts["_check"] = c.check
        return c.result

    out = _run("clustering", config, spark, work)
    facts.pop("_check")(out["rows_out"])
    return out | facts


def run_train_tokenizer(config: PipelineConfig, spark: SparkSession) -> dict:
    df = tables.read_parquet(spark, config.source("train_tokenizer"))
    lines = tokenize.corpus_lines(df, config.text_col, config.train_max_chars, config.limit)
    work = os.path.join(config.path("train_tokenizer"), "working", "corpus_txt")
    tokenize.write_shards(lines, work, config.num_shards)
    sample = spark.read.text(work).withColumnRenamed("value", "line")
    model = tokenize.train_sentencepiece(sample, config.vocab_size, config.model_type, config.character_coverage, config.input_sentence_size)
    target = config.spm_model or os.path.join(config.path("train_tokenizer"), "my_spm.model")
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    with open(target, "wb") as f:
        f.write(model)
    return {"model": target, "bytes": len(model)}


def run_tokenize(config: PipelineConfig, spark: SparkSession) -> dict:
    with open(config.spm_model or os.path.join(config.path("train_tokenizer"), "my_spm.model"), "rb") as f:
        model = f.read()
    eos = tokenize.eos_of(tokenize.load_sentencepiece(model))
    df = tables.in_file_order(tables.read_parquet(spark, config.source("tokenize")), [config.text_col])
    # written once: ranging the samples by their place reads them twice
    tokens = cut(tokenize.tokenised(df, tokenize.sentencepiece_encoder(model), config.text_col).select("_file", "_row", "input_ids"))
    shards = None
    if not config.limit:
        total = tokens.agg(F.sum(F.size(pack.with_eos(F.col("input_ids"), eos, config.add_eos, config.ensure_eos)))).first()[0] or 0
        shards = max(1, -(-(total // config.seq_len + (not config.drop_remainder)) // config.shard_chunks))
    chunks = pack.pack(tokens, ["_file", "_row"], seq_len=config.seq_len, eos_id=eos, add_eos=config.add_eos, ensure_eos=config.ensure_eos, drop_remainder=config.drop_remainder, limit=config.limit)
    drop = ([] if config.emit_seq_id else ["seq_id"]) + ([] if config.emit_seq_lens_offsets else ["seq_lens", "offsets"])
    tables.write_chunks(chunks.drop(*drop), config.path("tokenize"), config.seq_len, config.shard_chunks, config.compression, shards)
    discard(tokens)
    n = spark.read.parquet(config.path("tokenize")).count()
    meta = {"seq_len": config.seq_len, "chunks": n, "eos_id": eos, "dtype": "int32", "drop_remainder": config.drop_remainder, "status": "ok" if n else "empty"}
    tables.update_json(os.path.join(config.output_base, "packing_meta.json"), meta)
    return meta | {"output": config.path("tokenize")}


def run_export(config: PipelineConfig, spark: SparkSession) -> dict:
    chunks = tables.read_parquet(spark, config.source("export"), columns=["chunk_id", "input_ids"])
    target = config.output_file or config.path("export")
    return tables.write_binary(chunks, target, config.dtype, config.force_dtype, config.shard_chunks, config.limit) | {"output": target}


RUNNERS: dict[str, Callable[[PipelineConfig, SparkSession], dict]] = {
    "ingest": ingest, "clean": run_clean, "quality": run_quality, "pii": run_pii, "minhash": run_minhash, "clustering": run_clustering,
    "train_tokenizer": run_train_tokenizer, "tokenize": run_tokenize, "export": run_export,
}


def plan_steps(steps: str, resume_from: str | None = None) -> list[str]:
    """The steps to run in the order given; resuming takes the tail of these, else of all steps."""
    wanted = list(STEPS) if steps == "all" else [s.strip() for s in steps.split(",") if s.strip()]
    unknown = [s for s in wanted if s not in RUNNERS]
    if unknown:
        raise ValueError(f"unknown steps: {', '.join(unknown)}")
    if not resume_from:
        return wanted
    for whole in (wanted, list(STEPS)):
        if resume_from in whole:
            return whole[whole.index(resume_from) :]
    raise ValueError(f"unknown step to resume from: {resume_from}")


def run(config: PipelineConfig, spark: SparkSession, steps: str = "all", resume_from: str | None = None) -> dict:
    """Run steps; statistics are merged into ``pipeline_stats.json`` after each. A failing step stops the run."""
    stats = {}
    for step in plan_steps(steps, resume_from):
        began = time.time()
        log.info("%s begins", step)
        try:
            stats[step] = RUNNERS[step](config, spark)
        except FileNotFoundError:
            raise
        except Exception as e:
            raise RuntimeError(f"{step} failed: {e}") from e
        stats[step]["seconds"] = round(time.time() - began, 3)
        tables.update_json(os.path.join(config.output_base, "pipeline_stats.json"), {step: stats[step]})
    return stats


def compare_tokenizers(spark: SparkSession, input_dir: str, output_dir: str, spm_model: str | None = None, bpe: str | None = None, shards: int = 0, text_col: str = "text", keep_text: bool = False, compression: str = "zstd") -> dict:
    """Tokenise a corpus with each tokenizer given, write contiguous shards in file order and ``metrics.json``."""
    encoders = {"sentencepiece": spm_model and tokenize.sentencepiece_encoder(spm_model), "bpe": bpe and tokenize.bpe_encoder(bpe)}
    if not any(encoders.values()):
        raise ValueError("name a SentencePiece model, a file of BPE ranks, or both")
    files, size = tables.directory_stats(input_dir)
    metrics: dict = {"input_dir": input_dir, "num_input_files": files, "input_bytes": size, "compression": compression, "tokenizers": {}}
    for name, encoder in encoders.items():
        if not encoder:
            continue
        df = tables.in_file_order(tables.read_parquet(spark, input_dir), [text_col])
        staging, target = f"{output_dir}/{name}_staging", f"{output_dir}/{name}"
        df = df.withColumn("_text", F.col(text_col))
        ran = tokenize.benchmark(df.select("_file", "_row", text_col), encoder, staging, text_col, True, compression)
        began = time.time()
        tokens = spark.read.parquet(staging)
        tables.reshard(tokens if keep_text else tokens.drop(text_col), target, ["_file", "_row"], shards or max(1, files), compression)
        tables.remove(spark, staging)
        count, written = tables.directory_stats(target)
        metrics["tokenizers"][name] = {"model": spm_model if name == "sentencepiece" else bpe, "rows": ran.rows, "tokens": ran.tokens, "time_sec": {"tokenize": ran.seconds, "write": time.time() - began}, "throughput_tok_per_sec": ran.tokens_per_second, "num_shards": count, "bytes_written": written}
    if len(metrics["tokenizers"]) == 2:
        a, b = (metrics["tokenizers"][x]["tokens"] for x in ("sentencepiece", "bpe"))
        metrics["ratio"], metrics["saving"] = (a / b, 1 - a / b) if b else (0.0, 0.0)
    return tables.update_json(os.path.join(output_dir, "metrics.json"), metrics)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("quern")
    p.add_argument("--steps", default="all", help=f"comma-separated, of: {', '.join(STEPS)}")
    p.add_argument("--resume-from", default=None)
    p.add_argument("--log-file", default=None, help="log to this file as well")
    p.add_argument("--compare", default=None, metavar="DIR", help="instead of steps: tokenise with --spm-model and --bpe-ranks, shards and metrics.json go to DIR")
    p.add_argument("--bpe-ranks", default=None, help="a file of byte-level BPE tokens and ranks")
    for f in fields(PipelineConfig):
        if f.name in ("language_model", "name_stage"):
            continue
        flag = "--" + f.name.replace("_", "-")
        if isinstance(f.default, bool):
            p.add_argument(flag, action=argparse.BooleanOptionalAction, default=f.default)
        else:
            p.add_argument(flag, default=f.default, type=type(f.default) if f.default is not None else str)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format=_LOG_FORMAT)
    if args.log_file:
        os.makedirs(os.path.dirname(args.log_file) or ".", exist_ok=True)
        to_file = logging.FileHandler(args.log_file, encoding="utf-8")
        to_file.setFormatter(logging.Formatter(_LOG_FORMAT))
        log.addHandler(to_file)
        log.setLevel(logging.INFO)
    spark = spark or SparkSession.builder.appName("quern").getOrCreate()
    try:
        config = PipelineConfig.from_args(args)
        if args.compare:
            compare_tokenizers(spark, config.source("tokenize"), args.compare, config.spm_model, args.bpe_ranks, config.num_shards, config.text_col, compression=config.compression)
        else:
            run(config, spark, args.steps, args.resume_from)
    except Exception as e:  # noqa: BLE001 - the exit code tells the caller
        log.error("%s", e)
        return 1
    return 0
