"""Tokenizers: corpus lines, SentencePiece training and encoding, and a byte-level fallback."""

from __future__ import annotations

import base64
import io
import os
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.dist import spread
from quern.functions.text import strip

# The training defaults.
VOCAB_SIZE, MAX_CHARS, COVERAGE, MAX_SENTENCES, MAX_SHARDS = 32_000, 5_000, 0.9995, 5_000_000, 256
BYTE_EOS = 256


def corpus_lines(df: DataFrame, text_col: str = "text", max_chars: int = MAX_CHARS, limit: int = 0, keep: list[str] | None = None) -> DataFrame:
    """(*keep, line): texts that are not blank, cut to ``max_chars``, one a line; all rows, none lost to even shards."""
    text = F.col(text_col)
    full = df.where(text.isNotNull() & (strip(text) != ""))
    if limit:
        full = full.limit(limit)
    line = strip(F.regexp_replace(F.substring(text, 1, max_chars), "\n", " "))
    return full.select(*(keep or []), line.alias("line")).where("line <> ''")


def write_shards(lines: DataFrame, path: str, shards: int = MAX_SHARDS) -> None:
    """Text shards, one document a line."""
    lines.select("line").repartition(max(1, shards)).write.mode("overwrite").text(path)


def train_sentencepiece(
    lines: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    model_type: str = "bpe",
    character_coverage: float = COVERAGE,
    input_sentence_size: int = MAX_SENTENCES,
    num_threads: int = 16,
) -> bytes:
    """A model from the lines; with ``input_sentence_size`` at most so many are used (0: all).

    The trainer runs in one process, so the lines stream through the driver one
    partition at a time and the sample size bounds its memory.
    """
    import sentencepiece

    if input_sentence_size:
        n = lines.count()
        if n > input_sentence_size:
            lines = lines.sample(input_sentence_size / n, seed=42).limit(input_sentence_size)
    out = io.BytesIO()
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=(r["line"] for r in lines.toLocalIterator()), model_writer=out, vocab_size=vocab_size, model_type=model_type, character_coverage=character_coverage,
        byte_fallback=True, split_by_unicode_script=True, split_by_whitespace=True, split_by_number=True, remove_extra_whitespaces=True, normalization_rule_name="nmt_nfkc",
        num_threads=num_threads, unk_id=0, bos_id=1, eos_id=2, pad_id=3, minloglevel=2, hard_vocab_limit=False,
    )
    return out.getvalue()


def load_sentencepiece(model: str | bytes):
    import sentencepiece

    if isinstance(model, bytes):
        return sentencepiece.SentencePieceProcessor(model_proto=model)
    if not os.path.exists(model):
        raise FileNotFoundError(model)
    return sentencepiece.SentencePieceProcessor(model_file=model)


def eos_of(processor) -> int:
    """The end mark's id, by the model or by one of its usual spellings."""
    if processor.eos_id() >= 0:
        return processor.eos_id()
    for piece in ("</s>", "<eos>", "<EOS>"):  # fixed values
        i = processor.piece_to_id(piece)
        if i >= 0 and i != processor.unk_id():
            return i
    raise ValueError("the model has no end mark")


def sentencepiece_encoder(model: str | bytes):
    """A UDF from texts to token ids; null and empty texts give []. A path is read on the executors."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sp = load_sentencepiece(model)
        for texts in batches:
            yield pd.Series(sp.encode([t or "" for t in texts], num_threads=1))

    return encode


#: Pre-tokens of byte-level BPE as published with such vocabularies (fixed value).
BPE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def bpe_encoder(path: str, pattern: str = BPE_PATTERN):
    """Byte-level BPE from a file of base64 tokens and ranks, read on the executors."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        coder = tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pd.Series([coder.encode_ordinary(t or "") for t in texts])

    return encode


def byte_encoder():
    """UTF-8 bytes as ids 0-255, for use without any model; the end mark is 256."""

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer((t or "").encode(), np.uint8).astype(np.int32) for t in texts])

    return encode


def tokenised(df: DataFrame, encoder, text_col: str = "text") -> DataFrame:
    """Add ``input_ids`` and ``length``, the number of tokens."""
    out = spread(df).withColumn("input_ids", encoder(F.col(text_col)))
    return out.withColumn("length", F.size("input_ids"))


def vocabulary(spark: SparkSession, model: str | bytes, most: int = 500) -> DataFrame:
    """(id, piece): the first pieces of a model."""
    sp = load_sentencepiece(model)
    return spark.createDataFrame([(i, sp.id_to_piece(i)) for i in range(min(most, sp.vocab_size()))], "id int, piece string")


def compare_lengths(df: DataFrame, first, second, text_col: str = "text") -> DataFrame:
    """One row: tokens of two encoders over all texts, their ratio and the share saved by the first."""
    n = df.select(F.size(first(F.col(text_col))).alias("a"), F.size(second(F.col(text_col))).alias("b"))
    sums = n.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("first_tokens"), F.coalesce(F.sum("b"), F.lit(0)).alias("second_tokens"))
    ratio: Column = F.when(F.col("second_tokens") > 0, F.col("first_tokens") / F.col("second_tokens")).otherwise(F.lit(0.0))
    return sums.withColumn("ratio", ratio).withColumn("saving", 1 - F.col("ratio"))


@dataclass
class Throughput:
    rows: int
    tokens: int
    seconds: float

    @property
    def tokens_per_second(self) -> float:
        return self.tokens / self.seconds if self.seconds else 0.0


def benchmark(df: DataFrame, encoder, path: str, text_col: str = "text", keep_text: bool = False, compression: str = "zstd") -> Throughput:
    """Tokenise into a Parquet table; rows, tokens and seconds of that pass, the ids being kept."""
    began = time.time()
    tokens = df.select(*(df.columns if keep_text else []), encoder(F.col(text_col)).alias("input_ids")).withColumn("num_tokens", F.size("input_ids"))
    tokens.write.mode("overwrite").option("compression", compression).parquet(path)
    seconds = time.time() - began
    r = df.sparkSession.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("num_tokens"), F.lit(0)).alias("tokens")).first()
    return Throughput(r["rows"], r["tokens"], seconds)
