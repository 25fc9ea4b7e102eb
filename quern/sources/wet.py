"""Reader for web-archive text files (``*.wet.gz``)."""

from __future__ import annotations

import gzip
import io
import logging
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.dist import once
from quern.functions.text import document_id, normalise

log = logging.getLogger("quern")

_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:/")
SCHEMA = "doc_id string, url string, warc_date string, source_path string, text string"


@dataclass(frozen=True)
class IngestRules:
    warc_type: str = "conversion"
    min_chars: int = 200
    max_chars: int = 200_000
    max_docs_per_file: int = 0


def _exists(spark: SparkSession, directory: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def discover(directory: str, pattern: str = "*.wet.gz", max_files: int = 0, spark: SparkSession | None = None) -> list[str]:
    """Sorted paths below a directory whose file name matches and does not start with a dot; [] if there is none.

    A directory with a scheme (``hdfs://``, ``s3a://``) is listed by Spark.
    """
    if _SCHEME.match(directory):
        if not _exists(spark, directory):
            return []
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(directory)
        found = sorted(r["path"] for r in files.select("path").toLocalIterator() if not r["path"].rsplit("/", 1)[-1].startswith("."))
        return found[:max_files] if max_files else found
    found = sorted(os.path.join(root, f) for root, _, files in os.walk(directory) for f in files if not f.startswith(".") and fnmatch(f, pattern))
    return found[:max_files] if max_files else found


def records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, body) of each record of an uncompressed stream.

    Stray lines between records are skipped; a stream that ends inside a record
    gives what there is of its body.
    """
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, colon, value = line.decode("utf-8", "replace").partition(":")
            if colon:
                headers[name.strip().lower()] = value.strip()
        length = headers.get("content-length", "0")
        yield headers, stream.read(int(length) if length.isdigit() else 0)


def read_wet(spark: SparkSession, paths: list[str], rules: IngestRules | None = None) -> DataFrame:
    """(doc_id, url, warc_date, source_path, text): the text records of the files.

    One task reads one file as a stream, since gzip can't be split. Records of
    other types and empty ones are skipped, bytes that are no UTF-8 replaced,
    texts normalised, those below ``min_chars`` dropped and longer ones cut to
    ``max_chars``. A damaged file gives the records before the damage. The cap
    counts records that are given out, which is why short ones are dropped in
    the reader. Paths with a scheme are fetched by Spark, one file a row.
    """
    r = rules or IngestRules()
    schema = "url string, warc_date string, record_id string, source_path string, text string"
    outer = re.compile(r"\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\Z")

    def long_enough(text: str) -> bool:
        tidy = re.sub("\n{3,}", "\n\n", outer.sub("", text.replace("\r\n", "\n").replace("\r", "\n")))
        return len(tidy) >= r.min_chars

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                out, n, size = [], 0, 0
                with gzip.open(path if content is None else io.BytesIO(content)) as stream:
                    try:
                        for headers, body in records(stream):
                            if headers.get("warc-type", "").lower() != r.warc_type or not body:
                                continue
                            text = body.decode("utf-8", "replace")
                            if not long_enough(text):
                                continue
                            out.append((headers.get("warc-target-uri", ""), headers.get("warc-date", ""), headers.get("warc-record-id", ""), path, text))
                            n, size = n + 1, size + len(text)
                            if size > 4_000_000:
                                yield pd.DataFrame(out, columns=["url", "warc_date", "record_id", "source_path", "text"])
                                out, size = [], 0
                            if r.max_docs_per_file and n >= r.max_docs_per_file:
                                break
                    except (EOFError, gzip.BadGzipFile, zlib.error) as e:
                        # what was read stays; a failing disk or network is an error, and the task runs again
                        log.warning("%s is damaged after %d records: %s", path, n, e)
                yield pd.DataFrame(out, columns=["url", "warc_date", "record_id", "source_path", "text"])

    if any(_SCHEME.match(p) for p in paths):
        files = spark.read.format("binaryFile").load(paths).select("path", "content")
    else:
        files = spark.createDataFrame([(p, None) for p in paths], "path string, content binary")
    return as_documents(files.repartition(max(1, len(paths))).mapInPandas(scan, schema), r)


def as_documents(records: DataFrame, rules: IngestRules, keep: list[str] | None = None) -> DataFrame:
    """(*keep, doc_id, url, warc_date, source_path, text) of (url, warc_date, record_id, source_path, text).

    Texts are normalised, those below ``min_chars`` dropped and longer ones cut to ``max_chars``.
    """
    tidy = once(records, text=normalise(F.col("text"))).where(F.length("text") >= rules.min_chars)
    own = document_id(F.col("source_path"), F.col("url"), F.col("warc_date"), F.col("record_id"))
    return tidy.select(*(keep or []), own.alias("doc_id"), "url", "warc_date", "source_path", F.substring("text", 1, rules.max_chars).alias("text"))


def write_pages(pages: DataFrame, path: str) -> None:
    """(url, warc_date, text) as web-archive files in a folder of any file system, a part of the rows in each file."""
    one_line = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "[\r\n]+", " ")
    body = F.coalesce(F.col("text"), F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: conversion\r\nWARC-Target-URI: "), one_line("url"), F.lit("\r\nWARC-Date: "), one_line("warc_date"), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    pages.select(F.concat(head, body, F.lit("\r\n\r\n")).alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def write_wet(rows: list[tuple[str, str, str, str]], path: str) -> None:
    """A small file from (type, url, date, text) rows, for tests and fixtures."""
    with gzip.open(path, "wb") as out:
        for i, (kind, url, date, text) in enumerate(rows):
            body = text.encode() if isinstance(text, str) else text
            head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nWARC-Date: {date}\r\nWARC-Record-ID: <urn:{i}>\r\nContent-Length: {len(body)}\r\n\r\n"
            out.write(head.encode() + body + b"\r\n\r\n")
