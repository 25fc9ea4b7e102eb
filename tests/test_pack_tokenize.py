import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import pack, tokenize
from quern.sources import tables


def stream(rows, eos, add=True, ensure=True):
    out = []
    for i, (_, ids) in enumerate(rows):
        ids = list(ids or [])
        if ids and add and (not ensure or ids[-1] != eos):
            ids.append(eos)
        out += [(i, t) for t in ids]
    return out


def runs_of(seq_ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(local ids, lengths, offsets) of a list of sample ids; for an empty one [], [], [0]."""
    local: list[int] = []
    lengths: list[int] = []
    for i, s in enumerate(seq_ids):
        if i and s == seq_ids[i - 1]:
            lengths[-1] += 1
        else:
            lengths.append(1)
        local.append(len(lengths) - 1)
    offsets = [0]
    for n in lengths:
        offsets.append(offsets[-1] + n)
    return local, lengths, offsets


@pytest.mark.parametrize(("drop", "ensure", "add"), [(True, True, True), (False, True, True), (False, False, True), (True, True, False)])
def test_pack_same_as_stream(spark, drop, ensure, add):
    rng = random.Random(4)
    rows = [(i, [rng.randrange(3, 9) for _ in range(rng.choice([0, 1, 3, 7, 8, 9, 40]))] + ([2] if rng.random() < 0.3 else [])) for i in range(150)] + [(200, None)]
    df = spark.createDataFrame(rows, "doc_id long, input_ids array<int>")
    got = sorted(pack.pack(df, ["doc_id"], seq_len=8, eos_id=2, add_eos=add, ensure_eos=ensure, drop_remainder=drop).collect())
    want = stream(rows, 2, add, ensure)
    n = len(want) // 8
    for c in range(n):
        part = want[c * 8 : c * 8 + 8]
        r = got[c]
        assert r.chunk_id == c and r.input_ids == [t for _, t in part]
        assert (r.seq_id, r.seq_lens, r.offsets) == runs_of([s for s, _ in part])
    rest = [t for _, t in want[n * 8 :]]
    if drop or not rest:
        assert len(got) == n
    else:
        assert len(got) == n + 1 and got[n].input_ids == rest + [2] * (8 - len(rest)) and got[n].seq_lens[-1] == 8 - len(rest)


def test_runs_and_empty(spark):
    assert runs_of([]) == ([], [], [0]) and runs_of([5, 5, 7]) == ([0, 0, 1], [2, 1], [0, 2, 3])
    df = spark.createDataFrame([("b", 1, [1, 2, 3]), ("a", 9, [4]), ("b", 0, []), ("a", 10, [5, 6])], "f string, n int, input_ids array<int>")
    assert [r.input_ids for r in pack.pack(df, ["f", "n"], seq_len=2, add_eos=False).orderBy("chunk_id").collect()] == [[4, 5], [6, 1], [2, 3]]
    assert [r.input_ids for r in pack.pack(df, ["f", "n"], seq_len=2, add_eos=False, limit=3).orderBy("chunk_id").collect()] == [[4, 5]]
    assert "NestedLoop" not in pack.pack(df, ["f", "n"])._jdf.queryExecution().toString()
    assert pack.pack(spark.createDataFrame([], "doc_id long, input_ids array<int>"), ["doc_id"]).count() == 0


def test_sinks(spark, tmp_path):
    rows = [(i, [i % 7, 40_000, 3, i]) for i in range(30)]
    chunks = spark.createDataFrame(rows, "chunk_id long, input_ids array<int>")
    for dtype, kind in (("uint16", "<u2"), ("int32", "<i4")):
        facts = tables.write_binary(chunks, str(tmp_path / dtype), dtype, per_part=7)
        assert facts["rows"] == 30 and facts["tokens"] == 120
        assert np.fromfile(tmp_path / dtype, kind).tolist() == [t for _, ids in rows for t in ids]
    big = chunks.withColumn("input_ids", F.array(F.lit(70_000)))
    with pytest.raises(ValueError):
        tables.write_binary(big, str(tmp_path / "x"))
    assert tables.write_binary(big, str(tmp_path / "x"), force=True)["tokens"] == 30
    facts = tables.write_binary(chunks, "file://" + str(tmp_path / "p"), per_part=2, single=False)
    assert len(facts["parts"]) == 15 and facts["tokens"] == 120 and json.load(open(tmp_path / "p.parts" / "manifest.json")) == facts
    joined = b"".join(open(tmp_path / "p.parts" / x["file"], "rb").read()[:-1] for x in facts["parts"])
    assert np.frombuffer(joined, "<u2").tolist() == [t for _, ids in rows for t in ids]
    assert tables.write_binary(chunks, str(tmp_path / "few"), per_part=7, limit_parts=2)["tokens"] == 56
    tables.write_chunks(chunks, str(tmp_path / "c"), 4, per_shard=8)
    back = spark.read.parquet(str(tmp_path / "c"))
    files = sorted(f for f in os.listdir(tmp_path / "c") if f.endswith(".parquet"))
    assert [[r.chunk_id for r in spark.read.parquet(str(tmp_path / "c" / f)).collect()] for f in files] == [list(range(i, min(i + 8, 30))) for i in range(0, 30, 8)]
    tables.write_chunks(chunks, str(tmp_path / "c2"), 4, per_shard=8, shards=4)
    assert spark.read.parquet(str(tmp_path / "c2")).count() == 30
    # rows come in the order of the files, and a limit takes the first
    placed = tables.in_file_order(spark.read.parquet(str(tmp_path / "c")), ["chunk_id"]).orderBy("_file", "_row")
    assert [r.chunk_id for r in placed.collect()] == list(range(30)) and sorted(r.chunk_id for r in tables.read_parquet(spark, str(tmp_path / "c"), limit=11).collect()) == list(range(11))
    assert sorted(map(tuple, back.select("chunk_id").collect())) == [(i,) for i in range(30)] and tables.directory_stats(str(tmp_path / "c"))[0] >= 4
    with pytest.raises(Exception, match="tokens long"):
        tables.write_chunks(chunks, str(tmp_path / "d"), 5)
    assert tables.directory_stats(str(tmp_path / "none")) == (0, 0)
    tables.reshard(chunks, str(tmp_path / "r"), "chunk_id", 3)
    assert spark.read.parquet(str(tmp_path / "r")).count() == 30
    with pytest.raises(FileNotFoundError):
        tables.read_parquet(spark, str(tmp_path / "none"))
    assert tables.update_json(str(tmp_path / "s.json"), {"a": 1}) | {} == {"a": 1} and tables.update_json(str(tmp_path / "s.json"), {"b": 2}) == {"a": 1, "b": 2}


def test_split_writer(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(20)], "id long, kept boolean")
    tables.write_split(df, str(tmp_path / "k"), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "k")).count() == 7 and spark.read.parquet(str(tmp_path / "d")).count() == 13
    tables.write_split(df.where("kept"), str(tmp_path / "k"), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "k")).count() == 7 and spark.read.parquet(str(tmp_path / "d")).count() == 0


def test_tokenizers(spark, tmp_path):
    df = spark.createDataFrame([(i, f"The mill number {i} is in the valley of the river {'x' * (i % 5)}\nand more") for i in range(200)] + [(900, None), (901, ""), (902, " \n ")], "doc_id long, text string")
    lines = tokenize.corpus_lines(df)
    assert lines.count() == 200 and not lines.where(F.col("line").contains("\n")).count()
    assert tokenize.corpus_lines(df, max_chars=3).first().line == "The"
    model = tokenize.train_sentencepiece(lines, vocab_size=400, num_threads=2)
    sp = tokenize.load_sentencepiece(model)
    assert tokenize.eos_of(sp) == 2
    got = {r.doc_id: r for r in tokenize.tokenised(df, tokenize.sentencepiece_encoder(model)).collect()}
    assert got[900].input_ids == got[901].input_ids == [] and got[5].length == len(got[5].input_ids) > 0
    assert got[5].input_ids == sp.encode(df.where("doc_id = 5").first().text)
    raw = {r.doc_id: r.input_ids for r in tokenize.tokenised(df, tokenize.byte_encoder()).collect()}
    assert bytes(raw[7]).decode() == df.where("doc_id = 7").first().text
    assert tokenize.vocabulary(spark, model, 10).count() == 10
    c = tokenize.compare_lengths(df, tokenize.sentencepiece_encoder(model), tokenize.byte_encoder()).first()
    assert 0 < c.ratio < 1 and abs(c.saving + c.ratio - 1) < 1e-9
    assert tokenize.benchmark(df, tokenize.byte_encoder(), str(tmp_path / "bench")).rows == 203
    with pytest.raises(FileNotFoundError):
        tokenize.load_sentencepiece("/nowhere.model")
