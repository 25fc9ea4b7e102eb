import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from quern.operators import quality
from quern.plans import pipeline
from quern.sources import wet
from quern.streaming import stages

LINE = "The mill number {} is in the valley of the river, and the road to town {} is long and quiet in winter. "


def corpus():
    rows = [("warcinfo", "", "", "about this file")]
    rows += [("conversion", f"https://a.example/{i}", "2031-01-01T00:00:00Z", (LINE.format(i, i * 7) + LINE.format(i * 3, i)) * 2 + f"\nmail m{i}@a.example") for i in range(40)]
    rows += [("conversion", "https://a.example/1", "2031-01-02T00:00:00Z", rows[2][3]), ("conversion", "e", "d", ""), ("conversion", "s", "d", "short"), ("conversion", "long", "d", "word " * 60_000), ("conversion", "bad", "d", b"\xff\xfe" + LINE.encode() * 4)]
    return rows


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    root = tmp_path_factory.mktemp("wet")
    os.makedirs(root / "sub")
    wet.write_wet(corpus(), str(root / "sub" / "b.wet.gz"))
    wet.write_wet(corpus()[:5], str(root / "a.wet.gz"))
    wet.write_wet(corpus(), str(root / ".hidden.wet.gz"))
    whole = gzip.decompress((root / "a.wet.gz").read_bytes())
    (root / "c.wet.gz").write_bytes(gzip.compress(whole)[:-200])
    return str(root)


def test_reader(spark, archive):
    paths = wet.discover(archive)
    assert [os.path.basename(p) for p in paths] == ["a.wet.gz", "c.wet.gz", "b.wet.gz"] and wet.discover("/nowhere") == [] and len(wet.discover(archive, max_files=1)) == 1
    rows = wet.read_wet(spark, [p for p in paths if p.endswith("b.wet.gz")]).collect()
    assert len(rows) == 43 and len({r.doc_id for r in rows}) == 43
    by = {r.url: r for r in rows}
    assert len(by["long"].text) == 200_000 and by["bad"].text.startswith("��The") and not {"e", "s"} & set(by)
    assert all(len(r.doc_id) == 40 and r.source_path.endswith("b.wet.gz") for r in rows)
    assert wet.read_wet(spark, paths[:1], wet.IngestRules(max_docs_per_file=2)).count() == 2
    assert wet.read_wet(spark, [p for p in paths if p.endswith("c.wet.gz")]).count() < 5
    remote = wet.discover("file://" + archive, spark=spark)
    assert [os.path.basename(p) for p in remote] == [os.path.basename(p) for p in paths]
    again = wet.read_wet(spark, ["file://" + p for p in paths if p.endswith("b.wet.gz")])
    assert sorted(r.text for r in again.collect()) == sorted(r.text for r in rows)


def english():
    class English:
        def predict(self, texts):
            return ["__label__en"] * len(texts), [0.9 if "mill" in t else 0.1 for t in texts]

    return English()


def test_all_steps(spark, archive, tmp_path):
    config = pipeline.PipelineConfig(output_base=str(tmp_path), data_dir=archive, language_model=english(), vocab_size=300, num_shards=2, seq_len=64, shard_chunks=16, emit_seq_lens_offsets=True)
    stats = pipeline.run(config, spark)
    assert list(stats) == list(pipeline.STEPS)
    assert stats["ingest"]["files_in"] == 3 and stats["clean"]["rows_in"] == stats["ingest"]["rows_out"]
    assert stats["clean"]["rows_dropped"] + stats["clean"]["rows_out"] == stats["clean"]["rows_in"]
    clusters = stats["clustering"]
    assert clusters["rows_out"] <= clusters["total_docs"] and clusters["removed"] > 0
    pii_rows = spark.read.parquet(str(tmp_path / "pii_parquet"))
    assert pii_rows.where(F.col("text").contains("@")).count() == 0 and "lang_score" in pii_rows.columns
    packed = spark.read.parquet(str(tmp_path / "token_packing_parquet"))
    assert "seq_id" not in packed.columns and packed.where(F.size("input_ids") != 64).count() == 0
    assert os.path.getsize(tmp_path / "final.bin") == packed.count() * 64 * 2 == stats["export"]["bytes"]
    saved = json.loads((tmp_path / "pipeline_stats.json").read_text())
    assert list(saved) == list(pipeline.STEPS)
    assert pipeline.main(["--output-base", str(tmp_path), "--steps", "export", "--dtype", "int32", "--output-file", str(tmp_path / "o.bin")], spark) == 0
    assert os.path.getsize(tmp_path / "o.bin") == packed.count() * 64 * 4
    assert pipeline.main(["--output-base", str(tmp_path / "none"), "--steps", "clean"], spark) == 1


def test_step_order():
    assert pipeline.plan_steps("pii,clean") == ["pii", "clean"]
    assert pipeline.plan_steps("clean,pii,minhash", "pii") == ["pii", "minhash"]
    assert pipeline.plan_steps("clean", "tokenize") == ["tokenize", "export"]
    for bad in (("nope", None), ("all", "nope")):
        with pytest.raises(ValueError):
            pipeline.plan_steps(*bad)


def test_language_filter(spark):
    model = quality.TrigramModel.fit([("en", "the mill is in the valley and the road is long"), ("de", "die mühle ist im tal und der weg ist lang"), ("en", None)])
    df = spark.createDataFrame([(1, "the road\nis in the valley"), (2, "der weg ist im tal"), (3, " \n"), (4, None)], "id long, text string")
    keep = quality.LanguageFilter(model, ("en",), 0.5)
    got = {r.id: r for r in keep.apply(df).collect()}
    assert (got[1].lang, got[2].lang, got[3].lang, got[3].lang_score) == ("__label__en", "__label__de", "__label__unknown", 0.0)
    assert [got[i].quality_keep for i in (1, 2, 3, 4)] == [True, False, False, False]
    assert keep.apply(df.limit(0)).columns == ["id", "text", "quality_keep", "lang", "lang_score"]
    assert quality.keep_rate(keep.apply(df)).first().rate == 0.25 and quality.keep_rate(keep.apply(df).limit(0)).first().rate == 0
    assert quality.language_counts(keep.apply(df)).count() == 3 and quality.keep_counts(keep.apply(df)).count() == 3
    with pytest.raises(ValueError):
        quality.LanguageFilter(model, ())
    with pytest.raises(RuntimeError):
        quality.LanguageFilter(None).apply(df)

    class Broken:
        def predict(self, texts):
            raise RuntimeError("boom")

    assert {r.lang for r in quality.LanguageFilter(Broken()).apply(df).collect()} == {"__label__unknown"}


def test_quality_classifier(spark):
    rows = [(f"good clear words number {i}", "hq") for i in range(30)] + [(f"spam buy now offer {i}", "lq") for i in range(30)]
    f = quality.QualityFilter("hq", features=1 << 10).fit(spark.createDataFrame(rows, "text string, label string"))
    got = {r.text: r for r in f.score(spark.createDataFrame([("clear words good",), ("buy spam now",), ("  ",), (None,)], "text string")).collect()}
    assert got["clear words good"].quality_pass and not got["buy spam now"].quality_pass and got["  "].quality_score == got[None].quality_score == 0
    with pytest.raises(ValueError):
        quality.QualityFilter("none").fit(spark.createDataFrame(rows, "text string, label string"))


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [(i, LINE.format(i, i) * 4 if i % 2 else "short", f"2031-01-01 00:{i:02d}:00") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, at string").withColumn("at", F.to_timestamp("at"))
    df.write.parquet(src)
    q = stages.write(stages.cleaned(stages.arriving(spark, src, df.schema)), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    q = stages.drop_counts(stages.arriving(spark, src, df.schema), "at").writeStream.format("memory").queryName("drops").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("drops").groupBy().sum("n").first()[0] == 20


def test_compare_tokenizers(spark, tmp_path):
    bpe, spm = "/opt/tokenizers/byte_bpe_50k.tiktoken", "/opt/tokenizers/piece_bpe_32k.model"
    if not (os.path.exists(bpe) and os.path.exists(spm)):
        pytest.skip("no vocabulary files")
    spark.createDataFrame([(i, LINE.format(i, i)) for i in range(40)] + [(99, None)], "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "in"))
    assert pipeline.main(["--compare", str(tmp_path / "out"), "--input", str(tmp_path / "in"), "--spm-model", spm, "--bpe-ranks", bpe, "--num-shards", "2", "--log-file", str(tmp_path / "logs" / "x.log")], spark) == 0
    m = json.load(open(tmp_path / "out" / "metrics.json"))
    for name in ("sentencepiece", "bpe"):
        t = m["tokenizers"][name]
        got = spark.read.parquet(str(tmp_path / "out" / name))
        assert t["rows"] == 41 == got.count() and t["num_shards"] == 2 and t["tokens"] == got.selectExpr("sum(num_tokens)").first()[0] > 0
    assert m["ratio"] == m["tokenizers"]["sentencepiece"]["tokens"] / m["tokenizers"]["bpe"]["tokens"] and os.path.exists(tmp_path / "logs" / "x.log")
    assert pipeline.main(["--compare", str(tmp_path / "none"), "--input", str(tmp_path / "in")], spark) == 1
