import pytest

from quern.llm.langid import LABELS, languages, mislabelled, segments, tokens_of, train, training_sequences
from quern.llm.langlabels import language_of

TEXTS = {
    "en": ["The mill is closed in winter and the road leads to the sea.", "We saw how the old tower was built for the garden club.", "They have many of them, but the bakery is in the square."],
    "de": ["Die Mühle ist im Winter geschlossen und der Weg führt zum See.", "Wir haben das alte Schloss gesehen, aber es ist nicht mehr offen.", "Der Turm und die Schule sind auf der anderen Seite."],
    "fr": ["Le moulin est fermé en hiver et la route mène à la mer.", "Nous avons vu la vieille tour, mais elle est pour les jeunes.", "La gare et le musée sont sur la rive ouest."],
    "es": ["El molino está cerrado en invierno y el camino lleva al mar.", "Hemos visto la torre vieja, pero es para los jóvenes.", "La estación y el museo están en la orilla oeste."],
    "pt": ["O moinho está fechado no inverno e o caminho leva ao mar.", "Nós vimos a torre velha, mas ela é para os jovens.", "A estação e o museu ficam na margem oeste."],
    "zh": ["石塔影响了灯塔，我们也看到了山后的茶馆。", "这座木桥连接着老街和邮局。"],
}


@pytest.fixture(scope="module")
def model(spark):
    samples = spark.createDataFrame([(f"__label__{k}" if i else k, t) for k, ts in TEXTS.items() for i, t in enumerate(ts)] * 8 + [(None, "x"), ("en", None)], "lang string, sample_text string")
    words = spark.createDataFrame([("en", "the"), ("en", "and"), ("de", "die"), ("de", "und"), ("fr", "le"), ("fr", "et"), ("es", "el"), ("pt", "o"), ("es", "y"), ("pt", "e"), (None, "q")], "lang string, word string")
    # so few samples need more passes than the real table
    return train(samples.union(samples), words, rounds=60)


def rows():
    out = [(i * 10 + j, t, k) for i, (k, ts) in enumerate(TEXTS.items()) for j, t in enumerate(ts)]
    out += [(100, TEXTS["en"][0] + "\n" + TEXTS["de"][0], "en"), (101, "var a = b(12); if (a.b > 3) { c.push(d); }", "en"), (102, None, "en"), (103, "", None), (104, "12345 !!", None), (105, TEXTS["fr"][0].upper(), "xx"), (105, TEXTS["fr"][0].upper(), "xx")]
    return out


def test_spellings(spark):
    got = spark.createDataFrame([(x,) for x in ("en", "__label__en", "en-US", "eng", "EN", " de_DE", "zh-Hans", "zho", "und", "", None, "__label__unknown", "por")], "x string").select(language_of(__import__("pyspark").sql.functions.col("x")).alias("y"))
    assert [r.y for r in got.collect()] == ["en"] * 5 + ["de", "zh", "zh", None, None, None, None, "pt"]


def test_languages_and_wrong_labels(spark, model):
    df = spark.createDataFrame([(*r, 0.5, "clash") for r in rows()], "doc_id long, text string, lang string, share double, lang_found string")
    got = {}
    for r in languages(df, model).collect():
        got.setdefault(r.doc_id, {})[r.lang_found] = r
        assert 0.2 <= r.share <= 1 and 0 < r.confidence <= 1
    right = sum(k in got.get(d, {}) for d, t, k in rows() if d < 100)
    assert right >= 0.9 * sum(d < 100 for d, _, _ in rows())
    assert set(got[100]) == {"en", "de"} and not {101, 102, 103, 104} & set(got)
    wrong = {(r.doc_id, r.lang_found) for r in mislabelled(languages(df, model)).collect()}
    assert (100, "de") in wrong and (100, "en") not in wrong and (105, "fr") in wrong
    assert languages(df.limit(0), model).count() == 0


def test_segments(spark, model):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    texts = {d: t for d, t, _ in rows()}
    own = {}
    for r in segments(df, model).collect():
        own.setdefault(r.doc_id, []).append(r)
    two = sorted(own[100], key=lambda r: r.start)
    assert [r.lang for r in two] == ["en", "de"] and texts[100][two[1].start :].startswith("Die")
    assert segments(df.limit(0), model).count() == 0 and 102 not in own


def test_training_table():
    seqs, gold = training_sequences([(k, t) for k, ts in TEXTS.items() for t in ts])
    assert all(len(a) == len(b) > 0 for a, b in zip(seqs, gold))
    assert {y for g in gold for y in g} == set(range(len(LABELS)))
    assert tokens_of("Ein Weg, 12 山后\n") == ["Ein", "Weg", ",", "12", "山后", "\n"]
