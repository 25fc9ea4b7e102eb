import pytest

from quern.operators.quality import LanguageFilter


def test_one_failing_text_costs_no_other(spark):
    class Picky:
        def predict(self, texts):
            if any("bad" in t for t in texts):
                raise ValueError("can't read it")
            return ["__label__en"] * len(texts), [0.9] * len(texts)

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "fine"), (4, None)], "id long, text string").coalesce(1)
    got = {r.id: (r.lang, r.lang_score, r.quality_keep) for r in LanguageFilter(Picky()).apply(df).collect()}
    unknown = ("__label__unknown", 0.0, False)
    assert got == {1: ("__label__en", 0.9, True), 2: unknown, 3: ("__label__en", 0.9, True), 4: unknown}


def test_no_memory_is_an_error(spark):
    class Full:
        def predict(self, texts):
            raise MemoryError("no room")

    df = spark.createDataFrame([(1, "good")], "id long, text string")
    with pytest.raises(Exception, match="no room"):
        LanguageFilter(Full()).apply(df).collect()
