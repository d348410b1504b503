"""String kernels, and languages of odd rows."""

import numpy as np
from pyspark.sql import functions as F

from reviewmart.llm import language_id


def _shared(a, b):
    """The kernel from sets of n-grams as they are."""

    def spelt(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        joined = f" {' '.join(words)} "
        return {joined[i : i + n] for n in (1, 2, 3) for i in range(len(joined) - n + 1)}

    a, b = spelt(a), spelt(b)
    return len(a & b) / np.sqrt(len(a) * len(b))


def test_kernels_are_shared_presences(monkeypatch):
    texts = ["The cat sat.", "the CAT, the cat!", "die Katze saß 12 mal", "Ünder\nthe über", "x"]
    chosen = language_id.Landmarks(tuple(language_id.grams(t) for t in texts[:3]))
    want = [[_shared(a, b) for b in texts[:3]] for a in texts]
    assert np.allclose(chosen.kernels([language_id.grams(t) for t in texts]), want)
    monkeypatch.setattr(language_id, "_PIECE", 3)
    assert np.allclose(chosen.kernels([language_id.grams(t) for t in texts]), want)


def _model(spark, *rows, **options):
    return language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), **options)


TAUGHT = [(i, f"the thing with the {'ring' * (1 + i % 3)} {i}", "en") for i in range(30)]
TAUGHT += [(100 + i, f"die Sache mit dem {'Ding' * (1 + i % 3)} {i}", "de") for i in range(30)]


def test_odd_rows(spark, odd):
    model = _model(spark, *TAUGHT, (1, None, "en"), (2, "12 !", "de"), (3, "the", None))
    assert model.languages == ("de", "en")
    rows = odd.select(F.struct("doc_id", "text").alias("doc"), language_id.predicted(F.col("text"), model).alias("p")).collect()
    assert len(rows) == odd.count()
    for row in rows:
        text, guess = row["doc"]["text"], row["p"]
        assert 0 <= guess["score"] <= 1
        assert (guess["lang_pred"] == "und") == (not any(map(str.isalpha, text or "")))
    assert dict(zip(["en", "de"], [g for g, _ in model.predict(["with the ring", "mit dem Ding"])], strict=True)) == {"en": "en", "de": "de"}


def test_copies_and_partitions_do_not_change_the_model(spark):
    docs = spark.createDataFrame(TAUGHT + [TAUGHT[0]] * 500, "doc_id long, text string, lang string")
    texts = ["the ring", "die Sache", "ring Ding"]
    told = [language_id.fit(docs.repartition(n)).predict(texts) for n in (1, 5)]
    assert told[0] == told[1] == _model(spark, *TAUGHT).predict(texts)


def test_a_text_with_two_languages_has_the_more_frequent_one(spark):
    twice = [(i, "the ring", "de") for i in range(3)] + [(i, "the ring", "en") for i in range(2)]
    few = language_id.sample(spark.createDataFrame(twice, "doc_id long, text string, lang string"), "text", "lang", None, 100)
    assert [tuple(r) for r in few.collect()] == [("the ring", "de")]


def test_nothing_to_learn(spark, odd):
    for docs in (odd.limit(0), odd.withColumn("lang", F.lit(None).cast("string"))):
        model = language_id.fit(docs, learn=F.lit(True))
        assert odd.select(language_id.predicted(F.col("text"), model).alias("p")).where("p.lang_pred <> 'und' OR p.score <> 0").count() == 0
    assert odd.limit(0).select(language_id.predicted(F.col("text"), _model(spark, *TAUGHT))).count() == 0
    assert _model(spark, *TAUGHT[:30]).predict(["die Sache", None])[0][0] == "en"


def test_only_held_in_rows_teach(spark):
    rows = [(i, text, lang) for i, text, lang in TAUGHT] + [(7, "los perros", "es")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, learn=F.col("lang") != "es")
    assert "es" not in model.languages


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs, learn=~held)
    told = docs.where(held).select("lang", language_id.predicted(F.col("text"), model)["lang_pred"].alias("told"))
    rows = told.collect()
    assert sum(r["lang"] == r["told"] for r in rows) >= 0.98 * len(rows)
