"""What numbers rows and counts words leaves executors little to hold."""

from pyspark.sql import functions as F

from reviewmart.llm import quality_rules
from reviewmart.llm.common import count_of, n_words
from reviewmart.llm.numbering import numbered
from reviewmart.workspace import cut


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbering_starts_no_python_workers(spark):
    rows = spark.range(0, 500, 1, 7).select((F.col("id") * 37 % 500).alias("k"))
    out = numbered(rows, F.col("k").desc())
    assert "ExistingRDD" not in _plan(out)  # rows that Python workers pickle again
    assert {(r["k"], r["number"]) for r in out.collect()} == {(k, 499 - k) for k in range(500)}
    assert numbered(rows.where("k < 0"), F.col("k")).count() == 0


def test_numbering_of_a_few_ranges_among_many(spark):
    rows = spark.range(0, 40, 1, 3).select((F.col("id") % 4).alias("k"))
    out = [r["number"] for r in numbered(rows, F.col("k")).orderBy("number").collect()]
    assert out == list(range(40))


def test_words_are_counted_without_making_them(spark):
    texts = [
        "", " ", "\n\t\x0b\x0c\r ", "a", " a", "a ", "  a\tb\n\nc  ", "x" * 5000, "y " * 5000, None,
        " ", "a b", "   ", "\U0001f600 \U0001f600\U0001f600", "$1 \\ $", "é \x00 \x1c",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", "t", n_words(F.col("t")).alias("n"))
    assert "split(" not in _plan(df)
    for row in df.collect():
        plain = None if row["t"] is None else len("".join(" " if c in " \t\n\x0b\x0c\r" else "w" for c in row["t"]).split())
        assert row["n"] == plain, row["i"]


def test_characters_are_counted_by_runs(spark):
    texts = ["", "aB!?.,;:", "##a#*$%&|<>&&", "ABC abc XYZ 0189 09!", "]^[\\-A-Z 5-7", "\U0001f600A\u00c9\u0661.", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    measured = quality_rules.measures(df)
    assert "translate(" not in _plan(measured)  # makes a string of every character
    kinds = {
        "n_symbols": "#*$%&|<>", "n_upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "n_digits": "0123456789", "n_marks": "!?", "n_stops": ".,;:",
    }
    for row in measured.select("doc.doc_id", "m.*").collect():
        text = texts[row["doc_id"]] or ""
        assert {kind: row[kind] for kind in kinds} == {kind: sum(c in of for c in text) for kind, of in kinds.items()}
    odd = df.select("text", count_of(F.col("text"), "]^[\\-").alias("n")).collect()
    assert [r["n"] for r in odd] == [None if t is None else sum(c in "]^[\\-" for c in t) for t in texts]


def test_repeated_words_of_windows_alike_in_part(spark):
    big, low = 1 << 62, -(1 << 63)
    rows = [
        [], [1], [1, 1], [1, 2, 1], [5, 5, 5, 5], [low, -1, low, -1], [7, 8, 9, 10, 11, 7],
        [big, big + 1, big + 2], [big, big + 1, big, big + 1], [0, 1, 2, 3], [-1, 0, -2, 0], [-1, 2**63 - 1, low, 0],
        [big + i for i in range(50)] + [big + 49] + [big - i for i in range(50)],
    ]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, w array<long>").where("size(w) > size(array_distinct(w))")
    out = df.select("i", quality_rules._covered(F.col("w")).alias("n")).collect()
    assert {r["i"] for r in out} == {i for i, w in enumerate(rows) if len(set(w)) < len(w)}
    for row in out:
        w = rows[row["i"]]
        assert row["n"] == len({at + k for at, key in enumerate(w) if w.count(key) > 1 for k in range(3)}), w


def test_rules_are_learned_from_bins_found_once(spark, monkeypatch):
    rows = [(i, i % 2 == 0, "word " * (20 if i % 2 == 0 else 200 + i)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, junk boolean, text string")
    stats = quality_rules.measures(df.drop("junk")).withColumn("key", F.col("doc.doc_id"))
    stats = stats.join(df.select(F.col("doc_id").alias("key"), "junk"), "key")
    written = {}

    def keep(table, label, **options):
        written[label] = cut(table, label, **options)
        return written[label]

    monkeypatch.setattr(quality_rules, "cut", keep)
    rules = quality_rules.fit(stats).rules
    assert [(c.feature, c.above) for c in rules[0]] == [("n_words", False)]
    bins = written["labelled-statistics"].select("n_words", F.explode("bins")).count()
    assert bins == 120 * len(quality_rules.features(F.col("m")))
