"""Nulls, empty and very long texts, repeats, clashing names and empty tables."""

import math
from collections import Counter

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reviewmart.llm import (
    bpe,
    embedding_dedup,
    mixing,
    pii,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    token_files,
    toxicity,
)
from reviewmart.workspace import cut, fresh_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def _texts(rows):
    return sorted(((r["doc"]["doc_id"], r["doc"]["text"]) for r in rows), key=str)


def _whole(odd):
    return sorted(((r["doc_id"], r["text"]) for r in odd.collect()), key=str)


def test_sanitise(odd):
    rows = pii.sanitise(odd).collect()
    assert _texts(rows) == _whole(odd)
    for row in rows:
        spans = [(s["kind"], s["start"], s["end"]) for s in row["spans"] if s["kind"] != "term"]
        assert sorted(spans) == sorted(brute.personal(row["doc"]["text"]))


def test_disclosing_terms(spark):
    """A word that occurs only beside one address gives it away; a common one does not."""
    rows = [(i, f"Kestrel wrote to ann@mail.example.org about the plan {i}") for i in range(4)]
    rows += [(10 + i, f"the plan for {i} about others bob{i}@mail.example.org") for i in range(4)]
    rows += [(20 + i, f"about the plan {i}" + (" for others" if i > 10 else "")) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc"]["doc_id"]: r for r in pii.sanitise(docs).collect()}
    terms = {out[0]["doc"]["text"][s["start"] : s["end"]] for s in out[0]["spans"] if s["kind"] == "term"}
    assert terms == {"Kestrel", "wrote"}
    assert not any(s["kind"] == "term" for i in range(10, 14) for s in out[i]["spans"])
    clean = pii.sanitise(docs).select("doc.doc_id", pii.sanitised_text(F.col("doc.text"), F.col("spans")).alias("t"))
    texts = dict(clean.collect())
    assert texts[0] == "  to [email] about the plan 0"
    assert texts[20] == "about the plan 0"


def test_disclosing_terms_far_away(spark):
    """Words are judged and replaced over the whole document, at every occurrence."""
    filler = "about the plan " * 40
    rows = [(i, f"Kestrel {filler} ann@mail.example.org {filler} KESTREL and {i}") for i in range(4)]
    rows += [(10 + i, f"{filler} and {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc"]["doc_id"]: r for r in pii.sanitise(docs).collect()}
    for i, text in rows:
        terms = [text[s["start"] : s["end"]] for s in out[i]["spans"] if s["kind"] == "term"]
        assert sorted(terms) == (["KESTREL", "Kestrel"] if i < 4 else [])


@pytest.mark.parametrize(
    "entity",
    [
        lambda i: f"p{i}@corp.example.org",  # one domain
        lambda i: f"p{i}@corp{i}.example.org",  # one top domain
        lambda i: f"10.20.{i}.7",
        lambda i: f"10.{i}.3.7",
        lambda i: f"{i + 3}.{i}.3.7",  # nothing but the kind
        lambda i: f"+1 (555) 010-22{i}3",
        lambda i: f"+{i + 2}1 999 010-2203",
    ],
)
def test_terms_of_rare_entities(spark, entity):
    """Entities of one document each are judged by the narrowest class that documents share."""
    rows = [(i, f"Kestrel reach {entity(i)} about the plan {i}") for i in range(4)]
    rows += [(20 + i, f"reach about the plan {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc"]["doc_id"]: r for r in pii.sanitise(docs).collect()}
    for i, text in rows:
        terms = [text[s["start"] : s["end"]] for s in out[i]["spans"] if s["kind"] == "term"]
        assert terms == (["Kestrel"] if i < 4 else [])


def test_generalised_terms(spark):
    rows = [(i, f"Kestrel near ann@mail.example.org {i}") for i in range(6)]
    rows += [(6, "Kestrel flies"), (7, "Kestrel sings")]
    rows += [(20 + i, f"near nothing {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = pii.sanitise(docs).select("doc.doc_id", pii.sanitised_text(F.col("doc.text"), F.col("spans")).alias("t"))
    assert dict(out.collect())[0] == "[name] near [email] 0"


def test_shard(odd):
    rows = sharding.shard(odd, shards=3, piece_bytes=1000).collect()
    assert _texts(rows) == _whole(odd)
    for number in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == number)
        assert slots == list(range(len(slots)))


def test_shards_split_a_hot_text_only(spark):
    """Copies stay together unless they are a large part of a shard."""
    hot = [(i, "the same text " * 20) for i in range(3000)]
    pairs = [(10_000 + i, f"text {i // 2} " * 20) for i in range(6000)]
    docs = spark.createDataFrame(hot + pairs, "doc_id long, text string")
    rows = sharding.shard(docs, shards=10, piece_bytes=20000).collect()
    sizes, places = {}, {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        places.setdefault(r["doc"]["text"], set()).add(r["shard"])
    mean = sum(sizes.values()) / 10
    assert max(abs(s - mean) for s in sizes.values()) < 0.05 * mean
    assert len(places.pop("the same text " * 20)) > 2
    assert all(len(shards) == 1 for shards in places.values())


@pytest.mark.parametrize("partitions", [1, 6])
def test_shards_split_rows_alike(spark, partitions):
    """A third of all rows alike in text and id, with another column that differs."""
    rows = [(7, "quite the same " * 9, i) for i in range(3000)]
    rows += [(100 + i, f"text {i} " * (1 + i % 9), i) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other int").repartition(partitions)
    out = sharding.shard(docs, shards=10, piece_bytes=5000).collect()
    assert sorted(r["doc"]["other"] for r in out) == sorted(r[2] for r in rows)
    sizes, slots = {}, {}
    for r in out:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    mean = sum(sizes.values()) / 10
    assert len(sizes) == 10 and max(abs(s - mean) for s in sizes.values()) <= 0.02 * mean + 160
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())


def test_shards_like_plain_splitters(spark):
    """Every boundary is where counting all rows in order puts it, within the tolerance."""
    rows = [(i, f"some text {i} " * (1 + i % 23)) for i in range(4000)] + [(i, None) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.shard(docs, shards=8, piece_bytes=3000).collect()
    text, doc_id = F.coalesce("text", F.lit("")), F.col("doc_id")
    keys = docs.select(
        "doc_id",
        F.shiftrightunsigned(F.xxhash64(text), 1).alias("key"),
        F.shiftrightunsigned(F.xxhash64(doc_id.isNull(), doc_id), 1).alias("tie"),
        "text",
    ).collect()
    shard_of = {(r["doc"]["doc_id"], r["doc"]["text"]): r["shard"] for r in out}
    total, before = sum(r["size"] for r in out), 0
    order = sorted(keys, key=lambda r: (r["key"], r["tie"]))
    numbers = [shard_of[r["doc_id"], r["text"]] for r in order]
    assert numbers == sorted(numbers)
    for row, number, following in zip(order, numbers, numbers[1:]):
        before += len((row["text"] or "").encode()) + 16
        if following != number:
            assert abs(before - total * following / 8) <= 0.002 * total / 8 + 400


def test_token_files(spark, odd):
    path = fresh_path(spark, "files")
    token_files.write(odd, path, BYTES, end=2)
    rows = token_files.read(spark, path).orderBy("start").collect()
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    at = 0
    for row in rows:
        assert (row["start"], row["n_tokens"]) == (at, len(row["ids"]))
        at += row["n_tokens"]
    assert [r["ids"] for r in rows if r["doc_id"] == 0] == [[2]]
    assert token_files.fetch(spark, path, 3) == [r["ids"] for r in rows if r["doc_id"] == 3]
    assert token_files.fetch(spark, path, 5) == [r["ids"] for r in rows if r["doc_id"] == 5]
    assert token_files.fetch(spark, path, 999) == []


def test_kept_chunks_are_bounded_by_bytes():
    """Text without blanks does not fill the tables, and what fills them is counted in bytes."""
    encoder, serializer = bpe.Encoder(WORDS), token_files.Serializer(BYTES)
    blobs = ["".join(chr(0x4E00 + (7 * i + 11 * j) % 5000) for j in range(300)) for i in range(20)]
    for blob in blobs:
        ids, _, n = encoder.encode(blob)
        assert len(encoder.pack(blob)) == 4 * n == 4 * len(ids.split())
        serializer.serialize(f"a {blob}")
    assert not encoder.kept and not encoder.kept_packed
    assert not any(len(key) > 64 for key in (*serializer.bare, *serializer.after_blank))
    kept = bpe.Kept(lambda key: key * 100, 10_000)
    for i in range(1000):
        assert kept[f"word{i % 700}"] == f"word{i % 700}" * 100
        assert sum(map(len, kept.values())) <= 10_000 and sum(map(len, kept.before.values())) <= 10_000


@pytest.mark.parametrize(
    "text",
    ["a  b", "a \n b", "a\n\n b", " a", "a ", "  ", "\n", "a <|endoftext|> b", "x<|endoftext|>", "a,\nB. c!\nd\n", "a.. b,; C", "été\u0378 ｶﾅ x1 1x ١", "it's 12 ok's\tand  so", " a b"],
)
def test_serialized_as_the_library_does(text):
    encoder = token_files.Serializer(BYTES)
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert list(memoryview(encoder.serialize(text)).cast("H")) == want


def test_vectors(spark):
    far, near = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0]
    rows = [
        (1, far),
        (2, near),
        (3, [2.0, 0.0, 0.0]),
        (4, far),
        (5, [0.0, 1.0, 0.0]),
        (6, None),
        (7, []),
        (8, [0.0, 0.0, 0.0]),
        (9, [None, 1.0, 0.0]),
        (10, [float("nan"), 1.0, 0.0]),
        (11, [float("inf"), 0.0, 0.0]),
        (12, [1.0, 0.0]),
        (13, [1e300, 0.0, 0.0]),
        (None, [0.0, 0.0, 1.0]),
        (None, [0.0, 0.0, 1.0]),
        (5, [0.0, 1.0, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS doc", "2 AS id", "3 AS vector", "4 AS usable", "5 AS cls"
    )
    out = sorted(((r["doc"]["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.link(table).collect()), key=str)
    linked = [(i, 4, 1) for i in (1, 2, 3, 4, 13)]
    alone = [(i, 0, i) for i in (6, 7, 8, 9, 10, 11, 12)]
    assert out == sorted([*linked, *alone, (5, 1, 5), (5, 1, 5), (None, 1, None), (None, 1, None)], key=str)


def test_dense_group_keeps_every_link(spark, monkeypatch):
    """More near copies than a window holds."""
    import numpy as np

    draw = np.random.default_rng(5)
    middle = draw.standard_normal(16)
    close = middle + 0.02 * draw.standard_normal((1500, 16))
    others = draw.standard_normal((500, 16))
    vectors = np.vstack([close, others])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    out = {r["doc"]["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.link(rows).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9).sum(1) - 1
    assert [out[i][0] for i in range(len(vectors))] == links.tolist()
    assert {out[i][1] for i in range(1500)} == {0}


def test_recall_at_the_threshold(spark):
    import numpy as np

    draw = np.random.default_rng(6)
    base = draw.standard_normal((8000, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = draw.standard_normal(base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    mate = 0.902 * base + np.sqrt(1 - 0.902**2) * side
    vectors = np.vstack([base, mate])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    out = {r["doc"]["vec_id"]: r["n_links"] for r in embedding_dedup.link(rows).collect()}
    found = sum(out[i] > 0 for i in range(8000)) / 8000
    assert found >= 0.95
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    assert (np.array([out[i] for i in range(16000)]) <= [(unit @ v >= 0.9).sum() - 1 for v in unit]).all()


def test_ranges_meet_at_their_ends(spark):
    """Neighbours that a pass sorts into different ranges are compared all the same."""
    vectors = [(i, [math.cos(i * 0.02), math.sin(i * 0.02)]) for i in range(300)]
    classes = cut(spark.createDataFrame(vectors, "cls long, vector array<double>").withColumn("dim", F.lit(2)), "classes")
    classes = cut(embedding_dedup._sketched(classes, 3), "sketched")
    strings = embedding_dedup._strings(classes, range(1), 3).withColumn("root", F.lit(-1).cast("long"))
    met = embedding_dedup._neighbours(strings, 128).collect()
    inside = {}
    for row in met:
        inside.setdefault(row["unit"], set()).add(row["cls"])
    order = [r["cls"] for r in strings.orderBy("dim", "pass", "key", "cls").collect()]
    assert all(any({a, b} <= unit for unit in inside.values()) for a, b in zip(order, order[1:]))


def _crowded():
    """A third of all vectors crowd one direction, linked in pairs at 0.905 only."""
    import numpy as np

    draw = np.random.default_rng(7)
    middle = np.eye(65)[64]
    base = np.pad(draw.standard_normal((1000, 64)), ((0, 0), (0, 1)))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = np.pad(draw.standard_normal((1000, 64)), ((0, 0), (0, 1)))
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    mate = 0.62 * base + np.sqrt(1 - 0.62**2) * side
    crowd = np.sqrt(0.75) * middle + 0.5 * np.vstack([base, mate])
    vectors = np.vstack([crowd, draw.standard_normal((4000, 65))])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors, ((unit @ unit.T >= 0.9).sum(1) - 1).tolist()


@pytest.mark.parametrize(("depth", "recall"), [(None, 0.98), (14, 0.97)])
def test_recall_in_a_crowd(spark, monkeypatch, depth, recall):
    """Pairs in a crowded direction are found like others, with short and long beginnings of strings."""
    vectors, links = _crowded()
    if depth:
        monkeypatch.setattr(embedding_dedup, "_depth", lambda *_: depth)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    out = {r["doc"]["vec_id"]: r["n_links"] for r in embedding_dedup.link(rows).collect()}
    assert sum(links[:1000]) >= 1000
    assert sum(out[i] == links[i] for i in range(2000)) >= recall * 2000
    assert all(out[i] <= links[i] for i in range(len(vectors)))


def _marked(odd):
    return cut(
        odd.select(F.struct("doc_id", "text").alias("doc"), F.col("doc_id").alias("id"), simhash.fingerprint(F.col("text"), 3).alias("fingerprint")),
        "marked",
    )


def test_simhash(odd):
    rows = _marked(odd).collect()
    for row in rows:
        assert row["fingerprint"] % 2**64 == brute.fingerprint(row["doc"]["text"])


def test_one_document_of_each_group_stays(odd):
    kept = [r["doc"]["doc_id"] for r in simhash.kept_rows(_marked(odd), 3).collect()]
    assert len(kept) == len(set(kept))
    assert {0, 3, 11} <= set(kept) and not {1, 2} & set(kept)


@pytest.mark.parametrize("n", [300, 2600])
def test_dense_fingerprints(spark, n):
    """A chain of near fingerprints that share most segments, and scattered others."""
    import numpy as np

    draw = np.random.default_rng(n)
    values = [int(draw.integers(0, 2**63))]
    while len(values) < n:
        at = values[int(draw.integers(0, len(values)))]
        for bit in draw.choice(63, int(draw.integers(1, 5)), replace=False):
            at ^= 1 << int(bit)
        values.append(at)
    values = sorted(set(values) | {int(v) for v in draw.integers(0, 2**63, 200)})
    marked = cut(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, fingerprint long"), "dense")
    got = {r["fingerprint"]: r["component_id"] for r in simhash.classes(marked, 3).collect()}
    array = np.array(values, np.uint64)
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 3):
            low, high = sorted((find(i), find(int(j))))
            root[high] = low
    assert got == {v: find(i) for i, v in enumerate(values)}


def test_longer_segments_find_the_same():
    for n in (10, 10**7, 10**9, 10**12):
        masks = simhash._segment_masks(n, 3)
        for bits in ((), (0,), (0, 63), (1, 20, 40), (13, 14, 15)):
            changed = sum(1 << b for b in bits)
            assert any(not mask & changed for mask in masks)


def test_toxicity(spark, odd):
    clean = [(i, f"a quiet word about thing{i % 40}", 0) for i in range(200)]
    rude = [(1000 + i, f"you {'vile' if i % 2 else 'vilest'} {'wretch ' * (1 + i % 9)} thing{i % 40} again {i}", 1) for i in range(200)]
    table = spark.createDataFrame(clean + rude, "doc_id long, text string, toxic int")
    model = toxicity.fit(table.drop("toxic"), table.select("doc_id", "toxic"), least_texts=3)
    assert list(model.thresholds) == sorted(model.thresholds)
    unseen = spark.createDataFrame(
        [(1, "a quiet thing"), (2, "you wretch"), (3, "wretch wretch wretch wretch wretch vilest"), (4, None), (5, "")],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: r["g"] for r in unseen.select("doc_id", toxicity.graded(F.col("text"), model).alias("g")).collect()}
    assert [got[i]["toxic"] for i in range(1, 6)] == [False, True, True, False, False]
    assert got[3]["expected_severity"] > got[1]["expected_severity"]
    none = toxicity.fit(odd, table.select("doc_id", "toxic").limit(0))
    rows = odd.select(toxicity.graded(F.col("text"), none).alias("g")).collect()
    assert len(rows) == odd.count() and not any(r["g"]["toxic"] for r in rows)


def test_labels_of_equal_texts_are_averaged(spark):
    rows = [(i, "the same text", i % 3 == 0) for i in range(9)] + [(20 + i, "another one", i % 3 > 0) for i in range(9)]
    table = spark.createDataFrame([(i, t, int(toxic)) for i, t, toxic in rows], "doc_id long, text string, toxic int")
    for partitions in (1, 3, 8):
        docs = table.drop("toxic").repartition(partitions)
        few = toxicity.labelled_sample(docs, table.select("doc_id", "toxic"), "text", "doc_id", "toxic", 100)
        assert {tuple(r) for r in few.collect()} == {("the same text", False), ("another one", True)}


def test_toxicity_without_documents(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    none = spark.createDataFrame([], "doc_id long, text string")
    model = toxicity.fit(none, labels)
    assert none.select(toxicity.graded(F.col("text"), model)).count() == 0
    assert model.above("any text")[0] < 0.5


def test_fit_is_the_likeliest():
    """No change of a weight or threshold raises the likelihood as written down plainly."""
    import random

    import numpy as np

    draw = random.Random(9)
    rows = []
    for i in range(240):
        toxic = i % 2 == 0
        places = sorted(draw.sample(range(6), 3) if not toxic else draw.sample(range(3, 9), 3))
        rows.append({"toxic": toxic, "marked": draw.random() if toxic else 0.0, "places": places, "values": [draw.random() + 0.5 for _ in places]})
    names = [f"f{i}" for i in range(9)]
    model = toxicity._fitted(rows, names, rounds=4000)
    marked = sorted(r["marked"] for r in rows if r["toxic"])
    cuts = [float(np.quantile(marked, q)) for q in (1 / 3, 2 / 3)]

    def likelihood(weights, thresholds):
        total = 0.0
        for row in rows:
            grade = 1 + sum(row["marked"] >= c for c in cuts) if row["toxic"] else 0
            score = sum(weights[p] * v for p, v in zip(row["places"], row["values"], strict=True))
            above = [1.0, *(1 / (1 + math.exp(t - score)) for t in thresholds), 0.0]
            total += math.log(max(above[grade] - above[grade + 1], 1e-12)) * 0.5 / 120
        return total - 0.5e-4 * sum(w * w for w in weights)

    weights, thresholds = [model.weights.get(name, 0.0) for name in names], list(model.thresholds)
    best = likelihood(weights, thresholds)
    for step in (0.05, -0.05, 0.5, -0.5):
        for i in range(len(names)):
            assert likelihood([w + step * (i == j) for j, w in enumerate(weights)], thresholds) <= best + 1e-6
        for k in range(3):
            moved = [t + step * (j == k) for j, t in enumerate(thresholds)]
            if moved == sorted(moved):
                assert likelihood(weights, moved) <= best + 1e-6


def test_long_texts_train_the_dictionary(spark):
    long = " ".join(f"word{i % 300}" for i in range(60_000))
    docs = spark.createDataFrame([(1, long)], "id long, text string")
    data = token_files.train_dictionary(docs, BYTES, samples=30, size=4096)
    assert len(data) > 1000 and data == token_files.train_dictionary(docs.union(docs).repartition(3), BYTES, samples=60, size=4096)


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = toxicity.fit(docs, labels.where(~held))
    out = docs.join(labels.where(held), "doc_id").select("toxic", toxicity.graded(F.col("text"), model).alias("g")).collect()
    right = sum(r["g"]["toxic"] == (r["toxic"] == 1) for r in out)
    assert right / len(out) >= 0.9


def test_mix(odd):
    rows = mixing.mix(odd).collect()
    assert _texts(rows) == _whole(odd)
    assert {r["copies"] for r in rows if r["doc"]["doc_id"] == 3 and r["doc"]["source"] == "src1"} in ({0}, {1}, {2})
    assert all(r["copies"] <= 2 for r in rows)


@pytest.mark.parametrize("partitions", [1, 6])
def test_mix_of_rows_alike(spark, partitions):
    """A third of all rows alike: targets are met within one row, and each row counts by itself."""
    rows = [(7, "a b c d e f g", "s0", i) for i in range(3000)] + [(8, "x y z", "s2", i) for i in range(500)]
    rows += [(100 + i, "word " * (1 + i % 5), f"s{i % 3}", i) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other int").repartition(partitions)
    out = mixing.mix(docs).collect()
    assert sorted(r["doc"]["other"] for r in out) == sorted(r[3] for r in rows)
    taken, target = {}, {}
    for r in out:
        source = r["doc"]["source"]
        taken[source] = taken.get(source, 0) + r["size"] * r["copies"]
        target[source] = r["target"]
    for source in target:
        assert abs(taken[source] - target[source]) <= 4
    alike = [r["copies"] for r in out if r["doc"]["doc_id"] == 7]
    assert len(alike) == 3000 and max(alike) - min(alike) <= 1


def test_budget_beyond_all_caps(odd):
    rows = mixing.mix(odd, share=9.0).collect()
    assert {r["copies"] for r in rows if r["size"]} == {2}


def test_scan(odd):
    rows = secret_scan.scan(odd).collect()
    assert _texts(rows) == _whole(odd)
    for row in rows:
        spans = [(s["kind"], s["start"], s["end"]) for s in row["secrets"] if s["kind"] != "random"]
        assert sorted(spans) == sorted(brute.secrets(row["doc"]["text"]))


def test_ownership(spark):
    rows = [(i, f"use token = examplekey12345 here {i}", f"owner{i}", "en") for i in range(5)]
    rows += [(9, "my token = q8Zr51LmX0vT77b", "owner9", "en"), (10, "loose q8Zr51LmX0vT77bYYwaE33 end", "owner9", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = {r["doc"]["doc_id"]: r["secrets"] for r in secret_scan.scan(docs).collect()}
    assert [s["live"] for s in out[0]] == [False] and out[0][0]["owners"] == 5
    assert [(s["kind"], s["live"]) for s in out[9]] == [("assign", True)]
    assert [(s["kind"], s["live"]) for s in out[10]] == [("random", True)]
    redacted = secret_scan.scan(docs).select("doc.doc_id", secret_scan.redact(F.col("doc.text"), F.col("secrets")).alias("t"))
    texts = dict(redacted.collect())
    assert texts[0] == "use token = examplekey12345 here 0"
    assert texts[9] == "my [secret:assign]"
    assert texts[10] == "loose [secret:random] end"


def test_repositories_decide_between_two_owners(spark):
    few, many, own = "few1Zr51LmX0vT77b", "many8Zr51LmX0vT7", "own8Zr51LmX0vT77"
    rows = [(i, f"token = {few}", f"o{i % 2}", "en") for i in range(8)]
    rows += [(10 + i, f"token = {many}", f"o{i % 2}", f"l{i // 2}") for i in range(8)]
    rows += [(20 + i, f"token = {own}", "o1", f"l{i}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = {r["doc"]["doc_id"]: r["secrets"][0] for r in secret_scan.scan(docs).collect()}
    assert [(out[i]["owners"], out[i]["repositories"], out[i]["live"]) for i in (0, 10, 20)] == [(2, 2, True), (2, 8, False), (1, 8, True)]


def test_encode(spark, odd):
    out = bpe.with_ids(odd.select("text", F.col("text").alias("t")), "t", WORDS)
    out = out.withColumn("back", bpe.decoded(F.col("ids"), WORDS))
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    for row in out.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert (row["ids"], row["n_tokens"]) == (ids, len(ids))
        assert row["back"] == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    ["It's we'll I'M", "ΣΑΣ. İ ẞ ﬀ ẛ̣", "<|endoftext|>a<|startoftext|> <|endof", "\x1c\x1d a\x1fb", "x\x85y z", "한국어 日本語 ½²", "ab" * 3000, "\U0001f468‍\U0001f469"],
)
def test_encoder(text):
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(WORDS), bpe.encoder(WORDS)
    ids = library.encode(text, add_special_tokens=False).ids
    assert encoder.encode(text) == (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False), len(ids))


def test_encoder_on_every_character():
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(WORDS), bpe.Encoder(WORDS)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c} A{c}" for c in every]
    for begin in range(0, len(texts), 50_000):
        some = texts[begin : begin + 50_000]
        for text, want in zip(some, library.encode_batch(some, add_special_tokens=False), strict=True):
            assert encoder.encode(text)[0] == " ".join(map(str, want.ids)), ascii(text)


def test_encoder_on_strings_of_marks():
    import random
    import unicodedata

    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(WORDS), bpe.Encoder(WORDS)
    draw = random.Random(4)
    marks = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) in ("Mn", "Mc")]
    letters = [chr(c) for c in range(0x3000) if unicodedata.category(chr(c))[0] in "LNPSZ"]
    texts = ["t\u1ac5\u1dd8\u1715"] + [
        "".join(draw.choice(marks if draw.random() < 0.6 else letters) for _ in range(draw.randint(2, 8))) for _ in range(50_000)
    ]
    texts += ["".join(draw.choice(letters[:700]) for _ in range(draw.randint(2, 12))) for _ in range(20_000)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids, tokens, n = encoder.encode(text)
        assert ids == " ".join(map(str, want.ids)), ascii(text)
        assert tokens == library.decode(want.ids, skip_special_tokens=False) and n == len(want.ids)


def test_ids_beside_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "x")], "ids int, text string, n_tokens int, doc string")
    row = bpe.with_ids(docs, "text", WORDS).first()
    assert row.asDict() == {"doc": "x", "n_tokens": 2, "ids": bpe.encoder(WORDS)._ids("a") + bpe.encoder(WORDS)._ids("b")}


def test_quality(odd):
    rows = quality_rules.judge(quality_rules.measures(odd), quality_rules.DecisionList(())).collect()
    assert _texts(rows) == _whole(odd)
    for row in rows:
        want = brute.quality(row["doc"]["text"])
        got = {**row["m"].asDict(), "base_failed": row["base_failed"]}
        assert {name: got[name] for name in want} == want


def test_learned_rules(spark):
    """Junk full of marks, and junk in capitals; two rules tell them from good text."""
    from random import Random

    draw = Random(3)
    word = lambda: "".join(draw.choices("abcdefghij", k=draw.randint(2, 8)))
    rows = []
    for i in range(1200):
        text = [word() for _ in range(draw.randint(60, 120))]
        if i % 3 == 1:
            text = [w + "!!" for w in text]
        if i % 3 == 2:
            text = [w.upper() for w in text]
        rows.append((i, " ".join(text), int(i % 3 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    measured = cut(quality_rules.measures(table.drop("quality")), "measured")
    rules = quality_rules.fit(quality_rules.labelled(measured, table.select("doc_id", "quality")))
    assert len(rules.rules) == 2
    kept = {r["doc"]["doc_id"] for r in quality_rules.judge(measured, rules).where("kept").collect()}
    good = {i for i, _, quality in rows if quality}
    assert len(kept - good) <= 10 and len(good - kept) <= 5


@pytest.mark.parametrize("n_junk", [20, 60])
def test_few_labels_teach_a_rule(spark, n_junk):
    rows = [(i, " ".join(["plain"] * 20 + [f"w{j % 17}{i}" for j in range(60)]), 1) for i in range(n_junk)]
    rows += [(1000 + i, " ".join(f"W{j}{i}!!" for j in range(80)), 0) for i in range(n_junk)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    measured = cut(quality_rules.measures(table), "measured")
    rules = quality_rules.fit(quality_rules.labelled(measured, table))
    assert len(rules.rules) == 1
    assert {r["doc"]["doc_id"] for r in quality_rules.judge(measured, rules).where("rule = 1").collect()} == {r[0] for r in rows if not r[2]}


def test_rules_like_plain_covering(spark):
    """The learned list at two scales, against covering row by row."""
    for sf in ("sf0.001", "sf0.01"):
        folder = f"/root/testdata/{sf}"
        measured = cut(quality_rules.measures(spark.read.parquet(f"{folder}/documents.parquet")), "measured")
        stats = quality_rules.labelled(measured, spark.read.parquet(f"{folder}/labels.parquet"))
        values = stats.select(
            "junk",
            F.xxhash64("key", "m").alias("prunes"),
            *(value.alias(name) for name, value in quality_rules.features(F.col("m")).items()),
        )
        rows = sorted((r.asDict() for r in values.collect()), key=lambda r: (r["junk"], r["prunes"]))
        want = brute.decision_list([{**row, "prunes": place % 3 == 0} for place, row in enumerate(rows)])
        got = quality_rules.fit(stats).rules
        assert [[(c.feature, c.above, c.limit) for c in rule] for rule in got] == want
    assert want  # so few labels already teach something


def test_support_by_chance():
    assert quality_rules._by_chance(5, 0, 0.5) == pytest.approx(1 / 32)
    assert quality_rules._by_chance(2, 1, 0.1) == pytest.approx(3 * 0.01 * 0.9 + 0.001)
    assert quality_rules._by_chance(0, 3, 0.2) == pytest.approx(1)
    assert quality_rules._by_chance(4, 0, 1.0) == 1


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    assert pii.sanitise(none).count() == 0
    assert sharding.shard(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert secret_scan.scan(none).count() == 0
    assert quality_rules.measures(none).count() == 0
    assert simhash.kept_rows(_marked(none), 3).count() == 0
    path = fresh_path(spark, "files")
    token_files.write(none, path, BYTES, end=2)
    assert token_files.read(spark, path).count() == 0
    assert none.select(bpe.encoded(F.col("text"), WORDS)).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.link(vectors).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_stages(spark, odd, empty):
    docs = odd.limit(0) if empty else odd
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        rows = cut(stage(spark, docs, sf), "stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert rows.columns == docs.columns
        if name == "quality rules":  # nothing odd passes the limits
            assert rows.count() == 0
            continue
        assert empty == (rows.count() == 0)
        docs = rows


def test_pipeline_leaves_its_result_only(spark):
    import os

    from reviewmart.workspace import shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and left.pop().startswith("pipeline-byte-pair-encoding")
    assert rows.count() > 0


def test_pipeline(spark):
    """Whole runs against plain versions of what each stage may keep."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, sf), "stage")
        kept[name] = [r.asDict() for r in docs.collect()]
    good = kept["quality rules"]
    assert not any(brute.quality(r["text"])["base_failed"] for r in good)
    prints = {r["doc_id"]: brute.fingerprint(r["text"]) for r in good}
    component = brute.components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    apart = kept["simhash near-duplicates"]
    assert sorted(r["doc_id"] for r in apart) == sorted(set(component.values()))
    assert sorted(r["doc_id"] for r in kept["secret scan"]) == sorted(r["doc_id"] for r in apart)
    assert not any("AKIA" in r["text"] for r in kept["secret scan"])
    mixed = kept["source mixing"]
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in apart}
    # Targets by a plain water level, met by whole copies within half of the longest text.
    size = {r["doc_id"]: len(brute.WORD.findall(r["text"])) for r in kept["secret scan"]}
    source_of = {r["doc_id"]: r["source"] for r in kept["secret scan"]}
    of_source = Counter()
    for i, source in source_of.items():
        of_source[source] += size[i]
    weight = dict(zip(sorted(of_source), [5, 2, 1] * len(of_source), strict=False))
    low, high = 0.0, 2.0 * sum(of_source.values())
    for _ in range(200):
        level = (low + high) / 2
        filled = sum(min(2 * of_source[s], weight[s] * level) for s in of_source)
        low, high = (level, high) if filled < 1.5 * sum(of_source.values()) else (low, level)
    copies = Counter(r["doc_id"] for r in mixed)
    assert max(copies.values()) <= 2
    for source in of_source:
        taken = sum(n * size[i] for i, n in copies.items() if source_of[i] == source)
        longest = max(size[i] for i in size if source_of[i] == source)
        assert abs(taken - min(2 * of_source[source], weight[source] * level)) <= longest / 2 + 1
    encoder, texts = bpe.encoder(WORDS), {r["doc_id"]: r["text"] for r in mixed}
    assert len(kept["byte-pair encoding"]) == len(mixed)
    for row in kept["byte-pair encoding"]:
        assert " ".join(map(str, row["ids"])) == encoder.encode(texts[row["doc_id"]])[0]
