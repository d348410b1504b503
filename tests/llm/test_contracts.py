"""Every numbered query over its table against a plain version, and over odd rows."""

import hashlib
import zlib
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
from samples import SF
from tokenizers import Tokenizer

import __spark_entry__ as contract

NAMES = {name.split("_")[0]: name for name in contract.queries() if name.startswith("op")}


@pytest.fixture(scope="module")
def docs():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall())


@pytest.fixture(scope="module")
def result(spark):
    kept = {}

    def of(op):
        if op not in kept:
            kept[op] = [r.asDict() for r in contract.queries()[NAMES[op]](spark, SF).collect()]
        return kept[op]

    return of


def test_all_and_the_pipeline():
    assert sorted(NAMES, key=lambda n: int(n[2:])) == [f"op{n}" for n in range(1, 14)]
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("op", [f"op{n}" for n in (1, 2, 3, 5, 6, 7, 8, 9, 10, 11)])
def test_one_row_per_document(result, docs, op):
    assert sorted(r["doc_id"] for r in result(op)) == sorted(docs)


@pytest.mark.parametrize(("op", "kinds", "found"), [("op1", brute.PERSONAL, brute.personal), ("op8", brute.SECRET, brute.secrets)])
def test_spans(result, docs, op, kinds, found):
    for row in result(op):
        spans = found(docs[row["doc_id"]])
        assert row["base_sha256"] == brute.digest(spans)
        assert {k: row[f"n_{k}"] for k in kinds} == {k: sum(s[0] == k for s in spans) for k in kinds}
        listed = row["spans"].split(",") if row["spans"] else []
        assert set(f"{k}:{s}:{e}" for k, s, e in spans) <= set(listed)


def test_shards(result, docs):
    rows, shards = result("op2"), defaultdict(list)
    for row in rows:
        data = docs[row["doc_id"]].encode()
        assert (row["size"], row["text_crc32"], row["law"]) == (len(data) + 16, zlib.crc32(data), "bytes")
        assert row["grown_shard"] is None
        shards[row["shard"]].append(row)
    assert set(shards) <= set(range(40))
    for members in shards.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    largest = max(r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    for members in shards.values():
        assert abs(sum(r["size"] for r in members) - total / 40) <= largest + 0.05 * total / 40


def test_token_files(result, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_id, start = {r["doc_id"]: r for r in result("op3")}, 0
    for doc_id, text in docs.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want = {"doc_id": doc_id, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(ids, "<u4"))}
        assert by_id[doc_id] == want
        start += len(ids)


def test_embeddings(result):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY 1").fetchall()
    ids = [i for i, _ in rows]
    vectors = np.array([v for _, v in rows], np.float64)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    close = vectors @ vectors.T >= 0.9
    component = brute.components(range(len(ids)), lambda a, b: close[a, b])
    want = {ids[i]: (close[i].sum() - 1, ids[component[i]]) for i in range(len(ids))}
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in result("op4")} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in result("op4"))


def test_simhash(result, docs):
    prints = {i: brute.fingerprint(t) for i, t in docs.items()}
    component = brute.components(docs, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in result("op5")}
    assert got == {i: (f"{prints[i]:016x}", component[i]) for i in docs}


def test_mixing(result):
    rows = duckdb.sql(f"SELECT doc_id, source, text FROM '{SF}/documents.parquet'").fetchall()
    size = {i: len(brute.WORD.findall(t)) for i, _, t in rows}
    of_source = Counter()
    for i, source, _ in rows:
        of_source[source] += size[i]
    weight = dict(zip(sorted(of_source), [5, 2, 1] * len(of_source), strict=False))
    target, left, free = {}, 1.5 * sum(size.values()), set(of_source)
    while True:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 2 * of_source[s]}
        if not full:
            break
        target |= {s: 2.0 * of_source[s] for s in full}
        free -= full
        left -= sum(2 * of_source[s] for s in full)
    target |= {s: weight[s] * level for s in free}
    source_of, taken = {i: s for i, s, _ in rows}, Counter()
    for row in result("op7"):
        source = source_of[row["doc_id"]]
        assert (row["size"], row["source_size"]) == (size[row["doc_id"]], of_source[source])
        assert row["target"] == pytest.approx(target[source])
        assert row["taken"] in (0, row["size"], 2 * row["size"])
        taken[source] += row["taken"]
    for source in target:
        largest = max(size[i] for i in size if source_of[i] == source)
        assert abs(taken[source] - target[source]) <= largest / 2


def test_bpe(result, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for row in result("op9"):
        ids = tokenizer.encode(docs[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert row["decoded_sha256"] == sha(tokenizer.decode(ids, skip_special_tokens=False))


def test_quality(result, docs):
    for row in result("op10"):
        want = brute.quality(docs[row["doc_id"]])
        assert {name: row[name] for name in want} == want
        assert not (row["base_failed"] and row["kept"])


def test_languages(result):
    rows = duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall()
    got = {r["doc_id"]: r for r in result("op11")}
    held = [(i, lang) for i, lang in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r["held_out"]} == {i for i, _ in held}
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert sum(got[i]["lang_pred"] == lang for i, lang in held) >= 0.97 * len(held)


def test_prefixes(result):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    key = lambda r: sorted(r.items(), key=str)
    assert sorted(map(str, map(key, result("op12")))) == sorted(str(key(r)) for r in brute.prefix_nodes(rows))


def test_search(result, docs):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in result("op13")]
    assert sorted(got) == sorted(brute.best_documents(docs.items(), items))


def test_reruns_agree(spark, result):
    for op in ("op2", "op7", "op11"):
        again = contract.queries()[NAMES[op]](spark, SF).repartition(3).collect()
        key = lambda r: sorted(r.items(), key=str)
        assert sorted(map(str, map(key, result(op)))) == sorted(str(key(r.asDict())) for r in again)
