"""Where archives break, found by streaming, against reading them whole."""

import gzip
import random

import pytest

from reviewmart.sources import archives, readers

draw = random.Random(8)
TEXT = b"".join(b'{"asin": "%d", "title": "%s"}\n' % (i, bytes(draw.choices(b"abcdef", k=30))) for i in range(60_000))
WHOLE = gzip.compress(TEXT)


def _report(data, step=archives._BLOCK):
    archive = archives.Inflater()
    for begin in range(0, len(data), step):
        archive.take(data[begin : begin + step])
    archive.close()
    return archive


@pytest.mark.parametrize("step", [999, 1 << 16, 1 << 20])
def test_sound_archives(step):
    for data in (WHOLE, WHOLE + gzip.compress(b"more"), WHOLE + b"\0" * 5000, gzip.compress(b"") + WHOLE, b""):
        archive = _report(data, step)
        assert archive.broken_at is None
        assert archive.text_bytes == len(gzip.decompress(data) if data else b"")


def test_highly_compressed():
    data = gzip.compress(b"x" * (200 << 20))
    assert _report(data).text_bytes == 200 << 20


@pytest.mark.parametrize("step", [999, 1 << 20])
def test_where_they_break(step):
    assert _report(WHOLE[:1000], step).broken_at == 1000
    assert _report(WHOLE[:-1], step).broken_at == len(WHOLE) - 1
    assert _report(WHOLE + b"garbage", step).broken_at in range(len(WHOLE), len(WHOLE) + 3)
    assert _report(b"no archive at all", step).broken_at in (0, 1)
    wrong_sum = WHOLE[:-8] + bytes(b ^ 255 for b in WHOLE[-8:])
    assert _report(wrong_sum, step).broken_at in range(len(WHOLE) - 8, len(WHOLE))
    damaged = WHOLE[:40_000] + bytes(200) + WHOLE[40_200:]
    at = _report(damaged, step).broken_at
    assert 39_000 <= at <= len(WHOLE)
    # The same byte however the file is read.
    assert at == _report(damaged, 4096).broken_at


def test_one_job_names_them_all(spark, tmp_path):
    damaged = WHOLE[:40_000] + bytes(200) + WHOLE[40_200:]
    files = {"a.jsonl.gz": WHOLE, "b.jsonl.gz": WHOLE[: len(WHOLE) // 2], "c.jsonl.gz": damaged, "d.jsonl": TEXT, "e f.jsonl.gz": WHOLE}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    report = archives.verify(spark, str(tmp_path))
    assert report.rdd.getNumPartitions() == len(files)
    rows = {r["path"].rsplit("/", 1)[-1].replace("%20", " "): r for r in report.collect()}
    assert {name for name, r in rows.items() if r["broken_at"] is not None} == {"b.jsonl.gz", "c.jsonl.gz"}
    assert rows["b.jsonl.gz"]["broken_at"] == len(WHOLE) // 2
    assert rows["a.jsonl.gz"]["text_bytes"] == rows["d.jsonl"]["text_bytes"] == len(TEXT)
    broken = readers.broken_files(spark, str(tmp_path))
    assert [path.rsplit("/", 1)[-1] for path in broken] == ["b.jsonl.gz", "c.jsonl.gz"]


def test_stores_that_tasks_cannot_open_are_read_by_spark(spark, tmp_path, monkeypatch):
    (tmp_path / "a.jsonl.gz").write_bytes(WHOLE)
    (tmp_path / "b.jsonl.gz").write_bytes(WHOLE[:5000])
    unopened = spark.createDataFrame(
        [(f"file:{tmp_path}/{name}", None, None) for name in ("a.jsonl.gz", "b.jsonl.gz")],
        "path string, bytes long, broken_at long",
    )
    monkeypatch.setattr(readers, "verify", lambda *_: unopened)
    assert [path.rsplit("/", 1)[-1] for path in readers.broken_files(spark, str(tmp_path))] == ["b.jsonl.gz"]
