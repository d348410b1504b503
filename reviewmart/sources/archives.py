"""Checking gzip archives before they are staged: all of them in one job, each as a stream.

Spark cannot split an archive, and a reader that skips damaged ones says nothing of what it lost.
Here a task inflates archives block by block, keeps nothing, and tells how far each is sound.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BLOCK = 1 << 20
#: gzip framing in zlib's terms.
_GZIP = 31
_REPORT = pa.schema(
    [
        ("path", pa.string()),
        ("bytes", pa.int64()),
        ("text_bytes", pa.int64()),
        ("broken_at", pa.int64()),
        ("reason", pa.string()),
    ]
)


class Inflater:
    """Takes an archive's blocks in order; ``text_bytes`` is what they inflate to."""

    def __init__(self) -> None:
        self.taken = self.text_bytes = self._member_at = 0
        self.broken_at: int | None = None
        self.reason: str | None = None
        self._member = None
        self._over = False

    def take(self, block: bytes) -> bool:
        """Whether the archive is sound so far."""
        while block and self.broken_at is None:
            if self._over or self._member is None:
                # Between members; zeros may fill up the end of a file.
                rest = block.lstrip(b"\0") if self._over else block
                self.taken += len(block) - len(rest)
                block = rest
                if not block:
                    break
                self._member, self._over, self._member_at = zlib.decompressobj(_GZIP), False, self.taken
            block = self._inflate(block)
        return self.broken_at is None

    def _inflate(self, block: bytes) -> bytes:
        """Feed one member; what is left belongs to the next."""
        before = self._member.copy()
        try:
            data = block
            while data and not self._member.eof:
                # Bounded output, however well the block was compressed.
                self.text_bytes += len(self._member.decompress(data, _BLOCK))
                data = self._member.unconsumed_tail
        except zlib.error as error:
            self._locate(before, block, str(error))
            return b""
        if not self._member.eof:
            self.taken += len(block)
            return b""
        rest = self._member.unused_data
        self.taken += len(block) - len(rest)
        self._over = True
        return rest

    def _locate(self, member, block: bytes, reason: str) -> None:
        """Find the byte within the block: halve it until one is left."""
        low, high = 0, len(block)
        while high - low > 1:
            middle = (low + high) // 2
            tried = member.copy()
            try:
                data = block[low:middle]
                while data:
                    tried.decompress(data, _BLOCK)
                    data = tried.unconsumed_tail
                member, low = tried, middle
            except zlib.error:
                high = middle
        self.broken_at, self.reason = self.taken + low, reason

    def close(self) -> None:
        """The end of the file: a member that is not at its end was cut short."""
        if self.broken_at is None and not self._over and self.taken:
            self.broken_at, self.reason = self.taken, "the archive ends before its data"


def _opened(path: str):
    """A stream over a file where the running task can reach it."""
    from pyarrow import fs

    # Hadoop writes file:/x, others file:///x.
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_stream(inside, buffer_size=_BLOCK, compression=None)


def _checked(path: str) -> dict:
    try:
        stream = _opened(path)
    except Exception as error:  # noqa: BLE001 - stores fail in their own ways; the caller decides
        return {"path": path, "reason": f"not opened: {error}"[:500]}
    archive, size = Inflater(), 0
    with stream:
        while block := stream.read(_BLOCK):
            size += len(block)
            if path.endswith(".gz"):
                archive.take(block)
            else:
                archive.text_bytes += len(block)
    if path.endswith(".gz"):
        archive.close()
    return {
        "path": path,
        "bytes": size,
        "text_bytes": archive.text_bytes,
        "broken_at": archive.broken_at,
        "reason": archive.reason,
    }


def verify(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path``, ``bytes``, ``text_bytes``, and where and why an archive breaks, null if it is sound.

    One job with a task per file. ``bytes`` is null, and the reason says so, where tasks cannot open
    the store without Spark's readers.
    """
    listed = spark.read.format("binaryFile").load(paths).select("path", "length")
    files = [(row["path"],) for row in listed.orderBy(F.desc("length"), "path").collect()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield pa.RecordBatch.from_pylist([_checked(path)], schema=_REPORT)

    # Only this way of making a table puts each file into a task of its own.
    named = spark.sparkContext.parallelize(files, max(1, len(files))).toDF("path string")
    return named.mapInArrow(work, "path string, bytes long, text_bytes long, broken_at long, reason string")
