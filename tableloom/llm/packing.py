"""Packing documents into training sequences with a bounded number of open windows.

Each partition keeps a fixed number of open windows.  A document is cut into whole sequences as long as it has
that many tokens; what remains goes best-fit into the open window that it leaves fullest.  When none has the room
and no further window may be opened, the fullest one is topped up with the head of the piece and emitted.  The
windows still open at a partition's end are merged the same way, a bounded number of partitions at a time, until
one group is left; its last window is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tableloom.llm import wordscan as ws
from tableloom.llm.tokens import Vocabulary, encoder
from tableloom.scratch import Scratch

FAN_IN = 64  # partitions merged by one task
END = 1
FIELDS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, open int, ids binary"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]


class Windows:
    """Open windows of at most length tokens; emitted pieces gather in rows."""

    def __init__(self, length: int, most: int, first_id: int, keep_ids: bool):
        self.length, self.most, self.next, self.keep = length, most, first_id, keep_ids
        self.open: list[tuple[int, list]] = []  # tokens used, pieces
        self.rows: list[tuple] = []

    def _row(self, piece: tuple, sequence: int, offset: int, window: int | None) -> None:
        doc, start, ids, total = piece
        raw = ids.astype("<u4").tobytes()
        self.rows.append((doc, start, len(ids), zlib.crc32(raw), total, sequence, offset, window, raw if window is not None or self.keep else None))

    def emit(self, pieces: list, window: int | None = None) -> None:
        offset = 0
        for piece in pieces:
            self._row(piece, self.next, offset, window)
            offset += len(piece[2])
        self.next += 1

    def add(self, doc: int | None, ids: np.ndarray, start: int, total: int) -> None:
        while len(ids) >= self.length:
            self.emit([(doc, start, ids[: self.length], total)])
            ids, start = ids[self.length :], start + self.length
        while len(ids):
            best, room = -1, self.length + 1
            for k, (used, _) in enumerate(self.open):
                left = self.length - used
                if len(ids) <= left < room:
                    best, room = k, left
            if best < 0 and len(self.open) < self.most:
                self.open.append((len(ids), [(doc, start, ids, total)]))
                return
            if best < 0:  # the fullest takes what it has room for
                best = max(range(len(self.open)), key=lambda k: self.open[k][0])
            used, pieces = self.open[best]
            n = min(len(ids), self.length - used)
            pieces.append((doc, start, ids[:n], total))
            if used + n == self.length:
                self.emit(pieces)
                del self.open[best]
            else:
                self.open[best] = (used + n, pieces)
            ids, start = ids[n:], start + n

    def leave(self) -> None:
        """Hands the open windows on, as leftovers."""
        for k, (_, pieces) in enumerate(self.open):
            self.emit(pieces, k)
        self.open = []

    def finish(self) -> None:
        """Fills window after window with all that is left; the last is cut at powers of two."""
        pieces = [p for _, w in self.open for p in w]
        left = sum(len(p[2]) for p in pieces)
        while left:
            size = self.length if left >= self.length else 1 << (left.bit_length() - 1)
            mine, need = [], size
            while need:
                doc, start, ids, total = pieces.pop(0)
                n = min(need, len(ids))
                mine.append((doc, start, ids[:n], total))
                if n < len(ids):
                    pieces.insert(0, (doc, start + n, ids[n:], total))
                need -= n
            self.emit(mine)
            left -= size
        self.open = []

    def table(self) -> pa.Table:
        rows, self.rows = self.rows, []
        columns = zip(*rows, strict=True) if rows else [[]] * len(NAMES)
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)


def pack(docs: DataFrame, vocabulary: Vocabulary, length: int = 2048, windows: int = 32, keep_ids: bool = False) -> DataFrame:
    """Pieces of all rows of docs (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A document is its ids and then END; a null or empty text is END alone.  Each id lies in exactly one piece,
    pieces of a sequence lie at gapless offsets from 0, every sequence has length ids but for the last few, which
    have a power of two.  ids holds a piece's ids as little-endian unsigned 32-bit integers if keep_ids, else
    null.  Rows that repeat a doc_id, or have none, are documents of their own.  No rows give no pieces.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    ws.small_batches(spark)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        out = Windows(length, windows, TaskContext.get().partitionId() << 32, keep_ids)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(coder.ids(text.as_py()), np.uint32(END))
                out.add(doc, ids, 0, len(ids))
                if len(out.rows) > 5000:
                    yield from out.table().to_batches()
            ws.trim()
        out.leave()
        yield from out.table().to_batches()

    def merge(level: int, last: bool) -> Callable[[pa.Table], pa.Table]:
        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
            out = Windows(length, windows, (level << 56) + (table["part"][0].as_py() << 32), keep_ids)
            for doc, start, total, ids in zip(*(table[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True):
                out.add(doc, np.frombuffer(ids, "<u4"), start, total)
            if last:
                out.finish()
            else:
                out.leave()
            return out.table()

        return run

    found = scratch.save(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(fill, FIELDS), "pieces-0")
    whole = [found.filter("open is null")]
    level = 0
    while True:
        level += 1
        rest = found.filter("open is not null")
        part = F.shiftrightunsigned(F.col("sequence_id").bitwiseAND((1 << 56) - 1), 32)
        parts = rest.agg(F.max(part)).first()[0]
        if parts is None:
            break
        groups = rest.withColumn("part", F.floor(part / FAN_IN).cast("long")).groupBy("part")
        found = scratch.save(groups.applyInArrow(merge(level, parts < FAN_IN), FIELDS), f"pieces-{level}")
        whole.append(found.filter("open is null"))
        if parts < FAN_IN:
            break
    out = whole[0]
    for more in whole[1:]:
        out = out.unionByName(more)
    return out.drop("open")
