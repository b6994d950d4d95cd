"""Line dedup by an exact set-similarity join.

A line is the set of its lower-cased words.  Two lines match when the Jaccard similarity of their sets is at least
num / den; a line that matches an earlier one, in the order of (doc_id, line number), is removed.  Whether the
earlier line is itself removed makes no difference, so the result depends on no processing order.  Lines of fewer
than min_words distinct words take no part; at EVERY_LINE, only lines without words.

Words are ordered by rarity.  Exact frequencies of an open vocabulary have no size bound, so rarity is that of a
fixed table of 2^22 hash buckets, counted over every word of the corpus: an upper bound of the word's own
frequency.  The table holds the logarithms of the counts in a byte each, 4 MB whatever the corpus holds.  A word's
code is its bucket's byte followed by 56 bits of its hash, so a line sorted by code is sorted by rarity.  Lines of s
words that match share one of their s - ceil(t * s) + 1 rarest words; of those, a word whose bucket has one
occurrence in the whole corpus can't be the shared one and is passed over.

Lines meet by word in parts of hashed words, which get arrays, not rows: a part's task sorts them by word and tests
all later against earlier lines of a word by length, by what can still be shared from the word's places on, and by
the Hamming distance of 128-bit parity sketches of the lines.  Words of very many lines are compared with leading
lines first, and only what these leave over with all.  A task names the most likely earlier lines of a line, not
all; the whole sets of those are compared exactly, and a line with further candidates that none of them settled
gets all its candidates in a second pass.  Equal lines of a run of texts are settled before anything is sent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tableloom.llm import wordscan as ws
from tableloom.llm.linking import sized, unused
from tableloom.scratch import Scratch

U = np.uint64
BITS = 22
SLICES = 32  # of the bucket table, summed apart
LINE = "doc_id long, line_no int"
DEALT = "part long, words array<long>, docs array<long>, numbers array<int>, sizes array<int>, places array<int>, s0 array<long>, s1 array<long>, asks array<byte>"
DEALT_BYTES = 3 << 20  # of text dealt together
PART_BYTES = 8 << 20  # of text whose words one part takes, about
LEAD, LEADERS = 256, 16  # lines of a word from which on leading lines are compared first, and how many
SLICE = 1 << 17  # lines paired together
BEST = 2  # candidates of a line that a part names in the first pass


@dataclass(frozen=True)
class Similar:
    num: int = 4
    den: int = 5
    min_words: int = 5


EVERY_LINE = Similar(min_words=1)  # all lines but those without words


def shown(size: np.ndarray, s: Similar) -> np.ndarray:
    """Of so many of its rarest words a line shares one with every line that it matches."""
    return size - -(-size * s.num // s.den) + 1


def bucket_of(h: np.ndarray) -> np.ndarray:
    return (h & U((1 << BITS) - 1)).astype(np.int64)


def marks(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two buckets of a word's code, among as many, by different bits of its hash."""
    return (word & U((1 << BITS) - 1)).astype(np.int64), (word >> U(BITS) & U((1 << BITS) - 1)).astype(np.int64)


def marked(word: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether both buckets of words are in a table of flags, bit 1 and bit 2."""
    first, second = marks(word)
    out = (table[first] & 1) > 0
    at = np.flatnonzero(out)
    out[at] = (table[second[at]] & 2) > 0
    return out


def rarities(docs: DataFrame) -> tuple[np.ndarray, int]:
    """A byte per hash bucket: eight times the binary logarithm of its words' occurrences in all texts, 0 for one; and the texts' bytes."""
    width = (1 << BITS) // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size = np.zeros(1 << BITS, np.int32), 0
        for batch in batches:
            for _, _, data, at in ws.chunks(batch.column(0)):
                size += len(data)
                bucket = np.sort(bucket_of(ws.hashes(data, *ws.words(data, at))).astype(np.uint32))
                first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
                total[bucket[first]] += np.diff(np.r_[first, len(bucket)]).astype(np.int32)
            ws.trim()
        full = np.flatnonzero(total)
        ends = np.searchsorted(full, np.arange(SLICES + 1) * width).astype(np.int32)
        column = lambda x: pa.ListArray.from_arrays(pa.array(ends), pa.array(x, pa.int32()))
        sizes = np.where(np.arange(SLICES) == 0, size, 0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLICES, dtype=np.int32)), column(full), column(total[full]), pa.array(sizes)], ["slice", "buckets", "n", "bytes"])

    def add(table: pa.Table) -> pa.Table:
        k, total = table["slice"][0].as_py(), np.zeros(width, np.int64)
        for buckets, n in zip(table["buckets"], table["n"], strict=True):
            total[buckets.values.to_numpy() - k * width] += n.values.to_numpy()
        return pa.table({"slice": pa.array([k], pa.int32()), "logs": pa.array([np.minimum(255, np.rint(8 * np.log2(np.maximum(total, 1)))).astype(np.uint8).tobytes()]), "bytes": pa.array([sum(table["bytes"].to_pylist())], pa.int64())})

    out, size = np.zeros(1 << BITS, np.uint8), 0
    counts = docs.select("text").mapInArrow(count, "slice int, buckets array<int>, n array<int>, bytes long")
    for row in counts.groupBy("slice").applyInArrow(add, "slice int, logs binary, bytes long").toArrow().to_pylist():
        out[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["logs"], np.uint8)
        size += row["bytes"]
    return out, size


def word_codes(h: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return (rank[bucket_of(h)].astype(U) << U(56)) | (h >> U(8))


def split_lines(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where lines start, a text's first one included even if it is empty, and the index of each text's first line."""
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.concatenate([at[:-1], breaks])
    owner = np.concatenate([np.arange(len(at) - 1), np.searchsorted(at, breaks - 1, "right") - 1])
    order = np.lexsort((np.arange(len(starts)) >= len(at) - 1, starts, owner))
    return starts[order], np.searchsorted(owner[order], np.arange(len(at)))


def by_line(line: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    """The order of words by line and code: one sort of both in 64 bits, checked, else a sort by each."""
    bits = U(max(1, n.bit_length()))
    order = np.argsort((line.astype(U) << (U(64) - bits)) | (code >> bits))
    line, code = line[order], code[order]
    sorted_ = (line[1:] > line[:-1]) | ((line[1:] == line[:-1]) & (code[1:] >= code[:-1]))
    if not sorted_.all():  # codes of a line that differ in their last bits only
        order = order[np.lexsort((code, line))]
    return order


class Lines:
    """The distinct word codes of the lines of some texts, rarest first in each line."""

    def __init__(self, data: np.ndarray, at: np.ndarray, rank: np.ndarray, whole: bool = False):
        """whole: each text is one line."""
        starts, first = (at[:-1], np.arange(len(at))) if whole else split_lines(data, at)
        self.n = len(starts)
        self.doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
        self.line_no = np.arange(self.n) - first[self.doc]
        begin, end = ws.words(data, at)
        h = ws.hashes(data, begin, end)
        code = word_codes(h, rank)
        line = self._line_of(begin, starts)
        order = by_line(line, code, self.n)
        code, line = code[order], line[order]
        new = np.r_[True, (code[1:] != code[:-1]) | (line[1:] != line[:-1])] if len(code) else np.zeros(0, bool)
        self.code, self.line = code[new], line[new]
        self.size = np.bincount(self.line, minlength=self.n)
        self.first = np.r_[0, np.cumsum(self.size)]

    def _line_of(self, begin: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(starts, begin, "right") - 1

    def totals(self) -> list[np.ndarray]:
        """Two sums, modulo 2^64, of mixed words by line."""
        self.mixed = ws.mix(self.code)
        out = []
        for values in (self.mixed, (self.mixed ^ (self.mixed >> U(29))) * U(0x9FB21C651E98DF25)):
            run = np.r_[U(0), np.cumsum(values, dtype=U)]
            out.append(run[self.first[1:]] - run[self.first[:-1]])
        return out

    def sketch(self) -> list[np.ndarray]:
        """The parity of the words that fall on each of 128 bits, in two halves."""
        bit = self.mixed >> U(20) & U(127)
        out = []
        for half in (0, 1):
            run = np.r_[U(0), np.bitwise_xor.accumulate(np.where(bit >> U(6) == half, U(1) << (bit & U(63)), U(0)))] if len(bit) else np.zeros(1, U)
            out.append(run[self.first[1:]] ^ run[self.first[:-1]])
        return out


def lines_with(column: pa.Array, buckets: np.ndarray, rank: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets, row from the first on, line number) of the lines that have a word of these buckets."""
    for lo, hi, data, at in ws.chunks(column):
        starts, first = split_lines(data, at)
        begin, end = ws.words(data, at)
        hit = marked(word_codes(ws.hashes(data, begin, end), rank), buckets)
        line = np.unique(np.searchsorted(starts, begin[hit], "right") - 1)
        if len(line):
            doc = np.searchsorted(first, line, "right") - 1
            stop = np.where(line + 1 < first[doc + 1], np.r_[starts, 0][line + 1] - 1, at[doc + 1])
            offsets = np.r_[0, np.cumsum(stop - starts[line])]
            place = np.repeat(starts[line] - offsets[:-1], stop - starts[line]) + np.arange(offsets[-1])
            yield lo, hi, data[place], offsets, doc, line - first[doc]


def deal(docs: DataFrame, rank: Broadcast, s: Similar, parts: int, only: Broadcast | None = None) -> DataFrame:
    """docs (doc_id, text, wanted array<int>) as arrays of line places by part of their rarest words.

    Of the equal lines of a run of texts the first is sent; the others are removed at once, in part -1, unless a
    list of wanted lines restricts the search to those; only then tells which buckets have their words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            runs = ws.chunks(batch.column(1), DEALT_BYTES) if only is None else lines_with(batch.column(1), only.value, rank.value)
            for lo, hi, data, at, *line in runs:
                x = Lines(data, at, rank.value, whole=only is not None)
                if only is not None:
                    x.doc, x.line_no = line
                keep = np.flatnonzero(x.size >= s.min_words)
                if not len(keep):
                    continue
                doc, number, size = ids[lo:hi][x.doc[keep]], x.line_no[keep], x.size[keep]
                a, b = x.totals()
                part = batch.column(2).slice(lo, hi - lo)
                if only is not None:  # a second pass
                    asked = {(d, i) for d, own in zip(ids[lo:hi].tolist(), part.to_pylist(), strict=True) for i in own or ()}
                    asks = np.fromiter(((d, i) in asked for d, i in zip(doc.tolist(), number.tolist(), strict=True)), bool, len(doc))
                    first, copy = np.ones(len(doc), bool), np.zeros(len(doc), bool)
                else:
                    a, b = a[keep], b[keep]
                    order = np.lexsort((number, doc, b, a))
                    new = np.r_[True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])]
                    head = np.empty(len(keep), np.int64)
                    head[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
                    first = head == np.arange(len(keep))
                    copy = ~first & ~((doc == doc[head]) & (number == number[head]))
                    asks = first
                many = np.where(first, shown(size, s), 0)
                ends = np.r_[0, np.cumsum(many)]
                owner = np.repeat(np.arange(len(keep)), many)
                pos = np.arange(ends[-1]) - ends[:-1][owner]
                word = x.code[x.first[keep][owner] + pos]
                again = word >> U(56) > 0 if only is None else marked(word, only.value)
                owner, pos, word = owner[again], pos[again], word[again]
                to = (ws.mix(word) % U(parts)).astype(np.int64)
                order = np.argsort(to << 32 | np.arange(len(to)))
                owner, pos, word, to = owner[order], pos[order], word[order], to[order]
                gone = np.flatnonzero(copy)
                bounds = np.searchsorted(to, np.arange(parts + 1)) + len(gone)
                none = np.zeros(len(gone), np.int64)
                rows = np.r_[gone, owner]
                cut = np.unique(np.r_[0, bounds]).astype(np.int32)
                name = np.r_[none - 1, to][cut[:-1]]
                column = lambda y, kind: pa.ListArray.from_arrays(pa.array(cut), pa.array(y, kind))
                yield pa.RecordBatch.from_arrays([pa.array(name), column(ws.signed(np.r_[none.astype(U), word]), pa.int64()), column(doc[rows], pa.int64()), column(number[rows].astype(np.int32), pa.int32()), column(size[rows].astype(np.int32), pa.int32()), column(np.r_[none, pos].astype(np.int32), pa.int32()), *(column(ws.signed(y[keep][rows]), pa.int64()) for y in x.sketch()), column(asks[rows].astype(np.int8), pa.int8())], [f.split()[0] for f in DEALT.split(", ")])
            ws.trim()

    return docs.filter("doc_id is not null").mapInArrow(run, DEALT)


def by_group(word: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The order by word and size (of less than 2^31 each)."""
    order = np.argsort(word)
    group = np.cumsum(np.r_[False, word[order][1:] != word[order][:-1]]) if len(word) else order
    return order[np.argsort(group << 32 | size[order])]


class Meeting:
    """The lines of some words, sorted by word and size, and which pairs of them may match."""

    def __init__(self, columns: list[np.ndarray], s: Similar):
        word, doc, number, size, pos, s0, s1, asks = columns
        order = by_group(word, size)
        self.s, self.word, self.doc, self.number = s, word[order], doc[order], number[order]
        self.size, self.rest = size[order].astype(np.int64), (size - pos)[order].astype(np.int64)
        self.s0, self.s1, self.asks = s0.view(U)[order], s1.view(U)[order], asks[order] > 0
        first = np.flatnonzero(np.r_[True, self.word[1:] != self.word[:-1]]) if len(word) else np.zeros(0, np.int64)
        self.begin, self.end = first, np.r_[first[1:], len(word)].astype(np.int64)

    def close(self, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the pairs those that pass the filters, with the Hamming distance of their sketches."""
        num, den = self.s.num, self.s.den
        a, b = self.size[u], self.size[v]
        shared = -(-(a + b) * num // (num + den))
        ok = np.flatnonzero((np.minimum(a, b) * den >= np.maximum(a, b) * num) & (np.minimum(self.rest[u], self.rest[v]) >= shared))
        u, v = u[ok], v[ok]
        apart = np.bitwise_count(self.s0[u] ^ self.s0[v]).astype(np.int64) + np.bitwise_count(self.s1[u] ^ self.s1[v])
        ok = (apart <= (a + b - 2 * shared)[ok]) & ((self.doc[u] != self.doc[v]) | (self.number[u] != self.number[v]))
        return u[ok], v[ok], apart[ok]

    def later(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        return (self.doc[u] > self.doc[v]) | ((self.doc[u] == self.doc[v]) & (self.number[u] > self.number[v]))

    def lead(self, begin: int, end: int, asks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
        """Meets a frequent word's lines with leading ones, each the earliest line that passes with none before it; those that pass ask no more."""
        rest = begin + np.lexsort((self.number[begin:end], self.doc[begin:end]))
        for _ in range(LEADERS):
            lead, rest = rest[0], rest[1:]
            found = self.close(np.full(len(rest), lead), rest)
            keep = asks[found[1]]
            yield (*(x[keep] for x in found), True)
            gone = np.zeros(end - begin, bool)
            gone[found[1] - begin] = True
            asks[found[1]] = False
            rest = rest[~gone[rest - begin]]
            if not len(rest):
                break

    def pairs(self, lead_from: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
        """Pairs that pass, u earlier, and whether that is all that v was compared with.

        A word of more than lead_from lines is met by leading lines first: a line that passes with one waits for the
        exact comparison; all others meet every line before them.  Only lines of sizes that can match are paired: a
        line is tested against the larger ones next to it, until one is too large.
        """
        num, den, asks = self.s.num, self.s.den, self.asks.copy()
        for k in np.flatnonzero(self.end - self.begin > lead_from):
            yield from self.lead(int(self.begin[k]), int(self.end[k]), asks)
        last = np.repeat(self.end, self.end - self.begin)  # of each line's word
        for i in range(0, len(last), SLICE):
            active, step = np.arange(i, min(i + SLICE, len(last))), 1
            while len(active):
                active = active[active + step < last[active]]
                active = active[self.size[active] * den >= self.size[active + step] * num]
                swap = self.later(active, active + step)
                u, v = np.where(swap, active + step, active), np.where(swap, active, active + step)
                asked = asks[v]
                if asked.any():
                    yield (*self.close(u[asked], v[asked]), False)
                step += 1


def meet(s: Similar, best: int | None) -> Callable[[pa.Table], pa.Table]:
    """Pairs (u, v), u earlier, of a part's lines that may match: for each v the best ones, or all."""

    def run(table: pa.Table) -> pa.Table:
        columns = [np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table[name].chunks]) for name in (f.split()[0] for f in DEALT.split(", ")[1:])]
        if table["part"][0].as_py() < 0:
            none = pa.nulls(len(columns[0]), pa.int64())
            return pa.table({"u_doc": none, "u_line": none.cast(pa.int32()), "v_doc": columns[1], "v_line": columns[2], "more": np.zeros(len(columns[1]), bool)})
        x = Meeting(columns, s)
        found = [(u, v, apart, np.full(len(u), partly)) for u, v, apart, partly in x.pairs(LEAD if best else len(columns[0])) if len(u)]
        u, v, apart, partly = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 4
        place = np.unique(x.doc, return_inverse=True)[1][v] << 32 | x.number[v].astype(np.int64)
        line = np.unique(place, return_inverse=True)[1]
        order = np.argsort(line << 40 | apart.astype(np.int64) << 32 | u)  # fewer than 2^23 lines and 2^32 places
        u, v, place, partly = u[order], v[order], place[order], partly[order].astype(bool)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(v) else v
        count = np.diff(np.r_[first, len(v)])
        nth = np.arange(len(v)) - np.repeat(first, count)
        named = np.full(len(first), best or len(v))
        if best:  # where the best candidate is a close one, it is enough
            size = x.size[u[first]] + x.size[v[first]]
            named[apart[order][first] * 3 <= size - 2 * -(-size * s.num // (s.num + s.den))] = 1
        more = np.repeat((count > named) | (np.logical_or.reduceat(partly, first) if len(v) else partly), count)
        take = nth < np.repeat(named, count)
        u, v, more = u[take], v[take], more[take]
        out = pa.table({"u_doc": x.doc[u], "u_line": x.number[u], "v_doc": x.doc[v], "v_line": x.number[v], "more": more})
        del x, found
        ws.trim()
        return out

    return run


def wanted_lines(column: pa.Array, wanted: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, line number, bytes, offsets) of the lines of texts that each row's list of numbers asks for, and has."""
    for lo, hi, data, at in ws.chunks(column):
        starts, first = split_lines(data, at)
        part = wanted.slice(lo, hi - lo)
        owner = np.repeat(np.arange(hi - lo), part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        number = part.flatten().to_numpy(zero_copy_only=False)
        there = first[owner] + number < first[owner + 1]  # a repeated doc_id may have fewer lines
        owner, number = owner[there], number[there]
        if not len(owner):
            continue
        line = first[owner] + number
        begin = starts[line]
        end = np.where(line + 1 < first[owner + 1], np.r_[starts, 0][line + 1] - 1, at[owner + 1])
        offsets = np.r_[0, np.cumsum(end - begin)]
        place = np.repeat(begin - offsets[:-1], end - begin) + np.arange(offsets[-1])
        yield owner + lo, number, data[place], offsets


def line_sets(docs: DataFrame, rank: Broadcast) -> DataFrame:
    """The word codes of the lines that docs (doc_id, text, wanted array<int>) asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, number, data, at in wanted_lines(batch.column(1), batch.column(2)):
                x = Lines(data, at, rank.value, whole=True)
                codes = pa.ListArray.from_arrays(pa.array(x.first.astype(np.int32)), pa.array(ws.signed(x.code)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(number.astype(np.int32)), codes], ["doc_id", "line_no", "codes"])
            ws.trim()

    return docs.select("doc_id", "text", "wanted").mapInArrow(run, f"{LINE}, codes array<long>")


def buckets_of_lines(docs: DataFrame, rank: Broadcast, s: Similar) -> np.ndarray:
    """Which buckets have one of the rarest words of the lines that docs (doc_id, text, wanted) asks for; the driver gets 8 million numbers at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, at in wanted_lines(batch.column(0), batch.column(1)):
                x = Lines(data, at, rank.value, whole=True)
                place = np.arange(len(x.code)) - np.repeat(x.first[:-1], x.size)
                word = x.code[place < np.repeat(shown(x.size, s), x.size)]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate([k << BITS | y for k, y in enumerate(marks(word))])).astype(np.int32))], ["bucket"])
            ws.trim()

    out = np.zeros(1 << BITS, np.uint8)
    found = docs.select("text", "wanted").mapInArrow(run, "bucket int").distinct().toArrow()["bucket"].to_numpy()
    out[found[found < 1 << BITS]] |= 1
    out[found[found >= 1 << BITS] & ((1 << BITS) - 1)] |= 2
    return out


def later_matches(docs: DataFrame, s: Similar | None = None) -> DataFrame:
    """(doc_id, line_no from 0) of every line of docs (doc_id, text) that matches an earlier line.

    Lines end at a line feed.  Null and empty texts have no line that takes part; neither has a row without
    doc_id.  Rows that repeat a doc_id are the same document: equal places are not earlier than each other.
    """
    s = s or Similar()
    spark = docs.sparkSession
    scratch = Scratch(spark, "line-dedup")
    ws.small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    logs, size = rarities(docs)
    rank, parts = spark.sparkContext.broadcast(logs), max(4, -(-size // PART_BYTES))
    fields = "u_doc long, u_line int, v_doc long, v_line int, more boolean"
    u, v, ends = ["u_doc", "u_line"], ["v_doc", "v_line"], ["doc_id", "line_no"]

    def candidates(docs: DataFrame, best: int | None, name: str, only: Broadcast | None = None) -> DataFrame:
        return scratch.save(deal(docs, rank, s, parts, only).groupBy("part").applyInArrow(meet(s, best), fields), name)

    def asked(lines: DataFrame) -> DataFrame:
        """Lines (doc_id, line_no) as lists by document, to be broadcast if they are few."""
        return lines.groupBy("doc_id").agg(F.collect_list("line_no").alias("wanted"))

    def joined(lists: DataFrame) -> DataFrame:
        """The lists, to be broadcast if they are known to be small."""
        return sized(lists, rows=lists.agg(F.count("*") * 2 + F.sum(F.size("wanted"))).first()[0])

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        """The later lines of the pairs (u, v), u earlier, whose whole sets match."""
        pairs = scratch.save(pairs.select(*u, *v).distinct(), f"pairs-{name}")
        lines = pairs.select(*(F.col(a).alias(b) for a, b in zip(u, ends, strict=True))).unionAll(pairs.select(*(F.col(a).alias(b) for a, b in zip(v, ends, strict=True)))).distinct()
        lists = scratch.save(asked(lines), f"ends-{name}")
        sets = scratch.save(line_sets(docs.join(joined(lists), "doc_id"), rank), f"sets-{name}")
        side = lambda k, names: sets.select(*(F.col(a).alias(b) for a, b in zip(ends, names, strict=True)), F.col("codes").alias(k))
        common = F.size(F.array_intersect("eu", "ev"))
        found = pairs.join(side("ev", v), v).join(side("eu", u), u).filter(common * s.den >= (F.size("eu") + F.size("ev") - common) * s.num)
        found = scratch.save(found.select(*v).distinct(), f"found-{name}")
        scratch.drop(f"sets-{name}", f"ends-{name}", f"pairs-{name}")
        return found

    met = candidates(docs.withColumn("wanted", F.lit(None).cast("array<int>")), BEST, "met")
    scratch.release()
    settled = "u_doc is null"
    gone = met.filter(settled).select(*v).unionByName(verify(met.filter(f"not ({settled})"), "best"))
    # Lines with more candidates than the best ones, none of which matched, meet all of them.
    again = met.filter("more").select(*v).distinct().join(gone.distinct(), v, "left_anti")
    again = scratch.save(asked(again.select(F.col("v_doc").alias("doc_id"), F.col("v_line").alias("line_no"))), "again")
    if not again.isEmpty():
        scratch.release()
        few = joined(again)
        only = spark.sparkContext.broadcast(buckets_of_lines(docs.join(few, "doc_id"), rank, s))
        wanted = docs.join(few, "doc_id", "left").select("doc_id", "text", F.coalesce("wanted", F.array().cast("array<int>")).alias("wanted"))
        gone = gone.unionByName(verify(candidates(wanted, None, "met-again", only), "again"))
    return gone.select(F.col("v_doc").alias("doc_id"), F.col("v_line").alias("line_no")).distinct()


def dedup_lines(docs: DataFrame, s: Similar | None = None, counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """docs without the lines of their text that match an earlier line; all rows, columns and their order stay.

    Adds n_lines and n_removed, or what counts names; docs' own columns of those names go.  The kept lines keep their
    text and order; a text all of whose lines go is empty, a null text stays null, a row without doc_id stays as it is.
    """
    free = unused([*docs.columns, *counts])
    key, numbers = next(free), next(free)
    scratch = Scratch(docs.sparkSession, "line-dedup-gone")
    gone = later_matches(docs, s).groupBy("doc_id").agg(F.collect_set("line_no").alias(numbers)).withColumnRenamed("doc_id", key)
    gone = scratch.save(gone, "gone")
    gone = sized(gone, rows=gone.agg(F.count("*") * 2 + F.sum(F.size(numbers))).first()[0])
    spared = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(numbers, i))
    out = docs.join(gone, docs["doc_id"].cast("long") == gone[key], "left")
    own = docs["text"]  # by name it would be the new text
    n_lines = F.when(own.isNull(), 0).otherwise(F.octet_length(own) - F.octet_length(F.replace(own, F.lit("\n"), F.lit(""))) + 1).cast("long")
    # All numbers are lines of the text but where texts share a doc_id.
    n_gone = F.when(F.col(numbers).isNull() | own.isNull(), 0).when(F.array_max(numbers) < n_lines, F.size(numbers)).otherwise(F.size(F.filter(numbers, lambda i: i < n_lines))).cast("long")
    text = F.when(F.col(numbers).isNull(), F.col("text")).otherwise(F.array_join(spared, "\n"))
    return out.select(*(text.alias("text") if c == "text" else docs[c] for c in docs.columns if c not in counts), n_lines.alias(counts[0]), n_gone.alias(counts[1]))
