"""Language-model scores by context-tree weighting over bytes.

A text is the byte string of its lower-cased words, a space between two and a line feed at the end.  Every byte is
eight binary decisions; each of the 255 nodes of that binary tree has its own context tree over the preceding
bytes, to a fixed depth.  A context node holds counts (a, b) of the two decisions and the Krichevsky-Trofimov
block probability Pe(a, b); the weighted probability is Pw = Pe at full depth and (Pe + product of the children's
Pw) / 2 above.  Pe depends on the counts only, so the trees of a whole corpus follow from its n-gram counts, with
no sequential pass.  The next decision's probability mixes the estimates of all depths on its path with the
weights Pe / (2 Pw).  A context that training never reached takes its parent's estimate.  Code length per byte is
-log2 of the product over the text's bytes.

Spark's part: texts are hashed into blocks of bounded size.  A block counts its distinct n-grams and words and deals
them, as sorted, compressed arrays of keys and counts, to groups of trees.  An n-gram's key has its most recent context
byte first, so every context of every depth, and every binary node under it, is a run of the sorted keys.  Trees are
dealt by the last two context bytes, as evenly as a histogram of byte pairs tells; a pair too frequent for one task
is split by the third byte, and its nodes of depth 2 are summed over its tasks.  Depths 1 and 0 have at most
257 * 255 nodes, which go to every task whatever the corpus holds.  The values of the keys return to each
block as arrays in the order of the keys that it sent, so no row is made per key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heapreplace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tableloom.llm import wordscan as ws
from tableloom.scratch import Scratch

U = np.uint64
GRAM, WORD = 0, 1
TREE_BYTES = 8 << 20  # of text whose n-grams one task's trees hold, about
CHUNK = 1 << 19  # bytes of text looked at together; a longer text is looked at in pieces
LOG_HALF = float(np.log(0.5))
SENT = "block long, kind byte, part long, keys binary, n binary"
BACK = "block long, kind byte, part long, values binary"


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x >= 1/2, by Stirling's series after moving up by the recurrence."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] -= np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    return shift + (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y


_WHOLE = np.arange(4096.0)
_HALVES, _WHOLES = log_gamma(_WHOLE + 0.5), log_gamma(_WHOLE + 1.0)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a zeros and b ones (whole numbers)."""
    n = a + b
    i, j, k = (np.minimum(x, len(_WHOLE) - 1).astype(np.int64) for x in (a, b, n))
    out = _HALVES[i] + _HALVES[j] - _WHOLES[k] - np.log(np.pi)
    high = np.flatnonzero(n >= len(_WHOLE))
    out[high] = log_gamma(a[high] + 0.5) + log_gamma(b[high] + 0.5) - log_gamma(n[high] + 1.0) - np.log(np.pi)
    return out


class Forest:
    """The trees of sorted distinct n-grams (key: the bytes c1 .. c_depth of the context, c1 the most recent, and the symbol) and their counts.

    Level k's entries are the distinct (c1 .. ck, symbol), sorted; up leads from an entry to that of the level above.
    """

    def __init__(self, key: np.ndarray, n: np.ndarray, depth: int, lowest: int = 2):
        self.depth, self.lowest = depth, lowest
        self.entries, self.n, self.up = {depth: key}, {depth: n.astype(float)}, {}
        for k in range(depth - 1, lowest - 1, -1):
            last = self.entries[k + 1]
            short = (last >> U(16)) << U(8) | (last & U(255))
            order = np.argsort(short)
            ordered = short[order]
            first = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
            up = np.empty(len(order), np.int32)
            up[order] = np.cumsum(first, dtype=np.int32) - 1
            self.entries[k], self.up[k + 1] = ordered[first], up
            self.n[k] = np.bincount(up, self.n[k + 1], int(first.sum()))

    def nodes(self, j: int) -> dict[int, dict]:
        """By level, the nodes of the j-th decision: each entry's node, the nodes' first entries, counts, estimate and, but for lowest's, weight."""
        out: dict[int, dict] = {}
        for k in range(self.depth, self.lowest - 1, -1):
            e, n = self.entries[k], self.n[k]
            name = e >> U(8 - j)
            first = np.r_[True, name[1:] != name[:-1]] if len(e) else np.zeros(0, bool)
            start = np.flatnonzero(first)
            node = np.cumsum(first, dtype=np.int32) - 1
            total = np.add.reduceat(n, start) if len(start) else n
            b = np.add.reduceat(n * ((e >> U(7 - j)) & U(1)), start) if len(start) else n
            a = total - b
            x = {"node": node, "start": start, "a": a, "b": b, "reached": total > 0, "kt": (b + 0.5) / (total + 1.0)}
            if k < self.depth:
                low = out[k + 1]
                x["below"] = np.bincount(node[self.up[k + 1][low["start"]]], low["pw"], len(start)) if len(start) else total
            else:
                x["below"] = None
            if k > self.lowest:
                self.weigh(x)
            out[k] = x
        return out

    @staticmethod
    def weigh(x: dict) -> None:
        """ln Pw of nodes and the weight of their own estimate."""
        pe = log_kt(x["a"], x["b"])
        if x["below"] is None:
            x["pw"], x["weight"] = pe, np.ones(len(pe))
        else:
            x["pw"] = LOG_HALF + np.logaddexp(pe, x["below"])
            x["weight"] = np.exp(LOG_HALF + pe - x["pw"])


class Tops:
    """Depths 1 and 0, as dense tables, from depth 2's sums by (last byte, binary node)."""

    def __init__(self, c1: np.ndarray, node: np.ndarray, a: np.ndarray, b: np.ndarray, pw: np.ndarray):
        at = c1.astype(np.int64) << 8 | node.astype(np.int64)
        one = {"a": np.bincount(at, a, 1 << 16), "b": np.bincount(at, b, 1 << 16), "below": np.bincount(at, pw, 1 << 16)}
        Forest.weigh(one)
        zero = {name: one[name].reshape(256, 256).sum(0) for name in ("a", "b")} | {"below": one["pw"].reshape(256, 256).sum(0)}
        Forest.weigh(zero)
        self.levels = [(x["weight"], (x["b"] + 0.5) / (x["a"] + x["b"] + 1.0), x["a"] + x["b"] > 0) for x in (one, zero)]

    def mix(self, c1: np.ndarray, node: int, prefix: np.ndarray, p: np.ndarray, reached: np.ndarray) -> np.ndarray:
        """P(1) of nodes (their place among the 255 is node | prefix) below which depth 2 gives p where it is reached."""
        place = node | prefix.astype(np.int64)
        for at, (weight, kt, known) in zip((c1.astype(np.int64) << 8 | place, place), self.levels, strict=True):
            p, reached = np.where(reached, weight[at] * kt[at] + (1 - weight[at]) * p, kt[at]), known[at]
        return np.where(reached, p, 0.5)


def log10_symbols(forest: Forest, tops: Tops, twos: dict | None = None) -> np.ndarray:
    """log10 P(symbol | context) of each of the forest's n-grams.

    twos: of pairs of last bytes whose trees other tasks share, sorted names (pair << 8 | binary node) of depth 2 and their a, b and below.
    """
    depth, e = forest.depth, forest.entries[forest.depth]
    out = np.zeros(len(e))
    if not len(e):
        return out
    for j in range(8):
        levels = forest.nodes(j)
        two = levels[2]
        if twos is not None and len(twos["name"]):
            name = forest.entries[2][two["start"]] >> U(8 - j)  # (pair, prefix)
            name = (name >> U(j)) << U(8) | (U(1) << U(j)) | (name & U((1 << j) - 1))
            at = np.minimum(np.searchsorted(twos["name"], name), len(twos["name"]) - 1)
            same = twos["name"][at] == name
            for c in ("a", "b", "below"):
                two[c] = np.where(same, twos[c][at], two[c])
            two["reached"], two["kt"] = two["a"] + two["b"] > 0, (two["b"] + 0.5) / (two["a"] + two["b"] + 1.0)
        Forest.weigh(two)
        x = levels[depth]
        p, reached, entry = x["kt"], x["reached"], x["start"]
        for k in range(depth - 1, 1, -1):
            entry = forest.up[k + 1][entry]
            x = levels[k]
            at = x["node"][entry]
            w, kt = x["weight"][at], x["kt"][at]
            p, reached = np.where(reached, w * kt + (1 - w) * p, kt), x["reached"][at]
        own = e[levels[depth]["start"]]
        p = tops.mix(own >> U(8 * depth), 1 << j, (own & U(255)) >> U(8 - j), p, reached)
        node = levels[depth]["node"]
        out += np.where((e >> U(7 - j)) & U(1) == 1, np.log10(p)[node], np.log10(1 - p)[node])
    return out


def pieces(column: pa.Array, depth: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray | None, bool]]:
    """(first row, end row, bytes, offsets, context, whether texts end): runs of texts, or pieces of a long one.

    A long text is cut after white space, its white space at the end left out; context is the last depth
    bytes of the stream before a piece, None at a text's beginning.
    """
    for lo, hi, data, at in ws.chunks(column, CHUNK):
        if hi - lo > 1 or len(data) <= CHUNK:
            yield lo, hi, data, at, None, True
            continue
        solid = np.flatnonzero(ws.solid(data))
        end, begin, context = int(solid[-1]) + 1 if len(solid) else 0, 0, None
        while True:
            cut = end
            if end - begin > CHUNK:
                gap = np.flatnonzero(~ws.solid(data[begin + CHUNK : end]))
                cut = begin + CHUNK + int(gap[0]) + 1 if len(gap) else end
            part = data[begin:cut]
            yield lo, hi, part, np.array([0, len(part)]), context, cut == end
            if cut == end:
                break
            tail = Stream(part[-(1 << 12) :], np.array([0, len(part[-(1 << 12) :])]), depth, context, False)
            context, begin = tail.after, cut


class Stream:
    """The canonical byte stream of some texts, as n-gram codes, with the text of each, and their words' hashes."""

    def __init__(self, data: np.ndarray, at: np.ndarray, depth: int, context: np.ndarray | None = None, ends: bool = True):
        n = len(at) - 1
        start, end = ws.words(data, at)
        first = np.searchsorted(start, at)
        self.n_words = np.diff(first)
        self.word_doc = np.repeat(np.arange(n), self.n_words)
        self.span = (data, start, end)
        size = end - start + 1  # a word and what follows it
        total = np.bincount(self.word_doc, size, n).astype(np.int64) + ((self.n_words == 0) & ends)  # an empty text has its end
        begin = np.r_[0, np.cumsum(total + depth)]  # depth bytes stand before each text
        run = np.r_[0, np.cumsum(size)]
        into = run[:-1] - run[first[self.word_doc]] + begin[self.word_doc] + depth
        out = np.full(int(begin[-1]), 10, np.uint8)
        if context is not None:
            out[:depth] = context
        step = np.zeros(len(out) + 1, np.int8)
        step[into] += 1
        step[into + size - 1] -= 1
        out[np.cumsum(step[:-1], dtype=np.int8).astype(bool)] = ws.LOWER[data[ws.solid(data)]] if len(data) else 10
        out[into + size - 1] = 32
        if ends and len(start):
            last = first[1:][self.n_words > 0] - 1
            out[into[last] + size[last] - 1] = 10
        self.after = out[-depth:].copy()
        real = np.ones(len(out), bool)
        for k in range(depth):
            real[begin[:-1] + k] = False
        self.size = total
        self.doc = np.repeat(np.arange(n, dtype=np.int32), total)
        wide = out.astype(U)
        code = wide.copy()
        for k in range(1, depth + 1):
            code[k:] |= wide[: len(wide) - k] << U(8 * (depth - k + 1))
        self.code = code[real]

    def words(self) -> np.ndarray:
        return ws.hashes(*self.span)


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    return (ws.mix(key ^ U(0x9D39247E33776D41)) % U(parts)).astype(np.int64)


def planes(x: np.ndarray, keep: slice = slice(None)) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T[keep]).tobytes())


def unplanes(data: bytes, kind: type, lost: int = 0) -> np.ndarray:
    width = np.dtype(kind).itemsize
    got = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width - lost, -1)
    out = np.zeros((got.shape[1], width), np.uint8)
    out[:, lost:] = got.T
    return out.reshape(-1).view(kind)


def squeeze(key: np.ndarray) -> bytes:
    """Ascending keys as the byte planes of their differences, compressed."""
    return planes(np.diff(key, prepend=U(0)))


def unsqueeze(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, U), dtype=U)


def squeeze_values(x: np.ndarray) -> bytes:
    """Doubles to 36 bits of mantissa, which is 1.5e-11 of each, as compressed byte planes."""
    return planes((x.view(U) + U(1 << 15)) & ~U(0xFFFF), slice(2, None))


def unsqueeze_values(data: bytes) -> np.ndarray:
    return unplanes(data, np.float64, 2)


def count_keys(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


class Deal:
    """To which part an n-gram or a word goes.

    pairs: how often each pair of last bytes stands in the texts.  Parts get pairs largest first, the emptiest part
    next; a pair of more than most is split by its third byte.
    """

    def __init__(self, pairs: np.ndarray, most: int, words: int):
        split = np.minimum(256, -(-pairs // most))
        self.split = np.maximum(split, 1)
        self.first = np.zeros(1 << 16, np.int64)  # part of a whole pair; first part of a split one
        shared = np.flatnonzero(self.split > 1)
        whole = np.flatnonzero(self.split == 1)
        bins = max(1, -(-int(pairs[whole].sum()) // most))
        load = [(0, k) for k in range(bins)]
        for p in whole[np.argsort(-pairs[whole], kind="stable")].tolist():
            held, k = load[0]
            self.first[p] = k if pairs[p] else p % bins
            heapreplace(load, (held + int(pairs[p]), k))
        self.first[shared] = bins + np.cumsum(self.split[shared]) - self.split[shared]
        self.parts = bins + int(self.split[shared].sum())
        self.words = words

    def grams(self, key: np.ndarray, depth: int) -> np.ndarray:
        pair = (key >> U(8 * (depth - 1))).astype(np.int64)
        third = (key >> U(8 * (depth - 2))) & U(255)
        split = self.split[pair]
        return self.first[pair] + np.where(split > 1, (ws.mix(third + U(0x51)) % split.astype(U)).astype(np.int64), 0)


def block_keys(texts: pa.Table, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of a block's texts (text, learn): sorted n-grams and sorted words, with their counts in the texts to learn from."""
    learn = texts["learn"].combine_chunks().to_numpy(zero_copy_only=False)
    code = np.empty(sum(c.nbytes for c in texts["text"].chunks) + 2 * len(texts), U)  # a stream is no longer than its text and an end
    word, known, n = [], [], 0
    for lo, hi, data, at, context, ends in pieces(texts["text"], depth):
        x, mine = Stream(data, at, depth, context, ends), learn[lo:hi]
        own = code[n : n + len(x.code)]
        np.left_shift(x.code, U(8), out=own)
        own |= mine[x.doc].astype(U)
        n += len(own)
        word.append(x.words())
        known.append(mine[x.word_doc])
    code = code[:n]
    code.sort()
    first = np.concatenate([np.zeros(min(n, 1), np.int64), *(i + 1 + np.flatnonzero((code[i + 1 : i + CHUNK + 1] ^ code[i : i + CHUNK][: n - 1 - i]) >> U(8)) for i in range(0, n - 1, CHUNK))])
    key = code[first] >> U(8)
    code &= U(255)
    grams = key, (np.add.reduceat(code, first) if n else code).astype(np.int64)
    del code
    return [grams, count_keys(np.concatenate([np.zeros(0, U), *word]), np.concatenate([np.zeros(0, bool), *known]).astype(np.int64))]


def dealt(key: np.ndarray, part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its keys, in order)."""
    order = np.argsort(part.astype(np.int64) << 32 | np.arange(len(part)))  # fewer than 2^32 keys a block, parts below 2^31
    ordered = part[order]
    start = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(part) else np.zeros(0, np.int64)
    for lo, hi in zip(start.tolist(), [*start[1:].tolist(), len(part)], strict=False):
        yield int(ordered[lo]), order[lo:hi]


def parts_of(keys: list[tuple[np.ndarray, np.ndarray]], depth: int, deal: Deal) -> Iterator[tuple[int, int, np.ndarray]]:
    for kind, (key, _) in enumerate(keys):
        for part, own in dealt(key, deal.grams(key, depth) if kind == GRAM else part_of(key, deal.words)):
            yield kind, part, own


def columns(rows: list[tuple], fields: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "byte": pa.int8(), "binary": pa.binary(), "double": pa.float64()}
    names = [f.split() for f in fields.split(", ")]
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True) if rows else [()] * len(names), names, strict=True)], [n for n, _ in names])


def byte_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each pair (last byte, the byte before) stands in texts (text), as rows of a task."""
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for _, _, data, _ in ws.chunks(batch.column(0), CHUNK):
            for i in range(0, len(data), CHUNK):
                one = data[i : i + CHUNK]
                one = np.where(ws.solid(one), ws.LOWER[one], 32)
                total += np.bincount(one[1:].astype(np.int64) << 8 | one[:-1], minlength=1 << 16)
        ws.trim()
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["pair", "n"])


def count_block(depth: int, deal: Deal) -> Callable[[pa.Table], pa.Table]:
    """A block's keys dealt into parts: one row for each."""

    def run(texts: pa.Table) -> pa.Table:
        block, keys = texts["block"][0].as_py(), block_keys(texts, depth)
        rows = [(block, kind, part, squeeze(keys[kind][0][own]), planes(keys[kind][1][own].astype(np.uint32))) for kind, part, own in parts_of(keys, depth, deal)]
        ws.trim()
        return columns(rows, SENT)

    return run


def summed(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each row's keys, and the distinct ones of all rows with their counts."""
    own = [unsqueeze(k.as_py()) for k in table["keys"]]
    n = [unplanes(x.as_py(), np.uint32).astype(np.int64) for x in table["n"]]
    return own, *count_keys(np.concatenate([np.zeros(0, U), *own]), np.concatenate([np.zeros(0, np.int64), *n]))


NODES = "part long, pair int, node int, a double, b double, below double, tokens long, known long"


def sum_nodes(depth: int, deal: Deal) -> Callable[[pa.Table], pa.Table]:
    """Of a part's trees, depth 2's nodes of split pairs; of whole pairs their sums by last byte, as pair -1 - byte, with Pw as below; of words their totals."""

    def run(table: pa.Table) -> pa.Table:
        kind, part = table["kind"][0].as_py(), table["part"][0].as_py()
        _, key, n = summed(table)
        if kind == WORD:
            return columns([(part, 0, 0, 0.0, 0.0, 0.0, int(n.sum()), int((n > 0).sum()))], NODES)
        forest, rows = Forest(key[n > 0], n[n > 0], depth), []
        for j in range(8):
            two = forest.nodes(j)[2]
            if not len(two["start"]):
                continue
            e = forest.entries[2][two["start"]]
            pair, node = (e >> U(8)).astype(np.int64), 1 << j | (e & U(255)).astype(np.int64) >> (8 - j)
            shared = deal.split[pair] > 1
            rows += [(part, *row, 0, 0) for row in zip(*(x[shared].tolist() for x in (pair, node, two["a"], two["b"], two["below"])), strict=True)]
            Forest.weigh(two)
            name, at = np.unique((pair >> 8 << 8 | node)[~shared], return_inverse=True)
            sums = [np.bincount(at, two[c][~shared], len(name)) for c in ("a", "b", "pw")]
            rows += [(part, *row, 0, 0) for row in zip((-1 - (name >> 8)).tolist(), (name & 255).tolist(), *(x.tolist() for x in sums), strict=True)]
        ws.trim()
        return columns(rows, NODES)

    return run


def weigh_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (pair, node, a, b, below) of depth 2, summed over tasks, as rows (c1, node, a, b, pw)."""
    for batch in batches:
        pair, node, a, b, below = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        x = {"a": a, "b": b, "below": below}
        Forest.weigh(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.where(pair < 0, -1 - pair, pair >> 8).astype(np.int32)), batch.column(1), batch.column(2), batch.column(3), pa.array(np.where(pair < 0, below, x["pw"]))], ["c1", "node", "a", "b", "pw"])


def return_values(depth: int, tops: Callable[[], Tops]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """To each block log10 P of the n-grams, or the counts of the words, that it sent to this part, in its own order."""

    def run(sent: pa.Table, shared: pa.Table) -> pa.Table:
        if not len(sent):
            return columns([], BACK)
        kind = sent["kind"][0].as_py()
        own, key, value = summed(sent)
        if kind == GRAM:
            pair, node, *rest = (shared[c].to_numpy() for c in ("pair", "node", "a", "b", "below"))
            name = pair.astype(U) << U(8) | node.astype(U)
            order = np.argsort(name)
            twos = dict(zip(("name", "a", "b", "below"), (x[order] for x in (name, *rest)), strict=True))
            value = log10_symbols(Forest(key, value, depth), tops(), twos)
        value = value.astype(float)
        values = [squeeze_values(value[np.searchsorted(key, k)]) for k in own]
        ws.trim()
        return pa.table({"block": sent["block"], "kind": sent["kind"], "part": sent["part"], "values": pa.array(values, pa.binary())})

    return run


def score_block(depth: int, deal: Deal, tokens: float, kinds: float, ends: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Scores of a block's texts, given log10 P of its n-grams and the training counts of its words."""

    def run(texts: pa.Table, got: pa.Table) -> pa.Table:
        by = {(k, p): v for k, p, v in zip(got["kind"].to_pylist(), got["part"].to_pylist(), got["values"], strict=True)}
        keys = block_keys(texts, depth)
        values = [np.zeros(len(key)) for key, _ in keys]
        for kind, part, own in parts_of(keys, depth, deal):
            values[kind][own] = unsqueeze_values(by.pop((kind, part)).as_py())
        (grams, _), (words, _) = keys
        rows, unit = len(texts), np.log10(tokens + kinds + 1)
        score, base, n_tokens, known, size = (np.zeros(rows) for _ in range(5))
        for lo, hi, data, at, context, last in pieces(texts["text"], depth):
            x, n = Stream(data, at, depth, context, last), hi - lo
            order = np.argsort(x.code)
            score[lo:hi] += np.bincount(x.doc[order], values[GRAM][np.searchsorted(grams, x.code[order])], n)
            c = values[WORD][np.searchsorted(words, x.words())] if len(x.word_doc) else np.zeros(0)
            base[lo:hi] += np.bincount(x.word_doc, np.log10(c + 1) - unit, n)
            known[lo:hi] += np.bincount(x.word_doc, c > 0, n)
            n_tokens[lo:hi] += x.n_words
            size[lo:hi] += x.size
        base += np.log10(ends + 1) - unit
        learn = texts["learn"].combine_chunks().to_numpy(zero_copy_only=False)
        ws.trim()
        return pa.table({"doc_id": texts["doc_id"], "held_out": pa.array(~learn), "n_tokens": pa.array(n_tokens.astype(np.int64) + 1), "n_known": pa.array(known.astype(np.int64) + (ends > 0)), "base_score": pa.array(base), "score": pa.array(score), "bits_per_byte": pa.array(-score / np.log10(2) / size)})

    return run


def score_texts(docs: DataFrame, learn: Column, depth: int = 6, block_bytes: int = 12 << 20, tree_bytes: int = TREE_BYTES) -> DataFrame:
    """Per row of docs (doc_id, text): held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    learn: which rows the model may learn from; held_out is its negation.  depth: 3 to 6 bytes.  score is log10 of the
    model's probability of the text, base_score that of smoothed word counts.  A null text is an empty one: only its
    end is scored.  Nothing is dropped: rows that repeat a doc_id count and are scored each, a null doc_id too.  With
    no rows to learn from, every decision has probability 1/2.  An empty table gives an empty result.
    """
    if not 3 <= depth <= 6:
        raise ValueError("contexts have three to six bytes")
    spark = docs.sparkSession
    scratch = Scratch(spark, "context-tree")
    ws.small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", learn.alias("learn"))
    ends = docs.agg(F.count_if("learn")).first()[0]
    found = docs.select("text").mapInArrow(byte_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # 65,536 rows at most
    pairs = np.zeros(1 << 16, np.int64)
    pairs[found["pair"].to_numpy()] = found["n"].to_numpy()
    blocks = max(1, -(-int(pairs.sum()) // block_bytes))
    deal = Deal(pairs, tree_bytes, max(4, -(-int(pairs.sum()) // (4 * tree_bytes))))
    # The text is part of the hash: rows that share or lack a doc_id don't meet in one block.
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition(blocks, "block")
    sent = scratch.save(docs.groupBy("block").applyInArrow(count_block(depth, deal), SENT), "sent")
    scratch.release()

    nodes = scratch.save(sent.groupBy("kind", "part").applyInArrow(sum_nodes(depth, deal), NODES), "nodes")
    scratch.release()
    totals = nodes.agg(F.sum("tokens"), F.sum("known")).first()
    tokens, kinds = (totals[0] or 0) + ends, (totals[1] or 0) + (ends > 0)
    trees = nodes.filter("node > 0")
    twos = trees.groupBy("pair", "node").agg(*(F.sum(c).alias(c) for c in ("a", "b", "below")))
    low = twos.mapInArrow(weigh_nodes, "c1 int, node int, a double, b double, pw double")
    low = low.groupBy("c1", "node").agg(*(F.sum(c).alias(c) for c in ("a", "b", "pw"))).toArrow()  # 256 * 255 rows at most
    tops = spark.sparkContext.broadcast(Tops(*(low[c].to_numpy() for c in ("c1", "node", "a", "b", "pw"))))

    # Depth 2's nodes of a split pair go to each of its parts.
    shared = trees.filter("pair >= 0").select("part", "pair", "node").join(twos, ["pair", "node"]).select(F.lit(GRAM).cast("byte").alias("kind"), "part", "pair", "node", "a", "b", "below")
    back = sent.groupBy("kind", "part").cogroup(shared.groupBy("kind", "part"))
    back = scratch.save(back.applyInArrow(return_values(depth, lambda: tops.value), BACK), "back")
    scratch.drop("sent", "nodes")
    scratch.release()
    scored = docs.groupBy("block").cogroup(back.groupBy("block"))
    out = scored.applyInArrow(score_block(depth, deal, float(tokens), float(kinds), int(ends)), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, bits_per_byte double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte")
