"""A quality classifier: a convolutional network over a text's bytes, in numpy.

Every byte is a small learned vector and a flag that the eight bytes ending there occurred a few bytes before.
Learned filters slide over the whole text; their rectified answers are averaged over overlapping chunks of 64
bytes, one every 32, and combined into a chunk's features.  The maximum over all chunks of the text gives one
probability.  Texts of any length are covered to their last byte.

A filter's answer is a sum of one learned table row per byte, so a text is scored by looking rows up, a bounded
piece of it at a time under a running maximum.  All sums have a fixed order, so a text's score depends on nothing
but the text: not on its neighbours in a batch, nor on how rows are dealt.  Only the chunks that hold a maximum
have a gradient; the fit goes back through those alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tableloom.llm import wordscan as ws

STEP, WIDTH, HALF = 4, 8, 32  # bytes between filter positions, of a filter, of half a chunk
EMBED, FILTERS, FEATURES = 8, 24, 16
LAGS = range(2, 33)
BEFORE = 2  # halves before a piece that the flags of its first bytes look back to
PIECE = 1 << 12  # halves scored at a time
TEXTS = 1 << 19  # bytes of texts looked at together, or one text if it is longer


@dataclass(frozen=True)
class Training:
    """The sample's bounds and the fit.

    Of each class the first per_class rows in a seeded order train, as far as all their texts together have at most
    sample_bytes bytes; a text that is longer than that is passed over.
    """

    per_class: int = 800
    sample_bytes: int = 32 << 20
    epochs: int = 14
    batch: int = 32
    rate: float = 0.01
    seed: int = 7


def halves_of(size: np.ndarray) -> np.ndarray:
    """How many half chunks texts of these sizes have, two at least; a filter of zeros follows the last byte."""
    return np.maximum(2, -(-(size + WIDTH) // HALF))


def flags(data: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Whether the eight bytes ending here, all in the text, ended a few bytes before as well; offset is the byte's place in its text."""
    code = np.zeros(len(data), np.uint64)
    for j in range(min(8, len(data))):
        code[j:] |= data[: len(data) - j].astype(np.uint64) << np.uint64(8 * j)
    found = np.zeros(len(data), bool)
    for lag in LAGS:
        found[lag:] |= (code[lag:] == code[:-lag]) & (offset[lag:] >= lag + 7)
    return found


class Net:
    def __init__(self, seed: int):
        r = np.random.default_rng(seed)
        wide = (EMBED + 1) * WIDTH
        self.p = {
            "embed": r.normal(0, 0.5, (256, EMBED)),
            "filters": r.normal(0, wide**-0.5, (wide, FILTERS)),
            "filter_bias": np.zeros(FILTERS),
            "mix": r.normal(0, FILTERS**-0.5, (FILTERS, FEATURES)),
            "mix_bias": np.full(FEATURES, 0.05),
            "out": r.normal(0, FEATURES**-0.5, FEATURES),
            "out_bias": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.tabulate()

    def tabulate(self) -> None:
        """What each byte adds to the filters' answers at each of the eight places."""
        by_place = self.p["filters"].reshape(WIDTH, EMBED + 1, FILTERS)
        self.table = [self.p["embed"] @ by_place[j, :EMBED] for j in range(WIDTH)]
        self.flag = by_place[:, EMBED]

    def answers(self, data: np.ndarray, flag: np.ndarray) -> np.ndarray:
        """The filters' answers at every fourth byte but the last WIDTH - STEP, in a fixed order of sums."""
        n = (len(data) - (WIDTH - STEP)) // STEP
        a = np.empty((n, FILTERS), np.float32)
        a[:] = self.p["filter_bias"]
        row = np.empty_like(a)
        for j in range(WIDTH):
            own = slice(j, j + n * STEP, STEP)
            np.take(self.table[j], data[own], axis=0, out=row)
            a += row
            at = np.flatnonzero(flag[own])
            a[at] += self.flag[j]
        return a

    def features(self, data: np.ndarray, flag: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Features of the chunk that begins at each half of data (whole halves and WIDTH - STEP bytes more) but the last.

        last: the halves that end a text; the position of theirs that reaches beyond it says nothing.
        """
        a = self.answers(data, flag)
        a[(last + 1) * (HALF // STEP) - 1] = 0
        np.maximum(a, 0, out=a)
        a = a.reshape(-1, HALF // STEP, FILTERS)
        h = a[:, 0].copy()
        for k in range(1, HALF // STEP):
            h += a[:, k]
        c = (h[:-1] + h[1:]) * np.float32(STEP / HALF / 2)
        f = np.empty((len(c), FEATURES), np.float32)
        f[:] = self.p["mix_bias"]
        for k in range(FILTERS):
            f += c[:, k : k + 1] * self.p["mix"][k]
        return f

    def tops(self, data: np.ndarray, at: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Each text's largest features, 0 at least, and, if asked, the first chunk that has each (-1: none)."""
        n, size = len(at) - 1, np.diff(at)
        halves = halves_of(size)
        top = np.zeros((n, FEATURES), np.float32)
        place = np.full((n, FEATURES), -1, np.int64) if where else None
        i = 0
        while i < n:
            if halves[i] > PIECE:
                for lo in range(0, int(halves[i]) - 1, PIECE):
                    hi = min(lo + PIECE, int(halves[i]) - 1)  # chunks lo .. hi - 1
                    f = self._piece(data[at[i] : at[i + 1]], lo, hi, int(halves[i]))
                    best = f.max(0)
                    if where:
                        better = best > top[i]
                        place[i, better] = lo + f.argmax(0)[better]
                    np.maximum(top[i], best, out=top[i])
                i += 1
                continue
            ends = np.cumsum(halves[i:])
            j = i + max(1, int(np.searchsorted(ends, PIECE, "right")))
            first = np.r_[0, ends[: j - i]]
            own = np.zeros(int(first[-1]) * HALF + WIDTH - STEP, np.uint8)
            into = np.repeat(first[:-1] * HALF - at[i:j], size[i:j]) + np.arange(at[i], at[j])
            own[into] = data[at[i] : at[j]]
            offset = np.zeros(len(own), np.int64)
            offset[into] = np.arange(at[i], at[j]) - np.repeat(at[i:j], size[i:j])
            f = self.features(own, flags(own, offset), first[1:] - 1)
            f[first[1:-1] - 1] = 0  # chunks over two texts
            many = np.maximum.reduceat(f, first[:-1], axis=0) if j - i > 1 else f.max(0)[None]
            np.maximum(top[i:j], many, out=top[i:j])
            if where:
                owner = np.repeat(np.arange(j - i), np.r_[np.diff(first[:-1]), len(f) - first[-2]])
                chunk, k = np.nonzero((f == top[i:j][owner]) & (f > 0))
                place[i + owner[chunk[::-1]], k[::-1]] = (chunk - first[owner[chunk]])[::-1]
            i = j
        return top, place

    def _piece(self, text: np.ndarray, lo: int, hi: int, halves: int) -> np.ndarray:
        """Features of the chunks lo .. hi - 1 of one text."""
        begin = max(0, lo - BEFORE)
        own = np.zeros((hi + 1 - begin) * HALF + WIDTH - STEP, np.uint8)
        some = text[begin * HALF : begin * HALF + len(own)]
        own[: len(some)] = some
        flag = flags(own, np.arange(begin * HALF, begin * HALF + len(own)))
        flag[len(some) :] = False
        skip = (lo - begin) * HALF
        return self.features(own[skip:], flag[skip:], np.array([hi - lo] if hi + 1 == halves else [], np.int64))

    def logits(self, top: np.ndarray) -> np.ndarray:
        z = np.full(len(top), self.p["out_bias"][0], np.float32)
        for k in range(FEATURES):
            z += top[:, k] * self.p["out"][k]
        return z

    def gradients(self, texts: list[np.ndarray], label: np.ndarray, weight: np.ndarray) -> dict:
        """Of the weighted mean log loss of some texts."""
        p, sizes = self.p, [len(x) for x in texts]
        top, place = self.tops(np.concatenate(texts), np.r_[0, np.cumsum(sizes)], True)
        dz = ((1 / (1 + np.exp(-self.logits(top))) - label) * weight / len(label)).astype(np.float32)
        g = {"out": top.T @ dz, "out_bias": dz.sum(keepdims=True)}
        owner, feature = np.nonzero(place >= 0)
        pairs, row = np.unique(np.stack([owner, place[owner, feature]], 1), axis=0, return_inverse=True)
        df = np.zeros((len(pairs), FEATURES), np.float32)
        df[row.reshape(-1), feature] = dz[owner] * p["out"][feature]
        # The winning chunks again: their bytes, flags and answers.
        long = 2 * HALF + WIDTH - STEP
        data, flag, real = np.zeros((len(pairs), long), np.uint8), np.zeros((len(pairs), long), np.float32), np.ones((len(pairs), 2 * HALF // STEP), np.float32)
        for k, (i, chunk) in enumerate(pairs.tolist()):
            text, begin = texts[i], max(0, (chunk - BEFORE) * HALF)
            some = text[begin : chunk * HALF + long]
            mark = flags(some, np.arange(begin, begin + len(some)))[chunk * HALF - begin :]
            data[k, : max(0, len(text) - chunk * HALF)] = text[chunk * HALF : chunk * HALF + long]
            flag[k, : len(mark)] = mark
            if chunk + 2 == halves_of(np.array(len(text))):
                real[k, -1] = 0
        at = np.arange(0, 2 * HALF, STEP)[:, None] + np.arange(WIDTH)
        seen = np.concatenate([p["embed"][data[:, at]], flag[:, at][..., None]], -1).reshape(-1, WIDTH * (EMBED + 1))
        a = (seen @ p["filters"] + p["filter_bias"]).reshape(len(pairs), -1, FILTERS) * real[..., None]
        c = np.maximum(a, 0).mean(1)
        g["mix"], g["mix_bias"] = c.T @ df, df.sum(0)
        da = ((df @ p["mix"].T)[:, None] / a.shape[1] * (a > 0)).reshape(-1, FILTERS)
        g["filters"], g["filter_bias"] = seen.T @ da, da.sum(0)
        dx = (da @ p["filters"].T).reshape(-1, EMBED + 1)[:, :EMBED]
        byte = data[:, at].reshape(-1)
        g["embed"] = np.stack([np.bincount(byte, dx[:, k], 256) for k in range(EMBED)], 1)
        return g

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        z = self.logits(self.tops(data, at)[0]).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(texts: list[str], labels: list[int], t: Training) -> Net | float:
    """The network, or the only probability there is to tell if the labels aren't of both kinds."""
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return float(y[0]) if len(y) else 0.5
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum()))).astype(np.float32)
    raw = [np.frombuffer(x.encode(), np.uint8) for x in texts]
    net, r = Net(t.seed), np.random.default_rng(t.seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    steps, total = 0, t.epochs * -(-len(raw) // t.batch)
    for _ in range(t.epochs):
        order = r.permutation(len(raw))
        for i in range(0, len(order), t.batch):
            own = order[i : i + t.batch]
            g = net.gradients([raw[j] for j in own], y[own], weight[own])
            steps += 1
            rate = t.rate * (1 - steps / (total + 1)) * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
            for k, x in g.items():
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.999 * v[k] + 0.001 * x * x
                net.p[k] = (net.p[k] - rate * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
            net.tabulate()
    return net


def in_fold(column: str = "doc_id", of: int = 4, fold: int = 2) -> F.Column:
    """crc32 of the id as text, modulo of, is fold; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % of == fold


def train(docs: DataFrame, labels: DataFrame, t: Training | None = None) -> Net | float:
    """Fits on a bounded sample of labels (doc_id, quality) outside the held-out fold, the same one each time.

    Of several texts under one doc_id the least trains.
    """
    t = t or Training()
    known = labels.filter(~in_fold()).filter("quality in (0, 1)").select("doc_id", "quality").distinct()
    order = [F.xxhash64(F.lit(t.seed), "doc_id"), "doc_id", "quality"]
    ids = known.filter("quality = 0").orderBy(*order).limit(t.per_class).unionAll(known.filter("quality = 1").orderBy(*order).limit(t.per_class))
    found = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(ids), "doc_id")  # 2 * per_class ids at most
    found = found.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).withColumn("bytes", F.octet_length("text").cast("long"))
    found = found.filter(F.col("bytes") <= t.sample_bytes)
    # 2 * per_class rows: their running size is one task's work.
    upto = found.select("doc_id", "quality", F.sum("bytes").over(W.orderBy(*order)).alias("upto")).filter(F.col("upto") <= t.sample_bytes)
    rows = found.join(F.broadcast(upto), ["doc_id", "quality"]).select("doc_id", "quality", "text").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["quality"]))
    return fit([r["text"] for r in rows], [r["quality"] for r in rows], t)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, t: Training | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, held_out, score, predicted.

    score is the probability that the text is good; labels, language, source and doc_id are no inputs of it.  A
    null text is an empty one.  Rows that repeat a doc_id, or have none, are scored each.  Without labels of both
    kinds the score is the same for all: their only value, or 1/2.
    """
    ws.small_batches(docs.sparkSession)
    net = train(docs, labels, t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [np.full(hi - lo, net) if isinstance(net, float) else net.score(data, at) for lo, hi, data, at in ws.chunks(batch.column(1), TEXTS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.concatenate(got) if got else np.zeros(0))], ["doc_id", "held_out", "score"])
            ws.trim()

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", in_fold().alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, t: Training | None = None) -> DataFrame:
    """The rows of docs whose text scores threshold or more, with all their columns."""
    ws.small_batches(docs.sparkSession)
    net, place = train(docs, labels, t), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in ws.chunks(batch.column(place), TEXTS):
                good = np.full(hi - lo, net >= threshold) if isinstance(net, float) else net.score(data, at) >= threshold
                yield batch.slice(lo, hi - lo).filter(pa.array(good))
            ws.trim()

    return docs.mapInArrow(run, docs.schema)
