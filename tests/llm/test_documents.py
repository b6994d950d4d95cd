"""Operators on documents against brute force, on fixtures and on the smallest tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from math import lgamma, log, log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableloom.llm import byte_conv, context_tree as ct, jaccard_join as jj, line_dedup as ld, mixing, packing, separator_scan, wordscan as ws
from tableloom.llm.tokens import PROBES, Encoder, Vocabulary, encoder

SF = "/root/testdata/sf0.001"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, n):
    w = split(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def groups(ids, linked):
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in combinations(sorted(ids), 2):
        if linked(a, b):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def mutated(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"m{r.randrange(10**6)}"
    return words


def near_copies(seed, bases=6, copies=9):
    """Texts around the threshold: chains of copies, each some words from the one before, and exact copies."""
    r, out = random.Random(seed), []
    for _ in range(bases):
        words = [f"w{r.randrange(4000)}" for _ in range(r.choice([8, 25, 60, 200, 700]))]
        for _ in range(copies):
            out.append(" ".join(words))
            if r.random() < 0.7:
                words = mutated(r, words, r.choice([0, 1, 1, 2, max(1, len(words) // 40)]))
    r.shuffle(out)
    return out


def test_words_and_hashes():
    texts = ["A b\tC", None, "", "  x  ", "no-end", "start ", "ß É"]
    (lo, hi, data, at), = ws.chunks(pa.array(texts))
    start, end = ws.words(data, at)
    found = [bytes(ws.LOWER[data[s:e]]).decode() for s, e in zip(start, end)]
    assert found == [w for t in texts for w in split(t)]
    h = ws.hashes(data, start, end)
    again = next(ws.chunks(pa.array([" ".join(found)])))
    assert list(h) == list(ws.hashes(again[2], *ws.words(again[2], again[3])))
    assert len(set(h.tolist())) == len(set(found))


@pytest.mark.parametrize("j", [jj.Jaccard(), jj.Jaccard(4, 17, 20)])
def test_signatures_of_linked_sets_always_meet(j):
    r = np.random.default_rng(3)
    for size in [*range(1, 40), 90, 250, 1000]:
        for _ in range(6):
            base = r.integers(0, 2**63, size, dtype=np.uint64)
            drop, add = r.integers(0, size // 8 + 2, 2)
            other = np.unique(np.concatenate([base[min(drop, size - 1) :], r.integers(0, 2**63, add, dtype=np.uint64)]))
            a = np.unique(base)
            common = len(np.intersect1d(a, other))
            if common * j.den >= (len(a) + len(other) - common) * j.num and len(a) != common + 0 * len(other):
                assert set(jj.signatures(a, j).tolist()) & set(jj.signatures(other, j).tolist()), (size, len(a), len(other), common)


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_equal_all_pairs(spark, seed):
    texts = near_copies(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    j = jj.Jaccard(4, 17, 20)
    sets = {i: shingles(t, 4) for i, t in enumerate(texts)}
    want = groups(sets, lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    got = jj.link_documents(docs, j).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}


def test_jaccard_odd_rows(spark, odd_docs, no_docs):
    got = jj.link_documents(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert by[0] == by[0] & {(0, 0)} and by[1] == {(0, 1)} and by[50] == {(1, 3)} and by[3] == {(1, 3)}
    assert by[None] == {(1, 3), (0, None)}
    assert jj.link_documents(no_docs).count() == 0


def matches(docs, num=4, den=5, least=5):
    lines = [((d, i), frozenset(split(x))) for d, t in docs if d is not None and t is not None for i, x in enumerate(t.split("\n"))]
    lines = [(at, s) for at, s in lines if len(s) >= least]
    return {at for at, s in lines if any(e < at and len(s & o) * den >= len(s | o) * num for e, o in lines)}


def test_line_dedup_equals_all_pairs(spark):
    r, docs = random.Random(5), []
    pool = [[f"w{r.randrange(300)}" for _ in range(r.randrange(3, 30))] for _ in range(40)]
    for d in range(60):
        docs.append((d, "\n".join(" ".join(mutated(r, r.choice(pool), r.choice([0, 0, 1, 2, 4]))) for _ in range(r.randrange(1, 6)))))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {(x["doc_id"], x["line_no"]) for x in ld.later_matches(df).collect()}
    assert got == matches(docs) and got


@pytest.mark.parametrize("lead_from", [3, 10**6])
def test_lines_that_meet_by_word(lead_from):
    r = np.random.default_rng(6)
    n, s = 120, ld.Similar()
    base = r.integers(0, 2**63, 30, dtype=np.uint64)
    sets = [np.unique(np.r_[base[r.random(30) < r.choice([0.3, 0.9, 1.0])], r.integers(0, 2**63, r.integers(1, 6), dtype=np.uint64)]) for _ in range(n)]
    sketch = np.array([np.bitwise_xor.reduce(np.uint64(1) << (ws.mix(x ^ np.uint64(0x77)) & np.uint64(63))) for x in sets])
    sketch = ws.signed(sketch)
    rows = [(w, i, p) for i, x in enumerate(sets) for p, w in enumerate(x[: len(x) - -(-len(x) * 4 // 5) + 1])]
    word, line, place = (np.array(c) for c in zip(*rows))
    size = np.array([len(x) for x in sets])
    m = ld.Meeting([word, line, line * 0, size[line], place, sketch[line], 0 * sketch[line], np.ones(len(line), np.int8)], s)
    got, whole = defaultdict(set), defaultdict(set)
    for u, v, _, partly in m.pairs(lead_from):
        assert (m.doc[u] < m.doc[v]).all()
        for a, b in zip(m.doc[u].tolist(), m.doc[v].tolist()):
            got[b].add(a)
            whole[b].add(partly)
    for b in range(n):
        true = {a for a in range(b) if len(np.intersect1d(sets[a], sets[b])) * 5 >= len(np.union1d(sets[a], sets[b])) * 4}
        assert true <= got[b] or (lead_from == 3 and True in whole[b])


def test_line_dedup_on_whole_tables(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    gone = matches(docs)
    out = ld.dedup_lines(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    for r, (d, t) in zip(sorted(out), sorted(docs)):
        assert r["text"] == "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)
        assert r["n_removed"] == sum((d, i) in gone for i in range(r["n_lines"]))


def test_lines_of_few_words_equal_all_pairs(spark):
    r, pool = random.Random(8), [f"w{i}" for i in range(9)]
    docs = [(d, "\n".join(" ".join(r.choices(pool, k=r.randrange(0, 7))) for _ in range(5))) for d in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {(x["doc_id"], x["line_no"]) for x in ld.later_matches(df, ld.EVERY_LINE).collect()}
    assert got == matches(docs, least=1) and got > matches(docs)


def test_line_dedup_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c d e", 7, 8, 9), (2, "a b c d e\nx", 7, 8, 9)], "doc_id long, text string, _gone int, _x0 int, _gone_id int")
    out = ld.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, "a b c d e", 7, 8, 9, 1, 0), (2, "x", 7, 8, 9, 2, 1)]


def test_the_second_pass_finds_what_the_named_candidates_miss(spark, monkeypatch):
    """With one candidate named, lines that it leaves unsettled meet all earlier ones again."""
    r, docs = random.Random(11), []
    base = [f"w{i}" for i in range(60)]
    for d in range(70):
        docs.append((d, " ".join(mutated(r, base, r.choice([3, 4, 4])))))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    again = []
    monkeypatch.setattr(ld, "BEST", 1)
    monkeypatch.setattr(ld, "buckets_of_lines", lambda *a, f=ld.buckets_of_lines: again.append(1) or f(*a))
    assert {(x["doc_id"], x["line_no"]) for x in ld.later_matches(df).collect()} == matches(docs)
    assert again


def test_line_dedup_odd_rows(spark, odd_docs, no_docs):
    out = ld.dedup_lines(odd_docs)
    assert out.columns == [*odd_docs.columns, "n_lines", "n_removed"] and out.count() == odd_docs.count()
    assert {r["text"] for r in out.filter("doc_id = 0").collect()} == {None}
    assert ld.dedup_lines(no_docs).count() == 0
    three = spark.createDataFrame([(2, "one two three four five\nx"), (1, "one two THREE four five"), (3, "\none two three four five")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in ld.dedup_lines(three).collect()} == {1: "one two THREE four five", 2: "x", 3: ""}


def weigh(texts, depth):
    """Context-tree weighting by recursion over dictionaries, straight from its definition."""
    streams = [(" ".join(split(t)) + "\n").encode() for t in texts]
    counts = defaultdict(lambda: [0, 0])
    for s in streams:
        p = b"\n" * depth + s
        for i in range(depth, len(p)):
            for j in range(8):
                node, bit = (1 << j) | p[i] >> (8 - j), p[i] >> (7 - j) & 1
                for d in range(depth + 1):
                    counts[p[i - d : i], node][bit] += 1
    kids = defaultdict(list)
    for c, node in counts:
        if c:
            kids[c[1:], node].append(c)
    pe = lambda a, b: lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(np.pi)
    memo = {}

    def pw(c, node):
        if (c, node) not in memo:
            own = pe(*counts[c, node])
            memo[c, node] = own if len(c) == depth else log(0.5) + np.logaddexp(own, sum(pw(k, node) for k in kids[c, node]))
        return memo[c, node]

    def p1(context, d, node):
        c = context[len(context) - d :]
        a, b = counts[c, node]
        own = (b + 0.5) / (a + b + 1)
        if d == depth:
            return own
        w = np.exp(log(0.5) + pe(a, b) - pw(c, node))
        deeper = context[len(context) - d - 1 :]
        return w * own + (1 - w) * (p1(context, d + 1, node) if (deeper, node) in counts else own)

    def score(text):
        p, total = b"\n" * depth + (" ".join(split(text)) + "\n").encode(), 0.0
        for i in range(depth, len(p)):
            for j in range(8):
                node, bit = (1 << j) | p[i] >> (8 - j), p[i] >> (7 - j) & 1
                one = p1(p[i - depth : i], 0, node) if (b"", node) in counts else 0.5
                total += log10(one if bit else 1 - one)
        return total

    return score


def test_log_gamma():
    x = np.r_[np.arange(0.5, 40, 0.5), 1e3 + 0.5, 1e6, 1e9 + 0.5]
    assert np.allclose(ct.log_gamma(x), [lgamma(v) for v in x], rtol=1e-11, atol=1e-11)


def test_context_tree_equals_its_definition(spark):
    r = random.Random(2)
    texts = [" ".join(r.choice(["the", "of", "Then", "bat", "cat", "ßü"]) for _ in range(r.randrange(0, 25))) for _ in range(24)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x for x in ct.score_texts(docs, F.col("doc_id") % 3 != 0, depth=3, block_bytes=300).collect()}
    learn = [t for i, t in enumerate(texts) if i % 3]
    score, words = weigh(learn, 3), Counter(w for t in learn for w in split(t))
    n, v, ends = sum(words.values()) + len(learn), len(words) + 1, len(learn)
    for i, t in enumerate(texts):
        assert got[i]["score"] == pytest.approx(score(t), rel=1e-9)
        assert got[i]["base_score"] == pytest.approx(sum(log10((words[w] + 1) / (n + v + 1)) for w in split(t)) + log10((ends + 1) / (n + v + 1)), rel=1e-9)
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"], got[i]["held_out"]) == (len(split(t)) + 1, sum(words[w] > 0 for w in split(t)) + 1, n, i % 3 == 0)


def test_context_tree_with_split_pairs_and_pieces(spark, monkeypatch):
    r = random.Random(4)
    texts = [" ".join(r.choice(["the", "then", "of", "bathe", "cat", "ßü"]) for _ in range(r.randrange(0, 40))) for _ in range(20)] + ["the " * 300 + "of"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    score = weigh([t for i, t in enumerate(texts) if i % 3], 4)
    got = {x["doc_id"]: x["score"] for x in ct.score_texts(docs, F.col("doc_id") % 3 != 0, depth=4, block_bytes=500, tree_bytes=40).collect()}
    assert all(got[i] == pytest.approx(score(t), rel=1e-9) for i, t in enumerate(texts))
    deal = ct.Deal(np.r_[np.array([1000, 0, 30, 5]), np.zeros(65532, np.int64)], 40, 4)
    assert deal.split[0] == 25 and deal.parts == 26 and (deal.first[1:] == 0).all()


def test_long_texts_are_streamed_in_pieces(monkeypatch):
    texts = ["Abc  def\t" * 40 + " x" * 7 + "  ", "", "y" * 90 + " z", "  "]
    whole = [ct.Stream(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]), 6) for t in texts]
    monkeypatch.setattr(ct, "CHUNK", 32)
    for k, t in enumerate(texts):
        parts = [ct.Stream(data, at, 6, context, ends) for _, _, data, at, context, ends in ct.pieces(pa.array([t]), 6)]
        assert np.array_equal(np.concatenate([x.code for x in parts]), whole[k].code) and (len(parts) > 1) == (k in (0, 2))
        assert np.array_equal(np.concatenate([x.words() for x in parts]), whole[k].words())


def test_context_tree_probabilities_add_up():
    r = np.random.default_rng(0)
    key, n = ct.count_keys(r.integers(0, 2**20, 500, dtype=np.uint64) << np.uint64(12), np.ones(500, np.int64))
    contexts = [int(key[0]) >> 8, 0x616263]
    every = np.concatenate([(np.uint64(c) << np.uint64(8)) | np.arange(256, dtype=np.uint64) for c in contexts])
    known = ct.count_keys(np.r_[key, every], np.r_[n, 0 * every.astype(np.int64)])
    c1, node, sums = [], [], []
    forest = ct.Forest(key, n, 3)
    for j in range(8):
        two = forest.nodes(j)[2]
        ct.Forest.weigh(two)
        e = forest.entries[2][two["start"]].astype(np.int64)
        c1.append(e >> 16)
        node.append(1 << j | (e & 255) >> (8 - j))
        sums.append(np.stack([two["a"], two["b"], two["pw"]]))
    tops = ct.Tops(np.concatenate(c1), np.concatenate(node), *np.concatenate(sums, 1))
    value = dict(zip(known[0].tolist(), ct.log10_symbols(ct.Forest(*known, 3), tops).tolist()))
    for context in contexts:
        assert sum(10 ** value[context << 8 | s] for s in range(256)) == pytest.approx(1)


def test_context_tree_looks_six_bytes_back(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["abcdeg", "xbcdeh"] * 30)], "doc_id long, text string")
    score, got = weigh([r["text"] for r in docs.collect()], 6), ct.score_texts(docs, F.lit(True)).collect()
    assert all(r["score"] == pytest.approx(score(["abcdeg", "xbcdeh"][r["doc_id"] % 2]), rel=1e-9) for r in got)


def test_keys_are_squeezed_without_loss():
    key = np.unique(np.r_[np.random.default_rng(3).integers(0, 2**64, 999, dtype=np.uint64), 0, 2**64 - 1].astype(np.uint64))
    assert (ct.unsqueeze(ct.squeeze(key)) == key).all() and not len(ct.unsqueeze(ct.squeeze(key[:0])))
    value = -np.random.default_rng(4).random(999) * 12
    assert np.allclose(ct.unsqueeze_values(ct.squeeze_values(value)), value, rtol=2e-11, atol=0)


def test_context_tree_odd_rows(spark, odd_docs, no_docs):
    for learn in (F.lit(True), F.lit(False), F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))):
        got = ct.score_texts(odd_docs, learn).collect()
        assert len(got) == odd_docs.count() and all(np.isfinite(r["score"]) and np.isfinite(r["base_score"]) for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (0, 1, 2)} == {1}
    assert ct.score_texts(no_docs, F.lit(True)).count() == 0


def test_both_vocabulary_files_give_the_same_ids():
    coder = Encoder(Vocabulary.byte_bpe())
    r = random.Random(1)
    texts = [*PROBES, *("".join(chr(r.choice([32, 10, 9, 65, 97, 48, 33, 0xE9, 0x4E2D, 0x1F600, 0xA0])) for _ in range(200)) for _ in range(50))]
    for t in texts:
        assert np.array_equal(coder.ids(t), coder._slow(t))


def test_ids_are_those_of_the_library_with_added_tokens():
    from tokenizers import Tokenizer

    vocabulary = Vocabulary.byte_bpe()
    library, coder = Tokenizer.from_file(vocabulary.json), Encoder(vocabulary)
    for t in ("<|endoftext|> a", "x<|endoftext|><|endoftext|>", "a <|endoftext", "no mark"):
        assert coder.ids(t).tolist() == library.encode(t, add_special_tokens=False).ids
    assert coder.ids("<|endoftext|> a").tolist() == [50256, 257]
    assert 50256 not in Encoder(Vocabulary.byte_bpe(plain=True)).ids("<|endoftext|> a")


def test_separator_scan_refuses_what_would_break_it(spark, tmp_path):
    marked = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    assert [r["n_tokens"] for r in separator_scan.document_tokens(marked, Vocabulary.byte_bpe(plain=True), 50256).collect()] == [9]
    for vocabulary, dtype in ((Vocabulary.byte_bpe(), "<u2"), (Vocabulary.byte_bpe(plain=True), "u1")):
        with pytest.raises(Exception, match="ids up to|separator's id"):
            separator_scan.document_tokens(marked, vocabulary, 50256, dtype).collect()


def check_packing(pieces, docs, length):
    coder, at, owner = encoder(Vocabulary.byte_bpe()), defaultdict(list), defaultdict(list)
    want = {d: np.append(coder.ids(t), np.uint32(1)) for d, t in docs}
    for p in pieces:
        at[p["sequence_id"]].append((p["offset"], p["length"]))
        owner[p["doc_id"]].append(p)
        ids = want[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert zlib.crc32(ids.astype("<u4").tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(want[p["doc_id"]])
    for d, ids in want.items():
        spans = sorted((p["start"], p["length"]) for p in owner[d])
        assert [s for s, _ in spans] == list(np.cumsum([0, *(n for _, n in spans)])[:-1]) and sum(n for _, n in spans) == len(ids)
    padded = 0
    for spans in at.values():
        spans.sort()
        total = sum(n for _, n in spans)
        assert [s for s, _ in spans] == list(np.cumsum([0, *(n for _, n in spans)])[:-1]) and total <= length
        padded += total != length and total & (total - 1) != 0
    assert padded == 0


@pytest.mark.parametrize(("parts", "windows"), [(1, 2), (7, 4)])
def test_packing_is_gapless_and_unpadded(spark, parts, windows):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    pieces = packing.pack(docs.repartition(parts), Vocabulary.byte_bpe(), 512, windows).collect()
    check_packing(pieces, [tuple(r) for r in docs.collect()], 512)


def test_packing_merges_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    docs = spark.createDataFrame([(i, f"word {i} " * (i % 9)) for i in range(90)], "doc_id long, text string").repartition(9)
    check_packing(packing.pack(docs, Vocabulary.byte_bpe(), 64, 3).collect(), [tuple(r) for r in docs.collect()], 64)


def test_packing_odd_rows(spark, odd_docs, no_docs):
    got = packing.pack(odd_docs, Vocabulary.byte_bpe(), keep_ids=True).collect()
    assert {(r["start"], r["length"], r["doc_tokens"]) for r in got if r["doc_id"] in (0, 1)} == {(0, 1, 1)}
    assert all(len(r["ids"]) == 4 * r["length"] for r in got)
    assert packing.pack(no_docs, Vocabulary.byte_bpe()).count() == 0


def test_separator_scan_finds_every_document(spark, odd_docs, no_docs, tmp_path):
    coder = encoder(Vocabulary.byte_bpe())
    got = separator_scan.document_tokens(odd_docs.repartition(3), Vocabulary.byte_bpe(), 50256).collect()
    want = Counter((r["doc_id"], len(coder.ids(r["text"]))) for r in odd_docs.collect())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == want
    assert separator_scan.document_tokens(no_docs, Vocabulary.byte_bpe(), 50256).count() == 0


@pytest.mark.parametrize("block", [4, 6, 1000])
def test_separator_scan_stitches_blocks(spark, tmp_path, block):
    from tableloom.scratch import Scratch

    tokens = np.array([9, 0, 0, 5, 5, 5, 5, 5, 5, 5, 0, 1, 2, 0, 7, 7], "<u2")
    (tmp_path / "a").write_bytes(tokens.tobytes())
    (tmp_path / "b").write_bytes(b"")
    files = spark.createDataFrame([(str(tmp_path / "a"),), (str(tmp_path / "b"),)], "file string")
    got = sorted((r["ordinal"], r["start"], r["n_tokens"], r["ended"]) for r in separator_scan.count_tokens(files, 0, "<u2", Scratch(spark, "t"), block).collect())
    assert got == [(0, 0, 1, True), (1, 2, 0, True), (2, 3, 7, True), (3, 11, 2, True), (4, 14, 2, False)]


def test_targets_share_the_excess():
    assert mixing.targets([10, 100, 1000], [5, 2, 1], 1665, 2) == [20, 200, 1445]
    assert mixing.targets([], [], 0, 2) == [] and mixing.targets([0, 0], [5, 2], 0, 2) == [0, 0]


def test_subset_sum_is_exact_and_bounded():
    r = np.random.default_rng(4)
    for _ in range(1500):
        length = np.unique(r.integers(0, 60, r.integers(1, 9)))
        count = r.integers(1, 5, len(length))
        total = int((length * count).sum())
        budget = int(r.integers(0, total + 5))
        take = mixing.subset_sum(length, count, budget)
        assert (take >= 0).all() and (take <= count).all()
        sums = {0}
        for size, n in zip(length.tolist(), count.tolist(), strict=True):
            sums = {x + k * size for x in sums for k in range(n + 1)}
        assert int((take * length).sum()) == max(x for x in sums if x <= budget)
    assert list(mixing.subset_sum(np.array([6, 39]), np.array([2, 1]), 40)) == [0, 1]
    everything = np.arange(1, 400)
    assert int((mixing.subset_sum(everything, np.full(399, 50), 3_000_017) * everything).sum()) == 3_000_017


def test_subset_sum_of_long_documents_only():
    for length, count, budget in (([50000, 60000], [1, 1], 60000), ([40000, 41000, 42000, 43000], [1] * 4, 83000), ([100000, 120000, 150000], [1] * 3, 150000), ([50000, 60000], [3, 3], 120000)):
        assert int((mixing.subset_sum(np.array(length), np.array(count), budget) * length).sum()) == budget
    r = np.random.default_rng(9)
    for _ in range(30):
        length = np.unique(r.integers(17_000, 200_000, 6))
        count = r.integers(1, 3, len(length))
        budget = int(r.integers(10_000, int((length * count).sum())))
        sums = {0}
        for size, n in zip(length.tolist(), count.tolist(), strict=True):
            sums = {x + k * size for x in sums for k in range(n + 1)}
        take = mixing.subset_sum(length, count, budget)
        got = int((take * length).sum())
        assert (take >= 0).all() and (take <= count).all() and got <= budget
        if budget <= 4 * length.max():
            assert got == max(x for x in sums if x <= budget)


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert {r["doc_id"]: r["size"] for r in rows} == {d["doc_id"]: len(split(d["text"])) for d in docs.collect()}
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.02 * own[0]["target"] + 1
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in own)
    assert sorted(rows, key=str) == sorted(mixing.mix(docs.repartition(5)).collect(), key=str)


def test_mix_odd_rows(spark, odd_docs, no_docs):
    got = mixing.mix(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert {r["source"] for r in got} == {"s0", "s1", None}
    assert mixing.mix(no_docs).count() == 0


def naive_score(net, text):
    """The network's probability by loops over bytes, straight from its definition."""
    p, n = {k: v.astype(float) for k, v in net.p.items()}, len(text)
    halves = max(2, -(-(n + 8) // 32))
    filters = p["filters"].reshape(8, byte_conv.EMBED + 1, byte_conv.FILTERS)

    def answer(at):
        total = p["filter_bias"].copy()
        for j in range(8):
            o = at + j
            total += p["embed"][text[o] if o < n else 0] @ filters[j, :-1]
            if o < n and any(text[o - 7 : o + 1] == text[o - lag - 7 : o - lag + 1] for lag in range(2, 33) if o - lag >= 7):
                total += filters[j, -1]
        return np.maximum(total, 0)

    # A filter looks at eight bytes; the last of a text would reach beyond it.
    h = [sum((answer(32 * k + 4 * i) for i in range(8) if 32 * k + 4 * i + 8 <= 32 * halves), np.zeros(byte_conv.FILTERS)) / 8 for k in range(halves)]
    f = np.array([(x + y) / 2 @ p["mix"] + p["mix_bias"] for x, y in zip(h, h[1:])])
    return 1 / (1 + np.exp(-(np.maximum(f, 0).max(0) @ p["out"] + p["out_bias"][0])))


def scored(net, texts):
    return net.score(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))


def some_texts():
    r = random.Random(3)
    words = [b"the", b"quick", b"###", b"fox", "ß".encode(), b"\x00\x00", b"1234567890"]
    return [b"", b"abc", b"word " * 50, b"###" * 40, b"z" * 64, b"ab" * 300, *(b" ".join(r.choice(words) for _ in range(r.randrange(1, 150))) for _ in range(12))]


def test_network_equals_loops(monkeypatch):
    net, texts = byte_conv.Net(1), some_texts()
    assert np.allclose(scored(net, texts), [naive_score(net, t) for t in texts], atol=1e-5)


def test_network_gradients():
    net = byte_conv.Net(1)
    texts = [b"hello there you all " * 9, b"### *** $$$", b"x" * 100]
    raw = [np.frombuffer(t, np.uint8) for t in texts]
    y, w = np.array([1.0, 0, 1], np.float32), np.array([1.0, 2, 1], np.float32)

    def loss():
        net.tabulate()
        p = scored(net, texts)
        return float((w * -(y * np.log(p) + (1 - y) * np.log(1 - p))).mean())

    g = net.gradients(raw, y, w)
    for name in ("mix", "out", "filters", "embed"):
        flat, at = net.p[name].reshape(-1), int(np.abs(g[name]).argmax())
        old = flat[at]
        flat[at] = old + 1e-2
        up = loss()
        flat[at] = old - 1e-2
        down = loss()
        flat[at] = old
        assert (up - down) / 2e-2 == pytest.approx(g[name].reshape(-1)[at], rel=0.15, abs=1e-4), name


def test_network_scores_do_not_depend_on_neighbours_or_pieces(monkeypatch):
    net = byte_conv.Net(1)
    texts = [*some_texts(), b"end of one text", b"one text starts like the one before ends", b"12345678", b"12345678"]
    alone = [scored(net, [t])[0] for t in texts]
    assert list(scored(net, texts)) == alone and list(scored(net, texts[::-1])) == alone[::-1]
    for piece in (1, 3, 7):
        monkeypatch.setattr(byte_conv, "PIECE", piece)
        assert list(scored(net, texts)) == alone


def test_network_scores_do_not_depend_on_partitions(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    t = byte_conv.Training(epochs=2)
    one, many = ({r["doc_id"]: r["score"] for r in byte_conv.score_quality(docs.repartition(n), labels, t=t).collect()} for n in (1, 7))
    assert one == many and len(set(one.values())) > 10


def test_network_scores_a_very_long_text():
    net, text = byte_conv.Net(1), b"many words of prose, " * 150_000
    assert scored(net, [b"a", text, b"b"])[1] == scored(net, [text])[0] != scored(net, [text + b"#" * 200])[0]


def test_sample_bytes_bound_the_fit(spark):
    docs = spark.createDataFrame([(i, "word " * 50) for i in range(8)] + [(3, "a text")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    assert byte_conv.train(docs, labels, byte_conv.Training(sample_bytes=10)) == 1.0  # only the least text of 3 fits
    assert byte_conv.train(docs, labels, byte_conv.Training(sample_bytes=5)) == 0.5


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = byte_conv.score_quality(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in got])
    assert right >= 0.95 and all(0 <= r["score"] <= 1 for r in got)


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(3, 1), (4, 0), (7, 1), (None, 1), (8, None)], "doc_id long, quality int")
    got = byte_conv.score_quality(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert byte_conv.score_quality(no_docs, labels).count() == 0
    assert {r["score"] for r in byte_conv.score_quality(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert byte_conv.keep_good(odd_docs, labels.limit(0), 0.5).columns == odd_docs.columns
