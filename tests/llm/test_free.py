"""Classifier, language model, decontamination, SimHash, token counts and byte removal against plain versions."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from llm.common import awkward, prose, rows, table

from tidemark.llm import bitmaps, compression, parsing, queries, semantic, simhash, suffix_tree, token_counts

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def fold(i, parts):
    return zlib.crc32(str(i).encode()) % parts


# Quality

def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries()["op3_quality"](spark, folder).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = [(got[i].predicted, q) for i, q in labels.items() if i in got and got[i].held_out]
    assert all(r.held_out == (fold(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    assert sum(p == q for p, q in held) / len(held) > 0.93
    assert sum(p == 0 for p, q in held if q == 1) <= 0.03 * len(held)


def plain_quality(texts, labels):
    """Scores by the docstring's rules: a dictionary of two thirds of each label's sample, sizes block by block, the curve
    by plain Newton steps over the rest."""
    import zstandard

    signed = lambda h: h - 2**64 if h >= 2**63 else h
    shown = {i: q for i, q in labels.items() if i in texts and q in (0, 1) and fold(i, 5)}
    share = Counter(shown.values())
    sample = {
        q: [texts[i].encode() for i in sorted(
            (i for i, x in shown.items() if x == q and 1 <= len(texts[i].encode()) <= compression.TEXT_BYTES),
            key=lambda i: (signed(xxhash.xxh64_intdigest(str(i), 42)), str(i)),
        )[: compression.SAMPLE]] for q in (0, 1)
    }
    cut = {q: (2 * len(t) + 2) // 3 for q, t in sample.items()}
    books = [zstandard.ZstdCompressionDict(compression.trained(sample[q][: cut[q]])) for q in (1, 0)]

    def size(text, book=None):
        whole = 0
        for k in range(0, len(text), 65_536):
            make = lambda: zstandard.ZstdCompressor(level=3, write_content_size=False, **({"dict_data": book, "write_dict_id": False} if book else {}))
            whole += len(make().compress(text[k : k + 65_536])) - len(make().compress(b""))
        return max(1, whole)

    def measures(text):
        if not text:
            return [0.0, 0.0, 0.0, 1.0]
        good, bad, plain = size(text, books[0]), size(text, books[1]), size(text)
        ratio = min(0.0, math.log(plain / len(text)))
        return [(bad - good) / plain, ratio, ratio**2, 1.0]

    rest = {q: t[cut[q] :] or t for q, t in sample.items()}
    x = np.array([measures(t) for q in (0, 1) for t in rest[q]])
    y = np.array([float(q) for q in (0, 1) for _ in rest[q]])
    w = np.zeros(4)
    for _ in range(200):
        p = 1 / (1 + np.exp(-(x @ w)))
        slope = sum((yk - pk) * xk for xk, yk, pk in zip(x, y, p, strict=True)) - np.array([0.01, 0.01, 0.01, 1e-9]) * w
        bend = sum(pk * (1 - pk) * np.outer(xk, xk) for xk, pk in zip(x, p, strict=True)) + np.diag([0.01, 0.01, 0.01, 1e-9])
        w = w + np.linalg.inv(bend) @ slope
    w[3] += math.log(share[1] / share[0]) - math.log(len(rest[1]) / len(rest[0]))
    return {i: 1 / (1 + math.exp(-float(np.dot(measures(t.encode()), w)))) for i, t in texts.items()}


def test_quality_against_plain_version(spark, documents):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    want = plain_quality(documents, labels)
    got = {r.doc_id: r for r in queries()["op3_quality"](spark, SMALL).collect()}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert r.score == pytest.approx(want[i], abs=1e-6) and r.predicted == (r.score >= 0.3) and r.held_out == (fold(i, 5) == 0)


def test_dictionaries_of_few_texts():
    """Too few texts for zstandard's training: their bytes are the dictionary."""
    texts = [b"some good text", b"another one"]
    assert compression.trained(texts) == b"some good text\nanother one"
    many = [prose(k, 200).encode() for k in range(300)]
    assert compression.trained(many) not in (b"", b"\n".join(many)[-compression.DICTIONARY :])


def test_quality_cases(spark):
    docs = table(spark, awkward())
    none = docs.selectExpr("doc_id", "text", "cast(null as int) quality")
    assert {round(r.score, 6) for r in compression.scored(docs, none).collect()} == {0.5}
    one = docs.selectExpr("doc_id", "text", "1 quality")
    assert all(r.score > 0.99 for r in compression.scored(docs, one).collect())
    both = docs.selectExpr("doc_id", "text", "cast(doc_id % 2 as int) quality")
    got = compression.scored(docs, both)
    assert got.select("row.*").columns == docs.columns and got.count() == docs.count()
    assert compression.scored(table(spark, []), both).collect() == []


# Language model

def plain_scores(texts, training):
    tokens = {i: [*(w.decode() for w in t.encode().lower().split()), ""] for i, t in texts.items()}
    c = Counter(w for i in training for w in tokens[i])
    n, v = sum(c.values()), len(c)
    return {i: (len(ts), sum(c[w] > 0 for w in ts), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts)) for i, ts in tokens.items()}


def test_base_scores(spark, documents):
    got = {r.doc_id: r for r in queries()["op4_suffix_tree"](spark, SMALL).collect()}
    plain = plain_scores(documents, [i for i in documents if fold(i, 10)])
    assert got.keys() == plain.keys()
    for i, (size, known, n, base) in plain.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (size, known, n, fold(i, 10) == 0)
        assert r.base_score == pytest.approx(base)
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


def plain_tree(lines, frequent, least, depth):
    """Contexts of up to `depth` words by the docstring's rules, and P of a token behind given words."""
    tokens = [[*line.split(), ""] for line in lines]
    c = Counter(w for ts in tokens for w in ts)
    n, v = sum(c.values()), len(c)
    root = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    kept, entries, totals = {}, defaultdict(dict), {}

    def p(w, context):
        while context and context not in kept:
            context = context[1:]
        if not context:
            return root(w)
        found = entries[context]
        rest = 1 - 0.9 * sum(found.values()) / totals[context]
        return 0.9 * found.get(w, 0) / totals[context] + rest * p(w, context[1:])

    candidates = {(w,): k for w, k in c.items() if w and k >= frequent}
    for size in range(1, depth + 1):
        after = defaultdict(Counter)
        for ts in tokens:
            for i in range(size, len(ts)):
                if tuple(ts[i - size : i]) in candidates:
                    after[tuple(ts[i - size : i])][ts[i]] += 1
        stay, longer = {}, {}
        for s, total in candidates.items():
            found = {w: k for w, k in after[s].items() if k >= least}
            longer |= {(*s, w): k for w, k in found.items() if w and k >= frequent}
            told, expected = sum(found.values()) / total, min(sum(p(w, s[1:]) for w in found), 1 - 1e-9)
            gain = sum(k * math.log(k / total / p(w, s[1:])) for w, k in found.items())
            if told < 1:
                gain += total * (1 - told) * math.log((1 - told) / (1 - expected))
            if found and gain > 0.5 * math.log(n) * (len(found) + 1):
                stay[s] = found
                totals[s] = total
        for s, found in stay.items():
            entries[s] = found
        kept |= stay
        candidates = longer
    return p, kept, c


@pytest.mark.parametrize("depth", [1, 3])
def test_tree_against_plain_version(spark, depth):
    """All in memory, a part of the contexts by joins, all by joins: the same scores."""
    lines = [prose(k % 9, 60, 30) for k in range(40)] + ["", "a b a b a b", "a", "a b a b a b a"]
    for k in range(12):  # what follows depends on the last word and the third last
        pick = np.random.default_rng(k)
        walk = pick.integers(0, 4, 3).tolist()
        for _ in range(150):
            walk.append((walk[-1] + 2 * walk[-3] + int(pick.random() < 0.1)) % 4)
        lines.append(" ".join(f"x{w}" for w in walk))
    docs = table(spark, [(i, t, "s") for i, t in enumerate(lines)])
    p, kept, c = plain_tree(lines, 5, 2, depth)
    assert {len(s) for s in kept} == set(range(1, depth + 1))
    for s in [(), *list(kept)[:20], *[s for s in kept if len(s) == depth][:20]]:  # distributions sum to 1 with one unseen word's share
        assert sum(p(w, s) for w in c) + p("unseen", s) == pytest.approx(1)
    want = []
    for i, line in enumerate(lines):
        ts = [*line.split(), ""]
        want.append((i, sum(math.log10(p(w, tuple(ts[max(0, k - depth) : k]))) for k, w in enumerate(ts))))
    for near in ({}, {"near_contexts": len(kept) // 2}, {"near_entries": 0}, {"head_size": 5}):
        got = suffix_tree.scored(docs, docs, depth=depth, context_least=5, entry_least=2, **near)
        assert {r.doc_id: r.score for r in got.collect()} == {i: pytest.approx(score) for i, score in want}
        assert got.selectExpr("sum(n_known)").first()[0] == sum(c.values())


def test_what_the_tree_learns_grows(spark):
    """The entries kept of four times the texts are more than twice as many, with the same parameters."""
    texts = [prose(k, 200, 3000) + " " + prose(k % 40, 100, 90) for k in range(400)]
    many = []
    for size in (100, 400):
        docs = table(spark, [(i, t, "s") for i, t in enumerate(texts[:size])])
        counts = suffix_tree.unigrams(docs)
        v, n = counts.selectExpr("count(*)", "sum(n)").first()
        levels = suffix_tree.grown(docs.select("text"), counts, v, n, 2, 16, 3)
        many.append(sum(level.entries.count() for level in levels))
    assert many[1] > 2 * many[0] > 0


def test_bitmaps(spark):
    pick = np.random.default_rng(6).integers(-(2**63), 2**63, 3000)
    bits = bitmaps.bitmap(spark.createDataFrame([(int(x),) for x in pick[:1000]], "k long"), "k")
    found = bitmaps.inside(bits, pick.view(np.uint64))
    assert found[:1000].all() and found[1000:].mean() < 0.05 and len(bits) == 1 << 12
    full = bitmaps.bitmap(spark.createDataFrame([(int(x),) for x in pick], "k long"), "k", 16)
    assert len(full) == 1 << 13 and bitmaps.inside(full, pick.view(np.uint64)).all()


def test_hashes_of_words():
    import pyarrow as pa

    words = sorted({prose(k, 1, 3000) for k in range(3000)} | {"", "a", "aa", "aaa", "é", "日本", "ab", "ba"})
    found = suffix_tree.numbers(pa.array(words, pa.large_string()))
    assert len(set(found.tolist())) == len(words)
    cut = suffix_tree.numbers(pa.array(words, pa.large_string()).slice(5, 9))
    assert (cut == found[5:14]).all() and len(suffix_tree.numbers(pa.array([], pa.large_string()))) == 0


def test_states():
    ids = np.arange(5, dtype=np.uint64) * np.uint64(77)
    *_, (at, last) = suffix_tree.states(ids, np.array([0, 1, 2, 3, 0]), 3)
    assert at.tolist() == [3] and int(last[0].view(np.int64)) == suffix_tree.states_of([0, 77, 154])[-1]


def test_language_model_cases(spark):
    docs = table(spark, awkward())
    got = suffix_tree.scored(docs, docs.limit(0))
    assert {(r.n_known, r.train_tokens, r.score) for r in got.collect()} == {(0, 0, 0.0)}
    assert suffix_tree.scored(docs.limit(0), docs).collect() == []
    assert suffix_tree.scored(docs, docs).where("n_tokens = 1").count() == 4


# SimHash

def plain_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes))


def plain_components(fps):
    """fps: (name, fingerprint); the smallest name reachable of each."""
    root = list(range(len(fps)))

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    values = np.array([f for _, f in fps], np.uint64)
    for a in range(len(fps)):
        for b in np.flatnonzero(np.bitwise_count(values[a + 1 :] ^ values[a]) <= 3):
            root[top(a + 1 + int(b))] = top(a)
    least = {}
    for k, (name, _) in enumerate(fps):
        least[top(k)] = min((x for x in (least.get(top(k)), name) if x is not None), default=None)
    return [least[top(k)] for k in range(len(fps))]


def test_simhash_cases(spark):
    cases = awkward()
    fps = [(i, plain_fingerprint(t or "")) for i, t, _ in cases]
    want = [(i, f"{f:016x}", c) for (i, f), c in zip(fps, plain_components(fps), strict=True)]
    assert rows(simhash.grouped(table(spark, cases)), "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    assert simhash.grouped(table(spark, [])).collect() == []
    kept = simhash.kept_rows(table(spark, cases))
    assert {r.doc_id for r in kept.collect()} == {1, 3, 6, 8, 10, 11, 12, 13, 14} and kept.count() == 9
    assert kept.columns == table(spark, []).columns
    assert simhash.kept_rows(table(spark, [])).collect() == []


def test_simhash_on_documents(spark, documents):
    fps = [(i, plain_fingerprint(t)) for i, t in sorted(documents.items())]
    want = dict(zip(documents and [i for i, _ in fps], plain_components(fps), strict=True))
    assert {r.doc_id: r.component_id for r in queries()["op7_simhash"](spark, SMALL).collect()} == want


@pytest.mark.parametrize("cell", [8192, 4])
def test_links_lose_nothing(spark, cell):
    """Chains and clusters at up to 3 bits, over all bits; with small cells anchors are dealt out in blocks."""
    pick = np.random.default_rng(3)
    values = list(pick.integers(0, 2**64, 60, dtype=np.uint64))
    for k in range(700):
        flips = pick.choice(64, size=int(pick.integers(1, 5)), replace=False)
        values.append(values[int(pick.integers(0, len(values)))] ^ np.uint64(sum(1 << int(b) for b in flips)))
    distinct = sorted({int(v) for v in values})
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in distinct], "fp long")
    found = {(int(np.int64(r.a).astype(np.uint64)), int(np.int64(r.b).astype(np.uint64))) for r in simhash.links(frame, cell).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    from tidemark.llm.components import components
    edges = spark.createDataFrame([(a - 2**63, b - 2**63) for a, b in found], "a long, b long")
    got = {r.node + 2**63: r.root + 2**63 for r in components(edges).collect()}
    want = plain_components([(v, v) for v in distinct])
    assert [got.get(v, v) for v in distinct] == want


# Token counts

def test_token_counts(spark, documents):
    cases = [(i, t, "s") for i, t, _ in awkward()] + [(1000 + i, t, "s") for i, t in documents.items()]
    odd = ["<|endoftext|>", "a<|endoftext|>  b <|endoftext|>", " \n\n x\t\t\ty  ", "don't we'LL I'M", "x\x1c\x1dy\x85z\u200b\u3000q\u2028", "12ab३४ ½²"]
    cases += [(5000 + k, t, "s") for k, t in enumerate(odd)]
    tokenizer = token_counts.library(token_counts.TOKENIZER)[0]
    want = []
    for i, t, _ in cases:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    got = token_counts.counted(table(spark, cases))
    assert rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    assert token_counts.counted(table(spark, [])).collect() == []


# Decontamination

ITEMS = [(k, prose(100 + k, n) + ". " + prose(200 + k, 6) + ".") for k, n in enumerate([20, 30, 45, 12, 9])] + [(7, "too short"), (8, None), (9, "")]


def test_leaks_are_found(spark):
    clean = [(i, prose(1000 + i, 150), "s") for i in range(60)]
    leaks = [(100 + k, f"{prose(2000 + k, 37 + k)} {t} {prose(3000 + k, 21)}", "s") for k, t in ITEMS[:5]]
    words = ITEMS[2][1].split()
    edited = " ".join(w if k % 9 else "changed" for k, w in enumerate(words))  # a word in nine replaced
    docs = table(spark, [*clean, *leaks, (200, prose(9, 50) + " " + edited + " " + prose(10, 50), "s"), (201, ITEMS[1][1].upper(), "s"), (202, None, "s"), (203, "", "s")])
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = rows(semantic.matched(docs, bench), "doc_id", "item_id")
    assert got == sorted([*[(100 + k, k) for k in range(5)], (200, 2), (201, 1)], key=repr)
    assert semantic.kept_rows(docs, bench).count() == docs.count() - 7
    assert semantic.matched(docs, bench.limit(0)).collect() == [] and semantic.matched(docs.limit(0), bench).collect() == []


def test_leaks_in_given_documents(spark):
    """Every document that holds an item as it stands is found, and none without most of an item's word pairs."""
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: " ".join((r.text or "").split()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r.item_id: " ".join(r.text.split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in queries()["op6_decontamination"](spark, folder).collect()}
    assert {(i, k) for i, t in docs.items() for k, item in items.items() if item in t} <= found
    pairs = lambda t: set(zip(t.lower().split(), t.lower().split()[1:], strict=False))
    assert all(len(pairs(items[k]) & pairs(docs[i])) > 0.5 * len(pairs(items[k])) for i, k in found)


def test_lcs():
    a, b = np.array([1, 2, 3, 4, 5]), np.array([9, 1, 3, 9, 5, 4])
    assert semantic.lcs(a, b) == 3 and semantic.lcs(a, a) == 5 and semantic.lcs(a, b[:1]) == 0


# Repeated bytes

def plain_removal(texts):
    counts = Counter(t[p : p + 200] for t in texts for p in range(len(t) - 199))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - 199):
            if counts[t[p : p + 200]] > 1:
                gone[p : p + 200] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check_removal(spark, cases):
    got = parsing.cleaned(table(spark, cases)).selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) h")
    want = [(i, *r) for (i, _, _), r in zip(cases, plain_removal([(t or "").encode() for _, t, _ in cases]), strict=True)]
    assert rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "h") == sorted(want, key=repr)


def test_removal_cases(spark):
    cases = [(i, t if t is None or len(t) < 50_000 else t[:9000], s) for i, t, s in awkward()]
    check_removal(spark, cases)
    assert parsing.cleaned(table(spark, [])).collect() == []


def test_removal_at_edges(spark):
    """Passages of 199 to 340 bytes, shifted, nested and overlapping, in many contexts."""
    base = prose(77, 400)
    cases = [(k, prose(500 + k, 20) + base[7 * k : 7 * k + 195 + 5 * k] + prose(600 + k, 20), "s") for k in range(30)]
    cases += [(100 + k, base[300:499] + str(k), "s") for k in range(4)] + [(200 + k, base[300:500] + str(k), "s") for k in range(3)]
    check_removal(spark, cases)


def test_removal_on_documents(spark, documents):
    check_removal(spark, [(i, t, "s") for i, t in documents.items()])


def test_removal_across_a_chunk_of_a_long_text(spark):
    """A passage that lies over the border of a million bytes, and one that a text holds twice, far apart."""
    passage, twice = prose(900, 90), prose(901, 60)
    long = prose(902, 170_000, 5000).encode()[:1_100_000].decode()
    a = f"{long[:999_800]}#{passage}@{long[999_800:1_050_000]}#{twice}@{long[1_050_000:]}#{twice}%"
    got = rows(parsing.cleaned(table(spark, [(1, a, "s"), (2, f"%{passage}!", "s")])), "doc_id", "n_bytes", "n_removed", "n_spans")
    # What stands before and behind a passage differs, but for the '#' before one that stands twice behind it.
    assert got == [(1, len(a), len(passage) + 2 * (len(twice) + 1), 3), (2, len(passage) + 2, len(passage), 1)]


def test_removal_in_chunks(spark, monkeypatch):
    """Long texts are parsed in chunks."""
    hashed = parsing.Hasher
    monkeypatch.setattr(parsing, "CHUNK", 3000)
    text = prose(5, 3000)
    data = text.encode()
    pieces = [(tuple(o), tuple(s)) for _, o, s, _ in parsing.pieces(__import__("pyarrow").table({"text": [data]}))]
    starts = [x for o, _ in pieces for x in o]
    assert starts == list(range(0, len(data) - 199, 3000)) and hashed is parsing.Hasher
