"""Line dedup, centroid clustering and cross-tokenizer alignment: plain versions, awkward cases, SQL."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.common import awkward, prose, rows, table
from oracle import database, difference

from tidemark.llm import alignment, clustering, lines, oracle_sql, queries
from tidemark.llm.shared import located

FOLDER = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


@pytest.mark.parametrize("name", ["op12_clusters", "op13_line_dedup"])
def test_sql(spark, name):
    got = queries()[name](spark, FOLDER).toPandas()
    assert difference(got, database(FOLDER).execute(oracle_sql()[name]).df()) is None


# Line dedup

def plain_lines(texts, least, documents):
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(SPACES))
    split = [(t or "").split("\n") for t in texts]
    found = Counter(k for ls in split for k in {key(line) for line in ls})
    gone = {k for k, n in found.items() if n >= documents and len(k) >= least}
    return [(len(ls), sum(key(x) in gone for x in ls), "\n".join(x for x in ls if key(x) not in gone)) for ls in split]


def test_lines_of_awkward_rows(spark):
    common = "  Shared LINE É\t"
    cases = awkward() + [
        (20 + k, f"own {k}\n{common.lower() if k % 2 else common}\n\nown {k}\r\n{common}", "hot") for k in range(9)
    ] + [(40, "shared line É", "x"), (41, "shared line é", "x"), (42, "\n", "x"), (43, "a\n" * 50_000 + "SHARED line É", "x"), (43, "　", "x")]
    for least, documents in ((1, 10), (0, 3), (1, 2), (6, 1)):
        got = lines.cleaned(table(spark, cases), least_chars=least, documents=documents)
        want = [(i, *x) for (i, _, _), x in zip(cases, plain_lines([t for _, t, _ in cases], least, documents), strict=True)]
        assert rows(got, "row.doc_id", "n_lines", "n_dropped", "kept") == sorted(want, key=repr)
    assert got.select("row.*").columns == table(spark, []).columns
    kept = lines.kept_rows(table(spark, cases))
    assert kept.columns == table(spark, []).columns and kept.count() == len(cases)
    assert lines.cleaned(table(spark, [])).collect() == []


def test_lines_stay_in_the_engine(spark):
    plan = lines.op13_line_dedup(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_place_of_a_row_beside_a_column_of_that_name(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([(1, "a", "mine")], "doc_id bigint, text string, _metadata string").write.parquet(path)
    got = located(spark.read.parquet(path)).first()
    assert got.row._metadata == "mine" and got.at.file.endswith(".parquet")


# Centroid clustering

def plain_clusters(vectors, clusters=40, rounds=5):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if v and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:clusters]
    centroids = [v for _, v in first]

    def assign():
        out = []
        for _, v in kept:
            gaps = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((gaps.index(min(gaps)), min(gaps)))
        return out

    for _ in range(rounds):
        groups = defaultdict(list)
        for (_, v), (c, _) in zip(kept, assign(), strict=True):
            groups[c].append(v)
        for c, members in groups.items():
            centroids[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    return [(i, c, d) for (i, _), (c, d) in zip(kept, assign(), strict=True)], centroids


@pytest.mark.parametrize("largest", [1.0, 3e5])
def test_clusters_of_awkward_vectors(spark, largest):
    pick = np.random.default_rng(1)
    some = [(k, pick.uniform(-largest, largest, 64).tolist()) for k in range(60)]
    some += [(7, some[7][1]), (None, some[9][1]), (None, some[3][1]), (80, [0.0] * 64), (81, [-largest] * 64), (82, [1e-9] * 64)]
    some += [(100 + k, some[5][1]) for k in range(200)]  # a hot vector
    bad = [(90, None), (91, []), (92, [0.1] * 63), (93, [0.1] * 65), (94, [0.1] * 63 + [None]), (95, [math.nan] + [0.0] * 63), (96, [math.inf] + [0.0] * 63), (97, [0.0] * 63 + [-math.inf])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in some + bad], "vec_id bigint, embedding array<double>, cluster string, x int").repartition(3)
    for clusters in (40, 5):
        got, centroids = clustering.clustered(df, clusters=clusters)
        want, plain = plain_clusters(some, clusters)
        assert centroids.tolist() == plain
        assert rows(got, "vec_id", "cluster", "distance") == sorted(want, key=repr)


def test_few_no_and_too_large_vectors(spark):
    kind = "vec_id bigint, embedding array<float>"
    two = spark.createDataFrame([(1, [1.0] * 64), (2, [-1.0] * 64)], kind)
    got, centroids = clustering.clustered(two)
    assert len(centroids) == 2 and {r.distance for r in got.collect()} == {0}
    got, centroids = clustering.clustered(spark.createDataFrame([], kind))
    assert got.collect() == [] and len(centroids) == 0
    with pytest.raises(Exception, match="component is too large"):
        clustering.clustered(spark.createDataFrame([(1, [1e9] * 64)], kind))


def test_planes():
    pick = np.random.default_rng(2)
    for planes in (1, 2, 10, 28):
        low, high = -(1 << (planes - 1)), (1 << (planes - 1)) - 1
        a, b = pick.integers(low, high, (30, 64), endpoint=True), pick.integers(low, high, (7, 64), endpoint=True)
        p, q = clustering.packed(a, planes), clustering.packed(b, planes)
        assert (clustering.unpacked(p) == a).all()
        assert (clustering.dots(p, q) == a @ b.T).all() and (clustering.squares(p) == (a * a).sum(axis=1)).all()


# Alignment

def plain_alignment(texts):
    """By the definition: cuts where both end, links by overlapping byte ranges."""
    tokenizer, entries = alignment.first_library(alignment.FIRST)
    model, pieces = alignment.second_library(alignment.SECOND)
    made, counts = [], Counter()
    for text in texts:
        ones, others = ([], []) if not text else (tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text))
        data = (" " + (text or "")).encode()
        if b"".join(entries[i] for i in ones) != data or b"".join(pieces[i] for i in others) != data:
            ones, others = [], []
        spans = []
        for ids, values in ((ones, entries), (others, pieces)):
            at, side = 0, []
            for i in ids:
                side.append((at, at + len(values[i]), i))
                at += len(values[i])
            spans.append(side)
        links = [(a, b) for s, e, a in spans[0] for x, y, b in spans[1] if max(s, x) < min(e, y)] if len(ones) < 3000 else None
        if links is None:  # the same by walking both sides
            links, i, j = [], 0, 0
            while i < len(ones):
                links.append((spans[0][i][2], spans[1][j][2]))
                e, y = spans[0][i][1], spans[1][j][1]
                i, j = i + (e <= y), j + (y <= e)
        both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, begin = [], 0
        for end in both:
            groups.append("|".join(",".join(str(i) for s, e, i in side if begin <= s < end) for side in spans) if len(ones) < 3000 else None)
            begin = end
        counts.update(links)
        made.append((len(ones), len(others), both, links, groups))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (a, b, len(both), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
         None if None in groups else hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
        for a, b, both, links, groups in made
    ]


def check_alignment(spark, cases, head):
    got = rows(alignment.summed(table(spark, cases), head=head), "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    want = sorted(((i, *x) for (i, _, _), x in zip(cases, plain_alignment([t for _, t, _ in cases]), strict=True)), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[: 7 + (w[7] is not None)] == w[: 7 + (w[7] is not None)]


def test_alignment_of_awkward_rows(spark):
    cases = awkward() + [(30, "▁ mark", "x"), (31, " lead", "x"), (32, "日本語のテキスト 🎉🎉", "x"), (33, "<s> <0x41> </s><unk>", "x"), (34, "a\x00b\x7f", "x"), (35, "\n\n\t x  ", "x")]
    check_alignment(spark, cases, 1 << 18)
    check_alignment(spark, cases, 5)
    check_alignment(spark, [(1, None, "x"), (2, "", "x")], 10)
    check_alignment(spark, [(1, "ends. here \n", "x"), (2, "two  spaces here", "x"), (3, " ends. here \n", "x"), (4, "\u2581a a", "x"), (5, "a a", "x")], 10)
    assert alignment.summed(table(spark, [])).collect() == []


def test_alignment_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries()["op11_alignment"](spark, FOLDER).collect()}
    assert got.keys() == docs.keys()
    for i, w in zip(docs, plain_alignment(docs.values()), strict=True):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == w[:6]
        assert w[6] is None or r.groups_sha256 == w[6]


def test_both_libraries_agree_on_latin_chunks():
    pick = np.random.default_rng(4)
    common = list("aeinrst ,.'12\n") + ["'s", "'ll", "  "]
    chunks = [" " + "".join(pick.choice(common) if pick.random() < 0.6 else chr(pick.integers(0, 0x250)) for _ in range(pick.integers(1, 25))) for _ in range(20_000)]
    assert not any(alignment.OTHER(chunk) for chunk in chunks)
    tokenizer = alignment.first_library(alignment.FIRST)[0]
    want = [x.ids for x in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
    assert alignment.first_ids(chunks, alignment.FIRST) == want and alignment.fast_library(alignment.FIRST) is not None


def test_a_text_is_the_sum_of_its_chunks():
    """With and without cuts, over random texts, and with a table of chunks that begins anew with each slice."""
    pick = np.random.default_rng(5)
    words = ["the", "end.", "one", "é", "“x”", "日本", "a  b", "\n", "x\n", "</s>", "it's", "1,000", "—", "\u00a0", "..."]
    texts = [" ".join(pick.choice(words, pick.integers(0, 30))) for _ in range(300)] + ["", " ", "  a", "a ", None]
    cut, whole, small = (alignment.Chunks(alignment.FIRST, alignment.SECOND) for _ in range(3))
    whole.whole, small.MOST = True, 0
    want = alignment.aligned(texts, whole)
    for got in (alignment.aligned(texts, cut), alignment.aligned(texts, cut), alignment.aligned(texts[:9], small) and alignment.aligned(texts, small)):
        assert got["digests"] == want["digests"]
        assert all((got[name] == want[name]).all() for name in want if name != "digests")
    assert len(cut.groups) < len(whole.groups) * 10


def test_pointer_jumping():
    left, right = np.array([2, 5, 7, 9, 14, 20]), np.array([3, 6, 7, 12, 16, 20])
    assert alignment.labels(left, right).tolist() == [2, 2, 2, 5, 5, 5, 2, 2, 2, 5, 5, 5]
    long = np.arange(1, 100_001) * 2  # a chain over all tokens
    assert set(alignment.labels(np.append(long, 200_003), np.append(long + 1, 200_003)[:]).tolist()) == {100_000}
    assert alignment.labels(np.array([], int), np.array([], int)).tolist() == []


def test_written_groups():
    data, stops = alignment.written(np.array([12, 0, 50256]), np.array([7, 100, 31999, 9]), np.array([0, 0, 1]), np.array([0, 1, 1, 1]))
    assert data.tobytes() == b"12,0|7;50256|100,31999,9;" and stops.tolist() == [7, 25]


def test_lines_and_prose_together(spark):
    docs = [(k, prose(k, 30) + "\nfooter", "s") for k in range(12)]
    assert {r.kept for r in lines.cleaned(table(spark, docs)).collect()} == {prose(k, 30) for k in range(12)}
