"""URL filter, exact dedup, mixing and chat windows: awkward cases, and SQL on the given tables."""

import hashlib
import re
from collections import defaultdict

import pytest
from llm.common import awkward, rows, table
from oracle import database, difference

from tidemark.llm import chat, exact, mixing, oracle_sql, queries, urls

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_agrees_with_sql(spark, name):
    got = queries()[name](spark, FOLDER)
    want = database(FOLDER).execute(oracle_sql()[name]).df()
    frame = __import__("pandas").DataFrame([r.asDict() for r in got.collect()], columns=got.columns).astype(
        {c: want[c].dtype for c in got.columns if want[c].dtype != object}
    )
    assert difference(frame, want) is None


URLS = [
    (1, "http://WWW.Example.COM/en/x?q#f"), (2, "https://example.com/en/1"), (3, "http://a.net/es/"), (4, "http://a.net/de/"),
    (5, None), (6, ""), (7, "no scheme"), (8, "http://x.com"), (9, "http://x.com?a=/b"), (10, "ftp://sub.example.com/en/#"),
    (11, "http://notexample.com/en/"), (12, "http://é.net/fr/日本"), (12, "http://é.net/fr/日本"), (13, "http://a.org/" + "p" * 30_000),
    (14, "://h/p://q"),
]


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "g", "v") for i, u in URLS], "page_id long, url string, html string, gram string, verdict string")
    got = {r.page_id: r for r in urls.judged(pages).collect()}
    assert len(got) == len({i for i, _ in URLS}) and urls.judged(pages).count() == len(URLS)
    expected = {
        1: ("www.example.com", "/en/x", "www.example.com/en/", "allow"), 2: ("example.com", "/en/1", "example.com/en/", "block"),
        3: ("a.net", "/es/", "net/es/", "block"), 8: ("x.com", "", None, None), 9: ("x.com", "", None, None),
        10: ("sub.example.com", "/en/", "example.com/en/", "block"), 11: ("notexample.com", "/en/", "com/", "allow"),
        12: ("é.net", "/fr/日本", "net/fr/", "block"), 5: ("", "", None, None), 7: ("", "", None, None), 14: ("h", "/p://q", None, None),
    }
    for i, (host, path, rule, verdict) in expected.items():
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert verdict in (None, got[i].verdict) and got[i].verdict in ("allow", "block")


def test_url_model_tells_sides_apart(spark):
    good = [(i, f"http://news.com/story/{i}/reading") for i in range(60)]
    bad = [(100 + i, f"http://a.net/es/xxqq-{i}-zzkk") for i in range(60)]
    pages = spark.createDataFrame([*good, *bad, (500, "http://q.org/story/7/reading"), (501, "http://q.org/xxqq-9-zzkk")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judged(pages).collect()}
    assert (got[500], got[501]) == ("allow", "block")


def test_url_empty_and_unlabelled(spark):
    kind = "page_id long, url string"
    assert urls.judged(spark.createDataFrame([], kind)).collect() == []
    assert [r.verdict for r in urls.judged(spark.createDataFrame([(1, "http://a.org/")], kind)).collect()] == ["allow"]


def plain_groups(cases):
    by = defaultdict(list)
    for i, t, _ in cases:
        by[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    return {key: (min(found)[3], len(found)) for key, found in by.items()}


@pytest.mark.parametrize("digits", [64, 1])
def test_exact_groups(spark, digits):
    """One hex digit for a key makes different texts meet, so the check of full bytes has to part them."""
    cases, plain = awkward(), plain_groups(awkward())
    got = exact.groups(table(spark, cases), digest_chars=digits)
    want = []
    for i, t, _ in cases:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        want.append((i, *plain[key], hashlib.sha256(key.encode()).hexdigest()))
    assert rows(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=repr)
    assert got.where("kept").count() == len(plain)
    assert exact.groups(table(spark, [])).collect() == []


def test_exact_state_goes_on(spark, tmp_path):
    """A second run from the same checkpoint updates the groups with the new arrivals."""
    from tidemark.llm.shared import located

    def arrive(cases):
        exact.with_digest(located(table(spark, cases)), "doc_id", "text", 64).drop("text").write.mode("append").parquet(str(tmp_path / "in"))
        return exact.resolve(spark.read.parquet(str(tmp_path / "in")), str(tmp_path / "run"), str(tmp_path / "in"))

    assert rows(arrive([(1, "a b", "s"), (2, "c", "s")]), "best.doc_id", "n") == [(1, 1), (2, 1)]
    assert rows(arrive([(3, "a  b", "s")]), "best.doc_id", "n") == [(2, 1), (3, 2)]


def test_exact_kept_rows_keep_columns(spark):
    docs = table(spark, awkward())
    kept = exact.kept_rows(docs)
    assert kept.columns == docs.columns and kept.count() == len(plain_groups(awkward()))


def test_mixing(spark):
    cases = awkward()
    got = mixing.mixed(table(spark, cases)).collect()
    sizes = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in cases)
    assert sorted(r["size"] for r in got) == sizes
    assert all(r.taken <= 2 * r["size"] and r.taken % max(1, r["size"]) == 0 for r in got)
    assert mixing.mixed(table(spark, [])).collect() == []
    assert [tuple(r) for r in mixing.mixed(table(spark, [(1, None, None)])).collect()] == [(1, 0, 0, 0.0, 0)]


def test_targets_fill_up(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got == pytest.approx({"a": 200.0, "b": 1445.0, "c": 20.0, None: 0.0})


def test_sample_of_unequal_copies(spark):
    rows_ = spark.createDataFrame([(i, 10, 1, 0.9 if i % 3 == 0 else 0.2 if i % 3 == 1 else 1.5) for i in range(3000)], "doc_id long, size long, place int, copies double")
    got = mixing.sampled(rows_).groupBy((rows_.doc_id % 3).alias("k")).avg("times").collect()
    assert {r.k: r["avg(times)"] for r in got} == pytest.approx({0: 0.9, 1: 0.2, 2: 1.5}, abs=0.05)
    taken = mixing.sampled(rows_).selectExpr("sum(times * size)").first()[0]
    assert abs(taken - 26_000) <= 10


TALKS = [
    (1, 0, "system", "be <kind> \\l"), (1, 1, "user", "hi"), (1, 2, "assistant", chat.TRAP), (2, 0, "assistant", None), (2, 0, "assistant", None),
    (3, 0, "system", "alone"), (4, None, None, "w " * 5000), (4, 1, "assistant", "x " * 300), (4, 2, "user", ""), (4, 3, "assistant", "</turn><turn>"),
    (None, 1, "user", "lost"), (None, 2, "assistant", "found"), (5, 1, "assistant<", "\\<"), (5, 2, "system", "late"),
    *[(6, k, ("user", "assistant")[k % 2], f"turn {k} " * (k % 7 * 10)) for k in range(200)],
]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame([(*t, "w", "r") for t in TALKS], "conv_id long, turn long, role string, text string, window string, rank string")
    windows = chat.formatted(turns)
    by = defaultdict(list)
    for c, n, role, text in TALKS:
        by[c].append((n is not None, n or 0, role or "", text or ""))
    for r in chat.read_back(windows).collect():
        said = sorted(by[r.conv_id])
        learned = "".join(t for _, _, role, t in said if role == "assistant")
        assert r.n_turns == len(said) and r.loss_chars == len(learned)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{t}\n" for _, _, role, t in said).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    for r in windows.where("conv_id = 6").collect():
        shown = re.findall("<turn>([^<]*)<text>([^<]*)</turn>", r.text)
        assert sum(len(t.split()) + chat.OVERHEAD for _, t in shown) <= chat.BUDGET
        assert sum(len(t.split()) + chat.OVERHEAD for _, t in shown[: r.n_repeated]) <= chat.HISTORY
    assert windows.where("conv_id = 6 and n_repeated > 0").count() > 20
    assert chat.read_back(chat.formatted(turns.limit(0))).collect() == []
