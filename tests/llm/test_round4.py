"""The language model's tables: what a task holds at once, counts by block, and words that share a hash."""

from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from llm.common import prose

from tidemark.llm import bitmaps, suffix_tree
from tidemark.llm.shared import noting


def test_tables_are_written_in_small_batches(spark):
    """30 MB in one partition reach the task in batches of some 4 MB, all of them; the session's settings are as before."""

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"rows": pa.array([batch.num_rows]), "size": pa.array([batch.nbytes])})

    keys = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = [spark.conf.get(key, None) for key in keys]
    texts = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) text")
    got = suffix_tree.saved(texts.mapInArrow(sizes, "rows long, size long")).collect()
    assert sum(r.rows for r in got) == 3000 and max(r["size"] for r in got) < 8_000_000
    assert [spark.conf.get(key, None) for key in keys] == before


def test_pairs_are_counted_by_block(spark):
    """Pairs of a context of two words and what follows it, over tasks and blocks, against a plain count."""
    texts = [prose(k, 300, 12) for k in range(20)] + [None, "", "a", "a b"]
    plain = Counter()
    for text in texts:
        ids = [int(x) for x in suffix_tree.numbers(pa.array([*(text or "").split(), ""], pa.large_string())).view(np.int64)]
        plain.update((suffix_tree.states_of(ids[k - 2 : k])[-1], ids[k]) for k in range(2, len(ids)))
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    bits = [
        spark.sparkContext.broadcast(bitmaps.bitmap(spark.createDataFrame([(x,) for x in {pair[k] for pair in plain}], "k long"), "k"))
        for k in (0, 1)
    ]
    want = {pair: times for pair, times in plain.items() if times >= 4}
    assert 0 < len(want) < len(plain)
    got = suffix_tree.followers(rows, *bits, length=2, least=4, blocks=7).collect()
    assert {(r.s, r.h): r.n for r in got} == want and len(got) == len(want)


def test_words_that_share_a_hash_are_told_apart():
    known, distinct = pa.array(["a", "b", "c"], pa.large_string()), pa.array(["b", "x", "c", "d", ""], pa.large_string())
    hashes = np.array([5, 5, 9, 9, 7], np.uint64)  # x as b, d as c
    assert suffix_tree.placed(distinct, hashes, known, np.array([2, 5, 9], np.uint64)).tolist() == [1, -1, 2, -1, -1]
    none = suffix_tree.placed(distinct, hashes, known.slice(0, 0), np.empty(0, np.uint64))
    assert none.tolist() == [-1] * 5


def test_scoring_by_the_tables_keeps_little(spark, monkeypatch):
    """Nothing of the tree broadcast, in several rounds: the scores of a whole broadcast, and no files but the tree's and the scores."""
    monkeypatch.setattr(suffix_tree, "ROUND", 30_000)
    texts = [(k if k % 9 else None, prose(k % 150, 300, 12)) for k in range(200)] + [(1, None), (1, ""), (1, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    scores = {}
    for near in (suffix_tree.NEAR_CONTEXTS, 0):
        with noting() as paths:
            out = suffix_tree.scored(docs, docs, context_least=40, entry_least=4, near_contexts=near)
        got = out.collect()
        scores[near] = sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.base_score, r.score) for r in got)
    tokens = sum(x[1] for x in scores[0])
    assert len(scores[0]) == 203 and tokens > 60_000
    for a, b in zip(*scores.values(), strict=True):
        assert a == pytest.approx(b)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()  # the joins are done and their files deleted
    names = [spark.read.parquet(path).columns for path in paths if Path(path.removeprefix("file:")).exists()]
    assert sum("n_tokens" in x for x in names) >= 3 and not any("rest" in x and "n_tokens" in x for x in names)
