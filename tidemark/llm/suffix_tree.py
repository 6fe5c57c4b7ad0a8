"""Language-model scores by a probabilistic suffix tree over words.

Tokens are lower-case words and one end for each text. The root is the smoothed unigram distribution
P(w) = (c + 0.1) / (N + 0.1 (V + 1)). A candidate context is a sequence of 1 to `DEPTH` words that occurs `CONTEXT_LEAST` times or
more in training; its next-symbol entries are the symbols that follow it `ENTRY_LEAST` times or more. Both are fixed numbers,
so what is learned grows with the corpus, and counts are exact, over all training texts and all words.

Divergence test. A context stays if n(s) * KL(next symbols of s || those of its longest kept suffix), over its
entries and all other symbols as one, exceeds half ln N for each of them, the cost of writing them down.
Smoothing. P_s(w) = 0.9 n(s, w) / n(s) for an entry, plus b_s * P_suffix(w) for every symbol, where b_s is
what the entries leave of 1; so every distribution sums to 1. A token is scored in its longest kept suffix.

Tables. Words and sequences go by 64-bit hashes. Each level takes one pass over the training texts: (context, symbol) pairs
are counted, folded in the tasks, and go out as bytes by blocks of the pairs' hashes, of `DEALT` tokens at most on average; a block
is added up as one group. Pairs are left out early where a bitmap, as large for any corpus, tells
that the context or the symbol is too rare; what passes by chance is dropped by a join later. Contexts and entries are Spark
tables; the test and the smoothing are joins and sums over them. Tables and shuffle files that nothing reads any more are deleted.

Scoring. The most frequent contexts with all their entries, `NEAR_CONTEXTS` and `NEAR_ENTRIES` at most, are broadcast. What follows any
other kept context, told by a bitmap, is asked of the rest of the tree, packed by blocks of the contexts' hashes: (context, symbol) pairs go
out as bytes, each distinct one once for `ASKED` of a task, and values come back in their order. Texts with such pairs to ask are scored
in up to `ROUNDS` rounds, each of whose files go when its scores are there. Root counts
of the 2^18 most frequent words (at most 64 bytes each) are broadcast; all other words of a document get theirs by a join.

Cases. A null text counts as empty and has only its end. Without training texts N and V are 0 and every token has
P = 1. A text of any length is one slice. Rows are scored one by one, repeated ones too. Other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tidemark.llm import shared
from tidemark.llm.batches import Tally, coded, listed, one, slices, words
from tidemark.llm.bitmaps import bitmap, inside
from tidemark.llm.shared import fold, load, noting, removed, settings

FOLDS, DEPTH, CONTEXT_LEAST, ENTRY_LEAST = 10, 3, 64, 8
HEAD, HEAD_BYTES, ADD, KEEP = 1 << 18, 64, 0.1, 0.9
NEAR_CONTEXTS, NEAR_ENTRIES = 1 << 19, 1 << 21
#: Tokens that are counted at once, and partial counts that are held in a task.
ROWS, HELD = 500_000, 1_000_000
#: Bytes of text whose tokens are taken at once.
SLICE = 700_000
#: Tokens for each block of pairs, and the fewest blocks.
DEALT, BLOCKS = 200_000, 256
#: Pairs that a task asks of the tree at once; training tokens for each of its blocks, and the fewest blocks; the most
#: rounds of scoring, and training tokens from which there is one more.
ASKED, PACKED, PACKS, ROUNDS, ROUND = 500_000, 3_000_000, 16, 8, 2_000_000
#: While a table is written: Arrow batches of at most some 4 MB, and shuffle files that go once it is there.
WRITING = {"spark.sql.execution.arrow.maxBytesPerBatch": "4000000", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: The end as a value; no word is empty.
END, SEED = "", 42
ODD, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


LETTERS = np.random.default_rng(SEED).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def saved(df: DataFrame) -> DataFrame:
    """`df` written and read again, under `WRITING`."""
    with settings(df.sparkSession, WRITING):
        return shared.saved(df)


def numbers(distinct: pa.Array) -> np.ndarray:
    """64-bit hashes of words: polynomials over random numbers for their bytes, all words at once by sums from the left."""
    offsets = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
    data = np.frombuffer(distinct.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    powers, inverse = (
        np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(len(data), base, np.uint64)]))
        for base in (int(ODD), pow(int(ODD), -1, 1 << 64))
    )
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(LETTERS[data] * powers[:-1], dtype=np.uint64)])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of a common random generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def longer(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The sequence with a word put before it."""
    return mixed(state * ODD + word)


def entry(state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The pair of a context and what follows it."""
    return mixed(state * TURN ^ symbol)


def states_of(sequence: list[int]) -> list[int]:
    """The sequence's suffixes as states, the shortest first and itself last."""
    ids = np.array(sequence, np.int64).view(np.uint64)
    out = [ids[-1:]]
    for k in range(2, len(ids) + 1):
        out.append(longer(out[-1], ids[-k : len(ids) - k + 1]))
    return [int(x[0].view(np.int64)) for x in out]


def tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Of all tokens, ends too: owner, place in the text; the distinct words, each token's number among them, and their hashes."""
    values, sizes = words(one(table["text"]))
    values = pa.concat_arrays([values, pa.array([END], values.type)])
    distinct, codes = coded(values)
    codes = np.insert(codes[:-1], np.cumsum(sizes), codes[-1])
    many = sizes + 1
    place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(np.arange(len(sizes)), many), place, distinct, codes, numbers(distinct)


def states(ids: np.ndarray, place: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of a context up to `depth`: the tokens that have so many words before them, and their states."""
    state = np.zeros(len(ids), np.uint64)
    for length in range(1, depth + 1):
        at = np.flatnonzero(place >= length)
        state[at] = ids[at - 1] if length == 1 else longer(state[at], ids[at - length])
        yield at, state[at]


def unigrams(training: DataFrame) -> DataFrame:
    """value and n of all training tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for table in slices(batches):
            values, _ = words(one(table["text"]))
            distinct, codes = coded(values)
            distinct = pa.concat_arrays([distinct, pa.array([END], distinct.type)])
            times = np.append(np.bincount(codes, minlength=len(distinct) - 1), table.num_rows)
            yield from tally.add(distinct, times)
        yield from tally.take()

    return training.select("text").mapInArrow(count, "value string, n long").groupBy("value").agg(F.sum("n").alias("n"))


Pairs = tuple[np.ndarray, np.ndarray, np.ndarray]


def folded(parts: list[Pairs]) -> Pairs:
    """Pairs (state, symbol) with their counts, each once."""
    state, symbol, times = (np.concatenate(x) for x in zip(*parts, strict=True))
    if not len(state):
        return state, symbol, times
    key = entry(state, symbol)
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return state[order[new]], symbol[order[new]], np.add.reduceat(times[order], new)


def followers(training: DataFrame, contexts: Broadcast, symbols: Broadcast, length: int, least: int, blocks: int = BLOCKS) -> DataFrame:
    """s, h and n: how often a symbol follows a context of the given length, where it is `least` times or more and the bitmaps have both."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, usual = contexts.value, symbols.value
        raw, held = [], []
        for table in slices(batches, limit=SLICE):
            _, place, _, codes, hashes = tokens(table)
            ids = hashes[codes]
            *_, (at, state) = states(ids, place, length)
            good = inside(usual, hashes)[codes[at]]
            good[good] = inside(some, state[good])
            raw.append((state[good], ids[at[good]], np.ones(int(good.sum()), np.int64)))
            if sum(len(x[0]) for x in raw) > ROWS:
                held.append(folded(raw))
                raw = []
            if sum(len(x[0]) for x in held) > HELD:
                held = [folded(held)]
                if len(held[0][0]) > HELD // 2:
                    yield from given(held.pop())
        if raw or held:
            yield from given(folded(raw + held))

    def given(pairs: Pairs) -> Iterator[pa.RecordBatch]:
        block = (entry(*pairs[:2]) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)  # in rising order, as the hashes are
        if not len(block):
            return
        starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        offsets = pa.py_buffer((8 * np.append(starts, len(block))).astype(np.int32).tobytes())
        parts = [pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(x.tobytes())]) for x in pairs]
        batch = pa.record_batch([pa.array(block[starts].astype(np.int64)), *parts], ["block", "s", "h", "n"])
        step = max(1, 100_000 * len(starts) // len(block))
        for begin in range(0, len(starts), step):
            yield batch.slice(begin, step)

    def add(table: pa.Table) -> pa.Table:
        state, symbol, times = (
            np.frombuffer(b"".join(table[name].to_pylist()), kind) for name, kind in (("s", np.uint64), ("h", np.uint64), ("n", np.int64))
        )
        state, symbol, times = folded([(state, symbol, times)])
        many = times >= least
        return pa.table({"s": pa.array(state[many].view(np.int64)), "h": pa.array(symbol[many].view(np.int64)), "n": pa.array(times[many])})

    pairs = training.select("text").mapInArrow(count, "block long, s binary, h binary, n binary")
    return pairs.groupBy("block").applyInArrow(add, "s long, h long, n long")


def hashed(counts: DataFrame) -> DataFrame:
    """h, the hash of the word, value and n."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("value").cast(pa.large_string())
            yield pa.record_batch({"h": pa.array(numbers(values).view(np.int64)), "value": batch.column("value"), "n": batch.column("n")})

    return counts.mapInArrow(make, "h long, value string, n long")


@dataclass
class Level:
    """The kept contexts of one length: s, total and rest (log10 of b_s); and their entries: s, h and gain (log10 P_s(w) - log10 P(w))."""

    contexts: DataFrame
    entries: DataFrame


def resolved(rows: DataFrame, levels: list[Level], states: Column, out: str) -> DataFrame:
    """`rows`, with a symbol `h`, and as `out` log10 of its probability in the longest kept suffix over that in the root.

    states: the state of the context of each length; levels: from the shortest on.
    """
    names = rows.columns
    now = rows.withColumns({"_states": states, "_sum": F.lit(0.0), "_open": F.lit(True)})
    for k in reversed(range(len(levels))):
        now = now.withColumn("_s", F.get("_states", F.lit(k)))
        rest = levels[k].contexts.select(F.col("s").alias("_s"), "rest")
        gains = levels[k].entries.select(F.col("s").alias("_s"), "h", "gain")
        now = now.join(rest, "_s", "left").join(gains, ["_s", "h"], "left")
        more = F.coalesce("gain", "rest", F.lit(0.0))
        now = now.select(
            *names, "_states", F.when(F.col("_open"), F.col("_sum") + more).otherwise(F.col("_sum")).alias("_sum"),
            (F.col("_open") & F.col("gain").isNull()).alias("_open"),
        )
    return now.select(*names, F.col("_sum").alias(out))


def tested(entries: DataFrame, contexts: DataFrame, levels: list[Level], roots: DataFrame, n: int) -> Level:
    """The contexts that pass the divergence test, with their entries.

    entries: s, h, n; contexts: s, states, total; roots: h and p, the root's probability.
    """
    rows = entries.join(contexts.select("s", "states", "total"), "s").join(roots, "h")
    rows = resolved(rows, levels, F.col("states"), "below").withColumns(
        {"share": F.col("n") / F.col("total"), "base": F.col("p") * F.pow(F.lit(10.0), "below")}
    )
    with noting() as used:
        rows = saved(rows.select("s", "h", "total", "share", "base", "p", (F.col("n") * F.log(F.col("share") / F.col("base"))).alias("gain")))
    sums = rows.groupBy("s").agg(
        F.first("total").alias("total"), F.sum("share").alias("told"), F.sum("base").alias("expected"), F.sum("gain").alias("gain"), F.count("*").alias("many")
    )
    other, expected = F.greatest(1 - F.col("told"), F.lit(0.0)), F.least("expected", F.lit(1 - 1e-9))
    gain = F.col("gain") + F.when(other > 0, F.col("total") * other * F.log(other / (1 - expected))).otherwise(0.0)
    kept = saved(
        sums.where(gain > 0.5 * float(np.log(max(n, 2))) * (F.col("many") + 1))
        .select("s", "total", "many", (1 - KEEP * F.col("told")).alias("left"), F.log10(1 - KEEP * F.col("told")).alias("rest"))
    )
    stay = rows.drop("total", "gain").join(kept.select("s", "left"), "s")
    level = Level(kept, saved(stay.select("s", "h", (F.log10(KEEP * F.col("share") + F.col("left") * F.col("base")) - F.log10("p")).alias("gain"))))
    removed(rows.sparkSession, used)
    return level


def named(rows: DataFrame) -> DataFrame:
    """s, words, states (of its proper suffixes) and total of contexts given by their words."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [states_of(sequence) for sequence in batch.column("words").to_pylist()]
            yield pa.record_batch({
                "s": pa.array([x[-1] for x in found], pa.int64()), "words": batch.column("words"),
                "states": pa.array([x[:-1] for x in found], pa.list_(pa.int64())), "total": batch.column("total"),
            })

    return rows.mapInArrow(name, "s long, words array<long>, states array<long>, total long")


def grown(training: DataFrame, counts: DataFrame, v: int, n: int, depth: int, context_least: int, entry_least: int) -> list[Level]:
    """The tree, level by level; each level takes one pass over the training texts."""
    levels: list[Level] = []
    spark, spread = training.sparkSession, training.sparkSession.sparkContext.broadcast
    with noting() as words_:
        usual = saved(hashed(counts.where(F.col("n") >= min(context_least, entry_least))))
    symbols = usual.where(F.col("n") >= entry_least)
    roots = symbols.select("h", ((F.col("n") + ADD) / (n + ADD * (v + 1))).alias("p"))
    if symbols.isEmpty():
        return levels
    end = int(numbers(pa.array([END], pa.large_string())).view(np.int64)[0])
    bits = spread(bitmap(symbols, "h"))
    frequent = usual.where((F.col("n") >= context_least) & (F.col("value") != END))
    with noting() as of_contexts:
        contexts = saved(named(frequent.select(F.array("h").alias("words"), F.col("n").alias("total"))))
    for length in range(1, depth + 1):
        if contexts.isEmpty():
            break
        found = followers(training, spread(bitmap(contexts, "s")), bits, length, entry_least, max(BLOCKS, n // DEALT))
        with noting() as of_found:
            found = saved(found.join(contexts.select("s"), "s", "left_semi"))
        levels.append(tested(found, contexts, levels, roots, n))
        # Longer contexts: the entries that are frequent enough and not the end.
        following = found.where((F.col("n") >= context_least) & (F.col("h") != end))
        with noting() as of_longer:
            contexts = saved(named(
                following.join(contexts.select("s", "words"), "s").select(F.concat("words", F.array("h")).alias("words"), F.col("n").alias("total"))
            ))
        removed(spark, of_found + of_contexts)
        of_contexts = of_longer
    removed(spark, words_ + of_contexts)
    return levels


@dataclass
class Near:
    """What is broadcast: contexts with what they leave, entries with their gains, and a bitmap of the other contexts.

    least: the contexts here are those with this `step_of` their total or a higher one.
    """

    contexts: np.ndarray
    rest: np.ndarray
    entries: np.ndarray
    gains: np.ndarray
    far: np.ndarray | None
    least: int


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each in the rising keys, -1 where absent."""
    if not len(keys) or not len(wanted):
        return np.full(len(wanted), -1, np.int64)
    order = np.argsort(wanted)  # in rising order they are found several times as fast
    rising = wanted[order]
    at = np.minimum(np.searchsorted(keys, rising), len(keys) - 1)
    out = np.empty(len(wanted), np.int64)
    out[order] = np.where(keys[at] == rising, at, -1)
    return out


def placed(distinct: pa.Array, hashes: np.ndarray, known: pa.Array, keys: np.ndarray) -> np.ndarray:
    """The place in `known` of each word, -1 where it isn't there; keys: the hashes of `known`, rising."""
    at = find(keys, hashes)
    hit = np.flatnonzero(at >= 0)
    same = pc.equal(distinct.take(pa.array(hit)), known.take(pa.array(at[hit])))
    at[hit[~same.to_numpy(zero_copy_only=False)]] = -1  # words that only share a hash
    return at


def step_of(total: str) -> Column:
    """Totals to half powers of two: at most some 130 steps."""
    return F.floor(2 * F.log2(total))


def near_part(spark: SparkSession, levels: list[Level], most_contexts: int, most_entries: int) -> Near:
    """The contexts from a total on, the least that keeps both limits, with all their entries."""
    if not levels:
        return Near(*(np.empty(0, kind) for kind in (np.uint64, float, np.uint64, float)), None, 0)
    contexts = levels[0].contexts
    for level in levels[1:]:
        contexts = contexts.unionByName(level.contexts)
    size = step_of("total")
    steps = contexts.groupBy(size.alias("size")).agg(F.count("*").alias("n"), F.sum("many").alias("entries")).orderBy(F.desc("size")).collect()
    least, n, entries = None, 0, 0
    for step in steps:
        n, entries = n + step.n, entries + step.entries
        if n > most_contexts or entries > most_entries:
            break
        least = step.size
    whole = least is not None and least == steps[-1].size
    least = least if least is not None else 1 << 20
    inner = size >= least
    top = contexts.where(inner).select("s", "rest").toArrow()
    parts = [level.entries.join(level.contexts.where(inner).select("s"), "s", "left_semi").toArrow() for level in levels]
    keys = np.sort(top["s"].to_numpy().view(np.uint64)), np.argsort(top["s"].to_numpy().view(np.uint64))
    s, h, gains = (np.concatenate([part[name].to_numpy() for part in parts]) for name in ("s", "h", "gain"))
    pairs = entry(s.view(np.uint64), h.view(np.uint64))
    order = np.argsort(pairs)
    far = None if whole else bitmap(contexts.where(~inner), "s")
    return Near(keys[0], top["rest"].to_numpy()[keys[1]], pairs[order], gains[order], far, least)


def block_of(state: np.ndarray, blocks: int) -> np.ndarray:
    """The block of a context, in rising order of its state."""
    return ((state >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def packed(levels: list[Level], least: int, blocks: int) -> DataFrame:
    """block, and as bytes s and rest of its contexts and pair and gain of their entries, rising, for all that `near_part` left out."""
    both = None
    for level in levels:
        contexts = level.contexts.where(step_of("total") < least)
        entries = level.entries.join(contexts.select("s"), "s", "left_semi").select("s", "h", F.col("gain").alias("value"))
        rows = contexts.select("s", F.lit(None).cast("long").alias("h"), F.col("rest").alias("value")).unionByName(entries)
        both = rows if both is None else both.unionByName(rows)

    def pack(table: pa.Table) -> pa.Table:
        heads = pc.is_null(table["h"])
        contexts, entries = table.filter(heads), table.filter(pc.invert(heads))
        keys = contexts["s"].to_numpy().view(np.uint64)
        pairs = entry(entries["s"].to_numpy().view(np.uint64), entries["h"].to_numpy().view(np.uint64))
        order, by_pair = np.argsort(keys), np.argsort(pairs)
        arrays = (keys[order], contexts["value"].to_numpy()[order], pairs[by_pair], entries["value"].to_numpy()[by_pair])
        return pa.table({"block": table["block"].slice(0, 1), **{
            name: pa.array([x.tobytes()], pa.binary()) for name, x in zip(("s", "rest", "pair", "gain"), arrays, strict=True)
        }})

    block = F.shiftrightunsigned(F.shiftrightunsigned("s", 32) * blocks, 32)
    return both.withColumn("block", block).groupBy("block").applyInArrow(pack, "block long, s binary, rest binary, pair binary, gain binary")


class Questions:
    """What a task asks of the packed tree, gathered over slices of texts."""

    KIND = "g long, block long, s binary, h binary, texts binary, owner binary, token binary, place binary, behind binary"

    def __init__(self, blocks: int):
        self.blocks, self.groups = blocks, 0
        self.clear()

    def clear(self) -> None:
        self.rows, self.parts, self.n_rows, self.n_tokens, self.n_asked = [], [], 0, 0, 0

    def add(self, rows: np.ndarray, owner: np.ndarray, ids: np.ndarray, asked: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """asked: for each length, the longest first, the tokens, their states and what the broadcast contexts below add."""
        some = np.unique(np.concatenate([at for at, _, _ in asked]))
        if not len(some):
            return
        self.rows.append(rows)
        self.parts.append((owner[some] + self.n_rows, [(np.searchsorted(some, at) + self.n_tokens, state, ids[at], more) for at, state, more in asked]))
        self.n_rows, self.n_tokens = self.n_rows + len(rows), self.n_tokens + len(some)
        self.n_asked += sum(len(at) for at, _, _ in asked)

    def take(self) -> Iterator[dict[str, pa.Array]]:
        """Questions by block, each once, and what it takes to add up their answers, as a row without a block."""
        if not self.parts:
            return
        g = TaskContext.get().partitionId() << 32 | self.groups
        sizes, columns = [], []
        for level in zip(*(asked for _, asked in self.parts), strict=True):
            columns.append([np.concatenate(x) for x in zip(*level, strict=True)])
            sizes.append(len(columns[-1][0]))
        token, state, symbol, behind = (np.concatenate(x) for x in zip(*columns, strict=True))
        order = np.argsort(state & np.uint64(0xFFFFFFFF00000000) | entry(state, symbol) >> np.uint64(32))
        state, symbol = state[order], symbol[order]
        new = np.concatenate([[True], (state[1:] != state[:-1]) | (symbol[1:] != symbol[:-1])])
        place = np.empty(len(order), np.int32)
        place[order] = np.cumsum(new) - 1
        state, symbol = state[new], symbol[new]
        block = block_of(state, self.blocks)
        starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        ends = np.append(starts[1:], len(block))
        yield dict(
            g=pa.array(np.full(len(starts), g)), block=pa.array(block[starts]),
            **{name: pa.array([x[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()) for name, x in (("s", state), ("h", symbol))},
        )
        once = {
            "s": np.array(sizes, np.int64), "texts": np.concatenate(self.rows), "owner": np.concatenate([x for x, _ in self.parts]).astype(np.int32),
            "token": token.astype(np.int32), "place": place, "behind": behind,
        }
        yield dict(g=pa.array([g]), **{name: pa.array([x.tobytes()], pa.binary()) for name, x in once.items()})
        self.groups += 1
        self.clear()


def answered(parts: DataFrame, tree: DataFrame) -> DataFrame:
    """row and more: what the packed tree adds to the text's score."""

    def look(asked: pa.Table, tree: pa.Table) -> pa.Table:
        keys, rest, pairs, gains = (
            np.frombuffer(b"".join(tree[name].to_pylist()), kind) for name, kind in (("s", np.uint64), ("rest", float), ("pair", np.uint64), ("gain", float))
        )
        values, hits = [], []
        for states_, symbols in zip(asked["s"].to_pylist(), asked["h"].to_pylist(), strict=True):
            state = np.frombuffer(states_, np.uint64)
            at, hit = find(keys, state), find(pairs, entry(state, np.frombuffer(symbols, np.uint64)))
            value = np.zeros(len(state))
            value[at >= 0] = rest[at[at >= 0]]
            value[hit >= 0] = gains[hit[hit >= 0]]
            values.append(value.tobytes())
            hits.append((hit >= 0).astype(np.uint8).tobytes())
        return pa.table({"g": asked["g"], "block": asked["block"], "value": pa.array(values, pa.binary()), "hit": pa.array(hits, pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        texts, sizes, owner, token, place, behind = (
            np.frombuffer(b"".join(table[name].drop_null().to_pylist()), kind)
            for name, kind in (("texts", np.int64), ("s", np.int64), ("owner", np.int32), ("token", np.int32), ("place", np.int32), ("behind", float))
        )
        answers = table.filter(pc.is_valid(table["block"])).sort_by("block")
        value, hit = (np.frombuffer(b"".join(answers[name].to_pylist()), kind) for name, kind in (("value", float), ("hit", bool)))
        sums, open_, start = np.zeros(len(owner)), np.ones(len(owner), bool), 0
        for size in sizes.tolist():  # the longest contexts first
            here, at, more = token[start : start + size], place[start : start + size], behind[start : start + size]
            left = open_[here]
            here, at, more = here[left], at[left], more[left]
            sums[here] += value[at] + np.where(hit[at], 0.0, more)
            open_[here[hit[at]]] = False
            start += size
        rows, at = np.unique(owner, return_inverse=True)
        return pa.table({"row": pa.array(texts[rows]), "more": pa.array(np.bincount(at, weights=sums))})

    some = parts.where(F.col("block").isNotNull()).select("block", "g", "s", "h")
    answers = some.groupBy("block").cogroup(tree.groupBy("block")).applyInArrow(look, "g long, block long, value binary, hit binary")
    keep = ["g", "block", "s", "texts", "owner", "token", "place", "behind"]
    once = parts.where(F.col("g").isNotNull() & F.col("block").isNull()).select(*keep, *(F.lit(None).cast("binary").alias(x) for x in ("value", "hit")))
    back = answers.select("g", "block", *(F.lit(None).cast("binary").alias(x) for x in keep[2:]), "value", "hit")
    return once.unionByName(back).groupBy("g").applyInArrow(add, "row long, more double")


def scored(
    docs: DataFrame, training: DataFrame, id_column: str = "doc_id", text_column: str = "text", depth: int = DEPTH,
    context_least: int = CONTEXT_LEAST, entry_least: int = ENTRY_LEAST, head_size: int = HEAD,
    near_contexts: int = NEAR_CONTEXTS, near_entries: int = NEAR_ENTRIES,
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) of every row of docs."""
    spark = docs.sparkSession
    training = training.select(F.col(text_column).alias("text"))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    counts = saved(unigrams(training))
    v, n = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    top = counts.where(F.octet_length("value") <= HEAD_BYTES).orderBy(F.desc("n"), "value").limit(head_size).toArrow()
    whole = np.log10(n + ADD * (v + 1))
    frequent, times = one(top["value"].cast(pa.large_string())), top["n"].to_numpy().astype(np.int64)
    keys = numbers(frequent)
    order = np.argsort(keys)
    head = spark.sparkContext.broadcast((frequent.take(pa.array(order)), keys[order], times[order]))
    levels = grown(training, counts, v, n, depth, context_least, entry_least)
    near_tree = near_part(spark, levels, near_contexts, near_entries)
    tree = spark.sparkContext.broadcast(near_tree)
    identity = rows.schema["doc_id"].dataType.simpleString()
    deepest, blocks = len(levels), max(PACKS, n // PACKED)
    schema = f"row long, doc_id {identity}, n_tokens long, n_near long, near double, gain double, rest array<struct<value:string,n:long>>, {Questions.KIND}"
    shape = to_arrow_schema(_parse_datatype_string(schema))

    def whole_batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.record_batch([columns[x.name].cast(x.type) if x.name in columns else pa.nulls(size, x.type) for x in shape], schema=shape)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, keys, times), near = head.value, tree.value
        base = np.append(np.log10(times + ADD) - whole, 0.0)
        questions = Questions(blocks)
        for table in slices(batches, limit=SLICE):
            owner, place, distinct, codes, hashes = tokens(table)
            at, size, ids = placed(distinct, hashes, known, keys)[codes], table.num_rows, hashes[codes]
            gain, open_, last = np.zeros(len(ids)), np.ones(len(ids), bool), np.full(len(ids), -1)
            asked, behind = [], np.zeros((deepest, len(ids) if near.far is not None else 0))
            for here, state in reversed(list(states(ids, place, deepest))):
                left = open_[here]
                here, state = here[left], state[left]
                context = find(near.contexts, state)
                if near.far is not None:
                    other = np.flatnonzero(context < 0)
                    other = other[inside(near.far, state[other])]
                    last[here[other]] = len(asked)
                    asked.append((here[other], state[other]))
                here, state, context = here[context >= 0], state[context >= 0], context[context >= 0]
                hit = find(near.entries, entry(state, ids[here]))
                more = np.where(hit >= 0, near.gains[hit] if len(near.gains) else 0.0, near.rest[context])
                free = last[here] < 0  # else it counts only if what was asked before is no entry
                gain[here[free]] += more[free]
                behind[last[here[~free]], here[~free]] += more[~free]
                open_[here[hit >= 0]] = False
            far = at < 0
            words_, repeats = np.unique(owner[far] * len(distinct) + codes[far], return_counts=True)
            rest = listed(
                words_ // len(distinct), size,
                {"value": distinct.take(pa.array(words_ % len(distinct))).cast(pa.string()), "n": pa.array(repeats.astype(np.int64))},
            )
            total = lambda weights: np.bincount(owner, weights=weights, minlength=size)
            yield whole_batch({
                "row": one(table["row"]), "doc_id": one(table["doc_id"]),
                "n_tokens": pa.array(total(None).astype(np.int64)), "n_near": pa.array(total((~far).astype(float)).astype(np.int64)),
                "near": pa.array(total(base[at])), "gain": pa.array(total(gain)), "rest": rest,
            })
            if asked:
                questions.add(one(table["row"]).to_numpy(), owner, ids, [(*some, behind[k, some[0]]) for k, some in enumerate(asked)])
            if questions.n_asked > ASKED:
                yield from map(whole_batch, questions.take())
        yield from map(whole_batch, questions.take())

    def scores(some: DataFrame, tree: DataFrame | None) -> DataFrame:
        parts = saved(some.withColumn("row", F.monotonically_increasing_id()).mapInArrow(score, schema))
        texts = parts.where(F.col("row").isNotNull())
        # A hit's gain is relative to the root, a miss adds what is left on the way to the root.
        count = F.coalesce("n", F.lit(0))
        far = (
            texts.select("row", F.explode("rest").alias("x")).select("row", "x.value", F.col("x.n").alias("times"))
            .join(counts, "value", "left").groupBy("row").agg(
                F.sum(F.col("times") * (F.log10(count + ADD) - float(whole))).alias("far"),
                F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("n_far"),
            )
        )
        out = texts.select("row", "doc_id", "n_tokens", "n_near", "near", "gain").join(far, "row", "left").withColumn("more", F.lit(0.0))
        if tree is not None:
            more = answered(parts, tree).groupBy("row").agg(F.sum("more").alias("more"))
            out = out.drop("more").join(more, "row", "left")
        base = F.col("near") + F.coalesce("far", F.lit(0.0))
        return out.select(
            "doc_id", "n_tokens", (F.col("n_near") + F.coalesce("n_far", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
            base.alias("base_score"), (base + F.col("gain") + F.coalesce("more", F.lit(0.0))).alias("score"),
        )

    if near_tree.far is None:
        return scores(rows, None)
    far_tree, out = saved(packed(levels, near_tree.least, blocks)), None
    rounds = min(ROUNDS, 1 + n // ROUND)
    for turn in range(rounds):
        some = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == turn)
        with noting() as paths:
            done = saved(scores(some, far_tree))
        removed(spark, paths[:-1])  # the last one holds the scores
        out = done if out is None else out.unionByName(done)
    return out


def op4_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False))
    scores = scored(docs, docs.where(~held))
    return scores.withColumn("held_out", held).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


QUERIES = {"op4_suffix_tree": op4_suffix_tree}
ORACLE_SQL = {}
