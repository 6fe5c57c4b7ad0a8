"""Benchmark decontamination by latent semantic retrieval.

Words are lower-case (ASCII) and stripped of punctuation at both ends. Features are `FEATURES` buckets of their hashes.
The space is fitted on all distinct passages of 64 words (by a 64-bit hash of their words); they go as the features of their
words, 2 bytes each. They give document frequencies; A = X'X, of the TF-IDF passages X, meets a random
orthonormal matrix in one pass (a randomised SVD in its one-pass form for A): tasks return A * Omega in blocks of rows
that are added in two rounds, and its factors of FEATURES x RANK, as large for any corpus, are found in memory.

Retrieval. Every text is cut into windows of about n words, a quarter of that apart, for items of every length n of `LEAST` or more.
Windows and items lie in the space of right singular vectors, scaled by the singular values; a window with a cosine of `COSINE` or more
is retrieved for the item (recall: README).

Search. A leak is a stretch of at most n + 2 max(4, n / 4) words of a text, n the item's, that passes the checks. Two exact
bounds, which all that pass them meet, tell the places where a retrieved window is worth the checks, and complete them by
the places that no window is retrieved for, so that none is lost. A stretch with 0.8 of an item's words holds, of the item's 0.2 n + k rarest
words, at least k (k is 0.3 n): postings of these words are counted in buckets of a stretch's length, two at a time.
A stretch with less must hold the answer: word sequences are looked up by a rolling hash and compared. The benchmark is the
query set; it goes out in blocks of at most `BLOCK` items. `cosine` is that of item and stretch, `retrieved` whether a window there was.

Checks. The longest common subsequence of the item's words and the stretch's must hold 0.8 of the
item's words, or 0.6 of them if the answer, the item's last sentence, is there word for word.

Short items. An item of fewer than 8 words is a leak where all its words stand in a text in order, without a change; so one of
a single common word meets every text that has it. In scripts without spaces (Chinese, Japanese, Thai and the like) each
character counts as a word, in texts and items alike.

Cases. Null and empty texts and items match nothing, nor do items of punctuation only. Repeated rows and items are
reported row by row; of stretches of a text that pass alike, the first. A text of any length is searched whole, in spans of
`SPAN` words that overlap by the longest stretch. Other columns are not read; `kept_rows` hands them on. An empty table on either side gives no matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.batches import coded, one, slices, words
from tidemark.llm.shared import load, located, noting, removed, saved

FEATURES, RANK, EXTRA, PASSAGE, ROWS = 1 << 14, 64, 8, 64, 256
BLOCK, WHOLE, PART, LEAST = 1000, 0.8, 0.6, 8
#: The least cosine of a window that is retrieved, and words whose windows are compared at once.
COSINE, COMPARED = 0.6, 16_000
#: Words searched at once, (item, word) pairs counted at once, and what is asked of an item's rare words, as a share of it.
SPAN, PAIRS, RARE = 100_000, 2_000_000, 0.3
ODD = 0x9E3779B97F4A7C15
#: Rows that are added up at once where many are, and such groups at a time.
GROUP, GROUPS = 16, 250
#: What `sampled` takes, about.
SAMPLE = 60_000
MARKS = ".,;:!?\"'()[]{}"
#: Characters of scripts without spaces, each a word of its own, and their punctuation, which parts words.
UNSPACED = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"
PARTING = r"[\x{3000}-\x{303F}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF65}]"
TABLE = 1 << 20


def spaced(texts: pa.Array) -> pa.Array:
    """The texts with spaces around every character of a script that has none."""
    other = pc.match_substring_regex(texts, f"{UNSPACED}|{PARTING}")
    if not pc.any(other).as_py():
        return texts
    some = pc.replace_substring_regex(texts.filter(other), PARTING, " ")
    return pc.replace_with_mask(texts, other, pc.replace_substring_regex(some, f"({UNSPACED})", r" \1 "))


def xxh32(words_: pa.Array) -> np.ndarray:
    """XXH32 of words: of all with the same length below 16 bytes at once, if they are many."""
    import xxhash

    if len(words_) < 2000:
        return np.array([xxhash.xxh32_intdigest(word) for word in words_.to_pylist()], np.uint32)
    one_, two, three, four, five = (np.uint32(x) for x in (2654435761, 2246822519, 3266489917, 668265263, 374761393))
    words_ = words_.cast(pa.large_string())
    offsets = np.frombuffer(words_.buffers()[1], np.int64)[words_.offset : words_.offset + len(words_) + 1]
    data, sizes = np.frombuffer(words_.buffers()[2] or b"", np.uint8), np.diff(offsets)
    out = np.empty(len(words_), np.uint32)
    for size in np.unique(sizes[sizes < 16]).tolist():
        at = np.flatnonzero(sizes == size)
        chars = data[offsets[at][:, None] + np.arange(size)]
        x = np.full(len(at), int(five) + size, np.uint32)
        for k in range(0, size - 3, 4):
            x += np.ascontiguousarray(chars[:, k : k + 4]).view("<u4").ravel() * three
            x = (x << np.uint32(17) | x >> np.uint32(15)) * four
        for k in range(size - size % 4, size):
            x += chars[:, k] * five
            x = (x << np.uint32(11) | x >> np.uint32(21)) * one_
        x = (x ^ x >> np.uint32(15)) * two
        x = (x ^ x >> np.uint32(13)) * three
        out[at] = x ^ x >> np.uint32(16)
    for k in np.flatnonzero(sizes >= 16).tolist():
        out[k] = xxhash.xxh32_intdigest(data[offsets[k] : offsets[k + 1]].tobytes())
    return out


def hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of all words in order, and the number of words of each text."""
    values, sizes = words(spaced(texts))
    distinct, codes = coded(values)
    numbers = xxh32(pc.utf8_trim(distinct, characters=MARKS))
    return numbers[codes] if len(codes) else np.empty(0, np.uint32), sizes


def hashed_rows(rows: DataFrame) -> DataFrame:
    """doc_id, ids (word hashes, 4 bytes each) and words (their number) of rows with doc_id and text."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches):
            ids, sizes = hashed(one(table["text"]))
            ends = np.cumsum(sizes)
            parts = [ids[end - size : end].tobytes() for end, size in zip(ends, sizes, strict=True)]
            yield pa.record_batch({"doc_id": one(table["doc_id"]), "ids": pa.array(parts, pa.binary()), "words": pa.array(sizes)})

    return rows.mapInArrow(make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, words long")


def sampled(rows: DataFrame, most: int = SAMPLE) -> DataFrame:
    """ids of about `most` distinct passages, chosen by a hash of their words; of all, if there are fewer.

    For looking at a corpus: the space is fitted on all of them, see `distinct_passages`.
    """
    import xxhash

    whole = rows.agg(F.coalesce(F.sum(F.ceil(F.col("words") / PASSAGE)), F.lit(0))).first()[0]
    one_in = max(1, -(-int(whole) // most))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches, "ids", 4_000_000):
            parts = [ids[at : at + 4 * PASSAGE] for ids in table["ids"].to_pylist() for at in range(0, len(ids), 4 * PASSAGE)]
            some = [part for part in parts if xxhash.xxh64_intdigest(part) % one_in == 0]
            if some:
                yield pa.record_batch({"ids": pa.array(some, pa.binary())})

    return saved(rows.select("ids").mapInArrow(pick, "ids binary").distinct())


def read_ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    parts = table["ids"].to_pylist()
    return np.frombuffer(b"".join(parts), np.uint32), np.array([len(p) // 4 for p in parts], np.int64)


def distinct_passages(rows: DataFrame) -> DataFrame:
    """passage (a hash of its words) and features (of its words in order, 2 bytes each) of every distinct passage."""
    import xxhash

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches, "ids", 4_000_000):
            ids, sizes = read_ids(table)
            many = -(-sizes // PASSAGE)
            starts = np.repeat(np.cumsum(sizes) - sizes, many) + PASSAGE * within(many)
            if not len(starts):
                continue
            ends, whole = np.append(starts[1:], len(ids)), memoryview(ids.tobytes())
            hashes = [xxhash.xxh64_intdigest(whole[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            offsets = pa.py_buffer(np.append(0, 2 * ends).astype(np.int32).tobytes())
            features = pa.py_buffer((ids & (FEATURES - 1)).astype(np.uint16).tobytes())
            yield pa.record_batch({
                "passage": pa.array(np.array(hashes, np.uint64).view(np.int64)),
                "features": pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, features]),
            })

    return saved(rows.select("ids").mapInArrow(cut, "passage long, features binary").distinct())


def read_features(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of all words, where each passage begins, and the number of its passage for each word."""
    parts = table["features"].to_pylist()
    sizes = np.array([len(p) // 2 for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint16), np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Passages that hold each feature, and all passages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(FEATURES + 1, np.int64)
        for table in slices(batches, "features", 400_000):
            feature, starts, at = read_features(table)
            order = np.argsort(feature, kind="stable")
            feature, at = feature[order], at[order]
            new = np.concatenate([[True], (feature[1:] != feature[:-1]) | (at[1:] != at[:-1])])
            found[:-1] += np.bincount(feature[new], minlength=FEATURES)
            found[-1] += len(starts)
        yield pa.record_batch({"feature": pa.array(np.arange(FEATURES + 1)), "n": pa.array(found)})

    out = np.zeros(FEATURES + 1, np.int64)
    for row in rows.select("features").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():
        out[row.feature] = row.n
    return out[:-1], int(out[-1])


def sums(rows: np.ndarray, pick: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of rows[pick] over the runs of `pick` that begin at `starts`, `GROUP` rows at a time first."""
    rows = np.concatenate([rows, np.zeros((1, rows.shape[1]), rows.dtype)])
    sizes = np.diff(starts, append=len(pick))
    groups = -(-sizes // GROUP)
    first = np.cumsum(groups) - groups
    filled = np.full(GROUP * int(groups.sum()), len(rows) - 1)  # zeros fill up a run
    filled[np.arange(len(pick)) + np.repeat(GROUP * first - starts, sizes)] = pick
    step = GROUP * GROUPS
    parts = [rows.take(filled[at : at + step], axis=0).reshape(-1, GROUP, rows.shape[1]).sum(axis=1) for at in range(0, len(filled), step)]
    return np.add.reduceat(np.concatenate(parts), first, axis=0)


def sketch(rows: DataFrame, weights: np.ndarray, omega: np.ndarray) -> np.ndarray:
    """X'X * omega over the passages of `rows`."""
    model = rows.sparkSession.sparkContext.broadcast((weights.astype(np.float32), omega.astype(np.float32)))
    width = omega.shape[1]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale, right = model.value
        right, total = right * scale[:, None], np.zeros((FEATURES, width), np.float32)
        for table in slices(batches, "features", 800_000):
            feature, starts, at = read_features(table)
            rows_of = sums(right, feature, starts)  # X * omega
            order = np.argsort(feature, kind="stable")
            sorted_ = feature[order]
            first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
            total[sorted_[first]] += sums(rows_of, at[order], first)
        total *= scale[:, None]
        salt = TaskContext.get().partitionId()  # the same if the task runs again
        for block in range(FEATURES // ROWS):
            part = total[block * ROWS : (block + 1) * ROWS]
            if part.any():
                yield pa.record_batch({"block": pa.array([block]), "salt": pa.array([salt]), "part": pa.array([part.tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column("block").to_pylist(), batch.column("part").to_pylist(), strict=True):
                sums[block] = sums.get(block, 0.0) + np.frombuffer(part, np.float32).reshape(ROWS, width)
        for block, part in sums.items():
            yield pa.record_batch({"block": pa.array([block]), "salt": pa.array([0]), "part": pa.array([part.tobytes()], pa.binary())})

    kind = "block long, salt long, part binary"
    parts = rows.select("features").mapInArrow(multiply, kind)
    once = parts.repartition("block", F.col("salt") % 16).mapInArrow(add, kind)
    out = np.zeros((FEATURES, width))
    for row in once.repartition("block").mapInArrow(add, kind).collect():  # FEATURES x width numbers
        out[row.block * ROWS : (row.block + 1) * ROWS] = np.frombuffer(row.part, np.float32).reshape(ROWS, width)
    return out


def embedded(rows: DataFrame, df: np.ndarray, whole: int, rank: int = RANK) -> np.ndarray:
    """FEATURES x rank: what a word adds to its stretch's place in the scaled space of singular vectors."""
    weights = np.log((1 + whole) / (1 + df))
    omega = np.linalg.qr(np.random.default_rng(7).standard_normal((FEATURES, rank + EXTRA)))[0]
    y = sketch(rows, weights, omega)
    shift = 1e-6 * max(np.linalg.norm(y), 1e-9)
    y = y + shift * omega
    core = omega.T @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > shift
    half = vectors[:, good] / np.sqrt(values[good])
    u, s, _ = np.linalg.svd(y @ half, full_matrices=False)
    k = min(rank, int((s > s.max(initial=0) * 1e-4).sum()))
    return (weights[:, None] * u[:, :k] / s[:k]).astype(np.float32)


@dataclass
class Item:
    key: object
    ids: np.ndarray
    answer: np.ndarray


def item_of(key, text: str | None) -> Item:
    ids = hashed(pa.array([text or ""], pa.large_string()))[0]
    sentences = [x for x in re.split(r"(?<=[.!?])\s+|(?<=[。！？])", (text or "").strip()) if x.strip()]
    last = hashed(pa.array(sentences[-1:], pa.large_string()))[0]
    return Item(key, ids, last if len(last) >= 3 else ids[-5:])


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b.tolist():
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def holds(text: np.ndarray, part: np.ndarray) -> bool:
    """Whether `part` stands in `text` as it is."""
    if not len(part) or len(part) > len(text):
        return False
    return bool((np.lib.stride_tricks.sliding_window_view(text, len(part)) == part).all(axis=1).any())


def least_of(share: float, n: int) -> int:
    """The fewest of n words that make up the share."""
    return int(np.ceil(share * n - 1e-9))


def reach(n: int) -> int:
    """The words of a stretch in which an item of n words is looked for."""
    return n + 2 * max(4, n // 4)


class Sequences:
    """Looks up word sequences in texts: by hash, then word by word."""

    def __init__(self, sequences: list[tuple[int, np.ndarray]]):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in sorted({len(words_) for _, words_ in sequences}):
            some = [(number, words_) for number, words_ in sequences if len(words_) == length]
            rows_ = np.array([words_ for _, words_ in some], np.uint32)
            keys = np.array([self.hashes(row, length, *self.powers(length))[0] for row in rows_], np.uint64)
            order = np.argsort(keys, kind="stable")
            bits = np.zeros(1 << 16, bool)
            bits[keys >> np.uint64(48)] = True
            self.by_length[length] = keys[order], rows_[order], np.array([number for number, _ in some])[order], bits

    @staticmethod
    def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of ODD and of its inverse, modulo 2^64."""
        both = []
        for base in (ODD, pow(ODD, -1, 1 << 64)):
            steps = np.full(n, base, np.uint64)
            steps[:1] = 1
            both.append(np.multiply.accumulate(steps))
        return both[0], both[1]

    @staticmethod
    def hashes(ids: np.ndarray, length: int, up: np.ndarray, down: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
        """The hash of the sequence that begins at each word."""
        if sums is None:
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * up[: len(ids)], dtype=np.uint64)])
        return (sums[length:] - sums[: len(sums) - length]) * down[: len(sums) - length]

    def found(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Numbers of the sequences, where they begin, and their length."""
        if not self.by_length or not len(ids):
            return
        up, down = self.powers(len(ids))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * up, dtype=np.uint64)])
        for length, (keys, rows_, numbers, bits) in self.by_length.items():
            if length > len(ids):
                continue
            here = self.hashes(ids, length, up, down, sums)
            at = np.flatnonzero(bits[here >> np.uint64(48)])
            low, high = np.searchsorted(keys, here[at]), np.searchsorted(keys, here[at], side="right")
            times = high - low
            at, place = np.repeat(at, times), np.repeat(low, times) + within(times)
            same = np.ones(len(at), bool)
            for k in range(length):
                same &= ids[at + k] == rows_[place, k]
            if same.any():
                yield numbers[place[same]], at[same], length


def within(times: np.ndarray) -> np.ndarray:
    """0, 1 and so on in each run of the given lengths."""
    return np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)


class Searcher:
    """The bounds for one block of items, and the search of texts for them."""

    def __init__(self, items: list[Item], space: np.ndarray, df: np.ndarray):
        self.items, self.space = items, space
        self.searched = [k for k, item in enumerate(items) if len(item.ids) >= LEAST]
        self.distinct = {k: np.unique(items[k].ids) for k in self.searched}
        self.width = np.array([reach(len(items[k].ids)) for k in self.searched], np.int64)
        self.asked, posted, owners = np.zeros(len(self.searched), np.int64), [], []
        for place, k in enumerate(self.searched):
            ids = items[k].ids
            self.asked[place] = max(1, int(RARE * len(ids)))
            rare = np.argsort(df[ids & (FEATURES - 1)], kind="stable")[: len(ids) - least_of(WHOLE, len(ids)) + self.asked[place]]
            posted.append(np.unique(ids[rare]))
            owners.append(np.full(len(posted[-1]), place))
        words_, owners = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (posted, owners))
        order = np.argsort(words_, kind="stable")
        self.owners = owners[order].astype(np.int64)
        self.vocabulary, self.first, self.times = np.unique(words_[order], return_index=True, return_counts=True)
        self.table = np.zeros(TABLE, bool)
        self.table[self.vocabulary.astype(np.int64) & (TABLE - 1)] = True
        self.answers = Sequences([(k, items[k].answer) for k in self.searched])
        self.step = {k: 2 * max(1, round(len(items[k].ids) / 8)) for k in self.searched}
        self.of_step = {step: [k for k in self.searched if self.step[k] == step] for step in sorted({*self.step.values()})}
        self.queries = {step: np.array([self.project(items[k].ids) for k in some]).T for step, some in self.of_step.items()}
        self.column = {k: at for some in self.of_step.values() for at, k in enumerate(some)}
        self.wide = np.concatenate([space, np.zeros((1, space.shape[1]), space.dtype)])
        empty = hashed(pa.array(["."], pa.large_string()))[0]
        self.short = Sequences([(k, item.ids) for k, item in enumerate(items) if len(item.ids) < LEAST and (item.ids != empty).any()])

    def project(self, ids: np.ndarray) -> np.ndarray:
        z = self.space[ids & (FEATURES - 1)].sum(axis=0)
        return z / max(np.linalg.norm(z), 1e-12)

    def compared(self, ids: np.ndarray, sizes: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """For each step: which windows are retrieved for which of its items, and of each text the window around its first word.

        A window is four steps; those of a text begin three steps before it and end three behind it.
        """
        out: dict[int, tuple[list, list]] = {step: ([], []) for step in self.of_step}
        stops = np.cumsum(sizes)
        begins, text = stops - sizes, 0
        while text < len(sizes):
            last = max(text + 1, int(np.searchsorted(stops, begins[text] + COMPARED, side="right")))
            some, feature = sizes[text:last], ids[begins[text] : stops[last - 1]] & (FEATURES - 1)
            twos = -(-some // 2)
            at = np.repeat(begins[text:last] - begins[text], twos) + 2 * within(twos)
            end = np.repeat(stops[text:last] - begins[text], twos)
            after = np.where(at + 1 < end, np.append(feature, FEATURES)[at + 1], FEATURES)
            rows = np.zeros((len(at) + 1, self.wide.shape[1]), self.wide.dtype)  # of two words each; the last one stays empty
            rows[:-1] = self.wide.take(feature[at], axis=0)
            rows[:-1] += self.wide.take(after, axis=0)
            for step, (hits, firsts) in out.items():
                enough = some >= PART * min(len(self.items[k].ids) for k in self.of_step[step])
                pairs, half = np.where(enough, twos, 0), step // 2
                blocks = -(-pairs // half)
                filled = np.full(half * int(blocks.sum()), len(rows) - 1)  # zeros fill up a text's last block
                filled[within(pairs) + np.repeat(half * (np.cumsum(blocks) - blocks), pairs)] = np.flatnonzero(np.repeat(enough, twos))
                sums = np.zeros((len(filled) // half, rows.shape[1]), rows.dtype)
                for k in range(half):
                    sums += rows.take(filled[k::half], axis=0)
                first = 3 + np.cumsum(blocks + 3) - blocks - 3
                steps = np.zeros((int((blocks + 3).sum()) + 3, rows.shape[1]), rows.dtype)
                steps[within(blocks) + np.repeat(first, blocks)] = sums
                whole = steps[:-3] + steps[1:-2] + steps[2:-1] + steps[3:]
                least = COSINE * np.maximum(np.sqrt(np.einsum("ij,ij->i", whole, whole)), 1e-9)
                firsts.append(first - 2 + sum(len(x) for x in hits))
                hits.append(whole @ self.queries[step] >= least[:, None])
            text = last
        return {step: (np.concatenate(hits), np.concatenate(firsts)) for step, (hits, firsts) in out.items() if hits}

    def retrieved(self, windows: dict[int, tuple[np.ndarray, np.ndarray]], text: int, number: int, left: int, right: int) -> bool:
        """Whether a window around a word of the text's stretch is retrieved for the item."""
        step = self.step[number]
        hits, first = windows[step]
        return bool(hits[first[text] + left // step : first[text] + right // step + 1, self.column[number]].any())

    def crowded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, begin and end of the places with enough of an item's rare words."""
        hit = np.flatnonzero(self.table[ids & (TABLE - 1)])
        at = np.minimum(np.searchsorted(self.vocabulary, ids[hit]), max(len(self.vocabulary) - 1, 0))
        good = self.vocabulary[at] == ids[hit]
        hit, at = hit[good], at[good]
        sizes = len(ids) // self.width + 2  # the last one stays empty
        base = np.cumsum(sizes) - sizes
        counts, ends, start = np.zeros(int(sizes.sum()), np.int32), np.cumsum(self.times[at]), 0
        while start < len(hit):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
            times = self.times[at[start:stop]]
            place = self.owners[np.repeat(self.first[at[start:stop]], times) + within(times)]
            bucket = base[place] + np.repeat(hit[start:stop], times) // self.width[place]
            counts += np.bincount(bucket, minlength=len(counts)).astype(np.int32)
            start = stop
        two = np.flatnonzero(counts[:-1] + counts[1:] >= np.repeat(self.asked, sizes)[:-1])
        place = np.searchsorted(base, two, side="right") - 1
        left = (two - base[place]) * self.width[place]
        return place, left, left + 2 * self.width[place]

    def places(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Number of the item, begin and end of all places that may hold a leak."""
        most = int(self.width.max(initial=0))
        for begin in range(0, len(ids) if len(self.searched) else 0, SPAN):
            part = ids[begin : begin + SPAN + most]
            for place, left, right in zip(*self.crowded(part), strict=True):
                yield self.searched[place], begin + int(left), begin + int(right)
            for numbers, at, length in self.answers.found(part):
                for number, start in zip(numbers.tolist(), at.tolist(), strict=True):
                    width = reach(len(self.items[number].ids))
                    yield number, begin + start + length - width, begin + start + width

    def copies(self, ids: np.ndarray, stops: np.ndarray) -> set[tuple[int, int]]:
        """Text and number of the short items that stand in a text as they are."""
        out: set[tuple[int, int]] = set()
        for begin in range(0, len(ids), SPAN):
            for numbers, at, length in self.short.found(ids[begin : begin + SPAN + LEAST]):
                text = np.searchsorted(stops, begin + at, side="right")
                inside = begin + at + length <= stops[text]
                pairs = np.unique(np.stack([text[inside], numbers[inside]], axis=1), axis=0)
                out.update((int(x), int(y)) for x, y in pairs)
        return out

    def checked(self, text: np.ndarray, number: int) -> tuple[float, bool, int] | None:
        """Share of the item, whether the answer is there, and the begin, for the best stretch of `text` that passes."""
        item, words_ = self.items[number], self.distinct[number]
        n, width = len(item.ids), reach(len(item.ids))
        whole, part = least_of(WHOLE, n), least_of(PART, n)
        at = np.flatnonzero(words_[np.minimum(np.searchsorted(words_, text), len(words_) - 1)] == text)
        least = whole
        if len(at) >= part and holds(text, item.answer):
            least = part
        if len(at) < least:
            return None
        ends = np.searchsorted(at, at + width)
        some = np.flatnonzero(ends - np.arange(len(at)) >= least)  # a stretch may begin with a word of the item
        if not len(some) or lcs(item.ids, text[at]) < least:
            return None
        best, common, last = None, 0, None
        for k in some.tolist():
            target = max(least, round(best[0] * n) + 1) if best else least
            if last is not None and common + ends[k] - last < target:  # a stretch gains at most its new words
                continue
            common, last = lcs(item.ids, text[at[k : ends[k]]]), ends[k]
            if common < target:
                continue
            begin = int(at[k])
            answer = holds(text[begin : begin + width], item.answer)
            if common >= whole or answer:
                best = (common / n, answer, begin)
            if common == n:
                break
        return best

    def matches(self, ids: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, float, float, bool, bool]]:
        """Text, item, cosine, share of the item in common, whether the answer is there and whether it was retrieved; the best of each pair."""
        windows = self.compared(ids, sizes)
        stops = np.cumsum(sizes)
        begins = stops - sizes
        zones: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for number, left, right in self.places(ids):
            left, right = max(left, 0), min(right, len(ids))
            for text in range(int(np.searchsorted(stops, left, side="right")), int(np.searchsorted(begins, right))):
                some = (max(left, int(begins[text])), min(right, int(stops[text])))
                if some[1] - some[0] >= PART * len(self.items[number].ids):
                    zones.setdefault((text, number), []).append(some)
        for text, number in sorted(self.copies(ids, stops)):
            whole = self.project(self.items[number].ids)
            yield text, number, float(whole @ whole), 1.0, True, False
        for (text, number), spans in sorted(zones.items()):
            best, cosine, near = None, 0.0, False
            for left, right in merged(spans):
                found = self.checked(ids[left:right], number)
                if found and (best is None or found[:2] > best[:2]):
                    item = self.items[number].ids
                    stretch = ids[left + found[2] : min(right, left + found[2] + reach(len(item)))]
                    best, cosine = found, float(self.project(stretch) @ self.project(item))
                    begin = left + found[2] - int(begins[text])
                    near = self.retrieved(windows, text, number, begin, begin + len(stretch))
            if best:
                yield text, number, cosine, best[0], best[1], near


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans made one."""
    out: list[tuple[int, int]] = []
    for left, right in sorted(spans):
        if out and left <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], right))
        else:
            out.append((left, right))
    return out


def matched(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """doc_id, item_id, cosine, common (share of the item's words), answer and retrieved (short items: false) of every leak."""
    spark = docs.sparkSession
    rows = saved(hashed_rows(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))))
    items = benchmark.select(F.col(item_column).alias("item_id"), F.col("text"))
    kinds = (rows.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString())
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, cosine double, common double, answer boolean, retrieved boolean"
    out, block, model = spark.createDataFrame([], schema), [], None

    def space() -> tuple[np.ndarray, np.ndarray]:
        with noting() as paths:
            every = distinct_passages(rows)
            df, whole = document_frequencies(every)
            fitted = embedded(every, df, whole), df
        removed(spark, paths)
        return fitted

    for row in items.toLocalIterator():
        block.append(item_of(row.item_id, row.text))
        if len(block) == BLOCK:
            model = space() if model is None else model
            out, block = out.unionByName(searched(rows, block, *model, schema)), []
    if block:
        out = out.unionByName(searched(rows, block, *(space() if model is None else model), schema))
    return out


def searched(rows: DataFrame, items: list[Item], space: np.ndarray, df: np.ndarray, schema: str) -> DataFrame:
    model = rows.sparkSession.sparkContext.broadcast((items, space, df))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    shape = to_arrow_schema(_parse_datatype_string(schema))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*model.value)
        for table in slices(batches, "ids", 2_000_000):
            ids, sizes = read_ids(table)
            found = list(searcher.matches(ids, sizes))
            if found:
                text, number, cosine, common, answer, retrieved = zip(*found, strict=True)
                yield pa.record_batch([
                    one(table["doc_id"]).take(pa.array(text)).cast(shape.field(0).type),
                    pa.array([searcher.items[n].key for n in number], shape.field(1).type),
                    pa.array(cosine, pa.float64()), pa.array(common, pa.float64()), pa.array(answer, pa.bool_()),
                    pa.array(retrieved, pa.bool_()),
                ], schema=shape)

    return rows.mapInArrow(search, schema)


def kept_rows(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of `docs` without a leak, with all their columns."""
    rows = located(docs)
    leaks = matched(rows.select(F.col("at").alias("doc_id"), F.col(f"row.{text_column}").alias("text")), benchmark)
    gone = leaks.select(F.col("doc_id").alias("gone")).distinct()
    return rows.join(gone, F.col("at") == F.col("gone"), "left_anti").select("row.*")


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return matched(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


QUERIES = {"op6_decontamination": op6_decontamination}
ORACLE_SQL = {}
