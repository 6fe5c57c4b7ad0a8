"""Cross-tokenizer alignment by pointer jumping: which tokens of two tokenizers cover the same bytes.

A text with a space put before it is encoded by both; each tokenizer's tokens lie end to end over its bytes. Every token
points to its farthest-right overlapping token: the other tokenizer's token over its last byte, if that ends
further right, else the first tokenizer's token that ends there, which then points to itself. Successors are doubled for all
tokens at once until none changes, so every token knows its component's last token, the
group's label, after as many rounds as the logarithm of the longest chain.

Neither tokenizer has an entry with a space behind a printable ASCII character (else texts are taken whole), so a single
space between two of those always begins a token of both, and a group. Texts are cut there, and each distinct chunk in a
task is encoded and aligned once, all new chunks of a slice together; what a text has is summed over its chunks.

Bytes between two neighbouring ends of either tokenizer belong to one token of each, and that is one link. Links are
counted by pair of identifiers, folded in the tasks and summed over the corpus; of a pair is known whether its count is the
highest for its second identifier. A text's own sums meet these counts by a broadcast of the `HEAD` most frequent pairs
(at most 5 MB at any corpus size), and by a shuffled join for all others. Texts are encoded once: what a text holds of each
pair is written, and read again for the sums.

Cases. A text that is null, empty, or whose tokens' bytes of either side, joined, aren't the space and the text,
has no tokens: zeros and ''. Special strings in a text are plain text. A long text is one slice of its own.
Repeated rows and identifiers are rows like any other and count each time. Ties for the highest count are all
best. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.batches import Tally, listed, one, slices
from tidemark.llm.shared import load, saved

FIRST, SECOND, HEAD = "byte_bpe_50k.json", "piece_bpe_32k.model", 1 << 18
#: Bytes of text whose new chunks are encoded and aligned at once.
SLICE = 1_000_000
MARK = "▁"
#: Whether a text has a character beyond the Latin blocks.
OTHER = re.compile("[^\x00-\u024f]").search
CUT, ACROSS = re.compile(r"(?<=[!-~])(?= [!-~])"), re.compile(rb"[!-~] ")


@functools.cache
def first_library(name: str):
    """The byte-level tokenizer and the bytes of each of its entries."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    # The byte-level alphabet: printable Latin characters stand for themselves, the other bytes for those from 256 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in plain]
    byte_of = {chr(byte): byte for byte in plain} | {chr(256 + k): byte for k, byte in enumerate(rest)}
    entries = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for text, number in tokenizer.get_vocab(with_added_tokens=True).items():
        if all(char in byte_of for char in text):
            entries[number] = bytes(byte_of[char] for char in text)
    return tokenizer, entries


@functools.cache
def second_library(name: str):
    """The piece tokenizer and the bytes of each of its pieces."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    pieces = [
        bytes([int(model.id_to_piece(k)[3:-1], 16)]) if model.is_byte(k) else model.id_to_piece(k).replace(MARK, " ").encode()
        for k in range(model.get_piece_size())
    ]
    return model, pieces


@functools.cache
def separable(first: str, second: str) -> bool:
    """Whether texts may be cut before single spaces: no entry of either holds a space behind a printable character.

    Pairs across such a cut are never merged, so what is merged on one side of it doesn't depend on the other.
    """
    return not any(ACROSS.search(entry) for entry in chain(first_library(first)[1], second_library(second)[1]))


@functools.cache
def fast_library(name: str):
    """The first tokenizer's vocabulary and pattern in a faster library; None where its merges aren't in the order of its ids."""
    import json

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        model = json.load(file)["model"]
    made = [model["vocab"].get("".join(pair if isinstance(pair, list) else pair.split(" "))) for pair in model["merges"]]
    if None in made or any(one >= other for one, other in zip(made, made[1:], strict=False)):
        return None
    known = set(made)
    ranks = {entry: number for number, entry in enumerate(first_library(name)[1]) if len(entry) == 1 or number in known}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def first_ids(chunks: list[str], name: str) -> list[list[int]]:
    """The first tokenizer's identifiers of each chunk.

    Chunks of Latin letters go by the faster library: there the two can't differ in what they take for letters,
    numbers and white space.
    """
    tokenizer, fast = first_library(name)[0], fast_library(name)
    if fast is None:
        return [x.ids for x in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
    ids = [None if OTHER(chunk) else fast.encode_ordinary(chunk) for chunk in chunks]
    rest = [k for k, found in enumerate(ids) if found is None]
    for k, x in zip(rest, tokenizer.encode_batch_fast([chunks[k] for k in rest], add_special_tokens=False), strict=True):
        ids[k] = x.ids
    return ids


Side = tuple[np.ndarray, np.ndarray]


def encoded(chunks: list[str], first: str, second: str) -> tuple[Side, Side, np.ndarray]:
    """Identifiers of all chunks (a space and more) in a row and how many each has, by either tokenizer, and whether its bytes come back.

    A chunk whose bytes don't has no identifiers.
    """
    data = [chunk.encode() for chunk in chunks]
    whole, long = b"".join(data), np.fromiter(map(len, data), np.int64, len(data))
    model, pieces = second_library(second)
    made = first_ids(chunks, first), model.encode([chunk[1:] for chunk in chunks], num_threads=1)
    sides, good = [], np.ones(len(chunks), bool)
    for lists, table, lengths in zip(made, (first_library(first)[1], pieces), _lengths(first, second), strict=True):
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
        sides.append((ids, sizes))
        good &= np.bincount(np.repeat(np.arange(len(chunks)), sizes), weights=lengths[ids], minlength=len(chunks)) == long
        # With every length right, the chunks are the same if they are as one; else each is looked at.
        if not good.all() or b"".join([table[i] for i in ids.tolist()]) != whole:
            good &= np.array([b"".join([table[i] for i in x]) == y for x, y in zip(lists, data, strict=True)], bool)
    if not good.all():
        sides = [(ids[np.repeat(good, sizes)], sizes * good) for ids, sizes in sides]
    return sides[0], sides[1], good


def labels(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The component's last token (a place in `left`) of every token, those of `left` first.

    left, right: the ends of the tokens of either side, rising, the last ones equal.
    """
    over = np.searchsorted(right, left)  # the token of the other side over one's last byte
    back = np.searchsorted(left, right)
    farther = right[over] > left if len(left) else np.zeros(0, bool)
    ones = np.where(farther, len(left) + over, np.arange(len(left)))
    succ = np.concatenate([ones, back])
    while True:
        jumped = succ[succ]
        if (jumped == succ).all():
            return succ
        succ = jumped


def written(left: np.ndarray, right: np.ndarray, group_left: np.ndarray, group_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`a1,a2|b1;a3|b2;` of all groups in one row of bytes, and the end of each group in it.

    left, right: identifiers; group_left, group_right: the number of each token's group, rising.
    """
    groups = int(group_left[-1]) + 1 if len(group_left) else 0
    many_left, many_right = np.bincount(group_left, minlength=groups), np.bincount(group_right, minlength=groups)
    at_left = np.arange(len(left)) + (np.cumsum(many_right) - many_right)[group_left]
    at_right = np.arange(len(right)) + np.cumsum(many_left)[group_right]
    numbers, marks = np.empty(len(left) + len(right), np.int64), np.full(len(left) + len(right), ord(","), np.uint8)
    numbers[at_left], numbers[at_right] = left, right
    ends = np.cumsum(many_left + many_right)
    marks[np.cumsum(many_left + many_right) - many_right - 1] = ord("|")
    marks[ends - 1] = ord(";")
    digits = np.ones(len(numbers), np.int64)
    power = 10
    while len(numbers) and (more := numbers >= power).any():
        digits += more
        power *= 10
    stops = np.cumsum(digits + 1)
    out = np.empty(int(stops[-1]) if len(stops) else 0, np.uint8)
    out[stops - 1] = marks
    for k in range(int(digits.max()) if len(digits) else 0):  # from the last digit on
        has = digits > k
        out[stops[has] - 2 - k] = (numbers[has] // 10**k % 10 + 48).astype(np.uint8)
    return out, stops[ends - 1] if groups else stops[:0]


class Places(dict):
    """Numbers chunks as they are asked for."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        return number


class Chunks:
    """Distinct chunks, each aligned once: sizes, groups as text, and links as pairs (first identifier * 2^32 + second)."""

    #: Characters of chunks held at most; beyond, the next slice begins anew.
    MOST = 4_000_000

    def __init__(self, first: str, second: str):
        self.first, self.second = first, second
        self.whole = not separable(first, second)
        self.clear()

    def clear(self) -> None:
        self.places, self.held, self.groups = Places(), 0, []
        self.sizes = np.empty((0, 4), np.int64)  # n_a, n_b, n_groups, and 1 where the bytes come back
        self.pairs, self.ends = np.empty(0, np.int64), np.zeros(1, np.int64)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The places of the chunks of all texts in order, and how many each text has."""
        if self.held > self.MOST:
            self.clear()
        split = [([" " + text] if self.whole else CUT.split(" " + text)) if text else [] for text in texts]
        sizes, before = np.fromiter(map(len, split), np.int64, len(split)), len(self.places)
        places = np.fromiter(map(self.places.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if new := list(islice(self.places, before, None)):
            self.held += sum(map(len, new))
            self._align(new)
        return places, sizes

    def _align(self, chunks: list[str]) -> None:
        (a, a_sizes), (b, b_sizes), good = encoded(chunks, self.first, self.second)
        a_ends, b_ends = (np.cumsum(x[ids]) for x, ids in zip(_lengths(self.first, self.second), (a, b), strict=True))
        chunk = np.repeat(np.arange(len(chunks)), a_sizes)
        last, group = np.unique(labels(a_ends, b_ends), return_inverse=True)
        data, stops = written(a, b, group[: len(a)], group[len(a) :])
        n_groups = np.bincount(chunk[last], minlength=len(chunks))
        stops = np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum(n_groups)])].tolist()
        text = data.tobytes()
        self.groups += [text[begin : max(begin, end - 1)] for begin, end in zip(stops[:-1], stops[1:], strict=True)]
        cuts = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")  # a link ends at each, once
        cuts = cuts[np.append(np.diff(cuts) > 0, True)] if len(cuts) else cuts
        at_a, at_b = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        links = np.bincount(chunk[at_a], minlength=len(chunks))
        self.sizes = np.concatenate([self.sizes, np.stack([a_sizes, b_sizes, n_groups, good], axis=1)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(links)])
        self.pairs = np.concatenate([self.pairs, a[at_a] << 32 | b[at_b]])


def aligned(texts: list[str], chunks: Chunks) -> dict[str, np.ndarray | list]:
    """Of each text n_a, n_b, n_groups, n_links and digest; and row, pair and n of all its pairs."""
    places, many = chunks.of(texts)
    row = np.repeat(np.arange(len(texts)), many)
    back = many > 0
    back[row[chunks.sizes[places, 3] == 0]] = False  # one chunk's bytes don't come back: no tokens
    if not back.all():
        row, places = row[back[row]], places[back[row]]
    sums = [np.bincount(row, weights=chunks.sizes[places, k], minlength=len(texts)).astype(np.int64) for k in range(3)]
    stops = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]).tolist()
    groups, used = chunks.groups, places.tolist()
    digests = [
        hashlib.sha256(b";".join([groups[k] for k in used[begin:end]])).hexdigest() if end > begin else ""
        for begin, end in zip(stops[:-1], stops[1:], strict=True)
    ]
    links = chunks.ends[places + 1] - chunks.ends[places]
    first = np.repeat(chunks.ends[places] - (np.cumsum(links) - links), links)
    pair, row = chunks.pairs[first + np.arange(len(first))], np.repeat(row, links)
    n_links = np.bincount(row, minlength=len(texts))
    # Sorted by text and pair, as one number: identifiers have 16 bits each, or else numbers of their own.
    distinct = None
    if len(pair) and (pair.max() >> 48 or (pair & 0xFFFFFFFF).max() >> 16 or len(texts) >> 31):
        distinct, pair = np.unique(pair, return_inverse=True)
    else:
        pair = pair >> 16 | pair & 0xFFFF
    key = np.sort(row << 32 | pair)
    new = np.flatnonzero(np.diff(key, prepend=-1))
    row, pair = key[new] >> 32, key[new] & 0xFFFFFFFF
    return {
        "n_a": sums[0], "n_b": sums[1], "n_groups": sums[2], "n_links": n_links, "digests": digests,
        "row": row, "pair": distinct[pair] if distinct is not None else pair >> 16 << 32 | pair & 0xFFFF,
        "n": np.diff(np.append(new, len(key))),
    }


@functools.cache
def _lengths(first: str, second: str) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array([len(x) for x in table], np.int64) for table in (first_library(first)[1], second_library(second)[1]))


def alignments(docs: DataFrame, id_column: str, text_column: str, first: str, second: str) -> DataFrame:
    """Of every row: row (a number), doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and links: pair and n.

    A pair is first identifier * 2^32 + second identifier; a row has each of its pairs once.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(first, second)
        for table in slices(batches, limit=SLICE):
            found = aligned(one(table["text"]).to_pylist(), chunks)
            links = listed(found["row"], table.num_rows, {"pair": pa.array(found["pair"]), "n": pa.array(found["n"].astype(np.int32))})
            yield pa.record_batch({
                "row": one(table["row"]), "doc_id": one(table["doc_id"]),
                **{name: pa.array(found[name]) for name in ("n_a", "n_b", "n_groups", "n_links")},
                "groups_sha256": pa.array(found["digests"], pa.string()), "links": links,
            })

    return rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        align,
        f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "links array<struct<pair:long,n:int>>",
    )


def pair_counts(parts: DataFrame) -> DataFrame:
    """pair, n over the corpus, and best: whether no other pair of its second identifier has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            links = batch.column("links").flatten()
            yield from tally.add(links.field("pair"), links.field("n").to_numpy())
        yield from tally.take()

    counts = saved(
        parts.select("links").mapInArrow(count, "value long, n long")
        .groupBy(F.col("value").alias("pair")).agg(F.sum("n").alias("n"))
    )
    second = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = counts.groupBy(second.alias("second")).agg(F.max("n").alias("most"))
    return counts.join(most, second == F.col("second")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def summed(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", first: str = FIRST, second: str = SECOND, head: int = HEAD
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    spark = docs.sparkSession
    parts = saved(alignments(docs, id_column, text_column, first, second))
    counts = saved(pair_counts(parts))
    top = counts.orderBy(F.desc("n"), "pair").limit(head).toArrow().sort_by("pair")
    known = spark.sparkContext.broadcast(tuple(top[name].to_numpy() for name in ("pair", "n", "best")))

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, numbers, best = known.value
        for batch in batches:
            lists = batch.column("links")
            row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            pair, times = (lists.flatten().field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("pair", "n"))
            at = np.minimum(np.searchsorted(pairs, pair), max(0, len(pairs) - 1))
            near = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
            sums, wins = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, row[near], times[near] * numbers[at[near]])
            np.add.at(wins, row[near], times[near] * best[at[near]])
            far = ~near
            yield pa.record_batch({
                "row": batch.column("row"), "sums": pa.array(sums), "wins": pa.array(wins),
                "rest": listed(row[far], batch.num_rows, {"pair": pa.array(pair[far]), "times": pa.array(times[far])}),
            })

    near = saved(
        parts.select("row", "links").mapInArrow(sum_up, "row long, sums long, wins long, rest array<struct<pair:long,times:long>>")
    )
    far = (
        near.select("row", F.explode("rest").alias("x")).select("row", "x.*").join(counts, "pair")
        .select("row", (F.col("times") * F.col("n")).alias("sums"), F.when(F.col("best"), F.col("times")).otherwise(0).alias("wins"))
    )
    total = near.select("row", "sums", "wins").unionByName(far).groupBy("row").agg(F.sum("sums").alias("count_sum"), F.sum("wins").alias("n_best"))
    return parts.drop("links").join(total, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return summed(load(spark, folder, "documents"))


QUERIES = {"op11_alignment": op11_alignment}
ORACLE_SQL = {}
