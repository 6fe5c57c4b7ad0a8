"""SimHash near-duplicates by anchor-point covering.

Fingerprint. Over the shingles of 3 lower-case words (ASCII case and white space), repeats included, XXH64 with
seed 42; a bit is 1 if set in over half of them. A shorter text has one shingle, an empty one fingerprint 0.

Covering. Of two fingerprints at most 3 bits apart, one half (32 bits) is at most 1 bit apart. For each half the
anchors are a perfect Hamming code over 31 of its bits: covering radius 1. A fingerprint goes to every
anchor within radius + threshold = 2 of its half, 16 of 2^26; a pair meets at the anchor nearest to either.
Members of an anchor are compared on all 64 bits.

Groups. Distinct fingerprints only are compared, so copies cost nothing. Members of an anchor are linked
by a search that gives at most one link for each member, enough for reachability: large groups don't
make all their pairs. An anchor with over `CELL` members is dealt out by pairs of blocks of its members, so each
task holds two blocks and no link is lost. Components are found in rounds over the links.

The pipeline's stage (`kept_rows`) keeps one row of each component, with these shingles and this distance.

Cases. Null and empty texts have fingerprint 0, linked like any other. A null identifier is no component's name unless
all its members are null. Repeated rows are linked to each other. A text of any length is fingerprinted whole; a bit that
just half of its shingles have is 0. Other columns are not read. An empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.batches import one, slices
from tidemark.llm.components import components
from tidemark.llm.shared import load, located, saved

SHINGLE, SEED, APART, CELL = 3, 42, 3, 8192
LOW = np.uint64(0xFFFFFFFF)


def fingerprint(text: bytes) -> int:
    """The fingerprint of one text."""
    return int(of_hashes(np.array(hashes(text), np.uint64), np.array([len(hashes(text))]))[0])


def hashes(text: bytes) -> list[int]:
    import xxhash

    words = text.lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return [digest(joined, SEED)]
    starts, at = [], 0
    for word in words:
        starts.append(at)
        at += len(word) + 1
    ends = [start - 1 for start in starts[SHINGLE:]] + [len(joined)]
    return [digest(joined[start:end], SEED) for start, end in zip(starts, ends, strict=False)]


def of_hashes(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes."""
    out = np.zeros(len(sizes), np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    stops = np.cumsum(sizes)
    for k, (stop, size) in enumerate(zip(stops, sizes, strict=True)):
        ones = np.zeros(64, np.int64)
        for begin in range(stop - size, stop, 1 << 16):  # long texts in pieces
            part = values[begin : min(stop, begin + (1 << 16))]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        if size:
            out[k] = weights[2 * ones > size].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and fp (64 bits as bigint) of every row."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches):
            found = [hashes(text) for text in table["text"].to_pylist()]
            sizes = np.array([len(x) for x in found], np.int64)
            values = np.fromiter((h for x in found for h in x), np.uint64, int(sizes.sum()))
            yield pa.record_batch({"doc_id": one(table["doc_id"]), "fp": pa.array(of_hashes(values, sizes).view(np.int64))})

    return rows.mapInArrow(make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def syndrome(half: np.ndarray) -> np.ndarray:
    """Which of bits 1 to 31 to flip to get to the nearest code word, 0 for none: the XOR of the set bits' numbers."""
    out = np.zeros(half.shape, np.uint64)
    for bit in range(1, 32):
        out ^= np.where((half >> np.uint64(bit)) & np.uint64(1), np.uint64(bit), np.uint64(0))
    return out


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For fingerprints (uint64): index of the fingerprint and anchor, for all anchors it goes to.

    Bit 0 of a half is no part of the code; the half's number stands in its place. From a word with syndrome
    s the code words within 2 are those with bits i and i ^ s flipped, the nearest with bit s alone.
    """
    rows, keys = [], []
    number = np.arange(len(fps))
    for half in range(2):
        word = (fps >> np.uint64(32 * half)) & LOW & ~np.uint64(1)
        s = syndrome(word)
        flip = lambda i: np.where(i > 0, np.uint64(1) << i, np.uint64(0))
        for i in range(32):
            i = np.full(len(fps), i, np.uint64)
            pair = i ^ s
            new = i < pair if s.size else np.zeros(0, bool)  # each pair once; i = 0 is the nearest
            alone = (s == 0) & (i == 0)
            take = new | alone
            rows.append(number[take])
            keys.append(((word ^ flip(i) ^ flip(pair))[take] | np.uint64(half)))
    return np.concatenate(rows), np.concatenate(keys).view(np.int64)


def linked(values: np.ndarray) -> list[tuple[int, int]]:
    """Links (by place) that join what is reachable among fingerprints at most APART bits apart; fewer than those."""
    links, left = [], np.arange(len(values))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            here = queue.pop()
            near = np.bitwise_count(values[left] ^ values[here]) <= APART
            if near.any():
                found = left[near]
                links += [(int(here), int(x)) for x in found]
                queue += list(found)
                left = left[~near]
    return links


def links(fps: DataFrame, cell: int = CELL) -> DataFrame:
    """a and b: links between distinct fingerprints `fp` at most APART bits apart, enough for reachability."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 5_000):
                values = unsigned(batch.column("fp").slice(begin, 5_000))
                rows, keys = anchors(values)
                yield pa.record_batch({"anchor": pa.array(keys), "fp": pa.array(values[rows].view(np.int64))})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor and blocks; a group that a batch cuts is carried on."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "i", "j")], axis=1)
            held.append((keys, unsigned(batch.column("fp"))))
            if (keys[0] == keys[-1]).all() and (held[0][0][-1] == keys[-1]).all():
                continue
            keys, values = (np.concatenate(part) for part in zip(*held, strict=True))
            last = np.flatnonzero((keys != keys[-1]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            yield from meet(keys[:cut], values[:cut])
            held = [(keys[cut:], values[cut:])]
        if held:
            yield from meet(*(np.concatenate(part) for part in zip(*held, strict=True)))

    def meet(keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        sizes = np.diff(np.append(starts, len(keys)))
        two = starts[sizes == 2]
        near = two[np.bitwise_count(values[two] ^ values[two + 1]) <= APART]
        found = [np.stack([near, near + 1], axis=1)]
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            found.append(start + np.array(linked(values[start : start + size]), np.int64).reshape(-1, 2))
        pairs = np.concatenate(found)
        for begin in range(0, len(pairs), 20_000):
            part = pairs[begin : begin + 20_000]
            yield pa.record_batch({side: pa.array(values[part[:, k]].view(np.int64)) for k, side in enumerate("ab")})

    members = fps.select("fp").mapInArrow(spread, "anchor long, fp long")
    large = saved(  # seldom any; written, so that its size is known to the join
        members.groupBy("anchor").count().where(F.col("count") > cell)
        .select("anchor", F.ceil(F.col("count") / (cell / 2)).cast("long").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("fp"), "blocks")
    met = members.join(large, "anchor", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", own)
    # With one other block at a time: (own, other) in rising order, its own pair of one block included.
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    met = met.select("anchor", "fp", "own", F.explode(others).alias("other")).select(
        "anchor", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"
    )
    return (
        met.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
        .mapInArrow(compare, "a long, b long")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def named(rows: DataFrame, cell: int = CELL) -> DataFrame:
    """`rows` (doc_id and fp) with component_id, the smallest identifier reachable."""
    rows = saved(rows)
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct, cell))
    reached = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = reached.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(reached.join(names, "root").select("fp", "component_id"), "fp")


def grouped(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", cell: int = CELL) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return named(fingerprints(docs, id_column, text_column), cell).select("doc_id", digits.alias("fingerprint"), "component_id")


def kept_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each component, with all its columns: the first one with the smallest identifier."""
    rows = located(docs)
    flat = rows.select(
        F.struct(F.col(f"row.{id_column}").isNull().alias("unnamed"), F.col(f"row.{id_column}").alias("doc_id"), "at").alias("doc_id"),
        F.col(f"row.{text_column}").alias("text"),
    )
    gone = named(fingerprints(flat)).where("doc_id.at != component_id.at").select(F.col("doc_id.at").alias("gone"))
    return rows.join(gone, F.col("at") == F.col("gone"), "left_anti").select("row.*")


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return grouped(load(spark, folder, "documents"))


QUERIES = {"op7_simhash": op7_simhash}
ORACLE_SQL = {}
