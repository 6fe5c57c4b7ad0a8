"""Removal of repeated 200-byte strings by prefix-free parsing.

Phrases. A rolling hash of 16 bytes triggers where it is the smallest of 128 in a row. The string of 200 bytes that
starts at p belongs to the trigger s that is smallest in the first 128 places from p on: s is in it, at most 127
bytes in, and follows from its bytes alone. The starts lo..hi of one trigger make a phrase, the bytes from lo to
hi + 199: phrases overlap by 199 bytes, so every string lies whole in exactly one, and in the order of
strings by their first 200 bytes the order of dictionary phrases' suffixes decides all; the order of the parse, which
sorts on beyond that, isn't needed. Phrases are cut at text ends, and at a million bytes of one text.

Dictionary. Phrases are sorted by their core (the 64 bytes at the trigger) and content. Neighbours tell: a core that
comes once holds no repeat; equal phrases repeat wholly; phrases that share a core only are open.

Suffixes. Open phrases, each with the number of its occurrences, are parsed again with triggers 16 in a row and cores
of 185 bytes, kept with the at most 15 bytes at either side; equal phrases repeat wholly, and for the others
the suffixes that start at each byte are grouped by their 200 bytes and counted; no suffix array is built. Marks of repeated starts go back to their
texts, which cover the bytes, join the rest and digest it.

Cases. A null text counts as empty. Texts under 200 bytes lose nothing. Rows with equal identifier and text are two
texts, each repeating the other; of equal strings none is kept as the first. A text of any length is parsed in chunks of a
million bytes that overlap by 199. Null identifiers are identifiers. Other columns are not read. An empty table:
no rows.

Plan. One exchange of 24 bytes for about 64 bytes of text, by core; texts are shuffled once, for both joins.
A core is as frequent as one string of 64 bytes can be; the window over it spills.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import one, slices
from tidemark.llm.shared import load, saved, text_of

LENGTH, GRAM, WIDE, NARROW = 200, 16, 128, 16
CORE, INNER = 64, LENGTH - NARROW + 1
#: Bytes that are parsed at once; their places take 20 bits.
CHUNK, BITS = 1_000_000, 20
BASE = 0x9E3779B97F4A7C15
WORD = 1 << 64


class Hasher:
    """Hashes of byte strings modulo 2^64, over a fixed random number for each byte."""

    def __init__(self):
        self.table = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        n = CHUNK + 2 * LENGTH + 2
        self.powers, self.inverse = (
            np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, factor, np.uint64)])) for factor in (BASE, pow(BASE, -1, WORD))
        )

    def grams(self, letters: np.ndarray, size: int) -> dict[int, np.ndarray]:
        """Hashes of the 2^i bytes from each place on, for the sizes 16 and up to `size`."""
        kept, at, now = {}, letters, 1
        while now < size:
            at = at[: len(at) - now] * np.uint64(pow(BASE, now, WORD)) + at[now:]
            now *= 2
            if now >= GRAM:
                kept[now] = at
        return kept

    def ranges(self, letters: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(letters) + 1, np.uint64)
        np.cumsum(letters * self.powers[: len(letters)], out=sums[1:])
        return (sums[high] - sums[low]) * self.inverse[low]


def triggers(grams: np.ndarray, width: int) -> np.ndarray:
    """For each place, the rightmost place of the smallest hash among `width` from there on."""
    mask = np.uint64((1 << BITS) - 1)
    mixed = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    least = (mixed & ~mask) | (mask - np.arange(len(grams), dtype=np.uint64))
    step = 1
    while step < width:
        least = np.minimum(least[: len(least) - step], least[step:])
        step *= 2
    return (mask - (least & mask)).astype(np.int64)


def parsed(hasher: Hasher, data: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict, np.ndarray]:
    """Phrases of consecutive texts of the given sizes: low, high and trigger (places in data), owner; and the hashes."""
    letters = hasher.table[data]
    grams = hasher.grams(letters, CORE)
    at = triggers(grams[GRAM], width)
    starts = np.cumsum(sizes) - sizes
    counts = np.maximum(sizes - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    place = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner] + starts[owner]
    trigger = at[place]
    first = np.flatnonzero((np.diff(trigger, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
    last = np.append(first[1:], len(owner)) - 1
    return place[first], place[last], trigger[first], owner[first], grams, letters


def pieces(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, offsets, sizes and joined bytes of texts, long ones in overlapping chunks."""
    rows, offsets, parts, held = [], [], [], 0
    for row, text in enumerate(table["text"].to_pylist()):
        for offset in range(0, max(1, len(text) - LENGTH + 1), CHUNK):
            part = text[offset : offset + CHUNK + LENGTH - 1]
            if held and held + len(part) > CHUNK:
                yield _joined(rows, offsets, parts)
                rows, offsets, parts, held = [], [], [], 0
            if len(part) >= LENGTH:
                rows.append(row)
                offsets.append(offset)
                parts.append(part)
                held += len(part)
    if parts:
        yield _joined(rows, offsets, parts)


def _joined(rows, offsets, parts):
    return np.array(rows), np.array(offsets, np.int64), np.array([len(p) for p in parts], np.int64), np.frombuffer(b"".join(parts), np.uint8)


def phrases(texts: DataFrame) -> DataFrame:
    """core, content, r1, r2 and span (low * 256 + high - low) of every phrase."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for table in slices(batches, limit=CHUNK):
            r1, r2 = (table[c].to_numpy() for c in ("r1", "r2"))
            for rows, offsets, sizes, data in pieces(table):
                low, high, trigger, owner, grams, letters = parsed(hasher, data, sizes, WIDE)
                content = hasher.ranges(letters, low, high + LENGTH)
                start = (np.cumsum(sizes) - sizes)[owner]
                yield pa.record_batch({
                    "core": pa.array(grams[CORE][trigger].view(np.int64)), "content": pa.array(content.view(np.int64)),
                    "r1": pa.array(r1[rows[owner]]), "r2": pa.array(r2[rows[owner]]),
                    "span": pa.array((low - start + offsets[owner]) * 256 + (high - low)),
                })

    return texts.select("r1", "r2", "text").mapInArrow(parse, "core long, content long, r1 long, r2 long, span long")


def marked(found: DataFrame) -> DataFrame:
    """r1, r2, span, whole (it repeats) and weight (not null: open, or stands for the equal ones of an open core)."""
    order = Window.partitionBy("core").orderBy("content")
    before, after, first = F.lag("content").over(order), F.lead("content").over(order), F.first("content").over(order)
    rows = found.select("r1", "r2", "span", "content", before.alias("before"), after.alias("after"), first.alias("first"))
    whole = F.coalesce(F.col("before") == F.col("content"), F.lit(False)) | F.coalesce(F.col("after") == F.col("content"), F.lit(False))
    stands = F.coalesce(F.col("before") != F.col("content"), F.lit(False)) | (
        F.coalesce(F.col("after") != F.col("content"), F.lit(False)) & (F.col("content") == F.col("first"))
    )
    return rows.where("before is not null or after is not null").select(
        "r1", "r2", "span", whole.alias("whole"), F.when(stands, F.when(whole, 2).otherwise(1)).alias("weight")
    ).where("whole or weight is not null")


def suffixes(texts: DataFrame, open_: DataFrame) -> DataFrame:
    """Phrases of open phrases: core, left, right, r1, r2, low, high, trigger (places in the text), weight."""
    lists = open_.groupBy("r1", "r2").agg(F.collect_set(F.struct("span", "weight")).alias("spans"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for table in slices(batches, limit=CHUNK):
            r1, r2 = (table[c].to_numpy() for c in ("r1", "r2"))
            rows, lows, weights, parts, held = [], [], [], [], 0
            for row, (text, spans) in enumerate(zip(table["text"].to_pylist(), table["spans"].to_pylist(), strict=True)):
                for x in spans:
                    low, more = divmod(x["span"], 256)
                    rows.append(row)
                    lows.append(low)
                    weights.append(x["weight"])
                    parts.append(text[low : low + more + LENGTH])
                    held += more + LENGTH
                    if held > CHUNK - 2 * LENGTH:
                        yield split(hasher, r1, r2, rows, lows, weights, parts)
                        rows, lows, weights, parts, held = [], [], [], [], 0
            if parts:
                yield split(hasher, r1, r2, rows, lows, weights, parts)

    def split(hasher, r1, r2, rows, lows, weights, parts) -> pa.RecordBatch:
        sizes, joined = np.array([len(p) for p in parts], np.int64), b"".join(parts)
        low, high, trigger, owner, _, _ = parsed(hasher, np.frombuffer(joined, np.uint8), sizes, NARROW)
        shift = (np.array(lows, np.int64) - (np.cumsum(sizes) - sizes))[owner]
        edges = list(zip(low.tolist(), high.tolist(), trigger.tolist(), strict=True))
        rows = np.array(rows)[owner]
        return pa.record_batch({
            "core": pa.array([hashlib.blake2b(joined[s : s + INNER], digest_size=16).digest() for _, _, s in edges], pa.binary()),
            "left": pa.array([joined[lo:s] for lo, _, s in edges], pa.binary()),
            "right": pa.array([joined[s + INNER : hi + LENGTH] for _, hi, s in edges], pa.binary()),
            "r1": pa.array(r1[rows]), "r2": pa.array(r2[rows]), "low": pa.array(low + shift), "high": pa.array(high + shift),
            "trigger": pa.array(trigger + shift), "weight": pa.array(np.array(weights, np.int64)[owner]),
        })

    return texts.join(lists, ["r1", "r2"]).mapInArrow(
        parse, "core binary, left binary, right binary, r1 long, r2 long, low long, high long, trigger long, weight long"
    )


def repeated(parts: DataFrame) -> DataFrame:
    """r1, r2, low, high: the starts in open phrases whose strings come twice."""
    core, same = Window.partitionBy("core"), Window.partitionBy("core", "left", "right")
    rows = (
        parts.withColumns({"all": F.sum("weight").over(core), "equal": F.sum("weight").over(same)})
        .where("all > 1")
    )
    # Where all share one content it repeats whole; else every start is compared on its own.
    alike = F.col("all") == F.col("equal")
    whole = F.array(F.struct("low", "high"))
    each = F.transform(F.sequence("low", "high"), lambda p: F.struct(p.alias("low"), p.alias("high")))
    back = F.when(alike, -1).otherwise((F.col("trigger") - F.col("span.low")).cast("int"))
    return (
        rows.withColumn("span", F.explode(F.when(alike, whole).otherwise(each)))
        .withColumn("back", back)
        .withColumn("head", F.when(alike, F.lit(b"")).otherwise(F.substr("left", F.octet_length("left") - F.col("back") + 1, F.col("back"))))
        .withColumn("tail", F.when(alike, F.lit(b"")).otherwise(F.substr("right", F.lit(1), NARROW - 1 - F.col("back"))))
        .withColumn("n", F.sum("weight").over(Window.partitionBy("core", "back", "head", "tail")))
        .where("n > 1").select("r1", "r2", "span.low", "span.high")
    )


def cleaned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, kept (the remaining bytes), n_bytes, n_removed and n_spans of every row."""
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("t")).select(
        "doc_id", F.xxhash64("t").alias("r1"), F.xxhash64("doc_id").alias("r2"), F.col("t").cast("binary").alias("text")
    )
    marks = saved(marked(phrases(rows)))
    texts = rows.repartition("r1", "r2")
    ends = repeated(suffixes(texts, marks.where("weight is not null").select("r1", "r2", "span", "weight")))
    low = F.shiftright("span", 8)
    wholes = marks.where("whole").select("r1", "r2", low.alias("low"), (low + F.col("span").bitwiseAND(255)).alias("high"))
    spans = wholes.unionByName(ends).groupBy("r1", "r2").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    identity = rows.schema["doc_id"].dataType.simpleString()

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches):
            kept, removed, runs = [], [], []
            spans = one(table["spans"])
            for text, found in zip(table["text"].to_pylist(), spans, strict=True):
                if not found.is_valid:
                    kept.append(text)
                    removed.append(0)
                    runs.append(0)
                    continue
                edges = found.values
                change = np.zeros(len(text) + 1, np.int32)
                np.add.at(change, edges.field("low").to_numpy(), 1)
                np.add.at(change, edges.field("high").to_numpy() + LENGTH, -1)
                gone = np.cumsum(change[:-1]) > 0
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
                removed.append(int(gone.sum()))
                runs.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
            yield pa.record_batch({
                "doc_id": one(table["doc_id"]), "kept": pa.array(kept, pa.binary()), "n_bytes": pa.array([len(t) for t in table["text"].to_pylist()], pa.int64()),
                "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(runs, pa.int64()),
            })

    return texts.join(spans, ["r1", "r2"], "left").select("doc_id", "text", "spans").mapInArrow(
        cover, f"doc_id {identity}, kept binary, n_bytes long, n_removed long, n_spans long"
    )


def op10_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned(load(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES = {"op10_repeated_bytes": op10_repeated_bytes}
ORACLE_SQL = {}
