"""Token counts: pieces are counted once for each distinct pre-token, then summed by document.

Texts are split as the tokenizer's byte-level pre-tokenizer does; special strings in a text are one token
each, as the library's default is. The distinct pre-tokens of the corpus, with their frequencies, are
counted with map-side combine, and the library counts the pieces of each once. A document's sum joins the
frequencies of its pre-tokens to those counts: by a broadcast table of the `HEAD` most frequent pre-tokens of
at most 64 bytes, so at most 8 MB at any corpus size, and for all others by a shuffled join. No ids are
materialised.

Cases. A null text counts as empty: 0 bytes, 0 tokens. Very long texts are split in one go, their pre-tokens
folded. Repeated rows and identifiers are counted row by row. Other columns are not read. An empty table
gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.batches import Tally, coded, listed, one, places, slices
from tidemark.llm.shared import load, saved

TOKENIZER, LIMIT, HEAD, HEAD_BYTES = "byte_bpe_50k.json", 1024, 1 << 17, 64


@functools.cache
def library(name: str):
    """The tokenizer, the pattern of its pre-tokens, and its special strings."""
    import json

    import public_tokenizers
    import regex
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    with open(path, encoding="utf-8") as file:
        special = [token["content"] for token in json.load(file)["added_tokens"]]
    return Tokenizer.from_file(path), regex.compile(public_tokenizers.PATTERN), special


def pretokens(text: str, name: str) -> tuple[list[str], int]:
    """The pre-tokens of a text in order, and the number of special strings in it."""
    _, pattern, special = library(name)
    parts, count = [text], 0
    for mark in special:
        if mark in text:
            split = [part.split(mark) for part in parts]
            count += sum(len(found) - 1 for found in split)
            parts = [part for found in split for part in found]
    if len(parts) == 1:
        return pattern.findall(text), count
    return [token for part in parts for token in pattern.findall(part)], count


def _split(table: pa.Table, name: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    tokens, sizes, marks = [], [], []
    for text in table["text"].to_pylist():
        found, count = pretokens(text, name)
        tokens += found
        sizes.append(len(found))
        marks.append(count)
    return pa.array(tokens, pa.large_string()), np.array(sizes, np.int64), np.array(marks, np.int64)


def frequencies(docs: DataFrame, name: str) -> DataFrame:
    """value (pre-token) and n over the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for table in slices(batches):
            distinct, codes = coded(_split(table, name)[0])
            yield from tally.add(distinct, np.bincount(codes, minlength=len(distinct)))
        yield from tally.take()

    return docs.select("text").mapInArrow(count, "value string, n long").groupBy("value").agg(F.sum("n").alias("n"))


def with_pieces(vocabulary: DataFrame, name: str) -> DataFrame:
    """value, n and pieces: the number of tokens the library makes of it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = library(name)[0]
        for batch in batches:
            made = []
            for begin in range(0, batch.num_rows, 1000):
                values = batch.column("value").slice(begin, 1000).to_pylist()
                made += [len(x.ids) for x in tokenizer.encode_batch(values, add_special_tokens=False)]
            yield pa.record_batch({"value": batch.column("value"), "n": batch.column("n"), "pieces": pa.array(made, pa.int64())})

    return vocabulary.mapInArrow(count, "value string, n long, pieces long")


def counted(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", name: str = TOKENIZER, limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    vocabulary = saved(with_pieces(frequencies(rows, name), name))
    top = (
        vocabulary.where(F.octet_length("value") <= HEAD_BYTES).orderBy(F.desc("n"), "value").limit(HEAD)
        .select("value", "pieces").toArrow()
    )
    head = spark.sparkContext.broadcast((one(top["value"].cast(pa.large_string())), top["pieces"].to_numpy()))
    identity = rows.schema["doc_id"].dataType.simpleString()

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pieces = head.value
        pieces = np.append(pieces.astype(np.int64), 0)
        for table in slices(batches):
            tokens, sizes, marks = _split(table, name)
            distinct, codes = coded(tokens)
            at = places(distinct, known)[codes]
            owner = np.repeat(np.arange(table.num_rows), sizes)
            near = np.bincount(owner, weights=pieces[at], minlength=table.num_rows).astype(np.int64) + marks
            far = at < 0
            keys, times = np.unique(owner[far] * len(distinct) + codes[far], return_counts=True)
            rest = listed(
                keys // max(1, len(distinct)), table.num_rows,
                {"value": distinct.take(pa.array(keys % max(1, len(distinct)))).cast(pa.string()), "n": pa.array(times.astype(np.int64))},
            )
            yield pa.record_batch({
                "row": one(table["row"]), "doc_id": one(table["doc_id"]),
                "n_bytes": pc.binary_length(one(table["text"])).cast(pa.int64()), "near": pa.array(near), "rest": rest,
            })

    parts = saved(
        rows.withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(sum_up, f"row long, doc_id {identity}, n_bytes long, near long, rest array<struct<value:string,n:long>>")
    )
    far = (
        parts.select("row", F.explode("rest").alias("x")).select("row", "x.value", F.col("x.n").alias("times"))
        .join(vocabulary, "value").groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("far"))
    )
    total = F.col("near") + F.coalesce("far", F.lit(0))
    return parts.drop("rest").join(far, "row", "left").select(
        "doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit")
    )


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counted(load(spark, folder, "documents"))


QUERIES = {"op8_token_counts": op8_token_counts}
ORACLE_SQL = {}
