"""Quality by compression: two zstandard dictionaries, and the difference in compressed size as a score.

Fit. Of the labelled training texts of at most `TEXT_BYTES` bytes, the `SAMPLE` of each label that come first by a
hash of the identifier are the bounded sample: at most SAMPLE * TEXT_BYTES bytes of each label are ever
collected. The first two thirds of each label train its dictionary; the rest calibrate.

Score. d = (size with the bad dictionary - size with the good one) / (size with neither), for the whole text, each
size without what an empty frame takes. A
logistic curve over d, and over the logarithm of how far the text compresses by itself and its square (in text that
repeats itself no dictionary tells much), fitted to the calibration texts with their share of labels, makes
it a probability that the label is 1. A text longer than `BLOCK` is compressed in blocks and the sizes added, so that a
dictionary bears on all of it and memory is bounded.

Cases. Null and empty texts have d = 0. With no label, or one label only, there are no dictionaries; the score is the
share of label 1, or 0.5 without labels. Repeated rows are scored alike. Rows that tie for the sample go by identifier, then text.
A text of any length is compressed whole, in blocks of 64 KB. Labels without a text
and null labels are not used. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.batches import one, slices
from tidemark.llm.shared import fold, load, saved, text_of

FOLDS, CUT = 5, 0.3
SAMPLE, TEXT_BYTES, DICTIONARY, LEVEL, BLOCK = 1500, 20_000, 112_640, 3, 1 << 16


def trained(texts: list[bytes]) -> bytes:
    """A dictionary of the texts: zstandard's own where there are enough of them, else their bytes."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY:]


class Sizes:
    """Compressed sizes with both dictionaries and with neither."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        def ready(content: bytes):
            data = zstandard.ZstdCompressionDict(content)
            data.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)

        plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.good, self.bad, self.plain = ready(good), ready(bad), plain
        self.frame = [len(c.compress(b"")) for c in (self.good, self.bad, self.plain)]

    def measures(self, text: bytes) -> tuple[float, float, float, float]:
        """d, the logarithm of the text's own ratio and its square, and 1."""
        if not text:
            return 0.0, 0.0, 0.0, 1.0
        view = memoryview(text)
        parts = [view[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
        good, bad, plain = (
            max(1, sum(len(c.compress(p)) - frame for p in parts))
            for c, frame in zip((self.good, self.bad, self.plain), self.frame, strict=True)
        )
        ratio = min(0.0, np.log(plain / len(text)))
        return (bad - good) / plain, ratio, ratio * ratio, 1.0


def logistic(design: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights by Newton steps with a slight penalty on all but the last, the intercept."""
    beta = np.zeros(design.shape[1])
    penalty = np.diag([1e-2] * (design.shape[1] - 1) + [1e-9])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty, design.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-10:
            break
    return beta


def fitted(
    examples: DataFrame, id_column: str, text_column: str, label_column: str, share: dict[int, int] | None = None
) -> tuple[bytes, bytes, np.ndarray]:
    """good, bad and the curve's weights from labelled rows; share: the rows of each label that these stand for."""
    rows = examples.where(F.col(label_column).isin(0, 1)).select(
        F.col(id_column).cast("string").alias("key"), text_of(text_column).alias("text"), F.col(label_column).alias("label")
    )
    if share is None:
        share = _share(rows, "label")
    whole = share.get(0, 0) + share.get(1, 0)
    if not share.get(0) or not share.get(1):
        p = 0.5 if not whole else np.clip(share.get(1, 0) / whole, 1e-6, 1 - 1e-6)
        return b"", b"", np.array([0.0, 0.0, 0.0, np.log(p / (1 - p))])
    short = rows.where(F.octet_length("text").between(1, TEXT_BYTES))
    sample = {
        label: [
            row.text.encode() for row in short.where(F.col("label") == label)
            .orderBy(F.xxhash64("key"), "key", "text").limit(SAMPLE).collect()
        ]
        for label in (0, 1)
    }
    cut = {label: (2 * len(texts) + 2) // 3 for label, texts in sample.items()}
    good, bad = (trained(sample[label][: cut[label]]) for label in (1, 0))
    sizes = Sizes(good, bad)
    x, y, weight = [], [], {}
    for label, texts in sample.items():
        # Without texts to spare, as in tiny tables, those of the dictionary calibrate too.
        rest = texts[cut[label] :] or texts
        x += [sizes.measures(text) for text in rest]
        y += [label] * len(rest)
        weight[label] = len(rest)
    beta = logistic(np.array(x), np.array(y, float))
    # The sample is drawn by label; the labels' own shares set the level.
    if weight.get(0) and weight.get(1):
        beta[-1] += np.log(share[1] / share[0]) - np.log(weight[1] / weight[0])
    return good, bad, beta


def _share(rows: DataFrame, label: str) -> dict[int, int]:
    return {row[0]: row[1] for row in rows.where(F.col(label).isin(0, 1)).groupBy(label).count().collect()}


def scored(
    docs: DataFrame, examples: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
    share: dict[int, int] | None = None,
) -> DataFrame:
    """`docs` with the column `score`, the probability that a row's label is 1; share: as for `fitted`."""
    good, bad, beta = fitted(examples, id_column, text_column, label_column, share)
    model = docs.sparkSession.sparkContext.broadcast((good, bad))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(*model.value) if model.value[0] else None
        for table in slices(batches):
            x = [sizes.measures(text) if sizes else (0.0, 0.0, 0.0, 1.0) for text in table["text"].to_pylist()]
            p = 1 / (1 + np.exp(-np.clip(np.array(x) @ beta, -60, 60)))
            yield pa.record_batch({"row": one(table["row"]), "score": pa.array(p)})

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_column).cast("binary").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(score, f"row {kind}, score double")


def labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The sample of documents with a label outside the held-out fold, and all such rows of each label.

    Identifiers and lengths alone are joined to the labels; the at most 2 * SAMPLE identifiers that are picked then
    fetch their texts by a broadcast join, so no text is shuffled.
    """
    sized = docs.select("doc_id", "text", F.octet_length(text_of()).alias("size")).where(fold(F.col("doc_id"), FOLDS) != 0)
    marks = labels.select(F.col("doc_id").alias("of"), F.col("quality").alias("mark")).where("mark in (0, 1)")
    narrow = saved(sized.select("doc_id", "size").join(marks, F.col("doc_id") == F.col("of")).select("of", "size", "mark"))
    fits, key = F.col("size").between(1, TEXT_BYTES), F.col("of").cast("string")
    good, bad = (
        narrow.where(fits & (F.col("mark") == label)).select("of", "mark").orderBy(F.xxhash64(key), key).limit(SAMPLE)
        for label in (1, 0)
    )
    picked = F.broadcast(saved(good.unionByName(bad)).distinct())
    rows = sized.where(fits).join(picked, F.col("doc_id") == F.col("of"))
    return rows.select("doc_id", "text", F.col("mark").alias("quality")), _share(narrow, "mark")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    examples, share = labelled(docs, load(spark, folder, "labels"))
    found = scored(docs, examples, share=share)
    held = F.coalesce(fold(F.col("row.doc_id"), FOLDS) == 0, F.lit(False))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


QUERIES = {"op3_quality": op3_quality}
ORACLE_SQL = {}
