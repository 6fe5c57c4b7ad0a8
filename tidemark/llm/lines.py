"""Line dedup: lines found in many documents are dropped from all of them.

Lines are what stands between line feeds. A line's key is the line without ASCII white space at either end, A-Z
lower-cased; it is hashed to two 64-bit numbers. Each row sends a hash once, however often the line stands in it, so
counting rows for each hash, combined in the tasks, counts documents: a line that every document holds is
one partial row for each task. Hashes at the threshold or above are written, and the occurrences of lines
meet them in a semi join (a broadcast where Spark finds them small, else by hash, where Spark splits a hot one). Only
places of dropped lines, as numbers, are gathered for each row; the text meets them once, by the row's place
in its file, and is put together again from the lines that are left, in order.

Cases. A null or empty text is one empty line. The empty key is a line like any other unless `least_chars` leaves it
out; then it is never dropped. A row is a document: repeated rows and identifiers count as often as they stand there.
A text of any length is split in one row, and a line of any length is one key. A text that loses all its lines is
empty. Other columns, clashing names included, are handed on unchanged. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import SPACES, load, located, lower_ascii, saved, text_of

LEAST_CHARS, DOCUMENTS = 1, 10


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def keys_of(text: Column) -> Column:
    """The key of every line, in order."""
    return F.transform(lines_of(lower_ascii(text)), lambda line: F.btrim(line, F.lit("".join(SPACES))))


def hashed(keys: DataFrame) -> DataFrame:
    """`key` replaced by two numbers of it."""
    return keys.withColumns({"low": F.xxhash64("key"), "high": F.xxhash64(F.lit(1), F.col("key"))}).drop("key")


def frequent(texts: DataFrame, least_chars: int = LEAST_CHARS, documents: int = DOCUMENTS) -> DataFrame:
    """low and high of every key of `text` that stands in at least `documents` rows."""
    once = texts.select(F.explode(F.array_distinct(keys_of(F.col("text")))).alias("key")).where(F.char_length("key") >= least_chars)
    return hashed(once).groupBy("low", "high").agg(F.count("*").alias("n")).where(F.col("n") >= documents).select("low", "high")


def cleaned(
    docs: DataFrame, text_column: str = "text", least_chars: int = LEAST_CHARS, documents: int = DOCUMENTS
) -> DataFrame:
    """row (all columns of `docs`), n_lines, n_dropped and kept, the text that is left, of every row."""
    rows = located(docs)
    texts = rows.select("at", text_of(f"row.`{text_column}`").alias("text"))
    often = saved(frequent(texts, least_chars, documents))
    standing = texts.select("at", F.posexplode(keys_of(F.col("text"))).alias("place", "key"))
    dropped = (
        hashed(standing.where(F.char_length("key") >= least_chars)).join(often, ["low", "high"], "left_semi")
        .groupBy(F.col("at").alias("cut")).agg(F.collect_list("place").alias("places"))
    )
    lines = lines_of(text_of(f"row.`{text_column}`"))
    whole = rows.join(dropped, F.col("at") == F.col("cut"), "left").withColumn("lines", lines)
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "places")
    return whole.select(
        "row", F.size("lines").cast("bigint").alias("n_lines"), F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("places").isNull(), text_of(f"row.`{text_column}`"))
        .otherwise(F.array_join(F.transform(left, lambda place: F.get("lines", place)), "\n")).alias("kept"),
    )


def kept_rows(
    docs: DataFrame, text_column: str = "text", least_chars: int = LEAST_CHARS, documents: int = DOCUMENTS
) -> DataFrame:
    """`docs` with all columns, the text without the dropped lines."""
    return cleaned(docs, text_column, least_chars, documents).select(
        *[F.col("kept").alias(name) if name == text_column else F.col(f"row.`{name}`").alias(name) for name in docs.columns]
    )


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned(load(spark, folder, "documents")).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


SQL = r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM texts),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
marked AS (SELECT k.*, o.key IS NOT NULL AS gone FROM keyed k LEFT JOIN often o ON k.key = o.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked JOIN texts USING (r) GROUP BY r
"""

QUERIES = {"op13_line_dedup": op13_line_dedup}
ORACLE_SQL = {"op13_line_dedup": SQL}
