"""Word counts and line cleaning over the text of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import routing, words
from tidemark.plans import tables
from tidemark.sinks import kafka
from tidemark.sources import lines

# Documents per block of a running count, and such blocks per wider block: at 40 billion documents a word
# has 156 million blocks, added up in 38,000 wider ones of 4,096 each.
WIDTHS = (256, 4_096)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    documents = tables.load(spark, folder, "documents").select("doc_id", "text")
    return lines.explode_lines(documents, "text", "doc_id")


def _occurrences(spark: SparkSession, folder: str) -> DataFrame:
    return words.words(_lines(spark, folder), keep=("doc_id", "line_no"))


def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return words.word_counts(words.words(_lines(spark, folder)))


def word_count_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return words.sorted_in_partitions(word_count(spark, folder))


def word_count_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    return words.word_counts(words.nonempty(words.words(_lines(spark, folder))))


def running_word_count(spark: SparkSession, folder: str) -> DataFrame:
    occurrences = words.nonempty(_occurrences(spark, folder))
    return words.running_counts(occurrences, ("doc_id", "line_no", "pos"), F.col("doc_id"), WIDTHS)


def _routed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    content = lines.without_blank(_lines(spark, folder))
    occurrences = words.words(content, keep=("doc_id", "line_no"))
    return routing.split(occurrences, counted=words.short(), rejected=~words.short())


def short_word_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = _routed(spark, folder)["counted"]
    return words.running_counts(counted, ("doc_id", "line_no", "pos"), F.col("doc_id"), WIDTHS)


def rejected_words(spark: SparkSession, folder: str) -> DataFrame:
    return _routed(spark, folder)["rejected"]


def rejected_words_printed(spark: SparkSession, folder: str) -> DataFrame:
    rejected = rejected_words(spark, folder)
    return rejected.select("doc_id", "line_no", "pos", text.prefixed(F.col("word"), "reject word: ").alias("line"))


def clean_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.without_blank(lines.split_records(_lines(spark, folder)))


def publish_lines(spark: SparkSession, folder: str) -> DataFrame:
    return kafka.payload(clean_lines(spark, folder), key="doc_id")


QUERIES = {
    "word_count": word_count,
    "word_count_sorted": word_count_sorted,
    "word_count_nonempty": word_count_nonempty,
    "running_word_count": running_word_count,
    "short_word_counts": short_word_counts,
    "rejected_words": rejected_words,
    "rejected_words_printed": rejected_words_printed,
    "clean_lines": clean_lines,
    "publish_lines": publish_lines,
}

LINES = """
lines AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, rtrim(parts[i], chr(13)) AS value
  FROM (
    SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
    FROM (
      SELECT doc_id, string_split(
        CASE WHEN suffix(text, chr(10)) THEN left(text, length(text) - 1) ELSE text END, chr(10)) AS parts
      FROM documents WHERE text <> '')))"""

TOKENS = """
tokens AS (
  SELECT doc_id, line_no, CAST(i - 1 AS INTEGER) AS pos, toks[i] AS word
  FROM (
    SELECT doc_id, line_no, toks, unnest(range(1, len(toks) + 1)) AS i
    FROM (
      SELECT doc_id, line_no,
        CASE WHEN instr(value, ' ') = 0 THEN [value]
             WHEN rtrim(value, ' ') = '' THEN []
             ELSE string_split(rtrim(value, ' '), ' ') END AS toks
      FROM {source})))"""

_WORDS = "WITH" + LINES + "," + TOKENS.format(source="lines")
_CONTENT = (
    "WITH" + LINES + ",\ncontent AS (SELECT * FROM lines WHERE trim(value, ' ') <> '')," + TOKENS.format(source="content")
)
# UTF-16 code units: one for each code point, and one more beyond the BMP.
_LENGTH = r"length(word) + length(regexp_replace(word, '[^\x{10000}-\x{10FFFF}]', '', 'g'))"
_COUNT = _WORDS + "\nSELECT word, count(*) AS n FROM tokens GROUP BY word"
_RUNNING = """
SELECT doc_id, line_no, pos, word, count(*) OVER (
  PARTITION BY word ORDER BY doc_id, line_no, pos ROWS UNBOUNDED PRECEDING) AS running
FROM tokens WHERE {condition}"""

SQL = {
    "word_count": _COUNT,
    "word_count_sorted": _COUNT,
    "word_count_nonempty": _WORDS + "\nSELECT word, count(*) AS n FROM tokens WHERE word <> '' GROUP BY word",
    "running_word_count": _WORDS + _RUNNING.format(condition="word <> ''"),
    "short_word_counts": _CONTENT + _RUNNING.format(condition=_LENGTH + " <= 5"),
    "rejected_words": _CONTENT + f"\nSELECT doc_id, line_no, pos, word FROM tokens WHERE {_LENGTH} > 5",
    "rejected_words_printed": _CONTENT
    + f"\nSELECT doc_id, line_no, pos, 'reject word: > ' || word AS line FROM tokens WHERE {_LENGTH} > 5",
    "clean_lines": "WITH" + LINES + "\nSELECT doc_id, line_no, value FROM lines WHERE trim(value, ' ') <> ''",
    "publish_lines": "WITH" + LINES
    + "\nSELECT CAST(doc_id AS VARCHAR) AS key, value FROM lines WHERE trim(value, ' ') <> ''",
}
