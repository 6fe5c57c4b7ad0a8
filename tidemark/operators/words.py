"""Word counts: totals, running counts per occurrence, and routing by length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import running

# Fixed value: words up to this length are counted, longer ones are routed aside.
MAX_LENGTH = 5
# A running count is cut into blocks for the most frequent words, so many at most, that occur more often than this.
FREQUENT, OFTEN = 10_000, 1_000_000


def words(lines: DataFrame, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row `word` per token of each line, with the `keep` columns and the token's `pos`."""
    tokens = text.tokens(F.col(column))
    if keep:
        return lines.select(*keep, F.posexplode(tokens).alias("pos", "word"))
    return lines.select(F.explode(tokens).alias("word"))


def nonempty(words: DataFrame) -> DataFrame:
    return words.where(F.col("word") != "")


def word_counts(words: DataFrame) -> DataFrame:
    """Occurrences per word. Counts are partial per task first, so a frequent word stays cheap."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def sorted_in_partitions(counts: DataFrame) -> DataFrame:
    """Most frequent first inside each partition; no total order and no exchange."""
    return counts.sortWithinPartitions(F.desc("n"))


def sorted_totally(counts: DataFrame) -> DataFrame:
    """Most frequent first over all partitions, words in order among equals."""
    return counts.orderBy(F.desc("n"), "word")


def running_counts(
    words: DataFrame,
    order: Sequence[str],
    position: Column | None = None,
    widths: Sequence[int] = (),
    out: str = "running",
) -> DataFrame:
    """Each occurrence with the count of its word so far, in `order`.

    Frequent words are in every block of lines, so their rows must not meet in one task: give a
    `position` along the order and block `widths`, see `running.running`. They are counted first, in a job of its
    own; any other word has at most `OFTEN` rows or a share of 1 / `FREQUENT`, and its order is one block.
    """
    if not widths:
        return running.running(words, ["word"], order, F.lit(1), out, running.COUNT)
    often, columns = frequent(words), ["word", *(name for name in words.columns if name != "word"), out]
    if not often:
        return running.running(words, ["word"], order, F.lit(1), out, running.COUNT).select(columns)
    marks = words.sparkSession.createDataFrame([(word, True) for word in often], "word string, _often boolean")
    marked = words.join(F.broadcast(marks), "word", "left").select(*words.columns, "_often")
    place = F.when(F.col("_often"), position).otherwise(F.lit(0))
    return running.running(marked, ["word"], order, F.lit(1), out, running.COUNT, place, widths).select(columns)


def frequent(words: DataFrame) -> list[str]:
    """The most frequent words, `FREQUENT` at most, of those with more than `OFTEN` occurrences."""
    often = word_counts(words).where((F.col("n") > OFTEN) & F.col("word").isNotNull())
    return [row.word for row in often.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()]


def short(column: str = "word", limit: int = MAX_LENGTH) -> Column:
    """Whether a word is counted rather than routed aside, by its length in UTF-16 code units."""
    return text.utf16_length(F.col(column)) <= limit
