"""Exact deduplication by stateful streaming: keyed state on disk, full bytes checked on hits.

Texts are equal when identical after deleting ASCII white space. Documents become arrivals (digest of the
normalised text, stable identifier, length, content locator: file and row index). The arrivals stream
through a keyed aggregation whose state, in RocksDB and never expired, holds for each digest the row that
stays (most code points in the original text, then smallest identifier, then locator) and the number of
rows. Later batches update it: the stream can go on where it stopped, from the same checkpoint.

Hits are checked in full: the rows of a digest that came more than once are the same text only if the smallest and the
largest of their texts agree byte by byte. Texts without a hit stay where they are while such digests are `HITS` at most, whose hashes
are then broadcast (some 16 MB); beyond that texts meet them in a shuffled join. The aggregation combines map-side, so a group
of any size sends one text per task. Digests under which texts differ are grouped anew by the whole text.

Cases. A null text counts as empty; empty texts form a group. A null identifier loses to any other. Of
rows that agree in length and identifier, one stays. A text of any length is one value, digested and compared whole.
Other columns are not read, and `kept_rows` hands them on unchanged. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import load, located, saved, scratch, text_of, without_spaces

#: Digests with a hit whose hashes are broadcast.
HITS = 1_000_000

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # A store of few rows else takes megabytes of disk ahead, and uploads its files with each batch.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def with_digest(rows: DataFrame, id_column: str, text_column: str, digest_chars: int) -> DataFrame:
    """doc_id, n_chars, text_sha256, digest, at and the normalised text of `located` rows; streams too."""
    text = text_of(f"row.{text_column}")
    return rows.select(
        F.col(f"row.{id_column}").alias("doc_id"), F.char_length(text).alias("n_chars"),
        without_spaces(text).alias("text"), "at",
    ).withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256)).withColumn(
        "digest", F.substring("text_sha256", 1, digest_chars)
    )


def best() -> Column:
    """The row that stays: the largest of these."""
    return F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("turned"), "doc_id", "at"))


def resolve(arrivals: DataFrame, folder: str, path: str) -> DataFrame:
    """Run the stream over the files of `path`; digest, best and n of every digest.

    arrivals gives the schema. A batch writes the digests that it changed, under its own number, so that
    a batch that is run again replaces its rows.
    """
    spark = arrivals.sparkSession
    out = f"{folder}/changed"
    state = (
        spark.readStream.schema(arrivals.schema).parquet(path)
        .groupBy("digest").agg(best().alias("best"), F.count("*").alias("n"))
    )
    with settings(spark, STATE):
        query = (
            state.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state")
            .foreachBatch(lambda rows, number: rows.write.mode("overwrite").parquet(f"{out}/batch={number}"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    if query.lastProgress is None:
        return spark.createDataFrame([], state.schema)
    changed = spark.read.schema(f"{_ddl(state)}, batch bigint").parquet(out)
    return changed.groupBy("digest").agg(F.max_by(F.struct("best", "n"), "batch").alias("last")).select("digest", "last.*")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", digest_chars: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and `at` of every row.

    digest_chars: the leading hex digits of the SHA-256 that key the state.
    """
    return groups_of(located(docs), id_column, text_column, digest_chars)


def groups_of(rows: DataFrame, id_column: str, text_column: str, digest_chars: int = 64) -> DataFrame:
    """`groups` of `located` rows."""
    spark = rows.sparkSession
    texts = with_digest(rows, id_column, text_column, digest_chars)
    folder = scratch(spark)
    arrivals = texts.drop("text")
    arrivals.write.parquet(f"{folder}/arrivals")
    arrivals = spark.read.schema(arrivals.schema).parquet(f"{folder}/arrivals")
    stays = saved(resolve(arrivals, folder, f"{folder}/arrivals"))  # a table, so that Spark splits a hot digest's join

    hits = saved(stays.where("n > 1").select(F.xxhash64("digest").alias("hit")).distinct())
    few = F.broadcast(hits) if hits.count() <= HITS else hits
    differ = saved(
        texts.join(few, F.xxhash64("digest") == F.col("hit"), "left_semi").groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
        .where("low != high").select("digest")
    )
    if differ.isEmpty():
        found = arrivals.join(stays, "digest")
    else:
        clash = texts.join(differ, "digest")
        apart = clash.groupBy("digest", "text").agg(best().alias("best"), F.count("*").alias("n"))
        found = (
            arrivals.join(differ, "digest", "left_anti").join(stays, "digest")
            .unionByName(clash.join(apart, ["digest", "text"]).drop("text"))
        )
    same = (F.col("best.n_chars") == F.col("n_chars")) & F.col("best.doc_id").eqNullSafe(F.col("doc_id"))
    return found.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (same & (F.col("best.at") == F.col("at"))).alias("kept"), "text_sha256", "at",
    )


def kept_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    rows = located(docs)
    dropped = groups_of(rows, id_column, text_column).where("not kept").select(F.col("at").alias("gone"))
    return rows.join(dropped, F.col("at") == F.col("gone"), "left_anti").select("row.*")


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return groups(load(spark, folder, "documents")).drop("at")


SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER best AS place, first_value(doc_id) OVER best AS keep_id
  FROM texts
  WINDOW best AS (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

QUERIES = {"op2_exact_dedup": op2_exact_dedup}
ORACLE_SQL = {"op2_exact_dedup": SQL}
