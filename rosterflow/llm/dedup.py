"""Exact dedup with a persistent digest index: bucketed and sorted by digest, extended by anti-joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.session import materialize, shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
INDEX_COLUMNS = "digest BINARY, keep_row BIGINT, keep_id BIGINT, group_size BIGINT, batch STRING"


def normalised(text: str = "text"):
    """The text with A-Z in lower case and everything else as it is; null is empty."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, UPPER.lower())


def digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``row`` and the SHA-256 of the normalised text, of every row.

    ``row`` tells rows of one key apart.  It is fixed by writing the frame to the
    shared folder, so that a task that runs again can't number its rows anew.
    """
    numbered = df.select(
        F.col(key).cast("bigint").alias("key"),
        F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(normalised(text), 256)).alias("digest"),
    )
    return materialize(numbered, "digests")


def open_index(spark: SparkSession, name: str, path: str, buckets: int = 64) -> str:
    """Register the index at ``path`` as table ``name``, making it if there is none; gives the name.

    The files stay when the session ends: opening the same path again finds all digests.
    ``buckets`` must be the same each time.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{name}` ({INDEX_COLUMNS}) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return name


def add_batch(batch: DataFrame, index: str, batch_name: str) -> None:
    """Append to the index the digests that it doesn't hold yet.

    ``batch`` comes from :func:`digests`.  Of its rows with one digest, that with the
    largest key is entered, and of those the last row; a null key is the smallest.
    Digests that the index holds stay as they were entered.  The index is read by
    bucket, already dealt and sorted; only the batch's groups are shuffled.  Counts
    are combined before the shuffle, so that a digest of many rows is no hot key.
    A batch whose name the index holds already is not added again.
    """
    spark = batch.sparkSession
    known = spark.table(index)
    if known.where(F.col("batch") == batch_name).limit(1).count():
        return
    groups = batch.groupBy("digest").agg(
        F.max(F.struct("key", "row")).alias("last"), F.count(F.lit(1)).alias("group_size")
    )
    fresh = groups.hint("merge").join(known.select("digest"), "digest", "left_anti").select(
        "digest",
        F.col("last.row").alias("keep_row"),
        F.col("last.key").alias("keep_id"),
        "group_size",
        F.lit(batch_name).alias("batch"),
    )
    # written elsewhere first: a table can't be read and appended to in one job
    rows = materialize(fresh, "fresh_digests")
    buckets = int(spark.sql(f"DESCRIBE EXTENDED `{index}`").where("col_name = 'Num Buckets'").head()["data_type"])
    rows.repartition(buckets, "digest").write.insertInto(index)
    spark.catalog.refreshTable(index)


def lookup(batch: DataFrame, index: str, batch_name: str) -> DataFrame:
    """Each row of the batch with its index entry: ``key, row, digest, keep_id, group_size, kept``.

    ``kept`` is true for the one row of this batch that entered its digest.  The batch
    is the large side; adaptive execution splits it where a digest is hot.
    """
    known = batch.sparkSession.table(index).withColumnRenamed("digest", "known")
    joined = batch.join(known, batch.digest == known.known, "left")
    return joined.select(
        "key", "row", "digest", "keep_id", "group_size",
        ((F.col("batch") == batch_name) & (F.col("row") == F.col("keep_row"))).alias("kept"),
    )


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", index_path: str | None = None) -> DataFrame:
    """One row per input row: ``key, row, digest, keep_id, group_size, kept``.

    Texts are equal when identical after A-Z become a-z; null counts as empty.  Of the
    equal rows of this call the one with the largest key is kept, once, even where
    rows repeat; a text that the index at ``index_path`` already holds is not kept.
    Without a path a new index is made in the shared folder.  An empty frame gives no
    rows.
    """
    spark = df.sparkSession
    batch_name = uuid.uuid4().hex
    path = index_path or f"{shared_dir(spark)}/digest-index-{batch_name}"
    index = open_index(spark, f"digest_index_{batch_name}", path)
    batch = digests(df, key, text)
    add_batch(batch, index, batch_name)
    return lookup(batch, index, batch_name)


def keep_first_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with their columns as they were.

    The texts are dealt once, by (digest, key); that also serves to drop repeated rows.
    """
    kept = exact_dedup(docs, key, text).where("kept").select(F.col("digest").alias("__kept"), F.col("key").alias("__key"))
    rows = docs.withColumn("__digest", F.unhex(F.sha2(normalised(text), 256)))
    same = (F.col("__digest") == F.col("__kept")) & F.col(key).cast("bigint").eqNullSafe(F.col("__key"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["__digest", key]).select(*docs.columns)
