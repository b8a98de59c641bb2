"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 of the normalised text. A batch
is reduced to one row per digest (partial aggregation, so a text that makes up a third of all
rows leaves each task once), sort-merge anti-joined with the index and what is new is appended.

A digest remembers the batch that brought it. The same batch again appends nothing and gives the same
answer, so a batch whose result was lost after the append can be repeated.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.llm.common import SPACE_CLASS, row_key, scratch_path, texts, unused, with_keys, written

BUCKET_ROWS = 250_000      # rows that an index is laid out for, to a bucket
LEAST_BUCKETS = 16


def normalized(text: str | Column) -> Column:
    """Text with every run of white space replaced by one space; null counts as empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(c, F.lit("")), SPACE_CLASS, " ")


def text_digest(text: str | Column) -> Column:
    return F.sha2(normalized(text), 256)


class DigestIndex:
    """Digests seen so far: ``digest, keep_id, batch``, bucketed and sorted by ``digest`` at ``path``.

    ``path`` must be in storage that all executors share. ``rows`` is the number of texts that the index
    is meant to grow to; it sets the number of buckets when the index is made, and that number is kept
    beside it. Opening a path that holds files registers them again, so the index outlives the session.
    """

    def __init__(self, spark: SparkSession, path: str, rows: int = LEAST_BUCKETS * BUCKET_ROWS):
        self.spark, self.path = spark, path
        kept = f"{path.rstrip('/')}-buckets"
        try:
            self.buckets = spark.read.schema("buckets int").parquet(kept).first()["buckets"]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            self.buckets = max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))
            spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.parquet(kept)
        self.table = "digest_index_" + "".join(c if c.isalnum() else "_" for c in path)[-80:].lower()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (digest STRING, keep_id BIGINT, batch STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append_new(self, groups: DataFrame, batch: str) -> None:
        """Append the digests of ``groups`` (one row each) that the index does not hold yet."""
        fresh = groups.select("digest", "keep_id", F.lit(batch).alias("batch")).join(
            self.read().hint("merge"), "digest", "left_anti")
        (fresh.repartition(self.buckets, "digest").write.format("parquet").mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.table))


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep_id`` is the doc_id of the row that stays for this text: the one the index already
    holds, else the smallest of the batch. ``group_size`` counts the batch's rows with this text.
    Exactly one row of a new text is kept: of repeated rows with the same smallest doc_id one
    stays; a null doc_id comes after all others, and if all are null one of them stays with a
    null ``keep_id``. Null and empty text are the same text. An empty table gives no rows. Other
    columns of ``docs`` are not read.

    ``batch`` names the batch; unnamed, its content does (the ids and texts of all rows in any order). A
    batch that comes again keeps the rows that it kept before.
    """
    return _decide(docs, index, batch=batch)


def _decide(docs: DataFrame, index: DigestIndex | None, *more: str, batch: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    rows = written(texts(docs, *more).select("doc_id", text_digest("text").alias("digest"),
                                             F.monotonically_increasing_id().alias("row"), *more), "digests")
    seen = rows.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64(F.col("doc_id").cast("string"), "digest").cast("decimal(38,0)")).alias("h")).first()
    index = index or DigestIndex(spark, scratch_path(spark, "digest-index"), seen["n"])
    batch = batch or f"{seen['n']}-{seen['h']}"
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "row")).alias("first")
    groups = written(rows.groupBy("digest").agg(first, F.count(F.lit(1)).alias("group_size"))
                     .select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("first_row"),
                             "group_size"), "groups")
    known = written(groups.select("digest").join(index.read().where(F.col("batch") != batch).hint("merge"), "digest"), "known")
    index.append_new(groups, batch)
    # keep_id of a digest that another batch brought comes from the index; none of its rows stays.
    owners = groups.join(known.select("digest", F.col("keep_id").alias("known_id"), F.lit(True).alias("known")),
                         "digest", "left").select(
        "digest", "group_size", F.when(F.col("known"), F.col("known_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(F.col("known").isNull(), F.col("first_row")).alias("first_row"))
    # Both sides are plain scans, so a digest with a third of the rows is split by the skew join.
    return rows.join(written(owners, "owners"), "digest").select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("row") == F.col("first_row"), F.lit(False)).alias("kept"),
        F.col("digest").alias("text_sha256"), *more)


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row is known by its doc_id and text, which spreads a hot text over all tasks; of fully
    repeated rows one stays.
    """
    key = unused(docs, "row_key")
    keyed = docs.withColumn(key, row_key())
    stays = _decide(keyed.select("doc_id", "text", F.col(key).alias("key")), None, "key").where("kept").select(
        F.col("key").alias(key))
    return with_keys(keyed, key, stays).select(*docs.columns)


ORACLE = """
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d
"""
