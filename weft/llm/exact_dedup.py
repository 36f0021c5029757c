"""Exact dedup against a persistent index of text digests, bucketed and sorted by digest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.runtime import scratch_path

from .common import UID, as_scan, keyed_texts, salt, sha256_text, stored, without

SALTS = 64


def text_digest(text):
    """SHA-256 of the text with each run of ASCII white space as one space; null counts as empty."""
    return sha256_text(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " "))


class DigestIndex:
    """A table (digest, keep_id) in ``path``, bucketed and sorted by digest; it only grows.

    Opening an existing path in another session finds the digests again. As
    both the index and a batch are clustered by digest, a batch is compared by
    sort-merge anti-join and the index itself is never shuffled or rewritten.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.path = path or scratch_path(spark, "digests")
        self.name = "weft_digests_" + str(abs(hash(self.path)))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )
        spark.catalog.refreshTable(self.name)

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def ingest(self, docs: DataFrame) -> DataFrame:
        """Compare ``docs`` with the index and with each other, then append the new digests.

        One row per row of ``docs``: weft_uid, doc_id, keep_id (of the row that
        stays), group_size (rows of this batch with the text), kept and
        text_sha256. Of equal texts in a batch the smallest doc_id stays (null
        last, then the earlier row), unless the index knows the text: then none
        stays and keep_id is the indexed id. Null text counts as empty; an empty
        table gives no rows; other columns are ignored.

        Counts are combined per (digest, salt) before they meet per digest, and
        answers go back along the same salts, so a text that a third of the rows
        share is dealt over many tasks.
        """
        rows = stored(
            keyed_texts(docs).select(UID, "doc_id", text_digest(F.col("text")).alias("digest"), salt(UID, SALTS).alias("salt")),
            "batch-digests",
        )
        first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", UID)).alias("first")
        salted = rows.groupBy("digest", "salt").agg(first, F.count(F.lit(1)).alias("n"))
        groups = stored(
            salted.groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts")),
            "batch-groups",
        )
        known = self.entries().select("digest", "keep_id").hint("merge")
        answers = stored(
            groups.join(known.withColumn("known", F.lit(True)), "digest", "left"), "batch-answers"
        )  # read before the index grows
        fresh = groups.join(known, "digest", "left_anti").select("digest", F.col("first.doc_id").alias("keep_id"))
        (
            fresh.repartition(self.buckets, "digest")
            .write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
            .option("path", self.path).saveAsTable(self.name)
        )
        back = answers.select(
            "digest", "n", F.explode("salts").alias("salt"),
            F.when(F.col("known"), F.col("keep_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
            F.when(F.col("known").isNull(), F.col(f"first.{UID}")).alias("kept_uid"),
        )
        return rows.join(back, ["digest", "salt"]).select(
            UID, "doc_id", "keep_id", F.col("n").alias("group_size"),
            F.coalesce(F.col(UID) == F.col("kept_uid"), F.lit(False)).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )


def keep_first(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; a column named weft_uid is refused."""
    docs = as_scan(docs)
    index = index or DigestIndex(docs.sparkSession)
    return without(docs, stored(index.ingest(docs).where(~F.col("kept")).select(UID), "gone"))
