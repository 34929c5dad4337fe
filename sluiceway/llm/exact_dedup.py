"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 of the text. A batch is folded to
one row per digest (with map-side combine, so a group of copies of any size is one row per task),
the digests that the index has are taken away by a sort-merge anti-join in which the index is
neither shuffled nor sorted anew, and the rest is appended. All of it is DataFrame operations.

Across batches the first seen stays: a later copy is dropped whatever its id, and the entry of its
digest keeps the id and the count of the batch that brought it. :func:`decide` and :func:`survivors`
put the whole table into a new index as one batch, so their ids and counts are of all rows.

Defined results: a null text counts as empty; of equal texts in a batch the row with the largest id stays,
a null id is smaller than any other; rows that repeat both id and text are one document (marked
alike by :func:`decide`, returned once by :func:`survivors`); texts of any length are hashed whole; an empty
table adds nothing; further columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.llm.common import settle, whole_text
from sluiceway.runtime import new_dir


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the whole text in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(whole_text(text), 256))


class DigestIndex:
    """A table of (digest, keep_id, copies) under ``path``, bucketed and sorted by digest.

    ``keep_id`` is the id of the row that stays, the largest of the batch that brought the text;
    ``copies`` the rows with this text in that batch. Later batches change neither. ``buckets`` is fixed when the index is made (the session's shuffle partitions
    by default) and read back later. One writer at a time.
    """

    def __init__(
        self, spark: SparkSession, path: str, id_type: T.DataType, buckets: int | None = None
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = self._known_buckets() or self._make(buckets)
        self.name = f"digest_index_{hashlib.md5(self.path.encode()).hexdigest()}"
        self.columns = f"digest BINARY, keep_id {id_type.simpleString()}, copies BIGINT"

    def open(self) -> None:
        """Name the table in the session's catalog, which tells Spark of its buckets."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({self.columns})"
            f" USING parquet CLUSTERED BY (digest) SORTED BY (digest)"
            f" INTO {self.buckets} BUCKETS LOCATION '{self.path}/entries'"
        )

    def close(self) -> None:
        """Take the table out of the session's catalog; its files stay, and a new index at its path has them."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _known_buckets(self) -> int | None:
        try:
            return self.spark.read.schema("buckets INT").parquet(f"{self.path}/layout").first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _make(self, buckets: int | None) -> int:
        n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        layout = self.spark.range(1, numPartitions=1).select(F.lit(n).alias("buckets"))
        layout.write.parquet(f"{self.path}/layout")
        return n

    def bucketed(self) -> DataFrame:
        """The entries with their bucketing, for joins on the digest without a shuffle; ``close`` when done."""
        self.open()
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def entries(self) -> DataFrame:
        """The entries as plain files: a join shuffles them, so Spark may split a hot digest."""
        return self.spark.read.schema(self.columns).parquet(f"{self.path}/entries")

    def add(self, batch: DataFrame) -> None:
        """Append the digests of ``batch`` (digest, doc_id) that the index does not have."""
        groups = batch.groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("copies")
        )
        # Settled, since Spark would otherwise move the anti-join below the fold, and a large
        # group of copies would meet the index row by row.
        groups = settle(groups, "digest-groups")
        fresh = groups.join(self.bucketed().select("digest").hint("merge"), "digest", "left_anti")
        (
            fresh.repartition(self.buckets, "digest")
            .sortWithinPartitions("digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", f"{self.path}/entries")
            .saveAsTable(self.name)
        )


def index_of(docs: DataFrame, label: str = "digest-index") -> tuple[DigestIndex, DataFrame]:
    """A new index with all of ``docs``, out of the catalog again, and the settled (doc_id, digest) rows."""
    spark = docs.sparkSession
    batch = settle(docs.select("doc_id", text_digest().alias("digest")), "digests")
    index = DigestIndex(spark, new_dir(spark, label), docs.schema["doc_id"].dataType)
    try:
        index.add(batch)
    finally:
        index.close()
    return index, batch


def decide(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    index, batch = index_of(docs)
    return batch.join(index.entries(), "digest").select(
        "doc_id",
        "keep_id",
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def survivors(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; repeated rows once."""
    index, _ = index_of(docs)
    kept = index.entries().select("digest", "keep_id")
    own = docs.select(F.struct("*").alias("row"), "doc_id", text_digest().alias("digest"))
    stay = own.join(
        kept.withColumnRenamed("digest", "kept_digest"),
        (F.col("digest") == F.col("kept_digest")) & F.col("doc_id").eqNullSafe(F.col("keep_id")),
    )
    one = Window.partitionBy("digest", "doc_id").orderBy("kept_digest")
    first = stay.withColumn("nth", F.row_number().over(one)).where("nth = 1")
    return first.select("row.*")
