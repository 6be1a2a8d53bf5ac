"""Operator 6: exact deduplication with streaming state.

A Structured Streaming query keeps one row of state per digest, without
expiry, in RocksDB (on disk, snapshots in the shared checkpoint folder): the
digest, the stable id of the row that stays and the locator of its content
(file and row number). Before two rows count as equal, their full normalised
bytes are compared through the locators. New files only add to the state.

The records that stream are small (digest, length, id, locator); texts move
only for the comparison, and a hot digest is combined on the map side before
its shuffle and split by the skew join after it.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm.common import kept_table, located, squeeze
from ridgeline.session import child_names, scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# All state stores of an executor share this much memory.
STATE_MB = 256


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def update_index(spark: SparkSession, landing: str, state: str) -> DataFrame:
    """Streams the records that are new in ``landing`` into the state at
    ``state`` and returns what it holds of digests met more than once: digest,
    n, keep (the record that stays)."""
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
                # many small stores: no preallocated log space each
                "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
                "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
                "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": str(STATE_MB)}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        records = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)
        best = F.min(F.struct("points", "no_id", "doc_id", "file", "row")).alias("keep")
        query = (records.groupBy("digest").agg(best, F.count("*").alias("n"))
                 .writeStream.format("noop").outputMode("update").option("checkpointLocation", state)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        path = scratch_path(spark, "dedup-index")
        (spark.read.format("statestore").load(state).select("key.digest", "value.*").toDF("digest", "keep", "n")
         .where("n > 1").write.parquet(path))
        return spark.read.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored_contents(records: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """``records`` (file, row, digest) of earlier calls with their content, read
    from the files that their locators name. A content that is gone or no
    longer has its digest fails the query."""
    # the folders of the landed tables, as they are read: locators are
    # URL-encoded, and names are no patterns
    folders = records.select(F.regexp_extract("file", "^(.*)/[^/]*$", 1).alias("folder")).distinct()
    files = [re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(r.folder)) for r in folders.toLocalIterator()]
    if not files:
        return records.withColumn("content", F.lit(""))
    texts = (records.sparkSession.read.schema("text string").parquet(*files)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
                     squeeze(F.coalesce("text", F.lit(""))).alias("content")))
    changed = F.concat(F.lit("content of an earlier row is gone or changed: "), "file", F.lit(" row "), "row")
    return records.join(texts, ["file", "row"], "left").withColumn(
        "content", F.when(digest(F.col("content")) == F.col("digest"), F.col("content"))
        .otherwise(F.raise_error(changed).cast("string")))


def decisions(docs: DataFrame, digest: Callable[[Column], Column] = sha256, landing: str | None = None,
              state: str | None = None) -> DataFrame:
    """One row per row of ``docs``, which has its locator, and per row of earlier
    calls with the same folders: doc_id, file, row, keep_id, group_size, kept,
    text_sha256.

    Texts are equal when identical without the characters of
    ``[\\x20\\x09-\\x0D]``; null counts as empty. Of equal texts the row with
    the most code points stays, then the smallest doc_id (a null id last); of
    rows that tie in all this, repeated rows included, the first by locator.
    An empty table gives an empty result. ``landing`` and ``state`` name
    folders to keep between calls (a call adds the rows it is given to what
    they hold, a row is known by its locator, so a call may be repeated); by
    default each call has its own. Earlier rows are compared by the texts in
    the Parquet files of their locators, which have to stay; the names of their
    folders, not of the files, come to the driver.
    """
    spark = docs.sparkSession
    kept_landing = landing is not None
    landing = landing or scratch_path(spark, "dedup-records")
    state = state or scratch_path(spark, "dedup-state")
    plain = F.coalesce("text", F.lit(""))
    content = docs.select("doc_id", "file", "row", plain.alias("original"), squeeze(plain).alias("content"))
    added = content
    if kept_landing and child_names(spark, landing):  # a row that an earlier try of this call has landed is not landed again
        added = content.join(spark.read.parquet(landing).select("file", "row"), ["file", "row"], "left_anti")
    (added.select("doc_id", F.col("doc_id").isNull().alias("no_id"), "file", "row",
                    (-F.char_length("original")).alias("points"), digest(F.col("content")).alias("digest"))
     .write.mode("append").parquet(landing))
    index = update_index(spark, landing, state)
    claimed = kept_table(spark.read.parquet(landing).join(index, "digest", "left"), "dedup-claims")

    # every claimed copy against its keeper, byte for byte
    texts = content.select("file", "row", "content")
    if kept_landing:
        earlier = kept_table(claimed.where("n > 1").select("file", "row", "digest").distinct()
                             .join(content.select("file", "row"), ["file", "row"], "left_anti"), "dedup-earlier")
        texts = texts.union(stored_contents(earlier, digest).select(texts.columns))
    found = kept_table(texts.join(claimed.where("n > 1"), ["file", "row"]), "dedup-bytes")
    is_keeper = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    keepers = found.where(is_keeper).select("digest", F.col("content").alias("keeper_content"))
    # written before it is reduced, so that the join can split a hot digest
    differ = kept_table(found.where(~is_keeper).join(keepers, "digest")
                        .where(F.col("content") != F.col("keeper_content")).select("digest"), "dedup-differ").distinct()
    names = ["doc_id", "file", "row", "digest", "keep", "n"]
    if not differ.isEmpty():  # one digest, several texts: these groups form by their bytes
        mixed = found.join(differ, "digest", "left_semi")
        best = F.min(F.struct("points", "no_id", "doc_id", "file", "row")).alias("keep")
        exact = mixed.groupBy("digest", "content").agg(best, F.count("*").alias("n"))
        claimed = (claimed.join(differ, "digest", "left_anti").select(names)
                   .unionByName(mixed.drop("keep", "n").join(exact, ["digest", "content"]).select(names)))
    single = F.col("n").isNull()
    return claimed.select(
        "doc_id", "file", "row",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.when(single, F.lit(True)).otherwise(is_keeper).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, unchanged (see ``decisions``)."""
    rows = located(docs, "dedup_file", "dedup_row")
    dropped = decisions(rows.select("doc_id", "text", F.col("dedup_file").alias("file"),
                                    F.col("dedup_row").alias("row"))).where("not kept")
    dropped = dropped.select(F.col("file").alias("dedup_file"), F.col("row").alias("dedup_row"))
    return rows.join(dropped, ["dedup_file", "dedup_row"], "left_anti").select(docs.columns)


# DuckDB SQL for the rows of the query (ids are distinct there)
ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(content) AS text_sha256
FROM d WINDOW w AS (PARTITION BY content ORDER BY points DESC, doc_id)"""
