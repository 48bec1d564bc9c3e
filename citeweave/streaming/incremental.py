"""Incremental collation with Structured Streaming.

The batch collator resumes by skipping folders whose output exists. As a stream, the file source's
checkpoint is the ledger instead: each raw file is processed once, new files dropped into the tree
are picked up by the next run, and a failed run restarts from its last committed micro-batch.

Each micro-batch is written by the batch writer to ``<out>/batch=<id>``; a batch that is run again
after a failure overwrites its own folder. There is no metadata log in the output, so ``out`` reads
like any folder, together with a batch collection if one was made before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.operators.collate import collate_records, copied_object
from citeweave.session import materialize, scratch_scope
from citeweave.sinks.writers import write_collection


def collate_stream(spark: SparkSession, raw_root: str, out: str, checkpoint: str,
                   glob: str = "*.json", max_files_per_trigger: int = 100_000,
                   available_now: bool = True, newer_than: str | None = None):
    """Stream raw per-paper JSON files into JSONL by batch, parse type and bucket.

    ``checkpoint`` must be on storage shared by the cluster. ``max_files_per_trigger`` bounds each
    micro-batch. With ``available_now`` the query processes every file not yet seen and stops;
    otherwise it keeps running and the caller owns the returned ``StreamingQuery``.

    For a large tree, collate what is there with ``plans.jobs.collate_tree`` into another folder
    and pass the time it started as ``newer_than`` (a timestamp): files not modified after it are
    left to that collection, so no file is in both. Read both folders for the whole. The bucket is
    the first characters of the UUID, as folders of new files are not known beforehand.
    """
    files = (spark.readStream.format("text").option("wholetext", True)
             .option("recursiveFileLookup", True).option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", max_files_per_trigger).load(raw_root))
    if newer_than is not None:
        files = files.where(F.col("_metadata.file_modification_time")
                            > F.lit(newer_than).cast("timestamp"))
    records = files.select(F.col("value").alias("text"),
                           F.col("_metadata.file_name").alias("_file_name"))
    tagged = collate_records(records, "_file_name")
    lines = tagged.withColumn("line", copied_object("text", "file")).drop("text", "file")

    def write(batch: DataFrame, batch_id: int) -> None:
        # Written once, so that the range partitioner's two passes do not open raw files twice.
        with scratch_scope(spark):
            write_collection(materialize(batch, "stream-lines"), f"{out}/batch={batch_id}")

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    return writer.start()
