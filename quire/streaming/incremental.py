"""Incremental merging: clusters that arrive in batches enter the clusters there are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quire.operators.combine import combine, interval_links


def merge_batch(old: DataFrame, new: DataFrame, prefix: str) -> DataFrame:
    """Old clusters with the passages of overlapping new ones; the others of the batch under ``prefix``."""
    links = interval_links(new.select("cluster_id", "doc_id", "s", "e"), old.select("cluster_id", "doc_id", "s", "e"))
    return combine(old, new, links, prefix).drop("origin")


def start_merging(spark: SparkSession, stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Merge every micro-batch of new clusters (``cluster_id, doc_id, s, e``) into versions below ``folder``.

    Version ``v=N`` holds the clusters after batch ``N - 1``; ``v=0`` must exist. A batch that is run again after a
    failure overwrites its own version only.
    """

    def merge(batch: DataFrame, number: int) -> None:
        old = spark.read.parquet(f"{folder}/v={number}")
        merge_batch(old, batch.select(*old.columns), f"b{number}").write.mode("overwrite").parquet(f"{folder}/v={number + 1}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
