"""Running sums over a global order, without one task per key.

Rows are range-sorted by (key, order), summed within each partition, and the sums of the partitions before are added:
a key with a third of all rows spreads over many partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import Scratch


def _local(key: str, value: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = TaskContext.get().partitionId()
        last, total = None, 0
        for f in frames:
            if f.empty:
                continue
            sums = f.groupby(key, sort=False)[value].cumsum()
            if f[key].iloc[0] == last:
                sums = sums + (f[key] == last) * total
            last, total = f[key].iloc[-1], int(sums.iloc[-1])
            yield f.assign(_pid=pid, _upto=sums)

    return run


def _carried(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sum of the partitions before that reaches into each partition, for its first key; partitions in order."""
    rows = sorted(r for f in frames for r in f[["_pid", "_first", "_last", "_sum"]].itertuples(index=False, name=None))
    key, total, out = None, 0, []
    for pid, first, last, upto in rows:
        out.append((pid, first, total if first == key else 0))
        key, total = last, upto + (total if last == key else 0)
    yield pd.DataFrame(out, columns=["_pid", "_first", "_carry"])


def running_sum(df: DataFrame, key: str, order: str, value: str, to: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before, of the same ``key``, by ``order``, in column ``to``.

    ``order`` must be unique within a key for a defined result (ties come in any order). Key, order and value must
    not be null. An empty table stays empty. Only one row per partition passes through a single task.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, key, order).sortWithinPartitions(key, order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", _pid int, _upto long"
    local = Scratch(spark, "scan").cut(ordered.mapInPandas(_local(key, value), schema))
    # One row per partition: its first key, and its last one with the sum there.
    parts = local.groupBy("_pid").agg(F.min(key).alias("_first"), F.max(F.struct(F.col(key), F.col("_upto"))).alias("x")).select("_pid", "_first", F.col(f"x.{key}").alias("_last"), F.col("x._upto").alias("_sum"))
    carry = parts.coalesce(1).mapInPandas(_carried, f"_pid int, _first {df.schema[key].dataType.simpleString()}, _carry long")
    with_carry = local.join(F.broadcast(carry), "_pid", "left")
    more = F.when(F.col("_first") == F.col(key), F.col("_carry")).otherwise(0)
    return with_carry.withColumn(to, F.col("_upto") - F.col(value) + F.coalesce(more, F.lit(0))).select(*df.columns, to)
