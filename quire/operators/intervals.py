"""Merging of overlapping intervals and the gaps between them, without one task per entity.

The intervals are range-sorted by (entity, start, end), so one entity with a third of all rows spreads over many
partitions. Every partition is scanned once into local islands; one summary row per partition (its first and last
entity and its last island) is combined in partition order, and the carried island relabels the head of the
following partitions. Only the summaries, one row per partition, pass through a single task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.session import Scratch

LOCAL = "pid int, entity string, s long, e long, prev_e long"


def _local_islands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Islands of one sorted partition; prev_e is the end of the island before, of the same entity."""
    pid = TaskContext.get().partitionId()
    cur: tuple | None = None
    before = None
    rows: list[tuple] = []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * 4
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        arrays = [pa.array([pid] * len(rows), pa.int32())]
        arrays += [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["pid", "entity", "s", "e", "prev_e"])

    for b in batches:
        for ent, s, e in zip(*(b.column(k).to_pylist() for k in ("entity", "s", "e")), strict=True):
            if cur is not None and cur[0] == ent and s <= cur[2]:
                if e > cur[2]:
                    cur = (ent, cur[1], e)
                continue
            if cur is not None:
                rows.append((*cur, before))
                before = cur[2] if cur[0] == ent else None
            cur = (ent, s, e)
        if len(rows) >= 20_000:
            yield flush()
            rows = []
    if cur is not None:
        rows.append((*cur, before))
    if rows:
        yield flush()


def periods_and_gaps(spans: DataFrame, partitions: int | None = None) -> DataFrame:
    """Continuous periods and the gaps between them, per entity.

    ``spans``: ``entity`` string, ``s`` and ``e`` integers with ``s <= e``, half-open. Spans that overlap or touch
    form one period; a gap runs from the end of a period to the start of the next of the same entity. Rows with a
    null in any of the three columns are left out; reversed bounds are swapped; repeated rows count once; an
    empty span (``s = e``) is a period of length zero unless another touches it. An empty input gives no rows.
    Further columns are ignored. Returns ``entity, kind ('period' or 'gap'), s, e``.
    """
    spark = spans.sparkSession
    scratch = Scratch(spark, "intervals")
    clean = (
        spans.select(F.col("entity").cast("string"), F.least("s", "e").cast("long").alias("s"), F.greatest("s", "e").cast("long").alias("e"), F.col("s").isNotNull().alias("a"), F.col("e").isNotNull().alias("b"))
        .where("entity is not null and a and b")
        .select("entity", "s", "e")
        .distinct()
    )
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = clean.repartitionByRange(n, "entity", "s", "e").sortWithinPartitions("entity", "s", "e")
    local = scratch.cut(ordered.mapInArrow(_local_islands, LOCAL))
    # One row per partition: bounded by the number of partitions, so it may be combined in one task.
    parts = local.groupBy("pid").agg(
        F.min("entity").alias("first_entity"),
        F.max(F.struct("entity", "s", "e")).alias("last"),
    )
    carry = parts.coalesce(1).select("pid", "first_entity", "last.*").mapInPandas(_carry, "pid int, c_entity string, c_s long, c_e long")
    joined = local.join(F.broadcast(carry), "pid", "left")
    mine = F.col("entity") == F.col("c_entity")
    label = F.when(mine & (F.col("s") <= F.col("c_e")), F.col("c_s")).otherwise(F.col("s"))
    last_end = F.greatest(F.col("prev_e"), F.when(mine, F.col("c_e")))
    pieces = joined.select("entity", label.alias("label"), "s", "e", last_end.alias("before"))
    periods = pieces.groupBy("entity", "label").agg(F.max("e").alias("e"))
    gaps = pieces.where("before < s")
    return periods.select("entity", F.lit("period").alias("kind"), F.col("label").alias("s"), "e").unionAll(
        gaps.select("entity", F.lit("gap").alias("kind"), F.col("before").alias("s"), F.col("s").alias("e"))
    )


def _carry(frames):
    """Island that reaches into each partition from those before it, from one summary row per partition."""
    import pandas as pd

    rows = sorted(r for f in frames for r in f[["pid", "first_entity", "entity", "s", "e"]].itertuples(index=False, name=None))
    state = None
    out = []
    for pid, first, last, s, e in rows:
        out.append((pid, *(state or (None, None, None))))
        if state and first == last == state[0] and s <= state[2]:
            state = (last, state[1], max(state[2], e))
        else:
            state = (last, s, e)
    yield pd.DataFrame(out, columns=["pid", "c_entity", "c_s", "c_e"]).astype({"c_s": "Int64", "c_e": "Int64"})


def _labels(frames):
    """Label (first start) and furthest reach so far of the local island of every row of a sorted partition."""
    pid = TaskContext.get().partitionId()
    cur = None
    for f in frames:
        labels, reaches = [], []
        for ent, s, reach in f[["entity", "s", "reach"]].itertuples(index=False, name=None):
            cur = (ent, cur[1], max(cur[2], reach)) if cur is not None and cur[0] == ent and s <= cur[2] else (ent, s, reach)
            labels.append(cur[1])
            reaches.append(cur[2])
        yield f.assign(_pid=pid, _label=labels, _reach=reaches)


def island_labels(rows: DataFrame) -> DataFrame:
    """``rows`` with ``island``: equal for rows of one entity that are connected through overlapping or touching reaches.

    ``rows``: ``entity`` string, ``s`` long and ``reach`` long (not null, ``reach >= s``), and further columns. A row
    belongs to the island before it if its ``s`` is at most the furthest ``reach`` there. The same scan as in
    ``periods_and_gaps``: no entity is gathered.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "entity", "s", "reach").sortWithinPartitions("entity", "s", "reach")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    local = Scratch(rows.sparkSession, "islands").cut(ordered.mapInPandas(_labels, f"{schema}, _pid int, _label long, _reach long"))
    parts = local.groupBy("_pid").agg(F.min("entity").alias("first_entity"), F.max(F.struct("entity", "_label", "_reach")).alias("last"))
    parts = parts.coalesce(1).select(F.col("_pid").alias("pid"), "first_entity", "last.entity", F.col("last._label").alias("s"), F.col("last._reach").alias("e"))
    carry = parts.mapInPandas(_carry, "pid int, c_entity string, c_s long, c_e long")
    joined = local.join(F.broadcast(carry), F.col("_pid") == F.col("pid"), "left")
    label = F.when((F.col("entity") == F.col("c_entity")) & (F.col("_label") <= F.col("c_e")), F.col("c_s")).otherwise(F.col("_label"))
    return joined.select(*rows.columns, label.alias("island"))


def hit_spans(hits: DataFrame) -> DataFrame:
    """Span of every hit: two numbers in ``encoded_indices``, else the offsets in ``node``.

    A null ``doc_id`` is taken from ``node``. Numbers may be padded and reversed. Hits with neither form, or with
    no document, are left out. Returns ``entity, s, e``.
    """
    node = r"^\s*(.*?)___\s*(-?\d+)\s*_\s*(-?\d+)\s*$"
    enc = F.col("encoded_indices")
    num = lambda i: F.when(F.size(enc) == 2, F.expr(f"try_cast(trim(try_element_at(encoded_indices, {i})) as long)"))
    part = lambda i: F.expr(f"try_cast(nullif(regexp_extract(node, '{node}', {i}), '') as long)".replace("\\", "\\\\"))
    good = num(1).isNotNull() & num(2).isNotNull()
    spans = hits.select(
        F.coalesce(F.col("doc_id"), F.expr(f"nullif(regexp_extract(node, '{node}', 1), '')".replace("\\", "\\\\"))).alias("entity"),
        F.when(good, num(1)).otherwise(part(2)).alias("a"),
        F.when(good, num(2)).otherwise(part(3)).alias("b"),
    ).where("entity is not null and a is not null and b is not null")
    return spans.select("entity", F.least("a", "b").alias("s"), F.greatest("a", "b").alias("e"))
