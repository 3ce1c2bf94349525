"""Filling containers of fixed capacity with whole items, under several limits at once.

A container has room for so many tokens, so many segments, and so many tokens that bear loss. The dot-product
heuristic fills one container after another: of the items that still fit it takes the one whose vector has the
largest product with what is left. Items are dealt to shards of a bounded size by a hash; each shard fills its
containers by itself, and the items of containers in which no limit was reached are dealt anew to fewer shards, until
what is left fits one shard or shrinks by less than a fifth. So each task holds a bounded number of items, and the waste of
the shards' last containers is packed again.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import Scratch

CAPACITY, SEGMENTS = 2048, 64
#: Items of a shard (the hash deals about that many), and the fill from which a container is final.
SHARD, FULL = 8192, 0.98


def pack_vectors(items: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Container number of each item; ``items`` has one row per item, each within ``limits``."""
    kinds, back, left = np.unique(items, axis=0, return_inverse=True, return_counts=True)
    members = [list(x) for x in np.split(np.argsort(back.ravel(), kind="stable"), np.cumsum(left)[:-1])]
    scaled = kinds / limits
    out = np.empty(len(items), np.int64)
    bin_, todo = 0, len(items)
    left = left.copy()
    while todo:
        room = limits.astype(np.int64).copy()
        while True:
            fits = (left > 0) & (kinds <= room).all(axis=1)
            if not fits.any():
                break
            k = int(np.argmax(np.where(fits, scaled @ (room / limits), -1.0)))
            out[members[k].pop()] = bin_
            left[k] -= 1
            room -= kinds[k]
            todo -= 1
        bin_ += 1
    return out


def _shard(turn: int, limits: np.ndarray):
    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["doc_id", "piece"], ignore_index=True)
        bins = pack_vectors(np.column_stack([f["n_tokens"], np.ones(len(f), int), f["bear"]]).astype(np.int64), limits)
        fill = np.max([np.bincount(bins, x) for x in (f["n_tokens"], np.ones(len(f)), f["bear"])] / limits[:, None], axis=0)  # of the limit next to its end
        f["container"] = (turn << 56) | (f["_shard"].to_numpy(np.int64) << 24) | bins
        f["fill"] = fill[bins]
        return f[["container", "doc_id", "piece", "token_start", "n_tokens", "bear", "fill"]]

    return run


def fill_containers(items: DataFrame, capacity: int = CAPACITY, segments: int = SEGMENTS, loss: int | None = None, with_loss: bool = False) -> DataFrame:
    """Every item, or the pieces of one that exceeds ``capacity``, with its container.

    ``items``: ``doc_id`` (long, unique for a defined result), ``n_tokens``; optionally ``loss_tokens`` (else all but
    the first token of each piece bear loss); further columns are ignored. ``loss`` limits the loss-bearing tokens of
    a container (default: ``capacity``). Items of null or no tokens need no place and give no row. Returns
    ``container, doc_id, piece, token_start, n_tokens`` and ``with_loss`` the ``loss_tokens`` of each piece, cut to ``loss``; an item is cut only if it alone exceeds the capacity, and
    then into full pieces and a rest. An empty input gives no rows.
    """
    spark = items.sparkSession
    scratch = Scratch(spark, "packing")
    limits = np.array([capacity, segments, loss or capacity], float)
    own = F.col("loss_tokens") if "loss_tokens" in items.columns else F.col("n_tokens")
    pieces = (
        items.where("n_tokens > 0")
        .select("doc_id", F.col("n_tokens").alias("all"), own.alias("bear"), F.explode(F.sequence(F.lit(0), F.expr(f"cast((n_tokens - 1) div {capacity} as int)"))).alias("piece"))
        .select("doc_id", "piece", (F.col("piece") * capacity).cast("long").alias("token_start"), F.least(F.lit(capacity), F.col("all") - F.col("piece") * capacity).cast("long").alias("n_tokens"), "all", "bear")
    )
    bears = F.least(F.greatest(F.floor(F.col("bear") * F.col("n_tokens") / F.col("all")), F.lit(0)), F.lit(int(limits[2]))) if "loss_tokens" in items.columns else F.least(F.col("n_tokens") - 1, F.lit(int(limits[2])))
    todo = scratch.cut(pieces.select("doc_id", "piece", "token_start", "n_tokens", bears.cast("long").alias("bear")))
    schema = "container long, doc_id long, piece int, token_start long, n_tokens long, bear long, fill double"
    done: list[DataFrame] = []
    count, turn = todo.count(), 0
    while count:
        shards = -(-count // SHARD)

        dealt = todo.withColumn("_shard", F.pmod(F.xxhash64(F.lit(turn), "doc_id", "piece"), F.lit(shards)))
        # By number, which is never coalesced: a task has one shard, or a few that meet by hash.
        packed = scratch.cut(dealt.repartition(shards, "_shard").groupBy("_shard").applyInPandas(_shard(turn, limits), schema))
        rest = packed.where(f"fill < {FULL}").drop("container", "fill")
        more = rest.count() if shards > 1 else 0
        turn += 1
        if shards == 1 or more > 0.8 * count:
            done.append(packed)
            break
        done.append(packed.where(f"fill >= {FULL}"))
        todo, count = rest, more
    if not done:
        done = [todo.select(F.lit(0).cast("long").alias("container"), "*")]
    out = [d.select("container", "doc_id", "piece", "token_start", "n_tokens", *[F.col("bear").alias("loss_tokens")] * with_loss) for d in done]
    for d in out[1:]:
        out[0] = out[0].unionAll(d)
    return out[0]
