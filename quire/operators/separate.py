"""Separation of clusters whose hits don't really belong together.

Both ways, by alignment and by edit distance, are an assignment by priority: hits stand in a line, and one that nobody
before has taken takes all those behind it that it is linked to. ``first_come`` finds that assignment for all clusters at
once from the rows of the links, round by round, so no cluster is held by one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.alphabet import encode
from quire.functions.edits import distances
from quire.functions.sketch import code_arrays
from quire.operators.align import local_alignments
from quire.operators.scan import running_sum
from quire.session import Scratch

#: Sizes of the clusters that are separated.
MIN_COUNT, MAX_COUNT = 100, 20_000


def candidates(hits: DataFrame, min_count: int = MIN_COUNT, max_count: int | None = MAX_COUNT) -> DataFrame:
    """Hits (with a cluster and a text) of the clusters with ``min_count`` to ``max_count`` of them; None: no upper bound."""
    own = hits.where("cluster_id is not null and text is not null")
    sizes = own.groupBy("cluster_id").count().where((F.col("count") >= min_count) & (F.lit(True) if max_count is None else F.col("count") <= max_count)).select("cluster_id")
    return own.join(sizes, "cluster_id", "left_semi")


def place(size: Column, hit: Column) -> Column:
    """Place in line: by size, equal ones by number, as a text that sorts so."""
    return F.format_string("%010d%020d", size, hit)


def first_come(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``b, a``: what is taken and by whom; what isn't named there is taken by nobody.

    ``links``: ``a, at, b``, where ``at`` is the place of ``a``, which is before that of ``b``. Every round those that have nobody
    before them any more take what they are the first to be linked to; links from and to what is taken are gone then.
    The first in line always takes something, so the rounds end. Only least places are aggregated.
    """
    left, taken = scratch.cut(links.select("a", "at", "b")), []
    while not left.isEmpty():
        first = left.groupBy("b").agg(F.min(F.struct("at", "a"))["a"].alias("a"))
        taken.append(scratch.cut(first.join(left.select(F.col("b").alias("a")), "a", "left_anti").select("b", "a")))
        gone = taken[-1].select("b")
        after = scratch.cut(left.join(gone, "b", "left_anti").join(gone.withColumnRenamed("b", "a"), "a", "left_anti").select("a", "at", "b"))
        scratch.drop(left)
        left = after
    return reduce(lambda x, y: x.unionAll(y), taken, left.select("b", "a"))


def _owned(rows: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` with ``owner``, who has taken each hit (itself if nobody has), and whether it is ``alone``."""
    found = rows.join(first_come(links, scratch).select(F.col("b").alias("hit_id"), F.col("a").alias("owner")), "hit_id", "left").withColumn("owner", F.coalesce("owner", "hit_id"))
    found = scratch.cut(found)
    alone = found.groupBy("owner").agg((F.count("*") == 1).alias("alone"))
    return scratch.cut(found.join(alone, "owner"))


def _numbered(members: DataFrame) -> DataFrame:
    """``cluster_id`` as ``{old}_{i}``, ``hit_id`` and the mean ``length`` of each owner's hits; owners count in their order."""
    sizes = members.groupBy("cluster_id", "owner").agg(F.floor(F.sum("size") / F.count("*")).cast("int").alias("length"), F.max(F.when(F.col("hit_id") == F.col("owner"), F.col("at"))).alias("at"), F.lit(1).cast("long").alias("one"))
    named = running_sum(sizes, "cluster_id", "at", "one", "i").select("owner", F.concat("cluster_id", F.lit("_"), F.col("i").cast("string")).alias("name"), "length")
    return members.join(named, "owner").select(F.col("name").alias("cluster_id"), "hit_id", "length")


def separate(hits: DataFrame, alphabet: str = "eng", share: float = 0.75, min_count: int = MIN_COUNT, max_count: int | None = MAX_COUNT, e_value: float = 1e-10) -> DataFrame:
    """Separated clusters by alignment: ``cluster_id`` as ``{old}_{i}``, ``hit_id``, and the mean text ``length``.

    ``hits``: ``hit_id`` (unique long), ``cluster_id``, ``text``; only clusters of ``min_count`` to ``max_count`` hits are
    taken (``separated_all`` has the others too). Hits stand in line by text length; links are alignments longer than
    ``share`` of the longer code. A hit that is left alone moves to where its longest alignment is, unless an earlier one
    has moved to it. Hits without any alignment, and those that moved to one that itself moved on, are missing.
    """
    scratch = Scratch(hits.sparkSession, "separate")
    own = candidates(hits, min_count, max_count).select("hit_id", "cluster_id", F.length("text").alias("size"), encode(F.col("text"), alphabet).alias("enc"))
    own = scratch.cut(own.withColumn("codes", F.length("enc")).withColumn("at", place(F.col("size"), F.col("hit_id"))))
    found = local_alignments(own.select(F.col("hit_id").alias("doc_id"), "enc", "cluster_id"), e_value=e_value, within="cluster_id", both_ways=True)
    best = scratch.cut(found.where("q_id <> h_id").groupBy("q_id", "h_id").agg(F.max("length").alias("length")))
    side = lambda x: own.select(F.col("hit_id").alias(f"{x}_id"), F.col("codes").alias(f"{x}_codes"), F.col("at").alias(f"{x}_at"))
    both = best.join(side("q"), "q_id").join(side("h"), "h_id")
    near = both.where((F.col("q_at") < F.col("h_at")) & (F.col("length") > share * F.greatest("q_codes", "h_codes")))
    rows = _owned(own.drop("enc"), near.select(F.col("q_id").alias("a"), F.col("q_at").alias("at"), F.col("h_id").alias("b")), scratch)
    # Where the hits that are alone would go: to the owner of their longest alignment (ties: the least hit).
    goal = best.groupBy(F.col("q_id").alias("hit_id")).agg(F.min(F.struct(-F.col("length"), "h_id"))["h_id"].alias("to"))
    whose = rows.select(F.col("hit_id").alias("to"), F.col("owner").alias("new"), F.col("alone").alias("new_alone"), F.col("at").alias("to_at"))
    moves = scratch.cut(rows.where("alone").join(goal, "hit_id").join(whose, "to").select("hit_id", "at", "new", "new_alone", "to_at"))
    stay = first_come(moves.where("new_alone and at < to_at").select(F.col("hit_id").alias("a"), "at", F.col("new").alias("b")), scratch).select(F.col("b").alias("hit_id"))
    moved = moves.join(stay, "hit_id", "left_anti")
    arrived = moved.where("not new_alone").unionAll(moved.where("new_alone").join(stay.withColumnRenamed("hit_id", "new"), "new", "left_semi").select(*moved.columns))
    kept = rows.where("not alone").unionAll(rows.where("alone").join(stay, "hit_id", "left_semi").select(*rows.columns)).select("hit_id", "cluster_id", "size", "at", "owner")
    extra = rows.join(arrived.select("hit_id", "new"), "hit_id").select("hit_id", "cluster_id", "size", "at", F.col("new").alias("owner"))
    return _numbered(scratch.cut(kept.unionAll(extra)))


def separated_all(hits: DataFrame, alphabet: str = "eng", share: float = 0.75, min_count: int = MIN_COUNT, max_count: int | None = MAX_COUNT, e_value: float = 1e-10) -> DataFrame:
    """``separate`` and, under their own ``cluster_id``, all hits of the clusters that are not of a size to be separated.

    The latter keep the mean ``length`` of their cluster's texts, truncated, null without one.
    """
    whole = Scratch(hits.sparkSession, "separate").cut(hits.where("cluster_id is not null").select("hit_id", "cluster_id", "text"))
    taken = candidates(whole, min_count, max_count).select("cluster_id").distinct()
    rest = whole.join(taken, "cluster_id", "left_anti")
    lengths = rest.groupBy("cluster_id").agg(F.floor(F.avg(F.length("text"))).cast("int").alias("length"))
    kept = rest.join(lengths, "cluster_id").select("cluster_id", F.col("hit_id").cast("long").alias("hit_id"), "length")
    return separate(whole, alphabet, share, min_count, max_count, e_value).unionAll(kept)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``hit_a, hit_b, distance`` of the pairs whose texts ``xa`` and ``xb`` differ by at most ``most`` edits."""
    for b in batches:
        found = distances(code_arrays(b.column("xa")), code_arrays(b.column("xb")), b.column("most").to_numpy())
        at = pa.array(np.flatnonzero(found >= 0))
        yield pa.RecordBatch.from_arrays([b.column("hit_a").take(at), b.column("hit_b").take(at), pa.array(found.astype(np.int32)).take(at)], ["hit_a", "hit_b", "distance"])


def levenshtein_similar(hits: DataFrame, share: float = 0.75) -> DataFrame:
    """Pairs of hits of one cluster that are similar by edit distance: ``hit_a, hit_b, distance``.

    ``hits``: ``hit_id, cluster_id, text`` (or its ``size``) and, if the distance is that of the codes, ``enc`` (without codes a
    hit has no pair).
    With ``a`` the hit of the smaller id: ``share`` of its text's length is at most the other's, and at least that share of
    what is compared remains unchanged. The distance is at least the difference of the lengths, so a cluster's hits meet by
    blocks of length, each ``1 / share`` as long as the one before: similar ones are in the same block or in
    neighbouring ones.
    """
    what = "enc" if "enc" in hits.columns else "text"
    hits = hits.where("enc <> ''") if what == "enc" else hits
    block = F.when(F.length(what) > 0, F.floor(F.log(F.length(what).cast("double")) / -math.log(share))).otherwise(-1)
    own = hits.select("cluster_id", "hit_id", F.col(what).alias("x"), (F.col("size") if "size" in hits.columns else F.length("text")).alias("size"), block.alias("at"))
    a = own.select("cluster_id", F.col("hit_id").alias("hit_a"), F.col("x").alias("xa"), F.col("size").alias("na"), F.explode(F.sequence(F.col("at") - 1, F.col("at") + 1)).alias("at"))
    b = own.select("cluster_id", F.col("hit_id").alias("hit_b"), F.col("x").alias("xb"), F.col("size").alias("nb"), "at")
    n = F.length("xa")
    close = F.abs(n - F.length("xb")) <= F.floor(n * (1 - share))
    near = a.join(b, ["cluster_id", "at"]).where((F.col("hit_a") < F.col("hit_b")) & (F.col("na") * share <= F.col("nb")) & close)
    kind = hits.schema["hit_id"].dataType.simpleString()
    most = near.select("hit_a", "hit_b", "xa", "xb", F.floor(n * (1 - share)).cast("int").alias("most"))  # a bound ends the comparison early
    return most.mapInArrow(_edits, f"hit_a {kind}, hit_b {kind}, distance int")


def separate_by_edits(hits: DataFrame, alphabet: str = "eng", share: float = 0.75, min_count: int = MIN_COUNT, max_count: int | None = None, farthest: bool = False) -> DataFrame:
    """Separated clusters by the edit distance of the codes: ``cluster_id`` as ``{old}_{i}``, ``hit_id``, mean ``length``.

    Hits stand in line by their number; links are the pairs of ``levenshtein_similar``. A hit that is left alone is a cluster of
    its own, or with ``farthest`` goes, as it once did, to the owner of several whose codes are the farthest from its own
    (ties: the first in line), where there is one: that compares it with all owners of its cluster.
    """
    scratch = Scratch(hits.sparkSession, "edits")
    own = scratch.cut(candidates(hits, min_count, max_count).select("hit_id", "cluster_id", "text", F.length("text").alias("size"), encode(F.col("text"), alphabet).alias("enc"), place(F.lit(0), F.col("hit_id")).alias("at")))
    links = levenshtein_similar(own.select("hit_id", "cluster_id", "text", "enc"), share)
    at = own.select(F.col("hit_id").alias("hit_a"), "at")
    rows = _owned(own.drop("text"), links.join(at, "hit_a").select(F.col("hit_a").alias("a"), "at", F.col("hit_b").alias("b")), scratch)
    if farthest:
        goals = rows.where("not alone and hit_id = owner").select("cluster_id", F.col("owner").alias("new"), F.col("enc").alias("other"), F.col("at").alias("new_at"))
        far = rows.where("alone").join(goals, "cluster_id").groupBy("hit_id").agg(F.min(F.struct(-F.levenshtein("enc", "other"), "new_at", "new"))["new"].alias("new"))
        rows = rows.join(far, "hit_id", "left").withColumn("owner", F.coalesce("new", "owner"))
    return _numbered(scratch.cut(rows.select("hit_id", "cluster_id", "size", "at", "owner")))
