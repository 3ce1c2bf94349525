"""Merging of new clusters into old ones by overlapping passages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.clusters import without_overlaps

#: Which hits of new data count, by the type of the data, as a test of the node; an unknown type has none.
HIT_TYPES: dict[str, Callable[[Column], Column]] = {"america": lambda node: F.lit(True), "fin": lambda node: ~node.contains("xml")}
#: Width of the blocks of starts by which passages of one document are joined.
BLOCK = 256


def counted(kind: str, node: Column) -> Column:
    """Whether a hit of data of that kind counts; register further kinds in ``HIT_TYPES``."""
    return HIT_TYPES.get(kind, lambda node: F.lit(False))(node)


def clusters_with(hits: DataFrame, test: Column) -> DataFrame:
    """``cluster_id`` of the clusters that have at least one hit that passes the test."""
    return hits.where(F.col("cluster_id").isNotNull() & test).select("cluster_id").distinct()


def node_index(hits: DataFrame) -> DataFrame:
    """Passages by document: ``doc_id, nodes, clusters`` (numbers of passages and of clusters that have one)."""
    return hits.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("nodes"), F.countDistinct("cluster_id").alias("clusters"))


def interval_links(new: DataFrame, old: DataFrame, share: float = 0.9) -> DataFrame:
    """``new_cluster, old_cluster`` with passages of one document that overlap by more than ``share`` of the longer one.

    ``new``, ``old``: ``cluster_id, doc_id, s, e``; rows with a null or without length match nothing. Passages of
    matching length start close to one another, so they are joined by document, length class and start block, not
    by document alone: a document with very many passages is no hot key.
    """
    side = lambda df, x: df.select(F.col("cluster_id").alias(f"{x}_cluster"), "doc_id", F.col("s").alias(f"{x}s"), F.col("e").alias(f"{x}e")).where(f"{x}e > {x}s").distinct()
    at = lambda c: F.floor(F.col(c) / BLOCK)
    n, o = side(new, "new"), side(old, "old")
    reach = F.floor((1 - share) / share * (F.col("newe") - F.col("news"))) + 1
    n = n.withColumn("at", F.explode(F.sequence(F.floor((F.col("news") - reach) / BLOCK), F.floor((F.col("news") + reach) / BLOCK))))
    both = n.join(o.withColumn("at", at("olds")), ["doc_id", "at"])
    overlap = F.least("newe", "olde") - F.greatest("news", "olds")
    longer = F.greatest(F.col("newe") - F.col("news"), F.col("olde") - F.col("olds"))
    return both.where(overlap > F.lit(share) * longer).select("new_cluster", "old_cluster").distinct()


def chosen_links(links: DataFrame) -> DataFrame:
    """One old cluster per new one: the least name. Links with a null are dropped."""
    return links.where("new_cluster is not null and old_cluster is not null").groupBy("new_cluster").agg(F.min("old_cluster").alias("old_cluster"))


def unlinked(new: DataFrame, links: DataFrame, prefix: str = "new") -> DataFrame:
    """Rows of new clusters without a link, their ``cluster_id`` prefixed by ``{prefix}_``."""
    linked = chosen_links(links).select(F.col("new_cluster").alias("cluster_id"))
    rest = new.where("cluster_id is not null").join(linked, "cluster_id", "left_anti")
    return rest.withColumn("cluster_id", F.concat(F.lit(f"{prefix}_"), "cluster_id")).select(*new.columns)


def combine(old: DataFrame, new: DataFrame, links: DataFrame, prefix: str = "new", counted: Column | None = None) -> DataFrame:
    """Old clusters with the hits of their linked new ones, and unlinked new clusters, as ``cluster_id, node parts, origin``.

    ``old``, ``new``: ``cluster_id, doc_id, s, e`` and further columns, the same in both. Old clusters without a link pass
    unchanged. In a linked one overlapping passages are thinned (see ``without_overlaps``) and each kept passage has
    one row, an old one before a new one. ``counted`` says which new hits enter. ``origin`` is ``old`` or ``new``.
    """
    chosen = chosen_links(links)
    fresh = (new if counted is None else new.where(counted)).join(chosen.select(F.col("new_cluster").alias("cluster_id"), "old_cluster"), "cluster_id")
    cols = [c for c in old.columns if c != "cluster_id"]
    touched = chosen.join(new.select(F.col("cluster_id").alias("new_cluster")).distinct(), "new_cluster", "left_semi").select(F.col("old_cluster").alias("cluster_id")).distinct()
    before = old.select("cluster_id", *cols, F.lit("old").alias("origin"), F.lit(0).alias("_o"))
    after = fresh.select(F.col("old_cluster").alias("cluster_id"), *cols, F.lit("new").alias("origin"), F.lit(1).alias("_o"))
    pool = before.join(touched, "cluster_id", "left_semi").unionAll(after.join(old.select("cluster_id").distinct(), "cluster_id", "left_semi"))
    kept = without_overlaps(pool.select(F.col("cluster_id").alias("cluster"), "doc_id", "s", "e")).withColumnRenamed("cluster", "cluster_id")
    ties = [F.col(c) for c in cols if c not in ("doc_id", "s", "e") and dict(pool.dtypes)[c] in ("string", "bigint", "int")]
    w = Window.partitionBy("cluster_id", "doc_id", "s", "e").orderBy("_o", *ties)
    merged = pool.join(kept, ["cluster_id", "doc_id", "s", "e"]).withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    same = before.join(touched, "cluster_id", "left_anti")
    apart = unlinked(new, links, prefix).withColumn("origin", F.lit("new"))
    out = ["cluster_id", *cols, "origin"]
    return merged.select(*out).unionAll(same.select(*out)).unionAll(apart.select(*out))
