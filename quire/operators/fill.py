"""Clusters with the original text and metadata of their passages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.alphabet import positions, span_of
from quire.functions.nodes import node_string
from quire.operators.blocks import latest
from quire.operators.hsp import passages
from quire.session import Scratch

#: Passages of one document that are decoded together.
TOGETHER = 64


def fill_text(nodes: DataFrame, docs: DataFrame, alphabet: str = "eng", mode: str = "compat") -> DataFrame:
    """``nodes`` with ``text, i0, i1``: the raw text of each passage and its offsets, null where it can't be decoded.

    ``nodes``: ``doc_id`` string, ``s, e`` and further columns; ``docs``: ``doc_id`` (unique, any type), ``text``. The
    offsets of a document's letters are found once per ``TOGETHER`` of its passages, so the passages of one document
    are dealt to groups of about that size.
    """
    extra = [c for c in nodes.columns if c not in ("doc_id", "s", "e", "text", "i0", "i1")]
    counts = nodes.groupBy("doc_id").agg(F.count("*").alias("_n"))
    groups = F.ceil(F.col("_n") / TOGETHER)
    dealt = nodes.join(counts, "doc_id").withColumn("_g", F.pmod(F.xxhash64("s", "e", *extra), groups))
    packed = dealt.groupBy("doc_id", "_g").agg(F.collect_list(F.struct("s", "e", *extra)).alias("_nodes"))
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("_text"))
    joined = packed.join(texts, "doc_id", "left").withColumn("_pos", positions(F.col("_text"), alphabet))
    size = F.length("_text")
    one = joined.select("doc_id", "_text", F.explode(F.transform("_nodes", lambda x: F.struct(x.alias("x"), span_of(F.col("_pos"), size, x["s"], x["e"], mode).alias("at")))).alias("y"))
    i0, i1 = F.col("y.at.i0"), F.col("y.at.i1")
    return one.select("doc_id", F.col("y.x.s").alias("s"), F.col("y.x.e").alias("e"), *(F.col(f"y.x.{c}").alias(c) for c in extra), F.when(i0.isNotNull(), F.substring("_text", i0 + 1, i1 - i0)).alias("text"), i0.alias("i0"), i1.alias("i1"))


def alignment_texts(hsp: DataFrame, docs: DataFrame, alphabet: str = "eng", mode: str = "compat") -> DataFrame:
    """Alignments with the raw text of both sides, ``q_text`` and ``h_text``; null where a side can't be decoded."""
    texts = Scratch(hsp.sparkSession, "texts").cut(fill_text(passages(hsp).where("doc_id is not null and s is not null and e is not null").distinct(), docs, alphabet, mode))
    side = lambda x: texts.select(F.col("doc_id").alias(f"{x}_id"), F.col("s").alias(f"{x}_start"), F.col("e").alias(f"{x}_end"), F.col("text").alias(f"{x}_text"))
    return hsp.join(side("q"), ["q_id", "q_start", "q_end"], "left").join(side("h"), ["h_id", "h_start", "h_end"], "left").select(*hsp.columns, "q_text", "h_text")


def with_metadata(hits: DataFrame, *sources: DataFrame) -> DataFrame:
    """``hits`` with metadata columns by ``doc_id``: later sources override what earlier ones have; missing is null."""
    names = list(dict.fromkeys(c for s in sources for c in s.columns if c != "doc_id"))
    parts = [hits.withColumn("_hit", F.lit(True))]
    for k, s in enumerate(sources):
        parts.append(s.select(F.col("doc_id").cast("string").alias("doc_id"), *(F.col(c).alias(f"_{k}_{c}") for c in s.columns if c != "doc_id")))
    joined = reduce(lambda a, b: a.join(b, "doc_id", "left"), parts)
    value = lambda c: F.coalesce(*(F.col(f"_{k}_{c}") for k in reversed(range(len(sources))) if c in sources[k].columns)).alias(c)
    return joined.select(*hits.columns, *(value(c) for c in names if c not in hits.columns))


def first_text(*sources: DataFrame) -> DataFrame:
    """``doc_id, text`` of the first source that has the id, under its own name or with ``__`` as ``_``."""
    union = reduce(lambda a, b: a.unionAll(b), [s.select(F.replace(F.col("doc_id").cast("string"), F.lit("__"), F.lit("_")).alias("doc_id"), "text", F.lit(k).alias("_k")) for k, s in enumerate(sources)])
    return union.groupBy("doc_id").agg(F.min_by("text", "_k").alias("text"))


def filled_clusters(hits: DataFrame, min_count: int = 0) -> DataFrame:
    """Nested clusters: ``cluster_id, length, hits, skips`` of those with more than ``min_count`` passages.

    ``hits``: the rows of ``fill_text`` with ``cluster_id``. ``length`` is the mean text length of the decoded passages,
    truncated, null without one; ``skips`` names the others. A nested row holds its whole cluster; use the flat rows
    for clusters beyond a task's memory.
    """
    node = node_string(F.col("doc_id"), F.col("s"), F.col("e"))
    meta = [c for c in hits.columns if c not in ("cluster_id", "doc_id", "s", "e", "text", "i0", "i1")]
    hit = F.struct(*meta, "text", node.alias("node"), "doc_id", F.array("i0", "i1").alias("original_indices"), F.array(F.col("s").cast("string"), F.col("e").cast("string")).alias("encoded_indices"))
    good = F.col("text").isNotNull()
    out = hits.groupBy("cluster_id").agg(
        F.floor(F.avg(F.when(good, F.length("text")))).cast("int").alias("length"),
        F.collect_list(F.when(good, hit)).alias("hits"),
        F.collect_list(F.when(~good, node)).alias("skips"),
    )
    return out.where(F.size("hits") + F.size("skips") > min_count)


def unique_hits(hits: DataFrame) -> DataFrame:
    """Delivered hits, each ``hit_id`` once: the row written last."""
    return latest(hits, "hit_id", F.col("written_at"))


def cluster_sizes(hits: DataFrame, min_count: int = 0, max_count: int | None = None) -> DataFrame:
    """``cluster_id, hits, length`` of clusters with more than ``min_count`` (and at most ``max_count``) hits."""
    sizes = hits.where("cluster_id is not null").groupBy("cluster_id").agg(F.count("*").alias("hits"), F.floor(F.avg(F.length("text"))).cast("int").alias("length"))
    sizes = sizes.where(F.col("hits") > min_count)
    return sizes.where(F.col("hits") <= max_count) if max_count is not None else sizes
