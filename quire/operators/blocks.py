"""From documents to blocks with numbers: scanning, splitting, ids and metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.alphabet import encode
from quire.functions.nodes import ascii_id
from quire.operators.scan import running_sum


def nonempty(docs: DataFrame) -> DataFrame:
    """Documents with a text; null counts as empty."""
    return docs.where("text <> ''")


def latest(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per ``key``, the last by ``order`` (nulls first); a null key is dropped.

    ``order`` should be unique per key for a defined result. A maximum, combined before the shuffle: no key's rows are
    gathered or sorted.
    """
    last = F.max_by(F.struct(*rows.columns), F.struct(order.isNotNull(), order))
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(last.alias("_last")).select("_last.*")


def last_wins(docs: DataFrame, order: Column) -> DataFrame:
    """One row per ``doc_id``, the last by ``order``; a document without id is dropped."""
    return latest(docs, "doc_id", order)


def with_metadata(docs: DataFrame, core: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``doc_id, text, meta``: everything but the core as one JSON object; null fields are left out."""
    others = [c for c in docs.columns if c not in core]
    meta = F.to_json(F.struct(*others)) if others else F.lit("{}")
    return docs.select(*core, meta.alias("meta"))


def split_blocks(docs: DataFrame, size: int = 0) -> DataFrame:
    """Blocks of ``size`` characters: ``block_id, doc_id, block_start, block_end, text``.

    With ``size <= 0`` each document is one block under its own id. A block is named ``{doc}__{start}_{start + size}``
    even where it ends earlier; ``block_end`` is its true end. Empty and null texts give no block.
    """
    doc = ascii_id(F.col("doc_id"))
    docs = nonempty(docs)
    if size <= 0:
        return docs.select(doc.alias("block_id"), doc.alias("doc_id"), F.lit(0).alias("block_start"), F.length("text").alias("block_end"), "text")
    cut = docs.select(doc.alias("doc_id"), "text", F.explode(F.sequence(F.lit(0), F.length("text") - 1, F.lit(size))).alias("block_start"))
    end = F.col("block_start") + size
    name = F.concat("doc_id", F.lit("__"), F.col("block_start").cast("string"), F.lit("_"), end.cast("string"))
    return cut.select(name.alias("block_id"), "doc_id", "block_start", F.least(end, F.length("text")).alias("block_end"), F.substring("text", F.col("block_start") + 1, F.lit(size)).alias("text"))


def encoded_blocks(blocks: DataFrame, alphabet: str = "eng") -> DataFrame:
    """``block_id, doc_id, block_start, enc`` of the blocks that keep at least one letter."""
    return blocks.select("block_id", "doc_id", "block_start", encode(F.col("text"), alphabet).alias("enc")).where("enc <> ''")


def numbered(df: DataFrame, by: str, to: str = "gi") -> DataFrame:
    """``df`` with 1-based ordinals by the bytewise order of column ``by`` (unique and not null).

    The order is global, but no single task sorts all rows: partitions are ranges, and their counts are carried.
    """
    ones = df.withColumn("_all", F.lit(0)).withColumn("_one", F.lit(1).cast("long"))
    return running_sum(ones, "_all", by, "_one", "_before").select(*df.columns, (F.col("_before") + 1).alias(to))


def union_sources(named: dict[str, DataFrame]) -> DataFrame:
    """Documents of several sources in one table with a column ``source``; missing columns become null."""
    out = None
    for name, docs in named.items():
        one = docs.drop("source").withColumn("source", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError("no source given")
    return out


def source_counts(docs: DataFrame) -> DataFrame:
    """Texts per source; a null source is one of its own."""
    return nonempty(docs).groupBy("source").agg(F.count("*").alias("n_texts"))
