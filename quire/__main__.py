"""Command line: ``python -m quire STAGE ...``. Stages read and write Parquet tables below one output folder.

``run`` goes all the way; ``prepare``, ``prepare-sources``, ``align``, ``cluster`` and ``fill`` are its steps. ``separate``,
``combine``, ``examine`` and ``show`` work on what these left. Master and memory come from ``spark-submit`` or the
Spark configuration.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.nodes import parse_node
from quire.operators import align, blocks, clusters, combine, fill, hsp, separate
from quire.plans.pipeline import ReuseConfig, TextReuse, block_offsets
from quire.session import ship
from quire.sources import readers, writers


def _options(parser: argparse.ArgumentParser, names: str) -> None:
    """Options by name, each with the default of ``DEFAULTS``; a default of None makes it required."""
    for name in names.split():
        default = DEFAULTS[name]
        kind = {"default": default, "type": type(default)} if default is not None else {"required": True}
        parser.add_argument(f"--{name}", **kind)


DEFAULTS: dict[str, object] = {
    "data_folder": None, "data_folders": None, "output_folder": None, "language": "fin", "split_size": 0, "e_value": 0.001, "word_size": 6, "seed": 12, "reach": 8,
    "min_length": 0, "max_length": 100_000, "min_align_score": 0.0, "alignment_ranges": "", "node_similarity": 0.9, "strategy": "deoverlap", "files_per_iter": 0,
    "clusters_per_file": 1000, "min_count": 0, "max_count": 1_000_000, "max_distance": 0.75, "new_cluster_prefix": "new", "type": "america", "old_folder": None,
    "new_folder": None, "save_folder": None, "iter": -1, "qpi": 0, "alignments": "", "node": None, "mode": "compat",
}


def _put(df: DataFrame, folder: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/{name}")


def _get(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def _prepared(spark: SparkSession, docs: DataFrame, a: argparse.Namespace) -> None:
    _put(docs, a.output_folder, "documents")
    cut = blocks.encoded_blocks(blocks.split_blocks(docs, a.split_size), a.language)
    _put(blocks.numbered(cut, "block_id"), a.output_folder, "encoded")


def prepare(spark: SparkSession, a: argparse.Namespace) -> None:
    """Documents to numbered encoded texts."""
    _prepared(spark, readers.read_documents(spark, a.data_folder), a)


def prepare_sources(spark: SparkSession, a: argparse.Namespace) -> None:
    """The same for several sources, ``path;name;path;name``."""
    _prepared(spark, readers.read_sources(spark, a.data_folders), a)


def align_texts(spark: SparkSession, a: argparse.Namespace) -> None:
    """Encoded texts to alignments; with ``--iter`` and ``--qpi`` those of one slice of the queries with all texts."""
    own = _get(spark, a.output_folder, "encoded")
    asked = own.where(F.floor((F.col("gi") - 1) / a.qpi) == a.iter).select(F.col("block_id").alias("doc_id")) if a.qpi > 0 else None
    found = align.local_alignments(own.select(F.col("block_id").alias("doc_id"), "enc"), a.word_size, a.seed, a.reach, a.e_value, queries=asked)
    _put(found, a.output_folder, f"alignments/iter={max(a.iter, 0)}")


def cluster(spark: SparkSession, a: argparse.Namespace) -> None:
    """Alignments, own ones or reports of ``--alignments``, to clusters; with ``--files_per_iter`` in rounds of so many queries."""
    found = readers.read_alignments(spark, a.alignments) if a.alignments else _get(spark, a.output_folder, "alignments").drop("iter").dropDuplicates(["q_id", "h_id", "q_start", "q_end", "h_start", "h_end"])
    own = _get(spark, a.output_folder, "encoded")
    found = hsp.filter_hsp(found, min_length=a.min_length, max_length=a.max_length, min_score=a.min_align_score, ranges=a.alignment_ranges or None)
    slices = own.select(F.col("block_id").alias("q_id"), "gi")
    kept = clusters.clusters_in_rounds(found, slices, a.files_per_iter, a.node_similarity) if a.files_per_iter else clusters.clusters_of(found, a.node_similarity, a.strategy)
    at = kept.withColumnRenamed("doc_id", "block_id").join(block_offsets(own), "block_id")
    kept = at.select("cluster_id", "doc_id", *((F.col(x) + F.col("before")).cast("int").alias(x) for x in "se"))
    _put(kept, a.output_folder, "clusters")
    writers.write_unfilled(_get(spark, a.output_folder, "clusters"), f"{a.output_folder}/unfilled", a.clusters_per_file)


def fill_clusters(spark: SparkSession, a: argparse.Namespace) -> None:
    """Clusters with text and metadata, as the table ``hits`` and as files ``filled``."""
    docs = _get(spark, a.output_folder, "documents")
    rows = fill.with_metadata(fill.fill_text(_get(spark, a.output_folder, "clusters"), docs, a.language, a.mode), docs.drop("text"))
    _put(rows, a.output_folder, "hits")
    writers.write_filled(fill.filled_clusters(_get(spark, a.output_folder, "hits"), a.min_count), f"{a.output_folder}/filled", a.clusters_per_file)


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    """Documents to filled clusters; texts of equal codes are aligned once."""
    c = ReuseConfig(a.language, a.word_size, a.seed, a.reach, a.e_value, a.min_length, a.max_length, a.min_align_score, a.alignment_ranges or None, a.node_similarity, a.min_count, a.mode, a.split_size, a.strategy)
    found = TextReuse(c).run(readers.read_documents(spark, a.data_folder))
    _put(found["hits"], a.output_folder, "hits")
    rows = _get(spark, a.output_folder, "hits")
    writers.write_unfilled(rows, f"{a.output_folder}/unfilled", a.clusters_per_file)
    writers.write_filled(fill.filled_clusters(rows, a.min_count), f"{a.output_folder}/filled", a.clusters_per_file)


def _numbered_hits(spark: SparkSession, folder: str) -> DataFrame:
    rows = _get(spark, folder, "hits").withColumn("node", F.concat_ws("___", "cluster_id", "doc_id", F.concat_ws("_", "s", "e")))
    return blocks.numbered(rows, "node", "hit_id").drop("node")


def separate_clusters(spark: SparkSession, a: argparse.Namespace) -> None:
    """Clusters of ``--min_count`` to ``--max_count`` hits cut into those whose hits belong together; clusters done before stay."""
    rows = _numbered_hits(spark, a.output_folder)
    todo = writers.not_done(rows, "cluster_id", spark, f"{a.save_folder}/separated")
    found = separate.separated_all(todo, a.language, a.max_distance, a.min_count or separate.MIN_COUNT, min(a.max_count, separate.MAX_COUNT))
    new = rows.withColumnRenamed("cluster_id", "old").join(found.select("hit_id", F.col("cluster_id").alias("name"), "length"), "hit_id")
    new.select(F.col("old").alias("cluster_id"), "name", "length", *(c for c in rows.columns if c not in ("cluster_id", "length"))).write.mode("append").parquet(f"{a.save_folder}/separated")


def combine_clusters(spark: SparkSession, a: argparse.Namespace) -> None:
    """New clusters into the old ones that they overlap: links, merged hits and files."""
    old, new = _get(spark, a.old_folder, "hits"), _get(spark, a.new_folder, "hits")
    columns = [c for c in old.columns if c in new.columns]
    old, new = old.select(columns), new.select(columns)
    _put(combine.interval_links(new, old), a.save_folder, "links")
    links = _get(spark, a.save_folder, "links")
    node = F.concat_ws("___", "doc_id", F.concat_ws("_", "s", "e"))
    _put(combine.combine(old, new, links, a.new_cluster_prefix, combine.counted(a.type, node)), a.save_folder, "hits")
    writers.write_links(links, f"{a.save_folder}/link_files")
    writers.write_merged(fill.filled_clusters(_get(spark, a.save_folder, "hits").drop("origin")), f"{a.save_folder}/filled", a.new_cluster_prefix)


def examine(spark: SparkSession, a: argparse.Namespace) -> None:
    """Print the clusters within the size bounds, their hits by text length."""
    shown = writers.inspect(fill.filled_clusters(_get(spark, a.output_folder, "hits")), a.min_count, a.max_count)
    for row in shown.orderBy("cluster_id").toLocalIterator():  # one cluster after another
        print(f"\n{row.cluster_id}: {len(row.hits)} hits, mean length {row.length}")
        for hit in row.hits:
            print(f"  {hit.node}: {hit.text}")


def show(spark: SparkSession, a: argparse.Namespace) -> None:
    """Print the text behind one passage, ``{doc}___{start}_{end}``."""
    node = spark.range(1).select(parse_node(F.lit(a.node)).alias("n")).select("n.*")
    for row in fill.fill_text(node, _get(spark, a.output_folder, "documents"), a.language, a.mode).collect():
        print(row.doc_id, row.s, row.e, row.i0, row.i1, row.text, sep="\t")


ALIGN, CLUSTER = "e_value word_size seed reach", "min_length max_length min_align_score alignment_ranges node_similarity strategy clusters_per_file"
STAGES: dict[str, tuple[Callable[[SparkSession, argparse.Namespace], None], str]] = {
    "run": (run, f"data_folder output_folder language split_size mode min_count {ALIGN} {CLUSTER}"),
    "prepare": (prepare, "data_folder output_folder language split_size"),
    "prepare-sources": (prepare_sources, "data_folders output_folder language split_size"),
    "align": (align_texts, f"output_folder iter qpi {ALIGN}"),
    "cluster": (cluster, f"output_folder alignments files_per_iter {CLUSTER}"),
    "fill": (fill_clusters, "output_folder language mode min_count clusters_per_file"),
    "separate": (separate_clusters, "output_folder save_folder language min_count max_count max_distance"),
    "combine": (combine_clusters, "old_folder new_folder save_folder new_cluster_prefix type"),
    "examine": (examine, "output_folder min_count max_count"),
    "show": (show, "output_folder node language mode"),
}


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quire", description="Reused passages in large document collections.")
    stages = parser.add_subparsers(dest="stage", required=True)
    for name, (f, options) in STAGES.items():
        _options(stages.add_parser(name, help=(f.__doc__ or "").split("\n")[0]), options)
    a = parser.parse_args(arguments)
    spark = spark or SparkSession.builder.appName("quire").getOrCreate()
    ship(spark)
    STAGES[a.stage][0](spark, a)


if __name__ == "__main__":
    main()
