"""The queries of the core, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import alphabet, nodes
from quire.operators import align, blocks, clusters, combine, fill, graph, hsp, intervals, separate
from quire.operators import nodes as merging
from quire.plans.pipeline import ReuseConfig, TextReuse
from quire.session import Scratch, table
from quire.sources import readers, writers
from quire.streaming import incremental

BLOCK, KMER, SHARED_KMER, LEAST_RUN = 500, 20, 30, 50
#: What the documentation of the original runs advises as the expected number of chance hits of a whole run.
CHANCE = 1e-15
BOUNDS = {"min_length": 100, "max_length": 700, "min_score": 0.8, "ranges": "0,0.85,300;300,0.9,600"}


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").withColumn("doc_id", F.col("doc_id").cast("string"))


def _encoded(spark: SparkSession, sf: str, name: str = "eng") -> DataFrame:
    return blocks.encoded_blocks(blocks.split_blocks(_docs(spark, sf)), name).select("doc_id", "enc")


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    return fill.unique_hits(table(spark, sf, "cluster_hits"))


def _unfilled(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "clusters_unfilled").select("cluster_id", F.explode("nodes").alias("n"))
    return rows.select("cluster_id", "n.doc_id", "n.s", "n.e").where("cluster_id is not null and doc_id is not null and s is not null and e is not null")


def _hit_nodes(spark: SparkSession, sf: str) -> DataFrame:
    own = _hits(spark, sf).select("cluster_id", "hit_id", nodes.parse_node(F.col("node")).alias("n"))
    return own.select("cluster_id", "n.doc_id", "n.s", "n.e", "hit_id").where("cluster_id is not null and doc_id is not null and s is not null and e is not null")


def doc_scan_nonempty(spark: SparkSession, sf: str) -> DataFrame:
    return blocks.nonempty(_docs(spark, sf)).select("doc_id", F.length("text").cast("long").alias("chars"))


def doc_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return blocks.with_metadata(_docs(spark, sf)).select("doc_id", "meta")


def source_text_counts(spark: SparkSession, sf: str) -> DataFrame:
    return blocks.source_counts(_docs(spark, sf))


def split_blocks(spark: SparkSession, sf: str) -> DataFrame:
    cut = blocks.split_blocks(_docs(spark, sf), BLOCK)
    return cut.select("block_id", "doc_id", F.col("block_start").cast("long").alias("block_start"), F.col("block_end").cast("long").alias("block_end"), F.md5("text").alias("text_md5"))


def _encode(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _encoded(spark, sf, name).select("doc_id", F.length("enc").cast("long").alias("letters"), F.md5("enc").alias("enc_md5"))

    return query


def encode_mask(spark: SparkSession, sf: str) -> DataFrame:
    return blocks.nonempty(_docs(spark, sf)).select("doc_id", F.md5(alphabet.mask(F.col("text"))).alias("mask_md5"))


def decode_reverse(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(spark, sf).select("doc_id", F.md5(alphabet.unencode(F.col("enc"))).alias("text_md5"))


def preprocess(spark: SparkSession, sf: str) -> DataFrame:
    return blocks.nonempty(_docs(spark, sf)).select("doc_id", F.md5(alphabet.normalised(F.col("text"))).alias("text_md5"))


def gi_numbering(spark: SparkSession, sf: str) -> DataFrame:
    return blocks.numbered(blocks.encoded_blocks(blocks.split_blocks(_docs(spark, sf))).select("block_id"), "block_id")


def kmer_df(spark: SparkSession, sf: str) -> DataFrame:
    return align.kmer_documents(_encoded(spark, sf), KMER)


def shared_kmer_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return align.shared_kmers(_encoded(spark, sf), SHARED_KMER)


def class_members(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's representative in the results of the queries on classes of equal codes."""
    return align.classes(_encoded(spark, sf)).select("doc_id", "rep")


def maximal_exact_runs(spark: SparkSession, sf: str) -> DataFrame:
    one = align.classes(_encoded(spark, sf)).where("doc_id = rep").select("doc_id", "enc")
    return align.exact_runs(one, LEAST_RUN)


def gapped_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return TextReuse(ReuseConfig(alphabet="eng")).alignments(_encoded(spark, sf))


def hsp_filters(spark: SparkSession, sf: str) -> DataFrame:
    return hsp.filter_hsp(table(spark, sf, "hsp"), **BOUNDS)


def hsp_passages(spark: SparkSession, sf: str) -> DataFrame:
    return hsp.passages(table(spark, sf, "hsp")).groupBy("doc_id", "s", "e").agg(F.count("*").alias("n"))


def node_merge_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return merging.mergeable_pairs(hsp.passages(table(spark, sf, "hsp")))


def node_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return merging.centroids(hsp.passages(hsp.filter_hsp(table(spark, sf, "hsp"))))


def _edge_names(spark: SparkSession, sf: str) -> DataFrame:
    name = lambda x: nodes.node_string(F.col(f"{x}.doc_id"), F.col(f"{x}.s"), F.col(f"{x}.e")).alias(x)
    return table(spark, sf, "edges").select(name("src"), name("dst"))


def connected_components(spark: SparkSession, sf: str) -> DataFrame:
    return graph.connected_components(_edge_names(spark, sf))


def component_numbers(spark: SparkSession, sf: str) -> DataFrame:
    parts = connected_components(spark, sf)
    ids = blocks.numbered(parts.select("component").distinct(), "component", "n")
    return parts.join(ids, "component").select("node", F.concat(F.lit("cluster_"), (F.col("n") - 1).cast("string")).alias("cluster_id"))


def cluster_deoverlap(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.without_overlaps(_unfilled(spark, sf).withColumnRenamed("cluster_id", "cluster")).withColumnRenamed("cluster", "cluster_id")


def cluster_average_length(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.average_length(_unfilled(spark, sf).withColumnRenamed("cluster_id", "cluster")).withColumnRenamed("cluster", "cluster_id")


def clusters_from_hsp(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.clusters_of(hsp.filter_hsp(table(spark, sf, "hsp")))


def clusters_in_rounds(spark: SparkSession, sf: str) -> DataFrame:
    found = hsp.filter_hsp(table(spark, sf, "hsp"))
    slices = blocks.numbered(found.select("q_id").distinct(), "q_id")
    return clusters.clusters_in_rounds(found, slices, per_slice=500)


def fill_text_spans(spark: SparkSession, sf: str) -> DataFrame:
    edges = table(spark, sf, "edges")
    own = edges.select("src.*").unionAll(edges.select("dst.*")).where("doc_id is not null and s is not null and e is not null").distinct()
    filled = fill.fill_text(own, _docs(spark, sf))
    known = lambda c, v: F.coalesce(F.col(c), F.lit(v)).alias(c)
    return filled.withColumn("text_md5", F.md5("text")).select("doc_id", "s", "e", known("text_md5", ""), known("i0", -1), known("i1", -1))


def alignment_texts(spark: SparkSession, sf: str) -> DataFrame:
    return fill.alignment_texts(table(spark, sf, "hsp"), _docs(spark, sf))


def cluster_metadata_join(spark: SparkSession, sf: str) -> DataFrame:
    own = _hits(spark, sf).select("hit_id", "doc_id")
    return fill.with_metadata(own, _docs(spark, sf).select("doc_id", "title", "source", "lang"))


def cluster_size_filter(spark: SparkSession, sf: str) -> DataFrame:
    return fill.cluster_sizes(_hits(spark, sf), 3)


def _nested(spark: SparkSession, sf: str) -> DataFrame:
    filled = fill.with_metadata(fill.fill_text(_unfilled(spark, sf), _docs(spark, sf)), _docs(spark, sf).select("doc_id", "title", "issue_date"))
    return fill.filled_clusters(filled)


def filled_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Nested clusters, their hits and skips in an order of their own as one digest each."""
    at = lambda h, k: h["original_indices"][k].cast("string")
    hit = lambda h: F.concat_ws("|", h["node"], at(h, 0), at(h, 1), F.coalesce(h["title"], F.lit("")), F.coalesce(h["issue_date"], F.lit("")), h["text"])
    digest = lambda x: F.md5(F.array_join(F.array_sort(x), "\n"))
    size = lambda c: F.size(c).cast("long")
    return _nested(spark, sf).select("cluster_id", "length", size("hits").alias("n_hits"), size("skips").alias("n_skips"), digest(F.transform("hits", hit)).alias("hits_md5"), digest(F.col("skips")).alias("skips_md5"))


def interval_links(spark: SparkSession, sf: str) -> DataFrame:
    return combine.interval_links(_hit_nodes(spark, sf), _unfilled(spark, sf))


def link_choice(spark: SparkSession, sf: str) -> DataFrame:
    return combine.chosen_links(table(spark, sf, "links"))


def _new_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """The filled clusters as a later run would name them."""
    return _hit_nodes(spark, sf).withColumn("cluster_id", F.regexp_replace("cluster_id", "^cluster_", "new_")).select("cluster_id", "doc_id", "s", "e")


def unlinked_new(spark: SparkSession, sf: str) -> DataFrame:
    return combine.unlinked(_new_clusters(spark, sf).select("cluster_id").distinct(), table(spark, sf, "links"), "later")


def combined_hits(spark: SparkSession, sf: str) -> DataFrame:
    return combine.combine(_unfilled(spark, sf), _new_clusters(spark, sf), table(spark, sf, "links"), "later")


def levenshtein_pairs(spark: SparkSession, sf: str) -> DataFrame:
    hits = _hits(spark, sf).where("text is not null").select("hit_id", "cluster_id", F.length("text").alias("size"), alphabet.encode(F.col("text")).alias("enc"))
    own = Scratch(spark, "pairs").cut(hits.where("cluster_id is not null and enc <> ''"))
    return separate.levenshtein_similar(own).withColumn("distance", F.col("distance").cast("long"))


def separation_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return separate.candidates(_hits(spark, sf), 3, 20).select("cluster_id", "hit_id")


def separation_by_edits(spark: SparkSession, sf: str) -> DataFrame:
    return separate.separate_by_edits(_hits(spark, sf), min_count=5)


def separation(spark: SparkSession, sf: str) -> DataFrame:
    return separate.separated_all(_hits(spark, sf), min_count=5)


def unique_hits(spark: SparkSession, sf: str) -> DataFrame:
    return _hits(spark, sf).select("hit_id", "cluster_id", "doc_id", "node", "written_at")


def reuse_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to filled clusters."""
    docs = _docs(spark, sf).select("doc_id", "text", "title", "issue_date", "lang", "source")
    hits = TextReuse(ReuseConfig(alphabet="eng", e_value=CHANCE, min_length=50)).run(docs)["hits"]
    return hits.select("cluster_id", "doc_id", "s", "e", "text", "i0", "i1", "title", "issue_date", "lang", "source")


def _files(spark: SparkSession) -> str:
    """A folder of its own for what a query writes and reads back."""
    return Scratch(spark, "files").root


def documents_read(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as JSON lines and read back."""
    writers.write_json(_docs(spark, sf).select("doc_id", "text", "title"), path := _files(spark))
    return readers.read_documents(spark, path).select("doc_id", F.md5("text").alias("text_md5"), "title")


def sources_read(spark: SparkSession, sf: str) -> DataFrame:
    writers.write_json(_docs(spark, sf).select("doc_id", "text"), path := _files(spark))
    return readers.read_sources(spark, f"{path};first;{path};second").select("source", "doc_id", F.md5("text").alias("text_md5"))


def latest_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """The hit of each passage that was written last."""
    hits = table(spark, sf, "cluster_hits").select(F.col("node").alias("doc_id"), "hit_id", "written_at")
    return blocks.last_wins(hits, F.struct("written_at", "hit_id")).select(F.col("doc_id").alias("node"), "hit_id")


def text_count(spark: SparkSession, sf: str) -> DataFrame:
    return blocks.nonempty(_docs(spark, sf)).agg(F.count("*").alias("n_texts"))


def ascii_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", nodes.ascii_id(F.col("title")).alias("ascii_title"))


def old_node_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of an older form, made of language, source and node."""
    name = F.concat_ws("_", F.coalesce("lang", F.lit("und")), F.lit("x"), "node")
    return _hits(spark, sf).where("node is not null").select("hit_id", nodes.old_form(name).alias("node_id"))


def custom_alphabet(spark: SparkSession, sf: str) -> DataFrame:
    """An alphabet of vowels, as a user would add it."""
    alphabet.register_alphabet("vowels", "aeiou", "AEIHY")
    return _encoded(spark, sf, "vowels").select("doc_id", F.md5("enc").alias("enc_md5"))


def soft_mask(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(spark, sf, "eng_space").select("doc_id", F.md5(alphabet.soft_masked(F.col("enc"))).alias("enc_md5"))


def block_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    """Alignments with the coordinates of blocks, as documents' coordinates again."""
    start = lambda x: F.expr(f"{x}_start div {BLOCK} * {BLOCK}")
    name = lambda x: F.concat(f"{x}_id", F.lit("__"), start(x).cast("string"), F.lit("_"), (start(x) + BLOCK).cast("string"))
    own = table(spark, sf, "hsp").select(*(name(x).alias(f"{x}_id") for x in "qh"), *((F.col(f"{x}_{y}") - start(x)).cast("int").alias(f"{x}_{y}") for x in "qh" for y in ("start", "end")), "length", "ppos")
    return hsp.flatten_blocks(own)


def report_files(spark: SparkSession, sf: str) -> DataFrame:
    """Alignments written as tabular reports and read back."""
    writers.write_reports(table(spark, sf, "hsp"), path := _files(spark))
    return readers.read_alignments(spark, path)


def fasta_lines(spark: SparkSession, sf: str) -> DataFrame:
    own = blocks.numbered(blocks.encoded_blocks(blocks.split_blocks(_docs(spark, sf))).select("block_id", "enc"), "block_id")
    writers.write_fasta(own, path := _files(spark))
    return spark.read.text(path).select(F.md5("value").alias("line_md5"))


def unfilled_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return writers.unfilled(_unfilled(spark, sf)).select("cluster_id", F.array_join("nodes", ",").alias("nodes"), "avg_len")


def cluster_files(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters written as files of the list form and read back."""
    writers.write_unfilled(_unfilled(spark, sf), path := _files(spark), 100)
    return readers.read_clusters(spark, path)


def filled_files(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters written as files of the filled form and read back, without the passages that were skipped."""
    writers.write_filled(_nested(spark, sf), path := _files(spark), 100)
    return readers.read_clusters(spark, path).where("node is not null")


def merged_files(spark: SparkSession, sf: str) -> DataFrame:
    """Old clusters and, under a prefix, those that were new, in files of their own."""
    fresh = F.col("cluster_id").rlike("[05]$")
    own = _nested(spark, sf).withColumn("cluster_id", F.when(fresh, F.concat(F.lit("later_"), "cluster_id")).otherwise(F.col("cluster_id")))
    writers.write_merged(own, path := _files(spark), "later", 100)
    part = lambda x: readers.read_clusters(spark, f"{path}/{x}").select(F.lit(x).alias("part"), "cluster_id", "node")
    return part("old").unionAll(part("later")).where("node is not null")


def link_files(spark: SparkSession, sf: str) -> DataFrame:
    writers.write_links(table(spark, sf, "links"), path := _files(spark))
    return readers.read_links(spark, path)


def not_done(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of the clusters when those of a short average length are done."""
    own = table(spark, sf, "clusters_unfilled").select("cluster_id", "avg_len")
    own.where("avg_len < 300").write.parquet(path := _files(spark))
    return writers.not_done(own, "cluster_id", spark, path)


def inspection(spark: SparkSession, sf: str) -> DataFrame:
    """Hits of clusters of 2 to 50 hits, the longest first."""
    own = _hits(spark, sf).where("cluster_id is not null").groupBy("cluster_id").agg(F.collect_list(F.struct(F.coalesce("text", F.lit("")).alias("text"))).alias("hits"))
    shown = writers.inspect(own, 2, 50).select("cluster_id", F.posexplode("hits").alias("place", "hit"))
    return shown.select("cluster_id", F.col("place").cast("long").alias("place"), F.length("hit.text").cast("long").alias("chars"))


def counted_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters by the kind of new data that they have counted hits of."""
    combine.HIT_TYPES["numbers"] = lambda node: node.rlike("^[0-9]")
    own = _hits(spark, sf)
    kinds = [combine.clusters_with(own, combine.counted(k, F.col("node"))).select(F.lit(k).alias("kind"), "cluster_id") for k in ("fin", "america", "numbers", "other")]
    return kinds[0].unionAll(kinds[1]).unionAll(kinds[2]).unionAll(kinds[3])


def search_exact_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Exact runs of the documents whose id is divisible by 20 against all, by their representatives."""
    all_ = align.classes(_encoded(spark, sf))
    asked = all_.where("cast(doc_id as long) % 20 = 0").select(F.col("rep").alias("doc_id"))
    return align.exact_runs(all_.where("doc_id = rep").select("doc_id", "enc"), LEAST_RUN, queries=asked)


def within_cluster_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Exact runs between the hits of one cluster."""
    own = _hits(spark, sf).where("cluster_id is not null").select(F.col("hit_id").alias("doc_id"), "cluster_id", alphabet.encode(F.col("text")).alias("enc"))
    return align.exact_runs(own, LEAST_RUN, within="cluster_id")


def edge_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """Alignments as edges between passages that are mapped to multiples of ten."""
    found = table(spark, sf, "hsp")
    ten = lambda c: F.expr(f"{c} div 10 * 10").cast("int")
    merged = hsp.passages(found).distinct().select("doc_id", "s", "e", ten("s").alias("cs"), ten("e").alias("ce"))
    name = lambda x: nodes.node_string(F.col(f"{x}.doc_id"), F.col(f"{x}.s"), F.col(f"{x}.e")).alias(x)
    return merging.centroid_edges(found, merged).select(name("src"), name("dst"))


def first_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of two sources whose ids differ in form, the first source before the second."""
    docs = blocks.nonempty(_docs(spark, sf))
    name = lambda mark: F.concat(F.substring("doc_id", 1, 3), F.lit(mark), F.expr("substring(doc_id, 4)")).alias("doc_id")
    first = docs.where("cast(doc_id as long) % 3 = 0").select(name("__"), F.lower("text").alias("text"))
    return fill.first_text(first, docs.select(name("_"), "text")).select("doc_id", F.md5("text").alias("text_md5"))


def whole_components(spark: SparkSession, sf: str) -> DataFrame:
    """Components as they are, by the strategy that keeps all passages."""
    edges = table(spark, sf, "edges").where("src.doc_id is not null and src.s is not null and src.e is not null and dst.doc_id is not null and dst.s is not null and dst.e is not null")
    return clusters.cluster_edges(edges, "whole")


def star_edges(spark: SparkSession, sf: str) -> DataFrame:
    name = lambda x: nodes.node_string(F.col(f"{x}.doc_id"), F.col(f"{x}.s"), F.col(f"{x}.e")).alias(x)
    return clusters.star_edges(_unfilled(spark, sf)).select(name("src"), name("dst"))


def node_index(spark: SparkSession, sf: str) -> DataFrame:
    return combine.node_index(_unfilled(spark, sf))


def merged_batch(spark: SparkSession, sf: str) -> DataFrame:
    """New clusters merged into the old ones that they overlap."""
    return incremental.merge_batch(_unfilled(spark, sf), _new_clusters(spark, sf), "later")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    found = intervals.periods_and_gaps(intervals.hit_spans(table(spark, sf, "cluster_hits")))
    return found.select(F.col("entity").alias("doc_id"), F.col("kind").alias("span_kind"), F.col("s").cast("int").alias("s"), F.col("e").cast("int").alias("e"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "doc_scan_nonempty": doc_scan_nonempty,
    "doc_metadata": doc_metadata,
    "source_text_counts": source_text_counts,
    "split_blocks": split_blocks,
    "encode_eng": _encode("eng"),
    "encode_fin": _encode("fin"),
    "encode_eng_space": _encode("eng_space"),
    "encode_mask": encode_mask,
    "decode_reverse": decode_reverse,
    "preprocess": preprocess,
    "gi_numbering": gi_numbering,
    "kmer_df": kmer_df,
    "shared_kmer_pairs": shared_kmer_pairs,
    "class_members": class_members,
    "maximal_exact_runs": maximal_exact_runs,
    "gapped_alignment": gapped_alignment,
    "hsp_filters": hsp_filters,
    "hsp_passages": hsp_passages,
    "node_merge_pairs": node_merge_pairs,
    "node_centroids": node_centroids,
    "connected_components": connected_components,
    "component_numbers": component_numbers,
    "cluster_deoverlap": cluster_deoverlap,
    "cluster_average_length": cluster_average_length,
    "clusters_from_hsp": clusters_from_hsp,
    "clusters_in_rounds": clusters_in_rounds,
    "unique_hits": unique_hits,
    "fill_text_spans": fill_text_spans,
    "alignment_texts": alignment_texts,
    "cluster_metadata_join": cluster_metadata_join,
    "cluster_size_filter": cluster_size_filter,
    "filled_clusters": filled_clusters,
    "interval_links": interval_links,
    "link_choice": link_choice,
    "unlinked_new": unlinked_new,
    "combined_hits": combined_hits,
    "levenshtein_pairs": levenshtein_pairs,
    "separation": separation,
    "separation_candidates": separation_candidates,
    "separation_by_edits": separation_by_edits,
    "documents_read": documents_read,
    "sources_read": sources_read,
    "latest_nodes": latest_nodes,
    "text_count": text_count,
    "ascii_ids": ascii_ids,
    "old_node_ids": old_node_ids,
    "custom_alphabet": custom_alphabet,
    "soft_mask": soft_mask,
    "block_coordinates": block_coordinates,
    "report_files": report_files,
    "fasta_lines": fasta_lines,
    "unfilled_clusters": unfilled_clusters,
    "cluster_files": cluster_files,
    "filled_files": filled_files,
    "merged_files": merged_files,
    "link_files": link_files,
    "not_done": not_done,
    "inspection": inspection,
    "counted_hits": counted_hits,
    "search_exact_runs": search_exact_runs,
    "within_cluster_runs": within_cluster_runs,
    "edge_mapping": edge_mapping,
    "first_texts": first_texts,
    "whole_components": whole_components,
    "star_edges": star_edges,
    "node_index": node_index,
    "merged_batch": merged_batch,
    "reuse_pipeline": reuse_pipeline,
    "p5_found": p5_found,
}
