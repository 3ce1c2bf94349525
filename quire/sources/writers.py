"""Writers: sequences, clusters, links, and outputs that can be resumed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.nodes import natural_key, node_string
from quire.operators.blocks import numbered


def write_fasta(encoded: DataFrame, path: str) -> None:
    """Numbered encoded texts as ``>gi|{n} {id}`` and sequence lines, in order of ``gi``."""
    lines = F.concat(F.lit(">gi|"), F.col("gi").cast("string"), F.lit(" "), F.col("block_id"), F.lit("\n"), F.col("enc"))
    encoded.repartitionByRange("gi").sortWithinPartitions("gi").select(lines.alias("value")).write.mode("overwrite").text(path)


def unfilled(kept: DataFrame) -> DataFrame:
    """``cluster_id, nodes, avg_len`` with the node strings in natural order."""
    node = node_string(F.col("doc_id"), F.col("s"), F.col("e"))
    order = F.struct(natural_key(F.col("doc_id").cast("string")).alias("k"), F.col("s").alias("s"), F.col("e").alias("e"), node.alias("node"))
    return kept.groupBy("cluster_id").agg(
        F.transform(F.array_sort(F.collect_list(order)), lambda x: x["node"]).alias("nodes"),
        F.floor(F.sum(F.col("e") - F.col("s")) / F.count("*")).cast("int").alias("avg_len"),
    )


def write_json(df: DataFrame, path: str, per_file: int = 1000) -> None:
    """JSON lines, gzip, at most ``per_file`` rows a file; nothing is written for no rows but the folder."""
    df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", per_file).json(path)


def write_maps(entries: DataFrame, path: str, per_file: int = 1000) -> None:
    """``key`` and JSON ``body`` as gzip files of one JSON object each, ``per_file`` keys in every file but the last.

    Keys go to files in their bytewise order. One task holds the bodies of one file. No rows give an empty folder.
    """
    filed = numbered(entries.select("key", "body"), "key", "n").withColumn("n", F.floor((F.col("n") - 1) / per_file))
    pair = F.concat(F.to_json(F.array("key")).substr(F.lit(2), F.length(F.to_json(F.array("key"))) - 2), F.lit(":"), "body")
    files = filed.groupBy("n").agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(pair)), ","), F.lit("}")).alias("value"))
    files.select("value").write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)


def write_unfilled(kept: DataFrame, path: str, per_file: int = 1000) -> None:
    """Clusters in the list form ``{cluster: [[nodes], length]}`` that ``read_clusters`` reads."""
    body = F.concat(F.lit("["), F.to_json("nodes"), F.lit(","), F.col("avg_len").cast("string"), F.lit("]"))
    write_maps(unfilled(kept).select(F.col("cluster_id").alias("key"), body.alias("body")), path, per_file)


def write_filled(nested: DataFrame, path: str, per_file: int = 1000) -> None:
    """Clusters in the filled form ``{cluster: {length, hits, skips}}``; ``nested``: the rows of ``filled_clusters``."""
    body = F.to_json(F.struct(*(c for c in nested.columns if c != "cluster_id")))
    write_maps(nested.where("cluster_id is not null").select(F.col("cluster_id").alias("key"), body.alias("body")), path, per_file)


def write_merged(nested: DataFrame, path: str, prefix: str, per_file: int = 1000, per_new_file: int = 10_000) -> None:
    """Merged clusters in the filled form below ``path/old``, those named ``{prefix}_...`` below ``path/{prefix}``."""
    fresh = F.startswith("cluster_id", F.lit(f"{prefix}_"))
    write_filled(nested.where(~fresh), f"{path}/old", per_file)
    write_filled(nested.where(fresh), f"{path}/{prefix}", per_new_file)


def write_links(links: DataFrame, path: str, per_file: int = 100_000) -> None:
    """Links as ``{new cluster: [old clusters]}``, the form that ``read_links`` reads; links with a null are dropped."""
    lists = links.where("new_cluster is not null and old_cluster is not null").groupBy("new_cluster").agg(F.to_json(F.sort_array(F.collect_list("old_cluster"))).alias("body"))
    write_maps(lists.withColumnRenamed("new_cluster", "key"), path, per_file)


def write_reports(hsp: DataFrame, path: str, per_file: int = 1000) -> None:
    """Alignments as ``{query: tabular report}``, the form that ``read_alignments`` reads; rows with a null are dropped."""
    cells = ["h_id", "q_start", "q_end", "h_start", "h_end", "length", "ppos"]
    rows = hsp.dropna(subset=["q_id", *cells]).select("q_id", F.concat_ws("\t", *(F.col(c).cast("string") for c in cells)).alias("row"))
    reports = rows.groupBy("q_id").agg(F.array_join(F.sort_array(F.collect_list("row")), "\n").alias("report"))
    text = F.to_json(F.array("report"))
    write_maps(reports.select(F.col("q_id").alias("key"), text.substr(F.lit(2), F.length(text) - 2).alias("body")), path, per_file)


def not_done(df: DataFrame, key: str, spark: SparkSession, path: str) -> DataFrame:
    """Rows whose ``key`` a Parquet output doesn't have yet; all rows where there is no output."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return df
    return df.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")


def inspect(clusters: DataFrame, min_count: int = 0, max_count: int = 1_000_000) -> DataFrame:
    """Nested clusters within the size bounds with their hits by text length, the longest first."""
    sized = clusters.where(F.size("hits").between(min_count, max_count))
    longest = lambda a, b: F.length(b["text"]) - F.length(a["text"])
    return sized.withColumn("hits", F.array_sort("hits", longest))
