"""Readers: documents as JSON lines or Parquet, alignment tables, clusters and links."""

from __future__ import annotations

import gzip
import io
import json
import re
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.blocks import union_sources

#: The comment of a report that names the query behind its number.
_QUERY = re.compile(r"#\sQuery:\s\S+\s(?P<name>.*?)\s*\Z", re.DOTALL)
HSP = "q_id string, h_id string, q_start int, q_end int, h_start int, h_end int, length int, ppos double"


def read_documents(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Documents of a file or folder: JSON lines (also gzip) or Parquet; blank lines and empty texts are dropped.

    ``doc_id`` becomes a string; all other fields are kept as metadata columns. Gzip files can't be split: one task
    reads one file, so ``partitions`` spreads the rows afterwards.
    """
    docs = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.json(path)
    docs = docs.drop("_corrupt_record").withColumn("doc_id", F.col("doc_id").cast("string")).where("text <> ''")
    return docs.repartition(partitions) if partitions else docs


def read_sources(spark: SparkSession, spec: str) -> DataFrame:
    """Documents of several sources, ``path1;name1;path2;name2``, with a column ``source``."""
    parts = spec.split(";")
    if len(parts) % 2 or not all(parts):
        raise ValueError("expected path;name pairs")
    return union_sources({name: read_documents(spark, path) for path, name in zip(parts[::2], parts[1::2], strict=True)})


def parse_table(lines: Iterator[str], key: str | None = None) -> Iterator[tuple]:
    """Rows of a tabular alignment report; ``# Query: gi|1 docA`` lines name the query, other comments are skipped."""
    for line in lines:
        if named := _QUERY.match(line):
            key = named["name"]
        elif line.strip() and not line.startswith("#"):
            cells = line.rstrip("\r\n").split("\t")
            yield (key, cells[0], *map(int, cells[1:-1]), float(cells[-1]))


def _reports(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows: list[tuple] = []
        for path, content in zip(f["path"], f["content"], strict=True):
            if path.endswith(".tar.gz"):
                try:
                    with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                        for member in tar:
                            if member.name.endswith(".tsv"):
                                rows += parse_table(io.TextIOWrapper(tar.extractfile(member), "utf-8"))
                except (tarfile.TarError, EOFError, OSError):
                    continue  # an unreadable archive is skipped
            elif path.endswith(".gz"):
                for key, text in json.loads(gzip.decompress(content)).items():
                    rows += parse_table(iter(text.splitlines()), key)
            elif path.endswith(".tsv"):
                rows += parse_table(iter(content.decode("utf-8").splitlines()))
        yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in HSP.split(", ")])


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of report files: ``.tsv``, ``.gz`` (JSON of reports by query) and ``.tar.gz`` of ``.tsv``; others are ignored."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    wanted = files.where(F.col("path").rlike(r"\.(tsv|gz)$")).select("path", "content")
    return wanted.mapInPandas(_reports, HSP)


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """``cluster_id, node`` of cluster files (gzip JSON), in the list form ``[[nodes], length]`` or the filled form."""
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("cluster_id", "body"))
    listed = F.from_json(F.get_json_object("body", "$[0]"), "array<string>")
    filled = F.transform(F.from_json("body", "struct<hits:array<struct<node:string>>>")["hits"], lambda h: h["node"])
    return entries.select("cluster_id", F.explode(F.coalesce(listed, filled)).alias("node"))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """``new_cluster, old_cluster`` of link files (gzip JSON of lists); lists of one key in several files add up."""
    text = spark.read.text(path, wholetext=True)
    lists = text.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("new_cluster", "olds"))
    return lists.select("new_cluster", F.explode("olds").alias("old_cluster"))
