"""Readers and writers on small files, streaming merges and the pipeline."""

import gzip
import io
import json
import tarfile

from pyspark.sql import functions as F

from quire.plans.pipeline import ReuseConfig, TextReuse
from quire.sources import readers, writers
from quire.streaming import incremental

REPORT = "# Query: gi|1 docA\n# 2 hits found\ndocB\t11\t120\t5\t114\t110\t97.27\ndocA\t1\t50\t1\t50\t50\t100.00\n\n"


def put(path, text):
    with gzip.open(path, "wt") as f:
        f.write(text)


def test_documents(spark, tmp_path):
    put(tmp_path / "a.gz", '{"doc_id": "x", "text": "one", "title": "T"}\n\n{"doc_id": "y", "text": ""}\n')
    assert [(r.doc_id, r.text) for r in readers.read_documents(spark, str(tmp_path)).collect()] == [("x", "one")]
    assert {r.source for r in readers.read_sources(spark, f"{tmp_path};s1;{tmp_path};s2").collect()} == {"s1", "s2"}


def test_alignments(spark, tmp_path):
    (tmp_path / "a.tsv").write_text(REPORT)
    put(tmp_path / "b.gz", json.dumps({"docQ": "docB\t1\t2\t3\t4\t2\t50.0\n"}))
    with tarfile.open(tmp_path / "c.tar.gz", "w:gz") as tar:
        info = tarfile.TarInfo("x.tsv")
        info.size = len(REPORT)
        tar.addfile(info, io.BytesIO(REPORT.encode()))
    (tmp_path / "d.tar.gz").write_bytes(b"broken")
    (tmp_path / "e.txt").write_text("ignored")
    found = sorted(tuple(r) for r in readers.read_alignments(spark, str(tmp_path)).collect())
    assert found.count(("docA", "docB", 11, 120, 5, 114, 110, 97.27)) == 2
    assert ("docQ", "docB", 1, 2, 3, 4, 2, 50.0) in found and len(found) == 5


def test_clusters_and_links(spark, tmp_path):
    (tmp_path / "c").mkdir(), (tmp_path / "l").mkdir()
    put(tmp_path / "c" / "a.gz", json.dumps({"cluster_0": [["a___1_2", "b___3_4"], 5]}))
    put(tmp_path / "c" / "b.gz", json.dumps({"cluster_1": {"length": 3, "hits": [{"node": "c___1_2", "text": "t"}]}}))
    put(tmp_path / "l" / "a.gz", json.dumps({"n": ["o1", "o2"]}))
    assert sorted(tuple(r) for r in readers.read_clusters(spark, str(tmp_path / "c")).collect()) == [("cluster_0", "a___1_2"), ("cluster_0", "b___3_4"), ("cluster_1", "c___1_2")]
    assert sorted(tuple(r) for r in readers.read_links(spark, str(tmp_path / "l")).collect()) == [("n", "o1"), ("n", "o2")]


def test_writers(spark, tmp_path):
    enc = spark.createDataFrame([(2, "b", "AA"), (1, "a", "BB")], ["gi", "block_id", "enc"])
    writers.write_fasta(enc, str(tmp_path / "f"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "f").glob("part-*")))
    assert text == ">gi|1 a\nBB\n>gi|2 b\nAA\n"
    kept = spark.createDataFrame([("c", "d10", 1, 5), ("c", "d9", 2, 9)], "cluster_id string, doc_id string, s int, e int")
    nested = writers.unfilled(kept)
    assert (nested.first().nodes, nested.first().avg_len) == (["d9___2_9", "d10___1_5"], 5)
    writers.write_json(nested, str(tmp_path / "j"), 1)
    assert spark.read.json(str(tmp_path / "j")).count() == 1
    out = str(tmp_path / "o")
    assert writers.not_done(kept, "cluster_id", spark, out).count() == 2
    kept.write.parquet(out)
    assert writers.not_done(kept, "cluster_id", spark, out).count() == 0


def test_streaming(spark, tmp_path):
    schema = "cluster_id string, doc_id string, s int, e int"
    spark.createDataFrame([("o", "d", 0, 100)], schema).write.parquet(str(tmp_path / "v" / "v=0"))
    spark.createDataFrame([("n", "d", 2, 100), ("n", "w", 0, 10), ("m", "q", 0, 9)], schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    incremental.start_merging(spark, stream, str(tmp_path / "v"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "v" / "v=1")).collect()) == [("b0_m", "q", 0, 9), ("o", "d", 0, 100), ("o", "w", 0, 10)]


def test_pipeline(spark):
    words = "harbour steamer passage evening winter captain weather market river engine".split()
    passage = " ".join(words[i % 10] + words[(3 * i + 1) % 10] for i in range(25))
    texts = [("a", "One thing. " + passage + " end of a"), ("b", "Quite another start " + passage), ("c", "nothing at all in common here"), ("a2", "One thing. " + passage + " end of a"), ("n", None)]
    docs = spark.createDataFrame([(d, t, f"title {d}", 1) for d, t in texts], "doc_id string, text string, title string, gi int")
    hits = TextReuse(ReuseConfig(alphabet="eng", min_length=50)).run(docs)["hits"].collect()
    by = {}
    for r in hits:
        by.setdefault(r.cluster_id, set()).add(r.doc_id)
    assert any({"a", "b"} <= v for v in by.values()) and any("a2" in v for v in by.values())
    assert all(r.title == f"title {r.doc_id}" for r in hits)
    assert any(r.text and "steamer" in r.text for r in hits)
    assert docs.where(F.col("gi") > 5).count() == 0
