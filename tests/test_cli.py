"""Every stage of the command line on a small collection."""

import gzip
import json
import random

from quire.__main__ import main
from quire.sources import readers


def letters(rng, n):
    return "".join(rng.choice("abcdefghiklmnoprstuvwy") for _ in range(n))


def test_stages(spark, tmp_path, capsys):
    rng = random.Random(1)
    shared = letters(rng, 150)
    docs = [{"doc_id": f"d{i}", "text": letters(rng, 80) + (shared if i < 3 else "") + letters(rng, 60), "title": f"t{i}"} for i in range(5)]
    data, out, new, saved = (str(tmp_path / x) for x in ("in.gz", "out", "new", "saved"))
    with gzip.open(data, "wt") as f:
        f.writelines(json.dumps(d) + "\n" for d in docs)
    step = lambda *a: main([str(x) for x in a], spark)
    step("prepare-sources", "--data_folders", f"{data};s", "--output_folder", out, "--language", "eng")
    assert {r.source for r in spark.read.parquet(f"{out}/documents").collect()} == {"s"}
    step("prepare", "--data_folder", data, "--output_folder", out, "--language", "eng")
    for k in range(2):
        step("align", "--output_folder", out, "--iter", k, "--qpi", 3)
    step("cluster", "--output_folder", out, "--min_length", 50)
    step("fill", "--output_folder", out, "--language", "eng")
    step("run", "--data_folder", data, "--output_folder", new, "--language", "eng", "--min_length", 50)
    places = lambda folder: sorted((r.doc_id, r.s, r.e, r.text, r.title) for r in spark.read.parquet(f"{folder}/hits").collect())
    assert places(out) == places(new) and {x[0] for x in places(out)} == {"d0", "d1", "d2"}
    nodes = {f"{d}___{s}_{e}" for d, s, e, _, _ in places(out)}
    assert {r.node for r in readers.read_clusters(spark, f"{out}/unfilled").collect()} == nodes == {r.node for r in readers.read_clusters(spark, f"{out}/filled").collect()}
    step("combine", "--old_folder", out, "--new_folder", new, "--save_folder", saved)
    assert [tuple(r) for r in readers.read_links(spark, f"{saved}/link_files").collect()] == [("cluster_0", "cluster_0")]
    assert sorted((r.doc_id, r.origin) for r in spark.read.parquet(f"{saved}/hits").collect()) == [(f"d{i}", "old") for i in range(3)]
    for _ in range(2):
        step("separate", "--output_folder", out, "--save_folder", saved, "--language", "eng", "--min_count", 2)
    assert [r.name for r in spark.read.parquet(f"{saved}/separated").collect()] == ["cluster_0_0"] * 3
    capsys.readouterr()
    step("examine", "--output_folder", out)
    step("show", "--output_folder", out, "--language", "eng", "--node", "d1___90_110")
    said = capsys.readouterr().out
    assert "cluster_0: 3 hits" in said and docs[1]["text"][90:108] in said
