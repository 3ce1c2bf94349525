"""Operators against the whole job: nothing that a class, a bound or a seed might leave out."""

import os
import random

import numpy as np
from pyspark.sql import functions as F

from quire.operators import align, clusters, separate
from quire.plans import queries
from quire.plans.pipeline import ReuseConfig, TextReuse
from quire.session import Scratch


def letters(rng, n):
    return "".join(rng.choice("abcdefghiklmnoprstuvwy") for _ in range(n))


def parts(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.cluster_id, set()).add((r.doc_id, r.s, r.e))
    return sorted(sorted(x) for x in groups.values())


def test_copies_are_in_the_clusters_of_their_passages(spark):
    rng = random.Random(11)
    shared, other = letters(rng, 200), letters(rng, 150)
    text = letters(rng, 100) + shared + letters(rng, 100) + other + letters(rng, 90)
    texts = {"a1": text, "a2": text.upper(), "a3": text + " 1871!", "x": letters(rng, 80) + shared + letters(rng, 60), "y1": shared[20:] + letters(rng, 50)}
    texts |= {"y2": texts["y1"].title(), "z": other[:90] + letters(rng, 40), "single": letters(rng, 300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    got = TextReuse(ReuseConfig(alphabet="eng", min_length=50)).run(docs)
    found = parts(got["hits"].collect())
    places = [{d for d, _, _ in x} for x in found]
    assert {"a1", "a2", "a3", "x", "y1", "y2"} in places and {"a1", "a2", "a3", "z"} in places
    # as if every text had been aligned with every other one
    m = got["members"].select("doc_id", "rep", "n")
    side = lambda x: m.select(F.col("rep").alias(f"{x}_id"), F.col("doc_id").alias(f"{x}_doc"))
    links = got["hsp"].join(side("q"), "q_id").join(side("h"), "h_id").select(F.col("q_doc").alias("q_id"), F.col("h_doc").alias("h_id"), "q_start", "q_end", "h_start", "h_end")
    n = F.col("n").cast("int")
    same = m.alias("a").join(m.select("rep", F.col("doc_id").alias("o")), "rep").where("doc_id < o").select(F.col("doc_id").alias("q_id"), F.col("o").alias("h_id"), F.lit(1).alias("q_start"), n.alias("q_end"), F.lit(1).alias("h_start"), n.alias("h_end"))
    assert parts(clusters.clusters_of(links.unionAll(same)).collect()) == found


def test_clusters_of_other_sizes_pass_separation(spark):
    rng = random.Random(12)
    text = letters(rng, 200)
    hits = [(i, "mid", text) for i in range(4)] + [(10, "few", text), (11, "few", text[:100])] + [(20 + i, "many", text) for i in range(7)]
    hits += [(40, "none", None), (41, "few", None), (42, None, text)]
    df = spark.createDataFrame(hits, "hit_id long, cluster_id string, text string")
    got = {(r.hit_id, r.cluster_id, r.length) for r in separate.separated_all(df, min_count=3, max_count=5).collect()}
    assert got == {(i, "mid_0", 200) for i in range(4)} | {(i, "few", 150) for i in (10, 11, 41)} | {(20 + i, "many", 200) for i in range(7)} | {(40, "none", None)}


def test_levenshtein_pairs_by_length(spark, monkeypatch):
    rng = random.Random(13)
    texts = [(rng.choice("ab") * rng.randrange(0, 40)) + rng.choice(["", "a", "bb", "ab"]) for _ in range(90)]
    hits = [(i, "k", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(hits, "hit_id long, cluster_id string, text string")
    far = df.select("hit_id", "text").alias("a").join(df.select(F.col("hit_id").alias("o"), F.col("text").alias("u")), F.col("hit_id") < F.col("o"))
    want = {(r[0], r[1], r[2]) for r in far.where("length(text) * 0.75 <= length(u)").withColumn("d", F.levenshtein("text", "u")).where("d <= floor(length(text) * 0.25)").select("hit_id", "o", "d").collect()}
    assert {tuple(r) for r in separate.levenshtein_similar(df).collect()} == want and want
    monkeypatch.setattr(queries, "_hits", lambda spark, sf: df)
    big = spark.range(separate.MAX_COUNT + 1).select(F.col("id").alias("hit_id"), F.lit("big").alias("cluster_id"), F.lit("same").alias("text"))
    assert separate.candidates(big, 2, None).count() == separate.MAX_COUNT + 1
    assert {tuple(r) for r in queries.levenshtein_pairs(spark, "").collect()} == want


def test_alignment_crosses_gaps_without_a_seed_beyond(spark):
    rng = random.Random(14)
    core = "".join(rng.choice("ABCDEFGHIKLMNOPQRSTUVWY") for _ in range(300))
    noisy = list(core)
    for i in [*range(10, 130, 10), *range(175, 300, 10)]:
        noisy[i] = "Z"
    noisy = "".join(noisy)
    noisy = noisy[:133] + "Z" + noisy[133:172] + noisy[173:]  # a letter more on the left of the clean run, one less on its right
    for a, b in ((core, noisy), (noisy, core)):
        df = spark.createDataFrame([("a", "HIKLMN" + a), ("b", b + "ACACAC")], "doc_id string, enc string")
        (r,) = align.local_alignments(df).collect()
        assert (r.q_start, r.h_start) == (7, 1) and min(r.q_end - 6, r.h_end) >= 294 and r.length >= 294
    q, h = (np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (core, noisy))
    assert len(align.align_pair(q, h, [0, 1], 6)) == 1


def test_members_of_classes(spark, monkeypatch):
    docs = spark.createDataFrame([("a", "Hello, world"), ("b", "hello world 1871!"), ("c", "Other"), ("n", None)], "doc_id string, text string")
    monkeypatch.setattr(queries, "_docs", lambda spark, sf: docs)
    assert sorted(tuple(r) for r in queries.QUERIES["class_members"](spark, "").collect()) == [("a", "a"), ("b", "a"), ("c", "c")]


def test_pipeline_finds_pairs_with_short_common_runs(spark):
    rng = random.Random(15)
    core = "".join(rng.choice("ABCDEFGHIKLMNOPQRSTUVWY") for _ in range(200))
    noisy = "".join("Z" if i % 20 == 19 else c for i, c in enumerate(core))  # runs of 19
    df = spark.createDataFrame([("a", core), ("b", noisy)], "doc_id string, enc string")
    (r,) = TextReuse(ReuseConfig(alphabet="eng")).alignments(df).collect()
    assert (r.q_id, r.h_id) == ("a", "b") and r.length >= 199


def test_queries_find_what_the_pipeline_finds(spark, monkeypatch):
    rng = random.Random(16)
    core = "".join(rng.choice("untbdgfsmwipoehrlkcayjv") for _ in range(200))
    noisy = "".join(("u" if c != "u" else "n") if i % 20 == 19 else c for i, c in enumerate(core))  # runs of 19
    short = letters(rng, 24)  # too short for an expected number of 1e-15
    texts = [("a", core), ("b", noisy), ("c", letters(rng, 60) + short + letters(rng, 60)), ("d", letters(rng, 70) + short + letters(rng, 50))]
    docs = spark.createDataFrame([(*x, "t", "1900", "en", "s") for x in texts], "doc_id string, text string, title string, issue_date string, lang string, source string")
    monkeypatch.setattr(queries, "_docs", lambda spark, sf: docs)
    assert {("a", "b"), ("c", "d")} <= {(r.q_id, r.h_id) for r in queries.gapped_alignment(spark, "").collect()}
    assert {"a", "b"} in [{d for d, _, _ in x} for x in parts(queries.reuse_pipeline(spark, "").collect())]


def test_blocks_have_the_offsets_of_their_documents(spark):
    rng = random.Random(19)
    shared = letters(rng, 160)
    texts = {"a": letters(rng, 230) + " 12, " + letters(rng, 200) + shared, "b": shared + letters(rng, 30), "c": letters(rng, 300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    got = TextReuse(ReuseConfig(alphabet="eng", split_size=440, min_length=50)).run(docs)["hits"].collect()
    places = {r.doc_id: (r.s, r.e, r.text) for r in got}
    assert set(places) == {"a", "b"} and places["b"][2] and places["a"][2] in texts["a"] and places["a"][2][5:-5] in texts["b"]
    codes = {d: len([c for c in t if c.isalpha()]) for d, t in texts.items()}
    assert places["a"][1] == codes["a"] and places["a"][1] - places["a"][0] == places["b"][1] - places["b"][0] >= 150


def test_new_texts_against_all(spark):
    rng = random.Random(20)
    core = letters(rng, 120).upper()
    df = spark.createDataFrame([(d, letters(rng, 40).upper() + core + letters(rng, 30).upper()) for d in "abcd"], "doc_id string, enc string")
    new = df.where("doc_id in ('b', 'c')")
    every = align.exact_runs(df, 50).collect()
    assert len(every) == 6 and sorted(align.exact_runs(df, 50, queries=new).collect()) == sorted(r for r in every if {r.q_id, r.h_id} & {"b", "c"})
    found = align.local_alignments(df, queries=new).collect()
    assert {(r.q_id, r.h_id) for r in found} == {("a", "b"), ("a", "c"), ("b", "c"), ("b", "d"), ("c", "d")}


def test_scores():
    table = align.score_table(align.Scoring())
    at = lambda a, b: int(table[ord(a), ord(b)])
    assert (at("W", "W"), at("I", "V"), at("V", "I"), at("D", "E"), at("X", "X"), at("B", "B"), at("Z", "E"), at("C", "E")) == (11, 3, 3, 2, -1, 4, 4, -4)
    assert (table == table.T).all()
    plain = align.score_table(align.Scoring(blosum=False))
    assert plain[ord("W"), ord("W")] == 5 and plain[ord("I"), ord("V")] == -4


def test_recall_against_words_of_six(spark):
    """Planted passages with misread letters, one in twelve: pairs found by all words of six as seeds."""
    rng = random.Random(21)
    rows = []
    for k in range(40):
        core = letters(rng, 120)
        for side in "ab":
            text = "".join(rng.choice("abcdefghiklmnoprstuvwy") if rng.random() < 1 / 24 else c for c in core)
            rows.append((f"{k:02d}{side}", (letters(rng, 60) + text + letters(rng, 60)).upper()))
    df = spark.createDataFrame(rows, "doc_id string, enc string")
    pairs = lambda found: {(r.q_id, r.h_id) for r in found.where("length >= 50").collect()}
    c = ReuseConfig()
    every = pairs(align.local_alignments(df, word=6, seed=6, reach=1))
    assert len(every) >= 40 and len(pairs(align.local_alignments(df, c.word, c.seed, c.reach)) & every) >= 0.9 * len(every)


def test_shared_kmers_write_few_windows(spark, monkeypatch):
    """Pairs like those of sets, in few rows: windows that no other text can have aren't written."""
    rng = random.Random(22)
    phrase = letters(rng, 45)
    texts = {f"t{i}": letters(rng, 400) + (phrase[i % 3 :] + letters(rng, 5) + phrase[:40] if i % 2 else "é" * (40 + i)) for i in range(30)} | {"copy": letters(rng, 90)}
    texts |= {"copy2": texts["copy"], "short": phrase[:29], "just": phrase[:30], "none": None}
    df = spark.createDataFrame(list(texts.items()), "doc_id string, enc string")
    sizes, cut = [], align.Scratch.cut
    monkeypatch.setattr(align.Scratch, "cut", lambda self, x: sizes.append((out := cut(self, x)).count()) or out)
    got = {tuple(r) for r in align.shared_kmers(df, 30).collect()}
    sets = {d: {t[i : i + 30] for i in range(len(t) - 29)} for d, t in texts.items() if t and d != "copy2"}
    assert got == {(a, b, len(sets[a] & sets[b])) for a in sets for b in sets if a < b and sets[a] & sets[b]} and len(got) > 200
    assert max(sizes) < sum(map(len, sets.values())) / 4


def test_pipeline_leaves_only_tables_that_its_results_read(spark, monkeypatch):
    """And moves texts compressed: a class is found by names of codes, a chunk of texts is one value."""
    rng = random.Random(23)
    shared = letters(rng, 90)
    texts = {f"d{i}": letters(rng, 40) + shared + letters(rng, 40) for i in range(4)} | {"other": letters(rng, 200), "none": None}
    texts |= {"same": texts["d0"] + " 1871", "x": "uu"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    made, cut = {}, Scratch.cut

    def watched(self, df):
        out = cut(self, df)
        made[self._paths[id(out)].removeprefix("file://")] = df.columns
        return out

    monkeypatch.setattr(Scratch, "cut", watched)
    reuse = TextReuse(ReuseConfig(alphabet="eng", min_length=50))
    got = reuse.run(docs)
    left = [columns for path, columns in made.items() if os.path.exists(path)]
    assert len(left) == 3 and ["cluster_id", "doc_id", "s", "e"] in left and ["doc_id", "rep", "n"] in left
    assert not any("encs" in columns for columns in made.values())
    assert {r.doc_id for r in got["hits"].collect()} == {"d0", "d1", "d2", "d3", "same"} and got["hsp"].count() == 6
    encoded = got["encoded"]
    assert {tuple(r) for r in got["members"].collect()} == {(r.doc_id, r.rep, len(r.enc)) for r in align.classes(encoded).collect()}
    assert sorted(got["hsp"].collect()) == sorted(reuse.alignments(encoded).collect())
