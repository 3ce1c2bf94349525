"""Operators of the core against vectors and brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from quire.operators import align, blocks, clusters, combine, fill, graph, hsp, intervals, nodes, scan, separate


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_blocks(spark):
    docs = spark.createDataFrame([("d", "x" * 25), ("e", ""), ("f", None)], "doc_id string, text string")
    found = rows(blocks.split_blocks(docs, 10).select("block_id", "block_end", F.length("text")))
    assert found == [("d__0_10", 10, 10), ("d__10_20", 20, 10), ("d__20_30", 25, 5)]
    assert blocks.split_blocks(docs).count() == 1
    assert blocks.split_blocks(docs.limit(0), 10).count() == 0


def test_numbering_and_running_sum(spark):
    names = [f"k{i:03d}" for i in range(200)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n, "extra") for n in names], ["name", "gi2"])
    assert {r.name: r.gi for r in blocks.numbered(df, "name").collect()} == {n: i + 1 for i, n in enumerate(sorted(names))}
    hot = [("hot", i, i % 7) for i in range(300)] + [("b", 1, 5), ("z", 1, 2), ("z", 2, 0)]
    found = scan.running_sum(spark.createDataFrame(hot, "k string, o long, v long"), "k", "o", "v")
    want, sums = {}, {}
    for k, o, v in sorted(hot):
        want[k, o] = sums.get(k, 0)
        sums[k] = want[k, o] + v
    assert {(r.k, r.o): r.before for r in found.collect()} == want
    assert scan.running_sum(found.drop("before").limit(0), "k", "o", "v").count() == 0


def test_metadata_and_sources(spark):
    a = spark.createDataFrame([("1", "t", "T")], ["doc_id", "text", "title"])
    b = spark.createDataFrame([("2", "u", 7)], ["doc_id", "text", "year"])
    both = blocks.union_sources({"x": a, "y": b})
    assert rows(blocks.source_counts(both)) == [("x", 1), ("y", 1)]
    assert blocks.with_metadata(a).first().meta == '{"title":"T"}'
    twice = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), (None, "c", 3)], "doc_id string, text string, n int")
    assert rows(blocks.last_wins(twice, F.col("n"))) == [("1", "b", 2)]


def test_hsp_filters(spark):
    table = [("q", "h", n, p) for n, p in ((99, 80.0), (100, 80.0), (120, 74.9), (150, 10.0))] + [("q", "q", 100, 100.0), ("q", "h", None, None)]
    df = spark.createDataFrame(table, "q_id string, h_id string, length int, ppos double")
    assert [r[2:] for r in rows(hsp.filter_hsp(df, ranges="0,0.85,100;100,0.75,150"))] == [(100, 80.0), (150, 10.0)]
    flat = spark.createDataFrame([("d__20_30", "e", 1, 5, 2, 6)], ["q_id", "h_id", "q_start", "q_end", "h_start", "h_end"])
    assert rows(hsp.flatten_blocks(flat)) == [("d", "e", 21, 25, 2, 6)]
    assert rows(hsp.passages(flat)) == [("d__20_30", 1, 5), ("e", 2, 6)]


def takers(spans, **how):
    return nodes.owners(*np.array(spans).T, **how).tolist()


def merges(a, b):
    return takers([a, b])[1] == 0


def test_merge_vectors():
    cases = [((0, 100), (5, 100), True), ((0, 100), (0, 10), True), ((0, 100), (9, 109), True), ((0, 100), (10, 110), False), ((0, 100), (20, 120), False), ((0, 100), (5, 200), False), ((3, 3), (3, 3), False)]
    assert [merges(a, b) for a, b, _ in cases] == [x for _, _, x in cases]
    # One that doesn't merge is passed over, one out of reach ends the search.
    assert takers([(0, 100), (5, 200), (6, 100)]) == [0, 1, 0] and takers([(0, 100), (5, 10), (6, 100)]) == [0, 1, 2]
    assert takers([(0, 100), (0, 10)], clip=True) == [0, 1]


def one_by_one(spans, t=0.9):
    """The rule of merging, passage by passage."""
    group, left = {}, list(range(len(spans)))
    while left:
        (s, e), first = spans[left[0]], left[0]
        group[first] = first
        for k in left[1:]:
            x, y = spans[k]
            if x - min(e - s, y - x) * (1 - t) > s:
                break
            if (e - x) / max(e - s, y - x) > t:
                group[k] = first
        left = [k for k in left if k not in group]
    return [group[k] for k in range(len(spans))]


def test_owners_like_the_rule():
    rng = random.Random(15)
    for n in (1, 5, 60, 300):
        own = sorted({(s, s + rng.randrange(1, 160)) for s in (rng.randrange(3 * n) for _ in range(n))})
        assert takers(own) == one_by_one(own)


def test_centroids(spark):
    bag = [("d", 0, 100), ("d", 0, 100), ("d", 5, 100), ("e", 0, 50), ("e", 300, 400), ("e", None, 3), (None, 1, 2)]
    found = rows(nodes.centroids(spark.createDataFrame(bag, "doc_id string, s int, e int")))
    assert found == [("d", 0, 100, 1, 100), ("d", 5, 100, 1, 100), ("e", 0, 50, 0, 50), ("e", 300, 400, 300, 400)]


def test_centroids_like_one_pass_per_document(spark):
    rng = random.Random(5)
    bag = [(f"d{rng.randrange(3)}", s, s + rng.randrange(1, 120)) for s in (rng.randrange(900) for _ in range(500))]
    found = {(r[0], r[1], r[2]): (r[3], r[4]) for r in rows(nodes.centroids(spark.createDataFrame(bag, "doc_id string, s int, e int")))}
    for doc in {b[0] for b in bag}:
        own = sorted((s, e) for d, s, e in bag if d == doc)
        owner = one_by_one(own)
        for group in ([k for k in range(len(own)) if owner[k] == g] for g in set(owner)):
            mean = tuple(int(sum(own[k][x] for k in group) / len(group)) for x in (0, 1))
            assert all(found[doc, *own[k]] == mean for k in group)


def test_mergeable_pairs(spark):
    rng = random.Random(6)
    own = sorted({(s, s + rng.randrange(1, 300)) for s in (rng.randrange(700) for _ in range(150))})
    found = rows(nodes.mergeable_pairs(spark.createDataFrame([("d", *x) for x in own], "doc_id string, s int, e int")))
    assert found == sorted(("d", *a, *b) for i, a in enumerate(own) for b in own[i + 1 :] if merges(a, b))


def brute_components(edges):
    label = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            for x in (a, b):
                if label[x] != low:
                    label[x], changed = low, True
    return label


def test_components(spark):
    rng = random.Random(2)
    edges = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(45)] + [("hub", f"s{i}") for i in range(80)] + [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(40)] + [("self", "self")]
    df = spark.createDataFrame([*edges, ("x", None), (None, None)], "src string, dst string")
    assert dict(rows(graph.connected_components(df))) == brute_components(edges)
    assert graph.connected_components(df.limit(0)).count() == 0


def test_overlaps(spark):
    members = [("c", "d", *x) for x in ((0, 10), (8, 30), (12, 20), (25, 40), (25, 40))] + [("c", "d", None, 4)]
    df = spark.createDataFrame(members, "cluster string, doc_id string, s int, e int")
    assert rows(clusters.without_overlaps(df)) == [("c", "d", 8, 30), ("c", "d", 12, 20), ("c", "d", 25, 40)]
    assert rows(clusters.average_length(clusters.without_overlaps(df))) == [("c", 3, 15)]


def test_clusters_of(spark):
    hits = [("a", "b", 0, 100, 50, 150), ("b", "c", 52, 150, 0, 99), ("x", "y", 1, 60, 1, 60), ("a", "b", 0, 100, 50, 150)]
    df = spark.createDataFrame(hits, "q_id string, h_id string, q_start int, q_end int, h_start int, h_end int")
    found = rows(clusters.clusters_of(df))
    assert {r[:2] for r in found} == {("cluster_0", "a"), ("cluster_0", "b"), ("cluster_0", "c"), ("cluster_1", "x"), ("cluster_1", "y")}
    slices = spark.createDataFrame([("a", 1), ("b", 2), ("x", 3)], ["q_id", "gi"])
    assert {r[1] for r in rows(clusters.clusters_in_rounds(df, slices, per_slice=2))} == set("abcxy")


def test_fill(spark):
    docs = spark.createDataFrame([("d", "Hello, World!"), ("e", None)], "doc_id string, text string")
    own = spark.createDataFrame([("k", "d", 1, 10), ("k", "d", 2, 3), ("k", "e", 1, 2), ("k", "gone", 1, 2)], "cluster_id string, doc_id string, s int, e int")
    filled = fill.fill_text(own, docs)
    assert {(r.doc_id, r.s): (r.text, r.i0, r.i1) for r in filled.collect()} == {("d", 1): ("ello, Worl", 1, 11), ("d", 2): (None, None, None), ("e", 1): (None, None, None), ("gone", 1): (None, None, None)}
    nested = fill.filled_clusters(filled).first()
    assert (nested.length, len(nested.hits), len(nested.skips)) == (10, 1, 3)
    meta = [spark.createDataFrame([("d", "old", 1)], ["doc_id", "title", "year"]), spark.createDataFrame([("d", "new")], ["doc_id", "title"])]
    assert {(r.title, r.year) for r in fill.with_metadata(own.where("doc_id = 'd'"), *meta).collect()} == {("new", 1)}
    assert rows(fill.first_text(docs, spark.createDataFrame([("d", "other"), ("x__y", "z")], ["doc_id", "text"]))) == [("d", "Hello, World!"), ("e", None), ("x_y", "z")]


def test_alignment_texts(spark):
    docs = spark.createDataFrame([("d", "Hello, World!"), ("e", "Well, hello!")], "doc_id string, text string")
    found = spark.createDataFrame([("d", "e", 1, 10, 0, 9, 9), ("d", "gone", 1, 99, 1, 2, 9)], "q_id string, h_id string, q_start int, q_end int, h_start int, h_end int, length int")
    assert rows(fill.alignment_texts(found, docs).select("h_id", "q_text", "h_text")) == [("e", "ello, Worl", "Well, hell"), ("gone", None, None)]


def test_links_and_combining(spark):
    old = spark.createDataFrame([("o1", "d", 0, 100), ("o2", "d", 300, 400), ("o3", "z", 0, 9)], "cluster_id string, doc_id string, s int, e int")
    new = spark.createDataFrame([("n1", "d", 5, 100), ("n2", "d", 10, 100), ("n3", "q", 1, 2), ("n1", "w", 0, 50)], "cluster_id string, doc_id string, s int, e int")
    links = combine.interval_links(new, old)
    assert rows(links) == [("n1", "o1")]
    many = spark.createDataFrame([("n1", "o2"), ("n1", "o1"), ("n2", "o1"), (None, "o1")], ["new_cluster", "old_cluster"])
    assert rows(combine.chosen_links(many)) == [("n1", "o1"), ("n2", "o1")]
    assert rows(combine.unlinked(new, many, "P")) == [("P_n3", "q", 1, 2)]
    found = rows(combine.combine(old, new, links, "P"))
    assert found == [("P_n2", "d", 10, 100, "new"), ("P_n3", "q", 1, 2, "new"), ("o1", "d", 0, 100, "old"), ("o1", "w", 0, 50, "new"), ("o2", "d", 300, 400, "old"), ("o3", "z", 0, 9, "old")]


def test_interval_links_brute(spark):
    rng = random.Random(3)
    some = lambda p: [(f"{p}{rng.randrange(9)}", f"d{rng.randrange(2)}", s, s + rng.randrange(0, 900)) for s in (rng.randrange(2000) for _ in range(150))]
    a, b = some("n"), some("o")
    schema = "cluster_id string, doc_id string, s int, e int"
    want = {(x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[3] > x[2] and y[3] > y[2] and min(x[3], y[3]) - max(x[2], y[2]) > 0.9 * max(x[3] - x[2], y[3] - y[2])}
    assert set(rows(combine.interval_links(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)))) == want


def test_periods(spark):
    rng = random.Random(4)
    spans = [("hot", s, s + rng.randrange(0, 6)) for s in (rng.randrange(3000) for _ in range(700))] + [(f"d{rng.randrange(30)}", s, s + rng.randrange(0, 9)) for s in (rng.randrange(90) for _ in range(300))]
    spans += [("hot", 10, 10), ("hot", 10, 10), ("rev", 9, 3), (None, 1, 2), ("n", None, 2)]
    want = set()
    for ent in {x[0] for x in spans if x[0] and x[1] is not None}:
        last = None
        for s, e in sorted((min(a, b), max(a, b)) for x, a, b in spans if x == ent and a is not None):
            if last and s <= last[1]:
                last[1] = max(last[1], e)
                continue
            if last:
                want.add((ent, "period", *last))
                want.add((ent, "gap", last[1], s))
            last = [s, e]
        want.add((ent, "period", *last))
    df = spark.createDataFrame(spans, "entity string, s int, e int").withColumn("pid", F.lit(1))
    for partitions in (1, 7, 40):
        assert set(rows(intervals.periods_and_gaps(df, partitions))) == want
    assert intervals.periods_and_gaps(df.limit(0)).count() == 0


def test_hit_spans(spark):
    hits = [("d", "d___1_5", ["2", "9"]), ("d", "d___7_3", ["2"]), (None, "e___1_5", None), ("f", None, [" 004", "3 "]), ("g", "bad", ["x", None]), (None, None, ["1", "2"])]
    df = spark.createDataFrame(hits, "doc_id string, node string, encoded_indices array<string>")
    assert rows(intervals.hit_spans(df)) == [("d", 2, 9), ("d", 3, 7), ("e", 1, 5), ("f", 3, 4)]


def text_with(rng, n, inner=""):
    k = rng.randrange(n)
    base = "".join(rng.choice("ABCDEFGHIK") for _ in range(n))
    return base[:k] + inner + base[k:]


def test_exact_runs_and_kmers(spark):
    rng = random.Random(7)
    shared = "".join(rng.choice("ABCDEFGHIK") for _ in range(90))
    texts = {f"t{i}": text_with(rng, 200, shared[rng.randrange(20) : 90 - rng.randrange(20)] if i % 2 else "") for i in range(12)} | {"null": None, "short": "ABC"}
    df = spark.createDataFrame(list(texts.items()), "doc_id string, enc string")
    want = set()
    for a in texts:
        for b in texts:
            if a < b and texts[a] and texts[b]:
                q, h = (np.array(list(texts[x])) for x in (a, b))
                for d in range(-len(q), len(h)):
                    want |= {(a, b, s + 1, s + n, s + d + 1, s + d + n, n) for s, n in align._runs(q, h, d, 30)}
    assert set(rows(align.exact_runs(df, 30, 12))) == want and want
    sets = {k: {t[i : i + 20] for i in range(len(t) - 19)} for k, t in texts.items() if t and len(t) >= 20}
    pairs = {(a, b, len(sets[a] & sets[b])) for a in sets for b in sets if a < b and sets[a] & sets[b]}
    assert set(rows(align.shared_kmers(df, 20))) == pairs


def test_alignment(spark):
    rng = random.Random(8)
    core = "".join(rng.choice("ABCDEFGHIK") for _ in range(120))
    noisy = core[:40] + "L" + core[41:80] + core[82:]
    df = spark.createDataFrame([("a", core), ("b", text_with(rng, 60, noisy)), ("c", text_with(rng, 100)), ("n", None)], "doc_id string, enc string")
    found = align.local_alignments(df).collect()
    assert {(r.q_id, r.h_id) for r in found} == {("a", "b")}
    best = max(found, key=lambda r: r.length)
    assert best.length >= 110 and best.ppos > 95 and best.e_value < 1e-3
    both = align.local_alignments(df, both_ways=True)
    assert {("a", "b"), ("b", "a"), ("a", "a")} <= {(r.q_id, r.h_id) for r in both.collect()}


def test_separation(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghiklmnoprstuvwy") for _ in range(8)) for _ in range(80)]
    a, b = " ".join(words[:40]), " ".join(words[40:])
    hits = [(i, "k", (a if i % 2 else b)[: 330 - i]) for i in range(8)] + [(99, "k", None), (100, None, a)]
    df = spark.createDataFrame(hits, "hit_id long, cluster_id string, text string")
    groups = {}
    for r in separate.separate(df, min_count=2).collect():
        groups.setdefault(r.cluster_id, set()).add(r.hit_id)
    assert sorted(map(sorted, groups.values())) == [[0, 2, 4, 6], [1, 3, 5, 7]]
    assert separate.separate(df, min_count=50).count() == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_levenshtein(spark):
    texts = {1: "kitten sitting", 2: "sitten sitting", 3: "something else", 4: "kitten sittin", 5: "ä" * 12, 6: "ä" * 11 + "b"}
    df = spark.createDataFrame([(i, "k", t) for i, t in texts.items()], "hit_id long, cluster_id string, text string")
    want = {(a, b, d) for a in texts for b in texts if a < b and len(texts[a]) * 0.75 <= len(texts[b]) and (d := levenshtein(texts[a], texts[b])) <= int(len(texts[a]) * 0.25)}
    assert set(rows(separate.levenshtein_similar(df))) == want


def line(order, links):
    """The rule of taking, one after another."""
    taken = {}
    for k, a in enumerate(order):
        if a not in taken:
            for b in order[k + 1 :]:
                if (a, b) in links and b not in taken:
                    taken[b] = a
    return taken


def test_first_come(spark):
    from quire.session import Scratch

    rng = random.Random(16)
    links = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(130)} | {(100 + i, 101 + i) for i in range(7)}
    df = spark.createDataFrame([(a, a, b) for a, b in links], "a long, at long, b long")
    assert {r.b: r.a for r in separate.first_come(df, Scratch(spark, "t")).collect()} == line(list(range(108)), links)
    assert separate.first_come(df.limit(0), Scratch(spark, "t")).count() == 0


def test_moves_of_single_hits(spark, monkeypatch):
    rng = random.Random(17)
    n = 24
    texts = {i: "e" * (100 + i) for i in range(n)}
    found = {}
    for _ in range(30):
        a, b = rng.sample(range(n), 2)
        found[a, b] = found[b, a] = rng.choice([20, 50, 60, 99, 130])
    rows = [(a, b, m) for (a, b), m in found.items()] + [(i, i, 100 + i) for i in range(n)]
    table = spark.createDataFrame(rows, "q_id long, h_id long, length int")
    monkeypatch.setattr(separate, "local_alignments", lambda *a, **k: table)
    # One after another, as the docstring says.
    near = {(a, b) for (a, b), m in found.items() if m > 0.75 * max(100 + a, 100 + b)}
    taken = line(list(range(n)), near)
    groups = {i: [i] + [b for b, a in taken.items() if a == i] for i in range(n) if i not in taken}
    gone = set()
    for i in sorted(groups):
        if len(groups[i]) == 1:
            own = [(-m, b) for (a, b), m in found.items() if a == i]
            if own:
                to = min(own)[1]
                groups[taken.get(to, to)].append(i)
            gone.add(i)
    want = [sorted(v) for k, v in sorted(groups.items()) if k not in gone]
    hits = spark.createDataFrame([(i, "k", t) for i, t in texts.items()], "hit_id long, cluster_id string, text string")
    got = {}
    for r in separate.separate(hits, min_count=2).collect():
        got.setdefault(r.cluster_id, []).append(r.hit_id)
    assert [sorted(got[f"k_{i}"]) for i in range(len(got))] == want and len(want) > 2


def test_separation_by_edits(spark):
    rng = random.Random(18)
    base = ["".join(rng.choice("abcdefghiklmnoprstuvwy") for _ in range(60)) for _ in range(3)]
    texts = {i: base[i % 3][: 60 - i] + "xx" * (i % 2) for i in range(9)} | {20: "eeeeeeee", 21: "12", 22: ""}
    hits = spark.createDataFrame([(i, "k", t) for i, t in texts.items()], "hit_id long, cluster_id string, text string")
    alone = rows(separate.separate_by_edits(hits, min_count=1).select("hit_id", "cluster_id"))
    groups = {i: c for i, c in alone}
    assert len(groups) == len(texts) and len({groups[i] for i in (0, 3, 6)}) == len({groups[i] for i in (1, 4, 7)}) == 1 and len(set(groups.values())) == 6
    far = {r.hit_id: r.cluster_id for r in separate.separate_by_edits(hits, min_count=1, farthest=True).collect()}
    assert len(set(far.values())) == 3
