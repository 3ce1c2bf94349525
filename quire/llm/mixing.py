"""Mixing overlapping sources to target shares, by a minimum-cost flow.

The same text may come from several sources. Texts are aggregated by membership pattern (the set of sources that
have them), and the tokens of the patterns are routed to the quotas of the sources: each further use of a pattern
costs one more, so repetitions are few and even. The network has one node per pattern, at most
``2 ** sources - 1`` whatever the size of the collection. Documents are then chosen in a seeded order along the line
of each pattern's tokens, so that each text is used the number of times that the flow says, give or take one.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.scan import running_sum
from quire.session import Scratch


@dataclass
class Flow:
    """Residual network with costs; flows are whole tokens."""

    nodes: int

    def __post_init__(self):
        self.out: list[list[int]] = [[] for _ in range(self.nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def edge(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> int:
        """Greatest flow of least cost, by cheapest augmenting paths; returns the flow."""
        total = 0
        while True:
            far = [None] * self.nodes
            via = [-1] * self.nodes
            far[source] = 0
            queue, queued = deque([source]), [False] * self.nodes
            while queue:
                a = queue.popleft()
                queued[a] = False
                for e in self.out[a]:
                    b = self.to[e]
                    if self.room[e] > 0 and (far[b] is None or far[a] + self.cost[e] < far[b]):
                        far[b], via[b] = far[a] + self.cost[e], e
                        if not queued[b]:
                            queued[b] = True
                            queue.append(b)
            if far[sink] is None:
                return total
            push, b = None, sink
            while b != source:
                push = self.room[via[b]] if push is None else min(push, self.room[via[b]])
                b = self.to[via[b] ^ 1]
            b = sink
            while b != source:
                self.room[via[b]] -= push
                self.room[via[b] ^ 1] += push
                b = self.to[via[b] ^ 1]
            total += push


def route(patterns: dict[tuple[str, ...], int], targets: dict[str, tuple[float, int]], total: int | None = None) -> tuple[int, dict[tuple[tuple[str, ...], str], int]]:
    """Tokens of each pattern that each source takes, and the size of the mix.

    ``patterns``: tokens by sorted tuple of sources; ``targets``: (share, most repeats) by source. Sources without
    a text can't contribute; the shares of the others keep their proportions. Without ``total`` the mix is as large
    as all their shares allow, found by bisection.
    """
    weight = {s: targets[s][0] for p in patterns for s in p if targets[s][0] > 0 and targets[s][1] > 0}
    scale = sum(weight.values())
    names = sorted(weight)
    keys = sorted(patterns)
    if not names:
        return 0, {}

    def solve(size: int) -> tuple[int, int, dict]:
        quota = {s: int(size * weight[s] / scale) for s in names}
        net = Flow(2 + len(keys) + len(names))
        most = max(targets[s][1] for s in names)
        used = {}
        for i, p in enumerate(keys):
            for turn in range(sum(targets[s][1] for s in p if s in quota) if len(p) > 1 else most):
                net.edge(0, 2 + i, patterns[p], turn)
            for s in p:
                if s in quota:
                    used[p, s] = net.edge(2 + i, 2 + len(keys) + names.index(s), patterns[p] * targets[s][1])
        for j, s in enumerate(names):
            net.edge(2 + len(keys) + j, 1, quota[s])
        got = net.run(0, 1)
        return got, sum(quota.values()), {k: net.room[e ^ 1] for k, e in used.items()}

    if total is None:
        low, high = 0, sum(n * sum(targets[s][1] for s in p if s in weight) for p, n in patterns.items()) + 1
        while high - low > max(1, high // 100_000):
            mid = (low + high) // 2
            got, want, _ = solve(mid)
            low, high = (mid, high) if got == want else (low, mid)
        total = low
    return total, {k: v for k, v in solve(total)[2].items() if v}


def mix_sources(texts: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 1) -> DataFrame:
    """The chosen documents: ``source, doc_id, copies, n_tokens``.

    ``texts``: ``doc_id, source, digest`` (of the text), ``n_tokens``; ``targets``: ``source, target_share,
    max_repeats`` (a small table; rows with a null or a negative value are left out, and of several rows of a source
    the one of the largest share counts). Texts whose source is null or has no target take no part; a target without texts gets nothing. Equal
    texts of a source are one text, shown by its least ``doc_id``. No text is used more than ``max_repeats`` times
    for a source. Further columns are ignored; without texts there are no rows.
    """
    spark = texts.sparkSession
    scratch = Scratch(spark, "mixing")
    good = targets.select("source", "target_share", "max_repeats").where("source is not null and target_share >= 0 and max_repeats >= 0")
    wanted = {r.source: (r.target_share, r.max_repeats) for r in sorted(good.collect(), key=lambda r: (r.target_share, r.max_repeats))}
    of_source = texts.where(F.col("source").isin(list(wanted)) & (F.col("n_tokens") > 0)).groupBy("digest", "source").agg(F.min("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"))
    # At most one entry per source and text.
    lines = of_source.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("source", "doc_id"))).alias("docs"), F.max("n_tokens").alias("n_tokens"))
    lines = lines.select(F.array_join("docs.source", "\n").alias("pattern"), F.concat(F.lpad(F.hex(F.xxhash64(F.lit(seed), "digest")), 16, "0"), F.hex("digest")).alias("at"), "docs", "n_tokens")
    lines = scratch.cut(lines)
    sizes = {tuple(r.pattern.split("\n")): r.n for r in lines.groupBy("pattern").agg(F.sum("n_tokens").alias("n")).collect()}
    _, flow = route(sizes, wanted, total)
    takes, at = [], {}
    for (p, s), n in sorted(flow.items()):
        a = at.get(p, 0)
        takes.append(("\n".join(p), s, a, a + n, sizes[p]))
        at[p] = a + n
    take = spark.createDataFrame(takes, "pattern string, source string, a long, b long, w long")  # bounded by patterns and sources
    placed = running_sum(lines, "pattern", "at", "n_tokens").join(F.broadcast(take), "pattern")
    middle = F.col("before") + F.expr("n_tokens div 2")
    turns = lambda end: F.greatest(F.lit(0), -F.floor((middle - F.col(end)) / F.col("w")))
    chosen = placed.withColumn("copies", (turns("b") - turns("a")).cast("int")).where("copies > 0")
    own = F.filter("docs", lambda d: d["source"] == F.col("source"))[0]["doc_id"]
    return chosen.select("source", own.alias("doc_id"), "copies", "n_tokens")


def actual_shares(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: its share, the share really reached, tokens, documents and the most copies of one document."""
    sums = mix.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    sums = sums.withColumn("total", F.sum("tokens").over(Window.partitionBy(F.lit(0))))  # one row per target
    rows = targets.select("source", "target_share", "max_repeats").join(sums, "source", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return rows.select("source", "target_share", F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)).alias("actual_share"), zero("tokens"), zero("documents"), zero("most_copies"), "max_repeats")
