"""The pN_ queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import components as p1
from quire.llm import encoding as p7
from quire.llm import lookalike as p10
from quire.llm import mixing as p9
from quire.llm import nearcopies as p6
from quire.llm import packing as p8
from quire.llm import scans as p3
from quire.llm import spans as p4
from quire.llm import split as p2
from quire.llm.tokens import token_counts
from quire.session import Scratch, table


def _rendered(side: str) -> F.Column:
    """``{doc_id}___{s}_{e}``, null if any part is null."""
    return F.concat(F.col(f"{side}.doc_id"), F.lit("___"), F.col(f"{side}.s").cast("string"), F.lit("_"), F.col(f"{side}.e").cast("string"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    edges = table(spark, sf, "edges").select(_rendered("src").alias("src"), _rendered("dst").alias("dst"))
    return p1.components(edges)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    pieces = p2.split_oversized(table(spark, sf, "documents"), with_text=False)
    return pieces.where("piece = 0").select("doc_id")


def p2_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return p2.split_oversized(table(spark, sf, "documents"))


def _scan_noise(spark: SparkSession, sf: str, repaired: bool) -> DataFrame:
    docs, hits = table(spark, sf, "documents"), table(spark, sf, "cluster_hits")
    lexicon = {r.lang: frozenset(r.words) for r in table(spark, sf, "lexicon").collect()}  # one row per language
    records = docs.select(F.lit("doc").alias("record_kind"), F.col("doc_id").alias("record_id"), "text", "title").unionAll(
        hits.select(F.lit("hit").alias("record_kind"), F.col("hit_id").alias("record_id"), "text", "title")
    )
    return p3.scan_noise(records, lexicon, p3.common_words(docs, lexicon), repaired)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return _scan_noise(spark, sf, repaired=False).select("record_kind", "record_id").distinct()


def p3_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return _scan_noise(spark, sf, repaired=True).dropDuplicates(["record_kind", "record_id"])


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return p4.shared_spans(table(spark, sf, "documents"))


def p4_totals(spark: SparkSession, sf: str) -> DataFrame:
    return p4.shared_totals(table(spark, sf, "documents"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    hits = table(spark, sf, "cluster_hits").select(F.col("hit_id").alias("id"), "text")
    return p6.similar_pairs(hits).select(F.col("a").alias("hit_a"), F.col("b").alias("hit_b"))


def p6_groups(spark: SparkSession, sf: str) -> DataFrame:
    hits = table(spark, sf, "cluster_hits").select(F.col("hit_id").alias("id"), "text")
    found = p6.near_copies(hits)
    return found.select(F.col("id").alias("hit_id"), F.col("rep").alias("class_hit"), F.col("group").alias("group_hit"), "links")


def _known_words(spark: SparkSession, sf: str) -> frozenset[str]:
    """The lexicon: a fixed table of one row per language, whatever the size of the collection."""
    return frozenset(r[0] for r in table(spark, sf, "lexicon").select(F.explode("words")).distinct().collect())


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return p7.repair_encoding(table(spark, sf, "documents"), _known_words(spark, sf)).select("doc_id")


def p7_restored(spark: SparkSession, sf: str) -> DataFrame:
    return p7.repair_encoding(table(spark, sf, "documents"), _known_words(spark, sf))


def _sized(spark: SparkSession, sf: str) -> DataFrame:
    return Scratch(spark, "tokens").cut(token_counts(table(spark, sf, "documents")))


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return p8.fill_containers(_sized(spark, sf).select("doc_id", "n_tokens"))


#: Limits of a container of training examples, below what its tokens would allow.
EXAMPLES, LOSS = 4, 1536


def p8_examples(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as training examples: their first line is the prompt, which bears no loss; all three limits bind."""
    sized = Scratch(spark, "tokens").cut(token_counts(table(spark, sf, "documents"), heads=True))
    items = sized.select("doc_id", "n_tokens", F.greatest(F.col("n_tokens") - F.col("head_tokens"), F.lit(0)).alias("loss_tokens"))
    return p8.fill_containers(items, segments=EXAMPLES, loss=LOSS, with_loss=True)


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    bins = p8_containers(spark, sf).groupBy("container").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("k"))
    return bins.agg(F.count("*").alias("containers"), F.ceil(F.sum("n") / p8.CAPACITY).alias("least_containers"), F.max("n").alias("most_tokens"), F.max("k").alias("most_segments"), (F.sum("n") / F.count("*") / p8.CAPACITY).alias("fill"))


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    return p9.mix_sources(_sized(spark, sf), table(spark, sf, "mix_targets"))


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    return p9.actual_shares(p9_mix(spark, sf), table(spark, sf, "mix_targets"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return p10.lookalike_pairs(table(spark, sf, "documents"))


def p10_groups(spark: SparkSession, sf: str) -> DataFrame:
    return p10.lookalike_groups(table(spark, sf, "documents"))


def p10_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return p10.with_canonical_text(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "canonical")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p2_pieces": p2_pieces,
    "p3_found": p3_found,
    "p3_repaired": p3_repaired,
    "p4_found": p4_found,
    "p4_totals": p4_totals,
    "p6_found": p6_found,
    "p6_groups": p6_groups,
    "p7_found": p7_found,
    "p7_restored": p7_restored,
    "p8_containers": p8_containers,
    "p8_examples": p8_examples,
    "p8_fill": p8_fill,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_groups": p10_groups,
    "p10_canonical": p10_canonical,
}

_SPANS = """
o AS (SELECT doc_id, text, unnest(range(0, length(text) - 149, 300)) AS base FROM documents WHERE length(text) >= 150),
x AS (SELECT doc_id, base, substring(text, base + 1, 449) AS part FROM o),
y AS (SELECT doc_id, base, part, unnest(range(0, length(part) - 149)) AS i FROM x),
w AS (SELECT doc_id, base + i AS i, md5(substring(part, i + 1, 150)) AS name FROM y),
shared AS (SELECT name FROM w GROUP BY name HAVING min(doc_id) < max(doc_id)),
f AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM w WHERE name IN (SELECT name FROM shared)),
g AS (SELECT doc_id, i, sum(CASE WHEN before >= i - 150 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS island FROM f),
spans AS (SELECT doc_id, CAST(min(i) AS INT) AS span_start, CAST(max(i) + 150 AS INT) AS span_end FROM g GROUP BY doc_id, island)"""


def _similar(among: str, width: int, least: float) -> str:
    """``alike``: pairs ``a, b`` of similar hits, of all (``g``) or of the least of each set of shingles (``r``); ``m``: that least one."""
    gram = " || ' ' || ".join(f"words[i + {k}]" for k in range(width))
    return rf"""
tx AS (SELECT hit_id AS id, regexp_extract_all(lower(any_value(text)), '[\p{{L}}\p{{N}}]+') AS words FROM cluster_hits WHERE hit_id IS NOT NULL AND text IS NOT NULL GROUP BY hit_id),
p AS (SELECT id, words, unnest(range(1, len(words) - {width - 2})) AS i FROM tx WHERE len(words) >= {width}),
g AS (SELECT DISTINCT id, md5({gram}) AS gram FROM p),
cl AS (SELECT id, md5(string_agg(gram, ',' ORDER BY gram)) AS cls FROM g GROUP BY id),
m AS (SELECT id, min(id) OVER (PARTITION BY cls) AS rep FROM cl),
r AS (SELECT g.* FROM g JOIN m ON g.id = m.id AND m.id = m.rep),
n AS (SELECT id, count(*) AS n FROM {among} GROUP BY id),
c AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM {among} x JOIN {among} y ON x.gram = y.gram AND x.id < y.id GROUP BY x.id, y.id),
alike AS (SELECT a, b FROM c JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE c >= CAST({least} AS DOUBLE) * (x.n + y.n - c))"""


SQL: dict[str, str] = {
    "p1_found": """
WITH RECURSIVE e AS (
  SELECT DISTINCT src.doc_id || '___' || src.s || '_' || src.e AS a, dst.doc_id || '___' || dst.s || '_' || dst.e AS b FROM edges),
sym AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach(node, other) AS (SELECT a, a FROM sym UNION SELECT r.node, x.b FROM reach r JOIN sym x ON x.a = r.other)
SELECT node, min(other) AS group_node FROM reach GROUP BY node
""",
    "p4_found": f"WITH {_SPANS} SELECT doc_id, span_start, span_end FROM spans",
    "p4_totals": f"""
WITH {_SPANS}, t AS (SELECT doc_id, sum(span_end - span_start) AS shared_chars, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(length(text), 0) AS chars, CAST(coalesce(shared_chars, 0) AS BIGINT) AS shared_chars, coalesce(spans, 0) AS spans FROM documents d LEFT JOIN t USING (doc_id)
""",
    "p6_found": f"WITH {_similar('g', 3, 0.6)} SELECT a AS hit_a, b AS hit_b FROM alike",
    "p6_groups": f"""
WITH RECURSIVE {_similar('r', 5, 0.8)},
l AS (SELECT a, b FROM alike UNION ALL SELECT b, a FROM alike),
reach(id, other) AS (SELECT a, a FROM l UNION SELECT reach.id, l.b FROM reach JOIN l ON l.a = reach.other),
k AS (SELECT id, min(other) AS least FROM reach GROUP BY id),
d AS (SELECT a AS id, count(*) AS links FROM l GROUP BY a)
SELECT t.id AS hit_id, coalesce(m.rep, t.id) AS class_hit, coalesce(k.least, m.rep, t.id) AS group_hit, coalesce(d.links, 0) AS links
FROM (SELECT DISTINCT hit_id AS id FROM cluster_hits WHERE hit_id IS NOT NULL) t LEFT JOIN m ON m.id = t.id LEFT JOIN k ON k.id = m.rep LEFT JOIN d ON d.id = m.rep
""",
    "p2_found": "SELECT doc_id FROM documents WHERE length(text) > 6000",
}
