"""SQL of the core's queries, where SQL can express them, for an engine of the PostgreSQL kind."""

from __future__ import annotations

from quire.functions.alphabet import ALPHABETS
from quire.plans.queries import BLOCK, BOUNDS, KMER, LEAST_RUN, SHARED_KMER


def _enc(name: str) -> str:
    letters, codes = ALPHABETS[name]
    return f"translate(regexp_replace(lower(text), '[^{letters.replace('.', chr(92) + '.')}]', '', 'g'), '{letters}', '{codes}')"


def _encode(name: str) -> str:
    return f"WITH e AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_enc(name)} AS enc FROM documents WHERE text <> '') SELECT doc_id, length(enc) AS letters, md5(enc) AS enc_md5 FROM e WHERE enc <> ''"


_ENC = f"e AS (SELECT * FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_enc('eng')} AS enc FROM documents WHERE text <> '') WHERE enc <> ''), r AS (SELECT min(doc_id) AS doc_id, enc FROM e GROUP BY enc)"
_SPACE = r"[\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_HITS = "h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hit_id ORDER BY written_at DESC NULLS LAST) AS rn FROM cluster_hits) WHERE rn = 1)"
_NODE = r"""
hn AS (SELECT * FROM (SELECT cluster_id, hit_id, nullif(regexp_extract(node, '^\s*(.*?)___', 1), '') AS doc_id,
    try_cast(nullif(regexp_extract(node, '___\s*(-?\d+)\s*_\s*(-?\d+)\s*$', 1), '') AS INT) AS s,
    try_cast(nullif(regexp_extract(node, '___\s*(-?\d+)\s*_\s*(-?\d+)\s*$', 2), '') AS INT) AS e FROM h)
  WHERE cluster_id IS NOT NULL AND doc_id IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL)"""
_UNFILLED = "u AS (SELECT * FROM (SELECT cluster_id, n.doc_id AS doc_id, n.s AS s, n.e AS e FROM (SELECT cluster_id, unnest(nodes) AS n FROM clusters_unfilled)) WHERE cluster_id IS NOT NULL AND doc_id IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL)"
_NAMES = """
n AS (SELECT src.doc_id || '___' || src.s || '_' || src.e AS a, dst.doc_id || '___' || dst.s || '_' || dst.e AS b FROM edges),
sym AS (SELECT a, b FROM n WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM n WHERE a IS NOT NULL AND b IS NOT NULL),
reach(node, other) AS (SELECT a, a FROM sym UNION SELECT r.node, x.b FROM reach r JOIN sym x ON x.a = r.other),
c AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
"""
_RANGES = " AND ".join(f"NOT (length >= {lo} AND length < {hi} AND ppos < {100 * float(score)})" for lo, score, hi in (x.split(",") for x in BOUNDS["ranges"].split(";")))
_LETTERS = ALPHABETS["eng"][0]


def _decoded(source: str) -> str:
    """``dec``: the passages ``doc_id, s, e`` of a table with their raw offsets and text, null where there is none."""
    return f"""
dn AS (SELECT DISTINCT doc_id, s, e FROM {source} WHERE doc_id IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL),
dl AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, length(text) AS size, string_split(lower(text), '') AS cs FROM documents WHERE text <> ''),
dp AS (SELECT doc_id, text, size, list_filter(range(0, size), lambda i: contains('{_LETTERS}', cs[i + 1])) AS pos FROM dl),
da AS (SELECT dn.*, dp.text, dp.size, dp.pos, CASE WHEN dn.s = 0 THEN 0 WHEN dn.s > 0 THEN dp.pos[dn.s] + 1 END AS i0 FROM dn LEFT JOIN dp ON dn.doc_id = dp.doc_id),
db AS (SELECT *, CASE WHEN e - 1 > s THEN pos[e - 1] + 1 WHEN e - 1 = s AND (pos[s + 1] IS NULL OR pos[s + 1] <> i0) THEN i0 + 1 END AS i1 FROM da),
dec AS (SELECT doc_id, s, e, CASE WHEN good THEN substring(text, i0 + 1, i1 - i0) END AS text, CASE WHEN good THEN i0 END AS i0, CASE WHEN good THEN i1 END AS i1
  FROM (SELECT *, i0 < size AND i1 < size AS good FROM db))"""


def _longest(source: str) -> str:
    """``kept``: of the passages ``cluster_id, doc_id, s, e`` of a table the longest of each overlap group."""
    return f"""
o0 AS (SELECT DISTINCT cluster_id, doc_id, s, e FROM {source}),
o1 AS (SELECT *, row_number() OVER (PARTITION BY cluster_id, doc_id ORDER BY s, e DESC) AS rn FROM o0),
o2 AS (SELECT a.cluster_id, a.doc_id, a.rn, min(b.rn) AS nxt FROM o1 a LEFT JOIN o1 b ON a.cluster_id = b.cluster_id AND a.doc_id = b.doc_id AND b.rn > a.rn AND b.s >= a.e GROUP BY a.cluster_id, a.doc_id, a.rn),
o3 AS (SELECT * FROM o2 WHERE rn = 1 UNION ALL SELECT o2.* FROM o3 JOIN o2 ON o2.cluster_id = o3.cluster_id AND o2.doc_id = o3.doc_id AND o2.rn = o3.nxt),
o4 AS (SELECT o1.*, row_number() OVER (PARTITION BY o3.cluster_id, o3.doc_id, o3.rn ORDER BY o1.e - o1.s DESC, o1.rn) AS k
  FROM o1 JOIN o3 ON o1.cluster_id = o3.cluster_id AND o1.doc_id = o3.doc_id AND o1.rn >= o3.rn AND (o3.nxt IS NULL OR o1.rn < o3.nxt)),
kept AS (SELECT cluster_id, doc_id, s, e FROM o4 WHERE k = 1)"""


def _combined(links: str, columns: str) -> str:
    """Old clusters ``u``, new clusters ``m`` and links ``lk`` as merged clusters."""
    return f"""
WITH RECURSIVE {_HITS}, {_NODE}, {_UNFILLED}, m AS (SELECT regexp_replace(cluster_id, '^cluster_', 'new_') AS cluster_id, doc_id, s, e FROM hn),
{links}, ch AS (SELECT new_cluster, min(old_cluster) AS old_cluster FROM lk WHERE new_cluster IS NOT NULL AND old_cluster IS NOT NULL GROUP BY new_cluster),
touched AS (SELECT DISTINCT old_cluster FROM ch WHERE new_cluster IN (SELECT cluster_id FROM m)),
pool AS (SELECT *, 'old' AS origin FROM u WHERE cluster_id IN (SELECT old_cluster FROM touched)
  UNION ALL SELECT old_cluster, doc_id, s, e, 'new' FROM m JOIN ch ON m.cluster_id = ch.new_cluster WHERE old_cluster IN (SELECT cluster_id FROM u)),
{_longest('pool')},
merged AS (SELECT cluster_id, doc_id, s, e, max(origin) AS origin FROM pool JOIN kept USING (cluster_id, doc_id, s, e) GROUP BY cluster_id, doc_id, s, e)
SELECT {columns} FROM (SELECT * FROM merged UNION ALL SELECT *, 'old' FROM u WHERE cluster_id NOT IN (SELECT old_cluster FROM touched)
UNION ALL SELECT 'later_' || cluster_id, doc_id, s, e, 'new' FROM m WHERE cluster_id NOT IN (SELECT new_cluster FROM ch))
"""


def _runs(texts: str, on: str, keep: str = "") -> str:
    """Exact runs between the texts ``doc_id, enc`` of a table that agree on further columns."""
    same = "".join(f" AND a.{c} = b.{c}" for c in on.split())
    more = "".join(f", {c}" for c in on.split())
    return f"""
k AS (SELECT doc_id{more}, CAST(i AS INT) AS at, substring(enc, i, {KMER}) AS kmer FROM (SELECT doc_id{more}, enc, unnest(range(1, length(enc) - {KMER} + 2)) AS i FROM {texts} WHERE length(enc) >= {KMER})),
p AS (SELECT a.doc_id AS q_id, b.doc_id AS h_id, a.at AS q, b.at - a.at AS d FROM k a JOIN k b ON a.kmer = b.kmer AND a.doc_id < b.doc_id{same}),
g AS (SELECT *, q - row_number() OVER (PARTITION BY q_id, h_id, d ORDER BY q) AS island FROM p),
x AS (SELECT q_id, h_id, d, min(q) AS q_start, CAST(count(*) + {KMER - 1} AS INT) AS length FROM g GROUP BY q_id, h_id, d, island)
SELECT q_id, h_id, q_start, q_start + length - 1 AS q_end, q_start + d AS h_start, q_start + d + length - 1 AS h_end, length FROM x WHERE length >= {LEAST_RUN}{keep}
"""


#: ``cen``: the passages of the alignments with their means, by the rule of merging one taker after another.
_CENTROIDS = """
al AS (SELECT * FROM hsp WHERE q_id <> h_id AND length BETWEEN 0 AND 100000 AND ppos >= 0),
ps AS (SELECT doc_id, s, e, count(*) AS n FROM (SELECT q_id AS doc_id, q_start AS s, q_end AS e FROM al UNION ALL SELECT h_id, h_start, h_end FROM al)
  WHERE doc_id IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL GROUP BY doc_id, s, e),
st AS (SELECT doc_id, 0 AS i, list({'s': s, 'e': e, 'n': n, 'z': e - s} ORDER BY s, e) AS x, list(0 ORDER BY s, e) AS own FROM ps GROUP BY doc_id
  UNION ALL SELECT doc_id, i + 1, x, CASE WHEN own[i + 1] > 0 THEN own ELSE list_transform(range(1, len(x) + 1), lambda k:
    CASE WHEN k = i + 1 THEN i + 1
      WHEN own[k] = 0 AND k > i + 1 AND k < coalesce(list_filter(range(i + 2, len(x) + 1), lambda j: own[j] = 0 AND x[j].s - least(x[i + 1].z, x[j].z) * (CAST(1 AS DOUBLE) - CAST(0.9 AS DOUBLE)) > x[i + 1].s)[1], len(x) + 1)
        AND greatest(x[i + 1].z, x[k].z) > 0 AND CAST(x[i + 1].e - x[k].s AS DOUBLE) / greatest(x[i + 1].z, x[k].z) > CAST(0.9 AS DOUBLE) THEN i + 1
      ELSE own[k] END) END FROM st WHERE i < len(x)),
ow AS (SELECT doc_id, unnest(x) AS p, unnest(own) AS o FROM st WHERE i = len(x)),
cen AS (SELECT doc_id, p.s AS s, p.e AS e, CAST(trunc(CAST(sum(p.s * p.n) OVER w AS DOUBLE) / sum(p.n) OVER w) AS INT) AS cs, CAST(trunc(CAST(sum(p.e * p.n) OVER w AS DOUBLE) / sum(p.n) OVER w) AS INT) AS ce
  FROM ow WINDOW w AS (PARTITION BY doc_id, o))"""
_LINKS = f"""
lk AS (SELECT DISTINCT n.cluster_id AS new_cluster, o.cluster_id AS old_cluster FROM m n JOIN u o ON n.doc_id = o.doc_id
WHERE n.e > n.s AND o.e > o.s AND least(n.e, o.e) - greatest(n.s, o.s) > CAST(0.9 AS DOUBLE) * greatest(n.e - n.s, o.e - o.s))"""
_NODES_OF = "n.doc_id || '___' || n.s || '_' || n.e"
_META = " , ".join(f"""CASE WHEN {c} IS NOT NULL THEN '"{c}":' || {v} END""" for c, v in {c: f"CAST(to_json({c}) AS VARCHAR)" for c in ("lang", "source", "n_chars", "title", "issue_date")}.items())

SQL: dict[str, str] = {
    "doc_scan_nonempty": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, length(text) AS chars FROM documents WHERE text <> ''",
    "source_text_counts": "SELECT source, count(*) AS n_texts FROM documents WHERE text <> '' GROUP BY source",
    "split_blocks": f"""
SELECT doc_id || '__' || i || '_' || (i + {BLOCK}) AS block_id, doc_id, i AS block_start, least(i + {BLOCK}, length(text)) AS block_end, md5(substring(text, i + 1, {BLOCK})) AS text_md5
FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, unnest(range(0, length(text), {BLOCK})) AS i FROM documents WHERE text <> '')
""",
    "encode_eng": _encode("eng"),
    "encode_fin": _encode("fin"),
    "encode_eng_space": _encode("eng_space"),
    "encode_mask": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(regexp_replace(lower(text), '[^{_LETTERS}]', 'X', 'g')) AS mask_md5 FROM documents WHERE text <> ''",
    "decode_reverse": f"WITH {_ENC} SELECT doc_id, md5(translate(enc, '{ALPHABETS['eng'][1]}', '{_LETTERS}')) AS text_md5 FROM e",
    "preprocess": rf"SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(trim(regexp_replace(lower(text), '{_SPACE}', ' ', 'g'))) AS text_md5 FROM documents WHERE text <> ''",
    "gi_numbering": f"WITH {_ENC} SELECT doc_id AS block_id, row_number() OVER (ORDER BY doc_id) AS gi FROM e",
    "kmer_df": f"""
WITH {_ENC}, k AS (SELECT DISTINCT doc_id, substring(enc, i, {KMER}) AS kmer FROM (SELECT doc_id, enc, unnest(range(1, length(enc) - {KMER} + 2)) AS i FROM e WHERE length(enc) >= {KMER})),
d AS (SELECT kmer, count(*) AS documents FROM k GROUP BY kmer) SELECT documents, count(*) AS kmers FROM d GROUP BY documents
""",
    "shared_kmer_pairs": f"""
WITH {_ENC}, k AS (SELECT DISTINCT doc_id, substring(enc, i, {SHARED_KMER}) AS kmer FROM (SELECT doc_id, enc, unnest(range(1, length(enc) - {SHARED_KMER} + 2)) AS i FROM r WHERE length(enc) >= {SHARED_KMER}))
SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, count(*) AS shared FROM k a JOIN k b ON a.kmer = b.kmer AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
""",
    "maximal_exact_runs": f"WITH {_ENC}, {_runs('r', '')}",
    "search_exact_runs": f"WITH {_ENC}, s AS (SELECT r.doc_id FROM r JOIN e ON r.enc = e.enc WHERE CAST(e.doc_id AS BIGINT) % 20 = 0), {_runs('r', '', ' AND (q_id IN (SELECT doc_id FROM s) OR h_id IN (SELECT doc_id FROM s))')}",
    "within_cluster_runs": f"WITH {_HITS}, c AS (SELECT hit_id AS doc_id, cluster_id, {_enc('eng')} AS enc FROM h WHERE cluster_id IS NOT NULL AND text IS NOT NULL), {_runs('c', 'cluster_id')}",
    "hsp_filters": f"SELECT * FROM hsp WHERE q_id <> h_id AND length BETWEEN {BOUNDS['min_length']} AND {BOUNDS['max_length']} AND ppos >= {100 * BOUNDS['min_score']} AND {_RANGES}",
    "hsp_passages": "SELECT doc_id, s, e, count(*) AS n FROM (SELECT q_id AS doc_id, q_start AS s, q_end AS e FROM hsp UNION ALL SELECT h_id, h_start, h_end FROM hsp) GROUP BY doc_id, s, e",
    "node_merge_pairs": """
WITH p AS (SELECT DISTINCT * FROM (SELECT q_id AS doc_id, q_start AS s, q_end AS e FROM hsp UNION ALL SELECT h_id, h_start, h_end FROM hsp) WHERE doc_id IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL)
SELECT a.doc_id, a.s AS s1, a.e AS e1, b.s AS s2, b.e AS e2 FROM p a JOIN p b ON a.doc_id = b.doc_id AND (b.s > a.s OR (b.s = a.s AND b.e > a.e))
WHERE NOT (b.s - least(a.e - a.s, b.e - b.s) * (CAST(1 AS DOUBLE) - CAST(0.9 AS DOUBLE)) > a.s) AND CAST(a.e - b.s AS DOUBLE) / nullif(greatest(a.e - a.s, b.e - b.s), 0) > CAST(0.9 AS DOUBLE)
""",
    "connected_components": f"WITH RECURSIVE {_NAMES} SELECT node, component FROM c",
    "component_numbers": f"WITH RECURSIVE {_NAMES}, k AS (SELECT component, row_number() OVER (ORDER BY component) - 1 AS i FROM (SELECT DISTINCT component FROM c)) SELECT node, 'cluster_' || i AS cluster_id FROM c JOIN k USING (component)",
    "cluster_average_length": f"WITH {_UNFILLED} SELECT cluster_id, count(*) AS nodes, CAST(floor(CAST(sum(e - s) AS DOUBLE) / count(*)) AS INT) AS avg_len FROM u GROUP BY cluster_id",
    "unique_hits": f"WITH {_HITS} SELECT hit_id, cluster_id, doc_id, node, written_at FROM h",
    "fill_text_spans": f"""
WITH sides AS (SELECT src.doc_id AS doc_id, src.s AS s, src.e AS e FROM edges UNION ALL SELECT dst.doc_id, dst.s, dst.e FROM edges), {_decoded('sides')}
SELECT doc_id, s, e, coalesce(md5(text), '') AS text_md5, CAST(coalesce(i0, -1) AS INT) AS i0, CAST(coalesce(i1, -1) AS INT) AS i1 FROM dec
""",
    "alignment_texts": f"""
WITH sides AS (SELECT q_id AS doc_id, q_start AS s, q_end AS e FROM hsp UNION ALL SELECT h_id, h_start, h_end FROM hsp), {_decoded('sides')}
SELECT hsp.*, a.text AS q_text, b.text AS h_text FROM hsp LEFT JOIN dec a ON q_id = a.doc_id AND q_start = a.s AND q_end = a.e LEFT JOIN dec b ON h_id = b.doc_id AND h_start = b.s AND h_end = b.e
""",
    "filled_clusters": f"""
WITH {_UNFILLED}, {_decoded('u')},
f AS (SELECT u.cluster_id, u.doc_id || '___' || u.s || '_' || u.e AS node, dec.text, dec.i0, dec.i1, coalesce(d.title, '') AS title, coalesce(d.issue_date, '') AS issue_date
  FROM u JOIN dec USING (doc_id, s, e) LEFT JOIN documents d ON u.doc_id = CAST(d.doc_id AS VARCHAR))
SELECT cluster_id, CAST(floor(avg(length(text))) AS INT) AS length, count(text) AS n_hits, count(*) - count(text) AS n_skips,
  md5(coalesce(string_agg(CASE WHEN text IS NOT NULL THEN concat_ws('|', node, i0, i1, title, issue_date, text) END, chr(10) ORDER BY concat_ws('|', node, i0, i1, title, issue_date, text)), '')) AS hits_md5,
  md5(coalesce(string_agg(CASE WHEN text IS NULL THEN node END, chr(10) ORDER BY node), '')) AS skips_md5
FROM f GROUP BY cluster_id
""",
    "filled_files": f"WITH {_UNFILLED}, {_decoded('u')} SELECT cluster_id, doc_id || '___' || s || '_' || e AS node FROM u JOIN dec USING (doc_id, s, e) WHERE text IS NOT NULL",
    "merged_files": f"""
WITH {_UNFILLED}, {_decoded('u')}, f AS (SELECT cluster_id, doc_id || '___' || s || '_' || e AS node, regexp_matches(cluster_id, '[05]$') AS fresh FROM u JOIN dec USING (doc_id, s, e) WHERE text IS NOT NULL)
SELECT CASE WHEN fresh THEN 'later' ELSE 'old' END AS part, CASE WHEN fresh THEN 'later_' || cluster_id ELSE cluster_id END AS cluster_id, node FROM f
""",
    "cluster_files": f"WITH {_UNFILLED} SELECT cluster_id, {_NODES_OF} AS node FROM u n",
    "unfilled_clusters": f"WITH {_UNFILLED} SELECT cluster_id, string_agg({_NODES_OF}, ',' ORDER BY CAST(doc_id AS BIGINT), s, e) AS nodes, CAST(floor(CAST(sum(e - s) AS DOUBLE) / count(*)) AS INT) AS avg_len FROM u n GROUP BY cluster_id",
    "cluster_deoverlap": f"WITH RECURSIVE {_UNFILLED}, {_longest('u')} SELECT cluster_id, doc_id, s, e FROM kept",
    "combined_hits": _combined("lk AS (SELECT * FROM links)", "cluster_id, doc_id, s, e, origin"),
    "merged_batch": _combined(_LINKS, "cluster_id, doc_id, s, e"),
    "doc_metadata": f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, '{{' || concat_ws(',', {_META}, '"ingested_at":"' || strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%g') || '"') || '}}' AS meta FROM documents""",
    "documents_read": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS text_md5, title FROM documents WHERE text <> ''",
    "sources_read": "SELECT source, CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS text_md5 FROM (SELECT doc_id, text FROM documents WHERE text <> '') CROSS JOIN (SELECT unnest(['first', 'second']) AS source)",
    "latest_nodes": "SELECT node, hit_id FROM (SELECT node, hit_id, row_number() OVER (PARTITION BY node ORDER BY written_at DESC, hit_id DESC) AS rn FROM cluster_hits WHERE node IS NOT NULL) WHERE rn = 1",
    "text_count": "SELECT count(*) AS n_texts FROM documents WHERE text <> ''",
    "ascii_ids": r"SELECT CAST(doc_id AS VARCHAR) AS doc_id, regexp_replace(title, '[^\x00-\x7F]', '', 'g') AS ascii_title FROM documents",
    "old_node_ids": rf"""
WITH {_HITS}, n AS (SELECT hit_id, coalesce(lang, 'und') || '_x_' || node AS name FROM h WHERE node IS NOT NULL),
b AS (SELECT hit_id, CASE WHEN contains(name, '___') THEN regexp_extract(name, '^(.*?)___', 1) ELSE name END AS base, CASE WHEN contains(name, '___') THEN regexp_extract(name, '^.*___(.*)$', 1) ELSE name END AS span FROM n)
SELECT hit_id, regexp_replace(base, '^([^_]*)_([^_]*)_([^_]*)$', '\1__\2_\3') || '___' || span AS node_id FROM b
""",
    "custom_alphabet": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(enc) AS enc_md5 FROM (SELECT doc_id, translate(regexp_replace(lower(text), '[^aeiou]', '', 'g'), 'aeiou', 'AEIHY') AS enc FROM documents WHERE text <> '') WHERE enc <> ''",
    "soft_mask": f"SELECT doc_id, md5(replace(enc, 'D', 'd')) AS enc_md5 FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_enc('eng_space')} AS enc FROM documents WHERE text <> '') WHERE enc <> ''",
    "block_coordinates": "SELECT q_id, h_id, q_start, q_end, h_start, h_end, length, ppos FROM hsp",
    "report_files": "SELECT q_id, h_id, q_start, q_end, h_start, h_end, length, ppos FROM hsp WHERE q_id IS NOT NULL AND h_id IS NOT NULL AND q_start IS NOT NULL AND q_end IS NOT NULL AND h_start IS NOT NULL AND h_end IS NOT NULL AND length IS NOT NULL AND ppos IS NOT NULL",
    "fasta_lines": f"WITH {_ENC}, n AS (SELECT doc_id, enc, row_number() OVER (ORDER BY doc_id) AS gi FROM e) SELECT md5('>gi|' || gi || ' ' || doc_id) AS line_md5 FROM n UNION ALL SELECT md5(enc) FROM n",
    "link_files": "SELECT new_cluster, old_cluster FROM links WHERE new_cluster IS NOT NULL AND old_cluster IS NOT NULL",
    "not_done": "SELECT cluster_id, avg_len FROM clusters_unfilled WHERE cluster_id NOT IN (SELECT cluster_id FROM clusters_unfilled WHERE avg_len < 300 AND cluster_id IS NOT NULL)",
    "inspection": f"WITH {_HITS}, s AS (SELECT cluster_id, length(coalesce(text, '')) AS chars, count(*) OVER (PARTITION BY cluster_id) AS n, row_number() OVER (PARTITION BY cluster_id ORDER BY length(coalesce(text, '')) DESC) - 1 AS place FROM h WHERE cluster_id IS NOT NULL) SELECT cluster_id, place, chars FROM s WHERE n BETWEEN 2 AND 50",
    "counted_hits": rf"""
WITH {_HITS}, n AS (SELECT cluster_id, node FROM h WHERE cluster_id IS NOT NULL)
SELECT DISTINCT 'fin' AS kind, cluster_id FROM n WHERE NOT contains(node, 'xml') UNION ALL SELECT DISTINCT 'america', cluster_id FROM n UNION ALL SELECT DISTINCT 'numbers', cluster_id FROM n WHERE regexp_matches(node, '^[0-9]')
""",
    "edge_mapping": """
SELECT DISTINCT q_id || '___' || (q_start // 10 * 10) || '_' || (q_end // 10 * 10) AS src, h_id || '___' || (h_start // 10 * 10) || '_' || (h_end // 10 * 10) AS dst FROM hsp
WHERE q_id IS NOT NULL AND h_id IS NOT NULL AND q_start IS NOT NULL AND q_end IS NOT NULL AND h_start IS NOT NULL AND h_end IS NOT NULL
""",
    "first_texts": "SELECT substring(CAST(doc_id AS VARCHAR), 1, 3) || '_' || substring(CAST(doc_id AS VARCHAR), 4) AS doc_id, md5(CASE WHEN doc_id % 3 = 0 THEN lower(text) ELSE text END) AS text_md5 FROM documents WHERE text <> ''",
    "whole_components": f"""
WITH RECURSIVE {_NAMES}, i AS (SELECT component, row_number() OVER (ORDER BY component) - 1 AS i FROM (SELECT DISTINCT component FROM c)),
w AS (SELECT DISTINCT src.doc_id AS doc_id, src.s AS s, src.e AS e FROM edges UNION SELECT DISTINCT dst.doc_id, dst.s, dst.e FROM edges)
SELECT 'cluster_' || i AS cluster_id, doc_id, s, e FROM c JOIN i USING (component) JOIN w ON c.node = w.doc_id || '___' || w.s || '_' || w.e
""",
    "star_edges": f"""
WITH {_UNFILLED}, f AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY CAST(doc_id AS BIGINT), s, e) AS rn FROM u)
SELECT a.doc_id || '___' || a.s || '_' || a.e AS src, b.doc_id || '___' || b.s || '_' || b.e AS dst FROM f a JOIN u b ON a.rn = 1 AND a.cluster_id = b.cluster_id AND NOT (a.doc_id = b.doc_id AND a.s = b.s AND a.e = b.e)
""",
    "node_centroids": f"WITH RECURSIVE {_CENTROIDS} SELECT doc_id, s, e, cs, ce FROM cen",
    "clusters_from_hsp": f"""
WITH RECURSIVE {_CENTROIDS},
ed AS (SELECT DISTINCT a.doc_id AS da, a.cs AS sa, a.ce AS ea, b.doc_id AS db, b.cs AS sb, b.ce AS eb FROM al JOIN cen a ON q_id = a.doc_id AND q_start = a.s AND q_end = a.e JOIN cen b ON h_id = b.doc_id AND h_start = b.s AND h_end = b.e),
n AS (SELECT da || '___' || sa || '_' || ea AS a, db || '___' || sb || '_' || eb AS b FROM ed),
sym AS (SELECT a, b FROM n UNION SELECT b, a FROM n),
reach(node, other) AS (SELECT a, a FROM sym UNION SELECT r.node, x.b FROM reach r JOIN sym x ON x.a = r.other),
c AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
i AS (SELECT component, row_number() OVER (ORDER BY component) - 1 AS i FROM (SELECT DISTINCT component FROM c)),
w AS (SELECT da AS doc_id, sa AS s, ea AS e FROM ed UNION SELECT db, sb, eb FROM ed),
mem AS (SELECT 'cluster_' || i AS cluster_id, doc_id, s, e FROM c JOIN i USING (component) JOIN w ON c.node = w.doc_id || '___' || w.s || '_' || w.e),
{_longest('mem')}
SELECT cluster_id, doc_id, s, e FROM kept
""",
    "node_index": f"WITH {_UNFILLED} SELECT doc_id, count(*) AS nodes, count(DISTINCT cluster_id) AS clusters FROM u GROUP BY doc_id",
    "separation_candidates": f"WITH {_HITS}, n AS (SELECT *, count(*) OVER (PARTITION BY cluster_id) AS n FROM h WHERE cluster_id IS NOT NULL AND text IS NOT NULL) SELECT cluster_id, hit_id FROM n WHERE n BETWEEN 3 AND 20",
    "levenshtein_pairs": f"""
WITH {_HITS}, n AS (SELECT hit_id, cluster_id, length(text) AS size, {_enc('eng')} AS enc FROM h WHERE cluster_id IS NOT NULL AND text IS NOT NULL)
SELECT a.hit_id AS hit_a, b.hit_id AS hit_b, levenshtein(a.enc, b.enc) AS distance FROM n a JOIN n b ON a.cluster_id = b.cluster_id AND a.hit_id < b.hit_id
WHERE a.enc <> '' AND b.enc <> '' AND a.size * CAST(0.75 AS DOUBLE) <= b.size AND levenshtein(a.enc, b.enc) <= floor(length(a.enc) * CAST(0.25 AS DOUBLE))
""",
    "cluster_metadata_join": f"WITH {_HITS} SELECT h.hit_id, h.doc_id, d.title, d.source, d.lang FROM h LEFT JOIN documents d ON h.doc_id = CAST(d.doc_id AS VARCHAR)",
    "cluster_size_filter": f"WITH {_HITS} SELECT cluster_id, count(*) AS hits, CAST(floor(avg(length(text))) AS INT) AS length FROM h WHERE cluster_id IS NOT NULL GROUP BY cluster_id HAVING count(*) > 3",
    "interval_links": f"""
WITH {_HITS}, {_NODE}, {_UNFILLED}
SELECT DISTINCT n.cluster_id AS new_cluster, o.cluster_id AS old_cluster FROM hn n JOIN u o ON n.doc_id = o.doc_id
WHERE n.e > n.s AND o.e > o.s AND least(n.e, o.e) - greatest(n.s, o.s) > CAST(0.9 AS DOUBLE) * greatest(n.e - n.s, o.e - o.s)
""",
    "link_choice": "SELECT new_cluster, min(old_cluster) AS old_cluster FROM links WHERE new_cluster IS NOT NULL AND old_cluster IS NOT NULL GROUP BY new_cluster",
    "unlinked_new": f"""
WITH {_HITS}, {_NODE}, m AS (SELECT DISTINCT regexp_replace(cluster_id, '^cluster_', 'new_') AS cluster_id FROM hn)
SELECT 'later_' || cluster_id AS cluster_id FROM m WHERE cluster_id NOT IN (SELECT new_cluster FROM links WHERE new_cluster IS NOT NULL AND old_cluster IS NOT NULL)
""",
    "p5_found": r"""
WITH h AS (
  SELECT coalesce(doc_id, nullif(regexp_extract(node, '^\s*(.*?)___', 1), '')) AS doc_id,
    CASE WHEN len(encoded_indices) = 2 THEN try_cast(trim(encoded_indices[1]) AS INT) END AS e1,
    CASE WHEN len(encoded_indices) = 2 THEN try_cast(trim(encoded_indices[2]) AS INT) END AS e2,
    try_cast(nullif(regexp_extract(node, '___\s*(\d+)_(\d+)\s*$', 1), '') AS INT) AS n1,
    try_cast(nullif(regexp_extract(node, '___\s*(\d+)_(\d+)\s*$', 2), '') AS INT) AS n2
  FROM cluster_hits),
w AS (SELECT doc_id, CASE WHEN e1 IS NOT NULL AND e2 IS NOT NULL THEN e1 ELSE n1 END AS a,
        CASE WHEN e1 IS NOT NULL AND e2 IS NOT NULL THEN e2 ELSE n2 END AS b FROM h),
spans AS (SELECT DISTINCT doc_id, least(a, b) AS s, greatest(a, b) AS e FROM w WHERE doc_id IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL),
m AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM spans),
i AS (SELECT *, sum(CASE WHEN before >= s THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m),
p AS (SELECT doc_id, island, min(s) AS s, max(e) AS e FROM i GROUP BY doc_id, island),
g AS (SELECT doc_id, lag(e) OVER (PARTITION BY doc_id ORDER BY s) AS s, s AS e FROM p)
SELECT doc_id, 'period' AS span_kind, s, e FROM p UNION ALL SELECT doc_id, 'gap', s, e FROM g WHERE s IS NOT NULL
""",
}
