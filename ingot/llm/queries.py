"""The queries of the operators and their DuckDB SQL, for the entry module."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ingot.llm.common import table
from ingot.llm.counts import token_counts
from ingot.llm.decontaminate import contamination
from ingot.llm.exact import exact_duplicates
from ingot.llm.mixing import mixture
from ingot.llm.neardup import near_duplicates
from ingot.llm.ranked import ranked
from ingot.llm.sharding import shards
from ingot.llm.suffixes import dedup
from ingot.llm.tokens import token_table
from ingot.llm.toxicity import toxicity
from ingot.llm.trie import conversation_trie
from ingot.llm.urls import RULES, SOFT, STRICT, judge
from ingot.llm.warc import archived

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"), 100)


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(table(spark, sf_dir, "documents"))


def op4_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_grace_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op7_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op8_minhash_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op9_prefix_sum_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"), 24)


def op10_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def op11_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_token_shards": op3_token_shards,
    "op4_entropy_mixing": op4_entropy_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_grace_exact_dedup": op6_grace_exact_dedup,
    "op7_trie_token_counts": op7_trie_token_counts,
    "op8_minhash_odd_sketch": op8_minhash_odd_sketch,
    "op9_prefix_sum_shards": op9_prefix_sum_shards,
    "op10_url_vocabulary": op10_url_vocabulary,
    "op11_warc_transactions": op11_warc_transactions,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_fp_tree_search": op13_fp_tree_search,
}

_WORDS = f"regexp_extract_all({LOWER.format('coalesce(text, chr(32))')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_HIT = "regexp_matches(u, '(^|[^a-z0-9])({})([^a-z0-9]|$)')"
_FITS = "((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
_BY_LENGTH = sorted(RULES, key=lambda r: (-len(r[0] + r[1]), -len(r[0])))
_RULE = "CASE " + " ".join(f"WHEN {_FITS.format(h=h, p=p)} THEN '{h}{p}'" for h, p, _ in _BY_LENGTH) + " END"
_VERDICT = "CASE rule " + " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in _BY_LENGTH)

_CRC = """(SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
           FROM (SELECT unnest(range(0, 256)) AS n))"""

SQL = {
    "op1_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hit AS (SELECT DISTINCT doc_id, item_id, dw.k, i FROM dw JOIN bw USING (k, g)),
n AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) FROM hit) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op2_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, 1000 * j AS o, substr(h, CAST(2000 * j + 1 AS BIGINT), 2198) AS h FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2000 + 1)) AS j FROM d)),
f AS (SELECT doc_id, o + i AS i, substr(h, 2 * i + 1, 200) AS x FROM (SELECT doc_id, o, h, unnest(range(0, least(1000, len(h) // 2 - 99))) AS i FROM c)),
p AS (SELECT doc_id, i, row_number() OVER (PARTITION BY hash(x), hash(x || '.') ORDER BY doc_id, i) AS k FROM f),
m AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM p WHERE k > 1),
g AS (SELECT doc_id, i, sum(CASE WHEN gap <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM m),
x AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY doc_id, s),
y AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM x),
k AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
             string_agg(substr(h, CAST(2 * z + 1 AS BIGINT), CAST(2 * (a - z) AS BIGINT)), '' ORDER BY a) AS head FROM y JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""",
    "op8_minhash_odd_sketch": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
e AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2)
      JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id, c = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM r GROUP BY 1) ON a = d.doc_id""",
    "op6_grace_exact_dedup": """
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS s FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY s ORDER BY points DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(s) AS text_sha256 FROM g""",
    "op9_prefix_sum_shards": """
WITH t AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
           FROM (SELECT unnest(range(0, 256)) AS n)),
b AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
d AS (SELECT doc_id, octet_length(raw) + 8 AS size,
             list_prepend(4294967295, list_transform(regexp_extract_all(hex(raw), '..'), lambda x: CAST('0x' || x AS BIGINT))) AS b FROM b),
c AS (SELECT doc_id, CAST(size AS BIGINT) AS size, xor(4294967295, list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS text_crc32 FROM d, t),
s AS (SELECT *, sum(size) OVER (ORDER BY doc_id) AS upto, sum(size) OVER () AS total FROM c),
h AS (SELECT *, CAST(least(23, (2 * upto - size) * 24 // (2 * total)) AS INTEGER) AS shard FROM s)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM h""",
    "op10_url_vocabulary": f"""
WITH h AS (SELECT page_id, {LOWER.format("coalesce(url, '')")} AS u,
                  {LOWER.format("coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')")} AS host,
                  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, {_RULE} AS rule, {" + ".join(f"CAST({_HIT.format(t)} AS BIGINT)" for t in STRICT)} AS n_strict,
             {" + ".join(f"CAST({_HIT.format(t)} AS BIGINT)" for t in SOFT)} AS n_soft FROM h)
SELECT page_id, host, path, rule, {_VERDICT} ELSE CASE WHEN n_strict >= 1 OR n_soft >= 2 THEN 'block' ELSE 'allow' END END AS verdict,
       n_strict, n_soft FROM r""",
    "op11_warc_transactions": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY 1)
SELECT page_id, n AS payload_bytes, sha256(p.h) AS payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, true AS intact, CAST(1 AS BIGINT) AS n_requests
FROM p LEFT JOIN f ON f.h = p.h AND n >= 100""",
    "op12_conversation_trie": f"""
WITH x AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x FROM conversations WHERE conv_id IS NOT NULL),
c AS {_CRC},
o AS (SELECT conv_id, list(x ORDER BY p) AS own, list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(CAST(conv_id AS VARCHAR))), '..'), lambda y: CAST('0x' || y AS BIGINT))) AS b FROM x GROUP BY conv_id),
h AS (SELECT conv_id, own, xor(4294967295, list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % 4 AS h FROM o, c),
r AS (SELECT h.conv_id, list_concat(CASE WHEN h.h > 0 THEN coalesce(b.own[1:h.h], []) ELSE [] END, h.own[h.h + 1:]) AS s FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 20),
n AS (SELECT conv_id, d, CASE WHEN d > 0 THEN s[1:d] ELSE [] END AS k, len(s) = d AS whole FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM r)),
g AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CASE WHEN whole THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends FROM n GROUP BY k, d),
u AS (SELECT CASE WHEN d > 1 THEN k[1:d - 1] ELSE [] END AS k, d - 1 AS d, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1, 2),
v AS (SELECT g.*, coalesce(n_children, 0) AS n_children, CASE WHEN g.d > 0 THEN (n_convs - 1) * len(regexp_extract_all(g.k[g.d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved FROM g LEFT JOIN u ON u.k = g.k AND u.d = g.d),
w AS (SELECT CASE WHEN e > 0 THEN k[1:e] ELSE [] END AS k, e AS d, sum(saved) AS saved_tokens, count_if(n_children = 0) AS n_leaves FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM v) GROUP BY 1, 2)
SELECT v.conv_id, v.d AS depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN w ON w.k = v.k AND w.d = v.d LEFT JOIN g q ON v.d > 0 AND q.d = v.d - 1 AND q.k = CASE WHEN v.d > 1 THEN v.k[1:v.d - 1] ELSE [] END""",
    "op13_fp_tree_search": f"""
WITH d AS (SELECT doc_id, unnest({_WORDS}) AS t FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1),
s AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM n),
tf AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY 1, 2),
i AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS t FROM benchmark),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM (SELECT t, count(*) AS df FROM tf GROUP BY 1), s WHERE t IN (SELECT t FROM i)),
m AS (SELECT doc_id, CAST(10 + (90 * n * n_docs) // n_terms AS BIGINT) AS m FROM n, s),
x AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM i JOIN w USING (t) JOIN tf USING (t) JOIN m USING (doc_id) GROUP BY 1, 2),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM x WHERE score > 0)
SELECT * FROM r WHERE rank <= 10""",
}
