"""The operators as queries over the given tables, and equivalent SQL where SQL can express them."""

from . import exact_dedup, langid, licenses, lines, minhash, mixing, packing, pii, tokens, topk, trie, urls, whitening
from .common import table

#: Wanted shares of the tokens by quality label, 1 being good text.
TARGETS = {"1": 0.95, "0": 0.05}

#: Rules for the urls: the verdict, then a host and the start of a path.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op1_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op2_pii(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op3_licenses(spark, sf_dir):
    return licenses.scan_corpus(table(spark, sf_dir, "documents"))


def op4_packing(spark, sf_dir):
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


def op5_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op6_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op7_token_counts(spark, sf_dir):
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def quality_labels(spark, sf_dir):
    return table(spark, sf_dir, "labels").selectExpr("doc_id", "cast(quality AS string) AS domain")


def op9_mixing(spark, sf_dir):
    rated = mixing.rates(table(spark, sf_dir, "documents"), quality_labels(spark, sf_dir), TARGETS, max_rate=1.0)
    return rated.withColumn("copies", mixing.copies(rated["rate"], rated["doc_id"]))


def op10_lines(spark, sf_dir):
    return lines.remove_boilerplate(table(spark, sf_dir, "documents"), site_col="source", min_sites=8)


def op11_trie(spark, sf_dir):
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32, scale=64.0, offset=1_000_000)


def op13_urls(spark, sf_dir):
    labelled = spark.createDataFrame(urls.labelled_urls(), "url string, label string")
    return urls.judge(table(spark, sf_dir, "pages"), urls.fit(labelled), URL_RULES)


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_pii": op2_pii,
    "op3_licenses": op3_licenses,
    "op4_packing": op4_packing,
    "op5_topk": op5_topk,
    "op6_langid": op6_langid,
    "op7_token_counts": op7_token_counts,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_mixing": op9_mixing,
    "op10_lines": op10_lines,
    "op11_trie": op11_trie,
    "op12_whitening": op12_whitening,
    "op13_urls": op13_urls,
}

#: The sequence of words and the sets of shingles as the contract has them; copies of a set are linked as one.
OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (
  SELECT doc_id, CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
sets AS (SELECT doc_id, list_sort(s) AS s, len(s) AS n FROM grams),
classes AS (SELECT min(doc_id) AS rep, s, any_value(n) AS n FROM sets WHERE n > 0 GROUP BY s),
items AS (SELECT rep, n, unnest(s) AS item FROM classes),
df AS (SELECT item, count(*) AS f FROM items GROUP BY item),
ranked AS (SELECT rep, n, i.item, row_number() OVER (PARTITION BY rep ORDER BY f, i.item) AS pos FROM items i JOIN df USING (item)),
prefix AS (SELECT rep, n, item FROM ranked WHERE pos <= n - (4 * n + 4) // 5 + 1),
pairs AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM prefix a JOIN prefix b USING (item)
  WHERE a.rep < b.rep AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
common AS (SELECT p.a, p.b, x.n + y.n AS both_n, len(list_intersect(x.s, y.s)) AS c
  FROM pairs p JOIN classes x ON p.a = x.rep JOIN classes y ON p.b = y.rep),
links AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (both_n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(root, node) AS (SELECT rep, rep FROM classes UNION SELECT r.root, e.b FROM reach r JOIN edges e ON r.node = e.a),
component AS (SELECT root, min(node) AS component_id FROM reach GROUP BY root)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id,
  d.doc_id = coalesce(m.component_id, d.doc_id) AS kept
FROM sets d LEFT JOIN classes k ON d.s = k.s AND d.n > 0 LEFT JOIN component m ON m.root = k.rep
"""

OP8_SQL = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS p FROM documents),
ranked AS (SELECT doc_id, p, first_value(doc_id) OVER (PARTITION BY p ORDER BY n DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY p) AS group_size FROM plain)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(p) AS text_sha256 FROM ranked
"""

OP5_SQL = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP10_SQL = r"""
WITH pieces AS (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, source, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM pieces),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM lines),
drop AS (SELECT key FROM bare WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= 8),
marked AS (SELECT b.*, d.key IS NOT NULL AS gone FROM bare b LEFT JOIN drop d ON b.key = d.key),
clean AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
    count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed FROM marked GROUP BY doc_id)
SELECT d.doc_id, c.text, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN clean c ON d.doc_id = c.doc_id
"""

#: CRC-32 bit by bit; a prefix is known by the digest of its turns as JSON.
OP11_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, c: list_reduce(range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(crc, c)),
    4294967295)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
parts AS (
  SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
rebuilt AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth FROM parts),
paths AS (
  SELECT conv_id, depth, length(text) AS chars, sha256(CAST(to_json(list(struct_pack(r := role, t := text)) OVER (
    PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS VARCHAR)) AS key FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
sizes AS (SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id),
nodes AS (
  SELECT key, depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE n = depth), '') AS ends
  FROM paths p JOIN sizes s ON p.conv_id = s.conv_id GROUP BY key, depth),
linked AS (
  SELECT n.*, p.key AS parent, q.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 LEFT JOIN nodes q ON q.key = p.key),
children AS (SELECT parent AS key, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent),
full_nodes AS (SELECT l.*, coalesce(c.n_children, 0) AS n_children FROM linked l LEFT JOIN children c ON l.key = c.key),
below AS (
  SELECT p.key, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.chars) AS saved
  FROM full_nodes f JOIN paths p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY p.key)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM full_nodes f JOIN below b ON f.key = b.key
"""

ORACLES = {
    "op1_minhash": OP1_SQL,
    "op5_topk": OP5_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op10_lines": OP10_SQL,
    "op11_trie": OP11_SQL,
}
