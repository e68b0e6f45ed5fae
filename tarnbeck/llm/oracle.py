"""The queries that SQL can express, in DuckDB's SQL."""

from __future__ import annotations

from .license_scan import GRAM, NEAR, WORD, template_rows

EXACT_DEDUP = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS rn,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS c FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.c = l.a),
c AS (SELECT a, min(c) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

NGRAM_JOIN = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE p.c >= 0.8 * (x.n + y.n - p.c) - 1e-9),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.c = l.a),
c AS (SELECT a, min(c) AS class_id FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT doc_id, coalesce(n_links, 0) AS n_links, class_id, doc_id = class_id AS kept, md5(text) AS md5
FROM documents JOIN c ON c.a = doc_id LEFT JOIN k ON k.a = doc_id
"""

_GRAMS = ", ".join("('{}', {}, {}, {}, {}, {}, {}, '{}', {})".format(*r) for r in template_rows())
_PER = ", ".join(f"any_value({c}) AS {c}" for c in ("k", "grams", "size", "need", "label", "base"))
LICENSE_SCAN = f"""
WITH t(gram, template, k, place, grams, size, need, label, base) AS (VALUES {_GRAMS}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
p AS (SELECT doc_id, i - 1 AS pos, w[i : i + 1] AS two, w[i : i + {GRAM - 1}] AS four FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)),
g AS (SELECT doc_id, pos, array_to_string(two, ' ') AS gram, 2 AS k FROM p UNION ALL SELECT doc_id, pos, array_to_string(four, ' '), {GRAM} FROM p WHERE len(four) = {GRAM}),
v AS (SELECT doc_id, template, pos - place AS diagonal, list(DISTINCT place) AS votes, {_PER} FROM g JOIN t USING (gram, k) GROUP BY doc_id, template, pos - place),
b AS (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= {NEAR} AS joins FROM v),
x AS (SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM b),
c AS (SELECT doc_id, template, span, flatten(list(votes)) AS votes, count(*) FILTER (len(votes) = grams) AS places, min(diagonal) FILTER (len(votes) = grams) AS f, max(diagonal) FILTER (len(votes) = grams) AS l, {_PER}
      FROM x GROUP BY doc_id, template, span),
s AS (SELECT *, len(list_distinct(flatten(list_transform(votes, lambda a: range(a, a + k))))) AS covered FROM c),
o AS (SELECT *, CASE WHEN base THEN places > 0 ELSE covered >= need END AS found FROM s),
a AS (SELECT doc_id, sum(places) FILTER (base) AS n_base, min(f) FILTER (base) AS f, max(l) FILTER (base) AS l, max(covered / size) FILTER (found) AS score,
        list_sort(list(DISTINCT label) FILTER (base AND places > 0)) AS bl, list_sort(list(DISTINCT label) FILTER (found)) AS al FROM o GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, f AS first_word, l AS last_word, coalesce(array_to_string(bl, ','), '') AS base_labels,
       coalesce(array_to_string(al, ','), '') AS labels, coalesce(score, 0.0)::DOUBLE AS score FROM d LEFT JOIN a USING (doc_id)
"""

#: For pages whose article is one element of h1, p, b and br, as those of the tables are.
_ENTITIES = (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#x27;", "''"), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"))
_TEXT = "regexp_replace(b, '</?b>', '', 'g')"
_TEXT = f"regexp_replace({_TEXT}, '<br>', ' ', 'g')"
for _e, _c in _ENTITIES:
    _TEXT = f"replace({_TEXT}, '{_e}', '{_c}')"
_TEXT = f"trim(regexp_replace(regexp_replace({_TEXT}, '&amp;?', '&', 'g'), '\\s+', ' ', 'g'))"
HTML_TEXT = f"""
WITH x AS (SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(?:p|h1)>'), lambda b: {_TEXT}), lambda b: b <> '') AS t FROM pages)
SELECT page_id, url, array_to_string(t, chr(10)) AS text, length(array_to_string(t, chr(10))) AS n_chars FROM x
"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * j + 1}, 5))::BIGINT >> {s}) & 31)::INTEGER + 1, 1)" for j in range(8) for s in (15, 10, 5, 0)
)
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first FROM p)
SELECT page_id, octet_length(encode(x)) AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM f
"""

SQL = {
    "op1_ngram_join": NGRAM_JOIN,
    "op3_embedding_dedup": EMBEDDING_DEDUP,
    "op4_license_scan": LICENSE_SCAN,
    "op6_exact_dedup": EXACT_DEDUP,
    "op7_html_text": HTML_TEXT,
    "op8_warc": WARC,
}
