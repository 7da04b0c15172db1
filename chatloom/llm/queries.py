"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, collocations, decontaminate, exact_dedup, html_text, jaccard_join, license_scan, line_dedup, mixing, secrets, sharding, source_audit, toxicity
from ._common import table


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_report(table(spark, sf_dir, "pages"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.component_report(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.radix_groups(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.conversation_report(table(spark, sf_dir, "conversations"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence(table(spark, sf_dir, "documents"))


def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LOWER_X = "translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_TEMPLATES = ", ".join(f"({i}, '{name}', '{text}', {base})" for i, (name, text, base) in enumerate(license_scan.default_templates()))

#: SQL twins: the definitions of the results, not the methods. The hashes that order op3's and op5's rows, op1's entropy spans,
#: op4's parser, op7's models and op10's windows have no short SQL form; these are held against brute force in the tests.
ORACLE: dict[str, str] = {
    "op2_line_dedup": rf"""WITH t AS (SELECT doc_id, string_split(lower(regexp_replace(coalesce(text, ''), '[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+', ' ', 'g')), chr(10)) AS ls FROM documents),
 l AS (SELECT doc_id, unnest(range(len(ls))) AS line_no, trim(unnest(ls), ' ') AS line FROM t), s AS (SELECT *, string_split(line, ' ') AS w FROM l WHERE line <> ''),
 u AS (SELECT line, min((doc_id, line_no)) AS first, any_value(w) AS w FROM s GROUP BY line),
 v AS (SELECT line, first, unnest(range(1, len(w) + 1)) AS i, unnest(list_transform(range(1, len(w) + 1), lambda i: array_to_string(w[:i - 1] || w[i + 1:], ' '))) AS vk FROM u WHERE len(w) >= 5),
 g AS (SELECT vk, i, min(first) AS a FROM v GROUP BY vk, i),
 dead AS (SELECT v.line FROM v JOIN g ON v.vk = g.vk AND v.i = g.i WHERE g.a < v.first UNION SELECT v.line FROM v JOIN u ON v.vk = u.line WHERE u.first < v.first
 UNION SELECT u.line FROM v JOIN u ON v.vk = u.line WHERE v.first < u.first),
 f AS (SELECT s.doc_id, s.line_no, s.line IN (SELECT line FROM dead) AS near, (s.doc_id, s.line_no) <> u.first AS copy FROM s JOIN u ON s.line = u.line),
 d AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE copy AND NOT near) AS c, count(*) FILTER (WHERE near) AS m, string_agg(line_no, ',' ORDER BY line_no) FILTER (WHERE near OR copy) AS gone FROM f GROUP BY doc_id)
SELECT t.doc_id, coalesce(n, 0) AS n_lines, coalesce(c, 0) AS n_copies, coalesce(m, 0) AS n_near, coalesce(gone, '') AS dropped FROM t LEFT JOIN d ON t.doc_id = d.doc_id""",
    "op6_jaccard_join": rf"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
 l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
 r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a), m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN m ON d.doc_id = m.a""",
    "op8_exact_dedup": r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
 r AS (SELECT doc_id, chars, norm, count(*) OVER (PARTITION BY norm) AS n, first_value(doc_id) OVER w AS keep_id, first_value(chars) OVER w AS best
 FROM d WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, n AS group_size, chars = best AND doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM r""",
    "op9_decontamination": rf"""WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents), b AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_ALNUM} AS w FROM benchmark) WHERE len(w) > 0),
 win AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g FROM b),
 x AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g FROM d JOIN (SELECT DISTINCT n FROM win) ON len(w) >= n),
 h AS (SELECT x.doc_id, x.i, x.n, item_id FROM x JOIN win ON x.n = win.n AND x.g = win.g), q AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
 k AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
 FROM d LEFT JOIN q ON d.doc_id = q.doc_id LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op11_source_divergence": rf"""WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: {_LOWER_X}) AS w FROM documents),
 o AS (SELECT lang, source, unnest(w) AS term FROM d), t AS (SELECT lang, unnest(list_distinct(w)) AS term FROM d),
 k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(*) >= 10), v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
 c AS (SELECT lang, source, term, count(*) AS c FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
 g AS (SELECT lang, source, coalesce(sum(c), 0) + 2 * coalesce(any_value(v), 0) AS d FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) LEFT JOIN v USING (lang) GROUP BY lang, source),
 l AS (SELECT lang, term, sum(c) AS c, sum(sum(c)) OVER (PARTITION BY lang) + 2 * any_value(v) AS d FROM c JOIN v USING (lang) GROUP BY lang, term),
 p AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS n, CAST(1 + 1000000000 * (CAST(coalesce(c, 0) AS HUGEINT) + 2) // CAST(d AS HUGEINT) AS BIGINT) AS p FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
 q AS (SELECT lang, term, CAST(1 + 1000000000 * (CAST(c AS HUGEINT) + 2) // CAST(d AS HUGEINT) AS BIGINT) AS q FROM l),
 s AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
 a AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source),
 b AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM a UNION ALL SELECT * FROM b))
SELECT * FROM r WHERE part = 'pair' OR rank <= 10""",
    "op12_license_scans": rf"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_ALNUM} AS w FROM documents),
 t AS (SELECT id, label, base, w, len(w) AS size, CASE WHEN len(w) >= 4 THEN 4 ELSE 2 END AS k FROM (SELECT id, label, base, string_split(text, ' ') AS w FROM (VALUES {_TEMPLATES}) v(id, label, text, base))),
 tg AS (SELECT * EXCLUDE (w), unnest(range(0, size - k + 1)) AS j, unnest(list_transform(range(1, size - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM t),
 dg AS (SELECT row, k, unnest(range(0, len(w) - k + 1)) AS i, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM d JOIN (VALUES (2), (4)) v(k) ON len(w) >= k),
 h AS (SELECT DISTINCT row, id, label, base, size, tg.k, i - j AS diag, j FROM dg JOIN tg ON dg.g = tg.g AND dg.k = tg.k),
 x AS (SELECT *, diag - lag(diag) OVER (PARTITION BY row, id ORDER BY diag) > CASE WHEN base THEN 0 ELSE least(3, size // 4) END AS apart FROM (SELECT DISTINCT row, id, base, size, diag FROM h)),
 y AS (SELECT row, id, diag, sum(CASE WHEN coalesce(apart, true) THEN 1 ELSE 0 END) OVER (PARTITION BY row, id ORDER BY diag) AS span FROM x),
 c AS (SELECT row, id, label, base, size, span, diag, unnest(range(j, j + k)) AS p FROM h JOIN y USING (row, id, diag)),
 s AS (SELECT row, label, base, min(diag) AS place, count(DISTINCT p) / size AS share FROM c GROUP BY row, id, label, base, size, span)
SELECT any_value(doc_id) AS doc_id, any_value(len(w)) AS n_words, count(*) FILTER (WHERE base) AS n_base, min(place) FILTER (WHERE base) AS first_word, max(place) FILTER (WHERE base) AS last_word,
 coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base OR share >= 0.6), '') AS labels, coalesce(max(share), 0.0::DOUBLE) AS score
 FROM d LEFT JOIN s USING (row) GROUP BY row""",
    "op13_collocations": rf"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
 w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p), m AS (SELECT unnest([1, 2, 3, 4, 5]) AS m),
 g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM w JOIN m ON len(w) >= m),
 f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100), t AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
 c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1),
 s AS (SELECT c.lang, c.m, c.phrase, c.a, k, x.a AS l, y.a AS r, n, (CAST(1000 AS HUGEINT) * c.a * n) // (CAST(x.a AS HUGEINT) * y.a) AS score
 FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[:k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ') JOIN t ON t.lang = c.lang),
 b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM s),
 i AS (SELECT lang, a, unnest(list_transform(range(1, m - j + 2), lambda i: array_to_string(w[i:i + j - 1], ' '))) AS phrase FROM (SELECT lang, m, a, string_split(phrase, ' ') AS w, unnest(range(2, m)) AS j FROM f WHERE m > 2)),
 o AS (SELECT * FROM b WHERE nth = 1 AND NOT EXISTS (SELECT 1 FROM i WHERE i.lang = b.lang AND i.phrase = b.phrase AND i.a >= b.a)),
 r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 2000""",
}

QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scans, op2_line_dedup, op3_mix_sources, op4_html_extraction, op5_sharding,
        op6_jaccard_join, op7_toxicity, op8_exact_dedup, op9_decontamination, op10_chat_format,
        op11_source_divergence, op12_license_scans, op13_collocations,
    )
}
