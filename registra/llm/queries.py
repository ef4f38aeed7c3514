"""The registered queries of this subpackage, and their SQL where SQL can express them.

Near-duplicate documents and vectors are SQL as a whole, by an exact join of all pairs that share something, and so are
URL filters, vector codes and the divergence of sources. Of the others SQL tells single columns, registered as queries of their own; tokenizers, learned models and hashes of lanes
are held against plain Python in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import common, fingerprints
from .bpe_codec import op3_bpe_codec
from .divergence import op13_source_divergence
from .embeddings import op6_embedding_near_dedup
from .fingerprints import op5_fingerprints
from .language_model import op2_lm_scoring
from .lines import op1_line_dedup
from .minhash import op4_minhash_near_dedup
from .packing import op10_packing
from .quality import op7_quality_classifier
from .substrings import op8_substring_dedup
from .token_counts import op9_token_counts
from .url_filters import DEFAULT, RULES, op11_url_filters
from .vector_codes import op12_vector_codes


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op5_fingerprints that SQL can tell."""
    return fingerprints.edited_fingerprints(common.table(spark, sf_dir, "documents")).select("doc_id", "n_chars", "edited_sha256")


def text_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column of op9_token_counts that SQL can tell."""
    return op9_token_counts(spark, sf_dir).select("doc_id", "n_bytes")


_OPERATORS = (
    op1_line_dedup, op2_lm_scoring, op3_bpe_codec, op4_minhash_near_dedup, op5_fingerprints, op6_embedding_near_dedup,
    op7_quality_classifier, op8_substring_dedup, op9_token_counts, op10_packing, op11_url_filters,
    op12_vector_codes, op13_source_divergence, edited_texts, text_bytes,
)
QUERIES: dict[str, Callable] = {f.__name__: f for f in _OPERATORS}

#: Smallest id that links lead to, over ``ids`` (id) and ``links`` (a, b) in both directions.
_COMPONENTS = """reach AS (SELECT id, id AS c FROM ids UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.id),
 components AS (SELECT id, min(c) AS component_id FROM reach GROUP BY id)"""

#: Tables ``n{k}``, the nearest entry of ``b{k}`` to each part of ``x``, and ``b{k+1}``, the means of these parts.
_NEAREST = """n{0} AS MATERIALIZED (SELECT r, j, arg_min(i, (far, i)) AS i, min(far) AS far FROM (
      SELECT x.r, x.j, i, (x.a - b.a) * (x.a - b.a) + (x.b - b.b) * (x.b - b.b) + (x.c - b.c) * (x.c - b.c) + (x.d - b.d) * (x.d - b.d) AS far FROM x JOIN b{0} b USING (j)) GROUP BY r, j)"""
_MEANS = "b{1} AS MATERIALIZED (SELECT o.j, o.i, " + ", ".join(
    f"CASE WHEN n IS NULL THEN o.{c} ELSE CAST((s{c} - ((s{c} % n) + n) % n) // n AS BIGINT) END AS {c}" for c in "abcd"
) + " FROM b{0} o LEFT JOIN (SELECT n.j, n.i, count(*) AS n, sum(a) AS sa, sum(b) AS sb, sum(c) AS sc, sum(d) AS sd FROM x JOIN n{0} n USING (r, j) GROUP BY n.j, n.i) s USING (j, i))"

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": rf"""WITH RECURSIVE o AS (
      SELECT doc_id, i - 1 AS place, ls[i] AS line FROM (
        SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))),
     g AS (SELECT line, row_number() OVER (ORDER BY line) AS id FROM (SELECT DISTINCT line FROM o WHERE regexp_matches(line, '[^\x20\x09-\x0D]'))),
     s AS (SELECT DISTINCT id, substr(line, i, 8) AS sh FROM (SELECT id, line, unnest(generate_series(1, greatest(1, length(line) - 7))) AS i FROM g)),
     n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
     met AS (SELECT x.id AS a, y.id AS b, count(*) AS m FROM s x JOIN s y ON x.sh = y.sh AND x.id < y.id GROUP BY ALL),
     pairs AS (SELECT a, b FROM met JOIN n p ON p.id = a JOIN n q ON q.id = b WHERE 100 * m >= 80 * (p.n + q.n - m)),
     links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs), ids AS (SELECT id FROM g), {_COMPONENTS},
     places AS (SELECT o.*, row_number() OVER (PARTITION BY component_id ORDER BY doc_id, place) = 1 OR component_id IS NULL AS kept
      FROM o LEFT JOIN g USING (line) LEFT JOIN components USING (id))
    SELECT d.doc_id, coalesce(p.n_lines, 0) AS n_lines, coalesce(p.n_kept, 0) AS n_kept, CASE WHEN d.text IS NOT NULL THEN coalesce(p.kept_text, '') END AS text
    FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (kept) AS n_kept, string_agg(line, chr(10) ORDER BY place) FILTER (kept) AS kept_text FROM places GROUP BY doc_id) p USING (doc_id)""",
    "op4_minhash_near_dedup": rf"""WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
     s AS (SELECT DISTINCT doc_id, sh FROM (
      SELECT doc_id, ws[i] || ' ' || ws[i + 1] AS sh FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 1)
      UNION ALL SELECT doc_id, ws[1] FROM w WHERE len(ws) = 1)),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL),
     pairs AS (SELECT a, b FROM met JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * m >= 80 * (p.n + q.n - m)),
     links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs), ids AS (SELECT doc_id AS id FROM documents), {_COMPONENTS}
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
    FROM documents d LEFT JOIN n USING (doc_id) JOIN components ON id = d.doc_id""",
    "op6_embedding_near_dedup": f"""WITH RECURSIVE v AS (
      SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
     good AS (SELECT id, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
     links AS (SELECT x.id AS a, y.id AS b FROM good x JOIN good y ON x.id <> y.id AND len(x.e) = len(y.e) WHERE list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.95),
     ids AS (SELECT id FROM v), {_COMPONENTS}
    SELECT id AS vec_id, coalesce(k, 0) AS n_links, component_id, component_id = id AS kept FROM components LEFT JOIN (SELECT a AS id, count(*) AS k FROM links GROUP BY a) USING (id)""",
    "op11_url_filters": rf"""WITH rules AS (SELECT *, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS p FROM (VALUES {", ".join(map(str, RULES))}) t(rule, verdict)),
     rests AS (SELECT page_id, row_number() OVER () AS r, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
     urls AS (SELECT page_id, r, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path
      FROM (SELECT *, regexp_extract(rest, '^[^/?#]*') AS host FROM rests)),
     best AS (SELECT r, arg_max(rules.rule, length(rules.rule)) AS rule, arg_max(verdict, length(rules.rule)) AS verdict FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r)
    SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict FROM urls LEFT JOIN best USING (r)""",
    "op12_vector_codes": f"""WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     x AS MATERIALIZED (SELECT r, j, e[4 * j + 1] AS a, e[4 * j + 2] AS b, e[4 * j + 3] AS c, e[4 * j + 4] AS d FROM v, (SELECT unnest(generate_series(0, 15)) AS j)),
     b0 AS MATERIALIZED (SELECT j, r - 1 AS i, a, b, c, d FROM x WHERE r <= 64),
     {_NEAREST.format(0)}, {_MEANS.format(0, 1)}, {_NEAREST.format(1)}, {_MEANS.format(1, 2)}, {_NEAREST.format(2)},
     told AS (SELECT sha256(string_agg(concat_ws(',', a, b, c, d), ',' ORDER BY j, i)) AS h FROM b2),
     coded AS (SELECT r, string_agg(format('{{:02x}}', i), '' ORDER BY j) AS code, CAST(sum(far) AS BIGINT) AS error FROM n2 GROUP BY r)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM v JOIN coded USING (r), told""",
    "op13_source_divergence": r"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
     o AS (SELECT id, lang, source, unnest(ws) AS term FROM d),
     kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM o GROUP BY ALL HAVING count(DISTINCT id) >= 10),
     langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
     groups AS (SELECT DISTINCT lang, source FROM d),
     c AS (SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(x.n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM o GROUP BY ALL) x USING (lang, source, term)),
     p AS (SELECT lang, source, term, n, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p, 1 + 1000000000 * (lang_n + 2) // (total + 2 * v) AS q FROM c JOIN langs USING (lang)),
     pairs AS (SELECT g.lang, g.source, h.source AS item, coalesce(value, 0) AS value FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
      LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) s
       ON s.lang = g.lang AND s.source = g.source AND s.item = h.source),
     every AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
     SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every) WHERE part = 'pair' OR rank <= 10""",
    "edited_texts": """WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     n AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS nt FROM d)
    SELECT doc_id, length(t) AS n_chars, sha256(substr(t, 1, length(t) - length(t) // 2) || substr(nt, 1, length(t) // 2)) AS edited_sha256 FROM n""",
    "text_bytes": "SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes FROM documents",
}
