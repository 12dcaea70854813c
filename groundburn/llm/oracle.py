"""The queries' results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

op8 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_CLASS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_FOLD.format("text")}, '{_CLASS}') AS w FROM benchmark WHERE text IS NOT NULL),
pattern AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS width, array_to_string(w[i:i + 9], ' ') AS s
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
place AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS w1 FROM d),
spread AS (SELECT *, {", ".join(f"lead(w1, {k - 1}) OVER (PARTITION BY r ORDER BY i) AS w{k}" for k in range(2, 11))} FROM place),
found AS (
    {" UNION ALL ".join(f"SELECT r, i, width, item_id FROM spread JOIN pattern ON width = {k} AND s = {' || chr(32) || '.join(f'w{j}' for j in range(1, k + 1))}" for k in range(1, 11))}
),
hit AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + width)) AS k FROM found) GROUP BY r),
item AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
         FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(item.n, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN item USING (r)
"""

op9 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
),
place AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS w FROM d),
spot AS (SELECT r, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o || ' ' || lead(w, 5) OVER o || ' ' || lead(w, 6) OVER o || ' ' || lead(w, 7) OVER o AS s
         FROM place WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, list(i) AS spots FROM spot WHERE s IS NOT NULL GROUP BY r, s HAVING count(*) > 1),
covered AS (
    SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, unnest(spots) AS i FROM twice), range(8) x(k) GROUP BY r
),
f AS (
    SELECT d.r, doc_id, source, len(w)::BIGINT AS n_words, coalesce(len(array_to_string(w, '')), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN covered USING (r)
),
j AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        n_symbols > 0.5 * greatest(n_words, 1) OR n_dup_lines > 0.3::DOUBLE * greatest(n_lines, 1)
        OR word_chars / greatest(n_words, 1) < 2 OR word_chars / greatest(n_words, 1) > 14 AS soft_failed
    FROM f
),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed OR soft_failed) AS k FROM j GROUP BY source),
m AS (SELECT avg(k / n) AS mean, var_pop(k / n) AS spread FROM h),
prior AS (SELECT mean, CASE WHEN spread > 0 THEN greatest(mean * (1 - mean) / spread - 1, 1) ELSE 1 END AS strength FROM m),
verdict AS (SELECT source, (k + mean * strength) / (n + strength) AS host_rate FROM h, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR (host_rate > 0.5 AND soft_failed)) AS kept
FROM j JOIN verdict ON j.source IS NOT DISTINCT FROM verdict.source
"""

op13 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
),
word AS (SELECT r, lang, source, unnest(w) AS term FROM d),
vocabulary AS (SELECT lang, term, count(*)::HUGEINT AS n FROM word GROUP BY ALL HAVING count(DISTINCT r) >= 10),
occurring AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM word SEMI JOIN vocabulary USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM vocabulary GROUP BY lang),
grp AS (
    SELECT g.lang, g.source, coalesce(sum(o.n), 0)::HUGEINT AS n
    FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN occurring o ON o.lang = g.lang AND o.source = g.source
    GROUP BY g.lang, g.source
),
share AS (
    SELECT grp.lang, grp.source, t.term, o.n IS NOT NULL AS present,
        1 + (1000000000 * (coalesce(o.n, 0) + 2)) // (grp.n + 2 * size.v) AS p,
        1 + (1000000000 * (t.n + 2)) // (size.n + 2 * size.v) AS q
    FROM grp JOIN vocabulary t USING (lang) JOIN size USING (lang)
        LEFT JOIN occurring o ON o.lang = grp.lang AND o.source = grp.source AND o.term = t.term
),
pair AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM share WHERE present AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10
"""

ORACLES = {"op8_decontamination": op8, "op9_host_quality": op9, "op13_source_audit": op13}
