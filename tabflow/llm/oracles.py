"""SQL for the registered queries that SQL can express."""

from __future__ import annotations

from tabflow.llm.urls import LISTED_WORDS, RULES

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) = 1 THEN w
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY 1, 2
), links AS (
    SELECT a, b FROM shared
    JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 80 * (x.n + y.n - common)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reach r
    JOIN (SELECT a, b FROM links UNION SELECT b, a FROM links) l ON r.b = l.a
), components AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""

_RULES = ", ".join(str(rule) for rule in RULES)

OP3 = rf"""
WITH parts AS (
    SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
        THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), named AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}) AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), rules(name, start, says) AS (VALUES {_RULES}), fitting AS (
    SELECT page_id, name || start AS rule, says, row_number() OVER (
        PARTITION BY page_id ORDER BY length(name || start) DESC, name || start) AS place
    FROM named JOIN rules
    ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
)
SELECT n.page_id, host, path, rule, coalesce(says, CASE
    WHEN len(list_intersect(regexp_split_to_array(host, '[.-]'), {list(LISTED_WORDS)})) > 0
    THEN 'block' ELSE 'allow' END) AS verdict
FROM named n LEFT JOIN fitting f ON f.page_id = n.page_id AND place = 1
"""

OP4 = """
WITH bytes AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
    SELECT doc_id, p, md5(substr(h, (2 * p - 1)::BIGINT, 200)) AS w
    FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 98)) AS p FROM bytes)
), repeats AS (
    SELECT doc_id, p FROM windows
    QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, p) > 1
), starts AS (
    SELECT doc_id, p, coalesce(p > 100 + lag(p) OVER (PARTITION BY doc_id ORDER BY p), true) AS new
    FROM repeats
), numbered AS (
    SELECT doc_id, p, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM starts
), runs AS (
    SELECT doc_id, run, min(p) AS low, max(p) + 99 AS high FROM numbered GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS gone
    FROM runs
), cut AS (
    SELECT doc_id, sum(high - low + 1) AS removed, count(*) AS spans, max(high) AS last,
        string_agg(substr(h, (2 * gone + 1)::BIGINT, (2 * (low - gone - 1))::BIGINT), ''
            ORDER BY low) AS kept
    FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
    coalesce(spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(kept, '') || substr(h, (2 * coalesce(last, 0) + 1)::BIGINT)))
        AS kept_sha256
FROM bytes LEFT JOIN cut USING (doc_id)
"""

OP11 = """
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
        list_transform([1, 9, 17, 25], lambda i:
            ('0x' || substr(sha256('1:' || doc_id), i, 8))::BIGINT) AS h
    FROM documents
), drawn AS (
    SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS low,
        greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
            OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM texts
), cut AS (
    SELECT *, substr(t, 1, low) AS prefix, substr(t, low + 1, high - low) AS middle,
        substr(t, high + 1) AS suffix
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END)
        AS output_sha256,
    sha256(t) AS restored_sha256
FROM cut
"""

OP12 = r"""
WITH texts AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = min(doc_id) OVER same AS kept, s AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""

OP13 = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM worded, (VALUES (1), (2), (3), (4)) AS lengths(k)
), f AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS n
    FROM placed GROUP BY ALL
), sizes AS (
    SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, string_split(phrase, ' ') AS w, n AS a FROM f WHERE k > 1 AND n >= 30
), cuts AS (
    SELECT c.lang, c.phrase, c.a, cut, x.n AS l, y.n AS r,
        (2000000::HUGEINT * c.a) // (x.n + y.n) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')
), scored AS (
    SELECT * FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_phrases AS (
    SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM candidates, (VALUES (2), (3)) s(size)
        WHERE size < k)
    GROUP BY ALL
), ranked AS (
    SELECT s.*, row_number() OVER (
        PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
    FROM scored s LEFT JOIN inner_phrases i ON i.lang = s.lang AND i.phrase = s.phrase
    WHERE i.longer IS NULL OR 100 * i.longer < 80 * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op1_minhash_dedup": OP1,
    "op3_url_filter": OP3,
    "op4_suffix_dedup": OP4,
    "op11_fill_in_middle": OP11,
    "op12_exact_dedup": OP12,
    "op13_phrase_mining": OP13,
}
