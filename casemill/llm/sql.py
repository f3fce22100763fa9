"""DuckDB SQL for the training-data queries that SQL can express.

Not expressed: fingerprints by XXH64 (op7), tokenizers (op3, op4, op9), and so the pipeline; these are
tested against brute force.
"""

from __future__ import annotations

from casemill.llm.licenses import CONTAINMENT, TEMPLATES
from casemill.llm.quality import MIN_DOCS, MIN_LEFT, MIN_WORDS, MOST_DOCS, SHARE

WORDS = "[^\\x20\\x09-\\x0D]+"
FOLDED = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _fold(text: str) -> str:
    return f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '{FOLDED}')"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op1() -> str:
    rows = ", ".join(f"({i}, {_literal(n)}, {_literal(t)})" for i, (n, t) in enumerate(TEMPLATES))
    return f"""WITH t AS (SELECT id, name, {_fold('body')} AS w FROM (VALUES {rows}) AS v(id, name, body)),
    ts AS (SELECT DISTINCT id, name, array_to_string(w[k:k + 4], ' ') AS s FROM t, unnest(range(1, len(w) - 3)) AS u(k)),
    tn AS (SELECT id, count(*) AS m FROM ts GROUP BY 1),
    d AS (SELECT doc_id, {_fold('text')} AS w FROM documents),
    ds AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) AS u(k)),
    shares AS (SELECT doc_id, id, name, count(*) AS n FROM ds JOIN ts USING (s) GROUP BY ALL),
    found AS (SELECT DISTINCT doc_id, name FROM shares JOIN tn USING (id) WHERE n >= {CONTAINMENT} * m)
    SELECT doc_id, count(name) AS n_licenses, coalesce(string_agg(name, ',' ORDER BY name), '') AS licenses FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id"""


OP2 = f"""WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{WORDS}'), []) AS w FROM documents),
    windows AS (SELECT doc_id, k, array_to_string(w[k:k + 12], ' ') AS s FROM d, unnest(range(1, len(w) - 11)) AS u(k)),
    firsts AS (SELECT s, min(doc_id) AS f FROM windows GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
    gone AS (SELECT doc_id, list(DISTINCT k + j) AS g FROM windows JOIN firsts USING (s), unnest(range(0, 13)) AS x(j) WHERE f < doc_id GROUP BY 1),
    words AS (SELECT doc_id, k, w[k] AS word FROM d, unnest(range(1, len(w) + 1)) AS u(k)),
    lost AS (SELECT doc_id, unnest(g) AS k FROM gone),
    kept AS (SELECT doc_id, count(*) FILTER (WHERE lost.k IS NOT NULL) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY words.k) FILTER (WHERE lost.k IS NULL), '') AS rest FROM words LEFT JOIN lost USING (doc_id, k) GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

OP5 = f"""WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '{WORDS}'), []) AS w FROM documents),
    tri AS (SELECT doc_id, k, array_to_string(w[k:k + 2], ' ') AS s FROM d, unnest(range(1, len(w) - 1)) AS u(k)),
    twice AS (SELECT doc_id, s FROM tri GROUP BY 1, 2 HAVING count(*) > 1),
    repeated AS (SELECT doc_id, count(DISTINCT k + j) AS n FROM tri JOIN twice USING (doc_id, s), (VALUES (0), (1), (2)) AS x(j) GROUP BY 1),
    raw AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
    lines AS (SELECT doc_id, source, text, line, len(regexp_extract_all(line, '{WORDS}')) AS n, lower(array_to_string(regexp_extract_all(line, '{WORDS}'), ' ')) AS norm FROM raw WHERE regexp_matches(line, '{WORDS}')),
    dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY 1),
    hosts AS (SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY 1),
    common AS (SELECT source, norm FROM lines JOIN hosts USING (source) GROUP BY source, norm, docs HAVING count(DISTINCT text) > least({MOST_DOCS}, greatest({MIN_DOCS}, {SHARE} * docs))),
    lost AS (SELECT doc_id, sum(n) AS n FROM lines JOIN common USING (source, norm) GROUP BY 1),
    base AS (
        SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
               coalesce(repeated.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS n_removed_words
        FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN lost USING (doc_id)),
    judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_words - n_removed_words AS rest FROM base)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, CAST(n_removed_words AS BIGINT) AS n_removed_words,
           NOT base_failed AND NOT (n_removed_words > 0 AND (rest < {MIN_WORDS} OR rest < {MIN_LEFT} * n_words)) AS kept FROM judged"""

OP6 = """WITH t AS (
        SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL),
    ranks AS (SELECT DISTINCT pair_id, k FROM t),
    agree AS (
        SELECT r.pair_id, r.k, coalesce(a.role = b.role AND a.text = b.text, false) AS same
        FROM ranks r LEFT JOIN t a ON a.pair_id = r.pair_id AND a.k = r.k AND a.side = 0 LEFT JOIN t b ON b.pair_id = r.pair_id AND b.k = r.k AND b.side = 1),
    shared AS (SELECT pair_id, coalesce(min(k) FILTER (WHERE NOT same) - 1, max(k)) AS n FROM agree GROUP BY 1),
    shown AS (SELECT t.*, n, '<|' || role || '|>' || chr(10) || text || chr(10) AS line FROM t JOIN shared USING (pair_id)),
    placed AS (SELECT *, coalesce(sum(length(line)) OVER (PARTITION BY pair_id, side ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM shown WHERE k > n),
    spans AS (SELECT pair_id, side, string_agg(CAST(place + length(role) + 5 AS VARCHAR) || ':' || CAST(place + length(line) AS VARCHAR), ',' ORDER BY k) AS mask FROM placed WHERE role = 'assistant' GROUP BY 1, 2),
    texts AS (
        SELECT pair_id, max(n) AS n, count(*) FILTER (WHERE side = 0) AS na, count(*) FILTER (WHERE side = 1) AS nb, string_agg(line, '' ORDER BY k) FILTER (WHERE side = 0 AND k <= n) AS prompt,
               string_agg(line, '' ORDER BY k) FILTER (WHERE side = 0 AND k > n) AS chosen, string_agg(line, '' ORDER BY k) FILTER (WHERE side = 1 AND k > n) AS rejected FROM shown GROUP BY 1)
    SELECT pair_id, n AS n_prompt_turns, na AS n_chosen_turns, nb AS n_rejected_turns, coalesce(prompt, '') AS prompt, coalesce(chosen, '') AS chosen, coalesce(rejected, '') AS rejected,
           coalesce(a.mask, '') AS chosen_mask, coalesce(b.mask, '') AS rejected_mask
    FROM texts LEFT JOIN (SELECT pair_id, mask FROM spans WHERE side = 0) a USING (pair_id) LEFT JOIN (SELECT pair_id, mask FROM spans WHERE side = 1) b USING (pair_id)"""

OP8 = f"""WITH d AS (SELECT doc_id, coalesce({_fold('text')}, []) AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_fold('text')} AS w FROM benchmark),
    patterns AS (SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[k:k + least(13, len(w)) - 1], ' ') AS s FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(k) WHERE len(w) > 0),
    sizes AS (SELECT DISTINCT size FROM patterns),
    places AS (SELECT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS s FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS u(k)),
    hits AS (SELECT doc_id, k, size, item FROM places JOIN patterns USING (size, s)),
    counted AS (SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM hits, unnest(range(0, size)) AS x(j) GROUP BY 1),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN items USING (doc_id)"""

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP10 = f"""WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h, coalesce(html, '') AS html FROM pages),
    g AS (SELECT html, max(page_id) AS last, count(*) AS n FROM p GROUP BY 1),
    coded AS (SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || substr(h, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT)) AS five FROM p)
    SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda j: substr('{_LETTERS}', 1 + ((five[j // 4 + 1] >> CAST(15 - 5 * (j % 4) AS BIGINT)) & 31), 1)), '') AS payload_digest,
           CASE WHEN n > 1 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n > 1 AND page_id <> last THEN last END AS refers_to
    FROM coded JOIN g USING (html)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": op1(), "op2_substring_dedup": OP2, "op5_quality_rules": OP5, "op6_preference_format": OP6, "op8_decontamination": OP8, "op10_warc_archive": OP10,
    }
