"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from trendspark.llm.licenses import FILE_SHARE, TEMPLATES, THRESHOLD, term_weights
from trendspark.llm.line_dedup import SENTENCE
from trendspark.llm.queries import CONTROL_TEXT

NEAR_DEDUP = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
           GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT a, b FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other),
components AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.other, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(c.other, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN components c ON c.doc_id = d.doc_id
"""

PASSAGES = rf"""
WITH lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
placed AS (SELECT doc_id, l, unnest(range(0, len(l))) AS line FROM lines),
starts AS (
  SELECT doc_id, CAST(coalesce(list_sum(list_transform(l[1:line], lambda x: length(x) + 1)), 0) AS BIGINT) AS begins,
         regexp_extract_all(l[line + 1], '{SENTENCE}') AS s FROM placed),
cut AS (SELECT doc_id, begins, s, unnest(range(0, len(s))) AS k FROM starts),
sentences AS (
  SELECT doc_id, begins + CAST(coalesce(list_sum(list_transform(s[1:k], lambda x: length(x))), 0) AS BIGINT) AS start_char, length(s[k + 1]) AS n,
         lower(trim(regexp_replace(s[k + 1], '[ \t\r\f\v]+', ' ', 'g'), ' ')) AS normal FROM cut),
units AS (
  SELECT doc_id, start_char, start_char + n AS end_char, normal, len(string_split(normal, ' ')) AS n_words,
         row_number() OVER (PARTITION BY doc_id ORDER BY start_char) AS unit FROM sentences WHERE normal <> ''),
grouped AS (
  SELECT *, count(*) OVER (PARTITION BY normal) AS copies,
         first_value(doc_id) OVER (PARTITION BY normal ORDER BY doc_id, unit) AS kept_doc_id,
         first_value(unit) OVER (PARTITION BY normal ORDER BY doc_id, unit) AS kept_unit FROM units),
gone AS (
  SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS run FROM grouped WHERE doc_id <> kept_doc_id OR unit <> kept_unit)
SELECT doc_id, min(start_char) AS start_char, max(end_char) AS end_char, count(*) AS n_units, CAST(sum(n_words) AS BIGINT) AS n_words,
       arg_min(kept_doc_id, unit) AS kept_doc_id, min(copies) AS copies FROM gone GROUP BY doc_id, run
"""

CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
sized AS (
  SELECT *, length('<|') + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), '|>', '|\>')) + length('|>') + 1
         + length(replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '|>', '|\>')) + length('<|end|>') + 1 AS size FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


FILTER_AUDIT = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
flags AS (
  SELECT doc_id, part, len(w) < 100 AS A, 100 * len(list_distinct(w)) < 80 * len(w) AS B,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS C,
         regexp_matches(text, '[#$%&*|]') AS D, doc_id > min(doc_id) OVER (PARTITION BY text) AS E FROM words),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
docs AS (SELECT f.*, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM flags f LEFT JOIN known USING (doc_id)),
failed AS (
  SELECT part, good, toxic, concat(CASE WHEN A THEN 'A' ELSE '' END, CASE WHEN B THEN 'B' ELSE '' END, CASE WHEN C THEN 'C' ELSE '' END,
         CASE WHEN D THEN 'D' ELSE '' END, CASE WHEN coalesce(E, false) THEN 'E' ELSE '' END) AS fails, count(*) AS n FROM docs GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
placed AS (
  SELECT part, filter_order, step, filter_order[step] AS f, fails, good, toxic, n, contains(fails, filter_order[step]) AS hit,
         length(fails) > 0 AND length(translate(fails, filter_order[:step - 1], '')) < length(fails) AS gone,
         length(translate(fails, filter_order[:step], '')) < length(fails) AS gone_after FROM failed, steps),
counted AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (NOT gone_after), 0) AS kept, coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (hit AND gone), 0) AS redundant, coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
         coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0) AS good_lost, coalesce(sum(n) FILTER (hit AND NOT gone AND toxic), 0) AS toxic_lost
  FROM placed GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM counted
"""

LEXICAL_SEARCH = r"""
WITH terms AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
sized AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n FROM terms WHERE len(w) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sized),
tf AS (SELECT doc_id, any_value(n) AS n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM sized) GROUP BY doc_id, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
items AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
asked AS (SELECT item_id, t, count(*) AS q FROM items GROUP BY item_id, t),
scored AS (
  SELECT item_id, doc_id,
         CAST(sum(q * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
                  * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN df USING (t) JOIN tf USING (t), totals GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def _licenses() -> str:
    """The same cosine over all lines, without anchors."""
    idf, other, vectors = term_weights(TEMPLATES)
    weights = ", ".join(f"('{t}', {w!r}::DOUBLE)" for t, w in sorted(idf.items()))
    entries = ", ".join(f"({i}, '{TEMPLATES[i][0]}', '{t}', {w!r}::DOUBLE)" for i, v in enumerate(vectors) for t, w in sorted(v.items()))
    return rf"""
WITH weights(term, idf) AS (VALUES {weights}),
entries(template, license, term, weight) AS (VALUES {entries}),
files AS (SELECT doc_id, concat_ws('/', source, lang, doc_id) AS path, text FROM documents),
split AS (SELECT path, string_split(text, chr(10)) AS l,
                 len(list_filter(regexp_split_to_array(text, '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')) AS whole FROM files WHERE text IS NOT NULL),
lines AS (SELECT path, whole, unnest(range(0, len(l))) AS line, unnest(l) AS text FROM split),
terms AS (SELECT path, line, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS term FROM lines),
tf AS (SELECT path, line, t.term, count(*) * coalesce(any_value(idf), {other!r}::DOUBLE) AS value FROM terms t LEFT JOIN weights w ON w.term = t.term
       WHERE t.term <> '' GROUP BY path, line, t.term),
norms AS (SELECT path, line, sqrt(sum(value * value)) AS norm FROM tf GROUP BY path, line),
dots AS (SELECT path, line, template, any_value(license) AS license, sum(value * weight) AS dot FROM tf JOIN entries USING (term) GROUP BY path, line, template),
best AS (SELECT path, line, round(dot / norm, 6) AS cosine, license,
                row_number() OVER (PARTITION BY path, line ORDER BY round(dot / norm, 6) DESC, template) AS r FROM dots JOIN norms USING (path, line)),
notices AS (SELECT b.path, b.line, cosine, license, whole, len(list_filter(regexp_split_to_array(lower(l.text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')) AS words
            FROM best b JOIN lines l ON l.path = b.path AND l.line = b.line WHERE r = 1 AND cosine >= {THRESHOLD}),
own AS (SELECT path, cosine, license, sum(words) OVER (PARTITION BY path) >= {FILE_SHARE} * whole AS is_file,
               row_number() OVER (PARTITION BY path ORDER BY cosine DESC, line) AS r FROM notices),
named AS (SELECT * FROM own WHERE r = 1),
holders AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS directory, path, license, cosine FROM named WHERE is_file),
rest AS (SELECT path, regexp_replace(path, '/?[^/]*$', '') AS directory FROM files WHERE path NOT IN (SELECT path FROM named)),
above AS (SELECT path, unnest(range(0, len(string_split(directory, '/')) + 1)) AS levels, directory FROM rest),
found AS (SELECT a.path, a.levels, h.path AS from_path, h.license, h.cosine,
                 row_number() OVER (PARTITION BY a.path ORDER BY a.levels, h.cosine DESC, h.path) AS r
          FROM above a JOIN holders h ON h.directory = array_to_string(string_split(a.directory, '/')[1:len(string_split(a.directory, '/')) - a.levels], '/'))
SELECT CAST(regexp_extract(path, '[^/]*$') AS BIGINT) AS doc_id, path, license, origin, cosine, from_path, levels FROM (
  SELECT path, license, CASE WHEN is_file THEN 'file' ELSE 'header' END AS origin, cosine, path AS from_path, CAST(0 AS INTEGER) AS levels FROM named
  UNION ALL
  SELECT r.path, f.license, CASE WHEN f.path IS NULL THEN 'none' ELSE 'inherited' END, f.cosine, f.from_path, CAST(f.levels AS INTEGER)
  FROM rest r LEFT JOIN (SELECT * FROM found WHERE r = 1) f ON f.path = r.path)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_near_dedup": NEAR_DEDUP,
        "op4_line_dedup": PASSAGES,
        "op5_chat_prefix_targets": CHAT,
        "op9_license_scan": _licenses(),
        "op11_filter_audit": FILTER_AUDIT,
        "op13_lexical_search": LEXICAL_SEARCH,
    }
