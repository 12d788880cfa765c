"""DuckDB SQL for the operators that SQL can express, written from their meaning."""

from __future__ import annotations

from wattline.llm import licences, urls

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def license_scan() -> str:
    """Both cuts as lists of codes, then one step per rule."""
    known = ", ".join(f"({_text(s)}, {_text(c)})" for s, c in licences.coded_sentences().items())
    filler = licences.FILLER

    def cut(ends: str) -> str:
        plain = _LOWER.format(f"regexp_replace(text, '{ends}', chr(30), 'g')")
        return f"string_split(regexp_replace({plain}, '{filler}', ' ', 'g'), chr(30))"

    steps, before = [], "seq"
    for at, (licence, codes) in enumerate(licences.coded_rules()):
        steps.append(
            f"s{at} AS (SELECT rid, doc_id, cut, replace(rest, {_text(codes)}, '{'.' * len(codes)}') AS rest, "
            f"CASE WHEN contains(rest, {_text(codes)}) THEN list_append(found, {_text(licence)}) ELSE found END AS found "
            f"FROM {before})"
        )
        before = f"s{at}"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
known(sentence, code) AS (VALUES {known}),
cuts AS (
  SELECT rid, doc_id, 'sentence' AS cut, {cut(licences.SENTENCE_END)} AS parts FROM d
  UNION ALL SELECT rid, doc_id, 'line', {cut(licences.LINE_END)} FROM d),
one AS (
  SELECT rid, doc_id, cut, pos, trim(parts[pos], ' ') AS sentence
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS pos FROM cuts)),
coded AS (
  SELECT rid, doc_id, cut, pos, coalesce(code, '.') AS code
  FROM one LEFT JOIN known USING (sentence) WHERE sentence <> '' AND NOT regexp_matches(sentence, '{licences.MARKER}')),
seq AS (
  SELECT d.rid, d.doc_id, k.cut, coalesce(string_agg(code, '' ORDER BY pos), '') AS rest, []::VARCHAR[] AS found
  FROM d CROSS JOIN (VALUES ('sentence'), ('line')) AS k(cut)
  LEFT JOIN coded c ON c.rid = d.rid AND c.cut = k.cut GROUP BY ALL),
{", ".join(steps)},
counts AS (
  SELECT rid, length(rest) AS n_sentences, length(replace(rest, '.', '')) AS n_known FROM seq WHERE cut = 'sentence')
SELECT any_value(f.doc_id) AS doc_id, any_value(n_sentences) AS n_sentences, any_value(n_known) AS n_known,
  array_to_string(list_sort(list_distinct(flatten(list(found)))), ',') AS licences
FROM {before} f JOIN counts USING (rid) GROUP BY f.rid"""


DECONTAMINATION = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    [x for x in string_split_regex({_LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> ''] AS w
  FROM documents),
b AS (
  SELECT item_id,
    [x for x in string_split_regex({_LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> ''] AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[pos:pos + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS pos FROM b WHERE len(w) > 0)),
dw AS (
  SELECT rid, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS pos
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT rid, pos, n, item_id FROM dw JOIN bw USING (n, win)),
words AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(pos, pos + n)) AS p FROM (SELECT DISTINCT rid, pos, n FROM hit)) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS i FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""


def url_filter() -> str:
    """The rules by length, and the propagation as one CTE per step."""
    values = ", ".join(f"({_text(v)}, {_text(h)}, {_text(p)})" for v, h, p in urls.RULES)
    steps = ["s0 AS MATERIALIZED (SELECT * FROM base)"]
    for at in range(1, urls.STEPS + 1):
        steps.append(
            f"s{at} AS MATERIALIZED (SELECT kind, host, sum(score) AS score FROM ("
            f"SELECT kind, host, score FROM base UNION ALL "
            f"SELECT m.kind, m.stop, {urls.DAMPING} * s.score * m.share FROM s{at - 1} s "
            f"JOIN moves m ON m.kind = s.kind AND m.start = s.host) GROUP BY kind, host)"
        )
    link = urls.LINK.replace("'", "''")
    return f"""
WITH rules(verdict, h, p) AS (VALUES {values}),
p AS (
  SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS html,
    {_LOWER.format(f"regexp_extract(coalesce(url, ''), '{urls.URL}', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '{urls.URL}', 2) AS path FROM pages),
fit AS (
  SELECT rid, arg_max(h || p.p, length(h || p.p)) AS rule, arg_max(verdict, length(h || p.p)) AS verdict
  FROM p AS x JOIN rules AS p ON (x.host = h OR ends_with(x.host, '.' || h)) AND starts_with(x.path, p.p)
  GROUP BY rid),
r AS (SELECT p.*, rule, verdict FROM p LEFT JOIN fit USING (rid)),
edges AS (
  SELECT src, dst, count(*) AS n
  FROM (SELECT host AS src, {_LOWER.format("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS dst FROM p)
  WHERE src <> dst AND src <> '' GROUP BY src, dst),
moves AS MATERIALIZED (
  SELECT 'trust' AS kind, src AS start, dst AS stop, n / sum(n) OVER (PARTITION BY src) AS share FROM edges
  UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM edges),
seed AS (
  SELECT host, avg((coalesce(verdict, '') = 'allow')::INT) AS t, avg((coalesce(verdict, '') = 'block')::INT) AS d
  FROM r GROUP BY host),
base AS MATERIALIZED (
  SELECT 'trust' AS kind, host, (1 - {urls.DAMPING}) * t AS score FROM seed
  UNION ALL SELECT 'distrust', host, (1 - {urls.DAMPING}) * d FROM seed),
{", ".join(steps)},
bad AS (
  SELECT host FROM s{urls.STEPS} GROUP BY host
  HAVING sum(CASE WHEN kind = 'distrust' THEN score ELSE -score END) > {urls.THRESHOLD})
SELECT page_id, r.host, path, rule,
  coalesce(verdict, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN bad USING (host)"""


QUALITY_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    [x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents),
win AS (
  SELECT rid, pos, array_to_string(w[pos:pos + 7], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS pos FROM d WHERE len(w) >= 8)),
again AS (SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest(range(pos, pos + 8)) AS p FROM again) GROUP BY rid),
s AS (
  SELECT doc_id, text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines) AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (rid)),
j AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(text, '[^a-z]', '', 'g')) AS lower,
    length(regexp_replace(text, '[^!]', '', 'g')) AS bang, length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 100 * n_dup_lines > 50 * n_lines OR 4 * bang > n_words OR upper > lower OR 4 * digits > word_chars) AS kept
FROM j"""


LINE_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS lines,
    dense_rank() OVER (ORDER BY doc_id NULLS LAST, text) AS doc FROM documents),
w AS (
  SELECT DISTINCT doc, pos, array_to_string(lines[pos:pos + 2], chr(10)) AS win
  FROM (SELECT doc, lines, unnest(range(1, len(lines) - 1)) AS pos FROM d WHERE len(lines) >= 3)),
later AS (
  SELECT doc, pos FROM (
    SELECT doc, pos, row_number() OVER (PARTITION BY win ORDER BY doc, pos) AS k FROM w WHERE regexp_matches(win, '\S'))
  WHERE k > 1),
gone AS (SELECT doc, list(DISTINCT p) AS gone FROM (SELECT doc, unnest([pos, pos + 1, pos + 2]) AS p FROM later) GROUP BY doc),
kept AS (
  SELECT rid, doc_id, text, lines, gone,
    array_to_string([lines[i] for i in range(1, len(lines) + 1) if gone IS NULL OR NOT list_contains(gone, i)], chr(10)) AS left_over
  FROM d LEFT JOIN gone USING (doc))
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
  CASE WHEN text IS NOT NULL THEN sha256(left_over) END AS text_sha256 FROM kept"""


FILTER_AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), counted AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY t) AS least
  FROM texts
), failed AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN CASE WHEN doc_id IS NULL THEN least IS NOT NULL ELSE doc_id > least END THEN 'E' ELSE '' END AS fails
  FROM counted
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), groups AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT part, fails, n, good, toxic, filter_order, step, filter_order[step] AS filter,
         contains(fails, filter_order[step]) AS failing,
         translate(fails, left(filter_order, step - 1), '') <> fails AS gone
  FROM groups, orders, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)
), stepped AS (
  SELECT part, filter_order, step, filter,
         sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = filter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END) AS toxic_lost
  FROM steps GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM stepped
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan(),
        "op3_decontamination": DECONTAMINATION,
        "op6_url_filter": url_filter(),
        "op8_quality_rules": QUALITY_RULES,
        "op10_line_dedup": LINE_DEDUP,
        "op11_filter_audit": FILTER_AUDIT,
    }
