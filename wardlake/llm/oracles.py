"""DuckDB SQL of the text queries that SQL can express."""

from __future__ import annotations

import string

from wardlake.llm import licenses

LOWER = f"translate({{}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    def first(group: list[tuple[str, str]]) -> str:
        fits = " ".join(f"WHEN regexp_matches(s, {_quoted(f'(^| ){pattern}')}) THEN '{name}'" for name, pattern in group)
        return f"CASE {fits} END"

    known = ", ".join(first(group) for group in licenses.SENTENCES)
    steps, found, left = [], [], "sequence"
    for k, (name, pattern) in enumerate(licenses.RULES):
        whole = _quoted(f"(?:^|,)(?:{pattern})")
        steps.append(
            f"r{k} AS (SELECT *, CASE WHEN regexp_matches({left}, {whole}) THEN '{name}' END AS f{k}, "
            f"regexp_replace({left}, {whole}, ',', 'g') AS l{k} FROM {'seq' if k == 0 else f'r{k - 1}'})"
        )
        found.append(f"f{k}")
        left = f"l{k}"
    first_of_each = f"list_filter([{', '.join(found)}], lambda x: x IS NOT NULL)"
    return f"""
WITH bare AS (
  SELECT doc_id, regexp_replace(chr(10) || COALESCE(text, ''), {_quoted(licenses.LINE_BEGIN)}, chr(10), 'g') AS t
  FROM documents
), parts AS (
  SELECT doc_id, string_split_regex(regexp_replace(t, {_quoted(f"({licenses.SPDX_TAG}[^" + chr(92) + "n]*)")},
    '{chr(92)}1' || chr(10) || chr(10), 'g'), {_quoted(licenses.SENTENCE_END)}) AS sentences FROM bare
), ids AS (
  SELECT doc_id, len(list_filter(sentences, lambda s: trim(s, ' ' || chr(10)) <> '')) AS n_sentences,
    flatten(list_transform(list_transform(
      list_filter(sentences, lambda s: regexp_matches(s, {_quoted('(?i)' + licenses.HINT)})),
      lambda s: trim(regexp_replace({LOWER.format('s')}, '[^a-z0-9.+/-]+', ' ', 'g'))),
      lambda s: list_filter([{known}], lambda x: x IS NOT NULL))) AS ids
  FROM parts
), seq AS (
  SELECT doc_id, n_sentences, array_to_string(ids, ',') AS sentence_ids,
    ',' || COALESCE(array_to_string(list_transform(ids, lambda x: x || ','), ''), '') AS sequence FROM ids
), {', '.join(steps)}
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, COALESCE(sentence_ids, '') AS sentence_ids,
  COALESCE(array_to_string(list_transform(list_filter(list_zip({first_of_each}, range(len({first_of_each}))),
    lambda p: list_position({first_of_each}, p[1]) = p[2] + 1), lambda p: p[1]), ','), '') AS licenses,
  COALESCE(array_to_string(list_filter(string_split({left}, ','), lambda x: x <> ''), ','), '') AS unmatched
FROM r{len(licenses.RULES) - 1}
"""


WORDS = f"regexp_extract_all({LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, COALESCE({WORDS}, []) AS w FROM documents
), b AS (
  SELECT item_id, {WORDS} AS w FROM benchmark
), sized AS (
  SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
), sizes AS (
  SELECT DISTINCT n FROM win
), runs AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN sizes)
), occ AS (
  SELECT DISTINCT r, i, n, item_id FROM runs JOIN win USING (n, t)
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM occ) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(ids, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

URL_RULES = f"""
WITH p AS (
  SELECT page_id, {LOWER.format("COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
    COALESCE(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), rules(h, p, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
    ('org', '/fr/', 'allow')
), fits AS (
  SELECT page_id, max_by(h || rules.p, length(h || rules.p)) AS rule, max_by(verdict, length(h || rules.p)) AS verdict
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, rules.p) GROUP BY page_id
)
SELECT page_id, host, path, rule, COALESCE(verdict, 'allow') AS verdict FROM p LEFT JOIN fits USING (page_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS r,
    COALESCE(regexp_extract_all({LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 4
    THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d
), n AS (
  SELECT r, count(*) AS n FROM s GROUP BY r
), links AS (
  SELECT x.r AS a, y.r AS b FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r
  JOIN n nx ON nx.r = x.r JOIN n ny ON ny.r = y.r
  GROUP BY x.r, y.r, nx.n, ny.n HAVING 100 * count(*) >= 80 * (nx.n + ny.n - count(*))
), reach AS (
  SELECT r AS a, r AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), part AS (
  SELECT reach.a AS r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a
)
SELECT doc_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_shingles, component_id,
  doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN part USING (r) LEFT JOIN n USING (r)
"""

LINE_DEDUP = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(COALESCE(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d
), k AS (
  SELECT *, {LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l
), repeated AS (
  SELECT key, max(doc_id) AS largest FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, repeated.key IS NULL OR doc_id = largest AS stays FROM k LEFT JOIN repeated USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
  sha256(COALESCE(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE stays), '')) AS kept_sha256
FROM judged GROUP BY r
"""

FILTER_AUDIT = """
WITH letters(f, k) AS (VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3), ('E', 4)
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), t AS (
  SELECT COALESCE(source, '') AS part, COALESCE(text, '') AS text, doc_id,
    regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY COALESCE(text, '')) AS lowest
  FROM documents
), known AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, COALESCE(good, 0) AS good, COALESCE(toxic, 0) AS toxic,
    (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * COALESCE(doc_id > lowest, FALSE)::INT AS mask
  FROM t LEFT JOIN known USING (doc_id)
), counted AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
), stepped AS (
  SELECT part, o, mask, n, good, toxic, (
    SELECT min(CASE WHEN mask & (1 << k) > 0 THEN instr(o, f) ELSE 6 END) FROM letters) AS step
  FROM counted, orders
), grid AS (
  SELECT part, o, s, substr(o, s, 1) AS f, 1 << (ascii(substr(o, s, 1)) - 65) AS bit
  FROM (SELECT DISTINCT part FROM counted), orders, (SELECT unnest(range(1, 6)) AS s)
), judged AS (
  SELECT g.part, g.o, g.s, g.f, COALESCE(sum(n) FILTER (WHERE step > s), 0) AS kept,
    COALESCE(sum(n) FILTER (WHERE step = s), 0) AS removed,
    COALESCE(sum(n) FILTER (WHERE step < s AND mask & bit > 0), 0) AS redundant,
    COALESCE(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
    COALESCE(sum(c.good) FILTER (WHERE step = s), 0) AS good_lost,
    COALESCE(sum(c.toxic) FILTER (WHERE step = s), 0) AS toxic_lost
  FROM grid g JOIN stepped c ON c.part = g.part AND c.o = g.o GROUP BY g.part, g.o, g.s, g.f
)
SELECT part, o AS filter_order, CAST(s AS INT) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM judged
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INT) AS rank, id AS negative_id, positive_score,
  score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 10
"""

ORACLES: dict[str, str] = {
    "op1_license_scan": _license_sql(),
    "op2_decontamination": DECONTAMINATION,
    "op5_url_rules": URL_RULES,
    "op9_minhash_neardup": NEAR_DUPLICATES,
    "op11_line_dedup": LINE_DEDUP,
    "op12_filter_audit": FILTER_AUDIT,
    "op13_hard_negatives": HARD_NEGATIVES,
}
