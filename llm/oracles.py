"""DuckDB SQL for the contract queries that SQL can express, written from the contracts."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, gap: str = r"[\x20\x09-\x0D]+") -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '{gap}'), lambda x: x <> '')"


def _folded(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


_ALNUM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len({_words('text')})::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, 3 * source_size AS capacity, sum(source_size) OVER ()::DOUBLE AS total,
         sum(3 * source_size) OVER w - 3 * source_size AS filled,
         sum(weight) OVER () - (sum(weight) OVER w - weight) AS rest
  FROM s WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
g AS (SELECT *, (total - filled::DOUBLE) / rest AS level FROM f),
t AS (
  SELECT source, source_size,
         CASE WHEN level * weight >= capacity THEN capacity::DOUBLE
              ELSE weight * (SELECT arg_min(level, capacity / weight) FROM g WHERE level * weight < capacity) END AS target
  FROM g),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
r AS (
  SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d)
SELECT r.doc_id, r.size, p.source_size, p.target, r.source,
       (whole * size + greatest(0, least(size, round(target - whole * source_size)::BIGINT - before)))::BIGINT AS taken
FROM r JOIN p ON r.source IS NOT DISTINCT FROM p.source
"""

_GRID = "1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1"

QUALITY = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, {_words('text')} AS w FROM documents),
wins AS (SELECT doc_id, i, w[i:i + 2] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT doc_id, x FROM wins GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n
        FROM (SELECT doc_id, unnest(range(i, i + 3)) AS j FROM wins SEMI JOIN twice USING (doc_id, x)) GROUP BY 1),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
c AS (
  SELECT d.doc_id, lang, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
         (len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(t) - len(regexp_replace(t, '[!?]', '', 'g')) AS n_shouts, len(l) AS n_lines
  FROM d JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
s AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         coalesce(n_symbols / nullif(n_words, 0), 0.0) AS symbols, coalesce(n_shouts / nullif(n_words, 0), 0.0) AS shouting,
         coalesce(n_repeat_words / nullif(n_words, 0), 0.0) AS repeats, coalesce(n_dup_lines / nullif(n_lines, 0), 0.0) AS lines
  FROM c),
u AS (UNPIVOT s ON symbols, shouting, repeats, lines INTO NAME rule VALUE score),
k AS (
  SELECT lang, rule, cutoff, count(*) FILTER (WHERE quality = 1) AS n,
         count(*) FILTER (WHERE quality = 1 AND score > cutoff) AS lost,
         count(*) FILTER (WHERE quality = 0 AND score > cutoff) AS caught
  FROM u JOIN (SELECT DISTINCT doc_id, quality FROM labels WHERE quality IN (0, 1)) USING (doc_id),
       (SELECT unnest([{_GRID}])::DOUBLE AS cutoff)
  WHERE NOT base_failed GROUP BY ALL),
p AS (
  SELECT *, CASE WHEN lost >= n * 0.02 THEN 1.0 ELSE (
      SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.02) + (n - i) * ln(0.98)))
      FROM range(0, lost + 1) AS r(i)) END AS p
  FROM k),
q AS (
  SELECT *, max(p) OVER (PARTITION BY lang, rule ORDER BY cutoff DESC ROWS UNBOUNDED PRECEDING) AS worst,
         (SELECT count(*) FROM (SELECT DISTINCT lang, rule FROM k)) AS families
  FROM p),
best AS (
  SELECT lang, rule, arg_max(cutoff, (caught - lost) * 1000.0 + cutoff) AS cutoff FROM q
  WHERE worst <= 0.05 / families AND caught > lost GROUP BY ALL),
bad AS (
  SELECT u.doc_id, string_agg(u.rule, ',' ORDER BY list_position(['symbols', 'shouting', 'repeats', 'lines'], u.rule)) AS rules
  FROM u JOIN best ON u.lang IS NOT DISTINCT FROM best.lang AND u.rule = best.rule WHERE u.score > best.cutoff GROUP BY 1)
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND bad.rules IS NULL AS kept, coalesce(bad.rules, '') AS rejected_by
FROM s LEFT JOIN bad USING (doc_id)
"""

SUBSTRINGS = rf"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
wins AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS x
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
first AS (SELECT x, min(doc_id) AS least FROM wins GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM wins JOIN first USING (x) WHERE least < doc_id),
kept AS (
  SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.j) AS rest
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d) t ANTI JOIN gone g ON g.doc_id = t.doc_id AND g.j = t.j
  GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

NEAR = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(_folded('text'))} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS x
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(len('<|im_start|>') + len(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + 1
           + len(replace(replace(text, '\', '\\'), '<|', '<\|')) + len('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

BENCHMARK = rf"""
WITH d AS (SELECT doc_id, {_words(_folded('text'), _ALNUM_GAP)} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_words(_folded('text'), _ALNUM_GAP)} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, s, array_to_string(w[i:i + s - 1], ' ') AS x
       FROM (SELECT item, w, least(10, len(w)) AS s, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, s, i, array_to_string(w[i:i + s - 1], ' ') AS x
       FROM (SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM d, (SELECT DISTINCT s FROM bw) WHERE len(w) >= s)),
hit AS (SELECT doc_id, i, s, item FROM dw JOIN bw USING (s, x)),
words AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + s)) AS j FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items.l, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_CRC32 = """xor(list_reduce(list_transform(range(1, len(k) + 1), lambda i: ord(k[i])::BIGINT),
    lambda c, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[], lambda d, j: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)),
    4294967295), 4294967295)"""

REPAIR = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hit AS (SELECT *, {_CRC32} % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) FROM hit WHERE kind <> 0)),
placed AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS c, lag(left(role, 1)) OVER w AS last
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
r AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
put(before, after, edits, roles, cost) AS (   -- what may be inserted before a row or at the end: (state, state then)
  VALUES ('b', 'b', '', []::VARCHAR[], 0), ('s', 's', '', [], 0), ('u', 'u', '', [], 0), ('a', 'a', '', [], 0),
         ('b', 'u', 'I', ['user:'], 3), ('s', 'u', 'I', ['user:'], 3), ('u', 'a', 'I', ['assistant:'], 3), ('a', 'u', 'I', ['user:'], 3),
         ('b', 'a', 'II', ['user:', 'assistant:'], 6), ('s', 'a', 'II', ['user:', 'assistant:'], 6),
         ('u', 'u', 'II', ['assistant:', 'user:'], 6), ('a', 'a', 'II', ['user:', 'assistant:'], 6)),
step(source, target, role) AS (VALUES ('b', 's', ''), ('b', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')),
way AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 'b' AS state, {{'cost': 0, 'audit': '', 'rows': []::VARCHAR[]}} AS v FROM conversations
  UNION ALL
  SELECT conv_id, i, state, min(v) FROM (
    SELECT w.conv_id, r.i, put.after AS state,
           {{'cost': v.cost + put.cost + 4, 'audit': v.audit || put.edits || 'D', 'rows': v.rows || put.roles}} AS v
    FROM way w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1 JOIN put ON put.before = w.state
    UNION ALL
    SELECT w.conv_id, r.i, step.target,
           {{'cost': v.cost + put.cost + CASE WHEN r.c = step.target THEN 0 ELSE 3 END + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END,
            'audit': v.audit || put.edits || CASE WHEN r.c = step.target THEN 'K' ELSE 'R' END,
            'rows': v.rows || put.roles || [CASE WHEN r.c = step.target THEN r.role ELSE step.role END || ':' || r.text]}}
    FROM way w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1 JOIN put ON put.before = w.state
    JOIN step ON step.source = put.after
    WHERE fault NOT IN ('blank', 'duplicate') AND (step.target <> 's' OR r.c = 's')) GROUP BY ALL),
best AS (
  SELECT w.conv_id, min({{'cost': v.cost + put.cost, 'audit': v.audit || put.edits, 'rows': v.rows || put.roles}}) AS v
  FROM way w JOIN put ON put.before = w.state AND (put.after = 'a' OR w.state = 'b' AND put.after = 'b')
  WHERE w.i = (SELECT count(*) FROM r WHERE r.conv_id IS NOT DISTINCT FROM w.conv_id) GROUP BY 1),
n AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE i > 1 AND last || c NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY 1)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, v.cost::BIGINT AS cost, v.audit AS audit,
       sha256(array_to_string(v.rows, chr(10))) AS repaired_sha256
FROM best b LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM b.conv_id
"""

AUDIT = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_words('text')} AS w FROM documents),
least AS (SELECT t, min(doc_id) AS least FROM d GROUP BY 1),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         {{'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
           'C': 100 * (len(t) - len(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * len(t),
           'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(least < d.doc_id, false)}} AS fails
  FROM d JOIN least USING (t) LEFT JOIN l ON l.doc_id = d.doc_id),
m AS (
  SELECT part, (CASE WHEN fails.A THEN 'A' ELSE '' END) || (CASE WHEN fails.B THEN 'B' ELSE '' END) || (CASE WHEN fails.C THEN 'C' ELSE '' END)
               || (CASE WHEN fails.D THEN 'D' ELSE '' END) || (CASE WHEN fails.E THEN 'E' ELSE '' END) AS mask,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM f GROUP BY ALL),
c(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM c a, c b, c c, c d, c e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS done
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
x AS (
  SELECT *, contains(mask, letter) AS fails, mask <> '' AND regexp_matches(mask, '[' || done || '_]') AS gone FROM m, steps),
g AS (
  SELECT part, filter_order, step, letter, sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = letter THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM x GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
FROM g
"""

BYTES = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
wins AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 100)) AS x
         FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
first AS (SELECT x, min(doc_id) AS least FROM wins GROUP BY 1),
gone AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM wins JOIN first USING (x) WHERE least < doc_id),
runs AS (SELECT doc_id, i, sum(CASE WHEN step <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM gone),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS z FROM runs GROUP BY ALL),
pieces AS (
  SELECT doc_id, coalesce(lag(z) OVER w, 0) AS a, s.a AS z, h FROM spans s JOIN d USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY s.a)
  UNION ALL SELECT doc_id, max(z), any_value(len(h) // 2), any_value(h) FROM spans JOIN d USING (doc_id) GROUP BY 1),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a) AS rest FROM pieces GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n FROM spans GROUP BY 1)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n.n, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
