"""DuckDB SQL of the queries that SQL can express."""

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES = {
    "op5_minhash_near_dedup": f"""
WITH RECURSIVE t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT doc_id, {_WORDS} AS w FROM t),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
rows AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM rows a JOIN rows b ON a.g = b.g AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = s.doc_id""",
    "op9_substring_dedup": f"""
WITH t AS (SELECT doc_id, {_WORDS} AS w FROM documents),
runs AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM t WHERE len(w) >= 13),
keyed AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM runs),
firsts AS (SELECT k, min(doc_id) AS d FROM keyed GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM keyed JOIN firsts USING (k) WHERE doc_id > d),
lost AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE
         list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(ps, j)), lambda j: w[j]) END, ' ')) AS kept_sha256
FROM t LEFT JOIN lost USING (doc_id)""",
    "op6_chat_formatting": r"""
WITH t AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, min({'role': coalesce(role, ''), 'text': coalesce(text, '')}) AS said FROM conversations
           WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
l AS (SELECT conv_id, max(turn) AS turn, arg_max(said.text, turn) AS text FROM t WHERE said.role = 'assistant' GROUP BY conv_id),
y AS (SELECT l.conv_id, l.turn, o.text FROM l JOIN l o ON o.conv_id = CASE WHEN l.conv_id % 2 = 0 THEN l.conv_id + 1 ELSE l.conv_id - 1 END),
b AS (SELECT t.conv_id AS pair_id, t.turn, t.said AS chosen,
             CASE WHEN y.conv_id IS NOT NULL THEN {'role': said.role, 'text': CASE WHEN t.turn = y.turn THEN y.text ELSE said.text END} END AS rejected
      FROM t LEFT JOIN y ON y.conv_id = t.conv_id),
d AS (SELECT pair_id, min(CASE WHEN chosen IS DISTINCT FROM rejected THEN turn END) AS parted FROM b GROUP BY pair_id),
s AS (SELECT b.pair_id, turn, 'prompt' AS segment, chosen AS said FROM b JOIN d USING (pair_id) WHERE parted IS NULL OR turn < parted
      UNION ALL SELECT b.pair_id, turn, 'chosen', chosen FROM b JOIN d USING (pair_id) WHERE turn >= parted
      UNION ALL SELECT b.pair_id, turn, 'rejected', rejected FROM b JOIN d USING (pair_id) WHERE turn >= parted AND rejected IS NOT NULL),
r AS (SELECT pair_id, CAST(floor(turn / 64) AS BIGINT) AS stretch, turn, segment, segment <> 'prompt' AND said.role = 'assistant' AS loss,
             '<|' || said.role || '|>' || chr(10) || said.text || chr(10) AS rendered, length(said.role) + 5 AS head FROM s),
o AS (SELECT *, coalesce(sum(length(rendered)) OVER (PARTITION BY pair_id, stretch, segment ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM r)
SELECT pair_id, stretch, coalesce(string_agg(rendered, '' ORDER BY turn) FILTER (segment = 'prompt'), '') AS prompt,
       coalesce(string_agg(rendered, '' ORDER BY turn) FILTER (segment = 'chosen'), '') AS chosen,
       coalesce(string_agg(rendered, '' ORDER BY turn) FILTER (segment = 'rejected'), '') AS rejected,
       coalesce(string_agg(concat(ahead + head, ':', ahead + length(rendered)), ' ' ORDER BY turn) FILTER (segment = 'chosen' AND loss), '') AS chosen_mask,
       coalesce(string_agg(concat(ahead + head, ':', ahead + length(rendered)), ' ' ORDER BY turn) FILTER (segment = 'rejected' AND loss), '') AS rejected_mask
FROM o GROUP BY pair_id, stretch""",
    "op13_periodic_runs": f"""
WITH t AS (SELECT doc_id, {_WORDS} AS w,
  xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS h FROM documents),
n AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) % greatest(len(w), 1) AS a, h // 10 AS g FROM t),
given AS (SELECT doc_id, n, planted, a, 1 + (n - a) // (3 + g % 8) AS p FROM n),
said AS (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word FROM t),
m AS (SELECT s.doc_id, s.i, o.word, g.n FROM said s JOIN given g USING (doc_id)
      JOIN said o ON o.doc_id = s.doc_id AND o.i = CASE WHEN planted AND s.i >= a THEN a + (s.i - a) % p ELSE s.i END),
same AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM m x JOIN m y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
long AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM long x WHERE NOT EXISTS (
           SELECT 1 FROM long y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.s <= x.s AND y.s + y.l >= x.s + x.l)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM m ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
per_doc AS (SELECT doc_id, count(*) AS n_runs, first({{'s': s, 'l': l, 'q': q}} ORDER BY l DESC, s, q) AS best,
              string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS lines FROM runs GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length,
       CAST(best.q AS BIGINT) AS period, CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM t LEFT JOIN per_doc USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}
