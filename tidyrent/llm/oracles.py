"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

from . import quality_rules, urls
from .queries import CENTROID_DIMS, CENTROID_ROUNDS, CENTROID_SEED, CENTROIDS, COSINE, MIX_BLOCK_ROWS, MIX_WEIGHTS, SCALE, TOP_K, URL_RULES

FINE = "{v} IS NOT NULL AND len([x FOR x IN {v} IF x IS NULL OR NOT isfinite(x)]) = 0"


def op2() -> str:
    weight = " ".join(f"WHEN '{s}' THEN {w}" for s, w in MIX_WEIGHTS.items())
    return f"""
WITH RECURSIVE named AS (SELECT coalesce(source, '') AS s, count(*) AS n FROM documents GROUP BY 1),
arr AS (SELECT list(s ORDER BY s) AS names, list(cast(ceil(n / {MIX_BLOCK_ROWS}.0) AS BIGINT) ORDER BY s) AS blocks,
               list(cast(CASE s {weight} ELSE 1 END AS BIGINT) ORDER BY s) AS ws, count(*) AS k FROM named),
state AS (
  SELECT cast(-1 AS BIGINT) AS slot, cast(0 AS BIGINT) AS phase, cast(0 AS BIGINT) AS start,
         [cast(0 AS BIGINT) FOR i IN names] AS used, [cast(0 AS BIGINT) FOR i IN names] AS base,
         cast(NULL AS STRUCT(due BIGINT, i BIGINT, rel BIGINT)) AS pick, cast(0 AS BIGINT) AS done_phase
  FROM arr
  UNION ALL
  SELECT slot, CASE WHEN ended THEN phase + 1 ELSE phase END, CASE WHEN ended THEN slot + 1 ELSE start END,
         used, CASE WHEN ended THEN used ELSE base END, pick, phase
  FROM (SELECT *, used[pick.i] = blocks[pick.i] AS ended
        FROM (SELECT slot, phase, start, base, pick, blocks, [CASE WHEN i = pick.i THEN used[i] + 1 ELSE used[i] END FOR i IN range(1, k + 1)] AS used
              FROM (SELECT slot + 1 AS slot, phase, start, used, base, blocks, k,
                           list_min([{{'due': start + (((used[i] - base[i] + 1) * total + ws[i] - 1) // ws[i]), 'i': i,
                                      'rel': start + (used[i] - base[i]) * total // ws[i]}}
                                     FOR i IN range(1, k + 1)
                                     IF used[i] < blocks[i] AND start + (used[i] - base[i]) * total // ws[i] <= slot + 1]) AS pick
                    FROM (SELECT state.*, blocks, ws, k, list_sum([ws[i] FOR i IN range(1, k + 1) IF base[i] < blocks[i]])::BIGINT AS total
                          FROM state, arr)
                    WHERE list_sum(used) < list_sum(blocks))))),
served AS (SELECT slot, done_phase AS phase, pick.rel AS release, pick.due AS deadline, names[pick.i] AS s, used[pick.i] - 1 AS block
           FROM state, arr WHERE pick IS NOT NULL),
ranked AS (SELECT doc_id, source, coalesce(source, '') AS s, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id) - 1 AS r FROM documents)
SELECT doc_id, source, phase, block, release, deadline, slot, r % {MIX_BLOCK_ROWS} AS place
FROM ranked JOIN served ON ranked.s = served.s AND r // {MIX_BLOCK_ROWS} = block"""


OP3 = f"""
WITH v AS (SELECT vec_id, [floor({SCALE} * cast(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND {FINE.format(v="embedding")}),
s AS (SELECT a.vec_id AS query_id, b.vec_id, cast(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {TOP_K}"""

OP7 = r"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS own(t, r)),
e AS (SELECT *, length(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ':', '\c')) AS role_chars,
             length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t')) AS text_chars FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       cast(sum(4 + role_chars + 2 + text_chars + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

OP8 = f"""
WITH RECURSIVE d AS (SELECT vec_id, label, cast(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm FROM d
      WHERE label IS NOT NULL AND len(v) > 0 AND {FINE.format(v="v")}),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {COSINE}),
r AS (SELECT vec_id AS a, vec_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.a AS vec_id, coalesce(n.n, 0) AS n_links, component_id, c.a = component_id AS kept FROM c LEFT JOIN n ON c.a = n.a"""


def op9() -> str:
    values = ", ".join(f"({k}, '{v}', '{h}', '{p}')" for k, (v, h, p) in enumerate(URL_RULES))
    steps = []
    for k in range(1, urls.MAX_DEPTH + 2):
        steps.append(f"""
b{k} AS (SELECT host, template, shape[{k}] AS branch, sum(labels) AS l, sum(bad) AS b FROM t{k - 1} WHERE len(shape) >= {k} GROUP BY ALL),
g{k} AS (SELECT host, template, sum(b) / nullif(sum(l), 0) AS p FROM b{k} GROUP BY ALL),
m{k} AS (SELECT host, template, branch FROM b{k} JOIN g{k} USING (host, template)
         WHERE l >= {urls.MIN_LABELS} AND abs(b - l * p) <= {urls.Z} * sqrt(l * p * (1 - p)) + 0.5),
e{k} AS (SELECT DISTINCT t.host, t.template, t.shape[{k + 1}:] AS below FROM t{k - 1} t
         JOIN m{k} m ON t.host = m.host AND t.template = m.template AND t.shape[{k}] = m.branch),
q{k} AS (SELECT * FROM m{k} UNION ALL
         SELECT b.host, b.template, b.branch FROM b{k} b
         JOIN t{k - 1} t ON t.host = b.host AND t.template = b.template AND t.shape[{k}] = b.branch
         LEFT JOIN e{k} e ON e.host = t.host AND e.template = t.template AND e.below = t.shape[{k + 1}:]
         WHERE b.l < {urls.MIN_LABELS} GROUP BY ALL HAVING sum(t.n) >= {urls.MIN_LABELS} AND 2 * sum(CASE WHEN e.host IS NULL THEN 0 ELSE t.n END) >= sum(t.n)),
t{k} AS (SELECT t.host, t.shape, n, labels, bad, CASE WHEN len(t.shape) < {k} THEN t.template
                WHEN m.branch IS NULL THEN t.template || '/' || t.shape[{k}] ELSE t.template || '/*' END AS template
         FROM t{k - 1} t LEFT JOIN q{k} m ON t.host = m.host AND t.template = m.template AND t.shape[{k}] = m.branch)""")
    last = f"t{urls.MAX_DEPTH + 1}"
    return f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
s AS (SELECT page_id, translate(raw, '{urls.UPPER}', '{urls.LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
rules(place, verdict, rhost, rpath) AS (VALUES {values}),
f AS (SELECT page_id, arg_max({{'rule': rhost || rpath, 'verdict': verdict}}, (length(rhost) + length(rpath)) * 1000 + place) AS fit
      FROM s JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
parts AS (SELECT page_id, host, path, string_split(regexp_replace(path, '^/', ''), '/') AS p FROM s),
pieces AS (SELECT page_id, host, path, [CASE WHEN length(x) >= 16 AND regexp_matches(x, '^[0-9A-Za-z_-]*[0-9][0-9A-Za-z_-]*$') AND regexp_matches(x, '[A-Za-z]')
                  THEN '{{id}}' ELSE regexp_replace(x, '[0-9]+', '{{n}}', 'g') END FOR x IN p] AS p FROM parts),
shaped AS (SELECT page_id, host, path, CASE WHEN len(p) > {urls.MAX_DEPTH}
                  THEN list_append(p[1:{urls.MAX_DEPTH}], array_to_string(p[{urls.MAX_DEPTH + 1}:], '/')) ELSE p END AS shape FROM pieces),
t0 AS (SELECT host, shape, count(*) AS n, count(fit) AS labels, count(*) FILTER (fit.verdict = 'block') AS bad, '' AS template
       FROM shaped LEFT JOIN f USING (page_id) GROUP BY host, shape),{",".join(steps)},
total AS (SELECT (sum(labels) - sum(bad) + 1) / (sum(labels) + 2) AS good FROM t0),
pure AS (SELECT host, template, (sum(labels) - sum(bad) + {urls.STRENGTH} * any_value(good)) / (sum(labels) + {urls.STRENGTH}) AS purity
         FROM {last}, total GROUP BY host, template)
SELECT shaped.page_id, shaped.host, path, fit.rule AS rule,
       coalesce(fit.verdict, CASE WHEN purity < {urls.MIN_PURITY} THEN 'block' ELSE 'allow' END) AS verdict, z.template
FROM shaped LEFT JOIN f USING (page_id) JOIN {last} z ON shaped.host = z.host AND shaped.shape = z.shape
JOIN pure ON z.host = pure.host AND z.template = pure.template"""


def op11() -> str:
    stops = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
    fails = {}
    for name, count, per, low, high, base in quality_rules.TABLE:
        share = [f"{count} < cast({low} AS DECIMAL(9, 3)) * {per or 1}" if low else "", f"{count} > cast({high} AS DECIMAL(9, 3)) * {per or 1}" if high else ""]
        fails[name] = (" OR ".join(x for x in share if x), base)
    base = " OR ".join(f"({f})" for f, b in fails.values() if b)
    named = ", ".join(f"CASE WHEN {f} THEN '{n}' END" for n, (f, _) in fails.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
grams AS (SELECT rid, i, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM s)),
again AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
gaps AS (SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS n FROM again),
cover AS (SELECT rid, sum(n) AS n FROM gaps GROUP BY rid),
c AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             length(regexp_replace(t, '[^!?]', '', 'g')) AS n_exclamations, len(list_filter(w, lambda x: regexp_matches(x, '\\pL'))) AS n_letter_words,
             len(list_filter(w, lambda x: x = upper(x) AND x <> lower(x))) AS n_capital_words,
             len(list_filter(w, lambda x: rtrim(lower(x), '{quality_rules.MARKS}') IN ({stops}))) AS n_stop_words,
             len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
             len(list_filter(l, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•]'))) AS n_bullet_lines,
             len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) AS n_ellipsis_lines,
             cast(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM s LEFT JOIN cover USING (rid)),
v AS (SELECT *, {base} AS base_failed, list_filter([{named}], lambda x: x IS NOT NULL) AS failing FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, len(failing) = 0 AS kept, n_stop_words,
       array_to_string(failing, ', ') AS failed
FROM v"""


def op13() -> str:
    least = """(SELECT r, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'j': j}}) AS a
       FROM v, c{n} GROUP BY r)"""
    steps = []
    for n in range(1, CENTROID_ROUNDS + 1):
        steps.append(f"""
a{n} AS (SELECT r, a.j AS j FROM {least.format(n=n - 1)}),
c{n} AS (SELECT c{n - 1}.j, coalesce(m.c, c{n - 1}.c) AS c FROM c{n - 1} LEFT JOIN (
    SELECT j, list(m ORDER BY i) AS c FROM (SELECT j, i, cast(floor(sum(x[i])::DOUBLE / count(*)) AS BIGINT) AS m
    FROM a{n} JOIN v USING (r), range(1, {CENTROID_DIMS + 1}) AS g(i) GROUP BY j, i) GROUP BY j) m ON c{n - 1}.j = m.j)""")
    return f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: cast(floor({SCALE} * cast(e AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings WHERE len(embedding) = {CENTROID_DIMS} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{CENTROID_SEED}:' || vec_id), x) - 1 AS j, x AS c FROM v WHERE vec_id IS NOT NULL
       QUALIFY j < {CENTROIDS}),{",".join(steps)},
z AS (SELECT r, a.j AS j, a.d AS d FROM {least.format(n=CENTROID_ROUNDS)})
SELECT vec_id, cast(j AS INTEGER) AS cluster, d AS distance, cast(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
       cast(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM z JOIN v USING (r) JOIN c{CENTROID_ROUNDS} USING (j)"""


ORACLES = {"op2_pfair_mix": op2(), "op3_exact_topk": OP3, "op7_chat": OP7, "op8_cover_tree": OP8, "op9_url_filter": op9(),
           "op11_quality_rules": op11(), "op13_centroids": op13()}
