"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from tallyboard.llm.clusters import CLUSTERS, DIMENSIONS as COMPONENTS, ROUNDS as MEAN_ROUNDS, SCALE
from tallyboard.llm.divergence import LEAST_DOCUMENTS, PRIOR, TOP_TERMS, UNIT
from tallyboard.llm.mixing import DIMENSIONS, DRAWN, OTHER, ROUNDS, TEMPER, TOPICS
from tallyboard.llm.url_filter import RULES, SOFT, SOFT_HITS, STRICT

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def url_filter_sql() -> str:
    by_length = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in by_length]
    rule = " ".join(f"WHEN {test} THEN '{text}'" for test, text, _ in fits)
    ruled = " ".join(f"WHEN {test} THEN '{verdict}'" for test, _, verdict in fits)
    return f"""
WITH split AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
terms AS (
  SELECT *, list_distinct(string_split_regex(translate(url, '{UPPER}', '{LOWER}'), '[^\\p{{L}}\\p{{N}}]+')) AS words
  FROM split),
counted AS (
  SELECT *, len(list_filter(words, lambda w: w IN ({quoted(STRICT)}))) AS hard,
         len(list_filter(words, lambda w: w IN ({quoted(SOFT)}))) AS weak
  FROM terms)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {ruled} WHEN hard > 0 OR weak >= {SOFT_HITS} THEN 'block' ELSE 'allow' END AS verdict,
       CAST(hard AS INTEGER) AS strict_hits, CAST(weak AS INTEGER) AS soft_hits
FROM counted"""


def mixing_sql() -> str:
    """The raking written out, one step per dimension and round, and the scale that draws `DRAWN` of the tokens.

    With the cells in descending order of rate, the scale is the largest of those that result from taking the
    first k cells whole.
    """
    every = sorted({k for keys in TOPICS.values() for k in keys})
    counts = ", ".join(
        f"len(list_distinct(list_filter(met, lambda k: k IN ({quoted(keys)})))) AS n_{t}" for t, keys in TOPICS.items()
    )
    most = f"greatest({', '.join(f'n_{t}' for t in TOPICS)}, 1)"
    topic = " ".join(f"WHEN n_{t} = {most} THEN '{t}'" for t in TOPICS)
    dims = ", ".join(DIMENSIONS)
    targets = ", ".join(f"pow(CAST(sum(tokens) OVER (PARTITION BY {d}) AS DOUBLE), {TEMPER}) AS t_{d}" for d in DIMENSIONS)
    kept = ", ".join(f"t_{d}" for d in DIMENSIONS)
    steps, last = [], "w"
    for i in range(ROUNDS):
        for d in DIMENSIONS:
            total = f"sum(weight) OVER (PARTITION BY {d})"
            scaled = f"CASE WHEN {total} > 0 THEN weight * t_{d} / {total} ELSE 0 END AS weight"
            steps.append(f"w{i}_{d} AS (SELECT {dims}, tokens, {kept}, {scaled} FROM {last})")
            last = f"w{i}_{d}"
    same = " AND ".join(f"m.{d} IS NOT DISTINCT FROM p.{d}" for d in DIMENSIONS)
    white = "[ \\t-\\r]+"
    return f"""
WITH found AS (
  SELECT doc_id, source, lang,
         list_filter(string_split_regex(lower(coalesce(text, '')), '{white}'), lambda x: x <> '') AS found FROM documents),
met AS (
  SELECT doc_id, source, lang, CAST(len(found) AS BIGINT) AS n_tokens,
         list_filter(found, lambda x: x IN ({quoted(every)})) AS met FROM found),
counted AS (SELECT *, {counts} FROM met),
marked AS (SELECT doc_id, source, lang, n_tokens, CASE {topic} ELSE '{OTHER}' END AS topic FROM counted),
cells AS (SELECT {dims}, sum(n_tokens) AS tokens FROM marked GROUP BY {dims}),
w AS (SELECT {dims}, tokens, {targets}, CAST(tokens AS DOUBLE) AS weight FROM cells),
{", ".join(steps)},
rates AS (SELECT {dims}, tokens, weight, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS rate FROM {last}),
falling AS (
  SELECT coalesce(sum(tokens) OVER (ORDER BY rate DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS whole,
         sum(weight) OVER (ORDER BY rate DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM rates WHERE weight > 0),
scaled AS (SELECT max(({DRAWN} * (SELECT sum(tokens) FROM rates) - whole) / rest) AS scale FROM falling),
p AS (SELECT {dims}, round(least(rate * coalesce((SELECT scale FROM scaled), 0), 1), 9) AS probability FROM rates)
SELECT m.doc_id, m.source, m.lang, m.topic, m.n_tokens, p.probability,
       CAST('0x' || substr(md5(coalesce(CAST(m.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 < p.probability AS drawn
FROM marked m JOIN p ON {same}"""


def divergence_sql() -> str:
    share = lambda n, total: f"1 + ({UNIT}::HUGEINT * ({n} + {PRIOR})) // ({total} + {PRIOR} * v)"
    return f"""
WITH texts AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
spread AS (SELECT lang, unnest(list_distinct(terms)) AS term FROM texts),
kept AS (SELECT lang, term FROM spread GROUP BY lang, term HAVING count(*) >= {LEAST_DOCUMENTS}),
groups AS (SELECT DISTINCT lang, source FROM texts),
found AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM texts)
  SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0)::HUGEINT AS n
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
sized AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM grid GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, g.term, g.n, {share("g.n", "total")} AS p
  FROM grid g JOIN totals t ON t.lang = g.lang AND t.source = g.source JOIN sized s ON s.lang = g.lang),
q AS (
  SELECT lang, term, {share("n", "total")} AS q
  FROM (SELECT lang, term, sum(n) AS n FROM grid GROUP BY lang, term)
  JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) USING (lang) JOIN sized USING (lang)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value
  FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= {TOP_TERMS}"""


def clusters_sql() -> str:
    """The rounds written out; a vector is one row per component."""
    finite = f"len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}"
    steps = []
    for i in range(MEAN_ROUNDS + 1):
        steps.append(f"""
d{i} AS MATERIALIZED (
  SELECT p.row, c.cluster, sum((p.x - c.x) * (p.x - c.x)) AS distance
  FROM parts p JOIN c{i} c ON p.place = c.place GROUP BY p.row, c.cluster),
a{i} AS MATERIALIZED (
  SELECT row, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM d{i} GROUP BY row)""")
        if i < MEAN_ROUNDS:
            steps.append(f"""
m{i} AS (
  SELECT a.cluster, p.place, (sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) // count(*) AS x
  FROM parts p JOIN a{i} a ON a.row = p.row GROUP BY a.cluster, p.place),
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, c.place, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.cluster = c.cluster AND m.place = c.place)""")
    last = MEAN_ROUNDS
    return f"""
WITH sound AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), embedding) - 1 AS row, vec_id, embedding
  FROM embeddings WHERE len(embedding) = {COMPONENTS} AND {finite}),
parts AS MATERIALIZED (
  SELECT row, unnest(range({COMPONENTS})) AS place, unnest(list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::HUGEINT)) AS x
  FROM sound),
c0 AS MATERIALIZED (SELECT row AS cluster, place, x FROM parts WHERE row < {CLUSTERS}),
{",".join(steps)},
hashes AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM c{last} GROUP BY cluster),
sums AS (SELECT cluster, sum(distance) AS cluster_inertia FROM a{last} GROUP BY cluster)
SELECT s.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(cluster_inertia AS BIGINT) AS cluster_inertia, CAST((SELECT sum(distance) FROM a{last}) AS BIGINT) AS inertia, centroid_sha256
FROM a{last} a JOIN sound s ON s.row = a.row JOIN hashes h ON h.cluster = a.cluster JOIN sums u ON u.cluster = a.cluster"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mixing": mixing_sql(),
        "op7_url_filter": url_filter_sql(),
        "op12_divergence": divergence_sql(),
        "op13_clusters": clusters_sql(),
    }
