"""What the queries must give, in DuckDB's SQL."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"


def mixing_sql() -> str:
    """The water level in closed form: sources in order of what fills them first."""
    return f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, sum(source_size) OVER () AS everything, sum(w) OVER () AS weights,
         coalesce(sum(3 * source_size) OVER prior, 0) AS fixed, coalesce(sum(w) OVER prior, 0) AS gone
  FROM s
  WINDOW prior AS (ORDER BY 3 * source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (
  SELECT *, w * (everything - fixed) > 3 * source_size * (weights - gone) AS capped FROM o),
l AS (
  SELECT any_value(everything) - coalesce(sum(3 * source_size) FILTER (capped), 0) AS rest,
         sum(w) FILTER (NOT capped) AS shares FROM c),
t AS (
  SELECT source, source_size, CASE WHEN capped THEN 3 * source_size * shares ELSE w * rest END AS share, shares FROM c, l),
p AS (
  SELECT source, source_size, share::DOUBLE / shares::DOUBLE AS target,
         CASE WHEN source_size = 0 THEN 0 ELSE share // (source_size * shares) END AS copies, share, shares FROM t),
r AS (
  SELECT *, (share - copies * source_size * shares) // shares AS rest FROM p),
x AS (
  SELECT d.doc_id, d.source, d.size, r.source_size, r.target, r.copies, r.rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto,
         sum(size) OVER (PARTITION BY d.source, d.h) AS same
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN upto <= rest OR (upto - same <= rest AND upto - rest < rest - (upto - same)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM x"""


def near_duplicates_sql(words: int = 2, percent: int = 80) -> str:
    """Pairs by shared shingles, components by walking the links."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') AS w FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + {words - 1}], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words} + 2, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
pairs AS MATERIALIZED (
  SELECT x, y FROM met JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * m >= {percent} * (a.n + b.n - m)),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
c AS (SELECT x AS doc_id, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c.y, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(c.y, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id"""


def rules_sql() -> str:
    """The counts by windows over words; the estimation as one step per pair of tables."""
    from hetgraph.llm import rules as R

    listed = ", ".join(f"'{w}'" for w in dict.fromkeys(R.FUNCTION_WORDS))
    votes = ", ".join(
        f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 2 ELSE 1 END AS v_{r}" for r, (good, bad) in R.RULES.items()
    )
    columns = ", ".join(f"v_{r}" for r in R.RULES)
    start = " UNION ALL ".join(
        f"SELECT '{r}' AS rule, {v} AS vote, {R.GOOD_START[v]}::DOUBLE AS good, {R.BAD_START[v]}::DOUBLE AS bad"
        for r in R.RULES
        for v in range(3)
    )
    long = " UNION ALL ".join(f"SELECT {columns}, '{r}' AS rule, v_{r} AS vote, n FROM patterns" for r in R.RULES)
    steps = [f"r0 AS MATERIALIZED (SELECT rule, vote, ln(good / bad) AS w, {R.PRIOR_START}::DOUBLE AS prior FROM start)"]
    for k in range(R.STEPS):
        steps.append(f"""g{k} AS MATERIALIZED (
  SELECT {columns}, n, n / (1 + exp(-(sum(w) + ln(any_value(prior) / (1 - any_value(prior)))))) AS g
  FROM votes JOIN r{k} USING (rule, vote) GROUP BY {columns}, n),
t{k} AS MATERIALIZED (SELECT sum(n) AS n, sum(g) AS g, {R.BELIEF} * sum(n) AS held FROM g{k}),
r{k + 1} AS MATERIALIZED (
  SELECT s.rule, s.vote, ln((coalesce(x.g, 0) + t.held * s.good) / (t.g + t.held)
    / ((coalesce(x.n - x.g, 0) + t.held * s.bad) / (t.n - t.g + t.held))) AS w, (t.g + t.held * {R.PRIOR_START}) / (t.n + t.held) AS prior
  FROM start s CROSS JOIN t{k} t
  LEFT JOIN (SELECT rule, vote, sum(g{k}.n) AS n, sum(g) AS g FROM votes JOIN g{k} USING ({columns}) GROUP BY rule, vote) x
    USING (rule, vote))""")
    last = ", ".join(steps)
    odds = " + ".join(f"(SELECT w FROM r{R.STEPS} WHERE rule = '{r}' AND vote = v_{r})" for r in R.RULES)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (
  SELECT rid, unnest(w) AS w, unnest(range(len(w))) AS i FROM (SELECT rid, regexp_extract_all(t, '{WORD}') AS w FROM d)),
h AS (
  SELECT rid, i, w, CASE WHEN lead(w, 2) OVER o IS NOT NULL THEN w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o END AS h
  FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
f AS (SELECT rid, i, w, h IS NOT NULL AND count(*) OVER (PARTITION BY rid, h) > 1 AS f FROM h),
c AS (SELECT rid, w, max(f) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered FROM f),
a AS (
  SELECT rid, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars, count_if(covered) AS n_repeat_words,
         count_if(lower(w) IN ({listed})) AS n_function, count(DISTINCT w) AS n_distinct
  FROM c GROUP BY rid),
l AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{WORD}') GROUP BY rid),
k AS (
  SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '{R.SYMBOLS}'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_function, 0) AS n_function,
         coalesce(n_distinct, 0) AS n_distinct, len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(regexp_extract_all(t, '[a-z]')) AS n_lower
  FROM d LEFT JOIN a USING (rid) LEFT JOIN l USING (rid)),
v AS MATERIALIZED (SELECT *, {R.BASE_FAILED} AS base_failed, {votes} FROM k),
patterns AS MATERIALIZED (SELECT {columns}, count(*)::DOUBLE AS n FROM v WHERE NOT base_failed GROUP BY {columns}),
votes AS MATERIALIZED ({long.replace(", n FROM", " FROM")}),
start AS ({start}),
{last.replace("FROM votes JOIN r", "FROM patterns JOIN votes USING (" + columns + ") JOIN r")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {odds} + (SELECT ln(any_value(prior) / (1 - any_value(prior))) FROM r{R.STEPS}) >= 0 AS kept
FROM v"""


def resampling_sql() -> str:
    """crc32 bit by bit from the polynomial, over the bytes of the distinct words."""
    from hetgraph.llm import resampling as R

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

    def words(table: str, columns: str) -> str:
        return f"""SELECT {columns} regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{word}') AS w
  FROM {table}"""

    return f"""
WITH d AS MATERIALIZED ({words("documents", "row_number() OVER () AS rid, doc_id,")}),
x AS MATERIALIZED (SELECT rid, w, count(*) AS n FROM (SELECT rid, unnest(w) AS w FROM d) GROUP BY ALL),
y AS MATERIALIZED (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM ({words("benchmark", "")})) GROUP BY ALL),
table_of AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: {step}) ORDER BY b) AS t FROM (SELECT unnest(range(256)) AS b)),
v AS MATERIALIZED (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM x UNION SELECT w FROM y)),
k AS MATERIALIZED (
  SELECT w, xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, len(h) + 1, 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % {R.BUCKETS} AS bucket
  FROM v CROSS JOIN table_of),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM x JOIN k USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::BIGINT AS t FROM y JOIN k USING (w) GROUP BY bucket),
a AS (SELECT (SELECT coalesce(sum(s), 0)::BIGINT FROM s) AS s_all, (SELECT coalesce(sum(t), 0)::BIGINT FROM t) AS t_all),
g AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (s_all + {R.BUCKETS})::DOUBLE)
    / ((s + 1)::DOUBLE * (t_all + {R.BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket), a),
e AS (SELECT rid, sum(n * gain)::BIGINT AS weight FROM x JOIN k USING (w) JOIN g USING (bucket) GROUP BY rid),
f AS (
  SELECT rid, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{R.SEED}:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN e USING (rid)),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM f WHERE n_features >= {R.LEAST_WORDS}),
m AS (SELECT {R.PERCENT} * count(*) // 100 AS m FROM r)
SELECT f.doc_id, f.n_features, f.weight, f.score, CASE WHEN r.rank <= m THEN r.rank END AS rank
FROM f LEFT JOIN r USING (rid), m"""


def vector_codes_sql() -> str:
    """Plain Lloyd, one pair of tables per round."""
    from hetgraph.llm import product_codes as P

    n = P.PARTS
    cut = f"x[part * len(x) // {n} + 1 : (part + 1) * len(x) // {n}]"
    steps = []
    for k in range(P.ROUNDS + 1):
        steps.append(f"""d{k} AS MATERIALIZED (
  SELECT rid, part, min(struct_pack(
      d := (list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c))::BIGINT, e := entry)) AS m
  FROM p JOIN b{k} USING (part) GROUP BY rid, part)""")
        if k < P.ROUNDS:
            steps.append(f"""b{k + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(n.c, b{k}.c) AS c FROM b{k} LEFT JOIN (
    SELECT part, entry, list(floor(s / n) ORDER BY pos) AS c FROM (
      SELECT part, m.e AS entry, pos, sum(v) AS s, count(*) AS n
      FROM d{k} JOIN (SELECT rid, part, unnest(x) AS v, unnest(range(len(x))) AS pos FROM p) USING (rid, part) GROUP BY ALL)
    GROUP BY part, entry) n USING (part, entry))""")
    return f"""
WITH good AS (
  SELECT row_number() OVER () AS rid, vec_id, label, embedding FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v) AND abs(v) < {P.LIMIT})) = len(embedding)),
d AS (SELECT len(embedding) AS d FROM good GROUP BY 1 ORDER BY count(*) DESC, d LIMIT 1),
q AS MATERIALIZED (
  SELECT rid, vec_id, label, embedding, list_transform(embedding, lambda v: floor({P.SCALE} * v::DOUBLE)) AS x
  FROM good WHERE len(embedding) = (SELECT d FROM d)),
p AS MATERIALIZED (SELECT rid, part, {cut} AS x FROM q CROSS JOIN (SELECT unnest(range({n})) AS part)),
f AS (
  SELECT (row_number() OVER (ORDER BY vec_id NULLS LAST) - 1)::BIGINT AS entry, x
  FROM (SELECT vec_id, arg_min(x, embedding) AS x FROM q GROUP BY vec_id) ORDER BY entry LIMIT {P.ENTRIES}),
b0 AS MATERIALIZED (SELECT part, entry, {cut} AS c FROM f CROSS JOIN (SELECT unnest(range({n})) AS part)),
{", ".join(steps)},
h AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda v: v::BIGINT::VARCHAR), ','), ',' ORDER BY part, entry)) AS h FROM b{P.ROUNDS}),
r AS (SELECT rid, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM d{P.ROUNDS} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM q JOIN r USING (rid), h"""
