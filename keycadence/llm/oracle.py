"""SQL for DuckDB that gives the same rows as the named queries.

The other queries hash, sample, pack or search in ways that SQL does not express;
tests hold them against brute force.
"""

from __future__ import annotations

from itertools import permutations

from .mixing import MOST, SCHEDULES, SHARE, areas

BLANK = r"[\x20\x09-\x0D]+"

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text,
    list_filter(regexp_split_to_array(text, '{BLANK}'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{BLANK}', '', 'g') <> '')
      AS lines
  FROM d
),
windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 4) AS five
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)
),
twins AS (
  SELECT doc_id, i
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM windows)
  WHERE n > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, i, unnest(range(0, 5)) AS k FROM twins) GROUP BY doc_id
),
counts AS (
  SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{BLANK}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    length(regexp_replace(text, '[^!]+', '', 'g')) AS exclamations,
    length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) AS capitals,
    len(string_split(text, chr(10))) AS n_lines
  FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id
),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * exclamations > n_words
    OR 10 * capitals > 4 * word_chars OR 3 * n_dup_lines > n_lines
    OR word_chars < 2 * n_words OR word_chars > 12 * n_words) AS kept
FROM judged
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
last AS (SELECT html, max(page_id) AS source FROM p GROUP BY html),
hashed AS (
  SELECT p.page_id, p.html, source,
    array_to_string(list_transform(string_split(sha1(p.html), ''), lambda h:
      ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010',
       '1011', '1100', '1101', '1110', '1111'][position(h IN '0123456789abcdef')]), '') AS bits
  FROM p JOIN last ON p.html = last.html
)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
      + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
      + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = source THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> source THEN source END AS refers_to
FROM hashed
"""



def _audit_sql() -> str:
    steps = ", ".join(
        f"('{''.join(order)}', {k + 1}, {1 << 'ABCDE'.index(name)}, "
        f"{sum(1 << 'ABCDE'.index(x) for x in order[:k])})"
        for order in permutations("ABCDE")
        for k, name in enumerate(order)
    )
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANK}'), lambda x: x <> '') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents
),
masks AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text)
        THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
  FROM d
),
known AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
  FROM labels GROUP BY doc_id
),
judged AS (
  SELECT masks.*, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN mask = 0 THEN 0 ELSE 120 // bit_count(mask) END AS share
  FROM masks LEFT JOIN known ON masks.doc_id = known.doc_id
),
counts AS (
  SELECT part, mask, share, count(*) AS n, sum(CAST(good AS INT)) AS good,
    sum(CAST(toxic AS INT)) AS toxic
  FROM judged GROUP BY ALL
),
steps(filter_order, step, bit, earlier) AS (VALUES {steps})
SELECT part, filter_order, CAST(step AS INT) AS step,
  CAST(sum(CASE WHEN mask & (bit | earlier) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN mask & earlier <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS BIGINT)
    AS redundant,
  CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS BIGINT)
    AS good_lost,
  CAST(sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS BIGINT)
    AS toxic_lost,
  CAST(sum(CASE WHEN mask & bit <> 0 THEN n * share ELSE 0 END) AS BIGINT) AS shapley
FROM counts, steps GROUP BY part, filter_order, step
"""


def _time_sql(part: str, schedule) -> str:
    """The inverse of a schedule's integral, as the operator forms it."""
    sums = areas(schedule)
    wanted, out = f"({part} * {_double(sums[-1])})", _double(schedule[-1][0])
    for k in reversed(range(len(schedule) - 1)):
        (t, a), (u, b) = schedule[k : k + 2]
        rest = f"({wanted} - {_double(sums[k])})"
        slope = _double(2 * (b - a) / (u - t))
        root = f"sqrt(greatest({_double(a * a)} + {rest} * {slope}, {_double(0)}))"
        inside = (
            f"{_double(t)} + CASE WHEN {rest} > 0 "
            f"THEN {rest} * 2 / ({root} + {_double(a)}) ELSE 0 END"
        )
        out = f"CASE WHEN {wanted} <= {_double(sums[k + 1])} THEN {inside} ELSE {out} END"
    return out


def _double(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _mixing_sql() -> str:
    weights = ", ".join(_double(areas(s)[-1]) for s in SCHEDULES)
    part = "(CAST(start AS DOUBLE) / CAST(asked AS DOUBLE))"
    times = " ".join(f"WHEN {k} THEN {_time_sql(part, s)}" for k, s in enumerate(SCHEDULES))
    return rf"""
WITH d AS (
  SELECT doc_id, source, md5(concat_ws(':', '1', CAST(doc_id AS VARCHAR))) AS mark,
    CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANK}'), lambda x: x <> ''))
      AS BIGINT) AS size
  FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST(row_number() OVER (ORDER BY source NULLS LAST) - 1 AS INT) % {len(SCHEDULES)} AS turn
  FROM d GROUP BY source
),
w AS (
  SELECT *, [{weights}][turn + 1] AS weight, {MOST} * source_size AS most FROM s
),
-- with sources in the order in which they reach their limits, the level once the first k did
ordered AS (
  SELECT *, row_number() OVER (ORDER BY most / weight, source) AS place,
    coalesce(sum(most) OVER (ORDER BY most / weight, source
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reached,
    sum(weight) OVER (ORDER BY most / weight, source
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unmet,
    {_double(SHARE)} * sum(source_size) OVER () AS wanted
  FROM w
),
level AS (
  SELECT (wanted - reached) / unmet AS level FROM ordered
  WHERE (wanted - reached) / unmet * weight <= most ORDER BY place LIMIT 1
),
targets AS (
  SELECT source, source_size, turn,
    least(level * weight, CAST(most AS DOUBLE)) AS target FROM w, level
),
placed AS (
  SELECT d.*, source_size, turn, target, CAST(floor(target + 0.5) AS BIGINT) AS asked,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY mark, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN targets ON d.source IS NOT DISTINCT FROM targets.source
),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN asked // source_size ELSE 0 END AS rounds FROM placed
),
taken AS (
  SELECT *, CAST(rounds * size
    + least(greatest(asked - rounds * source_size - start, 0), size) AS BIGINT) AS taken FROM parts
)
SELECT doc_id, source, size, source_size, target, taken,
  CASE WHEN taken > 0 THEN round(CASE turn {times} END, 6) END AS first_position
FROM taken
"""


def _clustering_sql(k: int = 16, size: int = 64, rounds: int = 3) -> str:
    apart = "list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    out = f"""
WITH x AS MATERIALIZED (
  SELECT vec_id,
    list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {size}
    AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {size}
),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INT) AS k, v FROM (
    SELECT sha256(concat('1:', CAST(vec_id AS VARCHAR))) AS h, v FROM x ORDER BY h LIMIT {k})
)"""
    for r in range(rounds + 1):
        out += f""",
a{r} AS MATERIALIZED (
  SELECT vec_id, x.v AS v, min(struct_pack(d := CAST({apart} AS BIGINT), k := c.k)) AS best
  FROM x, c{r} c GROUP BY vec_id, x.v
)"""
        if r < rounds:
            out += f""",
m{r} AS (
  SELECT k, list(mean ORDER BY i) AS v FROM (
    SELECT k, i, CAST((sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)
      AS mean
    FROM (SELECT best.k AS k, unnest(range(0, {size})) AS i, unnest(v) AS e FROM a{r})
    GROUP BY k, i) GROUP BY k
),
c{r + 1} AS MATERIALIZED (
  SELECT c{r}.k, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} ON c{r}.k = m{r}.k
)"""
    return out + f"""
SELECT vec_id, best.k AS cluster, best.d AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.k = best.k
"""


ORACLE: dict[str, str] = {
    "op1_quality_rules": QUALITY,
    "op7_warc": WARC,
    "op11_filter_audit": _audit_sql(),
    "op12_source_mixing": _mixing_sql(),
    "op13_centroid_clustering": _clustering_sql(),
}
