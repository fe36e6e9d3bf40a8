"""DuckDB SQL for the query of secrets.py: the same patterns, the rules written
out as self-joins."""

from __future__ import annotations

from .secrets import BLANK_LINES, IDENTIFIERS, KINDS, ORDER, REACH, SECRETS, STRONG


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _names(kinds: list[str]) -> str:
    return "(" + ", ".join(map(_text, kinds)) + ")"


def _matches(number: int, kind: str) -> str:
    pattern, group, least, _ = KINDS[kind]
    p = _text(pattern)
    good = (f"length(x.g) >= {least}" if kind != "opaque" else
            "regexp_matches(x.g, '[A-Z]') AND regexp_matches(x.g, '[a-z]') AND regexp_matches(x.g, '[0-9]')")
    return f"""SELECT r, {number} AS number, '{kind}' AS kind, b, b + length(h[i]) AS e FROM (
  SELECT r, i, h, g[i] AS g, CAST(list_sum(list_transform(s[1:i], lambda y: length(y)))
    + coalesce(list_sum(list_transform(h[1:i - 1], lambda y: length(y))), 0) AS BIGINT) AS b
  FROM (SELECT r, string_split_regex(t, {p}) AS s, regexp_extract_all(t, {p}) AS h, regexp_extract_all(t, {p}, {group}) AS g FROM d),
    unnest(range(1, len(h) + 1)) u(i)) x WHERE {good}"""


def _sql() -> str:
    tables = [f"m{n} AS MATERIALIZED ({_matches(n, k)})" for n, k in enumerate(ORDER)]
    held = [f"m{n}" for n in range(len(STRONG))]
    for n in range(len(STRONG), len(ORDER)):
        before = " UNION ALL ".join(f"SELECT * FROM {x}" for x in held)
        tables.append(f"w{n} AS MATERIALIZED (SELECT * FROM m{n} x WHERE NOT EXISTS (SELECT 1 FROM ({before}) y "
                      "WHERE y.r = x.r AND y.b < x.e AND y.e > x.b))")
        held.append(f"w{n}")
    every = " UNION ALL ".join(f"SELECT * FROM {x}" for x in held)
    blank = _text(BLANK_LINES)
    told = f"""CASE WHEN x.kind = 'user' THEN bool_or(y.kind IN {_names(SECRETS)})
    WHEN x.kind = 'endpoint' THEN bool_or(y.kind IN {_names([k for k in STRONG if k in SECRETS])})
      OR bool_or(y.kind IN {_names(IDENTIFIERS)}) AND bool_or(y.kind IN {_names(SECRETS)})
    ELSE bool_or(y.kind IN {_names(IDENTIFIERS)}) END"""
    joined = "string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, number)"
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
{", ".join(tables)},
p AS MATERIALIZED ({every}),
s AS (SELECT r, string_split_regex(t, {blank}) AS s, regexp_extract_all(t, {blank}) AS h FROM d WHERE r IN (SELECT r FROM p WHERE number > 2)),
k AS (SELECT r, j, CAST(coalesce(list_sum(list_transform(s[1:j - 1], lambda y: length(y))), 0)
    + coalesce(list_sum(list_transform(h[1:j - 1], lambda y: length(y))), 0) AS BIGINT) AS lo, length(s[j]) AS n
  FROM s, unnest(range(1, len(s) + 1)) u(j)),
q AS (SELECT p.*, k.j, CAST(floor((p.b - k.lo) / {REACH}) AS BIGINT) - o AS scope
  FROM p JOIN k ON k.r = p.r AND p.b >= k.lo AND p.b < k.lo + k.n, unnest([0, 1]) v(o)),
t AS (SELECT DISTINCT r, number, kind, b, e FROM (
  SELECT x.r, x.number, x.kind, x.b, x.e, x.scope, {told} AS yes
  FROM q x JOIN q y ON x.r = y.r AND x.j = y.j AND x.scope = y.scope WHERE x.number > 2 GROUP BY x.r, x.number, x.kind, x.b, x.e, x.scope) WHERE yes),
z AS (SELECT r, number, kind, b, e FROM p WHERE number <= 2 UNION ALL SELECT * FROM t),
f AS (SELECT r, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in STRONG)},
  {joined.replace(")", ") FILTER (number <= 2)", 1)} AS base, {joined} AS spans FROM z GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in STRONG)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM d LEFT JOIN f USING (r)"""


SECRETS_SQL = _sql()
