"""SQL of the similarity ratio: the recursion over matching blocks as a recursive CTE.

The best block of a pair is its longest common substring, of equally long ones the first in
the left string, then in the right one; what stands left and right of it is searched in turn.
"""

from __future__ import annotations


def ratio_ctes(left: str, right: str, threshold: float) -> str:
    """CTEs up to ``ratio(a, b, score)``, the pairs at or over the threshold, unrounded.

    ``left`` and ``right`` are queries of one column of strings of under 200 characters.
    """
    return f"""left_of(a) AS MATERIALIZED (SELECT DISTINCT * FROM ({left})), right_of(b) AS MATERIALIZED (SELECT DISTINCT * FROM ({right})),
strings(s) AS (SELECT a FROM left_of UNION SELECT b FROM right_of),
letters AS MATERIALIZED (SELECT s, i, substr(s, i, 1) AS c FROM (SELECT s, unnest(range(1, length(s) + 1)) AS i FROM strings)),
bags AS MATERIALIZED (SELECT s, c, count(*) AS n FROM letters GROUP BY ALL),
pairs AS MATERIALIZED (
  SELECT x.s AS a, y.s AS b FROM bags x JOIN bags y USING (c) WHERE x.s IN (SELECT a FROM left_of) AND y.s IN (SELECT b FROM right_of)
  GROUP BY ALL HAVING 2.0::DOUBLE * sum(least(x.n, y.n)) >= {threshold} * (length(x.s) + length(y.s)) - 1e-9),
equal_letters AS (
  SELECT a, b, x.i AS i, y.i AS j, x.i - row_number() OVER (PARTITION BY a, b, x.i - y.i ORDER BY x.i) AS island
  FROM pairs JOIN letters x ON x.s = a JOIN letters y ON y.s = b AND y.c = x.c),
runs AS MATERIALIZED (SELECT a, b, i, j, row_number() OVER (PARTITION BY a, b, i - j, island ORDER BY i DESC) AS n FROM equal_letters),
blocks(a, b, a_low, a_high, b_low, b_high, i, j, n) AS (
  SELECT a, b, 1, length(a) + 1, 1, length(b) + 1, i, j, n FROM runs
  QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY n DESC, i, j) = 1
  UNION ALL
  SELECT p.a, p.b, p.a_low, p.a_high, p.b_low, p.b_high, r.i, r.j, least(r.n, p.a_high - r.i, p.b_high - r.j) AS size
  FROM (
    SELECT a, b, a_low, i AS a_high, b_low, j AS b_high FROM blocks WHERE a_low < i AND b_low < j
    UNION ALL SELECT a, b, i + n, a_high, j + n, b_high FROM blocks WHERE i + n < a_high AND j + n < b_high) p
  JOIN runs r ON r.a = p.a AND r.b = p.b AND r.i >= p.a_low AND r.i < p.a_high AND r.j >= p.b_low AND r.j < p.b_high
  QUALIFY row_number() OVER (PARTITION BY p.a, p.b, p.a_low, p.b_low ORDER BY size DESC, r.i, r.j) = 1),
ratio AS MATERIALIZED (
  SELECT a, b, 2.0::DOUBLE * sum(n) / (length(a) + length(b)) AS score FROM blocks GROUP BY a, b
  HAVING 2.0::DOUBLE * sum(n) / (length(a) + length(b)) >= {threshold})"""
