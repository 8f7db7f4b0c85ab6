"""SQL twins of the drift definitions."""

from __future__ import annotations

from riskloom.plans.sql import D


def _bin(column: str, numeric: bool) -> str:
    if not numeric:
        return f"coalesce(CAST({column} AS VARCHAR), '__null__')"
    x = f"CAST({column} AS DOUBLE)"
    share = f"({x} - e.lo_{column}) / (e.hi_{column} - e.lo_{column}) * {D(10)}"
    return f"""CASE WHEN {column} IS NULL THEN '-1'
      WHEN e.hi_{column} = e.lo_{column} THEN CASE WHEN {x} > e.lo_{column} THEN '9' ELSE '0' END
      ELSE CAST(CAST(floor(least({D(9)}, greatest({D(0)}, {share}))) AS INTEGER) AS VARCHAR) END"""


def drift_ctes(
    base: str, live: str, numeric=(), categorical=(), segments=(), window: str | None = None
) -> str:
    """CTEs ending in ``drift_out`` (window_start?, segment_column, segment_value, "column", psi, kl, jsd)."""
    edges = ", ".join(
        f"min(CAST({c} AS DOUBLE)) AS lo_{c}, max(CAST({c} AS DOUBLE)) AS hi_{c}" for c in numeric
    ) or "0 AS none"
    views = [("'__all__'", "'__all__'")] + [(f"'{s}'", f"coalesce(CAST({s} AS VARCHAR), '__null__')") for s in segments]

    def counts(source: str, extra: str) -> str:
        parts = []
        for column, is_numeric in [*((c, True) for c in numeric), *((c, False) for c in categorical)]:
            for segment_column, segment_value in views:
                parts.append(
                    f"""SELECT {extra} {segment_column} AS segment_column, {segment_value} AS segment_value,
                      '{column}' AS col, {_bin(column, is_numeric)} AS bin FROM {source}, drift_edges e"""
                )
        keys = ("window_start, " if extra else "") + "segment_column, segment_value, col, bin"
        return f"SELECT {keys}, count(*) AS n FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL"

    w = "window_start, " if window else ""
    wl = "l.window_start, " if window else ""
    return f"""drift_edges AS (SELECT {edges} FROM {base}),
base_bins AS ({counts(base, '')}),
live_bins AS ({counts(live, window + ' AS window_start,' if window else '')}),
live_groups AS (SELECT {w} segment_column, segment_value, col, sum(n) AS p_total FROM live_bins GROUP BY ALL),
base_groups AS (SELECT segment_column, segment_value, col, sum(n) AS q_total FROM base_bins GROUP BY ALL),
all_bins AS (
  SELECT {wl} l.segment_column, l.segment_value, l.col, b.bin FROM live_groups l
    JOIN base_bins b USING (segment_column, segment_value, col)
  UNION SELECT {w} segment_column, segment_value, col, bin FROM live_bins),
shares AS (
  SELECT {('a.window_start, ' if window else '')} a.segment_column, a.segment_value, a.col, a.bin,
    greatest({D(0.0001)}, coalesce(CAST(l.n AS DOUBLE) / g.p_total, 0)) AS p,
    greatest({D(0.0001)}, coalesce(CAST(b.n AS DOUBLE) / q.q_total, 0)) AS q
  FROM all_bins a
  JOIN live_groups g USING ({w} segment_column, segment_value, col)
  LEFT JOIN base_groups q USING (segment_column, segment_value, col)
  LEFT JOIN live_bins l USING ({w} segment_column, segment_value, col, bin)
  LEFT JOIN base_bins b USING (segment_column, segment_value, col, bin)),
drift_out AS (
  SELECT {w} segment_column, segment_value, col AS "column", round(sum((p - q) * ln(p / q)), 6) AS psi,
    round(sum(p * ln(p / q)), 6) AS kl,
    round({D(0.5)} * sum(p * ln(2 * p / (p + q))) + {D(0.5)} * sum(q * ln(2 * q / (p + q))), 6) AS jsd
  FROM shares GROUP BY {w} segment_column, segment_value, col)"""


LONG = """drift_long AS (
  SELECT * EXCLUDE (psi, kl, jsd), 'psi' AS metric, psi AS metric_value FROM drift_out
  UNION ALL SELECT * EXCLUDE (psi, kl, jsd), 'kl', kl FROM drift_out
  UNION ALL SELECT * EXCLUDE (psi, kl, jsd), 'jsd', jsd FROM drift_out)"""
