"""SQL text builders for the DuckDB oracles (independent of the Spark code
paths: plain window functions, quantile_cont, GROUP BY)."""

from __future__ import annotations

SEED = 42


def dbl(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def unpivot(src: str, cols: list[str], ids: list[str] = (), name: str = "feature", value: str = "value") -> str:
    """Long (ids..., feature, value DOUBLE) via UNION ALL (keeps NULLs)."""
    ids_s = "".join(f"{i}, " for i in ids)
    return " UNION ALL ".join(f"SELECT {ids_s}'{c}' AS {name}, {dbl(c)} AS {value} FROM {src}" for c in cols)


def auc(src: str, keys: list[str], score: str = "value", label: str = "y") -> str:
    """Exact tie-averaged AUC per key of a long table (a subquery)."""
    k = ", ".join(keys)
    return f"""(SELECT {k}, sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY {k} ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
  FROM (SELECT {k}, {score} AS v, sum({label}) AS pos, sum(1 - {label}) AS neg FROM {src}
        WHERE {score} IS NOT NULL GROUP BY {k}, {score}))
 GROUP BY {k} HAVING sum(pos) > 0 AND sum(neg) > 0)"""


def folds(src: str, k: int = 5, key: str = "id", label: str = "y", shuffle: bool = True) -> str:
    order = f"md5('{SEED}|' || CAST({key} AS VARCHAR)), {key}" if shuffle else key
    return (f"SELECT *, CAST(((row_number() OVER (PARTITION BY {label} ORDER BY {order}) - 1) % {k}) + 1 AS INTEGER) "
            f"AS fold FROM {src}")


def median_filled_long(src: str, cols: list[str], ids: list[str], group: str | None = None) -> str:
    """Long table with NULL values replaced by the (group's) median."""
    lng = unpivot(src, cols, ids)
    if group is None:
        return (f"SELECT l.* REPLACE (coalesce(l.value, m.med) AS value) FROM ({lng}) l JOIN "
                f"(SELECT feature, quantile_cont(value, 0.5) AS med FROM ({lng}) GROUP BY feature) m "
                f"ON l.feature = m.feature")
    return (f"SELECT l.* REPLACE (coalesce(l.value, m.med) AS value) FROM ({lng}) l JOIN "
            f"(SELECT {group}, feature, quantile_cont(value, 0.5) AS med FROM ({lng}) GROUP BY {group}, feature) m "
            f"ON l.feature = m.feature AND l.{group} = m.{group}")


def corr_pairs(src: str, cols: list[str], upper_only: bool, diagonal: bool) -> str:
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if (upper_only and j < i) or (not diagonal and i == j):
                continue
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            r = (f"covar_pop({dbl(a)}, {dbl(b)}) FILTER (WHERE {both}) / nullif("
                 f"stddev_pop({dbl(a)}) FILTER (WHERE {both}) * stddev_pop({dbl(b)}) FILTER (WHERE {both}), 0)")
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {i} AS pos_a, {j} AS pos_b, "
                         f"greatest(least({r}, 1.0), -1.0) AS corr FROM {src}")
    return " UNION ALL ".join(parts)
