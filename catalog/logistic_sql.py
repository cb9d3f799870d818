"""DuckDB SQL of the logistic workflow: undamped Newton steps and Gauss-Jordan elimination, one CTE each."""

from __future__ import annotations

FEATURES = "n_chars n_words n_lines n_digits n_upper is_toxic".split()
GRID = "0.001 0.01 0.1 0.5 1.0 5.0 10.0 50.0 100.0".split()
STEPS = 12

DOCUMENT_FEATURES = r"""SELECT doc_id, quality, n_chars, len(regexp_extract_all(text, '[ \t\n\x0B\f\r]+')) + 1 AS n_words,
  length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits,
  length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, toxic AS is_toxic FROM documents JOIN labels USING (doc_id)"""


def newton_sql(split: str) -> str:
    """CTEs up to `m`, the metrics per c on the validation rows, and `z`, the scores of all rows; split: rows with features, quality and split."""
    n = len(FEATURES) + 1
    scaled = ", ".join(f"(CAST({f} AS DOUBLE) - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END" for i, f in enumerate(FEATURES))
    parts = [
        f"f AS MATERIALIZED ({split})",
        "s AS MATERIALIZED (SELECT avg(quality) AS share, " + ", ".join(f"avg({f}) AS m{i}, stddev_pop({f}) AS s{i}" for i, f in enumerate(FEATURES)) + " FROM f WHERE split = 'train')",
        f"x AS MATERIALIZED (SELECT doc_id, quality AS y, split, [{scaled}, 1e0] AS v FROM f, s)",
        f"w0 AS MATERIALIZED (SELECT unnest([{', '.join(f'{c}e0' for c in GRID)}]) AS c, [{'0e0, ' * (n - 1)}ln(share / (1 - share))] AS w FROM s)",
    ]
    for k in range(STEPS):
        parts += [
            f"p{k} AS MATERIALIZED (SELECT c, v, y, 1 / (1 + exp(-list_dot_product(v, w))) AS p FROM x, w{k} WHERE split = 'train')",
            f"""e{k}_0 AS MATERIALIZED (
  SELECT g.c, g.i, g.j, g.g + CASE WHEN g.i = {n} THEN 0 WHEN g.j = {n + 1} THEN w.w[g.i] WHEN g.i = g.j THEN 1 ELSE 0 END AS v FROM (
    SELECT c, i, j, c * sum(CASE WHEN j = {n + 1} THEN (p - y) * v[i] ELSE p * (1 - p) * v[i] * v[j] END) AS g
    FROM p{k}, range(1, {n + 1}) a(i), range(1, {n + 2}) b(j) GROUP BY c, i, j
  ) g JOIN w{k} w ON w.c = g.c)""",
        ]
        for r in range(1, n + 1):
            old = f"e{k}_{r - 1}"
            parts.append(
                f"e{k}_{r} AS MATERIALIZED (SELECT a.c, a.i, a.j, CASE WHEN a.i = {r} THEN a.v / p.v ELSE a.v - l.v * t.v / p.v END AS v FROM {old} a "
                f"JOIN {old} p ON p.c = a.c AND p.i = {r} AND p.j = {r} JOIN {old} l ON l.c = a.c AND l.i = a.i AND l.j = {r} JOIN {old} t ON t.c = a.c AND t.i = {r} AND t.j = a.j)"
            )
        parts.append(f"w{k + 1} AS MATERIALIZED (SELECT e.c, list(w.w[e.i] - e.v ORDER BY e.i) AS w FROM e{k}_{n} e JOIN w{k} w ON w.c = e.c WHERE e.j = {n + 1} GROUP BY e.c)")
    parts += [
        f"z AS MATERIALIZED (SELECT doc_id, split, y, c, list_dot_product(v, w) AS z FROM x, w{STEPS})",
        """k AS (SELECT c, y, z, rank() OVER (PARTITION BY c ORDER BY z) + (count(*) OVER (PARTITION BY c, z) - 1) / 2 AS r FROM z WHERE split = 'validation')""",
        """m AS MATERIALIZED (SELECT c, count(*) FILTER ((z > 0) = (y = 1)) / count(*) AS accuracy,
  (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))) AS roc_auc,
  coalesce(count(*) FILTER (z > 0 AND y = 1) / nullif(count(*) FILTER (z > 0), 0), 0) AS precision,
  coalesce(count(*) FILTER (z > 0 AND y = 1) / nullif(sum(y), 0), 0) AS recall,
  coalesce(2 * count(*) FILTER (z > 0 AND y = 1) / nullif(count(*) FILTER (z > 0) + sum(y), 0), 0) AS f1 FROM k GROUP BY c)""",
    ]
    return "WITH " + ",\n".join(parts) + "\n"


def grid_sql(split: str) -> str:
    rounded = ", ".join(f"round({m}, 9) AS {m}" for m in ("accuracy", "roc_auc", "precision", "recall", "f1"))
    return newton_sql(split) + f"SELECT c, {rounded} FROM m"


def predict_sql(split: str) -> str:
    return newton_sql(split) + """SELECT doc_id, y AS quality, CAST(z > 0 AS INTEGER) AS prediction, round(1 / (1 + exp(-z)), 6) AS probability
FROM z WHERE split = 'test' AND c = (SELECT c FROM m ORDER BY roc_auc DESC, c LIMIT 1)"""
