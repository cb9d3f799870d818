"""DuckDB SQL with the same rows and column names as each query."""

from __future__ import annotations

from catalog.logistic_sql import DOCUMENT_FEATURES, grid_sql, predict_sql
from catalog.queries import MATRIX_COLUMNS, SCALED, SIZE_EDGES, SIZE_LABELS, WIDE_COLUMNS
from tableprofile.operators.quality import NOT_READY, READY

ORDERS = "SELECT * REPLACE (CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice) FROM orders"
LINES = "SELECT * REPLACE (nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax) FROM lineitem"
CUSTOMERS = (
    "SELECT * REPLACE (CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal), 'crm' AS c_source FROM customer"
)

ORDERS_COLUMNS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}
LINES_COLUMNS = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
CUSTOMER_COLUMNS = {
    "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
    "c_mktsegment": "string", "c_source": "string",
}
SUPPLIER_COLUMNS = {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"}
DOCUMENTS_COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
NUMBERS = ("bigint", "int", "double")


def numeric(columns: dict[str, str]) -> list[str]:
    return [name for name, dtype in columns.items() if dtype in NUMBERS]


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# --- profile -----------------------------------------------------------------------------


def examples_sql(name: str, dtype: str, n: int = 3) -> str:
    """First n distinct values: by size, or for texts by MD5 draw, with SHA-256 standing in for long ones."""
    order = name
    if dtype not in NUMBERS:
        text = f"CAST({name} AS VARCHAR)"
        order = f"substr(md5(CASE WHEN strlen({text}) > 64 THEN 'sha256:' || sha256({text}) ELSE {text} END), 1, 15)"
    return (
        f"(SELECT coalesce(string_agg(v, '|' ORDER BY r), '') FROM (SELECT CAST({name} AS VARCHAR) AS v, "
        f"row_number() OVER (ORDER BY {order}) AS r FROM (SELECT DISTINCT {name} FROM t WHERE {name} IS NOT NULL)) "
        f"WHERE r <= {n})"
    )


def summary_sql(source: str, columns: dict[str, str], examples: str | None = "{}", digits: int = 6) -> str:
    """`examples` is a pattern around the example list, or None to leave it out."""
    parts = []
    for i, (name, dtype) in enumerate(columns.items()):
        shown = "" if examples is None else examples.format(examples_sql(name, dtype)) + " AS example_values, "
        if dtype in NUMBERS:
            stats = (
                f"CAST(min({name}) AS DOUBLE) AS min, CAST(max({name}) AS DOUBLE) AS max, "
                f"round(avg({name}), {digits}) AS mean, round(stddev_samp({name}), {digits}) AS std"
            )
        else:
            stats = ", ".join(f"CAST(NULL AS DOUBLE) AS {s}" for s in ("min", "max", "mean", "std"))
        parts.append(
            f"SELECT {i} AS ordinal, '{name}' AS name, '{dtype}' AS dtype, count({name}) AS non_null, "
            f"count(*) - count({name}) AS missing, round((count(*) - count({name})) / count(*), {digits}) AS missing_share, "
            f'count(DISTINCT {name}) AS "unique", {shown}{str(dtype in NUMBERS).lower()} AS is_numeric, {stats} FROM t'
        )
    return f"WITH t AS ({source})\n" + union(parts)


def missing_sql(source: str, columns: dict[str, str], where: str = "true", count: bool = True) -> str:
    parts = [
        f"SELECT '{name}' AS \"column\", count(*) - count({name}) AS missing_count, "
        f"round((count(*) - count({name})) / count(*), 9) AS missing_share FROM t"
        for name in columns
    ]
    kept = '"column", missing_count, missing_share' if count else '"column", missing_share'
    return f"WITH t AS ({source}), m AS ({union(parts)}) SELECT {kept} FROM m WHERE {where}"


def first_seen_sql(columns: dict[str, str], source: str, order: str) -> str:
    parts = [
        f"SELECT '{name}' AS \"column\", row_number() OVER (ORDER BY min({order})) AS rank, "
        f"CAST({name} AS VARCHAR) AS value FROM {source} GROUP BY {name}"
        for name in columns
    ]
    return f"SELECT * FROM ({union(parts)}) WHERE rank <= 3"


# --- frequency ---------------------------------------------------------------------------


def top_sql(columns: list[str], source: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count, "
        f"row_number() OVER (ORDER BY count(*) DESC, {c}) AS rank FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in columns
    ]
    return (
        f'WITH ranked AS ({union(parts)}) SELECT "column", rank, value, count, '
        'round(count / sum(count) OVER (PARTITION BY "column"), 9) AS share FROM ranked WHERE rank <= 5'
    )


# --- quality -----------------------------------------------------------------------------


def flags_sql(source: str, columns: dict[str, str], tail: str) -> str:
    """Flags of a table from its column facts; `tail` selects from the one-row table `flags`."""
    parts = [
        f"SELECT {i} AS ordinal, '{n}' AS name, count(*) AS n_rows, {str(d in NUMBERS).lower()} AS is_numeric, "
        f"(count(*) - count({n})) / count(*) AS missing_share, count(DISTINCT {n}) AS u FROM t"
        for i, (n, d) in enumerate(columns.items())
    ]
    return f"""WITH t AS ({source}), facts AS ({union(parts)}),
folded AS (
  SELECT max(n_rows) AS n_rows, count(*) AS n_cols, max(missing_share) AS max_missing_share,
    count(*) FILTER (WHERE u <= 1) AS constants,
    coalesce(string_agg(name, '|' ORDER BY ordinal) FILTER (WHERE u <= 1), '') AS constant_columns_list,
    count(*) FILTER (WHERE NOT is_numeric AND u / n_rows >= 0.9e0) AS crowds,
    coalesce(string_agg(name, '|' ORDER BY ordinal) FILTER (WHERE NOT is_numeric AND u / n_rows >= 0.9e0), '')
      AS high_cardinality_categoricals
  FROM facts),
flags AS (
  SELECT n_rows, n_cols, n_rows < 100 AS too_few_rows, n_cols > 100 AS too_many_columns, max_missing_share,
    max_missing_share > 0.5e0 AS too_many_missing, constants > 0 AS has_constant_columns, constant_columns_list,
    crowds > 0 AS has_high_cardinality_categoricals, high_cardinality_categoricals,
    greatest(0e0, least(1e0, 1e0 - max_missing_share - CASE WHEN n_rows < 100 THEN 2e-1 ELSE 0e0 END
      - CASE WHEN n_cols > 100 THEN 1e-1 ELSE 0e0 END - 1e-1 * constants - 1.5e-1 * crowds)) AS quality_score
  FROM folded)
{tail}"""


VERDICT = f"quality_score >= 7e-1 AS ok_for_model, CASE WHEN quality_score >= 7e-1 THEN '{READY}' ELSE '{NOT_READY}' END AS message"
REPORT_FLAGS = "too_few_rows, too_many_columns, too_many_missing, has_constant_columns, has_high_cardinality_categoricals"

PROFILES = """SELECT l_suppkey, count(*) * 2 - CASE WHEN l_suppkey % 9 = 0 THEN 5000 ELSE 0 END AS n_rows,
  95 + l_suppkey % 12 AS n_cols, avg(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END) * (1 + l_suppkey % 10) AS max_missing_share,
  l_suppkey % 4 AS numeric_cols, l_suppkey % 3 AS categorical_cols FROM lineitem GROUP BY l_suppkey"""
VALID = (
    "coalesce(n_rows >= 0 AND n_cols >= 0 AND numeric_cols >= 0 AND categorical_cols >= 0 "
    "AND max_missing_share BETWEEN 0 AND 1, false)"
)
PROFILE_SCORE = """greatest(0e0, least(1e0, 1e0 - max_missing_share - CASE WHEN n_rows < 1000 THEN 2e-1 ELSE 0e0 END
  - CASE WHEN n_cols > 100 THEN 1e-1 ELSE 0e0 END
  - CASE WHEN numeric_cols = 0 AND categorical_cols > 0 THEN 1e-1 ELSE 0e0 END
  - CASE WHEN categorical_cols = 0 AND numeric_cols > 0 THEN 5e-2 ELSE 0e0 END))"""
PROFILE_FLAGS_SQL = """n_rows < 1000 AS too_few_rows, n_cols > 100 AS too_many_columns,
  max_missing_share > 5e-1 AS too_many_missing, numeric_cols = 0 AS no_numeric_columns,
  categorical_cols = 0 AS no_categorical_columns"""


# --- relations and distributions ---------------------------------------------------------


def corr_expr(x: str, y: str) -> str:
    if x == y:
        return f"CASE WHEN var_pop({x}) > 0 THEN 1e0 END"
    x_there, y_there = f"CASE WHEN {y} IS NOT NULL THEN {x} END", f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    return f"CASE WHEN var_pop({x_there}) > 0 AND var_pop({y_there}) > 0 THEN round(corr({x}, {y}), 9) END"


def correlation_sql(source: str, names: list[str]) -> str:
    pairs = [
        f"SELECT '{x}' AS column_x, '{y}' AS column_y, {corr_expr(x, y)} AS correlation FROM t"
        for x in names for y in names
    ]
    return f"WITH t AS ({source})\n" + union(pairs)


def matrix_sql(source: str, names: list[str]) -> str:
    rows = [
        f"SELECT '{x}' AS \"column\", " + ", ".join(f"{corr_expr(x, y)} AS {y}" for y in names) + " FROM t" for x in names
    ]
    return f"WITH t AS ({source})\n" + union(rows)


def describe_sql(source: str, names: list[str]) -> str:
    parts = [
        f"SELECT '{n}' AS \"column\", count({n}) AS count, round(avg({n}), 4) AS mean, round(stddev_samp({n}), 4) AS std, "
        f"CAST(min({n}) AS DOUBLE) AS min, round(quantile_cont(CAST({n} AS DOUBLE), 0.25), 4) AS q25, "
        f"round(quantile_cont(CAST({n} AS DOUBLE), 0.5), 4) AS q50, round(quantile_cont(CAST({n} AS DOUBLE), 0.75), 4) AS q75, "
        f"CAST(max({n}) AS DOUBLE) AS max FROM t"
        for n in names
    ]
    return f"WITH t AS ({source})\n" + union(parts)


def histogram_sql(source: str, names: list[str], bins: int) -> str:
    parts = []
    for i, name in enumerate(names):
        parts.append(f"""SELECT {i + 1} AS position, '{name}' AS "column", CAST(e.b AS INTEGER) AS bin,
  round(any_value(e.lo), 6) AS bin_low, round(any_value(e.hi), 6) AS bin_high, count(v) AS count
FROM (SELECT b, low + b * ((high - low) / {bins}e0) AS lo,
        CASE WHEN b = {bins - 1} THEN high ELSE low + (b + 1) * ((high - low) / {bins}e0) END AS hi, b = {bins - 1} AS final
      FROM (SELECT CAST(min({name}) AS DOUBLE) AS low, CAST(max({name}) AS DOUBLE) AS high FROM t), range({bins}) r(b)) e
LEFT JOIN (SELECT CAST({name} AS DOUBLE) AS v FROM t WHERE {name} IS NOT NULL) x
  ON v >= e.lo AND (v < e.hi OR (e.final AND v <= e.hi))
GROUP BY e.b""")
    return f"WITH t AS ({source})\n" + union(parts)


def boxplot_sql(source: str, category: str, measure: str, digits: int, round_limits: bool) -> str:
    limits = "round(n_min, {0}) AS min, round(n_max, {0}) AS max" if round_limits else "n_min AS min, n_max AS max"
    return f"""WITH t AS (SELECT {category} AS c, CAST({measure} AS DOUBLE) AS v FROM ({source}) WHERE {measure} IS NOT NULL),
q AS (SELECT c, count(*) AS n, min(v) AS n_min, max(v) AS n_max, quantile_cont(v, 0.25) AS q1,
        quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM t GROUP BY c),
w AS (SELECT c, least(min(v) FILTER (WHERE v >= q1 - 1.5e0 * (q3 - q1)), any_value(q1)) AS whisker_low,
        greatest(max(v) FILTER (WHERE v <= q3 + 1.5e0 * (q3 - q1)), any_value(q3)) AS whisker_high FROM t JOIN q USING (c) GROUP BY c)
SELECT c AS {category}, n, {limits.format(digits)}, round(q1, {digits}) AS q1, round(median, {digits}) AS median,
  round(q3, {digits}) AS q3, round(whisker_low, {digits}) AS whisker_low, round(whisker_high, {digits}) AS whisker_high,
  (SELECT count(*) FROM t WHERE t.c = q.c AND (v < whisker_low OR v > whisker_high)) AS n_outliers
FROM q JOIN w USING (c)"""


def bin_case(value: str) -> str:
    whens = [f"WHEN {value} <= {SIZE_EDGES[0]} THEN NULL"]
    whens += [f"WHEN {value} <= {high} THEN '{label}'" for high, label in zip(SIZE_EDGES[1:], SIZE_LABELS)]
    return "CASE " + " ".join(whens) + " END"


def blocks_sql() -> str:
    names = [n for n in LINES_COLUMNS if n != "l_orderkey"]
    parts = [
        f"SELECT block, '{n}' AS \"column\", count(*) AS n_rows, round(1 - count({n}) / count(*), 9) AS missing_share "
        "FROM t GROUP BY block" for n in names
    ]
    return f"""WITH limits AS (SELECT CAST(min(l_orderkey) AS DOUBLE) AS low, CAST(max(l_orderkey) AS DOUBLE) AS high FROM lineitem),
t AS (SELECT l.*, CAST(least(floor((l_orderkey - low) / ((high - low) / 10e0)), 9) AS INTEGER) AS block FROM ({LINES}) l, limits)
{union(parts)}"""


def matrix_blocks_sql(source: str, names: list[str], order_by: str, blocks: int) -> str:
    pattern = " || ".join(f"CASE WHEN {n} IS NULL THEN '1' ELSE '0' END" for n in names)
    parts = [
        f"SELECT block, min(i) AS first_row, count(*) AS n_rows, '{n}' AS \"column\", round(1 - count({n}) / count(*), 9) AS missing_share "
        "FROM b GROUP BY block" for n in names
    ]
    return f"""WITH t AS (SELECT *, row_number() OVER (ORDER BY {order_by} NULLS LAST, {pattern}) - 1 AS i, count(*) OVER () AS n FROM ({source})),
b AS (SELECT *, CAST(floor(i * {blocks} / n) AS BIGINT) AS block FROM t)
{union(parts)}"""


# --- checks, arrays, models --------------------------------------------------------------


def violations_sql() -> str:
    rules = {
        "low_balance": "c_acctbal < 500",
        "odd_nation": "c_nationkey > 22 OR c_nationkey < 2",
        "empty_household": "c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 1000",
    }
    fired = ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in rules.items())
    return (
        f"SELECT c_custkey, concat_ws('|', {fired}) AS violated_rules FROM ({CUSTOMERS}) "
        f"WHERE coalesce({' OR '.join(f'({r})' for r in rules.values())}, false)"
    )


def range_sql() -> str:
    checks = {
        "l_discount": "l_discount < 0 OR l_discount > 0.05e0", "l_quantity": "l_quantity < 1 OR l_quantity > 50",
        "l_tax": "l_tax < 0.03e0", "l_linenumber": "l_linenumber NOT IN (1, 2, 3, 4)",
    }
    parts = [
        f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
        f"count(*) FILTER (WHERE {rule}) AS n_outside, count(*) FILTER (WHERE {rule}) = 0 AS ok FROM t"
        for c, rule in checks.items()
    ]
    return f"WITH t AS ({LINES})\n" + union(parts)


def report_metrics_sql() -> str:
    facts = [
        ("source", "name", "'customer'"),
        ("shape", "n_rows", "CAST(n_rows AS VARCHAR)"),
        ("shape", "n_cols", "CAST(n_cols AS VARCHAR)"),
        ("parameters", "max_hist_columns", "'6'"),
        ("parameters", "top_k_categories", "'5'"),
        ("parameters", "min_missing_share", "'30.0%'"),
        ("quality", "quality_score", "printf('%.2f', quality_score)"),
        ("quality", "max_missing_share", "printf('%.2f%%', max_missing_share * 100)"),
        *[("quality", f, f"CAST({f} AS VARCHAR)") for f in (
            "too_few_rows", "too_many_columns", "too_many_missing", "has_constant_columns", "has_high_cardinality_categoricals")],
        ("missing", "problem_columns", "(SELECT CAST(count(*) AS VARCHAR) FROM facts WHERE missing_share >= 0.3e0)"),
        ("sections", "missing", "CAST(n_rows > 0 AS VARCHAR)"),
        ("sections", "correlation", "CAST(n_rows > 0 AS VARCHAR)"),
        ("sections", "top_categories", "CAST(n_rows > 0 AS VARCHAR)"),
        ("sections", "histograms", "(SELECT CAST(count(*) AS VARCHAR) FROM facts WHERE is_numeric AND u > 0)"),
    ]
    rows = [f"SELECT {i} AS position, '{s}' AS section, '{m}' AS metric, {v} AS value FROM flags" for i, (s, m, v) in enumerate(facts)]
    return flags_sql(CUSTOMERS, CUSTOMER_COLUMNS, union(rows))


def split_sql(source: str, label: str, key: str) -> str:
    return f"""SELECT * EXCLUDE (n, r), CASE WHEN r <= round(0.2e0 * n) THEN 'test'
  WHEN r <= round(0.2e0 * n) + round(0.25e0 * (n - round(0.2e0 * n))) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT *, count(*) OVER (PARTITION BY {label}) AS n,
        row_number() OVER (PARTITION BY {label} ORDER BY md5('42:' || CAST({key} AS VARCHAR))) AS r FROM ({source}))"""


LABEL_SPLIT = split_sql("SELECT * FROM labels", "quality", "doc_id")
DRAW = "CAST('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0"


def baseline_sql(split: str) -> str:
    return (
        f"SELECT s.*, CASE WHEN {DRAW} < (SELECT avg(quality) FROM ({split}) WHERE split = 'train') "
        f"THEN 1 ELSE 0 END AS baseline_prediction FROM ({split}) s"
    )


DOCUMENT_SCORES = """SELECT l.*, n_chars, n_chars / (n_chars + 1000e0) AS score,
  CASE WHEN n_chars / (n_chars + 1000e0) > 0.5e0 THEN 1 ELSE 0 END AS guess FROM labels l JOIN documents USING (doc_id)"""
LINE_SCORES = """SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned, l_linestatus,
  l_extendedprice * (1 + l_discount) AS score, CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END AS guess FROM lineitem"""


def metrics_sql(y: str, p: str) -> str:
    hits = f"count(*) FILTER (WHERE {y} = 1 AND {p} = 1)"
    predicted, actual = f"count(*) FILTER (WHERE {p} = 1)", f"count(*) FILTER (WHERE {y} = 1)"
    return f"""count(*) AS n, round(count(*) FILTER (WHERE {y} = {p}) / count(*), 9) AS accuracy,
  round(CASE WHEN {predicted} = 0 THEN 0 ELSE {hits} / {predicted} END, 9) AS precision,
  round(CASE WHEN {actual} = 0 THEN 0 ELSE {hits} / {actual} END, 9) AS recall,
  round(CASE WHEN {predicted} + {actual} = 0 THEN 0 ELSE 2 * {hits} / ({predicted} + {actual}) END, 9) AS f1"""


def classification_sql() -> str:
    return f"""WITH t AS ({DOCUMENT_SCORES}),
k AS (SELECT c, count(*) FILTER (WHERE quality = c) AS support, count(*) FILTER (WHERE guess = c) AS predicted,
        count(*) FILTER (WHERE quality = c AND guess = c) AS hits FROM t, (VALUES (0), (1)) v(c) GROUP BY c),
r AS (SELECT c, hits / predicted AS precision, hits / support AS recall, 2 * hits / (support + predicted) AS f1, support, hits FROM k)
SELECT c + 1 AS position, CASE c WHEN 0 THEN 'low' ELSE 'high' END AS name, round(precision, 9) AS precision,
  round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM r
UNION ALL SELECT 3, 'accuracy', NULL, NULL, round(sum(hits) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM r
UNION ALL SELECT 4, 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM r
UNION ALL SELECT 5, 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
  round(sum(f1 * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM r"""


def gain_sql() -> str:
    names = ["accuracy", "precision", "recall", "f1"]
    raw = {p: metrics_sql("quality", p).replace("round(", "(").replace(", 9)", ")") for p in ("guess", "baseline_prediction")}
    parts = [
        f"SELECT '{m}' AS metric, round(a.{m}, 9) AS value, round(b.{m}, 9) AS baseline, "
        f"round((a.{m} - b.{m}) * 100, 9) AS gain_points FROM a, b" for m in names
    ]
    areas = [auc_sql(f"SELECT quality, {p} AS score FROM t", "quality", None).replace("round(", "(").replace(", 9)", ")") for p in ("score", "baseline_prediction")]
    area = (
        "SELECT 'roc_auc' AS metric, round(x.roc_auc, 9) AS value, round(y.roc_auc, 9) AS baseline, "
        f"round((x.roc_auc - y.roc_auc) * 100, 9) AS gain_points FROM ({areas[0]}) x, ({areas[1]}) y"
    )
    return f"""WITH t AS (SELECT * FROM ({baseline_sql(split_sql(DOCUMENT_SCORES, "quality", "doc_id"))}) WHERE split = 'test'),
a AS (SELECT {raw["guess"]} FROM t), b AS (SELECT {raw["baseline_prediction"]} FROM t)
{union([*parts, area])}"""


def auc_sql(source: str, label: str, group: str | None) -> str:
    over = f"PARTITION BY {group} " if group else ""
    keys = f"{group}, " if group else ""
    return f"""WITH g AS (SELECT {keys}score, count(*) FILTER (WHERE {label} = 1) AS p, count(*) FILTER (WHERE {label} = 0) AS n
  FROM ({source}) GROUP BY {keys}score),
r AS (SELECT *, sum(n) OVER ({over}ORDER BY score) - n AS below FROM g)
SELECT {keys}round(CAST(sum(p * (below + 0.5e0 * n)) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * sum(n)), 9) AS roc_auc FROM r
{"GROUP BY " + group if group else ""}"""


CURVE = f"""WITH g AS (SELECT score, count(*) FILTER (WHERE returned = 1) AS p, count(*) FILTER (WHERE returned = 0) AS n
  FROM ({LINE_SCORES}) GROUP BY score),
c AS (SELECT score AS threshold, sum(n) OVER w / sum(n) OVER () AS fpr, sum(p) OVER w / sum(p) OVER () AS tpr
  FROM g WINDOW w AS (ORDER BY score DESC)
  UNION ALL SELECT CAST('Infinity' AS DOUBLE), 0e0, 0e0)"""


def thinned_sql(score: str) -> str:
    return f"""WITH g AS (SELECT CAST({score} AS DOUBLE) AS score, count(*) FILTER (WHERE returned = 1) AS p, count(*) FILTER (WHERE returned = 0) AS n
  FROM ({LINE_SCORES}) GROUP BY 1),
c AS (SELECT score, p, n, lead(p) OVER w AS np, lead(n) OVER w AS nn, row_number() OVER w AS i,
  sum(n) OVER w / sum(n) OVER () AS fpr, sum(p) OVER w / sum(p) OVER () AS tpr FROM g WINDOW w AS (ORDER BY score DESC))
SELECT round(score, 9) AS threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM c WHERE i = 1 OR np IS NULL OR p <> np OR n <> nn
UNION ALL SELECT CAST('Infinity' AS DOUBLE), 0e0, 0e0"""


EMBEDDING_WIDE = "SELECT " + ", ".join(
    f"CASE WHEN vec_id % {i + 2} <> 0 THEN CAST(embedding[{i + 1}] AS DOUBLE) + 5 END AS d{i}" for i in range(WIDE_COLUMNS)
) + " FROM embeddings"

ORACLES: dict[str, str] = {
    "column_summary": summary_sql(ORDERS, ORDERS_COLUMNS),
    "column_summary_texts": summary_sql("SELECT * FROM documents", DOCUMENTS_COLUMNS, "md5({})"),
    "flatten_summary": summary_sql("SELECT * FROM supplier", SUPPLIER_COLUMNS, None),
    "example_values": first_seen_sql(
        {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "props": "string"}, "events", "event_id"
    ),
    "dataset_profile": "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem",
    "schema_table": f"WITH t AS ({ORDERS})\n" + union([
        f"SELECT {i} AS ordinal, '{n}' AS \"column\", '{d}' AS dtype, count({n}) AS non_null FROM t"
        for i, (n, d) in enumerate(ORDERS_COLUMNS.items())
    ]),
    "missing_table": missing_sql(LINES, LINES_COLUMNS),
    "missing_share": missing_sql(LINES, LINES_COLUMNS, count=False),
    "problem_columns": missing_sql(LINES, LINES_COLUMNS, where="missing_share >= 0.05"),
    "value_counts": "SELECT event_type AS value, count(*) AS count FROM events GROUP BY 1",
    "value_counts_numbers": f"SELECT l_tax AS value, count(*) AS count FROM ({LINES}) WHERE l_tax IS NOT NULL GROUP BY 1",
    "value_shares": "SELECT c_mktsegment AS value, count(*) AS count, round(count(*) / sum(count(*)) OVER () * 100, 9) AS share FROM customer GROUP BY 1",
    "top_categories": top_sql(["p_name", "p_brand", "p_type"], "part"),
    "top_categories_heavy": top_sql(["p_name", "p_brand", "p_type"], "part"),
    "value_counts_texts": "SELECT text AS value, count(*) AS count FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "distinct_values_texts": "SELECT DISTINCT text FROM documents",
    "distinct_values": "SELECT DISTINCT p_brand FROM part",
    "distinct_values_first_seen": "SELECT user_id, min(event_id) AS first_event FROM events GROUP BY user_id",
    "merged_summary": f"""SELECT * EXCLUDE ("unique"), "unique" <= 1 AS is_constant FROM ({summary_sql(LINES, LINES_COLUMNS, None)})""",
    "merged_quality_flags": flags_sql(LINES, LINES_COLUMNS, "SELECT * FROM flags"),
    "quality_flags": flags_sql(CUSTOMERS, CUSTOMER_COLUMNS, "SELECT * FROM flags"),
    "quality_flags_from_summary": flags_sql(CUSTOMERS, CUSTOMER_COLUMNS, "SELECT * FROM flags"),
    "quality_verdict": flags_sql(LINES, LINES_COLUMNS, f"SELECT *, {VERDICT} FROM flags"),
    "boolean_flags": flags_sql(CUSTOMERS, CUSTOMER_COLUMNS, union([
        f"SELECT '{f.strip()}' AS flag, {f} AS value FROM flags" for f in REPORT_FLAGS.split(",")
    ])),
    "quality_report": flags_sql(LINES, LINES_COLUMNS, f"SELECT quality_score, {VERDICT}, n_rows, n_cols, {REPORT_FLAGS} FROM flags"),
    "validate_profiles": f"SELECT * REPLACE (round(max_missing_share, 9) AS max_missing_share), {VALID} AS is_valid FROM ({PROFILES})",
    "score_profiles": f"""SELECT * EXCLUDE (quality_score) REPLACE (round(max_missing_share, 9) AS max_missing_share),
  round(quality_score, 9) AS quality_score, {VERDICT}, {PROFILE_FLAGS_SQL}
FROM (SELECT *, {PROFILE_SCORE} AS quality_score FROM ({PROFILES}) WHERE {VALID})""",
    "score_profiles_stream": f"""SELECT c_custkey, round(quality_score, 9) AS quality_score, quality_score >= 7e-1 AS ok_for_model, {PROFILE_FLAGS_SQL}
FROM (SELECT *, {PROFILE_SCORE} AS quality_score FROM (SELECT c_custkey, c_custkey AS n_rows, c_nationkey * 10 AS n_cols,
  c_acctbal / 10000 AS max_missing_share, c_custkey % 3 AS numeric_cols, c_custkey % 2 AS categorical_cols FROM customer) WHERE {VALID})""",
    "latest_verdicts_stream": f"""SELECT 'nation ' || c_nationkey AS table_name, at_second, round(quality_score, 9) AS quality_score, quality_score >= 7e-1 AS ok_for_model
FROM (SELECT *, {PROFILE_SCORE} AS quality_score FROM (SELECT c_nationkey, CAST(c_custkey AS BIGINT) AS at_second, c_custkey AS n_rows, c_nationkey * 10 AS n_cols,
  c_acctbal / 10000 AS max_missing_share, c_custkey % 3 AS numeric_cols, c_custkey % 2 AS categorical_cols FROM customer) WHERE {VALID})
QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY at_second DESC) = 1""",
    "correlation_long": correlation_sql(
        LINES.replace(" FROM lineitem", ", 1e0 AS l_constant FROM lineitem"), numeric(LINES_COLUMNS) + ["l_constant"]
    ),
    "correlation_wide": correlation_sql(EMBEDDING_WIDE, [f"d{i}" for i in range(WIDE_COLUMNS)]),
    "correlation_offset": "SELECT * REPLACE (round(correlation, 6) AS correlation) FROM (" + correlation_sql(
        "SELECT l_quantity + CASE WHEN l_orderkey % 50 = 0 THEN 1e7 ELSE 0e0 END AS moved, CASE WHEN l_orderkey % 50 = 0 THEN l_extendedprice END AS seldom, "
        "l_quantity, l_discount, l_tax, l_linenumber FROM lineitem",
        ["moved", "seldom", "l_quantity", "l_discount", "l_tax", "l_linenumber"],
    ) + ")",
    "correlation_matrix": matrix_sql(LINES, MATRIX_COLUMNS),
    "correlation_heatmap": correlation_sql("SELECT * FROM part", ["p_partkey", "p_size", "p_retailprice"]),
    "scatter_points": f"SELECT o_custkey AS x, o_totalprice AS y, o_orderpriority AS category FROM ({ORDERS}) WHERE o_totalprice IS NOT NULL",
    "describe_numeric": describe_sql(LINES, numeric(LINES_COLUMNS)),
    "histogram_bins": histogram_sql(ORDERS, numeric(ORDERS_COLUMNS), 20),
    "histogram_age_bins": histogram_sql(LINES, ["l_quantity", "l_discount"], 10),
    "boxplot_stats": boxplot_sql(ORDERS, "o_orderpriority", "o_totalprice", 6, False),
    "boxplot_stats_skewed": boxplot_sql(
        "SELECT l_returnflag, l_extendedprice * l_extendedprice * l_quantity / 1e6 AS weight FROM lineitem",
        "l_returnflag", "weight", 4, True,
    ),
    "bin_column_counts": f"SELECT p_partkey, p_size, {bin_case('(p_size - 5)')} AS size_bin FROM part",
    "bin_means": f"""WITH labels(bin) AS (VALUES {", ".join(f"('{x}')" for x in SIZE_LABELS)}),
m AS (SELECT {bin_case("p_size")} AS bin, avg(p_retailprice) AS price, avg(p_size) AS size FROM part GROUP BY 1)
SELECT bin, round(size, 6) AS mean_p_size, round(price, 6) AS mean_p_retailprice FROM labels LEFT JOIN m USING (bin)""",
    "missing_mask": "SELECT o_orderkey, " + ", ".join(
        f"{n} IS NULL AS {n}" for n in ORDERS_COLUMNS if n != "o_orderkey"
    ) + f" FROM ({ORDERS})",
    "missing_patterns": "SELECT concat(" + ", ".join(
        f"CASE WHEN {n} IS NULL THEN '1' ELSE '0' END" for n in LINES_COLUMNS
    ) + f") AS pattern, count(*) AS n_rows FROM ({LINES}) GROUP BY 1",
    "missing_blocks": blocks_sql(),
    "missing_matrix": matrix_blocks_sql(LINES, [n for n in LINES_COLUMNS if n != "l_extendedprice"], "l_extendedprice", 40),
    "missing_matrix_ties": matrix_blocks_sql(
        "SELECT nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax, l_linenumber FROM lineitem", ["l_tax", "l_linenumber"], "l_discount", 17
    ),
    "duplicate_rows": "SELECT text, lang, count(*) AS n_copies FROM documents GROUP BY text, lang HAVING count(*) > 1",
    "duplicate_rows_numbers": f"""SELECT l_linenumber, l_quantity, l_discount, l_tax, count(*) AS n_copies FROM ({LINES})
GROUP BY ALL HAVING count(*) > 1""",
    "has_duplicates": "SELECT count(*) > count(DISTINCT (text, lang)) AS has_duplicates FROM documents",
    "rule_violations": violations_sql(),
    "range_check": range_sql(),
    "group_stats": f"""SELECT o_orderpriority, CAST(sum(o_custkey) AS BIGINT) AS sum_o_custkey, round(avg(o_custkey), 2) AS mean_o_custkey,
  round(sum(o_totalprice), 2) AS sum_o_totalprice, round(avg(o_totalprice), 2) AS mean_o_totalprice FROM ({ORDERS}) GROUP BY 1""",
    "category_rows": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'",
    "head_rows": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
    "csv_round_trip": f"""SELECT * REPLACE (CAST(c_custkey AS INTEGER) AS c_custkey, nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment)
FROM ({CUSTOMERS})""",
    "first_seen_in_files": """WITH f AS (
  SELECT 'c_custkey' AS "column", CAST(c_custkey AS VARCHAR) AS value, min(c_custkey) AS seen FROM customer GROUP BY 2
  UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), min(c_custkey) FROM customer GROUP BY 2
  UNION ALL SELECT 'c_mktsegment', c_mktsegment, min(c_custkey) FROM customer GROUP BY 2
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY seen) AS INTEGER) AS rank FROM f)
SELECT "column", rank, value FROM r WHERE rank <= 3
UNION ALL SELECT 'all segments', rank, value FROM r WHERE "column" = 'c_mktsegment'""",
    "report_metrics_facts": report_metrics_sql(),
    "missing_from_summary_rows": missing_sql(LINES, LINES_COLUMNS),
    "report_summary_file": f"""SELECT * EXCLUDE (ordinal) REPLACE (round(min, 6) AS min, round(max, 6) AS max)
FROM ({summary_sql(CUSTOMERS, CUSTOMER_COLUMNS, None)})""",
    "report_missing_file": missing_sql(LINES, LINES_COLUMNS),
    "report_correlation_file": matrix_sql(LINES, MATRIX_COLUMNS),
    "report_top_files": top_sql(["p_name", "p_brand", "p_type"], "part"),
    "array_features": """SELECT vec_id, '0.0,0.0,0.0,0.0,0.0,0.0' AS zeros, '1.0,1.0,1.0,1.0,1.0,1.0' AS ones, '0,1,2,3,4,5' AS numbers,
  CAST(embedding[3] AS DOUBLE) AS third, CAST(embedding[12] AS DOUBLE) AS second_row_fourth,
  round(CAST(embedding[4] AS DOUBLE) + CAST(embedding[5] AS DOUBLE) + CAST(embedding[6] AS DOUBLE), 9) AS slice_sum FROM embeddings""",
    "array_reshape": """SELECT vec_id, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS "column",
  CAST(embedding[r * 16 + c + 1] AS DOUBLE) AS item FROM embeddings, range(4) t(r), range(16) u(c)""",
    "array_shape": "SELECT vec_id, 4 AS rows, len(embedding) // 4 AS columns, lower(typeof(embedding[1])) AS item_type FROM embeddings",
    "array_elementwise": """SELECT vec_id, CAST(i AS INTEGER) AS position,
  round(CAST(embedding[i + 1] AS DOUBLE) + CAST(embedding[64 - i] AS DOUBLE), 9) AS total,
  round(CAST(embedding[i + 1] AS DOUBLE) * CAST(embedding[64 - i] AS DOUBLE), 9) AS product FROM embeddings, range(64) t(i)""",
    "array_stats": """SELECT vec_id, round(avg(x), 9) AS mean, round(stddev_pop(x), 9) AS std
FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY vec_id""",
    "stratified_split": LABEL_SPLIT,
    "stratified_split_orders": split_sql("SELECT o_orderkey, o_orderpriority FROM orders", "o_orderpriority", "o_orderkey"),
    "split_balance": f"""SELECT split, quality AS label, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 9) AS share
FROM ({LABEL_SPLIT}) GROUP BY split, quality""",
    "prior_baseline": f"SELECT doc_id, split, baseline_prediction FROM ({baseline_sql(LABEL_SPLIT)})",
    "binary_metrics": f"SELECT {metrics_sql('quality', 'guess')} FROM ({DOCUMENT_SCORES})",
    "binary_metrics_grouped": f"SELECT l_linestatus, {metrics_sql('returned', 'guess')} FROM ({LINE_SCORES}) GROUP BY 1",
    "confusion_counts": f"SELECT returned AS label, guess AS prediction, count(*) AS n FROM ({LINE_SCORES}) GROUP BY 1, 2",
    "classification_report": classification_sql(),
    "metric_gain": gain_sql(),
    "roc_auc": auc_sql(DOCUMENT_SCORES, "quality", None),
    "roc_auc_grouped": auc_sql(LINE_SCORES, "returned", "l_linestatus"),
    "best_model": "SELECT * FROM (" + auc_sql(
        "SELECT l_linenumber AS c, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned, l_extendedprice AS score FROM lineitem",
        "returned", "c",
    ) + ") ORDER BY roc_auc DESC, c LIMIT 1",
    "roc_curve": f"{CURVE} SELECT round(threshold, 9) AS threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM c",
    "roc_curve_thinned": thinned_sql("score"),
    "roc_curve_guess": thinned_sql("guess"),
    "trapezoid_auc": f"""{CURVE} SELECT round(sum((fpr - x) * (tpr + y) / 2), 9) AS auc
FROM (SELECT fpr, tpr, lag(fpr) OVER w AS x, lag(tpr) OVER w AS y FROM c WINDOW w AS (ORDER BY fpr, tpr))""",
    "feature_table": "SELECT l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem",
    "fit_scaler": union([
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM lineitem" for c in SCALED
    ]),
    "apply_scaler": "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in SCALED
    ) + " FROM lineitem",
}

ORACLES |= {
    "top_categories_texts": top_sql(["text", "lang", "source"], "documents"),
    "rejected_profiles": f"SELECT * FROM ({ORACLES['validate_profiles']}) WHERE NOT is_valid",
    "report_histogram_file": ORACLES["histogram_bins"],
    "report_patterns_file": ORACLES["missing_patterns"],
    "csv_quality_report": ORACLES["quality_report"],
    "logistic_grid": grid_sql(split_sql(DOCUMENT_FEATURES, "quality", "doc_id")),
    "logistic_predict": predict_sql(split_sql(DOCUMENT_FEATURES, "quality", "doc_id")),
}
