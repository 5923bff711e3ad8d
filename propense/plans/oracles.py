"""The registered queries as plain SQL over the same tables, written for DuckDB."""

from __future__ import annotations

from propense.plans import checks

PRODUCTS = {"o": "O", "f": "F", "p": "P"}
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _columns(template: str, items) -> str:
    return ",\n  ".join(template.format(x, **{"x": x}) for x in items)


def _product_columns(template: str) -> str:
    return ",\n  ".join(template.format(p=p, s=s) for p, s in PRODUCTS.items())


PROFILE = """
SELECT c_custkey AS client, c_mktsegment AS segment, c_acctbal AS acctbal, c_nationkey AS nation
FROM customer"""

BALANCES = f"""
SELECT o_custkey AS client,
  {_product_columns('''nullif(count(*) FILTER (o_orderstatus = '{s}'), 0) AS count_{p},
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) FILTER (o_orderstatus = '{s}') AS DOUBLE) AS bal_{p}''')}
FROM orders GROUP BY o_custkey"""

FLOWS = f"""
SELECT user_id AS client,
  {_columns('''coalesce(CAST(sum(CAST(value AS DECIMAL(12,2))) FILTER (event_type = '{x}') AS DOUBLE), 0) AS volume_{x},
  count(*) FILTER (event_type = '{x}') AS txn_{x}''', EVENT_TYPES)}
FROM events GROUP BY user_id"""

CAMPAIGN = """
SELECT c_custkey AS client FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('AFRICA', 'AMERICA', 'ASIA')"""

SALES = f"""
SELECT client,
  {_product_columns('''CAST(coalesce(n_{p} >= 4, false) AS INTEGER) AS sale_{p},
  CASE WHEN n_{p} >= 4 THEN coalesce(r_{p}, 0) ELSE 0 END AS revenue_{p}''')}
FROM ({CAMPAIGN}) c LEFT JOIN (
  SELECT o_custkey AS client,
  {_product_columns('''count(*) FILTER (o_orderstatus = '{s}') AS n_{p},
  CAST(sum(order_revenue) FILTER (o_orderstatus = '{s}') AS DOUBLE) AS r_{p}''')}
  FROM orders LEFT JOIN (
    SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(6,2))) AS order_revenue
    FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey
  GROUP BY o_custkey) n USING (client)"""

TRAIN = """
SELECT * FROM sales LEFT JOIN flows USING (client) LEFT JOIN balances USING (client)
LEFT JOIN profile USING (client)"""

HOLDOUT = """
SELECT p.*, b.* EXCLUDE (client), f.* EXCLUDE (client) FROM profile p
JOIN balances b ON p.client = b.client JOIN flows f ON p.client = f.client
LEFT JOIN sales s ON p.client = s.client WHERE s.client IS NULL"""

SCORES = f"""
SELECT client,
  {_product_columns('''coalesce(bal_{p} / total, 0) AS {p}_predicted_probability,
  coalesce(bal_{p} / count_{p}, 0) / 1000.0::DOUBLE AS {p}_predicted_revenue''')}
FROM (SELECT *, nullif(0.0::DOUBLE + coalesce(bal_o, 0) + coalesce(bal_f, 0) + coalesce(bal_p, 0), 0) AS total
      FROM balances)"""

COMBINED = f"""
SELECT client,
  {_product_columns('''{p}_predicted_probability, {p}_predicted_revenue,
  CASE WHEN {p}_predicted_probability < 0.71::DOUBLE THEN 0
       ELSE {p}_predicted_probability * {p}_predicted_revenue END AS {p}_expected_revenue''')}
FROM scores"""

OUTCOME = """
SELECT client, max_expected_revenue,
  CASE WHEN max_expected_revenue = o_expected_revenue THEN 'O'
       WHEN max_expected_revenue = f_expected_revenue THEN 'F' ELSE 'P' END AS best_product_type
FROM (SELECT *, greatest(o_expected_revenue, f_expected_revenue, p_expected_revenue) AS max_expected_revenue
      FROM combined)"""

ROLES = {
    "profile": PROFILE,
    "balances": BALANCES,
    "flows": FLOWS,
    "sales": SALES,
    "train": TRAIN,
    "holdout": HOLDOUT,
    "scores": SCORES,
    "combined": COMBINED,
    "outcome": OUTCOME,
}
NEEDS = {
    "train": ("sales", "flows", "balances", "profile"),
    "holdout": ("profile", "balances", "flows", "sales"),
    "scores": ("balances",),
    "combined": ("scores",),
    "outcome": ("combined",),
}


def with_roles(body: str, *roles: str, extra: str = "") -> str:
    """``body`` with the role tables it names, and theirs, as common table expressions."""
    order: list[str] = []

    def visit(role: str) -> None:
        for need in NEEDS.get(role, ()):
            visit(need)
        if role not in order:
            order.append(role)

    for role in roles:
        visit(role)
    parts = [f"{r} AS MATERIALIZED ({ROLES[r]})" for r in order]
    if extra:
        parts.append(extra)
    return f"WITH {', '.join(parts)} {body}" if parts else body


def decision() -> dict[str, str]:
    sweep = """
SELECT threshold, count(*) AS customers, count(*) FILTER (best > 0) AS positive_offers,
  round(sum(best), 2) AS total_expected_revenue,
  count(*) FILTER (best = vo) AS best_o,
  count(*) FILTER (best <> vo AND best = vf) AS best_f,
  count(*) FILTER (best <> vo AND best <> vf) AS best_p
FROM (SELECT *, greatest(vo, vf, vp) AS best FROM (
  SELECT threshold,
    CASE WHEN o_predicted_probability < threshold THEN 0 ELSE o_predicted_probability * o_predicted_revenue END AS vo,
    CASE WHEN f_predicted_probability < threshold THEN 0 ELSE f_predicted_probability * f_predicted_revenue END AS vf,
    CASE WHEN p_predicted_probability < threshold THEN 0 ELSE p_predicted_probability * p_predicted_revenue END AS vp
  FROM scores, (SELECT unnest([0.5, 0.6, 0.71, 0.8, 0.9]::DOUBLE[]) AS threshold)))
GROUP BY threshold"""
    top = "SELECT * FROM outcome WHERE max_expected_revenue > 0 ORDER BY max_expected_revenue DESC, client LIMIT 100"
    return {
        "combine_scores": with_roles("SELECT * FROM scores", "scores"),
        "combine_partial_scores": with_roles(
            "SELECT * FROM scores WHERE client % 7 NOT IN (0, 1, 2) AND client % 11 NOT IN (0, 1, 2)", "scores"
        ),
        "decide_expected_revenue": with_roles("SELECT * FROM combined", "combined"),
        "best_product": with_roles("SELECT * FROM outcome", "outcome"),
        "best_offers": with_roles(top, "outcome"),
        "positive_offers": with_roles("SELECT * FROM outcome WHERE max_expected_revenue > 0", "outcome"),
        "top_offer_details": with_roles(
            f"SELECT * FROM combined WHERE client IN (SELECT client FROM ({top}))", "outcome"
        ),
        "product_mix": with_roles(
            "SELECT best_product_type, count(*) AS count, "
            "round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS percentage "
            "FROM outcome GROUP BY best_product_type",
            "outcome",
        ),
        "outcome_totals": with_roles(
            "SELECT round(avg(max_expected_revenue), 2) AS avg_expected_revenue, "
            "round(min(max_expected_revenue), 2) AS min_expected_revenue, "
            "round(max(max_expected_revenue), 2) AS max_expected_revenue, "
            "round(sum(max_expected_revenue), 2) AS total_expected_revenue FROM outcome",
            "outcome",
        ),
        "threshold_sweep": with_roles(sweep, "scores"),
    }


def silver() -> dict[str, str]:
    return {
        "silver_train": with_roles("SELECT * FROM train", "train"),
        "silver_holdout": with_roles("SELECT * FROM holdout", "holdout"),
        "silver_sales": with_roles("SELECT * FROM sales", "sales"),
        "buyers_only": with_roles(
            "SELECT * FROM sales WHERE revenue_o <> 0 AND revenue_o IS NOT NULL", "sales"
        ),
        "available_predictors": with_roles("SELECT client, acctbal, bal_o FROM holdout", "holdout"),
    }


def _fails(f: str, rule) -> str:
    """Condition of a failing row: the other way round from the rules themselves."""
    arg = rule.argument
    if rule.kind == "enum":
        return f"{f} NOT IN ({', '.join(repr(v) for v in arg)})"
    if rule.kind == "type":
        casts = {"numerical": ["DOUBLE"], "datetime": ["DATE", "TIMESTAMP"], "string": ["VARCHAR"]}[arg]
        return " AND ".join([f"{f} IS NOT NULL", *[f"TRY_CAST({f} AS {c}) IS NULL" for c in casts]])
    return {
        "positive": f"{f} < 0",
        "non_null": f"{f} IS NULL",
        "sync_null": f"({f} IS NULL) <> ({arg} IS NULL)",
        "sync_zero": f"({f} = 0) <> ({arg} = 0)",
        "non_zero": f"{f} = 0",
    }[rule.kind]


def quality_results(specs) -> str:
    parts = []
    for spec in specs:
        for rule in spec.rules:
            if rule.kind == "unique":
                failed = (
                    f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {spec.table} "
                    f"GROUP BY {spec.field}) WHERE n > 1)"
                )
            else:
                failed = f"count(*) FILTER ({_fails(spec.field, rule)})"
            failed = f"CAST({failed} AS BIGINT)"
            named = rule.kind in ("type", "sync_null", "sync_zero")
            suffix = f"{rule.kind}_{rule.argument}" if named else rule.kind
            parts.append(
                f"SELECT '{spec.database}' AS database_name, '{spec.layer}' AS schema_name, "
                f"'{spec.table}' AS table_name, '{spec.field}' AS data_field_name, "
                f"count(*) AS total_records, '{rule.kind}' AS check_type, "
                f"count(*) - {failed} AS records_passed, {failed} AS records_failed, "
                f"'{spec.name}_{suffix}' AS check_name FROM {spec.table}"
            )
    return " UNION ALL ".join(parts)


def quality() -> dict[str, str]:
    roles = [s for s in checks.role_specs()]
    used = sorted({s.table for s in roles})
    everything = quality_results(roles + checks.raw_specs())
    sql = {
        "dq_all": with_roles(everything, *used),
        "dq_isolated": with_roles(everything, *used),
        "dq_summary": with_roles(
            "SELECT check_type, count(*) AS total_checks, "
            "CAST(sum(records_failed) AS BIGINT) AS total_failures, "
            "CAST(sum(total_records) AS BIGINT) AS total_records_checked "
            f"FROM ({everything}) GROUP BY check_type",
            *used,
        ),
    }
    orders = [s for s in checks.raw_specs() if s.table == "orders"]
    broken = ", ".join(f"('broken_{s.field}')" for s in orders[:2])
    sql["dq_failing_at_run_time"] = (
        f"SELECT check_name, total_records, records_passed, records_failed FROM ({quality_results(orders)}) "
        f"UNION ALL SELECT name, NULL, NULL, NULL FROM (VALUES {broken}) AS t(name)"
    )
    for name, specs in checks.by_rule().items():
        tables = sorted({s.table for s in specs if s.layer == "roles"})
        sql[name] = with_roles(quality_results(specs), *tables)
    return sql


TRAIN_NUMBERS = (
    ["client"]
    + [f"{c}_{p}" for p in PRODUCTS for c in ("sale", "revenue")]
    + [f"{c}_{e}" for e in EVENT_TYPES for c in ("volume", "txn")]
    + [f"{c}_{p}" for p in PRODUCTS for c in ("count", "bal")]
    + ["acctbal", "nation"]
)
LINEITEM_NUMBERS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax".split()
)


def _statistics(column: str, end: str) -> str:
    c = f'CAST("{column}" AS DOUBLE)' if not end else f'nullif(CAST("{column}" AS DOUBLE), 0)'
    def r(x):
        return f"round(CAST({x} AS DOUBLE) + 1e-8, 6)"

    return f"""{r(f'min({c})')} AS min_value{end}, {r(f'max({c})')} AS max_value{end},
  {r(f'max({c}) - min({c})')} AS min_max_range{end}, {r(f'median({c})')} AS median_value{end},
  {r(f'avg({c})')} AS mean_value{end},
  {r(f'mode() WITHIN GROUP (ORDER BY {c})')} AS mode{end},
  {r(f'quantile_cont({c}, 0.25)')} AS "25_percentile_value{end}",
  {r(f'quantile_cont({c}, 0.75)')} AS "75_percentile_value{end}",
  {r(f'quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)')} AS iqr{end},
  {r(f'skewness({c})')} AS skewness{end}, {r(f'kurtosis({c})')} AS kurtosis{end}"""


def _numeric_profile(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS data_field_name, {_statistics(c, '')}, {_statistics(c, '_non_zero')}, "
        f'count(*) FILTER ("{c}" <> 0) AS count_non_zero FROM {table}'
        for c in columns
    )


def _frequencies(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS data_field_name, CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {table} GROUP BY {c}"
        for c in columns
    )


def _categorical_profile(table: str, columns) -> str:
    def pct(x, y):
        return f"coalesce(round({x} * 100.0::DOUBLE / {y}, 2), 0)"

    return f"""
SELECT data_field_name, total_records, non_null_records, null_records,
  {pct('null_records', 'total_records')} AS null_percentage, unique_values_count,
  most_frequent_category, most_frequent_count,
  {pct('most_frequent_count', 'non_null_records')} AS most_frequent_percentage,
  least_frequent_category, least_frequent_count,
  {pct('least_frequent_count', 'non_null_records')} AS least_frequent_percentage,
  most_frequent_count / least_frequent_count AS balance_ratio,
  most_frequent_count / least_frequent_count < 2 AS is_balanced
FROM (
  SELECT data_field_name, CAST(sum(n) AS BIGINT) AS total_records,
    CAST(sum(n) FILTER (v IS NOT NULL) AS BIGINT) AS non_null_records,
    CAST(coalesce(sum(n) FILTER (v IS NULL), 0) AS BIGINT) AS null_records,
    count(v) AS unique_values_count,
    first(v ORDER BY n DESC, v) FILTER (v IS NOT NULL) AS most_frequent_category,
    max(n) FILTER (v IS NOT NULL) AS most_frequent_count,
    last(v ORDER BY n DESC, v) FILTER (v IS NOT NULL) AS least_frequent_category,
    min(n) FILTER (v IS NOT NULL) AS least_frequent_count
  FROM ({_frequencies(table, columns)}) GROUP BY data_field_name)"""


def _distribution(table: str, columns) -> str:
    return f"""
SELECT data_field_name, v AS category_value, n AS count,
  round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY data_field_name), 2) AS percentage
FROM ({_frequencies(table, columns)}) WHERE v IS NOT NULL"""


def _value_counts(table: str, column: str) -> str:
    return (
        f"SELECT {column} AS category_value, count(*) AS count, "
        f"round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS percentage "
        f"FROM {table} GROUP BY {column}"
    )


def profiling() -> dict[str, str]:
    categories = ["segment", "nation", "sale_o", "sale_f", "sale_p"]
    baseline = " UNION ALL ".join(
        f"""SELECT 'revenue_{p}' AS data_field_name, count(*) AS rows, round(any_value(m) + 1e-8, 6) AS mean_value,
  round(avg(abs(revenue_{p} - m)) + 1e-8, 6) AS mae
FROM sales, (SELECT avg(revenue_{p}) AS m FROM sales WHERE revenue_{p} <> 0) WHERE revenue_{p} <> 0"""
        for p in PRODUCTS
    )
    integers = ["client", "nation"] + [f"{c}_{p}" for p in PRODUCTS for c in ("sale", "count")]
    integers += [f"txn_{e}" for e in EVENT_TYPES]
    distinct = " UNION ALL ".join(
        f"SELECT '{c}' AS data_field_name, count(DISTINCT {c}) AS n FROM train" for c in integers
    )
    return {
        "category_columns": with_roles(
            f"SELECT data_field_name FROM ({distinct}) WHERE n <= 20 UNION ALL SELECT 'segment'", "train"
        ),
        "profile_numeric": with_roles(_numeric_profile("train", TRAIN_NUMBERS), "train"),
        "profile_numeric_lineitem": _numeric_profile("lineitem", LINEITEM_NUMBERS),
        "profile_categorical": with_roles(_categorical_profile("train", categories), "train"),
        "profile_categorical_orders": _categorical_profile("orders", ["o_orderstatus", "o_orderpriority"]),
        "profile_distributions": with_roles(_distribution("train", categories), "train"),
        "profile_distributions_customers": _distribution("orders", ["o_custkey"]),
        "category_distribution": with_roles(_distribution("train", categories), "train"),
        "category_distribution_events": _distribution("events", ["event_type", "props"]),
        "value_counts": _value_counts("orders", "o_orderpriority"),
        "value_counts_customers": _value_counts("orders", "o_custkey"),
        "mean_baseline_mae": with_roles(baseline, "sales"),
    }


PREDICTORS = ["acctbal", "volume_click", "txn_click", "volume_view", "txn_view", "bal_f", "count_p"]


def _r(x: str, digits: int = 6) -> str:
    return f"round({x} + 1e-8, {digits})"


def features() -> dict[str, str]:
    filled = "coalesce(segment, 'Unknown') AS segment, " + ", ".join(
        f"coalesce({c}, 0) AS {c}" for c in PREDICTORS
    )
    scaled = ", ".join(
        _r(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()") + f" AS {c}" for c in PREDICTORS
    )
    folds = " UNION ALL ".join(
        f"""SELECT CAST({k} AS INTEGER) AS k, sale_o, CAST(f AS INTEGER) AS fold, (n - f + {k} - 1) // {k} AS rows
FROM (SELECT sale_o, count(*) AS n FROM sales GROUP BY sale_o), (SELECT unnest(range({k})) AS f)"""
        for k in (3, 4, 5)
    )
    sizes = "(SELECT sale_f, count(*) AS n FROM sales GROUP BY sale_f)"

    def top2(table: str, key: str, target: str) -> str:
        return f"""SELECT {key}, {target}, CAST({target} = (SELECT max(v) FROM top) AS INTEGER)::DOUBLE AS label
FROM {table} WHERE {target} IN (SELECT v FROM top)"""

    def with_top(table: str, target: str) -> str:
        return (
            f"top AS (SELECT {target} AS v FROM {table} GROUP BY {target} "
            f"ORDER BY count(*) DESC, {target} LIMIT 2)"
        )

    def hot(categories) -> str:
        return ", ".join(f"CAST(segment = '{c}' AS INTEGER)::DOUBLE AS segment_{c}" for c in categories)

    return {
        "fill_missing": with_roles(f"SELECT * REPLACE ({filled}) FROM train", "train"),
        "drop_missing_target": with_roles("SELECT * FROM train WHERE count_o IS NOT NULL", "train"),
        "class_weight": with_roles(
            "SELECT count(*) FILTER (sale_o = 0) AS negatives, count(*) FILTER (sale_o = 1) AS positives, "
            "count(*) FILTER (sale_o = 0) / count(*) FILTER (sale_o = 1) AS class_weight FROM sales",
            "sales",
        ),
        "row_weights": with_roles(
            "SELECT client, sale_o, CASE WHEN sale_o = 1 THEN 2.5::DOUBLE ELSE 1 END AS weight FROM sales",
            "sales",
        ),
        "standardize": with_roles(
            f"SELECT client, segment, {scaled} FROM (SELECT client, {filled} FROM train)", "train"
        ),
        "one_hot_drop_first": with_roles(
            f"SELECT client, segment, {hot(['BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])} FROM train",
            "train",
        ),
        "one_hot_unseen": with_roles(
            f"SELECT client, segment, {hot(['BUILDING', 'FURNITURE'])} FROM profile", "profile"
        ),
        "top2_binary_target": with_roles(
            top2("orders", "o_orderkey", "o_orderpriority"), extra=with_top("orders", "o_orderpriority")
        ),
        "top2_languages": with_roles(
            top2("documents", "doc_id", "lang"), extra=with_top("documents", "lang")
        ),
        "numeric_target": "SELECT l_orderkey, l_linenumber, l_quantity AS quantity FROM lineitem "
        "WHERE l_returnflag <> 'R'",
        "target_scale_roundtrip": with_roles(
            f"SELECT client, {_r('revenue_o')} AS revenue_o, "
            f"{_r('(revenue_o - avg(revenue_o) OVER ()) / stddev_pop(revenue_o) OVER ()')} AS scaled, "
            f"{_r('revenue_o')} AS restored FROM sales WHERE revenue_o <> 0",
            "sales",
        ),
        "kfold_sizes": with_roles(folds, "sales"),
        "hash_folds": "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS outside, CAST(5 AS BIGINT) AS folds FROM orders",
        "split_sizes": with_roles(
            "SELECT 'test' AS side, sale_f, CAST(ceil(n * 0.2::DOUBLE) AS BIGINT) AS rows FROM "
            f"{sizes} UNION ALL SELECT 'train', sale_f, n - CAST(ceil(n * 0.2::DOUBLE) AS BIGINT) FROM {sizes}",
            "sales",
        ),
    }


def metrics() -> dict[str, str]:
    scored = "scored AS MATERIALIZED (" + " UNION ALL ".join(
        f"""SELECT client, '{p.upper()}' AS product, sale_{p} AS label, {p}_predicted_probability AS probability,
  revenue_{p} AS revenue, {p}_predicted_revenue * 200 AS predicted FROM sales JOIN scores USING (client)"""
        for p in PRODUCTS
    ) + ")"
    auc = """
SELECT product, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc_score FROM (
  SELECT *, sum(neg) OVER (PARTITION BY product ORDER BY probability) - neg AS below FROM (
    SELECT product, probability, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
    FROM scored GROUP BY product, probability)) GROUP BY product"""
    matrix = """
SELECT product, count(*) FILTER (label = 1 AND probability > 0.4) AS tp,
  count(*) FILTER (label = 0 AND probability <= 0.4) AS tn,
  count(*) FILTER (label = 0 AND probability > 0.4) AS fp,
  count(*) FILTER (label = 1 AND probability <= 0.4) AS fn FROM scored GROUP BY product"""

    def build(body: str) -> str:
        return with_roles(body, "sales", "scores", extra=scored)

    best = f"SELECT product, {_r('auc_score')} AS auc_score FROM ({auc}) ORDER BY auc_score DESC, product LIMIT 1"
    return {
        "best_run": build(best),
        "classification_metrics": build(
            f"""SELECT product, tp AS true_positives, tn AS true_negatives, fp AS false_positives,
  fn AS false_negatives, {_r('(tp + tn) / (tp + tn + fp + fn)')} AS accuracy,
  {_r('tp / (tp + fp)')} AS precision, {_r('tp / (tp + fn)')} AS recall,
  {_r('2 * tp / (2 * tp + fp + fn)')} AS f1_score, tp + fn AS positive_class_count,
  tn + fp AS negative_class_count, {_r('auc_score')} AS auc_score
FROM ({matrix}) JOIN ({auc}) USING (product)"""
        ),
        "roc_auc_products": build(f"SELECT product, {_r('auc_score')} AS auc_score FROM ({auc})"),
        "roc_auc": build(f"SELECT {_r('auc_score')} AS auc_score FROM ({auc}) WHERE product = 'O'"),
        "regression_metrics": build(
            f"""SELECT product, samples, {_r('mae', 3)} AS mae, {_r('mse', 3)} AS mse, {_r('sqrt(mse)', 3)} AS rmse,
  {_r('1 - mse / v', 3)} AS r2_score, {_r('mae / mean_actual * 100', 3)} AS mae_percentage,
  {_r('mean_actual', 3)} AS mean_actual, {_r('std_actual', 3)} AS std_actual
FROM (SELECT product, count(*) AS samples, avg(abs(revenue - predicted)) AS mae,
  avg((revenue - predicted) * (revenue - predicted)) AS mse, avg(revenue) AS mean_actual,
  stddev_samp(revenue) AS std_actual, var_pop(revenue) AS v
  FROM scored WHERE revenue <> 0 GROUP BY product)"""
        ),
        "score_distribution": build(
            f"""SELECT product, count(*) AS scores, {_r('min(probability)')} AS min_score,
  {_r('max(probability)')} AS max_score, {_r('avg(probability)')} AS mean_score,
  {_r('stddev_samp(probability)')} AS std_score, count(*) FILTER (probability > 0.4) AS class_1,
  count(*) FILTER (probability <= 0.4) AS class_0 FROM scored GROUP BY product"""
        ),
    }


EXACT_TREES, EXACT_RATE = 50, 0.1


def _exact_classes(predictor: str) -> str:
    """CTEs for the classifiers of one predictor: what their trees add up to, step by step, is a recursion over the
    weights of the two classes within each value of the predictor. The weights even the classes out."""
    rows = " UNION ALL ".join(f"SELECT '{p}' AS product, {predictor} AS v, sale_{p} AS y FROM train" for p in PRODUCTS)
    return f"""labelled AS ({rows}),
even AS (SELECT product, coalesce(count(*) FILTER (y <> 1)::DOUBLE / nullif(count(*) FILTER (y = 1), 0), 1) AS w FROM labelled GROUP BY product),
cells AS (SELECT product, v, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y <> 1) AS neg FROM labelled GROUP BY ALL),
steps AS (
    SELECT 1 AS t, product, v, pos, neg, pos * w AS a, neg::DOUBLE AS b, (pos * w - neg) / (pos * w + neg) AS m FROM cells JOIN even USING (product)
    UNION ALL
    SELECT t + 1, product, v, pos, neg, a, b, m + {EXACT_RATE} * (a * 4 / (1 + exp(2 * m)) - b * 4 / (1 + exp(-2 * m))) / (a + b)
    FROM steps WHERE t < {EXACT_TREES}
),
fitted AS (SELECT *, 1 / (1 + exp(-2 * m)) AS p FROM steps WHERE t = {EXACT_TREES})"""


def _recursive(extra: str, body: str, *roles: str) -> str:
    return with_roles(body, *roles, extra=extra).replace("WITH ", "WITH RECURSIVE ", 1)


def _exact_revenue() -> tuple[str, str]:
    """Regressors of the absolute error: each tree adds the mean sign of what is left, within each segment."""
    rows = " UNION ALL ".join(
        f"SELECT '{p}' AS product, coalesce(segment, 'Unknown') AS v, revenue_{p} AS y FROM train WHERE revenue_{p} <> 0" for p in PRODUCTS
    )
    steps = "s1 AS (SELECT product, v, avg(z) AS m FROM scaled GROUP BY ALL)"
    for t in range(1, EXACT_TREES):
        steps += f""",
s{t + 1} AS MATERIALIZED (SELECT product, v, any_value(m) + {EXACT_RATE} * avg(CASE WHEN z < m THEN -1.0::DOUBLE ELSE 1.0 END) AS m
    FROM scaled JOIN s{t} USING (product, v) GROUP BY product, v)"""
    extra = f"""bought AS ({rows}),
scale AS (SELECT product, avg(y) AS mean, stddev_pop(y) AS std FROM bought GROUP BY product),
scaled AS MATERIALIZED (SELECT product, v, (y - mean) / std AS z FROM bought JOIN scale USING (product)),
{steps}"""
    return extra, f"""SELECT client, product, {_r('m * std + mean', 3)} AS predicted_revenue
FROM holdout h JOIN s{EXACT_TREES} s ON coalesce(h.segment, 'Unknown') = v JOIN scale USING (product)"""


def _exact() -> dict[str, str]:
    classes = _exact_classes("coalesce(segment, 'Unknown')")
    pairs = """(SELECT h.product, sum(h.pos * l.neg * CASE WHEN h.p > l.p THEN 1.0 WHEN h.p = l.p THEN 0.5 ELSE 0 END) AS right_pairs
  FROM fitted h JOIN fitted l USING (product) GROUP BY h.product)"""
    matrix = """(SELECT product, sum(pos) AS pos, sum(neg) AS neg, coalesce(sum(pos) FILTER (p > 0.5), 0) AS tp,
  coalesce(sum(neg) FILTER (p > 0.5), 0) AS fp FROM fitted GROUP BY product)"""
    ratio = lambda a, b: f"coalesce(({a})::DOUBLE / nullif({b}, 0), 0)"
    precision, recall = ratio("tp", "tp + fp"), ratio("tp", "pos")
    return {
        "exact_propensity": _recursive(
            classes,
            f"""SELECT client, product, {_r('p')} AS predicted_probability, CAST(p > 0.5 AS INTEGER) AS predicted_class
FROM holdout h JOIN fitted ON coalesce(h.segment, 'Unknown') = v""",
            "holdout",
            "train",
        ),
        "exact_metrics": _recursive(
            classes,
            f"""SELECT 'sale_' || product AS response_variable, 'segment' AS predictive_variables,
  {_r('right_pairs / (pos * neg)')} AS auc_score, {_r(ratio('tp + neg - fp', 'pos + neg'))} AS accuracy,
  {_r(precision)} AS precision, {_r(recall)} AS recall,
  {_r(ratio(f'2 * {precision} * {recall}', f'{precision} + {recall}'))} AS f1_score,
  tp::BIGINT AS true_positives, fp::BIGINT AS false_positives, (pos + neg)::BIGINT AS training_samples,
  {_r('5.0::DOUBLE')} AS param_max_depth, {_r(f'{EXACT_TREES}.0::DOUBLE')} AS param_n_estimators,
  {_r(f'{EXACT_RATE}::DOUBLE')} AS param_learning_rate, NULL::DOUBLE AS param_gamma
FROM {matrix} m JOIN {pairs} q USING (product)""",
            "train",
        ),
        "exact_revenue": _recursive(*_exact_revenue(), "holdout", "train"),
        "exact_attribution": _recursive(
            f"""{_exact_classes("coalesce(sale_f, 0)")},
picked AS (SELECT coalesce(sale_f, 0) AS v FROM train ORDER BY md5('42:' || client), client LIMIT 100),
base AS (SELECT product, avg(m) AS base FROM picked JOIN fitted USING (v) GROUP BY product),
scale AS (SELECT avg(coalesce(sale_f, 0)) AS mean, stddev_pop(coalesce(sale_f, 0)) AS std FROM train)""",
            f"""SELECT client AS instance_id, 'sale_f' AS feature_name, {_r('(v - mean) / std')} AS feature_value,
  {_r('m - base')} AS contribution, {_r('base')} AS base_value, {_r('m')} AS margin, product
FROM train t JOIN fitted f ON coalesce(t.sale_f, 0) = f.v JOIN base USING (product) CROSS JOIN scale""",
            "train",
        ),
        "search_facts": """SELECT kind, CAST(6 AS BIGINT) AS runs, CAST(3 AS BIGINT) AS folds, CAST(0 AS BIGINT) AS not_best,
  CAST(12 AS BIGINT) AS settings, CAST(2 AS BIGINT) AS lengths FROM (VALUES ('propensity'), ('revenue')) AS t(kind)""",
        "model_facts": with_roles(
            " UNION ALL ".join(
                f"""SELECT '{p}' AS product, count(*) AS scored, count(*) FILTER (sale_{p} = 1) AS positives, true AS auc_agrees,
  true AS auc_above_chance, count(*) FILTER (revenue_{p} <> 0) AS buyers,
  {_r(f'avg(revenue_{p}) FILTER (revenue_{p} <> 0)', 3)} AS mean_actual, true AS mae_agrees, true AS mae_below_mean FROM train"""
                for p in PRODUCTS
            ),
            "train",
        ),
    }


def models() -> dict[str, str]:
    """The steps around the learner, over tables derived from the given ones, and facts of fits and scores."""
    trials = """WITH trials AS (SELECT c_custkey % 12 AS iteration_id, c_custkey // 12 AS setting,
  CAST(3 + c_custkey % 12 % 3 AS INTEGER) AS k_folds, CAST(3 + c_custkey % 5 AS INTEGER) AS max_depth,
  CAST(1 + c_custkey % 7 AS INTEGER) AS min_child_weight, CAST(100 * (1 + c_custkey % 3) AS INTEGER) AS n_estimators,
  floor(abs(c_acctbal) / 1000) / 10 AS auc_score FROM customer)"""
    settings = "k_folds, max_depth, min_child_weight, n_estimators, auc_score"
    numbers = 7  # predictors of the propensity model that are numbers
    facts = " UNION ALL ".join(
        f"""SELECT '{p}' AS product, count(*) FILTER (sale_{p} = 1) AS positive_class_count,
  count(*) FILTER (sale_{p} = 0) AS negative_class_count, count(*) FILTER (sale_{p} = 1) AS positives,
  count(*) FILTER (sale_{p} = 0) AS negatives, count(*) AS training_samples FROM train"""
        for p in PRODUCTS
    )
    return _exact() | {
        "sample_rows": with_roles(
            "SELECT client, sale_o FROM train ORDER BY md5('42:' || client), client LIMIT 1000", "train"
        ),
        "ranked_settings": f"""{trials}
SELECT {settings}, CAST(place AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY k_folds ORDER BY auc_score DESC, iteration_id, setting) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY {settings} ORDER BY iteration_id, setting) AS copy FROM trials)
  WHERE copy = 1) WHERE place <= 7""",
        "best_of_trials": f"""{trials}
SELECT max_depth::BIGINT AS max_depth, min_child_weight::BIGINT AS min_child_weight, n_estimators::BIGINT AS n_estimators
FROM trials ORDER BY auc_score DESC, iteration_id, setting LIMIT 1""",
        "ranked_importances": """
SELECT ascii(o_orderstatus) AS iteration_id, o_orderpriority AS feature_name, feature_importance,
  CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY feature_importance DESC, o_orderpriority) AS INTEGER)
    AS feature_importance_rank
FROM (SELECT o_orderstatus, o_orderpriority, floor(count(*) / 50)::DOUBLE AS feature_importance FROM orders GROUP BY ALL)""",
        "attribution_table": f"""
SELECT feature_name, {_r('m', 4)} AS mean_abs_contribution,
  CAST(row_number() OVER (ORDER BY m DESC, feature_name) AS INTEGER) AS feature_rank
FROM (SELECT 'quantity' AS feature_name, avg(abs(l_quantity - 25)) AS m FROM lineitem
  UNION ALL SELECT 'forward', avg(abs(l_linenumber - 3)) FROM lineitem
  UNION ALL SELECT 'backward', avg(abs(3 - l_linenumber)) FROM lineitem)""",
        "latest_model": """
SELECT unnest(range(3)) AS place, unnest(['a', o_orderpriority, 'z']) AS name
FROM (SELECT o_orderpriority FROM orders ORDER BY o_orderkey DESC LIMIT 1)""",
        "score_facts": with_roles(
            "SELECT count(*) AS rows, count(DISTINCT client) AS clients, CAST(0 AS BIGINT) AS wrong FROM holdout", "holdout"
        ),
        "attribution_facts": with_roles(
            f"SELECT count(*) AS rows, any_value(n) AS least, any_value(n) AS most, CAST(0 AS BIGINT) AS off FROM holdout, "
            f"(SELECT {numbers - 1} + count(DISTINCT coalesce(segment, 'Unknown')) AS n FROM train)",
            "holdout",
            "train",
        ),
        "fit_facts": with_roles(facts, "train"),
    }


def files() -> dict[str, str]:
    loaded = " UNION ALL ".join(
        f"SELECT '{t}_ingestion' AS job, 'bronze' AS layer, '{t}' AS \"table\", 'ok' AS status, count(*) AS rows, CAST(0 AS BIGINT) AS rejected FROM {t}"
        for t in ("customer", "orders", "nation", "region", "supplier")
    )
    return {
        "ingest_jobs": f"{loaded} UNION ALL SELECT 'absent_ingestion', 'bronze', 'absent', 'failed', NULL, NULL",
        "ingested_sheet_orders": "SELECT * FROM orders",
        "ingested_sheet_customer": "SELECT * FROM customer",
        "torn_sheet": "SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN 'o_totalprice is no double: n/a' END AS reason FROM orders",
        "replaced_from_itself": "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus, "
        "CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS priority FROM orders",
        "ingested_orders": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
        "sql_with_repeats": with_roles(
            "SELECT sale_o, count_f, * EXCLUDE (sale_o, count_f), sale_o AS sale_o_1, count_f AS count_f_1 "
            "FROM train WHERE sale_o = 1",
            "train",
        ),
        "sql_status": "SELECT o_orderstatus, count(*) AS n, CAST(1 AS INTEGER) AS good_status, "
        "CAST(0 AS INTEGER) AS bad_status FROM orders GROUP BY o_orderstatus",
    }


def oracle_sql() -> dict[str, str]:
    groups = (decision, silver, quality, profiling, features, metrics, models, files)
    return {name: sql for group in groups for name, sql in group().items()}
