"""SQL of the data and score queries."""

from __future__ import annotations

BASE = """base AS (
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       l_quantity, l_extendedprice, l_discount, l_tax,
       CAST(CASE WHEN (l_quantity-2.55e1)/1.443e1*(l_discount-5e-2)/2.9e-2
                    + (l_extendedprice-5.3e4)/3e4
                    + (((l_orderkey*7919+l_partkey*104729+l_linenumber*1299709)%1000)/5e2-1e0)*1.5e0
                 > 0e0 THEN 1 ELSE 0 END AS INT) AS label,
       CAST((l_orderkey*31+l_partkey*17+l_linenumber*7)%5 AS INT) AS fold
FROM lineitem)"""
KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FEATURE_LIST = ", ".join(FEATURES)
ROW_ORDER = f"{KEYS}, {FEATURE_LIST}"


def line_hash(seed=0):
    total = f"{seed} + l_orderkey*7919 + l_partkey*104729 + CAST(l_linenumber AS BIGINT)*1299709"
    return f"((({total}) % 2147483647) * 48271 % 2147483647)"


def with_base(text, *ctes):
    return "WITH " + ",\n".join([BASE, *ctes]) + "\n" + text


def union(parts):
    return "\nUNION ALL\n".join(parts)


NULLED = f"""nulled AS (
SELECT {KEYS}, l_quantity, l_extendedprice, l_discount, nullif(l_tax, 0e0) AS l_tax, label, fold FROM base)"""


def long_form(source, columns=FEATURES, extra=""):
    return union([f"SELECT {extra}'{c}' AS feature, {c} AS value FROM {source}" for c in columns])


def stats_sql():
    rows = [
        f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 4) AS mean,
 round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
 round(quantile_cont({c}, 2.5e-1), 4) AS q25, round(quantile_cont({c}, 5e-1), 4) AS q50,
 round(quantile_cont({c}, 7.5e-1), 4) AS q75, round(max({c}), 4) AS max,
 round(1e2 * avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END), 4) AS missing_pct FROM nulled"""
        for c in FEATURES
    ]
    return with_base(union(rows), NULLED)


def missing_sql(source, columns):
    return union([
        f"SELECT '{c}' AS feature, round(1e2 * avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END), 4)"
        f" AS missing_pct FROM {source}"
        for c in columns
    ])


def histogram_sql(shared):
    over = "PARTITION BY feature" if shared else "PARTITION BY feature, label"
    long = f"values_long AS ({long_form('base', extra='label, ')})"
    ranged = f"""ranged AS (
SELECT feature, label, value, min(value) OVER ({over}) AS low, max(value) OVER ({over}) AS high,
       count(*) OVER (PARTITION BY feature, label) AS n FROM values_long)"""
    ranges = "ranges AS (SELECT DISTINCT feature, label, low, high, n FROM ranged)"
    binned = """binned AS (
SELECT feature, label, CASE WHEN low = high THEN 25
       ELSE least(49, CAST(floor((value-low)*5e1/(high-low)) AS INT)) END AS bin,
       count(*) AS n_in_bin FROM ranged GROUP BY ALL)"""
    start = "CASE WHEN low = high THEN low - 5e-1 ELSE low END"
    width = "(CASE WHEN low = high THEN 1e0 ELSE high - low END / 5e1)"
    return with_base(
        f"""SELECT r.feature, r.label, CAST(b.bin AS INT) AS bin,
 round({start} + b.bin * {width}, 6) AS left_edge, round({start} + (b.bin + 1) * {width}, 6) AS right_edge,
 coalesce(n_in_bin, 0) AS n_rows, round(coalesce(n_in_bin, 0) / (n * {width}), 8) AS density
FROM ranges r CROSS JOIN (SELECT unnest(range(50)) AS bin) b
LEFT JOIN binned c ON c.feature = r.feature AND c.label = r.label AND c.bin = b.bin""",
        long, ranged, ranges, binned,
    )


def corr_sql(source, *ctes):
    rows = [
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
        + ("1e0 AS r" if a == b else f"round((SELECT corr({a}, {b}) FROM {source}), 6) AS r")
        for a in FEATURES for b in FEATURES
    ]
    return with_base(union(rows), *ctes)


STRATA = f"""strata AS (
SELECT *, row_number() OVER (PARTITION BY label ORDER BY {line_hash(42)}, {ROW_ORDER}) - 1 AS rank0,
       count(*) OVER (PARTITION BY label) AS n_class, count(*) OVER () AS n_all FROM base)"""


def scale_sql(std, fit_where, apply_where):
    stats = ", ".join(f"avg({c}) AS m_{c}, {std}({c}) AS s_{c}" for c in FEATURES)
    values = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS z_{c}" for c in FEATURES)
    return with_base(
        f"SELECT {KEYS}, {values} FROM base CROSS JOIN stats {apply_where}",
        f"stats AS (SELECT {stats} FROM base {fit_where})",
    )


DATA_SQL = {
    "scan_labelled": with_base("SELECT * FROM base"),
    "label_cast": "SELECT event_id, CAST(trunc(value) AS INT) AS label FROM events",
    "row_count": "SELECT count(*) AS n_rows FROM lineitem",
    "split_train_test": with_base(
        f"SELECT CASE WHEN fold <> 0 THEN 'train' ELSE 'test' END AS side, {KEYS}, label FROM base"
    ),
    "project_features": with_base(f"SELECT {KEYS}, {FEATURE_LIST}, label FROM base"),
    "feature_groups": with_base(
        "SELECT *, CASE WHEN feature IN ('l_quantity', 'l_extendedprice') THEN 'low_level'"
        f" ELSE 'high_level' END AS feature_group FROM ({long_form('base', extra=KEYS + ', ')})"
    ),
    "class_filter": with_base(
        f"SELECT CASE WHEN label = 1 THEN 'signal' ELSE 'background' END AS kind, {KEYS} FROM base"
    ),
    "summary_statistics": stats_sql(),
    "missing_pct": "WITH nulled AS (SELECT l_quantity, l_extendedprice, l_discount,"
    " nullif(l_tax, 0e0) AS l_tax FROM lineitem) " + missing_sql("nulled", FEATURES),
    "missing_pct_left_join": "WITH joined AS (SELECT doc_id, quality, toxic FROM documents"
    " LEFT JOIN labels USING (doc_id)) " + missing_sql("joined", ["quality", "toxic"]),
    "class_balance": with_base(
        "SELECT label, count(*) AS n_rows, round(count(*) / (SELECT count(*) * 1e0 FROM base), 6) AS share"
        " FROM base GROUP BY label"
    ),
    "histogram_by_class": histogram_sql(False),
    "histogram_shared_edges": histogram_sql(True),
    "correlation_matrix": corr_sql("base"),
    "correlation_pairwise": corr_sql("nulled", NULLED),
    "kfold_assign": with_base(f"SELECT {KEYS}, label, CAST({line_hash(42)} % 5 AS INT) AS fold FROM base"),
    "stratified_kfold_assign": with_base(
        f"""SELECT {KEYS}, label, CAST(ntile(5) OVER (
 PARTITION BY label ORDER BY {line_hash(42)}, {ROW_ORDER}) - 1 AS INT) AS fold FROM base"""
    ),
    "stratified_sample": with_base(
        f"SELECT {KEYS}, label FROM strata JOIN quotas USING (label) WHERE rank0 < quota",
        STRATA,
        "wanted AS (SELECT label, count(*) AS n, (SELECT count(*) FROM base) AS total,"
        " (SELECT count(*) * 3 // 10 FROM base) AS size FROM base GROUP BY label)",
        "floors AS (SELECT *, size * n // total AS low,"
        " row_number() OVER (ORDER BY (size * n) % total DESC, label) AS turn FROM wanted)",
        "quotas AS (SELECT label, low + CASE WHEN turn <= size - (SELECT sum(low) FROM floors)"
        " THEN 1 ELSE 0 END AS quota FROM floors)",
    ),
    "stratified_sample_hash": with_base(
        f"SELECT {KEYS}, label FROM base WHERE {line_hash(7)} <"
        " CASE label WHEN 0 THEN 536870911 ELSE 1073741823 END"
    ),
    "random_split": f"""SELECT {KEYS}, CAST(CASE WHEN {line_hash(42)} < floor(2147483647 * 6e-1) THEN 0
 WHEN {line_hash(42)} < floor(2147483647 * 8e-1) THEN 1 ELSE 2 END AS INT) AS part FROM lineitem""",
    "fold_complement": with_base(f"SELECT {KEYS}, fold FROM base WHERE fold <> 1"),
    "fold_complement_distinct": with_base(
        f"SELECT {KEYS}, {', '.join(FEATURES)}, label FROM base WHERE fold <> 1 EXCEPT"
        f" SELECT {KEYS}, {', '.join(FEATURES)}, label FROM base WHERE fold = 1"
    ),
    "except_distinct": with_base(
        "SELECT l_quantity, l_discount, l_tax, label FROM base EXCEPT"
        " SELECT l_quantity, l_discount, l_tax, label FROM base WHERE fold = 1"
    ),
    "vector_assemble": f"SELECT {KEYS}, "
    + ", ".join(f"{c} AS v{i}" for i, c in enumerate(FEATURES)) + " FROM lineitem",
    "vector_from_array": """SELECT vec_id, CAST(len(embedding) AS INT) AS n_dims,
 round(sqrt(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE)))), 5) AS norm,
 round(CAST(embedding[1] AS DOUBLE), 6) AS first_value FROM embeddings""",
    "standard_scale_sample": scale_sql("stddev_samp", "", ""),
    "standard_scale_population": scale_sql("stddev_pop", "", ""),
    "scale_train_to_test": scale_sql("stddev_samp", "WHERE fold <> 0", "WHERE fold = 0"),
    "csv_sink_roundtrip": with_base(f"SELECT label, {', '.join(FEATURES)} FROM base"),
}


def fixed_score(weight="2e-2"):
    margin = f"(l_extendedprice-5.3e4)/3e4 + (l_quantity-2.55e1)*{weight}"
    return f"(1e0/(1e0+exp(-({margin}))))"


def auc_ctes(scores, by):
    """CTEs that end in `aucs(by, auc)` over rows of (by, label, score)."""
    prefix = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return [
        f"""tied AS (SELECT {prefix}score, sum(label) AS pos, count(*) - sum(label) AS neg
 FROM {scores} GROUP BY {prefix}score)""",
        f"""ranked AS (SELECT *, sum(neg) OVER ({part}ORDER BY score ROWS UNBOUNDED PRECEDING) - neg AS below
 FROM tied)""",
        f"""aucs AS (SELECT {prefix}sum(pos * (below + neg / 2e0)) / (sum(pos) * 1e0 * sum(neg)) AS auc
 FROM ranked {'GROUP BY ' + by if by else ''})""",
    ]


SCORED = f"scored AS (SELECT {KEYS}, label, fold, {fixed_score()} AS score FROM base)"
# Same weights as the fixed scorers of the queries.
FIXED_MODELS = [
    ("native", "Logistic Regression", "2e-2"),
    ("native", "Random Forest", "0e0"),
    ("native", "Gradient Boosted Trees", "5e-2"),
    ("exact", "Logistic Regression", "3e-2"),
    ("exact", "Random Forest", "-2e-2"),
    ("exact", "Gradient Boosted Trees", "8e-2"),
]


def board_ctes():
    rows = union([
        f"SELECT '{f}' AS framework, '{m}' AS model, label, {fixed_score(w)} AS score FROM base WHERE fold = 0"
        for f, m, w in FIXED_MODELS
    ])
    return [
        f"model_scores AS ({rows})",
        *auc_ctes("model_scores", "framework, model"),
        """board AS (SELECT framework, model, round(accuracy, 5) AS accuracy, round(auc, 5) AS roc_auc FROM aucs
 JOIN (SELECT framework, model, avg(CASE WHEN (score > 5e-1) = (label = 1) THEN 1e0 ELSE 0e0 END) AS accuracy
       FROM model_scores GROUP BY framework, model) USING (framework, model))""",
    ]


def pivot_sql(metric):
    native = f"max(CASE WHEN framework = 'native' THEN {metric} END)"
    exact = f"max(CASE WHEN framework = 'exact' THEN {metric} END)"
    return (
        f"SELECT model, {native} AS native, {exact} AS exact,"
        f" round({native} - {exact}, 5) AS difference, '{metric}' AS metric FROM board GROUP BY model"
    )


TIMINGS = """timings AS (
SELECT CASE WHEN user_id % 3 = 0 THEN 'native' ELSE 'exact' END AS framework, event_type AS model,
       CAST(CASE user_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 8 END AS INT) AS n_cores,
       round(avg(value), 3) AS train_time, round(avg(value / 1e1), 3) AS predict_time
FROM events GROUP BY 1, 2, 3)"""


def speedup_sql():
    def ratio(c):
        base = f"max(CASE WHEN n_cores = 1 THEN {c} END) OVER (PARTITION BY framework, model)"
        return f"CASE WHEN {c} > 0 THEN {base} / {c} END"

    train, predict = ratio("train_time"), ratio("predict_time")
    return f"""WITH {TIMINGS} SELECT *, round({train}, 3) AS train_speedup,
 round(({train}) / n_cores, 3) AS train_efficiency, round({predict}, 3) AS predict_speedup,
 round(({predict}) / n_cores, 3) AS predict_efficiency FROM timings"""


def candidate_ctes():
    rows = union([
        f"SELECT {i} AS candidate, fold, label, {fixed_score(f'({c}/5e1)')} AS score FROM base"
        for i, c in enumerate(["1e-2", "1e-1", "1e0", "1e1"])
    ])
    return [
        f"candidate_scores AS ({rows})",
        *auc_ctes("candidate_scores", "candidate, fold"),
        "means AS (SELECT candidate, avg(auc) AS mean_auc, stddev_pop(auc) AS std_auc,"
        " count(auc) AS n_folds FROM aucs GROUP BY candidate)",
    ]


N_TRAIN = "(SELECT count(*) * 1e0 FROM base WHERE fold <> 0)"
NONE = "CAST(NULL AS DOUBLE)"


def grid_sql():
    def row(family, i, c=NONE, max_iter=NONE, n_estimators=NONE, max_depth=NONE, rate=NONE):
        return (
            f"SELECT '{family}' AS family, {i} AS candidate, {c} AS C, {max_iter} AS max_iter,"
            f" {n_estimators} AS n_estimators, {max_depth} AS max_depth, {rate} AS learning_rate,"
            f" round(1e0/({c} * {N_TRAIN}), 12) AS reg_param_exact"
        )

    rows = [row("lr", i, c=c, max_iter="2e2") for i, c in enumerate(["1e-2", "1e-1", "1e0", "1e1"])]
    rows += [
        row("rf", i, n_estimators=n, max_depth=d)
        for i, (n, d) in enumerate((n, d) for n in ("5e1", "1e2") for d in ("8e0", "1.2e1"))
    ]
    rows += [
        row("gbt", i, max_iter=m, max_depth=d, rate=r)
        for i, (m, d, r) in enumerate(
            (m, d, r) for m in ("1e2", "2e2") for d in ("3e0", "5e0") for r in ("5e-2", "1e-1")
        )
    ]
    return with_base(union(rows))


def search_sql():
    def u(step):
        return f"((i + 1) * {step} - floor((i + 1) * {step}))"

    a, b, c = "6.180339887498949e-1", "4.1421356237309515e-1", "7.320508075688772e-1"

    def whole(low, high, step):
        return f"({low}e0 + floor({u(step)} * {high - low + 1}e0))"

    def log(low, ratio, step):
        return f"exp(ln({low}) + {u(step)} * ln({ratio}))"

    def row(family, penalty=NONE, max_iter=NONE, n_estimators=NONE, max_depth=NONE, rate=NONE):
        return (
            f"SELECT '{family}' AS family, CAST(i AS INT) AS candidate, round({penalty}, 8) AS C,"
            f" {max_iter} AS max_iter, {n_estimators} AS n_estimators, {max_depth} AS max_depth,"
            f" round({rate}, 8) AS learning_rate, round(1e0/({penalty} * {N_TRAIN}), 12) AS reg_param_exact"
            " FROM (SELECT unnest(range(10)) AS i)"
        )

    return with_base(union([
        row("lr", penalty=log("1e-3", "1e2/1e-3", a)),
        row("rf", n_estimators=whole(50, 150, a), max_depth=whole(5, 15, b)),
        row("gbt", max_iter=whole(50, 200, a), max_depth=whole(2, 8, b), rate=log("1e-2", "3e-1/1e-2", c)),
    ]))


def mapping_sql():
    exact = f"round(1e0/(1e-2 * {N_TRAIN}), 12)"
    rows = []
    for profile, reg in (("native", "1e2"), ("exact", exact)):
        values = [
            ("lr", "maxIter", "2e2"), ("lr", "regParam", reg),
            ("rf", "maxDepth", "8e0"), ("rf", "numTrees", "5e1"),
            ("gbt", "maxDepth", "3e0"), ("gbt", "maxIter", "1e2"), ("gbt", "stepSize", "5e-2"),
        ]
        rows += [
            f"SELECT '{f}' AS family, '{profile}' AS profile, '{p}' AS param, {v} AS value"
            for f, p, v in values
        ]
    return with_base(union(rows))


SCORE_SQL = {
    "score_fixed_lr": with_base(
        f"SELECT {KEYS}, round(score, 8) AS score, CASE WHEN score > 5e-1 THEN 1e0 ELSE 0e0 END AS prediction"
        " FROM scored WHERE fold = 0", SCORED),
    "accuracy": with_base(
        "SELECT fold, round(avg(CASE WHEN (score > 5e-1) = (label = 1) THEN 1e0 ELSE 0e0 END), 6) AS accuracy"
        " FROM scored GROUP BY fold", SCORED),
    "roc_auc": with_base("SELECT fold, round(auc, 6) AS roc_auc FROM aucs",
                         SCORED, *auc_ctes("scored", "fold")),
    "roc_auc_tied": with_base(
        "SELECT round(auc, 6) AS roc_auc FROM aucs",
        f"coarse AS (SELECT label, round({fixed_score()}, 2) AS score FROM base)", *auc_ctes("coarse", "")),
    "roc_auc_builtin": with_base(
        "SELECT (SELECT count(*) FROM held_out) AS n_rows, round(auc, 6) AS roc_auc FROM aucs",
        SCORED, "held_out AS (SELECT * FROM scored WHERE fold = 0)", *auc_ctes("held_out", "")),
    "leaderboard_fixed": with_base("SELECT * FROM board", *board_ctes()),
    "leaderboard_union": with_base("SELECT * FROM board", *board_ctes()),
    "framework_pivot": with_base(union([pivot_sql("accuracy"), pivot_sql("roc_auc")]), *board_ctes()),
    "result_csv_roundtrip": with_base("SELECT * FROM board", *board_ctes()),
    "benchmark_series": f"WITH {TIMINGS} SELECT * FROM timings WHERE framework = 'native' ORDER BY model, n_cores",
    "speedup_table": speedup_sql(),
    "cv_mean_score": with_base(
        "SELECT candidate, round(mean_auc, 6) AS mean_auc, round(std_auc, 6) AS std_auc, n_folds FROM means",
        *candidate_ctes()),
    "best_candidate": with_base(
        "SELECT candidate, round(mean_auc, 6) AS mean_auc FROM means"
        " ORDER BY mean_auc DESC, candidate LIMIT 1", *candidate_ctes()),
    "param_grid": grid_sql(),
    "search_candidates": search_sql(),
    "param_mapping": mapping_sql(),
}
