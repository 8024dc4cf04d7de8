"""SQL of the model queries.

Logistic regressions are solved here by Newton's method, written out as a chain
of common table expressions: one pair of sums per step and an elimination of the
5 x 5 system, for many (model, fold) problems at a time. Tree ensembles have no
SQL form; their texts give the row counts and the invariants.
"""

from __future__ import annotations

from checks.data_sql import (
    FEATURES,
    N_TRAIN,
    ROW_ORDER,
    auc_ctes,
    line_hash,
    union,
    with_base,
)

K = len(FEATURES)
STEPS = 9


def newton_ctes(rows, regs, name="fit"):
    """CTEs ending in `{name}(model, w0..wK)`.

    `rows` holds (model, y, x1..xK), `regs` holds (model, r1..rK): mean log loss
    plus half the sum of r_i times the squared weights, intercept free.
    """
    weights, penalties = [f"w{i}" for i in range(K + 1)], [f"r{i}" for i in range(1, K + 1)]
    ctes = [f"{name}_0 AS MATERIALIZED (SELECT model, {', '.join(penalties)}, "
            + ", ".join(f"0e0 AS {w}" for w in weights) + f" FROM {regs})"]
    x = ["1e0"] + [f"x{i}" for i in range(1, K + 1)]
    margin = " + ".join(f"w{i}*{x[i]}" for i in range(K + 1))
    for step in range(1, STEPS + 1):
        previous = f"{name}_{step - 1}"
        sums = [f"avg((p - y)*{x[i]}) AS g{i}" for i in range(K + 1)]
        sums += [
            f"avg(p*(1e0 - p)*{x[i]}*{x[j]}) AS h{i}{j}"
            for i in range(K + 1) for j in range(i, K + 1)
        ]
        columns = ", ".join([*penalties, *weights])
        ctes.append(
            f"{name}_s{step} AS MATERIALIZED (SELECT model, {columns}, {', '.join(sums)} FROM ("
            f"SELECT r.*, {columns}, 1e0/(1e0 + exp(-({margin}))) AS p FROM {rows} r JOIN {previous} USING (model))"
            f" GROUP BY model, {columns})"
        )
        ridge = ["model", *penalties, *weights]
        ridge += ["g0"] + [f"g{i} + r{i}*w{i} AS g{i}" for i in range(1, K + 1)]
        ridge += [
            f"h{i}{j} + r{i} AS h{i}{j}" if i == j and i else f"h{i}{j}"
            for i in range(K + 1) for j in range(i, K + 1)
        ]
        ctes.append(f"{name}_e{step}_0 AS MATERIALIZED (SELECT {', '.join(ridge)} FROM {name}_s{step})")
        for pivot in range(K):
            kept = ["model", *penalties, *weights]
            for i in range(K + 1):
                if i <= pivot:
                    kept += [f"g{i}"] + [f"h{i}{j}" for j in range(i, K + 1)]
                else:
                    factor = f"h{pivot}{i}/h{pivot}{pivot}"
                    kept.append(f"g{i} - {factor}*g{pivot} AS g{i}")
                    kept += [f"h{i}{j} - {factor}*h{pivot}{j} AS h{i}{j}" for j in range(i, K + 1)]
            ctes.append(
                f"{name}_e{step}_{pivot + 1} AS MATERIALIZED (SELECT {', '.join(kept)} FROM {name}_e{step}_{pivot})"
            )
        source, solved = f"{name}_e{step}_{K}", []
        for i in range(K, -1, -1):
            rest = "".join(f" - h{i}{j}*d{j}" for j in range(i + 1, K + 1))
            solved.append(i)
            target = f"{name}_b{step}_{i}"
            ctes.append(f"{target} AS MATERIALIZED (SELECT *, (g{i}{rest})/h{i}{i} AS d{i} FROM {source})")
            source = target
        moved = ", ".join(f"w{i} - d{i} AS w{i}" for i in range(K + 1))
        ctes.append(f"{name}_{step} AS MATERIALIZED (SELECT model, {', '.join(penalties)}, {moved} FROM {source})")
    ctes.append(f"{name} AS (SELECT * FROM {name}_{STEPS})")
    return ctes


def penalties(reg):
    """The same penalty for every weight."""
    return ", ".join(f"{reg} AS r{i}" for i in range(1, K + 1))


def scaled_cte(profile, name="z", fit_where="fold <> 0"):
    """All rows of the base table, scaled by the statistics of the training rows."""
    std = "stddev_pop" if profile == "exact" else "stddev_samp"
    stats = ", ".join(f"avg({c}) AS m_{c}, {std}({c}) AS s_{c}" for c in FEATURES)
    values = ", ".join(f"({c} - m_{c})/s_{c} AS x{i}" for i, c in enumerate(FEATURES, 1))
    return (
        f"{name} AS MATERIALIZED (SELECT base.*, CAST(label AS DOUBLE) AS y, {values} FROM base CROSS JOIN"
        f" (SELECT {stats} FROM base WHERE {fit_where}))"
    )


XS = ", ".join(f"x{i}" for i in range(1, K + 1))
MARGIN = " + ".join(["w0"] + [f"w{i}*x{i}" for i in range(1, K + 1)])
PROBABILITY = f"1e0/(1e0 + exp(-({MARGIN})))"


def single_fit(profile):
    reg = f"1e0/{N_TRAIN}" if profile == "exact" else "0e0"
    return [
        scaled_cte(profile),
        f"train_rows AS (SELECT 0 AS model, y, {XS} FROM z WHERE fold <> 0)",
        f"regs AS (SELECT 0 AS model, {penalties(reg)})",
        *newton_ctes("train_rows", "regs"),
    ]


TERMS = union(
    ["SELECT 'intercept' AS term, round(w0, 4) AS coefficient FROM fit"]
    + [f"SELECT '{c}' AS term, round(w{i}, 4) AS coefficient FROM fit" for i, c in enumerate(FEATURES, 1)]
)
TEST_SCORES = f"test_scores AS (SELECT label, {PROBABILITY} AS score FROM z CROSS JOIN fit WHERE z.fold = 0)"


def cross_validation(profile, candidates, folds, folded):
    """CTEs ending in `cv(candidate, mean_auc, std_auc, n_folds)`.

    `candidates` lists the SQL values of C, `folded` is the CTE
    `folded(label, fold, y, x1..xK)`; model = 100 * candidate + held-out fold.
    """
    listed = union([f"SELECT {i} AS candidate, {c} AS C" for i, c in enumerate(candidates)])
    # Natively a fold's penalty is on its own scale: weights times the deviation over its training rows.
    regs = [f"1e0/(C * n) AS r{i}" if profile == "exact" else f"v{i}/C AS r{i}" for i in range(1, K + 1)]
    variances = ", ".join(f"var_samp(x{i}) AS v{i}" for i in range(1, K + 1))
    return [
        folded,
        f"candidates AS ({listed})",
        f"scales AS MATERIALIZED (SELECT h.fold, count(*) * 1e0 AS n, {variances} FROM folded JOIN"
        f" (SELECT unnest(range({folds})) AS fold) h ON folded.fold <> h.fold GROUP BY h.fold)",
        f"regs AS MATERIALIZED (SELECT candidate * 100 + fold AS model, {', '.join(regs)} FROM candidates CROSS JOIN scales)",
        f"train_rows AS (SELECT r.model, y, {XS} FROM folded CROSS JOIN regs r WHERE folded.fold <> r.model % 100)",
        *newton_ctes("train_rows", "regs"),
        f"held_out AS (SELECT fit.model, label, {PROBABILITY} AS score FROM folded JOIN fit"
        " ON folded.fold = fit.model % 100)",
        *auc_ctes("held_out", "model"),
        "cv AS (SELECT CAST(model // 100 AS INT) AS candidate, avg(auc) AS mean_auc, stddev_pop(auc) AS std_auc,"
        " count(auc) AS n_folds FROM aucs GROUP BY 1)",
    ]


GRID_C = ["1e-2", "1e-1", "1e0", "1e1"]
SEARCH_C = [
    f"(SELECT exp(ln(1e-3) + ({i}e0 * 6.180339887498949e-1 - floor({i}e0 * 6.180339887498949e-1)) * ln(1e2/1e-3)))"
    for i in range(1, 11)
]
TRAIN_STRATA = f"""strata AS (
SELECT *, row_number() OVER (PARTITION BY label ORDER BY {line_hash(42)}, {ROW_ORDER}) - 1 AS rank0
FROM z WHERE fold <> 0)"""


def key_folds(folds):
    return (
        f"folded AS MATERIALIZED (SELECT label, y, {XS}, CAST({line_hash(42)} % {folds} AS INT) AS fold"
        " FROM z WHERE fold <> 0)"
    )


def stratified_folds(source, folds, where=""):
    return (
        f"folded AS MATERIALIZED (SELECT label, y, {XS}, CAST(ntile({folds}) OVER (PARTITION BY label"
        f" ORDER BY {line_hash(43)}, {ROW_ORDER}) - 1 AS INT) AS fold FROM {source} {where})"
    )


RANK = "CAST(rank() OVER (ORDER BY mean_auc DESC NULLS LAST) AS INT)"


def cv_sql(profile, candidates, folds, *ctes, folded, with_max_iter, refit_rows=None):
    extra = ", 2e2 AS max_iter" if with_max_iter else ""
    penalty = "C" if with_max_iter else "round(C, 8) AS C"
    refits = ""
    if refit_rows:
        best = "(SELECT C FROM cv JOIN candidates USING (candidate) ORDER BY mean_auc DESC, candidate LIMIT 1)"
        reg = f"1e0/({best} * (SELECT count(*) FROM all_rows))" if profile == "exact" else f"1e0/{best}"
        after = [f"all_rows AS MATERIALIZED (SELECT 0 AS model, y, {XS} FROM {refit_rows})",
                 f"best_reg AS MATERIALIZED (SELECT 0 AS model, {penalties(reg)})", *newton_ctes("all_rows", "best_reg", "refit")]
        refits = "".join(f", (SELECT round(w{i}, 4) FROM refit) AS refit_{t}" for i, t in enumerate(["intercept", *FEATURES]))
    else:
        after = []
    return with_base(
        f"SELECT candidate, {penalty}{extra}, round(mean_auc, 4) AS mean_auc, round(std_auc, 4) AS std_auc,"
        f" n_folds, {RANK} AS rank, true AS fit_timed{refits} FROM cv JOIN candidates USING (candidate)",
        scaled_cte(profile), *ctes, *cross_validation(profile, candidates, folds, folded), *after,
    )


def grid_search_sql():
    best = "(SELECT C FROM cv JOIN candidates USING (candidate) ORDER BY mean_auc DESC, candidate LIMIT 1)"
    terms = union(
        ["SELECT 'intercept' AS term, round(w0, 4) AS coefficient FROM refit"]
        + [f"SELECT '{c}' AS term, round(w{i}, 4) AS coefficient FROM refit" for i, c in enumerate(FEATURES, 1)]
    )
    return with_base(
        f"SELECT t.*, {best} AS best_C, (SELECT round(max(mean_auc), 4) FROM cv) AS cv_score FROM ({terms}) t",
        scaled_cte("native"), *cross_validation("native", GRID_C, 5, key_folds(5)),
        f"all_rows AS (SELECT 0 AS model, y, {XS} FROM folded)",
        f"best_reg AS MATERIALIZED (SELECT 0 AS model, {penalties(f'1e0/{best}')})",
        *newton_ctes("all_rows", "best_reg", "refit"),
    )


def ensemble_sql(*entries):
    """Entries are (family, profile, trees); trees is None for a model without any, 0 for early stopping."""
    return with_base(union([
        f"""SELECT '{family}' AS family, '{profile}' AS profile, count(*) FILTER (fold <> 0) AS n_train,
 count(*) FILTER (fold = 0) AS n_scored, CAST({trees or 'NULL'} AS BIGINT) AS n_trees,
 CAST({'true' if trees == 0 else 'NULL'} AS BOOLEAN) AS stopped_early,
 CAST({'true' if trees == 0 else 'NULL'} AS BOOLEAN) AS stops_by_losses, true AS probabilities_valid, true AS predictions_consistent,
 true AS separates_classes FROM base"""
        for family, profile, trees in entries
    ]))


def best_split(rows, name):
    """CTEs ending in `{name}(node, feature, value)`: the cut x <= value of least Gini impurity for each node."""
    return [
        f"{name}_cells AS (SELECT node, feature, value, count(*) * 1e0 AS n, sum(label) * 1e0 AS n1 FROM ("
        "SELECT node, label, unnest([1, 2, 3]) AS feature, unnest([l_quantity, l_discount, l_tax]) AS value"
        f" FROM {rows} WHERE fold <> 0) GROUP BY ALL)",
        f"{name}_cuts AS (SELECT node, feature, value, sum(n) OVER upto AS l, sum(n1) OVER upto AS l1,"
        f" sum(n) OVER whole AS n, sum(n1) OVER whole AS n1 FROM {name}_cells WINDOW"
        " upto AS (PARTITION BY node, feature ORDER BY value), whole AS (PARTITION BY node, feature))",
        f"{name} AS (SELECT node, arg_max(feature, purity) AS feature, arg_max(value, purity) AS value FROM ("
        "SELECT *, (l1*l1 + (l - l1)*(l - l1))/l + ((n1 - l1)*(n1 - l1) + (n - l - n1 + l1)*(n - l - n1 + l1))/(n - l)"
        f" AS purity FROM {name}_cuts WHERE l < n) GROUP BY node)",
    ]


def tree_sql():
    """Two levels of splits; leaves of one parent that predict the same class are merged."""
    x = "(CASE feature WHEN 1 THEN l_quantity WHEN 2 THEN l_discount ELSE l_tax END)"
    same = "bool_and(2 * n1 > n) OR bool_and(2 * n1 <= n)"
    return with_base(
        "SELECT round(probability, 6) AS probability, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive"
        " FROM (SELECT label, CASE WHEN t.same THEN t.n1/t.n WHEN s.same THEN s.n1/s.n ELSE f.n1/f.n END AS probability"
        " FROM leafed JOIN leaves f USING (side, sub) JOIN sides s USING (side) CROSS JOIN top t WHERE fold = 0) GROUP BY 1",
        "rooted AS (SELECT *, 0 AS node FROM base)",
        *best_split("rooted", "first_cut"),
        f"halved AS (SELECT base.*, CAST({x} <= value AS INT) AS node FROM base CROSS JOIN first_cut)",
        *best_split("halved", "second_cut"),
        f"leafed AS (SELECT label, fold, node AS side, CAST({x} <= value AS INT) AS sub FROM halved JOIN second_cut USING (node))",
        "leaves AS (SELECT side, sub, count(*) * 1e0 AS n, sum(label) * 1e0 AS n1 FROM leafed WHERE fold <> 0 GROUP BY 1, 2)",
        f"sides AS (SELECT side, {same} AS same, sum(n) AS n, sum(n1) AS n1 FROM leaves GROUP BY 1)",
        f"top AS (SELECT {same} AS same, sum(n) AS n, sum(n1) AS n1 FROM leaves)",
    )


def variance_split(rows, name):
    """CTEs ending in `{name}(node, feature, value)`: the cut x <= value that leaves the least variance of t for each node."""
    return [
        f"{name}_cells AS MATERIALIZED (SELECT node, feature, value, count(*) * 1e0 AS n, sum(t) AS s FROM ("
        "SELECT node, t, unnest([1, 2, 3]) AS feature, unnest([l_quantity, l_discount, l_tax]) AS value"
        f" FROM {rows} WHERE fold <> 0) GROUP BY ALL)",
        f"{name}_cuts AS (SELECT node, feature, value, sum(n) OVER upto AS l, sum(s) OVER upto AS ls,"
        f" sum(n) OVER whole AS n, sum(s) OVER whole AS s FROM {name}_cells WINDOW"
        " upto AS (PARTITION BY node, feature ORDER BY value), whole AS (PARTITION BY node, feature))",
        f"{name} AS MATERIALIZED (SELECT node, arg_max(feature, gain) AS feature, arg_max(value, gain) AS value FROM ("
        f"SELECT *, ls*ls/l + (s - ls)*(s - ls)/(n - l) AS gain FROM {name}_cuts WHERE l < n) GROUP BY node)",
    ]


def boosting_ctes(rounds, step):
    """CTEs ending in `boosted(label, fold, f1..f{rounds})`: margins after each round, for all rows.

    The first tree is fitted to y = -1 or 1, later ones to 4y/(1 + exp(2yF)).
    """
    x = "(CASE feature WHEN 1 THEN l_quantity WHEN 2 THEN l_discount ELSE l_tax END)"
    ctes = ["margins_0 AS MATERIALIZED (SELECT *, 2e0 * label - 1e0 AS y FROM base)"]
    known = []
    for i in range(1, rounds + 1):
        target = "y" if i == 1 else f"4e0*y/(1e0 + exp(2e0*y*f{i - 1}))"
        ctes += [
            f"rooted_{i} AS MATERIALIZED (SELECT *, {target} AS t, 0 AS node FROM margins_{i - 1})",
            *variance_split(f"rooted_{i}", f"top_{i}"),
            f"halved_{i} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CAST({x} <= value AS INT) AS node FROM rooted_{i} r CROSS JOIN top_{i})",
            *variance_split(f"halved_{i}", f"low_{i}"),
            f"leafed_{i} AS MATERIALIZED (SELECT h.*, 2 * node + CAST({x} <= value AS INT) AS leaf FROM halved_{i} h JOIN low_{i} USING (node))",
            f"leaves_{i} AS MATERIALIZED (SELECT leaf, avg(t) AS p FROM leafed_{i} WHERE fold <> 0 GROUP BY leaf)",
            f"margins_{i} AS MATERIALIZED (SELECT m.* EXCLUDE (t, node, leaf, p),"
            f" {'p' if i == 1 else f'f{i - 1} + {step}*p'} AS f{i} FROM (SELECT * FROM leafed_{i} JOIN leaves_{i} USING (leaf)) m)",
        ]
        known.append(f"f{i}")
    return [*ctes, f"boosted AS (SELECT label, fold, y, {', '.join(known)} FROM margins_{rounds})"]


def small_boosting_sql(rounds=3, step="3e-1"):
    parts = [f"SELECT {i} AS rounds, label, 1e0/(1e0 + exp(-2e0*f{i})) AS score FROM boosted WHERE fold = 0" for i in range(1, rounds + 1)]
    return with_base(
        "SELECT CAST(rounds AS INT) AS rounds, round(score, 6) AS probability, count(*) AS n_rows,"
        f" CAST(sum(label) AS BIGINT) AS n_positive FROM ({union(parts)}) GROUP BY 1, 2", *boosting_ctes(rounds, step))


def round_losses_sql(rounds=3, step="3e-1"):
    parts = [
        f"SELECT CASE WHEN fold = 0 THEN 'test' ELSE 'train' END AS side, CAST({i} AS INT) AS round,"
        f" round(avg(2e0*ln(1e0 + exp(-2e0*y*f{i}))), 6) AS loss FROM boosted GROUP BY 1"
        for i in range(1, rounds + 1)
    ]
    return with_base(f"SELECT * FROM ({union(parts)})", *boosting_ctes(rounds, step))


def tree_search_sql(family, candidates, folds=5):
    return with_base(
        f"SELECT '{family}' AS family, count(*) AS n_train, CAST({candidates} AS BIGINT) AS n_candidates,"
        f" CAST({candidates * folds} AS BIGINT) AS n_scores, true AS scores_plausible, true AS best_is_highest"
        " FROM base WHERE fold <> 0"
    )


def quota_ctes(source, size, name=""):
    return [
        f"{name}wanted AS (SELECT label, count(*) AS n, (SELECT count(*) FROM {source}) AS total,"
        f" {size} AS size FROM {source} GROUP BY label)",
        f"{name}floors AS (SELECT *, size * n // total AS low,"
        f" row_number() OVER (ORDER BY (size * n) % total DESC, label) AS turn FROM {name}wanted)",
        f"{name}quotas AS (SELECT label, low + CASE WHEN turn <= size - (SELECT sum(low) FROM {name}floors)"
        f" THEN 1 ELSE 0 END AS quota FROM {name}floors)",
    ]


def leaderboard_lr_sql():
    parts = []
    ctes = []
    for profile in ("native", "exact"):
        reg = f"1e0/{N_TRAIN}" if profile == "exact" else "0e0"
        z = f"z_{profile}"
        ctes += [
            scaled_cte(profile, z),
            f"rows_{profile} AS (SELECT 0 AS model, y, {XS} FROM {z} WHERE fold <> 0)",
            f"regs_{profile} AS (SELECT 0 AS model, {penalties(reg)})",
            *newton_ctes(f"rows_{profile}", f"regs_{profile}", f"fit_{profile}"),
        ]
        parts.append(
            f"SELECT '{profile}' AS framework, label, {PROBABILITY} AS score FROM {z} CROSS JOIN fit_{profile}"
            f" WHERE {z}.fold = 0"
        )
    return with_base(
        """SELECT framework, 'Logistic Regression' AS model, round(round(accuracy, 5), 4) AS accuracy,
 round(round(auc, 5), 4) AS roc_auc FROM aucs JOIN (
 SELECT framework, avg(CASE WHEN (score > 5e-1) = (label = 1) THEN 1e0 ELSE 0e0 END) AS accuracy
 FROM both_scores GROUP BY framework) USING (framework)""",
        *ctes, f"both_scores AS ({union(parts)})", *auc_ctes("both_scores", "framework"),
    )


MODEL_SQL = {
    "fit_lr": with_base(f"SELECT *, true AS gradient_vanishes FROM ({TERMS})", *single_fit("native")),
    "fit_lr_exact": with_base(f"SELECT *, true AS gradient_vanishes FROM ({TERMS})", *single_fit("exact")),
    "predict_batch": with_base(
        "SELECT label, CASE WHEN score > 5e-1 THEN 1e0 ELSE 0e0 END AS prediction, count(*) AS n_rows"
        " FROM test_scores GROUP BY 1, 2", *single_fit("native"), TEST_SCORES),
    "predict_proba": with_base(
        "SELECT label, count(*) AS n_rows, round(avg(score), 4) AS mean_score,"
        " round(stddev_samp(score), 4) AS std_score FROM test_scores GROUP BY 1",
        *single_fit("native"), TEST_SCORES),
    "fit_rf": ensemble_sql(("rf", "native", 20)),
    "fit_gbt": ensemble_sql(("gbt", "native", 20)),
    "fit_rf_exact": ensemble_sql(("rf", "exact", 100)),
    "fit_gbt_exact": ensemble_sql(("gbt", "exact", 0)),
    "fit_benchmark_profile": ensemble_sql(
        ("lr", "benchmark", None), ("rf", "benchmark", 100), ("gbt", "benchmark", 100)),
    "cv_results": cv_sql("native", GRID_C, 5, folded=key_folds(5), with_max_iter=True),
    "cv_fold_results": with_base(
        "SELECT CAST(model // 100 AS INT) AS candidate, CAST(model % 100 AS INT) AS fold, round(auc, 4) AS auc, true AS fit_timed,"
        f" rank FROM aucs JOIN (SELECT candidate, {RANK} AS rank FROM cv) ON candidate = CAST(model // 100 AS INT)",
        scaled_cte("native"), *cross_validation("native", GRID_C, 5, key_folds(5))),
    "fit_tree": tree_sql(),
    "fit_gbt_small": small_boosting_sql(),
    "gbt_rounds": round_losses_sql(),
    "grid_search_lr": grid_search_sql(),
    "grid_search_stratified": cv_sql(
        "exact", GRID_C, 5, folded=stratified_folds("z", 5, "WHERE fold <> 0"), with_max_iter=True),
    "grid_search_rf": tree_search_sql("rf", 4),
    "grid_search_gbt": tree_search_sql("gbt", 8),
    "search_lr": cv_sql("native", SEARCH_C, 5, folded=key_folds(5), with_max_iter=False, refit_rows="folded"),
    "search_rf": tree_search_sql("rf", 10),
    "search_gbt": tree_search_sql("gbt", 10),
    "search_subsampled": cv_sql(
        "exact", SEARCH_C, 3, TRAIN_STRATA, *quota_ctes("strata", "(SELECT count(*) // 2 FROM strata)"),
        *quota_ctes("strata", "(SELECT count(*) * 3 // 4 FROM strata)", "refit_"),
        "sampled AS (SELECT strata.* EXCLUDE (fold), quota FROM strata JOIN quotas USING (label) WHERE rank0 < quota)",
        "refitted AS (SELECT strata.* FROM strata JOIN refit_quotas USING (label) WHERE rank0 < quota)",
        folded=f"folded AS MATERIALIZED (SELECT label, y, {XS}, CAST(ntile(3) OVER (PARTITION BY label ORDER BY rank0) - 1 AS INT)"
        " AS fold FROM sampled)", with_max_iter=False, refit_rows="refitted"),
    "leaderboard_lr": leaderboard_lr_sql(),
    "leaderboard": f"""SELECT framework, model, accuracy, roc_auc, true AS plausible FROM ({leaderboard_lr_sql()})
 UNION ALL SELECT framework, model, NULL, NULL, true FROM (VALUES ('native'), ('exact')) AS f(framework),
 (VALUES ('Random Forest'), ('Gradient Boosted Trees')) AS m(model)""",
    "training_summary": with_base(union([
        f"""SELECT 'native' AS framework, '{name}' AS model, CAST({n} AS INT) AS n_params, true AS score_plausible,
 true AS times_add_up, count(*) AS n_train FROM base WHERE fold <> 0"""
        for name, n in (("Logistic Regression", 2), ("Random Forest", 2), ("Gradient Boosted Trees", 3))
    ])),
    "model_roundtrip": with_base(union([
        f"SELECT '{family}' AS family, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM base WHERE fold = 0"
        for family in ("lr", "rf", "gbt")
    ])),
    "timing_row": with_base(
        "SELECT 'native' AS framework, 'Logistic Regression' AS model, count(*) FILTER (fold <> 0) AS n_train,"
        " count(*) FILTER (fold = 0) AS n_test, true AS train_timed, true AS predict_timed, true AS cores_known FROM base"),
}
