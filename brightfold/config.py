"""Column names, grids and search spaces of the collider-event classification task."""

# Column names and their order in the headerless files.
LABEL = "label"
LOW_LEVEL = [
    "lepton_pT", "lepton_eta", "lepton_phi",
    "missing_energy_magnitude", "missing_energy_phi",
    "jet1_pt", "jet1_eta", "jet1_phi", "jet1_b_tag",
    "jet2_pt", "jet2_eta", "jet2_phi", "jet2_b_tag",
    "jet3_pt", "jet3_eta", "jet3_phi", "jet3_b_tag",
    "jet4_pt", "jet4_eta", "jet4_phi", "jet4_b_tag",
]
HIGH_LEVEL = ["m_jj", "m_jjj", "m_lv", "m_jlv", "m_bb", "m_wbb", "m_wwbb"]

FEATURE_GROUPS = {"low_level": LOW_LEVEL, "high_level": HIGH_LEVEL}
FEATURES = LOW_LEVEL + HIGH_LEVEL

# Cross-validation, tuning and benchmark settings.
FOLDS = 5
SEED = 42
DISPLAY_NAMES = {
    "lr": "Logistic Regression",
    "rf": "Random Forest",
    "gbt": "Gradient Boosted Trees",
}
PARAM_GRIDS = {
    "lr": {"C": [0.01, 0.1, 1.0, 10.0], "max_iter": [200]},
    "rf": {"n_estimators": [50, 100], "max_depth": [8, 12]},
    "gbt": {"max_iter": [100, 200], "max_depth": [3, 5], "learning_rate": [0.05, 0.1]},
}
SEARCH_SPACES = {
    "lr": {"C": ("log_float", 1e-3, 100.0)},
    "rf": {"n_estimators": ("int", 50, 150), "max_depth": ("int", 5, 15)},
    "gbt": {
        "max_iter": ("int", 50, 200),
        "max_depth": ("int", 2, 8),
        "learning_rate": ("log_float", 0.01, 0.3),
    },
}
TRIALS = 10
TIME_BUDGET_S = 60.0
SEARCH_ROWS = 100_000
REFIT_ROWS = 500_000
SEARCH_FOLDS = 3

FAMILIES = ("lr", "rf", "gbt")
PROFILES = ("native", "exact")
