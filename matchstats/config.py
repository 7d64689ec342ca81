"""Fixed values that must equal the reference behaviour for identical results.

These are stated plainly, in their natural order, in one place.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference for identical results)
# ---------------------------------------------------------------------------

# Tournament tier 1: any of these lower-case substrings, and no "qualif".
TIER1_KEYWORDS = [
    "fifa world cup",
    "uefa european championship",
    "uefa euro",
    "copa america",
    "africa cup of nations",
    "african cup of nations",
    "afc asian cup",
    "concacaf gold cup",
    "ofc nations cup",
]
TIER1_BLOCKER = "qualif"

# Tournament tier 2: any of these lower-case substrings.
TIER2_KEYWORDS = [
    "qualif",
    "qualification",
    "nations league",
    "confederations cup",
    "concacaf championship",
]

# Tier -> sample weight.
TIER_WEIGHTS = {1: 3, 2: 2, 3: 1}

# Knockout detection: lower-case tournament contains any of these.
KNOCKOUT_KEYWORDS = [
    "final",
    "semi-final",
    "quarter-final",
    "round of 16",
    "knockout",
    "elimination",
    "last 16",
    "last 8",
]

# Result labels and their integer encoding (0, 1, 2 in this order).
RESULT_CLASSES = ["home_win", "draw", "away_win"]

# Points per result.
WIN_POINTS = 3
DRAW_POINTS = 1
LOSS_POINTS = 0

# Look-back windows.
FORM_WINDOWS = [5, 10]
MOMENTUM_WINDOW = 5
MIN_H2H_MATCHES = 1
H2H_DEFAULT_PCT = 0.33
H2H_DEFAULT_GOALS = 2.5
NO_HISTORY_REST_DAYS = 365

# Model training.
N_CV_SPLITS = 5
RANDOM_STATE = 42
RANDOMIZED_SEARCH_ITER = 50
LR_MAX_ITER = 1000
LR_TOL = 1e-4
RF_N_ESTIMATORS = 300
RF_MAX_DEPTH = 12
GB_N_ESTIMATORS = 200
GB_LEARNING_RATE = 0.1
GB_MAX_DEPTH = 5
# Random-search spaces, expressed as Spark ML params.  Spark trees have no
# "min samples to split"; the leaf minimum (minInstancesPerNode) is kept and
# an unlimited depth becomes Spark's maximum depth 30.
RF_PARAM_DIST = {
    "numTrees": [100, 200, 300],
    "maxDepth": [6, 9, 12, 30],
    "minInstancesPerNode": [1, 2, 4],
    "featureSubsetStrategy": ["sqrt", "log2"],
}
GB_PARAM_DIST = {
    "maxIter": [100, 200, 300],
    "stepSize": [0.05, 0.1, 0.2],
    "maxDepth": [3, 5, 7],
    "subsamplingRate": [0.7, 0.8, 1.0],
}

# Confidence thresholds for probability formatting.
CONFIDENCE_HIGH = 0.60
CONFIDENCE_MEDIUM = 0.40

# Heuristic predictor.
HOME_BOOST = 1.15
HEURISTIC_DRAW_MASS = 0.25

# Analytics thresholds.
EDA_MIN_MATCHES_FOR_WIN_PCT = 50
EDA_MIN_SHOOTOUTS_FOR_RATE = 3
EDA_TOP_N_TEAMS = 20
EDA_ROLLING_YEARS = 5
LEADERBOARD_MIN_PLAYED = 10
SCORE_MATRIX_MAX = 8
GOALS_HIST_MAX = 15
UPDATER_LOG_WINDOW = 100

# Tournament names of the three tiers used when scoring a fixture.
FIXTURE_TIER_TOURNAMENT = {1: "FIFA World Cup", 2: "FIFA World Cup qualification", 3: "Friendly"}
