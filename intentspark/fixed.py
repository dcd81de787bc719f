"""Results depend on these being exactly as stated."""

# --- fixed values: profile columns and their roles -------------------------------------------
PROFILE_COLUMNS = (
    "Age",
    "Gender",
    "AnnualIncome",
    "NumberOfPurchases",
    "ProductCategory",
    "TimeSpentOnWebsite",
    "LoyaltyProgram",
    "DiscountsAvailed",
    "PurchaseStatus",
)
CATEGORICAL = ("Gender", "ProductCategory", "LoyaltyProgram")
SAFE_NUMERIC = ("Age", "AnnualIncome", "NumberOfPurchases", "TimeSpentOnWebsite")
LEAKY = ("DiscountsAvailed",)
NUMERIC = ("Age", "AnnualIncome", "NumberOfPurchases", "TimeSpentOnWebsite", "DiscountsAvailed")
INTEGER_LIKE = (
    "Age",
    "Gender",
    "NumberOfPurchases",
    "ProductCategory",
    "LoyaltyProgram",
    "DiscountsAvailed",
    "PurchaseStatus",
)
TARGET = "PurchaseStatus"
ENGINEERED_NUMERIC = (
    "income_per_purchase_proxy",
    "loyalty_time_interaction",
    "high_time_low_history_flag",
    "non_loyal_high_time_flag",
)
ENGINEERED_CATEGORICAL = (
    "income_bucket",
    "purchase_frequency_bucket",
    "time_spent_bucket",
    "category_income_interaction",
)

# --- fixed values: plausible ranges (None = open) ---------------------------------------------
PLAUSIBLE_RANGE = {
    "Age": (0, 120),
    "AnnualIncome": (0, None),
    "NumberOfPurchases": (0, None),
    "TimeSpentOnWebsite": (0, None),
    "DiscountsAvailed": (0, None),
}

# --- fixed values: availability and leakage risk of each column -------------------------------
LEAKAGE_MATRIX = (
    ("Age", "pre_session", "low"),
    ("Gender", "pre_session", "low"),
    ("AnnualIncome", "pre_session", "low"),
    ("NumberOfPurchases", "pre_session", "low"),
    ("ProductCategory", "session_context", "medium"),
    ("TimeSpentOnWebsite", "session_end_proxy", "medium"),
    ("LoyaltyProgram", "pre_session", "medium"),
    ("DiscountsAvailed", "post_intervention_or_leaky", "high"),
    ("PurchaseStatus", "target", "high"),
)

# --- fixed values: business bands (right-closed, lowest edge included) -------------------------
AGE_BANDS = (("18_29", 17.0, 29.0), ("30_44", 29.0, 44.0), ("45_plus", 44.0, 70.0))
INCOME_BANDS = (("income_low", 0.0, 50000.0), ("income_mid", 50000.0, 90000.0), ("income_high", 90000.0, None))

# --- fixed values: class-imbalance severity cut-offs ------------------------------------------
MILD_RATIO = 0.75
MODERATE_RATIO = 0.5

# --- fixed values: splits ---------------------------------------------------------------------
SEED = 42
TEST_SIZE = 0.2
VALIDATION_SIZE = 0.2
CV_FOLDS = 4
CALIBRATION_FOLDS = 3

# --- fixed values: rule baseline weights ------------------------------------------------------
RULE_LOYALTY_WEIGHT = 0.45
RULE_PURCHASE_WEIGHT = 0.35
RULE_TIME_WEIGHT = 0.20
RULE_LABEL_CUT = 0.5

# --- fixed values: threshold search and decision bands ----------------------------------------
SWEEP_START = 0.2
SWEEP_STOP = 0.8
SWEEP_POINTS = 31
SWEEP_MIN_PRECISION = 0.55
BAND_HALF_WIDTH = 0.15
BAND_LOW_FLOOR = 0.2
BAND_HIGH_CEILING = 0.85
BAND_FALLBACK_WIDTH = 0.1
BAND_FALLBACK_LOW = 0.1
BAND_FALLBACK_HIGH = 0.9
CALIBRATION_BINS = 8
DEFAULT_BANDS = {"low": 0.2, "binary": 0.3, "high": 0.45}

# --- fixed values: model families -------------------------------------------------------------
FAMILY_COMPLEXITY = {"random_forest": 0, "hist_gradient_boosting": 1, "gradient_boosting": 2}
FOREST_GRID = (
    {"trees": 240, "depth": 8, "leaf": 4, "features": "sqrt"},
    {"trees": 320, "depth": 10, "leaf": 6, "features": "sqrt"},
    {"trees": 280, "depth": None, "leaf": 8, "features": "0.8"},
)
BOOSTING_GRID = (
    {"rounds": 140, "rate": 0.05, "depth": 2, "leaf": 12, "subsample": 0.9},
    {"rounds": 180, "rate": 0.05, "depth": 3, "leaf": 8, "subsample": 0.85},
    {"rounds": 120, "rate": 0.08, "depth": 2, "leaf": 10, "subsample": 0.9},
)
HIST_BOOSTING_GRID = (
    {"rounds": 160, "rate": 0.05, "depth": 6, "leaf": 20},
    {"rounds": 220, "rate": 0.05, "depth": 8, "leaf": 15},
    {"rounds": 180, "rate": 0.08, "depth": 6, "leaf": 10},
)

# --- fixed values: fairness -------------------------------------------------------------------
MIN_SEGMENT_ROWS = 20
FAIRNESS_GAP = 0.12

# --- fixed values: explanation sizes ---------------------------------------------------
BACKGROUND_ROWS = 20
PERMUTATION_REPEATS = 8
LOCAL_TOP_K = 4

# --- fixed values: offer policy ---------------------------------------------------------------
REFERENCE_ORDER_VALUE = 100.0
REFERENCE_MARGIN_RATE = 0.35
PROBABILITY_CEILING = 0.99
REVIEW_MARGIN = {"low": 0.03, "binary": 0.03, "high": 0.06}
LOYALTY_GAP_ALERT = 0.12
DISCOUNT_CAP_HISTORY = 4.0
DISCOUNT_DOWNGRADE_HISTORY = 3.0
BAND_ACTIONS = (
    ("low_intent_holdout", "holdout_low_cost_nurture"),
    ("lower_targeting_band", "targeted_standard_discount"),
    ("upper_targeting_band", "targeted_light_discount"),
    ("high_confidence_no_discount", "protect_margin_no_discount"),
)
# action, discount rate, expected uplift, contact cost, channel, target bands
ACTION_CATALOG = (
    ("holdout_low_cost_nurture", 0.0, 0.01, 0.1, "email_or_push", ("low_intent_holdout",)),
    ("targeted_standard_discount", 0.1, 0.15, 0.5, "email_plus_web_banner", ("lower_targeting_band",)),
    ("targeted_light_discount", 0.05, 0.08, 0.4, "onsite_or_email", ("upper_targeting_band",)),
    ("protect_margin_no_discount", 0.0, 0.0, 0.0, "none", ("high_confidence_no_discount",)),
    (
        "manual_review_discount_cap",
        0.05,
        0.05,
        0.6,
        "manual_queue",
        ("lower_targeting_band", "upper_targeting_band", "high_confidence_no_discount"),
    ),
)
GUARDRAILS = (
    ("discount_history_cap", "high", "active"),
    ("threshold_boundary_review", "medium", "active"),
    ("margin_protection_high_confidence", "medium", "active"),
)

# --- fixed values: hand-set scorecard ---------------------------------------------------------
SCORECARD_RANGE = {
    "Age": (18.0, 70.0),
    "AnnualIncome": (20000.0, 150000.0),
    "NumberOfPurchases": (0.0, 20.0),
    "TimeSpentOnWebsite": (1.0, 60.0),
}
SCORECARD_INTERCEPT = -2.45
SCORECARD_LOYALTY = 1.55
SCORECARD_TIME = 1.1
SCORECARD_PURCHASES = 1.05
SCORECARD_INCOME = 0.55
SCORECARD_AGE = 0.45
SCORECARD_GENDER = 0.01
SCORECARD_CATEGORY = {0: -0.05, 1: 0.03, 2: 0.01, 3: 0.05, 4: 0.0}
SCORECARD_CLAMP = (0.015, 0.985)
SCORECARD_HIGH_TIME = 0.72
SCORECARD_YOUNG = 0.8
SCORECARD_LOW_HISTORY = 0.2
SCORECARD_HIGH_HISTORY = 0.7
SCORECARD_YOUNG_ATTENTION_BUMP = 0.9
SCORECARD_NEW_ATTENTION_BUMP = 0.14
SCORECARD_LOYAL_BUYER_BUMP = 0.22
SCORECARD_REVIEW_DISTANCE = 0.025
SCORECARD_FREE_SCORE = 75
SCORECARD_LIST_PRICE = 89999

# --- fixed values: widening steps of learned float rules --------------------------------------
RULE_STEPS = {"AnnualIncome": 1000.0, "TimeSpentOnWebsite": 1.0}

# --- fixed values: what-if and alignment tolerances -------------------------------------------
SENSITIVITY_SHARE = 0.05
SENSITIVITY_MIN_TIME_STEP = 1.0
ALIGNMENT_TOLERANCE = 1e-6

# --- fixed values: readiness states, worst last -----------------------------------------------
READINESS_STATES = ("ready", "missing", "revision_needed")
