"""Fixed values the results depend on."""

# --- fixed values: domains -------------------------------------------------
GENDERS = ("men", "women")
SURFACES = ("hard", "clay", "grass", "carpet")
LEVELS = ("grand_slam", "atp_wta", "challenger", "itf", "qualifying")
LEVELS_WITHOUT_SURFACE_RULE = ("itf", "qualifying")
MAPPED_STATUSES = ("auto_mapped", "manual_mapped")
MAPPING_STATUSES = (
    "auto_mapped", "manual_mapped", "manual_unmapped",
    "manual_invalid_target", "ambiguous", "unmapped",
)
SETTLED = ("win", "loss", "void", "push")
PICKED_HOME = ("home", "first", "first player", "1")
PICKED_AWAY = ("away", "second", "second player", "2")

# --- player key parts: <gender>:<feed>:<id> --------------------------------
HISTORY_FEED = "history"
FIXTURE_FEED, FIXTURE_FEED_LONG = "api", "api_feed"

# --- fixed values: rating --------------------------------------------------
RATING_INITIAL = 1500.0
RATING_K = 32.0
RATING_MIN, RATING_MAX = 700.0, 2800.0
SLAM_PRIOR, TOUR_PRIOR = 8, 12
BLENDS = {"blend_80_20": (0.8, 0.2), "blend_70_30": (0.7, 0.3), "blend_60_40": (0.6, 0.4)}
# minimum surface count -> surface weight of the sample aware model
SAMPLE_AWARE_STEPS = ((5, 0.15), (10, 0.25), (25, 0.35))

# --- fixed values: backtest grids ------------------------------------------
COUNT_THRESHOLDS = (0, 3, 5, 10, 20, 30, 50)
PICK_THRESHOLDS = (0.50, 0.52, 0.55, 0.57, 0.60, 0.62, 0.65, 0.67, 0.70, 0.72, 0.75, 0.80)
EDGE_THRESHOLDS = (-0.02, 0.00, 0.02, 0.04, 0.06, 0.08, 0.10)
MIN_LEVEL_MATCHES, MIN_SURFACE_MATCHES = 10, 5
BUCKET_EDGES = (0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95)

# --- fixed values: odds and decision ---------------------------------------
MIN_QUOTES = 3
MAX_MEDIAN_GAP = 0.12
ODDS_MIN, ODDS_MAX = 1.30, 4.50
EDGE_BET, EDGE_STRONG = 0.04, 0.08
STAKE, STAKE_STRONG = 1.0, 1.25
# level -> model, level weight, surface weight, needs surface,
#          min level matches, min overall matches, min surface matches, min probability
LEVEL_RULES = (
    ("atp_wta", "blend_70_30", 0.70, 0.30, True, 10, None, 5, 0.50),
    ("grand_slam", "blend_70_30", 0.70, 0.30, True, 10, None, 5, 0.50),
    ("challenger", "blend_60_40", 0.60, 0.40, True, 10, None, 5, 0.50),
    ("itf", "level_only", 1.00, 0.00, False, 15, None, 0, 0.50),
    ("qualifying", "qualification_base70_overall30", 1.00, 0.00, False, 10, 20, 0, 0.53),
)
STRICT_QUALIFYING_RULE = (
    "qualifying", "level_only_qualifying_strict", 1.00, 0.00, False, 10, None, 0, 0.53)
QUALIFYING_BASE_WEIGHT, QUALIFYING_OVERALL_WEIGHT = 0.70, 0.30

# --- fixed values: entity resolution ---------------------------------------
AUTO_SCORE_MIN, AUTO_MARGIN_MIN = 0.935, 0.055
EXACT_SCORE_MIN, EXACT_MARGIN_MIN = 0.965, 0.020
INITIAL_SURNAME_SCORE_MIN, AMBIGUOUS_MARGIN = 0.880, 0.035
AMBIGUOUS_SCORE_MIN, KEEP_SCORE_MIN = 0.830, 0.760
FALLBACK_SCORE_MIN, FALLBACK_TOP = 0.78, 20
MAX_MATCH_BONUS, MAX_SCORE, TOP_CANDIDATES = 0.012, 0.999, 10
