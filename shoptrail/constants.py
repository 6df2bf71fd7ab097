"""They decide the results, so they are stated here once.

Behaviour names, weights, text layouts and default parameters of the jobs.
"""

# Behaviour types and the score each one adds to a user.
ALL_BEHAVIORS = ("pv", "cart", "fav", "buy")
DEEP_BEHAVIORS = ("cart", "fav", "buy")
BEHAVIOR_WEIGHTS = {"pv": 1, "fav": 2, "cart": 3, "buy": 4}

# Text layout of a log line and of a feature line.
LOG_HEADER_PREFIX = "user_id"
LOG_FIELDS = 5
FEATURE_HEADER_PREFIX = "user_id,"
FEATURE_FIELDS = 4
SECONDS_PER_DAY = 86400.0

# Default parameters.
TOP_ITEM_PAIRS = 1000
KMEANS_K = 3
KMEANS_MAX_ITER = 20
KMEANS_TOL = 1.0e-6
KMEANS_SEED = 2026
WALK_ALPHA = 0.85
WALK_MAX_ITER = 20
WALK_TOL = 1.0e-6
TOP_RECOMMENDATIONS = 10

# Node kinds of the user-item graph.
USER, ITEM = "user", "item"
