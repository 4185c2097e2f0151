"""Feature parameters of the two feature stacks.

Fixed values (must stay as they are for the features to mean the same):
"""

# Interaction weights used for weighted history scores.
SITE_WEIGHTS = {"total_click": 0.204, "total_fav": 0.066, "total_cart": 0.254, "total_order": 0.476}
SEARCH_WEIGHTS = {"total_search_impression": 0.1, "total_search_click": 0.9}
SEARCH_WEIGHTS_CLICK_FIRST = {"total_search_click": 0.9, "total_search_impression": 0.1}

# Fixed values: (from, to) pairs of the average ratios of cumulative histories.
SITE_RATIO_GROUPS = [("total_click", "total_order"), ("total_click", "total_cart"),
                     ("total_click", "total_fav"), ("total_cart", "total_order")]
SEARCH_RATIO_GROUPS = [("total_search_impression", "total_search_click")]

# Ratio pairs and aggregates of the time-rolling histories.
ROLLING_SITE_RATIOS = [("total_click", "total_order"), ("total_cart", "total_order"), ("total_fav", "total_order"),
                       ("total_click", "total_cart"), ("total_click", "total_fav")]
ROLLING_SEARCH_RATIOS = [("total_search_impression", "total_search_click")]
ROLLING_AGGS = ["mean", "std", "min", "max", "sum"]
ROLLING_RATIO_AGGS = ["mean", "std", "sum"]

# Ranking-target weights of the two stacks.
TARGET_WEIGHTS_A = {"clicked": 2.2, "added_to_fav": 0.1, "added_to_cart": 8.0, "ordered": 9.0}
TARGET_WEIGHTS_B = {"ordered": 9.0, "clicked": 0.5, "added_to_cart": 8.0, "added_to_fav": 1.8}

# Session ranking of item histories.
SESSION_TABLE_WEIGHTS = {"content_top_terms": 0.3, "content_sitewide": 0.6, "content_search": 0.1}
SESSION_COL_WEIGHTS = {"total_order": 0.476, "total_click": 0.204, "total_cart": 0.254, "total_fav": 0.066,
                       "total_search_impression": 0.1, "total_search_click": 0.9}

# Catalogue smoothing.
BAYES_M = 30
PSEUDO_ALPHA = 1
PSEUDO_BETA = 1
WILSON_Z = 1.96

# Decay and sampling.
DECAY_HALF_LIFE_STEPS = 3
DECAY_WINDOWS = [3, 12]
NEGATIVE_LIMIT = 1000
BLEND_WEIGHTS = (0.5, 0.5)

# Columns that are no features of the first stack, and features left out for their high correlation with others.
DROP_COLUMNS = ["ordered", "clicked", "ts_hour", "date", "content_creation_date", "added_to_cart", "added_to_fav", "session_id",
                "content_id_hashed", "user_id_hashed", "cv_tags", "search_term_normalized", "target"]
CORRELATED_COLUMNS = ["user_birth_year", "session_avg_rate_count", "session_std_rate_count", "session_min_rate_count", "session_max_rate_count",
                      "content_review_count_rank", "content_review_count_diff_percent", "content_review_wth_media_count_diff_percent",
                      "user_l1_cat_clicks", "user_l1_cat_orders", "search_ctr_24h_user_top_terms_log", "search_ctr_72h_user_top_terms_log",
                      "user_leaf_cat_conversion_rate", "search_ctr_7d_content_search_log", "selling_price", "discounted_price", "content_rate_count"]

# Categorical features, and what stands for a missing one.
CATEGORICAL = ["user_gender", "level1_category_name", "level2_category_name", "leaf_category_name"]
MISSING_CATEGORY = "UNKNOWN"
