"""Thresholds, hour bounds, grids and column lists the results depend on."""

from __future__ import annotations

# Zones and time grid.
ZONE_COUNT = 263
HOUR = "1 hour"

# Column order of the cleaned trip table.
TRIP_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
    "congestion_surcharge", "airport_fee",
]
SILVER_COLUMNS = TRIP_COLUMNS + [
    "_source_file", "_ingested_at", "trip_duration_min", "pickup_year", "pickup_month", "pickup_day",
    "pickup_hour", "pickup_dayofweek", "pickup_date", "_layer", "_processed_at",
]

# Split.
TRAIN_RATIO = 0.70
VAL_RATIO = 0.15

# Hour groups.
HOUR_BUCKETS = {"all": range(0, 24), "00_09": range(0, 10), "10_16": range(10, 17), "17_23": range(17, 24)}
METRIC_BUCKETS = {"night": (0, 8), "midday": (9, 16), "evening": (17, 23)}
CRITICAL_HOURS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 21, 22, 23]
NIGHT_HOURS = [0, 1, 2, 3, 4]
EVENING_HOURS = [17, 18, 19, 20, 21, 22, 23]
LATE_HOURS = [22, 23]
WEEKEND_LATE_HOURS = [21, 22, 23]

# Hour flags: name -> inclusive bounds. Training bounds are the default; the serving set differs
# for three names and is kept for comparison.
HOUR_FLAGS = {
    "is_late_night": (0, 4),
    "is_early_morning": (5, 6),
    "is_morning_peak": (7, 9),
    "is_evening_peak": (16, 19),
    "is_ramp_up_05_08": (5, 8),
    "is_post_midnight": (0, 1),
    "is_late_drop_23": (23, 23),
    "is_transition_up": (5, 8),
    "is_transition_down": (20, 23),
}
SERVING_HOUR_FLAGS = {
    "is_late_night": (0, 4),
    "is_night": (0, 5),
    "is_midnight": (0, 1),
    "is_early_morning": (5, 7),
    "is_ramp_up": (5, 8),
    "is_transition_up": (5, 8),
    "is_morning_peak": (7, 10),
    "is_evening_peak": (16, 19),
    "is_transition_down": (20, 22),
    "is_end_of_day": (22, 23),
    "is_late_evening": (21, 23),
}

# Model input columns.
MAIN_FEATURES = [
    "PULocationID",
    "lag_1h", "lag_2h", "lag_3h", "lag_24h", "lag_168h",
    "rolling_avg_3h", "rolling_avg_6h", "rolling_avg_24h",
    "hour", "day_of_week", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "is_weekend", "is_holiday",
    "is_late_night", "is_early_morning", "is_morning_peak", "is_evening_peak", "is_ramp_up_05_08",
    "is_post_midnight", "is_late_drop_23", "is_transition_up", "is_transition_down",
    "lag_ratio_1h_24h", "lag_ratio_3h_24h", "rolling_ratio_3h_24h", "lag_diff_1h_24h",
    "prev_1h_growth", "prev_2h_growth", "prev_3h_growth", "prev_day_growth_24_168", "ramp_momentum",
    "night_decay_signal",
    "growth_1h", "growth_2h", "growth_3h", "growth_6h", "growth_24h", "growth_168h",
    "acceleration_1h", "acceleration_3h", "ramp_growth_signal", "peak_growth_signal", "night_over_signal",
    "zone_hour_mean", "zone_dow_hour_mean",
]
SPECIALIST_BASE = [
    "PULocationID", "hour", "day_of_week", "month", "is_weekend", "is_holiday",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "lag_1h", "lag_2h", "lag_3h", "lag_24h", "lag_168h",
    "rolling_avg_3h", "rolling_avg_6h", "rolling_avg_24h",
    "zone_hour_mean", "zone_mean", "hour_mean", "baseline_blend",
]
LOW_HOUR_FEATURES = SPECIALIST_BASE + [
    "night_order", "is_00", "is_01", "is_02", "is_03", "is_04", "is_05", "is_06", "is_07", "is_08", "is_09",
    "is_deep_night", "is_pre_ramp", "is_morning_ramp", "is_ramp_low", "ramp_strength", "morning_ramp_strength",
    "lag_ratio_1h_24h", "lag_diff_1h_24h", "rolling_ratio_3h_24h", "momentum_1h_2h", "momentum_1h_3h",
    "baseline_gap_1h", "baseline_gap_24h", "baseline_ratio_1h", "baseline_ratio_24h",
    "pre_ramp_gap", "morning_gap_1h", "ramp_baseline_signal",
]
EVENING_FEATURES = SPECIALIST_BASE + [
    "evening_slot", "is_h17", "is_h18", "is_h19", "is_h20", "is_h21", "is_h22", "is_h23",
    "is_evening_segment_early", "is_evening_segment_late", "evening_decay",
    "lag_ratio_1h_24h", "lag_diff_1h_24h", "rolling_ratio_3h_24h", "momentum_1h_2h", "momentum_1h_3h",
    "baseline_gap_1h", "baseline_gap_24h", "baseline_ratio_1h", "baseline_ratio_24h",
    "evening_baseline_gap", "decline_2h_to_1h", "decline_ratio_2h_to_1h", "late_decline_signal",
]
SEQUENCE_FEATURES = [
    "trip_count", "lag_24h", "lag_168h", "lag_1h", "lag_2h", "rolling_avg_3h", "rolling_avg_24h",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "is_weekend", "is_holiday",
]
FEATURES = {
    "main": MAIN_FEATURES,
    "low_hour": LOW_HOUR_FEATURES,
    "evening": EVENING_FEATURES,
    "sequence": SEQUENCE_FEATURES,
}

# Other names some model inputs use for the same columns.
SERVING_ALIASES = {
    "rolling_mean_3h": "rolling_avg_3h",
    "rolling_mean_6h": "rolling_avg_6h",
    "rolling_mean_24h": "rolling_avg_24h",
    "is_am_peak": "is_morning_peak",
    "is_pm_peak": "is_evening_peak",
    "lag_1h_diff_24h": "lag_diff_1h_24h",
    "zone_hour_baseline": "zone_hour_mean",
    "zone_dow_hour_baseline": "zone_dow_hour_mean",
}

# Quality thresholds.
LIMITS = {
    "null_pct": 5.0,
    "spike_ratio": 10.0,
    "zero_pct": 30.0,
    "peak_pct_fail": 3.0,
    "peak_pct_warn": 10.0,
    "corr_fail": 0.85,
    "corr_warn": 0.70,
    "ceiling_tolerance": 0.05,
    "peak_share_pct": 5.0,
    "valid_sequence_pct": 50.0,
    "r2": 0.90,
    "peak_mape_warn": 20.0,
    "peak_mape_fail": 35.0,
    "rmse_mae": 5.0,
    "context_coverage": 0.85,
}
QUALITY_FEATURES = [
    "lag_1h", "lag_2h", "lag_3h", "lag_24h", "lag_168h",
    "rolling_avg_3h", "rolling_avg_6h", "rolling_avg_24h",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "is_weekend", "is_holiday",
]
OPTIONAL_QUALITY_FEATURES = ["lag_3h", "lag_168h", "rolling_avg_6h", "rolling_avg_24h", "is_holiday"]

# Post-processing parameters of the zero-inflated model: defaults and search lists.
ZERO_INFLATED_DEFAULTS = {
    "threshold_deep": 0.22, "threshold_ramp": 0.10, "threshold_morning": 0.10,
    "ramp_blend_alpha": 0.0, "morning_blend_alpha": 0.0,
    "cap_mult_deep": 3.0, "cap_bias_deep": 2.0,
    "cap_mult_ramp": 3.0, "cap_bias_ramp": 4.0,
    "cap_mult_morning": 4.5, "cap_bias_morning": 5.0,
    "min_floor": 0.0,
}
ZERO_INFLATED_SEARCH = {
    "deep": {
        "threshold": [0.18, 0.22, 0.26, 0.30, 0.34],
        "blend": [0.0],
        "cap": [(999.0, 0.0), (3.5, 2.0)],
    },
    "ramp": {
        "threshold": [0.08, 0.11, 0.14, 0.17, 0.20],
        "blend": [0.0, 0.08, 0.14, 0.20],
        "cap": [(999.0, 0.0), (4.0, 3.0), (4.5, 4.0)],
    },
    "morning": {
        "threshold": [0.06, 0.09, 0.12, 0.15, 0.18],
        "blend": [0.0, 0.10, 0.18, 0.26, 0.34],
        "cap": [(999.0, 0.0), (5.0, 5.0), (5.5, 6.0), (4.0, 4.0)],
    },
}

# Evening post-processing.
EVENING_POST = {
    "blend_alpha_late": 0.10,
    "cap_mult_evening": 5.0, "cap_bias_evening": 6.0,
    "cap_mult_late": 4.0, "cap_bias_late": 6.0,
}
