"""Fixed values shared by the reports.

These values must equal the ones the monitoring reports and fixtures use,
so they are stated once, plainly, here.
"""

from __future__ import annotations

import datetime as dt

# --- fixed values -----------------------------------------------------------
# Workload and model-path classes recognised in query tags, in match order.
WORKLOAD_CLASSES = ("TRAINING", "INFERENCE", "DATA_PREP")
WORKLOAD_DEFAULT = "UNTAGGED"
PATH_CLASSES = ("NATIVE", "BOOSTED")
PATH_DEFAULT = "OTHER"
# Tag layout: WORKLOAD:<type>|PATH:<path>|SCHEDULED:TRUE
TAG_PAIR_SEP = "|"
TAG_KV_SEP = ":"

# Cost parameters seeded by set-up, and the dashboard's fallbacks.
DOLLARS_PER_CREDIT = "DOLLARS_PER_CREDIT"
MEDIUM_CREDITS_PER_HOUR = "SP_WH_MEDIUM_CREDITS_PER_HOUR"
LARGE_CREDITS_PER_HOUR = "SP_WH_LARGE_CREDITS_PER_HOUR"
SEED_PARAMS = ((DOLLARS_PER_CREDIT, 3.0), (MEDIUM_CREDITS_PER_HOUR, 6.0))
PARAM_DEFAULTS = {DOLLARS_PER_CREDIT: 3.0, MEDIUM_CREDITS_PER_HOUR: 6.0}

# Job scenarios of the cost estimate: (name, hours); both on the medium rate.
JOB_SCENARIOS = (("Training Job (2 hours)", 2.0), ("Daily Forecasting (30 days @ 15 min/day)", 7.5))
# Size ladder used by the scenario comparison: (size, credits/hour, hours).
SIZE_SCENARIOS = (("Small", 2.0, 1.0), ("Medium", 6.0, 1.0), ("Large", 16.0, 1.0))

# Budget thresholds (percent of quota) and the action each one triggers.
BUDGET_THRESHOLDS = ((50, "NOTIFY"), (75, "NOTIFY"), (90, "SUSPEND"), (100, "SUSPEND_IMMEDIATE"))

# Dashboard rules.
SLOW_QUERY_SECONDS = 300
QUEUE_PEAK_HIGH = 2
LOW_UTILISATION_PCT = 30
HISTOGRAM_BINS = 30
PRIORITY_RANK = (("HIGH", 0), ("MEDIUM", 1), ("LOW", 2))

# The step each recommendation asks for, in neutral words.
ACTIONS = {"queued": "raise the warehouse size", "idle": "set auto-suspend to 30 seconds",
           "slow": "read the query plans; add clustering keys or materialised views",
           "untagged": "set the session's query tag before each workload"}

# KPI bands from the monitoring guide.
DAILY_VARIANCE_OK_PCT = 20
DAILY_VARIANCE_ACT_PCT = 30
UNTAGGED_OK_PCT = 5
QUEUE_OK_PCT = 5
QUEUE_ACT_PCT = 20
IDLE_OK_PCT = 15
UTILISATION_BAND = (60, 80)
# Growth (percent) from which a trend of the guide needs action.
TREND_ACT_PCT = {"inference_credits_per_run": 100, "avg_query_seconds": 50}

# Weekly series rules.
ALLOWED_REGIONS = ("Global", "AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
MIN_HISTORY_WEEKS = 10          # a track qualifies with more than this many weeks
MAX_TRAINING_AGE_WEEKS = 52
FIRST_WEEKS_FLAG = 3            # week_since_release <= 3 marks the first four weeks

# Boosted-tree settings of the training procedure.
GBT_PARAMS = {"n_estimators": 300, "max_depth": 7, "learning_rate": 0.03,
              "subsample": 0.8, "colsample_bytree": 0.8, "random_state": 42}
FORECAST_HORIZON = 12
Z_95 = 1.959963984540054
MODEL_FILE = "gbt_global"
# ---------------------------------------------------------------------------

# Parameters that make the time-bounded reports reproducible.
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
AS_OF_DATE = dt.date(2024, 1, 31)
SEED_STAMP = dt.datetime(2024, 1, 1, 0, 0, 0)
WAREHOUSE = "FORECAST_WH"
AUX_WAREHOUSE = "AUX_WH"
MONTHLY_QUOTA = 600.0
BUDGET_NAME = "FORECAST_BUDGET"
