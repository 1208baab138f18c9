"""Labelling expressions of the dashboard rollups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (thresholds and labels of the source dashboard)
# ---------------------------------------------------------------------------
HOT, WARM, COLD, COLD_DETAIL = 24.0, 18.0, 8.0, 10.0
THERMAL_LABELS = ("hot", "warm", "cold", "mild")
ERROR_EXCELLENT, ERROR_GOOD = 0.05, 0.5
ERROR_LABELS = ("excellent", "good", "needs_work")
LABEL_FUTURE = "Historical Archive"
LABEL_TODAY = "Live Sensor Data"
LABEL_PAST = "Verified Actual Temp"
LABEL_PENDING = "Retraining Pending"
LABEL_ARCHIVED = "Archived Baseline"
LABEL_AWAITING = "Awaiting Time"
ARCHIVE_CUTOFF = "2020-01-01"
PENDING_DAYS = 10
HEALTH_ACTIVE = "Active Autonomous Retraining"
HEALTH_BASELINE = "Baseline Validation Complete"
ACTIVE_YEARS = ("2025", "2026")
MIN_REQUEST_YEAR = 2001
MAX_REQUEST_AHEAD_DAYS = 365
MODEL_TREE, MODEL_NETWORK = "XGBoost", "Neural Network"
# ---------------------------------------------------------------------------


def thermal_band(daily_max: Column, cold: float = COLD) -> Column:
    """Band of a daily maximum, tested in this order: >24, >18, <cold, else."""
    hot, warm, cold_l, mild = THERMAL_LABELS
    return (F.when(daily_max > HOT, hot).when(daily_max > WARM, warm)
            .when(daily_max < cold, cold_l).otherwise(mild))


def error_band(err: Column) -> Column:
    """Quality band of an absolute error: <0.05, <0.5, else."""
    a, b, c = ERROR_LABELS
    return F.when(err < ERROR_EXCELLENT, a).when(err < ERROR_GOOD, b).otherwise(c)


def actual_label(date: Column, today: Column, actual: Column) -> Column:
    """Label of the actual value of a requested date (P20)."""
    age = F.datediff(today, date)
    present = (F.when(date > today, LABEL_FUTURE).when(date == today, LABEL_TODAY)
               .otherwise(LABEL_PAST))
    missing = (F.when((age > 0) & (age < PENDING_DAYS), LABEL_PENDING)
               .when(date < F.lit(ARCHIVE_CUTOFF).cast("date"), LABEL_ARCHIVED)
               .otherwise(LABEL_AWAITING))
    return F.when(actual.isNull(), missing).otherwise(present)


def health_status(latest_date: Column) -> Column:
    """Drift health from the latest row's date."""
    active = F.lit(False)
    for y in ACTIVE_YEARS:
        active = active | latest_date.contains(y)
    return F.when(active, HEALTH_ACTIVE).otherwise(HEALTH_BASELINE)


def champion(xgb_mae: Column, nn_mae: Column) -> Column:
    """Lower MAE wins; a tie or a missing network MAE keeps the tree model."""
    return F.when(nn_mae.isNotNull() & (nn_mae < xgb_mae), MODEL_NETWORK).otherwise(MODEL_TREE)


def valid_request(date: Column, today: Column) -> Column:
    """Request date in [2001-01-01, today + 365 days]."""
    return (F.year(date) >= MIN_REQUEST_YEAR) & (date <= F.date_add(today, MAX_REQUEST_AHEAD_DAYS))
