"""Activity / sleep segment reports.

Inputs use the column names of the daily activity domain (``Id, Date,
TotalSteps, Calories, ...``).  Thresholds are parameters with the reference's
values as defaults.  Every report is one grouped aggregation (partial +
final), so a hot user or day is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.functions.arith import round_half
from sparkfolio.functions.calendar import weekday_name, weekday_ord
from sparkfolio.operators.rows import keep_first

MINUTE_COLS = ["VeryActiveMinutes", "FairlyActiveMinutes", "LightlyActiveMinutes",
               "SedentaryMinutes"]
SLEEP_COLS = ["Id", "Date", "TotalMinutesAsleep", "TotalTimeInBed"]

# Segment labels.
HIGH_ACTIVE, MODERATE_ACTIVE, LOW_ACTIVE = "High Active", "Moderate Active", "Low Active"
ADEQUATE, INADEQUATE = "Adequate Sleep", "Inadequate Sleep"
UNKNOWN = "Unknown"
HIGH_ENG, MODERATE_ENG, LOW_ENG = "High Engagement", "Moderate Engagement", "Low Engagement"
# Long-format minute labels (R2), in report order.
MINUTE_LABELS = [("avg_very_active", "Very Active"), ("avg_fairly_active", "Fairly Active"),
                 ("avg_lightly", "Lightly Active"), ("avg_sedentary", "Sedentary")]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- buckets (P15-P17) ----------------------------------------------------------
def bucket_activity(steps, high: int = 12500, low: int = 5000,
                    null_as_unknown: bool = False) -> Column:
    """P15 (SQL: NULL -> Low, 12499.5 -> Low) / P17 (NULL -> Unknown)."""
    s = _col(steps)
    e = (F.when(s >= high, HIGH_ACTIVE)
         .when(s.between(low, high - 1), MODERATE_ACTIVE)
         .otherwise(LOW_ACTIVE))
    return F.when(s.isNull(), UNKNOWN).otherwise(e) if null_as_unknown else e


def bucket_sleep(minutes, adequate: int = 420, null_as_unknown: bool = False) -> Column:
    m = _col(minutes)
    e = F.when(m >= adequate, ADEQUATE).otherwise(INADEQUATE)
    return F.when(m.isNull(), UNKNOWN).otherwise(e) if null_as_unknown else e


def engagement_level(n_days: Column, high: int = 60, moderate: int = 45) -> Column:
    """CASE over an aggregate (days logged per user)."""
    return (F.when(n_days >= high, HIGH_ENG)
            .when(n_days.between(moderate, high - 1), MODERATE_ENG)
            .otherwise(LOW_ENG))


# ---- daily merge (W3, J2, P7, C7, C8) -----------------------------------------------
def merge_daily_sleep(daily: DataFrame, sleep: DataFrame, daily_order: str | None = None,
                      sleep_order: str | None = None, null_safe: bool = False) -> DataFrame:
    """Keep-first de-dup of both sides on (Id, Date), then a left join.

    The sleep side is projected to its four columns before the join so the
    daily row count is preserved.  ``null_safe`` makes NULL keys match (the
    pandas merge rule); the default is the SQL rule.
    """
    if daily_order:
        daily = keep_first(daily, ["Id", "Date"], daily_order).drop(daily_order)
    s = sleep.select(*SLEEP_COLS + ([sleep_order] if sleep_order else []))
    if sleep_order:
        s = keep_first(s, ["Id", "Date"], sleep_order).drop(sleep_order)
    if null_safe:
        s = s.withColumnRenamed("Id", "_sId").withColumnRenamed("Date", "_sDate")
        cond = daily["Id"].eqNullSafe(s["_sId"]) & daily["Date"].eqNullSafe(s["_sDate"])
        merged = daily.join(s, cond, "left").drop("_sId", "_sDate")
    else:
        merged = daily.join(s, ["Id", "Date"], "left")
    for c in MINUTE_COLS:
        if c not in merged.columns:
            merged = merged.withColumn(c, F.lit(0))
    return merged


def with_derived_metrics(merged: DataFrame, fill_missing: bool = True) -> DataFrame:
    """C7 TotalActiveMinutes (fill 0 then add; ``fill_missing=False`` is the
    SQL/R variant that propagates NULL) and C8 SleepEfficiency."""
    parts = [F.col(c) for c in MINUTE_COLS[:3]]
    if fill_missing:
        parts = [F.coalesce(p, F.lit(0)) for p in parts]
    total = parts[0] + parts[1] + parts[2]
    bed = F.col("TotalTimeInBed")
    eff = F.when(F.coalesce(bed, F.lit(0)) > 0,
                 F.lit(100.0) * F.coalesce(F.col("TotalMinutesAsleep"), F.lit(0)) / bed)
    return merged.withColumn("TotalActiveMinutes", total).withColumn("SleepEfficiency", eff)


# ---- reports (A3-A10) ---------------------------------------------------------------
# O3: the report orderings (aggregate / alias descending, with a tie-break
# key so that the order is total).  Apply with ``order_report`` only where a
# sorted result is needed: sorting is a range shuffle of its own.
REPORT_ORDER = {
    "activity_levels": [("avg_calories", True), ("activity_level", False)],
    "sleep_patterns": [("total_days_in_pattern", True), ("sleep_pattern", False)],
    "engagement": [("engagement_level", False), ("Id", False)],
    "hourly_profile": [("hour_of_day", False)],
    "weekday_profile": [("day_ord", False)],
}


def order_report(df: DataFrame, report: str) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() if desc else F.col(c) for c, desc in REPORT_ORDER[report]])


def activity_levels(merged: DataFrame, high: int = 12500, low: int = 5000) -> DataFrame:
    """A3 (query 2)."""
    return (merged.groupBy(bucket_activity("TotalSteps", high, low).alias("activity_level"))
            .agg(F.count(F.lit(1)).alias("total_days_in_level"),
                 round_half(F.avg("Calories"), 0).alias("avg_calories"),
                 round_half(F.avg("TotalMinutesAsleep"), 0).alias("avg_sleep_minutes")))


def time_allocation(merged: DataFrame) -> DataFrame:
    """A4 (query 3): global averages, one decimal."""
    names = ["avg_very_active", "avg_fairly_active", "avg_lightly_active", "avg_sedentary"]
    return merged.agg(*[round_half(F.avg(c), 1).alias(n) for c, n in zip(MINUTE_COLS, names)])


def sleep_patterns(merged: DataFrame, adequate: int = 420) -> DataFrame:
    """A5 (query 4)."""
    return (merged.groupBy(bucket_sleep("TotalMinutesAsleep", adequate).alias("sleep_pattern"))
            .agg(F.count(F.lit(1)).alias("total_days_in_pattern"),
                 round_half(F.avg("TotalSteps"), 0).alias("avg_steps"),
                 round_half(F.avg("Calories"), 0).alias("avg_calories"),
                 round_half(F.avg("TotalActiveMinutes"), 0).alias("avg_totalActive")))


def engagement(merged: DataFrame, high: int = 60, moderate: int = 45) -> DataFrame:
    """A6 (query 5): per-user engagement label and averages."""
    g = merged.groupBy("Id").agg(
        F.count(F.lit(1)).alias("_n"),
        round_half(F.avg("TotalSteps"), 0).alias("avg_steps"),
        round_half(F.avg("TotalMinutesAsleep"), 0).alias("avg_sleep"))
    return g.select("Id", engagement_level(F.col("_n"), high, moderate).alias("engagement_level"),
                    "avg_steps", "avg_sleep")


def split_activity_hour(df: DataFrame, ts_col: str = "ActivityHour") -> DataFrame:
    """Split an hourly timestamp into (Date, Time) join keys (J3 prerequisite).
    Text values are parsed with the C6 formats ('M/d/yyyy h:mm:ss a', then
    'yyyy-MM-dd HH:mm:ss'); unparseable text gives NULL keys (no join match)."""
    from sparkfolio.functions.coerce import multi_format_timestamp
    ts = F.col(ts_col)
    if isinstance(df.schema[ts_col].dataType, T.StringType):
        ts = multi_format_timestamp(ts)
    return (df.withColumn("Date", F.to_date(ts))
              .withColumn("Time", F.date_format(ts, "HH:mm:ss")))


def hourly_profile(steps: DataFrame, calories: DataFrame, intensities: DataFrame,
                   keys: tuple[str, ...] = ("Id", "Date", "Time"),
                   hour_col: str | None = None) -> DataFrame:
    """J3 + A7 (query 6): three-way inner join, averages per hour of day.

    ``keys`` defaults to the (Id, Date, Time) columns of split hourly files
    (hour read from the 'HH:mm:ss' text).  When the tables were aggregated
    per (Id, Date, Hour), pass those keys and ``hour_col``: the joins then
    reuse the aggregation's hash partitioning (no re-shuffle of any side)."""
    keys = list(keys)
    j = (steps.select(*keys, "StepTotal")
         .join(calories.select(*keys, "Calories"), keys, "inner")
         .join(intensities.select(*keys, "TotalIntensity"), keys, "inner"))
    hour = F.col(hour_col) if hour_col else F.substring("Time", 1, 2).cast("int")
    return (j.groupBy(hour.cast("int").alias("hour_of_day"))
            .agg(round_half(F.avg("StepTotal"), 0).alias("avg_steps"),
                 round_half(F.avg("Calories"), 0).alias("avg_calories"),
                 round_half(F.avg("TotalIntensity"), 2).alias("avg_intensity")))


def hourly_mean(df: DataFrame, ts_col: str, metric: str, out: str,
                is_hour: bool = False) -> DataFrame:
    """Mean of one metric per hour of day, NULLs skipped (unrounded).
    ``ts_col`` is a timestamp, or already the hour when ``is_hour``."""
    h = F.col(ts_col) if is_hour else F.hour(ts_col)
    return df.groupBy(h.cast("int").alias("hour_of_day")).agg(F.avg(metric).alias(out))


def weekday_profile(merged: DataFrame, rounded: bool = True) -> DataFrame:
    """A9 (query 7) with the C10 ordering key ``day_ord`` (Monday = 1)."""
    steps, sleep = F.avg("TotalSteps"), F.avg("TotalMinutesAsleep")
    if rounded:
        steps, sleep = round_half(steps, 0), round_half(sleep, 0)
    return (merged.groupBy(weekday_name("Date").alias("day_of_week"),
                           weekday_ord("Date").alias("day_ord"))
            .agg(steps.alias("avg_steps"), sleep.alias("avg_sleep")))


def log_utilization(log: DataFrame, id_col: str = "Id", approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """A10 (query 8): total rows and distinct users.  Exact by default (a
    two-phase distinct aggregate); ``approx=True`` uses a HyperLogLog++
    sketch (relative error ``rsd``) whose memory does not grow with users."""
    distinct = (F.approx_count_distinct(id_col, rsd) if approx
                else F.count_distinct(id_col))
    return log.agg(F.count(F.lit(1)).alias("total_logs"),
                   distinct.alias("unique_weight_users"))


def minutes_long(merged: DataFrame) -> DataFrame:
    """R2: unrounded minute averages pivoted longer with ordered labels."""
    wide = merged.agg(*[F.avg(c).alias(n) for c, (n, _) in zip(MINUTE_COLS, MINUTE_LABELS)])
    stack = ", ".join(f"'{lab}', {i + 1}, {n}" for i, (n, lab) in enumerate(MINUTE_LABELS))
    return wide.selectExpr(f"stack({len(MINUTE_LABELS)}, {stack}) "
                           "AS (activity_level, level_ord, avg_minutes)")


def daily_merged_from_files(spark, data_dir: str, date_format: str = "M/d/yyyy") -> DataFrame:
    """The daily ETL over reference-format files: S3 glob (``dailyActivity*merged*.csv``,
    else ``dailyActivity_*.csv``; error if none), P6 header normalisation,
    C5 date parsing, W3 keep-first in (file, position) order, S4 optional sleep
    file (``sleepDay_merged.csv`` or ``sleepDay.csv``, else empty), J2 left
    merge on (Id, Date), P7 missing minute columns, C7 and C8."""
    import os
    from sparkfolio.functions.coerce import to_date_safe, to_number
    from sparkfolio.sources.readers import exists, normalise_headers, read_csv_glob
    pos = "_pos"
    daily = read_csv_glob(spark, [os.path.join(data_dir, "dailyActivity*merged*.csv"),
                                  os.path.join(data_dir, "dailyActivity_*.csv")],
                          all_string=True, position_col=pos)
    daily = normalise_headers(daily, {"ActivityDate": "Date"})
    daily = daily.withColumn("Date", to_date_safe("Date", date_format))
    numeric = [c for c in daily.columns if c not in ("Id", "Date", pos)]
    daily = daily.select("Id", "Date", pos, *[to_number(c).alias(c) for c in numeric])
    sleep = None
    for name in ("sleepDay_merged.csv", "sleepDay.csv"):
        path = os.path.join(data_dir, name)
        if exists(spark, path):
            s = normalise_headers(read_csv_glob(spark, [path], all_string=True,
                                                position_col=pos), {"SleepDay": "Date"})
            s = s.withColumn("Date", to_date_safe(F.substring_index("Date", " ", 1), date_format))
            sleep = s.select("Id", "Date", pos, to_number("TotalMinutesAsleep").alias("TotalMinutesAsleep"),
                             to_number("TotalTimeInBed").alias("TotalTimeInBed"))
            break
    if sleep is None:
        sleep = spark.createDataFrame([], "Id string, Date date, _pos bigint, "
                                          "TotalMinutesAsleep double, TotalTimeInBed double")
    merged = merge_daily_sleep(daily, sleep, daily_order=pos, sleep_order=pos)
    return with_derived_metrics(merged)
