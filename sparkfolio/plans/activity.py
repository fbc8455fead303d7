"""Activity segment on the ``events`` table (S3/S4 stand-ins, W3, J2, J3,
C5-C10, P15-P18, A3-A10, A14-A18, R2).

Stand-in mapping (every number derives from ``events``; integer-valued so
that aggregates are exact in any engine):

* daily activity = events per (user_id, day):
  ``TotalSteps = round(sum(value) * 100)``, ``TotalDistance = steps / 1300``,
  ``Calories = 1400 + 60 n + floor(steps / 25)``, Very/Fairly/Lightly active
  minutes = 10/5/3 per purchase/click/view event, ``SedentaryMinutes = 1440 - 20 n``;
* sleep log = one row per purchase event (several per day: keep-first by
  event_id), ``k = round(value * 100)``, asleep ``240 + k % 300``, in bed
  ``asleep + 15 + k % 45``; days without a purchase have no sleep row;
* hourly steps / calories / intensities = events per (user, hour) over all /
  non-error / non-signup events; weight log = signup events.

The data covers 30 days, so the engagement cut-offs are the 30-day
equivalents (27 / 25 days) of the 60 / 45 defaults.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkfolio.functions.arith import round_sql
from sparkfolio.operators import profile, segments
from sparkfolio.plans.registry import query
from sparkfolio.plans.stages import stage
from sparkfolio.sources.tables import load

ENGAGEMENT = (27, 25)
STEP_BUCKETS = (12500, 5000)
SLEEP_ADEQUATE = 420


def _events(spark, sf):
    return load(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


def daily_activity(spark, sf):
    ev = _events(spark, sf)
    cnt = lambda t, k: F.sum(F.when(F.col("event_type") == t, k).otherwise(0)).cast("bigint")
    d = ev.groupBy(F.col("user_id").alias("Id"), F.to_date("ts").alias("Date")).agg(
        F.round(F.sum("value") * F.lit(100.0)).cast("bigint").alias("TotalSteps"),
        F.count(F.lit(1)).alias("_n"),
        cnt("purchase", 10).alias("VeryActiveMinutes"),
        cnt("click", 5).alias("FairlyActiveMinutes"),
        cnt("view", 3).alias("LightlyActiveMinutes"))
    steps = F.col("TotalSteps").cast("double")
    return d.select(
        "Id", "Date", "TotalSteps", (steps / F.lit(1300.0)).alias("TotalDistance"),
        (F.lit(1400) + F.lit(60) * F.col("_n") + F.floor(steps / F.lit(25.0))).cast("bigint")
        .alias("Calories"),
        "VeryActiveMinutes", "FairlyActiveMinutes", "LightlyActiveMinutes",
        (F.lit(1440) - F.lit(20) * F.col("_n")).alias("SedentaryMinutes"))


def sleep_log(spark, sf):
    ev = _events(spark, sf).where(F.col("event_type") == "purchase")
    k = F.round(F.col("value") * F.lit(100.0)).cast("bigint")
    asleep = F.lit(240) + k % 300
    return ev.select(F.col("user_id").alias("Id"), F.to_date("ts").alias("Date"), "event_id",
                     asleep.alias("TotalMinutesAsleep"),
                     (asleep + F.lit(15) + k % 45).alias("TotalTimeInBed"))


def build_merged_daily(spark, sf):
    m = segments.merge_daily_sleep(daily_activity(spark, sf), sleep_log(spark, sf),
                                   sleep_order="event_id")
    return segments.with_derived_metrics(m)


def merged_daily(spark, sf):
    """The merged daily table (CREATE TABLE AS): built once per input
    version, then read by every report."""
    return stage(spark, sf, "daily_merged", ["events"], lambda: build_merged_daily(spark, sf))


def build_hourly(spark, sf):
    """One aggregation of ``events`` per (Id, Date, Hour) carrying all three
    hourly measures and their source-row counts.  The keys come from the
    wall-clock timestamp without any time-zone conversion (``to_date`` and
    ``hour`` of a timestamp_ntz)."""
    ev = _events(spark, sf)
    keys = [F.col("user_id").alias("Id"), F.to_date("ts").alias("Date"),
            F.hour("ts").alias("Hour")]
    n_if = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    return ev.groupBy(*keys).agg(
        F.round(F.sum("value") * F.lit(100.0)).cast("bigint").alias("StepTotal"),
        n_if(F.col("event_type") != "error").alias("n_cal"),
        n_if(F.col("event_type") != "signup").alias("n_int"))


def hourly_tables(spark, sf):
    """Hourly steps / calories / intensities keyed by (Id, Date, Hour), with
    the 'HH:00:00' ``Time`` text of the reference files: three projections of
    one stage table (an hour has a calories / intensities row only when it
    has a source event for it)."""
    h = stage(spark, sf, "hourly", ["events"], lambda: build_hourly(spark, sf))
    h = h.withColumn("Time", F.format_string("%02d:00:00", F.col("Hour")))
    keys = ["Id", "Date", "Hour", "Time"]
    steps = h.select(*keys, "StepTotal")
    cal = h.where(F.col("n_cal") > 0).select(
        *keys, (F.lit(60) + F.lit(7) * F.col("n_cal")).alias("Calories"))
    inten = h.where(F.col("n_int") > 0).select(
        *keys, (F.lit(3) * F.col("n_int")).alias("TotalIntensity"),
        (F.lit(3) * F.col("n_int") / F.lit(60.0)).alias("AverageIntensity"))
    return steps, cal, inten


# ---- oracle SQL building blocks (same stand-in definitions) ------------------------
MERGED_CTE = """
WITH daily0 AS (
  SELECT user_id AS Id, CAST(ts AS DATE) AS Date,
         CAST(ROUND(SUM(value) * 100.0) AS BIGINT) AS TotalSteps,
         COUNT(*) AS n_ev,
         CAST(SUM(CASE WHEN event_type = 'purchase' THEN 10 ELSE 0 END) AS BIGINT) AS VeryActiveMinutes,
         CAST(SUM(CASE WHEN event_type = 'click' THEN 5 ELSE 0 END) AS BIGINT) AS FairlyActiveMinutes,
         CAST(SUM(CASE WHEN event_type = 'view' THEN 3 ELSE 0 END) AS BIGINT) AS LightlyActiveMinutes
  FROM events GROUP BY user_id, CAST(ts AS DATE)),
daily AS (
  SELECT Id, Date, TotalSteps, CAST(TotalSteps AS DOUBLE) / 1300.0 AS TotalDistance,
         CAST(1400 + 60 * n_ev + FLOOR(CAST(TotalSteps AS DOUBLE) / 25.0) AS BIGINT) AS Calories,
         VeryActiveMinutes, FairlyActiveMinutes, LightlyActiveMinutes,
         1440 - 20 * n_ev AS SedentaryMinutes
  FROM daily0),
sleep_raw AS (
  SELECT user_id AS Id, CAST(ts AS DATE) AS Date, event_id,
         240 + CAST(ROUND(value * 100.0) AS BIGINT) % 300 AS TotalMinutesAsleep,
         240 + CAST(ROUND(value * 100.0) AS BIGINT) % 300 + 15
             + CAST(ROUND(value * 100.0) AS BIGINT) % 45 AS TotalTimeInBed
  FROM events WHERE event_type = 'purchase'),
sleep AS (
  SELECT Id, Date, TotalMinutesAsleep, TotalTimeInBed FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY Id, Date ORDER BY event_id) AS rn FROM sleep_raw) t
  WHERE rn = 1),
merged AS (
  SELECT d.Id, d.Date, d.TotalSteps, d.TotalDistance, d.Calories, d.VeryActiveMinutes,
         d.FairlyActiveMinutes, d.LightlyActiveMinutes, d.SedentaryMinutes,
         s.TotalMinutesAsleep, s.TotalTimeInBed,
         COALESCE(d.VeryActiveMinutes, 0) + COALESCE(d.FairlyActiveMinutes, 0)
           + COALESCE(d.LightlyActiveMinutes, 0) AS TotalActiveMinutes,
         CASE WHEN COALESCE(s.TotalTimeInBed, 0) > 0
              THEN CAST(100 AS DOUBLE) * COALESCE(s.TotalMinutesAsleep, 0) / s.TotalTimeInBed END
           AS SleepEfficiency
  FROM daily d LEFT JOIN sleep s ON d.Id = s.Id AND d.Date = s.Date)
"""

HOURLY_CTE = """
WITH ev AS (SELECT user_id AS Id, date_trunc('hour', ts) AS ActivityHour, event_type, value FROM events),
hs AS (SELECT Id, CAST(ActivityHour AS DATE) AS Date, strftime(ActivityHour, '%H:%M:%S') AS Time,
              CAST(ROUND(SUM(value) * 100.0) AS BIGINT) AS StepTotal
       FROM ev GROUP BY Id, ActivityHour),
hc AS (SELECT Id, CAST(ActivityHour AS DATE) AS Date, strftime(ActivityHour, '%H:%M:%S') AS Time,
              60 + 7 * COUNT(*) AS Calories
       FROM ev WHERE event_type <> 'error' GROUP BY Id, ActivityHour),
hi AS (SELECT Id, CAST(ActivityHour AS DATE) AS Date, strftime(ActivityHour, '%H:%M:%S') AS Time,
              3 * COUNT(*) AS TotalIntensity
       FROM ev WHERE event_type <> 'signup' GROUP BY Id, ActivityHour)
"""

_STEP_CASE = f"""CASE WHEN TotalSteps >= {STEP_BUCKETS[0]} THEN 'High Active'
       WHEN TotalSteps BETWEEN {STEP_BUCKETS[1]} AND {STEP_BUCKETS[0] - 1} THEN 'Moderate Active'
       ELSE 'Low Active' END"""
_SLEEP_CASE = f"""CASE WHEN TotalMinutesAsleep >= {SLEEP_ADEQUATE} THEN 'Adequate Sleep'
       ELSE 'Inadequate Sleep' END"""
_STEP_CASE_U = f"CASE WHEN TotalSteps IS NULL THEN 'Unknown' ELSE {_STEP_CASE} END"
_SLEEP_CASE_U = f"CASE WHEN TotalMinutesAsleep IS NULL THEN 'Unknown' ELSE {_SLEEP_CASE} END"


@query("daily_merge", MERGED_CTE + "SELECT * FROM merged")
def daily_merge(spark, sf):
    """W3 keep-first + J2 left join + P7 + C7 + C8 (CREATE TABLE AS body)."""
    return merged_daily(spark, sf)


@query("bucket_activity", MERGED_CTE + f"""
SELECT {_STEP_CASE} AS activity_level, COUNT(*) AS total_days_in_level,
       {round_sql('AVG(Calories)')} AS avg_calories,
       {round_sql('AVG(TotalMinutesAsleep)')} AS avg_sleep_minutes
FROM merged GROUP BY 1""")
def bucket_activity(spark, sf):
    return segments.activity_levels(merged_daily(spark, sf), *STEP_BUCKETS)


@query("time_allocation", MERGED_CTE + f"""
SELECT {round_sql('AVG(VeryActiveMinutes)', 1)} AS avg_very_active,
       {round_sql('AVG(FairlyActiveMinutes)', 1)} AS avg_fairly_active,
       {round_sql('AVG(LightlyActiveMinutes)', 1)} AS avg_lightly_active,
       {round_sql('AVG(SedentaryMinutes)', 1)} AS avg_sedentary
FROM merged""")
def time_allocation(spark, sf):
    return segments.time_allocation(merged_daily(spark, sf))


@query("bucket_sleep", MERGED_CTE + f"""
SELECT {_SLEEP_CASE} AS sleep_pattern, COUNT(*) AS total_days_in_pattern,
       {round_sql('AVG(TotalSteps)')} AS avg_steps,
       {round_sql('AVG(Calories)')} AS avg_calories,
       {round_sql('AVG(TotalActiveMinutes)')} AS avg_totalActive
FROM merged GROUP BY 1""")
def bucket_sleep(spark, sf):
    return segments.sleep_patterns(merged_daily(spark, sf), SLEEP_ADEQUATE)


@query("engagement", MERGED_CTE + f"""
SELECT Id,
       CASE WHEN COUNT(*) >= {ENGAGEMENT[0]} THEN 'High Engagement'
            WHEN COUNT(*) BETWEEN {ENGAGEMENT[1]} AND {ENGAGEMENT[0] - 1} THEN 'Moderate Engagement'
            ELSE 'Low Engagement' END AS engagement_level,
       {round_sql('AVG(TotalSteps)')} AS avg_steps,
       {round_sql('AVG(TotalMinutesAsleep)')} AS avg_sleep
FROM merged GROUP BY Id""")
def engagement(spark, sf):
    return segments.engagement(merged_daily(spark, sf), *ENGAGEMENT)


@query("hourly_profile", HOURLY_CTE + f"""
SELECT CAST(hour(CAST(hs.Time AS TIME)) AS INTEGER) AS hour_of_day,
       {round_sql('AVG(hs.StepTotal)')} AS avg_steps,
       {round_sql('AVG(hc.Calories)')} AS avg_calories,
       {round_sql('AVG(hi.TotalIntensity)', 2)} AS avg_intensity
FROM hs JOIN hc ON hs.Id = hc.Id AND hs.Date = hc.Date AND hs.Time = hc.Time
        JOIN hi ON hs.Id = hi.Id AND hs.Date = hi.Date AND hs.Time = hi.Time
GROUP BY 1""")
def hourly_profile(spark, sf):
    return segments.hourly_profile(*hourly_tables(spark, sf), keys=("Id", "Date", "Hour"),
                                   hour_col="Hour")


@query("hourly_mean", """
SELECT CAST(hour(date_trunc('hour', ts)) AS INTEGER) AS hour_of_day,
       AVG(StepTotal) AS avg_steps
FROM (SELECT user_id, date_trunc('hour', ts) AS ts,
             CAST(ROUND(SUM(value) * 100.0) AS BIGINT) AS StepTotal
      FROM events GROUP BY user_id, date_trunc('hour', ts)) t
GROUP BY 1""")
def hourly_mean(spark, sf):
    steps, _, _ = hourly_tables(spark, sf)
    return segments.hourly_mean(steps, "Hour", "StepTotal", "avg_steps", is_hour=True)


@query("weekday_profile", MERGED_CTE + f"""
SELECT dayname(Date) AS day_of_week, CAST(isodow(Date) AS INTEGER) AS day_ord,
       {round_sql('AVG(TotalSteps)')} AS avg_steps,
       {round_sql('AVG(TotalMinutesAsleep)')} AS avg_sleep
FROM merged GROUP BY 1, 2""")
def weekday_profile(spark, sf):
    return segments.weekday_profile(merged_daily(spark, sf))


@query("distinct_users", """
SELECT COUNT(*) AS total_logs, COUNT(DISTINCT user_id) AS unique_weight_users
FROM events WHERE event_type = 'signup'""")
def distinct_users(spark, sf):
    log = _events(spark, sf).where(F.col("event_type") == "signup")
    return segments.log_utilization(log, "user_id")


@query("avg_minutes_long", MERGED_CTE + """
SELECT * FROM (VALUES ('Very Active', 1), ('Fairly Active', 2), ('Lightly Active', 3),
                      ('Sedentary', 4)) AS l(activity_level, level_ord)
JOIN (SELECT 1 AS k, AVG(VeryActiveMinutes) AS v FROM merged
      UNION ALL SELECT 2, AVG(FairlyActiveMinutes) FROM merged
      UNION ALL SELECT 3, AVG(LightlyActiveMinutes) FROM merged
      UNION ALL SELECT 4, AVG(SedentaryMinutes) FROM merged) a ON a.k = l.level_ord
""".replace("SELECT * FROM", "SELECT activity_level, level_ord, v AS avg_minutes FROM"))
def avg_minutes_long(spark, sf):
    return segments.minutes_long(merged_daily(spark, sf))


_PROFILE_COLS = ["TotalSteps", "Calories", "VeryActiveMinutes", "FairlyActiveMinutes",
                 "LightlyActiveMinutes", "SedentaryMinutes", "TotalMinutesAsleep",
                 "TotalTimeInBed", "TotalActiveMinutes", "SleepEfficiency"]
_MERGED_COLS = ["Id", "Date", "TotalSteps", "TotalDistance", "Calories", "VeryActiveMinutes",
                "FairlyActiveMinutes", "LightlyActiveMinutes", "SedentaryMinutes",
                "TotalMinutesAsleep", "TotalTimeInBed", "TotalActiveMinutes", "SleepEfficiency"]


@query("null_profile", MERGED_CTE + """
SELECT column_name, null_count FROM (
""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count FROM merged"
    for c in _MERGED_COLS) + """
) t ORDER BY null_count DESC, column_name LIMIT 10""")
def null_profile(spark, sf):
    """Top-10 NULL counts (a top-k report: the limit is the feature)."""
    return profile.null_profile(merged_daily(spark, sf), top=10)


def _describe_sql(cols):
    parts = []
    for c in cols:
        q = [f"{round_sql(f'quantile_cont(CAST({c} AS DOUBLE), {p})', 6)} AS p{int(p * 100)}"
             for p in (0.25, 0.5, 0.75)]
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS count, "
            f"{round_sql(f'AVG(CAST({c} AS DOUBLE))', 6)} AS mean, "
            f"{round_sql(f'STDDEV_SAMP(CAST({c} AS DOUBLE))', 6)} AS std, "
            f"CAST(MIN({c}) AS DOUBLE) AS min, {', '.join(q)}, CAST(MAX({c}) AS DOUBLE) AS max "
            f"FROM merged")
    return "\nUNION ALL ".join(parts)


@query("describe", MERGED_CTE + _describe_sql(_PROFILE_COLS))
def describe(spark, sf):
    """A15 with exact distributed quartiles (rounded to 6 places)."""
    d = profile.describe(merged_daily(spark, sf), _PROFILE_COLS, digits=6)
    return d.select("column_name", "count", "mean", "std", "min",
                    *[F.round(F.col(c) * F.lit(1e6), 0).__truediv__(F.lit(1e6)).alias(c)
                      for c in ("p25", "p50", "p75")], "max")


@query("bucket_unknown", MERGED_CTE + f"""
SELECT {_SLEEP_CASE_U} AS sleep_pattern, COUNT(*) AS count FROM merged GROUP BY 1""")
def bucket_unknown(spark, sf):
    """P17 + A16: null-aware sleep buckets, value counts including Unknown."""
    m = merged_daily(spark, sf).withColumn(
        "sleep_pattern", segments.bucket_sleep("TotalMinutesAsleep", SLEEP_ADEQUATE, True))
    return profile.value_counts(m, "sleep_pattern")


_XT = [segments.ADEQUATE, segments.INADEQUATE, segments.UNKNOWN]


@query("crosstab", MERGED_CTE + f"""
SELECT activity_level,
       COUNT(*) FILTER (WHERE sleep_pattern = 'Adequate Sleep') AS "Adequate Sleep",
       COUNT(*) FILTER (WHERE sleep_pattern = 'Inadequate Sleep') AS "Inadequate Sleep",
       COUNT(*) FILTER (WHERE sleep_pattern = 'Unknown') AS "Unknown"
FROM (SELECT {_STEP_CASE_U} AS activity_level, {_SLEEP_CASE_U} AS sleep_pattern FROM merged) t
GROUP BY activity_level""")
def crosstab(spark, sf):
    """Activity level x sleep pattern (both null-aware)."""
    m = merged_daily(spark, sf).select(
        segments.bucket_activity("TotalSteps", *STEP_BUCKETS, null_as_unknown=True)
        .alias("activity_level"),
        segments.bucket_sleep("TotalMinutesAsleep", SLEEP_ADEQUATE, True).alias("sleep_pattern"))
    return profile.crosstab(m, "activity_level", "sleep_pattern", _XT)


@query("trend", MERGED_CTE + f"""
SELECT {round_sql('REGR_SLOPE(TotalSteps, TotalMinutesAsleep)', 6)} AS slope,
       {round_sql('REGR_INTERCEPT(TotalSteps, TotalMinutesAsleep)', 6)} AS intercept,
       CAST(REGR_COUNT(TotalSteps, TotalMinutesAsleep) AS BIGINT) AS n
FROM merged""")
def trend(spark, sf):
    """Least-squares steps-on-sleep line."""
    return profile.linear_trend(merged_daily(spark, sf), "TotalSteps", "TotalMinutesAsleep")


@query("json_props", """
SELECT event_type, COUNT(*) AS n, COUNT(k) AS n_with_k, CAST(SUM(k) AS BIGINT) AS sum_k,
       MIN(k) AS min_k, MAX(k) AS max_k
FROM (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) t
GROUP BY event_type""")
def json_props(spark, sf):
    """S7-style JSON text parsing with a declared schema (``events.props``)."""
    ev = load(spark, sf, "events").select(
        "event_type", F.from_json("props", "k int").alias("p"))
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("p.k").alias("n_with_k"),
        F.sum("p.k").cast("bigint").alias("sum_k"), F.min("p.k").alias("min_k"),
        F.max("p.k").alias("max_k"))


@query("first_event_per_day", """
SELECT user_id, day, event_id, event_type, value FROM (
  SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type, value,
         ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
  FROM events) t
WHERE rn = 1""")
def first_event_per_day(spark, sf):
    """W3 on the raw events: keep the first event of every user-day (ordered
    by time, then id) as a min_by aggregate, combined map-side for hot keys."""
    from sparkfolio.operators.rows import keep_first
    ev = load(spark, sf, "events").select(
        "user_id", F.to_date("ts").alias("day"), "event_id", "event_type", "value",
        F.struct("ts", "event_id").alias("_ord"))
    return keep_first(ev, ["user_id", "day"], "_ord").drop("_ord")


@query("weekday_profile_sunday_first", MERGED_CTE + """
SELECT dayname(Date) AS day_of_week, CAST(dayofweek(Date) + 1 AS INTEGER) AS day_ord,
       AVG(TotalSteps) AS avg_steps, AVG(TotalMinutesAsleep) AS avg_sleep
FROM merged GROUP BY 1, 2""")
def weekday_profile_sunday_first(spark, sf):
    """A9 chart-feed variant: unrounded means, Sunday-first ordering key."""
    m = merged_daily(spark, sf)
    from sparkfolio.functions.calendar import weekday_name, weekday_ord
    return (m.groupBy(weekday_name("Date").alias("day_of_week"),
                      weekday_ord("Date", sunday_first=True).alias("day_ord"))
             .agg(F.avg("TotalSteps").alias("avg_steps"),
                  F.avg("TotalMinutesAsleep").alias("avg_sleep")))
