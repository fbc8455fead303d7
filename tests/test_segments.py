"""Activity segment operators."""

import datetime as dt

from pyspark.sql import functions as F

from sparkfolio.operators import segments as S


def test_bucket_edges(spark):
    df = spark.createDataFrame([(12500.0,), (12499.5,), (12499.0,), (5000.0,), (4999.0,), (None,)], "s double")
    sql = [r.o for r in df.select(S.bucket_activity("s").alias("o")).collect()]
    assert sql == ["High Active", "Low Active", "Moderate Active", "Moderate Active", "Low Active", "Low Active"]
    nb = [r.o for r in df.select(S.bucket_activity("s", null_as_unknown=True).alias("o")).collect()]
    assert nb[-1] == "Unknown"
    sl = spark.createDataFrame([(420,), (419,), (None,)], "m int")
    assert [r.o for r in sl.select(S.bucket_sleep("m").alias("o")).collect()] == \
        ["Adequate Sleep", "Inadequate Sleep", "Inadequate Sleep"]
    assert sl.select(S.bucket_sleep("m", null_as_unknown=True).alias("o")).collect()[2].o == "Unknown"


def _daily(spark):
    d = dt.date(2024, 1, 1)
    return spark.createDataFrame(
        [(1, d, 13000, 2000, 10, 5, 3, 600), (1, dt.date(2024, 1, 2), 4000, 1800, None, 1, 1, 700),
         (2, d, 8000, 1900, 1, 1, 1, 800)],
        "Id int, Date date, TotalSteps int, Calories int, VeryActiveMinutes int, "
        "FairlyActiveMinutes int, LightlyActiveMinutes int, SedentaryMinutes int")


def test_merge_keeps_row_count_and_first_sleep(spark):
    d = dt.date(2024, 1, 1)
    sleep = spark.createDataFrame([(1, d, 2, 430, 450), (1, d, 1, 300, 0), (3, d, 1, 100, 200)],
                                  "Id int, Date date, pos int, TotalMinutesAsleep int, TotalTimeInBed int")
    m = S.with_derived_metrics(S.merge_daily_sleep(_daily(spark), sleep, sleep_order="pos"))
    rows = {(r.Id, r.Date): r for r in m.collect()}
    assert len(rows) == 3
    first = rows[(1, d)]
    assert first.TotalMinutesAsleep == 300 and first.SleepEfficiency is None  # in bed 0 -> NULL
    assert rows[(1, dt.date(2024, 1, 2))].TotalActiveMinutes == 2  # NULL very-active filled with 0
    assert rows[(2, d)].TotalMinutesAsleep is None


def test_reports(spark):
    m = S.with_derived_metrics(S.merge_daily_sleep(_daily(spark), spark.createDataFrame(
        [], "Id int, Date date, TotalMinutesAsleep int, TotalTimeInBed int")))
    lv = {r.activity_level: r.total_days_in_level for r in S.activity_levels(m).collect()}
    assert lv == {"High Active": 1, "Moderate Active": 1, "Low Active": 1}
    eng = {r.Id: r.engagement_level for r in S.engagement(m, high=2, moderate=1).collect()}
    assert eng == {1: "High Engagement", 2: "Moderate Engagement"}
    wk = {r.day_of_week: r.day_ord for r in S.weekday_profile(m).collect()}
    assert wk == {"Monday": 1, "Tuesday": 2}
    long = [tuple(r) for r in S.minutes_long(m).orderBy("level_ord").collect()]
    assert [x[0] for x in long] == ["Very Active", "Fairly Active", "Lightly Active", "Sedentary"]
    assert long[3][2] == 700.0
    u = S.log_utilization(spark.createDataFrame([(1,), (1,), (2,)], "Id int")).first()
    assert (u.total_logs, u.unique_weight_users) == (3, 2)


def test_hourly_files_split_and_three_way_join(spark):
    hs = spark.createDataFrame([(1, "4/12/2016 1:00:00 PM", 100), (1, "4/12/2016 2:00:00 PM", 50),
                                (2, "2016-04-12 13:00:00", 10)], "Id int, ActivityHour string, StepTotal int")
    hc = spark.createDataFrame([(1, "4/12/2016 1:00:00 PM", 80), (2, "4/12/2016 1:00:00 PM", 60)],
                               "Id int, ActivityHour string, Calories int")
    hi = spark.createDataFrame([(1, "4/12/2016 1:00:00 PM", 7), (2, "4/12/2016 1:00:00 PM", 3),
                                (1, "bad", 9)], "Id int, ActivityHour string, TotalIntensity int")
    s = S.split_activity_hour(hs)
    r = s.orderBy("StepTotal").collect()[-1]
    assert (str(r.Date), r.Time) == ("2016-04-12", "13:00:00")
    out = S.hourly_profile(s, S.split_activity_hour(hc), S.split_activity_hour(hi)).collect()
    assert [(x.hour_of_day, x.avg_steps, x.avg_calories, x.avg_intensity) for x in out] == [(13, 55.0, 70.0, 5.0)]


def test_daily_etl_from_reference_files(spark, tmp_path):
    (tmp_path / "dailyActivity_merged.csv").write_text(
        "Id,ActivityDate,TotalSteps,Calories,VeryActiveMinutes,FairlyActiveMinutes,LightlyActiveMinutes\n"
        "1,4/12/2016,13162,1985,25,13,328\n1,4/12/2016,999,1,1,1,1\n2,4/13/2016,4000,1500,,2,3\n")
    (tmp_path / "sleepDay_merged.csv").write_text(
        "Id,SleepDay,TotalSleepRecords,TotalMinutesAsleep,TotalTimeInBed\n"
        "1,4/12/2016 12:00:00 AM,1,327,346\n1,4/12/2016 12:00:00 AM,1,1,1\n")
    m = {(r.Id, str(r.Date)): r for r in S.daily_merged_from_files(spark, str(tmp_path)).collect()}
    assert len(m) == 2
    a = m[("1", "2016-04-12")]
    assert (a.TotalSteps, a.TotalMinutesAsleep, a.TotalActiveMinutes) == (13162.0, 327.0, 366.0)
    assert abs(a.SleepEfficiency - 100 * 327 / 346) < 1e-12
    b = m[("2", "2016-04-13")]
    assert b.TotalMinutesAsleep is None and b.TotalActiveMinutes == 5.0 and b.SedentaryMinutes == 0


def test_daily_etl_without_sleep_file(spark, tmp_path):
    (tmp_path / "dailyActivity_a.csv").write_text("Id,ActivityDate,TotalSteps\n3,5/1/2016,10\n")
    rows = S.daily_merged_from_files(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and rows[0].TotalMinutesAsleep is None and rows[0].TotalActiveMinutes == 0
