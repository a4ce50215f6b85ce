"""Working time against a walk over minutes."""

import random
from datetime import date, datetime, time, timedelta

import pytest
from pyspark.sql import functions as F

from ticketloom import policy
from ticketloom.operators import sla
from ticketloom.operators.worktime import WorkCalendar, count_below, numbers, yearly

PLAIN = WorkCalendar()
ODD = WorkCalendar(
    hours=((time(8), time(12)), None, (time(9, 30), time(17, 45)), (time(0), time(23, 59)), (time(9), time(9, 1)), (time(10), time(14)), None),
    holidays=(date(2024, 1, 1), date(2024, 1, 3), date(2024, 1, 4), date(2024, 1, 7), date(2023, 12, 29)))


def open_at(calendar, t):
    h = calendar.hours[t.weekday()]
    return h is not None and t.date() not in calendar.holidays and h[0] <= t.time() < h[1]


def walk(calendar, start, minutes):
    """The instant after so many open minutes, by steps of one minute from a whole minute."""
    t = start
    while minutes > 0:
        minutes -= open_at(calendar, t)
        t += timedelta(minutes=1)
    return t


@pytest.mark.parametrize("calendar", [PLAIN, ODD, WorkCalendar(holidays=yearly(range(2023, 2026), (1, 1), (1, 2), (12, 25)))])
def test_due_times_and_elapsed_minutes(spark, calendar):
    rng = random.Random(7)
    rows = []
    for _ in range(120):
        start = datetime(2023, 12, 20) + timedelta(minutes=rng.randint(0, 40 * 1440))
        rows.append((start, rng.choice([0, 1, 30, 60, 480, 481, 960, 2400, rng.randint(1, 4000)])))
    frame = spark.createDataFrame(rows, "start timestamp_ntz, minutes int")
    got = frame.select("start", "minutes", calendar.add(F.col("start"), F.col("minutes")).alias("due")).withColumn("back", calendar.elapsed(F.col("start"), F.col("due"))).collect()
    for r in got:
        assert r.due == walk(calendar, r.start, r.minutes), (r.start, r.minutes)
        assert r.back == r.minutes


def test_seconds_and_nulls(spark):
    rows = [(datetime(2024, 1, 5, 16, 59, 30, 250000), 1), (datetime(2024, 1, 6, 12), 30), (None, 5), (datetime(2024, 1, 5, 8), None)]
    got = spark.createDataFrame(rows, "start timestamp_ntz, minutes int").select(PLAIN.add(F.col("start"), F.col("minutes")).alias("d")).collect()
    assert [r.d for r in got] == [datetime(2024, 1, 8, 9, 0, 30, 250000), datetime(2024, 1, 8, 9, 30), None, None]
    with pytest.raises(ValueError):
        WorkCalendar(hours=(None,) * 7)


def test_count_below(spark):
    for values in ([], [5], [0], [1, 3, 3, 8, 100], list(range(0, 2000, 3))):
        asked = [-5, 0, 1, 3, 4, 5, 8, 99, 100, 101, 5000]
        got = spark.createDataFrame([(a,) for a in asked], "x long").select(count_below(numbers(values), len(values), F.col("x")).alias("n")).collect()
        assert [r.n for r in got] == [sum(v < a for v in values) for a in asked]


def test_business_days_only_where_tickets_wait(spark):
    friday = datetime(2024, 1, 5, 16)
    rows = [("a", "P1", "Critical", friday), ("b", "P3", "Medium", friday), ("c", "P4", "Low", friday)]
    frame = spark.createDataFrame(rows, "id string, priority string, urgency_level string, submitted_date timestamp_ntz")
    plain = {r.id: r for r in sla.assign_sla(frame, sla.sla_table(spark)).collect()}
    business = {r.id: r for r in sla.assign_sla(frame, sla.sla_table(spark), calendar=PLAIN).collect()}
    assert plain["a"].resolution_due == business["a"].resolution_due == friday + timedelta(hours=4)
    assert plain["b"].resolution_due == friday + timedelta(days=2) and business["b"].resolution_due == datetime(2024, 1, 9, 16)
    assert business["b"].response_due == datetime(2024, 1, 8, 10) and business["b"].escalate_at == datetime(2024, 1, 8, 16)
    assert business["c"].resolution_due == datetime(2024, 1, 12, 16) and business["c"].escalate_at == datetime(2024, 1, 10, 16)
    assert policy.TIER_ESCALATION["P3"][0] == 1440
