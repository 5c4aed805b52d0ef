"""Data products on tiny support-desk tables."""

import os
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsgrain.plans import cases, complaints, sla, volume
from opsgrain.plans.contracts import HOURLY_QUEUE
from opsgrain.plans.semantic import Period, View, by_granularity, distinct, number, pick, rows, share, timeframe
from opsgrain.registry import rules
from opsgrain.registry.rules import SLA
from opsgrain.sources import tables as src
from opsgrain.sources import versions


def at(text):
    return datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def desk(spark):
    touch = "touch_id int, touch_start_id int, queue_name string, employee_id int, touch_start_time timestamp_ntz, touch_assignment_time timestamp_ntz, touch_end_time timestamp_ntz, response_time_seconds int, handle_time_seconds int, in_business_hours boolean"
    return {
        "messaging_touches": spark.createDataFrame(
            [
                (1, 1, "queue a", 7, at("2024-03-10 01:30:00"), at("2024-03-10 01:40:00"), at("2024-03-10 01:50:00"), 420, 600, True),
                (2, 2, "Queue A", 7, at("2024-03-10 01:35:00"), at("2024-03-11 01:40:00"), at("2024-03-11 01:45:00"), 421, 0, True),
                (3, 3, "nowhere", None, at("2024-03-10 03:30:00"), at("2024-03-10 03:31:00"), at("2024-03-10 03:32:00"), None, None, None),
                (4, 4, "QUEUE F", 7, at("2024-03-10 05:30:00"), at("2024-03-10 05:31:00"), at("2024-03-10 05:32:00"), 1, 1, True),
            ],
            touch,
        ),
        "queue_catalog": spark.createDataFrame(
            [("1", "QUEUE A", "T", "CHAT", "Customer Success - Core"), ("9", "Queue F", "F", "CHAT", "Finance")],
            "queue_id string, queue_name string, team_name string, communication_channel string, business_unit_name string",
        ),
        "chat_escalations": spark.createDataFrame(
            [(1, "RD Chat", at("2024-03-10 03:00:00"), at("2024-03-10 03:05:00"), 60, 120), (2, "RD Chat", at("2024-03-10 03:00:00"), at("2024-03-10 03:05:00"), 10, 0),
             (3, "Other", at("2024-03-10 03:00:00"), at("2024-03-10 03:05:00"), 10, 5)],
            "chat_transcript_id int, chat_record_type string, chat_created_at timestamp_ntz, chat_start_time timestamp_ntz, chat_wait_time int, chat_handle_time int",
        ).withColumn("chat_advocate_employee_id", F.lit(7)),
        "employees": spark.createDataFrame(
            [(7, "Ann", "Here", "M", "D", date(2024, 1, 1), date(2024, 3, 10))],
            "employee_id int, full_name string, city string, manager string, managers_manager string, start_date date, end_date date",
        ),
    }


def test_hourly_queue_fact(desk):
    fact = sla.hourly_queue_sla(desk, "2024-03-10", "2024-03-11", SLA)
    got = {(r["ts"].hour, r["queue_id"]): r for r in fact.collect()}
    # 01:30 Pacific is 09:30 UTC before the clock change, 03:30 is 10:30 after it
    assert got[(9, "1")]["entering_touches"] == 2 and got[(9, "1")]["handled_touches"] == 1
    assert got[(9, "1")]["touches_in_sla"] == 1 and got[(9, "1")]["touch_lifetime_min"] == 10
    assert got[(10, None)]["entering_touches"] == 1 and got[(10, None)]["handled_touches"] is None
    assert (12, None) not in got and (12, "9") not in got  # the hour holds a touch of another unit only
    assert got[(0, None)]["entering_touches"] == 0  # empty hour
    chat = got[(10, "RD")]
    assert (chat["entering_touches"], chat["touches_in_sla"], chat["qualified_sla_touches"]) == (2, 1, 1)
    assert len([k for k in got if k[1] is None]) == 22
    stored = sla.hourly_queue_sla(desk, "2024-03-10", "2024-03-11", SLA, ds=date(2024, 3, 12), round_like_fact=True)
    assert stored.schema == HOURLY_QUEUE and stored.schema["ts"].metadata["comment"] == "hour in UTC"


def test_hourly_advocate_fact(desk):
    rows_ = sla.hourly_advocate_sla(desk, "2024-03-10", "2024-03-12", SLA).filter("queue_id is not null").collect()
    got = {(r["ts"].day, r["ts"].hour, r["queue_id"]): r for r in rows_}
    # the range ends on the 10th at midnight for a timestamp, at the end of the day for a date
    assert got[(10, 9, "1")]["employee_id"] is None
    assert got[(10, 10, "RD")]["employee_id"] == 7
    assert got[(11, 8, "1")]["concurrency"] is None and got[(11, 8, "1")]["handled_backlog_touches"] == 1
    by_day = sla.hourly_advocate_sla(desk, "2024-03-10", "2024-03-12", SLA, by_date=True).filter("queue_id = '1'").collect()
    assert {r["ts"].day: r["employee_id"] for r in by_day} == {10: 7, 11: None}


def complaint(**over):
    base = dict(
        workflow="Internal", is_central_team=False, received_ts_utc=at("2024-01-01 00:00:00"), acknowledged_ts_utc=at("2024-01-09 00:00:00"),
        closed_ts_utc=at("2024-01-08 00:00:00"), response_due_ts_utc=at("2024-01-10 00:00:00"), external_response_sent_ts_utc=at("2024-01-05 00:00:00"),
        created_ts_utc=at("2024-01-01 00:00:00"), resolved_ts_utc=at("2024-01-04 00:00:00"), investigated_ts_utc=at("2024-01-03 00:00:00"),
    )
    return {**base, **over}


@pytest.mark.parametrize(
    ("over", "ack", "early", "formal"),
    [
        ({}, None, True, False),  # closed within 5 business days: the formal rule does not apply
        ({"closed_ts_utc": at("2024-01-12 00:00:00")}, None, False, True),
        ({"closed_ts_utc": None}, None, False, None),
        ({"is_central_team": True}, True, None, False),
        ({"is_central_team": True, "acknowledged_ts_utc": None}, False, None, False),
        ({"workflow": "BBB"}, None, None, True),
        ({"workflow": "Regulatory", "closed_ts_utc": at("2024-01-20 00:00:00")}, None, None, False),
        ({"workflow": "Global"}, None, None, False),
    ],
)
def test_complaint_limits(spark, over, ack, early, formal):
    schema = "workflow string, is_central_team boolean, received_ts_utc timestamp_ntz, acknowledged_ts_utc timestamp_ntz, closed_ts_utc timestamp_ntz, response_due_ts_utc timestamp_ntz, external_response_sent_ts_utc timestamp_ntz, created_ts_utc timestamp_ntz, resolved_ts_utc timestamp_ntz, investigated_ts_utc timestamp_ntz"
    record = complaint(**over)
    df = spark.createDataFrame([tuple(record.values())], schema)
    row = complaints.complaint_sla(df, F.lit("2024-01-04").cast("timestamp_ntz")).first()
    assert (row["is_in_acknowledgement_sla"], row["is_in_early_resolution_sla"], row["is_in_formal_response_sla"]) == (ack, early, formal)


def test_repeat_contacts(spark):
    base = spark.createDataFrame(
        [("u", "x", at("2024-01-01 00:00:00"), 1), ("u", "y", at("2024-01-03 00:00:00"), 2), ("u", "x", at("2024-01-11 00:00:00"), 3), ("w", "x", at("2024-01-01 00:00:00"), 4)],
        "customer_token string, problem_tag string, case_ts_utc timestamp_ntz, case_id int",
    )
    detail = cases.fcr_detail(base)
    got = {r["case_id"]: (r["any_days"], r["same_days"], r["different_days"], r["fcr_7_day"], r["fcr_14_day"]) for r in detail.collect()}
    assert got == {1: (2, 10, 2, True, False), 2: (-2, None, -2, True, True), 3: (-8, -10, -8, True, False), 4: (None, None, None, True, True)}
    summary = cases.fcr_summary(detail).first()
    assert summary["total_fcr_14_day"] == 50.0 and summary["pct_customers_with_same"] == 50.0 and summary["median_abs_days_since_any"] == 2.0


# -- semantic layer -----------------------------------------------------------------------------


def test_period_bounds():
    as_of = datetime(2024, 1, 30, 10, 15)
    clock = Period.from_filter(date(2024, 1, 16), date(2024, 1, 23), as_of)
    assert (clock.start, clock.previous_start, clock.days) == (datetime(2024, 1, 16, 10, 15), datetime(2024, 1, 9, 10, 15), 7)
    assert clock.previous_label == "2024-01-09 to 2024-01-15"
    early = datetime(2024, 1, 30, 3, 0)
    assert Period.from_filter(date(2024, 1, 16), date(2024, 1, 23), early, mode="local_date").start == datetime(2024, 1, 15)
    assert Period.from_filter(date(2024, 1, 16), date(2024, 1, 23), early, mode="rollover").start == datetime(2024, 1, 15)
    assert Period.from_filter(date(2024, 1, 16), date(2024, 1, 23), as_of, mode="rollover").start == datetime(2024, 1, 16)
    assert Period.from_filter(None, None, as_of) == Period(datetime(1970, 1, 1), datetime(2024, 1, 30))
    assert Period.from_filter(None, None, as_of, open_end="epoch").seconds == 0


def test_period_edges(spark):
    p = Period(datetime(2024, 1, 8), datetime(2024, 1, 15))
    df = spark.createDataFrame([(at(x),) for x in ("2024-01-01", "2024-01-08", "2024-01-15", "2023-12-31 23:59:59")], "t timestamp_ntz")
    got = df.select("t", p.bucket("t").alias("b"), p.position("t").alias("n"), p.aligned("t").alias("a")).collect()
    assert [r["b"] for r in got] == ["Previous Period", "Current Period", "Not In Range", "Not In Range"]
    assert [r["n"] for r in got] == [1.0, 1.0, 8.0, None]
    assert got[0]["a"] == datetime(2024, 1, 8)


def test_view_guards(spark):
    view = View("v", {"g": lambda p: F.col("g")}, {"n": distinct("id"), "k": rows(), "pct": share("n"), "bad": number(lambda x: x, "bad")}, {"d": ["id", "n"]})
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", 3)], "g string, id int")
    got = {r["g"]: (r["n"], r["k"], round(r["pct"], 3)) for r in view.query(df, ["g"], ["n", "k", "pct"]).collect()}
    assert got == {"a": (1, 2, 0.333), None: (1, 1, 0.333), "b": (1, 1, 0.333)}
    assert view.detail(df, "d").columns == ["id"]
    for bad in ("bad", "missing"):
        with pytest.raises(ValueError):
            view.query(df, ["g"], [bad])
    with pytest.raises(ValueError):
        pick({"a": "x"}, "b; drop table")
    with pytest.raises(ValueError):
        timeframe("t", "fortnight")
    stamp = spark.range(1).select(F.lit("2024-05-15 10:20:00").cast("timestamp_ntz").alias("t"))
    assert stamp.select(by_granularity("t", "Quarter")).first()[0] == date(2024, 4, 1)
    assert stamp.select(by_granularity("t", None)).first()[0] == date(2024, 5, 15)


# -- lifecycle ----------------------------------------------------------------------------------


def test_partition_reload_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "fact")

    def fact(days, value):
        return spark.createDataFrame([(at(f"2024-01-{d:02d} 05:00:00"), value) for d in days], "ts timestamp_ntz, v int")

    src.write(fact(range(1, 21), 1).withColumn("ds", F.col("ts").cast("date")), path, partition_by=["ds"])
    for _ in range(2):
        src.reload_partitions(fact(range(1, 23), 2), path, "ts", date(2024, 1, 20))
    rows_ = spark.read.parquet(path).collect()
    assert len(rows_) == 22 and {r["ds"].day for r in rows_ if r["v"] == 2} == set(range(13, 23))


def test_publish_switches_whole_versions(spark, tmp_path):
    prod = str(tmp_path / "prod")
    with pytest.raises(FileNotFoundError):
        versions.published(spark, prod)
    days = spark.createDataFrame([(i, f"d{i % 3}") for i in range(9)], "v int, ds string")
    first = versions.publish(days, prod, ["ds"])
    before = versions.published(spark, prod)
    assert before.columns == ["v", "ds"]
    assert sorted(os.listdir(f"{prod}/data/__v={first}")) == ["._SUCCESS.crc", "_SUCCESS", "ds=d0", "ds=d1", "ds=d2"]
    # a failing write leaves the published version as it is
    with pytest.raises(Exception, match="boom"):
        versions.publish(days.withColumn("v", F.when(F.col("v") == 8, F.raise_error(F.lit("boom")).cast("int")).otherwise(F.col("v"))), prod, ["ds"])
    assert versions.current_version(spark, prod) == first and versions.published(spark, prod).count() == 9
    second = versions.publish(days.filter("v < 3"), prod, ["ds"])
    assert versions.current_version(spark, prod) == second != first
    assert before.count() == 9 and versions.published(spark, prod).count() == 3  # an open reader keeps its version
    versions.publish(days.filter("v < 2"), prod, ["ds"])
    assert [x for x in os.listdir(f"{prod}/data") if first in x] == [] and versions.published(spark, prod).count() == 2
    # what a driver that was lost while it wrote has left is deleted when it is old enough
    os.makedirs(f"{prod}/data/__v=v-20200101000000000000-lost/ds=d0")
    versions.expire(spark, prod)
    assert len(os.listdir(f"{prod}/data")) == 3
    versions.expire(spark, prod, leftovers=timedelta(0))
    assert len(os.listdir(f"{prod}/data")) == 2 and versions.published(spark, prod, second).count() == 3


def test_a_run_writes_its_partitions_only(spark, tmp_path):
    prod = str(tmp_path / "prod")

    def fact(days, value):
        rows = [(at(f"2024-01-{d:02d} 05:00:00"), value) for d in days] + [(None, value)]
        return spark.createDataFrame(rows, "ts timestamp_ntz, v int")

    first = versions.publish(fact(range(1, 21), 1).withColumn("ds", F.col("ts").cast("date")), prod, ["ds"])
    before = versions.published(spark, prod)
    run = versions.reload_published(fact([13, 14, 15, 16, 17, 18, 20], 2), prod, "ts", date(2024, 1, 20))
    wrote = [x for x in os.listdir(f"{prod}/data/__v={run}") if x.startswith("ds=")]
    assert len(wrote) == 7
    held = {r["ds"] and r["ds"].day: r["v"] for r in versions.published(spark, prod).collect()}
    # days 1 to 12 and the row without a day stay, day 19 is gone
    assert held == {None: 1, **dict.fromkeys(range(1, 13), 1), **dict.fromkeys([13, 14, 15, 16, 17, 18, 20], 2)}
    assert before.count() == 21
    assert set(versions.version(spark, prod).folders.values()) == {first, run}
    # the first version is forgotten, its partitions that are still in use stay
    again = versions.reload_published(fact([20], 3), prod, "ts", date(2024, 1, 20))
    assert not os.path.exists(f"{prod}/data/__v={first}/ds=2024-01-14") and os.path.exists(f"{prod}/data/__v={first}/ds=2024-01-05")
    assert versions.published(spark, prod).count() == 14 and versions.published(spark, prod, run).count() == 20
    assert versions.current_version(spark, prod) == again
    with pytest.raises(ValueError):
        versions.reload_published(fact([20], 3).withColumn("more", F.lit(1)), prod, "ts", date(2024, 1, 20))


def test_the_second_of_two_runs_fails(spark, tmp_path, monkeypatch):
    prod = str(tmp_path / "prod")
    rows = spark.createDataFrame([(1, "a")], "v int, ds string")
    first = versions.publish(rows, prod, ["ds"])
    plain = versions.write

    def slow(*args, **options):
        monkeypatch.setattr(versions, "write", plain)
        versions.publish(rows.withColumn("v", F.lit(2)), prod, ["ds"])
        plain(*args, **options)

    monkeypatch.setattr(versions, "write", slow)
    with pytest.raises(versions.ChangedMeanwhile):
        versions.publish(rows.withColumn("v", F.lit(3)), prod, ["ds"], replaces=lambda p: True)
    assert versions.current_version(spark, prod) != first and [r["v"] for r in versions.published(spark, prod).collect()] == [2]
    assert versions.publish(rows.filter("v > 9"), prod, ["ds"]) and versions.published(spark, prod).count() == 0


def test_rows_without_time_stay_in_a_reload(spark):
    old = spark.createDataFrame([(None, 1), (at("2024-01-19 00:00:00"), 1)], "ts timestamp_ntz, v int")
    fresh = spark.createDataFrame([(None, 2), (at("2024-01-19 00:00:00"), 2)], "ts timestamp_ntz, v int")
    for full in (False, True):
        assert sorted(r["v"] for r in src.trailing_reload(old, fresh, "ts", date(2024, 1, 20), full=full).collect()) == [1, 2]


def test_create_append_and_full_refresh(spark, tmp_path):
    path = str(tmp_path / "fact")
    assert src.create_if_absent(spark, path, HOURLY_QUEUE).count() == 0
    row = spark.createDataFrame([(at("2024-01-01 00:00:00"), *["x"] * 4, *[2.5] * 8)])
    src.write(src.conform(row, HOURLY_QUEUE, positional=True), path, "append")
    again = src.create_if_absent(spark, path, HOURLY_QUEUE)
    assert [int(r["entering_touches"]) for r in again.collect()] == [3]

    parts = str(tmp_path / "parts")
    days = spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string")
    src.write(days, parts, partition_by=["day"])
    src.write(days.filter("v = 2").withColumn("v", F.lit(5)), parts, partition_by=["day"])
    assert sorted(r["v"] for r in spark.read.parquet(parts).collect()) == [1, 5]
    src.write(days.filter("v = 2"), parts, partition_by=["day"], full_refresh=True)
    assert [r["v"] for r in spark.read.parquet(parts).collect()] == [2]


def test_trailing_reload_and_contract(spark):
    old = spark.createDataFrame([(at("2024-01-01 00:00:00"), 1), (at("2024-01-19 00:00:00"), 1)], "ts timestamp_ntz, v int")
    new = old.withColumn("v", F.lit(2))
    assert sorted(r["v"] for r in src.trailing_reload(old, new, "ts", date(2024, 1, 20)).collect()) == [1, 2]
    assert [r["v"] for r in src.trailing_reload(old, new, "ts", date(2024, 1, 20), full=True).collect()] == [2, 2]
    with pytest.raises(ValueError):
        src.conform(old, HOURLY_QUEUE, positional=True)
    assert src.describe(src.empty(spark, HOURLY_QUEUE))[0] == ("ts", "timestamp_ntz", "hour in UTC")


def test_year_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(at("2023-05-01 00:00:00"), 1), (at("2024-05-01 00:00:00"), 2)], "t timestamp_ntz, v int").write.parquet(path)
    df = src.in_years(spark.read.parquet(path), "t", 2024, 2024)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t,2024-01-01T00:00), LessThan(t,2025-01-01T00:00)]" in plan
    assert df.count() == 1


# -- ranges at the scans --------------------------------------------------------------------------


def scans_without_range(df, folder):
    """Fact scans of a plan whose pushed filters hold no range."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x and str(folder) in x and not re.search(r"/(queue_catalog|employees|support_cases|events|cases|labels)\b", x)]
    assert scans
    return [x for x in scans if "GreaterThanOrEqual" not in x.split("PushedFilters")[1] or "LessThan" not in x.split("PushedFilters")[1]]


@pytest.fixture(scope="module")
def fact_files(spark, tmp_path_factory):
    """The views of the registry as files, so that time columns are stored columns."""
    from opsgrain.registry import base, rates

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # plans name all filters of a scan
    folder = tmp_path_factory.mktemp("facts")
    sf = "/root/testdata/sf0.001"
    views = dict(
        messaging_touches=base.MESSAGING, queue_catalog=base.CATALOG, chat_escalations=base.CHATS, employees=base.EMPLOYEES,
        email_touches=base.EMAILS, call_records=base.CALLS,
    )
    out = {}
    for name, v in views.items():
        v.spark(spark, sf).write.parquet(f"{folder}/{name}")
        out[name] = spark.read.parquet(f"{folder}/{name}")
    volume = {}
    for name, df in rates._volume_frames(spark, sf).items():
        if name == "regulated":
            volume[name] = df
            continue
        df.write.parquet(f"{folder}/v/{name}")
        volume[name] = spark.read.parquet(f"{folder}/v/{name}")
    return out, volume, folder


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not there")
def test_every_fact_scan_has_a_range(fact_files):
    t, v, folder = fact_files
    span = ("2024-01-05", "2024-02-01", SLA)
    plans = [
        sla.hourly_queue_sla(t, *span), sla.hourly_queue_sla(t, *span, ds=date(2024, 1, 20)), sla.hourly_advocate_sla(t, *span),
        sla.messaging_sla_hourly(t, *span), sla.daily_advocate_sla(t, *span), sla.email_sla_hourly(t, *span), sla.email_sla_total(t, *span),
        sla.messaging_sla_total(t, *span), sla.voice_sla_hourly(t, *span[:2], core_vertical="core"), sla.voice_sla_total(t, *span[:2]),
        volume.monthly_volume(v, "2024-01-05", "2024-01-20", rules.ARRIVALS), volume.monthly_touches(v, "2024-01-05", "2024-01-20", rules.TOUCHES),
    ]
    for df in plans:
        assert scans_without_range(df, folder) == []


def test_a_reload_reads_its_trailing_days_only(fact_files):
    t, _, _ = fact_files
    df = sla.hourly_queue_sla(t, "2024-01-01", "2024-02-01", SLA, ds=date(2024, 1, 20))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(touch_assignment_time,2024-01-12T00:00)" in plan
    whole = sla.hourly_queue_sla(t, "2024-01-01", "2024-02-01", SLA).filter("ts >= timestamp_ntz '2024-01-13'")
    assert df.exceptAll(whole).count() == 0 and whole.exceptAll(df).count() == 0


def test_spans_make_their_own_slots(spark):
    """No join of spans and calendar, and an open end costs the slots of the days asked for."""
    from opsgrain.plans.workforce import available_minutes

    spans = [("a@x", "Available", at("2024-01-01 10:10:00"), at("2024-01-01 11:10:00")), ("a@x", "Available", at("2024-01-01 10:10:00"), at("2024-01-01 11:10:00")),
             ("b@x", "Break", at("2024-01-01 10:10:00"), at("2024-01-01 11:10:00")), ("c@x", "Available", at("2024-01-01 10:10:00"), None)]
    activity = spark.createDataFrame(spans, "email string, code string, date_time timestamp_ntz, status_remove_time timestamp_ntz")
    out = available_minutes(activity, "2024-01-01", "2024-01-03")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and not re.search(r"Join.*(start_ts|end_ts|__node)", plan)
    got = out.collect()
    assert len(got) == 96 and sorted(r["available_minutes"] for r in got if r["login"]) == [10, 30]
    assert {(r["report_date"].day, r["day_minutes"]) for r in got} == {(1, 80), (2, None)}
    forever = activity.withColumn("status_remove_time", F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))
    late = available_minutes(forever, "2024-01-01", "2024-01-03").filter("login is not null").collect()
    assert len({r["interval_start"] for r in late}) == 75 and {r["available_minutes"] for r in late} == {30}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not there")
@pytest.mark.parametrize(("name", "most"), [("handle_time_totals", 4), ("share_by_channel", 1), ("payment_audit_match", 12), ("reimburse_refund_union", 11)])
def test_inputs_are_built_once(spark, name, most):
    """Scans that ran: one per table and use of it, not one more for each total over the rows."""
    from opsgrain.registry import QUERIES

    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall("FileScan parquet", final)) <= most


def test_remediation_gathers_a_case_once(spark):
    """Owner, queue and mail of a case come out of one aggregate; the best mail is that without team code, then a specialist's, then the latest."""
    from opsgrain.plans import complaints

    noon = "timestamp_ntz'2024-01-05 12:00:00'"
    t = {
        "complaints": spark.sql(
            f"""SELECT cast(id AS int) AS complaint_id, cast(id AS int) AS case_id, 'In Progress' AS complaint_status, 'Tier 2' AS severity_tier, false AS is_duplicate,
            'Internal' AS workflow, 'Main' AS business_unit, 'x' AS third_party_source, 'Unknown' AS country, false AS is_central_team, 'refund' AS resulting_action,
            cast(null AS timestamp_ntz) AS closed_ts_utc, {noon} AS created_ts_utc, 'n' AS review_notes FROM range(1, 6)"""
        ),
        "cases": spark.sql(
            f"""SELECT cast(id AS int) AS case_id, 'N' AS case_number, if(id = 5, 'Open', 'Closed') AS status, {noon} AS case_creation_date_time_utc,
            {noon} AS first_resolved_at, {noon} AS last_resolved_at FROM range(1, 6)"""
        ),
        "owner_history": spark.sql(
            """SELECT * FROM VALUES (3, 1, 'Team', timestamp_ntz'2024-01-02'), (5, 9, 'Escalations', timestamp_ntz'2024-01-06'), (5, 9, 'Escalations', null),
            (null, 1, 'Escalations', timestamp_ntz'2024-01-02') AS v(case_id, new_value, new_name, created_at_utc)"""
        ),
        "emails": spark.sql(
            """SELECT *, 'outgoing' AS direction FROM VALUES (1, 1, 2, timestamp_ntz'2024-01-03'), (2, 1, 1, timestamp_ntz'2024-01-02'), (3, 2, 1, timestamp_ntz'2024-01-02'),
            (4, 2, 3, timestamp_ntz'2024-01-01') AS v(email_id, case_id, created_by_id, email_created_at)"""
        ),
        "employees": spark.sql(
            "SELECT *, date'2023-01-01' AS start_date, date'2025-01-01' AS end_date FROM VALUES (1, 'MET 1'), (2, 'core'), (3, null) AS v(agent_id, team_code)"
        ),
    }
    names = ["central", "mail_action", "mail", "mail_open", "any_mail", "owned", "closed", "before_queue", "none"]
    out = complaints.remediation_list(t, specialist=["%met%"], escalation_queue="Escalations", business_unit="Main", texts={n: n for n in names})
    got = {r["case_id"]: r["remediation_bucket"] for r in out.collect()}
    assert got == {1: "mail_action", 2: "none", 3: "owned", 4: "none", 5: "before_queue"}
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
