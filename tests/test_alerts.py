"""Alert lifecycle: batch plan and stream against a plain loop."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from roadflux import workspace
from roadflux.functions import rules
from roadflux.operators import alerts
from roadflux.plans import jobs, notifications
from roadflux.sources import raw
from roadflux.streaming import landing, lifecycle, metrics

START = dt.datetime(2024, 1, 1)


def kind_of(v, s, o):
    """A NULL measure breaks no limit."""
    for name, (slow, full, many, *_) in rules.ALERTS.items():
        if (s is not None and s < slow) or (o is not None and o > full) or (v is not None and v > many):
            return name
    return None


def walk(windows):
    """The lifecycle as a loop: windows of all series, in time order."""
    open_, done = {}, []
    for road, zone, end, v, s, o in sorted(windows, key=lambda w: (w[2], w[0], w[1])):
        kind = kind_of(v, s, o)
        if kind is None:
            for key in [k for k in open_ if k[1:] == (road, zone)]:
                alert = open_.pop(key)
                done.append({**alert, "status": "RESOLVED", "resolved": end})
            continue
        alert = open_.get((kind, road, zone))
        if alert is None:
            open_[(kind, road, zone)] = dict(kind=kind, road=road, zone=zone, opened=end, last=end, n=0, v=v,
                                             updated=end, status="ACTIVE", resolved=None)
        else:
            alert.update(v=v, updated=end)
            if (end - alert["last"]).total_seconds() > rules.ALERTS[kind][4]:
                alert.update(last=end, n=alert["n"] + 1)
    return sorted((a["kind"], a["road"], a["zone"], a["opened"], a["v"], a["status"], a["n"], a["updated"], a["resolved"])
                  for a in done + list(open_.values()))


def random_windows(minutes=400, seed=5):
    rng, out = random.Random(seed), []
    for road, zone in (("R1", "Z1"), ("R2", "Z1"), ("R1", "Z2")):
        level = 60.0
        for m in range(minutes):
            if rng.random() < 0.15:
                continue  # no window: neither a sign of trouble nor of recovery
            level = rng.choice([20.0, 35.0, 45.0, 70.0]) if rng.random() < 0.06 else level
            speed = None if rng.random() < 0.03 else level
            out.append((road, zone, START + dt.timedelta(minutes=m + 1), float(rng.randrange(90)), speed, 10.0))
    return out


SCHEMA = ("road_id string, zone string, window_end timestamp_ntz, avg_vehicle_count double, avg_speed double, "
          "avg_occupancy_rate double")


def shaped(frame):
    return sorted((tuple(r) for r in frame.select(
        "alert_type", "road_id", "zone", "timestamp", "vehicle_count", "status", "escalation_count", "last_update",
        "resolved_at").collect()), key=str)


def same(got, want):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_lifecycle_matches_the_loop(spark):
    windows = random_windows()
    want = walk(windows)
    assert {w[0] for w in want} == set(rules.ALERTS) and max(w[6] for w in want) > 2
    got = alerts.lifecycle(spark.createDataFrame(windows, SCHEMA))
    same(shaped(got), want)


@pytest.mark.parametrize("seconds_per_chunk", [600, 3600, 86_400])
def test_lifecycle_does_not_depend_on_the_chunks(spark, seconds_per_chunk):
    windows = random_windows(seed=6)
    frame = spark.createDataFrame(windows, SCHEMA)
    same(shaped(alerts.lifecycle(frame, seconds_per_chunk)), walk(windows))


def test_one_series_over_many_days_without_python(spark):
    rng, windows = random.Random(11), []
    for k in range(24 * 1000):  # hours; quiet ones are rare, so alerts last for days
        if rng.random() < 0.9:
            windows.append(("R", "Z", START + dt.timedelta(hours=k, minutes=rng.choice([0, 5, 9, 15])), 1.0, rng.choice([20.0, 35.0, 45.0]) if rng.random() < 0.995 else 70.0, 0.0))
    frame = alerts.lifecycle(spark.createDataFrame(windows, SCHEMA))
    got = shaped(frame)
    want = walk(windows)
    same(got, want)
    assert max(w[6] for w in want) > 100
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("MapInArrow", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroups"))
    assert alerts.lifecycle(spark.createDataFrame([], SCHEMA)).collect() == []


def test_series_without_road_or_zone(spark):
    t = lambda m: START + dt.timedelta(minutes=m)
    windows = [(None, "Z", t(1), 1.0, 20.0, 0.0), (None, "Z", t(5), 1.0, 70.0, 0.0), ("R", None, t(2), 1.0, 20.0, 0.0), (None, None, t(3), 1.0, 20.0, 0.0)]
    got = {(r[1], r[2]): (r[5], r[8]) for r in shaped(alerts.lifecycle(spark.createDataFrame(windows, SCHEMA)))}
    assert got == {(None, "Z"): ("RESOLVED", t(5)), ("R", None): ("ACTIVE", None), (None, None): ("ACTIVE", None)}


def test_durations_and_ids(spark):
    t = lambda m: START + dt.timedelta(minutes=m)
    frame = spark.createDataFrame(
        [("R", "Z", t(1), 1.0, 20.0, 0.0), ("R", "Z", t(4), 1.0, 45.0, 0.0), ("R", "Z", t(9), 1.0, 90.0, 0.0)], SCHEMA)
    got = {a.alert_type: a for a in alerts.lifecycle(frame).collect()}
    assert got["HIGH_CONGESTION"].duration_seconds == 480 and got["LOW_CONGESTION"].duration_seconds == 300
    assert got["HIGH_CONGESTION"].alert_id == f"HIGH_CONGESTION_R_Z_{int(t(1).replace(tzinfo=dt.timezone.utc).timestamp())}"


def test_outbox_channels(spark):
    windows = spark.createDataFrame([("R", "Z", START, 1.0, 20.0, None)], SCHEMA)
    alert = alerts.lifecycle(windows)
    assert [r.channel for r in notifications.outbox(alert).collect()] == ["email"]
    every = {r.channel: r for r in notifications.outbox(alert, {"email": True, "slack": True, "webhook": True}).collect()}
    assert every["email"].subject == "🚨 ALERTE TRAFIC - HIGH_CONGESTION sur R"
    assert "*Taux occupation:* N/A%" in every["slack"].body and every["slack"].body.startswith("🚨 *ALERTE TRAFIC*")
    assert '"occupancy_rate":null' in every["webhook"].body and '"is_escalation":false' in every["webhook"].body


# --- streams ---------------------------------------------------------------------

def message(sensor, at, speed, road="R1", zone="Z1"):
    return (f'{{"sensor_id":"{sensor}","road_id":"{road}","road_type":"rue","zone":"{zone}","vehicle_count":5,'
            f'"average_speed":{speed},"occupancy_rate":10.0,"event_time":"{at.isoformat()}"}}')


def write_file(spark, path, messages):
    spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.mode("append").text(path)


def run_alerts(spark, source, out, state):
    events = raw.stream_events(raw.text_stream(spark, source, max_files=1))
    changes = lifecycle.alert_changes(metrics.live_metrics(events))
    running = metrics.run(changes, lifecycle.keep_changes(out), state, trigger=None)
    running.awaitTermination()
    assert running.exception() is None
    return running


def test_stream_equals_batch_across_a_restart(spark, tmp_path):
    rng = random.Random(9)
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    minutes = [[message(f"S{m}-{i}", START + dt.timedelta(minutes=m, seconds=10 * i + 1),
                        rng.choice([20.0, 35.0, 45.0, 70.0, 70.0]), road)
                for i in range(2) for road in ("R1", "R2")] for m in range(40)]
    first, second = [x for m in minutes[:20] for x in m], [x for m in minutes[20:] for x in m]
    write_file(spark, source, first)
    run_alerts(spark, source, out, state)
    before = lifecycle.changes(spark, out).count()
    halfway = shaped(lifecycle.current_alerts(spark, out))
    lifecycle.take_snapshot(spark, out)
    same(shaped(lifecycle.current_alerts(spark, out)), halfway)
    write_file(spark, source, second)
    last = START + dt.timedelta(days=1)  # closes every window before it
    write_file(spark, source, [message("END", last, 70.0, "R9")])
    run_alerts(spark, source, out, state)
    assert lifecycle.changes(spark, out).count() > before

    lines = spark.createDataFrame([(x,) for x in first + second], "value string")
    batch = alerts.lifecycle(alerts.window_metrics(raw.parse_lines(lines)))
    same(shaped(lifecycle.current_alerts(spark, out)), shaped(batch))
    again = lifecycle.take_snapshot(spark, out)
    assert again == lifecycle.changes(spark, out).agg(F.max("batch")).first()[0]
    same(shaped(lifecycle.current_alerts(spark, out)), shaped(batch))
    assert lifecycle.announcements(spark, out).count() == batch.count() + batch.agg(F.sum("escalation_count")).first()[0]


def test_late_rows_are_dropped(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    t = lambda m, s=0: START + dt.timedelta(minutes=m, seconds=s)

    def run():
        events = raw.stream_events(raw.text_stream(spark, source, max_files=1))
        running = metrics.run(metrics.live_metrics(events), metrics.live_display(out), state, trigger=None)
        running.awaitTermination()

    write_file(spark, source, [message("a", t(0, 5), 50.0), message("b", t(10), 50.0)])
    run()
    write_file(spark, source, [message("late", t(0, 30), 10.0), message("c", t(9, 1), 40.0)])  # late and not too late
    run()
    write_file(spark, source, [message("z", t(60), 50.0)])
    run()
    got = {r.window_start: (r.event_count, r.avg_speed) for r in spark.read.parquet(out + "/*").collect()}
    as_local = {k.replace(tzinfo=None): v for k, v in got.items()}
    assert as_local == {t(0): (1, 50.0), t(9): (1, 40.0), t(10): (1, 50.0)}


def test_live_job_across_a_restart_and_a_new_checkpoint(spark, tmp_path):
    rng = random.Random(4)
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    lines = [message(f"S{m}", START + dt.timedelta(minutes=m, seconds=1), rng.choice([20.0, 35.0, 45.0, 70.0])) for m in range(30)]

    def go(state):
        running = jobs.live_alerts(raw.text_stream(spark, source, max_files=1), store, state, trigger=None, compact_every=1)
        running.awaitTermination()
        assert running.exception() is None

    write_file(spark, source, lines[:15])
    go(str(tmp_path / "state"))
    write_file(spark, source, [*lines[15:], "junk", message("END", START + dt.timedelta(days=1), 70.0, "R9")])
    go(str(tmp_path / "state"))
    batch = alerts.lifecycle(alerts.window_metrics(raw.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))))
    same(shaped(lifecycle.current_alerts(spark, store)), shaped(batch))
    sent = spark.read.parquet(f"{store}/outbox")
    assert sent.count() == batch.count() + batch.agg(F.sum("escalation_count")).first()[0]
    # the same messages again in a run of its own: its batches count on, and say the same about every alert
    go(str(tmp_path / "other"))
    assert {r.run for r in spark.read.parquet(f"{store}/runs").collect()} == {0, 1}
    same(shaped(lifecycle.current_alerts(spark, store)), shaped(batch))


def test_ended_stream_has_every_alert(spark, tmp_path):
    rng = random.Random(6)
    source, store, state = (str(tmp_path / n) for n in ("in", "store", "state"))
    lines = [message(f"S{m}", START + dt.timedelta(minutes=m, seconds=1), rng.choice([20.0, 35.0, 70.0])) for m in range(20)]
    write_file(spark, source, lines)

    def go():
        running = jobs.live_alerts(raw.text_stream(spark, source), store, state, trigger=None)
        running.awaitTermination()
        assert running.exception() is None
        return shaped(lifecycle.current_alerts(spark, store))

    want = shaped(alerts.lifecycle(alerts.window_metrics(raw.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string")))))
    assert go() != want
    jobs.end_alerts(spark, store, (START + dt.timedelta(days=1)).replace(tzinfo=dt.timezone.utc))
    same(go(), want)
    same(go(), want)


def test_reader_held_open_over_a_compaction(spark, tmp_path):
    out = str(tmp_path / "store")
    keep = lifecycle.keep_changes(out)
    change = spark.createDataFrame(
        [("A", START, START, None, START)], "alert_id string, timestamp timestamp, last_update timestamp, resolved_at timestamp, changed_at timestamp"
    ).withColumn("change", F.lit("OPENED"))
    keep(change, 0)
    early = lifecycle.current_alerts(spark, out)
    assert lifecycle.compact(spark, out) == 0
    keep(change.withColumn("alert_id", F.lit("B")), 1)
    between = lifecycle.current_alerts(spark, out)
    assert early.count() == 1
    assert lifecycle.compact(spark, out) == 1 and lifecycle.compact(spark, out) == 1
    assert between.count() == 2 and lifecycle.current_alerts(spark, out).count() == 2
    keep(change.withColumn("alert_id", F.lit("C")), 2)
    assert lifecycle.compact(spark, out) == 2
    assert lifecycle.current_alerts(spark, out).count() == 3
    assert {r.batch for r in lifecycle.changes(spark, out).select("batch").distinct().collect()} == {2}


def test_rejects_have_a_sink(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_file(spark, source, [message("a", START, 50.0), "junk", "{sensor_id: S, event_time: 2024-01-01T00:00:00}", '{"sensor_id": "x"}'])
    running = jobs.live_rejects(raw.text_stream(spark, source), out, str(tmp_path / "state"), trigger=None)
    running.awaitTermination()
    assert sorted(r.reject_reason for r in spark.read.parquet(out).collect()) == ["bad_json", "bad_time"]
    kept = raw.stream_events(spark.read.text(source))
    assert sorted(r.sensor_id for r in kept.collect()) == ["S", "a"]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "changes")
    frame = spark.range(3)
    keep = lifecycle.keep_changes(out)
    keep(frame, 0)
    keep(frame, 0)
    keep(frame, 1)
    assert lifecycle.changes(spark, out).count() == 6


def test_stream_landing(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    write_file(spark, source, [message("a", START, 50.0, zone="Zone A-1"), "junk"])
    running = landing.land_stream(raw.text_stream(spark, source), out, state, trigger=None)
    running.awaitTermination()
    assert running.exception() is None
    got = rows(spark.read.text(out).groupBy("date", "zone").count())
    assert [tuple(map(str, r)) for r in got] == [("2024-01-01", "Zone_A_1", "1"), ("quarantine", "Unknown", "1")]


def test_workspace_needs_a_shared_folder(spark):
    assert workspace.fresh_path(spark, "x").startswith(workspace.shared_root(spark))
    assert workspace.fresh_path(spark, "x") != workspace.fresh_path(spark, "x")


@pytest.mark.parametrize("kind", rules.ALERTS)
def test_escalation_limit_is_exclusive(spark, kind):
    limit, speed = rules.ALERTS[kind][4], rules.ALERTS[kind][0] - 1.0
    at = lambda s: START + dt.timedelta(seconds=s)
    frame = spark.createDataFrame(
        [("R", "Z", at(0), 1.0, speed, 0.0), ("R", "Z", at(limit), 1.0, speed, 0.0)], SCHEMA)
    assert alerts.lifecycle(frame).first().escalation_count == 0
    later = frame.union(spark.createDataFrame([("R", "Z", at(limit + 1), 1.0, speed, 0.0)], SCHEMA))
    assert alerts.lifecycle(later).first().escalation_count == 1


def test_dashboard_of_no_alerts_is_zero(spark):
    empty = spark.createDataFrame([], "alert_type string, severity string, count bigint, avg_vehicles double, "
                                      "avg_speed double, avg_occupancy double")
    got = {(r.section, r.key): r.value for r in alerts.dashboard_sections(empty).collect()}
    assert got == {("total_alerts", "all"): 0.0, ("average_metrics", "avg_vehicles"): 0.0,
                   ("average_metrics", "avg_speed"): 0.0, ("average_metrics", "avg_occupancy"): 0.0}


def test_active_summary(spark):
    frame = spark.createDataFrame(
        [("ACTIVE", "HIGH", "HIGH_CONGESTION", "Z1"), ("ACTIVE", "LOW", "LOW_CONGESTION", "Z1"),
         ("RESOLVED", "LOW", "LOW_CONGESTION", "Z2")], "status string, severity string, alert_type string, zone string")
    got = {(r.section, r.key): r.n for r in alerts.active_summary(frame).collect()}
    assert got == {("total_active", "all"): 2, ("by_severity", "HIGH"): 1, ("by_severity", "LOW"): 1,
                   ("by_type", "HIGH_CONGESTION"): 1, ("by_type", "LOW_CONGESTION"): 1, ("by_zone", "Z1"): 2}
