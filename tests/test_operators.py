"""Scheduling, safety, audit, views and validation on small literal tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftfold.operators import audit, safety, schedule, validate, views
from driftfold.plans import adapters, jobs
from driftfold.schema import SafetyLimits

NOW = dt.datetime(2026, 3, 1)


@pytest.fixture(scope="module")
def users(spark, sf):
    return adapters.users(spark, sf).cache()


def aged(users, **values):
    row = users.where("profile_status = 'public' and blog_status = 'absent' and pending_observation is null and last_check_result = 'ok'").limit(1)
    for name, value in values.items():
        row = row.withColumn(name, F.lit(value).cast(row.schema[name].dataType))
    return row


def due_in_hours(users, **values):
    base = {"last_checked_at": NOW, "last_confirmed_at": NOW, "first_checked_at": NOW - dt.timedelta(days=90), "profile_changed_at": None, "blog_changed_at": None}
    row = schedule.with_due(aged(users, **(base | values))).collect()[0]
    return (row.due_at - NOW).total_seconds() / 3600


@pytest.mark.parametrize(("profile", "blog", "days"), [("public", "present", 1), ("public", "absent", 3), ("hidden", "unknown", 6), ("missing", "unknown", 6), ("unknown", "unknown", 1), ("public", "unknown", 1)])
def test_intervals(users, profile, blog, days):
    assert due_in_hours(users, profile_status=profile, blog_status=blog) == 24 * days


@pytest.mark.parametrize(("failures", "hours"), [(1, 24), (2, 48), (3, 72), (9, 72), (5000, 72)])
def test_backoff(users, failures, hours):
    assert due_in_hours(users, last_check_result="timeout", consecutive_failures=failures) == hours


def test_recent_change_comes_sooner_once(users):
    changed = {"profile_status": "hidden", "blog_status": "unknown", "blog_changed_at": NOW - dt.timedelta(days=2)}
    assert due_in_hours(users, **changed) == 24 * 6
    assert due_in_hours(users, **changed | {"last_confirmed_at": NOW - dt.timedelta(days=2), "profile_status": "hidden"}) == 24 * 4
    assert due_in_hours(users, blog_changed_at=NOW - dt.timedelta(days=90)) == 24 * 3


@pytest.mark.parametrize(("cursor", "first", "wraps"), [(1, 11, False), (13, 13, False), (267, 11, True)])
def test_frontier(users, cursor, first, wraps):
    ten = users.where("id <= 10").withColumn("profile_status", F.lit("public")).withColumn("last_confirmed_at", F.lit(NOW))
    assert [r.id for r in schedule.frontier_probes(ten, cursor, 2).orderBy("seq").collect()] == [first, first + 1]


@pytest.mark.parametrize(("drop", "unknown", "want"), [([], [], 4), ([103], [], 2), ([], [102], 1), ([101], [], 0)])
def test_trailing_run(users, drop, unknown, want):
    base = users.limit(1).drop("id").crossJoin(users.sparkSession.range(100, 105)).withColumn("last_confirmed_at", F.lit(NOW))
    rows = base.withColumn("profile_status", F.when(F.col("id") == 100, "public").when(F.col("id").isin(*unknown or [0]), "unknown").otherwise("missing")).where(~F.col("id").isin(*drop or [0]))
    assert schedule.trailing_missing(rows).collect()[0].trailing == want


def test_trailing_run_and_gaps_across_ranges(users, monkeypatch):
    monkeypatch.setattr(schedule, "RANGE", 4)
    ids = users.sparkSession.range(1, 40).where("id not in (1, 7, 8, 20)")
    assert sorted(r.label for r in schedule.coverage_gaps(ids).collect()) == ["1", "20", "7-8"]
    base = users.limit(1).drop("id").crossJoin(users.sparkSession.range(10, 40)).withColumn("last_confirmed_at", F.lit(NOW))
    rows = base.withColumn("profile_status", F.when(F.col("id") == 10, "public").otherwise("missing")).where("id <> 33")
    assert schedule.trailing_missing(rows).collect()[0].trailing == 22


def streak(spark, results, neutral):
    rows = spark.createDataFrame([(1, i, r, n) for i, (r, n) in enumerate(zip(results, neutral, strict=True))], "batch int, seq long, check_result string, neutral boolean")
    done = safety.streaks(rows, ["batch"], F.col("check_result").isin("timeout", "network_error"), F.col("neutral"))
    return [r.streak for r in done.orderBy("seq").collect()]


def test_streaks_skip_neutral_rows(spark):
    assert streak(spark, ["timeout", "timeout", "timeout", "ok", "timeout"], [False, True, False, False, False]) == [1, 1, 2, 0, 1]
    assert streak(spark, ["timeout", "ok", "timeout"], [False, True, False]) == [1, 1, 2]


def batch(spark, rows):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "batch int, seq long, check_result string, results array<string>, neutral boolean, is_probe boolean, n_events int, elapsed double")


def test_stop_rules(spark):
    ok = ("ok", ["ok"], False, False, 0, 0.0)
    bad = ("timeout", ["timeout"], False, False, 0, 0.0)
    changed = ("ok", ["ok"], False, False, 3, 0.0)
    stop = lambda rows, **k: tuple(safety.stop_row(batch(spark, rows), ["batch"], **k).collect()[0][1:])
    assert stop([ok] * 5) == (None, None)
    assert stop([bad] * 12) == (9, "transient")
    assert stop([ok, ("ok", ["rate_limited", "ok"], False, False, 0, 0.0), *[bad] * 12]) == (1, "fatal")
    assert stop([changed] * 20) == (19, "mass_change")
    assert stop([changed] * 19 + [(*changed[:3], True, 3, 0.0)] * 5) == (None, None)
    assert stop([ok, ok, ("ok", ["ok"], False, False, 0, 99.0)], budget=50.0) == (1, "budget")
    assert stop([("parse_error", ["parse_error"], False, False, 0, 0.0)] * 9, limits=SafetyLimits(parse_failures=3)) == (2, "parse")


def test_audit_is_idempotent_and_rejects_conflicts(spark):
    old = spark.createDataFrame([("e1", 1), ("e2", 2)], "event_id string, v int")
    new = spark.createDataFrame([("e2", 2), ("e3", 3), ("e3", 3)], "event_id string, v int")
    assert sorted(tuple(r) for r in audit.append_events(old, new).collect()) == [("e1", 1), ("e2", 2), ("e3", 3)]
    with pytest.raises(audit.AuditConflict):
        audit.append_events(old, spark.createDataFrame([("e2", 9)], "event_id string, v int"))


def test_runs_finish_once(spark):
    schema = "run_id string, mode string, started_at timestamp_ntz, finished_at timestamp_ntz, start_id long, crawler_version string, attempted long"
    row = lambda end, mode="update", n=0: spark.createDataFrame([("r", mode, NOW, end, 1, "1", n)], schema)
    none, opened, closed = row(None).limit(0), row(None), row(NOW + dt.timedelta(hours=1), n=5)
    table, n = audit.append_runs(none, opened)
    assert n == 1
    table, n = audit.append_runs(table, closed)
    assert n == 1 and table.collect()[0].attempted == 5
    assert audit.append_runs(closed, closed)[1] == 0
    for wrong in (opened, row(NOW + dt.timedelta(hours=1), n=6), row(NOW, "other")):
        with pytest.raises(audit.AuditConflict):
            audit.append_runs(closed, wrong)


def test_views(spark, sf, users):
    health = adapters.health(spark, sf)
    csv = views.csv_text(users, health).splitlines()
    assert csv[0] == views.CSV_HEAD and len(csv) == 1 + users.where("blog_url is not null").count()
    quoted = views.csv_lines(spark.createDataFrame([(1, "p", 'https://x.example/?a="b",c', "unchecked", None)], "id long, profile_url string, blog_url string, health_status string, last_confirmed_at string")).collect()[0].line
    assert quoted == '1,p,"https://x.example/?a=""b"",c",unchecked,'
    page, _ = jobs.render("head\n<!--b-->old<!--e-->\ntail", users, health, "maintenance", None, "<!--b-->", "<!--e-->")
    assert page.startswith("head\n<!--b-->\n## ") and page.endswith("<!--e-->\ntail") and "`maintenance`" in page
    assert views.list_section(users.limit(0), health) == views.EMPTY_LIST
    with pytest.raises(ValueError, match="once each"):
        views.replace_section("no markers", "<!--b-->", "<!--e-->", "")
    empty = views.summary(users.limit(0)).collect()[0]
    assert (empty.record_count, empty.highest_existing_user_id, empty.n_public) == (0, 0, 0)


def test_sound_rows_have_no_issues(users):
    assert validate.validate_users(users).count() == 0


@pytest.mark.parametrize(
    ("field", "value", "code"),
    [("profile_url", "x", "profile_url"), ("http_status", 99, "http_status"), ("parser_version", "a b", "parser_version"), ("source_fingerprint", None, "fingerprint"), ("consecutive_failures", 2, "failure_count"), ("blog_url_raw", "https://x.example/", "absent_blog_url"), ("last_checked_at", None, "attempt_timestamps"), ("blog_url", "http://127.0.0.1/", "blog_url")],
)
def test_one_fault_one_code(users, field, value, code):
    assert code in {r.code for r in validate.validate_users(aged(users, **{field: value})).collect()}


def test_health_rows(spark, sf):
    sound = adapters.health(spark, sf).withColumn("failure_confirmed", F.col("consecutive_failures") >= 2)
    assert validate.validate_health(sound).count() == 0
    broken = sound.where("status = 'reachable'").limit(1).withColumn("redirect_count", F.lit(2).cast("long"))
    assert [r.code for r in validate.validate_health(broken).collect()] == ["health_redirects"]


def test_jobs_commit_a_prefix(spark, sf, users):
    label = '<li>博客：<a href="https://n{}.example/">n{}.example</a></li>'
    work = spark.createDataFrame([(0, 500, True), (1, 501, True), (2, 502, True)], "seq long, id long, is_probe boolean")
    schema = "user_id long, attempt int, fetched_at timestamp_ntz, outcome string, http_status int, body string, suspected_stale boolean, error string"
    page = lambda i, n: (i, n, NOW + dt.timedelta(minutes=n), "ok", 200, label.format(i, i), False, None)
    fetched = spark.createDataFrame([page(500, 1), page(500, 2), (501, 1, NOW, "rate_limited", 429, None, False, None), page(502, 1)], schema)
    done = jobs.commit_batch(work, fetched, users, adapters.SITE, "run-1", "update", F.lit(NOW), F.lit(NOW))
    assert (done.stop_reason, done.exit_code) == ("fatal", jobs.EXIT_SAFETY)
    assert sorted((r.id, r.blog_url, r.consecutive_failures) for r in done.users.collect()) == [(500, "https://n500.example/", 0), (501, None, 1)]
    run = done.run.collect()[0]
    assert (run.attempted, run.confirmed, run.errors, run.rate_limited, run.start_id, run.end_id) == (2, 1, 1, 1, 500, 501)


def test_boundary_and_resume(spark):
    rows = spark.createDataFrame([(i, 100 + i, i >= 3) for i in range(10)], "seq long, id long, is_missing boolean")
    assert tuple(jobs.boundary_candidate(rows, True, run=5).collect()[0]) == (7, 103)
    assert jobs.boundary_candidate(rows, False, run=5).collect()[0].stop_seq is None
    state = spark.createDataFrame([("maintenance", None)], "phase string, paused_from_phase string")
    assert jobs.resume(jobs.paused(state), True, True).collect()[0].phase == "maintenance"
    with pytest.raises(ValueError, match="acknowledgement"):
        jobs.resume(jobs.paused(state), False, True)
    with pytest.raises(ValueError, match="not paused"):
        jobs.resume(state, True, True)


def test_whole_dataset_validates(spark, sf, users):
    changes = spark.createDataFrame([("e", 10**9, "blog_added", '{"status":"absent","url":null}', '{"status":"present","url":"u"}')], "event_id string, user_id long, kind string, old_value string, new_value string")
    runs = spark.createDataFrame([("r", 1, 1, 0, 0, NOW, NOW)], "run_id string, attempted long, confirmed long, errors long, rate_limited long, started_at timestamp_ntz, finished_at timestamp_ntz")
    health = adapters.health(spark, sf).withColumn("failure_confirmed", F.col("consecutive_failures") >= 2)
    manifest = jobs.new_manifest(users, spark.createDataFrame([(NOW, NOW)], "last_successful_run_at timestamp_ntz, updated_at timestamp_ntz"), "maintenance", F.lit(NOW), True)
    top = views.summary(users).select(F.lit("maintenance").alias("phase"), F.lit(None).cast("string").alias("paused_from_phase"), "highest_attempted_id", "highest_confirmed_user_id", (F.col("highest_attempted_id") + 1).alias("next_id"), F.lit(None).cast("long").alias("boundary_candidate_start"), F.lit(False).alias("boundary_confirmation_pending"))
    found = jobs.validate_dataset(users, changes, runs, health, manifest, top)
    assert [r.code for r in found.collect()] == ["change_user_missing"]
    assert tuple(validate.report(found).collect()[0]) == (1, 0, False)
