"""Documents of one row, layouts, wire forms, what comes in, and the update command end to end."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from driftfold.functions import scalars, web
from driftfold.operators import safety, validate
from driftfold.plans import adapters, jobs
from driftfold.schema import MANIFEST_COLUMNS, STATE_COLUMNS, USER_COLUMNS, SafetyLimits
from driftfold.sources import layout, records, singletons

NOW = dt.datetime(2026, 3, 1)
STATE = {"boundary_candidate_start": None, "boundary_confirmation_pending": False, "consecutive_missing_after_frontier": 0, "highest_attempted_id": 9, "highest_confirmed_user_id": 7, "last_run_id": "r", "maintenance_cursor": 3, "next_id": 10, "paused_from_phase": None, "phase": "maintenance", "schema_version": 1, "updated_at": "2026-03-01T00:00:00Z"}


def test_missing_documents_are_defaults(spark, tmp_path):
    state = singletons.read_state(spark, str(tmp_path / "none.json")).first().asDict()
    assert state == dict.fromkeys(STATE_COLUMNS) | {"boundary_confirmation_pending": False, "consecutive_missing_after_frontier": 0, "highest_attempted_id": 0, "highest_confirmed_user_id": 0, "maintenance_cursor": 1, "next_id": 1, "phase": "bootstrap", "schema_version": 1}
    manifest = singletons.read_manifest(spark, str(tmp_path / "none.json")).first()
    assert (manifest.record_count, manifest.n_public, manifest.phase, manifest.initialization_status) == (0, 0, "bootstrap", "not_started")
    assert set(singletons.read_loosely(spark, str(tmp_path / "none.json"), MANIFEST_COLUMNS).first()) == {None}


@pytest.mark.parametrize(
    ("change", "why"),
    [
        (lambda t: t, None),
        (lambda t: json.dumps(json.loads(t), indent=1), None),
        (lambda t: t[:-1], "invalid JSON"),
        (lambda t: t.replace('"phase"', '"next_id": 1, "phase"'), "invalid JSON"),
        (lambda t: f"[{t}]", "must be an object"),
        (lambda t: t.replace('"next_id": 10', '"next_id": "10"'), "not canonically"),
        (lambda t: t.replace('"next_id": 10, ', ""), "not canonically"),
        (lambda t: t.replace("00Z", "00.5Z"), "not canonically"),
        (lambda t: t.replace('"phase"', '"more": 1, "phase"'), "not canonically"),
    ],
)
def test_strict_documents(spark, tmp_path, change, why):
    path = tmp_path / "crawler.json"
    path.write_text(change(json.dumps(STATE)))
    if why is None:
        assert singletons.read_state(spark, str(path)).first().asDict() == STATE | {"updated_at": NOW}
    else:
        with pytest.raises(singletons.CorruptDocument, match=why):
            singletons.read_state(spark, str(path))


def test_documents_round_trip(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps(STATE))
    out = str(tmp_path / "out")
    state = singletons.read_state(spark, str(tmp_path / "in.json"))
    singletons.write_state(state, out)
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert text == json.dumps(STATE, indent=2, sort_keys=True, ensure_ascii=False) + "\n"
    # Written over what it is read from.
    singletons.write_state(singletons.read_state(spark, out).withColumn("next_id", F.lit(11)), out)
    assert singletons.read_state(spark, out).first().next_id == 11
    users = adapters.users(spark, "/root/testdata/sf0.001")
    manifest = jobs.new_manifest(users, singletons.read_manifest(spark, str(tmp_path / "none.json")), "maintenance", F.lit(NOW).cast("timestamp_ntz"), True)
    singletons.write_manifest(manifest, out)
    again = singletons.read_manifest(spark, out).first()
    assert (again.record_count, again.last_successful_run_at, again.n_hidden) == (users.count(), NOW, users.where("profile_status = 'hidden'").count())


def test_user_lines_round_trip(spark, sf, tmp_path):
    users = adapters.users(spark, sf).where("id < 1000")
    records.export_json(users, str(tmp_path / "out"), ["id"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert all(line == json.dumps(json.loads(line), sort_keys=True, ensure_ascii=False, separators=(",", ":")) for line in text.splitlines())
    os.makedirs(tmp_path / "users")
    (tmp_path / "users" / "00000-00999.jsonl").write_text(text)
    rows, faults = records.read_shards(spark, str(tmp_path / "users"), USER_COLUMNS)
    assert faults.count() == 0 and rows.exceptAll(users).count() == 0 == users.exceptAll(rows).count()
    assert records.read_rendered(spark, str(tmp_path / "users"), USER_COLUMNS).count() == users.count()
    (tmp_path / "users" / "01000-01999.jsonl").write_text(text.splitlines()[0] + "\n")
    with pytest.raises(ValueError, match="twice"):
        records.read_rendered(spark, str(tmp_path / "users"), USER_COLUMNS)


def test_empty_year_file(spark, tmp_path):
    (tmp_path / "2026.jsonl").write_text('{"at":"2026-01-01T00:00:00Z","event_id":"e","user_id":1}\n')
    (tmp_path / "2025.jsonl").write_text("")
    (tmp_path / ".gitkeep").write_text("")
    rows, faults = records.read_years(spark, str(tmp_path), {"at": "string", "event_id": "string", "user_id": "bigint"}, "event_id", "at")
    assert rows.count() == 1 and [tuple(r) for r in faults.collect()] == [("2025.jsonl", 0, "empty file")]


def test_layout(spark, tmp_path):
    for folder in ("data/users", "data/changes", "data/runs", "state"):
        os.makedirs(tmp_path / folder)
    for name in ("data/manifest.json", "data/.gitkeep", "data/runs/.gitkeep", "state/crawler.json"):
        (tmp_path / name).write_text("")
    assert layout.dataset_faults(spark, str(tmp_path)).count() == 0
    (tmp_path / "data" / "more.json").write_text("")
    (tmp_path / "data" / "changes" / ".gitkeep").write_text("x")
    (tmp_path / "data" / "changes" / "2026.jsonl").symlink_to(tmp_path / "data" / "manifest.json")
    (tmp_path / "data" / "blogs.csv").mkdir()
    assert sorted(tuple(r) for r in layout.dataset_faults(spark, str(tmp_path)).collect()) == [
        ("data", "blogs.csv", "must be a file"), ("data", "more.json", "unexpected entry"), ("data/changes", ".gitkeep", "must be empty"), ("data/changes", "2026.jsonl", "must be a file"),
    ]
    assert layout.dataset_faults(spark, str(tmp_path / "none")).count() == 0
    health, faults = records.read_health(spark, str(tmp_path / "none.jsonl"))
    assert health.count() == faults.count() == 0


def test_bodies_and_delays():
    assert web.decoded("é".encode("latin-1"), "text/html; charset=ISO-8859-1") == "é"
    assert web.decoded("你".encode("gb18030"), 'text/html; charset="gb18030"') == "你"
    assert web.decoded(b"a\xff", None) == web.decoded(b"a\xff", "text/html; charset=none") == web.decoded(b"a\xff", "x; charset=ascii") == "a�"
    assert web.decoded(b"", None) == ""
    assert web.crawl_delay("User-agent: *\nCrawl-delay: 4\n\nUser-agent: me\nCrawl-delay: 2\n", "me") == 2
    assert web.crawl_delay("User-agent: *\nCrawl-delay: 4\n", "me") == 4
    assert web.crawl_delay("User-agent: *\nDisallow:\n", "me") is None is web.crawl_delay(None, "me")


def test_waits(spark):
    rows = spark.createDataFrame([(1, None, 0.5), (2, None, 1.0), (2, None, 0.0), (3, None, 0.5), (1, 7.0, 0.5), (1, 121.0, 0.5)], "n int, after double, jitter double")
    got = [r[0] for r in rows.select(scalars.retry_wait(F.col("n"), F.col("after"), F.col("jitter"))).collect()]
    assert got == pytest.approx([3.0, 7.2, 4.8, None, 7.0, None])


def walk(spark, ids, phase="bootstrap", start=None, missing=0, known=True, run=3):
    """ids: text, one letter an id from 10 on: e(xisting), m(issing), u(nclear)."""
    rows = spark.createDataFrame([(1, i, 10 + i, c == "e", c == "m", c != "u") for i, c in enumerate(ids)], "batch int, seq long, id long, is_existing boolean, is_missing boolean, clean boolean")
    first = F.struct(*[F.lit(v) for v in (phase, 10, start, missing, known, None, None)])
    r = safety.bootstrap_walk(rows, ["batch"], first, run).first()
    return r.phase, r.next_id, r.start, r.missing, r.stop


def test_bootstrap_walks(spark):
    assert walk(spark, "emme") == ("bootstrap", 14, None, 0, None)
    assert walk(spark, "emmmee") == ("boundary_confirmation", 11, 11, 3, "found")
    assert walk(spark, "mm", missing=1)[:3] == ("boundary_confirmation", 9, 9)
    assert walk(spark, "mmmm", known=False) == ("bootstrap", 14, None, 0, None)
    assert walk(spark, "mmumm") == ("bootstrap", 15, None, 2, None)
    confirming = {"phase": "boundary_confirmation", "start": 10}
    assert walk(spark, "mmmm", **confirming) == ("maintenance", 13, None, 0, "confirmed")
    assert walk(spark, "mu", **confirming) == ("boundary_confirmation", 10, 10, 0, "unclear")
    assert walk(spark, "memmm", **confirming) == ("boundary_confirmation", 12, 12, 3, "found")


def test_bootstrap_state(spark, tmp_path):
    state = singletons.read_state(spark, str(tmp_path / "none.json"))
    rows = spark.createDataFrame([(i, 1 + i, i < 2, i >= 2, True) for i in range(6)], "seq long, id long, is_existing boolean, is_missing boolean, clean boolean")
    moved, why = jobs.bootstrap_state(state, rows, "r1", F.lit(NOW), run=3)
    row = moved.first()
    assert why == safety.BOUNDARY_STOPS["found"]
    assert (row.phase, row.next_id, row.boundary_candidate_start, row.boundary_confirmation_pending, row.highest_attempted_id, row.highest_confirmed_user_id) == ("boundary_confirmation", 3, 3, True, 5, 2)
    again, why = jobs.bootstrap_state(moved, rows.where("id >= 3"), "r2", F.lit(NOW), run=3)
    assert why == safety.BOUNDARY_STOPS["confirmed"]
    assert (again.first().phase, again.first().next_id, again.first().maintenance_cursor, again.first().boundary_confirmation_pending) == ("maintenance", 6, 1, False)
    assert jobs.bootstrap_state(state, rows.limit(0), "r", F.lit(NOW))[1] is None


def test_cursor(spark):
    probes = lambda *ids: spark.createDataFrame(list(enumerate(ids)), "seq long, id long")
    assert safety.next_cursor(probes(8, 9), 8, 4, 1).first()[0] == 10
    assert safety.next_cursor(probes(10, 11), 8, 4, 1).first()[0] == 8
    assert safety.next_cursor(probes(1).limit(0), 8, 4, 5).first()[0] == 5


def test_sound_observations_and_changes(spark, sf):
    assert validate.validate_observations(adapters.observations(spark, sf)).count() == 0
    tidy = validate.tidy_observations(spark.createDataFrame([("public", "present", "HTTP://A.example", " ", "ok", " a \n b ", None)], "profile_status string, blog_status string, blog_url string, blog_url_raw string, check_result string, error string, source_fingerprint string")).first()
    assert (tidy.blog_url, tidy.blog_url_raw, tidy.error, len(tidy.source_fingerprint)) == ("http://a.example/", None, "a b", 64)


def test_guards():
    with pytest.raises(ValueError, match="limit must be positive"):
        jobs.positive(limit=0)
    with pytest.raises(ValueError, match="in \\(0, 1\\]"):
        jobs.ratio(mass_ratio=1.5)


def update(spark, sf, state, pages, **more):
    users = adapters.users(spark, sf).where("id <= 20")
    none = lambda names: spark.createDataFrame([], names)
    changes = none("event_id string, user_id long, changed_at timestamp_ntz, kind string, old_value string, new_value string, run_id string")
    runs = none("run_id string, mode string, started_at timestamp_ntz, finished_at timestamp_ntz, start_id long, end_id long, attempted long, confirmed long, changed long, errors long, rate_limited long, stopped_reason string, crawler_version string")
    fetched = spark.createDataFrame(pages, "user_id long, attempt int, fetched_at timestamp_ntz, outcome string, http_status int, body string, suspected_stale boolean, error string")
    manifest = singletons.default_row(spark, MANIFEST_COLUMNS, {})
    now = F.lit(NOW).cast("timestamp_ntz")
    return users, jobs.update(users, changes, runs, state, singletons.flat(manifest), fetched, adapters.SITE, "run-1", now, now, existing_limit=50, new_limit=2, sweep=4, **more)


def state_row(spark, **changed):
    values = STATE | {"updated_at": NOW, "highest_attempted_id": 20, "highest_confirmed_user_id": 20, "maintenance_cursor": 1} | changed
    return spark.createDataFrame([tuple(values[c] for c in STATE_COLUMNS)], ", ".join(f"{c} {k}" for c, k in STATE_COLUMNS.items()))


def test_update_end_to_end(spark, sf):
    page = lambda i, n=1, outcome="ok", status=200: (i, n, NOW + dt.timedelta(minutes=n), outcome, status, f'<li>博客：<a href="https://n{i}.example/">n{i}.example</a></li>' if outcome == "ok" else None, False, None)
    frontier = adapters.users(spark, sf).where("id <= 20").where(scalars.existing()).agg(F.max("id")).first()[0] + 1
    users, done = update(spark, sf, state_row(spark), [page(frontier), page(frontier, 2), page(frontier + 1, outcome="rate_limited", status=429)])
    state = done.state.first()
    assert (state.phase, state.paused_from_phase, state.maintenance_cursor, state.last_run_id, state.highest_attempted_id, state.highest_confirmed_user_id) == ("paused", "maintenance", frontier + 2, "run-1", frontier + 1, frontier)
    run = done.runs.first()
    why = jobs.STOP_TEXTS["rate_limited"]
    assert (run.attempted, run.confirmed, run.errors, run.start_id, run.end_id, run.stopped_reason, done.outcome.exit_code) == (2, 1, 1, frontier, frontier + 1, why, jobs.EXIT_SAFETY)
    assert done.users.count() == users.select("id").union(spark.createDataFrame([(frontier,), (frontier + 1,)], "id long")).distinct().count()
    manifest = done.manifest.first()
    assert (manifest.phase, manifest.last_successful_run_at, manifest.record_count) == ("paused", None, done.users.count())
    assert json.loads(done.summary) == {"attempted": 2, "changed": run.changed, "confirmed": 1, "errors": 1, "phase": "paused", "run_id": "run-1", "stopped_reason": why}


def test_update_refuses(spark, sf):
    with pytest.raises(jobs.SafetyStop):
        update(spark, sf, state_row(spark, phase="paused", paused_from_phase="maintenance"), [])
    with pytest.raises(ValueError, match="bootstrap"):
        update(spark, sf, state_row(spark, phase="bootstrap"), [])
    with pytest.raises(ValueError, match="mass_ratio"):
        update(spark, sf, state_row(spark), [], limits=SafetyLimits(mass_ratio=2.0))
