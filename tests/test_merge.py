"""The fold against a plain state machine, and its invariants."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftfold.functions.scalars import profile_fingerprint
from driftfold.operators import merge
from driftfold.schema import OBSERVATION_COLUMNS, ddl
from driftfold.streaming import merge_stream

START = dt.datetime(2026, 1, 1)
VALUES = [("public", "present", "https://a.example/"), ("public", "present", "https://b.example/"), ("public", "absent", None), ("hidden", "unknown", None), ("missing", "unknown", None), ("fail", None, None)]
SCHEMA = ddl({k: v for k, v in OBSERVATION_COLUMNS.items() if k != "source_fingerprint"}) + ", seq long"


def observation(user, seq, second, value, status=200):
    profile, blog, url = value
    at = START + dt.timedelta(seconds=second)
    if profile == "fail":
        return ("unknown", None, None, "timeout", "slow", None, at, "1.0.0", "unknown", user, seq)
    return (blog, url, url, "ok", None, status, at, "1.0.0", profile, user, seq)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA.replace("source_fingerprint string, ", ""))


def plain(rows):
    """The rules, one row at a time."""
    s = dict(p="unknown", b="unknown", u=None, fails=0, conf=None, first=None, last=None, pend=None, events=[], pat=None, bat=None, result=None)
    for blog, url, _, result, _, _, at, _, profile, _, _ in sorted(rows, key=lambda r: (r[6], r[10])):
        s["first"], s["last"], s["result"] = s["first"] or at, at, result
        if result != "ok":
            s["fails"] += 1
            continue
        s["fails"] = 0
        new, old = (profile, blog, url), (s["p"], s["b"], s["u"])
        if s["conf"] and new == old:
            s["conf"], s["pend"] = at, None
            continue
        if s["conf"] or blog == "present":
            if s["pend"] and s["pend"][0] == new:
                if at > s["pend"][2]:
                    s["pend"] = (new, s["pend"][1] + 1, at)
            else:
                s["pend"] = (new, 1, at)
            if s["pend"][1] < 2:
                continue
        if s["conf"]:
            if profile != s["p"]:
                s["events"].append("profile_status")
            if (blog, url) != old[1:]:
                s["events"].append("blog_added" if s["b"] != "present" and blog == "present" else "blog_removed" if s["b"] == "present" and blog == "absent" else "blog_changed")
        if not s["conf"] or profile != s["p"]:
            s["pat"] = at
        if not s["conf"] or (blog, url) != old[1:]:
            s["bat"] = at
        s["p"], s["b"], s["u"], s["conf"], s["pend"] = *new, at, None
    return s


def check(folded, rows):
    got = {r.user_id: r.state for r in folded.collect()}
    for user in {r[9] for r in rows}:
        want, s = plain([r for r in rows if r[9] == user]), got[user]
        assert (s.profile_status, s.blog_status, s.blog_url, s.consecutive_failures, s.last_confirmed_at) == (want["p"], want["b"], want["u"], want["fails"], want["conf"])
        assert (s.first_checked_at, s.last_checked_at, s.last_check_result, s.profile_changed_at, s.blog_changed_at) == (want["first"], want["last"], want["result"], want["pat"], want["bat"])
        p = s.pending_observation
        assert (p and (p.profile_status, p.blog_status, p.blog_url, p.confirmations, p.last_observed_at)) == (want["pend"] and (*want["pend"][0], *want["pend"][1:]))
        assert [e.kind for e in s.events] == want["events"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 12), st.sampled_from(VALUES)), min_size=1, max_size=40))
def test_fold_is_the_state_machine(spark, items):
    rows = [observation(user, i, second, value) for i, (user, second, value) in enumerate(items)]
    check(merge.fold_observations(frame(spark, rows)), rows)


def test_fold_in_rounds_and_over_records(spark):
    rows = [observation(1 + i % 2, i, i, VALUES[(i * 7 + i // 5) % 6]) for i in range(60)]
    check(merge.fold_observations(frame(spark, rows), chunk=7), rows)
    half = merge.fold_observations(frame(spark, rows[:30]))
    rest = merge.fold_observations(frame(spark, rows[30:]), merge.records(half, "https://site.example/user/"))
    whole = {r.user_id: r.state for r in merge.fold_observations(frame(spark, rows)).collect()}
    for r in rest.collect():
        assert r.state.asDict() | {"events": None} == whole[r.user_id].asDict() | {"events": None}


def test_replay_and_order_do_not_count(spark):
    a, b = VALUES[0], VALUES[2]
    rows = [observation(1, 0, 0, a)]
    state = merge.fold_observations(frame(spark, rows * 3)).collect()[0].state
    assert state.pending_observation.confirmations == 1 and state.last_confirmed_at is None
    rows += [observation(1, 1, 60, a), observation(1, 2, 120, b), observation(1, 3, 180, VALUES[5]), observation(1, 4, 240, b)]
    state = merge.fold_observations(frame(spark, rows)).collect()[0].state
    assert (state.blog_status, [e.kind for e in state.events]) == ("absent", ["blog_removed"])


def test_hidden_after_blog_gives_two_events(spark):
    rows = [observation(1, i, i, v) for i, v in enumerate([VALUES[0], VALUES[0], VALUES[3], VALUES[3]])]
    events = merge.change_events(merge.fold_observations(frame(spark, rows)), F.lit("r1")).orderBy("kind").collect()
    assert [(e.kind, e.old_value, e.new_value) for e in events] == [
        ("blog_changed", '{"status":"present","url":"https://a.example/"}', '{"status":"unknown","url":null}'),
        ("profile_status", '"public"', '"hidden"'),
    ]
    assert len({e.event_id for e in events}) == 2 and all(len(e.event_id) == 24 for e in events)


def test_stream_equals_batch(spark):
    rows = [observation(1 + i % 3, i, i, VALUES[(i * 5) % 6]) for i in range(45)]
    obs = frame(spark, rows)
    stream = {r.user_id: r.state for r in merge_stream.replay(obs, 4).collect()}
    assert stream == {r.user_id: r.state for r in merge.fold_observations(obs).collect()}


def test_hot_entities_go_on_from_their_states(spark):
    rows = [observation(1 if i % 4 else 2 + i % 3, i, i, VALUES[(i * 5) % 6]) for i in range(60)]
    first = merge.fold_over(frame(spark, rows[:20]), None, chunk=6)
    both = {r.user_id: r.state for r in merge.fold_over(frame(spark, rows[20:]), first, chunk=6).collect()}
    assert both == {r.user_id: r.state for r in merge.fold_observations(frame(spark, rows)).collect()}


def test_old_versions_go(spark, tmp_path):
    rows = [observation(1 + i % 2, i, i, VALUES[(i * 5) % 6]) for i in range(30)]
    table = merge_stream.StateTable(spark, f"file://{tmp_path}/state", shards=1)
    fold = merge_stream.fold_batch(table)
    for epoch in range(5):
        fold(frame(spark, rows[6 * epoch : 6 * epoch + 6]), epoch)
    assert table.all_versions() == {0: [4, 3, 2]}
    fold(frame(spark, rows[24:]), 4)
    assert {r.user_id: r.state for r in table.read().collect()} == {r.user_id: r.state for r in merge.fold_observations(frame(spark, rows)).collect()}


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    rows = [observation(1 + i % 5, i, i, VALUES[(i * 5) % 6]) for i in range(40)]
    table = merge_stream.StateTable(spark, f"file://{tmp_path}/state", shards=3)
    fold = merge_stream.fold_batch(table)
    for epoch in (0, 1, 1, 1):
        fold(frame(spark, rows[20 * epoch : 20 * epoch + 20]), epoch)
    fold(frame(spark, rows).limit(0), 2)
    again = {r.user_id: r.state for r in merge_stream.StateTable(spark, f"file://{tmp_path}/state", 3).read().collect()}
    assert again == {r.user_id: r.state for r in merge.fold_observations(frame(spark, rows)).collect()}


@pytest.mark.parametrize(("statuses", "failures"), [(["client_error"], 1), (["client_error", "timeout"], 2), (["client_error", "client_error", "reachable"], 0), (["reachable", "timeout"], 1)])
def test_link_strikes(spark, statuses, failures):
    checks = spark.createDataFrame([("u", i, s) for i, s in enumerate(statuses)], "url string, seq long, status string")
    row = merge.fold_link_checks(checks).collect()[0]
    assert (row.consecutive_failures, row.failure_confirmed) == (failures, failures >= 2)


def test_fingerprint_is_of_canonical_json(spark):
    import hashlib

    got = spark.range(1).select(profile_fingerprint(F.lit("public"), F.lit("absent"), F.lit(None).cast("string"))).collect()[0][0]
    assert got == hashlib.sha256(b'{"blog_status":"absent","blog_url":null,"profile_status":"public"}').hexdigest()
