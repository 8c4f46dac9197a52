"""The engine's commands as jobs over tables; times and run ids are always parameters.

A job reads tables, returns tables and raises only at its edge; writing them is the caller's last step, so a job
that fails leaves nothing half done.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftfold.functions.scalars import existing
from driftfold.operators import audit, merge, responses, safety, schedule, validate, views
from driftfold.schema import BOUNDARY_RUN, SafetyLimits, SchedulePolicy

# Exit codes of the commands.
EXIT_OK, EXIT_OTHER, EXIT_USAGE, EXIT_SAFETY, EXIT_INVALID = 0, 1, 2, 3, 4


# How a run row tells why its batch ended.
STOP_TEXTS = {
    None: "maintenance batch completed",
    "budget": "time budget reached",
    "parse": "consecutive parse/staleness safety threshold reached",
    "transient": "consecutive transport/HTTP safety threshold reached",
    "mass_change": "mass-change safety threshold reached",
    "blocked_or_challenge": "source returned a block/challenge or disallowed the crawler",
    "rate_limited": "source remained rate-limited after polite retries",
}


class SafetyStop(RuntimeError):
    """A command that must not start: EXIT_SAFETY is its exit code."""


def _guard(ok: bool, name: str, rule: str) -> None:
    if not ok:
        raise ValueError(f"{name} must be {rule}")


def positive(**values: float) -> None:
    for name, value in values.items():
        _guard(value > 0, name, "positive")


def ratio(**values: float) -> None:
    for name, value in values.items():
        _guard(0 < value <= 1, name, "in (0, 1]")


@dataclass(frozen=True)
class Outcome:
    """What a batch changes: records, change events, one run row, its stop, the exit code, and the rows it committed."""

    users: DataFrame
    events: DataFrame
    run: DataFrame
    stop_reason: str | None
    exit_code: int
    kept: DataFrame


def commit_batch(work: DataFrame, fetched: DataFrame, users: DataFrame, site: str, run_id: str, mode: str, started_at: Column, finished_at: Column, limits: SafetyLimits = SafetyLimits(), budget: float | None = None, neutral_retries: bool = True) -> Outcome:
    """Observe a work list (seq, id, is_probe) from captured pages (user_id, attempt, ...), and commit up to the stop row.

    The stop row is found before anything is folded for good: later rows were never visited.
    """
    seen = responses.observations(fetched).join(fetched.select("user_id", "fetched_at", "attempt").withColumnRenamed("fetched_at", "observed_at"), ["user_id", "observed_at"])
    listed = seen.join(work.select("seq", F.col("id").alias("user_id"), "is_probe"), "user_id")
    tried = listed.groupBy("user_id", "seq", "is_probe").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("attempt", "check_result"))), lambda x: x["check_result"]).alias("results"),
        F.count("*").alias("attempts"), F.max_by("check_result", "attempt").alias("check_result"), F.max_by("http_status", "attempt").alias("http_status"), F.max_by("error", "attempt").alias("error"), F.max_by("parser_version", "attempt").alias("parser_version"),
    )
    before = users.select(
        F.col("id").alias("user_id"), F.col("last_check_result").alias("prev_result"), F.col("last_error").alias("prev_error"), F.col("parser_version").alias("prev_parser_version"),
        F.col("http_status").alias("prev_http_status"), F.col("pending_observation").isNotNull().alias("prev_pending"),
    )
    obs = listed.select("user_id", F.col("attempt").cast("long").alias("seq"), "observed_at", "profile_status", "blog_status", "blog_url", "blog_url_raw", "check_result", "http_status", "error", "parser_version", "source_fingerprint")
    touched = users.join(work.select("id"), "id", "left_semi")
    # A batch is bounded by its work list, and its fold is read by all that follows.
    folded = merge.fold_observations(obs, touched).persist()
    counted = folded.select("user_id", F.size("state.events").alias("n_events"), (F.col("state.last_confirmed_at") == F.col("state.last_checked_at")).alias("confirmed"))
    rows = tried.join(before, "user_id", "left").join(counted, "user_id").withColumn("batch", F.lit(run_id)).withColumn("prev_pending", F.coalesce("prev_pending", F.lit(False)))
    rows = rows.withColumn("neutral", safety.stable_known_failure() if neutral_retries else F.lit(False)).withColumn("confirmed", F.coalesce("confirmed", F.lit(False))).persist()
    stops = safety.stop_row(rows, ["batch"], limits, budget)
    kept = safety.prefix(rows, stops, ["batch"])
    done = folded.join(kept.select("user_id"), "user_id", "left_semi")
    reason = next((r["stop_reason"] for r in stops.collect()), None)
    counters = safety.run_counters(kept, ["batch"])
    start = work.agg(F.min_by("id", "seq").alias("start_id"))
    run = counters.crossJoin(start).select(
        F.lit(run_id).alias("run_id"), F.lit(mode).alias("mode"), started_at.alias("started_at"), finished_at.alias("finished_at"), "start_id", "end_id", "attempted", "confirmed", "changed", "errors", "rate_limited", F.lit(reason).cast("string").alias("stopped_reason"),
    )
    return Outcome(merge.records(done, site), merge.change_events(done, F.lit(run_id)), run, reason, EXIT_SAFETY if reason and reason != "budget" else EXIT_OK, kept)


def update_plan(users: DataFrame, now: Column, cursor: int, existing_limit: int = 500, new_limit: int = 64, sweep: int = BOUNDARY_RUN, policy: SchedulePolicy = SchedulePolicy()) -> DataFrame:
    """The work list of an update: frontier probes, then due records."""
    positive(existing_limit=existing_limit, new_limit=new_limit, sweep=sweep)
    return schedule.work_list(users, now, cursor, existing_limit, new_limit, sweep, policy)


def bootstrap_plan(users: DataFrame, next_id: int, most: int = 4000) -> DataFrame:
    """The work list of a bootstrap chunk."""
    positive(next_id=next_id, most=most)
    return schedule.id_range(users.sparkSession, next_id, most).select((F.col("id") - next_id).alias("seq"), "id", F.lit(False).alias("is_probe"))


def boundary_candidate(rows: DataFrame, existing_known: bool, run: int = BOUNDARY_RUN) -> DataFrame:
    """One row (stop_seq, start_id): where a bootstrap batch meets `run` consecutive confirmed-missing ids, if it does.

    rows: seq, id, is_missing. Nothing counts before some user is known to exist.
    """
    marked = rows.withColumn("batch", F.lit(0))
    counted = safety.streaks(marked, ["batch"], F.col("is_missing"), F.lit(False))
    found = counted.where((F.col("streak") >= run) & F.lit(existing_known)).agg(F.min("seq").alias("stop_seq"), F.min("id").alias("at"))
    return found.select("stop_seq", (F.col("at") - run + 1).alias("start_id"))


def check_links(urls: DataFrame, health: DataFrame, captured: DataFrame, now: Column, limit: int = 200) -> DataFrame:
    """New health rows of the links due: captured hops walked, then two-strike confirmation against the old row."""
    positive(limit=limit)
    due = schedule.due_links(urls, health, now, limit).select("url")
    walked = responses.walk_redirects(captured.join(due, "url", "left_semi"))
    old = health.select("url", F.col("status").alias("old_status"), F.col("consecutive_failures").alias("old_failures"))
    well, was_well = F.col("status").isin("reachable", "redirected"), F.coalesce(F.col("old_status").isin("reachable", "redirected"), F.lit(False))
    failures = F.when(well, 0).otherwise(F.when(F.col("old_status").isNotNull() & ~was_well, F.coalesce("old_failures", F.lit(0)) + 1).otherwise(1)).cast("long")
    return walked.join(old, "url", "left").select(
        F.lit(1).cast("long").alias("attempts"), now.alias("checked_at"), failures.alias("consecutive_failures"), "error", (failures >= 2).alias("failure_confirmed"), "final_url", "http_status", F.col("redirect_count").cast("long").alias("redirect_count"), "status", "url",
    )


def stored_health(health: DataFrame, checked: DataFrame) -> DataFrame:
    """The health table after a batch of checks: checked links over old ones, one row a URL."""
    return audit.overlay(health, checked.select(*health.columns), "url")


@dataclass(frozen=True)
class Update:
    """All tables after an update, to be written in this order, and its summary as one JSON line."""

    users: DataFrame
    changes: DataFrame
    state: DataFrame
    runs: DataFrame
    manifest: DataFrame
    outcome: Outcome
    summary: str


def next_state(state: DataFrame, kept: DataFrame, records: DataFrame, run_id: str, at: Column, sweep: int = BOUNDARY_RUN, frontier: int | None = None) -> DataFrame:
    """The control row after committed rows (seq, user_id, is_probe) with their new records: maxima, cursor, run and time."""
    row = state.select("highest_attempted_id", "highest_confirmed_user_id", "maintenance_cursor").first()
    seen = kept.select(F.col("user_id").alias("id"), "seq", "is_probe").join(records.select("id", existing().alias("is_existing")), "id")
    top = safety.advance_state(seen, row["highest_attempted_id"], row["highest_confirmed_user_id"])
    start = row["highest_confirmed_user_id"] + 1 if frontier is None else frontier
    cursor = safety.next_cursor(seen.where("is_probe"), start, sweep, row["maintenance_cursor"])
    kept_columns = state.drop("highest_attempted_id", "highest_confirmed_user_id", "maintenance_cursor")
    # Three single rows side by side.
    moved = kept_columns.crossJoin(top).crossJoin(cursor).withColumn("last_run_id", F.lit(run_id)).withColumn("updated_at", at)
    return moved.select(*state.columns)


def update(users: DataFrame, changes: DataFrame, runs: DataFrame, state: DataFrame, manifest: DataFrame, fetched: DataFrame, site: str, run_id: str, started_at: Column, finished_at: Column, existing_limit: int = 500, new_limit: int = 64, sweep: int = BOUNDARY_RUN, limits: SafetyLimits = SafetyLimits(), budget: float | None = None) -> Update:
    """An update from captured pages, end to end: plan, observe, commit up to the stop row, and move state, run and manifest on.

    A paused crawler is not started, nor is one whose bootstrap is not over.
    """
    ratio(mass_ratio=limits.mass_ratio)
    positive(parse_failures=limits.parse_failures, transient_failures=limits.transient_failures, mass_attempts=limits.mass_attempts, mass_changes=limits.mass_changes)
    control = state.first()
    if control["phase"] == "paused":
        raise SafetyStop("the crawler is paused; look into it, then resume")
    if control["phase"] != "maintenance":
        raise ValueError("the bootstrap is not complete")
    frontier = schedule.highest_existing(users).first()["highest_existing"] + 1
    work = update_plan(users, started_at, control["maintenance_cursor"], existing_limit, new_limit, sweep)
    done = commit_batch(work.persist(), fetched, users, site, run_id, "update", started_at, finished_at, limits, budget)
    # A batch has existing_limit + new_limit rows at most, and each of its frames is read several times.
    done = replace(done, users=done.users.persist(), events=done.events.persist(), run=done.run.persist(), kept=done.kept.persist())
    moved = next_state(state, done.kept, done.users, run_id, finished_at, sweep, frontier)
    stopped = done.exit_code == EXIT_SAFETY
    moved = paused(moved) if stopped else moved
    reason = done.stop_reason
    if reason == "fatal":
        last = done.kept.orderBy(F.desc("seq")).select("results").first()["results"]
        reason = "blocked_or_challenge" if "blocked_or_challenge" in last else "rate_limited"
    run = done.run.withColumn("stopped_reason", F.lit(STOP_TEXTS[reason]))
    lacking = {c: F.lit(None) for c in runs.columns if c not in run.columns}
    run = run.withColumns(lacking).select(*[F.col(c).cast(runs.schema[c].dataType).alias(c) for c in runs.columns])
    after = audit.overlay(users, done.users.select(*users.columns))
    published = new_manifest(after, manifest, "paused" if stopped else "maintenance", finished_at, not stopped)
    told = done.run.select("attempted", "changed", "confirmed", "errors", F.lit("paused" if stopped else "maintenance").alias("phase"), F.lit(run_id).alias("run_id"), F.lit(STOP_TEXTS[reason]).alias("stopped_reason"))
    line = told.select(F.to_json(F.struct("*"))).first()
    return Update(after, audit.append_events(changes, done.events.select(*changes.columns)), moved, audit.append_runs(runs, run)[0], published, done, line[0] if line else "{}")


def validate_dataset(users: DataFrame, changes: DataFrame, runs: DataFrame, health: DataFrame, manifest: DataFrame, state: DataFrame, faults: DataFrame | None = None) -> DataFrame:
    """All issues of a dataset; read faults end the check at one issue."""
    if faults is not None and (first := faults.orderBy("file", "nth").limit(1).collect()):
        f = first[0]
        return users.sparkSession.createDataFrame([("error", "dataset_read", f"{f['file']}:{f['nth']}: {f['fault']}", f["file"], None)], "severity string, code string, message string, path string, user_id long")
    text = lambda value: value.cast("string")
    mismatches = validate.manifest_mismatches(users, manifest)
    stale = mismatches.select(F.lit("error").alias("severity"), F.lit("manifest_mismatch").alias("code"), F.concat("field", F.lit("="), text(F.col("actual")), F.lit(", expected "), text(F.col("expected"))).alias("message"), F.lit("manifest").alias("path"), F.lit(None).cast("long").alias("user_id"))
    lost = audit.orphans(changes, users, 20).select(F.lit("error").alias("severity"), F.lit("change_user_missing").alias("code"), F.concat(F.lit("no user for event "), "event_id").alias("message"), F.lit("changes").alias("path"), "user_id")
    sick = validate.validate_health(health).select("severity", "code", "message", F.col("url").alias("path"), F.lit(None).cast("long").alias("user_id"))
    return validate.union_all([validate.validate_users(users), validate.validate_coverage(users), stale, validate.validate_state(state, manifest, users), validate.validate_runs(runs), validate.validate_changes(changes), lost, sick])


def render(template: str, users: DataFrame, health: DataFrame, phase: str, updated: str | None, begin: str, end: str) -> tuple[str, str]:
    """(page, csv): the page's generated section and the CSV view."""
    body = "\n".join(["## 数据状态", "", views.status_section(users, phase, updated), "", "## 博客索引", "", views.list_section(users, health)])
    return views.replace_section(template, begin, end, body), views.csv_text(users, health)


def is_fresh(page: str, csv: str, rendered: tuple[str, str]) -> bool:
    """Whether published views are what the data would render now."""
    return (page, csv) == rendered


def inspect_page(page: DataFrame) -> DataFrame:
    """The observation of one captured page; nothing is written."""
    return responses.observations(page)


def bootstrap_state(state: DataFrame, kept: DataFrame, run_id: str, at: Column, run: int = BOUNDARY_RUN) -> tuple[DataFrame, str | None]:
    """The control row after a bootstrap chunk's committed rows (seq, id, is_existing, is_missing, clean), and why it ended."""
    row = state.first()
    start = F.struct(F.lit(row["phase"]).alias("phase"), F.lit(row["next_id"]).alias("next_id"), F.lit(row["boundary_candidate_start"]).alias("start"), F.lit(row["consecutive_missing_after_frontier"]).alias("missing"), F.lit(row["highest_confirmed_user_id"] > 0).alias("known"), F.lit(None).alias("stop"), F.lit(None).alias("last"))
    walked = safety.bootstrap_walk(kept.withColumn("batch", F.lit(run_id)), ["batch"], start, run)
    end = walked.first()
    if end is None:
        return state, None
    visited = kept.where(F.col("seq") <= end["last"])
    top = safety.advance_state(visited, row["highest_attempted_id"], row["highest_confirmed_user_id"])
    fresh = {
        "phase": end["phase"], "next_id": end["next_id"], "boundary_candidate_start": end["start"], "boundary_confirmation_pending": end["phase"] == "boundary_confirmation",
        "consecutive_missing_after_frontier": end["missing"], "last_run_id": run_id, "maintenance_cursor": 1 if end["phase"] == "maintenance" else row["maintenance_cursor"],
    }
    changed = {c: F.lit(v).cast(state.schema[c].dataType) for c, v in fresh.items()} | {"updated_at": at}
    moved = state.withColumns(changed).drop("highest_attempted_id", "highest_confirmed_user_id").crossJoin(top)
    return moved.select(*state.columns), safety.BOUNDARY_STOPS.get(end["stop"])


def resume(state: DataFrame, acknowledged: bool, probe_ok: bool) -> DataFrame:
    """The control row after a pause: back to the phase it was paused from, once a person and a probe agree."""
    if not acknowledged or not probe_ok:
        raise ValueError("a resume needs an acknowledgement and a successful probe")
    if state.where("phase = 'paused' and paused_from_phase is not null").isEmpty():
        raise ValueError("the crawler is not paused")
    return state.withColumn("phase", F.col("paused_from_phase")).withColumn("paused_from_phase", F.lit(None).cast("string"))


def paused(state: DataFrame) -> DataFrame:
    """The control row of a safety stop."""
    keep = F.when(F.col("phase") == "paused", F.col("paused_from_phase")).otherwise(F.col("phase"))
    return state.withColumn("paused_from_phase", keep).withColumn("phase", F.lit("paused"))


def new_manifest(users: DataFrame, previous: DataFrame, phase: str, finished_at: Column, ok: bool) -> DataFrame:
    """The manifest after a run; the time of the last success moves only if the run was not stopped."""
    rebuilt = views.rebuilt_summary(users, previous)
    status = {"bootstrap": "in_progress", "boundary_confirmation": "in_progress", "maintenance": "complete", "paused": "paused"}[phase]
    stamped = rebuilt.withColumn("phase", F.lit(phase)).withColumn("initialization_status", F.lit(status)).withColumn("updated_at", finished_at)
    return stamped.withColumn("last_successful_run_at", finished_at) if ok else stamped


def known_existing(users: DataFrame) -> bool:
    return not users.where(existing()).limit(1).isEmpty()
