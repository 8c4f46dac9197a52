"""The merge fold: ordered observations of an entity into its record and change events.

A fold step is a native expression over (state, observation), run by `aggregate` over an entity's sorted
observations; no Python worker takes part. Failures never touch confirmed values. A new value is committed
at its second strictly later sighting, or at once where no confirmation is asked for.

Entities of more than `chunk` observations are folded in rounds, each one starting from the last one's state,
so that no task ever holds more than a chunk of one entity.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftfold.functions.scalars import change_value, event_id, profile_fingerprint
from driftfold.schema import CONFIRMATIONS, EVENT, HEALTHY, USER_COLUMNS
from driftfold.session import shared_folder

#: Observations of one entity that a task may hold.
CHUNK = 20_000
_OBSERVED = ("observed_at", "seq", "check_result", "profile_status", "blog_status", "blog_url", "blog_url_raw", "http_status", "error", "parser_version", "source_fingerprint")
_STATE = {name: kind for name, kind in USER_COLUMNS.items() if name not in ("id", "profile_url")} | {"events": f"array<{EVENT}>"}


def _typed(values: dict[str, Column]) -> Column:
    """A state struct of the exact field types, whatever the branches' own."""
    return F.struct(*[values[name].cast(kind).alias(name) for name, kind in _STATE.items()])


def _blank() -> dict[str, Column]:
    blank = {name: F.lit(None) for name in _STATE}
    return blank | {"profile_status": F.lit("unknown"), "blog_status": F.lit("unknown"), "consecutive_failures": F.lit(0), "events": F.array()}


def _same(a: Column, b: Column) -> Column:
    return (a["profile_status"] == b["profile_status"]) & (a["blog_status"] == b["blog_status"]) & a["blog_url"].eqNullSafe(b["blog_url"])


def _events(s: Column, o: Column) -> Column:
    """The change events of a commit over a confirmed baseline."""
    profile = F.struct(o["observed_at"].alias("at"), F.lit("profile_status").alias("kind"), s["profile_status"].alias("old_status"), F.lit(None).cast("string").alias("old_url"), o["profile_status"].alias("new_status"), F.lit(None).cast("string").alias("new_url"))
    kind = (
        F.when((s["blog_status"] != "present") & (o["blog_status"] == "present"), "blog_added")
        .when((s["blog_status"] == "present") & (o["blog_status"] == "absent"), "blog_removed")
        .otherwise("blog_changed")
    )
    blog = F.struct(o["observed_at"].alias("at"), kind.alias("kind"), s["blog_status"].alias("old_status"), s["blog_url"].alias("old_url"), o["blog_status"].alias("new_status"), o["blog_url"].alias("new_url"))
    profile_differs = s["profile_status"] != o["profile_status"]
    blog_differs = (s["blog_status"] != o["blog_status"]) | ~s["blog_url"].eqNullSafe(o["blog_url"])
    return F.array_compact(F.array(F.when(profile_differs, profile).cast(EVENT), F.when(blog_differs, blog).cast(EVENT)))


def fold_step(s: Column, o: Column, confirm_changes: bool = True, required: int = CONFIRMATIONS) -> Column:
    """The state after one observation."""
    ok = o["check_result"] == "ok"
    baseline = s["last_confirmed_at"].isNotNull()
    refresh = ok & baseline & _same(s, o)
    needed = F.lit(confirm_changes and required > 1) & (baseline | (o["blog_status"] == "present"))
    p = s["pending_observation"]
    matches = p.isNotNull() & _same(p, o) & (p["source_fingerprint"] == o["source_fingerprint"])
    later = o["observed_at"] > p["last_observed_at"]
    sightings = F.when(F.coalesce(matches, F.lit(False)), p["confirmations"] + F.when(later, 1).otherwise(0)).otherwise(F.lit(1)).cast("bigint")
    commit = ok & ~refresh & (~needed | (sightings >= required))
    settled = refresh | commit
    fresh = F.struct(
        o["blog_status"].alias("blog_status"), o["blog_url"].alias("blog_url"), o["blog_url_raw"].alias("blog_url_raw"), F.lit(1).cast("bigint").alias("confirmations"), o["observed_at"].alias("first_observed_at"),
        o["http_status"].alias("http_status"), o["observed_at"].alias("last_observed_at"), o["parser_version"].alias("parser_version"), o["profile_status"].alias("profile_status"), o["source_fingerprint"].alias("source_fingerprint"),
    )
    again = F.struct(
        p["blog_status"].alias("blog_status"), p["blog_url"].alias("blog_url"), o["blog_url_raw"].alias("blog_url_raw"), sightings.alias("confirmations"), p["first_observed_at"].alias("first_observed_at"),
        o["http_status"].alias("http_status"), o["observed_at"].alias("last_observed_at"), o["parser_version"].alias("parser_version"), p["profile_status"].alias("profile_status"), p["source_fingerprint"].alias("source_fingerprint"),
    )
    kind = _STATE["pending_observation"]
    pending = (
        F.when(~ok, p)
        .when(settled, F.lit(None).cast(kind))
        .when(~F.coalesce(matches, F.lit(False)), fresh.cast(kind))
        .when(later, again.cast(kind))
        .otherwise(p)
    )
    keep = lambda name, when, value: F.when(when, value).otherwise(s[name])
    profile_changed = ~baseline | (s["profile_status"] != o["profile_status"])
    blog_changed = ~baseline | (s["blog_status"] != o["blog_status"]) | ~s["blog_url"].eqNullSafe(o["blog_url"])
    return _typed(
        {
            "blog_changed_at": keep("blog_changed_at", commit & blog_changed, o["observed_at"]),
            "blog_status": keep("blog_status", commit, o["blog_status"]),
            "blog_url": keep("blog_url", commit, o["blog_url"]),
            "blog_url_raw": keep("blog_url_raw", settled, o["blog_url_raw"]),
            "consecutive_failures": F.when(ok, F.lit(0)).otherwise(s["consecutive_failures"] + 1),
            "first_checked_at": F.coalesce(s["first_checked_at"], o["observed_at"]),
            "http_status": o["http_status"],
            "last_check_result": o["check_result"],
            "last_checked_at": o["observed_at"],
            "last_confirmed_at": keep("last_confirmed_at", settled, o["observed_at"]),
            "last_error": F.when(~ok, o["error"]),
            "parser_version": F.when(~ok | settled | s["parser_version"].isNull(), o["parser_version"]).otherwise(s["parser_version"]),
            "pending_observation": pending,
            "profile_changed_at": keep("profile_changed_at", commit & profile_changed, o["observed_at"]),
            "profile_status": keep("profile_status", commit, o["profile_status"]),
            "source_fingerprint": keep("source_fingerprint", settled, o["source_fingerprint"]),
            "events": F.when(commit & baseline, F.concat(s["events"], _events(s, o))).otherwise(s["events"]),
        }
    )


def _fold_once(obs: DataFrame, previous: DataFrame | None, **rules) -> DataFrame:
    """user_id and state of every entity that is in either table."""
    rows = obs.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct(*_OBSERVED))).alias("obs"))
    zero = _typed(_blank())
    if previous is not None:
        rows = rows.join(previous, "user_id", "full_outer")
        zero = F.coalesce(F.col("state"), zero)
        rows = rows.withColumn("obs", F.coalesce("obs", F.array().cast(rows.schema["obs"].dataType)))
    return rows.select("user_id", F.aggregate("obs", zero, lambda s, o: fold_step(s, o, **rules)).alias("state"))


def starting_states(users: DataFrame) -> DataFrame:
    """The states that a table of user records stands for."""
    values = {name: F.col(name) for name in _STATE if name != "events"} | {"events": F.array()}
    return users.select(F.col("id").alias("user_id"), _typed(values).alias("state"))


def fold_observations(obs: DataFrame, users: DataFrame | None = None, chunk: int = CHUNK, **rules) -> DataFrame:
    """user_id and state (record fields and events) after all observations, in order of observed_at and seq.

    rules: confirm_changes, required. Times count in whole seconds: two sightings in one second are not independent.
    """
    return fold_over(obs, None if users is None else starting_states(users), chunk, **rules)


def fold_over(obs: DataFrame, state: DataFrame | None, chunk: int = CHUNK, **rules) -> DataFrame:
    """fold_observations over states (user_id, state) as this returns them.

    Entities of more than `chunk` observations are folded by themselves, in rounds that are written once, by number.
    """
    spark = obs.sparkSession
    obs = obs.withColumn("observed_at", F.date_trunc("second", "observed_at").cast("timestamp_ntz"))
    if "source_fingerprint" not in obs.columns:
        obs = obs.withColumn("source_fingerprint", F.when(F.col("check_result") == "ok", profile_fingerprint(F.col("profile_status"), F.col("blog_status"), F.col("blog_url"))))
    hot = obs.groupBy("user_id").count().where(F.col("count") > chunk).select("user_id")
    if hot.isEmpty():
        return _fold_once(obs, state, **rules)
    part = lambda df, how: df and df.join(hot, "user_id", how)
    path = f"{shared_folder(spark)}/driftfold/rounds-{uuid.uuid4().hex}"
    order = Window.partitionBy("user_id").orderBy("observed_at", "seq")
    dealt = part(obs, "left_semi").withColumn("round", F.floor((F.row_number().over(order) - 1) / chunk))
    dealt.write.partitionBy("round").parquet(path)
    rounds = spark.read.parquet(path)
    folded = part(state, "left_semi")
    for n in range(rounds.agg(F.max("round")).first()[0] + 1):
        # Each round is cut from the last one's plan: it would be recomputed once a round otherwise.
        folded = _fold_once(rounds.where(F.col("round") == n), folded, **rules).checkpoint()
    return _fold_once(part(obs, "left_anti"), part(state, "left_anti"), **rules).unionByName(folded)


def records(folded: DataFrame, profile_base: str) -> DataFrame:
    """User records in canonical column order."""
    fields = {name: F.col(f"state.{name}") for name in _STATE if name != "events"}
    fields |= {"id": F.col("user_id"), "profile_url": F.concat(F.lit(profile_base), F.col("user_id").cast("string"))}
    return folded.select(*[fields[name].alias(name) for name in USER_COLUMNS])


def change_events(folded: DataFrame, run_id: Column | None = None) -> DataFrame:
    """One row a change event, with its content-addressed id."""
    e = F.col("e")
    rows = folded.select("user_id", F.explode("state.events").alias("e"))
    old, new = (change_value(e["kind"], e[f"{side}_status"], e[f"{side}_url"]) for side in ("old", "new"))
    return rows.select(
        e["at"].alias("changed_at"), event_id(F.col("user_id"), e["at"], e["kind"], old, new).alias("event_id"), e["kind"].alias("kind"),
        new.alias("new_value"), old.alias("old_value"), (F.lit(None).cast("string") if run_id is None else run_id).alias("run_id"), "user_id",
    )


def fold_link_checks(checks: DataFrame, confirmations: int = CONFIRMATIONS) -> DataFrame:
    """Link health after ordered checks (url, seq, status, previous failures 0): failures since the last healthy check.

    Equal to the step rule (healthy: 0, else one more) over all of a link's checks, but as two aggregates, so
    a link of any number of checks needs no task to itself.
    """
    healthy = F.col("status").isin(*HEALTHY)
    last = checks.groupBy("url").agg(F.max(F.when(healthy, F.col("seq"))).alias("well"), F.max_by("status", "seq").alias("status"), F.count("*").alias("checks"))
    after = checks.where(~healthy).join(last.select("url", "well"), "url").where(F.col("well").isNull() | (F.col("seq") > F.col("well"))).groupBy("url").agg(F.count("*").alias("n"))
    failures = F.coalesce("n", F.lit(0))
    return last.join(after, "url", "left").select("url", "status", failures.alias("consecutive_failures"), (failures >= confirmations).alias("failure_confirmed"), "checks")
