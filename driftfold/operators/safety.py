"""Safety rules over ordered work lists: streaks, mass change, and the row at which a batch stops.

A work list has a batch key and a sequence number; it holds a bounded batch (a few hundred rows by default), so
a window over one batch fits a task, and different batches run side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftfold.schema import BOUNDARY_RUN, PARSE_FAILURES, TRANSIENT_FAILURES, SafetyLimits


def _so_far(by: list[str]) -> Window:
    return Window.partitionBy(*by).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def streaks(rows: DataFrame, by: list[str], failure: Column, neutral: Column) -> DataFrame:
    """rows with `streak`: consecutive failures up to each row; other results reset it, neutral rows leave it as it is.

    Islands: a running count of resets numbers them, and failures are counted inside each.
    """
    fails, resets = failure & ~neutral, ~failure & ~neutral
    numbered = rows.withColumn("island", F.sum(F.when(resets, 1).otherwise(0)).over(_so_far(by)))
    inside = Window.partitionBy(*by, "island").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return numbered.withColumn("streak", F.sum(F.when(fails, 1).otherwise(0)).over(inside).cast("long")).drop("island")


def first_trip(rows: DataFrame, by: list[str], tripped: Column, name: str) -> DataFrame:
    """Per batch the first sequence number at which a rule trips, null if it never does."""
    return rows.groupBy(*by).agg(F.min(F.when(tripped, F.col("seq"))).alias(name))


def stable_known_failure(attempts: str = "attempts") -> Column:
    """Whether a row repeats a failure already on record: neutral to the streaks of a whole site."""
    return F.coalesce(
        (F.col(attempts) == 1)
        & ~F.col("prev_pending")
        & F.col("prev_result").isin(*PARSE_FAILURES, *TRANSIENT_FAILURES)
        & (F.col("check_result") == F.col("prev_result"))
        & (F.col("check_result") != "suspected_stale")
        & (F.col("prev_parser_version") == F.col("parser_version"))
        & F.col("prev_http_status").eqNullSafe(F.col("http_status"))
        & (F.col("prev_error") == F.col("error")),
        F.lit(False),
    )


def mass_change(rows: DataFrame, by: list[str], limits: SafetyLimits = SafetyLimits()) -> DataFrame:
    """rows (of maintenance, one a user) with running `attempted`, `changed_users` and whether the rule has tripped."""
    over = _so_far(by)
    counted = rows.withColumn("attempted", F.count("*").over(over)).withColumn("changed_users", F.sum(F.when(F.col("n_events") > 0, 1).otherwise(0)).over(over).cast("long"))
    tripped = (F.col("attempted") >= limits.mass_attempts) & (F.col("changed_users") >= limits.mass_changes) & (F.col("changed_users") >= F.col("attempted") * limits.mass_ratio)
    return counted.withColumn("tripped", tripped)


def fatal_reason(results: Column) -> Column:
    """Why a row stops a batch at once: a block outranks a rate limit."""
    return F.when(F.array_contains(results, "blocked_or_challenge"), "blocked").when(F.array_contains(results, "rate_limited"), "rate_limited")


def stop_row(rows: DataFrame, by: list[str], limits: SafetyLimits = SafetyLimits(), budget: float | None = None) -> DataFrame:
    """Per batch (stop_seq, stop_reason): the first row at which any rule stops it, nulls if none does.

    rows: by, seq, check_result, results, neutral, is_probe, n_events and, with a budget, elapsed. Of rules that
    trip at one row fatal results come before parse, transport and mass change. The budget is looked at before a
    row, which is then left out: its stop is the row before.
    """
    result = F.col("check_result")
    parse = streaks(rows, by, result.isin(*PARSE_FAILURES), F.col("neutral"))
    transport = streaks(rows, by, result.isin(*TRANSIENT_FAILURES), F.col("neutral"))
    changes = mass_change(rows.where(~F.col("is_probe")), by, limits)
    trips = [
        (first_trip(rows, by, fatal_reason(F.col("results")).isNotNull(), "fatal"), "fatal"),
        (first_trip(parse, by, F.col("streak") >= limits.parse_failures, "parse"), "parse"),
        (first_trip(transport, by, F.col("streak") >= limits.transient_failures, "transient"), "transient"),
        (first_trip(changes, by, F.col("tripped"), "mass_change"), "mass_change"),
    ]
    found = rows.select(*by).distinct()
    for trip, _ in trips:
        found = found.join(trip, by, "left")
    names = [name for _, name in trips]
    if budget is not None:
        found = found.join(rows.groupBy(*by).agg((F.min(F.when(F.col("elapsed") >= budget, F.col("seq"))) - 1).alias("budget")), by, "left")
        names.insert(0, "budget")
    stop = F.least(*[F.col(n) for n in names])
    reason = F.coalesce(*[F.when(F.col(n) == stop, F.lit(n)) for n in names])
    return found.select(*by, stop.alias("stop_seq"), reason.alias("stop_reason"))


def prefix(rows: DataFrame, stops: DataFrame, by: list[str]) -> DataFrame:
    """The rows a batch commits: up to and with the stopping row."""
    return rows.join(stops, by).where(F.col("stop_seq").isNull() | (F.col("seq") <= F.col("stop_seq"))).drop("stop_seq", "stop_reason")


def run_counters(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per run: users attempted and confirmed, change events, users with any failed or rate-limited result, last id."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("attempted"),
        F.count_if("confirmed").alias("confirmed"),
        F.coalesce(F.sum("n_events"), F.lit(0)).cast("long").alias("changed"),
        F.count_if(F.exists("results", lambda r: r != "ok")).alias("errors"),
        F.count_if(F.array_contains("results", "rate_limited")).alias("rate_limited"),
        F.max_by("user_id", "seq").alias("end_id"),
    )


def advance_state(rows: DataFrame, highest_attempted: int, highest_existing: int) -> DataFrame:
    """The control row's running maxima after a committed prefix (id, is_existing)."""
    return rows.agg(
        F.greatest(F.lit(highest_attempted), F.coalesce(F.max("id"), F.lit(0))).cast("long").alias("highest_attempted_id"),
        F.greatest(F.lit(highest_existing), F.coalesce(F.max(F.when(F.col("is_existing"), F.col("id"))), F.lit(0))).cast("long").alias("highest_confirmed_user_id"),
    )


def next_cursor(probes: DataFrame, frontier: Column | int, sweep: int, cursor: int) -> DataFrame:
    """One row: where the next sweep of the frontier goes on after committed probes (seq, id); back to its start at its end.

    Without a probe the cursor stays.
    """
    start = F.lit(frontier) if isinstance(frontier, int) else frontier
    after = F.max_by("id", "seq") + 1
    wrapped = F.when(after >= start + sweep, start).otherwise(after)
    return probes.agg(F.coalesce(wrapped, F.lit(cursor)).cast("long").alias("maintenance_cursor"))


#: The state of a bootstrap walk: one struct that the fold below hands on.
WALK = "struct<phase:string,next_id:bigint,start:bigint,missing:bigint,known:boolean,stop:string,last:bigint>"
#: Why a bootstrap walk ends.
BOUNDARY_STOPS = {"found": "boundary candidate found; independent pass required", "unclear": "boundary confirmation was inconclusive", "confirmed": "bootstrap boundary confirmed"}


def bootstrap_walk(rows: DataFrame, by: list[str], start: Column, run: int = BOUNDARY_RUN) -> DataFrame:
    """Where each batch (by, seq, id, is_existing, is_missing, clean) leaves the control state, starting from `start` (a WALK).

    clean: the check was confirmed and all its answers were in order. While bootstrapping, `run` clean missing ids in
    a row beyond a known user make a boundary candidate, and the batch ends there; while confirming one, each of its
    ids must be clean and missing again: an existing one sends the walk back to bootstrapping, an unclear one ends
    it for another try, and the last one finishes the bootstrap. Old rows of missing ids count for nothing: only
    what this batch saw does. A batch is as long as its command's limit allows, so its rows fit into one value.
    """
    seen = F.when(F.col("clean") & F.col("is_existing"), "existing").when(F.col("clean") & F.col("is_missing"), "missing").otherwise("unclear")
    steps = F.array_sort(F.collect_list(F.struct("seq", "id", seen.alias("seen"), F.col("is_existing").alias("exists"))))

    def to(w: Column, **changed: Column) -> Column:
        names = ("phase", "next_id", "start", "missing", "known", "stop", "last")
        return F.struct(*[changed.get(n, w[n]).alias(n) for n in names]).cast(WALK)

    def step(w: Column, r: Column) -> Column:
        none, zero, onward = F.lit(None).cast("long"), F.lit(0).cast("long"), r["id"] + 1
        common = {"known": w["known"] | r["exists"], "last": r["seq"]}
        count = F.when((r["seen"] == "missing") & common["known"], w["missing"] + 1).otherwise(zero)
        first = r["id"] - run + 1
        stop = {name: F.lit(name) for name in BOUNDARY_STOPS}
        confirming = (
            F.when(r["seen"] == "existing", to(w, **common, phase=F.lit("bootstrap"), next_id=onward, start=none, missing=zero))
            .when(r["seen"] == "unclear", to(w, **common, next_id=w["start"], stop=stop["unclear"]))
            .when(r["id"] >= w["start"] + run - 1, to(w, **common, phase=F.lit("maintenance"), next_id=onward, start=none, missing=zero, stop=stop["confirmed"]))
            .otherwise(to(w, **common, next_id=onward))
        )
        looking = F.when(count >= run, to(w, **common, phase=F.lit("boundary_confirmation"), next_id=first, start=first, missing=count, stop=stop["found"])).otherwise(to(w, **common, next_id=onward, missing=count))
        return F.when(w["stop"].isNotNull(), w).when(w["phase"] == "boundary_confirmation", confirming).otherwise(looking)

    return rows.groupBy(*by).agg(F.aggregate(steps, start.cast(WALK), step).alias("w")).select(*by, "w.*")
