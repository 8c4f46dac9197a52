"""Scheduling: due records, the priority batch, frontier probes, trailing runs and coverage gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftfold.functions.scalars import confirmed_missing, due_at, existing, link_due_at, priority
from driftfold.schema import BOUNDARY_RUN, SchedulePolicy

#: Ids in a range whose gaps one task looks for.
RANGE = 1 << 16


def with_due(users: DataFrame, policy: SchedulePolicy = SchedulePolicy()) -> DataFrame:
    return users.withColumn("due_at", due_at(policy)).withColumn("category", priority())


def due_users(users: DataFrame, now: Column, limit: int = 500, policy: SchedulePolicy = SchedulePolicy()) -> DataFrame:
    """The most urgent due records, at most limit: a top-k, never a full sort."""
    if limit < 0:
        raise ValueError("limit cannot be negative")
    return with_due(users, policy).where(F.col("due_at") <= now).orderBy("category", "due_at", "id").limit(limit)


def due_links(urls: DataFrame, health: DataFrame, now: Column, limit: int = 200) -> DataFrame:
    """The links longest due, at most limit; a link without health is due since the epoch."""
    joined = urls.select("url").distinct().join(health.select("url", "status", "checked_at", "consecutive_failures"), "url", "left")
    return joined.withColumn("due_at", link_due_at()).where(F.col("due_at") <= now).orderBy("due_at", "url").limit(limit)


def highest_existing(users: DataFrame) -> DataFrame:
    """One row: the highest confirmed public or hidden id, 0 without one."""
    return users.agg(F.coalesce(F.max(F.when(existing(), F.col("id"))), F.lit(0)).cast("long").alias("highest_existing"))


def frontier_probes(users: DataFrame, cursor: int, max_new: int = 64, sweep: int = BOUNDARY_RUN) -> DataFrame:
    """(seq, id): the next probes beyond the frontier, wrapping at the end of the sweep."""
    if max_new < 1 or sweep < max_new:
        raise ValueError("a sweep must hold at least max_new ids")
    frontier = highest_existing(users).select((F.col("highest_existing") + 1).alias("frontier"))
    start = F.greatest(F.col("frontier"), F.lit(cursor))
    start = F.when(start >= F.col("frontier") + sweep, F.col("frontier")).otherwise(start)
    probes = users.sparkSession.range(max_new)
    return frontier.crossJoin(probes).select(F.col("id").alias("seq"), (F.col("frontier") + F.pmod(start - F.col("frontier") + F.col("id"), F.lit(sweep))).alias("id"))


def work_list(users: DataFrame, now: Column, cursor: int, limit: int = 500, max_new: int = 64, sweep: int = BOUNDARY_RUN, policy: SchedulePolicy = SchedulePolicy()) -> DataFrame:
    """(seq, id, is_probe): frontier probes first, then due records that are no probes. At most limit + max_new rows."""
    probes = frontier_probes(users, cursor, max_new, sweep).select("seq", "id", F.lit(True).alias("is_probe"))
    due = due_users(users, now, limit, policy).join(F.broadcast(probes.select("id")), "id", "left_anti")
    order = Window.orderBy("category", "due_at", "id")
    ranked = due.withColumn("seq", F.row_number().over(order).cast("long") + max_new - 1)
    return probes.unionByName(ranked.select("seq", "id", F.lit(False).alias("is_probe")))


def trailing_missing(users: DataFrame) -> DataFrame:
    """One row: how many consecutive confirmed-missing ids follow the highest existing one, and whether they reach a boundary.

    The run ends before the first id that is absent or not confirmed missing. Two aggregates find it: the first
    id beyond the frontier that breaks it by its state, and, among the ids below that, how many there are.
    """
    top = highest_existing(users)
    beyond = users.crossJoin(F.broadcast(top)).where(F.col("id") > F.col("highest_existing"))
    missing = beyond.where(confirmed_missing()).select("id", "highest_existing")
    spread = missing.withColumn("block", F.floor(F.col("id") / RANGE))
    inside = Window.partitionBy("block").orderBy("id")
    blocks = spread.withColumn("prev", F.lag("id").over(inside)).groupBy("block").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.min(F.when(F.col("id") - F.col("prev") > 1, F.col("prev"))).alias("break_at")
    )
    across = Window.orderBy("block")
    ends = (
        blocks.withColumn("before", F.lag("high").over(across))
        .crossJoin(F.broadcast(top))
        .select(
            "highest_existing",
            F.when(F.col("low") != F.coalesce("before", "highest_existing") + 1, F.coalesce("before", "highest_existing")).otherwise(F.col("break_at")).alias("stop"),
            "high",
        )
    )
    # A block cut by the frontier starts right after it; the first stop by id ends the run.
    run = ends.agg(F.min("stop").alias("stop"), F.max("high").alias("high"))
    length = F.coalesce(F.coalesce("stop", "high") - F.col("highest_existing"), F.lit(0)).cast("long")
    return top.crossJoin(run).select("highest_existing", length.alias("trailing"), (length >= BOUNDARY_RUN).alias("boundary_reached"))


def coverage_gaps(ids: DataFrame) -> DataFrame:
    """(first, last, label) of each run of ids missing between 1 and the highest.

    Ids are looked at in ranges, each in its own window; the ranges' edges, one row for each, meet in a second one.
    """
    blocks = ids.select("id").distinct().withColumn("block", F.floor(F.col("id") / RANGE))
    inside = Window.partitionBy("block").orderBy("id")
    within = blocks.withColumn("prev", F.lag("id").over(inside)).where(F.col("id") - F.col("prev") > 1).select((F.col("prev") + 1).alias("first"), (F.col("id") - 1).alias("last"))
    edges = blocks.groupBy("block").agg(F.min("id").alias("low"), F.max("id").alias("high")).withColumn("prev", F.coalesce(F.lag("high").over(Window.orderBy("block")), F.lit(0)))
    between = edges.where(F.col("low") - F.col("prev") > 1).select((F.col("prev") + 1).alias("first"), (F.col("low") - 1).alias("last"))
    label = F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(F.concat(F.col("first").cast("string"), F.lit("-"), F.col("last").cast("string")))
    return within.unionByName(between).withColumn("label", label)


def order_faults(rows: DataFrame, key: str, position: str, within: list[str]) -> DataFrame:
    """Rows that repeat an earlier key of their file, or do not come after the row before: (…, code)."""
    by_position = Window.partitionBy(*within).orderBy(position, key)
    by_key = Window.partitionBy(*within, key).orderBy(position)
    marked = rows.withColumn("prev", F.lag(key).over(by_position)).withColumn("nth", F.row_number().over(by_key))
    codes = F.array_compact(F.array(F.when(F.col("nth") > 1, "duplicate_id"), F.when(F.col(key) <= F.col("prev"), "record_order")))
    return marked.select(*within, key, position, F.explode(codes).alias("code"))


def id_range(spark: SparkSession, next_id: int, count: int) -> DataFrame:
    """The ids a bootstrap batch visits."""
    return spark.range(next_id, next_id + count)
