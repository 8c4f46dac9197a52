"""Writes to the record and audit tables: upserts, idempotent appends, run finalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftfold.functions.scalars import KEEP_NULLS, shard_start

RUN_IDENTITY = ("crawler_version", "mode", "run_id", "start_id", "started_at")


class AuditConflict(ValueError):
    """Rows that would rewrite the audit trail."""


def row_json(df: DataFrame) -> F.Column:
    return F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), KEEP_NULLS)


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    nth = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.withColumn("nth", F.row_number().over(nth)).where("nth = 1").drop("nth")


def repeated(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def overlay(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """New rows over old rows by key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def upsert_shards(old: DataFrame, new: DataFrame, size: int, key: str = "id") -> DataFrame:
    """The overlay of the shards that new rows touch, ready to overwrite just these partitions."""
    dated = new.withColumn("shard_start", shard_start(F.col(key), size))
    touched = old.withColumn("shard_start", shard_start(F.col(key), size)).join(dated.select("shard_start").distinct(), "shard_start", "left_semi")
    return overlay(touched, dated.select(*touched.columns), key)


def classify_append(old: DataFrame, new: DataFrame, key: str = "event_id") -> DataFrame:
    """(key, action) of every new row: insert, noop, or conflict where its key holds another row already or brings two."""
    mine = new.select(key, row_json(new).alias("row")).groupBy(key).agg(F.min("row").alias("low"), F.max("row").alias("high"))
    theirs = old.select(key, row_json(old).alias("row"))
    joined = mine.join(theirs, key, "left")
    clash = (F.col("low") != F.col("high")) | (F.col("row").isNotNull() & (F.col("row") != F.col("low")))
    return joined.select(key, F.when(clash, "conflict").when(F.col("row").isNull(), "insert").otherwise("noop").alias("action"))


def append_events(old: DataFrame, new: DataFrame, key: str = "event_id") -> DataFrame:
    """old with the new rows that it lacks; any conflict is an error."""
    actions = classify_append(old, new, key)
    if first := actions.where("action = 'conflict'").orderBy(key).limit(1).collect():
        raise AuditConflict(f"{key} {first[0][key]!r} has conflicting rows")
    fresh = new.join(actions.where("action = 'insert'"), key, "left_semi").dropDuplicates([key])
    return old.unionByName(fresh.select(*old.columns))


def classify_runs(old: DataFrame, new: DataFrame) -> DataFrame:
    """(run_id, action) of new run rows: insert, noop, finalize or conflict.

    A run may be finished once, keeping who and when it is; anything else that differs is a conflict, and so is
    an id that exists in another year.
    """
    a = new.select("run_id", row_json(new).alias("row"), *[F.col(c).alias(f"new_{c}") for c in (*RUN_IDENTITY, "finished_at") if c != "run_id"])
    b = old.select("run_id", row_json(old).alias("old_row"), *[F.col(c).alias(f"old_{c}") for c in (*RUN_IDENTITY, "finished_at") if c != "run_id"])
    same = F.lit(True)
    for c in RUN_IDENTITY:
        if c != "run_id":
            same = same & F.col(f"new_{c}").eqNullSafe(F.col(f"old_{c}"))
    other_year = F.year("new_started_at") != F.year("old_started_at")
    action = (
        F.when(F.col("old_row").isNull(), "insert")
        .when(other_year, "conflict")
        .when(F.col("row") == F.col("old_row"), "noop")
        .when(F.col("old_finished_at").isNull() & F.col("new_finished_at").isNotNull() & same, "finalize")
        .otherwise("conflict")
    )
    return a.join(b, "run_id", "left").select("run_id", action.alias("action"))


def append_runs(old: DataFrame, new: DataFrame) -> tuple[DataFrame, int]:
    """old after new run rows, and how many rows that changed."""
    if first := repeated(new, "run_id").orderBy("run_id").limit(1).collect():
        raise AuditConflict(f"run_id {first[0]['run_id']!r} is given twice")
    actions = classify_runs(old, new)
    if first := actions.where("action = 'conflict'").orderBy("run_id").limit(1).collect():
        raise AuditConflict(f"run_id {first[0]['run_id']!r} cannot overwrite an existing run")
    changed = new.join(actions.where("action in ('insert', 'finalize')"), "run_id", "left_semi")
    return overlay(old, changed.select(*old.columns), "run_id"), changed.count()


def orphans(changes: DataFrame, users: DataFrame, shown: int | None = None) -> DataFrame:
    """Change events without a user, the first ones by id if `shown` is given."""
    found = changes.join(users.select(F.col("id").alias("user_id")), "user_id", "left_anti")
    return found if shown is None else found.orderBy("user_id", "event_id").limit(shown)
