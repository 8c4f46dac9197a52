"""Strict and permissive readers of JSON-lines tables, point lookups, and writers for the edge of the engine.

Inside, tables are Parquet partitioned by shard or year; JSON lines come in and go out here. A strict read
gives rows and corruption reports side by side, so that a caller can stop on any report; nothing is repaired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftfold.functions.scalars import WIRE, shard_name, shard_start
from driftfold.schema import HEALTH_COLUMNS, SHARD_SIZE, ddl
from driftfold.sources import layout

USER_FILE = r"^[0-9]{5,}-[0-9]{5,}\.jsonl$"
YEAR_FILE = r"^(?!0000)[0-9]{4}\.jsonl$"


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, nth, line): every line of the files at path, numbered from 1; a final line break ends a line."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    body = F.regexp_replace("value", "\n$", "")
    lines = F.when(F.col("value") == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))
    return whole.select("file", F.posexplode(lines).alias("nth", "line")).withColumn("nth", F.col("nth") + 1)


def line_fault(line: Column, parsed: Column) -> Column:
    """Why a line is corrupt, or null: blank, not JSON (a key given twice included), no object, or not canonical.

    Canonical form is one comparison: the parsed row, written again with its fields in order, must be the line.
    A wrong type parses to null, a missing or extra field changes the text, and so both fail it.
    """
    variant = F.try_parse_json(line)
    return (
        F.when(F.trim(line) == "", "blank row")
        .when(variant.isNull(), "invalid JSON")
        .when(~F.startswith(F.schema_of_variant(variant), F.lit("OBJECT")), "row must be an object")
        .when(F.to_json(parsed, WIRE) != line, "row is not canonically encoded")
    )


def strict_rows(lines: DataFrame, columns: dict[str, str], key: str, order: list[str] | None = None, file_pattern: str | None = None, home: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, faults) of lines (file, nth, line) that should hold exactly these columns (in alphabetical order).

    faults: file, nth, fault. Besides corrupt lines these are foreign file names, rows outside their home file,
    repeated keys, and rows out of order within their file.
    """
    parsed = lines.withColumn("row", F.from_json("line", ddl(columns), WIRE))
    checked = parsed.withColumn("fault", line_fault(F.col("line"), F.col("row")))
    rows = checked.where("fault is null").select("file", "nth", "row.*")
    by_key = Window.partitionBy(key).orderBy("file", "nth")
    by_file = Window.partitionBy("file").orderBy("nth")
    mark = F.struct(*[F.col(c) for c in (order or [key])])
    # Both windows and the home file in one pass over the sound rows.
    seen = rows.withColumn("mark", mark).withColumn("copy", F.row_number().over(by_key)).withColumn("prev", F.lag("mark").over(by_file))
    tests = [F.when(F.col("copy") > 1, "repeated key"), F.when(F.col("mark") <= F.col("prev"), "out of order")]
    if home is not None:
        tests.append(F.when(home != F.col("file"), "row outside its file"))
    found = checked.where("fault is not null").select("file", "nth", "fault")
    found = found.unionByName(seen.select("file", "nth", F.explode(F.array_compact(F.array(*tests))).alias("fault")))
    if file_pattern:
        foreign = lines.select("file").distinct().where(~F.rlike("file", F.lit(file_pattern)))
        found = found.unionByName(foreign.select("file", F.lit(0).alias("nth"), F.lit("foreign file name").alias("fault")))
    return rows.drop("file", "nth"), found


def read_strict(spark: SparkSession, path: str, columns: dict[str, str], key: str, order: list[str] | None = None, file_pattern: str | None = None, home: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """strict_rows of the JSON-lines files at path."""
    return strict_rows(raw_lines(spark, path), columns, key, order, file_pattern, home)


def read_shards(spark: SparkSession, path: str, columns: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    return read_strict(spark, path, columns, "id", file_pattern=USER_FILE, home=shard_name(F.col("id")))


def read_years(spark: SparkSession, path: str, columns: dict[str, str], key: str, stamp: str) -> tuple[DataFrame, DataFrame]:
    """Audit rows, one file a UTC year of their time stamp (ISO text)."""
    home = F.concat(F.left(F.col(stamp), F.lit(4)), F.lit(".jsonl"))
    order = [stamp, key] if key != "event_id" else [stamp, "user_id", key]
    rows, faults = read_strict(spark, path, columns, key, order, YEAR_FILE, home)
    empty = layout.entries(spark, path).where("kind = 'file' and bytes = 0 and name <> '.gitkeep'")
    return rows, faults.unionByName(empty.select(F.col("name").alias("file"), F.lit(0).alias("nth"), F.lit("empty file").alias("fault")))


def read_health(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Link health, one strict file in order of URL; a missing file holds no rows."""
    if not layout.exists(spark, path):
        return spark.createDataFrame([], ddl(HEALTH_COLUMNS)), spark.createDataFrame([], "file string, nth int, fault string")
    return read_strict(spark, path, HEALTH_COLUMNS, "url")


def read_permissive(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Rows for rendering: blank lines skipped, form not checked, malformed rows an error."""
    return spark.read.schema(ddl(columns)).options(mode="FAILFAST", timestampNTZFormat=WIRE["timestampNTZFormat"]).json(path)


def read_rendered(spark: SparkSession, path: str, columns: dict[str, str], key: str = "id") -> DataFrame:
    """Permissive rows whose keys are unique; a key given twice is an error."""
    rows = read_permissive(spark, path, columns)
    if twice := rows.groupBy(key).count().where("count > 1").orderBy(key).limit(1).collect():
        raise ValueError(f"{key} {twice[0][key]} is given twice")
    return rows


def point_lookup(table: DataFrame, user_id: int, size: int = SHARD_SIZE) -> DataFrame:
    """One record of a table partitioned by shard_start; the derived predicate is what prunes partitions."""
    return table.where((F.col("shard_start") == user_id // size * size) & (F.col("id") == user_id))


def write_shards(rows: DataFrame, path: str, size: int = SHARD_SIZE, key: str = "id") -> None:
    """Overwrite the partitions that rows touch, and no others."""
    dated = rows if "shard_start" in rows.columns else rows.withColumn("shard_start", shard_start(F.col(key), size))
    dated.repartition("shard_start").sortWithinPartitions("shard_start", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard_start").parquet(path)


def write_years(rows: DataFrame, path: str, stamp: Column, order: list[str]) -> None:
    dated = rows.withColumn("year", F.year(stamp))
    dated.repartition("year").sortWithinPartitions("year", *order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def json_lines(rows: DataFrame) -> DataFrame:
    """(line): rows as canonical JSON, fields in alphabetical order, nulls kept."""
    return rows.select(F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]), WIRE).alias("line"))


def export_json(rows: DataFrame, path: str, order: list[str]) -> None:
    """One sorted JSON-lines directory; an empty table gives an empty file."""
    lines = rows.select(*order, F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]), WIRE).alias("line"))
    lines.orderBy(*order).select("line").coalesce(1).write.mode("overwrite").text(path)
