"""Documents of one row: the public manifest and the control state.

Inside, both are one-row frames with a flat column for each count; outside, one JSON object. A missing document
stands for its defaults. Strict reads compare values, not spelling: field order and blanks are free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftfold.functions.scalars import WIRE, pretty_json
from driftfold.schema import MANIFEST_COLUMNS, MANIFEST_DEFAULTS, PROFILE_STATUSES, STATE_COLUMNS, STATE_DEFAULTS, ddl
from driftfold.sources.layout import exists

COUNTS = "profile_status_counts"


class CorruptDocument(ValueError):
    """A document that is there but cannot be taken as it is."""


def default_row(spark: SparkSession, columns: dict[str, str], defaults: dict) -> DataFrame:
    """What a missing document stands for: its defaults, zero for all other numbers, null for all other fields."""
    zero = [c for c, kind in columns.items() if kind == "bigint" and c not in defaults and c != "boundary_candidate_start"]
    counts = F.struct(*[F.lit(0).cast("bigint").alias(s) for s in PROFILE_STATUSES])
    value = lambda c: counts if c == COUNTS else F.lit(0 if c in zero else defaults.get(c))
    return spark.range(1).select(*[value(c).cast(kind).alias(c) for c, kind in columns.items()])


def document_fault(text: Column, parsed: Column) -> Column:
    """Why a document is corrupt, or null: not JSON (a key given twice included), no object, or other fields, types or
    values than its columns have."""
    variant = F.try_parse_json(text)
    return (
        F.when(variant.isNull(), "invalid JSON")
        .when(~F.startswith(F.schema_of_variant(variant), F.lit("OBJECT")), "must be an object")
        .when(F.to_json(variant) != F.to_json(parsed, WIRE), "not canonically serialized")
    )


def strict_documents(texts: DataFrame, columns: dict[str, str], text: str = "text") -> DataFrame:
    """texts with the parsed row and its fault: row is null where there is one."""
    parsed = texts.withColumn("row", F.from_json(F.col(text), ddl(columns), WIRE))
    checked = parsed.withColumn("fault", document_fault(F.col(text), F.col("row")))
    return checked.withColumn("row", F.when(F.col("fault").isNull(), F.col("row")))


def read_document(spark: SparkSession, path: str, columns: dict[str, str], defaults: dict) -> DataFrame:
    """One row, strictly read; the defaults if there is no such document."""
    if not exists(spark, path):
        return default_row(spark, columns, defaults)
    found = strict_documents(spark.read.text(path, wholetext=True).withColumnRenamed("value", "text"), columns)
    # One row of bounded width: the driver looks at it once and hands it on.
    rows = found.select("row", "fault").collect()
    if len(rows) != 1 or rows[0]["fault"]:
        raise CorruptDocument(f"{path}: {rows[0]['fault'] if rows else 'empty'}")
    return spark.createDataFrame([rows[0]["row"]], ddl(columns))


def read_loosely(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """One row for rendering: absent fields are null, and so are all of a missing document; malformed JSON is an error."""
    if not exists(spark, path):
        return spark.range(1).select(*[F.lit(None).cast(kind).alias(c) for c, kind in columns.items()])
    return spark.read.schema(ddl(columns)).options(mode="FAILFAST", multiLine=True, timestampNTZFormat=WIRE["timestampNTZFormat"]).json(path)


def flat(manifest: DataFrame) -> DataFrame:
    """The counts by status as columns of their own."""
    return manifest.select("*", *[F.col(f"{COUNTS}.{s}").alias(f"n_{s}") for s in PROFILE_STATUSES]).drop(COUNTS)


def nested(manifest: DataFrame) -> DataFrame:
    """The manifest as it is published; fields that a frame lacks are null."""
    counts = F.struct(*[F.col(f"n_{s}").alias(s) for s in PROFILE_STATUSES])
    value = lambda c: counts if c == COUNTS else F.col(c) if c in manifest.columns else F.lit(MANIFEST_DEFAULTS.get(c))
    return manifest.select(*[value(c).cast(kind).alias(c) for c, kind in MANIFEST_COLUMNS.items()])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return flat(read_document(spark, path, MANIFEST_COLUMNS, MANIFEST_DEFAULTS))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return read_document(spark, path, STATE_COLUMNS, STATE_DEFAULTS)


def document_text(row: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(text): rows as indented JSON documents, fields in alphabetical order."""
    return row.select(pretty_json(F.struct(*[F.col(c).cast(kind).alias(c) for c, kind in sorted(columns.items())])).alias("text"))


def _write(row: DataFrame, columns: dict[str, str], path: str) -> None:
    # The row is evaluated before the old document, which it may come from, goes.
    text = document_text(row, columns).collect()
    if len(text) != 1:
        raise ValueError(f"a document is one row, not {len(text)}")
    # The writer ends the line itself.
    document = row.sparkSession.createDataFrame([(text[0]["text"].removesuffix("\n"),)], "text string")
    document.coalesce(1).write.mode("overwrite").text(path)


def write_manifest(manifest: DataFrame, path: str) -> None:
    _write(nested(manifest), MANIFEST_COLUMNS, path)


def write_state(state: DataFrame, path: str) -> None:
    _write(state, STATE_COLUMNS, path)
