"""Strict JSON-lines reading: each kind of corruption, round trips, partition overwrite and pruning."""

import pytest

from driftfold.operators import audit
from driftfold.plans import adapters
from driftfold.sources import records

COLUMNS = {"a": "string", "id": "bigint"}


@pytest.mark.parametrize(
    ("text", "faults"),
    [
        ('{"a":"é","id":1}\n{"a":null,"id":2}\n', []),
        ("", []),
        ('{"a":"x","id":1}\n\n{"a":"x","id":2}\n', ["blank row"]),
        ("{oops\n", ["invalid JSON"]),
        ('{"a":"x","a":"y","id":1}\n', ["invalid JSON"]),
        ("[1]\n", ["row must be an object"]),
        ('{"id":1,"a":"x"}\n', ["row is not canonically encoded"]),
        ('{"a":"x", "id":1}\n', ["row is not canonically encoded"]),
        ('{"a":"x","id":"1"}\n', ["row is not canonically encoded"]),
        ('{"a":"x","b":1,"id":1}\n', ["row is not canonically encoded"]),
        ('{"a":"x","id":2}\n{"a":"x","id":1}\n', ["out of order"]),
        ('{"a":"x","id":1}\n{"a":"y","id":1}\n', ["out of order", "repeated key"]),
        ('{"a":"x","id":1000}\n', ["row outside its file"]),
    ],
)
def test_faults(spark, tmp_path, text, faults):
    (tmp_path / "00000-00999.jsonl").write_text(text)
    rows, found = records.read_shards(spark, str(tmp_path), COLUMNS)
    assert sorted(r.fault for r in found.collect()) == faults
    if not faults:
        assert rows.count() == text.count("\n")


def test_foreign_file(spark, tmp_path):
    (tmp_path / "notes.jsonl").write_text('{"a":"x","id":1}\n')
    assert "foreign file name" in {r.fault for r in records.read_shards(spark, str(tmp_path), COLUMNS)[1].collect()}


def test_round_trip_and_dynamic_overwrite(spark, sf, tmp_path):
    users = adapters.users(spark, sf)
    path = str(tmp_path / "t")
    records.write_shards(users, path, 50)
    changed = audit.upsert_shards(users, users.where("id = 3").withColumn("parser_version", users.parser_version.substr(1, 1)), 50)
    records.write_shards(changed, path, 50)
    table = spark.read.parquet(path)
    assert table.count() == users.count()
    found = records.point_lookup(table, 3, 50)
    assert [r.parser_version for r in found.collect()] == ["1"]
    assert "shard_start" in found._jdf.queryExecution().toString().split("PartitionFilters")[1][:80]
    records.export_json(users.select("id", "profile_status"), str(tmp_path / "out"), ["id"])
    lines = spark.read.text(str(tmp_path / "out")).collect()
    assert len(lines) == users.count() and lines[0].value == '{"id":1,"profile_status":"hidden"}'


def test_year_files(spark, tmp_path):
    (tmp_path / "2025.jsonl").write_text('{"changed_at":"2025-01-01T00:00:00Z","event_id":"b","user_id":1}\n{"changed_at":"2026-01-01T00:00:00Z","event_id":"a","user_id":1}\n')
    columns = {"changed_at": "string", "event_id": "string", "user_id": "bigint"}
    assert [r.fault for r in records.read_years(spark, str(tmp_path), columns, "event_id", "changed_at")[1].collect()] == ["row outside its file"]
