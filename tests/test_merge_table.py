"""Copy-on-write merges: only touched buckets change their files."""
import os

import pytest

from tessera.session import scratch_path
from tessera.sinks.manifest import Manifests
from tessera.sinks.merge_table import MergeTable

SCHEMA = "k long, name string, v double"


@pytest.fixture
def table(spark):
    t = MergeTable(spark, scratch_path(spark, "merge-test"), spark.createDataFrame([], SCHEMA).schema, ["k"], buckets=16)
    t.merge(spark.range(500).selectExpr("id AS k", "concat('n', id) AS name", "id * 0.5D AS v"))
    return t


def rows(table):
    return {r.k: (r.name, r.v) for r in table.read().collect()}


def listed(table):
    out = {}
    for b, folder in table.files().items():
        path = f"{table.path}/{folder}".removeprefix("file:")
        out[b] = sorted(f"{folder}/{f}" for f in os.listdir(path) if f.startswith("part-"))
    return out


def test_untouched_files_keep_their_names(spark, table):
    before, old = listed(table), rows(table)
    touched = table.merge(spark.createDataFrame([(7, "seven", -1.0), (9000, "new", 2.0)], SCHEMA))
    after = listed(table)
    assert 1 <= len(touched) <= 2 and len(before) == 16
    assert {b: f for b, f in after.items() if b not in touched} == {b: f for b, f in before.items() if b not in touched}
    assert all(after[b] != before[b] for b in touched)
    assert rows(table) == old | {7: ("seven", -1.0), 9000: ("new", 2.0)}


def test_crash_and_race(spark, table, monkeypatch):
    old, create = rows(table), Manifests.create
    update = spark.createDataFrame([(1, "one", 1.0)], SCHEMA)

    def crash(*_):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(Manifests, "create", crash)
        with pytest.raises(OSError):
            table.merge(update)
    assert rows(table) == old
    rival, calls = MergeTable(spark, table.path, table.schema, ["k"]), []
    assert rival.buckets == 16  # as the table was made, whatever the default

    def raced(self, version, state):
        calls.append(version)
        if len(calls) == 1:
            rival.merge(spark.createDataFrame([(1, "rival", 5.0), (2, "two", 2.0)], SCHEMA))
        return create(self, version, state)
    with monkeypatch.context() as m:
        m.setattr(Manifests, "create", raced)
        table.merge(update)
    assert rows(table) == old | {1: ("one", 1.0), 2: ("two", 2.0)}  # neither writer's rows are lost


def test_repeats_deletes_nulls_and_nothing(spark, table):
    old = rows(table)
    with pytest.raises(ValueError, match="repeated"):
        table.merge(spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], SCHEMA))
    assert table.merge(spark.createDataFrame([], SCHEMA)) == [] and rows(table) == old
    table.delete(table.read().where("k >= 3"))
    assert set(rows(table)) == {0, 1, 2}
    table.delete(table.read())
    assert rows(table) == {}
    table.merge(spark.createDataFrame([(4, None, None)], SCHEMA))
    assert rows(table) == {4: (None, None)}
