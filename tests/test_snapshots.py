"""Tables that change as a whole: failed writes, replacing, adding and merging by key."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardflow.sources import files, snapshots, tables
from wardflow.sources.snapshots import Conflict, SnapshotTable

COLUMNS = "id long, name string, n int"


def rows(spark, data):
    return spark.createDataFrame(data, COLUMNS)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def torn(df):
    """Some tasks write all they have before one of them fails."""
    return df.withColumn("n", F.when(F.col("id") == 3, F.raise_error(F.lit("torn")).cast("int")).otherwise(F.col("n")))


def test_replace_and_old_versions(spark, root):
    table = SnapshotTable(spark, root)
    assert table.latest() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.replace(rows(spark, [(1, "a", 1)]))
    assert (first.number, first.rows_written) == (1, 1)
    before = table.read()
    second = table.replace(table.read().withColumn("n", F.col("n") + 1))  # the query reads what it replaces
    assert got(table.read()) == [(1, "a", 2)] and got(before) == [(1, "a", 1)] == got(table.read(first))
    table.replace(rows(spark, []))
    assert got(table.read()) == [] and [v.number for v in table.versions()] == [2, 3]
    assert got(table.read(second.number)) == [(1, "a", 2)]
    assert not files.exists(spark, first.paths(table.root)[0])
    assert table.read().columns == ["id", "name", "n"]


def test_failed_write_changes_nothing(spark, root):
    table = SnapshotTable(spark, root)
    table.replace(rows(spark, [(1, "a", 1)]))
    listed = files.names(spark, f"{root}/_versions")
    more = rows(spark, [(i, "b", i) for i in range(8)]).repartition(8)
    for write in (table.replace, table.append, lambda df: table.merge(df, ["id"])):
        with pytest.raises(Exception, match="torn"):
            write(torn(more))
        assert got(table.read()) == [(1, "a", 1)]
    assert files.names(spark, f"{root}/_versions") == listed
    import os

    assert len([d for d in os.listdir(root) if d.startswith("_run=")]) == 1


def test_append_and_clear(spark, root):
    table = SnapshotTable(spark, root)
    table.append(rows(spark, [(1, "a", 1)]))
    table.append(rows(spark, [(2, "b", 2)]).select("n", "name", "id"))
    assert got(table.read()) == [(1, "a", 1), (2, "b", 2)]
    table.clear({"why": "gone"})
    assert got(table.read()) == [] and table.latest().note == {"why": "gone"}
    table.append(rows(spark, [(3, "c", None)]))
    assert got(table.read()) == [(3, "c", None)]


def test_merge_touches_only_files_with_its_keys(spark, root):
    table = SnapshotTable(spark, root)
    table.replace(rows(spark, [(i, f"p{i % 3}", i) for i in range(40)]).repartitionByRange(4, "id"))
    before = {table._local(f) for f in table.read().inputFiles()}
    merged = table.merge(rows(spark, [(3, "new", 30), (100, "new", 31)]), ["id"])
    after = {table._local(f) for f in table.read().inputFiles()}
    want = sorted([(i, f"p{i % 3}", i) for i in range(40) if i != 3] + [(3, "new", 30), (100, "new", 31)], key=str)
    assert got(table.read()) == want
    assert len(before & after) == 3 and len(merged.parts) == 1
    assert merged.rows_written < 20  # one file of four and what came
    table.merge(rows(spark, [(3, "new", 30), (100, "new", 31)]), ["id"])
    assert got(table.read()) == want
    table.replace(rows(spark, [(1, "z", 0)]))
    table.replace(rows(spark, [(1, "z", 0)]))
    import os

    assert len([d for d in os.listdir(root) if d.startswith("_run=")]) == 2


def test_merge_moves_rows_between_partitions(spark, root):
    table = SnapshotTable(spark, root)
    table.replace(rows(spark, [(1, "x", 1), (2, "x", 2), (None, "y", 3)]), ["name"])
    table.merge(rows(spark, [(1, "y/z [*]", 1), (None, "x", 4)]), ["id"])
    assert got(table.read()) == sorted([(1, "y/z [*]", 1), (2, "x", 2), (None, "x", 4)], key=str)
    table.merge(rows(spark, [(1, "x", 5)]), ["id"])
    assert got(table.read()) == sorted([(1, "x", 5), (2, "x", 2), (None, "x", 4)], key=str)
    table.merge(rows(spark, []), ["id"])
    table.clear()
    table.merge(rows(spark, [(1, "x", 5)]), ["id"])
    assert got(table.read()) == [(1, "x", 5)]
    with pytest.raises(ValueError, match="key columns"):
        table.merge(rows(spark, []), [])


KEY = st.one_of(st.none(), st.integers(0, 4))
ROW = st.tuples(KEY, st.sampled_from(["a", "b", None]), st.integers(0, 2))
STEP = st.tuples(st.sampled_from(["replace", "append", "merge", "clear"]), st.lists(ROW, max_size=5))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(steps=st.lists(STEP, min_size=1, max_size=5))
def test_any_order_of_writes(spark, tmp_path_factory, steps):
    table, want = SnapshotTable(spark, str(tmp_path_factory.mktemp("any"))), None
    for kind, data in steps:
        if kind == "clear":
            table.clear()
            want = want if want is None else []
            continue
        df = rows(spark, data).repartition(2)
        if kind == "merge":
            table.merge(df, ["id"])
            came = {r[0] for r in data}
            want = [r for r in want or [] if r[0] not in came] + data
        else:
            getattr(table, kind)(df)
            want = data if kind == "replace" else (want or []) + data
    assert want is None or got(table.read()) == sorted(want, key=str)


def test_two_writers(spark, root, monkeypatch):
    table, other = SnapshotTable(spark, root), SnapshotTable(spark, root)
    table.replace(rows(spark, [(1, "a", 1), (2, "b", 2)]))
    commit, rivals = SnapshotTable._commit, [rows(spark, [(2, "rival", 9)]), rows(spark, [(3, "rival", 9)])]

    def late(self, version):
        if self is table and rivals:
            other.merge(rivals.pop(), ["id"])
        return commit(self, version)

    monkeypatch.setattr(SnapshotTable, "_commit", late)
    table.merge(rows(spark, [(1, "mine", 5)]), ["id"])
    assert got(table.read()) == [(1, "mine", 5), (2, "rival", 9), (3, "rival", 9)]
    rivals.append(rows(spark, [(4, "rival", 9)]))
    table.append(rows(spark, [(5, "mine", 5)]))
    assert [r[0] for r in got(table.read())] == [1, 2, 3, 4, 5]
    rivals.append(rows(spark, [(4, "rival", 9)]))
    assert table.replace(rows(spark, [(7, "mine", 0)])).number == 8 and got(table.read()) == [(7, "mine", 0)]
    monkeypatch.setattr(SnapshotTable, "_commit", lambda self, version: False)
    for write in (table.append, lambda df: table.merge(df, ["id"])):
        with pytest.raises(Conflict):
            write(rows(spark, [(8, "mine", 0)]))
    monkeypatch.undo()
    assert got(table.read()) == [(7, "mine", 0)]


def test_catalog_table_keeps_its_rows_when_a_write_fails(spark):
    tables.create_layers(spark)
    name = f"curated.kept_{random.randrange(10**9)}"
    tables.ctas(rows(spark, [(1, "a", 1)]), name)
    with pytest.raises(Exception, match="torn"):
        tables.ctas(torn(rows(spark, [(i, "b", i) for i in range(5)])), name)
    assert got(spark.table(name)) == [(1, "a", 1)]
    tables.ctas(spark.table(name).withColumn("n", F.lit(7)), name)
    assert got(spark.table(name)) == [(1, "a", 7)]
    tables.ctas(rows(spark, [(1, "a", 1)]).select("id"), name)  # other columns
    assert got(spark.table(name)) == [(1,)]
    tables.append(spark.range(1).toDF("id"), name)
    assert got(spark.table(name)) == [(0,), (1,)]


def test_export_lists_its_files(spark, root):
    tables.create_layers(spark)
    path = f"{root}/open"
    for n in (3, 4):
        tables.export_open(spark.range(n), path)
        listed = files.read_text(spark, f"{path}/_symlink_format_manifest/manifest").split()
        assert spark.read.parquet(*listed).count() == n == tables.read(spark, path).count()
        plain = spark.read.parquet(path)
        assert plain.columns == ["id"] and plain.count() == n
    with pytest.raises(Exception, match="torn"):
        tables.export_open(torn(rows(spark, [(i, "b", i) for i in range(8)]).repartition(8)), path)
    assert tables.read(spark, path).count() == 4 == spark.read.parquet(path).count()
    tables.append(spark.range(2), path)
    assert tables.read(spark, path).count() == 6
    tables.export_open(spark.range(5), f"{root}/named", "gold.named_export")
    listed = files.read_text(spark, f"{root}/named/_symlink_format_manifest/manifest").split()
    assert spark.read.parquet(*listed).count() == 5 == spark.table("gold.named_export").count()
    assert not snapshots.is_snapshot(spark, f"{root}/nothing")
