"""Status upsert: update-if-changed, inserts, NULL keys, duplicate sources, snapshots."""

import datetime as dt
import os
import tempfile

import pytest

from ledgerlint.operators.merge import DuplicateSourceKeys, merge_status
from ledgerlint.session import ensure_checkpoint_dir
from ledgerlint.sources.sinks import ConcurrentUpsert, StatusTable

SRC = ("market_code string, division_code string, point_of_sale_code string, client_name string, "
       "source_project string, year bigint, month bigint, channel_level1 string, channel_level2 string, "
       "data_source_frequency string, missing_file_count bigint, missing_file bigint")
T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)


def src(spark, rows):
    return spark.createDataFrame([("AU", d, p, "C", "P", 2024, m, "L1", "L2", "Daily", n, f)
                                  for d, p, m, n, f in rows], SRC)


def as_map(df):
    return {(r["division_code"], r["point_of_sale_code"], r["month"]):
            (r["missing_file_count"], r["missing_file"], r["last_updated_timestamp"], r["last_invoked_timestamp"])
            for r in df.collect()}


def test_first_run_inserts_everything(spark):
    s1 = merge_status(None, src(spark, [("A", "p", 1, 3, 1)]), T1)
    assert as_map(s1) == {("A", "p", 1): (3, 1, T1, T1)}


def test_update_only_when_changed_and_keep_target_only_rows(spark):
    s1 = merge_status(None, src(spark, [("A", "p", 1, 3, 1), ("A", "p", 2, 0, 0), ("A", "p", 3, None, 2)]), T1)
    s2 = merge_status(s1, src(spark, [("A", "p", 1, 3, 1), ("A", "p", 2, 4, 1), ("A", "p", 4, 1, 1)]), T2)
    assert as_map(s2) == {
        ("A", "p", 1): (3, 1, T1, T2),        # unchanged: only last_invoked moves
        ("A", "p", 2): (4, 1, T2, T2),        # changed: count, flag and last_updated
        ("A", "p", 3): (None, 2, T1, T2),     # target only: kept
        ("A", "p", 4): (1, 1, T2, T2),        # source only: inserted
    }


def test_null_counts_do_not_trigger_and_null_keys_never_match(spark):
    s1 = merge_status(None, src(spark, [("A", "p", 1, None, 2), (None, "p", 1, 1, 1)]), T1)
    s2 = merge_status(s1, src(spark, [("A", "p", 1, None, 2), (None, "p", 1, 1, 1)]), T2)
    rows = [(r["division_code"], r["missing_file_count"], r["last_updated_timestamp"]) for r in s2.collect()]
    assert sorted(rows, key=str) == sorted([("A", None, T1), (None, 1, T1), (None, 1, T2)], key=str)


def test_running_twice_with_the_same_source_changes_only_last_invoked(spark):
    rows = [("A", "p", m, m % 3, 1 if m % 3 else 0) for m in range(1, 13)]
    s1 = merge_status(None, src(spark, rows), T1)
    s2 = merge_status(s1, src(spark, rows), T2)
    a, b = as_map(s1), as_map(s2)
    assert a.keys() == b.keys()
    assert all(a[k][:3] == b[k][:3] and b[k][3] == T2 for k in a)


def test_duplicate_source_rows_for_one_target_row_raise(spark):
    s1 = merge_status(None, src(spark, [("A", "p", 1, 3, 1)]), T1)
    dup = src(spark, [("A", "p", 1, 3, 1), ("A", "p", 1, 4, 1)])
    with pytest.raises(DuplicateSourceKeys):
        merge_status(s1, dup, T2)


def test_status_table_snapshots(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="ledgerlint-status-", dir="/tmp"), "status")
    table = StatusTable(spark, root)
    assert table.current_version() == 0 and table.read().count() == 0
    assert table.upsert(src(spark, [("A", "p", 1, 3, 1)]), T1) == 1
    assert table.upsert(src(spark, [("A", "p", 1, 5, 1), ("A", "q", 1, 0, 0)]), T2) == 2
    assert as_map(table.read()) == {("A", "p", 1): (5, 1, T2, T2), ("A", "q", 1): (0, 0, T2, T2)}
    assert as_map(table.read(1)) == {("A", "p", 1): (3, 1, T1, T1)}
    assert table.upsert(src(spark, [("A", "p", 1, 5, 1)]), T3) == 3
    assert as_map(table.read())[("A", "p", 1)] == (5, 1, T2, T3)


def _new_table(spark):
    return StatusTable(spark, os.path.join(tempfile.mkdtemp(prefix="ledgerlint-status-", dir="/tmp"), "status"))


def test_upsert_goes_on_after_a_crash_before_the_commit(spark):
    table = _new_table(spark)
    table.upsert(src(spark, [("A", "p", 1, 3, 1)]), T1)
    table.write_attempt(src(spark, [("A", "p", 1, 9, 1)]), T2, 1)  # died before the manifest row
    assert table.current_version() == 1 and as_map(table.read()) == {("A", "p", 1): (3, 1, T1, T1)}
    assert table.upsert(src(spark, [("A", "p", 1, 5, 1)]), T3) == 2
    assert as_map(table.read()) == {("A", "p", 1): (5, 1, T3, T3)}


def test_upsert_goes_on_after_a_crash_inside_the_data_write(spark):
    table = _new_table(spark)
    os.makedirs(os.path.join(table.root, "data", "half", "_temporary"))
    assert table.upsert(src(spark, [("A", "p", 1, 3, 1)]), T1) == 1
    assert table.vacuum() == [f"{table.root}/data/half"]


def test_a_version_is_committed_once(spark):
    table = _new_table(spark)
    a = table.write_attempt(src(spark, [("A", "p", 1, 3, 1)]), T1, 0)
    b = table.write_attempt(src(spark, [("A", "p", 1, 4, 1)]), T1, 0)
    assert table.commit(a, 0) == 1
    with pytest.raises(ConcurrentUpsert):
        table.commit(b, 0)
    assert as_map(table.read()) == {("A", "p", 1): (3, 1, T1, T1)}


def test_vacuum_keeps_the_newest_versions_and_staged_data_is_removed(spark):
    table = _new_table(spark)
    folder = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "staged")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    for i, ts in enumerate((T1, T2, T3)):
        table.upsert(src(spark, [("A", "p", 1, i, 1)]), ts)
    assert set(os.listdir(folder)) == before
    assert len(table.vacuum(keep=2)) == 1 and len(os.listdir(os.path.join(table.root, "data"))) == 2
    assert as_map(table.read(2))[("A", "p", 1)][0] == 1 and as_map(table.read())[("A", "p", 1)][0] == 2


def test_repeated_source_rows_raise_even_if_they_change_nothing(spark):
    """The reference's MERGE has one update clause; which row would win is undefined, so any repeat is refused."""
    s1 = merge_status(None, src(spark, [("A", "p", 1, 3, 1)]), T1)
    with pytest.raises(DuplicateSourceKeys):
        merge_status(s1, src(spark, [("A", "p", 1, 3, 1), ("A", "p", 1, 3, 1)]), T2)


def test_the_upsert_counts_what_it_writes(spark):
    table = _new_table(spark)
    first = table.write_attempt(src(spark, [("A", "p", 1, 3, 1), (None, "p", 1, 1, 1), ("A", "p", 2, None, 2)]), T1, 0)
    assert table.observed[first] == {"source_rows": 3, "null_keys": 1, "n_rows": 3, "from_target": 0, "matched": 0, "updated": 0, "inserted": 3}
    table.commit(first, 0)
    second = table.write_attempt(src(spark, [("A", "p", 1, 4, 1), (None, "p", 1, 1, 1), ("A", "p", 2, None, 2), ("A", "p", 9, 0, 0)]), T2, 1)
    assert table.observed[second] == {"source_rows": 4, "null_keys": 1, "n_rows": 5, "from_target": 3, "matched": 2, "updated": 1, "inserted": 2}
    table.commit(second, 1)
    assert [r["n_rows"] for r in table._versions().orderBy("version").collect()] == [3, 5]


def test_repeated_source_rows_for_a_written_row_fail_the_attempt(spark):
    table = _new_table(spark)
    table.upsert(src(spark, [("A", "p", 1, 3, 1), ("A", "p", 2, 3, 1)]), T1)
    with pytest.raises(DuplicateSourceKeys, match="point_of_sale_code"):
        table.upsert(src(spark, [("A", "p", 1, 3, 1), ("A", "p", 1, 4, 1)]), T2)
    assert table.current_version() == 1 and table.read().count() == 2
    # repeated rows that meet no row of the table are inserted, as a MERGE does
    assert table.upsert(src(spark, [("B", "p", 1, 3, 1), ("B", "p", 1, 4, 1), (None, "p", 1, 0, 0), (None, "p", 1, 0, 0)]), T2) == 2
    assert table.read().count() == 6
    # one source row may then meet both
    assert table.upsert(src(spark, [("B", "p", 1, 9, 1)]), T3) == 3
    assert sorted(r["missing_file_count"] for r in table.read().where("division_code = 'B'").collect()) == [9, 9]


def test_empty_sources_and_manifests_without_counts(spark):
    table = _new_table(spark)
    assert table.upsert(src(spark, []), T1) == 1 and table.read().count() == 0
    assert table.upsert(src(spark, [("A", "p", 1, 3, 1)]), T2) == 2
    assert table.upsert(src(spark, []), T3) == 3 and as_map(table.read()) == {("A", "p", 1): (3, 1, T2, T3)}
    older = table.write_attempt(src(spark, [("A", "p", 1, 5, 1)]), T3, 3)
    table.observed.clear()  # a manifest row of an older library has no count
    table.commit(older, 3)
    assert table._n_rows(4) == 1
    assert table.upsert(src(spark, [("A", "p", 1, 6, 1)]), T3) == 5


def test_the_source_is_read_once(spark):
    table = _new_table(spark)
    table.upsert(src(spark, [("A", "p", 1, 3, 1)]), T1)
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = src(spark, [("A", "p", m, 3, 1) for m in range(1, 11)])
    table.upsert(rows.mapInArrow(count, rows.schema), T2)
    assert reads.value == 10
