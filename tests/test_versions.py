"""versions / evolved fixtures on the versioned table."""

import pytest

from tidemark.plans.versioned import VersionedTable


def _rows(spark, rows):
    return spark.createDataFrame(rows, "symbol string, ts long, price double, seq long")


def test_versions_as_of_history_rollback_diff(spark, tmp_root):
    vt = VersionedTable(spark, tmp_root, keys=["symbol"], ts="ts", seq="seq")
    v1 = vt.commit(_rows(spark, [("A", 1, 10.0, 1)]), "2024-01-01 00:00:00")
    v2 = vt.commit(_rows(spark, [("B", 2, 20.0, 2), ("C", 2, 30.0, 3)]), "2024-01-02 00:00:00")
    v3 = vt.commit(_rows(spark, [("B", 3, 21.0, 4)]), "2024-01-03 00:00:00")
    assert (v1, v2, v3) == (1, 2, 3)
    snap = lambda v: sorted((r.symbol, r.price) for r in vt.snapshot(v).collect())
    assert snap(1) == [("A", 10.0)]
    assert snap(2) == [("A", 10.0), ("B", 20.0), ("C", 30.0)]
    assert snap(None) == [("A", 10.0), ("B", 21.0), ("C", 30.0)]
    assert vt.version_at("2024-01-02 12:00:00") == 2
    d = {(r.symbol, r.change) for r in vt.diff(2, 3).collect()}
    assert d == {("B", "changed")}
    d = {(r.symbol, r.change) for r in vt.diff(1, 3).collect()}
    assert d == {("B", "added"), ("C", "added")}
    v4 = vt.rollback_to(2, "2024-01-04 00:00:00")
    assert snap(None) == snap(2)
    hist = {r.version: r.is_current_ancestor for r in vt.history().collect()}
    assert hist == {1: True, 2: True, 3: False, 4: True}
    # A commit after the rollback builds on the rolled-back state.
    vt.commit(_rows(spark, [("D", 5, 40.0, 5)]), "2024-01-05 00:00:00")
    assert snap(None) == [("A", 10.0), ("B", 20.0), ("C", 30.0), ("D", 40.0)]
    assert v4 == 4
    snaps = {r.version: r.added_rows for r in vt.snapshots().collect()}
    assert snaps == {1: 1, 2: 2, 3: 1, 4: 0, 5: 1}
    assert vt.manifests().count() == 4 and vt.files().count() >= 4


def test_evolved_schema(spark, tmp_root):
    vt = VersionedTable(spark, tmp_root)
    vt.commit(spark.createDataFrame([(1, "A", 7)], "id long, symbol string, n int"), "2024-01-01 00:00:00")
    vt.add_column("exchange", "string")
    vt.commit(spark.createDataFrame([(2, "B", 8, "X")], "id long, symbol string, n int, exchange string"))
    vt.rename_column("exchange", "venue")
    vt.widen_type("n", "bigint")
    vt.commit(spark.createDataFrame([(3, "C", 2**40, "Y")], "id long, symbol string, n long, venue string"))
    df = vt.snapshot()
    assert df.columns == ["id", "symbol", "n", "venue"]
    assert dict(df.dtypes)["n"] == "bigint"
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(1, "A", 7, None), (2, "B", 8, "X"), (3, "C", 2**40, "Y")]
    with pytest.raises(ValueError):
        vt.widen_type("symbol", "int")
    with pytest.raises(ValueError):
        vt.rename_column("nope", "x")
    with pytest.raises(ValueError):
        vt.rename_column("symbol", "n")
    with pytest.raises(ValueError):
        vt.drop_column("nope")
    vt.drop_column("venue")
    vt.reorder_columns(["symbol", "id"])
    assert vt.snapshot().columns == ["symbol", "id", "n"]
    # Old versions keep their own schema.
    assert vt.snapshot(1).columns == ["id", "symbol", "n"]


def test_commit_is_idempotent_per_batch(spark, tmp_root):
    """Rewriting a batch directory (a replayed commit) does not duplicate rows."""
    vt = VersionedTable(spark, tmp_root)
    df = spark.createDataFrame([(1, "A")], "id long, symbol string")
    vt.commit(df)
    df.write.mode("overwrite").parquet(f"{vt.data_path}/batch_id=1")
    assert vt.snapshot().count() == 1


def test_append_only_diff_reads_batches(spark, tmp_root):
    vt = VersionedTable(spark, tmp_root)
    for i in range(3):
        vt.commit(spark.createDataFrame([(i, f"S{i}")], "id long, symbol string"))
    vt.rollback_to(1)
    got = sorted((r.id, r.change) for r in vt.diff(3, 4).collect())
    assert got == [(1, "removed"), (2, "removed")]
    got = sorted((r.id, r.change) for r in vt.diff(1, 3).collect())
    assert got == [(1, "added"), (2, "added")]


def test_commit_token_makes_retry_a_no_op(spark, tmp_root):
    vt = VersionedTable(spark, tmp_root)
    df = spark.createDataFrame([(1, "A")], "id long, symbol string")
    assert vt.commit(df, token="q:0") == 1
    assert vt.commit(df, token="q:0") == 1          # retried micro-batch
    assert vt.commit(df, token="q:1") == 2
    assert vt.snapshot().count() == 2
    assert vt.refresh().current_version() == 2
