"""Ties between rows that differ in which column is NULL, map columns, and the change feed between versions."""

from pyspark.sql import functions as F

from tidemark.operators.upsert import upsert_by_key
from tidemark.plans.versioned import VersionedTable


def test_upsert_ties_count_nulls_by_place_and_take_maps(spark):
    rows = [(1, None, 1, "x", None, {"a": 1}), (1, None, 1, None, "x", {"a": 1}), (2, 5, 1, None, None, None), (2, 6, 1, "y", None, {})]
    df = spark.createDataFrame(rows, "k long, ts long, seq long, a string, b string, m map<string, int>")
    first = [upsert_by_key(d, ["k"]).orderBy("k").collect() for d in (df, df.orderBy(F.desc("a")).repartition(3), df.orderBy("a").coalesce(1))]
    assert first[0] == first[1] == first[2] and first[0][1]["ts"] == 6 and first[0][0]["m"] == {"a": 1}


def test_diff_reads_old_batches_for_touched_keys_only(spark, tmp_root):
    t = VersionedTable(spark, tmp_root, keys=["id"], ts="ts", seq="seq")
    schema = "id long, ts long, seq long, v string"
    t.commit(spark.createDataFrame([(i, 1, i, "old") for i in range(50)] + [(None, 1, 99, "null")], schema))
    t.commit(spark.createDataFrame([(3, 2, 100, "new"), (60, 2, 101, "new"), (None, 2, 102, "newer"), (4, 0, 103, "stale")], schema))
    want = [(3, "changed"), (60, "added"), (None, "changed")]
    got = t.diff(1, 2)
    assert sorted(((r["id"], r["change"]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(((r["id"], r["change"]) for r in t.diff(2, 1).collect()), key=repr) == sorted(
        [(3, "changed"), (60, "removed"), (None, "changed")], key=repr)
    assert t.diff(2, 2).count() == 0
    t.compact()
    assert t.diff(2, 3).count() == 0 and t.diff(1, 3).count() == 3
