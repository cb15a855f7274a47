"""Upserts into bucketed tables: results, late and replayed updates, and a stored side that is not shuffled."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.upsert import upsert_by_key
from tidemark.plans import bucketed as buck

SCHEMA = "id long, ts long, seq long, v string, m map<string, int>"


def name(path, tag):
    return f"bucketed_{path.rsplit('-', 1)[-1]}_{tag}"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_merge_is_upsert_over_both_sides(spark, tmp_root):
    base = rows(spark, [(i, 10, i, "old", None) for i in range(200)] + [(5, 11, 1, "newer", {"a": 1}), (900, None, 1, "no time", None)])
    updates = rows(spark, [(3, 20, 1, "new", {"b": 2}), (4, 9, 1, "late", None), (5, 11, 1, None, None), (500, 1, 1, "added", None),
                           (500, 2, 1, "added later", None), (900, 1, 1, "timed", None), (7, 10, 7, "old", None)])
    one, two = name(tmp_root, "a"), name(tmp_root, "b")
    buck.create_bucketed(base, one, f"{tmp_root}/a", ["id"], 4)
    buck.merge_bucketed(spark, one, updates, two, f"{tmp_root}/b", ["id"], 4)
    want = sorted(map(str, upsert_by_key(base.unionByName(updates), ["id"]).select(*base.columns).collect()))
    assert sorted(map(str, spark.table(two).collect())) == want
    # A replay of the updates, and the sides swapped, give the same rows.
    buck.merge_bucketed(spark, two, updates, name(tmp_root, "c"), f"{tmp_root}/c", ["id"], 4)
    assert sorted(map(str, spark.table(name(tmp_root, "c")).collect())) == want
    buck.create_bucketed(updates, name(tmp_root, "d"), f"{tmp_root}/d", ["id"], 4)
    buck.merge_bucketed(spark, name(tmp_root, "d"), base, name(tmp_root, "e"), f"{tmp_root}/e", ["id"], 4)
    assert sorted(map(str, spark.table(name(tmp_root, "e")).collect())) == want


def test_only_the_updates_are_shuffled(spark, tmp_root):
    schema = rows(spark, []).schema
    buck.create_bucketed(rows(spark, [(i, 1, i, "x", None) for i in range(100)]), name(tmp_root, "a"), f"{tmp_root}/a", ["id"], 4)
    # Another session knows the files only.
    spark.sql(f"DROP TABLE {name(tmp_root, 'a')}")
    buck.open_bucketed(spark, name(tmp_root, "r"), f"{tmp_root}/a", schema, ["id"], 4)
    stored = spark.table(name(tmp_root, "r"))
    merged = buck.merged_rows(stored, rows(spark, [(1, 2, 1, "y", None)]).repartition(2), ["id"], 4)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("FullOuter"):]
    left = left[: left.index("FileScan") + 2000].split("\n")
    stored_side = left[: next(i for i, line in enumerate(left) if "FileScan" in line) + 1]
    assert "Bucketed: true" in stored_side[-1] and not any("Exchange" in line for line in stored_side)
    buck.merge_bucketed(spark, name(tmp_root, "r"), rows(spark, [(1, 2, 1, "y", None)]), name(tmp_root, "s"), f"{tmp_root}/s", ["id"], 4)
    files = spark.table(name(tmp_root, "s")).select(F.col("_metadata.file_name").alias("f"), "id").distinct().groupBy("f").count()
    assert files.count() <= 4 and files.agg(F.sum("count")).first()[0] == 100


def test_null_keys_are_refused_and_empty_updates_change_nothing(spark, tmp_root):
    with pytest.raises(Exception, match="key column id is NULL"):
        buck.create_bucketed(rows(spark, [(None, 1, 1, "x", None)]), name(tmp_root, "n"), f"{tmp_root}/n", ["id"], 2)
    buck.create_bucketed(rows(spark, [(1, 1, 1, "x", None)]), name(tmp_root, "a"), f"{tmp_root}/a", ["id"], 2)
    buck.merge_bucketed(spark, name(tmp_root, "a"), rows(spark, []), name(tmp_root, "b"), f"{tmp_root}/b", ["id"], 2)
    assert [r["v"] for r in spark.table(name(tmp_root, "b")).collect()] == ["x"]
    buck.create_bucketed(rows(spark, []), name(tmp_root, "e"), f"{tmp_root}/e", ["id"], 2)
    buck.merge_bucketed(spark, name(tmp_root, "e"), spark.table(name(tmp_root, "a")), name(tmp_root, "f"), f"{tmp_root}/f", ["id"], 2)
    assert [r["v"] for r in spark.table(name(tmp_root, "f")).collect()] == ["x"]
