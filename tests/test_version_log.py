"""The log's own queries: ancestors through nested rollbacks, row totals, versions by time."""

import pytest

from tidemark.plans.versioned import VersionedTable


def walked(table):
    """Ancestors of the newest version, found by following the log by hand."""
    by = {r.version: r for r in table.commits().collect()}
    out, v = set(), max(by)
    while v is not None:
        out.add(v)
        v = by[v].target if by[v].operation == "rollback" else by[v].parent
    return out


def test_ancestors_and_totals_through_nested_rollbacks(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    now = lambda: f"2024-01-01 00:00:{len(t._log()):02d}"
    put = lambda n: t.commit(spark.range(n), now())
    for n in (3, 4, 5):
        put(n)                     # 1, 2, 3
    t.rollback_to(2, now())  # 4
    put(7)                         # 5
    t.compact(now())         # 6
    t.rollback_to(1, now())  # 7: cuts off 2 to 6, the first rollback included
    put(2)                         # 8
    t.rollback_to(5, now())  # 9: back into what was cut off
    for check in (1, 2):
        history = {r["version"]: r["is_current_ancestor"] for r in t.history().collect()}
        assert {v for v, kept in history.items() if kept} == walked(t) and len(history) == 7 + 2 * check
        growth = {r["version"]: (r["added_rows"], r["total_rows"], r["growing"]) for r in t.rows_growing().collect()}
        assert growth[3] == (5, 12, True) and growth[4] == (0, 7, False) and growth[5] == (7, 14, True)
        assert growth[6] == (0, 14, False) and growth[7] == (0, 3, False) and growth[8] == (2, 5, True) and growth[9] == (0, 14, True)
        assert t.snapshot().count() == growth[max(growth)][1]
        put(1)                     # 10, 12
        t.add_column(f"c{check}", "string", now())  # 11, 13
    assert t.version_at("2024-01-01 00:00:05") == 6
    with pytest.raises(ValueError, match="no version"):
        t.version_at("2020-01-01 00:00:00")


def test_an_empty_log(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    assert t.history().count() == t.rows_growing().count() == t.snapshots().count() == 0
