"""Bucketed sessions equal brute-force sessions, including a key with most rows."""

import datetime as dt
import random

import pytest

from tidemark import operators as ops


def brute(rows, gap):
    out = []
    by = {}
    for k, t in rows:
        by.setdefault(k, []).append(t)
    for k, ts in by.items():
        ts.sort()
        start = last = ts[0]
        n = 1
        for t in ts[1:]:
            if t - last > gap:
                out.append((k, start, last + gap, n))
                start, n = t, 0
            last = t
            n += 1
        out.append((k, start, last + gap, n))
    return sorted(out)


@pytest.mark.parametrize("bucket", ["2 minutes", "7 minutes", "1 hour"])
def test_sessions_match_brute_force(spark, bucket):
    rng = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        k = 0 if rng.random() < 0.6 else rng.randrange(1, 20)  # key 0 holds ~60% of rows
        rows.append((k, base + dt.timedelta(seconds=rng.randrange(0, 6 * 3600))))
    rows += [(99, base + dt.timedelta(minutes=5 * i)) for i in range(30)]  # exactly one gap apart
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz").repartition(6)
    got = sorted(tuple(r) for r in ops.sessions(df, ["k"], "ts", "5 minutes", bucket=bucket).collect())
    assert got == brute(rows, dt.timedelta(minutes=5))
