import random

import pytest

from voxloom.operators.intervals import find_gaps, merge_periods, spans_ms


def brute(rows):
    covered = {}
    for f, a, b in rows:
        covered.setdefault(f, set()).update(range(a, b))
    periods, gaps = set(), set()
    for f, c in covered.items():
        last = first = None
        for x in sorted(c):
            if last is None or x != last + 1:
                if last is not None:
                    periods.add((f, first, last + 1))
                    gaps.add((f, last + 1, x))
                first = x
            last = x
        periods.add((f, first, last + 1))
    return periods, gaps


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("shard", [3, 10, 1000])
def test_random_spans(spark, seed, shard):
    r = random.Random(seed)
    rows = [(r.choice(["a", None]), a := r.randint(-50, 80), a + r.choice([1, 2, 4, 9, 45])) for _ in range(r.choice([1, 5, 40]))]
    df = spark.createDataFrame(rows, "entity string, s long, e long")
    periods, gaps = brute(rows)
    got = [tuple(x) for x in find_gaps(df, shard).collect()]
    assert len(got) == len(set(got)) and set(got) == gaps
    got = [tuple(x) for x in merge_periods(df, shard).collect()]
    assert len(got) == len(set(got)) and set(got) == periods


def test_dirty_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("f", 0.0, 1.0), ("f", 0.0, 1.0), ("f", None, 2.0), ("f", 1.0, nan), ("f", 3.0, 2.0), ("f", 2.0, 2.0), ("f", 1.0, inf), ("f", 1.0000004, 1.5), ("f", 9.0, 9.0004), ("f", 2.0, 1e6)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "file_id string, start double, end double, entity string")
    assert [tuple(x) for x in find_gaps(spans_ms(df)).collect()] == [("f", 1500, 2000)]
    assert {tuple(x) for x in merge_periods(spans_ms(df)).collect()} == {("f", 0, 1500), ("f", 2000, 1_000_000_000)}


def test_empty(spark):
    df = spark.createDataFrame([], "file_id string, start double, end double")
    assert find_gaps(spans_ms(df)).isEmpty() and merge_periods(spans_ms(df)).isEmpty()
