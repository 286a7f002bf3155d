import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmere.operators.intervals import merge_intervals


def brute(rows):
    out = set()
    for e in {r[0] for r in rows}:
        spans = sorted((s, t) for x, s, t in rows if x == e and s is not None and t is not None and t > s)
        now = None
        for s, t in spans:
            if now and s <= now[1]:
                now[1] = max(now[1], t)
            else:
                if now:
                    out |= {(e, "period", *now), (e, "gap", now[1], s)}
                now = [s, t]
        if now:
            out.add((e, "period", *now))
    return out


def merged(spark, rows):
    df = spark.createDataFrame(rows, "who string, a bigint, b bigint").withColumnRenamed("a", "entity")
    got = [tuple(r) for r in merge_intervals(df, "who", "entity", "b").collect()]
    assert len(got) == len(set(got))
    return set(got)


CASES = [
    [],
    [("x", 0, 10), ("x", 10, 12), ("x", 13, 14), ("y", 5, 6)],
    [("x", 0, 100), ("x", 5, 6), ("x", 7, 8), ("x", 101, 102)],
    [(None, 0, 5), (None, 9, 10), ("x", 1, 2)],
    [("x", 3, 3), ("x", None, 4), ("x", 5, None), ("x", 9, 1)],
    [("x", 1, 2)] * 7,
]


@pytest.mark.parametrize("rows", CASES)
def test_cases(spark, rows):
    assert merged(spark, rows) == brute(rows)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("aab"), st.integers(0, 400), st.integers(1, 12)), max_size=150))
def test_random(spark, triples):
    rows = [(e, s, s + n) for e, s, n in triples]
    assert merged(spark, rows) == brute(rows)


def test_hot_entity_over_many_partitions(spark):
    rows = [("hot", i * 7 % 5000, i * 7 % 5000 + (900 if i % 97 == 0 else 3)) for i in range(3000)] + [(f"e{i}", i, i + 5) for i in range(50)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert merged(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
