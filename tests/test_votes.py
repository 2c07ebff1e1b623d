from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowgauge.operators import voting as ops


def _expected(votes):
    votes = [x for x in votes if x is not None]
    best = max(Counter(votes).values(), default=0)
    return next((x for x in votes if votes.count(x) == best), 0.0)


def _table(spark, rows):
    columns = [f"pred_{i}" for i in range(len(rows[0]))]
    return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} double" for c in columns)), columns


@pytest.mark.parametrize(
    "votes, expected",
    [((1.0, 2.0, 2.0, 1.0), 1.0), ((None, 2.0, None, None), 2.0), ((None,) * 4, 0.0), ((3.0, 1.0, 1.0, 2.0), 1.0)],
)
def test_ties_and_nulls(spark, votes, expected):
    df, columns = _table(spark, [votes])
    assert ops.with_vote(df, columns).first().final_prediction == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 10).flatmap(
    lambda n: st.lists(st.lists(st.sampled_from([None, 0.0, 1.0, 2.0, 3.0]), min_size=n, max_size=n), min_size=20, max_size=60)
))
def test_vote_equals_counting(spark, rows):
    df, columns = _table(spark, rows)
    got = [r.final_prediction for r in ops.with_vote(df.coalesce(1), columns).collect()]
    assert got == [_expected(r) for r in rows]


def test_vote_stays_out_of_python(spark, capsys):
    df, columns = _table(spark, [(1.0, 2.0, 3.0)])
    voted = ops.with_vote(df, columns)
    voted.explain()
    assert "Python" not in capsys.readouterr().out
    assert "_votes" not in voted.columns


def test_members_line_up_by_row_key(spark):
    a = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 2.0)], "flow_id long, prediction double")
    b = spark.createDataFrame([(3, 5.0), (1, 4.0)], "flow_id long, prediction double")
    rows = {tuple(r) for r in ops.line_up_votes([a, b], "flow_id").collect()}
    assert rows == {(1, 0.0, 4.0), (3, 2.0, 5.0)}


def test_agreement_counts_members(spark):
    df, columns = _table(spark, [(1.0, 1.0, None, 2.0)])
    assert ops.with_vote(df, columns).select(ops.agreement(columns).alias("n")).first().n == 2
    assert df.select(F.lit(1)).count() == 1
