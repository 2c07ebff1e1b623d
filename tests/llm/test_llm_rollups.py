"""Rollups: signed changes, batches that come twice, compaction."""

from __future__ import annotations

import duckdb
import pytest
from oracle import connect, difference

from flowgauge.llm import delta_rollups as D
from flowgauge.llm.entry import QUERIES
from flowgauge.sources.scratch import fresh_dir

CHANGE = f"before {D.TOTALS_STATE}, after {D.TOTALS_STATE}, extra string, docs int"


def changes(spark, rows):
    return spark.createDataFrame([(b, a, "x", 5) for b, a in rows], CHANGE)


def totals(rollup):
    return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}


@pytest.fixture
def rollup(spark):
    return D.Rollup.create(spark, fresh_dir(spark, "rollup-test"))


def test_query(spark, sf_dir):
    entry = QUERIES["op7_delta_rollups"]
    assert difference(entry.run(spark, sf_dir), connect(sf_dir), entry.sql) is None


def test_query_with_null_ids_and_repeated_rows(spark, tmp_path):
    rows = [(1, "a b", "en"), (1, "a b", "en"), (None, "x-y", "de"), (None, "x-y", "de"), (2, None, "en"), (3, "", "en"), (None, "a b", "en"), (4, "a b", "de")]
    frame = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    frame.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    entry = QUERIES["op7_delta_rollups"]
    found = sorted(tuple(r) for r in entry.run(spark, folder).collect())
    assert found == [("s", "de", "alnum-2", 1, 2), ("s", "en", "words-1", 2, 2)]
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    assert found == sorted(con.execute(entry.sql).fetchall())


def test_signed_changes(spark, rollup):
    a, b = ("s", "en", "v1", 10), ("s", "en", "v1", 4)
    assert totals(rollup) == {}
    assert rollup.commit("1", changes(spark, [(None, a), (None, b), (None, (None, None, None, None))]))
    assert totals(rollup) == {("s", "en", "v1"): (2, 14), (None, None, None): (1, 0)}
    assert rollup.commit("2", changes(spark, [(a, None), (b, ("s", "en", "v2", 5)), ((None, None, None, None), None), (None, None)]))
    assert totals(rollup) == {("s", "en", "v2"): (1, 5)}


def test_a_batch_counts_once(spark, rollup):
    batch = changes(spark, [(None, ("s", "en", "v1", 10))])
    assert rollup.commit("1", batch) and not rollup.commit("1", batch)
    assert not D.Rollup(spark, rollup.base).commit("1", changes(spark, [(None, ("other", "en", "v1", 1))]))
    assert totals(rollup) == {("s", "en", "v1"): (1, 10)}
    # Two drivers that both wrote the batch before either was in the ledger.
    folder = f"{rollup.base}/deltas-zzz"
    D.signed_sums(batch).write.parquet(folder)
    rollup._append(rollup._named("1", folder))
    assert totals(rollup) == {("s", "en", "v1"): (1, 10)}


def test_a_folder_without_a_ledger_row_is_not_read(spark, rollup):
    D.signed_sums(changes(spark, [(None, ("s", "en", "v1", 10))])).write.parquet(f"{rollup.base}/deltas-lost")
    assert totals(rollup) == {}


def test_an_empty_batch_and_repeated_rows(spark, rollup):
    assert rollup.commit("0", changes(spark, [])) and not rollup.commit("0", changes(spark, []))
    rollup.commit("1", changes(spark, [(None, ("s", None, "v", 3))] * 4))
    assert totals(rollup) == {("s", None, "v"): (4, 12)}


def test_compaction_keeps_totals_and_batches(spark, rollup):
    for i in range(3):
        rollup.commit(str(i), changes(spark, [(None, ("s", "en", "v1", i))]))
    compacted = rollup.compact(fresh_dir(spark, "rollup-test"))
    assert totals(compacted) == totals(rollup) == {("s", "en", "v1"): (3, 3)}
    assert not compacted.commit("1", changes(spark, [(None, ("s", "en", "v1", 9))]))
    assert compacted.commit("3", changes(spark, [(None, ("s", "en", "v1", 1))]))
    again = compacted.compact(fresh_dir(spark, "rollup-test"))
    assert totals(again) == {("s", "en", "v1"): (4, 4)} and not again.commit("3", changes(spark, []))
    with pytest.raises(ValueError, match="not the name"):
        again.commit(D.SUMMARY, changes(spark, []))
