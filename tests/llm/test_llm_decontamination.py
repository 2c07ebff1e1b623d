"""Positional index: exact and proximity matches against plain scans."""

from __future__ import annotations

import re

from llm_frames import edge_documents, edge_rows, low
from oracle import connect, difference

from flowgauge.llm import positional_index as X
from flowgauge.llm.entry import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(low(text))


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, phrase int, word string")


def plain(docs, items, width):
    phrases = {}
    for i, text in items:
        w = words(text)
        for a in range(max(1, len(w) - width + 1)) if w else []:
            phrases.setdefault(tuple(w[a : a + width]), set()).add(i)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for phrase, owners in phrases.items():
            for a in range(len(w) - len(phrase) + 1):
                if tuple(w[a : a + len(phrase)]) == phrase:
                    hit |= set(range(a, a + len(phrase)))
                    found |= owners - {None}
        out.append((i if i is not None else -1, len(w), len(hit), len(found), sorted(map(str, found))))
    return sorted(out)


def found(docs, items, width):
    rows = X.decontaminate(docs, items, width).collect()
    return sorted((r["id"] if r["id"] is not None else -1, r["n_words"], r["n_hit"], r["n_items"], r["items"]) for r in rows)


ITEMS = [
    (1, "lazy dog Été naïve été quick"), (2, "the LAZY dog"), (2, "the lazy dog"), (3, None), (4, "..."), (None, "One"), (5, "a b a b"),
    (6, "b c a b a"), (7, "never seen words"), (8, " ".join(f"shared{i}" for i in range(20, 45))), (9, "中文 中文"), (10, "İı"), (11, "x" * 5000),
    (12, "w5x5 w6x6 w7x7"),
]


def test_query(spark, sf_dir):
    entry = QUERIES["op10_positional_index"]
    assert difference(entry.run(spark, sf_dir), connect(sf_dir), entry.sql) is None


def test_edges(spark):
    docs = [r[:2] for r in edge_rows()]
    for width in (1, 2, 3, 10):
        assert found(edge_documents(spark), items_frame(spark, ITEMS), width) == plain(docs, ITEMS, width)


def test_empty_tables(spark):
    docs = [r[:2] for r in edge_rows()]
    assert found(edge_documents(spark), items_frame(spark, []), 3) == plain(docs, [], 3)
    assert found(edge_documents(spark, []), items_frame(spark, ITEMS), 3) == []


def test_beyond_the_broadcast_bound(spark):
    """The same result when Spark may broadcast nothing."""
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = [r[:2] for r in edge_rows()]
        assert found(edge_documents(spark), items_frame(spark, ITEMS), 3) == plain(docs, ITEMS, 3)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_proximity(spark):
    docs = [
        (1, "alpha beta gamma"), (2, "gamma x beta y alpha"), (3, "alpha beta x x x x x x x gamma"), (4, "alpha beta"),
        (5, "beta gamma alpha beta alpha"), (6, None), (7, "beta " * 50 + "alpha gamma"),
    ]
    items = [(1, "alpha beta gamma"), (2, "beta alpha"), (3, "gamma")]
    phrases = X.windows_of(items_frame(spark, items), 3)
    index = X.build_index(edge_documents(spark, [(*d, "en") for d in docs]), phrases.vocabulary)
    ranked = X.ranked_terms(index, phrases.terms)
    ids = {r["at"]: r["id"] for r in index.where("term = -1").collect()}
    names = {r["phrase"]: r["item_id"] for r in phrases.owners.collect()}
    for reach in (1, 2, 4, 20):
        got = {(ids[r["at"]], names[r["phrase"]], r["pos"]) for r in X.proximity_matches(index, ranked, reach).collect()}
        rarest = {r["phrase"]: r["term"] for r in ranked.where("rank = 1").collect()}
        term_names = {r["term"]: r["word"] for r in phrases.vocabulary.collect()}
        anchors = {names[p]: term_names[t] for p, t in rarest.items()}
        wanted = set()
        for d, text in docs:
            w = words(text)
            for i, item in items:
                for p, x in enumerate(w):
                    if x == anchors[i] and all(any(y == t and abs(q - p) <= reach for q, y in enumerate(w)) for t in words(item)):
                        wanted.add((d, i, p))
        assert got == wanted


def test_no_python_on_executors(spark, sf_dir):
    plan = QUERIES["op10_positional_index"].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan
