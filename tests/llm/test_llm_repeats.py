"""Substring dedup against a plain scan."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from llm_frames import PASSAGE, WORD, documents_of, edge_documents, edge_rows

from flowgauge.llm import super_kmers as K
from flowgauge.llm.entry import QUERIES


def keep(rows, width=20):
    """Kept words of rows in the order (id, position), rows without an id last."""
    seen, out = set(), {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    for i in order:
        words = WORD.findall(rows[i][1] or "")
        covered = [False] * len(words)
        for a in range(len(words) - width + 1):
            window = tuple(words[a : a + width])
            if window in seen:
                covered[a : a + width] = [True] * width
            seen.add(window)
        out[i] = (len(words), sum(covered), " ".join(w for w, c in zip(words, covered) if not c))
    return out


def test_query(spark, sf_dir):
    docs = documents_of(spark, sf_dir)
    expected = {docs[i][0]: x for i, x in keep(docs).items()}
    rows = QUERIES["op8_super_kmers"].run(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, removed, kept = expected[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, removed, hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("block", [1, 1000, 1 << 24])
def test_edges_in_blocks_of_any_size(spark, monkeypatch, block):
    monkeypatch.setattr(K, "BLOCK_BYTES", block)
    rows = [r[:2] for r in edge_rows()]
    expected = sorted((x[0], x[1], x[2]) for x in keep(rows).values())
    frame = edge_documents(spark).coalesce(1)
    found = sorted((r["n_words"], r["n_removed"], r["kept"]) for r in K.drop_repeats(frame).collect())
    assert found == expected
    assert K.drop_repeats(edge_documents(spark, [])).count() == 0


def test_texts_that_keep_all_words_stay_as_written(spark):
    frame = edge_documents(spark, [(1, f" two  spaces\n{PASSAGE}\n", "en"), (2, f"then {PASSAGE}", "en")])
    rows = {r["id"]: r["kept"] for r in K.drop_repeats(frame, as_written=True).collect()}
    assert rows == {1: f" two  spaces\n{PASSAGE}\n", 2: "then"}


def test_equal_hashes_do_not_decide():
    numbers = np.array([1, 2, 1, 3, 1, 2, 1, 3, 9])
    starts = np.arange(8)
    same = np.zeros(8, np.uint64)
    exact = K.later_windows(numbers, same, starts, 2)
    assert exact.tolist() == [False, False, False, False, True, True, True, False]


def test_sliding_least():
    draw = np.random.default_rng(0)
    for width in range(1, 20):
        x = draw.integers(0, 100, 50)
        assert K.sliding_least(x, width).tolist() == [x[i : i + width].min() for i in range(51 - width)]
