"""SimHash fingerprints and components against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from llm_frames import documents_of, edge_documents, edge_rows, low

from flowgauge.llm import simhash_bktree as S
from flowgauge.llm.components import star_components
from flowgauge.llm.entry import QUERIES


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", low(text).encode())
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest index linked to each, by comparing all pairs."""
    label = list(range(len(prints)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, p in enumerate(prints):
        for j in range(i):
            if (p ^ prints[j]).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(prints))]


def test_query(spark, sf_dir):
    docs = sorted(documents_of(spark, sf_dir))
    prints = [fingerprint(t) for _, t in docs]
    expected = {d: (f"{p:016x}", docs[c][0]) for (d, _), p, c in zip(docs, prints, components(prints))}
    rows = QUERIES["op4_simhash_bktree"].run(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == expected
    assert len(rows) == len(docs)


def test_edges(spark):
    rows = S.near_duplicates(edge_documents(spark)).collect()
    assert len(rows) == len(edge_rows())
    empty = [r for r in rows if r["fp"] == 0]
    assert {r["component_id"] for r in empty} == {1} and sum(r["stays"] for r in empty) == 1
    twins = [r for r in rows if r["id"] in (5, 6)]
    assert len(twins) == 3 and {r["component_id"] for r in twins} == {5} and sum(r["stays"] for r in twins) == 1
    assert S.near_duplicates(edge_documents(spark, [])).count() == 0
    assert [r["component_id"] for r in S.near_duplicates(edge_documents(spark, [(None, "a b", None)])).collect()] == [None]


@pytest.mark.parametrize("seed", range(20))
def test_shards_against_all_pairs(seed):
    draw = np.random.default_rng(seed)
    n = int(draw.integers(1, 300))
    prints = draw.integers(0, 2**63, int(draw.integers(1, 20)), dtype=np.uint64)[np.zeros(n, int)]
    for _ in range(int(draw.integers(0, 7))):
        prints = prints ^ (np.uint64(1) << draw.integers(0, 64, n).astype(np.uint64))
    prints = np.unique(prints)
    u, _ = S.shard_links(np.zeros(len(prints), int), prints, np.ones(len(prints), bool))
    labels = components([int(p) for p in prints])
    assert len(u) == sum(c != i for i, c in enumerate(labels))


@pytest.mark.parametrize("members", [3, 10_000])
def test_every_way_to_shard_finds_all_links(spark, monkeypatch, members):
    """Small limits send all shards through every number of blocks and through the last, cut way."""
    monkeypatch.setattr(S, "SHARD_MEMBERS", members)
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 12, dtype=np.uint64)
    prints = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << draw.integers(0, 64, 12).astype(np.uint64)) for _ in range(6)]))
    labels = components([int(p) for p in prints])
    frame = spark.createDataFrame([(int(p.view(np.int64)),) for p in prints], "fp long")
    rows = star_components(S.near_links(frame)).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["v"], {r["v"]}).add(r["u"])
    expected = {}
    for p, c in zip(prints.view(np.int64).tolist(), labels):
        expected.setdefault(c, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (3, 2), (3, 2)]
    rows = star_components(spark.createDataFrame(path, "u long, v long")).collect()
    assert {r["u"]: r["v"] for r in rows} == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 60)}}
    assert len(rows) == 99


def test_more_blocks_for_more_prints():
    assert [S._blocks_for(n) for n in (0, 10**5, 10**7, 10**9, 10**11)] == [5, 5, 6, 7, 8]
    for blocks in range(5, 9):
        masks = [m % (1 << 64) for m in S._masks(blocks)]
        draw = np.random.default_rng(blocks)
        for _ in range(200):
            flipped = sum(1 << int(b) for b in draw.choice(64, 4, replace=False))
            assert any(flipped & m == 0 for m in masks)
