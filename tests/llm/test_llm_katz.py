"""Katz backoff against a plain model, and distributions that add up to 1."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_frames import WORD, documents_of, edge_documents, edge_rows, low
from pyspark.sql import functions as F

from flowgauge.llm import katz_backoff as K
from flowgauge.llm.entry import QUERIES
from flowgauge.llm.packing import pack, pack_bytes, unpack, unpack_bytes


def good_turing(counts):
    n = Counter(min(c, 7) for c in counts.values())
    cut = 6 * n[6] / n[1] if n[1] else 1
    factors = [1.0]
    for r in range(1, 6):
        x = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut != 1 else 1.0
        factors.append(x if 0 < x < 1 else 1.0)
    return lambda c: [*factors, 1.0][min(c, 6)]


class Plain:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.one = Counter(w for t in texts for w in t)
        self.two = Counter(p for t in texts for p in zip(["<s>", *t[:-1]], t))
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.d1, self.d2 = good_turing(self.one), good_turing(self.two)
        lost = sum(c * (1 - self.d1(c)) for c in self.one.values())
        self.total = self.n if lost > 0 else self.n + 1
        self.unknown = (lost if lost > 0 else 1) / self.total
        after = defaultdict(list)
        for (u, w), c in self.two.items():
            after[u].append((w, c))
        self.context = {}
        for u, found in after.items():
            n, mass = sum(c for _, c in found), sum(self.d2(c) * c for _, c in found)
            whole = mass >= n * (1 - 1e-12)
            left = 1 / (n + 1) if whole else (n - mass) / n
            self.context[u] = n + whole, left / (1 - sum(self.p1(w) for w, _ in found))

    def p1(self, w):
        return self.d1(self.one[w]) * self.one[w] / self.total if self.one[w] else self.unknown

    def p(self, u, w):
        if u not in self.context:
            return self.p1(w)
        total, alpha = self.context[u]
        c = self.two[u, w]
        return self.d2(c) * c / total if c else alpha * self.p1(w)

    def scores(self, text):
        base = sum(math.log10((self.one[w] + 1) / (self.n + self.v + 1)) for w in text)
        return base, sum(math.log10(self.p(u, w)) for u, w in zip(["<s>", *text[:-1]], text))


def tokens(text):
    return [*WORD.findall(low(text)), "</s>"]


def held_out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2


def expected(rows):
    model = Plain([tokens(t) for i, t in rows if not held_out(i)])
    for u in [*list(model.context)[:30], "<s>"]:
        assert abs(sum(model.p(u, w) for w in model.one) + model.p(u, "\0") - 1) < 1e-9
    out = []
    for i, t in rows:
        words = tokens(t)
        known = sum(model.one[w] > 0 for w in words)
        out.append((i if i is not None else -1, held_out(i), len(words), known, model.n, *model.scores(words)))
    return sorted(out)


def close(found, wanted):
    assert len(found) == len(wanted)
    for a, b in zip(found, wanted):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def flat(rows, name):
    return sorted((r[name] if r[name] is not None else -1, *tuple(r)[1:]) for r in rows)


def test_query(spark, sf_dir):
    rows = QUERIES["op2_katz_backoff"].run(spark, sf_dir).collect()
    close(flat(rows, "doc_id"), expected(documents_of(spark, sf_dir)))
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def scored(frame):
    return K.score_documents(frame, K.id_remainder(F.col("doc_id"), 7) != 2)


@pytest.mark.parametrize(("block", "parts"), [(1 << 24, 2), (2000, 2), (1, 40)])
def test_edges_in_blocks_and_parts_of_any_size(spark, monkeypatch, block, parts):
    """Many parts make every other word a hot one, dealt on by its followers."""
    monkeypatch.setattr(K, "BLOCK_BYTES", block)
    monkeypatch.setattr(K, "PARTS_PER_PARTITION", parts)
    rows = [r[:2] for r in edge_rows() if r[1] is None or len(r[1]) < 10_000] * 2
    close(flat(scored(edge_documents(spark, [(*r, "en") for r in rows])).collect(), "id"), expected(rows))


def test_no_rows_and_no_training(spark):
    assert scored(edge_documents(spark, [])).count() == 0
    only = next(i for i in range(100) if held_out(i))
    row = scored(edge_documents(spark, [(only, "a b", "en")])).first()
    assert tuple(row)[1:5] == (True, 3, 0, 0) and row["score"] == 0


def test_blocks_are_not_exchanged(spark, sf_dir):
    plan = QUERIES["op2_katz_backoff"].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1


def test_packing():
    draw = np.random.default_rng(0)
    for n in (0, 1, 1000):
        x = draw.integers(0, 2**64, n, dtype=np.uint64)
        assert np.array_equal(unpack(pack(x), np.uint64), x)
        assert np.array_equal(unpack(pack(np.sort(x), True), np.uint64, True), np.sort(x))
        assert bytes(unpack_bytes(pack_bytes(x.tobytes()))) == x.tobytes()
        assert np.array_equal(K.unpack_followers(K.pack_followers(x >> np.uint64(24))), x >> np.uint64(24))


def test_thousands_of_hot_words_are_found_by_one_search():
    draw = np.random.default_rng(3)
    firsts, followers = draw.integers(0, 20_000, 100_000).astype(np.uint64), draw.integers(0, 2**40, 100_000).astype(np.uint64)
    hot = {int(w): int(n) for w, n in zip(draw.permutation(20_000)[:5000], draw.integers(1, 50, 5000))}
    found = K.pair_parts(firsts, followers, hot, 97)
    wanted = [(int(a) % 97 + (int(b) % hot[int(a)] if int(a) in hot else 0)) % 97 for a, b in zip(firsts, followers)]
    assert found.tolist() == wanted
    assert (K.pair_parts(firsts, followers, {}, 97) == (firsts % np.uint64(97)).astype(int)).all()
