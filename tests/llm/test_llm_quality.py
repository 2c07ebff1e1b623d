"""Base rules, the Kneser-Ney model and the bands; the classifier on held-out labels."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_frames import WORD, edge_documents, edge_rows

from flowgauge.llm import perplexity_bands as Q
from flowgauge.llm import random_indexing as R
from flowgauge.llm.entry import QUERIES


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


class PlainModel:
    """Interpolated modified Kneser-Ney over the bytes of running texts, with dictionaries."""

    def __init__(self, texts):
        self.levels = {Q.ORDER: Counter(g for text in texts for side in grams(text) for g in side)}
        for size in range(Q.ORDER - 1, 0, -1):
            self.levels[size] = Counter(g[1:] for g in self.levels[size + 1])
        self.cuts, self.after = {}, {}
        for size, level in self.levels.items():
            n = Counter(level.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
            usual = [r - (r + 1) * y * n[r + 1] / n[r] if n[1] and n[r] else r / 2 for r in (1, 2, 3)]
            self.cuts[size] = [0, *(min(max(c, 0.05), r - 0.05) for r, c in enumerate(usual, 1))]
            sums = defaultdict(lambda: [0, 0.0])
            for g, c in level.items():
                sums[g[:-1]][0] += c
                sums[g[:-1]][1] += self.cuts[size][min(c, 3)]
            self.after[size] = sums

    def p(self, gram):
        size = len(gram)
        if size == 0:
            return 1 / (len(self.levels[1]) + 1)
        lower = self.p(gram[1:])
        if gram[:-1] not in self.after[size]:
            return lower
        total, cut = self.after[size][gram[:-1]]
        c = self.levels[size][gram]
        return (c - self.cuts[size][min(c, 3)]) / total + cut / total * lower


def grams(text):
    """(inside, across): an n-gram for each byte of the words of a text and of the space after each."""
    words = [w.encode() for w in WORD.findall(text or "")]
    running, inside, across = b"\n" * (Q.ORDER - 2) + b" ", [], []
    for word in words:
        for place, sign in enumerate(word + b" "):
            running += bytes([sign])
            (across if place < Q.ORDER - 2 else inside).append(running[-Q.ORDER :])
    return inside, across


def check(rows, found):
    """Counts, surprise and verdict of (id, text, lang) rows."""
    by_lang = defaultdict(list)
    for _, text, lang in rows:
        by_lang[lang].append(text)
    models = {lang: PlainModel(texts) for lang, texts in by_lang.items()}
    for model in models.values():
        for context in [c for c in list(model.after[Q.ORDER])[:5]]:
            assert sum(model.p(context + bytes([b])) for b in range(256) if model.levels[1][bytes([b])]) + model.p(context + b"\x00") == pytest.approx(1)
    wanted = []
    for i, text, lang in rows:
        both = [-sum(math.log(models[lang].p(g)) for g in side) / len(side) if side else None for side in grams(text)]
        base = counts(text)
        wanted.append([i if i is not None else -1, str(lang), *base, base[0] < 50 or 100 * base[4] > 50 * base[0], *both])
    bands = {}
    for lang in by_lang:
        for m in (8, 9):
            passing = [w[m] for w in wanted if w[1] == str(lang) and not w[7] and w[m] is not None]
            if not passing:
                continue
            middle = np.median(np.round(np.array(passing) / Q.STEP)) * Q.STEP
            width = []
            for side in (-1, 1):
                apart = [side * (x - middle) for x in passing if side * (x - middle) >= 0]
                spread = np.median(np.round(np.array(apart) / Q.STEP)) * Q.STEP if apart else 0
                width.append(max(Q.LEAST_BAND, Q.BAND * 1.4826 * spread))
            bands[str(lang), m] = middle - width[0], middle + width[1]
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "surprise", "border_surprise", "kept")
    got = sorted(([r["id"] if r["id"] is not None else -1, str(r["lang"]), *(r[c] for c in columns)] for r in found), key=str)
    wanted.sort(key=str)
    assert [g[:8] for g in got] == [w[:8] for w in wanted]
    for g, w in zip(got, wanted):
        inside, near_edge = not w[7], False
        for m in (8, 9):
            assert (g[m] is None and w[m] is None) or g[m] == pytest.approx(w[m], rel=1e-9)
            if not w[7] and w[m] is not None:
                low, high = bands[w[1], m]
                inside &= low <= w[m] <= high
                near_edge |= min(abs(w[m] - low), abs(w[m] - high)) < 2 * Q.STEP
        assert g[10] == inside or near_edge


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], Q.judge(docs).collect())
    rows = QUERIES["op5_perplexity_bands"].run(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts(texts[r["doc_id"]]) for r in rows)
    assert len(rows) == len(texts) and not any(r["kept"] for r in rows if r["base_failed"])


@pytest.mark.parametrize("order, model_rows, piece", [(3, 1 << 22, 1), (5, 60_000, 1 << 22), (2, 1 << 22, 1 << 22)])
def test_edges_in_any_pieces_and_passes(spark, monkeypatch, piece, model_rows, order):
    monkeypatch.setattr(Q, "ORDER", order)
    monkeypatch.setattr(Q, "PIECE_BYTES", piece)
    monkeypatch.setattr(Q, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(Q, "HELD_GRAMS", 1000)
    rows = edge_rows() + [(20 + i, " ".join(f"{c}{j % 60}" for j in range(70)), "en") for i, c in enumerate("abcdefg")]
    check(rows, Q.judge(edge_documents(spark, rows), model_rows=model_rows).collect())


def test_no_documents(spark):
    assert Q.judge(edge_documents(spark, [])).count() == 0
    assert [r["kept"] for r in Q.judge(edge_documents(spark, [(1, None, None)])).collect()] == [False]


def test_a_text_far_from_its_language_is_rejected(spark):
    draw = np.random.default_rng(0)
    syllables = ["ba", "ko", "ti", "la", "re", "mu", "so", "ni"]
    normal = [(i, " ".join("".join(draw.choice(syllables, 3)) for _ in range(80)), "en") for i in range(60)]
    strange = (100, " ".join("".join(draw.choice(list("qxzjwv0123456789"), 6)) for _ in range(80)), "en")
    found = {r["id"]: r["kept"] for r in Q.judge(edge_documents(spark, [*normal, strange])).collect()}
    assert not found[100] and sum(found.values()) == 60


def test_words_out_of_order_are_rejected(spark):
    sf_dir, draw = "/root/testdata/sf0.01", np.random.default_rng(8)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    long = [r for r in rows if len((r[1] or "").split()) > 100][:40]
    shuffled = [(10**9 + i, " ".join(draw.permutation(t.split())), lang) for i, t, lang in long]
    found = {r["id"]: r["kept"] for r in Q.judge(edge_documents(spark, rows + shuffled)).collect()}
    kept = [sum(found[i] for i, _, _ in some) for some in (long, shuffled)]
    assert kept[1] < kept[0] / 3, kept


def test_bands_are_as_narrow_as_their_language(spark):
    """Most documents labelled bad that pass the rules go, and few of the good ones."""
    sf_dir = "/root/testdata/sf0.01"
    rows = {r["id"]: r for r in Q.judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    stay = {q: [rows[r["doc_id"]]["kept"] for r in labels if r["quality"] == q and not rows[r["doc_id"]]["base_failed"]] for q in (0, 1)}
    assert np.mean(stay[0]) < 0.3 and np.mean(stay[1]) > 0.95


def test_classifier_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op9_random_indexing"].run(spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    held = [(rows[r["doc_id"]]["score"], r["quality"]) for r in labels if rows[r["doc_id"]]["held_out"]]
    assert sum((s >= 0.7) == q for s, q in held) / len(held) > 0.93
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_sums_of_many_tasks_meet_in_two_levels(spark):
    """Sums of 1,000 map tasks: no task of the first level reads more than its share, and none more than a few of a part."""
    tasks, parts = 1000, 4

    def some(batches):
        for batch in batches:
            for i in batch.column("id").to_pylist():
                rows = [np.full(50, i * (p + 1), np.int64).tobytes() for p in range(parts)]
                yield pa.RecordBatch.from_pydict({"part": pa.array(range(parts), pa.int32()), "sums": pa.array(rows, pa.binary())})

    given = spark.range(0, tasks, 1, tasks).mapInArrow(some, "part int, sums binary")
    found = {r["part"]: np.frombuffer(r["sums"], np.int64) for r in R.summed(given).collect()}
    assert set(found) == set(range(parts))
    assert all((v == (p + 1) * tasks * (tasks - 1) // 2).all() for p, v in found.items())


def test_classifier_edges(spark):
    frame = edge_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in R.classify(frame, none).collect()} == {0.5}
    train = [i for i in range(1, 13) if zlib.crc32(str(i).encode()) % 4 != 2]
    a, b, c = train[:3]
    odd = spark.createDataFrame([(a, 1, 0), (a, 0, 0), (None, 1, 0), (b, 1, 0), (b, None, 0), (c, 1, 1), (c, 1, 1), (99, 0, 0)], none.schema)
    assert {r["score"] for r in R.classify(frame, odd).collect()} == {1.0}
    both = spark.createDataFrame([(i, i % 2, 0) for i in range(13)], none.schema)
    rows = R.classify(frame, both, most_rows=8).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["id"] in (2, 3)}) == 1
    assert R.classify(edge_documents(spark, []), both).count() == 0


def test_scores_depend_on_the_text_alone(spark):
    rows = [(i, f"good plain words number {i}" if i % 2 else f"bad ### bad ### {i}", "en") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    first = {r["id"]: r["score"] for r in R.classify(edge_documents(spark, rows), labels).collect()}
    held = [i for i in first if zlib.crc32(str(i).encode()) % 4 == 2]
    turned = spark.createDataFrame([(i, 1 - i % 2 if i in held else i % 2, 1) for i in range(60)], labels.schema)
    changed = [(i, t, "xx") for i, t, _ in rows]
    assert {r["id"]: r["score"] for r in R.classify(edge_documents(spark, changed), turned).collect()} == first


def test_tokens():
    words = R.tokens_of(pa.array(["Ab1 c!!\né", None, "", "x"]))
    spans = [bytes(words.data[a:b]).decode() for a, b in zip(words.start, words.end)]
    assert spans == ["Ab", "1", "c", "!", "!", "é", "x"] and words.first.tolist() == [0, 6, 6, 6, 7]


def test_context_vectors_by_hand(spark):
    vectors = R.context_vectors(edge_documents(spark, [(1, "a b a", "en"), (2, "c", "en")]))
    words = R.tokens_of(pa.array(["a b a", "c"]))
    slots, hashes = R._slots(words)
    index = np.zeros((5 - 1, R.DIMENSIONS))
    for place, sign in R._index_vectors(hashes):
        index[np.arange(4), place] += sign
    near = [index[1] + index[2], index[0] + index[2], index[0] + index[1], 0 * index[0]]
    sums, n = defaultdict(lambda: 0), Counter(slots.tolist())
    for s, x in zip(slots.tolist(), near):
        sums[s] = sums[s] + x
    common = sum(sums.values()) / 4
    for s, x in sums.items():
        assert vectors[s] == pytest.approx((x / n[s] - common) * n[s] / (n[s] + R.SHRINK), abs=1e-6)
    assert (vectors[[i for i in range(R.SLOTS) if i not in n]] == 0).all()
