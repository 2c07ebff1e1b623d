"""Alignment of two tokenizers against whole-text encoding and a pair of loops."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_frames import documents_of, edge_documents, edge_rows

from flowgauge.llm import merge_path as M
from flowgauge.llm.entry import QUERIES

FILES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def pair():
    with open(FILES[0], "rb") as a, open(FILES[1], "rb") as b:
        return M.load_pair(a.read(), b.read())


def tokens(pair, text):
    """Ids and byte ranges of both sides from the whole text, or none."""
    a = pair.a.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    whole = (" " + text).encode()
    parts = [[pair.a_bytes[i] for i in a], [pair.b_bytes[i] for i in b]]
    if not text or any(b"".join(p) != whole for p in parts):
        return None
    return [list(zip(ids, np.cumsum([0, *map(len, p[:-1])]), np.cumsum(list(map(len, p))))) for ids, p in zip((a, b), parts)]


def links(a, b):
    found, j = [], 0
    for i, (_, start, end) in enumerate(a):
        while b[j][2] <= start:
            j += 1
        k = j
        while k < len(b) and b[k][1] < end:
            found.append((i, k))
            k += 1
    return found


def groups(a, b):
    shared = {t[2] for t in a} & {t[2] for t in b}
    out = [[[], []]]
    for end, side, i in sorted([(t[2], 0, i) for i, t in enumerate(a)] + [(t[2], 1, i) for i, t in enumerate(b)]):
        if out[-1][0] and out[-1][1] and last in shared and end > last:  # noqa: F821
            out.append([[], []])
        out[-1][side].append((a, b)[side][i][0])
        last = end
    return out


def plain(pair, texts):
    coded = [tokens(pair, t or "") for t in texts]
    linked = [[] if c is None else [(c[0][i][0], c[1][j][0]) for i, j in links(*c)] for c in coded]
    counts = Counter(p for doc in linked for p in doc)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    rows = []
    for c, doc in zip(coded, linked):
        if c is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        made = groups(*c)
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in made)
        best = sum(counts[p] == highest[p[1]] for p in doc)
        rows.append((len(c[0]), len(c[1]), len(made), len(doc), best, sum(counts[p] for p in doc), hashlib.sha256(shown.encode()).hexdigest()))
    return rows


def test_query(spark, sf_dir, pair):
    given_rows = sorted(documents_of(spark, sf_dir))
    found = sorted((r["doc_id"], *[r[c] for c in COLUMNS]) for r in QUERIES["op12_merge_path"].run(spark, sf_dir).collect())
    assert found == [(i, *row) for (i, _), row in zip(given_rows, plain(pair, [t for _, t in given_rows]))]


NASTY = ["a▁b c", "<|endoftext|> x <s> </s> <unk> <0x41>", "a  b   c ", " lead", "nul\x00in it", "  nbsp  x", "　 中 文 x", "tab\t x", "́ a ́b", "\U0001f600 \U0001f600", "x   y z"]


def test_edges(spark, pair):
    rows = edge_rows() + [(100 + i, t, None) for i, t in enumerate(NASTY)]
    wanted = Counter((i, *row) for (i, _, _), row in zip(rows, plain(pair, [t for _, t, _ in rows])))
    frame = M.align_tokenizers(edge_documents(spark, rows).repartition(3), *FILES)
    assert Counter((r["doc_id"], *[r[c] for c in COLUMNS]) for r in frame.collect()) == wanted
    assert {"at", "id", "row", "part", "key"} <= set(frame.columns) and "text" not in frame.columns
    assert M.align_tokenizers(edge_documents(spark, []), *FILES).count() == 0
    shown = {r["doc_id"]: r["groups"] for r in M.token_groups(edge_documents(spark, rows), *FILES).collect()}
    assert {i: hashlib.sha256(g.encode()).hexdigest() if g else "" for i, g in shown.items()} == {r[0]: r[-1] for r in wanted}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \t\n'sabAé0. ▁ 　中\U0001f600́\x1c\x85"), max_size=30))
def test_units_change_no_token(pair, text):
    encoder = M.Encoder(pair)
    data, offsets = M.text_bytes(M.pa.array([text]))
    start, end, _ = M.split_units(data, offsets)
    units = [data[a:b].tobytes() for a, b in zip(start, end)]
    coded = encoder.encode(units)
    whole = tokens(pair, text)
    if whole is None:
        assert not text or (coded[1] == 0).any()
    else:
        for side in (0, 1):
            assert coded[2 * side].tolist() == [t[0] for t in whole[side]] and coded[2 * side + 1].sum() == len(whole[side])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=60), st.lists(st.integers(1, 3), min_size=1, max_size=60), st.integers(1, 9))
def test_pieces_of_any_work_give_all_overlaps(a, b, work):
    a, b = np.cumsum(a), np.cumsum(b)
    end = max(a[-1], b[-1])
    a, b = (x if x[-1] == end else np.append(x, end) for x in (a, b))
    link_a, link_b, shared_a, shared_b = M.overlaps(a, b, work)
    ranges = [[(0, s, e) for s, e in zip([0, *x[:-1]], x)] for x in (a, b)]
    assert sorted(zip(link_a.tolist(), link_b.tolist())) == sorted(links(*ranges))
    assert set(a[shared_a]) == set(b[shared_b]) == set(a) & set(b)
    cuts = sum(M.diagonal_cuts(a, b, work))
    assert (np.diff(cuts) <= work).all() and cuts[-1] == len(a) + len(b)
