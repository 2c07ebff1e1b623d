"""Rank-queue encoding against the reference library, and exact round trips."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_frames import documents_of, edge_documents, edge_rows

from flowgauge.llm import rank_queue_bpe as B
from flowgauge.llm.entry import QUERIES

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    with open(RANK_FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return B.Texts(B.read_ranks(RANK_FILE), public_tokenizers.PATTERN)


def expected(encoding, text):
    return np.array(encoding.encode_ordinary(text or ""), "<u4").tobytes()


def test_query(spark, sf_dir, encoding):
    texts = dict(documents_of(spark, sf_dir))
    rows = QUERIES["op6_rank_queue_bpe"].run(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        ids = expected(encoding, text)
        found = (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
        assert found == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_edges(spark, encoding):
    coded = B.encode_and_decode(edge_documents(spark), RANK_FILE, public_tokenizers.PATTERN)
    rows = coded.collect()
    found = sorted((r["doc_id"] or 0, bytes(r["ids"]), bytes(r["decoded"])) for r in rows)
    assert found == sorted((i or 0, expected(encoding, t), (t or "").encode()) for i, t, _ in edge_rows())
    assert {"at", "id", "row", "part"} <= set(coded.columns) and "text" not in coded.columns
    assert B.encode_and_decode(edge_documents(spark, []), RANK_FILE, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2FF), max_size=80))
def test_any_text(encoding, coder, text):
    ids = coder.encode([text])[0]
    assert ids == expected(encoding, text) and coder.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_001, "ab" * 9_000 + "c", " " * 5_000 + "x", "the" * 7_000, "中" * 3_000, "z1" * 4_000])
def test_long_pre_tokens(encoding, coder, text):
    assert coder.encode([text])[0] == expected(encoding, text) == coder.encode_long(text)


def test_known_pre_tokens_may_be_forgotten(encoding, monkeypatch):
    monkeypatch.setattr(B, "KNOWN", 3)
    coder = B.Texts(B.read_ranks(RANK_FILE), public_tokenizers.PATTERN)
    draw = random.Random(5)
    for _ in range(30):
        text = " ".join("".join(draw.choices("abcdet", k=draw.randint(1, 9))) for _ in range(20))
        assert coder.encode([text, text])[1] == expected(encoding, text)


def test_rank_bits():
    bits, members = B.RankBits(50_000), set()
    draw = random.Random(1)
    for _ in range(3_000):
        rank = draw.randrange(50_000)
        if rank in members:
            members.discard(rank)
            bits.remove(rank)
        else:
            members.add(rank)
            bits.add(rank)
        assert not members and not bits.top or bits.first() == min(members)


def test_gaps_in_ranks_are_an_error(tmp_path):
    file = tmp_path / "ranks"
    file.write_text(f"{base64.b64encode(b'a').decode()} 0\n{base64.b64encode(b'b').decode()} 2\n")
    with pytest.raises(ValueError, match="gaps"):
        B.read_ranks(str(file))
