"""Byte-level BPE by a rank queue with a hierarchical bitmap.

Symbols are nodes of a linked list over bytes. A bucket for each merge rank
holds the positions whose pair has that rank; a bitmap over ranks, with a second
bitmap over its words, gives the lowest filled bucket by find-first-set. The
leftmost position of that bucket is merged and its two new pairs are queued; an
entry whose pair has changed meanwhile is stale and skipped when it comes up. So
a pre-token of any length takes a few steps for each merge, where a scan for the
best pair after each merge would take time by the square of its length.

The pre-tokens of a slice of texts share one list, with a barrier after each.
Those met before in the task, up to KNOWN of them, are looked up.

Null and empty texts have no ids and decode to no bytes. Repeated rows are rows
of their own, a text of any length is encoded whole, and an empty table gives an
empty result. A result column replaces an input column of the same name. Letters
and digits are those of the installed regex library's Unicode tables.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.entry import query, table

WORD_BITS = 256
SLICE_CHARS = 1 << 20
KNOWN = 500_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks, from a rank file."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError(f"ranks of {path} have gaps")
    return [tokens[r] for r in range(len(tokens))]


class RankBits:
    """A set of ranks that finds its least member by two find-first-set steps."""

    def __init__(self, size: int) -> None:
        self.words = [0] * (size // WORD_BITS + 1)
        self.top = 0

    def add(self, rank: int) -> None:
        word, bit = divmod(rank, WORD_BITS)
        self.words[word] |= 1 << bit
        self.top |= 1 << word

    def remove(self, rank: int) -> None:
        word, bit = divmod(rank, WORD_BITS)
        self.words[word] &= ~(1 << bit)
        if not self.words[word]:
            self.top &= ~(1 << word)

    def first(self) -> int:
        word = (self.top & -self.top).bit_length() - 1
        bits = self.words[word]
        return word * WORD_BITS + (bits & -bits).bit_length() - 1


class Encoder:
    """Encodes pre-tokens by the ranks of a vocabulary."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.ranks = {t: r for r, t in enumerate(tokens)}
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [self.ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self.of_pair = np.array(pairs, np.int64)
        self.merged: dict[int, int] = {}

    def rank(self, left: int, right: int) -> int:
        """Rank of the token that two neighbours make, or -1."""
        key = left << 32 | right
        found = self.merged.get(key)
        if found is None:
            found = self.merged[key] = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
        return found

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian 32-bit numbers; pieces are not empty."""
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        stop = np.cumsum(length)
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        last = np.zeros(len(data), bool)
        last[stop - 1] = True
        pair = np.full(len(data), -1)
        pair[:-1] = self.of_pair[data[:-1] * 256 + data[1:]]
        pair[last] = -1
        ids = np.array(self._merge(self.of_byte[data].tolist(), pair, last), np.int64)
        alive = ids >= 0
        ids = ids[alive].astype("<u4")
        to = np.cumsum(alive)[stop - 1] * 4
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *to[:-1].tolist()], to.tolist())]

    def _merge(self, symbol: list[int], pair: np.ndarray, last: np.ndarray) -> list[int]:
        """Merge all pairs in the order of their ranks; a symbol that was swallowed is -1."""
        n = len(symbol)
        at = np.arange(n)
        after = np.where(last, -1, at + 1).tolist()
        before = np.where(np.concatenate([[True], last[:-1]]), -1, at - 1).tolist()
        queued = np.flatnonzero(pair >= 0)
        queued = queued[np.argsort(pair[queued], kind="stable")]
        ranks, first = np.unique(pair[queued], return_index=True)
        buckets = {r: b.tolist() for r, b in zip(ranks.tolist(), np.split(queued, first[1:]))}
        bits = RankBits(len(self.tokens))
        for r in buckets:
            bits.add(r)
        merged, look_up = self.merged, self.rank
        while bits.top:
            rank = bits.first()
            bucket = buckets[rank]
            lower = False
            while bucket and not lower:
                i = heappop(bucket)
                j = after[i]
                if j < 0 or symbol[i] < 0:
                    continue
                found = merged.get(symbol[i] << 32 | symbol[j])
                if (look_up(symbol[i], symbol[j]) if found is None else found) != rank:
                    continue
                symbol[i], symbol[j] = rank, -1
                after[i] = k = after[j]
                h = before[i]
                if k >= 0:
                    before[k] = i
                    r = merged.get(rank << 32 | symbol[k])
                    r = look_up(rank, symbol[k]) if r is None else r
                    if r >= 0:
                        lower |= r < rank
                        if r in buckets:
                            heappush(buckets[r], i)
                        else:
                            buckets[r] = [i]
                            bits.add(r)
                if h >= 0:
                    r = merged.get(symbol[h] << 32 | rank)
                    r = look_up(symbol[h], rank) if r is None else r
                    if r >= 0:
                        lower |= r < rank
                        if r in buckets:
                            heappush(buckets[r], h)
                        else:
                            buckets[r] = [h]
                            bits.add(r)
            if not bucket:
                del buckets[rank]
                bits.remove(rank)
        return symbol


class Texts:
    """Encodes texts, remembering pre-tokens."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        self.encoder = Encoder(tokens)
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def learn(self, pre_tokens: Iterable[str]) -> None:
        if len(self.known) > KNOWN:
            self.known.clear()
        new = list(set(pre_tokens).difference(self.known))
        if not new:
            return
        raw = [t.encode() for t in new]
        whole = [self.encoder.ranks.get(t) for t in raw]
        split = [i for i, r in enumerate(whole) if r is None]
        for t, r in zip(new, whole):
            if r is not None:
                self.known[t] = r.to_bytes(4, "little")
        if split:
            for i, ids in zip(split, self.encoder.encode_all([raw[i] for i in split])):
                self.known[new[i]] = ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of some short texts."""
        found = [self.pattern.findall(t) for t in texts]
        self.learn(t for pre_tokens in found for t in pre_tokens)
        return [b"".join(map(self.known.__getitem__, pre_tokens)) for pre_tokens in found]

    def encode_long(self, text: str) -> bytes:
        """Ids of one text, with few of its pre-tokens in memory at a time."""
        found = (m.group() for m in self.pattern.finditer(text))
        out = []
        while some := list(islice(found, SLICE_CHARS // 8)):
            self.learn(some)
            out.append(b"".join(map(self.known.__getitem__, some)))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.encoder.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _coder(tokens, pattern: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Texts(tokens.value, pattern)
        for batch in batches:
            texts = batch.column("text")
            size = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                to = int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_CHARS, "right"))
                some = texts.slice(at, max(1, to - at)).to_pylist()
                ids = coder.encode(some) if to > at else [coder.encode_long(some[0])]
                decoded = [coder.decode(x) for x in ids]
                row = batch.column("row").slice(at, len(some))
                yield pa.RecordBatch.from_arrays([row, pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], ["row", "ids", "decoded"])
                at += len(some)

    return run


def encode_and_decode(df: DataFrame, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """All columns but the text, with ids (little-endian 32-bit numbers) and decoded (the bytes they stand for)."""
    others = [c for c in df.columns if c not in (text, "ids", "decoded")]
    named = df.select(F.struct(*others).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tokens = df.sparkSession.sparkContext.broadcast(read_ranks(rank_file))
    schema = f"row {named.schema['row'].dataType.simpleString()}, ids binary, decoded binary"
    return named.mapInArrow(_coder(tokens, pattern), schema).select("row.*", "ids", "decoded")


@query("op6_rank_queue_bpe")
def op6(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_and_decode(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
