"""Alignment of two tokenizers' outputs over whole texts, by merge-path partitioning.

Token ends of both tokenizers are two sorted lists of byte offsets; merging them
gives the overlaps: each stretch between neighbouring ends lies in one token of
each side. The merge is cut where diagonals of equal total length meet its path,
each found by binary search without merging, so pieces have equal work whatever
the texts' lengths. A piece gives its overlaps alone; an end that both sides share
but that two pieces hold is found when the pieces are stitched. Shared ends close
the groups.

Texts are cut into units before single spaces between two signs that are no space.
Neither tokenizer has a token across such a cut (the byte-level pattern starts a
new pre-token there, and the reader of the piece model checks that no piece has a
space after another sign), so a unit is encoded and aligned once however often
a block of texts has it. A text without such a space is one unit.

How many links hold a pair of ids linked, over all texts: each block gives its
distinct pairs with their counts, dealt by the second id to PARTS parts; the
vocabularies bound a part's table. Sums are taken in two levels, and the answers go
back to the blocks, which are stored as unit numbers.

Null and empty texts, and texts whose tokens do not join to a space and the text,
have no tokens: zeros and an empty string. Repeated rows and ids have a row each.
Ties: all pairs of a second id with its highest count are best. An empty table gives
an empty result. Columns of the input stay; a result column replaces one of its name.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from flowgauge.llm.entry import query, table
from flowgauge.llm.packing import pack, pack_bytes, unpack, unpack_bytes
from flowgauge.llm.words import expand, gather, pieces, text_bytes
from flowgauge.sources.scratch import written

WORK = 1 << 16
BLOCK_BYTES = 1 << 20
ENCODE_BYTES, JOINED_BYTES = 1 << 17, 1 << 12
KNOWN = 300_000
PARTS = 64
SPACE_SIGN = "▁"

_ASCII = np.zeros(256, bool)
_ASCII[0x21:0x7F] = True
_REST = np.zeros(256, bool)
_REST[0x80:0xC0] = True
# First bytes of two-byte signs without a space among them, and of those that no space starts with.
_TWO = np.zeros(256, bool)
_TWO[0xC3:0xE0] = True
_FIRST = _ASCII | _TWO
_FIRST[0xE4:0xF8] = True


def split_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each unit, and the first unit of each text; the space before a unit belongs to none."""
    n = len(data)
    inner = np.zeros(n, bool)
    if n > 2:
        before = _ASCII[data[:-2]]
        before[1:] |= _REST[data[1:-2]] & _TWO[data[:-3]]
        inner[1:-1] = (data[1:-1] == 32) & before & _FIRST[data[2:]]
        edges = np.concatenate([offsets[:-1], offsets[1:] - 1])
        inner[edges[(edges >= 0) & (edges < n)]] = False
    cuts = np.flatnonzero(inner)
    filled = np.flatnonzero(np.diff(offsets) > 0)
    start = np.sort(np.concatenate([offsets[filled], cuts + 1]))
    end = np.sort(np.concatenate([offsets[filled + 1], cuts]))
    return start, end, np.searchsorted(start, offsets)


@dataclass
class Pair:
    """Both tokenizers, with the bytes of each id."""

    a: Tokenizer
    b: sentencepiece.SentencePieceProcessor
    a_bytes: list[bytes]
    b_bytes: list[bytes]


def byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable ones themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[1:-1], 16)]) if is_byte else piece.replace(SPACE_SIGN, " ").encode()


def load_pair(a_file: bytes, b_file: bytes) -> Pair:
    a = Tokenizer.from_buffer(a_file)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
    signs = byte_signs()
    entries = [a.id_to_token(i) or "" for i in range(a.get_vocab_size())]
    a_bytes = [bytes(signs[c] for c in e) if all(c in signs for c in e) else e.encode() for e in entries]
    names = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    if any(SPACE_SIGN in name.lstrip(SPACE_SIGN) for name in names):
        raise ValueError("a piece goes on after a space; texts cannot be cut at spaces")
    return Pair(a, b, a_bytes, [piece_bytes(name, b.is_byte(i)) for i, name in enumerate(names)])


def _stands_alone(unit: bytes) -> bool:
    """Whether units may stand before and after this one in one text."""
    end = _ASCII[unit[-1]] or (len(unit) > 1 and _REST[unit[-1]] and _TWO[unit[-2]])
    return bool(end and _FIRST[unit[0]])


class Side:
    """One tokenizer: encodes units, and holds the ids of those met before."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], tokens: list[bytes]) -> None:
        self.encode, self.tokens = encode, tokens
        self.size = np.array([len(x) for x in tokens], np.int64)
        self.clear()

    def clear(self) -> None:
        self.ids, self.start, self.n = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def of_texts(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each unit of texts that are units joined by spaces; zero for units whose tokens do not join to them."""
        found, counts = [], []
        for units, ids in zip(texts, self.encode([b" ".join(u).decode() for u in texts])):
            if b"".join(map(self.tokens.__getitem__, ids)) == b" " + b" ".join(units):
                ids = np.array(ids, np.uint32)
                stops = np.cumsum([len(u) + 1 for u in units])
                counts.append(np.diff(np.searchsorted(np.cumsum(self.size[ids]), stops) + 1, prepend=0))
                found.append(ids)
            elif len(units) == 1:
                counts.append(np.zeros(1, np.int64))
            else:
                ids, each = self.of_texts([[u] for u in units])
                found.append(ids)
                counts.append(each)
        return np.concatenate([np.empty(0, np.uint32), *found]), np.concatenate([np.empty(0, np.int64), *counts])

    def learn(self, texts: list[list[bytes]]) -> None:
        ids, n = self.of_texts(texts)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(n) - n])
        self.n, self.ids = np.concatenate([self.n, n]), np.concatenate([self.ids, ids])


class Encoder:
    """Ids of units by both tokenizers; those met before, up to KNOWN, are looked up.

    New units are encoded together, joined by spaces, as far as texts may be cut
    between them; the ends of their tokens tell them apart again.
    """

    def __init__(self, pair: Pair) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.known: dict[bytes, int] = {}
        self.a = Side(lambda texts: [e.ids for e in pair.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], pair.a_bytes)
        self.b = Side(lambda texts: pair.b.encode(texts, num_threads=1), pair.b_bytes)

    def _learn(self, units: list[bytes]) -> None:
        together, alone, size = [[]], [], 0
        for unit in units:
            if not _stands_alone(unit):
                alone.append([unit])
                continue
            together[-1].append(unit)
            size += len(unit)
            if size >= JOINED_BYTES:
                together.append([])
                size = 0
        texts = [t for t in together if t] + alone
        self.a.learn(texts)
        self.b.learn(texts)
        for text in texts:
            for unit in text:
                self.known[unit] = len(self.known)

    def encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and numbers of ids of the units, of a and of b; none where either side's tokens do not join to the unit."""
        if len(self.known) > KNOWN:
            self.known.clear()
            self.a.clear()
            self.b.clear()
        new, size = [], 0
        for unit in units:
            if unit in self.known:
                continue
            new.append(unit)
            size += len(unit)
            if size >= ENCODE_BYTES:
                self._learn(new)
                new, size = [], 0
        if new:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        good = (self.a.n[at] > 0) & (self.b.n[at] > 0)
        out = []
        for side in (self.a, self.b):
            n = np.where(good, side.n[at], 0)
            out += [side.ids[expand(side.start[at], n)].astype(np.int64), n]
        return tuple(out)


def diagonal_cuts(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of both, a first on ties, passes each diagonal: by binary search on all diagonals at once."""
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (low < high).any():
        mid = (low + high) // 2
        open_ = low < high
        right = np.zeros(len(mid), bool)
        right[open_] = a[mid[open_]] <= b[diagonals[open_] - mid[open_] - 1]
        low, high = np.where(open_ & right, mid + 1, low), np.where(open_ & ~right, mid, high)
    return low, diagonals - low


def overlaps(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Indices (of a, of b) of all overlapping tokens, and which ends of a and of b are shared.

    Both lists of ends are strictly ascending and end at the same offset.
    """
    cut_a, cut_b = diagonal_cuts(a, b, work)
    links_a, links_b = [], []
    shared_a, shared_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    for i, i_end, j, j_end in zip(cut_a[:-1], cut_a[1:], cut_b[:-1], cut_b[1:]):
        own_a, own_b = a[i:i_end], b[j:j_end]
        over_b = j + np.searchsorted(own_b, own_a)  # past the piece: the next one's first
        over_a = i + np.searchsorted(own_a, own_b)
        inside = over_a < i_end
        shared_b[j:j_end][inside] = a[over_a[inside]] == own_b[inside]
        if i and len(own_b):  # stitch: the end before this piece may be that of its first b
            shared_b[j] |= a[i - 1] == b[j]
        alone = ~shared_b[j:j_end]
        links_a += [np.arange(i, i_end), over_a[alone]]
        links_b += [over_b, np.arange(j, j_end)[alone]]
    link_a = np.concatenate(links_a) if links_a else np.empty(0, np.int64)
    link_b = np.concatenate(links_b) if links_b else np.empty(0, np.int64)
    shared_a[np.searchsorted(a, b[shared_b])] = True
    return link_a, link_b, shared_a, shared_b


class Numbers:
    """Decimal numbers, each with one byte after it."""

    def __init__(self, size: int) -> None:
        shown = [b"%d," % i for i in range(size)]
        self.size = np.array([len(x) for x in shown], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(shown), np.uint8)

    def write(self, ids: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[ids]
        out = gather(self.data, self.start[ids], size)
        out[np.cumsum(size) - 1] = after
        return out, size


@dataclass
class Units:
    """The distinct units of a block: counts, links and the group text of each."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    link_keys: np.ndarray
    text: np.ndarray
    text_start: np.ndarray
    text_size: np.ndarray


def align_units(encoder: Encoder, numbers: Numbers, units: list[bytes]) -> Units:
    """Aligns the token ends of all the units, one after the other, in one merge."""
    n = len(units)
    ids_a, n_a, ids_b, n_b = encoder.encode(units)
    ends_a, ends_b = np.cumsum(encoder.a.size[ids_a]), np.cumsum(encoder.b.size[ids_b])
    link_a, link_b, shared_a, shared_b = overlaps(ends_a, ends_b)
    of_a, of_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    owner = of_a[link_a]
    order = np.argsort(owner, kind="stable")
    keys = (ids_b[link_b] * len(encoder.a.size) + ids_a[link_a])[order]

    group_a, group_b = np.cumsum(shared_a) - shared_a, np.cumsum(shared_b) - shared_b
    at_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a)
    at_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
    ids, after, of = (np.empty(len(ids_a) + len(ids_b), kind) for kind in (np.int64, np.uint8, np.int64))
    for at, some, last, mark, whose in ((at_a, ids_a, shared_a, "|", of_a), (at_b, ids_b, shared_b, ";", of_b)):
        ids[at], after[at], of[at] = some, np.where(last, ord(mark), ord(",")), whose
    text, sizes = numbers.write(ids, after)
    text_size = np.bincount(of, sizes, n).astype(np.int64)
    return Units(
        n_a > 0, n_a, n_b, np.bincount(of_a, shared_a, n).astype(np.int64), np.bincount(owner, minlength=n),
        keys, text, np.cumsum(text_size) - text_size, text_size,
    )


@dataclass
class Block:
    """Some texts: facts and group text of each, their units, and the units' links."""

    facts: dict[str, np.ndarray]
    texts: list[bytes]
    unit: np.ndarray
    n_units: np.ndarray
    units: Units


def _distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    column = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(gather(data, start, size))])
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def align_block(encoder: Encoder, numbers: Numbers, column: pa.Array) -> Block:
    data, offsets = text_bytes(column)
    start, end, first = split_units(data, offsets)
    unit, distinct = _distinct(data, start, end)
    units = align_units(encoder, numbers, distinct)
    bad = _sums(~units.good[unit], first) > 0
    keep = np.repeat(~bad, np.diff(first))
    unit, n_units = unit[keep], np.where(bad, 0, np.diff(first))
    first = np.concatenate([[0], np.cumsum(n_units)])
    facts = {n: _sums(getattr(units, n)[unit], first) for n in ("n_a", "n_b", "n_groups", "n_links")}
    whole = gather(units.text, units.text_start[unit], units.text_size[unit]).tobytes()
    stop = _sums(units.text_size[unit], first).cumsum()
    texts = [whole[a : b - 1] if b > a else b"" for a, b in zip(np.concatenate([[0], stop[:-1]]).tolist(), stop.tolist())]
    return Block(facts, texts, unit, n_units, units)


_STORED = [("block", pa.int64()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("body", pa.binary())]
_STORED_DDL = "block bigint, part int, keys binary, counts binary, body binary"
FACTS = ("n_a", "n_b", "n_groups", "n_links")
_DONE = [*[(n, pa.int64()) for n in FACTS], ("groups_sha256", pa.string())]
_DONE_DDL = ", ".join(f"{n} bigint" for n in FACTS) + ", groups_sha256 string"


def _ready(files) -> tuple[Encoder, Numbers]:
    pair = load_pair(*files.value)
    return Encoder(pair), Numbers(max(len(pair.a_bytes), len(pair.b_bytes)))


def _digest(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest() if text else ""


def _body(block: Block, place: np.ndarray) -> bytes:
    """The block as it waits for the counts: units of each text, links of each unit as places among the block's keys."""
    arrays = [(block.n_units, "<u4"), (block.unit, "<u4"), (block.units.n_links, "<u4"), (place, "<u4")]
    packed = [pack(np.asarray(values).astype(kind)) for values, kind in arrays]
    return b"".join(len(p).to_bytes(8, "little") + p for p in packed)


def _unpacked(body: bytes) -> list[np.ndarray]:
    found, at = [], 0
    while at < len(body):
        size = int.from_bytes(body[at : at + 8], "little")
        found.append(unpack(body[at + 8 : at + 8 + size], "<u4").astype(np.int64))
        at += 8 + size
    return found


def _aligning(files, row_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each block of texts one row with its texts' facts and units, and one for each part of its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, numbers = _ready(files)
        doc = pa.struct([("row", row_type), *_DONE])
        schema = pa.schema([*_STORED, ("docs", pa.list_(doc))])
        for number, piece in enumerate(pieces(batches, BLOCK_BYTES)):
            at = (TaskContext.get().partitionId() << 32) + number
            block = align_block(encoder, numbers, piece.column("text"))
            times = np.bincount(block.unit, minlength=len(block.units.n_links))
            distinct, place = np.unique(block.units.link_keys, return_inverse=True)
            counts = np.bincount(place, np.repeat(times, block.units.n_links), len(distinct)).astype(np.int64)
            part = distinct // len(encoder.a.size) % PARTS
            order = np.argsort(part, kind="stable")
            turned = np.empty(len(order), np.int64)
            turned[order] = np.arange(len(order))
            distinct, counts = distinct[order], counts[order]
            borders = np.searchsorted(part[order], np.arange(PARTS + 1))
            rows = [
                (at, p, pack(distinct[a:b], ascending=True), pack(counts[a:b]), None)
                for p, (a, b) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist()))
                if b > a
            ]
            columns = [pa.array([r[k] for r in rows] + [at if k == 0 else _body(block, turned[place]) if k == 4 else None], kind) for k, (_, kind) in enumerate(_STORED)]
            facts = [pa.array(block.facts[n], pa.int64()) for n in FACTS]
            docs = pa.StructArray.from_arrays([piece.column("row"), *facts, pa.array(map(_digest, block.texts), pa.string())], fields=list(doc))
            lists = pa.ListArray.from_arrays(pa.array([0] * (len(rows) + 1) + [len(docs)], pa.int32()), docs)
            yield pa.RecordBatch.from_arrays([*columns, lists.cast(pa.list_(doc))], schema=schema)

    return run


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([c for _, c in found]), len(keys)).astype(np.int64)


def _summing(names: tuple[str, ...], best_of: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums the sorted pairs of each group of rows, a few at a time; with `best_of` the sums are final and the best are marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[(n, pa.int32()) for n in names], ("keys", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())]
        schema, now, held, size = pa.schema(kinds), None, [], 0

        def closed() -> pa.RecordBatch:
            keys, counts = _merged(held)
            best = b""
            if best_of is not None:
                second = keys // best_of
                starts = np.flatnonzero(np.concatenate([[True], second[1:] != second[:-1]]))
                highest = np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.append(starts, len(keys))))
                best = pack_bytes((counts == highest).astype(np.uint8))
            values = [*now, pack(keys, ascending=True), pack(counts), best]
            return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, (_, kind) in zip(values, kinds)], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                here = tuple(batch.column(n)[i].as_py() for n in names)
                if here != now:
                    if held:
                        yield closed()
                    now, held, size = here, [], 0
                held.append((unpack(batch.column("keys")[i].as_py(), np.int64, True), unpack(batch.column("counts")[i].as_py(), np.int64)))
                size += len(held[-1][0])
                if size > 4 * len(held[0][0]) + 1_000_000:
                    held = [_merged(held)]
                    size = len(held[0][0])
        if held:
            yield closed()

    return run


def _answering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and marks for each block's pairs; the sums of a part stand before its blocks."""
    keys = counts = best = None
    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("counts", pa.binary()), ("best", pa.binary())])
    for batch in batches:
        out: list[tuple] = []
        for i in range(batch.num_rows):
            block, part = batch.column("block")[i].as_py(), batch.column("part")[i].as_py()
            own = unpack(batch.column("keys")[i].as_py(), np.int64, True)
            if block is None:
                keys, counts = own, unpack(batch.column("counts")[i].as_py(), np.int64)
                best = unpack_bytes(batch.column("best")[i].as_py())
                continue
            at = np.searchsorted(keys, own)
            out.append((block, part, pack(counts[at]), pack_bytes(best[at])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, kind.type) for v, kind in zip(zip(*out), schema)], schema=schema)


def _finishing(row_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Facts of each text with those that the counts give; the answers of a block stand before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("row", row_type), *_DONE, ("n_best", pa.int64()), ("count_sum", pa.int64())]
        schema, counts, best = pa.schema(kinds), [], []
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("body")[i].as_py() is None:
                    counts.append(unpack(batch.column("counts")[i].as_py(), np.int64))
                    best.append(unpack_bytes(batch.column("best")[i].as_py()))
                    continue
                n_units, unit, n_links, place = _unpacked(batch.column("body")[i].as_py())
                docs = batch.column("docs")[i].values
                of_unit = np.concatenate([[0], np.cumsum(n_links)])
                first = np.concatenate([[0], np.cumsum(n_units)])
                sums = []
                for found in (best, counts):
                    each = np.concatenate(found).astype(np.int64)[place] if found else np.empty(0, np.int64)
                    sums.append(_sums(_sums(each, of_unit)[unit], first))
                counts, best = [], []
                columns = [docs.field(k) for k in range(len(_DONE) + 1)] + [pa.array(s, pa.int64()) for s in sums]
                yield pa.RecordBatch.from_arrays([c.cast(k) for c, (_, k) in zip(columns, kinds)], schema=schema)

    return run


def _named(df: DataFrame, text: str, results: tuple[str, ...]) -> tuple[DataFrame, str, pa.DataType]:
    others = [c for c in df.columns if c != text and c not in results]
    named = df.select(F.struct(*others).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = to_arrow_schema(named.select("row").schema).field("row").type
    return named, named.schema["row"].dataType.simpleString(), kind


def _files(df: DataFrame, a_file: str, b_file: str):
    """Both tokenizer files; of fixed size, whatever the table."""
    held = []
    for path in (a_file, b_file):
        with open(path, "rb") as file:
            held.append(file.read())
    return df.sparkSession.sparkContext.broadcast(tuple(held))


RESULTS = (*FACTS, "groups_sha256", "n_best", "count_sum")


def align_tokenizers(df: DataFrame, a_file: str, b_file: str, text: str = "text") -> DataFrame:
    """All columns but the text, with n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum."""
    spark = df.sparkSession
    named, row, row_type = _named(df, text, RESULTS)
    files = _files(df, a_file, b_file)
    n_first = len(load_pair(*files.value).a_bytes)
    docs = f"docs array<struct<row:{row}, {', '.join(f'{n}:bigint' for n in FACTS)}, groups_sha256:string>>"
    stored = written(named.mapInArrow(_aligning(files, row_type), f"{_STORED_DDL}, {docs}"), "aligned")

    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTS)
    salt = F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt")
    asks = stored.where("part is not null").select("block", "part", salt, "keys", "counts")
    sums = "keys binary, counts binary, best binary"
    some = asks.repartition("part", "salt").sortWithinPartitions("part", "salt")
    partial = some.mapInArrow(_summing(("part", "salt"), None), f"part int, salt int, {sums}")
    ordered = partial.repartition("part").sortWithinPartitions("part")
    totals = written(ordered.mapInArrow(_summing(("part",), n_first), f"part int, {sums}"), "pairs")

    spread = totals.select(F.lit(None).cast("bigint").alias("block"), "part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "keys", "counts", "best")
    both = spread.unionByName(asks.select("block", "part", "salt", "keys", F.lit(None).cast("binary").alias("counts"), F.lit(None).cast("binary").alias("best")))
    dealt = both.repartition("part", "salt").sortWithinPartitions("part", "salt", "block")
    answers = dealt.mapInArrow(_answering, "block bigint, part int, counts binary, best binary")

    blocks = stored.where("part is null").select("block", F.lit(PARTS).alias("part"), "body", "docs")
    met = blocks.unionByName(answers, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "part")
    found = met.mapInArrow(_finishing(row_type), f"row {row}, {_DONE_DDL}, n_best bigint, count_sum bigint")
    return found.select("row.*", *RESULTS)


def token_groups(df: DataFrame, a_file: str, b_file: str, text: str = "text") -> DataFrame:
    """All columns but the text, with n_a, n_b, n_groups, n_links and `groups`: the ids of both sides, group by group."""
    results = (*FACTS, "groups")
    named, row, row_type = _named(df, text, results)
    files = _files(df, a_file, b_file)
    kinds = [("row", row_type), *[(n, pa.int64()) for n in FACTS], ("groups", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, numbers = _ready(files)
        for piece in pieces(batches, BLOCK_BYTES):
            block = align_block(encoder, numbers, piece.column("text"))
            columns = [piece.column("row"), *[pa.array(block.facts[n], pa.int64()) for n in FACTS], pa.array([t.decode() for t in block.texts], pa.string())]
            yield pa.RecordBatch.from_arrays([c.cast(k) for c, (_, k) in zip(columns, kinds)], schema=pa.schema(kinds))

    ddl = f"row {row}, {', '.join(f'{n} bigint' for n in FACTS)}, groups string"
    return named.mapInArrow(run, ddl).select("row.*", *results)


@query("op12_merge_path")
def op12(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return align_tokenizers(documents, *files).select("doc_id", *RESULTS)
