"""Substring dedup by super-k-mers: every later copy of a window of words goes.

The k-mers are windows of `width` words of one text. The minimiser of a window
is the least hash of its runs of MINIMISER words, so neighbouring windows mostly
share it; the words of such neighbours travel as one packed string to the bucket
of their minimiser. There the windows are sorted by hash and compared word by
word, so equal windows are counted exactly, and all but the first are given back
as ranges of their texts.

A task packs blocks of whole texts and first drops the windows that it has seen
in the same block: a passage that millions of texts share reaches its bucket
once from each block, not once from each text. Buckets are many times the shuffle
partitions, and hold nothing but distinct windows of each block.

Windows are judged on the input in the order (id, position in the read, start);
rows without an id come last. A null or empty text has no words, a text with
fewer words than a window keeps them all. Repeated rows are texts of their own,
so all but the first lose what a window covers. An empty table gives an empty
result. The input must be a stable read (a file scan or a written table), as the
position of a row is taken twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.entry import query, table
from flowgauge.llm.words import Words, expand, joined_words, pieces, split_words, text_bytes, window_hashes, word_numbers

WIDTH = 20
MINIMISER = 3
BLOCK_BYTES = 12 << 20
BUCKETS_PER_PARTITION = 4
COMPARED = 1 << 18
KEEP_BYTES = 1 << 20

PACKED = "bucket int, at binary, id binary, start binary, words binary, later binary"
RANGES = "at long, start int, stop int"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of `width` neighbours, in log2(width) passes."""
    out, span = values, 1
    while span < width:
        step = min(span, width - span)
        out = np.minimum(out[:-step], out[step:])
        span += step
    return out


def later_windows(numbers: np.ndarray, hashes: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """For windows in their order: whether one with the same words came before.

    Equal hashes only propose pairs; the numbers of all words decide.
    """
    later = np.zeros(len(starts), bool)
    _, first, group = np.unique(hashes, return_index=True, return_inverse=True)
    again = np.flatnonzero(first[group] != np.arange(len(starts)))
    wrong = []
    for at in range(0, len(again), COMPARED):
        some = again[at : at + COMPARED]
        mine, other = starts[some], starts[first[group[some]]]
        same = np.ones(len(some), bool)
        for i in range(width):
            same &= numbers[mine + i] == numbers[other + i]
        later[some[same]] = True
        wrong += some[~same].tolist()
    seen: dict[bytes, int] = {}
    for at in wrong:  # windows that only share a hash with their group's first
        content = numbers[starts[at] : starts[at] + width].tobytes()
        later[at] = content in seen
        seen[content] = at
    return later


def _runs(at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Borders of runs of neighbouring starts with the same label."""
    head = np.ones(len(starts), bool)
    head[1:] = (starts[1:] != starts[:-1] + 1) | (at[1:] != at[:-1])
    first = np.flatnonzero(head)
    return first, np.append(first, len(starts))[1:] - 1


def _windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner and first word of each window that lies within one text."""
    count = np.maximum(np.diff(words.first) - width + 1, 0)
    return np.repeat(np.arange(len(count)), count), expand(words.first[:-1], count)


def _pack(rows: pa.Table, buckets: int, width: int) -> Iterator[dict]:
    """The super-k-mers of a block by bucket, and ranges of windows that came before in the block."""
    at, ids = rows.column("at").to_numpy(), rows.column("id")
    known = ids.is_valid().to_numpy()
    ids = ids.fill_null(0).to_numpy()
    order = np.lexsort((at, ids, ~known))
    at, ids, known = at[order], ids[order], known[order]
    words = split_words(*text_bytes(rows.column("text").combine_chunks().take(pa.array(order))))
    owner, starts = _windows(words, width)
    if not len(starts):
        return
    numbers, dictionary = word_numbers(words)
    hashes = dictionary[numbers]
    minimiser = sliding_least(window_hashes(hashes, MINIMISER), width - MINIMISER + 1)[starts]
    later = later_windows(numbers, window_hashes(hashes, width)[starts], starts, width)

    a, b = _runs(owner[later], starts[later])
    which = owner[later][a]
    base = words.first[which]
    ranges = [at[which], starts[later][a] - base, starts[later][b] - base + width]
    yield {"bucket": int(at[0] % buckets), "later": np.stack(ranges).astype(np.int64).tobytes()}

    owner, starts, minimiser = owner[~later], starts[~later], minimiser[~later]
    head = np.ones(len(starts), bool)
    head[1:] = (starts[1:] != starts[:-1] + 1) | (minimiser[1:] != minimiser[:-1])
    a = np.flatnonzero(head)
    b = np.append(a, len(starts))[1:] - 1
    bucket = (minimiser[a] % np.uint64(buckets)).astype(np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    a, b, bucket = a[by_bucket], b[by_bucket], bucket[by_bucket]
    joined, begin, end = joined_words(words)
    raw, which = joined.tobytes(), owner[a]
    begin, end = begin[starts[a]].tolist(), end[starts[b] + width - 1].tolist()
    borders = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    codec = pa.Codec("zstd", compression_level=1)
    for lo, hi in zip(borders[:-1], borders[1:]):
        text = b"\n".join([raw[begin[i] : end[i]] for i in range(lo, hi)])
        mine = which[lo:hi]
        yield {
            "bucket": int(bucket[lo]),
            "at": at[mine].tobytes(),
            "id": np.where(known[mine], ids[mine], np.iinfo(np.int64).max).tobytes(),
            "start": (starts[a[lo:hi]] - words.first[mine]).astype(np.int32).tobytes(),
            "words": len(text).to_bytes(8, "little") + codec.compress(text, asbytes=True),
        }


def _packer(buckets: int, width: int):
    names = [c.split()[0] for c in PACKED.split(", ")]
    schema = pa.schema([(n, pa.int32() if n == "bucket" else pa.binary()) for n in names])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            for row in _pack(pa.Table.from_batches(kept), buckets, width):
                yield pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            begin = 0
            while begin < batch.num_rows:
                room = BLOCK_BYTES - size
                stop = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + room, "right")) - 1)
                stop = min(stop, batch.num_rows)
                kept.append(batch.slice(begin, stop - begin))
                size += int(offsets[stop] - offsets[begin])
                begin = stop
                if size >= BLOCK_BYTES or begin < batch.num_rows:
                    yield from out()
                    kept, size = [], 0
        if kept:
            yield from out()

    return pack


def _bucket_ranges(width: int):
    """Ranges of all windows of a bucket that are not the first with their words."""

    def find(rows: pa.Table) -> pa.Table:
        out = []
        for later in rows.column("later").drop_null().to_pylist():
            out.append(np.frombuffer(later, np.int64).reshape(3, -1))
        packed = rows.filter(rows.column("words").is_valid())
        if packed.num_rows:
            def column(name: str, kind: type) -> np.ndarray:
                return np.frombuffer(b"".join(packed.column(name).to_pylist()), kind)

            at, ids, start = column("at", np.int64), column("id", np.int64), column("start", np.int32).astype(np.int64)
            codec = pa.Codec("zstd")
            texts = [codec.decompress(t[8:], int.from_bytes(t[:8], "little"), asbytes=True) for t in packed.column("words").to_pylist()]
            data = np.frombuffer(b"\n".join(texts), np.uint8)
            ends = np.append(np.flatnonzero(data == 10), len(data))
            words = split_words(data, np.concatenate([[0], ends[:-1] + 1, [len(data)]]))
            numbers, dictionary = word_numbers(words)
            order = np.lexsort((start, at, ids))
            count = np.diff(words.first)[order] - width + 1
            starts, owner = expand(words.first[order], count), np.repeat(order, count)
            later = later_windows(numbers, window_hashes(dictionary[numbers], width)[starts], starts, width)
            owner, starts = owner[later], starts[later]
            a, b = _runs(owner, starts)
            base = start[owner[a]] - words.first[owner[a]]
            out.append(np.stack([at[owner[a]], starts[a] + base, starts[b] + base + width]))
        at, start, stop = np.concatenate(out, axis=1) if out else np.empty((3, 0), np.int64)
        return pa.table({"at": at, "start": start.astype(np.int32), "stop": stop.astype(np.int32)})

    return find


def _keep(batches: Iterator[pa.RecordBatch], as_written: bool) -> Iterator[pa.RecordBatch]:
    """Texts without the words in their ranges, the others joined by one space."""
    for batch in pieces(batches, KEEP_BYTES):
        words = split_words(*text_bytes(batch.column("text")))
        ranges = batch.column("ranges")
        owner = np.repeat(np.arange(batch.num_rows), np.diff(ranges.offsets.to_numpy()))
        flat = ranges.flatten()
        owner = owner[: len(flat)]
        depth = np.zeros(len(words.start) + 1, np.int64)
        base = words.first[owner]
        np.add.at(depth, base + flat.field("start").to_numpy(), 1)
        np.add.at(depth, base + flat.field("stop").to_numpy(), -1)
        kept = np.cumsum(depth[:-1]) == 0
        counts = np.concatenate([[0], np.cumsum(kept)])[words.first]
        some = Words(words.data, words.start[kept], words.end[kept], counts)
        joined, begin, end = joined_words(some)
        raw = joined.tobytes()
        texts = [raw[begin[a] : end[b - 1]] if b > a else b"" for a, b in zip(counts[:-1].tolist(), counts[1:].tolist())]
        n_words = np.diff(words.first)
        kept_texts = pa.array(texts, pa.binary()).cast(pa.string())
        if as_written:
            whole = n_words == np.diff(counts)
            kept_texts = pc.if_else(pa.array(whole), batch.column("text").cast(pa.string()), kept_texts)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("at"),
                batch.column("id"),
                kept_texts,
                pa.array(n_words.astype(np.int64)),
                pa.array((n_words - np.diff(counts)).astype(np.int64)),
            ],
            ["row", "at", "id", "kept", "n_words", "n_removed"],
        )


def drop_repeats(
    df: DataFrame, width: int = WIDTH, text: str = "text", row_id: str = "doc_id", as_written: bool = False
) -> DataFrame:
    """Per row: row (its other columns), at (its position in the read), id, kept (the text without repeats), n_words, n_removed.

    Kept words are joined by one space; as_written leaves a text that keeps all of them as it was.
    """
    named = df.select(
        F.struct(*[c for c in df.columns if c != text]).alias("row"),
        F.monotonically_increasing_id().alias("at"),
        F.col(row_id).cast("long").alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    buckets = BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = named.select("at", "id", "text").mapInArrow(_packer(buckets, width), PACKED)
    ranges = packed.groupBy("bucket").applyInArrow(_bucket_ranges(width), RANGES)
    per_text = ranges.groupBy("at").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    none = F.array().cast("array<struct<start:int,stop:int>>")
    covered = named.join(per_text, "at", "left").select("row", "at", "id", "text", F.coalesce("ranges", none).alias("ranges"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _keep(batches, as_written)

    row = named.schema["row"].dataType.simpleString()
    return covered.mapInArrow(keep, f"row {row}, at long, id long, kept string, n_words long, n_removed long")


@query("op8_super_kmers")
def op8(spark, sf_dir):
    found = drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )
