"""Language-model scores by Katz backoff over words, learnt from the training documents.

p(w | u) is the Good-Turing discounted share of w among what follows u in
training; for a w that never follows u it is alpha(u) p(w), and p(w) is the
discounted share of w among all tokens, or the mass that the discounts left over
for a word that training has not. alpha(u) makes the words that do not follow u
sum to what the discounts after u leave; the sum over those that do follow is
taken word by word, so every distribution adds up to 1. Where no discount is left
after u, its counts are divided by one more.

Texts are packed into blocks, written once and bucketed by block. A block asks
the model for its distinct words, then for its distinct pairs, as sorted arrays
of hashes, one for each of many parts; the same arrays carry its training counts.
So one exchange both counts the corpus and answers the blocks, and its volume is
the distinct words and pairs of each block. Words and pairs are dealt to parts by
the hash of the (first) word. Followers of words that make up more than half a
part's share are dealt on by their own hash; at most two such words for each part
exist, and their sums are the only ones that pass the driver.

The model is stored in two partitioned tables, one row for each part: `words`
(hashes, counts) and `pairs` (first words, followers, counts). Hashes have 64 bits
for words and 40 more for the follower of a word.

The order is two: on texts like the given ones two thirds of all triples are
distinct, and their exchange alone would pass the disk that the check allows.

Null and empty texts have the end token only. A null id counts as empty text in
the fold, and trains. Repeated rows are texts of their own. An empty table gives
an empty result; without training texts every token is unknown.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.entry import query, table
from flowgauge.llm.packing import pack, pack_bytes, unpack, unpack_bytes
from flowgauge.llm.random_indexing import id_remainder
from flowgauge.llm.words import LOWER, split_words, text_bytes, word_numbers
from flowgauge.sources.scratch import fresh_dir, written

FOLDS, HELD_OUT = 7, 2
BLOCK_BYTES = 16 << 20
PARTS_PER_PARTITION = 2
MOST_DISCOUNTED = 5
BEGIN, END = np.uint64(1), np.uint64(2)
FOLLOWER_SHIFT = np.uint64(24)

BLOCKS = "block long, ids binary, train binary, lengths binary, text binary"
WORD_ASKS = "part int, block long, words binary, counts binary"
WORD_ROWS = "part int, words binary, counts binary, having array<long>, tokens long, answers array<struct<block:long,counts:binary>>"
PAIR_ASKS = "part int, block long, firsts binary, fans binary, followers binary, known binary, counts binary"
PAIR_ROWS = (
    "part int, firsts binary, fans binary, followers binary, known binary, counts binary, having array<long>, "
    "answers array<struct<block:long,counts:binary,places:binary>>"
)
ANSWERS = "block long, part int, kind int, counts binary, alphas binary"
ABOUT_WORDS, ABOUT_PAIRS = 0, 1


@dataclass(frozen=True)
class Discounts:
    """Good-Turing: the factor of a count, from how many distinct items have counts 1 to MOST_DISCOUNTED + 1."""

    factors: tuple[float, ...]

    @classmethod
    def of(cls, having: list[int]) -> Discounts:
        n = dict(enumerate(having, 1))
        last = MOST_DISCOUNTED + 1
        cut = last * n[last] / n[1] if n[1] else 1.0
        factors = [1.0]
        for r in range(1, last):
            usual = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut != 1 else 1.0
            factors.append(usual if 0 < usual < 1 else 1.0)
        return cls((*factors, 1.0))

    def mass(self, counts: np.ndarray) -> np.ndarray:
        """The discounted counts."""
        return counts * np.array(self.factors)[np.minimum(counts, MOST_DISCOUNTED + 1)]


@dataclass(frozen=True)
class Unigrams:
    """What turns the count of a word into its probability."""

    discounts: Discounts
    tokens: int
    distinct: int
    total: float
    unknown: float

    @classmethod
    def of(cls, having: list[int], tokens: int, distinct: int) -> Unigrams:
        discounts = Discounts.of(having)
        lost = sum(r * having[r - 1] * (1 - discounts.factors[r]) for r in range(1, MOST_DISCOUNTED + 1))
        total = tokens if lost > 0 else tokens + 1
        return cls(discounts, tokens, distinct, float(total), (lost if lost > 0 else 1.0) / total)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discounts.mass(counts) / self.total, self.unknown)


def _rows(schema: str, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_flat(schema))


def _flat(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])


def _having(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, ..., MOST_DISCOUNTED + 1."""
    return np.bincount(np.minimum(counts, MOST_DISCOUNTED + 2), minlength=MOST_DISCOUNTED + 3)[1 : MOST_DISCOUNTED + 2].tolist()


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: list[pa.RecordBatch] = []
    size = 0

    def block() -> pa.RecordBatch:
        rows = pa.Table.from_batches(kept)
        data, offsets = text_bytes(rows.column("text"))
        ids = rows.column("id")
        both = np.stack([ids.is_valid().to_numpy().astype(np.int64), ids.fill_null(0).to_numpy()])
        row = {
            "block": rows.column("at")[0].as_py(),
            "ids": both.tobytes(),
            "train": rows.column("train").to_numpy().astype(np.uint8).tobytes(),
            "lengths": np.diff(offsets).tobytes(),
            "text": pack_bytes(LOWER[data]),
        }
        return _rows(BLOCKS, [row])

    for batch in batches:
        _, offsets = text_bytes(batch.column("text"))
        begin = 0
        while begin < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[begin] + BLOCK_BYTES - size, "right")) - 1
            stop = min(max(stop, begin + (not kept)), batch.num_rows)
            if stop > begin:
                kept.append(batch.slice(begin, stop - begin))
                size += int(offsets[stop] - offsets[begin])
                begin = stop
            if begin < batch.num_rows:
                yield block()
                kept, size = [], 0
    if kept:
        yield block()


class Block:
    """A block's texts as numbers of its distinct words, in the order of their hashes."""

    def __init__(self, row: dict, parts: int) -> None:
        self.name, self.parts = row["block"], parts
        known, ids = np.frombuffer(row["ids"], np.int64).reshape(2, -1)
        self.ids, self.known = ids, known.astype(bool)
        self.train = np.frombuffer(row["train"], np.uint8).astype(bool)
        offsets = np.concatenate([[0], np.cumsum(np.frombuffer(row["lengths"], np.int64))])
        words = split_words(unpack_bytes(row["text"]), offsets)
        numbers, hashes = word_numbers(words)
        hashes = np.append(hashes, END)
        self.words, place = np.unique(hashes, return_inverse=True)
        n = np.diff(words.first)
        self.lengths = n + 1
        stops = np.cumsum(self.lengths)
        self.tokens = np.full(int(stops[-1]) if len(stops) else 0, place[-1], np.int64)
        inner = np.ones(len(self.tokens), bool)
        inner[stops - 1] = False
        self.tokens[inner] = place[numbers]
        self.starts = stops - self.lengths
        self.training = np.repeat(self.train, self.lengths)
        self.word_parts = (self.words % np.uint64(parts)).astype(np.int64)

    def word_asks(self) -> Iterator[dict]:
        counts = np.bincount(self.tokens[self.training], minlength=len(self.words))
        for part, some in _by_part(self.word_parts):
            yield {"part": part, "block": self.name, "words": pack(self.words[some], True), "counts": pack(counts[some].astype(np.uint32))}

    def take_words(self, answers: list[dict]) -> None:
        """Training counts of the distinct words, from the answers about words."""
        self.word_counts = np.zeros(len(self.words), np.int64)
        by_part = {a["part"]: a["counts"] for a in answers}
        for part, some in _by_part(self.word_parts):
            self.word_counts[some] = unpack(by_part[part], np.int64)

    def make_pairs(self, hot: dict[int, int]) -> None:
        """The distinct pairs in the order of their words' hashes, and the part of each."""
        self.first_hashes = np.concatenate([[BEGIN], self.words])  # BEGIN is less than any word
        before = np.empty(len(self.tokens), np.int64)
        before[1:] = self.tokens[:-1] + 1
        before[self.starts] = 0
        pairs, self.pair_of = np.unique(before * len(self.words) + self.tokens, return_inverse=True)
        self.pair_first, self.pair_follower = np.divmod(pairs, len(self.words))
        self.pair_parts = pair_parts(self.first_hashes[self.pair_first], self.words[self.pair_follower], hot, self.parts)

    def pair_asks(self) -> Iterator[dict]:
        counts = np.bincount(self.pair_of[self.training], minlength=len(self.pair_first))
        for part, some in _by_part(self.pair_parts):
            firsts, fans = np.unique(self.pair_first[some], return_counts=True)
            followers = self.pair_follower[some]
            yield {
                "part": part,
                "block": self.name,
                "firsts": pack(self.first_hashes[firsts], True),
                "fans": pack(fans.astype(np.uint32)),
                "followers": pack_followers(self.words[followers] >> FOLLOWER_SHIFT),
                "known": pack(self.word_counts[followers].astype(np.uint64)),
                "counts": pack(counts[some].astype(np.uint32)),
            }


def _by_part(parts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part with the places that belong to it, in order."""
    order = np.argsort(parts, kind="stable")
    border = np.flatnonzero(np.concatenate([[True], parts[order][1:] != parts[order][:-1], [True]])) if len(parts) else [0]
    for a, b in zip(border[:-1], border[1:]):
        yield int(parts[order[a]]), order[a:b]


def pair_parts(firsts: np.ndarray, followers: np.ndarray, hot: dict[int, int], parts: int) -> np.ndarray:
    """Part of each pair: by the first word, and for a hot one also by the follower."""
    out = firsts % np.uint64(parts)
    mine, which = found_among(firsts, hot)
    spread = np.array(list(hot.values()), np.uint64)[which]
    out[mine] = (out[mine] + followers[mine] % spread) % np.uint64(parts)
    return out.astype(np.int64)


def found_among(firsts: np.ndarray, hot: dict[int, object]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first words that are hot, and the number of each among the hot ones; by one search for all."""
    if not hot:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    names = np.array(list(hot), np.uint64)
    order = np.argsort(names)
    at = np.minimum(np.searchsorted(names, firsts, sorter=order), len(names) - 1)
    mine = np.flatnonzero(names[order[at]] == firsts)
    return mine, order[at[mine]]


def pack_followers(followers: np.ndarray) -> bytes:
    """40-bit numbers, as they are."""
    return np.ascontiguousarray(followers).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack_followers(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.reshape(-1).view(np.uint64)


def _asks(parts: int, hot: dict[int, int] | None = None):
    """Rows of blocks to asks: about words, or about pairs for groups of a block and its answers about words."""

    def about_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for ask in Block(row, parts).word_asks():
                    yield _rows(WORD_ASKS, [ask])

    def about_pairs(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in blocks.to_pylist():
            block = Block(row, parts)
            block.take_words(answers.to_pylist())
            block.make_pairs(hot)
            out += block.pair_asks()
        return pa.Table.from_pylist(out, schema=_flat(PAIR_ASKS))

    return about_words if hot is None else about_pairs


def _merge_words(asks: pa.Table) -> pa.Table:
    """All words of a part with their training counts, and the answer to each ask."""
    rows = asks.to_pylist()
    words = [unpack(r["words"], np.uint64, True) for r in rows]
    all_words, place = np.unique(np.concatenate(words), return_inverse=True)
    counts = np.bincount(place, np.concatenate([unpack(r["counts"], np.uint32) for r in rows]), len(all_words)).astype(np.int64)
    ends = np.cumsum([len(w) for w in words])[:-1]
    answers = [{"block": r["block"], "counts": pack(counts[p])} for r, p in zip(rows, np.split(place, ends))]
    seen = counts > 0
    row = {
        "part": rows[0]["part"], "words": pack(all_words[seen], True), "counts": pack(counts[seen]),
        "having": [*_having(counts), int(seen.sum())], "tokens": int(counts.sum()), "answers": answers,
    }
    return pa.Table.from_pylist([row], schema=_NESTED_WORDS)


_NESTED_WORDS = pa.schema([
    ("part", pa.int32()), ("words", pa.binary()), ("counts", pa.binary()), ("having", pa.list_(pa.int64())), ("tokens", pa.int64()),
    ("answers", pa.list_(pa.struct([("block", pa.int64()), ("counts", pa.binary())]))),
])
_NESTED_PAIRS = pa.schema([
    ("part", pa.int32()), ("firsts", pa.binary()), ("fans", pa.binary()), ("followers", pa.binary()), ("known", pa.binary()),
    ("counts", pa.binary()), ("having", pa.list_(pa.int64())),
    ("answers", pa.list_(pa.struct([("block", pa.int64()), ("counts", pa.binary()), ("places", pa.binary())]))),
])


def _merge_pairs(asks: pa.Table) -> pa.Table:
    """All pairs of a part with their training counts, and the answer to each ask."""
    rows = asks.to_pylist()
    firsts = [unpack(r["firsts"], np.uint64, True) for r in rows]
    all_firsts, place = np.unique(np.concatenate(firsts), return_inverse=True)
    places = np.split(place, np.cumsum([len(f) for f in firsts])[:-1])
    first = np.concatenate([np.repeat(p, unpack(r["fans"], np.uint32)) for p, r in zip(places, rows)])
    follower = np.concatenate([unpack_followers(r["followers"]) for r in rows])
    order = np.lexsort((follower, first))
    new = np.ones(len(order), bool)
    new[1:] = (first[order][1:] != first[order][:-1]) | (follower[order][1:] != follower[order][:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    asked = [unpack(r["counts"], np.uint32) for r in rows]
    counts = np.bincount(which, np.concatenate(asked), int(new.sum())).astype(np.int64)
    known = np.concatenate([unpack(r["known"], np.uint64) for r in rows])[order][new]
    kept = order[new]
    seen = counts > 0
    ends = np.cumsum([len(a) for a in asked])[:-1]
    answers = [
        {"block": r["block"], "counts": pack(counts[w].astype(np.uint64)), "places": pack(p.astype(np.int64), True)}
        for r, w, p in zip(rows, np.split(which, ends), places)
    ]
    row = {
        "part": rows[0]["part"], "firsts": pack(all_firsts, True),
        "fans": pack(np.bincount(first[kept][seen], minlength=len(all_firsts)).astype(np.int64)),
        "followers": pack_followers(follower[kept][seen]), "known": pack(known[seen]), "counts": pack(counts[seen]),
        "having": _having(counts), "answers": answers,
    }
    return pa.Table.from_pylist([row], schema=_NESTED_PAIRS)


def _context_sums(row: dict, unigrams: Unigrams, discounts: Discounts) -> tuple[np.ndarray, np.ndarray]:
    """First words of a part, and for each: its training count, what the discounts leave of it, and the sum of p over its followers."""
    firsts, fans = unpack(row["firsts"], np.uint64, True), unpack(row["fans"], np.int64)
    counts, known = unpack(row["counts"], np.int64), unpack(row["known"], np.uint64).astype(np.int64)
    which = np.repeat(np.arange(len(firsts)), fans)
    sums = [np.bincount(which, x, len(firsts)) for x in (counts, discounts.mass(counts), unigrams.probability(known))]
    return firsts, np.stack(sums).astype(np.float64)  # without a pair, sums are whole numbers


def _alpha(sums: np.ndarray) -> np.ndarray:
    """alpha of each context, negative where its counts are divided by one more; 1 for a context not in training."""
    count, mass, followers = sums
    whole = mass >= count * (1 - 1e-12)
    total = np.where(whole, count + 1, count)
    left = np.divide(total - np.where(whole, count, mass), total, out=np.ones_like(total), where=count > 0)
    alpha = np.where(count > 0, left / np.maximum(1 - followers, 1e-300), 1.0)
    return np.where(whole & (count > 0), -alpha, alpha)


def _hot_sums(unigrams: Unigrams, discounts: Discounts, hot: dict[int, int]):
    names = np.array(list(hot), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                firsts, sums = _context_sums(row, unigrams, discounts)
                mine = np.isin(firsts, names)
                columns = [pa.array(firsts[mine].view(np.int64)), *[pa.array(s) for s in sums[:, mine]]]
                yield pa.RecordBatch.from_arrays(columns, ["first", "count", "mass", "followers"])

    return run


def _pair_answers(unigrams: Unigrams, discounts: Discounts, hot: dict[int, tuple]):
    """Rows of pairs to the answers of each block: counts of its pairs, alphas of its first words."""
    totals = np.array(list(hot.values()), float).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                firsts, sums = _context_sums(row, unigrams, discounts)
                mine, which = found_among(firsts, hot)
                if len(mine):
                    sums[:, mine] = totals[:, which]
                alphas = _alpha(sums)
                for a in row["answers"]:
                    mine = alphas[unpack(a["places"], np.int64, True)]
                    answer = {"block": a["block"], "part": row["part"], "kind": ABOUT_PAIRS, "counts": a["counts"], "alphas": pack(mine)}
                    yield _rows(ANSWERS, [answer])

    return run


def _score(parts: int, hot: dict[int, int], unigrams: Unigrams, discounts: Discounts, begins: int):
    """A block and all its answers to a row for each text."""

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        told = answers.to_pylist()
        out = []
        for row in blocks.to_pylist():
            block = Block(row, parts)
            block.take_words([a for a in told if a["kind"] == ABOUT_WORDS])
            block.make_pairs(hot)
            by_part = {a["part"]: a for a in told if a["kind"] == ABOUT_PAIRS}
            n = len(block.pair_first)
            counts, alpha = np.zeros(n, np.int64), np.zeros(n)
            for part, some in _by_part(block.pair_parts):
                place = np.unique(block.pair_first[some], return_inverse=True)[1]
                counts[some] = unpack(by_part[part]["counts"], np.uint64).astype(np.int64)
                alpha[some] = unpack(by_part[part]["alphas"], np.float64)[place]
            as_context = np.concatenate([[begins], block.word_counts])
            total = as_context[block.pair_first] + (alpha < 0)
            p = unigrams.probability(block.word_counts)
            seen = counts > 0
            logs = np.empty(n)
            logs[seen] = np.log10(discounts.mass(counts[seen]) / total[seen])
            logs[~seen] = np.log10(np.abs(alpha[~seen])) + np.log10(p[block.pair_follower[~seen]])
            base = np.log10((block.word_counts + 1) / (unigrams.tokens + unigrams.distinct + 1))
            first = block.starts

            def per_text(values: np.ndarray) -> np.ndarray:
                return np.add.reduceat(values, first) if len(first) else np.empty(0)

            out.append(pa.table({
                "id": pa.array(block.ids, mask=~block.known),
                "held_out": ~block.train,
                "n_tokens": block.lengths,
                "n_known": per_text((block.word_counts > 0).astype(np.int64)[block.tokens]),
                "train_tokens": np.full(len(first), unigrams.tokens),
                "base_score": per_text(base[block.tokens]),
                "score": per_text(logs[block.pair_of]),
            }))
        return pa.concat_tables(out) if out else _EMPTY

    return run


SCORES = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_EMPTY = _flat(SCORES).empty_table()


def _bucketed(blocks: DataFrame, buckets: int) -> DataFrame:
    """The blocks, written once in buckets by block, so that answers come to them without another exchange of texts."""
    spark = blocks.sparkSession
    path = fresh_dir(spark, "blocks")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    blocks.write.bucketBy(buckets, "block").option("path", path).option("compression", "uncompressed").saveAsTable(name)
    bucketed = spark.table(name)
    spark.sql(f"drop table {name}")  # the folder stays, the session's catalog is left as it was
    return bucketed


def score_documents(documents: DataFrame, train, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document; train marks those to learn from."""
    spark = documents.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = PARTS_PER_PARTITION * buckets
    named = documents.select(
        F.monotonically_increasing_id().alias("at"),
        F.col(row_id).cast("long").alias("id"),
        train.alias("train"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    blocks = _bucketed(named.mapInArrow(_block_batches, BLOCKS), buckets)

    word_asks = blocks.mapInArrow(_asks(parts), WORD_ASKS).repartitionById(parts, F.col("part"))
    words = written(word_asks.groupBy("part").applyInArrow(_merge_words, WORD_ROWS), "katz-words")
    sums = [F.coalesce(F.sum(F.col("having")[i]), F.lit(0)) for i in range(MOST_DISCOUNTED + 2)]
    *having, distinct, tokens = words.agg(*sums, F.coalesce(F.sum("tokens"), F.lit(0))).first()
    unigrams = Unigrams.of(having, tokens, distinct)
    begins = documents.where(train).count()
    hot = _hot_words(words, unigrams, begins, parts)

    told = words.select("part", F.explode("answers").alias("a")).select(
        "a.block", "part", F.lit(ABOUT_WORDS).alias("kind"), "a.counts", F.lit(None).cast("binary").alias("alphas")
    )
    pair_asks = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_asks(parts, hot), PAIR_ASKS)
    pairs = written(pair_asks.repartitionById(parts, F.col("part")).groupBy("part").applyInArrow(_merge_pairs, PAIR_ROWS), "katz-pairs")
    discounts = Discounts.of(list(pairs.agg(*sums[:-1]).first()))
    partial = pairs.mapInArrow(_hot_sums(unigrams, discounts, hot), "first long, count double, mass double, followers double")
    totals = partial.groupBy("first").agg(*[F.sum(c).alias(c) for c in ("count", "mass", "followers")])
    hot_totals = {r["first"] % (1 << 64): (r["count"], r["mass"], r["followers"]) for r in totals.collect()}
    answers = pairs.mapInArrow(_pair_answers(unigrams, discounts, hot_totals), ANSWERS).unionByName(told)
    score = _score(parts, hot, unigrams, discounts, begins)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, SCORES)


def _hot_words(words: DataFrame, unigrams: Unigrams, begins: int, parts: int) -> dict[int, int]:
    """Words with more than half a part's share of tokens, at most two for each part, and over how many parts each is dealt."""
    least = max(unigrams.tokens / (2 * parts), 1)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names, counts = unpack(row["words"], np.uint64, True), unpack(row["counts"], np.int64)
                many = counts > least
                yield pa.RecordBatch.from_arrays([pa.array(names[many].view(np.int64)), pa.array(counts[many])], ["word", "n"])

    found = {r["word"] % (1 << 64): r["n"] for r in words.mapInArrow(find, "word long, n long").collect()}
    if begins > least:
        found[int(BEGIN)] = begins
    return {w: min(parts, int(-(-n // least))) for w, n in found.items() if w != int(END)}


@query("op2_katz_backoff")
def op2(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(documents, id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    return scored.withColumnRenamed("id", "doc_id")
