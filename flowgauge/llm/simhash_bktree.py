"""Near-duplicates by SimHash, searched with BK-trees.

A fingerprint is made from the 64-bit hashes of all 4-word shingles of a whole
text. Equal fingerprints are grouped first, so a text with any number of copies
is searched once. The distinct fingerprints are dealt to shards: of `blocks`
blocks of bits two fingerprints within the radius agree in `blocks - radius` at
least, so every link lies within a shard of equal bits, whatever the number of
blocks; it grows with the number of fingerprints so that shards stay small. Each
shard is a BK-tree: children are keyed by their Hamming distance to the parent,
and a search follows only edges within the radius of the distance it has seen.

The trees of a partition are built and searched together, a level at a time.
Links to ancestors are found while the tree is built; the search then skips
subtrees that are already joined to the searcher, so a dense group costs little
more than a sparse one and its pairs are never listed. A shard gives each of its
members one edge at most, to the smallest it can reach; the components of these
edges are those of all links.

A tree goes to the task that has its searchers, not to all tasks: trees of all
shards grow with the corpus, and no bound for a broadcast can be shown.

Null and empty texts have no words and the fingerprint zero, linked like any
other. Repeated rows and ids keep a row each. A null id is never the smallest
unless its whole component has none. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.batches import written_in_batches
from flowgauge.llm.components import local_components, star_components
from flowgauge.llm.entry import query, table
from flowgauge.llm.words import LOWER, expand, joined_words, pieces, split_words, text_bytes
from flowgauge.sources.scratch import written

SHINGLE = 4
SEED = 42
RADIUS = 4
BITS = 64

# A shard of more members is dealt again by more blocks.
SHARD_MEMBERS = 4096
AVERAGE_MEMBERS = 64
MOST_BLOCKS = 8

TEXT_BYTES = 1 << 20
SEARCH_PAIRS = 1 << 21


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The fingerprint of each text; bytes are lower-cased already."""
    words = split_words(data, offsets)
    joined, start, stop = joined_words(words)

    counts = np.diff(words.first)
    shingles = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    head = expand(words.first[:-1], shingles)
    tail = head + np.repeat(np.minimum(counts, SHINGLE) - 1, shingles)
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(raw[a:b], SEED) for a, b in zip(start[head].tolist(), stop[tail].tolist())), np.uint64, len(head)
    )

    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(shingles)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = (np.cumsum(shingles) - shingles)[some]
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        over = 2 * ones > shingles[some][:, None]
        out[some] = np.packbits(over, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, TEXT_BYTES):
        data, offsets = text_bytes(batch.column("text"))
        prints = fingerprints(LOWER[data], offsets)
        yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("id"), pa.array(prints.view(np.int64))], ["at", "id", "fp"])


class Forest:
    """BK-trees of several shards in arrays; an item is a node, a shard's first item its root."""

    def __init__(self, shard: np.ndarray, prints: np.ndarray, radius: int) -> None:
        n = len(prints)
        self.prints, self.radius = prints, radius
        self.parent = np.full(n, -1)
        links, levels = [], []
        items, group, root = np.arange(n), shard, True
        self.roots = np.empty(0, int)
        edges: list[tuple[np.ndarray, np.ndarray]] = []
        while len(items):
            order = np.argsort(group, kind="stable")
            items, group = items[order], group[order]
            head = np.concatenate([[True], group[1:] != group[:-1]])
            nodes = items[head]
            if root:
                self.roots, root = nodes, False
            else:
                self.parent[nodes] = group[head] // (BITS + 1)
                edges.append((group[head], nodes))
            levels.append(nodes)
            rest = items[~head]
            above = nodes[np.cumsum(head) - 1][~head]
            far = np.bitwise_count(prints[rest] ^ prints[above]).astype(np.int64)
            near = far <= radius
            links.append((rest[near], above[near]))
            items, group = rest, above * (BITS + 1) + far
        key = np.concatenate([e for e, _ in edges]) if edges else np.empty(0, int)
        child = np.concatenate([c for _, c in edges]) if edges else np.empty(0, int)
        order = np.argsort(key, kind="stable")
        self.key, self.child, self.levels = key[order], child[order], levels
        self.links = tuple(np.concatenate(x) for x in zip(*links)) if links else (np.empty(0, int),) * 2

    def spans(self, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and greatest label below each node, itself included."""
        low, high = label.copy(), label.copy()
        for nodes in reversed(self.levels[1:]):
            np.minimum.at(low, self.parent[nodes], low[nodes])
            np.maximum.at(high, self.parent[nodes], high[nodes])
        return low, high

    def search(self, prints: np.ndarray, root: np.ndarray, own: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(searcher, node) within the radius, but for subtrees joined to the searcher already."""
        low, high = self.spans(label)
        seeker, node = np.arange(len(prints)), root
        found = []
        while len(seeker):
            far = np.bitwise_count(prints[seeker] ^ self.prints[node]).astype(np.int64)
            near = (far <= self.radius) & (label[node] != own[seeker])
            found.append((seeker[near], node[near]))
            a = np.searchsorted(self.key, node * (BITS + 1) + np.maximum(far - self.radius, 0))
            b = np.searchsorted(self.key, node * (BITS + 1) + np.minimum(far + self.radius, BITS), "right")
            seeker, node = np.repeat(seeker, b - a), self.child[expand(a, b - a)]
            open_ = (low[node] != own[seeker]) | (high[node] != own[seeker])
            seeker, node = seeker[open_], node[open_]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int),) * 2


def shard_links(shard: np.ndarray, prints: np.ndarray, planted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from members to the smallest index they reach within their shard.

    Rows are sorted by shard. Only planted rows are in the tree; all rows search it.
    """
    trees = np.flatnonzero(planted)
    forest = Forest(shard[trees], prints[trees], RADIUS)
    label = local_components(len(prints), trees[forest.links[0]], trees[forest.links[1]])
    size = np.bincount(shard, minlength=int(shard[-1]) + 1 if len(shard) else 0)
    root_of = np.full(len(size), -1)
    root_of[shard[trees][forest.roots]] = forest.roots
    seekers = np.flatnonzero(root_of[shard] >= 0)
    work = np.cumsum(size[shard[seekers]])
    at = 0
    while at < len(seekers):
        to = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + SEARCH_PAIRS, "right")))
        some = seekers[at:to]
        who, node = forest.search(prints[some], root_of[shard[some]], label[some], label[trees])
        if len(who):
            merged = local_components(len(prints), label[some[who]], label[trees[node]])
            label = merged[label]
        at = to
    linked = np.flatnonzero(label != np.arange(len(prints)))
    return prints[linked], prints[label[linked]]


def _edge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of a sorted partition, whole ones at a time."""
    kept: list[pa.RecordBatch] = []

    def edges(rows: pa.Table) -> pa.RecordBatch:
        shard = rows.column("shard").to_numpy()
        ids = np.cumsum(np.concatenate([[0], shard[1:] != shard[:-1]])) if len(shard) else np.empty(0, int)
        prints = rows.column("fp").to_numpy().view(np.uint64)
        u, v = shard_links(ids, prints, rows.column("planted").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        shard = batch.column("shard").to_numpy()
        last = int(np.searchsorted(shard, shard[-1]))
        if last or (len(kept) > 1 and kept[-2].column("shard")[-1].as_py() != shard[0]):
            rows = pa.Table.from_batches(kept)
            whole = rows.num_rows - (batch.num_rows - last)
            yield edges(rows.slice(0, whole))
            kept = [batch.slice(last)]
    if kept:
        yield edges(pa.Table.from_batches(kept))


def _masks(blocks: int) -> list[int]:
    """Bit masks of every choice of blocks - RADIUS of the blocks."""
    borders = [BITS * i // blocks for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(borders, borders[1:])]
    masks = [sum(chosen) for chosen in combinations(block, blocks - RADIUS)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _blocks_for(count: int) -> int:
    for blocks in range(RADIUS + 1, MOST_BLOCKS):
        if count <= AVERAGE_MEMBERS << ((blocks - RADIUS) * (BITS // blocks)):
            return blocks
    return MOST_BLOCKS


def _search(keyed: DataFrame) -> DataFrame:
    sharded = keyed.select(F.xxhash64("choice", "value", "tree").alias("shard"), "fp", "planted")
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sharded.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(_edge_batches, "u long, v long")


def near_links(prints: DataFrame) -> DataFrame:
    """Edges (u, v) between distinct fingerprints `fp` whose components are those of all links.

    Shards are found by a hash of their bits; two shards that share a hash are
    searched as one, which finds no wrong link, as distances are compared.
    """
    edges = []
    blocks = _blocks_for(prints.count())
    while True:
        choices = [F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(_masks(blocks))]
        keyed = prints.select("fp", F.explode(F.array(*choices)).alias("k")).select("fp", "k.*")
        hot = written(keyed.groupBy("choice", "value").count().where(F.col("count") > SHARD_MEMBERS), "hot-shards")
        whole = keyed.join(hot, ["choice", "value"], "left_anti")
        edges.append(_search(whole.select("*", F.lit(0).alias("tree"), F.lit(True).alias("planted"))))
        again = keyed.join(hot, ["choice", "value"])
        if blocks == MOST_BLOCKS:
            trees = F.ceil(F.col("count") / SHARD_MEMBERS).cast("int")
            spread = again.select("*", F.explode(F.sequence(F.lit(0), trees - 1)).alias("tree"))
            edges.append(_search(spread.withColumn("planted", F.pmod(F.xxhash64("fp"), trees) == F.col("tree"))))
            break
        if hot.isEmpty():
            break
        prints = written(again.select("fp").distinct(), "hot-prints")
        blocks += 1
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(df: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """Per row: at (its position in the read), id, fp, component_id and stays, true for one row of each component."""
    named = df.select(F.monotonically_increasing_id().alias("at"), F.col(row_id).cast("long").alias("id"), F.col(text).alias("text"))
    prints = written_in_batches(named.mapInArrow(_print_batches, "at long, id long, fp long"), "prints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "at"))
    groups = written(prints.groupBy("fp").agg(first.alias("first"), F.count(F.lit(1)).alias("n")), "print-groups")
    roots = star_components(near_links(groups.select("fp")))
    linked = roots.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct()
    )
    rooted = groups.join(linked, "fp", "left").where("root is not null or n > 1").withColumn("root", F.coalesce("root", "fp"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    shared = rooted.select("fp", "root").join(firsts, "root").select("fp", "first")
    return prints.join(shared, "fp", "left").select(
        "at",
        "id",
        "fp",
        F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("component_id"),
        (F.col("first").isNull() | (F.col("first.at") == F.col("at"))).alias("stays"),
    )


@query("op4_simhash_bktree")
def op4(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
