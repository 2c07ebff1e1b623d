"""Shards of near equal bytes by histogram sort; DataFrame functions only.

Rows are ordered by (hash of the text, id, position in the input), so equal
texts stand together and yet a text or id that holds a third of all rows can be
cut anywhere. Each round counts the exact bytes and rows between probes, in one
pre-aggregated pass over the keys, and lays new probes only into the gaps where
a splitter still is. It ends when every splitter is within the tolerance or
between two neighbouring rows. Only then are the rows exchanged, once.

The driver holds probes and splitters: a few numbers for each shard and for each
bucket of `bucket_bytes`, never rows of the table.

Null texts and ids are values of their own; a null text has no bytes. Repeated
rows get slots of their own. An empty table gives an empty result. An input
column that is named like a result column is replaced. The input must be a
stable read (a file scan or a written table), as row positions are taken twice.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.entry import query, table
from flowgauge.sources.scratch import written

OVERHEAD = 8
BUCKET_BYTES = 512 * 1024 * 1024
PROBES = 1023
SHARD_TOLERANCE = 0.001
BUCKET_TOLERANCE = 0.1
HALF, FULL = 1 << 63, 1 << 64
END = 1 << 192


@dataclass(frozen=True)
class Point:
    """A border in key space, with the bytes and rows below it."""

    at: int
    size: int
    rows: int


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; 0, that of no bytes, for a null."""
    return F.crc32(F.coalesce(text, F.lit("")))


def sort_key(text: Column, row_id: Column) -> Column:
    """Total order of the rows; a null sorts as the smallest number."""
    least = F.lit(-HALF)
    return F.struct(
        F.when(text.isNull(), least).otherwise(F.xxhash64(text)).alias("h"),
        F.coalesce(row_id.cast("long"), least).alias("id"),
        F.monotonically_increasing_id().alias("at"),
    )


def _number(h: int, row_id: int, at: int) -> int:
    return ((h + HALF) << 128) | ((row_id + HALF) << 64) | (at + HALF)


def _literal(number: int) -> str:
    h, row_id, at = (number >> 128) - HALF, (number >> 64) % FULL - HALF, number % FULL - HALF
    return f"named_struct('h',{h}L,'id',{row_id}L,'at',{at}L)"


def borders_below(key: Column, borders: list[int]) -> Column:
    """How many of the sorted borders are at or below the key: binary search in a constant array."""
    steps = len(borders).bit_length()
    if not steps:
        return F.lit(0)
    padded = borders + [END - 1] * ((1 << steps) - 1 - len(borders))
    array = F.expr("array(" + ",".join(map(_literal, padded)) + ")")
    widths = F.array(*[F.lit(1 << s) for s in reversed(range(steps))])
    return F.aggregate(
        widths, F.lit(0), lambda found, width: found + F.when(F.element_at(array, found + width) <= key, width).otherwise(0)
    )


def _count(keys: DataFrame, probes: list[int]) -> list[dict]:
    """Bytes, rows and key range of each gap between neighbouring probes."""
    cell = borders_below(F.struct("h", "id", "at"), probes)
    ranges = [f(c).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in ("h", "id", "at")]
    rows = keys.groupBy(cell.alias("cell")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"), *ranges)
    found = {r["cell"]: r.asDict() for r in rows.collect()}
    return [found.get(i, {"size": 0, "rows": 0}) for i in range(len(probes) + 1)]


def _range(cell: dict) -> tuple[int, int]:
    """The smallest and largest key that the cell's minima and maxima allow."""
    low, high = [cell["min_h"], -HALF, -HALF], [cell["max_h"], HALF - 1, HALF - 1]
    if low[0] == high[0]:
        low[1], high[1] = cell["min_id"], cell["max_id"]
        if low[1] == high[1]:
            low[2], high[2] = cell["min_at"], cell["max_at"]
    return _number(*low), _number(*high)


def find_splitters(keys: DataFrame, targets: list[tuple[float, float]], total: Point) -> list[Point]:
    """For each (bytes below, tolerance) the border that comes near enough, or nearest."""
    ends = [(Point(0, 0, 0), total) for _ in targets]

    def open_gap(i: int) -> bool:
        (low, high), (wanted, tolerance) = ends[i], targets[i]
        near = min(wanted - low.size, high.size - wanted)
        return near > tolerance and high.rows - low.rows > 1 and high.at - low.at > 1

    while unmet := [i for i in range(len(targets)) if open_gap(i)]:
        gaps = sorted({(ends[i][0].at, ends[i][1].at) for i in unmet})
        each = max(1, PROBES // len(gaps))
        probes = sorted(
            {p for low, high in gaps for k in range(each + 1) if low < (p := low + (high - low) * (k + 1) // (each + 1)) <= high}
            | {low for low, _ in gaps if low}
        )
        probes = [p for p in probes if p < END]
        points, size, rows = [Point(0, 0, 0)], 0, 0
        for probe, cell in zip([*probes, END], _count(keys, probes)):
            if cell["rows"]:
                first, last = _range(cell)
                points += [Point(max(first, points[-1].at), size, rows), Point(min(last + 1, probe), size + cell["size"], rows + cell["rows"])]
            size, rows = size + cell["size"], rows + cell["rows"]
            points.append(Point(probe, size, rows))
        sizes = [p.size for p in points]
        for i in unmet:
            above = max(1, bisect_left(sizes, targets[i][0]))
            low, high = points[above - 1], points[min(above, len(points) - 1)]
            ends[i] = (low, high) if high.at - low.at < ends[i][1].at - ends[i][0].at else ends[i]
    return [low if wanted - low.size <= high.size - wanted else high for (low, high), (wanted, _) in zip(ends, targets)]


def shard_by_bytes(
    df: DataFrame, shards: int, text: str = "text", row_id: str = "doc_id", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """The rows with their shard (0 to shards - 1) and gapless slot within it.

    Sizes of shards differ by SHARD_TOLERANCE or one row. A shard of more than
    bucket_bytes is sorted in several tasks.
    """
    df = df.drop("shard", "slot")
    size = text_size(F.col(text))
    keyed = df.select(F.struct("*").alias("row"), sort_key(F.col(text), F.col(row_id)).alias("key"))
    keys = written(df.select(sort_key(F.col(text), F.col(row_id)).alias("key"), size.alias("size")).select("key.*", "size"), "shard-keys")
    sums = keys.agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).first()
    total = Point(END, sums["size"] or 0, sums["rows"])
    pieces = max(1, ceil(total.size / shards / bucket_bytes))
    each = total.size / (shards * pieces)
    targets = [
        (i * each, each * (BUCKET_TOLERANCE if i % pieces else SHARD_TOLERANCE)) for i in range(1, shards * pieces)
    ] if total.rows else []
    splitters = find_splitters(keys, targets, total)

    starts = [0, *[p.rows for p in splitters]]
    before = [starts[b] - starts[b - b % pieces] for b in range(len(starts))]
    bucket = borders_below(F.col("key"), [p.at for p in splitters])
    in_bucket = Window.partitionBy("bucket").orderBy("key")
    offset = F.element_at(F.array(*[F.lit(x).cast("long") for x in before]), F.col("bucket") + 1)
    dealt = keyed.withColumn("bucket", bucket).repartitionById(len(starts), F.col("bucket"))
    return dealt.withColumn("n", F.row_number().over(in_bucket)).select(
        "row.*",
        F.floor(F.col("bucket") / pieces).cast("int").alias("shard"),
        (F.col("n") - 1 + offset).alias("slot"),
    )


@query("op1_histogram_sort")
def op1(spark, sf_dir):
    shards = shard_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), 24)
    return shards.select(
        "doc_id",
        text_size(F.col("text")).alias("size"),
        text_crc32(F.col("text")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
