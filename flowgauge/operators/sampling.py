"""Seeded samples, class balancing, splits and folds from stable hashes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowgauge.functions.hashing import HASH_SPAN, hash_bucket, hash_number, hash_text
from flowgauge.operators.cleaning import labelled
from flowgauge.sources.scratch import lookup

# Size of the quantile sketches: some 16 KB a class, ranks right to about 0.1 percent.
SKETCH = 2048


def balance(
    df: DataFrame,
    caps: Mapping[str, int],
    key: str,
    seed: int,
    label: str = "label",
    counts: Mapping[str, int] | None = None,
) -> DataFrame:
    """At most caps[c] rows of each capped class, all rows of the others.

    Kept are the rows with the smallest (hash, key) of their class, so the
    result is exact and repeatable. The last row to keep of each class is found
    on two columns only; the wide rows then pass one filter and no shuffle.
    """
    cutoffs = class_cutoffs(df, caps, key, seed, label, counts)
    return labelled(df, label).filter(_within(cutoffs, caps, key, seed, label))


def seeded_sample(
    df: DataFrame, class_name: str, size: int, key: str, seed: int, label: str = "label"
) -> DataFrame:
    """`size` rows of one class, the ones with the smallest hash."""
    return balance(df.filter(F.col(label) == class_name), {class_name: size}, key, seed, label)


def class_cutoffs(
    df: DataFrame,
    caps: Mapping[str, int],
    key: str,
    seed: int,
    label: str = "label",
    counts: Mapping[str, int] | None = None,
) -> dict[str, tuple[str, str]]:
    """(hash, key) of the last row to keep, for each class over its cap.

    The cap-th smallest of n uniform hashes lies near cap / n of the hash span.
    Rows clearly below are only counted; those in a band of about six standard
    deviations around it, a number that grows with the root of the cap, are
    ranked. Should the band miss, the classes are counted anew, as the given
    counts may be wrong, and the band is widened. A band of the whole span that
    misses shows a class at or under its cap, all of whose rows are kept.
    """
    counts = counts if counts is not None else _class_sizes(df, caps, label)
    wanted = {c: cap for c, cap in caps.items() if 0 < cap < counts.get(c, 0)}
    found: dict[str, tuple[str, str]] = {}
    spread = 6.0
    while wanted:
        bands = {c: _band(cap, counts[c], spread) for c, cap in wanted.items()}
        found.update(_ranked_in_band(df, wanted, bands, key, seed, label))
        missed = {c: cap for c, cap in wanted.items() if c not in found and bands[c] != (0, HASH_SPAN)}
        counts = _class_sizes(df, missed, label) if missed else {}
        wanted = {c: cap for c, cap in missed.items() if cap < counts.get(c, 0)}
        spread *= 8
    return found


def _class_sizes(df: DataFrame, caps: Mapping[str, int], label: str) -> dict[str, int]:
    sizes = df.filter(F.col(label).isin(*caps)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return {r[0]: r[1] for r in sizes.collect()}


def _band(cap: int, size: int, spread: float) -> tuple[int, int]:
    margin = spread * sqrt(cap) + 16
    low = max(0, int(HASH_SPAN * (cap - margin) / size))
    return low, min(HASH_SPAN, ceil(HASH_SPAN * (cap + margin) / size))


def _ranked_in_band(
    df: DataFrame,
    caps: Mapping[str, int],
    bands: Mapping[str, tuple[int, int]],
    key: str,
    seed: int,
    label: str,
) -> dict[str, tuple[str, str]]:
    low = _per_class({c: b[0] for c, b in bands.items()}, label)
    high = _per_class({c: b[1] for c, b in bands.items()}, label)
    cap = _per_class(caps, label)
    row = F.struct(F.col("hash"), F.col("key"))
    near = (
        df.filter(F.col(label).isin(*caps))
        .select(
            F.col(label).alias("label"),
            hash_text(seed, key).alias("hash"),
            F.col(key).cast("string").alias("key"),
            low.alias("low"),
            high.alias("high"),
            cap.alias("cap"),
        )
        .withColumn("number", hash_number(F.col("hash")))
        .filter(F.col("number") < F.col("high"))
    )
    # All rows below the band fall into one pre-aggregated group per class.
    slots = near.groupBy("label", "cap", F.when(F.col("number") >= F.col("low"), row).alias("row")).agg(
        F.count(F.lit(1)).alias("n")
    )
    found = {}
    for r in _at_cap(slots).collect():
        if r["row"] is None:
            continue
        if r["upto"] > r["cap"]:
            raise ValueError(f"{key} is not unique within class {r['label']}")
        found[r["label"]] = (r["row"]["hash"], r["row"]["key"])
    return found


def _at_cap(slots: DataFrame) -> DataFrame:
    """Of (label, cap, row, n) the row of each class at which the running number of rows reaches the cap; a null row stands for all before the band."""
    running = W.partitionBy("label").orderBy(F.col("row").asc_nulls_first())
    ranked = slots.withColumn("upto", F.sum("n").over(running))
    return ranked.filter((F.col("upto") >= F.col("cap")) & (F.col("upto") - F.col("n") < F.col("cap")))


def first_per_class(df: DataFrame, caps: Mapping[str, int], order: Column, key: str, label: str = "label", width: int = SKETCH) -> DataFrame:
    """At most caps[c] rows of each capped class, those first in `order` (a bigint, nulls last, ties by key as text); all rows of other classes.

    The order may be spread in any way, as the arrival times of a burst are, so the
    cutoff cannot be guessed from a class's size. One pass makes a mergeable
    quantile sketch of each class, which holds its size and its quantiles at once;
    a second one ranks the rows of a narrow band around the cutoff. Should the
    sketch's error have missed it, the band is widened, with no new pass for sizes.
    """
    value = order.cast("bigint")
    some = {c: n for c, n in caps.items() if n > 0}
    capped = df.filter(F.col(label).isin(*some)).select(F.col(label).alias("label"), value.alias("value"), F.col(key).cast("string").alias("key"))
    cutoffs = _sketched_cutoffs(capped, some, key, width)
    row = F.struct(value.isNull(), value, F.col(key).cast("string"))
    keep = F.lit(True)
    for name, last in cutoffs.items():
        keep = F.when(F.col(label) == name, row <= F.struct(F.lit(last[0]), F.lit(last[1]).cast("bigint"), F.lit(last[2]))).otherwise(keep)
    empty = [c for c, cap in caps.items() if cap <= 0]
    return labelled(df, label).filter(keep & ~F.col(label).isin(*empty) if empty else keep)


def _sketched_cutoffs(rows: DataFrame, caps: Mapping[str, int], key: str, width: int) -> dict[str, tuple]:
    """(no value, value, key) of the last row to keep of each class over its cap."""
    sketched = F.kll_sketch_agg_bigint("value", F.lit(width)).alias("sketch")
    sizes = [F.count(F.lit(1)).alias("n"), F.count("value").alias("known")]
    found: dict[str, tuple] = {}
    if not caps:
        return found
    classes = lookup(rows.groupBy("label").agg(sketched, *sizes))
    over = {r["label"]: r for r in classes.select("label", "n", "known").collect() if r["n"] > caps[r["label"]]}
    wanted, spread = {c: caps[c] for c in over}, 1.0
    while wanted:
        error = 4.0 * spread / width**0.9
        ranks = {c: (cap / over[c]["known"] - error, cap / over[c]["known"] + error) if over[c]["known"] else (0, 1) for c, cap in wanted.items()}
        bands = _sketch_bands(classes, ranks)
        found.update(_ranked_values(rows, wanted, bands, key))
        wanted = {c: cap for c, cap in wanted.items() if c not in found and bands[c] != (None, None)}
        spread *= 8
    return found


def _sketch_bands(classes: DataFrame, ranks: Mapping[str, tuple[float, float]]) -> dict[str, tuple[int | None, int | None]]:
    """The values of each class at its two ranks; None where a rank lies outside all values."""

    def at(which: int) -> Column:
        out = F.lit(None).cast("bigint")
        for name, pair in ranks.items():
            if 0 < pair[which] < 1:
                quantile = F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(pair[which])))
                out = F.when(F.col("label") == name, quantile).otherwise(out)
        return out

    rows = classes.filter(F.col("label").isin(*ranks)).select("label", at(0).alias("low"), at(1).alias("high"))
    return {r["label"]: (r["low"], r["high"]) for r in rows.collect()}


def _ranked_values(rows: DataFrame, caps: Mapping[str, int], bands: Mapping[str, tuple], key: str) -> dict[str, tuple]:
    low, high = (_per_class({c: b[i] for c, b in bands.items() if b[i] is not None}, "label") for i in (0, 1))
    near = rows.filter(F.col("label").isin(*caps)).withColumns({"low": low, "high": high, "cap": _per_class(caps, "label")})
    near = near.filter(F.col("high").isNull() | (F.col("value") <= F.col("high")))
    row = F.struct(F.col("value").isNull().alias("none"), "value", "key")
    before = F.coalesce(F.col("value") < F.col("low"), F.lit(False))
    slots = near.groupBy("label", "cap", F.when(~before, row).alias("row")).agg(F.count(F.lit(1)).alias("n"))
    found = {}
    for r in _at_cap(slots).collect():
        if r["row"] is None:
            continue
        if r["upto"] > r["cap"]:
            raise ValueError(f"{key} is not unique within class {r['label']}")
        found[r["label"]] = tuple(r["row"])
    return found


def _per_class(values: Mapping[str, int], label: str) -> Column:
    out = F.lit(None).cast("bigint")
    for name, value in values.items():
        out = F.when(F.col(label) == name, F.lit(value).cast("bigint")).otherwise(out)
    return out


def _within(
    cutoffs: Mapping[str, tuple[str, str]], caps: Mapping[str, int], key: str, seed: int, label: str
) -> Column:
    row = F.struct(hash_text(seed, key), F.col(key).cast("string"))
    keep = F.lit(True)
    for name, (digest, last) in cutoffs.items():
        keep = F.when(F.col(label) == name, row <= F.struct(F.lit(digest), F.lit(last))).otherwise(keep)
    empty = [c for c, cap in caps.items() if cap <= 0]
    return keep & ~F.col(label).isin(*empty) if empty else keep


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of the tables, columns matched by name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def is_test_row(key: str, share: float, seed: int) -> Column:
    """Whether the row's 32-bit draw lies below the share of the hash span."""
    return hash_number(hash_text(seed, key)) < F.lit(test_bound(share)).cast("bigint")


def test_bound(share: float) -> int:
    return round(HASH_SPAN * share)


def split(df: DataFrame, key: str, share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, complete and the same on any partitioning."""
    test = is_test_row(key, share, seed)
    return df.filter(~test), df.filter(test)


def with_fold(df: DataFrame, key: str, folds: int, seed: int) -> DataFrame:
    """Adds `fold` in [0, folds), drawn apart from the train/test draw."""
    return df.withColumn("fold", hash_bucket(f"fold:{seed}", folds, key).cast("int"))
