"""Token totals by source, language and tokenizer version, kept by signed changes.

A change has a `before` and an `after` state of one text: an insert has no
before, a delete no after, a revised count has both. A batch of changes is
summed to one signed row for each key, with map-side combine, and written to a
folder of its own. Only then does one row in the ledger name that folder, so a
batch is in the totals wholly or not at all. A batch that the ledger names is
not written again, and if two drivers commit one batch at the same time, readers
take one of the two folders; a folder that no ledger row names is never read.

Totals are the sums of the committed rows. compact() sums them to one folder and
starts a new ledger, which keeps the committed names, so a batch that comes
again later still changes nothing.

Null sources, languages and versions are keys of their own. A null count is 0.
Repeated rows are changes of their own. An empty batch commits and changes
nothing; totals of an empty rollup have no rows. Columns beside before and after
are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.llm.entry import query, table
from flowgauge.sources.scratch import fresh_dir, written

KEYS = ("source", "lang", "version")
LEDGER = "batch string, folder string"
TOTALS = "source string, lang string, version string, docs long, tokens long"
TOTALS_STATE = "struct<source:string,lang:string,version:string,tokens:bigint>"
SUMMARY = "-"


class Rollup:
    """Totals in a shared folder."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base

    @classmethod
    def create(cls, spark: SparkSession, base: str) -> Rollup:
        rollup = cls(spark, base)
        spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(rollup._ledger)
        return rollup

    @property
    def _ledger(self) -> str:
        return f"{self.base}/ledger"

    def _committed(self) -> DataFrame:
        """(batch, folder): one row a batch, also of those before the last compaction, whose folder is null."""
        return self.spark.read.schema(LEDGER).parquet(self._ledger).groupBy("batch").agg(F.min("folder").alias("folder"))

    def _append(self, names: DataFrame, mode: str = "append") -> None:
        names.select("batch", "folder").coalesce(1).write.mode(mode).parquet(self._ledger)

    def _named(self, batch: str, folder: str) -> DataFrame:
        return self.spark.createDataFrame([(batch, folder)], LEDGER)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes; False, and no effect, if the batch is committed already."""
        if batch == SUMMARY:
            raise ValueError(f"{SUMMARY} is not the name of a batch")
        if not self._committed().where(F.col("batch") == batch).isEmpty():
            return False
        folder = f"{self.base}/deltas-{uuid.uuid4().hex}"
        signed_sums(changes).write.parquet(folder)
        self._append(self._named(batch, folder))
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) of all committed batches; keys whose sums are 0 are gone."""
        # The driver holds a folder for each batch since the last compaction, and no older names.
        folders = sorted(r["folder"] for r in self._committed().where("folder is not null").select("folder").distinct().collect())
        if not folders:
            return self.spark.createDataFrame([], TOTALS)
        sums = self.spark.read.schema(TOTALS).parquet(*folders).groupBy(*KEYS)
        return sums.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")

    def compact(self, base: str) -> Rollup:
        """The same totals in a new base, in one folder; the old base stays as it is."""
        done = self._committed().where(F.col("batch") != SUMMARY).select("batch", F.lit(None).cast("string").alias("folder"))
        folder = f"{base}/deltas-{uuid.uuid4().hex}"
        self.totals().write.parquet(folder)
        compacted = Rollup(self.spark, base)
        compacted._append(done.unionByName(compacted._named(SUMMARY, folder)), "errorifexists")
        return compacted


def state(source: Column, lang: Column, version: Column, tokens: Column) -> Column:
    """One side of a change."""
    return F.struct(source.alias("source"), lang.alias("lang"), version.alias("version"), tokens.cast("long").alias("tokens"))


def signed_sums(changes: DataFrame) -> DataFrame:
    """Changes (before, after) summed to one signed row for each key."""
    sides = F.array(F.struct(F.col("after").alias("s"), F.lit(1).alias("sign")), F.struct(F.col("before").alias("s"), F.lit(-1).alias("sign")))
    rows = changes.select(F.explode(sides).alias("x")).where("x.s is not null").select("x.s.*", "x.sign")
    return rows.groupBy(*KEYS).agg(
        F.sum(F.col("sign").cast("long")).alias("docs"),
        F.sum(F.coalesce("tokens", F.lit(0)) * F.col("sign")).cast("long").alias("tokens"),
    )


WORDS, ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SQL = rf"""
with counted as (
  select source, lang,
    len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) as words,
    len(regexp_extract_all(coalesce(text, ''), '{ALNUM}')) as alnum,
    row_number() over (partition by coalesce(text, '') order by doc_id nulls last) as copy
  from documents
)
select source, lang, case when words <> alnum then 'alnum-2' else 'words-1' end as version,
  count(*) as docs, sum(case when words <> alnum then alnum else words end)::bigint as tokens
from counted where copy = 1 group by 1, 2, 3
"""


@query("op7_delta_rollups", SQL)
def op7(spark, sf_dir):
    """All documents come in, later copies of a text go, counts that a second tokenizer sees otherwise are revised.

    The first copy is that of the smallest id, a null id coming last, and of equal
    ids that of the first place; all other rows of the text are copies.
    """
    text = F.coalesce("text", F.lit(""))
    counted = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.sha2(text, 256).alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).alias("words"), F.regexp_count(text, F.lit(ALNUM)).alias("alnum"),
        F.monotonically_increasing_id().alias("at"),
    )
    counted = written(counted, "token-counts")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at")
    first = counted.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    marked = counted.join(first.select("digest", F.col("first.at").alias("first")), "digest", "left")
    again = F.col("first").isNotNull() & (F.col("at") != F.col("first"))

    words = state(F.col("source"), F.col("lang"), F.lit("words-1"), F.col("words"))
    alnum = state(F.col("source"), F.col("lang"), F.lit("alnum-2"), F.col("alnum"))
    batches = {
        "load": counted.select(F.lit(None).cast(TOTALS_STATE).alias("before"), words.alias("after")),
        "copies": marked.where(again).select(words.alias("before"), F.lit(None).cast(TOTALS_STATE).alias("after")),
        "recount": marked.where(~again & (F.col("words") != F.col("alnum"))).select(words.alias("before"), alnum.alias("after")),
    }
    rollup = Rollup.create(spark, fresh_dir(spark, "rollup"))
    for batch, changes in [*batches.items(), *batches.items()]:  # the second time, nothing changes
        rollup.commit(batch, changes)
    return rollup.totals()
