"""Benchmark decontamination with a positional inverted index; DataFrame functions only.

The index holds a posting (term, document, position) for every occurrence of a
benchmark term in the training texts, and one end mark for each document with
its number of words. It is distributed by document: each file is the inverted
index of its own documents, sorted by term, document and position, and is
written once, without a shuffle. Terms that no benchmark item uses can be in no
match and are not stored.

A phrase is looked up from its rarest term: that term's postings, shifted by its
offset, are the candidate starts. They are intersected with the shifted postings
of the second rarest term, and what is left with those of all other terms. So
frequent words are joined only where two rare ones already stand at the right
distance. The postings are streamed past a hash table of what is wanted, dealt by
term, document and position, at every size alike. Proximity matches take the same road with ranges for distances.

The vocabulary and the phrases come from the benchmark; Spark broadcasts them
below its own size bound and shuffles the join beyond it.

Words are compared in lower case of A to Z only. Null and empty texts have no
words, and an item without words has no phrase. A null item id is never listed
or counted, though its phrases hit. Repeated documents are documents of their
own, repeated items count once by id. Empty tables on either side give no hits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.entry import query, table
from flowgauge.sources.scratch import fresh_dir, written

WIDTH = 10
END_MARK = -1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Runs of digits, letters and all that is not ASCII, in either case.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words as they are written; the lower case is taken word by word."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)


def lower_ascii(word: Column) -> Column:
    return F.translate(word, UPPER, LOWER)


@dataclass(frozen=True)
class Phrases:
    """Terms of phrases (phrase, shift, term), their owners (item_id, phrase) and the vocabulary (word, term, folded)."""

    terms: DataFrame
    owners: DataFrame
    vocabulary: DataFrame


def windows_of(items: DataFrame, width: int, text: str = "text", item_id: str = "item_id") -> Phrases:
    """Every run of `width` words of an item, or all words of a shorter one, as a phrase."""
    words = F.transform(words_of(F.col(text)), lower_ascii)
    split = items.select(F.col(item_id).alias("item_id"), words.alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1)))
    found = split.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("words", s, width))).alias("words"))
    phrases = written(found.select("words").distinct().withColumn("phrase", F.monotonically_increasing_id()), "phrases")
    owners = written(found.join(phrases, "words").select("item_id", "phrase").distinct(), "phrase-owners")
    each = phrases.select("phrase", F.posexplode("words").alias("shift", "word"))
    mark = items.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(END_MARK).cast("long").alias("term"))
    numbered = each.select("word").distinct().withColumn("term", F.monotonically_increasing_id()).unionByName(mark)
    vocabulary = written(numbered.withColumn("folded", F.lower("word")), "vocabulary")
    terms = written(each.join(vocabulary, "word").select("phrase", "shift", "term"), "phrase-terms")
    return Phrases(terms, owners, vocabulary)


def build_index(documents: DataFrame, vocabulary: DataFrame, text: str = "text", row_id: str = "doc_id", at: str | None = None) -> DataFrame:
    """Postings (term, at, pos, id) of the vocabulary; `at`, the column named or the position in the read, tells rows apart, id stands at end marks only."""
    numbered = documents.select((F.col(at) if at else F.monotonically_increasing_id()).alias("at"), F.col(row_id).alias("id"), F.col(text).alias("text"))
    spelled = F.array_append(words_of(F.col("text")), F.lit(""))
    exploded = numbered.select("at", "id", F.posexplode(spelled).alias("pos", "spelled"))
    # lower() is much faster and equal for equal words; the filter keeps those that A to Z alone make equal.
    joined = exploded.withColumn("folded", F.lower("spelled")).join(vocabulary, "folded")
    postings = joined.where(lower_ascii(F.col("spelled")) == F.col("word")).select(
        "term", "at", "pos", F.when(F.col("term") == END_MARK, F.col("id")).alias("id")
    )
    path = fresh_dir(documents.sparkSession, "index")
    postings.sortWithinPartitions("term", "at", "pos").write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(postings.schema).parquet(path)


def ranked_terms(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Terms of each phrase with their rank from the rarest, for phrases all of whose terms occur."""
    counts = index.where(F.col("term") != END_MARK).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    by_phrase = Window.partitionBy("phrase")
    known = terms.join(counts, "term", "left").withColumn("least", F.min(F.coalesce("n", F.lit(0))).over(by_phrase)).where("least > 0")
    rank = F.row_number().over(by_phrase.orderBy("n", "shift"))
    return written(known.select("phrase", "shift", "term", rank.alias("rank"), F.count(F.lit(1)).over(by_phrase).alias("size")), "ranked-terms")


def exact_matches(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """(at, phrase, start, size) of every occurrence of a phrase."""
    shifted = ranked.select("phrase", "term", F.col("shift").alias("move"), "rank", "size")
    postings = index.select("term", "at", "pos")
    first = postings.join(shifted.where("rank = 1"), "term")
    starts = first.select("at", "phrase", (F.col("pos") - F.col("move")).alias("start"), "size").where("start >= 0")
    second = shifted.where("rank = 2").select("phrase", "term", "move")
    wanted = starts.where("size > 1").join(second, "phrase").withColumn("pos", F.col("start") + F.col("move"))
    rare = postings.join(second.select("term").distinct(), "term", "left_semi")
    pairs = written(rare.join(wanted.hint("shuffle_hash"), ["term", "at", "pos"]).select("at", "phrase", "start", "size"), "phrase-pairs")
    others = shifted.where("rank > 2").select("phrase", "term", "move")
    expected = pairs.where("size > 2").join(others, "phrase").withColumn("pos", F.col("start") + F.col("move"))
    full = (
        postings.join(expected.hint("shuffle_hash"), ["term", "at", "pos"])
        .groupBy("at", "phrase", "start", "size")
        .count()
        .where("count = size - 2")
    )
    columns = ["at", "phrase", "start", "size"]
    return starts.where("size = 1").select(columns).unionByName(pairs.where("size = 2").select(columns)).unionByName(full.select(columns))


def proximity_matches(index: DataFrame, ranked: DataFrame, reach: int) -> DataFrame:
    """(at, phrase, pos) where the rarest term stands at pos and every other term within `reach` words of it, in any order.

    Positions are joined by cells of `reach` words, so a text full of a frequent
    term gives each candidate the postings of three cells and no more.
    """
    postings = index.select("term", "at", "pos")
    cell = F.floor(F.col("pos") / reach)
    first = postings.join(ranked.where("rank = 1").select("phrase", "term", "size"), "term").select("at", "phrase", "pos", "size")
    beside = F.explode(F.array(*[cell + i for i in (-1, 0, 1)])).alias("cell")

    def within(found: DataFrame, terms: DataFrame) -> DataFrame:
        """Candidates near which all of these terms stand."""
        wanted = terms.groupBy("phrase").agg(F.countDistinct("term").alias("wanted"))
        near = postings.join(terms.select("term").distinct(), "term", "left_semi").select("at", "term", cell.alias("cell"), F.col("pos").alias("other"))
        seek = found.select("*", beside).join(terms, "phrase")
        met = seek.join(near, ["at", "term", "cell"]).where(F.abs(F.col("other") - F.col("pos")) <= reach)
        counted = met.groupBy("at", "phrase", "pos", "size").agg(F.countDistinct("term").alias("n"))
        return counted.join(wanted, "phrase").where("n = wanted").select("at", "phrase", "pos", "size")

    second = ranked.where("rank = 2").select("phrase", "term")
    pairs = written(within(first.where("size > 1"), second), "near-pairs")
    whole = within(pairs.where("size > 2"), ranked.where("rank > 2").select("phrase", "term"))
    out = first.where("size = 1").unionByName(pairs.where("size = 2")).unionByName(whole)
    return out.select("at", "phrase", "pos")


def contamination(index: DataFrame, matches: DataFrame, owners: DataFrame) -> DataFrame:
    """Per document: at, id, n_words, n_hit (words inside matches), n_items and items (their ids as text, sorted)."""
    matches = written(matches, "matches")
    ends = matches.select("at", "start", (F.col("start") + F.col("size")).alias("stop")).groupBy("at", "start").agg(F.max("stop").alias("stop"))
    before = Window.partitionBy("at").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0))))
    hit = ends.select("at", fresh.alias("fresh")).groupBy("at").agg(F.sum("fresh").alias("n_hit"))
    items = matches.select("at", "phrase").distinct().join(owners, "phrase").groupBy("at")
    listed = items.agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    documents = index.where(F.col("term") == END_MARK).select("at", "id", F.col("pos").cast("long").alias("n_words"))
    found = documents.join(hit, "at", "left").join(listed, "at", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return found.select(
        "at", "id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items")
    )


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, text: str = "text", row_id: str = "doc_id", at: str | None = None
) -> DataFrame:
    """What of each document occurs in the benchmark, in windows of `width` words."""
    phrases = windows_of(benchmark, width)
    index = build_index(documents, phrases.vocabulary, text, row_id, at)
    return contamination(index, exact_matches(index, ranked_terms(index, phrases.terms)), phrases.owners)


SQL = r"""
with doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), item as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), phrase as (
  select distinct item_id, array_to_string(w[i : i + 9], ' ') as p, least(len(w), 10) as size
  from item, unnest(range(1, greatest(len(w) - 8, 2))) as t(i) where len(w) > 0
), sizes as (select distinct size from phrase),
place as (
  select doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') as p
  from doc, sizes, unnest(range(1, len(w) - size + 2)) as t(i) where len(w) >= size
), hit as (select doc_id, i, size, item_id from place join phrase using (p, size)),
word as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + size)) as j from hit) group by 1),
found as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from hit group by 1)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join word using (doc_id) left join found using (doc_id)
"""


@query("op10_positional_index", SQL)
def op10(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(documents, table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
