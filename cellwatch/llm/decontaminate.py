"""Test items inside documents: MinHash containment search over size partitions.

Items are short and documents long, so a similarity of whole-document
signatures says nothing (20 of 20,000 shingles). The search therefore keeps
only the item side as MinHash sketches and looks the sketches up in *all*
shingles of every document:

* Items are partitioned by their number of distinct shingles, in doublings.
  Each partition has one sketch length, taken from its upper size: as many
  smallest hashes as an item of that size may miss at the threshold, plus one.
  An item contained at the threshold therefore always has a sketch value in the
  document; no match is left to chance.
* A document is a candidate only for items whose required count its own size
  allows.
* Candidates are verified by the shingles themselves, not by hashes.

Only DataFrame functions are used. The sketches are broadcast when a count
shows that they stay under ``broadcast_rows``; beyond it the same join shuffles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.frames import materialise, plain_words

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BROADCAST_ROWS = 500_000


def _needed(n: Column, threshold: float) -> Column:
    return F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int")


def _starts(words: Column, k: int) -> Column:
    last = F.size(words) - F.lit(k)
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _hashes(words: str, k: int) -> Column:
    """Hash of every run of ``k`` words; runs of different lengths never share a seed."""
    return F.transform(
        _starts(F.col(words), k),
        lambda i: F.xxhash64(F.lit(k), *[F.get(F.col(words), i + F.lit(j)) for j in range(k)]),
    )


def _texts(words: str, k: int) -> Column:
    return F.transform(_starts(F.col(words), k), lambda i: F.array_join(F.slice(F.col(words), i + 1, k), " "))


def _by_length(make, words: str, lengths: list[int]) -> Column:
    return F.concat(*[make(words, k) for k in lengths])


def item_shingles(items: DataFrame, item_id: str, text: str, width: int, threshold: float) -> DataFrame:
    """Items with their distinct shingles, required count, size partition and sketch.

    An item of fewer words than ``width`` has one shingle, its whole sequence.
    Items without a word are left out: nothing contains them.
    """
    words = items.select(F.col(item_id).alias("item_id"), plain_words(F.col(text)).alias("w")).distinct()
    words = words.filter(F.size("w") > 0).withColumn("k", F.least(F.size("w"), F.lit(width)))

    def chosen(make) -> Column:
        return reduce(lambda rest, k: F.when(F.col("k") == k, make("w", k)).otherwise(rest), range(1, width), make("w", width))

    sized = words.select(
        "item_id",
        "k",
        F.array_distinct(chosen(_texts)).alias("shingles"),
        F.array_sort(F.array_distinct(chosen(_hashes))).alias("hashes"),
    ).withColumns({"n_shingles": F.size("shingles"), "size_class": F.floor(F.log2(F.size("shingles"))).cast("int")})
    upper = (F.pow(F.lit(2), F.col("size_class") + 1) - 1).cast("int")
    return sized.withColumns(
        {
            "needed": _needed(F.col("n_shingles"), threshold),
            "sketch": F.slice("hashes", F.lit(1), upper - _needed(upper, threshold) + 1),
        }
    ).drop("hashes")


def contained_items(
    documents: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per document id and item id contained in it at the threshold or more.

    Columns: doc_id, item_id, n_shingles (distinct, of the item), n_found and
    containment. Null and empty texts contain nothing and are contained in
    nothing. Null ids are ids like any other. Rows that share a document id, or
    items that share an item id, are judged one by one and the best containment
    counts. Other columns are not read. Empty tables give no rows.
    """
    sketched = materialise(item_shingles(items, item_id, item_text, width, threshold), "items").withColumn(
        "item", F.struct("item_id", F.xxhash64("shingles").alias("version"))
    )
    sizes = sketched.groupBy("k").agg(F.sum(F.size("shingles")).alias("n")).collect()  # a row per k, 5 at most
    lengths = sorted(r["k"] for r in sizes) or [width]
    small = sum(r["n"] for r in sizes) <= broadcast_rows
    sent = F.broadcast if small else (lambda df: df)

    docs = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.length("text") > 0)
    worded = docs.select(F.struct("doc_id", F.xxhash64("text").alias("version")).alias("doc"), plain_words(F.col("text")).alias("w"))
    worded = worded.filter(F.size("w") > 0)

    sketches = sketched.select("item", "needed", F.explode("sketch").alias("h"))
    probes = worded.select(
        "doc", F.size("w").alias("size"), F.explode(_by_length(_hashes, "w", lengths)).alias("h")
    )
    candidates = materialise(
        probes.join(sent(sketches), "h").filter(F.col("size") >= F.col("needed")).select("doc", "item").distinct(),
        "candidates",
    )

    shingles = sketched.select("item", "needed", "n_shingles", F.explode("shingles").alias("s"))
    suspects = worded.join(candidates.select("doc").distinct(), "doc", "left_semi")
    found = (
        suspects.select("doc", F.explode(F.array_distinct(_by_length(_texts, "w", lengths))).alias("s"))
        .join(sent(shingles), "s")
        .groupBy("doc", "item", "needed", "n_shingles")
        # Equal rows of one id are one document, so a shingle counts once.
        .agg(F.count_distinct("s").alias("n_found"))
        .filter(F.col("n_found") >= F.col("needed"))
    )
    return (
        found.join(candidates, ["doc", "item"], "left_semi")
        .withColumn("containment", F.col("n_found") / F.col("n_shingles"))
        .groupBy(F.col("doc.doc_id").alias("doc_id"), F.col("item.item_id").alias("item_id"))
        .agg(F.max(F.struct("containment", "n_shingles", "n_found")).alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.n_shingles").cast("long").alias("n_shingles"),
            F.col("best.n_found").alias("n_found"),
            F.col("best.containment").alias("containment"),
        )
    )


def decontaminated(documents: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """Rows of ``documents`` whose id contains no item; all columns stay."""
    bad = contained_items(documents, items, doc_id=doc_id, **options).select(F.col("doc_id").alias("_found")).distinct()
    return documents.join(bad, documents[doc_id].eqNullSafe(bad["_found"]), "left_anti")
