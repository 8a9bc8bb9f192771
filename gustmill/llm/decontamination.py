"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are folded; an item's windows are its runs of 13 words, or the whole item if it is
shorter. Of every stretch of 9 neighbouring 5-grams the smallest hash is kept, for documents
and items alike, so that any 13 words they share leave a common fingerprint. (An item of
c < 13 words uses grams of min(5, c) words and stretches that make up c words.) Fingerprints
are joined; each common one fixes an alignment of item and document, along which the words
themselves are compared. A document's word is hit if it lies in an occurrence of a window.

A null text has no words. An item without words has no window. A null item_id reads as the
empty string; items that share an item_id count once. Rows of documents are judged one by
one, repeated or not, also without a doc_id. Other columns are not read. An empty table of
items leaves every document clean.

Only item fingerprints and candidates are broadcast, and only after they were measured.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustmill.llm.tables import fold_ascii, let, measured_broadcast, numbers, saved, text_of

WINDOW = 13
GRAM = 5
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(fold_ascii(text), SEPARATORS), "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _grams(hashes: Column, size) -> Column:
    """Hash of every run of ``size`` words."""
    starts = numbers(F.lit(1), F.size(hashes) - size + 1)
    return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, size)))


def _winnowed(grams: Column, stretch) -> Column:
    """The smallest hash of every stretch of neighbouring grams."""
    starts = numbers(F.lit(1), F.size(grams) - stretch + 1)
    return F.array_distinct(F.transform(starts, lambda i: F.array_min(F.slice(grams, i, stretch))))


def _fingerprints(words: Column, lengths: list[int]) -> Column:
    """Fingerprints that every shared run of any of ``lengths`` words leaves."""

    def of(hashes: Column) -> Column:
        parts = [_stretched(hashes, size, lengths) for size in sorted({min(GRAM, c) for c in lengths})]
        return F.array_distinct(F.flatten(F.array(*parts)))

    return let(_hashes(words), of)


def _stretched(hashes: Column, size: int, lengths: list[int]) -> Column:
    """Fingerprints for those of ``lengths`` that use grams of ``size`` words."""
    stretches = [c - size + 1 for c in lengths if min(GRAM, c) == size]
    return let(_grams(hashes, size), lambda g: F.flatten(F.array(*[_winnowed(g, s) for s in stretches])))


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id, words, length, window``: items that have words."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(text_of()).alias("words")
    ).distinct()
    return items.withColumn("length", F.size("words")).filter("length > 0").withColumn("window", F.least("length", F.lit(WINDOW)))


def _seeds(items: DataFrame) -> DataFrame:
    """``h, item_id, words, window, q``: an item's fingerprints and where their grams stand."""
    size = F.least(F.lit(GRAM), F.col("window"))
    found = items.select(
        "item_id",
        "words",
        "window",
        let(_hashes(F.col("words")), lambda h: let(_grams(h, size), lambda g: F.struct(g.alias("grams"), _winnowed(g, F.col("window") - size + 1).alias("kept")))).alias("f"),
    )
    grams = found.select("item_id", "words", "window", "f.kept", F.posexplode("f.grams").alias("q", "h"))
    return grams.filter(F.array_contains("kept", F.col("h"))).select("h", "item_id", "words", "window", (F.col("q") + 1).alias("q"))


def _occurrences(words: Column, item: Column) -> Column:
    """Places in ``words`` where a window of ``item`` starts, by extending its seeds."""
    n, window = F.size(words), item["window"]
    size = F.least(F.lit(GRAM), window)

    def diagonals(grams: Column) -> Column:
        def of(seed: Column) -> Column:
            at = F.filter(numbers(F.lit(1), F.size(grams)), lambda i: F.get(grams, i - 1) == seed["h"])
            return F.transform(at, lambda i: i - seed["q"])

        return F.array_distinct(F.flatten(F.transform(item["seeds"], of)))

    def along(d: Column) -> Column:
        low = F.greatest(F.lit(1), 1 - d)
        high = F.least(F.size(item["words"]) - window + 1, n - window + 1 - d)
        same = F.filter(
            numbers(low, high), lambda j: F.slice(words, j + d, window) == F.slice(item["words"], j, window)
        )
        return F.transform(same, lambda j: j + d)

    places = let(_hashes(words), lambda h: let(_grams(h, size), diagonals))
    return F.array_distinct(F.flatten(F.transform(places, along)))


def contamination(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``df`` with ``_n_words`` and ``_hits``: item, window and places of each hit item."""
    items = saved(_items(benchmark))
    lengths = sorted(r[0] for r in items.select("window").distinct().collect())  # 13 values at most
    rows = df.withColumn("_text_hash", F.xxhash64(text_of()))
    if not lengths:
        none = F.array().cast("array<struct<item_id:string,window:int,places:array<int>>>")
        return df.withColumn("_n_words", F.size(words_of(text_of()))).withColumn("_hits", none)
    seeds = saved(_seeds(items))
    prints = rows.select(
        F.col("doc_id").alias("_id"),
        F.col("_text_hash").alias("_hash"),
        F.explode(_fingerprints(words_of(text_of()), lengths)).alias("h"),
    )
    known = saved(seeds.select("h").distinct())
    matched = prints.join(measured_broadcast(known), "h", "left_semi").distinct()
    matched = saved(matched)
    candidates = (
        matched.join(measured_broadcast(seeds), "h")
        .groupBy("_id", "_hash", "item_id", "words", "window")
        .agg(F.collect_set(F.struct("h", "q")).alias("seeds"))
        .groupBy("_id", "_hash")
        .agg(F.collect_list(F.struct("item_id", "words", "window", "seeds")).alias("_items"))
    )
    candidates = measured_broadcast(saved(candidates))
    met = rows.join(
        candidates, rows.doc_id.eqNullSafe(candidates._id) & (rows._text_hash == candidates._hash), "left"
    )

    def judged(words: Column) -> Column:
        hits = F.transform(
            F.col("_items"),
            lambda x: F.struct(x["item_id"].alias("item_id"), x["window"].alias("window"), _occurrences(words, x).alias("places")),
        )
        hits = F.when(F.col("_items").isNotNull(), F.filter(hits, lambda x: F.size(x["places"]) > 0))
        none = F.array().cast("array<struct<item_id:string,window:int,places:array<int>>>")
        return F.struct(F.size(words).alias("n_words"), F.coalesce(hits, none).alias("hits"))

    met = met.withColumn("_judged", let(words_of(text_of()), judged))
    return met.select(*[rows[c] for c in df.columns], F.col("_judged.n_words").alias("_n_words"), F.col("_judged.hits").alias("_hits"))


def n_hit() -> Column:
    """Distinct words within the hits."""
    covered = F.transform(
        F.col("_hits"), lambda x: F.flatten(F.transform(x["places"], lambda p: F.sequence(p, p + x["window"] - 1)))
    )
    return F.size(F.array_distinct(F.flatten(covered))).cast("bigint")


def contaminated(hit: Column, words: Column) -> Column:
    return (hit > 0) & (ONE_IN * hit >= words)


def contamination_digests(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    judged = contamination(df.select("doc_id", "text"), benchmark)
    judged = judged.select("doc_id", F.col("_n_words").cast("bigint").alias("n_words"), n_hit().alias("n_hit"), F.array_distinct(F.col("_hits.item_id")).alias("ids"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("ids")), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def clean_documents(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``df`` that are not contaminated.

    The columns of ``df`` travel as one, so that their names clash with none used here.
    """
    judged = contamination(df.select(F.struct("*").alias("row"), "doc_id", "text"), benchmark)
    judged = judged.withColumn("_n_hit", n_hit())
    return judged.filter(~contaminated(F.col("_n_hit"), F.col("_n_words"))).select("row.*")
