"""Near-duplicates by b-bit MinHash, with every link confirmed on the full shingle sets.

A set is the distinct pairs of neighbouring words (a lone word counts as itself), kept as 64-bit
hashes. 128 minima give 32 bands of four; two bits of each minimum are kept, packed into four
longs. Sets that share a band are candidates; the packed signatures give an estimate of their
similarity, corrected for minima that agree by chance, and those clearly below the threshold go.
The rest is compared set by set. At similarity 0.8 a pair shares no band once in 20 million
cases and is dropped by the estimate less often than that.

Groups may be as large as they like. Equal sets are folded first, by an aggregate. Each set is then
compared with the most alike of the smallest ids of its bands; links join parts, and bands that are
all of one part are done. In the others, the sets outside the band's largest part are compared with
all sets around them: bands that share documents make a bucket, a bucket is dealt into blocks of
bounded size, and pairs of blocks are compared exactly in tasks of their own, which return only
links that join parts. So a pair is left out only if the two are joined already, and no step lists
the pairs of a group. Buckets full of sets that are alike but not enough cost comparing them all:
that work, though no output, grows with the square of the bucket.

Empty or null texts have empty sets, linked with nothing. Rows without doc_id are linked with
nothing. Rows that share a doc_id are one document, linked through any of their texts. Columns
other than doc_id and text are not read. Ties: the smallest doc_id stands for a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gustmill.llm.components import min_labels
from gustmill.llm.tables import free_finished_shuffles, maybe_broadcast, measured_broadcast, saved, text_of

MINIMA, BAND_ROWS, BITS = 128, 4, 2
BANDS = MINIMA // BAND_ROWS
WORDS = 2  # words of a shingle, fixed by the contract
THRESHOLD = (80, 100)  # similarity as a fraction
#: An estimate has a standard error of 0.042 at 0.8; pairs 5.5 of these below are not confirmed.
LEAST_ESTIMATE = 0.57
#: Bounds of a block of sets that a task holds.
BLOCK_SETS, BLOCK_SHINGLES = 2048, 1 << 20

_RNG = np.random.default_rng(7)
_FACTORS = _RNG.integers(1, 1 << 63, MINIMA, dtype=np.uint64) | np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, MINIMA, dtype=np.uint64)
_ALTERNATE = 0x5555555555555555


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def shingle_hashes(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: folds and splits ASCII only
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if len(words) < WORDS:
        return _mix(hashes)
    return np.unique(_mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + _mix(hashes[1:] + np.uint64(1))))


def minima(hashes: np.ndarray) -> np.ndarray:
    out = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(hashes), 2048):
        part = hashes[low : low + 2048]
        np.minimum(out, (part[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1), out=out)
    return _mix(out)


def packed_bits(signature: np.ndarray) -> np.ndarray:
    """The low bits of all minima in longs."""
    low = (signature & np.uint64((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    places = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(low << places, axis=1)


def band_keys(signature: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64)
    for column in signature.reshape(BANDS, BAND_ROWS).T:
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


SKETCHES = "doc_id bigint, n_shingles bigint, digest string, bits array<bigint>, bands array<bigint>"


def sketches(df: DataFrame) -> DataFrame:
    """Per row: size and digest of its set, packed signature, band keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bits, bands = [], [], [], []
            for value in batch.column(1):
                hashes = shingle_hashes(value.as_py())
                sizes.append(len(hashes))
                if not len(hashes):
                    digests.append(None)
                    bits.append(None)
                    bands.append(None)
                    continue
                signature = minima(hashes)
                digests.append(xxhash.xxh3_128_hexdigest(hashes.tobytes()))
                bits.append(packed_bits(signature).view(np.int64))
                bands.append(band_keys(signature).view(np.int64))
            lists = pa.list_(pa.int64())
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(bits, lists), pa.array(bands, lists)],
                ["doc_id", "n_shingles", "digest", "bits", "bands"],
            )

    return df.select(F.col("doc_id").cast("bigint"), text_of().alias("text")).mapInArrow(work, SKETCHES)


def full_sets(df: DataFrame) -> DataFrame:
    """``doc_id, shingles``: the sorted hashes of each row's set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(v.as_py()).view(np.int64) for v in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    rows = df.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    return rows.mapInArrow(work, "doc_id bigint, shingles array<bigint>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: equal fields, less those equal by chance."""
    differing = F.lit(0)
    for i in range(MINIMA * BITS // 64):
        x = a[i].bitwiseXOR(b[i])
        folded = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_ALTERNATE))
        differing = differing + F.bit_count(folded)
    chance = 1 / (1 << BITS)
    return (1 - differing / MINIMA - chance) / (1 - chance)


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of ``pairs (a, b)`` (saved) those whose full sets are similar enough."""
    few = measured_broadcast(pairs)
    left = sets.join(few, sets.doc_id == few.a).select("a", "b", F.col("shingles").alias("of_a"))
    right = sets.join(few, sets.doc_id == few.b).select("a", "b", F.col("shingles").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - shared
    part, whole = THRESHOLD
    return left.join(right, ["a", "b"]).filter(whole * shared >= part * union).select("a", "b").distinct()


def linked_components(df: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, a row for each row of ``df``."""
    rows = saved(sketches(df))
    named = rows.filter(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    # Equal sets: the smallest id stands for all; ids with several texts tie those together.
    classes = named.groupBy("digest").agg(
        F.min_by(F.struct("doc_id", "bits", "bands", "n_shingles"), "doc_id").alias("first"), F.count("*").alias("n")
    )
    classes = saved(classes.select("digest", "first.*", "n"))
    same = (
        named.select("doc_id", "digest")
        .join(classes.filter("n > 1").select("digest", F.col("doc_id").alias("a")), "digest")
        .filter("doc_id != a")
        .select("a", F.col("doc_id").alias("b"))
        .distinct()
    )
    members = classes.select("doc_id", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.min("doc_id").alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    members = saved(members.join(shared, "band").select("band", "doc_id", "pivot"))
    ids = saved(members.select("doc_id").distinct())
    signatures = saved(classes.join(maybe_broadcast(ids, 16), "doc_id", "left_semi").select("doc_id", "bits", "n_shingles"))
    # An id with several texts: any of its sets may confirm a link.
    texts = df.select("doc_id", "text").join(maybe_broadcast(ids, 16), "doc_id", "left_semi")
    sets = saved(full_sets(texts))

    labels = _labels(members, signatures, sets, same)
    out = rows.join(labels, rows.doc_id == labels.vertex, "left")
    component = F.coalesce("label", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _alike(pairs: DataFrame, signatures: DataFrame, best: bool) -> DataFrame:
    """Of ``pairs (a, b)`` those alike by estimate; with ``best`` only the most alike ``b`` of each ``a``."""
    left = signatures.select(F.col("doc_id").alias("a"), F.col("bits").alias("of_a"), F.col("n_shingles").alias("n_a"))
    right = signatures.select(F.col("doc_id").alias("b"), F.col("bits").alias("of_b"), F.col("n_shingles").alias("n_b"))
    part, whole = THRESHOLD
    # The intersection lies within the smaller set.
    sizes = whole * F.least("n_a", "n_b") >= part * F.greatest("n_a", "n_b")
    rated = pairs.join(left, "a").join(right, "b").filter(sizes).withColumn("rate", estimate(F.col("of_a"), F.col("of_b")))
    rated = rated.filter(F.col("rate") >= LEAST_ESTIMATE)
    if best:
        rated = rated.groupBy("a").agg(F.max_by("b", F.struct("rate", "b")).alias("b"))
    return rated.select("a", "b").distinct()


def _labels(members: DataFrame, signatures: DataFrame, sets: DataFrame, same: DataFrame) -> DataFrame:
    """``vertex, label`` of all linked documents: the most alike pivots, then all that is left."""
    pairs = members.filter("doc_id != pivot").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")).distinct()
    links = saved(_confirm(saved(_alike(pairs, signatures, best=True)), sets)).unionByName(same)
    labels = saved(min_labels(links))
    placed = members.join(labels, members.doc_id == labels.vertex, "left")
    placed = placed.select("band", "doc_id", F.coalesce("label", "doc_id").alias("part"))
    # Bands that are all of one part are done.
    bands = placed.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.min("doc_id").alias("first"))
    state = saved(placed.join(bands.filter("low != high").select("band", "first"), "band"))
    del placed, bands, pairs
    free_finished_shuffles(state)
    found = _block_links(state, sets)
    if found.isEmpty():
        return labels
    # What is joined already goes in as stars, which need no further rounds.
    return min_labels(labels.select(F.col("vertex").alias("a"), F.col("label").alias("b")).unionByName(found))


def _outside(state: DataFrame) -> DataFrame:
    """Documents that are not in the largest part of one of their bands."""
    parts = state.groupBy("band", "part").agg(F.count("*").alias("n"))
    main = parts.groupBy("band").agg(F.max_by("part", F.struct("n", -F.col("part"))).alias("main"))
    return state.join(main, "band").filter("part != main").select("doc_id").distinct()


def _block_links(state: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between parts, from comparing the documents outside with all that they share bands with.

    Bands that share documents make up a bucket. Its documents are dealt into blocks of bounded
    size, and each block of documents outside meets each block of the bucket in a task of its own.
    """
    nearby = min_labels(state.select(F.col("first").alias("a"), F.col("doc_id").alias("b")))
    docs = state.select("doc_id", "part").distinct()
    docs = docs.join(nearby, docs.doc_id == nearby.vertex).select("doc_id", "part", F.col("label").alias("bucket"))
    docs = docs.join(_outside(state).withColumn("out", F.lit(True)), "doc_id", "left")
    docs = saved(docs.join(sets, "doc_id").withColumn("size", F.size("shingles")))
    blocks = docs.groupBy("bucket").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    docs = docs.join(blocks, "bucket").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["bucket", "one", "two", "doc_id", "part", "shingles"]
    left = docs.filter("out").withColumn("one", F.col("own")).withColumn("two", every).select(*columns)
    right = docs.withColumn("two", F.col("own")).withColumn("one", every)
    right = right.select(*[F.col(c).alias(f"{c}_2") for c in columns])  # names that don't clash
    met = left.groupBy("bucket", "one", "two").cogroup(right.groupBy("bucket_2", "one_2", "two_2"))
    met = met.applyInPandas(_compare, "a bigint, b bigint")
    return saved(met)


def _compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Links between sets of two blocks, none between parts that those before it have joined."""
    parent: dict[int, int] = {}

    def root(part: int) -> int:
        while parent.get(part, part) != part:
            parent[part] = part = parent.get(parent[part], parent[part])
        return part

    out: list[tuple[int, int]] = []
    if len(left) and len(right):
        sizes = np.array([len(s) for s in right["shingles_2"]])
        flat = np.concatenate(right["shingles_2"].to_numpy())
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], np.repeat(np.arange(len(right)), sizes)[order]
        ids, parts = right["doc_id_2"].tolist(), right["part_2"].tolist()
        part, whole = THRESHOLD
        for doc, own, shingles in zip(left["doc_id"], left["part"], left["shingles"], strict=True):
            low, high = np.searchsorted(flat, shingles, "left"), np.searchsorted(flat, shingles, "right")
            widths = high - low
            places = np.repeat(low - np.concatenate(([0], np.cumsum(widths)[:-1])), widths) + np.arange(widths.sum())
            shared = np.bincount(owner[places], minlength=len(right))
            alike = whole * shared >= part * (len(shingles) + sizes - shared)
            for k in np.flatnonzero(alike).tolist():
                one, two = root(int(own)), root(parts[k])
                if one != two:
                    parent[max(one, two)] = min(one, two)
                    out.append((int(doc), ids[k]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def keep_one(df: DataFrame) -> DataFrame:
    """The rows of ``df``, one of each group of near-duplicates; rows without doc_id stay.

    Rows that share a doc_id and differ in text count as documents of their own here: all texts of an
    id but the first get an id beyond all others for the search, so of a group a document with
    an id of its own stays, if there is one. Of equal rows by id and text one stays, the
    first by the other columns. The columns of ``df`` travel as one, so that their names clash
    with none used here.
    """
    rows = df.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = rows.withColumn("mark", F.md5(F.encode(text_of(), "utf-8")))
    named = rows.filter("doc_id IS NOT NULL")
    texts = named.groupBy("doc_id").agg(F.min("mark").alias("first"), F.max("mark").alias("last"))
    several = texts.filter("first != last").select("doc_id", "first")
    others = named.join(several, "doc_id").filter("mark != first").select("doc_id", "mark").distinct()
    others = saved(others.withColumn("n", F.monotonically_increasing_id()))
    vertex = F.col("doc_id")
    if not others.isEmpty():
        beyond = named.agg(F.max("doc_id")).first()[0] + 1
        if beyond > 1 << 62:
            raise ValueError("ids beyond 2 ** 62 leave no room for texts that share one")
        named = named.join(others, ["doc_id", "mark"], "left")
        vertex = F.coalesce(F.col("n") + beyond, "doc_id")
    named = named.select("row", "mark", "text", vertex.alias("doc_id"))
    kept = linked_components(named).filter("kept").select("doc_id").distinct()
    once = named.join(kept, "doc_id", "left_semi")
    order = Window.partitionBy("doc_id").orderBy(*[F.col("row").getField(c) for c in df.columns if c != "doc_id"])
    once = once.withColumn("place", F.row_number().over(order)).filter("place = 1")
    return once.select("row.*").unionByName(rows.filter("doc_id IS NULL").select("row.*"))
