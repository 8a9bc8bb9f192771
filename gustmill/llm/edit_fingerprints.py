"""Document fingerprints by a randomised edit embedding.

All texts are walked with the same random bits: at output place j the current character is
written, and the walk goes on to the next character if the bit of (place, character) is set. Texts
at a small edit distance soon walk in step again, so that their outputs differ in few places. One
random bit of each output symbol is sampled at fixed places, 16 for each level; a level spans a
quarter of an octave of places, and a text has the levels that its output reaches. The fingerprint
writes the levels as hexadecimal digits. Likeness weighs the agreement of levels by their spans and
corrects it for bits equal by chance.

Documents that agree in all of 26 bits drawn by the levels' spans, in one of 46 draws, are
candidates; those alike enough are linked, and classes are what links connect. Texts two levels
apart are never alike enough. A band is a number. A first pass counts short hashes of the bands, and only
members of bands met twice move after it.

A null text is empty, with an empty fingerprint; two empty ones are alike. Documents are in order
of doc_id, then of the first characters of the text; a null doc_id comes first, and repeated ones each have the row after them as
the next. A lone document follows itself. Other columns are not read. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustmill.llm.components import min_labels
from gustmill.llm.ordering import FIRST, OWN, in_order
from gustmill.llm.tables import maybe_broadcast, saved, scratch_folder, text_of

PERIOD = 4096  # places after which the walk's bits repeat
KINDS = 256  # characters are told apart by their hash to so many
SAMPLES = 16  # bits of a level
LEVELS = 140  # enough for 2 ** 39 places
#: At likeness 0.8 bits agree with 0.9: by calculation a pair meets in a band in 95 of 100 cases, at 0.85
#: in 998 of 1000. Unlike texts agree in 0.54 of the bits, so seldom in a band.
BANDS, BAND_BITS = 46, 26
SHORTER_BANDS = 8  # of one level less: such pairs can only be near if their bits agree with 0.96
BLOCK = 512  # fingerprints that a task compares with as many
PREFIX = 64  # characters of a text that order documents of one id
NEAR = 0.8

_RNG = np.random.default_rng(31)


def _gaps() -> np.ndarray:
    """By kind and place: how many outputs a character fills that starts at the place."""
    bits = _RNG.integers(0, 2, (KINDS, PERIOD), dtype=np.uint8)
    bits[:, -1] = 1
    gaps = np.empty((KINDS, PERIOD), dtype=np.int64)
    run = np.zeros(KINDS, dtype=np.int64)
    for place in range(PERIOD - 1, -1, -1):
        run = np.where(bits[:, place] == 1, 1, run + 1)
        gaps[:, place] = run
    return gaps


_GAPS = _gaps().astype(np.uint8 if PERIOD < 256 else np.uint16)
_FLAT_GAPS = _GAPS.ravel()
_STARTS = np.array([0, *(int(16 * 2 ** (q / 4)) for q in range(LEVELS))], dtype=np.int64)
_PLACES = np.stack(
    [np.sort(_RNG.integers(a, b, SAMPLES)) for a, b in zip(_STARTS, _STARTS[1:], strict=False)]
)
_BITS = _RNG.integers(0, 2, (KINDS + 1, SAMPLES), dtype=np.uint8)  # the last row: past the end
_BAND_PLACES: dict[int, np.ndarray] = {}
_LANES = 64  # with fewer texts left than this, they are walked one by one


def kinds_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return ((points * np.uint32(2654435761)) >> np.uint32(24)).astype(np.int64)


def walk(kinds: list[np.ndarray], begins: list[int]) -> list[np.ndarray]:
    """Place at which each character of each text starts, and where the last one ends."""
    order = np.argsort([-len(k) for k in kinds], kind="stable")
    lengths = np.array([len(kinds[i]) for i in order], dtype=np.int64)
    out = [np.empty(len(k) + 1, dtype=np.int64) for k in kinds]
    at = np.array([begins[i] for i in order], dtype=np.int64)
    step, mask = 0, PERIOD - 1
    lanes = int(np.count_nonzero(lengths > 0))
    if lanes >= _LANES:
        rows = np.concatenate([kinds[i] for i in order]) * PERIOD
        offsets = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        flat = np.empty(len(rows), dtype=np.int64)
        stop = int(lengths[_LANES - 1])
        live = np.searchsorted(-lengths, -np.arange(stop), "left").tolist()
        for step in range(stop):
            k = live[step]
            place = offsets[:k] + step
            here = at[:k]
            flat[place] = here
            at[:k] = here + _FLAT_GAPS[rows[place] + (here & mask)]
        step = stop
        for lane, i in enumerate(order):
            done = min(int(lengths[lane]), stop)
            out[i][:done] = flat[offsets[lane] : offsets[lane] + done]
    for lane, i in enumerate(order):
        n, here = int(lengths[lane]), int(at[lane])
        if n > step:
            found = []
            for row in (kinds[i][step:] * PERIOD).tolist():
                found.append(here)
                here += int(_FLAT_GAPS[row + (here & mask)])
            out[i][step:n] = found
        out[i][n] = here
    return out


def fingerprint(kinds: np.ndarray, places: np.ndarray) -> str:
    end = int(places[-1])
    if not len(kinds) or not end:
        return ""
    levels = int(np.searchsorted(_STARTS, end, "left"))
    sampled = _PLACES[:levels]
    character = np.searchsorted(places[:-1], sampled, "right") - 1
    kind = np.where(sampled < end, kinds[character], KINDS)
    bits = _BITS[kind, np.arange(SAMPLES)]
    return np.packbits(bits, axis=1).tobytes().hex()


_SPANS = np.diff(_STARTS).astype(np.float64)


def likeness(one: str, two: str) -> float:
    """From 0 to 1; levels that only one has count as unlike."""
    a = np.unpackbits(np.frombuffer(bytes.fromhex(one), dtype=np.uint8)).reshape(-1, SAMPLES)
    b = np.unpackbits(np.frombuffer(bytes.fromhex(two), dtype=np.uint8)).reshape(-1, SAMPLES)
    most, both = max(len(a), len(b)), min(len(a), len(b))
    if not most:
        return 1.0
    agreeing = float((_SPANS[:both] * (a[:both] == b[:both]).mean(axis=1)).sum())
    chance = 0.5 * float(_SPANS[both:most].sum())
    return max(0.0, 2 * (agreeing + chance) / float(_SPANS[:most].sum()) - 1)


_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)
_REACH = np.concatenate(([0.0], np.cumsum(_SPANS)))


def packed(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints as rows of bytes, filled up with zeros, and their levels."""
    raw = [bytes.fromhex(p) for p in prints]
    levels = np.array([len(r) * 8 // SAMPLES for r in raw], dtype=np.int64)
    width = int(levels.max(initial=0)) * SAMPLES // 8
    return np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raw), dtype=np.uint8).reshape(len(raw), width), levels


def likenesses(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """``likeness`` of packed fingerprints, row by row; a single row meets all of the other's."""
    (a, of_a), (b, of_b) = one, two
    width = min(a.shape[1], b.shape[1])
    most, both = np.maximum(of_a, of_b), np.minimum(of_a, of_b)
    unlike = _ONES[a[:, :width] ^ b[:, :width]].reshape(len(both), -1, SAMPLES // 8).sum(axis=2)
    shares = np.where(np.arange(unlike.shape[1]) < both[:, None], 1 - unlike / SAMPLES, 0.0)
    agreeing = shares @ _SPANS[: unlike.shape[1]] + 0.5 * (_REACH[most] - _REACH[both])
    return np.where(most > 0, np.maximum(0.0, 2 * agreeing / np.where(most > 0, _REACH[most], 1) - 1), 1.0)


def edited(text: str, following: str) -> tuple[str, int]:
    """The text with its last quarter replaced by the start of the next, and what it keeps."""
    quarter = len(text) // 4
    kept = len(text) - quarter
    return text[:kept] + following[:quarter], kept


OUT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_AT_ONCE = 1 << 21  # characters in memory at a time


def _rows(pending: list[tuple]) -> list[tuple]:
    """Results for all pending rows but the last, which only is the next of the one before."""
    texts = [p[3] for p in pending]
    kinds = [kinds_of(t) for t in texts]
    places = walk(kinds, [0] * len(texts))
    prints = [fingerprint(k, p) for k, p in zip(kinds, places, strict=True)]
    changed = [edited(t, n) for t, n in zip(texts, texts[1:], strict=False)]
    tails = [np.concatenate((k[kept:kept], kinds_of(new[kept:]))) for (new, kept), k in zip(changed, kinds, strict=False)]
    walked = walk(tails, [int(p[kept]) for (_, kept), p in zip(changed, places, strict=False)])
    out = []
    for i, ((new, kept), tail, end) in enumerate(zip(changed, tails, walked, strict=True)):
        if pending[i][1] != OWN:
            continue
        other = fingerprint(np.concatenate((kinds[i][:kept], tail)), np.concatenate((places[i][:kept], end)))
        out.append(
            (
                pending[i][2],
                len(texts[i]),
                hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                prints[i],
                other,
                likeness(prints[i], other),
                likeness(prints[i], prints[i + 1]),
            )
        )
    return out


def _compressed(rows: DataFrame) -> DataFrame:
    """``rows`` with their texts compressed for the shuffle."""
    names = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names) + ", text binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=6).compress
        for batch in batches:
            texts = [compress(t.as_buffer()) for t in batch.column(len(names))]
            yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.binary())], [*names, "text"])

    return rows.select(*names, "text").mapInArrow(work, schema)


def fingerprints(df: DataFrame) -> DataFrame:
    """The columns of ``OUT`` for every row."""
    key = F.col("doc_id").cast("decimal(20,0)") + F.lit(Decimal(1 << 63))  # not negative
    key = F.coalesce(F.lpad(key.cast("decimal(20,0)").cast("string"), 20, "0"), F.lit(""))
    key = F.concat(key, F.lit("\n"), F.substring(text_of(), 1, PREFIX))  # splits an id with many texts
    rows = df.select(key.alias("key"), text_of().alias("text"), F.col("doc_id").cast("bigint").alias("doc_id"))
    rows = in_order(rows, True, _compressed).select("part", "edge", "doc_id", "text")
    names = [f.split()[0] for f in OUT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def batch_of(pending: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*_rows(pending), strict=True)) or [[]] * len(names)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor().decompress
        pending, size = [], 0
        for batch in batches:
            parts, edges, ids = (batch.column(i).to_pylist() for i in range(3))
            for row in zip(parts, edges, ids, batch.column(3), strict=True):
                if row[1] == FIRST:
                    continue
                row = (*row[:3], decompress(row[3].as_py()).decode("utf-8", "surrogatepass"))
                if pending and (pending[-1][0] != row[0] or size > _AT_ONCE or len(pending) > 8192):
                    same = pending[-1][0] == row[0]
                    if same:
                        pending.append(row)
                    if len(pending) > 1:
                        yield batch_of(pending)
                    pending, size = [], 0
                pending.append(row)
                size += len(row[3])
        if len(pending) > 1:
            yield batch_of(pending)

    return rows.mapInArrow(work, OUT)


def _band_places(levels: int) -> np.ndarray:
    """By band: places of its bits in a fingerprint of so many levels, drawn by the levels' spans."""
    rng = np.random.default_rng((41, levels))
    spans = _SPANS[:levels] / _SPANS[:levels].sum()
    return rng.choice(levels, (BANDS, BAND_BITS), p=spans) * SAMPLES + rng.integers(0, SAMPLES, (BANDS, BAND_BITS))


def band_keys(print_: str) -> list[int]:
    """Keys of all bands at the text's own levels, and of some at one level less."""
    bits = np.unpackbits(np.frombuffer(bytes.fromhex(print_), dtype=np.uint8)).astype(np.int64)
    own, keys = len(bits) // SAMPLES, []
    for levels, bands in ((own, BANDS), (own - 1, SHORTER_BANDS)):
        if levels:
            if levels not in _BAND_PLACES:
                _BAND_PLACES[levels] = _band_places(levels)
            values = bits[_BAND_PLACES[levels][:bands]] @ (1 << np.arange(BAND_BITS, dtype=np.int64))
            keys += ((np.int64(levels) * BANDS + np.arange(bands)) << BAND_BITS | values).tolist()
    return keys


def _members(classes: DataFrame) -> DataFrame:
    """``band, h, part``: the bands of each fingerprint, with its hash and its part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [band_keys(p) for p in batch.column(2).to_pylist()]
            times = [len(k) for k in keys]
            bands = np.array([k for own in keys for k in own], dtype=np.int64)
            rest = [pa.array(np.repeat(batch.column(i).to_numpy(), times).astype(np.int64)) for i in (0, 1)]
            yield pa.record_batch([pa.array(bands), *rest], ["band", "h", "part"])

    return classes.select("h", "part", "fingerprint").mapInArrow(work, "band bigint, h bigint, part bigint")


def near_links(prints: DataFrame, least: float = NEAR) -> DataFrame:
    """``vertex, label``: each linked doc_id and the smallest that links of ``least`` lead to.

    ``prints`` has ``doc_id`` and ``fingerprint``. Equal fingerprints are folded first. Each other one
    is compared with one member of each of its bands. Bands that are all of one part then are
    done; in the others, those outside the largest part are compared with all of it, in blocks.
    """
    named = prints.filter("doc_id IS NOT NULL AND fingerprint != ''").select("doc_id", "fingerprint")
    classes = named.groupBy("fingerprint").agg(F.min("doc_id").alias("a"), F.count("*").alias("n"))
    classes = saved(classes.withColumn("h", F.xxhash64("fingerprint")))
    copies = named.join(classes.filter("n > 1").select("fingerprint", "a"), "fingerprint").filter("doc_id != a")
    copies = copies.select("a", F.col("doc_id").alias("b")).distinct()
    # Bands that are met once, nearly all, go before their members move: told by a short hash, of which
    # a few are met twice by chance.
    members = _members(classes.withColumn("part", F.col("a"))).drop("part").withColumn("short", F.hash("band"))
    short = members.groupBy("short").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("short")
    members = saved(members.join(maybe_broadcast(saved(short), 16), "short").select("band", "h"))
    met = members.groupBy("band").agg(F.min("h").alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    of = classes.select("h", "a", "fingerprint")
    pairs = members.join(met, "band").filter("h != pivot").select("h", "pivot").distinct()
    pairs = pairs.join(of, "h").join(of.select(F.col("h").alias("pivot"), F.col("a").alias("b"), F.col("fingerprint").alias("of_b")), "pivot")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (packed(batch.column(i).to_pylist()) for i in (2, 3))
            near = pa.array(likenesses(one, two) >= least)
            yield batch.select([0, 1]).filter(near)

    links = pairs.select("a", "b", "fingerprint", "of_b").mapInArrow(alike, "a bigint, b bigint")
    links = saved(links.unionByName(copies))
    labels = saved(min_labels(links))
    # The bands again, with the parts; of classes that share any.
    shared = members.select("h").distinct().join(of, "h").join(labels, F.col("a") == F.col("vertex"), "left")
    shared = saved(shared.select("h", "a", "fingerprint", F.coalesce("label", "a").alias("part")))
    placed = _members(shared)
    mixed = placed.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("n"))
    mixed = saved(mixed.filter("low != high AND n > 2").select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    placed = saved(placed.join(maybe_broadcast(mixed, 24), "band"))
    main = placed.groupBy("band", "part").agg(F.count("*").alias("n")).groupBy("band")
    main = main.agg(F.max_by("part", F.struct("n", "part")).alias("main"))
    docs = placed.join(main, "band")
    docs = docs.withColumn("own", F.pmod(F.xxhash64("h", F.lit(1)), F.col("blocks")).cast("int")).join(of, "h")
    docs = saved(docs.select("band", "blocks", "own", "part", "main", "a", "fingerprint"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["band", "one", "two", "a", "part", "fingerprint"]
    left = docs.filter("part != main").withColumn("one", F.col("own")).withColumn("two", every).select(*columns)
    right = docs.withColumn("two", F.col("own")).withColumn("one", every).select(*[F.col(c) for c in columns])
    right = right.select(*[F.col(c).alias(f"{c}_2") for c in columns])

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            (rows, levels), others = packed(left["fingerprint"].tolist()), packed(right["fingerprint_2"].tolist())
            ids, parts = right["a_2"].to_numpy(), right["part_2"].to_numpy()
            for k, (doc, part) in enumerate(zip(left["a"], left["part"], strict=True)):
                near = np.flatnonzero((likenesses((rows[k : k + 1], levels[k : k + 1]), others) >= least) & (parts != part))
                _, first = np.unique(parts[near], return_index=True)  # one link for each part
                found += [(int(doc), int(ids[n])) for n in near[first]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    more = left.groupBy("band", "one", "two").cogroup(right.groupBy("band_2", "one_2", "two_2"))
    more = saved(more.applyInPandas(compare, "a bigint, b bigint").distinct())
    return min_labels(labels.select(F.col("vertex").alias("a"), F.col("label").alias("b")).unionByName(more))


def with_classes(df: DataFrame) -> DataFrame:
    """``fingerprints`` with ``class_id``, the smallest doc_id linked, and ``n_class``, the rows of the class."""
    spark = df.sparkSession
    place = f"{scratch_folder(spark)}/prints-{uuid.uuid4().hex}"
    fingerprints(df).write.option("compression", "zstd").parquet(place)
    rows = spark.read.parquet(place)
    labels = saved(near_links(rows))
    ids = rows.select("doc_id").join(maybe_broadcast(labels, 32), F.col("doc_id") == F.col("vertex"))
    sizes = ids.groupBy("label").agg(F.count("*").alias("n_class"))
    # A row for each linked doc_id.
    classes = saved(labels.join(sizes, "label").select("vertex", F.col("label").alias("class_id"), "n_class"))
    out = rows.join(maybe_broadcast(classes, 40), rows.doc_id == classes.vertex, "left")
    alone = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n_same")).filter("n_same > 1")
    out = out.join(maybe_broadcast(saved(alone), 32), "doc_id", "left")
    n_class = F.coalesce("n_class", "n_same", F.lit(1)).cast("bigint").alias("n_class")
    return out.select(*[f.split()[0] for f in OUT.split(", ")], F.coalesce("class_id", "doc_id").alias("class_id"), n_class)
