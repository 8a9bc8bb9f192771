"""Two tokenizations of one text, aligned by the bytes at which their tokens end.

Tokenizer A, a byte-level BPE, reads a space and the text; tokenizer B, a piece BPE that puts
that space before a text itself, reads the text. Both lists of tokens then spell the same
bytes. Wherever a token of each ends at the same byte, the lists are cut into groups.

``cut`` finds the cuts by diagonal run skipping: while tokens pair one to one, the widths of
both agree at a fixed shift of their indexes, so probes of doubling length compare whole
slices and jump the stretch. Where a probe fails, the first bit in which its slices differ
tells the token; the irregular group there is resolved by stepping whichever side lies
behind, and the shift that it leaves is the next diagonal.

The tokens that end a group end together: they are its link. Of two byte strings that end
together one is a suffix of the other, so a token of A of m bytes has links with at most m
byte strings of B besides those it is a suffix of itself. The linked id pairs are therefore
bounded by the bytes of the two vocabularies (``most_pairs``), however large the corpus: their
table may be gathered, and sent to every executor.

A text that is null or empty, or that a tokenizer does not spell back byte by byte, has no
tokens: zeros, and an empty list of groups. Rows are independent but for the counts of id
pairs, in which a repeated row counts each time; ties for a pair's rank are all best. Ids may
be null or repeat. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustmill.llm.bpe import _byte_symbols
from gustmill.llm.piecewise import PiecewiseTokenizer
from gustmill.llm.tables import scratch_folder, text_of

#: Links that a task gathers before it folds them into its table of distinct pairs.
LINKS_AT_ONCE = 1 << 22

#: Tokens that the first probe of a run compares.
PROBE = 16

#: Bytes up to which tokens are joined by one look-up in a table.
NARROW = 16


class Pair:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, byte_level: str, pieces: bytes):
        """``byte_level``: a tokenizers JSON file's text; ``pieces``: a sentencepiece model."""
        import sentencepiece

        self.a = PiecewiseTokenizer(byte_level, plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.bytes_a = bytes_of_byte_level(byte_level)
        self.bytes_b = bytes_of_pieces(self.b)
        self.widths_a, self.widths_b = _widths([len(s) for s in self.bytes_a], [len(s) for s in self.bytes_b])
        # Of wider ones the start only.
        self.narrow_b = np.array(self.bytes_b, dtype=f"S{NARROW}")
        self.entries = max(len(self.bytes_a), len(self.bytes_b))
        self.signed = _signed_decimals(self.entries)

    def groups(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both and their runs; empty where one of them does not spell the text."""
        if text:
            spelled, a, b = (" " + text).encode(), self.a.encode(" " + text), self.b.encode(text, return_type="numpy")
            right = self.a.spelled
            if right is None:
                right = _spell(self.bytes_a, a.tolist()) == spelled
            widths = self.widths_b[b]
            if widths.max() > NARROW or b"\0" in spelled:
                right = right and _spell(self.bytes_b, b.tolist()) == spelled
            else:
                right = right and self.narrow_b[b].tobytes().translate(None, b"\0") == spelled
            if right:
                return a, b, runs_of(self.widths_a[a], widths)
        none = np.zeros(0, dtype=np.uint32)
        return none, none, np.zeros((0, 3), dtype=np.int64)

    def written(self, a: np.ndarray, b: np.ndarray, runs: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Groups as ``a1,a2|b1;a3|b2,b3``, and the linked id pairs as one number each.

        The ids of all groups, A's before B's in each, are looked up as decimals that the sign for
        what comes after them follows.
        """
        last_a, last_b = links_of(runs, len(a), len(b))
        if not len(last_a):
            return b"", np.zeros(0, dtype=np.int64)
        # Before a token of A stand the tokens of B of earlier groups; before one of B all of A's up to its group.
        place_a = np.arange(len(a)) + np.repeat(np.concatenate(([0], last_b[:-1] + 1)), np.diff(last_a, prepend=-1))
        place_b = np.arange(len(b)) + np.repeat(last_a + 1, np.diff(last_b, prepend=-1))
        which = np.empty(len(a) + len(b), dtype=np.int64)
        which[place_a], which[place_b] = a, b
        which[place_a[last_a]] += self.entries
        which[place_b[last_b]] += 2 * self.entries
        out = self.signed[which].tobytes().translate(None, b"\0")
        return out[:-1], _codes(a[last_a], b[last_b])

    def most_pairs(self) -> int:
        """Bound of the distinct id pairs whose byte strings can end together."""
        same_a = max(np.unique([s for s in self.bytes_a if s], return_counts=True)[1], default=0)
        same_b = max(np.unique([s for s in self.bytes_b if s], return_counts=True)[1], default=0)
        return int(self.widths_a.sum(dtype=np.int64) * same_b + self.widths_b.sum(dtype=np.int64) * same_a)


def bytes_of_byte_level(vocabulary: str) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary; of added tokens their string."""
    spec = json.loads(vocabulary)
    byte_of = {c: b for b, c in enumerate(_byte_symbols())}
    ids, added = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
    found = [b""] * (1 + max([*ids.values(), *added.values()]))
    for token, i in ids.items():
        found[i] = bytes(byte_of[c] for c in token) if token not in added else token.encode()
    for token, i in added.items():
        found[i] = token.encode()
    return found


def bytes_of_pieces(model) -> list[bytes]:
    """Bytes of every id of a piece vocabulary; unknown and control pieces have none."""
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            found.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_unknown(i) or model.is_control(i):
            found.append(b"")
        else:
            found.append(piece.replace("▁", " ").encode())
    return found


def cut(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Runs ``(i, j, n)`` in order that cover two ascending lists of ends with the same last value.

    ``n`` > 0: ``n`` groups of one token each, from ``a[i]`` and ``b[j]``. ``n`` = 0: one group,
    which ends where the next run starts, or at the end of both lists.
    """
    return [tuple(run) for run in runs_of(*_widths(np.diff(a, prepend=0), np.diff(b, prepend=0))).tolist()]


def runs_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The runs of ``cut``, as rows, from the widths of the tokens, in one unsigned type."""
    size, n_a = a.itemsize, len(a)
    # Behind their ends, which are the same, the two differ: a probe may reach beyond.
    raw_a, raw_b = a.tobytes() + b"\x00" * PROBE * size, b.tobytes() + b"\xff" * PROBE * size
    a, b = (raw_a, raw_b) if size == 1 else (a.tolist(), b.tolist())
    number = int.from_bytes
    runs = []
    i = j = 0
    while i < n_a:
        # Before i and j the ends agree; probe on from there at the shift j - i.
        x, y, step = i * size, j * size, PROBE * size
        p, q = raw_a[x : x + step], raw_b[y : y + step]
        while p == q:
            x += step
            y += step
            step *= 2
            p, q = raw_a[x : x + step], raw_b[y : y + step]
        # The lowest bit that differs lies in the first token that does.
        differ = number(p, "little") ^ number(q, "little")
        n = x // size - i + ((differ & -differ).bit_length() - 1) // (8 * size)
        if n:
            runs += i, j, n
            i += n
            j += n
            if i == n_a:
                break
        runs += i, j, 0
        ahead = a[i] - b[j]  # of A's end before B's
        while ahead:
            if ahead < 0:
                i += 1
                ahead += a[i]
            else:
                j += 1
                ahead -= b[j]
        i += 1
        j += 1
    return np.array(runs, dtype=np.int64).reshape(-1, 3)


def links_of(runs: np.ndarray, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens that end each group."""
    starts, n = np.concatenate((runs[:, :2], [(n_a, n_b)])), runs[:, 2]
    # Those of a run from its start, that of an irregular group before the next run.
    first = np.where(n[:, None] == 0, starts[1:] - 1, starts[:-1])
    sizes = np.maximum(n, 1)
    before = sizes.cumsum() - sizes
    places = np.arange(sizes.sum())
    return places + np.repeat(first[:, 0] - before, sizes), places + np.repeat(first[:, 1] - before, sizes)


def _widths(a, b) -> list[np.ndarray]:
    """Both in the smallest unsigned type that holds all."""
    kind = np.min_scalar_type(int(max(np.max(a, initial=0), np.max(b, initial=0))))
    return [np.asarray(x).astype(kind) for x in (a, b)]


def _spell(strings: list[bytes], ids: list[int]) -> bytes:
    return b"".join(map(strings.__getitem__, ids))


def _signed_decimals(n: int) -> np.ndarray:
    """The numbers below ``n`` before a comma, then before ``|``, then before ``;``, filled up with zero bytes."""
    names = [f"{i}{sign}".encode() for sign in ",|;" for i in range(n)]
    width = max(map(len, names))
    return np.array(names, dtype=f"S{8 * -(-width // 8)}")


@functools.lru_cache(maxsize=1)
def pair_of(byte_level: str, pieces: bytes) -> Pair:
    return Pair(byte_level, pieces)


def _models(spark: SparkSession, a_path: str, b_path: str):
    """Both vocabulary files, read on the driver: models of fixed size that tasks receive."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


def aligned(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, a, b, groups``: ids of both and the groups, written out, of every text."""
    models = _models(df.sparkSession, a_path, b_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*models.value)
        for batch in batches:
            of_a, of_b, groups = [], [], []
            for value in batch.column(1):
                a, b, runs = pair.groups(value.as_py())
                of_a.append(a.astype(np.int32))
                of_b.append(b.astype(np.int32))
                groups.append(pair.written(a, b, runs)[0].decode())
            ids = pa.list_(pa.int32())
            yield pa.record_batch([batch.column(0), pa.array(of_a, ids), pa.array(of_b, ids), pa.array(groups)], ["key", "a", "b", "groups"])

    rows = df.select(F.col(key).alias("key"), text_of(text).alias("text"))
    kind = df.schema[key].dataType.simpleString()
    return rows.mapInArrow(work, f"key {kind}, a array<int>, b array<int>, groups string").withColumnRenamed("key", key)


COUNTED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
    "link_a array<int>, link_b array<int>, times array<int>"
)
DIGESTS = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def counted_links(df: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per text: its figures and its distinct linked id pairs with how often each occurs."""
    models = _models(df.sparkSession, a_path, b_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*models.value)
        for batch in batches:
            n_a, n_b, n_groups, digests, of_a, of_b, times = [], [], [], [], [], [], []
            for value in batch.column(1):
                a, b, runs = pair.groups(value.as_py())
                groups, links = pair.written(a, b, runs)
                digests.append(hashlib.sha256(groups).hexdigest() if len(a) else "")
                codes, counts = np.unique(links, return_counts=True)
                n_a.append(len(a))
                n_b.append(len(b))
                n_groups.append(len(links))
                of_a.append((codes >> 32).astype(np.int32))
                of_b.append((codes & 0xFFFFFFFF).astype(np.int32))
                times.append(counts.astype(np.int32))
            ids = pa.list_(pa.int32())
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)), pa.array(digests, pa.string())]
            yield pa.record_batch([*columns, *(pa.array(x, ids) for x in (of_a, of_b, times))], _names(COUNTED))

    return df.select(F.col("doc_id").cast("bigint"), text_of().alias("text")).mapInArrow(work, COUNTED)


def _codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b.astype(np.int64)


def _flat(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def _folded(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(np.concatenate(codes), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(times), len(distinct)).astype(np.int64)


def pair_counts(counted: DataFrame) -> DataFrame:
    """``code, n``: for each id pair (A in the upper, B in the lower 32 bits) its links in all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, times, held = [], [], 0
        for batch in batches:
            codes.append(_codes(_flat(batch.column(0)), _flat(batch.column(1))))
            times.append(_flat(batch.column(2)).astype(np.int64))
            held += len(codes[-1])
            if held >= LINKS_AT_ONCE:
                distinct, sums = _folded(codes, times)
                codes, times, held = [distinct], [sums], 0
        if codes:
            distinct, sums = _folded(codes, times)
            yield pa.record_batch([pa.array(distinct), pa.array(sums)], ["code", "n"])

    parts = counted.select("link_a", "link_b", "times").mapInArrow(work, "code bigint, n bigint")
    return parts.groupBy("code").agg(F.sum("n").alias("n"))


def alignment_digests(df: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: figures of its alignment, and how its links stand in the corpus.

    The texts are tokenized once; what the second pass needs is written as Parquet to the
    folder that executors share.
    """
    spark = df.sparkSession
    place = f"{scratch_folder(spark)}/links-{uuid.uuid4().hex}"
    counted_links(df, a_path, b_path).write.parquet(place)
    counted = spark.read.parquet(place)
    # At most ``most_pairs`` rows, whatever the corpus.
    table = pair_counts(counted).toArrow().sort_by("code")
    codes, counts = (table[name].to_numpy() for name in ("code", "n"))
    pieces = codes & 0xFFFFFFFF
    highest = np.zeros(int(pieces.max()) + 1 if len(pieces) else 0, dtype=np.int64)
    np.maximum.at(highest, pieces, counts)
    shared = spark.sparkContext.broadcast((codes, counts, counts == highest[pieces]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = shared.value
        for batch in batches:
            lists = batch.column(7)
            times = _flat(lists).astype(np.int64)
            at = np.searchsorted(codes, _codes(_flat(batch.column(5)), _flat(batch.column(6))))
            stops = np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
            figures = []
            for each in (times, times * best[at], times * counts[at]):
                sums = np.concatenate(([0], np.cumsum(each)))[stops] if len(stops) else stops
                figures.append(pa.array(np.diff(sums, prepend=0).astype(np.int64)))
            yield pa.record_batch([*batch.columns[:4], *figures, batch.column(4)], _names(DIGESTS))

    return counted.mapInArrow(work, DIGESTS)
