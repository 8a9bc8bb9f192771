"""Byte-level BPE: encoding by a priority queue of merge ranks, decoding by vocabulary strings.

``BytePairEncoder`` holds one vocabulary. A text is cut into pieces by the vocabulary's
pattern; each piece is a doubly linked list of symbols. All mergeable neighbours lie in a
heap by rank, then place; a popped entry whose symbols have changed meanwhile is stale and
skipped. Pieces repeat, so a bounded memo keeps the ids of those met lately.

Null texts read as empty and give no tokens. Strings of added tokens inside a text become
those tokens, as in the tokenizers library. Rows are independent: repeated rows, ties and
repeated ids give a result each, an empty table an empty one, other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustmill.llm.tables import text_of

#: Pieces kept in a worker's memo; it is emptied when full.
MEMO_PIECES = 1 << 18

# Fixed value: the pre-tokenizer's pattern of the byte-level vocabularies.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

_SHIFT = 20  # ids are below 2 ** 20


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class BytePairEncoder:
    def __init__(self, vocabulary: str):
        """``vocabulary``: the text of a tokenizers JSON file with a byte-level BPE model."""
        spec = json.loads(vocabulary)
        model = spec["model"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is needed")
        symbols = _byte_symbols()
        byte_of = {c: b for b, c in enumerate(symbols)}
        ids = model["vocab"]
        self.added = {a["content"]: a["id"] for a in spec.get("added_tokens") or []}
        size = 1 + max([*ids.values(), *self.added.values()])
        self.strings: list[bytes] = [b""] * size
        for token, i in ids.items():
            if token not in self.added:
                self.strings[i] = bytes(byte_of[c] for c in token)
        for token, i in self.added.items():
            self.strings[i] = token.encode()
        self.widths = np.array([len(s) for s in self.strings], dtype=np.int64)
        self.first = [ids.get(c) for c in symbols]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[left] << _SHIFT | ids[right]] = len(self.merged)
            self.merged.append(ids[left + right])
        self.pieces = regex.compile(PIECES).findall
        marks = sorted(map(regex.escape, self.added), key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(marks) + ")") if marks else None
        self.memo: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ranks, merged = self.ranks, self.merged
        ids = [self.first[b] for b in piece]
        if None in ids:  # as a model without an unknown token: such bytes are left out
            ids = [i for i in ids if i is not None]
        n = len(ids)
        bits = n.bit_length()
        mask = (1 << bits) - 1
        heap = []
        for at in range(n - 1):
            rank = ranks.get(ids[at] << _SHIFT | ids[at + 1])
            if rank is not None:
                heap.append(rank << bits | at)
        if not heap:
            return ids
        heapq.heapify(heap)
        after = list(range(1, n + 1))  # n: none
        before = list(range(-1, n))  # one place more, written for the end
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            entry = pop(heap)
            at = entry & mask
            right = after[at]
            if ids[at] < 0 or right == n:
                continue  # stale
            rank = entry >> bits
            if ranks.get(ids[at] << _SHIFT | ids[right]) != rank:
                continue  # stale
            ids[at] = symbol = merged[rank]
            ids[right] = -1
            after[at] = right = after[right]
            before[right] = at
            if right != n:
                rank = ranks.get(symbol << _SHIFT | ids[right])
                if rank is not None:
                    push(heap, rank << bits | at)
            left = before[at]
            if left >= 0:
                rank = ranks.get(ids[left] << _SHIFT | symbol)
                if rank is not None:
                    push(heap, rank << bits | left)
        return [i for i in ids if i >= 0]

    def _pack(self, text: str, out: list[bytes]) -> None:
        memo = self.memo
        for piece in self.pieces(text):
            packed = memo.get(piece)
            if packed is None:
                packed = np.array(self.merge(piece.encode()), dtype="<u4").tobytes()
                if len(piece) <= 64:
                    if len(memo) >= MEMO_PIECES:
                        memo.clear()
                    memo[piece] = packed
            out.append(packed)

    def encode_packed(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        if self.marks is None:
            self._pack(text, out)
        else:
            for part in self.marks.split(text):
                if part in self.added:
                    out.append(np.array([self.added[part]], dtype="<u4").tobytes())
                elif part:
                    self._pack(part, out)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype="<u4").tolist()

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.strings.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str) -> BytePairEncoder:
    return BytePairEncoder(vocabulary)


def vocabulary_text(path: str) -> str:
    """The vocabulary file, read on the driver: a model of fixed size that tasks receive."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_texts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids``: token ids of every text."""
    vocabulary = df.sparkSession.sparkContext.broadcast(vocabulary_text(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary.value)
        for batch in batches:
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["key", "ids"])

    rows = df.select(F.col(key).alias("key"), text_of(text).alias("text"))
    kind = df.schema[key].dataType.simpleString()
    return rows.mapInArrow(work, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode_ids(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text``: the string of every id list; null lists give an empty text."""
    vocabulary = df.sparkSession.sparkContext.broadcast(vocabulary_text(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary.value)
        for batch in batches:
            texts = [bpe.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    rows = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    kind = df.schema[key].dataType.simpleString()
    return rows.mapInArrow(work, f"key {kind}, text string").withColumnRenamed("key", key)


DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint"


def encoding_digests(df: DataFrame, path: str) -> DataFrame:
    """Per row: tokens, hash of the ids, hash of the text decoded from them, its bytes.

    Ids and decoded texts stay within a task; only their digests leave it.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(vocabulary_text(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary.value)
        for batch in batches:
            counts, of_ids, of_text, widths = [], [], [], []
            for value in batch.column(1):
                packed = bpe.encode_packed(value.as_py())
                decoded = bpe.decode(np.frombuffer(packed, dtype="<u4").tolist()).encode()
                counts.append(len(packed) // 4)
                of_ids.append(hashlib.sha256(packed).hexdigest())
                of_text.append(hashlib.sha256(decoded).hexdigest())
                widths.append(len(decoded))
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(of_ids, pa.string()),
                    pa.array(of_text, pa.string()),
                    pa.array(widths, pa.int64()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"],
            )

    return df.select(F.col("doc_id").cast("bigint"), text_of().alias("text")).mapInArrow(work, DIGESTS)

