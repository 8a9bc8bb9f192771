"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1, derived from its code point; one more
stands for a stretch of other characters. The vector of a trigram binds (multiplies) its
letters' vectors, the first one rotated twice and the second once. A text's vector bundles
(adds) those of all its trigrams; a language's prototype bundles the texts it is learned
from. A text gets the language whose prototype has the largest cosine with its vector.

Texts are folded by ``str.lower`` first. A null text or one without a letter is ``und`` with
score 0, also when nothing could be learned. Score is the cosine, at least 0. Ties go to the
smaller language name. Rows without a language are not learned from but are predicted. Rows
are independent, whatever repeats; an empty table gives an empty result.

The model has (languages x dimensions) numbers, whatever the input's size: sums are taken in
each task and added by language and dimension in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustmill.llm.tables import text_of

DIMENSIONS = 1024
SEED = 20_240_501
UNKNOWN = "und"

_BREAK = 32  # symbol of everything that is no letter
_BITS = 21  # a code point's width
_SLICE = 4096  # trigrams whose vectors are in memory at a time
_LETTERS: list[np.ndarray] = []
_VECTORS: dict[int, np.ndarray] = {}


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def letter_vector(point: int) -> np.ndarray:
    vector = _VECTORS.get(point)
    if vector is None:
        if len(_VECTORS) >= 1 << 16:
            _VECTORS.clear()
        bits = np.random.default_rng((SEED, point)).integers(0, 2, DIMENSIONS, dtype=np.int8)
        vector = _VECTORS[point] = bits * 2 - 1
    return vector


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of a text, packed into integers, and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    symbols = np.where(_letters()[points], points, _BREAK)
    symbols = np.concatenate(([_BREAK], symbols, [_BREAK]))
    kept = np.ones(len(symbols), dtype=bool)
    kept[1:] = (symbols[1:] != _BREAK) | (symbols[:-1] != _BREAK)
    symbols = symbols[kept]
    if len(symbols) < 3:
        none = np.zeros(0, dtype=np.int64)
        return none, none
    return np.unique(symbols[:-2] << 2 * _BITS | symbols[1:-1] << _BITS | symbols[2:], return_counts=True)


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    mask = (1 << _BITS) - 1
    bound = None
    for turn in (2, 1, 0):
        points, place = np.unique(codes >> turn * _BITS & mask, return_inverse=True)
        letters = np.stack([np.roll(letter_vector(int(p)), turn) for p in points])[place]
        bound = letters if bound is None else bound * letters
    return bound.astype(np.float32)


def bundles(grams: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """One vector for each text."""
    out = np.zeros((len(grams), DIMENSIONS), dtype=np.float32)
    codes, place = np.unique(np.concatenate([g[0] for g in grams]), return_inverse=True)
    counts = np.concatenate([g[1] for g in grams]).astype(np.float32)
    row = np.repeat(np.arange(len(grams)), [len(g[0]) for g in grams])
    order = np.argsort(place, kind="stable")
    row, counts, place = row[order], counts[order], place[order]
    for low in range(0, len(codes), _SLICE):
        part = slice(*np.searchsorted(place, (low, low + _SLICE)))
        matrix = np.zeros((len(grams), min(_SLICE, len(codes) - low)), dtype=np.float32)
        matrix[row[part], place[part] - low] = counts[part]
        out += matrix @ trigram_vectors(codes[low : low + _SLICE])
    return out


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(3)) == 1


def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototypes by language, from the rows of ``df`` that have one."""
    rows = df.filter(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), text_of(text).alias("text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            found: dict[str, list] = {}
            pending = 0
            for lang, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found.setdefault(lang, []).append(trigrams(value.as_py()))
                pending += len(found[lang][-1][0])
                if pending > 1 << 20:
                    _add(sums, found)
                    found, pending = {}, 0
            _add(sums, found)
        for lang, vector in sums.items():
            yield pa.record_batch(
                [pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(vector)],
                ["lang", "dim", "total"],
            )

    sums = rows.mapInArrow(work, "lang string, dim int, total double").groupBy("lang", "dim").agg(
        F.sum("total").alias("total")
    )
    model: dict[str, np.ndarray] = {}
    for lang, dim, total in sums.collect():
        model.setdefault(lang, np.zeros(DIMENSIONS))[dim] = total
    return {k: v for k, v in sorted(model.items()) if v.any()}


def _add(sums: dict[str, np.ndarray], found: dict[str, list]) -> None:
    for lang, grams in found.items():
        codes, place = np.unique(np.concatenate([g[0] for g in grams]), return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate([g[1] for g in grams]), minlength=len(codes))
        total = sums.setdefault(lang, np.zeros(DIMENSIONS))
        for low in range(0, len(codes), _SLICE):
            part = slice(low, low + _SLICE)
            total += counts[part] @ trigram_vectors(codes[part])


def _judge(grams: list[tuple[np.ndarray, np.ndarray]], names: list[str], matrix: np.ndarray) -> pd.DataFrame:
    some = np.array([len(g[0]) > 0 for g in grams], dtype=bool)
    if not names or not some.any():
        return pd.DataFrame({"lang_pred": [UNKNOWN] * len(grams), "score": np.zeros(len(grams)), "letters": some})
    vectors = bundles(grams)
    norms = np.linalg.norm(vectors, axis=1)
    cosines = vectors @ matrix.T / np.where(norms > 0, norms, 1)[:, None]
    best = cosines.argmax(axis=1)
    scores = np.clip(cosines[np.arange(len(grams)), best].astype(np.float64), 0, 1)
    found = np.where(some, np.array(names, dtype=object)[best], UNKNOWN)
    return pd.DataFrame({"lang_pred": found, "score": np.where(some, scores, 0.0), "letters": some})


def with_language(df: DataFrame, model: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """The rows of ``df`` with ``_language``: lang_pred, score and whether the text has letters."""
    names = list(model)
    matrix = np.array([model[n] / np.linalg.norm(model[n]) for n in names], dtype=np.float32).reshape(-1, DIMENSIONS)
    shared = df.sparkSession.sparkContext.broadcast((names, matrix))

    @F.pandas_udf("lang_pred string, score double, letters boolean")
    def language(texts: pd.Series) -> pd.DataFrame:
        parts, grams, size = [], [], 0
        for value in texts:
            grams.append(trigrams(value))
            size += len(grams[-1][0])
            if len(grams) == 128 or size > 1 << 19:
                parts.append(_judge(grams, *shared.value))
                grams, size = [], 0
        parts.append(_judge(grams, *shared.value))
        return pd.concat(parts, ignore_index=True)

    return df.withColumn("_language", language(text_of(text)))


def _learned(df: DataFrame) -> dict[str, np.ndarray]:
    return learn(df.filter(~_held_out()))


def _held_out() -> Column:
    return F.coalesce(held_out(F.col("doc_id")), F.lit(False))


def language_of(df: DataFrame) -> DataFrame:
    """Learn from two thirds of the rows of ``documents`` and predict all of them."""
    found = with_language(df.select("doc_id", "text"), _learned(df))
    return found.select("doc_id", _held_out().alias("held_out"), "_language.lang_pred", "_language.score")


def accepted(df: DataFrame) -> DataFrame:
    """The rows of ``df`` whose text has a letter, also where no language could be learned.

    The columns of ``df`` travel as one, so that their names clash with none used here.
    """
    found = with_language(df.select(F.struct("*").alias("row"), "text"), _learned(df))
    return found.filter("_language.letters").select("row.*")
