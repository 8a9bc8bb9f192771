"""Token ids as ORC files: one row a document, in ascending order of the document ids.

A file holds ``part`` (its number), ``at`` (ids in the file before the row), ``n_tokens``,
``doc_id`` and ``ids``. Integers of all columns, the ids included, are run-length encoded by
ORC itself. Stripes are small enough to be read by tasks of their own; each carries statistics, a
row index with an entry every ``INDEX_ROWS`` rows and a Bloom filter of the document ids, so
``documents_of`` opens only stripes and row groups that may hold the ids asked for.

``write_tokens`` deals the texts out by ranges of ``doc_id`` and sorts each range, so that the
files in the order of their numbers are in ascending order, and encodes them after the shuffle:
texts are smaller than lists of ids in memory, and the order needs no second one. Rows of one id
follow each other by hash of the text, then by the task that read them, so that one id with any number
of rows fills as many files as its share of all rows. Null ids come first.

A null text reads as empty; every document ends in the end id, so none is without tokens.
Repeated rows give a row each, an empty table no row. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustmill.llm.bpe import vocabulary_text
from gustmill.llm.piecewise import tokenizer
from gustmill.llm.tables import scratch_folder, text_of

END_ID = 0
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
BLOOM_FALSE_RATE = 0.01

STORED = "part int, at bigint, doc_id bigint, n_tokens bigint, ids array<int>"


def ordered_texts(df: DataFrame, partitions: int) -> DataFrame:
    """``doc_id, text``: partitions in ascending order, rows in ascending order within them."""
    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumns({"mark": F.xxhash64("text"), "task": F.spark_partition_id()})
    dealt = rows.repartitionByRange(partitions, "doc_id", "mark", "task")
    return dealt.sortWithinPartitions("doc_id", "mark", "task").select("doc_id", "text")


def write_tokens(
    df: DataFrame, vocabulary_path: str, folder: str, partitions: int | None = None, end_id: int = END_ID
) -> None:
    """Encode every text, end it by ``end_id`` and write the ids to ORC files below ``folder``."""
    spark = df.sparkSession
    vocabulary = spark.sparkContext.broadcast(vocabulary_text(vocabulary_path))
    end = np.array([end_id], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, part, before = tokenizer(vocabulary.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            packed = [library.encode_packed(value.as_py()) + end for value in batch.column(1)]
            counts = np.array([len(own) // 4 for own in packed], dtype=np.int64)
            stops = before + np.cumsum(counts)
            places = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(places), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32)))
            yield pa.record_batch(
                [
                    pa.array(np.full(len(packed), part, dtype=np.int32)),
                    pa.array(stops - counts),
                    batch.column(0),
                    pa.array(counts),
                    ids,
                ],
                ["part", "at", "doc_id", "n_tokens", "ids"],
            )
            before = int(stops[-1]) if len(stops) else before

    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = ordered_texts(df, partitions).mapInArrow(work, STORED).write
    options = {
        "compression": "zstd",
        "orc.stripe.size": str(STRIPE_BYTES),
        "orc.create.index": "true",
        "orc.row.index.stride": str(INDEX_ROWS),
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": str(BLOOM_FALSE_RATE),
    }
    writer.options(**options).orc(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of all documents; ``start``: the ids of all documents before.

    The parts' totals come from one narrow column: a row for each file.
    """
    stored = spark.read.schema(STORED).orc(folder)
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    found = sorted((row["part"], row["n"]) for row in totals.collect())
    starts = np.concatenate(([0], np.cumsum([n for _, n in found]))).tolist()
    bases = spark.createDataFrame([(part, base) for (part, _), base in zip(found, starts, strict=False)], "part int, base bigint")
    # A row for each file: as small as the list of files that Spark keeps on the driver.
    placed = stored.join(F.broadcast(bases), "part")
    return placed.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def documents_of(spark: SparkSession, folder: str, ids: Sequence[int]) -> DataFrame:
    """The stored rows of some documents; statistics and Bloom filters tell what to skip."""
    return spark.read.schema(STORED).orc(folder).filter(F.col("doc_id").isin([int(i) for i in ids]))


DIGESTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def stored_digests(tokens: DataFrame) -> DataFrame:
    """Per row of ``read_tokens``: its place, and the checksum of its ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            stops = np.cumsum(pa.compute.list_value_length(ids).to_numpy(zero_copy_only=False)).tolist()
            sums = [zlib.crc32(flat[low:high]) for low, high in zip([0, *stops], stops, strict=False)]
            yield pa.record_batch([*batch.columns[:3], pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(work, DIGESTS)


def token_file_digests(df: DataFrame, vocabulary_path: str) -> DataFrame:
    """Write the ids of every text to the folder that executors share, read them back, sum them up."""
    spark = df.sparkSession
    folder = f"{scratch_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(df, vocabulary_path, folder)
    return stored_digests(read_tokens(spark, folder))
