"""Stages of the pipeline: clashing names, ids that repeat, long tokens, empty tables, the whole run."""

from __future__ import annotations

import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gustmill.llm import decontamination, language_id, minhash, secrets, tables

NAMES = ["_scan", "_spans", "_changed", "_items", "_place", "_language", "_n_hit", "_hits", "_id", "_hash", "row", "mark", "place", "vertex", "n"]
ALPHA = " ".join(f"alpha{i}" for i in range(30))
OTHER = " ".join(f"one{i} two" for i in range(30))


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [
        (1, ALPHA, "en", 10),
        (2, OTHER + " token = abcdefgh12345678", "en", 20),
        (3, None, None, None),
        (4, "", "fr", 0),
        (None, "no id", "en", 5),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars int")
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in NAMES])


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([("a", ALPHA)], "item_id string, text string")


def test_columns_of_any_name_pass_unchanged(clashing, bench):
    stages = {
        "redacted": secrets.redacted,
        "clean": lambda df: decontamination.clean_documents(df, bench),
        "kept": minhash.keep_one,
        "accepted": language_id.accepted,
    }
    for name, stage in stages.items():
        found = stage(clashing)
        assert found.schema == clashing.schema, name
        rows = found.collect()
        assert rows and all(r[n] == f"own {n}" for r in rows for n in NAMES), name
    texts = {r.doc_id: (r.text, r.n_chars) for r in secrets.redacted(clashing).collect()}
    assert texts[2] == (OTHER + " [SECRET]", len(OTHER) + 9) and texts[1] == (ALPHA, 10) and texts[3] == (None, None)


def test_texts_that_share_an_id_stay_unless_they_are_near_another(spark):
    near = ALPHA + " end"
    rows = [(1, ALPHA, 1), (1, OTHER, 2), (1, OTHER, 2), (2, near, 3), (3, OTHER + " end", 4), (5, "a b", 5), (5, "c d", 6), (5, None, 7), (None, ALPHA, 8), (None, ALPHA, 8)]
    kept = sorted((r.doc_id or 0, r.n) for r in minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect())
    groups = {1: "alpha", 3: "alpha", 2: "other", 4: "other"}
    assert [n for i, n in kept if i == 5] == [5, 6, 7] and [n for i, n in kept if i == 0] == [8, 8]
    one = sorted(groups[n] for i, n in kept if i in (1, 2, 3))
    assert one == ["alpha", "other"] and len(kept) == 7


def test_a_token_of_a_million_characters(spark):
    rng = np.random.default_rng(3)
    letters = list(secrets.ENCODINGS["base64"][0])
    rows = [(1, "".join(rng.choice(letters, 1_000_000))), (2, "short text"), (3, "a1B" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.monotonic()
    found = {r.doc_id: r.n_random for r in secrets.secret_digests(df).collect()}
    assert time.monotonic() - began < 90
    assert found == {1: 1, 2: 0, 3: 0}


def test_the_battery_against_plain_formulas(spark):
    rng = np.random.default_rng(5)
    alphabet = secrets.ENCODINGS["hex"][0]
    tokens = ["".join(rng.choice(list(alphabet), n)) for n in (20, 33, 64, 500)] + ["0123456789abcdef" * 2, "ab" * 20]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    pairs = secrets._equal_pairs(F.col("t"))
    rows = df.select("t", pairs.alias("pairs"), secrets._battery(F.col("t"), F.lit("hex"), pairs).alias("z")).collect()
    for row in rows:
        v = np.array([alphabet.index(c) + 1 for c in row.t], dtype=float)
        n, size = len(v), 16
        counts = np.bincount(v.astype(int), minlength=17)[1:]
        chi = ((counts - n / size) ** 2 / (n / size)).sum()
        even = (np.cbrt(chi / 15) - (1 - 2 / 135)) / np.sqrt(2 / 135)
        high = v * 2 > size
        above, changes = high.sum(), (high[1:] != high[:-1]).sum()
        expected = 2 * above * (n - above) / n
        spread = expected * (expected - 1) / (n - 1)
        runs = (changes - expected) / np.sqrt(spread) if spread > 0 else 99.0  # all on one side
        around = v - v.mean()
        serial = ((around[1:] * around[:-1]).sum() / (around**2).sum() + 1 / n) * np.sqrt(n)
        assert np.allclose([row.z["even"], row.z["runs"], row.z["serial"]], [even, runs, serial])


def test_base_spans_against_plain_expressions(spark):
    rng = np.random.default_rng(7)
    parts = ["token", "PASSWORD", "api_key", "apikey", "=", ":", " ", '"', "'", "\n", "é", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", "x", "/+.", "secretpasswd", "-_"]
    texts = ["".join(rng.choice(parts, 40)) for _ in range(300)] + ["", "deadbeef" * 50, "z" * 40, "_" * 30 + " " + "GHIJ" * 9]
    found = secrets.secret_digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    base = [
        ("assign", re.compile(secrets.ASSIGN), 2, 12),
        ("access", re.compile(secrets.ACCESS), 0, 18),
        ("hex", re.compile(secrets.HEX), 0, 16),
    ]
    for row in found:
        spans = [(m.start(), rank, m.end(), kind) for rank, (kind, p, g, least) in enumerate(base) for m in p.finditer(texts[row.doc_id]) if len(m[g]) >= least]
        want = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))
        assert ",".join(s for s in row.spans.split(",") if not s.startswith("random")) == want


def test_paths_without_broadcasts_give_the_same(spark, clashing, bench, monkeypatch):
    want = sorted(map(str, decontamination.contamination_digests(clashing, bench).collect()))
    kept = sorted(map(str, minhash.keep_one(clashing).collect()))
    monkeypatch.setattr(tables, "BROADCAST_BYTES", 0)
    assert sorted(map(str, decontamination.contamination_digests(clashing, bench).collect())) == want
    assert sorted(map(str, minhash.keep_one(clashing).collect())) == kept


def test_the_whole_run_is_its_stages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    want, kept = docs, set()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        want = stage(spark, want, "/root/testdata/sf0.001")
        assert want.columns == docs.columns, name
        want = spark.createDataFrame(want.toPandas(), docs.schema)
    kept = {r.doc_id: r.text for r in want.collect()}
    assert {r.doc_id for r in found} == set(kept) and len(found) == len(kept) < docs.count()
    assert all(r.n_bytes == len(kept[r.doc_id].encode()) for r in found)
    # Clean documents stay: what goes has no letter, is near one that stays, or holds a benchmark passage.
    contaminated = {r.doc_id for r in decontamination.contamination_digests(docs, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")).collect() if r.contaminated}
    doubles = {r.doc_id for r in minhash.linked_components(docs).collect() if not r.kept}
    gone = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in kept}
    assert all(i in contaminated or i in doubles or not re.search(r"[^\W\d_]", t or "") for i, t in gone.items())


def test_empty_tables_pass_through(spark, bench, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
