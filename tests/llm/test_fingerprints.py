"""Classes of fingerprints against all pairs, and the vectorised likeness against the plain one."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from gustmill.llm import edit_fingerprints as ef
from gustmill.llm import tables


def test_likenesses_are_the_plain_ones():
    rng = np.random.default_rng(1)
    prints = ["", *("".join(rng.choice(list("0123456789abcdef"), 4 * n)) for n in rng.integers(1, 40, 60))]
    pairs = [(a, b) for a in prints for b in prints]
    found = ef.likenesses(ef.packed([a for a, _ in pairs]), ef.packed([b for _, b in pairs]))
    assert np.allclose(found, [ef.likeness(a, b) for a, b in pairs])


@pytest.fixture(scope="module")
def table(spark):
    """All documents of sf0.01 and the links of all pairs of their fingerprints."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prints = spark.createDataFrame(ef.fingerprints(docs).select("doc_id", "fingerprint").toPandas())
    rows = [(r.doc_id, r.fingerprint) for r in prints.collect() if r.fingerprint]
    ids, matrix = np.array([i for i, _ in rows]), ef.packed([p for _, p in rows])
    links = []
    for k in range(len(ids)):
        near = ef.likenesses((matrix[0][k : k + 1], matrix[1][k : k + 1]), matrix) >= ef.NEAR
        links += [(int(ids[k]), int(ids[j])) for j in np.flatnonzero(near) if ids[j] > ids[k]]
    return prints, links


@pytest.mark.parametrize("bound", [tables.BROADCAST_BYTES, 0])
def test_links_are_found_and_only_links_join(table, bound, monkeypatch):
    monkeypatch.setattr(tables, "BROADCAST_BYTES", bound)
    prints, links = table
    label = {r.vertex: r.label for r in ef.near_links(prints).collect()}
    found = [label.get(a, a) == label.get(b, b) for a, b in links]
    assert len(links) > 100 and np.mean(found) >= 0.95
    # Nothing is joined that all pairs would not join.
    root = {}

    def top(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(top(a), top(b))] = min(top(a), top(b))
    assert all(top(v) == top(own) for v, own in label.items())


def test_rows_of_one_id_and_of_none(spark):
    long = "a long text that is told at some length " * 3000
    rows = [(1, long), (1, "something else entirely, of other words"), (2, long + "end"), (None, long), (None, ""), (None, "x"), (3, None), (4, ""), (5, long)]
    found = ef.with_classes(spark.createDataFrame([(i, t, "own", 1) for i, t in rows], "doc_id long, text string, band string, n int").repartition(3)).collect()
    assert len(found) == len(rows)
    assert {r.class_id for r in found if r.doc_id in (1, 2, 5)} == {1} and {r.n_class for r in found if r.doc_id in (1, 2, 5)} == {4}
    assert all(r.class_id is None and r.n_class == 1 for r in found if r.doc_id is None)
    assert {(r.doc_id, r.class_id, r.n_class) for r in found if r.doc_id in (3, 4)} == {(3, 3, 1), (4, 4, 1)}
    order = sorted(((i is not None, i or 0, (t or "")[: ef.PREFIX], t or "") for i, t in rows))
    texts = [t for *_, t in order]
    edited = [hashlib.sha256(ef.edited(t, texts[(n + 1) % len(texts)])[0].encode()).hexdigest() for n, t in enumerate(texts)]
    assert sorted(edited) == sorted(r.edited_sha256 for r in found)
    assert ef.with_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_many_rows_of_one_id_are_split(spark):
    rows = [(None, f"{n} text of some length") for n in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert ef.fingerprints(df).count() == 3000
    from gustmill.llm.ordering import bounds_of
    from pyspark.sql import functions as F

    keys = df.select(F.concat(F.lit("\n"), F.substring("text", 1, ef.PREFIX)).alias("key"))
    assert len(bounds_of(keys, 20)) > 10
