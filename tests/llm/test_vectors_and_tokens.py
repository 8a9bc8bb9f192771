"""Whitening, token files and the alignment of tokenizers against plain computations."""

from __future__ import annotations

import hashlib
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gustmill.llm import cross_tokenizers, piecewise, queries, token_files, whitening

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
ODD = [
    (5, "The cat sat on the mat.\nThe end.", "x"),
    (5, "The cat sat on the mat.\nThe end.", "x"),  # repeated
    (3, None, "x"),
    (-4, "", None),
    (None, "no id here", "x"),
    (None, None, "x"),
    (7, "a\x00b <|endoftext|> <s> </s> <unk> <0x41> ▁x", "x"),
    (8, "  two  spaces \U0001f926‍ É été straße 漢字", "x"),
    (9, "word " * 60_000 + "\n" * 2000 + "z" * 20_000, "x"),
    (10, "one", "x"),
    (5, "another text of one id", "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, s, 1, 2, "n") for i, t, s in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, mark int, part int, a string").repartition(3)


# Whitening


def reference(rows, components=4):
    """Rows of the whitening by plain arithmetic, with components of either sign."""
    kept = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = {}
    for i, x in kept:
        z = (np.array(x) - sums / n) @ vectors / np.sqrt(values)
        deviation = sum((n * v - int(s)) ** 2 for v, s in zip(x, sums, strict=True))
        for k in range(min(components, len(x))):
            found.setdefault((i, k + 1), []).append((n, deviation, z[k], values[k] / np.trace(covariance)))
    return found


def compared(frame, wanted):
    rows = {}
    for r in frame.collect():
        rows.setdefault((r.vec_id, r.component), []).append(r)
    assert {k: len(v) for k, v in rows.items()} == {k: len(v) for k, v in wanted.items()}
    signs = {}
    for key, own in sorted(rows.items(), key=repr):
        for r, (n, deviation, z, explained) in zip(
            sorted(own, key=lambda r: r.deviation), sorted(wanted[key], key=lambda w: w[1]), strict=True
        ):
            assert (r.n, r.deviation) == (n, deviation) and abs(r.explained - explained) < 1e-12
            assert r.identity_error < 1e-9
            if abs(z) > 1e-3:
                assert signs.setdefault(key[1], np.sign(r.whitened * z)) == np.sign(r.whitened * z)
            assert abs(abs(r.whitened) - abs(z)) < 1e-8


def test_whitening_of_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compared(queries.queries()["op11_whitening"](spark, SMALL), reference(rows))


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=6) * [5, 4, 3, 2, 1, 0.5]]) for i in range(40)]
    good += [(100 + i, good[0][1]) for i in range(30)]  # a third are copies
    good += [(None, good[1][1]), (3, good[2][1]), (3, good[2][1])]
    bad = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (203, [float("nan")] * 6), (204, [float("inf")] + [0.0] * 5), (205, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in good + bad], "vec_id long, embedding array<float>, n int, x int").repartition(4)
    compared(whitening.whitened_rows(df), reference(good))
    assert whitening.whitened_rows(df.limit(0)).count() == 0
    assert whitening.whitened_rows(df.filter("vec_id BETWEEN 200 AND 204")).count() == 0


def test_components_without_variance(spark):
    rows = [(1, [1.0, 5.0]), (2, [2.0, 5.0]), (3, [4.0, 5.0])]
    found = whitening.whitened_rows(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    second = [r for r in found if r.component == 2]
    assert len(found) == 6 and all(r.whitened is None and r.explained == 0 for r in second)
    assert all(r.explained == 1 and r.identity_error < 1e-12 for r in found if r.component == 1)
    alone = whitening.whitened_rows(spark.createDataFrame(rows[:1], "vec_id long, embedding array<float>")).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(0, None, None, None)] * 2


def test_deviations_beyond_a_long_are_null_and_below_it_exact(spark):
    rows = [(1, [2.0**40]), (2, [0.0]), (3, [2.0**21])]
    found = whitening.whitened_rows(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x, s = {1: 2**48, 2: 0, 3: 2**29}, 2**48 + 2**29
    want = {i: (3 * v - s) ** 2 for i, v in x.items()}
    assert {r.vec_id: r.deviation for r in found} == {i: d if d < 2**63 else None for i, d in want.items()}


def orthonormal(size, seed):
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0].astype(np.longdouble)


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 60, 60),
        np.concatenate((np.full(10, 3.0), np.linspace(5, 9, 30))),
        np.concatenate((3 + 1e-9 * np.arange(8), [7, 7 + 1e-12, 9, 9])),
        np.concatenate((1 + 1e-5 * np.arange(20), 1e-8 * np.arange(1, 10))),
        np.array([1e6, 1.0, 1e-6, 0.0]),
        np.ones(5),
    ],
)
def test_eigenvectors_are_right_to_double_precision(values):
    q = orthonormal(len(values), 4)
    q = q @ (1.5 * np.eye(len(values)) - q.T @ q / 2)
    a = (q * values.astype(np.longdouble)) @ q.T
    a = ((a + a.T) / 2).astype(float)
    found, x = whitening.eigenvectors(a)
    size = np.abs(a).max() * len(values)
    assert np.abs(a @ x - x * found).max() < 4e-16 * size
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 2e-15
    assert np.abs(np.sort(found) - np.sort(values)).max() < 1e-15 * size
    assert (np.diff(found) <= 0).all()


def test_corrections_beat_float32():
    q = orthonormal(30, 9)
    values = np.linspace(1, 2, 30)[::-1]
    a = ((q * values) @ q.T).astype(float)
    a = (a + a.T) / 2
    single = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    error = lambda x: np.abs(np.abs((x.T @ q.astype(float))) - np.eye(30)).max()
    assert error(single) > 1e-7 and error(whitening.eigenvectors(a)[1]) < 1e-13


# Pieces


@pytest.mark.parametrize("plain", [False, True])
def test_ids_are_the_librarys(spark, plain, monkeypatch):
    monkeypatch.setattr(piecewise, "MEMO_PIECES", 50)  # generations change often
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = plain
    with open(BYTES, encoding="utf-8") as file:
        ours = piecewise.PiecewiseTokenizer(file.read(), plain)
    rng = np.random.default_rng(1)
    known = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F)]]
    often = list(" \n\t'srtvemdlaZ09.,\xa0\x85é<|>") + ["  ", "'s", "'ll", "<|endoftext|>", " \n"]
    texts = ["".join(rng.choice(known if n % 2 else often, 60)) for n in range(1500)] + [t or "" for _, t, _ in ODD]
    texts += ["".join(map(chr, rng.integers(0x250, 0xD800, 20))) for _ in range(200)]
    for text in texts:
        assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(ours.memo) <= 51 and len(ours.memo.old) <= 51


# Token files


def digests(rows):
    library, start, out = Tokenizer.from_file(BYTES), 0, []
    for i, text in sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_of_a_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = queries.queries()["op12_token_files"](spark, SMALL).collect()
    assert sorted(map(tuple, found)) == digests(rows)


def test_token_files_of_odd_rows(spark, odd):
    found = sorted(map(tuple, token_files.token_file_digests(odd, BYTES).collect()), key=lambda r: r[1])
    want = digests(ODD)
    # Rows of one id follow each other in an order of their own.
    assert [r[0] for r in found] == [r[0] for r in want]
    assert Counter((i, n, c) for i, _, n, c in found) == Counter((i, n, c) for i, _, n, c in want)
    assert [r[1] for r in found] == np.concatenate(([0], np.cumsum([r[2] for r in found])))[:-1].tolist()
    assert token_files.token_file_digests(odd.limit(0), BYTES).count() == 0


def test_one_id_with_all_rows_fills_several_files(spark, tmp_path):
    df = spark.range(4000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'the same text' AS text").repartition(8)
    token_files.write_tokens(df, BYTES, f"{tmp_path}/t", partitions=4)
    stored = spark.read.schema(token_files.STORED).orc(f"{tmp_path}/t")
    assert stored.select("part").distinct().count() >= 3 and stored.count() == 4000


def test_files_hold_stripes_indexes_and_bloom_filters(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "STRIPE_BYTES", 64 << 10)
    ids = list(range(0, 40_000, 2))
    df = spark.createDataFrame([(i, f"text number {i} " * 20) for i in ids], "doc_id long, text string")
    folder = f"{tmp_path}/tokens"
    token_files.write_tokens(df, BYTES, folder, partitions=2)
    files = sorted(tmp_path.rglob("*.orc"))
    assert len(files) == 2 and all(orc.ORCFile(f).nstripes > 1 for f in files)
    found = token_files.documents_of(spark, folder, [4000, 4001, 39_998])
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    assert sorted(r.doc_id for r in found.collect()) == [4000, 39_998]
    read = rows_scanned(found)
    assert 0 < read <= 4 * token_files.INDEX_ROWS < len(ids)
    # 4001 lies between stored ids: statistics don't exclude it, the Bloom filter does.
    absent = token_files.documents_of(spark, folder, [4001])
    assert absent.count() == 0 and rows_scanned(absent) == 0
    starts = {r.doc_id: r.start for r in token_files.read_tokens(spark, folder).collect()}
    assert starts[0] == 0 and sorted(starts, key=starts.get) == ids


def rows_scanned(df):
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    plan = execution.executedPlan()
    leaves = (plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getName() else plan).collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


# Alignment of tokenizers


def plain_alignments(rows):
    """By sets of common ends."""
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    strings_a = cross_tokenizers.bytes_of_byte_level(open(BYTES, encoding="utf-8").read())
    strings_b = cross_tokenizers.bytes_of_pieces(pieces)
    every, linked = [], Counter()
    for i, text, *_ in rows:
        text = text or ""
        a = library.encode(" " + text, add_special_tokens=False).ids
        b = pieces.encode(text)
        spelled = (" " + text).encode()
        if not text or b"".join(strings_a[k] for k in a) != spelled or b"".join(strings_b[k] for k in b) != spelled:
            a = b = []
        ends_a = np.cumsum([len(strings_a[k]) for k in a]).tolist()
        ends_b = {e: k for k, e in enumerate(np.cumsum([len(strings_b[k]) for k in b]).tolist())}
        links = [(x, ends_b[e]) for x, e in enumerate(ends_a) if e in ends_b]
        groups, x0, y0 = [], 0, 0
        for x, y in links:
            groups.append(",".join(map(str, a[x0 : x + 1])) + "|" + ",".join(map(str, b[y0 : y + 1])))
            x0, y0 = x + 1, y + 1
        pairs = [(a[x], b[y]) for x, y in links]
        linked.update(pairs)
        every.append((i, len(a), len(b), ";".join(groups), pairs))
    best = {}
    for (_, y), n in linked.items():
        best[y] = max(best.get(y, 0), n)
    return [
        (
            i, n_a, n_b, len(pairs), len(pairs), sum(linked[p] == best[p[1]] for p in pairs), sum(linked[p] for p in pairs),
            hashlib.sha256(groups.encode()).hexdigest() if n_a else "",
        )
        for i, n_a, n_b, groups, pairs in every
    ]


def test_alignment_of_a_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = queries.queries()["op13_alignment"](spark, SMALL).collect()
    assert sorted(map(tuple, found)) == sorted(plain_alignments(rows))


def test_alignment_of_odd_rows(spark, odd):
    found = cross_tokenizers.alignment_digests(odd, BYTES, PIECES).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(plain_alignments(ODD), key=repr)
    assert cross_tokenizers.alignment_digests(odd.limit(0), BYTES, PIECES).count() == 0
    nothing = cross_tokenizers.alignment_digests(odd.filter("text IS NULL"), BYTES, PIECES).collect()
    assert [tuple(r)[1:] for r in nothing] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_written_groups_spell_the_ids(odd):
    for row in cross_tokenizers.aligned(odd, BYTES, PIECES).collect():
        sides = [g.split("|") for g in row.groups.split(";")] if row.groups else []
        assert [int(x) for a, _ in sides for x in a.split(",")] == row.a
        assert [int(x) for _, b in sides for x in b.split(",")] == row.b


def test_cuts_against_common_ends():
    rng = np.random.default_rng(6)
    for _ in range(400):
        last = int(rng.integers(1, 200))
        density = rng.choice([0.1, 0.5, 0.95, 1.0], 2)
        a, b = (sorted({last, *np.flatnonzero(rng.random(last) < p).tolist()} - {0}) for p in density)
        ends = []
        runs = cross_tokenizers.cut(a, b)
        for k, (i, j, n) in enumerate(runs):
            if n:
                assert a[i : i + n] == b[j : j + n]
                ends += a[i : i + n]
            else:
                x, y = runs[k + 1][:2] if k + 1 < len(runs) else (len(a), len(b))
                assert a[x - 1] == b[y - 1]
                ends.append(a[x - 1])
        assert ends == sorted(set(a) & set(b))
        # No two runs of pairs meet: each is as long as it can be.
        assert not any(one[2] and two[2] for one, two in zip(runs, runs[1:], strict=False))


def test_cuts_of_tokens_of_any_width():
    rng = np.random.default_rng(8)
    for widest in (3, 255, 256, 70_000):
        widths = rng.integers(1, widest + 1, 5000)
        widths[2500] = widest
        a, b = np.delete(widths.cumsum(), np.arange(9, 4990, 40)), np.delete(widths.cumsum(), np.arange(20, 4990, 200))
        runs = cross_tokenizers.cut(a.tolist(), b.tolist())
        ends = np.concatenate([a[i : i + n] for i, _, n in runs])
        irregular = [a[(runs[k + 1][0] if k + 1 < len(runs) else len(a)) - 1] for k, run in enumerate(runs) if not run[2]]
        assert sorted([*ends, *irregular]) == sorted(set(a.tolist()) & set(b.tolist()))


def test_a_run_takes_few_steps():
    ends = np.arange(1, 10_001)
    a, b = ends.tolist(), np.delete(ends, np.arange(9, 9990, 10)).tolist()
    steps = 0

    def count(frame, event, _):
        nonlocal steps
        if frame.f_code.co_filename != cross_tokenizers.__file__:
            return None
        steps += event == "line"
        return count

    before = sys.gettrace()
    sys.settrace(count)
    try:
        runs = cross_tokenizers.cut(a, b)
    finally:
        sys.settrace(before)
    # Eight pairs and a group of two tokens, in turn.
    assert len(runs) == 1999 and steps < 16 * len(runs)


def test_decimals_come_before_their_sign():
    table = cross_tokenizers._signed_decimals(1001)
    for place, sign in enumerate(b",|;"):
        for i in (0, 9, 10, 999, 1000):
            assert table[place * 1001 + i : place * 1001 + i + 1].tobytes().rstrip(b"\0") == b"%d%c" % (i, sign)


def test_linked_pairs_stay_below_their_bound(spark):
    with open(BYTES, encoding="utf-8") as a, open(PIECES, "rb") as b:
        pair = cross_tokenizers.Pair(a.read(), b.read())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    pairs = cross_tokenizers.pair_counts(cross_tokenizers.counted_links(docs, BYTES, PIECES)).collect()
    assert len(pairs) <= pair.most_pairs() < 1_000_000
    for row in pairs:
        x, y = pair.bytes_a[row.code >> 32], pair.bytes_b[row.code & 0xFFFFFFFF]
        assert x.endswith(y) or y.endswith(x)
