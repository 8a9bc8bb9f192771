"""Secret scans by a battery of randomness tests, in DataFrame operations only.

Base spans are the matches of three patterns. The method adds ``random`` spans: tokens of 20 and
more characters whose characters tell an encoding (hex, base32, letters and digits, base64) and
that look drawn from it evenly. The battery asks for evenness of the alphabet (chi-squared), for
as many runs above and below its middle as chance gives, and for no correlation of neighbours; a
token that any of these refuses is no secret.

False discoveries are kept to one in a hundred. The null hypothesis is a token made as text is. For
each encoding it is learned from all tokens without one, cut down to the encoding's alphabet: how
often equal characters meet, on which chi-squared depends, and mean and spread of the statistics of
all three tests. A token's statistics, each weighted by how far text is from even drawing, add up
to one p-value (Stouffer), and the Benjamini-Hochberg bound is set for each class of lengths apart,
from counts of p-values over all rows: short tokens, which
tell little, don't weaken the bound of long ones. Counts are kept by length class and step of
p-value, so what reaches the driver has a fixed bound.

A null or empty text has no spans. Spans count code points, end exclusive. Rows are judged one by
one, whatever repeats; only the counts depend on all of them. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustmill.llm.tables import let, numbers, saved, text_of, total

# The base patterns and the shortest that count, of a group or the match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = {"assign": (ASSIGN, 2, 12), "access": (ACCESS, 0, 18), "hex": (HEX, 0, 16)}

KINDS = [*BASE, "random"]
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
FALSE_DISCOVERIES = 0.01
#: Standard deviations beyond which a test of the battery refuses a token.
REFUSAL = 3.0
STEPS = 10  # of p-values, for each power of ten
MOST = 30 * STEPS
MARK = "[SECRET]"
# Before any text is seen, as in written languages: equal ones of 1000 pairs and the spread of their
# statistic, for so many tokens. Of the hexadecimal letters, e alone makes up nearly half.
PRIOR = {"hex": (250, 1.6), "base32": (66, 1.25), "alnum": (66, 1.25), "base64": (66, 1.25)}
PRIOR_TOKENS = 30
LEAST_PLAIN = 8  # characters of the alphabet that a token must have to be learned from

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Alphabet by encoding, with the test that infers it; the first that fits is taken.
ENCODINGS = {
    "hex": ("0123456789abcdef", r"^(?=.*[0-9])(?=.*[A-Fa-f])([0-9a-f]+|[0-9A-F]+)$"),
    "base32": (_LETTERS + "234567", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$"),
    "alnum": ("0123456789" + _LETTERS.lower(), r"^(?=.*[0-9])(?=.*[A-Za-z])([a-z0-9]+|[A-Z0-9]+)$"),
    "base64": (_LETTERS + _LETTERS.lower() + "0123456789+/-_", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+$"),
}


@dataclass(frozen=True)
class Text:
    """How often two characters of text agree, and mean and spread of each statistic."""

    agree: float
    pairs: tuple[float, float]
    runs: tuple[float, float]
    serial: tuple[float, float]


@dataclass(frozen=True)
class Bounds:
    """What is learned: text by encoding, and steps of p by length class."""

    text: dict[str, Text]
    least: dict[int, int]


def _starts(pieces: Column, matches: Column) -> Column:
    """Where each match begins: piece 1, match 1, piece 2 and so on make up the text."""
    size = 512

    def of(widths: Column) -> Column:
        blocks = F.transform(
            numbers(F.lit(0), F.ceil(F.size(widths) / size).cast("int") - 1), lambda b: total(F.slice(widths, b * size + 1, size))
        )

        def start(piece: Column, i: Column, blocks: Column) -> Column:
            block = F.floor(i / size).cast("int")
            return total(F.slice(blocks, F.lit(1), block)) + total(F.slice(widths, block * size + 1, i % size)) + F.length(piece)

        return let(blocks, lambda b: F.transform(F.slice(pieces, F.lit(1), F.size(matches)), lambda p, i: start(p, i, b)))

    return let(F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.length(p) + F.length(m)), of)


def _matches(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """``start, end, value`` of all matches whose ``group`` has ``least`` characters."""
    regex = F.lit(pattern)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    value = F.regexp_extract_all(text, regex, F.lit(group)) if group else whole
    found = let(
        F.struct(F.split(text, pattern, -1).alias("p"), whole.alias("m"), value.alias("v")),
        lambda x: F.zip_with(
            F.arrays_zip(_starts(x["p"], x["m"]).alias("s"), x["m"].alias("m")),
            x["v"],
            lambda a, v: F.struct(a["s"].alias("start"), (a["s"] + F.length(a["m"])).alias("end"), v.alias("value")),
        ),
    )
    found = F.filter(found, lambda x: F.length(x["value"]) >= least)
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def base_spans(text: Column) -> Column:
    """Struct of the spans of each base kind."""
    hexes = _matches(text, HEX.replace("+", "{16,}"))  # runs are whole either way
    return F.struct(
        _matches(text, ASSIGN, 2, 12).alias("assign"), _matches(text, ACCESS, 0, 18).alias("access"), hexes.alias("hex")
    )


def _encoding(token: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, (_, test) in reversed(ENCODINGS.items()):
        out = F.when(token.rlike(test), F.lit(name)).otherwise(out)
    return out


def _alphabet(encoding: Column) -> Column:
    out = F.lit(ENCODINGS["base64"][0])
    for name, (alphabet, _) in ENCODINGS.items():
        out = F.when(encoding == name, F.lit(alphabet)).otherwise(out)
    return out


def _equal_pairs(token: Column) -> Column:
    """Pairs of equal characters, from how many of each of the distinct ones there are."""
    distinct = F.array_distinct(F.regexp_extract_all(token, F.lit("(?s)."), F.lit(0)))
    counts = F.transform(distinct, lambda c: (F.length(token) - F.length(F.replace(token, c, F.lit("")))).cast("double"))
    return F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * (c - 1) / 2)


def _battery(token: Column, encoding: Column, pairs: Column) -> Column:
    """Standard deviations of the three tests from what even drawing from the alphabet gives."""

    def tests(x: Column) -> Column:
        # At least 2: Spark may evaluate this before a filter on the length.
        n, size, values = F.greatest(F.length(token), F.lit(2)).cast("double"), x["size"].cast("double"), x["values"]
        squares = 2 * pairs + n
        free = size - 1
        chi = F.cbrt((size * squares / n - n) / free)
        z_even = (chi - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))  # Wilson and Hilferty
        rest = F.greatest(F.size(values) - 1, F.lit(0))
        following = F.zip_with(F.slice(values, F.lit(1), rest), F.slice(values, F.lit(2), rest), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        above = F.aggregate(values, F.lit(0.0), lambda a, v: a + F.when(v * 2 > size, 1.0).otherwise(0.0))
        mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / n

        def moments(m: Column) -> Column:
            """One pass each over the values and over the neighbours, with ``m`` at hand."""
            away = lambda v: v - m["mean"]
            beside = F.aggregate(
                following,
                F.struct(F.lit(0.0).alias("changes"), F.lit(0.0).alias("products")),
                lambda a, p: F.struct(
                    (a["changes"] + F.when((p["a"] * 2 > size) != (p["b"] * 2 > size), 1.0).otherwise(0.0)).alias("changes"),
                    (a["products"] + away(p["a"]) * away(p["b"])).alias("products"),
                ),
            )
            around = F.aggregate(values, F.lit(0.0), lambda a, v: a + away(v) * away(v))
            expected = 2 * m["above"] * (n - m["above"]) / n
            return F.struct(beside.alias("beside"), around.alias("around"), expected.alias("expected"))

        def statistics(m: Column) -> Column:
            expected, around = m["expected"], m["around"]
            spread = F.sqrt(expected * (expected - 1) / (n - 1))
            z_runs = F.when(spread > 0, (m["beside"]["changes"] - expected) / spread).otherwise(99.0)
            z_serial = F.when(around > 0, (m["beside"]["products"] / around + 1 / n) * F.sqrt(n)).otherwise(99.0)
            return F.struct(z_even.alias("even"), z_runs.alias("runs"), z_serial.alias("serial"))

        return let(let(F.struct(mean.alias("mean"), above.alias("above")), moments), statistics)

    folded = F.when(encoding.isin("hex", "alnum"), F.lower(token)).otherwise(token)
    alphabet = _alphabet(encoding)
    values = F.transform(F.regexp_extract_all(folded, F.lit("(?s)."), F.lit(0)), lambda c: F.instr(alphabet, c))
    return let(F.struct(F.length(alphabet).alias("size"), values.alias("values")), tests)


def _accepted(tests: Column) -> Column:
    return (tests["even"] < REFUSAL) & (F.abs(tests["runs"]) < REFUSAL) & (F.abs(tests["serial"]) < REFUSAL)


def _candidates(text: Column, base: Column) -> Column:
    """Tokens outside the base spans, with what the tests need."""

    def outside(x: Column) -> Column:
        return ~F.exists(
            F.concat(base["assign"], base["access"], base["hex"]), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])
        )

    def measured(x: Column) -> Column:
        token = x["value"]
        return let(
            F.struct(_encoding(token).alias("encoding"), _equal_pairs(token).alias("pairs")),
            lambda y: let(
                F.when(y["encoding"].isNotNull(), _battery(token, y["encoding"], y["pairs"])),
                lambda z: F.struct(
                    x["start"].alias("start"),
                    x["end"].alias("end"),
                    F.length(token).cast("double").alias("n"),
                    y["encoding"].alias("encoding"),
                    y["pairs"].alias("pairs"),
                    z["runs"].alias("runs"),
                    z["serial"].alias("serial"),
                    F.coalesce(_accepted(z), F.lit(False)).alias("even"),
                    F.when(y["encoding"].isNull(), token).alias("plain"),
                ),
            ),
        )

    return F.transform(F.filter(_matches(text, TOKEN), outside), measured)


def _length_class(n: Column) -> Column:
    return F.floor(2 * F.log2(n)).cast("int")


def _pairs_statistic(n: Column, pairs: Column, agree: Column) -> Column:
    return 2 * (F.sqrt(pairs + 0.75) - F.sqrt(n * (n - 1) / 2 * agree))


def _step(x, text: dict[str, Text]) -> Column:
    """Steps of the negative logarithm of the p-value that text is as near to even drawing as ``x``."""

    def of(learned: Text, size: int) -> Column:
        n = x["n"]
        mean, spread = learned.pairs
        drawn = F.sqrt(n * (n - 1) / 2) * (2 * (size**-0.5 - learned.agree**0.5))  # expected of even drawing
        terms = [((_pairs_statistic(n, x["pairs"], F.lit(learned.agree)) - mean) / spread, (drawn - mean) / spread)]
        for name, (mean, spread) in (("runs", learned.runs), ("serial", learned.serial)):
            terms.append(((x[name] - mean) / spread, F.lit(-mean / spread)))
        added, weight = F.lit(0.0), F.lit(0.0)
        for z, w in terms:
            added, weight = added + z * w, weight + w * w
        return F.when(weight > 0, added / F.sqrt(weight)).otherwise(0.0)

    z = F.lit(0.0)
    for name, learned in text.items():
        z = F.when(x["encoding"] == name, of(learned, len(ENCODINGS[name][0]))).otherwise(z)

    def steps(z: Column) -> Column:
        odds = 1.5976 * z + 0.07056 * z * z * z
        logarithm = F.log10(1 + F.exp(F.least(odds, F.lit(300.0))))
        return F.least(F.floor(logarithm * STEPS), F.lit(MOST)).cast("int")

    return let(z, steps)


def _scanned(df: DataFrame) -> DataFrame:
    text = text_of()
    scan = let(text, lambda t: let(base_spans(t), lambda b: F.struct(b.alias("base"), _candidates(t, b).alias("tokens"))))
    return df.withColumn("_scan", scan)


def learn_text(tokens: DataFrame) -> dict[str, Text]:
    """From tokens without an encoding (``plain``): how text of each encoding's alphabet behaves."""

    def cut(name: str) -> Column:
        folded = {"hex": F.lower, "alnum": F.lower, "base32": F.upper}.get(name, lambda c: c)(F.col("plain"))
        inside = {"hex": "0-9a-f", "base32": "A-Z2-7", "alnum": "0-9a-z", "base64": "A-Za-z0-9+/_-"}[name]
        return F.struct(F.lit(name).alias("encoding"), F.regexp_replace(folded, f"[^{inside}]", "").alias("token"))

    rows = tokens.select(F.explode(F.array(*map(cut, ENCODINGS))).alias("x")).select("x.*")
    rows = rows.filter(F.length("token") >= LEAST_PLAIN).withColumn("pairs", _equal_pairs(F.col("token")))
    rows = rows.select("encoding", F.length("token").cast("double").alias("n"), "pairs", _battery(F.col("token"), F.col("encoding"), F.col("pairs")).alias("z"))
    rows = saved(rows.filter("abs(z.runs) < 99 AND abs(z.serial) < 99").select("encoding", "n", "pairs", "z.runs", "z.serial"))
    sums = rows.groupBy("encoding").agg(F.sum("pairs").alias("pairs"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("possible"))
    agree = {name: equal / 1000 for name, (equal, _) in PRIOR.items()}
    for r in sums.collect():
        agree[r["encoding"]] = (PRIOR[r["encoding"]][0] + r["pairs"]) / (1000 + r["possible"])
    expected = F.lit(0.0)
    for name, share in agree.items():
        expected = F.when(F.col("encoding") == name, F.lit(share)).otherwise(expected)
    rows = rows.select("encoding", _pairs_statistic(F.col("n"), F.col("pairs"), expected).alias("pairs"), "runs", "serial")
    names = ("pairs", "runs", "serial")
    moments = rows.groupBy("encoding").agg(
        F.count("*").alias("count"),
        *[F.sum(c).alias(c) for c in names],
        *[F.sum(F.col(c) * F.col(c)).alias(f"{c}_2") for c in names],
    )
    found = {r["encoding"]: r for r in moments.collect()}
    out = {}
    for name, (_, spread) in PRIOR.items():
        r, both = found.get(name), []
        for c in names:
            count = PRIOR_TOKENS + (r["count"] if r else 0)
            mean = (r[c] if r else 0.0) / count
            square = (PRIOR_TOKENS * (spread if c == "pairs" else 1.0) ** 2 + (r[f"{c}_2"] if r else 0.0)) / count
            both.append((mean, max(square - mean * mean, 0.25) ** 0.5))
        out[name] = Text(agree[name], *both)
    return out


def learn_bounds(df: DataFrame) -> Bounds:
    """From all rows: text by encoding, and the Benjamini-Hochberg step of each length class."""
    tokens = _scanned(df.select("text")).select(F.explode("_scan.tokens").alias("t"))
    tokens = saved(tokens.select("t.n", "t.encoding", "t.pairs", "t.runs", "t.serial", "t.even", "t.plain"))
    text = learn_text(tokens.filter("plain IS NOT NULL").select("plain"))
    row = {c: F.col(c) for c in ("n", "encoding", "pairs", "runs", "serial")}
    steps = F.when(F.col("even"), _step(row, text)).otherwise(0)
    counts = (
        tokens.filter("encoding IS NOT NULL")
        .groupBy(_length_class(F.col("n")).alias("length"), steps.alias("step"))
        .count()
        .collect()  # at most a few dozen length classes of MOST + 1 steps
    )
    least = {}
    for length in sorted({r["length"] for r in counts}):
        own = sorted(((r["step"], r["count"]) for r in counts if r["length"] == length), reverse=True)
        tested, smaller = sum(n for _, n in own), 0
        for step, n in own:
            smaller += n
            # All of this step have p-values up to 10 ** (-step / STEPS).
            if tested * 10 ** (-step / STEPS) <= FALSE_DISCOVERIES * smaller:
                least[length] = step
    return Bounds(text, least)


def _discovered(x: Column, bounds: Bounds) -> Column:
    least = F.lit(MOST + 1)
    for length, step in bounds.least.items():
        least = F.when(_length_class(x["n"]) == length, F.lit(step)).otherwise(least)
    return x["even"] & (_step(x, bounds.text) >= least)


def _ranked(spans: Column, rank: int) -> Column:
    return F.transform(
        spans, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"))
    )


def with_spans(df: DataFrame, bounds: Bounds | None = None) -> DataFrame:
    """The rows of ``df`` with ``_spans``: kind, start and end of all secrets by start, then kind."""
    if bounds is None:
        bounds = learn_bounds(df)

    def of(scan: Column) -> Column:
        random = F.filter(scan["tokens"], lambda x: _discovered(x, bounds))
        kinds = [*(scan["base"][kind] for kind in BASE), random]
        return F.array_sort(F.concat(*[_ranked(spans, rank) for rank, spans in enumerate(kinds)]))

    spans = F.transform(
        let(F.col("_scan"), of),
        lambda x: F.struct(
            F.element_at(F.array(*map(F.lit, KINDS)), x["rank"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end")
        ),
    )
    return _scanned(df).withColumn("_spans", spans).drop("_scan")


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secret_digests(df: DataFrame) -> DataFrame:
    found = with_spans(df.select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("_spans", lambda x: x["kind"] == kind)).cast("bigint")

    base = F.filter("_spans", lambda x: x["kind"] != "random")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("_spans")).alias("spans"),
        count("random").alias("n_random"),
    )


def redacted(df: DataFrame) -> DataFrame:
    """The rows of ``df`` with every secret replaced by ``MARK``; ``n_chars`` follows, if there is one.

    The columns of ``df`` travel as one, so that their names clash with none used here.
    """
    found = with_spans(df.select(F.struct("*").alias("row"), "text"))

    def cut(spans: Column) -> Column:
        # Spans are in order; one that begins within an earlier one only lengthens it.
        def reach(i: Column) -> Column:
            return F.coalesce(F.array_max(F.transform(F.slice(spans, F.lit(1), i), lambda x: x["end"])), F.lit(0).cast("bigint"))

        parts = F.transform(
            spans,
            lambda x, i: let(
                reach(i),
                lambda past: F.when(
                    x["start"] >= past,
                    F.concat(F.substring(F.col("text"), (past + 1).cast("int"), (x["start"] - past).cast("int")), F.lit(MARK)),
                ).otherwise(F.lit("")),
            ),
        )
        rest = F.substring(F.col("text"), (reach(F.size(spans)) + 1).cast("int"), F.length("text"))
        return F.concat(F.array_join(parts, ""), rest)

    text = F.when(F.size("_spans") == 0, F.col("text")).otherwise(let(F.col("_spans"), cut))
    changed = found.select("row", text.alias("text"), (F.size("_spans") > 0).alias("changed"))

    def column(name: str) -> Column:
        old = F.col("row").getField(name)
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            new = F.length("text").cast(df.schema[name].dataType)
            return F.when(F.col("changed"), new).otherwise(old).alias(name)
        return old.alias(name)

    return changed.select(*map(column, df.columns))
