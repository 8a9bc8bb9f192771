"""A hidden Markov language model over classes of words.

Words fall into 1024 classes by their hash; the end of a text has a class of its own. A hidden
Markov model with a few states produces the classes, and each class its words with probability
(c + 1) / (N + V + 1) over the counts of the class, the last share being that of any unknown word.
The score of a text is log10 of the product over all its tokens: exact, since the class of a word
is fixed.

Baum-Welch passes read every training text in stretches of up to 256 tokens. Each task sums its
expected counts, a shuffle adds them, and the model, whose size is fixed, goes back to the tasks.
The likelihood of a whole text is a product of matrices, scaled against underflow: stretches are
multiplied side by side and then joined, so a very long text takes no more steps than a short one.

Word counts are a distributed table. The 2**18 most frequent words are handed to the tasks; all
other words of a text are joined with the table, each once for a text. Nothing is left out.

Words are told apart by 64-bit hashes. A null text is empty: one token, its end. A null doc_id is
trained on. Repeated rows are scored each and count each. An empty table gives an empty result.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustmill.llm.tables import saved, text_of

STATES, CLASSES, PASSES = 4, 1024, 2
STRETCH = 256
FREQUENT = 1 << 18
_LANES = 4096
_MASK = np.uint64(CLASSES - 1)
END = xxhash.xxh64_intdigest(b" ")  # no word has a space


def held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(7)) == 2, F.lit(False))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the tokens of a text; the end is the last."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: folds and splits ASCII only
    out = np.empty(len(words) + 1, dtype=np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def classes_of(hashes: np.ndarray) -> np.ndarray:
    found = (hashes & _MASK).astype(np.int64)
    found[hashes == np.uint64(END)] = CLASSES
    return found


def _stretches(sequences: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of stretches, the longest first: padded symbols (step, lane), lengths, places."""
    flat = np.concatenate(sequences)
    begins, lengths, at = [], [], 0
    for s in sequences:
        starts = np.arange(0, len(s), STRETCH)
        begins.append(starts + at)
        lengths.append(np.minimum(STRETCH, len(s) - starts))
        at += len(s)
    begins, lengths = np.concatenate(begins), np.concatenate(lengths)
    order = np.argsort(-lengths, kind="stable")
    for low in range(0, len(order), _LANES):
        own = order[low : low + _LANES]
        steps = np.arange(lengths[own[0]])[:, None]
        inside = steps < lengths[own]
        symbols = flat[np.where(inside, begins[own] + steps, 0)]
        yield symbols, lengths[own], own


class Model:
    def __init__(self, first: np.ndarray, moves: np.ndarray, emits: np.ndarray):
        """Probabilities of the first state, of moves, and of classes by state."""
        self.first, self.moves, self.emits = first, moves, emits

    @staticmethod
    def start(class_counts: np.ndarray) -> Model:
        rng = np.random.default_rng(11)
        emits = (class_counts + 1.0) * rng.uniform(0.5, 1.5, (STATES, CLASSES + 1))
        moves = np.full((STATES, STATES), 0.1 / (STATES - 1)) + np.eye(STATES) * (0.9 - 0.1 / (STATES - 1))
        return Model(np.full(STATES, 1 / STATES), moves, emits / emits.sum(axis=1, keepdims=True))

    def expected_counts(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Baum-Welch counts: first states, moves, emissions, in one vector."""
        first, moves = np.zeros(STATES), np.zeros((STATES, STATES))
        emits = np.zeros((STATES, CLASSES + 1))
        emission = np.ascontiguousarray(self.emits.T)
        for symbols, lengths, _ in _stretches(sequences):
            steps, lanes = symbols.shape
            live = np.searchsorted(-lengths, -np.arange(steps), "left")  # lanes longer than each step
            forward = np.zeros((steps, lanes, STATES))
            scale = np.ones((steps, lanes))
            state = np.broadcast_to(self.first, (lanes, STATES))
            for t in range(steps):
                k = live[t]
                state = (state[:k] if t == 0 else state[:k] @ self.moves) * emission[symbols[t, :k]]
                scale[t, :k] = state.sum(axis=1)
                state = state / scale[t, :k, None]
                forward[t, :k] = state
            weights = np.zeros((steps, lanes, STATES))
            back = np.ones((lanes, STATES))
            for t in range(steps - 1, -1, -1):
                k = live[t]
                weights[t, :k] = forward[t, :k] * back[:k]
                if t:
                    arriving = emission[symbols[t, :k]] * back[:k] / scale[t, :k, None]
                    moves += self.moves * (forward[t - 1, :k].T @ arriving)
                    back[:k] = arriving @ self.moves.T
            first += weights[0].sum(axis=0)
            for s in range(STATES):
                emits[s] += np.bincount(symbols.ravel(), weights[:, :, s].ravel(), CLASSES + 1)
        return np.concatenate([first, moves.ravel(), emits.ravel()])

    @staticmethod
    def from_counts(counts: np.ndarray) -> Model:
        first = counts[:STATES] + 0.1
        moves = counts[STATES : STATES + STATES**2].reshape(STATES, STATES) + 0.1
        emits = counts[STATES + STATES**2 :].reshape(STATES, CLASSES + 1) + 0.1
        return Model(first / first.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(1, keepdims=True))

    def log10_likelihoods(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Of each whole sequence of classes, by the scaled forward recursion."""
        emission = np.ascontiguousarray(self.emits.T)
        pieces = sum(-(-len(s) // STRETCH) for s in sequences)
        products, logs = np.zeros((pieces, STATES, STATES)), np.zeros(pieces)
        counts = np.array([-(-len(s) // STRETCH) for s in sequences])
        place = np.concatenate(([0], np.cumsum(counts)[:-1]))
        opening = np.zeros(pieces, dtype=bool)
        opening[place] = True
        for symbols, lengths, own in _stretches(sequences):
            steps, lanes = symbols.shape
            live = np.searchsorted(-lengths, -np.arange(steps), "left")
            product = np.broadcast_to(np.eye(STATES), (lanes, STATES, STATES)).copy()
            log = np.zeros(lanes)
            for t in range(steps):
                k = live[t]
                moved = (product[:k].reshape(-1, STATES) @ self.moves).reshape(k, STATES, STATES)
                if t == 0:  # no move leads to the first token of a text
                    moved[opening[own]] = np.eye(STATES)
                moved *= emission[symbols[t, :k]][:, None, :]
                if t % 16 == 15 or t == steps - 1:
                    size = moved.sum(axis=(1, 2))
                    moved /= size[:, None, None]
                    log[:k] += np.log10(size)
                product[:k] = moved
            products[own], logs[own] = product, log
        order = np.argsort(-counts, kind="stable")
        state = np.broadcast_to(self.first, (len(sequences), STATES)).copy()
        out = np.zeros(len(sequences))
        for t in range(counts.max(initial=0)):
            own = order[: np.searchsorted(-counts[order], -t, "left")]
            state[own] = np.einsum("ls,lsr->lr", state[own], products[place[own] + t])
            size = state[own].sum(axis=1)
            state[own] /= size[:, None]
            out[own] += np.log10(size) + logs[place[own] + t]
        return out


def _texts(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))


def _groups(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and token hashes of a batch, about ``most`` tokens at a time."""
    ids, hashes, size = [], [], 0
    for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        ids.append(key)
        hashes.append(word_hashes(value.as_py()))
        size += len(hashes[-1])
        if size > most:
            yield ids, hashes
            ids, hashes, size = [], [], 0
    if ids:
        yield ids, hashes


def word_counts(training: DataFrame) -> DataFrame:
    """``h, c``: occurrences of every token in the training texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, hashes in _groups(batch, 1 << 22):
                found, counts = np.unique(np.concatenate(hashes), return_counts=True)
                yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], ["h", "c"])

    return _texts(training).mapInArrow(work, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))


def _class_column(h: Column) -> Column:
    end = int(np.uint64(END).view(np.int64))
    return F.when(h == end, CLASSES).otherwise(h.bitwiseAND(F.lit(CLASSES - 1)))


def train(training: DataFrame, class_counts: np.ndarray) -> Model:
    model = Model.start(class_counts)
    for _ in range(PASSES):
        shared = training.sparkSession.sparkContext.broadcast(model)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for _, hashes in _groups(batch):
                    counts = shared.value.expected_counts([classes_of(h) for h in hashes])
                    total = counts if total is None else total + counts
            if total is not None:
                yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

        sums = _texts(training).mapInArrow(work, "place bigint, value double").groupBy("place").agg(F.sum("value"))
        counts = np.zeros(STATES + STATES**2 + STATES * (CLASSES + 1))
        for place, value in sums.collect():
            counts[place] = value
        model = Model.from_counts(counts)
    return model


SCORES = (
    "doc_id bigint, n_tokens bigint, known bigint, base double, words double, classes double, "
    "h array<bigint>, tf array<int>"
)


def scores(df: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    training = df.filter(~held_out(F.col("doc_id")))
    counts = saved(word_counts(training))
    by_class = counts.groupBy(_class_column(F.col("h")).alias("class")).agg(
        F.sum("c").alias("tokens"), F.count("*").alias("types")
    )
    tokens, types = np.zeros(CLASSES + 1, dtype=np.int64), np.zeros(CLASSES + 1, dtype=np.int64)
    for row in by_class.collect():
        tokens[row["class"]], types[row["class"]] = row["tokens"], row["types"]
    whole = int(tokens.sum() + types.sum() + 1)
    share = np.log10(tokens + types + 1.0)  # denominators, as logarithms
    share[CLASSES] = 0.0  # the end is all of its class
    model = train(training, tokens)
    frequent = counts.orderBy(F.desc("c"), "h").limit(FREQUENT).toArrow()
    order = np.argsort(frequent["h"].to_numpy().view(np.uint64))
    head = (frequent["h"].to_numpy().view(np.uint64)[order], frequent["c"].to_numpy()[order])
    shared = df.sparkSession.sparkContext.broadcast((model, *head, share, np.log10(whole)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, head, often, share, whole = shared.value
        for batch in batches:
            for ids, hashes in _groups(batch):
                sequences = [classes_of(h) for h in hashes]
                classes = model.log10_likelihoods(sequences)
                known, base, words, rare, times = [], [], [], [], []
                for h in hashes:
                    found, tf = np.unique(h, return_counts=True)
                    place = np.searchsorted(head, found)
                    place[place == len(head)] = 0
                    met = head[place] == found if len(head) else np.zeros(len(found), dtype=bool)
                    log = np.log10(often[place[met]] + 1.0)
                    end = found[met] == np.uint64(END)
                    known.append(int(tf[met].sum()))
                    base.append(float((tf[met] * (log - whole)).sum()))
                    words.append(float((tf[met] * np.where(end, 0.0, log - share[classes_of(found[met])])).sum()))
                    rare.append(found[~met].view(np.int64))
                    times.append(tf[~met].astype(np.int32))
                yield pa.record_batch(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([len(h) for h in hashes], pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(base, pa.float64()),
                        pa.array(words, pa.float64()),
                        pa.array(classes, pa.float64()),
                        pa.array(rare, pa.list_(pa.int64())),
                        pa.array(times, pa.list_(pa.int32())),
                    ],
                    [f.split()[0] for f in SCORES.split(", ")],
                )

    rows = saved(_texts(df).mapInArrow(work, SCORES)).withColumn("row", F.monotonically_increasing_id())
    rare = rows.select("row", F.explode(F.arrays_zip("h", "tf")).alias("x")).select("row", "x.h", "x.tf")
    denominators = F.lit(share.tolist())
    c = F.coalesce("c", F.lit(0))
    log = F.log10(c + 1.0)
    of_class = F.element_at(denominators, _class_column(F.col("h")).cast("int") + 1)
    word = F.when(_class_column(F.col("h")) == CLASSES, 0.0).otherwise(log - of_class)
    joined = rare.join(counts, "h", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("more_known"),
        F.sum(F.col("tf") * (log - float(np.log10(whole)))).alias("more_base"),
        F.sum(F.col("tf") * word).alias("more_words"),
    )
    zero = F.lit(0)
    return rows.join(joined, "row", "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(int(tokens.sum())).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("classes") + F.col("words") + F.coalesce("more_words", zero)).alias("score"),
    )
