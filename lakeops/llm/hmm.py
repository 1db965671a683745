"""A hidden Markov language model trained by Baum-Welch over partitions (operator 7).

All training words are counted. The most frequent ones are symbols of the latent model; any other
word is the symbol "rare", followed by a choice among the rare words by their add-one counts, so no
word is left out of a likelihood. Each iteration of Baum-Welch runs forward and backward over the
training documents of a partition, in segments of bounded length, and returns expected counts;
these are added up by state and symbol. Scores come from the scaled forward recursion over whole
documents, which is exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import crc_remainder, plain_words
from lakeops.session import written

END = "\n"  # no word holds a blank
STATES = 8
SYMBOLS = 32_000  # frequent words with emissions of their own; fits 16 bits with rare and end
COUNTED = 200_000  # frequent words whose counts every task holds; others are joined
SEGMENT = 1_024
CELLS = 1 << 19
SMOOTHING = 20.0


def _word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``count`` over training documents, the end among the words."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(plain_words(text))
                counts[END] += 1
            if len(counts) > 300_000:
                yield table(counts)
                counts = Counter()
        yield table(counts)

    def table(counts: Counter) -> pa.RecordBatch:
        words, times = pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())
        return pa.RecordBatch.from_arrays([words, times], names=["word", "times"])

    training = docs.filter(~F.col("held_out")).select("text")
    partial = training.mapInArrow(counted, "word string, times long")
    return written(partial.groupBy("word").agg(F.sum("times").alias("times")), "lm-counts")


def _frequent(counts: DataFrame, most: int) -> dict[str, int]:
    """At most ``most`` words, all those above some count; the same ones whatever the partitions."""
    levels = counts.groupBy("times").agg(F.count("*").alias("words")).filter("times > 1")
    top = levels.orderBy(F.desc("times")).limit(most).collect()
    least, taken = None, 0
    for row in top:
        taken += row["words"]
        if taken > most:
            break
        least = row["times"]
    if least is None:
        rows = counts.orderBy(F.desc("times"), "word").limit(min(most, 1_000)).collect()
        return {r["word"]: r["times"] for r in rows}
    rows = counts.filter(F.col("times") >= least).toPandas().sort_values(["times", "word"], ascending=[False, True])
    return dict(zip(rows["word"], rows["times"].tolist()))


class Model:
    """Start, transition and emission probabilities; symbols are words, then rare, then end."""

    def __init__(self, start: np.ndarray, moves: np.ndarray, emits: np.ndarray):
        self.start, self.moves, self.emits = start, moves, emits

    @staticmethod
    def initial(unigram: np.ndarray, states: int, seed: int = 7) -> "Model":
        random = np.random.default_rng(seed)
        emits = unigram * random.gamma(1.0, 1.0, (states, len(unigram)))
        emits = 0.8 * emits / emits.sum(1, keepdims=True) + 0.2 * unigram
        moves = np.full((states, states), 0.05 / states) + 0.95 * np.eye(states)
        return Model(np.full(states, 1 / states), moves, emits)

    @staticmethod
    def estimated(starts: np.ndarray, moves: np.ndarray, emits: np.ndarray, unigram: np.ndarray) -> "Model":
        """From expected counts, smoothed towards even starts and moves and the unigram emissions."""
        start = (starts + 1) / (starts + 1).sum()
        moves = (moves + 0.1) / (moves + 0.1).sum(1, keepdims=True)
        emits = (emits + SMOOTHING * unigram) / (emits.sum(1, keepdims=True) + SMOOTHING)
        return Model(start, moves, emits)


def batches_of(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of sequences of similar length, ``CELLS`` symbols at most together (one at least)."""
    order = np.argsort(lengths, kind="stable")
    first = 0
    while first < len(order):
        after = first + 1
        while after < len(order) and (after + 1 - first) * lengths[order[after]] <= CELLS:
            after += 1
        yield order[first:after][::-1]
        first = after


def forward_log10(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of each sequence; only the current state vectors are held."""
    result = np.zeros(len(sequences))
    lengths = np.array([len(s) for s in sequences])
    emits = np.ascontiguousarray(model.emits.T)
    for chosen in batches_of(lengths):
        sizes = lengths[chosen]
        symbols = np.zeros((sizes.max(), len(chosen)), np.int64)
        for column, number in enumerate(chosen):
            symbols[: sizes[column], column] = sequences[number]
        total = np.zeros(len(chosen))
        active = np.searchsorted(-sizes, -np.arange(len(symbols)), "left")
        state = np.broadcast_to(model.start, (len(chosen), len(model.start)))
        for t, running in enumerate(active):
            state = (state[:running] if t == 0 else state[:running] @ model.moves) * emits[symbols[t, :running]]
            scale = state.sum(1)
            total[:running] += np.log10(scale)
            state = state / scale[:, None]
        result[chosen] = total
    return result


def expected_counts(model: Model, sequences: list[np.ndarray], starts, moves, emits) -> None:
    """Add the expected starts, moves and emissions of the sequences to the given sums."""
    lengths = np.array([len(s) for s in sequences])
    by_symbol = np.ascontiguousarray(model.emits.T)
    for chosen in batches_of(lengths):
        sizes = lengths[chosen]
        steps, count, states = sizes.max(), len(chosen), len(model.start)
        symbols = np.zeros((steps, count), np.int64)
        for column, number in enumerate(chosen):
            symbols[: sizes[column], column] = sequences[number]
        active = np.searchsorted(-sizes, -np.arange(steps), "left")
        alpha = np.zeros((steps, count, states))
        scales = np.ones((steps, count))
        for t, running in enumerate(active):
            before = model.start if t == 0 else alpha[t - 1, :running] @ model.moves
            state = before * by_symbol[symbols[t, :running]]
            scales[t, :running] = state.sum(1)
            alpha[t, :running] = state / scales[t, :running, None]
        beta = np.ones((count, states))
        for t in range(steps - 1, -1, -1):
            running = active[t]
            posterior = alpha[t, :running] * beta[:running]
            if t:
                seen = by_symbol[symbols[t, :running]] * beta[:running] / scales[t, :running, None]
                moves += (alpha[t - 1, :running].T @ seen) * model.moves
                beta[:running] = seen @ model.moves.T
            else:
                starts += posterior.sum(0)
            alpha[t, :running] = posterior
        flat = symbols.ravel()
        for state in range(states):
            emits[state] += np.bincount(flat, alpha[:, :, state].ravel(), emits.shape[1])


def _segments(encoded: np.ndarray) -> list[np.ndarray]:
    return [encoded[i : i + SEGMENT] for i in range(0, len(encoded), SEGMENT)]


def train(encoded: DataFrame, unigram: np.ndarray, states: int, iterations: int) -> Model:
    """Baum-Welch over ``symbols`` (16-bit numbers) of the rows that are not held out."""
    spark = encoded.sparkSession
    model = Model.initial(unigram, states)
    width = len(unigram)
    training = encoded.filter(~F.col("held_out")).select("symbols")
    for _ in range(iterations):
        known = spark.sparkContext.broadcast(model)

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current = known.value
            starts, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((states, width))
            for batch in batches:
                sequences = [s for b in batch.column("symbols").to_pylist() for s in _segments(np.frombuffer(b, "<u2"))]
                expected_counts(current, sequences, starts, moves, emits)
            # Symbols first, then a row for each state's moves, then the starts.
            rows = np.concatenate((emits.T, moves, starts[None, :]))
            kept = np.flatnonzero(rows.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept), *(pa.array(rows[kept, k]) for k in range(states))],
                names=["item", *(f"s{k}" for k in range(states))],
            )

        schema = "item long, " + ", ".join(f"s{k} double" for k in range(states))
        sums = (
            training.mapInArrow(counted, schema)
            .groupBy("item")
            .agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(states)))
            .toPandas()
        )
        known.unpersist()
        rows = np.zeros((width + states + 1, states))
        rows[sums["item"].to_numpy()] = sums.drop(columns="item").to_numpy()
        model = Model.estimated(rows[-1], rows[width:-1], rows[:width].T, unigram)
    return model


def score_documents(docs: DataFrame, states: int = STATES, iterations: int = 4) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Words are runs between blanks with A to Z lowered, then one end. Documents whose crc32 of the id
    modulo 7 is 2 are held out of counts and training; a missing id is not. A missing or empty text
    is the end alone. Without any training document all counts are 0 and the latent model stays as
    it began. Rows that repeat are scored one by one. Other columns are not read.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (crc_remainder("doc_id", 7) == 2).alias("held_out"),
        "text",
    )
    counts = _word_counts(narrow)
    totals = counts.agg(F.sum("times"), F.count("*")).first()
    n, v = totals[0] or 0, totals[1]
    frequent = _frequent(counts, COUNTED)
    names = [w for w in frequent if w != END][:SYMBOLS]
    rare, end, width = len(names), len(names) + 1, len(names) + 2
    in_symbols = sum(frequent[w] for w in names)
    rare_tokens = n - in_symbols - frequent.get(END, 0)
    rare_words = v - len(names) - (n > 0)
    unigram = np.array([*(frequent[w] for w in names), rare_tokens, frequent.get(END, 0)], float) + 1
    unigram /= unigram.sum()
    # log10 of (count + 1) over the sum of the same for the rare words and one unseen word.
    rare_total = math.log10(rare_tokens + rare_words + 1)
    base_total = math.log10(n + v + 1)
    table = spark.sparkContext.broadcast(({w: i for i, w in enumerate(names)}, frequent))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, known = table.value
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                words = plain_words(text)
                symbols = np.fromiter((numbers.get(w, rare) for w in words), "<u2", len(words))
                times = Counter(words)
                times[END] += 1
                top, asked = {}, {}
                for w, c in times.items():
                    (top if w in known else asked)[w] = c
                logs = {w: c * math.log10(known[w] + 1) for w, c in top.items()}
                rows.append(
                    (
                        np.append(symbols, np.uint16(end)).astype("<u2").tobytes(),
                        len(words) + 1,
                        sum(top.values()),
                        math.fsum(logs.values()),
                        math.fsum(x for w, x in logs.items() if w not in numbers and w != END),
                        int(np.count_nonzero(symbols == rare)),
                        list(asked),
                        list(asked.values()),
                    )
                )
            columns = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
            kinds += [pa.list_(pa.string()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    batch.column("row"),
                    *(pa.array(c, kind) for c, kind in zip(columns, kinds)),
                ],
                names=[c.split(" ")[0] for c in schema.split(", ")],
            )

    schema = (
        "doc_id long, held_out boolean, row long, symbols binary, n_tokens long, n_top long, top_log double, "
        "top_rare double, n_rare long, asked array<string>, asked_times array<long>"
    )
    rows = narrow.withColumn("row", F.xxhash64("doc_id", "text"))
    stored = written(rows.mapInArrow(encoded, schema), "lm-encoded")
    # Words beyond the table meet their counts in one join; rows that repeat ask once.
    asked = (
        stored.dropDuplicates(["row"])
        .select("row", F.explode(F.arrays_zip("asked", "asked_times")).alias("__pair"))
        .select("row", F.col("__pair.asked").alias("word"), F.col("__pair.asked_times").alias("c"))
    )
    answered = (
        asked.join(counts, "word")
        .groupBy("row")
        .agg(F.sum("c").alias("__known"), F.sum(F.col("c") * F.log10(F.col("times") + 1)).alias("__log"))
    )
    model = spark.sparkContext.broadcast(train(stored, unigram, states, iterations))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequences = [np.frombuffer(b, "<u2") for b in batch.column("symbols").to_pylist()]
            latent = forward_log10(model.value, sequences) if sequences else np.empty(0)
            kept = [batch.column(c) for c in plain]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(latent)], names=[*plain, "latent"])

    plain = ["doc_id", "held_out", "row", "n_tokens", "n_top", "top_log", "top_rare", "n_rare"]
    kinds = dict(stored.dtypes)
    latent = stored.select(*plain, "symbols").mapInArrow(
        scored, ", ".join(f"{c} {kinds[c]}" for c in plain) + ", latent double"
    )
    found = F.coalesce("__log", F.lit(0.0))
    return latent.join(answered, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_top") + F.coalesce("__known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("top_log") + found - F.col("n_tokens") * F.lit(base_total)).alias("base_score"),
        (F.col("latent") + F.col("top_rare") + found - F.col("n_rare") * F.lit(rare_total)).alias("score"),
    )
