"""Toxicity by a convolutional text classifier, trained here in numpy.

Words are runs of letters. A word's embedding is the sum of three hashed ones, of the word and of its first four and
six bytes, so that rare inflections share what their stem has learned. Filters of several widths slide over them; each filter's greatest answer in the text
goes into a logistic output. A text of any length is scored block by block with a running maximum.

Thresholds are calibrated by language: the language is guessed from the hashed words of the text alone (word
frequencies of the training rows), and each language has its own cut, found on a part of the training rows that the
filters have not seen (with too few of them, the cut of all languages, or even odds). Scores are shifted so that the cut of every language is at `threshold`.

Every labelled text takes part, whole: word frequencies and cuts are counts over all rows, the cuts' in bins of logits. The
filters are trained in rounds. Rows are dealt into shards by a hash of their id; in each round a task goes once through
every row of its shard, and the shards' weights are averaged, an embedding's over the shards that have moved it. So a task holds
one Arrow batch, and the driver as many models as there are shards, `SHARDS` at most.

Defined results: a null or empty text has the score of a text without words; an empty table gives an empty result; with
no labelled row, or only one label, every score is the share of toxic rows (0 without rows); repeated rows are scored
alike; labels that repeat a document count once, the greater label winning.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerhouse.llm.common import by_bytes, discard, in_bloom, materialize, text_bytes, tidied, word_hashes
from brokerhouse.llm.linking import filter_of
from brokerhouse.sources.work import new_path

BUCKETS = 1 << 15
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 6
#: Words that are scored at a time.
SPAN = 1 << 17
#: Rows of each label that a cut needs; with fewer the neutral one is taken, even odds.
LEAST_FOR_A_CUT = 12
#: Rows that a shard should have, and shards at most; rows that all rounds together should pass, and rounds at least.
SHARD_ROWS, SHARDS = 1024, 32
PASSES, LEAST_ROUNDS = 36_000, 4
#: Rows that a step of training takes, and its words at most (a longer text comes alone).
STEP_ROWS, STEP_WORDS = 32, 1 << 17
#: Bins a unit of the logit, in which rows are counted for the cuts.
FINENESS = 1000
#: Empty words after each text; a filter that starts on the first one sees nothing else.
PAD = max(WIDTHS)


#: Letters are a-z, A-Z and all bytes of other alphabets.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
STEMS = (4, 6)
PARTS = 1 + len(STEMS)


@dataclass
class Model:
    embed: np.ndarray  # BUCKETS + 1 rows, the last one zero
    kernels: list[np.ndarray]  # by width: place, dimension, filter
    bias: np.ndarray
    output: np.ndarray
    intercept: float
    languages: np.ndarray  # log frequencies, BUCKETS + 1 rows, a column a language
    shifts: np.ndarray  # added to the logit, a number a language
    share: float
    trained: bool

    def scores(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and guessed language of each text, from the buckets of all words and each text's number of words."""
        raw, language = self.raw(ids, counts)
        if not self.trained:
            return np.full(len(counts), self.share), language
        return 1 / (1 + np.exp(-np.clip(raw + self.shifts[language], -30, 30))), language

    def raw(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(counts)), counts)
        # every text is followed by empty words, so no filter that starts on a word sees two texts
        padded = np.full((len(ids) + PAD * len(counts), PARTS), BUCKETS, np.int32)
        padded[np.arange(len(ids)) + PAD * owner] = ids
        begins = np.cumsum(counts + PAD) - (counts + PAD)
        idle = left_out(padded, begins)
        best = np.full((len(counts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        guess = np.zeros((len(counts), self.languages.shape[1]))
        places = np.concatenate([k.reshape(-1, FILTERS) for k in self.kernels], axis=0)
        places = places.reshape(-1, DIMENSIONS, FILTERS).transpose(1, 0, 2).reshape(DIMENSIONS, -1)
        for lo in range(0, len(padded), SPAN):
            hi = min(len(padded), lo + SPAN)
            first, last = np.searchsorted(begins, lo, side="right") - 1, np.searchsorted(begins, hi)
            cuts = np.maximum(begins[first:last], lo) - lo
            window = padded[lo : hi + PAD]
            window = np.concatenate([window, np.full((hi - lo + PAD - len(window), PARTS), BUCKETS, np.int32)])
            n, at = hi - lo, 0
            answers = sum(self.embed[window[:, k]] for k in range(PARTS)) @ places
            for w, kernel in enumerate(self.kernels):
                answer = 0
                for k in range(len(kernel)):
                    answer = answer + answers[k : n + k, at : at + FILTERS]
                    at += FILTERS
                answer[idle[lo:hi]] = -np.inf
                part = np.maximum.reduceat(answer, cuts, axis=0)
                columns = slice(w * FILTERS, (w + 1) * FILTERS)
                best[first:last, columns] = np.maximum(best[first:last, columns], part)
            guess[first:last] += np.add.reduceat(self.languages[window[:n, 1]], cuts, axis=0)
        hidden = np.maximum(best + self.bias, 0) if len(counts) else best
        return hidden @ self.output + self.intercept, guess.argmax(1) if len(counts) else np.zeros(0, np.int64)


def left_out(padded: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Rows where no filter's answer counts: empty words, as filters that start there reach into the next text.

    The first empty word of a text without words stays, for an answer from empty words alone.
    """
    out = padded[:, 0] == BUCKETS
    out[begins] = False
    return out


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all words and their stems, a row a word, and the number of words of each text."""
    *hashes, counts = word_hashes(*text_bytes(column), NOT_LETTER, STEMS)
    return np.stack([(h >> np.uint64(40)).astype(np.int32) % BUCKETS for h in hashes], axis=1), counts


DECAY = 1e-4


def gradients(
    ids: list[np.ndarray], labels: np.ndarray, weights: list[np.ndarray], intercept: float
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], float]:
    """Of the mean logistic loss, kernels and output a little decayed: touched rows of the embedding and their
    gradients, those of the kernels, bias and output, and that of the intercept. `weights` are in the same order."""
    embed, *kernels, bias, output = weights
    counts = np.array([len(own) + PAD for own in ids])
    empty = np.full((PAD, PARTS), BUCKETS, np.int32)
    spread = np.concatenate([*(y for own in ids for y in (own, empty)), empty])
    begins = np.cumsum(counts) - counts
    n = len(spread) - PAD
    idle = left_out(spread[:n], begins)
    tops = [np.full((len(ids), FILTERS), -np.inf, output.dtype) for _ in kernels]
    hits = [np.repeat(begins[:, None], FILTERS, axis=1) for _ in kernels]
    for lo in range(0, n, SPAN):
        hi = min(n, lo + SPAN)
        first, last = np.searchsorted(begins, lo, side="right") - 1, np.searchsorted(begins, hi)
        cuts = np.maximum(begins[first:last], lo) - lo
        sizes = np.diff(np.append(cuts, hi - lo))
        x = embed[spread[lo : hi + PAD]].sum(1)
        for w, kernel in enumerate(kernels):
            answer = sum(x[j : hi - lo + j] @ kernel[j] for j in range(len(kernel)))
            answer[idle[lo:hi]] = -np.inf
            top = np.maximum.reduceat(answer, cuts, axis=0)
            match = answer == np.repeat(top, sizes, axis=0)
            place = np.minimum.reduceat(np.where(match, np.arange(lo, hi)[:, None], n), cuts, axis=0)
            better = top > tops[w][first:last]
            tops[w][first:last][better], hits[w][first:last][better] = top[better], place[better]
    hidden = np.concatenate(tops, axis=1) + bias
    on = hidden > 0
    p = 1 / (1 + np.exp(-np.clip((hidden * on) @ output + intercept, -30, 30)))
    error = ((p - labels) / len(ids)).astype(output.dtype)
    g_output = (hidden * on).T @ error + DECAY * output
    g_hidden = np.outer(error, output) * on
    touched, g_kernels, g_rows = [], [], []
    for w, kernel in enumerate(kernels):
        g = g_hidden[:, w * FILTERS : (w + 1) * FILTERS]
        g_kernel = np.zeros_like(kernel)
        for j in range(len(kernel)):
            rows = hits[w] + j
            g_kernel[j] = np.einsum("bfd,bf->df", embed[spread[rows]].sum(2), g)
            touched.append(spread[rows].ravel())
            g_rows.append(np.repeat((g[:, :, None] * kernel[j].T[None]).reshape(-1, DIMENSIONS), PARTS, axis=0))
        g_kernels.append(g_kernel + DECAY * kernel)
    touched, inverse = np.unique(np.concatenate(touched), return_inverse=True)
    g_embed = np.zeros((len(touched), DIMENSIONS), output.dtype)
    np.add.at(g_embed, inverse, np.concatenate(g_rows))
    g_embed[touched == BUCKETS] = 0
    return touched, g_embed, [*g_kernels, g_hidden.sum(0), g_output], float(error.sum())


class Learner:
    """Weights as Adam on the logistic loss leaves them."""

    def __init__(self, weights: list[np.ndarray], intercept: float):
        self.weights, self.intercept = weights, intercept
        self.moments = [(np.zeros_like(x), np.zeros_like(x)) for x in weights]
        self.step = 0

    def learn(self, ids: list[np.ndarray], labels: np.ndarray) -> None:
        touched, g_embed, rest, g_intercept = gradients(ids, labels, self.weights, self.intercept)
        self.intercept -= 0.05 * g_intercept
        self.step += 1
        rate = 0.01 * np.sqrt(1 - 0.999 ** min(self.step, 4000)) / (1 - 0.9 ** min(self.step, 200))
        for k, (value, gradient, (m, v)) in enumerate(zip(self.weights, [g_embed, *rest], self.moments, strict=True)):
            rows = touched if k == 0 else slice(None)
            m[rows] = 0.9 * m[rows] + 0.1 * gradient
            v[rows] = 0.999 * v[rows] + 0.001 * gradient**2
            value[rows] -= rate * m[rows] / (np.sqrt(v[rows]) + 1e-8)


def fresh_weights(rng: np.random.Generator) -> list[np.ndarray]:
    shape = len(WIDTHS) * FILTERS
    embed = rng.normal(0, 0.3, (BUCKETS + 1, DIMENSIONS)).astype(np.float32)
    embed[BUCKETS] = 0
    kernels = [rng.normal(0, 0.4, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
    return [embed, *kernels, np.zeros(shape, np.float32), rng.normal(0.3, 0.1, shape).astype(np.float32)]


def log_frequencies(freq: np.ndarray) -> np.ndarray:
    out = np.log(freq / freq.sum(0)).astype(np.float32)
    out[BUCKETS] = 0
    return out


def steps(sizes: Iterable[int]) -> Iterator[slice]:
    """Places of the rows of each step, from the rows' numbers of words."""
    lo, k, words = 0, -1, 0
    for k, n in enumerate(sizes):
        if k > lo and (k - lo == STEP_ROWS or words + n > STEP_WORDS):
            yield slice(lo, k)
            lo, words = k, 0
        words += n
    if k >= lo:
        yield slice(lo, k + 1)


def shifts_of(counts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], number: int, threshold: float) -> np.ndarray:
    """What brings each language's cut to the threshold; `counts`: by language the logits, toxic rows and rows at each."""
    at_cut = np.log(threshold / (1 - threshold))

    def cut(raw: np.ndarray, toxic: np.ndarray, rows: np.ndarray, otherwise: float) -> float:
        enough = min(toxic.sum(), rows.sum() - toxic.sum()) >= LEAST_FOR_A_CUT
        return best_cut(raw, toxic, rows) if enough else otherwise

    none = (np.zeros(0),) * 3
    everywhere = cut(*(np.concatenate(x) for x in zip(none, *counts.values(), strict=True)), 0.0)
    return np.array([at_cut - cut(*counts.get(k, none), everywhere) for k in range(number)])


def train(
    ids: list[np.ndarray], labels: np.ndarray, languages: list[str], threshold: float, epochs: int = 12, seed: int = 7
) -> Model:
    """As `fit`, of few rows in one process; a fifth of the rows is kept back for the cuts by language."""
    rng = np.random.default_rng(seed)
    known = sorted(set(languages)) or [""]
    freq = np.ones((BUCKETS + 1, len(known)))
    for row, lang in zip(ids, languages, strict=True):
        np.add.at(freq[:, known.index(lang)], row[:, 1], 1.0)
    share = float(labels.mean()) if len(labels) else 0.0
    learner = Learner(fresh_weights(rng), 0.0)

    def model(shifts: np.ndarray) -> Model:
        embed, *kernels, bias, output = learner.weights
        return Model(embed, kernels, bias, output, learner.intercept, log_frequencies(freq), shifts, share, 0 < share < 1)

    if not 0 < share < 1:
        return model(np.zeros(len(known)))
    held = rng.random(len(ids)) < 0.2
    if len({*labels[~held].tolist()}) < 2:
        held[:] = False
    learner.intercept = float(np.log(share / (1 - share)))
    for _epoch in range(epochs):
        order = rng.permutation(np.flatnonzero(~held))
        for some in steps([len(ids[i]) for i in order]):
            learner.learn([ids[i] for i in order[some]], labels[order[some]])
    check = np.flatnonzero(held) if held.any() else np.arange(len(ids))
    raw, spoken = model(np.zeros(len(known))).raw(np.concatenate([ids[i] for i in check]), np.array([len(ids[i]) for i in check]))
    counts = {k: (raw[spoken == k], labels[check][spoken == k], np.ones((spoken == k).sum())) for k in range(len(known))}
    return model(shifts_of(counts, len(known), threshold))


def best_cut(raw: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> float:
    """The middle between the neighbouring logits that part the labels with the best F1, from the rows at each logit."""
    order = np.argsort(-raw, kind="stable")
    values, hits = raw[order], np.cumsum(toxic[order])
    f1 = 2 * hits / (np.cumsum(rows[order]) + max(toxic.sum(), 1))
    f1[:-1][values[:-1] == values[1:]] = -1
    k = int(f1.argmax())
    return float(values[k] + values[k + 1]) / 2 if k + 1 < len(values) else float(values[k]) - 1e-3


def packed_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_col: str) -> DataFrame:
    """A row for each labelled id: `_lang`, `_label`, `_hash` of the id, and `_words`, the buckets of all its words; written."""
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_label_id")
    ).agg(F.max(F.when(F.col(label_col) > 0, 1).otherwise(0)).alias("_label"))
    marked = materialize(marked.withColumn("_hash", F.xxhash64("_label_id")))
    bits = filter_of(marked, "_hash")
    light = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(id_col).alias("_hash"),
        F.coalesce(F.col(lang_col), F.lit("")).alias("_lang"),
        F.col(text_col).alias("_text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch.filter(pa.array(in_bloom(bits, batch.column("_hash").to_numpy()), pa.bool_()))
            for part in by_bytes(near, "_text"):
                flat, counts = buckets(part.column("_text"))
                ends = np.cumsum(counts).tolist()
                flat = flat.astype(np.uint16)
                words = [flat[e - n : e].tobytes() for e, n in zip(ends, counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_lang"), pa.array(words, pa.binary())], ["_id", "_lang", "_words"]
                )

    kind = light.schema["_id"].dataType.simpleString()
    packed = light.mapInArrow(tidied(run), f"_id {kind}, _lang string, _words binary")
    own = packed.join(marked, F.col("_id") == F.col("_label_id")).dropDuplicates(["_id"])
    return materialize(own.select("_lang", "_label", "_hash", "_words"))


def unpacked(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16).astype(np.int32).reshape(-1, PARTS) for x in column.to_pylist()]


def word_counts(rows: DataFrame, known: list[str]) -> np.ndarray:
    """How often each bucket (of first stems) is in the rows of each language, and one more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((len(known), BUCKETS), np.int64)
        for batch in batches:
            for part in by_bytes(batch, "_words"):
                for lang, own in zip(part.column("_lang").to_pylist(), unpacked(part.column("_words")), strict=True):
                    found[place[lang]] += np.bincount(own[:, 1], minlength=BUCKETS)
        lang, bucket = np.nonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket), pa.array(found[lang, bucket])], ["_k", "_bucket", "_n"])

    place = {lang: k for k, lang in enumerate(known)}
    parts = rows.select("_lang", "_words").mapInArrow(tidied(run), "_k long, _bucket long, _n long")
    table = parts.groupBy("_k", "_bucket").agg(F.sum("_n").alias("_n")).toArrow()
    freq = np.ones((BUCKETS + 1, len(known)))
    freq[table.column("_bucket").to_numpy(), table.column("_k").to_numpy()] += table.column("_n").to_numpy()
    return freq


def one_round(shards: DataFrame, weights: list[np.ndarray], intercept: float, seed: int) -> tuple[list[np.ndarray], float]:
    """The weights after every shard has gone once through its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, rng, rows = Learner([x.copy() for x in weights], intercept), np.random.default_rng(seed), 0
        for batch in batches:
            for part in by_bytes(batch, "_words", 1 << 23):
                order = rng.permutation(part.num_rows)
                part = part.take(pa.array(order))
                ids, labels = unpacked(part.column("_words")), part.column("_label").to_numpy().astype(np.float32)
                for some in steps(map(len, ids)):
                    learner.learn(ids[some], labels[some])
                rows += part.num_rows
        if rows:
            packed = np.concatenate([x.ravel() for x in learner.weights]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([learner.intercept]), pa.array([packed])], names)

    names = ["_rows", "_intercept", "_weights"]
    table = shards.select("_label", "_words").mapInArrow(tidied(run), "_rows long, _intercept double, _weights binary").toArrow()
    part = table.column("_rows").to_numpy() / sum(table.column("_rows").to_pylist())
    ends = np.cumsum([x.size for x in weights])
    sums, moved = [np.zeros(x.shape) for x in weights], np.zeros(len(weights[0]))
    for own, packed in zip(part.tolist(), table.column("_weights").to_pylist(), strict=True):
        pieces = np.split(np.frombuffer(packed, np.float32), ends[:-1])
        for k, (total, piece, before) in enumerate(zip(sums, pieces, weights, strict=True)):
            change = piece.reshape(before.shape).astype(np.float64) - before
            total += own * change
            if k == 0:
                moved += own * (change != 0).any(1)
    sums[0] /= np.where(moved > 0, moved, 1)[:, None]
    return [(x + y).astype(np.float32) for x, y in zip(weights, sums, strict=True)], float(part @ table.column("_intercept").to_numpy())


def counts_at_logits(rows: DataFrame, model: Model) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By guessed language the logits, in bins, with the toxic rows and all rows at each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "_words"):
                ids = unpacked(part.column("_words"))
                raw, spoken = model.raw(np.concatenate(ids), np.array([len(x) for x in ids]))
                bins = np.rint(np.clip(raw, -30, 30) * FINENESS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(spoken), pa.array(bins), part.column("_label")], ["_k", "_bin", "_label"])

    found = rows.select("_label", "_words").mapInArrow(tidied(run), "_k long, _bin long, _label int")
    table = found.groupBy("_k", "_bin").agg(F.sum("_label").alias("_toxic"), F.count("*").alias("_rows")).orderBy("_k", "_bin").toArrow()
    k, *columns = (table.column(c).to_numpy() for c in ("_k", "_bin", "_toxic", "_rows"))
    columns[0] = columns[0] / FINENESS
    return {int(own): tuple(c[k == own] for c in columns) for own in np.unique(k)}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    label_col: str = "toxic",
    seed: int = 7,
) -> Model:
    """Train on every labelled document; a fifth of them, by their ids' hashes, is kept back for the cuts by language."""
    spark = docs.sparkSession
    rows = packed_rows(docs, labels, id_col, text_col, lang_col, label_col)
    held = F.pmod(F.xxhash64("_hash", F.lit(seed)), F.lit(5)) == 0
    found = rows.groupBy("_lang", held.alias("_held"), "_label").count().toArrow().to_pylist()  # a few rows a language
    known = sorted({r["_lang"] for r in found}) or [""]
    number = lambda **of: sum(r["count"] for r in found if all(r[f"_{k}"] == v for k, v in of.items()))
    total, toxic = number(), number(label=1)
    share = toxic / total if total else 0.0
    weights, intercept = fresh_weights(np.random.default_rng(seed)), 0.0
    freq = log_frequencies(word_counts(rows, known))

    def model(shifts: np.ndarray) -> Model:
        embed, *kernels, bias, output = weights
        return Model(embed, kernels, bias, output, intercept, freq, shifts, share, 0 < share < 1)

    if not 0 < share < 1:
        return model(np.zeros(len(known)))
    apart = min(number(held=False, label=0), number(held=False, label=1)) > 0 and number(held=True) > 0
    fitted = rows.where(~held) if apart else rows
    size = min(max(1, total // SHARD_ROWS), SHARDS)
    # a file a shard, read by one task a round, whatever the number of cores
    path = new_path(spark)
    dealt = fitted.withColumn("_shard", F.pmod("_hash", F.lit(size)).cast("int"))
    dealt.repartition(size, "_shard").sortWithinPartitions("_shard", "_hash").write.partitionBy("_shard").parquet(path)
    shards = [spark.read.schema(dealt.schema).parquet(path).where(F.col("_shard") == k).coalesce(1) for k in range(size)]
    together = reduce(DataFrame.unionAll, shards)
    intercept = float(np.log(share / (1 - share)))
    for turn in range(min(12, max(LEAST_ROUNDS, -(-PASSES // total)))):
        weights, intercept = one_round(together, weights, intercept, seed + turn)
    counts = counts_at_logits(rows.where(held) if apart else rows, model(np.zeros(len(known))))
    out = model(shifts_of(counts, len(known), threshold))
    discard(rows)
    return out


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, name: str = "_score"
) -> DataFrame:
    """The score (column `name`) of every row: beside the id, or with `keep` beside all columns of `docs`."""
    light = docs if keep else docs.select(F.col(id_col), F.col(text_col))
    out = [f for f in light.schema if keep or f.name == id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, text_col):  # a text's score does not depend on its neighbours
                scores, _ = model.scores(*buckets(part.column(text_col)))
                columns = [part.column(f.name) for f in out]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], [*[f.name for f in out], name])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in out]
    return light.mapInArrow(tidied(run), ", ".join([*fields, f"`{name}` double"]))
