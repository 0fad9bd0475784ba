"""Language identification with interpolated Kneser-Ney character models.

Each language has its own model of `ORDER` characters: counts of the highest order, continuation counts below, one
absolute discount per order (n1 / (n1 + 2 n2)), interpolated down to an even distribution over the alphabet. N-grams are
64-bit numbers (their characters' classes, packed) in sorted arrays, found by binary search. A text gets the language of the
lowest cross-entropy per character. The model also holds, for every n-gram seen in any language, its log
probability in each of them, so that a text costs one search per character; n-grams seen nowhere are computed.

Rejection is calibrated on training rows kept back: a language's bound is the cross-entropy that all but a small share of
its own rows stay under. Texts above their best language's bound are marked `rejected`.

Training takes a bounded sample: at most `most` documents of each language with at most `longest` characters. Every text is
scored whole, in blocks.

Defined results: `und` with score 0 for a null text, one without letters, and where nothing could be learned; ties go to the
language that comes first by code point; an empty table gives an empty result; repeated rows are scored alike.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerhouse.llm.common import by_bytes, sample_rows, tidied

ORDER = 4
#: Bits of a character's class: class 0 is all that is no letter, the last one a letter outside the alphabet.
BITS = 12
CLASSES = 1 << BITS
#: Characters that are scored at a time.
SPAN = 1 << 20
UNKNOWN = "und"


def letter_classes(texts: list[str], alphabet: int = CLASSES - 2) -> np.ndarray:
    """Class of every code point: letters of the sample, lower-cased, the `alphabet` most frequent ones; other letters share one."""
    seen = np.zeros(sys.maxunicode + 1, np.int64)
    for text in texts:
        np.add.at(seen, _points(text.lower()), 1)
    letters = [c for c in np.argsort(-seen, kind="stable")[: CLASSES * 2].tolist() if seen[c] and chr(c).isalpha()]
    table = np.zeros(sys.maxunicode + 1, np.int16)
    known = {c: k + 1 for k, c in enumerate(letters[: min(alphabet, CLASSES - 2)])}
    for c in range(sys.maxunicode + 1):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = known.get(ord(low[0]), CLASSES - 1)
    return table


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(classes: np.ndarray, order: int) -> np.ndarray:
    """For every character the number of the n-gram that ends there; the text is led in by blanks."""
    padded = np.concatenate([np.zeros(order - 1, np.int64), classes])
    out = np.zeros(len(classes), np.int64)
    for k in range(order):
        out = (out << BITS) | padded[k : k + len(classes)]
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class KneserNey:
    """Sorted n-grams and counts per order; sorted contexts with their totals and numbers of different followers."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    discounts: list[float]

    @classmethod
    def train(cls, texts: list[np.ndarray]) -> KneserNey:
        all_grams = np.concatenate([grams(t, ORDER) for t in texts]) if texts else np.zeros(0, np.int64)
        keys, counts = np.unique(all_grams, return_counts=True)
        levels, contexts, discounts = [], [], []
        for order in range(ORDER, 0, -1):
            if order < ORDER:  # continuation counts: how many different characters come before
                keys, counts = np.unique(keys & ((1 << BITS * order) - 1), return_counts=True)
            once, twice = int((counts == 1).sum()), int((counts == 2).sum())
            discounts.append(once / (once + 2 * twice) if once else 0.5)
            before = keys >> BITS
            first = np.flatnonzero(np.r_[True, before[1:] != before[:-1]]) if len(keys) else np.zeros(0, np.int64)
            totals = np.add.reduceat(counts, first) if len(keys) else counts
            followers = np.diff(np.append(first, len(keys)))
            levels.append((keys, counts))
            contexts.append((before[first], totals, followers))
        return cls(levels, contexts, discounts)

    def probability(self, wanted: np.ndarray, level: int = 0) -> np.ndarray:
        """Of the last character of each n-gram after those before it; level 0 is the highest order."""
        if level == ORDER:
            return np.full(len(wanted), 1.0 / CLASSES)
        order = ORDER - level
        lower = self.probability(wanted & ((1 << BITS * (order - 1)) - 1), level + 1)
        keys, counts = self.grams[level]
        before, totals, followers = self.contexts[level]
        at, known = _find(keys, wanted)
        count = np.where(known, counts[at] if len(counts) else 0, 0)
        at, known = _find(before, wanted >> BITS)
        if not len(before):
            return lower
        discount = self.discounts[level]
        own = (np.maximum(count - discount, 0) + discount * followers[at] * lower) / totals[at]
        return np.where(known, own, lower)


@dataclass
class Model:
    languages: list[str]
    classes: np.ndarray
    models: list[KneserNey]
    keys: np.ndarray  # n-grams of any language
    logs: np.ndarray  # their log probabilities, a column a language
    bounds: np.ndarray
    scale: float

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text (rows) in each language, and the number of letters."""
        sums = np.zeros((len(texts), len(self.languages)))
        sizes, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        group: list[int] = []
        held: list[np.ndarray] = []
        for k, text in enumerate(texts):
            for lo in range(0, len(text), SPAN):
                part = self.classes[_points(text[lo : lo + SPAN])].astype(np.int64)
                sizes[k] += len(part)
                letters[k] += int((part > 0).sum())
                lead = self.classes[_points(text[max(0, lo - ORDER + 1) : lo])].astype(np.int64)
                held.append(grams(np.concatenate([lead, part]), ORDER)[len(lead) :])
                group.append(k)
                if sum(map(len, held)) >= SPAN:
                    self._add(sums, group, held)
                    group, held = [], []
        self._add(sums, group, held)
        return -sums / np.maximum(sizes, 1)[:, None], letters

    def _add(self, sums: np.ndarray, group: list[int], held: list[np.ndarray]) -> None:
        held, group = [h for h in held if len(h)], [g for g, h in zip(group, held, strict=True) if len(h)]
        if not held:
            return
        wanted = np.concatenate(held)
        at, known = _find(self.keys, wanted)
        logs = self.logs[at]
        if not known.all():
            missing, back = np.unique(wanted[~known], return_inverse=True)
            logs[~known] = np.stack([np.log(m.probability(missing)) for m in self.models], axis=1)[back]
        begins = np.cumsum([0, *map(len, held[:-1])])
        np.add.at(sums, group, np.add.reduceat(logs, begins, axis=0, dtype=np.float64))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and rejection of each text."""
        if not self.languages:
            n = len(texts)
            return [UNKNOWN] * n, np.zeros(n), np.zeros(n), np.ones(n, bool)
        entropy, letters = self.entropies([t or "" for t in texts])
        best = entropy.argmin(1)
        lines = np.arange(len(texts))
        lowest = entropy[lines, best]
        score = 1 / np.exp((lowest[:, None] - entropy) * self.scale).sum(1) if len(texts) else np.zeros(0)
        none = letters == 0
        # a text whose letters are all of no known alphabet has no evidence but the models' floor
        language = [UNKNOWN if no else self.languages[k] for no, k in zip(none.tolist(), best.tolist(), strict=True)]
        return language, np.where(none, 0.0, score), np.where(none, 0.0, lowest), none | (lowest > self.bounds[best])


def train(texts: list[str], languages: list[str], alphabet: int = CLASSES - 2, rejected: float = 0.01, seed: int = 5) -> Model:
    """Models from nine tenths of the rows, bounds and the scale of scores from the others."""
    known = sorted(set(languages))
    classes = letter_classes(texts, alphabet)
    rng = np.random.default_rng(seed)
    held = rng.random(len(texts)) < 0.1
    models = []
    for name in known:
        rows = [k for k, x in enumerate(languages) if x == name]
        use = [k for k in rows if not held[k]] or rows
        models.append(KneserNey.train([classes[_points(texts[k])].astype(np.int64) for k in use]))
    keys = np.unique(np.concatenate([m.grams[0][0] for m in models])) if models else np.zeros(0, np.int64)
    logs = np.stack([np.log(m.probability(keys)) for m in models], axis=1).astype(np.float32) if models else np.zeros((0, 0))
    out = Model(known, classes, models, keys, logs, np.full(len(known), np.inf), 20.0)
    check = [k for k in range(len(texts)) if held[k]]
    if known and check:
        entropy, letters = out.entropies([texts[k] for k in check])
        own = np.array([known.index(languages[k]) for k in check])
        for k in range(len(known)):
            values = entropy[(own == k) & (letters > 0), k]
            if len(values) >= 5:
                out.bounds[k] = float(np.quantile(values, 1 - rejected)) * 1.05
    return out


def fit(
    docs: DataFrame,
    most: int = 600,
    longest: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    alphabet: int = CLASSES - 2,
) -> Model:
    """Learn from at most `most` rows of each non-null language with at most `longest` characters.

    The `alphabet` most frequent letters of these are told apart (4,094 at most, as four must fit a number); all others count
    as one more letter. That is enough for alphabets and syllabaries, and leaves out rare ideographs.
    """
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) <= longest))
    light = usable.select(
        F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")
    ).where("_id is not null")
    # the sample is drawn among ids, so that only its rows meet their texts
    ids = sample_rows(light.select("_lang", "_id").distinct(), "_lang", "_id", most).select(F.col("_lang").alias("_l"), F.col("_id").alias("_i"))
    both = light.join(F.broadcast(ids.distinct()), (F.col("_id") == F.col("_i")) & (F.col("_lang") == F.col("_l")))
    one = both.groupBy("_lang", "_id").agg(F.min("_text").alias("_text"))  # one row an id and language
    rows = one.orderBy("_lang", "_id").select("_text", "_lang").toArrow()
    return train(rows.column("_text").to_pylist(), rows.column("_lang").to_pylist(), alphabet)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, `lang_pred`, `score` (0 to 1), `cross_entropy` per character, `rejected`."""
    light = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = light.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "_text", rows=512):
                language, score, entropy, rejected = model.predict(part.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(language, pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)],
                    [id_col, "lang_pred", "score", "cross_entropy", "rejected"],
                )

    return light.mapInArrow(
        tidied(run), f"`{id_col}` {kind}, lang_pred string, score double, cross_entropy double, rejected boolean"
    )


__all__ = ["KneserNey", "Model", "fit", "grams", "predict", "train"]
