"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions beside them.

Base spans are leftmost non-overlapping matches of fixed patterns, each kind for itself, less those that fail the
kind's check (parts of an address, number of digits, Luhn). The model is trained in numpy from labelled spans: the base
spans of a bounded sample of documents, and variants of them that the patterns do not know (other separators, no
country code), which teach it to look at the surroundings and the shape.

A text is covered by overlapping windows on a fixed grid. A span must hold a digit or an at sign, so windows without
either are all outside by definition and are not computed. The windows' emissions are put together over the whole
text, each weighted by its distance from the window's edge, and one Viterbi pass over every covered stretch decides globally.
The model only adds spans: one that overlaps a base span, or lies within a match of its kind's pattern that the check
has refused, or fails its kind's check itself, is left out.

Defined results: a null text counts as empty and has no span; an empty table gives an empty result; with no labelled
span in the sample there is no model, and base spans are all; repeated rows have the same spans. Whole texts are read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerhouse.llm.common import by_bytes, sample_rows, texts_of, tidied

KINDS = ("email", "ip", "card", "phone")
WIDTH, STRIDE = 96, 48
EMBED, HIDDEN = 10, 16
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
#: Windows that are computed at a time; stretches that are decoded at a time, and their places, each as long as the longest.
WINDOWS, TOGETHER, CELLS = 1024, 256, 1 << 20

# The patterns are fixed values. An e-mail's local part is found backwards from its at sign, which gives the
# leftmost match without trying every start; the others cannot run on in vain.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile("[0-9@]")
_NUMBER = re.compile("[0-9]+")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def valid(kind: int, text: str) -> bool:
    """The check of a kind."""
    if kind == 0:
        return True
    numbers = _NUMBER.findall(text)
    if kind == 1:
        parts = [n.lstrip("0") or "0" for n in numbers]  # a part may have any number of leading zeros
        return all(len(n) <= 3 and int(n) <= 255 for n in parts)
    digits = "".join(numbers)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        rest = _DOMAIN.match(text, at + 1) if start < at else None
        if rest:
            yield start, rest.end()
            done = rest.end()
        at = text.find("@", max(at + 1, done))


def matches(text: str) -> list[Span]:
    """All matches of the base patterns, checked or not."""
    if not _HINT.search(text):
        return []
    found = [(a, 0, b) for a, b in emails(text)]
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return sorted(found)


def base_spans(text: str) -> list[Span]:
    return [s for s in matches(text) if valid(s[1], text[s[0] : s[2]])]


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# characters by class: 1 small letter, 2 capital, 3 digit, 4 white space, then each ASCII sign; 0 fills up
_CLASS = np.ones(129, np.int8)
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[:33] = 4
_SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS[_SIGNS] = np.arange(len(_SIGNS)) + 5
CLASSES = len(_SIGNS) + 5


def classes(text: str) -> np.ndarray:
    return _CLASS[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 128)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Tagger:
    """Weights: embedding; for each direction input, recurrent and bias; output and its bias; transitions and start."""

    weights: list[np.ndarray]

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Tagger:
        draw = lambda *shape: rng.normal(0, 0.25, shape).astype(np.float32)
        sides = []
        for _ in range(2):
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1
            sides += [draw(EMBED, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN), bias]
        rest = [draw(2 * HIDDEN, TAGS), np.zeros(TAGS, np.float32), np.zeros((TAGS, TAGS), np.float32), np.zeros(TAGS, np.float32)]
        return cls([draw(CLASSES, EMBED), *sides, *rest])

    def _side(self, x: np.ndarray, w: int, keep: bool) -> tuple[np.ndarray, list]:
        wx, wh, bias = self.weights[w : w + 3]
        n, steps, _ = x.shape
        given = x.transpose(1, 0, 2).reshape(steps * n, -1) @ wx + bias
        given = given.reshape(steps, n, -1)
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, kept = np.empty((steps, n, HIDDEN), np.float32), []
        for t in range(steps):
            z = given[t] + h @ wh
            gates, new = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            before_h, before_c = h, c
            c = f * c + i * new
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep:
                kept.append((i, f, o, new, tc, before_h, before_c))
        return out, kept

    def emissions(self, ids: np.ndarray, keep: bool = False):
        x = self.weights[0][ids]
        forth, kept_forth = self._side(x, 1, keep)
        back, kept_back = self._side(x[:, ::-1], 4, keep)
        both = np.concatenate([forth, back[::-1]], axis=2).transpose(1, 0, 2)
        out = both @ self.weights[7] + self.weights[8]
        return (out, x, both, kept_forth, kept_back) if keep else out

    def _side_back(self, x: np.ndarray, w: int, kept: list, grad: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        wx, wh, _ = self.weights[w : w + 3]
        n, steps, _ = x.shape
        gz = np.empty((steps, n, 4 * HIDDEN), np.float32)
        g_wh = np.zeros_like(wh)
        gh, gc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            i, f, o, new, tc, before_h, before_c = kept[t]
            gh = gh + grad[t]
            gc = gc + gh * o * (1 - tc * tc)
            gz[t, :, :HIDDEN] = gc * new * i * (1 - i)
            gz[t, :, HIDDEN : 2 * HIDDEN] = gc * before_c * f * (1 - f)
            gz[t, :, 2 * HIDDEN : 3 * HIDDEN] = gh * tc * o * (1 - o)
            gz[t, :, 3 * HIDDEN :] = gc * i * (1 - new * new)
            g_wh += before_h.T @ gz[t]
            gh, gc = gz[t] @ wh.T, gc * f
        flat = gz.reshape(steps * n, -1)
        g_wx = x.transpose(1, 0, 2).reshape(steps * n, -1).T @ flat
        gx = (flat @ wx.T).reshape(steps, n, -1).transpose(1, 0, 2)
        return gx, [g_wx, g_wh, flat.sum(0)]

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log-likelihood of the tags, and its gradients."""
        emit, x, both, kept_forth, kept_back = self.emissions(ids, keep=True)
        n, steps, _ = emit.shape
        trans, start = self.weights[9].astype(np.float64), self.weights[10].astype(np.float64)
        e = emit.astype(np.float64)
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + start
        for t in range(1, steps):
            alpha[:, t] = e[:, t] + _log_sum(alpha[:, t - 1][:, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            beta[:, t] = _log_sum(trans + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        log_z = _log_sum(alpha[:, -1], 1)
        lines = np.arange(n)
        gold = start[tags[:, 0]] + e[lines[:, None], np.arange(steps), tags].sum(1) + trans[tags[:, :-1], tags[:, 1:]].sum(1)
        g_emit = np.exp(alpha + beta - log_z[:, None, None])
        pair = alpha[:, :-1, :, None] + trans + (e + beta)[:, 1:, None, :] - log_z[:, None, None, None]
        g_trans = np.exp(pair).sum((0, 1))
        g_start = g_emit[:, 0].sum(0)
        np.add.at(g_trans, (tags[:, :-1], tags[:, 1:]), -1)
        np.add.at(g_start, tags[:, 0], -1)
        g_emit[lines[:, None], np.arange(steps), tags] -= 1
        g_emit = (g_emit / n).astype(np.float32)
        flat, gflat = both.reshape(n * steps, -1), g_emit.reshape(n * steps, -1)
        g_both = (gflat @ self.weights[7].T).reshape(n, steps, -1).transpose(1, 0, 2)
        gx, forth = self._side_back(x, 1, kept_forth, g_both[:, :, :HIDDEN])
        gx_back, back = self._side_back(x[:, ::-1], 4, kept_back, g_both[::-1, :, HIDDEN:])
        g_embed = np.zeros_like(self.weights[0])
        np.add.at(g_embed, ids, gx + gx_back[:, ::-1])
        crf = [(g / n).astype(np.float32) for g in (g_trans, g_start)]
        return float((log_z - gold).mean()), [g_embed, *forth, *back, flat.T @ gflat, gflat.sum(0), *crf]

    def viterbi(self, blocks: Iterator[np.ndarray], sizes: np.ndarray) -> list[np.ndarray]:
        """Best tags of each row, of which the first `sizes` places count. The emissions come in blocks of places."""
        trans, start = self.weights[9], self.weights[10]
        n, steps, t = len(sizes), int(sizes.max()), 0
        back, last = np.zeros((n, steps, TAGS), np.int8), np.zeros((n, TAGS), np.float32)
        for emit in blocks:
            for k in range(min(emit.shape[1], steps - t)):
                if t:
                    all_ = score[:, :, None] + trans
                    back[:, t] = all_.argmax(1)
                    score = all_.max(1) + emit[:, k]
                else:
                    score = emit[:, k] + start
                t += 1
                ends = sizes == t
                if ends.any():
                    last[ends] = score[ends]
        out = []
        for row in range(n):
            tag = int(last[row].argmax())
            path = np.empty(sizes[row], np.int8)
            for t in range(sizes[row] - 1, -1, -1):
                path[t] = tag
                tag = int(back[row, t, tag])
            out.append(path)
        return out

    def blocks(self, rows: list[np.ndarray], counts: list[int]) -> Iterator[np.ndarray]:
        """Emissions of stretches, each of so many windows, a block of places at a time."""
        edge = (1 + np.minimum(np.arange(WIDTH), np.arange(WIDTH)[::-1])).astype(np.float32)[:, None]
        rest = np.zeros((len(rows), WIDTH - STRIDE, TAGS + 1), np.float32)  # of places that the next windows see too
        most, step = max(counts), max(1, WINDOWS // len(rows))
        for lo in range(0, most, step):
            hi = min(most, lo + step)
            sums = np.concatenate([rest, np.zeros((len(rows), (hi - lo) * STRIDE, TAGS + 1), np.float32)], axis=1)
            places = [(r, w) for r, count in enumerate(counts) for w in range(lo, min(hi, count))]
            windows = np.zeros((len(places), WIDTH), np.int8)
            for window, (r, w) in zip(windows, places, strict=True):
                part = rows[r][w * STRIDE : w * STRIDE + WIDTH]
                window[: len(part)] = part
            for emit, (r, w) in zip(self.emissions(windows), places, strict=True):
                begin = (w - lo) * STRIDE
                sums[r, begin : begin + WIDTH, :TAGS] += emit * edge
                sums[r, begin : begin + WIDTH, TAGS:] += edge
            done = (hi - lo) * STRIDE
            yield sums[:, :done, :TAGS] / np.maximum(sums[:, :done, TAGS:], 1)
            rest = sums[:, done:]
        yield rest[:, :, :TAGS] / np.maximum(rest[:, :, TAGS:], 1)

    def tag(self, texts: list[str]) -> list[list[Span]]:
        """Spans of each text, decoded over the whole of it."""
        stretches: list[tuple[int, int, np.ndarray, int]] = []  # text, first place, classes, number of windows
        for k, text in enumerate(texts):
            if not _HINT.search(text):
                continue
            row = classes(text)
            hints = np.zeros(-(-len(row) // STRIDE) * STRIDE, bool)
            hints[: len(row)] = (row == _CLASS[48]) | (row == _CLASS[64])
            hints = hints.reshape(-1, STRIDE).any(1)
            wanted = np.flatnonzero(hints | np.append(hints[1:], False))
            breaks = np.flatnonzero(np.diff(wanted) > 1)
            for a, b in zip([0, *(breaks + 1).tolist()], [*breaks.tolist(), len(wanted) - 1], strict=True):
                first, last = int(wanted[a]) * STRIDE, int(wanted[b]) * STRIDE
                stretches.append((k, first, row[first : last + WIDTH], b + 1 - a))
        out: list[list[Span]] = [[] for _ in texts]
        stretches.sort(key=lambda s: len(s[2]))
        lo = 0
        while lo < len(stretches):
            # together if their back-pointers are few; a longer stretch goes alone
            hi = lo + 1
            while hi < len(stretches) and hi - lo < TOGETHER and (hi + 1 - lo) * len(stretches[hi][2]) <= CELLS:
                hi += 1
            group, lo = stretches[lo:hi], hi
            rows = [row for _, _, row, _ in group]
            paths = self.viterbi(self.blocks(rows, [n for *_, n in group]), np.array([len(row) for row in rows]))
            for (k, first, _, _), tags in zip(group, paths, strict=True):
                out[k] += _tagged(tags, first)
        return [sorted(spans) for spans in out]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def _tagged(tags: np.ndarray, first: int) -> list[Span]:
    """Spans of a tagged stretch: a begin tag and the inside tags of its kind that follow."""
    out = []
    for a in np.flatnonzero(tags % 2 == 1).tolist():
        b = a + 1
        while b < len(tags) and tags[b] == tags[a] + 1:
            b += 1
        out.append((first + a, int(tags[a]) // 2, first + b))
    return out


def _plausible(kind: int, text: str) -> bool:
    """The stricter check of what the model adds."""
    if "\n" in text or text != text.strip():
        return False
    if kind == 0:
        name, _, host = text.partition("@")
        return bool(name) and "." in host.strip(".") and "@" not in host
    if not re.fullmatch(r"[0-9+ ().\-/\[\]]+" if kind == 1 else r"[0-9+ ().\-/]+", text):
        return False
    return valid(kind, text) and (kind != 1 or len(_NUMBER.findall(text)) == 4)


def _like_an_ip(text: str) -> bool:
    return all(len(n) <= 3 for n in _NUMBER.findall(text))


class _Ranges:
    """Sorted ranges of places."""

    def __init__(self, ranges: list[tuple[int, int]]):
        self.begins = [a for a, _ in ranges]
        self.ends = list(accumulate((b for _, b in ranges), max))

    def furthest(self, place: int) -> int:
        """The furthest end of the ranges that begin before the place; -1 for none."""
        k = bisect_left(self.begins, place)
        return self.ends[k - 1] if k else -1


def all_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and base and added spans, of each text."""
    found = [matches(t) for t in texts]
    tagged = tagger.tag(texts) if tagger else [[] for _ in texts]
    out = []
    for text, raw, more in zip(texts, found, tagged, strict=True):
        base, refused = [], [[] for _ in KINDS]
        for a, kind, b in raw:
            if valid(kind, text[a:b]):
                base.append((a, kind, b))
            else:
                refused[kind].append((a, b))
        added: list[Span] = []
        if more:
            # what a pattern has matched and its check has refused stays refused, as that kind, or as a phone if it looks
            # like an IP; a span that reaches beyond is another number, of which the pattern has matched pieces
            refused[3] = sorted(refused[3] + [(a, b) for a, b in refused[1] if _like_an_ip(text[a:b])])
            taken, against = _Ranges([(a, b) for a, _, b in base]), [_Ranges(r) for r in refused]
        for a, kind, b in more:
            if _plausible(kind, text[a:b]) and taken.furthest(b) <= a and against[kind].furthest(a + 1) < b:
                added.append((a, kind, b))
        out.append((base, sorted(base + added)))
    return out


def _variant(kind: int, text: str, rng: np.random.Generator) -> str:
    """The same datum in a form that the base patterns do not know."""
    if kind == 0:
        return text.replace("@", " @ ", 1) if rng.random() < 0.5 else text.replace("@", "(@)", 1)
    if kind == 1:
        return re.sub(r"\.", [" . ", "-", "[.]"][rng.integers(3)], text)
    if kind == 2:
        digits = re.sub("[^0-9]", "", text)
        return [".", "/", "  "][rng.integers(3)].join(digits[k : k + 4] for k in range(0, len(digits), 4))
    bare = text.lstrip("+")
    return [bare, bare.replace(" ", "/"), "00" + bare][rng.integers(3)]


#: Of one text, so many spans and other places make windows; they are drawn at random.
SPANS_OF, OTHERS_OF = 6, 3


def evenly(tags: np.ndarray, most: int, rng: np.random.Generator) -> np.ndarray:
    """Which `most` windows to take: in turn one of each kind (by its greatest tag, so windows without a span are a kind)."""
    kind = (tags.max(1, initial=0) + 1) // 2
    order = rng.permutation(len(kind))
    turn = np.zeros(len(kind), np.int64)
    for k in np.unique(kind):
        own = order[kind[order] == k]
        turn[own] = np.arange(len(own))
    return np.sort(np.lexsort((kind, turn))[:most])


def examples(texts: list[str], rng: np.random.Generator, most: int = 3000) -> tuple[np.ndarray, np.ndarray]:
    """Windows and their tags around the spans of the texts, half of them in a variant, and around other numbers.

    All texts make windows; where these are more than `most`, those are drawn evenly over the kinds.
    """
    ids, tags = [], []

    def add(text: str, spans: list[Span], near: int) -> None:
        begin = max(0, near - int(rng.integers(8, WIDTH - 8)))
        row, tag = classes(text[begin : begin + WIDTH]), np.zeros(WIDTH, np.int64)
        for a, kind, b in spans:
            a, b = a - begin, b - begin
            if a >= 0 and b <= WIDTH:
                tag[a:b] = 2 + 2 * kind
                tag[a] = 1 + 2 * kind
            elif a < WIDTH and b > 0:  # cut off by the window
                tag[max(a, 0) : b] = 2 + 2 * kind
                if a >= 0:
                    tag[a] = 1 + 2 * kind
        ids.append(np.pad(row, (0, WIDTH - len(row))))
        tags.append(tag)

    for text in texts:
        spans, raw = base_spans(text), matches(text)
        free = [s for s in spans if not any(o is not s and s[0] < o[2] and o[0] < s[2] for o in spans)]
        for span in [free[k] for k in rng.permutation(len(free))[:SPANS_OF]]:
            add(text, free, span[0])
            a, kind, b = span
            own = text[max(0, a - WIDTH) : a]
            other = _variant(kind, text[a:b], rng)
            add(own + other + text[b : b + WIDTH], [(len(own), kind, len(own) + len(other))], len(own))
        others = [m.start() for m in _HINT.finditer(text) if not any(a <= m.start() < b for a, _, b in raw)]
        for k in rng.permutation(len(others))[:OTHERS_OF]:
            add(text, free, others[k])
    windows, marks = np.array(ids, np.int8).reshape(-1, WIDTH), np.array(tags, np.int8).reshape(-1, WIDTH)
    some = evenly(marks, most, rng)
    return windows[some].astype(np.int64), marks[some].astype(np.int64)


def train(texts: list[str], windows: int = 3000, steps: int = 160, batch: int = 32, seed: int = 11) -> Tagger | None:
    rng = np.random.default_rng(seed)
    ids, tags = examples(texts, rng, windows)
    if not tags.any():
        return None
    tagger = Tagger.fresh(rng)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in tagger.weights]
    for step in range(1, steps + 1):
        some = rng.integers(0, len(ids), batch)
        _, gradients = tagger.gradients(ids[some], tags[some])
        norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1))) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for w, g, (m, v) in zip(tagger.weights, gradients, moments, strict=True):
            g = g * min(1.0, 5.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * m / (np.sqrt(v) + 1e-8)
    return tagger


def fit(
    docs: DataFrame, most: int = 1000, longest: int = 20_000, id_col: str = "doc_id", text_col: str = "text", windows: int = 3000
) -> Tagger | None:
    """Train on at most `most` documents with a digit or an at sign and at most `longest` characters, and on at most
    `windows` windows of them, drawn evenly over the kinds."""
    usable = docs.where((F.length(text_col) <= longest) & F.col(text_col).rlike("[0-9@]") & F.col(id_col).isNotNull())
    light = usable.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    ids = sample_rows(light.select(F.lit(0).alias("_all"), "_id").distinct(), "_all", "_id", most).select(F.col("_id").alias("_i"))
    rows = light.join(F.broadcast(ids), F.col("_id") == F.col("_i"))
    rows = rows.groupBy("_id").agg(F.min("_text").alias("_text")).orderBy("_id").select("_text")  # one row an id
    return train(rows.toArrow().column("_text").to_pylist(), windows)


def find(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts of base spans by kind, `base_sha256`, all `spans` as text, `n_added`."""
    light = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = light.schema["_id"].dataType.simpleString()
    counts = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "_text", rows=1024):
                both = all_spans(texts_of(part.column("_text")), tagger)
                numbers = [pa.array([sum(s[1] == k for s in b) for b, _ in both], pa.int64()) for k in range(len(KINDS))]
                sha = pa.array([hashlib.sha256(as_text(b).encode()).hexdigest() for b, _ in both], pa.string())
                spans = pa.array([as_text(a) for _, a in both], pa.string())
                added = pa.array([len(a) - len(b) for b, a in both], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), *numbers, sha, spans, added], [id_col, *counts, "base_sha256", "spans", "n_added"]
                )

    columns = ", ".join(f"{c} long" for c in counts)
    return light.mapInArrow(tidied(run), f"`{id_col}` {kind}, {columns}, base_sha256 string, spans string, n_added long")
