"""Token counts by section: documents are encoded once, tokens are attributed by their character offsets.

Every document is encoded whole, so a token may lie across the border of two sections. Token spans and section
spans, both in characters and in order, are joined as intervals; a token across borders is allocated by an
explicit rule:

- `first`: to the section that holds its first character;
- `most`: to the section that holds most of its characters, the earlier one on a tie;
- `share`: to each section by its share of the token's characters.

Characters outside every section are reported as section -1. Tokens that cover only part of a character (bytes of
one that was split) count with that whole character, as offsets of the tokenizers library do.

Defined results: a null or empty text has one section without tokens; an empty table gives an empty result;
repeated rows are counted each for itself; sections may be empty, and then hold no token.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerhouse.llm.bpe import TOGETHER, TOGETHER_BYTES, Bpe
from brokerhouse.llm.common import by_bytes, texts_of, tidied

RULES = ("first", "most", "share")
Sections = Callable[[str], list[tuple[int, int]]]

_LINE = re.compile(r"[^\n]*\n|[^\n]+")


def lines(text: str) -> list[tuple[int, int]]:
    """Sections by line; the line break belongs to the line it ends."""
    return [m.span() for m in _LINE.finditer(text)] or [(0, 0)]


def token_spans(sizes: np.ndarray, text: str, ids: Sequence[int] | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of all tokens of a text, in order; `sizes` has the number of bytes of each token."""
    if not len(ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(text.encode(), np.uint8)
    owner = np.cumsum((data & 0xC0) != 0x80) - 1  # the character of each byte
    lengths = sizes[np.asarray(ids, np.int64)]
    ends = np.cumsum(lengths)
    return owner[ends - lengths], owner[ends - 1] + 1


def allocate(
    begins: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]], rule: str
) -> tuple[np.ndarray, np.ndarray, float]:
    """Tokens of each section, tokens that cross a border counted where they begin, and tokens outside all.

    The spans must be in order and must not overlap.
    """
    lo, hi = np.array(spans, np.int64).reshape(-1, 2).T
    full = np.flatnonzero(hi > lo)
    counts, crossing = np.zeros(len(lo)), np.zeros(len(lo), np.int64)
    if not len(begins) or not len(full):
        return counts, crossing, float(len(begins))
    a, b = lo[full], hi[full]
    # interval join of two ordered lists: the sections a token meets are neighbours
    first = np.searchsorted(b, begins, side="right")
    last = np.searchsorted(a, ends, side="left") - 1
    meets = np.maximum(last - first + 1, 0)
    token = np.repeat(np.arange(len(begins)), meets)
    section = np.arange(len(token)) - np.repeat(np.cumsum(meets) - meets, meets) + first[token]
    shared = np.minimum(ends[token], b[section]) - np.maximum(begins[token], a[section])
    outside = (meets == 0) | (begins < a[np.minimum(first, len(a) - 1)]) | (ends > b[np.clip(last, 0, len(b) - 1)])
    over = (meets > 1) | ((meets == 1) & outside)
    np.add.at(crossing, full[first[over]], 1)
    if rule == "share":
        part = shared / (ends - begins)[token]
        np.add.at(counts, full[section], part)
        return counts, crossing, float(len(begins) - part.sum())
    if rule == "first":
        keep = begins[token] >= a[section]
        keep &= begins[token] < b[section]
    else:
        order = np.lexsort((section, -shared, token))
        keep = np.zeros(len(token), bool)
        keep[order[np.flatnonzero(np.r_[True, np.diff(token[order]) > 0])]] = True if len(order) else False
    np.add.at(counts, full[section[keep]], 1)
    return counts, crossing, float(len(begins) - keep.sum())


def section_tokens(
    docs: DataFrame,
    vocabulary: str,
    rule: str = "most",
    sections: Sections = lines,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document and section: its span, its tokens by `rule`, tokens beginning there that cross a border."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.read(vocabulary)
        sizes = np.array(list(map(len, bpe.token_bytes)), np.int64)
        for batch in batches:
            for part in by_bytes(batch, "_text", TOGETHER_BYTES, TOGETHER):
                owner, number, begin, end, tokens, crossing, whole = [], [], [], [], [], [], []
                texts = texts_of(part.column("_text"))
                for row, (text, ids) in enumerate(zip(texts, bpe.encode_arrays(texts), strict=True)):
                    spans = sections(text)
                    begins, ends = token_spans(sizes, text, ids)
                    counts, over, rest = allocate(begins, ends, spans, rule)
                    extra = rest > 1e-9
                    owner += [row] * (len(spans) + extra)
                    number += [*range(len(spans)), *[-1] * extra]
                    begin += [s for s, _ in spans] + [None] * extra
                    end += [e for _, e in spans] + [None] * extra
                    tokens += [*counts.tolist(), *[rest] * extra]
                    crossing += [*over.tolist(), *[0] * extra]
                    whole += [len(begins)] * (len(spans) + extra)
                columns = [part.column("_id").take(pa.array(owner, pa.int64())), pa.array(number, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (begin, end)]
                columns += [pa.array(tokens, pa.float64()), pa.array(crossing, pa.int64()), pa.array(whole, pa.int64())]
                names = [id_col, "section", "begins", "ends", "tokens", "crossing", "document_tokens"]
                yield pa.RecordBatch.from_arrays(columns, names)

    light = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = light.schema["_id"].dataType.simpleString()
    return light.mapInArrow(
        tidied(run),
        f"`{id_col}` {kind}, section int, begins long, ends long, tokens double, crossing long, document_tokens long",
    )
