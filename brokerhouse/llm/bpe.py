"""BPE encoding and decoding with forced boundaries.

A byte pair that stands side by side inside no token of the vocabulary can never be bridged by a
merge. Each such pair inside a piece of text is a certain cut: the fragments between cuts are merged on
their own and their ids are put together again. The vocabulary comes from a file of the tokenizers library
(byte-level BPE without normalizer), whose path is a parameter.

Defined results: a null text counts as empty and has no ids; an empty table gives an empty result; rows
that repeat are encoded each for itself; a string of a special token in the text is that token, as in the
library; texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import PreTokenizer

from brokerhouse.llm.common import by_bytes, free_names, texts_of, tidied

#: White space of the byte-level pre-tokenizer (fixed value). A run without it, with the one blank before it if any,
#: is a chunk: no piece of the pre-tokenizer reaches over the border of two chunks.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Letters, digits and the rest among the first 256 characters, but for those whose class is unusual (fixed value);
#: a chunk of other characters is split by the pre-tokenizer itself.
_LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_USUAL = re.compile(" ?[!-~\xc0-\xff\xa1\xa7\xab\xbb\xbf]+")
#: Pieces of usual chunks that are written one a line; the end of a line comes out as a piece of its own.
_PIECE = re.compile(f"\n|'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[0-9]+| ?[^ \n{_LETTER}0-9]+")
#: Chunks longer than this are not remembered after their batch; beyond so many others, all are forgotten.
LONGEST_KEPT, MOST_KEPT = 64, 400_000
#: Fragments of more bytes than this are merged one by one, others with all of their length.
LONGEST_ROW = 128
#: Documents that are encoded together, and their bytes; a longer one comes alone.
TOGETHER, TOGETHER_BYTES = 256, 4 << 20
_NO_RANK = np.iinfo(np.int32).max


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass
class Bpe:
    """A vocabulary ready to encode: token ids by bytes, merge ranks by pairs of ids, forbidden byte pairs."""

    ids: dict[bytes, int]
    merges: dict[tuple[int, int], tuple[int, int]]
    special: dict[str, int]
    token_bytes: list[bytes]
    pre_tokenizer: PreTokenizer

    def __post_init__(self) -> None:
        self.bridged = np.zeros((256, 256), bool)
        for token in self.ids:
            row = np.frombuffer(token, np.uint8)
            self.bridged[row[:-1], row[1:]] = True
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        keys = np.array([left << 32 | right for left, right in self.merges], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        rank, whole = np.array(list(self.merges.values()), np.int32).reshape(-1, 2).T
        self.ranks = np.append(rank[order], _NO_RANK)
        self.wholes = np.zeros(int(rank.max(initial=-1)) + 1, np.int32)  # by rank
        self.wholes[rank] = whole
        self.byte_ranks = self._ranks(self.byte_ids[:, None], self.byte_ids)
        self.token_objects = np.array(self.token_bytes, object)
        self._forget()

    @classmethod
    def read(cls, path: str) -> Bpe:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        as_bytes = {t: bytes(letters[c] for c in t) for t in spec["model"]["vocab"]}
        ids = {as_bytes[t]: i for t, i in spec["model"]["vocab"].items()}
        merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (as_bytes[t] for t in (pair.split(" ") if isinstance(pair, str) else pair))
            merges[ids[left], ids[right]] = (rank, ids[left + right])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        token_bytes = [b""] * (1 + max([*ids.values(), *special.values()]))
        for token, i in ids.items():
            token_bytes[i] = token
        for text, i in special.items():
            token_bytes[i] = text.encode()
        return cls(ids, merges, special, token_bytes, Tokenizer.from_file(path).pre_tokenizer)

    def _forget(self) -> None:
        """Remember no chunk but the special tokens. Chunks are numbered as they are met; their ids stand in that order."""
        self.kept = defaultdict(itertools.count(len(self.special)).__next__, {t: k for k, t in enumerate(self.special)})
        self.known = np.fromiter(self.special.values(), np.int32, len(self.special))
        self.begins = np.arange(len(self.special) + 1)

    def pieces(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Pieces of the pre-tokenizer, and for each chunk the place of its first one and their number."""
        usual = np.fromiter(map(bool, map(_USUAL.fullmatch, chunks)), bool, len(chunks))
        out = _PIECE.findall("\n".join([*itertools.compress(chunks, usual), ""]))
        ends = np.flatnonzero(np.fromiter(map("\n".__eq__, out), bool, len(out)))
        first, count = np.zeros((2, len(chunks)), np.int64)
        first[usual] = np.append(0, ends + 1)[:-1]
        count[usual] = ends - first[usual]
        for k in np.flatnonzero(~usual).tolist():
            own = [chunks[k][a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(chunks[k])]
            first[k], count[k] = len(out), len(own)
            out += own
        return out, first, count

    def _cuts(self, row: np.ndarray) -> np.ndarray:
        """Whether a fragment begins at each byte: two neighbours that stand together in no token are cut apart."""
        cut = np.ones(len(row), bool)
        cut[1:] = ~self.bridged[row[:-1], row[1:]]
        return cut

    def fragments(self, piece: bytes) -> list[bytes]:
        """The piece, cut wherever two neighbouring bytes stand together in no token."""
        ends = [*np.flatnonzero(self._cuts(np.frombuffer(piece, np.uint8))).tolist(), len(piece)]
        return [piece[a:b] for a, b in itertools.pairwise(ends)]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each merge, the highest rank where there is none."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NO_RANK)

    def merge_rows(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of many fragments of one length, a row of bytes each: every round merges the best pair of each row.

        Rows come as they are done, together with those of as many ids: their places, and the ids of each.
        """
        owner, tokens = np.arange(len(rows)), self.byte_ids[rows]
        rank = self.byte_ranks[rows[:, :-1], rows[:, 1:]]
        while len(owner) and rank.shape[1]:
            at = rank.argmin(1)
            best = rank[np.arange(len(owner)), at]
            go = best < _NO_RANK
            if not go.all():
                yield owner[~go], tokens[~go]
                owner, at, best, tokens, rank = owner[go], at[go], best[go], tokens[go], rank[go]
            place, at_row = np.arange(tokens.shape[1] - 1), at[:, None]
            tokens = np.where(place <= at_row, tokens[:, :-1], tokens[:, 1:])
            tokens[np.arange(len(owner)), at] = self.wholes[best]
            rank = np.where(place[:-1] < at_row, rank[:, :-1], rank[:, 1:])
            for shift in (-1, 0):
                k = at + shift
                fits = np.flatnonzero((k >= 0) & (k < rank.shape[1]))
                k = k[fits]
                rank[fits, k] = self._ranks(tokens[fits, k], tokens[fits, k + 1])
        yield owner, tokens

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in order, and where those of each piece begin (and the last end)."""
        data = np.frombuffer("".join(pieces).encode(), np.uint8)
        letters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where each character begins
        ends = letters[np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))]
        cut = self._cuts(data)
        cut[ends[:-1]] = True
        begins = np.flatnonzero(cut)
        lengths = np.diff(begins, append=len(data))
        sizes, found = np.zeros(len(begins), np.int64), []
        for n in np.unique(lengths).tolist():
            of = np.flatnonzero(lengths == n)
            if n > LONGEST_ROW:
                found += [(of[k : k + 1], np.array([self.merge(data[a : a + n].tobytes())])) for k, a in enumerate(begins[of].tolist())]
            else:
                found += [(of[rows], ids) for rows, ids in self.merge_rows(data[begins[of][:, None] + np.arange(n)])]
        for rows, ids in found:
            sizes[rows] = ids.shape[1]
        at = np.append(0, np.cumsum(sizes))
        out = np.zeros(int(at[-1]), np.int32)
        for rows, ids in found:
            out[at[rows][:, None] + np.arange(ids.shape[1])] = ids
        return out, at[np.append(0, np.searchsorted(begins, ends))]

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks not met before, all at once, and put their ids behind the known ones."""
        flat, first, count = self.pieces(chunks)
        number = defaultdict(itertools.count().__next__)
        piece = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))[_spread(first, count)]
        ids, begins = self.encode_pieces(list(number))
        sizes = np.diff(begins)[piece]
        self.known = np.append(self.known, ids[_spread(begins[piece], sizes)])
        ends = np.append(0, np.cumsum(sizes))[np.cumsum(count)]
        self.begins = np.append(self.begins, self.begins[-1] + ends)

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of a fragment: the neighbours of lowest rank merge first, the leftmost of equals."""
        tokens = [self.ids[fragment[k : k + 1]] for k in range(len(fragment))]
        n, merges = len(tokens), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(*merges[p], k, *p) for k, p in enumerate(itertools.pairwise(tokens)) if p in merges]
        heapq.heapify(queue)
        while queue:
            _, whole, k, left, right = heapq.heappop(queue)
            j = after[k]
            if j >= n or tokens[k] != left or tokens[j] != right:
                continue
            tokens[k], tokens[j] = whole, -1
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
            for a in (before[k], k):
                if a >= 0 and after[a] < n and (found := merges.get((tokens[a], tokens[after[a]]))):
                    heapq.heappush(queue, (*found, a, tokens[a], tokens[after[a]]))
        return [t for t in tokens if t >= 0]

    def parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The text in order, special tokens told apart with their id."""
        if not any(s in text for s in self.special):
            yield text, None
            return
        longest_first = sorted(self.special, key=len, reverse=True)
        for part in re.split(f"({'|'.join(map(re.escape, longest_first))})", text):
            if part:
                yield part, self.special.get(part)

    def chunks(self, text: str) -> list[str]:
        """Chunks of the text in order, special tokens for themselves."""
        if not any(s in text for s in self.special):
            return _CHUNK.findall(text)
        return [c for part, i in self.parts(text) for c in ([part] if i is not None else _CHUNK.findall(part))]

    def encode_arrays(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Chunks become numbers, and ids are taken by number."""
        if not texts:
            return []
        if len(self.kept) > MOST_KEPT:
            self._forget()
        split = list(map(self.chunks, texts))
        count = np.fromiter(map(len, split), np.int64, len(split))
        before = len(self.kept)
        at = np.fromiter(map(self.kept.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(count.sum()))
        new = list(itertools.islice(reversed(self.kept), len(self.kept) - before))[::-1]
        long = np.fromiter(map(len, new), np.int64, len(new)) > LONGEST_KEPT
        if long.any():  # these take the last numbers, which are given anew after this batch
            order = np.argsort(long, kind="stable")
            place = np.append(np.arange(before), before + np.argsort(order))
            at, new = place[at], [new[k] for k in order.tolist()]
            for chunk in new:
                del self.kept[chunk]
            few = new[: len(new) - int(long.sum())]
            self.kept.update(zip(few, itertools.count(before), strict=False))
            self.kept.default_factory = itertools.count(len(self.kept)).__next__
        self.learn(new)
        begins = self.begins[at]
        sizes = self.begins[at + 1] - begins
        ids = self.known[_spread(begins, sizes)]
        self.begins = self.begins[: len(self.kept) + 1]
        self.known = self.known[: self.begins[-1]]
        return np.split(ids, np.append(0, np.cumsum(sizes))[np.cumsum(count)][:-1])

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        return list(map(np.ndarray.tolist, self.encode_arrays(texts)))

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0]

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        return b"".join(self.token_objects[np.asarray(ids, np.int64)].tolist()).decode("utf-8", errors="replace")


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(sizes.sum())) + np.repeat(begins - (ends - sizes), sizes)


def encode_documents(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """The columns of `docs` but the text, with `token_ids array<int>` and `round_trip`: the ids decode to the text."""
    tokens, trip = free_names(docs, "token_ids", "round_trip")
    rest = [f for f in docs.schema if f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.read(vocabulary)
        for batch in batches:
            for part in by_bytes(batch, text_col, TOGETHER_BYTES, TOGETHER):
                texts = texts_of(part.column(text_col))
                ids = bpe.encode_arrays(texts)
                same = [bpe.decode(i) == t for i, t in zip(ids, texts, strict=True)]
                columns = [part.column(f.name) for f in rest]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())],
                    [*[f.name for f in rest], tokens, trip],
                )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest]
    return docs.mapInArrow(tidied(run), ", ".join([*fields, f"`{tokens}` array<int>", f"`{trip}` boolean"]))


def decode_documents(encoded: DataFrame, vocabulary: str, tokens_col: str = "token_ids", text_col: str = "text") -> DataFrame:
    """The columns of `encoded` but the ids, with the text that they stand for (empty for null)."""
    rest = [f for f in encoded.schema if f.name not in (tokens_col, text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.read(vocabulary)
        for batch in batches:
            texts = [bpe.decode(i or []) for i in batch.column(tokens_col).to_pylist()]
            columns = [batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*[f.name for f in rest], text_col])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest]
    return encoded.mapInArrow(tidied(run), ", ".join([*fields, f"`{text_col}` string"]))


def encode_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Number of ids, and digests of ids and decoded text, one row per document; no texts leave the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.read(vocabulary)
        names = np.array([f",{i}" for i in range(len(bpe.token_bytes))], "S")
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            rows = []
            for part in by_bytes(batch, "_text", TOGETHER_BYTES, TOGETHER):
                for ids in bpe.encode_arrays(texts_of(part.column("_text"))):
                    text = names[ids].tobytes().translate(None, b"\0")[1:]  # shorter numbers are filled with zero bytes
                    rows.append((len(ids), sha(text), sha(bpe.decode(ids).encode())))
            n, digest, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(decoded, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    light = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = light.schema["_id"].dataType.simpleString()
    return light.mapInArrow(tidied(run), f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
