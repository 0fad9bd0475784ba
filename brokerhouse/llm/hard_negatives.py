"""Hard negatives of anchors, with candidates ruled out by rotated one-bit codes.

Every vector is rotated once (sign flips and Hadamard transforms, by a fixed seed) and coded by the signs of its
components; beside the code stands its alignment with the vector, which gives the best multiple of the code, and the
length of what is left over. What is left over is coded by its signs in turn, `LEVELS` times. With y the rotated vector,
s a code, a its alignment and r the rest, y = a s + r with r at right angles to s, so for a rotated query q

    <y, q> = a <s, q> + <r, q>   and   |<r, q>| <= |r| * sqrt(|q|^2 - <s, q>^2 / |s|^2)   (Cauchy-Schwarz)

whatever the data are. <s, q> comes from popcounts: the query is cut into `PLANES` bit planes, and the length of what
that leaves out widens the interval. The same holds level by level. A pair whose interval cannot hold a score that is
still wanted is ruled out, by the first code or by later ones; the pairs that survive are scored in whole numbers.

1. Positives: for each anchor the first `positives` other rows of its label. 2. Negatives: rows of other labels whose score
lies between two shares of the positive's score, the first `negatives` for each anchor and positive. In both steps all rows
are dealt over blocks by a hash, so a label with most rows is spread like any other; every anchor (a stated set) goes to
every block, a task holds one block and reads the anchors as a stream, and the few best of each block meet in a window.

Defined results: rows with a null label, or a vector that is null, empty or holds null or non-finite components (256 times
them included), take no part; vectors of different length do not meet; a null id is a candidate but no anchor, and comes
last among ties; rows that repeat an id are rows of their own, and each is an anchor; a score beyond the range of a long
counts as the end of that range; an anchor without positives, or a positive without negatives, gives no row; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerhouse.llm.common import exact_products, free_names, materialize, quiet, tidied

#: Codes of a vector, and bit planes of a query.
LEVELS, PLANES = 5, 7
#: Bytes of the vectors in a block, rows of a block at least and at most.
BLOCK_BYTES, LEAST_ROWS, MOST_ROWS = 1 << 24, 4096, 32_768
#: Candidates scored first to get a bound of each range, of the so many that are estimated highest.
SEEDS, AHEAD = 12, 512
#: Anchors that are answered together.
TOGETHER = 64
_ROUNDS = 3
_LONG = (1 << 63) - 1


def padded(dim: int) -> int:
    """Components after the rotation: a power of two, and whole 64-bit words."""
    return max(64, 1 << (dim - 1).bit_length())


@quiet
def rotate(rows: np.ndarray) -> np.ndarray:
    """The rows turned by a fixed rotation; lengths and inner products stay."""
    n = padded(rows.shape[1])
    out = np.zeros((len(rows), n))
    out[:, : rows.shape[1]] = rows
    rng = np.random.default_rng(n)
    for _ in range(_ROUNDS):
        out *= rng.choice([-1.0, 1.0], n)
        step = 1
        while step < n:
            pairs = out.reshape(len(out), -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), n)
            step *= 2
        out /= math.sqrt(n)
    return out


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


@quiet
def encode(rows: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words), alignments and lengths of the rests (rows, levels)."""
    rest = rotate(rows)
    codes, aligned, left = [], [], []
    for _ in range(levels):
        signs = rest >= 0
        share = np.abs(rest).mean(1)
        rest = rest - np.where(signs, 1.0, -1.0) * share[:, None]
        codes.append(pack(signs))
        aligned.append(share)
        left.append(np.sqrt((rest**2).sum(1)))
    return np.stack(codes, 1), np.stack(aligned, 1), np.stack(left, 1)


class Query:
    """A rotated query in bit planes: q = low + step * (0 .. 2^planes - 1) + what is left out."""

    @quiet
    def __init__(self, turned: np.ndarray, planes: int = PLANES) -> None:
        self.length = float(np.sqrt((turned**2).sum()))
        self.low = float(turned.min())
        self.step = max((float(turned.max()) - self.low) / ((1 << planes) - 1), 1e-300)
        whole = np.rint((turned - self.low) / self.step)
        self.error = float(np.sqrt(((turned - self.low - self.step * whole) ** 2).sum()))
        bits = (whole.astype(np.int64)[None] >> np.arange(planes)[:, None]) & 1
        self.planes = pack(bits.astype(bool))
        # with s = 2 b - 1: <s, q> = sum over planes of step 2^k (2 |b & plane| - |plane|) + low (2 |b| - n)
        self.whole = self.step * float((2.0 ** np.arange(planes) * np.bitwise_count(self.planes).sum(1)).sum())

    def products(self, codes: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """<s, q> of each code, by popcounts; `codes` a row for each word, `ones`: how many bits each code has."""
        found = np.zeros(codes.shape[1], np.int32)
        for word, planes in zip(codes, self.planes.T, strict=True):
            for k, plane in enumerate(planes):
                found += np.left_shift(np.bitwise_count(word & plane), k, dtype=np.int32)
        return (2 * self.step) * found + (2 * self.low) * ones - (self.whole + 64 * len(codes) * self.low)


class Block:
    """Candidates with their codes; `pairs` counts those that were asked for, `scored` those that were scored."""

    def __init__(self, uids, ids, known, labels, rows: np.ndarray, codes: np.ndarray, aligned: np.ndarray, left: np.ndarray):
        by_label = np.argsort(labels, kind="stable")  # rows of a label lie together
        self.uids, self.ids, self.known, self.labels, self.rows = (x[by_label] for x in (uids, ids, known, labels, rows))
        self.codes = np.ascontiguousarray(codes[by_label].transpose(1, 2, 0))
        self.aligned, self.left = (np.ascontiguousarray(x[by_label].T) for x in (aligned, left))
        self.ones = np.bitwise_count(self.codes).sum(1, dtype=np.int32)
        with np.errstate(over="ignore"):
            self.lengths = np.sqrt((self.rows**2).sum(1))
        self.greatest = np.abs(self.rows).max(initial=0)
        self.pairs = self.scored = 0

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]).tolist())

    @quiet
    def refine(self, query: Query, level: int, some, sums: np.ndarray | float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Estimates of the candidates `some` (places or a slice) with one more code, and the ends of their intervals."""
        product = query.products(self.codes[level][:, some], self.ones[level][some])
        n, lengths, left = 64 * self.codes.shape[1], self.lengths[some], self.left[level][some]
        sums = sums + self.aligned[level][some] * product
        # <s, q> itself is known up to sqrt(n) * error, which may only shorten the part of q along the code
        along = np.maximum(np.abs(product) / math.sqrt(n) - query.error, 0)
        across = np.sqrt(np.maximum(query.length**2 - along * along, 0))
        # rounding must not rule out a pair
        wide = left * (across + query.error) + lengths * (query.error + 1e-9 * query.length) + 1e-6
        low, high = sums - wide, sums + wide
        # what is too great to reckon with rules nothing out; scores end where longs do
        unsure = ~np.isfinite(wide) | ~np.isfinite(sums)
        low, high = np.where(unsure, -np.inf, low), np.where(unsure, np.inf, high)
        return np.where(unsure, 0.0, sums), np.minimum(low, float(_LONG)), np.maximum(high, -float(_LONG))

    def score(self, vector: np.ndarray, some: np.ndarray) -> np.ndarray:
        self.scored += len(some)
        return exact_products(self.rows[some], vector, self.greatest)

    def best(self, scores: np.ndarray, some: np.ndarray, k: int) -> np.ndarray:
        """Places in `some` of the k greatest scores; known and smaller ids first among ties."""
        near = np.arange(len(some))
        if len(some) > 4 * k:
            near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        own = some[near]
        return near[np.lexsort((self.uids[own], self.ids[own], ~self.known[own], -scores[near]))[:k]]

    def search(
        self, uid: int, vector: np.ndarray, turned: np.ndarray, parts: list[slice], ranges: list[tuple[int, int]], k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each range (least, greatest score, both included) the k best candidates of the slices, but not row `uid`."""
        query = Query(turned)
        wanted = [(float(least), float(most)) for least, most in ranges]
        lowest, highest = min(least for least, _ in wanted), max(most for _, most in wanted)
        some, sums, low, high = [], [], [], []
        for part in parts:
            whole = self.refine(query, 0, part, 0.0)
            at = np.flatnonzero((whole[1] <= highest) & (whole[2] >= lowest))
            some.append(at + part.start)
            for out, values in zip((sums, low, high), whole, strict=True):
                out.append(values[at])
            self.pairs += part.stop - part.start
        some, sums, low, high = (np.concatenate(x) for x in (some, sums, low, high))
        other = self.uids[some] != uid
        if not other.all():
            some, sums, low, high = some[other], sums[other], low[other], high[other]
        wanted = self.narrowed(vector, some, sums, wanted, k)
        for level in range(1, len(self.codes) + 1):
            keep = np.zeros(len(some), bool)
            for least, most in wanted:
                keep |= (low <= most) & (high >= least)
            some, sums = some[keep], sums[keep]
            if level == len(self.codes) or len(some) <= k:
                break
            sums, low, high = self.refine(query, level, some, sums)
        scores = self.score(vector, some)
        out = []
        for least, most in ranges:
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            top = inside[self.best(scores[inside], some[inside], k)]
            out.append((some[top], scores[top]))
        return out

    def narrowed(self, vector: np.ndarray, some: np.ndarray, sums: np.ndarray, wanted: list, k: int) -> list[tuple[float, float]]:
        """The ranges from the k-th best of a few candidates on, which are scored: those estimated next under each range's end."""
        near = np.argpartition(-sums, AHEAD)[:AHEAD] if len(sums) > AHEAD else np.arange(len(sums))
        near = near[np.argsort(-sums[near])]
        begins = np.searchsorted(-sums[near], [-most for _, most in wanted])
        seeds = some[np.unique(np.concatenate([near[at : at + SEEDS] for at in begins]))]
        scores = np.sort(self.score(vector, seeds))
        out = []
        for least, most in wanted:
            inside = scores[np.searchsorted(scores, least) : np.searchsorted(scores, most, "right")]
            out.append((float(inside[-k]) if len(inside) >= k else least, most))
        return out


def score_range(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score of a negative: low/100 to high/100 of the positive's."""
    return -(-low * positive // 100), high * positive // 100


def _usable(vector: Column) -> Column:
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * 256.0) < F.lit(float("inf"))))
    return F.when((F.size(x) > 0) & finite, x)


def _coded(light: DataFrame, levels: int) -> DataFrame:
    """`_id`, `_label`, `_dim`, `_v` (whole numbers), `_codes`, `_form` (alignments, then lengths) of usable rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("_dim").to_numpy()
            for dim in np.unique(dims).tolist():
                of_dim = batch.filter(pa.array(dims == dim))
                for lo in range(0, of_dim.num_rows, step := max(16, (1 << 17) // padded(dim))):
                    part = of_dim.slice(lo, step)
                    rows = np.floor(256 * part.column("_x").flatten().to_numpy().reshape(-1, dim))
                    codes, aligned, left = encode(rows, levels)
                    both = np.concatenate([aligned, left], 1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[part.column(c) for c in ("_id", "_label", "_dim")],
                            _lists(rows),
                            pa.array([c.tobytes() for c in codes], pa.binary()),
                            _lists(both),
                        ],
                        ["_id", "_label", "_dim", "_v", "_codes", "_form"],
                    )

    return light.mapInArrow(
        tidied(run), "_id long, _label long, _dim int, _v array<double>, _codes binary, _form array<double>"
    )


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


def _arrays(parts: list[pa.RecordBatch], dim: int, levels: int) -> tuple[np.ndarray, ...]:
    table = pa.Table.from_batches(parts)
    ids = table.column("_id").combine_chunks()
    flat = lambda name: np.concatenate([p.column(name).flatten().to_numpy() for p in parts])
    form = flat("_form").reshape(-1, 2, levels)
    codes = np.frombuffer(b"".join(table.column("_codes").to_pylist()), np.uint64).reshape(-1, levels, padded(dim) // 64)
    return (
        table.column("_uid").to_numpy(),
        ids.fill_null(0).to_numpy(),
        ids.is_valid().to_numpy(zero_copy_only=False),
        table.column("_label").to_numpy(),
        flat("_v").reshape(-1, dim),
        codes,
        form[:, 0],
        form[:, 1],
    )


def _met(clean: DataFrame, anchors: DataFrame, blocks: int, levels: int, answer, schema: str) -> DataFrame:
    """Every anchor with every block of its dimension; `answer(block, row as a dict, vector, turned vector)` yields rows of `schema`.

    `anchors` holds `_uid`, `_id`, `_label`, `_dim`, `_v` and `_ranges`.
    """
    place = F.pmod(F.xxhash64("_uid"), F.lit(blocks)).cast("int")
    ranges = anchors.schema["_ranges"].dataType
    candidates = clean.select(
        "_dim", place.alias("_block"), F.lit(0).alias("_turn"), "_uid", "_id", "_label", "_v", "_codes", "_form",
        F.lit(None).cast(ranges).alias("_ranges"),
    )
    asked = anchors.select(
        "_dim", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"), F.lit(1).alias("_turn"), "_uid", "_id", "_label",
        "_v", F.lit(None).cast("binary").alias("_codes"), F.lit(None).cast("array<double>").alias("_form"), "_ranges",
    )
    both = candidates.unionByName(asked).repartition("_dim", "_block").sortWithinPartitions("_dim", "_block", "_turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at, block = None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("_dim", "_block", "_turn")], axis=1).astype(np.int64)
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(1)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                if lo == hi:
                    continue
                dim, number, turn = keys[lo].tolist()
                if at != (dim, number):
                    at, held, block = (dim, number), [], None
                part = batch.slice(lo, hi - lo)
                if not turn:
                    held.append(part)
                    continue
                if block is None and held:
                    block, held = Block(*_arrays(held, dim, levels)), []
                if block is None:  # a block without candidates
                    continue
                for k in range(0, part.num_rows, TOGETHER):
                    few = part.slice(k, TOGETHER)
                    vectors = few.column("_v").flatten().to_numpy().reshape(-1, dim)
                    light = few.select(["_uid", "_id", "_label", "_ranges"]).to_pylist()
                    rows = [row for one in zip(light, vectors, rotate(vectors), strict=True) for row in answer(block, *one)]
                    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names
                    )

    names = [field.split()[0] for field in schema.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32()}[field.split()[1]] for field in schema.split(", ")]
    return both.mapInArrow(tidied(run), schema)


def mine(
    vectors: DataFrame,
    anchor_every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    levels: int = LEVELS,
    block_rows: int | None = None,
) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`; shares in percent."""
    light = (
        vectors.select(
            F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("long").alias("_label"), _usable(F.col(vector_col)).alias("_x")
        )
        .where("_label is not null and _x is not null")
        .withColumn("_dim", F.size("_x"))
    )
    clean = materialize(_coded(light, levels).withColumn("_uid", F.monotonically_increasing_id()))
    count, dim = clean.agg(F.count("*"), F.max("_dim")).first()
    fits = block_rows or min(MOST_ROWS, max(LEAST_ROWS, BLOCK_BYTES // (8 * (dim or 1))))
    spread = math.ceil(count / LEAST_ROWS) if block_rows is None else 1  # few rows still make work for all cores
    blocks = max(1, math.ceil(count / fits), min(spread, vectors.sparkSession.sparkContext.defaultParallelism))
    anchors = clean.where(F.col("_id") % anchor_every == 0)

    def same_label(block: Block, row: dict, vector: np.ndarray, turned: np.ndarray) -> Iterator[tuple]:
        own = [block.of_label(row["_label"])]
        ((some, scores),) = block.search(row["_uid"], vector, turned, own, [(-_LONG - 1, _LONG)], positives)
        for at, score in zip(some.tolist(), scores.tolist(), strict=True):
            yield row["_uid"], row["_id"], int(block.ids[at]) if block.known[at] else None, int(block.uids[at]), score

    nothing = F.lit(None).cast("array<struct<_at:int,_score:long>>")
    schema = "_uid long, anchor_id long, positive_id long, _positive long, positive_score long"
    found = _met(clean, anchors.withColumn("_ranges", nothing), blocks, levels, same_label, schema)
    turn = F.expr("row_number() over (partition by _uid order by positive_score desc, positive_id asc nulls last, _positive)")
    chosen = materialize(found.withColumn("_at", turn).where(F.col("_at") <= positives).drop("_positive"))

    def other_labels(block: Block, row: dict, vector: np.ndarray, turned: np.ndarray) -> Iterator[tuple]:
        own = block.of_label(row["_label"])
        others = [slice(0, own.start), slice(own.stop, len(block.rows))]
        ranges = [score_range(x["_score"], low, high) for x in row["_ranges"]]
        found = block.search(row["_uid"], vector, turned, others, ranges, negatives)
        for x, (some, scores) in zip(row["_ranges"], found, strict=True):
            for at, score in zip(some.tolist(), scores.tolist(), strict=True):
                yield row["_uid"], x["_at"], int(block.ids[at]) if block.known[at] else None, int(block.uids[at]), score

    lists = chosen.groupBy("_uid").agg(
        F.array_sort(F.collect_list(F.struct("_at", F.col("positive_score").alias("_score")))).alias("_ranges")
    )
    schema = "_uid long, _at int, negative_id long, _negative long, negative_score long"
    met = _met(clean, anchors.join(lists, "_uid"), blocks, levels, other_labels, schema)
    turn = F.expr("row_number() over (partition by _uid, _at order by negative_score desc, negative_id asc nulls last, _negative)")
    few = met.withColumn("rank", turn).where(F.col("rank") <= negatives)
    return few.join(chosen, ["_uid", "_at"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def shifted_labels(vectors: DataFrame, every: int = 7, labels: int = 10, id_col: str = "vec_id", label_col: str = "label") -> DataFrame:
    """The vectors with the label (label + 1) % `labels` where the id is divisible by `every`."""
    (name,) = free_names(vectors, "_shifted")
    moved = F.when(F.col(id_col) % every == 0, (F.col(label_col) + 1) % labels).otherwise(F.col(label_col))
    return vectors.withColumn(name, moved).drop(label_col).withColumnRenamed(name, label_col)


__all__ = ["Block", "Query", "encode", "exact_products", "mine", "rotate", "score_range", "shifted_labels"]
