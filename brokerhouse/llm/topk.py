"""Exact top-k by inner product, with candidates ruled out by a table of distances to pivots.

For vectors q and x the inner product is (|q|^2 + |x|^2 - d(q, x)^2) / 2, and for any pivot p the distance d(q, x) is at
least |d(q, p) - d(x, p)|. The greatest of these bounds over many pivots gives an upper bound of the score. Within a
bucket of candidates, a query evaluates candidates in the order of their bounds and stops, exactly, where the next bound
is under its k-th best score. Pivots are chosen apart from each other, each the farthest from those before it, among
a bounded sample; the k-th best score within that sample is a bound that a query has in every bucket from the start.

Candidates are dealt over buckets of bounded bytes by a hash; queries are sent to every bucket (they are a stated set, and
must meet all rows). A task holds one bucket and reads the queries as a stream. The k best per query and bucket meet in a
window. Components are whole numbers: floor(256 * x).

Defined results: vectors that are null, empty or hold null or non-finite components (256 times them included) take no part;
vectors of different length do not meet; a null id is a candidate but no query, and comes last among ties; rows that
repeat an id are rows of their own, and each is a query; a score beyond the range of a long counts as the end of
that range; a table without queries, or empty, gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerhouse.llm.common import exact_products, materialize, quiet, sample_rows, tidied

#: Bytes of the vectors in a bucket, rows of a bucket at least and at most.
BUCKET_BYTES, LEAST_ROWS, MOST_ROWS = 1 << 24, 4096, 32_768
#: Pivots of vectors of one length; rows of the sample they are chosen from, and its bytes (eight lengths have so many).
PIVOTS, SAMPLE, SAMPLE_BYTES = 64, 1024, 1 << 22
#: Candidates that a query evaluates before it looks at its bound again; doubled each time.
FIRST = 64
#: Queries of a batch that share the table of bounds.
TOGETHER = 64
NO_BOUND = -(1 << 63)


def usable(vector: Column) -> Column:
    """The vector, null where it takes no part."""
    x = vector.cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * 256.0) < F.lit(float("inf"))))
    return F.when((F.size(x) > 0) & fine, x)


@quiet
def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (rows**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * (rows @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def apart(rows: np.ndarray, number: int) -> np.ndarray:
    """The first row and then, one by one, the row farthest from those taken: at most `number` different ones."""
    if not len(rows):
        return rows
    taken, near = [0], distances(rows, rows[:1])[:, 0]
    while len(taken) < number and np.nanmax(near, initial=0) > 0:
        taken.append(int(np.nanargmax(near)))
        near = np.minimum(near, distances(rows, rows[taken[-1:]])[:, 0])
        near[taken] = 0
    return rows[taken]


class Bucket:
    """Candidates of one bucket, with their pivot table. `pairs` and `evaluated` count those met and those scored."""

    def __init__(self, uids: np.ndarray, ids: np.ndarray, known: np.ndarray, rows: np.ndarray, pivots: np.ndarray) -> None:
        self.uids, self.ids, self.known, self.rows = uids, ids, known, rows
        with np.errstate(over="ignore"):
            self.norms = (rows**2).sum(1)
        self.table = np.ascontiguousarray(distances(rows, pivots).T)
        self.greatest = np.abs(rows).max(initial=0)
        self.pairs = self.evaluated = 0

    @quiet
    def bounds(self, vector: np.ndarray, to_pivots: np.ndarray) -> np.ndarray:
        """What the score of no candidate exceeds."""
        norm = float((vector**2).sum())
        least = np.zeros(len(self.rows))
        for row, d in zip(self.table, to_pivots.tolist(), strict=True):
            np.maximum(least, np.abs(row - d), out=least)
        # rounding must not rule out a candidate: bounds are a little wider, distances a little less
        bound = (norm + self.norms - least**2) / 2 + 1e-6 * (norm + self.norms) + 1e-6
        # what is too great to reckon with rules nothing out; scores end where longs do
        return np.clip(np.where(np.isnan(bound), np.inf, bound), float(NO_BOUND), -float(NO_BOUND))

    def best(self, uid: int, vector: np.ndarray, to_pivots: np.ndarray, k: int, least: int = NO_BOUND) -> list[tuple[int, int]]:
        """Row number and score of the k best candidates that reach `least`: greater scores, then known and smaller ids."""
        bound = self.bounds(vector, to_pivots)
        self.pairs += len(bound)
        open_ = np.flatnonzero((bound >= least) & (self.uids != uid))
        order = open_[np.argsort(-bound[open_])] if len(open_) > FIRST else open_
        if len(order) > 8 * FIRST:  # the foremost alone are put in order first
            near = np.argpartition(-bound[open_], FIRST)[:FIRST]
            scores = np.sort(exact_products(self.rows[open_[near]], vector, self.greatest))
            least = max(least, int(scores[-k])) if len(scores) >= k else least
            order = order[: int(np.searchsorted(-bound[order], -least, "right"))]
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, FIRST
        while at < len(order):
            if len(found) >= k and bound[order[at : at + step]].max() < scores[k - 1]:
                break
            some = order[at : at + step]
            self.evaluated += len(some)
            if 8 * len(some) > len(self.rows):  # so many are cheaper where they lie
                own = exact_products(self.rows, vector, self.greatest)[some]
            else:
                own = exact_products(self.rows[some], vector, self.greatest)
            found, scores = np.concatenate([found, some]), np.concatenate([scores, own])
            if len(found) > 16 * k:
                near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
                found, scores = found[near], scores[near]
            top = np.lexsort((self.ids[found], ~self.known[found], -scores))[:k]
            found, scores = found[top], scores[top]
            at, step = at + len(some), step * 2
        return [(f, s) for f, s in zip(found.tolist(), scores.tolist(), strict=True) if s >= least]


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    bucket: int | None = None,
    pivots: int = PIVOTS,
) -> DataFrame:
    """`query_id`, `rank`, the candidate's id and `score`, for the rows whose id is divisible by `every`."""
    light = vectors.select(F.col(id_col).cast("long").alias("_id"), usable(F.col(vector_col)).alias("_v")).where("_v is not null")
    clean = materialize(light.select("_id", "_v", F.size("_v").alias("_dim"), F.monotonically_increasing_id().alias("_uid")))
    count, dim = clean.agg(F.count("*"), F.max("_dim")).first()
    fits = bucket or min(MOST_ROWS, max(LEAST_ROWS, BUCKET_BYTES // (8 * (dim or 1))))
    spread = 1 if bucket else min(math.ceil(count / LEAST_ROWS), vectors.sparkSession.sparkContext.defaultParallelism)
    number = max(1, math.ceil(count / fits), spread)
    most = min(SAMPLE, max(1, SAMPLE_BYTES // (8 * (dim or 1))))
    drawn = sample_rows(clean, "_dim", "_uid", most, 8 * most).select(F.col("_uid").alias("_u"))
    sampled: dict[int, list] = {}
    for row in clean.join(F.broadcast(drawn), F.col("_uid") == F.col("_u")).select("_uid", "_v").orderBy("_uid").toLocalIterator():
        sampled.setdefault(len(row[1]), []).append((row[0], row[1]))
    samples = {
        n: (np.array([u for u, _ in rows]), np.floor(256 * np.array([v for _, v in rows], np.float64)))
        for n, rows in sampled.items()
    }
    chosen = {n: apart(rows, pivots) for n, (_, rows) in samples.items()}
    dealt = F.pmod(F.xxhash64("_uid"), F.lit(number)).cast("int")
    nothing = F.lit(NO_BOUND).cast("long").alias("_least")
    candidates = clean.select("_dim", dealt.alias("_bucket"), F.lit(0).alias("_query"), "_uid", "_id", "_v", nothing)
    asked = _first_bounds(clean.where(F.col("_id") % every == 0), samples, k)
    queries = asked.select(
        "_dim", F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias("_bucket"), F.lit(1).alias("_query"), "_uid", "_id", "_v", "_least"
    )
    both = candidates.unionByName(queries).repartition("_dim", "_bucket").sortWithinPartitions("_dim", "_bucket", "_query")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        place, now = None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("_dim", "_bucket", "_query")], axis=1).astype(np.int64)
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(1)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                if lo == hi:
                    continue
                dim, number_, query = keys[lo].tolist()
                part = batch.slice(lo, hi - lo)
                if place != (dim, number_):
                    place, held, now = (dim, number_), [], None
                if not query:
                    held.append(part)
                    continue
                origin = chosen.get(dim, np.zeros((0, dim)))
                if now is None:
                    now, held = Bucket(*_arrays(held, dim), origin), []
                uids, ids, _, rows = _arrays([part], dim)
                least = part.column("_least").to_pylist()
                for at in range(0, len(rows), TOGETHER):
                    near = distances(rows[at : at + TOGETHER], origin)
                    out = [
                        (uids[at + j], ids[at + j], c, s)
                        for j in range(len(near))
                        for c, s in now.best(int(uids[at + j]), rows[at + j], near[j], k, least[at + j])
                    ]
                    yield pack(out, now)

    def pack(out: list[tuple], now: Bucket) -> pa.RecordBatch:
        uid, query, row, score = (np.array(x, np.int64) for x in (zip(*out, strict=True) if out else [()] * 4))
        ids = pa.array(now.ids[row], pa.int64(), mask=~now.known[row])
        return pa.RecordBatch.from_arrays(
            [pa.array(uid), pa.array(query), ids, pa.array(score)], ["_uid", "query_id", "_candidate", "score"]
        )

    few = both.mapInArrow(tidied(run), "_uid long, query_id long, _candidate long, score long")
    rank = F.expr("row_number() over (partition by _uid order by score desc, _candidate asc nulls last)")
    best = few.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("_candidate").alias(id_col), "score")


def _first_bounds(queries: DataFrame, samples: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """The queries with `_least`, the k-th best score among the sampled rows but the query's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = []
            for uid, vector in zip(batch.column("_uid").to_pylist(), batch.column("_v"), strict=True):
                own, rows = samples.get(len(vector), (np.zeros(0, np.int64), np.zeros((0, len(vector)))))
                scores = exact_products(rows, np.floor(256 * vector.values.to_numpy()))[own != uid]
                least.append(int(np.partition(scores, -k)[-k]) if len(scores) >= k else NO_BOUND)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(least, pa.int64())], [*names, "_least"]
            )

    names = ["_dim", "_uid", "_id", "_v"]
    return queries.select(*names).mapInArrow(tidied(run), "_dim int, _uid long, _id long, _v array<double>, _least long")


def _arrays(parts: list[pa.RecordBatch], dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids (0 where null), which ids are known, and vectors in whole numbers."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros((0, dim))
    table = pa.Table.from_batches(parts)
    ids = table.column("_id").combine_chunks()
    rows = np.concatenate([p.column("_v").flatten().to_numpy() for p in parts]).reshape(-1, dim)
    return (
        table.column("_uid").to_numpy(),
        ids.fill_null(0).to_numpy(),
        ids.is_valid().to_numpy(zero_copy_only=False),
        np.floor(256 * rows),
    )
