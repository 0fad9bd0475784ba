"""Documents whose word shingles overlap: a grouped prefix join with exact verification.

A document is the set of its word shingles, as 64-bit hashes. Equal sets are one node. In any fixed order of all
shingles, two sets that reach the wanted similarity share one of their first floor((100 - percent) / 100 * size) + 1
shingles, their prefixes. The order here is by hash, with the shingles of very many prefixes put last, so that a
passage which thousands of documents share does not bring all of them together.

1. Nodes with the same prefix and size are one group. A group has a cell for each shingle of its prefix and each of two
   classes of sizes, its own and the next, so groups whose sizes rule a link out hardly ever share one. Cells of one
   group only are left out; how many groups a cell has is counted over all of them, packed.
2. Groups of a cell meet the foremost of them; pairs of groups are filtered by size, expanded to nodes and verified, as
   `linking` says, first against the foremost nodes, then between the components that are left.

Classes are exact, while pairs within a class that is already connected are not listed. Bounded data alone goes to every
task: filters, and a list of at most `MOST_HOT` shingles that are put last; none decides about a result.

Defined results: a null, empty or blank text is a set of size 0 and linked with nothing; a text with fewer words than
a shingle has is one shingle; rows that repeat are of one class; a null id never is the least of its class unless
all are null; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerhouse.llm.common import discard, materialize, scramble, tidied
from brokerhouse.llm.linking import (
    AT_ONCE,
    MEETING,
    fine_allows,
    fine_sketch,
    least_of_classes,
    linked,
    nodes_of,
    read_sets,
    sets_reach,
    shared_cells,
    size_class,
    slices,
    tallied,
    texts_of_rows,
    whole_sets,
)

#: Shingles that are in more prefix pools than this are put last, the most frequent ones and at most so many.
HOT, MOST_HOT = 48, 500_000


def prefix_size(n: int, percent: int) -> int:
    """How many first shingles of a set of size n must hold one that is shared."""
    return n - (percent * n + 99) // 100 + 1


def _ordered(pool: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, int]:
    """The pool in the order of all shingles (by hash, hot ones last), and how many are not hot."""
    if not len(hot):
        return pool, len(pool)
    at = np.minimum(np.searchsorted(hot, pool), len(hot) - 1)
    late = hot[at] == pool
    return np.concatenate([pool[~late], pool[late]]), int((~late).sum())


def _is_short(n: int, pool: np.ndarray, hot: np.ndarray, percent: int) -> bool:
    """Whether a pool holds too few shingles that are not hot, so that the prefix is not known."""
    return len(pool) < n and _ordered(pool, hot)[1] < prefix_size(n, percent)


def _short_nodes(nodes: DataFrame, hot: np.ndarray, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            pools = [np.frombuffer(x, np.uint64) for x in part.column("_form").to_pylist()]
            keep = [_is_short(n, p, hot, percent) for n, p in zip(part.column("_n").to_pylist(), pools, strict=True)]
            yield part.select(names).filter(pa.array(keep, pa.bool_()))

    names = ["_node", "_key", "_h1", "_n", "_copies"]
    return nodes.select(*names, "_form").mapInArrow(tidied(run), "_node long, _key long, _h1 long, _n int, _copies long")


def _prefixes(nodes: DataFrame, column: str, hot: np.ndarray, percent: int) -> DataFrame:
    """`_node`, `_n`, `_copies`, `_g1` and `_g2` (equal for equal prefix and size), and `_prefix`.

    The column holds pools, and then short ones are left out, or whole sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            keep, groups, prefixes = [], [], []
            for n, packed in zip(part.column("_n").to_pylist(), part.column(column).to_pylist(), strict=True):
                pool = np.frombuffer(packed, np.uint64)
                keep.append(column == "_set" or not _is_short(n, pool, hot, percent))
                if keep[-1]:
                    prefixes.append(_ordered(pool, hot)[0][: prefix_size(n, percent)].tobytes())
                    groups.append(hashlib.sha256(prefixes[-1] + n.to_bytes(8, "little")).digest()[:16])
            kept = part.filter(pa.array(keep, pa.bool_()))
            both = np.frombuffer(b"".join(groups), np.int64).reshape(-1, 2)
            columns = [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(prefixes, pa.binary())]
            yield pa.RecordBatch.from_arrays([*[kept.column(c) for c in names], *columns], [*names, "_g1", "_g2", "_prefix"])

    names = ["_node", "_n", "_copies"]
    return nodes.select(*names, column).mapInArrow(
        tidied(run), "_node long, _n int, _copies long, _g1 long, _g2 long, _prefix binary"
    )


def _cells(groups: DataFrame, percent: int) -> DataFrame:
    """`_rep`, `_n`, `_copies` and `_cells`: keys of each shingle of the prefix with both classes of sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2048):
            classes = size_class(part.column("_n").to_numpy(), percent).astype(np.uint64)
            marks = np.stack([classes, classes + np.uint64(1)], axis=1) * _STEP
            prefixes = [np.frombuffer(packed, np.uint64) for packed in part.column("_prefix").to_pylist()]
            keys = [scramble((own[:, None] + prefix[None]).ravel()).tobytes() for own, prefix in zip(marks, prefixes, strict=True)]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(keys, pa.binary())], [*names, "_cells"])

    names = ["_rep", "_n", "_copies"]
    return groups.select(*names, "_prefix").mapInArrow(tidied(run), "_rep long, _n int, _copies long, _cells binary")


_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def links(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (`_id`, `_n`, `_node`), verified links between nodes (`a`, `b`), and their components (`node`, `component`).

    The links hold at least those that connect the components; every pair of nodes of different components has been ruled out.
    """
    texts = texts_of_rows(docs, text_col, id_col)
    # the pool is twice the prefix, by hash: hot shingles in it may move to the end
    read = read_sets(texts, words, lambda found: found[: 2 * prefix_size(len(found), percent)].tobytes())
    rows, nodes = nodes_of(read)
    discard(read)
    number = nodes.agg(F.coalesce(F.sum(F.length("_form") / 8), F.lit(0)).cast("long")).first()[0]
    often = tallied(nodes, "_form", number, HOT + 1)
    table = often.orderBy(F.desc("_times"), "_value").limit(MOST_HOT).toArrow()
    hot = np.sort(table.column("_value").to_numpy().view(np.uint64))
    spots = _prefixes(nodes, "_form", hot, percent)
    short = materialize(_short_nodes(nodes, hot, percent))
    if not short.isEmpty():
        whole = short.join(whole_sets(texts, short, words), "_node")
        spots = spots.unionByName(_prefixes(whole, "_set", hot, percent))
    spots = materialize(spots)

    first = materialize(spots.groupBy("_g1", "_g2").agg(F.max(F.struct("_copies", "_node")).alias("_top")).select(
        "_g1", "_g2", F.col("_top._node").alias("_rep")
    ))
    members = materialize(spots.select("_node", "_g1", "_g2").join(first, ["_g1", "_g2"]).select("_node", "_rep"))
    groups = spots.join(first.select(F.col("_rep").alias("_node")), "_node").withColumnRenamed("_node", "_rep")
    keyed = materialize(_cells(groups, percent))
    discard(spots)
    entries = shared_cells(keyed, "_cells", "_rep", "_n", "_copies", node="_rep")
    discard(keyed)
    found, parts = linked(entries, members, nodes, texts, words, percent, MEETING, AT_ONCE)
    return rows, found, parts


def classes(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, `n_shingles` (size of its set), `component_id` (least id reachable by links)."""
    rows, _, parts = links(docs, words, percent, id_col, text_col)
    return least_of_classes(rows, parts, id_col)


__all__ = ["classes", "fine_allows", "fine_sketch", "links", "prefix_size", "sets_reach"]
