"""Links between sets of word shingles: what joins by prefixes and by minwise hashes have in common.

Rows with equal sets are one node, known by a number. Some rule puts nodes, or groups of them, into cells, so that nodes
which reach the wanted similarity share a cell. Cells may be huge, so pairs are found in two steps:

1. All groups of a cell meet the foremost of them, and all nodes of a group the group's own: as many pairs as there are
   entries. Pairs are checked by sketches of the sets (bounds that never rule out a link), small ones and then finer ones,
   and verified on whole sets.
2. Components of the links found so far need no more pairs within themselves. What is left are pairs in cells that hold
   nodes of different components, a group that shares no cell being one by itself. These meet in blocks, where sketches leave few pairs, and are verified as well, all of
   them; no list of all pairs is ever made.

So every link between different components is found, and components are exact; pairs within a component that is already
connected are not listed. Only filters whose size follows the number of their keys, up to a bound, go to every task; beyond
the bound they let more rows pass, and joins decide.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerhouse.llm.common import bloom_bits, by_bytes, discard, in_bloom, materialize, shingle_sets, tidied
from brokerhouse.llm.components import components

#: Numbers of shingles by the last bits of their hash: two sets share at most the sum of the lesser numbers.
COUNTED = 128
#: Nodes of one cell that meet each other at a time, and how many pairs are looked at together.
MEETING, AT_ONCE = 512, 32_768
#: Of the cells of a node, so many go with it: the least ones, so that two nodes which share many cells meet in few of them.
LEAST_CELLS = 8
#: What a node is in a part of a cell (flags).
MEETS, IS_MET, MINOR = 1, 2, 4
#: Words of a filter, at least and at most (64 megabytes).
FEW_WORDS, MOST_WORDS = 1 << 14, 1 << 23
#: Keys that one slot of a tally should hold, and slots there are at least, as a power of two: many, so that tasks get like shares.
SLOT, SLOT_BITS = 1 << 21, 9
#: Bytes of packed keys that a task works on at a time.
PACKED = 1 << 22


def digest(found: np.ndarray) -> tuple[int, int]:
    """Two longs that tell sets apart."""
    return tuple(np.frombuffer(hashlib.sha256(found.tobytes()).digest()[:16], np.int64).tolist())


def sketch(found: np.ndarray) -> bytes:
    """How many shingles fall into each of `COUNTED` classes; empty where a number does not fit a byte."""
    numbers = np.bincount((found & np.uint64(COUNTED - 1)).astype(np.int64), minlength=COUNTED)
    return numbers.astype(np.uint8).tobytes() if numbers.max(initial=0) < 256 else b""


def fine_sketch(found: np.ndarray) -> bytes:
    """How many shingles fall into each of as many classes as the set has shingles, at least (a power of two), two
    numbers a byte; empty where a number does not fit four bits. It takes a sixteenth to an eighth of the set's bytes."""
    number = 1 << max(1, (len(found) - 1).bit_length())
    classes = np.bincount((found & np.uint64(number - 1)).astype(np.int64), minlength=number)
    if classes.max() > 15:
        return b""
    few = classes.astype(np.uint8)
    return (few[::2] | few[1::2] << 4).tobytes()


def _fine_numbers(packed: bytes) -> np.ndarray:
    both = np.frombuffer(packed, np.uint8)
    return np.stack([both & 15, both >> 4], axis=1).ravel().astype(np.int64)


def fine_allows(x: bytes, y: bytes, percent: int) -> bool:
    """Whether two sets may reach the similarity by their fine sketches: never false for sets that do."""
    if not (x and y):
        return True
    p, q = sorted((_fine_numbers(x), _fine_numbers(y)), key=len)
    both = int(np.minimum(p, q.reshape(-1, len(p)).sum(0)).sum())
    return 100 * both >= percent * (int(p.sum()) + int(q.sum()) - both)


def sets_reach(x: bytes, y: bytes, percent: int) -> bool:
    """Whether two whole sets reach the similarity."""
    few, many = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    at = np.minimum(np.searchsorted(many, few), len(many) - 1)
    both = int((many[at] == few).sum())
    return 100 * both >= percent * (len(few) + len(many) - both)


def sizes_allow(x: str, y: str, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def size_class(n: np.ndarray, percent: int) -> np.ndarray:
    """Classes of sizes: two sizes that allow the similarity are in the same class or in neighbouring ones."""
    return np.floor(np.log(np.maximum(n, 1)) / math.log(100 / percent) + 1e-9).astype(np.int64)


def ends(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def filter_of(keys: DataFrame, column: str) -> np.ndarray:
    """A filter over a written table's 64-bit keys, about ten bits a key up to its greatest size."""
    words = 1 << max(0, math.ceil(math.log2(max(1, keys.count() * 10 / 64))))
    return bloom_bits(keys, column, min(max(words, FEW_WORDS), MOST_WORDS))


def texts_of_rows(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """`_id`, `_text` (null as empty) and `_key`, a hash of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_key"))


def read_sets(texts: DataFrame, words: int, form: Callable[[np.ndarray], bytes]) -> DataFrame:
    """`_id`, `_key`, `_h1`, `_h2` (the set's digest), `_n`, `_sketch`, `_form` (what `form` makes of a set), `_uid`; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "_text", rows=512):
                sets = list(shingle_sets(part.column("_text"), words))
                h1, h2 = zip(*map(digest, sets), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id"),
                        part.column("_key"),
                        pa.array(h1, pa.int64()),
                        pa.array(h2, pa.int64()),
                        pa.array(map(len, sets), pa.int32()),
                        pa.array(map(sketch, sets), pa.binary()),
                        pa.array([form(x) if len(x) else b"" for x in sets], pa.binary()),
                    ],
                    ["_id", "_key", "_h1", "_h2", "_n", "_sketch", "_form"],
                )

    kind = texts.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, _key long, _h1 long, _h2 long, _n int, _sketch binary, _form binary"
    read = texts.mapInArrow(tidied(run), schema)
    return materialize(read.withColumn("_uid", F.monotonically_increasing_id()))


def nodes_of(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (`_id`, `_n`, `_node`; null where the set is empty), and one row a node (`_node`, `_copies` and its columns)."""
    full = read.where("_n > 0")
    # rows are told apart by digests alone; the other columns follow for one row of each node
    first = materialize(full.groupBy("_h1", "_h2").agg(F.min("_uid").alias("_node"), F.count("*").alias("_copies")))
    light = full.select("_id", "_n", "_h1", "_h2").join(first.drop("_copies"), ["_h1", "_h2"]).select("_id", "_n", "_node")
    rows = materialize(light.unionByName(read.where("_n = 0").select("_id", "_n", F.lit(None).cast("long").alias("_node"))))
    own = first.select("_node", "_h1", "_copies").join(
        full.select(F.col("_uid").alias("_node"), "_key", "_n", "_sketch", "_form"), "_node"
    )
    return rows, materialize(own)


def whole_sets(texts: DataFrame, wanted: DataFrame, words: int, form: Callable[[np.ndarray], bytes] = np.ndarray.tobytes) -> DataFrame:
    """`_node` and its whole set, in the form given, once for each wanted node (`_node`, `_h1`, `_key`: hash of a text with this set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column("_key").to_numpy()
            batch = batch.filter(pa.array(in_bloom(bits, keys)))
            for part in by_bytes(batch, "_text", rows=256):
                new = []
                for key in part.column("_key").to_pylist():
                    new.append(key not in seen)
                    if len(seen) < 1 << 20:
                        seen.add(key)
                part = part.filter(pa.array(new, pa.bool_()))
                sets = list(shingle_sets(part.column("_text"), words))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_key"),
                        pa.array([digest(x)[0] for x in sets], pa.int64()),
                        pa.array([form(x) if len(x) else b"" for x in sets], pa.binary()),
                    ],
                    ["_key", "_h1", "_set"],
                )

    bits = filter_of(wanted, "_key")
    found = texts.select("_key", "_text").mapInArrow(tidied(run), "_key long, _h1 long, _set binary")
    both = found.join(wanted.select("_key", "_h1", "_node"), ["_key", "_h1"]).select("_node", "_set")
    return materialize(both.dropDuplicates(["_node"]))


def tallied(packed: DataFrame, column: str, number: int, least: int = 2) -> DataFrame:
    """`_value` and `_times` of the 64-bit values of a binary column that occur at least `least` times, as a written table.

    `number`: about how many values there are. Values travel packed, eight bytes each with their counts, added up before.
    """
    bits = max(SLOT_BITS, math.ceil(math.log2(max(2, number / SLOT))))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, column, PACKED, 1 << 15):
                own = np.frombuffer(b"".join(x for x in part.column(column).to_pylist() if x), np.uint64)
                yield packed_slots(*np.unique(own, return_counts=True))

    def packed_slots(values: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        slot = values >> np.uint64(64 - bits)
        cuts = np.append(np.flatnonzero(np.diff(slot, prepend=slot[:1] + np.uint64(1))), len(values)).tolist()
        pieces = list(zip(cuts, cuts[1:], strict=False))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int(slot[a]) for a, _ in pieces], pa.int32()),
                pa.array([values[a:b].tobytes() for a, b in pieces], pa.binary()),
                pa.array([np.minimum(times[a:b], 0xFFFFFFFF).astype(np.uint32).tobytes() for a, b in pieces], pa.binary()),
            ],
            ["_slot", "_values", "_counts"],
        )

    def add(values: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if len(values) == 1:
            return values[0], times[0]
        distinct, place = np.unique(np.concatenate(values), return_inverse=True)
        return distinct, np.bincount(place, np.concatenate(times), len(distinct)).astype(np.int64)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, values, times, size = None, [], [], 0

        def out() -> pa.RecordBatch:
            distinct, sums = add(values, times) if values else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            keep = sums >= least
            return pa.RecordBatch.from_arrays([pa.array(distinct[keep].view(np.int64)), pa.array(sums[keep])], ["_value", "_times"])

        for batch in batches:
            for slot, own, counts in zip(*(batch.column(c).to_pylist() for c in ("_slot", "_values", "_counts")), strict=True):
                if slot != now:
                    yield out()
                    now, values, times, size = slot, [], [], 0
                values.append(np.frombuffer(own, np.uint64))
                times.append(np.frombuffer(counts, np.uint32).astype(np.int64))
                size += len(values[-1])
                if size > 4 * SLOT:  # repeats are added up as they come
                    distinct, sums = add(values, times)
                    values, times, size = [distinct], [sums], 0
        yield out()

    slots = packed.select(column).mapInArrow(tidied(spread), "_slot int, _values binary, _counts binary")
    dealt = slots.repartition("_slot").sortWithinPartitions("_slot")
    return materialize(dealt.mapInArrow(tidied(gather), "_value long, _times long"))


def shared_cells(keyed: DataFrame, column: str, *others: str, node: str) -> DataFrame:
    """`_cell` and the columns `others`: a row for each 64-bit key of a binary column that rows of other nodes have too; written.

    Of keys that are shared by the same nodes, one stays. A node that shares no key gets no row; `linked` sees to the pairs in it. A row should hold a key once, and a node have one row.
    """
    number = keyed.agg(F.coalesce(F.sum(F.length(column) / 8), F.lit(0)).cast("long")).first()[0]
    shared = tallied(keyed, column, number)
    bits = filter_of(shared, "_value")
    discard(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, column, PACKED, 1 << 15):
                packed = [np.frombuffer(x or b"", np.int64) for x in part.column(column).to_pylist()]
                owner = np.repeat(np.arange(len(packed)), [len(x) for x in packed])
                keys = np.concatenate(packed)
                keep = in_bloom(bits, keys)
                rest = [part.column(c).take(pa.array(owner[keep])) for c in others]
                yield pa.RecordBatch.from_arrays([pa.array(keys[keep]), *rest], ["_cell", *others])

    kinds = ", ".join(f"{c} {keyed.schema[c].dataType.simpleString()}" for c in others)
    near = materialize(keyed.select(column, *others).mapInArrow(tidied(run), f"_cell long, {kinds}"))
    marks = [F.expr(f"bit_xor(xxhash64({node}, {k}))").alias(f"_mark{k}") for k in range(2)]
    cells = near.groupBy("_cell").agg(F.count("*").alias("_entries"), *marks).where("_entries > 1")
    kept = materialize(cells.groupBy("_entries", "_mark0", "_mark1").agg(F.min("_cell").alias("_cell")).select("_cell"))
    out = materialize(near.join(kept, "_cell", "left_semi"))
    discard(near)
    return out


def possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (`a`, `b`) that may reach the similarity by the sketches of their nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = bytes([255]) * COUNTED
        for part in slices(batches, 4096):
            x, y = (
                np.frombuffer(b"".join(s or full for s in part.column(c).to_pylist()), np.uint8).reshape(-1, COUNTED)
                for c in ("_x", "_y")
            )
            n, m = (part.column(c).to_numpy().astype(np.int64) for c in ("_n", "_m"))
            both = np.minimum(x, y).sum(1, dtype=np.int64)
            open_ = np.array([not (s and t) for s, t in zip(part.column("_x").to_pylist(), part.column("_y").to_pylist(), strict=True)], bool)
            both = np.where(open_, np.minimum(n, m), both)
            keep = 100 * both >= percent * (n + m - both)
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = nodes.select(F.col("_node").alias("a"), F.col("_n"), F.col("_sketch").alias("_x"))
    two = nodes.select(F.col("_node").alias("b"), F.col("_n").alias("_m"), F.col("_sketch").alias("_y"))
    both = pairs.join(two, "b").join(one, "a").select("a", "b", "_n", "_m", "_x", "_y")
    return both.mapInArrow(tidied(run), "a long, b long")


def _parts_of_cells(rows: pa.Table) -> np.ndarray:
    """Numbers of the parts of cells of sorted rows, from 0."""
    keys = np.stack([rows.column(c).to_numpy() for c in ("_cell", "_i", "_j")], axis=1)
    return np.concatenate([[0], np.cumsum((np.diff(keys, axis=0) != 0).any(1))])


def meetings(members: DataFrame, nodes: DataFrame, percent: int, meeting: int = MEETING, at_once: int = AT_ONCE) -> DataFrame:
    """Pairs of nodes of different components that share a cell (`_cell`, `_node`, `_part`, `_minor`), and may reach the
    similarity by their sketches.

    At least one of two components is not the cell's main one, so its nodes meet all others. The nodes of a cell
    are dealt into blocks of about `meeting`, and a task holds two blocks at a time, however many nodes share a cell.
    Two nodes meet in every cell that they share; where one of their least cells is common to both, they are left out of
    all greater ones, so a pair comes out of the first of its cells, and hardly ever of more.
    """

    def pairs(part: pa.Table, place: np.ndarray) -> Iterator[pa.RecordBatch]:
        role, n = part.column("_role").to_numpy(), part.column("_n").to_numpy().astype(np.int64)
        raw = part.column("_sketch").to_pylist()
        known = np.array([bool(s) for s in raw])
        numbers = np.frombuffer(b"".join(s or bytes(COUNTED) for s in raw), np.uint8).reshape(-1, COUNTED)
        unit, node, cell = (part.column(c).to_numpy() for c in ("_part", "_node", "_cell"))
        lists = part.column("_least").combine_chunks()
        least = lists.flatten().to_numpy().reshape(len(role), LEAST_CELLS)
        x, y = np.flatnonzero(role & MEETS), np.flatnonzero(role & IS_MET)
        first = np.searchsorted(place[y], place[x])
        number = np.searchsorted(place[y], place[x], "right") - first
        ends_ = np.cumsum(number)
        lo = 0
        while lo < len(x):
            hi = max(lo + 1, int(np.searchsorted(ends_, ends_[lo] - number[lo] + at_once, "right")))
            some = number[lo:hi]
            i = np.repeat(x[lo:hi], some)
            j = y[np.arange(len(i)) + np.repeat(first[lo:hi] - np.cumsum(some) + some, some)]
            # two minor nodes meet twice, each as the one that meets: the one of lower number is enough
            keep = (unit[i] != unit[j]) & ((role[j] & MINOR == 0) | (node[i] <= node[j]))
            keep &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            i, j = i[keep], j[keep]
            both = np.minimum(numbers[i], numbers[j]).sum(1, dtype=np.uint16).astype(np.int64)  # at most 255 * COUNTED
            both = np.where(known[i] & known[j], both, np.minimum(n[i], n[j]))
            keep = 100 * both >= percent * (n[i] + n[j] - both)
            i, j = i[keep], j[keep]
            before = np.zeros(len(i), bool)
            for k in range(LEAST_CELLS):
                own = least[i, k]
                before |= (own < cell[i]) & (least[j] == own[:, None]).any(1)
            i, j = i[~before], j[~before]
            yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j])], ["a", "b"])
            lo = hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            place = _parts_of_cells(held)
            done = int(np.searchsorted(place, place[-1]))  # the last part may go on in the next batch
            if done:
                yield from pairs(held.slice(0, done), place[:done])
                held = held.slice(done).combine_chunks()
        if held is not None:
            yield from pairs(held, _parts_of_cells(held))

    sizes = materialize(
        members.groupBy("_cell").agg(
            F.ceil(F.count("*") / meeting).cast("int").alias("_blocks"),
            F.ceil(F.sum(F.col("_minor").cast("int")) / meeting).cast("int").alias("_minors"),
        ).where("_minors > 0")
    )
    few = F.concat(F.array_sort(F.collect_list("_cell")), F.array_repeat(F.lit((1 << 63) - 1), LEAST_CELLS))
    there = members.groupBy("_node").agg(F.slice(few, 1, LEAST_CELLS).alias("_least"))
    there = materialize(there.join(nodes.select("_node", "_n", "_sketch"), "_node"))
    dealt = members.join(there, "_node").join(sizes, "_cell")
    others, own = F.sequence(F.lit(0), F.col("_minors") - 1), F.sequence(F.lit(0), F.col("_blocks") - 1)
    place = lambda blocks: F.pmod(F.xxhash64("_node"), F.col(blocks)).cast("int")
    is_minor = F.when(F.col("_minor"), MINOR).otherwise(0)
    # a node is met in its block by all blocks of minor nodes; a minor node meets in one of these parts as well ...
    met_by = dealt.withColumn("_i", F.explode(others)).withColumn("_j", place("_blocks"))
    meets_too = F.when(F.col("_minor") & (F.col("_i") == place("_minors")), MEETS).otherwise(0)
    columns = ("_cell", "_i", "_j", "_node", "_part", "_n", "_sketch", "_least")
    every = met_by.select(*columns, (F.lit(IS_MET) + is_minor + meets_too).alias("_role"))
    # ... and in the other blocks
    going = dealt.where("_minor AND _blocks > 1").withColumn("_i", place("_minors")).withColumn("_j", F.explode(own))
    minor = going.where(F.col("_j") != place("_blocks")).select(*columns, F.lit(MEETS + MINOR).alias("_role"))
    met = minor.unionByName(every).repartition("_cell", "_i", "_j").sortWithinPartitions("_cell", "_i", "_j")
    return met.mapInArrow(tidied(run), "a long, b long").select(*ends("a", "b"))


def _ruled(pairs: DataFrame, forms: DataFrame, rule: Callable[[bytes, bytes, int], bool], percent: int) -> DataFrame:
    """The pairs (`a`, `b`) whose nodes' forms (`_node`, `_set`) pass a rule."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2048):
            keep = [rule(x.as_py(), y.as_py(), percent) for x, y in zip(part.column("_x"), part.column("_y"), strict=True)]
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(forms.select(F.col("_node").alias("b"), F.col("_set").alias("_y")), "b").join(
        forms.select(F.col("_node").alias("a"), F.col("_set").alias("_x")), "a"
    )
    return materialize(both.select("a", "b", "_x", "_y").mapInArrow(tidied(run), "a long, b long"))


def verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, percent: int, sketched: bool = False) -> DataFrame:
    """The pairs (`a`, `b`) of nodes whose whole sets reach the similarity."""
    # most pairs are ruled out by sketches of fixed size, and most others by those that grow with the set, before any
    # whole set is fetched
    pairs = materialize(pairs) if sketched else materialize(possible(pairs, nodes, percent))
    for form, rule in ((fine_sketch, fine_allows), (np.ndarray.tobytes, sets_reach)):
        both = pairs.select(F.col("a").alias("_node")).unionByName(pairs.select(F.col("b").alias("_node"))).distinct()
        wanted = materialize(both.join(nodes.select("_node", "_key", "_h1"), "_node"))
        forms = whole_sets(texts, wanted, words, form)
        pairs = _ruled(pairs, forms, rule, percent)
        discard(forms)
    return pairs


def linked(
    entries: DataFrame,
    members: DataFrame,
    nodes: DataFrame,
    texts: DataFrame,
    words: int,
    percent: int,
    meeting: int = MEETING,
    at_once: int = AT_ONCE,
) -> tuple[DataFrame, DataFrame]:
    """Links between nodes (`a`, `b`), and their components (`node`, `component`).

    `entries`: a row for each group and each of its cells (`_cell`, `_rep`: the group's foremost node, `_n`, `_copies`);
    `members`: a row for each node (`_node`, `_rep`); `nodes`: `_node`, `_key`, `_h1`, `_n`, `_sketch`. All are written tables.
    """
    # what is joined by a cell is written first, so that a cell with very many entries can be split
    foremost = materialize(
        entries.groupBy("_cell")
        .agg(F.max(F.struct("_copies", "_rep", "_n")).alias("_top"), F.count("*").alias("_entries"))
        .where("_entries > 1")
        .select("_cell", F.col("_top._rep").alias("_top"), F.col("_top._n").alias("_m"))
    )
    across = (
        entries.join(foremost, "_cell").where((F.col("_rep") != F.col("_top")) & sizes_allow("_n", "_m", percent)).select(*ends("_rep", "_top"))
    )
    inside = members.where("_node <> _rep").select(*ends("_node", "_rep"))
    tried = materialize(across.unionByName(inside).distinct())
    found = verified(tried, nodes, texts, words, percent)
    parts = materialize(components(found))

    placed = materialize(
        members.join(parts.withColumnRenamed("node", "_node"), "_node", "left").select(
            "_node", "_rep", F.coalesce("component", "_node").alias("_part")
        )
    )
    spread = placed.groupBy("_rep").agg(
        F.min("_part").alias("_lo"), F.max("_part").alias("_hi"), F.max(F.when(F.col("_node") == F.col("_rep"), F.col("_part"))).alias("_own")
    )
    columns = ("_cell", "_rep", "_copies", "_lo", "_hi", "_own")
    # a group without a shared cell has no entry: where its nodes are not all connected, it is a cell by itself
    alone = spread.where("_lo <> _hi").join(entries.select("_rep").distinct(), "_rep", "left_anti")
    alone = alone.withColumns({"_cell": F.xxhash64("_rep"), "_copies": F.lit(0).cast("long")}).select(*columns)
    parted = materialize(entries.join(spread, "_rep").select(*columns).unionByName(alone))
    open_ = materialize(
        parted.groupBy("_cell")
        .agg(F.min("_lo").alias("_least"), F.max("_hi").alias("_most"), F.max(F.struct("_copies", "_own")).alias("_top"))
        .where("_least <> _most")
        .select("_cell", F.col("_top._own").alias("_main"))
    )
    there = parted.select("_cell", "_rep").join(open_, "_cell").join(placed, "_rep").select(
        "_cell", "_node", "_part", (F.col("_part") != F.col("_main")).alias("_minor")
    )
    rest = meetings(materialize(there), nodes, percent, meeting, at_once).distinct()
    rest = materialize(rest.join(tried, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        more = verified(rest, nodes, texts, words, percent, sketched=True)
        if not more.isEmpty():
            found = found.unionByName(more)
            parts = materialize(components(found))
    return found, parts


def least_of_classes(rows: DataFrame, parts: DataFrame, id_col: str) -> DataFrame:
    """One row per document: id, `n_shingles` (size of its set), `component_id` (least id reachable by links)."""
    full = rows.where("_node is not null").join(parts.withColumnRenamed("node", "_node"), "_node", "left")
    placed = materialize(full.select("_id", "_n", F.coalesce("component", "_node").alias("_part")))
    # written before it is joined: a class that holds most documents can then be split
    least = materialize(placed.groupBy("_part").agg(F.min("_id").alias("_least")))
    both = placed.join(least, "_part").select("_id", "_n", "_least")
    empty = rows.where("_node is null").select("_id", "_n", F.col("_id").alias("_least"))
    return both.unionByName(empty).select(
        F.col("_id").alias(id_col), F.col("_n").cast("long").alias("n_shingles"), F.col("_least").alias("component_id")
    )
