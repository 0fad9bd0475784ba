"""Faults of conversations and their cheapest repair, chosen by prefix-doubling path ranking.

A conversation's roles should read: at most one system turn first, then user and assistant in turn; or nothing at all.
Edits: Keep a row for 0, give it the role user or assistant (Rerole) for 2, Delete it for 3, Insert an empty user or
assistant turn for 2; a truncated row that stays adds 1; blank and repeated rows must go.

1. Costs: a node is a place between rows together with what was said last (nothing, system, user, assistant). From the
   last place back, the least cost to the end of every node follows from the nodes after it.
2. Ranks: arcs on cheapest paths stay, each with its initial (D, I, K, R). They are ranked by the first initial of the least
   audit that begins with them, then by the first 2, 4, 8, ... initials: the rank of twice the length is that of
   the pair (own rank, rank of the arc so many initials on). What has reached the end ranks before any initial.
3. Of the arcs that leave a node, the one of least rank is taken. Pointers from arc to arc, doubled, give all arcs of the
   least path at once, and their initials are the audit.

Only a byte per row (its role's initial and its fault) is gathered for a conversation, from a stream sorted by conversation
and row; texts stay in the rows. The audit, a byte or so per row as well, meets the rows again in a second stream,
where the repaired text is hashed row by row: the hash of a whole conversation is made in order by nature, so one task reads
a conversation's rows, but never holds them. First appearances of a role and text are found before, by a minimum that is
combined before its shuffle. Many short conversations are ranked together; long ones in stretches of `STRETCH` rows.

Defined results: nulls of any column count as one space (a null turn comes first, and takes no part in gaps); a null id is a
conversation of its own; rows of one turn go by role and the text's SHA-256; a role whose first character is none of
s, u, a can only be changed or deleted; an empty table gives an empty result; a conversation without rows after damage
has zeros, an empty audit and the hash of the empty text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerhouse.llm.common import materialize, tidied

#: What was said last. Nothing and assistant are ends.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NO_WAY = 1 << 40
#: What was said last after a row that is kept (by its initial: s, u, a, any other), and after a turn that an edit puts there.
AFTER_KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
AFTER_PUT = np.array([USER, USER, ASSISTANT, USER])
#: Faults, in the order in which they count.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, INSERT, REROLE, DELETE, TRUNCATED_STAYS = 0, 2, 2, 3, 1
#: Initials in ASCII order; the end of a path comes before them.
INITIALS = np.frombuffer(b"DIKR", np.uint8)
#: Rows that are ranked together at most, and initials of paths that are written out together.
STRETCH, TOGETHER = 4096, 1 << 20
WHITE = " \t\n\x0b\x0c\r"
#: What a conversation without rows has.
NO_TEXT = hashlib.sha256(b"").hexdigest()
NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def row_arcs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cost and following state of deleting, keeping and reroling each row in each state: (rows, 4 states, 3)."""
    initials, faults = codes % 4, codes // 4
    stays = ((faults != BLANK) & (faults != DUPLICATE))[:, None]
    extra = np.where(faults == TRUNCATED, TRUNCATED_STAYS, 0)[:, None]
    kept = AFTER_KEPT.T[initials]
    to = np.stack([np.broadcast_to(np.arange(4), kept.shape), np.maximum(kept, 0), np.broadcast_to(AFTER_PUT, kept.shape)], 2)
    cost = np.full(to.shape, NO_WAY, np.int64)
    cost[:, :, 0] = DELETE
    cost[:, :, 1] = np.where(stays & (kept >= 0), KEEP + extra, NO_WAY)
    cost[:, :, 2] = np.where(stays, REROLE + extra, NO_WAY)
    return cost, to


def closed(costs: np.ndarray) -> np.ndarray:
    """Least costs of the four states of a place, by way of inserted turns too: two in a row reach all that is worth it."""
    for _ in range(2):
        costs = np.minimum(costs, costs[..., AFTER_PUT] + INSERT)
    return costs


ENDS = np.array([0, NO_WAY, NO_WAY, 0], np.int64)


class Stretch:
    """Rows of several conversations, or a piece of one, with the least costs to the end from every place and state.

    `ends`: for each conversation the least costs of its last place (closed where the rows go on beyond the stretch).
    Node 4 * place + state; a conversation has one place more than rows.
    """

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> None:
        self.cost, self.to = row_arcs(codes)
        self.lengths = lengths
        self.last = np.cumsum(lengths + 1) - 1  # place
        self.first = self.last - lengths
        self.costs = np.empty((len(codes) + len(lengths), 4), np.int64)
        after = np.cumsum(lengths)  # row after the conversation's last one
        by_length = np.argsort(-lengths, kind="stable")
        now = self.costs[self.last] = closed(ends)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            own = by_length[: np.searchsorted(-lengths[by_length], -back, "right")]
            row = after[own] - back
            ways = self.cost[row] + np.take_along_axis(now[own], self.to[row].reshape(len(own), 12), 1).reshape(-1, 4, 3)
            now[own] = closed(ways.min(2))
            self.costs[self.last[own] - back] = now[own]

    def starts(self) -> np.ndarray:
        return self.costs[self.first]

    def audits(self, states: np.ndarray, go_on: bool) -> tuple[list[bytes], np.ndarray]:
        """The least audit of each conversation from the states of its first place, and the states at its last place.

        With `go_on` a path is done where it reaches the last place, else where nothing more is to be paid there.
        """
        arc, letter, head, leaving = self._arcs(go_on)
        end = len(arc)
        letter, head_arc = np.append(letter + 1, 0), lambda of: np.append(of[head], end)
        pointer, rank = head_arc(leaving), letter
        # an initial leads from a node to one node only, so the first initials already tell the arcs of a node apart
        while (pointer != end).any():
            rank = np.unique(rank * (end + 2) + rank[pointer], return_inverse=True)[1]
            pointer = pointer[pointer]
        # the least rank of the arcs that leave a node takes the path on
        chosen = np.full(4 * len(self.costs), end, np.int64)
        node = arc // 4
        order = np.lexsort((rank[:-1], node))
        ahead = order[np.concatenate([[True], np.diff(node[order]) != 0])] if end else order
        chosen[node[ahead]] = ahead
        ladder = [head_arc(chosen)]
        while (ladder[-1] != end).any():
            ladder.append(ladder[-1][ladder[-1]])
        path = chosen[4 * self.first + states][:, None]
        for step in reversed(ladder[:-1]):
            path = np.stack([path, step[path]], axis=2).reshape(len(path), -1)
        sizes = (path != end).sum(1)
        letters = np.append(INITIALS, 0).astype(np.uint8)[np.where(path != end, letter[path] - 1, 4)]
        some = sizes > 0
        out = np.array(states, np.int64)
        out[some] = head[path[some, sizes[some] - 1]] % 4
        return [row[:n].tobytes() for row, n in zip(letters, sizes.tolist(), strict=True)], out

    def _arcs(self, go_on: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Arcs on cheapest paths: number (4 * node + initial), initial, node it leads to; and of every node its first arc."""
        places = len(self.costs)
        on, heads = np.zeros((places, 4, 4), bool), np.zeros((places, 4, 4), np.int64)
        inner = np.ones(places, bool)
        inner[self.last] = False
        at = np.flatnonzero(inner)
        then = np.take_along_axis(self.costs[at + 1], self.to.reshape(-1, 12), 1).reshape(-1, 4, 3)
        for arc, initial in enumerate((0, 2, 3)):  # D, K, R; an insert stays at its place
            on[at, :, initial] = self.costs[at] == self.cost[:, :, arc] + then[:, :, arc]
            heads[at, :, initial] = 4 * (at[:, None] + 1) + self.to[:, :, arc]
        on[:, :, 1] = self.costs == self.costs[:, AFTER_PUT] + INSERT
        heads[:, :, 1] = 4 * np.arange(places)[:, None] + AFTER_PUT
        if go_on:
            on[self.last] = False
        on &= (self.costs < NO_WAY)[:, :, None]
        arc = np.flatnonzero(on)
        leaving = np.full(4 * places, len(arc), np.int64)
        leaving[arc[::-1] // 4] = np.arange(len(arc))[::-1]
        return arc, arc % 4, heads.ravel()[arc], leaving


def repair_long(codes: np.ndarray, stretch: int = STRETCH) -> tuple[int, bytes]:
    """Cost and audit of one conversation, stretch by stretch."""
    parts = [codes[k : k + stretch] for k in range(0, len(codes), stretch)]
    borders = [ENDS[None]]
    for part in reversed(parts):
        borders.append(Stretch(part, np.array([len(part)]), borders[-1]).starts())
    borders.reverse()
    states, audit = np.array([NOTHING]), []
    for k, part in enumerate(parts):
        (own,), states = Stretch(part, np.array([len(part)]), borders[k + 1]).audits(states, k + 1 < len(parts))
        audit.append(own)
    return int(borders[0][0, NOTHING]), b"".join(audit)


def repair(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Cost and audit of each of the conversations that lie one after the other in `codes`."""
    begins = np.cumsum(lengths) - lengths
    costs, audits = np.zeros(len(lengths), np.int64), [b""] * len(lengths)
    by_length, lo = np.argsort(lengths, kind="stable"), 0
    while lo < len(lengths):
        if lengths[by_length[lo]] > STRETCH:
            k = by_length[lo]
            costs[k], audits[k] = repair_long(codes[begins[k] : begins[k] + lengths[k]])
            lo += 1
            continue
        # conversations of like lengths: their paths are written into one table
        sizes = lengths[by_length[lo:]]
        most = np.arange(1, len(sizes) + 1) * (3 * sizes + 3)
        hi = lo + max(1, min(int(np.searchsorted(most, TOGETHER, "right")), int(np.searchsorted(sizes, 2 * sizes[0] + 8, "right"))))
        own = by_length[lo:hi]
        rows = np.concatenate([np.arange(begins[k], begins[k] + lengths[k]) for k in own.tolist()]) if len(own) else own
        stretch = Stretch(codes[rows.astype(np.int64)], lengths[own], np.broadcast_to(ENDS, (len(own), 4)))
        found, _ = stretch.audits(np.zeros(len(own), np.int64), go_on=False)
        costs[own] = stretch.starts()[:, NOTHING]
        for k, audit in zip(own.tolist(), found, strict=True):
            audits[k] = audit
        lo = hi
    return costs, audits


class Rewriter:
    """The repaired turns of a conversation by its audit, row by row."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.said = audit, 0, NOTHING
        self.sha, self.turns = hashlib.sha256(), 0

    def _say(self, role: str, text: str, said: int) -> None:
        self.sha.update(f"{chr(10) if self.turns else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.turns, self.said = self.turns + 1, said

    def _put(self, text: str) -> None:
        said = int(AFTER_PUT[self.said])
        self._say("user" if said == USER else "assistant", text, said)

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self._put("")

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._say(role, text, int(AFTER_KEPT[self.said, "sua".find(role[:1])]))
        elif edit == "R":
            self._put(text)

    def digest(self) -> str:
        self.inserted()
        return self.sha.hexdigest()


def _key(column: Column) -> Column:
    return F.when(column.isNull(), "null").otherwise(F.concat(F.lit("id "), column.cast("string")))


def damaged(turns: DataFrame) -> DataFrame:
    """`_key`, `_turn`, `_role`, `_text`: the rows of `conversations` with every twentieth kind of row damaged."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    named = turns.select(
        _key(F.col("conv_id")).alias("_key"),
        F.col("turn").cast("long").alias("_turn"),
        spaced("role").alias("_role"),
        spaced("text").alias("_text"),
        kind.alias("_kind"),
    )
    text = (
        F.when(F.col("_kind") == 1, F.lit(""))
        .when(F.col("_kind") == 2, F.translate("_text", ".!?", ""))
        .otherwise(F.col("_text"))
    )
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return named.where("_kind <> 0").select(
        "_key",
        "_turn",
        F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("_role")).alias("_role"),
        text.alias("_text"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


#: Order of a conversation's rows.
_ORDER = ["_known", "_turn", "_role", "_sha", "_uid"]


def _marked(rows: DataFrame) -> DataFrame:
    """Rows with their order, a number of their own, and a fault but for repeats, as a written table."""
    last = F.rtrim("_text", F.lit(WHITE))
    fault = F.when(F.length(last) == 0, BLANK).when(F.right(last, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    initial = F.when(F.col("_role").startswith("s"), 0).when(F.col("_role").startswith("u"), 1)
    initial = initial.when(F.col("_role").startswith("a"), 2).otherwise(3)
    return materialize(
        rows.select(
            "_key",
            F.col("_turn").isNotNull().alias("_known"),
            "_turn",
            "_role",
            F.unhex(F.sha2("_text", 256)).alias("_sha"),
            F.monotonically_increasing_id().alias("_uid"),
            initial.cast("int").alias("_initial"),
            fault.cast("int").alias("_fault"),
            "_text",
        )
    )


def _faults(rows: DataFrame) -> DataFrame:
    """The light columns of all rows, with `_code`: initial + 4 * fault."""
    order = [c for c in _ORDER if c not in ("_role", "_sha")]
    firsts = rows.groupBy("_key", "_role", "_sha").agg(F.min(F.struct(*order)).alias("_first")).select(
        F.col("_first._uid").alias("_uid"), F.lit(True).alias("_is_first")
    )
    light = rows.select("_key", *_ORDER, "_initial", "_fault").join(firsts, "_uid", "left")
    repeated = F.col("_is_first").isNull() & (F.col("_fault") != BLANK)
    fault = F.when(repeated, DUPLICATE).otherwise(F.col("_fault"))
    return light.select("_key", *_ORDER, (F.col("_initial") + 4 * fault).cast("tinyint").alias("_code"))


class Open:
    """A conversation whose rows have not all been read: a byte a row, and what is known of its turns."""

    def __init__(self, key: str) -> None:
        self.key, self.codes = key, []
        self.least = self.greatest = None
        self.distinct = 0

    def add(self, codes: np.ndarray, turns: np.ndarray) -> None:
        """`turns`: those that are known, in order."""
        self.codes.append(codes.astype(np.uint8))
        if len(turns):
            self.distinct += int((np.diff(turns) != 0).sum()) + (self.greatest is None or int(turns[0]) != self.greatest)
            self.least = int(turns[0]) if self.least is None else self.least
            self.greatest = int(turns[-1])

    def gaps(self) -> int:
        return self.greatest - self.least + 1 - self.distinct if self.distinct else 0


#: Initials that may follow each other: su, ua, au.
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True


def _audited(light: DataFrame) -> DataFrame:
    """One row per conversation with rows: `_key`, its numbers and its audit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Open | None = None
        whole: list[Open] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("_key")
            codes = batch.column("_code").to_numpy().astype(np.uint8)
            known = batch.column("_known").to_numpy(zero_copy_only=False)
            turns = batch.column("_turn").fill_null(0).to_numpy()
            cuts = [0, *(np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)) + 1).tolist(), len(codes)]
            for lo, hi in zip(cuts, cuts[1:]):
                key = keys[lo].as_py()
                if now is None or now.key != key:
                    if now is not None:
                        whole.append(now)
                    now = Open(key)
                now.add(codes[lo:hi], turns[lo:hi][known[lo:hi]])
                size += hi - lo
            if size > 1 << 16 and whole:
                yield answers(whole)
                whole, size = [], sum(map(len, now.codes))
        if now is not None:
            yield answers([*whole, now])

    def answers(of: list[Open]) -> pa.RecordBatch:
        own = [np.concatenate(x.codes) for x in of]
        lengths = np.array([len(c) for c in own], np.int64)
        codes = np.concatenate(own).astype(np.int64)
        costs, audits = repair(codes, lengths)
        begins = np.cumsum(lengths) - lengths
        legal = np.append(True, _LEGAL[codes[:-1] % 4, codes[1:] % 4])
        legal[begins] = True
        sums = lambda flags: np.add.reduceat(flags.astype(np.int64), begins)
        numbers = [np.array([x.gaps() for x in of]), *(sums(codes // 4 == k) for k in (BLANK, DUPLICATE, TRUNCATED)), sums(~legal), costs]
        columns = [pa.array([x.key for x in of]), *(pa.array(x, pa.int64()) for x in numbers), pa.array([a.decode() for a in audits])]
        return pa.RecordBatch.from_arrays(columns, ["_key", *NUMBERS, "audit"])

    by_row = light.repartition("_key").sortWithinPartitions("_key", *_ORDER)
    numbers = ", ".join(f"{n} long" for n in NUMBERS)
    return by_row.select("_key", "_known", "_turn", "_code").mapInArrow(tidied(run), f"_key string, {numbers}, audit string")


def _hashed(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The conversations with the hash of their repaired turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, about = None, None
        for batch in batches:
            done = []
            texts, roles = batch.column("_text"), batch.column("_role")
            for k, (key, audit) in enumerate(zip(batch.column("_key").to_pylist(), batch.column("audit").to_pylist(), strict=True)):
                if audit is not None:  # a conversation's first row
                    if now is not None:
                        done.append((*about, now.digest()))
                    now, about = Rewriter(audit), (key, *(batch.column(n)[k].as_py() for n in NUMBERS), audit)
                else:
                    now.row(roles[k].as_py(), texts[k].as_py())
            yield packed(done)
        if now is not None:
            yield packed([(*about, now.digest())])

    def packed(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) if done else [()] * (len(NUMBERS) + 3)
        kinds = [pa.string(), *[pa.int64()] * len(NUMBERS), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names)

    names = ["_key", *NUMBERS, "audit", "repaired_sha256"]
    heads = audited.select("_key", F.lit(0).alias("_turns"), *NUMBERS, "audit")
    both = heads.unionByName(rows.select("_key", F.lit(1).alias("_turns"), *_ORDER, "_text"), allowMissingColumns=True)
    by_row = both.repartition("_key").sortWithinPartitions("_key", "_turns", *_ORDER)
    numbers = ", ".join(f"{n} long" for n in NUMBERS)
    return by_row.select("_key", "_role", "_text", *NUMBERS, "audit").mapInArrow(
        tidied(run), f"_key string, {numbers}, audit string, repaired_sha256 string"
    )


def repaired(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each id of `conversations` (`conv_id`), from rows (`_key`, `_turn`, `_role`, `_text`)."""
    marked = _marked(rows)
    found = _hashed(marked, materialize(_audited(_faults(marked))))
    ids = conversations.select("conv_id").distinct().withColumn("_own", _key(F.col("conv_id")))
    both = ids.join(found, F.col("_own") == F.col("_key"), "left")
    return both.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in NUMBERS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(NO_TEXT)).alias("repaired_sha256"),
    )


__all__ = ["Rewriter", "Stretch", "damaged", "repair", "repair_long", "repaired", "row_arcs"]
