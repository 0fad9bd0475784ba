"""Helpers shared by the corpus operators: samples, splits, Arrow batches, word hashes."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator
from functools import wraps
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerhouse.sources.work import materialize, work_dir

__all__ = [
    "bloom_bits", "by_bytes", "discard", "exact_products", "fold", "free_names", "in_bloom", "materialize", "quiet", "same_columns", "sample_rows",
    "shingle_sets", "small_batches", "text_bytes", "texts_of", "tidied", "word_hashes",
]

#: Bytes of text that numpy works on at a time.
BLOCK = 1 << 19


def discard(table: DataFrame) -> None:
    """Empty a work table that no later plan reads: its space is free long before the application ends."""
    spark = table.sparkSession
    files = table.inputFiles()
    folder = unquote(files[0].rpartition("/")[0]) if files else ""
    if work_dir(spark).split(":", 1)[-1].strip("/") in folder:  # never a table that somebody else has written
        spark.createDataFrame([], table.schema).write.mode("overwrite").parquet(folder)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; -1 where the id is null."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)), F.lit(-1)).cast("int")


def sample_rows(df: DataFrame, group: str, key: str, most: int, total: int = 200_000) -> DataFrame:
    """`group` and `key` of at most `most` rows of each group and `total` rows in all, the same ones whenever it runs.

    `df` should hold these two columns alone. A row stays if its hash lies under a bound that follows from its group's
    size, so rows reach the exact limits already thinned, whatever the size of a group. The result may be broadcast.
    """
    light = df.select(F.col(group).alias("_group"), F.col(key).alias("_key"))
    sizes = light.groupBy("_group").agg(F.count("*").alias("_size")).withColumnRenamed("_group", "_of")
    near = (
        light.join(sizes, F.col("_group").eqNullSafe(F.col("_of")))
        .withColumn("_place", F.pmod(F.xxhash64(F.col("_key").cast("string"), F.lit("sample")), F.lit(1 << 30)))
        .where(F.col("_place") * F.col("_size") < F.lit(2.0 * most * (1 << 30)))
    )
    turn = F.expr("row_number() over (partition by _group order by _place, _key)")
    few = near.withColumn("_turn", turn).where(F.col("_turn") <= most).orderBy("_turn", "_place", "_group").limit(total)
    return few.select(F.col("_group").alias(group), F.col("_key").alias(key))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of `df` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def same_columns(df: DataFrame) -> list[Column]:
    """The columns of `df` by name, whatever characters are in it."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


Batches = Iterator[pa.RecordBatch]


def tidied(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The Arrow function; at its end the worker, which lives on for other tasks, gives back memory that it holds in reserve."""

    @wraps(run)
    def whole(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim is not None:
                trim(0)

    return whole


def by_bytes(batch: pa.RecordBatch, text_col: str, most: int = BLOCK, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts (or binaries) hold at most `most` bytes together and `rows` rows; a longer one comes alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        before = int(ends[lo - 1]) if lo else 0
        hi = min(max(lo + 1, int(np.searchsorted(ends, before + most, "right"))), lo + rows)
        yield batch.slice(lo, hi - lo)
        lo = hi


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Let tasks exchange batches of at most `size` bytes from now on, unless the session already asks for less.

    A batch is held by the executor and by its Python worker, in each as memory that is kept for the next one.
    """
    if not 0 < _bytes(spark.conf.get(_BATCH, "64m")) <= _bytes(size):
        spark.conf.set(_BATCH, size)


def _bytes(size: str) -> int:
    """Bytes of a size as settings have it, such as 67108864b or 8m."""
    number, unit = re.fullmatch(r"(-?[0-9]+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Texts of an Arrow column, null as the empty text."""
    return [t or "" for t in column.to_pylist()]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow text column and the place where each text begins (and the last ends)."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, at, data = column.buffers()
    starts = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


_MIX = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX[65:91] = _MIX[97:123]  # A-Z count as a-z
_STEP = 0x9E3779B97F4A7C15
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True


def scramble(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _STEP, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, separator: np.ndarray = _SEPARATOR, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, ...]:
    """64-bit hash of each word, A-Z lower-cased, of its first bytes for each of `prefixes`, and the words of each text.

    Words are runs of bytes outside `separator`, white space if none is given.
    """
    n = len(data)
    hashes, owners = [[] for _ in (0, *prefixes)], []
    lo = 0
    while lo < n:
        hi = min(n, lo + BLOCK)
        while hi < n:  # cut at a separator or where a text begins
            gaps = np.flatnonzero(separator[data[hi : hi + 4096]])
            after = starts[np.searchsorted(starts, hi)]
            cut = min(hi + int(gaps[0]) if len(gaps) else n + 1, int(after))
            if cut <= min(n, hi + 4096):
                hi = cut
                break
            hi = min(n, hi + 4096)
        part = data[lo:hi]
        in_word = ~separator[part]
        begins = in_word.copy()
        begins[1:] &= ~in_word[:-1]
        first = starts[np.searchsorted(starts, lo) : np.searchsorted(starts, hi)] - lo
        begins[first] = in_word[first]
        at = np.flatnonzero(begins)
        if len(at):
            places = np.flatnonzero(in_word)
            word = np.cumsum(begins)[places] - 1
            offset = places - at[word]
            value = _MIX[part[places]] * _powers(int(offset.max()) + 1)[offset]
            first = np.searchsorted(places, at)
            hashes[0].append(scramble(np.add.reduceat(value, first)))
            for out, size in zip(hashes[1:], prefixes, strict=True):
                out.append(scramble(np.add.reduceat(value * (offset < size), first) + np.uint64(size)))
            owners.append(np.searchsorted(starts, at + lo, side="right") - 1)
        lo = hi
    count = np.zeros(len(starts) - 1, np.int64)
    if not owners:
        return *(np.zeros(0, np.uint64) for _ in hashes), count
    found = np.concatenate(owners)
    # an empty text begins where the next one does, and owns nothing
    count += np.bincount(found, minlength=len(count))[: len(count)]
    return *(np.concatenate(h) for h in hashes), count


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of `size` words; fewer words make one run, none make none."""
    data, starts = text_bytes(column)
    words, count = word_hashes(data, starts)
    salt = _powers(size + 1)[1:] | np.uint64(1)
    end = 0
    for n in count:
        own, end = words[end : end + n], end + n
        if n >= size:
            runs = own[: n - size + 1] * salt[0]
            for k in range(1, size):
                runs = runs + own[k : n - size + 1 + k] * salt[k]
            yield np.unique(scramble(runs))
        elif n:
            yield scramble((own * salt[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
        else:
            yield own


#: Bits of a Bloom filter: one megabyte, whatever the size of the data. A fuller filter only lets more rows pass.
BLOOM_WORDS = 1 << 17


def bloom_bits(keys: DataFrame, column: str, words: int = BLOOM_WORDS) -> np.ndarray:
    """A filter of `words` 64-bit words over random-like 64-bit keys. Rows that pass it may still not be among the keys."""
    bits = (
        keys.select(
            (F.shiftrightunsigned(column, 6) % F.lit(words)).alias("_word"),
            F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))").alias("_bit"),
        )
        .groupBy("_word")
        .agg(F.expr("bit_or(_bit)").alias("_bits"))
        .toArrow()
    )
    out = np.zeros(words, np.int64)
    out[bits.column("_word").to_numpy()] = bits.column("_bits").to_numpy()
    return out


def in_bloom(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    keys = keys.view(np.uint64)
    word = (keys >> np.uint64(6)) % np.uint64(len(bits))
    return (bits[word].view(np.uint64) >> (keys & np.uint64(63))) & np.uint64(1) > 0


_LONG = (1 << 63) - 1


def quiet(run: Callable) -> Callable:
    """The function without warnings of numbers too great to reckon with: it treats them itself."""

    @wraps(run)
    def inner(*args, **named):
        with np.errstate(over="ignore", invalid="ignore"):
            return run(*args, **named)

    return inner


def exact_products(rows: np.ndarray, vector: np.ndarray, greatest: float | None = None) -> np.ndarray:
    """Inner products of whole-number vectors as longs; beyond the range of a long, its nearest end.

    `greatest`: what no component of the rows exceeds, if known.
    """
    ends = float(np.abs(rows).max(initial=0) if greatest is None else greatest), float(np.abs(vector).max(initial=0))
    most = ends[0] * ends[1] * len(vector)
    if most < 2**53:
        return (rows @ vector).astype(np.int64)
    if most < 2**62 and max(ends) < 2**53:
        return rows.astype(np.int64) @ vector.astype(np.int64)
    own = [int(v) for v in vector]
    exact = [sum(int(a) * b for a, b in zip(row, own, strict=True)) for row in rows]
    return np.array([min(max(x, -_LONG - 1), _LONG) for x in exact], np.int64)
