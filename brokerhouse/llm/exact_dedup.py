"""Exact duplicates by composable polynomial fingerprints.

The fingerprint of a text is the value of its bytes (A-Z lower-cased) as a polynomial, modulo two primes. The
value of two parts together follows from their values and the length of the second: h(ab) = h(a) * B^|b| + h(b). So
chunks are hashed on their own, and a huge document is cut into segments that are hashed in parallel, on any
executor, and put together by that rule. Texts of equal fingerprint and length are then compared byte by byte, chunk
against chunk: within a group the least and the greatest chunk of each place must be the same, which Spark finds
with combining before the shuffle, so a group that holds a third of all rows is no heavier than others. A
group that fails (a collision) is divided by a cryptographic digest and compared again.

Defined results: a null text equals the empty text; of equal texts the row with the largest id stays (a null id is
smaller than any other; of rows that repeat an id, one stays); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brokerhouse.llm.common import bloom_bits, free_names, in_bloom, materialize, same_columns, text_bytes, tidied
from brokerhouse.sources.work import with_copy_number

#: Primes under 2**31: sums over a chunk stay under 2**53, so products in floating point are exact.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245 % 2147483647, 1664525)
CHUNK = 8192
#: Texts are compared in chunks of so many bytes.
COMPARED = 1 << 18
#: Documents of more characters are hashed in segments of as many, on several executors.
HUGE = 1 << 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base**(n-1) .. base**0 modulo prime."""
    out = [1]
    for _ in range(n - 1):
        out.append(out[-1] * base % prime)
    return np.array(out[::-1], np.float64)


def combine(left: int, right: int, shift: int, prime: int) -> int:
    """Hash of two parts together; `shift` is base**(length of the right part)."""
    return (left * shift + right) % prime


class Hasher:
    """Polynomial hashes modulo each prime."""

    def __init__(self, primes: tuple[int, int] = PRIMES) -> None:
        self.primes = primes
        self.table = np.stack([powers(b, p, CHUNK) for b, p in zip(BASES, primes, strict=True)], axis=1)
        self.shifts = [pow(b, CHUNK, p) for b, p in zip(BASES, primes, strict=True)]

    def __call__(self, data: np.ndarray) -> list[int]:
        out = [0] * len(self.primes)
        head = len(data) % CHUNK
        if head:
            part = data[:head].astype(np.float64) @ self.table[CHUNK - head :]
            out = [int(x) % p for x, p in zip(part, self.primes, strict=True)]
        for lo in range(head, len(data), CHUNK * 64):
            block = data[lo : lo + CHUNK * 64]
            values = block.reshape(-1, CHUNK).astype(np.float64) @ self.table
            for row in values:
                out = [
                    combine(h, int(x), s, p)
                    for h, x, s, p in zip(out, row, self.shifts, self.primes, strict=True)
                ]
        return out

    def shift_of(self, length: int) -> list[int]:
        return [pow(b, length, p) for b, p in zip(BASES, self.primes, strict=True)]


def _lower_texts(column: pa.Array) -> Iterator[np.ndarray]:
    data, starts = text_bytes(column)
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        yield _LOWER[data[a:b]]


def _normal(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _small(light: DataFrame, kind: str, primes: tuple[int, int]) -> DataFrame:
    """Digest, length and fingerprint of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(primes)
        for batch in batches:
            sha, size, print_ = [], [], []
            for data in _lower_texts(batch.column("_text")):
                high, low = hasher(data)
                sha.append(hashlib.sha256(data).hexdigest())
                size.append(len(data))
                print_.append(high << 31 | low)
            columns = [pa.array(sha, pa.string()), pa.array(size, pa.int64()), pa.array(print_, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *columns], ["_id", "_sha", "_bytes", "_print"])

    return light.mapInArrow(tidied(run), f"_id {kind}, _sha string, _bytes long, _print long")


def _segments(light: DataFrame, huge: int, primes: tuple[int, int]) -> DataFrame:
    """Fingerprints of huge documents, by digest: segments are dealt over the executors, hashed, and combined in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(primes)
        for batch in batches:
            rows = []
            for data in _lower_texts(batch.column("_part")):
                (h1, h2), (s1, s2) = hasher(data), hasher.shift_of(len(data))
                rows.append((len(data), h1, h2, s1, s2))
            columns = [pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [()] * 5)]
            names = ["_sha", "_place", "_bytes", "_h1", "_h2", "_s1", "_s2"]
            yield pa.RecordBatch.from_arrays([batch.column("_sha"), batch.column("_place"), *columns], names)

    places = F.sequence(F.lit(0), F.floor((F.length("_text") - 1) / F.lit(huge)).cast("int"))
    parts = (
        light.withColumn("_normal", _normal(F.col("_text")))
        .select(F.sha2("_normal", 256).alias("_sha"), "_text", F.posexplode(places).alias("_place", "_k"))
        .select("_sha", "_place", F.expr(f"substring(_text, _k * {huge} + 1, {huge})").alias("_part"))
        .repartition("_sha", "_place")
    )
    hashed = parts.mapInArrow(
        tidied(run), "_sha string, _place int, _bytes long, _h1 long, _h2 long, _s1 long, _s2 long"
    ).dropDuplicates(["_sha", "_place"])
    ordered = hashed.groupBy("_sha").agg(
        F.array_sort(F.collect_list(F.struct("_place", "_bytes", "_h1", "_h2", "_s1", "_s2"))).alias("_parts")
    )
    fold = lambda n, p: F.aggregate(
        "_parts", F.lit(0).cast("long"), lambda acc, x: (acc * x[f"_s{n}"] + x[f"_h{n}"]) % F.lit(p)
    )
    return ordered.select(
        "_sha",
        F.aggregate("_parts", F.lit(0).cast("long"), lambda acc, x: acc + x["_bytes"]).alias("_bytes"),
        (fold(1, primes[0]) * F.lit(1 << 31) + fold(2, primes[1])).alias("_print"),
    )


def fingerprints(
    docs: DataFrame, id_col: str, text_col: str, huge: int = HUGE, primes: tuple[int, int] = PRIMES
) -> DataFrame:
    """`_id`, `_sha` (SHA-256 of the normalised text), `_bytes` and `_print` of each row."""
    light = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = light.schema["_id"].dataType.simpleString()
    long = F.coalesce(F.length("_text"), F.lit(0)) > huge
    large = light.where(long)
    joined = (
        large.select("_id", F.sha2(_normal(F.col("_text")), 256).alias("_sha"))
        .join(_segments(large, huge, primes), "_sha")
        .select("_id", "_sha", "_bytes", "_print")
    )
    return _small(light.where(~long), kind, primes).unionByName(joined)


def _chunks(light: DataFrame, huge: int, primes: tuple[int, int], bits: np.ndarray) -> DataFrame:
    """Compared chunks of the texts whose fingerprint may be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(primes)
        for batch in batches:
            rows, size = [], 0
            for data in _lower_texts(batch.column("_text")):
                high, low = hasher(data)
                print_ = high << 31 | low
                if not in_bloom(bits, np.array([print_], np.int64))[0]:
                    continue
                sha = hashlib.sha256(data).hexdigest()
                for k in range(0, max(len(data), 1), COMPARED):
                    rows.append((print_, len(data), sha, k // COMPARED, data[k : k + COMPARED].tobytes()))
                    size += len(rows[-1][-1])
                    if size > 1 << 23:
                        yield pack(rows)
                        rows, size = [], 0
            yield pack(rows)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary())
        columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["_print", "_bytes", "_sha", "_chunk", "_data"])

    return light.mapInArrow(tidied(run), "_print long, _bytes long, _sha string, _chunk int, _data binary")


def duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    huge: int = HUGE,
    primes: tuple[int, int] = PRIMES,
) -> DataFrame:
    """One row per document: its id, `keep_id`, `group_size`, `kept` and `text_sha256`. `primes` is for tests."""
    spark = docs.sparkSession
    rows = materialize(fingerprints(docs, id_col, text_col, huge, primes))
    key = ["_print", "_bytes"]
    shared = rows.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1")
    bits = bloom_bits(shared, "_print")
    light = docs.select(F.col(text_col).alias("_text"))
    compared = materialize(
        _chunks(light, huge, primes, bits)
        .groupBy(*key, "_chunk")
        .agg(F.min("_data").alias("_least"), F.max("_data").alias("_most"))
        .where("_least <> _most")
        .select(*key)
        .distinct()
    )
    # a collision: texts of one fingerprint that differ are told apart by their digest
    told = rows.join(compared.withColumn("_differ", F.lit(True)), key, "left").withColumn(
        "_sub", F.when(F.col("_differ"), F.col("_sha")).otherwise(F.lit(""))
    )
    _check_digests(spark, light, compared, huge, primes)
    key = [*key, "_sub"]
    told = materialize(told.select("_id", "_sha", *key))
    told = with_copy_number(told)
    # written before it is joined: a group that holds most rows can then be split
    groups = materialize(
        told.groupBy(*key).agg(F.count("*").alias("group_size"), F.max(F.struct("_id", "_copy")).alias("_stays"))
    )
    return told.join(groups, key).select(
        F.col("_id").alias(id_col),
        F.col("_stays._id").alias("keep_id"),
        "group_size",
        (F.col("_copy") == F.col("_stays._copy")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def _check_digests(spark, light: DataFrame, compared: DataFrame, huge: int, primes: tuple[int, int]) -> None:
    """Compare texts that share fingerprint and digest where fingerprints have collided."""
    if compared.isEmpty():
        return
    differing = (
        _chunks(light, huge, primes, bloom_bits(compared, "_print"))
        .groupBy("_print", "_bytes", "_sha", "_chunk")
        .agg(F.min("_data").alias("_least"), F.max("_data").alias("_most"))
        .where("_least <> _most")
    )
    if not differing.isEmpty():
        raise RuntimeError("different texts share both fingerprint and SHA-256")


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their columns."""
    sha, turn, kept_id, kept_sha = free_names(docs, "_sha", "_turn", "_kept_id", "_kept_sha")
    kept = (
        duplicates(docs, id_col, text_col)
        .where("kept")
        .select(F.col(id_col).alias(kept_id), F.col("text_sha256").alias(kept_sha))
    )
    both = docs.withColumn(sha, F.sha2(_normal(F.col(text_col)), 256)).join(
        kept, (F.col(sha) == F.col(kept_sha)) & F.col(id_col).eqNullSafe(F.col(kept_id)), "left_semi"
    )
    # rows that repeat both id and text: one stays
    first = F.row_number().over(Window.partitionBy(sha, id_col).orderBy(sha))
    return both.withColumn(turn, first).where(F.col(turn) == 1).select(*same_columns(docs))


__all__ = ["combine", "duplicates", "fingerprints", "without_duplicates"]
