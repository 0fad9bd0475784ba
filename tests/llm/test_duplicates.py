import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from brokerhouse.llm import exact_dedup, linking, minhash_dedup, ngram_join
from brokerhouse.llm.common import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = "doc_id long, text string, _sha int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def corpus():
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    passage = [rng.choice(words) for _ in range(50)]
    rows = []
    for _ in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 30, 120]))]
        if rng.random() < 0.5:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.choice([1, 2, 6])):
            text = list(base)
            for _ in range(rng.choice([0, 1, 3])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text) if rng.random() < 0.9 else "  ".join(text).upper()))
    for _ in range(80):  # a large group of near copies
        text = list(passage)
        for _ in range(rng.choice([0, 1, 2])):
            text[rng.randrange(50)] = rng.choice(words)
        rows.append((len(rows), " ".join(text)))
    rows += [(None, "a b c d"), (None, "a b c d"), (5, None), (6, ""), (7, "  "), (8, "one"), (9, "One"), (8, "one")]
    return [(i, t, 0) for i, t in rows]


def brute_classes(rows, size, percent):
    sets = []
    for _, text, *_ in rows:
        words = WORD.findall(lower(text))
        runs = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)] or [tuple(words)] * bool(words)
        sets.append(frozenset(runs))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and 100 * both >= percent * len(sets[x] | sets[y]):
                parent[root(x)] = root(y)
    least = {}
    for x, (i, *_) in enumerate(rows):
        if i is not None:
            least[root(x)] = min(least.get(root(x), i), i)
    return sorted(((i, len(s), least.get(root(x)) if s else i) for x, ((i, *_), s) in enumerate(zip(rows, sets, strict=True))), key=str)


@pytest.mark.parametrize(("size", "percent", "hot"), [(3, 90, 48), (5, 80, 2)])
def test_classes_equal_brute_force(spark, monkeypatch, size, percent, hot):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "MEETING", 16)
    monkeypatch.setattr(ngram_join, "AT_ONCE", 50)
    rows = corpus()
    found = ngram_join.classes(spark.createDataFrame(rows, NAMES), size, percent)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str) == brute_classes(rows, size, percent)


def same_prefixes(words, percent):
    """Texts that have their prefix and size in common and share no cell with others: two near copies, far from their foremost."""
    rng = random.Random(2)
    first = ngram_join.prefix_size(100, percent)
    while True:
        base = [f"v{rng.randrange(10**6)}" for _ in range(100 + words - 1)]
        one = base[:-20] + [f"u{rng.randrange(10**6)}" for _ in range(20)]
        two = [*one[:-1], f"t{rng.randrange(10**6)}"]
        texts = [" ".join(x) for x in (base, one, two)]
        sets = list(shingle_sets(pa.array(texts), words))
        if all(len(s) == 100 and (s[:first] == sets[0][:first]).all() for s in sets):
            return texts


def test_near_copies_of_one_group_that_shares_no_cell_are_linked(spark):
    base, one, two = same_prefixes(3, 90)
    rows = [(1, base, 0), (2, base, 0), (3, one, 0), (4, two, 0), (5, "another text than these", 0)]
    found = ngram_join.classes(spark.createDataFrame(rows, NAMES), 3, 90)
    expected = brute_classes(rows, 3, 90)
    assert [c for *_, c in expected] == [1, 1, 3, 3, 5]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str) == expected


@pytest.mark.parametrize(("size", "percent", "meeting"), [(3, 85, 16), (5, 80, 512)])
def test_tensored_bands_equal_brute_force(spark, monkeypatch, size, percent, meeting):
    monkeypatch.setattr(minhash_dedup, "MEETING", meeting)
    rows = corpus() + [(3000 + k, "long " + " ".join(f"w{j % 977}" for j in range(60_000)) + f" end{k % 2}", 0) for k in range(3)]
    found = minhash_dedup.near_duplicates(spark.createDataFrame(rows, NAMES).repartition(5), size, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute_classes(rows, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_bands_collide_as_often_as_reckoned():
    rng = np.random.default_rng(5)
    for share, least, most in ((0.3, 0.02, 0.12), (0.5, 0.4, 0.68), (0.85, 0.99, 1)):
        met, n = 0, 60
        for _ in range(200):
            pool = rng.integers(0, 1 << 63, 3 * n, dtype=np.uint64)
            same = round(share * n)
            one, two = pool[:n], np.concatenate([pool[:same], pool[n : n + (n - same)]])
            alike = round(100 * same / (2 * n - same))
            x, y = minhash_dedup.bands(one), minhash_dedup.bands(two)
            table = np.isin(minhash_dedup.table_keys(*x), minhash_dedup.table_keys(*y)).any()
            assert table == ((x == y).any(1).all())
            met += table
        expected = (1 - (1 - (alike / 100) ** minhash_dedup.DEPTH) ** minhash_dedup.SIDE) ** 2
        assert abs(met / 200 - expected) < 0.12


def test_values_are_tallied_exactly(spark, monkeypatch):
    monkeypatch.setattr(linking, "SLOT", 100)
    rng = np.random.default_rng(6)
    rows = [rng.choice(900, int(rng.integers(0, 40)), replace=False).astype(np.uint64) << np.uint64(54) for _ in range(300)]
    packed = spark.createDataFrame([(r.tobytes(),) for r in rows] + [(None,)], "values binary").repartition(4)
    values, times = np.unique(np.concatenate(rows), return_counts=True)
    found = linking.tallied(packed, "values", 6000, 3).collect()
    assert sorted((r._value, r._times) for r in found) == sorted(
        (int(v), int(t)) for v, t in zip(values.view(np.int64), times) if t >= 3
    )
    assert linking.tallied(packed.limit(0), "values", 0).count() == 0


def test_no_rows(spark):
    empty = spark.createDataFrame([], NAMES)
    assert ngram_join.classes(empty).count() == 0
    assert minhash_dedup.near_duplicates(empty).count() == 0
    assert exact_dedup.duplicates(empty).count() == 0


@pytest.mark.parametrize(
    ("huge", "primes"), [(exact_dedup.HUGE, exact_dedup.PRIMES), (50, exact_dedup.PRIMES), (40, (7, 5))]
)
def test_copies_equal_brute_force_even_where_fingerprints_collide(spark, huge, primes):
    rows = corpus() + [(900 + k, "Lang é" * 3000 + str(k % 3), 0) for k in range(6)] + [(950 + k, "x" * k, 0) for k in range(4)]
    groups = defaultdict(list)
    for i, text, _ in rows:
        groups[lower(text)].append(-1 if i is None else i)
    expected = [
        (i, None if (keep := max(groups[lower(t)])) == -1 else keep, len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest())
        for i, t, _ in rows
    ]
    docs = spark.createDataFrame(rows, NAMES)
    found = exact_dedup.duplicates(docs, huge=huge, primes=primes).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == sorted(expected, key=str)
    assert sum(r.kept for r in found) == len(groups)
    if huge == 50:
        kept = exact_dedup.without_duplicates(docs)
        assert kept.columns == docs.columns and kept.count() == len(groups)


def test_fingerprints_compose():
    hasher = exact_dedup.Hasher()
    import numpy as np

    data = np.random.default_rng(0).integers(0, 256, 30_000).astype(np.uint8)
    for cut in (0, 1, 8192, 20_000, 30_000):
        left, right, shift = hasher(data[:cut]), hasher(data[cut:]), hasher.shift_of(len(data) - cut)
        assert hasher(data) == [exact_dedup.combine(*x) for x in zip(left, right, shift, hasher.primes, strict=True)]


@pytest.mark.parametrize("percent", [80, 90])
def test_fine_sketches_never_rule_out_a_link(percent):
    rng = np.random.default_rng(11)
    passed = reached = 0
    for _ in range(3000):
        n = int(rng.integers(1, 260))
        one = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        own = rng.random(len(one)) < rng.choice([0.3, 0.8, 0.95, 1.0])
        more = rng.integers(0, 1 << 63, int(rng.integers(0, n // 8 + 2)), dtype=np.uint64)
        two = np.unique(np.concatenate([one[own], more]))
        if not len(two):
            continue
        share = 100 * len(np.intersect1d(one, two)) >= percent * len(np.union1d(one, two))
        assert ngram_join.sets_reach(one.tobytes(), two.tobytes(), percent) == share
        allowed = ngram_join.fine_allows(ngram_join.fine_sketch(one), ngram_join.fine_sketch(two), percent)
        assert allowed or not share
        passed, reached = passed + allowed, reached + share
    assert 100 < reached <= passed < 2 * reached
    alike = np.arange(40, dtype=np.uint64) << np.uint64(32)  # all in one class: no sketch, so nothing is ruled out
    assert ngram_join.fine_sketch(alike) == b"" and ngram_join.fine_allows(b"", ngram_join.fine_sketch(one), percent)
