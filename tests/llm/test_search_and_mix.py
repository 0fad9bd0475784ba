import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest

from brokerhouse.llm import mixing, revisits, topk


def whole(vector):
    return [int(np.floor(256 * x)) for x in vector]


def brute_top(rows):
    """The five best of each query, in Python's whole numbers."""
    out = []
    for n, (i, v, _) in enumerate(rows):
        if i is None or i % 50:
            continue
        own, scores = whole(v), []
        for m, (j, w, _) in enumerate(rows):
            if m != n and len(w) == len(v):
                score = sum(a * b for a, b in zip(own, whole(w), strict=True))
                scores.append((-min(max(score, -(2**63)), 2**63 - 1), j is None, j or 0))
        out += [(i, k + 1, None if null else j, -s) for k, (s, null, j) in enumerate(sorted(scores)[:5])]
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket", [64, None])
def test_top_k_equals_brute_force(spark, bucket):
    rng = np.random.default_rng(3)
    rows = [(int(k), rng.normal(0, 0.3, 12).tolist(), "x") for k in range(300)]
    rows += [(300 + k, rows[7][1], "x") for k in range(30)] + [(None, rows[7][1], "x"), (50, rows[9][1], "x")]
    bad = [(1000, None, "x"), (1050, [None, 1.0], "x"), (1100, [float("nan")] * 12, "x"), (1150, [float("inf")] * 12, "x"), (1200, [], "x")]
    other = [(2000, [0.5, 0.5], "x"), (2001, [0.25, 0.5], "x")]
    huge = [(3000 + 25 * k, [float(s) * 2.0**e, 1.0, 0.5], "x") for k, (s, e) in enumerate([(1, 40), (-1, 40), (1, 24), (1, 1), (-1, 900), (1, 900)])]
    docs = spark.createDataFrame(rows + bad + other + huge, "vec_id long, embedding array<double>, score string")
    found = topk.top_k(docs, bucket=bucket)
    assert sorted(map(tuple, found.collect()), key=str) == brute_top(rows + other + huge)
    assert topk.top_k(docs.limit(0)).count() == 0


def test_pivots_rule_out_most_of_clustered_candidates():
    """Rows around 40 centres: far fewer than a fifth are evaluated; every bound holds, also for random rows."""
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 100, (40, 16))
    for spread, most in ((5.0, 0.2), (300.0, 1.0)):
        rows = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, spread, (4000, 16)))
        pivots = topk.apart(rows[:1000], 40)
        bucket = topk.Bucket(np.arange(4000), np.arange(4000), np.ones(4000, bool), rows, pivots)
        for q in range(0, 4000, 100):
            exact = rows @ rows[q]
            to_pivots = topk.distances(rows[q : q + 1], pivots)[0]
            assert (bucket.bounds(rows[q], to_pivots) >= exact).all()
            exact[q] = -np.inf
            best = np.lexsort((np.arange(4000), -exact))[:5]
            for least in (topk.NO_BOUND, int(exact[best[-1]])):
                assert bucket.best(q, rows[q], to_pivots, 5, least) == [(int(b), int(exact[b])) for b in best]
        assert bucket.evaluated < most * bucket.pairs


def water_filling(sizes, weights, most):
    """Shares the excess again and again, as the rule says."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_ = dict.fromkeys(names, 0.0), set(names)
    rest = float(sum(sizes.values()))
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        target = {s: target[s] + (rest * weight[s] / total if s in open_ else 0) for s in names}
        over = {s for s in open_ if target[s] > most * sizes[s]}
        rest = sum(target[s] - most * sizes[s] for s in over)
        target |= {s: most * sizes[s] for s in over}
        open_ -= over
    return target


def test_mix_reaches_its_targets(spark):
    rng = random.Random(5)
    rows = []
    for k in range(900):
        source = rng.choice([None, "b", "a", "tiny", "\U0001f600", "c"]) if k % 40 else "rare"
        rows.append((k, "w " * rng.choice([0, 1, 5, 30]) + " x" * (k % 2), source, 1))
    rows += [(3, "same row", "b", 1)] * 2 + [(None, None, "void", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _size int")
    found = mixing.mix(docs, bins=16).collect()
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
        assert 0 <= r.taken <= 3 * r.size
    target = water_filling(sizes, mixing.WEIGHTS, mixing.MOST_EPOCHS)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in sizes)
    again = mixing.mix(docs.repartition(7), bins=16).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert mixing.mix(docs.limit(0)).count() == 0


def test_better_documents_are_taken_more_often(spark):
    from pyspark.sql import functions as F

    rows = [(k, "w " * 10, "a" if k < 1000 else "b") for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    good = F.when(F.col("doc_id") % 2 == 0, 8.0).otherwise(0.125)
    found = mixing.mix(docs, good, weights=(1, 1)).where("source = 'a'").collect()
    by = [sum(r.taken for r in found if r.doc_id % 2 == side) for side in (0, 1)]
    assert by[0] > 4 * by[1]


def test_revisits_equal_brute_force(spark):
    rng = random.Random(6)
    start = datetime(2024, 1, 1)
    urls = ["http://A.example:80/x?b=1&a=2#f", "HTTP://a.example/x?a=2&b=1", "https://b.example", None]
    rows = []
    for k in range(400):
        full = rng.random() < 0.4
        when = None if k % 50 == 49 else start + timedelta(minutes=rng.randrange(150))
        headers = {"ETag": rng.choice(['"1"', 'W/"2"'])} if rng.random() < 0.6 else {}
        headers |= {"Last-Modified": rng.choice(["Mon", "Tue"])} if rng.random() < 0.5 else {}
        headers |= {"Cache-Control": f"max-age={k}", "Server": f"s{k}"}
        digest = rng.choice([None, "d1", "d2"])
        rows.append((k, urls[min(3, k % 5 // 1 if k % 5 < 3 else 0)], when, "response" if full else "revisit", headers, digest, "x"))
    rows += [(400, None, start, "revisit", None, None, "x"), (401, urls[0], start, "other", {}, None, "x")]
    schema = "record_id long, url string, captured_at timestamp, type string, headers map<string,string>, payload_digest string, outcome string"
    found = {r.record_id: r for r in revisits.resolve(spark.createDataFrame(rows, schema), pieces=8).collect()}
    canonical = {urls[0]: 1, urls[1]: 1, urls[2]: 2, None: None}
    assert {r[0] for r in rows if r[3] == "revisit"} == set(found)
    for i, url, when, kind, headers, digest, _ in rows:
        if kind != "revisit":
            continue
        own = found[i]
        before = [r for r in rows if r[3] == "response" and url and when and r[2] and r[2] < when and canonical[r[1]] == canonical[url]]
        if not before:
            assert own.outcome == "no_original" and own.original_id is None
            continue
        origin = max(before, key=lambda r: (r[2], r[0]))
        tag = lambda h: (h.get("ETag") or "").removeprefix("W/") or None
        pairs = [(digest, origin[5]), (tag(headers), tag(origin[4])), (headers.get("Last-Modified"), origin[4].get("Last-Modified"))]
        checks = [a == b for a, b in pairs if a and b]
        outcome = "no_validator" if not checks else "resolved" if checks[0] else "validator_mismatch"
        assert (own.outcome, own.original_id) == (outcome, origin[0] if outcome == "resolved" else None)
        if outcome == "resolved":
            low = {k.lower(): v for k, v in origin[4].items()} | {k.lower(): v for k, v in headers.items() if k not in ("Server", "Last-Modified")}
            assert own.headers == low and own.payload_digest == origin[5]


def test_no_records(spark):
    schema = "record_id long, url string, captured_at timestamp, type string, headers map<string,string>, payload_digest string"
    assert revisits.resolve(spark.createDataFrame([], schema)).count() == 0
    assert revisits.crawl_of(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_the_query_uses_every_validator_and_outcome(spark):
    rows = [(k, f"http://a{k % 40}.example/x{k // 40}", f"<p>{k}</p>") for k in range(120)] + [(None, None, None)]
    crawl = revisits.crawl_of(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert crawl.where("type = 'response'").groupBy("url").count().agg({"count": "max"}).first()[0] == 3
    found = revisits.resolve(crawl).where("url is not null").collect()
    assert {r.outcome for r in found} == {"resolved", "validator_mismatch", "no_validator", "no_original"}
    by_kind = {kind: {r.outcome for r in found if (r.record_id // 16 + r.record_id % 16 - 8) % 6 == kind} for kind in range(6)}
    assert by_kind[0] == by_kind[2] == {"no_original", "resolved"} and by_kind[5] == {"no_original", "validator_mismatch"}
    assert by_kind[1] == {"no_original", "resolved", "no_validator"} and by_kind[3] == {"no_original", "no_validator"}
    assert by_kind[4] == {"no_original", "resolved", "validator_mismatch"}
    assert {r.original_id % 16 for r in found if r.outcome == "resolved"} == {0, 1, 2}  # the latest of several


def test_revisits_put_urls_in_form_once(spark):
    pages = spark.createDataFrame([(1, "http://A.example/x?b=1&a=2", "text")], "page_id long, url string, html string")
    found = revisits.resolve(revisits.crawl_of(pages))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "^.*@" not in plan and "http" not in plan  # the plan reads what was written
    assert {r.url for r in found.collect()} == {"http://a.example/x?a=2&b=1"}
