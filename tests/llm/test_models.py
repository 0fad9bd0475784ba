import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from brokerhouse.llm import language_id, pii, toxicity
from brokerhouse.llm.common import by_bytes

PATTERNS = [
    re.compile(p)
    for p in (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )
]


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            fine = [
                True,
                kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                12 <= len(digits) <= 19 and luhn(digits),
                9 <= len(digits) <= 15,
            ][kind]
            if fine:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab.@-+ 12()5_%") for _ in range(rng.randrange(60))) for _ in range(20_000)]
    texts += ["a@b.c_x@d.e 4111 1111 1111 1111 10.0.0.256 1.2.3.4.5 +1 (555) 123-4567", "", "9" * 5000, "a" * 5000 + "@"]
    assert all(pii.base_spans(t) == brute(t) for t in texts)


def test_parts_of_any_length_are_numbers(spark):
    zeros = "0" * 5000
    texts = [f"x {zeros}.1.2.3 y", ".".join([zeros + "7"] * 4), f"{zeros}256.1.1.1", f"1.2.3.{zeros}", "+" + "1" * 5000, "4" * 5000]
    rows = pii.find(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"), None)
    found = {r.doc_id: r.spans for r in rows.collect()}
    assert found == {0: "ip:2:5008", 1: "ip:0:20007", 2: "", 3: "ip:0:5006", 4: "", 5: ""}


def test_training_windows_are_drawn_evenly():
    texts = [f"a{k}@b.co and {k}" for k in range(300)] + ["10.0.0.1", "+49 30 1234567", "4111 1111 1111 1111"] * 30
    for most in (40, 10_000):
        ids, tags = pii.examples(texts, np.random.default_rng(1), most)
        kinds = np.bincount((tags.max(1) + 1) // 2, minlength=5)
        assert len(ids) == len(tags) == kinds.sum() <= most and (most > 40 or kinds.tolist() == [0, 10, 10, 10, 10])


def test_gradients_of_the_tagger():
    rng = np.random.default_rng(0)
    tagger = pii.Tagger.fresh(rng)
    tagger.weights = [w.astype(np.float64) for w in tagger.weights]
    ids, tags = rng.integers(0, pii.CLASSES, (3, 9)), rng.integers(0, pii.TAGS, (3, 9))
    _, gradients = tagger.gradients(ids, tags)
    for k, w in enumerate(tagger.weights):
        at = (ids[0, 3], 2) if k == 0 else tuple(rng.integers(0, s) for s in w.shape)
        value = w[at]
        w[at] = value + 1e-3
        more = tagger.gradients(ids, tags)[0]
        w[at] = value - 1e-3
        less = tagger.gradients(ids, tags)[0]
        w[at] = value
        assert abs((more - less) / 2e-3 - gradients[k][at]) < 1e-3


def personal_texts(n, seed):
    rng = random.Random(seed)
    words = ["lorem", "ipsum", "dolor", "sit", "amet,", "call", "mail"]
    for _ in range(n):
        datum = rng.choice(
            [f"jo.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", f"10.{rng.randrange(256)}.3.{rng.randrange(256)}"]
        )
        yield " ".join([*rng.choices(words, k=rng.randrange(3, 30)), datum, *rng.choices(words, k=rng.randrange(3, 30))])


def test_model_adds_variants_and_keeps_base_spans(spark):
    tagger = pii.train(list(personal_texts(250, 1)))
    fresh = list(personal_texts(60, 2))
    bare = [t.replace("+1 (", "1 (") for t in fresh if "+1 (" in t]
    added = [len(a) - len(b) for b, a in pii.all_spans(bare, tagger)]
    assert sum(added) >= 0.5 * len(bare)
    clean = ["no data here 12 times", "lorem ipsum " * 50, "9999 9999 9999 9999", ""]
    assert all(a == b == [] for b, a in pii.all_spans(clean, tagger))
    for text, (base, all_) in zip(fresh, pii.all_spans(fresh, tagger), strict=True):
        assert base == brute(text) and set(base) <= set(all_)
    schema = "doc_id long, text string, spans int"
    docs = spark.createDataFrame([(1, "a@b.co", 1), (None, None, 2), (1, "a@b.co", 1)], schema)
    rows = pii.find(docs, tagger).collect()
    assert sorted((r.n_email, r.spans) for r in rows) == [(0, ""), (1, "email:0:6"), (1, "email:0:6")]
    assert pii.find(docs.limit(0), None).count() == 0 and pii.fit(docs.limit(0)) is None


def test_toxicity_learns_and_scores_blocks_alike(spark, monkeypatch):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(400):
        words = ["".join(rng.choices("aeioulmnrst", k=5)) for _ in range(rng.randrange(5, 60))]
        toxic = k % 4 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["scum", "vilefest", "vilefing!"]))
        rows.append((k, " ".join(words), rng.choice(["en", None]), 1.0))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _score double")
    model = toxicity.fit(docs.where("doc_id < 300"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    kept = toxicity.score(docs, model, keep=True, name="_s").where("doc_id >= 300").collect()
    assert sum((r._s >= 0.3) == (r.doc_id % 4 == 0) for r in kept) >= 95
    column = pa.array([r[1] for r in rows] + [None, "", "!!"])
    whole, _ = model.scores(*toxicity.buckets(column))
    monkeypatch.setattr(toxicity, "SPAN", 37)
    parts, _ = model.scores(*toxicity.buckets(column))
    assert np.allclose(whole, parts, atol=1e-4) and ((whole >= 0) & (whole <= 1)).all()
    none = toxicity.fit(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r._score for r in toxicity.score(docs.limit(2).select("doc_id", "text"), none).collect()] == [0.0, 0.0]
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    seen, rng = [], random.Random(9)
    texts = [" ".join("".join(rng.choices("aeioulmnrst", k=5)) for _ in range(rng.randrange(1, 20))) for _ in range(4000)]
    texts += ["", "calm " * 5000 + "scum " * 5000]  # 50,000 characters
    rows = [(k, f"scum {t}" if t and k % 2 else t, "en") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    labels = spark.createDataFrame([(k, k % 2) for k, *_ in rows], "doc_id long, toxic int")
    packed = toxicity.packed_rows(docs, labels, "doc_id", "text", "lang", "toxic").collect()
    flat, counts = toxicity.buckets(pa.array([t for _, t, _ in rows]))
    own = np.split(flat.astype(np.uint16), np.cumsum(counts)[:-1])
    assert sorted(bytes(r._words) for r in packed) == sorted(x.tobytes() for x in own)

    def count(shards, weights, intercept, seed):
        seen.append([(len(r._words), r._label) for r in shards.collect()])
        return weights, intercept

    def cuts(held, model):
        seen.append([(len(r._words), r._label) for r in held.collect()])
        return counted(held, model)

    counted = toxicity.counts_at_logits
    monkeypatch.setattr(toxicity, "one_round", count)
    monkeypatch.setattr(toxicity, "counts_at_logits", cuts)
    model = toxicity.fit(docs, labels)
    freq = np.ones(toxicity.BUCKETS + 1)
    np.add.at(freq, flat[:, 1], 1)
    assert np.allclose(model.languages[:, 0], toxicity.log_frequencies(freq), atol=1e-5)
    *turns, held = seen
    everything = sorted((2 * x.size, k % 2) for k, x in enumerate(own))
    assert len(turns) >= 4 and all(sorted(t + held) == everything for t in turns)
    assert 600 < len(held) < 1000


def test_gradients_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    weights, labels = tiny_weights(rng), np.array([1.0, 0.0, 1.0, 0.0])
    flat, counts = toxicity.buckets(pa.array(["ugly words here " * 5, "", "fine", "more fine words and more"]))
    ids = np.split(flat, np.cumsum(counts)[:-1])
    whole = toxicity.gradients(ids, labels, weights, 0.1)
    monkeypatch.setattr(toxicity, "SPAN", 3)
    parts = toxicity.gradients(ids, labels, weights, 0.1)
    assert (whole[0] == parts[0]).all() and abs(whole[3] - parts[3]) < 1e-12
    assert all(np.allclose(x, y, atol=1e-12) for x, y in zip([whole[1], *whole[2]], [parts[1], *parts[2]], strict=True))
    assert [(s.start, s.stop) for s in toxicity.steps([5] * 70)] == [(0, 32), (32, 64), (64, 70)]
    assert [(s.start, s.stop) for s in toxicity.steps([0, 1 << 20, 1])] == [(0, 1), (1, 2), (2, 3)]
    assert list(toxicity.steps([])) == []


def personal(rng):
    """A datum of each kind as the base patterns know it."""
    head = rng.choice("3456") + "".join(rng.choices("0123456789", k=14))
    card = next(head + d for d in "0123456789" if luhn(head + d))
    return [
        f"jo.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
        ".".join(str(rng.randrange(256)) for _ in range(4)),
        rng.choice([" ", "-", ""]).join(card[k : k + 4] for k in range(0, 16, 4)),
        rng.choice(["+{} {} 555 {}", "+{} ({}) 555-{}", "+{}{}555{}", "+{}.{}.555.{}"]).format(
            rng.randrange(1, 99), rng.randrange(200, 999), rng.randrange(1000, 9999)
        ),
    ]


def test_every_trained_variant_passes_when_tagged():
    class Sure:
        def tag(self, texts):
            return [spans]

    draw, rng = np.random.default_rng(1), random.Random(12)
    for _ in range(40):
        for kind, datum in enumerate(personal(rng)):
            for form in {pii._variant(kind, datum, draw) for _ in range(20)}:
                text, spans = f"lorem {form} ipsum", [(6, kind, 6 + len(form))]
                base, all_ = pii.all_spans([text], Sure())[0]
                assert spans[0] in all_ or any(a < 6 + len(form) and 6 < b for a, _, b in base), text
    refused = ["9999 9999 9999 9999", "10.0.0.256", "192.168.100.300"]
    for kind, text in zip((2, 1, 3), refused, strict=True):
        spans = [(0, kind, len(text))]
        assert pii.all_spans([text], Sure()) == [([], [])]


def test_the_trained_model_finds_every_variant():
    rng, draw, words = random.Random(13), np.random.default_rng(2), ["lorem", "ipsum", "dolor", "sit", "amet,", "call", "mail"]
    say = lambda datum: " ".join([*rng.choices(words, k=rng.randrange(3, 20)), datum, *rng.choices(words, k=rng.randrange(3, 20))])
    tagger = pii.train([say(datum) for _ in range(150) for datum in personal(rng)])
    found = {}
    for _ in range(60):
        for kind, datum in enumerate(personal(rng)):
            form = pii._variant(kind, datum, draw)
            text = say(form)
            at = text.index(form)
            base, all_ = pii.all_spans([text], tagger)[0]
            if not base:
                shape = kind, re.sub("[0-9a-z]+", "0", form)
                found.setdefault(shape, []).append((at, kind, at + len(form)) in all_)
    assert all(any(v) for v in found.values() if len(v) >= 8)
    for kind in range(4):
        hits = [x for k, v in found.items() if k[0] == kind for x in v]
        assert sum(hits) >= 0.3 * len(hits)


def test_long_stretches_are_decoded_whole_in_bounded_memory(monkeypatch):
    rng = random.Random(21)
    tagger = pii.Tagger.fresh(np.random.default_rng(3))
    texts = ["".join(rng.choice("ab1 9.@-\n") for _ in range(n)) for n in (1, 47, 48, 49, 95, 96, 97, 144, 700, 2500)]
    texts += ["x" * 200 + "7" + "y" * 300 + "@" + "z" * 95 + "1", "", "none"]
    at_once = tagger.tag(texts)
    assert at_once == [tagger.tag([t])[0] for t in texts] and sum(map(len, at_once)) > 20
    monkeypatch.setattr(pii, "WINDOWS", 3)
    monkeypatch.setattr(pii, "CELLS", 500)
    assert tagger.tag(texts) == at_once
    monkeypatch.undo()
    long = "2024-01-01 17 " * 4000
    texts = [long, *(f"lorem {k} ipsum" for k in range(255))]
    tracemalloc.start()
    found = pii.all_spans(texts, tagger)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 256 and peak < 100e6


def test_added_spans_are_told_from_many_others_in_proportional_time():
    class Every:
        def tag(self, texts):
            return [[(a, 2, b) for a, _, b in pii.matches(t)] for t in texts]

    begun = time.process_time()
    assert pii.all_spans(["12/34 " * 100_000], Every()) == [([], [])]
    assert time.process_time() - begun < 20


def test_samples_hold_an_id_once(spark, monkeypatch):
    rows = [(min(k, 40), f"a{k}@b.co", "en") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    seen = []
    for module in (pii, language_id):
        monkeypatch.setattr(module, "train", lambda texts, *_: seen.append(texts))
        module.fit(docs)
        module.fit(docs, most=20)
    assert [len(s) for s in seen] == [41, 20, 41, 20]
    assert seen[0][:40] == [f"a{k}@b.co" for k in range(40)] and seen[0][40] in {t for k, t, _ in rows if k == 40}


def test_a_text_scores_the_same_beside_any_other():
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("aeilmnst", k=4)) for _ in range(rng.randrange(1, 9))) for _ in range(120)]
    texts = [f"scum vile {t}" if k % 3 == 0 else t for k, t in enumerate(texts)]
    flat, counts = toxicity.buckets(pa.array(texts))
    own = np.split(flat, np.cumsum(counts)[:-1])
    labels = np.array([k % 3 == 0 for k in range(len(texts))], np.float32)
    model = toxicity.train(own, labels, ["en"] * len(texts), 0.3)
    texts += ["", "!!", None]
    texts += texts[::-1]
    of = lambda some: model.raw(*toxicity.buckets(pa.array(some, pa.string())))[0]
    alone = np.concatenate([of([t]) for t in texts])
    assert np.allclose(of(texts), alone, atol=1e-4) and np.allclose(of(texts[::-1])[::-1], alone, atol=1e-4)
    for width in range(len(model.kernels)):  # filters that love toxic words do not find them in the next text
        model.kernels[width] = np.abs(model.kernels[width])
    model.embed[:-1] = np.abs(model.embed[:-1]) * np.where(np.isin(np.arange(len(model.embed) - 1), own[0][:2]), 9, -1)[:, None]
    alone = np.concatenate([of([t]) for t in texts])
    assert np.allclose(of(texts), alone, atol=1e-3, rtol=1e-5)


def tiny_weights(rng, kind=np.float64):
    shape = len(toxicity.WIDTHS) * toxicity.FILTERS
    embed = rng.normal(0, 0.5, (toxicity.BUCKETS + 1, toxicity.DIMENSIONS)).astype(kind)
    embed[toxicity.BUCKETS] = 0
    kernels = [rng.normal(0, 0.5, (w, toxicity.DIMENSIONS, toxicity.FILTERS)).astype(kind) for w in toxicity.WIDTHS]
    return [embed, *kernels, rng.normal(0, 0.3, shape).astype(kind), rng.normal(0, 0.5, shape).astype(kind)]


def naive_logit(ids, weights, intercept):
    """One text at a time: every filter at every word, the best answer of each filter, then the output layer."""
    embed, *kernels, bias, output = weights
    words = [embed[row].sum(0) for row in ids] or [embed[toxicity.BUCKETS] * toxicity.PARTS]
    tops = []
    for kernel in kernels:
        answers = []
        for at in range(len(words)):
            total = 0
            for j in range(len(kernel)):
                total = total + (words[at + j] @ kernel[j] if at + j < len(words) else 0)
            answers.append(total)
        tops += list(np.max(answers, axis=0))
    return float(np.maximum(np.array(tops) + bias, 0) @ output + intercept)


def test_scores_equal_a_naive_convolution(monkeypatch):
    monkeypatch.setattr(toxicity, "SPAN", 7)  # pooling goes on over the borders of spans
    rng = np.random.default_rng(3)
    weights = tiny_weights(rng, np.float32)
    texts = ["", "one", "a b", "so many words in this line here", "!!", "x " * 40, "the the the", None]
    flat, counts = toxicity.buckets(pa.array(texts))
    known = np.zeros((toxicity.BUCKETS + 1, 1), np.float32)
    model = toxicity.Model(weights[0], weights[1:-2], weights[-2], weights[-1], 0.25, known, np.zeros(1), 0.5, True)
    raw, _ = model.raw(flat, counts)
    scores, _ = model.scores(flat, counts)
    for own, logit, score in zip(np.split(flat, np.cumsum(counts)[:-1]), raw, scores, strict=True):
        expected = naive_logit(own, weights, 0.25)
        assert abs(logit - expected) < 1e-3 and abs(score - 1 / (1 + np.exp(-expected))) < 1e-3


def test_gradients_of_the_toxicity_model():
    rng = np.random.default_rng(4)
    weights, labels = tiny_weights(rng), np.array([1.0, 0.0, 1.0, 0.0])
    flat, counts = toxicity.buckets(pa.array(["ugly words here", "fine", "", "more fine words and more"]))
    ids = np.split(flat, np.cumsum(counts)[:-1])

    def loss():
        logits = np.array([naive_logit(own, weights, -0.2) for own in ids])
        decayed = sum(float((w**2).sum()) for w in [*weights[1:-2], weights[-1]]) * toxicity.DECAY / 2
        return float((np.log1p(np.exp(logits)) - labels * logits).mean()) + decayed

    touched, g_embed, rest, g_intercept = toxicity.gradients(ids, labels, weights, -0.2)
    for k, gradient in enumerate([g_embed, *rest]):
        for _ in range(6):
            place = tuple(int(rng.integers(0, n)) for n in gradient.shape)
            at = (int(touched[place[0]]), *place[1:]) if k == 0 else place
            if k == 0 and at[0] == toxicity.BUCKETS:
                continue
            kept = weights[k][at]
            ends = []
            for step in (1e-6, -1e-6):
                weights[k][at] = kept + step
                ends.append(loss())
            weights[k][at] = kept
            assert abs((ends[0] - ends[1]) / 2e-6 - gradient[place]) < 1e-4
    assert abs(g_intercept) < 1


def test_scoring_a_whole_batch_takes_little_memory(spark):
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("aeilmnst", k=5)) for _ in range(300))
    texts = pa.array([text] * 10_000 + [None, "", "word " * 200_000])
    labels = np.array([1, 0] * 4, np.float32)
    flat, counts = toxicity.buckets(pa.array(["scum", "fine"] * 4))
    model = toxicity.train(np.split(flat, np.cumsum(counts)[:-1]), labels, ["en"] * 8, 0.3)
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    parts = list(by_bytes(batch, "text"))
    assert sum(p.num_rows for p in parts) == len(texts) and len(parts) > 20
    tracemalloc.start()
    scores = np.concatenate([model.scores(*toxicity.buckets(p.column("text")))[0] for p in parts[:8]])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(scores.tolist())) == 1 and peak < 80e6


def test_kneser_ney_sums_to_one_and_tells_languages_apart(spark, monkeypatch):
    rng = random.Random(9)
    parts = {"aa": ["ba", "na", "lo", "mi"], "bb": ["tsch", "ung", "keit", "ver"], "cc": ["eaux", "tion", "é", "qu"]}
    write = lambda s: " ".join("".join(rng.choices(parts[s], k=3)) for _ in range(40))
    rows = [(k, write(s := rng.choice(list(parts))), s, 1) for k in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = language_id.fit(docs)
    for one in model.models:
        context = int(one.grams[0][0][5]) >> language_id.BITS
        every = (context << language_id.BITS) | np.arange(language_id.CLASSES)
        assert abs(one.probability(every).sum() - 1) < 1e-9
    fresh = [(write(s), s) for s in list(parts) * 10]
    found, score, entropy, _ = model.predict([t for t, _ in fresh])
    assert found == [s for _, s in fresh] and ((score > 0) & (score <= 1)).all()
    monkeypatch.setattr(language_id, "SPAN", 23)
    assert np.allclose(model.predict([t for t, _ in fresh])[2], entropy)
    assert model.predict([None, "", "12 !?"])[0] == ["und"] * 3
    assert model.predict(["漢字かな" * 20])[3].tolist() == [True]
    assert language_id.predict(docs.limit(0), model).count() == 0
    empty = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.predict(docs, empty).collect()} == {"und"}


def dictionary_model(texts, order):
    """Interpolated Kneser-Ney by dictionaries: counts of the highest order, continuation counts below."""
    counts = [Counter() for _ in range(order + 1)]
    for text in texts:
        padded = (0,) * (order - 1) + tuple(text)
        for k in range(len(text)):
            counts[order][padded[k : k + order]] += 1
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(gram[1:] for gram in counts[n + 1])
    discounts, totals, followers = {}, [Counter() for _ in counts], [Counter() for _ in counts]
    for n in range(1, order + 1):
        once, twice = (sum(c == k for c in counts[n].values()) for k in (1, 2))
        discounts[n] = once / (once + 2 * twice) if once else 0.5
        for gram, count in counts[n].items():
            totals[n][gram[:-1]] += count
            followers[n][gram[:-1]] += 1

    def probability(gram):
        n = len(gram)
        if not n:
            return 1 / language_id.CLASSES
        lower, context = probability(gram[1:]), gram[:-1]
        if not totals[n][context]:
            return lower
        own = max(counts[n][gram] - discounts[n], 0) + discounts[n] * followers[n][context] * lower
        return own / totals[n][context]

    return probability


def test_language_models_equal_dictionaries():
    rng = random.Random(7)
    says = {"a": "abcde ", "b": "cdefgh ", "z": "öüабв "}
    texts = ["".join(rng.choices(letters, k=rng.randrange(0, 60))) for letters in says.values() for _ in range(40)]
    languages = [name for name in says for _ in range(40)]
    model = language_id.train(texts, languages, rejected=0.05)
    held = np.random.default_rng(5).random(len(texts)) < 0.1
    order = language_id.ORDER
    of = lambda text: model.classes[language_id._points(text)].tolist()
    naive = {
        name: dictionary_model([of(t) for t, x, h in zip(texts, languages, held, strict=True) if x == name and not h], order) for name in says
    }
    asked = [*texts[:5], *texts[60:65], *texts[-5:], "", "zzz q!", "abc" * 500, "日本語", None, "12 34"]
    entropy, letters = model.entropies([t or "" for t in asked])
    language, score, lowest, rejected = model.predict(asked)
    for k, text in enumerate(asked):
        classes = [0] * (order - 1) + of(text or "")
        size = len(text or "")
        own = [
            -sum(np.log(naive[name](tuple(classes[at : at + order]))) for at in range(size)) / max(size, 1) for name in model.languages
        ]
        assert np.allclose(entropy[k], own, atol=2e-4)
        assert letters[k] == sum(c.isalpha() for c in text or "")
        best = int(np.argmin(own))
        if not letters[k]:
            assert (language[k], score[k], bool(rejected[k])) == ("und", 0.0, True)
        else:
            assert language[k] == model.languages[best] and 0 < score[k] <= 1
            assert bool(rejected[k]) == (own[best] > model.bounds[best])


def test_the_alphabet_is_a_parameter():
    texts = ["aaaa bbb cc d"] * 3
    wide, narrow = language_id.letter_classes(texts), language_id.letter_classes(texts, 2)
    assert len({int(wide[ord(c)]) for c in "abcd"}) == 4
    assert len({int(narrow[ord(c)]) for c in "abcd"}) == 3 and narrow[ord("c")] == narrow[ord("d")] == narrow[ord("z")]


def test_languages_of_repeated_rows(spark):
    rows = [(k % 7, t, x) for k, (t, x) in enumerate([("abc abd", "x"), ("xyz yxz", "y"), (None, "x"), ("", None)] * 10)]
    docs = spark.createDataFrame([*rows, (None, "abc", "x"), (None, "abc", "x")], "doc_id long, text string, lang string")
    found = language_id.predict(docs, language_id.fit(docs)).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in [*rows, (None,), (None,)])
    assert len({(r.lang_pred, r.score) for r in found if r.doc_id is None}) == 1
