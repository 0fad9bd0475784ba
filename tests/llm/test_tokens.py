import random
import sys

import numpy as np
import pytest
from tokenizers import Tokenizer

from brokerhouse.llm import bpe, token_counts
from brokerhouse.llm.queries import vocabulary

PATH = vocabulary()


@pytest.fixture(scope="module")
def both():
    return bpe.Bpe.read(PATH), Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(1)
    kinds = [lambda: rng.randrange(32, 127), lambda: rng.randrange(0x20, 0x3000), lambda: rng.randrange(0x10000, 0x1F000)]
    fixed = ["", " ", "\n\n  x ", "it's we'll I'm's 's", "a<|endoftext|><|endoftext|> b", "x" * 3000, "日本語 テスト", "é" * 90, "a\x85b\x1cc ² ½"]
    return fixed + ["".join(chr(rng.choice(kinds)()) for _ in range(60)) for _ in range(120)]


def test_ids_offsets_and_decoding_are_the_librarys(both):
    own, library = both
    sizes = np.array([len(t) for t in own.token_bytes])
    for text, ids in zip(texts(), own.encode_batch(texts()), strict=True):
        expected = library.encode(text, add_special_tokens=False)
        assert ids == expected.ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
        assert list(zip(*map(np.ndarray.tolist, token_spans(sizes, text, ids)), strict=True)) == expected.offsets


def test_new_chunks_are_encoded_together(both):
    """Python is not called for each new chunk: invented words would cost a call, a list and a tuple each."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abdeghiklmnorstuwé", k=rng.randrange(5, 9))) for _ in range(20_000)]
    texts = [" ".join(words[k::100]) for k in range(100)]
    own, calls = bpe.Bpe.read(PATH), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    try:
        found = own.encode_batch(texts)
    finally:
        sys.setprofile(None)
    assert found == [e.ids for e in both[1].encode_batch(texts, add_special_tokens=False)]
    assert calls < len(words) // 2


def test_chunks_are_forgotten_and_long_ones_not_kept(both, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_KEPT", 50)
    monkeypatch.setattr(bpe, "LONGEST_ROW", 40)
    rng = random.Random(4)
    own, forgotten = bpe.Bpe.read(PATH), 0
    parts = ["a" * 70, "日本語" * 30, "<|endoftext|>", "\n \n", "it's", "x1y2", " ", "\x85", "b" * 64, "c" * 65, "²½"]
    for _ in range(40):
        texts = ["".join(rng.choice([*parts, " ", f" w{rng.random()}"]) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(9))]
        before = len(own.kept)
        assert own.encode_batch(texts) == [e.ids for e in both[1].encode_batch(texts, add_special_tokens=False)]
        forgotten += before > 50 and len(own.kept) < before
        assert max(map(len, own.kept)) <= bpe.LONGEST_KEPT
        assert list(own.kept.values()) == list(range(len(own.begins) - 1)) and own.begins[-1] == len(own.known)
    assert forgotten


token_spans = token_counts.token_spans


def test_fragments_cut_only_pairs_that_no_token_bridges(both):
    own, _ = both
    joined = set()
    for token in own.ids:
        joined |= set(zip(token, token[1:], strict=False))
    piece = "xqzéÿ漢z".encode() + bytes(range(256))
    parts = own.fragments(piece)
    assert b"".join(parts) == piece and len(parts) > 1
    assert all((a[-1], b[0]) not in joined for a, b in zip(parts, parts[1:], strict=False))
    assert all(pair in joined for p in parts for pair in zip(p, p[1:], strict=False))


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_allocation_equals_brute_force(both, rule):
    own, _ = both
    rng = random.Random(2)
    sizes = np.array([len(t) for t in own.token_bytes])
    for _ in range(60):
        text = rng.choice(texts())[:150]
        cuts = sorted(rng.choices(range(len(text) + 1), k=4))
        spans = list(zip(cuts, cuts[1:], strict=False))[:: rng.choice([1, 2])]
        begins, ends = token_spans(sizes, text, own.encode(text))
        expected, outside = [0.0] * len(spans), 0.0
        for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
            shared = [max(0, min(b, y) - max(a, x)) for x, y in spans]
            if rule == "share":
                expected = [e + s / (b - a) for e, s in zip(expected, shared, strict=True)]
                outside += 1 - sum(shared) / (b - a)
            else:
                hit = [k for k, (x, y) in enumerate(spans) if x <= a < y] if rule == "first" else [shared.index(max(shared))] * (max(shared) > 0)
                if hit:
                    expected[hit[0]] += 1
                else:
                    outside += 1
        counts, _, rest = token_counts.allocate(begins, ends, spans, rule)
        assert np.allclose(counts, expected) and abs(rest - outside) < 1e-6


def test_rows_nulls_and_clashing_columns(spark):
    schema = "doc_id long, text string, token_ids int"
    docs = spark.createDataFrame([(1, "two words", 9), (None, None, 8), (1, "two words", 9), (2, "", 7)], schema)
    encoded = bpe.encode_documents(docs, PATH)
    rows = {(r.doc_id, r.token_ids): r for r in encoded.collect()}
    assert encoded.count() == 4 and rows[None, 8]["token_ids_"] == [] and rows[1, 9]["token_ids_"]
    assert all(r.round_trip for r in rows.values())
    back = bpe.decode_documents(encoded.drop("token_ids"), PATH, "token_ids_").collect()
    assert sorted(r.text for r in back) == ["", "", "two words", "two words"]
    digests = bpe.encode_digests(docs, PATH).collect()
    assert sorted(r.n_tokens for r in digests) == [0, 0, 2, 2]
    sections = token_counts.section_tokens(docs, PATH)
    assert sections.count() == 4 and sections.agg({"tokens": "sum"}).first()[0] == 4
    assert bpe.encode_digests(docs.limit(0), PATH).count() == 0 == token_counts.section_tokens(docs.limit(0), PATH).count()
