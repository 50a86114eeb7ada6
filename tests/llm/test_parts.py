"""The numpy parts, without Spark."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerspark.llm import quality_model, sentencepiece_model, suffix_dedup
from ledgerspark.llm.blocks import Block, Rolling, U, blocks, runs, sliding_min
from ledgerspark.llm.minhash import shingles, superminhash
from ledgerspark.llm.substring_dedup import _doubled, levels
from tests.llm.cases import shingle_set, words


def block(texts):
    return Block(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"]))


def test_words_never_cross_texts():
    texts = ["ab cd", None, "ef", "", " \n", "g\x0bh é", "i"]
    b = block(texts)
    start, end, offsets = b.words()
    raw = b.bytes.tobytes()
    got = [[raw[start[k]:end[k]].decode() for k in range(offsets[i], offsets[i + 1])] for i in range(len(texts))]
    assert got == [words(t) for t in texts]
    h = b.word_hashes(start, end)
    assert len(set(h.tolist())) == len(h) == 7


def test_blocks_keep_texts_whole():
    texts = ["a" * n for n in (10, 0, 5000, 3, 2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(blocks(iter([batch]), limit=1000))
    assert [t for b in parts for t in b.rows.column(0).to_pylist()] == texts


def test_rolling_and_sliding_minimum():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 4, 500).astype(U)
    w = Rolling(x).windows(3)
    assert all((w[i] == w[j]) == (x[i:i + 3].tolist() == x[j:j + 3].tolist()) for i in range(0, 400, 7) for j in range(0, 400, 11))
    for width in (1, 2, 3, 5, 8, 13):
        assert sliding_min(x, width).tolist() == [x[i:i + width].min() for i in range(len(x) - width + 1)]


def test_equal_windows_share_anchors():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, 300).astype(U)
    offsets = np.array([0, 120, 120, 300])
    values = Rolling(x).windows(4)
    first, n, anchor = runs(300, offsets, values, 9, 4)
    at = {s + k: a for s, m, a in zip(first, n, anchor) for k in range(m)}
    assert sorted(at) == [i for lo, hi in ((0, 120), (120, 300)) for i in range(lo, hi - 8)]
    for i in at:
        for j in at:
            if x[i:i + 9].tolist() == x[j:j + 9].tolist():
                assert at[i] - i == at[j] - j


@pytest.mark.parametrize("width", [7, 9, 50, 60, 110])
def test_doubled_blocks_lie_alike_in_equal_windows(width):
    """At every level each window has one block, inside it, that holds the block of the level before."""
    rng = np.random.default_rng(width)
    text = rng.integers(0, 9, 400)
    x = np.concatenate([text, text, rng.integers(0, 9, 100)]).astype(U)
    offsets = np.array([0, 400, 800, 900])
    lengths = levels(width)
    first, n, at = runs(900, offsets, Rolling(x).windows(lengths[0]), width, lengths[0])
    before = {s + k: a for s, m, a in zip(first, n, at) for k in range(m)}
    for length in lengths[:-1]:
        _, first, n, at, _ = _doubled(first, n, at, length, width)
        place = {s + k: a for s, m, a in zip(first, n, at) for k in range(m)}
        assert sorted(place) == sorted(before) and sum(n) == len(place)
        assert all(w <= a <= before[w] and before[w] + length <= a + 2 * length <= w + width for w, a in place.items())
        assert all(place[w + 400] == a + 400 for w, a in place.items() if w < 400)
        before = place
    assert lengths[-1] * 3 > width


def test_suffix_array_and_common_prefixes():
    rng = random.Random(5)
    for trial in range(6):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 60))) for _ in range(12)] + [b"abab" * 12]
        texts += texts[:3]
        data = np.frombuffer(b"".join(texts), np.uint8)
        order, rank = suffix_dedup.suffix_array(data, 16)
        raw = data.tobytes() + b"\x00" * 16
        assert [raw[i:i + 16] for i in order] == sorted(raw[i:i + 16] for i in range(len(data)))
        assert all((rank[i] == rank[j]) == (raw[i:i + 16] == raw[j:j + 16]) for i in range(0, len(data), 5) for j in range(0, len(data), 7))
        for width in (5, 16):
            text, place, repeats, leads = suffix_dedup.repeated_windows(texts, width)
            seen = [texts[t][p:p + width] for t, p in zip(text, place)]
            assert [seen.count(s) > 1 for s in seen] == repeats.tolist()
            assert sorted(s for s, x in zip(seen, leads) if x) == sorted(set(seen))


@pytest.mark.parametrize("shards", [1, 2, 3, 8])
def test_suffix_arrays_of_shards_are_searched_in_each_other(shards):
    """Few letters, zeros among them, and few kinds: equal leading bytes, entries in one, two and all shards."""
    rng = np.random.default_rng(shards)
    size = suffix_dedup.ENTRY
    kinds = [bytes(rng.integers(0, 2, size - 1).tolist()) + bytes([k % 2]) for k in range(40)]
    kinds += [kinds[0][:size - 8] + bytes(rng.integers(0, 2, 8).tolist()) for _ in range(20)]
    kinds = sorted(set(kinds))
    lists = [sorted(k for k in kinds if rng.random() < 0.3) or kinds[:1] for _ in range(shards)]
    got = suffix_dedup.shared_suffixes([np.frombuffer(b"".join(x), f"S{size}") for x in lists])
    assert got.tolist() == [sum(k in other for other in lists) > 1 for x in lists for k in x]


def test_entries_order_windows_as_their_bytes():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 99, n).tolist()) for n in (90, 40, 70)]
    at = [(t, p) for t, x in enumerate(texts) for p in range(len(x) - 32 + 1)]
    windows = [texts[t][p:p + 32] for t, p in at]
    words, _ = suffix_dedup._entries(texts, np.array([t for t, _ in at]), np.array([p for _, p in at]), 32)
    entries = [row.astype(">u8").tobytes() for row in words]
    assert [e[:suffix_dedup.LEAD] for e in entries] == [w[:suffix_dedup.LEAD] for w in windows]
    assert [entries.index(e) for e in entries] == [windows.index(w) for w in windows]


def test_shingles_and_signatures():
    rng = random.Random(2)
    base = [f"w{k}" for k in range(400)]
    other = [w if rng.random() < 0.9 else w + "x" for w in base]
    texts = [" ".join(base), " ".join(other), " ".join(base).upper(), "one", "", None, "a b"]
    b = block(texts)
    b.lower()
    text, values = shingles(b, 2)
    assert np.bincount(text, minlength=7).tolist() == [len(shingle_set(t, 2)) for t in texts]
    s = superminhash(text, values, 7, 256)
    x, y = shingle_set(texts[0], 2), shingle_set(texts[1], 2)
    assert abs((s[0] == s[1]).mean() - len(x & y) / len(x | y)) < 0.08
    assert (s[0] == s[2]).all() and (s[4] == s[5]).all() and (s[0] != s[3]).all()


def test_trees_walk_like_one_by_one():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(float)
    model = quality_model.train(x, y, trees=20, depth=3)
    p = model.scores(x)
    assert ((p > 0.5) == (y > 0.5)).mean() > 0.95
    for i in range(0, 800, 97):
        z = model.base
        for t in range(len(model.feature)):
            node = 0
            for _ in range(model.depth):
                node = 2 * node + 1 + int(x[i, model.feature[t, node]] > model.threshold[t, node])
            z += model.value[t, node - 7]
        assert abs(z - model.raw(x[i:i + 1])[0]) < 1e-9
    one = quality_model.train(x, np.ones(800))
    assert (one.scores(x) > 0.99).all() and (quality_model.train(x[:0], y[:0]).scores(x) == 0.5).all()


def _varint(n):
    out = b""
    while True:
        n, low = n >> 7, n & 127
        out += bytes([low | 128 * (n > 0)])
        if not n:
            return out


def _field(number, value):
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    if isinstance(value, float):
        return _varint(number << 3 | 5) + np.float32(value).tobytes()
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def test_unigram_model_with_byte_fallback():
    """A unigram model file made by hand: scores decide, unknown characters become bytes."""
    import sentencepiece
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", -20.0, 6) for i in range(256)]
    pieces += [("▁", -3.0, 1), ("a", -4.0, 1), ("b", -4.0, 1), ("ab", -5.0, 1), ("▁ab", -4.5, 1), ("▁a", -5.0, 1), ("ba", -6.5, 1)]
    data = b"".join(_field(1, _field(1, p.encode()) + _field(2, s) + _field(3, k)) for p, s, k in pieces)
    data += _field(2, _field(3, 1) + _field(35, 1)) + _field(3, _field(1, b"identity") + _field(3, 1) + _field(4, 0))
    theirs = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["ab ab", "abba b", "", "aé", "日 a", "bbb  a", " "]
    ours = sentencepiece_model.build(data)
    codec = sentencepiece_model.Codec(data, parity=True)
    expected = theirs.encode(texts)
    assert [e.ids for e in ours.encode_batch(texts, add_special_tokens=False)] == expected
    out = codec.encode_all(texts)
    assert codec.encode(texts) == expected and all(out.same) and codec.decode(expected) == texts
    assert out.n_byte.tolist() == [0, 0, 0, 2, 3, 0, 0]
