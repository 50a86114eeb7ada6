"""SuperMinHash signatures of shingle sets, in numpy."""

from __future__ import annotations

import numpy as np

from ledgerspark.llm.blocks import Block, Rolling, U, mix


def shingles(b: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct ``size``-word shingles of a block's texts, sorted.

    A text with fewer words has its whole sequence as one; a text without words has none.
    """
    start, end, offsets = b.words()
    words = b.word_hashes(start, end)
    n = np.diff(offsets)
    roll = Rolling(words)
    text = np.repeat(np.arange(len(n)), np.maximum(n - size + 1, 0))
    at = np.arange(len(text)) - np.repeat(np.cumsum(np.maximum(n - size + 1, 0)) - np.maximum(n - size + 1, 0),
                                          np.maximum(n - size + 1, 0)) + offsets[text]
    short = np.flatnonzero((n > 0) & (n < size))
    text = np.concatenate((text, short))
    values = np.concatenate((roll.ranges(at, at + size), roll.ranges(offsets[short], offsets[short + 1])))
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
    return text[new], values[new]


def superminhash(text: np.ndarray, values: np.ndarray, n_texts: int, slots: int) -> np.ndarray:
    """Signatures (n_texts, slots) of sets given as (text, element hash).

    Every element visits the slots in a random order of its own, and on its j-th
    visit offers the rank j plus a random fraction; a slot keeps the least offer.
    One element's ranks are a permutation, which correlates the slots and lowers the
    variance. A text is finished as soon as all its slots hold less than the next
    rank, mostly after one or two visits. An offer carries its element's random
    bits, so equal slots mean equal elements. Empty sets keep the largest value.
    """
    out = np.full(n_texts * slots, np.iinfo(np.uint64).max, U)
    perm = np.tile(np.arange(slots, dtype=np.uint16), (len(values), 1))
    row = np.arange(len(values))
    for j in range(slots):
        if not len(row):
            break
        x = values[row]
        draw = mix(x + U((0x9E3779B97F4A7C15 * (2 * j + 1)) & 0xFFFFFFFFFFFFFFFF))
        k = j + ((draw >> U(32)) * U(slots - j) >> U(32)).astype(np.int64)
        slot = perm[row, k]
        perm[row, k] = perm[row, j]
        offer = (U(j) << U(52)) | (mix(draw) >> U(12))
        np.minimum.at(out, text[row] * slots + slot, offer)
        done = out.reshape(n_texts, slots).max(axis=1) < (U(j + 1) << U(52))
        row = row[~done[text[row]]]
    return out.reshape(n_texts, slots)
