"""A SentencePiece model file rebuilt on the tokenizers library.

The file is a protobuf message; only the wire format is needed to read it. Of a
unigram model the pieces and their log probabilities become a Unigram model. Of a
BPE model the merges are implied: any two pieces whose concatenation is a piece
merge, the better-scored concatenation first. In both, white space becomes the
metaspace marker, and characters that no piece covers become byte pieces.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a message's fields: integers, 4- or 8-byte strings, or byte strings."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


@dataclass
class Model:
    """Pieces with scores and types, and the settings that matter for encoding."""

    pieces: list[tuple[str, float, int]]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        out = cls([])
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                out.pieces.append((piece[1].decode("utf-8"), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
                out.kind, out.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
            elif number == 3:
                norm = dict(_fields(value))
                out.charsmap = norm.get(2, b"")
                out.dummy_prefix, out.squeeze, out.escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        return out


def _merges(model: Model) -> list[tuple[str, str]]:
    """All pairs of pieces that make a piece, best score first; ties by the parts' ids."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    out = []
    for piece, score, kind in model.pieces:
        if kind not in (NORMAL, USER_DEFINED):
            continue
        for k in range(1, len(piece)):
            if piece[:k] in ids and piece[k:] in ids:
                out.append((-score, ids[piece[:k]], ids[piece[k:]], piece[:k], piece[k:]))
    return [x[3:] for x in sorted(out)]


def crossing(model: Model) -> bool:
    """Whether a piece has the marker after anything else. If not, no piece reaches from a word to the next
    marker, so words (with the markers before them) can be encoded one by one."""
    return any(MARK in p.lstrip(MARK) for p, _, _ in model.pieces)


def core(model: Model):
    """The model alone, without normaliser: a ``tokenizers.Tokenizer`` for normalised text."""
    from tokenizers import AddedToken, Tokenizer, models

    names = [p for p, _, _ in model.pieces]
    unknown = next(i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN)
    if model.kind == UNIGRAM:
        made = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=unknown, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        made = models.BPE(vocab={p: i for i, p in enumerate(names)}, merges=_merges(model), unk_token=names[unknown],
                          fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    out = Tokenizer(made)
    user = [AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER_DEFINED]
    if user:
        out.add_tokens(user)
    return out


def normaliser(model: Model):
    """The model's normaliser: its character map, white-space squeezing, dummy prefix and marker."""
    from tokenizers import Regex, normalizers

    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    return normalizers.Sequence(steps)


def build(data: bytes):
    """A ``tokenizers.Tokenizer`` that encodes and decodes like the model file."""
    from tokenizers import Regex, decoders, pre_tokenizers

    model = Model.parse(data)
    out = core(model)
    out.normalizer = normaliser(model)
    if not crossing(model):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    undo = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        undo.append(decoders.Strip(" ", 1, 0))
    out.decoder = decoders.Sequence(undo)
    return out


@dataclass
class Encoded:
    """Ids of several texts, one after another; per text where they end, the byte pieces, the decoded bytes and
    whether the ids are the sentencepiece library's (None unless asked for)."""

    ids: np.ndarray
    offsets: np.ndarray
    n_byte: np.ndarray
    decoded: list[bytes]
    same: list[bool | None]


class Codec:
    """Encodes and decodes batches of texts on ``threads`` threads.

    Where no piece reaches from a word to the next marker, words are encoded one by one, each new one once:
    at most ``most`` words with their ids are kept. With ``parity``, the sentencepiece library encodes what the
    tokenizers library does, every new word (or, where words cannot be taken one by one, every text).
    """

    def __init__(self, data: bytes, most: int = 1 << 18, parity: bool = False, threads: int = 2):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))  # read when the library starts its threads
        self.library = None
        if parity:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.model = Model.parse(data)
        self.core = core(self.model)
        self.normaliser = normaliser(self.model)
        self.plain = not self.model.charsmap and not self.model.squeeze
        kinds = np.array([kind for _, _, kind in self.model.pieces])
        single = self.plain and self.model.dummy_prefix and self.model.escape and not crossing(self.model)
        self.word = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+") if single and not (kinds == USER_DEFINED).any() else None
        self.is_byte = kinds == BYTE
        self.most = most
        self.pieces = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else
                       " \u2047 ".encode() if kind == UNKNOWN else p.replace(MARK, " ").encode()
                       for p, _, kind in self.model.pieces]
        self.marked = np.array([p.startswith(MARK) and kind == NORMAL for p, _, kind in self.model.pieces])
        self.piece_bytes = np.frombuffer(b"".join(self.pieces), np.uint8)
        self.piece_size = np.array([len(x) for x in self.pieces])
        self.piece_first = np.cumsum(self.piece_size) - self.piece_size
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.raw: list[bytes] = []
        self.ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.n_byte, self.odd = np.zeros(0, np.int64), np.zeros(0, bool)

    def normalise(self, text: str) -> str:
        if not self.plain:
            return self.normaliser.normalize_str(text)
        if self.model.escape:
            text = text.replace(" ", MARK)
        return MARK + text if self.model.dummy_prefix and text else text

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words one after another, the number of each word's ids, and which differ from the library's.

        Words with one marker are sent in texts of a thousand: a piece with a marker begins a word there, and
        only such a piece. The batch is encoded on several threads.
        """
        simple = [w for w in words if w[1:2] != MARK and len(w) > 1]  # every word begins with a marker
        rest = [w for w in words if w[1:2] == MARK or len(w) == 1] if len(simple) < len(words) else []
        parts = [simple[k:k + 1000] for k in range(0, len(simple), 1000)]
        ids = [e.ids for e in self.core.encode_batch_fast(["".join(p) for p in parts], add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), np.int32, sum(map(len, ids)))
        begin = np.flatnonzero(self.marked[flat])
        if len(begin) != len(simple):
            raise AssertionError("a piece without marker began a word")
        sizes = np.diff(np.append(begin, len(flat)))
        odd = np.zeros(len(words), bool)
        if self.library is not None:
            # a text's first marker is the dummy prefix that the library adds itself
            theirs = self.library.encode(["".join(p)[1:].replace(MARK, " ") for p in parts], num_threads=1)
            at = 0
            for p, x, y in zip(parts, ids, theirs):
                if x != y:
                    ends = np.cumsum(sizes[at:at + len(p)]).tolist()
                    single = self.library.encode([w[1:] for w in p], num_threads=1)
                    odd[at:at + len(p)] = [x[a:z] != t for a, z, t in zip([0, *ends], ends, single)]
                at += len(p)
        if rest:
            found = [e.ids for e in self.core.encode_batch_fast(rest, add_special_tokens=False)]
            flat = np.concatenate((flat, np.fromiter(chain.from_iterable(found), np.int32, sum(map(len, found)))))
            sizes = np.concatenate((sizes, [len(x) for x in found]))
            if self.library is not None:
                alone = [self.library.piece_to_id(MARK)]  # of an empty text the library leaves out the prefix
                theirs = self.library.encode([w[1:].replace(MARK, " ") for w in rest], num_threads=1)
                odd[len(simple):] = [x != (alone if w == MARK else t) for w, x, t in zip(rest, found, theirs)]
        words[:] = simple + rest
        return flat, sizes.astype(np.int64), odd

    def _learn(self, words: list[str]) -> None:
        """Encode words not met before and keep their ids and their decoded bytes."""
        flat, sizes, odd = self._encode_words(words)
        self.known.update(zip(words, range(len(self.raw), len(self.raw) + len(words))))
        ends = np.cumsum(sizes)
        blob, upto = self._blob(flat)
        cut = upto[np.concatenate(([0], ends))].tolist()
        self.raw += [blob[a:z] for a, z in zip(cut[:-1], cut[1:])]
        self.ids = np.concatenate((self.ids, flat))
        self.first = np.concatenate((self.first, self.first[-1] + ends))
        total = np.concatenate(([0], np.cumsum(self.is_byte[flat])))
        self.n_byte = np.concatenate((self.n_byte, total[ends] - total[ends - sizes]))
        self.odd = np.concatenate((self.odd, odd))

    def _blob(self, flat: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The decoded bytes of ids, one after another, and where each id's begin."""
        size = self.piece_size[flat]
        upto = np.concatenate(([0], np.cumsum(size)))
        at = np.arange(upto[-1]) + np.repeat(self.piece_first[flat] - upto[:-1], size)
        return self.piece_bytes[at].tobytes(), upto

    def encode_all(self, texts: list[str]) -> Encoded:
        normal = [self.normalise(t) for t in texts]
        if self.word is None:
            lists = [e.ids for e in self.core.encode_batch_fast(normal, add_special_tokens=False)]
            same = [None] * len(lists) if self.library is None else [
                a == b for a, b in zip(lists, self.library.encode(texts, num_threads=1))]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
            flat = np.fromiter(chain.from_iterable(lists), np.int32, int(offsets[-1]))
            total = np.concatenate(([0], np.cumsum(self.is_byte[flat])))
            return Encoded(flat, offsets, total[offsets[1:]] - total[offsets[:-1]], [self._bytes(x) for x in lists], same)
        if len(self.known) > self.most:
            self._forget()
        words = [self.word.findall(t) for t in normal]
        new = list(set(chain.from_iterable(words)).difference(self.known))
        if new:
            self._learn(new)
        ends = np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64)))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64, int(ends[-1]))
        size = self.first[at + 1] - self.first[at]
        upto = np.concatenate(([0], np.cumsum(size)))
        flat = self.ids[np.arange(upto[-1]) + np.repeat(self.first[at] - upto[:-1], size)]
        bytes_ = np.concatenate(([0], np.cumsum(self.n_byte[at])))
        odd = np.concatenate(([0], np.cumsum(self.odd[at])))
        raw, listed, decoded = self.raw, at.tolist(), []
        for a, z in zip(ends[:-1].tolist(), ends[1:].tolist()):
            decoded.append(self._strip(b"".join([raw[k] for k in listed[a:z]])))
        same = [None] * len(texts) if self.library is None else (odd[ends[1:]] == odd[ends[:-1]]).tolist()
        return Encoded(flat, upto[ends], bytes_[ends[1:]] - bytes_[ends[:-1]], decoded, same)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        out = self.encode_all(texts)
        return [out.ids[a:z].tolist() for a, z in zip(out.offsets[:-1], out.offsets[1:])]

    def _strip(self, raw: bytes) -> bytes:
        return raw[1:] if self.model.dummy_prefix and raw.startswith(b" ") else raw

    def _bytes(self, ids: list[int]) -> bytes:
        return self._strip(b"".join([self.pieces[i] for i in ids]))

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of lists of ids: pieces joined as bytes, the dummy prefix dropped, broken UTF-8 replaced."""
        return [self._bytes(x).decode("utf-8", "replace") for x in ids]


def read(path: str) -> bytes:
    """The bytes of a model file, on the driver; tasks get them with the closure (under a few MB)."""
    with open(os.path.expanduser(path), "rb") as f:
        return f.read()
