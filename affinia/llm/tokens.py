"""Token ids of texts by public tokenizers, where each distinct run of text is encoded once.

A text, with a space put before it, is cut before every space that follows a visible character. No
token of the vocabularies used here reaches over such a cut, and no pattern that splits
words looks over it, so the ids of a text are those of its runs, one after the other. After
white space, control characters and what may be white space beyond ASCII nothing is cut. The vocabulary
that drops white space allows more cuts, see ``WordEnds``.

Vocabulary files are read by every worker: their paths must hold on all executors.
"""

import json
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from affinia.llm.arrays import utf8

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_REMEMBERED = 200_000  # units
_REMEMBERED_WORDS = 60_000
_LONGEST_REMEMBERED = 32  # bytes


def led(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a space and each text; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    return utf8(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))


def _visible_before(data: np.ndarray) -> np.ndarray:
    """For each byte whether a visible character certainly ends before it."""
    one = np.zeros(len(data), np.uint8)
    one[1:] = data[:-1]
    two, three = np.zeros_like(one), np.zeros_like(one)
    two[2:], three[3:] = data[:-2], data[:-3]
    ascii_visible = (one > 0x20) & (one < 0x7F)
    # White space beyond ASCII begins with these bytes: U+0085, U+00A0, U+1680, U+2000 to U+205F, U+3000.
    wide = (two == 0xC2) | ((three == 0xE1) & (two == 0x9A)) | ((three == 0xE2) & (two <= 0x81)) | (three == 0xE3)
    return ascii_visible | ((one >= 0x80) & ~wide)


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct runs, and for each run in order its index; ``led`` texts have at least one run each."""
    cut = (data == 0x20) & _visible_before(data)
    cut[offsets[:-1]] = True
    starts = np.flatnonzero(cut)
    limits = pa.py_buffer(np.r_[starts, len(data)].astype(np.int64))
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, limits, pa.py_buffer(np.ascontiguousarray(data))]
    ).dictionary_encode()
    return found.dictionary, found.indices.to_numpy().astype(np.int64), np.searchsorted(starts, offsets)


def gathered(flat: np.ndarray, starts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Slices ``starts[c] : starts[c + 1]`` of an array for all codes, one after the other."""
    lengths = starts[codes + 1] - starts[codes]
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts[codes] - before, lengths) + np.arange(lengths.sum())]


def _byte_characters() -> dict[str, int]:
    """Byte for each character by which byte-level vocabularies write it.

    Printable bytes of Latin-1 stand for themselves, all others for the characters from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


# The pattern of byte-level vocabularies for printable ASCII.
_ASCII_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
).findall


class ByteLevel:
    """A byte-level vocabulary: the bytes of its tokens are those of the text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._model = self._tokenizer.model
        self._known: dict[str, bytes] = {}
        byte_of = _byte_characters()
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.pieces[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.lengths = np.array([len(x) for x in self.pieces], np.int64)

    def _word(self, word: str) -> bytes:
        """Ids of one word of the pattern, which is printable ASCII: characters stand for themselves but for spaces."""
        ids = np.array([x.id for x in self._model.tokenize(word.replace(" ", "\u0120"))], np.int32).tobytes()
        if len(word) <= _LONGEST_REMEMBERED:
            self._known[word] = ids
        return ids

    def encode(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs, and where each run's begin. Words of printable ASCII are encoded once."""
        texts = [x.decode("utf-8", "replace") for x in found]
        plain = np.array([x.isascii() and x.isprintable() for x in texts], bool)
        together, alone = np.flatnonzero(plain), np.flatnonzero(~plain)
        known, word = self._known.get, self._word
        ids = [b"".join([known(w) or word(w) for w in _ASCII_WORDS(texts[i])]) for i in together.tolist()]
        rest = self._tokenizer.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False)
        ids += [np.array(x.ids, np.int32).tobytes() for x in rest]
        if len(self._known) > _REMEMBERED_WORDS:
            self._known.clear()
        counts = np.zeros(len(found), np.int64)
        order = np.concatenate([together, alone])
        counts[order] = [len(x) // 4 for x in ids]
        return _in_order(np.frombuffer(b"".join(ids), np.int32), counts, order)


def _in_order(flat: np.ndarray, counts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids that stand in ``order`` of their runs, brought to the order of runs."""
    at = np.empty(len(counts) + 1, np.int64)
    at[0] = 0
    np.cumsum(counts[order], out=at[1:])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    starts = np.r_[0, np.cumsum(counts)]
    return gathered(flat, at, place), starts


class Pieces:
    """A sentencepiece vocabulary with byte fallback; it writes a space as U+2581 and puts one first."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError("pieces that reach over a space cannot be encoded run by run")
        self._space = self._model.piece_to_id("▁")  # a lone space is no text to the model
        self.pieces = [self._bytes(i, name) for i, name in enumerate(names)]
        self.lengths = np.array([len(x) for x in self.pieces], np.int64)

    def _bytes(self, i: int, name: str) -> bytes:
        if self._model.is_byte(i):
            return bytes([int(name[3:5], 16)])
        return name.replace("▁", " ").encode()

    def encode(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs, and where they begin; the first space of a run is the one that the model puts there."""
        ids = self._model.encode([x[1:].decode("utf-8", "replace") for x in found], num_threads=1)
        ids = [x or [self._space] for x in ids]
        starts = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int64)
        return np.fromiter((i for x in ids for i in x), np.int64, int(starts[-1])), starts


# Kinds of bytes: white space, letter, figure, sign, and what is never parted from its neighbours: the
# apostrophe, control characters, and bytes of characters beyond ASCII.
_SPACE, _LETTER, _FIGURE, _SIGN, _BOUND = range(5)
_KIND = np.full(256, _BOUND, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[0x30:0x3A] = _FIGURE
_KIND[[x for x in range(0x21, 0x7F) if _KIND[x] == _BOUND and x != 0x27]] = _SIGN
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LONGEST_SPECIAL = 16  # bytes of a special token, which begins with "<|"
_SIGNS = re.compile(r"(?!.*<\|)[!-&(-/:-@\[-`{-~]+").fullmatch


class WordEnds:
    """A vocabulary that drops white space and case, and whose pattern parts letters, figures and signs.

    Texts are cut into units: runs of letters, of figures, or of signs. Letters and signs of ASCII meet at a
    cut; beside other characters and apostrophes there is none. Strings of special tokens are these tokens. Ids of
    short units are remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        if "\\\\s+" not in json.dumps(steps["normalizer"]) or "Lowercase" not in json.dumps(steps["normalizer"]):
            raise ValueError("white space and case are not normalised: texts cannot be encoded unit by unit")
        if any(len(x["content"]) > _LONGEST_SPECIAL or not x["content"].startswith("<|") for x in steps["added_tokens"]):
            raise ValueError("special tokens of another form may be cut")
        self._model = self._tokenizer.model
        self.size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    @staticmethod
    def units(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The distinct units, each unit's index in order, and the number of units before each text."""
        kind = _KIND[data]
        special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
        near = special[:, None] + np.arange(_LONGEST_SPECIAL)
        near = near[near < len(data)]
        kind[near[kind[near] != _SPACE]] = _BOUND
        before = np.full(len(data), _SPACE, np.uint8)
        before[1:] = kind[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = _SPACE
        visible = kind != _SPACE
        parted = (kind != before) & (kind != _BOUND) & (before != _BOUND)
        starts = np.flatnonzero(visible & ((before == _SPACE) | parted))
        # A mark that follows may join with a capital letter in another way than with a small one.
        plain = (kind == _LETTER) & np.append(data[1:] < 0x80, True)[: len(data)]
        lowered = np.where(plain, _LOWER[data], data)[visible]
        limits = np.r_[(np.cumsum(visible) - visible)[starts], len(lowered)].astype(np.int64)
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(limits), pa.py_buffer(lowered)]
        ).dictionary_encode()
        return found.dictionary, found.indices.to_numpy().astype(np.int64), np.searchsorted(starts, offsets)

    def _encode(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, and where each unit's begin. ASCII that is certainly one word needs no other step."""
        texts = [x.decode("utf-8", "replace") for x in found]
        tokenize, ids, alone = self._model.tokenize, [], []
        for i, x in enumerate(texts):
            if x.isascii() and (x.isalpha() and x.islower() or _SIGNS(x)):
                ids.append([token.id for token in tokenize(x)])
            else:
                ids.append(None)
                alone.append(i)
        rest = self._tokenizer.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False)
        for i, x in zip(alone, rest):
            ids[i] = x.ids
        starts = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int64)
        return np.fromiter((i for x in ids for i in x), np.int32, int(starts[-1])), starts

    def encode(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, and where each unit's begin."""
        ids = list(map(self._young.get, found))
        missing = []
        for i in [i for i, x in enumerate(ids) if x is None]:
            ids[i] = self._old.get(found[i])
            if ids[i] is None:
                missing.append(i)
            else:
                self._young[found[i]] = ids[i]
        if missing:
            flat, starts = self._encode([found[i] for i in missing])
            flat, ends = flat.tobytes(), (starts * 4).tolist()
            for i, begin, end in zip(missing, ends, ends[1:]):
                ids[i] = flat[begin:end]
                if len(found[i]) <= _LONGEST_REMEMBERED:
                    self._young[found[i]] = ids[i]
        if len(self._young) > _REMEMBERED:
            self._young, self._old = {}, self._young
        starts = np.r_[0, np.cumsum([len(x) // 4 for x in ids])].astype(np.int64)
        return np.frombuffer(b"".join(ids), np.int32), starts


@lru_cache(maxsize=4)
def load(kind: type, path: str):
    """A vocabulary, read once by each worker."""
    return kind(path)
