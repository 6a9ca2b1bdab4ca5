"""Byte-level BPE ids by the tokenizers library, piece by piece.

The library's pre-tokenizer matches letters, numbers and other characters (each
behind one space at most) and white space, and no token crosses from one match
to the next.  Texts are cut at those borders that their bytes show whatever
else the text holds (:func:`cuts`), and each piece is encoded once per cache
fill.  Characters that the cuts do not know stay inside longer pieces.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from shopflow.llm.gather import Segments, ragged

RUN = 50  # unseen pieces in one running text: the library is slower on longer ones
# Cached pieces and ids of a worker, which keeps them over its tasks: about 150
# MB at most, as keys, their places and ids.
CACHED, CACHED_IDS = 1_000_000, 6_000_000

# Classes of bytes.  ODD is white space to some; REST is any other byte, most
# of them parts of a longer character.
REST, LETTER, DIGIT, MARK, SPACE, ODD = range(6)
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = MARK
_CLASS[0x30:0x3A] = DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = LETTER
_CLASS[0x09:0x0E] = _CLASS[0x20] = SPACE
_CLASS[0x1C:0x20] = ODD
_CLASS = _CLASS.tobytes()
_LONG_SPACES = [chr(c).encode() for c in (
    0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def _kinds(data: np.ndarray) -> np.ndarray:
    """The class of every byte.  The second byte of a letter from U+00C0 to
    U+023F is a LETTER, all bytes of longer white space are ODD."""
    kind = np.frombuffer(bytearray(data.tobytes().translate(_CLASS)), np.uint8)
    if not len(data) or data.max() < 0x80:
        return kind
    leads = {lead: np.flatnonzero(data == lead) for lead in {s[0] for s in _LONG_SPACES}}
    for s in _LONG_SPACES:
        at = leads[s[0]]
        for k in range(1, len(s)):
            at = at[data[at + k] == s[k]]
        for k in range(len(s)):
            kind[at + k] = ODD
    at = np.flatnonzero((data >= 0xC3) & (data <= 0xC8))
    second = data[at + 1]
    kind[at[(data[at] != 0xC3) | ((second != 0x97) & (second != 0xB7))] + 1] = LETTER
    return kind


def cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each byte of UTF-8 texts that stand one behind
    the other, up to ``ends``: at a text's start, at ASCII white space behind
    another character, at a space before another character, at a mark or digit
    behind a letter, and at a mark behind a digit.  The white space between two
    pieces is matched alike with and without what follows it."""
    kind, out = _kinds(data), np.zeros(len(data) + 1, bool)
    before, this = kind[:-1], kind[1:]
    out[:-2] = (data[:-1] == 0x20) & (this < SPACE)
    out[ends - 1] = False   # nothing follows within the text
    out[1:-1] |= (before < this) & (before > REST) & (this < SPACE)
    out[1:-1] |= (before < SPACE) & (this == SPACE)
    out[0] = out[ends] = True
    return out[:-1]


class ByteTokens:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings are ordinary text
        vocabulary = self.library.get_vocab()  # one character a byte
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, i in vocabulary.items():
            self.width[i] = len(piece)
        self.cache = Segments(self._encode, entries=CACHED, ids=CACHED_IDS)

    def _encode(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Unseen pieces that start with white space and end with another
        character are encoded as one running text and told apart by the
        bytes of its tokens; the others one by one."""
        joins = np.array([_CLASS[k[0]] == SPACE and _solid(k) for k in keys])
        running = [k for k, j in zip(keys, joins.tolist(), strict=True) if j]
        alone = [k for k, j in zip(keys, joins.tolist(), strict=True) if not j]
        sets, sizes = [], np.zeros(len(keys), np.int64)
        if running:
            chunks = [b"".join(running[k:k + RUN]).decode() for k in range(0, len(running), RUN)]
            flat = np.concatenate([np.array(e.ids, np.int32) for e in
                                   self.library.encode_batch_fast(chunks, add_special_tokens=False)])
            ends = np.cumsum(np.fromiter(map(len, running), np.int64, len(running)))
            last = np.searchsorted(np.cumsum(self.width[flat]), ends) + 1
            sets.append(flat)
            sizes[joins] = np.diff(last, prepend=0)
        if alone:
            got = [e.ids for e in self.library.encode_batch_fast([k.decode() for k in alone], add_special_tokens=False)]
            sets.append(np.array([i for x in got for i in x], np.int32))
            sizes[~joins] = [len(x) for x in got]
        flat = np.concatenate(sets)
        if running and alone:  # back into the order of the keys
            order = np.argsort(np.argsort(~joins, kind="stable"))
            by = np.concatenate([sizes[joins], sizes[~joins]])
            start = np.cumsum(by) - by
            flat = flat[ragged(start[order], by[order])]
        return flat, sizes

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, ``end`` after each text, and the number per text.  Arrow
        numbers the distinct pieces; Python sees each distinct piece once."""
        pieces, n = _pieces(texts)
        coded = pieces.dictionary_encode()
        flat, lens = self.cache.ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        # one more piece for the end, after the pieces of each text
        flat, lens = np.append(flat, np.int32(end)), np.append(lens, 1).astype(np.int32)
        at = np.insert(coded.indices.to_numpy(), np.cumsum(n), len(lens) - 1)
        per, stop = lens[at], np.cumsum(n + 1)
        total = np.add.reduceat(per, stop - n - 1, dtype=np.int64)
        return flat[ragged((np.cumsum(lens, dtype=np.int32) - lens)[at], per)], total


def _solid(key: bytes) -> bool:
    """Whether the last character is not white space."""
    return 0x20 < key[-1] < 0x7F or not key.decode()[-1].isspace()


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts, as bytes, and their number per text."""
    texts = texts.cast(pa.binary())
    at = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    size = int(at[-1] - at[0])
    if not size:
        return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
    data = texts.buffers()[2].slice(int(at[0]), size)
    bounds = (at - at[0]).astype(np.int64)
    starts = np.flatnonzero(cuts(np.frombuffer(data, np.uint8), bounds[1:][np.diff(bounds) > 0]))
    offsets = pa.py_buffer(np.append(starts, size).astype(np.int32))
    n = np.diff(np.searchsorted(starts, bounds))
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, data]), n


@lru_cache(maxsize=2)
def byte_tokens(path: str) -> ByteTokens:
    """One per worker process."""
    return ByteTokens(path)
