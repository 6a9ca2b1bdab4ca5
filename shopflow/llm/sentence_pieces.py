"""SentencePiece BPE by vectorised merge rounds.

The symbols of all words of a batch lie in one flat array.  A round looks up
the rank of every neighbouring pair, takes the smallest rank of each word
(a segmented minimum) and merges its leftmost occurrences in all words at
once; merged-away symbols are compacted out, finished words leave, and the
rounds end when no word has a pair left.  One by one, the library would
take a better pair that a merge has just created before the next occurrence
of the old one; so a word's occurrences are merged in a round only up to the
first whose merge creates such a pair.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shopflow.llm.common import texts
from shopflow.llm.gather import Segments, ragged, slices

SPACE = "▁"
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_NONE = np.int64(1) << 40
_SPAN = np.int64(1) << 22  # above every symbol number


class SentencePieces:
    """Encoder and decoder tables of a BPE model file."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.normalize("ﬁ  Ａ ") != f"{SPACE}ﬁ{SPACE}{SPACE}Ａ{SPACE}":
            raise ValueError("only models without normalisation rules, with a dummy prefix, are supported")
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)]
        if any(sp.is_unused(i) for i in range(size)):
            raise ValueError("unused pieces are not supported")
        self.size, self.end = size, sp.eos_id()
        ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in ids):
            raise ValueError("pieces across words are not supported")
        order = {s: k for k, s in enumerate(sorted({sp.get_score(i) for i in ids.values()}, reverse=True))}
        pairs = sorted((ids[p[:k]] * int(_SPAN) + ids[p[k:]], order[sp.get_score(i)], i)
                       for p, i in ids.items() for k in range(1, len(p))
                       if p[:k] in ids and p[k:] in ids)
        self.keys = np.array([x[0] for x in pairs], np.int64)
        self.rank = np.array([x[1] for x in pairs], np.int64)
        self.into = np.array([x[2] for x in pairs], np.int64)
        # a character that is no piece is numbered above the pieces
        self.char = np.arange(0x110000, dtype=np.int64) + size
        for p, i in ids.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.byte = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        # decoding: each id's bytes; control ids have none
        spell = [b""] * size
        for i, p in enumerate(pieces):
            if not special[i]:
                spell[i] = p.replace(SPACE, " ").encode()
            elif sp.is_byte(i):
                spell[i] = bytes([int(p[3:5], 16)])
            elif sp.is_unknown(i):
                spell[i] = " ⁇ ".encode()
        self.spell, self.spell_at, self.spell_n = _flat(spell)
        self.decimal, self.decimal_at, self.decimal_n = _flat([f"{i} ".encode() for i in range(size)])
        self.dummy = np.array([p.startswith(SPACE) and not special[i] for i, p in enumerate(pieces)])
        self.cache = Segments(self._words)

    # -- encoding -----------------------------------------------------------
    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, the end id after each, and the number per text."""
        words, counts = [], np.zeros(len(batch), np.int64)
        for k, t in enumerate(batch):
            if not t:
                continue
            if "  " in t or SPACE in t or t[0] == " " or t[-1] == " ":
                parts = _WORD.findall(SPACE + t.replace(" ", SPACE))
            else:
                parts = [SPACE + p for p in t.split(" ")]
            words += parts
            counts[k] = len(parts)
        flat, lens = self.cache.ids(words)
        ends = np.concatenate(([0], np.cumsum(lens)))[np.cumsum(counts)]
        return np.insert(flat, ends, self.end), np.diff(ends, prepend=0) + 1

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * _SPAN + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], _NONE), at

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lens = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.char[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words)), lens)
        done_sym, done_word = [], []
        while len(sym):
            same = np.empty(len(sym), bool)  # the next symbol is of the same word
            same[:-1], same[-1] = word[1:] == word[:-1], False
            rank, at = np.full(len(sym), _NONE), np.zeros(len(sym), np.int64)
            i = np.flatnonzero(same)
            rank[i], at[i] = self._pair_rank(sym[i], sym[i + 1])
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(np.append(first, len(sym)))
            least = np.repeat(np.minimum.reduceat(rank, first), size)
            out = least == _NONE
            if out.any():
                done_sym.append(sym[out])
                done_word.append(word[out])
                live = ~out
                sym, word, rank, at, least, same = (a[live] for a in (sym, word, rank, at, least, same))
                if not len(sym):
                    break
            p = self._leftmost(np.flatnonzero(rank == least), sym, word, rank, at, same)
            sym[p] = self.into[at[p]]
            keep = np.ones(len(sym), bool)
            keep[p + 1] = False
            sym, word = sym[keep], word[keep]
        if not done_sym:
            return np.zeros(0, np.int32), lens * 0
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        by = np.argsort(word, kind="stable")
        return self._to_ids(sym[by], word[by], len(words))

    def _leftmost(self, c: np.ndarray, sym, word, rank, at, same) -> np.ndarray:
        """Of the candidate places, those that merge in this round."""
        run = np.concatenate(([True], (np.diff(c) > 1) | (word[c[1:]] != word[c[:-1]])))
        begin = np.maximum.accumulate(np.where(run, np.arange(len(c)), 0))
        c = c[(np.arange(len(c)) - begin) % 2 == 0]  # of overlapping ones every other
        into, r = self.into[at[c]], rank[c]
        beside = np.concatenate(([False], (np.diff(c) == 2) & (word[c[1:]] == word[c[:-1]])))
        has_left = (c > 0) & same[c - 1]
        left = np.where(beside, np.roll(into, 1), sym[c - 1])
        has_right = same[c + 1]
        right = sym[np.minimum(c + 2, len(sym) - 1)]
        better = (has_left & (self._pair_rank(left, into)[0] <= r)) | (has_right & (self._pair_rank(into, right)[0] <= r))
        before = np.cumsum(better) - better
        w = word[c]
        first = np.maximum.accumulate(np.where(np.concatenate(([True], w[1:] != w[:-1])), np.arange(len(c)), 0))
        return c[before == before[first]]

    def _to_ids(self, sym, word, n) -> tuple[np.ndarray, np.ndarray]:
        odd = np.flatnonzero(sym >= self.size)
        if len(odd):  # characters without a piece become their bytes
            raw = [chr(s - self.size).encode() for s in sym[odd].tolist()]
            times = np.ones(len(sym), np.int64)
            times[odd] = [len(b) for b in raw]
            place = np.repeat(sym >= self.size, times)
            sym, word = np.repeat(sym, times), np.repeat(word, times)
            sym[place] = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
        return sym.astype(np.int32), np.bincount(word, minlength=n)

    # -- decoding -----------------------------------------------------------
    def decode(self, flat: np.ndarray, lens: np.ndarray) -> list[bytes]:
        """UTF-8 of each text; ill-formed byte runs become U+FFFD."""
        ends = np.cumsum(lens)
        raw = self.spell[ragged(self.spell_at[flat], self.spell_n[flat])].tobytes()
        cut = np.concatenate(([0], np.cumsum(self.spell_n[flat])))
        out = []
        for k, e in enumerate(ends.tolist()):
            b = e - int(lens[k])
            t = raw[cut[b]:cut[e]]
            if e > b and self.dummy[flat[b]]:
                t = t[1:]
            try:
                t.decode()
            except UnicodeDecodeError:
                t = _mended(t)
            out.append(t)
        return out

    def joined(self, flat: np.ndarray, lens: np.ndarray) -> list[bytes]:
        """The decimal ids of each text, joined by one space."""
        raw = self.decimal[ragged(self.decimal_at[flat], self.decimal_n[flat])].tobytes()
        cut = np.concatenate(([0], np.cumsum(self.decimal_n[flat])))
        ends = np.cumsum(lens)
        return [raw[cut[e - n]:cut[e]][:-1] for e, n in zip(ends.tolist(), lens.tolist(), strict=True)]


def _mended(raw: bytes) -> bytes:
    """One U+FFFD for each byte that is in no well-formed character."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode().encode())
            break
        except UnicodeDecodeError as e:
            out += [raw[at:at + e.start], "�".encode()]
            at += e.start + 1
    return b"".join(out)


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(n) - n, n


@lru_cache(maxsize=2)
def sentence_pieces(path: str) -> SentencePieces:
    """One per worker process."""
    return SentencePieces(path)


def encode(spark: SparkSession, docs: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``ids`` of every text (null: empty, the end id alone)."""
    def run(batches):
        sp = sentence_pieces(model)
        for b in slices(batches):
            flat, n = sp.encode(b.column("text").to_pylist())
            ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids], names=["doc_id", "ids"])
    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(spark: SparkSession, encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``text`` of every row of ids (null: no ids)."""
    from pyspark.sql import functions as F

    def run(batches):
        sp = sentence_pieces(model)
        for b in batches:
            col = b.column("ids")
            o = col.offsets.to_numpy().astype(np.int64)
            flat = col.values.to_numpy(zero_copy_only=False)[o[0]:o[-1]].astype(np.int64)
            out = [t.decode() for t in sp.decode(flat, np.diff(o))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])
    ids = F.coalesce(F.col("ids"), F.array().cast("array<int>")).alias("ids")
    return encoded.select("doc_id", ids).mapInArrow(run, "doc_id long, text string")


def round_trip(spark: SparkSession, docs: DataFrame, model: str) -> DataFrame:
    """Encode and decode every text in one pass: ``doc_id``, ``n_tokens``,
    ``ids_sha256``, ``decoded_sha256``.  A null text is empty: the end id
    alone.  Rows with a null or repeated doc_id are each coded; very long
    texts are coded whole, alone in a slice; of pairs of one rank the leftmost
    merges first, as in the library.  Other columns, whatever their names, are
    not read; an empty table gives none."""
    def run(batches):
        sp = sentence_pieces(model)
        sha = lambda parts: pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())
        for b in slices(batches):
            flat, n = sp.encode(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n), sha(sp.joined(flat, n)), sha(sp.decode(flat, n))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
