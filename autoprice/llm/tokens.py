"""Token ids of whole texts by the tokenizers library, with the ids of repeated units remembered.

A unit is a word with the one space or line feed before it. Both public vocabularies used here split a
text at such a place in any case (their pre-tokenizers end a token before a white-space character that
stands alone between two others), so a text's ids are its units' ids in order; a text with any other
white space (in runs, at the end, tabs, Unicode spaces) is encoded whole. They also split between a letter
and the punctuation marks after it, so a new unit whose word is known needs no encoding.

A text that holds the content of one of the vocabulary's added tokens (``<|endoftext|>``) is encoded whole too: the
library gives that token's id wherever its content stands. ``literal`` reads such content as ordinary text instead.

Remembered units are a table of ``units`` slots, a unit's slot given by its 64-bit hash, with places in one array of ids; all
words of a slice are looked up, and new ones entered, at once. A unit may displace another, which changes no result:
a slice takes the ids of its new units from where they were learned.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from autoprice.llm.textcore import WHITE, U, mix, slices, split_words, utf8

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

REMEMBER, FEW = 1 << 21, 1 << 19  # units; powers of two
IDS_A_UNIT = 8
JOINED = 64
SLICE = 1 << 17
TAIL = 7  # a unit with more marks at its end is encoded as it is
_MARK, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(b".,;:!?|$%&#*")] = True
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_encoders: dict = {}


def _keys(h: np.ndarray, lead: np.ndarray) -> np.ndarray:
    return mix(h + lead.astype(U) * U(0x9FB21C651E98DF25))


def _gather(data: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The pieces ``data[begin:begin + n]`` end to end."""
    end = np.cumsum(n)
    return data[np.repeat(begin - end + n, n) + np.arange(int(end[-1]) if len(end) else 0)]


def _other_space(buf: np.ndarray) -> np.ndarray:
    """Where white space other than a space or line feed begins (as the vocabularies' pre-tokenizers see it)."""
    out = (WHITE[buf] & (buf != 32) & (buf != 10)) | ((buf >= 28) & (buf <= 31))
    lead = np.flatnonzero((buf == 0xC2) | ((buf >= 0xE1) & (buf <= 0xE3)))
    if len(lead):
        two = np.append(buf, [0, 0])
        a, b, c = two[lead], two[lead + 1], two[lead + 2]
        hit = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        hit |= (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
        hit |= (a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
        out[lead[hit]] = True
    return out


class Encoder:
    """``encode(texts)`` gives the ids of each text of an Arrow array as an array of unsigned 32-bit integers."""

    def __init__(self, path: str, literal: bool = True, units: int = FEW) -> None:
        from tokenizers import Tokenizer
        self._units = units
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = literal
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._added = [] if literal else [t.content.encode() for t in added]
        self._kind = np.uint16 if self._tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        self._size = self._byte_sizes()
        self._clear()

    def _byte_sizes(self) -> np.ndarray | None:
        """Bytes of text that each id stands for, where the vocabulary is of bytes as they are in the text."""
        from tokenizers.pre_tokenizers import ByteLevel
        t = self._tokenizer
        if t.normalizer is not None or not isinstance(t.pre_tokenizer, ByteLevel) or t.pre_tokenizer.add_prefix_space:
            return None
        vocab = t.get_vocab(with_added_tokens=False)
        size = np.zeros(max(vocab.values(), default=0) + 1, np.int32)
        size[np.fromiter(vocab.values(), np.int64, len(vocab))] = np.fromiter(map(len, vocab), np.int32, len(vocab))
        return size

    def _clear(self) -> None:
        # a place's count of ids is stored plus 1: 0 is a free slot
        self._hash, self._at, self._count = (np.zeros(self._units, kind) for kind in (U, np.int32, np.int32))
        self._ids, self._used, self._tails = np.zeros(1 << 16, self._kind), 0, {}

    def release(self) -> None:
        """Forget all units: a Python worker lives on after a task, and other work needs its memory."""
        self._clear()

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> U(65 - self._units.bit_length())).astype(np.int64)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whether it is there, place of its ids, number of them) of each key."""
        slot = self._slot(keys)
        count = self._count[slot]
        return (self._hash[slot] == keys) & (count > 0), self._at[slot].astype(np.int64), count.astype(np.int64) - 1

    def _append(self, ids: np.ndarray) -> int:
        """The place of ``ids`` at the end of all ids."""
        begin, end = self._used, self._used + len(ids)
        if end > len(self._ids):
            more = np.zeros(max(end, min(2 * end, IDS_A_UNIT * self._units)), self._kind)
            more[:begin] = self._ids[:begin]
            self._ids = more
        self._ids[begin:end] = ids
        self._used = end
        return begin

    def _add(self, keys: np.ndarray, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Remember new keys: ``n`` ids each, end to end in ``ids``. Returns (place, number) of each key's."""
        at, slot = self._append(ids) + np.cumsum(n) - n, self._slot(keys)
        self._hash[slot], self._at[slot], self._count[slot] = keys, at, n + 1
        return at, n

    def _forget(self) -> None:
        """Drop the ids of displaced units; all units, if those left fill half the array."""
        keep = np.flatnonzero(self._count)
        n = self._count[keep].astype(np.int64) - 1
        if int(n.sum()) > IDS_A_UNIT // 2 * self._units:
            return self._clear()
        ids = _gather(self._ids, self._at[keep].astype(np.int64), n)
        self._used = len(ids)
        self._ids[:self._used] = ids
        self._at[keep] = np.cumsum(n) - n

    def _encode_units(self, buf: np.ndarray, a: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, number of each) of the units ``buf[a:e]``, which begin with white space: JOINED at a
        time as one text, and its tokens dealt to the units by where they begin: by their bytes where these are known,
        else by the library's offsets, which take it longer."""
        size = e - a
        joined = _gather(buf, a, size)
        byte = np.concatenate([[0], np.cumsum(size)])
        at = range(0, len(a), JOINED)
        texts = [joined[byte[i]:byte[min(i + JOINED, len(a))]].tobytes().decode() for i in at]
        if self._size is not None:
            ids = np.concatenate([np.array(x.ids, np.uint32) for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            begin = np.concatenate([[0], np.cumsum(self._size[ids])])
            cut = np.searchsorted(begin, byte)
            if begin[-1] == byte[-1] and (begin[cut] == byte).all():
                return ids, np.diff(cut)
        made = self._tokenizer.encode_batch(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in made])
        char = np.concatenate([[0], np.cumsum((joined & 0xC0) != 0x80)])[byte]
        begin = np.concatenate([np.array(x.offsets, np.int64).reshape(-1, 2)[:, 0] + char[i] for i, x in zip(at, made)])
        cut = np.searchsorted(begin, char)
        cut[-1] = len(ids)
        return ids, np.diff(cut)

    def _learn(self, keys: np.ndarray, buf: np.ndarray, lead: np.ndarray, start: np.ndarray,
               end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Remember new units: the words ``buf[start:end]`` with the white space ``lead`` (0: none) before them.
        Returns (place, number) of the ids of each."""
        bare = end.copy()
        for _ in range(TAIL):
            bare -= _MARK[buf[bare - 1]] & (bare > start)
        marked = (bare > start) & (bare < end) & _LETTER[buf[bare - 1]]
        bare = np.where(marked, bare, end)
        m = np.flatnonzero(marked)
        key = keys.copy()
        if len(m):
            size = bare[m] - start[m]
            key[m] = _keys(split_words(_gather(buf, start[m], size), np.concatenate([[0], np.cumsum(size)])).hash, lead[m])
        word, first, back = np.unique(key, return_index=True, return_inverse=True)
        there, at, n = self._find(word)
        for some, own in ((~there & (lead[first] != 0), self._encode_units), (~there & (lead[first] == 0), self._encode_firsts)):
            if some.any():
                k = first[some]
                at[some], n[some] = self._add(word[some], *own(buf, start[k] - (lead[k] != 0), bare[k]))
        at, n = at[back], n[back]
        if len(m):
            tail = np.zeros(len(m), U)
            for j in range(TAIL):
                mark = bare[m] + j
                tail = np.where(mark < end[m], (tail << U(8)) | buf[np.minimum(mark, len(buf) - 1)].astype(U), tail)
            tail, of = np.unique(tail, return_inverse=True)
            for t in tail.tolist():
                if t not in self._tails:
                    self._tails[t] = self._whole(t.to_bytes(8, "big").lstrip(b"\0").decode())
            tails = [self._tails[t] for t in tail.tolist()]
            n_tail = np.array([len(t) for t in tails], np.int64)
            at_tail = self._append(np.concatenate(tails)) + np.cumsum(n_tail) - n_tail
            both = np.stack([n[m], n_tail[of]], axis=1)
            place = np.stack([at[m], at_tail[of]], axis=1)
            at[m], n[m] = self._add(keys[m], _gather(self._ids, place.ravel(), both.ravel()), both.sum(axis=1))
        return at, n

    def _encode_firsts(self, buf: np.ndarray, a: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``_encode_units``, of words that begin a text."""
        texts = [buf[i:j].tobytes().decode() for i, j in zip(a.tolist(), e.tolist())]
        ids = [np.array(x.ids, np.uint32) for x in self._tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)

    def _slice(self, data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        w, bounds = split_words(data, off), off - off[0]
        rows, buf = len(off) - 1, w.buf
        white = WHITE[buf]
        odd = _other_space(buf)
        odd[1:] |= white[1:] & white[:-1]  # across rows too: such a row is encoded whole, no more
        last = bounds[1:][np.diff(bounds) > 0] - 1
        odd[last] |= white[last]
        count = np.concatenate([[0], np.cumsum(odd)])
        loose = np.diff(count[bounds]) > 0
        text = buf.tobytes() if self._added else b""
        for content in self._added:
            at = text.find(content)
            while at >= 0:  # across rows too
                loose[np.searchsorted(bounds, at, side="right") - 1] = True
                at = text.find(content, at + 1)
        if self._used > IDS_A_UNIT * self._units:
            self._forget()
        of = w.row_of()
        tight = np.flatnonzero(~loose[of])
        begins = w.start[tight] == bounds[of[tight]]
        lead = np.where(begins, 0, buf[w.start[tight] - 1]) if len(tight) else np.zeros(0, np.int64)
        key = _keys(w.hash[tight], lead)
        there, begin, n = self._find(key)
        new = np.flatnonzero(~there)
        if len(new):
            own, first, back = np.unique(key[new], return_index=True, return_inverse=True)
            k = new[first]
            at, size = self._learn(own, buf, lead[k], w.start[tight[k]], w.end[tight[k]])
            begin[new], n[new] = at[back], size[back]
        end = np.cumsum(n)
        ids = _gather(self._ids, begin, n).astype(np.uint32)
        total = np.concatenate([[0], end])[np.searchsorted(of[tight], np.arange(rows + 1))]
        return [self._whole(buf[bounds[r]:bounds[r + 1]].tobytes().decode()) if loose[r] else ids[total[r]:total[r + 1]]
                for r in range(rows)]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        data, off = utf8(texts)
        for i, j in slices(off, SLICE):
            yield from self._slice(data, off[i:j + 1])


def encoder(path: str, units: int = FEW) -> Encoder:
    """The process's encoder of a vocabulary file that remembers up to ``units`` units."""
    if (path, units) not in _encoders:
        _encoders[path, units] = Encoder(path, literal=False, units=units)
    return _encoders[path, units]
