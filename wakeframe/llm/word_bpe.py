"""Ids of whole texts by a word-level BPE tokenizer file, a block of texts at a time.

Texts in ASCII and Latin-1 letters are split into pre-tokens on byte arrays: the
normaliser lowers letters, and letters, digits, white space and all else separate
each other. A pre-token's ids depend on it alone, so each distinct one goes through
the tokenizer once and its ids are kept. Texts with other characters, or with an
apostrophe (contractions), go through the tokenizer whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from wakeframe.llm.words import BLOCK, Texts, _hashes, _BASE, _BYTE, mixed

REMEMBERED = 500_000  # pre-tokens whose ids a Python worker keeps, at about 40 bytes each
HEADS = 18  # bits of a hash that lead to its place in the sorted hashes
JOINED = 400  # pre-tokens given to the tokenizer as one text

_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[48:58] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=2)
def _tokenizer(data: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer, pre_tokenizers

    made = Tokenizer.from_str(data)
    made.encode_special_tokens = True
    # pre-tokens need neither normaliser nor pattern, only the map from bytes to characters
    bare = Tokenizer(made.model)
    bare.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    ends = np.zeros(made.get_vocab_size(), dtype=bool)
    for token, i in made.get_vocab().items():
        ends[i] = token.endswith("</w>")
    return made, bare, ends


@lru_cache(maxsize=1)
def coder_of(data: str) -> WordBpe:
    """One encoder per Python worker: tasks that follow find its pre-tokens."""
    return WordBpe(data)


class WordBpe:
    """Encodes rows of texts; ``data`` is the tokenizer file's content."""

    def __init__(self, data: str, remembered: int = REMEMBERED):
        self.coder, self.bare, self.ends = _tokenizer(data)
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)  # hashes, sorted
        self.heads = np.zeros(1 << HEADS, dtype=np.int64)  # first place of each range of hashes
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.uint16)

    def encode(self, texts: Texts, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of rows first..last; row i has ids[offsets[i]:offsets[i + 1]]."""
        low = int(texts.start[first])
        data = texts.data[low : max(low, int(texts.end[last - 1]))]
        start, end = texts.start[first:last] - low, texts.end[first:last] - low
        plain = self._plain(data, start, end)
        low_data = _LOWER[data]
        lead = np.zeros(len(data), dtype=bool)
        lead[1:] = data[:-1] == 0xC3
        low_data[lead & (data <= 0x9E)] += 32  # the multiplication sign, 0x97, is no plain text
        row, piece_start, piece_end = self._pieces(data, start, end, plain)
        row_ids, counts = self._ids_of(low_data, piece_start, piece_end)
        per_row = np.bincount(row, weights=counts, minlength=last - first).astype(np.int64)
        slow = {}
        for i in np.flatnonzero(~plain):
            text = data[start[i] : end[i]].tobytes().decode()
            slow[i] = np.array(self.coder.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint16)
            per_row[i] = len(slow[i])
        offsets = np.concatenate(([0], np.cumsum(per_row)))
        if not slow:
            return row_ids, offsets
        out = np.empty(offsets[-1], dtype=np.uint16)
        fast = np.repeat(plain, per_row)
        out[fast] = row_ids
        for i, ids in slow.items():
            out[offsets[i] : offsets[i + 1]] = ids
        return out, offsets

    @staticmethod
    def _plain(data, start, end) -> np.ndarray:
        """Rows in ASCII without apostrophes and Latin-1 letters only."""
        odd = data == 39
        high = data >= 0x80
        if high.any():
            lead = data == 0xC3
            follows = np.zeros(len(data), dtype=bool)
            follows[1:] = lead[:-1]
            odd |= high & ~lead & ~follows
            odd |= follows & ((data == 0x97) | (data == 0xB7))
        sums = np.concatenate(([0], np.cumsum(odd)))
        return sums[np.maximum(end, start)] == sums[start]

    @staticmethod
    def _pieces(data, start, end, plain):
        """(row, start, end) of the plain rows' pre-tokens, in order."""
        kind = _KIND[data]
        edge = np.ones(len(data) + 1, dtype=bool)
        edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        edge[start] = True
        edge[end] = True
        at = np.flatnonzero(edge)
        begin, stop = at[:-1], at[1:]
        solid = kind[begin] != _SPACE if len(begin) else np.zeros(0, bool)
        begin, stop = begin[solid], stop[solid]
        row = np.searchsorted(start, begin, side="right") - 1
        mine = plain[row] & (begin < end[row])
        return row[mine], begin[mine], stop[mine]

    def _ids_of(self, data, start, end) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces data[start:end], end to end, and each piece's number of ids."""
        if not len(start):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        found = mixed(_hashes(data, start, end, _BYTE, _BASE))
        place = self._find(found)
        missing = place < 0
        if missing.any():
            fresh, where = np.unique(found[missing], return_index=True)
            where = np.flatnonzero(missing)[where]
            if len(self.known) and len(self.known) + len(fresh) > self.remembered:
                self._forget()
                fresh, where = np.unique(found, return_index=True)
            self._learn(fresh, [data[a:b].tobytes().decode() for a, b in zip(start[where], end[where], strict=True)])
            place = self._find(found)
        at, size = self.at[place], self.size[place]
        begin = np.cumsum(size) - size
        return self.pool[np.arange(int(size.sum())) + np.repeat(at - begin, size)], size

    def _find(self, found) -> np.ndarray:
        place = self.heads[(found >> np.uint64(64 - HEADS)).astype(np.int64)]
        if not len(self.known):
            return place - 1
        padded = np.append(self.known, np.uint64((1 << 64) - 1))
        behind = np.flatnonzero(padded[place] < found)
        while len(behind):
            place[behind] += 1
            behind = behind[padded[place[behind]] < found[behind]]
        return np.where((padded[place] == found) & (place < len(self.known)), place, -1)

    def _learn(self, fresh: np.ndarray, pieces: list[str]) -> None:
        ids, sizes = [], []
        texts = [" ".join(pieces[i : i + JOINED]) for i in range(0, len(pieces), JOINED)]
        for i, coded in enumerate(self.bare.encode_batch_fast(texts, add_special_tokens=False)):
            part = pieces[i * JOINED : (i + 1) * JOINED]
            found = np.array(coded.ids, dtype=np.uint16)
            cuts = np.flatnonzero(self.ends[found]) + 1
            if len(cuts) != len(part):
                one = [np.array(x.ids, dtype=np.uint16) for x in self.bare.encode_batch_fast(part, add_special_tokens=False)]
                found, cuts = np.concatenate(one), np.cumsum([len(x) for x in one])
            ids.append(found)
            sizes.append(np.diff(cuts, prepend=0))
        size = np.concatenate(sizes)
        at = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate([self.pool, *ids])
        known = np.concatenate([self.known, fresh])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.at = np.concatenate([self.at, at])[order]
        self.size = np.concatenate([self.size, size])[order]
        self.heads = np.searchsorted(self.known, np.arange(1 << HEADS, dtype=np.uint64) << np.uint64(64 - HEADS))


__all__ = ["BLOCK", "WordBpe"]
