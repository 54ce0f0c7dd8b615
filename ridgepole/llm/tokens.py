"""Token ids of many texts by a byte-level BPE file, one encoding for each distinct word.

Pre-tokens never share merges, so a text's ids are its pre-tokens' ids put together.
Texts of the common alphabets are cut into pre-tokens with array operations, and only
words not seen before go to the tokenizer; a text with any other character is encoded by
the tokenizer as a whole.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from ridgepole.llm import hashes

#: Alphabets whose letters, digits and blanks are the same in every Unicode version in use.
PLAIN = 0x0530
SLOTS = 1 << 20
#: Ids kept before the memory of words starts anew.
KEPT_IDS = 1 << 22
#: Characters of a batch; while it is cut, each takes some ten words of memory.
CHARS = 1 << 18

# The blanks of the pre-token pattern's \s below PLAIN, and its contractions.
_BLANKS = [9, 10, 11, 12, 13, 32, 0x85, 0xA0]
_CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]

_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3


def _classes() -> np.ndarray:
    out = np.full(PLAIN, _OTHER, np.uint8)
    for c in range(PLAIN):
        kind = unicodedata.category(chr(c))[0]
        out[c] = _LETTER if kind == "L" else _DIGIT if kind == "N" else _OTHER
    out[_BLANKS] = _SPACE
    return out


_CLASS = _classes()
_VALUE = hashes.symbols(PLAIN, 17)


def pretokens(chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens.  chars: code points of texts on end, first: where each text starts."""
    n = len(chars)
    kind = _CLASS[chars]
    opens = np.zeros(n + 1, bool)
    opens[first[first < n]] = True
    opens[n] = True
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    starts = change | opens[:n]
    blank, word = kind == _SPACE, kind != _SPACE
    # the last blank before a word of its own text stands alone or joins the word
    last_blank = np.flatnonzero(blank[:-1] & word[1:] & ~opens[1:n]) if n else np.empty(0, int)
    starts[last_blank] = True
    joins = last_blank[chars[last_blank] == 32]
    starts[joins + 1] = False
    # contractions: a lone apostrophe, no blank joined to it, then the letters
    quote = np.flatnonzero((chars == 39) & starts[:n])
    if len(quote):
        padded = np.concatenate([chars, np.zeros(3, chars.dtype)])
        for letters in _CONTRACTIONS:
            hit = np.ones(len(quote), bool)
            for k, letter in enumerate(letters, 1):
                at = np.minimum(quote + k, n)
                hit &= (padded[quote + k] == ord(letter)) & ~opens[at]
            own = quote[hit]
            starts[own + 1] = False
            after = own + 1 + len(letters)
            after = after[after < n]
            starts[after[(kind[after] == _LETTER) & ~opens[after]]] = True
    return np.flatnonzero(starts)


class Encoder:
    """Ids of texts by one tokenizer file, with a bounded memory of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._own = Tokenizer.from_file(path)
        self._own.encode_special_tokens = True
        self._forget()

    def _forget(self) -> None:
        self._slot = np.zeros(SLOTS, np.uint64)
        self._at = np.zeros(SLOTS, np.int32)
        self._n = np.zeros(SLOTS, np.int32)
        self._ids = np.empty(1 << 16, np.int32)
        self._used = 0

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self._own.encode_batch_fast(words, add_special_tokens=False)]

    def _keep(self, lists: list[list[int]]) -> np.ndarray:
        counts = np.array([len(x) for x in lists], np.int64)
        flat = np.fromiter((i for x in lists for i in x), np.int32, int(counts.sum()))
        if self._used + len(flat) > len(self._ids):
            grown = np.empty(max(2 * len(self._ids), self._used + len(flat)), np.int32)
            grown[: self._used] = self._ids[: self._used]
            self._ids = grown
        self._ids[self._used : self._used + len(flat)] = flat
        self._used += len(flat)
        return counts

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self._used > KEPT_IDS:
            self._forget()
        whole = "".join(texts)
        chars = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        sizes = np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(sizes) - sizes
        starts = pretokens(chars, first)
        ends = np.append(starts[1:], len(chars))
        words = hashes.mix(hashes.Prefix(_VALUE[chars]).of(starts, ends) + (ends - starts).astype(np.uint64))
        words[words == 0] = 1
        slot = (words & np.uint64(SLOTS - 1)).astype(np.int64)
        at, count = self._at[slot], self._n[slot]
        new = np.flatnonzero(self._slot[slot] != words)
        if len(new):
            distinct, one, which = np.unique(words[new], return_index=True, return_inverse=True)
            before = self._used
            counts = self._keep(self._encode([whole[starts[i] : ends[i]] for i in new[one].tolist()]))
            places = before + np.cumsum(counts) - counts
            at[new], count[new] = places[which], counts[which]
            own, won = np.unique(slot[new[one]], return_index=True)  # one word for a slot that two want
            self._slot[own], self._at[own], self._n[own] = distinct[won], places[won], counts[won]
        text_of = np.searchsorted(first, starts, side="right") - 1
        lengths = np.bincount(text_of, count, len(texts)).astype(np.int64) if len(starts) else np.zeros(len(texts), np.int64)
        return self._ids[hashes.expand(at, count)], lengths

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and how many each has.  Lone surrogates are not text."""
        plain = [i for i, t in enumerate(texts) if t and (t.isascii() or ord(max(t)) < PLAIN)]
        rest = sorted({i for i, t in enumerate(texts) if t} - set(plain))
        parts: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        for a, b in hashes.slices([len(texts[i]) for i in plain], CHARS):
            ids, lengths = self._plain([texts[i] for i in plain[a:b]])
            cut = np.cumsum(lengths)
            for i, lo, hi in zip(plain[a:b], cut - lengths, cut):
                parts[i] = ids[lo:hi]
        for i in rest:
            parts[i] = np.array(self._own.encode(texts[i], add_special_tokens=False).ids, np.int32)
        lengths = np.array([len(p) for p in parts], np.int64)
        return np.concatenate(parts) if parts else np.empty(0, np.int32), lengths


_open: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's own encoder for a file; its memory of words lasts from task to task."""
    if path not in _open:
        _open[path] = Encoder(path)
    return _open[path]
