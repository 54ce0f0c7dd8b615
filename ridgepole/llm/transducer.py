"""Byte-level BPE by a lazily determinised finite-state transducer, and its decoder.

**Encoding.**  A piece of text (one match of the split pattern) is read byte by byte.  The
transducer behind it is nondeterministic: its states are places in the trie of the tokens'
bytes together with the last token given out; at a token's end it may give that token out
and go back to the root.  Merges are compiled into which token may follow which: ``v``
follows ``u`` if merging the bytes of ``uv`` by rank ends in exactly these two, which the
parts along their border decide.  Sequences
in which each token may follow the one before are what merging gives, and every prefix of a
piece has exactly one, so of all ways that reach the root after a byte one is left.

It is determinised as it is used.  A state is the set of ways still open, each with its
place in the trie, its last token and the tokens it has not given out yet; what all ways
have in common is given out at once, so a token leaves as soon as no later byte can change
it, at the latest after as many bytes as the longest token has.  Steps found once are kept
(``STATES`` states, then the table starts anew), and so are the ids of words (the last
``WORDS`` to twice as many); both are memories of the transducer's own output, bounded.

**Decoding** joins the tokens' bytes block by block.  Where text is wanted, an incremental
UTF-8 machine holds back the bytes of an unfinished character until the next block.

Ids travel as binary columns of little-endian unsigned 32-bit numbers: a long text's ids
stay four bytes each.  Everything is a narrow map over rows: no shuffle, nothing shared but
the vocabulary file, which every task opens by its path.

Defined results: a null text is an empty one, which has no ids; an empty table gives an
empty table; repeated rows repeat; a text of any length is cut lazily, its ids are held
whole; columns of the input with the names of added ones are replaced.  Ids that the
vocabulary lacks, and lengths that are no multiple of four, raise; null ids decode to null.
A piece that is a token as a whole is that token, even if merging would not build it.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterator
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgepole.llm import hashes

STATES = 1 << 17
WORDS = 1 << 18
#: Pieces cut at a time, ids decoded at a time, and bytes of ids in one batch of rows.
BLOCK = 1 << 16
BYTES = 1 << 25

ROOT = 0
#: Beyond every rank.
NEVER = 1 << 62
#: Tokens below a place of the trie that are tested one by one for a way that comes there.
FEW = 16

Way = tuple[int, int, tuple[int, ...]]


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, a base64 token and a number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Transducer:
    """Ids of pieces of bytes, by rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._child: dict[int, int] = {}  # node * 256 + byte -> node
        self._token = [-1]
        self._below: list[list[int]] = [[]]
        self._first: dict[int, tuple[int, ...]] = {}  # the parts a token begins with, from its first byte to itself
        self._last: dict[int, tuple[int, ...]] = {}  # and those it ends with
        for token, rank in sorted(ranks.items(), key=lambda x: (len(x[0]), x[1])):
            if self._compile(token, rank):  # a token that merging never builds is no way's end
                self._plant(token, rank)
        self._follows: dict[tuple[int, int], bool] = {}
        self._under: dict[int, tuple[int, ...] | None] = {}
        self._words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._forget()

    def _merge(self, piece: bytes) -> tuple[list[bytes], tuple[bytes, bytes] | None, bool]:
        """The parts left by merging the pair of least rank, the first of equals, until none is left;
        the last pair merged, and whether ranks only rose on the way to every part."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pair, rising = None, True
        while len(parts) > 1:
            found = [self.ranks.get(a + b, -1) for a, b in zip(parts, parts[1:])]
            least = min((r for r in found if r >= 0), default=None)
            if least is None:
                break
            i = found.index(least)
            pair = (parts[i], parts[i + 1])
            rising &= all(len(p) == 1 or self.ranks[p] < least for p in pair)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts, pair, rising

    def merged(self, piece: bytes) -> list[int]:
        return [self.ranks[p] for p in self._merge(piece)[0]]

    def _compile(self, token: bytes, rank: int) -> bool:
        parts, pair, rising = self._merge(token)
        if len(parts) > 1:
            return False
        if not rising:
            raise ValueError("a token's rank is below that of a part it is merged from")
        left, right = (self.ranks[p] for p in pair) if pair else (None, None)
        self._first[rank] = (*(self._first[left] if pair else ()), rank)
        self._last[rank] = (*(self._last[right] if pair else ()), rank)
        return True

    def _plant(self, token: bytes, rank: int) -> None:
        node = ROOT
        for byte in token:
            key = node << 8 | byte
            if key not in self._child:
                self._child[key] = len(self._token)
                self._token.append(-1)
                self._below.append([])
                self._below[node].append(len(self._token) - 1)
            node = self._child[key]
        self._token[node] = rank

    def _few(self, node: int) -> tuple[int, ...] | None:
        """The tokens that begin with the bytes at a place in the trie and go on, if they are few."""
        if node not in self._under:
            found, todo = [], list(self._below[node])
            while todo and len(found) <= FEW:
                child = todo.pop()
                todo += self._below[child]
                if self._token[child] >= 0:
                    found.append(self._token[child])
            self._under[node] = tuple(found) if len(found) <= FEW else None
        return self._under[node]

    def _forget(self) -> None:
        start: tuple[Way, ...] = ((ROOT, -1, ()),)
        self._ways = [start]
        self._number = {start: 0}
        self._steps: dict[int, tuple[int, tuple[int, ...]]] = {}  # state * 256 + byte -> state, ids given out
        self._ends: list[tuple[int, ...]] = [()]

    def _may_follow(self, u: int, v: int) -> bool:
        """True if merging never joins the end of ``u`` to the beginning of ``v``.

        Both sides grow towards the border part by part, in the order of ranks; at each
        time the two parts that meet there could be merged before either grows.
        """
        if u < 0:
            return True
        known = self._follows.get((u, v))
        if known is not None:
            return known
        if len(self._follows) >= 2 * STATES:
            self._follows.clear()
        ends, begins = self._last[u], self._first[v]
        i = j = 0
        known = True
        while True:
            # the parts at the border grow when the next longer ones are merged
            left = ends[i + 1] if i + 1 < len(ends) else NEVER
            right = begins[j + 1] if j + 1 < len(begins) else NEVER
            across = self.ranks.get(self.tokens[ends[i]] + self.tokens[begins[j]], NEVER)
            if across < left and across <= right:  # of equal ranks the first pair is merged first
                known = across == NEVER
                break
            if left == right == NEVER:
                break
            if left <= right:
                i += 1
            else:
                j += 1
        self._follows[u, v] = known
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The deterministic step, found once: all open ways read the byte."""
        child, ways, done = self._child, [], None
        for node, last, held in self._ways[state]:
            below = child.get(node << 8 | byte)
            if below is None:
                continue
            if self._below[below]:
                if (few := self._few(below)) is None:
                    ways.append((below, last, held))
                elif any(may := [self._may_follow(last, t) for t in few]):
                    ways.append((below, -1 if all(may) else last, held))
            token = self._token[below]
            if token >= 0 and done is None and self._may_follow(last, token):
                done = (ROOT, token, (*held, token))
        if done is None:
            raise ValueError("the vocabulary has no token for a byte")
        shared, ids = 0, done[2]
        if not ways:
            shared = len(ids)
        else:
            shortest = min(len(held) for _, _, held in ways)
            while shared < shortest and all(held[shared] == ids[shared] for _, _, held in ways):
                shared += 1
        ways.append(done)
        after = tuple([(node, last, held[shared:]) for node, last, held in ways]) if shared else tuple(ways)
        number = self._number.get(after)
        if number is None:
            number = self._number[after] = len(self._ways)
            self._ways.append(after)
            self._ends.append(ids[shared:])
        step = self._steps[state << 8 | byte] = (number, ids[:shared])
        return step

    def stream(self, piece: bytes) -> Iterator[tuple[int, ...]]:
        """Ids as they are settled while the piece is read, and the rest at its end."""
        if len(self._ways) > STATES:
            self._forget()
        state, steps = 0, self._steps
        for byte in piece:
            step = steps.get(state << 8 | byte) or self._step(state, byte)
            state = step[0]
            if step[1]:
                yield step[1]
        yield self._ends[state]

    def encode(self, piece: bytes) -> list[int]:
        """All ids of a piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self._ways) > STATES:
            self._forget()
        state, steps, out = 0, self._steps, []
        for byte in piece:
            step = steps.get(state << 8 | byte) or self._step(state, byte)
            state = step[0]
            out += step[1]
        out += self._ends[state]
        return out

    def _packed(self, pieces: list[str]) -> bytes:
        found = [i for piece in pieces for i in self.encode(piece.encode())]
        return pack(f"<{len(found)}I", *found)

    def whole(self, text: str, pattern: regex.Pattern) -> bytes:
        """Little-endian ids of a text, piece by piece."""
        return b"".join([self._packed(block) for block in pieces(text, pattern)])

    def by_word(self, text: str, pattern: regex.Pattern) -> bytes:
        """The same, a word with the space before it at a time; those met not long ago are remembered.

        For patterns whose matches never go on from a non-space into white space, and leave
        the last space of several to the word behind it.  So a text may be cut before each
        space, except where white space stands on both sides; such a text is cut as a whole.
        """
        first, *words = text.split(" ")
        if len(self._words) > WORDS:
            self._older, self._words = self._words, {}
        known, older, out = self._words, self._older, [self.whole(first, pattern)]
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = older.get(word)
                if ids is None:
                    if not word or word[0].isspace():
                        return self.whole(text, pattern)
                    ids = self.whole(" " + word, pattern)
                if len(word) <= 64:
                    known[word] = ids
            out.append(ids)
        return b"".join(out)


class Utf8Stream:
    """An incremental UTF-8 machine: text of bytes that come in blocks cut anywhere.

    Its state is the unfinished character at the end of what it has read: at most three
    bytes.  Bytes that are no UTF-8 become U+FFFD, as in a decoder that sees them whole.
    """

    def __init__(self) -> None:
        self._rest = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many last bytes begin a character that may still be finished."""
        for back in range(1, min(3, len(data)) + 1):
            first = data[-back]
            if 0x80 <= first < 0xC0:
                continue  # goes on with a character that began earlier
            wanted = 2 if 0xC2 <= first < 0xE0 else 3 if 0xE0 <= first < 0xF0 else 4 if 0xF0 <= first < 0xF5 else 1
            if wanted <= back:
                return 0
            # The least and greatest second byte after these first ones
            low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(first, (0x80, 0xBF))
            return back if back == 1 or low <= data[1 - back] <= high else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self._rest + data
        cut = len(data) - self._unfinished(data)
        self._rest = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self._rest = self._rest, b""
        return rest.decode("utf-8", "replace")


_open: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The process's own transducer for a file; what it has learned lasts from task to task."""
    if path not in _open:
        _open[path] = Transducer(read_ranks(path))
    return _open[path]


def pieces(text: str, pattern: regex.Pattern) -> Iterator[list[str]]:
    """Matches of the split pattern, a block at a time."""
    if len(text) <= BLOCK:
        yield pattern.findall(text)
        return
    found = pattern.finditer(text)
    while block := [m.group() for m in islice(found, BLOCK)]:
        yield block


class Tokens:
    """The bytes of all tokens on end, and where each lies."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        self.starts, self.lengths = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.starts[:] = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)

    def blocks(self, ids: bytes) -> Iterator[bytes]:
        """The tokens' bytes, a block of ids at a time."""
        for at in range(0, len(ids), 4 * BLOCK):
            these = np.frombuffer(ids[at : at + 4 * BLOCK], "<u4")
            lengths = self.lengths[these]
            if not lengths.all():
                raise ValueError("an id that the vocabulary lacks")
            yield self.bytes[hashes.expand(self.starts[these], lengths)].tobytes()


def decode_text(ids: bytes, tokens: Tokens) -> Iterator[str]:
    """The text of ids, a block at a time, never cut inside a character."""
    machine = Utf8Stream()
    for data in tokens.blocks(ids):
        yield machine.feed(data)
    yield machine.close()


def _mapped(rows: DataFrame, source: str, outs: dict[str, str], make) -> DataFrame:
    """Put ``make``'s values of the column ``source`` in its place, in batches of bounded size."""
    keep = [c for c in rows.columns if c != source and c not in outs]
    given = rows.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{source}`").alias("_given"))
    kinds = [pa.binary() if kind == "binary" else pa.string() for kind in outs.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # what a task keeps has no cycles, and looking for them takes longer than the work
        values = make()
        for batch in batches:
            held, first, size = [], 0, 0
            for i, x in enumerate(batch.column(len(keep))):
                held.append(values(x.as_py()))
                size += sum(len(v) for v in held[-1] if v)
                if size > BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(first, len(held))
                    made = [pa.array(column, kind) for column, kind in zip(zip(*held), kinds)]
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*keep, *outs])
                    held, first, size = [], i + 1, 0

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1]]
    return given.mapInArrow(run, ", ".join([*fields, *[f"`{name}` {kind}" for name, kind in outs.items()]]))


def _encoder(ranks_path: str, pattern: str, by_word: bool):
    own = transducer(ranks_path)
    cut, split = own.by_word if by_word else own.whole, regex.compile(pattern)
    return lambda given: cut(given or "", split)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids", by_word: bool = True) -> DataFrame:
    """Replace the text by its ids, each match of ``pattern`` encoded by itself.

    ``by_word`` asks for a pattern as ``Transducer.by_word`` describes it.
    """

    def make():
        ids = _encoder(ranks_path, pattern, by_word)
        return lambda given: (ids(given),)

    return _mapped(docs, text, {out: "binary"}, make)


def decode(docs: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded", as_text: bool = False) -> DataFrame:
    """Replace ids by the bytes they stand for, or by their text."""

    def make():
        tokens = Tokens(read_ranks(ranks_path))

        def values(given: bytes | None):
            if given is None:
                return (None,)
            return ("".join(decode_text(given, tokens)) if as_text else b"".join(tokens.blocks(given)),)

        return values

    return _mapped(docs, ids, {out: "string" if as_text else "binary"}, make)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", by_word: bool = True) -> DataFrame:
    """Replace the text by its ids and the bytes these decode to, in one pass over the rows."""

    def make():
        own, tokens = _encoder(ranks_path, pattern, by_word), Tokens(read_ranks(ranks_path))

        def values(given: str | None):
            coded = own(given)
            return coded, b"".join(tokens.blocks(coded))

        return values

    return _mapped(docs, text, {ids: "binary", decoded: "binary"}, make)
