"""Phrase collocations from a weighted de Bruijn graph of each language's words.

Texts are cut into pieces and those into words.  The graph's edges are the longest grams
(``LONGEST`` words), its nodes the grams one word shorter that an edge leads from and to.

**Counts.**  Only edges are counted in the corpus: every word occurrence gives one row, the
gram that begins there, filled up with ``NONE`` where its piece ends.  Rows that end early
are the piece-end corrections: a node's count is the flow out of it, all edges that leave
it, plus the pieces that end in it.  Grams shorter than nodes follow in the same way, by
summing over the last word again.  Single words are counted beforehand, as the vocabulary.

**What cannot count.**  A gram that occurs often holds no rare word.  Words are counted
first, and those seen ``least`` times or more set a bit of a bitmap of fixed size (``BITS``,
8 MB, whatever the corpus holds) that goes to every task.  There a gram is cut before the
first word without its bit, and dropped if that is its first word.  Where words share a bit
or the bitmap is full, more rows are shuffled and nothing else changes.

**One large shuffle.**  Each task counts its own grams, a batch of texts at a time, and sends
the distinct ones as 64-bit word hashes, to where their first two words decide.  From there
all counts of two words and more are sums inside the partition.  Two words that both make up
a ``HOT``-th of the corpus (so at most ``HOT`` words) may have more followers than one task
should hold: their grams are dealt over ``SALTS`` places by the third word, and counts of
the pair alone are put together afterwards.

**Unary paths.**  A node that has one way in and one way out, both of its own count, is an
inner node of a path: no piece begins, ends or turns there.  Such paths (passages that many
texts share) are compacted by pointer doubling.  Their inner nodes lie in an edge of the
same count and are settled without a look at other edges, and ``paths`` lists the passages.

Words are told apart by 64-bit hashes, seeded by language.  Arithmetic is in decimals of 38
digits: exact up to 10**15 occurrences of a phrase.

Defined results: a null text is empty; a null language is ``und``, as is the language of
that name; pieces without words vanish; repeated rows count as often as they occur; texts of
any length (they are read in blocks of whole texts); an empty table gives no phrase; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgepole.llm import hashes
from ridgepole.llm.common import discard, stored

LONGEST = 3
UNKNOWN = "und"
NONE = 0
#: Bits of the bitmap of words that are often enough.
BITS = 26
#: Bytes of texts that a task cuts into words at a time, and grams that it counts at a time.
BYTES = 1 << 20
GRAMS = 3 << 19
#: A word is hot if it makes up this part of all occurrences.
HOT = 1000
SALTS = 64

_BREAK, _BLANK, _WORD = 0, 1, 2


def _classes() -> np.ndarray:
    out = np.full(256, _WORD, np.uint8)
    out[[0x20, 0x09]] = _BLANK
    out[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK
    return out


_CLASS = _classes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_VALUE = hashes.symbols(256, 29)


class Words:
    """The words of some texts on end: where they lie, their hashes, and which end a piece."""

    def __init__(self, texts: Sequence[bytes], langs: Sequence[str]):
        # a line break stands between texts
        self.bytes = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        kind = _CLASS[self.bytes]
        inside = np.concatenate([[False], kind == _WORD, [False]])
        self.starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
        self.ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        breaks = np.concatenate([[0], np.cumsum(kind == _BREAK, dtype=np.int64)])
        piece = breaks[self.starts]
        self.last = np.ones(len(piece), bool)
        self.last[:-1] = piece[1:] != piece[:-1]
        names, number = np.unique(np.array(langs, object).astype(str), return_inverse=True) if len(langs) else (np.empty(0, str), np.empty(0, int))
        self.names = names.tolist()
        self.lang = number[np.searchsorted(np.cumsum(sizes), self.starts, side="right")] if len(texts) else np.empty(0, int)
        seeds = np.array([_seed(n) for n in self.names], np.uint64)
        own = hashes.Prefix(_VALUE[self.bytes]).of(self.starts, self.ends) + (self.ends - self.starts).astype(np.uint64)
        self.hashes = hashes.mix(hashes.mix(own) ^ seeds[self.lang]) if len(own) else own
        self.hashes[self.hashes == NONE] = 1

    def text(self, i: int) -> bytes:
        return self.bytes[self.starts[i] : self.ends[i]].tobytes()


def _seed(name: str) -> int:
    data = np.frombuffer(name.encode(), np.uint8)
    one = hashes.Prefix(_VALUE[data]).of(np.array([0]), np.array([len(data)]))
    return int(hashes.mix(one + np.uint64(len(data) + 1))[0])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Blocks of whole texts as words."""
    texts: list[bytes] = []
    langs: list[str] = []
    size = 0
    for batch in batches:
        for lang, text in zip(*[c.to_pylist() for c in batch.columns]):
            if text:
                texts.append(text)
                langs.append(lang)
                size += len(text)
            if size > BYTES:
                yield Words(texts, langs)
                texts, langs, size = [], [], 0
    if texts:
        yield Words(texts, langs)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _corpus(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").cast("binary").alias("text"))


def vocabulary(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, word, w, n``: every word with its hash and its occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _read(batches):
            distinct, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
            names = [words.names[i] for i in words.lang[first].tolist()]
            said = [words.text(i) for i in first.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(said, pa.binary()), _signed(distinct), pa.array(n)], names=["lang", "word", "w", "n"]
            )

    counted = _corpus(docs, text, lang).mapInArrow(run, "lang string, word binary, w bigint, n bigint")
    summed = counted.groupBy("lang", "word").agg(F.min("w").alias("w"), F.sum("n").alias("n"))
    return summed.select("lang", F.col("word").cast("string").alias("word"), "w", "n")


def bitmap(words: DataFrame, bits: int) -> np.ndarray:
    """A bit for the hash of each word.  Its size is given by ``bits``, not by the words."""
    place = F.pmod(F.col("w"), F.lit(1 << bits))
    chunk, bit = F.shiftright(place, 13), place.bitwiseAND(F.lit((1 << 13) - 1))
    # one row for each of the bitmap's longs that has a bit, put together to chunks of a kilobyte
    longs = words.select(chunk.alias("chunk"), F.shiftright(bit, 6).alias("at"), F.expr("shiftleft(1L, cast(pmod(w, 64) as int))").alias("one"))
    rows = longs.groupBy("chunk", "at").agg(F.bit_or("one").alias("bits")).groupBy("chunk").agg(F.collect_list(F.struct("at", "bits")).alias("set"))
    out = np.zeros(max(1, (1 << bits) >> 6), np.int64)
    for row in rows.toLocalIterator():
        at = np.array([s["at"] for s in row["set"]], np.int64)
        out[(row["chunk"] << 7) + at] = [s["bits"] for s in row["set"]]
    return out.view(np.uint8)


def _set(bits: np.ndarray, words: np.ndarray) -> np.ndarray:
    place = (words & np.uint64(len(bits) * 8 - 1)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def grams(words: Words, often: np.ndarray, longest: int) -> np.ndarray:
    """The gram that begins at each word, one row for each of its words; those of one word are left out.

    A gram is cut (``NONE``) where its piece ends and before a word without its bit.
    """
    n = len(words.hashes)
    kept = _set(often, words.hashes)
    table = np.zeros((longest, n), np.uint64)
    goes_on = kept.copy()
    for k in range(min(longest, n)):
        if k:
            goes_on[: n - k] &= ~words.last[k - 1 : n - 1] & kept[k:]
            goes_on[n - k :] = False
        table[k, : n - k] = np.where(goes_on[: n - k], words.hashes[k:], np.uint64(NONE))
    return table[:, table[1] != NONE]


def counted(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams and how often each occurs, those of one first word together."""
    rest = np.zeros(table.shape[1], np.uint64)
    for row in table[1:]:
        rest = hashes.mix(rest ^ row)
    # a word's high bits, then the other words': grams that share a key by chance may stay in two rows
    key = (table[0] & np.uint64(~((1 << 40) - 1) & ((1 << 64) - 1))) | (rest >> np.uint64(24))
    table = table[:, np.argsort(key)]
    new = np.ones(table.shape[1], bool)
    new[1:] = (table[:, 1:] != table[:, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    return table[:, first], np.diff(np.append(first, table.shape[1]))


def _columns(longest: int) -> list[str]:
    return [f"w{i}" for i in range(1, longest + 1)]


def heavy_grams(docs: DataFrame, words: DataFrame, least: int, longest: int = LONGEST, text: str = "text", lang: str = "lang") -> DataFrame:
    """``size, w1 .. , f``: every gram of 2 to ``longest`` words with ``least`` occurrences.

    ``words``: the vocabulary's words with ``least`` occurrences, stored.
    """
    spark, w = docs.sparkSession, _columns(longest)
    often = spark.sparkContext.broadcast(bitmap(words, BITS))
    total = words.agg(F.sum("n")).first()[0] or 0
    hot = [r["w"] for r in words.where(F.col("n") * HOT >= total).select("w").toLocalIterator()]  # at most HOT words
    names = [*w, "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for block in _read(batches):
            held.append(grams(block, often.value, longest))
            if sum(t.shape[1] for t in held) > GRAMS:
                yield from sent(held)
                held = []
        if held:
            yield from sent(held)

    def sent(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        table, n = counted(np.concatenate(held, axis=1))
        for a in range(0, len(n), 1 << 17):
            b = a + (1 << 17)
            yield pa.RecordBatch.from_arrays([*[_signed(np.ascontiguousarray(c[a:b])) for c in table], pa.array(n[a:b])], names=names)

    found = _corpus(docs, text, lang).mapInArrow(run, ", ".join(f"{c} bigint" for c in names))
    salt = F.when(F.col("w1").isin(hot) & F.col("w2").isin(hot), F.pmod(F.col(w[-1]), F.lit(SALTS)) + 1).otherwise(F.lit(0)) if longest > 2 else F.lit(0)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    dealt = found.withColumn("salt", salt.cast("bigint")).repartition(parts, "w1", "w2", "salt")
    edges = dealt.groupBy("w1", "w2", "salt", *w[2:]).agg(F.sum("n").alias("n"))
    # node flows: sums over what follows, from the longest grams down, in the same partition
    rows = edges.withColumn(f"f{longest}", F.col("n")).withColumn(f"first{longest}", F.lit(True))
    for size in range(2, longest):
        same = Window.partitionBy("w1", "w2", "salt", *w[2:size])
        rows = rows.withColumn(f"f{size}", F.sum("n").over(same)).withColumn(f"first{size}", F.row_number().over(same.orderBy(*w[size:])) == 1)
    told = []
    for size in range(2, longest + 1):
        whole = F.col(f"w{size}") != NONE
        enough = (F.col(f"f{size}") >= least) | (F.col("salt") > 0)
        gram = F.struct(F.lit(size).alias("size"), *[F.col(c) if i < size else F.lit(NONE).cast("bigint").alias(c) for i, c in enumerate(w)], F.col(f"f{size}").alias("f"), "salt")
        told.append(F.when(whole & enough & F.col(f"first{size}"), gram))
    listed = rows.select(F.explode(F.array_compact(F.array(*told))).alias("g")).select("g.*")
    listed = stored(listed, "phrases-grams")
    whole = listed.where("salt = 0").select("size", *w, "f")
    parted = listed.where("salt > 0").groupBy("size", *w).agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return whole.union(parted)


def score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)), exact."""
    digits = lambda c: c.cast("decimal(16,0)")
    up = (digits(a) * digits(a)).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    down = digits(l) * digits(r)
    return F.call_function("div", up.cast("decimal(38,0)"), down.cast("decimal(38,0)")).cast("bigint")


def unary_links(edges: DataFrame, nodes: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``edge, next``: edges joined by a node whose count is that of both, so that nothing else meets there."""
    w = _columns(longest)
    key = lambda names: F.concat_ws(" ", *[F.col(c).cast("string") for c in names])
    named = edges.select(key(w).alias("edge"), key(w[:-1]).alias("tail"), key(w[1:]).alias("head"), "f")
    flow = nodes.select(key(w[:-1]).alias("node"), F.col("f").alias("flow"))
    into = named.join(flow, F.col("head") == F.col("node")).where("f = flow").select("edge", F.col("node").alias("meet"))
    out = named.join(flow, F.col("tail") == F.col("node")).where("f = flow").select(F.col("edge").alias("next"), F.col("node").alias("leave"))
    return into.join(out, F.col("meet") == F.col("leave")).where("edge <> next").select("edge", "next")


def compact(links: DataFrame) -> DataFrame:
    """``edge, path, place``: the edges of every unary path, named by its last edge, counted from there.

    Pointer doubling: each round every edge takes over what the edge it points at points
    at, so a path of n edges takes log2(n) rounds.  A path cannot be a ring: pieces end.
    """
    ends = links.select(F.col("next").alias("edge")).join(links.select("edge"), "edge", "left_anti")
    start = links.select("edge", F.col("next").alias("path"), F.lit(1).cast("bigint").alias("place"), F.lit(False).alias("done"))
    last = ends.select("edge", F.col("edge").alias("path"), F.lit(0).cast("bigint").alias("place"), F.lit(True).alias("done"))
    now = stored(start.union(last), "phrases-paths")
    while not now.where("not done").isEmpty():
        at = now.select(F.col("edge").alias("there"), F.col("path").alias("far"), F.col("place").alias("more"), F.col("done").alias("ends"))
        step = now.where("not done").join(at, F.col("path") == F.col("there"))
        moved = step.select("edge", F.col("far").alias("path"), (F.col("place") + F.col("more")).alias("place"), F.col("ends").alias("done"))
        older, now = now, stored(now.where("done").union(moved), "phrases-paths")
        discard(older)
    return now.drop("done")


class Collocations:
    """Candidates of one corpus, and the unary paths of its graph."""

    def __init__(self, docs: DataFrame, least: int = 10, longest: int = LONGEST, text: str = "text", lang: str = "lang"):
        self.longest, self.w = longest, _columns(longest)
        counted = stored(vocabulary(docs, text, lang), "phrases-vocabulary")
        self.totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
        self.words = stored(counted.where(F.col("n") >= least), "phrases-words")
        self.grams = stored(heavy_grams(docs, self.words, least, longest, text, lang), "phrases-heavy")

    def _of(self, size: int) -> DataFrame:
        return self.grams.where(F.col("size") == size)

    @cached_property
    def paths(self) -> DataFrame:
        """``edge, path, place`` of the graph's unary paths of two edges and more, compacted."""
        return compact(unary_links(self._of(self.longest), self._of(self.longest - 1), self.longest))

    def passages(self) -> DataFrame:
        """``lang, passage, n_words, f``: the words along each unary path and how often they stand together."""
        at = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("place")))
        ids = F.transform(F.split("edge", " "), lambda x: x.cast("bigint"))
        # the first edge gives all its words, each further one its last
        placed = self.paths.withColumn("_at", at).withColumn("_ids", F.when(F.col("_at") == 1, ids).otherwise(F.slice(ids, self.longest, 1)))
        each = placed.select("path", "_at", F.posexplode("_ids").alias("_i", "_w"))
        spelled = each.join(self.words.select(F.col("w").alias("_w"), "word", "lang"), "_w")
        joined = spelled.groupBy("path").agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("_at", "_i", "word"))).alias("_all"))
        key = F.concat_ws(" ", *[F.col(c).cast("string") for c in self.w])
        counts = self._of(self.longest).select(key.alias("path"), "f")
        return joined.join(counts, "path").select("lang", F.concat_ws(" ", "_all.word").alias("passage"), F.size("_all").cast("bigint").alias("n_words"), "f")

    def _parted(self) -> DataFrame:
        """Each gram with its ``lang`` and the counts of the parts of every cut."""
        w, found = self.w, None
        single = self.words.select(F.col("w").alias("_w"), F.col("n").alias("_n"), F.col("lang").alias("_lang"))
        count = lambda size: self._of(size).select(*[F.col(c).alias(f"_{c}") for c in w[:size]], F.col("f").alias("_n"))
        for size in range(2, self.longest + 1):
            rows = self._of(size)
            for at, part in [(f"{side}{k}", w[:k] if side == "l" else w[k:size]) for k in range(1, size) for side in "lr"]:
                known = single if len(part) == 1 else count(len(part))
                keys = ["_w"] if len(part) == 1 else [f"_{c}" for c in w[: len(part)]]
                test = F.lit(True)
                for mine, other in zip(part, keys):
                    test = test & (F.col(mine) == F.col(other))
                rows = rows.join(known, test).withColumnRenamed("_n", at).drop(*keys)
                if len(part) == 1 and part == w[:1]:
                    rows = rows.withColumnRenamed("_lang", "lang")
                else:
                    rows = rows.drop("_lang")
            scored = F.array(*[F.struct(score(F.col("f"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, size)])
            rows = rows.select("lang", "size", *w, F.col("f").alias("a"), F.array_min(scored).alias("_cut"))
            found = rows if found is None else found.union(rows)
        return found.select("lang", "size", *w, "a", "_cut.l", "_cut.r", "_cut.score")

    def _contained(self) -> DataFrame:
        """Grams that lie in a longer one of at least half their count: ``size, w1 ..``.

        An inner node of a unary path lies in an edge of its own count; other grams are
        told by the longer ones that hold them, one row for each, reduced on the map side.
        """
        w, parts = self.w, []
        for longer in range(3, self.longest + 1):
            for size in range(2, longer):
                for at in range(longer - size + 1):
                    gram = [F.col(w[at + i]).alias(w[i]) if i < size else F.lit(NONE).cast("bigint").alias(w[i]) for i in range(self.longest)]
                    parts.append(F.struct(F.lit(longer).alias("_longer"), F.lit(size).alias("size"), *gram, "f"))
        if not parts:
            return self.grams.where("false").select("size", *w)
        within = F.split("edge", " ")
        inner = [F.get(within, F.lit(i + 1)).cast("bigint") if i < self.longest - 1 else F.lit(NONE).cast("bigint") for i in range(self.longest)]
        settled = self.paths.where("place > 0").select(F.lit(self.longest - 1).alias("size"), *[c.alias(n) for c, n in zip(inner, w)])
        inside = self.grams.select(F.col("size").alias("_of"), F.explode(F.array(*parts)).alias("g")).where("g._longer = _of").select("g.*")
        inside = inside.join(settled, ["size", *w], "left_anti")
        most = inside.groupBy("size", *w).agg(F.max("f").alias("_most"))
        same = F.col("_size") == F.col("size")
        for c in w:
            same = same & (F.col(f"_{c}") == F.col(c))
        own = self.grams.select(F.col("size").alias("_size"), *[F.col(c).alias(f"_{c}") for c in w], F.col("f").alias("_f"))
        return most.join(own, same).where("100 * _most >= 50 * _f").select("size", *w).union(settled)

    def top(self, first: int = 2000) -> DataFrame:
        """Each language's first phrases by score, count and words."""
        w = self.w
        keys = ["size", *w]
        stays = self._parted().join(self._contained(), keys, "left_anti")
        # those that tie with the last count and score are told apart by their words, so all of them are spelled
        # a language's candidates are ranked in parts first; what ranks among the first does so in its part
        by = [F.desc("score"), F.desc("a")]
        parted = stays.withColumn("_part", F.pmod(F.xxhash64(*w), F.lit(SALTS)))
        parted = parted.withColumn("_r", F.rank().over(Window.partitionBy("lang", "_part").orderBy(*by))).where(F.col("_r") <= first)
        near = parted.withColumn("_r", F.rank().over(Window.partitionBy("lang").orderBy(*by))).where(F.col("_r") <= first)
        spelled = near
        single = self.words.select(F.col("w").alias("_w"), F.col("word").alias("_word"))
        for c in w:
            spelled = spelled.join(single, F.col(c) == F.col("_w"), "left").withColumnRenamed("_word", f"_said_{c}").drop("_w")
        phrase = spelled.withColumn("phrase", F.concat_ws(" ", *[f"_said_{c}" for c in w]))
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = phrase.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= first)
        return ranked.join(self.totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
