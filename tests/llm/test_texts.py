"""Text operators against brute force, and their defined results on odd rows."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridgepole.llm import counts, inducing, jaccard, langid, mixing, packing, quotes, repeats, shards, shingles, tokens
from ridgepole.session import scratch_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, slot string, score string, a string"
LONG = " ".join(f"word{i % 977} filler{i}" for i in range(60_000))  # about a megabyte
PASSAGE = "This passage of some length stands in several of the documents, word by word, and is therefore taken out of all of them, whatever else they say before it or after it; it has more than two hundred bytes, as is easy to see."

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away into the green wood.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away into the green wood.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away into the green wood.", "en", "a"),
    (3, None, None, None),
    (4, "", "de", "b"),
    (5, " \n\t ", "de", "b"),
    (6, "1234 5678 !!!", None, "a"),
    (7, "Der schnelle braune Fuchs springt über den faulen Hund und läuft in den Wald. " + PASSAGE, "de", "b"),
    (8, PASSAGE + " Le renard brun saute par-dessus le chien paresseux et court vers la forêt.", "fr", None),
    (9, LONG, "en", "c"),
    (10, LONG + " one more end", "en", "c"),
    (11, "two words", "en", "a"),
    (12, "Two WORDS", "en", "a"),
    (None, "A document without an id that still has some words to say.", "en", "a"),
    (None, None, None, None),
    (13, "\x00 odd \x00 bytes é中\U0001f600 here", "en", "d"),
    (14, "ab" * 900, "en", "d"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows, and columns named like added ones."""
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "s", None, "x", "y") for r in ROWS], DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- sharding -----------------------------------------------------------------------------


def test_grown_tree_moves_rows_only_to_the_new_shard(spark):
    nodes = shards.tree(16)
    rows = spark.range(4000).select(F.col("id").alias("k"))
    both = shards.place(shards.place(rows, F.col("k"), nodes), F.col("k"), shards.grow(nodes), out="grown").collect()
    assert all(r["grown"] in (r["shard"], 16) for r in both)
    assert {r["shard"] for r in both} == set(range(16))
    assert 4000 / 17 * 0.7 < sum(r["grown"] == 16 for r in both) < 4000 / 17 * 1.3


def test_a_changed_weight_moves_rows_only_in_its_subtree(spark):
    nodes = shards.tree(8)
    heavier = shards.reweigh(nodes, 5, 3.0)
    rows = spark.range(4000).select(F.col("id").alias("k"))
    both = shards.place(shards.place(rows, F.col("k"), nodes), F.col("k"), heavier, out="after").collect()
    region, rack = (lambda s: s // 4), (lambda s: s // 2)
    for r in both:
        # out of another region only into the heavier one; inside it, other racks lose to the heavier rack only
        if region(r["shard"]) != region(r["after"]):
            assert region(r["after"]) == 1
        elif rack(r["shard"]) != rack(r["after"]):
            assert rack(r["after"]) == 2
        elif r["shard"] != r["after"]:
            assert r["after"] == 5
    share = Counter(r["after"] for r in both)
    assert 0.25 < share[5] / 4000 < 0.35  # 3 of 10


def test_shards_of_odd_rows(odd, none):
    placed = shards.with_slots(shards.place(odd, F.col("doc_id"), shards.tree(16)), F.col("doc_id"), ["doc_id", "text"], block=4)
    rows = placed.collect()
    assert len(rows) == odd.count()
    for s in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert shards.with_slots(shards.place(none, F.col("doc_id"), shards.tree(4)), F.col("doc_id"), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        shards.place(odd, F.col("doc_id"), (shards.Shard(0, 0, 0, 0.0),))


# --- tokens, counts, packing --------------------------------------------------------------


def test_encoder_equals_the_tokenizer():
    rng = np.random.default_rng(3)
    parts = ["a", "b", "st", "'s", "'ll", "'", " ", "  ", "\n", "\t", "é", "中", "1", "½", "²", "!", "’", "\r\n", "<|endoftext|>", "\x1c", "\x85", " ", "word", " the", "😀"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(3000)]
    own = tokens.Encoder(PATH)
    for _ in range(2):  # the second time from memory
        ids, lengths = own.encode(texts)
        want = [e.ids for e in own._own.encode_batch(texts, add_special_tokens=False)]
        assert lengths.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def _ids(text):
    own = tokens.encoder(PATH)
    return [*own._own.encode(text or "", add_special_tokens=False).ids, 0]


def _check_packing(spark, source, capacity=1024):
    docs = Counter((r["doc_id"], tuple(_ids(r["text"]))) for r in source.select("doc_id", "text").collect())
    rows = packing.pack(source, PATH, capacity=capacity).collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append(r)
    padding = 0
    for pieces in bins.values():
        pieces.sort(key=lambda r: r["offset"])
        at = 0
        for r in pieces:
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    want = defaultdict(Counter)
    for (doc, ids), n in docs.items():
        want[doc][ids] += n
    for doc, texts in want.items():
        for ids in texts:
            raw = np.array(ids, "<u4")
            mine = [p for p in by_doc[doc] if p[3] == len(ids) and zlib.crc32(raw[p[0] : p[0] + p[1]].tobytes()) == p[2]]
            assert sum(p[1] for p in mine) == len(ids) * texts[ids]
    assert sum(r["length"] for r in rows) == sum(len(ids) * n for (_, ids), n in docs.items())
    return padding, len(bins)


def test_packing(spark, docs):
    padding, bins = _check_packing(spark, docs.repartition(3))
    assert padding <= 0.01 * 1024 * bins


def test_packing_of_odd_rows(spark, odd, none):
    _check_packing(spark, odd, capacity=64)
    assert packing.pack(none, PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd, PATH, capacity=1000)


def test_a_task_opens_few_texts_of_a_batch_at_a_time(spark, none, monkeypatch):
    """Texts and what is made of them take less room than their batch, once a task's fixed tables stand."""

    def peak(work, *args):
        for _ in work(*args):
            pass
        tracemalloc.start()
        for _ in work(*args):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    rng = np.random.default_rng(5)
    words = np.array([f" word{i}" for i in range(500)])
    texts = ["".join(rng.choice(words, 1000)) for _ in range(40)] * 100
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    monkeypatch.setattr(type(none), "mapInArrow", lambda self, run, schema: run)
    monkeypatch.setattr(packing.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    assert batch.nbytes > 24 << 20
    assert peak(packing.pack(none, PATH), [batch]) < batch.nbytes
    model = langid.Model(("a", "b"), np.full((2, langid.BUCKETS), 1 / langid.BUCKETS, np.float32))
    told = langid.predict(none.select("doc_id", "text"), model, F.col("text"))
    assert peak(told, [batch.slice(0, 2000).append_column("_text", batch.column(1).slice(0, 2000))]) < batch.nbytes / 4
    assert peak(jaccard._parts, batch.column(1)) < batch.nbytes


def test_pieces_of_lengths():
    doc, start, size = packing.cut(np.array([700, 0, 1024, 1, 2049]), 1024)
    found = sorted(zip(doc.tolist(), start.tolist(), size.tolist()))
    assert found == [(0, 0, 512), (0, 512, 170), (0, 682, 18), (2, 0, 1024), (3, 0, 1), (4, 0, 1024), (4, 1024, 1024), (4, 2048, 1)]


def test_token_totals(spark, odd, none):
    counted = counts.count_tokens(odd.select("doc_id", "source", "lang", "text"), PATH).cache()
    assert {(r["doc_id"], r["n_tokens"]) for r in counted.collect()} == {(r["doc_id"], len(_ids(r["text"])) - 1) for r in odd.collect()}
    store = counts.Totals(spark, scratch_dir(spark, "totals"))
    assert store.totals().count() == 0
    assert store.commit("load", counts.inserted(counted, "v1"))
    assert not store.commit("load", counts.inserted(counted, "v1"))

    def totals():
        return {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"]) for r in store.totals().collect()}

    want = defaultdict(lambda: [0, 0])
    for r in counted.collect():
        own = want[(r["source"], r["lang"], "v1")]
        own[0] += 1
        own[1] += r["n_tokens"]
    assert totals() == {k: tuple(v) for k, v in want.items()}
    store.commit("one more id", counts.revised(counted, "v1", F.col("n_tokens"), F.col("n_tokens") + 1))
    assert totals() == {k: (v[0], v[1] + v[0]) for k, v in want.items()}
    store.commit("drop a", counts.deleted(counted.where("source = 'a'").withColumn("n_tokens", F.col("n_tokens") + 1), "v1"))
    assert totals() == {k: (v[0], v[1] + v[0]) for k, v in want.items() if k[0] != "a"}
    store.commit("odd / name?", counts.inserted(none.select("source", "lang", F.lit(1).alias("n_tokens")), "v1"))
    assert not store.commit("odd / name?", counts.inserted(counted, "v1"))


# --- language -----------------------------------------------------------------------------


def test_language_of_held_out_documents(docs):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = langid.predict(docs.where(held), langid.fit(docs.where(~held)), F.col("text")).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.95 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_mixture(docs):
    model = langid.fit(docs)
    best = {r["lang"]: r["text"] for r in docs.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text")).collect()}
    half = best["fr"][:3000] + " " + best["de"][:3000]
    names, scores, sets = langid.infer(model, [half, best["fr"], best["fr"]])
    assert {s.split(":")[0] for s in sets[0].split(",")} >= {"fr", "de"} and 0.35 < scores[0] < 0.65
    assert (names[1], scores[1], sets[1]) == (names[2], scores[2], sets[2]) and names[1] == "fr"


def test_language_of_odd_rows(odd, none):
    model = langid.fit(odd)
    rows = {(r["doc_id"], r["text"]): r for r in langid.predict(odd, model, F.col("text")).collect()}
    for (doc, text), r in rows.items():
        letters = bool(text) and any(c.isalpha() for c in text)
        assert (r["lang_pred"] != "und") == letters
        assert isinstance(r["score"], float)
    assert langid.predict(none, model, F.col("text")).count() == 0
    empty = langid.fit(none)
    assert {r["lang_pred"] for r in langid.predict(odd, empty, F.col("text")).collect()} == {"und"}


# --- shingle join -------------------------------------------------------------------------


def _shingle_sets(rows):
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def _components(rows, percent=80):
    """(doc_id, size, component) of every row by comparing all that share a shingle."""
    sets = _shingle_sets(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    for i, s in enumerate(sets):
        if rows[i][0] is None:
            continue
        both = Counter(j for x in s for j in where[x] if j > i and rows[j][0] is not None)
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return Counter((rows[i][0], len(sets[i]), least[find(i)] if sets[i] and rows[i][0] is not None else rows[i][0]) for i in range(len(rows)))


def _joined(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect())


def test_join_equals_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert _joined(docs) == _components(rows)


def test_join_of_odd_rows(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert _joined(odd) == _components(rows)
    assert jaccard.join(none).count() == 0


def test_join_of_near_copies_and_common_lines(spark):
    """A large group of copies with their own edits, chains of small changes, a line in every text."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    line = " ".join(words[:12])
    base = list(rng.choice(words, 120))
    rows = []
    for i in range(90):
        own = base.copy()
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            own[at] = str(rng.choice(words))
        rows.append((i, " ".join(own)))
    chain = list(rng.choice(words, 150))
    for i in range(90, 130):
        chain = chain[2:] + list(rng.choice(words, 2))
        rows.append((i, " ".join(chain)))
    for i in range(130, 220):
        rows.append((i, line + " " + " ".join(rng.choice(words, int(rng.integers(5, 60))))))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert _joined(df) == _components(rows)


def test_join_of_members_that_share_a_shingle_of_two_groups(spark):
    """A and B have one prefix and size; C holds B and shares the prefix with them, and A leads the group."""
    rows, tried = [], 0
    while len(rows) < 36:
        word = lambda k: f"v{tried}x{k}"
        head = [word(k) for k in range(5)]
        texts = [" ".join(head + [word(k) for k in range(low, low + 3)]) for low in (5, 8)]
        a, b = shingles.sets([t.encode() for t in texts])
        if a[0] == b[0] and set(a) & set(b) == {a[0]} and shingles.key(a) < shingles.key(b):
            rows += [(len(rows) + k, t) for k, t in enumerate([*texts, texts[1] + " " + word(11)])]
        tried += 1
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert _joined(df) == _components(rows)
    assert len({component for _, _, component in _components(rows)}) == 24


def test_join_moves_texts_of_likely_pairs_only(spark, monkeypatch):
    """Lines that a few texts share, a long one that many share, and three pairs of near copies."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(5000)]
    text = lambda line, n: " ".join([*line, *rng.choice(words, n)])
    texts = []
    for _ in range(6):
        line = list(rng.choice(words, 30))
        texts += [text(line, 60) for _ in range(5)]
    long_line = list(rng.choice(words, 215))
    texts += [text(long_line, 50) for _ in range(30)]
    copies = [text([], 120) for _ in range(3)]
    texts += copies + [t + " more" for t in copies]
    rows = list(enumerate(texts))
    moved = Counter()

    def counting(df, label):
        out = stored(df, label)
        moved[label] += out.count()
        return out

    stored = jaccard.stored
    monkeypatch.setattr(jaccard, "stored", counting)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert _joined(df) == _components(rows)
    assert moved["jaccard-texts"] == 6


def test_bitmaps_differ_in_no_more_than_the_sets():
    rng = np.random.default_rng(9)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool[:spread], n)) for n, spread in ((1, 4), (63, 80), (64, 80), (65, 80), (700, 800), (900, 1000), (3000, 4000))]
    bits = [shingles.bitmap(s) for s in sets]
    assert {len(s): len(b) for s, b in zip(sets, bits)}[1] == 8
    for a, s in zip(bits, sets):
        for b, t in zip(bits, sets):
            apart = shingles.difference(a, b)
            assert apart <= len(np.setxor1d(s, t)) and shingles.difference(b, a) == apart
            assert not shingles.similar(s, t) or shingles.possible(apart, len(s) + len(t))
            both = [np.frombuffer(x, np.uint8)[None, :].repeat(2, 0) for x in (a, b)]
            assert (shingles.differences(*both) == apart).all()


def test_shingle_sets_of_long_texts_in_pieces(monkeypatch):
    texts = [b"a b c d e f g", b"", b" x ", b"A  b\tc d E f g", b"q r"]
    want = shingles.sets(texts)
    monkeypatch.setattr(shingles, "BYTES", 4)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(want, shingles.sets(texts)))
    assert (want[0] == want[3]).all() and [len(s) for s in want] == [3, 0, 1, 3, 1]


# --- suffix sorting -----------------------------------------------------------------------


def _suffixes(text, cap):
    t = bytes(text)
    order = sorted(range(len(t)), key=lambda i: t[i:])
    common = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while k < cap and max(a, b) + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        common.append(k)
    return order[::-1], [0, *common[::-1][:-1]]


@pytest.mark.parametrize("memory", [1 << 19, 5])
def test_induced_sorting(tmp_path, monkeypatch, memory):
    monkeypatch.setattr(inducing, "IN_MEMORY", memory)
    monkeypatch.setattr(inducing, "STEP", max(8, memory // 2))
    rng = np.random.default_rng(memory)
    for trial in range(60 if memory > 5 else 25):
        body = rng.integers(1, rng.integers(2, 8), rng.integers(0, 90)).astype(np.uint8)
        if trial % 4 == 0:
            body = np.tile(body[:7], 9)
        text, cap = np.append(body, np.uint8(0)), int(rng.choice([3, 20, 200]))
        got = ([], [])
        inducing.sorted_suffixes(inducing.Disk(str(tmp_path)), text, 256, cap, lambda p, c: (got[0].extend(p.tolist()), got[1].extend(c.tolist())))
        assert got == _suffixes(text, cap)
    assert not list(tmp_path.iterdir())


def _repeats(rows, length):
    """(doc_id, bytes, removed, runs, hash) of every row by counting all strings."""
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[s : s + length] for _, b in raw for s in range(len(b) - length + 1))
    out = Counter()
    for doc, b in raw:
        gone = np.zeros(len(b) + 1, np.int8)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = 1
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[(doc, len(b), int(gone.sum()), int((np.diff(np.append(0, gone)) == 1).sum()), hashlib.sha256(kept).hexdigest())] += 1
    return out


def _removed(df, **options):
    found = repeats.remove(df, **options).select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256))
    return Counter(tuple(r) for r in found.collect())


def test_removal_equals_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert _removed(docs) == _repeats(rows, 200)


def test_removal_from_odd_rows(odd, none):
    small = odd.where("text is null or length(text) < 100000")
    rows = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()]
    assert _removed(small) == _repeats(rows, 200)
    long = {(r["doc_id"], r["n_removed"], r["n_bytes"]) for r in repeats.remove(odd).where("n_bytes > 100000").collect()}
    assert long == {(9, next(n for d, _, n in long if d == 9), next(n for d, _, n in long if d == 9)), (10, next(n for d, _, n in long if d == 9), next(n for d, _, n in long if d == 10))}
    assert repeats.remove(none).count() == 0


def test_removal_in_whole_characters(spark):
    same = "é" * 150
    df = spark.createDataFrame([(1, "a" + same + "b"), (2, "c" + same + "d"), (3, "è" * 120 + "z"), (4, "x" + "è" * 120)], "doc_id bigint, text string")
    rows = {r["doc_id"]: bytes(r["kept"]).decode() for r in repeats.remove(df, characters=True).collect()}
    assert rows == {1: "ab", 2: "cd", 3: "z", 4: "x"}


# --- mixing -------------------------------------------------------------------------------


def test_sainte_lague_takes_the_highest_quotients():
    rng = np.random.default_rng(9)
    for _ in range(200):
        votes = rng.integers(0, 30, rng.integers(1, 9)).astype(float)
        caps = rng.integers(0, 12, len(votes))
        seats = int(rng.integers(0, 40))
        ranked = sorted(((-v / (2 * k + 1), i) for i, v in enumerate(votes) if v > 0 for k in range(caps[i])))[:seats]
        want = np.bincount([i for _, i in ranked], minlength=len(votes))
        assert mixing.sainte_lague(votes, seats, caps).tolist() == want.tolist()


def _targets(sizes, weights=(5, 2, 1), limit=3):
    names = sorted((k for k in sizes if k is not None), key=lambda k: k.encode()) + [k for k in sizes if k is None]
    weight = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    fixed, total = {}, float(sum(sizes.values()))
    while True:
        rest = [k for k in names if k not in fixed]
        level = (total - sum(fixed.values())) / sum(weight[k] for k in rest) if rest else 0
        over = [k for k in rest if level * weight[k] > limit * sizes[k]]
        if not over:
            return {**fixed, **{k: level * weight[k] for k in rest}}
        fixed.update({k: float(limit * sizes[k]) for k in over})


def _check_mix(df, **options):
    rows = mixing.mix(df, F.col("doc_id"), F.col("source"), mixing.word_count(F.col("text")), **options).collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert r["size"] == n and 0 <= r["taken"] <= 3 * n
        sizes[r["source"]] += n
        taken[r["source"]] += r["taken"]
    want = _targets(sizes)
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
    for k, t in want.items():
        assert abs(taken[k] - t) <= max(2, 0.01 * t)
    return Counter((r["doc_id"], r["text"], r["taken"]) for r in rows)


def test_mixing(docs):
    first = _check_mix(docs, cell_rows=40)
    assert first == _check_mix(docs.repartition(7), cell_rows=40)
    assert first != _check_mix(docs, cell_rows=40, seed=1)


def test_mixing_of_odd_rows(odd, none, spark):
    _check_mix(odd)
    assert mixing.mix(none, F.col("doc_id"), F.col("source"), mixing.word_count(F.col("text"))).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    _check_mix(blank)


# --- quotes -------------------------------------------------------------------------------


def test_quotes_are_linked_and_removed(spark):
    talk = [
        (1, 0, "Shall we meet\non Monday?"),
        (1, 1, "> Shall we meet\n> on   MONDAY?\nYes."),
        (1, 2, ">> Shall we meet\n> Yes.\nGood,\nat ten."),
        (1, 3, "> on Monday?\nNo, on Tuesday."),
        (1, 4, "> something nobody said\nNew matter."),
        (1, 5, "> > > Shall we meet\nlate"),
        (None, 0, "alone"),
        (None, 1, "> alone\nnot any more"),
        (2, None, "> alone\nno turn"),
        (2, 7, None),
        (2, 8, ""),
        (2, 9, "> Shall we meet\nother conversation"),
        (3, 0, "same"), (3, 1, "same"), (3, 2, "> same\nlatest of two"), (3, 2, "> same\nlatest of two"),
    ]
    df = spark.createDataFrame([(*t, "x") for t in talk], "conv_id bigint, turn bigint, text string, depth string").repartition(3)
    rows = {(r["conv_id"], r["turn"]): r for r in quotes.conversations(df).collect()}
    parents = {k: r["parent_turn"] for k, r in rows.items()}
    assert [parents[(1, t)] for t in range(6)] == [None, 0, 1, 0, None, 0]
    assert parents[(None, 1)] == 0 and parents[(2, None)] is None and parents[(2, 9)] is None and parents[(3, 2)] == 1
    assert rows[(1, 2)]["text"] == "Good,\nat ten." and rows[(2, 7)]["text"] == "" and rows[(2, None)]["text"] == "no turn"
    assert [(rows[(1, t)]["root_turn"], rows[(1, t)]["depth"], rows[(1, t)]["position"]) for t in range(6)] == [(0, 0, 0), (0, 1, 1), (0, 2, 2), (0, 1, 3), (4, 0, 5), (0, 1, 4)]
    assert quotes.conversations(df).count() == len(talk)
    assert quotes.conversations(df.limit(0)).count() == 0


def test_long_chain_of_replies(spark):
    df = spark.range(200).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.concat_ws("\n", F.when(F.col("id") > 0, F.concat(F.lit("> line "), F.col("id") - 1)), F.concat(F.lit("line "), "id")).alias("text"))
    rows = quotes.conversations(df).orderBy("position").collect()
    assert [(r["turn"], r["depth"], r["root_turn"], r["text"]) for r in rows] == [(i, i, 0, f"line {i}") for i in range(200)]


def test_repeats_work_on_few_texts_at_a_time(monkeypatch):
    """Cutting takes arrays of words for each byte, so a worker's memory follows the bytes it holds."""
    import pyarrow as pa

    held, real = [], repeats.pieces
    monkeypatch.setattr(repeats, "pieces", lambda texts, *more: held.append(sum(map(len, texts))) or real(texts, *more))
    texts = [f"{i} " * 400 for i in range(1200)] + ["long text " * 100_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["text", "value"])
    found = pa.Table.from_batches(repeats._cut(200, 64)(iter([batch])))
    assert max(held) <= repeats.BLOCK + 200 and set(found.column("text").to_pylist()) == set(range(len(texts)))
