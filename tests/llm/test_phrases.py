"""Collocations against counting every gram, and the graph's unary paths."""

import random
import re
from collections import Counter, defaultdict

import pytest
from verify_oracle import compare, connect

from ridgepole.llm import phrases, queries, sql

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "text string, lang string, doc_id bigint, w string, n string, f int"


def brute(rows, least, longest, first):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        gone = set()
        for g, a in candidates.items():
            for size in range(2, len(g)):
                for i in range(len(g) - size + 1):
                    if 100 * a >= 50 * f[g[i : i + size]]:
                        gone.add(g[i : i + size])
        found = []
        for g, a in candidates.items():
            if g not in gone:
                score, _, l, r = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))  # noqa: E741
                found.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:first], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def made_up(seed, n=300, vocabulary=9):
    draw = random.Random(seed)
    words = [f"W{i}é" if i % 3 else f"x{i}" for i in range(vocabulary)] + ["中文", " nb"]
    passage = "One fixed passage of many words that stands here again and again"
    rows = []
    for i in range(n):
        text = "".join(draw.choice(words) + draw.choice([" ", "  ", "\t", ". ", "\n", ", ", " ", " "]) for _ in range(draw.randint(0, 12)))
        rows.append((text + (passage if draw.random() < 0.2 else ""), draw.choice(["en", "de", None, "und"])))
    return [*rows, (None, "en"), ("", "fr"), (" \t\n.", "fr"), (rows[0][0], rows[0][1])]


def frame(spark, rows):
    return spark.createDataFrame([(t, g, i, "x", "y", 1) for i, (t, g) in enumerate(rows)], SCHEMA).repartition(3)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least, longest, first", [(2, 3, 2000), (5, 3, 7), (3, 4, 2000), (3, 2, 50)])
def test_against_counting(spark, least, longest, first):
    rows = made_up(least * 10 + longest)
    assert found(phrases.Collocations(frame(spark, rows), least, longest).top(first)) == brute(rows, least, longest, first)


def test_full_bitmap_hot_pairs_and_small_blocks(spark, monkeypatch):
    rows = made_up(5) + [("the thing " * 4 + f"w{i}", "en") for i in range(60)]
    monkeypatch.setattr(phrases, "BITS", 6)  # every word shares its bit
    monkeypatch.setattr(phrases, "HOT", 12)
    monkeypatch.setattr(phrases, "SALTS", 5)
    own = phrases.Collocations(frame(spark, rows), 3)
    assert found(own.top()) == brute(rows, 3, 3, 2000)


def test_blocks_cut_texts_nowhere():
    texts, langs = [b"a b c. d e", b"f", b"g h i j"], ["en", "de", "en"]
    words = phrases.Words(texts, langs)
    assert [words.text(i) for i in range(len(words.starts))] == [b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"h", b"i", b"j"]
    assert words.last.tolist() == [False, False, True, False, True, True, False, False, False, True]
    assert [words.names[i] for i in words.lang] == ["en"] * 5 + ["de"] + ["en"] * 4
    import numpy as np

    table, n = phrases.counted(phrases.grams(words, np.full(8, 255, np.uint8), 3))
    assert n.sum() == 6 and (table[2] == 0).sum() == 3  # ab-, bc., de., gh-, hi-, ij.: three end their piece


def test_paths_and_passages(spark):
    passage = "this passage of ten words stands in several texts whole"
    rows = [(f"odd{i} {passage}" if i % 2 else f"{passage}. tail{i}", "en") for i in range(12)]
    own = phrases.Collocations(frame(spark, rows), 5)
    assert [tuple(r) for r in own.passages().collect()] == [("en", passage, 10, 12)]
    assert own.paths.count() == 8
    assert {r.phrase for r in own.top().collect()} == {" ".join(passage.split()[i : i + 3]) for i in range(8)}


def test_no_rows_and_long_texts(spark):
    assert phrases.Collocations(frame(spark, [("x", "en")]).where("false")).top().count() == 0
    rows = [(" ".join(f"a{i % 50} b{i % 7}" for i in range(150_000)), "en"), ("z" * 100_000, "en")]
    assert found(phrases.Collocations(frame(spark, rows)).top()) == brute(rows, 10, 3, 2000)


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    big = 3_000_000_000_123
    row = spark.range(1).select(phrases.score(F.lit(big), F.lit(big + 7), F.lit(2 * big)).alias("s")).first()
    assert row.s == 1_000_000 * big * big // ((big + 7) * 2 * big)


def test_query_against_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), queries.QUERIES["op12_collocations"], sql.ORACLE["op12_collocations"], sf_dir) == ""
