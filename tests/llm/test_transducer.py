"""The transducer against merging itself and against tiktoken; decoding in blocks."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from ridgepole.llm import queries, transducer

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = regex.compile(public_tokenizers.PATTERN)
LONG = " ".join(f"word{i % 977} filler{i}" for i in range(60_000)) + "x" * 20_000


@pytest.fixture(scope="module")
def own():
    return transducer.Transducer(transducer.read_ranks(PATH))


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def toy(words):
    """Ranks of all single bytes and some longer tokens."""
    return {bytes([i]): i for i in range(256)} | {w: 256 + i for i, w in enumerate(words)}


@pytest.mark.parametrize("seed", range(6))
def test_merging_itself_on_small_alphabets(seed):
    draw = random.Random(seed)
    words = []
    for _ in range(14):  # each new token joins two that are there
        there = [b"a", b"b", b"c", *words]
        new = draw.choice(there) + draw.choice(there)
        if new not in words:
            words.append(new)
    own = transducer.Transducer(toy(words))
    for _ in range(1500):
        piece = bytes(draw.choice(b"abc") for _ in range(draw.randint(0, 24)))
        by_merging = [own.ranks[piece]] if piece in own.ranks else own.merged(piece)
        assert own.encode(piece) == by_merging
        if piece not in own.ranks:
            assert [i for given in own.stream(piece) for i in given] == by_merging


def test_ids_leave_after_bounded_lookahead():
    own = transducer.Transducer(toy([b"ab", b"abab", b"ababab"]))
    held = [len(own._ways[0])]
    given, state = 0, 0
    for n, byte in enumerate(b"ab" * 500, 1):
        state, out = own._step(state, byte)
        given += sum(len(own.tokens[i]) for i in out)
        held.append(n - given)
    assert max(held[1:]) <= 2 * 6 and len(own._ways) < 40


def test_tokens_that_merging_never_builds():
    own = transducer.Transducer(toy([b"xyz", b"ab"]))  # no pair makes xyz
    assert own.encode(b"xyz") == [256]
    assert own.encode(b"xyzz") == own.merged(b"xyzz") == [120, 121, 122, 122]


def test_documents_against_the_library(own, library, sf_dir, spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for text in [*texts, LONG, "", " ", "  a", "a  ", "a \n b  c", "\U0001f600 é中文", "I'll've it's"]:
        packed = own.by_word(text, PATTERN)
        assert ids(packed) == library.encode_ordinary(text)
        assert packed == own.whole(text, PATTERN)


def test_odd_blanks_against_the_library(own, library):
    draw = random.Random(3)
    bits = ["a", "b", " ", "  ", "\n", "\t", "'s", "'", "é", "中", "1", "!", " ", "the", " \n", "\r\n", "　", "\x1c"]
    for _ in range(4000):
        text = "".join(draw.choice(bits) for _ in range(draw.randint(0, 12)))
        assert ids(own.by_word(text, PATTERN)) == library.encode_ordinary(text)


def test_small_memories_change_nothing(monkeypatch, library, sf_dir, spark):
    monkeypatch.setattr(transducer, "STATES", 50)
    monkeypatch.setattr(transducer, "WORDS", 20)
    monkeypatch.setattr(transducer, "BLOCK", 8)
    small = transducer.Transducer(transducer.read_ranks(PATH))
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(25).collect():
        packed = small.by_word(row.text or "", PATTERN)
        assert ids(packed) == library.encode_ordinary(row.text or "")
        assert b"".join(transducer.Tokens(small.ranks).blocks(packed)) == (row.text or "").encode()


def test_utf8_machine_cut_anywhere():
    draw = random.Random(5)
    whole = "aé中\U0001f600ß end".encode()
    bad = [b"\xff", b"\xe2\x82", b"\xf0\x9f", b"\xed\xa0\x80", b"\xc0\xaf", b"\xf4\x90\x80\x80", b"\xe0\x80", b"\x80"]
    for _ in range(3000):
        data = b"".join(draw.choice([whole, *bad]) for _ in range(3))
        machine, out, at = transducer.Utf8Stream(), "", 0
        while at < len(data):
            step = draw.randint(1, 4)
            out += machine.feed(data[at : at + step])
            at += step
        assert out + machine.close() == data.decode("utf-8", "replace")


def test_query_against_the_library(spark, sf_dir, library):
    docs = {r.doc_id: (r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.op13_byte_bpe(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    for r in found:
        wanted = np.array(library.encode_ordinary(docs[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(wanted), hashlib.sha256(wanted.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", None), (3, LONG, "y"), (3, LONG, "y"), (None, "é \U0001f600", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").repartition(2)
    coded = transducer.encode(docs, PATH, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "ids"]
    back = transducer.decode(coded, PATH, as_text=True, out="text").collect()
    assert sorted(((r.doc_id or 0), r.text) for r in back) == sorted((a or 0, b or "") for a, b, _ in rows)
    assert transducer.encode(docs.where("false"), PATH, public_tokenizers.PATTERN).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id bigint, ids binary")
    assert transducer.decode(nothing, PATH).first().decoded is None
    unknown = nothing.select("doc_id", F.lit(b"\xff\xff\xff\x00").alias("ids"))
    with pytest.raises(Exception, match="lacks|out of bounds"):
        transducer.decode(unknown, PATH).collect()
