"""The registered queries against their SQL twins, and the pipeline's stages against brute force."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from verify_oracle import compare, connect

from __spark_entry__ import oracle_sql, queries
from ridgepole.llm.queries import ORACLE, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_is_registered():
    assert {re.match(r"op(\d+)_", name)[1] for name in QUERIES} == {str(i) for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), QUERIES[name], ORACLE[name], sf_dir) == ""


def _stages(spark, docs, sf_dir, tmp_path):
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(f"{tmp_path}/{i}")
        out.append(spark.read.parquet(f"{tmp_path}/{i}"))
    return out


def test_stages(spark, sf_dir, tmp_path):
    from test_texts import _components, _targets

    tables = _stages(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir, tmp_path)
    start, told, single, cut, mixed, packed = [t.collect() for t in tables]
    assert all(t.columns == COLUMNS for t in tables[:-1])
    assert {r["doc_id"] for r in told} == {r["doc_id"] for r in start if r["text"] and any(c.isalpha() for c in r["text"])}
    leads = {doc for doc, _, component in _components([(r["doc_id"], r["text"]) for r in told]) if doc == component}
    assert {r["doc_id"] for r in single} == leads and len(single) == len(leads)
    # no string of 200 bytes that stood twice is left whole in a text
    raw = {r["doc_id"]: r["text"].encode() for r in single}
    seen = Counter(b[s : s + 200] for b in raw.values() for s in range(len(b) - 199))
    twice = {k for k, n in seen.items() if n > 1}
    for r in cut:
        repeats = any(raw[r["doc_id"]][s : s + 200] in twice for s in range(len(raw[r["doc_id"]]) - 199))
        assert (r["text"] != raw[r["doc_id"]].decode()) == repeats and r["n_chars"] == len(r["text"])
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = Counter(), Counter()
    for r in cut:
        sizes[r["source"]] += words(r["text"])
    for r in mixed:
        taken[r["source"]] += words(r["text"])
    longest = Counter()
    for r in cut:
        longest[r["source"]] = max(longest[r["source"]], words(r["text"]))
    for source, target in _targets(sizes).items():
        assert abs(taken[source] - target) <= 2 * longest[source]
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 3
    assert Counter(r["doc_id"] for r in packed if r["start"] == 0).keys() == {r["doc_id"] for r in mixed}


def test_stages_of_empty_and_odd_tables(spark, sf_dir, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    assert [t.count() for t in _stages(spark, spark.createDataFrame([], schema), sf_dir, tmp_path / "none")] == [0] * 6
    rows = [(1, None, None, None, None), (None, "words without an id", "en", None, 1), (2, "", "en", "a", 0), (2, "same id, other words", None, "a", None), (2, "same id, other words", "en", "a", None), (3, "123 !", "en", "a", 5)]
    counts = [t.count() for t in _stages(spark, spark.createDataFrame(rows, schema), sf_dir, tmp_path / "odd")]
    assert counts[:4] == [6, 3, 2, 2]


def test_clean_texts_under_repeated_ids_stay(spark, sf_dir):
    """Removal is by id and text: a copy goes, other texts of its id stay, equal rows are folded."""
    say = lambda word: " ".join(f"{word}{i}" for i in range(40))
    rows = [(3, say("a")), (7, say("a")), (7, say("b")), (9, say("c")), (9, say("d")), (9, say("d")), (11, say("e") + " more"), (11, say("e")), (None, say("a")), (12, None), (12, ""), (12, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir).select("doc_id", "text").collect()
    found = Counter((r.doc_id, r.text) for r in kept)
    of_eleven = [t for i, t in found if i == 11]
    assert len(of_eleven) == 1 and of_eleven[0] in (say("e"), say("e") + " more")
    assert {k: n for k, n in found.items() if k[0] != 11} == {
        (3, say("a")): 1, (7, say("b")): 1, (9, say("c")): 1, (9, say("d")): 1, (None, say("a")): 1, (12, None): 1, (12, ""): 1,
    }


def test_documents_without_an_id_are_compared(spark, sf_dir):
    """Copies without an id go but for one, so the next stage does not cut their text from all of them."""
    say = lambda word: " ".join(f"{word}{i}" for i in range(80))
    rows = [(None, say("a")), (None, say("a")), (None, say("b")), (None, say("b") + " more"), (None, say("c")), (4, say("d")), (5, say("d")), (5, say("e"))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    of_b = [t for i, t in found if t.startswith("b")]
    assert len(of_b) == 1 and of_b[0] in (say("b"), say("b") + " more")
    assert found == {(None, say("a")): 1, (None, of_b[0]): 1, (None, say("c")): 1, (4, say("d")): 1, (5, say("e")): 1}
    left = corpus_pipeline.repeated_passages(spark, kept, sf_dir).select("doc_id", "text").collect()
    assert Counter((r.doc_id, r.text) for r in left) == found
