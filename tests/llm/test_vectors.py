"""Vector operators against brute force, and components against union-find."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgepole.llm import forest, near, vectors
from ridgepole.llm.common import components

ODD = [
    (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, [0.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]),
    (8, [math.nan, 1.0]), (9, [math.inf, 1.0]), (10, [None, 1.0]), (None, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [0.0, -3.0]), (60, None), (80, [1e-30, 1e-30]),
]


@pytest.fixture(scope="module")
def odd_vectors(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in ODD], "vec_id bigint, embedding array<double>, n_links string, rep int").repartition(3)


@pytest.fixture(scope="module")
def embeddings(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def _rows(df):
    return [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]


def _usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def _links(rows, threshold=0.9):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and _usable(v)]
    x = np.array([v / np.linalg.norm(v) for _, v in good])
    hit = x @ x.T >= threshold
    ids = [i for i, _ in good]
    parent = list(range(len(ids)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in zip(*np.nonzero(np.triu(hit, 1))):
        parent[find(a)] = find(b)
    least = defaultdict(lambda: 1 << 62)
    for k, i in enumerate(ids):
        least[find(k)] = min(least[find(k)], i)
    out = Counter()
    for k, i in enumerate(ids):
        out[(i, int(hit[k].sum()) - 1, least[find(k)], least[find(k)] == i)] += 1
    for i, v in rows:
        if i is None or not _usable(v):
            out[(i, 0, i, i is not None)] += 1
    return out


def _found(df, **options):
    return Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near.dedup(df, **options).collect())


def test_near_duplicates_equal_brute_force(embeddings):
    assert _found(embeddings) == _links(_rows(embeddings))


def test_near_duplicates_in_small_blocks(spark, monkeypatch):
    """Dense groups over many cells and blocks: almost all pairs are found, and none that is not there."""
    rng = np.random.default_rng(2)
    heads = rng.standard_normal((30, 16))
    rows = [(i, (heads[i % 30] + 0.12 * rng.standard_normal(16)).tolist()) for i in range(900)]
    monkeypatch.setattr(near, "CELL", 16)
    monkeypatch.setattr(near, "BLOCK", 20)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    want, got = _links(rows), _found(df)
    pairs = lambda c: sum(n * k for (_, n, _, _), k in c.items())
    assert 0.99 * pairs(want) <= pairs(got) <= pairs(want)
    assert near.dedup(df).columns == ["vec_id", "embedding", "n_links", "component_id", "kept"]


def test_near_duplicates_of_a_tight_group_over_many_cells(spark):
    """One group of thousands of different vectors, and as many without near neighbours: every link is found."""
    rng = np.random.default_rng(3)
    head = rng.standard_normal(16)
    tight = head / np.linalg.norm(head) + 0.07 * rng.standard_normal((3500, 16))
    rows = list(enumerate(np.concatenate([tight, rng.standard_normal((2500, 16))]).tolist()))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= 0.9
    lead = vectors.forest(len(x), *np.nonzero(hit))
    assert _found(df) == Counter((i, int(hit[i].sum()) - 1, int(lead[i]), bool(lead[i] == i)) for i in range(len(x)))


def test_near_duplicates_of_odd_rows(odd_vectors):
    assert _found(odd_vectors) == _links(_rows(odd_vectors))
    assert near.dedup(odd_vectors.limit(0)).count() == 0


def test_near_duplicates_are_compared_without_a_shuffle(spark, monkeypatch):
    """Vectors meet where they lie, in several rounds; ids repeat, and one cell is larger than a round."""
    rng = np.random.default_rng(5)
    loose, tight = rng.standard_normal((700, 24)), rng.standard_normal(24) + 0.1 * rng.standard_normal((300, 24))
    rows = [(i % 990, v.tolist()) for i, v in enumerate(np.concatenate([loose, tight, -0.5 * loose[:40], 2 * loose[:40]]))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    plans, kind = [], type(df)
    own = kind.mapInArrow

    def noted(self, *args, **options):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return own(self, *args, **options)

    monkeypatch.setattr(kind, "mapInArrow", noted)
    monkeypatch.setattr(near, "BLOCK", 250)
    monkeypatch.setattr(near, "CELL", 512)
    got = _found(df)
    assert not any("Exchange" in plan for plan in plans) and len(plans) > 4
    # vectors of one id are not linked, and their links are those of the id
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = (x @ x.T >= 0.9) & (ids[:, None] != ids[None, :])
    names, place = np.unique(ids, return_inverse=True)
    lead = names[vectors.forest(len(names), *(place[k] for k in np.nonzero(hit)))][place]
    n_links = np.bincount(place, hit.sum(axis=1))[place]
    assert got == Counter((int(i), int(n), int(c), bool(c == i)) for i, n, c in zip(ids, n_links, lead))


def test_rounds_hold_every_cell_once():
    many = np.array([0, 3, 4, 25, 0, 10, 1, 10, 0, 7])
    rounds = list(near._rounds(many, 10))
    assert rounds == [(0, 2, 0, 1), (3, 3, 0, 3), (3, 3, 1, 3), (3, 3, 2, 3), (4, 5, 0, 1), (6, 6, 0, 1), (7, 8, 0, 1), (9, 9, 0, 1)]
    assert list(near._rounds(np.zeros(3, np.int64), 10)) == []


def _nearest(rows, query_ids, most=20):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and _usable(v)]
    out = {}
    for q, v in good:
        if q in query_ids:
            ranked = sorted(((-float((v * w).sum()), i) for i, w in good if i != q))
            out[q] = [(i, -s) for s, i in ranked[:most]]
    return out


def _answers(df, **options):
    out = defaultdict(list)
    for r in forest.search(df, F.col("vec_id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_forest_to_the_roots_is_exact(embeddings):
    rows = _rows(embeddings)
    want, got = _nearest(rows, {i for i, _ in rows if i % 20 == 0}), _answers(embeddings)
    assert {q: [i for i, _ in a] for q, a in got.items()} == {q: [i for i, _ in a] for q, a in want.items()}


def test_forest_recall_and_scores(spark, sf_dir, monkeypatch):
    df = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.1") + "/embeddings.parquet")
    monkeypatch.setattr(forest, "SEGMENT", 300)
    rows = _rows(df)
    vec = {i: np.array(v, float) for i, v in rows}
    want, got = _nearest(rows, {i for i, _ in rows if i % 20 == 0}), _answers(df)
    assert set(want) == set(got)
    recall = np.mean([len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / 20 for q in want])
    assert recall >= 0.9
    for q, found in got.items():
        assert q not in {i for i, _ in found}
        for i, score in found:
            assert score == pytest.approx(float((vec[q] * vec[i]).sum()), abs=1e-12)
        assert [(-s, i) for i, s in found] == sorted((-s, i) for i, s in found)


def test_forest_recall_without_the_floor(spark, sf_dir):
    """What share alone finds, as in large tables, with a few vectors three times as long as the rest."""
    df = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.1") + "/embeddings.parquet")
    rows = [(i, (3 * np.array(v, float)).tolist() if i % 400 == 1 else v) for i, v in _rows(df)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    want, got = _nearest(rows, {i for i, _ in rows if i % 20 == 0}), _answers(df, least=0)
    assert set(want) == set(got)
    assert np.mean([len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / 20 for q in want]) >= 0.9


def test_forest_of_odd_rows(odd_vectors):
    got = _answers(odd_vectors)
    want = _nearest(_rows(odd_vectors), {20, 40, 60, 80})
    assert {q: [i for i, _ in a] for q, a in got.items()} == {q: [i for i, _ in a] for q, a in want.items()}
    assert forest.search(odd_vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(50)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    nodes = sorted({x for e in edges for x in e if e[0] != e[1]})
    place = {x: i for i, x in enumerate(nodes)}
    label = vectors.forest(len(nodes), np.array([place[a] for a, b in edges if a != b]), np.array([place[b] for a, b in edges if a != b]))
    assert found == {x: nodes[label[i]] for x, i in place.items()}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
