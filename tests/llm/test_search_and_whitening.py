"""Whitening against a dense eigensolver, ranked search against brute force, and their odd inputs."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import kerbside.llm.queries  # noqa: F401  (registration)
from kerbside.llm import lexical_search, whitening
from kerbside.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.01"


def whitened_densely(vectors, components=8):
    x = np.floor(np.array(vectors, np.float64) * 1024) + 100_000
    n, total = len(x), x.sum(0)
    c = x - total / n
    values, u = np.linalg.eigh(c.T @ c / n)
    values, u = values[::-1][:components], u[:, ::-1][:, :components]
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total)) for row in x]
    return n, exact, c @ u / np.sqrt(values), values / np.trace(c.T @ c / n)


def assert_whitened(rows, vectors, ids, components=8):
    n, exact, want, explained = whitened_densely(vectors, components)
    got = np.full(want.shape, np.nan)
    at = {i: r for r, i in enumerate(ids)}
    for r in rows:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == exact[at[r.vec_id]] and r.identity_error < 1e-10
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-10
    sign = np.sign((got * want).sum(0))
    assert np.abs(got - want * sign).max() < 1e-7 * np.abs(want).max()
    assert len(rows) == want.size


def test_whitening_query_equals_a_dense_solver(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    rows = QUERIES["op11_embedding_whitening"](spark, SMALL).collect()
    assert_whitened(rows, [r.embedding for r in table], [r.vec_id for r in table])


@pytest.mark.parametrize("size, spectrum", [(40, "close"), (40, "falling"), (90, "many"), (5, "falling")])
def test_leading_pairs_of_awkward_spectra(size, spectrum):
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
    i = np.arange(size)
    values = {"close": 1 + 1e-5 * i, "falling": 10.0**-i, "many": np.where(i < 12, 2.0, 1.0)}[spectrum]
    matrix = (turn * values) @ turn.T
    pairs = whitening.leading_pairs(lambda b: matrix @ b, size, 8)
    want = np.sort(values)[::-1][:8]
    assert np.abs(pairs.values - want).max() < 1e-13 * want[0] and (np.diff(pairs.values) <= 1e-14 * want[0]).all()
    assert np.abs(matrix @ pairs.vectors - pairs.vectors * pairs.values).max() < 1e-13 * want[0]
    assert np.abs(pairs.vectors.T @ pairs.vectors - np.eye(len(want))).max() < 1e-13


def test_minres_solves_indefinite_systems_with_their_own_shifts():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((30, 30))
    a, shifts, right = a + a.T, np.array([0.3, -2.0]), rng.standard_normal((30, 2))
    x = whitening.minres(lambda v: a @ v - shifts * v, right, 200, 1e-13)
    assert np.abs(a @ x - shifts * x - right).max() < 1e-9


def test_odd_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [0.5, 1.0, -2.0]), (1, [0.25, 1.0, 3.0]), (None, [1.5, -1.0, 0.0]), (4, [0.5, 1.0, -2.0]), (5, None), (6, []), (7, [1.0, None, 0.0])]
    data += [(8, [nan, 0.0, 0.0]), (9, [inf, 0.0, 0.0]), (10, [7.0]), (11, [1.0, 2.0]), (12, [2.0, 2.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumns({"n": F.lit("x"), "x": F.lit(1), "id": F.lit(2)})
    rows = whitening.whiten(df).collect()
    three = [r for r in rows if r.n == 4]
    assert sorted({r.component for r in three}) == [1, 2] and len(three) == 8  # three different points span a plane
    two = [r for r in rows if r.n == 2]
    assert {(r.vec_id, r.component, round(abs(r.whitened), 9), r.explained) for r in two} == {(11, 1, 1.0, 1.0), (12, 1, 1.0, 1.0)}
    assert len(rows) == 10  # the one vector of length 1 has no variance
    assert whitening.whiten(df.limit(0)).count() == 0
    far = spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 1e30])], "vec_id long, embedding array<double>")
    rows = whitening.whiten(far).collect()
    assert len(rows) == 6 and all(math.isfinite(r.whitened) and 0 < r.deviation <= (1 << 63) - 1 for r in rows)


def test_partial_sums_are_added_in_groups(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 3)
    df = spark.range(1000).repartition(40).select(F.array(F.col("id")).alias("x"))
    whitening.ship(spark)
    got = whitening.block_of(df, 40, lambda b: np.array([[sum(v[0] for v in b.column(0).to_pylist())]], float), (1, 1))
    assert got[0, 0] == 999 * 500


def searched(docs, items, k=10):
    """Brute force over ``(id, text)`` lists."""
    word = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: word.findall((t or "").translate(low))
    bags = [(i, split(t)) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(len(b) for _, b in bags)
    out = []
    for item, text in items:
        hits = []
        for i, bag in bags:
            m, score = 10 + (90 * len(bag) * n) // total, 0
            for t in set(split(text)):
                tf, df = bag.count(t), sum(t in b for _, b in bags)
                if tf:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                hits.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(hits, key=lambda h: (h[0], h[1], h[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def test_search_equals_brute_force_with_copies_and_odd_rows(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["ÀB", "x_y", "Z9", "日本"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 12))) for _ in range(60)]
    docs = [(i, rng.choice(texts)) for i in range(300)] + [(i, texts[0]) for i in range(900, 1000)]  # one large class
    docs += [(5, texts[3]), (None, texts[0]), (None, texts[1]), (2000, None), (2001, ""), (2002, "!? _"), (2003, "W1 w2-" * 30_000)]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(vocabulary, k=4))) for i in range(12)] + [(50, None), (51, "absent"), (52, texts[0]), (52, texts[0])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumns({"n": F.lit(1), "m": F.lit(1), "bag": F.lit("b")})
    asked = spark.createDataFrame([*items, (None, texts[0])], "item_id long, text string").withColumn("item", F.lit(1))
    want = searched(docs, items[:-1])
    assert rows_of(lexical_search.search(frame, asked)) == want
    monkeypatch.setattr(lexical_search, "TERMS", 9)  # several blocks of items
    monkeypatch.setattr(lexical_search, "CELLS", 7)
    assert rows_of(lexical_search.search(frame, asked)) == want
    assert lexical_search.search(frame.limit(0), asked).count() == 0
    assert lexical_search.search(frame, asked.limit(0)).count() == 0


def test_equal_hashes_do_not_join_bags(spark):
    """Classes are grouped by the whole bag beside its hash."""
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "b a"), (4, "a a b")], "doc_id long, text string")
    bagged = lexical_search.bags(docs, {b"a": 0, b"b": 1}, "doc_id", "text")
    kinds = {bytes(r.bag): r.n for r in bagged.groupBy("bag").agg(F.count("*").alias("n")).collect()}
    assert sorted(kinds.values()) == [1, 3]


def test_scores_beyond_doubles_stay_exact():
    scorer = lexical_search.Scorer([frozenset({0, 1})], np.array([1 << 40, 3]))
    bag = np.array([0, 5, 1, 7], "<u4").tobytes()
    want = (1 << 40) * (5_000_000_000 // (5000 + 800)) + 3 * (7_000_000_000 // (7000 + 800))
    assert scorer.scores([bag], np.array([100]))[0, 0] == want
