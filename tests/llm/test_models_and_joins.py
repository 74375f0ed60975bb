"""Language identification, toxicity, top-k, the n-gram join, mixing and the pipeline."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kerbside.llm import components, jaccard, language_id, mixing, topk, toxicity
from kerbside.llm.queries import MIX_TARGETS, language_network, toxicity_model
from kerbside.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.01"
AWKWARD = [(1, None), (2, ""), (3, "12 34"), (4, "the"), (4, "the"), (None, "the words"), (6, "the other word " * 20_000)]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.fixture
def awkward(spark):
    data = [(i, t, None if i == 4 else "en", None, -1, "own") for i, t in AWKWARD]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, score string")


def test_languages_of_held_out_documents(documents, awkward):
    network = language_network(documents)
    rows = language_id.identify(documents, network).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    odd = {(r.doc_id, r.text and r.text[:5]): (r.lang_pred, r.score) for r in language_id.identify(awkward, network).collect()}
    assert len(odd) == len(set(AWKWARD)) and {odd[1, None], odd[2, ""], odd[3, "12 34"]} == {("und", 0.0)}
    kept = language_id.keep_identified(awkward, network, 0.0)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD) - 3


def test_table_lookups_equal_the_convolution(documents):
    network = language_network(documents)
    x = np.frombuffer(b"The quick brown fox, na\xc3\xafve. " * 20, np.uint8)[: 2 * language_id.WINDOW].reshape(2, -1)
    pooled = []
    for f in network.filters:
        e = network.embedding[x]
        width = len(f)
        pooled.append(np.stack([np.tensordot(e[:, i : i + width], f, ([1, 2], [0, 1])) for i in range(x.shape[1] - width + 1)], 1).max(1))
    z = np.maximum(np.concatenate(pooled, 1) + network.bias, 0) @ network.dense + network.dense_bias
    want = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    assert np.allclose(network.probabilities(x, network.tables()), want, atol=1e-4)


def test_hash_bounds_hold_the_smallest_hashes(spark):
    rng = random.Random(5)
    spread = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(5000)]
    repeated = [(1 << 63) - 5] * 4000 + spread[:20]  # one key holds nearly all rows
    rows = [("a", h) for h in spread] + [("b", h) for h in spread[:30]] + [("c", h) for h in repeated]
    last = language_id._last_hashes(spark.createDataFrame(rows, "lang string, h long"), {"a": 5000, "b": 30, "c": 4020}, 50)
    assert last["b"] == last["c"] == (1 << 63) - 1
    held = sorted(h for h in spread if h <= last["a"])
    assert 50 <= len(held) < 400 and held[:50] == sorted(spread)[:50]


def test_nothing_to_learn_a_language_from(awkward):
    assert language_id.fit(awkward.limit(0)) is None
    assert {r.lang_pred for r in language_id.identify(awkward, None).collect()} == {"und"}
    one = language_id.fit(awkward.where("doc_id = 6"))
    assert one.languages == ["en"]


def test_toxic_held_out_documents(documents, labels, awkward):
    model = toxicity_model(documents, labels)
    rows = toxicity.score(documents, model).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == r.toxic for r in held]) >= 0.9
    learnt = [r for r in rows if r.toxic == 1 and r.lang == "en"]
    assert np.mean([r.predicted for r in learnt]) > 0.6
    clean = [r for r in rows if r.toxic == 0]
    assert np.mean([r.predicted for r in clean]) < 0.05
    odd = toxicity.score(awkward, model).collect()
    assert len(odd) == len(AWKWARD) and all(isinstance(r.score, float) and 0 <= r.score <= 1 for r in odd)
    assert toxicity.reject_toxic(awkward, model).columns == awkward.columns


def test_planted_insults_are_learnt(spark):
    rng = random.Random(2)
    word = lambda: rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split())
    docs, marks = [], []
    for i in range(600):
        words, bad = [word() for _ in range(40)], i % 6 == 0
        if bad:
            words[rng.randrange(40)] = rng.choice(["dolt", "oaf"])
        docs.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    d, m = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.fit(d, m.where("doc_id < 400"))
    got = {r.doc_id: r.predicted for r in toxicity.score(d, model).collect()}
    assert all(got[i] == y for i, y in marks)


def test_toxicity_without_two_classes(spark, documents, labels):
    for rows, score in ((labels.limit(0), 0.0), (labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1"), 1.0)):
        model = toxicity.fit(documents, rows)
        assert {r.score for r in toxicity.score(documents.limit(5), model).collect()} == {score}


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(400, 12)) * rng.exponential(size=(400, 1))
    vectors[50:60] = vectors[40:50]  # ties
    data = [(i, v.tolist(), "own") for i, v in enumerate(vectors)]
    odd = [(1000, None), (1050, [float("nan")] * 12), (1100, [None] + [0.0] * 11), (1150, [float("inf")] * 12), (1200, []), (1250, [1.0] * 3), (None, [1.0] * 12)]
    data += [(i, v, "own") for i, v in odd] + data[:3]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, score string").repartition(4)
    whole = np.floor(256 * vectors).astype(int)
    for block in (64, 16_384):
        got = defaultdict(list)
        for r in topk.top_k(df, df.where("vec_id % 50 = 0"), 5, block=block).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.vec_id, r.score))
        want = {}
        for q in range(0, 400, 50):
            scores = whole @ whole[q]
            want[q] = [(int(i), int(scores[i])) for i in sorted((i for i in range(400) if i != q), key=lambda i: (-scores[i], i))[:5]]
        assert dict(got) == want
    few = topk.top_k(df.where("vec_id < 3"), df.where("vec_id = 0"), 5).collect()
    assert len(few) == 2
    assert topk.top_k(df.limit(0), df, 5).count() == 0 == topk.top_k(df, df.limit(0), 5).count()


def test_large_components_keep_whole_scores(spark):
    df = spark.createDataFrame([(0, [3.0e9, 1.0]), (50, [3.0e9, 2.0]), (51, [-1.0, 5.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id = 0"), 2).orderBy("rank").collect()]
    a, b, c = ([256 * 3_000_000_000, 256], [256 * 3_000_000_000, 512], [-256, 1280])
    cut = lambda s: max(min(s, 2**63 - 1), -(2**63))
    assert got == [(0, 1, 50, cut(a[0] * b[0] + a[1] * b[1])), (0, 2, 51, a[0] * c[0] + a[1] * c[1])]


def brute_components(rows, size=4, least=(85, 100)):
    """Sets and components by comparing all pairs."""
    lower, sets = {c: c + 32 for c in range(65, 91)}, []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and least[1] * len(sets[a] & sets[b]) >= least[0] * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    smallest = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            smallest[find(i)] = min(smallest.get(find(i), id_), id_)
    return sorted(((id_, len(s), smallest.get(find(i))) for i, ((id_, _), s) in enumerate(zip(rows, sets))), key=str)


def near_copies(rng, groups=6, copies=40):
    rows = []
    for g in range(groups):
        words = [f"w{rng.randrange(10_000)}" for _ in range(rng.choice([4, 12, 60, 300]))]
        for _ in range(copies):
            other = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                other[rng.randrange(len(other))] = f"x{rng.randrange(10_000)}"
            rows.append((len(rows) * 3 % 1009, " ".join(other)))
    passage = " ".join(f"p{i}" for i in range(80))
    rows += [(2000 + i, passage + " " + " ".join(f"q{i}x{j}" for j in range(i % 30))) for i in range(120)]
    return rows + [(3000, None), (3001, ""), (3002, " \n"), (3003, "One two"), (3004, "one TWO"), (None, "one two"), (3005, "ÀB ÀB"), (3006, "àb àb"), (3007, "a b")]


@pytest.mark.parametrize("block", [16, 2_048])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "LIST_BLOCK", block)
    rows = near_copies(random.Random(block))
    df = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, sid string").repartition(6)
    got = sorted((tuple(r) for r in jaccard.similar_classes(df).collect()), key=str)
    assert got == brute_components(rows)
    none = sorted((tuple(r) for r in jaccard.similar_classes(df, frequent=0).collect()), key=str)
    assert none == got
    assert jaccard.similar_classes(df.limit(0)).count() == 0


def test_components_of_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.limit(400).collect()]
    got = sorted((tuple(r) for r in jaccard.similar_classes(documents.limit(400), shingle=5, least=(80, 100)).collect()), key=str)
    assert got == brute_components(rows, 5, (80, 100))


def test_one_of_each_group_stays(spark, awkward):
    kept = jaccard.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 3, 4, 6, None]


def test_repeated_ids_lose_no_other_text(spark):
    alpha, beta, gamma = (" ".join(f"{w}{i}" for i in range(30)) for w in "abc")
    rows = [(1, alpha), (1, beta), (2, beta), (2, gamma), (2, gamma), (3, alpha + " more"), (4, None), (4, ""), (4, "  "), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    kept = [tuple(r) for r in jaccard.one_of_each(docs).collect()]
    assert sorted((i, t or "") for i, t in kept) == sorted([(1, alpha), (1, beta), (2, gamma), (4, ""), (4, "  "), (5, "")])
    assert jaccard.one_of_each(docs.where("doc_id > 7")).collect() == []


def test_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100}


def test_raking_meets_all_marginals():
    rng = random.Random(1)
    tokens = {(s, l, t): rng.randrange(1, 1000) for s in "abc" for l in ("en", "fr") for t in ("x", "y")}
    targets = {"source": {"a": 0.2, "b": 0.3, "c": 0.5}, "lang": {"en": 0.6, "fr": 0.4}, "topic": {"x": 0.9, "y": 0.1}}
    shares = mixing.fit_cells(tokens, targets)
    for axis, name in enumerate(mixing.AXES):
        for category, goal in targets[name].items():
            assert sum(v for c, v in shares.items() if c[axis] == category) == pytest.approx(goal, abs=1e-8)
    odds = {c: shares[c] / tokens[c] for c in tokens}  # raking keeps cross ratios
    first = odds["a", "en", "x"] * odds["b", "fr", "x"] / (odds["a", "fr", "x"] * odds["b", "en", "x"])
    assert first == pytest.approx(1.0, rel=1e-6)
    p = mixing.probabilities(tokens, shares)
    assert max(p.values()) == pytest.approx(1.0)
    budget = mixing.probabilities(tokens, shares, 0.4)
    assert sum(budget[c] * tokens[c] for c in tokens) == pytest.approx(0.4 * sum(tokens.values()))
    assert set(mixing.probabilities(tokens, shares, 1.0).values()) == {1.0}
    assert mixing.fit_cells({}, targets) == {} == mixing.fit_cells({("a", "en", "x"): 0}, targets)


def test_the_sample_has_the_target_weights(spark):
    rng = random.Random(4)
    data = [(i, " ".join("w" for _ in range(rng.randrange(1, 60))), rng.choice(["en", "en", "en", "fr", None]), "s0" if i % 3 else f"s{i % 7}") for i in range(20_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    targets = {"source": {"s0": 0.6, "s1": 0.1, "other": 0.3}, "lang": {"en": 0.5, "fr": 0.3, "other": 0.2}, "topic": {"prose": 1.0}}
    rows = mixing.mix(docs, targets, 0.2).collect()
    kept = [r for r in rows if r.mix_kept]
    total = sum(r.mix_tokens for r in kept)
    assert total / sum(r.mix_tokens for r in rows) == pytest.approx(0.2, abs=0.01)
    for column, name in (("mix_source", "source"), ("mix_lang", "lang")):
        for category, goal in targets[name].items():
            assert sum(r.mix_tokens for r in kept if r[column] == category) / total == pytest.approx(goal, abs=0.02)


def test_mixing_awkward_rows(awkward):
    clashing = awkward.withColumn("mix_kept", F.lit("own"))
    assert mixing.mix(clashing, MIX_TARGETS).count() == len(AWKWARD)
    assert mixing.sample(clashing, MIX_TARGETS, 1.0).columns == clashing.columns
    assert mixing.sample(clashing.limit(0), MIX_TARGETS).count() == 0
    empty = mixing.sample(awkward.where("doc_id IN (1, 2)"), MIX_TARGETS)
    assert empty.count() == 2  # nothing has tokens


def test_topics(spark):
    texts = ["plain words", "a | b", "write to me@x.org", "under this License", "call 12345", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.topic_of(F.coalesce("text", F.lit("")))).collect()]
    assert got == ["prose", "tabular", "contact", "licensing", "numeric", "prose"]


def test_every_stage_takes_awkward_and_empty_rows(spark, awkward):
    for docs in (awkward.drop("score"), awkward.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert name == "bpe" or out.columns == docs.columns
            assert out.count() <= docs.count()


def test_pipeline_equals_its_stages_by_hand(spark, documents, labels):
    """The kept documents by the operators' plain rows and brute-force groups."""
    rows = QUERIES["pipeline"](spark, SMALL).collect()
    toxic = {r.doc_id for r in toxicity.score(documents, toxicity_model(documents, labels)).where("predicted = 1").collect()}
    left = documents.where(~F.col("doc_id").isin(toxic))
    sure = language_id.identify(left, language_network(left)).where(f"lang_pred <> 'und' AND score >= {corpus_pipeline.LEAST_LANGUAGE_SCORE}")
    told = [(r.doc_id, r.text) for r in sure.select("doc_id", "text").collect()]
    single = [i for i, _, c in brute_components(told, 5, (80, 100)) if i == c]
    assert len(single) < len(told) < documents.count()
    mixed = mixing.mix(documents.where(F.col("doc_id").isin(single)), MIX_TARGETS, 0.5).where("mix_kept")
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in mixed.collect())
    assert all(r.round_trip and len(r.ids) == 4 * r.n_tokens for r in rows)


def test_queries_cover_their_tables(spark, documents):
    n = documents.count()
    for name, table in (("op2_token_count", n), ("op5_bpe_round_trip", n), ("op8_fingerprints", n), ("op9_ngram_jaccard", n), ("op10_source_mixing", n)):
        assert QUERIES[name](spark, SMALL).count() == table


def test_pairs_of_words_are_sent_as_lines(spark):
    rows = [(0, "b a b a"), (0, "a b"), (1, "A b"), (1, ""), (0, "é_1 é_1")] + [(0, f"u{i} v{i}") for i in range(300)]
    texts = spark.createDataFrame([(t.encode(), y, True) for y, t in rows], "text binary, toxic int, learns boolean").repartition(2)
    pairs = toxicity._pair_counts(texts)
    got = {(r.v, r.w): (r.n0, r.n1) for r in pairs.collect()}
    want = defaultdict(lambda: [0, 0])
    for y, t in rows:
        found = ["", *t.lower().split()]
        for pair in set(zip(found, found[1:])):
            want[pair][y] += 1
    assert got == {k: tuple(n) for k, n in want.items()}
    sent = toxicity._pair_lines(texts).agg(F.count("*"), F.max(F.size(F.split("pairs", "\n")))).first()
    assert sent[0] < len(want) and sent[1] > 1


def test_only_pairs_that_tell_fetch_their_sets(spark, monkeypatch):
    given = {}

    def verified(pairs, sets, least, label, real=jaccard._verified):
        given[label] = pairs.count()
        return real(pairs, sets, least, label)

    monkeypatch.setattr(jaccard, "_verified", verified)
    text = lambda *spans: " ".join(f"{c}{i}" for c, n in spans for i in range(n))
    equal = [(i, text(("e", 50))) for i in range(12)]  # in several tasks
    partly = [(20, text(("p", 1_600), ("q", 250))), (21, text(("p", 1_600), ("r", 250)))]  # share 0.76
    near = [(30 + i, text(("n", 400), (f"s{i}x", 1 + i))) for i in range(9)]
    rows = equal + partly + near
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted((tuple(r) for r in jaccard.similar_classes(df, frequent=0).collect()), key=str) == brute_components(rows)
    assert given == {"nearest": len(near) - 1, "rest": 0}


def test_marked_rows_are_those_of_the_nodes(spark):
    numbers = [(p << 33) + i for p in (0, 1, 3) for i in (1, 8, 9, 32_767, 32_768, 32_769, 70_000)]
    table = spark.createDataFrame([(n, str(n)) for n in numbers] + [(None, "none")], "node long, tokens string")
    chosen = spark.createDataFrame([(n,) for n in numbers[::2] * 2] + [(None,)], "node long")
    assert sorted(r.node for r in jaccard._marked(table, chosen).collect()) == sorted(numbers[::2])
    assert jaccard._marked(table, chosen.limit(0)).count() == 0
