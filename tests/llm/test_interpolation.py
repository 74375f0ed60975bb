"""The interpolated language model against counts and expectation-maximisation by hand."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import kerbside.llm.queries  # noqa: F401  (registration)
from kerbside.llm import interpolation
from kerbside.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.01"


def tokens_of(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [*re.findall("[^\x20\x09-\x0d]+", low), " end"]


def n_grams(tokens, k, order):
    padded = [" start"] * (order - 1) + tokens
    at = order - 1
    return [tuple(padded[at + i - k + 1 : at + i + 1]) for i in range(len(tokens))]


class ByHand:
    def __init__(self, learnt, deleted, order):
        """``learnt`` holds all training texts, ``deleted`` those that weights are fitted on."""
        self.order = order
        self.all, kept = self.counts(learnt), self.counts([t for t in learnt if t not in deleted])
        words = {g[0] for g in self.all[1] if g[0] != " start"}
        self.words, self.tokens = len(words), sum(n for g, n in self.all[1].items() if g[0] != " start")
        kept_tokens = sum(n for g, n in kept[1].items() if g[0] != " start")
        rows = [(self.bucket(kept, t, i), self.estimates(kept, kept_tokens, t, i)[0]) for t in deleted for i in range(len(t))]
        self.weights = self.fitted(rows)

    def counts(self, texts):
        out = {0: Counter()}
        for k in range(1, self.order + 1):
            out[k] = Counter(g for t in texts for g in n_grams(t, k, self.order))
            if k < self.order:
                out[k][(" start",) * k] = len(texts)
        return out

    def context(self, counts, tokens, i, k):
        gram = n_grams(tokens, k, self.order)[i]
        return counts[k - 1][gram[:-1]]

    def bucket(self, counts, tokens, i):
        return min(int(math.frexp(self.context(counts, tokens, i, self.order))[1]), interpolation.BUCKETS - 1) if self.order > 1 else 0

    def estimates(self, counts, total, tokens, i):
        e, d = [1 / (self.words + 1), counts[1][(tokens[i],)] / total if total else 0], [True, total > 0]
        for k in range(2, self.order + 1):
            c = self.context(counts, tokens, i, k)
            e.append(counts[k][n_grams(tokens, k, self.order)[i]] / max(c, 1))
            d.append(c > 0)
        return e, d

    def fitted(self, rows):
        size = self.order + 1
        weights, before = defaultdict(lambda: [1 / size] * size), None
        for _ in range(interpolation.ROUNDS):
            found, log = defaultdict(lambda: [0.0] * size), 0.0
            for b, e in rows:
                parts = [x * y for x, y in zip(weights[b], e)]
                log += math.log(sum(parts))
                found[b] = [f + p / sum(parts) for f, p in zip(found[b], parts)]
            if not rows:
                return weights
            whole = [sum(f[k] for f in found.values()) for k in range(size)]
            norm = lambda f: [(x + interpolation.PRIOR) / (sum(f) + size * interpolation.PRIOR) for x in f]
            weights = defaultdict(lambda w=norm(whole): w, {b: norm(f) for b, f in found.items()})
            log /= len(rows)
            if before is not None and log - before < interpolation.GAIN:
                break
            before = log
        return weights

    def score(self, tokens):
        n, known, base, score = len(tokens), 0, 0.0, 0.0
        for i, token in enumerate(tokens):
            c = self.all[1][(token,)]
            known += c > 0
            base += math.log10((c + 0.5) / (self.tokens + 0.5 * (self.words + 1)))
            e, d = self.estimates(self.all, self.tokens, tokens, i)
            w = self.weights[self.bucket(self.all, tokens, i)]
            score += math.log10(sum(x * y for x, y, z in zip(e, w, d) if z) / sum(y for y, z in zip(w, d) if z))
        return n, known, self.tokens, base, score


def texts(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "cat", "sat", "on", "a", "mat", "ÄB", "x y", "1,2", "rare"]
    return [rng.choice([" ", "\t", "\n"]).join(rng.choices(words, [9, 3, 5, 5, 4, 4, 3, 1, 1, 1, 0.2], k=rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("order, size", [(1, 1 << 22), (2, 1 << 22), (2, 37), (3, 1 << 22), (3, 20)])
def test_scores_equal_those_by_hand(spark, order, size):
    rows = [(i, t) for i, t in enumerate(texts(150, order))] + [(7, "the cat"), (7, "the cat"), (None, "a mat"), (900, None), (901, " \n")]
    rows += [(902, "the cat sat " * 300), (903, "never seen")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({"score": F.lit("x"), "key": F.lit(0), "n": F.lit(1)})
    learns = F.col("doc_id") % 4 != 1
    counted = interpolation.count(df, learns, order=order, size=size, slot=500)
    weights = interpolation.fitted_weights(counted.evidence(), order)
    got = counted.scores(weights, "doc_id").collect()
    mark = F.pmod(F.xxhash64("text", F.lit("deleted")), F.lit(interpolation.DELETED)) == 0
    learnt = [(tokens_of(r.text), r.m) for r in df.where(learns).select("text", mark.alias("m")).collect()]
    model = ByHand([t for t, _ in learnt], [t for t, m in learnt if m], order)
    assert any(m for _, m in learnt)
    want = sorted((str(i), *model.score(tokens_of(t))) for i, t in rows)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9)
    assert np.allclose(weights.table.sum(1), 1) and (weights.table > 0).all()
    assert (np.diff(weights.log_likelihoods) > -1e-3).all()


def test_probabilities_of_all_words_add_up_to_one(spark):
    """After seen, rare and unseen contexts: every known word, the end and one unknown word."""
    learnt = texts(60, 9)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(learnt)], "doc_id long, text string")
    known = sorted({w for t in learnt for w in tokens_of(t)[:-1]})
    for context in ("the", "rare", "unseen"):
        asked = [(1000 + i, f"{context} {w}") for i, w in enumerate([*known, "unknown"])] + [(2000, context), (2001, f"{context} the the")]
        both = df.union(spark.createDataFrame(asked, df.schema))
        counted = interpolation.count(both, F.col("doc_id") < 1000)
        weights = interpolation.fitted_weights(counted.evidence(), 2)
        scored = {r.doc_id: r.score for r in counted.scores(weights, "doc_id").where("doc_id >= 1000").collect()}
        end_alone = scored[2000]  # log P(context) + log P(end | context)
        ends = {w: interpolation_end(counted, weights, w, both) for w in [*known, "unknown"]}
        first = first_token(counted, weights, context, both)
        total = 10 ** (end_alone - first) + sum(10 ** (scored[1000 + i] - first - ends[w]) for i, w in enumerate([*known, "unknown"]))
        assert total == pytest.approx(1, abs=1e-9)


def _counts(both):
    counts, pairs = Counter(), Counter()
    for r in both.where("doc_id < 1000").collect():
        t = tokens_of(r.text)
        counts.update(t)
        counts[" start"] += 1
        pairs.update(zip([" start", *t], t))
    return counts, pairs


def _log(counted, weights, before, word, both):
    counts, pairs = _counts(both)
    c = counts[before]
    w = weights.table[min(math.frexp(c)[1], interpolation.BUCKETS - 1)]
    e = [1 / (counted.words + 1), counts[word] / counted.tokens, pairs[before, word] / max(c, 1)]
    usable = w if c else w[:2]
    return math.log10(sum(a * b for a, b in zip(usable, e)) / sum(usable))


def interpolation_end(counted, weights, word, both):
    return _log(counted, weights, word, " end", both)


def first_token(counted, weights, word, both):
    return _log(counted, weights, " start", word, both)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.score) for r in interpolation.score_texts(df, F.lit(None).cast("boolean")).collect()}
    assert got == {1: (3, 0, 0, 0.0), 2: (1, 0, 0, 0.0)}
    assert interpolation.score_texts(df.limit(0), F.lit(True)).count() == 0
    named = spark.createDataFrame([("x", "a b"), ("y", "a")], "name string, text string")
    assert {r.name for r in interpolation.score_texts(named, F.lit(True), id="name").collect()} == {"x", "y"}


def test_query_counts_and_beats_the_base_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in docs}
    counts = Counter(t for r in docs if not held[r.doc_id] for t in tokens_of(r.text))
    total, words = sum(counts.values()), len(counts)
    rows = {r.doc_id: r for r in QUERIES["op12_lm_scoring"](spark, SMALL).collect()}
    assert rows.keys() == held.keys()
    for r in docs:
        got, tokens = rows[r.doc_id], tokens_of(r.text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (words + 1))) for t in tokens)
        assert (got.held_out, got.n_tokens, got.n_known, got.train_tokens) == (held[r.doc_id], len(tokens), sum(t in counts for t in tokens), total)
        assert got.base_score == pytest.approx(base, rel=1e-9) and got.score < 0
    out = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.05 * sum(r.n_tokens for r in out)
