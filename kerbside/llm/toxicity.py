"""Toxicity by two class-conditional Kneser-Ney bigram models.

A class's probability of a word is its discounted continuation count (how many different words the word follows) and
backs off to the continuation counts of both classes together. After a given word, what discounting leaves of the pairs
(counted once a text) is split between the classes, drawn towards the split that both share, and interpolated with the
probability of the word alone, with one backoff weight for both classes. So expressions that were seen a few times only
have shared counts left in either class and say nothing, while one that many contexts of one class share says much.

A text's features are length-normalised log-likelihood differences, toxic less ordinary: of the whole text, of its
strongest pair of neighbouring words and of its strongest word. A logistic curve over them, fitted on labelled rows that
the counts have not seen, gives the score. The counts come from all labelled rows but those of the curve. One in
CALIBRATION texts is for the curve, up to ``rows[y]`` of class y (those with the smallest hashes, a documented bound).
Every text is scored whole. Words and pairs that discounting leaves are gathered in one model, which grows with them.

Defined results: null counts as the empty text, which gets the score of a text without evidence. An id with several
labels is toxic if one of them says so; labels or ids that are null teach nothing. Equal texts are learnt from once. If
only one class has labels, every score is 0 (only ordinary, or none) or 1 (only toxic). Columns are kept; those with a
result's name are replaced.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from functools import reduce
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.common import annotate, fresh, give_back, ship, utf8
from kerbside.session import broadcast_if_small, stored

TOXIC_ROWS, ORDINARY_ROWS = 4_000, 12_000  # for the logistic curve
DISCOUNT = 2.0  # of continuation counts
PAIR_DISCOUNT = 8.0
SHARED = 50.0  # texts' weight of the shared split of pairs
CALIBRATION = 4  # every so many-th labelled text is kept for the logistic curve, as far as its bound goes

_WORDS = re.compile(r"\w+").findall


def words(text: bytes) -> list[str]:
    return _WORDS(text.decode().lower())


@dataclass
class Model:
    """Log-likelihood differences of known words and pairs, and the logistic curve."""

    constant: float | None = None  # the score of every text, where there is nothing to tell classes apart
    vocabulary: dict[str, int] = field(default_factory=dict)
    word: np.ndarray | None = None  # 0 is any unknown word
    pair_keys: np.ndarray | None = None
    pair: np.ndarray | None = None
    weights: np.ndarray | None = None  # of the features, and the intercept

    def differences(self, text: bytes) -> np.ndarray:
        """The log-likelihood difference of each word, given the word before it."""
        found = words(text)
        ids = np.fromiter(map(self.vocabulary.get, found, repeat(0)), np.int64, len(found))
        before = np.concatenate([[0], ids[:-1]]) if len(ids) else ids
        out = self.word[ids]
        if len(self.pair_keys) and len(ids):
            keys = before * len(self.word) + ids
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            known = self.pair_keys[at] == keys
            out[known] = self.pair[at[known]]
        return out

    def features(self, text: bytes) -> tuple[float, float, float]:
        d = self.differences(text)
        if not len(d):
            return 0.0, 0.0, 0.0
        return float(d.mean()), float(((d[1:] + d[:-1]) / 2).max() if len(d) > 1 else d[0]), float(d.max())

    def score(self, text: bytes) -> float:
        if self.constant is not None:
            return self.constant
        z = float(np.dot(self.weights[:-1], self.features(text)) + self.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _sample(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, rows: tuple[int, int]) -> DataFrame:
    """``(text, toxic, learns)``: the labelled texts, and whether the counts or the curve learn from them."""
    known = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("toxic"))
    known = known.where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col(f"`{id}`").alias("id"), utf8(text).alias("text"))
    texts = texts.join(broadcast_if_small(stored(known, "toxicity-labels")), "id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    hashed = F.xxhash64("text")
    texts = stored(texts.withColumn("h", F.when(F.pmod(hashed, F.lit(CALIBRATION)) == 0, hashed)), "toxicity-texts")
    last = {}  # the largest hash of each class that the curve takes
    for y in (0, 1):
        curve = texts.where((F.col("toxic") == y) & F.col("h").isNotNull()).select("h").orderBy("h").limit(rows[y])
        last[y] = curve.agg(F.max("h")).collect()[0][0]
    taken = [(F.col("toxic") == y) & (F.col("h") <= h) for y, h in last.items() if h is not None]
    curve = reduce(lambda a, b: a | b, taken, F.lit(False))
    return texts.select("text", "toxic", (~F.coalesce(curve, F.lit(False))).alias("learns"))


def _pair_lines(sample: DataFrame) -> DataFrame:
    """``(bucket, toxic, n, pairs)``: lines of pairs of neighbouring words that n of a task's texts of a class have.

    Many lines in a row take less than half the room of a row for each pair. A bucket is a hash of both words, so that a
    frequent word is in all of them.
    """
    ship(sample.sparkSession)
    buckets = 4 * int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(batches):
        counts = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = ["", *words(text)]
                counts[toxic > 0].update(set(map(" ".join, zip(found, found[1:]))))  # no word has a space
                if len(counts[0]) + len(counts[1]) > 500_000:
                    yield from rows(counts)
                    counts = Counter(), Counter()
        yield from rows(counts)
        del counts
        give_back()

    def rows(counts):
        lines = defaultdict(list)
        for toxic, counted in enumerate(counts):
            for pair, n in counted.items():
                lines[crc32(pair.encode()) % buckets, toxic, n].append(pair)
        keys = list(lines)
        for begin in range(0, len(keys), 1_000):
            part = keys[begin : begin + 1_000]
            columns = [pa.array(c, k) for c, k in zip(zip(*part), (pa.int32(), pa.int32(), pa.int64()))]
            columns.append(pa.array(["\n".join(sorted(lines.pop(k))) for k in part], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "toxic", "n", "pairs"])

    return sample.where("learns").select("text", "toxic").mapInArrow(count, "bucket int, toxic int, n long, pairs string")


def _pair_counts(sample: DataFrame) -> DataFrame:
    """``(v, w, n0, n1)``: in how many texts of either class w follows v; v is empty at the start of a text."""
    single = _pair_lines(sample).repartition("bucket").select("bucket", "toxic", "n", F.explode(F.split("pairs", "\n")).alias("pair"))
    of = lambda y: F.sum(F.when(F.col("toxic") == y, F.col("n")).otherwise(0)).alias(f"n{y}")
    pairs = single.groupBy("bucket", "pair").agg(of(0), of(1))
    part = lambda i: F.substring_index("pair", " ", i)
    return pairs.select(part(1).alias("v"), part(-1).alias("w"), "n0", "n1")


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    rows: tuple[int, int] = (ORDINARY_ROWS, TOXIC_ROWS), discount: float = DISCOUNT,
) -> Model:
    """Fits both models and the curve on all labelled rows. The words and pairs that tell reach the driver."""
    sample = _sample(docs, labels, id, text, label, rows)
    sizes = {(r.toxic, r.learns): r.n for r in sample.groupBy("toxic", "learns").agg(F.count("*").alias("n")).collect()}
    classes = {y for y, _ in sizes}
    if classes != {0, 1}:
        return Model(constant=1.0 if classes == {1} else 0.0)
    if not sizes.get((0, True)) or not sizes.get((1, True)):  # too few rows to keep some back
        sample = sample.withColumn("learns", F.lit(True))
    pairs = stored(_pair_counts(sample), "toxicity-pairs")
    cut = lambda c: F.least(F.col(c), F.lit(discount))
    by_word = pairs.groupBy("w").agg(
        F.sum((F.col("n0") > 0).cast("long")).alias("c0"), F.sum((F.col("n1") > 0).cast("long")).alias("c1"), F.count("*").alias("p")
    )
    by_word = stored(by_word, "toxicity-words")
    sums = by_word.agg(F.sum("c0"), F.sum("c1"), F.sum("p"), F.sum(cut("c0")), F.sum(cut("c1"))).collect()[0]
    if not sums[0] or not sums[1]:
        return Model(constant=0.0)
    total, everything, lam = sums[0:2], sums[2], (sums[3] / sums[0], sums[4] / sums[1])
    telling = by_word.where((F.col("c0") > discount) | (F.col("c1") > discount)).orderBy("w").toArrow()
    vocabulary = {w: i + 1 for i, w in enumerate(telling["w"].to_pylist())}
    number = lambda c: np.asarray(telling[c], float)
    p = np.column_stack(
        [lam[y] * number("p") / everything + np.maximum(number(f"c{y}") - discount, 0) / total[y] for y in (0, 1)]
    )
    word = np.concatenate([[np.log(lam[1] / lam[0])], np.log(p[:, 1] / p[:, 0])])
    order, values = _telling_pairs(pairs, vocabulary, p, word)
    model = Model(None, vocabulary, word, order, values)
    share = labels.where(F.col(f"`{label}`").isNotNull()).agg(F.avg((F.col(f"`{label}`") > 0).cast("double"))).collect()[0][0]
    model.weights = _curve(model, sample, share)
    return model


def _telling_pairs(pairs: DataFrame, vocabulary: dict[str, int], p: np.ndarray, word: np.ndarray):
    """Sorted keys of pairs that discounting leaves, and their log-likelihood differences."""
    contexts = pairs.withColumn("n", F.col("n0") + F.col("n1")).groupBy("v").agg(F.sum("n").alias("all"), F.max("n").alias("most"))
    kept = pairs.where(F.col("n0") + F.col("n1") > PAIR_DISCOUNT).join(contexts.where(F.col("most") > PAIR_DISCOUNT), "v")
    rows = kept.select("v", "w", "n0", "n1", "all").toArrow()
    if not rows.num_rows:
        return np.zeros(0, np.int64), np.zeros(0)
    n = np.column_stack([np.asarray(rows[c], float) for c in ("n0", "n1")])
    m = n * (1 - PAIR_DISCOUNT / n.sum(1))[:, None]
    context = np.asarray(rows["v"].combine_chunks().dictionary_encode().indices, np.int64)
    mass = np.column_stack([np.bincount(context, m[:, y])[context] for y in (0, 1)])  # what discounting leaves of a context
    v, w = (np.fromiter(map(vocabulary.get, rows[c].to_pylist(), repeat(0)), np.int64, rows.num_rows) for c in ("v", "w"))
    ok = (v > 0) & (w > 0)
    v, w, m, mass, whole = v[ok], w[ok], m[ok], mass[ok], np.asarray(rows["all"], float)[ok]
    shared = m.sum(1) / mass.sum(1)
    own = (m + SHARED * shared[:, None]) / (mass + SHARED)
    back = (1 - mass.sum(1) / whole)[:, None]
    q = (1 - back) * own + back * p[w - 1]
    keys = v * len(word) + w
    order = np.argsort(keys)
    return keys[order], np.log(q[:, 1] / q[:, 0])[order]


def _curve(model: Model, sample: DataFrame, share: float) -> np.ndarray:
    """Weights of the logistic curve, for classes in the shares that the labels have."""
    kept = sample.where(~F.col("learns"))
    if {r[0] for r in kept.select("toxic").distinct().collect()} != {0, 1}:
        kept = sample

    def make():
        return lambda values: list(zip(*[model.features(v) for v in values]))

    rows = annotate(kept, F.col("text"), make, "f0 double, f1 double, f2 double", done=give_back).select("f0", "f1", "f2", "toxic").collect()
    x, y = np.array([r[:3] for r in rows], float), np.array([r[3] for r in rows], float)
    middle, spread = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([(x - middle) / spread, np.ones(len(x))])
    balance = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    w, use = np.zeros(4), np.ones(4, bool)
    ridge = np.array([0.02, 0.02, 0.02, 1e-4])
    for _ in range(100):  # Newton; evidence can't count against toxicity, so a feature with a negative weight is left out
        prob = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = (a.T @ (balance * (prob - y)) + ridge * w)[use]
        curvature = ((a * (balance * prob * (1 - prob))[:, None]).T @ a + np.diag(ridge))[np.ix_(use, use)]
        step = np.linalg.solve(curvature, gradient)
        w[use] -= step
        if np.abs(step).max() < 1e-9:
            if (w[:3] >= 0).all():
                break
            use[:3] &= w[:3] >= 0
            w = np.where(use, w, 0.0)
    return np.append(w[:3] / spread, w[3] - (w[:3] * middle / spread).sum())


def score(docs: DataFrame, model: Model, text: str = "text", prefix: str = "") -> DataFrame:
    """Adds score (0 to 1) and predicted (1 if score >= 0.5) to every row."""

    def make():
        def work(values):
            scores = [model.score(v) for v in values]
            return scores, [int(s >= 0.5) for s in scores]

        return work

    return annotate(docs, utf8(text), make, "score double, predicted int", prefix, give_back)


def reject_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose text isn't predicted toxic, with the columns of ``docs``."""
    prefix = fresh("toxicity_", [c[: len("toxicity_")] for c in docs.columns])
    return score(docs, model, text, prefix).where(F.col(f"{prefix}predicted") == 0).select(*[f"`{c}`" for c in docs.columns])
