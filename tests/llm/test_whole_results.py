"""Places where an operator once did less than its whole job."""

import random

import numpy as np
import pytest

from test_models_and_joins import brute_components

from kerbside.llm import jaccard, toxicity


@pytest.mark.parametrize("least", [(85, 100), (80, 100), (1, 2), (99, 100)])
def test_the_largest_difference_of_linked_sets(least):
    for n in range(1, 300):
        partners = range(-(-least[0] * n // least[1]), n + 1)
        allowed = max(n + m - 2 * jaccard.least_overlap(n, m, least) for m in partners)
        assert jaccard.most_difference(n, least) >= allowed


@pytest.mark.parametrize("least, size", [((80, 100), 15), ((85, 100), 20)])
def test_links_at_the_threshold_in_long_lists(spark, least, size):
    rng = random.Random(size)
    # Words in the order of their hashes, which is the order of sets where no frequent shingles are known.
    hash_of = lambda w: int(jaccard.unpacked(jaccard.packed(jaccard.shingles(w.encode(), 1, jaccard._WordHashes())))[0])
    words = sorted((f"w{i}" for i in range(4_000)), key=hash_of)
    shared, others = words[:5], words[5:]  # the first five words of all sets fill their prefixes
    rng.shuffle(others)
    take = lambda n: [others.pop() for _ in range(n)]
    core = take(size - 7)
    sets = [[*core, *take(1)], [*core, *take(2)]]  # size - 1 and size words with the shared ones, size - 2 in common
    sets += [take(size - 5 + i % 5) for i in range(2 * jaccard.SKIP)]
    for _ in range(8):
        n = size + 1 + rng.randrange(6)
        both = jaccard.least_overlap(n, n - 1, least)
        common = take(both - 5)
        sets += [[*common, *take(n - both)], [*common, *take(n - 1 - both)]]
    rows = [(i, " ".join([*shared, *s])) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in jaccard.similar_classes(df, shingle=1, least=least, frequent=0).collect()), key=str)
    assert got == brute_components(rows, 1, least)
    assert {r[0]: r[2] for r in got}[1] == 0
    assert len(np.unique([r[2] for r in got])) == len(rows) - 9


def test_counts_learn_from_all_labelled_rows(spark):
    rng = random.Random(4)
    insults = [f"insult{i}" for i in range(10)]
    docs, marks = [], []
    for i in range(1_000):
        words, bad = [f"w{rng.randrange(12)}" for _ in range(30)], i % 5 == 0
        if bad:
            words[rng.randrange(1, 30)] = insults[i // 5 % 10]
        docs.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    d, m = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.fit(d, m, rows=(60, 12))
    assert set(insults) <= set(model.vocabulary)
    got = {r.doc_id: r.predicted for r in toxicity.score(d, model).collect()}
    assert all(got[i] == y for i, y in marks)
