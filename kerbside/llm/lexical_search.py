"""Ranked lexical search over bags of terms, each kind of bag scored once.

A document's score for an item is a sum over the item's terms, of which only the document's counts of these terms and its
length class m matter. One pass over the texts keeps just that: the length and the counts of terms of the items' vocabulary.
Bags that are identical, m included, form a class: rows are grouped by the bag's hash together with the bag itself, so equal
hashes alone never join two bags, and copies fold together before the shuffle. Each class is scored once. A task keeps the k
best classes of every item, by score and then by their smallest id; that suffices, as each class ranked before a document's
own holds a document that ranks before it. Only the members of winning classes are then listed, by ascending id, k for each
class at most, and ranked.

Items are searched in blocks of at most TERMS terms together, one pass over the texts for each block, so that what tasks and
driver hold of the items is bounded.

Defined results: a null text, or one without terms, is no document and ranks nowhere. Rows are documents of their own, also
where they share an id or have none; a null id comes after all others. Items without text, or whose terms no document
holds, return nothing, and so do items without an id. Of items with one id each is searched as if it were alone and the
results are kept side by side, once where they are equal.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kerbside.llm.common import ship, slices, utf8
from kerbside.session import broadcast_if_small, stored

TERMS = 200_000  # of a block's items, each item's distinct terms counted, but for one item that has more by itself
ITEMS = 2_000  # items in a block at most
CELLS = 1 << 20  # scores, or gains of terms, that a task holds at a time
_TERMS = re.compile(rb"[0-9a-z\x80-\xff]+").findall  # in UTF-8: letters and digits of ASCII, and all beyond ASCII
_LAST = (1 << 63) - 1  # in place of a null id


def terms(text: bytes) -> list[bytes]:
    return _TERMS(text.lower())  # bytes.lower changes A-Z only


def item_blocks(items: DataFrame, id: str, text: str) -> Iterator[list[tuple]]:
    """Lists of ``(id, terms)`` of bounded size, streamed to the driver a partition at a time."""
    block, held = [], 0
    chosen = items.where(F.col(f"`{id}`").isNotNull()).select(F.col(f"`{id}`").alias("id"), utf8(text).alias("text")).distinct()
    for row in chosen.toLocalIterator():
        own = frozenset(terms(bytes(row.text)))
        if block and (held + len(own) > TERMS or len(block) >= ITEMS):
            yield block
            block, held = [], 0
        block.append((row.id, own))
        held += len(own)
    if block:
        yield block


def bags(docs: DataFrame, vocabulary: dict[bytes, int], id: str, text: str) -> DataFrame:
    """``(id, n, bag)`` of every row with a term: its number of terms, and its counts of vocabulary terms as bytes.

    A bag is a sequence of pairs of 32-bit integers, term and count, by ascending term.
    """
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)  # TERMS at most, or one item's

    def run(batches):
        lookup = known.value.get
        for batch in batches:
            for part in slices(batch, 0):
                lengths, packed, keep = [], [], []
                for i, value in enumerate(part.column(0).to_pylist()):
                    found = terms(value)
                    if not found:
                        continue
                    counted = Counter(map(lookup, found))
                    counted.pop(None, None)
                    keep.append(i)
                    lengths.append(len(found))
                    packed.append(np.array(sorted(counted.items()), "<u4").tobytes())
                arrays = [part.column(1).take(pa.array(keep, pa.int32())), pa.array(lengths, pa.int64()), pa.array(packed, pa.binary())]
                yield pa.record_batch(arrays, names=["id", "n", "bag"])

    texts = docs.select(utf8(text).alias("text"), F.col(f"`{id}`").cast("long").alias("id"))
    return texts.mapInArrow(run, "id long, n long, bag binary")


def document_counts(bagged: DataFrame, size: int) -> np.ndarray:
    """In how many rows each of ``size`` terms occurs: tasks count in arrays, the cluster adds them up."""

    def run(batches):
        held = np.zeros(size, np.int64)
        for batch in batches:
            for bag in batch.column(0).to_pylist():
                held[np.frombuffer(bag, "<u4")[::2]] += 1
        at = np.flatnonzero(held)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(held[at])], names=["term", "df"])

    counts = np.zeros(size, np.int64)
    partial = bagged.select("bag").mapInArrow(run, "term int, df long")
    for row in partial.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        counts[row.term] = row.df
    return counts


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


class Scorer:
    """Integer scores of bags for a block of items."""

    def __init__(self, items: list[frozenset[int]], weights: np.ndarray):
        self.weights, self.count = weights, len(items)
        pairs = sorted((t, i) for i, own in enumerate(items) for t in own)
        self.holders = np.array([i for _, i in pairs], np.int64)
        self.starts = np.searchsorted(np.array([t for t, _ in pairs], np.int64), np.arange(len(weights) + 1))

    def scores(self, packed: list[bytes], m: np.ndarray) -> np.ndarray:
        """A row for each bag, a column for each item."""
        lengths = np.array([len(b) // 8 for b in packed])
        flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
        term, tf, row = flat[::2], flat[1::2], np.repeat(np.arange(len(packed)), lengths)
        gain = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        start, spread = self.starts[term], self.starts[term + 1] - self.starts[term]
        out = np.zeros(len(packed) * self.count, np.int64)
        whole = len(gain) and int(np.abs(gain).max()) * int(lengths.max()) < 1 << 52  # then exact in doubles
        ends = np.cumsum(spread)
        at = 0
        while at < len(gain):
            to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS, "right")), at + 1)
            part = slice(at, to)
            n = spread[part]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            cell = np.repeat(row[part] * self.count, n) + self.holders[within + np.repeat(start[part], n)]
            if whole:
                low, high = row[at] * self.count, (row[to - 1] + 1) * self.count
                out[low:high] += np.bincount(cell - low, np.repeat(gain[part], n), high - low).astype(np.int64)
            else:
                np.add.at(out, cell, np.repeat(gain[part], n))
            at = to
        return out.reshape(-1, self.count)


def best_classes(classes: DataFrame, scorer: Scorer, k: int) -> DataFrame:
    """``(item, score, first, h, m, bag)``: the k best classes of every item among each task's."""
    shared = classes.sparkSession.sparkContext.broadcast(scorer)  # bounded like the vocabulary

    def run(batches):
        scorer = shared.value
        rows = max(CELLS // max(scorer.count, 1), 1)
        held = [[] for _ in range(scorer.count)]  # (-score, first, h, m, bag)
        least = np.ones(scorer.count, np.int64)  # what a class must reach
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                packed, m = part.column("bag").to_pylist(), np.asarray(part.column("m"))
                first, h = np.asarray(part.column("first")), np.asarray(part.column("h"))
                scores = scorer.scores(packed, m)
                for i in np.flatnonzero((scores >= least).any(0)):
                    at_least = np.flatnonzero(scores[:, i] >= least[i])
                    top = at_least[np.lexsort((first[at_least], -scores[at_least, i]))[:k]]
                    new = [(-int(scores[c, i]), int(first[c]), int(h[c]), int(m[c]), packed[c]) for c in top]
                    held[i] = sorted(held[i] + new)[:k]
                    if len(held[i]) == k:
                        least[i] = -held[i][-1][0]
        found = [(i, -s, first, h, m, bag) for i, own in enumerate(held) for s, first, h, m, bag in own]
        columns = list(zip(*found)) if found else [[]] * 6
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["item", "score", "first", "h", "m", "bag"])

    return classes.mapInArrow(run, "item int, score long, first long, h long, m long, bag binary")


def leaders(df: DataFrame, k: int, by: list, *order) -> DataFrame:
    """The first k rows of each group with their ``rank``; tasks drop later rows before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def search_block(docs: DataFrame, items: list[tuple], k: int, id: str, text: str) -> DataFrame | None:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(own for _, own in items))))}
    bagged = stored(bags(docs, vocabulary, id, text), "search-bags")
    n_documents, all_terms = bagged.agg(F.count("*"), F.sum("n")).first()
    if not n_documents or not vocabulary:
        return None
    df = document_counts(bagged, len(vocabulary))
    weights = np.array([weight(n_documents, int(f)) for f in df], np.int64)
    scorer = Scorer([frozenset(vocabulary[t] for t in own) for _, own in items], weights)
    m = 10 + F.expr(f"(90 * n * {n_documents}L) div {all_terms}L")
    # A bag without vocabulary terms scores 0 for every item.
    kinds = bagged.where(F.length("bag") > 0).select("id", m.alias("m"), "bag").withColumn("h", F.xxhash64("bag", "m"))
    first = F.coalesce(F.min("id"), F.lit(_LAST)).alias("first")
    classes = kinds.groupBy("h", "m", "bag").agg(first)
    best = leaders(best_classes(classes, scorer, k), k, ["item"], F.desc("score"), "first", "h", "m", "bag").drop("rank", "first")
    best = stored(best, "search-winners")  # k classes an item
    winning = broadcast_if_small(best.select("h", "m", "bag").distinct())
    members = kinds.join(winning, ["h", "m", "bag"], "left_semi")
    members = leaders(members, k, ["h", "m", "bag"], F.asc_nulls_last("id")).drop("rank")
    ranked = leaders(broadcast_if_small(best).join(members, ["h", "m", "bag"]), k, ["item"], F.desc("score"), F.asc_nulls_last("id"))
    numbered = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long")
    return ranked.join(F.broadcast(numbered), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every item with scores above 0."""
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items, item_id, item_text):
        part = search_block(docs, block, k, id, text)
        out = out if part is None else out.unionByName(part)
    return out
