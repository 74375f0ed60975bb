"""Language-model scores of texts by deleted interpolation.

The probability of a token mixes maximum-likelihood estimates of all orders up to ``order`` and a uniform one:
P(w | h) = sum over k of weight[b][k] * c(last k words) / c(last k - 1 words) + weight[b][0] / (V + 1), where b, the context's
bucket, is the binary logarithm of how often the longest context occurs. One in DELETED of the training texts is deleted:
the weights of every bucket come from expectation-maximisation on its counts, under estimates from the texts kept. The
estimates that score use all training texts. An order whose context never occurs drops out and the others share its weight,
so that probabilities always add up to one over the V words and an unknown one.

Counts grow with the corpus and reach neither the driver nor all tasks. Texts are cut into chunks of at most CHUNK tokens,
held as numbers into the chunk's own words. A chunk asks for the counts of its distinct n-grams, as one block of sorted
64-bit hashes for each of the slots, which are ranges of hashes; a slot adds up what all chunks bring and answers each in
the order it asked. A frequent n-gram thus weighs no more than once a chunk, and no slot holds more than its share of
hashes. Deleted texts fill chunks of their own, so that fitting the weights moves these only.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end. N-grams are told apart by 64 bits of hash.

Defined results: null counts as the empty text, which is one end. Every row is a text of its own, whatever its id; rows
without a known answer of ``learns`` teach nothing. Texts of any length are scored whole, in pieces that carry their context
on. Without training texts every token has the uniform probability 1. A bucket without deleted counts uses the weights of
all buckets together; without any deleted counts all orders weigh the same.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from kerbside.llm.common import ship, slices, utf8
from kerbside.session import scratch_path, stored

ORDER = 2
DELETED = 16  # one in so many training texts is for the weights
CHUNK = 1 << 21  # tokens
SLOT = 1 << 21  # distinct n-grams of chunks, in the mean, that one slot answers
BUCKETS = 48  # of context frequencies, by powers of two
PRIOR = 0.5  # counts that every weight starts with, so that none becomes 0
ROUNDS, GAIN = 60, 1e-5  # of expectation-maximisation, and the gain in log-likelihood a token that ends it
START, END = b"\n", b" "  # no word holds white space
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall
STEP = 1 << 17  # tokens whose estimates are held at a time
_MORE = 255  # counts from here on are stored apart


# -- chunks of texts ---------------------------------------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, width * size, codec="zstd", asbytes=True), np.uint8).reshape(width, size)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


class Chunk:
    """Pieces of texts as numbers of words; a piece begins with ``order - 1`` tokens of context.

    All texts of a chunk are alike in whether they teach and whether they are deleted.
    """

    def __init__(self, number: int, learns: bool, deleted: bool):
        self.number, self.learns, self.deleted = number, learns, deleted
        self.words: dict[bytes, int] = {}
        self.tokens = array("I")
        self.pieces: list[tuple] = []  # (id, key, whether the text begins here, tokens without the context)

    def add(self, id, key: int, begins: bool, context: list[bytes], tokens: list[bytes]) -> None:
        words = self.words
        self.tokens.extend([words.setdefault(w, len(words)) for w in context])
        self.tokens.extend([words.setdefault(w, len(words)) for w in tokens])
        self.pieces.append((id, key, begins, len(tokens)))

    def row(self) -> list:
        tokens = np.frombuffer(self.tokens, np.uint32)
        # Numbers by falling frequency compress best.
        by_use = np.argsort(-np.bincount(tokens, minlength=len(self.words)), kind="stable")
        rank = np.empty(len(by_use), np.uint32)
        rank[by_use] = np.arange(len(by_use), dtype=np.uint32)
        words = list(self.words)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(words[i]) for i in by_use), np.uint64, len(words))
        return [self.number, self.learns, self.deleted, len(tokens), packed(rank[tokens]), hashes.tobytes(), *map(list, zip(*self.pieces))]


def chunk_schema(id_type: str) -> str:
    return (
        f"chunk long, learns boolean, deleted boolean, size int, tokens binary, words binary, ids array<{id_type}>, "
        "keys array<long>, begins array<boolean>, lengths array<int>"
    )


def chunks(texts: DataFrame, order: int, size: int = CHUNK) -> DataFrame:
    """Chunks of ``(text, id, learns, deleted)``."""
    ship(texts.sparkSession)
    id_type = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        task = TaskContext.get().partitionId() << 36
        number = key = task
        open_chunks: dict[tuple[bool, bool], Chunk] = {}
        kinds = names = None

        def closed(chunk: Chunk):
            columns = [[v] for v in chunk.row()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            if kinds is None:
                lists = [pa.list_(t) for t in (batch.schema.field(1).type, pa.int64(), pa.bool_(), pa.int32())]
                kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.binary(), pa.binary(), *lists]
                names = "chunk learns deleted size tokens words ids keys begins lengths".split()
            for part in slices(batch, 0):
                for text, id, learns, deleted in zip(*(c.to_pylist() for c in part.columns)):
                    key += 1
                    context, begins = [START] * (order - 1), True
                    for piece in pieces(text, size):
                        chunk = open_chunks.get((learns, deleted))
                        if chunk is None:
                            chunk = open_chunks[learns, deleted] = Chunk(number, learns, deleted)
                            number += 1
                        chunk.add(id, key, begins, context, piece)
                        begins, context = False, (context + piece)[len(piece) :]
                        if len(chunk.tokens) >= size:
                            yield closed(open_chunks.pop((learns, deleted)))
        for chunk in open_chunks.values():
            yield closed(chunk)

    rows = texts.select("text", "id", "learns", "deleted").mapInArrow(run, chunk_schema(id_type))
    # Rows are large: the writer looks at its buffer after each of them.
    path = scratch_path(texts.sparkSession, "language-model-chunks")
    rows.write.options(**{"parquet.page.size.row.check.min": "1", "parquet.block.size": str(32 << 20)}).parquet(path)
    return texts.sparkSession.read.schema(rows.schema).parquet(path)


def pieces(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The tokens of a text, at most about ``size`` at a time, the end last."""
    text = text.lower()
    found, at = [], 0
    if len(text) <= 2 * size:
        found = _WORDS(text)
    else:
        for match in re.finditer(rb"[^\x20\x09-\x0D]+", text):
            found.append(match.group())
            at += 1
            if at == size:
                yield found
                found, at = [], 0
    found.append(END)
    yield found


# -- n-grams of a chunk ------------------------------------------------------------------------------------------------


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two 64-bit hashes, in this order."""
    h = left * np.uint64(0x9E3779B97F4A7C15) ^ (right + np.uint64(0x7F4A7C15F39CC060)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _distinct(values: np.ndarray, numbered: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Sorted distinct values, the number of each value among them where wanted, and how often each occurs."""
    by_value = np.argsort(values) if numbered else None
    values = values[by_value] if numbered else np.sort(values)
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    repeats = np.diff(np.append(starts, len(values)))
    number = None
    if numbered:
        number = np.empty(len(values), np.int32)
        number[by_value] = np.repeat(np.arange(len(starts), dtype=np.int32), repeats)
    return values[starts], number, repeats


class Positions:
    """A chunk's tokens, and its distinct n-grams of each order."""

    def __init__(self, chunk: dict, order: int):
        self.tokens = unpacked(chunk["tokens"], chunk["size"], np.uint32).astype(np.int32)
        self.words, self.order, self.learns = np.frombuffer(chunk["words"], np.uint64), order, chunk["learns"]
        lengths, context = np.asarray(chunk["lengths"], np.int64) + order - 1, order - 1
        starts = np.cumsum(lengths) - lengths
        self.within = (np.arange(chunk["size"]) - np.repeat(starts, lengths)).astype(np.int32)
        self.scored = self.within >= context
        # The last start of a text counts as the context it is, once a text; other context was counted where it was text.
        self.starts = starts[np.asarray(chunk["begins"], bool)] + context - 1 if context else np.zeros(0, np.int64)

    def grams(self, numbered: bool) -> Iterator[tuple[np.ndarray | None, np.ndarray, np.ndarray]]:
        """For each order: the number of the n-gram that ends at each position (0 where none does), the n-grams' hashes,
        and how often the chunk teaches them. Without ``numbered`` the highest order has no numbers."""
        number, hashes, size = self.tokens, self.words, np.int64(len(self.words))
        for k in range(1, self.order + 1):
            if k == self.order > 1:
                # All positions of the highest order are tokens.
                distinct, last, counts = _distinct(number[:-1][self.scored[1:]] * size + self.tokens[self.scored], numbered)
                hashes = self._hashes(hashes, distinct, k)
                if numbered:
                    number = np.zeros(len(self.tokens), np.int32)
                    number[self.scored] = last
                yield number if numbered else None, hashes, counts if self.learns else np.zeros_like(counts)
                return
            if k > 1:
                valid = self.within >= k - 1
                distinct, own, _ = _distinct(number[:-1][valid[1:]] * size + self.tokens[valid], True)
                hashes = self._hashes(hashes, distinct, k)
                number = np.zeros(len(self.tokens), np.int32)
                number[valid] = own
            counts = np.zeros(len(hashes), np.int64)
            if self.learns:
                counts = np.bincount(number[self.scored], minlength=len(hashes)) + np.bincount(number[self.starts], minlength=len(hashes))
            yield number, hashes, counts

    def _hashes(self, before: np.ndarray, pairs: np.ndarray, k: int) -> np.ndarray:
        return _mixed(before[pairs // len(self.words)], self.words[pairs % len(self.words)] + np.uint64(k))


def dealt(hashes: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the hashes, and where each slot, a range of them, begins and the last one ends."""
    by_hash = np.argsort(hashes)
    bounds = np.array([-(-(s << 64) // slots) for s in range(slots)], np.uint64)
    return by_hash, np.append(np.searchsorted(hashes[by_hash], bounds), len(hashes))


def _small(values: np.ndarray) -> tuple[bytes, bytes]:
    """Counts as bytes, those that don't fit apart."""
    return packed(np.minimum(values, _MORE).astype(np.uint8)), values[values >= _MORE].astype("<i8").tobytes()


def _counts(low: bytes, high: bytes, size: int) -> np.ndarray:
    out = unpacked(low, size, np.uint8).astype(np.int64)
    out[out == _MORE] = np.frombuffer(high, "<i8")
    return out


_ASKED = "slot long, chunk long, asking boolean, size int, hashes binary, low binary, high binary"
_ANSWER = "chunk long, slot long, asking boolean, low binary, high binary, kept_low binary, kept_high binary, known long"


def requests(chunked: DataFrame, order: int, slots: list[int]) -> DataFrame:
    """Each chunk's distinct n-grams with what it teaches of them, a row for every slot that they fall in."""

    def run(batches):
        names = [f.split()[0] for f in _ASKED.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                for k, (_, hashes, counts) in enumerate(Positions(row, order).grams(numbered=False)):
                    out = [[] for _ in kinds]
                    by_hash, ends = dealt(hashes, slots[k])
                    hashes, counts = hashes[by_hash], counts[by_hash]
                    for s in np.flatnonzero(np.diff(ends)):
                        part = slice(ends[s], ends[s + 1])
                        steps = np.diff(hashes[part], prepend=np.uint64(0))
                        values = [int(s) * order + k, row["chunk"], row["deleted"], len(steps), packed(steps), *_small(counts[part])]
                        for column, value in zip(out, values):
                            column.append(value)
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return chunked.drop("ids", "keys").mapInArrow(run, _ASKED)


def answers(asked: DataFrame, order: int, slots: int) -> DataFrame:
    """For every request the counts over all training texts and over those kept, in the order of the request.

    ``known`` is the number of distinct counted words of the slot, in one of its rows.
    """

    def add(group: pa.Table) -> pa.Table:
        rows = group.to_pydict()
        del group
        sizes, asking = rows["size"], rows["asking"]
        hashes = np.empty(sum(sizes), np.uint64)
        ends = np.cumsum([0, *sizes])
        for i, data in enumerate(rows.pop("hashes")):
            hashes[ends[i] : ends[i + 1]] = np.cumsum(unpacked(data, sizes[i], np.uint64), dtype=np.uint64)
        distinct, number, _ = _distinct(hashes, True)
        del hashes
        each = np.split(number, ends[1:-1])
        total, kept = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        for i, at in enumerate(each):
            part = np.bincount(at, _counts(rows["low"][i], rows["high"][i], sizes[i]), len(distinct)).astype(np.int64)
            total += part
            if not asking[i]:
                kept += part
        out = {"chunk": rows["chunk"], "slot": rows["slot"], "asking": asking}
        out["low"], out["high"] = zip(*(_small(total[at]) for at in each))
        # Only deleted chunks ask what is left without them.
        out["kept_low"], out["kept_high"] = zip(*(_small(kept[at]) if d else (b"", b"") for at, d in zip(each, asking)))
        words = int((total > 0).sum()) if rows["slot"][0] % order == 0 else 0
        out["known"] = [words] + [0] * (len(sizes) - 1)
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(out.values(), kinds)], names=list(out))

    parts = min(slots, 16 * asked.sparkSession.sparkContext.defaultParallelism)
    return asked.repartition(parts, "slot").groupBy("slot").applyInArrow(add, _ANSWER)


class Answered:
    """A chunk's tokens with the counts of the n-grams that end at them and of their contexts, by order."""

    def __init__(self, chunk: dict, rows: dict, order: int, slots: list[int], kept: bool):
        at = Positions(chunk, order)
        by_slot = {s: i for i, s in enumerate(rows["slot"])}
        prefix = "kept_" if kept else ""
        self.counts, self.contexts, before = [], [], None
        for k, (number, hashes, _) in enumerate(at.grams(numbered=True)):
            by_hash, ends = dealt(hashes, slots[k])
            counts = np.zeros(max(len(hashes), 1), np.int64)
            for s in np.flatnonzero(np.diff(ends)):
                i = by_slot[int(s) * order + k]
                counts[by_hash[ends[s] : ends[s + 1]]] = _counts(rows[prefix + "low"][i], rows[prefix + "high"][i], int(ends[s + 1] - ends[s]))
            here = counts[number]
            self.counts.append(here[at.scored])
            self.contexts.append(before[:-1][at.scored[1:]] if before is not None else None)
            before = here
        self.last = number[at.scored]

    def __len__(self) -> int:
        return len(self.last)

    def likelihoods(self, at, tokens: int, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Estimates of all orders for the tokens ``at``, uniform first, a row for each; and which have a context."""
        first = self.counts[0][at]
        estimates, defined = np.zeros((len(first), len(self.counts) + 1)), np.ones((len(first), len(self.counts) + 1), bool)
        estimates[:, 0] = 1 / (words + 1)
        estimates[:, 1] = first / tokens if tokens else 0
        defined[:, 1] = tokens > 0
        for k in range(1, len(self.counts)):
            context = self.contexts[k][at]
            estimates[:, k + 1] = self.counts[k][at] / np.maximum(context, 1)
            defined[:, k + 1] = context > 0
        return estimates, defined

    def buckets(self, at) -> np.ndarray:
        if len(self.counts) == 1:
            return np.zeros(len(self.counts[0][at]), np.int64)
        return np.minimum(np.frexp(self.contexts[-1][at].astype(np.float64))[1], BUCKETS - 1)


# -- weights -----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Weights:
    """A weight for each bucket of contexts and order, uniform first; how they were found."""

    table: np.ndarray
    rounds: int
    converged: bool
    log_likelihoods: list[float]  # a deleted token's, in each round


def fitted_weights(evidence: DataFrame, order: int, rounds: int = ROUNDS, gain: float = GAIN) -> Weights:
    """Expectation-maximisation over ``(bucket, e0 .. e_order, n)``: estimates of deleted n-grams and their counts.

    A round is one aggregation to BUCKETS rows. Weights are those after ``rounds`` rounds at most; ``converged`` says
    whether the gain fell below ``gain`` before.
    """
    names = [f"e{k}" for k in range(order + 1)]
    table, logs = np.full((BUCKETS, order + 1), 1 / (order + 1)), []
    for done in range(1, rounds + 1):
        weights = F.lit(table.reshape(-1).tolist())
        parts = [F.col(e) * F.get(weights, F.col("bucket") * (order + 1) + k) for k, e in enumerate(names)]
        whole = sum(parts[1:], parts[0])
        shares = [F.sum(F.col("n") * p / whole).alias(f"s{k}") for k, p in enumerate(parts)]
        sums = evidence.groupBy("bucket").agg(*shares, F.sum("n").alias("n"), F.sum(F.col("n") * F.log(whole)).alias("log"))
        found = np.zeros((BUCKETS, order + 1))
        log = total = 0
        for row in sums.collect():
            found[row.bucket] = [row[f"s{k}"] for k in range(order + 1)]
            log, total = log + row.log, total + row.n
        if not total:
            return Weights(table, 0, True, [])
        all_buckets = found.sum(0)
        seen = found.sum(1) > 0
        found[~seen] = all_buckets
        found += PRIOR
        table = found / found.sum(1, keepdims=True)
        logs.append(log / total)
        if len(logs) > 1 and logs[-1] - logs[-2] < gain:
            return Weights(table, done, True, logs)
    return Weights(table, rounds, False, logs)


def mixture(estimates: np.ndarray, defined: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Probabilities; orders without a context leave their weight to the others."""
    usable = np.where(defined, weights, 0)
    return (usable * estimates).sum(1) / usable.sum(1)


# -- the whole ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Counted:
    """Chunks with their answers, and the totals of the training texts: everything that scoring needs but the weights."""

    chunked: DataFrame
    answered: DataFrame
    order: int
    slots: list[int]
    tokens: int
    kept_tokens: int
    words: int

    def meet(self, run, schema: str, deleted_only: bool = False) -> DataFrame:
        """``run(chunk, answers)`` for every chunk."""
        left = self.chunked.drop("deleted") if not deleted_only else self.chunked.where("deleted").drop("deleted")
        right = self.answered.select("chunk", "slot", "low", "high")
        if deleted_only:
            right = self.answered.where("asking").select("chunk", "slot", "kept_low", "kept_high")

        def both(own: pa.Table, found: pa.Table) -> pa.Table:
            return run({name: own[name][0].as_py() for name in own.schema.names}, found.to_pydict())

        return left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(both, schema)

    def evidence(self) -> DataFrame:
        """The estimates, from the texts kept, of the deleted texts' n-grams, and how often each occurs in its chunk."""
        order, slots, tokens, words = self.order, self.slots, self.kept_tokens, self.words
        names = ["bucket", *[f"e{k}" for k in range(order + 1)], "n"]

        def run(chunk, rows):
            found = Answered(chunk, rows, order, slots, kept=True)
            _, first, n = np.unique(found.last, return_index=True, return_counts=True)
            estimates, _ = found.likelihoods(first, tokens, words)
            columns = [found.buckets(first).astype(np.int32), *estimates.T, n]
            return pa.table([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

        fields = ", ".join(["bucket int", *[f"e{k} double" for k in range(order + 1)], "n long"])
        return stored(self.meet(run, fields, deleted_only=True), "language-model-evidence")

    def scores(self, weights: Weights, id: str) -> DataFrame:
        order, slots, tokens, words, table = self.order, self.slots, self.tokens, self.words, weights.table
        id_type = self.chunked.schema["ids"].dataType.elementType.simpleString()

        def run(chunk, rows):
            found = Answered(chunk, rows, order, slots, kept=False)
            logs = np.empty(len(found))
            for start in range(0, len(found), STEP):
                at = slice(start, start + STEP)
                logs[at] = np.log10(mixture(*found.likelihoods(at, tokens, words), table[found.buckets(at)]))
            c = found.counts[0]
            base = np.log10((c + 0.5) / (tokens + 0.5 * (words + 1)))
            starts = np.cumsum([0, *chunk["lengths"][:-1]])
            add = lambda values: np.add.reduceat(values, starts)
            columns = [chunk["keys"], chunk["lengths"], add((c > 0).astype(np.int64)), add(base), add(logs)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            ids = pa.array(chunk["ids"], id_kind) if id_kind is not None else pa.array(chunk["ids"])
            arrays = [ids, *(pa.array(v, t) for v, t in zip(columns, kinds))]
            return pa.table(arrays, names=["id", "key", "n_tokens", "n_known", "base_score", "score"])

        id_kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(id_type)
        schema = f"id {id_type}, key long, n_tokens long, n_known long, base_score double, score double"
        sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
        whole = self.meet(run, schema).groupBy("key").agg(F.max("id").alias("id"), *sums)
        return whole.select(
            F.col("id").alias(id), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
        )


def count(docs: DataFrame, learns: Column, id: str = "doc_id", text: str = "text", order: int = ORDER, size: int = CHUNK, slot: int = SLOT) -> Counted:
    """Cut the texts into chunks and count their n-grams over the texts for which ``learns`` holds."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    learns = F.coalesce(learns, F.lit(False))
    deleted = learns & (F.pmod(F.xxhash64(F.col(f"`{text}`"), F.lit("deleted")), F.lit(DELETED)) == 0)
    texts = docs.select(utf8(text).alias("text"), F.col(f"`{id}`").alias("id"), learns.alias("learns"), deleted.alias("deleted"))
    chunked = chunks(texts, order, size)
    length = F.aggregate("lengths", F.lit(0).cast("long"), lambda total, n: total + n)
    totals = chunked.agg(F.sum(F.when(F.col("learns"), length)), F.sum(F.when(F.expr("learns AND NOT deleted"), length)), F.sum("size"), F.sum(F.length("words") / 8)).first()
    tokens, kept, positions, words = (int(v or 0) for v in totals)
    slots = [max(-(-words // slot), 1)] + [max(-(-positions // slot), 1)] * (order - 1)
    asked = requests(chunked, order, slots)
    answered = stored(answers(asked, order, sum(slots)), "language-model-answers")
    known = int(answered.agg(F.sum("known")).first()[0] or 0)
    # The start of a text is counted as a context, but is no word.
    return Counted(chunked, answered, order, slots, tokens, kept, known - (tokens > 0 and order > 1))


def score_texts(docs: DataFrame, learns: Column, id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``, learning where ``learns`` holds."""
    counted = count(docs, learns, id, text, order)
    weights = fitted_weights(counted.evidence(), order)
    return stored(counted.scores(weights, id), "language-model-scores")
