"""Homomorphic multiset fingerprints of documents.

A document is the multiset of its paragraphs: what stands between line feeds and isn't only white space. Each paragraph
hashes to a wide vector and a fingerprint is the sum of these vectors: order doesn't count, and inserting or deleting a
paragraph adds or subtracts its vector. A vector has two parts, both summed modulo 2**32:

- ``EXACT`` lanes filled from SHAKE-128 of the paragraph, which tell unequal multisets apart;
- ``SKETCH`` lanes where each run of up to three words adds +1 or -1 to one lane. The difference of two sums has the
  expected squared length of the difference of the multisets of word runs, so that likeness can be told from
  fingerprints alone: 2 <a, b> / (<a, a> + <b, b>), cut to 0..1, over the signed square roots of the sums (a line that
  is repeated a hundred times then doesn't outweigh the rest).

Defined results: null counts as the empty text, whose fingerprint is all zeros; two empty documents have likeness 1, an
empty and another one 0. Equal texts have equal fingerprints. Lanes stay true up to 2**31 equal word runs.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.common import SLICE_BYTES, annotate, fresh, ship, utf8

EXACT = 32  # lanes of 32 bits
SKETCH = 256
RUN = 3  # words
_MULTIPLY = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_END = np.uint64(0x27D4EB2F165667C5)  # stands after a paragraph's last word
RANGE_BYTES = 256 << 20  # of texts that one task compares, sorted and read as a stream
_WORDS_KEPT = 300_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Hasher:
    """Fingerprints many texts at once."""

    def __init__(self):
        self.words = _WordHashes()

    def vectors(self, texts: list[bytes]) -> np.ndarray:
        """One row of EXACT + SKETCH lanes (unsigned 32-bit) for each text."""
        if len(self.words) > _WORDS_KEPT:
            self.words.clear()
        out = np.zeros((len(texts), EXACT + SKETCH), np.uint32)
        hashes, owner, paragraph = [], [], []
        digests: dict[bytes, np.ndarray] = {}
        number = 0
        for i, text in enumerate(texts):
            for part in text.split(b"\n"):
                words = part.split()
                if not words:
                    continue
                if part not in digests:
                    digests[part] = np.frombuffer(hashlib.shake_128(part).digest(4 * EXACT), "<u4")
                out[i, :EXACT] += digests[part]
                hashes += map(self.words.__getitem__, words)
                owner.append((i, len(words)))
                number += 1
        if hashes:
            h = np.array(hashes, np.uint64)
            counts = np.array([n for _, n in owner])
            texts_of = np.repeat(np.array([i for i, _ in owner]), counts)
            paragraph = np.repeat(np.arange(number), counts)
            out[:, EXACT:] = self._sketch(h, texts_of, paragraph, len(texts))
        return out

    @staticmethod
    def _sketch(h: np.ndarray, text: np.ndarray, paragraph: np.ndarray, texts: int) -> np.ndarray:
        mixed = h * _MULTIPLY[0]
        for ahead in range(1, RUN):
            following = np.full_like(h, _END)
            if len(h) > ahead:
                same = paragraph[ahead:] == paragraph[:-ahead]
                following[:-ahead][same] = h[ahead:][same]
            mixed = (mixed ^ (mixed >> np.uint64(29)) ^ following) * _MULTIPLY[ahead]
        mixed ^= mixed >> np.uint64(32)
        lane = (mixed % np.uint64(SKETCH)).astype(np.int64)
        sign = np.where(mixed >> np.uint64(40) & np.uint64(1), 1.0, -1.0)
        sums = np.bincount(text * SKETCH + lane, weights=sign, minlength=texts * SKETCH)
        return sums.reshape(texts, SKETCH).astype(np.int64).astype(np.uint32)


def shown(vectors: np.ndarray) -> list[str]:
    """Fingerprints as text (base64 of the lanes, little-endian)."""
    return [base64.b64encode(row.tobytes()).decode() for row in vectors.astype("<u4")]


def lanes(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4").astype(np.uint32)


def fingerprint(text: str) -> str:
    return shown(Hasher().vectors([text.encode()]))[0]


def insert(fingerprint_: str, paragraph: str) -> str:
    """The fingerprint after a paragraph (or several, on lines) has been inserted anywhere."""
    return shown((lanes(fingerprint_) + Hasher().vectors([paragraph.encode()])[0])[None])[0]


def delete(fingerprint_: str, paragraph: str) -> str:
    return shown((lanes(fingerprint_) - Hasher().vectors([paragraph.encode()])[0])[None])[0]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of the fingerprints in the rows of a and b, from 0 to 1."""
    a, b = (m[:, EXACT:].astype(np.int32).astype(np.float64) for m in (a, b))
    a, b = (np.sign(m) * np.sqrt(np.abs(m)) for m in (a, b))
    own = (a * a).sum(1) + (b * b).sum(1)
    both = 2 * (a * b).sum(1)
    return np.where(own > 0, np.clip(both / np.where(own > 0, own, 1), 0, 1), 1.0)


def fingerprints(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Adds fingerprint to every row."""

    def make():
        hasher = Hasher()
        return lambda values: [shown(hasher.vectors(values))]

    return annotate(docs, utf8(text), make, "fingerprint string", prefix)


def spliced(text: str, following: str) -> str:
    """The text with its last third of code points replaced by the first as many of another."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_COMPARED = (
    "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def compare_with_next(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside its spliced edit and the next document (descending id; the first follows the last).

    Ids without a value come last, rows with one id are in the order of their texts. Documents are dealt out by ranges
    of ids, as many as their bytes need, and each range is a task; the first of each range is also sent, as a look ahead, to
    the range before it, so a text moves once.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    cuts = rows.select("id").where("id IS NOT NULL").stat.approxQuantile("id", [i / parts for i in range(1, parts)], 0.25 / parts)
    edges = [float("-inf"), *sorted(set(cuts) or {0.0}), float("inf")]
    ranges = Bucketizer(splits=edges, inputCol="at", outputCol="range", handleInvalid="keep")
    # Ranges run downwards; rows without an id (the last bucket) come after all others.
    number = F.when(F.col("id").isNull(), F.lit(len(edges) + 1)).otherwise(F.lit(len(edges)) - F.col("range").cast("int"))
    dealt = ranges.transform(rows.withColumn("at", F.col("id").cast("double"))).withColumn("range", number).drop("at")
    heads = [(r["range"], r["first"]) for r in dealt.groupBy("range").agg(F.max("id").alias("first")).collect()]
    heads.sort()
    if not heads:
        return spark.createDataFrame([], _COMPARED).withColumnRenamed("id", id)
    ahead = spark.createDataFrame(
        [(heads[i - 1][0], own, first) for i, (own, first) in enumerate(heads)], "to int, own int, first long"
    )  # at most one row for each range
    seen = F.broadcast(ahead)
    match = (dealt["range"] == seen["own"]) & dealt["id"].eqNullSafe(seen["first"])
    own = F.struct(F.col("range"), F.lit(False).alias("lent"))
    also = F.struct(F.col("to").alias("range"), F.lit(True).alias("lent"))
    places = F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, also))
    lent = dealt.join(seen, match, "left").select("id", "text", F.explode(places).alias("place"))
    ordered = lent.select("place.range", "place.lent", "id", "text").repartitionById(len(edges) + 2, "range").sortWithinPartitions(
        "range", "lent", F.desc_nulls_last("id"), "text"
    )

    def compare(batches):
        hasher = Hasher()
        for ids, texts in _runs(batches):  # the last text only follows
            edits = [spliced(a, b) for a, b in zip(texts, texts[1:])]
            plain = hasher.vectors([t.encode() for t in texts])
            edited = hasher.vectors([t.encode() for t in edits])
            columns = [
                pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edits], pa.string()),
                pa.array(shown(plain[:-1]), pa.string()), pa.array(shown(edited), pa.string()),
                pa.array(likeness(plain[:-1], edited)), pa.array(likeness(plain[:-1], plain[1:])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _COMPARED.split(", ")])

    return ordered.mapInArrow(compare, _COMPARED).withColumnRenamed("id", id)


def _runs(batches):
    """``(ids, texts)`` of neighbouring documents of one range, with one more text that follows the last."""
    ids, texts, size, now, done = [], [], 0, None, False
    for batch in batches:
        for range_, lent, id_, text in zip(*(c.to_pylist() for c in batch.columns)):
            if range_ != now:
                ids, texts, size, now, done = [], [], 0, range_, False
            if done:  # only the first row of the next range is needed
                continue
            texts.append(text)
            if lent:
                if ids:
                    yield ids, texts
                done = True
                continue
            if len(texts) > 1 and size >= SLICE_BYTES:
                yield ids, texts
                ids, texts, size = [], [text], 0
            ids.append(id_)
            size += len(text)
