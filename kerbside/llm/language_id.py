"""Language identification by a byte convolutional network, trained here in numpy.

Bytes are embedded; filters of several widths run over a window of fixed length, each keeps its strongest response, and a
softmax over these gives the languages' probabilities. A text is cut into such windows, whole; they are computed in
batches and averaged, weighted by their letters. When predicting, a filter's response to two neighbouring bytes comes
from a table, which gives the same sums as the embedding.

The network is trained on a bounded sample (a documented bound): ``rows_per_language`` rows of each of the
``MOST_LANGUAGES`` most frequent languages, those with the smallest hashed keys, ``WINDOWS_PER_ROW`` windows of each at
hashed places.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text if nothing was learnt.
Short windows are padded with spaces. The score is the probability of the language. Columns are kept; those with a
result's name are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from kerbside.llm.common import annotate, fresh, give_back, utf8
from kerbside.session import stored

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 24  # of each width
EMBEDDED = 8
ROWS_PER_LANGUAGE = 1_000
WINDOWS_PER_ROW = 3
MOST_LANGUAGES = 200
STEPS, BATCH, RATE = 600, 64, 3e-3
UNKNOWN = "und"
_AT_ONCE = 64  # windows

_LETTERS = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


def windows(text: bytes) -> bytes:
    """The text padded to whole windows."""
    return text.ljust(-(-len(text) // WINDOW) * WINDOW, b" ")


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDED
    filters: list[np.ndarray]  # for each width: width x EMBEDDED x FILTERS
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """For each width the responses to its pairs of bytes, and to the last byte of an odd width."""
        out = []
        for f in self.filters:
            one = [self.embedding @ f[j] for j in range(len(f))]
            pairs = [(one[j][:, None] + one[j + 1][None]).reshape(65536, -1).astype(np.float32) for j in range(0, len(f) - 1, 2)]
            out.append(pairs + [one[-1].astype(np.float32)] * (len(f) % 2))
        return out

    def probabilities(self, x: np.ndarray, tables: list) -> np.ndarray:
        """Softmax of each window in the rows of x (bytes)."""
        two = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        pooled = []
        for f, parts in zip(self.filters, tables):
            width, length = len(f), x.shape[1] - len(f) + 1
            sums = None
            for n, table in enumerate(parts):
                where = two[:, 2 * n : 2 * n + length] if 2 * n + 1 < width else x[:, 2 * n : 2 * n + length]
                sums = table[where] if sums is None else sums + table[where]
            pooled.append(sums.max(1))
        h = np.maximum(np.concatenate(pooled, 1) + self.bias, 0)
        z = h @ self.dense + self.dense_bias
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def predict(self, texts: list[bytes], tables: list) -> np.ndarray:
        """Probabilities of each text that isn't empty, from all its windows."""
        padded = b"".join(map(windows, texts))
        x = np.frombuffer(padded, np.uint8).reshape(-1, WINDOW)
        p = np.concatenate([self.probabilities(x[i : i + _AT_ONCE], tables) for i in range(0, len(x), _AT_ONCE)])
        weight = _LETTERS[x].sum(1) + 1e-3
        starts = np.concatenate([[0], np.cumsum([-(-len(t) // WINDOW) for t in texts])[:-1]]).astype(int)
        sums = np.add.reduceat(p * weight[:, None], starts, axis=0)
        return sums / np.add.reduceat(weight, starts)[:, None]


def train(x: np.ndarray, y: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Adam over cross entropy, classes in equal shares. x: rows of WINDOW bytes, y: numbers of languages."""
    rng = np.random.default_rng(seed)
    size = len(WIDTHS) * FILTERS
    params = [rng.normal(0, 0.3, (256, EMBEDDED))]
    params += [rng.normal(0, (w * EMBEDDED) ** -0.5, (w, EMBEDDED, FILTERS)) for w in WIDTHS]
    params += [np.zeros(size), rng.normal(0, size**-0.5, (size, len(languages))), np.zeros(len(languages))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    members = [np.flatnonzero(y == c) for c in range(len(languages))]
    for step in range(1, STEPS + 1):
        drawn = np.array([rng.choice(members[c]) for c in rng.integers(len(languages), size=BATCH)])
        b, target = x[drawn], y[drawn]
        embedding, filters, bias, dense, dense_bias = params[0], params[1:-3], params[-3], params[-2], params[-1]
        e = embedding[b]
        pooled, places = [], []
        for f in filters:
            length = WINDOW - len(f) + 1
            response = sum(e[:, j : j + length] @ f[j] for j in range(len(f)))
            places.append(response.argmax(1))
            pooled.append(response.max(1))
        pre = np.concatenate(pooled, 1) + bias
        h = np.maximum(pre, 0)
        z = h @ dense + dense_bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(BATCH), target] -= 1
        p /= BATCH
        back = (p @ dense.T) * (pre > 0)
        grads = [np.zeros_like(embedding)] + [np.zeros_like(f) for f in filters] + [back.sum(0), h.T @ p, p.sum(0)]
        rows = np.arange(BATCH)[:, None]
        for k, f in enumerate(filters):
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            for j in range(len(f)):
                bytes_there = b[rows, places[k] + j]
                grads[1 + k][j] = np.einsum("bfe,bf->ef", embedding[bytes_there], own)
                np.add.at(grads[0], bytes_there, own[:, :, None] * f[j].T[None])
        for i, (g, (m, v)) in enumerate(zip(grads, moments)):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            params[i] = params[i] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(languages, params[0], list(params[1:-3]), params[-3], params[-2], params[-1])


def _last_hashes(hashed: DataFrame, counts: dict[str, int], rows: int) -> dict[str, int]:
    """For each language a hash up to which there are ``rows`` rows or all that it has.

    Hashes are spread evenly, so twice the wanted share of their span holds enough. That is counted, and where repeated keys
    made it too few, the language keeps all its rows.
    """
    top = (1 << 63) - 1
    last = {lang: top if n <= 2 * rows + 100 else int(((2 * rows + 100) << 64) // n) - (1 << 63) for lang, n in counts.items()}
    if all(h == top for h in last.values()):
        return last
    bounds = hashed.sparkSession.createDataFrame(list(last.items()), "lang string, last long")
    found = hashed.join(F.broadcast(bounds), "lang").where(F.col("h") <= F.col("last")).groupBy("lang").agg(F.count("*").alias("n"))
    enough = {r.lang for r in found.collect() if r.n >= rows}
    return {lang: h if h == top or lang in enough else top for lang, h in last.items()}


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows_per_language: int = ROWS_PER_LANGUAGE
) -> Network | None:
    """Trains on rows with a text and a language; None if there are none. The driver gets the sampled windows only."""
    size = F.length("data")
    rows = docs.select(utf8(text).alias("data"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{key}`").cast("string").alias("key"))
    rows = rows.where(F.col("lang").isNotNull() & (size > 0) & F.col("data").cast("string").rlike(r"\p{L}"))
    places = [F.pmod(F.xxhash64("key", F.lit(n)), F.greatest(size - WINDOW, F.lit(0)) + 1).cast("int") for n in range(WINDOWS_PER_ROW)]
    cut = rows.select("lang", F.xxhash64("key").alias("h"), F.array(*[F.substring("data", p + 1, F.lit(WINDOW)) for p in places]).alias("x"))
    hashed = stored(rows.select("lang", F.xxhash64("key").alias("h")), "language-hashes")
    counts = hashed.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    last = _last_hashes(hashed, {r.lang: r.n for r in counts}, rows_per_language)
    if not last:
        return None
    common = docs.sparkSession.createDataFrame(list(last.items()), "lang string, last long")  # MOST_LANGUAGES rows at most
    by = Window.partitionBy("lang").orderBy("h", "x")
    near = cut.join(F.broadcast(common), "lang").where(F.col("h") <= F.col("last"))
    drawn = near.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= rows_per_language)
    sample = drawn.select("lang", "h", "x").orderBy("lang", "h", "x").collect()
    if not sample:
        return None
    languages = sorted({r.lang for r in sample})
    x = np.frombuffer(b"".join(bytes(w).ljust(WINDOW, b" ") for r in sample for w in r.x), np.uint8).reshape(-1, WINDOW)
    y = np.repeat([languages.index(r.lang) for r in sample], WINDOWS_PER_ROW)
    return train(x, y, languages)


def identify(docs: DataFrame, network: Network | None, text: str = "text", prefix: str = "") -> DataFrame:
    """Adds lang_pred and score to every row."""

    def make():
        tables = network.tables() if network else None

        def work(values):
            labels, scores = [UNKNOWN] * len(values), [0.0] * len(values)
            told = [i for i, v in enumerate(values) if network and v and any(map(str.isalpha, v.decode()))]
            if told:
                p = network.predict([values[i] for i in told], tables)
                for i, row in zip(told, p):
                    labels[i], scores[i] = network.languages[int(row.argmax())], min(1.0, float(row.max()))
            return labels, scores

        return work

    return annotate(docs, utf8(text), make, "lang_pred string, score double", prefix, give_back)


def keep_identified(docs: DataFrame, network: Network | None, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows whose language is known with a probability of ``least`` or more, with the columns of ``docs``."""
    prefix = fresh("language_", [c[: len("language_")] for c in docs.columns])
    known = (F.col(f"{prefix}lang_pred") != UNKNOWN) & (F.col(f"{prefix}score") >= least)
    return identify(docs, network, text, prefix).where(known).select(*[f"`{c}`" for c in docs.columns])
