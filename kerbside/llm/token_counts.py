"""Token counts without encoding every word of every text.

A text is normalised and cut into pre-tokens as the tokenizer file says; its count is the sum of their lengths in tokens.
Lengths come from two tiers, both on the map side, so pre-tokens are never shuffled: a compact table of frequent
pre-tokens that every task gets with its closure, and a cache in the worker that encodes each miss once with the
library. The table only saves work: it comes from a bounded sample of texts (``sample_rows``, ``table_size``), and
counts are the same whatever it holds.

Defined results: null counts as the empty text (0 tokens). Special strings inside texts are handled as the library does
by default: such texts, and texts with characters that the installed Unicode tables don't know, are encoded whole by the
library. Every row is counted by itself, repeated rows too; columns are kept, those with a result's name are replaced.
"""

from __future__ import annotations

import os
import unicodedata
from collections import Counter

import public_tokenizers
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from kerbside.llm.common import annotate, utf8

SAMPLE_ROWS = 2_000
SAMPLE_CHARS = 4_096  # of each sampled text; counted texts are always whole
TABLE_SIZE = 1 << 16  # frequent pre-tokens that travel to the tasks
CACHE_SIZE = 400_000  # further pre-tokens that a worker remembers; beyond it the worker starts afresh

# The pattern of the tokenizer file's Split step (a fixed value).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

FIELDS = "n_bytes long, n_tokens long, over_limit boolean"


class PreTokenCounter:
    """Counts tokens of whole texts; kept by a Python worker for the tasks that it runs."""

    def __init__(self, path: str, frequent: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile(PRE_TOKEN).findall
        self.bytes_shown = ByteLevel(add_prefix_space=False, use_regex=False)
        self.frequent = frequent
        self.lengths = dict(frequent)
        self.known: set[str] = set()

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def plain(self, text: str) -> bool:
        """Whether cutting the text here gives the library's pre-tokens."""
        if any(s in text for s in self.special):
            return False
        if not text.isascii():
            new = set(text) - self.known
            if any(unicodedata.category(c) == "Cn" for c in new):
                return False
            self.known |= new
        return True

    def pre_tokens(self, text: str) -> list[str]:
        return self.split(text.lower() if text.isascii() else self.tokenizer.normalizer.normalize_str(text))

    def learn(self, missing: list[str]) -> None:
        """Encode pre-tokens once and remember their lengths."""
        stable = [m for m in missing if m.isascii() or self.tokenizer.normalizer.normalize_str(m) == m]
        for token, done in zip(stable, self.tokenizer.encode_batch(stable, add_special_tokens=False)):
            self.lengths[token] = len(done.ids)
        for token in set(missing).difference(stable):  # normalising again would change it
            shown = "".join(p for p, _ in self.bytes_shown.pre_tokenize_str(token))
            self.lengths[token] = len(self.tokenizer.model.tokenize(shown))

    def count(self, texts: list[str]) -> list[int]:
        cut = [self.pre_tokens(t) if self.plain(t) else None for t in texts]
        seen = set().union(*(c for c in cut if c))
        missing = seen - self.lengths.keys()
        if len(self.lengths) + len(missing) > len(self.frequent) + CACHE_SIZE:
            self.lengths = dict(self.frequent)
            missing = seen - self.lengths.keys()
        self.learn(list(missing))
        length = self.lengths.__getitem__
        return [self.whole(t) if c is None else sum(map(length, c)) for t, c in zip(texts, cut)]


_WORKERS: dict = {}


def counter(path: str, frequent: dict[str, int]) -> PreTokenCounter:
    """The worker's counter for a tokenizer file and table; one at a time is kept."""
    key = (path, len(frequent), hash(tuple(frequent)))
    if key not in _WORKERS:
        _WORKERS.clear()
        _WORKERS[key] = PreTokenCounter(path, frequent)
    return _WORKERS[key]


def pack(lengths: dict[str, int]) -> tuple[bytes, bytes]:
    """The compact form of the table: the pre-tokens in one string, a byte for each length."""
    return "\n".join(lengths).encode(), bytes(lengths.values())


def unpack(table: tuple[bytes, bytes]) -> dict[str, int]:
    return dict(zip(table[0].decode().split("\n"), table[1])) if table[1] else {}


def frequent_lengths(docs: DataFrame, path: str, sample_rows: int, table_size: int, text: str = "text") -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a bounded sample, at most ``table_size`` (about 1 MB packed)."""
    worker, counts = PreTokenCounter(path, {}), Counter()
    for row in docs.select(F.substring(utf8(text).cast("string"), 1, SAMPLE_CHARS).alias("text")).limit(sample_rows).collect():
        counts.update(worker.pre_tokens(row.text))
    tokens = [t for t, _ in sorted(counts.items(), key=lambda c: (-c[1], c[0])) if len(t) <= 64][:table_size]
    worker.learn(tokens)
    return {t: worker.lengths[t] for t in tokens if worker.lengths[t] < 256}


def count_tokens(
    docs: DataFrame,
    path: str | None = None,
    limit: int = 2048,
    sample_rows: int = SAMPLE_ROWS,
    table_size: int = TABLE_SIZE,
    text: str = "text",
    prefix: str = "",
) -> DataFrame:
    """Adds n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``) to every row."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    table = pack(frequent_lengths(docs, path, sample_rows, table_size, text))

    def make():
        worker = counter(path, unpack(table))

        def count(values):
            n = worker.count([v.decode() for v in values])
            return [len(v) for v in values], n, [x > limit for x in n]

        return count

    return annotate(docs, utf8(text), make, FIELDS, prefix)
