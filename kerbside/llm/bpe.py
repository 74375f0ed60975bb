"""Byte-level BPE: encoding whole texts of any length, and decoding.

Texts up to ``long_bytes`` are encoded in the worker that holds them. Longer ones become rows of pieces that the cluster
encodes in parallel and that are then concatenated as a tree:

- A white-space character after another kind of character always starts a pre-token, so cutting there is exact.
- A pre-token longer than ``leaf_bytes`` can't be cut exactly. It is halved until its parts are small, the halves are
  encoded by themselves, and around each join a window of the last k tokens of the left and the first k of the right is
  encoded anew, k doubling until the window starts with the left's token and ends with the right's. An encoding is
  right when each pair of neighbouring tokens is, and then all pairs lie in an encoding of their own: the join is exact.

The same joining serves long pre-tokens inside shorter texts. Merges and ids come from the tokenizer file; a special
token's string inside a text gives its id, as the library's default does.

Defined results: null counts as the empty text (no ids, decodes to the empty text). Equal long texts are encoded once.
Ids come as little-endian unsigned 32-bit integers in one binary. Columns are kept, those with a result's name replaced.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.common import annotate, fresh, give_back, ship, utf8

LONG_BYTES = 1 << 16  # texts beyond this are dealt out as pieces
PIECE_BYTES = 1 << 14  # of such a piece, where the text can be cut exactly
LEAF_BYTES = 1 << 12  # pre-tokens beyond this are halved
WINDOW = 8  # tokens on each side of a join at first

_CUT = re.compile(r"(?<=\S)\s")
_SPACES = re.compile(r"\s{1024,}")


def unsplit(text: str) -> bool:
    """Whether a text may hold a pre-token over LEAF_BYTES: these take 1,024 characters of one kind at least."""
    return len(text) >= 1024 and (max(map(len, text.split()), default=0) >= 1024 or bool(_SPACES.search(text)))


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies show bytes as: printable Latin-1 as itself, the rest from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of one tokenizer file; a Python worker keeps it for all its tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        alphabet = byte_alphabet()
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        ranks = {
            bytes(alphabet[c] for c in shown): i for shown, i in described["model"]["vocab"].items() if shown not in special
        }
        self.special = special
        self.core = tiktoken.Encoding(
            "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        self.token_bytes = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for token, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.token_bytes[i] = token
        self.splitter = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.pre_token = None

    def piece(self, data: bytes) -> list[int]:
        """Ids of bytes that the pre-tokenizer doesn't split."""
        return self.core._encode_single_piece(data) if data else []

    def text(self, text: str) -> list[int]:
        """Ids of a text whose pre-tokens are short."""
        return self.core.encode(text, allowed_special="all") if "<|" in text else self.core.encode_ordinary(text)

    def encode(self, text: str, leaf_bytes: int = LEAF_BYTES) -> list[int]:
        if leaf_bytes >= LEAF_BYTES and not unsplit(text):
            return self.text(text)
        ids: list[int] = []
        for kind, data in self.pieces(text, PIECE_BYTES, leaf_bytes):
            ids += self.text(data.decode()) if kind == "text" else self.tree(self.leaves(data, leaf_bytes))
        return ids

    def leaves(self, data: bytes, leaf_bytes: int) -> list[list[int]]:
        """Encodings of the parts that repeated halving makes of unsplit bytes."""
        return [self.piece(part) for part in halves(data, leaf_bytes)]

    def pieces(self, text: str, piece_bytes: int, leaf_bytes: int):
        """``(kind, bytes)`` in order: kind ``text`` where cuts are exact, ``run`` for one long pre-token."""
        begin = 0
        for cut in [m.start() for m in _CUT.finditer(text)] + [len(text)]:
            # a part of one word is kept until it is large enough; characters stand for bytes here
            if cut - begin >= piece_bytes or cut == len(text):
                if cut > begin:
                    yield from self._short_or_runs(text[begin:cut], leaf_bytes)
                begin = cut

    def _short_or_runs(self, part: str, leaf_bytes: int):
        if leaf_bytes >= LEAF_BYTES and not unsplit(part):
            yield "text", part.encode()
            return
        if self.pre_token is None:
            import regex

            self.pre_token = regex.compile(public_tokenizers.PATTERN)
        gathered: list[str] = []
        held, at = 0, 0
        specials = [m.span() for m in self.splitter.finditer(part)] + [(len(part), len(part))]
        for begin, end in specials:
            for token in self.pre_token.findall(part[at:begin]):
                data = token.encode()
                if len(data) > leaf_bytes:
                    if gathered:
                        yield "text", "".join(gathered).encode()
                    yield "run", data
                    gathered, held = [], 0
                    continue
                gathered.append(token)
                held += len(data)
                if held >= PIECE_BYTES:
                    yield "text", "".join(gathered).encode()
                    gathered, held = [], 0
            if end > begin:
                gathered.append(part[begin:end])
            at = end
        if gathered:
            yield "text", "".join(gathered).encode()

    def join(self, left: list[int], right: list[int], window: int = WINDOW) -> list[int]:
        """The encoding of two neighbouring parts of one pre-token, from theirs."""
        if not left or not right:
            return left or right
        k = window
        while True:
            a, b = min(k, len(left)), min(k, len(right))
            middle = self.piece(b"".join(map(self.token_bytes.__getitem__, left[-a:] + right[:b])))
            if (a == len(left) or middle[0] == left[-a]) and (b == len(right) or middle[-1] == right[b - 1]):
                return left[:-a] + middle + right[b:]
            k *= 2

    def tree(self, parts: list[list[int]]) -> list[int]:
        """Join neighbours pairwise, level by level."""
        while len(parts) > 1:
            parts = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0] if parts else []

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def halves(data: bytes, leaf_bytes: int) -> list[bytes]:
    if len(data) <= leaf_bytes:
        return [data]
    middle = len(data) // 2
    return halves(data[:middle], leaf_bytes) + halves(data[middle:], leaf_bytes)


def to_bytes(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def from_bytes(data: bytes | None) -> list[int]:
    return np.frombuffer(data or b"", dtype="<u4").tolist()


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _tokenizer(path: str | None) -> str:
    return path or public_tokenizers.path("byte_bpe_50k.json")


def encode(
    docs: DataFrame,
    path: str | None = None,
    text: str = "text",
    long_bytes: int = LONG_BYTES,
    piece_bytes: int = PIECE_BYTES,
    leaf_bytes: int = LEAF_BYTES,
    prefix: str = "",
) -> DataFrame:
    """Adds ids (binary) and n_tokens to every row."""
    path = _tokenizer(path)
    source = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    size = F.octet_length(source)

    def make():
        worker = codec(path)

        def work(values):
            ids = [to_bytes(worker.encode(v.decode(), leaf_bytes)) for v in values]
            return ids, [len(i) // 4 for i in ids]

        return work

    fields = "ids binary, n_tokens long"
    short = annotate(docs.where(size <= long_bytes), utf8(text), make, fields, prefix, give_back)
    long = docs.where(size > long_bytes)
    key, ids = fresh("text_key", short.columns + docs.columns), f"{prefix}ids"
    keyed = long.withColumn(key, F.sha2(source.cast("binary"), 256))
    encoded = _long_encodings(keyed.select(F.col(key).alias("key"), source.alias("text")), path, piece_bytes, leaf_bytes)
    encoded = encoded.withColumnsRenamed({"key": key, "ids": ids}).withColumn(f"{prefix}n_tokens", F.expr(f"octet_length(`{ids}`) div 4").cast("long"))
    lower = {f"{prefix}ids".lower(), f"{prefix}n_tokens".lower()}
    kept = keyed.select(*[c for c in keyed.columns if c.lower() not in lower])
    return short.unionByName(kept.join(encoded, key).drop(key))


def _long_encodings(texts: DataFrame, path: str, piece_bytes: int, leaf_bytes: int) -> DataFrame:
    """``(key, text)`` to ``(key, ids)``, one row for each key: pieces are dealt out, encoded and joined again."""
    ship(texts.sparkSession)

    def cut(batches):
        worker = codec(path)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for part, (kind, data) in enumerate(worker.pieces(text, piece_bytes, leaf_bytes)):
                    # leaf -1: a piece of text; else a leaf of the run
                    rows += [(part, -1, data)] if kind == "text" else [(part, i, d) for i, d in enumerate(halves(data, leaf_bytes))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary()),
                    ],
                    names=["key", "part", "leaf", "data"],
                )

    def leaves(batches):
        worker = codec(path)
        for batch in batches:
            ids = [
                to_bytes(worker.text(d.decode()) if leaf < 0 else worker.piece(d))
                for leaf, d in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(batch.columns[:3] + [pa.array(ids, pa.binary())], names=["key", "part", "leaf", "ids"])

    def joined(group: pa.Table) -> pa.Table:
        worker = codec(path)
        rows = sorted(zip(group["part"].to_pylist(), group["leaf"].to_pylist(), group["ids"].to_pylist()))
        out, run, open_part = [], [], None
        for part, leaf, ids in [*rows, (-1, -1, b"")]:
            if run and part != open_part:
                out.append(to_bytes(worker.tree(run)))
                run = []
            if leaf < 0:
                out.append(ids)
            else:
                run.append(from_bytes(ids))
            open_part = part
        return pa.table({"key": pa.array([group["key"][0].as_py()], pa.string()), "ids": pa.array([b"".join(out)], pa.binary())})

    pieces = texts.mapInArrow(cut, "key string, part int, leaf int, data binary").dropDuplicates(["key", "part", "leaf"])
    encoded = pieces.mapInArrow(leaves, "key string, part int, leaf int, ids binary")
    return encoded.groupBy("key").applyInArrow(joined, "key string, ids binary")


def decode(rows: DataFrame, path: str | None = None, ids: str = "ids", prefix: str = "") -> DataFrame:
    """Adds decoded (the text of the ids, special tokens shown) to every row; null ids decode to the empty text."""
    path = _tokenizer(path)

    def make():
        worker = codec(path)
        return lambda values: [[worker.decode(from_bytes(v)) for v in values]]

    return annotate(rows, F.col(f"`{ids}`"), make, "decoded string", prefix, give_back)
