"""Mixing sources to target weights by iterative proportional fitting, then sampling documents.

Documents are counted once into cells (source, language, topic) with their tokens. Targets name a bounded number of
categories of each marginal and what all others together get, so there are at most (S + 1)(L + 1)(T + 1) cells and
fitting them is a driver's affair at any size of corpus. Each round scales the cells to the targets of one marginal after
another until all agree. A cell's share over its tokens is the density that it should have; the largest scale at which
no probability exceeds one, or the one that meets the token budget, turns densities into probabilities of keeping a
document. Documents are drawn by a hash of their id and text, so the draw is the same on every run and needs no shuffle.

Topics come from the text itself: the first of the ordered rules whose pattern it contains.

Defined results: a category without a target, or null, is ``other``. Targets of categories that hold no tokens are spread
over the rest in proportion. Documents without tokens are kept with their cell's probability. If nothing has tokens,
every probability is 1. Rows are drawn one by one; equal rows (id and text) are kept or dropped together.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import DataFrame, functions as F

OTHER = "other"
AXES = ("source", "lang", "topic")
ROUNDS = 200
CLOSE = 1e-10

# Ordered topic rules (name, what the text must hold, pattern that it must match as well).
TOPICS = (
    ("tabular", " | ", None),
    ("contact", "@", r"[A-Za-z0-9._]@[A-Za-z0-9.]+\.[A-Za-z]{2}"),
    ("licensing", None, r"\b([Ll]icen[cs]e|LICENSE|[Cc]opyright|COPYRIGHT|[Ww]arranty|WARRANTY|[Pp]ermission|PERMISSION)\b"),
    ("numeric", None, r"[0-9][0-9][0-9]"),
)
PROSE = "prose"


def topic_of(text):
    """The topic of a text column that has no nulls."""
    out = F.lit(PROSE)
    for name, needle, pattern in reversed(TOPICS):
        holds = F.contains(text, F.lit(needle)) if needle else F.lit(True)
        out = F.when(holds & text.rlike(pattern) if pattern else holds, name).otherwise(out)
    return out


def token_weight(text):
    """Tokens of a text column, as far as weights need them: what white space separates."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _category(column, targets: Mapping[str, float]):
    known = [k for k in sorted(targets) if k != OTHER]
    return F.when(column.isin(known), column).otherwise(OTHER) if known else F.lit(OTHER)


def placed(docs: DataFrame, targets: Mapping[str, Mapping[str, float]], prefix: str, text: str = "text") -> DataFrame:
    """``docs`` with its cell and token weight in columns named with ``prefix``."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    columns = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(whole)}
    out = {f"{prefix}{a}": _category(columns[a].cast("string"), targets[a]) for a in AXES}
    return docs.withColumns(out | {f"{prefix}tokens": token_weight(whole)})


def fit_cells(tokens: Mapping[tuple[str, str, str], int], targets: Mapping[str, Mapping[str, float]], rounds: int = ROUNDS) -> dict:
    """The share of each cell that holds tokens, raked to the targets of all three marginals."""
    cells = sorted(c for c, n in tokens.items() if n > 0)
    if not cells:
        return {}
    share = np.array([float(tokens[c]) for c in cells])
    share /= share.sum()
    members, wanted = [], []
    for axis, name in enumerate(AXES):
        present = sorted({c[axis] for c in cells})
        goal = np.array([max(float(targets[name].get(p, 0.0)), 0.0) for p in present])
        goal = goal / goal.sum() if goal.sum() > 0 else np.full(len(present), 1 / len(present))
        members.append(np.array([present.index(c[axis]) for c in cells]))
        wanted.append(goal)
    for _ in range(rounds):
        before = share.copy()
        for member, goal in zip(members, wanted):
            has = np.bincount(member, weights=share, minlength=len(goal))
            share = share * np.divide(goal, has, out=np.zeros_like(goal), where=has > 0)[member]
        if np.abs(share - before).max() < CLOSE:
            break
    total = share.sum()
    return dict(zip(cells, (share / total if total > 0 else share).tolist()))


def probabilities(tokens: Mapping, shares: Mapping, budget: float | None = None) -> dict:
    """The probability of keeping a document of each cell.

    Without a budget the scale is the largest that keeps every probability within one, so the sample has exactly the
    fitted shares in expectation. With a budget (a share of all tokens) cells that would exceed one are kept whole and
    the others are scaled up until the expected tokens meet it, or all are whole.
    """
    cells = [c for c in shares if tokens[c] > 0 and shares[c] > 0]
    density = {c: shares[c] / tokens[c] for c in cells}
    if not cells:
        return {}
    scale = 1 / max(density.values())
    if budget is not None:
        goal = budget * sum(tokens.values())
        order = sorted(cells, key=lambda c: -density[c])
        whole, rest = 0.0, sum(shares[c] for c in cells)
        for c in order:
            scale = (goal - whole) / rest if rest > 0 else scale
            if scale * density[c] <= 1:
                break
            whole += tokens[c]
            rest -= shares[c]
    return {c: min(1.0, max(0.0, scale * d)) for c, d in density.items()}


def draw(columns) -> object:
    """A number in [0, 1) from a hash of the columns, the same in every run."""
    digits = F.substring(F.md5(F.concat_ws("\x1f", *columns)), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**12))


def mix(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]],
    budget: float | None = None,
    id: str = "doc_id",
    text: str = "text",
    prefix: str = "mix_",
) -> DataFrame:
    """Adds the cell, tokens, weight (fitted over natural share), probability, draw and kept to every row."""
    taken = {c.lower() for c in docs.columns}
    while any(f"{prefix}{n}" in taken for n in ("source", "lang", "topic", "tokens", "weight", "probability", "draw", "kept")):
        prefix = "_" + prefix
    rows = placed(docs, targets, prefix, text)
    keys = [f"{prefix}{a}" for a in AXES]
    counted = rows.groupBy(*keys).agg(F.sum(f"{prefix}tokens").alias("n")).collect()  # bounded by the targets
    tokens = {tuple(r[k] for k in keys): r.n for r in counted}
    shares = fit_cells(tokens, targets)
    chance = probabilities(tokens, shares, budget)
    total = sum(tokens.values())
    nothing = 1.0 if total == 0 else 0.0
    table = [
        (*cell, shares.get(cell, 0.0) * total / n if n else 1.0, chance.get(cell, nothing if n or not total else 1.0))
        for cell, n in tokens.items()
    ]
    schema = ", ".join(f"`{k}` string" for k in keys) + f", `{prefix}weight` double, `{prefix}probability` double"
    cells = F.broadcast(docs.sparkSession.createDataFrame(table, schema))
    drawn = draw([F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))])
    joined = rows.join(cells, keys, "left").withColumn(f"{prefix}draw", drawn)
    return joined.withColumn(f"{prefix}kept", F.col(f"{prefix}draw") < F.col(f"{prefix}probability"))


def sample(docs: DataFrame, targets: Mapping, budget: float | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the mix keeps, with the columns of ``docs``."""
    mixed = mix(docs, targets, budget, id, text)
    kept = next(c for c in reversed(mixed.columns) if c.endswith("mix_kept"))
    return mixed.where(F.col(kept)).select(*[f"`{c}`" for c in docs.columns])
