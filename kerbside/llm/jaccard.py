"""Self-join of documents by the Jaccard similarity of their word n-grams, with set-relation skipping.

1. Each document becomes the set of its hashed shingles. Equal sets are one node from here on, however many documents
   have them; nodes have short numbers, which keep the index small. Where some nodes are wanted, a bit for each travels
   to the sets, so that sets which aren't wanted stay where they are.
2. Frequent shingles are counted (partial counts in each task, then an aggregate; a bounded table of the most frequent
   ones travels to the tasks). All sets are ordered alike: rare shingles first, by hash, then frequent ones by count.
   Any common order is exact; this one keeps the lists short.
3. Two sets that link share a shingle of their prefixes, so prefixes become an inverted index: for each shingle the
   list of (set, size, position). The list of a very frequent shingle is split into blocks, and pairs of blocks. Most
   lists are short: their pairs are taken where the list is, without sketches.
4. In a list, sorted by size, whole blocks are skipped by position: if a pair's first common shingle stands at positions
   p and q, the sets differ in p + q shingles at least. Sets are further compared by parity sketches, whose Hamming
   distance is at most the size of their difference. As this is a metric, answers carry over between similar sets: the
   distances computed for a list's first set bound those of every other set, which is only compared where they allow it.
   Pairs from all lists are then compared by wide sketches, which have as many bits as the sets have shingles.
5. In a first round the nearest of the smaller survivors of each set is verified on the sets themselves, which gives
   components. In a second round all survivors of different components are verified (those of long lists are only
   found then). A pair inside one component can't change it, so large groups of near copies cost a forest, not all
   their pairs.

Defined results: a document without words, or a null one, has an empty set, links with nothing and is its own component.
With fewer words than a shingle has, the whole sequence is the only shingle. Documents without an id take part; the
component is the smallest id that is there, null if none is. Repeated rows are copies. Shingles are told apart by 64-bit
hashes within a document and by 48 bits of them between two.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from kerbside.llm.common import annotate, fresh, give_back, ship, slices, utf8
from kerbside.llm.components import components
from kerbside.session import broadcast_if_small, stored

SHINGLE = 4
LEAST = (85, 100)  # a link: LEAST[1] * intersection >= LEAST[0] * union
FREQUENT = 1 << 18  # shingles whose counts travel to the tasks (12 bytes each)
COUNTED_FROM = 8
LIST_BLOCK = 2_048  # sets of one shingle that are compared with each other in one place
SKETCH_BITS = 512
SKIP = 64  # neighbours in a list that are skipped together
SHORT = 8  # rows of a list whose pairs are taken without sketches

_WORDS_KEPT = 100_000
_MULTIPLY = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_SHIFT = np.uint64(31)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes, size: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles. Words are what ASCII white space separates, A-Z lower-cased."""
    words = text.lower().split()  # of bytes: ASCII only
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        out = (out ^ h[j : len(h) - width + 1 + j]) * _MULTIPLY[j % 4]
        out ^= out >> _SHIFT
    return np.unique(out)


def packed(tokens: np.ndarray) -> bytes:
    """48 bits of each hash."""
    return (tokens >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<i8").ravel()


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """For each of 2**k classes of tokens, as many as tokens or more, whether the set has an odd number of them."""
    bits = max(SKETCH_BITS, 1 << (len(tokens) - 1).bit_length())
    bit = ((tokens >> np.uint64(20)) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=bits) & 1).astype(np.uint8))


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch of ``size`` bytes from a longer one."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, size), axis=0)


def least_overlap(n, m, least):
    """The smallest intersection with which sets of n and m shingles link."""
    return -(-least[0] * (n + m) // (least[0] + least[1]))


def most_difference(n, least):
    """How many shingles a set of n and any linked set that isn't larger can differ in at most.

    What two sizes allow rises and falls with their sum's parity, and never rises as a partner loses two shingles, so
    partners of n and n - 1 shingles tell.
    """
    return max(n + m - 2 * least_overlap(n, m, least) for m in (n, n - 1))


def _set_table(docs: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """``(id, mark, n, sid, node, tokens, sketch, wide)``, mark being the text's hash; of equal sets in a task only the first is a node, with tokens and sketches.

    The table is written, so node numbers stay what they are.
    """

    def make():
        hashes, seen, number = _WordHashes(), set(), TaskContext.get().partitionId() << 33

        def work(values):
            nonlocal number
            if len(hashes) > _WORDS_KEPT:
                hashes.clear()
            rows = []
            for value in values:
                tokens = shingles(value, size, hashes)
                sid = hashlib.blake2b(tokens.tobytes(), digest_size=12).digest() if len(tokens) else None
                first = sid is not None and sid not in seen
                seen.add(sid)
                number += first
                shown = (None,) * 4
                if first:
                    wide = parity_sketch(tokens)
                    shown = number, packed(tokens), folded(wide, SKETCH_BITS // 8).tobytes(), wide.tobytes()
                rows.append((len(tokens), sid, *shown))
            return list(zip(*rows))

        return work

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), utf8(text).alias("text"), F.xxhash64(utf8(text)).alias("mark"))
    sets = annotate(rows, F.col("text"), make, "n long, sid binary, node long, tokens binary, sketch binary, wide binary", done=give_back).drop("text")
    return stored(sets, "shingle-sets")


def _marked(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``sets`` that are one of ``nodes``. A bit for each node is broadcast."""
    place = F.bitmap_bit_position("node")
    bits = nodes.groupBy(F.bitmap_bucket_number("node").alias("bucket")).agg(F.bitmap_construct_agg(place).alias("bits"))
    found = sets.join(broadcast_if_small(bits, store="node-bits"), F.bitmap_bucket_number("node") == F.col("bucket"))
    byte = "cast(conv(hex(substring(bits, cast(bitmap_bit_position(node) div 8 as int) + 1, 1)), 16, 10) as int)"
    return found.where(F.expr(f"shiftright({byte}, cast(bitmap_bit_position(node) % 8 as int)) % 2 = 1")).select(*sets.columns)


def _frequent(sets: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens, sorted, and their counts. A token is counted where a task holds it twice."""

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                held.append(unpacked(data))
                size += len(held[-1])
                if size > 4_000_000:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)
        del held
        give_back()

    def rows(held):
        tokens, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(tokens[n > 1]), pa.array(n[n > 1].astype(np.int64))], names=["token", "n"])

    partial = sets.select("tokens").mapInArrow(count, "token long, n long")
    total = partial.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= COUNTED_FROM)
    top = total.orderBy(F.desc("n"), "token").limit(most).toArrow()
    tokens, n = np.asarray(top["token"], np.int64), np.asarray(top["n"], np.int64)
    order = np.argsort(tokens)
    return tokens[order], n[order]


_POSTINGS = "token long, block_i int, block_j int, side int, node long, n int, pos int"


def _postings(sets: DataFrame, frequent, least) -> DataFrame:
    """The inverted index of prefixes, a row for each pair of blocks of its list that the set belongs to."""
    known, counts = frequent

    def index(batches):
        for batch in batches:
            for part in slices(batch, 2):
                yield from rows(part)
        give_back()

    def rows(batch):
        nodes, sizes = np.asarray(batch.column(0), np.int64), np.asarray(batch.column(1), np.int64)
        tokens = unpacked(b"".join(batch.column(2).to_pylist()))
        owner = np.repeat(np.arange(len(nodes)), sizes)
        count = np.zeros(len(tokens), np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
            count = np.where(known[at] == tokens, counts[at], 0)
        order = np.lexsort((tokens, count, owner))  # owners stay in order
        pos = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        prefix = sizes - -(-least[0] * sizes // least[1]) + 1
        inside = pos < np.repeat(prefix, sizes)
        token, count, own, pos = tokens[order][inside], count[order][inside], owner[inside], pos[inside]
        blocks = np.maximum(-(-count // LIST_BLOCK), 1)
        mine = ((nodes.astype(np.uint64) * _MULTIPLY[0]) >> np.uint64(33)).astype(np.int64)[own] % blocks
        each = np.repeat(np.arange(len(token)), blocks)
        other = np.arange(len(each)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        low, high = np.minimum(mine[each], other), np.maximum(mine[each], other)
        own = own[each]
        columns = [
            pa.array(token[each]), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
            pa.array((mine[each] != low).astype(np.int32)), pa.array(nodes[own]), pa.array(sizes[own].astype(np.int32)),
            pa.array(pos[each].astype(np.int32)),
        ]
        for begin in range(0, len(own), 100_000):
            yield pa.RecordBatch.from_arrays([c.slice(begin, 100_000) for c in columns], names=[c.split()[0] for c in _POSTINGS.split(", ")])

    return sets.select("node", "n", "tokens").mapInArrow(index, _POSTINGS)


class _Lists:
    """The rows of some whole lists, sorted by list and size."""

    def __init__(self, table: pa.Table, least):
        number = lambda name: np.asarray(table[name], np.int64)
        self.node, self.n, self.pos, self.side, self.least = number("node"), number("n"), number("pos"), number("side"), least
        self.sketch = None  # of short lists
        if "sketch" in table.column_names:
            self.sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), "<u8").reshape(len(self.n), -1)
        self.group = np.asarray(table["root"].fill_null(-1), np.int64) if "root" in table.column_names else None
        if self.group is not None:
            self.group = np.where(self.group < 0, self.node, self.group)
        keys = np.column_stack([number("token"), number("block_i"), number("block_j")])
        self.starts = np.append(np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1))), len(keys))
        self.split = keys[:, 1] != keys[:, 2]  # between two blocks only pairs across them count

    def difference(self, i, j):
        """How many shingles two linked sets can differ in at most."""
        total = self.n[i] + self.n[j]
        return total - 2 * least_overlap(self.n[i], self.n[j], self.least)

    def survives(self, i, j):
        """Which pairs of rows may link, and their sketches' distances (0 without sketches)."""
        most = self.difference(i, j)
        ok = (self.least[1] * np.minimum(self.n[i], self.n[j]) >= self.least[0] * np.maximum(self.n[i], self.n[j])) & (
            self.pos[i] + self.pos[j] <= most
        )
        ok &= (self.side[i] != self.side[j]) | ~self.split[i]
        if self.group is not None:
            ok &= self.group[i] != self.group[j]
        i, j, most = i[ok], j[ok], most[ok]
        if self.sketch is None:
            return i, j, np.zeros(len(i), np.int64)
        far = np.bitwise_count(self.sketch[i] ^ self.sketch[j]).sum(1, dtype=np.int64)
        near = far <= most
        return i[near], j[near], far[near]

    def pairs(self):
        """Pairs of rows that survive, the larger set first.

        Of a long list only the nearest partner of each comes, unless roots are known: then all pairs of different components.
        """
        sizes = np.diff(self.starts)
        small, i, j = np.flatnonzero((sizes > 1) & (sizes <= SKIP)), [], []
        for k in np.unique(sizes[small]):  # lists of equal length together
            first = self.starts[small[sizes[small] == k]]
            a, b = np.tril_indices(k, -1)
            i.append((first[:, None] + a).ravel())
            j.append((first[:, None] + b).ravel())
        if i:
            yield self.survives(np.concatenate(i), np.concatenate(j))[:2]
        for g in np.flatnonzero(sizes > SKIP):
            yield from self.long_list(self.starts[g], self.starts[g + 1])

    def long_list(self, begin, end):
        if self.group is not None and (self.group[begin:end] == self.group[begin]).all():
            return
        leader = np.bitwise_count(self.sketch[begin:end] ^ self.sketch[begin]).sum(1, dtype=np.int64)
        edges = np.arange(0, end - begin, SKIP)
        lowest = np.minimum.reduceat(self.pos[begin:end], edges)
        closest, farthest = np.minimum.reduceat(leader, edges), np.maximum.reduceat(leader, edges)
        out = []
        for x in range(1, end - begin):
            size = self.n[begin + x]
            low = np.searchsorted(self.n[begin : begin + x], -(-self.least[0] * size // self.least[1]))
            if low == x:
                continue
            most = most_difference(size, self.least)  # partners before x aren't larger
            block = np.arange(low // SKIP, (x - 1) // SKIP + 1)
            block = block[
                (lowest[block] + self.pos[begin + x] <= most) & (closest[block] <= leader[x] + most) & (farthest[block] >= leader[x] - most)
            ]
            y = (block[:, None] * SKIP + np.arange(SKIP)).ravel()
            y = y[(y >= low) & (y < x)]
            y = y[np.abs(leader[y] - leader[x]) <= most]
            if len(y):
                i, j, far = self.survives(np.full(len(y), begin + x), begin + y)
                if self.group is None and len(far):  # the first round takes the nearest
                    i, j, far = i[:1], j[[far.argmin()]], far[:1]
                out.append((i, j))
        if out:
            yield tuple(np.concatenate(c) for c in zip(*out))


_KEYS = ["token", "block_i", "block_j"]


def _whole_lists(batches):
    """Rows sorted by list, as tables of whole lists."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows >= 20_000:
            table = pa.concat_tables(held)
            last = [table[k][rows - 1].as_py() for k in _KEYS]
            same = np.all([np.asarray(table[k], np.int64) == v for k, v in zip(_KEYS, last)], axis=0)
            whole = int(np.argmax(same))  # rows are sorted: the last list starts here
            if whole:
                yield table.slice(0, whole)
            held, rows = [table.slice(whole)], rows - whole
    if rows:
        yield pa.concat_tables(held)


def _pairs_of(table: pa.Table, least):
    """The surviving pairs of a table of whole lists: numbers of the smaller and the larger set."""
    lists = _Lists(table, least)
    for i, j in lists.pairs():
        a, b = pa.array(lists.node[j]), pa.array(lists.node[i])
        for begin in range(0, len(i), 100_000):
            yield pa.RecordBatch.from_arrays([a.slice(begin, 100_000), b.slice(begin, 100_000)], names=["a", "b"])


def _candidates(lists: DataFrame, least) -> DataFrame:
    """``(a, b)``: pairs of sets that may link, repeated. Lists are gathered by shingle and pair of blocks."""

    def search(batches):
        for table in _whole_lists(batches):
            yield from _pairs_of(table, least)
        give_back()

    gathered = lists.repartition(*_KEYS).sortWithinPartitions(*_KEYS, "n", "node")
    return gathered.mapInArrow(search, "a long, b long")


def _not_far(pairs: DataFrame, nodes: DataFrame, least) -> DataFrame:
    """``(a, b, far)``: of pairs, once each, those that may link by their wide sketches, and the sketches' distance."""
    of = lambda end: nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("wide").alias(f"wide_{end}"))
    both = pairs.select("a", "b").distinct().join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "n_b", "wide_a", "wide_b")

    def compare(batches):
        for batch in batches:
            far = []
            for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                size = min(len(x), len(y))
                far.append(int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum(dtype=np.int64)))
            n, m, far = (np.asarray(c, np.int64) for c in (batch.column(2), batch.column(3), far))
            near = pa.array(far <= n + m - 2 * least_overlap(n, m, least))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(far)], names=["a", "b", "far"]).filter(near)
        give_back()

    return both.mapInArrow(compare, "a long, b long, far long")


def _verified(pairs: DataFrame, sets: DataFrame, least, label: str) -> DataFrame:
    """Those pairs whose sets link."""
    pairs = stored(pairs.select("a", "b"), f"{label}-pairs")
    tokens = _marked(sets.select("node", "tokens"), pairs.select(F.explode(F.array("a", "b")).alias("node")))

    def compare(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = unpacked(x), unpacked(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(least[1] * both >= least[0] * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(ok))
        give_back()

    with_a = pairs.join(tokens.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
    with_b = with_a.join(tokens.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    return stored(with_b.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long"), f"{label}-links")


def _shared_lists(postings: DataFrame, least) -> DataFrame:
    """Of lists of up to SHORT rows the pairs ``(a, b)`` that may link; of longer ones the rows, with the list's length k.

    Rows without a neighbour of fitting size in their list are left out.
    """
    by = Window.partitionBy(*_KEYS)
    sized = by.orderBy("n", "node")
    before, after = F.lag("n").over(sized), F.lead("n").over(sized)
    fits = (least[1] * F.col("before") >= least[0] * F.col("n")) | (least[1] * F.col("n") >= least[0] * F.col("after"))
    near = postings.select("*", before.alias("before"), after.alias("after")).where(fits).drop("before", "after")
    several = near.withColumn("k", F.count("*").over(by)).where("k > 1").sortWithinPartitions(*_KEYS, "n", "node")
    fields = f"{_POSTINGS}, k long, a long, b long"
    schema = pa.schema([(f.split()[0], pa.int32() if f.endswith("int") else pa.int64()) for f in fields.split(", ")])

    def filled(columns, rows):
        made = [columns[f.name].combine_chunks() if f.name in columns else pa.nulls(rows, f.type) for f in schema]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(made, schema)], schema=schema)

    def split(batches):
        for table in _whole_lists(batches):
            short = np.asarray(table["k"], np.int64) <= SHORT
            rows = table.filter(pa.array(~short))
            if rows.num_rows:
                yield filled({c: rows[c] for c in rows.column_names}, rows.num_rows)
            few = table.filter(pa.array(short))
            for pairs in _pairs_of(few, least) if few.num_rows else ():
                whole = pa.Table.from_batches([pairs])
                yield filled({"a": whole["a"], "b": whole["b"]}, pairs.num_rows)
        give_back()

    return several.mapInArrow(split, fields)


def _row_classes(docs: DataFrame, id: str, text: str, shingle: int, least: tuple[int, int], frequent: int) -> DataFrame:
    """``(id, mark, n, sid, root, component_id)`` of every row; without shingles, sid and root are null."""
    ship(docs.sparkSession)
    sets = _set_table(docs, id, text, shingle)
    classes = stored(sets.where("sid IS NOT NULL").groupBy("sid").agg(F.min("id").alias("least_id"), F.min("node").alias("node")), "equal-sets")
    nodes = _marked(sets.where("node IS NOT NULL").select("node", "n", "tokens", "sketch", "wide"), classes)  # equal sets of other tasks are gone
    lists = stored(_shared_lists(_postings(nodes, _frequent(nodes, frequent), least), least), "shingle-lists")
    long = lists.where("a IS NULL").drop("a", "b").join(nodes.select("node", "sketch"), "node")
    found = lists.where("a IS NOT NULL").select("a", "b").union(_candidates(long, least))
    pairs = stored(_not_far(found, nodes, least), "candidates")
    nearest = pairs.groupBy("b").agg(F.min(F.struct("far", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    first = _verified(nearest, nodes, least, "nearest")
    roots = stored(components(first, "nearest-stars"), "nearest-roots")
    # The second round: what short lists have already given, and long lists once more, between components only.
    root_of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
    apart = pairs.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
    apart = apart.where(~(F.coalesce("a_root", "a") == F.coalesce("b_root", "b"))).select("a", "b")
    longest = long.where(F.col("k") > SKIP).join(roots, "node", "left")
    late = _not_far(_candidates(longest, least).join(pairs.select("a", "b"), ["a", "b"], "left_anti"), nodes, least)
    rest = apart.join(nearest, ["a", "b"], "left_anti").union(late.select("a", "b"))
    second = _verified(rest, nodes, least, "rest")
    final = components(first.union(second), "all-stars")
    classes = classes.join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = classes.join(smallest, "root").select("sid", "root", "component_id")
    rows = sets.select("id", "mark", "n", "sid").join(classes, "sid", "left")
    return rows.withColumn("component_id", F.when(F.col("sid").isNull(), F.col("id")).otherwise(F.col("component_id")))


def similar_classes(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, least: tuple[int, int] = LEAST, frequent: int = FREQUENT
) -> DataFrame:
    """A row for every document: its id, n_shingles and component_id."""
    rows = _row_classes(docs, id, text, shingle, least, frequent)
    return rows.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, least: tuple[int, int] = LEAST) -> DataFrame:
    """The document with the smallest id of each component, with the columns of ``docs``.

    Ids may repeat: of different texts of a component under its smallest id, the one with the smallest hash stays; equal
    rows (id and text; null counts as empty) are copies, of which one stays; a text of another component is untouched.
    Texts without words and rows without an id stay, for nothing can stand for them.
    """
    rows = _row_classes(docs.where(F.col(f"`{id}`").isNotNull()), id, text, shingle, least, FREQUENT)
    first = rows.where(F.col("component_id") == F.col("id")).groupBy(
        "root", F.when(F.col("root").isNull(), F.col("mark")).alias("own"), "id", "mark"
    )
    kept = first.agg(F.count("*").alias("copies")).groupBy("root", "own", "id").agg(
        F.min("mark").alias("mark"), F.min_by("copies", "mark").alias("copies")
    )
    number, mark = fresh("kept_id", docs.columns), fresh("kept_mark", docs.columns)
    kept = stored(kept.select(F.col("id").alias(number), F.col("mark").alias(mark), "copies"), "kept-rows")
    marked = docs.withColumns({number: F.col(f"`{id}`").cast("long"), mark: F.xxhash64(utf8(text))})

    def stays(wanted: DataFrame) -> DataFrame:
        return marked.join(broadcast_if_small(wanted.select(number, mark)), [number, mark], "left_semi")

    copied = kept.where("copies > 1")
    out = stays(kept.where("copies = 1"))
    if not copied.isEmpty():
        out = out.unionByName(stays(copied).dropDuplicates([number, mark]))
    nameless = marked.where(F.col(f"`{id}`").isNull())
    return out.unionByName(nameless).select(*[f"`{c}`" for c in docs.columns])
