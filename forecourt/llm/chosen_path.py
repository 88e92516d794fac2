"""Near-duplicate documents by a chosen-path set similarity join.

1. Each document's lower-cased words give a set of five-word shingles, kept as 64-bit hashes. Documents with one set are
   one class (by 128 bits of hash); everything after that works on classes, so copies cost nothing.
2. Each class has 128 minwise tokens. Each of eight independent trees branches all classes by one of them. A node too
   large to be compared is branched again, by two tokens chosen by the node, and so on. Two sets of similarity J share
   a tree's first node with probability J, so eight trees miss a pair of similarity 0.75 with probability 1.5e-5
   (``(1 - J) ** trees``); below that, two choices a level keep a pair with probability over 0.66 a tree at any depth.
3. Small nodes, of at most 2048 classes and 32 MB of sets, are compared exhaustively: first by their minwise tokens, at
   a bar that a pair at the threshold fails with probability 1e-5; then the full sets of classes that have a partner
   above the bar are brought to the node and compared exactly. A pair is compared in the first tree that has it in such
   a node. A node hands on a spanning forest of its links, never all pairs.
4. A node up to eight times as large is compared in blocks: each pair of blocks is a small node of its own. So is a
   node that is still larger at the last depth. No partner is dropped.
5. Components of the links give each document its class's smallest document id.

Full sets are made again from the text, only for classes that need them; texts are picked by a bitmap of fixed size before any
moves. Small nodes are bounded, so no task holds a group that grows with the corpus.

Defined results: a null or blank text has an empty set and is linked with nothing (its component is itself); fewer
than five words are one shingle; documents are rows: rows alike in id and text stay or go together, rows with one id
and different texts are judged by their texts; a row without an id has the component of its copies, or none, and is
kept only if it has none. Other columns pass through ``mark_duplicates``; those of the results' names are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import bitmap_test, documents, drop_names, free_name, hold, in_bitmap, text_key, text_or_empty, written
from forecourt.llm.components import components

WORDS = 5
PERCENT = 75  # similarity that links, in percent
TOKENS = 128  # minwise tokens per class
TREES = 8
LEAF = 2048  # classes that a node may have to be compared by one task
LEAF_SHINGLES = 1 << 22  # and shingles of all of them
ACROSS = 1024  # shingles that a node's sets are multiplied by at a time
WIDE = 8  # times as large a node is compared in blocks; beyond, it is branched
DEPTH = 8  # levels below the first
ALL = -1  # side of members that are compared with every other one
BAR = 0.58  # share of equal minwise tokens, 4.4 standard deviations below the threshold

RESULTS = ("n_shingles", "component_id", "kept")
_RANDOM = np.random.default_rng(20011)
_A = _RANDOM.integers(1, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, TOKENS, dtype=np.uint64)
_PLACE = _RANDOM.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_EMPTY = np.zeros(0, np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sorted shingle hashes of texts; remembers the hashes of words."""

    def __init__(self, remembered: int = 1 << 17):
        self.known: dict[bytes, int] = {}
        self.remembered = remembered

    def word(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self.known) >= self.remembered:
            self.known.clear()
        self.known[word] = value
        return value

    def of(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()  # of bytes: A-Z and ASCII white space only
        if not words:
            return _EMPTY
        get = self.known.get
        values = np.fromiter([v if (v := get(w)) is not None else self.word(w) for w in words], np.uint64, len(words))
        n = len(values) - WORDS + 1
        if n < 1:  # the length tells a short text from a shingle that begins alike
            mixed = _mixed((values * _PLACE[: len(values)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(values)))
            return mixed
        total = np.zeros(n, np.uint64)
        for i in range(WORDS):
            total += _mixed(values[i : i + n] * _PLACE[i])
        return np.unique(_mixed(total))


def minwise(values: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set: per function the smallest 32-bit hash."""
    out = np.full(TOKENS, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(values), 2048):
        part = values[at : at + 2048, None] * _A + _B
        np.minimum(out, (part >> np.uint64(32)).min(axis=0), out=out)
    return out.astype("<u4")


def _grouped(key: str, others: list[str], use: Callable[[int, list[list]], list[tuple]], out: list[str], types: list) -> Callable:
    """A function for ``mapInArrow`` over rows sorted by ``key``: calls ``use`` with the columns of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, rows = None, [[] for _ in others], []

        def flush() -> list[tuple]:
            return use(current, held) if held[0] else []

        for batch in batches:
            keys = batch.column(batch.schema.names.index(key)).to_numpy(zero_copy_only=False)
            columns = [batch.column(batch.schema.names.index(o)) for o in others]
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if keys[a] != current:
                    rows += flush()
                    current, held = keys[a], [[] for _ in others]
                for i, column in enumerate(columns):
                    held[i] += column.slice(a, b - a).to_pylist()
            if rows:
                yield _batch(rows, out, types)
                rows = []
        if rows := rows + flush():
            yield _batch(rows, out, types)

    return run


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


# --- 1. sets ----------------------------------------------------------------------------------------------------


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes, hashes and tokens of the sets of texts; what other stages remember in this worker goes."""
    hold("near duplicates", lambda: None)
    shingles = Shingles()
    for batch in batches:
        sizes, hashes, tokens = [], [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            own = shingles.of(text)
            sizes.append(len(own))
            hashes.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
            tokens.append(minwise(own).tobytes() if len(own) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("ka"), batch.column("kb"), pa.array(sizes, pa.int64()), pa.array(hashes, pa.binary()), pa.array(tokens, pa.binary())],
            ["id", "ka", "kb", "n", "c", "tokens"],
        )


def document_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, hash of the text (``key``), size of the set, ``c`` (the set's hash, null if empty), tokens."""

    key = text_key(text_col)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"), key["a"].alias("ka"), key["b"].alias("kb"))
    return rows.mapInArrow(set_rows, "id long, ka long, kb long, n long, c binary, tokens binary")


def full_sets(docs: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame | None:
    """``c`` and full set of the wanted classes (``c``, ``ka``, ``kb`` of one of their texts)."""
    bitmap = bitmap_test(wanted, "ka")
    if bitmap is None:
        return None
    key = text_key(text_col)
    texts = docs.select(text_or_empty(text_col).alias("text"), key["a"].alias("ka"), key["b"].alias("kb"))
    picked = texts.filter(in_bitmap(bitmap, F.col("ka"))).join(wanted, ["ka", "kb"]).select("c", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            own = [shingles.of(t).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("c"), pa.array(own, pa.binary())], ["c", "members"])

    return picked.mapInArrow(sets, "c binary, members binary").dropDuplicates(["c"])


# --- 2. trees ---------------------------------------------------------------------------------------------------


def _token(tokens: Column, number: int) -> Column:
    return F.substring(tokens, 4 * number + 1, 4)


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of nodes with at least two classes; ``parts`` says how many times as large as a small node theirs is."""
    parts = F.greatest(F.ceil(F.count("*") / LEAF), F.ceil(F.sum("n") / LEAF_SHINGLES)).cast("int")
    sizes = rows.groupBy("node").agg(F.count("*").alias("size"), parts.alias("parts")).filter("size > 1").drop("size")
    return rows.join(sizes, "node")


def _children(rows: DataFrame) -> DataFrame:
    """Two chosen tokens branch each node; a child is named by the path to it."""

    both = rows.withColumn("j", F.explode(F.array(F.lit(0), F.lit(1))))
    both = both.withColumn("choice", F.pmod(F.xxhash64("node", "j"), F.lit(TOKENS)).cast("int"))
    token = F.expr("substring(tokens, 4 * choice + 1, 4)")
    return both.withColumn("node", F.xxhash64("node", "j", token)).drop("j", "choice", "parts")


def _blocks(rows: DataFrame) -> DataFrame:
    """Large nodes as pairs of blocks that are nodes themselves; ``side`` tells the two blocks of a pair apart."""
    number = F.lit(2) * F.col("parts")
    own = rows.withColumn("own", F.pmod(F.xxhash64("c"), number).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), number - 1)))
    pair = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), ALL).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return other.withColumns({"node": pair, "side": side}).drop("own", "other")


# --- 3. nodes ---------------------------------------------------------------------------------------------------


def similar_members(node: int, columns: list[list]) -> list[tuple]:
    """(node, c) of the members that have a partner above the bar which no earlier node has compared with them."""
    hashes, tokens, trees, leaves, sides = columns
    own = np.frombuffer(b"".join(tokens), "<u4").reshape(-1, TOKENS)
    mask, side = np.asarray(leaves, np.int64), np.asarray(sides, np.int8)
    members: set[int] = set()
    for i in range(len(own) - 1):
        rest = own[i + 1 :]
        alike = np.flatnonzero((rest == own[i]).sum(axis=1) >= BAR * TOKENS)
        if side[i] != ALL:  # what lies on one side meets in a node of its own
            alike = alike[side[i + 1 :][alike] != side[i]]
        if len(alike):
            tree = trees[i]  # in a deeper node, TREES: all trees come before it
            shared = (rest[alike, :tree] == own[i, :tree]) & ((mask[i] & mask[i + 1 :][alike])[:, None] >> np.arange(tree) & 1).astype(bool)
            new = alike[~shared.any(axis=1)]
            if len(new):
                members.add(i)
                members.update((new + i + 1).tolist())
    return [(node, hashes[i]) for i in sorted(members)]


def forest(n: int, links: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """The links that join parts not joined before."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    kept = []
    for a, b in links:
        if (x := find(a)) != (y := find(b)):
            root[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def node_links(node: int, columns: list[list]) -> list[tuple]:
    """A spanning forest of the exact links among the full sets of a node."""
    hashes, members = columns
    sets = [np.frombuffer(m, np.uint64) for m in members]
    sizes = np.asarray([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    first = np.flatnonzero(np.diff(values[order], prepend=~values[order[:1]]))  # of each distinct value in that order
    counts = np.diff(first, append=len(order))
    del values
    often = counts > 1  # what only one set has adds nothing to an intersection
    rows = (np.searchsorted(ends, order[np.repeat(often, counts)], "right")).astype(np.int32)
    del order
    stops = np.append(0, np.cumsum(counts[often]))
    common = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, len(stops) - 1, ACROSS):  # counts are whole numbers below 2 ** 24, exact as floats
        own = stops[at : at + ACROSS + 1]
        table = np.zeros((len(sets), len(own) - 1), np.float32)
        table[rows[own[0] : own[-1]], np.repeat(np.arange(len(own) - 1), np.diff(own))] = 1
        common += table @ table.T

    def links() -> Iterator[tuple[int, int]]:
        for i in range(len(sets) - 1):  # a row at a time: a node of copies has as many links as pairs
            both = np.rint(common[i, i + 1 :]).astype(np.int64)
            linked = 100 * both >= PERCENT * (sizes[i] + sizes[i + 1 :] - both)
            for j in np.flatnonzero(linked).tolist():
                yield i, i + 1 + j

    return [(hashes[i], hashes[j]) for i, j in forest(len(sets), links())]


def _partners(rows: DataFrame) -> DataFrame:
    """``node`` and ``c`` of the classes that full sets are needed for."""
    columns = ["c", "tokens", "tree", "leaves", "side"]
    run = _grouped("node", columns, similar_members, ["node", "c"], [pa.int64(), pa.binary()])
    small = rows.filter("parts = 1").withColumn("side", F.lit(ALL)).select("node", *columns)
    wide = _blocks(rows.filter("parts > 1")).select("node", *columns)
    return small.union(wide).repartition("node").sortWithinPartitions("node").mapInArrow(run, "node long, c binary")


# --- 4. join ----------------------------------------------------------------------------------------------------


def similar_classes(docs: DataFrame, sets: DataFrame, text_col: str) -> DataFrame:
    """Links (``u``, ``v``) between classes, enough of them to connect all that are similar."""
    classes = written(
        sets.filter("c IS NOT NULL").groupBy("c").agg(F.min(F.struct("ka", "kb")).alias("key"), F.max("n").alias("n"), F.first("tokens").alias("tokens")),
        "classes",
    )
    first = F.array(*(F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), _token(F.col("tokens"), t)).alias("node")) for t in range(TREES)))
    nodes = written(_sized(classes.select("c", "n", F.explode(first).alias("f")).select("c", "n", "f.tree", "f.node")), "nodes")
    # Per class: the nodes it shares with others, and in which trees these are compared rather than branched.
    per_class = nodes.groupBy("c").agg(
        F.collect_list(F.struct("tree", "node", "parts")).alias("own"),
        F.sum(F.when(F.col("parts") <= WIDE, F.pow(F.lit(2), F.col("tree")).cast("long")).otherwise(0)).alias("leaves"),
    )
    rows = (
        per_class.join(classes.select("c", "n", "tokens"), "c")
        .select("c", "n", "tokens", "leaves", F.explode("own").alias("o"))
        .select("c", "n", "tokens", "leaves", "o.tree", "o.node", "o.parts")
    )
    partners = [_partners(rows.filter(F.col("parts") <= WIDE))]
    if not nodes.filter(F.col("parts") > WIDE).isEmpty():
        large = rows.filter(F.col("parts") > WIDE).withColumn("tree", F.lit(TREES))
        for depth in range(DEPTH):
            level = written(_sized(_children(large)), "level")
            most = WIDE if depth < DEPTH - 1 else None
            partners.append(_partners(level if most is None else level.filter(F.col("parts") <= most)))
            large = level.filter(F.col("parts") > WIDE)
            if large.isEmpty():
                break
    wanted = partners[0]
    for more in partners[1:]:
        wanted = wanted.union(more)
    wanted = written(wanted.distinct(), "partners")

    needed = wanted.select("c").distinct().join(classes.select("c", "key.ka", "key.kb"), "c")
    members = full_sets(docs, needed, text_col)
    if members is None:
        return wanted.select(F.col("c").alias("u"), F.col("c").alias("v")).limit(0)
    run = _grouped("node", ["c", "members"], node_links, ["u", "v"], [pa.binary(), pa.binary()])
    return wanted.join(members, "c").repartition("node").sortWithinPartitions("node").mapInArrow(run, "u binary, v binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id``, hash of its text (``ka``, ``kb``), ``n_shingles``, ``component_id``, ``kept``."""
    sets = written(document_sets(docs, id_col, text_col), "sets")
    linked = components(similar_classes(docs, sets, text_col))
    least = sets.filter("c IS NOT NULL").groupBy("c").agg(F.min("id").alias("least"))
    # Classes with links, with the smallest id of their component; all others have their own.
    ends = linked.select(F.col("node").alias("c"), "component").union(linked.select(F.col("component").alias("c"), "component")).distinct()
    joined = least.join(ends, "c", "left").withColumn("component", F.coalesce("component", "c"))
    smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = joined.join(smallest, "component").select("c", "component_id")
    found = sets.drop("tokens").join(of_class, "c", "left").withColumn(
        "component_id", F.when(F.col("c").isNull(), F.col("id")).otherwise(F.col("component_id"))
    )
    kept = F.when(F.col("id").isNull(), F.col("component_id").isNull()).otherwise(F.col("id") == F.col("component_id"))
    return found.select("id", "ka", "kb", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` and ``kept``."""
    docs = drop_names(docs, *RESULTS)
    key, m_id, m_a, m_b = (free_name(docs.columns, n) for n in ("key", "m_id", "m_a", "m_b"))
    marks = near_duplicates(docs, id_col, text_col).distinct().toDF(m_id, m_a, m_b, *RESULTS)
    joined = docs.withColumn(key, text_key(text_col)).join(
        marks,
        F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(m_id)) & (F.col(f"{key}.a") == F.col(m_a)) & (F.col(f"{key}.b") == F.col(m_b)),
    )
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns), *RESULTS)


def q_near_duplicates(spark, sf_dir):
    """Every document's component of near-duplicates, and whether it stays for it."""
    return near_duplicates(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")
