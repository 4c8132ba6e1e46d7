"""Near duplicates by an LSH forest of MinHash signatures.

Each text is the set of its word shingles. Equal sets form a class; one signature per class goes on. A tree of the
forest is one order of the signature's values; all classes are sorted by it across the cluster. Classes that agree on
its first ``DEPTH`` values form a region. Within a sparse region, the candidates of a class are all others, up to
``NEIGHBOURS`` of them; in a dense one only the next in sorted order, with the longest common prefix, so the depth that
a candidate must share grows with the density. Ranges, not regions, are dealt to tasks, so a dense region is spread.

Candidates are confirmed on the full sets. Classes joined by candidates or by a dense region form a cluster, and each
set travels once to the task of its cluster (a cluster of too many shingles is cut into blocks, with a task for each
pair of blocks). A task confirms candidates from the likeliest on, skipping those whose sides are linked already: as
components are asked for, links between linked sides do not matter.

Where a neighbourhood was cut short (more than ``NEIGHBOURS`` followed in a region) there may be links beyond the
candidates. For members of such regions the task counts the shared shingles of all of them through an inverted index
of its sets, unless they are linked already. So nothing is lost to the limit of neighbours.

Rows of equal ``doc_id`` are one document with several texts: they always share a component. Null, empty and wordless
texts have no shingles and are linked with nothing, as are rows without ``doc_id`` (``component_id`` null, kept).
Texts of any length are taken whole. Other columns are not looked at. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distributary.llm.shared import arrow_schema, spent_tables, written
from distributary.llm.text import SPACED, U64, Words, batch_of, constants, gram_hashes, spread_bits, texts_of, whole_hash, words_of

PERCENT = 80
TREES = 24
DEPTH = 4
TAIL = 4
NEIGHBOURS = 8
TASK_NODES = 500_000
BLOCK_SHINGLES = 4_000_000
SIGNATURE = TREES * DEPTH

ROWS = "doc_id long, n_shingles long, fp1 long, fp2 long, signature binary"
SETS = "doc_id long, fp1 long, shingles binary"
ENTRIES = "tree int, region long, tail long, node long, n long"
FOUND = "kind int, a long, b long, weight long, part int, place long, size long, tree int, region long, tail long, n long"
PAIR, EDGE, CUT, NEXT = 0, 1, 2, 3  # candidates; ends of tasks; regions cut short; mere neighbours in a region


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    hashes = words.hashes()
    at, value = gram_hashes(hashes, words.rows(), size)
    low = np.searchsorted(at, words.bounds[:-1])
    high = np.searchsorted(at, words.bounds[1:])
    counts = words.counts()
    sets = []
    for i, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
        if b > a:
            sets.append(np.unique(value[a:b]))
        elif counts[i]:
            sets.append(np.array([whole_hash(hashes[words.bounds[i] : words.bounds[i + 1]])], dtype=U64))
        else:
            sets.append(np.zeros(0, U64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (32 bits each), one row per set; none of the sets may be empty."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    factors, shifts = constants(SIGNATURE, 5), constants(SIGNATURE, 6)
    result = np.empty((len(sets), SIGNATURE), dtype=np.uint32)
    for i in range(SIGNATURE):
        value = (((flat ^ shifts[i]) * factors[i]) >> U64(32)).astype(np.uint32)
        result[:, i] = np.minimum.reduceat(value, starts)
    return result


def sums_of(sets: list[np.ndarray]) -> np.ndarray:
    """Two independent 64-bit hashes of each whole set."""
    return np.array(
        [[int((spread_bits(s ^ c)).sum(dtype=U64)) for c in constants(2, 9)] for s in sets], dtype=U64
    ).reshape(-1, 2)


def documents_as_sets(documents: DataFrame, shingle: int) -> DataFrame:
    schema = arrow_schema(ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                sets = shingle_sets(words_of(texts.lowered(), SPACED), shingle)
                sums = sums_of(sets).view(np.int64)
                packed: list[bytes | None] = [None] * len(sets)
                filled = [i for i, s in enumerate(sets) if len(s)]
                if filled:
                    for i, row in zip(filled, signatures([sets[i] for i in filled]), strict=True):
                        packed[i] = row.tobytes()
                ids = batch.column("doc_id").slice(texts.first, len(texts))
                yield batch_of(schema, [ids, [len(s) for s in sets], sums[:, 0], sums[:, 1], packed])

    return documents.mapInArrow(run, ROWS)


def forest(classes: DataFrame) -> DataFrame:
    """An entry per class and tree: its region (the first values of that order) and the values that follow."""
    schema = arrow_schema(ENTRIES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 2000) for i in range(0, len(batch), 2000)):
                packed = b"".join(part.column("signature").to_pylist())
                values = np.frombuffer(packed, dtype=np.uint32).reshape(len(part), SIGNATURE).astype(U64)
                for tree in range(TREES):
                    order = np.roll(values, -tree * DEPTH, axis=1)
                    region = (order[:, :DEPTH] * constants(DEPTH, 31)).sum(axis=1, dtype=U64)
                    tail = np.zeros(len(part), dtype=U64)
                    for j in range(TAIL):  # 16 bits of each, so that common prefixes of the tail stay adjacent
                        tail = tail << U64(16) | (order[:, DEPTH + j] & U64(0xFFFF))
                    yield batch_of(schema, [
                        np.full(len(part), tree), spread_bits(region).view(np.int64), tail.view(np.int64),
                        part.column("node"), part.column("n"),
                    ])

    return classes.select("node", "n", "signature").mapInArrow(run, ENTRIES)


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of leading values that two tails share."""
    differ = (a ^ b).view(U64)
    return sum((differ >> U64(48 - 16 * j) == 0).astype(np.int64) for j in range(TAIL))


def close_enough(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether two set sizes allow the similarity at all."""
    return 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)


def neighbours(entries: DataFrame) -> DataFrame:
    """Candidate pairs in all sorted orders. Kinds of rows: pairs, entries at the edges of tasks, regions cut short."""
    schema = arrow_schema(FOUND)
    zeros, names = {f.name: 0 for f in schema}, entries.columns
    ordered = entries.repartitionByRange("tree", "region", "tail", "node").sortWithinPartitions("tree", "region", "tail", "node")

    def rows(count: int, /, **columns: object) -> pa.RecordBatch:
        return batch_of(schema, [np.broadcast_to(columns.get(f, zeros[f]), count) for f in schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, first = TaskContext.get().partitionId(), 0, None
        kept: list[np.ndarray] = [np.zeros(0, np.int64)] * 5
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names]
            old = len(kept[0])
            cols = [np.concatenate([a, b]) for a, b in zip(kept, new, strict=True)]
            tree, region, tail, node, n = cols
            total = len(tree)
            # Entries that more than NEIGHBOURS follow in their region, as far as is known by now.
            dense = np.zeros(total, dtype=bool)
            reach = NEIGHBOURS + 1
            dense[:-reach] = (tree[:-reach] == tree[reach:]) & (region[:-reach] == region[reach:])
            dense[reach:] |= dense[:-reach].copy()
            for j in range(1, NEIGHBOURS + 2):
                low = max(0, old - j)  # the second of the pair must be new
                if total - j <= low:
                    break
                a, b = slice(low, total - j), slice(low + j, total)
                same = (tree[a] == tree[b]) & (region[a] == region[b])
                if j > NEIGHBOURS:
                    cut = np.unique(np.stack([tree[a][same], region[a][same]]), axis=1)
                    if cut.shape[1]:
                        yield rows(cut.shape[1], kind=CUT, tree=cut[0], region=cut[1])
                    break
                close = close_enough(n[a], n[b])
                if j > 1:
                    close &= ~dense[a.start : a.stop]
                for kind, chosen in ((PAIR, same & close), (NEXT, same & ~close & (j == 1))):
                    x, y = node[a][chosen], node[b][chosen]
                    weight = DEPTH + common(tail[a][chosen], tail[b][chosen])
                    if len(x):
                        yield rows(len(x), kind=kind, a=np.minimum(x, y), b=np.maximum(x, y), weight=weight, place=int(j == 1))
            seen += total - old
            if first is None or len(first[0]) < NEIGHBOURS + 1:
                joined = new if first is None else [np.concatenate([a, b]) for a, b in zip(first, new, strict=True)]
                first = [c[: NEIGHBOURS + 1] for c in joined]
            kept = [c[-(NEIGHBOURS + 1) :] for c in cols]
        if seen:
            for at, edge in ((0, first), (max(0, seen - NEIGHBOURS - 1), kept)):
                tree, region, tail, node, n = edge
                place = at + np.arange(len(tree))
                yield rows(len(tree), kind=EDGE, a=node, part=part, place=place, size=seen, tree=tree, region=region, tail=tail, n=n)

    return ordered.mapInArrow(run, FOUND)


def across_tasks(found: DataFrame) -> DataFrame:
    """Pairs whose two entries are at the ends of neighbouring tasks: few rows per task, so one task takes them."""
    schema = arrow_schema(FOUND)
    columns = ["part", "place", "size", "tree", "region", "tail", "a", "n"]
    edges = found.filter(F.col("kind") == EDGE).select(*columns).repartition(1).sortWithinPartitions("part", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = list(batches)
        if not tables:
            return
        cols = [np.concatenate([t.column(c).to_numpy(zero_copy_only=False) for t in tables]) for c in columns]
        part, place, size, tree, region, tail, node, n = (c.astype(np.int64) for c in cols)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        before = np.concatenate([[0], np.cumsum(size[starts])])[:-1]
        at = place + np.repeat(before, np.diff(np.append(starts, len(part))))
        for j in range(1, 2 * (NEIGHBOURS + 1) + 2):
            a, b = slice(0, -j), slice(j, None)
            step = at[b] - at[a]
            same = (tree[a] == tree[b]) & (region[a] == region[b]) & (part[a] != part[b])
            cut = same & (step == NEIGHBOURS + 1)
            close = close_enough(n[a], n[b])
            pair, following = same & (step <= NEIGHBOURS) & close, same & (step == 1) & ~close
            for chosen, kind in ((pair, PAIR), (following, NEXT), (cut, CUT)):
                k = int(chosen.sum())
                if k:
                    x, y = node[a][chosen], node[b][chosen]
                    zero = np.zeros(k, np.int64)
                    weight = DEPTH + common(tail[a][chosen], tail[b][chosen])
                    yield batch_of(schema, [
                        np.full(k, kind), np.minimum(x, y), np.maximum(x, y), weight, zero, (step[chosen] == 1), zero,
                        tree[a][chosen], region[a][chosen], zero, zero,
                    ])

    return edges.mapInArrow(run, FOUND)


def sets_of(documents: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """``shingles`` of the classes in ``nodes`` (``node``, ``fp1``), taken from a text of each, with their columns."""
    schema = arrow_schema(SETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                sets = shingle_sets(words_of(texts.lowered(), SPACED), shingle)
                ids = batch.column("doc_id").slice(texts.first, len(texts))
                yield batch_of(schema, [ids, sums_of(sets).view(np.int64)[:, 0], [s.tobytes() for s in sets]])

    asked = nodes.select(F.col("node").alias("doc_id"))
    sets = documents.join(asked, "doc_id", "left_semi").mapInArrow(run, SETS).withColumnRenamed("doc_id", "node")
    return sets.dropDuplicates(["node", "fp1"]).join(nodes, ["node", "fp1"])


def alike(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two sets reach the similarity."""
    both = np.sort(np.concatenate([one, other]))
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= PERCENT * (len(both) - shared)


class Task:
    """Sets of a cluster, or of two blocks of one, and the links found among them."""

    def __init__(self, one: int, other: int) -> None:
        self.one, self.other = one, other
        self.sets: dict[int, list[np.ndarray]] = {}  # several where an id has several texts
        self.dense: list[tuple[int, int, np.ndarray]] = []  # node, block and set
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        while self.parent[node] != node:
            self.parent[node] = self.parent[self.parent[node]]
            node = self.parent[node]
        return node

    def add(self, node: int, block: int, dense: bool, shingles: bytes) -> None:
        values = np.frombuffer(shingles, dtype=U64)
        self.sets.setdefault(node, []).append(values)
        self.parent.setdefault(node, node)
        if dense:
            self.dense.append((node, block, values))

    def confirm(self, a: int, b: int) -> bool:
        """Links two nodes if their sets are similar enough and they are not linked yet."""
        x, y = self.root(a), self.root(b)
        if x == y:
            return False
        if not any(alike(one, other) for one in self.sets[a] for other in self.sets[b]):
            return False
        self.parent[max(x, y)] = min(x, y)
        return True

    def beyond_candidates(self) -> Iterator[tuple[int, int]]:
        """Links among members of dense regions: shared shingles of each with all others, by an inverted index."""
        nodes = np.array([n for n, _, _ in self.dense], dtype=np.int64)
        roots = np.array([self.root(n) for n in nodes.tolist()])
        listed, counts = np.unique(roots, return_counts=True)
        if len(listed) < 2:
            return
        sizes = np.array([len(s) for _, _, s in self.dense])
        owner = np.repeat(np.arange(len(nodes)), sizes)
        _, token = np.unique(np.concatenate([s for _, _, s in self.dense]), return_inverse=True)
        order = np.argsort(token, kind="stable")
        holders = owner[order]  # owners by token
        often = np.bincount(token)
        first = np.cumsum(often) - often
        begins = np.cumsum(sizes) - sizes
        blocks = np.array([b for _, b, _ in self.dense])
        # Every link between two components has a side outside the largest one.
        asking = np.flatnonzero((roots != listed[counts.argmax()]) & (blocks == self.one) if self.one == self.other else blocks == self.one)
        for i in asking.tolist():
            own = token[begins[i] : begins[i] + sizes[i]]
            n = often[own]
            at = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            shared = np.bincount(holders[at], minlength=len(nodes))
            close = 100 * shared >= PERCENT * (sizes[i] + sizes - shared)
            for j in np.flatnonzero(close & (blocks == self.other)).tolist():
                a, b = int(nodes[i]), int(nodes[j])
                x, y = self.root(a), self.root(b)
                if x != y:
                    self.parent[max(x, y)] = min(x, y)
                    yield a, b


def confirmed(work: DataFrame) -> DataFrame:
    """Links of all tasks: rows are the sets and then the candidates of each, the likeliest first."""
    schema = "a long, b long"
    key = ["cluster", "one", "other"]
    dealt = work.repartition(*key).sortWithinPartitions(*key, "is_pair", F.desc("weight"), "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, now = Task(0, 0), None
        links: list[tuple[int, int]] = []
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, len(batch), 1000)):
                for row in zip(*(part.column(c).to_pylist() for c in work_columns), strict=True):
                    cluster, one, other, is_pair, a, b, _, dense, shingles = row
                    if (cluster, one, other) != now:
                        links += task.beyond_candidates()
                        task, now = Task(one, other), (cluster, one, other)
                    if not is_pair:
                        task.add(a, b, dense, shingles)
                    elif task.confirm(a, b):
                        links.append((a, b))
                if links:
                    yield batch_of(arrow_schema(schema), list(zip(*links, strict=True)))
                    links = []
        links += task.beyond_candidates()
        if links:
            yield batch_of(arrow_schema(schema), list(zip(*links, strict=True)))

    work_columns = ["cluster", "one", "other", "is_pair", "a", "b", "weight", "dense", "shingles"]
    return dealt.select(*work_columns).mapInArrow(run, schema)


def without_settled(pairs: DataFrame, dense: DataFrame) -> DataFrame:
    """Candidates without those between two members of dense regions that are nobody's nearest neighbours.

    The search beyond candidates covers these two, whichever sparse region they also met in.
    """
    one, other = (dense.select(F.col("node").alias(c)) for c in ("a", "b"))
    far = pairs.filter("nearest = 0")
    alone = far.join(one, "a", "left_anti").select(*pairs.columns)
    mixed = far.join(other, "b", "left_anti").join(one, "a", "left_semi").select(*pairs.columns)
    return pairs.filter("nearest = 1").union(alone).union(mixed)


def links_of(documents: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """Links between classes, enough to connect all that are connected."""
    entries = written(forest(classes), "forest")
    found = written(neighbours(entries), "neighbours")
    found = found.unionByName(written(across_tasks(found), "across-tasks"))
    pairs = found.filter(F.col("kind") == PAIR).groupBy("a", "b")
    pairs = written(pairs.agg(F.sum("weight").alias("weight"), F.max("place").alias("nearest")), "pairs")
    cut = found.filter(F.col("kind") == CUT).select("tree", "region").distinct()
    dense = entries.join(cut, ["tree", "region"], "left_semi").select("node").distinct().withColumn("dense", F.lit(True))
    # Taken in the order they were found in: a task holds whole stretches of a region and joins them to few stars.
    joined = components(found.filter(F.col("kind").isin(PAIR, NEXT)).select("a", "b"))
    # A cluster's smallest node is its name; clusters of mere neighbours that are not dense have no pair to confirm.
    named = joined.union(joined.select(F.col("root").alias("node"), "root").distinct())
    nodes = classes.select("node", "fp1", "n").join(named, "node").join(dense, "node", "left")
    sizes = nodes.groupBy("root").agg(F.sum("n").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK_SHINGLES).cast("long").alias("blocks")
    nodes = nodes.join(sizes.select("root", blocks), "root")
    nodes = nodes.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    nodes = written(nodes.select("node", "fp1", "root", "blocks", "block", F.coalesce("dense", F.lit(False)).alias("dense")), "nodes")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with")
    sets = sets_of(documents, nodes, shingle).select("*", other)
    nothing = F.lit(None)
    sets = sets.select(
        F.col("root").alias("cluster"), F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"),
        F.lit(False).alias("is_pair"), F.col("node").alias("a"), F.col("block").alias("b"), F.lit(0).cast("long").alias("weight"),
        "dense", "shingles",
    )
    placed = lambda c: nodes.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"), F.col("block").alias(f"block_{c}"))
    asked = without_settled(pairs, dense).join(placed("a"), "a").join(placed("b").drop("root_b"), "b").select(
        F.col("root_a").alias("cluster"), F.least("block_a", "block_b").alias("one"),
        F.greatest("block_a", "block_b").alias("other"), F.lit(True).alias("is_pair"), "a", "b", "weight",
        F.lit(False).alias("dense"), nothing.cast("binary").alias("shingles"),
    )
    return written(confirmed(sets.union(asked)), "links")


def joined_within_tasks(edges: DataFrame) -> DataFrame:
    """Edges ``a`` < ``b`` of the same components: a task replaces what it sees by stars around the smallest node."""
    schema = "a long, b long"

    def stars(parent: dict[int, int]) -> pa.RecordBatch:
        rows = [(root_of(parent, n), n) for n in parent if parent[n] != n]
        return batch_of(arrow_schema(schema), list(zip(*rows, strict=True)) if rows else [[], []])

    def root_of(parent: dict[int, int], n: int) -> int:
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = root_of(parent, parent.setdefault(a, a)), root_of(parent, parent.setdefault(b, b))
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > TASK_NODES:
                yield stars(parent)
                parent = {}
        yield stars(parent)

    return edges.select("a", "b").mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of all nodes on edges ``a``, ``b`` but the roots.

    In turn, the larger and the smaller neighbours of every node are hung below its smallest neighbour, until every
    node hangs below one root that hangs below none. Edges that several tasks arrive at are kept once, so what the joins
    of a turn take does not grow with the number of tasks. Each half of a turn is written, as two of them in one task
    would need two Python processes.
    """
    stars = written(joined_within_tasks(edges).distinct(), "edges")
    while True:
        ends = stars.select(F.col("b").alias("node"), "a").union(stars.select(F.col("a").alias("node"), "a"))
        unsettled = ends.groupBy("node").agg(F.min("a").alias("low"), F.max("a").alias("high")).filter("low < high")
        if unsettled.isEmpty():
            return stars.select(F.col("b").alias("node"), F.col("a").alias("root")).distinct()
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b")
        up = written(joined_within_tasks(large).select(F.col("b").alias("a"), F.col("a").alias("b")), "edges-up")
        least = up.groupBy("a").agg(F.min("b").alias("m"))
        joined = up.join(least, "a")
        small = joined.filter("b > m").select(F.col("m").alias("a"), "b").union(joined.select(F.col("m").alias("a"), F.col("a").alias("b")))
        stars = written(joined_within_tasks(small).distinct(), "edges")


def near_duplicates(documents: DataFrame, shingle: int) -> DataFrame:
    """Per row: ``doc_id``, size of its set, smallest ``doc_id`` of its component, and whether it is that document.

    These are written; signatures, candidates and links on the way to them are deleted then.
    """
    documents = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    with spent_tables(documents.sparkSession) as folders:
        found = written(rooted(documents, shingle), "near-duplicates")
        folders.pop()
    return found.withColumn("kept", kept())


def rooted(documents: DataFrame, shingle: int) -> DataFrame:
    """Per row: ``doc_id``, size of its set, and smallest ``doc_id`` of its component."""
    rows = written(documents_as_sets(documents, shingle), "sets")
    real = rows.filter("doc_id is not null and n_shingles > 0")
    classes = real.groupBy("fp1", "fp2").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")
    )
    classes = written(classes, "classes")
    several = real.groupBy("doc_id").agg(F.count_distinct("fp1", "fp2").alias("k")).filter("k > 1").select("doc_id")
    own = real.join(several, "doc_id", "left_semi").join(classes.select("fp1", "fp2", "node"), ["fp1", "fp2"])
    same = own.select(F.least("doc_id", "node").alias("a"), F.greatest("doc_id", "node").alias("b"))
    labels = written(components(links_of(documents, classes, shingle).union(same)), "labels")
    named = classes.select("fp1", "fp2", "node").join(labels, "node", "left")
    named = named.select("fp1", "fp2", F.coalesce("root", "node").alias("class_root"))
    found = rows.join(named, ["fp1", "fp2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("class_root")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return found.select("doc_id", "n_shingles", component.alias("component_id"))


def kept() -> Column:
    return F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
