"""Removal of long passages that occurred before, by prefix-partitioned suffix trees over words.

Every place of a text where a whole window of words starts is a suffix. Suffixes are split by prefixes of variable
length: a prefix that too many suffixes share is made one word longer, and so on, until what shares it fits into the
memory of a task. Prefixes are dealt into groups of such a size. Within a group, suffixes are sorted; those that agree
on a whole window meet in one node of the group's tree at that depth (deeper levels are never needed, so paths end
there, and a path is known by its 64-bit hash). A node met by several documents is a repeat: all its suffixes but
those of its first document are reported. Consecutive ones join to maximal repeats in the document they are cut from.

A window that is too frequent even at full depth leaves the tree: its first document is found by an aggregate, and the
bounded list of such windows goes to all tasks. Its repeats are decided there and dealt to the groups by the row they are
cut from. So no group grows with the frequency of a passage.

Windows are judged on the input. Documents are ordered by ``doc_id``; rows of equal ``doc_id`` do not remove words
from each other, and rows without ``doc_id`` neither remove nor lose words. Null and empty texts have no words. Texts
of any length are taken whole. Equal rows are treated alike. Other columns are kept; names that this operator adds
replace older columns of that name. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distributary.llm.shared import arrow_schema
from distributary.llm.text import SPACED, U64, Texts, batch_of, covered, gram_hashes, spread_bits, texts_of, words_of

WINDOW = 13
GROUP_SUFFIXES = 2_000_000

COUNTS = "prefix long, n long, first_doc long"
PARTS = "group_id long, hashes binary, places binary"
BUCKETS = "bucket long, packed binary"
HITS = "doc_id long, tag long, at binary"

Hot = list[tuple[np.ndarray, np.ndarray]]


def member(values: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in a sorted list, and where."""
    if not len(listed):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    place = np.minimum(np.searchsorted(listed, values), len(listed) - 1)
    return listed[place] == values, place


class Suffixes:
    """Suffixes of a chunk: row, first word within its text, hash of the whole window, and of shorter prefixes."""

    def __init__(self, texts: Texts, ids: np.ndarray, window: int) -> None:
        words = words_of(texts, SPACED)
        self.hashes, self.rows = words.hashes(), words.rows()
        self.at, self.window = gram_hashes(self.hashes, self.rows, window)
        keep = ids[self.rows[self.at]] >= 0 if len(self.at) else np.zeros(0, bool)
        self.at, self.window = self.at[keep], self.window[keep]
        self.row = self.rows[self.at]
        self.place = self.at - words.bounds[self.row]
        self.size = window

    def prefixes(self, depth: int) -> np.ndarray:
        """Hash of the first ``depth`` words of every suffix."""
        if depth == self.size:
            return self.window
        at, value = gram_hashes(self.hashes, self.rows, depth)
        return value[np.searchsorted(at, self.at)]


def numbered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids as ranks that keep their order (-1 for null), and the ids by rank."""
    values = column.to_numpy(zero_copy_only=False)
    valid = np.asarray(column.is_valid())
    ids, rank = np.unique(values[valid].astype(np.int64), return_inverse=True)
    result = np.full(len(column), -1)
    result[valid] = rank
    return result, ids


def prefix_counts(documents: DataFrame, window: int, hot: Hot, least: int) -> DataFrame:
    """Suffixes per prefix, one word longer than ``hot``, of the suffixes whose shorter prefixes are all hot.

    A task leaves out prefixes that it has met fewer than ``least`` times, summing them up under no prefix.
    """
    schema, depth = arrow_schema(COUNTS), len(hot) + 1

    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        keys, n, first = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, n, first = keys[order], n[order], first[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
        if not len(starts):
            return keys, n, first
        return keys[starts], np.add.reduceat(n, starts), np.minimum.reduceat(first, starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            rank, ids = numbered(batch.column("doc_id"))
            for texts in texts_of(batch.column("text")):
                own = rank[texts.first : texts.first + len(texts)]
                suffixes = Suffixes(texts, own, window)
                open_ = np.ones(len(suffixes.at), dtype=bool)
                for i, (keys, _) in enumerate(hot):
                    open_ &= member(suffixes.prefixes(i + 1), keys)[0]
                docs = ids[own[suffixes.row[open_]]] if len(ids) else np.zeros(0, np.int64)
                parts.append(merged([(suffixes.prefixes(depth)[open_], np.ones(len(docs), np.int64), docs)]))
                if sum(len(p[0]) for p in parts) > 2_000_000:
                    parts = [merged(parts)]
                    if len(parts[0][0]) > 1_000_000:
                        keys, n, first = parts.pop()
                        yield batch_of(schema, [keys.view(np.int64), n, first])
        if parts:
            keys, n, first = merged(parts)
            few = n < least
            if few.any():
                yield batch_of(schema, [[None], [int(n[few].sum())], [None]])
            yield batch_of(schema, [keys[~few].view(np.int64), n[~few], first[~few]])

    counts = documents.select("doc_id", "text").mapInArrow(run, COUNTS)
    return counts.groupBy("prefix").agg(F.sum("n").alias("n"), F.min("first_doc").alias("first_doc"))


def hot_prefixes(documents: DataFrame, window: int, group_suffixes: int) -> tuple[Hot, int]:
    """Prefixes to be made longer, by length, and the number of suffixes. There are at most (suffixes / limit) each.

    Counts only balance the groups, so a task may keep a prefix to itself that is rare in it; what all tasks keep of
    one prefix stays below the limit. At full depth all are counted, as the first document is needed.
    """
    hot: Hot = []
    total, limit = 0, max(1, group_suffixes // 4)
    least = max(1, limit // documents.rdd.getNumPartitions())
    for depth in range(1, window + 1):
        counts = prefix_counts(documents, window, hot, least if depth < window else 1)
        # One job gives both: the prefixes over the limit, and the rest summed up.
        key = F.when(F.col("n") > limit, F.col("prefix"))
        rows = counts.groupBy(key.alias("prefix")).agg(F.sum("n").alias("n"), F.min("first_doc").alias("first_doc")).collect()
        if depth == 1:
            total = sum(r["n"] or 0 for r in rows)
        rows = [r for r in rows if r["prefix"] is not None]
        if not rows:
            break
        keys = np.array([r["prefix"] for r in rows], dtype=np.int64).view(U64)
        order = np.argsort(keys)
        hot.append((keys[order], np.array([r["first_doc"] for r in rows], dtype=np.int64)[order]))
    return hot, total


def pack(ids: np.ndarray, tags: np.ndarray, rows: np.ndarray, places: np.ndarray) -> bytes:
    """Rows (in order) and places of some suffixes; small, as neighbours differ little."""
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    steps = np.diff(places, prepend=0).astype(np.int32)
    counts = np.diff(np.append(starts, len(rows))).astype(np.int32)
    docs = rows[starts]
    parts = (np.array([len(docs), len(rows)], np.int64), np.diff(ids[docs], prepend=0), tags[docs], counts, steps)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in parts))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, tags and places of the suffixes in a packed part."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    docs, n = np.frombuffer(raw, np.int64, 2).tolist()
    ids = np.cumsum(np.frombuffer(raw, np.int64, docs, 16))
    tags = np.frombuffer(raw, np.uint32, docs, 16 + 8 * docs)
    counts = np.frombuffer(raw, np.int32, docs, 16 + 12 * docs)
    places = np.cumsum(np.frombuffer(raw, np.int32, n, 16 + 16 * docs), dtype=np.int64)
    return np.repeat(ids, counts), np.repeat(tags, counts), places


def dealt_suffixes(documents: DataFrame, window: int, hot: Hot, groups: int) -> DataFrame:
    """Suffixes by group. Repeats already seen within a chunk come without hash: they are hits in any case."""
    schema = arrow_schema(PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, ids = numbered(batch.column("doc_id"))
            all_tags = batch.column("tag").to_numpy(zero_copy_only=False).astype(np.uint32)
            for texts in texts_of(batch.column("text")):
                own = rank[texts.first : texts.first + len(texts)]
                tags = all_tags[texts.first : texts.first + len(texts)]
                suffixes = Suffixes(texts, own, window)
                n = len(suffixes.at)
                if not n:
                    continue
                row_ids = ids[np.maximum(own, 0)]
                doc = row_ids[suffixes.row]
                group = np.full(n, -1, dtype=np.int64)
                left, hit = np.arange(n), np.zeros(n, dtype=bool)
                for depth in range(1, window + 1):
                    keys = suffixes.prefixes(depth)[left]
                    is_hot, place = member(keys, hot[depth - 1][0] if depth <= len(hot) else keys[:0])
                    group[left[~is_hot]] = (keys[~is_hot] % U64(groups)).astype(np.int64)
                    left = left[is_hot]
                    if depth == window:
                        hit[left] = doc[left] > hot[depth - 1][1][place[is_hot]] if len(left) else False
                        # Decided already, so they need not meet in a node: dealt by row, as they may be very many.
                        group[left] = bucket_of(doc[left], tags[suffixes.row[left]], groups)
                    if not len(left):
                        break
                known = hit.copy()
                known[left] = True  # frequent at full depth
                order = np.lexsort((doc, suffixes.window))
                new = np.concatenate([[True], suffixes.window[order][1:] != suffixes.window[order][:-1]])
                first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
                later = doc[order] > doc[order][first]
                hit[order[later]] = True
                known[order[later]] = True
                rows: list[tuple[int, bytes, bytes]] = []
                for chosen, hashed in ((~known, True), (hit, False)):
                    at = np.flatnonzero(chosen)
                    at = at[np.argsort(group[at], kind="stable")]
                    cuts = np.flatnonzero(np.diff(group[at])) + 1
                    for part in np.split(at, cuts):
                        if len(part):
                            places = pack(row_ids, tags, suffixes.row[part], suffixes.place[part])
                            rows.append((int(group[part[0]]), suffixes.window[part].tobytes() if hashed else b"", places))
                for i in range(0, len(rows), 64):
                    yield batch_of(schema, list(zip(*rows[i : i + 64], strict=True)))

    return documents.select("doc_id", "text", "tag").mapInArrow(run, PARTS)


def bucket_of(doc: np.ndarray, tag: np.ndarray, buckets: int) -> np.ndarray:
    return (spread_bits(spread_bits(doc.view(U64)) + tag.astype(U64)) % U64(buckets)).astype(np.int64)


def group_hits(table: pa.Table, buckets: int) -> pa.Table:
    """Repeats of one group: suffixes that meet in a node at full depth with one of a smaller document.

    They are packed by buckets of documents, so that a bucket gets few rows from each group.
    """
    schema = arrow_schema(BUCKETS)
    hashes, ids, tags, places, hits = [], [], [], [], []
    for hashed, packed in zip(table.column("hashes").to_pylist(), table.column("places").to_pylist(), strict=True):
        part = unpack(packed)
        if hashed:
            hashes.append(np.frombuffer(hashed, dtype=U64))
            for store, values in zip((ids, tags, places), part, strict=True):
                store.append(values)
        else:
            hits.append(part)
    if hashes:
        node, doc = np.concatenate(hashes), np.concatenate(ids)
        order = np.lexsort((doc, node))
        node, sorted_doc = node[order], doc[order]
        new = np.concatenate([[True], node[1:] != node[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(len(node)), 0))
        chosen = order[sorted_doc > sorted_doc[first]]
        hits.append((doc[chosen], np.concatenate(tags)[chosen], np.concatenate(places)[chosen]))
    doc, tag, place = (np.concatenate(x) for x in zip(*hits, strict=True))
    bucket = bucket_of(doc, tag, buckets)
    order = np.lexsort((place, tag, doc, bucket))
    doc, tag, place, bucket = doc[order], tag[order], place[order], bucket[order]
    rows = []
    for part in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(bucket)) + 1):
        if len(part):
            own_doc, own_tag = doc[part], tag[part]
            row = np.cumsum(np.concatenate([[0], (own_doc[1:] != own_doc[:-1]) | (own_tag[1:] != own_tag[:-1])]))
            _, at = np.unique(row, return_index=True)
            rows.append((int(bucket[part[0]]), pack(own_doc[at], own_tag[at], row, place[part])))
    return pa.table(batch_of(schema, list(zip(*rows, strict=True)) if rows else [[], []]).to_pydict(), schema=schema)


def bucket_hits(table: pa.Table) -> pa.Table:
    """One row per document with all its hits."""
    schema = arrow_schema(HITS)
    doc, tag, place = (np.concatenate(x) for x in zip(*map(unpack, table.column("packed").to_pylist()), strict=True))
    order = np.lexsort((place, tag, doc))
    doc, tag, place = doc[order], tag[order], place[order].astype("<u4")
    starts = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]))
    offsets = (np.append(starts, len(doc)) * 4).astype(np.int32)
    at = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(place)])
    return pa.table([pa.array(doc[starts]), pa.array(tag[starts].astype(np.int64)), at], schema=schema)


def compressed(documents: DataFrame) -> DataFrame:
    """``text`` as ``packed_text``: whole texts take less room in the shuffle that brings the hits to them."""
    names = [c for c in documents.columns if c != "text"]
    schema = documents.select(*names).withColumn("packed_text", F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [squeeze.compress(t.as_buffer()) if t.is_valid else None for t in batch.column("text")]
            columns = [*(batch.column(c) for c in names), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "packed_text"])

    return documents.mapInArrow(run, schema)


def tagged(documents: DataFrame) -> DataFrame:
    """``tag`` tells rows of equal ``doc_id`` apart by their texts."""
    return (
        documents.withColumn("doc_id", F.col("doc_id").cast("long"))
        .withColumn("text", F.col("text").cast("string"))
        .withColumn("tag", F.xxhash64("text").bitwiseAND(0xFFFFFFFF))
    )


def repeats(documents: DataFrame, window: int = WINDOW, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """Per ``doc_id`` and ``tag``, the places (32-bit integers) where repeated windows start."""
    documents = tagged(documents)
    hot, total = hot_prefixes(documents, window, group_suffixes)
    groups = max(1, -(-total // group_suffixes))
    by_group = dealt_suffixes(documents, window, hot, groups).groupBy("group_id")
    found = by_group.applyInArrow(lambda table: group_hits(table, groups), BUCKETS)
    return found.groupBy("bucket").applyInArrow(bucket_hits, HITS)


def removal(words: int, at: bytes | None, window: int) -> np.ndarray:
    """Marks the words under repeated windows; marked runs are the maximal repeats."""
    starts = np.frombuffer(at or b"", dtype="<u4").astype(np.int64)
    return covered(starts, window, words)


def spans_of(marked: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(marked.astype(np.int8), prepend=0, append=0))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def without_repeats(
    documents: DataFrame, window: int = WINDOW, group_suffixes: int = GROUP_SUFFIXES, as_text: bool = True
) -> DataFrame:
    """All rows with ``n_words``, ``n_removed``, ``removed_spans``, and the kept words joined by single spaces.

    Texts that lose nothing stay as they are, unless ``as_text`` is false: then ``text`` becomes ``kept_sha256``, the
    digest of the joined words of every text.
    """
    added = ["n_words", "n_removed", "removed_spans", "kept_sha256", "tag", "at", "packed_text"]
    documents = documents.drop(*added)
    found = repeats(documents, window, group_suffixes)
    joined = compressed(tagged(documents)).join(found, ["doc_id", "tag"], "left").drop("tag")
    plain = [c for c in documents.columns if as_text or c != "text"]
    target = tagged(documents).select(*plain).withColumns({
        "n_words": F.lit(0).cast("long"),
        "n_removed": F.lit(0).cast("long"),
        "removed_spans": F.array(F.struct(F.lit(0).alias("first"), F.lit(0).alias("after"))),
        **({} if as_text else {"kept_sha256": F.lit("")}),
    })
    schema = target.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, expand = [f.name for f in schema.fields], zstandard.ZstdDecompressor()
        for batch in batches:
            counts, removed, spans, texts = [], [], [], []
            for packed, at in zip(batch.column("packed_text").to_pylist(), batch.column("at").to_pylist(), strict=True):
                raw = b"" if packed is None else expand.decompress(packed)
                words = raw.split()
                marked = removal(len(words), at, window)
                counts.append(len(words))
                removed.append(int(marked.sum()))
                spans.append([{"first": a, "after": b} for a, b in spans_of(marked)])
                kept = [w for w, gone in zip(words, marked.tolist(), strict=True) if not gone] if removed[-1] else words
                if as_text:
                    texts.append(None if packed is None else (b" ".join(kept) if removed[-1] else raw).decode())
                else:
                    texts.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            columns = {c: batch.column(c) for c in plain if c != "text"} | {"n_words": counts, "n_removed": removed, "removed_spans": spans}
            columns |= {"text": texts} if as_text else {"kept_sha256": texts}
            kinds = {"removed_spans": pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))}
            kinds |= {"n_words": pa.int64(), "n_removed": pa.int64(), "text": pa.string(), "kept_sha256": pa.string()}
            arrays = [columns[c] if isinstance(columns[c], pa.Array) else pa.array(columns[c], kinds[c]) for c in names]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return joined.mapInArrow(run, schema)


def kept_digests(documents: DataFrame) -> DataFrame:
    """Per document: words, removed words, and the digest of what is left."""
    frame = without_repeats(documents.select("doc_id", "text"), as_text=False)
    return frame.select("doc_id", "n_words", "n_removed", "kept_sha256")
