"""URL filters: rules by host and path, and exact list membership by a cascade of Bloom filters.

Listed keys go into a Bloom filter. The keys of the corpus that are not listed but pass it by chance go into a second
filter, the listed ones that pass the second by chance into a third, and so on until nobody passes wrongly. The first
level that a key does not pass then decides it, exactly, for every key of the corpus: no join is needed.

Keys are split by hash into segments of bounded size with a cascade each, built by one task per segment from the
distinct keys.

Keys are known by 64-bit hashes. Should a listed and another key have the same hash, no filter
can tell them apart: both stay out of the cascades, and the listed ones of such keys are kept as texts beside them (one
in 2^64 pairs; more than ``TWINS`` are refused).

Verdicts are given in one narrow pass over the pages with all cascades at hand, or, where those exceed
``BROADCAST_BYTES``, in one such pass per block of segments.

A URL's host is what stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, in lower case
(A-Z); its path goes on to ``?``, ``#`` or the end. Null and other texts have neither (both are empty). Equal rows are
treated alike; other columns are not looked at. Keys that are null are not listed. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distributary.llm.shared import BROADCAST_BYTES, arrow_schema, written
from distributary.llm.text import U64, batch_of, constants, range_hashes, spread_bits, texts_of

SEGMENT_KEYS = 1_000_000
BITS_PER_KEY = 10
PROBES = 5
TWINS = 100_000

# Rules as (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

CASCADES = "segment long, levels binary, sizes binary, twins binary"

Hashes = Callable[[pa.Array], np.ndarray]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; longest by host, then by path."""
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def key_of(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit(" "), path)


def key_hashes(column: pa.Array) -> np.ndarray:
    found = [range_hashes(t.data, t.offsets[:-1], t.offsets[1:]) for t in texts_of(column)]
    return np.concatenate([np.zeros(0, U64), *found])


def probes(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Bit positions of each key in the filter of a level."""
    first = spread_bits(keys ^ constants(1, 100 + level)[0])
    second = spread_bits(keys + constants(1, 200 + level)[0]) | U64(1)
    return np.stack([(first + U64(i) * second) % U64(bits) for i in range(PROBES)])


def passes(bitset: np.ndarray, keys: np.ndarray, level: int) -> np.ndarray:
    at = probes(keys, level, 8 * len(bitset))
    return (bitset[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8) & 1).all(axis=0)


def cascade(listed: np.ndarray, others: np.ndarray) -> list[np.ndarray]:
    """Bit sets of all levels for two sets of key hashes that have none in common."""
    levels: list[np.ndarray] = []
    inside, outside = listed, others
    while len(inside):
        bits = np.zeros(8 * (-(-len(inside) * BITS_PER_KEY // 8)), dtype=bool)
        bits[probes(inside, len(levels), len(bits)).ravel().astype(np.int64)] = True
        levels.append(np.packbits(bits, bitorder="little"))
        inside, outside = outside[passes(levels[-1], outside, len(levels) - 1)], inside
    return levels


def listed_by(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Membership: the number of levels passed before the first one that refuses is odd for listed keys."""
    passed = np.zeros(len(keys), dtype=np.int64)
    left = np.arange(len(keys))
    for i, bitset in enumerate(levels):
        left = left[passes(bitset, keys[left], i)]
        passed[left] += 1
    return passed % 2 == 1


def cascades(keys: DataFrame, segment_keys: int = SEGMENT_KEYS, hashes: Hashes = key_hashes) -> tuple[DataFrame, int]:
    """A cascade per segment from distinct ``key``, ``listed``, with hashes of both kinds; and the number of segments."""
    total = keys.count()
    segments = max(1, -(-total // segment_keys))
    schema = "segment long, hash long, listed boolean"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = hashes(batch.column("key"))
            segment = (value >> U64(32)) % U64(segments)
            yield batch_of(arrow_schema(schema), [segment.astype(np.int64), value.view(np.int64), batch.column("listed")])

    def build(table: pa.Table) -> pa.Table:
        value = table.column("hash").to_numpy().view(U64)
        listed = table.column("listed").to_numpy()
        twins = np.intersect1d(value[listed], value[~listed])
        listed, others = (np.setdiff1d(x, twins) for x in (value[listed], value[~listed]))
        levels = cascade(listed, others)
        sizes = np.array([len(x) for x in levels], dtype=np.int64)
        packed = np.concatenate([np.zeros(0, np.uint8), *levels])
        row = [[table.column("segment")[0].as_py()], *([x.tobytes()] for x in (packed, sizes, twins))]
        return pa.Table.from_batches([batch_of(arrow_schema(CASCADES), row)])

    parts = keys.select("key", "listed").mapInArrow(hashed, schema)
    return parts.groupBy("segment").applyInArrow(build, CASCADES), segments


def listed_twins(keys: DataFrame, built: DataFrame, hashes: Hashes) -> tuple[np.ndarray, set[str]]:
    """Hashes that listed and other keys share, and the listed keys among those that have one."""
    shared = built.filter(F.length("twins") > 0)
    if (shared.agg(F.sum(F.length("twins"))).first()[0] or 0) > 8 * TWINS:
        raise ValueError(f"more than {TWINS} hashes stand for listed and other keys")
    twins = np.sort(np.concatenate([np.zeros(0, U64), *(np.frombuffer(r["twins"], U64) for r in shared.select("twins").collect())]))
    if not len(twins):
        return twins, set()

    def having(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(np.isin(hashes(batch.column("key")), twins)))

    listed = keys.filter("listed").select("key")
    return twins, {r["key"] for r in listed.mapInArrow(having, listed.schema).collect()}


def with_membership(
    frame: DataFrame,
    keys: DataFrame,
    segment_keys: int = SEGMENT_KEYS,
    block_bytes: int = BROADCAST_BYTES,
    *,
    hashes: Hashes = key_hashes,
) -> DataFrame:
    """Adds ``listed`` to a frame with a column ``key``; ``keys`` holds every key of the frame."""
    built, segments = cascades(keys, segment_keys, hashes)
    built = written(built, "cascades")
    twins, apart = listed_twins(keys, built, hashes)
    sizes = {r["segment"]: r["n"] for r in built.select("segment", F.length("levels").alias("n")).collect()}
    blocks: list[list[int]] = [[]]
    room = block_bytes
    for segment in sorted(sizes):
        if blocks[-1] and sizes[segment] > room:
            blocks.append([])
            room = block_bytes
        blocks[-1].append(segment)
        room -= sizes[segment]
    frame = frame.withColumn("listed", F.lit(None).cast("boolean"))
    schema = frame.schema
    for block in blocks:
        rows = built.filter(F.col("segment").between(block[0], block[-1])).collect() if block else []
        held = frame.sparkSession.sparkContext.broadcast({r["segment"]: (bytes(r["levels"]), bytes(r["sizes"])) for r in rows})

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            filters = {}
            for segment, (packed, sizes) in held.value.items():
                ends = np.cumsum(np.frombuffer(sizes, dtype=np.int64))[:-1]
                filters[segment] = np.split(np.frombuffer(packed, dtype=np.uint8), ends) if len(sizes) else []
            for batch in batches:
                value = hashes(batch.column("key"))
                segment = ((value >> U64(32)) % U64(segments)).astype(np.int64)
                known = batch.column("listed").to_pylist()
                found = np.array([x is True for x in known], dtype=bool)
                decided = np.array([x is not None for x in known], dtype=bool)
                for s in np.unique(segment):
                    if int(s) in filters:
                        own = np.flatnonzero(segment == s)
                        found[own] = listed_by(filters[int(s)], value[own])
                        decided[own] = True
                for i in np.flatnonzero(np.isin(value, twins)) if len(twins) else ():
                    found[i] = batch.column("key")[int(i)].as_py() in apart
                listed = pa.array(found, mask=~decided)
                columns = [listed if n == "listed" else batch.column(n) for n in batch.schema.names]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        frame = frame.mapInArrow(run, schema)
    return frame


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], segment_keys: int = SEGMENT_KEYS) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict``: by rule, else block what is ``listed`` (``key``)."""
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    pages = pages.withColumn("key", key_of(F.col("host"), F.col("path")))
    tagged = pages.select("key", F.lit(0).alias("l")).union(listed.filter("key is not null").select("key", F.lit(1)))
    keys = written(tagged.groupBy("key").agg((F.max("l") == 1).alias("listed")), "url-keys")
    found = with_membership(pages, keys, segment_keys)
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", name.alias("rule"), verdict.alias("verdict"))


def referral_keys(pages: DataFrame) -> DataFrame:
    """The list used here: addresses that were ever crawled through a referral parameter."""
    url = F.col("url").cast("string")
    referred = pages.filter(url.rlike(r"[?&]ref="))
    return referred.select(key_of(host_of(url), path_of(url)).alias("key")).distinct()


def url_verdicts(pages: DataFrame) -> DataFrame:
    return judge(pages, referral_keys(pages), RULES)
