"""Language of web pages by Bayesian fusion of four kinds of evidence.

    P(language | page) ~ P(text | language)^w * P(declared | language) * P(suffix | language) * P(language | host)

* Text: naive Bayes over byte trigrams of the visible text, counted by Spark over all documents of known language.
  Trigrams of a text depend on each other, so its log-likelihood is tempered to that of ``EFFECTIVE`` trigrams.
* Declared: the ``lang`` attribute of the markup (its primary part). How far declarations are right is counted, not
  assumed: P(declared | language) comes from the text posteriors of all pages that declare it.
* Suffix: the last label of the address's host, counted likewise.
* Host: how its other pages are distributed, smoothed towards its domain, that towards the suffix and that towards all
  pages, each level weighing ``PRIOR_PAGES`` pages (grouped aggregates, the page's own share left out).

Text posteriors are computed in one narrow pass and written; the counts are sums of them. Tables by host are joined;
their rows are spread over ``SALTS`` copies so that a host with very many pages is shared out among tasks.

Null and empty pages have no text, which then says nothing; missing declarations and addresses are a value like any
other. Texts are read whole. Equal rows are treated alike. Without documents of known language there is no language
and ``language`` is null. Documents without text or language teach nothing. Other columns are not looked at. An empty
table of pages gives an empty table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distributary.llm.shared import BROADCAST_BYTES, arrow_schema, written
from distributary.llm.text import LOWER, Texts, batch_of, texts_of
from distributary.llm.url_filter import host_of

TRIGRAMS = 1 << 16
EFFECTIVE = 60.0
PRIOR_PAGES = 5.0
SMOOTHING = 0.5
SALTS = 16

# Unclosed parts end with the page or at the next bracket, so that no page is searched more than once.
HIDDEN = re.compile(r"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^<>]*>?")
COUNTS = "language string, gram int, n long"

IS_TEXT = np.ones(256, dtype=bool)
IS_TEXT[:0x80] = False
IS_TEXT[0x61:0x7B] = True


def trigrams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of all byte trigrams of lower-cased letters; everything else between them is one space."""
    data = LOWER[texts.data]
    data = np.where(IS_TEXT[data], data, np.uint8(0x20))
    row = np.repeat(np.arange(len(texts)), np.diff(texts.offsets))
    if len(data) < 3:
        return row[:0], row[:0]
    keep = (data != 0x20) | np.concatenate([[True], (data[:-1] != 0x20) | (row[1:] != row[:-1])])
    data, row = data[keep].astype(np.int64), row[keep]
    gram = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    whole = row[:-2] == row[2:]
    hashed = gram * 0x9E3779B1 >> 13
    return row[:-2][whole], (hashed % TRIGRAMS)[whole]


def language_counts(documents: DataFrame) -> DataFrame:
    """Trigram counts by language over all documents that state one; summed within tasks before the shuffle."""
    schema = arrow_schema(COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), dtype=object)
            for texts in texts_of(batch.column("text")):
                row, gram = trigrams(texts)
                own = names[texts.first : texts.first + len(texts)]
                for name in set(own.tolist()):
                    counts = np.bincount(gram[(own == name)[row]], minlength=TRIGRAMS)
                    kept[name] = kept.get(name, 0) + counts
                if len(kept) > 64:
                    yield from rows(kept)
                    kept = {}
        yield from rows(kept)

    def rows(kept: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, counts in kept.items():
            gram = np.flatnonzero(counts)
            yield batch_of(schema, [pa.array([name] * len(gram), pa.string()), gram, counts[gram]])

    known = documents.select(F.col("lang").cast("string"), F.col("text").cast("string")).filter("lang is not null and text is not null")
    return known.mapInArrow(run, COUNTS).groupBy("language", "gram").agg(F.sum("n").alias("n"))


def trained(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the log-probabilities of the trigrams of each."""
    counts = written(language_counts(documents), "trigram-counts")
    if counts.count() * 16 > 4 * BROADCAST_BYTES:
        raise ValueError("more languages than a task can hold; ``lang`` must name languages")
    rows = counts.toArrow()
    names = sorted(set(rows.column("language").to_pylist()))
    table = np.full((len(names), TRIGRAMS), SMOOTHING)
    where = np.array([names.index(x) for x in rows.column("language").to_pylist()], dtype=np.int64)
    table[where, rows.column("gram").to_numpy()] += rows.column("n").to_numpy()
    return names, np.log(table / table.sum(axis=1, keepdims=True))


def visible(page: str) -> str:
    return html.unescape(HIDDEN.sub(" ", page))


def text_evidence(pages: DataFrame, model: np.ndarray) -> DataFrame:
    """Adds ``log_text``, the tempered log-likelihood by language (largest 0), and ``p_text``, its posterior."""
    held = pages.sparkSession.sparkContext.broadcast(model)
    kinds = {"log_text": "array<double>", "p_text": "array<double>"}
    schema = pages.drop("html").withColumns({k: F.lit(None).cast(v) for k, v in kinds.items()}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, len(batch), 256)):
                plain = pa.array([visible(x or "") for x in part.column("html").to_pylist()], pa.large_string())
                logs = []
                for texts in texts_of(plain):
                    row, gram = trigrams(texts)
                    n = np.bincount(row, minlength=len(texts))
                    sums = np.stack([np.bincount(row, weights=t[gram], minlength=len(texts)) for t in table], axis=1)
                    logs.append(sums * (np.minimum(n, EFFECTIVE) / np.maximum(n, 1))[:, None])
                found = np.concatenate(logs) if logs else np.zeros((0, len(table)))
                found -= found.max(axis=1, keepdims=True)
                p = np.exp(found)
                p /= p.sum(axis=1, keepdims=True)
                columns = [part.column(c) for c in part.schema.names if c != "html"]
                names = [c for c in part.schema.names if c != "html"] + list(kinds)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(found)), pa.array(list(p))], names=names)

    return pages.mapInArrow(run, schema)


def identify(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """Per page: ``language`` and its probability, with what was declared, the suffix, and the text's own verdict."""
    names, model = trained(documents)
    declared = F.lower(F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1))
    host = host_of(F.col("url"))
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    pages = pages.withColumns({
        "declared": F.coalesce(declared, F.lit("")),
        "host": host,
        "domain": F.regexp_extract(host, r"([^.]*\.)?[^.]*$", 0),
        "suffix": F.regexp_extract(host, r"[^.]*$", 0),
    }).drop("url")
    if not names:
        nothing = F.lit(None)
        return pages.select(
            "page_id", nothing.cast("string").alias("language"), nothing.cast("double").alias("score"), "declared",
            "suffix", nothing.cast("string").alias("text_language"),
        )
    seen = written(text_evidence(pages, model), "text-evidence")
    k = len(names)
    each = range(k)
    sums = lambda *keys: seen.groupBy(*keys).agg(*(F.sum(F.col("p_text")[i]).alias(f"s{i}") for i in each))
    together = lambda name: F.array(*(F.col(f"s{i}") for i in each)).alias(name)
    totals = sums().first()
    everywhere = F.array(*(F.lit(totals[f"s{i}"] or 0.0) for i in each))  # a number per language
    by_declared = sums("declared").select("declared", together("c_declared"))
    by_suffix = sums("suffix").select("suffix", together("c_suffix"))
    by_domain = sums("suffix", "domain").select("suffix", "domain", together("c_domain"))
    by_host = sums("suffix", "domain", "host").select("suffix", "domain", "host", together("c_host"))
    hosts = by_host.join(by_domain, ["suffix", "domain"]).join(by_suffix, "suffix").withColumn("all_pages", everywhere)
    hosts = hosts.withColumn("salt", F.explode(F.array(*(F.lit(i) for i in range(SALTS)))))
    names_count = F.lit(float(by_declared.count()))
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    joined = seen.withColumn("salt", salt).join(hosts.drop("domain", "suffix"), ["host", "salt"])
    by_declared = by_declared.withColumn("salt", F.explode(F.array(*(F.lit(i) for i in range(SALTS)))))
    joined = joined.join(by_declared, ["declared", "salt"]).drop("salt")
    suffixes = F.lit(float(by_suffix.count()))

    # Shares without the page's own posterior, each level resting on the next wider one. All numbers are arrays by
    # language, so neither the plan nor the work on a page grows faster than the number of languages.
    joined = joined.withColumns({
        column: F.zip_with(column, "p_text", lambda n, p: F.greatest(n - p, F.lit(0.0)))
        for column in ("all_pages", "c_suffix", "c_domain", "c_host", "c_declared")
    })
    total_of = lambda column: F.aggregate(column, F.lit(0.0), lambda a, n: a + n)
    divided = lambda column, by: F.zip_with(column, F.array_repeat(by, k), lambda n, size: n / size)
    plus = lambda one, other: F.zip_with(one, other, lambda a, b: a + b)
    smoothed = F.transform("all_pages", lambda n: n + SMOOTHING)
    joined = joined.withColumn("prior", divided(smoothed, total_of("all_pages") + SMOOTHING * k))
    for column in ("c_suffix", "c_domain", "c_host"):
        rested = F.zip_with(column, "prior", lambda n, wider: n + PRIOR_PAGES * wider)
        joined = joined.withColumn("prior", divided(rested, total_of(column) + PRIOR_PAGES))
    right = lambda column, kinds: F.zip_with(
        column, "all_pages", lambda n, all_n: F.log((n + SMOOTHING) / (all_n + SMOOTHING * kinds))
    )
    with_prior = F.zip_with("log_text", "prior", lambda text, prior: text + F.log(prior))
    joined = joined.withColumn("logs", plus(plus(with_prior, right("c_declared", names_count)), right("c_suffix", suffixes)))
    shares = F.zip_with("logs", F.array_repeat(F.array_max("logs"), k), lambda log, most: F.exp(log - most))
    total = total_of(shares)
    named = lambda column: F.element_at(F.array(*map(F.lit, names)), F.array_position(column, F.array_max(column)).cast("int"))
    has_text = F.array_min("log_text") < 0
    return joined.select(
        "page_id", named(F.col("logs")).alias("language"), (1 / total).alias("score"), "declared", "suffix",
        F.when(has_text, named(F.col("p_text"))).alias("text_language"),
    )
