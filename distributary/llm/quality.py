"""Quality rules: counts over whole texts, and bands of n-gram perplexity per language.

The language model is a modified Kneser-Ney model over bytes of lower-cased words (each run of white space counts as
one space; every text starts with one). Documents are dealt into two halves by the hash of their normal form, so copies
stay together, and each half is scored by the model of the other: no text predicts itself. Near copies may fall into
both halves. Spark counts all n-grams of all documents by half and language, takes the discounts from the counts of
counts, and computes the interpolated probabilities; the models are one table of (language, n-gram, log-probability,
back-off), held as sorted arrays of n-gram codes where it is small enough for every task (``BROADCAST_BYTES``), and
joined by a shuffle where it is not. Both ways give the same perplexities. A language whose texts are all in one half
has no model to be scored by: all its n-grams are equally likely, and the bands reject none.

A document's perplexity is compared with the distribution of its own language: below the lower band (repetition,
boilerplate) or above the upper band (noise, another language or alphabet) it is rejected. Bands lie ``REACH``
interquartile ranges outside the quartiles, at least ``LEAST_REACH``, and further for texts of few words, whose means
scatter more (``SHORT_REACH`` over the root of the words). So they follow the corpus and leave its bulk alone. Documents
without language count as one language.

Null texts have no words, and their verdict follows from the base rules, like that of any text without n-grams. Texts
of any length are counted whole. Equal rows are treated alike. Other columns are kept; names that this operator adds
replace older columns of that name. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from distributary.llm.shared import BROADCAST_BYTES, arrow_schema, spent_tables, written
from distributary.llm.text import LOWER, SPACED, U64, Texts, Words, batch_of, gram_hashes, per_row, range_hashes, spread_bits, texts_of, words_of

ORDER = 4
GRAM_CHUNK = 1 << 19  # bytes of text at a time; their n-grams take some hundred times as much memory
REACH = 4.0
LEAST_REACH = 0.35
SHORT_REACH = 2.0
BROADCAST_BANDS = 100_000
SALTS = 64
MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"

BASE_RULES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
COUNTS = "language string, gram long, n long"
SCORES = "log_sum double, n_grams long"

IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
IS_START = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point


def base_counts(texts: Texts, words: Words) -> list[np.ndarray]:
    """The five counts of each text."""
    data, offsets = texts.data, texts.offsets
    inside = SPACED[data]
    chars = per_row(inside & IS_START[data], offsets)
    symbols = per_row(IS_SYMBOL[data], offsets)

    # Lines start with the text and behind each \n; they end at the next \n or with the text.
    newlines = np.flatnonzero(data == 0x0A)
    starts = np.union1d(offsets[:-1], newlines + 1)
    starts = starts[starts < len(data)]
    ends = np.append(newlines, len(data))[np.searchsorted(newlines, starts)]
    ends = np.minimum(ends, offsets[np.searchsorted(offsets, starts, side="right")])
    has_word = np.concatenate([[0], np.cumsum(inside)])
    real = has_word[ends] > has_word[starts]
    starts, ends = starts[real], ends[real]
    row = np.searchsorted(offsets, starts, side="right") - 1
    line = range_hashes(data, starts, ends) + row.astype(U64) * U64(0x9E3779B97F4A7C15)
    _, first = np.unique(spread_bits(line), return_index=True)
    again = np.ones(len(line), dtype=np.int64)
    again[first] = 0
    dup_lines = np.bincount(row, weights=again, minlength=len(texts)).astype(np.int64)

    rows = words.rows()
    at, value = gram_hashes(words.hashes(), rows, REPEAT_WINDOW)
    own = spread_bits(value + rows[at].astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(own), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    marks[at[twice]] += 1  # the places are distinct
    np.subtract.at(marks, at[twice] + REPEAT_WINDOW, 1)
    repeated = per_row(np.cumsum(marks[:-1]) > 0, words.bounds)
    return [words.counts(), chars, symbols, dup_lines, repeated]


def gram_codes(texts: Texts, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and code (its bytes as a number) of every byte n-gram of the normal form of the texts."""
    n, offsets = len(texts.data), texts.offsets
    filled = np.flatnonzero(np.diff(offsets))
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = ~SPACED[texts.data]
    first = np.zeros(n, dtype=bool)
    first[offsets[filled]] = True
    keep = ~gap | np.concatenate([[True], ~gap[:-1]]) | first
    data = np.where(gap, 0x20, LOWER[texts.data])[keep].astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))[keep]
    # A space before every text: it is part of the first n-gram's history.
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    data, row = np.insert(data, starts, 0x20), np.insert(row, starts, row[starts])
    code = data[: len(data) - order + 1].copy() if len(data) >= order else data[:0]
    for j in range(1, order):
        code = code << 8 | data[j : j + len(code)]
    whole = row[: len(code)] == row[order - 1 :][: len(code)]
    return row[: len(code)][whole], code[whole]


def gram_counts(documents: DataFrame, order: int) -> DataFrame:
    """Counts of all n-grams by language, summed within tasks before they are shuffled."""
    schema = arrow_schema(COUNTS)

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        codes, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        codes, place = np.unique(codes, return_inverse=True)
        return codes, np.bincount(place, weights=n, minlength=len(codes)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            names = np.array(batch.column("language").to_pylist(), dtype=object)
            for texts in texts_of(batch.column("text"), GRAM_CHUNK):
                row, code = gram_codes(texts, order)
                own = names[texts.first : texts.first + len(texts)]
                for name in set(own.tolist()):
                    chosen = code[(own == name)[row]]
                    parts = kept.setdefault(name, [])
                    parts.append(np.unique(chosen, return_counts=True))
                    if sum(len(p[0]) for p in parts) > 500_000:
                        parts[:] = [merged(parts)]
                if sum(len(p[0]) for parts in kept.values() for p in parts) > 2_000_000:
                    yield from rows(kept)
                    kept = {}
        yield from rows(kept)

    def rows(kept: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for name, parts in kept.items():
            codes, n = merged(parts)
            for i in range(0, len(codes), 500_000):
                some = slice(i, i + 500_000)
                yield batch_of(schema, [pa.array([name] * len(codes[some]), pa.string()), codes[some], n[some]])

    counts = documents.select("language", "text").mapInArrow(run, COUNTS)
    return counts.groupBy("language", "gram").agg(F.sum("n").alias("n"))


def discount(n: Column, kinds: Column) -> Column:
    """Modified Kneser-Ney discount of a count, from the counts of counts; never all of the count."""
    one, two, three, four = (F.greatest(F.element_at(kinds, i), F.lit(1)).cast("double") for i in (1, 2, 3, 4))
    ratio = one / (one + 2 * two)
    value = (
        F.when(n == 1, 1 - 2 * ratio * two / one)
        .when(n == 2, 2 - 3 * ratio * three / two)
        .otherwise(3 - 4 * ratio * four / three)
    )
    return F.least(F.greatest(value, F.lit(0.05)), n * 0.95)


def kneser_ney(counts: DataFrame, order: int) -> DataFrame:
    """The model: ``language``, ``size``, ``gram``, ``log_p`` of the last byte, ``log_back`` of the gram as a history.

    The highest order uses counts, lower orders the number of distinct bytes before the gram. A byte's unigram falls
    back to an equal share of the 256 bytes.
    """
    levels = {order: counts.select("language", "gram", F.col("n").cast("long").alias("n"))}
    for size in range(order - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND((1 << 8 * size) - 1)
        levels[size] = levels[size + 1].groupBy("language", suffix.alias("gram")).agg(F.count("*").alias("n"))
    below: DataFrame | None = None
    tables = []
    for size in range(1, order + 1):
        level = levels[size]
        kinds = level.groupBy("language").agg(
            F.array(*(F.sum(F.when(F.col("n") == i, 1).otherwise(0)) for i in (1, 2, 3, 4))).alias("kinds")
        )
        cut = level.join(F.broadcast(kinds), "language").select(
            "language", "gram", "n", F.shiftright("gram", 8).alias("history"), discount(F.col("n"), F.col("kinds")).alias("off")
        )
        sums = cut.groupBy("language", "history").agg(F.sum("n").alias("total"), F.sum("off").alias("mass"))
        cut = cut.join(sums, ["language", "history"])
        back = F.col("mass") / F.col("total")
        if below is None:
            lower = F.lit(1 / 256)
        else:
            shorter = F.col("gram").bitwiseAND((1 << 8 * (size - 1)) - 1)
            lesser = below.select("language", F.col("gram").alias("shorter"), F.col("p").alias("lower_p"))
            cut = cut.withColumn("shorter", shorter).join(lesser, ["language", "shorter"], "left")
            lower = F.coalesce("lower_p", F.lit(1 / 256))
        p = (F.col("n") - F.col("off")) / F.col("total") + back * lower
        below = written(cut.select("language", "gram", p.alias("p")), f"grams-{size}")
        tables.append(below.select("language", F.lit(size).alias("size"), "gram", F.log("p").alias("log_p")))
        backs = sums.select("language", F.lit(size - 1).alias("size"), F.col("history").alias("gram"), F.log(F.col("mass") / F.col("total")).alias("log_back"))
        tables.append(backs)
    return union_by_gram(tables)


def union_by_gram(tables: list[DataFrame]) -> DataFrame:
    found = tables[0].select("language", "size", "gram", "log_p", F.lit(None).cast("double").alias("log_back"))
    for table in tables[1:]:
        full = table.withColumns({c: F.lit(None).cast("double") for c in ("log_p", "log_back") if c not in table.columns})
        found = found.unionByName(full)
    return found.groupBy("language", "size", "gram").agg(F.max("log_p").alias("log_p"), F.max("log_back").alias("log_back"))


class Model:
    """Sorted arrays of n-gram codes with their values, by language and size."""

    def __init__(self, table: pa.Table, order: int) -> None:
        self.order = order
        names = table.column("language").combine_chunks().dictionary_encode()
        where = np.asarray(names.indices)
        sizes, grams, log_p, log_back = (
            table.column(c).to_numpy(zero_copy_only=False) for c in ("size", "gram", "log_p", "log_back")
        )
        self.levels: dict[tuple[str, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for i, name in enumerate(names.dictionary.to_pylist()):
            for size in range(order + 1):
                chosen = np.flatnonzero((where == i) & (sizes == size))
                chosen = chosen[np.argsort(grams[chosen])]
                kept = (grams[chosen], log_p[chosen].astype(np.float32), log_back[chosen].astype(np.float32))
                self.levels[name, size] = kept

    def scores(self, language: str, codes: np.ndarray) -> np.ndarray:
        """Log-probability of the last byte of each n-gram given the bytes before it."""
        found = np.zeros(len(codes), dtype=np.float64)
        left = np.arange(len(codes))
        for size in range(self.order, 0, -1):
            keys, log_p, _ = self.levels.get((language, size), EMPTY_LEVEL)
            part = codes[left] & ((1 << 8 * size) - 1)
            place = np.minimum(np.searchsorted(keys, part), max(len(keys) - 1, 0))
            value = log_p[place] if len(keys) else np.full(len(part), np.nan)
            known = (keys[place] == part) & ~np.isnan(value) if len(keys) else np.zeros(len(part), bool)
            found[left[known]] += value[known]
            left, part = left[~known], part[~known]
            if not len(left):
                return found
            keys, _, log_back = self.levels.get((language, size - 1), EMPTY_LEVEL)
            if len(keys):
                place = np.minimum(np.searchsorted(keys, part >> 8), len(keys) - 1)
                real = (keys[place] == part >> 8) & ~np.isnan(log_back[place])
                found[left[real]] += log_back[place[real]]
        found[left] -= np.log(256)
        return found


EMPTY_LEVEL = (np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, np.float32))


def with_columns(frame: DataFrame, ddl: str) -> StructType:
    kinds = [field.split() for field in ddl.split(",")]
    return frame.withColumns({name: F.lit(None).cast(kind) for name, kind in kinds}).schema


def based(documents: DataFrame) -> DataFrame:
    """All rows with the counts of the base rules."""
    schema = arrow_schema(BASE_RULES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch.column("text"), GRAM_CHUNK):
                rows = batch.slice(texts.first, len(texts))
                added = batch_of(schema, base_counts(texts, words_of(texts, SPACED)))
                yield pa.RecordBatch.from_arrays([*rows.columns, *added.columns], names=[*rows.schema.names, *schema.names])

    return documents.mapInArrow(run, with_columns(documents, BASE_RULES))


def scored_in_place(documents: DataFrame, model: Model) -> DataFrame:
    """All rows with the counts of the base rules, the log-probability of their text and its number of n-grams.

    Both in one function: a second one would need a second Python process for every task.
    """
    added_ddl = f"{BASE_RULES}, {SCORES}"
    schema, order = arrow_schema(added_ddl), model.order
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("language").to_pylist(), dtype=object)
            for texts in texts_of(batch.column("text"), GRAM_CHUNK):
                rows = batch.slice(texts.first, len(texts))
                row, code = gram_codes(texts, order)
                own = names[texts.first : texts.first + len(texts)]
                value = np.zeros(len(code))
                for name in set(own.tolist()):
                    chosen = (own == name)[row]
                    value[chosen] = held.value.scores(name, code[chosen])
                sums = np.bincount(row, weights=value, minlength=len(texts))
                counts = np.bincount(row, minlength=len(texts))
                base = base_counts(texts, words_of(texts, SPACED))
                added = batch_of(schema, [*base, sums, counts.astype(np.int64)])
                yield pa.RecordBatch.from_arrays([*rows.columns, *added.columns], names=[*rows.schema.names, *schema.names])

    return documents.mapInArrow(run, with_columns(documents, added_ddl))


def scored_by_join(documents: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """The same for models of any size: the distinct n-grams of each text meet the model in joins."""
    keyed = documents.withColumn("text_key", F.concat_ws(":", F.xxhash64("text"), F.length("text"), "language"))
    schema = "text_key string, language string, gram long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, names = batch.column("text_key"), batch.column("language")
            for texts in texts_of(batch.column("text"), GRAM_CHUNK):
                row, code = gram_codes(texts, order)
                for i in range(len(texts)):
                    low, high = np.searchsorted(row, [i, i + 1])
                    grams, n = np.unique(code[low:high], return_counts=True)
                    at = pa.array(np.full(len(grams), texts.first + i))
                    yield batch_of(arrow_schema(schema), [keys.take(at), names.take(at), grams, n])

    grams = keyed.select("text_key", "language", "text").dropDuplicates(["text_key"]).mapInArrow(run, schema)
    asked = grams.select("language", "gram").distinct()
    value = F.lit(-float(np.log(256)))
    for size in range(1, order + 1):
        level = model.filter((F.col("size") == size) & F.col("log_p").isNotNull())
        level = level.select("language", F.col("gram").alias("level_gram"), F.col("log_p").alias(f"p{size}"))
        past = model.filter((F.col("size") == size - 1) & F.col("log_back").isNotNull())
        past = past.select("language", F.col("gram").alias("past_gram"), F.col("log_back").alias(f"b{size}"))
        asked = asked.withColumn("level_gram", F.col("gram").bitwiseAND((1 << 8 * size) - 1))
        asked = asked.withColumn("past_gram", F.shiftright("level_gram", 8))
        asked = asked.join(level, ["language", "level_gram"], "left").join(past, ["language", "past_gram"], "left")
        asked = asked.drop("level_gram", "past_gram")
        value = F.coalesce(F.col(f"p{size}"), F.coalesce(F.col(f"b{size}"), F.lit(0.0)) + value)
    asked = asked.select("language", "gram", value.alias("log_p"))
    sums = grams.join(asked, ["language", "gram"]).groupBy("text_key").agg(
        F.sum(F.col("n") * F.col("log_p")).alias("log_sum"), F.sum("n").alias("n_grams")
    )
    joined = keyed.join(sums, "text_key", "left").drop("text_key")
    return joined.withColumns({"log_sum": F.coalesce("log_sum", F.lit(0.0)), "n_grams": F.coalesce("n_grams", F.lit(0))})


def half_of(text: Column) -> Column:
    """0 or 1, the same for all texts of one normal form."""
    return F.pmod(F.xxhash64(F.trim(F.regexp_replace(F.lower(text), "[\\x20\\x09-\\x0D]+", " "))), F.lit(2))


def assess(documents: DataFrame, keep: list[str], order: int = ORDER, model_bytes: int = 2 * BROADCAST_BYTES) -> DataFrame:
    """The columns ``keep`` of all rows with counts, ``perplexity`` (per byte), both verdicts and ``kept``."""
    language = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in documents.columns else F.lit("")
    text = F.col("text").cast("string")
    half = F.coalesce(half_of(text), F.lit(0))
    keyed = lambda n: documents.withColumns({"text": text, "language": F.concat(n.cast("string"), F.lit(":"), language)})
    with spent_tables(documents.sparkSession) as folders:
        counts = written(gram_counts(keyed(half), order), "gram-counts")
        documents = keyed(1 - half)  # scored by the other half's model
        model = written(kneser_ney(counts, order), "gram-model")
        if model.count() * 24 <= model_bytes:
            scored = scored_in_place(documents, Model(model.toArrow(), order))
        else:
            scored = based(scored_by_join(documents, model, order))
        scored = scored.withColumn("log_ppl", F.when(F.col("n_grams") > 0, -F.col("log_sum") / F.col("n_grams")))
        numbers = ["language", "log_ppl", *(field.split()[0] for field in BASE_RULES.split(","))]
        scored = scored.withColumn("language", F.expr("substring(language, 3)"))  # one band for both halves
        scored = written(scored.select(*keep, *(c for c in numbers if c not in keep)), "scored")
        folders.pop()
    quartiles = F.percentile_approx("log_ppl", [0.25, 0.75], 10_000)
    bands = scored.groupBy("language").agg(quartiles.alias("q")).select("language", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    reach = F.greatest(REACH * (F.col("q3") - F.col("q1")), F.lit(LEAST_REACH))
    bands = bands.select("language", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    bands = written(bands, "bands")
    n = F.col("n_words")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * n)
    more = F.lit(SHORT_REACH) / F.sqrt(F.greatest(n, F.lit(1)))
    inside = F.col("log_ppl").between(F.col("low") - more, F.col("high") + more)
    inside = F.coalesce(inside, F.lit(True))
    return (
        with_bands(scored, bands)
        .withColumns({"base_failed": failed, "perplexity": F.exp("log_ppl")})
        .withColumn("kept", ~F.col("base_failed") & inside)
        .drop("language", "low", "high", "log_ppl")
    )


def with_bands(scored: DataFrame, bands: DataFrame) -> DataFrame:
    """Adds the band of each row's language, without moving the rows of a language to one task."""
    if bands.count() <= BROADCAST_BANDS:
        return scored.join(F.broadcast(bands), "language", "left")
    salted = bands.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = scored.withColumn("salt", F.pmod(F.xxhash64("log_ppl", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    return spread.join(salted, ["language", "salt"], "left").drop("salt")


RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "perplexity"]


def quality_rules(documents: DataFrame) -> DataFrame:
    """Per document: the counts, and whether the base rules and the perplexity bands let it through."""
    columns = ["doc_id", "text", *(["lang"] if "lang" in documents.columns else [])]
    found = assess(documents.select(*columns), ["doc_id"])
    return found.select(F.col("doc_id").cast("long"), *RULES)


def good_documents(documents: DataFrame) -> DataFrame:
    """The rows that pass all rules, as they are."""
    columns = documents.columns
    names = {c: f"own_{i}" for i, c in enumerate(columns) if c not in ("text", "lang")}
    renamed = documents.withColumnsRenamed(names)
    found = assess(renamed, renamed.columns).filter("kept")
    return found.select(*renamed.columns).withColumnsRenamed({v: k for k, v in names.items()})
