"""Words that a polynomial hash modulo 2^64 cannot tell apart, in every operator that hashes words."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from distributary.llm import bpe, decontaminate, near_dup, quality, substrings, text, token_files, url_filter
from distributary.llm.queries import TOKENIZER
from distributary.llm.shared import new_folder
from tests.llm import cases


def twins(size):
    """A Thue-Morse word and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


PAIRS = [*twins(1024), *twins(4096)]


def test_words_have_hashes_of_their_own():
    chunk = next(text.texts_of(pa.array([" ".join([*PAIRS, *(w[:60] for w in PAIRS), "a", "aa", "b"])])))
    words = text.words_of(chunk, text.SPACED)
    assert len(set(words.hashes().tolist())) == len(set(chunk.raw(0).split()))


def test_equal_ranges_hash_alike_wherever_they_stand():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 5000).astype(np.uint8)
    start = rng.integers(0, 4000, 3000)
    end = start + rng.integers(0, 100, 3000)
    at, place = text.distinct_ranges(data, start, end)
    contents = [data[i:j].tobytes() for i, j in zip(start, end, strict=True)]
    assert [contents[at[p]] for p in place] == contents
    assert len(at) == len(set(contents))


def test_ranges_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(text, "range_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    data = np.frombuffer(b"abcabdab" + b"x" * 100 + b"y" * 100 + b"x" * 100, dtype=np.uint8)
    start, end = np.array([0, 3, 6, 0, 3, 8, 108, 208]), np.array([3, 6, 8, 3, 5, 108, 208, 308])
    at, place = text.distinct_ranges(data, start, end)
    contents = [data[i:j].tobytes() for i, j in zip(start, end, strict=True)]
    assert [contents[at[p]] for p in place] == contents


@pytest.fixture
def documents(spark):
    texts = [*PAIRS, *(f"{w} " * 13 for w in PAIRS), *("\n".join([w, w]) for w in PAIRS[:2]), f"{PAIRS[0]}\n{PAIRS[1]}"]
    return cases.frame(spark, [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)])


def test_tokens(documents):
    library = Tokenizer.from_file(TOKENIZER)
    ids = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in documents.collect()}
    for row in bpe.token_digests(documents, TOKENIZER).collect():
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids[row["doc_id"]])).encode()).hexdigest()
    folder = new_folder(documents.sparkSession, "token-files")
    index = token_files.write_token_files(documents, TOKENIZER, folder)
    assert {r["doc_id"]: r["n_tokens"] for r in index.collect()} == {i: len(x) + 1 for i, x in ids.items()}


def test_no_links_no_repeats_no_hits(spark, documents):
    assert all(r["kept"] for r in near_dup.near_duplicates(documents, 4).collect() if r["doc_id"] < 8)
    assert all(r["n_removed"] == 0 for r in substrings.kept_digests(documents.filter("doc_id < 8")).collect())
    items = spark.createDataFrame([("i", PAIRS[0]), ("j", f"{PAIRS[2]} " * 10)], "item_id string, text string")
    hit = {r["doc_id"]: r["n_items"] for r in decontaminate.contamination(documents, items).collect()}
    assert hit == {0: 1, 1: 0, 2: 0, 3: 0, 4: 1, 5: 0, 6: 1, 7: 0, 8: 1, 9: 0, 10: 1}
    counts = {r["doc_id"]: r["n_dup_lines"] for r in quality.quality_rules(documents).collect()}
    assert [counts[i] for i in (8, 9, 10)] == [1, 1, 0]


def one_hash(column):
    return np.zeros(len(column), np.uint64)


def test_lists_whose_keys_share_a_hash(spark):
    rows = [(f"{w} /{i}",) for w in PAIRS for i in range(20)]
    frame = spark.createDataFrame(rows, "key string")
    keys = frame.withColumn("listed", frame["key"].endswith("7"))
    for hashes in (url_filter.key_hashes, one_hash):
        found = url_filter.with_membership(frame, keys, hashes=hashes).collect()
        assert len(found) == len(rows)
        assert all(r["listed"] == r["key"].endswith("7") for r in found)
