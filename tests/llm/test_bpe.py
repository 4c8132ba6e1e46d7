"""Token ids against the tokenizers library, digests against ids, and the round trip."""

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.ipc
import pytest
from tokenizers import Tokenizer

from distributary.llm import bpe, token_files
from distributary.llm.queries import TOKENIZER
from distributary.llm.shared import new_folder
from distributary.llm.text import texts_of
from tests.llm import cases

LIBRARY = Tokenizer.from_file(TOKENIZER)


def odd_texts():
    rng = random.Random(1)
    letters = [chr(rng.randrange(0x20, 0x3000)) for _ in range(300)] + list("   \n\t'sabcdt019.,!") * 10
    listed = ["", " ", "  a  b ", "a\n\n b", "x<|endoftext|> y <|endoftext|>", "a" * 3000, "don't I'LL 's", " x  y", "Ᲊ \U00031350"]
    return listed + ["".join(rng.choices(letters, k=rng.randrange(1, 200))) for _ in range(400)]


def test_ids_of_a_small_cache_equal_the_library():
    words = bpe.vocabulary(TOKENIZER)
    cache = bpe.PieceCache(words.encode_pieces, np.int32, words.special, 10)
    for text in [*odd_texts()[:60], *odd_texts()[:60]]:
        ids, _ = cache.texts(next(texts_of(pa.array([text]))))
        assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert len(cache.known) + len(cache.older) < 400


def test_newer_letters_take_little_memory():
    """Each worker looks for them before its first text."""
    tracemalloc.start()
    found = bpe.newer_letters()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found and peak < 16 << 20
    assert all(c < 0x110000 and not 0xD800 <= c < 0xE000 for c in found)


@pytest.mark.parametrize("cache", [bpe.encoder(TOKENIZER), token_files.library_encoder(TOKENIZER)])
def test_ids_equal_the_library(cache):
    texts = odd_texts()
    found = []
    for chunk in texts_of(pa.array(texts)):
        ids, bounds = cache.texts(chunk)
        found += [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:], strict=False)]
    assert found == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("cache", [bpe.encoder(TOKENIZER), token_files.library_encoder(TOKENIZER)])
def test_signs_behind_words_are_pieces_of_their_own(cache):
    """Words are known whatever signs follow them; special tokens and other signs stay whole."""
    texts = ["one two, three. two; two... it's. é. ü, ×. ÷; x) 7, x-y, a'll! l'a. …. a…. end.", ",", ". a, b", "a,", ",. b, c", "a\xa0, b\u3000. c"]
    seen, encode = [], cache.encode
    for some in (texts, [*texts, "a<|endoftext|> b, c<|endoftext|>. d, <|endoftext|>"]):
        cache.known, cache.older, cache.encode = {}, {}, lambda parts, inner: (seen.extend(parts), encode(parts, inner))[1]
        chunk = next(texts_of(pa.array(some)))
        ids, bounds = cache.texts(chunk)
        cache.encode = encode
        expected = [LIBRARY.encode(t, add_special_tokens=False).ids for t in some]
        assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:], strict=False)] == expected
        if some is texts:
            assert seen.count(b" two") == 1 and not {b" two,", b" two;", b" two...", " é.".encode()} & set(seen)
            assert " ×.".encode() in seen


@pytest.mark.parametrize("cache", [bpe.encoder(TOKENIZER), token_files.library_encoder(TOKENIZER)])
def test_lines_are_pieces_of_their_own(cache):
    """Words before and behind a line end are known without each other; line ends next to white space stay inside."""
    texts = ["one two.\nthree four\nfive", "a two\nthree.\nfive's six", "\nseven", "eight\n", "a \nb\n c\n\nd\r\ne\n\u3000f\xa0\ng", "\n", "x\n'll y\n7 z"]
    rng = random.Random(4)
    texts += ["".join(rng.choices(["\n", "\n", " ", "a", "bc.", "'s", "7", "é", "\u3000", "\r"], k=rng.randrange(1, 40))) for _ in range(300)]
    seen, encode = [], cache.encode
    cache.known, cache.older, cache.encode = {}, {}, lambda parts, inner: (seen.extend(parts), encode(parts, inner))[1]
    chunk = next(texts_of(pa.array(texts)))
    ids, bounds = cache.texts(chunk)
    cache.encode = encode
    expected = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:], strict=False)] == expected
    assert seen.count(b" two") == 1 and seen.count(b"\nthree") == 1 and seen.count(b"\nfive") == 1
    assert not {b" two.\nthree", b" two\nthree", b" four\nfive"} & set(seen)


def test_exact_merging_both_ways():
    words = bpe.vocabulary(TOKENIZER)
    raw = [w.encode() for w in ["thhereon", "aaaaaaa", "ünïcödé", "x"]]
    assert [words.merged(w) for w in raw] == [x.tolist() for x in words.merged_together(raw)]
    ids, sizes = words.encode_words(raw)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [words.merged(w) for w in raw]


def test_digests_and_round_trip(spark):
    rows = cases.awkward()
    found = bpe.token_digests(cases.clashing(cases.frame(spark, rows)), TOKENIZER).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = []
    for doc_id, text, *_ in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(decoded)))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert bpe.token_digests(cases.empty(spark), TOKENIZER).collect() == []


def test_encode_and_decode_columns(spark):
    frame = bpe.encode(cases.clashing(cases.frame(spark, cases.awkward())), TOKENIZER)
    back = bpe.decode(frame, TOKENIZER).select("text", "ids", "decoded", "kept").collect()
    assert all((r["text"] or "") == r["decoded"] and r["kept"] == "mine" for r in back)


def expected_checks(rows):
    found, start = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


@pytest.mark.parametrize(("length", "file_tokens"), [(2048, 1 << 20), (7, 500)])
def test_token_files(spark, length, file_tokens):
    rows = cases.awkward()
    folder = new_folder(spark, "token-files")
    index = token_files.write_token_files(cases.frame(spark, rows), TOKENIZER, folder, length, file_tokens)
    found = [tuple(r) for r in token_files.read_token_files(index, folder).collect()]
    assert sorted(found, key=lambda r: r[1]) == expected_checks(rows)
    for name in {r["file"] for r in index.collect()}:
        reader = pa.ipc.open_file(pa.memory_map(f"{folder.removeprefix('file://')}/{name}"))
        kind = reader.schema.field("ids").type
        assert (kind.list_size, kind.value_type) == (length, pa.uint16())
        batch = reader.get_batch(0)
        assert batch.column("ids").values.to_numpy().base is not None or len(batch) == 0  # a view


def test_no_documents_no_files(spark):
    assert token_files.token_file_checks(cases.empty(spark), TOKENIZER).collect() == []
