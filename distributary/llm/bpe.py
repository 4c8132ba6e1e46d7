"""Byte-level BPE by speculation: propose the longest tokens, check all adjacent pairs at once, merge only what fails.

Greedy longest match proposes tokens for a word. The proposal is the encoding exactly if no merge would have crossed
the border of any two adjacent tokens, and each token is the encoding of its own bytes. Whether a merge crosses a
border follows from the order in which the two sides grow, so all borders of a batch are checked by array operations
on the merge table. Words with a border that fails are merged step by step.

Texts: null is an empty text; empty texts have no tokens; a text of any length is encoded whole. Repeated rows and ids
are encoded each for themselves; other columns are not looked at. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from distributary.llm.shared import arrow_schema
from distributary.llm.text import Texts, batch_of, distinct_ranges, texts_of

# Fixed values of the byte-level tokenizer format: the pattern that cuts words, and the bytes that stand for themselves.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VISIBLE = (range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100))

SYMBOL = "\ue000"
CACHED_PIECES = 400_000
WORKER_PIECES = 150_000  # of ``encoder``, whose worker keeps them while it does other work
CACHED_LENGTH = 64
TOGETHER = 48
LETTER_BLOCK = 1 << 12
NEVER = np.iinfo(np.int64).max

SPACE_BYTES = np.isin(np.arange(256), [*range(0x09, 0x0E), *range(0x1C, 0x21)])
# First bytes of the characters beyond ASCII that are white space.
SPACE_LEADS = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
ALNUM = np.array([chr(i).isascii() and chr(i).isalnum() for i in range(256)])
SIGNS = np.array([0x20 < i < 0x7F for i in range(256)]) & ~ALNUM
# Last bytes of the letters from U+00C0 to U+00FF, which start with 0xC3; two in between are signs.
LATIN_ENDS = np.isin(np.arange(256), [i for i in range(0x80, 0xC0) if i not in (0x97, 0xB7)])


def tail_starts(data: np.ndarray, first: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Where ASCII signs follow a letter or digit and nothing but such signs stands before the next of the cuts."""
    sign, word = SIGNS[data], ALNUM[data]
    word[1:] |= (data[:-1] == 0xC3) & LATIN_ENDS[data[1:]]
    at = np.flatnonzero(sign[1:] & word[:-1]) + 1
    other = np.append(np.flatnonzero(~sign), len(data))
    end = other[np.searchsorted(other, at)]
    at, end = at[end < len(data)], end[end < len(data)]
    at, end = at[cut[end]], end[cut[end]]
    return at[np.searchsorted(first, at - 1, side="right") == np.searchsorted(first, end, side="right")]


def piece_starts(texts: Texts, tails: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces start: at each text, and at single spaces and line ends between characters that are no white space.

    A word never holds such a space but as its first character, and such a line end is a word, so pieces can be encoded
    each for itself. Characters that share their first byte with white space beyond ASCII are taken for white space,
    which only makes pieces longer.
    With ``tails``, signs at the end of such a piece are one of their own, as no word goes on from a letter or digit to
    a sign; that must not be asked for where special tokens stand. Also says which pieces start with such a space or line
    end and end before a cut: they stay apart from each other in any order.
    """
    data, offsets = texts.data, texts.offsets
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    space, lead = SPACE_BYTES[data], SPACE_LEADS[data]
    cut = (data == 0x20) | (data == 0x0A)
    cut[-1] = False
    cut[:-1] &= ~(space[1:] | lead[1:])
    cut[1:] &= ~space[:-1]
    cut[2:] &= ~(lead[:-2] & (data[:-2] == 0xC2))
    cut[3:] &= ~(lead[:-3] & (data[:-3] != 0xC2))
    first = np.unique(offsets[:-1][np.diff(offsets) > 0])
    cut[first] = False
    cut[np.minimum(offsets[1:], n) - 1] = False
    inner = np.flatnonzero(cut)
    tail = tail_starts(data, first, cut) if tails else inner[:0]
    starts = np.sort(np.concatenate([first, inner, tail]))
    ends = np.append(starts[1:], n)
    spaced = cut.copy()
    cut[tail] = True
    return starts, spaced[starts] & (cut[np.minimum(ends, n - 1)] & (ends < n))


def stretches(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[begin : begin + size]`` of all ``begins``, one after the other."""
    after = np.cumsum(sizes)
    return values[np.repeat(begins - (after - sizes), sizes) + np.arange(after[-1] if len(after) else 0)]


class Table:
    """Byte strings by number, put together by array operations."""

    def __init__(self, strings: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.sizes = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
        self.begins = np.cumsum(self.sizes) - self.sizes

    def joined(self, numbers: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """For the numbers between consecutive ``bounds``, their strings one after the other."""
        sizes = self.sizes[numbers]
        raw = stretches(self.data, self.begins[numbers], sizes).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds].tolist()
        return [raw[i:j] for i, j in zip(ends, ends[1:], strict=False)]


class PieceCache:
    """Token ids of texts, from those of their distinct pieces; short pieces stay known while a worker lives."""

    def __init__(
        self, encode: Callable[[list[bytes], np.ndarray], list[bytes]], dtype: type, special: Iterable[str], pieces: int = CACHED_PIECES
    ) -> None:
        self.encode, self.dtype, self.pieces = encode, np.dtype(dtype), pieces
        self.special = [token.encode() for token in special]
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def recalled(self, parts: list[bytes]) -> tuple[list[bytes | None], list[int]]:
        """What is known of the pieces, and which are new. Of two generations, the older one goes when the younger is full."""
        if len(self.known) > self.pieces:
            self.older, self.known = self.known, {}
        found = list(map(self.known.get, parts))
        new = []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            ids = self.older.get(parts[i])
            if ids is None:
                new.append(i)
            else:
                found[i] = self.known[parts[i]] = ids
        return found, new

    def texts(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk, and where those of each text start and end."""
        raw = texts.data.tobytes()
        starts, inner = piece_starts(texts, tails=not any(token in raw for token in self.special))
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(texts) + 1, np.int64)
        ends = np.append(starts[1:], len(texts.data))
        at, place = distinct_ranges(texts.data, starts, ends)
        parts = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        found, new = self.recalled(parts)
        for i, ids in zip(new, self.encode([parts[i] for i in new], inner[at[new]]) if new else [], strict=True):
            found[i] = ids
            if len(parts[i]) <= CACHED_LENGTH:
                self.known[parts[i]] = ids
        flat = np.frombuffer(b"".join(found), dtype=self.dtype)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.dtype.itemsize
        lengths = sizes[place]
        ids = stretches(flat, (np.cumsum(sizes) - sizes)[place], lengths)
        return ids, np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, texts.offsets)]


def newer_letters() -> dict[int, str]:
    """Letters and digits that the tokenizers library, by its own version of Unicode, takes for symbols.

    They are asked for by blocks, as the library's answer takes some hundred bytes a character and every worker asks.
    """
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    found = {}
    for low in range(0, 0x110000, LETTER_BLOCK):
        block = "".join(chr(c) for c in range(low, low + LETTER_BLOCK) if not 0xD800 <= c < 0xE000)
        for kind, sample in (("L", "a"), ("N", "1")):
            known = regex.findall(rf"\p{{{kind}}}", block)
            ends = {end for _, (_, end) in split("".join(f"{sample}{c}\n" for c in known))}
            found.update({ord(c): SYMBOL for i, c in enumerate(known) if 3 * i + 1 in ends})
    return found


class Vocabulary:
    """Tokens, merges and the tables that the check of adjacent tokens needs."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model = stated["model"]
        if model["type"] != "BPE" or stated["pre_tokenizer"]["type"] != "ByteLevel" or stated["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        self.special = {t["content"]: t["id"] for t in stated["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in stated["added_tokens"]):
            raise ValueError("added tokens that take or hold white space are not supported")
        standing = [b for r in VISIBLE for b in r]
        hidden = [b for b in range(256) if b not in set(standing)]
        byte_of = {chr(b): b for b in standing} | {chr(256 + i): b for i, b in enumerate(hidden)}
        self.size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.bytes = [b""] * self.size
        for token, i in model["vocab"].items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.ids = {self.bytes[i]: i for i in model["vocab"].values()}
        self.rank = np.full(self.size, -1, dtype=np.int64)
        self.left = np.arange(self.size)
        self.right = np.arange(self.size)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = (model["vocab"][x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            token = self.ids[self.bytes[a] + self.bytes[b]]
            if self.rank[token] >= 0 or rank <= max(self.rank[a], self.rank[b]):
                raise ValueError("merges must be in the order in which their tokens arise, one per token")
            self.merge[a, b] = (rank, token)
            self.rank[token], self.left[token], self.right[token] = rank, a, b
        keys = np.array([a * self.size + b for a, b in self.merge], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.array([r for r, _ in self.merge.values()], dtype=np.int64)[order]
        merged = np.flatnonzero(self.rank >= 0)
        self.made = np.argsort(self.rank, kind="stable")[self.size - len(merged) :]
        whole = self.compatible(self.left[merged], self.right[merged], 2 * self.rank[merged])
        self.unstable = {int(t) for t in merged[~whole]}
        for t in merged.tolist():  # parts come before wholes
            if int(self.left[t]) in self.unstable or int(self.right[t]) in self.unstable:
                self.unstable.add(t)
        self.proposed = {b: i for b, i in self.ids.items() if i not in self.unstable}
        self.longest: dict[bytes, int] = {}
        for token in self.proposed:
            self.longest[token[:2]] = max(self.longest.get(token[:2], 1), len(token))
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int64)
        self.pattern = regex.compile(WORD_PATTERN)
        self.newer = newer_letters()
        self.first_newer = chr(min(self.newer, default=0x10FFFF))
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.decimals = Table([b"%d," % i for i in range(self.size)])
        self.contents = Table(self.bytes)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses from token ``a`` to a following ``b``, before time ``until``.

        Walks back in time. A merge of rank r happens at time 2r; of two equal merges the left one comes first, so
        what grows on the right counts as later by one. Whichever side grew last is undone; the pair met before that
        would have merged if its own rank came before either side grew.
        """
        good = np.ones(len(a), dtype=bool)
        limit = np.full(len(a), NEVER) if until is None else until.copy()
        a, b, at = a.copy(), b.copy(), np.arange(len(a))
        while len(at):
            keys = a * self.size + b
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            crosses = (self.keys[place] == keys) & (2 * self.ranks[place] < limit)
            good[at[crosses]] = False
            born_a, born_b = 2 * self.rank[a], 2 * self.rank[b] + 1
            undo_a = born_a > born_b
            limit = np.where(undo_a, born_a, born_b)
            going = ~crosses & (limit >= 0)
            a = np.where(undo_a, self.right[a], a)[going]
            b = np.where(undo_a, b, self.left[b])[going]
            limit, at = limit[going], at[going]
        return good

    def propose(self, word: bytes) -> list[int]:
        """The longest token at each place."""
        found, i, n = [], 0, len(word)
        proposed, longest = self.proposed, self.longest
        while i < n:
            end = min(n, i + longest.get(word[i : i + 2], 1))
            while (token := proposed.get(word[i:end])) is None:
                end -= 1
            found.append(token)
            i = end
        return found

    def merged(self, word: bytes) -> list[int]:
        """Step-by-step merging: lowest rank first, leftmost of equals; n log n in the length of the word."""
        ids = [self.ids[bytes([b])] for b in word]
        n = len(ids)
        following = list(range(1, n + 1))
        previous = list(range(-1, n - 1))
        queue = []
        for i, pair in enumerate(zip(ids, ids[1:], strict=False)):
            if pair in self.merge:
                rank, token = self.merge[pair]
                queue.append((rank, i, token, *pair))
        heapq.heapify(queue)
        while queue:
            _, i, token, a, b = heapq.heappop(queue)
            j = following[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = token, -1
            following[i] = following[j]
            if following[j] < n:
                previous[following[j]] = i
            for x, y in ((previous[i], i), (i, following[i])):
                if x >= 0 and y < n and (step := self.merge.get((ids[x], ids[y]))):
                    heapq.heappush(queue, (step[0], x, step[1], ids[x], ids[y]))
        return [t for t in ids if t >= 0]

    def merges_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or ``NEVER``."""
        keys = a * self.size + b
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.ranks[place], NEVER)

    def merged_together(self, words: list[bytes]) -> list[np.ndarray]:
        """The same for many short words: in each round every word does its first merge."""
        width = max(map(len, words))
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(-1, width)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ids = self.byte_ids[text]
        cols = np.arange(width)
        rank = np.full(ids.shape, NEVER)  # of the pair that starts here
        rank[:, :-1] = self.merges_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        rank[cols >= size[:, None] - 1] = NEVER
        result: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        word = np.arange(len(words))
        while len(word):
            at = rank.argmin(axis=1)
            row = np.arange(len(word))
            best = rank[row, at]
            for i in np.flatnonzero(best == NEVER):
                result[word[i]] = ids[i, : size[i]].astype(np.int32)
            going = best < NEVER
            ids, rank, size, word, at, best = ids[going], rank[going], size[going] - 1, word[going], at[going], best[going]
            row = np.arange(len(word))
            source = np.minimum(cols + (cols > at[:, None]), width - 1)
            ids, rank = np.take_along_axis(ids, source, 1), np.take_along_axis(rank, source, 1)
            ids[row, at] = self.made[best]
            rank[cols >= size[:, None] - 1] = NEVER
            for place, real in ((at - 1, at > 0), (at, at < size - 1)):
                r, c = row[real], place[real]
                rank[r, c] = self.merges_of(ids[r, c], ids[r, c + 1])
        return result

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Proposals for all words, one check of all their borders, exact merging of the words that fail.

        Gives the ids of all words, one after the other, and how many each has.
        """
        found = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(sizes.sum()))
        word = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, place = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        bad = ~self.compatible(pairs // self.size, pairs % self.size)[place]
        failing = np.unique(word[inner[bad]]).tolist()
        if not failing:
            return flat.astype(np.int32), sizes
        exact: dict[int, np.ndarray] = {}
        short = sorted((i for i in failing if len(words[i]) <= TOGETHER), key=lambda i: len(words[i]))
        for k in range(0, len(short), 20_000):
            some = short[k : k + 20_000]
            exact.update(zip(some, self.merged_together([words[i] for i in some]), strict=True))
        exact.update((i, np.array(self.merged(words[i]), dtype=np.int32)) for i in failing if len(words[i]) > TOGETHER)
        kept = np.ones(len(words), dtype=bool)
        kept[failing] = False
        merged_ids = np.concatenate([exact[i] for i in failing])
        merged_sizes = np.fromiter((len(exact[i]) for i in failing), dtype=np.int64, count=len(failing))
        begins = np.cumsum(sizes) - sizes
        begins[failing] = len(flat) + np.cumsum(merged_sizes) - merged_sizes
        sizes[failing] = merged_sizes
        return stretches(np.concatenate([flat.astype(np.int32), merged_ids]), begins, sizes), sizes

    def cut_words(self, part: str) -> list[str]:
        if part.isascii() or max(part, default="") < self.first_newer:
            return self.pattern.findall(part)
        ends = [m.end() for m in self.pattern.finditer(part.translate(self.newer))]
        return [part[i:j] for i, j in zip([0, *ends], ends, strict=False)]

    def cut_pieces(self, parts: list[bytes], inner: np.ndarray) -> tuple[list[bytes | int], np.ndarray]:
        """Words (special tokens as their ids) of all pieces, and the piece that each is of.

        Pieces that stay apart in any order are cut into words as one text.
        """
        together = np.flatnonzero(inner).tolist()
        text = b"".join([parts[i] for i in together]).decode()
        alone = np.flatnonzero(~inner).tolist()
        if self.cut_special and self.cut_special.search(text):  # special tokens hold no space, hence no cut
            special = {i for i in together if self.cut_special.search(parts[i].decode())}
            alone += sorted(special)
            together = [i for i in together if i not in special]
            text = b"".join([parts[i] for i in together]).decode()
        words: list[bytes | int] = [w.encode() for w in self.cut_words(text)]
        ends = np.cumsum(np.fromiter((len(parts[i]) for i in together), dtype=np.int64, count=len(together)))
        starts = np.cumsum([0, *map(len, words)])[:-1]
        owners = [np.array(together, dtype=np.int64)[np.searchsorted(ends, starts, side="right")]]
        for i in alone:
            sections = self.cut_special.split(parts[i].decode()) if self.cut_special else [parts[i].decode()]
            before = len(words)
            for k, section in enumerate(sections):
                words += [self.special[section]] if k % 2 else [w.encode() for w in self.cut_words(section)]
            owners.append(np.full(len(words) - before, i))
        return words, np.concatenate(owners)

    def encode_pieces(self, parts: list[bytes], inner: np.ndarray) -> list[bytes]:
        """Ids (as 32-bit numbers) of pieces of text: special tokens first, then words by the pattern."""
        words, owner = self.cut_pieces(parts, inner)
        known = dict.fromkeys(words)
        distinct = [w for w in known if isinstance(w, bytes)]
        special = [w for w in known if isinstance(w, int)]
        flat, sizes = self.encode_words(distinct)
        flat = np.concatenate([flat, np.array(special, dtype=np.int32)])
        sizes = np.concatenate([sizes, np.ones(len(special), np.int64)])
        places = {w: i for i, w in enumerate([*distinct, *special])}
        place = np.fromiter((places[w] for w in words), dtype=np.int64, count=len(words))
        order = np.argsort(owner, kind="stable")
        place, owner = place[order], owner[order]
        ids = stretches(flat, (np.cumsum(sizes) - sizes)[place], sizes[place])
        ends = 4 * np.cumsum(np.bincount(owner, weights=sizes[place], minlength=len(parts)).astype(np.int64))
        raw, ends = ids.tobytes(), ends.tolist()
        return [raw[i:j] for i, j in zip([0, *ends], ends, strict=False)]

    def decode(self, ids: Iterable[int]) -> str:
        """Text of token ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceCache:
    words = vocabulary(path)
    return PieceCache(words.encode_pieces, np.int32, words.special, WORKER_PIECES)


def encode(frame: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the token ids of each text as an array."""
    frame = frame.drop(ids)
    schema = frame.withColumn(ids, F.array(F.lit(0))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = encoder(path)
        for batch in batches:
            for texts in texts_of(batch.column(text)):
                part = batch.slice(texts.first, len(texts))
                found, bounds = cache.texts(texts)
                arrays = [*part.columns, pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(found))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, ids])

    return frame.mapInArrow(run, schema)


def decode(frame: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of an array of token ids; null ids give a null text."""
    frame = frame.drop(text)
    schema = frame.withColumn(text, F.lit("").cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = [None if x is None else words.decode(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    return frame.mapInArrow(run, schema)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def token_digests(documents: DataFrame, path: str) -> DataFrame:
    """Per document: number of tokens, and hashes of its ids and of the text decoded from them. One narrow pass."""
    schema = arrow_schema(DIGESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, words = encoder(path), vocabulary(path)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                ids, bounds = cache.texts(texts)
                decimals = [sha(x[:-1]) for x in words.decimals.joined(ids, bounds)]
                decoded = [sha(x.decode("utf-8", errors="replace").encode()) for x in words.contents.joined(ids, bounds)]
                doc_ids = batch.column("doc_id").slice(texts.first, len(texts))
                yield batch_of(schema, [doc_ids, np.diff(bounds), decimals, decoded])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, DIGESTS)
