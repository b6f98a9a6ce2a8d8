"""Exact byte-pair encoding by backtracking over longest matches, and decoding by offsets.

The encoder walks a word from left to right. At each place it takes the longest token that
starts there (found by an Aho-Corasick pass) and keeps it if the merges could have left the
previous token and this one side by side. Most words are done with that. If not, it tries the
token's longest proper prefix that is a token; without one it takes the previous token back.
Places known to lead nowhere are marked, so every place is left at most once and time is linear
in the word.

Two neighbours are compatible if no merge across their border comes earlier than the merges
that built them. Undoing these merges from the last to the first gives the symbols that touched
at the border; answers are kept in a table of pairs.
"""

from __future__ import annotations

import array
import functools
import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import fresh, ship, trim

# The pattern that splits text before the merges of byte-level vocabularies.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Unicode white space.
SPACE = "\t-\r \x85\xa0  -     　"

#: Bytes of each of the two generations of words that a worker keeps, and pairs that it keeps.
#: They save time, no result depends on them.
CACHE_BYTES, PAIRS = 64_000_000, 250_000
#: Bytes of a kept word beside its characters and tokens: two objects and a place in a table.
ENTRY = 200
#: Words up to so many characters are kept.
KEPT = 64
#: Texts whose tokens and decoded texts a worker holds at a time.
SLICE = 256
#: Letters below this one have been letters in every version of Unicode.
SETTLED = "\u0250"


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabulary files."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    symbols = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [symbols[b] for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary file with its merges, read once per worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        raw = {c: chr(b) for b, c in enumerate(byte_symbols())}
        plain = {t: "".join(raw[c] for c in t) for t in spec["model"]["vocab"]}
        self.ids = {plain[t]: i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: t.encode("latin-1") for t, i in self.ids.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        top = max(self.bytes_of) + 1
        # by token: its bytes, the rank of the merge that makes it, and the merge's two parts; by
        # pair: the rank of the merge
        self.length = [len(self.bytes_of.get(i, b"")) for i in range(top)]
        self.rank = [-1] * top
        self.left, self.right = [0] * top, [0] * top
        self.merge: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            left, right = plain[left], plain[right]
            whole, left, right = self.ids[left + right], self.ids[left], self.ids[right]
            self.merge[left << 32 | right] = rank
            if self.rank[whole] < 0:
                self.rank[whole], self.left[whole], self.right[whole] = rank, left, right
        self.never = len(self.merge)
        self.prefix = self._prefixes(top)
        self.matcher = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.matcher.add_word(text, i)
        self.matcher.make_automaton()
        self.compatible: dict[int, bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.room = CACHE_BYTES
        self.split_words = regex.compile(WORDS).findall
        self.split_chunks = re.compile(
            f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
        ).findall
        marks = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.split_special = re.compile(f"({'|'.join(marks)})").split if marks else None
        pieces = [self.bytes_of.get(i, b"") for i in range(top)]
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        self.buffer = np.frombuffer(b"".join(pieces), np.uint8)

    def _prefixes(self, top: int) -> list[int]:
        """By token, the longest other token that its text begins with, or -1."""
        out = [-1] * top
        open_: list[str] = []  # texts of which each begins with the one before
        for text in sorted(self.ids):
            while open_ and not text.startswith(open_[-1]):
                open_.pop()
            if open_:
                out[self.ids[text]] = self.ids[open_[-1]]
            open_.append(text)
        return out

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the merges can leave the two tokens side by side."""
        key = left << 32 | right
        merge, rank, never = self.merge.get, self.rank, self.never
        # until when the two symbols at the border stay as they are; equal merges go from left
        # to right, so the right one's own merge comes after one across the border
        until, good = never, True
        while True:
            if merge(left << 32 | right, never) < until:
                good = False
                break
            made_left, made_right = rank[left], rank[right]
            if made_left > made_right:
                until, left = made_left, self.right[left]
            elif made_right >= 0:
                until, right = made_right + 1, self.left[right]
            else:
                break
        if len(self.compatible) >= PAIRS:
            self.compatible.clear()
        self.compatible[key] = good
        return good

    def encode_word(self, text: str) -> list[int]:
        """The tokens of one piece of the split, given as one character per byte."""
        greedy = [token for _, token in self.matcher.iter_long(text)]
        known, last = self.compatible.get, -1
        for i, token in enumerate(greedy):
            if last >= 0:
                good = known(last << 32 | token)
                if not (self._compatible(last, token) if good is None else good):
                    return self._backtracked(text, greedy, i)
            last = token
        return greedy

    def _backtracked(self, text: str, greedy: list[int], i: int) -> list[int]:
        """The same where the i-th of the longest tokens does not go with the one before."""
        lengths, prefix, known = self.length, self.prefix, self.compatible.get
        match = self.matcher.iter_long
        longest, at = {}, 0
        for token in greedy:
            longest[at] = token
            at += lengths[token]
        done, token, size = greedy[:i], greedy[i], len(text)
        at = sum([lengths[t] for t in done])
        dead: set[int] = set()
        while True:
            end = at + lengths[token]
            if end not in dead:
                good = True
                if done:
                    good = known(done[-1] << 32 | token)
                    if good is None:
                        good = self._compatible(done[-1], token)
                if good:
                    done.append(token)
                    if end == size:
                        return done
                    at = end
                    token = longest.get(at, -1)
                    if token < 0:
                        token = longest[at] = next(match(text, at))[1]
                    continue
            token = prefix[token]
            while token < 0:
                dead.add(at)
                token = done.pop()
                at -= lengths[token]
                token = prefix[token]

    def forget(self) -> None:
        """Let go of all remembered words and pairs."""
        self.young, self.old, self.room = {}, {}, CACHE_BYTES
        self.compatible.clear()

    def _keep(self, piece: str, packed: bytes) -> bytes:
        """Remember a piece; the older of two generations makes room for a new one."""
        if len(piece) <= KEPT:
            self.room -= len(piece) + len(packed) + ENTRY
            if self.room < 0:
                self.old, self.young, self.room = self.young, {}, CACHE_BYTES
            self.young[piece] = packed
        return packed

    def packed(self, word: str) -> bytes:
        """The tokens of one piece of the split, as 32-bit integers."""
        known = self.young.get(word)
        if known is not None:
            return known
        known = self.old.get(word)
        if known is None:
            raw = word if word.isascii() else word.encode("utf-8", "replace").decode("latin-1")
            tokens = self.encode_word(raw)
            known = array.array("i", tokens).tobytes()
        return self._keep(word, known)

    def chunk(self, chunk: str) -> bytes:
        """The tokens of one run between white space that is not among the young ones."""
        known = self.old.get(chunk)
        if known is not None:
            return self._keep(chunk, known)
        # most runs are a word of letters, perhaps with a mark behind it; the pattern that splits
        # any other would give the same
        body = chunk[1:] if chunk[0] == " " else chunk
        if body.isascii() or max(body) < SETTLED:
            if body.isalpha():
                return self.packed(chunk)
            if body[-1:] in (",", ".", "!", "?", ";", ":") and body[:-1].isalpha():
                return self._keep(chunk, self.packed(chunk[:-1]) + self.packed(chunk[-1]))
        packed = b"".join([self.packed(word) for word in self.split_words(chunk)])
        return self._keep(chunk, packed)

    def _plain(self, text: str) -> bytes:
        chunk, known = self.chunk, self.young.get
        return b"".join([known(c) or chunk(c) for c in self.split_chunks(text)])

    def encode(self, text: str | None) -> np.ndarray:
        """All token ids of a text; names of special tokens in it become these tokens."""
        if not text:
            return np.zeros(0, np.int32)
        if self.split_special is None or not any(s in text for s in self.special):
            return np.frombuffer(self._plain(text), np.int32)
        return np.frombuffer(
            b"".join(
                np.int32(self.special[part]).tobytes() if i % 2 else self._plain(part)
                for i, part in enumerate(self.split_special(text))
            ),
            np.int32,
        )

    def words_of(self, text: str) -> list[str]:
        """The pieces of a text that are encoded on their own, in order."""
        if self.split_special is None or not any(s in text for s in self.special):
            return self.split_words(text)
        out = []
        for i, part in enumerate(self.split_special(text)):
            out += [part] if i % 2 else self.split_words(part)
        return out

    def count_word(self, word: str) -> int:
        """The number of tokens of one piece."""
        if word in self.special:
            return 1
        return len(self.packed(word)) // 4

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become the replacement character."""
        ids = ids[(ids >= 0) & (ids < len(self.offsets) - 1)]
        starts, lengths = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(starts - ends + lengths, lengths)
        return self.buffer[places].tobytes().decode("utf-8", "replace")


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, kept for the life of the worker."""
    return Vocabulary(path)


def encoded(text: Column, path: str) -> Column:
    """Token ids (array of int) of a text column; null and empty texts have none."""
    ship()

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        own = vocabulary(path)
        ids = [own.encode(t.as_py()) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        trim()
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))

    return encode(text)


def decoded(ids: Column, path: str) -> Column:
    """The text of an array of token ids; null ids give an empty text, unknown ids nothing."""
    ship()

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        own = vocabulary(path)
        texts = []
        for x in lists:
            values = x.values.drop_null().to_numpy() if x.is_valid else np.zeros(0, np.int32)
            texts.append(own.decode(values))
        trim()
        return pa.array(texts, pa.string())

    return decode(ids)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text, as the vocabulary file encodes it.

    Null and empty texts have no ids. Other columns stay; one called as ``ids`` is replaced.
    Every text is encoded on its own, so ties, repeats and empty tables need no care, and a
    long text costs time and memory in proportion to its length.
    """
    return docs.withColumn(ids, encoded(F.col(text).cast("string"), path))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of each list of ids; see ``decoded`` for nulls."""
    return docs.withColumn(text, decoded(F.col(ids).cast("array<int>"), path))


def round_trip(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass over the rows.

    Of the one after the other Spark makes a plan that encodes every text twice, once for the
    ids and once for what is decoded.
    """
    ship()

    @F.arrow_udf("struct<ids: array<int>, text: string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = vocabulary(path)
        for whole in batches:
            for start in range(0, len(whole), SLICE):
                found = [own.encode(t.as_py()) for t in whole.slice(start, SLICE)]
                back = pa.array([own.decode(x) for x in found], pa.string())
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])])
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(found), pa.int32())
                )
                yield pa.StructArray.from_arrays([lists, back], ["ids", "text"])
            trim()
        own.forget()  # the worker goes on to tasks of other kinds
        trim()

    result = both(F.col(text).cast("string"))
    pair = fresh()
    return (
        docs.withColumn(pair, result)
        .withColumns({ids: F.col(pair)["ids"], decoded: F.col(pair)["text"]})
        .drop(pair)
    )
