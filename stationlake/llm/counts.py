"""Token counts that follow edits without encoding texts anew.

A document keeps a segment tree over its pre-tokens. A leaf stands for some consecutive runs
between white space (each of which is encoded on its own) and has their characters and tokens;
inner nodes have the sums below them, so the root has the document's counts. An edit finds its
leaves by the sums of characters, encodes only these leaves and their boundary context, and adds
what changed to the sums above them.

The context is what can change how the text around an edit is split: a run's end depends on two
characters after it, and a special token on its own length. Encoding starts at a leaf that begins
far enough before the edit, and ends where a run begins at the old place of a leaf that begins far
enough behind it.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.bpe import Vocabulary, vocabulary
from stationlake.llm.common import fresh, ship

#: Runs of a leaf, and the multiple of them at which a tree is built anew.
RUNS, GROWN = 32, 4
STATE = "tokens array<int>, chars array<int>"


class Counter:
    """Counts the tokens of runs, which the vocabulary remembers."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.context = max([2, *(len(s) for s in vocabulary.special)]) + 1

    def runs(self, text: str) -> list[str]:
        """The runs of a text, in order; special tokens are runs of their own."""
        own = self.vocabulary
        if own.split_special is None or not any(s in text for s in own.special):
            return own.split_chunks(text)
        out = []
        for i, part in enumerate(own.split_special(text)):
            out += [part] if i % 2 else own.split_chunks(part)
        return out

    def counts(self, runs: list[str]) -> list[int]:
        own = self.vocabulary
        known, chunk, special = own.young.get, own.chunk, own.special
        return [1 if r in special else len(known(r) or chunk(r)) // 4 for r in runs]


def _tree(leaves: np.ndarray) -> np.ndarray:
    """Sums over a power of two of leaves; node i has the children 2 i and 2 i + 1."""
    size = 1 << max(int(len(leaves) - 1).bit_length(), 0)
    tree = np.zeros(2 * size, np.int32)
    tree[size : size + len(leaves)] = leaves
    while size > 1:
        half = tree[size : 2 * size]
        size //= 2
        tree[size : 2 * size] = half[::2] + half[1::2]
    return tree


def _set(tree: np.ndarray, places: range, values: list[int]) -> None:
    """Give leaves new values and update the sums above them."""
    size = len(tree) // 2
    changed = set()
    for place, value in zip(places, values):
        tree[size + place] = value
        changed.add((size + place) // 2)
    while changed and 0 not in changed:
        for node in changed:
            tree[node] = tree[2 * node] + tree[2 * node + 1]
        changed = {node // 2 for node in changed}


def _leaf_at(tree: np.ndarray, offset: int) -> tuple[int, int]:
    """The leaf that has the character at an offset (the last leaf, beyond), and its start."""
    size, node, start = len(tree) // 2, 1, 0
    while node < size:
        node *= 2
        if offset - start >= tree[node] and tree[node + 1]:
            start += int(tree[node])
            node += 1
    return node - size, start


def build(counter: Counter, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Trees of tokens and characters of a text."""
    runs = counter.runs(text)
    if not runs:
        return np.zeros(2, np.int32), np.zeros(2, np.int32)
    cuts = np.arange(0, len(runs), RUNS)
    tokens = np.add.reduceat(np.array(counter.counts(runs), np.int32), cuts)
    chars = np.add.reduceat(np.array([len(r) for r in runs], np.int32), cuts)
    return _tree(tokens), _tree(chars)


def edit(
    counter: Counter,
    text: str,
    tokens: np.ndarray,
    chars: np.ndarray,
    start: int,
    removed: int,
    inserted: str,
) -> tuple[str, np.ndarray, np.ndarray, int]:
    """Text and trees after an edit, and the number of characters that were encoded."""
    start = min(max(start, 0), len(text))
    removed = min(max(removed, 0), len(text) - start)
    end = start + removed
    new = text[:start] + inserted + text[end:]
    shift = len(inserted) - removed
    size = len(chars) // 2
    first, begin = _leaf_at(chars, max(start - counter.context, 0))
    # leaves that begin far enough behind the edit may go on as they are
    last, place = _leaf_at(chars, end)
    last, place = last + 1, place + int(chars[size + last])
    runs: list[str] = []
    while True:
        while place < len(text) and (place < end + counter.context or not chars[size + last]):
            place += int(chars[size + last])
            last += 1
        if place >= len(text):
            last = size
            runs = counter.runs(new[begin:])
            break
        # the next leaf is read along, to see whether a run begins where it did
        along = max(int(chars[size + last]), counter.context)
        runs = counter.runs(new[begin : place + along + shift])
        length, at = 0, place + shift - begin
        for i, r in enumerate(runs):
            if length >= at:
                break
            length += len(r)
        if length == at:
            runs = runs[:i]
            break
        place += int(chars[size + last])
        last += 1
    encoded = sum(map(len, runs))
    if last == size:
        last = max(first + 1, size - int(np.argmax(chars[size:][::-1] > 0)))
    slots = range(first, last)
    each = -(-len(runs) // len(slots)) if runs else 1
    if each > RUNS * GROWN:
        # grown too much: the leaves are laid out anew
        old_t, old_c = tokens[size:], chars[size:]
        own = [runs[i : i + RUNS] for i in range(0, len(runs), RUNS)]
        t = [sum(counter.counts(r)) for r in own]
        c = [sum(map(len, r)) for r in own]
        tokens = _tree(np.concatenate([old_t[:first], t, old_t[last:]]).astype(np.int32))
        chars = _tree(np.concatenate([old_c[:first], c, old_c[last:]]).astype(np.int32))
        return new, tokens, chars, encoded
    own = [runs[i * each : (i + 1) * each] for i in range(len(slots))]
    tokens, chars = tokens.copy(), chars.copy()
    _set(tokens, slots, [sum(counter.counts(r)) for r in own])
    _set(chars, slots, [sum(map(len, r)) for r in own])
    return new, tokens, chars, encoded


_counters: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(vocabulary(path))
    return _counters[path]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def tree_of(text: Column, path: str) -> Column:
    """Struct (tokens, chars) of trees of a whole text; of zeros for a null or empty one."""
    ship()

    @F.arrow_udf(STATE)
    def made(texts: pa.Array) -> pa.Array:
        own = _counter(path)
        trees = [build(own, t or "") for t in texts.to_pylist()]
        columns = [_lists([t for t, _ in trees]), _lists([c for _, c in trees])]
        return pa.StructArray.from_arrays(columns, ["tokens", "chars"])

    return made(text)


def with_counts(
    docs: DataFrame, path: str, text: str = "text", state: str = "state", name: str = "n_tokens"
) -> DataFrame:
    """``docs`` with the segment tree of each whole text and its number of tokens.

    Null and empty texts have 0 tokens. Columns of the given names are replaced, others stay.
    """
    treed = docs.withColumn(state, tree_of(F.col(text).cast("string"), path))
    return treed.withColumn(name, F.get(F.col(state)["tokens"], F.lit(1)).cast("bigint"))


def _edited(own: Counter, text: str, trees: tuple, changes: list | None) -> tuple:
    """Text, trees and number of encoded characters after some edits."""
    tokens, chars = trees
    total = 0
    for e in changes or ():
        if e is not None:
            text, tokens, chars, n = edit(
                own, text, tokens, chars, e["start"] or 0, e["removed"] or 0, e["inserted"] or ""
            )
            total += n
    return text, tokens, chars, total


def apply_edits(
    docs: DataFrame,
    path: str,
    edits: str = "edits",
    text: str = "text",
    state: str = "state",
    name: str = "n_tokens",
    before: str = "n_tokens_before",
    encoded: str = "n_encoded",
) -> DataFrame:
    """Apply each row's edits to its text, tree and count.

    ``edits`` is an array of struct<start, removed, inserted>, applied in order: ``removed``
    characters from ``start`` of the text so far give way to the string ``inserted``. Offsets
    beyond the text count as its end, negative ones as 0, null ones as 0 and a null string as
    empty; a null array changes nothing. Without a column ``state`` the trees are built first.
    ``name`` gets the new count, ``before`` the old one, and ``encoded`` the number of
    characters that were encoded for the edits. A null text becomes a text if something is
    inserted. Columns of these names are replaced, others stay.
    """
    ship()
    kind = f"text string, {STATE}, before bigint, encoded bigint"
    names = ["text", "tokens", "chars", "before", "encoded"]

    def run(texts: list, trees: Iterable[tuple], lists: list) -> pa.Array:
        own = _counter(path)
        out, tokens, chars, old, work = [], [], [], [], []
        for own_text, (t, c), changes in zip(texts, trees, lists):
            now, new_t, new_c, total = _edited(own, own_text or "", (t, c), changes)
            out.append(now if now or own_text is not None else None)
            tokens.append(new_t)
            chars.append(new_c)
            old.append(int(t[1]))
            work.append(total)
        columns = [pa.array(out, pa.string()), _lists(tokens), _lists(chars)]
        columns += [pa.array(c, pa.int64()) for c in (old, work)]
        return pa.StructArray.from_arrays(columns, names)

    @F.arrow_udf(kind)
    def from_state(texts: pa.Array, states: pa.Array, lists: pa.Array) -> pa.Array:
        parts = (states.field("tokens"), states.field("chars"))
        trees = (tuple(p[i].values.to_numpy() for p in parts) for i in range(len(texts)))
        return run(texts.to_pylist(), trees, lists.to_pylist())

    @F.arrow_udf(kind)
    def from_text(texts: pa.Array, lists: pa.Array) -> pa.Array:
        own, found = _counter(path), texts.to_pylist()
        return run(found, (build(own, t or "") for t in found), lists.to_pylist())

    done, whole = fresh(), F.col(text).cast("string")
    if state in docs.columns:
        rows = docs.withColumn(done, from_state(whole, F.col(state), F.col(edits)))
    else:
        rows = docs.withColumn(done, from_text(whole, F.col(edits)))
    new = F.col(done)
    return rows.withColumns(
        {
            text: new["text"],
            state: F.struct(new["tokens"].alias("tokens"), new["chars"].alias("chars")),
            name: F.get(new["tokens"], F.lit(1)).cast("bigint"),
            before: new["before"],
            encoded: new["encoded"],
        }
    ).drop(done)


def count_text(path: str, text: str | None) -> int:
    """The number of tokens of a text, encoded as a whole."""
    return len(vocabulary(path).encode(text))
