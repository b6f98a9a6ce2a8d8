"""Repair of conversations by weighted interval parsing.

A conversation should read: perhaps a system turn, then pairs of a user's and an assistant's
turn. The cheapest edits that make it so are found in the manner of Cocke, Younger and Kasami:
a cell for every span of rows and every nonterminal of a grammar in Chomsky normal form, with the
least (cost, audit) of all parses of that span.

The nonterminals are pairs of places in the pattern: ``[p, q]`` derives the rows that lead from
``p`` to ``q``. Its rules are ``[p, q] -> [p, r] [r, q]``, and a terminal rule for each edit of a
row. Empty rules insert turns; their closure is worked into every cell. Costs add up and audits
are joined, and as the places where a span can be cut mean the same to all its parses, every cut
gives the same cell. So a span is put together from two neighbours once, bottom-up by length.

This also holds across tasks. Rows are sorted into ranges that cut through long conversations;
each task fills the cells of its part, and parts are joined, a few neighbours at a time, until
each conversation is one span. Texts are read again only to carry out the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import exact_key, ship, slices
from stationlake.session import discard, materialise

# White space, ends of sentences, the costs of edits, and their initials.
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}

#: The pattern ``(s?(ua)+)?`` as places and what leads from one to the next: the start, behind a
#: system turn, behind a user's, behind an assistant's. It may end at the first and the last.
PLACES = 4
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LAST = (0, 3)
#: The letter that may be put in at each place.
WANTED = {p: letter for (p, letter) in NEXT if letter in ROLES}

#: Parts of a conversation that are joined at a time.
NEIGHBOURS = 8

CLEAN, BLANK, DUPLICATE, CUT_OFF = range(4)

Cell = list[tuple[int, str] | None]
_WAYS = list(product(range(PLACES), repeat=3))


def joined(left: Cell, right: Cell) -> Cell:
    """The cells of two neighbouring spans as those of one."""
    out: Cell = [None] * PLACES**2
    for p, r, q in _WAYS:
        one, other = left[p * PLACES + r], right[r * PLACES + q]
        if one and other:
            cost, best = one[0] + other[0], out[p * PLACES + q]
            if best is None or cost <= best[0]:
                found = cost, one[1] + other[1]
                if best is None or found < best:
                    out[p * PLACES + q] = found
    return out


@cache
def inserted() -> Cell:
    """The cells of no row at all: the closure of inserting turns."""
    out: Cell = [(0, "") if p == q else None for p, q in product(range(PLACES), repeat=2)]
    for p, letter in WANTED.items():
        out[p * PLACES + NEXT[p, letter]] = INSERT, "I"
    while (more := joined(out, out)) != out:
        out = more
    return out


@cache
def of_row(initial: str, fault: int) -> Cell:
    """The cells of one row, with turns inserted before and behind it."""
    out: Cell = [None] * PLACES**2
    for p in range(PLACES):
        edits = [(DELETE, "D", p)]
        if fault not in (BLANK, DUPLICATE):
            extra = TRUNCATED if fault == CUT_OFF else 0
            if (p, initial) in NEXT:
                edits.append((KEEP + extra, "K", NEXT[p, initial]))
            edits.append((REROLE + extra, "R", NEXT[p, WANTED[p]]))
        for cost, letter, q in edits:
            found, best = (cost, letter), out[p * PLACES + q]
            out[p * PLACES + q] = min(found, best or found)
    return joined(joined(inserted(), out), inserted())


def best(cells: Cell) -> tuple[int, str]:
    """The cheapest edits of a whole conversation, as cost and audit."""
    return min(found for q in LAST if (found := cells[q]))


@dataclass
class Span:
    """What is known of a run of a conversation's rows."""

    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    first: str = ""
    last: str = ""
    illegal: int = 0
    rows: int = 0
    cells: Cell = field(default_factory=inserted)

    @classmethod
    def of(cls, turn: int | None, initial: str, fault: int) -> Span:
        """That of a single row."""
        return cls(
            turn, turn, int(turn is not None),
            int(fault == BLANK), int(fault == DUPLICATE), int(fault == CUT_OFF),
            initial, initial, 0, 1, of_row(initial, fault),
        )

    def __add__(self, other: Span) -> Span:
        if not (self.rows and other.rows):
            return self if self.rows else other
        met = self.last_turn is not None and self.last_turn == other.first_turn
        return Span(
            other.first_turn if self.first_turn is None else self.first_turn,
            self.last_turn if other.last_turn is None else other.last_turn,
            self.turns + other.turns - met,
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            self.first,
            other.last,
            self.illegal + other.illegal + (self.last + other.first not in ("su", "ua", "au")),
            self.rows + other.rows,
            joined(self.cells, other.cells),
        )


class Growing:
    """Spans that are joined bottom-up by their length as rows come in."""

    def __init__(self):
        self.spans: list[Span] = []

    def add(self, span: Span) -> None:
        self.spans.append(span)
        while len(self.spans) > 1 and self.spans[-2].rows <= self.spans[-1].rows:
            right = self.spans.pop()
            self.spans[-1] += right

    def whole(self) -> Span:
        out = Span()
        for span in reversed(self.spans):
            out = span + out
        return out


_FIELDS = {
    "first_turn": "long", "last_turn": "long", "turns": "long", "blank": "long",
    "duplicate": "long", "truncated": "long", "first": "string", "last": "string",
    "illegal": "long", "rows": "long",
}
_KINDS = {"long": pa.int64(), "string": pa.string()}
_SPAN = ", ".join(f"{k} {v}" for k, v in _FIELDS.items()) + ", costs array<long>, audits array<string>"


def _written(spans: list[Span]) -> dict[str, pa.Array]:
    out = {k: pa.array([getattr(s, k) for s in spans], _KINDS[v]) for k, v in _FIELDS.items()}
    costs = [[c and c[0] for c in s.cells] for s in spans]
    audits = [[c and c[1] for c in s.cells] for s in spans]
    out["costs"] = pa.array(costs, pa.list_(pa.int64()))
    out["audits"] = pa.array(audits, pa.list_(pa.string()))
    return out


def _read(row: dict) -> Span:
    cells = [None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"])]
    return Span(**{k: row[k] for k in _FIELDS}, cells=cells)


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults that follow from each row's place.

    Nulls in role and text become one space, as do nulls of the key, the text
    ``conv_id:turn``. Of its CRC-32 modulo 20, 0 drops the row, 1 empties its text, 2 takes out
    ``.``, ``!`` and ``?``, 3 gives the row twice and 4 makes its role ``user``.
    """

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = (
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.translate(filled("text"), "".join(ENDS), ""))
        .otherwise(filled("text"))
    )
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    damaged = rows.where(kind != 0).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(filled("role")).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("copy"),
    )
    return damaged.drop("copy")


def _rows(rows: DataFrame) -> DataFrame:
    """The four columns, without nulls in role and text, and a key of these two."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
    ).withColumn("key", exact_key("role", "text"))


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, key, n, initial, fault`` of each row; ``n`` is a number of its own.

    A row is blank without a character other than white space, else a duplicate if an earlier
    row of its conversation has its role and text, else cut off unless it ends in ``.``, ``!`` or
    ``?``. First rows are found by an aggregation, so that a row that makes up most of a
    conversation meets in no task.
    """
    body = F.rtrim(F.col("text"), F.lit(SPACE))
    light = materialise(
        _rows(rows).select(
            "conv_id",
            "turn",
            "key",
            F.substring("role", 1, 1).alias("initial"),
            F.when(body == "", F.lit(BLANK))
            .when(~F.right(body, F.lit(1)).isin(*ENDS), F.lit(CUT_OFF))
            .otherwise(F.lit(CLEAN))
            .alias("own"),
            F.monotonically_increasing_id().alias("n"),
        )
    )
    first = light.groupBy("conv_id", "key").agg(F.min(F.struct("turn", "n")).alias("first"))
    first = first.select(F.col("first.n").alias("n"), F.lit(True).alias("first"))
    again = F.col("first").isNull() & (F.col("own") != BLANK)
    return light.join(first, "n", "left").select(
        "conv_id", "turn", "key", "n", "initial",
        F.when(again, F.lit(DUPLICATE)).otherwise(F.col("own")).alias("fault"),
    )


def _parts(found: DataFrame) -> DataFrame:
    """A span for each conversation in each range of rows: ``conv_id, part, open`` and the span.

    ``open`` spans are at the border of their range and may go on beyond it.
    """
    ship()
    order = ["conv_id", "turn", "key", "n"]
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = (
        found.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .select("conv_id", "turn", "initial", "fault", F.spark_partition_id().alias("part"))
    )

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, growing, part, first = None, None, None, True

        def done(last: bool) -> list:
            return [(at[0], part, first or last, growing.whole())] if at else []

        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (row[0],):
                    if at:
                        out += done(False)
                        first = False
                    at, growing = (row[0],), Growing()
                growing.add(Span.of(*row[1:4]))
                part = row[4]
            yield _batch(out)
        yield _batch(done(True))

    return ranges.mapInArrow(grow, f"conv_id long, part int, open boolean, {_SPAN}")


def _batch(spans: list[tuple]) -> pa.RecordBatch:
    ids, parts, opened = ([s[i] for s in spans] for i in range(3))
    head = {
        "conv_id": pa.array(ids, pa.int64()),
        "part": pa.array(parts, pa.int32()),
        "open": pa.array(opened, pa.bool_()),
    }
    return pa.RecordBatch.from_pydict(head | _written([s[3] for s in spans]))


def _merged(parts: DataFrame) -> DataFrame:
    """Open spans joined until no conversation has two; there are two a range at most."""

    def merge(key: tuple, found: pa.Table) -> pa.Table:
        growing = Growing()
        rows = sorted(found.to_pylist(), key=lambda r: r["part"])
        for row in rows:
            growing.add(_read(row))
        return pa.Table.from_batches([_batch([(rows[0]["conv_id"], rows[0]["part"], True, growing.whole())])])

    while not parts.groupBy("conv_id").count().where("count > 1").isEmpty():
        number = F.row_number().over(Window.partitionBy("conv_id").orderBy("part")) - 1
        near = parts.withColumn("near", F.floor(number / NEIGHBOURS))
        shorter = near.groupBy("conv_id", "near").applyInArrow(
            merge, f"conv_id long, part int, open boolean, {_SPAN}"
        )
        before, parts = parts, materialise(shorter)
        discard(before)
    return parts


def _summary(parts: DataFrame) -> DataFrame:
    ends = [F.struct(F.col("costs")[q].alias("cost"), F.col("audits")[q].alias("audit")) for q in LAST]
    whole = F.array_min(F.filter(F.array(*ends), lambda end: end["cost"].isNotNull()))
    gaps = F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")
    return parts.select(
        "conv_id",
        F.coalesce(gaps, F.lit(0)).alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        whole["cost"].alias("cost"),
        whole["audit"].alias("audit"),
    )


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest repair of each conversation, and what is wrong with it.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``. Rows come by turn,
    nulls first, then by a hash of role and text. Edits are Keep (0), Rerole to user or assistant
    (2), Delete (3; blank and duplicate rows must go) and Insert an empty turn (2); rows that are
    cut off and stay cost 1 more. The audit has their initials in order; of equal costs the least
    audit wins. Kept roles count by their first letter, and a role without one cannot be kept.

    A null role or text counts as one space. A null ``conv_id`` is a conversation of its own, a
    null turn no part of ``gaps``. Repeated rows are duplicates. An empty table gives no rows;
    other columns play no part. Long texts are hashed in place. An audit has a letter or two a
    row, so that a task that joins the parts of a very long conversation holds some tens of bytes
    for each of its rows.
    """
    parts = materialise(_parts(faults(rows)))
    opened = materialise(parts.where("open"))
    return _summary(parts.where("NOT open").unionByName(_merged(opened)))


def _edited(
    rows: DataFrame, audits: DataFrame, schema: str, carry_out: Callable[..., Iterator]
) -> DataFrame:
    """What ``carry_out`` makes of each conversation's audit and the rows behind it."""
    ship()
    own = _rows(rows)
    head = audits.select(
        "conv_id",
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
        F.lit(None).cast("binary").alias("key"),
        F.lit(True).alias("head"),
    )
    order = ["conv_id", F.col("head").desc(), "turn", "key"]
    return (
        head.unionByName(own.withColumn("head", F.lit(False)))
        .repartition("conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", "head", "role", "text")
        .mapInArrow(carry_out, schema)
    )


class _Edits:
    """Carries out an audit row by row: ``(edit, role, text)`` of the turns that come out."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0

    def _put(self, letter: str) -> str:
        self.place = NEXT[self.place, letter]
        return ROLES.get(letter, "")

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield "I", self._put(WANTED[self.place]), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role[:1])
            yield edit, role, text
        elif edit == "R":
            yield edit, self._put(WANTED[self.place]), text


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(conv_id, None)`` where a conversation begins, ``(conv_id, turn)`` for what comes out."""
    edits, at = None, None
    for batch in batches:
        for part in slices(batch):
            for number, head, role, text in zip(*part.columns):
                if head.as_py():
                    if edits:
                        yield from ((at, turn) for turn in edits.inserts())
                    edits, at = _Edits(text.as_py()), number.as_py()
                    yield at, None
                else:
                    yield from ((at, turn) for turn in edits.row(role.as_py(), text.as_py()))
    if edits:
        yield from ((at, turn) for turn in edits.inserts())


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv_id, position, edit, role, text``: the turns that the audits of ``repair`` leave.

    ``rows`` are those that were given to ``repair``. Positions count from 0.
    """

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, position = [], 0
        for number, turn in _turns(batches):
            if turn is None:
                position = 0
                continue
            out.append((number, position, *turn))
            position += 1
            if len(out) == 512:
                yield write(out)
                out = []
        yield write(out)

    def write(found: list) -> pa.RecordBatch:
        kinds = {"conv_id": pa.int64(), "position": pa.int64()}
        names = ("conv_id", "position", "edit", "role", "text")
        return pa.RecordBatch.from_pydict(
            {c: pa.array([x[i] for x in found], kinds.get(c, pa.string())) for i, c in enumerate(names)}
        )

    return _edited(rows, audits, "conv_id long, position long, edit string, role string, text string", turns)


def repaired_digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the repaired turns as ``role:text``, joined by newlines.

    A conversation's rows stream through one task in order, as the digest needs them.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, digest, mark = [], None, None, b""
        for number, turn in _turns(batches):
            if turn is None:
                if digest:
                    out.append((at, digest.hexdigest()))
                at, digest, mark = number, hashlib.sha256(), b""
                if len(out) >= 4096:
                    yield write(out)
                    out = []
            else:
                digest.update(mark + f"{turn[1]}:{turn[2]}".encode())
                mark = b"\n"
        if digest:
            out.append((at, digest.hexdigest()))
        yield write(out)

    def write(found: list) -> pa.RecordBatch:
        columns = {"conv_id": pa.array([x[0] for x in found], pa.int64())}
        columns["repaired_sha256"] = pa.array([x[1] for x in found], pa.string())
        return pa.RecordBatch.from_pydict(columns)

    return _edited(rows, audits, "conv_id long, repaired_sha256 string", digests)


def report(rows: DataFrame, every: DataFrame) -> DataFrame:
    """``repair`` with ``repaired_sha256``, for each ``conv_id`` of ``every``, with rows or not."""
    summary = materialise(repair(rows))
    digests = repaired_digests(rows, summary.select("conv_id", "audit"))
    ids = every.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    nothing = {
        "audit": F.lit(""),
        "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest()),
    }

    def same(one: DataFrame, other: DataFrame) -> Column:
        return one["conv_id"].eqNullSafe(other["conv_id"])

    out = ids.join(summary, same(ids, summary), "left").drop(summary["conv_id"])
    out = out.join(digests, same(ids, digests), "left").drop(digests["conv_id"])
    return out.select(
        "conv_id",
        *[
            F.coalesce(c, nothing.get(c, F.lit(0))).alias(c)
            for c in (*summary.columns[1:], "repaired_sha256")
        ],
    )
