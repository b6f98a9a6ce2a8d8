"""Near-duplicate texts by BagMinHash signatures of their word shingles.

A text is the multiset of its runs of ``WORDS`` words, and two texts are near duplicates if their
weighted Jaccard similarity (sum of the lesser over sum of the greater counts) is at least
``SIMILARITY``.

*Signatures.* Think of each shingle as a line of weights, and of random points on it over time: a
Poisson process of rate 1 per unit of weight. A text sees the points below its shingle's count.
Every point belongs to one of ``BANDS * ROWS`` slots, and the signature has the first point seen
in each, so two signatures agree in a slot with a chance of just their similarity. Weights are
discretised to whole counts, and the processes are hierarchical: an interval of weights [2^k,
2^(k+1)) has one process of rate 2^k, whose points fall on its counts at random, so a count of w
needs log w processes. Points come in order of time, and a process ends when its next point is
later than what all slots have already.

*Candidates.* Texts with the same words are one node. Nodes that agree in all slots of a band
share a bucket. In each bucket a centre is compared with all others: the member that shares most
buckets with others, which is the original of a family of copies. The links found give
components; buckets within one component are settled. In the others all members outside the
largest component meet all members of other components, in blocks. First the signatures of two
blocks are compared, and each such member is verified with the one of all its buckets whose
signature is nearest, which joins most of them to their family. Then, for those that are still
apart, all that agree in ``LIKELY`` of the slots come once more with their bags of shingles, and the
task that has both blocks verifies them and hands on no more links than join its components. So
each two nodes of a bucket end up in one component or have been compared, and no step has a row per
pair. Two similar texts miss each other with a chance of (1 - 0.8^ROWS)^BANDS = 0.00003 at most,
and fall below ``LIKELY`` with one of 10^-6.

*Verification* counts the shingles of both texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import fresh, ship, slices, trim
from stationlake.llm.suffixes import BASES, Hashes, mixed
from stationlake.session import discard, materialise, release, small_batches

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 26, 5
#: Share of the slots in which similar texts agree almost surely.
LIKELY = 0.62
#: Members of a block, and shingles of a block, at most about.
BLOCK, BLOCK_SHINGLES = 2_048, 1 << 21
#: What names two blocks of a bucket.
CELL = ("bucket", "row", "column")
#: Bytes of text that are hashed at a time, and texts that go to a worker at a time.
PIECE, BATCH = 1 << 18, 512
#: Multipliers for the words of a shingle.
STEPS = np.array([pow(0x9FB21C651E98DF25, i, 1 << 64) for i in range(WORDS)], np.uint64)


class Bags:
    """The shingles of some texts: rows (text, hash, count), in order of text and hash."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        begin = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        first = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
        last = np.flatnonzero(~blank & np.r_[blank[1:], True]) + 1
        text = np.searchsorted(begin, first, "right") - 1
        self.words = np.bincount(text, minlength=len(texts))
        one, two = (mixed(Hashes(data, b).of(first, last)) for b in BASES)
        start = np.cumsum(self.words) - self.words
        place = np.arange(len(text)) - start[text]
        # the order of all words decides which texts are copies
        self.content = np.zeros((len(texts), 2), np.uint64)
        for i, hashes in enumerate((one, two)):
            steps = mixed(place.astype(np.uint64) * STEPS[1] + STEPS[2]) | np.uint64(1)
            np.add.at(self.content[:, i], text, mixed(hashes * steps))
        self.content = mixed(self.content + self.words[:, None].astype(np.uint64))
        # runs of words; a shorter text has one run of all its words
        count = np.minimum(np.maximum(self.words - WORDS + 1, 1), self.words)
        starts = np.flatnonzero(place < count[text])
        total = np.zeros(len(starts), np.uint64)
        for i in range(WORDS):
            at = starts + i
            inside = place[starts] + i < self.words[text[starts]]
            total[inside] += one[at[inside]] * STEPS[i]
        length = np.minimum(self.words[text[starts]], WORDS).astype(np.uint64)
        hashes, of = mixed(total + length), text[starts]
        order = np.lexsort((hashes, of))
        hashes, of = hashes[order], of[order]
        other = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
        new = np.flatnonzero(np.r_[np.ones(min(len(of), 1), bool), other])
        self.text, self.hash = of[new], hashes[new]
        self.count = np.diff(np.r_[new, len(of)])


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)


def signatures(bags: Bags, texts: int, slots: int) -> np.ndarray:
    """The time of the first point in each slot, a row per text; infinite for an empty one."""
    # an interval for count 1, and one for each power of two above 1 that the count exceeds
    spans = np.ceil(np.log2(bags.count)).astype(np.int64) + 1
    owner = np.repeat(np.arange(len(bags.count)), spans)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(spans) - spans, spans)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    rate = np.where(level == 0, 1, 1 << np.maximum(level - 1, 0)).astype(np.float64)
    text, most = bags.text[owner], bags.count[owner]
    seed = mixed(bags.hash[owner] + level.astype(np.uint64) * STEPS[3])
    out = np.full((texts, slots), np.inf)
    flat = out.reshape(-1)
    time = np.zeros(len(owner))
    number = 0
    while len(text):
        # several points at a time once few processes are left
        many = int(min(max(100_000 // len(text), 1), 64))
        n = np.arange(number, number + many, dtype=np.uint64)
        draw = mixed(seed[:, None] + (n + np.uint64(1))[None, :] * STEPS[1])
        gaps = -np.log(_uniform(draw)) / rate[:, None]
        # summed one by one from the start: the bits do not depend on the steps, nor they on others
        times = np.cumsum(np.c_[time, gaps], axis=1)[:, 1:]
        more = mixed(draw ^ STEPS[4])
        slot = ((more >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        part = (more & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32
        seen = low[:, None] + (part * rate[:, None]).astype(np.int64) < most[:, None]
        np.minimum.at(flat, (text[:, None] * slots + slot)[seen], times[seen])
        time = times[:, -1]
        latest = out.max(axis=1)
        go = time < latest[text]
        text, most, seed, low, rate, time = (a[go] for a in (text, most, seed, low, rate, time))
        number += many
    return out


def similarities(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """The weighted Jaccard similarity of each pair of texts; 0 if one has no words."""
    n = len(left)
    bags = Bags([*left, *right])
    pair, side = bags.text % n, bags.text // n
    order = np.lexsort((side, bags.hash, pair))
    p, h, c = pair[order], bags.hash[order], bags.count[order]
    same = np.flatnonzero((p[1:] == p[:-1]) & (h[1:] == h[:-1]))
    shared = np.bincount(p[same], np.minimum(c[same], c[same + 1]), minlength=n)
    total = np.bincount(p, c, minlength=n)
    return shared / np.maximum(total - shared, 1)


def _groups(texts: list[bytes], *more: list, piece: int = PIECE) -> Iterator[tuple]:
    """Slices of lists, with about ``piece`` bytes of text each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= piece or i == len(texts) - 1:
            yield tuple(x[start : i + 1] for x in (texts, *more))
            start, size = i + 1, 0


def _bytes(texts: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace") for t in texts.to_pylist()]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Lower-case texts with a key that only equal rows share."""
    return docs.select(
        F.col(doc_id).cast("bigint").alias("id"),
        F.xxhash64(F.lit("bags"), F.col(text)).alias("h"),
        F.lower(F.col(text).cast("string")).alias("t"),
    )


def signed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, h, node, n, signature): texts with the same words have the same node.

    ``n`` is the number of shingles; a signature has 16 bits of each slot. A text without words
    has neither node nor signature.
    """
    ship()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            nodes, sizes, found = [], [], []
            for (texts,) in _groups(_bytes(batch.column("t"))):
                bags = Bags(texts)
                times = signatures(bags, len(texts), BANDS * ROWS).view(np.uint64)
                short = (mixed(times) >> np.uint64(48)).astype(np.uint16)
                has = (bags.words > 0).tolist()
                total = np.bincount(bags.text, bags.count, minlength=len(texts))
                sizes += total.astype(np.int64).tolist()
                nodes += [r.tobytes() if w else None for r, w in zip(bags.content, has)]
                found += [r.tobytes() if w else None for r, w in zip(short, has)]
            columns = [
                batch.column("id"),
                batch.column("h"),
                pa.array(nodes, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(found, pa.binary()),
            ]
            names = ["id", "h", "node", "n", "signature"]
            yield pa.RecordBatch.from_arrays(columns, names)
        trim()

    return _keyed(docs, doc_id, text).mapInArrow(
        work, "id bigint, h bigint, node binary, n bigint, signature binary"
    )


def _buckets(members: DataFrame) -> DataFrame:
    """Rows (bucket, node, n): a node's buckets, one per band."""
    width = 2 * ROWS
    bands = [
        F.xxhash64(F.lit(i), F.substring("signature", i * width + 1, width)) for i in range(BANDS)
    ]
    return members.select(F.explode(F.array(*bands)).alias("bucket"), "node", "n")


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""
    ship()
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            rows = list(range(batch.num_rows))
            keep = []
            sides = [_bytes(batch.column(c)) for c in ("ta", "tb")]
            for left, right, own in _groups(*sides, rows, piece=PIECE // 2):
                near = similarities(left, right) >= least
                keep += [r for r, yes in zip(own, near) if yes]
            found = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([found.column("a"), found.column("b")], ["a", "b"])
        trim()

    return both.select("a", "b", "ta", "tb").mapInArrow(work, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for all nodes of the links (a, b); a component is its least node.

    Large and small stars in turn: every node hands its greater neighbours to its least one,
    then its lesser ones, until the links are stars around the least nodes.
    """
    links = materialise(_ordered(links))
    spent, before = [], None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a")
        large = materialise(_ordered(large.select(F.col("b").alias("a"), F.col("m").alias("b"))))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m"))
        spent += [links, large]
        links = materialise(_ordered(small.select(F.col("b").alias("a"), F.col("m").alias("b"))))
        total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        state = links.agg(F.count(F.lit(1)), total).first()
        if state == before:
            break
        before = state
    discard(*spent)
    tops = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        tops.withColumn("component", F.col("node"))
    )


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, from the greater to the lesser node."""
    return links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _possible(a: str, b: str, similarity: float) -> Column:
    """Whether two numbers of shingles allow the similarity."""
    return F.least(a, b) >= F.lit(similarity) * F.greatest(a, b)


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """Rows (id, h, component) of all rows of ``docs``.

    ``id`` and ``h`` are the key of a row, equal for equal rows only; rows with the same
    component are one class of near duplicates. It is null for texts without words (null and
    empty ones too), which are never duplicates. Words are what ASCII white space separates, in
    lower case; texts of less than five words are one shingle of all their words.
    """
    with small_batches(docs.sparkSession, BATCH):
        return _classes(docs, doc_id, text, similarity)


def _classes(docs: DataFrame, doc_id: str, text: str, similarity: float) -> DataFrame:
    """As ``classes``; every step with a worker is written before it returns."""
    scratch = []

    def hold(df: DataFrame) -> DataFrame:
        scratch.append(materialise(df))
        return scratch[-1]

    rows = hold(signed(docs, doc_id, text))
    members = (
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min(F.struct("id", "h")).alias("first"),
            F.first("n").alias("n"),
            F.first("signature").alias("signature"),
        )
    )
    members = hold(members)
    shares = _buckets(members)
    # grouped by more than the bucket, so that a join partitions both sides itself and Spark can
    # split the members of a large bucket
    part = F.hash("bucket").alias("_part")
    sizes = shares.groupBy("bucket", part).count().where("count > 1").drop("_part")
    shares = hold(shares.join(sizes, "bucket"))
    weights = hold(shares.groupBy("node").agg(F.sum("count").alias("weight")))
    shares = shares.drop("count").join(weights, "node")
    centres = shares.groupBy("bucket", part).agg(
        F.max_by(F.struct("node", "n"), F.struct("weight", "node")).alias("c")
    )
    centres = centres.select("bucket", F.col("c.node").alias("b"), F.col("c.n").alias("m"))
    pairs = shares.join(centres, "bucket").where(
        (F.col("node") != F.col("b")) & _possible("n", "m", similarity)
    )
    tested = hold(_ordered(pairs.select(F.col("node").alias("a"), "b")))
    texts = hold(_texts(docs, doc_id, text, members.join(weights, "node", "left_semi")))
    release(docs.sparkSession)  # the shuffle of all texts
    links = hold(_verified(tested, texts, similarity))
    release(docs.sparkSession)
    parts = components(links)
    shares = shares.select("bucket", "node")
    for step in (_nearest, _apart):
        cells, met = _cells(shares, members, parts, similarity, hold)
        found = hold(step(cells, met, texts, similarity, hold))
        if not found.isEmpty():
            links = links.unionByName(found)
            scratch.append(parts)
            parts = components(links)
    own = F.coalesce("component", "node").alias("component")
    found = rows.drop("n", "signature").join(parts, "node", "left").select("id", "h", own)
    found = materialise(found)
    discard(*scratch, parts)
    return found


def _id(value: Column) -> list[Column]:
    """An id as two columns without nulls, which a join and a grouping after it can share."""
    return [F.coalesce(value, F.lit(0).cast("bigint")), value.isNull()]


def _texts(docs: DataFrame, doc_id: str, text: str, members: DataFrame) -> DataFrame:
    """Rows (node, t): the text of one row of each of the nodes."""
    key = ["i", "null", "h"]
    of = members.select(*_id(F.col("first.id")), "first.h", "node").toDF(*key, "node")
    found = _keyed(docs, doc_id, text).select(*_id(F.col("id")), "h", "t").toDF(*key, "t")
    found = found.join(of, key)
    # by the key too, so that texts are shuffled once
    return found.groupBy(*key, "node").agg(F.first("t").alias("t")).select("node", "t")


def _cells(
    shares: DataFrame, members: DataFrame, parts: DataFrame, similarity: float, hold: Callable
) -> tuple[Callable, Callable]:
    """Blocks of members that meet in buckets with several components.

    Members outside a bucket's largest component meet all that are of another component than they,
    a block of the ones with a block of the others. Returns a function that applies another to the
    two tables of each cell, and one that finds the likely partners in them.
    """
    ship()
    placed = shares.join(parts, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    placed = placed.join(members.select("node", "n", "signature"), "node")
    counts = placed.groupBy("bucket", "component").agg(
        F.count(F.lit(1)).alias("count"), F.sum("n").alias("shingles")
    )
    blocks = F.greatest(F.sum("count") / BLOCK, F.sum("shingles") / BLOCK_SHINGLES)
    several = counts.groupBy("bucket").agg(
        F.max_by("component", F.struct("count", "component")).alias("kept"),
        F.ceil(blocks).cast("int").alias("blocks"),
        F.count(F.lit(1)).alias("parts"),
    )
    full = placed.join(several.where("parts > 1").drop("parts"), "bucket")
    full = full.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    full = hold(full)
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    values = ["node", "component", "n", "signature"]
    strays = full.where("component <> kept").withColumn("column", every)
    strays = strays.select("bucket", F.col("block").alias("row"), "column", *values)
    others = full.withColumn("row", every)
    others = others.select("bucket", "row", F.col("block").alias("column"), *values)
    least = int(LIKELY * BANDS * ROWS)

    def apply(work: Callable, schema: str) -> DataFrame:
        met = strays.groupBy(*CELL).cogroup(others.groupBy(*CELL))
        return met.applyInArrow(work, schema)

    def likely(left: pa.Table, right: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each row of the one table, the likely rows of the other, and their equal slots."""
        sizes, slots = right["n"].to_numpy(), _slots(right)
        codes, (own, kind) = _codes(left["component"], right["component"])
        for code, n, signature in zip(own, left["n"].to_pylist(), _slots(left)):
            fits = np.minimum(sizes, n) >= similarity * np.maximum(sizes, n)
            near = np.flatnonzero(fits & (kind != code))
            agree = (slots[near] == signature).sum(axis=1)
            yield near[agree >= least], agree[agree >= least]

    return apply, likely


def _nearest(
    cells: Callable, likely: Callable, texts: DataFrame, similarity: float, hold: Callable
) -> DataFrame:
    """Links (a, b) of members outside a family and the one that is nearest to each."""

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        nodes, names, out = left["node"].to_pylist(), right["node"].to_pylist(), []
        if nodes and names:
            for node, (near, agree) in zip(nodes, likely(left, right)):
                if len(near):
                    out.append((node, names[near[agree.argmax()]], int(agree.max())))
        columns = zip(*out) if out else ((), (), ())
        _tidy(left, right)
        kinds = (pa.binary(), pa.binary(), pa.int32())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["a", "b", "agree"])

    found = cells(best, "a binary, b binary, agree int").groupBy("a").agg(
        F.max_by("b", F.struct("agree", "b")).alias("b")
    )
    return _verified(hold(_ordered(found)), texts, similarity)


def _apart(
    cells: Callable, likely: Callable, texts: DataFrame, similarity: float, hold: Callable
) -> DataFrame:
    """Links (a, b) that join all similar members of blocks, as few as do."""

    def needed(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        asks, held = np.zeros(len(left), bool), np.zeros(len(right), bool)
        if len(left) and len(right):
            for i, (near, _) in enumerate(likely(left, right)):
                asks[i] = len(near) > 0
                held[near] = True
        out = []
        for rows, chosen, is_left in ((left, asks, True), (right, held, False)):
            some = rows.select(["node", "component"]).filter(pa.array(chosen))
            for name, value in zip((*CELL, "asks"), (*key, pa.scalar(is_left))):
                some = some.append_column(name, pa.repeat(value, len(some)))
            out.append(some)
        _tidy(left, right)
        return pa.concat_tables(out)

    cell = "bucket bigint, row int, column int"
    rows = hold(cells(needed, f"node binary, component binary, {cell}, asks boolean"))
    bags = hold(_bags(texts.join(rows.select("node").distinct(), "node", "left_semi")))
    full = rows.join(bags, "node")
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def verify(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return schema.empty_table()
        out = []
        nodes, names = left["node"].to_pylist(), right["node"].to_pylist()
        codes, (own, kind) = _codes(left["component"], right["component"])
        root = np.arange(codes)
        bag = [np.frombuffer(b, np.uint64) for b in left["bag"].to_pylist()]
        held = [np.frombuffer(b, np.uint64) for b in right["bag"].to_pylist()]
        sizes = np.array([len(b) for b in held])
        postings = _Postings(held)
        for node, code, tokens in zip(nodes, own, bag):
            shared = postings.shared(tokens)
            near = shared >= similarity * (sizes + len(tokens) - shared)
            for i in np.flatnonzero(near & (root[kind] != root[code])):
                if root[kind[i]] != root[code]:
                    root[root == root[kind[i]]] = root[code]
                    out.append((max(node, names[i]), min(node, names[i])))
        a, b = zip(*out) if out else ((), ())
        del bag, held, postings
        _tidy(left, right)
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], schema=schema)

    asking = full.where("asks").drop("asks")
    held = full.where("NOT asks").select(*(F.col(c).alias(c) for c in asking.columns))
    met = asking.groupBy(*CELL).cogroup(held.groupBy(*CELL))
    return met.applyInArrow(verify, "a binary, b binary").distinct()


def _tidy(*tables: pa.Table) -> None:
    """Give back what large blocks took; there are too many small ones to do it after each."""
    if sum(t.nbytes for t in tables) >= PIECE:
        trim()


def _codes(*columns: pa.ChunkedArray) -> tuple[int, list[np.ndarray]]:
    """Numbers for the values of some columns, equal for equal values."""
    lists = [c.to_pylist() for c in columns]
    codes = {}
    out = [np.array([codes.setdefault(v, len(codes)) for v in values], np.int64) for values in lists]
    return len(codes), out


class _Postings:
    """Which of some bags have a token."""

    def __init__(self, bags: list[np.ndarray]):
        tokens = np.concatenate(bags)
        owners = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        order = np.argsort(tokens, kind="stable")
        self.bags, self.owners = len(bags), owners[order]
        self.tokens, self.first, self.count = np.unique(
            tokens[order], return_index=True, return_counts=True
        )

    def shared(self, tokens: np.ndarray) -> np.ndarray:
        """How many of the tokens each bag has."""
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        at = at[self.tokens[at] == tokens]
        count = self.count[at]
        ends = np.cumsum(count)
        places = np.arange(ends[-1] if len(ends) else 0)
        places += np.repeat(self.first[at] - (ends - count), count)
        return np.bincount(self.owners[places], minlength=self.bags)


def _bags(texts: DataFrame) -> DataFrame:
    """Rows (node, bag): a token of 8 bytes for each occurrence of a shingle, by hash and number."""
    ship()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            found = []
            for (some,) in _groups(_bytes(batch.column("t"))):
                bags = Bags(some)
                start = np.cumsum(bags.count) - bags.count
                number = np.arange(bags.count.sum()) - np.repeat(start, bags.count)
                tokens = np.repeat(bags.hash, bags.count) + number.astype(np.uint64) * STEPS[1]
                text = np.repeat(bags.text, bags.count)
                cuts = np.searchsorted(text, np.arange(1, len(some)))
                found += [t.tobytes() for t in np.split(mixed(tokens), cuts)]
            columns = [batch.column("node"), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "bag"])
        trim()

    return texts.select("node", "t").mapInArrow(work, "node binary, bag binary")


def _slots(rows: pa.Table) -> np.ndarray:
    data = b"".join(rows["signature"].to_pylist())
    return np.frombuffer(data, np.uint16).reshape(rows.num_rows, -1)


def with_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows (doc_id, class_id, class_size), one for each row of ``docs``.

    ``class_id`` is the smallest id of the class, ignoring nulls; a text without words is a
    class of its own, of its own id.
    """
    rows = classes(docs, doc_id, text, **options)
    names = rows.where("component IS NOT NULL").groupBy("component").agg(
        F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size")
    )
    return rows.join(names, "component", "left").select(
        F.col("id").alias(doc_id),
        F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
    )


def dedupe(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: that with the smallest id, nulls first.

    Of rows with equal ids and texts one stays. Texts without words all stay.
    """
    rows = classes(docs, doc_id, text, **options)
    first = rows.where("component IS NOT NULL").groupBy("component").agg(
        F.min(F.struct("id", "h")).alias("first")
    )
    key = [fresh() for _ in range(3)]
    first = first.select(*_id(F.col("first.id")), "first.h").toDF(*key)
    own = [*_id(F.col(doc_id).cast("bigint")), F.xxhash64(F.lit("bags"), F.col(text))]
    keyed = docs.withColumns(dict(zip(key, own)))
    words = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # one shuffle of the rows, by the key, for both steps
    kept = keyed.where(words).join(first, key, "left_semi").dropDuplicates([*key, doc_id])
    return kept.unionByName(keyed.where(~words)).drop(*key)
