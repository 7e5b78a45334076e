"""Near-dedup by BagMinHash, banding and exact multiset overlap.

Documents are multisets of five-word shingles; similar means weighted Jaccard
(sum of minima over sum of maxima of counts) of at least 0.8.

Signature. A shingle's count is cut into dyadic levels (0,1], (1,2], (2,4],
(4,8], ... Each (shingle, level) is a Poisson process whose rate is the
level's length; an event has a time, a register and, inside its level, a
height, and counts only if the height is within the shingle's count. A
register holds its earliest event. Two documents share that event with
probability exactly their weighted Jaccard similarity. All processes of a
document are generated together up to a time by which every register is very
likely hit; if one is not, the time is doubled.

Search. Documents with equal words collapse to one representative. Bands of
registers form buckets; each member is linked to its bucket's smallest id (a
star, so links are linear in members however large a bucket is) and connected
components of these links are candidate blocks. Within a block the exact
counts decide (``solve_block``), in one task, and nothing but the resulting
classes leaves it. Components beyond ``Params.component_rows`` or
``component_chars`` are taken apart again: their buckets become the blocks, which still hold each
candidate pair together at least once. A bucket that is too large itself is
settled exactly by leader rounds over the whole cluster (``_leader_rounds``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.llm.common import batches_of, join_hot, rows_of, small_batches, with_long_ids
from caseloom.session import settle, table


@dataclass(frozen=True)
class Params:
    """Similar documents share a band with probability 1 - (1 - 0.8^rows)^bands, 0.9998."""

    words: int = 5
    bands: int = 36
    rows: int = 7
    #: Similarity as a fraction, so that it is tested in whole numbers.
    share: tuple[int, int] = (8, 10)
    #: A component up to this size is solved whole; larger ones by bucket.
    component_rows: int = 500
    component_chars: int = 4_000_000
    #: A bucket up to this size is solved in one task; larger ones by leader rounds.
    block_rows: int = 1_000
    block_chars: int = 16_000_000
    #: Leaders of one block compared in one round.
    leaders: int = 64
    #: Rows of (id, block) that may be broadcast, at most about 40 MB.
    broadcast_rows: int = 1_000_000


_C = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _C[1]
    x = (x ^ (x >> np.uint64(27))) * _C[2]
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Words of a text to shingle hashes; word hashes are cached."""

    def __init__(self, width: int, cached: int = 150_000):
        self.width, self.cached, self.seen = width, cached, {}

    def words(self, text: str | None) -> np.ndarray:
        if len(self.seen) > self.cached:
            self.seen = {}
        words, seen = (text or "").lower().split(), self.seen
        for w in set(words).difference(seen):
            seen[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))

    def bag(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles and their counts. Under ``width`` words: one shingle of them all."""
        n = len(words) - self.width + 1
        if not len(words):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            if n < 1:
                shingles = mix(np.array([xxhash.xxh64_intdigest(words.tobytes())], np.uint64))
            else:
                total = np.zeros(n, np.uint64)
                for i in range(self.width):
                    total = (total ^ words[i : i + n]) * _C[i % len(_C)] + np.uint64(i + 1)
                    total ^= total >> np.uint64(29)
                shingles = mix(total)
        return np.unique(shingles, return_counts=True)


def signature(shingles: np.ndarray, counts: np.ndarray, m: int) -> np.ndarray:
    """BagMinHash registers (event times as float64) of a multiset that is not empty."""
    levels = [(0, shingles, counts)]
    top, j = int(counts.max()), 1
    while 1 << (j - 1) < top:
        has = counts > 1 << (j - 1)
        levels.append((j, shingles[has], counts[has]))
        j += 1
    until = m * (np.log(m) + 4) / int(counts.sum())
    while True:
        registers = np.full(m, np.inf)
        for level, items, n in levels:
            _events(registers, level, items, n, until)
        if np.isfinite(registers).all():
            return registers
        until *= 2


def _events(registers: np.ndarray, level: int, items: np.ndarray, counts: np.ndarray, until: float) -> None:
    """Run the processes of one level up to ``until`` and note the earliest events."""
    length = 1 << max(0, level - 1)
    mean = length * until
    many = int(mean + 6 * np.sqrt(mean) + 8)
    step = max(1, 4_000_000 // many)
    for lo in range(0, len(items), step):
        some, n, width = items[lo : lo + step], counts[lo : lo + step], many
        while True:
            with np.errstate(over="ignore"):
                seed = mix(some * _C[3] + np.uint64(level))
                draw = mix(seed[:, None] + np.arange(1, width + 1, dtype=np.uint64) * _C[0])
                gaps = -np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53)
                times = np.cumsum(gaps, axis=1) / length
                if (times[:, -1] > until).all():
                    break
            width *= 2
        row, at = np.nonzero(times <= until)
        with np.errstate(over="ignore"):
            more = mix(draw[row, at] ^ _C[4])
        when = times[row, at]
        if level > 1:  # inside a level of several units an event has a height
            height = length + 1 + ((more >> np.uint64(40)) * np.uint64(length) >> np.uint64(24)).astype(np.int64)
            ok = height <= n[row]
            more, when = more[ok], when[ok]
        np.minimum.at(registers, ((more & np.uint64(0xFFFFFFFF)) * np.uint64(len(registers)) >> np.uint64(32)).astype(np.int64), when)


def band_keys(registers: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key a band."""
    bits = registers.view(np.uint64).reshape(bands, -1)
    with np.errstate(over="ignore"):
        key = np.arange(1, bands + 1, dtype=np.uint64) * _C[0]
        for i in range(bits.shape[1]):
            key = mix(key * _C[2] + bits[:, i])
    return key.view(np.int64)


def signatures(rows: DataFrame, p: Params) -> DataFrame:
    """(id, body) -> (id, words, chars, bands): digest of the words, length, band keys (none for no words)."""
    small_batches(rows.sparkSession)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        shingler = Shingler(p.words)
        for key, text in rows_of(batches):
            words = shingler.words(text)
            bands = band_keys(signature(*shingler.bag(words), p.bands * p.rows), p.bands).tolist() if len(words) else []
            yield key, xxhash.xxh3_128_digest(words.tobytes()), len(text), bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
        yield from batches_of(signed(batches), ["id", "words", "chars", "bands"], types, 3, most=2000)

    return rows.mapInArrow(run, "id long, words binary, chars long, bands array<long>")


def components(edges: DataFrame, label: str) -> DataFrame:
    """(u, v) links to (id, root): alternating large-star and small-star rounds.

    Every link is between two different ids. The root is a component's
    smallest id; roots have no row. Each round is written to the shared
    folder, and a few rounds (about the logarithm of the size) are needed.
    The links of a hub are not dealt by it (``join_hot``), so they meet in no
    one task.
    """

    def down(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()

    def lowest(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))

    def large(e: DataFrame, n: int) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = lowest(both).select("u", F.least("u", "m").alias("m"), "n")
        return join_hot(both, low, "u", 2 * n, f"{label}-low").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small(e: DataFrame, n: int) -> DataFrame:
        near = join_hot(e, lowest(e), "u", n, f"{label}-low")
        return near.select("u", F.col("m").alias("v")).unionByName(near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))

    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())
    e = settle(down(edges), label)
    old = state(e)
    while old[0]:
        wide = settle(down(large(e, old[0])), label)
        e = settle(down(small(wide, wide.count())), label)
        now = state(e)
        if now == old:
            break
        old = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _similar(inter: np.ndarray, sizes: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """inter / (sizes - inter) >= share, in whole numbers."""
    a, b = share
    return inter * (a + b) >= sizes * a


class Postings:
    """Inverted index of multisets: overlap of one with all."""

    def __init__(self, bags: list[tuple[np.ndarray, np.ndarray]]):
        keys = np.concatenate([h for h, _ in bags])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.doc = np.repeat(np.arange(len(bags)), [len(h) for h, _ in bags])[order]
        self.count = np.concatenate([c for _, c in bags])[order]
        self.total = np.array([c.sum() for _, c in bags], np.int64)

    def overlap(self, bag: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(sum of minima, sum of sizes) of ``bag`` and each multiset."""
        h, c = bag
        lo = np.searchsorted(self.keys, h, "left")
        many = np.searchsorted(self.keys, h, "right") - lo
        which = np.repeat(np.arange(len(h)), many)
        at = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + lo[which]
        inter = np.bincount(self.doc[at], np.minimum(self.count[at], c[which]), len(self.total))
        return inter.astype(np.int64), self.total + int(c.sum())


def _prefixes(bags: list[tuple[np.ndarray, np.ndarray]], share: tuple[int, int]) -> list[np.ndarray]:
    """Of each multiset the rarest shingles, of which similar ones share at least one.

    Similar multisets overlap in at least ``share`` of the larger, so what
    follows the prefix, in order of frequency in the block, is not enough.
    """
    keys, inverse = np.unique(np.concatenate([h for h, _ in bags]), return_inverse=True)
    frequency = np.bincount(inverse, minlength=len(keys))
    order = np.empty(len(keys), np.int64)
    order[np.lexsort((keys, frequency))] = np.arange(len(keys))
    out, at = [], 0
    for h, c in bags:
        rank = order[inverse[at : at + len(h)]]
        at += len(h)
        by = np.argsort(rank)
        size = int(c.sum())
        rest = size - np.cumsum(c[by])  # after the first, the second, ...
        need = -(-size * share[0] // share[1])
        out.append(rank[by[: int(np.count_nonzero(rest >= need)) + 1]])
    return out


def solve_block(bags: list[tuple[np.ndarray, np.ndarray]], share: tuple[int, int]) -> list[int]:
    """Class of each multiset: links of similarity ``share`` or more, closed transitively.

    Candidates come from shared prefix shingles; those already in one class
    need no comparison. Few candidates are compared one by one, many at once
    through the inverted index. Every link between classes is found.
    """
    n = len(bags)
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    prefixes = _prefixes(bags, share)
    rank = np.concatenate(prefixes)
    owner = np.repeat(np.arange(n), [len(x) for x in prefixes])
    order = np.argsort(rank, kind="stable")
    rank, owner = rank[order], owner[order]
    label = np.arange(n)
    index = None
    for i, prefix in enumerate(prefixes):
        lo, hi = np.searchsorted(rank, prefix, "left"), np.searchsorted(rank, prefix, "right")
        seen = np.zeros(n, bool)
        for x, y in zip(lo.tolist(), hi.tolist()):
            seen[owner[x:y]] = True
        seen[: i + 1] = False
        seen &= label != label[i]
        near = np.flatnonzero(seen)
        if len(near) > 40:
            index = index or Postings(bags)
            near = np.flatnonzero(seen & _similar(*index.overlap(bags[i]), share))
        else:
            near = [k for k in near.tolist() if _similar(*_overlap(bags[i], bags[k]), share)]
        for k in near:
            a, b = find(i), find(int(k))
            if a != b:
                root[max(a, b)] = min(a, b)
                label[label == label[max(a, b)]] = label[min(a, b)]
    return [find(i) for i in range(n)]


def _overlap(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """(sum of minima, sum of sizes) of two multisets with sorted keys."""
    at = np.minimum(np.searchsorted(y[0], x[0]), len(y[0]) - 1)
    hit = y[0][at] == x[0]
    return int(np.minimum(x[1][hit], y[1][at[hit]]).sum()), int(x[1].sum() + y[1].sum())


def _solve_small(rows: DataFrame, p: Params) -> DataFrame:
    """(block, id, body) of blocks that fit one task -> (id, root)."""
    dealt = rows.repartition("block").sortWithinPartitions("block", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, block, ids, bags = Shingler(p.words), None, [], []

        def solved() -> pa.RecordBatch:
            roots = [ids[k] for k in solve_block(bags, p.share)]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(roots, pa.int64())], names=["id", "root"])

        for key, i, text in rows_of(batches):
            if key != block:
                if ids:
                    yield solved()
                block, ids, bags = key, [], []
            ids.append(i)
            bags.append(shingler.bag(shingler.words(text)))
        if ids:
            yield solved()

    return dealt.mapInArrow(run, "id long, root long")


def _few(todo: DataFrame, k: int) -> DataFrame:
    """k members of each block, ranked in spread parts first, so no block meets in one task."""
    part = F.pmod(F.xxhash64("id"), F.lit(64))
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64("id", F.lit(3)), "id", "text"))
    some = todo.withColumn("part", part).withColumn("nth", rank("block", "part")).filter(F.col("nth") <= k)
    return some.withColumn("nth", rank("block")).filter(F.col("nth") <= k).select("block", "id", "text")


def _compare(rows: DataFrame, lead: DataFrame, p: Params) -> DataFrame:
    """(block, id, text, lead, d) of members within twice the distance limit of their block's leaders.

    Leaders that are similar (closed transitively) stand as one: a member has
    one row for each such group near it, with the group's first leader and the
    distance to the nearest.
    """
    led = rows.join(lead.select("block").distinct(), "block", "left_semi")
    parts = led.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / p.block_rows).alias("parts"))
    members = rows.join(parts, "block").select("block", F.pmod(F.xxhash64("id", F.lit(5)), F.col("parts")).alias("part"), F.lit(1).alias("what"), "id", "text", "body")
    leaders = lead.join(parts, "block").select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("what"), "id", "text", "body")
    dealt = members.unionByName(leaders).repartition("block", "part").sortWithinPartitions("block", "part", "what", "id", "text")
    far = 2 * (1 - p.share[0] / p.share[1])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        shingler, key, names, bags, index, group = Shingler(p.words), None, [], [], None, []
        for block, part, what, i, digest, text in rows_of(batches):
            if key != (block, part):
                key, names, bags, index = (block, part), [], [], None
            bag = shingler.bag(shingler.words(text))
            if what == 0:
                names.append(i)
                bags.append(bag)
                continue
            if index is None:
                index, group = Postings(bags), solve_block(bags, p.share)
            inter, sizes = index.overlap(bag)
            away = 1 - inter / np.maximum(1, sizes - inter)
            nearest: dict[int, float] = {}
            for k in np.flatnonzero(away <= far + 1e-9).tolist():
                nearest[group[k]] = min(float(away[k]), nearest.get(group[k], np.inf))
            for g, d in nearest.items():
                yield block, i, digest, names[g], d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(near(batches), ["block", "id", "text", "lead", "d"], [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()])

    return dealt.mapInArrow(run, "block long, id long, text long, lead long, d double")


def _leader_rounds(rows: DataFrame, p: Params) -> DataFrame:
    """(block, id, body) of blocks too large for one task -> links (u, v).

    In a round up to ``leaders`` members of each block are compared exactly
    with all members of that block, which lie spread over the cluster. A
    leader is done in this block then, not in others: all its links here are
    known. 1 - similarity is a metric, so a link between x and y needs
    d(x, l) <= d(y, l) + (1 - share) for each leader l. A member must lead
    later in a block only if it is linked to no leader of the block, or if it
    is within 2 (1 - share) of one of another class, where a link across could
    hide; in a block of one class nobody must. When nobody must in any block,
    no link that joins classes is missing. A member is one text, of which an
    id may have several; classes are those of ids over all blocks.

    What is kept from round to round: one (id, root) row for an id with
    links, one mark for a member that led or is linked, and the distances
    that still lie between two classes; those within a class are dropped.
    """
    far = 1 - p.share[0] / p.share[1] + 1e-9
    rows = settle(rows.withColumn("text", F.xxhash64("body")), "near-large")
    here = ["block", "id", "text"]
    roots, led, linked, apart, todo = None, None, None, None, rows.select(here).distinct()
    more = lambda old, new: new if old is None else old.unionByName(new)
    while not (lead := settle(_few(todo, p.leaders).join(rows, here), "near-lead")).isEmpty():
        found = settle(_compare(rows, lead, p), "near-links")
        led = more(led, lead.select(here))
        close = found.filter(F.col("d") <= far).filter("id <> lead")
        linked = settle(more(linked, close.select(here)).distinct(), "near-linked")
        edges = close.select(F.col("id").alias("u"), F.col("lead").alias("v"))
        roots = components(more(None if roots is None else roots.select(F.col("id").alias("u"), F.col("root").alias("v")), edges), "near-roots")
        named = rows.select("id").distinct().join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("class"))
        mixed = rows.select("block", "id").join(named, "id").groupBy("block").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high").select("block")
        far_apart = more(apart, found.select(*here, "lead")).distinct()
        apart = settle(far_apart.join(named, "id").join(named.select(F.col("id").alias("lead"), F.col("class").alias("other")), "lead").filter("class <> other").select(*here, "lead"), "near-apart")
        rest = rows.select(here).distinct().join(mixed, "block", "left_semi").join(led, here, "left_anti")
        todo = rest.join(linked, here, "left_anti").unionByName(rest.join(apart.select(here).distinct(), here, "left_semi")).distinct()
    return roots.select(F.col("id").alias("u"), F.col("root").alias("v"))


def _too_large(blocks: DataFrame, firsts: DataFrame, rows: int, chars: int) -> tuple[DataFrame, bool]:
    """The blocks that one task should not hold, and whether there are any."""
    sizes = blocks.join(firsts.select("id", "chars"), "id").groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    large = settle(sizes.filter((F.col("n") > rows) | (F.col("chars") > chars)).select("block"), "near-too-large")
    return large, not large.isEmpty()


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """Class of every row: (id, class_id, kept); the class id is its smallest document id.

    Texts with equal words (lower-cased, split at white space) are alike; so
    are all texts without words, null ones included. Texts of fewer words than
    a shingle are one shingle. Ids may be of any type that has an order; a
    null id is the smallest. Rows that repeat an id are one document: each
    gets a row, all its texts' links count, and all or none are kept. Very
    long texts are read whole, one at a time. Only the two columns are read,
    so extra columns cannot clash; empty tables give no rows.
    """
    rows, names = with_long_ids(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body")), "near-ids")
    sigs = settle(signatures(rows, p), "near-sigs")
    # Written out, so that both sides of the joins below are dealt anew.
    reps = settle(sigs.groupBy("words").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")), "near-reps")
    n_rows = sigs.count()
    members = join_hot(sigs.select("id", "words"), reps, "words", n_rows).select("id", "rep")
    firsts = join_hot(sigs, reps, "words", n_rows).filter("id = rep").select("id", "chars", "bands")

    buckets = settle(firsts.select("id", F.explode("bands").alias("key")), "near-buckets")
    low = settle(buckets.groupBy("key").agg(F.min("id").alias("v"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).filter("v < last").select("key", "v", "n"), "near-low")
    edges = join_hot(buckets, low, "key", buckets.count()).filter("id <> v").select(F.col("id").alias("u"), "v").distinct()
    stars = components(edges, "near-stars")
    blocks = settle(stars.select("id", F.col("root").alias("block")).unionByName(stars.select(F.col("root").alias("id"), F.col("root").alias("block")).distinct()), "near-blocks")
    n_blocked = blocks.count()
    send = lambda small: F.broadcast(small) if n_blocked <= p.broadcast_rows else small
    texts = lambda chosen: rows.join(send(chosen), "id").select("block", "id", "body")

    large, any_large = _too_large(blocks, firsts, p.component_rows, p.component_chars)
    solved = _solve_small(texts(blocks.join(large, "block", "left_anti") if any_large else blocks), p)
    if any_large:
        ids = blocks.join(large, "block", "left_semi").select("id")
        inner = join_hot(buckets, low.select("key", "n"), "key", buckets.count()).join(ids, "id", "left_semi")
        mark = inner.groupBy("key").agg(F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("x"), F.sum(F.xxhash64("id", F.lit(1)).cast("decimal(20,0)")).alias("y"), F.count(F.lit(1)).alias("n"))
        once = mark.groupBy("x", "y", "n").agg(F.min("key").alias("key")).select("key")  # buckets with the same members
        parts = settle(inner.join(once, "key", "left_semi").select("id", F.col("key").alias("block")), "near-parts")
        n_parts = parts.count()
        texts_of = lambda chosen: rows.join(F.broadcast(chosen) if n_parts <= p.broadcast_rows else chosen, "id").select("block", "id", "body")
        huge, any_huge = _too_large(parts, firsts, p.block_rows, p.block_chars)
        links = _solve_small(texts_of(parts.join(huge, "block", "left_anti") if any_huge else parts), p).select(F.col("id").alias("u"), F.col("root").alias("v"))
        if any_huge:
            links = links.unionByName(_leader_rounds(texts_of(parts.join(huge, "block", "left_semi")), p))
        solved = solved.unionByName(components(links, "near-roots"))
    pairs = solved.filter("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v"))
    several = members.groupBy("id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high").select("id")
    pairs = pairs.unionByName(members.join(several, "id").filter("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v")))
    solved = components(pairs, "near-classes")
    out = members.join(solved.withColumnRenamed("id", "rep"), "rep", "left").select("id", F.coalesce("root", "rep").alias("class_id"))
    if names is None:
        kind = docs.schema[id_col].dataType
        return out.select(F.col("id").cast(kind).alias(id_col), F.col("class_id").cast(kind).alias("class_id"), (F.col("id") == F.col("class_id")).alias("kept"))
    value = lambda number, name: names.select(F.col("number").alias(number), F.col("value").alias(name))
    out = out.withColumn("kept", F.col("id") == F.col("class_id")).withColumnRenamed("class_id", "class")
    return out.join(value("id", "own"), "id").join(value("class", "class_id"), "class").select(F.col("own").alias(id_col), "class_id", "kept")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """``docs`` with one document of each class (the smallest id), columns as they were.

    Texts, ids and odd rows count as in ``near_classes``: of all texts without
    words (null ones included) one document stays, rows that repeat a kept id
    all stay, a null id is the smallest, extra columns pass through, and an
    empty table stays empty.
    """
    lost = settle(near_classes(docs, id_col, text_col, p).filter(~F.col("kept")).select(F.col(id_col).alias("__lost_id")).distinct(), "near-lost")
    n = lost.count()
    return docs.join(F.broadcast(lost) if n <= p.broadcast_rows else lost, docs[id_col].eqNullSafe(F.col("__lost_id")), "left_anti") if n else docs


def op2_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


QUERIES = {"op2_bagminhash": op2_bagminhash}
ORACLE_SQL: dict[str, str] = {}
