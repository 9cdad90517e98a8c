"""Near-duplicates by SimHash: fingerprints of 64 bits that differ in a few bits are linked, found with vantage-point trees.

A fingerprint's bit is set if more than half of the text's shingles have it set in their XXH64. Equal fingerprints are
one node from there on, so groups of exact copies cost nothing.

Distances to random fingerprints crowd around 32, so a tree over all 64 bits would send two thirds of its queries down
both branches at every split. The bits are cut into three segments instead, with a tree for each: two fingerprints
within 4 bits are within 1 bit in the first segment, or within 1 in the second, or equal in the third (else they would
differ in 2 + 2 + 1 bits). In general the radii r of the segments satisfy sum(r + 1) = bits + 1.

1. Every tree is built from a bounded sample of fingerprints. A node holds a vantage point and a distance; its near
   branch has the fingerprints closer to the point than that, measured in the segment. Leaves are shards.
2. A fingerprint lives in one shard of each tree. As a query it also visits the shards that its ball reaches: by the
   triangle inequality a branch is left out if its distance from the point lies beyond the radius. Of two shards the
   one further on is visited, so a pair is met once per tree.
3. A shard's residents and visitors are dealt into blocks of bounded size. Every pair of blocks is searched by a local
   vantage-point tree down to small parts, where whole fingerprints are compared; links that join what is joined
   already are left out, so a group returns at most as many links as it has fingerprints.
4. Components of the links give the result.

Defined cases: a null text and a text without words have the fingerprint zero, linked like any other; rows with a null
id are linked with nothing and have a null component; rows that share an id are one node, each with its own fingerprint;
repeated rows stay rows; there are no ties to break but for the component's smallest id; very long texts are read in
pieces, with the same result; an empty table gives an empty result; extra columns are left out.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import stored, table
from .near_dedup import connected, words

SHINGLE, BITS = 4, 4
#: Fingerprints that the trees are built from, and shards of a tree: 2**DEPTH at most.
SAMPLE, DEPTH = 1 << 16, 12
#: Fingerprints that a shard is to hold, and that a block of it holds at most, about.
SHARD, GROUP = 8192, 16384
#: Characters of a text that are taken apart at once.
PIECE = 1 << 20
#: Comparisons below which parts are compared outright.
_OUTRIGHT = 1 << 16
_SET = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint of a text, from all its shingles, repeats included."""
    carried: list[bytes] = []
    total, seen = 0, np.zeros((8, 256), np.int64)
    for some in _pieces(text or ""):
        carried += words(some)
        if len(carried) >= size:
            shingles = map(b" ".join, zip(*(carried[i:] for i in range(size)), strict=False))
            hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(42)), np.uint64, len(carried) - size + 1)
            total += len(hashes)
            for k, column in enumerate(hashes.view(np.uint8).reshape(-1, 8).T):
                seen[k] += np.bincount(column, minlength=256)
            carried = carried[-(size - 1) :] if size > 1 else []
    if not total:
        if not carried:
            return 0
        return xxh64_intdigest(b" ".join(carried), 42)
    # Counts of set bits from counts of bytes: one table of 256 per byte of the hash, the lowest first.
    return int.from_bytes(np.packbits((seen @ _SET > total / 2).ravel(), bitorder="little").tobytes(), "little")


def _pieces(text: str) -> Iterator[str]:
    """Pieces of about PIECE characters that end where a word ends."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and text[end] not in " \t\n\v\f\r":
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, code) of every row; code is the fingerprint as a signed number."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.fromiter((fingerprint(t.as_py(), size) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(codes.view(np.int64))], names=["doc_id", "code"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(coded, "doc_id long, code long")


@dataclass(frozen=True)
class Segment:
    """Bits of a fingerprint, and how many of them two linked ones may differ in, if no other segment tells."""

    shift: int
    bits: int
    radius: int

    def of(self, codes: np.ndarray) -> np.ndarray:
        return (codes.view(np.uint64) >> np.uint64(self.shift)) & np.uint64((1 << self.bits) - 1)


def segments(bits: int) -> list[Segment]:
    """Segments whose radii, each one more, add up to bits + 1; those of radius 1 are half as long again."""
    if not 0 <= bits <= 15:
        raise ValueError("links must be at 0 to 15 differing bits")
    radii = [1] * ((bits + 1) // 2) + [0] * ((bits + 1) % 2)
    share = [3 if r else 2 for r in radii]
    ends = [round(64 * sum(share[: i + 1]) / sum(share)) for i in range(len(share))]
    return [Segment(begin, end - begin, r) for begin, end, r in zip([0, *ends], ends, radii, strict=False)]


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def _split(values: np.ndarray, radius: int, rng: np.random.Generator, tries: int) -> tuple[np.uint64, int] | None:
    """A vantage point among values and a distance that halve them about, with few values between; None if none saves work."""
    best, found = None, None
    for point in rng.choice(values, min(tries, len(values)), replace=False):
        counts = np.bincount(_distance(values, point))
        below = np.cumsum(counts)
        for at in range(1, len(counts)):
            near, far = below[at - 1], below[-1] - below[at - 1]
            if not near or not far:
                continue
            # What both branches get as queries, the larger branch counting most.
            reach = below[min(at - 1 + radius, len(below) - 1)], below[-1] - (below[at - radius - 1] if at > radius else 0)
            cost = near * reach[0] + far * reach[1]
            if best is None or cost < best:
                best, found = cost, (point, at)
    return found if found and best < 0.95 * len(values) ** 2 else None


class Tree:
    """A vantage-point tree over one segment; nodes are (point, distance, near, far), leaves are numbers of shards."""

    def __init__(self, sample: np.ndarray, segment: Segment, depth: int):
        self.segment, self.leaves = segment, 0
        self.root = self._grown(segment.of(sample), depth, np.random.default_rng(7))

    def _grown(self, values: np.ndarray, depth: int, rng: np.random.Generator):
        cut = _split(values, self.segment.radius, rng, 4) if depth and len(values) > 1 else None
        if cut is None:
            self.leaves += 1
            return self.leaves - 1
        near = _distance(values, cut[0]) < cut[1]
        return (*cut, self._grown(values[near], depth - 1, rng), self._grown(values[~near], depth - 1, rng))

    def routes(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in codes, shard, whether it lives there) of all shards that the codes live in or visit."""
        values, radius = self.segment.of(codes), self.segment.radius
        home = np.zeros(len(codes), np.int64)
        visits: list[tuple[np.ndarray, int]] = []
        stack = [(self.root, np.arange(len(codes)), np.ones(len(codes), bool))]
        while stack:
            node, who, lives = stack.pop()
            if not len(who):
                continue
            if not isinstance(node, tuple):
                home[who[lives]] = node
                visits.append((who, node))
                continue
            point, at, near, far = node
            d = _distance(values[who], point)
            inside, outside = d < at + radius, d >= at - radius
            stack.append((near, who[inside], (lives & (d < at))[inside]))
            stack.append((far, who[outside], (lives & (d >= at))[outside]))
        who = np.concatenate([w for w, _ in visits]) if visits else np.empty(0, np.int64)
        shard = np.repeat([n for _, n in visits], [len(w) for w, _ in visits]).astype(np.int64)
        later = shard >= home[who]
        return who[later], shard[later], (shard == home[who])[later]


class _Joined:
    """Sets of places that links join, with the links that joined them."""

    def __init__(self, n: int):
        self.root, self.links = np.arange(n), []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            # Every set hangs on the smallest of those that it meets, once a round; a round halves what is apart.
            high, low = np.maximum(x, y), np.minimum(x, y)
            order = np.lexsort((low, high))
            first = order[np.concatenate([[True], np.diff(high[order]) != 0])]
            self.links.append(np.stack([a[first], b[first]]))
            above = np.arange(len(self.root))
            above[high[first]] = low[first]
            while (above != above[above]).any():
                above = above[above]
            self.root = above[self.root]


def links_between(codes: np.ndarray, lives: np.ndarray, segment: Segment, bits: int) -> np.ndarray:
    """Links (2, n) of places: all pairs of one that lives here with one that asks and is within `bits` are joined by them."""
    joined, values, rng = _Joined(len(codes)), segment.of(codes), np.random.default_rng(11)
    codes = codes.view(np.uint64)
    stack = [(np.flatnonzero(lives), np.flatnonzero(~lives), 0)]
    while stack:
        here, asking, depth = stack.pop()
        if not len(here) or not len(asking):
            continue
        cut = _split(values[here], segment.radius, rng, 1) if len(here) * len(asking) > _OUTRIGHT and depth < 40 else None
        if cut is None:
            step = max(1, _OUTRIGHT // len(asking))
            for at in range(0, len(here), step):
                some = here[at : at + step]
                roots = joined.root[some]
                if (roots == roots[0]).all() and (joined.root[asking] == roots[0]).all():
                    continue
                x, y = np.nonzero(np.bitwise_count(codes[some][:, None] ^ codes[asking]) <= bits)
                joined.add(some[x], asking[y])
            continue
        d, q = _distance(values[here], cut[0]), _distance(values[asking], cut[0])
        stack.append((here[d < cut[1]], asking[q < cut[1] + segment.radius], depth + 1))
        stack.append((here[d >= cut[1]], asking[q >= cut[1] - segment.radius], depth + 1))
    return np.concatenate(joined.links, axis=1) if joined.links else np.empty((2, 0), np.int64)


def close(codes: DataFrame, bits: int = BITS, shard: int = SHARD, group: int = GROUP) -> DataFrame:
    """Links (a, b) of distinct codes (code, node) that join up all that are within `bits` of one another."""
    spark = codes.sparkSession
    count = codes.count()
    share = min(1.0, SAMPLE / max(1, count))
    drawn = codes.where(F.pmod(F.xxhash64("code"), F.lit(1 << 30)) < share * (1 << 30)).select("code").limit(2 * SAMPLE)
    sample = np.sort(np.array([r["code"] for r in drawn.collect()], np.int64))
    depth = min(DEPTH, max(0, (max(1, count // shard) - 1).bit_length()))
    trees = [Tree(sample, s, depth) for s in segments(bits)]

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("code").to_numpy()
            for k, tree in enumerate(trees):
                who, shard, lives = tree.routes(codes)
                columns = [pa.array(np.full(len(who), k)), pa.array(shard), pa.array(lives), batch.column("code").take(pa.array(who)), batch.column("node").take(pa.array(who))]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "shard", "lives", "code", "node"])

    rows = stored(codes.mapInArrow(routed, "tree long, shard long, lives boolean, code long, node long"), "op11-routes")
    # Blocks of a shard: a row per shard, 2**DEPTH of each tree at most.
    sizes = rows.groupBy("tree", "shard").agg(F.count_if("lives").alias("residents"), F.count("*").alias("asking"))
    sizes = F.broadcast(sizes.select("tree", "shard", F.ceil(F.col("residents") / group).alias("hosts"), F.ceil(F.col("asking") / group).alias("guests")).where("hosts > 0"))
    rows = rows.join(sizes, ["tree", "shard"])
    number = lambda many: F.pmod(F.xxhash64("code"), F.col(many))
    every = lambda many: F.explode(F.sequence(F.lit(0).cast("long"), F.col(many) - 1))
    hosts = rows.where("lives").select("tree", "shard", number("hosts").alias("host"), every("guests").alias("guest"), F.lit(True).alias("lives"), "code", "node")
    guests = rows.select("tree", "shard", every("hosts").alias("host"), number("guests").alias("guest"), F.lit(False).alias("lives"), "code", "node")
    parts = segments(bits)

    def search(group: pa.Table) -> pa.Table:
        codes, nodes, lives = (group.column(c).to_numpy() for c in ("code", "node", "lives"))
        a, b = links_between(np.ascontiguousarray(codes), lives, parts[group.column("tree")[0].as_py()], bits)
        apart = nodes[a] != nodes[b]
        return pa.table({"a": nodes[a][apart], "b": nodes[b][apart]})

    return hosts.unionByName(guests).groupBy("tree", "shard", "host", "guest").applyInArrow(search, "a long, b long")


def components(docs: DataFrame, bits: int = BITS, size: int = SHINGLE) -> DataFrame:
    """(doc_id, code, component_id) of every row: the smallest id that links reach, its own included."""
    coded = stored(fingerprints(docs, size), "op11-fingerprints")
    usable = coded.where("doc_id is not null")
    classes = stored(usable.groupBy("code").agg(F.min("doc_id").alias("node")), "op11-classes")
    found = close(classes, bits)
    # An id with several fingerprints links their classes.
    several = usable.groupBy("doc_id").agg(F.min("code").alias("low"), F.max("code").alias("high")).where("low <> high").select("doc_id")
    bridges = usable.join(several, "doc_id", "left_semi").join(classes, "code").select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a <> b")
    roots = connected(found.unionByName(bridges), "op11-links")
    named = classes.join(roots, "node", "left").select("code", F.coalesce("root", "node").alias("component_id"))
    out = coded.join(named.hint("merge"), "code", "left")
    return out.select("doc_id", "code", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def op11_sim_hash(spark, sf_dir: str) -> DataFrame:
    found = components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op11_sim_hash": op11_sim_hash}
SQL: dict[str, str] = {}
