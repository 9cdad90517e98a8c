"""Near-duplicate detection with min-max hashing, confirmed on full shingle sets.

A text's set is its distinct word shingles. Every permutation of the shingle hashes keeps both its minimum and its
maximum, so half as many permutations are evaluated for a signature of the same length; the values are banded.

1. Texts with equal sets form a class, known by the SHA-256 of the full set in order; the smallest id stands for it
   from there on.
2. Bands are joined to their bucket's smallest member (a star, never all pairs), a text's stars are joined at the
   smallest of these, and the connected components are clusters: two texts that share a band are in one cluster. The
   banding follows the threshold and misses a pair at it with a probability below 1e-4 (1e-8 at 0.85).
3. Inside a cluster all links between different components are found exactly on the full sets, by an inverted list of
   shingles. A cluster over CLUSTER_CHARS is never whole in a task: its stars are confirmed first, one pair a row, and
   the largest component of these is not compared with itself again. Only the other texts, in chunks, meet one another
   and the chunks of that component, so a group of near copies costs in proportion to its size.
4. Components of the confirmed links give the result; copies follow the text that stands for them.

Defined cases: texts without words and rows with a null id are linked with nothing (a null id has a null component and
is kept); rows that share an id are one node, each with its own n_shingles; an empty table gives an empty result; extra
columns are left out by `components` and kept by `reject`; a very long text is one set in one task, and of texts that
tie the smallest id stands for the others.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xxhash import xxh3_64_intdigest

from .common import LOWER, UPPER, stored, table

SHINGLE, THRESHOLD = 5, 80
#: Values of a signature: the minimum and maximum of half as many permutations.
VALUES = 480
#: Characters of a cluster that one task compares at once.
CLUSTER_CHARS = 6 << 20
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def banding(threshold: int) -> tuple[int, int]:
    """Bands and values in each: the longest bands, of 8 at most, that miss a pair at the threshold below 1e-4."""
    fitting = (r for r in (8, 6, 5, 4, 3, 2) if (1 - (threshold / 100) ** r) ** (VALUES // r) < 1e-4)
    rows = next(fitting, 1)
    return VALUES // rows, rows


def words(text: str) -> list[bytes]:
    """Lower-cased words; bytes split at exactly the blanks 09-0D and 20."""
    return text.encode().translate(_LOWERED).split()


def shingles(text: str | None, size: int = SHINGLE) -> set[bytes]:
    """Distinct shingles; words hold no blanks, so joining them by one is reversible."""
    w = words(text or "")
    if not w:
        return set()
    if len(w) < size:
        return {b" ".join(w)}
    return set(map(b" ".join, zip(*(w[i:] for i in range(size)), strict=False)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class MinMax:
    """Min-max signatures of sets of 64-bit hashes."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(2024)
        n = bands * rows // 2
        self.bands, self.rows = bands, rows
        self.mult = rng.integers(1, 1 << 32, n, dtype=np.uint32) | np.uint32(1)
        self.flip = rng.integers(0, 1 << 32, n, dtype=np.uint32)

    def band_keys(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One key per set and band. hashes: the sets one after another, none empty; starts: where each begins."""
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        values = np.empty((2 * len(self.mult), len(starts)), np.uint64)
        held = np.empty_like(low)
        for k, (m, f) in enumerate(zip(self.mult, self.flip, strict=True)):
            np.bitwise_xor(low, f, out=held)
            np.multiply(held, m, out=held)
            np.bitwise_xor(held, held >> np.uint32(15), out=held)
            values[2 * k] = np.minimum.reduceat(held, starts)
            values[2 * k + 1] = np.maximum.reduceat(held, starts)
        keys = np.zeros((self.bands, len(starts)), np.uint64) + np.arange(1, self.bands + 1, dtype=np.uint64)[:, None] * _GOLDEN
        # A permutation's minimum and maximum go to different bands.
        order = np.concatenate([np.arange(0, len(values), 2), np.arange(1, len(values), 2)])
        for r in range(self.rows):
            keys = _mixed(keys ^ values[order[r :: self.rows]]) + _GOLDEN
        return keys.T.astype(np.int64)


def _unique_sets(texts: list[str | None], size: int) -> tuple[list[np.ndarray], list[int], list[bytes]]:
    """Per text: 64-bit hashes of its distinct shingles, the set's size, and a digest of the set itself."""
    hashes, sizes, digests = [], [], []
    for text in texts:
        s = shingles(text, size)
        sizes.append(len(s))
        hashes.append(np.fromiter(map(xxh3_64_intdigest, s), np.uint64, len(s)))
        # Words hold no line ends, so the joined set can be taken apart again.
        digests.append(hashlib.sha256(b"\n".join(sorted(s))).digest())
    return hashes, sizes, digests


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minmax = MinMax(bands, rows)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                hashes, sizes, digests = _unique_sets(part.column("text").to_pylist(), size)
                full = [i for i, n in enumerate(sizes) if n]
                keys: list = [None] * len(sizes)
                if full:
                    lengths = np.array([sizes[i] for i in full])
                    for i, k in zip(full, minmax.band_keys(np.concatenate([hashes[i] for i in full]), np.cumsum(lengths) - lengths), strict=True):
                        keys[i] = k
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array([d if n else None for d, n in zip(digests, sizes, strict=True)], pa.binary()), pa.array(keys, schema.field("bands").type)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def connected(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): the smallest node that can be reached, for every node of edges (a, b).

    Every round each node takes the smallest root among its neighbours' and then that root's own root, so paths halve;
    rounds are written to the shared folder.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), f"{name}-edges")
    roots = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node"), f"{name}-roots")
    while True:
        near = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        step = stored(step.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("beyond", "root")).alias("root")), f"{name}-roots")
        roots = step.select("node", "root")
        if step.where("old <> root").isEmpty():
            return roots


def _links(ids: np.ndarray, texts: list[str], part: np.ndarray, side: np.ndarray, threshold: int, size: int) -> list[tuple[int, int]]:
    """Links that join up the texts' parts as all links would; part: texts of one are known to be joined.

    side: with two sides (0, 1) only pairs across them count, 2 is both.
    """
    code: dict[bytes, int] = {}
    sets = []
    for t in texts:
        sets.append(np.array([code.setdefault(x, len(code)) for x in shingles(t, size)], np.int64))
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    posting, begin = owner[order], np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=len(code)))])
    root = np.unique(part, return_inverse=True)[1]
    out = []
    # Central texts first: they link most, and pairs inside a component need no look again.
    weight = np.array([np.diff(begin)[s].mean() for s in sets])
    order = np.argsort(-weight, kind="stable")
    across = (side != 2).any()
    if across:  # every pair is met from the side of fewer texts
        order = order[side[order] == (0 if 2 * np.count_nonzero(side == 0) <= len(side) else 1)]
    for x in order:
        open_ = root != root[x]
        if not open_.any():
            continue
        s = sets[x]
        lengths = begin[s + 1] - begin[s]
        at = np.repeat(begin[s] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        inter = np.bincount(posting[at], minlength=len(sets))
        linked = open_ & (100 * inter >= threshold * (sizes + sizes[x] - inter))
        if across:
            linked &= side != side[x]
        for y in np.flatnonzero(linked):
            if root[y] != root[x]:
                out.append((int(ids[x]), int(ids[y])))
                root[root == root[y]] = root[x]
    return out


def confirmed(pairs: DataFrame, threshold: int, size: int) -> DataFrame:
    """(a, b) of the pairs (a, b, one, other) whose texts are linked."""

    def linked(one: str, other: str) -> bool:
        s, t = shingles(one, size), shingles(other, size)
        both = len(s & t)
        return bool(s) and 100 * both >= threshold * (len(s) + len(t) - both)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                kept = [linked(*texts) for texts in zip(some.column("one").to_pylist(), some.column("other").to_pylist(), strict=True)]
                yield some.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return pairs.select("a", "b", "one", "other").mapInArrow(check, "a long, b long")


def _dealt(texts: DataFrame, known: DataFrame, most: int) -> DataFrame:
    """Rows of large clusters (cluster, doc_id, text), once per group that compares them.

    Of the parts that the known links join up, the largest is not compared with itself: its chunks come first, and the
    chunks of the other texts meet every chunk, each pair of chunks in a group (low, high) of its own.
    """
    parts = connected(known, "op6-parts").withColumnsRenamed({"node": "doc_id", "root": "part"})
    rows = texts.join(parts, "doc_id", "left").withColumn("part", F.coalesce("part", "doc_id"))
    chars = rows.groupBy("cluster", "part").agg(F.sum(F.length("text")).alias("chars"))
    tops = chars.groupBy("cluster").agg(F.max(F.struct("chars", "part")).alias("top"), F.sum("chars").alias("chars"))
    chunks = stored(tops.select("cluster", F.col("top.part").alias("main"), F.ceil(F.col("top.chars") / most).alias("m"), F.ceil((F.col("chars") - F.col("top.chars")) / most).alias("r")), "op6-chunks")
    rows = rows.join(chunks, "cluster")
    in_main, last, by_hash = F.col("part") == F.col("main"), F.col("m") + F.col("r") - 1, F.xxhash64("doc_id")
    rows = rows.withColumn("mine", F.when(in_main, F.pmod(by_hash, F.col("m"))).otherwise(F.col("m") + F.pmod(by_hash, F.col("r"))))
    meets = F.when(in_main & (F.col("r") == 0), F.expr("cast(array() as array<bigint>)")).when(in_main, F.sequence("m", last))
    rows = rows.withColumn("other", F.explode(meets.otherwise(F.sequence(F.lit(0).cast("long"), last))))
    side = F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1)
    return rows.select("cluster", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), side.alias("side"), "doc_id", "part", "text")


def links(cluster_of: DataFrame, stars: DataFrame, docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE, most: int = CLUSTER_CHARS) -> DataFrame:
    """Exact links (a, b) that join up each cluster (node, root); nodes are ids of docs, one text each.

    stars: pairs (a, b) that span the clusters; those of a large cluster are tried first.
    """
    ids, texts = cluster_of.select(F.col("node").alias("doc_id"), F.col("root").alias("cluster")), docs.select("doc_id", "text")
    lengths = docs.select("doc_id", F.length("text").alias("chars")).join(ids.hint("merge"), "doc_id").groupBy("cluster").agg(F.sum("chars").alias("chars"))
    large = stored(lengths.where(F.col("chars") > most).select("cluster"), "op6-large")
    # Stored, so that Spark knows their sizes: without large clusters no text is shuffled for them.
    members = stored(ids.join(large, "cluster", "left_semi"), "op6-large-members")
    held = stored(texts.join(members, "doc_id"), "op6-large-texts")
    pairs = stars.join(members.select(F.col("doc_id").alias("a")), "a", "left_semi")
    for node, text in (("b", "other"), ("a", "one")):
        pairs = pairs.join(held.select(F.col("doc_id").alias(node), F.col("text").alias(text)), node)
    known = stored(confirmed(pairs, threshold, size), "op6-known")
    number = lambda n, name: F.lit(n).cast("long").alias(name)
    usual = texts.join(ids.join(large, "cluster", "left_anti").hint("merge"), "doc_id")
    usual = usual.select("cluster", number(0, "low"), number(0, "high"), F.lit(2).alias("side"), "doc_id", F.col("doc_id").alias("part"), "text")
    rows = usual.unionByName(_dealt(held, known, most))

    def compare(group: pa.Table) -> pa.Table:
        ids, part, side = (group.column(c).to_numpy() for c in ("doc_id", "part", "side"))
        found = _links(ids, group.column("text").to_pylist(), part, side, threshold, size) if group.num_rows > 1 else []
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return rows.groupBy("cluster", "low", "high").applyInArrow(compare, "a long, b long").unionByName(known)


def components(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Texts are linked when the sets of their shingles of `size` words have a similarity of threshold percent or more.
    """
    signed = stored(signatures(docs, size, *banding(threshold)), "op6-signatures")
    usable = signed.where("doc_id is not null and set_key is not null")
    classes = usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = stored(classes, "op6-classes")
    banded = classes.select("rep", F.explode("bands").alias("key"))
    leaders = banded.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Both joins are by shuffle at every size: the smaller sides grow with the input, and Spark splits hot keys of either.
    met = banded.join(leaders.hint("merge"), "key").groupBy("rep").agg(F.collect_set("leader").alias("leaders"))
    # A text hangs on the first of its leaders (one per band at most), and these on one another: near copies share their
    # leaders, so a large group is about one edge per text and a few among its leaders.
    first = F.array_min("leaders")
    stars = met.select(first.alias("a"), F.explode(F.array_union("leaders", F.array("rep"))).alias("b")).where("a <> b").distinct()
    stars = stored(stars, "op6-stars")
    clusters = connected(stars, "op6-stars")
    # A node's text: of rows that share an id, each representative's set is that of one of its rows.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = links(clusters, stars, texts, threshold, size)
    # Rows of one class are linked by their equal sets; an id in two classes links them.
    members = usable.join(classes.select("set_key", "rep"), "set_key").select("doc_id", "rep").distinct()
    several = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    roots = connected(found.unionByName(several), "op6-links")
    named = members.groupBy("doc_id").agg(F.min("rep").alias("rep")).join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("doc_id", F.coalesce("root", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles").join(named, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents").select("doc_id", "text"), threshold=85, size=3)


def reject(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, once if it is repeated.

    Rows are the nodes here, not ids: of an id with two texts, each text has its own group. Rows with a null id and
    rows without words are kept.
    """
    # Stored with their numbers, so that these are the same on every read.
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "op6-rows")
    named = rows.where("doc_id is not null")
    groups = components(named.select(F.col("__row").alias("doc_id"), "text"), threshold, size).select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group"))
    order = F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("text"), F.col("__row").alias("row"))
    # A least value is pre-aggregated, so a large group is no hot key.
    chosen = named.select("__row", order.alias("__order")).join(groups, "__row").groupBy("__group").agg(F.min("__order").alias("__least"))
    kept = named.join(chosen.select(F.col("__least.row").alias("__row")), "__row", "left_semi")
    return kept.select(*docs.columns).unionByName(rows.where("doc_id is null").select(*docs.columns))


QUERIES = {"op6_near_dedup": op6_near_dedup}
SQL: dict[str, str] = {}
