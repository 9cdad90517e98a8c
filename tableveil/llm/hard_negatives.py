"""Hard-negative mining: for an anchor and each of its nearest rows of the same label, the nearest rows of other labels
whose score is high, but not too high against the positive's.

Scores are exact inner products of whole-number vectors, found with the Four Russians' tables. A candidate's components
are cut into bit planes, packed eight dimensions to a byte. For every anchor and group of eight dimensions a table holds
the sums of all 256 subsets of the anchor's components; a plane's byte is an index into it, so a plane of a vector costs
one lookup per eight dimensions, and the planes' sums are shifted and added (the top plane, of the sign, subtracts).

1. Rows become bit planes once, stored; anchors keep their components as well.
2. Candidates are dealt into chunks and anchors into blocks by a hash of the row; each pair of these is a group of its
   own, of bounded size whatever the input, labels or ties. Only anchors are repeated per chunk and chunks per block.
3. A first pass scores anchors against rows of their own label and keeps the first few of each group, then of all. A
   second pass, which knows the positives, scores the other labels and keeps the first few inside each positive's range.

Defined cases: rows with a null id, label or vector, or a null, NaN or infinite component, take no part; components are
scaled in double precision and held to +-sqrt(2**62 / dimensions), so that a score always fits 64 bits; rows whose
vectors differ in length are not scored together, and empty vectors score 0; equal scores go by the smaller id; a row
is no positive or negative of a row with its own id; repeated rows are rows of their own (an anchor that stands twice
has its results twice); an empty table gives an empty result; extra columns are left out.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score, from and to.
RANGE = (30, 90)
#: Candidates and anchors that a group holds, about.
CHUNK, BLOCK = 4096, 512
#: Candidates that are looked up at once.
_TILE = 256
_SUBSETS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)


def quantized(values: np.ndarray) -> np.ndarray:
    """Whole numbers floor(SCALE * x) of rows of doubles."""
    most = int((2**62 / max(1, values.shape[1])) ** 0.5)
    return np.clip(np.floor(SCALE * values), -most, most).astype(np.int64)


def planes(rows: np.ndarray, bits: int) -> np.ndarray:
    """Bytes (plane, group of eight dimensions, row) of rows of whole numbers that fit `bits`; the sign's plane first."""
    cut = np.stack([np.packbits((rows >> k) & 1, axis=1) for k in range(bits - 1, -1, -1)]) if rows.size else np.zeros((bits, len(rows), -(-rows.shape[1] // 8)), np.uint8)
    return np.ascontiguousarray(cut.transpose(0, 2, 1), dtype=np.uint8)


def width(rows: np.ndarray) -> int:
    """Bits that hold every number of the rows, its sign included."""
    return int(max(rows.max(initial=0), -1 - rows.min(initial=0))).bit_length() + 1


class Tables:
    """Sums of all subsets of every eight components of some anchors."""

    def __init__(self, anchors: np.ndarray):
        n, dims = anchors.shape
        padded = np.zeros((n, -(-dims // 8) * 8), np.int64)
        padded[:, :dims] = anchors
        self.n, bound = n, int(np.abs(anchors).sum(axis=1).max(initial=0))
        # A plane's sum fits the narrow type, a whole score needs more.
        self.narrow = np.int16 if bound < 1 << 15 else np.int64
        self.bound = bound
        self.sums = np.ascontiguousarray(np.einsum("sk,ngk->gsn", _SUBSETS, padded.reshape(n, -1, 8)), dtype=self.narrow)

    def scores(self, packed: np.ndarray) -> np.ndarray:
        """(row, anchor) scores of the rows behind `planes`."""
        bits, groups, rows = packed.shape
        wide = np.int32 if self.bound << bits < 1 << 31 else np.int64
        out = np.empty((rows, self.n), wide)
        for at in range(0, rows, _TILE):
            some = packed[:, :, at : at + _TILE]
            total = np.zeros((some.shape[2], self.n), wide)
            for k in range(bits):
                plane = np.zeros(total.shape, self.narrow)
                for g in range(groups):
                    plane += self.sums[g].take(some[k, g], axis=0)
                total <<= 1
                if k:
                    total += plane
                else:
                    total -= plane
            out[at : at + _TILE] = total
        return out


def vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, dims, planes, row, anchor) of the rows that take part; anchor holds the components of anchors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    usable = rows.where("vec_id is not null and label is not null and embedding is not null").where(finite).select("vec_id", label.alias("label"), "embedding")
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("dims", pa.int32()), ("planes", pa.binary()), ("anchor", pa.binary())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                lists, ids = batch.column("embedding"), batch.column("vec_id").to_numpy()
                lengths, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
                starts = np.cumsum(lengths) - lengths
                made: list = [None] * len(ids)
                kept: list = [None] * len(ids)
                for dims in np.unique(lengths):
                    which = np.flatnonzero(lengths == dims)
                    values = quantized(flat[starts[which][:, None] + np.arange(dims)].reshape(len(which), dims))
                    cut = planes(values, width(values)).transpose(2, 0, 1)
                    for i, at in enumerate(which):
                        made[at] = cut[i].tobytes()
                        if ids[at] % 100 == 0:
                            kept[at] = values[i].tobytes()
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(lengths, pa.int32()), pa.array(made, pa.binary()), pa.array(kept, pa.binary())], schema=schema)

    out = usable.mapInArrow(packed, "vec_id long, label long, dims int, planes binary, anchor binary")
    # Numbered where they are stored, so that a row keeps its number on every read.
    return stored(out.withColumn("row", F.monotonically_increasing_id()), "op13-vectors")


def _matrix(column: pa.ChunkedArray, dims: int, many: int) -> np.ndarray:
    """Components of the anchors in a column of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(many, dims)


def _planes(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Planes of the rows in a column; those with fewer than the most repeat their sign's."""
    held, groups = column.to_pylist(), -(-dims // 8)
    if not groups:
        return np.zeros((1, 0, len(held)), np.uint8)
    sizes = np.array([len(x) // groups for x in held])
    bits = int(sizes.max(initial=1))
    out = np.empty((len(held), bits, groups), np.uint8)
    for size in np.unique(sizes):
        which = np.flatnonzero(sizes == size)
        part = np.frombuffer(b"".join(held[i] for i in which), np.uint8).reshape(len(which), size, groups)
        out[which, bits - size :] = part
        out[which, : bits - size] = part[:, :1]
    return np.ascontiguousarray(out.transpose(1, 2, 0))


def _sorted(group: pa.Table) -> pa.Table:
    return group.sort_by("vec_id")


def _groups(rows: DataFrame, anchors: DataFrame, chunk: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Candidates and anchors with the numbers of the groups that compare them."""
    counts = rows.agg(F.count("*").alias("rows"), F.count("anchor").alias("anchors")).first()
    chunks, blocks = max(1, -(-counts["rows"] // chunk)), max(1, -(-counts["anchors"] // block))
    number = lambda many: F.pmod(F.xxhash64("row"), F.lit(many)).cast("long")
    every = lambda many: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long")))
    candidates = rows.select("dims", number(chunks).alias("chunk"), every(blocks).alias("block"), "vec_id", "label", "planes")
    return candidates, anchors.withColumn("block", number(blocks)).withColumn("chunk", every(chunks))


def _first_positives(anchors: pa.Table, rows: pa.Table, most: int) -> tuple[list, list, list]:
    """Row numbers of anchors, ids and scores of their first rows of the same label in this group."""
    dims = anchors.column("dims")[0].as_py()
    values, packed = _matrix(anchors.column("anchor"), dims, anchors.num_rows), _planes(rows.column("planes"), dims)
    of, mine, ids, labels = (t.column(c).to_numpy() for t, c in ((anchors, "row"), (anchors, "vec_id"), (rows, "vec_id"), (rows, "label")))
    wanted = anchors.column("label").to_numpy()
    out: tuple[list, list, list] = ([], [], [])
    for label in np.unique(wanted):
        there, who = np.flatnonzero(labels == label), np.flatnonzero(wanted == label)
        if not len(there):
            continue
        scores = Tables(values[who]).scores(packed[:, :, there])
        for k, a in enumerate(who):
            # Rows stand in the order of their ids, so a stable order breaks ties by the smaller.
            order = np.argsort(-scores[:, k], kind="stable")
            order = order[ids[there[order]] != mine[a]][:most]
            out[0].extend([of[a]] * len(order))
            out[1].extend(ids[there[order]])
            out[2].extend(scores[order, k])
    return out


def _first_negatives(anchors: pa.Table, rows: pa.Table, most: int, bounds: tuple[int, int]) -> tuple[list, list, list, list]:
    """Row numbers of anchors, places of positives, ids and scores of the first rows of other labels in each range."""
    dims = anchors.column("dims")[0].as_py()
    values, packed = _matrix(anchors.column("anchor"), dims, anchors.num_rows), _planes(rows.column("planes"), dims)
    of, mine, wanted, ids, labels = (t.column(c).to_numpy() for t, c in ((anchors, "row"), (anchors, "vec_id"), (anchors, "label"), (rows, "vec_id"), (rows, "label")))
    scores = Tables(values).scores(packed)
    out: tuple[list, list, list, list] = ([], [], [], [])
    for a, positives in enumerate(anchors.column("positives").to_pylist()):
        other = np.flatnonzero((labels != wanted[a]) & (ids != mine[a]))
        order = np.argsort(-scores[other, a], kind="stable")
        other = other[order]
        falling = -scores[other, a].astype(np.int64)
        for at, p in enumerate(positives):
            # lowest <= score <= highest, in whole numbers; Python's are exact at any size.
            lowest, highest = -(-bounds[0] * p["score"] // 100), bounds[1] * p["score"] // 100
            if lowest > highest:
                continue
            begin, end = np.searchsorted(falling, -highest, "left"), np.searchsorted(falling, -lowest, "right")
            chosen = other[begin : min(end, begin + most)]
            out[0].extend([of[a]] * len(chosen))
            out[1].extend([at] * len(chosen))
            out[2].extend(ids[chosen])
            out[3].extend(scores[chosen, a])
    return out


def mined(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, bounds: tuple[int, int] = RANGE, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among rows.

    Rows whose id is divisible by 100 are anchors. bounds: least and most percent of the positive's score.
    """
    held = vectors(rows)
    anchors = held.where("anchor is not null").select("dims", "vec_id", "label", "row", "anchor")
    key = ("dims", "chunk", "block")

    def near(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = _first_positives(anchors, _sorted(rows), positives) if anchors.num_rows and rows.num_rows else ([], [], [])
        return pa.table({n: pa.array(np.array(c, np.int64)) for n, c in zip(("row", "positive_id", "score"), found, strict=True)})

    def far(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = _first_negatives(anchors, _sorted(rows), negatives, bounds) if anchors.num_rows and rows.num_rows else ([], [], [], [])
        return pa.table({n: pa.array(np.array(c, np.int64)) for n, c in zip(("row", "place", "negative_id", "negative_score"), found, strict=True)})

    candidates, asking = _groups(held, anchors, chunk, block)
    first = asking.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInArrow(near, "row long, positive_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "positive_id")
    first = first.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    chosen = first.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "score"))).alias("positives"))
    asked = stored(anchors.join(chosen, "row"), "op13-asked")
    _, asking = _groups(held, asked, chunk, block)
    second = asking.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInArrow(far, "row long, place long, negative_id long, negative_score long")
    best = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    second = second.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    names = asked.select("row", F.col("vec_id").alias("anchor_id"), "positives")
    out = second.join(names, "row").withColumn("p", F.element_at("positives", (F.col("place") + 1).cast("int")))
    return out.select("anchor_id", F.col("p.positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id", F.col("p.score").alias("positive_score"), "negative_score")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return mined(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))


_SQL = f"""
with u as (select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end) as label, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as v
 from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same, list_dot_product(a.v, r.v)::bigint as score from u a join u r on a.vec_id <> r.vec_id and len(a.v) = len(r.v) where a.vec_id % 100 = 0),
p as (select anchor_id, id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= {POSITIVES})
select anchor_id, positive_id, (row_number() over (partition by anchor_id, positive_id order by score desc, id))::int as rank, id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not same and {RANGE[0]} * positive_score <= 100 * score and 100 * score <= {RANGE[1]} * positive_score
qualify rank <= {NEGATIVES}"""

QUERIES = {"op13_hard_negatives": op13_hard_negatives}
SQL = {"op13_hard_negatives": _SQL}
