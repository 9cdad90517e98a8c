"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame functions only.

Sources are cut into blocks by a hash of the document. Each source's target fixes how many whole passes it makes and,
in one more pass over its permuted blocks, which blocks it gives whole and where in the next block it stops: an exact
quota of blocks per source. A binary tree over the output shards then deals the drawn blocks out: at every node the
blocks are permuted and the left half of the shards takes its share, which draws the sources' counts from the
multivariate hypergeometric distribution, and the right half takes the rest. Within a shard documents are put in a
random order. Nothing depends on how the input is partitioned, so reruns agree.

Blocks are planned in number (`blocks` in all, whatever the input's size), so the plan is a small table. The one block of
each source in which its quota ends is divided the same way, by LEVELS more hashes into SPLIT parts each, of which one is
cut in turn; so no task orders more than a source's share of 1 / (2048 * 32 * 32), whatever the source's size. Texts are
shuffled once, by `emit`, which puts the drawn documents of a shard together in random order.

Defined cases: a null text has size 0; a null source is a source, the last one; a row with a null id is
placed by its text, so such rows spread; repeated rows (of one id, or of one text without id) fall into one block; sources without words have target 0; an empty table gives an
empty result; extra columns are left out, or carried to `emit` under their own names; documents that tie in the order of
a cut part are taken by id, then size; a very long text is one row and taken by its size alone.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blank_words, stored, table, whole

#: Weights in the order of the sources, repeating; share of all words that the mix takes; most passes over a source.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
SHARDS, BLOCKS = 32, 2048
#: Levels of parts inside a cut block, and parts of a level.
LEVELS, SPLIT = 2, 32


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, size, the digest of a text without id, and, as one struct, the document itself."""
    own = F.when(F.col("doc_id").isNull(), F.md5(text)).alias("own")
    return docs.select("doc_id", "source", own, F.size(blank_words(whole(text))).cast("long").alias("size"), F.struct(*docs.columns).alias("__row"))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: source_size and target, filled by weight until no source is above `most` times its size."""
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # The sources themselves are few; the windows below see one row of each.
    ranked = by.withColumn("n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("n") - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", (most * F.col("source_size")).cast("double"))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "n").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.lit(share) * F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double")
    ranked = ranked.withColumn("level", level).withColumn("capped", F.col("cap") / F.col("weight") <= F.col("level"))
    free = F.min_by("level", F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "n"))).over(everything)
    return ranked.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(free * F.col("weight")).alias("target"))


def _key(*parts) -> Column:
    return F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("-")) if isinstance(p, Column) else F.lit(str(p)) for p in parts)))


def _modulo(digest: Column, n: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n


def block_of(sized: DataFrame, goals: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """sized with its source's figures, each document's block and its place in the block's order."""
    total = F.sum("source_size").over(Window.partitionBy())
    goals = goals.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.lit(blocks) * F.col("source_size") / F.greatest(total, F.lit(1)))).cast("long"))
    goals = goals.withColumnRenamed("source", "__source")
    # One row per source; Spark broadcasts it by its size.
    joined = sized.join(goals, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    key = F.coalesce(F.col("doc_id").cast("string"), "own")
    return joined.withColumns({"block": _modulo(_key("block", key), F.col("n_blocks")), "place": _key("place", key)})


def plan(placed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per block: whole passes, words that the last pass takes of it, and the shard of every draw."""
    by = placed.groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    by = by.withColumn("goal", F.round("target").cast("long"))
    by = by.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("goal") / F.col("source_size"))).otherwise(0).cast("long"))
    order = Window.partitionBy("source").orderBy(_key("order", F.col("source"), F.col("block")), "block").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("goal") - F.col("passes") * F.col("source_size") - F.coalesce(F.sum("words").over(order), F.lit(0))
    by = by.withColumn("part", F.greatest(F.lit(0), F.least("words", rest)).cast("long"))
    draws = F.col("passes") + (F.col("part") > 0).cast("long")
    drawn = by.where(draws > 0).select("source", "block", F.explode(F.sequence(F.lit(1).cast("long"), draws)).alias("draw"))
    drawn = drawn.withColumns({"low": F.lit(0), "high": F.lit(shards)})
    for depth in range((shards - 1).bit_length()):
        node = Window.partitionBy("low", "high")
        rank = F.row_number().over(node.orderBy(_key("split", depth, F.col("source"), F.col("block"), F.col("draw")), "source", "block", "draw"))
        half = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        quota = F.floor(F.count("*").over(node) * (half - F.col("low")) / (F.col("high") - F.col("low")))
        drawn = drawn.withColumns({"left": rank <= quota, "half": half}).select(
            "source", "block", "draw",
            F.when((F.col("high") - F.col("low") > 1) & ~F.col("left"), F.col("half")).otherwise(F.col("low")).alias("low"),
            F.when((F.col("high") - F.col("low") > 1) & F.col("left"), F.col("half")).otherwise(F.col("high")).alias("high"),
        )
    dealt = drawn.groupBy("source", "block").agg(*(F.max(F.when(F.col("draw") == d, F.col("low"))).alias(f"shard_{d}") for d in range(1, MOST + 1)))
    dealt = dealt.withColumnsRenamed({"source": "__source", "block": "__block"})
    by = by.join(dealt, F.col("source").eqNullSafe(F.col("__source")) & (F.col("block") == F.col("__block")), "left")
    return by.select("source", "block", "words", "passes", "part", *(f"shard_{d}" for d in range(1, MOST + 1)))


def _parts(cut: DataFrame) -> DataFrame:
    """For documents (source, block, place, size) of cut blocks: where each part of each level stands against the quota.

    One row per (source, block, path): the words before the part within its parent, and the words it has. A path is the
    first digits of `place`, one per level in base SPLIT, so parts follow the order of the documents.
    """
    out = None
    for level in range(1, LEVELS + 1):
        path = _path(level)
        by = cut.groupBy("source", "block", path.alias("path")).agg(F.sum("size").alias("words"))
        before = Window.partitionBy("source", "block", F.floor(F.col("path") / SPLIT)).orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
        by = by.select(F.lit(level).alias("level"), "source", "block", "path", "words", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
        out = by if out is None else out.unionByName(by)
    return out


def _path(level: int) -> Column:
    """The part of a level that a document lies in: the leading bits of its place."""
    bits = (SPLIT - 1).bit_length() * level
    return F.shiftright(F.conv(F.substring("place", 1, 8), 16, 10).cast("long"), 32 - bits)


def draw(placed: DataFrame, planned: DataFrame, parts: DataFrame) -> DataFrame:
    """placed with taken (words, repeats counted), last (those of the last pass) and the shard of each draw."""
    planned = planned.withColumnsRenamed({"source": "__source", "block": "__block"})
    rows = placed.join(planned, F.col("source").eqNullSafe(F.col("__source")) & (F.col("block") == F.col("__block"))).drop("__source", "__block")
    inside = (F.col("part") > 0) & (F.col("part") < F.col("words")) & (F.col("size") > 0)
    settled = rows.where(~inside).withColumn("last", F.when(F.col("part") > 0, F.col("size")).otherwise(0).cast("long"))
    # One block of each source is cut inside. Level by level a part is taken whole, left, or cut: then it goes on with
    # what is left of the quota. Only the documents of the last level's cut part are put in order.
    cut = rows.where(inside).withColumn("quota", F.col("part"))
    for level in range(1, LEVELS + 1):
        names = {"source": "__source", "block": "__block", "path": "__path", "words": "__words", "before": "__before"}
        held = parts.where(F.col("level") == level).drop("level").withColumnsRenamed(names)
        cut = cut.join(held, F.col("source").eqNullSafe(F.col("__source")) & (F.col("block") == F.col("__block")) & (_path(level) == F.col("__path")))
        cut = cut.withColumn("quota", F.greatest(F.lit(0), F.least("__words", F.col("quota") - F.col("__before"))).cast("long"))
        whole_part = F.col("quota") >= F.col("__words")
        settled = settled.unionByName(cut.where(whole_part | (F.col("quota") == 0)).withColumn("last", F.when(whole_part, F.col("size")).otherwise(0).cast("long")).drop("quota", *names.values()))
        cut = cut.where(~whole_part & (F.col("quota") > 0)).drop(*names.values())
    before = Window.partitionBy("source", "block").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.greatest(F.lit(0), F.least("size", F.col("quota") - F.coalesce(F.sum("size").over(before), F.lit(0)))).cast("long")
    rows = settled.unionByName(cut.withColumn("last", taken).drop("quota"))
    shards = {f"shard_{d}": F.when(_of_draw(d) > 0, F.col(f"shard_{d}")) for d in range(1, MOST + 1)}
    return rows.withColumn("taken", F.col("passes") * F.col("size") + F.col("last")).withColumns(shards)


def _of_draw(d: int) -> Column:
    """Words that a draw takes of its document."""
    return F.when(F.lit(d) <= F.col("passes"), F.col("size")).otherwise(F.when(F.lit(d) == F.col("passes") + 1, F.col("last")).otherwise(0))


def mix(docs: DataFrame, text: str = "text", shards: int = SHARDS, blocks: int = BLOCKS, carry: bool = False) -> DataFrame:
    """One row per document: size, source_size, target, taken, the shards of its draws; carry: also the document, for `emit`."""
    rows = sizes(docs, text)
    sized = stored(rows.drop("__row"), "op5-sizes")
    goals = stored(targets(sized).coalesce(1), "op5-targets")
    placed = block_of(sized, goals, blocks)
    planned = stored(plan(placed, shards).coalesce(1), "op5-plan")
    cut = planned.where("part > 0 and part < words").select(F.col("source").alias("__source"), F.col("block").alias("__block"))
    inside = placed.join(cut, F.col("source").eqNullSafe(F.col("__source")) & (F.col("block") == F.col("__block")), "left_semi")
    parts = stored(_parts(inside.where("size > 0").select("source", "block", "place", "size")), "op5-parts")
    drawn = draw(block_of(rows, goals, blocks) if carry else placed, planned, parts)
    names = ("doc_id", "source", "size", "source_size", "target", "taken", "passes", "last", *(f"shard_{d}" for d in range(1, MOST + 1)), "place")
    return drawn.select(*names, *(["__row"] if carry else []))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself (of `mix` with carry), one row per draw: the documents' columns, then size, source_size, target, draw, shard, and taken,
    the draw's words. Shards stand together, one after another, each in a random order of its own.

    Only the last document of a source's quota is taken in part; its text stays whole, and taken says how far it counts.
    """
    draws = F.array(*(F.struct(F.lit(d).alias("draw"), F.col(f"shard_{d}").alias("shard"), _of_draw(d).cast("long").alias("taken")) for d in range(1, MOST + 1)))
    rows = mixed.select("__row", "size", "source_size", "target", "place", F.explode(F.filter(draws, lambda x: x["shard"].isNotNull())).alias("d"))
    own = ("size", "source_size", "target", "draw", "shard", "taken")
    rows = rows.withColumns({"__shard": F.col("d.shard"), "__local": _key("local", F.col("place"), F.col("d.draw"))})
    # Ranges of (shard, random key) are even, so a shard is as many tasks as it is large.
    rows = rows.repartitionByRange("__shard", "__local").sortWithinPartitions("__shard", "__local")
    names = [c for c in rows.schema["__row"].dataType.names if c not in own]
    return rows.select(*(F.col(f"__row.`{c}`") for c in names), *(F.col(c if c in ("size", "source_size", "target") else f"d.{c}") for c in own))


def op5_source_mix(spark, sf_dir: str) -> DataFrame:
    shards = (F.coalesce(f"shard_{d}", F.lit(-1)).alias(f"shard_{d}") for d in (1, 2))  # -1: not drawn
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", *shards)


def _sql() -> str:
    key = lambda *parts: "md5(concat_ws('|', " + ", ".join(parts) + "))"
    source = "coalesce(source, '-')"
    levels, last = "", "drawn"
    for depth in range((SHARDS - 1).bit_length()):
        order = f"{key("'split'", f"'{depth}'", source, 'block::varchar', 'draw::varchar')}, source nulls first, block, draw"
        levels += f"""
r{depth} as (select *, (low + high) // 2 as half, row_number() over (partition by low, high order by {order}) as r, count(*) over (partition by low, high) as n from {last}),
t{depth} as (
  select source, block, draw, case when high - low > 1 and not is_left then half else low end as low, case when high - low > 1 and is_left then half else high end as high
  from (select *, r <= floor(n * (half - low) / (high - low)) as is_left from r{depth})),"""
        last = f"t{depth}"
    shards = ", ".join(f"max(low) filter (draw = {d}) as shard_{d}" for d in (1, 2))
    return rf"""
with sized as (
  select doc_id, source, coalesce(doc_id::varchar, md5(text), '-') as own, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::bigint as size from documents),
by_source as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (
  select source, source_size, row_number() over (order by source nulls last) as n, [{', '.join(map(str, WEIGHTS))}][(row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1] as weight,
    ({MOST} * source_size)::double as cap
  from by_source),
levels as (
  select *, (({SHARE} * sum(source_size) over ())::double - coalesce(sum(cap) over b, 0)) / (sum(weight) over () - coalesce(sum(weight) over b, 0))::double as level
  from ranked window b as (order by cap / weight, n rows between unbounded preceding and 1 preceding)),
goals as (
  select source, source_size, case when cap / weight <= level then cap else weight * (select arg_min(level, (cap / weight, n)) from levels where not cap / weight <= level) end as target,
    greatest(1, ceil({BLOCKS} * source_size / greatest(sum(source_size) over (), 1)))::bigint as n_blocks
  from levels),
placed as (
  select sized.*, source_size, target, ('0x' || left({key("'block'", "own")}, 8))::bigint % n_blocks as block, {key("'place'", "own")} as place
  from sized join goals on sized.source is not distinct from goals.source),
by_block as (select source, block, sum(size)::bigint as words, any_value(source_size) as source_size, round(any_value(target))::bigint as goal from placed group by source, block),
passed as (select *, case when source_size > 0 then goal // source_size else 0 end as passes from by_block),
parts as (
  select *, greatest(0, least(words, goal - passes * source_size - coalesce(sum(words) over o, 0)))::bigint as part
  from passed window o as (partition by source order by {key("'order'", source, 'block::varchar')}, block rows between unbounded preceding and 1 preceding)),
drawn as (select source, block, unnest(range(1, passes + (part > 0)::int + 1)) as draw, 0 as low, {SHARDS} as high from parts),{levels}
dealt as (select source, block, {shards} from {last} group by source, block),
taken as (
  select p.doc_id, p.size, p.source_size, p.target, passes, shard_1, shard_2,
    case when part = words then p.size else greatest(0, least(p.size, part - coalesce(sum(p.size) over (partition by p.source, p.block order by place, p.doc_id, p.size rows between unbounded preceding and 1 preceding), 0)))::bigint end as last
  from placed p join parts b on p.source is not distinct from b.source and p.block = b.block
    left join dealt d on p.source is not distinct from d.source and p.block = d.block)
select doc_id, size, source_size, target, (passes * size + last)::bigint as taken,
  coalesce(case when (case when 1 <= passes then size else last end) > 0 then shard_1 end, -1)::int as shard_1,
  coalesce(case when (case when 2 <= passes then size else last end) > 0 then shard_2 end, -1)::int as shard_2
from taken"""


QUERIES = {"op5_source_mix": op5_source_mix}
SQL = {"op5_source_mix": _sql()}
