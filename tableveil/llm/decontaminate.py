"""Benchmark decontamination with a distributed positional inverted index, in DataFrame functions only.

The index is a table of postings (term, document, position), sorted by term inside each file, of the terms that the
test items use. A phrase query takes, for every window of an item, its two rarest terms by their number of postings,
reads only those lists, shifts each by the term's place in the item and intersects them on (document, item, shift).
The few documents that pass are compared word by word with the item, so matches are exact. A proximity query asks for
an item's rarest terms inside a span of words, in any order; of it terms are known by their 64-bit hashes.

The terms are broadcast while the index is built, at most TERM_BLOCK of them at a time: a larger vocabulary is indexed
in several passes, so the broadcast's size does not grow with either table. Documents are known by a hash of id and
text; since every match is checked on the text itself, neither a collision nor a repeated row can change a result.

Defined cases: null texts have no words and match nothing; rows with a null id and repeated rows get their own result;
items with equal ids count once and a null item id counts as an empty one; empty tables give no hits or no rows; extra
columns of the documents stay where a function says so, and results take their names over clashing ones; a very long
text is one row's array of words in memory, and of terms that tie in rarity the first in the item is taken.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, let, stored, table, whole

WINDOW = 10
#: A proximity match: this many rarest words of an item inside a span of so many words.
NEAR_TERMS, NEAR_SPAN = 3, 20
#: Distinct terms (8 bytes each) that are broadcast at once.
TERM_BLOCK = 1_000_000
_CUTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def phrase_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(whole(text)), _CUTS), "")


def items_of(benchmark: DataFrame) -> DataFrame:
    """item (id as text), words and window length; one row per distinct id and words."""
    words = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), phrase_words(F.col("text")).alias("item_words"))
    return words.where(F.size("item_words") > 0).distinct().withColumn("span", F.least(F.size("item_words"), F.lit(WINDOW)))


def doc_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(F.col(doc_id), F.col(text))


def index(docs: DataFrame, items: DataFrame, block: int = TERM_BLOCK) -> DataFrame:
    """Stored postings of all terms that the items use."""
    terms = stored(items.select(F.explode(F.transform("item_words", lambda w: F.xxhash64(w))).alias("term")).distinct(), "op2-terms")
    passes = -(-terms.count() // block) or 1
    words = docs.select(doc_key().alias("doc"), phrase_words(F.col("text")).alias("words"))
    tokens = words.select("doc", F.posexplode("words").alias("pos", "word")).select(F.xxhash64("word").alias("term"), "doc", "pos")
    postings = None
    for k in range(passes):
        some = F.broadcast(terms.where(F.pmod(F.col("term"), F.lit(passes)) == k))
        part = stored(tokens.join(some, "term").sortWithinPartitions("term"), "op2-postings")
        postings = part if postings is None else postings.unionByName(part)
    return postings


def list_lengths(postings: DataFrame) -> DataFrame:
    """(term, postings): the length of every list, stored; one row per term of the items."""
    return stored(postings.groupBy("term").agg(F.count("*").alias("postings")), "op2-lengths")


def rarest(items: DataFrame, lengths: DataFrame, how_many: int = 2) -> DataFrame:
    """items with pairs: per window that can occur, the places in the item of its rarest terms."""
    places = items.select("item", "item_words", F.posexplode("item_words").alias("at", "word")).withColumn("term", F.xxhash64("word"))
    found = places.join(lengths, "term").groupBy("item", "item_words").agg(F.map_from_entries(F.collect_list(F.struct("at", "postings"))).alias("n"))

    def best(p: Column) -> Column:
        inside = F.sequence(p, p + F.col("span") - 1)
        ranked = F.array_sort(F.transform(inside, lambda q: F.struct(F.try_element_at("n", q).alias("n"), q.alias("at"))))
        whole_window = F.forall(inside, lambda q: F.try_element_at("n", q).isNotNull())
        # A word without postings leaves a null: its window occurs nowhere.
        return F.when(whole_window, F.transform(F.slice(ranked, 1, how_many), lambda x: x["at"]))

    with_span = found.withColumn("span", F.least(F.size("item_words"), F.lit(WINDOW)))
    pairs = F.array_compact(F.transform(F.sequence(F.lit(0), F.size("item_words") - F.col("span")), best))
    return with_span.select("item", "item_words", "span", F.array_distinct(pairs).alias("pairs")).where(F.size("pairs") > 0)


def candidates(items: DataFrame, postings: DataFrame, lengths: DataFrame) -> DataFrame:
    """(doc, item, item_words, span, shifts): places where some window's rarest terms stand at its distances."""
    version = F.xxhash64("item_words").alias("version")
    chosen = stored(rarest(items, lengths), "op2-rarest")
    anchors = chosen.select("item", version, "item_words", F.explode(F.array_distinct(F.flatten("pairs"))).alias("at"))
    anchors = stored(anchors.select("item", "version", "at", F.xxhash64(F.get("item_words", F.col("at"))).alias("term")), "op2-anchors")
    # Only the asked lists are read on: Spark broadcasts their terms by the stored table's size, or shuffles both.
    asked = postings.join(anchors.select("term").distinct(), "term", "left_semi")
    shifted = asked.join(anchors, "term").select("doc", "item", "version", (F.col("pos") - F.col("at")).alias("shift"), "at")
    met = shifted.groupBy("doc", "item", "version", "shift").agg(F.collect_set("at").alias("met"))
    met = met.join(chosen.select("item", version, "pairs"), ["item", "version"]).where(F.exists("pairs", lambda p: F.size(F.array_except(p, F.col("met"))) == 0))
    # However often a document repeats an item, it carries the item's words once and one number per place.
    places = met.groupBy("doc", "item", "version").agg(F.collect_list("shift").alias("shifts"))
    return places.join(chosen.select("item", version, "item_words", "span"), ["item", "version"]).select("doc", "item", "item_words", "span", "shifts")


def matches(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with n_words, n_hit and hit_items, compared word by word at every candidate place."""
    by_doc = found.groupBy("doc").agg(F.collect_list(F.struct("item", "item_words", "span", "shifts")).alias("__found")).withColumnRenamed("doc", "__found_doc")
    docs = docs.drop("n_words", "n_hit", "hit_items")
    names = docs.columns
    rows = docs.withColumn("__key", doc_key()).join(by_doc, F.col("__key") == F.col("__found_doc"), "left")

    def hits(words: Column, c: Column) -> Column:
        same = lambda shift, q: F.coalesce(F.get(words, shift + q) == F.get(c["item_words"], q), F.lit(False))
        windows = F.sequence(F.lit(0), F.size(c["item_words"]) - c["span"])
        starts = F.flatten(F.transform(c["shifts"], lambda s: F.transform(F.filter(windows, lambda p: F.forall(F.sequence(p, p + c["span"] - 1), lambda q: same(s, q))), lambda p: s + p)))
        return F.struct(c["item"].alias("item"), F.flatten(F.transform(starts, lambda p: F.sequence(p, p + c["span"] - 1))).alias("at"))

    def summed(words: Column) -> Column:
        exact = F.filter(F.transform("__found", lambda c: hits(words, c)), lambda h: F.size(h["at"]) > 0)
        found = let(exact, lambda e: F.struct(F.size(F.array_distinct(F.flatten(F.transform(e, lambda h: h["at"])))).alias("n"), F.array_sort(F.array_distinct(F.transform(e, lambda h: h["item"]))).alias("items")))
        return F.struct(F.size(words).alias("words"), F.when(F.col("__found").isNotNull(), found).alias("found"))

    # The words are bound once inside the expression, so a filter that is pushed into it cuts no text twice.
    rows = rows.withColumn("__sum", let(phrase_words(F.col("text")), summed))
    none = F.expr("cast(array() as array<string>)")
    return rows.select(*names, F.col("__sum.words").cast("long").alias("n_words"), F.coalesce(F.col("__sum.found.n"), F.lit(0)).cast("long").alias("n_hit"), F.coalesce(F.col("__sum.found.items"), none).alias("hit_items"))


def proximity(items: DataFrame, postings: DataFrame, lengths: DataFrame, within: int = NEAR_SPAN, terms: int = NEAR_TERMS) -> DataFrame:
    """(doc, item, first, last): spans of at most `within` words that hold the item's `terms` rarest words, in any order.

    Of words that tie in rarity the first in the item is taken; an item of fewer words asks for all it has. Postings
    carry the document's hash; each row is the first such span from one of the words on.
    """
    version = F.xxhash64("item", "item_words").alias("version")
    places = items.select("item", version, F.posexplode("item_words").alias("at", "word"))
    words = places.groupBy("item", "version", F.xxhash64("word").alias("term")).agg(F.min("at").alias("at"))
    # A word without a list occurs nowhere, so neither do all words together.
    ranked = words.join(lengths, "term", "left").groupBy("item", "version").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("postings", F.lit(0)).alias("n"), "at", "term"))), 1, terms).alias("t"))
    able = stored(ranked.where(F.forall("t", lambda t: t["n"] > 0)).select("item", "version", F.col("t.term").alias("terms")), "op2-near")
    wanted = able.select("item", "version", F.size("terms").alias("need"), F.explode("terms").alias("term"))
    asked = postings.join(wanted.select("term").distinct(), "term", "left_semi")
    # One exchange serves the repeated rows' removal and the window; a group is one item's words in one text.
    met = asked.join(wanted, "term").select("doc", "version", "item", "need", "term", "pos").repartition("doc", "version").dropDuplicates(["doc", "version", "term", "pos"])
    near = Window.partitionBy("doc", "version").orderBy("pos").rangeBetween(0, within - 1)
    seen = met.withColumns({"have": F.size(F.collect_set("term").over(near)), "last": F.max("pos").over(near)})
    return seen.where(F.col("have") == F.col("need")).select("doc", "item", F.col("pos").alias("first"), "last").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs (columns kept) with n_words, n_hit and hit_items."""
    items = stored(items_of(benchmark), "op2-items")
    postings = index(docs, items)
    return matches(docs, candidates(items, postings, list_lengths(postings)))


def searched(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs (columns kept) with n_words, n_hit and hit_items, and n_near: the items with a proximity match."""
    items = stored(items_of(benchmark), "op2-items")
    postings = index(docs, items)
    lengths = list_lengths(postings)
    near = proximity(items, postings, lengths).groupBy("doc").agg(F.countDistinct("item").alias("n_near")).withColumnRenamed("doc", "__near")
    rows = matches(docs.drop("n_near").withColumn("__doc", doc_key()), candidates(items, postings, lengths))
    return rows.join(near, F.col("__doc") == F.col("__near"), "left").withColumn("n_near", F.coalesce("n_near", F.lit(0))).drop("__doc", "__near")


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = searched(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"), F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_near")


def reject(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that share no window with the benchmark."""
    # Other columns stand aside, so that none clashes and the text travels once.
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", *([F.struct(*others).alias("__others")] if others else []))
    kept = contamination(rows, benchmark).where("n_hit = 0")
    return kept.select(*(F.col(f"__others.`{c}`") if c in others else F.col(c) for c in docs.columns))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SQL = rf"""
with d as (select doc_id, list_filter(string_split_regex({_LOWER}, '{_CUTS}'), lambda x: x <> '') as w from documents),
b as (select coalesce(item_id::varchar, '') as item, list_filter(string_split_regex({_LOWER}, '{_CUTS}'), lambda x: x <> '') as w from benchmark),
wins as (
  select distinct item, least(len(w), {WINDOW}) as span, array_to_string(w[p:p + least(len(w), {WINDOW}) - 1], ' ') as g
  from (select item, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) as p from b where len(w) > 0)),
spans as (select distinct span from wins),
grams as (
  select doc_id, p, span, array_to_string(w[p:p + span - 1], ' ') as g
  from (select doc_id, w, span, unnest(range(1, len(w) - span + 2)) as p from d, spans)),
hits as (select doc_id, item, p, span from grams join wins using (span, g)),
counts as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + span)) as q from hits) group by doc_id),
named as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hits group by doc_id),
versions as (select item, w, row_number() over () as version from (select distinct item, w from b where len(w) > 0)),
places as (select item, version, word, min(pos) as pos from (select item, version, unnest(w) as word, unnest(range(len(w))) as pos from versions) group by all),
seen as (select doc_id, unnest(w) as word, unnest(range(len(w))) as pos from d),
lengths as (select word, count(*) as n from seen where word in (select word from places) group by word),
rare as (
  select *, count(*) over (partition by version) as need from (
    select item, version, word, coalesce(n, 0) as n from places left join lengths using (word)
    qualify row_number() over (partition by version order by coalesce(n, 0), pos) <= {NEAR_TERMS})),
able as (select * from rare where version not in (select version from rare where n = 0)),
close as (
  select doc_id, item, need, count(distinct word) over (partition by doc_id, version order by seen.pos range between current row and {NEAR_SPAN - 1} following) as have
  from seen join able using (word)),
near as (select doc_id, count(distinct item) as n_near from close where have = need group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(n_near, 0)::bigint as n_near
from d left join counts using (doc_id) left join named using (doc_id) left join near using (doc_id)"""

QUERIES = {"op2_decontaminate": op2_decontaminate}
SQL = {"op2_decontaminate": _SQL}
