"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Every text gets counts (words, symbols, repeated lines, words in repeated windows). A rule rejects a text whose ratio
lies above a cutoff. Cutoffs are learned per stratum (language) from labelled rows, and what is guaranteed is the
verdict of all rules together: with probability 1 - DELTA, in every stratum at most RISK of the clean texts that pass the
base rule are rejected.

For each rule and each cutoff of a fixed grid the clean labelled rows above it are false rejections. The exact binomial
probability of seeing so few if the true risk were i / PARTS of RISK must be at most DELTA divided by the number of tests
(all rules, cutoffs and strata: Bonferroni); the least such i is what the cutoff costs. All these bounds hold at once,
so any choice of cutoffs may follow: of each rule the certified cutoff that gains most (junk rejected less ten times the
clean rejected), and of these the cheapest first, for as long as their costs add up to PARTS at most, since the risk of a
union is no more than the sum of the risks. A rule without a cutoff is off in that stratum.

Defined cases: a null or empty text has no words and fails the base rule; a null language is a stratum of its own;
a stratum without enough labelled rows has no rules; labels with a null id or quality are left out, and of repeated
labels the lowest quality counts; repeated rows are judged each; an empty table gives an empty result; extra columns
stay, and the counts take their names over clashing ones; a very long text is one row's array of words in memory; rules
that tie in cost and gain are taken by name, and cutoffs that tie in gain and cost by the larger cutoff.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, blank_words, let, stored, table, whole

WINDOW = 5
#: Grid of cutoffs of each rule; a text is rejected above the cutoff.
GRID = {
    "symbols": (0.02, 0.05, 0.1, 0.2, 0.4, 0.8, 1.6),
    "dup_lines": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7),
    "repeats": (0.02, 0.05, 0.1, 0.15),
    "long_words": (8.0, 10.0, 12.0, 16.0, 24.0),
    "short_words": (-1.0, -1.5, -2.0, -2.5, -3.0),
}
RISK, DELTA = 0.05, 0.05
#: Steps in which cutoffs share the risk.
PARTS = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside 5-word windows that the text has at least twice."""
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))

    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        again = let(ordered, lambda s: F.filter(s, lambda e, k: (F.get(s, k - 1)["x"] == e["x"]) | (F.get(s, k + 1)["x"] == e["x"])))
        places = F.array_sort(F.transform(again, lambda e: e["i"]))
        zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
        step = lambda a, i: F.struct((a["total"] + i + WINDOW - F.greatest(i, a["end"])).alias("total"), (i + WINDOW).alias("end"))
        return F.aggregate(places, zero, step, lambda a: a["total"])

    # Most texts repeat no window; only the others are sorted.
    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(n < WINDOW, F.lit(0)).otherwise(found)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the counts of MEASURES and base_failed."""
    t = whole(text)
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.drop(*MEASURES, "base_failed").withColumns({"__words": blank_words(t), "__lines": lines})
    n = F.size("__words")
    counts = {
        "n_words": n,
        "word_chars": F.length(F.regexp_replace(t, BLANKS, "")),
        "n_symbols": F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": _repeat_words(F.col("__words"), n),
        "n_lines": F.size("__lines"),
    }
    docs = docs.withColumns({k: v.cast("long") for k, v in counts.items()}).drop("__words", "__lines")
    return docs.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _ratios() -> dict[str, Column]:
    n = F.greatest("n_words", F.lit(1))
    return {
        "symbols": F.col("n_symbols") / n,
        "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeats": F.col("n_repeat_words") / n,
        "long_words": F.col("word_chars") / n,
        "short_words": -(F.col("word_chars") / n),
    }


def _log_tail(k: Column, n: Column, p: float) -> Column:
    """ln P(Binomial(n, p) <= k), exact but for rounding."""
    import math

    odds = math.log(p / (1 - p))
    first = n.cast("double") * math.log1p(-p)
    zero = F.struct(first.alias("term"), first.alias("sum"))

    def step(a: Column, j: Column) -> Column:
        term = a["term"] + F.log((n - j + 1) / j) + odds
        top = F.greatest(term, a["sum"])
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(F.least(term, a["sum"]) - top))).alias("sum"))

    return F.when(k < 1, first).otherwise(F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1))), zero, step, lambda a: a["sum"]))


def _stratum(name: str) -> Column:
    """Null is apart from every text, the empty one too."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def calibrate(measured: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum: the cutoff of each rule, null where the rule is off."""
    ratios, tests = _ratios(), sum(map(len, GRID.values()))
    truth = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("__quality"))
    known = measured.where("not base_failed").select("doc_id", _stratum(stratum).alias("stratum"), *(c.alias(k) for k, c in ratios.items()))
    known = known.join(truth, "doc_id")
    clean, sums = F.col("__quality") == 1, [F.sum(F.col("__quality")).cast("long").alias("n")]
    for rule, grid in GRID.items():
        for i, cut in enumerate(grid):
            above = F.col(rule) > cut
            sums += [F.count_if(above & clean).alias(f"{rule}_{i}_false"), F.count_if(above & ~clean).alias(f"{rule}_{i}_true")]
    by = known.groupBy("stratum").agg(*sums)
    # The strata are counted by a window over their few rows.
    cells = F.array(*(F.struct(F.lit(rule).alias("rule"), F.lit(cut).alias("cut"), F.col(f"{rule}_{i}_false").alias("bad"), F.col(f"{rule}_{i}_true").alias("good")) for rule, grid in GRID.items() for i, cut in enumerate(grid)))
    by = by.withColumn("strata", F.count("*").over(Window.partitionBy()))
    by = by.select("stratum", "n", "strata", F.explode(cells).alias("c")).select("stratum", "n", "strata", "c.*")

    def certified(part: int) -> Column:
        share = risk * part / PARTS
        # At or above the risk itself nothing can be certified, so the sum stays short.
        return F.coalesce(F.when(F.col("bad") < F.col("n") * share, _log_tail(F.col("bad"), F.col("n"), share)) <= F.log(F.lit(delta) / (tests * F.col("strata"))), F.lit(False))

    by = by.withColumns({"cost": F.coalesce(*(F.when(certified(i), i) for i in range(1, PARTS + 1))), "gain": F.col("good") - 10 * F.col("bad")})
    best = by.where("cost is not null and gain > 0").groupBy("stratum", "rule").agg(F.max_by(F.struct("cut", "cost", "gain"), F.struct("gain", -F.col("cost"), "cut")).alias("x")).select("stratum", "rule", "x.*")
    spent = F.sum("cost").over(Window.partitionBy("stratum").orderBy("cost", F.desc("gain"), "rule").rowsBetween(Window.unboundedPreceding, 0))
    best = best.withColumn("spent", spent).where(F.col("spent") <= PARTS)
    return best.groupBy("stratum").agg(*(F.max(F.when(F.col("rule") == rule, F.col("cut"))).alias(f"cut_{rule}") for rule in GRID))


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """measured with kept: false for a failed base rule or a ratio above its stratum's cutoff."""
    rejected = F.lit(False)
    for rule, ratio in _ratios().items():
        rejected = rejected | F.coalesce(ratio > F.col(f"cut_{rule}"), F.lit(False))
    cuts = cutoffs.withColumnRenamed("stratum", "__stratum")
    names = [c for c in measured.columns if c != "kept"]
    # A handful of strata: Spark broadcasts them by the size of the stored table.
    joined = measured.withColumn("__key", _stratum(stratum)).join(cuts, F.col("__key") == F.col("__stratum"), "left")
    return joined.select(*names, (~F.col("base_failed") & ~rejected).alias("kept"))


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    measured = stored(measure(docs).drop("text"), "op7-measured")
    cutoffs = stored(calibrate(measured, table(spark, sf_dir, "labels")).coalesce(1), "op7-cutoffs")
    return judge(measured, cutoffs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The kept rows of docs, with the columns of docs.

    Only labelled texts are counted before the cutoffs are known; then one pass counts and judges all, and no text is
    stored or shuffled.
    """
    known = labels.where("doc_id is not null and quality is not null").select("doc_id").distinct()
    measured = stored(measure(docs.select("doc_id", "lang", "text").join(known, "doc_id", "left_semi")).drop("text"), "op7-measured")
    cutoffs = stored(calibrate(measured, labels).coalesce(1), "op7-cutoffs")
    rows = docs.select(F.struct("*").alias("__row"), "lang", "text")
    # A row number that the filter reads as well keeps the filter above the counts, so that they are made once.
    rows = measure(rows).withColumn("__number", F.monotonically_increasing_id())
    return judge(rows, cutoffs).where("kept and __number >= 0").select("__row.*")


def _sql() -> str:
    grid = ", ".join(f"('{rule}', {float(cut)!r}::double)" for rule, cuts in GRID.items() for cut in cuts)
    tests = sum(map(len, GRID.values()))
    return rf"""
with words as (
  select doc_id, coalesce('=' || lang, '') as stratum, coalesce(text, '') as t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
grams as (
  select doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], chr(31)) as g
  from (select doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from words)),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from grams) where n > 1),
places as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + {WINDOW})) as p from again) group by doc_id),
m as (
  select words.doc_id, stratum, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words, len(l)::bigint as n_lines
  from words left join places using (doc_id)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m),
ratios as (
  select doc_id, stratum, base_failed, unnest([
    {{'rule': 'symbols', 'x': n_symbols / greatest(n_words, 1)}}, {{'rule': 'dup_lines', 'x': n_dup_lines / greatest(n_lines, 1)}},
    {{'rule': 'repeats', 'x': n_repeat_words / greatest(n_words, 1)}}, {{'rule': 'long_words', 'x': word_chars / greatest(n_words, 1)}},
    {{'rule': 'short_words', 'x': -(word_chars / greatest(n_words, 1))}}], recursive := true)
  from b),
truth as (select doc_id, min(quality) as quality from labels where doc_id is not null and quality is not null group by doc_id),
grid(rule, cut) as (values {grid}),
cells as (
  select stratum, rule, cut, sum(quality)::bigint as n, count(*) filter (x > cut and quality = 1) as bad, count(*) filter (x > cut and quality <> 1) as good
  from ratios join truth using (doc_id) join grid using (rule) where not base_failed group by stratum, rule, cut),
tails as (
  select stratum, rule, cut, good, bad, part,
    (select sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK} * part / {PARTS}) + (n - j) * ln(1 - {RISK} * part / {PARTS}))) from (select unnest(range(0, bad + 1)) as j)) as p
  from cells, (select unnest(range(1, {PARTS + 1})) as part) where bad < n * {RISK} * part / {PARTS}),
costs as (
  select stratum, rule, cut, any_value(good - 10 * bad) as gain, min(part) as cost from tails
  where p <= {DELTA} / ({tests} * (select count(distinct stratum) from cells)) and good - 10 * bad > 0 group by stratum, rule, cut),
one as (select * from costs qualify row_number() over (partition by stratum, rule order by gain desc, cost, cut desc) = 1),
best as (select stratum, rule, cut from one qualify sum(cost) over (partition by stratum order by cost, gain desc, rule rows between unbounded preceding and current row) <= {PARTS}),
verdict as (select doc_id, bool_or(coalesce(x > cut, false)) as rejected from ratios left join best using (stratum, rule) group by doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not rejected as kept
from b join verdict using (doc_id)"""


QUERIES = {"op7_quality_rules": op7_quality_rules}
SQL = {"op7_quality_rules": _sql()}
