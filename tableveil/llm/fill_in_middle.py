"""Fill-in-the-middle: texts cut into prefix, middle and suffix, and put together again in the order a model is to learn.

`regexp_count` gives a text's length n in code points. Two draws from a hash of the id give the cuts a <= b, and every
row's own pattern, `(.{a}+)(.{b-a}+)(.*+)`, captures the three parts in one match, whose replacement is the output:
possessive counts never step back, so a match is one pass over the text whatever its length.

The count takes large blocks first, then smaller ones of what is left, so that the list of matches which Spark makes
stays short for very long texts.

Defined cases: a null text is empty and stays plain, as does a text that holds a marker; a null id draws as the empty
id; rows that repeat an id are cut alike if their texts are equal; there are no ties (equal cuts give an empty middle);
an empty table gives an empty result; extra columns are kept by `transform`, those with the name of a new column give
way to it; a very long text is one row throughout.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, whole

#: Markers of the parts: prefix, suffix, middle.
MARKS = ("<P>", "<S>", "<M>")
#: Rows in a hundred that are cut, and those of them that have the suffix first.
RATE, SUFFIX_FIRST = 90, 20
SEED = "1"
#: Code points that a match counts, from block to block.
BLOCKS = (1024, 32, 1)


def with_length(docs: DataFrame, name: str, text: Column) -> DataFrame:
    """docs with the code points of a text, by counted matches."""
    total, rest = F.lit(0).cast("long"), text
    for k, size in enumerate(BLOCKS):
        docs = docs.withColumn(f"__n{k}", F.regexp_count(rest, F.lit(f"(?s).{{{size}}}+")))
        total = total + F.col(f"__n{k}") * size
        docs = docs.withColumn(f"__rest{k}", F.substring(rest, F.col(f"__n{k}") * size + 1, F.lit(size)))
        rest = F.col(f"__rest{k}")
    return docs.withColumn(name, total).drop(*(f"__{what}{k}" for what in ("n", "rest") for k in range(len(BLOCKS))))


def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four unsigned numbers of 32 bits from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = MARKS, seed: str = SEED) -> DataFrame:
    """docs with n, form (plain, psm, spm), prefix_chars, middle_chars and output.

    psm puts the prefix first, spm the suffix. Markers must differ from one another, and none may hold another's or its
    own beginning further on (`<P>` and the like do not), so that an output can be taken apart.
    """
    p, s, m = marks
    if any(not x or x[0] in x[1:] for x in marks) or len({*marks}) < 3 or len({x[0] for x in marks}) > 1:
        raise ValueError("markers must differ, begin with the same character and not hold it again")
    text = whole("text")
    drawn = F.array(*draws(F.col("doc_id"), seed))
    rows = with_length(docs, "n", text).withColumn("__h", drawn)
    h = [F.col("__h")[i] for i in range(4)]
    cuts = [h[i] % (F.col("n") + 1) for i in range(2)]
    plain = (F.col("n") == 0) | F.contains(text, F.lit(p)) | F.contains(text, F.lit(s)) | F.contains(text, F.lit(m)) | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < suffix_first, "spm").otherwise("psm")
    rows = rows.withColumns({"form": form, "__a": F.least(*cuts), "__b": F.greatest(*cuts)})
    cut = F.col("form") != "plain"
    rows = rows.withColumns({"prefix_chars": F.when(cut, F.col("__a")), "middle_chars": F.when(cut, F.col("__b") - F.col("__a"))})
    pattern = F.concat(F.lit(r"(?s)\A(.{"), F.col("prefix_chars").cast("string"), F.lit("}+)(.{"), F.col("middle_chars").cast("string"), F.lit(r"}+)(.*+)\z"))
    quoted = [x.replace("\\", "\\\\").replace("$", "\\$") for x in marks]
    order = F.when(F.col("form") == "psm", "{}$1{}$3{}$2".format(*quoted)).otherwise("{1}$3{0}$1{2}$2".format(*quoted))
    out = F.when(cut, F.regexp_replace(text, pattern, order)).otherwise(text)
    return rows.withColumn("output", out).drop("__h", "__a", "__b")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text again, from the output and its form alone."""
    p, s, m = (re.escape(x) for x in marks)
    # An output that is cut holds every marker once, so the first that is met is the only one.
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    rows = transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(restored(F.col("output"), F.col("form")), 256)}
    return rows.withColumns(digests).select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


_SQL = """
with d as (select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
c as (select *, length(text)::bigint as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
f as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
 case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from c),
p as (select *, substr(text, 1, a) as p, substr(text, a + 1, b - a) as m, substr(text, b + 1) as s from f)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
 sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
 sha256(text) as restored_sha256
from p"""

QUERIES = {"op12_fill_in_middle": op12_fill_in_middle}
SQL = {"op12_fill_in_middle": _SQL}
