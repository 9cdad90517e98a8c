import collections
import tempfile

import corpus_pipeline as pipeline
from tableveil.llm.common import stored

from .test_operators import blank_words, components_by_force, hits_by_force, rule_counts


def test_stages_do_what_brute_force_says(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "quality_rules", "near_dedup", "decontaminate", "source_mix"]
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stored(stage(spark, docs, sf), f"t-{name}")
        after = {r["doc_id"] for r in docs.collect()}
        assert after <= set(before) and after
        if name == "language_id":
            # Texts without letters go, and nothing that is labelled with the language it is written in.
            assert {d for d, t in before.items() if not any(c.isalpha() for c in t or "")} == set(before) - after
        if name == "quality_rules":
            failed = {d for d, t in before.items() if (c := rule_counts(t))[0] < 10 or 100 * c[4] > 20 * c[0]}
            assert not failed & after
        if name == "near_dedup":
            assert after == {d for d, _, root in components_by_force(list(before.items())) if d == root}
        if name == "decontaminate":
            assert after == {d for d, _, n, _ in hits_by_force(list(before.items()), bench) if not n}
        if name == "source_mix":
            rows = docs.collect()
            drawn, goal = collections.Counter(), {}
            for r in rows:
                assert r["text"] == before[r["doc_id"]] and 0 < r["taken"] <= r["size"] == len(blank_words(r["text"]))
                drawn[r["source"]] += r["taken"]
                goal[r["source"]] = r["target"]
            # Each source's draws add up to its target, no draw stands twice, and shards are contiguous.
            assert all(abs(drawn[s] - goal[s]) <= 1 for s in goal) and len({(r["doc_id"], r["draw"]) for r in rows}) == len(rows)
            assert docs.columns == [*columns, "size", "source_size", "target", "draw", "shard", "taken"]
        else:
            assert docs.columns == columns
    assert pipeline.run(spark, sf).count() == docs.count()


def tables(spark, docs, schema, bench=(), labels=()):
    path = tempfile.mkdtemp(prefix="spark-")
    spark.createDataFrame(docs, schema).coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(bench), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality long").write.parquet(f"{path}/labels.parquet")
    return path


def test_nulls_repeats_empty_texts_and_clashing_columns(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen"
    other = "a quite different text about other things that has more than ten words in all, of which none repeat"
    long = " ".join(f"w{i}" for i in range(200_000))
    docs = [(1, text, "en", "a", 7), (1, text, "en", "a", 7), (2, text, "en", "b", 8), (3, other, None, None, 9), (None, other + " more", "en", "a", 1), (4, None, None, None, None), (5, "", "en", "a", 1), (6, "12 34 !", "en", "a", 1), (7, text + " and the secret item of the benchmark set", "en", "a", 1), (8, long, "en", "a", 1), (9, "few words", "en", "a", 1)]
    schema = "doc_id long, text string, lang string, source string, shard int"
    rows = pipeline.run(spark, tables(spark, docs, schema, [(1, "the secret item of the benchmark"), (2, None)], [(1, 1), (None, 0), (2, None)])).collect()
    # 1 stands for itself, its copy and 2; a null id stays by itself; 4, 5, 6 have no letters, 9 few words, 7 a benchmark item.
    assert {r["doc_id"] for r in rows} <= {1, 3, None, 8} and {r["doc_id"] for r in rows if r["draw"] == 1} and all(r["shard"] != 7 or r["shard"] < 32 for r in rows)
    assert len([r for r in rows if r["doc_id"] == 1]) <= 2 and all(r["taken"] <= r["size"] for r in rows)
    assert pipeline.run(spark, tables(spark, [], schema)).count() == 0
