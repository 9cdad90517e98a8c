"""SimHash components, fill-in-the-middle and hard negatives against brute force, and their defined cases."""

import hashlib
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tableveil.llm import fill_in_middle, hard_negatives, sim_hash

from .test_operators import DOCS, EDGES, LONG, blank_words, low

# 11


def fingerprint_by_force(text, size=4):
    words = blank_words(low(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(max(1, len(words) - size + 1))]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def roots_by_force(codes, bits):
    """Smallest place that links reach, for each place."""
    root = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= bits and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return root


def drifting_codes(seed, n=700):
    """Random fingerprints, chains that drift away bit by bit, and a dense ball."""
    rng = random.Random(seed)
    codes = [rng.getrandbits(64) for _ in range(n // 2)]
    while len(codes) < n:
        codes.append(rng.choice(codes[-40:] if len(codes) % 3 else codes[:20]))
        for _ in range(rng.randrange(1, 6)):
            codes[-1] ^= 1 << rng.randrange(64)
    return list(dict.fromkeys(codes))


@pytest.mark.parametrize("text", [None, "", " \t", "One", "a b c", "A b c D", "a b c d a b c d", LONG, "Ünïcode É 日本 🙂 ok " * 7])
def test_fingerprints_equal_brute_force(text, monkeypatch):
    want = fingerprint_by_force(text)
    assert sim_hash.fingerprint(text) == want
    monkeypatch.setattr(sim_hash, "PIECE", 17)
    assert sim_hash.fingerprint(text) == want


def test_spark_hashes_shingles_alike(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("some words of ünïcode")).alias("h")).first()["h"] % 2**64 == xxhash.xxh64_intdigest("some words of ünïcode".encode(), 42)


@pytest.mark.parametrize("bits", range(16))
def test_segments_miss_no_pair(bits):
    parts = sim_hash.segments(bits)
    assert sum(s.bits for s in parts) == 64 and sum(s.radius + 1 for s in parts) == bits + 1
    assert [s.shift for s in parts] == [sum(p.bits for p in parts[:i]) for i in range(len(parts))]


@pytest.mark.parametrize("bits", [1, 4, 7])
def test_trees_route_every_close_pair_together(bits):
    codes = np.array(drifting_codes(bits), np.uint64).view(np.int64)
    met = set()
    for k, part in enumerate(sim_hash.segments(bits)):
        tree = sim_hash.Tree(codes[::3], part, 4)
        who, shard, lives = tree.routes(codes)
        assert sorted(who[lives]) == list(range(len(codes)))
        for s in range(tree.leaves):
            here, there = set(who[(shard == s) & lives]), set(who[shard == s])
            met |= {(min(a, b), max(a, b)) for a in here for b in there if a != b}
        assert k or tree.leaves > 4
    close = {(j, i) for i in range(len(codes)) for j in range(i) if ((int(codes[i]) ^ int(codes[j])) % 2**64).bit_count() <= bits}
    assert close <= met


@pytest.mark.parametrize("shard,group,bits,outright", [(50, 1 << 14, 4, 1 << 16), (64, 30, 4, 64), (1 << 14, 100, 3, 256), (40, 50, 6, 128)])
def test_links_equal_brute_force(make, monkeypatch, shard, group, bits, outright):
    monkeypatch.setattr(sim_hash, "_OUTRIGHT", outright)
    codes = drifting_codes(shard)
    frame = make([(c - 2**64 if c >> 63 else c, i) for i, c in enumerate(codes)], "code long, node long")
    root = list(range(len(codes)))
    for r in sim_hash.close(frame, bits, shard, group).distinct().collect():
        assert (codes[r["a"]] ^ codes[r["b"]]).bit_count() <= bits
        if root[r["a"]] != root[r["b"]]:
            old, new = max(root[r["a"]], root[r["b"]]), min(root[r["a"]], root[r["b"]])
            root = [new if x == old else x for x in root]
    assert root == roots_by_force(codes, bits)


def test_a_dense_group_returns_few_links():
    rng = np.random.default_rng(1)
    codes = np.unique(np.concatenate([np.uint64(1) << rng.integers(0, 64, 4000, dtype=np.uint64) | np.uint64(1) << rng.integers(0, 64, 4000, dtype=np.uint64), np.zeros(1, np.uint64)]))
    twice = np.concatenate([codes, codes])
    lives = np.arange(len(twice)) < len(codes)
    found = sim_hash.links_between(twice.view(np.int64), lives, sim_hash.segments(4)[0], 4)
    assert len(codes) - 1 <= found.shape[1] < len(twice)


def test_sim_hash_components_equal_brute_force(spark, sf, make):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rng = random.Random(2)
    for i in range(60):  # near copies of a long text
        words = (rows[3][1] or "").split() * 8
        words[rng.randrange(len(words))] = "other"
        rows.append((10_000 + i, " ".join(words)))
    codes = [fingerprint_by_force(t) for _, t in rows]
    root = roots_by_force(codes, 4)
    least = {}
    for (d, _), r in zip(rows, root, strict=True):
        least[r] = min(d, least.get(r, d))
    got = {r["doc_id"]: (r["code"] % 2**64, r["component_id"]) for r in sim_hash.components(make(rows, "doc_id long, text string")).collect()}
    assert got == {d: (c, least[r]) for (d, _), c, r in zip(rows, codes, root, strict=True)}


def test_sim_hash_edge_cases(make):
    rows = [*EDGES, (9, "one text of an id with two", "", ""), (9, LONG, "", ""), (10, "one text of an id with two", "", "")]
    got = sorted(((r["doc_id"], r["code"] % 2**64, r["component_id"]) for r in sim_hash.components(make(rows, DOCS)).collect()), key=str)
    at = {d: (c, r) for d, c, r in got}
    assert len(got) == len(rows) and at[1] == at[2] == at[3] == (0, 1)
    assert at[None][1] is None and at[5][1] == 5 and at[6][1] == at[9][1] == at[10][1] == 6 and at[8][1] == 8
    assert sim_hash.components(make([], DOCS)).count() == 0
    clashing = make([(1, "a b", "x", "y")], "doc_id long, text string, code string, component_id string")
    assert sim_hash.components(clashing).first()["component_id"] == 1


# 12


def cut_by_force(doc_id, text, rate=90, first=20, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in marks) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, s, m = marks
    if h[3] % 100 < first:
        return n, "spm", a, b - a, s + text[b:] + p + text[:a] + m + text[a:b]
    return n, "psm", a, b - a, p + text[:a] + s + text[b:] + m + text[a:b]


@pytest.mark.parametrize("marks", [("<P>", "<S>", "<M>"), ("$1(", "$2\\E", "$[x")])
def test_middles_equal_brute_force(make, marks):
    rng = random.Random(3)
    signs = ["a", " ", "\n", "é", "日", "🙂", "<", "P", ">", "$", "\\", "\r", " ", "0"]
    rows = [(d, t) for d, t, *_ in EDGES] + [(100 + i, "".join(rng.choices(signs, k=rng.randrange(80)))) for i in range(400)]
    rows += [(600, "has <P> inside"), (601, "<S>"), (602, "$2\\E"), (603, "🙂" * 5000), (604, "x\n" * 1_500_000), (605, "y" * 1024), (606, "z" * 1056)]
    out = fill_in_middle.transform(make(rows, "doc_id long, text string"), marks=marks)
    out = out.withColumn("again", fill_in_middle.restored(F.col("output"), F.col("form"), marks))
    got = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["again"]) for r in out.collect()]
    want = [(d, *cut_by_force(d, t, marks=marks), t or "") for d, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {"psm", "spm", "plain"} == {g[2] for g in got}


def test_middle_edge_cases(make):
    rows = make([(1, "abc", "kept", 5)], "doc_id long, text string, lang string, n int")
    out = fill_in_middle.transform(rows, rate=100, suffix_first=0)
    assert out.columns == ["doc_id", "text", "lang", "n", "form", "prefix_chars", "middle_chars", "output"] and out.first()["n"] == 3 and out.first()["form"] == "psm"
    assert fill_in_middle.transform(make([], "doc_id long, text string")).count() == 0
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aba", "<S>", "<M>"), ("<P>", "[S]", "<M>")):
        with pytest.raises(ValueError):
            fill_in_middle.transform(rows, marks=bad)


# 13

VECTORS = "vec_id long, embedding array<float>, label int"


def mined_by_force(rows, bounds=(30, 90)):
    held = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, lab in rows if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, lab, v in held:
        if i % 100:
            continue
        scored = sorted(((-sum(map(int.__mul__, v, w)), j, other) for j, other, w in held if j != i and len(w) == len(v)))
        for s, p, _ in [x for x in scored if x[2] == lab][:5]:
            near = [(j, -t) for t, j, other in scored if other != lab and bounds[0] * -s <= 100 * -t <= bounds[1] * -s][:10]
            out += [(i, p, k, j, -s, t) for k, (j, t) in enumerate(near, 1)]
    return sorted(out)


def some_vectors(seed, n=400, dims=20):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(4)]
    rows = [(i, [round(c + rng.gauss(0, 0.2), 2) for c in rng.choice(centres)], rng.randrange(4)) for i in range(n)]
    # Ties: the same vector under many ids.
    return rows + [(n + i, rows[5][1], i % 3) for i in range(40)]


@pytest.mark.parametrize("chunk,block", [(4096, 512), (37, 2)])
def test_hard_negatives_equal_brute_force(make, chunk, block):
    nan, inf = float("nan"), float("inf")
    rows = some_vectors(4) + [(1000, None, 1), (1001, [0.1] * 20, None), (1002, [nan] + [0.1] * 19, 1), (1003, [inf] * 20, 1), (1004, [None] + [0.1] * 19, 1), (None, [0.5] * 20, 1)]
    rows += [(-100, [0.25] * 20, 3), (-101, [-0.25] * 20, 3), (2000, [], 1), (2001, [], 1), (2002, [], 2), (2003, [0.5] * 7, 2), (2100, [0.5] * 7, 1), (2101, [0.4] * 7, 1), (2102, [900.5] * 7, 1)]
    got = sorted(tuple(r) for r in hard_negatives.mined(make(rows, VECTORS), chunk=chunk, block=block).collect())
    assert got == mined_by_force(rows) and {-100, 2000, 2100} <= {r[0] for r in got}


def test_repeated_rows_and_empty_tables_have_results(make):
    rows = some_vectors(5, 150, 8)
    got = hard_negatives.mined(make([*rows, *rows], VECTORS)).collect()
    best = max((sum(math.floor(256 * float(np.float32(x))) * math.floor(256 * float(np.float32(y))) for x, y in zip(rows[100][1], v, strict=True)) for i, v, lab in rows if i != 100 and ((lab + 1) % 10 if i % 7 == 0 else lab) == rows[100][2]), default=None)
    assert {r["anchor_id"] for r in got} <= {0, 100} and max(r["positive_score"] for r in got if r["anchor_id"] == 100) == best
    assert hard_negatives.mined(make([], VECTORS)).count() == 0
    extra = make([(i, [0.5, float(i)], i % 2, "x", "y") for i in range(101)], VECTORS + ", row string, anchor string")
    assert {r["anchor_id"] for r in hard_negatives.mined(extra).collect()} <= {0, 100}


@pytest.mark.parametrize("scale,dims", [(1, 64), (3000, 64), (10**6, 3), (100, 1), (5, 1000)])
def test_table_scores_are_inner_products(scale, dims):
    rng = np.random.default_rng(dims)
    anchors, rows = (rng.integers(-scale, scale + 1, (n, dims)) for n in (9, 300))
    packed = hard_negatives.planes(rows, hard_negatives.width(rows))
    assert (hard_negatives.Tables(anchors).scores(packed) == rows @ anchors.T).all()


def test_huge_components_are_held():
    held = hard_negatives.quantized(np.array([[3e38, -3e38, 1.0]]))
    assert held[0, 2] == 256 and int(held[0, 0]) * int(held[0, 0]) * 3 <= 2**62 and (hard_negatives.Tables(held).scores(hard_negatives.planes(held, hard_negatives.width(held))) == held @ held.T).all()

