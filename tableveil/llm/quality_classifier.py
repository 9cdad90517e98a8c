"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text's terms are hashed character trigrams, words' shapes and marks of repetition (a word as one of the five before
it, a line or a run of three words that the text has already). Their weighted frequencies are projected on the leading
singular vectors of a bounded labelled sample: at most `each` texts per label, none longer than `longest` characters, `characters` in all (parameters
of `fit`). The sample's vectors are broadcast (`rank` numbers each: a few megabytes whatever the input's size); every text takes its exact cosine with all of them, in
blocks, and the `k` nearest vote with their label, weighted by similarity.

Defined cases: null and empty texts have no terms, are equally near to every labelled text and so score the sample's
share of label 1; without labelled rows every text scores 0.5; labels with a null id or quality are left out; rows are
scored one by one, so repeated rows and null ids get their own result; an empty table gives an empty result; extra
columns stay, and results take their names over clashing ones; neighbours that tie with the last of the k vote as well;
the characters of a very long text are read PIECE at a time, cut between words with their neighbours in view, and its
words are marked as a whole, so its terms are those of one reading (but a word of over 2 * PIECE characters is cut).
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LABELS, LONGEST, bounded_sample, fold, pieces, sliced, table, whole

TRIGRAMS, SHAPES = 2048, 128
TERMS = TRIGRAMS + SHAPES
#: Labelled texts per label value that vote, singular vectors, neighbours, and the power of a neighbour's cosine.
EACH, RANK, NEIGHBOURS, POWER = 1500, 64, 25, 4
#: Characters of all labelled texts together.
CHARACTERS = 1 << 26
BLOCK = 2048
#: Cosines that differ by no more than this tie.
TIED = np.float32(1e-6)
#: Characters of a text that are read at once.
PIECE = 1 << 20
BLANK = "\t\n\v\f\r "
_MULT = np.uint64(0x9E3779B97F4A7C15)
#: Weight of the marks of repetition and shape against the trigrams.
SHAPE_WEIGHT = 2.0


def _repeated(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Places whose (owner, value) stands more than once."""
    key = (owner.astype(np.uint64) * _MULT) ^ value
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    return n[back] > 1


def terms(texts: list[str]) -> np.ndarray:
    """Square roots of the relative frequencies of each text's terms, trigrams and shapes each on their own."""
    grams, shapes, lines = np.zeros((len(texts), TRIGRAMS)), np.zeros((len(texts), SHAPES)), np.zeros(len(texts), np.int64)
    owner, parts, sides = [], [], []
    for i, t in enumerate(texts):
        cut = [t] if len(t) <= PIECE else [p for p in pieces(t, PIECE, lambda c: c not in BLANK) if p]
        owner += [i] * len(cut)
        parts += cut
        # A piece is read between the characters beside it; a text stands between line ends.
        sides += zip(["\n", *(p[-1] for p in cut[:-1])], [*(p[0] for p in cut[1:]), "\n"], strict=True)
    of, word, line = [], [], []
    for a, b in sliced(parts):
        whose = np.array(owner[a:b])
        found = _characters(parts[a:b], sides[a:b])
        np.add.at(grams, whose, found.grams)
        np.add.at(shapes, whose, found.shapes)
        # Lines are counted on through a text's pieces.
        before = np.cumsum(found.lines) - found.lines
        first = np.searchsorted(whose, whose)
        of.append(whose[found.part].astype(np.int32))
        word.append(found.words)
        line.append(found.line + (lines[whose] + before - before[first])[found.part])
        np.add.at(lines, whose, found.lines)
    words = _words(shapes, *(np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (of, word, line)))
    shapes /= np.maximum(words, 1)[:, None]
    shapes[:, 35] = np.log2(np.maximum(words, 1)) / 20
    total = np.maximum(grams.sum(axis=1, keepdims=True), 1)
    return np.concatenate([np.sqrt(grams / total), SHAPE_WEIGHT * np.sqrt(shapes)], axis=1).astype(np.float32)


class _Read(NamedTuple):
    """What the characters of some pieces say: per piece counts of trigrams, of shapes of words, and of line ends; per
    word its piece, its hash and the line of the piece on which it stands."""

    grams: np.ndarray
    shapes: np.ndarray
    lines: np.ndarray
    part: np.ndarray
    words: np.ndarray
    line: np.ndarray


def _characters(parts: list[str], sides: list[tuple[str, str]]) -> _Read:
    n = len(parts)
    codes = np.frombuffer("".join(left + p + right for p, (left, right) in zip(parts, sides, strict=True)).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    sizes = np.array([len(p) + 2 for p in parts], np.int64)
    ends = np.cumsum(sizes)
    part = np.repeat(np.arange(n), sizes)
    inside = np.ones(len(codes), bool)
    inside[ends - 1] = inside[ends - sizes] = False
    h = (((codes[:-2] * _MULT) ^ codes[1:-1]) * _MULT ^ codes[2:]) * _MULT
    own = inside[1:-1]  # a trigram belongs to its middle character
    grams = np.bincount(part[1:-1][own] * TRIGRAMS + (h[own] >> np.uint64(53)).astype(np.int64), minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
    blank = ~inside | (codes <= 13) & (codes >= 9) | (codes == 32)
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    length = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1 - starts
    breaks = np.cumsum(inside & (codes == 10))
    upto = breaks[ends - 1]
    lines = np.diff(upto, prepend=0)
    shapes = np.zeros((n, SHAPES))
    if not len(starts):
        return _Read(grams, shapes, lines, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    of = part[starts]
    power = np.cumprod(np.full(int(length.max()) + 1, _MULT))
    at = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(at, length)
    letters = codes[np.repeat(starts, length) + place]
    word = np.add.reduceat(letters * power[place], at)
    alnum = np.add.reduceat(((letters >= 48) & (letters <= 57) | (letters >= 65) & (letters <= 90) | (letters >= 97) & (letters <= 122) | (letters > 127)).astype(np.int64), at)
    shapes += np.bincount(of * SHAPES + np.minimum(length, 24), minlength=n * SHAPES).reshape(n, SHAPES)  # 1 to 24: length
    shapes[:, 25] = np.bincount(of[alnum == 0], minlength=n)
    shapes[:, 26] = np.bincount(of[length - alnum >= 2], minlength=n)
    return _Read(grams, shapes, lines, of, word, breaks[starts] - (upto - lines)[of])


def _words(shapes: np.ndarray, of: np.ndarray, word: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Adds the marks of repetition to the texts' shapes; of, word, line: each word's text, hash and line, in order.
    Returns how many words each text has."""
    n = len(shapes)
    for k in range(1, 6):
        shapes[:, 26 + k] = np.bincount(of[k:][(word[k:] == word[:-k]) & (of[k:] == of[:-k])], minlength=n)
    three = np.zeros(len(word), bool)
    at = np.flatnonzero(of[2:] == of[:-2])
    three[at] = _repeated(of[at], (word[at] * _MULT ^ word[at + 1]) * _MULT ^ word[at + 2])
    first = np.ones(len(word), bool)  # words that begin a line
    first[1:] = (of[1:] != of[:-1]) | (line[1:] != line[:-1])
    for at, hit in ((32, three), (33, first), (34, first & three)):
        shapes[:, at] = np.bincount(of[hit], minlength=n)
    return np.bincount(of, minlength=n)


class Voters:
    """Labelled vectors and the projection that made them."""

    def __init__(self, texts: list[str], labels: list[float], rank: int = RANK):
        self.labels = np.array(labels, np.float32)
        self.vectors = np.zeros((len(texts), 0), np.float32)
        if not texts:
            return
        x = np.concatenate([terms(texts[a:b]) for a, b in sliced(texts)])
        self.weight = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1).astype(np.float32)
        x = x * self.weight
        gram = (x.T @ x).astype(np.float64)
        _, vectors = np.linalg.eigh(gram)
        self.axes = np.ascontiguousarray(vectors[:, ::-1][:, :rank], np.float32)
        self.vectors = self.unit(x @ self.axes)

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def score(self, texts: list[str], k: int = NEIGHBOURS) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        prior = float(self.labels.mean())
        mine = terms(texts)
        empty = np.array([not t for t in texts])
        mine = self.unit((mine * self.weight) @ self.axes)
        k = min(k, len(self.labels))
        out = np.full(len(texts), prior)
        for at in range(0, len(texts), BLOCK):
            near = mine[at : at + BLOCK] @ self.vectors.T
            last = np.partition(near, -k, axis=1)[:, [-k]]
            weight = np.where(near >= last - TIED, np.maximum(near, 0) ** POWER + np.float32(1e-9), 0)
            out[at : at + BLOCK] = weight @ self.labels / weight.sum(axis=1)
        out[empty] = prior
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", each: int = EACH, longest: int = LONGEST, characters: int = CHARACTERS, kinds: int = LABELS) -> Voters:
    """Voters from a sample of the labelled documents, bounded by `each` texts of each of the `kinds` most frequent labels,
    by the `longest` text and by the `characters` of all of them, taken in the order of the texts' hashes."""
    truth = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias("__label"))
    # The sample is drawn from the labels, so that only its few ids travel to the texts, not the texts to the labels.
    chosen = bounded_sample(truth, "__label", F.col("doc_id").cast("string"), each, kinds)
    ids = docs.sparkSession.createDataFrame([(int(r["text"]), float(r["label"])) for r in chosen], "doc_id long, __label double")
    found = docs.select("doc_id", whole(text).alias("__text")).where(F.length("__text") <= longest).join(F.broadcast(ids), "doc_id")
    sample = found.groupBy(F.xxhash64("__text", "__label").alias("h")).agg(F.first("__text").alias("text"), F.first("__label").alias("label"))
    upto = F.sum(F.length("text")).over(Window.orderBy("h").rowsBetween(Window.unboundedPreceding, 0))
    rows = sample.withColumn("upto", upto).where(F.col("upto") <= characters).select("h", "text", "label").collect()
    rows.sort(key=lambda r: r["h"])
    return Voters([r["text"] for r in rows], [float(r["label"]) for r in rows])


def classify(docs: DataFrame, voters: Voters, text: str = "text") -> DataFrame:
    """docs with score and predicted."""
    held = docs.sparkSession.sparkContext.broadcast(voters)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            texts = [t or "" for t in column]
            parts = [held.value.score(texts[a:b]) for a, b in sliced(texts)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn("score", score.asNondeterministic()(F.col(text))).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 3) == 1
    voters = fit(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out))
    return classify(docs.withColumn("held_out", held_out), voters).drop("text")


QUERIES = {"op10_quality_classifier": op10_quality_classifier}
SQL: dict[str, str] = {}
