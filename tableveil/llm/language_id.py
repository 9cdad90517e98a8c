"""Language identification by a linear-chain conditional random field over words.

Each word of a text is labelled with a language. A word's features are its affixes and inner n-grams (hashed, with
word boundaries as characters) and an entry in a lexicon of frequent words; transitions between neighbouring labels
are learned as well, from sequences in which pieces of several languages follow one another. Forward-backward gives
every word's posterior, and a text's language is the one with the largest mean posterior, which is its score. The words'
own labels are returned as spans of one language each, which is what code-switched texts are read for.

The model is fitted on a bounded sample of labelled texts (`each` per language, none longer than `longest` characters, of
the `languages` most frequent languages: parameters of `fit`) and is a few megabytes whatever the input's size; every text
is labelled whole, as one chain. A very long text is read in parts of about SEQUENCE characters, cut between words: what a
part makes of any label before it is one small matrix, the matrices' products are the messages that the chain sends
over each cut from either side, and with these each part's posteriors are those of the whole chain. So memory and the number
of steps stay bounded (a run of over 2 * SEQUENCE letters is cut in itself).

Defined cases: null texts, empty texts and texts without letters give `und` with score 0; without labelled rows every
text gives `und`, and `reject` drops only texts without letters; of languages that tie the first by name is taken; rows are
judged one by one, so repeated rows and null ids get their own result; an empty table gives an empty result; extra columns
stay, and results take their names over clashing ones.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LABELS, LONGEST, bounded_sample, fold, pieces, sliced, table

BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
#: Characters of one part of a text, and of the texts that are labelled at once (fewer if there are many languages).
SEQUENCE, SLICE = 1 << 14, 1 << 20
#: Labelled texts that the model is fitted on, per language.
SAMPLE = 120
ROUNDS = 30
#: Share of a language's sample texts in which a word must stand to enter the lexicon.
LEXICON_SHARE = 0.05
_MULT = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


class Words:
    """The words (runs of letters) of some texts as flat arrays."""

    def __init__(self, texts: list[str]):
        codes = np.frombuffer(("\n" + "\n".join(t.lower() for t in texts) + "\n").encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[codes]
        codes = np.where(letter, codes, 0).astype(np.uint64)
        self.codes, self.starts = codes, np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
        lengths = np.array([len(t.lower()) for t in texts])
        begins = np.concatenate([[1], 1 + np.cumsum(lengths + 1)])
        self.doc_at = np.searchsorted(self.starts, begins)  # first word of each text, and the end
        self.size = len(self.starts)

    def segments(self) -> np.ndarray:
        """Where each word's n-grams begin: one place before the word."""
        return self.starts - 1

    def features(self, order: int) -> np.ndarray:
        """Hashed n-gram that starts at each place; BUCKETS where there is none inside a word with its two boundaries."""
        c, n = self.codes, len(self.codes) - order + 1
        h = np.full(n, order, np.uint64)
        inner = np.ones(n, bool)
        for k in range(order):
            h = (h ^ c[k : n + k]) * _MULT
            if 0 < k < order - 1:
                inner &= c[k : n + k] > 0
        if order == 2:
            inner = (c[:n] > 0) | (c[1 : n + 1] > 0)
        out = np.full(len(c), BUCKETS, np.int32)
        out[:n] = np.where(inner, (h >> np.uint64(48)).astype(np.int32), BUCKETS)
        return out

    def hashes(self) -> np.ndarray:
        """A hash of each word."""
        if not self.size:
            return np.zeros(0, np.uint64)
        owner = np.cumsum(np.bincount(self.starts, minlength=len(self.codes))) - 1
        place = np.arange(len(self.codes)) - self.starts[np.maximum(owner, 0)]
        power = np.cumprod(np.full(int(place.max()) + 2, _MULT))
        return np.add.reduceat(self.codes * power[np.maximum(place, 0)], self.starts)


class Model:
    def __init__(self, labels: list[str], lexicon: np.ndarray):
        n = len(labels)
        self.labels, self.lexicon = labels, lexicon
        self.grams = np.zeros((BUCKETS + 1, n), np.float32)
        self.entries = np.zeros((len(lexicon) + 1, n), np.float32)
        self.moves = np.zeros((n, n), np.float32)

    def looked_up(self, words: Words) -> np.ndarray:
        h = words.hashes()
        if not len(self.lexicon):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, h), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == h, at, len(self.lexicon))

    def emissions(self, words: Words, features: list[np.ndarray] | None = None, entries: np.ndarray | None = None) -> np.ndarray:
        """Log potential of every word and label."""
        if not words.size:
            return np.zeros((0, len(self.labels)), np.float32)
        total = sum(self.grams[f] for f in features or (words.features(n) for n in ORDERS))
        found = np.add.reduceat(total, words.segments(), axis=0)
        return found + self.entries[self.looked_up(words) if entries is None else entries]

    def potentials(self, emissions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' and the moves' potentials, each divided by its largest."""
        return np.exp(emissions - emissions.max(axis=1, keepdims=True)), np.exp(self.moves - self.moves.max())

    def passages(self, emissions: np.ndarray, starts: np.ndarray, lengths: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """For each sequence the weight (up to a factor) of all paths from a label before it to a label of its last word;
        a sequence at the `heads` of a chain has none before it, so there it is a label of its first word."""
        e, move = self.potentials(emissions)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths, heads, n = starts[order], lengths[order], heads[order], len(move)
        most = int(lengths[0]) if len(lengths) else 0
        live = np.searchsorted(-lengths, -np.arange(most), side="left")
        out = np.where(heads[:, None, None], np.eye(len(move), dtype=np.float32), move)
        for t in range(most):
            k = live[t]
            m = (out[:k].reshape(-1, n) @ move).reshape(-1, n, n) if t else out[:k]
            m = m * e[starts[:k] + t][:, None, :]
            out[:k] = m / m.reshape(-1, n * n).max(axis=1)[:, None, None]
        back = np.empty_like(out)
        back[order] = out
        return back

    def posteriors(self, emissions: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pairs: bool = False, before: np.ndarray | None = None, after: np.ndarray | None = None):
        """Forward-backward over all sequences at once, longest first; with pairs also the expected moves. before and
        after: the messages to each sequence's first and last word from the rest of its chain."""
        n = len(self.labels)
        e, move = self.potentials(emissions)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        most = int(lengths[0]) if len(lengths) else 0
        live = np.searchsorted(-lengths, -np.arange(most), side="left")  # sequences longer than t
        alpha = np.empty_like(e)
        a = np.full((len(lengths), n), 1.0 / n, np.float32) if before is None else before[order]
        last = np.ones((len(lengths), n), np.float32) if after is None else after[order]
        for t in range(most):
            at = starts[: live[t]] + t
            a = (a[: live[t]] @ move if t else a[: live[t]]) * e[at]
            a /= a.sum(axis=1, keepdims=True)
            alpha[at] = a
        gamma = np.empty_like(e)
        expected = np.zeros((n, n))
        b = np.zeros((0, n), np.float32)
        for t in range(most - 1, -1, -1):
            k = live[t]
            at = starts[:k] + t
            grown = last[:k].copy()
            if len(b):
                pull = e[at[: len(b)] + 1] * b
                grown[: len(b)] = pull @ move.T
                if pairs:
                    joint = alpha[at[: len(b)]][:, :, None] * move[None] * pull[:, None, :]
                    expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            grown /= grown.sum(axis=1, keepdims=True)
            g = alpha[at] * grown
            gamma[at] = g / g.sum(axis=1, keepdims=True)
            b = grown
        return (gamma, expected) if pairs else gamma

    def batches(self, parts: list[str], which) -> Iterator[tuple[np.ndarray, "Words", np.ndarray, np.ndarray]]:
        """Some of the parts at a time, longest first, as parts of like length share their steps: those that have words,
        their words, and where these begin and how many they are."""
        order = sorted(which, key=lambda k: -len(parts[k]))
        for a, b in sliced([parts[k] for k in order], max(SEQUENCE, 4 * SLICE // max(4, len(self.labels)))):
            words = Words([parts[k] for k in order[a:b]])
            counts = np.diff(words.doc_at)
            has = np.flatnonzero(counts)
            if len(has):
                yield np.array(order[a:b])[has], words, words.doc_at[has], counts[has]

    def messages(self, parts: list[str], whose: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the words before and after each part of a text say of its first and its last word."""
        n = len(self.labels)
        before, after = np.full((len(parts), n), 1.0 / n, np.float32), np.ones((len(parts), n), np.float32)
        same = whose[1:] == whose[:-1]
        cut = np.flatnonzero(np.append(same, False) | np.append(False, same))
        cut = [k for k in cut.tolist() if any(map(str.isalpha, parts[k]))]  # parts without words say nothing
        of = whose[cut]
        head, tail = np.ones(len(cut), bool), np.ones(len(cut), bool)
        head[1:] = tail[:-1] = of[1:] != of[:-1]
        heads = np.zeros(len(parts), bool)
        heads[cut] = head
        through: dict[int, np.ndarray] = {}
        for some, words, starts, counts in self.batches(parts, cut):
            through.update(zip(some.tolist(), self.passages(self.emissions(words), starts, counts, heads[some]), strict=True))
        move = self.potentials(np.zeros((1, n), np.float32))[1]
        unit = lambda x: x / x.sum()
        said = before[0] if parts else None
        for k, first in zip(cut, head, strict=True):
            if not first:
                before[k] = unit(said @ move)
            said = unit((before[k] if first else said) @ through[k])
        for k, final in zip(cut[::-1], tail[::-1], strict=True):
            if not final:
                after[k] = said
            said = unit(through[k] @ after[k])
        return before, after

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, list[list[tuple[int, int, int]]]]:
        """Each text's language and score, and its spans: (first word, words, label) of neighbours of one language."""
        owner, parts = [], []
        for i, t in enumerate(texts):
            cut = [t] if len(t) <= SEQUENCE else pieces(t, SEQUENCE, str.isalpha)
            owner += [i] * len(cut)
            parts += cut
        names, scores, spans = np.full(len(texts), "und", object), np.zeros(len(texts)), [[] for _ in texts]
        if not self.labels:
            return names.tolist(), scores, spans
        n, whose = len(self.labels), np.array(owner, np.int64)
        before, after = self.messages(parts, whose)
        sums, seen = np.zeros((len(texts), n)), np.zeros(len(texts), np.int64)
        labels: list = [None] * len(parts)
        for some, words, starts, counts in self.batches(parts, range(len(parts))):
            gamma = self.posteriors(self.emissions(words), starts, counts, before=before[some], after=after[some])
            np.add.at(sums, whose[some], np.add.reduceat(gamma.astype(np.float64), starts, axis=0))
            np.add.at(seen, whose[some], counts)
            best = gamma.argmax(axis=1).astype(np.int16)
            for k, at, size in zip(some, starts, counts, strict=True):
                labels[k] = best[at : at + size]
        known = np.flatnonzero(seen)
        mean = sums[known] / seen[known, None]
        names[known] = np.array(self.labels, object)[mean.argmax(axis=1)]
        scores[known] = np.clip(mean.max(axis=1), 0, 1)
        by_text: dict[int, list] = {}
        for i, found in zip(owner, labels, strict=True):
            if found is not None:
                by_text.setdefault(i, []).append(found)
        for i, found in by_text.items():
            path = np.concatenate(found)
            first = np.flatnonzero(np.append(True, path[1:] != path[:-1]))
            spans[i] = list(zip(first.tolist(), np.diff(np.append(first, len(path))).tolist(), path[first].tolist(), strict=True))
        return names.tolist(), scores, spans


def _mixed(words: Words, language: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training sequences: pieces of 10 to 60 words in random order, six to a sequence, so that languages alternate."""
    pieces = []
    for d in range(len(language)):
        at, end = words.doc_at[d], words.doc_at[d + 1]
        while at < end:
            to = min(end, at + int(rng.integers(10, 60)))
            pieces.append((at, to, language[d]))
            at = to
    rng.shuffle(pieces)
    pieces = [(int(a), int(b), int(y)) for a, b, y in pieces]
    order = np.concatenate([np.arange(a, b) for a, b, _ in pieces])
    truth = np.concatenate([np.full(b - a, y) for a, b, y in pieces])
    sizes = np.array([b - a for a, b, _ in pieces])
    return order, truth, np.add.reduceat(sizes, np.arange(0, len(sizes), 6))


def train(sample: list, rounds: int = ROUNDS) -> Model:
    """Fits the weights to labelled texts by Adam on the sequences' likelihood."""
    labels = sorted({r["label"] for r in sample})
    if not labels:
        return Model([], np.zeros(0, np.uint64))
    language = np.array([labels.index(r["label"]) for r in sample])
    words = Words([r["text"] for r in sample])
    hashes, doc = words.hashes(), np.repeat(np.arange(len(sample)), np.diff(words.doc_at))
    seen: set[int] = set()
    for y in range(len(labels)):
        mine = np.unique(np.stack([doc.astype(np.uint64), hashes])[:, language[doc] == y], axis=1)[1]
        value, n = np.unique(mine, return_counts=True)
        seen.update(value[n >= max(2, LEXICON_SHARE * (language == y).sum())].tolist())
    model = Model(labels, np.array(sorted(seen), np.uint64))
    if not words.size:
        return model
    order, truth, lengths = _mixed(words, language, np.random.default_rng(7))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    features, entries = [words.features(n) for n in ORDERS], model.looked_up(words)
    owner = np.maximum(np.cumsum(np.bincount(words.segments(), minlength=len(words.codes))) - 1, 0)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    hot = np.eye(len(labels))[truth]
    same = np.ones(len(truth), bool)
    same[starts] = False
    moved = np.zeros((len(labels), len(labels)))
    np.add.at(moved, (truth[:-1][same[1:]], truth[1:][same[1:]]), 1)
    params = [model.grams, model.entries, model.moves]
    first, second = [np.zeros_like(p, np.float64) for p in params], [np.zeros_like(p, np.float64) for p in params]
    for r in range(1, rounds + 1):
        gamma, expected = model.posteriors(model.emissions(words, features, entries)[order], starts, lengths, pairs=True)
        off = (hot - gamma)[back]
        grads = [np.zeros(p.shape) for p in params]
        for y in range(len(labels)):
            spread = off[owner, y]
            for f in features:
                grads[0][:, y] += np.bincount(f, spread, BUCKETS + 1)
            grads[1][:, y] = np.bincount(entries, off[:, y], len(model.lexicon) + 1)
        grads[2] = moved - expected
        grads[0][BUCKETS] = grads[1][-1] = 0
        for p, g, m, v, rate in zip(params, grads, first, second, (0.05, 0.05, 0.3), strict=True):
            g = g / len(truth) - 1e-6 * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += (rate * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-9)).astype(np.float32)
    return model


def fit(docs: DataFrame, label: str = "lang", text: str = "text", each: int = SAMPLE, languages: int = LABELS, longest: int = LONGEST) -> Model:
    return train(bounded_sample(docs, label, text, each, languages, longest))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred, score and n_spans, the number of runs of words of one language."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, n_spans long")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in batches:
            texts = [t or "" for t in column]
            order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))  # texts of like length share their steps
            out = pd.DataFrame({"lang_pred": "und", "score": 0.0, "n_spans": 0}, index=range(len(texts)))
            for a, b in sliced([texts[i] for i in order], SLICE):
                names, scores, spans = held.value.predict([texts[i] for i in order[a:b]])
                out.iloc[order[a:b]] = pd.DataFrame({"lang_pred": names, "score": scores, "n_spans": [len(x) for x in spans]})
            yield out

    docs = docs.withColumn("__found", predict.asNondeterministic()(F.col(text)))
    return docs.withColumns({c: F.col(f"__found.{c}") for c in ("lang_pred", "score", "n_spans")}).drop("__found")


def code_switches(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with spans: the text's words (runs of letters, counted from 0) as runs of one language, in order."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<first: long, words: long, lang: string>>")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            texts = [t or "" for t in column]
            found = [held.value.predict(texts[a:b])[2] for a, b in sliced(texts)]
            yield pd.Series([[{"first": f, "words": n, "lang": held.value.labels[y]} for f, n, y in x] for spans in found for x in spans], dtype=object)

    return docs.withColumn("spans", label.asNondeterministic()(F.col(text)))


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    model = fit(docs.where(~held_out))
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def reject(docs: DataFrame, least: float = 0.5, sure: float = 0.8) -> DataFrame:
    """The rows of docs whose language is found with at least the score `least`.

    A row whose own label names another language goes only if the score is at least `sure`. Without labelled rows
    there is no model that could doubt a text: then only texts without letters go.
    """
    rows = docs.select(F.struct("*").alias("__row"), "doc_id", "lang", "text")
    model = fit(rows.where(fold("doc_id", 5) != 0))
    if not model.labels:
        return rows.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).select("__row.*")
    found = identify(rows, model)
    agrees = F.col("lang").isNull() | (F.col("lang") == F.col("lang_pred")) | (F.col("score") < sure)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= least) & agrees).select("__row.*")


QUERIES = {"op3_language_id": op3_language_id}
SQL: dict[str, str] = {}
