"""Token counts by rank-synchronous array merging.

Texts are cut into pre-tokens, the distinct pre-tokens of a batch are laid out as one ragged array of
symbols, and in every round each sequence merges all places of its own lowest-ranked pair at once. What
survives is counted and added up per text. The vocabulary file is named by a parameter and read on every
executor from its installed place.

A pre-token over LONG bytes (a text without blanks, say) is merged on its own with linked neighbours: still all places of
the lowest rank at once, but each round touches only those places, not the whole array.

Defined cases: a null text counts as empty and has 0 tokens; the vocabulary's special strings inside a text
are one token each; repeated rows and rows with a null id are counted like any other; an empty table gives an
empty result; all columns of the input are kept, and the counts take their names over clashing ones; a very long text is
cut into pre-tokens CHUNK characters at a time; pairs of equal rank that touch merge from the left, as in the library.
"""

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, whole

#: The byte-level pre-token pattern of this vocabulary's family.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct pre-tokens whose counts a worker remembers before it starts anew.
REMEMBERED = 400_000
#: Bytes of a pre-token that is merged on its own, and that is not remembered.
LONG = 2048
#: Characters that are cut into pre-tokens at a time.
CHUNK = 1 << 20


class Merges:
    """Pair ranks of a byte-level BPE vocabulary as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        visible = _visible_bytes()
        self.first = np.array([vocab[visible[b]] for b in range(256)], np.int64)
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = (left << 32) | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made
        self.none = len(pairs)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, `none` where there is no merge."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Surviving symbols of each piece."""
        long = [i for i, p in enumerate(pieces) if len(p) > LONG]
        if long:
            out = np.zeros(len(pieces), np.int64)
            out[long] = [self.count_long(pieces[i]) for i in long]
            short = [i for i, p in enumerate(pieces) if len(p) <= LONG]
            out[short] = self.count([pieces[i] for i in short])
            return out
        lengths = np.array([len(p) for p in pieces], np.int64)
        out = lengths.copy()
        symbols = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        rank = self.rank_at(symbols, owner, np.arange(len(symbols)))
        while len(symbols) > 1:
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(symbols))))
            live = lowest < self.none
            if not live.all():  # finished sequences leave the arrays
                symbols, owner, rank, lowest = symbols[live], owner[live], rank[live], lowest[live]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == lowest)
            # Of places that touch (a a a), every second one merges, from the left of each run.
            fresh = np.append(True, at[1:] != at[:-1] + 1)
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            out -= np.bincount(owner[at], minlength=len(out))
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            at = at - np.arange(len(at))  # as many symbols before each have gone
            changed = np.concatenate([at, at[at > 0] - 1])
            rank[changed] = self.rank_at(symbols, owner, changed)
        return out

    def count_long(self, piece: bytes) -> int:
        """Surviving symbols of one long piece: rounds by rank over linked places."""
        symbols = self.first[np.frombuffer(piece, np.uint8)]
        n = left = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n)  # place n is the end
        rank = np.append(self.rank(symbols[:-1], symbols[1:]), self.none)
        live, due, ranks = np.ones(n, bool), {}, []

        def put(places: np.ndarray) -> None:
            places = places[rank[places] < self.none]
            places = places[np.argsort(rank[places], kind="stable")]
            for some in np.split(places, np.flatnonzero(np.diff(rank[places])) + 1) if len(places) else ():
                r = int(rank[some[0]])
                if r not in due:
                    due[r] = []
                    heapq.heappush(ranks, r)
                due[r].append(some)

        put(np.arange(n))
        while ranks:
            lowest = heapq.heappop(ranks)
            at = np.unique(np.concatenate(due.pop(lowest)))
            at = at[live[at] & (rank[at] == lowest)]
            if not len(at):
                continue
            fresh = np.append(True, after[at[:-1]] != at[1:])
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            gone = after[at]
            symbols[at] = self.made[lowest]
            live[gone] = False
            after[at] = after[gone]
            before[after[at]] = at
            left -= len(at)
            changed = np.unique(np.concatenate([at, before[at]]))
            changed = changed[(changed >= 0)]
            ends = after[changed] >= n
            rank[changed] = np.where(ends, self.none, self.rank(symbols[changed], symbols[np.minimum(after[changed], n - 1)]))
            put(changed)
        return left

    def rank_at(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each of the places."""
        after = np.minimum(at + 1, len(symbols) - 1)
        return np.where((owner[after] == owner[at]) & (after > at), self.rank(symbols[at], symbols[after]), self.none)


def _visible_bytes() -> list[str]:
    """The printable stand-in of every byte in a byte-level vocabulary: printable Latin-1 stays, the rest follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=2)
def _loaded(path: str) -> Merges:
    return Merges(path)


class Counter:
    """Counts texts with a vocabulary; remembers the counts of pre-tokens seen."""

    def __init__(self, path: str):
        self.merges = _loaded(path)
        self.known: dict[str, int] = {}
        self.long = False  # whether a long pre-token has to be forgotten
        self.cut = regex.compile(PRE_TOKEN)
        self.special = regex.compile("|".join(map(regex.escape, self.merges.specials))) if self.merges.specials else None

    def pieces(self, text: str):
        """Lists of pre-tokens of a text, some at a time, and the number of special strings."""
        for part in self.special.split(text) if self.special else [text]:
            if len(part) <= CHUNK:
                yield self.cut.findall(part)
                continue
            held = []
            for m in self.cut.finditer(part):
                held.append(m[0])
                if len(held) >= CHUNK // 8:
                    yield held
                    held = []
            yield held

    def total(self, pieces: list[str]) -> int:
        known = self.known
        try:
            return sum(map(known.__getitem__, pieces))
        except KeyError:
            pass
        new = [p for p in dict.fromkeys(pieces) if p not in known]
        counts = dict(zip(new, self.merges.count([p.encode() for p in new]).tolist(), strict=True))
        total = sum(counts[p] if p in counts else known[p] for p in pieces)
        known.update((p, c) for p, c in counts.items() if len(p) <= LONG)
        return total

    def learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self.known]
        if new:
            self.long = any(len(p) > LONG for p in new)
            self.known.update(zip(new, self.merges.count([p.encode() for p in new]).tolist(), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        out, held, chars = [], [], 0
        for text in texts:
            if len(self.known) > REMEMBERED:
                self._flush(held, out)
            special = len(self.special.findall(text)) if self.special else 0
            if len(text) > CHUNK:
                self._flush(held, out)
                out.append(special + sum(self.total(p) for p in self.pieces(text)))
                continue
            held.append((special, [p for part in self.pieces(text) for p in part]))
            chars += len(text)
            if chars > CHUNK:
                self._flush(held, out)
                chars = 0
        self._flush(held, out)
        return out

    def _flush(self, held: list, out: list) -> None:
        self.learn(set().union(*(p for _, p in held)))
        known = self.known
        out.extend(special + sum(map(known.__getitem__, p)) for special, p in held)
        held.clear()
        if len(known) > REMEMBERED:
            known.clear()
        for p in [p for p in known if len(p) > LONG] if self.long else ():
            del known[p]
        self.long = False


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit (more tokens than `limit`)."""

    @F.pandas_udf(T.LongType())
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(path)
        for texts in batches:
            yield pd.Series(counter.count(texts.tolist()), dtype="int64")

    return docs.withColumns({"n_bytes": F.octet_length(whole(text)).cast("long"), "n_tokens": tokens(whole(text))}).withColumn(
        "over_limit", F.col("n_tokens") > limit
    )


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, str(public_tokenizers.path("byte_bpe_50k.json"))).drop("text")


QUERIES = {"op1_token_counts": op1_token_counts}
SQL: dict[str, str] = {}
