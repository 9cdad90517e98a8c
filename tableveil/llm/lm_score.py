"""Language-model scores by prediction by partial matching (PPM), with a smoothed unigram score as the base.

A text is spelled as bytes: its lower-cased words, each closed by one blank, and one more blank for the end token. The
model is a byte-context trie of orders 0 to ORDER over all training texts; contexts run across word ends, and a text
begins after blanks. A byte is looked up from the longest context down. In a context with N training events of V kinds,
a symbol seen c times has the probability (c - 1/2) / N, and V / 2N is the escape to the next shorter context (method D);
symbols that a longer context has seen are excluded from the shorter ones, counts and kinds. Below order 0 all bytes left
are equally likely. On top stands an adaptive order: a context of OWN bytes that the text itself had before predicts by
the same rule, with its escape blended into the trie's probability.
The score is the sum of the bytes' log10 probabilities, a proper distribution over texts.

The trie is never in one place. All orders above LOW of a context share its last three bytes, so a hash of these deals
the trie into buckets, and each bucket is scored on its own; only contexts of at most LOW = 2 bytes, at most 2**24
counts at any size of the corpus, are broadcast. In steps:

1. Texts are cut into blocks of about BLOCK bytes of one input split. A block sends each bucket one row: its distinct
   words, or its distinct byte strings of ORDER + 1, with their counts in training texts.
2. Rows meet by bucket and salt (a group of blocks), then the sums by bucket: a frequent word or context is one entry
   per block, then one per salt, and no group holds more than its bucket of BLOCKS_PER_SALT blocks.
3. Each (bucket, salt) meets its bucket's sums, and every block gets back one number per word and byte string it asked
   for: a count, or a log-probability.
4. Each block's texts meet its answers and add up.

Defined cases: a null or empty text is its end token alone; a null id has the fold of the empty text (trained on);
repeated rows count and are scored each; ties do not arise, as nothing is ranked; a very long text is a block of its own
and is read PIECE bytes at a time, with what its own contexts were followed by carried on, so its score is that of one
reading; without training texts all counts are 0 and all bytes are equally likely; an empty
table gives an empty result; extra columns are left out, so clashing names do no harm. The input must be read from files
(see `stored`).
"""

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, pairwise
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import LOWER, UPPER, fold, stored, table

#: Bytes of the longest context of the trie (at most 6), of the longest one that is broadcast, and of the text's own.
ORDER, LOW, OWN = 5, 2, 12
BLOCK = 16 << 20
#: Bytes of text that are spelled at once.
PIECE = 1 << 18
#: Byte strings that a block holds before it adds them up.
HELD = 1 << 21
#: Bytes of text per bucket, the least number of buckets, and blocks that meet in one group of a bucket.
BUCKET, LEAST_BUCKETS, BLOCKS_PER_SALT = 64 << 20, 64, 1024
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
_MULT = np.uint64(0x9E3779B97F4A7C15)
_ROWS = "bucket long, keys binary, n binary, total long, kinds long"


def runs(text: bytes | None) -> Iterator[list[bytes]]:
    """The text's words, those of about PIECE bytes at a time; bytes split at exactly the blanks 09-0D and 20."""
    text, at = (text or b"").translate(_LOWERED), 0
    while len(text) - at > PIECE:
        cut = len(text[at : at + PIECE].rsplit(None, 1)[0]) if len(text[at : at + PIECE].split(None, 1)) > 1 else 0
        if not cut:  # one word is longer than a piece
            rest = text[at:].split(None, 1)
            cut = len(text) - at - (len(rest[1]) if len(rest) > 1 else 0)
        yield text[at : at + cut].split()
        at += cut
    yield text[at:].split()


def spelled(text: bytes | None) -> Iterator[bytes]:
    """The text's bytes in pieces, each after the OWN bytes that stand before it."""
    held = b" " * OWN
    for words in runs(text):
        held += b"".join(w + b" " for w in words)
        while len(held) - OWN > PIECE:
            yield held[: OWN + PIECE]
            held = held[PIECE:]
    yield held + b" "


def together(texts: Iterable[bytes | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Pieces of the texts, and whose they are, about PIECE bytes at a time."""
    owner, held, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in spelled(text):
            if held and size + len(piece) > PIECE:
                yield owner, held
                owner, held, size = [], [], 0
            owner.append(i)
            held.append(piece)
            size += len(piece)
    if held:
        yield owner, held


def grams(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the pieces: the ORDER bytes before it and itself as one number, and a hash of the OWN bytes before it."""
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    lengths = np.array([len(p) for p in pieces], np.int64)
    inside = np.ones(len(flat), bool)
    inside[((np.cumsum(lengths) - lengths)[:, None] + np.arange(OWN)).ravel()] = False
    six = np.zeros(len(flat) - ORDER, np.int64)
    for j in range(ORDER + 1):
        six <<= 8
        six |= flat[j : len(flat) - ORDER + j]
    inside = inside[OWN:]
    here = six[OWN - ORDER :][inside]
    # Two numbers of six bytes are the twelve bytes before the place.
    near, far = six[OWN - ORDER - 1 : -1].view(np.uint64), six[OWN - 2 * ORDER - 2 : -ORDER - 2].view(np.uint64)
    context = (near * _MULT ^ far) * _MULT
    return here, (context ^ context >> np.uint64(29))[inside]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their sums."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(keys) else counts


def found(keys: np.ndarray, asked: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values of the asked keys, 0 where there is none; keys are in order."""
    if not len(keys):
        return np.zeros(len(asked), values.dtype)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0)


class Order:
    """One order of the trie: contexts of k bytes, what follows them, and what the next longer order excludes in them."""

    def __init__(self, k: int, grams: np.ndarray, n: np.ndarray):
        """grams: distinct strings that end in a context of at least k bytes and a symbol; n: their counts."""
        self.k, self.mask = k, (1 << 8 * (k + 1)) - 1
        self.keys, self.n = summed(grams & self.mask, n)
        ids = self.keys >> 8
        self.starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, np.int64)
        self.ids = ids[self.starts]
        self.total, self.kinds = self.over(self.n), np.diff(np.append(self.starts, len(ids)))

    def over(self, values: np.ndarray) -> np.ndarray:
        """Sums over each context's symbols."""
        return np.add.reduceat(values, self.starts) if len(self.starts) else values[:0]

    def shorten(self, shorter: "Order") -> None:
        """Notes how many events of the shorter context this one's symbols are."""
        self.gone = self.over(found(shorter.keys, self.keys & shorter.mask, shorter.n))


def orders(grams: np.ndarray, n: np.ndarray, longest: int, shortest: int, below: "list[Order]") -> list[Order]:
    """Orders from the longest to the shortest, over those below."""
    out = [Order(k, grams, n) for k in range(longest, shortest - 1, -1)] + below
    for longer, shorter in zip(out, out[1:], strict=False):
        longer.shorten(shorter)
    return out


def log10(trie: list[Order], grams: np.ndarray) -> np.ndarray:
    """log10 of each gram's symbol after its context, from the longest order on, with exclusion."""
    zero = np.zeros(len(grams), np.int64)
    p, left, seen = np.zeros(len(grams)), np.ones(len(grams)), np.zeros(len(grams), bool)
    gone, gone_kinds = zero, zero
    for order in trie:
        at = found(order.ids, (grams & order.mask) >> 8, np.arange(1, len(order.ids) + 1))  # 0: never seen
        value = lambda x: np.append(0, x)[at]  # noqa: B023, E731
        n, kinds = found(order.keys, grams & order.mask, order.n), value(order.kinds)
        events = np.maximum(value(order.total) - gone, 1)
        hit = ~seen & (n > 0)
        p[hit] = (left * (n - 0.5) / events)[hit]
        seen |= hit
        left = np.where(kinds > gone_kinds, left * (kinds - gone_kinds) / 2 / events, left)
        gone, gone_kinds = value(order.gone) if order.k else zero, kinds
    return np.log10(np.where(seen, p, left / np.maximum(256 - gone_kinds, 1)))


class Sums:
    """Sums by key in sorted runs, each at least twice as long as the next, so n additions cost about n log n in all."""

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        run = summed(keys, values)
        while self.runs and len(self.runs[-1][0]) < 2 * len(run[0]):
            run = summed(*(np.concatenate(x) for x in zip(self.runs.pop(), run, strict=True)))
        self.runs.append(run)

    def of(self, asked: np.ndarray) -> np.ndarray:
        return sum((found(keys, asked, values).astype(np.int64) for keys, values in self.runs), np.zeros(len(asked), np.int64))


class Heard:
    """What followed the long contexts of one text in the pieces read so far: 28 bytes or less per byte of the text."""

    def __init__(self):
        self.contexts, self.pairs = Sums(), Sums()

    @staticmethod
    def pair(contexts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        mixed = (contexts + symbols.astype(np.uint64) + np.uint64(1)) * _MULT
        return mixed ^ mixed >> np.uint64(31)

    def add(self, contexts: np.ndarray, symbols: np.ndarray) -> None:
        pairs, at, n = np.unique(self.pair(contexts, symbols), return_index=True, return_counts=True)
        fresh = contexts[at][self.pairs.of(pairs) == 0]
        # Events stand above the low 32 bits of a context's value, kinds in them.
        self.contexts.add(np.append(contexts, fresh), np.append(np.full(len(contexts), 1 << 32), np.ones(len(fresh), np.int64)))
        self.pairs.add(pairs, n.astype(np.int32))

    def of(self, contexts: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Events and kinds of the contexts, and how often each symbol followed."""
        both = self.contexts.of(contexts)
        return both >> 32, both & 0xFFFFFFFF, self.pairs.of(self.pair(contexts, symbols))


def adapt(p: np.ndarray, symbols: np.ndarray, contexts: np.ndarray, heard: Heard | None = None, going_on: int = 0) -> np.ndarray:
    """Probabilities after the texts' own long contexts have been heard; places of a text are in order.

    contexts differ between texts. The first `going_on` places go on with the text whose earlier pieces are in `heard`.
    """
    # Most contexts stand once: a table of their hashes' last bits tells which may stand again.
    low = (contexts >> np.uint64(43)).astype(np.int64)
    may = np.bincount(low, minlength=1 << 21)[low] > 1
    if heard:
        may[:going_on] = True
    again = np.flatnonzero(may)
    order = again[np.argsort(contexts[again], kind="stable")]
    c, s = contexts[order], symbols[order]
    old_events, old_kinds, old_count = (np.zeros(len(order), np.int64) for _ in range(3))
    if heard:
        on = order < going_on
        old_events[on], old_kinds[on], old_count[on] = heard.of(c[on], s[on])
    place = np.arange(len(order))
    first = np.maximum.accumulate(np.where(np.append(True, c[1:] != c[:-1]), place, 0)) if len(order) else place
    events = place - first + old_events
    # The same within (context, symbol): counts of the symbol before, and which symbols were new.
    pair = np.lexsort((place, s, c))
    fresh = np.append(True, (c[pair][1:] != c[pair][:-1]) | (s[pair][1:] != s[pair][:-1])) if len(order) else np.zeros(0, bool)
    count = np.empty(len(order), np.int64)
    count[pair] = np.arange(len(order)) - np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    count += old_count
    new = np.cumsum(count == 0) - (count == 0)
    kinds = old_kinds + new - new[first] if len(order) else new
    known = events > 0
    out = p.copy()
    at = order[known]
    out[at] = (np.maximum(count[known] - 0.5, 0) + 0.5 * kinds[known] * p[at]) / events[known]
    return out


def scored(texts: Iterable[bytes | None], n: int, trie: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """log10 of each of n texts; trie: the probabilities that the trie gives to byte strings of ORDER + 1."""
    score, heard, going_on = np.zeros(n), None, -1
    for (owner, pieces), (coming, _) in pairwise(chain(together(texts), [([-1], [])])):
        here, contexts = grams(pieces)
        sizes = [len(x) - OWN for x in pieces]
        whose = np.repeat(np.array(owner), sizes)
        contexts ^= (whose.astype(np.uint64) + np.uint64(1)) * _MULT
        if owner[0] != going_on:
            heard = None
        score += np.bincount(whose, np.log10(adapt(trie(here), here & 255, contexts, heard, sizes[0])), n)
        going_on = coming[0]
        if going_on == owner[-1]:  # the last text has a further piece
            if heard is None or len(owner) > 1:
                heard = Heard()
            heard.add(contexts[-sizes[-1] :], here[-sizes[-1] :] & 255)
    return score


def packed(x: np.ndarray | list[bytes]) -> bytes:
    """Numbers, or words joined by blanks, compressed."""
    return zstandard.compress(b" ".join(x) if isinstance(x, list) else x.tobytes(), 1)


def _words(x: bytes) -> list[bytes]:
    return zstandard.decompress(x).split(b" ")


def _numbers(x: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), kind)


def _table(rows: list[tuple], names: str) -> pa.Table:
    """rows under "name kind, ..."; kinds: long, double, boolean, binary."""
    kinds = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split() for f in names.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _blocks(docs: DataFrame) -> DataFrame:
    """docs as (block, doc_id, held_out, text): runs of about BLOCK bytes of one input split, the same on every read."""
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, size = None, 0
        for batch in batches:
            text = batch.column("text").cast(pa.binary())
            sizes = np.diff(np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, text.offset * 4)) if len(text) else []
            blocks = []
            for path, start, n in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), sizes, strict=True):
                if (path, start) != split:
                    split, size = (path, start), 0
                blocks.append(xxh3_64_intdigest(f"{path}|{start}|{size // BLOCK}") - (1 << 63))
                size += int(n)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), batch.column("doc_id"), batch.column("held_out"), text], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", F.coalesce("text", F.lit("")).alias("text"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    return rows.mapInArrow(cut, "block long, doc_id long, held_out boolean, text binary")


class Asking:
    """What one block asks for: its distinct words and byte strings, with their counts in its training texts."""

    def __init__(self):
        self.words, self.parts, self.held, self.size = Counter(), [], ([], []), 0

    def add(self, text: bytes, off: bool) -> None:
        for words in runs(text):
            if off:
                for w in words:
                    self.words.setdefault(w, 0)
            else:
                self.words.update(words)
        self.words[b""] += not off
        self.held[off].append(text)
        self.size += len(text)
        if self.size > PIECE:
            self.spell()

    def spell(self) -> None:
        for off, texts in enumerate(self.held):
            for _, pieces in together(texts):
                keys, n = np.unique(grams(pieces)[0], return_counts=True)
                self.parts.append((keys, np.zeros_like(n) if off else n))
            texts.clear()
        self.size = 0
        if sum(len(k) for k, _ in self.parts) > HELD:
            self.parts = [summed(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))]

    def rows(self, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
        """(bucket, keys, n); words have buckets below 0."""
        self.spell()
        words: dict[int, list[bytes]] = {}
        for w in self.words:
            words.setdefault(crc32(w) % buckets, []).append(w)
        for b, some in words.items():
            yield -1 - b, packed(some), packed(np.array([self.words[w] for w in some], np.int64))
        keys, n = summed(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))
        bucket = ((keys >> 8 & 0xFFFFFF).astype(np.uint64) * _MULT >> np.uint64(33)).astype(np.int64) % buckets
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
        for a, b in zip(edges, edges[1:], strict=False):
            yield int(bucket[order[a]]), packed(keys[order[a:b]]), packed(n[order[a:b]])


def asked(blocks: DataFrame, buckets: int, salts: int) -> DataFrame:
    """(bucket, salt, block, keys, n) of every block."""
    names = "bucket long, salt long, block long, keys binary, n binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, asking = None, None
        for batch in batches:
            for block, off, text in zip(*(batch.column(c) for c in ("block", "held_out", "text")), strict=True):
                if block.as_py() != current:
                    if asking:
                        yield from _table([(b, current % salts, current, k, n) for b, k, n in asking.rows(buckets)], names).to_batches()
                    current, asking = block.as_py(), Asking()
                asking.add(text.as_py(), bool(off.as_py()))
        if asking:
            yield from _table([(b, current % salts, current, k, n) for b, k, n in asking.rows(buckets)], names).to_batches()

    return blocks.mapInArrow(ask, names)


def added(group: pa.Table) -> pa.Table:
    """The rows of one bucket added up, without what no training text has."""
    bucket, keys, n = group.column("bucket")[0].as_py(), group.column("keys").to_pylist(), group.column("n").to_pylist()
    if bucket < 0:
        sums: Counter = Counter()
        for some, times in zip(keys, n, strict=True):
            for w, c in zip(_words(some), _numbers(times).tolist(), strict=True):
                if c:
                    sums[w] += c
        all_keys, all_n = list(sums), np.array(list(sums.values()), np.int64)
    else:
        all_keys, all_n = summed(np.concatenate([_numbers(k) for k in keys]), np.concatenate([_numbers(x) for x in n]))
        all_keys, all_n = all_keys[all_n > 0], all_n[all_n > 0]
    rows = [(bucket, packed(all_keys), packed(all_n), int(all_n.sum()), len(all_n))] if len(all_n) else []
    return _table(rows, _ROWS)


def low_counts(sums: DataFrame, spark) -> list[Order]:
    """The orders from LOW down: at most 2**24 counts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(batch.column("keys").to_pylist(), batch.column("n").to_pylist(), strict=True):
                short, times = summed(_numbers(keys) & (1 << 8 * (LOW + 1)) - 1, _numbers(n))
                yield pa.RecordBatch.from_arrays([pa.array(short), pa.array(times)], names=["gram", "n"])

    rows = sums.where("bucket >= 0").select("keys", "n").mapInArrow(cut, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    return orders(rows["gram"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), LOW, 0, [])


def answered(asking: DataFrame, sums: DataFrame, low: list[Order]) -> DataFrame:
    """(block, words, keys, values): for every row of `asked` the counts of its words, or its byte strings' log10."""
    names, shared = "block long, words boolean, keys binary, answers binary", asking.sparkSession.sparkContext.broadcast(low)

    def answer(rows: pa.Table, model: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _table([], names)
        bucket, blocks, keys = rows.column("bucket")[0].as_py(), rows.column("block").to_pylist(), rows.column("keys").to_pylist()
        known = [(k, n) for k, n in zip(model.column("keys").to_pylist(), model.column("n").to_pylist(), strict=True)]
        if bucket < 0:
            counts = {w: c for k, n in known for w, c in zip(_words(k), _numbers(n).tolist(), strict=True)}
            out = [(b, True, k, packed(np.array([counts.get(w, 0) for w in _words(k)], np.int64))) for b, k in zip(blocks, keys, strict=True)]
        else:
            own = [_numbers(k) for k in keys]
            seen, n = (np.concatenate([_numbers(x) for x in c]) for c in zip(*known, strict=True)) if known else (np.zeros(0, np.int64),) * 2
            every = np.unique(np.concatenate(own))
            p = log10(orders(seen, n, ORDER, LOW + 1, shared.value), every).astype(np.float32)
            out = [(b, False, k, packed(p[np.searchsorted(every, o)])) for b, k, o in zip(blocks, keys, own, strict=True)]
        return _table(out, names)

    salted = asking.select(F.col("bucket").alias("of"), F.col("salt").alias("group")).distinct()
    salted = salted.join(sums.select(F.col("bucket").alias("of"), "keys", "n"), "of")
    return asking.groupBy("bucket", "salt").cogroup(salted.groupBy("of", "group")).applyInArrow(answer, names)


def score_documents(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, held_out) scored: n_tokens, n_known, train_tokens, base_score, score."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, salts = max(LEAST_BUCKETS, -(-size // BUCKET)), max(1, -(-size // (BLOCK * BLOCKS_PER_SALT)))
    blocks = _blocks(docs)
    asking = stored(asked(blocks, buckets, salts), "op4-asked")
    by_salt = asking.groupBy("bucket", "salt").applyInArrow(added, _ROWS)
    sums = stored(by_salt.groupBy("bucket").applyInArrow(added, _ROWS), "op4-sums")
    totals = sums.where("bucket < 0").agg(F.sum("total"), F.sum("kinds")).first()
    n, v = totals[0] or 0, totals[1] or 0
    answers = answered(asking, sums, low_counts(sums, docs.sparkSession))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def add_up(rows: pa.Table, back: pa.Table) -> pa.Table:
        counts: dict[bytes, int] = {}
        keys, values = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
        for is_word, k, x in zip(*(back.column(c).to_pylist() for c in ("words", "keys", "answers")), strict=True):
            if is_word:
                counts.update(zip(_words(k), _numbers(x).tolist(), strict=True))
            else:
                keys.append(_numbers(k))
                values.append(_numbers(x, np.float32))
        strings, p = pd.Index(np.concatenate(keys)), np.concatenate(values)
        texts = rows.column("text")
        base, tokens, known = (np.zeros(len(texts)) for _ in range(3))
        score = scored((x.as_py() for x in texts), len(texts), lambda here: 10.0 ** p[strings.get_indexer(here)].astype(np.float64))
        for i, text in enumerate(texts):
            for words in (*runs(text.as_py()), [b""]):
                c = np.fromiter(map(counts.__getitem__, words), np.int64, len(words))
                tokens[i] += len(c)
                known[i] += np.count_nonzero(c)
                base[i] += np.log10((c + 1) / (n + v + 1)).sum()
        ints = (x.astype(np.int64) for x in (tokens, known))
        columns = [rows.column("doc_id"), rows.column("held_out"), *(pa.array(x) for x in ints), pa.array(np.full(len(texts), n, np.int64)), pa.array(base), pa.array(score)]
        return pa.table(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add_up, schema)


def op4_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs.withColumn("held_out", fold("doc_id", 7) == 2))


QUERIES = {"op4_lm_score": op4_lm_score}
SQL: dict[str, str] = {}
