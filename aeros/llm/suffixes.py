"""Benchmark decontamination by suffix arrays of the training text.

Words are runs of letters, digits and characters beyond ASCII; A-Z count as a-z. The documents of a task are taken in
shards bounded by bytes. A shard's suffix array orders all its suffixes that begin with a word of some test item, by
doubling, as deep as the longest item; words that no item holds, and the ends of documents, match nothing. Every suffix of
every item is binary-searched in it, which gives its longest verbatim match with a location. A window is `window`
consecutive words of an item, or all words of a shorter item. Where a suffix matches a whole window, all places of
the window are an interval of the suffix array; the words there are hit.

Items go to the tasks in blocks of bounded size, each a pass of its own over the documents, whose findings are united. A
shard's work grows with its words and the items' words, not with the copies: a place begins one window of each width at most.

A null text has no words, like an empty one. Each row is judged by itself, so repeated rows and ids give repeated
results. Items without an id or without words take no part; an id that occurs with several texts owns the windows of all.
A text longer than a shard is taken in pieces that overlap by the longest item. Empty tables give no rows, and an
empty benchmark no hits. The columns to keep may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import slices, stored, tidy

#: Bytes of text and words of a shard, bytes of the items of a block.
SHARD, PIECE, BLOCK = 12 << 20, 3 << 20, 16 << 20
WINDOW = 10
_DOCUMENT = b"\x00"
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def packed(ids: np.ndarray, bits: int, per: int) -> np.ndarray:
    """The next `per` ids of each place in one number, the first in its highest bits; zeros beyond the end."""
    out = np.zeros(len(ids), np.uint64)
    for i in range(min(per, len(ids))):
        out[: len(ids) - i] |= ids[i:].astype(np.uint64) << np.uint64(64 - bits * (i + 1))
    return out


class Passages:
    """The items of a block: their words as ids from 1, in the order of the sequences, each followed by a 0."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            if words := tuple(text.encode().translate(_WORD).split()):
                owners.setdefault(words, set()).add(item)
        self.items = [sorted(own) for own in owners.values()]  # of each sequence
        self.vocabulary: dict[bytes, int] = {_DOCUMENT: -1}
        sequences = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for words in owners]
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.per = 64 // self.bits
        self.depth = max(map(len, sequences), default=0)
        self.ids = np.array([i for s in sequences for i in (*s, 0)], np.int64)
        ends = np.flatnonzero(self.ids == 0)
        self.left = ends[np.searchsorted(ends, np.arange(len(self.ids)))] - np.arange(len(self.ids))  # words up to the item's end
        self.keys = packed(self.ids, self.bits, self.per)
        # windows of equal words are one; sets of items that own the same windows are one
        found: dict[bytes, list] = {}
        start = 0
        for s, own in zip(sequences, owners.values()):
            width = min(window, len(s))
            for p in range(start, start + len(s) - width + 1):
                found.setdefault(self.ids[p : p + width].tobytes(), [p, width, set()])[2].update(own)
            start += len(s) + 1
        sets: dict[frozenset, int] = {}
        rows = [(p, w, sets.setdefault(frozenset(own), len(sets))) for p, w, own in found.values()]
        self.at, self.width, self.owner = (np.array(c, np.int64) for c in (zip(*rows) if rows else ([], [], [])))
        self.sets = [sorted(s) for s in sets]
        self._names: dict[tuple[int, ...], list[str]] = {}

    def key(self, at: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The keys at these places with only so many words kept."""
        shift = np.uint64(64) - (np.clip(words, 0, self.per) * self.bits).astype(np.uint64)
        inside = at < len(self.keys)
        full = np.where(inside, self.keys[np.where(inside, at, 0)], np.uint64(0))
        return np.where(words > 0, (full >> np.minimum(shift, np.uint64(63))) << np.minimum(shift, np.uint64(63)), np.uint64(0))

    def owners(self, sets: tuple[int, ...]) -> list[str]:
        """The items of these sets, sorted."""
        if len(sets) == 1:
            return self.sets[sets[0]]
        if sets not in self._names:
            if len(self._names) >= 1000:
                self._names.clear()
            self._names[sets] = sorted(set().union(*(self.sets[s] for s in sets)))
        return self._names[sets]


def word_ids(texts: list[bytes | None], passages: Passages, chunk: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words of all texts, 0 for words of no item and before each text; the places of those zeros."""
    whole = b"".join(part for t in texts for part in (_DOCUMENT, b" ", (t or b"").translate(_WORD), b" "))
    parts, start, get = [], 0, passages.vocabulary.get
    while start < len(whole):
        stop = whole.find(b" ", start + chunk)
        stop = len(whole) if stop < 0 else stop
        words = whole[start:stop].split()
        parts.append(np.fromiter((get(w, 0) for w in words), np.int32, len(words)))
        start = stop
    ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
    starts = np.flatnonzero(ids < 0)
    ids[starts] = 0
    return ids, starts


class SuffixArray:
    """The suffixes of ids that begin with a known word, in order of at least their first `depth` words."""

    def __init__(self, ids: np.ndarray, bits: int, per: int, depth: int):
        n, self.bits, self.per = len(ids), bits, per
        zeros = np.append(np.flatnonzero(ids == 0), n)
        self.keys = np.append(packed(ids, bits, per), np.zeros(depth + per, np.uint64))
        at = np.flatnonzero(ids)
        first = self.keys[at]
        order = np.argsort(first)
        self.sa, self.first = at[order], first[order]
        rank = np.zeros(n + depth + per + 1, np.int64)
        tied = np.flatnonzero(self._ranked(np.arange(len(at)), self.first, rank))
        h = per
        while len(tied) and h < depth + per:
            own = self.sa[tied]
            own_end = zeros[np.searchsorted(zeros, own)]
            tied, own = tied[own_end - own >= h], own[own_end - own >= h]  # beyond an unknown word nothing matches
            both = rank[own] << 32 | rank[own + h]
            order = np.argsort(both, kind="stable")
            self.sa[tied] = own[order]
            tied = tied[self._ranked(tied, both[order], rank)]
            h *= 2

    def _ranked(self, places: np.ndarray, keys: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Rank the suffixes at these places of the array by the first place of equal keys; which of them are tied."""
        if not len(places):
            return np.empty(0, bool)
        new = np.append(True, keys[1:] != keys[:-1])
        heads = np.flatnonzero(new)
        rank[self.sa[places]] = np.repeat(places[heads], np.diff(np.append(heads, len(places)))) + 1
        return ~(new & np.append(new[1:], True))

    def _bound(self, low: np.ndarray, high: np.ndarray, offset: int, target: np.ndarray, right: bool) -> np.ndarray:
        """The first place of [low, high) whose key at the offset is not below (right: is above) the target."""
        low, high = low.copy(), high.copy()
        if offset == 0 and len(low) and (low == 0).all() and (high == len(self.sa)).all():
            return np.searchsorted(self.first, target, "right" if right else "left")
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            key = self.keys[self.sa[middle] + offset]
            below = key <= target[open_] if right else key < target[open_]
            low[open_[below]] = middle[below] + 1
            high[open_[~below]] = middle[~below]
            open_ = open_[low[open_] < high[open_]]
        return low

    def longest(self, passages: Passages, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the item suffixes at these places: words of the longest match, and a place in the text where it lies."""
        length, where = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
        todo, low, high, level = np.arange(len(at)), np.zeros(len(at), np.int64), np.full(len(at), len(self.sa), np.int64), 0
        while len(todo) and len(self.sa):
            offset = level * self.per
            left = passages.left[at[todo]] - offset
            target = passages.key(at[todo] + offset, left)
            lo = self._bound(low, high, offset, target, False)
            for side in (lo - 1, lo):  # the neighbours of where it would stand share most words with it
                inside = (side >= low) & (side < high)
                place = self.sa[np.where(inside, side, 0)]
                other = self.keys[place + offset] ^ target
                same = sum((other >> np.uint64(64 - self.bits * (i + 1)) == 0).astype(np.int64) for i in range(self.per))
                same = np.where(inside, offset + np.minimum(same, left), 0)
                better = same > length[todo]
                length[todo[better]], where[todo[better]] = same[better], place[better]
            hi = self._bound(lo, high, offset, target, True)
            on = (left > self.per) & (lo < hi)
            todo, low, high, level = todo[on], lo[on], hi[on], level + 1
        return length, where

    def interval(self, passages: Passages, at: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of suffixes that begin with the `width` words at these places of the items."""
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.sa), np.int64)
        for offset in range(0, int(width.max(initial=0)), self.per):
            on = np.flatnonzero(width > offset)
            words = np.minimum(width[on] - offset, self.per)
            target = passages.key(at[on] + offset, words)
            rest = (np.uint64(64) - (words * self.bits).astype(np.uint64))
            most = np.where(rest > 0, target | ((np.uint64(1) << np.minimum(rest, np.uint64(63))) - np.uint64(1)), target)
            lo = self._bound(low[on], high[on], offset, target, False)
            low[on], high[on] = lo, self._bound(lo, high[on], offset, most, True)
        return low, high


def arrays(ids: np.ndarray, passages: Passages) -> Iterator[tuple[int, SuffixArray]]:
    """(start, suffix array) of pieces of the ids, which overlap by the longest item."""
    step = max(PIECE, 2 * passages.depth)
    for start in range(0, max(1, len(ids) - passages.depth), step):
        yield start, SuffixArray(ids[start : start + step + passages.depth], passages.bits, passages.per, passages.depth)


def matches(ids: np.ndarray, starts: np.ndarray, passages: Passages) -> tuple[list[np.ndarray], list[tuple[int, ...]]]:
    """For each text: its hit runs of words as rows (first, beyond the last); the sets of items whose windows occur in it."""
    edges = np.zeros(len(ids) + 1, np.int64)
    pairs = [np.empty(0, np.int64)]
    for start, array in arrays(ids, passages):
        length, _ = array.longest(passages, passages.at)
        met = np.flatnonzero(length >= passages.width)
        low, high = array.interval(passages, passages.at[met], passages.width[met])
        n = high - low
        place = array.sa[np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())] + start
        np.add.at(edges, place, 1)
        np.add.at(edges, place + np.repeat(passages.width[met], n), -1)
        text = np.searchsorted(starts, place, "right") - 1
        pairs.append(np.unique(text * len(passages.sets) + np.repeat(passages.owner[met], n)))
        del array
    hit = np.diff((np.cumsum(edges) > 0).astype(np.int8), prepend=0)
    runs = np.stack([np.flatnonzero(hit > 0), np.flatnonzero(hit < 0)], axis=1)
    text = np.searchsorted(starts, runs[:, 0], "right") - 1
    runs -= starts[text][:, None] + 1
    pair = np.unique(np.concatenate(pairs))
    owner = pair // max(1, len(passages.sets))
    cut = lambda rows, of: np.split(rows, np.searchsorted(of, np.arange(1, len(starts))))
    return cut(runs, text), [tuple(p.tolist()) for p in cut(pair % max(1, len(passages.sets)), owner)]


def _united(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, beyond in sorted(a + b):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], beyond))
        else:
            out.append((first, beyond))
    return out


_RUNS = ArrayType(StructType([StructField("first", LongType()), StructField("beyond", LongType())]))
_FOUND = [StructField("n_words", LongType()), StructField("hits", _RUNS), StructField("items", ArrayType(StringType()))]
_FOUND_ARROW = (pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("beyond", pa.int64())])), pa.list_(pa.string()))


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW, most: int = BLOCK) -> Iterator[Passages]:
    """The items in blocks of about `most` bytes, an item at least; one block without items if there are none."""
    size = F.octet_length("text") + 64
    rows = stored(benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).filter("item is not null and text is not null").distinct(), "items")
    n = max(1, -(-(rows.agg(F.sum(size)).first()[0] or 0) // most))
    for i in range(n):
        own = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        yield Passages([tuple(r) for r in own.collect()], window)


def found(df: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item: str = "item_id", window: int = WINDOW) -> DataFrame:
    """(row, n_words, hits, items) of each row: the columns to keep as one struct, the number of words, the runs of hit words
    (first, beyond the last), and the items whose windows occur, sorted as text."""
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    inside = keep.index(text) if text in keep else None
    out = df.select(kept) if inside is not None else df.select(kept, F.col(f"`{text}`").alias("text"))
    kind = StructType([StructField("row", out.schema["row"].dataType), *_FOUND] if inside is not None else [*out.schema.fields, *_FOUND])
    for n, passages in enumerate(blocks(benchmark, item, "text", window)):
        out = (out if n == 0 else stored(out, "matches")).mapInArrow(tidy(_search(passages, inside, n > 0)), kind)
    return out.select("row", "n_words", "hits", "items")


def _search(passages: Passages, inside: int | None, again: bool):
    """The findings of a block's items for batches of (row, text), united with those that the batches hold already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            text = (pc.struct_field(whole.column(0), [inside]) if inside is not None else whole.column(1)).cast(pa.binary())
            shell = pa.RecordBatch.from_arrays([*whole.columns, text], names=[*whole.schema.names, "_bytes"])
            for b in slices(shell, shell.num_columns - 1, SHARD):
                ids, starts = word_ids(b.column(b.num_columns - 1).to_pylist(), passages)
                runs, sets = matches(ids, starts, passages)
                words = np.diff(np.append(starts, len(ids))) - 1
                hits = [[tuple(r) for r in own.tolist()] for own in runs]
                items = [passages.owners(s) if s else [] for s in sets]
                if again:
                    hits = [_united([(r["first"], r["beyond"]) for r in old], new) for old, new in zip(b.column("hits").to_pylist(), hits)]
                    items = [sorted({*old, *new}) for old, new in zip(b.column("items").to_pylist(), items)]
                given = [b.column(i) for i in range(1 if inside is not None else 2)]
                names = ["row", "text"][: len(given)] + ["n_words", "hits", "items"]
                yield pa.RecordBatch.from_arrays([*given, *(pa.array(c, t) for c, t in zip((words, hits, items), _FOUND_ARROW))], names=names)

    return run


def n_hit() -> Column:
    """Hit words of a row of found()."""
    return F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r["beyond"] - r["first"])


def decontaminated(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", window: int = WINDOW) -> DataFrame:
    """The documents in which no window of an item occurs, all their columns."""
    return found(df, benchmark, df.columns, text, item, window).filter(F.size("hits") == 0).select("row.*")


def digests(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", window: int = WINDOW) -> DataFrame:
    """key, n_words, n_hit, n_items, items_sha256, contaminated of each row."""
    out = found(df, benchmark, [key], text, item, window)
    joined = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("row.*", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"), joined.alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def longest_matches(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """item, first, length, key, place: for every item the longest run of its words that stands verbatim in a document, where
    in the item it begins, and one place of it. Items without a common word have no row."""
    best = None
    schema = StructType([StructField("item", StringType()), StructField("first", LongType()), StructField("length", LongType()), StructField("key", df.schema[key].dataType), StructField("place", LongType())])
    for passages in blocks(benchmark, item, "text"):
        own = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(tidy(_longest(passages)), schema)
        best = own if best is None else best.unionByName(own)
    order = F.struct(F.col("length"), -F.col("first"))
    top = best.groupBy("item").agg(F.max(order).alias("top"))
    same = best.join(top, "item").filter(order == F.col("top"))
    return same.groupBy("item", "first", "length").agg(F.min(F.struct("key", "place")).alias("at")).select("item", "first", "length", F.col("at.key").alias(key), "at.place")


def _longest(passages: Passages):
    at = np.flatnonzero(passages.ids)
    ends = np.flatnonzero(passages.ids == 0)
    sequence = np.searchsorted(ends, at)
    begins = np.append(0, ends[:-1] + 1)[sequence] if len(ends) else at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 1, SHARD):
                ids, starts = word_ids(b.column(1).to_pylist(), passages)
                keys, rows = b.column(0).to_pylist(), []
                for start, array in arrays(ids, passages):
                    length, where = array.longest(passages, at)
                    order = np.lexsort((at, -length, sequence))
                    for i in order[np.append(True, np.diff(sequence[order]) > 0)] if len(order) else ():
                        if length[i]:
                            p = int(where[i]) + start
                            text = int(np.searchsorted(starts, p, "right")) - 1
                            rows.append((int(sequence[i]), int(at[i] - begins[i]), int(length[i]), keys[text], p - int(starts[text]) - 1))
                out = [(item, *r[1:]) for r in rows for item in passages.items[r[0]]]
                cols = list(zip(*out)) if out else [()] * 5
                kinds = (pa.string(), pa.int64(), pa.int64(), b.schema.field(0).type, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["item", "first", "length", "key", "place"])

    return run
