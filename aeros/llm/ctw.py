"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A document is its lower-cased words (A-Z alone are lowered), joined by one space and closed by an end byte, so the
score is the probability of its token sequence. Each byte is eight binary decisions; each decision has, for every
context of 0 to DEPTH bytes before it, a Krichevsky-Trofimov estimate. Weighted over all depths,

    Pw(s) = (KT(s) + product over longer contexts of Pw) / 2,    Pw = KT at DEPTH,

they give the probability of a bit given the training documents. A context that training has not seen is no node: the tree
ends above it. The score sums log10 over the document; the code length per byte follows from it.

On Spark: documents are dealt into buckets of at most BUCKET neighbouring rows and about BUCKET_BYTES; a text over LONG
bytes is a bucket of its own. A bucket's distinct n-grams and words are counted once and dealt into parts, each as one
compressed sorted list; a part sums its lists over all buckets, weighs its contexts, and sends each bucket's list back
with its values. N-grams are dealt by their TOP nearest bytes; the levels above are sums by Spark, one level from the
other, and the topmost two (65,535 binary nodes at most, by their form) are merged on the driver. Values travel as
32-bit floats; words are told apart by 63-bit hashes.

Null and empty texts are the end token alone. With no training documents every bit has probability 1/2. Repeated rows
and rows of one id are scored each by itself, and count as often as they occur. No column but the id and the text plays a part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, small, stored, tidy

DEPTH = 6
#: Rows of a bucket; bytes that are worked on at a time; bytes of text for each part of the tree.
BUCKET, CHUNK, PART = 6144, 2 << 20, 4 << 20
#: Bytes of text that a bucket holds, about; bytes beyond which a text is a bucket of its own.
BUCKET_BYTES, LONG = 20 << 20, 1 << 20
#: Nearest bytes of the context by which n-grams are dealt over parts; parts in a task.
TOP, TOGETHER = 3, 4
END = b"\n"
_WORD_BIT = np.uint64(1 << 63)
_END_KEY = np.uint64(xxhash.xxh3_64_intdigest(END)) | _WORD_BIT
_LN2 = float(np.log(2))
_SMALL = np.concatenate([[0.0], np.cumsum(np.log(np.arange(4096) + 0.5))])  # log of (1/2)(3/2)...(n - 1/2)
_FACT = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 4097)))])


def _log_rising(n: np.ndarray) -> np.ndarray:
    """log of (1/2)(3/2)...(n - 1/2)."""
    small = n < 4096
    x = np.where(small, 4096, n) + 0.5
    far = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) - 0.5 * np.log(np.pi)
    return np.where(small, _SMALL[np.where(small, n, 0)], far)


def _log_factorial(n: np.ndarray) -> np.ndarray:
    small = n <= 4096
    x = np.where(small, 4097, n) + 1.0
    far = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(small, _FACT[np.where(small, n, 0)], far)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of the counts."""
    return _log_rising(zeros) + _log_rising(ones) - _log_factorial(zeros + ones)


def kt_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1.0)


def words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def word_keys(own: list[bytes]) -> np.ndarray:
    """A key for each word and one for the end; the top bit tells them from n-grams."""
    out = np.empty(len(own) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    out[:-1] |= _WORD_BIT
    out[-1] = _END_KEY
    return out


def ngram_keys(streams: list[bytes]) -> np.ndarray:
    """For each byte of each stream: the DEPTH bytes before it, nearest first, and the byte, as one number."""
    pad = END * DEPTH
    data = np.frombuffer(pad + pad.join(streams), np.uint8)
    n = len(data) - DEPTH
    key = np.zeros(n, np.uint64)
    for back in range(1, DEPTH + 1):
        key = key << np.uint64(8) | data[DEPTH - back : DEPTH - back + n]
    key = key << np.uint64(8) | data[DEPTH:]
    keep = np.ones(n, bool)
    ends = np.cumsum([len(s) + DEPTH for s in streams])[:-1] - DEPTH
    for i in range(DEPTH):
        keep[ends + i] = False
    return key[keep]


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of n for each."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(keys) else n


def _distinct(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how many of each are in training documents."""
    for_train, counts = np.unique(keys[train], return_counts=True)
    rest = np.setdiff1d(np.unique(keys[~train]), for_train, assume_unique=True)
    return np.concatenate([for_train, rest]), np.concatenate([counts, np.zeros(len(rest), np.int64)])


def _counted(texts: list[bytes | None], train: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    own = [words(t) for t in texts]
    streams = [b" ".join(w) + END for w in own]
    grams = _distinct(ngram_keys(streams), np.repeat(train, [len(s) for s in streams]))
    tokens = _distinct(np.concatenate([word_keys(w) for w in own]), np.repeat(train, [len(w) + 1 for w in own]))
    return np.concatenate([grams[0], tokens[0]]), np.concatenate([grams[1], tokens[1]])


def pack(values: np.ndarray) -> bytes:
    """Numbers of one type, bytes of one place together, compressed."""
    wide = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(wide.T).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Keys in order, as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """N-grams: 0 to parts - 1, by their TOP nearest bytes; words: the same number after."""
    near = keys >> np.uint64(8 * (DEPTH - TOP + 1))
    gram = (near * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts)
    word = np.uint64(parts) + (keys >> np.uint64(20)) % np.uint64(parts)
    return np.where(keys >= _WORD_BIT, word, gram).astype(np.int64)


def lists(keys: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its keys) for each part that has any; keys are in order and stay so."""
    part = parts_of(keys, parts)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1], [True]])) if len(keys) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(part[order[a]]), order[a:b]


def chunks(texts: list[bytes | None]) -> Iterator[slice]:
    """Runs of texts of about CHUNK bytes."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or b"") > CHUNK:
            yield slice(start, i)
            start, size = i, 0
        size += len(t or b"")
    if texts:
        yield slice(start, len(texts))


def bucket_keys(texts: list[bytes | None], train: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a bucket in order, with their training counts."""
    parts: list[tuple] = []
    for c in chunks(texts):
        parts.append(_counted(texts[c], train[c]))
        if len(parts) > 3:
            parts = [summed(*(np.concatenate(x) for x in zip(*parts)))]
    return summed(*(np.concatenate(x) for x in zip(*parts))) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _count(bucket_rows: DataFrame, parts: int) -> DataFrame:
    """(bucket, part, keys, counts) of the rows (bucket, train, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, texts, train, size, folded = None, [], [], 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            if texts:
                folded.append(bucket_keys(texts, train))
            if folded:
                keys, n = summed(*(np.concatenate(x) for x in zip(*folded)))
                rows = [(at, p, pack_keys(keys[i]), pack(n[i].astype(np.uint32 if n[i].max() < 1 << 32 else np.uint64)), int(n[i].max() >= 1 << 32)) for p, i in lists(keys, parts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32()))], names=["bucket", "part", "keys", "counts", "wide"])

        for b in batches:
            for bucket, t, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if bucket != at:
                    yield from flush()
                    at, texts, train, size, folded = bucket, [], [], 0, []
                texts.append(text)
                train.append(t)
                size += len(text or b"")
                if size > 8 * CHUNK:
                    folded.append(bucket_keys(texts, train))
                    texts, train, size = [], [], 0
        yield from flush()

    return bucket_rows.mapInArrow(tidy(run), "bucket long, part int, keys binary, counts binary, wide int")


def _part_sums(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each list's keys, and the distinct keys of the part with their summed counts."""
    each = [unpack_keys(k) for k in table.column("keys").to_pylist()]
    n = [unpack(c, np.uint64 if w else np.uint32).astype(np.int64) for c, w in zip(table.column("counts").to_pylist(), table.column("wide").to_pylist())]
    return each, *summed(np.concatenate(each), np.concatenate(n))


class Lookup:
    """Values of distinct keys by hashing: a probe costs a memory access where a search in order costs some twenty."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 3 // 2).bit_length())
        self.key, self.value = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits)
        owner, left, slot = np.full(1 << self.bits, -1, np.int32), np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = owner[slot] < 0
            owner[slot[free]] = left[free]
            out = owner[slot] != left
            left, slot = left[out], (slot[out] + 1) & ((1 << self.bits) - 1)
        used = np.flatnonzero(owner >= 0)
        self.key[used], self.value[used] = keys[owner[used]], values[owner[used]]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys that are all known. Free slots hold key 0; that key itself, if known, lies before any of them."""
        slot = self._slot(keys)
        off = np.flatnonzero(self.key[slot] != keys)
        while len(off):
            slot[off] = (slot[off] + 1) & ((1 << self.bits) - 1)
            off = off[self.key[slot[off]] != keys[off]]
        return self.value[slot]


class _Tree:
    """The distinct n-grams of one part of the tree, at each depth from DEPTH up to `top`."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, top: int):
        self.top, self.keys, self.n, self.up = top, {DEPTH: keys}, {DEPTH: n}, {}
        for d in range(DEPTH - 1, top - 1, -1):
            whole = self.keys[d + 1]
            short = whole >> np.uint64(16) << np.uint64(8) | whole & np.uint64(255)  # without the farthest byte
            self.keys[d], self.up[d + 1] = np.unique(short, return_inverse=True)
            self.n[d] = np.bincount(self.up[d + 1], self.n[d + 1], len(self.keys[d])).astype(np.int64)

    def nodes(self, d: int, j: int):
        """For bit j at depth d: each n-gram's node, first n-gram of each node, zeros, ones, the nodes' own numbers."""
        keys, n = self.keys[d], self.n[d]
        prefix = keys >> np.uint64(8 - j)
        first = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
        node = np.cumsum(np.concatenate([[0], prefix[1:] != prefix[:-1]]))
        one = (keys >> np.uint64(7 - j) & np.uint64(1)).astype(np.int64)
        ones = np.add.reduceat(n * one, first)
        return node, first, np.add.reduceat(n, first) - ones, ones, prefix[first]

    def weigh(self, j: int) -> dict[int, tuple]:
        """nodes() with log KT and the summed log Pw of longer contexts, for each depth; top has the sums alone."""
        out, log_pw = {}, None
        for d in range(DEPTH, self.top - 1, -1):
            node, first, zeros, ones, name = self.nodes(d, j)
            child = np.zeros(len(first)) if log_pw is None else np.bincount(node[self.up[d + 1][out[d + 1][1]]], log_pw, len(first))
            kt = log_kt(zeros, ones)
            log_pw = kt if d == DEPTH else np.logaddexp(kt, child) - _LN2
            out[d] = (node, first, zeros, ones, name, kt, child)
        return out


def _number(name: np.ndarray, j: int) -> np.ndarray:
    """A node's number: context, bit, and the bits of the byte before that bit."""
    return (name >> np.uint64(j) << np.uint64(11) | np.uint64(j << 8) | name & np.uint64((1 << j) - 1)).astype(np.int64)


_NODE = "node long, zeros long, ones long, child double"
_GIVEN = "node long, share double, rest double, ends double"


def _rise(parts: int):
    def run(table: pa.Table) -> pa.Table:
        """Counts and summed log Pw of a part's nodes at depth TOP; of words, their number and kinds at node -1."""
        part = table.column("part")[0].as_py()
        _, keys, n = _part_sums(table)
        if part >= parts:
            out = [pd.DataFrame({"node": [-1], "zeros": [n.sum()], "ones": [(n > 0).sum()], "child": [0.0]})]
        else:
            tree, out = _Tree(keys, n, TOP), []
            for j in range(8):
                _, _, zeros, ones, name, _, child = tree.weigh(j)[TOP]
                out.append(pd.DataFrame({"node": _number(name, j), "zeros": zeros, "ones": ones, "child": child}))
        both = pd.concat(out)
        release()
        kinds = dict(zip(both.columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64())))
        return pa.table({"part": pa.array(np.full(len(both), part), pa.int32())} | {c: pa.array(both[c].to_numpy(), t) for c, t in kinds.items()})

    return run


def _step(zeros, ones, kt, child, share, rest, above):
    """From above: the weight mixed so far (share), what is left (rest), and the estimate if the tree ends there (above)."""
    own = kt_one(zeros, ones)
    weight = 1 / (1 + np.exp(np.clip(child - kt, -700, 700)))
    ends = np.where(zeros + ones > 0, share + rest * own, above)
    return share + rest * weight * own, rest * (1 - weight), ends


def _up(node: np.ndarray) -> np.ndarray:
    """The number of the node that lacks the farthest byte of this one's context."""
    return node >> 19 << 11 | node & 2047


def _raised(level: DataFrame) -> DataFrame:
    """The nodes of one depth, summed to the depth above."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in batches:
            z, o = g["zeros"].to_numpy(), g["ones"].to_numpy()
            pw = np.logaddexp(log_kt(z, o), g["child"].to_numpy()) - _LN2
            yield pd.DataFrame({"node": _up(g["node"].to_numpy()), "zeros": z, "ones": o, "child": pw})

    rows = level.select("node", "zeros", "ones", "child").mapInPandas(run, _NODE)
    return rows.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "child")])


def _lowered(level: DataFrame, above: DataFrame) -> DataFrame:
    """(part, node, share, rest, ends) of the nodes of one depth, given those of the depth above."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in batches:
            z, o, *given = (g[c].to_numpy() for c in ("zeros", "ones", "share", "rest", "ends"))
            share, rest, ends = _step(z, o, log_kt(z, o), g["child"].to_numpy(), *given)
            yield pd.DataFrame({"part": g["part"], "node": g["node"], "share": share, "rest": rest, "ends": ends})

    number = F.shiftright("node", 19) * 2048 + F.col("node").bitwiseAND(2047)
    joined = level.withColumn("up", number).join(above.select(F.col("node").alias("up"), "share", "rest", "ends"), "up")
    return joined.select("part", "node", "zeros", "ones", "child", "share", "rest", "ends").mapInPandas(run, "part int, " + _GIVEN)


def _from_root(level: pd.DataFrame) -> pd.DataFrame:
    """Depth 1 nodes with share, rest and ends, given the root above them."""
    level = level.sort_values("node", ignore_index=True)
    z, o, child = (level[c].to_numpy() for c in ("zeros", "ones", "child"))
    kt = log_kt(z, o)
    at = level["node"].to_numpy() & 2047
    root = pd.DataFrame({"at": at, "zeros": z, "ones": o, "child": np.logaddexp(kt, child) - _LN2}).groupby("at").sum()
    rz, ro = root["zeros"].to_numpy(), root["ones"].to_numpy()
    share, rest, ends = _step(rz, ro, log_kt(rz, ro), root["child"].to_numpy(), 0.0, 1.0, 0.5)
    i = root.index.get_indexer(at)
    share, rest, ends = _step(z, o, kt, child, share[i], rest[i], ends[i])
    return pd.DataFrame({"node": level["node"], "share": share, "rest": rest, "ends": ends})


def _values(keys: np.ndarray, n: np.ndarray, above: pd.DataFrame) -> np.ndarray:
    """log10 probability of each n-gram of a part, given its nodes at depth TOP."""
    above = above.sort_values("node")
    names, given = above["node"].to_numpy(), [above[c].to_numpy() for c in ("share", "rest", "ends")]
    tree, total = _Tree(keys, n, TOP), np.zeros(len(keys))
    for j in range(8):
        levels = tree.weigh(j)
        i = np.searchsorted(names, _number(levels[TOP][4], j))
        share, rest, ends = (v[i] for v in given)
        for d in range(TOP + 1, DEPTH + 1):
            node, first, zeros, ones, _, kt, child = levels[d]
            p = levels[d - 1][0][tree.up[d][first]]
            share, rest, ends = _step(zeros, ones, kt, child, share[p], rest[p], ends[p])
        p = ends[levels[DEPTH][0]]
        bit = (keys >> np.uint64(7 - j) & np.uint64(1)).astype(bool)
        total += np.log10(np.maximum(np.where(bit, p, 1 - p), 1e-300))
    return total


def _fall(parts: int):
    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        """(bucket, word, keys, values): for n-grams log10 probabilities, for words their counts, in the order of the keys."""
        names, kinds = ("bucket", "word", "keys", "values"), (pa.int64(), pa.bool_(), pa.binary(), pa.binary())
        if not table.num_rows:
            return pa.table({n: pa.array([], k) for n, k in zip(names, kinds)})
        each, keys, n = _part_sums(table)
        word = table.column("part")[0].as_py() >= parts
        value = n if word else _values(keys, n, above.to_pandas()).astype(np.float32)
        own = [pack(value[np.searchsorted(keys, k)]) for k in each]
        del each, keys, n, value
        release()
        return pa.table(dict(zip(names, (table.column("bucket"), pa.array([word] * len(own), pa.bool_()), table.column("keys"), pa.array(own, pa.binary())))))

    return run


def weighted(items: DataFrame, parts: int) -> tuple[DataFrame, int, int]:
    """(bucket, word, keys, values) for the lists of items, the training tokens and their kinds."""
    tasks = max(1, 2 * parts // TOGETHER)
    dealt = items.repartition(tasks, "part")
    rows = stored(dealt.groupBy("part").applyInArrow(_rise(parts), "part int, " + _NODE), "nodes")
    total, kinds = rows.filter("node = -1").agg(F.coalesce(F.sum("zeros"), F.lit(0)), F.coalesce(F.sum("ones"), F.lit(0))).first()
    levels = [rows.filter("node >= 0")]
    for _ in range(TOP - 2):
        levels.append(stored(_raised(levels[-1]).withColumn("part", F.lit(0)), "nodes"))
    # at most 256 contexts of one byte with 255 binary nodes each
    above = F.broadcast(items.sparkSession.createDataFrame(_from_root(_raised(levels[-1]).toPandas()), _GIVEN))
    for level in reversed(levels):
        above = _lowered(level, above)
    given = above.repartition(tasks, "part")
    out = dealt.groupBy("part").cogroup(given.groupBy("part")).applyInArrow(_fall(parts), "bucket long, word boolean, keys binary, values binary")
    return out, total, kinds


def bucketed(df: DataFrame, columns: list[Column]) -> tuple[DataFrame, int, int]:
    """The columns of df, one of them named text, and each row's bucket; the bytes of all texts; how many buckets, about.

    A block is BUCKET neighbouring rows of a file. It is cut into as many runs of rows as it holds BUCKET_BYTES of texts
    that are not long; a long text is a bucket of its own.
    """
    row = F.col("_metadata.row_index")
    if "_metadata" in df.columns:  # a column of this name hides the file's
        df = stored(df.select(*columns), "documents")
        columns = [F.col(c) for c in df.columns]
    where = lambda d: d.select(*columns, F.xxhash64(F.col("_metadata.file_path"), F.floor(row / BUCKET)).alias("block"), (row % BUCKET).alias("row"))
    try:
        docs = where(df)
    except AnalysisException:  # not rows of a file: make them so
        docs = where(stored(df, "documents"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    is_long = size > LONG
    blocks = docs.groupBy("block").agg(F.sum(size).alias("size"), F.sum(F.when(~is_long, size).otherwise(0)).alias("short"), F.sum(is_long.cast("int")).alias("long"))
    runs = F.greatest(F.ceil(F.col("short") / BUCKET_BYTES), F.lit(1))
    blocks = stored(blocks.withColumn("runs", runs), "blocks")
    total, count = blocks.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum(F.col("runs") + F.col("long")), F.lit(0))).first()
    cut = small(stored(blocks.filter("runs > 1").select("block", "runs"), "cut"))
    run = F.floor(F.col("row") * F.coalesce("runs", F.lit(1)) / BUCKET)
    bucket = F.when(is_long, F.xxhash64("block", "row", F.lit("long"))).otherwise(F.xxhash64("block", run))
    return docs.join(cut, "block", "left").withColumn("bucket", bucket).drop("block", "row", "runs"), total, count


def scores(df: DataFrame, train, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of each row.

    train: a boolean column that tells the rows to learn from.
    """
    columns = [F.col(key).alias("id"), F.coalesce(train, F.lit(True)).alias("train"), F.col(text).cast("binary").alias("text")]
    docs, size, buckets = bucketed(df, columns)
    docs, parts, tasks = docs.select("bucket", "id", "train", "text"), max(8, size // PART), max(1, 2 * buckets)
    items = stored(_count(docs.select("bucket", "train", "text"), parts), "items")
    values, total, kinds = weighted(items, parts)
    floor = total + 0.1 * (kinds + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, train = left.column("text").to_pylist(), left.column("train").to_pylist()
        keys = np.concatenate([unpack_keys(k) for k in right.column("keys").to_pylist()])
        value = np.concatenate([unpack(v, np.int64 if w else np.float32).astype(np.float64) for v, w in zip(right.column("values").to_pylist(), right.column("word").to_pylist())])
        keys, first = np.unique(keys, return_index=True)
        of = Lookup(keys, value[first])
        del keys, value, first
        cols: list[list] = [[] for _ in range(5)]
        for at in chunks(texts):
            own = [words(t) for t in texts[at]]
            streams = [b" ".join(w) + END for w in own]
            c = of(np.concatenate([word_keys(w) for w in own]))
            p = of(ngram_keys(streams))
            n, lengths = np.array([len(w) + 1 for w in own]), np.array([len(s) for s in streams])
            first, begin = np.cumsum(n) - n, np.cumsum(lengths) - lengths
            score = np.add.reduceat(p, begin)
            for col, v in zip(cols, (n, np.add.reduceat((c > 0).astype(np.int64), first), np.add.reduceat(np.log10((c + 0.1) / floor), first), score, -score / np.log10(2) / lengths)):
                col.append(v)
        n, seen, base, score, bits = (np.concatenate(c) if c else np.empty(0) for c in cols)
        del of
        release()
        held = pa.array([not t for t in train], pa.bool_())
        return pa.table({key: left.column("id"), "held_out": held, "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(seen, pa.int64()), "train_tokens": pa.array(np.full(len(n), total), pa.int64()), "base_score": base, "score": score, "bits_per_byte": bits})

    kind = df.schema[key].dataType.simpleString()
    left, right = docs.repartition(tasks, "bucket"), values.repartition(tasks, "bucket")
    return left.groupBy("bucket").cogroup(right.groupBy("bucket")).applyInArrow(run, f"{key} {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
