"""Sum-of-squares packing of tokenised documents into sequences of a fixed capacity.

A document's tokens (and one end token) are one piece, or, where longer than the capacity, a shorter first piece
and full ones. Full pieces are sequences of their own. The others are dealt evenly over shards of about
SHARD pieces; each shard places its pieces, longest first, where the sum over residual gaps of (open bins with that
gap) ** 2 becomes smallest. Shards keep the work parallel; a shard wastes only its own last open bins.

A piece opens a new sequence only where it fits into no open one: among the open ones the sums of squares decide.

Pieces of equal length are placed in the order of key, piece and start; of equally good gaps the smallest is filled. An empty table
gives no pieces.

Null and empty texts are a document of the end token alone. Repeated rows are packed once each, rows without an id like
any other; the result has the key and the columns above, whatever other columns there are.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import BYTE_CHARS
from .common import slices, stored, tidy

#: Pieces that one shard packs, on average.
SHARD = 20_000
#: Chunks whose ids a task remembers before it starts anew; with at most 100 characters each they take 30 MB at most.
CACHE = 100_000
#: How byte-level files cut a text before merging (fixed value of that format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class _Known(dict):
    """Ids of a space and the chunk after it; what is not known is encoded."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace():  # such a space belongs to a run of white space
            raise KeyError(chunk)
        ids = self.encode(" " + chunk)
        if len(self) > CACHE:
            self.clear()
        if len(chunk) < 100:
            self[chunk] = ids
        return ids


class ByteCodec:
    """Ids of a byte-level vocabulary file as little-endian 32-bit bytes.

    A space before a character that is no white space always begins a token, so the text is cut there and the
    ids of each cut are remembered. Where ids follow the order of the merges, as they do in these files, chunks without
    special tokens are encoded from ranks; all else by the file's own tokenizer.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            self.ranks = self._by_rank(json.load(f))
        self.known = _Known(self._chunk)

    @cached_property
    def tokenizer(self):
        """The file's own tokenizer, loaded when a text needs it."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(self.path)
        own.no_truncation()
        own.no_padding()
        return own

    def forget(self) -> None:
        """Drop what a task has remembered and the tokenizer, which few texts need."""
        self.known.clear()
        self.__dict__.pop("tokenizer", None)

    @staticmethod
    def _by_rank(spec: dict):
        model, cut = spec["model"], spec["pre_tokenizer"]
        vocab = model["vocab"]
        made = [vocab["".join(m if not isinstance(m, str) else m.split(" ", 1))] for m in model["merges"]]
        plain = cut == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and spec["normalizer"] is None
        if not plain or made != sorted(set(made)) or sorted(vocab.values()) != list(range(len(vocab))) or (made and made[0] < len(vocab) - len(made)):
            return None
        import tiktoken

        to_byte = {c: b for b, c in BYTE_CHARS.items()}
        ranks = {bytes(map(to_byte.__getitem__, t)): i for t, i in vocab.items()}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _exact(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunk(self, text: str) -> bytes:
        if self.ranks is None or "<|" in text:
            return self._exact(text)
        return array("I", self.ranks.encode_ordinary(text)).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text."""
        first, *rest = (text or "").split(" ")
        try:
            return self._chunk(first) + b"".join(map(self.known.__getitem__, rest))
        except KeyError:
            return self._exact(text)


@lru_cache(maxsize=1)
def codec(path: str) -> ByteCodec:
    """One per Python worker and file."""
    return ByteCodec(path)


def pieces(df: DataFrame, path: str, capacity: int = 2048, key: str = "doc_id", text: str = "text", end: int = 0, with_ids: bool = True) -> DataFrame:
    """key, piece, start, length, ids_crc32 and, if asked for, ids of each piece of each document."""
    names = [key, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, last = codec(path), end.to_bytes(4, "little")
        for b in batches:
            for part in slices(b, 1, 2 << 20):
                cols: list[list] = [[] for _ in names]
                for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = use.encode(t) + last
                    n = len(ids) // 4
                    start, stop, i = 0, n % capacity or min(n, capacity), 0
                    while start < n:
                        own = ids[4 * start : 4 * stop]
                        row = (k, i, start, stop - start, zlib.crc32(own)) + ((np.frombuffer(own, "<i4"),) if with_ids else ())
                        for col, v in zip(cols, row):
                            col.append(v)
                        start, stop, i = stop, stop + capacity, i + 1
                kinds = (part.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(tidy(run, lambda: codec(path).forget()), f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, taken in the order given."""
    count = np.zeros(capacity + 1, np.int64)  # open bins per residual gap
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        gaps = size + np.flatnonzero(count[size:])
        rest = gaps - size
        # (n - 1)**2 - n**2 of the gap left and (m + 1)**2 - m**2 of the gap made; a filled bin is no longer open
        change = 1 - 2 * count[gaps] + np.where(rest > 0, 2 * count[rest] + 1, 0)
        if len(gaps):
            gap = int(gaps[change.argmin()])
            bin_ = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, bin_, made = capacity, made, made + 1
        bins[i], offsets[i] = bin_, capacity - gap
        if gap > size:
            open_at[gap - size].append(bin_)
            count[gap - size] += 1
    return bins, offsets


def pack(items: DataFrame, capacity: int = 2048, shard: int = SHARD) -> DataFrame:
    """Add sequence_id and offset to rows with a length of 1 to capacity."""
    names = items.columns
    shards = max(1, -(-items.filter(F.col("length") < capacity).count() // shard))
    full = items.filter(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    rest = items.filter(F.col("length") < capacity).withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["length", *[c for c in names if c != "length"]], ascending=[False] + [True] * (len(names) - 1), ignore_index=True)
        bins, g["offset"] = place(g["length"].to_numpy(), capacity)
        g["sequence_id"] = bins + g["shard"].astype("int64") * (1 << 32)
        return g[[*names, "sequence_id", "offset"]]

    return full.unionByName(rest.groupBy("shard").applyInPandas(run, full.schema))


def pack_documents(df: DataFrame, path: str, capacity: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, piece, start, length, ids_crc32, sequence_id, offset of each piece."""
    return pack(stored(pieces(df, path, capacity, key, text, with_ids=False), "pieces"), capacity)
