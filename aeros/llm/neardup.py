"""Near-duplicate components by MinHash bands and sequential Bayesian verification.

1. One pass over the texts gives each its distinct word shingles (as 64-bit hashes), a 128-bit digest of that
   set and MinHash band keys. Equal sets become one node; nodes that share an id are linked.
2. Nodes that share a band key are candidates. In each bucket all are compared with its most central member
   (the one that shares most buckets with others), which costs one pair a member.
3. A pair's signatures are compared batch by batch. It is dropped once the posterior probability that its
   similarity reaches the threshold falls below MISS; survivors are checked on their full sets.
4. Buckets whose members are not yet all in one component are searched whole, block against block, by the same
   test; buckets that share members are searched together. A block gives only links that join two components, and is
   bounded both in members and in shingles.

A pair at the threshold shares no band with probability (1 - 0.8**6)**40 = 5e-6, less above it.

Null and empty texts, and texts of white space, have an empty set and are linked with nothing. Rows with a null
id are nodes of no component: component_id is null and they are kept. Repeated rows are one node; rows of one id with
different texts are one document, in one component (but for those with an empty set, each its own). Of such rows
keep_first keeps one, with the smallest text. Columns besides the id and the text play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, slices, stored, tidy

BANDS, ROWS = 40, 6
HASHES = BANDS * ROWS
#: Signature positions compared at a time, and the chance of losing a true pair that each stop may take.
BATCH, MISS = 40, 1e-7
#: Members and shingles of a block of one bucket; members up to which a bucket's join goes by the bucket alone.
BLOCK, BLOCK_SHINGLES, SALT = 256, 1 << 18, 4096
#: Pairs of one pivot that meet one copy of its set.
PIVOT_PAIRS = 512
_RNG = np.random.default_rng(7)
_A = _RNG.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_M = np.uint64(0x9E3779B97F4A7C15)
_N = np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _N
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; with fewer words, of the whole sequence."""
    words = text.lower().split() if text else []  # bytes: A-Z alone are lowered, ASCII white space alone splits
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(size, len(words))
    run = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        run = _mix(run * _M + h[j : len(h) - k + 1 + j])
    return np.unique(run)


def signature(items: np.ndarray) -> np.ndarray:
    """The smallest value of each of HASHES permutations over the set."""
    x = (items >> np.uint64(32)).astype(np.uint32)
    out = np.empty(HASHES, np.uint32)
    step = max(1, min(HASHES, 200_000 // max(1, len(x))))
    for i in range(0, HASHES, step):
        y = _A[i : i + step, None] * x[None, :]
        y ^= y >> np.uint32(15)
        y *= _B[i : i + step, None]
        y ^= y >> np.uint32(13)
        out[i : i + step] = y.min(axis=1)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = _mix(key * _M + rows[:, j])
    return key.view(np.int64)


def fewest_matches(share: float) -> list[tuple[int, int]]:
    """(compared, matches below which a pair is dropped) after each batch.

    With a uniform prior, m matches of n leave a Beta(m + 1, n - m + 1) posterior; its mass above `share` is the
    chance that n + 1 draws with that share give at most m hits.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        mass, m = 0.0, -1
        while mass < MISS:
            m += 1
            mass += math.comb(n + 1, m) * share**m * (1 - share) ** (n + 1 - m)
        out.append((n, m))
    return out


def likely(left: np.ndarray, right: np.ndarray, share: float) -> np.ndarray:
    """Indices of the signature pairs that no batch rules out."""
    alive, hits = np.arange(len(left)), np.zeros(len(left), np.int32)
    for n, least in fewest_matches(share):
        if not len(alive):
            break
        at = slice(n - BATCH, n)
        hits[alive] += (left[alive, at] == right[alive, at]).sum(axis=1, dtype=np.int32)
        alive = alive[hits[alive] >= least]
    return alive


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test on two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _signatures(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), np.uint32).reshape(-1, HASHES)


def describe(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """key, n_shingles, digest of the set (null if empty), band keys (null if empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 1)):
            n, digest, bands = [], [], []
            for t in b.column(1).cast(pa.binary()).to_pylist():
                s = shingles(t, size)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                bands.append(band_keys(signature(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["id", "n_shingles", "digest", "bands"])

    return df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(tidy(run), "id long, n_shingles long, digest binary, bands array<long>")


def sets(df: DataFrame, size: int) -> DataFrame:
    """digest, signature and shingles of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 0, 1 << 20)):
            found = [s for t in b.column(0).cast(pa.binary()).to_pylist() if len(s := shingles(t, size))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in ([xxhash.xxh3_128_digest(s.tobytes()) for s in found], [signature(s).tobytes() for s in found], [s.tobytes() for s in found])], names=["digest", "signature", "items"])

    return df.select("text").mapInArrow(tidy(run), "digest binary, signature binary, items binary")


def with_sets(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) with signatures and shingles of both sides and the copy of a's set (`salt`) that a pair meets.

    pairs is a stored table. Where an id is `a` of more than PIVOT_PAIRS pairs, they are dealt over copies of its set.
    """
    side = lambda x: found.select(F.col("id").alias(x), F.col("signature").alias(f"{x}_sig"), F.col("items").alias(f"{x}_items"))
    hot = pairs.groupBy("a").agg(F.ceil(F.count("*") / PIVOT_PAIRS).cast("int").alias("copies")).filter("copies > 1")
    hot = small(stored(hot, "hot"))
    copies = F.coalesce("copies", F.lit(1))
    dealt = pairs.join(hot, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), copies).cast("int").alias("salt"))
    pivots = side("a").join(hot, "a", "left").select("a", "a_sig", "a_items", F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt"))
    return dealt.join(side("b"), "b").join(pivots, ["a", "salt"])


def verify(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets pass: signatures batch by batch, then the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            if b.num_rows:
                left, right = (_signatures(b.column(f"{x}_sig").to_pylist()) for x in "ab")
                for i in likely(left, right, percent / 100):
                    sa, sb = (np.frombuffer(b.column(f"{x}_items")[int(i)].as_py(), np.uint64) for x in "ab")
                    if linked(sa, sb, percent):
                        keep.append(int(i))
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(keep, pa.int64())), b.column("b").take(pa.array(keep, pa.int64()))], names=["a", "b"])

    return with_sets(pairs, found).select("a", "b", "a_sig", "b_sig", "a_items", "b_items").mapInArrow(tidy(run), "a long, b long")


def _root(up: list[int], i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def block_links(g: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links within one block, or between its two sides, that join components; pairs already joined are passed over."""
    g = g.drop_duplicates(["id", "side"]).reset_index(drop=True)
    sig, items = _signatures(list(g["signature"])), [np.frombuffer(x, np.uint64) for x in g["items"]]
    comp, names = pd.factorize(g["component"])
    side, ids, up, out = g["side"].to_numpy(), g["id"].to_numpy(), list(range(len(names))), []
    first = np.flatnonzero(side == 0)
    for i in np.flatnonzero(side == 1) if side.any() else range(1, len(g)):
        others = first if side.any() else np.arange(i)
        others = others[comp[others] != comp[i]]
        if len(others):
            for j in others[likely(np.broadcast_to(sig[i], (len(others), HASHES)), sig[others], percent / 100)]:
                x, y = _root(up, int(comp[i])), _root(up, int(comp[j]))
                if x != y and linked(items[i], items[j], percent):
                    up[x] = y
                    out.append((ids[j], ids[i]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that links reach from each linked id.

    In each round an id takes the smallest label among its own, its neighbours' and its label's label, so the rounds
    grow with the logarithm of the longest chain. Each round's labels are a table in the shared folder.
    """
    both = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("m")).select("id", F.least("id", "m").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "v"), "v").groupBy(F.col("u").alias("id")).agg(F.min("component").alias("near"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("next"))
        new = labels.join(jump, "component").join(near, "id").select("id", F.col("component").alias("was"), F.least("component", "next", "near").alias("component"))
        new = stored(new, "labels")
        changed = new.filter("component <> was").limit(1).count()
        labels = new.select("id", "component")
        if not changed:
            return labels


def _open_pairs(placed: DataFrame) -> DataFrame:
    """Rows (group, x, y, side, id, component) for the block search of buckets (band, n, rep, component) still open.

    Rows of placed: band, rep, component and size (its shingles). Buckets that share members are one group, searched as a whole where that takes fewer rows than bucket by bucket.
    In a group, members of its largest component are never compared with each other: they meet only the rest.
    """
    several = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("rep").alias("head")).filter("low <> high")
    rows = stored(placed.join(small(stored(several.select("band", "head"), "several")), "band"), "open")
    if not rows.limit(1).count():
        return rows.select(F.lit(0).alias("group"), F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(0).alias("side"), F.col("rep").alias("id"), "component").limit(0)
    # buckets are named by their smallest member; a member links the names of its buckets
    names = stored(rows.groupBy("rep").agg(F.collect_set("head").alias("heads")), "names")
    pairs = names.select(F.array_min("heads").alias("a"), F.explode("heads").alias("b")).filter("a <> b").distinct()
    whole = smallest_reachable(pairs).select(F.col("id").alias("first"), F.col("component").alias("whole"))
    of_member = names.select("rep", F.array_min("heads").alias("first")).join(whole, "first", "left").select("rep", F.coalesce("whole", "first").alias("whole"))
    tagged = stored(rows.join(of_member, "rep"), "tagged")
    cost = lambda n: n * F.ceil(n / BLOCK)
    apart = tagged.groupBy("whole", "band").agg(F.count("*").alias("m")).groupBy("whole").agg(F.sum(cost(F.col("m"))).alias("apart"))
    sizes = tagged.select("whole", "rep").distinct().groupBy("whole").agg(F.count("*").alias("m"))
    joint = stored(apart.join(sizes, "whole").select("whole", (cost(F.col("m")) <= F.col("apart")).alias("joint")), "joint")
    members = stored(tagged.join(joint, "whole").select(F.when(F.col("joint"), F.col("whole")).otherwise(F.col("band")).alias("group"), "joint", "rep", "component", "size").distinct(), "groups")
    keys = ["group", "joint"]
    per = members.groupBy(*keys, "component").agg(F.count("*").alias("m"), F.sum("size").alias("size"))
    blocks = lambda m, size: F.ceil(F.greatest(m / BLOCK, size / BLOCK_SHINGLES)).cast("int")
    whole_group = per.groupBy(*keys).agg(F.sum("m").alias("all"), F.sum("size").alias("sizes"), F.max(F.struct("m", "component", "size")).alias("top"))
    largest = stored(whole_group.select(*keys, F.col("top.component").alias("main"), blocks(F.col("top.m"), F.col("top.size")).alias("mains"), blocks(F.col("all") - F.col("top.m"), F.col("sizes") - F.col("top.size")).alias("rests")), "largest")
    is_main = F.col("component") == F.col("main")
    own = F.pmod(F.xxhash64("rep"), F.when(is_main, F.col("mains")).otherwise(F.col("rests"))).cast("int")
    to = lambda n: F.sequence(F.lit(0), n - 1)
    meet = lambda x, y, side: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), F.lit(side).alias("side"))
    with_rest = F.transform(to(F.col("rests")), lambda r: meet(r, F.col("own"), 0))
    # y of -1 - block stands for another block of the rest
    among = F.transform(to(F.col("rests")), lambda r: F.struct(F.least(r, F.col("own")).cast("int").alias("x"), (-1 - F.greatest(r, F.col("own"))).cast("int").alias("y"), F.when(r < F.col("own"), 1).otherwise(0).alias("side")))
    rest = F.concat(F.transform(to(F.col("mains")), lambda m: meet(F.col("own"), m, 1)), among)
    dealt = members.join(largest, keys).withColumn("own", own)
    return dealt.select(F.xxhash64(*keys).alias("group"), F.col("rep").alias("id"), "component", F.inline(F.when(is_main, with_rest).otherwise(rest)))


def components(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of df: key, n_shingles, component_id (smallest id reachable over links, itself included), kept.

    size: words in a shingle; percent: least 100 * intersection / union of a link.
    """
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = stored(describe(docs, "id", "text", size), "shingles")
    named = rows.filter("digest is not null and id is not null")
    nodes = named.groupBy("digest").agg(F.min(F.struct("id", "n_shingles", "bands")).alias("m"))
    # numbers stay as they are, since the table is written
    nodes = stored(nodes.select("digest", F.monotonically_increasing_id().alias("rep"), F.col("m.id").alias("id"), F.col("m.n_shingles").alias("size"), F.col("m.bands").alias("bands")), "nodes")

    keys = nodes.select("rep", "size", F.explode("bands").alias("band"))
    shared = stored(keys.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    members = stored(keys.join(small(shared), "band"), "members")
    weight = stored(members.groupBy("rep").agg(F.sum("n").alias("weight")), "weights")
    ranked = members.select("rep", "band", "n").join(weight, "rep")
    pivots = stored(ranked.groupBy("band").agg(F.max(F.struct("weight", (-F.col("rep")).alias("rep"))).alias("m"), F.first("n").alias("n")).select("band", "n", (-F.col("m.rep")).alias("pivot")), "pivots")
    # the members of a large bucket are dealt over several copies of its pivot
    copies = F.ceil(F.col("n") / SALT).cast("int")
    salted = members.select("rep", "band", F.pmod(F.xxhash64("rep"), copies).cast("int").alias("salt"))
    asked = small(stored(pivots.select("band", "pivot", F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt")), "asked"))
    pairs = stored(salted.join(asked, ["band", "salt"]).filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")

    candidates = nodes.join(weight, "rep").select("digest", "rep", "id")
    texts = docs.join(small(stored(candidates.select("id").distinct(), "candidates")), "id")
    found = stored(sets(texts, size).dropDuplicates(["digest"]).join(candidates.select("digest", F.col("rep").alias("id")), "digest").select("id", "signature", "items"), "sets")
    links = stored(verify(pairs, found, percent).union(_same_id(named, nodes)), "verified")
    labels = smallest_reachable(links)

    # of a bucket of two, the pair has been checked
    placed = members.filter("n > 2").join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("band", "rep", "size", F.coalesce("component", "rep").alias("component"))
    to_search = _open_pairs(stored(placed, "placed"))
    more = to_search.join(found, "id").select("group", "x", "y", "side", "id", "component", "signature", "items").groupBy("group", "x", "y").applyInPandas(lambda g: block_links(g, percent), "a long, b long")
    more = stored(more.distinct(), "links")
    if more.limit(1).count():
        labels = smallest_reachable(links.union(more))

    # a component is named by its smallest id
    in_component = nodes.select("digest", "rep", "id").join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("digest", "id", F.coalesce("component", "rep").alias("component"))
    in_component = stored(in_component, "placed")
    names = in_component.groupBy("component").agg(F.min("id").alias("component_id"), F.count("*").alias("m"))
    several = stored(names.filter("m > 1").select("component", "component_id"), "several")
    named_digests = in_component.join(small(several), "component", "left").select("digest", F.coalesce("component_id", "id").alias("component_id"))
    out = rows.select("id", "n_shingles", "digest").join(stored(named_digests, "named"), "digest", "left")
    place = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(key), "n_shingles", place.alias("component_id")).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def _same_id(named: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the nodes of each id that has several texts."""
    several = named.groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low <> high")
    several = stored(several.select("id", "low"), "several")
    if not several.limit(1).count():
        return several.select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).limit(0)
    others = named.join(several, "id").filter("digest <> low").select("low", "digest").distinct()
    number = nodes.select("digest", "rep")
    return others.join(number.withColumnRenamed("rep", "a").withColumnRenamed("digest", "low"), "low").join(number.withColumnRenamed("rep", "b"), "digest").select("a", "b")


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of df without those that have a smaller id in their component, one row for each id that repeats."""
    found = components(df, key, text, size, percent).select(F.col(key).alias("id"), "kept")
    state = found.filter("id is not null").groupBy("id").agg(F.count("*").alias("m"), F.bool_and("kept").alias("kept")).filter("m > 1 or not kept")
    state = stored(state.select("id", "kept"), "dropped")
    own = df.select(F.col(key).cast("long").alias("id"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    once = own.join(state, "id", "left_anti").select("row")
    if state.filter("kept").limit(1).count():
        repeated = own.join(state.filter("kept"), "id", "left_semi").groupBy("id").agg(F.min_by("row", F.struct(F.col("row")[text].isNull(), F.col("row")[text], F.to_json("row"))).alias("row"))
        once = once.union(repeated.select("row"))
    return once.select("row.*")
