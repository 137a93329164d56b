"""Decontamination, whitening and hard negatives against brute force, and the SQL of the corpus queries."""

from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from aeros.llm import negatives, suffixes, whitening
from aeros.llm import queries as corpus

SF = "/root/testdata/sf0.001"


# ---- decontamination ----


def words_of(text):
    return (text or "").encode().translate(suffixes._WORD).split()


def brute_hits(texts, items, window=10):
    """(words, hit words, items) of each text."""
    owners = {}
    for item, text in items:
        w = words_of(text)
        k = min(window, len(w))
        for j in range(len(w) - k + 1) if w else ():
            owners.setdefault(tuple(w[j : j + k]), set()).add(item)
    out = []
    for text in texts:
        w, met = words_of(text), set()
        hit = [0] * len(w)
        for k in range(1, window + 1):
            for j in range(len(w) - k + 1):
                if own := owners.get(tuple(w[j : j + k])):
                    met |= own
                    hit[j : j + k] = [1] * k
        out.append((len(w), sum(hit), sorted(met)))
    return out


def passages_and_texts(rng):
    words = [f"w{i}" for i in range(rng.choice([2, 3, 5, 30, 3000]))]
    items = [(str(i), " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 5, 9, 10, 11, 14, 25, 40])))) for i in range(rng.randint(0, 8))]
    texts = []
    for _ in range(rng.randint(1, 8)):
        parts = []
        for _ in range(rng.randint(0, 5)):
            if items and rng.random() < 0.6:
                own = rng.choice(items)[1].split()
                at = rng.randint(0, len(own))
                parts += own[at : at + rng.randint(0, 30)]
            parts += [rng.choice([*words, "zz", "ü"]) for _ in range(rng.randint(0, 9))]
        texts.append(" ".join(parts))
    return items, texts


@pytest.mark.parametrize("piece,chunk", [(3 << 20, 1 << 20), (5, 3), (50, 20)])
def test_suffix_arrays_match_brute_force(monkeypatch, piece, chunk):
    """Shards in one piece and in short overlapping ones, words cut at any place."""
    monkeypatch.setattr(suffixes, "PIECE", piece)
    rng = random.Random(piece)
    for _ in range(60):
        items, texts = passages_and_texts(rng)
        p = suffixes.Passages(items)
        ids, starts = suffixes.word_ids([t.encode() for t in texts], p, chunk)
        runs, sets = suffixes.matches(ids, starts, p)
        sizes = np.diff(np.append(starts, len(ids))) - 1
        assert [(int(n), int((r[:, 1] - r[:, 0]).sum()), p.owners(s) if s else []) for n, r, s in zip(sizes, runs, sets)] == brute_hits(texts, items)


def test_every_suffix_has_its_longest_match():
    rng = random.Random(4)
    for _ in range(40):
        items, texts = passages_and_texts(rng)
        p = suffixes.Passages(items)
        ids, _ = suffixes.word_ids([t.encode() for t in texts], p)
        array = suffixes.SuffixArray(ids, p.bits, p.per, p.depth)
        at = np.flatnonzero(p.ids)
        length, where = array.longest(p, at)
        for i, n, w in zip(at.tolist(), length.tolist(), where.tolist()):
            own = p.ids[i : i + p.left[i]].tolist()
            assert n == max((next((k for k, (a, b) in enumerate(zip(own, ids[x:].tolist())) if a != b), min(len(own), len(ids) - x)) for x in range(len(ids))), default=0)
            assert ids[w : w + n].tolist() == own[:n] if n else w == -1


ITEMS = [(1, "One two three, four five six seven EIGHT nine ten eleven"), (2, "short item"), (3, "one two three four five six seven eight nine ten"), (2, "a second text of item two"), (None, "no id"), (5, None), (6, "?! --"), (7, "ünï cödé")]
TEXTS = [None, "", "x ONE two three four-five six seven eight nine ten eleven y", "a short item", "one two three four five six seven eight nine", "no id", "ünï;cödé Ünï cödé", "short  Item"]


def item_frame(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("most", [suffixes.BLOCK, 250])
def test_decontamination_frames(spark, monkeypatch, most):
    """Nulls, empty and repeated rows, columns with the operator's own names; items in one block and in four."""
    monkeypatch.setattr(suffixes.blocks, "__defaults__", ("item_id", "text", 10, most))
    texts = [*TEXTS, TEXTS[2]]
    rows = [(i if i < len(TEXTS) else None, t, 1, 2, 3) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, hits int, n_words int")
    want = brute_hits(texts, [(str(i), t) for i, t in ITEMS if i is not None])
    got = suffixes.digests(docs, item_frame(spark)).collect()
    digest = lambda own: hashlib.sha256(",".join(own).encode()).hexdigest()
    assert sorted(map(tuple, got), key=str) == sorted([(r[0], n, h, len(own), digest(own), h > 0) for r, (n, h, own) in zip(rows, want)], key=str)
    left = suffixes.decontaminated(docs, item_frame(spark))
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [0, 1, 4, 5]
    spans = {r["row"]["doc_id"]: [tuple(s) for s in r["hits"]] for r in suffixes.found(docs.filter("doc_id is not null"), item_frame(spark), ["doc_id"]).collect()}
    assert spans[2] == [(1, 12)] and spans[3] == [(1, 3)] and spans[6] == [(0, 2)]


def test_decontamination_of_empty_tables_and_long_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    nothing = item_frame(spark).limit(0)
    assert [(r["n_hit"], r["n_items"]) for r in suffixes.digests(docs, nothing).collect()] == [(0, 0)] * 2
    assert suffixes.digests(docs.limit(0), item_frame(spark)).collect() == []
    assert suffixes.longest_matches(docs, nothing).collect() == []
    monkeypatch.setattr(suffixes, "PIECE", 1000)
    passage = " ".join(ITEMS[2][1].split())
    long = " ".join(["filler"] * 4990 + [passage] + ["filler"] * 5000)
    r = suffixes.digests(spark.createDataFrame([(1, long)], docs.schema), item_frame(spark)).first()
    assert (r["n_words"], r["n_hit"], r["n_items"]) == (10_000, 10, 2)


def test_longest_matches(spark):
    docs = spark.createDataFrame([(5, "two three four"), (3, "five six three four five six zz")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three four five six seven"), (2, "nothing here")], "item_id long, text string")
    assert [tuple(r) for r in suffixes.longest_matches(docs, items).collect()] == [("1", 2, 4, 3, 2)]


# ---- whitening ----


def spectra():
    rng = np.random.default_rng(0)
    flat, steep = rng.standard_normal((900, 64)), rng.standard_normal((900, 120)) * np.linspace(1, 0.05, 120)
    turned = np.linalg.qr(rng.standard_normal((70, 70)))[0]
    few = rng.standard_normal((3, 50))
    return [flat.T @ flat / 900, steep.T @ steep / 900, turned @ np.diag(10.0 ** -np.linspace(0, 12, 70)) @ turned.T, few.T @ few, np.eye(40), np.zeros((5, 5)), np.diag([1.0] * 5 + [0.0] * 20), np.diag([1e6, 1e-6, 1e-9, 1.0]), np.array([[2.0]])]


@pytest.mark.parametrize("case", range(9))
@pytest.mark.parametrize("block,steps", [(24, 5), (4, 8)])
def test_eigenpairs(case, block, steps):
    v = spectra()[case]
    products = []

    def product(b):
        products.append(b.shape[1])
        return v @ b

    pairs = whitening.eigenpairs(product, len(v), 32, block, steps)
    want = np.linalg.eigvalsh(v)[::-1][:32]
    top = max(want[0], 1e-300)
    assert len(pairs.values) == min(32, len(v)) and pairs.products == len(products)
    assert np.abs(pairs.values - want).max() <= 1e-13 * top
    assert pairs.residuals.max() <= 1e-13 * top
    assert np.abs(pairs.vectors.T @ pairs.vectors - np.eye(len(want))).max() < 1e-13
    assert max(products) <= 32  # the search space itself, then blocks


def test_corrections_solve_the_projected_equation():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, 30)) * np.linspace(2, 0.5, 30)
    v = x.T @ x / 500
    off, _ = np.linalg.qr(rng.standard_normal((30, 4)))
    r = rng.standard_normal((30, 3))
    theta = np.array([9.0, 5.0, 4.5])
    t = whitening.corrections(lambda b: v @ b, theta, r, off, 60, 1e-12)
    p = np.eye(30) - off @ off.T
    for i in range(3):
        assert np.abs(p @ (v - theta[i] * np.eye(30)) @ p @ t[:, i] + p @ r[:, i]).max() < 1e-9 and np.abs(off.T @ t[:, i]).max() < 1e-12


def brute_whitened(vectors, k):
    x = np.floor(64 * np.array(vectors, dtype=float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    return ((n * x - s) ** 2).sum(axis=1), c @ u[:, ::-1][:, :k] / np.sqrt(e[::-1][:k]), e[::-1][:k] / e.sum()


@pytest.mark.parametrize("n,dims,k", [(200, 40, 32), (90, 6, 32), (60, 5, 2)])
def test_whitened(spark, n, dims, k):
    rng = np.random.default_rng(n)
    vectors = (rng.standard_normal((n, dims)) * np.linspace(3, 1, dims) + 100).astype(np.float32).tolist()
    bad = [None, [1.0] * (dims - 1) + [None], [float("nan")] * dims, [float("inf")] * dims, [1e30] * dims]
    rows = [(i if i else None, v, i, "x") for i, v in enumerate(vectors)] + [(1000 + i, v, 0, "x") for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int, x string").repartition(5)
    out = whitening.whitened(df, k).toPandas().fillna({"vec_id": 0}).sort_values(["vec_id", "component"])
    k = min(k, dims)
    deviation, want, explained = brute_whitened(vectors, k)
    assert len(out) == n * k and (out["n"] == n).all() and out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-10
    got = out["whitened"].to_numpy().reshape(n, k)
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-8
    assert (out["deviation"].to_numpy().reshape(n, k) == deviation[:, None]).all()
    assert np.abs(out["explained"].to_numpy().reshape(n, k) / explained - 1).max() < 1e-10


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []
    one = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0])], schema)).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None), (2, 0, None, None, None)]
    # repeated rows, shorter vectors, one direction only
    rows = [(1, [1.0, 5.0]), (1, [1.0, 5.0]), (2, [3.0, 5.0]), (3, [2.0, 5.0]), (4, [2.0, 5.0, 0.0])]
    out = sorted(whitening.whitened(spark.createDataFrame(rows, schema)).collect(), key=lambda r: (r["component"], r["vec_id"]))
    first = [r for r in out if r["component"] == 1]
    assert len(out) == 15 and all(r["whitened"] is None for r in out if r["component"] > 1)
    assert first[0]["whitened"] == first[1]["whitened"] and first[0]["explained"] == pytest.approx(1.0)
    assert sum(r["whitened"] ** 2 for r in first) / 5 == pytest.approx(1.0)
    assert whitening._squares(np.array([[1 << 31, 1]])) == [(1 << 62) + 1] and whitening._squares(np.array([[1 << 32, 1]])) == [None]


# ---- hard negatives ----


def brute_negatives(rows, is_anchor, positives=5, count=10, band=(30, 90)):
    out = []
    for a, la, xa in rows:
        if not is_anchor(a):
            continue
        scores = [(int(xa @ x), i, label) for i, label, x in rows if i != a]
        best = sorted((-s, i) for s, i, label in scores if label == la)[:positives]
        for s, p in best:
            fits = sorted((-t, i) for t, i, label in scores if label != la and band[0] * -s <= 100 * t <= band[1] * -s)[:count]
            out += [(a, p, rank, i, -s, -t) for rank, (t, i) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("n,dims,labels,kind", [(300, 16, 4, "flat"), (300, 64, 3, "steep"), (120, 4, 2, "ties"), (150, 8, 2, "copies"), (9, 3, 2, "flat"), (60, 5, 1, "flat"), (80, 6, 3, "zeros")])
@pytest.mark.parametrize("cells", [1 << 21, 3000])
def test_negatives_match_brute_force(spark, monkeypatch, n, dims, labels, kind, cells):
    """Flat and steep spectra, many ties, a third of all rows alike, a single label; one shard and many."""
    monkeypatch.setattr(negatives, "CELLS", cells)
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    rng = np.random.default_rng(n + dims)
    x = {"flat": lambda: rng.standard_normal((n, dims)), "steep": lambda: rng.standard_normal((n, dims)) * np.geomspace(1, 0.01, dims), "ties": lambda: rng.integers(-1, 2, (n, dims)) / 8, "copies": lambda: rng.standard_normal((n, dims)), "zeros": lambda: rng.standard_normal((n, dims)) * (rng.random((n, dims)) < 0.3)}[kind]()
    if kind == "copies":
        x[: n // 3] = x[0]
    ids = rng.permutation(n) * 3 - 20
    own = rng.integers(0, labels, n)
    df = spark.createDataFrame([(int(i), v, int(y), 1) for i, v, y in zip(ids, x.tolist(), own)], "vec_id long, embedding array<double>, label int, shard int").repartition(3)
    got = sorted(map(tuple, negatives.mined(df, F.col("vec_id") % 4 == 0, F.col("label")).collect()))
    rows = [(int(i), int(y), np.floor(256 * v).astype(np.int64)) for i, v, y in zip(ids, x, own)]
    assert got == brute_negatives(rows, lambda i: i % 4 == 0)


def test_negatives_frames(spark):
    """Nulls, non-finite components, repeated ids, shorter vectors, tables without anchors or rows."""
    schema = "vec_id long, embedding array<double>, label int"
    rows = [(0, [1.0, 0.0, 0.0], 1), (1, [1.0], 1), (2, [0.5, 0.1, 0.0], 2), (2, [0.6, 0.1, 0.0], 2), (3, [0.5], None), (None, [0.5], 2), (4, None, 2), (5, [0.5, None], 2), (6, [float("nan")], 2), (7, [float("inf")], 2), (8, [-1.0], 1)]
    df = spark.createDataFrame(rows, schema)
    anchor = F.col("vec_id") == 0
    assert [tuple(r) for r in negatives.mined(df, anchor, F.col("label")).collect()] == [(0, 1, 1, 2, 65536, 32768)]
    assert negatives.mined(df, F.lit(False), F.col("label")).collect() == negatives.mined(df.limit(0), anchor, F.col("label")).collect() == []
    assert negatives.mined(df.filter("label = 1"), anchor, F.col("label")).collect() == []


def test_lists_are_left_out_for_high_thresholds():
    """Of vectors with uneven components few postings are taken, and few rows are scored exactly."""
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.standard_normal((4000, 64)) * np.geomspace(1, 0.01, 64)).astype(np.int64)
    lists = negatives.Lists(np.arange(4000), rng.integers(0, 5, 4000), x)
    for a in range(20):
        part = negatives.Partial(lists, x[a])
        score = int((x @ x[a]).max() * 0.6)
        part.window(lists.labels != lists.labels[a], int(0.3 * score), int(0.9 * score), 10)
    assert lists.opened < 0.3 * 20 * x.size and lists.scored < 0.2 * 20 * len(x)


# ---- SQL ----


@pytest.mark.parametrize("name", sorted(corpus.ORACLES))
def test_corpus_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = corpus.QUERIES[name](spark, SF)
    result = con.execute(corpus.ORACLES[name])
    have = [c[0] for c in result.description]
    assert sorted(have) == sorted(df.columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*have).collect()))) == sorted(map(str, result.fetchall()))
