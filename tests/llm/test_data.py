"""Near-duplicates, top-k, WARC, context-tree weighting, toxicity and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aeros.llm import ctw, neardup, pii, topk, toxicity, warc
from aeros.llm.common import table

SF = "/root/testdata/sf0.001"


def brute_components(docs, size, percent=80):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        k = min(size, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = [i for i in sets if sets[i]]
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_copies(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = [None, "", "  \n", "one", "one", "One", "one two", "two one", "x" * 3000]
    for _ in range(6):
        base = [rng.choice(words) for _ in range(rng.randint(30, 90))]
        for _ in range(rng.randint(3, 25)):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = rng.choice(words)
            docs.append(" ".join(own))
    docs += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("size,block", [(2, 256), (2, 4), (5, 256)])
def test_components_match_brute_force(spark, monkeypatch, size, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "PIVOT_PAIRS", 3 if block < 256 else 512)
    docs = near_copies()
    df = spark.createDataFrame([(i, t, "d", i) for i, t in docs], "doc_id long, text string, digest string, band long")
    want = brute_components(docs, size)
    got = {r["doc_id"]: r for r in neardup.components(df, size=size).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_pairs_of_a_hot_pivot_are_dealt_over_copies_of_its_set(spark):
    """3000 pairs of one pivot and a few of another: each pair once, no key with many more than PIVOT_PAIRS."""
    pairs = neardup.stored(spark.range(1, 3001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b")).union(spark.range(2, 6).selectExpr("1L", "id")), "pairs")
    found = spark.range(3001).selectExpr("id", "CAST(CAST(id AS STRING) AS BINARY) AS signature", "CAST('x' AS BINARY) AS items")
    rows = neardup.with_sets(pairs, found).selectExpr("a", "b", "salt", "CAST(a_sig AS STRING) AS x", "CAST(b_sig AS STRING) AS y").collect()
    assert sorted((r["a"], r["b"]) for r in rows) == sorted([(0, i) for i in range(1, 3001)] + [(1, i) for i in range(2, 6)])
    assert all((r["x"], r["y"]) == (str(r["a"]), str(r["b"])) for r in rows)
    per = defaultdict(int)
    for r in rows:
        per[r["a"], r["salt"]] += 1
    assert max(per.values()) <= 1.25 * neardup.PIVOT_PAIRS and per[1, 0] == 4


def test_components_edges(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "a b c")], "doc_id long, text string")
    rows = neardup.components(df, size=2).collect()
    assert len(rows) == 4 and sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in rows) == [("1", "1", True), ("1", "1", True), ("2", "1", False), ("None", "None", True)]
    assert neardup.components(df.limit(0)).count() == 0
    assert sorted(str(r["doc_id"]) for r in neardup.keep_first(df, size=2).collect()) == ["1", "None"]
    assert neardup.keep_first(df.limit(0)).columns == df.columns


def test_components_of_ids_with_several_texts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 200)
    a, b, long_ = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60)), " ".join(f"c{i}" for i in range(30_000))
    rows = [(5, a), (5, b), (9, b + " more"), (3, a + " less"), (5, ""), (5, None), (7, long_), (8, long_ + " end"), (6, "other words"), (6, "other words")]
    df = spark.createDataFrame([(*r, "x", 1.5) for r in rows], "doc_id long, text string, rep string, component double")
    got = {(r["doc_id"], r["n_shingles"] > 0): r["component_id"] for r in neardup.components(df, size=2).collect()}
    assert got == {(5, True): 3, (9, True): 3, (3, True): 3, (5, False): 5, (7, True): 7, (8, True): 7, (6, True): 6}
    kept = neardup.keep_first(df, size=2)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 6, 7] and kept.columns == df.columns


def test_posterior_bounds():
    table_ = neardup.fewest_matches(0.8)
    assert table_[0][0] == 40 and all(0 < m < n for n, m in table_)
    hits = np.random.default_rng(1).random((2000, neardup.HASHES)) < 0.8
    assert len(neardup.likely(hits.astype(np.uint32), np.ones_like(hits, np.uint32), 0.8)) == 2000


@pytest.mark.parametrize("n,dims,spread", [(400, 8, 1000), (900, 16, 3), (60, 4, 2), (15, 3, 0), (1, 3, 5)])
def test_index_is_exact(n, dims, spread):
    rng = np.random.default_rng(n)
    x, ids = rng.integers(-spread, spread + 1, (n, dims)), rng.permutation(n * 3)[:n]
    index, m = topk.Index(ids, x), min(n, 130)
    place, found, scores = index.search(x[:m], ids[:m], 10)
    for row in range(m):
        every = x @ x[row]
        want = sorted((-int(every[i]), int(ids[i])) for i in range(n) if i != row)[:10]
        assert [(-int(s), int(i)) for p, i, s in zip(place, found, scores) if p == row] == want


def test_queries_stop_on_proof():
    """Vectors of few large components: the first strata prove the rest out."""
    rng = np.random.default_rng(2)
    x = np.where(rng.random((3000, 24)) < 0.1, rng.integers(800, 1000, (3000, 24)), rng.integers(-3, 4, (3000, 24)))
    index = topk.Index(np.arange(3000), x)
    index.search(x[:50], np.arange(50), 10)
    assert index.taken <= 50 * sum(index.postings[:1]) and sum(index.postings) < 3000 * 24 * 0.2


def test_search_frames(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 70)
    monkeypatch.setattr(topk, "QUERIES", 2)
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(0, 0.3, 6).round(3)]) for i in range(300)]
    bad = [(1000, None), (1100, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (1200, [float("nan")] + [0.0] * 5), (1300, [float("inf")] + [0.0] * 5), (None, [0.5] * 6)]
    twice = [rows[100], rows[100], rows[7], (9, [9.0] * 6)]  # of the last, the smaller vector counts
    df = spark.createDataFrame([(*r, "s") for r in rows + bad + twice], "vec_id long, embedding array<double>, score string")
    out = topk.search(df, F.col("vec_id") % 100 == 0).collect()
    whole = {i: [math.floor(1024 * v) for v in e] for i, e in rows}
    want = []
    for q in (0, 100, 200):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)[:10]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out) == sorted(want)
    assert topk.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_warc_round_trip(spark, tmp_path):
    same, crlf = "p" * 150, "line\r\n\r\nWARC/1.1\r\nend\r\n"
    pages = [(5, "http://a/\r\nx", same), (3, "http://b/", same), (9, None, same), (1, "http://c/", "short"), (2, "http://c/", "short"), (4, "http://d/", None), (6, "http://e/", "é" * 100), (7, "http://f/", crlf), (8, "", ""), (None, "http://g/", "x")]
    df = spark.createDataFrame([(*p, "n") for p in pages], "page_id long, url string, html string, digest string")
    rows = {r["page_id"]: r for r in warc.round_trip(df).collect()}
    for i, _, html in pages:
        raw = (html or "").encode()
        r = rows[i]
        assert (r["payload_bytes"], r["payload_digest"], r["digest_ok"]) == (len(raw), hashlib.sha256(raw).hexdigest(), True)
        later = html == same and i != 3
        assert (r["record_type"], r["refers_to"]) == (("revisit", 3) if later else ("response", None))
        assert r["request"]["concurrent_to"] == r["response"]["record_id"] == r["metadata"]["concurrent_to"]
    warc.write(df, str(tmp_path / "w"))
    payloads = {r["target"]: bytes(r["payload"]) for r in warc.records(spark, str(tmp_path / "w")).filter("type = 'response'").collect()}
    assert payloads["http://f/"] == crlf.encode()
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_members_and_sizes(spark, tmp_path, monkeypatch):
    """Every member is a record; files are cut by bytes; a record of over 16 MB; repeated ids; damage."""
    rng = random.Random(4)
    huge = "".join(rng.choice("abcdefgh") for _ in range(1 << 20)) * 17
    pages = [(i, f"http://{i}/", "".join(rng.choice("abcdefgh") for _ in range(60_000))) for i in range(40)] + [(40, "http://h/", huge), (1, "http://again/", "another payload"), (None, "http://none/", "n" * 120)]
    df = spark.createDataFrame([(*p, 1, "o") for p in pages], "page_id long, url string, html string, row int, owner string").coalesce(1)
    monkeypatch.setattr(warc, "FILE_BYTES", 200_000)
    warc.write(df, str(tmp_path / "w"))
    files = sorted((tmp_path / "w").rglob("part-*"))
    assert len(files) > 3
    seen = []
    for f in files:
        data = f.read_bytes()
        while data:
            one = zlib.decompressobj(31)
            record = one.decompress(data)
            assert one.eof and (not record or record.startswith(b"WARC/1.1\r\n"))
            seen += [record.split(b"\r\n")[1]] if record else []
            data = one.unused_data
        assert len(f.read_bytes()) < 400_000 or any(len(h) > 1 << 24 for _, h in warc._walk(f.read_bytes()))
    assert seen.count(b"WARC-Type: warcinfo") == len(files) and seen.count(b"WARC-Type: response") == len(pages)
    found = warc.captures(warc.records(spark, str(tmp_path / "w"), payloads=False))
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["digest_ok"]) for r in found.collect())
    assert got == sorted((str(i), len(h), hashlib.sha256(h.encode()).hexdigest(), True) for i, _, h in pages)
    record = b"".join(warc._transaction("1", 0, "t", b"payload", None, "d")).replace(b"\r\n\r\npayload", b"\r\n\r\npaylord")
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "part-0").write_bytes(record)
    assert [r["digest_ok"] for r in warc.captures(warc.records(spark, str(tmp_path / "x"))).collect()] == [False]


def brute_ctw(train, texts):
    """The same probabilities by recursion over dictionaries."""
    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)
    for t in train:
        data = ctw.END * ctw.DEPTH + b" ".join(ctw.words(t)) + ctw.END
        for i in range(ctw.DEPTH, len(data)):
            for d in range(ctw.DEPTH + 1):
                ctx = tuple(data[i - 1 - k] for k in range(d))
                for j in range(8):
                    node = (ctx, j, data[i] >> (8 - j))
                    counts[node][data[i] >> (7 - j) & 1] += 1
                    if d:
                        children[(ctx[:-1], j, node[2])].add(node)

    def kt(node):
        a, b = counts[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)

    known = {}

    def pw(node):
        if node not in known:
            own = kt(node)
            known[node] = own if len(node[0]) == ctw.DEPTH else float(np.logaddexp(own, sum(map(pw, children[node])))) - math.log(2)
        return known[node]

    def one(ctx, j, prefix, d=0):
        node = (ctx[:d], j, prefix)
        if node not in counts:
            return 0.5
        a, b = counts[node]
        own = (b + 0.5) / (a + b + 1)
        if d == ctw.DEPTH or (ctx[: d + 1], j, prefix) not in counts:
            return own
        weight = 1 / (1 + math.exp(min(700, sum(map(pw, children[node])) - kt(node))))
        return weight * own + (1 - weight) * one(ctx, j, prefix, d + 1)

    out = []
    for t in texts:
        data, total = ctw.END * ctw.DEPTH + b" ".join(ctw.words(t)) + ctw.END, 0.0
        for i in range(ctw.DEPTH, len(data)):
            ctx = tuple(data[i - 1 - k] for k in range(ctw.DEPTH))
            for j in range(8):
                p = one(ctx, j, data[i] >> (8 - j))
                total += math.log10(p if data[i] >> (7 - j) & 1 else 1 - p)
        out.append(total)
    return out


def test_ctw_matches_recursion(spark):
    texts = ["the cat sat on the mat", "The cat ran  on the\tmat and sat", "a dog sat", None, "", "zzz unseen words here", "the the the", "naïve café", "the cat sat on the mat"]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    learn = [i not in (2, 5) for i in range(len(texts))]
    rows = {r["doc_id"]: r for r in ctw.scores(df, ~F.col("doc_id").isin(2, 5)).collect()}
    raw = [t.encode() if t is not None else None for t in texts]
    want = brute_ctw([t for t, ok in zip(raw, learn) if ok], raw)
    tokens = [[*ctw.words(t), None] for t in raw]
    counts = defaultdict(int)
    for ts, ok in zip(tokens, learn):
        for t in ts if ok else ():
            counts[t] += 1
    total, kinds = sum(counts.values()), len(counts)
    for i, ts in enumerate(tokens):
        base = sum(math.log10((counts.get(t, 0) + 0.1) / (total + 0.1 * (kinds + 1))) for t in ts)
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (not learn[i], len(ts), sum(counts.get(t, 0) > 0 for t in ts), total)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(want[i], rel=1e-6)
    assert ctw.scores(df.limit(0), F.lit(True)).count() == 0
    alone = ctw.scores(df.filter("doc_id = 0"), F.lit(False)).first()
    assert alone["score"] == pytest.approx(-(len(texts[0]) + 1) * 8 * math.log10(2)) and alone["train_tokens"] == 0


def test_ctw_buckets_change_no_score(spark, tmp_path, monkeypatch):
    """Cut blocks, texts in buckets of their own, repeated ids and names that clash give the scores of one bucket."""
    texts = ["word%d and %s the end" % (i % 7, "some more text " * (i % 5)) for i in range(60)] + ["long text " * 3000, None, ""]
    rows = [(i // 2, t, "x", i, True) for i, t in enumerate(texts)] + [(3, texts[0], "x", 1, True)] * 2
    spark.createDataFrame(rows, "id long, text string, bucket string, row long, train boolean").coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = []
    for bucket_bytes, long in ((20 << 20, 1 << 20), (300, 2000), (300, 40)):
        monkeypatch.setattr(ctw, "BUCKET_BYTES", bucket_bytes)
        monkeypatch.setattr(ctw, "LONG", long)
        found.append(sorted(map(tuple, ctw.scores(df, F.col("id") % 5 != 0, key="id").collect())))
    found.append(sorted(map(tuple, ctw.scores(df.withColumn("_metadata", F.lit(1)), F.col("id") % 5 != 0, key="id").collect())))
    assert len(found[0]) == len(rows)
    for other in found[1:]:
        assert [r[:5] for r in other] == [r[:5] for r in found[0]]
        assert np.allclose([r[5:] for r in other], [r[5:] for r in found[0]], rtol=1e-5)


def test_kt_far():
    a, b = np.array([0, 1, 4095, 5000, 10**6]), np.array([0, 3, 4096, 20, 10**7])
    want = [math.lgamma(x + 0.5) + math.lgamma(y + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(x + y + 1) for x, y in zip(a.tolist(), b.tolist())]
    assert np.allclose(ctw.log_kt(a, b), want, rtol=1e-9, atol=1e-6)


def test_toxicity_learns(spark):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(500):
        words = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["flurb", "you idiot", "m0r0n", "zork"]))
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    docs += [(1000, None, "x"), (1001, "", "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    lab = spark.createDataFrame([*labels, (1000, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.learn(lab.filter("doc_id % 5 <> 2 OR doc_id IS NULL"), df)
    assert {"flurb", "zork"} <= {*model.lexicon}
    out = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    assert len(out) == 502 and all(0 <= s <= 1 for s in out.values()) and out[1000] == out[1001]
    held = [(out[i], y) for i, y in labels if i % 5 == 2]
    assert sum((s >= 0.3) == y for s, y in held) / len(held) > 0.9
    none = toxicity.learn(lab.limit(0), df)
    assert {r["score"] for r in toxicity.score(df, none).collect()} == {0.0}
    assert toxicity.score(df.limit(0), model).count() == 0


def _tree_value(text, x):
    """Prediction of one tree from its printed form: nested tests of a feature against a threshold."""
    lines = [x_.strip() for x_ in text.splitlines() if x_.strip().startswith(("If", "Else", "Predict"))]

    def walk(i):
        if lines[i].startswith("Predict"):
            return float(lines[i].split(":")[1]), i + 1
        _, feature, sign, bound = lines[i].strip("If ()").split(" ")
        left, i = walk(i + 1)
        right, i = walk(i + 1)
        return (left if (x[int(feature)] <= float(bound)) == (sign == "<=") else right), i

    return walk(0)[0]


def test_scores_match_printed_trees(spark):
    """Scores recomputed from the trees' printed form and the steps of the calibration, with extra columns and ties."""
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["you", "idiot", "Fine", "day", "GO", "m0ron!", "zork"][: 4 + i % 4]) for _ in range(rng.randint(1, 30))), 1.0) for i in range(150)]
    docs += [docs[5], (None, docs[5][1], 2.0), (900, None, 0.0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, prediction double").withColumns({"probability": F.lit(1), "features": F.lit("f"), "row": F.lit("r"), "raw": F.lit(2)})
    labels = spark.createDataFrame([(i, int("zork" in t or "idiot" in t)) for i, t, _ in docs[:150]], "doc_id long, toxic int")
    model = toxicity.learn(labels, df)
    printed = [t.toDebugString for t in model.trees.trees]
    weights, at, levels = model.trees.treeWeights, np.array(model.scale.boundaries.toArray()), np.array(model.scale.predictions.toArray())
    out = toxicity.scored(df, model, df.columns).select("row.*", "score").collect()
    assert len(out) == len(docs) and out[0].asDict().keys() == {*df.columns, "score"}
    for r in out:
        x = toxicity.features(r["text"], model.lexicon)
        raw = 1 / (1 + math.exp(-2 * sum(w * _tree_value(t, x) for w, t in zip(weights, printed))))
        assert r["score"] == pytest.approx(0.999 * float(np.interp(raw, at, levels)) + 0.001 * raw, abs=1e-6)
    assert len({r["score"] for r in out if r["text"] == docs[5][1]}) == 1


def test_pipeline_stages_with_odd_rows(spark):
    """Null ids, null and empty texts, repeated rows, empty tables, and columns with the names that stages use."""
    docs = table(spark, SF, "documents").limit(40)
    odd = spark.createDataFrame([(None, "same text of some words here", "en", "s", 28), (None, None, "en", "s", None), (7001, "", "en", "s", 0), (7002, "write to ann.19@mail5.example.com", "en", "s", 33), (7002, "write to ann.19@mail5.example.com", "en", "s", 33)], "doc_id long, text string, lang string, source string, n_chars long")
    every = docs.select(*odd.columns).union(odd).withColumns({c: F.lit(1) for c in ("prediction", "probability", "_tries", "_toxicity", "row", "id", "digest", "kept", "label")})
    for docs in (every, every.limit(0)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            rows = out.select("doc_id", "text").collect()
            if n:
                assert sum(r["doc_id"] is None for r in rows) == 2 and sum(r["doc_id"] == 7002 for r in rows) == (1 if name == "near_dedup" else 2), name
            else:
                assert rows == []
        assert (corpus_pipeline.pack(spark, docs, SF).count() >= n) and {"sequence_id", "offset"} <= {*corpus_pipeline.pack(spark, docs, SF).columns}


def test_features():
    f = dict(zip(toxicity.FEATURES, toxicity.features("YOU id10t!! i.d.i.o.t, you are an idiot", dict.fromkeys(["idiot"], 1.0))))
    assert f["hits"] == 1 and f["near_you"] == 1 and f["hidden_hits"] >= 1 and f["capitals"] > 0 and f["exclaims"] > 0
    assert toxicity.features(None, {}) == toxicity.features("", {}) == [0.0] * len(toxicity.FEATURES)


def test_shouts_in_long_texts():
    at = toxicity.FEATURES.index("shouted_words")
    plain = "an ordinary word " * 700
    assert toxicity.features(plain, {})[at] == 0
    assert toxicity.features(plain + "you IDIOT " + plain, {})[at] == 1 / toxicity.WINDOW
    assert toxicity.features("you IDIOT", {})[at] == 1 / 2


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    clashing = docs.withColumns({"score": F.lit(1), "pii_kinds": F.lit("x"), "component_id": F.lit(2)})
    kept = corpus_pipeline.drop_toxic(spark, clashing, SF)
    assert kept.columns == clashing.columns
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    left = {r["doc_id"] for r in kept.select("doc_id").collect()}
    clean = [i for i, y in labels.items() if y == 0]
    assert sum(i in left for i in clean) / len(clean) > 0.95

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute_components(rows, 5)
    apart = corpus_pipeline.drop_near_copies(spark, clashing, SF)
    assert {r["doc_id"] for r in apart.collect()} == {i for i, (_, c) in want.items() if c == i} and apart.columns == clashing.columns

    clean = corpus_pipeline.replace_personal_data(spark, clashing, SF)
    assert clean.columns == clashing.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in clean.collect():
        spans = pii.find(before[r["doc_id"]])
        assert (r["text"] == before[r["doc_id"]]) == (not spans) and r["n_chars"] == len(r["text"])
        assert all(before[r["doc_id"]][s:e] not in r["text"] for s, e, _, _ in spans)


def test_pipeline_rejects_what_is_toxic(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    toxic = {r["doc_id"] for r in table(spark, SF, "labels").filter("toxic = 1").collect()}
    left = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, SF).select("doc_id").collect()}
    assert toxic and len(toxic - left) / len(toxic) > 0.7
    monkeypatch.setattr(toxicity, "scored", lambda df, model, keep: df.select(F.struct(*keep).alias("row"), (F.col("doc_id") % 10 / 10).alias("score")))
    left = {r["doc_id"] % 10 for r in corpus_pipeline.drop_toxic(spark, docs, SF).select("doc_id").collect()}
    assert left == {0, 1, 2}


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF)
    sizes = out.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert out.count() and all(r["n"] <= 2048 for r in sizes)
