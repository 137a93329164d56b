"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration.

The model is learned from a bounded sample of the labelled rows (SAMPLE, a parameter); every document is scored in
one pass without a shuffle. Features are rates and densities of the whole text: lexicon hits (a short fixed list
and words that the labelled sample shows to be telling), their closeness to second-person words, capitals,
punctuation and obfuscated words. Ids, sources and languages are no features.

The sample is cut into FOLDS parts by text. A row's lexicon features come from the lexicon of the other parts, for the
trees as for the calibration, so no row is judged by words that its own label has put there; the calibration is fitted
to scores by trees that have not seen the row either. Texts to score meet the lexicon and the trees of all parts.

Null and empty texts have all features 0 and get the score of such a text; equal texts get equal scores, also in repeated
rows, and rows without an id are scored like any other. Of labelled rows with equal texts, or of labels of one id, the
larger label counts. Labelled rows without a text or without a label teach nothing. Without any labelled row, or with one
class alone, the score is the share of label 1 (0 if none). Whole texts are read, however long, one at a time. Columns to
keep travel in one struct, so their names are free. An empty table of documents gives no scores.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import slices, stored, tidy

#: Labelled rows that the model is learned from at most (in expectation), and learned lexicon words at most.
SAMPLE, WORDS = 20_000, 500
#: Parts of the sample; each is scored by trees learned from the others.
FOLDS = 3
#: Least score at which a document is toxic.
TOXIC = 0.3
#: Insults and curses, fixed values.
INSULTS = """idiot idiots moron morons stupid dumb loser losers scum trash garbage worthless pathetic disgusting clown clowns
fool fools jerk liar pig vermin filth coward hate kill die shut ugly bastard bitch shit fuck fucking asshole crap
dumm idioten trottel arschloch scheisse scheiße abschaum müll wertlos widerlich dreck schwein
imbécile crétin connard salaud merde débile ordure minable dégoûtant abruti
estúpido imbécil basura inútil asqueroso patético mierda cabrón escoria tonto""".split()
#: Second-person words, fixed values.
YOU = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu toi te ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
_WORD = re.compile(r"[^\W_]+")
_MIXED = re.compile(r"[^\W\d_]+(?:[0-9@$*+.!|_-]+[^\W\d_]+)+|[0-9@$!|][^\W\d_]+(?:[0-9@$*+.!|_-]+[^\W\d_]*)*")
_PLAIN = str.maketrans("01345789@$!|", "oieastbgasil")
_REPEAT = re.compile(r"(.)\1+")
NEAR, WINDOW = 4, 40
FEATURES = ["hits", "hit_weight", "distinct_hits", "hit_density", "weight_density", "densest_window", "near_you", "you_rate", "capitals", "shouted_words", "exclaims", "questions", "punctuation", "masks", "mixed_words", "hidden_hits", "digits", "log_words"]


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """FEATURES of one whole text."""
    if not text:
        return [0.0] * len(FEATURES)
    low = text.lower()
    words = _WORD.findall(low)
    n = max(1, len(words))
    at = [i for i, w in enumerate(words) if w in lexicon]
    you = [i for i, w in enumerate(words) if w in YOU]
    weight = sum([lexicon[words[i]] for i in at])
    places = np.array(at)
    dense = int((np.searchsorted(places, places + WINDOW) - np.arange(len(at))).max()) if at else 0
    near = 0
    if at and you:
        yous = np.array(you)
        right = np.searchsorted(yous, places)
        gap = np.minimum(np.abs(places - yous[np.minimum(right, len(yous) - 1)]), np.abs(places - yous[np.maximum(right - 1, 0)]))
        near = int((gap <= NEAR).sum())
    mixed = _MIXED.findall(low)
    hidden = 0
    for m in mixed:
        plain = m.translate(_PLAIN)
        bare = "".join(_WORD.findall(plain)).replace("_", "")
        hidden += bare in lexicon or _REPEAT.sub(r"\1", bare) in lexicon
    raw = np.frombuffer(text.encode(), np.uint8)
    upper, lower = int(((raw >= 65) & (raw <= 90)).sum()), int(((raw >= 97) & (raw <= 122)).sum())
    caps = np.array([i for i, w in enumerate(_WORD.findall(text)) if w.isupper()])
    shouted = int((np.searchsorted(caps, caps + WINDOW) - np.arange(len(caps))).max()) if len(caps) else 0
    size = len(raw)
    bangs, asks = text.count("!"), text.count("?")
    marks = int((((raw > 32) & (raw < 48)) | ((raw > 57) & (raw < 65)) | ((raw > 90) & (raw < 97)) | ((raw > 122) & (raw < 127))).sum())
    masks = sum(map(text.count, "*#$%&@"))
    digits = int(((raw >= 48) & (raw <= 57)).sum())
    return [
        float(len(at)), weight, float(len({words[i] for i in at})), len(at) / n, weight / n, float(dense), near / max(1, len(at)), len(you) / n,
        upper / max(1, upper + lower), shouted / min(n, WINDOW), bangs / size, asks / size, marks / size, masks / size, len(mixed) / n, float(hidden), digits / size, math.log1p(len(words)),
    ]


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    scale: IsotonicRegressionModel | None
    share: float


def _featured(df: DataFrame, lexicons: list[dict[str, float]]) -> DataFrame:
    """(row, features) of (row, text, part): the features of each text by the lexicon of its part. Without a text column, the text is the field of row that the second column numbers."""
    names, kind = ["row", "features"], df.schema["row"].dataType
    inside = "text" not in df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if inside:  # the text is a field of the row, named by its place in the last column
                place = whole.column(1)[0].as_py() if whole.num_rows else 0
                parts = (whole.slice(i, 500) for i in range(0, whole.num_rows, 500))
                texts = ((b, pc.struct_field(b.column(0), [place]).to_pylist(), [0] * b.num_rows) for b in parts)
            else:
                texts = ((b, b.column(1).to_pylist(), b.column(2).to_pylist()) for b in slices(whole, 1))
            for b, own, part in texts:
                found = [features(t, lexicons[i]) for t, i in zip(own, part)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.float64()))], names=names)

    schema = StructType([StructField("row", kind), StructField("features", ArrayType(DoubleType()))])
    return df.mapInArrow(tidy(run), schema).select("row", array_to_vector("features").alias("features"))


def _lexicon(counts: DataFrame, without: int | None, words: int) -> dict[str, float]:
    """The fixed insults and the words that mark label 1 in the sample, one part left out."""
    parts = [f for f in range(FOLDS) if f != without]
    n, ones = (sum(F.coalesce(F.col(f"{c}{f}"), F.lit(0)) for f in parts) for c in ("n", "y"))
    own = counts.select("word", n.alias("df"), ones.alias("hits"))
    whole = own.filter("word = ''").first()  # every text counts once for the empty word
    lexicon = dict.fromkeys(INSULTS, 1.0)
    if whole is None or not 0 < whole["hits"] < whole["df"]:
        return lexicon
    share = whole["hits"] / whole["df"]
    lift = F.log((F.col("hits") + share) / ((F.col("df") + 1) * share))
    z = (F.col("hits") - F.col("df") * share) / F.sqrt(F.col("df") * share * (1 - share))
    telling = own.filter((F.col("word") != "") & (F.col("df") >= max(4, 0.002 * whole["df"]))).filter((z > 5) & (lift > math.log(2)))
    return lexicon | {r["word"]: float(r["lift"]) for r in telling.orderBy(F.desc(z), "word").limit(words).select("word", lift.alias("lift")).collect()}


def learn(labelled: DataFrame, documents: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, words: int = WORDS) -> Model:
    """Learn from labelled (key, label) and the texts of documents (key, text).

    At most about `sample` labelled keys are taken, by a hash of the key; only their texts are read further.
    """
    known = labelled.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("label"))
    total = known.count()
    spread = F.pmod(F.xxhash64(F.col("id"), F.lit("sample")), F.lit(1_000_000))
    chosen = known.filter(spread < F.lit(math.ceil(1e6 * min(1.0, sample / max(1, total)))))
    texts = documents.select(F.col(key).alias("id"), F.col(text).alias("text")).filter("text is not null")
    # the sample is bounded, so its (id, label) pairs can go to every task
    part = F.pmod(F.xxhash64("text", F.lit("part")), F.lit(FOLDS)).cast("int")
    rows = stored(texts.join(F.broadcast(chosen), "id").groupBy("text").agg(F.max("label").alias("label")).withColumn("part", part), "labelled")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < ones < n:
        return Model(dict.fromkeys(INSULTS, 1.0), None, None, ones / n if n else 0.0)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t, y, f in zip(*(c.to_pylist() for c in b.columns)):
                own = ["", *set(_WORD.findall(t.lower()))]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([y] * len(own), pa.int32()), pa.array([f] * len(own), pa.int32())], names=["word", "label", "part"])

    by_part = [a for f in range(FOLDS) for a in (F.count_if(F.col("part") == f).alias(f"n{f}"), F.sum(F.when(F.col("part") == f, F.col("label"))).alias(f"y{f}"))]
    counts = stored(rows.select("text", "label", "part").mapInArrow(tidy(bags), "word string, label int, part int").groupBy("word").agg(*by_part), "words")
    lexicons = [_lexicon(counts, f, words) for f in range(FOLDS)]

    table = stored(_featured(rows.select(F.struct("label", "part").alias("row"), "text", "part"), lexicons).select("row.*", "features"), "features")
    gbt = GBTClassifier(labelCol="label", featuresCol="features", maxIter=16, maxDepth=3, stepSize=0.35, maxBins=64, minInstancesPerNode=5, subsamplingRate=0.8, seed=11)
    share = ones / n
    # a row at each end with the share of label 1 keeps the calibration of small samples from the extremes
    judged = table.sparkSession.createDataFrame([(0.0, share), (1.0, share)], "raw double, label double")
    for f in range(FOLDS):
        others = table.filter(F.col("part") != f)
        if others.select("label").distinct().count() == 2:
            unseen = gbt.fit(others.coalesce(4)).transform(table.filter(F.col("part") == f))
            judged = judged.unionByName(unseen.select(vector_to_array("probability")[1].alias("raw"), F.col("label").cast("double").alias("label")))
    scale = IsotonicRegression(featuresCol="raw", labelCol="label").fit(judged.coalesce(1))
    return Model(_lexicon(counts, None, words), gbt.fit(table.coalesce(4)), scale, share)


def scored(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """(row, score): the columns to keep as one struct, and the score (0 to 1) of each row.

    A thousandth of the score is the uncalibrated probability, which orders documents within a calibration step.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    if model.trees is None:
        return df.select(row, F.lit(float(model.share)).alias("score"))
    if text in keep:
        source = df.select(row, F.lit(keep.index(text)).alias("place"))
    else:
        source = df.select(row, F.col(text).alias("text"), F.lit(0).alias("part"))
    raw = model.trees.transform(_featured(source, [model.lexicon])).select("row", vector_to_array("probability")[1].alias("raw"))
    judged = model.scale.setFeaturesCol("raw").setPredictionCol("calibrated").transform(raw)
    return judged.select("row", F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.999 * F.col("calibrated") + 0.001 * F.col("raw"))).alias("score"))


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", name: str = "score") -> DataFrame:
    """The key and the score, as `name`, of each row."""
    return scored(df, model, [key], text).select("row.*", F.col("score").alias(name))
