"""Toxicity by a classifier that is regularised with counterfactuals.

Features of a word are the word and its pieces of four to six characters, ends marked, so that inflected and compound forms count;
a text has the sum over its different words. A logistic regression is fitted on the features whose presence depends on the label beyond chance.
Where a labelled text holds an identity term, its counterfactuals are the same text with the term swapped for the others of its group, and
the squared change of the score is part of the loss. So a term gets no weight that the others of its group do not get, even if it
happens to stand in toxic texts more often: a neutral mention of a group is not held against it.

The model is fitted on a bounded sample of labelled texts (``most_rows``, the first by a hash of the id). Features are counted in the tasks; only the
chosen ones, at most ``most_features``, and the sample's share of them reach the driver. Every text is scored whole, in one pass
without a shuffle; a word's score is looked up once for each task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import sent_to_tasks, written

# fixed values: identity terms by group, whose members stand for one another
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "indigenous"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "bouddhistes", "athées"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "budistas", "ateos"),
)
WORD = re.compile(r"\w+")
PIECES = (4, 5, 6)


@dataclass(frozen=True)
class Fit:
    most_rows: int = 12_000
    most_features: int = 50_000
    least_evidence: float = 30.0  # twice the log likelihood ratio of a feature against the label
    folds: int = 5
    ridge: float = 1e-3
    pairing: float = 1.0  # weight of squared score changes under swaps
    rounds: int = 300
    step: float = 0.1


def held_out(doc_id: Column, folds: int) -> Column:
    """Rows of the fold that labels are never learned from; rows without an id belong to it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def word_features(word: str) -> list[int]:
    """Hashes of the word and its pieces, each once."""
    marked = f"^{word}$"
    pieces = {marked} | {marked[i : i + n] for n in PIECES for i in range(len(marked) - n + 1)}
    return [xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass")) for p in pieces]


def text_features(text: str, known: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes and in how many different words each is. ``known`` keeps words between calls."""
    if len(known) > 100_000:
        known.clear()
    arrays = [known.get(w) if w in known else known.setdefault(w, np.array(word_features(w), np.uint64)) for w in words(text)]
    return np.unique(np.concatenate([*arrays, np.zeros(0, np.uint64)]), return_counts=True)


def swaps(features: np.ndarray) -> dict[str, list[tuple[np.ndarray, np.ndarray]]]:
    """For each identity term the changes of its counterfactuals: places in ``features`` and the step there, scaled to one mean swap."""
    found = {}
    for group in IDENTITY_TERMS:
        own = {w: np.isin(features, np.array(word_features(w), np.uint64)).astype(float) for w in group}
        for w in group:
            changes = [(own[o] - own[w]) / np.sqrt(len(group) - 1) for o in group if o != w]
            found[w] = [(np.flatnonzero(c), c[np.flatnonzero(c)]) for c in changes if c.any()]
    return found


def fit_weights(rows: Sequence[tuple[np.ndarray, np.ndarray]], terms: Sequence[Sequence[str]], labels: np.ndarray, features: np.ndarray,
                fit: Fit) -> tuple[np.ndarray, float]:
    """Weights of ``features`` and the intercept, by full-batch gradient steps. ``rows``: places and counts; ``terms``: identity terms of each text."""
    n, size = len(rows), len(features)
    flat = np.concatenate([*(at for at, _ in rows), np.zeros(0, np.int64)])
    counts = np.concatenate([*(c for _, c in rows), np.zeros(0)])
    owner = np.repeat(np.arange(n), [len(at) for at, _ in rows]).astype(np.int64)
    changes, often = [], []
    for term, change in swaps(features).items():
        holders = sum(term in held for held in terms)
        if holders:
            changes += change
            often += [holders / n] * len(change)
    weights, slopes = np.zeros(size), np.full(size, 1e-8)
    rate = min(max(labels.mean() if n else 0.0, 1e-3), 1 - 1e-3)
    if not n or not size:  # nothing to learn from: the share of toxic labels
        return weights, float(np.log(rate / (1 - rate)))
    intercept, steep = 0.0, 1e-8
    balance = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))  # both classes weigh alike
    for _ in range(fit.rounds):
        margin = intercept + np.bincount(owner, weights[flat] * counts, minlength=n)
        error = (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - labels) * balance
        slope = np.bincount(flat, error[owner] * counts, minlength=size) + fit.ridge * weights
        for (at, by), share in zip(changes, often):
            slope[at] += 2 * fit.pairing * share * float(weights[at] @ by) * by
        slopes += slope**2
        weights -= fit.step * slope / np.sqrt(slopes)
        steep += error.sum() ** 2
        intercept -= fit.step * error.sum() / np.sqrt(steep)
    return weights, float(intercept)


def training_texts(docs: DataFrame, labels: DataFrame, fit: Fit, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(id, label, text) of the sample. Of several labels of one id the highest counts; null ids and labels do not; of several texts of an id
    the last in order counts."""
    known = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).dropna()
    known = known.where(~held_out(F.col("id"), fit.folds)).groupBy("id").agg(F.max(F.when(F.col("label") > 0, 1).otherwise(0)).alias("label"))
    chosen = written(known.orderBy(F.xxhash64("id"), "id").limit(fit.most_rows), "labelled")
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    return written(rows.groupBy("id").agg(F.max("label").alias("label"), F.max("text").alias("text")), "sample")


def counted_features(sample: DataFrame) -> DataFrame:
    """(feature, plain, toxic): in how many texts of each label a feature is. Texts of a batch are counted before they move."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        for batch in batches:
            labels, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 1000):
                part = [text_features(t, known)[0] for t in texts[at : at + 1000]]
                own = np.repeat(np.array(labels[at : at + 1000]), [len(p) for p in part])
                found, place = np.unique(np.concatenate(part), return_inverse=True)
                toxic = np.bincount(place, own, minlength=len(found)).astype(np.int64)
                all_ = np.bincount(place, minlength=len(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(all_ - toxic), pa.array(toxic)], names=["feature", "plain", "toxic"]
                )

    rows = sample.select("label", "text").mapInArrow(counted, "feature long, plain long, toxic long")
    return rows.groupBy("feature").agg(F.sum("plain").alias("plain"), F.sum("toxic").alias("toxic"))


def chosen_features(sample: DataFrame, fit: Fit) -> np.ndarray:
    """The features of most evidence, at most ``most_features``."""
    whole = dict(sample.groupBy("label").count().collect())
    plain, toxic = float(whole.get(0, 0)), float(whole.get(1, 0))
    sides = []
    for a, b in ((F.col("plain"), F.col("toxic")), (plain - F.col("plain"), toxic - F.col("toxic"))):
        for part, share in ((a, plain), (b, toxic)):
            expected = (a + b) * share / max(plain + toxic, 1.0)
            sides.append(F.when(part > 0, part * F.log(part / expected)).otherwise(0.0))
    rows = counted_features(sample).withColumn("evidence", 2 * (sides[0] + sides[1] + sides[2] + sides[3]))
    best = rows.where(F.col("evidence") >= fit.least_evidence).orderBy(F.col("evidence").desc(), "feature").limit(fit.most_features)
    return np.sort(np.array([r.feature for r in best.select("feature").collect()], dtype=np.int64).view(np.uint64))


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), **columns: str) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, intercept). Without a chosen feature the score is the share of toxic labels everywhere, without labelled rows the least rate."""
    sample = training_texts(docs, labels, fit, **columns)
    features = chosen_features(sample, fit)
    terms = {w for group in IDENTITY_TERMS for w in group}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        for batch in batches:
            out = []
            for id_, label, text in zip(*(c.to_pylist() for c in batch.columns)):
                found, counts = text_features(text, known)
                at = np.searchsorted(features, found)
                fine = at < len(features)
                fine[fine] = features[at[fine]] == found[fine]
                out.append((str(id_), label, at[fine].tolist(), counts[fine].tolist(), sorted(words(text) & terms)))
            yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in out], schema=kinds)

    names = ["id", "label", "at", "counts", "terms"]
    kinds = pa.schema(list(zip(names, [pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())])))
    schema = "id string, label int, at array<int>, counts array<int>, terms array<string>"
    rows = sorted(sample.select("id", "label", "text").mapInArrow(placed, schema).collect())
    sparse = [(np.array(r.at, np.int64), np.array(r.counts, float)) for r in rows]
    weights, intercept = fit_weights(sparse, [r.terms for r in rows], np.array([r.label for r in rows], float), features, fit)
    return features, weights, intercept


def score_texts(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``row`` (the carried columns) and ``score``; null texts are empty, and an empty text has the intercept's score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most most_features numbers
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, intercept = sent.value
        by_feature = dict(zip(features.tolist(), weights.tolist()))
        known: dict[str, float] = {}
        for batch in batches:
            scores = []
            for t in batch.column(1).to_pylist():
                parts = []
                for word in words(t) if t else ():
                    value = known.get(word)
                    if value is None:
                        if len(known) > 1_000_000:
                            known.clear()
                        value = known[word] = math.fsum(by_feature.get(f, 0.0) for f in word_features(word))
                    parts.append(value)
                margin = max(-60.0, min(60.0, intercept + math.fsum(parts)))  # fsum: no order matters
                scores.append(1 / (1 + math.exp(-margin)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    return named.mapInArrow(scored, f"row {named.schema['row'].dataType.simpleString()}, score double")


sent_to_tasks(__name__)
