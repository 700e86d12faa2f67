"""Toxic passages by maximum-scoring segments.

Words get log-odds between toxic and clean labelled texts, with a Dirichlet
prior in proportion to the counts of the whole corpus.  A linear scan over the
words of a text finds all its maximal scoring segments.  Their scores follow an
extreme-value law in clean text, whose scale comes from the word frequencies
and whose location from clean labelled texts; what a segment has beyond the
law's level for a text of that length is its evidence, and the evidence of all
significant segments of a text makes its score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small

BUCKETS = 1 << 18
SAMPLE = 50_000
STEM = 5
PRIOR = 0.1
SURE = 3.0
DRIFT = 1.0
EULER = 0.5772156649015329


@dataclass(frozen=True)
class ToxicModel:
    """Scores of hashed words and stems and the calibration; BUCKETS fixes its size."""

    odds: np.ndarray
    scale: float  # lambda of the extreme-value law
    location: float  # ln K
    slope: float
    offset: float


def words(text: Column) -> Column:
    """Hash buckets of the lower-case words of a text, in order; each word's is
    followed by that of its stem, its first STEM letters."""
    found = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}]+"), lambda w: w != "")

    def bucket(word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")

    pairs = F.transform(
        found, lambda w: F.array(bucket(w), bucket(F.concat(F.lit("-"), F.substring(w, 1, STEM))))
    )
    return F.flatten(pairs)


def training_rows(labels: DataFrame, id_col="doc_id", label_col="toxic", sample: int = SAMPLE) -> DataFrame:
    """(id, label) of at most ``sample`` labelled rows outside the held-out third.

    The rows with the smallest hashes of the id are taken.  A document with
    several labels counts as toxic if one says so; rows without id or label are
    left out.
    """
    chosen = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).filter(~held_out(id_col))
    return (
        chosen.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(sample)
    )


def held_out(id_col="doc_id") -> Column:
    """True for the third of the ids whose labels are not learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence.

    One pass over its runs of equal sign.  A stack holds candidate segments with
    the cumulative scores left and right of them; a new positive run is merged
    with the nearest candidate on whose left the total was lower, as long as
    that candidate's right total does not exceed its own.
    """
    if not len(scores):
        return []
    positive = scores > 0
    if not positive.any():
        return []
    edges = np.flatnonzero(np.diff(positive.astype(np.int8)))
    starts = np.concatenate(([0], edges + 1))
    ends = np.concatenate((edges + 1, [len(scores)]))
    totals = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[list] = []  # start, end, left total, right total, candidate with a lower left total
    for a, b in zip(starts[positive[starts]].tolist(), ends[positive[starts]].tolist()):
        new = [a, b, float(totals[a]), float(totals[b]), -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]
            new[4] = j
            if j < 0 or stack[j][3] >= new[3]:
                stack.append(new)
                break
            new = [stack[j][0], new[1], stack[j][2], new[3], -1]
            del stack[j:]
    return [(a, b, right - left) for a, b, left, right, _ in stack]


def word_scores(buckets: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """A word has its own log-odds where they are sure, else those of its stem."""
    own, stem = odds[buckets[0::2]], odds[buckets[1::2]]
    return np.where(own != 0, own, stem) - DRIFT


def evidence(buckets: np.ndarray, model: ToxicModel) -> tuple[float, list[tuple[int, int, float]]]:
    """The summed evidence of a text, or its best segment's shortfall, each as a
    logarithm with sign, and its toxic passages."""
    scores = word_scores(buckets, model.odds)
    found = segments(scores)
    level = np.log(max(len(scores), 1)) + model.location
    if not found:
        return -np.log1p(max(level + 1.0, 0.0)), []
    worth = [model.scale * s - level for _, _, s in found]
    passages = [(a, b, w) for (a, b, _), w in zip(found, worth) if w > 0]
    if passages:
        return np.log1p(sum(w for *_, w in passages)), passages
    return -np.log1p(-max(worth)), []


def smoothed(counts: np.ndarray, corpus: np.ndarray, strength: float) -> np.ndarray:
    """Counts with a Dirichlet prior of ``strength`` words, spread as in the corpus."""
    return counts + strength * corpus / max(corpus.sum(), 1.0) + 1e-3


def log_odds(toxic: np.ndarray, clean: np.ndarray, corpus: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Log-odds of each bucket, zero where they are within SURE deviations.

    The prior weighs ``prior`` times as much as the toxic texts.
    """
    strength = prior * toxic.sum()
    a, b = smoothed(toxic, corpus, strength), smoothed(clean, corpus, strength)
    odds = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    return np.clip(np.where(np.abs(odds) > SURE * np.sqrt(1 / a + 1 / b), odds, 0.0), -8.0, 8.0)


def law_scale(scores: np.ndarray, background: np.ndarray) -> float:
    """The positive root of E[exp(scale * score)] = 1 under the background."""
    p = background / max(background.sum(), 1.0)
    used = p > 0
    s, p = scores[used], p[used]
    if not len(s) or s.max() <= 0 or (p * s).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (p * np.exp(np.minimum(high * s, 600))).sum() < 1:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * s, 600))).sum() < 1 else (low, mid)
    return high


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and offset of a logistic fit, by Newton steps with a weak prior."""
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + 1e-2 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
    return max(float(w[0]), 1e-3), float(w[1])


def fit(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic",
    sample: int = SAMPLE,
) -> ToxicModel:
    """The model from all texts (prior) and at most ``sample`` labelled ones.

    Without labels of both kinds no word is toxic and every text scores low.
    """
    chosen = F.broadcast(training_rows(labels, id_col, label_col, sample))
    texts = docs.select(F.col(id_col).alias("_id"), words(F.col(text_col)).alias("_w"))

    def count(batches):
        held = np.zeros((3, BUCKETS), np.int64)  # all texts, clean ones, toxic ones
        for batch in small(batches):
            label = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
            for k, x in zip(label, batch.column(1)):
                n = np.bincount(x.values.to_numpy(), minlength=1)
                held[0, : len(n)] += n
                if k == k:
                    held[1 + int(k == 1), : len(n)] += n
        at = np.flatnonzero(held[0])
        columns = [pa.array(at.astype(np.int32)), *(pa.array(x[at]) for x in held)]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "n", "clean", "toxic"])

    counted = (
        texts.join(chosen, "_id", "left").select("_label", "_w")
        .mapInArrow(count, "bucket int, n long, clean long, toxic long")
        .groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toPandas()  # a row per bucket at most
    )
    corpus, toxic, clean = np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = counted["bucket"].to_numpy(np.int64)
    for counts, name in ((corpus, "n"), (toxic, "toxic"), (clean, "clean")):
        counts[at] = counted[name].to_numpy(float)
    if not toxic.sum() or not clean.sum():
        return ToxicModel(np.zeros(BUCKETS), 1.0, 0.0, 1.0, -5.0)
    odds = log_odds(toxic, clean, corpus)
    scale = law_scale(odds - DRIFT, smoothed(clean, corpus, PRIOR * toxic.sum()))
    labelled = texts.join(chosen, "_id").select("_w", "_label")

    def evaluated(measure):
        def run(batches):
            for batch in small(batches):
                made = [measure(x.values.to_numpy()) for x in batch.column(0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made, pa.float64()), batch.column(1)], names=["x", "label"]
                )

        found = labelled.mapInArrow(run, "x double, label int").toPandas()  # ``sample`` rows at most
        return found["x"].to_numpy(float), found["label"].to_numpy(float)

    def level(buckets):
        if not len(buckets):
            return np.nan
        top = max((x for *_, x in segments(word_scores(buckets, odds))), default=0.0)
        return scale * top - np.log(len(buckets) // 2)

    x, label = evaluated(level)
    calm = x[(label == 0) & ~np.isnan(x)]
    location = float(calm.mean() - EULER) if len(calm) else 0.0
    draft = ToxicModel(odds, scale, location, 1.0, 0.0)
    slope, offset = logistic(*evaluated(lambda buckets: evidence(buckets, draft)[0]))
    return ToxicModel(odds, scale, location, slope, offset)


def score(docs: DataFrame, model: ToxicModel, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, score (0 to 1), passages.

    passages lists (first word, end word, evidence) of the significant segments.
    Null, empty and wordless texts have no passage and score as a clean text of
    one word.  Only the text is scored; other columns are not read; repeated rows
    score alike.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in small(batches):
            m, made, passages = sent.value, [], []
            for x in batch.column(1):
                value, found = evidence(x.values.to_numpy(), m)
                made.append(1 / (1 + np.exp(-np.clip(m.slope * value + m.offset, -500, 500))))
                passages.append([{"start": a, "end": b, "evidence": w} for a, b, w in found])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.float64()), pa.array(passages, kind)],
                names=[id_col, "score", "passages"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), words(F.col(text_col)).alias("_w")).mapInArrow(
        run, f"`{id_col}` {kind}, score double, passages array<struct<start:int,end:int,evidence:double>>"
    )


def drop_toxic(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col="doc_id", text_col="text",
    label_col="toxic",
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, by a model learnt from them."""
    model = fit(docs, labels, id_col, text_col, label_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    # Only the words go to Python and one flag comes back; the other columns stay in the JVM.
    @F.arrow_udf("boolean")
    def calm(found: pa.Array) -> pa.Array:
        m = sent.value
        values = np.array([evidence(x.values.to_numpy(), m)[0] for x in found], float)
        return pa.array(1 / (1 + np.exp(-np.clip(m.slope * values + m.offset, -500, 500))) < threshold)

    return docs.filter(calm(words(F.col(text_col))))
