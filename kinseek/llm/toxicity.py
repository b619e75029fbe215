"""Toxicity by non-negative positive-unlabelled learning.

A text's features are its words and the first 4, 5 and 6 bytes of its words, hashed; words
that only share a stem share features. A bounded sample of confirmed toxic texts and of
unlabelled texts picks the features that toxic texts have more often, and trains a logistic
classifier in numpy by the non-negative risk estimate

    prior * loss(toxic, 1) + max(0, loss(unlabelled, 0) - prior * loss(toxic, 0)),

where `prior`, the share of toxic texts, is counted over all labels that may be learned from.
Steps back (where the second part is below 0) can carry the bias far off, so the weights of the
least risk of all steps are kept, and the bias is then set so that the unlabelled texts' scores
have the prior as their mean. Every text is scored whole, in the tasks that read it.

Defined results: a null or empty text gets the score of a text without any feature; without
a toxic label to learn from all scores are 0; with fewer than `LEAST_TOXIC` toxic texts, or
none that differ from the others in their words, nothing was learned: all texts get the prior, and
`without_toxic` keeps them all. Of repeated labels of an id the toxic one counts, null labels
do not, and of repeated rows of an id the first text in order is learned from; rows with equal
texts get equal scores; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.llm import words
from kinseek.runtime import stage

SLOTS = 1 << 19
PREFIXES = (4, 5, 6)
TOXIC_ROWS, UNLABELLED_ROWS = 3000, 9000  # texts that training looks at, at most
FEATURES = 4096  # features with a weight, at most
CERTAINTY = 5.0  # standard errors by which toxic texts must have a feature more often
LEAST_TOXIC = 5  # toxic texts that a classifier can be learned from
CUT = 0.3
STEPS, RATE, DECAY = 400, 0.05, 1e-3


@dataclass(frozen=True)
class Model:
    slots: np.ndarray  # ascending
    weights: np.ndarray
    bias: float


def held_out(doc_id):
    """Rows whose labels no model may see."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of all words of all rows, and their rows; repeated ones included."""
    starts, ends, counts = words.word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = words.word_hashes(data, starts, fold=True)
    found = [whole]
    for size in PREFIXES:
        long = np.flatnonzero(ends - starts > size)
        found.append(whole)
        if len(long):
            at = starts[long][:, None] + np.arange(size)
            letters = data[at]
            letters = letters + np.where((letters >= 65) & (letters <= 90), 32, 0).astype(np.uint8)
            code = np.zeros(len(long), np.uint64)
            for k in range(size):
                code = (code << np.uint64(8)) | letters[:, k].astype(np.uint64)
            own = whole.copy()
            own[long] = words.mix(code + np.uint64(size << 56))
            found[-1] = own
    slots = np.concatenate([h >> np.uint64(45) for h in found]).astype(np.int64)
    return slots, np.tile(words.row_of(counts), len(found))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = words.buffers(batch.column("text"))
    for lo, hi in words.chunks(offsets):
        slots, rows = _features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        yield lo, hi, slots, rows


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros((2, SLOTS), np.int64)
    for batch in batches:
        kind = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, _, slots, rows in _rows(batch):
            own = np.unique(rows * SLOTS + slots)
            np.add.at(seen, (kind[lo + own // SLOTS], own % SLOTS), 1)
    full = np.flatnonzero(seen.sum(0))
    yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(seen[1, full]), pa.array(seen[0, full])], ["slot", "toxic", "other"])


def _present(slots: np.ndarray):
    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [[] for _ in range(batch.num_rows)]
            for lo, hi, found, rows in _rows(batch):
                at = np.minimum(np.searchsorted(slots, found), len(slots) - 1)
                hit = slots[at] == found
                own = np.unique(rows[hit] * len(slots) + at[hit])
                for row, cut in zip(range(lo, hi), np.split(own % len(slots), np.searchsorted(own // len(slots), np.arange(1, hi - lo)))):
                    lists[row] = cut.tolist()
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(lists, pa.list_(pa.int32()))], ["toxic", "at"])

    return present


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts to learn from with `toxic`: 1 confirmed, 0 unlabelled; drawn by a hash of the id."""
    draw = F.xxhash64(F.col("doc_id"), F.lit(7))
    toxic = labels.where("toxic = 1").select("doc_id").orderBy(draw, "doc_id").limit(TOXIC_ROWS)
    other = docs.where("doc_id is not null").where(~held_out(F.col("doc_id"))).select("doc_id").orderBy(draw, "doc_id").limit(UNLABELLED_ROWS)
    chosen = other.select("doc_id", F.lit(0).alias("toxic")).union(toxic.select("doc_id", F.lit(1).alias("toxic")))
    # One text of an id, so that repeated rows cannot pass the bounds.
    texts = docs.join(F.broadcast(chosen.distinct()), "doc_id").select("toxic", "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.groupBy("toxic", "doc_id").agg(F.min("text").alias("text")).select("toxic", F.col("text").cast("binary").alias("text"))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from `docs` (doc_id, text) and all of `labels` (doc_id, toxic) that it is given."""
    labels = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = labels.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not share:
        return None
    prior = min(share, 0.9)
    unlearned = Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    sample = stage(_sample(docs, labels))
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sizes.get(1, 0) < LEAST_TOXIC or not sizes.get(0):
        return unlearned
    toxic = F.col("toxic") / F.lit(float(sizes[1]))
    other = F.col("other") / F.lit(float(sizes[0]))
    # The error of the difference if both kinds had the feature equally often.
    pooled = (F.col("toxic") + F.col("other")) / F.lit(float(sizes[1] + sizes[0]))
    error = F.sqrt(pooled * (1 - pooled) * (1 / sizes[1] + 1 / sizes[0]) + 1e-12)
    found = (
        sample.mapInArrow(_counter, "slot long, toxic long, other long")
        .groupBy("slot")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .withColumn("gain", (toxic - other) / error)
        .where(f"gain >= {CERTAINTY} and toxic >= 3")
        .orderBy(F.desc("gain"), "slot")
        .limit(FEATURES)
        .select("slot")
        .collect()
    )
    slots = np.sort(np.array([r.slot for r in found], np.int64))
    if not len(slots):
        return unlearned
    rows = sample.mapInArrow(_present(slots), "toxic int, at array<int>").collect()
    rows.sort(key=lambda r: (r.toxic, r["at"]))  # task order must not change the sums
    return Model(slots, *_train([r["at"] for r in rows if r.toxic], [r["at"] for r in rows if not r.toxic], len(slots), prior))


def _train(toxic: list[list[int]], other: list[list[int]], size: int, prior: float) -> tuple[np.ndarray, float]:
    def flat(rows):
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([i for r in rows for i in r], np.int64)

    (pr, pc), (ur, uc) = flat(toxic), flat(other)
    w, b = np.zeros(size), float(np.log(prior / (1 - prior)))
    least, kept = np.inf, w
    m, v, beta = np.zeros(size + 1), np.zeros(size + 1), (0.9, 0.999)
    for step in range(1, STEPS + 1):
        zp = np.bincount(pr, w[pc], len(toxic)) + b
        zu = np.bincount(ur, w[uc], len(other)) + b
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        risk = prior * np.logaddexp(0, -zp).mean() + max(0.0, negative) + DECAY / 2 * (w @ w)
        if risk < least:
            least, kept = risk, w
        # d softplus(z) = sigmoid(z), d softplus(-z) = sigmoid(z) - 1
        gp, gu = prior * (sp - 1) / len(toxic), np.zeros(len(other))
        if negative >= 0:
            gp, gu = gp - prior * sp / len(toxic), su / len(other)
        else:  # more toxic texts among the unlabelled than there can be: step back
            gp, gu = prior * sp / len(toxic), -su / len(other)
        grad = np.append(
            np.bincount(pc, gp[pr], size) + np.bincount(uc, gu[ur], size) + DECAY * w, gp.sum() + gu.sum()
        )
        m, v = beta[0] * m + (1 - beta[0]) * grad, beta[1] * v + (1 - beta[1]) * grad**2
        move = RATE * (m / (1 - beta[0] ** step)) / (np.sqrt(v / (1 - beta[1] ** step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return kept, _bias(np.bincount(ur, kept[uc], len(other)), prior)


def _bias(z: np.ndarray, mean: float) -> float:
    """What must be added to `z` for their scores to have this mean."""
    low, high = -50.0 - np.abs(z).max(), 50.0 + np.abs(z).max()
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (low, middle) if (1 / (1 + np.exp(-np.clip(z + middle, -700, 700)))).mean() > mean else (middle, high)
    return float(low)


def _scorer(model: Model | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = np.zeros(SLOTS, bool)
        if model is not None:
            listed[model.slots] = True
        for batch in batches:
            z = np.full(batch.num_rows, -np.inf if model is None else model.bias)
            for lo, hi, slots, rows in _rows(batch) if listed.any() else ():
                hit = listed[slots]
                own = np.unique(rows[hit] * SLOTS + slots[hit])
                at = np.searchsorted(model.slots, own % SLOTS)
                z[lo:hi] += np.bincount(own // SLOTS, model.weights[at], hi - lo)
            with np.errstate(over="ignore"):
                out = pa.array(np.round(1 / (1 + np.exp(-z)), 12))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], [*batch.schema.names[:-1], "score"])

    return score


def score_documents(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The columns `keep` of `docs` and `score`, 0 to 1."""
    given = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col("text").cast("binary").alias("text"))
    schema = given.drop("text").schema.add("score", "double")
    scored = given.mapInArrow(_scorer(model), schema)
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("score").alias("_score"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, held_out, score, predicted` of every row of `docs` (doc_id, text).

    Learns only labels (doc_id, toxic) of rows that are not held out.
    """
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic").where(~held_out(F.col("doc_id"))))
    return score_documents(docs, model, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= CUT).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without the rows that `toxicity` predicts to be toxic; all columns stay."""
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic").where(~held_out(F.col("doc_id"))))
    if model is not None and not len(model.slots):
        return docs
    return score_documents(docs, model, docs.columns).where(F.col("_score") < CUT).drop("_score")
