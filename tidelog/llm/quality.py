"""Text quality by ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.sampling import class_sample
from tidelog.llm.textnum import codes, gram_buckets, groups_of, lean, offsets_of

BITS = 11           # n-grams are hashed into 2,048 places
SIZES = (1, 2, 3)
PER_GRADE = 1000    # texts of each grade that a model is fitted on
SURE = 300          # n-grams from which on a text's shares count in full
STEPS, RATE, DECAY = 150, 1.0, 1e-4
HOLD = 0.5         # pull of the thresholds' middle to 0, so that a text that says nothing is undecided
SELECT = 0.3        # tail probability from which a text is kept


def features(text: str | None) -> np.ndarray:
    """Square roots of the shares of a text's hashed 1- to 3-grams of code points, as they are written.

    The vector has length 1, less in texts of few n-grams, which say little; zeros if empty.
    """
    counts = np.bincount(gram_buckets(codes(text or ""), SIZES, BITS), minlength=1 << BITS)
    return np.sqrt(counts / max(SURE, counts.sum())).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass
class OrdinalModel:
    """P(grade > k) = sigmoid(x . weights - thresholds[k]), thresholds rising."""

    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    @staticmethod
    def fit(rows: np.ndarray, grades: np.ndarray) -> OrdinalModel:
        """Maximum likelihood with small weights; grades count alike, however many texts they have."""
        names, level = np.unique(grades, return_inverse=True)
        if len(names) < 2:
            return OrdinalModel(names.tolist(), np.zeros(rows.shape[1]), np.zeros(0))
        share = (1 / np.bincount(level))[level] / len(names)
        cuts = len(names) - 1
        # the first threshold, then the logarithms of the steps to the next ones
        place = np.concatenate([np.zeros(rows.shape[1]), [0.0], np.zeros(cuts - 1)])
        first, second = np.zeros_like(place), np.zeros_like(place)
        for step in range(1, STEPS + 1):
            weights, rise = place[:rows.shape[1]].astype(rows.dtype), place[rows.shape[1]:]
            thresholds = np.cumsum(np.concatenate([rise[:1], np.exp(rise[1:])]))
            above = _sigmoid((rows @ weights)[:, None] - thresholds)
            tails = np.concatenate([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))], axis=1)
            pick = np.arange(len(rows))
            chance = np.maximum(tails[pick, level] - tails[pick, level + 1], 1e-9)
            slope = np.concatenate([np.zeros((len(rows), 1)), above * (1 - above), np.zeros((len(rows), 1))], axis=1)
            upper, lower = slope[pick, level] * share / chance, slope[pick, level + 1] * share / chance
            by_cut = np.array([lower[level == k].sum() - upper[level == k + 1].sum() for k in range(cuts)])
            by_rise = np.cumsum(by_cut[::-1])[::-1]  # a step moves all later thresholds
            by_rise[1:] *= np.exp(rise[1:])
            by_rise[0] -= HOLD * (thresholds[0] + thresholds[-1]) / 2
            up = np.concatenate([(upper - lower).astype(rows.dtype) @ rows - DECAY * weights, by_rise])
            first, second = 0.9 * first + 0.1 * up, 0.999 * second + 0.001 * up ** 2
            rate = RATE * 10 ** (-1.5 * step / STEPS)
            place = place + rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        rise = place[rows.shape[1]:]
        return OrdinalModel(names.tolist(), place[:rows.shape[1]], np.cumsum(np.concatenate([rise[:1], np.exp(rise[1:])])))

    def tails(self, rows: np.ndarray) -> np.ndarray:
        """P(grade > k) for all grades but the last."""
        return _sigmoid((rows @ self.weights)[:, None] - self.thresholds)

    def tails_of(self, texts: list[str | None]) -> np.ndarray:
        """The tails of texts; 0 for those of white space only, which have nothing to be good at."""
        content = np.array([bool(t and t.strip()) for t in texts])
        return np.where(content[:, None], self.tails(np.stack([features(t) for t in texts])), 0.0)


def fit_quality(docs: DataFrame, ratings: DataFrame, per_grade: int = PER_GRADE) -> OrdinalModel:
    """Model of the whole numbers in ``ratings.quality``, fitted on about ``per_grade`` whole texts of each grade.

    Ratings are joined by ``doc_id``; rows without a grade are left out. The sample's
    features (8 KB a text) reach the driver, however long the texts are.
    """
    @lean
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["grade"], pa.array(rows, pa.binary())], ["grade", "features"])

    graded = ratings.select(F.col("doc_id").alias("rated_id"), F.col("quality").cast("int").alias("grade"))
    known = docs.select("doc_id").join(graded, F.col("doc_id") == F.col("rated_id"))  # ids alone: few rows are wanted
    chosen = class_sample(known.select("rated_id", "grade"), "grade", per_grade, "rated_id")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("rated_id")).select("text", "grade")
    found = sample.mapInArrow(measure, "grade int, features binary").toArrow().sort_by([("grade", "ascending"), ("features", "ascending")])
    if not len(found):
        return OrdinalModel([], np.zeros(1 << BITS), np.zeros(0))
    rows = np.stack([np.frombuffer(f.as_buffer(), np.float32) for f in found["features"]])
    return OrdinalModel.fit(rows, found["grade"].to_numpy())


def grade(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """``doc_id``, ``expected_grade``, ``tail`` (probability of more than the lowest grade) of every whole text.

    Null and empty texts, and texts of white space, get the lowest grade and a tail of 0. A model
    with one grade gives that grade and a tail of 1, one without grades null and 1.
    Repeated rows get a row each; other columns are ignored; an empty table gives no rows.
    """
    names = np.array(model.grades, np.float64)

    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = offsets_of(batch["text"])
            for first, last in groups_of(offsets):
                for low in range(first, last, 512):
                    part = batch.slice(low, min(512, last - low))
                    if len(names) > 1:
                        above = model.tails_of(part["text"].to_pylist())
                        expected, tail = names[0] + above @ np.diff(names), above[:, 0].astype(np.float64)
                    else:
                        expected, tail = np.full(len(part), names[0] if len(names) else np.nan), np.ones(len(part))
                    yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(expected, from_pandas=True), pa.array(tail)],
                                                     ["doc_id", "expected_grade", "tail"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(score, "doc_id long, expected_grade double, tail double")


def keep_good(docs: DataFrame, model: OrdinalModel, select: float = SELECT) -> DataFrame:
    """The rows of ``docs``, all columns, whose tail probability is ``select`` or more; all rows if there are fewer than two grades.

    Null and empty texts, and texts of white space, go if there are two grades.
    """
    @lean
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = offsets_of(batch["text"])
            for first, last in groups_of(offsets):
                for low in range(first, last, 512):
                    part = batch.slice(low, min(512, last - low))
                    yield part.filter(pa.array(model.tails_of(part["text"].to_pylist())[:, 0] >= select)) if len(model.thresholds) else part

    return docs.mapInArrow(keep, docs.schema)
