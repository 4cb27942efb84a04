"""Language identification with string kernels and Nystrom landmarks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.sampling import class_sample, id_remainder
from tidelog.llm.textnum import codes, groups_of, is_letter, lean, offsets_of
from tidelog.sinks.tables import written_table

SIZES = (1, 2, 3)    # the blended spectrum
WINDOW = 4096        # characters of a window; a longer text is the mean of its windows
PER_CLASS = 300      # texts of each language that a model is fitted on
LANDMARKS = 128      # windows of these texts, over all languages; at least one of each
RIDGE = 1e-2
UNKNOWN = "und"
MIN_SCORE = 0.4      # a text whose best language scores less is not identified
PART = 1 << 19       # bytes of text worked on at a time


def windows(text: str | None) -> list[np.ndarray]:
    """The distinct n-grams, sorted, of each window of a text; none for a text without letters.

    Letters are lower-cased, all else is one space. An n-gram is the number made of its
    up to three code points, so different ones never meet. The windows of a text are of
    equal length and overlap by two characters: every n-gram of the text is in one.
    """
    points = codes((text or "").lower())
    points = np.where(is_letter()[points], points, 0x20)
    letter = points != 0x20
    if not letter.any():
        return []
    gap = np.ones(len(points), bool)
    gap[1:] = letter[1:] | letter[:-1]
    points = points[gap].astype(np.int64) + 1
    edges = np.linspace(0, len(points), -(-len(points) // WINDOW) + 1).astype(np.int64)
    found = []
    for low, high in zip(edges[:-1], edges[1:]):
        part = points[low:high + max(SIZES) - 1]
        grams, code = [], np.zeros(len(part), np.int64)
        for size in SIZES:
            code = (code[:len(part) - size + 1] << 21) + part[size - 1:]
            grams.append(code)
        grams = np.sort(np.concatenate(grams))
        found.append(grams[np.append(True, grams[1:] != grams[:-1])])
    return found


@dataclass
class Landmarks:
    """Windows of texts by their n-grams: all n-grams, and the landmarks that have each."""
    grams: np.ndarray    # distinct, sorted
    begin: np.ndarray    # (grams + 1) where the holders of a gram begin
    holders: np.ndarray
    sizes: np.ndarray    # n-grams of each landmark

    @staticmethod
    def of(sets: list[np.ndarray]) -> Landmarks:
        sizes = np.array([len(s) for s in sets])
        every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(every, kind="stable")
        grams, begin = np.unique(every[order], return_index=True)
        return Landmarks(grams, np.append(begin, len(every)), owner[order], sizes)

    def places(self, found: np.ndarray) -> np.ndarray:
        """Places in ``grams`` of those n-grams that any landmark has."""
        at = np.minimum(np.searchsorted(self.grams, found), len(self.grams) - 1)
        return at[self.grams[at] == found]

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Presence kernel of a text with each landmark, the mean over the text's windows."""
        sums = np.zeros(len(self.sizes))
        for found in sets:
            at = self.places(found)
            counts = self.begin[at + 1] - self.begin[at]
            stops = np.cumsum(counts)
            held = self.holders[np.arange(counts.sum()) - np.repeat(stops - counts - self.begin[at], counts)]
            sums += np.bincount(held, minlength=len(self.sizes)) / np.sqrt(len(found) * self.sizes)
        return sums / len(sets)


@dataclass
class LanguageModel:
    names: list[str]
    grams: np.ndarray       # n-grams of the landmarks, sorted
    weights: np.ndarray     # (n-grams, languages)
    bias: np.ndarray

    @staticmethod
    def fit(landmarks: Landmarks, inner: np.ndarray, rows: np.ndarray, labels: list[str]) -> LanguageModel:
        """One-versus-rest kernel ridge regression in the space spanned by the landmarks.

        ``inner`` and ``rows``: kernels of the landmarks and of the labelled texts with the landmarks.
        """
        names = sorted(set(labels))
        values, vectors = np.linalg.eigh(inner)
        large = values > 1e-8 * max(values.max(initial=0), 1)
        whiten = vectors[:, large] / np.sqrt(values[large])
        features = rows @ whiten
        wanted = np.where(np.array(labels)[:, None] == np.array(names)[None, :], 1.0, -1.0)
        # languages count alike, however many texts they have
        share = np.array([1 / labels.count(x) for x in labels])
        share *= len(labels) / share.sum()
        mean_x, mean_y = np.average(features, 0, share), np.average(wanted, 0, share)
        centred = features - mean_x
        gram = (centred * share[:, None]).T @ centred + RIDGE * len(rows) / 100 * np.eye(features.shape[1])
        solved = np.linalg.solve(gram, (centred * share[:, None]).T @ (wanted - mean_y))
        # the kernel is a sum over n-grams, so the landmarks' weights can be added up for each n-gram
        weights = (whiten @ solved) / np.sqrt(landmarks.sizes)[:, None]
        return LanguageModel(names, landmarks.grams, np.add.reduceat(weights[landmarks.holders], landmarks.begin[:-1]), mean_y - mean_x @ solved)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text.

        The windows of all texts are the rows of one sparse matrix of n-grams, which is multiplied
        by the n-grams' weights.
        """
        sets = [(row, found) for row, text in enumerate(texts if self.names else []) for found in windows(text)]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not sets:
            return names, scores
        owner, sizes = np.array([row for row, _ in sets]), np.array([len(found) for _, found in sets])
        every = np.concatenate([found for _, found in sets])
        at = np.minimum(np.searchsorted(self.grams, every), len(self.grams) - 1)
        known = self.grams[at] == every
        at, window = at[known], np.repeat(np.arange(len(sets)), sizes)[known]
        values = np.stack([np.bincount(window, self.weights[at, c], len(sets)) for c in range(len(self.names))], axis=1) / np.sqrt(sizes)[:, None]
        count = np.bincount(owner, minlength=len(texts))
        means = np.stack([np.bincount(owner, values[:, c], len(texts)) for c in range(len(self.names))], axis=1)
        means = means / np.maximum(count, 1)[:, None] + self.bias
        best = means.argmax(axis=1)
        for row in np.flatnonzero(count).tolist():
            names[row] = self.names[best[row]]
        top = np.clip((means[np.arange(len(texts)), best] + 1) / 2, 0, 1)
        return names, np.where(count > 0, top, 0.0)


def _lettered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array([bool((is_letter()[codes((t or "").lower())]).any()) for t in batch["text"].to_pylist()], pa.bool_()))


def _middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [windows(t) for t in batch["text"].to_pylist()]
        middle = [s[len(s) // 2].tobytes() for s in sets]
        yield pa.RecordBatch.from_arrays([batch["turn"], batch["lang"], pa.array(middle, pa.binary())], ["turn", "lang", "grams"])


def fit_languages(docs: DataFrame, per_class: int = PER_CLASS) -> LanguageModel:
    """Model of the languages in ``lang``, fitted on whole texts: about ``per_class`` of each, chosen by a hash of ``doc_id``.

    Rows without a language, and texts without letters, are left out. The landmarks are
    the middle windows of sampled texts, evenly from the languages and at least one of each. Their n-grams (at
    most 100 KB each) and the kernels of the sampled whole texts with them (1 KB a text)
    reach the driver, however long the texts are.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sample = class_sample(rows, "lang", per_class).select("lang", "text").mapInArrow(lean(_lettered), "lang string, text string")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    sample = written_table(sample.withColumn("turn", F.row_number().over(order)))
    turns = sorted((r.turn, r.lang) for r in sample.select("turn", "lang").collect())
    if not turns:
        return LanguageModel([], np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0))
    languages = sum(turn == 1 for turn, _ in turns)
    last = turns[:max(LANDMARKS, languages)][-1]
    chosen = sample.filter((F.col("turn") < last[0]) | (F.col("turn") == last[0]) & (F.col("lang") <= last[1]))
    chosen = chosen.select("turn", "lang", "text").mapInArrow(lean(_middles), "turn int, lang string, grams binary").toArrow()
    chosen = chosen.sort_by([("turn", "ascending"), ("lang", "ascending")])
    sets = [np.frombuffer(g.as_buffer(), np.int64) for g in chosen["grams"]]
    landmarks = Landmarks.of(sets)

    @lean
    def kernels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [landmarks.kernel(windows(t)).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["turn"], batch["lang"], pa.array(values, pa.binary())], ["turn", "lang", "kernel"])

    found = sample.select("turn", "lang", "text").mapInArrow(kernels, "turn int, lang string, kernel binary").toArrow()
    found = found.sort_by([("lang", "ascending"), ("turn", "ascending")])
    inner = np.stack([landmarks.kernel([s]) for s in sets])
    return LanguageModel.fit(landmarks, inner, np.stack([np.frombuffer(k.as_buffer()) for k in found["kernel"]]), found["lang"].to_pylist())


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) of every whole text.

    The score of a long text is the mean over its windows, so it does not depend on the length.

    Null and empty texts, and texts without letters, are ``und`` with score 0, and so is
    every text where the model has no languages. Repeated rows get a row each; other
    columns are ignored; an empty table gives no rows.
    """
    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = offsets_of(batch["text"])
            for first, last in groups_of(offsets, PART):
                for low in range(first, last, 256):
                    part = batch.slice(low, min(256, last - low))
                    names, scores = model.predict(part["text"].to_pylist())
                    yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(score, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is found with ``min_score`` or more; ``und`` goes."""
    @lean
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = offsets_of(batch["text"])
            for first, last in groups_of(offsets, PART):
                for low in range(first, last, 256):
                    part = batch.slice(low, min(256, last - low))
                    names, scores = model.predict(part["text"].to_pylist())
                    yield part.filter(pa.array((np.array(names) != UNKNOWN) & (scores >= min_score)))

    return docs.mapInArrow(keep, docs.schema)


def language_of(docs: DataFrame, folds: int = 5, held_fold: int = 0) -> DataFrame:
    """Languages by a model fitted on the rows of the other folds: ``doc_id``, ``held_out``, ``lang_pred``, ``score``."""
    model = fit_languages(docs.filter(id_remainder(folds) != held_fold))
    return identify(docs, model).withColumn("held_out", id_remainder(folds) == held_fold)
