"""Toxicity by multiple-instance learning: sentences scored, documents labelled."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.sampling import class_sample, id_remainder
from tidelog.llm.textnum import BY_MARK, groups_of, lean, minhash, mix, permutations, utf8, word_hashes

BITS = 17           # words and word beginnings are hashed into 131,072 places each
PREFIX = 4          # bytes of a word's beginning
PER_CLASS = 3000    # texts of each label that a model is fitted on
MIN_TEXTS, MIN_Z = 5, 5.0  # a word has weight if that many texts have it and its labels are so many deviations off
BANDS, BAND_ROWS = 6, 8    # texts of the sample that share a band of minhashes of their words are copies
STEPS, RATE = 200, 0.1
BASE = 0.02                # chance that nineteen of twenty texts are called toxic at most, whatever their words
LEAK = 0.05                # share of toxic labels that no sentence explains
DECAY = 0.02               # of a weight, against the pull of one toxic text
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n\r"]] = True


def sentences_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per part of the column: its first row and the row after the last, word features (two rows), sentence of each word,
    start, end and text of each sentence.

    A sentence is a run of bytes up to ``.``, ``!``, ``?`` or a line end that has words;
    words are compared in lower case. Starts and ends are code points of the text, of which
    lower case has as many. Texts are numbered within the part.
    """
    lowered = pc.utf8_lower(column.cast(pa.large_string()))
    data, offsets = utf8(lowered)
    for first, last in groups_of(offsets):
        part = offsets[first:last + 1] - offsets[first]
        piece = data[offsets[first]:offsets[last]]
        words, places, upto = word_hashes(piece, part, BY_MARK)
        begins, _, _ = word_hashes(piece, part, BY_MARK, PREFIX)
        shift = np.uint64(64 - BITS)
        features = np.stack([(words >> shift).astype(np.int64), (begins >> shift).astype(np.int64) + (1 << BITS)])
        cuts = np.unique(np.concatenate([np.flatnonzero(_ENDS[piece]) + 1, part]))
        cut = np.searchsorted(cuts, places, "right") - 1
        used, sentence = np.unique(cut, return_inverse=True)
        starts = cuts[used]
        ends = cuts[used + 1] if len(used) else starts
        text = np.searchsorted(part, starts, "right") - 1
        points = np.concatenate([[0], np.cumsum((piece & 0xC0) != 0x80)])
        yield first, last, features, sentence, points[starts] - points[part[text]], points[ends] - points[part[text]], text


def _sums(sentence: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(sentence, values, count)


@dataclass
class ToxicityModel:
    """A sentence is toxic with probability sigmoid(bias + its words' weights); a text if any sentence is (noisy-or)."""

    weights: np.ndarray
    bias: float

    def clean(self, features: np.ndarray, sentence: np.ndarray, count: int) -> np.ndarray:
        """Logarithm of each sentence's probability to be clean."""
        logits = self.bias + _sums(sentence, self.weights[features].sum(axis=0), count)
        return -np.logaddexp(0, logits)

    @staticmethod
    def fit(features: np.ndarray, sentence: np.ndarray, text: np.ndarray, labels: np.ndarray) -> ToxicityModel:
        """Gradient ascent on the likelihood of the texts' labels; both labels count alike.

        Only words that tell the labels apart get a weight, so that the other words of
        a toxic text are not learned by heart.
        """
        pairs = np.unique(features.ravel() * len(labels) + np.tile(text[sentence], 2))
        names, first, texts = np.unique(pairs // len(labels), return_index=True, return_counts=True)
        toxic = max(1, int((labels == 1).sum()))
        rate = toxic / len(labels)
        found = np.add.reduceat(labels[pairs % len(labels)], first) if len(first) else first
        deviations = np.abs(found - texts * rate) / np.sqrt(texts * rate * (1 - rate))
        used = names[(texts >= MIN_TEXTS) & (deviations >= MIN_Z)]
        places = np.searchsorted(used, features.ravel())
        telling = np.append(used, -1)[places] == features.ravel()
        places, holder = places[telling], np.tile(sentence, 2)[telling]
        share = np.where(labels == 1, 0.5 / toxic, 0.5 / max(1, (labels == 0).sum()))
        # many sentences alone must not make a text toxic, so the bias is set, not learned
        bias = float(np.log(BASE / max(1.0, np.quantile(np.bincount(text, minlength=len(labels)), 0.95))))
        place = np.zeros(len(used))
        mean, square = np.zeros_like(place), np.zeros_like(place)
        for step in range(1, STEPS + 1):
            logits = bias + _sums(holder, place[places], len(text))
            clean = np.log1p(-LEAK) - _sums(text, np.logaddexp(0, logits), len(labels))
            odds = np.where(labels == 1, np.exp(clean) / -np.expm1(clean), -1.0)
            by_sentence = (odds * share)[text] * 0.5 * (1 + np.tanh(logits / 2))
            up = _sums(places, by_sentence[holder], len(used)) - DECAY * 0.5 / toxic * place
            mean, square = 0.9 * mean + 0.1 * up, 0.99 * square + 0.01 * up ** 2
            place = place + RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-5)
        weights = np.zeros(2 << BITS, np.float32)
        weights[used] = place
        return ToxicityModel(weights, bias)


def _distinct(features: list[np.ndarray]) -> list[int]:
    """Texts that are no near copies of an earlier one; copies would make all their words look telling."""
    functions, seen, kept = permutations(BANDS * BAND_ROWS, 61), set(), []
    for i, words in enumerate(features):
        least = minhash(mix(np.unique(words).astype(np.uint64)), functions).reshape(BANDS, BAND_ROWS)
        bands = {(b, row.tobytes()) for b, row in enumerate(least)}
        if not bands & seen:
            kept.append(i)
        seen |= bands
    return kept


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel:
    """Model of ``labels.toxic`` (0 or 1, joined by ``doc_id``), fitted on about ``per_class`` whole texts of each label.

    The sample's word numbers (8 bytes a word) reach the driver. Rows without a label
    are left out. Without both labels every sentence is clean.
    """
    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, features, sentence, _, _, text in sentences_of(batch["text"]):
                sizes = np.bincount(sentence, minlength=len(text))
                words = np.concatenate([[0], np.cumsum(sizes)])
                bounds = np.searchsorted(text, np.arange(last - first + 1))
                of_text = [slice(words[lo], words[hi]) for lo, hi in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch["label"].slice(first, last - first),
                     pa.array([features[:, own].astype("<i4").tobytes() for own in of_text], pa.binary()),
                     pa.array([sizes[lo:hi].astype("<i4").tobytes() for lo, hi in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    ["label", "features", "sizes"])

    known = labels.select(F.col("doc_id").alias("labelled_id"), F.col("toxic").cast("int").alias("label")).filter("label IN (0, 1)")
    present = docs.select("doc_id").join(known, F.col("doc_id") == F.col("labelled_id")).select("labelled_id", "label")
    chosen = class_sample(present, "label", per_class, "labelled_id")
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id")).select("text", "label")
    found = sample.mapInArrow(count, "label int, features binary, sizes binary").toArrow().sort_by([("label", "ascending"), ("features", "ascending")])
    found = found.take(pa.array(_distinct([np.frombuffer(f.as_buffer(), "<i4") for f in found["features"]]), pa.int64()))
    marks = found["label"].to_numpy() if len(found) else np.zeros(0, np.int64)
    if len(set(marks.tolist())) < 2:
        return ToxicityModel(np.zeros(2 << BITS, np.float32), -50.0)
    features = np.concatenate([np.frombuffer(f.as_buffer(), "<i4").reshape(2, -1) for f in found["features"]], axis=1)
    sizes = [np.frombuffer(s.as_buffer(), "<i4") for s in found["sizes"]]
    text = np.repeat(np.arange(len(sizes)), [len(s) for s in sizes])
    flat = np.concatenate(sizes)
    return ToxicityModel.fit(features, np.repeat(np.arange(len(flat)), flat), text, marks)


def score_texts(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1), ``sentences`` and ``offending`` of every whole text.

    ``offending`` lists the sentences whose own probability reaches ``threshold``:
    ``start`` and ``end`` (code points of the given text, the end is the one after) and ``probability``. Null and empty
    texts, and texts without words, have no sentences and score 0. Repeated rows get a
    row each; other columns are ignored; an empty table gives no rows.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, counts = np.zeros(len(batch)), np.zeros(len(batch), np.int64)
            offending: list[list[dict]] = [[] for _ in range(len(batch))]
            for first, last, features, sentence, starts, ends, text in sentences_of(batch["text"]):
                clean = model.clean(features, sentence, len(text))
                scores[first:last] = -np.expm1(_sums(text, clean, last - first))
                counts[first:last] = np.bincount(text, minlength=last - first)
                for i in np.flatnonzero(-np.expm1(clean) >= threshold):
                    offending[first + text[i]].append({"start": int(starts[i]), "end": int(ends[i]), "probability": float(-np.expm1(clean[i]))})
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores), pa.array(counts), pa.array(offending, kind)],
                                             ["doc_id", "score", "sentences", "offending"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(score, "doc_id long, score double, sentences long, offending array<struct<start:long,end:long,probability:double>>")


def toxicity_of(docs: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1, threshold: float = 0.7) -> DataFrame:
    """Scores by a model that learns no label of the held fold: ``doc_id``, ``held_out``, ``score``, ``predicted``, ``sentences``, ``offending``."""
    model = fit_toxicity(docs, labels.filter(id_remainder(folds) != held_fold))
    scored = score_texts(docs, model, threshold)
    return scored.select("doc_id", (id_remainder(folds) == held_fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "sentences", "offending")
