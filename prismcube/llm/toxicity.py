"""Toxicity: a support vector machine over a subsequence string kernel, by Nyström landmarks.

The kernel of two texts sums, over all sequences of ``ORDER`` letters, the
product of how strongly each text holds the sequence in order, gaps allowed: an
occurrence that spans ``n`` characters counts ``DECAY ** n``, and none spans
more than ``REACH``. An insult with letters put in or pulled apart therefore
still resembles the insult. Characters other than letters hold no place in a
sequence, but widen its span.

Landmarks are words of labelled documents: those that stand out in toxic ones
and the commonest of the others. A stretch of text is represented by its
kernels with the landmarks, whitened by the landmarks' own kernels (Nyström). A
document is as toxic as its worst stretch, and labels are of documents, so the
machine is trained in rounds: in each, every sentence gives its worst stretch
by the last round's machine, of which toxic documents give the worst one of all
as a positive and clean ones their worst few as negatives, which are kept.

A trained machine is linear in the kernel's sequences: it collapses into one
weight per sequence, and a text is scored in numpy by looking up the sequences
that begin at each of its characters.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import text_chunks, texts_of, written
from prismcube.operators.joins import measured

#: Letters of a sequence, the weight of one more character of span, and the longest span.
ORDER, DECAY, REACH = 4, 0.8, 7
#: Characters at which the sequences of a stretch may begin.
STRETCH = 12
#: A stretch is scaled by the length of its sequences' weights, or by this where it holds hardly any.
LEAST_SQUARES = 2 * DECAY ** (2 * ORDER)
#: Letters are told apart by so many bits.
LETTER_BITS = 5
#: Landmarks that stand out in toxic documents, and common ones.
STANDING_OUT, COMMON = 96, 32
#: Most labelled documents of either label that the machine is fitted to, those with the smallest id hashes.
TRAINING_ROWS = 2_000
#: Worst stretches, each of another sentence, that a clean document gives in a round, and rounds.
WORST, ROUNDS = 4, 6
#: Decisions are counted in bins of this width for calibration, up to so many on either side.
BIN, MOST_BINS = 1 / 16, 1 << 12
#: Characters of a text, or of many, that are looked at at once.
PIECE = 1 << 18
#: The cost of a stretch on the wrong side of the margin.
COST = 1.0
#: Letters of the words that landmarks are made of.
LANDMARK_LETTERS = (4, 24)
#: Ends a sentence: a mark before white space, or a line's end.
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")

WORD = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The code of each character: 1 to 26 for a to z whatever the case and accent, higher for other letters, 0 for the rest."""
    table = np.zeros(0x110000, dtype=np.uint8)
    table[0x3000:] = 27 + np.arange(0x110000 - 0x3000) % 5
    for point in range(0x3000):
        base = unicodedata.normalize("NFKD", chr(point).lower())[:1]
        if "a" <= base <= "z":
            table[point] = ord(base) - 96
        elif base.isalpha():
            table[point] = 27 + point % 5
    return table


def coded(text: str) -> np.ndarray:
    """The letters of a text as codes."""
    return _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]


def sequences(codes: np.ndarray, order: int = ORDER, reach: int = REACH) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each way to place the later letters: the sequence that begins at each place, whether all are letters, its span."""
    n = len(codes)
    padded = np.concatenate((codes, np.zeros(reach, dtype=np.uint8))).astype(np.int32)
    letter = padded > 0

    def grow(found: np.ndarray, valid: np.ndarray, last: int, left: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for place in range(last + 1, reach - left + 1):
            longer, whole = found << LETTER_BITS | padded[place : place + n], valid & letter[place : place + n]
            if left == 1:
                yield longer, whole, place + 1
            else:
                yield from grow(longer, whole, place, left - 1)

    yield from grow(padded[:n], letter[:n], 0, order - 1)


def profile(text: str, order: int = ORDER, decay: float = DECAY, reach: int = REACH) -> dict[int, float]:
    """How strongly a text holds each sequence."""
    out: dict[int, float] = {}
    for found, valid, span in sequences(coded(text), order, reach):
        for u in found[valid].tolist():
            out[u] = out.get(u, 0.0) + decay**span
    return out


def kernel(a: str, b: str, order: int = ORDER, decay: float = DECAY, reach: int = REACH) -> float:
    """The subsequence kernel of two texts."""
    x, y = profile(a, order, decay, reach), profile(b, order, decay, reach)
    return sum(v * y.get(u, 0.0) for u, v in x.items())


@dataclass(frozen=True)
class Landmarks:
    """Landmark words, the sequences they hold, and how strongly each holds them, scaled to kernel 1 with itself."""

    words: list[str]
    known: np.ndarray  # sequences, sorted
    strength: np.ndarray  # by sequence and landmark
    whitening: np.ndarray  # the landmarks' kernels to the power of -1/2

    @classmethod
    def of(cls, words: list[str]) -> Landmarks:
        profiles = [(w, p) for w, p in ((w, profile(w)) for w in words) if p]
        if not profiles:
            return cls([], np.zeros(0, dtype=np.int32), np.zeros((0, 0)), np.zeros((0, 0)))
        known = np.array(sorted({u for _, p in profiles for u in p}), dtype=np.int32)
        strength = np.zeros((len(known), len(profiles)))
        for j, (_, p) in enumerate(profiles):
            at = np.searchsorted(known, np.array(list(p), dtype=np.int32))
            strength[at, j] = list(p.values())
        strength /= np.sqrt((strength**2).sum(axis=0))
        values, vectors = np.linalg.eigh(strength.T @ strength)
        keep = values > 1e-8
        whitening = vectors[:, keep] / np.sqrt(values[keep]) @ vectors[:, keep].T
        return cls([w for w, _ in profiles], known, strength, whitening)

    def kernels(self, codes: np.ndarray, begin: int, end: int) -> np.ndarray:
        """Scaled kernels of a stretch, the sequences beginning at places ``begin`` to ``end``, with the landmarks."""
        out, squares = np.zeros(self.strength.shape[1]), 0.0
        for found, valid, span in sequences(codes[begin : end + REACH]):
            own = found[: end - begin][valid[: end - begin]]
            squares += DECAY ** (2 * span) * len(own)
            at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
            hit = at[self.known[at] == own]
            if len(hit):
                out += DECAY**span * self.strength[hit].sum(axis=0)
        return out / np.sqrt(max(squares, LEAST_SQUARES))

    def weights(self, by_landmark: np.ndarray) -> np.ndarray:
        """One weight per sequence, from one per landmark."""
        table = np.zeros(1 << LETTER_BITS * ORDER, dtype=np.float32)
        table[self.known] = self.strength @ by_landmark
        return table


def joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts in one array, where each begins, and whether a place is a part's; non-letters after each keep it to itself."""
    gap = np.zeros(REACH + STRETCH, dtype=np.uint8)
    sizes = np.array([len(p) + len(gap) for p in parts], dtype=np.int64)
    flat = np.concatenate([x for p in parts for x in (p, gap)]) if parts else gap[:0]
    begins = np.cumsum(sizes) - sizes
    own = np.zeros(len(flat), dtype=bool)
    for begin, part in zip(begins.tolist(), parts, strict=True):
        own[begin : begin + len(part)] = True
    return flat, begins, own


def _sums(values: np.ndarray) -> np.ndarray:
    """Sums over the stretches that begin at each place."""
    total = np.concatenate(([0.0], np.cumsum(values), np.zeros(STRETCH - 1)))
    total[len(values) + 1 :] = total[len(values)]
    return total[STRETCH:] - total[:-STRETCH]


@dataclass(frozen=True)
class Machine:
    """A trained machine: weights of sequences (0 with a non-letter), offset, and calibration of document scores."""

    weights: np.ndarray
    offset: float = 0.0
    scale: float = 1.0
    shift: float = 0.0

    def stretches(self, codes: np.ndarray) -> np.ndarray:
        """The decision for the stretch that begins at each place."""
        n = len(codes)
        held = np.zeros((REACH + 1, n), dtype=np.float32)
        number = np.zeros((REACH + 1, n), dtype=np.uint8)
        for found, valid, span in sequences(codes):
            held[span] += self.weights[found]
            number[span] += valid
        decay = DECAY ** np.arange(REACH + 1)
        held, squares = _sums(decay @ held), _sums(decay**2 @ number)
        return held / np.sqrt(np.maximum(squares, LEAST_SQUARES)) + self.offset

    def decision(self, texts: list[str]) -> np.ndarray:
        """The decision for the worst stretch of each text, the offset where there is none."""
        codes, begins, inside = joined([coded(t) for t in texts])
        out = np.full(len(texts), -np.inf)
        for at in range(0, len(codes), PIECE):
            # What a stretch reads beyond the piece is read with it.
            own = self.stretches(codes[at : at + PIECE + STRETCH + REACH])[:PIECE]
            own[~inside[at : at + PIECE]] = self.offset
            first = int(np.searchsorted(begins, at, side="right")) - 1
            last = int(np.searchsorted(begins, at + len(own)))
            places = np.maximum(begins[first:last] - at, 0)
            out[first:last] = np.maximum(out[first:last], np.maximum.reduceat(own, places))
        return out

    def probability(self, decisions: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * decisions + self.shift, -35, 35)))


def support_vectors(rows: np.ndarray, labels: np.ndarray, cost: float, passes: int = 30) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear machine with squared hinge loss, by Newton steps over the rows inside the margin.

    ``labels`` are 1 and -1; both sides weigh the same in all.
    """
    x = np.hstack((rows, np.ones((len(rows), 1), dtype=rows.dtype)))
    side = np.where(labels > 0, len(labels) / max(1, 2 * (labels > 0).sum()), len(labels) / max(1, 2 * (labels < 0).sum()))
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6

    def loss(v: np.ndarray) -> float:
        slack = np.maximum(0, 1 - labels * (x @ v))
        return 0.5 * v @ ridge @ v + cost * (side * slack**2).sum()

    now = loss(w)
    for _ in range(passes):
        margin = labels * (x @ w)
        inside = margin < 1
        own, weight = x[inside].astype(np.float64), 2 * cost * side[inside]
        gradient = ridge @ w - (weight * labels[inside] * (1 - margin[inside])) @ own
        step = np.linalg.solve(ridge + (own * weight[:, None]).T @ own, gradient)
        rate = 1.0
        while rate > 1e-4 and loss(w - rate * step) > now:
            rate /= 2
        w = w - rate * step
        before, now = now, loss(w)
        if before - now <= 1e-9 * max(1.0, before):
            break
    return w[:-1], float(w[-1])


def worst_stretches(text: str, machine: Machine, landmarks: Landmarks, most: int) -> np.ndarray:
    """The kernels of the worst stretch of each of the ``most`` worst sentences, a row each."""
    sentences = [c for c in map(coded, SENTENCE.split(text)) if np.count_nonzero(c) >= ORDER]
    if not sentences:
        return np.zeros((0, len(landmarks.words)))
    codes, begins, inside = joined(sentences)
    decisions = machine.stretches(codes)
    decisions[~inside] = -np.inf
    worst = np.maximum.reduceat(decisions, begins)
    rows = []
    for i in np.argsort(-worst, kind="stable")[:most]:
        at = int(decisions[begins[i] : begins[i] + len(sentences[i])].argmax())
        rows.append(landmarks.kernels(sentences[i], at, min(at + STRETCH, len(sentences[i]))))
    return np.array(rows)


def calibrated(machine: Machine, decisions: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> Machine:
    """Platt scaling from how many documents of either label have each decision."""
    positives, negatives = toxic.sum(), clean.sum()
    high, low = (positives + 1) / (positives + 2), 1 / (negatives + 2)
    a, b = 1.0, 0.0

    def loss(a: float, b: float) -> float:
        z = a * decisions + b
        every = toxic + clean
        return float((every * np.logaddexp(0, z) - (toxic * high + clean * low) * z).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * decisions + b, -35, 35)))
        error = toxic * (p - high) + clean * (p - low)
        weight = (toxic + clean) * np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(error * decisions).sum(), error.sum()])
        hessian = np.array([[(weight * decisions**2).sum(), (weight * decisions).sum()], [(weight * decisions).sum(), weight.sum()]])
        move, rate = np.linalg.solve(hessian + 1e-9 * np.eye(2), gradient), 1.0
        while rate > 1e-6 and loss(a - rate * move[0], b - rate * move[1]) > loss(a, b):
            rate /= 2
        a, b = a - rate * move[0], b - rate * move[1]
        if abs(rate * move).max() < 1e-9:
            break
    return Machine(machine.weights, machine.offset, float(a), float(b))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word, how many of a chunk's documents of either label hold it."""
    least, most = LANDMARK_LETTERS
    for batch in text_chunks(batches):
        counts: dict[str, list[int]] = {}
        for text, label in zip(texts_of(batch), batch.column("label").to_pylist(), strict=True):
            for word in set(WORD.findall(text.lower())):
                if least <= len(word) <= most:
                    counts.setdefault(word, [0, 0])[label] += 1
        columns = [pa.array(list(counts), pa.string()), *(pa.array([c[k] for c in counts.values()], pa.int64()) for k in (0, 1))]
        yield pa.RecordBatch.from_arrays(columns, ["word", "clean", "toxic"])


def choose_landmarks(labelled: DataFrame, standing_out: int = STANDING_OUT, common: int = COMMON) -> tuple[dict[str, float], list[str]]:
    """The words that stand out in toxic documents of ``label, text``, with how much, and the commonest of clean ones.

    All rows are counted. What speaks for a word is the number of documents
    that hold it times the divergence of their toxic share from the share of
    all; that must outweigh the choice among all distinct words, or rare words
    of a few documents would stand out by chance.
    """
    counts = written(
        labelled.select("label", "text").mapInArrow(_word_counts, "word string, clean long, toxic long")
        .groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")),
        "toxic-words",
    )
    share = labelled.agg(F.avg("label")).first()[0]
    if not share or share == 1:
        return {}, []
    held = F.col("clean") + F.col("toxic")
    toxic, clean = F.col("toxic") / held, F.col("clean") / held

    def part(own, of_all: float):
        return F.when(own > 0, own * F.log(own / F.lit(of_all))).otherwise(0.0)

    evidence = held * (part(toxic, share) + part(clean, 1 - share))
    chance = math.log(max(2, counts.count()))
    ranked = counts.where(toxic > F.lit(share)).select("word", evidence.alias("evidence")).where(F.col("evidence") > chance)
    out = {r["word"]: r["evidence"] for r in ranked.orderBy(F.col("evidence").desc(), "word").limit(standing_out).collect()}
    often = counts.where("clean > 0").orderBy(F.col("clean").desc(), "word").limit(common + len(out)).collect()
    return out, [r["word"] for r in often if r["word"] not in out][:common]


def _kernels_of(shared):
    """Kernels of the worst stretches of each row, one list of numbers."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, landmarks, worst = shared.value
        for batch in text_chunks(batches):
            rows = [
                worst_stretches(text, machine, landmarks, 1 if label else worst).astype(np.float32).reshape(-1)
                for text, label in zip(texts_of(batch), batch.column("label").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("text_hash"), batch.column("label"), pa.array(rows, pa.list_(pa.float32()))],
                ["place", "text_hash", "label", "kernels"],
            )

    return each


def _bins(shared):
    """The decision of each row, in bins."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            bins = np.clip(np.floor(shared.value.decision(texts_of(batch)) / BIN), -MOST_BINS, MOST_BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("label")], ["bin", "label"])

    return each


def train(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS, rounds: int = ROUNDS) -> Machine:
    """A machine learned from ``doc_id, text`` and ``doc_id, label``.

    Landmarks and calibration take all labelled documents. The machine is
    fitted to ``most`` ids of either label, those with the smallest hashes;
    where an id stands on several documents, to the one with the smallest text
    hash. NULL labels and ids are left out. Where no word stands out, every
    score is the smoothed share of toxic labels, and 0 without labels.
    """
    context = docs.sparkSession.sparkContext
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    # Labels that are few enough go to the documents, so that no text is shuffled.
    labelled = docs.select("doc_id", "text").join(measured(known.distinct()), "doc_id")
    labelled = written(labelled.select(F.xxhash64("doc_id").alias("place"), F.xxhash64("text").alias("text_hash"), "label", "text"), "labelled")
    out, common = choose_landmarks(labelled)
    landmarks = Landmarks.of([*out, *common])
    if not out or not landmarks.words:
        toxic, every = labelled.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
        shift = math.log((toxic + 1) / (every - toxic + 1)) if every else -math.inf
        return Machine(np.zeros(1 << LETTER_BITS * ORDER, dtype=np.float32), scale=0.0, shift=shift)

    ids = [labelled.where(F.col("label") == k).select("place", "label").distinct().orderBy("place").limit(most) for k in (0, 1)]
    sample = written(labelled.join(F.broadcast(ids[0].unionByName(ids[1])), ["place", "label"]), "toxic-sample")
    # The first machine leans on the words that stand out, the more the more they do.
    most_evidence = max(out.values())
    lead = np.array([out[w] / most_evidence if w in out else -0.1 for w in landmarks.words])
    machine = Machine(landmarks.weights(landmarks.whitening @ landmarks.whitening @ lead))
    clean: list[np.ndarray] = []
    for _ in range(rounds):
        shared = context.broadcast((machine, landmarks, WORST))
        found = sample.select("place", "text_hash", "label", "text").mapInArrow(
            _kernels_of(shared), "place long, text_hash long, label int, kernels array<float>"
        )
        table = found.groupBy("place", "label").agg(F.min_by("kernels", "text_hash").alias("kernels")).orderBy("place", "label").toArrow()
        toxic, new = _by_label(table, len(landmarks.words))
        # What was the worst of a clean document stays a negative, or the next machine might fall for it again.
        clean.append(new)
        rows = np.vstack([toxic, *clean])
        sides = np.where(np.arange(len(rows)) < len(toxic), 1, -1)
        weights, offset = support_vectors(rows @ landmarks.whitening.astype(np.float32), sides, COST)
        machine = Machine(landmarks.weights(landmarks.whitening @ weights), offset)
        shared.unpersist()
    counted = labelled.mapInArrow(_bins(context.broadcast(machine)), "bin int, label int").groupBy("bin").agg(
        F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean")
    )
    bins = np.array([[r["bin"], r["toxic"], r["clean"]] for r in counted.orderBy("bin").collect()], dtype=float)
    return calibrated(machine, (bins[:, 0] + 0.5) * BIN, bins[:, 1], bins[:, 2])


def _by_label(table: pa.Table, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """The kernels of toxic and of clean documents as rows."""
    of = table.column("label").to_pylist()
    kernels = [k.values.to_numpy().reshape(-1, wide) for k in table.column("kernels")]
    return tuple(np.vstack([np.zeros((0, wide), dtype=np.float32), *(k for k, own in zip(kernels, of, strict=True) if own == label)]) for label in (1, 0))


def score_toxicity(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs`` with a ``held_out`` column.

    A text is as toxic as its worst stretch; a NULL text is empty, and one
    without a sequence of letters has the score of that.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            scores = shared.value.probability(shared.value.decision(texts_of(batch)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast("int64"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(predict, "doc_id long, held_out boolean, score double, predicted int")
