"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of every learning row inside its task and sums the
counts by language and bucket, so the model is a matrix of ``languages x
buckets`` log-probabilities, whatever the input's size. It is broadcast, and a
batch of texts is scored as one gather from its columns and one sum per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import mix, row_sums, text_chunks, texts_of

#: Hash buckets of the n-grams, as a power of two, and the lengths of n-grams.
BUCKET_BITS = 14
LENGTHS = (1, 2, 3)
#: Added to every count.
SMOOTHING = 0.5
#: Predicted where a text is NULL or has no letter.
UNDETERMINED = "und"

PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def gram_buckets(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length of n-grams, their buckets in all lower-cased texts and how many each text has.

    What isn't a letter is a boundary; runs of it are one. A text without a
    letter has no n-gram.
    """
    lowered = [f"\n{t.lower()}\n" for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), dtype=np.uint32)
    sizes = np.fromiter(map(len, lowered), dtype=np.int64, count=len(texts))
    letter = _letters()[points]
    # Of a run of other characters, the first stays; each text begins and ends with one.
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    begins = np.cumsum(sizes) - sizes
    kept[begins] = letter[begins + 1]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)[kept]
    symbols = np.where(letter, points, 0)[kept].astype(np.uint64)
    found = []
    rolling = np.zeros(len(symbols), dtype=np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        m = max(len(symbols) - n + 1, 0)
        rolling = rolling[:m] * np.uint64(0x100000001B3) + symbols[n - 1 : n - 1 + m] + np.uint64(n)
        if n in LENGTHS:
            inside = symbols[:m] != 0 if n == 1 else owner[:m] == owner[n - 1 : n - 1 + m]
            buckets = (mix(rolling[inside]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
            found.append((buckets, np.bincount(owner[:m][inside], minlength=len(texts))))
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's rows by language and bucket; bucket -1 counts the rows."""
    totals: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in text_chunks(batches):
        langs = batch.column("lang").to_pylist()
        found = gram_buckets(texts_of(batch))
        for name in set(langs):
            own = np.array([x == name for x in langs])
            seen = sum(np.bincount(b[np.repeat(own, counts)], minlength=1 << BUCKET_BITS) for b, counts in found)
            totals[name] = totals.get(name, 0) + seen
            rows[name] = rows.get(name, 0) + int(own.sum())
    for name, seen in totals.items():
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({
            "lang": [name] * (len(used) + 1),
            "bucket": np.append(used, -1).astype(np.int32),
            "n": np.append(seen[used], rows[name]).astype(np.int64),
        })


@dataclass(frozen=True)
class Model:
    """Languages in order, their log-probabilities by bucket less the mean over languages, and log-priors."""

    langs: list[str]
    log_probabilities: np.ndarray
    log_priors: np.ndarray


def train(docs: DataFrame) -> Model:
    """Learn from ``text`` and ``lang`` of all rows whose ``lang`` isn't NULL.

    What reaches the driver is one count per language and bucket. Rows without
    text or letters teach the prior only. No rows give a model without
    languages.
    """
    learned = docs.select("text", "lang").where(F.col("lang").isNotNull())
    counts = learned.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    lang = np.array(table.column("lang").to_pylist(), dtype=object)
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    langs = sorted(set(lang))
    seen = np.full((len(langs), 1 << BUCKET_BITS), SMOOTHING)
    rows = np.ones(len(langs))
    for k, name in enumerate(langs):
        own = lang == name
        grams = own & (bucket >= 0)
        seen[k, bucket[grams]] += n[grams]
        rows[k] = max(1, n[own & (bucket < 0)].sum())
    log = np.log(seen / seen.sum(axis=1, keepdims=True)) if langs else seen
    return Model(langs, (log - log.mean(axis=0)).astype(np.float32) if langs else log, np.log(rows / rows.sum()))


def score(texts: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its posterior probability."""
    if not model.langs:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    sums = np.tile(model.log_priors, (len(texts), 1))
    letters = np.zeros(len(texts), dtype=np.int64)
    for buckets, counts in gram_buckets(texts):
        letters += counts
        for k, row in enumerate(model.log_probabilities):
            sums[:, k] += row_sums(row[buckets], counts)
    best = sums.argmax(axis=1)
    top = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    return [model.langs[b] if n else UNDETERMINED for b, n in zip(best, letters, strict=True)], np.where(letters > 0, top, 0.0)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of ``docs`` with a ``held_out`` column.

    Only the text counts. A NULL text or one without a letter is ``und`` with
    score 0, as is every text if the model has no language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            langs, scores = score(texts_of(batch), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast("int64"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(predict, PREDICTED)
