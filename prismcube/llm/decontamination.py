"""Benchmark decontamination by edit distance over words.

The random walk of Chakraborty, Goldenberg and Koucky reads a sequence of
words and repeats or passes each word as a hash of the step and the word
decides. Two walks that meet the same word at the same step move alike, so an
edit shifts one walk for a while and then they tend to fall into step again:
edit distance becomes Hamming distance of what the walks read. Bit-sampling
locality-sensitive hashing over that takes a few steps of a walk as a key.

Windows begin at every word of an item and of a document, and keys are sampled
from a walk's first steps, so a window as long as the item needs only the walk
up to there, and one stretch of an item that was left alone is enough. Walks are
repeated until the recall on edited copies of the items themselves reaches the
target. Candidates are verified by the exact edit distance of the item to the
best-fitting part of the document, within the task that found them: documents
aren't shuffled.
"""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import mix, text_chunks, texts_of, word_hashes, written

#: Least similarity of a match: 1 - edits / words of the item.
SIMILARITY = 0.8
#: Share of edited copies that the walks must find, and the most walks tried.
RECALL, MOST_WALKS = 0.98, 256
#: Edited copies by which the walks of a band are calibrated.
TRIALS = 400
#: Keys sampled from each walk.
SAMPLES = 2
#: Words of items that one pass over the documents looks for; more items take more passes.
PASS_WORDS = 100_000
#: Verified places of a document are told apart by so many words.
STRIDE = 16

MATCHES = "doc_id long, item_id long, distance int, item_words int, similarity double, first_word long, end_word long"


@dataclass(frozen=True)
class Band:
    """Items of at least ``least`` words: keys of ``width`` steps from walks of ``steps`` steps."""

    least: int
    steps: int
    width: int


#: A key never reads beyond its item: a walk of n steps reads n words at most.
BANDS = (Band(16, 12, 6), Band(8, 6, 4), Band(3, 3, 3), Band(2, 2, 2), Band(1, 1, 1))


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words without case and punctuation, and how many each text has."""
    return word_hashes([t.lower().encode("utf-8", "replace") for t in texts], marks="dropped")


def walk_keys(words: np.ndarray, ends: np.ndarray, band: int, walk: int) -> list[np.ndarray]:
    """Keys of the windows that begin at every word; ``ends`` is where the text of each word ends.

    Past the end of a text a walk reads the same mark at every step.
    """
    steps, width = BANDS[band].steps, BANDS[band].width
    moves = mix(words ^ np.uint64(0x9E3779B97F4A7C15 * (band * 1000 + walk + 1) % (1 << 64)))
    chosen = [np.random.default_rng((band, walk, k)).permutation(steps)[:width] for k in range(SAMPLES)]
    keys = [np.full(len(words), (band * 1000 + walk) * SAMPLES + k + 1, dtype=np.uint64) for k in range(SAMPLES)]
    needed = max(int(c.max()) for c in chosen) + 1
    place = np.arange(len(words))
    last = max(len(words) - 1, 0)
    for step in range(needed):
        inside = place < ends
        at = np.minimum(place, last)
        for key, steps_of in zip(keys, chosen, strict=True):
            if step in steps_of:
                np.add(key * np.uint64(0xFF51AFD7ED558CCD), np.where(inside, words[at], np.uint64(0)), out=key)
        place = place + ((moves[at] >> np.uint64(step)) & np.uint64(1)).astype(np.int64) * inside
    return [mix(key) for key in keys]


@dataclass(frozen=True)
class Items:
    """What one pass looks for; broadcast. Its size follows from ``PASS_WORDS`` and the number of walks."""

    ids: list[list[int]]  # of the items that have these words
    lists: list[list[int]]  # words
    bags: list[dict[int, int]]  # how often an item has each word
    allowed: list[int]  # edits
    walks: dict[int, int]  # by band
    keys: np.ndarray  # sorted
    item: np.ndarray
    offset: np.ndarray
    seen: np.ndarray  # whether any key has these first bits
    shift: int

    def candidates(self, words: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Place among ``words``, item, and place in the item, of windows that share a key."""
        ends = np.repeat(np.cumsum(counts), counts)
        for band, walks in self.walks.items():
            for walk in range(walks):
                for keys in walk_keys(words, ends, band, walk):
                    at = np.flatnonzero(self.seen[keys >> np.uint64(self.shift)])
                    low = np.searchsorted(self.keys, keys[at], side="left")
                    n = np.searchsorted(self.keys, keys[at], side="right") - low
                    entry = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                    yield np.repeat(at, n), self.item[entry], self.offset[entry]


def edits_allowed(words: int, similarity: float) -> int:
    return int(words * (1 - similarity) + 1e-9)


def band_of(words: int) -> int:
    return next(k for k, band in enumerate(BANDS) if words >= band.least)


def index_items(ids: list[list[int]], sequences: list[np.ndarray], walks: dict[int, int], similarity: float) -> Items:
    """Keys of every window of the items that doesn't reach beyond its item."""
    keys, items, offsets = [], [], []
    for band, times in walks.items():
        own = [k for k, w in enumerate(sequences) if band_of(len(w)) == band]
        if not own:
            continue
        counts = np.array([len(sequences[k]) for k in own])
        words = np.concatenate([sequences[k] for k in own])
        ends = np.repeat(np.cumsum(counts), counts)
        offset = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
        whole = offset + BANDS[band].steps <= np.repeat(counts, counts)
        for walk in range(times):
            for key in walk_keys(words, ends, band, walk):
                keys.append(key[whole])
                items.append(np.repeat(own, counts)[whole])
                offsets.append(offset[whole])
    flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
    order = np.argsort(flat, kind="stable")
    bits = max(16, min(27, (64 * len(flat)).bit_length()))
    seen = np.zeros(1 << bits, dtype=bool)
    seen[flat >> np.uint64(64 - bits)] = True
    item = np.concatenate(items).astype(np.int32) if items else np.zeros(0, dtype=np.int32)
    offset = np.concatenate(offsets).astype(np.int32) if offsets else np.zeros(0, dtype=np.int32)
    allowed = [edits_allowed(len(w), similarity) for w in sequences]
    lists = [w.tolist() for w in sequences]
    bags = [dict(Counter(w)) for w in lists]
    return Items(ids, lists, bags, allowed, walks, flat[order], item[order], offset[order], seen, 64 - bits)


def edited(words: np.ndarray, edits: int, draw: np.random.Generator) -> np.ndarray:
    """A copy with ``edits`` words replaced, dropped or put in, at random."""
    copy = words.tolist()
    for _ in range(edits):
        at = int(draw.integers(0, len(copy) + 1))
        kind, new = int(draw.integers(0, 3)), int(draw.integers(1, 1 << 63))
        if kind == 0 or not copy:
            copy.insert(at, new)
        elif kind == 1:
            copy[min(at, len(copy) - 1)] = new
        else:
            del copy[min(at, len(copy) - 1)]
    return np.array(copy, dtype=np.uint64)


def settled(recalls: list[float]) -> bool:
    """Whether two doublings in a row brought nothing."""
    return len(recalls) > 2 and recalls[-1] == recalls[-3]


def calibrated_walks(sequences: list[np.ndarray], similarity: float, recall: float, trials: int = TRIALS) -> dict[int, int]:
    """Walks per band: twice as many until edited copies of the band's items are found as often as asked.

    Copies have as many edits as a match may have. ``trials`` copies per band
    are made, of evenly chosen items, from a fixed seed. Doubling ends, with a
    warning, where it brings nothing any more or at ``MOST_WALKS``; then the
    fewest walks with the highest recall are taken.
    """
    walks = {}
    for band in sorted({band_of(len(w)) for w in sequences}):
        own = [w for w in sequences if band_of(len(w)) == band]
        draw = np.random.default_rng(band)
        sample = [own[i * len(own) // trials] for i in range(trials)] if len(own) >= trials else [own[i % len(own)] for i in range(trials)]
        copies = [edited(w, edits_allowed(len(w), similarity), draw) for w in sample]
        words, counts = np.concatenate(copies), np.array([len(c) for c in copies])
        owner = np.repeat(np.arange(trials), counts)
        reached: dict[int, float] = {}
        times = 1
        # Copies without a stretch that a walk can read are found by no number of walks.
        while times < MOST_WALKS and max(reached.values(), default=0) < recall and not settled([*reached.values()]):
            times *= 2
            index = index_items([[i] for i in range(trials)], sample, {band: times}, similarity)
            found = np.zeros(trials, dtype=bool)
            for at, item, _ in index.candidates(words, counts):
                hit = owner[at] == item
                found[item[hit]] = True
            reached[times] = float(found.mean())
        best = max(reached.values())
        walks[band] = min(t for t, x in reached.items() if x == best)
        if best < recall:
            warnings.warn(f"items of {BANDS[band].least} words or more are found with a recall of {best:.3f}", stacklevel=2)
    return walks


def closest(pattern: list[int], text: list[int], anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a part of ``text``, and where the first such part ends.

    Bit-parallel over the pattern. ``anchored``: the part begins with the text.
    """
    masks: dict[int, int] = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(pattern)) - 1
    top = 1 << (len(pattern) - 1)
    more, less, score = full, 0, len(pattern)
    best, end = score, 0
    for j, w in enumerate(text):
        equal = masks.get(w, 0)
        vertical = equal | less
        horizontal = (((equal & more) + more) ^ more) | equal
        up = less | (~(horizontal | more) & full)
        down = more & horizontal
        score += bool(up & top) - bool(down & top)
        up = (up << 1 | anchored) & full
        down = (down << 1) & full
        more = down | (~(vertical | up) & full)
        less = up & vertical
        if score < best:
            best, end = score, j + 1
    return best, end


def shared_words(bag: dict[int, int], text: list[int]) -> int:
    """How many words of ``text`` stand for a word of ``bag``, each as often as it is there."""
    known = [w for w in text if w in bag]
    return sum(min(n, bag[w]) for w, n in Counter(known).items())


def matches(words: np.ndarray, counts: np.ndarray, items: Items) -> dict[tuple[int, int], tuple[int, int, int]]:
    """By text and item: edit distance, first and end word of the best-fitting part, where it is allowed."""
    begins = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    places = set()
    for at, item, offset in items.candidates(words, counts):
        where = (at - begins[owner[at]] - offset) // STRIDE
        places.update(zip(owner[at].tolist(), item.tolist(), where.tolist(), strict=True))
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for text, item, where in sorted(places):
        best = found.get((text, item))
        if best and best[0] == 0:
            continue
        pattern, allowed = items.lists[item], items.allowed[item]
        low = max(0, where * STRIDE - allowed)
        high = min(int(counts[text]), (where + 1) * STRIDE + len(pattern) + allowed)
        part = words[begins[text] + low : begins[text] + high].tolist()
        if shared_words(items.bags[item], part) < len(pattern) - allowed:
            continue  # each edit takes one word of the item away at most
        distance, end = closest(pattern, part)
        if distance <= allowed and (best is None or distance < best[0]):
            _, back = closest(pattern[::-1], part[:end][::-1], anchored=True)
            found[text, item] = (distance, low + end - back, low + end)
    return found


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches):
        words, counts = words_of(texts_of(batch))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(words.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), lists], ["item_id", "words"])


@dataclass(frozen=True)
class Benchmark:
    """The distinct items as a written table ``words, ids, block``, the number of blocks, and the walks of each band."""

    items: DataFrame
    blocks: int
    walks: dict[int, int]
    similarity: float

    def index(self, block: int) -> Items:
        """What one pass looks for: the items of a block, about ``PASS_WORDS`` words, with the keys of their windows."""
        rows = self.items.where(F.col("block") == block).orderBy("words").collect()
        sequences = [np.array(r["words"], dtype=np.int64).view(np.uint64) for r in rows]
        return index_items([r["ids"] for r in rows], sequences, self.walks, self.similarity)


def prepared(benchmark: DataFrame, similarity: float, recall: float) -> Benchmark:
    """Deal the items out to blocks and calibrate the walks.

    Reads ``item_id`` and ``text``; NULL ids, and texts without a word, are
    left out. Items with the same words are looked for once. The driver holds
    one block at a time, and of each band the ``TRIALS`` items with the
    smallest hashes, by which the walks are calibrated.
    """
    read = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    words = read.mapInArrow(_item_words, "item_id long, words array<long>").where(F.size("words") > 0)
    distinct = written(words.groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("ids")), "items")
    total = distinct.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    blocks = -(-total // PASS_WORDS)
    items = distinct.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(max(1, blocks))))
    sample = []
    above = None
    for band in BANDS:
        size = F.size("words")
        own = distinct.where((size >= band.least) & (F.lit(True) if above is None else size < above))
        chosen = own.orderBy(F.xxhash64("words"), "words").limit(TRIALS).collect()
        chosen.sort(key=lambda r: (r["ids"][0], r["words"]))
        sample += [np.array(r["words"], dtype=np.int64).view(np.uint64) for r in chosen]
        above = band.least
    return Benchmark(items, blocks, calibrated_walks(sample, similarity, recall) if sample else {}, similarity)


def find_contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """``doc_id, item_id, distance, item_words, similarity, first_word, end_word``: items found in rows of ``docs``.

    One row for each row of ``docs`` and item, with the best-fitting part of
    the text: words ``first_word`` to ``end_word``, end exclusive, are
    ``distance`` word edits from the item. A NULL text has no word; no items
    give no rows.
    """
    context = docs.sparkSession.sparkContext

    def search(shared):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in text_chunks(batches):
                words, counts = words_of(texts_of(batch))
                doc_ids = batch.column("doc_id").to_pylist()
                rows = [
                    (doc_ids[text], name, distance, n := len(items.lists[item]), 1 - distance / n, first, end)
                    for (text, item), (distance, first, end) in matches(words, counts, items).items()
                    for name in items.ids[item]
                ]
                if rows:
                    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64()]
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in MATCHES.split(", ")])

        return each

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = prepared(benchmark, similarity, recall)
    passes = []
    for block in range(items.blocks):
        shared = context.broadcast(items.index(block))
        passes.append(written(read.mapInArrow(search(shared), MATCHES), "matches"))
        shared.destroy()  # one block's index is held at a time
    if not passes:
        return docs.sparkSession.createDataFrame([], MATCHES)
    return reduce(DataFrame.unionByName, passes)


def without_contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no item is found."""
    context = docs.sparkSession.sparkContext

    def clean(shared):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_chunks(batches):
                words, counts = words_of(texts_of(batch))
                hit = {text for text, _ in matches(words, counts, shared.value)}
                yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)]))

        return each

    items = prepared(benchmark, similarity, recall)
    for block in range(items.blocks):
        shared = context.broadcast(items.index(block))
        docs = docs.mapInArrow(clean(shared), docs.schema)
        if block < items.blocks - 1:
            docs = written(docs, "clean")
            shared.destroy()
    return docs
