"""Cross-tokenizer alignment by divide and conquer at shared cuts.

A text is encoded by two tokenizers, and the tokens of either cover the same
bytes. Where a token of both ends, the text can be cut. To find the cuts of a
stretch, ends of the first tokenizer around its middle are looked up among those
of the second by bisection, ever wider until one is common; then the parts to
the left and to the right of what was looked at are searched alike. A stretch
without a common end is a leaf: its tokens are one group. All stretches of a
chunk of texts take a step together, so a step is a few numpy calls.

Ids of a group are linked. How many documents link two ids is counted by Spark
over the whole corpus, and every document meets the counts again: by broadcast
if the counted pairs are few enough, by a join otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import row_sums, text_chunks, texts_of, written
from prismcube.llm.wavelet import Encoder, extended

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Most counted pairs that are broadcast; more are joined.
BROADCAST_PAIRS = 2_000_000
#: A group of more links is counted by its distinct ids.
LARGE_GROUP = 4096
#: Links of a chunk that are held one by one; then they are added up.
HELD_LINKS = 1 << 22
#: Pairs of a batch that are looked up at once.
LOOKED_UP = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair(Encoder):
    """The two tokenizers: how they encode, and the bytes of their tokens.

    The first one gets a text with a blank before it, as the second one puts
    there itself; strings of special tokens are plain text. Neither has tokens
    across a single blank, so the words of a text in which all blanks are
    single are encoded once each, by both (see ``Encoder``).
    """

    def __init__(self, byte_level: str, pieces: str) -> None:
        self.second = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.second_bytes = []
        for i in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode()
            self.second_bytes.append(raw)
        # A piece that goes on after a blank would join words.
        self.by_word = not any(p.strip("▁") and "▁" in p[1:] for p in map(self.second.id_to_piece, range(len(self.second_bytes))))
        super().__init__(byte_level)
        self.tokenizer.encode_special_tokens = True
        self.special = []
        byte_of = byte_alphabet()
        entries = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        # A special token's entry may hold characters beyond the alphabet; no text is encoded to it.
        self.first_bytes = [bytes(byte_of[c] for c in e if c in byte_of) for e in entries]
        self.first_sizes = np.array([len(b) for b in self.first_bytes])
        self.second_sizes = np.array([len(b) for b in self.second_bytes])
        most = max(len(self.first_bytes), len(self.second_bytes))
        #: Each id and what follows it: another one of its side, the other side, another group.
        self.shown = [f"{i}{mark}" for i in range(most) for mark in ",|;"]

    def _forget(self) -> None:
        super()._forget()
        self.second_flat = np.zeros(0, dtype=np.uint32)
        self.second_starts = np.zeros(1, dtype=np.int64)
        self.spelled = np.zeros(0, dtype=bool)

    def _spells(self, first: list[int], second: list[int], text: str) -> bool:
        """Whether the tokens of both sides are a blank and the text, byte by byte."""
        raw = b" " + text.encode()
        return b"".join(map(self.first_bytes.__getitem__, first)) == raw == b"".join(map(self.second_bytes.__getitem__, second))

    def _learn(self, words: list[str]) -> None:
        begin = len(self.starts) - 1
        super()._learn(words)
        second = self.second.encode(words, num_threads=1)
        first = [self.flat[a:b].tolist() for a, b in zip(self.starts[begin:-1], self.starts[begin + 1 :], strict=True)]
        spelled = [self._spells(a, b, w) for a, b, w in zip(first, second, words, strict=True)]
        sizes = np.fromiter(map(len, second), dtype=np.int64, count=len(second))
        ids = np.fromiter(chain.from_iterable(second), dtype=np.uint32, count=int(sizes.sum()))
        self.second_starts = extended(self.second_starts, len(self.second_flat) + np.cumsum(sizes))
        self.second_flat = extended(self.second_flat, ids)
        self.spelled = extended(self.spelled, np.array(spelled, dtype=bool))

    def encode_both(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of each text by both; none where the text is empty or either's bytes aren't those of the text."""
        if len(self.places) > self.WORDS or self.characters > self.CHARACTERS:
            self._forget()
        none = np.zeros(0, dtype=np.int64)
        first, second = [none] * len(texts), [none] * len(texts)
        splits = [bool(t) and self.by_word and not t[0].isspace() and self._splits(t) for t in texts]
        whole = [i for i, (t, s) in enumerate(zip(texts, splits, strict=True)) if t and not s]
        some = [texts[i] for i in whole]
        if some:
            for i, a, b in zip(whole, self._whole([f" {t}" for t in some]), self.second.encode(some, num_threads=1), strict=True):
                if self._spells(a.tolist(), b, texts[i]):
                    first[i], second[i] = a.astype(np.int64), np.array(b, dtype=np.int64)
        words = {i: texts[i].split(" ") for i, s in enumerate(splits) if s}
        number = self.places.__getitem__
        at = [np.fromiter(map(number, w), dtype=np.int64, count=len(w)) for w in words.values()]
        if fresh := self.places.fresh():
            self._learn(fresh)
        for i, own in zip(words, at, strict=True):
            if self.spelled[own].all():
                first[i] = self.flat[ranges(self.starts[own], self.starts[own + 1])[0]].astype(np.int64)
                second[i] = self.second_flat[ranges(self.second_starts[own], self.second_starts[own + 1])[0]].astype(np.int64)
        return first, second


@lru_cache(maxsize=2)
def _pair(byte_level: str, pieces: str) -> Pair:
    """One pair of tokenizers per worker, which keeps its words from task to task."""
    return Pair(byte_level, pieces)


def ranges(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the given ranges, one after another, and the number of the range of each."""
    sizes = np.maximum(ends - begins, 0)
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begins[of], of


def shared_cuts(first: np.ndarray, second: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each of the ``first`` ends is also one of the ``second``.

    Both grow. Stretches, places ``begins`` to ``ends`` among the first, are
    searched from the middle outwards until a common end is found, then to
    both sides of what was looked at; no end is looked up twice.
    """
    cut = np.zeros(len(first), dtype=bool)
    low, high = begins, ends
    while len(low):
        middle = (low + high) // 2
        left, right = middle.copy(), middle.copy()  # what was looked at, from left up to right
        waiting, radius = np.flatnonzero(low < high), 1
        while len(waiting):
            wide = np.maximum(middle[waiting] - radius + 1, low[waiting]), np.minimum(middle[waiting] + radius, high[waiting])
            before, by = ranges(wide[0], left[waiting])
            after, by_after = ranges(right[waiting], wide[1])
            places, by = np.concatenate((before, after)), np.concatenate((by, by_after))
            sought = first[places]
            common = second[np.minimum(np.searchsorted(second, sought), len(second) - 1)] == sought
            cut[places[common]] = True
            left[waiting], right[waiting] = wide
            hit = np.zeros(len(waiting), dtype=bool)
            hit[by[common]] = True
            whole = (wide[0] == low[waiting]) & (wide[1] == high[waiting])
            waiting = waiting[~hit & ~whole]
            radius *= 2
        low, high = np.concatenate((low, right)), np.concatenate((left, high))
        open_ = low < high
        low, high = low[open_], high[open_]
    return cut


@dataclass(frozen=True)
class Aligned:
    """The groups of a chunk of documents: consecutive tokens of both sides, and where groups and documents end."""

    first: np.ndarray
    second: np.ndarray
    first_ends: np.ndarray  # tokens of the first up to the end of each group
    second_ends: np.ndarray
    group_ends: np.ndarray  # groups up to the end of each document
    first_counts: np.ndarray  # tokens of each document
    second_counts: np.ndarray

    def group_sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return np.diff(self.first_ends, prepend=0), np.diff(self.second_ends, prepend=0)

    def groups_of(self) -> np.ndarray:
        """The document of each group."""
        return np.repeat(np.arange(len(self.group_ends)), np.diff(self.group_ends, prepend=0))


def aligned(pair: Pair, texts: list[str]) -> Aligned:
    """Encode and align texts."""
    first, second = pair.encode_both(texts)
    flat = [np.concatenate([*side, np.zeros(0, dtype=np.int64)]) for side in (first, second)]
    first_counts, second_counts = (np.array([len(x) for x in side], dtype=np.int64) for side in (first, second))
    a, b = np.cumsum(pair.first_sizes[flat[0]]), np.cumsum(pair.second_sizes[flat[1]])
    full = first_counts > 0
    last = np.cumsum(first_counts)[full] - 1
    cut = shared_cuts(a, b, last + 1 - first_counts[full], last)
    cut[last] = True  # both end where the text does
    places = np.flatnonzero(cut)
    return Aligned(
        *flat,
        places + 1,
        np.searchsorted(b, a[places]) + 1,
        np.searchsorted(places, np.cumsum(first_counts)),
        first_counts,
        second_counts,
    )


def shown_groups(pair: Pair, found: Aligned) -> list[str]:
    """The groups of each document as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    firsts, seconds = found.group_sizes()
    group_a, group_b = np.repeat(np.arange(len(firsts)), firsts), np.repeat(np.arange(len(seconds)), seconds)
    out = np.empty(len(found.first) + len(found.second), dtype=np.int64)
    a, b = found.first * 3, found.second * 3
    a[found.first_ends - 1] += 1
    b[found.second_ends - 1] += 2
    out[np.arange(len(a)) + (found.second_ends - seconds)[group_a]] = a
    out[np.arange(len(b)) + found.first_ends[group_b]] = b
    parts = list(map(pair.shown.__getitem__, out.tolist()))
    ends = np.cumsum(found.first_counts + found.second_counts).tolist()
    return ["".join(parts[begin:end])[:-1] for begin, end in zip([0, *ends], ends, strict=False)]


def linked_pairs(found: Aligned, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair (first id times ``wide`` plus second id) and number of its links, for all pairs of each document."""
    firsts, seconds = found.group_sizes()
    links, of = firsts * seconds, found.groups_of()
    small = np.flatnonzero(links <= LARGE_GROUP)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    keep = 0

    def add_up() -> None:
        docs, pairs, times = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((pairs, docs))
        docs, pairs, times = docs[order], pairs[order], times[order]
        new = np.flatnonzero(np.r_[True, (np.diff(docs) != 0) | (np.diff(pairs) != 0)]) if len(docs) else docs[:0]
        held[:] = [(docs[new], pairs[new], np.add.reduceat(times, new) if len(new) else times)]

    def hold(docs: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> None:
        nonlocal keep
        held.append((docs, pairs, times))
        keep += len(pairs)
        if keep > HELD_LINKS:
            add_up()
            # Twice what is distinct, so that adding up again pays.
            keep = -len(held[0][0])

    cuts = np.searchsorted(np.cumsum(links[small]), np.arange(HELD_LINKS, links[small].sum() + 1, HELD_LINKS))
    for own in np.split(small, cuts):
        k, g = ranges(np.zeros(len(own), dtype=np.int64), links[own])
        group = own[g]
        a = found.first[found.first_ends[group] - firsts[group] + k // seconds[group]]
        b = found.second[found.second_ends[group] - seconds[group] + k % seconds[group]]
        hold(of[group], a * wide + b, np.ones(len(a), dtype=np.int64))
    for group in np.flatnonzero(links > LARGE_GROUP).tolist():
        a, times_a = np.unique(found.first[found.first_ends[group] - firsts[group] : found.first_ends[group]], return_counts=True)
        b, times_b = np.unique(found.second[found.second_ends[group] - seconds[group] : found.second_ends[group]], return_counts=True)
        step = max(1, HELD_LINKS // len(b))
        for at in range(0, len(a), step):
            pairs = (a[at : at + step, None] * wide + b).reshape(-1)
            hold(np.full(len(pairs), of[group]), pairs, (times_a[at : at + step, None] * times_b).reshape(-1))
    add_up()
    return held[0]


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Consecutive values as lists of the given lengths."""
    offsets = np.concatenate(([0], np.cumsum(counts)))
    if offsets[-1] < 1 << 31:
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
    parts = [pa.array(values[a:b], kind).to_pylist() for a, b in zip(offsets, offsets[1:], strict=False)]
    return pa.array(parts, pa.list_(kind))


def _paths(byte_level: str | None, pieces: str | None) -> tuple[str, str]:
    return byte_level or public_tokenizers.path(BYTE_LEVEL), pieces or public_tokenizers.path(PIECES)


def align_documents(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """``doc_id, first_ids, second_ids, first_ends, second_ends`` for each row of ``docs``.

    Group ``k`` of a document holds the ids before ``first_ends[k]`` and
    ``second_ends[k]``, from where the group before it ends. The first
    tokenizer gets the text with a blank before it, as the second one puts
    there itself. A text that is NULL or empty, or that the tokens of either
    don't spell byte by byte, has none.
    """
    paths = _paths(byte_level, pieces)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*paths)
        for batch in text_chunks(batches):
            found = aligned(pair, texts_of(batch))
            groups = np.diff(found.group_ends, prepend=0)
            begins = [np.cumsum(c) - c for c in (found.first_counts, found.second_counts)]
            of = found.groups_of()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast("int64"),
                    _lists(found.first, found.first_counts, pa.int32()),
                    _lists(found.second, found.second_counts, pa.int32()),
                    _lists(found.first_ends - begins[0][of], groups, pa.int32()),
                    _lists(found.second_ends - begins[1][of], groups, pa.int32()),
                ],
                ["doc_id", "first_ids", "second_ids", "first_ends", "second_ends"],
            )

    kinds = "first_ids array<int>, second_ids array<int>, first_ends array<int>, second_ends array<int>"
    return docs.select("doc_id", "text").mapInArrow(each, f"doc_id long, {kinds}")


DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def link_documents(docs: DataFrame, paths: tuple[str, str], wide: int) -> DataFrame:
    """The digest of each document's groups, its linked pairs and how often it links each."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*paths)
        for batch in text_chunks(batches):
            found = aligned(pair, texts_of(batch))
            n = batch.num_rows
            of, pairs, times = linked_pairs(found, wide)
            links = np.bincount(of, weights=times, minlength=n).astype(np.int64)
            digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in shown_groups(pair, found)]
            held = np.bincount(of, minlength=n)
            numbers = (found.first_counts, found.second_counts, np.diff(found.group_ends, prepend=0), links)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast("int64"),
                    *(pa.array(x, pa.int64()) for x in numbers),
                    pa.array(digests, pa.string()),
                    _lists(pairs, held, pa.int64()),
                    _lists(times, held, pa.int64()),
                ],
                [part.split()[0] for part in f"{DIGEST}, pairs long, times long".split(", ")],
            )

    return docs.select("doc_id", "text").mapInArrow(each, f"{DIGEST}, pairs array<long>, times array<long>")


def pair_counts(linked: DataFrame, wide: int) -> DataFrame:
    """``pair, n, best``: how many documents link a pair, and whether no pair of its first id is linked by more."""
    counts = written(linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    first = F.floor(F.col("pair") / F.lit(wide))
    highest = counts.groupBy(first.alias("first")).agg(F.max("n").alias("highest"))
    return counts.join(highest, first == F.col("first")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _looked_up(shared):
    """Sums over the pairs of each row, whose counts are held sorted by pair."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        kept = [part.split()[0] for part in DIGEST.split(", ")]
        for batch in batches:
            ends = np.cumsum(np.diff(batch.column("pairs").offsets.to_numpy()))
            begin = 0
            while begin < batch.num_rows:
                before = int(ends[begin - 1]) if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, before + LOOKED_UP, side="right")))
                part = batch.slice(begin, end - begin)
                begin = end
                pairs, times = (part.column(c).flatten().to_numpy() for c in ("pairs", "times"))
                counts = np.diff(part.column("pairs").offsets.to_numpy())
                at = np.searchsorted(known, pairs)
                columns = [part.column(c) for c in kept]
                for values in (times * best[at], times * n[at]):
                    columns.append(pa.array(row_sums(values, counts)))
                yield pa.RecordBatch.from_arrays(columns, [*kept, "n_best", "count_sum"])

    return each


def alignment_digests(
    docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, most: int = BROADCAST_PAIRS
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row of ``docs``.

    Counts of tokens, groups and links, the links whose pair is one of the
    most often linked of its first id, the sum of the pairs' counts over the
    links, and a digest of the groups; all are zero and the digest is empty
    for a text without tokens (see ``align_documents``). A pair's count is the
    number of rows that link it. Up to ``most`` pairs are broadcast.
    """
    paths = _paths(byte_level, pieces)
    wide = sentencepiece.SentencePieceProcessor(model_file=paths[1]).get_piece_size()
    linked = written(link_documents(docs, paths, wide), "linked")
    counts = written(pair_counts(linked, wide), "pair-ranks")
    shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counts.count() <= most:
        table = counts.orderBy("pair").toArrow()
        held = (table.column("pair").to_numpy(), table.column("n").to_numpy(), table.column("best").to_numpy().astype(np.int64))
        if len(held[0]) == 0:
            held = tuple(np.zeros(1, dtype=np.int64) for _ in held)
        shared = docs.sparkSession.sparkContext.broadcast(held)
        return linked.mapInArrow(_looked_up(shared), f"{DIGEST}, n_best long, count_sum long").select(*shown)
    numbered = linked.withColumn("row", F.monotonically_increasing_id())
    each = numbered.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), "l.times")
    sums = each.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    return numbered.join(sums, "row", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}).select(*shown)
