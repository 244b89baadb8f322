"""Token ids as wavelet matrices: succinct bit planes with rank and select.

A shard holds whole documents in order. Its ids are stored as one bit plane
per bit of an id, from the highest; below each plane the ids stand in the
order that puts zeros first, stably. A plane is cut into blocks that are
compressed one by one, with the number of ones before each block beside them,
so a token, a count or a position is found by opening a few blocks per plane.

Spark deals the documents out by ranges of their ids, each task encodes its
range and cuts it into shards, and the shards are rows of a Parquet table in
the shared folder, written and committed by Spark like any other.
"""

from __future__ import annotations

import json
import struct
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import count, islice, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from prismcube.llm.common import text_chunks, texts_of
from prismcube.scratch import scratch_path

#: Ends every document.
END = 0
#: A shard is closed once it holds so many ids; a longer document has a shard of its own.
SHARD_IDS = 1 << 20
#: Bytes of text that are encoded at a time: distinct words are looked up once for each.
CHUNK = 1 << 21
#: Bits of a plane that are compressed together.
BLOCK_BITS = 1 << 16
MAGIC = b"WMX1"

SHARDS = "part int, seq int, before long, n_docs long, n_tokens long, payload binary"


# --- The matrix ----------------------------------------------------------


def pack(ids: np.ndarray, doc_ids: list[int | None], counts: np.ndarray, width: int) -> bytes:
    """One shard: the ids of consecutive documents of ``counts`` ids each."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    current = ids.astype(np.uint16 if width <= 16 else np.uint32)
    zeros, ones, blocks = [], [], []
    for level in range(width):
        raw = np.packbits(current & current.dtype.type(1 << (width - 1 - level)) != 0, bitorder="little").tobytes()
        plane = pa.Array.from_buffers(pa.bool_(), len(ids), [None, pa.py_buffer(raw)])
        held = pa.array(current)
        low, high = held.filter(pc.invert(plane)), held.filter(plane)
        zeros.append(len(low))
        cut = [raw[i : i + BLOCK_BITS // 8] for i in range(0, len(raw), BLOCK_BITS // 8)]
        ones.append([int(np.bitwise_count(np.frombuffer(b, dtype=np.uint8)).sum(dtype=np.int64)) for b in cut])
        blocks.append([squeeze(b) for b in cut])
        current = np.concatenate((low.to_numpy(), high.to_numpy()))
    docs = squeeze(json.dumps([doc_ids, counts.tolist()]).encode())
    head = squeeze(json.dumps({
        "n": len(ids), "width": width, "zeros": zeros, "ones": ones,
        "docs": len(docs), "sizes": [[len(b) for b in plane] for plane in blocks],
    }).encode())
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, docs, *(b for plane in blocks for b in plane)])


@dataclass
class Shard:
    """Reads a packed shard, opening the blocks that a question needs."""

    payload: bytes
    _open: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.payload[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        self._unpack = zstandard.ZstdDecompressor().decompress
        (size,) = struct.unpack_from("<I", self.payload, 4)
        head = json.loads(self._unpack(self.payload[8 : 8 + size]))
        self.n, self.width, self.zeros = head["n"], head["width"], head["zeros"]
        self._docs = (8 + size, 8 + size + head["docs"])
        at, self._places, self._before = self._docs[1], [], []
        for sizes, ones in zip(head["sizes"], head["ones"], strict=True):
            ends = at + np.cumsum(sizes, dtype=np.int64)
            self._places.append(list(zip(ends - sizes, ends, strict=True)))
            self._before.append(np.concatenate(([0], np.cumsum(ones, dtype=np.int64))))
            at = int(ends[-1]) if len(sizes) else at

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Ids of the shard's documents and how many tokens each has."""
        doc_ids, counts = json.loads(self._unpack(self.payload[slice(*self._docs)]))
        return doc_ids, np.array(counts, dtype=np.int64)

    def _block(self, level: int, block: int) -> np.ndarray:
        key = (level, block)
        if key not in self._open:
            raw = self._unpack(self.payload[slice(*self._places[level][block])])
            self._open[key] = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), bitorder="little")
        return self._open[key]

    def _plane(self, level: int) -> np.ndarray:
        raw = b"".join(self._unpack(self.payload[slice(*p)]) for p in self._places[level])
        return np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=self.n, bitorder="little").view(bool)

    def _rank1(self, level: int, i: int) -> int:
        """Ones before place ``i`` of a plane."""
        block, rest = divmod(i, BLOCK_BITS)
        return int(self._before[level][block]) + (int(self._block(level, block)[:rest].sum(dtype=np.int64)) if rest else 0)

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) zero or one of a plane."""
        before = self._before[level]
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK_BITS, self.n) - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        return block * BLOCK_BITS + int(np.flatnonzero(self._block(level, block) == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        found = 0
        for level in range(self.width):
            bit = int(self._block(level, i // BLOCK_BITS)[i % BLOCK_BITS])
            ones = self._rank1(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            found = found << 1 | bit
        return found

    def _bounds(self, token: int, begin: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` among places ``begin`` to ``end`` stand below the last plane."""
        if token >> self.width:
            return 0, 0
        for level in range(self.width):
            a, b = self._rank1(level, begin), self._rank1(level, end)
            if token >> (self.width - 1 - level) & 1:
                begin, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                begin, end = begin - a, end - b
        return begin, end

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        """Occurrences of ``token`` among the places from ``begin`` up to ``end``."""
        a, b = self._bounds(token, begin, self.n if end is None else end)
        return b - a

    def select(self, token: int, k: int) -> int:
        """Place of the ``k``-th (from 0) occurrence of ``token``."""
        a, b = self._bounds(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        place = a + k
        for level in reversed(range(self.width)):
            bit = token >> (self.width - 1 - level) & 1
            place = self._select(level, bit, place - self.zeros[level] if bit else place)
        return place

    def occurrences(self, token: int) -> list[int]:
        """All places of ``token``, in order."""
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All ids, from the last plane up: each plane says from which half its ids come."""
        current = np.zeros(self.n, dtype=np.uint16 if self.width <= 16 else np.uint32)
        for level in reversed(range(self.width)):
            plane = self._plane(level)
            above = np.empty_like(current)
            above[np.flatnonzero(~plane)] = current[: self.zeros[level]]
            above[np.flatnonzero(plane)] = current[self.zeros[level] :] | current.dtype.type(1 << (self.width - 1 - level))
            current = above
        return current


# --- Encoding ------------------------------------------------------------


class _Numbers(defaultdict):
    """Numbers words in the order in which they are first asked for."""

    def __init__(self) -> None:
        super().__init__(count().__next__)
        self._known = 0

    def fresh(self) -> list[str]:
        """The words numbered since this was last asked, in order."""
        words = list(islice(reversed(self), len(self) - self._known))
        self._known = len(self)
        return words[::-1]


def extended(held: np.ndarray, more: np.ndarray) -> np.ndarray:
    """``held`` and then ``more``, in the room behind ``held`` where there is enough; extend only the newest result."""
    room = held if held.base is None else held.base
    size = len(held) + len(more)
    if size > len(room):
        room = np.empty(2 * size, dtype=held.dtype)
        room[: len(held)] = held
    room[len(held) : size] = more
    return room[:size]


def places(begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the given ranges, one after another, and how many there are up to the end of each."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0), ends


def tails(words: pa.Array, heads: pa.Array) -> pa.Array:
    """What is left of each word behind the head that it begins with."""
    _, bounds, text = words.buffers()
    after = np.frombuffer(bounds, dtype=np.int32)[words.offset + 1 :][: len(words)].astype(np.int64)
    sizes = pc.subtract(pc.binary_length(words), pc.binary_length(heads)).to_numpy()
    place, ends = places(after - sizes, sizes)
    bounds = np.concatenate(([0], ends)).astype(np.int32)
    left = np.frombuffer(text, dtype=np.uint8)[place]
    return pa.Array.from_buffers(pa.string(), len(words), [None, pa.py_buffer(bounds), pa.py_buffer(left)])


class Encoder:
    """Encode texts with a byte-level tokenizer, each distinct word once.

    The tokenizer splits before a single blank between two characters that
    aren't white space, whatever surrounds them, and merges never cross a
    split. So the ids of such a text are those of its first word followed by
    those of each other word with its blank, which are remembered. Any other
    text is encoded whole. A single line end between two such characters is a
    token of its own, so what follows it is a word as well.

    Arrow splits many texts at a time and tells their words apart: each
    distinct one is looked up once, however often it occurs. Of letters and
    then marks the two are looked up apart, the marks as if a line end came
    before them; it is cut off.

    A new word that is letters and then marks, or lines of that, splits there
    and nowhere else; its letters go to the tokenizer's model as they are,
    without the pattern search that takes most of the time, and once for all
    the marks that follow them. Other new words are encoded with their blanks,
    some hundred in one text.
    """

    #: Most words remembered, and their characters in all.
    WORDS, CHARACTERS = 1_000_000, 12_000_000
    #: Most runs of letters remembered, and the characters of one that is.
    RUNS, RUN_CHARACTERS = 200_000, 40
    #: ASCII punctuation but the apostrophe, with which contractions begin.
    MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    #: Letters below this one are letters in every version of Unicode.
    LETTERS_END = "\u0250"
    #: White space other than the blank; ASCII first.
    SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
    ASCII_SPACES = [c for c in SPACES if c.isascii()]

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.width = max(1, (size - 1).bit_length())
        self.tokenize = self.tokenizer.model.tokenize
        pieces = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.begins_word = np.array([p.startswith("Ġ") for p in pieces])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        as_bytes = self.tokenizer.pre_tokenizer.pre_tokenize_str
        letters = [c for c in map(chr, range(ord(self.LETTERS_END))) if c.isalpha()]
        #: Letters alone, or behind a line end.
        self.letters = f"^\n?[{''.join(letters)}]+$"
        self.bytes_of = str.maketrans({c: as_bytes(c)[0][0] for c in letters})
        self.line_end = array("I", self.tokenizer.encode("\n", add_special_tokens=False).ids).tobytes()
        self._forget()

    def _forget(self) -> None:
        self.places = _Numbers()
        self.marks: dict[str, bytes] = {}
        self.runs: dict[str, dict[str, bytes]] = {"Ġ": {}, "": {}}
        self.characters = 0
        self.flat = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(1, dtype=np.int64)

    def _splits(self, text: str) -> bool:
        """Whether every blank of a text stands alone between two characters that aren't white space."""
        if text[0] == " " or text[-1] == " " or "  " in text or any(s in text for s in self.special):
            return False
        spaces = self.ASCII_SPACES if text.isascii() else self.SPACES
        return not any(c in text and (f"{c} " in text or f" {c}" in text) for c in spaces)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in encoded]

    def _run(self, line: str, lead: str) -> bytes | None:
        """The ids of letters and then marks, with a blank before them or not; None for anything else."""
        core = line.rstrip(self.MARKS)
        known = self.runs[lead]
        ids = known.get(core)
        if ids is None:
            if not core.isalpha():
                return None
            if core.isascii():
                spelled = lead + core
            elif max(core) < self.LETTERS_END:
                spelled = lead + core.translate(self.bytes_of)
            else:
                return None
            ids = array("I", [t.id for t in self.tokenize(spelled)]).tobytes()
            if len(core) <= self.RUN_CHARACTERS:
                if len(known) >= self.RUNS:
                    known.clear()
                known[core] = ids
        if len(core) < len(line):
            mark = line[len(core) :]
            if mark not in self.marks:
                self.marks[mark] = array("I", self.tokenizer.encode(mark, add_special_tokens=False).ids).tobytes()
            ids += self.marks[mark]
        return ids

    def _plain(self, word: str) -> bytes | None:
        """The ids of a word with its blank or its line end, if it is letters and marks, or lines of that; else None."""
        if "\n" not in word:
            return self._run(word, "Ġ")
        first, *lines = word.split("\n")
        out = self._run(first, "Ġ") if first else b""
        for line in lines:
            ids = self._run(line, "")
            if out is None or ids is None:
                return None
            out += self.line_end + ids
        return out

    def _learn(self, words: list[str]) -> None:
        """Store the ids of words that were just numbered; one that begins with a line end has no blank before it."""
        found = [self._plain(word) for word in words]
        lines = [i for i, ids in enumerate(found) if ids is None and words[i][0] == "\n"]
        for i, ids in zip(lines, self._whole([words[i] for i in lines]) if lines else (), strict=True):
            found[i] = ids.tobytes()
        others = [i for i, ids in enumerate(found) if ids is None]
        for at in range(0, len(others), 256):
            chunk = others[at : at + 256]
            (joined,) = self._whole(["".join(f" {words[i]}" for i in chunk)])
            cuts = np.flatnonzero(self.begins_word[joined])
            if len(cuts) != len(chunk):
                raise ValueError("the tokenizer doesn't split words at blanks")
            for i, ids in zip(chunk, np.split(joined, cuts[1:]), strict=True):
                found[i] = ids.tobytes()
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.flat.itemsize
        self.characters += sum(map(len, words))
        self.starts = extended(self.starts, len(self.flat) + np.cumsum(sizes))
        self.flat = extended(self.flat, np.frombuffer(b"".join(found), dtype=np.uint32))

    def _lines(self, text: str) -> bool:
        """Whether a text that splits has line ends, and each stands alone between two characters that aren't white space."""
        if "\n" not in text or text[0] == "\n" or text[-1] == "\n":
            return False
        spaces = self.ASCII_SPACES if text.isascii() else self.SPACES
        return not any(c in text and (f"{c}\n" in text or f"\n{c}" in text) for c in spaces)

    def _ids_of(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words, as the bytes of an array each."""
        cores = pc.ascii_rtrim(words, characters=self.MARKS)
        plain = pc.match_substring_regex(cores, self.letters)
        heads = pc.if_else(plain, cores, words)
        marks = tails(words, heads).dictionary_encode()
        heads = heads.dictionary_encode()
        asked = heads.dictionary.to_numpy(zero_copy_only=False).tolist()
        asked += [f"\n{m}" for m in marks.dictionary.to_pylist()]
        numbers = np.fromiter(map(self.places.__getitem__, asked), dtype=np.int64, count=len(asked))
        if fresh := self.places.fresh():
            self._learn(fresh)
        head, mark = numbers[heads.indices.to_numpy()], numbers[len(heads.dictionary) + marks.indices.to_numpy()]
        begins = np.stack((self.starts[head], self.starts[mark] + 1), axis=1).ravel()
        place, ends = places(begins, np.stack((self.starts[head + 1], self.starts[mark + 1]), axis=1).ravel() - begins)
        bounds = np.concatenate(([0], ends[1::2])) * self.flat.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(bounds), pa.py_buffer(self.flat[place])])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.places) > self.WORDS or self.characters > self.CHARACTERS:
            self._forget()
        out: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * len(texts)
        splits = [bool(t) and self._splits(t) for t in texts]
        whole = [i for i, (t, s) in enumerate(zip(texts, splits, strict=True)) if t and not s]
        for i, ids in zip(whole, self._whole([texts[i] for i in whole]), strict=True):
            out[i] = ids
        of = [i for i, s in enumerate(splits) if s]
        cut = [(texts[i].replace("\n", " \n") if self._lines(texts[i]) else texts[i]).partition(" ") for i in of]
        for i, first in zip(of, self._whole([first for first, _, _ in cut]), strict=True):
            out[i] = first
        of, rests = [i for i, c in zip(of, cut, strict=True) if c[1]], [rest for _, blank, rest in cut if blank]
        if rests:
            lists = pc.split_pattern(pa.array(rests, pa.string()), " ")
            words = lists.flatten().dictionary_encode()
            _, bounds, found = self._ids_of(words.dictionary).take(words.indices).buffers()
            ids = np.frombuffer(found, dtype=self.flat.dtype)
            ends = np.frombuffer(bounds, dtype=np.int64)[lists.offsets.to_numpy()] // ids.itemsize
            for i, (begin, end) in zip(of, pairwise(ends.tolist()), strict=True):
                out[i] = np.concatenate((out[i], ids[begin:end]))
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One encoder per worker, which keeps its words from task to task."""
    return Encoder(path)


def _shards(path: str, most: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0
        end = np.array([END], dtype=np.uint32)

        def close() -> pa.RecordBatch:
            counts = np.array([len(h) for h in held], dtype=np.int64)
            payload = pack(np.concatenate(held), doc_ids, counts, encoder.width)
            row = [part, seq, before, len(held), size, payload]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                ["part", "seq", "before", "n_docs", "n_tokens", "payload"],
            )

        for batch in text_chunks(batches, size=CHUNK):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts_of(batch)), strict=True):
                if held and size + len(ids) + 1 > most:
                    yield close()
                    seq, before, size, doc_ids, held = seq + 1, before + size, 0, [], []
                doc_ids.append(doc_id)
                held.append(np.concatenate((ids, end)))
                size += len(ids) + 1
        if held:
            yield close()

    return each


def write_shards(docs: DataFrame, path: str, tokenizer: str | None = None, shard_ids: int = SHARD_IDS) -> None:
    """Encode every text of ``docs`` and write the shards, in ascending order of ``doc_id``, as a table at ``path``.

    NULL ids come first, rows with one id in the order of a hash of their
    texts; a NULL text is empty. ``part`` numbers the ranges of ids and ``seq``
    the shards of a range; ``before`` counts a range's ids before the shard.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ranges = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    vocabulary = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    ranges.mapInArrow(_shards(vocabulary, shard_ids), SHARDS).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            shard = Shard(batch.column("payload")[row].as_py())
            doc_ids, counts = shard.documents()
            ids = shard.decode().astype("<u4")
            starts = np.cumsum(counts) - counts
            sums = [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(starts, counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch.column("part")[row].as_py()] * len(doc_ids), pa.int32()),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts + batch.column("before")[row].as_py()),
                    pa.array(counts),
                    pa.array(sums, pa.int64()),
                ],
                ["part", "doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_documents(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the shards alone.

    ``start`` counts the ids of all documents before it. What precedes a range
    is a running sum over the ranges: one row for each task that wrote.
    """
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    running = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(running, F.lit(0)).alias("base"))
    rows = shards.select("part", "before", "payload").mapInArrow(
        _read, "part int, doc_id long, start long, n_tokens long, ids_crc32 long"
    )
    located = rows.join(F.broadcast(bases), "part")
    return located.select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` as shards into the shared folder and read them back; see ``read_documents``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "wavelet")
    write_shards(docs, path, tokenizer)
    return read_documents(spark.read.schema(SHARDS).parquet(path))
