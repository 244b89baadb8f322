"""Secret scan: a character convolutional network over every candidate and its surroundings.

Candidates are what the base patterns match, every other token of some length
that holds a digit, and of tokens without one those beside a cue, long ones of
mixed case, very long ones and headers of private keys. They are cut from the
text in windows that cover all of a candidate with the characters around it, so
a text is read once and what follows handles small rows. The network learns which
windows hold a finding from the labels that the base patterns give. All labelled
candidates that it didn't learn from calibrate its scores, and the threshold is
the highest one that still recalls the asked-for share of every kind's findings.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import text_chunks, texts_of, written

KINDS = ("assign", "access", "hex")
#: The kind of what the network adds.
ADDED = "token"
ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
#: Parts of the words that an assignment begins with.
CUES = (b"passw", b"secret", b"token", b"api")
#: Words beside which a token without a digit is a candidate too, and how far after them it may begin.
BESIDE = re.compile(rb"passw|passp|secret|token|api|credential|private|key")
REACH = 32
#: Private keys begin with such a line.
HEADER = re.compile(rb"-----BEGIN [A-Z ]*PRIVATE KEY-----")
#: Shortest findings and shortest other tokens, in characters.
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST, TOKEN_LEAST = 8, 16, 32, 8
#: Shortest tokens without a digit that are candidates anywhere: of mixed case, and any.
MIXED_LEAST, LONG_LEAST = 16, 48

#: A window: characters before, of and after a candidate. A longer candidate has several, this far apart.
BEFORE, WITHIN, AFTER = 24, 48, 8
WINDOW = BEFORE + WITHIN + AFTER
STEP = 24
#: Scores are counted in bins of logits of this width, up to so many on either side.
BIN, MOST_BINS = 1 / 16, 1 << 12
#: Most labelled candidates of either label that training reads, those with the smallest hashes.
TRAINING_CANDIDATES = 3_000
#: The share of labelled findings that the threshold must recall.
RECALL = 0.99


def _table(members: str) -> bytes:
    return bytes(1 if chr(i) in members else 0 for i in range(256))


_DIGITS = "0123456789"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX = _table(_DIGITS + "abcdef")
_DIGIT = _table(_DIGITS)
_TOKEN = _table(_DIGITS + _LETTERS + "+/_=.@-")


def _runs(text: bytes, members: bytes, least: int) -> Iterator[tuple[int, int]]:
    """Maximal runs of at least ``least`` member characters."""
    marked = text.translate(members)
    full, at = b"\1" * least, 0
    while (begin := marked.find(full, at)) >= 0:
        end = marked.find(b"\0", begin + least)
        at = end if end >= 0 else len(marked)
        yield begin, at


def _tokens(text: bytes) -> Iterator[tuple[int, int]]:
    """Maximal runs of token characters that hold a digit, without the full stop that ends a sentence."""
    digits, marked = text.translate(_DIGIT), text.translate(_TOKEN)
    at = digits.find(b"\1")
    while at >= 0:
        begin = marked.rfind(b"\0", 0, at) + 1
        stop = marked.find(b"\0", at)
        stop = stop if stop >= 0 else len(marked)
        end = begin + len(text[begin:stop].rstrip(b"."))
        if end - begin >= TOKEN_LEAST:
            yield begin, end
        at = digits.find(b"\1", stop)


#: A capital after a small letter.
MIXED = re.compile(rb"[a-z][A-Z]")


def _wordlike(text: bytes, lower: bytes) -> Iterator[tuple[int, int]]:
    """Tokens without a digit that may be secrets, and headers of private keys; some may come twice."""
    marked = text.translate(_TOKEN)

    def stop(at: int) -> int:
        end = marked.find(b"\0", at)
        return end if end >= 0 else len(marked)

    run_end, last = 0, (-1, -1)  # of the run that a cue stands in, and the last token that was found
    for cue in BESIDE.finditer(lower):
        at = cue.end()
        if at >= run_end:
            run_end = stop(at)
        # The word that the cue belongs to isn't the secret.
        begin = marked.find(b"\1", run_end, at + REACH + 1)
        while 0 <= begin <= at + REACH:
            if begin != last[0]:
                last = (begin, stop(begin))
                yield begin, begin + len(text[begin : last[1]].rstrip(b"."))
            begin = marked.find(b"\1", last[1], at + REACH + 1)
    at = 0
    while mixed := MIXED.search(text, at):
        begin, at = marked.rfind(b"\0", 0, mixed.start()) + 1, stop(mixed.start())
        if at - begin >= MIXED_LEAST:
            yield begin, begin + len(text[begin:at].rstrip(b"."))
    yield from _runs(text, _TOKEN, LONG_LEAST)
    if b"PRIVATE KEY" in text:
        yield from ((m.start(), m.end()) for m in HEADER.finditer(text))


def candidates(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` in code points, by start, then kind; ``token`` is no base kind.

    The text is read as one byte per character; a character beyond Latin-1 is
    a question mark, which no pattern contains.
    """
    raw = text.encode("latin-1", "replace")
    found: list[tuple[int, int, int]] = []
    lower = raw.lower()
    if any(cue in lower for cue in CUES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(raw) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(raw) if len(m[0]) >= ACCESS_LEAST]
    found += [(a, 2, b) for a, b in _runs(raw, _HEX, HEX_LEAST)]
    base = sorted((a, b) for a, _, b in found)
    others: list[tuple[int, int]] = []
    for a, b in sorted({*_tokens(raw), *_wordlike(raw, lower)}, key=lambda t: (t[0], -t[1])):
        if b - a >= TOKEN_LEAST and (not others or a >= others[-1][1]):
            others.append((a, b))
    at = 0
    for a, b in others:
        # Base spans of different kinds overlap; of those that end before this token none meets a later one.
        while at < len(base) and base[at][1] <= a:
            at += 1
        if not any(x < b and a < y for x, y in base[at : at + 2 * len(KINDS)]):
            found.append((a, len(KINDS), b))
    return [((*KINDS, ADDED)[k], a, b) for a, k, b in sorted(found)]


def windows(raw: bytes, start: int, end: int) -> bytes:
    """The candidate and its surroundings in fixed places, in as many windows as it takes to cover it, one after another."""
    out = []
    for at in range(start, max(start + 1, end - WITHIN + STEP), STEP):
        stop = min(end, at + WITHIN)
        before = raw[max(0, at - BEFORE) : at].rjust(BEFORE, b"\0")
        out.append(before + raw[at:stop].ljust(WITHIN, b"\0") + raw[stop : stop + AFTER].ljust(AFTER, b"\0"))
    return b"".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches):
        kinds, starts, ends, cut = [], [], [], []
        for text in texts_of(batch):
            found = candidates(text)
            raw = text.encode("latin-1", "replace") if found else b""
            kinds.append([k for k, _, _ in found])
            starts.append([a for _, a, _ in found])
            ends.append([b for _, _, b in found])
            cut.append([windows(raw, a, b) for _, a, b in found])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast("int64"),
                pa.array(kinds, pa.list_(pa.string())),
                pa.array(starts, pa.list_(pa.int64())),
                pa.array(ends, pa.list_(pa.int64())),
                pa.array(cut, pa.list_(pa.binary())),
            ],
            ["doc_id", "kinds", "starts", "ends", "windows"],
        )


@dataclass
class Network:
    """Characters to vectors, one convolution, maximum over places, one logistic output."""

    embedding: np.ndarray  # character and segment by dimension
    kernel: np.ndarray  # width * dimension by filter
    kernel_bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0  # nothing reaches it until it is calibrated

    WIDTH = 5

    @classmethod
    def fresh(cls, dimensions: int = 10, filters: int = 24) -> Network:
        draw = np.random.default_rng(7)
        return cls(
            draw.normal(0, 0.3, (3 * 128, dimensions)),
            draw.normal(0, 1 / np.sqrt(cls.WIDTH * dimensions), (cls.WIDTH * dimensions, filters)),
            np.zeros(filters),
            draw.normal(0, 1 / np.sqrt(filters), filters),
            np.zeros(1),
        )

    @staticmethod
    def symbols(cut: list[bytes]) -> np.ndarray:
        """Characters of all windows, told apart by whether they stand before, in or after the candidate."""
        codes = np.frombuffer(b"".join(cut), dtype=np.uint8).reshape(-1, WINDOW).astype(np.int64)
        segment = np.repeat([0, 1, 2], [BEFORE, WITHIN, AFTER])
        return np.minimum(codes, 127) + 128 * segment

    def forward(self, symbols: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        vectors = self.embedding[symbols]
        patches = np.lib.stride_tricks.sliding_window_view(vectors, self.WIDTH, axis=1)
        patches = patches.transpose(0, 1, 3, 2).reshape(len(symbols), WINDOW - self.WIDTH + 1, -1)
        maps = patches @ self.kernel + self.kernel_bias
        place = maps.argmax(axis=1)
        top = np.take_along_axis(maps, place[:, None, :], axis=1)[:, 0]
        hidden = np.maximum(top, 0)
        return hidden @ self.output + self.output_bias[0], (patches, place, hidden)

    def gradients(self, symbols: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        logits, (patches, place, hidden) = self.forward(symbols)
        error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) / len(labels)
        back = error[:, None] * self.output * (hidden > 0)
        rows = np.arange(len(symbols))
        kernel, embedding = np.zeros_like(self.kernel), np.zeros_like(self.embedding)
        dimensions = self.embedding.shape[1]
        for f in range(self.kernel.shape[1]):
            kernel[:, f] = back[:, f] @ patches[rows, place[:, f]]
            spread = (back[:, f, None] * self.kernel[:, f]).reshape(-1, self.WIDTH, dimensions)
            at = symbols[rows[:, None], place[:, f, None] + np.arange(self.WIDTH)]
            np.add.at(embedding, at.reshape(-1), spread.reshape(-1, dimensions))
        return [embedding, kernel, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]

    def learn(self, symbols: np.ndarray, labels: np.ndarray, passes: int = 4, step: float = 0.01) -> None:
        """Adam over batches of 64, in an order drawn from a fixed seed."""
        parts = [self.embedding, self.kernel, self.kernel_bias, self.output, self.output_bias]
        first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        draw, t = np.random.default_rng(11), 0
        for _ in range(passes):
            order = draw.permutation(len(labels))
            for at in range(0, len(order), 64):
                t += 1
                chosen = order[at : at + 64]
                for p, g, m, v in zip(parts, self.gradients(symbols[chosen], labels[chosen]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    def logits(self, cut: list[bytes]) -> np.ndarray:
        """The score of each candidate: that of its highest window."""
        if not cut:
            return np.zeros(0)
        symbols = self.symbols(cut)
        each = np.concatenate([self.forward(symbols[at : at + 256])[0] for at in range(0, len(symbols), 256)])
        sizes = np.array([len(c) // WINDOW for c in cut])
        return np.maximum.reduceat(each, np.cumsum(sizes) - sizes)

    def probabilities(self, cut: list[bytes]) -> np.ndarray:
        """Calibrated probability that each candidate is a finding."""
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(cut) + self.shift, -30, 30)))

    def calibrate(self, counts: dict[str, dict[int, int]], recall: float) -> None:
        """Fit scale and shift of the logits (Platt), then the threshold, from how many candidates of each kind have each bin.

        The threshold lies where every base kind keeps ``recall`` of its
        findings: midway between the lowest score that must pass and the
        highest lower one of another candidate.
        """
        found = [(b, n) for kind in KINDS for b, n in counts.get(kind, {}).items()]
        others = list(counts.get(ADDED, {}).items())
        logits = np.array([(b + 0.5) * BIN for b, _ in found + others])
        weights = np.array([float(n) for _, n in found + others])
        positives, negatives = weights[: len(found)].sum(), weights[len(found) :].sum()
        # Labels as Platt smooths them, which keeps the fit finite when the classes are apart.
        target = np.where(np.arange(len(logits)) < len(found), (positives + 1) / (positives + 2), 1 / (negatives + 2))
        a, b = 1.0, 0.0

        def loss(a: float, b: float) -> float:
            z = a * logits + b
            return float((weights * (np.logaddexp(0, z) - target * z)).sum())

        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
            weight = weights * np.maximum(p * (1 - p), 1e-9)
            gradient = np.array([(weights * (p - target) * logits).sum(), (weights * (p - target)).sum()])
            hessian = np.array([[(weight * logits**2).sum(), (weight * logits).sum()], [(weight * logits).sum(), weight.sum()]])
            move, rate = np.linalg.solve(hessian + 1e-9 * np.eye(2), gradient), 1.0
            while rate > 1e-6 and loss(a - rate * move[0], b - rate * move[1]) > loss(a, b):
                rate /= 2
            a, b = a - rate * move[0], b - rate * move[1]
            if abs(rate * move).max() < 1e-9:
                break
        self.scale, self.shift = float(a), float(b)
        lowest = min(lowest_kept(counts[kind], recall) for kind in KINDS if counts.get(kind))
        below = max((b for b, _ in others if b < lowest), default=lowest - 1)
        middle = (lowest + below + 1) / 2 * BIN
        self.threshold = float(1 / (1 + np.exp(-np.clip(self.scale * middle + self.shift, -30, 30))))


def lowest_kept(bins: dict[int, int], recall: float) -> int:
    """The highest bin such that ``recall`` of what is counted lies in it or above."""
    kept, wanted = 0, recall * sum(bins.values())
    for b in sorted(bins, reverse=True):
        kept += bins[b]
        if kept >= wanted:
            return b
    return min(bins)


def _binned(shared):
    """How many candidates of each kind that weren't learned from have each bin of logits."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                logits = shared.value.logits(part.column("windows").to_pylist())
                bins = np.clip(np.floor(logits / BIN), -MOST_BINS, MOST_BINS).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("kind"), pa.array(bins)], ["kind", "bin"])

    return each


def train(found: DataFrame, most: int = TRAINING_CANDIDATES, recall: float = RECALL) -> Network:
    """Learn from the candidates of ``found``, labelled by the base patterns.

    The network is fitted to ``most`` candidates of either label, those with
    the smallest hashes, less a fifth of them. All other candidates calibrate
    it and set the threshold. With fewer than 20 of either label, or none of
    one to calibrate with, nothing is learned and no span is added.
    """
    each = found.select("doc_id", F.explode(F.arrays_zip("kinds", "starts", "windows")).alias("c")).select(
        F.col("c.kinds").alias("kind"),
        (F.col("c.kinds") != ADDED).cast("int").alias("label"),
        F.col("c.windows").alias("windows"),
        F.xxhash64("doc_id", "c.starts", "c.kinds").alias("place"),
    )
    sample, last = [], {}
    for label in (0, 1):
        rows = each.where(F.col("label") == label).orderBy("place", "windows").limit(most).collect()
        sample += [(bytes(r["windows"]), label) for r in rows if r["place"] % 5]
        last[label] = max((r["place"] for r in rows), default=None)
    labels = np.array([label for _, label in sample], dtype=float)
    if min(labels.sum(), (1 - labels).sum()) < 20:
        return Network.fresh()
    network = Network.fresh()
    of_window = np.repeat(labels, [len(w) // WINDOW for w, _ in sample])
    network.learn(Network.symbols([w for w, _ in sample]), of_window)
    learned = (F.col("place") <= F.when(F.col("label") == 1, last[1]).otherwise(last[0])) & (F.col("place") % 5 != 0)
    shared = found.sparkSession.sparkContext.broadcast(network)
    rest = each.where(~learned).select("kind", "windows").mapInArrow(_binned(shared), "kind string, bin int")
    counts: dict[str, dict[int, int]] = {}
    for r in rest.groupBy("kind", "bin").count().collect():
        counts.setdefault(r["kind"], {})[r["bin"]] = r["count"]
    if ADDED not in counts or len(counts) < 2:
        return Network.fresh()
    network.calibrate(counts, recall)
    return network


def scan_secrets(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """Counts, digest and spans of secrets for each row of ``docs``.

    Reads ``doc_id`` and ``text``; a NULL text is empty. Base spans follow
    fixed patterns, leftmost and without overlap within a kind, whatever the
    network says; it adds the tokens that score at least the threshold.
    ``top_score`` is the highest score of the row's candidates, 0 without any.
    """
    found = written(
        docs.select("doc_id", "text").mapInArrow(
            _extract, "doc_id long, kinds array<string>, starts array<long>, ends array<long>, windows array<binary>"
        ),
        "secret-candidates",
    )
    shared = docs.sparkSession.sparkContext.broadcast(train(found, recall=recall))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = batch.column("windows").to_pylist()
            scores = iter(shared.value.probabilities([w for row in cut for w in row]))
            counts, digests, spans, tops = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("kinds", "starts", "ends"))
            for kinds, starts, ends in zip(*columns, strict=True):
                own = [(k, a, b, next(scores)) for k, a, b in zip(kinds, starts, ends, strict=True)]
                counts.append([kinds.count(k) for k in KINDS])
                base = ",".join(f"{k}:{a}:{b}" for k, a, b, _ in own if k != ADDED)
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(",".join(f"{k}:{a}:{b}" for k, a, b, s in own if k != ADDED or s >= shared.value.threshold))
                tops.append(max((s for *_, s in own), default=0.0))
            numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *numbers, pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(tops, pa.float64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "top_score"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return found.mapInArrow(judge, f"doc_id long, {counts}, base_sha256 string, spans string, top_score double")
