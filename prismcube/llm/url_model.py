"""URL filter: rules first, then the ratio of two character language models.

The URLs that rules accept and those that rules reject teach a variable-order
Markov model each: counts of every character after its last 0 to 5 characters,
interpolated from the shortest context to the longest one seen. The models are
one table of contexts that grows with the URLs, named by 64 bits of hash so that
no two of them share counts. URLs meet it by broadcast while it is small, else
in blocks, each of which is joined with the contexts that it asks for. A URL's
score is the difference of its log-likelihoods, divided by its length; the score
from which URLs pass is calibrated on labelled URLs that the models haven't
seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import mix, row_sums, text_chunks, written

#: Longest context, and the weight of the shorter context.
ORDER = 5
BACKOFF = 4.0
#: Most contexts that are broadcast.
BROADCAST_CONTEXTS = 1_500_000
#: One labelled URL in so many calibrates instead of teaching.
FOLDS = 5
#: Scores are counted in bins of this width, up to this distance from 0.
BIN, REACH = 0.01, 10.0


@dataclass(frozen=True)
class Rule:
    """``verdict`` for URLs of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path; both empty for NULL or without ``://``."""
    mark = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(mark > 0, F.substr(url, mark + 3)).otherwise("")
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^([^?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judged_by_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id, url, host, path, rule, verdict``; the longest fitting rule decides, NULL where none fits."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    longest_first = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = [(r, r.fits(F.col("host"), F.col("path"))) for r in longest_first]
    none = F.lit(None).cast("string")
    rule = F.coalesce(*[F.when(fit, r.name) for r, fit in fits], none)
    verdict = F.coalesce(*[F.when(fit, r.verdict) for r, fit in fits], none)
    return split.select("page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def model_text(url: Column, host: Column) -> Column:
    """What the models read: the URL from its host on, the host lower-cased; all of it without ``://``."""
    mark = F.coalesce(F.instr(url, "://"), F.lit(0))
    after = F.substr(url, mark + 3 + F.length(host))
    return F.coalesce(F.when(mark > 0, F.concat(host, after)).otherwise(url), F.lit(""))


def contexts(texts: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each order, the names of every character's context and of the context with the character.

    A text is preceded by ``ORDER`` marks and followed by one. Also returns
    the number of characters of each text, the final mark included.
    """
    lead = b"\x02" * ORDER
    symbols = np.frombuffer(b"".join(lead + t + b"\x03" for t in texts), dtype=np.uint8).astype(np.uint64)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(lengths + ORDER) - lengths
    at = np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    # What is hashed is one number per context: order, whether a character follows, and up to six bytes.
    found, context = [], np.zeros(len(at), dtype=np.uint64)
    for k in range(ORDER + 1):
        if k:
            context = context << np.uint64(8) | symbols[at - k]
        kind = np.uint64(2 * k) << np.uint64(56)
        joint = np.uint64(2 * k + 1) << np.uint64(56) | context << np.uint64(8) | symbols[at]
        found.append((mix(kind | context).view(np.int64), mix(joint).view(np.int64)))
    return found, lengths


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each context of a chunk stands in rejected and in accepted URLs."""
    for batch in text_chunks(batches, "said"):
        allowed = np.array(batch.column("verdict").to_pylist()) == "allow"
        found, lengths = contexts([t.encode("utf-8", "replace") for t in batch.column("said").to_pylist()])
        accepted = np.repeat(allowed, lengths)
        names, place = np.unique(np.concatenate([x for pair in found for x in pair]), return_inverse=True)
        every = np.bincount(place, minlength=len(names))
        own = np.bincount(place, weights=np.tile(accepted, 2 * len(found)), minlength=len(names)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(every - own), pa.array(own)], ["name", "rejected", "accepted"])


@dataclass(frozen=True)
class Model:
    """Names of contexts, sorted, and how often they stand in rejected and in accepted URLs."""

    names: np.ndarray
    counts: np.ndarray  # side by context

    @classmethod
    def of(cls, table: pa.Table | pa.RecordBatch) -> Model:
        names = table.column("name").to_numpy()
        order = np.argsort(names)
        return cls(names[order], np.stack([table.column(c).to_numpy()[order] for c in ("rejected", "accepted")]))

    def seen(self, names: np.ndarray) -> np.ndarray:
        """The counts of contexts by side, 0 for those that aren't there."""
        if not len(self.names):
            return np.zeros((2, len(names)), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return np.where(self.names[at] == names, self.counts[:, at], 0)


def scores(texts: list[bytes], model: Model) -> np.ndarray:
    """Log-likelihood as an accepted URL less that as a rejected one, by length; 0 for an empty text."""
    found, lengths = contexts(texts)
    p = np.full((2, int(lengths.sum())), 1 / 257)
    for context, joint in found:
        p = (model.seen(joint) + BACKOFF * p) / (model.seen(context) + BACKOFF)
    logs = np.log(p)
    return np.where(lengths > 1, row_sums(logs[1] - logs[0], lengths) / lengths, 0.0)


def _encoded(batch: pa.RecordBatch) -> list[bytes]:
    return [t.encode("utf-8", "replace") for t in batch.column("said").to_pylist()]


def _block_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The URLs of a partition in blocks of bounded size, each with the contexts that it asks for."""
    part, number = TaskContext.get().partitionId(), 0
    for batch in text_chunks(batches, "said"):
        found, _ = contexts(_encoded(batch))
        names = np.unique(np.concatenate([x for pair in found for x in pair]))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part << 32 | number]), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([names], pa.list_(pa.int64()))],
            ["block", "rows", "names"],
        )
        number += 1


def with_scores(rows: DataFrame, model: DataFrame, most: int = BROADCAST_CONTEXTS) -> DataFrame:
    """``rows`` with the ``score`` of their column ``said``; ``model`` is a written table of contexts.

    Up to ``most`` contexts are broadcast. More of them are joined with the
    contexts of blocks of rows, whose number is bounded by the block's bytes.
    """
    schema = f"{', '.join(f'`{c}` {t}' for c, t in rows.dtypes)}, score double"

    def scored(batch: pa.RecordBatch, own: Model) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores(_encoded(batch), own))], [*batch.schema.names, "score"])

    if model.count() <= most:
        shared = rows.sparkSession.sparkContext.broadcast(Model.of(model.toArrow()))

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_chunks(batches, "said"):
                yield scored(batch, shared.value)

        return rows.mapInArrow(each, schema)

    blocks = written(rows.mapInArrow(_block_contexts, "block long, rows binary, names array<long>"), "url-blocks")
    asked = blocks.select("block", F.explode("names").alias("name")).join(model, "name", "left")
    entry = F.struct("name", F.coalesce("rejected", F.lit(0)).alias("rejected"), F.coalesce("accepted", F.lit(0)).alias("accepted"))
    own = asked.groupBy("block").agg(F.collect_list(entry).alias("model"))

    def each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                entries = batch.column("model")[i].values
                own_model = Model.of(pa.RecordBatch.from_arrays(entries.flatten(), ["name", "rejected", "accepted"]))
                for packed in pa.ipc.open_stream(batch.column("rows")[i].as_py()):
                    yield scored(packed, own_model)

    return blocks.select("block", "rows").join(own, "block").select("rows", "model").mapInArrow(each_block, schema)


def train(judged: DataFrame, most: int = BROADCAST_CONTEXTS) -> tuple[DataFrame, float]:
    """The table of contexts ``name, rejected, accepted``, and the score from which URLs pass.

    Learns from the rows of ``url, host, verdict`` that a rule judged. All of
    them count, those of one fold in the calibration. If no URL was accepted
    or none rejected, all scores are compared with 0.
    """
    said = model_text(F.col("url"), F.col("host")).alias("said")
    labelled = judged.where(F.col("verdict").isNotNull()).select("verdict", said)
    calibrates = F.crc32(F.col("said").cast("binary")) % FOLDS == 0
    counted = labelled.where(~calibrates).mapInArrow(_count, "name long, rejected long, accepted long")
    model = written(counted.groupBy("name").agg(F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted")), "url-contexts")
    scored = with_scores(labelled.where(calibrates), model, most)
    place = F.round(F.greatest(F.least(F.col("score"), F.lit(REACH)), F.lit(-REACH)) / BIN).cast("long")
    rows = scored.groupBy("verdict", place.alias("bin")).count().collect()
    return model, best_threshold([(r["verdict"] == "allow", r["bin"], r["count"]) for r in rows])


def best_threshold(rows: list[tuple[bool, int, int]]) -> float:
    """The score from which URLs pass: the one with the most even share of right verdicts on both sides.

    Of equally good ones, the middle. ``rows``: accepted or not, bin, number.
    """
    total = {side: sum(n for s, _, n in rows if s == side) for side in (True, False)}
    if not total[True] or not total[False]:
        return 0.0
    places = sorted({b for _, b, _ in rows})
    places.append(places[-1] + 1)
    share = [
        sum(n for s, b, n in rows if s and b >= p) / total[True] + sum(n for s, b, n in rows if not s and b < p) / total[False]
        for p in places
    ]
    best = [i for i, x in enumerate(share) if x == max(share)]
    i = best[len(best) // 2]
    low = places[i - 1] if i else places[i] - 1
    return (low + places[i]) / 2 * BIN


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, most: int = BROADCAST_CONTEXTS) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for each row of ``pages``.

    ``score`` is the models' for every URL; the verdict is the rule's where
    one fits, else ``allow`` from the threshold on. A NULL or empty URL has
    score 0. Up to ``most`` contexts are broadcast.
    """
    judged = judged_by_rules(pages, rules)
    model, threshold = train(judged, most)
    said = model_text(F.col("url"), F.col("host")).alias("said")
    scored = with_scores(judged.select(F.col("page_id").cast("long").alias("page_id"), "host", "path", "rule", "verdict", said), model, most)
    found = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", found).alias("verdict"), "score")
