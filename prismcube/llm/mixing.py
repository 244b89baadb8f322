"""Mix sources to target weights with hash-threshold histograms.

Every document has a hash of its id and text, so "the documents below a
threshold" is a fixed, nested family of subsets of each source. Sizes are summed by source and
hash bucket; where the running sum passes the budget lies the boundary bucket,
and only its documents are summed again, by the next bits of the hash, until
the boundary is one hash value. The mix is then a filter: nothing is sorted, and
a source that holds most rows is one partial sum per task and bucket.

Everything is DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prismcube.llm.common import written

#: Bits of the document hash, and how many of them one refinement looks at.
HASH_BITS = 60
LEVEL_BITS = 12
#: What separates words.
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights of the sources in order, the share of all words to take, and how often a document may repeat."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    repeats: int = 2


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of the MD5 of the id, a colon and the text; NULL counts as empty."""
    both = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    digest = F.md5(both.cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row per source.

    A target is the source's share by weight, at most ``repeats`` times its
    size, where what a full source can't take is shared by weight among the
    rest. Sources fill up in the order of size by weight, so the level at
    which sharing ends follows from running sums over that order: one row per
    source, in one window.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weights = F.array(*[F.lit(w) for w in mix.weights])
    rows = sizes.withColumn("rank", F.row_number().over(in_order)).withColumn(
        "weight", F.element_at(weights, (F.col("rank") - 1) % len(mix.weights) + 1)
    )
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("cap", F.col("source_size") * mix.repeats)
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(mix.share))
        .withColumn("place", F.row_number().over(filling))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("budget") - F.col("cap_before")) / F.col("weight_left"))
    )
    open_level = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))
    open_place = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("place"))
    rows = rows.withColumn("level", F.min_by(open_level, open_place).over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return rows.select("source", "rank", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``whole`` copies of every document and the hash ``below`` which one more is taken."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1).cast("long")
    state = targets.withColumn("whole", whole).withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    state = written(
        state.withColumns({"base": F.lit(0).cast("long"), "prefix": F.lit(0).cast("long"), "below": F.lit(None).cast("long")}),
        "mix-targets",
    )
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        open_ = state.where(F.col("below").isNull()).select("rank", "extra", "base", "prefix", F.col("source").alias("_source"))
        if open_.isEmpty():
            break
        inside = sized.join(open_, sized["source"].eqNullSafe(F.col("_source")) & (F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix")))
        buckets = inside.groupBy("rank", "extra", "base", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high")
        )
        running = F.col("base") + F.sum("words").over(Window.partitionBy("rank").orderBy("bucket"))
        past = buckets.withColumn("after", running).where(F.col("after") > F.col("extra"))
        boundary = past.groupBy("rank").agg(F.min(F.struct("bucket", "after", "words", "low", "high")).alias("b"))
        found = state.join(boundary, "rank", "left")
        passed = F.col("b.after") - F.col("b.words")
        nearer = F.col("b.after") - F.col("extra") < F.col("extra") - passed
        hash_found = F.when(F.col("b.low") == F.col("b.high"), F.col("b.low") + F.when(nearer, 1).otherwise(0))
        found = found.withColumns({
            "below": F.when(F.col("below").isNotNull(), F.col("below")).when(F.col("b").isNull(), F.lit(0)).otherwise(hash_found),
            "base": F.when(F.col("b").isNull(), F.col("base")).otherwise(passed),
            "prefix": F.coalesce("b.bucket", "prefix"),
        })
        state = written(found.select(state.columns), f"mix-level-{level}")
    return state.select("source", "source_size", "target", "whole", "below")


def sized_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, h``: all that the thresholds need, counted once."""
    size, h = word_count(F.col("text")).alias("size"), document_hash(F.col("doc_id"), F.col("text")).alias("h")
    return written(docs.select("doc_id", "source", size, h), "mix-sizes")


def found_thresholds(sized: DataFrame, mix: Mix) -> DataFrame:
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return thresholds(sized, source_targets(sizes, mix))


def mix_copies(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """How often each document is taken: ``doc_id, source, size, h, source_size, target, copies``.

    One row per row of ``docs``, of which ``doc_id``, ``text`` and ``source``
    are read. Rows equal in id and text are taken alike, a NULL text has no
    word, NULL is a source of its own and the last, and no rows give no rows.
    The words taken from a source miss its target by less than the words of
    the rows that share the boundary's hash.
    """
    sized = sized_documents(docs)
    found = found_thresholds(sized, mix or Mix()).withColumnRenamed("source", "_source")
    copies = F.col("whole") + (F.col("h") < F.col("below")).cast("long")
    return sized.join(found, sized["source"].eqNullSafe(found["_source"])).select(
        "doc_id", "source", "size", "h", "source_size", "target", copies.alias("copies")
    )


def mix_sources(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row of ``docs``; see ``mix_copies``."""
    return mix_copies(docs, mix).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_documents(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the columns of ``docs``.

    The thresholds are one row per source, so the documents meet them in one
    join, and their text is neither shuffled nor counted again.
    """
    found = found_thresholds(sized_documents(docs), mix or Mix()).select("source", "whole", "below")
    copies = found["whole"] + (document_hash(docs["doc_id"], docs["text"]) < found["below"]).cast("long")
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    joined = docs.join(found, docs["source"].eqNullSafe(found["source"]))
    return joined.select(row, F.explode(F.array_repeat(F.lit(0), copies.cast("int")))).select("row.*")


ORACLE = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 15))::bigint as h
  from documents
), ranked as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as rank
  from sized group by source
), weighted as (
  select *, [3, 1, 2][(rank - 1) % 3 + 1] as weight, source_size * 2 as cap from ranked
), filled as (
  select *, row_number() over (order by source_size / weight, rank) as place,
         (sum(source_size) over () * 1.5::double
          - coalesce(sum(cap) over (order by source_size / weight, rank rows between unbounded preceding and 1 preceding), 0))
         / (sum(weight) over ()
            - coalesce(sum(weight) over (order by source_size / weight, rank rows between unbounded preceding and 1 preceding), 0)) as lvl
  from weighted
), cut as (
  select arg_min(lvl, place) filter (where cap > lvl * weight) as lvl from filled
), targets as (
  select f.source, f.source_size, coalesce(least(f.cap::double, c.lvl * f.weight), f.cap::double) as target
  from filled f, cut c
), wholes as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 1 end as whole from targets
), budgets as (
  select *, target - whole * source_size as extra from wholes
), hashes as (
  select source, h, sum(size)::bigint as words from sized group by source, h
), running as (
  select source, h, words, sum(words) over (partition by source order by h) as after from hashes
), boundary as (
  select r.source, min({'h': r.h, 'after': r.after, 'words': r.words}) as b
  from running r join budgets t on r.source is not distinct from t.source
  where r.after > t.extra group by r.source
), found as (
  select t.*, case when b.b is null then 0
                   when b.b.after - t.extra < t.extra - (b.b.after - b.b.words) then b.b.h + 1 else b.b.h end as below
  from budgets t left join boundary b on b.source is not distinct from t.source
)
select s.doc_id, s.size, f.source_size, f.target,
       (s.size * (f.whole + case when s.h < f.below then 1 else 0 end))::bigint as taken
from sized s join found f on s.source is not distinct from f.source
"""
