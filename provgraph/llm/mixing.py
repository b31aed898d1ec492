"""Mixing sources to target weights by repetition rates and hash-seeded extra copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import Scratch, numbered

#: Each md5 gives four uniform numbers; so many seeds are tried for each source.
SEEDS = 32


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(row_id: Column, seed: Column | int) -> Column:
    """A number in [0, 1) from md5 of ``id:block``; seed = 4 * block + quarter of the hash."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    block = F.floor(seed / 4).cast("int").cast("string")
    digest = F.md5(F.concat_ws(":", F.coalesce(row_id.cast("string"), F.lit("null")), block).cast("binary"))
    part = F.substr(digest, ((seed % 4) * 8 + 1).cast("int"), F.lit(8))
    return F.conv(part, 16, 10).cast("double") / float(2**32)


def _level(sources: DataFrame, total: float, cap: float) -> float:
    """The share per unit of weight once the capped sources' excess is dealt anew.

    Every round holds the sources whose share exceeds ``cap`` times their size at
    that cap and shares the rest by weight, until no further source is above;
    the driver sees three sums a round.
    """
    held, level = 0, None
    while True:
        over = F.lit(False) if level is None else F.col("weight") * level > F.col("size") * cap
        r = sources.agg(
            F.sum(F.when(over, F.col("size")).otherwise(0.0)).alias("size"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weight"), F.count_if(over).alias("held"),
        ).first()
        if not r["weight"] or (level is not None and r["held"] == held):
            return level or 0.0
        held, level = r["held"], (total - cap * r["size"]) / r["weight"]


def source_rates(scratch: Scratch, sized: DataFrame, weights: Sequence[int] = (3, 1, 2), total: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target, rate), one row per source.

    Sources stand in code-point order, null last, with ``weights`` repeating;
    together they get ``total`` times all sizes, in proportion to weight, but
    none more than ``cap`` times its size.  Sources of size 0 have target and
    rate 0.
    """
    by = scratch.save(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    by = numbered(scratch, by.withColumn("_last", F.col("source").isNull()), ["_last", "source"])
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("pos"), F.lit(len(weights))) + 1).cast("int"))
    by = scratch.save(by.select("source", "source_size", F.col("source_size").cast("double").alias("size"), w.alias("weight")))
    all_sizes = by.agg(F.sum("size").alias("s")).first()["s"]
    level = _level(by, total * (all_sizes or 0.0), cap)
    target = F.least(F.col("size") * cap, F.col("weight") * level)
    return by.select("source", "source_size", target.alias("target"), F.when(F.col("size") > 0, target / F.col("size")).otherwise(0.0).alias("rate"))


def _by_source(docs: DataFrame, source_col: str, plan: DataFrame) -> DataFrame:
    return docs.join(plan.withColumnRenamed("source", "_of"), docs[source_col].eqNullSafe(F.col("_of")), "left").drop("_of")


def _copies(row_id: Column) -> Column:
    part = F.col("rate") - F.floor("rate")
    return F.floor("rate").cast("long") + (uniform(row_id, F.col("seed")) < part).cast("long")


def mix_plan(sized: DataFrame, **settings) -> DataFrame:
    """(source, source_size, target, rate, seed) from rows (_id, source, size).

    For each source the totals under ``SEEDS`` seeds are summed in one pass,
    combined on the map side, and the seed whose total is nearest to the
    target is used (the smallest of equals), so that a source of few or
    uneven documents comes near its target too.
    """
    scratch = Scratch(sized.sparkSession, "mixing")
    sized = scratch.save(sized)
    rates = scratch.save(source_rates(scratch, sized, **settings))
    part = F.col("rate") - F.floor("rate")
    extra = [F.sum(F.when(uniform(F.col("_id"), s) < part, F.col("size")).otherwise(0)).alias(f"_{s}") for s in range(SEEDS)]
    sums = _by_source(_by_source(sized, "source", rates).groupBy("source").agg(*extra), "source", rates)
    miss = [F.struct(F.abs(F.floor("rate") * F.col("source_size") + F.col(f"_{s}") - F.col("target")).alias("miss"), F.lit(s).alias("seed")) for s in range(SEEDS)]
    return scratch.save(sums.select("source", "source_size", "target", "rate", F.array_min(F.array(*miss))["seed"].alias("seed")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """(id, source, size, source_size, target, rate, seed, copies, taken), one row per row of ``docs``.

    A document is taken floor(rate) times, plus once more when its hash-seeded
    uniform number is below the fraction; with a rate of at most ``cap`` that
    is never more than ``cap`` times.  Reruns agree.  ``settings``: weights,
    total and cap of ``source_rates``.

    Null text counts 0 words and null sources form a source of their own.
    Repeated rows share their draw, null ids share one too.  Empty tables give
    an empty result; extra columns are not read.

    The source table is joined back under Spark's own size check and split by
    the skew join where it is not broadcast.
    """
    sized = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    copies = _copies(F.col("_id"))
    return _by_source(sized, "source", mix_plan(sized, **settings)).select(
        F.col("_id").alias(id_col), "source", "size", "source_size", "target", "rate", "seed", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, all columns kept.

    Only the source's rate and seed are joined to the documents.
    """
    sized = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    plan = mix_plan(sized, **settings).select("source", "rate", "seed")
    row = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    taken = _by_source(row, "_source", plan).select("_row", F.explode(F.array_repeat(F.lit(0), _copies(F.col("_id")).cast("int"))))
    return taken.select("_row.*")
