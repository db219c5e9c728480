"""Mixing sources to target weights by capped water-filling.

Every source asks for its share of the total by weight; a source that would need more than ``max_epochs`` repetitions is
clamped there and the excess goes to the others in proportion to their weights, until none is above.  As a source is
clamped exactly when its capacity per weight lies under the final level, the fixed point is found in one pass over the
sources ordered by capacity per weight (prefix sums) instead of a loop.

A source at e epochs takes floor(e) whole repetitions of each document and, for the fraction, its documents in a seeded
order (md5 of seed and doc_id) until the words are used up; the last one gives part of its words.  Seeded order is cut
into 4096 cells by the first three hex digits, so a source of any size is summed cell by cell and no window holds more
than one cell of one source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from llm.textops import _spaced as spaced, n_words, named, same, scratch_name

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 17


def repeating_weights(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Weights for the sources in code point order, null last, repeating."""
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                     (place % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS, total: Column | None = None) -> DataFrame:
    """``target`` of each source from ``source_size`` and ``weight``; one row per source, whatever the corpus size.

    ``total`` is the words to share out (default: all sizes).  What exceeds the capacity of all sources is not given.  A
    source of weight 0 gets nothing.
    """
    capacity = F.col("source_size") * max_epochs
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    filling = W.orderBy(F.try_divide("capacity", "weight").asc_nulls_last(), F.col("source").asc_nulls_last()) \
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    out = sources.withColumn("capacity", capacity) \
        .withColumn("total", (F.sum("source_size").over(everything) if total is None else total).cast("double")) \
        .withColumn("full", F.sum("capacity").over(filling) - F.col("capacity")) \
        .withColumn("rest", F.sum("weight").over(everything) - (F.sum("weight").over(filling) - F.col("weight"))) \
        .withColumn("level", (F.col("total") - F.col("full")) / F.nullif(F.col("rest"), F.lit(0.0))) \
        .withColumn("clamped", F.col("level") * F.col("weight") >= F.col("capacity"))
    # the level of the first source that is not clamped holds for all that follow
    level = F.min(F.when(~F.col("clamped") & (F.col("weight") > 0), F.struct(F.try_divide("capacity", "weight"), F.col("level")))).over(everything)
    return out.withColumn("final", level.getField("level")) \
        .withColumn("target", F.when(F.col("weight") == 0, 0.0).when(F.col("clamped"), F.col("capacity").cast("double"))
                    .otherwise(F.col("final") * F.col("weight"))) \
        .select("source", "source_size", "weight", "target")


def mix(docs: DataFrame, weights=repeating_weights, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        size: Column | None = None) -> DataFrame:
    """``docs`` plus size, source_size, target and taken (the words that the mix takes, repeats counted).

    taken is floor(epochs) times the size, plus the document's part of the fractional repetition: the whole size, or for
    one document per source a part of it.  Columns of ``docs`` with these names are replaced.  A null text has size 0 and
    is taken with 0 words; a null source is a source of its own; a null or repeated doc_id has its place in the seeded
    order like any other (null ids by a hash of the text; ties by text, equal rows side by side).  Texts of any length
    are taken whole.  Other columns pass, whatever their names.  Empty input gives an empty result.
    """
    new = ["size", "source_size", "target", "taken"]
    docs = docs.withColumn("size", F.coalesce(n_words(F.col("text")) if size is None else size, F.lit(0)).cast("long")) \
        .drop(*new[1:])
    order, cell = scratch_name(docs, "order_"), scratch_name(docs, "cell_")
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null "), F.xxhash64("text").cast("string")))
    docs = docs.withColumn(order, F.md5(F.concat(F.lit(f"{seed}:"), name)))
    docs = docs.withColumn(cell, F.substring(order, 1, 3))
    cells = docs.groupBy("source", cell).agg(F.sum("size").alias("words"))
    upto = W.partitionBy("source").orderBy(cell).rowsBetween(W.unboundedPreceding, W.currentRow)
    cells = cells.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    sources = water_fill(weights(cells.groupBy("source").agg(F.sum("words").alias("source_size"))), max_epochs)
    sources = sources.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)) \
        .withColumn("part", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    of, at, before, whole, part, run = (scratch_name(docs, x) for x in ("of_", "at_", "before_", "whole_", "part_", "run_"))
    plan = cells.join(sources.withColumnRenamed("source", "s"), same(F.col("source"), F.col("s"))).select(
        F.col("source").alias(of), F.col(cell).alias(at), F.col("before").alias(before), "source_size", "target",
        F.col("whole").alias(whole), F.col("part").alias(part))
    inside = W.partitionBy("source", cell).orderBy(order, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")) \
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    slim = docs.withColumn(run, F.sum("size").over(inside) - F.col("size"))
    out = slim.join(plan, same(F.col("source"), F.col(of)) & (F.col(cell) == F.col(at)))
    left = F.col(part) - F.col(before) - F.col(run)
    out = out.withColumn("taken", (F.col(whole) * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))).cast("long"))
    return out.select(*named([c for c in docs.columns if c not in (order, cell)]), *new[1:])


def sample(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row for each repetition that ``mix`` takes of a document, none for a document it does not take.

    ``repeat`` numbers the repetitions from 0; ``taken`` is the words of this one.  Where that is a part of the document,
    ``text`` (and ``n_chars``, if there) ends behind the last word taken.  A column named repeat is replaced.
    """
    out = mix(docs.drop("repeat"), **options).where("taken > 0")
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    out = out.withColumn("repeat", F.explode(F.sequence(F.lit(0), copies - 1)))
    out = out.withColumn("taken", F.least(F.col("size"), F.col("taken") - F.col("repeat") * F.col("size")))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("at"))
    step = lambda a, x: F.when(a["n"] >= F.col("taken"), a).otherwise(
        F.struct((a["n"] + (x != "").cast("long")).alias("n"), (a["at"] + F.length(x) + 1).alias("at")))
    end = F.aggregate(F.split(spaced(F.col("text")), " "), start, step, lambda a: a["at"] - 1)
    part = F.col("taken") < F.col("size")
    out = out.withColumn("text", F.when(part, F.substring("text", F.lit(1), end)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(part, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out


def contract(docs: DataFrame) -> DataFrame:
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("n"), F.xxhash64("text").alias("text"))
    return mix(sized, size=F.col("n")).select("doc_id", "size", "source_size", "target", "taken", "source")

