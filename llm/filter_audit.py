"""Filter interaction audit by incremental retraction streaming.

All files are read as available-now micro-batches.  Each row becomes the mask of the filters that its text fails; whether
it fails E (a copy of a smaller id's text) can change while smaller ids still arrive.  A state per text holds its least
id so far and the rows with that id.  Every row is first counted as a copy; the rows with a text's least id are counted
without E instead, and as soon as a smaller id arrives that is retracted and entered for the smaller id's rows.  Every
micro-batch writes its state entries and the sums of its changes per (part, mask, labels) into directories of its own,
which a replayed batch overwrites; it reads only what earlier batches wrote, and every eighth batch gathers the state
anew.  The sums of all changes are at most 128 counters a part, and every figure of all 120 filter orders follows.

A text that a third of the rows share costs a partial minimum per map task; its rows are joined by (text, id).
"""

from __future__ import annotations

import uuid
from itertools import permutations
from math import ceil, factorial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from llm.textops import shared_dir, stored, word_array

LETTERS = "ABCDE"
BIT = {c: 1 << i for i, c in enumerate(LETTERS)}
E = BIT["E"]
ORDERS = ["".join(p) for p in permutations(LETTERS)]
BATCHES = 4   # micro-batches that a table's files are divided into
GATHER = 8    # batches after which the state is written as one table again

#: Changes of the counters: n rows of a part, with a mask and labels.
CHANGE = "part string, mask int, good boolean, toxic boolean, n long"


def failing(text: Column) -> Column:
    """The bits of filters A to D that a text fails."""
    words, distinct = F.col("_w"), F.size(F.array_distinct("_w"))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    parts = {"A": F.size(words) < 200, "B": 100 * distinct < 50 * F.size(words),
             "C": 100 * capitals > 2 * F.length(text), "D": text.rlike(r"[#$%&*|]")}
    bits = [F.when(fails, BIT[c]).otherwise(0) for c, fails in parts.items()]
    return sum(bits[1:], bits[0])


def order_kind(given: T.DataType) -> T.DataType:
    """The type that ids are compared in: whole numbers as long, other numbers as double, all else as text."""
    if isinstance(given, T.IntegralType):
        return T.LongType()
    return T.DoubleType() if isinstance(given, T.NumericType) else T.StringType()


def label_flags(labels: DataFrame) -> DataFrame:
    """One row per labelled id: good (some quality is 1) and toxic (some toxic is 1); ids with neither are left out."""
    on = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)) == 1
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(on("quality").alias("good"), on("toxic").alias("toxic")) \
        .where("good OR toxic")


def features(docs: DataFrame) -> DataFrame:
    """(key, id, part, mask) of documents (doc_id, text, source): the text's digest and the filters A to D that it fails."""
    kind = order_kind(docs.schema["doc_id"].dataType)
    return docs.select(F.col("doc_id").cast(kind).alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text")) \
        .withColumn("_w", word_array(F.col("text"))) \
        .select(F.unhex(F.sha2("text", 256)).alias("key"), "id", "part", failing(F.col("text")).alias("mask"))


class Audit:
    """The state and the changes of one stream, in the folder ``at``."""

    def __init__(self, labels: DataFrame, at: str):
        self.labels, self.at = labels, at

    def read(self, schema: T.StructType, *names: str) -> DataFrame:
        return self.labels.sparkSession.read.schema(schema).parquet(*[f"{self.at}/{n}" for n in names])

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.at}/{name}")
        return self.read(df.schema, name)

    def state(self, batch: int, schema: T.StructType) -> DataFrame:
        """What batches before this one have entered: per text the rows of each id that was its least at some time."""
        base = batch - batch % GATHER
        names = ([f"gathered/batch={base}"] if base else []) + [f"state/batch={b}" for b in range(base, batch)]
        return self.read(schema, *names) if names else self.labels.sparkSession.createDataFrame([], schema)

    def gather(self, batch: int, schema: T.StructType) -> None:
        """Before every GATHER-th batch: the entries of the least ids so far, as one table."""
        base = batch - GATHER
        names = ([f"gathered/batch={base}"] if base else []) + [f"state/batch={b}" for b in range(base, batch)]
        before = self.read(schema, *names)
        least = before.groupBy("key").agg(F.min("id").alias("id"))
        self.write(before.join(least, ["key", "id"]), f"gathered/batch={batch}")

    def step(self, given: DataFrame, batch: int) -> None:
        """One micro-batch of features."""
        seen = self.write(given, f"rows/batch={batch}")
        no = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
        flags = self.labels.select(F.col("doc_id").cast(seen.schema["id"].dataType).alias("id"), "good", "toxic")
        rows = self.write(seen.join(flags, "id", "left").groupBy("key", "id", "part", "mask", no("good"), no("toxic"))
                          .agg(F.count("*").alias("n")), f"counted/batch={batch}")
        if batch and batch % GATHER == 0:
            self.gather(batch, rows.schema)
        state = self.state(batch, rows.schema)
        least = rows.where("id IS NOT NULL").groupBy("key").agg(F.min("id").alias("id")) \
            .join(state.groupBy("key").agg(F.min("id").alias("held")), "key", "left").where("held IS NULL OR id <= held")
        entered = self.write(rows.join(least.select("key", "id"), ["key", "id"]), f"state/batch={batch}")
        retracted = state.join(least.where("id < held").select("key", F.col("held").alias("id")), ["key", "id"])
        copy = F.when(F.col("id").isNull(), F.col("mask")).otherwise(F.col("mask").bitwiseOR(E))
        entry = lambda df, mask, n: df.select("part", mask.alias("mask"), "good", "toxic", n.alias("n"))
        n, mask = F.col("n"), F.col("mask")
        parts = [entry(rows, copy, n), entry(entered, copy, -n), entry(entered, mask, n), entry(retracted, mask, -n), entry(retracted, copy, n)]
        changes = parts[0]
        for p in parts[1:]:
            changes = changes.unionByName(p)
        log_changes(changes, f"{self.at}/changes/batch={batch}")


def docs_seen(spark: SparkSession, at: str) -> bool:
    """Whether some micro-batch has been logged."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/changes")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def log_changes(changes: DataFrame, path: str) -> None:
    """The sums of one micro-batch's changes, in a directory of its own."""
    changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0").write.mode("overwrite").parquet(path)


def counters(docs: DataFrame, labels: DataFrame, at: str | None = None) -> DataFrame:
    """The final counters (part, mask, good, toxic, n) of a stream of documents, run until all its files are processed.

    The stream's checkpoint, its state and its changes lie in ``at`` (a new folder in the shared one): a run that is
    begun again there goes on behind its last whole micro-batch, and a micro-batch that runs twice writes one and the
    same directories.
    """
    spark = docs.sparkSession
    at = at or f"{shared_dir(spark)}/llm-audit-{uuid.uuid4().hex[:12]}"
    audit = Audit(labels, at)
    features(docs).writeStream.foreachBatch(audit.step).option("checkpointLocation", f"{at}/checkpoint") \
        .trigger(availableNow=True).start().awaitTermination()
    if not docs_seen(spark, at):
        return spark.createDataFrame([], T.StructType.fromDDL(CHANGE))
    return spark.read.schema(T.StructType.fromDDL(f"{CHANGE}, batch int")).parquet(f"{at}/changes") \
        .groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")


def _figures() -> list[tuple]:
    """(mask, filter_order, step, kept, removed, redundant, unique, shapley) for every mask: whether a row with that mask
    counts, and in how many of the 120 orders the step's filter removes it."""
    out = []
    for mask in range(1 << len(LETTERS)):
        failed = bin(mask).count("1")
        for order in ORDERS:
            done = 0
            for step, letter in enumerate(order, 1):
                bit = BIT[letter]
                fails, gone = bool(mask & bit), bool(mask & done)
                out.append((mask, order, step, int(not mask & (done | bit)), int(fails and not gone), int(fails and gone), int(mask == bit),
                            factorial(len(LETTERS)) // failed if fails else 0))
                done |= bit
    return out


def interactions(counts: DataFrame) -> DataFrame:
    """All figures of all orders and steps per part, from the counters.  Each (part, mask) meets the 600 steps of its mask
    in a table of fixed size (19,200 rows)."""
    spark = counts.sparkSession
    steps = spark.createDataFrame(pd.DataFrame(_figures(), columns=["mask", "filter_order", "step", "k", "r", "d", "u", "s"]),
                                  "mask int, filter_order string, step int, k int, r int, d int, u int, s int")
    count = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
    per_mask = counts.groupBy("part", "mask").agg(F.sum("n").alias("n"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic"))
    total = lambda n, flag, name: F.sum(F.col(n) * F.col(flag)).cast("long").alias(name)
    return per_mask.join(F.broadcast(steps), "mask").groupBy("part", "filter_order", "step").agg(
        total("n", "k", "kept"), total("n", "r", "removed"), total("n", "d", "redundant"), total("n", "u", "unique_fails"),
        total("good", "r", "good_lost"), total("toxic", "r", "toxic_lost"), total("n", "s", "shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of a stream of documents (doc_id, text, source) with labels (doc_id, quality, toxic): one row per part,
    filter_order (120) and step (5): kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A null text is empty and a null source is the part ''.  A null doc_id fails E for no one and never itself; rows of
    one doc_id are no copies of each other.  An id with several labels is good (toxic) if one of them says so.  An empty
    table has no parts and gives no rows.  Texts are taken whole; other columns, whatever their names, are not used.
    """
    return interactions(counters(docs, stored(label_flags(labels), "labels")))


def file_stream(spark: SparkSession, path: str, batches: int = BATCHES) -> DataFrame:
    """The files of a Parquet table (a folder or one file) as a stream of about ``batches`` micro-batches."""
    table = spark.read.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        path = f"{path[:-1]}[{path[-1]}]"   # a stream takes one file by a pattern only
    files = max(1, ceil(len(table.inputFiles()) / batches))
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(path)


def contract(spark: SparkSession, documents: str, labels: DataFrame) -> DataFrame:
    return audit(file_stream(spark, documents), labels)
