"""Quality rules with risk-controlled cutoffs.

Each rule gives a document a score (symbols, shouting, repeated windows, repeated lines, all per word).  A rule rejects
scores above its cutoff.  Cutoffs are chosen per stratum (language) on labelled documents from a fixed grid: the share
of good documents that a cutoff rejects is tested against ``risk`` with the exact binomial tail
``P(Bin(n, risk) <= rejected)``.  Cutoffs are tested from lenient to strict and testing stops at the first failure (fixed
sequence, which needs no correction inside the grid); rules and strata share ``delta`` by Bonferroni.  So with
probability 1 - delta no rule rejects more than ``risk`` of the good documents of any stratum.  Of the cutoffs that
pass, the one with the largest gain (bad minus good documents rejected) is taken, the most lenient among equals.  A
stratum with too few labelled documents for a proof gets no cutoff and keeps everything.

All is DataFrame functions: no Python in the tasks, no row moves but the narrow score columns that join the labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from llm.textops import named, same, scratch_name, stored, word_array

RISK, DELTA = 0.02, 0.05
GRID = (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)   # lenient to strict
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
TERMS = 4096          # exact terms of a binomial tail; what lies beyond is bounded from above by a geometric series
MAX_STRATA = 10_000   # cutoff rows that are broadcast at most; beyond, a shuffled join

RULES = ("symbols", "shouting", "repeats", "lines")

_NO_WORD = "^[\\x20\\x09-\\x0D]*$"


def _removed(text: Column, chars: str) -> Column:
    """Occurrences of ASCII characters in a text: bytes that go when each is deleted."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in chars), F.lit(0))


def signals(docs: DataFrame, into: str = "signals") -> DataFrame:
    """``docs`` plus a struct of counts of the whole text (a null text counts as empty)."""
    t, w, h, s, p, n = (scratch_name(docs, x) for x in ("text_", "words_", "windows_", "sorted_", "places_", "lines_"))
    out = docs.withColumn(t, F.coalesce(F.col("text"), F.lit("")))
    out = out.withColumn(w, word_array(F.col(t))) \
        .withColumn(n, F.filter(F.split(t, "\n"), lambda x: ~F.rlike(x, F.lit(_NO_WORD))))
    out = out.withColumn(h, F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
        .otherwise(F.array().cast("array<long>")))
    # windows with their places, in the order of the windows, only where one occurs twice
    out = out.withColumn(s, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(
        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    out = out.withColumn(p, F.sort_array(F.transform(F.filter(
        F.transform(s, lambda x, i: F.struct(x["i"].alias("i"), (F.get(s, i - 1)["h"].eqNullSafe(x["h"])
                                                                | F.get(s, i + 1)["h"].eqNullSafe(x["h"])).alias("twice"))),
        lambda x: x["twice"]), lambda x: x["i"])))
    covered = F.when(F.col(s).isNull(), F.lit(0)).otherwise(F.aggregate(
        p, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"]))
    # spark_partition_id keeps filters on the counts above this step: pushed below, they would compute all of it again
    out = out.withColumn(into, F.when(F.spark_partition_id() >= 0, F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _removed(F.col(t), "#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size(n) - F.size(F.array_distinct(n))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        _removed(F.col(t), "!?").cast("long").alias("n_shouts"),
        F.size(n).cast("long").alias("n_lines"))))
    return out.drop(t, w, h, s, p, n)


def base_failed(sig: Column) -> Column:
    return (sig["n_words"] < MIN_WORDS) | (100 * sig["n_repeat_words"] > MAX_REPEAT_PERCENT * sig["n_words"])


def scores(sig: Column) -> dict[str, Column]:
    share = lambda a, b: F.coalesce(sig[a] / F.nullif(sig[b], F.lit(0)), F.lit(0.0))
    return {"symbols": share("n_symbols", "n_words"), "shouting": share("n_shouts", "n_words"),
            "repeats": share("n_repeat_words", "n_words"), "lines": share("n_dup_lines", "n_lines")}


def _log_gamma(x: Column) -> Column:
    """Stirling's series, shifted by 10 (relative error under 1e-14 for x >= 1)."""
    z = x + 10
    product = F.lit(0.0)
    for i in range(10):
        product = product + F.log(x + i)
    return (z - 0.5) * F.log(z) - z + F.lit(0.9189385332046727) + 1 / (12 * z) - 1 / (360 * z * z * z) \
        + 1 / (1260 * z * z * z * z * z) - product


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), 1 where k is not under the mean (no proof is possible there)."""
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    step = lambda i: i * (1 - p) / ((n - i + 1) * p)  # noqa: E731  from i to i - 1 successes
    last = F.least(k, F.lit(float(TERMS)))
    sums = F.aggregate(F.sequence(F.lit(0), last.cast("int")), F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
                       lambda a, j: F.struct((a["term"] * step(k - j)).alias("term"), (a["sum"] + a["term"]).alias("sum")))
    ratio = step(k - last)
    beyond = F.when(k > TERMS, sums["term"] / (1 - ratio)).otherwise(0.0)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), top * (sums["sum"] + beyond)))


def cutoffs(scored: DataFrame, risk: float = RISK, delta: float = DELTA, grid: tuple[float, ...] = GRID) -> DataFrame:
    """(stratum, one column per rule) from rows (stratum, quality, a column per rule); null: the rule is not applied."""
    rows = scored.where("quality in (0, 1)")
    tested = rows.select("stratum", "quality", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(r).alias("score")) for r in RULES])).alias("x")).select("stratum", "quality", "x.*")
    good = F.col("quality") == 1
    count = tested.groupBy("stratum", "rule").agg(
        F.sum(good.cast("long")).alias("n"),
        *[F.struct(F.lit(c).alias("cutoff"), F.sum((good & (F.col("score") > c)).cast("long")).alias("lost"),
                   F.sum((~good & (F.col("score") > c)).cast("long")).alias("caught")).alias(f"c{i}") for i, c in enumerate(grid)])
    count = stored(count.select("stratum", "rule", "n", F.explode(F.array(*[f"c{i}" for i in range(len(grid))])).alias("c"))
                   .select("stratum", "rule", "n", "c.*"), "calibration")
    families = max(1, count.select("stratum", "rule").distinct().count())
    proof = count.withColumn("p", binomial_tail(F.col("lost"), F.col("n"), risk))
    lenient_first = W.partitionBy("stratum", "rule").orderBy(F.col("cutoff").desc())
    proof = proof.withColumn("worst", F.max("p").over(lenient_first.rowsBetween(W.unboundedPreceding, W.currentRow)))
    passed = proof.where((F.col("worst") <= delta / families) & (F.col("caught") > F.col("lost")))
    best = passed.groupBy("stratum", "rule").agg(F.max_by("cutoff", F.struct(F.col("caught") - F.col("lost"), "cutoff")).alias("cutoff"))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(r) for r in RULES])


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA,
                into: str = "quality_rules", counted: str | None = None) -> DataFrame:
    """``docs`` plus a struct: the counts, base_failed, kept, and the rules that rejected the document.

    ``counted`` names a column that holds the counts of ``signals`` already; else they are computed from ``text``.

    A null text counts as empty and fails the base rule; a null stratum is a stratum of its own.  Labels count once per
    (doc_id, quality); null or other labels, and labels without a document, are not used.  Without labels nothing is
    proved, so only the base rule rejects.  Repeated documents are judged each.  Empty tables give an empty result.
    """
    sig, st = scratch_name(docs, "signals_"), scratch_name(docs, "stratum_")
    with_signals = (docs.withColumn(sig, F.col(counted)) if counted else signals(docs, sig)).withColumn(st, F.col(stratum))
    known = labels.select(F.col("doc_id").alias("labelled"), F.col("quality")).where("quality in (0, 1)").distinct()
    ids = with_signals.select("doc_id", F.col(st).alias("stratum"), F.col(sig).alias("signals"))
    sample = ids.join(known, F.col("doc_id") == F.col("labelled")).where(~base_failed(F.col("signals")))
    key, cut = scratch_name(docs, "cut_stratum_"), scratch_name(docs, "cut_")
    chosen = cutoffs(sample.select("stratum", "quality", *[c.alias(r) for r, c in scores(F.col("signals")).items()]), risk, delta)
    chosen = stored(chosen.select(F.col("stratum").alias(key), F.struct(*RULES).alias(cut)), "cutoffs")
    if chosen.count() <= MAX_STRATA:
        chosen = F.broadcast(chosen)
    out = with_signals.join(chosen, same(F.col(st), F.col(key)), "left")
    rejected = F.array_compact(F.array(*[F.when(c > F.col(f"{cut}.{r}"), F.lit(r)) for r, c in scores(F.col(sig)).items()]))
    failed = base_failed(F.col(sig))
    verdict = F.struct(F.col(f"{sig}.*"), failed.alias("base_failed"), (~failed & (F.size(rejected) == 0)).alias("kept"),
                       rejected.alias("rejected_by"))
    return out.withColumn(into, verdict).select(*named([c for c in docs.columns if c.lower() != into.lower()]), into)


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that no rule rejects, in their own columns."""
    into = scratch_name(docs, "rules_")
    return apply_rules(docs, labels, into=into, **options).where(f"{into}.kept").drop(into)


def contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    counts = stored(signals(docs.select("doc_id", "text", "lang")).drop("text"), "signals")   # once, for both uses
    out = apply_rules(counts, labels, counted="signals")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return out.select("doc_id", *[f"quality_rules.{n}" for n in names],
                      F.array_join("quality_rules.rejected_by", ",").alias("rejected_by"))
