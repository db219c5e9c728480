"""Substring deduplication by relative Lempel-Ziv parsing.

The reference is the corpus itself.  It is cut into content-defined blocks: a minimiser over 16-word seeds marks at
least one *anchor* in every 50-word window, and equal windows choose equal anchors, so only blocks whose anchor occurs
in two different documents can hold a repeated window.  Of those blocks every window is indexed (128-bit fingerprint ->
its first occurrence: smallest document, first place in it).  Each document is parsed greedily against the whole index:
a factor starts at the first window that an earlier document holds, and is extended word by word while the occurrence in
the reference moves on with it, so it stands verbatim at (reference, place).  Where a factor ends, the windows across its
boundary are looked up too and start factors of their own, so that a repeat that the greedy cut would split is found.
Factors reach ``window`` words by construction and become duplicate spans.

Steps (every group-by is pre-aggregated; joins on hot anchors or windows are split by AQE):
 1. one pass over the texts: words, digest, anchors per document (written to the shared folder);
 2. copies with equal word sequences collapse on their digest; anchors are grouped -> shared anchors;
 3. texts with a shared anchor are read again and their candidate windows written;
 4. index = first occurrence per window; candidate windows join it; the parse runs per document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.textops import SPACES, Words, lists, rolling, signed, sliding_min, stored, text_slices

WINDOW = 50     # words in a window = least length of a factor
SEED = 16       # words in the seed that anchors are chosen from

NO_ID = -(1 << 63)   # stands for a null doc_id

FACTORS = "factors array<struct<start: long, words: long, reference: long, place: long>>"
SURVEYED = "doc_id long, key long, n_words long, digest string, anchors array<long>"
PARSED = f"doc_id long, key long, {FACTORS}, n_removed long, kept_sha256 string"
PLACES = 1 << 31   # more than a document has words

_OTHER = np.uint64(0xD6E8FEB86659FD93)


def anchors(words: Words, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(start of every window, its anchor): the smallest seed fingerprint among the seeds inside the window."""
    low = sliding_min(rolling(words.hash, seed), window - seed + 1)
    at = np.flatnonzero(words.room() >= window)
    return at, low[at]


def _survey(window: int, seed: int):
    """Pass 1: (doc_id, text key, words, digest of the words, distinct anchors)."""
    def run(batches):
        for b in batches:
            for i, raw, offsets in text_slices(b.column(2)):
                w = Words(raw, offsets, SPACES)
                n = len(offsets) - 1
                data = raw.tobytes()
                digests = [hashlib.sha256(b" ".join(data[s:e].split())).hexdigest()
                           for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                at, low = anchors(w, window, seed)
                row = np.searchsorted(w.first, at, "right") - 1
                new = np.ones(len(at), bool)
                new[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1])
                at, low, row = at[new], low[new], row[new]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n), b.column(1).slice(i, n), pa.array(w.counts, pa.int64()), pa.array(digests),
                     lists(signed(low), np.searchsorted(row, np.arange(n + 1)), pa.int64())],
                    names=["doc_id", "key", "n_words", "digest", "anchors"])
    return run


def _candidates(window: int, seed: int):
    """Pass 2: the windows whose anchor is shared, as (two fingerprints, doc_id, text key, place)."""
    def run(batches):
        for b in batches:
            for i, raw, offsets in text_slices(b.column(2)):
                w = Words(raw, offsets, SPACES)
                n = len(offsets) - 1
                at, low = anchors(w, window, seed)
                row = np.searchsorted(w.first, at, "right") - 1
                picked = b.column(3).slice(i, n)
                owner = np.repeat(np.arange(n), np.diff(picked.offsets.to_numpy()))
                marks = np.unique(np.stack([owner.astype(np.uint64), picked.flatten().to_numpy().view(np.uint64)], 1), axis=0)
                # a window is kept if (row, anchor) is marked: compare one row's anchors at a time
                keep = np.zeros(len(at), bool)
                edge = np.searchsorted(row, np.arange(n + 1))
                mark_edge = np.searchsorted(marks[:, 0], np.arange(n + 1).astype(np.uint64))
                for r in range(n):
                    keep[edge[r]:edge[r + 1]] = np.isin(low[edge[r]:edge[r + 1]], marks[mark_edge[r]:mark_edge[r + 1], 1])
                at, row = at[keep], row[keep]
                one = rolling(w.hash, window)[at]
                two = rolling(w.hash * _OTHER ^ (w.hash >> np.uint64(29)), window)[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(one)), pa.array(signed(two)), b.column(0).slice(i, n).take(pa.array(row)),
                     b.column(1).slice(i, n).take(pa.array(row)), pa.array((at - w.first[row]).astype(np.int32))],
                    names=["h1", "h2", "doc_id", "key", "at"])
    return run


def greedy_factors(at: np.ndarray, source: np.ndarray, place: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """(start, words, reference document, place in it) of each factor, from the places of repeated windows and their
    first occurrences: a factor goes on while the occurrence moves on with it."""
    if not len(at):
        return []
    order = np.argsort(at, kind="stable")
    at, source, place = at[order], source[order], place[order]
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (source[1:] != source[:-1]) | (np.diff(place) != 1)]))
    last = np.concatenate([cut[1:], [len(at)]]) - 1
    return [(int(at[a]), int(at[z] - at[a]) + window, int(source[a]), int(place[a])) for a, z in zip(cut, last)]


def _parse(window: int, texts: bool):
    """Pass 3: factors of a document, the words they remove, the digest of the rest (and the rest, if ``texts``)."""
    names = ("start", "words", "reference", "place")
    factor = pa.list_(pa.struct([(n, pa.int64()) for n in names]))

    def run(batches):
        for b in batches:
            out = []
            for text, found in zip(b.column(2).cast(pa.large_binary()).to_pylist(), b.column(3)):
                parts = greedy_factors(*(found.values.field(k).to_numpy() for k in range(3)), window)
                words = text.split()
                cover = np.zeros(len(words) + 1, np.int64)
                for s, n, *_ in parts:
                    cover[s] += 1
                    cover[s + n] -= 1
                gone = np.cumsum(cover[:-1]) > 0
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                out.append(([dict(zip(names, p)) for p in parts], int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                            kept.decode() if texts else None))
            columns = [b.column(0), b.column(1), pa.array([o[0] for o in out], factor), pa.array([o[1] for o in out], pa.int64()),
                       pa.array([o[2] for o in out], pa.string()), pa.array([o[3] for o in out], pa.string())]
            yield pa.RecordBatch.from_arrays(columns[:5 + texts], names=["doc_id", "key", "factors", "n_removed", "kept_sha256",
                                                                        "kept_text"][:5 + texts])
    return run


def dedupe_substrings(docs: DataFrame, window: int = WINDOW, seed: int = SEED, texts: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): words, removed words, digest of the kept words, the factors, and if
    ``texts`` the kept text (null where nothing was removed, as the text itself stays).

    A word goes if a window of ``window`` words over it also starts in a document with a smaller doc_id.  A null or empty
    text has no words; a text shorter than the window loses none.  Rows with the same doc_id count as one document for
    that order (neither removes from the other; a factor's place counts in any of them); a null doc_id is smaller than all
    others.  Empty input gives an empty
    result; other columns are not used, whatever their names.  doc_id is a whole number (of any integer type; text that
    is none raises).  A text of any length is one document: its windows are indexed like all others.
    """
    src = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                      F.xxhash64("text").alias("key"), F.col("text"))
    survey = stored(src.mapInArrow(_survey(window, seed), SURVEYED), "survey")
    long = survey.where(F.col("n_words") >= window)
    # the small sides of joins on hot keys are written, so that AQE can split the other side
    first = stored(long.groupBy("digest").agg(F.min("doc_id").alias("rep")), "copies")
    marks = long.join(first, "digest").where("doc_id = rep").select("doc_id", F.explode("anchors").alias("a"))
    shared = stored(marks.groupBy("a").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
                    .select("a"), "anchors")
    listed = marks.join(shared, "a").groupBy("doc_id").agg(F.collect_set("a").alias("anchors"))
    cand = stored(src.where("text is not null").join(listed, "doc_id").select(*src.columns, "anchors"), "candidates")
    wins = stored(cand.mapInArrow(_candidates(window, seed), "h1 long, h2 long, doc_id long, key long, at int"), "windows")
    # document and place as one number: its minimum is kept by hash aggregation, a struct's is not
    first_at = F.min(F.col("doc_id").cast("decimal(20,0)") * F.lit(PLACES).cast("decimal(10,0)") + F.col("at"))
    index = wins.groupBy("h1", "h2").agg(first_at.alias("first"), F.max("doc_id").alias("last")) \
        .withColumn("place", F.pmod("first", F.lit(PLACES).cast("decimal(10,0)")).cast("int")) \
        .withColumn("source", F.expr(f"cast((first - place) div {PLACES} as long)"))
    index = stored(index.where("source < last").select("h1", "h2", "source", "place"), "index")
    found = wins.join(index, ["h1", "h2"]).where("source < doc_id") \
        .groupBy("doc_id", "key").agg(F.collect_set(F.struct("at", "source", "place")).alias("found"))
    parsed = cand.select("doc_id", "key", "text").join(found, ["doc_id", "key"]) \
        .mapInArrow(_parse(window, texts), PARSED + ", kept_text string" * texts).dropDuplicates(["doc_id", "key"])
    copy = F.col("rep") < F.col("doc_id")
    known = lambda c: F.when(c != NO_ID, c)
    return survey.drop("anchors").join(first, "digest", "left").join(parsed, ["doc_id", "key"], "left").select(
        known(F.col("doc_id")).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(copy, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("words"),
                                      known(F.col("rep")).alias("reference"), F.lit(0).cast("long").alias("place"))))
        .otherwise(F.transform("factors", lambda f: f.withField("reference", known(f["reference"])))).alias("factors"),
        *[F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")] * texts)


def contract(docs: DataFrame) -> DataFrame:
    return dedupe_substrings(docs, texts=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
