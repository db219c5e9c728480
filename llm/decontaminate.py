"""Benchmark decontamination with suffix arrays over the training text.

Each task builds a suffix array over the words of one shard after another (half a MB of documents each).  Every benchmark suffix is then
located in it by binary search, word by word, which gives all places where its window occurs.  From each such place the
sorted benchmark suffixes are searched the other way, word by word, for the longest verbatim match that any of the
items with this window goes on with.  Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z, compared by
64-bit fingerprints.  Documents never move: the plan has no shuffle.

The benchmark is shipped to the tasks in blocks of about ``block_bytes`` of text (the size is measured first).  A
larger benchmark takes one more pass over the documents per block, so nothing is cut off; each pass is written to the
shared folder before the next, so a task holds the index of one block only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.textops import LOWER, NOT_ALNUM, Words, annotate, rolling, scratch_name, stored, text_slices

WINDOW = 10                 # words in a window; a shorter item is one window
SHARD_BYTES = 1 << 19       # text under one suffix array (a longer document is a shard of its own); its arrays take about 30 times that
BLOCK_BYTES = 8 << 20       # benchmark text shipped to the tasks at once

KIND = "n_words long, n_hit long, items array<string>, longest long, spans array<struct<start: long, end: long>>"


class BenchmarkIndex:
    """The suffixes of some benchmark items that start a window: distinct windows, the items of each, and all suffixes of
    a full window or more in their order (``gapped`` text with a 0 behind each item)."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        raw = [t.encode() for _, t in items]
        offsets = np.cumsum([0, *map(len, raw)])
        words = Words(np.frombuffer(b"".join(raw), np.uint8), offsets, NOT_ALNUM, LOWER)
        self.ids = np.array([i for i, _ in items], object)
        self.vocabulary = np.unique(words.hash)
        self.text = np.searchsorted(self.vocabulary, words.hash) + 1
        room, row, counts = words.room(), words.rows(), words.counts
        size = np.minimum(counts, window)[row]
        at = np.flatnonzero((room >= size) & ((counts[row] >= window) | (words.first[row] == np.arange(len(row)))))
        size = size[at]
        key = np.zeros(len(at), np.uint64)
        for n in np.unique(size):
            key[size == n] = rolling(words.hash, int(n))[at[size == n]] + np.uint64(n)
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        self.start, self.size, self.window = at[first], size[first], window
        order = np.lexsort((row[at], inverse))
        pairs = np.unique(np.stack([inverse[order], row[at][order]], 1), axis=0) if len(at) else np.zeros((0, 2), int)
        self.item_of, self.item_from = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(first) + 1))
        self.gapped = np.zeros(len(self.text) + len(items), np.int64)
        self.gapped[np.arange(len(self.text)) + row] = self.text
        full = np.zeros(len(self.gapped) + 1, bool)
        full[(np.arange(len(self.text)) + row)[room >= window]] = True
        order = suffix_array(self.gapped, int(counts.max(initial=0)))
        self.order = order[full[order]]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions with a known word (text > 0), in the order of the ``depth`` words that follow (prefix doubling)."""
    at = np.flatnonzero(text)
    rank = np.concatenate([text.astype(np.int64), np.zeros(1, np.int64)])
    known, order = 1, at[np.argsort(rank[at], kind="stable")]
    while known < depth and len(at):
        after = np.where(at + known < len(text), at + known, len(text))
        key = rank[at] * (int(rank.max()) + 1) + rank[after]
        by = np.argsort(key, kind="stable")
        order, key = at[by], key[by]
        rank = np.zeros_like(rank)
        rank[order] = np.cumsum(np.concatenate([[1], key[1:] != key[:-1]]))
        known = depth if rank[order[-1]] == len(at) else known * 2   # all different: in order
    return order


def narrow(text: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray):
    """The parts of the ranges [lo, hi) of a suffix array whose suffixes have ``word`` at ``depth``, by binary search."""
    edges = []
    for right in (False, True):
        a, b = lo.copy(), hi.copy()
        while (open_ := a < b).any():
            mid = (a + b) >> 1
            seen = text[order[np.minimum(mid, len(order) - 1)] + depth]
            up = open_ & ((seen <= word) if right else (seen < word))
            a = np.where(up, mid + 1, a)
            b = np.where(open_ & ~up, mid, b)
        edges.append(a)
    return edges


def locate(text: np.ndarray, order: np.ndarray, index: BenchmarkIndex) -> tuple[np.ndarray, np.ndarray]:
    """For each benchmark window, the range [lo, hi) of the suffix array whose suffixes start with it."""
    n = len(index.start)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    padded = np.concatenate([text, np.zeros(int(index.size.max()) if n else 0, text.dtype)])
    for d in range(int(index.size.max()) if n else 0):
        live = np.flatnonzero((lo < hi) & (index.size > d))
        if not len(live):
            break
        lo[live], hi[live] = narrow(padded, order, lo[live], hi[live], d, index.text[index.start[live] + d])
    return lo, hi


def longest_match(text: np.ndarray, places: np.ndarray, index: BenchmarkIndex) -> np.ndarray:
    """Words from each place that stand in a row in some benchmark item (places of full windows)."""
    size = np.zeros(len(places), np.int64)
    lo, hi = np.zeros(len(places), np.int64), np.full(len(places), len(index.order), np.int64)
    live, depth = np.arange(len(places)), 0
    while len(live):   # text ends with a gap (0), which no item has inside
        word = text[places[live] + depth]
        live = live[word > 0]
        if len(live):
            lo[live], hi[live] = narrow(index.gapped, index.order, lo[live], hi[live], depth, word[word > 0])
            live = live[lo[live] < hi[live]]
        depth += 1
        size[live] = depth
    return size


def spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, member) for every member of the ranges [lo, hi)."""
    count = np.maximum(hi - lo, 0)
    owner = np.repeat(np.arange(len(lo)), count)
    return owner, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + lo[owner]


def _shard(words: Words, index: BenchmarkIndex, earlier: list | None) -> list[tuple]:
    """Per document: n_words, n_hit, items, longest, spans."""
    counts, row = words.counts, words.rows()
    slot = np.minimum(np.searchsorted(index.vocabulary, words.hash), max(0, len(index.vocabulary) - 1))
    known = (index.vocabulary[slot] == words.hash) if len(index.vocabulary) else np.zeros(len(words.hash), bool)
    # a gap (0) behind each document keeps matches inside it
    text = np.zeros(len(words.hash) + len(counts), np.int64)
    text[np.arange(len(words.hash)) + row] = np.where(known, slot + 1, 0)
    cover = np.zeros(len(text) + 1, np.int64)
    items, longest = [set() for _ in counts], np.zeros(len(counts), np.int64)
    begin = words.first + np.arange(len(words.first))   # of each document in text
    if known.any():
        order = suffix_array(text, int(index.size.max()))
        lo, hi = locate(text, order, index)
        found = np.flatnonzero(lo < hi)
        q, member = spread(lo[found], hi[found])
        q, p = found[q], order[member]
        size = index.size[q].copy()
        np.add.at(cover, p, 1)
        np.add.at(cover, p + size, -1)
        full, which = np.unique(p[size == index.window], return_inverse=True)
        size[size == index.window] = longest_match(text, full, index)[which]
        doc = np.searchsorted(begin, p, "right") - 1
        np.maximum.at(longest, doc, size)
        for d, w in np.unique(np.stack([doc, q], 1), axis=0) if len(p) else ():
            items[d].update(index.ids[index.item_of[index.item_from[w]:index.item_from[w + 1]]])
    for d, old in enumerate(earlier or ()):
        items[d].update(old["items"])
        longest[d] = max(longest[d], old["longest"])
        for s in old["spans"]:
            cover[begin[d] + s["start"]] += 1
            cover[begin[d] + s["end"]] -= 1
    hit = np.cumsum(cover[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    owner = np.searchsorted(begin, starts, "right") - 1
    spans: list[list] = [[] for _ in counts]
    for d, s, e in zip(owner.tolist(), starts.tolist(), ends.tolist()):
        spans[d].append({"start": s - int(begin[d]), "end": e - int(begin[d])})
    return [(int(counts[d]), sum(s["end"] - s["start"] for s in spans[d]), sorted(items[d]), int(longest[d]), spans[d])
            for d in range(len(counts))]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The benchmark in blocks of about block_bytes: whether it is the last, and its items."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"),
                            F.col(text_col).alias("t")).where("t is not null")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b)
        yield b == n - 1, [(r.i, r.t) for r in part.collect()]


def match_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                    item_text_col: str = "text", into: str = "contamination", window: int = WINDOW,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus a struct: words, words inside a window that also occurs in a benchmark item, the items, the longest
    verbatim match (words) and the hit word spans.

    Null or empty texts have no words and match nothing; so do items without words.  Repeated documents are matched
    each, repeated items count once by id (a null id is written as the empty string).  Empty tables give no match.
    A text of any length is searched whole (one suffix array over it); an input column named like ``into`` is replaced,
    all others pass unchanged whatever their names.  The longest match starts with a window: a whole item of fewer words,
    or a full window and what follows it in any item that has it (among several of one length, only the length counts).
    """
    out = docs
    for n, (last, items) in enumerate(_blocks(benchmark, item_id_col, item_text_col, block_bytes)):
        index = BenchmarkIndex(items, window)

        def fn(b: pa.RecordBatch, index=index, later=n > 0) -> pa.StructArray:
            rows = []
            old = b.column(into).to_pylist() if later else None
            for i, raw, offsets in text_slices(b.column(text_col), SHARD_BYTES):
                words = Words(raw, offsets, NOT_ALNUM, LOWER)
                rows += _shard(words, index, old and old[i:i + len(offsets) - 1])
            kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                              ("longest", pa.int64()),
                              ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
            return pa.array([dict(zip(("n_words", "n_hit", "items", "longest", "spans"), r)) for r in rows], kind)
        out = annotate(out, fn, into, KIND)
        if not last:
            out = stored(out, "benchmark-pass")
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that share no window with the benchmark, in their own columns."""
    into = scratch_name(docs, "contamination_")
    return match_benchmark(docs, benchmark, into=into, **options).where(f"{into}.n_hit = 0").drop(into)


def contract(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    hit = match_benchmark(docs.select("doc_id", "text"), benchmark)
    return hit.select("doc_id", "contamination.n_words", "contamination.n_hit",
                      F.size("contamination.items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("contamination.items", ","), 256).alias("items_sha256"),
                      (F.col("contamination.n_hit") > 0).alias("contaminated"))
