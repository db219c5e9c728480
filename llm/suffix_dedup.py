"""Suffix-array deduplication of bytes: deep-shallow sorting of the suffixes that can repeat.

A suffix is followed for ``window`` bytes; equal ones that start in different documents are repeats.  Which suffixes can
repeat is found first: a minimiser over SEED bytes marks an *anchor* in every window, equal windows have equal anchors, so
only windows whose anchor occurs in two documents are sorted.  The stretch of consecutive windows around such an anchor
goes to the anchor's bucket.  A bucket's stretches are collapsed where they are equal, laid behind one another with those
of other buckets, and the suffixes of this text are put in order by deep-shallow sorting: a multikey quicksort over
8-byte characters, all parts of one round at a time, goes down to a shallow depth, and blind tries order what still
shares that prefix.  Neighbours that agree on ``window`` bytes form a class, whose smallest document keeps its bytes.

No bucket is unbounded: the stretches of an anchor that occurs more than CROWD times go to buckets of their own content.
There a stretch that a smaller document also holds is covered as a whole; only the stretches of each one's smallest
document go on, window by window, to buckets of the windows' content, where only the smallest document counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from llm.textops import lists, mix, rolling, signed, sliding_min, stored, text_slices

WINDOW = 50          # bytes that a repeat has at least
SEED = 24            # bytes that anchors are chosen from: long enough that few are shared by chance
SHALLOW = 16         # depth of the multikey quicksort in bytes; beyond it the blind tries
CROWD = 1 << 14      # occurrences of an anchor that are sorted as one bucket
STRETCH = 64         # windows in one stretch (a longer run of one anchor is cut)
TEXT = 1 << 20       # bytes of stretches that are sorted at once

NO_ID = -(1 << 63)   # stands for a null doc_id

MARKS = "a long, doc_id long, n int"
STRETCHES = "bucket long, piece binary, doc_id long, key long, start long, alone boolean"
REPEATS = "doc_id long, key long, start long, stop long"
WINDOWS = REPEATS + ", bucket long, piece binary"

_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


# --- deep-shallow sorting -----------------------------------------------------------------------------------------

def characters(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position as one number whose order is theirs (zeros behind the end)."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for i in range(8):
        out = out << np.uint64(8) | padded[i:i + len(text)]
    return out


def multikey_quicksort(chars: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts in the order of their first ``depth`` bytes, the number of each one's group of equal ones).

    Each round splits every unfinished part by a pivot, its middle element's character, into less, equal and greater; the
    equal part goes on with its next character.  All parts of a round are split together.
    """
    order, n = starts.copy(), len(starts)
    rank = np.zeros(n, np.int64)          # position where the element's part begins
    at = np.zeros(n, np.int64)            # bytes that the element's part has in common
    live = np.arange(n)                   # positions of elements in unfinished parts
    while len(live):
        part = rank[live]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sizes = np.diff(np.concatenate([first, [len(live)]]))
        c = chars[np.minimum(order[live] + at[live], len(chars) - 1)]
        pivot = np.repeat(c[first + sizes // 2], sizes)
        side = (c > pivot).astype(np.int8) - (c < pivot)
        move = np.lexsort((side, part))
        order[live], side, deep = order[live][move], side[move], at[live][move]
        cut = np.concatenate([[True], (part[1:] != part[:-1]) | (side[1:] != side[:-1])])
        begin = np.flatnonzero(cut)
        rank[live] = np.repeat(live[begin], np.diff(np.concatenate([begin, [len(live)]])))
        at[live] = deep + 8 * (side == 0)
        size = np.repeat(np.diff(np.concatenate([begin, [len(live)]])), np.diff(np.concatenate([begin, [len(live)]])))
        live = live[(size > 1) & (at[live] < depth)]
    return order, rank


class BlindTrie:
    """A trie of equally long byte strings (as numbers) that keeps only where they part and the byte there."""

    def __init__(self, length: int):
        self.length, self.root = length, None

    def common(self, a: int, b: int) -> int:
        return self.length - (((a ^ b).bit_length() + 7) >> 3)

    def byte(self, value: int, depth: int) -> int:
        return value >> 8 * (self.length - 1 - depth) & 255

    def add(self, value: int, item: int) -> None:
        if self.root is None:
            self.root = (self.length, value, [item])
            return
        node = self.root
        while node[0] < self.length:   # blindly down to some leaf: its string shares as much as any
            node = node[1].get(self.byte(value, node[0])) or next(iter(node[1].values()))
        shared = self.common(value, node[1])
        if shared == self.length:
            node[2].append(item)
            return
        leaf, up, node = (self.length, value, [item]), None, self.root
        while node[0] < shared:
            up, node = node, node[1][self.byte(value, node[0])]
        if node[0] == shared:
            node[1][self.byte(value, shared)] = leaf
            return
        other = node
        while other[0] < self.length:
            other = next(iter(other[1].values()))
        branch = (shared, {self.byte(value, shared): leaf, self.byte(other[1], shared): node})
        if up is None:
            self.root = branch
        else:
            up[1][self.byte(value, up[0])] = branch

    def leaves(self) -> Iterator[list[int]]:
        """The items of each string, strings in order."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[0] == self.length:
                yield node[2]
            else:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]


def deep_shallow(text: np.ndarray, starts: np.ndarray, window: int = WINDOW, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(the starts in the order of their next ``window`` bytes, the number of each one's class of equal windows)."""
    shallow = min(shallow, window // 8 * 8)
    chars = characters(text)
    order, rank = multikey_quicksort(chars, starts, shallow)
    n = len(order)
    if not n:
        return order, np.zeros(0, np.int64)
    # equal windows go to the tries as one: those of a part with one fingerprint whose bytes agree
    code = rolling(_CODES[text], window)[order]
    by = np.lexsort((code, rank))
    order, code = order[by], code[by]
    new = np.concatenate([[True], (rank[1:] != rank[:-1]) | (code[1:] != code[:-1])])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    bytewise = shallow + (window - shallow) // 8 * 8
    for at in range(shallow, bytewise, 8):
        new |= chars[order + at] != chars[order[lead] + at]
    for at in range(bytewise, window):
        new |= text[order + at] != text[order[lead] + at]
    lead = np.where(new, np.arange(n), lead)
    leads = np.flatnonzero(new)
    part = rank[leads]
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    sizes = np.diff(np.concatenate([first, [len(leads)]]))
    place = np.zeros(n, np.int64)         # of a window among those of its part
    data, rest = text.tobytes(), window - shallow
    for b, size in zip(first[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        trie, own = BlindTrie(rest), leads[b:b + size]
        for i, s in zip(own.tolist(), order[own].tolist()):
            trie.add(int.from_bytes(data[s + shallow:s + window]), i)
        for i, same in enumerate(trie.leaves()):
            place[same] = i
    place = place[lead]
    by = np.lexsort((place, rank))
    order, place = order[by], place[by]
    return order, np.cumsum(np.concatenate([[False], (rank[1:] != rank[:-1]) | (place[1:] != place[:-1])]))


# --- candidates ---------------------------------------------------------------------------------------------------

def runs(raw: np.ndarray, offsets: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, ...]:
    """(first window, windows, row, anchor) of every run of consecutive windows with one anchor."""
    low = sliding_min(rolling(_CODES[raw], seed), window - seed + 1)
    sizes = np.maximum(np.diff(offsets) - window + 1, 0)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + offsets[row]
    low = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    return at[begin], np.diff(np.concatenate([begin, [len(at)]])), row[begin], low[begin]


def _mark(window: int, seed: int):
    """The distinct anchors of each document with their number of runs."""
    def run(batches):
        for b in batches:
            for i, raw, offsets in text_slices(b.column(2)):
                _, length, row, low = runs(raw, offsets, window, seed)
                order = np.lexsort((low, row))
                row, low, pieces = row[order], low[order], (-(-length // STRETCH))[order]
                new = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (row[1:] != row[:-1])])) if len(row) else row
                counts = np.add.reduceat(pieces, new) if len(new) else pieces
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(low[new])), b.column(0).slice(i, len(offsets) - 1).take(pa.array(row[new])), pa.array(counts.astype(np.int32))],
                    names=["a", "doc_id", "n"])
    return run


def _cut_out(window: int, seed: int):
    """The stretches of each document's listed anchors, alone where the anchor is crowded."""
    def run(batches):
        for b in batches:
            for i, raw, offsets in text_slices(b.column(2)):
                first, length, row, low = runs(raw, offsets, window, seed)
                n = len(offsets) - 1
                listed = {}
                for name, at in (("some", 3), ("crowded", 4)):
                    col = b.column(at).slice(i, n)
                    owner = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False))
                    values = col.flatten().to_numpy().view(np.uint64)
                    edge, hit = np.searchsorted(owner, np.arange(n + 1)), np.zeros(len(low), bool)
                    own = np.searchsorted(row, np.arange(n + 1))
                    for r in np.unique(owner):
                        hit[own[r]:own[r + 1]] = np.isin(low[own[r]:own[r + 1]], values[edge[r]:edge[r + 1]])
                    listed[name] = hit
                out = []
                for name in ("some", "crowded"):
                    f, l, r, a = (x[listed[name]] for x in (first, length, row, low))
                    pieces = -(-l // STRETCH)
                    which = np.repeat(np.arange(len(f)), pieces)
                    nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                    start = f[which] + nth * STRETCH
                    stop = np.minimum(start + STRETCH, (f + l)[which]) - 1 + window
                    bucket = a[which]
                    if name == "crowded" and len(start):
                        code = rolling(_CODES[raw], window)
                        bucket = code[start] ^ mix(code[stop - window])
                    out.append((bucket, start, stop, r[which], np.full(len(which), name == "crowded")))
                bucket, start, stop, r, alone = (np.concatenate(x) for x in zip(*out))
                data = raw.tobytes()
                step = 1 << 16
                for j in range(0, len(start), step):
                    s = slice(j, j + step)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(bucket[s])), pa.array([data[x:y] for x, y in zip(start[s].tolist(), stop[s].tolist())], pa.binary()),
                         b.column(0).slice(i, n).take(pa.array(r[s])), b.column(1).slice(i, n).take(pa.array(r[s])),
                         pa.array((start - offsets[r])[s]), pa.array(alone[s])],
                        names=["bucket", "piece", "doc_id", "key", "start", "alone"])
    return run


# --- buckets ------------------------------------------------------------------------------------------------------

class _Shard:
    """Buckets that are sorted as one text: the distinct pieces, and where they stand."""

    def __init__(self, window: int):
        self.window = window
        self.pieces: list[bytes] = []
        self.least: list[np.ndarray] = []
        self.places: list[tuple[np.ndarray, ...]] = []   # (piece, document, text key, start)
        self.size = self.rows = 0

    def add(self, pieces: list[bytes], least: np.ndarray, piece: np.ndarray, *place: np.ndarray) -> None:
        self.places.append((piece + len(self.pieces), *place))
        self.pieces += pieces
        self.least.append(least)
        self.size += sum(map(len, pieces))
        self.rows += len(piece)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(the smallest document of the window at each byte, each piece's first byte, its number of windows)."""
        sizes = np.array([len(p) for p in self.pieces])
        begin = np.cumsum(sizes) - sizes
        count = sizes - self.window + 1
        starts = np.repeat(begin, count) + _counting(count)
        order, classes = deep_shallow(np.frombuffer(b"".join(self.pieces), np.uint8), starts, self.window)
        least = np.concatenate(self.least)[np.searchsorted(begin, order, "right") - 1]
        first = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
        smallest = np.empty(int(sizes.sum()), np.int64)
        smallest[order] = np.minimum.reduceat(least, first)[classes]
        return smallest, begin, count

    def repeats(self) -> Iterator[pa.RecordBatch]:
        """The bytes that a smaller document also holds."""
        if not self.pieces:
            return
        smallest, begin, count = self.windows()
        places = [np.concatenate(x) for x in zip(*self.places)]
        step = 1 << 14
        for lo in range(0, len(places[0]), step):
            piece, doc, key, start = (x[lo:lo + step] for x in places)
            who, at = np.repeat(np.arange(len(piece)), count[piece]), _counting(count[piece])
            gone = np.flatnonzero(smallest[begin[piece][who] + at] < doc[who])
            if not len(gone):
                continue
            who, at = who[gone], at[gone]
            new = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (np.diff(at) > self.window)]))
            last = np.concatenate([new[1:], [len(gone)]]) - 1
            who = who[new]
            yield _spans(doc[who], key[who], start[who] + at[new], start[who] + at[last] + self.window)


def _counting(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one after the other."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _spans(doc: np.ndarray, key: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, key, start, stop)], names=["doc_id", "key", "start", "stop"])


def _pieces(bucket: np.ndarray, piece: pa.Array) -> np.ndarray:
    """Which rows begin another piece than the row before."""
    new = np.ones(len(bucket), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | pc.not_equal(piece.slice(1), piece.slice(0, len(piece) - 1)).to_numpy(zero_copy_only=False)
    return new


class _Least:
    """The smallest document of each piece, batch by batch of rows in the order of bucket, piece and document."""

    def __init__(self):
        self.last: tuple[int, bytes, int] | None = None

    def __call__(self, bucket: np.ndarray, piece: pa.Array, doc: np.ndarray) -> np.ndarray:
        new = _pieces(bucket, piece)
        first = doc[new]
        if self.last and self.last[:2] == (int(bucket[0]), piece[0].as_py()):
            first[0] = self.last[2]
        least = first[np.cumsum(new) - 1]
        self.last = int(bucket[-1]), piece[-1].as_py(), int(least[-1])
        return least


def _numbers(b: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [b.column(n).to_numpy(zero_copy_only=False) for n in names]


def _windows(window: int, piece: pa.Array, doc: np.ndarray, key: np.ndarray, start: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Every window of some pieces, to be compared in a bucket of its own content."""
    step = 1 << 10
    for lo in range(0, len(piece), step):
        held = piece.slice(lo, step).to_pylist()
        sizes = np.array([len(p) for p in held])
        data = b"".join(held)
        count = sizes - window + 1
        who, at = lo + np.repeat(np.arange(len(held)), count), _counting(count)
        begin = np.repeat(np.cumsum(sizes) - sizes, count) + at
        found = _spans(doc[who], key[who], start[who] + at, start[who] + at + window)
        yield pa.RecordBatch.from_arrays(
            [*found.columns, pa.array(signed(rolling(_CODES[np.frombuffer(data, np.uint8)], window)[begin])),
             pa.array([data[x:x + window] for x in begin.tolist()], pa.binary())], names=[*found.schema.names, "bucket", "piece"])


def _first_windows(window: int):
    """The windows of each crowded stretch, of its smallest document only."""
    def run(batches):
        least = _Least()
        for b in batches:
            if b.num_rows:
                bucket, doc, key, start = _numbers(b, "bucket", "doc_id", "key", "start")
                first = least(bucket, b.column("piece"), doc) == doc
                yield from _windows(window, b.column("piece").filter(pa.array(first)), doc[first], key[first], start[first])
    return run


def _sort_buckets(window: int):
    """Buckets come one after the other, their pieces in order, equal pieces by document."""
    def stretches(b, least):
        """Crowded anchors: a piece that a smaller document also holds goes as a whole."""
        bucket, doc, key, start = _numbers(b, "bucket", "doc_id", "key", "start")
        gone = least(bucket, b.column("piece"), doc) < doc
        size = pc.binary_length(b.column("piece")).to_numpy(zero_copy_only=False)
        return _spans(doc[gone], key[gone], start[gone], (start + size)[gone])

    def buckets(b, shard):
        """Whole buckets: a single piece goes as a whole, but for its smallest document; several go to the shard."""
        bucket, doc, key, start = _numbers(b, "bucket", "doc_id", "key", "start")
        new = _pieces(bucket, b.column("piece"))
        piece, first = np.cumsum(new) - 1, np.flatnonzero(new)
        begin = np.flatnonzero(np.concatenate([[True], bucket[first][1:] != bucket[first][:-1]]))
        sizes = np.diff(np.concatenate([begin, [len(first)]]))
        several = np.repeat(sizes > 1, sizes)
        gone = ~several[piece] & (doc[first][piece] < doc)
        size = pc.binary_length(b.column("piece")).to_numpy(zero_copy_only=False)
        if several.any():
            rows = several[piece]
            shard.add(b.column("piece").take(pa.array(first[several])).to_pylist(), doc[first][several], (np.cumsum(several) - 1)[piece[rows]],
                      doc[rows], key[rows], start[rows])
        return _spans(doc[gone], key[gone], start[gone], (start + size)[gone])

    def run(batches):
        shard, least, held = _Shard(window), _Least(), None
        for b in batches:
            alone = b.column("alone")
            if pc.any(alone).as_py():
                yield stretches(b.filter(alone), least)
                b = b.filter(pc.invert(alone))
            if held is not None and held.num_rows:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            if not b.num_rows:
                continue
            bucket = _numbers(b, "bucket")[0]
            cut = int(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))[-1])   # the last bucket may go on
            held = b.slice(cut)
            if cut:
                yield buckets(b.slice(0, cut), shard)
            if shard.size > TEXT or shard.rows > TEXT:
                yield from shard.repeats()
                shard = _Shard(window)
        if held is not None and held.num_rows:
            yield buckets(held, shard)
        yield from shard.repeats()
    return run


def _compare_windows(batches):
    """Of equal windows, all go but those of the smallest document."""
    least = _Least()
    for b in batches:
        if b.num_rows:
            bucket, doc, key, start, stop = _numbers(b, "bucket", "doc_id", "key", "start", "stop")
            gone = least(bucket, b.column("piece"), doc) < doc
            yield _spans(doc[gone], key[gone], start[gone], stop[gone])


def _remove(batches):
    """(doc_id, key, text, places) -> spans, removed bytes, digest of the rest, the rest."""
    for b in batches:
        out = []
        for text, found in zip(b.column(2).cast(pa.large_binary()).to_pylist(), b.column(3)):
            start, stop = found.values.field(0).to_numpy(), found.values.field(1).to_numpy()
            order = np.argsort(start, kind="stable")
            start, stop = start[order], np.maximum.accumulate(stop[order])
            cut = np.flatnonzero(start[1:] > stop[:-1]) + 1
            spans = list(zip(start[np.concatenate([[0], cut])].tolist(), stop[np.concatenate([cut - 1, [len(stop) - 1]])].tolist()))
            edges = [0, *(x for s in spans for x in s), len(text)]
            kept = b"".join(text[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))
            out.append(([{"start": s, "stop": e} for s, e in spans], len(text) - len(kept), hashlib.sha256(kept).hexdigest(), kept))
        kinds = (pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([o[i] for o in out], k) for i, k in enumerate(kinds))],
                                         names=["doc_id", "key", "spans", "n_removed", "kept_sha256", "kept"])


def dedupe_bytes(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans, kept_sha256, spans (start, stop in bytes)
    and kept (the remaining bytes, which need not be UTF-8; null where nothing was removed).

    A byte goes if a string of ``window`` bytes over it also starts in a document with a smaller doc_id, judged on the
    input; matches never cross documents.  A null or empty text has no bytes; a text shorter than the window loses none.
    Rows with the same doc_id count as one document (neither removes from the other); a null doc_id is smaller than all
    others.  Ids are whole numbers (long), or text that reads as one.  Texts may be of any length; other columns,
    whatever their names, are not used.  An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    src = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("key"), text.alias("text"))
    facts = stored(src.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("digest")), "facts")
    # copies of one text: the smallest document stands for all
    first = stored(facts.groupBy("digest").agg(F.min("doc_id").alias("rep")), "copies")
    reps = stored(facts.join(first, "digest").where("doc_id = rep").select("doc_id", "key").distinct(), "reps")
    marks = src.mapInArrow(_mark(window, seed), MARKS)
    by = Window.partitionBy("a")
    shared = stored(marks.withColumn("docs", F.count("*").over(by)).withColumn("all", F.sum("n").over(by)).where("docs > 1")
                    .select("a", "doc_id", (F.col("all") > CROWD).alias("crowded")), "anchors")
    listed = shared.join(reps.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(
        F.collect_set(F.when(~F.col("crowded"), F.col("a"))).alias("some"), F.collect_set(F.when(F.col("crowded"), F.col("a"))).alias("crowded"))
    texts = src.join(stored(listed.join(reps, "doc_id"), "listed"), ["doc_id", "key"])
    pieces = texts.select("doc_id", "key", "text", "some", "crowded").mapInArrow(_cut_out(window, seed), STRETCHES)
    # found stays a plan: both joins of src by (doc_id, key) then use one shuffle of the texts
    dealt = pieces.repartition("bucket")
    repeats = dealt.sortWithinPartitions("bucket", "alone", "piece", "doc_id").mapInArrow(_sort_buckets(window), REPEATS)
    # spark_partition_id keeps the filter above the shuffle, which both uses share
    crowded = dealt.where(F.when(F.spark_partition_id() >= 0, F.col("alone"))).sortWithinPartitions("bucket", "piece", "doc_id") \
        .mapInArrow(_first_windows(window), WINDOWS).repartition("bucket").sortWithinPartitions("bucket", "piece", "doc_id") \
        .mapInArrow(_compare_windows, REPEATS)
    found = repeats.union(crowded) \
        .groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "stop")).alias("places"))
    kind = "doc_id long, key long, spans array<struct<start: long, stop: long>>, n_removed long, kept_sha256 string, kept binary"
    cleaned = src.join(found, ["doc_id", "key"]).dropDuplicates(["doc_id", "key"]).select("doc_id", "key", "text", "places").mapInArrow(_remove, kind)
    copy = (F.col("rep") < F.col("doc_id")) & (F.col("n_bytes") >= window)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    none = F.array().cast("array<struct<start: long, stop: long>>")
    spans = F.when(copy, whole).otherwise(F.coalesce("spans", none))
    return facts.join(first, "digest", "left").join(cleaned, ["doc_id", "key"], "left").select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        spans.alias("spans"), F.when(copy, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"))


def contract(docs: DataFrame) -> DataFrame:
    return dedupe_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
