"""Near-duplicate detection with SuperMinHash signatures.

SuperMinHash gives every element one random permutation of the signature's slots; at level j it offers the value
``j + r`` to the j-th slot of that permutation, so the values of an element are spread over the slots without
replacement (lower variance than independent minima).  A slot filled at level j cannot be improved at a later level, so
a set stops as soon as all its slots are filled: after one level for long texts.  Signatures are cut into bands; equal
bands make candidates; candidates are verified on the full shingle sets; verified links are grouped by union-find.

No pairs are listed inside a bucket.  Every member is first compared with the bucket's smallest member; the links found
are grouped.  Only buckets whose members are then still in different groups go on: there, blocks of members are compared
with each other inside a task (exact intersections by a 0/1 matrix product) and only links between different groups come
out.  Blocks of one and the same group are skipped, so a large group of copies costs nothing; nothing is capped.  What
shares a band is therefore always decided on the full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from llm.textops import LOWER, SPACES, U, Words, lists, mix, rolling, signed, stored, text_slices

SHINGLE = 3
PERCENT = 85
BLOCK = 512                   # members of a bucket that are compared with as many others in one task
BANDS, BAND_ROWS = 24, 5      # a pair at 0.85 shares no band with probability (1 - 0.85^5)^24 < 1e-6

_SALT = U(0xA0761D6478BD642F)
_STEP = U(0xE7037ED1A0B428DB)


def shingles(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) sorted and distinct; a row with fewer than k words has its whole sequence as one shingle."""
    room, count, row = words.room(), words.counts, words.rows()
    at = np.flatnonzero(room >= k)
    h, r = [rolling(words.hash, k)[at] if len(at) else words.hash[:0]], [row[at]]
    for n in range(1, k):   # rows of n words
        at = np.flatnonzero((room == n) & (count[row] == n))
        if len(at):
            h.append(mix(rolling(words.hash, n)[at] + U(n)))
            r.append(row[at])
    h, r = np.concatenate(h), np.concatenate(r)
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(r[order], kind="stable")]
    h, r = h[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return r[new], h[new]


def superminhash(row: np.ndarray, h: np.ndarray, n_rows: int, slots: int) -> np.ndarray:
    """Signatures (n_rows x slots) of the sets given as sorted (row, element); rows without elements stay unfilled."""
    empty = U(0xFFFFFFFFFFFFFFFF)
    sig = np.full(n_rows * slots, empty, np.uint64)
    order = None
    for level in range(slots):
        x = mix(h + U((level + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
        pick = level + (((x & U(0xFFFFFFFF)) * U(slots - level)) >> U(32)).astype(np.int64)
        if level == 0:
            slot = first = pick
        else:
            if order is None:   # the permutations so far, of the elements still needed
                order = np.tile(np.arange(slots, dtype=np.int16), (len(h), 1))
                e = np.arange(len(h))
                order[e, 0], order[e, first] = first, 0
            e = np.arange(len(h))
            slot = order[e, pick]
            order[e, pick] = order[:, level]
            order[:, level] = slot
        np.minimum.at(sig, row * slots + slot, (U(level) << U(32)) | (x >> U(32)))
        unfilled = (sig.reshape(n_rows, slots) == empty).any(1)
        keep = unfilled[row]
        if not keep.any():
            break
        if not keep.all():
            row, h = row[keep], h[keep]
            if order is not None:
                order = order[keep]
            else:
                first = first[keep]
    return sig.reshape(n_rows, slots)


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    n, slots = sig.shape
    parts = sig.reshape(n, bands, slots // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _SALT, (n, bands)).copy()
    for i in range(parts.shape[2]):
        key = mix(key * _STEP + parts[:, :, i])
    return key


def set_keys(row: np.ndarray, h: np.ndarray, n_rows: int) -> np.ndarray:
    """128-bit fingerprint of each row's set, as 16 bytes."""
    out = np.zeros((n_rows, 2), np.uint64)
    np.add.at(out[:, 0], row, mix(h + _SALT))
    np.add.at(out[:, 1], row, mix(h ^ _STEP))
    return out


def _survey(k: int, bands: int, rows: int):
    """Per document: size of its set, the set's fingerprint (null for an empty set), its band keys."""
    def run(batches):
        for b in batches:
            for i, raw, offsets in text_slices(b.column(2)):
                n = len(offsets) - 1
                row, h = shingles(Words(raw, offsets, SPACES, LOWER), k)
                count = np.bincount(row, minlength=n)
                keys = band_keys(superminhash(row, h, n, bands * rows), bands)[count > 0]
                node = set_keys(row, h, n).tobytes()
                nodes = [node[16 * r:16 * r + 16] if count[r] else None for r in range(n)]
                first = np.concatenate([[0], np.cumsum(np.where(count > 0, bands, 0))])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n), b.column(1).slice(i, n), pa.array(count, pa.int64()),
                     pa.array(nodes, pa.binary()), lists(signed(keys.reshape(-1)), first, pa.int64())],
                    names=["doc_id", "key", "n_shingles", "node", "bands"])
    return run


def _sets(k: int):
    def run(batches):
        for b in batches:
            for i, raw, offsets in text_slices(b.column(1)):
                n = len(offsets) - 1
                row, h = shingles(Words(raw, offsets, SPACES, LOWER), k)
                first = np.searchsorted(row, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n), pa.array(np.diff(first), pa.int64()), lists(signed(h), first, pa.int64())],
                    names=["node", "n", "items"])
    return run


def links_between(sets: list[np.ndarray], group: np.ndarray, left: np.ndarray, right: np.ndarray,
                  percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs (one of left, one of right) of different groups whose sets are similar enough, compared exactly."""
    size = np.array([len(x) for x in sets], np.int64)
    who = np.repeat(np.arange(len(sets)), size)
    values, item = np.unique(np.concatenate(sets), return_inverse=True)
    common = (np.bincount(item, minlength=len(values)) > 1)[item]
    who, item = who[common], np.unique(item[common], return_inverse=True)[1]
    at = np.zeros(len(sets), np.int64)
    both = np.zeros((len(left), len(right)), np.int64)
    order = np.argsort(item, kind="stable")
    who, item = who[order], item[order]
    width = 2048
    for lo in range(0, int(item[-1]) + 1 if len(item) else 0, width):
        a, z = np.searchsorted(item, [lo, lo + width])
        part = np.zeros((len(sets), width), np.float32)
        part[who[a:z], item[a:z] - lo] = 1
        both += (part[left] @ part[right].T).astype(np.int64)
    total = size[left][:, None] + size[right][None, :] - both
    hit = (100 * both >= percent * total) & (group[left][:, None] != group[right][None, :])
    i, j = np.nonzero(hit)
    return list(zip(left[i].tolist(), right[j].tolist()))


def _compare_blocks(percent: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        items = t["items"].combine_chunks()
        if isinstance(items, pa.ChunkedArray):
            items = items.chunk(0)
        values, first = items.flatten().to_numpy(), items.offsets.to_numpy()
        first = first - first[0]
        sets = [values[a:z] for a, z in zip(first[:-1], first[1:])]
        names = t["label"].to_pylist()
        code = {x: i for i, x in enumerate(dict.fromkeys(names))}
        group = np.array([code[x] for x in names])
        block = t["block"].to_numpy()
        left, right = (np.flatnonzero(block == t[c][0].as_py()) for c in ("one", "two"))
        found = {(names[i], names[j]) for i, j in links_between(sets, group, left, right, percent)}
        return pa.table({"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([y for _, y in found], pa.binary())})
    return run


def _forest(batches):
    """Union-find over the links of one task: each node with the smallest node of its group."""
    parent: dict[bytes, bytes] = {}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x, y = find(parent.setdefault(x, x) and x), find(parent.setdefault(y, y) and y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    roots = [find(x) for x in nodes]
    moved = [(x, r) for x, r in zip(nodes, roots) if x != r]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in moved], pa.binary()), pa.array([r for _, r in moved], pa.binary())],
                                     names=["node", "label"])


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every linked node but the smallest of its group, label being that smallest node.

    Union-find inside each task first; what the tasks found is then joined by alternating large-star and small-star
    steps until every node hangs on its root.  Links stay distributed; each step is a written table.
    """
    tree = stored(links.select("a", "b").mapInArrow(_forest, "node binary, label binary").distinct(), "forest")
    while not _is_star(tree):
        both = tree.select(F.col("node").alias("u"), F.col("label").alias("v")).union(tree.select("label", "node"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select("v", "m").distinct()                    # node v, smaller m
        least = large.groupBy("v").agg(F.min("m").alias("root"))
        small = large.join(least, "v").select(F.explode(F.array(F.struct(F.col("v").alias("node"), F.col("root").alias("label")),
                                                                F.struct(F.col("m").alias("node"), F.col("root").alias("label")))).alias("e")) \
            .select("e.*").where("node != label").distinct()
        tree = stored(small, "forest")
    return tree


def _is_star(tree: DataFrame) -> bool:
    """Every node has one label, and no label has another."""
    ends = tree.select(F.col("node").alias("x"), F.lit(1).alias("node"), F.lit(0).alias("label")) \
        .union(tree.select("label", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("node").alias("n"), F.max("label").alias("l")) \
        .where("n > 1 or (n > 0 and l > 0)").isEmpty()


def _similar(percent: int, n1: str, n2: str, both: Column) -> Column:
    return 100 * both >= percent * (F.col(n1) + F.col(n2) - both)


def _grouped(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS,
             band_rows: int = BAND_ROWS, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` (doc_id, key: hash of the text, n_shingles, node: hash of the set), and every node with its group:
    node, label, doc (least doc_id), best (its least row: no doc_id last, then doc_id, key)."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text"))
    survey = stored(src.mapInArrow(_survey(shingle, bands, band_rows),
                                   "doc_id long, key long, n_shingles long, node binary, bands array<long>"), "signatures")
    sets_seen = survey.where("n_shingles > 0")
    classes = stored(sets_seen.groupBy("node").agg(
        F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.min(F.struct(F.col("doc_id").alias("d"), F.col("key").alias("k"))).alias("row"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("d"), F.col("key").alias("k"))).alias("best")), "classes")
    member = classes.select("node", F.explode("bands").alias("bucket"))
    bucket = member.groupBy("bucket").agg(F.min("node").alias("center"), F.max("node").alias("other"), F.count("*").alias("m")) \
        .where("center != other").drop("other")
    member = stored(member.join(bucket, "bucket"), "buckets")

    # full sets of the classes that share a bucket
    needed = member.select("node").distinct().join(classes.select("node", "row"), "node") \
        .select("node", F.col("row.d").alias("d"), F.col("row.k").alias("k"))
    full = src.join(needed, F.expr("doc_id <=> d and key = k")).select("node", "text")
    sets = stored(full.mapInArrow(_sets(shingle), "node binary, n long, items array<long>").dropDuplicates(["node"]), "sets")

    size = classes.select("node", "n")
    star = member.where("node != center").select("center", "node").distinct() \
        .join(size.withColumnRenamed("n", "n1"), "node") \
        .join(size.select(F.col("node").alias("center"), F.col("n").alias("n2")), "center") \
        .where(100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2"))
    links = star.join(sets.select("node", F.col("items").alias("x")), "node") \
        .join(sets.select(F.col("node").alias("center"), F.col("items").alias("y")), "center") \
        .withColumn("common", F.size(F.array_intersect("x", "y"))).where(_similar(percent, "n1", "n2", F.col("common"))) \
        .select(F.col("center").alias("a"), F.col("node").alias("b"))
    label = components(links)

    # buckets whose members are still in different groups: block against block
    row = stored(member.where("m > 2").select("bucket", "node").join(label, "node", "left")
                 .select("bucket", "node", F.coalesce("label", "node").alias("label")), "open")
    mixed = row.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m"),
                                      F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who")).where("lo != hi")
    mixed = mixed.groupBy("who", "m").agg(F.min("bucket").alias("bucket")).select("bucket")   # equal buckets once
    row = row.join(mixed, "bucket")
    count = row.groupBy("bucket", "label").agg(F.count("*").alias("c"))
    small = count.groupBy("bucket").agg(F.coalesce(F.sum(F.when(F.col("c") < block, F.col("c"))), F.lit(0)).alias("s"))
    big = F.col("c") >= block
    row = row.join(count.join(small, "bucket"), ["bucket", "label"]).select(
        "bucket", "node", "label", F.when(big, F.col("label")).alias("whole"),
        F.when(big, F.xxhash64("label", F.pmod(F.xxhash64("node"), F.ceil(F.col("c") / block))))
        .otherwise(F.pmod(F.xxhash64("label"), F.ceil(F.col("s") / block))).alias("block"))
    others = row.select("bucket", F.struct("block", "whole").alias("o")).distinct().groupBy("bucket") \
        .agg(F.collect_list("o").alias("others"))
    meet = row.join(others, "bucket").withColumn("o", F.explode("others")) \
        .where("whole is null or o.whole is null or whole != o.whole") \
        .select("bucket", F.least("block", "o.block").alias("one"), F.greatest("block", "o.block").alias("two"),
                "block", "node", "label")
    late = meet.join(sets, "node").groupBy("bucket", "one", "two").applyInArrow(_compare_blocks(percent), "a binary, b binary")
    # written first: a task that compares blocks and groups links would hold two Python workers, which outlive it
    bridge = components(stored(late, "bridges")).select(F.col("node").alias("label"), F.col("label").alias("to"))

    group = label.join(bridge, "label", "left").select("node", F.coalesce("to", "label").alias("label")) \
        .union(bridge.select(F.col("label").alias("node"), F.col("to").alias("label")))
    group = classes.select("node", "doc", "best").join(group, "node", "left") \
        .select("node", F.coalesce("label", "node").alias("label"), "doc", "best")
    return survey, group


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS,
                    band_rows: int = BAND_ROWS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked when their shingle sets are similar by at least ``percent``; component_id is the smallest doc_id
    that links lead to, the document itself included.  A null text, or one without words, has an empty set and is linked
    with nothing.  Rows are documents of their own, also with equal doc_ids; a null doc_id is never the smallest, and such
    a row is kept only if its group has no other id.  Empty input gives an empty result; other columns are not used.
    """
    survey, group = _grouped(docs, shingle, percent, bands, band_rows, block)
    least = group.groupBy("label").agg(F.min("doc").alias("component_id"))
    ids = group.join(least, "label").select("node", "component_id")
    return survey.select("doc_id", "n_shingles", "node").join(ids, "node", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents that stand for their group, in their own columns: those with its least doc_id, or where it has none,
    one row.  Documents without words stay; of rows with equal doc_id and text, one."""
    survey, group = _grouped(docs, **options)
    best = group.groupBy("label").agg(F.min("best").alias("first"))
    stands = survey.where("n_shingles > 0").join(group.join(best, "label").select("node", "first"), "node") \
        .where(F.col("doc_id").eqNullSafe(F.col("first.d")) & (~F.col("first.no_id") | (F.col("key") == F.col("first.k"))))
    kept = stands.select("doc_id", "key").union(survey.where("n_shingles = 0").select("doc_id", "key")).distinct() \
        .toDF("__id", "__key")
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["__id"]) & (F.xxhash64(docs["text"]) == kept["__key"]), "left_semi") \
        .dropDuplicates(["doc_id", "text"])


def contract(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, SHINGLE, PERCENT)
