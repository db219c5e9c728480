"""Conversation structure repair: turns aligned to the role grammar ``(s?(ua)+)?`` at least cost.

The strings of the grammar are suffixes of one another (all but the leading ``s`` end in ...uaua), so one Wagner-Fischer
table over (rows left, characters left) holds the alignment to every feasible length: column k is the target of length
k.  A plain repair gives an incumbent cost, and Ukkonen's band keeps the cells from which that cost can still be met.
Among the lengths of least cost the backtraced audits are compared letter by letter, all at once, and the ASCII-least
stays.  The table is kept at every sqrt(n)-th row and filled in again block by block on the way back.

A conversation is one ordered string, so one task walks through it: the alignment needs three bits and a digest of each
row, and the audit then meets the sorted texts in a second pass, which hashes them one at a time.  No task holds the
texts of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate, groupby
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from llm.textops import stored

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3   # costs; keeping is free
FREE, MUST_GO, CUT_SHORT = 0, 1, 2               # a row without fault, a blank or repeated one, a truncated one
FAR = np.int32(1 << 29)
SPACE = " \t\n\x0b\f\r"

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
FOUND = ", ".join(f"{c} long" for c in COUNTS) + ", audit string"


# --- alignment ----------------------------------------------------------------------------------------------------

def incumbent(initials: str, faults: bytes) -> int:
    """The cost of the best of some plain repairs: rows in turn take u and a; or a missing role is put in before a row."""
    rows = [(c, TRUNCATED * (f == CUT_SHORT)) for c, f in zip(initials, faults) if f != MUST_GO]
    gone = DELETE * (len(initials) - len(rows))

    def in_turn(rows):
        return sum(t + REROLE * (c != "ua"[i % 2]) for i, (c, t) in enumerate(rows)) + INSERT * (len(rows) % 2)

    def filled(rows):
        cost, want = 0, "u"
        for c, t in rows:
            if c in "ua" and c != want:
                cost, want = cost + INSERT, c
            cost += t + REROLE * (c != want)
            want = "a" if want == "u" else "u"
        return cost + INSERT * (want == "a")
    best = min(DELETE * len(rows), in_turn(rows), filled(rows))
    if len(rows) > 1 and rows[0][0] == "s":
        best = min(best, rows[0][1] + min(in_turn(rows[1:]), filled(rows[1:])))
    return gone + best


class Table:
    """Least cost of bringing rows i.. to the last k characters of the target, within the band: ``plain`` cells have no s
    to come, ``led`` cells still wait for their leading s (one of the k)."""

    def __init__(self, initials: str, faults: bytes):
        self.n = n = len(initials)
        self.faults, self.initials = faults, initials
        self.limit = incumbent(initials, faults)
        left = lambda flags: list(accumulate(reversed(flags), initial=0))[::-1]  # noqa: E731  those from row i on
        stay = left([f != MUST_GO for f in faults])
        short = left([f == CUT_SHORT for f in faults])
        spare = self.limit - DELETE * (n - stay[0]) - TRUNCATED * short[0]
        # a longer target costs an insertion a character; a shorter one a deletion a row (1 more where it was truncated)
        self.hi = [r + spare // INSERT for r in stay]
        self.lo = [max(0, r - (spare if spare <= t else t + (spare - t) // DELETE)) for r, t in zip(stay, short)]
        self.block = max(64, isqrt(n))
        end = (self.cells(n, INSERT * np.arange(self.lo[n], self.hi[n] + 1, dtype=np.int32)), np.full(self.hi[n] - self.lo[n] + 1, FAR))
        self.kept = {n: end}
        at = end
        for i in range(n - 1, -1, -1):
            at = self.before(i, *at)
            if i % self.block == 0:
                self.kept[i] = at
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def cells(self, i: int, values: np.ndarray) -> np.ndarray:
        return np.minimum(values, FAR).astype(np.int32)

    def shifted(self, i: int, row: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Cells lo..hi of row i, FAR where it has none."""
        out = np.full(hi - lo + 1, FAR)
        a, b = max(lo, self.lo[i]), min(hi, self.hi[i])
        if a <= b:
            out[a - lo:b - lo + 1] = row[a - self.lo[i]:b - self.lo[i] + 1]
        return out

    def before(self, i: int, plain: np.ndarray, led: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row i from row i + 1."""
        lo, hi, c, fault = self.lo[i], self.hi[i], self.initials[i], self.faults[i]
        k = np.arange(lo, hi + 1, dtype=np.int32)
        out = self.shifted(i + 1, plain, lo, hi) + DELETE
        wait = self.shifted(i + 1, led, lo, hi) + DELETE
        if fault != MUST_GO:
            extra = TRUNCATED * (fault == CUT_SHORT)
            other = np.full(len(k), extra + REROLE, np.int32) if c not in "ua" else extra + REROLE * ((k % 2 == 1) != (c == "a")).astype(np.int32)
            out = np.minimum(out, self.shifted(i + 1, plain, lo - 1, hi - 1) + other)
            if c == "s":
                start = self.shifted(i + 1, plain, lo - 1, hi - 1) + extra
                wait = np.minimum(wait, np.where((k >= 3) & (k % 2 == 1), start, FAR))
        out = np.minimum.accumulate(out - INSERT * k) + INSERT * k
        return self.cells(i, out), self.cells(i, wait)

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i in self.kept:
            return self.kept[i]
        if i not in self.rows:
            above = min(self.n, (i // self.block + 1) * self.block)
            self.rows, at = {}, self.kept[above]
            for j in range(above - 1, i - 1, -1):
                at = self.rows[j] = self.before(j, *at)
        return self.rows[i]

    def at(self, i: int, k: int, waits: bool) -> int:
        if not self.lo[i] <= k <= self.hi[i]:
            return int(FAR)
        return int(self.row(i)[waits][k - self.lo[i]])

    def edits(self, i: int, k: int, waits: bool) -> Iterator[tuple[str, tuple[int, int, bool]]]:
        """The edits of least cost from a cell: (letter, next cell)."""
        now = self.at(i, k, waits)
        if i < self.n:
            if now == DELETE + self.at(i + 1, k, waits):
                yield "D", (i + 1, k, waits)
            if self.faults[i] != MUST_GO:
                extra = TRUNCATED * (self.faults[i] == CUT_SHORT)
                c = self.initials[i]
                if waits:
                    if c == "s" and now == extra + self.at(i + 1, k - 1, False):
                        yield "K", (i + 1, k - 1, False)
                elif k:
                    same = c == ("a" if k % 2 else "u")
                    if now == extra + REROLE * (not same) + self.at(i + 1, k - 1, False):
                        yield "K" if same else "R", (i + 1, k - 1, False)
        if k and not waits and now == INSERT + self.at(i, k - 1, False):
            yield "I", (i, k - 1, False)


def align(initials: str, faults: bytes) -> tuple[int, str]:
    """(least cost, ASCII-least audit of that cost) over all feasible target lengths."""
    if not initials:
        return 0, ""
    table = Table(initials, faults)
    lengths = [(table.at(0, k, waits), (0, k, waits)) for waits in (False, True)
               for k in range(table.lo[0], table.hi[0] + 1) if k % 2 == waits]
    cost = min(c for c, _ in lengths)
    cells, audit = [cell for c, cell in lengths if c == cost], []
    while True:   # cells reached by one and the same audit so far: they differ in k alone
        steps = [step for cell in cells for step in table.edits(*cell)]
        if not steps:
            return cost, "".join(audit)
        letter = min(s[0] for s in steps)
        audit.append(letter)
        cells = [cell for s, cell in steps if s == letter]


# --- over a table -------------------------------------------------------------------------------------------------

def _conversations(batches) -> Iterator[tuple]:
    """Rows as tuples with True where a conversation begins; the batches are sorted by it."""
    before = ()
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            yield before != row[:1], row
            before = row[:1]


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _examine(kind: pa.DataType, rows_per_batch: int = 1000):
    """Pass 1: counts, cost and audit of each conversation, from rows (conversation, absent, turn, role, text)."""
    def result(key, initials, faults, turns, duplicates, blanks):
        cost, audit = align("".join(initials), bytes(faults))
        legal = {"su", "ua", "au"}
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        illegal = sum(a + b not in legal for a, b in zip(initials, initials[1:]))
        return key, gaps, blanks, duplicates, faults.count(CUT_SHORT), illegal, cost, audit

    def run(batches):
        out, state, key = [], None, None

        def batch():
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:-1]), pa.array(columns[-1], pa.string())],
                names=["conv", *COUNTS, "audit"])
        for new, (conv, absent, turn, role, text) in _conversations(batches):
            if new:
                if state is not None:
                    out.append(result(key, *state))
                    if len(out) >= rows_per_batch:
                        yield batch()
                        out = []
                key, state, seen = conv, [[], bytearray(), None, 0, 0], set()
            if absent:
                continue
            if turn is not None:
                first, last, distinct = state[2] or (turn, None, 0)
                state[2] = (first, turn, distinct + (turn != last))
            # what is no grammar character is one that no pair and no target has
            state[0].append(role[:1] if role[:1] in ("s", "u", "a") else "x")
            mark, bare = _digest(role, text), text.rstrip(SPACE)
            if not bare:
                state[4] += 1
                state[1].append(MUST_GO)
            elif mark in seen:
                state[3] += 1
                state[1].append(MUST_GO)
            else:
                state[1].append(FREE if bare[-1] in ".!?" else CUT_SHORT)
            seen.add(mark)
        if state is not None:
            out.append(result(key, *state))
        if out:
            yield batch()
    return run


def replay(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each repaired row, by the audit over the rows as they come."""
    rows, said = iter(rows), ""
    for edit in audit:
        if edit == "I":
            role, text = "", ""
        else:
            role, text = next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if said == "u" else "user"
        said = role[:1]
        yield edit, role, text


def _hash_all(kind: pa.DataType, given: list[str]):
    """Pass 2: each conversation's first row brings what pass 1 found, the others their texts in the same order."""
    def run(batches):
        rows = (row for _, row in _conversations(batches))
        out = []
        for conv, own in groupby(rows, key=lambda r: (r[0] is None, r[0])):
            head = next(own)
            sha, first = hashlib.sha256(), True
            for _, role, text in replay(head[2]["audit"], ((r[4], r[5]) for r in own)):
                sha.update(("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                first = False
            out.append((conv[1], *(head[2][c] for c in COUNTS), head[2]["audit"], sha.hexdigest()))
            if len(out) >= 1000:
                yield _batch(out, kind, given)
                out = []
        if out:
            yield _batch(out, kind, given)
    return run


def _batch(out, kind, names):
    columns = list(zip(*out))
    kinds = [kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _turns(kind: pa.DataType):
    """Pass 2, for the repaired rows themselves."""
    def run(batches):
        rows = (row for _, row in _conversations(batches))
        out, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), (kind, pa.int64(), pa.string(), pa.string(), pa.string()))],
                names=["conv_id", "place", "role", "text", "edit"])
        for conv, own in groupby(rows, key=lambda r: (r[0] is None, r[0])):
            head = next(own)
            for place, (edit, role, text) in enumerate(replay(head[2]["audit"], ((r[4], r[5]) for r in own))):
                out.append((conv[1], place, role, text, edit))
                held += len(text) + 64
                if held > 1 << 22:
                    yield batch()
                    out, held = [], 0
        if out:
            yield batch()
    return run


def _rows(turns: DataFrame) -> DataFrame:
    """(conv, absent, turn, role, text): nulls in role and text are one space; a turn that is no whole number is null."""
    absent = F.coalesce(F.col("absent").cast("boolean"), F.lit(False)) if "absent" in turns.columns else F.lit(False)
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return turns.select(F.col("conv_id").alias("conv"), absent.alias("absent"), F.col("turn").try_cast("long").alias("turn"),
                        said("role").alias("role"), said("text").alias("text"))


def _arrow_kind(spark_type: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(spark_type)


def examine(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv, the counts, cost and audit."""
    rows = _rows(turns)
    kind = rows.schema["conv"]
    schema = T.StructType([kind, *T.StructType.fromDDL(FOUND).fields])
    ordered = rows.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.mapInArrow(_examine(_arrow_kind(kind.dataType)), schema)


def _headed(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The present rows in order, before each conversation's rows one with what was found of it."""
    rows = _rows(turns).where("NOT absent")
    head = F.struct(*COUNTS, "audit")
    both = found.select("conv", F.lit(0).alias("kind"), head.alias("head"), F.lit(None).cast("long").alias("turn"),
                        F.lit("").alias("role"), F.lit("").alias("text")) \
        .unionByName(rows.select("conv", F.lit(1).alias("kind"), F.lit(None).cast(found.select(head).schema[0].dataType).alias("head"),
                                 "turn", "role", "text"))
    return both.repartition("conv").sortWithinPartitions("conv", "kind", F.col("turn").asc_nulls_first(), "role", "text")


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256.

    A conversation's rows are taken by turn, nulls first, then role, then text; rows of null conv_id form one
    conversation.  Null role or text counts as one space, so a null text is blank.  Repeated rows are duplicates (each but
    the first).  A row whose optional column ``absent`` is true takes no part, but its conversation gets its row (zeros, an
    empty audit and the hash of nothing if all are absent).  Texts may be of any length; other columns, whatever their
    names, are not used.  An empty table gives an empty result.
    """
    found = stored(examine(turns), "audits")
    kind = found.schema["conv"]
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    schema = T.StructType([T.StructField("conv_id", kind.dataType), *T.StructType.fromDDL(FOUND + ", repaired_sha256 string").fields])
    return _headed(turns, found).mapInArrow(_hash_all(_arrow_kind(kind.dataType), names), schema)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations themselves: conv_id, place (from 0), role, text, edit (K, R or I); rows as in ``repair``."""
    found = stored(examine(turns), "audits")
    kind = found.schema["conv"]
    schema = T.StructType([T.StructField("conv_id", kind.dataType),
                           *T.StructType.fromDDL("place long, role string, text string, edit string").fields])
    return _headed(turns, found).mapInArrow(_turns(_arrow_kind(kind.dataType)), schema)


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage by crc32(conv_id:turn) % 20: 0 drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3
    repeats it, 4 sets its role to user; nulls are one space.  Dropped rows stay, marked ``absent``."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind: Column = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    role = F.when(kind == 4, "user").otherwise(said("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("absent"),
                                F.explode(copies).alias("copy")).drop("copy")


def contract(conversations: DataFrame) -> DataFrame:
    return repair(damage(conversations))
