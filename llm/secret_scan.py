"""Secret scans: fixed patterns, and random strings told from ordinary identifiers by character Markov models.

Two first-order character models are trained on labelled samples from the texts themselves: what the patterns find
(``random``, together with random strings over the usual alphabets of keys) and all other characters of the corpus
(``ordinary``).  Both use shares of the counts only, so a corpus of any size gives the same model.  A stretch of 16 or more characters becomes a
span if the log-likelihood ratio of its characters, random against ordinary, is high in sum and per character.  Training counts
character pairs (one small table per batch, summed by Spark); scoring is a lookup and a
running sum over the bytes.

Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.textops import LOWER, annotate, named, scratch_name, text_slices

KINDS = ("assign", "access", "hex", "markov")
# fixed patterns and lengths
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")   # every assign match holds one of these

TOKEN_LENGTH = 16       # characters of a token that is scored
LEAST_SUM, LEAST_MEAN = 12.0, 0.75   # log-likelihood ratio (nats) of a token, and per character pair
UNSEEN = 0.05           # share of a pair's estimate that does not depend on its first character
FOLDED = 0.2            # share of an ordinary pair's estimate that comes from the same pair in either case
UNKNOWN = 0.1           # share of the uniform distribution in the frequency of an ordinary character

_ALPHABET = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
STATES = len(_ALPHABET)
_CODE = np.full(256, -1, np.int64)
_CODE[list(_ALPHABET)] = np.arange(STATES)
_LETTERS, _CAPITALS, _DIGITS = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
KEY_ALPHABETS = (_DIGITS + b"abcdef", _LETTERS + _DIGITS, _CAPITALS + _DIGITS, _LETTERS + _CAPITALS + _DIGITS,
                 _LETTERS + _CAPITALS + _DIGITS + b"+/", _LETTERS + _CAPITALS + _DIGITS + b"-_")
_JOINER = np.isin(np.arange(STATES), _CODE[list(b"+/_=-")])
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True


def runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of the maximal runs of at least ``least`` true bytes that do not cross a row."""
    cut = np.zeros(len(inside) + 1, bool)
    cut[offsets] = True
    edge = np.zeros(len(inside) + 2, bool)
    edge[1:-1] = inside
    start = np.flatnonzero(inside & (~edge[:-2] | cut[:-1]))
    end = np.flatnonzero(inside & (~edge[2:] | cut[1:])) + 1
    long = end - start >= least
    return start[long], end[long]


def base_spans(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, start, kind, end, start of the secret itself) in bytes of the slice, by row, start and kind."""
    found = []
    data, low = raw.tobytes(), LOWER[raw].tobytes()
    rows = set()
    for word in KEYWORDS:
        at = low.find(word)
        while at >= 0:
            r = int(np.searchsorted(offsets, at, "right")) - 1
            rows.add(r)
            at = low.find(word, max(at + 1, int(offsets[r + 1]) - len(word)))
    for r in rows:
        lo, hi = int(offsets[r]), int(offsets[r + 1])
        found += [(r, lo + m.start(), 0, lo + m.end(), lo + m.start(2)) for m in ASSIGN.finditer(data[lo:hi])
                  if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    at, rows = data.find(b"AKIA"), set()
    while at >= 0:
        r = int(np.searchsorted(offsets, at, "right")) - 1
        rows.add(r)
        at = data.find(b"AKIA", max(at + 1, int(offsets[r + 1]) - 4))
    for r in rows:
        lo, hi = int(offsets[r]), int(offsets[r + 1])
        found += [(r, lo + m.start(), 1, lo + m.end(), lo + m.start()) for m in ACCESS.finditer(data[lo:hi])
                  if m.end() - m.start() >= ACCESS_LENGTH]
    s, e = runs(_HEX[raw], offsets, HEX_LENGTH)
    owner = np.searchsorted(offsets, s, "right") - 1
    found += [(int(r), int(a), 2, int(b), int(a)) for r, a, b in zip(owner, s, e)]
    return sorted(found)


def _pairs(code: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte, the pair it makes with the one before it in its row (-1: none)."""
    pair = np.full(len(code), -1, np.int64)
    both = (code[1:] >= 0) & (code[:-1] >= 0)
    pair[1:][both] = code[:-1][both] * STATES + code[1:][both]
    pair[offsets[:-1][offsets[:-1] < len(code)]] = -1
    return pair


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-likelihood ratio (random against ordinary) of each pair of characters.

    Random strings over the key alphabets speak for secrets also where the table holds no labelled one.  A table without
    ordinary characters has no ordinary model: nothing is scored as random there.
    """
    def count(batches):
        for b in batches:
            total = np.zeros((2, STATES * STATES), np.int64)
            for _, raw, offsets in text_slices(b.column(0)):
                pair = _pairs(_CODE[raw], offsets)
                total[0] += np.bincount(pair[pair >= 0], minlength=STATES * STATES)
                secret = np.zeros(len(raw) + 1, np.int64)
                for _, _, _, end, inner in base_spans(raw, offsets):
                    if end > inner + 1:   # the pairs inside it
                        secret[inner + 1] += 1
                        secret[end] -= 1
                own = pair[(np.cumsum(secret[:-1]) > 0) & (pair >= 0)]
                total[1] += np.bincount(own, minlength=STATES * STATES)
            total[0] -= total[1]
            kind, at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(at, pa.int32()), pa.array(total[kind, at])],
                                             names=["kind", "pair", "n"])
    rows = docs.select(text_col).mapInArrow(count, "kind int, pair int, n long") \
        .groupBy("kind", "pair").agg(F.sum("n").alias("n")).toArrow()   # at most 2 * STATES**2 rows
    n = np.zeros((2, STATES * STATES))
    n[rows["kind"].to_numpy(), rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return ratios(n.reshape(2, STATES, STATES))


def _given(n: np.ndarray, unseen: np.ndarray) -> np.ndarray:
    """Share of each second character among the pairs of its row; ``unseen`` for a row without pairs."""
    row = n.sum(1, keepdims=True)
    return np.divide(n, row, out=np.broadcast_to(unseen, n.shape).copy(), where=row > 0)


def ratios(n: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each pair from the counts of the ordinary and of the labelled pairs (2 x STATES x STATES).

    The labelled pairs weigh as much as the random strings over each of the ``KEY_ALPHABETS``, whose pairs are all
    equally frequent.  Multiplying the counts changes nothing.  A joiner (+ / _ = -) never speaks for a random string.
    """
    if not n[0].any():
        return np.full((STATES, STATES), -1.0)
    labelled = [n[1] / n[1].sum()] if n[1].any() else []
    for alphabet in KEY_ALPHABETS:
        member = np.isin(np.arange(STATES), _CODE[list(alphabet)]) / len(alphabet)
        labelled.append(np.outer(member, member))
    even = np.full(STATES, 1 / STATES)
    random = (1 - UNSEEN) * _given(np.mean(labelled, 0), even) + UNSEEN * even

    single = n[0].sum(0)
    single = (1 - UNKNOWN) * single / max(1, single.sum()) + UNKNOWN * even
    case = np.repeat([0, 1, 2], [26, 26, STATES - 52])   # small, capital, neither
    fold = np.arange(STATES) - 26 * (case == 1)
    both = np.zeros((STATES, STATES))
    np.add.at(both, (fold[:, None], fold[None, :]), n[0])
    both = both[fold][:, fold]   # each letter pair stands for its case; behind another character, half for each
    both[(case[:, None] != case) & (case[:, None] < 2) & (case < 2)] = 0
    both[52:, :52] /= 2
    ordinary = (1 - UNSEEN - FOLDED) * _given(n[0], single) + FOLDED * _given(both, single) + UNSEEN * single
    out = np.log(random) - np.log(ordinary)
    joined = _JOINER[:, None] | _JOINER
    out[joined] = np.minimum(out[joined], 0)
    return out


def _stretches(gain: list[float]) -> list[tuple[int, int]]:
    """[start, end) of the pairs between a low and the next high of the running sum of ``gain`` above ``LEAST_MEAN``.

    A stretch ends at its high where the sum falls to its low again, or by ``LEAST_SUM``: so what joins two secrets
    does not count against either.
    """
    out, at = [], 0
    while at < len(gain):
        total = high = 0.0
        start = end = at
        for i in range(at, len(gain)):
            total += gain[i] - LEAST_MEAN
            if total > high:
                high, end = total, i + 1
            elif high > 0 and (total <= 0 or total < high - LEAST_SUM):
                break
            elif total <= 0:
                total, start = 0.0, i + 1
        if high <= 0:
            break
        out.append((start, end))
        at = end
    return out


def markov_spans(raw: np.ndarray, offsets: np.ndarray, ratio: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Every stretch that scores as random, out to the next joiner (+ / _ = -) or the end of the run on both sides.

    An ordinary word between joiners that a stretch only begins or ends in is not part of the span.
    """
    code = _CODE[raw]
    s, e = runs(code >= 0, offsets, TOKEN_LENGTH)
    if not len(s):
        return []
    pair = _pairs(code, offsets)
    gain = np.where(pair >= 0, ratio.reshape(-1)[np.maximum(pair, 0)], 0.0)
    total, upward = np.cumsum(gain), np.cumsum(np.maximum(gain, 0))

    def random(a, b):
        score = total[b - 1] - total[a]
        return b - a >= TOKEN_LENGTH and score >= LEAST_SUM and score >= LEAST_MEAN * (b - a - 1)

    def ordinary(a, b):
        return b - a > 1 and total[b - 1] < total[a]

    found = []
    open_ = upward[e - 1] - upward[s] >= LEAST_SUM - 1e-6   # no stretch of the others can reach the sum
    for lo, hi in zip(s[open_].tolist(), e[open_].tolist()):
        joiner = [lo - 1, *(np.flatnonzero(_JOINER[code[lo:hi]]) + lo).tolist(), hi]
        done = lo
        for i, j in _stretches(gain[lo + 1:hi].tolist()):
            a, b = max(lo + i, done), lo + j + 1
            if b <= a:
                continue
            first, last = bisect_right(joiner, a) - 1, bisect_left(joiner, b)
            while last - first > 1 and ordinary(joiner[last - 1] + 1, joiner[last]):
                last -= 1
            while last - first > 1 and ordinary(joiner[first] + 1, joiner[first + 1]):
                first += 1
            left, right = max(done, joiner[first] + 1), joiner[last]
            if random(max(a, left), min(b, right)) or random(left, right):
                found.append((left, right))
                done = right
        if done == lo and random(lo, hi):
            found.append((lo, hi))
    owner = np.searchsorted(offsets, [a for a, _ in found], "right") - 1
    return [(int(r), a, 3, b, a) for r, (a, b) in zip(owner, found)]


def find_spans(raw: np.ndarray, offsets: np.ndarray, ratio: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Per row, (start, kind, end) in code points, by start and kind.  A scored stretch wholly under patterns' spans is not told again."""
    base = base_spans(raw, offsets)
    taken = np.zeros(len(raw) + 1, np.int64)
    for _, s, _, e, _ in base:
        taken[s] += 1
        taken[e] -= 1
    taken = np.concatenate([[0], np.cumsum(np.cumsum(taken[:-1]) > 0)])
    more = [x for x in markov_spans(raw, offsets, ratio) if taken[x[3]] - taken[x[1]] < x[3] - x[1]]
    out: list[list] = [[] for _ in range(len(offsets) - 1)]
    if not base and not more:
        return out
    point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    for r, s, k, e, _ in sorted(base + more):
        zero = point[offsets[r]]
        out[r].append((int(point[s] - zero), k, int(point[e] - zero)))
    return out


def _masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    parts, at = [], 0
    for s, _, e in spans:
        if e <= at:
            continue
        if s >= at:
            parts += [text[at:s], mask]
        at = e
    return "".join(parts) + text[at:]


SPANS = "spans array<struct<kind: string, start: long, end: long>>"


def find_secrets(docs: DataFrame, ratio: np.ndarray, into: str = "secrets", mask: str | None = None) -> DataFrame:
    """``docs`` plus a struct: the spans, and with a ``mask`` the text with every span replaced (null: no span).

    A null or empty text has no spans; repeated rows are scanned each; an empty table gives an empty result.  Spans of
    different kinds may overlap (a hexadecimal value inside an assignment); the mask covers their union once.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def fn(b: pa.RecordBatch) -> pa.StructArray:
        spans, masked = [], []
        for _, raw, offsets in text_slices(b.column("text")):
            for r, found in enumerate(find_spans(raw, offsets, ratio)):
                spans.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found])
                if mask is not None:
                    text = raw[offsets[r]:offsets[r + 1]].tobytes().decode() if found else None
                    masked.append(_masked(text, found, mask) if found else None)
        columns, names = [pa.array(spans, span)], ["spans"]
        if mask is not None:
            columns, names = columns + [pa.array(masked, pa.string())], names + ["masked"]
        return pa.StructArray.from_arrays(columns, names=names)
    return annotate(docs, fn, into, SPANS + (", masked string" if mask is not None else ""))


def mask_secrets(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by the mask, and ``n_chars`` to match; no document is dropped."""
    into = scratch_name(docs, "secrets_")
    out = find_secrets(docs, train(docs), into=into, mask=mask)
    hit = F.col(f"{into}.masked").isNotNull()
    out = out.withColumn("text", F.coalesce(f"{into}.masked", "text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*named(docs.columns))


def contract(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    spans = F.col("secrets.spans")
    told = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    n = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
    return find_secrets(docs, train(docs)).select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(told(F.filter(spans, lambda x: x["kind"] != "markov")), 256).alias("base_sha256"), told(spans).alias("spans"))
