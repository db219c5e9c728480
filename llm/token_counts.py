"""Token counts under a unigram vocabulary, by dynamic programming shared over a trie of pre-tokens.

A pre-token is a word (``[^\\x20\\x09-\\x0D]+``) with the word mark in front.  Its segmentation is the path of pieces with
the largest sum of log-probabilities (ties: fewer pieces); a character without a piece costs its UTF-8 bytes at
``byte_score`` each.  The distinct pre-tokens of a few MB of text are inserted in a trie; level by level, the forward
scores of all its nodes are computed at once, each prefix once, and each terminal node stores its count of pieces.

The pieces are read from a SentencePiece model file on the driver and shipped to the tasks; their number is that of the
file, not of the data.  The file is a BPE model: what it stores beside a piece is the place of its merge, no probability.
``unigram_vocabulary`` therefore estimates the log-probabilities on the table: the distinct pre-tokens of all documents
are counted, segmented once under a start that falls with the place (1 / (place + 2)), and the pieces on the best paths
are counted, one added to each.  The pieces themselves stay as they are: no tokenizer is trained.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.textops import SPACES, Words, annotate, struct, text_slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
SHARD_BYTES = 8 << 20    # text under one trie
TRIE_WORDS = 1 << 17     # distinct pre-tokens under one trie where they come without a text
LEVELS = 64              # longer pre-tokens are few and walked one by one, with the same result
_CHAR = 21               # bits of a code point


class Vocabulary:
    """Pieces with their scores, and their trie: ``keys`` (state and code point) in order, the state each leads to, the
    piece that ends in a state (-1: none)."""

    def __init__(self, scores: dict[str, float], byte_score: float | None = None):
        self.scores = {p: s for p, s in scores.items() if p}
        self.longest = max(map(len, self.scores), default=1)
        self.byte_score = min(self.scores.values(), default=0.0) - 10.0 if byte_score is None else byte_score
        self.pieces = list(self.scores)
        self.score = np.array([self.scores[p] for p in self.pieces], float)
        states, ends = {}, [-1]
        for k, piece in enumerate(self.pieces):
            at = 0
            for c in piece:
                key = at << _CHAR | ord(c)
                if key not in states:
                    states[key] = len(ends)
                    ends.append(-1)
                at = states[key]
            ends[at] = k
        self.keys = np.array(sorted(states), np.int64)
        self.leads = np.array([states[k] for k in self.keys.tolist()], np.int64)
        self.ends = np.array(ends, np.int64)

    @classmethod
    def from_model(cls, path: str = MODEL) -> "Vocabulary":
        """The pieces of a model file with the scores stored there."""
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return cls({sp.IdToPiece(i): sp.GetScore(i) for i in range(sp.GetPieceSize())
                    if not (sp.IsControl(i) or sp.IsUnknown(i) or sp.IsByte(i))})

    def by_place(self) -> "Vocabulary":
        """The same pieces, the k-th best with a probability that falls as 1 / (k + 2)."""
        order = sorted(self.pieces, key=lambda p: (-self.scores[p], p))
        return Vocabulary({p: -math.log(k + 2) for k, p in enumerate(order)})

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The state behind each character (-1: no piece goes on so)."""
        if not len(self.keys):
            return np.full(len(state), -1, np.int64)
        key = state << _CHAR | char
        slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[slot] == key, self.leads[slot], -1)


def _walk(word: str, vocabulary: Vocabulary) -> tuple[int, list[tuple[str | None, int]]]:
    """Pieces of one pre-token and its best path: (piece, 1), or (None, bytes) where a character has no piece."""
    get, longest, byte = vocabulary.scores.get, vocabulary.longest, vocabulary.byte_score
    best, pieces, back = [0.0], [0], [0]
    for j in range(1, len(word) + 1):
        size = len(word[j - 1].encode())
        top, count, start = best[j - 1] + size * byte, pieces[j - 1] + size, -1
        for i in range(max(0, j - longest), j):
            s = get(word[i:j])
            if s is not None:
                v = best[i] + s
                if v > top or (v == top and pieces[i] < count - 1):
                    top, count, start = v, pieces[i] + 1, i
        best.append(top)
        pieces.append(count)
        back.append(start)
    path, j = [], len(word)
    while j:
        path.append((None, len(word[j - 1].encode())) if back[j] < 0 else (word[back[j]:j], 1))
        j = j - 1 if back[j] < 0 else back[j]
    return pieces[-1], path


class Trie:
    """The trie of some distinct pre-tokens in order, with the forward score of every node.

    ``nodes[d][w]`` is the node of depth d that word w passes; ``pieces[d]`` has a value per node of that depth, ``piece[d]``
    and ``back[d]`` the last piece on its best path (-1: bytes) and the depth before that piece.
    """

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        size = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        first = np.cumsum(size) - size
        n, depth = len(words), int(size.max(initial=0))
        self.size, self.nodes, self.pieces, self.piece, self.back, self.char = size, [np.zeros(n, np.int64)], [np.zeros(1, np.int64)], [None], [None], [None]
        best, live = [np.zeros(1)], (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(2, np.int64))
        alike = np.ones(n, bool)      # the word before has the same prefix so far
        alike[:1] = False
        for d in range(1, depth + 1):
            here = np.flatnonzero(size >= d)
            char = np.zeros(n, np.int64)
            char[here] = codes[first[here] + d - 1]
            alike[1:] &= (char[1:] == char[:-1]) & (size[:-1] >= d)
            new = here[~alike[here]]                   # the first word of every node
            node = np.full(n, -1, np.int64)
            node[here] = np.cumsum(~alike[here]) - 1
            parent, c = self.nodes[d - 1][new], char[new]
            starts, states, edge = live
            count = np.diff(edge)[parent] + 1          # what is under way at the parent, and a piece that begins here
            owner = np.repeat(np.arange(len(new)), count)
            rank = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            old = rank + 1 < count[owner]
            take = np.where(old, edge[parent][owner] + rank, 0)
            start = np.where(old, starts[take], d - 1) if len(starts) else np.full(len(owner), d - 1)
            state = vocabulary.step(np.where(old, states[take], 0) if len(states) else np.zeros(len(owner), np.int64), c[owner])
            go = state >= 0
            owner, start, state = owner[go], start[go], state[go]
            live = start, state, np.searchsorted(owner, np.arange(len(new) + 1))
            width = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
            top = best[d - 1][parent] + width * vocabulary.byte_score
            least, piece, back = self.pieces[d - 1][parent] + width, np.full(len(new), -1, np.int64), np.full(len(new), d - 1)
            done = np.flatnonzero(vocabulary.ends[state] >= 0)
            for s in np.unique(start[done]):           # at most as many as the longest piece has characters
                k = done[start[done] == s]
                o, e = owner[k], vocabulary.ends[state[k]]
                above = self.nodes[s][new[o]]
                value, number = best[s][above] + vocabulary.score[e], self.pieces[s][above] + 1
                wins = (value > top[o]) | ((value == top[o]) & (number < least[o]))
                o = o[wins]
                top[o], least[o], piece[o], back[o] = value[wins], number[wins], e[wins], s
            best.append(top)
            self.nodes.append(node)
            self.pieces.append(least)
            self.piece.append(piece)
            self.back.append(back)
            self.char.append((width, new))

    def counts(self) -> np.ndarray:
        """Pieces of every word, as stored at its terminal node."""
        out = np.zeros(len(self.size), np.int64)
        for d, (node, pieces) in enumerate(zip(self.nodes, self.pieces)):
            ends = self.size == d
            out[ends] = pieces[node[ends]]
        return out

    def usage(self, times: np.ndarray, pieces: int) -> np.ndarray:
        """How often each piece is on the best paths of words that occur ``times`` (last: bytes without a piece)."""
        out = np.zeros(pieces + 1, np.int64)
        flow = [np.zeros(len(p), np.int64) for p in self.pieces]
        for d in range(len(flow)):
            ends = self.size == d
            np.add.at(flow[d], self.nodes[d][ends], times[ends])
        for d in range(len(flow) - 1, 0, -1):
            width, new = self.char[d]
            raw = self.piece[d] < 0
            np.add.at(out, np.where(raw, pieces, self.piece[d]), flow[d] * np.where(raw, width, 1))
            for s in np.unique(self.back[d]):
                k = self.back[d] == s
                np.add.at(flow[s], self.nodes[s][new[k]], flow[d][k])
        return out


def trie_counts(pretokens: list[str], vocabulary: Vocabulary) -> list[int]:
    """Pieces of each pre-token; ``pretokens`` sorted, equal ones allowed."""
    short = [k for k, w in enumerate(pretokens) if len(w) <= LEVELS]
    out = [0] * len(pretokens)
    for k, n in zip(short, Trie([pretokens[k] for k in short], vocabulary).counts().tolist()):
        out[k] = n
    last, n = None, 0
    for k, w in enumerate(pretokens):
        if len(w) > LEVELS:
            if w != last:
                last, n = w, _walk(w, vocabulary)[0]
            out[k] = n
    return out


def piece_usage(pretokens: list[str], times: list[int], vocabulary: Vocabulary) -> np.ndarray:
    """How often each piece (last: a byte without a piece) is used by sorted pre-tokens that occur ``times``."""
    short = [k for k, w in enumerate(pretokens) if len(w) <= LEVELS]
    out = Trie([pretokens[k] for k in short], vocabulary).usage(np.array([times[k] for k in short], np.int64), len(vocabulary.pieces))
    number = None
    for w, n in zip(pretokens, times):
        if len(w) > LEVELS:
            number = number or {p: k for k, p in enumerate(vocabulary.pieces)}
            for piece, size in _walk(w, vocabulary)[1]:
                out[-1 if piece is None else number[piece]] += n * size
    return out


def _distinct(raw: np.ndarray, w: Words) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct pre-tokens of a slice in order, how often each occurs, and the place of each word's among them."""
    _, first, which, times = np.unique(w.hash, return_index=True, return_inverse=True, return_counts=True)
    data = raw.tobytes()
    words = [MARK + data[s:e].decode() for s, e in zip(w.start[first].tolist(), w.end[first].tolist())]
    order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    return [words[k] for k in order.tolist()], times[order], place[which]


def unigram_vocabulary(docs: DataFrame, pieces: Vocabulary, text_col: str = "text") -> Vocabulary:
    """``pieces`` with log-probabilities: (uses + 1) / (all uses + pieces) on the best paths of all words of ``docs``.

    Words are counted over the whole table and segmented once each under ``pieces.by_place()``.  What comes to the driver
    is a number per piece.  Bytes without a piece share their uses over the 256 byte values.  A table without words gives
    all pieces the same score.
    """
    start = pieces.by_place()

    def words(batches):
        for b in batches:
            for _, raw, offsets in text_slices(b.column(0), SHARD_BYTES):
                found, times, _ = _distinct(raw, Words(raw, offsets, SPACES))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(times, pa.int64())], names=["word", "n"])

    def usage(batches):
        total = np.zeros(len(start.pieces) + 1, np.int64)
        held: list[tuple[str, int]] = []
        for b in batches:
            held += zip(b.column(0).to_pylist(), b.column(1).to_pylist())
            if len(held) >= TRIE_WORDS:
                held.sort()
                total += piece_usage([w for w, _ in held], [n for _, n in held], start)
                held = []
        held.sort()
        total += piece_usage([w for w, _ in held], [n for _, n in held], start)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["piece", "uses"])

    # a stated number of partitions: small as they are in bytes, the words are dear to segment
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = docs.select(text_col).mapInArrow(words, "word string, n long").repartition(parts, "word") \
        .groupBy("word").agg(F.sum("n").alias("n"))
    rows = counted.mapInArrow(usage, "piece long, uses long").groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
    uses = np.zeros(len(start.pieces) + 1)
    for r in rows:
        uses[r.piece] = r.uses
    whole = math.log(uses.sum() + len(uses) + 255)
    score = np.log(uses + 1) - whole
    return Vocabulary(dict(zip(start.pieces, score[:-1].tolist())), math.log(uses[-1] / 256 + 1) - whole)


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", into: str = "tokens") -> DataFrame:
    """``docs`` plus a struct (n_words, n_tokens).

    A null or empty text has no words and no tokens; repeated rows are counted each; a word of any length is counted
    whole; an empty table gives an empty result; a column named like ``into`` is replaced.
    """
    def fn(b: pa.RecordBatch) -> pa.StructArray:
        n_words, n_tokens = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
        for i, raw, offsets in text_slices(b.column(text_col), SHARD_BYTES):
            w = Words(raw, offsets, SPACES)
            found, _, place = _distinct(raw, w)
            count = np.array(trie_counts(found, vocabulary), np.int64)
            rows = slice(i, i + len(offsets) - 1)
            n_words[rows] = w.counts
            n_tokens[rows] = np.bincount(w.rows(), count[place], minlength=len(offsets) - 1).astype(np.int64)
        return struct(n_words=pa.array(n_words), n_tokens=pa.array(n_tokens))
    return annotate(docs, fn, into, "n_words long, n_tokens long")


def contract(docs: DataFrame, model: str = MODEL) -> DataFrame:
    docs = docs.select("doc_id", "text")
    vocabulary = unigram_vocabulary(docs, Vocabulary.from_model(model))
    return count_tokens(docs, vocabulary).select("doc_id", "tokens.n_words", "tokens.n_tokens")
