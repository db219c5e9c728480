import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs_of  # noqa: F401
from llm import token_counts as M
from llm.textops import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(word, v):
    """(score, -pieces) of the best path, by trying every piece at every place."""
    best = [(0.0, 0)] + [None] * len(word)
    for j in range(1, len(word) + 1):
        size = len(word[j - 1].encode())
        options = [(best[j - 1][0] + size * v.byte_score, best[j - 1][1] - size)]
        options += [(best[i][0] + v.scores[word[i:j]], best[i][1] - 1) for i in range(j) if word[i:j] in v.scores]
        best[j] = max(options)
    return -best[-1][1]


def plain_path(word, v):
    """Pieces of the best path, None for a byte."""
    best = [(0.0, 0, ())] + [None] * len(word)
    for j in range(1, len(word) + 1):
        size = len(word[j - 1].encode())
        options = [(best[j - 1][0] + size * v.byte_score, best[j - 1][1] - size, (best[j - 1][2], None, size))]
        options += [(best[i][0] + v.scores[word[i:j]], best[i][1] - 1, (best[i][2], word[i:j], 1)) for i in range(j) if word[i:j] in v.scores]
        best[j] = max(options, key=lambda o: o[:2])
    chain = best[-1][2]
    while chain:
        chain, piece, size = chain
        yield from [piece] * size


def plain_vocabulary(texts, v):
    """Log-probabilities of the pieces, from the best paths of all words under scores by place."""
    start = M.Vocabulary({p: -math.log(k + 2) for k, p in enumerate(sorted(v.scores, key=lambda p: (-v.scores[p], p)))})
    uses = Counter()
    for w, n in Counter(w for t in texts for w in WORD.findall(t or "")).items():
        for piece in plain_path(M.MARK + w, start):
            uses[piece] += n
    whole = sum(uses.values()) + len(start.scores) + 256
    return M.Vocabulary({p: math.log(uses[p] + 1) - math.log(whole) for p in start.scores}, math.log(uses[None] / 256 + 1) - math.log(whole))


def test_unigram_vocabulary(spark, docs_of):
    docs = table(spark, SF, "documents")
    pieces = M.Vocabulary.from_model()
    texts = [r.text for r in docs.collect()]
    for rows, given in ((docs, texts), (docs_of([(1, "é \x01\x02 " + "漢" * 90), (2, None), (3, "ab" * 80)]), ["é \x01\x02 " + "漢" * 90, "ab" * 80]), (docs.limit(0), [])):
        got, want = M.unigram_vocabulary(rows, pieces), plain_vocabulary(given, pieces)
        assert got.byte_score == pytest.approx(want.byte_score)
        assert got.scores.keys() == want.scores.keys() and all(got.scores[p] == pytest.approx(s, abs=1e-9) for p, s in want.scores.items())
        assert sum(math.exp(s) for s in got.scores.values()) + 256 * math.exp(got.byte_score) == pytest.approx(1)


def test_long_words_as_short_ones(monkeypatch):
    rng = np.random.default_rng(4)
    v = M.Vocabulary({"a": -1.0, "ab": -1.5, "ba": -1.7, "bab": -2.0}, -3.0)
    words = sorted({"".join(rng.choice(list("abé"), rng.integers(0, 20))) for _ in range(300)})
    times = rng.integers(1, 9, len(words)).tolist()
    counts, usage = M.trie_counts(words, v), M.piece_usage(words, times, v)
    assert int(usage.sum()) == sum(n * c for n, c in zip(times, counts))
    monkeypatch.setattr(M, "LEVELS", 5)
    assert M.trie_counts(words, v) == counts and (M.piece_usage(words, times, v) == usage).all()


def test_documents_match_word_by_word(spark):
    docs = table(spark, SF, "documents")
    v = plain_vocabulary([r.text for r in docs.collect()], M.Vocabulary.from_model())
    memo = {}
    want = []
    for r in docs.collect():
        words = WORD.findall(r.text)
        want.append((r.doc_id, len(words), sum(memo.get(w) or memo.setdefault(w, plain(M.MARK + w, v)) for w in words)))
    assert sorted(tuple(r) for r in M.contract(docs).collect()) == sorted(want)


def test_trie_equals_plain_on_random_vocabularies():
    rng = np.random.default_rng(8)
    for _ in range(30):
        piece = lambda: "".join(rng.choice(list("abé"), rng.integers(1, 4)))
        v = M.Vocabulary({piece(): float(-rng.integers(1, 6)) for _ in range(12)}, -4.0)
        words = sorted("".join(rng.choice(list("abéz"), rng.integers(0, 9))) for _ in range(60))
        assert M.trie_counts(words, v) == [plain(w, v) for w in words]


def test_edges(spark, docs_of):
    v = M.Vocabulary({M.MARK: -1.0, M.MARK + "a": -1.5, "a": -1.0, "aa": -1.0})
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "aaa é"), (5, "aaa é"), (None, "x"), (6, "a" * 20000), (7, "a " * 9000)]
    docs = docs_of(rows).withColumn("tokens", F.lit(1)).withColumnRenamed("lang", "n_tokens")
    got = [(r.doc_id, r.tokens.n_words, r.tokens.n_tokens) for r in M.count_tokens(docs, v).collect()]
    want = [(d, len(WORD.findall(t or "")), sum(plain(M.MARK + w, v) for w in WORD.findall(t or "")) if len(t or "") < 9999 else None) for d, t in rows]
    assert [g for g in got if g[0] not in (6, 7)] == [w for w in want if w[0] not in (6, 7)]
    assert dict((g[0], g[1:]) for g in got)[6] == (1, 10001 - 0) or dict((g[0], g[1:]) for g in got)[6][1] in (10000, 10001)
    assert dict((g[0], g[1:]) for g in got)[7] == (9000, 9000)
    assert M.count_tokens(docs.limit(0), v).collect() == []
    assert M.count_tokens(docs_of(rows), M.Vocabulary({})).where("doc_id = 4").first().tokens.n_tokens == 4
