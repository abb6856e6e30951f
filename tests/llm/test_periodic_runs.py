"""Recompression and periodic runs: against plain definitions."""

import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tablejobs.llm import periodic_runs as op
from tablejobs.llm.recompression import Grammar
from tablejobs.llm.textbatch import text_view
from tests.llm import brute


def runs_of(words):
    """Every run: maximal stretches of words q apart that agree, smallest q first."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        k = 0
        while k < n - q:
            start = k
            while k < n - q and words[k] == words[k + q]:
                k += 1
            if k - start + q >= max(24, 3 * q):
                found.setdefault((start, k - start + q), q)
            k += k == start
    return sorted((s, length, q) for (s, length), q in found.items())


def changed(doc_id, text):
    words = brute.SPACED.findall(text or "")
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    words = changed(doc_id, text)
    runs = runs_of(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            brute.sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()),
            brute.sha(" ".join(w for i, w in enumerate(words) if i not in gone).encode()))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def some_text(rng):
    words = []
    while len(words) < rng.choice([0, 5, 40, 250]):
        piece = [f"w{rng.randrange(rng.choice([1, 2, 3, 50]))}" for _ in range(rng.randrange(1, 25))]
        words += piece * (rng.randrange(2, 9) if rng.random() < 0.5 else 1)
    return " ".join(words)


def test_runs_and_extensions(monkeypatch):
    rng = random.Random(3)
    for _ in range(15):
        texts = [some_text(rng) for _ in range(rng.choice([1, 30]))]
        words = op.Words(*text_view(pa.array(texts, pa.string())))
        symbols, origin = words.sequences()
        grammar = Grammar(symbols)
        for grid in (40, 2_000_000):
            monkeypatch.setattr(op, "GRID", grid)
            runs = op.find_runs(words)
            for k, text in enumerate(texts):
                assert [tuple(r) for r in runs[runs[:, 0] == k, 1:].tolist()] == runs_of(text.split())
        for k, text in enumerate(texts):
            w = text.split()
            if len(w) < 2:
                continue
            i, j = np.array([sorted(rng.sample(range(len(w)), 2)) for _ in range(20)]).T
            ahead, back = (grammar.extend(origin[k] + i, origin[k] + j, s).tolist() for s in (1, -1))
            for a, b, x, y in zip(i.tolist(), j.tolist(), ahead, back):
                assert w[a:a + x] == w[b:b + x] and (b + x == len(w) or w[a + x] != w[b + x])
                assert w[a - y + 1:a + 1] == w[b - y + 1:b + 1] and (a == y - 1 or w[a - y] != w[b - y])


def test_grammar_is_small_and_exact():
    long = np.tile(np.arange(1, 8), 3000)
    symbols = np.concatenate([[0], long, [0], np.ones(5000, int), [0]])
    grammar = Grammar(symbols)
    assert len(grammar.top) <= 9 and len(grammar.levels) < 80
    assert grammar.extend(np.array([1]), np.array([8]), 1).tolist() == [len(long) - 7]
    # Different words whose polynomial hash modulo 2**64 agrees are still different words.
    ab = "a"
    for _ in range(10):
        ab += ab.translate(str.maketrans("ab", "ba"))
    words = op.Words(*text_view(pa.array([f"{ab} {ab.translate(str.maketrans('ab', 'ba'))} " * 15], pa.string())))
    assert op.find_runs(words).tolist() == [[0, 0, 30, 2]]


def test_supplied_documents(spark, small_dir, documents):
    got = rows(op.op11_periodic_runs(spark, small_dir))
    assert got == sorted((expected(r["doc_id"], r["text"]) for r in documents), key=repr)
    assert any(r[1] for r in got)


def test_edges(spark, edges, nothing):
    assert rows(op.periodic_runs(nothing, tail=op.repeat_tails())) == []
    rare = edges.withColumnRenamed("k", "tail").withColumnRenamed("n", "id")
    got = rows(op.periodic_runs(rare, tail=op.repeat_tails()))
    assert got == sorted((expected(r["doc_id"], r["text"]) for r in edges.collect()), key=repr)
    found = {tuple(r) for r in op.all_runs(rare).collect()}
    assert found == {(r["doc_id"], *x) for r in edges.collect()
                     for x in runs_of(brute.SPACED.findall(r["text"] or ""))}
    texts = {r["doc_id"]: r["text"] for r in op.collapse_runs(rare).collect()}
    assert texts[6] == "word" and texts[7] == "a b c d e f g h i j k l" and texts[1] == ""


@pytest.mark.parametrize("n", [23, 24, 71, 72, 73])
def test_shortest_run(n):
    words = op.Words(*text_view(pa.array([" ".join(str(i % 24) for i in range(n)), " ".join("x" * n)], pa.string())))
    assert op.find_runs(words).tolist() == ([[0, 0, n, 24]] if n >= 72 else []) + ([[1, 0, n, 1]] if n > 23 else [])
