"""Operators that compare documents: against their plain definitions."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablejobs.llm import decontamination, jaccard, lm_scoring, repeats
from tablejobs.llm.eftrie import EliasFano, Mapped, Trie, to_bytes
from tablejobs.llm.store import read, saved
from tablejobs.llm.suffixes import FMIndex, suffix_array
from tests.llm import brute
from tests.llm.conftest import untouched


def test_suffix_array_and_fm_index():
    rng = np.random.default_rng(5)
    for alphabet in (2, 5, 400):
        text = np.append(rng.integers(1, alphabet + 1, 700), 0)
        order = suffix_array(text)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        index = FMIndex(text)
        phrases, lengths = text[:60].reshape(20, 3).copy(), rng.integers(1, 4, 20)
        lo, hi = index.search(phrases, lengths)
        for p, n, a, b in zip(phrases, lengths, lo, hi):
            found = sorted(index.locate(np.arange(a, b)).tolist())
            assert found == [i for i in range(len(text) - n) if (text[i:i + n] == p[:n]).all()]


def test_prefix_groups():
    rng = np.random.default_rng(6)
    text = np.append(np.tile(rng.integers(1, 4, 90), 3), 0)
    order, group = repeats.prefix_groups(text, 12)
    starts = [text[i:i + 12].tolist() for i in order]
    assert [a == b for a, b in zip(starts[1:], starts)] == [a == b for a, b in zip(group[1:], group)]


def test_elias_fano_and_trie():
    rng = np.random.default_rng(7)
    for top in (50, 2**31, 2**64 - 2):
        values = np.unique(rng.integers(0, top, 800, dtype=np.uint64))
        packed = EliasFano(EliasFano.pack(values, "x"), "x")
        assert (packed.values() == values).all()
        wanted = np.concatenate([values[::3], values[::4] + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
        place, found = packed.successor(wanted)
        assert (place == np.searchsorted(values, wanted)).all() and (found == np.isin(wanted, values)).all()
    none = np.zeros(0, np.uint64)
    with Mapped(to_bytes(Trie.pack(none, none, none.astype(np.int64), 0.75))) as trie:
        total, many, codes = trie.lookup(values[:2], np.array([1, 0]), np.array([3], np.uint32))
        assert (total.tolist(), many.tolist(), codes.tolist()) == ([0, 0], [0, 0], [0])


def model(texts):
    words = {k: brute.SPACED.findall(brute.lower(t)) + [None] for k, t in texts.items()}
    trained = [k for k in words if zlib.crc32(str(k).encode()) % 7 != 2]
    c = Counter(w for k in trained for w in words[k])
    n, v = sum(c.values()), len(c)
    pair = Counter(p for k in trained for p in zip(["<s>", *words[k]], words[k]))
    total, many = Counter(), Counter()
    for (u, _), k in pair.items():
        total[u] += k
        many[u] += 1

    def score(text):
        out = 0.0
        for u, w in zip(["<s>", *text], text):
            p = (c[w] - 0.75) / n if c[w] else 0.75 * v / n
            seen = 0.0
            if pair[u, w]:
                seen = 10 ** (-0.04 * (min(255, max(1, round(-math.log10((pair[u, w] - 0.75) / total[u]) / 0.04) + 1)) - 1))
            out += math.log10(seen + (0.75 * many[u] / total[u] if total[u] else 1.0) * p)
        return out

    return {k: (len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), score(t))
            for k, t in words.items()}


def test_lm_scores(spark, small_dir, documents, monkeypatch):
    expected = model({d["doc_id"]: d["text"] for d in documents})
    for bits in (lm_scoring.BATCH_BITS, 5):
        monkeypatch.setattr(lm_scoring, "BATCH_BITS", bits)
        rows = lm_scoring.op1_lm_scoring(spark, small_dir).collect()
        assert len(rows) == len(expected)
        for r in rows:
            n_tokens, n_known, n, base, score = expected[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
            assert r.base_score == pytest.approx(base) and abs(r.score - score) < 0.05 * n_tokens
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    assert sum(r.score - r.base_score for r in rows if r.held_out) > 0


def test_lm_vocabulary_of_hot_words(spark):
    """Words of a very frequent passage have one successor, and many shards share them."""
    from pyspark.sql import functions as F

    texts = {i: " ".join(f"w{k}" for k in range(12)) for i in range(30)} | {30: "some other words"}
    rows = lm_scoring.score_texts(saved(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "hot"),
                                  F.lit(True)).collect()
    n, v = 30 * 13 + 4, 12 + 3 + 1
    count = Counter(w for t in texts.values() for w in [*t.split(), None])
    for r in rows:
        expected = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*texts[r.doc_id].split(), None])
        assert r.train_tokens == n and r.base_score == pytest.approx(expected, abs=1e-9)


def test_lm_edges(edges, nothing):
    from pyspark.sql import functions as F

    rows = lm_scoring.score_texts(saved(edges, "edges"), F.col("doc_id") != 4).collect()
    assert len(rows) == edges.count() and all(math.isfinite(r.score) for r in rows)
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (1, 2, 3))
    untrained = lm_scoring.score_texts(saved(edges, "edges"), F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in untrained)
    assert lm_scoring.score_texts(saved(nothing, "edges"), F.lit(True)).count() == 0


def test_jaccard_components(spark, small_dir, documents):
    expected = brute.components({d["doc_id"]: d["text"] for d in documents})
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op6_jaccard(spark, small_dir).collect()}
    assert got == expected


def test_jaccard_chains_hubs_and_small_sets(spark, monkeypatch):
    """Chains of links, texts that share one passage, and sets at the threshold, in small blocks."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(4000)]
    shared = " ".join(rng.choice(words, 40))
    texts, k = {}, 0
    for size in (1, 4, 5, 6, 7, 8, 9, 13, 20, 45, 120):
        for _ in range(6):
            base = list(rng.choice(words, size))
            for _ in range(5):              # each a little further from the first
                texts[k] = " ".join(base)
                base[int(rng.integers(size))] = str(rng.choice(words))
                k += 7
    for _ in range(60):
        texts[k] = shared + " " + " ".join(rng.choice(words, int(rng.integers(1, 30))))
        k += 7
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.k: (r.n, r.component) for r in jaccard.similar_components(docs).collect()}
    assert got == brute.components(texts)


def test_jaccard_pairs_are_all_links(spark, monkeypatch):
    """Also those between texts that other links connect already."""
    rng = np.random.default_rng(10)
    words = [f"w{i}" for i in range(3000)]
    texts = {}
    for size in (6, 20, 45, 120):
        base = list(rng.choice(words, size))
        for _ in range(9):
            texts[len(texts)] = " ".join([*base, *rng.choice(words, max(1, size // 15))])
        texts[len(texts)] = texts[len(texts) - 1].upper()       # the same set
    sets = {k: brute.shingle_set(t) for k, t in texts.items()}
    expected = {(i, j) for i in sets for j in sets if i < j and sets[i] != sets[j]
                and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    pairs, rows = jaccard.similar_pairs(docs)
    members = {r.k: r for r in rows.collect()}
    linked = [(r.a, r.b) for r in pairs.collect()]
    assert len(linked) == len(set(linked)) and len(expected) > 60
    assert set(linked) == {tuple(sorted((members[i].c, members[j].c))) for i, j in expected}
    assert all(members[k].n_links == len({sets[j] for j in sets if (min(j, k), max(j, k)) in expected}) for k in sets)


def test_pigeonhole_bound():
    for band in range(30):
        strict, loose, slack = jaccard.allocation(band)
        low, high = jaccard.band_limits(band)
        assert strict + 2 * loose >= 2 * high // 9 + 1 + slack and jaccard.band_of(low) == jaccard.band_of(high) == band


def test_jaccard_edges(edges, nothing):
    rows = jaccard.similar_components(edges).collect()
    assert len(rows) == edges.count()
    found = {r.k: (r.n, r.component) for r in rows}
    assert found[1] == (0, 1) and found[3] == (0, 3) and found[5] == (1, 4) and found[11][1] == 10
    kept = jaccard.keep_first(edges)
    assert kept.columns == edges.columns and untouched(kept.collect())
    ids = sorted((r.doc_id or 0) for r in kept.collect())
    assert ids == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert jaccard.similar_components(nothing).count() == 0 and jaccard.keep_first(nothing).count() == 0


def test_repeats(spark, small_dir, documents):
    texts = {d["doc_id"]: d["text"] for d in documents}
    gone = brute.removed(texts)
    for hot in (repeats.HOT, 1):
        repeats.HOT, before = hot, repeats.HOT
        try:
            rows = repeats.op8_suffix_repeats(spark, small_dir).collect()
        finally:
            repeats.HOT = before
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == {
            k: brute.repeat_row(t, gone[k]) for k, t in texts.items()}


def test_repeats_edges(spark, edges, nothing):
    from tests.llm.conftest import EDGES

    texts = {-(2**63) if i is None else i: t for i, t in EDGES}
    gone = brute.removed(texts)
    rows = repeats.repeat_digests(edges).collect()
    assert len(rows) == len(EDGES)
    for r in rows:
        k = -(2**63) if r.doc_id is None else r.doc_id
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == brute.repeat_row(texts[k], gone[k])
    cut = repeats.remove_repeats(edges)
    assert cut.columns == edges.columns and cut.count() == len(EDGES) and untouched(cut.collect())
    assert {r.text for r in cut.collect() if r.doc_id == 1} == {None}
    assert repeats.repeat_digests(nothing).count() == 0 and repeats.remove_repeats(nothing).count() == 0


def test_one_id_with_different_texts(spark):
    """Null ids and a repeated id: rows are told apart by their texts, too."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(2000)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(12)]
    near = texts[0] + " more"
    rows = [(None, t) for t in texts[:5]] + [(7, t) for t in texts[5:9]] + [(8, near), (9, texts[6]), (7, texts[8]),
                                                                           (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = Counter((r.doc_id, r.text) for r in jaccard.keep_first(docs).collect())
    assert kept == Counter({*rows} - {(8, near), (9, texts[6])})
    found = Counter((r.k, r.n, r.component) for r in jaccard.similar_components(docs).collect())
    null = -(2**63)
    assert found == Counter({(null, 56, null): 5, (null, 0, null): 2, (7, 56, 7): 5, (8, 57, null): 1, (9, 56, 7): 1})

    # Two texts without an id hold a passage; a third and one more with the id 7 must stay whole.
    passage = " ".join(rng.choice(words, 40))
    rows = [(None, "a " + passage), (None, "b " * 60 + passage), (None, texts[1]), (7, texts[2]), (7, texts[3] + passage),
            (7, texts[2]), (8, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    cut = Counter((r.doc_id, r.text) for r in repeats.remove_repeats(docs).collect())
    assert sum(cut.values()) == len(rows) and cut[None, texts[1]] == 1 and cut[7, texts[2]] == 2 and cut[8, texts[4]] == 1
    holding = [(i, t) for i, t in cut if passage in t]
    assert len(holding) == 1 and holding[0][0] is None and (7, texts[3]) in cut
    hashed = docs.select("*", F.xxhash64("text").alias("h")).collect()
    keyed = {(null if r.doc_id is None else r.doc_id, r.h): r.text for r in hashed}
    gone = brute.removed(keyed)
    expected = [(r.doc_id, *brute.repeat_row(r.text, gone[null if r.doc_id is None else r.doc_id, r.h])) for r in hashed]
    assert Counter(tuple(r) for r in repeats.repeat_digests(docs).collect()) == Counter(expected)


def test_whole_characters_stay(spark):
    docs = spark.createDataFrame([(1, "é" * 200), (2, "xé" + "é" * 120 + "y")], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in repeats.remove_repeats(docs).collect()}
    assert rows[2] == "xy" and set(rows[1]) == {"é"}


def test_decontamination(spark, small_dir, documents):
    items = [(r.item_id, r.text) for r in read(spark, small_dir, "benchmark").collect()]
    found = brute.phrases(items)
    expected = {}
    for d in documents:
        n, hit, ids = brute.contaminated(d["text"], found)
        expected[d["doc_id"]] = (n, len(hit), len(ids), brute.sha(",".join(ids).encode()), bool(hit))
    rows = decontamination.op10_decontamination(spark, small_dir).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows} == expected
    assert any(r.contaminated for r in rows)


def test_decontamination_edges_and_blocks(spark, edges, nothing):
    items = [(1, "quick brown fox"), (2, "Quick, Brown FOX jumps"), (2, None), (3, ""), (None, "naïve 漢字"),
             (4, "a b c d e f g h i j k l m"), (5, "word word word")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = brute.phrases(items)
    from tests.llm.conftest import EDGES

    for size in (1 << 20, 150):
        for r in decontamination.contamination(edges, benchmark, block_bytes=size).collect():
            text = dict(EDGES)[r.doc_id]
            n, hit, ids = brute.contaminated(text, found)
            assert (r.n_words, r.n_hit, sorted(r["items"])) == (n, len(hit), ids)
            assert sum(s.words for s in r.spans) == len(hit)
        cut = decontamination.decontaminate(edges, benchmark, block_bytes=size)
        assert cut.columns == edges.columns and cut.count() == edges.count() and untouched(cut.collect())
        texts = {r.doc_id: r.text for r in cut.collect()}
        assert texts[1] is None and "quick" not in texts[10] and texts[4] == "one two"
        assert decontamination.contamination(nothing, benchmark, block_bytes=size).count() == 0
        # Rows that repeat, with and without an id, stay rows of their own.
        more = edges.unionAll(edges).unionAll(edges.filter("doc_id IS NULL"))
        ids = Counter(r.doc_id for r in decontamination.contamination(more, benchmark, block_bytes=size).collect())
        assert ids == Counter([i for i, _ in EDGES] * 2 + [None])
    empty = decontamination.contamination(edges, benchmark.limit(0)).collect()
    assert len(empty) == edges.count() and all(r.n_hit == 0 for r in empty)


def patterned():
    """Two words whose polynomial hashes modulo 2 ** 64 agree whatever the base."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_patterned_words_are_told_apart(spark):
    one, two = patterned()
    texts = [(1, f"{one} " * 6), (2, f"{two} " * 6), (3, f"{one.upper()}\n" * 6)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.k: r.component for r in jaccard.similar_components(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 1}
    items = spark.createDataFrame([("i", two)], "item_id string, text string")
    hits = {r.doc_id: r.n_hit for r in decontamination.contamination(docs, items).collect()}
    assert hits == {1: 0, 2: 6, 3: 0}
    scores = lm_scoring.score_texts(saved(docs, "patterned"), F.col("doc_id") == 1)
    assert {r.doc_id: r.n_known for r in scores.collect()} == {1: 7, 2: 1, 3: 7}
