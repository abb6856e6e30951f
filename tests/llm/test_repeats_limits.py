"""What the removal of repeated passages sorts, and what it leaves on disk."""

import time

import numpy as np
from pyspark.sql import functions as F

from tablejobs.llm import repeats
from tablejobs.llm.store import saved, temporary
from tablejobs.llm.textbatch import WordHasher, word_table


def test_only_segments_with_a_shared_anchor_are_sorted(monkeypatch):
    """Four distinct segments in two documents each; two of them share an anchor and a string."""
    rng = np.random.default_rng(5)
    text = rng.integers(97, 123, (4, 120)).astype(np.uint8)
    text[1, :110] = text[0, 10:]
    sorted_bytes = []
    groups = repeats.prefix_groups

    def spy(symbols, length):
        sorted_bytes.append(len(symbols))
        return groups(symbols, length)

    monkeypatch.setattr(repeats, "prefix_groups", spy)
    ids = np.array([1, 2] * 4)
    which = np.repeat(np.arange(4), 2)
    start = which * 1000
    spans = repeats.repeated_spans(ids, start, which, np.full(4, 120), np.array([7, 7, 8, 9], np.uint32),
                                   text.ravel(), 100)
    assert sorted_bytes == [2 * 121 + 1]
    found = sorted(zip(*(x.tolist() for x in repeats.merge(*spans))))
    # Whole copies in document 2, and what segment 1 has of segment 0 in document 1.
    assert found == [(1, 1000, 1110), *[(2, 1000 * k, 1000 * k + 120) for k in range(4)]]


def test_no_shared_anchor_is_nothing_to_sort():
    text = np.arange(240, dtype=np.uint8)
    none = repeats.repeated_spans(np.array([1, 1]), np.array([0, 500]), np.array([0, 1]), np.full(2, 120),
                                  np.array([1, 2], np.uint32), text, 100)
    assert all(len(x) == 0 for x in none)


def test_hashes_of_passages():
    """Equal passages at other places agree; patterned ones that differ do not."""
    hasher = WordHasher(word_table([]), fold=False)
    word = lambda n, a, b: a if n == 0 else word(n - 1, a, b) + word(n - 1, b, a)
    texts = [word(k, a, b) for k in (7, 10, 11) for a, b in ((b"a", b"b"), (b"b", b"a"))]
    texts += [b"x" * n for n in (100, 127, 128, 129, 168)]
    for front in (b"", b"moved"):
        data = front + b"".join(texts)
        ends = len(front) + np.cumsum([len(t) for t in texts])
        got = hasher.passages(np.frombuffer(data, np.uint8), ends - [len(t) for t in texts], ends)
        assert len(set(got.tolist())) == len(texts)
        if front:
            assert (got == before).all()
        before = got
    assert len(hasher.passages(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0


def test_saving_leaves_no_shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(cleanup, "false")
    with temporary(spark):
        counts = saved(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count(), "shuffled")
        until = time.monotonic() + 20                 # executors delete them in their own time
        while not files() <= before and time.monotonic() < until:
            time.sleep(0.1)
        assert files() <= before
        assert counts.count() == 700
    assert spark.conf.get(cleanup, "false") == setting
