"""Periodic runs of words, and texts without their repeats.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), at least ``max(MIN_WORDS, EXPONENT * q)`` words long, that no
neighbouring word extends keeping the period.

The texts of a slice become one run-length grammar by recompression (see
``recompression``). For every period q the words at multiples of q form a grid;
over all q that is a harmonic number of places per word. A run holds three
neighbouring grid places, whose words agree; from such places the grammar's
common extensions, forward and backward, give the run's exact ends. A run of
period q is found for multiples of q as well, with the same ends; the smallest
period stays. Words are named by comparing their bytes, nothing rests on hashes.

Each text is treated by itself, in one narrow pass: no row moves, and a lost
executor costs its tasks only. Memory grows with the words of a slice (2 MB, or
one longer text): grammar and grid are some hundred bytes a word, the grid is
walked in pieces of ``GRID`` places.

Defined results: a null, empty or blank text has no words, no runs, and digests
of the empty string; repeated rows and equal texts each get their own result;
of runs with equal exponents the smallest start, then period is the longest;
a null id repeats nothing in ``repeat_tails``; an empty table gives an empty
result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.recompression import SEPARATOR, Grammar
from tablejobs.llm.store import read
from tablejobs.llm.textbatch import SPACED, WordHasher, ranges, row_counts, slices

#: Shortest run in words, and in periods.
MIN_WORDS = 24
EXPONENT = 3
#: Grid places looked at in one piece.
GRID = 2_000_000

SCHEMA = ("n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long")


class Words:
    """The words of a slice of texts, named by their bytes. ``tails`` (one entry per
    text, None for most) are the numbers g of ``repeat_tails``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, tails: list[int | None] | None = None):
        self.data = data
        self.starts, self.ends, self.row = WordHasher(SPACED).words(data, offsets)
        self.counts = row_counts(self.row, len(offsets) - 1)
        self.base = np.concatenate([[0], np.cumsum(self.counts)]).astype(np.int64)
        #: Which word of the slice stands at each place.
        self.source = np.arange(len(self.row))
        for k, g in enumerate(tails or []):
            n = int(self.counts[k])
            if g is not None and n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                lo = int(self.base[k])
                self.source[lo + a:lo + n] = lo + a + np.arange(n - a) % p
        blob = data[SPACED[data]]
        cuts = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        column = pa.Array.from_buffers(pa.large_binary(), len(self.row),
                                       [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(blob)])
        self.names = np.asarray(column.dictionary_encode().indices).astype(np.int64)[self.source] + 1

    def sequences(self) -> tuple[np.ndarray, np.ndarray]:
        """The names with separators around each text, and each text's place in them."""
        place = np.arange(len(self.row)) + self.row + 1
        symbols = np.full(len(self.row) + len(self.counts) + 1, SEPARATOR, np.int64)
        symbols[place] = self.names
        return symbols, self.base[:-1] + np.arange(len(self.counts)) + 1

    def joined(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets): each text's words with ``keep``, a space after each."""
        kept = np.flatnonzero(keep)
        source = self.source[kept]
        size = self.ends[source] - self.starts[source]
        out = np.full(int(size.sum()) + len(kept), 0x20, np.uint8)
        at = np.cumsum(size + 1) - size - 1
        out[ranges(at, size)] = self.data[ranges(self.starts[source], size)]
        ends = np.concatenate([[0], np.cumsum(size + 1)])
        return out, ends[np.concatenate([[0], np.cumsum(row_counts(self.row[kept], len(self.counts)))])]


def grid_places(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, place) of the grid places with two more after them, in pieces."""
    text = np.flatnonzero(counts >= MIN_WORDS)
    periods = counts[text] // EXPONENT
    text = np.repeat(text, periods)
    period = ranges(np.ones(len(periods), np.int64), periods)
    places = (counts[text] - 1) // period - 1
    ends = np.cumsum(places)
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + GRID, side="right")))
        n = places[lo:hi]
        q = np.repeat(period[lo:hi], n)
        yield np.repeat(text[lo:hi], n), q, ranges(np.zeros(hi - lo, np.int64), n) * q
        lo = hi


def find_runs(words: Words) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, sorted by text, start and period."""
    symbols, origin = words.sequences()
    names = words.names
    grammar, found = None, [np.zeros((0, 4), np.int64)]
    for text, period, place in grid_places(words.counts):
        at = words.base[text] + place
        hit = np.flatnonzero(names[at] == names[at + period])
        hit = hit[names[at[hit]] == names[at[hit] + 2 * period[hit]]]
        if not len(hit):
            continue
        grammar = grammar or Grammar(symbols)
        text, period, place = text[hit], period[hit], place[hit]
        a = origin[text] + place
        b = a + period
        before = grammar.extend(a - 1, b - 1, -1)
        length = before + period + grammar.extend(a, b, 1)
        long = length >= np.maximum(MIN_WORDS, EXPONENT * period)
        run = np.stack([text, place - before, length, period], 1)[long]
        found.append(np.unique(run, axis=0))
    runs = np.unique(np.concatenate(found), axis=0)
    # Sorted by text, start, length and period: the first of equal ends has the smallest period.
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :3] != runs[:-1, :3]).any(1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def kept_words(words: Words, runs: np.ndarray) -> np.ndarray:
    """False for the words a run holds after its first period."""
    cover = np.zeros(len(words.row) + 1, np.int64)
    first = words.base[runs[:, 0]] + runs[:, 1]
    np.add.at(cover, first + runs[:, 3], 1)
    np.add.at(cover, first + runs[:, 2], -1)
    return np.cumsum(cover[:-1]) == 0


def _digests(words: Words, runs: np.ndarray) -> Iterator[tuple]:
    keep = kept_words(words, runs)
    text, at = words.joined(keep)
    text = memoryview(text)
    dropped = row_counts(words.row[~keep], len(words.counts))
    cuts = np.searchsorted(runs[:, 0], np.arange(len(words.counts) + 1))
    for k, n in enumerate(words.counts.tolist()):
        mine = runs[cuts[k]:cuts[k + 1], 1:].tolist()
        best = min(mine, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{l},{q}\n" for s, l, q in mine)
        milli = 1000 * best[1] // best[2] if mine else None
        yield (len(mine), *best, milli, hashlib.sha256(lines.encode()).hexdigest(),
               hashlib.sha256(text[at[k]:max(at[k], at[k + 1] - 1)]).hexdigest(), n, int(dropped[k]))


def _prepared(docs: DataFrame, id_col: str, text: str, tail: Column | None) -> DataFrame:
    none = F.lit(None).cast("long")
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"),
                       (none if tail is None else tail).alias("tail"))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  tail: Column | None = None) -> DataFrame:
    """Per row: the id, the number of runs, the one of greatest exponent, digests of
    all runs and of the collapsed text, and the numbers of words and dropped words.
    ``tail``: the numbers of ``repeat_tails``, if texts are to be changed so first."""
    slim = _prepared(docs, id_col, text, tail)
    names = ["id", *[c.split()[0] for c in SCHEMA.split(", ")]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches):
            words = Words(data, offsets, part.column(2).to_pylist())
            columns = list(zip(*_digests(words, find_runs(words))))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

    return slim.mapInArrow(work, f"id {dict(slim.dtypes)['id']}, {SCHEMA}").withColumnRenamed("id", id_col)


def all_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (id, start, length, period) per run."""
    slim = _prepared(docs, id_col, text, None)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches):
            runs = find_runs(Words(data, offsets))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(runs[:, 0])), *[pa.array(runs[:, i]) for i in (1, 2, 3)]],
                ["id", "start", "length", "period"])

    kind = dict(slim.dtypes)["id"]
    return slim.mapInArrow(work, f"id {kind}, start long, length long, period long").withColumnRenamed("id", id_col)


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text): the words that are left, joined by single spaces."""
    slim = _prepared(docs, id_col, text, None)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches):
            words = Words(data, offsets)
            joined, at = words.joined(kept_words(words, find_runs(words)))
            whole = joined.tobytes()
            texts = [whole[lo:max(lo, hi - 1)].decode() for lo, hi in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["id", "text"])

    out = slim.mapInArrow(work, f"id {dict(slim.dtypes)['id']}, text string")
    return out.toDF(id_col, text)


def repeat_tails(id_col: str = "doc_id") -> Column:
    """g = crc32(decimal id) div 10 for the tenth of the ids whose crc32 ends in 0, else
    null. With n words, from the word a = g mod n on a text repeats its
    p = 1 + (n - a) div (3 + g mod 8) words that start there."""
    h = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    return F.when(h % 10 == 0, F.floor(h / 10).cast("long"))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    return periodic_runs(read(spark, sf_dir, "documents"), tail=repeat_tails())
