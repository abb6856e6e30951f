"""Benchmark decontamination with an FM-index per training shard.

The windows of the benchmark's items (``WINDOW`` words each; a shorter item is
one window) are the phrases. Each task cuts its documents into shards of bounded
size. In a shard, words that no item has become separators and stretches of
known words too short for any window are left out; they can't hold an
occurrence. An FM-index over what remains finds each phrase by backward search
with wavelet ranks, locates its occurrences by sampled suffix positions, and the
occurrences' spans are merged per document.

The benchmark is the smaller side, but its size is checked, not assumed: it is
dealt into blocks of at most ``BLOCK_BYTES`` of text, each broadcast in turn.
One block (the usual case) is a single narrow pass over the documents; with more
blocks the passes' spans are merged per id and text by a shuffle and joined to all rows.

Defined results: null texts have no words; items without words have no window;
the same window in several items counts for each; a null item id reads as the
empty string; rows that repeat are judged row by row; an empty benchmark marks
nothing and an empty table gives an empty result; other columns pass unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.store import free_names, read
from tablejobs.llm.suffixes import FMIndex
from tablejobs.llm.textbatch import ALNUM, WordHasher, ranges, row_counts, slices, text_view

#: Words per window.
WINDOW = 10
#: Benchmark text broadcast at once (its windows take some 80 times as much in the driver and
#: in each worker, about 160 MB), and document text per shard.
BLOCK_BYTES = 2 << 20
SHARD_BYTES = 4 << 20


class Phrases:
    """The distinct windows of a block of items, as word numbers from 2 on."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.ids = sorted({i for i, _ in items})
        number = {x: k for k, x in enumerate(self.ids)}
        hasher = WordHasher(ALNUM)
        data, offsets = text_view(pa.array([t for _, t in items], pa.large_string()))
        starts, ends, row = hasher.words(data, offsets)
        self.vocabulary, word = np.unique(hasher.hashes(data, starts, ends), return_inverse=True)
        found: dict[tuple, set[int]] = {}
        cuts = np.searchsorted(row, np.arange(len(items) + 1))
        for k, (item, _) in enumerate(items):
            words = (word[cuts[k]:cuts[k + 1]] + 2).tolist()
            for at in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[at:at + window]), set()).add(number[item])
        order = sorted(found)
        self.lengths = np.array([len(p) for p in order], np.int64)
        self.words = np.zeros((len(order), window), np.int64)
        for k, p in enumerate(order):
            self.words[k, :len(p)] = p
        self.item_counts = np.array([len(found[p]) for p in order], np.int64)
        self.item_starts = np.concatenate([[0], np.cumsum(self.item_counts)]).astype(np.int64)
        self.items = np.array([i for p in order for i in sorted(found[p])], np.int64)
        self.shortest = int(self.lengths.min(initial=window))
        #: Low bits of the known hashes: most unknown words end here.
        self.low = np.zeros(1 << 16, bool)
        self.low[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers; 0 for words that no item has."""
        out = np.zeros(len(hashes), np.int64)
        if len(self.vocabulary):
            may = np.flatnonzero(self.low[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
            h = hashes[may]
            at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
            same = self.vocabulary[at] == h
            out[may[same]] = at[same] + 2
        return out


class ShardHits:
    """What a block of phrases finds in one shard of documents."""

    def __init__(self, phrases: Phrases, hasher: WordHasher, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        starts, ends, row = hasher.words(data, offsets)
        self.n_words = row_counts(row, n)
        word, phrase, length = self._occurrences(phrases, hasher.hashes(data, starts, ends), row)
        cover = np.zeros(len(starts) + 1, np.int64)
        np.add.at(cover, word, 1)
        np.add.at(cover, word + length, -1)
        hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        self.n_hit = row_counts(row[hit], n)
        # Merged spans: words that are hit one after another in the same document.
        new = np.ones(len(hit), bool)
        new[1:] = (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hit)) - 1 if len(hit) else first
        self.span_row = row[hit[first]]
        self.span_start = starts[hit[first]] - offsets[self.span_row]
        self.span_end = ends[hit[last]] - offsets[self.span_row]
        base = np.concatenate([[0], np.cumsum(self.n_words)])
        self.span_word = hit[first] - base[self.span_row]
        self.span_words = hit[last] - hit[first] + 1
        # Distinct (document, item) pairs.
        pairs = np.unique(np.stack([row[word], phrase]), axis=1) if len(word) else np.zeros((2, 0), np.int64)
        counts = phrases.item_counts[pairs[1]]
        items = phrases.items[ranges(phrases.item_starts[pairs[1]], counts)]
        self.items: list[list[str]] = [[] for _ in range(n)]
        for r, i in sorted(set(zip(np.repeat(pairs[0], counts).tolist(), items.tolist()))):
            self.items[r].append(phrases.ids[i])     # ids are sorted as strings

    @staticmethod
    def _occurrences(phrases: Phrases, hashes: np.ndarray, row: np.ndarray):
        """(first word, phrase, length) of every occurrence, by the FM-index of the shard."""
        none = (np.zeros(0, np.int64),) * 3
        number = phrases.number(hashes)
        known = np.flatnonzero(number)
        if not len(known):
            return none
        new = np.ones(len(known), bool)
        new[1:] = (known[1:] != known[:-1] + 1) | (row[known[1:]] != row[known[:-1]])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(known)))
        first, size = first[size >= phrases.shortest], size[size >= phrases.shortest]
        if not len(first):
            return none
        # Each stretch is followed by a separator (1), all by the terminal (0).
        at = np.cumsum(size + 1) - (size + 1)
        symbols = np.ones(int((size + 1).sum()) + 1, np.int64)
        symbols[-1] = 0
        words = known[ranges(first, size)]
        symbols[ranges(at, size)] = number[words]
        origin = np.zeros(len(symbols), np.int64)
        origin[ranges(at, size)] = words
        index = FMIndex(symbols)
        lo, hi = index.search(phrases.words, phrases.lengths)
        phrase = np.repeat(np.arange(len(lo)), hi - lo)
        places = index.locate(ranges(lo, hi - lo))
        return origin[places], phrase, phrases.lengths[phrase]


def blocks(benchmark: DataFrame, id_col: str = "item_id", text: str = "text",
           block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The items, in blocks of about ``block_bytes`` of text at most (one longer item is one block)."""
    items = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                             F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-total * 2 // block_bytes) if total > block_bytes else 1
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield [(r["id"], r["text"]) for r in part.collect()]


#: Merged spans: first word, words, first byte, byte after the last.
_SPANS = "array<struct<word: long, words: long, start: long, end: long>>"


def _find(docs: DataFrame, items: list[tuple[str, str]], text: str) -> DataFrame:
    """Columns of ``docs`` but the text, plus n_words, n_hit, items and spans (byte offsets)."""
    phrases = docs.sparkSession.sparkContext.broadcast(Phrases(items))     # a block: bounded
    place = docs.columns.index(text)
    kept = [c for c in docs.columns if c != text]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(ALNUM)
        for part, data, offsets in slices(batches, text, SHARD_BYTES):
            found = ShardHits(phrases.value, hasher, data, offsets)
            cuts = np.searchsorted(found.span_row, np.arange(part.num_rows + 1)).astype(np.int32)
            spans = pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays(
                [pa.array(x, pa.int64()) for x in (found.span_word, found.span_words, found.span_start, found.span_end)],
                ["word", "words", "start", "end"]))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(i) for i in range(part.num_columns) if i != place], pa.array(found.n_words),
                 pa.array(found.n_hit), pa.array(found.items, pa.list_(pa.string())), spans],
                [*kept, "n_words", "n_hit", "items", "spans"])

    schema = "".join(f"`{n}` {k}, " for n, k in docs.dtypes if n != text)
    return docs.mapInArrow(work, schema + f"n_words long, n_hit long, items array<string>, spans {_SPANS}")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: id, n_words, n_hit, items (sorted as strings) and merged spans."""
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    parts = list(blocks(benchmark, block_bytes=block_bytes))
    if len(parts) == 1:
        return _find(slim, parts[0], "text").withColumnRenamed("id", id_col)
    key = ("id", "h", "size")
    keyed = slim.select("id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size"), "text")
    merged = _merged(keyed, parts)
    rows = keyed.select(*[F.col(c).alias(f"_{c}") for c in key])
    same = reduce(Column.__and__, [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in key])
    return rows.join(merged, same).select(F.col("_id").alias(id_col), "n_words", "n_hit", "items", "spans")


def _merged(keyed: DataFrame, parts: list[list[tuple[str, str]]]) -> DataFrame:
    """Of documents (id, h, size, text), what all blocks find: one row per id, h and size."""
    # Rows that repeat find the same in a pass.
    passes = [_find(keyed, items, "text").groupBy("id", "h", "size").agg(
        *[F.first(c).alias(c) for c in ("n_words", "items", "spans")]) for items in parts]
    both = reduce(DataFrame.unionAll, passes).groupBy("id", "h", "size").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = [merge_spans(x) for x in batch.column(5).to_pylist()]
            hits = pa.array([sum(s["words"] for s in x) for x in merged], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], hits, batch.column(4), pa.array(merged, batch.schema.field(5).type)],
                ["id", "h", "size", "n_words", "n_hit", "items", "spans"])

    kind = dict(keyed.dtypes)["id"]
    return both.select("id", "h", "size", "n_words", "items", "spans").mapInArrow(
        merge, f"id {kind}, h long, size int, n_words long, n_hit long, items array<string>, spans {_SPANS}")


def merge_spans(spans: list[dict]) -> list[dict]:
    """Sorted spans with those that overlap or follow one another joined."""
    out: list[dict] = []
    for s in spans:
        last = out[-1] if out else None
        if last is not None and s["word"] <= last["word"] + last["words"]:
            last["words"] = max(last["words"], s["word"] + s["words"] - last["word"])
            last["end"] = max(last["end"], s["end"])
        else:
            out.append(dict(s))
    return out


def _cut(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """The texts without the spans: (bytes, offsets)."""
    gone = np.zeros(len(data) + 1, np.int64)
    np.add.at(gone, offsets[row] + start, 1)
    np.add.at(gone, offsets[row] + end, -1)
    keep = np.cumsum(gone[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], left[offsets]


def replaced(batch: pa.RecordBatch, text: str, data: np.ndarray, offsets: np.ndarray,
             chars: str | None = "n_chars") -> pa.RecordBatch:
    """``batch`` with other texts; null texts stay null, and the count of characters follows."""
    at = batch.schema.get_field_index(text)
    old = batch.column(at)
    new = pa.Array.from_buffers(pa.utf8(), len(old), [None, pa.py_buffer(offsets.astype(np.int32)),
                                                      pa.py_buffer(np.ascontiguousarray(data))])
    if old.null_count:
        new = pa.compute.if_else(old.is_valid(), new, pa.scalar(None, pa.utf8()))
    columns = list(batch.columns)
    columns[at] = new
    k = batch.schema.get_field_index(chars) if chars else -1
    if k >= 0 and pa.types.is_integer(columns[k].type):
        columns[k] = pa.compute.if_else(pa.compute.equal(old, new).fill_null(True), columns[k],
                                        pa.compute.utf8_length(new).cast(columns[k].type))
    return pa.RecordBatch.from_arrays(columns, batch.schema.names)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the benchmark's passages cut out of the texts; all rows and columns stay."""
    parts = list(blocks(benchmark, block_bytes=block_bytes))
    schema = docs.schema
    if len(parts) == 1:
        phrases = docs.sparkSession.sparkContext.broadcast(Phrases(parts[0]))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher = WordHasher(ALNUM)
            for part, data, offsets in slices(batches, text, SHARD_BYTES):
                found = ShardHits(phrases.value, hasher, data, offsets)
                if len(found.span_row):
                    part = replaced(part, text, *_cut(data, offsets, found.span_row, found.span_start, found.span_end))
                yield part

        return docs.mapInArrow(work, schema)
    # Spans of several passes are looked up by the text itself (its hash and size).
    key = F.sha2(F.col(f"`{text}`"), 256)
    keyed = docs.select(key.alias("id"), F.lit(0).cast("long").alias("h"), F.lit(0).alias("size"),
                        F.col(f"`{text}`").alias("text"))
    by, cuts = free_names(docs, "_k", "_spans")
    spans = _merged(keyed, parts).filter("n_hit > 0").select(F.col("id").alias(by), F.col("spans").alias(cuts))
    marked = docs.withColumn(by, key).join(spans, by, "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, text):
            found = part.column(part.num_columns - 1).to_pylist()
            row = np.repeat(np.arange(len(found)), [len(x or ()) for x in found]).astype(np.int64)
            start, end = (np.array([s[f] for x in found for s in x or ()], np.int64) for f in ("start", "end"))
            part = part.drop_columns([part.schema.names[-1]])
            yield replaced(part, text, *_cut(data, offsets, row, start, end)) if len(row) else part

    return marked.select(*[F.col(f"`{c}`") for c in docs.columns], cuts).mapInArrow(cut, schema)


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP10_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), p AS (
  SELECT DISTINCT item, list_slice(w, i + 1, i + 10) AS w FROM b, unnest(range(greatest(len(w) - 9, 1))) t(i) WHERE len(w) > 0
), o AS (
  SELECT doc_id, i, size, item FROM (
    SELECT doc_id, i, size, list_slice(d.w, i + 1, i + size) AS w
    FROM d, (SELECT DISTINCT len(w) AS size FROM p) s, unnest(range(len(d.w) - size + 1)) t(i)) JOIN p USING (w)
), h AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM o, unnest(range(i, i + size)) u(j) GROUP BY 1
), k AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)
"""
