"""Removal of repeated passages by threshold-bounded interval expansion.

Every byte covered by a ``LENGTH``-byte string that also starts earlier in the
corpus (smaller document id, or earlier in the same document) is removed.

A suffix array of the whole corpus would be one task's work, so strings are
dealt out first, without losing any match: each ``LENGTH``-byte string is known
by its anchor, the ``ANCHOR``-byte piece in it with the smallest hash (the first
of equals). Equal strings have equal anchors. Neighbouring strings share theirs,
so a document becomes segments, each the bytes of consecutive strings with one
anchor.

1. Anchors are counted; a segment whose anchor is seen once cannot repeat.
2. Segments with repeated anchors go to the bucket of their anchor, each
   distinct one once per task with the places where it occurs. Strings of an
   anchor with more than ``HOT`` places are dealt out by the hash of the whole
   string instead, so a passage that a third of all rows share is spread.
3. In each bucket, equal segments become one, and anchors are counted again: a
   distinct segment whose anchor no other one has shares no string with another. The
   rest are suffix sorted and transformed (Burrows-Wheeler). Starting from the interval of all suffixes, intervals of
   longer and longer strings are found breadth first by backward extension.
   Each new right end gets the current length as its common prefix, so values
   are derived in increasing order; the expansion stops at ``LENGTH``, and
   neighbours without a value by then share at least that much.
4. Spans are gathered per document and cut out.

Ids must be integers. Defined results: null texts are empty; a null id counts
as smaller than all others; rows with the same id and text are one document and
get the same result each; rows with the same id (or none) and other texts are
documents of their own, in the order of a hash of their texts; an empty table
gives an empty result; other columns pass unchanged.

A document is known by its id ``k`` and a tag ``t``: the hash of its text where some
id has several texts, else 0, which costs next to nothing in packed columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.decontamination import replaced
from tablejobs.llm.store import free_names, partitions, read, saved, temporary
from tablejobs.llm.suffixes import bwt, suffix_array
from tablejobs.llm.textbatch import (
    U64,
    WordHasher,
    binary_array,
    inverse,
    mix,
    ranges,
    slices,
    text_view,
    word_table,
)

#: Bytes of a repeated string, and of its anchor.
LENGTH = 100
ANCHOR = 32
#: Places from which on an anchor's strings are dealt out by their own hash.
HOT = 20_000

_NULL_ID = -(2**63)


def piece_hashes(hasher: WordHasher, data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size``-byte piece."""
    n = len(data)
    if n < size:
        return np.zeros(0, U64)
    power = hasher.powers(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum(hasher.values[data] * power[:n], out=sums[1:])
    h = sums[size:] - sums[:-size]
    h *= power[n - size + 1:0:-1] if size == n else power[n - np.arange(n - size + 1)]
    return mix(h * inverse(power[n]))


def segments(hasher: WordHasher, data: np.ndarray, offsets: np.ndarray, length: int = LENGTH,
             anchor: int = ANCHOR):
    """(row, start in the slice, number of strings, anchor hash) of each segment."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, np.zeros(0, U64)
    hashes = piece_hashes(hasher, data, anchor)
    # The hash with the place below it: the minimum is the first of equals.
    bits = U64(max(1, n.bit_length()))
    key = hashes >> bits << bits
    key |= np.arange(len(key), dtype=U64)
    span, width = length - anchor + 1, 1
    while width * 2 <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < span:
        key = np.minimum(key[:len(key) - (span - width)], key[span - width:])
    place = (key & ((U64(1) << bits) - U64(1))).astype(np.int64)
    valid = np.zeros(len(place) + 1, np.int64)      # strings inside one document
    lens = np.diff(offsets)
    at = offsets[:-1][lens >= length]
    np.add.at(valid, at, 1)
    np.add.at(valid, offsets[1:][lens >= length] - length + 1, -1)
    strings = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    if not len(strings):
        return none, none, none, np.zeros(0, U64)
    place = place[strings]
    row = np.searchsorted(offsets, strings, side="right") - 1
    new = np.ones(len(strings), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(strings)))
    return row[first], strings[first], count, hashes[place[first]]


def _by_bucket(bucket: np.ndarray, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """One row per bucket: the bucket and, packed, its share of each column."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    first = np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else np.zeros(0, np.int64)
    cuts = np.append(first, len(b))
    return pa.RecordBatch.from_arrays(
        [pa.array(b[first].astype(np.int32)), *[binary_array(c[order], cuts) for c in columns]], ["bucket", *names])


def _unpack(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(all values, values per row) of a column of packed arrays."""
    parts = [np.frombuffer(x.as_buffer(), dtype) for x in column]
    return (np.concatenate(parts) if parts else np.zeros(0, dtype)), np.array([len(p) for p in parts], np.int64)


def _hasher() -> WordHasher:
    return WordHasher(word_table([]), fold=False)


def _documents(ids: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each place's document, ids and tags of the documents), in their order."""
    order = np.lexsort((tags, ids))
    i, t = ids[order], tags[order]
    new = np.ones(len(i), bool)
    new[1:] = (i[1:] != i[:-1]) | (t[1:] != t[:-1])
    number = np.empty(len(i), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, i[new], t[new]


def _tagged(docs: DataFrame, id_col: str, text: str) -> tuple[Column, Column]:
    """The columns of ``docs`` that tell documents apart: id and tag."""
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NULL_ID))
    hashed = F.xxhash64(F.col(f"`{text}`"))
    several = docs.select(key.alias("k"), hashed.alias("t")).groupBy("k").agg(
        F.min("t").alias("low"), F.max("t").alias("high")).filter("low <> high")
    return key, F.lit(0).cast("long") if several.isEmpty() else hashed


def repeated_anchors(slim: DataFrame, length: int, anchor: int, buckets: int) -> DataFrame:
    """Per document and bucket of anchors: packed starts, string counts, anchors and heat
    of its segments whose anchor occurs more than once."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for part, data, offsets in slices(batches):
            row, start, count, h = segments(hasher, data, offsets, length, anchor)
            if len(row):
                ids, tags = (np.asarray(part.column(i), np.int64) for i in (0, 1))
                yield _by_bucket((h >> U64(32)).astype(np.int64) % buckets,
                                 [h, ids[row], tags[row], (start - offsets[row]).astype(np.uint32),
                                  count.astype(np.uint16)], ["h", "id", "tag", "start", "n"])

    packed = slim.mapInArrow(collect, "bucket int, h binary, id binary, tag binary, start binary, n binary")

    def repeated(table: pa.Table) -> pa.Table:
        h, _ = _unpack(table["h"], U64)
        order = np.argsort(h, kind="stable")
        s = h[order]
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        size = np.diff(np.append(first, len(s)))
        places = np.empty(len(h), np.int64)
        places[order] = np.repeat(size, size)
        some = np.flatnonzero(places > 1)
        ids, tags, start, n = (_unpack(table[c], t)[0][some] for c, t in
                               (("id", np.int64), ("tag", np.int64), ("start", np.uint32), ("n", np.uint16)))
        hot = (places[some] > HOT).astype(np.uint8)
        number, ids, tags = _documents(ids, tags)
        order = np.argsort(number, kind="stable")
        cuts = np.append(0, np.cumsum(np.bincount(number, minlength=len(ids))))
        return pa.table([pa.array(ids), pa.array(tags),
                         *[binary_array(x[order], cuts) for x in (start, n, h[some], hot)]],
                        names=["k", "t", "start", "n", "h", "hot"])

    return packed.groupBy("bucket").applyInArrow(
        repeated, "k long, t long, start binary, n binary, h binary, hot binary")


def bucketed_segments(slim: DataFrame, marks: DataFrame, length: int, buckets: int) -> DataFrame:
    """The marked segments with their bytes, each distinct one once per slice of a task."""
    gathered = marks.groupBy("k", "t").agg(*[F.collect_list(c).alias(c) for c in ("start", "n", "h", "hot")])
    joined = slim.join(gathered, ["k", "t"]).select("k", "t", "text", "start", "n", "h", "hot")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for part, data, offsets in slices(batches):
            cols = [[np.frombuffer(b"".join(x), t) for x in part.column(i).to_pylist()]
                    for i, t in ((3, np.uint32), (4, np.uint16), (5, U64), (6, np.uint8))]
            row = np.repeat(np.arange(part.num_rows), [len(x) for x in cols[0]])
            start, n, h, hot = (np.concatenate(c) for c in cols)
            start, n = start.astype(np.int64), n.astype(np.int64)
            fits = start + n + length - 1 <= np.diff(offsets)[row]
            row, start, n, h, hot = (x[fits] for x in (row, start, n, h, hot))
            # Strings of hot anchors become segments of their own.
            many = hot.astype(bool)
            each = np.where(many, n, 1)
            row, h, many = (np.repeat(x, each) for x in (row, h, many))
            start = ranges(start, each)
            n = np.where(many, 1, np.repeat(n, each))
            size = n + length - 1
            at = offsets[row] + start
            content = hasher.passages(data, at, at + size)
            target = np.where(many, content, h)
            bucket = (target >> U64(33)).astype(np.int64) % buckets
            ids, tags = (np.asarray(part.column(i), np.int64)[row] for i in (0, 1))
            anchors = (target & U64(0xFFFFFFFF)).astype(np.uint32)
            yield from _packed_segments(bucket, content, anchors, ids, tags, start, size, at, data)

    return joined.mapInArrow(
        collect, "bucket int, id binary, tag binary, start binary, which binary, size binary, anchor binary, body binary")


def _packed_segments(bucket, content, anchors, ids, tags, start, size, at, data) -> Iterator[pa.RecordBatch]:
    if not len(bucket):
        return
    order = np.lexsort((content, bucket))
    b, c = bucket[order], content[order]
    new = np.append(True, (b[1:] != b[:-1]) | (c[1:] != c[:-1]))
    first = order[new]                                # one place of each distinct segment
    which = np.cumsum(new) - 1
    heads = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
    occ = np.append(heads, len(b))                    # places per bucket
    seg = np.append(which[heads], len(first))         # distinct segments per bucket
    body = data[ranges(at[first], size[first])]
    ends = np.append(0, np.cumsum(size[first]))
    # Numbers of segments count from the bucket's first.
    local = which - np.repeat(seg[:-1], np.diff(occ))
    yield pa.RecordBatch.from_arrays(
        [pa.array(b[heads].astype(np.int32)), binary_array(ids[order], occ),
         binary_array(tags[order], occ), binary_array(start[order].astype(np.uint32), occ), binary_array(local.astype(np.uint32), occ),
         binary_array(size[first].astype(np.uint16), seg), binary_array(anchors[first], seg),
         binary_array(body, ends[seg])],
        ["bucket", "id", "tag", "start", "which", "size", "anchor", "body"])


def prefix_groups(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, group of each suffix in that order): neighbours are in one group
    when they share their first ``length`` symbols.

    ``symbols`` ends with a unique smallest 0. Interval expansion: level by level, the
    intervals of all strings ``c + w`` are found from the interval of ``w`` through the
    transform; a right end that is new at this level has a common prefix of ``len(w)``
    with its neighbour, and only such intervals are expanded further."""
    order = suffix_array(symbols)
    n = len(symbols)
    transform = bwt(symbols, order).astype(np.int16)
    by_symbol = np.argsort(transform, kind="stable")
    back = np.empty(n, np.int64)                      # place of the suffix one symbol longer
    back[by_symbol] = np.arange(n)
    del by_symbol
    known = np.zeros(n + 1, bool)                     # right ends with a common prefix found so far
    known[[0, n]] = True
    lo, hi = np.array([0]), np.array([n])
    for _ in range(length):
        if not len(lo):
            break
        size = hi - lo
        places = ranges(lo, size)
        images = back[places]
        owner = np.repeat(np.arange(len(lo)), size)
        # Images of one interval under one symbol lie side by side.
        by_image = np.argsort(images)
        images, owner, symbol = images[by_image], owner[by_image], transform[places][by_image]
        new = np.ones(len(images), bool)
        new[1:] = (images[1:] != images[:-1] + 1) | (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(images)) - 1
        lo, hi = images[first], images[last] + 1
        fresh = ~known[hi]
        lo, hi = lo[fresh], hi[fresh]
        known[hi] = True
    return order, np.cumsum(known[:-1])


def repeated_spans(ids: np.ndarray, start: np.ndarray, which: np.ndarray, size: np.ndarray, anchor: np.ndarray,
                   body: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, start, end) of spans to remove, for one bucket: the places (id, start, number of
    the segment) of distinct segments of the given sizes, anchors (hashed) and bytes."""
    order = np.lexsort((start, ids, which))
    w = which[order]
    head = np.append(True, w[1:] != w[:-1])
    first = order[head]                               # where each segment occurs first
    # The same place twice (a repeated row) is no repetition of itself.
    copy = ~head & ((ids[order] != ids[first[w]]) | (start[order] != start[first[w]]))
    again = order[copy]
    spans = [(ids[again], start[again], start[again] + size[which[again]])]
    # Strings are in segments with their anchor, and one segment has each of its strings once.
    _, of, many = np.unique(anchor, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(many[of] > 1)
    body = body[ranges(np.append(0, np.cumsum(size))[shared], size[shared])]
    first, size = first[shared], size[shared]
    at = np.append(0, np.cumsum(size + 1))
    symbols = np.ones(int(at[-1]) + 1, np.int32)
    symbols[ranges(at[:-1], size)] = body.astype(np.int32) + 2
    symbols[-1] = 0
    suffixes, group = prefix_groups(symbols, length)
    # Suffixes that start a whole string, with the place it occurs first.
    many = size - length + 1
    strings = ranges(at[:-1], many)
    owner = np.repeat(np.arange(len(size)), many)
    offset = strings - at[owner]
    of = np.empty(len(symbols), np.int64)
    of[suffixes] = group
    g = of[strings]
    count = np.bincount(g)
    some = np.flatnonzero(count[g] > 1)
    g, owner, offset = g[some], owner[some], offset[some]
    sid, spos = ids[first[owner]], start[first[owner]] + offset
    order = np.lexsort((spos, sid, g))
    g, sid, spos = g[order], sid[order], spos[order]
    head = np.append(True, g[1:] != g[:-1]) if len(g) else np.zeros(0, bool)
    leader = np.maximum.accumulate(np.where(head, np.arange(len(g)), 0))
    later = (sid != sid[leader]) | (spos != spos[leader])
    spans.append((sid[later], spos[later], spos[later] + length))
    return tuple(np.concatenate(x) for x in zip(*spans))


def merge(ids: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Spans sorted by id and start, those that touch joined."""
    if not len(ids):
        return ids, start, end
    order = np.lexsort((start, ids))
    ids, start, end = ids[order], start[order], end[order]
    block = np.cumsum(np.append(0, ids[1:] != ids[:-1]))
    step = int(end.max()) + 1
    reach = np.maximum.accumulate(end + block * step) - block * step
    new = np.append(True, (ids[1:] != ids[:-1]) | (start[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    return ids[first], start[first], reach[np.append(first[1:], len(ids)) - 1]


def spans_by_document(packed: DataFrame, length: int) -> DataFrame:
    """Per bucket and document: packed starts and ends of the spans to remove."""

    def expand(table: pa.Table) -> pa.Table:
        ids, per_row = _unpack(table["id"], np.int64)
        ids, known, tags = _documents(ids, _unpack(table["tag"], np.int64)[0])
        start = _unpack(table["start"], np.uint32)[0].astype(np.int64)
        which = _unpack(table["which"], np.uint32)[0].astype(np.int64)
        size, segs = _unpack(table["size"], np.uint16)
        size = size.astype(np.int64)
        body = _unpack(table["body"], np.uint8)[0]
        which += np.repeat(np.append(0, np.cumsum(segs))[:-1], per_row)
        # Segments that several tasks sent become one.
        distinct = binary_array(body, np.append(0, np.cumsum(size))).dictionary_encode()
        number = distinct.indices.to_numpy().astype(np.int64)
        first = np.unique(number, return_index=True)[1]
        anchor = _unpack(table["anchor"], np.uint32)[0][first]
        body, at = text_view(distinct.dictionary)
        found = repeated_spans(ids, start, number[which], np.diff(at), anchor, body, length)
        ids, start, end = merge(*found)
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, np.int64)
        cuts = np.append(first, len(ids))
        return pa.table([pa.array(known[ids[first]]), pa.array(tags[ids[first]]),
                         binary_array(start.astype(np.uint32), cuts), binary_array(end.astype(np.uint32), cuts)],
                        names=["k", "t", "start", "end"])

    return packed.groupBy("bucket").applyInArrow(expand, "k long, t long, start binary, end binary")


def repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
            anchor: int = ANCHOR) -> DataFrame:
    """(k, t, start, end): per document (id, null ids as the smallest long, and tag), packed
    spans to remove."""
    return _repeats(docs, *_tagged(docs, id_col, text), text, length, anchor)


def _repeats(docs: DataFrame, key: Column, tag: Column, text: str, length: int, anchor: int = ANCHOR) -> DataFrame:
    spark = docs.sparkSession
    parts = partitions(spark)
    slim = docs.select(key.alias("k"), tag.alias("t"), F.col(f"`{text}`").alias("text"))
    with temporary(spark):
        marks = saved(repeated_anchors(slim, length, anchor, 2 * parts), "repeat_anchors")
        spans = saved(spans_by_document(bucketed_segments(slim, marks, length, 4 * parts), length),
                      "repeat_spans", keep=True)
    return spans.groupBy("k", "t").agg(
        F.collect_list("start").alias("start"), F.collect_list("end").alias("end"))


def _gone(part: pa.RecordBatch, at: int, offsets: np.ndarray) -> np.ndarray:
    """For each byte of a slice, whether it is removed; spans are in columns ``at`` and ``at + 1``."""
    starts, ends = ([np.frombuffer(b"".join(x or ()), np.uint32) for x in part.column(i).to_pylist()]
                    for i in (at, at + 1))
    row = np.repeat(np.arange(part.num_rows), [len(x) for x in starts])
    limit = offsets[1:][row]
    mark = np.zeros(int(offsets[-1]) + 1, np.int64)
    np.add.at(mark, np.minimum(offsets[row] + np.concatenate(starts), limit), 1)
    np.add.at(mark, np.minimum(offsets[row] + np.concatenate(ends), limit), -1)
    return np.cumsum(mark[:-1]) > 0


def _marked(docs: DataFrame, id_col: str, text: str, length: int) -> DataFrame:
    key, tag = _tagged(docs, id_col, text)
    k, t, start, end = free_names(docs, "_k", "_t", "_start", "_end")
    spans = _repeats(docs, key, tag, text, length).toDF(k, t, start, end)
    return docs.withColumns({k: key, t: tag}).join(spans, [k, t], "left").select(
        *[F.col(f"`{c}`") for c in docs.columns], start, end)


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans and the digest of what is left."""
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches):
            gone = _gone(part, 2, offsets)
            n = part.num_rows
            row = np.repeat(np.arange(n), np.diff(offsets))
            begins = gone.copy()
            begins[1:] &= ~gone[:-1] | (row[1:] != row[:-1])
            left = np.append(0, np.cumsum(~gone))[offsets]
            rest = data[~gone].tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(offsets)), pa.array(np.bincount(row[gone], minlength=n)),
                 pa.array(np.bincount(row[begins], minlength=n)),
                 pa.array([hashlib.sha256(rest[a:b]).hexdigest() for a, b in zip(left[:-1].tolist(), left[1:].tolist())],
                          pa.string())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = dict(slim.dtypes)["id"]
    return _marked(slim, "id", "text", length).mapInArrow(
        digest, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string") \
        .withColumnRenamed("id", id_col)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` without the repeated bytes; all rows and columns stay. A character of
    which only some bytes are left goes too."""
    schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, text):
            gone = _gone(part, part.num_columns - 2, offsets)
            part = part.select(part.schema.names[:-2])
            if gone.any():
                lead = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, np.arange(len(data)), 0))
                broken = np.zeros(len(data), bool)
                broken[lead[gone]] = True             # characters with a byte removed
                gone = broken[lead]
                left = np.append(0, np.cumsum(~gone))[offsets]
                part = replaced(part, text, data[~gone], left)
            yield part

    return _marked(docs, id_col, text, length).mapInArrow(cut, schema)


def op8_suffix_repeats(spark, sf_dir: str) -> DataFrame:
    return repeat_digests(read(spark, sf_dir, "documents").select("doc_id", "text"))
