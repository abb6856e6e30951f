"""Exact Jaccard join of shingle sets by universe partition and pigeonhole.

Two sets of sizes a and b with similarity of 0.8 or more differ in at most
(a + b) / 9 elements. Sets are put into size bands. In a band, hashing cuts the
universe of shingles into segments; a segment's subset either has to be equal
(weight 1) or may differ by one deletion (weight 2). When the weights add up to
more than the greatest difference in the band, similar sets agree in some
segment, by its subset or its one-deletion neighbourhood. The allocation of
weights to segments is chosen per band by the expected cost: signatures written
against segments that are likely to be empty.

Empty subsets agree by accident, so they aren't indexed; each band has some more
weight than needed, so that every set may leave out empty segments up to that
slack. A set with more of them is overloaded and does index them; as whatever
pair agrees in empty segments alone is overloaded on both sides, nothing is lost.

Sets that share a signature form a group. Every candidate pair is first held against
its sizes and parity sketches (a bit or two per element), which bound the number of
differing elements from below; sets are shuffled for pairs within the bound only, and
links are verified exactly, on the sets themselves:
 1. each set against one hub, the smallest within the bound of any group it is in;
 2. the other hubs of its groups, where they are in another component by then;
 3. within a family (the groups of one hub), each set against the nearest one of another
    component, twice; then all pairs of a family that still are in different components.
    Families are compared in blocks.
After that, every two sets with a signature in common have been ruled out, verified or
connected, so the components are exact. Pairs inside a component are not all verified
for that; ``similar_pairs`` is the join itself, which verifies all pairs of a family
within the sketches' bound and so returns every link.

Equal sets are one class from the start (known by a 64-bit digest), so that a
text that a third of the rows repeat is indexed once per task.

Ids must be integers. Defined results: null texts, and texts without words, have an
empty set and are linked with nothing; fewer than five words are one shingle; a null
id counts as the smallest long; rows with the same id and text are one document, rows
with the same id and other texts (null ids too) are documents of their own, told apart
by a hash of the text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.components import join_labels
from tablejobs.llm.repeats import _unpack
from tablejobs.llm.store import free_names, partitions, read, saved, temporary
from tablejobs.llm.textbatch import SPACED, U64, WordHasher, binary_array, kept, mix, row_counts, slices, trim_memory

SHINGLE = 5
#: Similarity threshold: THRESHOLD[0] / THRESHOLD[1]
THRESHOLD = (4, 5)
#: Members of a family compared with each other in one block.
BLOCK = 1024
#: Bytes of text handled at once: shingles and signatures take many times as much.
SLICE = 1 << 20
_NULL_ID = -(2**63)
#: Pairs of 16 bytes that are broadcast at most.
BROADCAST_PAIRS = 500_000
#: Classes of 24 bytes that are broadcast to find their texts at most.
BROADCAST_SETS = 500_000
#: What an expected overloaded set costs, in signatures per element.
_OVERLOAD_COST = 8.0


# ------------------------------------------------------------------- shingles

def _hasher() -> WordHasher:
    """The worker's hasher; what the worker kept for other operators goes."""
    trim_memory()
    return kept("jaccard", lambda: WordHasher(SPACED))


def shingles(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """(row, 52-bit shingle) of the distinct shingles of each text, sorted."""
    n_rows = len(offsets) - 1
    starts, ends, row = hasher.words(data, offsets)
    words = hasher.hashes(data, starts, ends)
    n = len(words)
    factors = mix(np.arange(11, 11 + SHINGLE, dtype=U64)) | U64(1)
    count = row_counts(row, n_rows)
    first = np.append(0, np.cumsum(count))[:-1]
    if n >= SHINGLE:
        h = words[:n - SHINGLE + 1] * factors[0]
        for j in range(1, SHINGLE):
            h += words[j:n - SHINGLE + 1 + j] * factors[j]
        whole = row[:n - SHINGLE + 1] == row[SHINGLE - 1:]
        h, of = mix(h[whole]), row[:n - SHINGLE + 1][whole]
    else:
        h, of = np.zeros(0, U64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        s = np.zeros(len(short), U64)
        for j in range(SHINGLE - 1):
            has = count[short] > j
            s[has] += words[first[short[has]] + j] * factors[j]
        h = np.append(h, mix(s + count[short].astype(U64)))
        of = np.append(of, short)
    # The row above the shingle: one sort for all texts of the slice.
    key = np.unique((of.astype(U64) << U64(52)) | (h >> U64(12)))
    return (key >> U64(52)).astype(np.int64), key & U64((1 << 52) - 1)


def digests(row: np.ndarray, shingle: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, class) of each text's set; the class of an empty set is 0."""
    size = row_counts(row, n_rows)
    total = np.zeros(n_rows, U64)
    has = np.flatnonzero(size)
    if len(row):
        head = np.append(0, np.cumsum(size[has]))[:-1]
        total[has] = np.add.reduceat(mix(shingle + U64(0x51ED270B)), head)
    cls = mix(total + size.astype(U64) * U64(0x9E3779B97F4A7C15)).view(np.int64).copy()
    cls[size == 0] = 0
    return size, cls


# ----------------------------------------------------------------- allocation

def band_of(size: int) -> int:
    """The band a size falls in: bands reach from L to 1.25 L."""
    band, low = 0, 1
    while size > low * 5 // 4:
        low = low * 5 // 4 + 1
        band += 1
    return band


@lru_cache(maxsize=None)
def band_limits(band: int) -> tuple[int, int]:
    low = 1
    for _ in range(band):
        low = low * 5 // 4 + 1
    return low, low * 5 // 4


def _tail(mean: float, more_than: int) -> float:
    """P(X > more_than) for a Poisson X."""
    term, total = math.exp(-mean), 0.0
    for k in range(more_than + 1):
        total += term
        term *= mean / (k + 1)
    return max(0.0, 1.0 - total)


@lru_cache(maxsize=None)
def allocation(band: int) -> tuple[int, int, int]:
    """(segments that must be equal, segments that may differ by one deletion, slack):
    the cheapest for a set at the band's lower end. The weights exceed the greatest
    difference in the band by the slack plus one."""
    low, high = band_limits(band)
    most = 2 * high // 9
    if most == 0:
        return 1, 0, 0
    size, best = 0.9 * low, None
    slacks = sorted({round(x) for x in np.linspace(0, 4 + most // 4, 24)})
    for slack in slacks:
        need = most + 1 + slack
        for share in (0.0, 0.1, 0.25, 0.5, 0.75, 1.0):
            loose = math.ceil(need / 2 * share)
            strict = max(0, need - 2 * loose)
            segments = strict + loose
            fill = size / segments
            empty, single = math.exp(-fill), fill * math.exp(-fill)
            skipped = strict * empty + 2 * loose * (empty + single)
            spent = slack // 2 if strict == 0 else slack
            over = _tail(skipped / 2 if strict == 0 else skipped, spent)
            cost = strict + loose * (fill + 1) + over * _OVERLOAD_COST * size
            if best is None or cost < best[0]:
                best = cost, strict, loose, strict + 2 * loose - most - 1
    return best[1:]


# ----------------------------------------------------------------- signatures

def signatures(row: np.ndarray, shingle: np.ndarray, size: np.ndarray, band: np.ndarray):
    """(row, signature) of all indexed subsets, each text taken as a member of ``band[row]``
    (-1: none)."""
    n_rows = len(size)
    plans = {b: allocation(b) for b in np.unique(band[band >= 0]).tolist()}
    strict, loose, slack = (np.array([plans[b][i] if b >= 0 else 0 for b in band.tolist()], np.int64) for i in range(3))
    segments = strict + loose
    base = np.append(0, np.cumsum(segments))
    inside = band[row] >= 0
    row, shingle = row[inside], shingle[inside]
    x = mix(shingle)
    seg = ((x >> U64(32)) * segments[row].astype(U64) >> U64(32)).astype(np.int64)
    place = base[row] + seg
    y = mix(shingle ^ U64(0x5BF03635D1E3A7C9))
    low, high = (y & U64((1 << 26) - 1)).astype(np.float64), (y >> U64(38)).astype(np.float64)
    total = int(base[-1])
    # Sums of 26-bit parts are exact in doubles; they stand for the subset.
    sum_low, sum_high = (np.bincount(place, v, total) for v in (low, high))
    count = np.bincount(place, minlength=total)
    owner = np.repeat(np.arange(n_rows), segments)
    local = np.arange(total) - base[owner]
    spot = mix(band[owner].astype(U64) << U64(32) | local.astype(U64))
    may_delete = local >= strict[owner]

    def signature(at, lows, highs):
        return mix(spot[at] ^ mix(lows.astype(U64) * U64(0xD6E8FEB86659FD93) + highs.astype(U64) * U64(0xA0761D6478BD642F)))

    full = np.flatnonzero(count)
    rows, sigs = [owner[full]], [signature(full, sum_low[full], sum_high[full])]
    deleted = np.flatnonzero(may_delete[place] & (count[place] > 1))
    at = place[deleted]
    rows.append(owner[at])
    sigs.append(signature(at, sum_low[at] - low[deleted], sum_high[at] - high[deleted]))
    # Segments whose agreement could be on nothing, and the sets with too many of them.
    hollow = np.where(may_delete, count <= 1, count == 0)
    weight = np.bincount(owner[hollow], np.where(may_delete[hollow], 2, 1), n_rows)
    listed = np.flatnonzero(hollow & (weight > slack)[owner])
    rows.append(owner[listed])
    sigs.append(mix(spot[listed] + U64(1)))
    return np.concatenate(rows), np.concatenate(sigs)


def bands_for(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(own band, next band or -1) of each size: the next one's smallest sets may match too."""
    own = np.full(len(size), -1, np.int64)
    after = own.copy()
    for s in np.unique(size[size > 0]).tolist():
        b = band_of(s)
        own[size == s] = b
        if s * THRESHOLD[1] >= band_limits(b + 1)[0] * THRESHOLD[0]:
            after[size == s] = b + 1
    return own, after


def signature_groups(docs: DataFrame, buckets: int) -> DataFrame:
    """(hub, c): the classes ``c`` that share a signature of which the smallest class is ``hub``."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for part, data, offsets in slices(batches, limit=SLICE):
            row, shingle = shingles(data, offsets, hasher)
            size, cls = digests(row, shingle, part.num_rows)
            keep = np.zeros(part.num_rows, bool)
            keep[np.unique(cls, return_index=True)[1]] = True
            keep &= size > 0
            found = [signatures(row, shingle, size, np.where(keep, b, -1)) for b in bands_for(size)]
            r, sig = (np.concatenate(x) for x in zip(*found))
            if not len(r):
                continue
            bucket = (sig >> U64(32)).astype(np.int64) % buckets
            order = np.lexsort((r, bucket))
            r, sig, bucket = r[order], sig[order], bucket[order]
            heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            runs = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (r[1:] != r[:-1])))
            cuts = np.append(heads, len(r))
            run_cuts = np.append(np.searchsorted(runs, heads), len(runs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[heads].astype(np.int32)), binary_array((sig & U64(0xFFFFFFFF)).astype(np.uint32), cuts),
                 binary_array((sig >> U64(32) & U64(0xFFFF)).astype(np.uint16), cuts),
                 binary_array(cls[r[runs]], run_cuts),
                 binary_array(np.diff(np.append(runs, len(r))).astype(np.uint32), run_cuts)],
                ["bucket", "low", "high", "c", "n"])

    def group(table: pa.Table) -> pa.Table:
        sig = _unpack(table["low"], np.uint32)[0].astype(U64) | _unpack(table["high"], np.uint16)[0].astype(U64) << U64(32)
        c = np.repeat(_unpack(table["c"], np.int64)[0], _unpack(table["n"], np.uint32)[0])
        order = np.argsort(sig)
        s = sig[order]
        same = s[1:] == s[:-1]
        shared = order[np.append(same, False) | np.append(False, same)]
        sig, c = sig[shared], c[shared]
        order = np.lexsort((c, sig))
        sig, c = sig[order], c[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (c[1:] != c[:-1])
        sig, c = sig[new], c[new]
        head = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, np.int64)
        hub = np.repeat(c[head], np.diff(np.append(head, len(sig))))
        order = np.lexsort((c, hub))
        hub, c = hub[order], c[order]
        new = np.ones(len(c), bool)
        new[1:] = (hub[1:] != hub[:-1]) | (c[1:] != c[:-1])
        new &= hub != c
        return pa.table([pa.array(hub[new]), pa.array(c[new])], names=["hub", "c"])

    packed = docs.mapInArrow(collect, "bucket int, low binary, high binary, c binary, n binary")
    return packed.groupBy("bucket").applyInArrow(group, "hub long, c long").distinct()


# --------------------------------------------------------------- verification

def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return THRESHOLD[1] * both >= THRESHOLD[0] * (len(a) + len(b) - both)


def _set(low, high) -> np.ndarray:
    return np.frombuffer(low, np.uint32).astype(U64) | np.frombuffer(high, np.uint16).astype(U64) << U64(32)


def sketches(row: np.ndarray, shingle: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, cuts): for each text a power of two of bits, the set's size or more;
    each element flips the bit it is hashed to. Two sets differ in as many elements as
    their sketches do in bits, at least."""
    bits = 1 << np.ceil(np.log2(np.maximum(size, 256))).astype(np.int64)
    base = np.append(0, np.cumsum(bits))
    place = (mix(shingle) & (bits[row] - 1).astype(U64)).astype(np.int64)
    odd = np.bincount(base[row] + place, minlength=int(base[-1])) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little"), base >> 3


def class_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(c, low, high): the sets of the wanted classes (k, h, c), packed, one row each."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, done = _hasher(), set()
        for part, data, offsets in slices(batches, limit=SLICE):
            row, shingle = shingles(data, offsets, hasher)
            cuts = np.append(0, np.cumsum(row_counts(row, part.num_rows)))
            new = []
            for c in part.column(1).to_pylist():        # rows that repeat are one set
                new.append(c not in done)
                done.add(c)
            yield pa.RecordBatch.from_arrays(
                [part.column(1), binary_array((shingle & U64(0xFFFFFFFF)).astype(np.uint32), cuts),
                 binary_array((shingle >> U64(32) & U64(0xFFFF)).astype(np.uint16), cuts)],
                ["c", "low", "high"]).filter(pa.array(new))

    small = wanted.count() <= BROADCAST_SETS
    sets = saved(docs.join(F.broadcast(wanted) if small else wanted, ["k", "h"]).select("text", "c").mapInArrow(
        build, "c long, low binary, high binary"), "jaccard_class_sets")
    if sets.count() > sets.select("c").distinct().count():      # rows that repeat in several tasks
        sets = saved(sets.dropDuplicates(["c"]), "jaccard_class_sets")
    return sets


def close_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sizes and sketches leave room for a link."""
    slim = classes.select("c", "n", "sketch")
    joined = pairs.join(slim.toDF("b", "n_b", "sketch_b"), "b").filter("n_b > 0").join(
        slim.toDF("a", "n_a", "sketch_a"), "a").filter("4 * n_a <= 5 * n_b and 4 * n_b <= 5 * n_a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.asarray(batch.column(2)) + np.asarray(batch.column(3))
            differ = [sketch_difference(np.frombuffer(x, U64), np.frombuffer(y, U64))
                      for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())]
            keep = pa.array(9 * np.array(differ, np.int64) <= both)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return joined.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(check, "a long, b long")


def sketch_difference(x: np.ndarray, y: np.ndarray) -> int:
    """A lower bound of the difference of two sets: the longer sketch is folded first."""
    while len(x) != len(y):
        x, y = (_fold(x), y) if len(x) > len(y) else (x, _fold(y))
    return int(np.bitwise_count(x ^ y).sum())


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (saved) pairs (a, b) of classes that link; up to BROADCAST_PAIRS pairs go by a broadcast."""
    pairs = F.broadcast(pairs) if pairs.count() <= BROADCAST_PAIRS else pairs
    joined = pairs.join(sets.toDF("b", "low_b", "high_b"), "b").join(sets.toDF("a", "low_a", "high_a"), "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [similar(_set(w.as_buffer(), x.as_buffer()), _set(y.as_buffer(), z.as_buffer()))
                  for w, x, y, z in zip(*(batch.column(i) for i in range(2, 6)))]
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return joined.select("a", "b", "low_a", "high_a", "low_b", "high_b").mapInArrow(check, "a long, b long")


def _fold(sketches: np.ndarray) -> np.ndarray:
    """Sketches of half as many bits."""
    half = sketches.shape[-1] // 2
    return sketches[..., :half] ^ sketches[..., half:]


class Block:
    """Sketches of a block's sets, by their number of 64-bit words."""

    def __init__(self, packed: list[bytes]):
        words = np.array([len(x) // 8 for x in packed])
        self.of = {int(w): np.flatnonzero(words == w) for w in np.unique(words)}
        self.at = np.empty(len(packed), np.int64)
        self.whole, self.halves = {}, {}
        for w, rows in self.of.items():
            self.at[rows] = np.arange(len(rows))
            self.whole[w] = np.frombuffer(b"".join(packed[i] for i in rows), U64).reshape(-1, w)
            self.halves[w] = _fold(self.whole[w]) if w > 1 else self.whole[w]
        self.words = words

    def differences(self, x: int, others: np.ndarray) -> np.ndarray:
        """Lower bounds of the differences between set ``x`` and others of about its size."""
        w, out = int(self.words[x]), np.zeros(len(others), np.int64)
        own, half = self.whole[w][self.at[x]], self.halves[w][self.at[x]]
        for k, (mine, theirs) in {w: (own, self.whole), 2 * w: (own, self.halves), w // 2: (half, self.whole)}.items():
            if k in self.of:
                some = np.flatnonzero(self.words[others] == k)
                out[some] = np.bitwise_count(theirs[k][self.at[others[some]]] ^ mine).sum(1)
        return out


def near_pairs(families: DataFrame, labels: DataFrame, sets: DataFrame, nearest: bool) -> DataFrame:
    """The pairs (a, b) of a family (hub, c) in different components that may link; with
    ``nearest``, just the nearest of each set and block. Families are dealt out in blocks.
    The members of a family's largest component meet the others but not each other, so a
    family of copies that are connected already costs no more than its size."""
    members = families.unionAll(families.select("hub", F.col("hub").alias("c")).distinct())
    mixed = members.join(labels.toDF("c", "label"), "c")
    torn = mixed.groupBy("hub", "label").agg(F.count("*").alias("m")).groupBy("hub").agg(
        F.max(F.struct("m", "label")).alias("most"), F.sum("m").alias("m")).filter("most.m < m").select(
        "hub", F.col("most.label").alias("largest"), F.ceil(F.col("most.m") / BLOCK).cast("int").alias("large"),
        F.ceil((F.col("m") - F.col("most.m")) / BLOCK).cast("int").alias("small"))
    dealt = mixed.join(torn, "hub").join(sets.select("c", "n", "sketch"), "c")
    inside, hash_ = F.col("label") == F.col("largest"), F.xxhash64("c")
    own = F.when(inside, F.pmod(hash_, F.col("large"))).otherwise(F.col("large") + F.pmod(hash_, F.col("small")))
    # Member i meets block j in the block pair (min, max).
    others = F.sequence(F.when(inside, F.col("large")).otherwise(0), F.col("large") + F.col("small") - 1)
    dealt = dealt.withColumn("own", own.cast("int")).withColumn("other", F.explode(others))
    dealt = dealt.select("hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         "own", "c", "label", "n", "sketch")

    def compare(table: pa.Table) -> pa.Table:
        own, c, label, n = (table[x].to_numpy() for x in ("own", "c", "label", "n"))
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        block = Block(table["sketch"].to_pylist())
        # By size: sets that may link are a stretch.
        right = np.flatnonzero(own == i)
        right = right[np.argsort(n[right], kind="stable")]
        sizes = n[right]
        a, b = [], []
        for x in np.flatnonzero(own == j):
            lo = np.searchsorted(sizes, -(-4 * n[x] // 5), side="left")
            hi = np.searchsorted(sizes, 5 * n[x] // 4, side="right")
            rest = right[lo:hi]
            rest = rest[label[rest] != label[x]]
            if i == j and not nearest:
                rest = rest[c[rest] > c[x]]
            if not len(rest):
                continue
            differ = block.differences(x, rest)
            close = 9 * differ <= n[rest] + n[x]
            rest, differ = rest[close], differ[close]
            if nearest and len(rest):
                rest = rest[[np.lexsort((c[rest], differ / (n[rest] + n[x])))[0]]]
            a.append(np.minimum(c[rest], c[x]))
            b.append(np.maximum(c[rest], c[x]))
        return pa.table([pa.array(np.concatenate(v) if v else np.zeros(0, np.int64)) for v in (a, b)], names=["a", "b"])

    return dealt.groupBy("hub", "i", "j").applyInArrow(compare, "a long, b long").distinct()


# -------------------------------------------------------------------- the join

def _key(id_col: str):
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NULL_ID))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, h, n, component, first) for every row: id (null: smallest long), hash of the text,
    set size, the smallest id reachable by links, and the hash of that id's text there."""
    spark = docs.sparkSession
    with temporary(spark):
        return saved(_components(docs, id_col, text), "jaccard_components", keep=True)


def similar_pairs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every link: (a, b) for each two classes of different sets that link, once, a < b; and
    (k, h, n, c, n_links) for every row, with its class and how many classes that links to.
    Rows of one class (equal sets, n > 0) are linked with each other besides."""
    with temporary(docs.sparkSession):
        slim, rows, classes, families, members = _prepared(docs, id_col, text)
        # Each class in a component of its own: no pair is left out.
        own = members.select("c", F.col("c").alias("label"))
        candidates = saved(near_pairs(families, own, classes, nearest=False), "jaccard_pairs")
        pairs = saved(verified(candidates, _sets_of(candidates, slim, classes)), "jaccard_all_links", keep=True)
        many = pairs.select(F.col("a").alias("c")).unionAll(pairs.select(F.col("b").alias("c"))) \
            .groupBy("c").agg(F.count("*").alias("n_links"))
        found = rows.join(many, "c", "left").select("k", "h", "n", "c", F.coalesce("n_links", F.lit(0)).alias("n_links"))
        return pairs, saved(found, "jaccard_members", keep=True)


def _prepared(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, ...]:
    """(texts, rows, classes, families, members): what the rounds of links work on."""
    parts = partitions(docs.sparkSession)
    slim = docs.select(_key(id_col).alias("k"), F.xxhash64(F.col(f"`{text}`")).alias("h"),
                       F.col(f"`{text}`").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for part, data, offsets in slices(batches, limit=SLICE):
            row, shingle = shingles(data, offsets, hasher)
            size, cls = digests(row, shingle, part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(size), pa.array(cls),
                 binary_array(*sketches(row, shingle, size))], ["k", "h", "n", "c", "sketch"])

    rows = saved(slim.mapInArrow(measure, "k long, h long, n long, c long, sketch binary"), "jaccard_sets")
    families = saved(signature_groups(slim, 4 * parts), "jaccard_families")
    members = saved(families.select("c").unionAll(families.select(F.col("hub").alias("c"))).distinct(), "jaccard_members")
    classes = saved(rows.filter("n > 0").groupBy("c").agg(
        F.min(F.struct("k", "h")).alias("r"), F.min("n").alias("n"), F.min("sketch").alias("sketch"))
        .select("c", "r.k", "r.h", "n", "sketch"), "jaccard_classes")
    return slim, rows, classes, families, members


def _sets_of(pairs: DataFrame, slim: DataFrame, classes: DataFrame) -> DataFrame:
    """The sets of the classes in ``pairs`` (a, b)."""
    ends = pairs.select(F.col("a").alias("c")).unionAll(pairs.select(F.col("b").alias("c"))).distinct()
    return class_sets(slim, saved(classes.select("c", "k", "h").join(ends, "c"), "jaccard_wanted"))


def _components(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    slim, rows, classes, families, members = _prepared(docs, id_col, text)
    least = F.min(F.struct("k", "h"))
    labels = saved(members.select(F.col("c").alias("node"), F.col("c").alias("label")), "jaccard_labels")

    def linked(pairs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """The labels after what links of the saved ``pairs``."""
        sets = _sets_of(pairs, slim, classes) if sets is None else sets
        return join_labels(labels, saved(verified(pairs, sets), "jaccard_links"))

    tried = families.toDF("a", "b")
    close = saved(close_pairs(tried, classes), "jaccard_close")
    sets = _sets_of(close, slim, classes)
    hubs = saved(close.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "jaccard_hubs")
    labels = linked(hubs, sets)
    la, lb = (labels.select(F.col("node").alias(x), F.col("label").alias(f"l{x}")) for x in ("a", "b"))
    others = close.join(hubs, ["a", "b"], "left_anti").join(la, "a").join(lb, "b").filter("la <> lb").select("a", "b")
    labels = linked(saved(others, "jaccard_pairs"), sets)
    for nearest in (True, True, False):
        pairs = near_pairs(families, labels, classes, nearest).join(tried, ["a", "b"], "left_anti")
        pairs = saved(pairs, "jaccard_pairs")
        labels = linked(pairs)
        tried = tried.unionAll(pairs)

    # The smallest id of each component, then each class's.
    named = classes.join(labels.toDF("c", "label"), "c", "left").select("c", "k", "h", F.coalesce("label", "c").alias("label"))
    named = saved(named, "jaccard_named")
    smallest = named.groupBy("label").agg(least.alias("r")).select(
        "label", F.col("r.k").alias("component"), F.col("r.h").alias("first"))
    of_class = named.join(smallest, "label").select("c", "component", "first")
    empty = rows.filter("n = 0").select("k", "h", "n", F.col("k").alias("component"), F.col("h").alias("first"))
    return rows.filter("n > 0").select("c", "k", "h", "n").join(of_class, "c").select(
        "k", "h", "n", "component", "first").unionAll(empty)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of linked documents, the one with the smallest id (of
    its texts there, the first by hash; one row of it, should it repeat); texts without
    words stay."""
    found = similar_components(docs, id_col, text)
    k, h = free_names(docs, "_k", "_h")
    stay = found.filter("k = component and h = first").select(F.col("k").alias(k), F.col("h").alias(h)).distinct()
    keyed = docs.withColumns({k: _key(id_col), h: F.xxhash64(F.col(f"`{text}`"))})
    return keyed.join(stay, [k, h]).dropDuplicates([k, h]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_jaccard(spark, sf_dir: str) -> DataFrame:
    found = similar_components(read(spark, sf_dir, "documents").select("doc_id", "text"))
    back = lambda c: F.when(F.col(c) != _NULL_ID, F.col(c))
    return found.select(back("k").alias("doc_id"), F.col("n").alias("n_shingles"), back("component").alias("component_id"))


OP6_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS shingle
  FROM d, unnest(range(greatest(len(w) - 4, 1))) t(i) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), l AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (shingle)
    WHERE x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n m ON m.doc_id = a JOIN n o ON o.doc_id = b WHERE 100 * c >= 80 * (m.n + o.n - c)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY 1, 2
"""
