"""Exact top-k search by inner product with a pivot-distance index.

Index. Every vector is keyed by its nearest pivot and the distance to it, and
all rows are sorted by that key. The sorted run is cut into segments: an annulus
around a pivot, with its inner and outer radius and greatest norm. Segments in
sorted order form groups of bounded size, the unit of work of a task.

Search. Since 2 q.x = |q|^2 + |x|^2 - |q - x|^2, and by the triangle inequality
|q - x| is at least the gap between d(q, p) and the annulus, a segment's scores
have an upper bound. Queries go in blocks. A block first expands the annuli of its
home group, nearest first, which gives each query a k-th score. Then it is sent to
exactly those groups in which some query's bound reaches its k-th score, expands
their annuli in the same way, and stops where no bound reaches it any more. Every
score is an exact integer. Nothing rests on the bounds being tight: where vectors
have no clusters (random directions), most groups are visited, and the work is
that of the queries against all rows, in blocks.

Rows with one key (a third of all rows may be one vector) are split by their
place in the scan. A task holds one group of at most ``GROUP_BYTES`` and one block.
The driver holds a sample for the pivots (``SAMPLE_ROWS`` rows and ``SAMPLE_BYTES``
at most, picked by hash), a count per partition and one line per group and pivot.

Defined results: vectors that are null or hold null or non-finite components
take no part; vectors of different lengths are compared as if the shorter ended
in zeros, so an empty one scores 0; equal scores are ordered by id, a null id
(never a query) first, then by place in the index; rows that repeat, also in
their id, are rows of their own: each is a candidate for the others, and each
query row has its own result; scores too large for a long are its largest or
smallest value; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.store import partitions, read, saved, temporary
from tablejobs.llm.textbatch import binary_array

#: Components are multiplied by this and floored.
SCALE = 64
PIVOTS = 32
#: Bounds of the sample that pivots are fitted on.
SAMPLE_ROWS, SAMPLE_BYTES = 4096, 32 << 20
#: Rows and bytes (as doubles) of a segment, rows of a query block, and bounds of a group.
SEGMENT, SEGMENT_BYTES, BLOCK = 1024, 8 << 20, 512
GROUP_ROWS, GROUP_BYTES = 4096, 64 << 20
#: Stored integers by kind; of kind ``WIDE`` are vectors whose products need more than a double.
KINDS = (np.int8, np.int16, np.int32)
WIDE = len(KINDS)
#: Greatest squared norm whose products are exact in doubles.
EXACT = 2.0**52
#: Rounding of bounds, in parts of the squared norms.
SLACK = 1e-5
NO_ID = -(2**63)

LONG = np.iinfo(np.int64)


def segment_rows(dims: int) -> int:
    return max(1, min(SEGMENT, SEGMENT_BYTES // (8 * max(dims, 1))))


def pack(vectors: np.ndarray, kind: int) -> bytes:
    if kind == WIDE:
        return ",".join(map(str, vectors.ravel())).encode()
    return np.ascontiguousarray(vectors, KINDS[kind]).tobytes()


def unpack(blob: bytes, kind: int, rows: int, dims: int) -> np.ndarray:
    """Doubles, or Python integers for kind ``WIDE``."""
    if kind == WIDE:
        return np.array(list(map(int, blob.decode().split(","))), object).reshape(rows, dims)
    return np.frombuffer(blob, KINDS[kind]).reshape(rows, dims).astype(np.float64)


def squares(vectors: np.ndarray) -> np.ndarray:
    """Squared norms; infinite for kind ``WIDE``."""
    if vectors.dtype == object:
        return np.full(len(vectors), np.inf)
    return np.einsum("ij,ij->i", vectors, vectors)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of both, as longs."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    if a.dtype != object and b.dtype != object:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    return np.array([[max(LONG.min, min(LONG.max, sum(int(x) * y for x, y in zip(row, other)))) for other in whole]
                     for row in a], np.int64).reshape(len(a), len(b))


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """From each row to each pivot; 0 for kind ``WIDE``."""
    if vectors.dtype == object:
        return np.zeros((len(vectors), len(pivots)))
    d = min(vectors.shape[1], pivots.shape[1])
    square = squares(vectors)[:, None] + squares(pivots) - 2 * (vectors[:, :d] @ pivots[:, :d].T)
    return np.sqrt(np.maximum(square, 0))


def fit_pivots(sample: np.ndarray, count: int = PIVOTS, passes: int = 6) -> np.ndarray:
    """Centres of the sample by Lloyd's passes from different rows of it."""
    if not len(sample):
        return np.zeros((1, 1))
    different = np.unique(sample, axis=0)
    centres = different[:: max(1, len(different) // count)][:count].astype(np.float64)
    for _ in range(passes):
        nearest = distances(sample, centres).argmin(1)
        for k in range(len(centres)):
            mine = sample[nearest == k]
            if len(mine):
                centres[k] = mine.mean(0)
    return centres


def quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(floor(SCALE * x), kind of each row) of rows of finite doubles."""
    with np.errstate(over="ignore"):
        v = np.floor(SCALE * values)
        norm = squares(v)
    kind = np.full(len(v), WIDE)
    for k in range(WIDE - 1, -1, -1):
        limit = np.iinfo(KINDS[k])
        kind[(norm <= EXACT) & (v >= limit.min).all(1) & (v <= limit.max).all(1)] = k
    return v, kind


def _exact(row: np.ndarray) -> bytes:
    return ",".join(str(math.floor(Fraction(float(x)) * SCALE)) for x in row).encode()


def usable(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return df.filter(v.isNotNull() & fine).select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"), v.alias("vector"))


def sample_pivots(rows: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    count = min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * max(longest, 1)))
    picked = rows.orderBy(F.xxhash64("id", "vector"), "id").limit(max(count, 1)).collect()
    sample = np.zeros((len(picked), max(longest, 1)))
    for k, row in enumerate(picked):
        sample[k, :len(row["vector"])] = row["vector"]
    v, kind = quantised(sample)
    return fit_pivots(v[kind != WIDE], pivots)


_KEYED = "kind int, dims int, pivot int, dist double, scan long, id long, square double, body binary"
_SEGMENT = ("part int, at long, kind int, dims int, pivot int, lo double, hi double, norm double, n int, "
            "ids binary, body binary")


def index(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The segments of (id, vector) rows, numbered in sorted order: ``at`` is the number of
    a segment's first row."""
    spark = rows.sparkSession

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, scan, column = (batch.column(i) for i in range(3))
            at = np.asarray(column.offsets).astype(np.int64)
            values = np.asarray(column.values, np.float64)
            length = np.diff(at)
            for d in np.unique(length).tolist():
                here = np.flatnonzero(length == d)
                raw = values[at[here][:, None] + np.arange(d)]
                v, kinds = quantised(raw)
                for k in np.unique(kinds).tolist():
                    mine = np.flatnonzero(kinds == k)
                    n, taken = len(mine), pa.array(here[mine])
                    if k == WIDE:
                        pivot, dist, norm = np.full(n, -1), np.zeros(n), np.full(n, np.inf)
                        body = pa.array([_exact(raw[i]) for i in mine], pa.binary())
                    else:
                        away = distances(v[mine], pivots)
                        pivot, norm = away.argmin(1), squares(v[mine])
                        dist = away[np.arange(n), pivot]
                        cells = np.ascontiguousarray(v[mine], KINDS[k]).view(np.uint8).ravel()
                        body = binary_array(cells, np.arange(n + 1) * (d * KINDS[k]().itemsize))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, k, np.int32)), pa.array(np.full(n, d, np.int32)),
                         pa.array(pivot.astype(np.int32)), pa.array(dist), scan.take(taken), ids.take(taken),
                         pa.array(norm), body], [c.split()[0] for c in _KEYED.split(", ")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            kind, dims, pivot, dist = (np.asarray(batch.column(i)) for i in range(4))
            ids, norm, body = np.asarray(batch.column(5)), np.asarray(batch.column(6)), batch.column(7)
            new = np.ones(len(kind), bool)
            new[1:] = (kind[1:] != kind[:-1]) | (dims[1:] != dims[:-1]) | (pivot[1:] != pivot[:-1])
            heads = np.append(np.flatnonzero(new), len(kind))
            out = []
            for a, b in zip(heads[:-1].tolist(), heads[1:].tolist()):
                step = segment_rows(int(dims[a]))
                for lo in range(a, b, step):
                    hi = min(b, lo + step)
                    k = int(kind[lo])
                    blob = (b"," if k == WIDE else b"").join(body[lo:hi].to_pylist())
                    out.append((part, done + lo, k, int(dims[lo]), int(pivot[lo]), float(dist[lo]),
                                float(dist[hi - 1]) if k != WIDE else math.inf, float(norm[lo:hi].max()), hi - lo,
                                ids[lo:hi].tobytes(), blob))
            done += len(kind)
            if out:
                yield _batch(out, _arrow(_SEGMENT))

    keyed = rows.select("id", F.monotonically_increasing_id().alias("scan"), "vector").mapInArrow(key, _KEYED)
    order = ["kind", "dims", "pivot", "dist", "scan"]
    ranged = saved(keyed, "pivot_keys").repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order) \
        .select("kind", "dims", "pivot", "dist", "scan", "id", "square", "body")
    segments = saved(ranged.mapInArrow(cut, _SEGMENT), "pivot_segments")
    counts = sorted((r["part"], r["n"]) for r in segments.groupBy("part").agg(F.sum("n").alias("n")).collect())
    starts = list(zip((part for part, _ in counts), accumulate((n for _, n in counts), initial=0)))
    # One row per range partition, whatever the number of vectors.
    first = F.broadcast(spark.createDataFrame(starts, "part int, _first long"))
    return segments.join(first, "part").withColumn("at", F.col("at") + F.col("_first")).drop("part", "_first")


_KINDS_OF = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _KINDS_OF[c.split()[1]]) for c in schema.split(", ")])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), schema.types)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


class Hits:
    """The best ``k`` candidates of each query: parallel arrays query, score, id and row."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.queries = queries
        self.columns = [np.zeros(0, np.int64) for _ in range(4)]
        self.floor = np.full(queries, LONG.min)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        columns = [np.concatenate(c) for c in zip(self.columns, (query, score, ids, row))]
        query, score, ids, row = columns
        order = np.lexsort((row, ids, -score.astype(np.float64), query))
        if ((score > 2**52) | (score < -2**52)).any():  # not told apart as doubles
            order = np.array(sorted(range(len(score)), key=lambda i: (query[i], -int(score[i]), ids[i], row[i])))
        order = order.astype(np.int64)
        sorted_query = query[order]
        rank = np.arange(len(order)) - np.searchsorted(sorted_query, sorted_query)
        kept = order[rank < self.k]
        self.columns = [c[kept] for c in columns]
        last = order[rank == self.k - 1]
        self.floor[query[last]] = score[last]


class Bounds:
    """Upper bounds of the scores of queries in annuli (pivot, lo, hi, norm)."""

    def __init__(self, pivots: np.ndarray, annuli: list[tuple[int, float, float, float]]):
        self.pivots = pivots
        pivot, self.lo, self.hi, self.norm = (np.array(c) for c in zip(*annuli))
        self.pivot = np.maximum(pivot.astype(np.int64), 0)

    def of(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(gap, bound) by query and annulus."""
        away = distances(queries, self.pivots)[:, self.pivot]
        gap = np.maximum(0, np.maximum(self.lo - away, away - self.hi))
        both = squares(queries)[:, None] + self.norm
        with np.errstate(invalid="ignore"):
            bound = (both * (1 + SLACK) - gap * gap) / 2 + 1
        return gap, np.where(np.isfinite(both), bound, np.inf)


class Group:
    """Neighbouring segments, searched together."""

    def __init__(self, segments: list[dict], pivots: np.ndarray):
        self.segments = segments
        self.bounds = Bounds(pivots, [(s["pivot"], s["lo"], s["hi"], s["norm"]) for s in segments])
        self.vectors = [unpack(s["body"], s["kind"], s["n"], s["dims"]) for s in segments]
        self.ids = [np.frombuffer(s["ids"], np.int64) for s in segments]

    def expand(self, queries: np.ndarray, rows: np.ndarray, hits: Hits) -> None:
        """Visit the annuli by their distance from the queries (numbers ``rows``) as long
        as a bound reaches a query's k-th score."""
        gap, bound = self.bounds.of(queries)
        for s in np.argsort(gap.mean(0), kind="stable").tolist():
            open_ = np.flatnonzero(bound[:, s] >= hits.floor)
            if not len(open_):
                continue
            score = products(queries[open_], self.vectors[s])
            number = self.segments[s]["at"] + np.arange(score.shape[1])
            itself = number == rows[open_][:, None]
            limit = hits.floor[open_]
            if score.shape[1] > hits.k + 1:             # one of the best k + 1 may be the row itself
                place = score.shape[1] - hits.k - 1
                limit = np.maximum(limit, np.partition(score, place, axis=1)[:, place])
            q, c = np.nonzero((score >= limit[:, None]) & ~itself)
            if len(q):
                hits.add(open_[q], score[q, c], self.ids[s][c], number[c])


#: Query blocks with what is found so far; the columns of a hit are query (a place in the block), score, id and row.
_FOUND = "home long, no int, kind int, dims int, n int, ids binary, rows binary, body binary, hits binary"
_SENT = ("grp long, home long, no int, at long, kind int, dims int, pivot int, lo double, hi double, norm double, "
         "n int, ids binary, rows binary, body binary, floor binary")


def _found(home: int, no: int, kind: int, dims: int, ids: np.ndarray, rows: np.ndarray, body: bytes,
           hits: Hits) -> tuple:
    return (home, no, kind, dims, len(ids), ids.tobytes(), rows.tobytes(), body, np.stack(hits.columns).tobytes())


def search_home(segments: DataFrame, pivots: np.ndarray, k: int, every: int) -> DataFrame:
    """Query blocks (ids divisible by ``every``) with their best candidates in their own group."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for home, rows in groupby(_rows(batches), key=itemgetter("grp")):
            parts = list(rows)
            group, no = Group(parts, pivots), 0
            for (kind, dims), same in groupby(range(len(parts)), key=lambda i: (parts[i]["kind"], parts[i]["dims"])):
                same = list(same)
                ids = np.concatenate([group.ids[i] for i in same])
                rows = np.concatenate([parts[i]["at"] + np.arange(parts[i]["n"]) for i in same])
                asked = np.flatnonzero((ids != NO_ID) & (ids % every == 0))
                if not len(asked):
                    continue
                vectors = np.concatenate([group.vectors[i] for i in same])
                step = min(BLOCK, segment_rows(dims))
                for lo in range(0, len(asked), step):
                    mine = asked[lo:lo + step]
                    hits = Hits(len(mine), k)
                    group.expand(vectors[mine], rows[mine], hits)
                    yield _batch([_found(home, no, kind, dims, ids[mine], rows[mine], pack(vectors[mine], kind), hits)],
                                 _arrow(_FOUND))
                    no += 1

    return _by_group(segments).mapInArrow(work, _FOUND)


def _by_group(df: DataFrame) -> DataFrame:
    first = ["grp", "home", "no", "at"] if "home" in df.columns else ["grp", "at"]
    return df.repartition(partitions(df.sparkSession), "grp").sortWithinPartitions(*first)


def _floors(found: dict, k: int) -> np.ndarray:
    query, score, _, _ = np.frombuffer(found["hits"], np.int64).reshape(4, -1)
    floor, count = np.full(found["n"], LONG.max), np.bincount(query, minlength=found["n"])
    np.minimum.at(floor, query, score)
    floor[count < k] = LONG.min
    return floor


def send(found: DataFrame, annuli: list[tuple], pivots: np.ndarray, k: int) -> DataFrame:
    """The queries of each block for each group but its own in which a bound reaches their
    k-th score. ``annuli``: (group, pivot, lo, hi, norm)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = np.array([a[0] for a in annuli], np.int64)
        bounds = Bounds(pivots, [a[1:] for a in annuli])
        for block in _rows(batches):
            vectors = unpack(block["body"], block["kind"], block["n"], block["dims"])
            ids, rows = (np.frombuffer(block[c], np.int64) for c in ("ids", "rows"))
            floor = _floors(block, k)
            reached = bounds.of(vectors)[1] >= floor[:, None]
            for g in np.unique(groups[reached.any(0)]).tolist():
                if g == block["home"]:
                    continue
                mine = np.flatnonzero(reached[:, groups == g].any(1))
                yield _batch([(g, block["home"], block["no"], -1, block["kind"], block["dims"], 0, 0.0, 0.0, 0.0,
                               len(mine), mine.astype(np.int64).tobytes(), rows[mine].tobytes(),
                               pack(vectors[mine], block["kind"]), floor[mine].tobytes())], _arrow(_SENT))

    return found.mapInArrow(work, _SENT)


def search_sent(segments: DataFrame, sent: DataFrame, pivots: np.ndarray, k: int) -> DataFrame:
    """What the sent queries find in the groups they were sent to."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches), key=itemgetter("grp")):
            parts, group = [], None
            for row in rows:                            # a group's segments come first
                if row["home"] < 0:
                    parts.append(row)
                    continue
                group = group or Group(parts, pivots)
                asked, number, floor = (np.frombuffer(row[c], np.int64) for c in ("ids", "rows", "floor"))
                hits = Hits(len(asked), k)
                hits.floor = floor.copy()
                group.expand(unpack(row["body"], row["kind"], row["n"], row["dims"]), number, hits)
                if len(hits.columns[0]):
                    hits.columns[0] = asked[hits.columns[0]]
                    none = np.zeros(0, np.int64)
                    yield _batch([_found(row["home"], row["no"], row["kind"], row["dims"], none, none, b"", hits)],
                                 _arrow(_FOUND))

    empty = {"home": "long", "no": "int", "rows": "binary", "floor": "binary"}
    held = segments.select(*[F.lit(-1 if n in ("home", "no") else None).cast(kind).alias(n) if n in empty
                             else F.col(n) for n, kind in (c.split() for c in _SENT.split(", "))])
    return _by_group(held.unionByName(sent)).mapInArrow(work, _FOUND)


def merge(found: DataFrame, k: int) -> DataFrame:
    """The best of all that was found, one row per query and rank."""
    schema = "query_id long, rank int, vec_id long, score long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches), key=itemgetter("home", "no")):
            hits = ids = None
            for row in rows:                            # the home group's comes first
                if hits is None:
                    hits, ids = Hits(row["n"], k), np.frombuffer(row["ids"], np.int64)
                hits.add(*np.frombuffer(row["hits"], np.int64).reshape(4, -1))
            query, score, other, _ = hits.columns
            rank = np.arange(len(query)) - np.searchsorted(query, query) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[query]), pa.array(rank.astype(np.int32)), pa.array(other, mask=other == NO_ID),
                 pa.array(score)], names=_arrow(schema).names)

    return found.repartition(partitions(found.sparkSession), "home", "no") \
        .sortWithinPartitions("home", "no", F.desc("n")).mapInArrow(work, schema)


def group_rows(rows: int, longest: int, tasks: int) -> int:
    """Rows of a group: as many groups as keep the tasks busy, not too small, and bounded in bytes."""
    return max(segment_rows(longest), min(max(GROUP_ROWS, rows // (4 * tasks)), GROUP_BYTES // (8 * max(longest, 1))))


def top_k(df: DataFrame, k: int, every: int, id_col: str = "vec_id", vector: str = "embedding",
          pivots: int = PIVOTS, rows_a_group: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best others of each row whose id is
    divisible by ``every``."""
    spark = df.sparkSession
    with temporary(spark):
        rows = usable(df, id_col, vector)
        centres = sample_pivots(rows, pivots)
        segments = index(rows, centres)
        total, longest = segments.agg(F.sum("n"), F.max("dims")).first()
        size = rows_a_group or group_rows(total or 0, longest or 1, partitions(spark))
        segments = saved(segments.withColumn("grp", F.expr(f"at div {size}")), "pivot_groups")
        annuli = [tuple(r) for r in segments.groupBy("grp", "pivot").agg(
            F.min("lo"), F.max("hi"), F.max("norm")).collect()]
        found = saved(search_home(segments, centres, k, every), "pivot_home")
        if len({a[0] for a in annuli}) > 1:
            sent = send(found, annuli, centres, k)
            found = found.unionByName(saved(search_sent(segments, sent, centres, k), "pivot_found"))
        return saved(merge(found, k), "pivot_top", keep=True)


def op13_pivot_search(spark, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), 20, 20)


OP13_SQL = """
WITH v AS (
    SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT q.n, q.vec_id AS query_id, c.vec_id, c.n AS other, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.n <> c.n),
ranked AS (
    SELECT query_id, vec_id, score,
           row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id NULLS FIRST, other) AS rank
    FROM pairs)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
