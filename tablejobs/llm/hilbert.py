"""Sharding along a Hilbert curve.

Several metadata columns are quantised into equally filled cells (numbers, dates,
times and booleans by their quantiles, strings by the exact quantiles of all their
whole values), each row gets the index of its cell on a Hilbert curve
through all of them, rows are sorted by
that index and the sorted run is cut into shards of equal row counts (law
``rows``: counts differ by one at most). Neighbours on the curve are neighbours
in every dimension, so a shard's (and a file's) minimum and maximum of each
column are close together and readers can skip whole files.

Texts are never shuffled: only the id, size, checksum and curve index are. The
sort is a range exchange with the id as last key, so one cell holding a third
of the rows is still split over tasks. Rows are numbered inside each range
partition as they stream past; the driver sees one count per partition.

Defined results: null metadata sorts as the smallest value of its column, NaN as the
largest; a null text has size 1 and checksum 0; equal rows are interchangeable, each
gets a slot of its own; dimensions of nested kinds are refused; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.llm.store import free_names, partitions, read, saved, temporary

#: Bits per dimension: columns are cut into at most 2 ** BITS cells.
BITS = 8
SHARDS = 8


#: Different strings of a dimension that the driver holds at most, and bytes of each. Where there
#: are more or longer ones, those held only deal all of them to tasks: they decide no cell.
SAMPLE_VALUES, SAMPLE_BYTES = 10_000, 1600


def is_text(kind: str) -> bool:
    return kind == "binary" or kind.split("(")[0] in ("string", "varchar", "char")


def ordinal(column: Column, kind: str) -> Column:
    """A value in the order of the column: the bytes of a string, else a double (null: null)."""
    if is_text(kind):
        return column.cast("binary")
    plain = kind.split("(")[0]
    if plain in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"):
        value = column.cast("double")
        return F.when(F.isnan(value), F.lit(math.inf)).otherwise(value)
    if plain == "boolean":
        return column.cast("int").cast("double")
    if plain == "date":
        return F.unix_date(column).cast("double")
    if plain in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    raise TypeError(f"a dimension can't be of kind {kind}")


def cell_starts(firsts: dict[int, int], number: int) -> list[int]:
    """Places, in the order of ``number`` different values, of those that start a cell.
    ``firsts``: for each count of borders between cells that rows of smaller values
    cross, the place of the first value behind so many. A cell has one value at least."""
    starts: list[int] = []
    runs = sorted(firsts.items())
    for (borders, first), end in zip(runs, [first for _, first in runs[1:]] + [number]):
        starts += range(first, min(end, first + borders - len(starts)))
    return starts


def text_cuts(values: DataFrame, cells: int) -> list[bytes]:
    """Cuts of the column ``v`` into cells of about equal row counts, by all its different
    values and their counts. The driver goes through them where they are few and short; else
    they are dealt to ranges, sorted and counted there, and only the cuts come back."""
    counted = values.filter("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n"))
    found = counted.select(F.substring("v", 1, SAMPLE_BYTES).alias("v"), F.octet_length("v").alias("size"), "n",
                           F.xxhash64("v").alias("hash")) \
        .orderBy("hash").limit(SAMPLE_VALUES + 1).repartition(1).collect()    # picked by a task, not by the driver
    if len(found) > SAMPLE_VALUES or any(r["size"] > SAMPLE_BYTES for r in found):
        return ranged_cuts(counted, sorted({bytes(r["v"]) for r in found}), cells)
    found = sorted((bytes(r["v"]), r["n"]) for r in found)
    total, before, firsts = sum(n for _, n in found), 0, {}
    for at, (_, n) in enumerate(found):
        firsts.setdefault(before * cells // total, at)
        before += n
    return [found[at][0] for at in cell_starts(firsts, len(found))]


def ranged_cuts(counted: DataFrame, bounds: list[bytes], cells: int) -> list[bytes]:
    """The cuts for values ``v`` with counts ``n``. ``bounds`` part them into ranges, which
    may differ in size; each is sorted by itself (values that only differ behind the longest
    bound are in one), the driver sees one row per range and per cell."""
    spark = counted.sparkSession

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = pa.array([bisect_right(bounds, v) for v in batch.column(0).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, part], ["v", "n", "_part"])

    run = Window.partitionBy("_part").orderBy("v")
    through = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    with temporary(spark):
        ranked = saved(counted.mapInArrow(deal, "v binary, n long, _part int").select(
            "v", "n", "_part", (F.row_number().over(run) - 1).alias("_at"),
            (F.sum("n").over(through) - F.col("n")).alias("_before")), "text_ranges")
        total, number, starts = 0, 0, []
        for part, rows, different in sorted(ranked.groupBy("_part").agg(F.sum("n"), F.count("*")).collect()):
            starts.append((part, total, number))
            total, number = total + rows, number + different
        # One row per range, whatever the number of values.
        offsets = F.broadcast(spark.createDataFrame(starts, "_part int, _rows long, _values long"))
        placed = ranked.join(offsets, "_part").select(
            "v", (F.col("_values") + F.col("_at")).alias("at"),
            F.expr(f"(_rows + _before) * {cells}L div {total}L").alias("borders"))
        firsts = dict(placed.groupBy("borders").agg(F.min("at")).collect())
        cuts = placed.filter(F.col("at").isin(cell_starts(firsts, number))).select("v").collect()
    return sorted(bytes(r["v"]) for r in cuts)


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of each row of ``cells`` (rows x dimensions, values below 2 ** bits),
    by undoing, bit by bit, the rotations and reflections of the curve's sub-cubes."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[dims - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    index = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


def curve_order(df: DataFrame, dims: list[str], keep: list[Column], bits: int = BITS) -> DataFrame:
    """``keep`` plus ``curve``, the row's Hilbert index over ``dims``."""
    if len(dims) * bits > 62:
        raise ValueError("dimensions times bits must stay below 63")
    kinds = dict(df.dtypes)
    mine = [f"_dim{i}" for i in range(len(dims))]
    kept = df.select(*keep).columns
    keyed = df.select(*keep, *[ordinal(F.col(f"`{d}`"), kinds[d]).alias(m) for d, m in zip(dims, mine)])
    cells = 1 << bits
    at = [k / cells for k in range(1, cells)]
    numbers = [m for d, m in zip(dims, mine) if not is_text(kinds[d])]
    found = keyed.agg(*[F.percentile_approx(m, at, 10_000).alias(m) for m in numbers]).first() if numbers else {}
    cuts = [np.unique(np.asarray(found[m] or [], np.float64)) if m in numbers
            else text_cuts(keyed.select(F.col(m).alias("v")), cells) for m in mine]
    names = kept

    def cell(column: pa.Array, cut) -> np.ndarray:
        if isinstance(cut, np.ndarray):
            return np.searchsorted(cut, np.asarray(column.fill_null(-math.inf)), side="left")
        coded = column.dictionary_encode()
        place = np.array([bisect_right(cut, v) for v in coded.dictionary.to_pylist()] + [0], np.int64)
        return place[np.asarray(coded.indices.fill_null(len(place) - 1))]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [cell(batch.column(len(names) + i), cut) for i, cut in enumerate(cuts)]
            curve = hilbert_index(np.stack(cols, 1), bits)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(curve)], [*names, "curve"])

    schema = ", ".join(f"`{n}` {k}" for n, k in keyed.dtypes if n in names)
    return keyed.mapInArrow(index, f"{schema}, curve long")


def place(keyed: DataFrame, order: list[str], shards: int = SHARDS) -> DataFrame:
    """Sort by ``order`` over all rows and cut equal counts: adds ``shard`` and ``slot``."""
    spark = keyed.sparkSession
    names = keyed.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)),
                 pa.array(np.arange(at, at + n, dtype=np.int64))], [*names, "_part", "_at"])
            at += n

    schema = ", ".join(f"`{n}` {k}" for n, k in keyed.dtypes)
    ranged = keyed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    numbered = saved(ranged.mapInArrow(number, f"{schema}, _part int, _at long"), "curve_runs")
    counts = sorted((r["_part"], r["count"]) for r in numbered.groupBy("_part").count().collect())
    first, starts = 0, []
    for part, count in counts:
        starts.append((part, first))
        first += count
    total = max(first, 1)
    # One row per range partition, whatever the number of documents.
    offsets = F.broadcast(spark.createDataFrame(starts, "_part int, _first long"))
    rank = F.col("_first") + F.col("_at")
    placed = numbered.join(offsets, "_part").withColumn("_rank", rank)
    placed = placed.withColumn("shard", F.expr(f"_rank * {shards} div {total}").cast("int"))
    return placed.withColumn("slot", F.col("_rank") - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")) \
        .select(*[F.col(f"`{n}`") for n in names], "shard", "slot")


def shard_documents(docs: DataFrame, dims: list[str], shards: int = SHARDS, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Per document: id, size, text_crc32, curve, shard and slot."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = curve_order(docs, dims, [
        F.col(f"`{id_col}`").alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32")])
    return place(keyed, ["curve", "id", "text_crc32", "size"], shards).withColumnRenamed("id", id_col)


def write_shards(docs: DataFrame, dims: list[str], path: str, shards: int = SHARDS) -> None:
    """Write whole documents by shard (folders ``shard=0`` and on), in curve order inside
    each, for file pruning. Rows are told apart by a number of their own, given in a copy
    in the shared folder: null and repeated ids lose or double nothing."""
    spark = docs.sparkSession
    (row,) = free_names(docs, "_row")
    if "shard" in map(str.casefold, docs.columns):
        raise ValueError("docs has a column named shard")
    with temporary(spark):
        own = saved(docs.withColumn(row, F.monotonically_increasing_id()), "shard_rows")
        keyed = curve_order(own, dims, [F.col(row).alias("id")])
        placed = place(keyed, ["curve", "id"], shards).select(F.col("id").alias(row), "shard", "slot")
        at, = free_names(own, "_slot")
        joined = own.join(placed.withColumnRenamed("slot", at), row).drop(row)
        (joined.repartitionByRange(partitions(spark), "shard", at)
         .sortWithinPartitions("shard", at).drop(at).write.partitionBy("shard").parquet(path))


def op4_hilbert_sharding(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    placed = shard_documents(docs, ["lang", "source", "n_chars"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")
