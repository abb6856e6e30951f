"""The registered jobs: one function per inventory key, ``(spark, sf_dir) -> DataFrame``.

Each job reads the supplied tables (or files Spark writes from them) in full.
Jobs that exercise sinks, round trips and the catalog write below the shared
scratch root and work in a database of their own, so reruns never collide.
The weather roles of the teaching notebooks map onto the supplied tables as
follows: ``events`` plays the station readings (user_id = station,
event_type = unit, value = temperature), ``lineitem`` the large fact table,
``part`` a failing and ``customer`` a passing consistency check.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from tablejobs import catalog
from tablejobs import operators as ops
from tablejobs.operators.actions import partition_profile
from tablejobs.schemas import CUSTOMER_SCHEMA, EVENTS_DDL, TABLE_DDL
from tablejobs.session import scratch_path, table_path, unique_name
from tablejobs.sources import (
    NULL_MARKER_OPTIONS,
    conform,
    raw_preview,
    read_csv,
    read_csv_exact,
    read_files,
    read_json,
    read_parquet,
    schema_audit,
    write_csv,
    write_csv_exact,
    write_files,
    write_numbered,
    write_with_inventory,
)

Job = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table read with its declared schema: no footer job when the
    DataFrame is defined (``parquet_inferred`` shows the embedded schema)."""
    return read_parquet(spark, table_path(sf_dir, name), TABLE_DDL[name])


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem")


# ---------------------------------------------------------------- aggregation

def group_count(spark, sf_dir):
    """Flagship: group by two keys, count, rename, sort."""
    return ops.group_count(_lineitem(spark, sf_dir), "l_returnflag", "l_linestatus",
                           name="counts")


def group_count_one(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return ops.group_count(events, "user_id", name="counts", order=False)


def view_counts_coded(spark, sf_dir):
    """Temp view with the measured value as a grouping key, sorted by the positions of
    the keys."""
    events = _table(spark, sf_dir, "events")
    counted = ops.group_count(events, "user_id", "event_type", "value", name="n_readings", order=False)
    counted = ops.sort_by_position(counted, 1, 2, 3)
    return catalog.view_from_df(counted, unique_name("station_counts"))


def view_counts_spec(spark, sf_dir):
    """Temp view of the recorded (non-NULL) values per station and unit."""
    events = _table(spark, sf_dir, "events")
    counted = ops.count_values(events, "user_id", "event_type", value="value", name="n_readings")
    return catalog.view_from_df(counted, unique_name("station_counts"))


def group_sum(spark, sf_dir):
    """Re-aggregation: sum of the flagship counts per status."""
    return ops.group_sum(group_count(spark, sf_dir), "l_linestatus", "counts", name="total")


def row_count(spark, sf_dir):
    return ops.row_count(_lineitem(spark, sf_dir))


def distinct_count(spark, sf_dir):
    return ops.distinct_count(_lineitem(spark, sf_dir), "l_partkey")


def unit_stats(spark, sf_dir):
    return ops.stats_by(_table(spark, sf_dir, "events"), "event_type", "value")


def filter_post_agg(spark, sf_dir):
    return ops.having_count(_lineitem(spark, sf_dir), "l_suppkey", ">", 600, name="counts")


# ----------------------------------------------------- projections and filters

def select_cols(spark, sf_dir):
    return ops.select_cols(_lineitem(spark, sf_dir), "l_orderkey", "l_shipdate")


def filter_eq(spark, sf_dir):
    return ops.filter_eq(_lineitem(spark, sf_dir), "l_returnflag", "R")


def filter_like(spark, sf_dir):
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return ops.filter_like(part, "p_name", "%ring%")


def drop_cols(spark, sf_dir):
    return ops.drop_cols(_table(spark, sf_dir, "orders"), "o_orderpriority")


def derive_cols(spark, sf_dir):
    return ops.derive_dates(_table(spark, sf_dir, "orders"), "o_orderdate", keep=("o_orderkey",))


def convert_units(spark, sf_dir):
    # In the supplied events the 'click' rows play the Fahrenheit readings and the
    # 'view' rows the Celsius ones; the other types are no temperature.
    return ops.convert_units(_table(spark, sf_dir, "events"), "value", "event_type",
                             fahrenheit="click", celsius="view", keep=("event_id",))


# ------------------------------------------------------ sort, distinct, top-n

def distinct_rows(spark, sf_dir):
    return ops.distinct_rows(_table(spark, sf_dir, "part"), "p_name")


def top_n(spark, sf_dir):
    return ops.top_n(_table(spark, sf_dir, "orders"), 20, "o_orderkey")


def first_row(spark, sf_dir):
    return ops.first_row(_table(spark, sf_dir, "orders"), "o_orderkey")


def reduce_row(spark, sf_dir):
    return ops.max_row(_table(spark, sf_dir, "orders"), "o_totalprice", "o_orderkey")


#: The prime the keys' product is taken by.
FOLD_PRIME = 2**31 - 1


def fold_any_rows(spark, sf_dir) -> DataFrame:
    """What ``fold_any`` folds: a one and a number from 1 to the prime less 1 per line."""
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return _lineitem(spark, sf_dir).select(F.lit(1).cast("bigint").alias("n"),
                                           (1 + key % (FOLD_PRIME - 1)).alias("product"))


def fold_any(spark, sf_dir):
    """A fold that no aggregate expresses: the number of lines and the product of their
    keys modulo a prime."""
    def merge(a, b, prime=FOLD_PRIME):
        return a[0] + b[0], a[1] * b[1] % prime

    def fold_batch(batch, prime=FOLD_PRIME):
        n, left = batch.num_rows, np.asarray(batch.column(1))
        while len(left) > 1:                # halves are multiplied pairwise; one may be left over
            half = len(left) // 2
            left = np.append(left[:half] * left[half:2 * half] % prime, left[2 * half:])
        return n, int(left[0])

    return ops.fold_any(fold_any_rows(spark, sf_dir), merge, fold_batch)


# ----------------------------------------------------------- consistency check

def fd_check(spark, sf_dir):
    return ops.fd_summary(_table(spark, sf_dir, "part"), "p_name", ["p_brand", "p_type"])


def fd_pass(spark, sf_dir):
    return ops.fd_summary(_table(spark, sf_dir, "customer"), "c_custkey",
                          ["c_name", "c_nationkey"])


def fd_violations(spark, sf_dir):
    return ops.fd_violations(_table(spark, sf_dir, "part"), "p_name", ["p_brand", "p_type"])


# ------------------------------------------------ partitioning, reuse, staging

def seven_steps_plan(spark, sf_dir) -> DataFrame:
    """Steps 1-6: read -> select -> filter -> groupBy/count -> select -> filter.
    Two stages around one shuffle: steps 1-4a pipeline in the map stage,
    4b-6 in the reduce stage."""
    return (_lineitem(spark, sf_dir)                                    # 1 read
            .select("l_suppkey", "l_returnflag")                        # 2 select
            .filter(F.col("l_returnflag") == "A")                       # 3 filter
            .groupBy("l_suppkey").count()                               # 4 groupBy/count
            .select("l_suppkey", F.col("count").alias("n"))             # 5 select
            .filter(F.col("n") > 200))                                  # 6 filter


def seven_steps(spark, sf_dir):
    """The six steps above, then step 7: write the result as Parquet."""
    out = scratch_path(spark, "seven_steps")
    write_files(seven_steps_plan(spark, sf_dir), out, "parquet", "overwrite")
    return read_parquet(spark, out)


def _parts(spark: SparkSession) -> int:
    return max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))


def repartition_rows(spark, sf_dir):
    """All orders dealt out evenly, whatever their keys (wide)."""
    return ops.spread(_table(spark, sf_dir, "orders"), _parts(spark))


def repartition_coalesce(spark, sf_dir):
    """The same rows, with neighbouring partitions then merged without another
    shuffle (narrow); many tasks still read them."""
    return ops.narrow_to(repartition_rows(spark, sf_dir), _parts(spark) // 2)


#: The keys of the counts that the reuse jobs make once and sum up twice.
_REUSED = ["o_orderstatus", "o_orderpriority"]


def _reused_counts(spark, sf_dir) -> DataFrame:
    return ops.group_count(_table(spark, sf_dir, "orders"), *_REUSED, name="n", order=False)


def cache_parts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(cached counts per status and priority, both totals made from them). The
    aggregate is cached after the groupBy and read by two consumers; call
    ``unpersist()`` on the first when done."""
    counted = ops.cached(_reused_counts(spark, sf_dir))
    return counted, ops.totals_by_each(counted, _REUSED, "n")


def cache_reuse(spark, sf_dir):
    """Both totals from counts that are cached, and released after the second one."""
    path = scratch_path(spark, "cache_reuse")
    with ops.held(_reused_counts(spark, sf_dir)) as counted:
        write_files(ops.totals_by_each(counted, _REUSED, "n"), path, "parquet")
    return read_parquet(spark, path)


def shuffle_reuse(spark, sf_dir):
    """Both totals from the same counts in one query: Spark runs the counts' shuffle
    once and reads it twice; nothing is kept."""
    return ops.totals_by_each(_reused_counts(spark, sf_dir), _REUSED, "n")


def checkpoint_reuse(spark, sf_dir):
    """Both totals from counts checkpointed to the shared folder: a lost executor
    costs a read of those files, not the scan."""
    return ops.totals_by_each(ops.checkpointed(_reused_counts(spark, sf_dir)), _REUSED, "n")


def partition_profile_job(spark, sf_dir):
    """A user function per partition (Arrow batches), summed to one row."""
    shipdates = _lineitem(spark, sf_dir).select("l_shipdate")
    return partition_profile(
        shipdates,
        lambda batch: {"n_rows": batch.num_rows,
                       "n_ship": batch.num_rows - batch.column(0).null_count},
        ["n_rows", "n_ship"])


# ------------------------------------------------------------ sources (scans)

def _written_customer_csv(spark, sf_dir, **options) -> str:
    path = scratch_path(spark, "customer_csv")
    write_csv(_table(spark, sf_dir, "customer"), path, "overwrite", **options)
    return path


def csv_infer(spark, sf_dir):
    return read_csv(spark, _written_customer_csv(spark, sf_dir), header=True, infer_schema=True)


def csv_schema(spark, sf_dir):
    return read_csv(spark, _written_customer_csv(spark, sf_dir), header=True,
                    schema=CUSTOMER_SCHEMA)


def csv_strings(spark, sf_dir):
    return read_csv(spark, _written_customer_csv(spark, sf_dir), header=True)


def csv_noheader(spark, sf_dir):
    path = scratch_path(spark, "supplier_csv")
    write_csv(_table(spark, sf_dir, "supplier"), path, "overwrite", header=False)
    return read_csv(spark, path, header=False)


def csv_delim(spark, sf_dir):
    path = _written_customer_csv(spark, sf_dir, sep="|")
    return read_csv(spark, path, header=True, schema=CUSTOMER_SCHEMA, sep="|")


def parquet_inferred(spark, sf_dir):
    """The schema stored in the file (timestamps come back as timestamp_ntz
    under Spark's default ``spark.sql.parquet.inferTimestampNTZ.enabled``)."""
    return read_parquet(spark, table_path(sf_dir, "orders"))


def parquet_struct(spark, sf_dir):
    schema = StructType([StructField("o_orderkey", LongType()),
                         StructField("o_custkey", LongType()),
                         StructField("o_orderstatus", StringType()),
                         StructField("o_totalprice", DoubleType()),
                         StructField("o_orderdate", TimestampNTZType()),
                         StructField("o_orderpriority", StringType())])
    return read_parquet(spark, table_path(sf_dir, "orders"), schema)


def parquet_ddl(spark, sf_dir):
    return read_parquet(spark, table_path(sf_dir, "orders"),
                        "o_orderkey BIGINT, o_orderstatus STRING, not_in_file DOUBLE")


def json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "events_json")
    write_files(_table(spark, sf_dir, "events"), path, "json", "overwrite")
    return read_json(spark, path, EVENTS_DDL)


def json_infer(spark, sf_dir):
    """The same files without a schema: one more job to learn it, columns by name,
    timestamps as strings."""
    path = scratch_path(spark, "events_json")
    write_files(_table(spark, sf_dir, "events"), path, "json", "overwrite")
    return read_json(spark, path)


def awkward_events(spark, sf_dir) -> DataFrame:
    """Whole events, with what text formats lose: NULL and empty strings side by side,
    spaces at both ends, quotes, separators, line breaks, and text like the NULL marker."""
    third = F.col("event_id") % 3
    props = (F.when(third == 0, F.lit(None)).when(third == 1, F.lit(""))
             .otherwise(F.concat(F.lit('  "a",\\N\n\r'), "props", F.lit("\\ "))))
    marker = F.when(F.col("event_id") % 7 == 0, F.lit("\\N")).otherwise(F.col("event_type"))
    return _table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", marker.alias("event_type"),
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"), props.alias("props"))


def csv_exact(spark, sf_dir):
    path = scratch_path(spark, "events_exact_csv")
    write_csv_exact(awkward_events(spark, sf_dir), path)
    return read_csv_exact(spark, path, EVENTS_DDL)


def audited_orders(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders as they are, and with a narrower key, without a column and with a new one."""
    orders = _table(spark, sf_dir, "orders")
    later = orders.drop("o_orderpriority").withColumns({
        "o_custkey": F.col("o_custkey").cast("int"), "o_note": F.lit("later")})
    return orders, later


def schema_audit_job(spark, sf_dir):
    """What the footers of a folder say in which two schemas were written."""
    path = scratch_path(spark, "orders_two_schemas")
    for part, mode in zip(audited_orders(spark, sf_dir), ("errorifexists", "append")):
        write_files(part, path, "parquet", mode)
    return schema_audit(spark, path).select("col_name", "data_type", "n_rows", "every_file")


def _typed_copies(spark, orders: DataFrame) -> dict[str, DataFrame]:
    """Orders written in each format and read back without a declared schema."""
    paths = {fmt: scratch_path(spark, f"orders_{fmt}") for fmt in ("parquet", "orc", "json", "csv")}
    for fmt, path in paths.items():
        if fmt == "csv":
            write_csv(orders, path, **NULL_MARKER_OPTIONS)
        else:
            write_files(orders, path, fmt)
    return {"parquet": read_parquet(spark, paths["parquet"]), "orc": read_files(spark, paths["orc"], "orc"),
            "json": read_json(spark, paths["json"]),
            "csv": read_csv(spark, paths["csv"], infer_schema=True, **NULL_MARKER_OPTIONS)}


def types_survive(spark, sf_dir):
    """Per format and column of the orders: the type before and after a write, the NULLs,
    and the values that differ once they have their type again."""
    orders = _table(spark, sf_dir, "orders")
    found = []
    for fmt, back in _typed_copies(spark, orders).items():
        stored = dict(back.dtypes)
        kinds = F.create_map(*[F.lit(x) for c, kind in orders.dtypes for x in (c, f"{kind} {stored[c]}")])
        both = F.split(F.element_at(kinds, F.col("col_name")), " ")
        found.append(ops.multiset_difference(orders, conform(back, orders.schema))
                     .filter(F.col("col_name").isNotNull())
                     .select(F.lit(fmt).alias("format"), "col_name", both[0].alias("written"),
                             both[1].alias("stored"), "n_null",
                             (F.col("only_left") + F.col("only_right")).alias("n_differ")))
    return reduce(DataFrame.unionByName, found)


def default_format(spark, sf_dir):
    path = scratch_path(spark, "supplier_default")
    write_files(_table(spark, sf_dir, "supplier"), path, None, "overwrite")
    # Declared schema: names and types hold for any default format that can
    # store these types (parquet, orc, json, csv; text cannot).
    return read_files(spark, path, schema=TABLE_DDL["supplier"])


def raw_preview_job(spark, sf_dir):
    """Head of the CSV written from customer: its first part file (task 0 writes
    one in any case). One file per write task whatever the session's
    maxRecordsPerFile says."""
    return raw_preview(spark, _written_customer_csv(spark, sf_dir, maxRecordsPerFile=0), 20)


def table_scan(spark, sf_dir):
    db = catalog.new_database(spark, "scan")
    table = f"{db}.supplier"
    catalog.save_external(_table(spark, sf_dir, "supplier"), table, scratch_path(spark, "supplier"))
    return ops.group_count(spark.table(table), "s_nationkey", name="n", order=False)


def file_inventory_job(spark, sf_dir):
    """Write orders with its natural parallelism and check the part-file
    listing against the write (see ``sources.write_with_inventory``)."""
    return write_with_inventory(_table(spark, sf_dir, "orders"),
                                scratch_path(spark, "orders_files"))


#: Part files of ``file_rows``.
ROW_FILES = 32


def numbered_orders(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "orders").repartitionById(
        ROW_FILES, (F.col("o_orderkey") % ROW_FILES).cast("int"))


def file_rows(spark, sf_dir):
    """Orders written so that the key says which part file a row is in; one row per
    file: its task, how many rows are found in it, and whether it has a size."""
    files = write_numbered(_table(spark, sf_dir, "orders"), scratch_path(spark, "orders_numbered"),
                           F.col("o_orderkey") % ROW_FILES, ROW_FILES)
    return files.select("task", "n_rows", (F.col("size") > 0).alias("has_size"))


# ---------------------------------------------------------------------- sinks

def sink_overwrite(spark, sf_dir):
    """Customers are written, then replaced by the orders."""
    path = scratch_path(spark, "sink_overwrite")
    write_files(_table(spark, sf_dir, "customer"), path, "parquet", "overwrite")
    write_files(_table(spark, sf_dir, "orders"), path, "parquet", "overwrite")
    return read_parquet(spark, path)


def sink_error(spark, sf_dir):
    """Suppliers are written; the default mode refuses the customers after them."""
    path = scratch_path(spark, "sink_error")
    write_files(_table(spark, sf_dir, "supplier"), path, "parquet")
    try:
        write_files(_table(spark, sf_dir, "customer"), path, "parquet")
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        return read_parquet(spark, path)
    raise AssertionError(f"{path} was written over")


def sink_append(spark, sf_dir):
    path = scratch_path(spark, "sink_append")
    supplier = _table(spark, sf_dir, "supplier")
    write_files(supplier, path, "parquet", "errorifexists")
    write_files(supplier, path, "parquet", "append")
    return read_parquet(spark, path)


def sink_ignore(spark, sf_dir):
    """Orders are written; the customers are ignored (data exists)."""
    path = scratch_path(spark, "sink_ignore")
    write_files(_table(spark, sf_dir, "orders"), path, "parquet", "errorifexists")
    write_files(_table(spark, sf_dir, "customer"), path, "parquet", "ignore")
    return read_parquet(spark, path)


def sink_aggregate(spark, sf_dir):
    """Aggregate view -> table lookup -> Parquet files."""
    view = unique_name("status_counts")
    catalog.view_from_df(sink_aggregate_plan(spark, sf_dir), view)
    path = scratch_path(spark, "status_counts")
    write_files(spark.table(view), path, "parquet", "overwrite")
    return read_parquet(spark, path)


def table_external(spark, sf_dir):
    db = catalog.new_database(spark, "ext")
    return catalog.save_external(_table(spark, sf_dir, "customer"), f"{db}.customer_ext",
                                 scratch_path(spark, "customer_ext"))


def table_drop(spark, sf_dir):
    """Save an external table, drop it, and read the files it leaves."""
    table = f"{catalog.new_database(spark, 'drop')}.customer_drop"
    path = scratch_path(spark, "customer_drop")
    catalog.save_external(_table(spark, sf_dir, "customer"), table, path)
    catalog.drop_table(spark, table)
    if spark.catalog.tableExists(table):
        raise AssertionError(f"{table} is still there")
    return read_parquet(spark, path)


def table_append(spark, sf_dir):
    """A table of orders is read, appended to with its columns in another order, and read
    again: the rows go by column name and the second read sees the new files."""
    orders = _table(spark, sf_dir, "orders")
    table = f"{catalog.new_database(spark, 'app')}.orders_app"
    before = catalog.save_external(orders, table, scratch_path(spark, "orders_app")).count()
    after = catalog.append_to_table(orders.select(*reversed(orders.columns)), table)
    if after.count() != 2 * before:
        raise AssertionError(f"{table} does not show what was appended")
    return after


def table_managed(spark, sf_dir):
    db = catalog.new_database(spark, "man")
    return catalog.save_managed(_table(spark, sf_dir, "supplier"), f"{db}.supplier_man")


def table_register(spark, sf_dir):
    db = catalog.new_database(spark, "reg")
    path = scratch_path(spark, "supplier_files")
    write_files(_table(spark, sf_dir, "supplier"), path, "parquet", "overwrite")
    return catalog.register_files(spark, f"{db}.supplier_reg", path)


# -------------------------------------------------------------------- catalog

def view_from_df(spark, sf_dir):
    view = unique_name("customer")
    catalog.view_from_df(_table(spark, sf_dir, "customer"), view)
    return spark.sql(f"SELECT * FROM {view}")


def view_from_sql(spark, sf_dir):
    source = unique_name("customer")
    catalog.view_from_df(_table(spark, sf_dir, "customer"), source)
    return catalog.view_from_sql(spark, unique_name("machinery"),
                                 f"SELECT * FROM {source} WHERE c_mktsegment = 'MACHINERY'")


def sql_params(spark, sf_dir):
    view = unique_name("customer")
    catalog.view_from_df(_table(spark, sf_dir, "customer"), view)
    return catalog.run_sql(spark, "SELECT * FROM IDENTIFIER(:t) WHERE c_mktsegment = :seg",
                           t=view, seg="AUTOMOBILE")


# Jobs whose limit without an ordering is the feature (the head of a file).
UNORDERED_LIMIT_JOBS = frozenset({"raw_preview"})

# Jobs whose row order is part of the result.
ORDERED_JOBS = frozenset({"group_count", "view_counts_coded", "top_n", "first_row",
                          "raw_preview"})

# What the jobs that write files have Spark run before they read the files back;
# the plan checks look at these. Jobs that write a supplied table as it is have a
# plain scan here.
_WHOLE = {
    "customer": ["csv_infer", "csv_schema", "csv_strings", "csv_delim", "raw_preview",
                 "table_external", "table_drop"],
    "supplier": ["csv_noheader", "default_format", "table_scan", "sink_append", "table_managed",
                 "table_register", "sink_error"],
    "orders": ["file_inventory", "sink_overwrite", "sink_ignore", "table_append", "types_survive"],
    "events": ["json_roundtrip", "json_infer"],
}


def sink_aggregate_plan(spark, sf_dir) -> DataFrame:
    return ops.group_count(_table(spark, sf_dir, "orders"), "o_orderstatus", name="n", order=False)


WRITE_PLANS: dict[str, Job] = {
    "seven_steps": seven_steps_plan,
    "sink_aggregate": sink_aggregate_plan,
    "cache_reuse": lambda spark, sf_dir: cache_parts(spark, sf_dir)[1],
    "checkpoint_reuse": _reused_counts,
    "csv_exact": awkward_events,
    "file_rows": numbered_orders,
    "fold_any": fold_any_rows,
    "schema_audit": lambda spark, sf_dir: audited_orders(spark, sf_dir)[1],
    **{key: (lambda spark, sf_dir, table=table: _table(spark, sf_dir, table))
       for table, keys in _WHOLE.items() for key in keys},
}

JOBS: dict[str, Job] = {
    # aggregation
    "group_count": group_count,
    "group_count_one": group_count_one,
    "view_counts_coded": view_counts_coded,
    "view_counts_spec": view_counts_spec,
    "group_sum": group_sum,
    "row_count": row_count,
    "distinct_count": distinct_count,
    "unit_stats": unit_stats,
    "filter_post_agg": filter_post_agg,
    # projections, filters, column edits
    "select_cols": select_cols,
    "filter_eq": filter_eq,
    "filter_like": filter_like,
    "drop_cols": drop_cols,
    "derive_cols": derive_cols,
    "convert_units": convert_units,
    # sort, distinct, top-n, reduce
    "distinct_rows": distinct_rows,
    "top_n": top_n,
    "first_row": first_row,
    "reduce_row": reduce_row,
    "fold_any": fold_any,
    # consistency
    "fd_check": fd_check,
    "fd_pass": fd_pass,
    "fd_violations": fd_violations,
    # partitioning, reuse, staged write, per-partition function
    "seven_steps": seven_steps,
    "repartition_rows": repartition_rows,
    "repartition_coalesce": repartition_coalesce,
    "cache_reuse": cache_reuse,
    "shuffle_reuse": shuffle_reuse,
    "checkpoint_reuse": checkpoint_reuse,
    "partition_profile": partition_profile_job,
    # sources
    "csv_infer": csv_infer,
    "csv_schema": csv_schema,
    "csv_strings": csv_strings,
    "csv_noheader": csv_noheader,
    "csv_delim": csv_delim,
    "parquet_inferred": parquet_inferred,
    "parquet_struct": parquet_struct,
    "parquet_ddl": parquet_ddl,
    "json_roundtrip": json_roundtrip,
    "json_infer": json_infer,
    "csv_exact": csv_exact,
    "schema_audit": schema_audit_job,
    "types_survive": types_survive,
    "default_format": default_format,
    "raw_preview": raw_preview_job,
    "table_scan": table_scan,
    "file_inventory": file_inventory_job,
    "file_rows": file_rows,
    # sinks
    "sink_overwrite": sink_overwrite,
    "sink_append": sink_append,
    "sink_ignore": sink_ignore,
    "sink_error": sink_error,
    "sink_aggregate": sink_aggregate,
    "table_external": table_external,
    "table_append": table_append,
    "table_managed": table_managed,
    "table_register": table_register,
    "table_drop": table_drop,
    # catalog and SQL entry
    "view_from_df": view_from_df,
    "view_from_sql": view_from_sql,
    "sql_params": sql_params,
}
