"""Archives and shards."""

import collections
import gzip
import random
import zlib

import numpy as np
import pytest

from tablejobs.llm import hilbert, warc
from tablejobs.llm.queries import ORACLE_SQL
from tablejobs.session import scratch_path


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        index = hilbert.hilbert_index(grid, bits)
        assert sorted(index.tolist()) == list(range(1 << bits * dims))
        steps = np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(1)
        assert (steps == 1).all()


def test_shards_of_equal_counts(spark, small_dir, documents):
    rows = hilbert.op4_hilbert_sharding(spark, small_dir).collect()
    texts = {d["doc_id"]: d["text"].encode() for d in documents}
    assert len(rows) == len(texts)
    counts = [0] * 8
    for r in rows:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (
            len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]), "rows", None)
        counts[r.shard] += 1
    assert max(counts) - min(counts) <= 1
    assert {(r.shard, r.slot) for r in rows} == {(s, i) for s, n in enumerate(counts) for i in range(n)}
    by_place = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in by_place] == sorted(r.curve for r in rows)


def test_shards_prune_files(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    path = scratch_path(spark, "shards")
    hilbert.write_shards(docs, ["lang", "n_chars"], path)
    back = spark.read.parquet(path)
    assert back.drop("shard").exceptAll(docs).count() == 0 and back.count() == docs.count()
    extents = back.groupBy("shard").agg({"lang": "approx_count_distinct"}).collect()
    assert sum(r[1] for r in extents) < 4 * len(extents)         # a shard doesn't hold all languages


def test_shards_keep_every_row(spark, edges):
    """Null ids and repeated rows are written once each, whatever their ids."""
    docs = edges.unionAll(edges.filter("doc_id IS NULL"))
    path = scratch_path(spark, "shards_rows")
    hilbert.write_shards(docs, ["lang", "doc_id"], path, 3)
    back = spark.read.parquet(path)
    assert sorted(map(str, back.drop("shard").collect())) == sorted(map(str, docs.collect()))
    counts = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert max(counts) - min(counts) <= 1


def cells_of(spark, values, kind, bits=3):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, v {kind}").repartition(3)
    return {r["id"]: r["curve"] for r in hilbert.curve_order(df, ["v"], [hilbert.F.col("id")], bits).collect()}


def test_cells_follow_whole_values(spark):
    """One dimension: the curve's index is the cell. Long common beginnings, fractions,
    negative numbers, dates, times and booleans all spread over the cells, in order."""
    import datetime as dt
    import decimal

    cases = [
        ("string", [f"https://www.example.org/a/very/long/common/start/{i:03d}" for i in range(64)]),
        ("binary", [b"same start " + bytes([i]) for i in range(64)]),
        ("double", [i / 64 - 0.5 for i in range(64)]),
        ("decimal(10,4)", [decimal.Decimal(i) / 100 for i in range(64)]),
        ("date", [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(64)]),
        ("timestamp_ntz", [dt.datetime(2020, 1, 1, 0, 0, 0, i) for i in range(64)]),
        ("timestamp", [dt.datetime(2020, 1, 1, 0, 0, i % 60, i) if i < 60 else dt.datetime(2020, 1, 1, 0, 1, 0, i)
                       for i in range(64)]),
    ]
    for kind, values in cases:
        cells = cells_of(spark, values, kind)
        order = [cells[i] for i in range(64)]
        assert order == sorted(order) and set(order) == set(range(8)), (kind, order)
        assert max(order.count(c) for c in range(8)) <= 10
    flags = cells_of(spark, [False, True, None, True] * 8, "boolean")
    assert flags[0] <= flags[1] and flags[2] == 0 and flags[1] == flags[3] != flags[0]
    odd = cells_of(spark, [float("nan"), None, float("-inf"), 0.0, 1.0, float("inf")], "double")
    assert odd[1] == odd[2] == 0 and odd[0] == odd[5] == max(odd.values())
    with pytest.raises(TypeError, match="kind array"):
        cells_of(spark, [[1]], "array<int>")


def test_a_hot_value_fills_one_cell(spark):
    cells = cells_of(spark, ["m"] * 60 + [None] * 2 + ["a", "z"], "string")
    assert cells[62] <= cells[0] <= cells[63] and cells[60] == 0 and len({cells[i] for i in range(60)}) == 1


def cells_by_rows(values, cells):
    """Each string's cell by going through all of them in order: a value starts a cell
    where more borders of equal row counts were crossed than cells were started."""
    counts = collections.Counter(v.encode() for v in values if v is not None)
    total, before, started, out = sum(counts.values()), 0, 0, {}
    for value in sorted(counts):
        started += before * cells // total > started
        out[value.decode()] = started
        before += counts[value]
    return out


def test_string_cells_count_all_values(spark):
    """More different strings than the driver holds, long ones among them, hot ones and
    common beginnings of any length: every value counts for the cells."""
    rng = random.Random(4)
    many = [f"https://www.example.org/{rng.randrange(10 ** 9)}" for _ in range(11_000)]
    hot = [f"https://www.example.org/{x}" for x in ("", "31", "55", "9" * 12)]
    far = [f"{'same ' * 400}{i:03d}" for i in range(300)]
    cases = [
        (many + many[:500] + hot[:1] * 4000 + hot[1:2] * 700 + hot[2:3] * 3000 + hot[3:] * 2000 + [None] * 50, 8),
        (many[:400] + ["https://www.example.org/4" + "x" * 3_000_000, "", "é"], 3),
        (far + far[:40] * 6 + ["same", "same " * 320], 4),
        (["y" * 2000], 3),
    ]
    for values, bits in cases:
        rng.shuffle(values)
        cells, expected = cells_of(spark, values, "string", bits), cells_by_rows(values, 1 << bits)
        assert [cells[i] for i in range(len(values))] == [expected.get(v, 0) for v in values]


@pytest.mark.parametrize("held", [3, 40])
def test_string_cells_do_not_depend_on_what_the_driver_holds(spark, monkeypatch, held):
    """Values of a few rows each, dealt to a few ranges: the same cells as with all on the driver."""
    values = [f"src{i * i % 97}" for i in range(400)] + ["src5"] * 150 + [None] * 3
    assert (whole := cells_of(spark, values, "string", 5))[0] == cells_by_rows(values, 32)["src0"]
    monkeypatch.setattr(hilbert, "SAMPLE_VALUES", held)
    assert cells_of(spark, values, "string", 5) == whole


def test_shard_edges(edges, nothing):
    rows = hilbert.shard_documents(edges, ["lang", "n"], 3).collect()
    assert len(rows) == edges.count()
    assert {r.size for r in rows if r.doc_id == 1} == {1}
    assert hilbert.shard_documents(nothing, ["lang", "n"]).count() == 0


def archive(tmp_path, bodies):
    path = tmp_path / "a.warc.gz"
    at, out = [], b""
    for i, body in enumerate(bodies):
        at.append(len(out))
        out += gzip.compress(warc.record(i, f"http://x/{i}", body), 6 if i % 2 else 0)
    path.write_bytes(out)
    return path, at, len(out)


def test_every_record_is_read_once_wherever_ranges_are_cut(tmp_path):
    rng = random.Random(3)
    bodies = [rng.randbytes(rng.randint(0, 900)) + b"\x1f\x8b\x08" * rng.randint(0, 3) + b"\x1f\x8b" for _ in range(40)]
    path, at, size = archive(tmp_path, bodies)
    for step in (1, 7, 64, 1000, size):
        found = []
        with open(path, "rb") as file:
            for start in range(0, size, step):
                own = [warc.parse(b) for b in warc.Members(file, start, start + step)]
                assert len(own) == sum(start <= x < start + step for x in at)
                found += own
        assert [f["payload"] for f in found] == bodies


def test_damage_is_noticed(tmp_path):
    path, at, size = archive(tmp_path, [b"abc" * 100, b"def" * 100])
    path.write_bytes(path.read_bytes()[:-9])
    with open(path, "rb") as file, pytest.raises(ValueError):
        list(warc.Members(file, 0, size))


def test_round_trip(spark):
    pages = [(1, "http://a/ü b\r\n", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>é</p>"), (4, "u", "<p>é</p>"),
             (None, "u", "<p>é</p>"), (None, "u", "alone"), (5, "u", "x" * 300_000)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    rows = sorted(map(tuple, warc.round_trip(spark, table, split=500).collect()), key=str)
    expected = []
    for i, _, h in pages:
        body = (h or "").encode()
        same = [j for j, _, x in pages if (x or "").encode() == body and j is not None]
        head = max(same, default=None)
        first = i == head
        expected.append((i, len(body), warc.digest32(body), "response" if first else "revisit", None if first else head))
    assert rows == sorted(expected, key=str)
    assert warc.round_trip(spark, table.limit(0)).count() == 0


def test_fields_read_back(spark):
    table = spark.createDataFrame([(7, "http://a/ü?q=%20 x", "<p>é</p>")], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.deduplicated(table), scratch_path(spark, "warc"))
    row = warc.read_archives(warc.byte_ranges(manifest), ("page_id", "payload")).first()
    assert (row.page_id, bytes(row.payload).decode()) == ("7", "<p>é</p>")


def test_oracles(spark):
    import duckdb

    from tablejobs.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    assert set(ORACLE_SQL) == {"op3_warc", "op6_jaccard", "op10_decontamination", "op12_merkle_manifest",
                               "op13_pivot_search"}
    for name, sql in ORACLE_SQL.items():
        ours, theirs = QUERIES[name](spark, sf), con.sql(sql)
        columns = sorted(theirs.columns)
        assert sorted(ours.columns) == columns
        assert sorted(map(str, map(tuple, ours.select(*columns).collect()))) == sorted(
            map(str, con.sql(f"SELECT {', '.join(columns)} FROM theirs").fetchall()))
