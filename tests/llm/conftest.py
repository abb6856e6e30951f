import os

import pyarrow.parquet as pq
import pytest

SF = os.environ.get("TABLEJOBS_LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def small_dir():
    return SF


@pytest.fixture(scope="session")
def documents(small_dir):
    return pq.read_table(f"{small_dir}/documents.parquet").to_pylist()


EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  Two"),
    (6, "word " * 4000), (7, "a b c d e f g h i j k l " * 30), (7, "a b c d e f g h i j k l " * 30),
    (8, "x" * 70_000), (9, "Émile   naïve 漢字 \U0001F600 line\nline\nline\n"), (None, "no id here at all but words"),
    (10, "the quick brown fox jumps over the lazy dog and then it sleeps for a very long while in the warm sun " * 2),
    (11, "the quick brown fox jumps over the lazy dog and then it sleeps for a very long while in the warm sun " * 2),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and very long texts, ties and repeated rows, and columns whose names
    operators may want to use themselves."""
    rows = [(i, t, "en" if (i or 0) % 2 else None, "k", 1, "h", 77 + (i or 0), "own", None, 5, 6, ["s"])
            for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, k string, n int, bucket string, "
                                       "_k long, _H string, _t string, _start int, _end int, _spans array<string>")


def untouched(rows):
    """Whether the columns of ``edges`` that no operator may touch have their values."""
    return all((r["k"], r["n"], r["bucket"], r["_k"], r["_H"], r["_t"], r["_start"], r["_end"], r["_spans"])
               == ("k", 1, "h", 77 + (r["doc_id"] or 0), "own", None, 5, 6, ["s"]) for r in rows)


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.limit(0)
