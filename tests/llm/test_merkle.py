"""The Merkle manifest: against its definition."""

import hashlib
import zlib

import pytest

from tablejobs.llm import merkle
from tests.llm import brute

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, add=0):
    values = [row[c] for c in COLUMNS]
    values[3] = values[3] + add if values[3] is not None else None
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def steps(levels, at):
    """(siblings before, siblings after) of each level."""
    for nodes in levels[:-1]:
        lo = at // 2 * 2
        yield nodes[lo:at], nodes[at + 1:lo + 2]
        at //= 2


def expected(rows):
    keys = sorted({r["lang"] for r in rows}, key=lambda k: (k is not None, (k or "").encode()))
    trees, order = {}, {}
    for key in keys:
        order[key] = sorted((r for r in rows if r["lang"] == key),
                            key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[key] = tree([leaf(r) for r in order[key]])
    top = tree([trees[k][-1][0] for k in keys]) if keys else []
    out = []
    for k, key in enumerate(keys):
        for at, r in enumerate(order[key]):
            way = [*steps(trees[key], at), *steps(top, k)]
            i = r["doc_id"]
            folded = leaf(r, i is not None and zlib.crc32(str(i).encode()) % 7 == 0)
            for before, after in way:
                folded = h(*before, folded, *after)
            out.append((i, leaf(r), trees[key][-1][0], top[-1][0], h(*[x for b, a in way for x in b + a]),
                        folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def got(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string")


def test_supplied_documents(spark, small_dir, documents):
    rows = got(merkle.op12_merkle_manifest(spark, small_dir))
    assert rows == expected(documents)
    assert {r[-1] for r in rows} == {True, False}


def test_sql(spark, sf_dir):
    from tests.compare import compare, duck_connection
    assert compare(merkle.op12_merkle_manifest(spark, sf_dir), duck_connection(sf_dir), merkle.OP12_SQL) == []


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_rounds_of_any_height(spark, levels):
    """Trees of all sizes around the blocks' ends, nulls everywhere, equal ids and rows,
    many keys, and a key with most rows."""
    rows = []
    for size in (1, 2, 3, 4, 5, 7, 8, 9, 16, 17):
        rows += [dict(doc_id=i, source=None, lang=f"k{size}", n_chars=i if i % 3 else None, text="é" * i)
                 for i in range(size)]
    rows += [dict(doc_id=i // 2, source="s", lang=None, n_chars=1, text=str(i // 4)) for i in range(60)]
    rows += [dict(doc_id=None, source="s", lang="", n_chars=i, text=None) for i in range(3)]
    df = frame(spark, rows).withColumn("key", merkle.F.lit("x")).withColumn("place", merkle.F.lit(1))
    assert got(merkle.document_manifest(df.repartition(5), merkle.every_seventh(), levels)) == expected(rows)


def test_small_tables(spark, edges):
    one = [dict(doc_id=7, source=None, lang=None, n_chars=None, text="")]
    (row,) = got(merkle.document_manifest(frame(spark, one), merkle.every_seventh()))
    assert row[1] == row[2] == row[3] == row[5] and row[4] == brute.sha(b"") and row[6]
    assert got(merkle.document_manifest(frame(spark, one).limit(0))) == []


def test_fold_finds_a_change():
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(11)]
    sweep = merkle.Sweep(digests, True)
    assert sweep.root.hex() == tree([d.hex() for d in digests])[-1][0]
    for place, suffix in sweep.suffixes(b""):
        assert merkle.fold(digests[place], suffix) == sweep.root
        assert merkle.fold(digests[place - 1], suffix) != sweep.root


def test_nothing_is_left_behind(spark, small_dir):
    from tablejobs.session import hadoop_fs, session_scratch
    folder = session_scratch(spark)
    fs, path = hadoop_fs(spark, folder)
    merkle.op12_merkle_manifest(spark, small_dir)
    left = {s.getPath().getName().rsplit("-", 1)[0] for s in fs.listStatus(path)}
    assert "merkle_manifest" in left and not any(x.startswith("merkle") for x in left - {"merkle_manifest"})
