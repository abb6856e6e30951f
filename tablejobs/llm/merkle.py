"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf: the digest of its columns. Leaves are ordered by key (a
null key first, then by UTF-8 bytes) and id; in each key every two consecutive
nodes are hashed into their parent until one is left, the key's root, and the
keys' roots are hashed into the dataset's root alike.

Nodes are labelled by (level, place). A sweep in the order of labels takes the
messages to a node (its children's digests) from a priority queue, hashes them
and sends the result to the parent's label. The queue is external: it holds the
messages inside a block of ``2 ** LEVELS`` neighbouring nodes in memory, and those
to other blocks are rows of a table in the shared folder, sorted by label by the
next round's exchange. A key with a third of all rows is many blocks, and a tree
of n leaves takes log(n) / ``LEVELS`` rounds. The reversed sweep goes from the root
to the leaves by descending labels: each node is sent its proof suffix (the
steps from its parent on) and sends it on, with the sibling before it.

Texts are read once and never move: the leaf digests (32 bytes a row), keys and
ids do. The driver sees one row per range partition and one number per tree.

Defined results: a null column is ``-`` in a leaf, an empty text ``0:``; rows with
equal ids are ordered by their digests (equal rows are interchangeable, each is a
leaf of its own), a null id comes first; a lone leaf is its key's root and has no
siblings; an empty table gives an empty result; columns not named are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.store import partitions, read, saved, temporary

#: Levels of a tree swept in one round: a block has 2 ** LEVELS nodes.
LEVELS = 8
#: Steps of a proof, each followed by the sibling's digest, but for an only child's.
LEFT, RIGHT, ONLY = b"<", b">", b"."


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 over the columns, in order: ``-`` for null, else byte count, ``:`` and value."""
    parts = []
    for column in columns:
        value = column.cast("string")
        size = F.octet_length(value).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def hashed(digests: list[bytes]) -> bytes:
    """The parent of nodes, whose digests go in as hexadecimal text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


class Sweep:
    """The nodes below one block's root. ``digests``: the block's nodes, ``alone`` if it
    is its tree's first block, which may end below the full height."""

    def __init__(self, digests: list[bytes], alone: bool, levels: int = LEVELS):
        self.height = (len(digests) - 1).bit_length() if alone else levels
        self.nodes: dict[tuple[int, int], bytes] = {}
        # Messages: the label they go to, the place they come from, a digest.
        queue = [((0, place), place, digest) for place, digest in enumerate(digests)]
        heapq.heapify(queue)
        while queue:
            label, _, digest = heapq.heappop(queue)
            got = [digest]
            while queue and queue[0][0] == label:
                got.append(heapq.heappop(queue)[2])
            level, place = label
            self.nodes[label] = node = hashed(got) if level else digest
            if level < self.height:
                heapq.heappush(queue, ((level + 1, place >> 1), place, node))
        self.root = self.nodes[self.height, 0]

    def suffixes(self, suffix: bytes) -> Iterator[tuple[int, bytes]]:
        """(place, proof suffix) of the block's nodes, from its root's, by descending labels."""
        queue = [((-self.height, 0), suffix)]
        while queue:
            (level, place), suffix = heapq.heappop(queue)
            level = -level
            if not level:
                yield place, suffix
                continue
            left, right = ((level - 1, 2 * place), (level - 1, 2 * place + 1))
            if right in self.nodes:
                heapq.heappush(queue, ((-left[0], left[1]), RIGHT + self.nodes[right] + suffix))
                heapq.heappush(queue, ((-right[0], right[1]), LEFT + self.nodes[left] + suffix))
            else:
                heapq.heappush(queue, ((-left[0], left[1]), ONLY + suffix))


def proof_steps(suffix: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(side of the sibling, its digest) of each step from the leaf to the root."""
    at = 0
    while at < len(suffix):
        side = suffix[at:at + 1]
        end = at + 1 + (0 if side == ONLY else 32)
        yield side, suffix[at + 1:end]
        at = end


def fold(digest: bytes, suffix: bytes) -> bytes:
    """The root that a leaf digest and its proof lead to."""
    for side, sibling in proof_steps(suffix):
        digest = hashed([sibling, digest] if side == LEFT else [digest, sibling] if side == RIGHT else [digest])
    return digest


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), schema.types)], schema=schema)


_NODE = pa.schema([("key", pa.string()), ("place", pa.int64()), ("digest", pa.binary())])


def number(nodes: DataFrame, order: list[str], label: str) -> DataFrame:
    """``nodes`` with ``place``, the gapless place of each row in its key when sorted by
    key, then ``order``. A range exchange sorts; the driver adds up one row per partition."""
    spark, names = nodes.sparkSession, nodes.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, at, first = TaskContext.get().partitionId(), (), 0, True
        for batch in batches:
            places = []
            for key in batch.column(names.index("key")).to_pylist():
                if (key,) != last:
                    first, last, at = not last, (key,), 0
                places.append((at, first))
                at += 1
            at_first = [pa.array(c, k) for c, k in zip(zip(*places), (pa.int64(), pa.bool_()))] if places else \
                [pa.array([], pa.int64()), pa.array([], pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), *at_first],
                [*names, "_part", "_at", "_head"])

    kinds = ", ".join(f"`{n}` {k}" for n, k in nodes.dtypes)
    # Equal rows may be many: their places in the scan let the exchange split them.
    by = ["key", *order, "_scan"]
    ranged = nodes.withColumn("_scan", F.monotonically_increasing_id()) \
        .repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by).drop("_scan")
    numbered = saved(ranged.mapInArrow(count, f"{kinds}, _part int, _at long, _head boolean"), label)
    ends = numbered.groupBy("_part").agg(
        F.min_by(F.struct("key"), ~F.col("_head")).alias("first"), F.max(F.struct("key")).alias("last"),
        F.max_by("_at", F.struct("key", "_at")).alias("tail"))
    carry, before, starts = 0, None, []
    for row in sorted(ends.collect(), key=itemgetter("_part")):
        carried = carry if before == row["first"] else 0
        starts.append((row["_part"], carried))
        carry = row["tail"] + 1 + (carried if row["first"] == row["last"] else 0)
        before = row["last"]
    # One row per range partition, whatever the number of rows.
    offsets = F.broadcast(spark.createDataFrame(starts, "_part int, _carried long"))
    place = F.col("_at") + F.when(F.col("_head"), F.col("_carried")).otherwise(0)
    return numbered.join(offsets, "_part").select(*[F.col(f"`{n}`") for n in names], place.alias("place"))


def _dealt(df: DataFrame, *then: str) -> DataFrame:
    """By block, blocks in order of their labels, in each task."""
    return df.repartition(partitions(df.sparkSession), "key", "block").sortWithinPartitions("key", "block", *then)


def _block(place: str, levels: int) -> Column:
    return F.shiftright(place, levels).alias("block")


def rounds(count: int, levels: int) -> int:
    """Rounds it takes until one node is left of ``count``."""
    n = 0
    while count > 1:
        count, n = -(-count >> levels), n + 1
    return n


def sweep_up(nodes: DataFrame, label: str, levels: int = LEVELS) -> list[DataFrame]:
    """The node tables (key, place, digest) of all rounds: first the given one, last the
    roots. ``nodes`` may have more columns."""
    most = nodes.agg(F.max("place")).first()[0]
    tables = [nodes.select("key", "place", "digest")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def roots():
            for (key, block), rows in groupby(_rows(batches), key=itemgetter(0, 1)):
                yield key, block, Sweep([r[2] for r in rows], block == 0, levels).root
        yield from _batches(roots(), _NODE)

    for _ in range(rounds(0 if most is None else most + 1, levels)):
        messages = _dealt(tables[-1].select("key", _block("place", levels), "digest", "place"), "place")
        tables.append(saved(messages.mapInArrow(work, "key string, place long, digest binary"), label))
    return tables


def sweep_down(tables: list[DataFrame], roots: DataFrame, extra: DataFrame, label: str,
               levels: int = LEVELS) -> DataFrame:
    """``extra`` (the nodes of the first table, with more columns) plus ``suffix``, the
    proof of each node, and the columns ``subroot`` and ``root`` of ``roots`` (key, place,
    suffix, subroot, root), which has the suffix of each tree's root."""
    sent = roots
    for depth in range(max(len(tables) - 2, 0), -1, -1):
        here = extra if depth == 0 else tables[depth]
        more = [c for c in here.columns if c not in ("key", "place", "digest")]
        kinds = dict(here.dtypes)
        nodes = here.select("key", _block("place", levels), "place", "digest", *more,
                            *[F.lit(None).cast("binary").alias(c) for c in ("suffix", "subroot", "root")])
        from_above = sent.select("key", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"),
                                 F.lit(None).cast("binary").alias("digest"),
                                 *[F.lit(None).cast(kinds[c]).alias(c) for c in more], "suffix", "subroot", "root")
        names = ["key", "place", "digest", *more, "suffix", "subroot", "root"]
        schema = ", ".join(f"`{c}` {kinds.get(c, 'binary')}" for c in names)
        arrow = pa.schema([(c, _ARROW[kinds.get(c, "binary")]) for c in names])

        def work(batches: Iterator[pa.RecordBatch], arrow=arrow) -> Iterator[pa.RecordBatch]:
            def down():
                for (key, block), rows in groupby(_rows(batches), key=itemgetter(0, 1)):
                    above, *nodes = rows                # the message from above has place -1
                    suffix, *root = above[-3:]
                    block_sweep = Sweep([r[3] for r in nodes], block == 0, levels)
                    for place, own in block_sweep.suffixes(suffix):
                        yield (key, *nodes[place][2:-3], own, *root)
            yield from _batches(down(), arrow)

        sent = _dealt(nodes.unionByName(from_above), "place").mapInArrow(work, schema)
        if depth:
            sent = saved(sent.select("key", "place", "suffix", "subroot", "root"), label)
    return sent


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``rows`` (key string, id long, digest binary, and more columns of the kinds string,
    bigint and binary) plus the binary columns ``suffix``, ``subroot`` and ``root``."""
    leaves = number(saved(rows, "merkle_rows"), ["id", "digest"], "merkle_leaves")
    trees = sweep_up(leaves, "merkle_up", levels)
    keys = trees[-1].select(F.col("key").alias("name"), "digest", F.lit(None).cast("string").alias("key"))
    tops = number(keys, ["name"], "merkle_keys")
    top = sweep_up(tops, "merkle_top", levels)
    root = top[-1].select("key", "place", F.lit(b"").alias("suffix"), F.lit(b"").alias("subroot"),
                          F.col("digest").alias("root"))
    proved = sweep_down(top, root, tops, "merkle_top_down", levels)
    subroots = saved(proved.select(F.col("name").alias("key"), F.lit(0).cast("long").alias("place"), "suffix",
                                   F.col("digest").alias("subroot"), "root"), "merkle_subroots")
    return sweep_down(trees, subroots, leaves, "merkle_down", levels)


def document_manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """Per row of (doc_id, source, lang, n_chars, text): its leaf, subroot, root, the
    digest of its proof, and the root that the leaf, read again, folds to with it. Where
    ``tampered`` is true, that leaf has 1 added to ``n_chars``."""
    column = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    again = leaf_digest(*column[:3], column[3] + 1, column[4])
    changed = F.coalesce(tampered if tampered is not None else F.lit(False), F.lit(False))
    rows = docs.select(
        F.col("lang").cast("string").alias("key"), F.col("doc_id").cast("long").alias("id"),
        F.unhex(leaf_digest(*column)).alias("digest"), F.when(changed, F.unhex(again)).alias("read"))
    names = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in (
        "leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_()), ("n_steps", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def checked():
            for key, digest, read_again, suffix, subroot, root in _rows(batches):
                folded = fold(digest if read_again is None else read_again, suffix)
                steps = list(proof_steps(suffix))
                proof = hashed([sibling for _, sibling in steps])
                yield (key, digest.hex(), subroot.hex(), root.hex(), proof.hex(), folded.hex(), folded == root,
                       len(steps))
        yield from _batches(checked(), names)

    with temporary(docs.sparkSession):
        proved = manifest(rows, levels).select("id", "digest", "read", "suffix", "subroot", "root")
        return saved(proved.mapInArrow(
            verify, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                    "folded_root string, verified boolean, n_steps long"), "merkle_manifest", keep=True)


def every_seventh(id_col: str = "doc_id") -> Column:
    """Whether 7 divides the CRC-32 of the decimal id."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 7 == 0


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return document_manifest(docs, every_seventh())


#: Remainders of CRC-32 by half byte: fixed values of the public polynomial 0xEDB88320.
_CRC_STEPS = ("[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
              "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]")
#: The CRC-32 of the decimal digits of ``doc_id``, half byte by half byte.
_CRC = f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(2 * length(doc_id::VARCHAR)),
        lambda k: (ascii(substr(doc_id::VARCHAR, 1 + k // 2, 1))::BIGINT >> (4 * (k % 2))) & 15)),
        lambda c, x: xor(c >> 4, ({_CRC_STEPS}::BIGINT[])[1 + (xor(c, x) & 15)])))"""


def _sql_leaf(n_chars: str) -> str:
    parts = [f"coalesce(strlen(({c})::VARCHAR)::VARCHAR || ':' || ({c})::VARCHAR, '-')"
             for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(parts)})"


OP12_SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT doc_id, lang, leaf, here, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           row_number() OVER () AS n
    FROM (SELECT doc_id, lang, {_sql_leaf('n_chars')} AS leaf,
                 CASE WHEN {_CRC} % 7 = 0 THEN {_sql_leaf('n_chars + 1')} ELSE {_sql_leaf('n_chars')} END AS here
          FROM documents) d),
tree AS (
    SELECT lang, 0 AS level, place, leaf AS node FROM leaves
    UNION ALL
    SELECT lang, max(level) + 1, place // 2, sha256(string_agg(node, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS many FROM tree) t WHERE many > 1
    GROUP BY lang, place // 2),
subroots AS MATERIALIZED (
    SELECT lang, height, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
    FROM (SELECT lang, max(level) AS height, arg_max(node, level) AS node FROM tree GROUP BY lang) s),
top AS (
    SELECT 0 AS level, place, node FROM subroots
    UNION ALL
    SELECT max(level) + 1, place // 2, sha256(string_agg(node, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER () AS many FROM top) t WHERE many > 1
    GROUP BY place // 2),
steps AS MATERIALIZED (
    SELECT l.n, t.level AS step, (l.place >> t.level) & 1 AS side, u.node AS sibling
    FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
    JOIN (SELECT unnest(range(64))::INTEGER AS level) t ON t.level < s.height
    LEFT JOIN tree u ON u.lang IS NOT DISTINCT FROM l.lang AND u.level = t.level AND u.place = xor(l.place >> t.level, 1)
    UNION ALL
    SELECT l.n, s.height + t.level, (s.place >> t.level) & 1, u.node
    FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
    JOIN (SELECT DISTINCT level FROM top) t ON t.level < (SELECT max(level) FROM top)
    LEFT JOIN top u ON u.level = t.level AND u.place = xor(s.place >> t.level, 1)),
folds AS (
    SELECT n, 0 AS step, here AS node FROM leaves
    UNION ALL
    SELECT f.n, f.step + 1, sha256(CASE WHEN s.sibling IS NULL THEN f.node WHEN s.side = 1 THEN s.sibling || f.node
                                   ELSE f.node || s.sibling END)
    FROM folds f JOIN steps s ON s.n = f.n AND s.step = f.step),
proofs AS (SELECT n, coalesce(string_agg(sibling, '' ORDER BY step), '') AS siblings, count(*) AS n_steps
           FROM steps GROUP BY n)
SELECT l.doc_id, l.leaf, s.node AS subroot, r.node AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
       f.node AS folded_root, f.node = r.node AS verified, coalesce(p.n_steps, 0) AS n_steps
FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
LEFT JOIN proofs p ON p.n = l.n
JOIN (SELECT n, arg_max(node, step) AS node FROM folds GROUP BY n) f ON f.n = l.n
CROSS JOIN (SELECT arg_max(node, level) AS node FROM top) r
"""
