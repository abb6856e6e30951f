"""Language-model scoring with sharded Elias-Fano tries.

A bigram model with interpolated absolute discounting:

    p(w | u) = max(c(u, w) - D, 0) / c(u) + D n(u) / c(u) * p(w)
    p(w)     = (c(w) - D) / N, or D V / N for all unknown words together

over training tokens, with c counts, n(u) the number of different words after
u, and the start of a text as the first context. The first term is what the tries hold,
quantised to a byte.

1. One scan counts training tokens and finds the frequent contexts (those that would
   fill half a shard or more, and all with at least 1 / 1000 of the tokens).
2. Documents are read in batches of rows. A batch sends each of its different pairs
   once, with its training count, to the shard of the context; pairs of a frequent
   context are dealt to several shards by the word, in proportion to its share.
3. A shard adds up the counts, packs its trie, maps it into memory, and answers
   each batch: the context's count and number of successors, and a byte per pair.
4. Batch and answers meet, and texts are scored. Every token is the context
   of the next one, so the answers give the words' own counts as well.

Two scans number the rows alike: ``docs`` has to be read from files (``saved``
makes it so). Answers that don't fit a batch raise an error.

Defined results: null texts are empty (one token, the end); a null id counts as the
empty text where training rows are chosen; repeated rows are scored (and counted)
one by one; without training tokens every word is unknown and scores are those of
the smoothed empty model; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.eftrie import Mapped, Trie, probabilities, to_bytes
from tablejobs.llm.repeats import _unpack
from tablejobs.llm.store import partitions, read, saved
from tablejobs.llm.textbatch import SPACED, U64, WordHasher, binary_array, mix, row_counts, slices, text_view

DISCOUNT = 0.75
#: Rows per batch, as a power of two.
BATCH_BITS = 11
#: A context is frequent with a share of 1 / FREQUENT of the tokens, or half a shard.
FREQUENT = 1000
#: Hashes of the start and the end of a text.
START, END = U64(0x5353535353535353), U64(0xE0E0E0E0E0E0E0E0)


def tokens(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher):
    """(row, context, word) of every token: a text's words and its end."""
    n = len(offsets) - 1
    starts, ends, row = hasher.words(data, offsets)
    h = hasher.hashes(data, starts, ends)
    count = row_counts(row, n)
    at = np.append(0, np.cumsum(count + 1))
    word = np.empty(int(at[-1]), U64)
    word[np.arange(len(row)) + row] = h
    word[at[1:] - 1] = END
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[at[:-1]] = START
    return np.repeat(np.arange(n), count + 1), context, word


class Shards:
    """Which shard holds a pair."""

    def __init__(self, shards: int, frequent: dict[int, int], n_tokens: int):
        self.shards = shards
        self.contexts = np.array(sorted(frequent), U64)
        self.pieces = np.array([min(shards, max(1, -(-2 * shards * frequent[int(c)] // max(n_tokens, 1))))
                                for c in self.contexts.tolist()], np.int64)

    def pieces_of(self, context: np.ndarray) -> np.ndarray:
        out = np.ones(len(context), np.int64)
        if len(self.contexts):
            at = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
            same = self.contexts[at] == context
            out[same] = self.pieces[at[same]]
        return out

    def shard(self, context: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Pieces of one context go to different shards."""
        return ((mix(context) >> U64(33)).astype(np.int64) + piece) % self.shards


class Pairs:
    """The different pairs of a batch, by shard, piece of the context, context and word."""

    def __init__(self, row, context, word, trained: np.ndarray, shards: Shards):
        contexts, u = np.unique(context, return_inverse=True)
        w = (word >> U64(32)).astype(np.int64)
        key = u.astype(U64) << U64(32) | w.astype(U64)
        order = np.argsort(key, kind="stable")
        s = key[order]
        new = np.append(True, s[1:] != s[:-1]) if len(s) else np.zeros(0, bool)
        head = np.flatnonzero(new)
        number = np.empty(len(key), np.int64)
        number[order] = np.cumsum(new) - 1
        count = np.add.reduceat(trained[row][order].astype(np.int64), head) if len(head) else head
        key = s[head]
        u, w = (key >> U64(32)).astype(np.int64), (key & U64(0xFFFFFFFF)).astype(np.int64)
        # Contexts in their pieces: all pieces are asked, for their totals.
        many = shards.pieces_of(contexts)
        base = np.append(0, np.cumsum(many))
        owner = np.repeat(np.arange(len(contexts)), many)
        piece = np.arange(len(owner)) - base[owner]
        where = shards.shard(contexts[owner], piece)
        rank = np.argsort(where, kind="stable")       # places in the order of shards
        place = np.empty(len(owner), np.int64)
        place[rank] = np.arange(len(owner))
        spot = place[base[u] + (w * many[u] >> 32)]
        order = np.argsort(spot, kind="stable")
        turn = np.empty(len(order), np.int64)
        turn[order] = np.arange(len(order))
        #: For each token, its pair; for each pair, its context's place.
        self.pair, self.spot = turn[number], spot[order]
        self.words, self.counts = w[order].astype(np.uint32), count[order].astype(np.uint32)
        #: For each place: shard, context and number of pairs.
        self.shards, self.context_number = where[rank], owner[rank]
        self.contexts = contexts
        self.runs = np.bincount(spot, minlength=len(owner)).astype(np.uint32)

    def messages(self, batch: int) -> pa.RecordBatch:
        head = np.flatnonzero(np.append(True, self.shards[1:] != self.shards[:-1]))
        cuts = np.append(head, len(self.shards))
        pair_cuts = np.append(0, np.cumsum(self.runs.astype(np.int64)))[cuts]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.shards[head].astype(np.int32)), pa.array(np.full(len(head), batch, np.int64)),
             binary_array(self.contexts[self.context_number], cuts), binary_array(self.runs, cuts),
             binary_array(self.words, pair_cuts), binary_array(self.counts, pair_cuts)],
            ["shard", "batch", "context", "run", "word", "count"])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows in the order they come, cut where the batch number (column 0) changes."""
    held: list[pa.RecordBatch] = []
    number = None
    for part in batches:
        numbers = np.asarray(part.column(0))
        cuts = np.append(np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])), len(numbers))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if number is not None and numbers[a] != number:
                yield number, pa.Table.from_batches(held)
                held = []
            number = int(numbers[a])
            held.append(part.slice(a, b - a))
    if held:
        yield number, pa.Table.from_batches(held)


def frequent_contexts(slim: DataFrame, least: int) -> tuple[int, int, dict[int, int]]:
    """(training tokens, training texts, {context with a share of 1 / least: its training
    count or somewhat less}). Slices pass on what has that share in them, tasks what has
    half of it, so no context with twice the share is missed, and a task sends 2 * least
    rows at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, n, texts, held = WordHasher(SPACED), 0, 0, {}
        for part, data, offsets in slices(batches):
            row, context, _ = tokens(data, offsets, hasher)
            trained = np.asarray(part.column(0))
            u, c = np.unique(context[trained[row]], return_counts=True)
            n, texts = n + int(c.sum()), texts + int(trained.sum())
            often = c * least > c.sum()
            for x, k in zip(u[often].tolist(), c[often].tolist()):
                held[x] = held.get(x, 0) + k
        rows = [(None, n, texts), *((x - (1 << 63), k, 0) for x, k in held.items() if 2 * k * least > n)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, pa.int64()) for v in zip(*rows)], ["context", "n", "texts"])

    rows = slim.select("trained", "text").mapInArrow(count, "context long, n long, texts long") \
        .groupBy("context").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    rows = saved(rows, "lm_contexts")
    total = rows.filter("context IS NULL").first()
    n, texts = (total["n"], total["texts"]) if total else (0, 0)
    # At most 2 * least rows can pass: their counts add up to the tokens at most.
    often = rows.filter(F.col("context").isNotNull() & (F.col("n") * (2 * least) > n)).collect()
    return n, texts, {r["context"] + (1 << 63): r["n"] for r in often}


def score_texts(docs: DataFrame, trained: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score (add-one
    unigrams) and score (the model), both log10; ``trained`` marks the rows to learn from."""
    spark = docs.sparkSession
    slim = docs.select(F.shiftright(F.monotonically_increasing_id(), BATCH_BITS).alias("batch"),
                       F.coalesce(trained, F.lit(False)).alias("trained"),
                       F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    n_shards = 2 * partitions(spark)
    n, texts, frequent = frequent_contexts(slim, max(FREQUENT, 2 * n_shards))
    shards = Shards(n_shards, frequent, n)      # entries in proportion to the shards at most

    def pairs_of(table: pa.Table):
        hasher = WordHasher(SPACED)
        data, offsets = text_view(table["text"])
        found = tokens(data, offsets, hasher)
        return found, Pairs(*found, np.asarray(table["trained"]), shards)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _batches(batches):
            yield pairs_of(table)[1].messages(number)

    def answer(table: pa.Table) -> pa.Table:
        context, per_row = _unpack(table["context"], U64)
        run = _unpack(table["run"], np.uint32)[0].astype(np.int64)
        word, pairs = _unpack(table["word"], np.uint32)
        count = _unpack(table["count"], np.uint32)[0]
        seen = count > 0
        levels = to_bytes(Trie.pack(np.repeat(context, run)[seen], word[seen], count[seen], DISCOUNT))
        with Mapped(levels) as trie:
            total, many, codes = trie.lookup(context, run, word)
            words = trie.contexts.values()
            # Contexts in pieces are in several tries: they are counted below.
            vocabulary = int(((shards.pieces_of(words) == 1) & (words != START)).sum())
        cuts, pair_cuts = np.append(0, np.cumsum(per_row)), np.append(0, np.cumsum(pairs))
        out = pa.table([table["batch"], table["shard"], binary_array(total, cuts),
                        binary_array(many.astype(np.uint32), cuts), binary_array(codes, pair_cuts),
                        pa.array([None] * table.num_rows, pa.int64())],
                       names=["batch", "shard", "total", "many", "code", "vocabulary"])
        about = pa.table([pa.array([-1], pa.int64()), table["shard"].slice(0, 1), *[pa.array([b""])] * 3,
                          pa.array([vocabulary], pa.int64())], schema=out.schema)
        return pa.concat_tables([out, about])

    kind = dict(slim.dtypes)["id"]

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["id", "n_tokens", "n_known", "log_counts", "score", "unknown", "vocabulary"]
        if not left.num_rows:                       # the shards' vocabulary sizes
            v = sum(x for x in right["vocabulary"].to_pylist() if x is not None)
            return pa.table([pa.nulls(1, left.schema.field("id").type), *[pa.array([0], pa.int64())] * 2,
                             *[pa.array([0.0])] * 2, pa.array([0], pa.int64()), pa.array([v], pa.int64())], names=names)
        (row, _, word), pairs = pairs_of(left)
        right = right.sort_by("shard")
        total, many, codes = (_unpack(right[c], t)[0] for c, t in
                              (("total", np.int64), ("many", np.uint32), ("code", np.uint8)))
        if len(total) != len(pairs.runs) or len(codes) != len(pairs.words):
            raise ValueError("the rows of a batch were not the same twice; save the documents first")
        size = len(pairs.contexts)
        c = np.bincount(pairs.context_number, total, size)              # of each context, over its pieces
        n1 = np.bincount(pairs.context_number, many, size)
        own = pairs.context_number[pairs.spot]
        first = probabilities(codes) * total[pairs.spot] / np.maximum(c[own], 1)
        back = np.where(c > 0, DISCOUNT * n1 / np.maximum(c, 1), 1.0)
        # Each word's count: as the context it is for the next token; the end's is the texts'.
        end = word == END
        count = np.empty(len(word))
        count[end] = texts
        at = np.searchsorted(pairs.contexts, word[~end])
        count[~end] = c[at]
        known = count > 0
        p_word = np.where(known, (count - DISCOUNT) / max(n, 1), 1.0)
        p = first[pairs.pair] + back[own][pairs.pair] * p_word
        rows = left.num_rows
        return pa.table([left["id"], pa.array(np.bincount(row, minlength=rows)),
                         pa.array(np.bincount(row[known], minlength=rows)),
                         pa.array(np.bincount(row, np.log10(count + 1), rows)),
                         pa.array(np.bincount(row, np.log10(p), rows)),
                         pa.array(np.bincount(row[~known], minlength=rows)), pa.nulls(rows, pa.int64())], names=names)

    messages = slim.mapInArrow(ask, "shard int, batch long, context binary, run binary, word binary, count binary")
    answers = messages.groupBy("shard").applyInArrow(
        answer, "batch long, shard int, total binary, many binary, code binary, vocabulary long")
    scored = saved(slim.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        finish, f"id {kind}, n_tokens long, n_known long, log_counts double, score double, unknown long, "
                "vocabulary long"), "lm_scores")
    # Contexts in pieces have training tokens, so each is a word of the vocabulary.
    split = int(((shards.pieces > 1) & (shards.contexts != START)).sum())
    v = (scored.agg(F.sum("vocabulary")).first()[0] or 0) + split + (texts > 0)
    log_unknown = math.log10(DISCOUNT * v / n) if n else 0.0
    return scored.filter("vocabulary IS NULL").select(
        F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"),
        (F.col("score") + F.col("unknown") * F.lit(log_unknown)).alias("score"))


def held_out(id_col: str = "doc_id", parts: int = 7, part: int = 2) -> Column:
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % parts == part


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, ~held_out()).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
