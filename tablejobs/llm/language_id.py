"""Language identification by compression.

For each language, a zstandard raw-content dictionary is filled with training
texts. A text belongs to the language whose dictionary lets it be encoded in
the fewest bytes; where the runner-up comes close, the prediction is kept but
marked as not accepted.

The model is fitted on a bounded sample of the labelled rows (the only part
that doesn't read everything). Distinct training texts are cut, from their first
letter on, into pieces of ``PIECE_CHARS`` characters; those of smallest hash, as
many as fill ``DICTIONARY_BYTES`` per language, are its dictionary. So every part
of long and short texts teaches alike. Prediction is a narrow step over whole
texts, however long.

Defined results: a null text or one without a letter is ``und`` with score 0;
rows without a language teach nothing; a null id counts as the empty text when
held-out rows are dealt; equal sizes go to the language with more training rows,
then to the first by name; without any training row everything is ``und``; an
empty table gives an empty result; repeated rows are judged row by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, groupby
from operator import itemgetter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablejobs.llm.store import read
from tablejobs.llm.textbatch import slices

#: Dictionary size per language; fewer bytes each where there are so many
#: languages that all dictionaries would exceed MODEL_BYTES.
DICTIONARY_BYTES = 64 << 10
MODEL_BYTES = 32 << 20
#: Characters of a piece of training text.
PIECE_CHARS = 4096
LEVEL = 6
#: Least relative distance to the runner-up for an accepted prediction.
MIN_MARGIN = 0.02
UNKNOWN = "und"


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2):
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % parts == part


def fit_dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang") -> list[tuple[str, bytes]]:
    """(language, dictionary) for each language, most training rows first."""
    rows = labelled.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    # Copies share a hash: a text that a third of the rows repeat counts once.
    rows = rows.select("lang", F.xxhash64("text").alias("h"), F.regexp_replace("text", "^\\P{L}+", "").alias("text"))
    pieces = F.ceil(F.length("text") / PIECE_CHARS).cast("int")
    distinct = rows.groupBy("lang", "h").agg(
        F.count("*").alias("n"), F.min(pieces).alias("pieces"), F.min(F.octet_length("text")).alias("size"))
    stats = distinct.groupBy("lang").agg(
        F.sum("n").alias("n"), F.sum("pieces").alias("pieces"), F.sum("size").alias("size")).collect()
    if not stats:
        return []
    budget = max(1, min(DICTIONARY_BYTES, MODEL_BYTES // len(stats)))
    want = {r["lang"]: 4 * budget * r["pieces"] // r["size"] + 32 for r in stats}
    spark = labelled.sparkSession
    shares = spark.createDataFrame([(r["lang"], want[r["lang"]] / r["pieces"], want[r["lang"]]) for r in stats],
                                   "lang string, share double, want long")
    # Which pieces of a text are taken is known before any is cut.
    taken = F.filter(F.sequence(F.lit(0), pieces - 1),
                     lambda i: F.xxhash64("h", i) / F.lit(2.0**64) + 0.5 <= F.col("share"))
    piece = F.substring("text", F.col("i") * PIECE_CHARS + 1, F.lit(PIECE_CHARS))
    picked = (rows.join(F.broadcast(shares), "lang")                              # one row per language
              .select("lang", "h", "text", "want", F.explode(taken).alias("i"))
              .select("lang", "h", "i", "want", piece.alias("text")).filter(F.col("text").rlike("\\p{L}"))
              .groupBy("lang", "h", "i").agg(F.min("text").alias("text"), F.min("want").alias("want"))
              .withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("h", "i"), "h", "i")))
              .filter("k <= want").select("lang", "h", "i", "text").collect())
    # Texts take turns: the first picked piece of each, then the second, as long as there is room.
    turns: dict[str, list[tuple]] = {r["lang"]: [] for r in stats}
    for (lang, h), mine in groupby(sorted(picked, key=itemgetter("lang", "h", "i")), key=itemgetter("lang", "h")):
        turns[lang] += [(turn, h, r["i"], r["text"].encode() + b"\n") for turn, r in enumerate(mine)]
    content: dict[str, bytes] = {}
    for lang, pieces_of in turns.items():
        ends = accumulate(len(p[3]) for p in sorted(pieces_of))
        room = [p for p, end in zip(sorted(pieces_of), ends) if end - len(p[3]) < budget]
        content[lang] = b"".join(p[3] for p in sorted(room, key=itemgetter(1, 2)))
    order = sorted(stats, key=lambda r: (-r["n"], r["lang"]))
    return [(r["lang"], content[r["lang"]][:budget]) for r in order]


def encoders(dictionaries: list[tuple[str, bytes]]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang, content in dictionaries:
        content = content.ljust(8, b"\n")
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                                   write_checksum=False, write_dict_id=False)))
    return out


def classify(text: bytes, models: list[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float, bool]:
    """(language, score, accepted). The score is the best encoding's advantage over
    the runner-up, as a share of the runner-up's size."""
    sizes = [len(c.compress(text)) for _, c in models]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    rest = [s for i, s in enumerate(sizes) if i != best]
    margin = (min(rest) - sizes[best]) / min(rest) if rest else 1.0
    return models[best][0], margin, margin >= MIN_MARGIN


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], id_col: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted) for every row of ``docs``."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(dictionaries)     # at most MODEL_BYTES
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = encoders(model.value)
        for part, _, _ in slices(batches):
            found = []
            for value in part.column(1).to_pylist():
                if not models or not value or not any(map(str.isalpha, value)):
                    found.append((UNKNOWN, 0.0, False))
                else:
                    found.append(classify(value.encode(), models))
            lang, score, accepted = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(accepted, pa.bool_())], ["id", "lang_pred", "score", "accepted"])

    kind = dict(slim.dtypes)["id"]
    return slim.mapInArrow(predict, f"id {kind}, lang_pred string, score double, accepted boolean") \
        .withColumnRenamed("id", id_col)


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    dictionaries = fit_dictionaries(docs.filter(~held_out()))
    return identify(docs, dictionaries).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")
