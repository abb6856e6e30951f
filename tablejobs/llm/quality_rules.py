"""Quality rules by weak supervision (built-in functions only).

Each rule looks at one measure of a text and votes good (+1) or bad (-1) or
abstains (0). Nobody says how far a rule can be trusted: expectation
maximisation over the corpus' vote patterns estimates, for each rule, how often
it casts each vote on good and on bad texts. A document's verdict is then the
posterior probability of being good, given its votes.

Only counts per vote pattern reach the driver: at most ``3 ** len(RULES)`` rows
however large the corpus is, aggregated on the map side first. Everything per
document is one narrow projection; no text is shuffled.

Defined results: a null or wordless text has zero measures and fails the base
test; an empty table gives an empty result (uninformative parameters); repeated
rows are judged row by row; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.store import read, saved

#: White space as Spark's regular expressions write it: \x20 and \x09-\x0D.
_SPACE = "[\\x20\\x09-\\x0D]"
#: Words per window when counting repeated words.
WINDOW = 8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Measures only the rules use.
_RULE_MEASURES = ("n_lines", "n_distinct_words", "n_sentence_lines", "n_non_letters")


def measures(docs: DataFrame, text: str = "text", prefix: str = "_q_") -> DataFrame:
    """``docs`` with a long column ``prefix + name`` for each measure.

    Arrays that later steps use more than once get a projection of their own,
    so that Spark computes each of them once.
    """
    p = lambda name: f"{prefix}{name}"      # noqa: E731
    c = lambda name: F.col(p(name))         # noqa: E731
    keep = [F.col(f"`{x}`") for x in docs.columns]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    tail = lambda col, k: F.slice(c(col), k + 1, F.greatest(F.size(c(col)), F.lit(1)))

    df = docs.select(
        *keep,
        F.filter(F.split(body, f"{_SPACE}+", -1), lambda w: w != "").alias(p("words")),
        F.filter(F.split(body, "\n", -1),
                 lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias(p("lines")),
        F.length(F.regexp_replace(body, "[^#*$%&|<>]+", "")).cast("long").alias(p("n_symbols")),
        F.length(F.regexp_replace(body, "[\\p{L}\\x20\\x09-\\x0D]+", "")).cast("long")
        .alias(p("n_non_letters")))
    df = df.select(
        *keep, c("n_symbols"), c("n_non_letters"),
        F.size(c("words")).cast("long").alias(p("n_words")),
        F.aggregate(c("words"), F.lit(0).cast("long"),
                    lambda a, w: a + F.length(w)).alias(p("word_chars")),
        F.size(c("lines")).cast("long").alias(p("n_lines")),
        (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long").alias(p("n_dup_lines")),
        F.size(F.filter(c("lines"), lambda line: line.rlike("[.!?][\"')]?\\s*$"))).cast("long")
        .alias(p("n_sentence_lines")),
        F.transform(c("words"), lambda w: F.xxhash64(w)).alias(p("h1")))
    df = df.withColumn(p("n_distinct_words"), F.size(F.array_distinct(c("h1"))).cast("long"))
    # Hashes of 2, 4 and 8 words, each from two of half the length. zip_with pads
    # with nulls past the end; only whole windows are kept below.
    for half in (1, 2, 4):
        df = df.withColumn(p(f"h{2 * half}"),
                           F.zip_with(c(f"h{half}"), tail(f"h{half}", half),
                                      lambda a, b: F.xxhash64(a, b))).drop(p(f"h{half}"))
    df = df.withColumn(p("h8"), F.slice(c("h8"), 1, F.greatest(c("n_words") - (WINDOW - 1), F.lit(0)).cast("int")))
    # Sorted (hash, place) pairs, for texts in which some window occurs twice.
    df = df.withColumn(p("pairs"), F.when(
        F.size(F.array_distinct(c("h8"))) < F.size(c("h8")),
        F.sort_array(F.transform(c("h8"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop(p("h8"))
    df = df.withColumn(p("places"), F.sort_array(F.transform(F.filter(
        c("pairs"), lambda x, i: F.coalesce(x["h"] == F.get(c("pairs"), i - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(c("pairs"), i + 1)["h"], F.lit(False))),
        lambda x: x["i"]))).drop(p("pairs"))
    # Windows at sorted places cover min(WINDOW, distance to the next) words each.
    covered = F.aggregate(
        F.zip_with(c("places"), F.slice(c("places"), 2, F.greatest(F.size(c("places")), F.lit(1))),
                   lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, b: a + b)
    return df.select(*keep, *[c(m) for m in MEASURES[:-1]], *[c(m) for m in _RULE_MEASURES],
                     F.coalesce(covered, F.lit(0).cast("long")).alias(p("n_repeat_words")))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules(prefix: str = "_q_") -> dict[str, Column]:
    """The rules' votes, from the measures. A rule votes bad only on marked
    cases; rules that look for one defect abstain where they don't find it."""
    m = lambda name: F.col(f"{prefix}{name}")
    n, lines, chars = m("n_words"), m("n_lines"), m("word_chars")
    never = F.lit(False)
    return {
        "length": _vote(n < 20, n >= 50),
        "symbols": _vote(m("n_symbols") > 0.1 * n, never),
        "letters": _vote(m("n_non_letters") > 0.12 * chars, m("n_non_letters") <= 0.08 * chars),
        "dup_lines": _vote(m("n_dup_lines") > 0.4 * lines, never),
        "repeats": _vote(m("n_repeat_words") > 0.3 * n, never),
        "word_length": _vote((chars < 2.5 * n) | (chars > 12 * n), (chars >= 3.5 * n) & (chars <= 8 * n)),
        "variety": _vote((n >= 50) & (m("n_distinct_words") < 0.1 * n),
                         m("n_distinct_words") >= 0.4 * n),
        "sentences": _vote((lines >= 8) & (m("n_sentence_lines") < 0.05 * lines),
                           (lines > 0) & (m("n_sentence_lines") >= 0.6 * lines)),
    }


RULES = ("length", "symbols", "letters", "dup_lines", "repeats", "word_length", "variety", "sentences")


def base_failed(prefix: str = "_q_") -> Column:
    m = lambda name: F.col(f"{prefix}{name}")
    return (m("n_words") < 20) | (100 * m("n_repeat_words") > 30 * m("n_words"))


#: What a rule is expected to vote on good and on bad texts, before any data:
#: bad votes are rarely false alarms, and a bad text has some defects, not all.
PRIOR_GOOD = {-1: 0.002, 0: 0.098, 1: 0.9}
PRIOR_BAD = {-1: 0.3, 0: 0.2, 1: 0.5}
#: Weight of that expectation, as a share of the documents.
PRIOR_WEIGHT = 0.1


def fit(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 100) -> tuple[float, list[dict]]:
    """Expectation maximisation over counted vote patterns.

    Returns the log odds of good before any vote and, per rule, the log
    likelihood ratio (good : bad) of each of its votes. It starts from texts
    without a bad vote as probably good. Bad texts come in kinds (junk symbols,
    endless repeats) that different rules notice; the expected votes above,
    weighted by ``PRIOR_WEIGHT``, keep one kind from being taken for all of them.
    A bad vote never speaks for a text, nor a good one against it.
    """
    total = sum(c for _, c in patterns)
    if not total:
        return 0.0, [{v: math.log(PRIOR_GOOD[v] / PRIOR_BAD[v]) for v in (-1, 0, 1)} for _ in range(n_rules)]
    post = [0.05 if min(votes, default=0) < 0 else 0.95 for votes, _ in patterns]
    odds, ratios, weight = 0.0, [], PRIOR_WEIGHT * total
    for _ in range(rounds):
        good = sum(p * c for p, (_, c) in zip(post, patterns))
        odds = math.log((good + 0.9 * weight) / (total - good + 0.1 * weight))
        ratios = []
        for j in range(n_rules):
            seen = {v: [weight * PRIOR_GOOD[v], weight * PRIOR_BAD[v]] for v in (-1, 0, 1)}
            for p, (votes, c) in zip(post, patterns):
                seen[votes[j]][0] += p * c
                seen[votes[j]][1] += (1 - p) * c
            r = {v: math.log(a / (good + weight)) - math.log(b / (total - good + weight))
                 for v, (a, b) in seen.items()}
            ratios.append({-1: min(r[-1], 0.0), 0: 0.0, 1: max(r[1], 0.0)})
        new = [1 / (1 + math.exp(-max(-500.0, min(500.0, odds + sum(r[v] for r, v in zip(ratios, votes))))))
               for votes, _ in patterns]
        moved = max(abs(a - b) for a, b in zip(new, post))
        post = new
        if moved < 1e-9:
            break
    return odds, ratios


def vote_patterns(measured: DataFrame, prefix: str = "_q_") -> list[tuple[tuple[int, ...], int]]:
    """Documents per vote pattern; at most 3 ** rules rows come to the driver."""
    votes = rules(prefix)
    rows = measured.groupBy(*[v.alias(k) for k, v in votes.items()]).count().collect()
    return sorted((tuple(r[k] for k in votes), r["count"]) for r in rows)


def posterior(odds: float, ratios: list[dict], prefix: str = "_q_") -> Column:
    """Probability that the document is good."""
    total = F.lit(odds)
    for vote, ratio in zip(rules(prefix).values(), ratios):
        total = total + F.when(vote < 0, ratio[-1]).when(vote > 0, ratio[1]).otherwise(ratio[0])
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                     threshold: float = 0.5) -> DataFrame:
    """One row per document: its id, the measures, ``base_failed``, the
    posterior ``quality`` and ``kept``. The measures are written to the shared
    folder once; fitting and judging read them back, not the texts."""
    # Unnamed like this, no other column of the table can clash with the measures.
    slim = docs.select(F.col(f"`{id_col}`").alias("_q_id"), F.col(f"`{text}`").alias("_q_text"))
    measured = saved(measures(slim, "_q_text").drop("_q_text"), "quality_measures")
    odds, ratios = fit(vote_patterns(measured), len(RULES))
    judged = measured.withColumn("quality", posterior(odds, ratios))
    return judged.select(
        F.col("_q_id").alias(id_col), *[F.col(f"_q_{m}").alias(m) for m in MEASURES],
        base_failed().alias("base_failed"), "quality",
        (~base_failed() & (F.col("quality") >= threshold)).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents worth keeping, all their columns as they were. The documents are
    written once with their measures, then judged as they are read back: the
    texts are split into words only once, and nothing is shuffled."""
    prefix = "_q_"
    while any(x.startswith(prefix) for x in docs.columns):
        prefix = "_" + prefix
    measured = saved(measures(docs, text, prefix), "quality_measured")
    odds, ratios = fit(vote_patterns(measured, prefix), len(RULES))
    kept = ~base_failed(prefix) & (posterior(odds, ratios, prefix) >= threshold)
    return measured.filter(kept).select(*[F.col(f"`{x}`") for x in docs.columns])


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_verdicts(read(spark, sf_dir, "documents"))
