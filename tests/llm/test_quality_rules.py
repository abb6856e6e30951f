from tablejobs.llm.quality_rules import MEASURES, RULES, fit, keep_good, op9_quality_rules, quality_verdicts
from tests.llm.brute import quality_base


def test_measures_match_their_definition(spark, small_dir, documents):
    texts = {d["doc_id"]: d["text"] for d in documents}
    rows = op9_quality_rules(spark, small_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = quality_base(texts[r.doc_id])
        assert tuple(r[m] for m in MEASURES) == base
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        assert r.base_failed == failed and (not failed or not r.kept)


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("quality", "label")
    rows = op9_quality_rules(spark, sf).select("doc_id", "kept", "base_failed").join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.label == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.label == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.5 * len(bad)


def test_em_learns_which_votes_to_trust():
    # Two rules agree; a third says the opposite of nothing in particular.
    patterns = [((1, 1, 1), 450), ((1, 1, -1), 5), ((-1, -1, 1), 40), ((-1, -1, -1), 5)]
    odds, ratios = fit(patterns, 3)
    assert odds > 0 and ratios[0][-1] < -2 and ratios[0][1] > 0
    assert all(r[-1] <= 0 <= r[1] for r in ratios)
    assert len(fit([], len(RULES))[1]) == len(RULES)


def test_edges(edges, nothing):
    rows = quality_verdicts(edges).collect()
    assert len(rows) == edges.count()
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert (r.n_words, r.base_failed, r.kept) == (0, True, False)
    kept = keep_good(edges)
    assert kept.columns == edges.columns and kept.dtypes == edges.dtypes
    assert quality_verdicts(nothing).count() == 0 and keep_good(nothing).count() == 0
    clash = edges.withColumnRenamed("k", "_q_n_words").withColumnRenamed("bucket", "quality")
    assert keep_good(clash).count() == kept.count()


def test_no_python_in_the_plan(spark, small_dir):
    from tablejobs.llm.quality_rules import measures

    plan = measures(spark.read.parquet(f"{small_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))
