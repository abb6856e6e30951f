"""The pipeline against its stages' plain definitions."""

import corpus_pipeline as pipeline
from tablejobs.llm import bpe
from tablejobs.llm.store import read, saved
from tests.llm import brute


def test_stages(spark, small_dir, documents):
    docs = read(spark, small_dir, "documents")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in read(spark, small_dir, "benchmark").collect()]
    for k, (name, stage) in enumerate(pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        docs = saved(stage(spark, docs, small_dir), "stage")
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == docs.count()
        texts = {i: r.text for i, r in before.items()}
        if k < 4:
            assert docs.columns == columns
        if k == 0:
            gone = [brute.quality_base(texts[i]) for i in texts if i not in after]
            base = {i for i in texts if (b := brute.quality_base(texts[i]))[0] < 20 or 100 * b[4] > 30 * b[0]}
            assert gone and not base & set(after) and after == {i: before[i] for i in after}
        elif k == 1:
            assert set(after) == {i for i, (_, c) in brute.components(texts).items() if i == c}
        elif k == 2:
            marks = brute.removed(texts)
            for i, t in texts.items():
                left = bytes(b for b, g in zip(t.encode(), marks[i]) if not g)
                assert len(after[i].text.encode()) <= len(left) and after[i].n_chars == len(after[i].text)
                if not any(marks[i]):
                    assert after[i] == before[i]
        elif k == 3:
            found = brute.phrases(items)
            for i, t in texts.items():
                _, hit, _ = brute.contaminated(t, found)
                assert (after[i].text == t) == (not hit)
        else:
            library = bpe.tokenizer(*bpe.vocabulary())
            assert {i: (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.valid_utf8) for i, r in after.items()} == {
                i: library.digest(t) for i, t in texts.items()}
            assert {i: bpe.unpack_ids(r.ids) for i, r in after.items()} == {
                i: library.encode(t) for i, t in texts.items()}


def test_run_is_registered(spark, small_dir):
    import __spark_entry__ as entry

    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert names["pipeline"](spark, small_dir).count() > 0


def test_only_the_result_stays(spark, small_dir):
    from tablejobs.session import hadoop_fs, session_scratch

    fs, path = hadoop_fs(spark, session_scratch(spark))
    names = lambda: {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()
    before = names()
    result = pipeline.run(spark, small_dir)
    assert {n.rsplit("-", 1)[0] for n in names() - before} == {"pipeline_byte-level_bpe"}
    assert result.count() > 0 and "ids" in result.columns
