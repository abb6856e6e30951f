"""Operators on single texts: tokenising, language, extraction."""

import random
import sys

import pytest
import tiktoken

from tablejobs.llm import bpe, language_id, wrappers
from tests.llm.brute import sha


@pytest.fixture(scope="module")
def tokenizer():
    path, pattern = bpe.vocabulary()
    ranks = bpe.load_ranks(path)
    return bpe.Tokenizer(ranks, pattern), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(tokenizer, documents):
    ours, library = tokenizer
    rng = random.Random(7)
    letters = "abcdeinthersou ABC012  \n\t'éüñß中文😀.,-_=#​"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", " ", "a" * 3000, " " * 2000, "ab" * 1500, "<|endoftext|>", "don't we'll"] + [d["text"] for d in documents]
    for text in texts:
        expected = library.encode_ordinary(text)
        assert ours.encode(text) == expected
        n, ids, back, valid = ours.digest(text)
        assert (n, ids, back, valid) == (len(expected), sha(" ".join(map(str, expected)).encode()), sha(text.encode()), True)


def test_bpe_survives_forgetting(tokenizer, documents, monkeypatch):
    ours = bpe.Tokenizer(tokenizer[0].transducer.ranks, bpe.vocabulary()[1])
    for bound, size in (("STATE_BYTES", 9000), ("WORD_BYTES", 4000), ("APART_BYTES", 5000)):
        monkeypatch.setattr(bpe, bound, size)
    monkeypatch.setattr(bpe, "NARROW", 3)
    for d in documents[:20]:
        assert ours.encode(d["text"]) == tokenizer[1].encode_ordinary(d["text"])


def test_bpe_memory_is_bounded_in_bytes(tokenizer, documents, monkeypatch):
    """What a worker remembers of made-up words without end stays below the bounds, and
    the bookkeeping is not below what the objects take."""
    ours = bpe.Tokenizer(tokenizer[0].transducer.ranks, bpe.vocabulary()[1])
    for bound, size in (("STATE_BYTES", 2 << 20), ("WORD_BYTES", 1 << 20), ("APART_BYTES", 1 << 19)):
        monkeypatch.setattr(bpe, bound, size)
    rng, t = random.Random(9), ours.transducer
    for _ in range(60):
        ours.digest(" ".join("".join(rng.choices("aeinrstöзж漢", k=rng.randint(3, 12))) for _ in range(400)))
        deep = sum(map(sys.getsizeof, (t.states, t.numbers, t.moves, t.emitted, t.ends)))
        deep += sum(map(sys.getsizeof, t.states)) + 60 * len(t.moves)
        deep += sum(map(sys.getsizeof, [*t.emitted.values(), *t.ends.values()]))
        words = sum(map(sys.getsizeof, [ours.words, ours.older, *ours.words, *ours.words.values()]))
        assert t.bytes < (2 << 20) + 100_000 and deep < 1.3 * t.bytes + 20_000
        assert ours.bytes < (1 << 20) + 400_000 and words < 3 * (1 << 20)
        assert len(t.apart) * bpe.ENTRY < (1 << 19) + bpe.ENTRY * 2


def test_bpe_long_texts_stream(tokenizer, monkeypatch):
    """A text above ``LONG`` is read by runs of pre-tokens, with the same ids."""
    ours = bpe.Tokenizer(tokenizer[0].transducer.ranks, bpe.vocabulary()[1])
    text = "A long text's pre-tokens: 12 345, naïve 漢字 ... \n\n  end " * 300
    whole = ours.digest(text)
    monkeypatch.setattr(bpe.Tokenizer, "LONG", 100)
    monkeypatch.setattr(bpe.Tokenizer, "RUN", 7)
    assert max(map(len, ours.runs(text))) == 7 and ours.digest(text) == whole
    assert ours.encode(text) == tokenizer[1].encode_ordinary(text)


def test_streaming_utf8():
    decoder = bpe.StreamDecoder({str(i): bytes([i]) for i in range(256)})
    state, out = bpe.START, b""
    data = "aé漢😀".encode()
    for byte in data:
        piece, state = decoder.decode([str(byte)], state)
        out += piece
    assert (out, state) == (data, bpe.START)
    for bad in (b"\x80", b"\xc0\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xe2\x82"):
        state = bpe.START
        for byte in bad:
            state = bpe.utf8_step(state, byte)
        assert state != bpe.START


def test_bpe_edges(edges, nothing):
    rows = bpe.encode_decode(edges, *bpe.vocabulary()).collect()
    assert len(rows) == edges.count()
    assert all(r.n_tokens == 0 and r.ids_sha256 == sha(b"") for r in rows if r.doc_id in (1, 2))
    assert bpe.encode_decode(nothing, *bpe.vocabulary()).count() == 0


def test_language_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = language_id.op7_language_id(spark, sf).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    own = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in own) >= 0.95 * len(own)


def test_language_edges(spark, edges, nothing):
    dictionaries = language_id.fit_dictionaries(edges)
    assert [lang for lang, _ in dictionaries] == ["en"]
    rows = language_id.identify(edges, dictionaries).collect()
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in rows if r.doc_id in (4, 6, 9)} == {"en"}
    assert language_id.fit_dictionaries(nothing) == []
    assert {r.lang_pred for r in language_id.identify(edges, []).collect()} == {"und"}
    assert language_id.identify(nothing, dictionaries).count() == 0


PAGES = [
    ("http://a.example/1", "<html><head><title>T</title></head><body><div class='menu'><a href=/>Home</a></div><article>"
     "<h1>One &amp; two</h1><p>First  para<p>Second <b>bold</b> text<br>line</article><div id=comments><p>Nice!</div>"
     "<footer>(c)</footer></body></html>", "One & two\nFirst para\nSecond bold text line"),
    ("http://a.example/2", "<html><body><article><h1>Alone</h1><ul><li>x<li>y</ul></article>"
     "<script>var t='<p>no</p>';</script><div class='cookie-notice'>We use</div>", "Alone\nx\ny"),
    ("http://b.example/1", "<div class=nav><a>n</a></div><div class=post-12><p>" + "Body text here. " * 9 + "</p><p>More of it, "
     "really. </p></div><div class=sidebar><p>side</p></div>", "Body text here. " * 8 + "Body text here.\nMore of it, really."),
    (None, None, ""), ("x", "", ""), ("http://c.example/", "no markup at all", "no markup at all"),
    ("http://c.example/", "no markup at all", "no markup at all"),
]


def test_wrappers_on_pages(spark):
    rows = [(i, u, h) for i, (u, h, _) in enumerate(PAGES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for limit in (wrappers.BROADCAST_BYTES, 0):
        wrappers.BROADCAST_BYTES, before = limit, wrappers.BROADCAST_BYTES
        try:
            got = {r.page_id: r for r in wrappers.main_texts(pages).collect()}
        finally:
            wrappers.BROADCAST_BYTES = before
        for i, (url, _, text) in enumerate(PAGES):
            assert (got[i].url, got[i].text, got[i].n_chars) == (url, text, len(text))
    assert wrappers.main_texts(pages.limit(0)).count() == 0


def test_language_of_many_copies_and_of_long_texts(spark):
    """Copies of one text don't crowd out the others, and long texts teach, too."""
    from pyspark.sql import functions as F

    copies = spark.range(200_000).select(F.lit("a copy that everybody has " * 40).alias("text"))
    others = spark.range(40).select(F.concat(F.lit("kaksi "), F.repeat(F.sha2(F.col("id").cast("string"), 256), 60)).alias("text"))
    long = spark.createDataFrame([(" " * 40_000 + "viisi sanaa on paljon " * 4_000,)], "text string")
    rows = copies.unionAll(others).select("text", F.lit("xx").alias("lang")).unionAll(long.select("text", F.lit("fi").alias("lang")))
    found = language_id.fit_dictionaries(rows)
    assert [lang for lang, _ in found] == ["xx", "fi"]
    assert found[0][1].count(b"kaksi") > 10 and found[1][1].startswith(b"viisi sanaa") and len(found[1][1]) > 32_000
    got = language_id.identify(spark.createDataFrame([(1, "viisi sanaa on paljon " * 9)], "doc_id long, text string"), found)
    assert got.first().lang_pred == "fi"


def test_short_texts_do_not_silence_long_ones(spark):
    """One short text and five long ones of a language all teach it."""
    rows = [("kurz genug", "de")] + [(f"langer text nummer {i} mit vielen verschiedenen woertern " * 1000, "de") for i in range(5)]
    rows += [("short one", "en"), ("another long text with words of its own " * 2000, "en")]
    found = dict(language_id.fit_dictionaries(spark.createDataFrame(rows, "text string, lang string")))
    assert all(len(d) > 60_000 for d in found.values())
    assert sum(f"nummer {i}".encode() in found["de"] for i in range(5)) >= 4


BODY = "The text of this page, long enough to be told from the rest of what is on it, and its number is "


def test_wrappers_of_mixed_templates(spark):
    """Pages of one host (or of none) with an article, in main, and in plain elements."""
    kinds = (["<body><div class=date>{d}</div><article><p>{t}</p></article></body>"] * 6
             + ["<body><div class=date>{d}</div><main><p>{t}</p></main></body>"] * 2
             + ["<body><div class=date>{d}</div><div class=content><p>{t}</p></div></body>"] * 20
             + ["<body><div class=date>{d}</div><div class=story><p>{t}</p></div></body>"])
    rows = [(f"{host}{k}", f"{host}{k}" if host else None, kind.format(t=BODY + str(k), d=k), BODY + str(k))
            for host in ("http://mixed.example/", "") for k, kind in enumerate(kinds)]
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id string, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in wrappers.main_texts(pages).collect()} == {r[0]: r[3] for r in rows}


def test_names_that_only_hold_a_skipped_word(spark):
    """Layout classes hide nothing; whole names of notices and the like still do."""
    kinds = ["<body class='has-sidebar'><article><p>{t}</p></article></body>", "<body class=no-sidebar><p>{t}</p></body>",
             "<main class='with-header menu'><p>{t}</p></main>", "<html class=menu-ready><body><div><p>{t}</p></div></body></html>",
             "<article class='post share-enabled' id=search><p>{t}</p></article>",
             "<body><div class='page has-sidebar'><p>{t}</p></div><div class='cookie-notice'>We use</div>"
             "<div class='box ad3'>Buy</div><div id=site-footer>(c)</div><ul role=navigation><li>n</ul></body>"]
    rows = [(k, f"http://{k}.example/", kind.format(t=BODY + str(k))) for k, kind in enumerate(kinds)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrappers.main_texts(pages).collect()} == {k: BODY + str(k) for k, _, _ in rows}


def test_wrapper_inference():
    a = wrappers.wrapper_of("<ul><li>1</li><li>2</li></ul><p>same</p><h2>a</h2><p>x</p><h2>b</h2><p>y</p>")
    b = wrappers.wrapper_of("<ul><li>1</li></ul><p>same</p><hr><div>new</div><h2>c</h2><p>z</p>")
    joined = wrappers.align(a, b)
    text = wrappers.expression(joined)
    assert text.startswith("<ul>(<li>#</li>)+</ul>") and "(<div>'new'</div>)?" in text and ")+" in text


MENU = "<div><div><a>Start</a> <a>Products and services of ours</a> <a>Contact</a></div><div>{long}</div></div>"


def test_the_hosts_wrapper_decides(spark):
    """A menu and a long notice without names are on all pages of a host: they are the
    template's. The same page alone, or on a host of copies, keeps them."""
    long = "We have been in this business for a very long time and say so on every page, at some length. " * 2
    menu = MENU.format(long=long)
    page = "<body>{m}<div><p>{t}</p><p>Second part of {k}, which is its own as well.</p></div></body>"
    rows = [(k, f"http://many.example/{k}", page.format(m=menu, t=(BODY + str(k) + ". ") * 6, k=k)) for k in range(6)]
    rows += [(10, "http://single.example/", page.format(m=menu, t=(BODY + "10. ") * 6, k=10))]
    rows += [(20 + k, "http://copies.example/", page.format(m=menu, t=(BODY + "20. ") * 6, k=20)) for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    expected = {k: (BODY + str(k) + ". ") * 6 for k, _, _ in rows if k < 10}
    found = {}
    for parts in (1, 2, 7):                             # whatever the partitioning
        found[parts] = {r.page_id: r.text for r in wrappers.main_texts(pages.repartition(parts)).collect()}
        for k, body in expected.items():
            assert found[parts][k] == f"{body.strip()}\nSecond part of {k}, which is its own as well."
        assert found[parts][10].startswith("Start Products") and len({found[parts][20 + k] for k in range(4)}) == 1
        assert "20. " in found[parts][20]
    assert found[1] == found[2] == found[7]


def test_deep_pages(spark):
    deep = "<div>" * 10_000 + "<p>the bottom</p>" + "</div>" * 10_000
    spans = "<article>" + "<span>" * 5_000 + "inside" + "</span>" * 5_000 + "<p>after</p></article>"
    rows = [(1, "http://deep.example/1", deep), (2, "http://deep.example/2", deep.replace("bottom", "end")),
            (3, "http://spans.example/", spans), (4, "http://deep.example/3", "<b>" * 20_000 + "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrappers.main_texts(pages).collect()} == {
        1: "the bottom", 2: "the end", 3: "inside\nafter", 4: "x"}


def test_wrappers_on_the_table(spark, small_dir):
    rows = wrappers.op2_html_wrappers(spark, small_dir).collect()
    assert len(rows) == spark.read.parquet(f"{small_dir}/pages.parquet").count()
    for r in rows:
        assert r.text and "track(" not in r.text and "©" not in r.text and r.n_chars == len(r.text)
