import collections
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import edits, fertility, packing, pages

TEXT = st.text(alphabet=st.sampled_from(list("ab é'st12!\n\t .,-日𝕏")), max_size=80)


@pytest.fixture(scope="module")
def counter():
    return edits.Counter(edits.RANKS)


@given(TEXT, st.lists(st.tuples(st.integers(0, 90), st.integers(0, 30), TEXT), max_size=6))
@settings(max_examples=150, deadline=None)
def test_edited_counts_equal_full_counts(counter, text, changes):
    document = edits.Document(text, counter.leaves(text), counter)
    for start, length, insert in changes:
        document.edit(start, length, insert)
        assert document.tree.tokens[1] == len(counter.encoding.encode_ordinary(document.text))
        assert document.tree.chars[1] == len(document.text)


def full_count(counter, text):
    """Tokens of a whole text, encoded at once; the special token is one."""
    parts = text.split(edits.SPECIAL)
    return sum(len(counter.encoding.encode_ordinary(p)) for p in parts) + len(parts) - 1


WORDY = st.lists(st.sampled_from(["def", "x", " y", "\t", "\n", "\n\t", "  ", " ", "\u00a0", "\u0085", "\u2028", "12", ",", "é", "日", "'s", "<|endoftext|>", "<|end", "oftext|>"]), min_size=400, max_size=900).map("".join)


@given(WORDY, st.lists(st.tuples(st.integers(0, 3000), st.integers(0, 40), st.text(st.sampled_from(list("a \t\n\u00a0\u2028<|endoftext|>")), max_size=14)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_counts_over_many_leaves(counter, text, changes):
    document = edits.Document(text, counter.leaves(text), counter)
    assert document.tree.tokens[1] == full_count(counter, text)
    for start, length, insert in changes:
        document.edit(start, length, insert)
        assert document.tree.tokens[1] == full_count(counter, document.text)


@pytest.mark.parametrize("text", ["\t".join(["def f():\n", "if a:\n\t", "return x, y\n"] * 90), ("def f():\n\tif a:\n\t\treturn x, y\n\treturn z\n\n" * 40)])
def test_indented_code_counts_as_encoded(counter, text):
    assert sum(t for _, t in counter.leaves(text)) == full_count(counter, text)


@pytest.mark.parametrize("unit", [" ", "\n", "x", "\u00a0", "é!"])
def test_a_million_alike(counter, unit):
    text = "a" + unit * 1_000_000 + "b"
    document = edits.Document(text, counter.leaves(text), counter)
    n = document.tree.tokens[1]
    document.edit(len(text) - 1, 1, "")
    document.edit(len(text) - 1, 0, "b")
    assert document.tree.tokens[1] == n > 0


def test_counts_agree_with_packing(counter):
    encode = packing.Encoder(packing.RANKS, packing.VOCABULARY)
    for text in ("one <|endoftext|> two", "  <|endoftext|><|endoftext|>\n x", "<|endoftext|", " " * 5000 + "x", "\t\n" * 3000):
        assert sum(t for _, t in counter.leaves(text)) == len(encode(text.encode()))


def test_an_edit_encodes_little(counter):
    text = " ".join(f"word{i % 97}" for i in range(20_000))
    document = edits.Document(text, counter.leaves(text), counter)
    document.edit(60_000, 5, "other")
    document.edit(10, 0, "more and ")
    assert document.encoded < 2000 and document.tree.tokens[1] == len(counter.encoding.encode_ordinary(document.text))


def test_edits_on_tables(spark, docs, no_docs, counter):
    trees = edits.with_trees(docs.withColumn("n_tokens", F.lit("clash")).drop("n_tokens"), ["doc_id"])
    change = F.array(F.struct(F.lit(2).cast("long").alias("start"), F.lit(3).cast("long").alias("length"), F.lit("X y").alias("insert")), F.lit(None))
    given_edits = trees.withColumn("changes", F.when(F.col("doc_id") != 7, change))
    got = edits.edited(given_edits, ["doc_id"], "changes").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.n_tokens == len(counter.encoding.encode_ordinary(r.text)) == sum(r.leaf_tokens) and sum(r.leaf_chars) == len(r.text)
    assert next(r for r in got if r.doc_id == 7).n_edits == 0
    assert edits.edited(edits.with_trees(no_docs, ["doc_id"]), ["doc_id"], edits.redactions).count() == 0


def test_redaction_query(spark, small, counter):
    from millrace.llm.registry import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op4_edits"](spark, small).collect():
        text = texts[r.doc_id]
        assert r.n_tokens_before == len(counter.encoding.encode_ordinary(text))
        for start, length, insert in edits.redactions(text):
            text = text[:start] + insert + text[start + length :]
        assert (r.n_tokens, r.n_chars) == (len(counter.encoding.encode_ordinary(text)), len(text))


def check_packed(rows, texts, capacity=1024):
    """rows of one run; texts: a list of (id, text)."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.VOCABULARY)
    want = collections.Counter()
    for key, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want[key, ids.tobytes()] += 1
    by_key = collections.defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        by_key[r.doc_id].append(r)
    for key, own in by_key.items():
        starts = collections.defaultdict(list)
        for r in own:
            starts[r.doc_tokens, r.start].append(r)
        total = sum(len(ids) // 4 * n for (k, ids), n in want.items() if k == key)
        assert sum(r.length for r in own) == total
    if len({k for k, _ in texts}) == len(texts):
        for (key, ids), _ in want.items():
            assert b"".join(bytes(r.ids) for r in sorted(by_key[key], key=lambda r: r.start)) == ids
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return sum(r.length for r in rows), len(by_sequence)


def test_packing_a_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    tokens, sequences = check_packed(packing.pack(docs.repartition(5), ["doc_id"], with_ids=True).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert sequences <= 1.01 * tokens / 1024 + 2


def test_packing_edge_rows(spark, docs, no_docs):
    rows = packing.pack(docs.withColumn("offset", F.lit("clash")), ["doc_id"], with_ids=True).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert packing.pack(no_docs, ["doc_id"]).count() == 0


@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=300), st.integers(1, 40))
@settings(max_examples=100, deadline=None)
def test_both_vocabulary_files_and_chunks_agree(text, size):
    encode = ENCODER
    from tokenizers import Tokenizer

    global SLOW
    SLOW = SLOW or Tokenizer.from_file(packing.VOCABULARY)
    want = SLOW.encode(text, add_special_tokens=False).ids
    assert encode(text.encode()).tolist() == want
    parts = list(packing.chunks(text, size))
    assert "".join(parts) == text and [i for p in parts for i in encode(p.encode()).tolist()] == want


ENCODER, SLOW = packing.Encoder(packing.RANKS, packing.VOCABULARY), None


def test_special_and_long_words():
    for text in ("a<|endoftext|>b", "x" * 10_000, " " * 9000 + "y", "né " * 5000):
        raw = text.encode()
        ids = ENCODER(raw)
        from tokenizers import Tokenizer

        assert ids.tolist() == Tokenizer.from_file(packing.VOCABULARY).encode(text, add_special_tokens=False).ids


def brute_facts(text):
    words = text.encode().split()
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            again.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    chars = sum(c not in " \t\n\x0b\x0c\r" for c in text)
    return len(words), chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)


@given(st.text(alphabet=st.sampled_from(list("ab #|\n\té\x0b\x85 ")), max_size=120))
@settings(max_examples=300, deadline=None)
def test_word_facts(text):
    assert fertility.word_facts(text.encode(), text) == brute_facts(text)


def test_fertility_bands(spark):
    rng = np.random.default_rng(5)
    words = "the quick brown fox jumps over a lazy dog while many people watch from the old stone bridge near town".split()
    rows = [(i, " ".join(rng.choice(words, 80)), "en") for i in range(200)]
    rows += [(1000, " ".join(f"%&#{x}" for x in rng.integers(0, 10**9, 80)), "en"), (1001, " ".join(["zq"] * 4 + ["vv"] * 4 + [str(i) for i in range(9)] * 4), "en")]
    got = {r.doc_id: r for r in fertility.rate(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sum(not got[i].kept for i in range(200)) == 0 and not got[1000].kept and not got[1001].kept and got[1001].base_failed


def prose_and_soup(seed):
    rng = np.random.default_rng(seed)
    words = "the quick brown fox jumps over a lazy dog while many people watch from the old stone bridge near town".split()
    return lambda: " ".join(rng.choice(words, 80)), lambda: " ".join(f"%&#{x}" for x in rng.integers(0, 10**9, 80))


@pytest.mark.parametrize("lang", ["xx", None, "en"])
@pytest.mark.parametrize("many", [200, 12])
def test_rare_languages_and_small_tables_get_a_verdict(spark, lang, many):
    prose, soup = prose_and_soup(7)
    rows = [(i, prose(), "en") for i in range(many)] + [(1000, soup(), lang), (1001, soup(), lang), (1002, prose(), lang)]
    rows += [(1003, " ".join("Ж%dщ☃☂" % i for i in range(40)), lang)]  # a script of one document
    got = {r.doc_id: r for r in fertility.rate(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sorted(got) == [*range(many), 1000, 1001, 1002, 1003]
    assert {k for k, r in got.items() if not r.kept} == {1000, 1001, 1003} and not any(r.base_failed for r in got.values())


def test_fertility_without_sound_documents(spark):
    rows = [(1, "few words", "en"), (2, None, None)]
    got = fertility.rate(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == 2 and all(r.base_failed and r.kept is False for r in got)


def test_fertility_edge_rows(spark, docs, no_docs):
    got = fertility.rate(docs.withColumn("kept", F.lit("clash"))).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    for r in got:
        assert not (r.kept and r.base_failed) and 0 <= r.byte_share <= 1 and 0 <= r.entropy <= 1
        if r.doc_id is not None and r.doc_id != 10:
            facts = brute_facts(texts[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == facts
            assert r.base_failed == (facts[0] < 10 or 100 * facts[4] > 20 * facts[0])
    assert fertility.rate(no_docs).count() == 0


PAGE = """<html><head><title>t</title><script>var a = "<p>no</p>";</script></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav><div id="cookie-notice"><p>We use cookies</div>%s
<div class="sidebar"><p>Read this</p></div><form>Name <input></form><section id="comments"><p>I disagree with it</p></section><footer>&copy; me</footer>"""


@pytest.mark.parametrize("body, text", [
    ("<article><h1>One &amp; two</h1><p>First\n  <b>bold</b>er <a href='a>b'>link</a>.<p>Second<br>line<div class=ad>Buy!<p>Now</div><p>x &lt; y</article>", "One & two First bolder link. Second line x < y"),
    ("<main><header><h2>Head</h2></header><p>Short.</p><article><p>me too</p></article></main>", "Head Short. me too"),
    ("<article><p>Text</p><section><article><p>a remark</p></article></section></article>", "Text"),
    ("<div><p>" + "A long paragraph without any article around it. " * 3 + "</p><p>And an end.</p></div>", ("A long paragraph without any article around it. " * 3 + "And an end.").strip()),
    ("", ""),
])
def test_main_text(body, text):
    assert pages.main_text(PAGE % body) == text


def test_page_rows(spark):
    rows = [(1, "u", PAGE % "<article>A b</article>"), (1, "u", PAGE % "<article>A b</article>"), (2, None, None), (None, "v", ""), (3, "w", "<p>" * 20_000 + "deep" + "<" * 2000), (4, "x", "<p class='ad")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in pages.extract(df, ["page_id", "url"]).collect()}
    assert got[1, "u"] == ("A b", 3) and got[2, None] == got[None, "v"] == ("", 0) and got[3, "w"][0].startswith("deep")
    assert pages.extract(df.limit(0), ["page_id", "url"]).count() == 0


def test_pages_of_a_table(spark, small):
    import html
    import re

    for r in pages.extract(spark.read.parquet(f"{small}/pages.parquet"), ["page_id", "html"]).collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", article)).split()) and r.n_chars == len(r.text)


LONG = "Plain sentences of a page that fill one block after the other, as in a report of some length. " * 4
DENSE = f"<div>{LONG}</div><div>{LONG}</div><div>{LONG}</div>"
CARD = "<article><h3><a href=z>Another story</a></h3><p>A teaser that says in some ninety characters what the other story is about, and more.</p></article>"


@pytest.mark.parametrize("body, text", [
    (DENSE + CARD, LONG * 3),  # the text is in plain blocks, a teaser is marked as an article
    (CARD + DENSE, LONG * 3),
    (f"<div>{LONG}</div><div>{LONG}</div>{CARD}<div>{LONG}</div><div>The end.</div>", LONG * 3 + "The end."),
    (f"<main><p>Skip.</p></main>{DENSE}", LONG * 3),
    (DENSE.replace("div", "p"), LONG * 3),  # no article at all
    (f"<div>{LONG}</div><article>{DENSE[: len(DENSE) // 3 * 2]}</article>", LONG * 3),  # as dense outside as in the article
    (f"<div>Filed under news</div><article>{DENSE}</article><div>Top of page</div>", LONG * 3),
    (f"<article><h1><a href=z>Head</a></h1>{DENSE}<div class=ad>x</div><div class=ad>x</div><div class=ad>x</div><p>And then it was over.</p><p><a href=q>Source</a></p></article>", "Head " + LONG * 3 + "And then it was over. Source"),
    ("<article><p><a href=z>Only a link</a></p></article>", "Only a link"),
])
def test_windows_choose_the_text(body, text):
    assert pages.main_text(PAGE % body).split() == text.split()


def test_pages_of_a_table_without_article_tags(spark, small):
    for r in spark.read.parquet(f"{small}/pages.parquet").collect():
        assert pages.main_text(r.html.replace("article>", "div>")) == pages.main_text(r.html)


@pytest.mark.parametrize("name", [
    "ad-hoc committee", "share-price", "social-history", "search-strategy", "notice-of-meeting", "wp-block alert-level", "widget-theory", "related-work", "menu-costs", "banner-blindness",
])
def test_words_of_a_class_remove_no_text(name):
    body = f"<article>{DENSE}<section class='{name}'><p>{LONG}</p></section><div id='{name}'><p>{LONG}</p></div></article>"
    assert pages.main_text(PAGE % body).split() == (LONG * 5).split()
    assert pages.main_text(PAGE % body.replace("article>", "div>")).split() == (LONG * 5).split()


@pytest.mark.parametrize("part", [
    "<div class=ad><p>Buy this now!</p></div>", "<aside><p>" + "Read more of this. " * 20 + "</p></aside>", "<div class='comments'><p>" + "I disagree with all of it. " * 20 + "</p></div>",
    "<div class='cookie-note'>We use them</div>", "<div hidden>" + "Not to be seen. " * 20 + "</div>",
])
def test_boilerplate_inside_an_article_goes(part):
    assert pages.main_text(PAGE % f"<article>{DENSE}{part}<p>{LONG}</p></article>").split() == (LONG * 4).split()


def test_text_inside_one_marked_element_stays():
    assert pages.main_text(PAGE % f"<article><h1>Head</h1><div class=notice>{DENSE}</div></article>").split() == ("Head " + LONG * 3).split()


def plain_runs(weight, there, threshold):
    """Surges and dives one window after the other."""
    kept, run = [], []
    windows = [sum(weight[i : i + pages.WINDOW]) for i in range(len(weight))]
    for i in range(len(weight) + 1):
        if not any(there[i : i + pages.WINDOW]):
            if any(windows[j] >= threshold for k in run for j in range(max(0, run[0] - pages.WINDOW + 1), run[-1] + 1) if j >= 0):
                kept += run
            run = []
        elif there[i]:
            run.append(i)
    return kept


@given(st.lists(st.tuples(st.integers(0, 60), st.booleans()), max_size=30), st.integers(1, 120))
@settings(max_examples=200, deadline=None)
def test_line_blocks_against_a_plain_version(lines, threshold):
    weight = np.array([w if t else 0 for w, t in lines], np.int64)
    there = np.array([t and w > 0 for w, t in lines], bool)
    assert pages.surged(weight, there, threshold) == plain_runs(weight.tolist(), there.tolist(), threshold)


def plain_text(page):
    """The article by line blocks alone: no class or id is looked at."""
    import re

    return pages.main_text(re.sub(r"\s(class|id)=(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", page))


def test_marks_decide_few_given_pages(spark, small):
    rows = [r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    assert sum(plain_text(h) == pages.main_text(h) for h in rows) >= 0.95 * len(rows)
