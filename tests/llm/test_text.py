"""Decontamination, personal data and main text against brute force."""

from __future__ import annotations

import hashlib
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterfold.llm import boost, lstm, op8_html, op9_decontaminate, op10_pii
from tests.llm.helpers import odd_documents, odd_texts, prose, rows_of

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [
    ("b", prose(1, 60)), ("a", "one"), ("c", None), ("d", ""), ("e", "two words"), ("f", prose(1, 60)), ("g", prose(7, 35)), (None, "me: a"),
    ("h", prose(2, 9)), ("b", "élan"),
]


def contaminated(rows, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD))
    windows = {}
    for i, t in items:
        w = split(t)
        n = min(len(w), 10)
        for a in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[a : a + n]), set()).add(i or "")
    sizes = {len(w) for w in windows}
    out = []
    for i, t in rows:
        w, hit, ids = split(t), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in windows:
                    hit |= set(range(a, a + n))
                    ids |= windows[tuple(w[a : a + n])]
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("rows", "items"), [(odd_texts(), ITEMS), (odd_texts(), []), ([], ITEMS), (odd_texts(), ITEMS[:1])])
def test_contamination(spark, rows, items):
    table = spark.createDataFrame([(*x, 1) for x in items], "item_id string, text string, words int")
    docs = odd_documents(spark, rows)
    got = op9_decontaminate.contamination(docs, table)
    want = contaminated(rows, items)
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    clean = op9_decontaminate.uncontaminated(docs, table)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not x[-1] for x in want)


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for k, c in enumerate(reversed(digits))) % 10 == 0


def spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return [f"{op10_pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)]


def test_personal_data(spark):
    rows = odd_texts() + [
        (30, "a@b-c.d_e@f.g x@y.z@w.v 1.2.3.4.5.6.7.8 999.1.1.1 +1 (23) 456-789-00 ++49123456789 4111 1111 1111 1111-"),
        (31, "é😀 a@b.cc é 😀 0001.2.3.4 user (at) host (dot) org (555) 123-4567 " + "7" * 3000), (32, "a" * 5000 + "@b"), (33, "1-2" * 4000),
        (34, "4111-1111 1111-1111,5500 0000 0000 0004;+12345678 +123456789012345 +1234567890123456"),
    ]
    got = {(r.doc_id, r.base_sha256): r for r in op10_pii.personal_data(odd_documents(spark, rows)).collect()}
    for i, t in rows:
        want = spans(t)
        r = got[i, hashlib.sha256(",".join(want).encode()).hexdigest()]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k in op10_pii.KINDS]
        assert set(want) <= set(r.spans.split(",")) if want else True
    assert op10_pii.personal_data(odd_documents(spark, [])).count() == 0


def test_trees_learn_and_agree_with_sql(spark):
    r = np.random.default_rng(3)
    x = r.integers(0, 10, (3000, 3)).astype(np.uint8)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 6)).astype(float)
    trees = boost.fit(x, y, trees=20, depth=3, bins=10)
    assert ((trees.margin(x) > 0) == y).mean() > 0.99
    df = spark.createDataFrame([tuple(map(int, v)) for v in x[:50]], "a int, b int, c int")
    got = [row[0] for row in df.select(trees.sql([df.a, df.b, df.c])).collect()]
    assert np.allclose(got, trees.margin(x[:50]))
    twice = boost.fit(np.concatenate([x, x]), np.concatenate([y, y]), trees=5, depth=2, bins=10)
    counted = boost.fit(x, y, np.full(len(x), 2.0), trees=5, depth=2, bins=10)
    assert np.allclose(twice.margin(x), counted.margin(x))


def test_lstm_gradients():
    r = np.random.default_rng(5)
    model = lstm.Labeller.new(4, 3)
    x, mask = lstm.padded([r.normal(size=(5, 4)), r.normal(size=(3, 4))], 4)
    y = (r.random(mask.shape) > 0.5).astype(float)
    _, grad = model.gradients(x, mask, y)
    for k, p in model.p.items():
        at = tuple(r.integers(0, n) for n in p.shape)
        old, step = p[at], 1e-5
        p[at] = old + step
        up = model.gradients(x, mask, y)[0]
        p[at] = old - step
        down = model.gradients(x, mask, y)[0]
        p[at] = old
        assert abs((up - down) / (2 * step) - grad[k][at]) < 1e-6


PAGE = (
    "<html><head><title>t</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/x'>Home</a></li></ul></nav>"
    "<div class='ad'>buy {i}</div><article><h1>Title &amp; {i}</h1><p><b>First   {i}\n line<br>more<p>Second &eacute; {i}</p></article>{more}"
    "<footer>&copy; {i}</footer></body></html>"
)


def test_main_text(spark):
    sides = ["", "<aside>side {i}</aside>", "<section class='comments'><p>nice {i}</p></section>", "<form>name {i}</form>", "<div class='cookie'>ok {i}</div>"]
    pages = [(i, f"u{i}", PAGE.replace("{more}", sides[i % 5]).replace("{i}", f"word{i}"), 1) for i in range(150)]
    odd = [(900, None, None, 1), (901, "u", "", 1), (902, "u", "<", 1), (903, "u", "plain", 1), (1, "u1", pages[1][2], 1), (None, "u", pages[2][2], 1),
           (904, "u", "<article><p>" + "long word " * 20000 + "</article>", 1), (905, "u", "<!-- a <p>b", 1), (906, "u", "<article><p>cut <b", 1)]
    got = op8_html.main_text(spark.createDataFrame(pages + odd, "page_id long, url string, html string, text int"))
    by = {(r.page_id, r.url): r for r in got.collect()}
    right = sum(by[i, f"u{i}"].text == f"Title & word{i}\n\nFirst word{i} line more\n\nSecond é word{i}" for i, *_ in pages)
    assert right >= 147  # the side blocks are new to the model but for its training leaves
    assert got.count() == len(pages) + len(odd)
    assert all(r.n_chars == len(r.text) for r in by.values())
    assert by[900, None].text == by[901, "u"].text == ""
    assert op8_html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_leaves():
    found = op8_html.leaves("<p>a<b>b</b> &lt;c<p>d</div><ul><li>e<li>f</ul><textarea>x</textarea>g")
    assert [t for _, t, _ in found] == ["ab <c", "d", "e", "f", "g"]


def texts(page):
    return [t for _, t, _ in op8_html.leaves(page)]


@pytest.mark.parametrize("tag", sorted(op8_html.EMBEDDED))
def test_embedded_elements_take_nothing_else_away(tag):
    assert texts(f"<article><p>one</p><{tag} src=x><p>two</p><p>three</p></article>") == ["one", "two", "three"]
    assert texts(f"<p>one</p><{tag}>in<{tag}>ner</{tag}>side</{tag}><p>two</p>") == ["one", "two"]
    assert texts(f"<p>one</{tag}> <{tag}/>more</p><{tag}>left out</{tag}>") == ["one more"]


def test_pages_that_break_off():
    assert texts("<p>one <two</p>") == ["one"] and texts("a < b, c <d and the rest") == ["a < b, c <d and the rest"]
    assert texts('<p>one<a href="x') == ["one"] and texts("<p>one</") == ["one</"] and texts("<p>one<b") == ["one"]
    assert texts('<p title="a > b">one</p><p>t"wo</p>') == ["one", 't"wo'] and texts('<a href="x>one</a><p>two</p>') == ["one", "two"]
    assert texts("<p>one<script>x<p>y") == ["one"] and texts("<p>one<script>x</SCRIPT>two<!-- <p> --> three") == ["onetwo three"]


@pytest.mark.parametrize("piece", ["<a ", "<a '", '<a b="', "<!--", "<!", "</", "<div>x", "<b>x", "<p><b>x", "<script>", "<video>", "</a>", "<ul><li>x", "<>\"'"])
def test_reading_takes_time_in_proportion(piece):
    began = time.monotonic()
    op8_html.leaves(piece * (300_000 // len(piece)))
    op8_html.leaves(piece * (300_000 // len(piece)) + ">" + "x</p>")
    assert time.monotonic() - began < 10


def test_a_page_of_very_many_leaves(spark):
    """Labelled alone; nothing is kept of its steps."""
    import tracemalloc

    model = lstm.Labeller.new(op8_html.TAGS + op8_html.WORDS + 4, 16)
    pages = [op8_html.leaves("<p>word</p>" * n) for n in (100_000, 3, 1, 0, 500)]
    tracemalloc.start()
    assert [len(x) for x in op8_html.labelled(model, pages)] == [100_000, 3, 1, 0, 500]
    assert tracemalloc.get_traced_memory()[1] < 500e6
    tracemalloc.stop()


def test_pages_without_an_article_are_no_lesson(spark):
    """Half of the pages, or all of them, have their text in another element."""
    body = lambda k, tag: (
        f"<html><body><nav><a href='/'>home {k}</a></nav><{tag}><h1>title {k}</h1><p>{prose(k, 30)}</p><p>{prose(k + 1, 40)}</p></{tag.split()[0]}>"
        f"<footer>imprint {k}</footer></body></html>")
    for share in (2, 1):
        pages = [(k, f"u{k}", body(k, 'div class="post-body"' if k % 2 or share == 1 else "article")) for k in range(120)]
        got = op8_html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
        right = [r.text == f"title {r.page_id}\n\n{prose(r.page_id, 30)}\n\n{prose(r.page_id + 1, 40)}" for r in got]
        assert sum(right) >= 114


def test_words_of_documents_are_counted_without_lowering_the_text(spark):
    from quarterfold.llm import op9_decontaminate as op9

    texts = ["", "Abc DEF ghi", "A@Z[`a{z~0/9:x", "Ä-Ö ÅBİ  X", "UPPER_lower-09\x00Z\x7fq", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    counted = docs.select("doc_id", op9.word_count(op9.text_of("text")).alias("n"))
    assert "translate" not in counted._jdf.queryExecution().optimizedPlan().toString()
    lowered = {r.doc_id: len(r.words) for r in op9._with_words(docs).collect()}
    assert {r.doc_id: r.n for r in counted.collect()} == lowered


def test_word_classes_are_those_of_the_contract_for_every_character(spark):
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    docs = spark.createDataFrame([("".join(every),)], "text string")
    others = {op9_decontaminate.WORD: r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]", op9_decontaminate.RAW_WORD: r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"}
    for ours, contract in others.items():
        left = docs.select(F.regexp_replace("text", F.lit(ours), F.lit(""))).first()[0]
        assert left == re.sub(contract, "", "".join(every))


def test_words_are_found_faster_than_by_the_negated_class(spark):
    rows = [(" ".join([prose(k, 20), "быстрая лиса 4711 CAPITALS, l'été"] * 30),) for k in range(1000)]
    docs = spark.createDataFrame(rows, "text string").cache()

    def seconds(found):
        taken = []
        for _ in range(4):
            start = time.perf_counter()
            total = docs.select(F.sum(found).alias("n")).first().n
            taken.append(time.perf_counter() - start)
        return min(taken), total

    for ours, contract in (
        (F.size(F.regexp_extract_all("text", F.lit(op9_decontaminate.WORD), F.lit(0))), r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
        (op9_decontaminate.word_count(F.col("text")), r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"),
    ):
        now, n = seconds(ours)
        negated, same = seconds(F.size(F.regexp_extract_all("text", F.lit(contract), F.lit(0))))
        assert n == same and now < negated / 2
    docs.unpersist()
