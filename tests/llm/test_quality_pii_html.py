"""Operators that judge one text at a time, against plain rules and small cases."""

import hashlib
import os
import re
import time
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chainstar.llm import html_text, pii, quality
from chainstar.llm.quality import base_figures, clean_text, line_fault

GOOD = "The river ran past the old mill and the children watched the boats go by in the sun. "


def brute_repeat(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    return len({i + o for i, w in enumerate(windows) if count[w] > 1 for o in range(3)})


@pytest.mark.parametrize("text", ["", " \n\t ", "a", "a b c", "a b c a b c a", "x x x x x x", "a b c d a b c e f\na b c",
                                  "one two\none two\n\none two \n", "é ü\x0bz # $ | <a>"])
def test_base_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, chars, symbols, dup, rep = base_figures(text)
    assert n == len(words) and chars == sum(map(len, words))
    assert symbols == len(re.findall(r"[#*$%&|<>]", text))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    assert dup == len(lines) - len(set(lines))
    assert rep == brute_repeat(words)


@pytest.mark.parametrize("line,fault", [
    (GOOD.strip(), None), ("Home | About | News | Contact", "noise"), ("Home · About · News", "navigation"),
    ("BUY!! NOW!! CHEAP!! PILLS!!", "shouting"), ("READ THIS ALL NOW.", "shouting"), ("Contact", "navigation"),
    ("Licensed under the Apache License, Version 2.0.", "boilerplate"), ("All rights reserved.", "boilerplate"),
    ("a### b### c###", "noise"), ("He said so.", None),
    # Words of notices in plain prose stay; the notices themselves go, in each language of the corpus.
    ("My grandmother baked one cookie for each of us on Sundays.", None),
    ("JavaScript closures capture variables, not values.", None), ("Copyright law is older than the printing press.", None),
    ("The ship was powered by two diesel engines.", None), ("Few readers subscribe to that theory.", None),
    ("We use cookies to improve your visit.", "boilerplate"), ("Please enable JavaScript to go on reading.", "boilerplate"),
    ("Copyright © 2019 by the authors of this page.", "boilerplate"), ("Alle Rechte vorbehalten, auch für Bilder.", "boilerplate"),
    ("Ce site utilise des cookies pour votre confort.", "boilerplate"), ("Todos los derechos reservados por la editorial.", "boilerplate"),
    ("ВСЕ ПРАВА ЗАЩИЩЕНЫ, копирование запрещено законом.", "boilerplate")])
def test_line_rules(line, fault):
    assert line_fault(line) == fault


def test_clean_text_removes_lines_and_counts_loss():
    text, lost, total = clean_text(GOOD + "\nHome\n\n" + GOOD)
    assert text == GOOD + "\n\n" + GOOD and lost == 4 and total == 2 * len(GOOD.strip()) + 4


def test_quality_defined_results(spark, docs_of):
    long_text = " ".join(f"word{i}" for i in range(200_000)) + "."
    docs = docs_of([None, "", GOOD * 1, " ".join(f"w{i}" for i in range(60)) + ".", long_text, "Menu\n" * 80, long_text],
                   ids=[0, None, 2, 3, 4, 5, 4])
    got = sorted(((r.doc_id is not None, r.doc_id), r.n_words, r.base_failed, r.kept) for r in quality.quality(docs).collect())
    assert got == [((False, None), 0, True, False), ((True, 0), 0, True, False), ((True, 2), 18, True, False),
                   ((True, 3), 60, False, True), ((True, 4), 200_000, False, True), ((True, 4), 200_000, False, True),
                   ((True, 5), 80, True, False)]
    kept = quality.clean(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 4]
    assert quality.quality(docs.limit(0)).count() == 0 and quality.clean(docs.limit(0)).count() == 0


def test_clean_updates_the_length(spark, docs_of):
    text = "Home\n" + " ".join(f"w{i}" for i in range(60)) + "."
    row = quality.clean(docs_of([text])).first()
    assert row.text == text[5:] and row.n_chars == len(text) - 5 and row.kept == "x"


# -- personal data ---------------------------------------------------------------------

@pytest.mark.parametrize("text,found", [
    ("", []), ("a.b@c.example.com x", ["email:0:17"]), ("1.2.3.4 and 1.2.3.256", ["ip:0:7"]),
    ("4111 1111 1111 1111", ["card:0:19"]), ("4111 1111 1111 1112", []), ("+49 (171) 123-4567", ["phone:0:18"]),
    ("+12 345", []), ("a@b", []), ("é x@y.z", ["email:2:7"])])
def test_base_spans(text, found):
    base, every = pii.spans(text)
    assert pii.told(base) == ",".join(found) and base == every


@pytest.mark.parametrize("text,hidden,kind", [
    ("mail john dot doe at example dot com now", "john dot doe at example dot com", "email"),
    ("write john [at] example [dot] com.", "john [at] example [dot] com", "email"),
    ("write john(at)example.com today", "john(at)example.com", "email"),
    ("jоhn@exаmple.com", "jоhn@exаmple.com", "email"),
    ("x@mail​5.example.com", "x@mail​5.example.com", "email"),
    ("a@b&#46;com", "a@b&#46;com", "email"),
    ("１９２．１６８．１．１ x", "１９２．１６８．１．１", "ip"),
    ("at one nine two dot one six eight dot one dot one", "one nine two dot one six eight dot one dot one", "ip"),
    ("call plus four nine one seven one two three four five six, ok", "plus four nine one seven one two three four five six", "phone"),
    ("card four " + "one " * 15 + "end", "four " + ("one " * 15).strip(), "card")])
def test_disguises_map_back(text, hidden, kind):
    base, every = pii.spans(text)
    assert base == [] and [(k, text[a:b]) for k, a, b in every] == [(kind, hidden)]
    assert pii.mask(text) == text.replace(hidden, f"<{kind.upper()}>")


@pytest.mark.parametrize("text", ["Look at the dot on the map.", "un six neuf deux le sept", "He was at home. Dot com fell.",
                                  "look at example.com", "Il est un point sur la carte de un deux trois."])
def test_ordinary_text_stays(text):
    assert pii.spans(text) == ([], []) and pii.mask(text) == text


def test_rewrite_keeps_offsets():
    text = "аb [at] c one two"
    flat, start, end, rule = pii.rewrite(text)
    assert flat == "ab@c 12" and len(flat) == len(start) == len(end) == len(rule)
    assert [text[a:b] for a, b in zip(start, end)] == ["а", "b", " [at] ", "c", " ", "one", "two"]


@pytest.mark.parametrize("text,hidden,kind", [
    ("at 192.168.one.one now", "192.168.one.one", "ip"), ("on 192.168.1.One.", "192.168.1.One", "ip"),
    ("one nine two.one six eight.one.one", "one nine two.one six eight.one.one", "ip"),
    ("call plus 49 171 1234567 now", "plus 49 171 1234567", "phone"),
    ("call +49 171 123 four five six seven", "+49 171 123 four five six seven", "phone"),
    ("card 4111 1111 1111 111 one", "4111 1111 1111 111 one", "card"),
    ("mail john at example dot berlin now", "john at example dot berlin", "email"),
    ("an ſix.two.three.four", "ſix.two.three.four", "ip")])
def test_disguises_without_other_signs(text, hidden, kind):
    base, every = pii.spans(text)
    assert base == [] and [(k, text[a:b]) for k, a, b in every] == [(kind, hidden)]


@pytest.mark.parametrize("text", ["We met at some point during spring.", "Call +49 171 1234567 one of us.", "αβΒο Σ İ",
                                  "one" + " " * 50_000 + "x" + " at" + " \t" * 25_000 + "(" * 1000])
def test_plain_words_add_nothing(text):
    base, every = pii.spans(text)
    assert every == base
    flat, start, _, rule = pii.rewrite(text)
    assert len(flat) == len(start) and all(r or x == text[a] for x, a, r in zip(flat, start, rule))


def test_spans_are_those_of_the_rewritten_text():
    """Every card and address of numbers in the rewritten text is found, whatever other signs the text has."""
    import random

    rng = random.Random(3)
    bits = ["one", "Two", "drei", "cinq", "7", "192", ".", ".", " ", " dot ", "-", "plus ", "[dot]", "x", "４", "\u200b", " at "]
    for _ in range(20_000):
        text = "".join(rng.choices(bits, k=14))
        flat, start, end, rule = pii.rewrite(text)
        every = pii.spans(text)[1]
        for kind, a, b in pii.plain_spans(flat):
            if kind in ("ip", "card") and any(rule[a:b]):
                lo, hi = start[a], end[b - 1]
                clash = [s for s in pii.plain_spans(text) if s[0] == kind and s[1] < hi and lo < s[2]]
                assert clash or any(k == kind and lo <= x and y <= hi for k, x, y in every), text


def test_pii_tables(spark, docs_of):
    docs = docs_of([None, "", "a@b.co " * 3, "x" * 100_000 + " 1.2.3.4"], ids=[0, None, 2, 3], extra="spans")
    got = {r.doc_id: r for r in pii.detect(docs).collect()}
    assert got[0].spans == "" and got[2].n_email == 3 and got[3].spans == "ip:100001:100008"
    red = pii.redact(docs)
    rows = {r.doc_id: r for r in red.collect()}
    assert red.columns == docs.columns and rows[0].text is None and rows[2].text == "<EMAIL> " * 3
    assert rows[2].n_chars == len(rows[2].text)
    assert pii.redact(docs.limit(0)).count() == 0 and pii.detect(docs.limit(0)).count() == 0
    assert pii.base_digest("") == hashlib.sha256(b"").hexdigest()


# -- pages -----------------------------------------------------------------------------

PAGES = "/root/testdata/sf0.1/pages.parquet"
LONG = "A paragraph of the article that goes on for a while, with enough words to stand out from menus."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>
<div class="ad">Buy this now, it is a very good thing to have and to hold for everyone.</div>
<article><h1>Head &amp; line</h1><p><b>{LONG}<br><p>Short.</p><aside>Side text</aside>
<form><input><label>Mail</label></form><section id="comments"><p>{LONG} says a reader.</p></section></article>
<footer>&copy; site</footer><div class="cookie-notice">We use cookies.</div>"""


def test_article_is_found():
    assert html_text.main_text(PAGE) == f"Head & line\n{LONG}\nShort."


def test_page_without_article():
    page = (f'<body><div id="menu"><a>a</a><a>b</a></div><div class="content"><h2>Title</h2><p>{LONG}</p><p>{LONG}</p>'
            f'<p>End.</p></div><div id="sidebar"><p>{LONG}</p></div></body>')
    assert html_text.main_text(page) == f"Title\n{LONG}\n{LONG}\nEnd."


@pytest.mark.parametrize("page,text", [(None, ""), ("", ""), ("<nav>x</nav>", ""), ("plain  text\n", "plain text"),
                                       ("<p>a<b>b</b>c</p><p>d", "abc\nd"), ("<script>x", ""),
                                       ("<article><p>x&nbsp;y</p></article>", "x y")])
def test_small_pages(page, text):
    assert html_text.main_text(page) == text


BLOCK = " ".join([LONG] * 6)


@pytest.mark.parametrize("tag", ["pre", "blockquote", "ul", "div", "table"])
def test_no_region_beside_the_longest_block_is_lost(tag):
    inner = {"ul": f"<li>{BLOCK}</li>", "table": f"<tr><td>{BLOCK}</td></tr>"}.get(tag, BLOCK)
    page = f'<body><div id="content"><p>{LONG}</p><{tag}>{inner}</{tag}><p>{LONG}</p></div><div class="ad">{LONG}</div></body>'
    assert html_text.main_text(page) == f"{LONG}\n{BLOCK}\n{LONG}"


def test_every_article_of_a_main_is_kept():
    two = f"<article><p>{LONG} {LONG}</p></article><article><p>{LONG}</p></article>"
    assert html_text.main_text(f"<main>{two}</main>") == f"{LONG} {LONG}\n{LONG}"
    assert html_text.main_text(f"<main><p>{LONG} Intro.</p>{two}</main>") == f"{LONG} Intro.\n{LONG} {LONG}\n{LONG}"


def test_small_article_beside_the_text():
    page = f"<div><p>{BLOCK}</p><p>{BLOCK}</p></div><article><p>{LONG}</p></article>"
    assert html_text.main_text(page) == f"{BLOCK}\n{BLOCK}\n{LONG}"


def test_scripts_are_no_text_of_their_block():
    page = f'<head><style>p{{}}</style></head><p>{LONG}<script>var a;</script> Go<button><i>on</i></button></p><p>{LONG}</p>'
    assert html_text.main_text(page) == f"{LONG} Go\n{LONG}"


@pytest.mark.parametrize("open_,close", [
    ('<div class="site has-sidebar">', "</div>"), ('<div class="widget-page">', "</div>"), ("<form action=x>", "</form>"),
    ('<div id="search-form"><section role="search">', "</section></div>")])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_marks_do_not_empty_a_page(open_, close, tag):
    page = (f'<body>{open_}<div id="menu"><a>Home</a></div><{tag}><p>{LONG}</p><p>{LONG}</p></{tag}>'
            f'<div class="ad">{LONG}</div>{close}<footer>Foot</footer></body>')
    assert html_text.main_text(page) == f"{LONG}\n{LONG}"


def test_many_marks_end_soon():
    page = "".join(f'<div class="ad">{"x" * (1 + i % 40)}</div>' for i in range(20_000))
    assert html_text.main_text(page)


@pytest.mark.skipif(not os.path.exists(PAGES), reason="driver tables missing")
def test_pages_of_sf01():
    import html

    import pyarrow.parquet as pq

    for page in pq.read_table(PAGES)["html"].to_pylist()[:500]:
        inner = re.search(r"<article[^>]*>(.*?)</article>", page, re.S)[1]
        inner = re.sub(r"<(script|style|aside|form)\b.*?</\1>", "\n", re.sub(r"<!--.*?-->", "", inner, flags=re.S), flags=re.S)
        lines = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h\d|div|ul|ol|li|pre|blockquote|table|tr|td)\b[^>]*>", "\n", inner))
        want = [" ".join(html.unescape(x).split()) for x in lines.split("\n")]
        assert html_text.main_text(page) == "\n".join(x for x in want if x)


def test_pages_table(spark):
    rows = [(1, None, None, "a"), (None, "u", PAGE, "b"), (3, "v", "<p>" + "word " * 100_000, "c"), (3, "v", "", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, len(r.text)) for r in html_text.extract(pages).collect())
    assert got == [(0, len(html_text.main_text(PAGE))), (1, 0), (3, 0), (3, 499_999)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_smoothing_and_threshold():
    import numpy as np

    x = np.array([0.0, 0, 0, 5, 5, 5, 0, 0])
    s = html_text.smooth(x, 1.0)
    assert s[4] == s.max() and s[0] < 0.5 and 0 < html_text.threshold(s) < 5


_BASE = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")}


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.%@- +x", max_size=40))
def test_base_patterns_are_those_of_the_contract(text):
    want = [("email", *m.span()) for m in _BASE["email"].finditer(text)]
    want += [("ip", *m.span()) for m in _BASE["ip"].finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    assert [s for s in pii.plain_spans(text) if s[0] in _BASE] == sorted(want, key=pii._order)


@pytest.mark.parametrize("text", ["1" * 1_000_000, "a" * 1_000_000 + " b@c.de", "1." * 500_000, "a@" * 500_000, "+1 " * 300_000,
                                  "1 " * 500_000])
def test_long_runs_take_linear_time(text):
    began = time.process_time()
    pii.spans(text)
    assert time.process_time() - began < 10


def test_redact_keeps_clashing_columns(spark, docs_of):
    docs = docs_of(["mail a@b.co now", None], extra="x_masked")
    got = pii.redact(docs)
    assert got.columns == docs.columns
    assert [(r.text, r.n_chars, r.x_masked) for r in got.orderBy("doc_id").collect()] == [("mail <EMAIL> now", 16, "x"), (None, None, "x")]


@pytest.mark.parametrize("beside", ['<div class="comments"><p>{}</p></div>', "<form><p>{}</p></form>"])
def test_long_comments_and_forms_stay_out(beside):
    page = "<body><article><p>One line of an article.</p></article>" + beside.format("words of a reader " * 100) + "</body>"
    assert html_text.main_text(page) == "One line of an article."


@pytest.mark.parametrize("page", [
    "<div>" * 50_000 + "<p>word</p>" * 50_000, "<div class=sidebar>" * 50_000 + "<p>word" * 50_000,
    "<div>" * 50_000 + "</section>" * 50_000 + "text", "<p>word <b>bold</b></p>" * 100_000])
def test_deep_pages_take_linear_time(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 20
