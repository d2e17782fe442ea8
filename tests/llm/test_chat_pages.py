"""Chat perspectives and page texts against plain versions."""

from collections import Counter, defaultdict

import pytest

from tessera.llm import chat, pages
from tessera.llm.common import table


def plain_views(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "unknown", text or "", turn))
    out = Counter()
    for conv, turns in by_conv.items():
        for who in {t[2] for t in turns} - {"system"}:
            at = 0
            for position, (_, _, role, text, turn) in enumerate(sorted(turns, key=lambda t: t[:4])):
                own = role == who
                head = "<|im_start|>" + ("assistant" if own else "system" if role == "system" else f"user name={role}") + "\n"
                segment = head + text + "<|im_end|>\n"
                out[conv, who, position, turn, role, segment, at, at + len(segment), int(own),
                    at + len(head) if own else None, at + len(segment) if own else None] += 1
                at += len(segment)
    return out


def result(df):
    return Counter(tuple(r) for r in df.collect())


def test_perspectives(spark, sf_small):
    turns = table(spark, sf_small, "conversations")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert result(chat.perspectives(turns)) == plain_views(rows)


def test_perspectives_odd_rows(spark):
    rows = [(1, 0, "ann", "hi"), (1, 1, "bob", None), (1, 1, "bob", None), (1, 1, "ann", "same turn"), (1, None, None, "first"), (1, 700, "cy", "é" * 3),
            (1, -300, "bob", "early"), (2, 0, "system", "alone"), (None, 0, "ann", "x"), (None, 1, "system", "y"), (3, 0, "ann", "z" * 100000)]
    rows += [(4, k, f"p{k % 3}", f"t{k}") for k in range(1500)]
    frame = spark.createDataFrame([(*r, "a", 1) for r in rows], "conv_id long, turn long, role string, text string, segment string, start int")
    views = chat.perspectives(frame)
    assert result(views) == plain_views(rows)
    for r in chat.render(views.filter("conv_id = 1")).collect():
        assert r.dialogue.count("<|im_start|>assistant\n") == len(r.trained)
        for span in r.trained:
            assert r.dialogue[span.mask_start:span.mask_stop].endswith("<|im_end|>\n") and "<|im_start|>" not in r.dialogue[span.mask_start:span.mask_stop]
    assert chat.perspectives(frame.limit(0)).count() == 0


def test_only_dataframe_operations(spark, sf_small):
    plan = chat.perspectives(table(spark, sf_small, "conversations"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("no markup  at\nall", "no markup at all"),
    ("<article><h1>T &amp; t</h1><p>a<b>b</b> c<br>d<p>e&nbsp;f</article><p>out", "T & t ab c d e f"),
    ("<body><nav>menu</nav><main><p>x</p><aside>s</aside><form>f</form><div class='post-comments'><p>c</p></div><p>y</p></main><footer>z</footer>", "x y"),
    ("<header>h</header><article><header><h1>t</h1></header>x<footer>f</footer><script>var a='</p>';</script><style>p{}</style></article>", "t x"),
    ("<div class=ad>buy<article><p>real</article>", "real"),
    ("<article><p>one<!-- no <p>two --><section class='related'>r</section><div hidden>h</div><p style='display:none'>n</p>three", "one three"),
    ("<article>a<p title='1 > 0'>b</p>&lt;i&gt; &am &#233;</article><article class=comment>no</article>", "a b <i> &am é"),
    ("<div><p>plain page</p><ul><li>one<li>two</ul></div><div id='sidebar'>s</div>", "plain page one two"),
    ("<article>cut <p>off <b", "cut off"), ("<ARTICLE><P>Up</P></ARTICLE>", "Up"), ("<article></article><p>rest", "rest"),
])
def test_page_texts(spark, html, want):
    found = pages.blocks(html or "")
    main = [t for r, t in found if r == pages.MAIN]
    other = [t for r, t in found if r == pages.OTHER]
    assert " ".join(main or other) == want


def test_a_host_repeats_itself(spark):
    notice = "we use many small files to remember who you are on this site"
    rows = [(k, f"http://h.example/{k}", f"<body><p>{notice}</p><p>story {k} told once in words of its own {k * 7} and more {k * 11}</p></body>") for k in range(4)]
    rows += [(9, "http://other.example/", f"<p>{notice}</p>"), (10, None, "<p>x y</p>"), (11, "http://h.example/a", None), (12, "", ""),
             (13, "http://h.example/b", "<article><p>" + "long " * 40000 + "</article>"), (9, "http://other.example/", f"<p>{notice}</p>")]
    frame = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    got = sorted(((r.page_id, r.text) for r in pages.main_texts(frame).collect()), key=str)
    want = [(k, f"story {k} told once in words of its own {k * 7} and more {k * 11}") for k in range(4)]
    want += [(9, notice), (9, notice), (10, "x y"), (11, ""), (12, ""), (13, ("long " * 40000).strip())]
    assert got == sorted(want, key=str)
    assert pages.main_texts(frame.limit(0)).count() == 0


def test_copies_of_a_page_are_not_boilerplate(spark):
    notice = "we use many small files to remember who you are on this site"
    story = "a story of some length that the host serves under more than one address and page"
    def page(k, text):
        return f"<nav>you are here on page {k}</nav><p>{notice}</p><p>{text}</p>"
    rows = [(1, "http://h.example/1", page(1, story)), (2, "http://h.example/2?ref=x", page(1, story)), (3, "http://h.example/2", page(3, story)),
            (4, "http://h.example/4", page(4, "another text told once on this host in words of its own")), (1, "http://h.example/1", page(1, story))]
    got = pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    # the notice is also on page 4 and goes; the story is only on copies and stays on each
    assert sorted((r.page_id, r.text) for r in got) == [(1, story), (1, story), (2, story), (3, story), (4, "another text told once on this host in words of its own")]


def test_the_article_is_the_text_whoever_else_has_it(spark):
    line = "a paragraph of more than eight words that two articles of the host share"
    rows = [(k, f"http://h.example/{k}", f"<article><p>{line}</p><p>own words {k}</p></article>") for k in range(2)]
    got = pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(k, f"{line} own words {k}") for k in range(2)]


def test_run_keys_find_equal_runs():
    import numpy as np
    words = np.array([1, 2, 3, 1, 2, 3, 4], np.uint64)
    key, place, text = pages.run_keys(words, np.array([0, 3, 7]), 3)
    assert place.tolist() == [0, 3, 4] and text.tolist() == [0, 1, 1]
    assert key[0] == key[1] != key[2]


def test_given_pages(spark, sf_small):
    import html
    import re
    frame = table(spark, sf_small, "pages")
    got = {r.page_id: r.text for r in pages.main_texts(frame).collect()}
    for r in frame.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article))
        assert got[r.page_id] == " ".join(html.unescape(plain).split())
