import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.llm import chat, html_extract, license_scan

DOCS = "doc_id long, text string"


def energy(score, edges, labels):
    e = sum(s for s, x in zip(score, labels) if s > 0 and not x) + sum(-s for s, x in zip(score, labels) if s < 0 and x)
    return e + sum(c for u, v, c in edges if labels[u] != labels[v])


def test_minimum_cut_is_the_cheapest_labelling():
    rng = np.random.default_rng(3)
    for _ in range(150):
        n = int(rng.integers(1, 9))
        score = rng.normal(size=n) * 2
        edges = [(u, v, float(rng.random() * 2)) for u, v in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        got = energy(score, edges, html_extract.minimum_cut(score, edges))
        assert got == pytest.approx(min(energy(score, edges, x) for x in itertools.product([False, True], repeat=n)))


def test_smoothing_takes_in_a_weak_block_between_strong_ones():
    score, edges = np.array([3.0, -0.5, 3.0]), [(0, 1, 0.8), (1, 2, 0.8)]
    assert html_extract.minimum_cut(score, edges) == [True, True, True]


PROSE = ["This is the first paragraph, and it says a few things of note.", "Another paragraph follows; it has a link in the text.",
         "Short one.", "The last paragraph ends the article & the story."]
ESCAPED = [p.replace("&", "&amp;").replace("a link", '<a href="/x?a>b">a link</a>') for p in PROSE]
BODY = "".join(f"<p>{p}</p>" for p in ESCAPED)
LAYOUTS = {
    "article": f"<body><nav><a href=/>Home</a> <a href=/b>About us</a></nav><header><h2>Site</h2></header><article>{BODY}</article>"
               "<footer>&copy; 2020 Site &middot; All rights</footer></body>",
    "sidebar": f"<body class='has-sidebar'><div class='page with-sidebar'><main>{BODY}</main><aside><p>Read this other piece, it is good.</p></aside></div></body>",
    "comments": f"<article class='post'>{BODY}<section class='comments'><article class=comment><p>I liked the article, it was a good read.</p></article></section></article>",
    "forms": f"<div id=content>{BODY}<form><label>Your mail</label><input><button>Send it now</button><select><option>One</option></select></form></div>",
    "notice": f"<div class='cookie-notice'>We use cookies to make this site better for you.</div><div class=article-body>{BODY}</div><div class='adBox ad'>Buy this thing now, it is good and cheap.</div>",
    "scripts": f"<head><title>T</title><style>p>a{{x:y}}</style></head><body><script>if (a<b) {{ '</p>' }}</script><!-- <p>gone</p> --><main>{BODY}<noscript>no</noscript></main>",
    "unclosed": "<article><p>" + "<p>".join(ESCAPED) + "</article><footer><p>foot note of the site",
    "plain": f"<body><ul><li><a href=/>Home</a><li><a href=/a>News</a><li><a href=/b>Mail</a></ul><div>{BODY}</div><div><a href=/>Back</a> | <a href=/x>Top</a></div></body>",
    "hidden": f"<main>{BODY}<div style='display: none'><p>This text is not shown to any reader.</p></div><p hidden>nor this.</p></main>",
    "article header": "<div id='header'><h2>Site</h2></div><article><header><div class='post-header'><h2>" + PROSE[0] + "</h2></div></header>"
                      + "".join(f"<p data-id='sidebar'>{p}</p>" for p in ESCAPED[1:]) + "<footer>Filed under news.</footer></article>",
    "ads inside": f"<article>{BODY.replace('<p>Short', '<div class=advert><p>Our partner has an offer for you.</p></div><p>Short')}</article>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    assert html_extract.extract(LAYOUTS[name]).split("\n") == PROSE


NAMED = f"<article><h1>Title of it</h1>{BODY}</article>"
WRAPPED = {
    "form": f"<body><form action=x><nav><a href=/>Home</a></nav>{NAMED}<footer>&copy; 2020 Site</footer></form></body>",
    "state of comments": f"<body><div class='page comments-open'><div id=nav-main><a href=/>Home</a></div>{NAMED}</div></body>",
    "state of notices": f"<body><div class='site has-cookie-notice no-sidebar'>{NAMED}<div class='cookie-notice'>We use cookies on this site, as you know.</div></div></body>",
    "state of the article": NAMED.replace("<article>", "<article class='post related-none'>"),
    "teasers aside": f"{NAMED}<aside><article><h2>Another piece</h2><p>This is a piece that you may like, too.</p></article></aside>",
    "dialog around all": f"<div role=dialog class=modal>{NAMED}</div>",
}


@pytest.mark.parametrize("name", WRAPPED)
def test_what_holds_the_content_is_no_boilerplate(name):
    assert html_extract.extract(WRAPPED[name]).split("\n") == ["Title of it", *PROSE]


@pytest.mark.parametrize("wrap", ["<form>{}</form>", "<div class='modal'>{}</div>", "<div id=sidebar-page>{}</div>", "<div>{}</div>"])
def test_a_wrapper_of_a_page_without_marks(wrap):
    links = "<ul><li><a href=/>Home</a><li><a href=/a>News of the day</a><li><a href=/b>Mail</a></ul>"
    page = "<body>" + wrap.format(links + "<div>" + BODY + "</div><div><a href=/>Back</a> | <a href=/x>Top</a></div>") + "</body>"
    assert html_extract.extract(page).split("\n") == PROSE


def test_the_cut_mends_what_the_costs_alone_get_wrong():
    """Pages without marks: a short line among paragraphs is content, a sentence among links is not."""
    long = "The river rose for three days, and nobody in the village had seen it so high; the bridge was closed to all."
    page = f"<div><p>{long}</p><p>By Ann, 4 | 5</p><p>{long}</p><p>{long}</p></div>" \
           "<ul><li><a href=/1>One</a><li><a href=/2>Two</a><li>See all of our news, and that of last week.<li><a href=/3>Three</a><li><a href=/4>Four</a></ul>"
    blocks = html_extract.blocks_of(page)
    score, edges = html_extract.graph(blocks, html_extract.PRIOR)
    alone, cut = [bool(s > 0) for s in score], html_extract.minimum_cut(score, edges)
    want = [True] * 4 + [False] * 5
    assert cut == want and alone != want and sum(a != w for a, w in zip(alone, want)) >= 2


def test_white_space_and_references():
    page = "<article><h1>A&nbsp;&lt;b&gt;\n\n title</h1><p> one<br>two<b>three</b>\t four &amp;amp; &eacute;&#x41;</p><p> </p></article>"
    assert html_extract.extract(page) == "A <b> title\none twothree four &amp; éA"


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><meta charset=utf-8><style>p{{x:y}}</style><body><article>{BODY}</article>",
    f"<head><title>T</title><script>a</script><article>{BODY}</article>",
    f"<HEAD>\n<title>T</title>\n</HEAD><body><article>{BODY}</article></body>",
    f"<article><svg class='i' d=\"a>b\" />{BODY}</article>",
    f"<article><svg/><math/>{BODY}<p><svg width='1'><title>no</title><path d='M0'/></svg></p></article>"])
def test_open_head_and_empty_icons(page):
    assert html_extract.extract(page).split("\n") == PROSE


def test_whole_blocks_and_pages_count(spark):
    digits, = html_extract.blocks_of("<p>" + "a" * 300 + "1" * 100 + "</p>")
    assert html_extract.shape(digits)[6] == 0.25
    page = "<article>" + "<p>Some words of the article, and more of them.</p>" * 600 + "</article><footer><p>12 34 | 56</p></footer>"
    pages = spark.createDataFrame([(page,)], "html string")
    assert (html_extract.learned_weights(pages) == html_extract.learn([page])).all()
    assert (html_extract.learn([page]) != html_extract.PRIOR).any()


def test_page_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<html></html>"), (4, "u", "<<>>< a <b"), (5, "u", LAYOUTS["article"]),
            (5, "u", LAYOUTS["article"]), (6, "u", "<article><p>" + "long text. " * 60_000), (None, "u", "</p></div></article>x</b>"),
            (7, "u", "<p>" * 3000 + "deep"), (8, "u", "<article>" + "".join(f"<p>Line {i}, it is.</p>" for i in range(3000)) + "</article>"),
            (9, "u", "<a b='" * 2000), (10, "u", "<!-- open"), (11, "u", "<script>open")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(0))
    got = {r.page_id: r for r in html_extract.extract_pages(pages).collect()}
    assert [got[i].text for i in (1, 2, 3, 10, 11)] == [""] * 5
    assert got[5].text.split("\n") == PROSE and got[2].url is None
    assert len(got[6].text) == 60_000 * 11 - 1 and got[8].text.count("\n") == 2999
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def plain_scan(docs, templates=license_scan.TEMPLATES):
    grams = lambda ws: [" ".join(ws[i:i + 5]) for i in range(len(ws) - 4)]
    split = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    best = {}
    for i, t in docs:
        gs = grams(split(t))
        for name, text in templates:
            want = grams(split(text))
            n = len(want)
            if not n:
                continue
            step, width = license_scan.step_of(n), license_scan.window_of(n)
            for a in range(0, len(gs), step):
                share = round(len(set(want) & set(gs[a:a + width])) / len(set(want)), 6)
                if share >= 0.8:
                    best[i, name] = max(best.get((i, name), 0), share)
    return best


def license_docs():
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(50)] + ["license", "the", "under", "licensed"]
    say = lambda k: " ".join(rng.choices(vocab, k=k))
    docs = []
    for i in range(120):
        text = rng.choice(license_scan.TEMPLATES)[1]
        ws = text.split()
        kind = i % 4
        if kind == 1 and len(ws) > 15:
            ws.insert(rng.randrange(len(ws)), "EXTRA")
        elif kind == 2:
            ws = ws[:max(1, int(len(ws) * rng.random()))]
        elif kind == 3 and len(ws) > 15:
            ws[rng.randrange(len(ws))] = "other"
        docs.append((i, say(rng.randrange(30)) + rng.choice([" ", "\n", ". "]) + " ".join(ws).upper() + " " + say(rng.randrange(30))))
    return docs + [(200, None), (201, ""), (202, "Released under the MIT"), (203, "Released under the MIT License."), (203, "Licensed under CC BY-NC 4.0."),
                   (None, "Released under the MIT License."), (204, "w " * 30_000 + license_scan.TEMPLATES[1][1] + " w" * 30_000), (205, docs[0][1])]


def test_license_scan_is_the_exact_containment(spark):
    docs = license_docs()
    d = spark.createDataFrame(docs, DOCS).withColumn("license_id", F.lit(1)).withColumn("ws", F.lit("clash")).withColumn("n", F.lit("c"))
    got = {(r.doc_id, r.license_id): r.containment for r in license_scan.scan(d).collect()}
    assert got == plain_scan(docs) and len(got) > 60


def test_bands_alone_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(license_scan, "LITERAL_SHINGLES", 0)
    monkeypatch.setattr(license_scan, "BROADCAST_ROWS", 0)
    docs = [d for d in license_docs() if d[0] != 204][::3]
    got = {(r.doc_id, r.license_id): r.containment for r in license_scan.scan(spark.createDataFrame(docs, DOCS)).collect()}
    assert got == plain_scan(docs)


def test_band_settings():
    for n in range(1, 400):
        s = license_scan.similarity(n)
        assert 1 - (1 - s) ** license_scan.bands_of(n) >= license_scan.COLLISION or s == 1


def test_license_empty_tables(spark):
    d = spark.createDataFrame(license_docs(), DOCS)
    given = spark.createDataFrame([("X", "only four words here"), ("Y", None)], "license_id string, text string")
    assert license_scan.scan(d.limit(0)).count() == 0
    assert license_scan.scan(d, given).count() == 0


CHAT = "conv_id long, turn long, role string, text string"


def thread(spark, rows):
    m = spark.createDataFrame(rows, CHAT).withColumn("depth", F.lit("clash")).withColumn("conv", F.lit(1))
    return sorted(chat.format_chats(m).collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.place))


def test_quotes_are_linked_and_removed(spark):
    rows = [(1, 0, "user", "How do I bake bread?\nAnd how long?"),
            (1, 1, "assistant", "Bob wrote:\n> How do I bake  BREAD?\n\nWith flour."),
            (1, 2, "user", "By the way, a new matter."),
            (1, 3, "user", "> With flour.\n>> How do I bake bread?\nWhich flour?"),
            (1, 4, "assistant", ">> With flour.\n> Which flour?\nRye."),
            (1, 5, "user", "> not said by anyone\nHm."),
            (2, 0, "user", "> Which flour?\nOther conversation.")]
    got = thread(spark, rows)
    one = [r for r in got if r.conv_id == 1]
    assert [(r.turn, r.reply_to, r.thread, r.depth) for r in one] == [
        (0, None, 0, 0), (1, 0, 0, 1), (3, 1, 0, 2), (4, 3, 0, 3), (2, None, 2, 0), (5, None, 5, 0)]
    assert [r.formatted for r in one][1] == "<|assistant|>\nWith flour.\n<|end|>"
    assert [r.formatted for r in one][3] == "<|assistant|>\nRye.\n<|end|>"
    assert [r.reply_to for r in got if r.conv_id == 2] == [None]


def test_most_lines_then_latest_original(spark):
    rows = [(1, 0, "u", "a\nb"), (1, 1, "u", "c"), (1, 2, "u", "d"), (1, 3, "u", "> a\n> b\n> c\nx"), (1, 4, "u", "> c\n> d\ny"), (1, 5, "u", "> y\n> z"), (1, 6, "u", "z")]
    parents = {r.turn: (r.reply_to, r.n_quoted) for r in thread(spark, rows)}
    assert parents[3] == (0, 3) and parents[4] == (2, 2) and parents[5] == (4, 1) and parents[6] == (None, 0)


def test_long_chain_and_cases(spark):
    rows = [(1, i, "u", (f"> line {i - 1}\n" if i else "") + f"line {i}") for i in range(40)]
    got = thread(spark, rows)
    assert [(r.turn, r.thread, r.depth) for r in got] == [(i, 0, i) for i in range(40)]
    odd = [(None, 0, "u", "x"), (None, 1, "u", "> x\ny"), (3, None, "u", "q"), (3, 0, "u", "> q\nr"), (4, 0, None, None), (5, 0, "u", "s"), (5, 0, "u", "s"),
           (5, 1, "u", "> s\nt"), (6, 0, "u", "> self\nself"), (7, 0, "u", "z " * 100_000)]
    got = {(r.conv_id, r.turn): r for r in thread(spark, odd)}
    assert got[None, 1].reply_to == 0 and got[3, 0].reply_to is None and got[5, 1].reply_to == 0 and got[6, 0].reply_to is None
    assert got[4, 0].formatted == "<||>\n\n<|end|>" and got[3, None].place < got[3, 0].place
    assert len(thread(spark, odd)) == len(odd)
    assert chat.format_chats(spark.createDataFrame([], CHAT)).count() == 0


def test_rewrapped_and_deeper_quotes(spark):
    long = "The dough has to rest for an hour, then it is folded twice and left in a cold place until the next morning."
    wrapped = "> The dough has to rest for an hour, then\n> it is folded twice and left in a cold\n> place until the next morning."
    rows = [(1, 0, "u", "How do I bake bread?"), (1, 1, "u", "> How do I bake bread?\n" + long), (1, 2, "u", "Another matter is the price of it all."),
            (1, 3, "u", wrapped + "\nThanks."), (1, 4, "u", ">> How do I bake bread?\nAsked before."),
            (1, 5, "u", wrapped.replace(">", ">>") + "\nSo I did."), (1, 6, "u", ">> The price of it all\n>> is what nobody said here.\nNo."),
            (2, 0, "u", "one short\nline"), (2, 1, "u", ">> one\n>> short line\nyes"), (2, 2, "u", ">>> one short\nno"),
            (3, 0, "u", long.replace("folded", "folded\n").replace("place", "\nplace")), (3, 1, "u", "> " + long + "\nok"),
            (4, 0, "u", wrapped)]
    got = {(r.conv_id, r.turn): r for r in thread(spark, rows)}
    assert {k: r.reply_to for k, r in got.items()} == {
        (1, 0): None, (1, 1): 0, (1, 2): None, (1, 3): 1, (1, 4): 1, (1, 5): 3, (1, 6): None,
        (2, 0): None, (2, 1): 0, (2, 2): 0, (3, 0): None, (3, 1): 0, (4, 0): None}
    assert got[1, 3].n_quoted == 3 and got[1, 5].thread == 0 and got[1, 5].depth == 3
