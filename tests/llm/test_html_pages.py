"""Main-text extraction on pages written by hand, under any names, and on the given pages."""

import html as references
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from tallystone.llm import htmltext

WORDS = "the sea was calm and we sailed along coast until evening when lights of harbour came into view beyond hills".split()
USUAL = (
    "post page primary postText main-col blog-entry body-copy richtext markdown-body mw-parser-output td-post-content field-item news-text entry article-content story text content main "
    "container wrapper section prose detail column page-body site-main single-page"
).split()


@pytest.fixture(scope="module")
def model(spark):
    return htmltext.kept_model(spark)


def paragraph(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(20, 60))).capitalize() + "."


def test_articles_under_any_name(model):
    rng = random.Random(31)
    names = USUAL + ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(100)]
    lost = []
    for name in names:
        parts = [paragraph(rng) for _ in range(8)]
        menu = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in WORDS[:6])
        page = f'<html><body><nav><ul>{menu}</ul></nav><div class="{name}"><h1>A day at sea</h1>{"".join(f"<p>{p}</p>" for p in parts)}</div><footer>© 2024 Example. All rights reserved.</footer></body></html>'
        found = htmltext.main_texts([page], model)[0]
        if not all(p in found for p in parts) or "rights reserved" in found:
            lost.append(name)
    assert len(lost) <= 1, lost  # of 128


def test_pages_of_little_else(model):
    pages = {
        '<div class="a1">One thing.</div><div class="b2">Another thing.</div><div class="c3">A third.</div>': "One thing. Another thing. A third.",
        "<p>Just one sentence here.</p>": "Just one sentence here.",
        "A plain line of text": "A plain line of text",
        "<xmp>Shown as it is, in a page of little else.</xmp>": "Shown as it is, in a page of little else.",
    }
    assert dict(zip(pages, htmltext.main_texts(list(pages), model), strict=True)) == pages


#: Pages written by hand. ``+`` before a text: main text; ``-``: not.
PAGES = [
    """<body><div id="masthead">-The Daily Example</div><ul class="menu"><li><a href="/a">-Home</a></li><li><a href="/b">-World</a></li></ul>
    <article><h1>+Bridge reopens after repairs</h1><p>+The old bridge over the river reopened on Monday, eleven months after a barge struck its second pier.</p>
    <aside class="related"><h4>-Read more</h4><p>-Five other bridges that closed this year</p></aside><p>+Engineers replaced forty metres of masonry and all of the bearings.</p>
    <blockquote><p>+We are glad that it is over, said the mayor.</p></blockquote></article><div class="footer">-© 2023 The Daily Example. All rights reserved.</div></body>""",
    """<body><div class="cookie-notice">-We use cookies to improve your visit. <button>-Accept</button></div><nav><a href="/">-Start</a> <a href="/blog">-Blog</a></nav>
    <div class="qzvm"><h1>+How I bake bread</h1><p>+Flour, water and salt are all you need, and time.</p><ul><li>+500 g flour</li><li>+350 g water</li><li>+10 g salt</li></ul>
    <p>+Mix them in the evening and leave the bowl covered until the morning.</p><p>+Bake hot, for about forty minutes.</p></div>
    <section id="comments"><h3>-2 comments</h3><div class="comment"><b>-Ann</b><p>-Worked for me, thank you!</p></div><div class="comment"><b>-Bo</b><p>-Mine was flat.</p></div></section></body>""",
    """<html><body><header class="page-header"><div>-Example University</div><nav><ul><li><a href="/x">-Study</a></li><li><a href="/y">-Research</a></li></ul></nav></header>
    <main><h1>+Opening hours of the library</h1><table><tr><td>+Monday to Friday</td><td>+8 to 22</td></tr><tr><td>+Saturday</td><td>+10 to 18</td></tr></table>
    <p>+The reading rooms close half an hour earlier. On public holidays the library stays closed.</p></main>
    <footer><p>-© Example University</p><p>-Imprint and privacy</p></footer></body></html>""",
    """<div class="topbar">-Call us today</div><form class="search"><label>-Search</label><input><button>-Go</button></form>
    <div id="kx4"><div class="wub"><h2>+Why cats purr</h2><p>+Cats purr when they are content, but also when they are hurt. The sound comes from the larynx, whose muscles twitch some twenty-five times a second.</p>
    <p>+Some think that it helps bones to heal.</p><div class="ad">-Buy cat food now, half price!</div><p>+Big cats roar instead, as their hyoid bone is not rigid.</p></div></div>
    <div class="sidebar"><h3>-Popular</h3><ul><li><a href="/1">-Why dogs bark</a></li><li><a href="/2">-Why cows moo</a></li></ul></div><div class="legal">-All texts under licence.</div>""",
    """<body><nav><ul><li><a href=/>-Accueil</a></li><li><a href=/c>-Contact</a></li></ul></nav><section class="zfrt"><h1>+Le marché du dimanche</h1>
    <p>+Chaque dimanche matin, une trentaine de marchands s'installent sur la place de la mairie.</p><p>+On y trouve du fromage, du miel et des légumes de saison.</p>
    <figure><img src=x><figcaption>+La place, vue du clocher</figcaption></figure></section><div class="newsletter">-Recevez notre lettre chaque semaine !</div><footer>-© 2022 La Commune</footer></body>""",
    """<body><div class="breadcrumbs"><a href="/">-Home</a> <a href="/docs">-Docs</a></div><div class="markdown-body"><h1>+Installing the tool</h1><p>+Download the archive and unpack it.</p>
    <pre>+tar xf tool.tar.gz</pre><p>+Then add its folder to your path. You are done.</p><h2>+Problems</h2><p>+If the tool does not start, look into its log.</p></div>
    <nav class="pagination"><a href="/p">-Previous</a> <a href="/n">-Next</a></nav></body>""",
    """<body><header>-My travel notes</header><div class="entry-content"><p>+We left the harbour at dawn, and by noon the coast was out of sight.</p>
    <div class="share"><ul><li><a href="#">-Share</a></li><li><a href="#">-Tweet</a></li></ul></div><p>+In the evening the wind rose, so that we had to take in the sails.</p>
    <div class="comments"><p>-I was on that boat too, what a night!</p></div><p>+The next morning was calm again.</p></div><footer>-Contact | Imprint</footer></body>""",
    """<body><div id="navigation"><a href="/1">-One</a> | <a href="/2">-Two</a> | <a href="/3">-Three</a></div><td class="hq"><h1>+Council approves budget</h1><p>+The council approved next year's budget by nineteen votes to twelve.</p>
    <p>+Schools get four per cent more, roads three per cent less.</p><p>+The opposition called the plan &ldquo;timid&rdquo; and asked for a new vote in spring.</p></td>
    <div class="sponsored">-Sponsored: ten ways to save on your heating bill</div><div class="copyright">-© Local Paper</div></body>""",
    """<p>+A page of three paragraphs and nothing else, as people wrote them in the beginning.</p><p>+It has no menu.</p><p>+It has no footer either.</p>""",
    """<body><div class="login"><form><label>-Name</label><input><label>-Password</label><input><button>-Log in</button></form></div><main class="lkj"><h1>+Minutes of the meeting</h1><ol><li>+The minutes of the last meeting were approved.</li>
    <li>+The treasurer reported a small surplus.</li><li>+The next meeting will be in June.</li></ol></main><div class="site-footer"><ul><li><a href="/i">-Imprint</a></li></ul></div></body>""",
]


def test_pages_written_by_hand(model):
    """Of all their texts at least 0.95 are kept or left out rightly, on both sides, and no article is lost."""
    kept = missed = wrong = 0
    for page in PAGES:
        texts = re.findall(r">\s*([+-])([^<]+)|^([+-])([^<]+)", page)
        clean = re.sub(r"(>\s*)[+-](?=[^<])", r"\1", page)
        found = htmltext.main_texts([clean], model)[0]
        assert found
        for mark, said, *_ in texts:
            said = " ".join(references.unescape(said).split())
            there = re.search(rf"(?<!\w){re.escape(said)}(?!\w)", found) is not None
            kept += mark == "+" and there
            missed += mark == "+" and not there
            wrong += mark == "-" and there
    assert kept > 40 and kept / (kept + missed) >= 0.95 and kept / (kept + wrong) >= 0.95, (kept, missed, wrong)


def test_generated_pages_that_training_did_not_see(model):
    maker = random.Random(12345)
    good = extra = lost = 0
    for _ in range(300):
        blocks = htmltext.leaf_blocks(htmltext.training_page(maker))
        if not blocks:
            continue
        wanted = np.array([htmltext._MARK in b[0] for b in blocks])
        x, first = htmltext.features([[(b[0].replace(htmltext._MARK, "").strip(), b[1], b[2]) for b in blocks]])
        own = model.margins(x, first) > 0
        good, extra, lost = good + (own & wanted).sum(), extra + (own & ~wanted).sum(), lost + (~own & wanted).sum()
    assert good / (good + extra) >= 0.97 and good / (good + lost) >= 0.97


def test_given_pages(model):
    """Articles whole, adverts, menus and footers out."""
    pages = [p.as_py() for p in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"]]
    wrong = total = 0
    for page, found in zip(pages, htmltext.main_texts(pages, model), strict=True):
        for text, element, _ in htmltext.leaf_blocks(page):
            tags, names = [], set()
            while element is not None:
                tags.append(element.name)
                names |= set(element.names)
                element = element.parent
            if "article" in tags and "ad" not in names and "aside" not in tags:
                total += 1
                wrong += text not in found
    assert total > 1000 and wrong <= total / 1000
