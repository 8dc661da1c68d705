import random

from helpers import BIG

from signalloom.llm import html_text
from signalloom.llm.html_text import extract, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/a>Home, sweet</a></ul></nav><div id="cookie-notice"><p>We use cookies, many of them, on this page.</p></div>
<div class="wrap"><div class="content"><h1>The  title</h1><p><b>First, para &amp; more,
 text &#8217;s &hellip;<br>next<p>Second <a href=x>link</a> text, and more.<ul><li>one<li>two</ul><blockquote>Quote</blockquote>
<div class="ad">Buy, buy, buy</div><table><tr><td>c1<td>c2</table></div><div class="sidebar"><p>Side, side, side, side, side, side.</p></div></div>
<section id="comments"><p>Nice, post, really, good, one.</p></section><form><p>Your, name, here, please, now</p></form><footer><p>&copy; foot, er</p></footer></body></html>"""
TEXT = "The title\n\nFirst, para & more, text ’s … next\n\nSecond link text, and more.\n\none\n\ntwo\n\nQuote\n\nc1\n\nc2"


def test_main_text():
    assert main_text(PAGE) == TEXT


def test_article_holds_its_header_and_loses_comments():
    page = "<body><aside>x, y</aside><article><header><h1>H</h1></header><p>One, two.</p><section><p>Three.</p></section><div class='comments'><p>No, no, no, no</p></div><footer>f</footer></article></body>"
    assert main_text(page) == "H\n\nOne, two.\n\nThree."


NAMED = """<h2 id="related-work">Related work</h2><section id="discussion"><h3>Discussion</h3><p>We found, as others did, that the rate rises.</p></section>
<p class="notice">Please note this.</p><div id="social-policy"><p>Housing costs rose in all of the regions we looked at.</p></div><h2 id="cookie-law">Cookie law</h2>
<div class="share"><a href=x>Share this</a> <a href=y>Post</a></div><div class="related"><h4>More</h4><ul><li><a href=z>Another, longer, story of the day</a></ul></div>
<ul class="tags"><li>housing<li>rent</ul><p class="related"><a href=q>Read also, on this page: another story</a></p><div class="ad"><p>Buy, buy, buy, buy, buy, buy</p></div>
<div class="comments"><p>No, no, no, no</p></div><div class="sidebar"><p>Side, side, side, side</p></div>"""


def test_everyday_names_inside_an_article():
    want = "H\n\nOne, two, and three.\n\nRelated work\n\nDiscussion\n\nWe found, as others did, that the rate rises.\n\nPlease note this.\n\nHousing costs rose in all of the regions we looked at.\n\nCookie law"
    assert main_text(f"<body><div class=related><p>Far, far, far, far</p></div><article><h1>H</h1><p>One, two, and three.</p>{NAMED}</article></body>") == want
    assert main_text(f"<body><div class=content><h1>H</h1><p>One, two, and three.</p>{NAMED}</div></body>") == want


def test_deep_nesting_of_everyday_names():
    assert main_text("<div class=share>" * 2_000 + "deep, text, and more of it" + "</div>" * 2_000) == "deep, text, and more of it"


def test_siblings_and_lists_of_links():
    page = "<body><h1>Head</h1><div class=a><p>" + "Long text, with commas, and words. " * 5 + "</p></div><div class=b><p>" + "More text, with commas, and words. " * 5 + "</p><ul><li><a>x y z</a><li><a>u v w</a></ul></div><div class=menu><a>m</a></div></body>"
    out = main_text(page).split("\n\n")
    assert out[0] == "Head" and out[2].startswith("More") and out[3:] == ["x y z", "u v w"]


def test_nothing_of_an_article_is_dropped():
    body = "<p>" + "Long text, with commas, and words. " * 5 + "</p>"
    text = ("Long text, with commas, and words. " * 5).strip()
    sources = "<h3>Sources</h3><ul><li><a href=a>First report</a></li><li><a href=b>Second report</a></li></ul>"
    assert main_text(f"<article>{body}{sources}</article>") == f"{text}\n\nSources\n\nFirst report\n\nSecond report"
    named = '<p class="sponsors">The sponsors of the bill, three of them, spoke.</p><section id="newsletter-history"><p>It began, as most do, with one letter.</p></section>'
    assert main_text(f"<article>{body}{named}</article>") == f"{text}\n\nThe sponsors of the bill, three of them, spoke.\n\nIt began, as most do, with one letter."
    beside = f"<h1>T</h1><p>Short lead.</p><div>{body}</div><h3>Facts</h3><ul><li>one</li></ul><table><tr><td>two</td></tr></table>bare text<p>The end.</p>"
    assert main_text(f"<body><nav>m</nav><div class=wrap>{beside}</div></body>") == f"T\n\nShort lead.\n\n{text}\n\nFacts\n\none\n\ntwo\n\nbare text\n\nThe end."
    assert main_text(f"<main><article>{body}</article><article><p>Another one, of its own, with words.</p>{body}</article><aside>x</aside></main>") == f"{text}\n\nAnother one, of its own, with words.\n\n{text}"
    assert main_text(f'<article>{body}<div class="newsletter"><p>Get news, offers, and more.</p><form><input></form></div></article>') == text


def test_of_equal_containers_the_first_is_best():
    same = "<section><p>Some words, of one kind, and of another.</p></section>"
    assert main_text(f"<body><div>{same}</div><div>{same}</div></body>").startswith("Some words")
    one, two = (f"<td><p>{w} words, of one kind, and of another.</p></td>" for w in ("First", "Other"))
    assert main_text(f"<body><table><tr>{one}</tr></table><hr><ol><li>{two}</ol></body>").startswith("First")


def plain_text(root):
    """The definition, node by node, by recursion over the pruned tree."""
    def chars(n, link=None):
        if isinstance(n, str):
            return len(" ".join(n.split())) if link in (None, True) else 0
        inside = link if link is None else link or n.tag == "a"
        return sum(chars(c, inside) for c in n.children)

    def commas(n):
        return n.count(",") if isinstance(n, str) else sum(map(commas, n.children))

    def in_link(n):
        return n is not None and (n.tag == "a" or in_link(n.parent))

    def density(n):
        return chars(n, in_link(n)) / chars(n) if chars(n) else 0.0

    def walk(n):
        yield n
        for c in n.children:
            if not isinstance(c, str):
                yield from walk(c)

    def block_inside(n):
        return any(not isinstance(c, str) and c.tag in html_text.BLOCKS for c in n.children)

    def earned(n):
        if not chars(n) or n.tag in html_text.HEADINGS or n.tag not in html_text.BLOCKS or n.parent is None:
            return 0.0
        if block_inside(n) and not any(isinstance(c, str) and c.strip() for c in n.children):
            return 0.0
        return (0.25 + commas(n) + min(chars(n) / 100, 3)) * (1 - density(n)) * n.weight

    points = {n: 0.0 for n in walk(root)}
    for n in walk(root):
        up = n if block_inside(n) else n.parent
        for step in (1, 2, 3, 4):
            if up is not None and earned(n):
                points[up] += earned(n) / {1: 1, 2: 2, 3: 9, 4: 12}[step]
                up = up.parent
    worth = lambda n: points[n] * (1 - density(n))
    best, most = None, 0.0
    for n in walk(root):
        if points[n] > 0 and (best is None or worth(n) * {"article": 1.5, "main": 1.3, "section": 1.1}.get(n.tag, 1) > most):
            best, most = n, worth(n) * {"article": 1.5, "main": 1.3, "section": 1.1}.get(n.tag, 1)
    if best is None:
        best = root
    up = best
    while up is not None and best.tag != "article":
        best, up = (up if up.tag in ("article", "main") else best), up.parent

    def kept(c):
        if isinstance(c, str):
            return best.tag not in ("article", "main")
        if not chars(c):
            return False
        if "article" in (c.tag, best.tag) or best.tag == "main":
            return c.tag == best.tag and worth(c) >= 0.2 * most or c.tag in ("h1", "h2") and density(c) < 0.5
        if c.tag in ("div", "section"):
            return c.tag == best.tag and worth(c) >= max(2.0, 0.2 * most)
        return c.tag in html_text.HEADINGS or density(c) < (0.5 if c.tag in html_text.BLOCKS else 1)

    def text(n):
        if isinstance(n, str):
            return n
        if n.tag in html_text.VOID:
            return " "
        inner = "".join(map(text, n.children))
        return f"\0{inner}\0" if n.tag in html_text.BLOCKS else inner

    some = [best] if best.parent is None else [c for c in best.parent.children if c is best or kept(c)]
    out = [" ".join(b.split()) for b in "".join(map(text, some)).split("\0")]
    return "\n\n".join(b for b in out if b)


def test_random_trees_against_recursion():
    rng = random.Random(7)
    tags = "div section p p p ul li h2 table tr td span a b article main blockquote".split()

    def page(depth):
        if depth == 0 or rng.random() < 0.25:
            return " ".join(rng.choice(["word", "other,", "longer-word", "and"]) for _ in range(rng.randint(0, 25)))
        t = rng.choice(tags)
        name = rng.choice(["", "", "", " class=notice", " class=content", " id=related"])
        return f"<{t}{name}>" + " ".join(page(depth - 1) for _ in range(rng.randint(1, 4))) + f"</{t}>"

    for _ in range(400):
        html = "".join(page(5) for _ in range(rng.randint(1, 4)))
        root = html_text.parse(html)
        html_text.prune(root)
        assert main_text(html) == plain_text(root)


def test_broken_pages():
    assert main_text(None) == main_text("") == main_text("<scr") == main_text("<div>") == ""
    assert main_text("plain text") == "plain text"
    assert main_text("<p>a<p>b<scr") == "a\n\nb"
    assert main_text("<p>a &am") == "a &am"
    assert main_text("<div>" * 20_000 + "deep, text" + "</div>" * 20_000) == "deep, text"
    long = "word, " * 200_000
    assert main_text(f"<article><p>{long}</p></article>") == long.strip()


def test_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, "x"), (BIG, "v", "", None), (BIG + 2, "v", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract(df).collect()), key=str)
    assert got == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0), (BIG, "v", "", 0), (BIG + 2, "v", "", 0)], key=str)
    assert extract(df.limit(0)).count() == 0
