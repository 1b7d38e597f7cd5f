import random

from polikit.llm import html_extract as H

PAGES = "page_id long, url string, html string"


def page(rng, body, host="h.example.com", extra=""):
    ad = "".join(rng.choice("abc ") for _ in range(30))
    return (f'<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head>'
            f'<body><nav><ul><li><a href="/">{ad}</a></li></ul></nav><!-- ad --><div class="ad">{ad}</div>{extra}'
            f'<article>{body}</article><footer>&copy; {host}</footer></body></html>')


def para(rng, n=12):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))


def test_parse_handles_broken_markup():
    e = H.extract
    assert e(None, None) == "" and e("", None) == "" and e("plain &amp; text", None) == "plain & text"
    assert e("<article><h1>A &lt;b&gt;</h1><p><b>x\n y<br><p>z</article>", None) == "A <b> x y z"
    assert e("<article><p>cut off <b>here &amp", None) == "cut off here &"
    assert e("<article><p>cut tag <a hre", None) == "cut tag"
    assert e("<article><p>1 < 2 <!-- no --> <![CDATA[x]]> ok", None) == "1 < 2 ok"
    assert e("<article><p title='a>b'>q</p><p class=\"x>y\">r</p>", None) == "q r"
    assert e("<div>" * 5000 + "deep" + "</div>" * 5000, None) == "deep"
    assert e("<article><p>in<b>li</b>ne<p>block</article>", None) == "inline block"


def test_parts_that_are_not_the_article():
    junk = ('<header><h2>site</h2></header><aside>side</aside><form><input value=x>send</form>'
            '<div class="cookie-notice">ok?</div><div id="sidebarLeft">menu</div><noscript>js</noscript>')
    body = ('<h1>Title</h1><p>First.</p><div class="advert">buy</div><ul><li>one<li>two</ul><script>x</script>'
            '<section class="comments"><p>nice post</p></section><p>Last&nbsp;word.</p>')
    html = f"<html><head><title>t</title></head><body>{junk}<article>{body}</article><footer>f</footer></body></html>"
    assert H.extract(html, None) == "Title First. one two Last word."
    plain = html.replace("<article>", '<div class="post">').replace("</article>", "</div>")
    assert H.extract(plain, None) == "Title First. one two Last word."


def slow_match(a, b):
    """Simple tree matching, as defined."""
    if a.tag != b.tag:
        return 0
    m = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children, 1):
        for j, y in enumerate(b.children, 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + slow_match(x, y))
    return m[-1][-1] + 1


def test_tree_match_is_the_largest():
    rng = random.Random(2)

    def tree(depth):
        node = H.Node(rng.choice("ab") if depth < 4 else "r")
        if depth:
            node.children = [tree(depth - 1) for _ in range(rng.randint(0, 3))]
        return node
    for _ in range(200):
        a, b = tree(4), tree(4)
        pairs = H.tree_match(a, b)
        assert len(pairs) == slow_match(a, b)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)


def induced(pages):
    """The wrapper of a host that has these pages only, its template taken as all candidates."""
    made = H.induce([H.skeleton(p) for p in pages])
    return {**made, "template": made["candidates"]}


def boxed(rng, n=8, notice="Share this story", size=12):
    bodies = [f"<h1>{para(rng, 4)}</h1><p>{para(rng, size)}</p><p>{notice}</p>" for _ in range(n)]
    return bodies, [page(rng, b).replace("<article>", '<div class="c1"><div class="c2">').replace("</article>", "</div></div>")
                    for b in bodies]


def test_wrapper_finds_container_and_template():
    bodies, pages = boxed(random.Random(3))
    made = induced(pages)
    assert made["path"] == ["html", "body", "div c1", "div c2"] and [t[1] for t in made["template"]] == ["Share this story"]
    for b, p in zip(bodies, pages):
        assert "Share" not in H.extract(p, made) and H.extract(p, made) == H.extract(f"<article>{b}</article>", None)[:-17]
    assert induced([pages[0]] * 8)["template"] == []  # copies are one page


def test_only_the_aligned_node_is_template():
    """An article block that reads the same stays, before or after the notice."""
    rng = random.Random(13)
    bodies, pages = boxed(rng, notice="The end")
    made = induced(pages)
    twice = pages[0].replace("<p>The end</p>", f"<p>The end</p><p>{para(rng)}</p><p>The end</p>")
    assert H.extract(twice, made).count("The end") == 1 and H.extract(twice, made).startswith(H.extract(pages[0], made) + " The end ")
    other = pages[1].replace("<p>The end</p>", "<h2>The end</h2><p>The end</p>")
    assert H.extract(other, made).endswith(" The end")


def site(rng, n, host, notice, size):
    """Pages of one host with a notice in the article box, and their texts without it."""
    rows, want = [], []
    for i in range(n):
        body = f"<h1>{para(rng, 3)}</h1>" + "".join(f"<p>{para(rng, 20)}</p>" for _ in range(size))
        at = page(rng, body + f"<p>{notice}</p>", host).replace("<article>", '<div class="box">').replace("</article>", "</div>")
        rows.append((f"http://{host}/{i}", at))
        want.append(H.extract(f"<article>{body}</article>", None))
    return rows, want


def test_template_of_long_pages_and_small_hosts(spark):
    """A notice goes on pages of any length and on hosts of two pages; one that a few pages have stays."""
    rng = random.Random(14)
    rows, want = [], []
    for host, n, size in (("long.example.com", 10, 600), ("two.example.com", 2, 4), ("three.example.com", 3, 1200), ("many.example.com", 30, 5)):
        own, texts = site(rng, n, host, "Subscribe now to us", size)
        rows += own
        want += texts
    some, texts = site(rng, 40, "some.example.com", "Breaking", 4)
    rows += [(u, h if i % 3 == 0 else h.replace("<p>Breaking</p>", "")) for i, (u, h) in enumerate(some)]
    want += [t + " Breaking" if i % 3 == 0 else t for i, t in enumerate(texts)]
    copies, texts = site(rng, 1, "copy.example.com", "All one story", 9)
    url, html = copies[0]
    near = html.replace("<h1>", "<h1>New: ", 1)
    rows += [(url, html)] * 20 + [(url + "x", near)] * 20
    want += [f"{texts[0]} All one story"] * 20 + [f"New: {texts[0]} All one story"] * 20  # near copies are no layout
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], PAGES).repartition(6)
    got = {r["page_id"]: r["text"] for r in H.main_text(df).collect()}
    assert [got[i] for i in range(len(rows))] == want


def test_template_that_references_lack(spark):
    """A notice on nine of ten pages goes, also where the shortest references lack it, and one too long for a skeleton."""
    rng = random.Random(21)
    rows, want = [], []
    for host, notice in (("lack.example.com", "Subscribe now"), ("legal.example.com", "Every word is given without warranty. " * 8)):
        own, texts = site(rng, 40, host, notice, 40 if "legal" in host else 5)
        for i, (url, html) in enumerate(own):
            cut = i % 10 == 0
            rows.append((url, html.replace(f"<p>{notice}</p>", "") if cut else html))
            want.append(texts[i])
    short = '<html><body><nav>x</nav><div class="box"><h1>A b</h1><p>Short one here {}</p></div></body></html>'
    rows += [(f"http://lack.example.com/s{i}", short.format(i)) for i in range(4)]
    want += [f"A b Short one here {i}" for i in range(4)]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], PAGES).repartition(5)
    got = {r["page_id"]: r["text"] for r in H.main_text(df).collect()}
    assert [got[i] for i in range(len(rows))] == want


def test_words_within_names_drop_nothing_of_the_article():
    rng = random.Random(15)
    bodies = [f'<h1>T{i}</h1><p class="related-work">{para(rng)}</p><section class="search-results-study"><p>Para {para(rng)}</p></section>'
              f'<div id="newsletter_archive">{para(rng)}</div><ul class="comments"><li>nice {i}</li></ul><p>End {i}.</p>' for i in range(10)]
    pages = [page(rng, b) for b in bodies]
    made = induced(pages)
    for i, (b, p) in enumerate(zip(bodies, pages)):
        text = H.extract(p, made)
        assert text == H.extract(p, None) and text.startswith(f"T{i} ") and text.endswith(f" End {i}.")
        assert "Para" in text and "nice" not in text and len(text.split()) == 1 + 12 + 13 + 12 + 2


def test_container_named_like_boilerplate():
    html = f'<body><div class="site-header">Menu words here and there</div><div class="comment-driven-blog"><h1>A title</h1><p>{"word " * 50}</p></div></body>'
    assert H.extract(html, None) == "A title " + " ".join(["word"] * 50)


def test_skeletons_are_bounded():
    html = "<article>" + "".join(f"<p>{'x' * 5000}{i}</p>" for i in range(5000)) + "</article>"
    made = H.skeleton(html)
    assert len(made) < 100_000 and H.skeleton(html) == made
    deep = H.skeleton("<div>" * 20_000 + "x")
    assert len(deep) < 200_000


def plain_constant(pages):
    """Texts inside the container of small trees that every page has at the same steps from it."""
    def own(p):
        return {(path, text) for path, text in H.placed_blocks(H.content_path(H.parse(p))[-1])}
    return set.intersection(*map(own, pages))


def test_induction_against_plain_intersection():
    """Small pages whose constant blocks stand at either end of varying ones: the aligned constants are those that all share."""
    rng = random.Random(16)
    for _ in range(40):
        head, tail = rng.randint(0, 2), rng.randint(0, 2)
        before = "".join(f"<h2>fixed {i}</h2>" for i in range(head))
        after = "".join(f"<p>last {i}</p>" for i in range(tail))
        pages = [f"<html><body><nav>n</nav><div class='box'>{before}" + "".join(f"<p>{para(rng, 9)}</p>" for _ in range(rng.randint(3, 6)))
                 + f"{after}</div></body></html>" for _ in range(rng.randint(2, 6))]
        made = induced(pages)
        assert {(t[0], t[1]) for t in made["template"]} == plain_constant(pages) and len(made["template"]) == head + tail


def test_article_after_siblings_like_it():
    """The container has siblings of the same step: plain boxes, cells, sections, articles."""
    rng = random.Random(9)
    for box in ("div", "td", "section", "article"):
        bodies = [f"<h1>{para(rng, 3)}</h1><p>{para(rng, 20 + k)}</p>" for k in range(4)]
        about = "<p>" + "all about this site and its makers " * 3 + "</p>"
        for before, after in (("Site name", ""), ("", "Site name"), (about, ""), ("", about)):
            boxed = [f"<{box}>{before}</{box}>" * bool(before) + f"<{box}>{b}</{box}>" + f"<{box}>{after}</{box}>" * bool(after)
                     for b in bodies]
            pages = [f"<html><body>{'<table><tr>' if box == 'td' else ''}{b}</body></html>" for b in boxed]
            made = induced(pages)
            for b, p in zip(bodies, pages):
                assert H.extract(p, made) == H.extract(f"<article>{b}</article>", None)


def wrappers_of(spark, rows):
    import json
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], PAGES).repartition(5)
    return {r["host"]: json.loads(r["wrapper"]) for r in H.wrappers(df).collect()}


def test_all_pages_vote_for_the_wrapper(spark):
    """The pages with the smallest hashes have another layout than the other three quarters of their host."""
    from pyspark.sql import functions as F
    rng = random.Random(31)
    odd = [f'<html><body><div class="old"><h1>{para(rng, 3)}</h1><p>{para(rng, 60)}</p></div></body></html>' for _ in range(400)]
    new = [f'<html><body><p>On every page</p><div class="new"><h1>{para(rng, 3)}</h1><p>{para(rng, 60)}</p></div></body></html>' for _ in range(200)]
    made = spark.createDataFrame([(h,) for h in odd + new], "html string").withColumn("key", F.xxhash64("html")).collect()
    key = {r["html"]: r["key"] for r in made}
    first = sorted(odd, key=key.get)[:8]
    rest = [h for h in new if key[h] > key[first[-1]]][:40]
    assert len(rest) == 40
    found = wrappers_of(spark, [("http://a.example.com/", h) for h in first + rest])["a.example.com"]
    assert found["path"] == ["html", "body", "div new"]


def test_constants_are_of_whole_pages_and_all_of_them(spark):
    """Constant texts amid long pages, and long ones, are found; one that a page in ten lacks, or that three in ten have, is told apart."""
    rng = random.Random(32)
    legal = "Every word is given without any warranty. " * 8

    def made(i):
        body = [f"<p>{para(rng, 5)}</p>" for _ in range(200)]
        return ("<html><body>" + "".join(body[:100]) + f"<h3>{legal}</h3>" + ("<h4>Nine of ten</h4>" if i % 10 else "")
                + ("<h5>Three of ten</h5>" if i % 10 < 3 else "") + "".join(body[100:]) + "</body></html>")
    rows = [("http://long.example.com/", made(i)) for i in range(40)] + [("http://two.example.com/", made(1)), ("http://two.example.com/", made(2))]
    found = wrappers_of(spark, rows)
    mark = H._mark(H.Node("#", "", legal))
    assert len(mark) < len(legal) and set(found["two.example.com"]["constant"]) == {mark, "Nine of ten", "Three of ten"}
    assert set(found["long.example.com"]["constant"]) in ({mark, "Nine of ten"}, {mark})  # the anchor may be a page that lacks it
    top = H.parse(f"<body><div>{legal}</div><section>{para(rng, 20)}</section></body>")
    assert H.container(top, {"path": ["nowhere"], "constant": [mark]}).tag == "section"


def test_few_pages_are_induced_alike_in_one_place(spark):
    """All of up to eight pages in the table, and their skeletons in one place, give one wrapper."""
    rng = random.Random(33)
    rows = []
    for n in range(2, 9):
        rows += [(f"http://h{n}.example.com/{i}", p) for i, p in enumerate(boxed(rng, n)[1])]
    found = wrappers_of(spark, rows)
    for n in range(2, 9):
        own = H.induce([H.skeleton(p) for u, p in rows if f"/h{n}." in u])
        assert (found[f"h{n}.example.com"]["path"], found[f"h{n}.example.com"]["constant"]) == (own["path"], own["constant"])


def test_long_lists_are_matched_alike(monkeypatch):
    """By rows of numpy as by plain tables, and a list of thousands in little memory."""
    import tracemalloc
    rng = random.Random(34)

    def tree(depth, most):
        node = H.Node(rng.choice("ab") if depth < 3 else "r")
        if depth:
            node.children = [tree(depth - 1, 3) for _ in range(rng.randint(0, most))]
        return node
    for _ in range(60):
        a, b = tree(3, 12), tree(3, 12)
        plain = [(id(x), id(y)) for x, y in H.tree_match(a, b)]
        with monkeypatch.context() as m:
            m.setattr(H, "CELLS", 0)
            assert plain == [(id(x), id(y)) for x, y in H.tree_match(a, b)]
        assert len(plain) == slow_match(a, b)
    texts = [[H.Node(rng.choice(("p", "h2", "ul", "ol"))) for _ in range(3000)] for _ in range(2)]
    a, b = H.Node("r"), H.Node("r")
    a.children, b.children = texts
    tracemalloc.start()
    pairs = H.tree_match(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(pairs) > 1500 and peak < 16 << 20


def test_outlines_are_whole():
    html = "<div>" * 20_000 + "x" + "</div>" * 20_000 + "".join(f"<p>{i}</p>" for i in range(5000))
    made, plain = H._outlined(H.outline(html)), H.parse(html)
    assert H.placed_blocks(made) == H.placed_blocks(plain) and len(H._texts(made)) == 5001
    assert len(H.repeated(made, plain)) == 5001


def test_whole_table(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(120):
        host = "hot.example.com" if i % 3 else f"h{i % 7}.example.org"
        parts = [para(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 5))]
        if i % 5 == 0:
            parts[0] = "a very common passage"
        rows.append((i, f"http://{host}/{i}", page(rng, f"<h1>t{i}</h1>" + "".join(f"<p>{p}</p>" for p in parts), host)))
        want[i] = " ".join([f"t{i}", *parts])
    long = " ".join(para(rng) for _ in range(3000))
    rows += [(200, "http://hot.example.com/l", page(rng, f"<p>{long}</p>")), (201, None, None), (202, None, ""),
             (203, "nothing", "<nav>x</nav>"), (None, "http://hot.example.com/1", rows[1][2]), rows[5]]
    want |= {200: long, 201: "", 202: "", 203: ""}
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS id", "2 AS host", "3 AS wrapper", "4 AS key")
    got = H.main_text(df).collect()
    assert got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"} and len(got) == len(rows)
    for r in got:
        assert r["text"] == want[1 if r["page_id"] is None else r["page_id"]] and r["n_chars"] == len(r["text"])


def test_empty_table(spark):
    assert H.main_text(spark.createDataFrame([], PAGES)).collect() == []
