import random

from pyspark.sql import functions as F

from lectern.llm import wrappers as w


def text(page, template=frozenset()):
    return w._texts(set(template), page)


def test_blocks_and_references():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- <p>gone</p> --><div class="ad">buy</div>
    <article><h1>A &amp; B</h1><p><b>One<br>two
      three &lt;4&gt;<p>Next <i>par</i>agraph</p><p>  </p><ul><li>first<li>second</ul>
      <section class="comments"><p>me too</p></section></article>
    <aside>side</aside><form><p>mail</p></form><footer>&copy; me</footer></body></html>"""
    assert text(page) == "A & B\n\nOne two three <4>\n\nNext paragraph\n\nfirst\n\nsecond"


def test_pages_without_an_article():
    assert text("<body><header>h</header><div>one<p>two</div><div id=cookie-notice>ok?</div>three</body>") == "one\n\ntwo\n\nthree"
    assert text("no markup &nbsp; at   all") == "no markup at all"
    assert text("") == "" and text("<nav>only</nav>") == "" and text("a < b and c > d") == "a < b and c > d"
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    assert text(deep) == "deep"


def test_tree_matching_by_definition():
    rng = random.Random(2)

    def page(depth):
        return "".join(rng.choice(["<p>x</p>", f"<div>{page(depth - 1)}</div>", f"<ul>{page(depth - 1)}</ul>"] if depth else ["<p>x</p>"]) for _ in range(rng.randrange(4)))

    def naive(a, b):
        if isinstance(a, int) or isinstance(b, int):
            return int(isinstance(a, int) and isinstance(b, int))
        if a.label != b.label:
            return 0
        x, y = a.parts, b.parts
        m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + naive(x[i], y[j]))
        return m[-1][-1] + 1

    aligner = w.Aligner()
    for _ in range(40):
        a, b = (aligner.tree(w.skeleton(w.parse(page(3)))) for _ in range(2))
        assert aligner.size(a, b) == naive(a, b)
        pairs = list(aligner.texts(a, b))
        assert len(pairs) <= aligner.size(a, b)


def pages(spark, n, host, copies=1):
    rows = []
    for i in range(n):
        body = f"<div><p>Welcome to our site</p><p>story {i} of {host}</p><p>All rights reserved</p></div>"
        rows += [(i, f"http://{host}/{i}", body)] * copies
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_constant_texts_become_template(spark):
    many, few = pages(spark, 90, "Many.example.org"), pages(spark, 3, "few.example.org")
    got = {r.url: r.text for r in w.extract(many.unionByName(few), group_size=16).collect()}
    assert got["http://Many.example.org/7"] == "story 7 of Many.example.org"
    assert got["http://few.example.org/1"] == "Welcome to our site\n\nstory 1 of few.example.org\n\nAll rights reserved"


def test_copies_are_no_template(spark):
    same = pages(spark, 1, "one.example.org", copies=50)
    assert {r.text for r in w.extract(same).collect()} == {"Welcome to our site\n\nstory 0 of one.example.org\n\nAll rights reserved"}


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "no scheme", "<p>a"), (2, "no scheme", "<p>a"), (3, "http://h", ""), (None, "http://h/", "<p>b</p>")]
    given = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("template", F.lit(1))
    got = w.extract(given).collect()
    assert sorted(((r.page_id or 0, r.text) for r in got)) == [(0, "b"), (1, ""), (2, "a"), (2, "a"), (3, "")]
    assert w.extract(given.limit(0)).count() == 0


def test_attributes_are_read_by_name():
    """Values and longer names say nothing, nor do words of the ids inside an article."""
    kept = (
        'aria-hidden="false"', 'title="a hidden gem"', 'href="/hidden/gem"', "href=/hidden/", 'data-id="ad"', 'data-class="menu"',
        'data-role="menu"', 'id="social-policy"', "id=share-prices", 'class="related-work"', "title='x class=ad id=ad'",
    )
    gone = ("hidden", 'aria-hidden="true"', 'id="comments"', 'class="post AD x"', "role=menu", 'data-a="1"hidden', "class = 'ad'")
    for tag in ("section", "h2", "p", "span"):
        for attributes in kept:
            assert text(f"<article><p>a</p><{tag} {attributes}>b</{tag}></article>") == ("a\n\nb"), (tag, attributes)
        for attributes in gone:
            assert text(f"<article><p>a</p><{tag} {attributes}>b</{tag}></article>") == "a", (tag, attributes)
    assert text('<body><h2 id="social-policy">a</h2><div class="ad-box">b</div></body>') == "a"


def test_near_copies_of_an_article_are_no_template(spark):
    """Other adverts and comments, or a date, beside one article; with an article element and without."""
    rows = []
    for i in range(12):
        beside = f'<div class="ad">advert {i}</div><div class="comments"><p>comment {i}</p></div>'
        rows += [(i, "http://a.example.org/", f"<article><p>day {i}</p><p>one story</p></article>{beside}")]
        rows += [(100 + i, "http://m.example.org/", f"<main><p>one story</p></main>{beside}")]
        rows += [(200 + i, "http://n.example.org/", f"<div><p>one story</p></div>{beside}")]
    got = w.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 36
    assert all(r.text == (f"day {r.page_id}\n\none story" if r.page_id < 100 else "one story") for r in got)


def test_the_share_is_that_of_pages(spark):
    """A text in 70 % of a large host's pages goes, one in half of them stays; layouts may differ."""
    rows = []
    for i in range(200):
        most, half = "<p>in most</p>" * (i % 10 < 7), "<p>in half</p>" * (i % 2)
        rows.append((i, "http://large.example.org/", f"<div><p>story {i}</p>{most}{half}</div>"))
    for i in range(20):  # two layouts, the rarer first by its bytes
        body = f"<div class=a><p>tale {i}</p><p>rare</p></div>" if i < 6 else f"<div class=b><p>tale {i}</p><p>common</p></div>"
        rows.append((1000 + i, "http://two.example.org/", body))
    got = {r.page_id: r.text for r in w.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"story {i}" + "\n\nin half" * (i % 2) for i in range(200))
    assert all(got[1000 + i] == f"tale {i}" + "\n\nrare" * (i < 6) for i in range(20))


def test_roles_inside_an_article_and_outside():
    for name in ("comment-list", "ad-box", "site-footer", "newsletter-signup"):
        assert text(f'<article><p>a</p><div class="{name}"><p>b</p></div></article>') == "a", name
    for mark in ('class="remarks"', 'id="disqus_thread"', 'class="discussion"'):
        assert text(f"<body><p>a</p><div {mark}><p>b</p></div></body>") == "a", mark
    assert text('<article><p class="ad-hoc">a</p><h2 class="footer-notes">b</h2></article>') == "a\n\nb"


def test_nested_inline_adverts():
    assert text('<article><p>a <span class="ad"><span>Buy</span> now</span> b</p></article>') == "a b"
    assert text('<p>a <span class="ad">buy</span> b <b class="ad">c') == "a b c"


def test_long_pages_are_read_once():
    import time

    for page in ("<div>" * 60_000, '<a "' * 60_000, "<p>" * 60_000, '<a "' * 60_000 + ">", "<!" * 60_000, "<b class=ad>" * 2_000):
        start = time.time()
        w.parse(page)
        assert time.time() - start < 10


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_what_each_article_of_a_host_repeats_is_template(spark):
    """Inside article and main, over clearly different articles; on hosts with few of them it stays."""
    rows = []
    for host, n in (("many", 80), ("few", 5)):
        for i in range(n):
            own = " ".join(f"w{i}x{j}" for j in range(30))
            tag = ("article", "main")[i % 2]
            rows.append((i, f"http://{host}.example.org/{i}", f"<{tag}><p>{own}</p><div><p>Read more stories here</p></div></{tag}>"))
    for size in (16, 32, 500):
        got = {r.url: r.text for r in w.extract(rows_of(spark, rows), group_size=size, share=0.4).collect()}
        assert len(got) == 85 and all(("Read more" in out) == ("few." in url) for url, out in got.items()), size


def test_paragraphs_of_an_article_with_many_near_copies_stay(spark):
    """Two thirds of a host's pages are near copies of one article, alone in their groups or not."""
    rows = [(i, f"http://h.example.org/{i}", f"<article><p>day {i}</p><p>{'one long story ' * 9}</p><p>its end</p></article>") for i in range(200)]
    for i in range(100):
        own = " ".join(f"v{i}z{j}" for j in range(25))
        rows.append((1000 + i, f"http://h.example.org/{i}", f"<article><p>{own}</p></article>"))
    for some in (rows, rows[:200]):
        for size in (8, 32, 1000):
            got = {r.page_id: r.text for r in w.extract(rows_of(spark, some), group_size=size).collect()}
            assert all(got[i].startswith(f"day {i}") and got[i].endswith("its end") for i in range(200)), size


def test_induction_by_recount(spark):
    """One group: shares counted page by page over different contents, inside articles over different articles."""
    rng = random.Random(9)
    for whole in (True, False):
        bodies = []
        for i in range(40):
            own = "".join(f"<p>{i} {j} {'z' * 20}</p>" for j in range(rng.randrange(1, 4)))
            shared = "".join(f"<p>t{k}</p>" for k in range(6) if rng.random() < (0.3, 0.5, 0.55, 0.65, 0.8, 1)[k])
            bodies.append(f"<article>{own}{shared}</article>" if whole else f"<div>{own}{shared}</div>")
        bodies += bodies[:10]
        frame = rows_of(spark, [(i, "http://h/", b) for i, b in enumerate(bodies)])
        found = {n for r in w.induce(frame, group_size=1000).collect() for n in r.template}
        label = w._below(w._below(w._below(0, ""), "article" if whole else "div"), "p")
        different = list(dict.fromkeys(bodies))
        want = {k for k in range(6) if sum(f"<p>t{k}</p>" in b for b in different) >= 0.6 * len(different)}
        assert found == {w._name(label, w._text_hash(f"t{k}")) for k in want}
