import random
import re
import time

import pytest
from pyspark.sql import functions as F

from sievemark.llm import html_text as H
from sievemark.llm.catalogue import op7_html_text


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain &amp; simple\n text", "plain & simple text"),
        ("<article><h1>T &lt;1&gt;</h1><p><b>a.<br><p>b  \n c</p><p></p>tail</article>", "T <1>\na.\nb c\ntail"),
        ("<body><nav>menu</nav><main><div>one<script>var t='</p>'</script> two</div></main><footer>f</footer>", "one two"),
        ("<article>a<aside>side</aside>b<form>x</form><div class='x newsletter-box'>n</div><section id=comments><article>c</article></section></article>", "a\nb"),
        ("<header>h</header><article><header><h1>Title</h1></header><ul><li>x<li>y</ul><!-- no --><style>p{}</style></article>", "Title\nx\ny"),
        ("<div class=article-body><p>kept</p></div><div class=sidebar>no</div><div style='display:none'>no</div>", "kept"),
        ("<article class='comment'>no</article><article>yes<article>nested</article></article>", "yes\nnested"),
        ("<p>x &nbsp;&eacute;&#233;&#x41;<p>un<i>der</i>lined < 3 & <b", "x ééA\nunderlined < 3 & <b"),
        ("<article>open <p>never closed <em>at all", "open\nnever closed at all"),
        ("</div></p><table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<div class=site-header>no</div><article><div class=article-header>Title</div>text</article>", "Title\ntext"),
        ("<div id=header>no</div><div>text</div>", "text"),
        ("<textarea>no<p></textarea><title>no</title><p title=\"a > b\">yes", "yes"),
    ],
)
def test_pages(page, text):
    assert H.extract_page(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<main class='content no-sidebar'>a</main>", "a"),
        ("<div class='post comments-open'><p>a</div><div class='comments-area'>no</div>", "a"),
        ("<article class='post social-science'>a<div class=social-links>no</div></article>", "a"),
        ("<article><h2 id=related-work>a</h2><section id=search-algorithms>b</section><p id=response>c<p id=notice>d</article>", "a\nb\nc\nd"),
        ("<div class='layout sidebar-right'><h1>T</h1><p>a long enough text</p></div><div class=left-sidebar>no</div><div class=siteFooter>no</div>", "T\na long enough text"),
        ("<div class=has-header>a</div><div class=site-header>no</div><div class=cookie-banner-2>no</div><div role=search>no</div>", "a"),
    ],
)
def test_names_that_mark_and_names_that_do_not(page, text):
    assert H.extract_page(page) == text


def test_tree_matching():
    a = H.folded(H.page_blocks("<body><div>c</div><ul><li>1</li><li>2</li></ul><p>x</p></body>"))
    b = H.folded(H.page_blocks("<body><div>c</div><section>new</section><ul><li>7</li></ul><p>y</p></body>"))
    n, pairs = H.align(a, b)
    assert n == 6 and [x.tag for x, _ in pairs] == ["", "body", "div", "ul", "li", "p"] and pairs[4][0].texts == ["1", "2"]


def brute_align(a, b):
    """Simple tree matching with the full table over both lists of children."""
    if a.tag != b.tag:
        return 0
    table = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children, 1):
        for j, y in enumerate(b.children, 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + brute_align(x, y))
    return table[-1][-1] + 1


def test_tree_matching_against_the_full_table():
    rng = random.Random(4)

    def tree(depth):
        kids = "".join(f"<{t}>{tree(depth - 1)}</{t}>" for t in rng.choices(["div", "ul", "section", "p", "table", "form1", "h1"], k=rng.randrange(6))) if depth else ""
        return f"t{rng.randrange(9)}{kids}"

    for _ in range(60):
        a, b = (H.folded(H.page_blocks(f"<body>{tree(3)}</body>")) for _ in range(2))
        n, pairs = H.align(a, b)
        assert n == brute_align(a, b) == len(pairs) and all(x.tag == y.tag for x, y in pairs)


@pytest.mark.parametrize(
    "page, blocks",
    [
        ("<body>" + "<p>a</p><div>b</div>" * 5000 + "</body>", 10_000),
        ('<p "' * 250_000, 1),
        ('<p "> " ' * 100_000, 1),
        ("<b>" * 50_000 + "<p></p></x>x" * 30_000, 30_000),
        ("<" * 500_000 + ">", 1),
        ("<ul><li>a" * 20_000, 20_000),
    ],
)
def test_reading_takes_linear_time(page, blocks):
    began = time.process_time()
    found = H.page_blocks(page)
    H.align(H.folded(found), H.folded(found))
    assert time.process_time() - began < 10
    assert len(found) >= blocks


def test_wrapper_without_semantic_elements(spark):
    """The host's constant texts go and its varying slot stays, also for a host whose pages are all copies."""
    page = "<body><div class=top><div>Welcome to us</div><div><a href=/{i}>Link {i}</a></div></div><div class='story s{i}'><div><p>Story {i} told at length</p><p>with a second part {j}</p></div></div><div>Rights reserved</div></body>"
    rows = [(i, f"http://a.x/{i}", page.format(i=i, j=i * 7)) for i in range(6)] + [(10 + i, "http://copies.x/", page.format(i=1, j=2)) for i in range(5)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(6)] == [f"Story {i} told at length\nwith a second part {i * 7}" for i in range(6)]
    assert got[10] == "Welcome to us\nLink 1\nStory 1 told at length\nwith a second part 2\nRights reserved"


def test_wrapper_bounds_by_the_article_that_varies(spark):
    """The article's own texts stay though all pages have them, but for links; what varies outside it is not content."""
    page = "<body><div>Offer {j}</div><article><h1>T{i}</h1><p>Story {i} told n{i} in w{i} its x{i} own y{i} words</p><div>Read it all</div><div><a href=/>All stories</a></div></article><div>seen {j}</div></body>"
    rows = [(i, "http://a.x/", page.format(i=i, j=i * 7)) for i in range(5)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"T{i}\nStory {i} told n{i} in w{i} its x{i} own y{i} words\nRead it all" for i in range(5)}


def test_near_copies_of_an_article_are_no_template(spark):
    """Pages that differ in one word keep their whole text, alone on a host or beside other pages."""
    article = "<body><div>Our site</div><article><h1>The title</h1><p>First paragraph, told in full.</p><p>Second paragraph, told as well.</p><p>Third paragraph of version {i} ends the story.</p></article></body>"
    other = "<body><div>Our site</div><article><h1>Other {i}</h1><p>Report number {i} on quite another matter {i}{i}</p></article></body>"
    plain = "<body><div>First paragraph, told in full.</div><div>The third paragraph of this story, in its version {i} here, ends it as it should be ended.</div></body>"
    rows = [(i, "http://few.x/", article.format(i=i)) for i in range(3)] + [(10 + i, "http://many.x/", article.format(i=i)) for i in range(30)]
    rows += [(50, "http://many.x/", other.format(i=1)), (51, "http://many.x/", other.format(i=2)), (52, "http://many.x/", other.format(i=3))]
    rows += [(60 + i, "http://plain.x/", plain.format(i=i)) for i in range(3)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    whole = "The title\nFirst paragraph, told in full.\nSecond paragraph, told as well.\nThird paragraph of version {i} ends the story."
    assert all(got[i] == whole.format(i=i) for i in range(3)) and all(got[10 + i] == whole.format(i=i) for i in range(30))
    assert all(got[50 + i] == f"Other {i + 1}\nReport number {i + 1} on quite another matter {i + 1}{i + 1}" for i in range(3))
    assert all(got[60 + i].startswith("First paragraph, told in full.\n") for i in range(3))


def test_each_layout_has_its_own_template(spark):
    """Two layouts at 60 to 40: the template of both goes and the text of both stays."""
    first = "<body><div class=top>Welcome to us</div><article><h1>Title {i}</h1><p>Story {i} told at length {j}</p></article><div class=end>Rights reserved</div></body>"
    second = "<body><section><div class=hint>Pick what you like</div><div class=entry>Entry {i} stands alone here {j}</div><div class=last>End of the list</div></section></body>"
    rare = "<body><section><main><p>A page by itself</p></main></section><div>beside it</div></body>"
    rows = [(i, "http://a.x/", (first if i < 12 else second).format(i=f"n{i}", j=f"{i * 7} {i * 11}")) for i in range(20)] + [(20, "http://a.x/", rare)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Title n{i}\nStory n{i} told at length {i * 7} {i * 11}" for i in range(12))
    assert all(got[i] == f"Entry n{i} stands alone here {i * 7} {i * 11}" for i in range(12, 20))
    assert got[20] == "A page by itself"
    assert H.choose_layouts([("a\nb", 5), ("a", 1), ("c", 2), ("d\ne", 3)]) == ["a\nb", "d\ne"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_host_of_many_layouts_has_a_template_for_each(spark, monkeypatch, broadcast):
    """Six layouts besides 1100 commoner sets of paths of a seventh: the template of all goes and the text of all stays."""
    monkeypatch.setattr(H, "SLICE", 400)
    if not broadcast:
        monkeypatch.setattr(H, "BROADCAST_CHARS", -1)
        monkeypatch.setattr(H, "fitted", lambda df, row_bytes=64: df)
    name = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    frame = "<body><div class=z{n}><div class=w{n}><div class=u{n}>Welcome to part {n}</div></div><div class=t{n}>Entry {i} stands alone here {j}</div><div class=e{n}>End of part {n}</div></div></body>"
    crowd = "<body><div class=p><div class=q><div class=r>Hello all</div><div class=s>Story {i} of its own {j}</div></div></div><div class=v{n}>Part {i} of it {j}</div></body>"
    rows = [(10 * n + i, "http://a.x/", frame.format(n=name(n), i=f"n{n}{i}", j=f"{i * 7} {i * 11 + n}")) for n in range(6) for i in range(3)]
    rows += [(1000 + 2 * n + i, "http://a.x/", crowd.format(n=name(n), i=f"n{n}{i}", j=n * 13 + i)) for n in range(1100) for i in range(2)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert all(got[10 * n + i] == f"Entry n{n}{i} stands alone here {i * 7} {i * 11 + n}" for n in range(6) for i in range(3))
    assert all(got[1000 + 2 * n + i] == f"Story n{n}{i} of its own {n * 13 + i}\nPart n{n}{i} of it {n * 13 + i}" for n in range(1100) for i in range(2))


def test_the_likest_layout_against_all_comparisons():
    rng = random.Random(7)
    for trial in range(60):
        names = [f"{x}" for x in range(rng.choice([4, 12, 40]))]
        keys = list(dict.fromkeys("\n".join(sorted(rng.sample(names, rng.randint(1, min(len(names), 9))))) for _ in range(80)))
        share = lambda a, b: len(a & b) / len(a | b)
        sets, layouts = [set(k.split("\n")) for k in keys[:50]], H.Layouts()
        for k in keys[:50]:
            layouts.add(k)
        for k in [*keys, "unknown", "0\nunknown"]:
            all_shares = [share(x, set(k.split("\n"))) for x in sets]
            for least in (0.0, 0.5, 1.0):
                best = max(all_shares)
                assert layouts.likest(k, least) == (all_shares.index(best) if best >= least and best > 0 else None), (trial, k, least)
    assert H.choose_layouts([("a", 2), ("b", 2)]) == ["a"] and H.choose_layouts([(name, 3) for name in "abcdefgh"]) == list("abcdefgh")


def test_sets_that_are_like_no_other_do_not_matter_to_the_choice(spark):
    rng = random.Random(11)
    rows = []
    for host in range(40):
        names = [f"n{x}" for x in range(rng.choice([3, 8]))]
        keys = dict.fromkeys("\n".join(sorted([*rng.sample(names, rng.randint(1, 3)), *(f"own{host}{k}{x}" for x in range(rng.choice([0, 2, 9])))])) for k in range(rng.choice([1, 4, 30])))
        rows += [(f"h{host}", key, rng.choice([1, 1, 2, 2, 3] if host % 2 else [1, 2]), i, 1) for i, key in enumerate(keys)]
    left = [tuple(r) for r in H._related(spark.createDataFrame(rows, "host string, key string, pages long, hash long, chars int")).collect()]
    assert set(left) < set(rows) and len(left) == len(set(left))
    for host in range(40):
        every, some = ([(key, pages) for h, key, pages, _, _ in x if h == f"h{host}"] for x in (rows, left))
        assert H.choose_layouts(some) == H.choose_layouts(every)


def test_induction_counts_pages_against_brute_force():
    """A wrapper's constants are the texts that nine tenths of the pages have in the same node."""
    pages = [f"<body><ul><li>a</li><li>b{i % 2}</li></ul><section><p>text {i} of it</p><p>often</p></section></body>" if i else "<body><ul><li>a</li><li>b0</li></ul><section><p>text</p><p>often</p></section></body>" for i in range(20)]
    counted = {}
    for page in pages:
        for s in H._seen(pages[0], H.page_blocks(page)):
            row = counted.setdefault((s["node"], s["text"]), {"node": s["node"], "text": s["text"], "pages": 0, "varying": 0, "links": 0})
            row["pages"] += 1
            row["varying"] += s["varying"]
            row["links"] += s["links"]
    w = H.induce(pages[0], list(counted.values()))
    assert w.known and w.region is None and not w.menus
    assert w.constants == {H._digest("/body/ul/li", "a"), H._digest("/body/section/p", "often")}
    assert H.extract_page(pages[3], w) == "b1\ntext 3 of it"
    assert H.induce(pages[0], []) == H.Wrapper()


def test_driver_table_against_its_own_markup(spark):
    """There the article element holds the main text, without nested markup but b and br."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in op7_html_text(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == pages.count()
    import html

    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert got[r["page_id"]]["text"] == "\n".join(x for x in parts if x) and got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(H, "BROADCAST_CHARS", -1)
    rows = [(1, None, None, "x"), (2, "no host", "<p>a", "x"), (3, "http://h/", "", "x"), (4, "http://h/", "<p>" * 500 + "deep" + "<div>" * 3000 + "deeper", "x"), (4, "http://h/", "b " * 50_000, "x"), (None, "http://h/", "<p>c</p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"] or 0, r["text"], r["n_chars"]) for r in H.extract(df).collect()))
    assert got == sorted([(1, "", 0), (2, "a", 1), (3, "", 0), (4, "deep\ndeeper", 11), (4, " ".join(["b"] * 50_000), 99_999), (0, "c", 1)])
    assert H.extract(df.limit(0)).agg(F.count(F.lit(1))).first()[0] == 0
