import random

from riskframe.llm import html_extract as H


def article(body, n=0):
    return (f'<!DOCTYPE html><html><head><title>T{n}</title><style>p{{}}</style><script>var t="</p><article>";</script></head><body>'
            f'<header><h1>Site</h1></header><nav><ul><li><a href="/a">A{n}</a><li>B</ul></nav><div class="cookie-notice">We use cookies</div>'
            f'<article>{body}</article><div id="comments"><p>first!</p></div><aside>More</aside><footer>&copy; x</footer></body></html>')


def plain(body, n):
    return (f'<html><body><div class="top">Welcome to our site</div><ul><li>Home</li><li>About</li></ul><div class="body">{body}</div>'
            f'<p>Call us now</p><form><input name="q">Search</form></body></html>')


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "old", 1) for i, u, h in rows], "page_id long, url string, html string, text string, place long").repartition(3)


CASES = [
    ("<h1>Title</h1><p>One&nbsp;two\n  three<p>Four &amp; five &lt;b&gt;", "Title\nOne two three\nFour & five <b>"),
    ("<h1>T</h1><p><b>bold <i>text</i>.<br><p>Next</p>", "T\nbold text.\nNext"),
    ("<p>a</p><div class='ad'>buy</div><p>b</p><form>x<button>go</button></form><aside>side</aside><script>1<2</script><!-- c --><p>c", "a\nb\nc"),
    ("<p>keep</p><section class=comments><p>nope</p></section><p>1 < 2 and 3</p>", "keep\n1 < 2 and 3"),
    ("<ul><li>x<li>y</ul><table><tr><td>p<td>q</table>", "x\ny\np\nq"),
    ("", ""),
    ("<p>" + "long " * 40_000 + "</p>", ("long " * 40_000).strip()),
    ("<p>caf&eacute; &#8364;5 &#x4e2d; &unknown; &amp;amp;</p>", "café €5 中 &unknown; &amp;"),
    ("<header><h1>Inside</h1></header><p class='lead ad'>x</p>", "Inside"),
    ("<p class='lead ad-free'>x</p><section id='related-work'>y</section><p class='share-price'>z</p><h2 id='social-history'>h</h2>", "x\ny\nz\nh"),
    ("<p data-id='ad' data-class=nav>x</p><div id=ad>gone</div>", "x"),
    ("<p class=it's>x</p><p title='a > b < c'>y</p>", "x\ny"),
    ("<table><tr><td class=ad>ad<tr><td>cell two<td>three</table>", "cell two\nthree"),
    ("<dl><dt>a<dd class=ad>b<dt>c</dl>", "a\nc"),
]


def test_unclosed_tags_are_read_once():
    import time
    assert [H.main_text(x, None) for x in ("a <b", "a<script>x > y", "a<!-- b > c", "a<!-- b --> c < d", "<p <b>x", "a<style>p{}</style> z")] == [
        "a <b", "a", "a", "a c < d", "x", "a z"]
    for piece in ("<a ", "<p class='", '<a "', "<!", "<a b='c' ", "<a =' >", "<!-- ", "<script "):
        start = time.perf_counter()
        sum(1 for _ in H.tokens(piece * 100_000))
        assert time.perf_counter() - start < 4


def test_articles(spark):
    rows = [(i, f"http://h{i % 2}.example/{i}", article(body, i)) for i, (body, _) in enumerate(CASES)]
    got = {r.page_id: r for r in H.extract_main_text(pages(spark, rows), least_pages=3).collect()}
    for i, (_, want) in enumerate(CASES):
        assert got[i].text == want, i
    assert got[0].place == 1 and got[0].url == "http://h0.example/0"


def test_without_article_the_template_is_removed(spark):
    rng = random.Random(1)
    bodies = [" ".join(f"<p>w{rng.randrange(999)} {k}" for k in range(1, 2 + i % 3)) for i in range(8)]
    rows = [(i, "http://plain.example/", plain(b, i)) for i, b in enumerate(bodies)]
    got = {r.page_id: r.text for r in H.extract_main_text(pages(spark, rows)).collect()}
    for i, b in enumerate(bodies):
        assert got[i] == "\n".join(x.strip() for x in b.split("<p>") if x.strip())
    # too few different pages: no template, so the elements alone decide
    few = {r.page_id: r.text for r in H.extract_main_text(pages(spark, rows[:2] * 3)).collect()}
    assert few[0].startswith("Welcome to our site\nHome\nAbout\n") and few[0].endswith("Call us now")


def test_equivalence_classes_equal_the_definition(spark):
    rng = random.Random(3)
    rows = [(i, f"https://e{i % 3}.example/x", plain("<p>a" * rng.randrange(1, 4), i) if i % 3 else article("<p>z", i)) for i in range(30)]
    table = {r.host: r for r in H.templates(pages(spark, rows).select("page_id", "url", "html")).collect()}
    for host in ("e0.example", "e1.example"):
        counts = [{} for _ in range(10)]
        mine = [h for _, u, h in rows if f"//{host}/" in u]
        for c, page in zip(counts, mine):
            for r in H.tokens(page):
                name = H._named(*r[:3])
                if name:
                    c[name] = c.get(name, 0) + 1
        vectors = {}
        for t in set().union(*counts):
            vectors.setdefault(tuple(c.get(t, 0) for c in counts), set()).add(t)
        want = {frozenset(ts) for v, ts in vectors.items() if min(v) > 0 and (set(v) == {1} or len(ts) > 1)}
        if host in table:
            found = {}
            for t in table[host].tokens:
                found.setdefault(t.vector, set()).add(t.token)
            assert {frozenset(x) for x in found.values()} == want
            assert found[table[host].once] == vectors[(1,) * 10]
    assert "e0.example" in table


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "no url", ""), (None, "http://[bad", "<p>x"), (3, "HTTP://U@Big.Example:80/x", "text only"), (3, "HTTP://U@Big.Example:80/x", "text only"),
            (4, "http://a.example", "<article><p>x</article></article></div><p>after"), (5, "http://a.example", "<"), (6, "http://a.example", "<p <b>")]
    got = sorted(((r.page_id, r.text) for r in H.extract_main_text(pages(spark, rows)).collect()), key=str)
    assert got == sorted([(1, ""), (2, ""), (None, "x"), (3, "text only"), (3, "text only"), (4, "x"), (5, "<"), (6, "")], key=str)
    assert H.extract_main_text(pages(spark, rows).where("false")).count() == 0


def test_template_text_inside_articles_is_removed(spark):
    rng = random.Random(4)
    words = [" ".join(f"w{rng.randrange(10_000)}" for _ in range(9)) for _ in range(40)]
    body = lambda i: f"<h1>{words[i]}</h1><p>Written for readers of this site</p><p>{words[i + 20]} <b>x{i}</b>.</p><div>Keep in touch</div>"
    rows = [(i, "http://full.example/", article(body(i), i)) for i in range(10)]
    rows += [(i, "http://holes.example/", article(body(i), i)) for i in range(10, 20)]
    rows += [(20, "http://holes.example/", None), (21, "http://holes.example/", ""), (22, "http://holes.example/", " \n"), (23, "http://holes.example/", "<p>Not found</p>")]
    rows += [(i, "http://few.example/", article(body(i - 24), i)) for i in (24, 25)]
    got = {r.page_id: r.text for r in H.extract_main_text(pages(spark, rows)).collect()}
    for i in range(20):
        assert got[i] == f"{words[i]}\n{words[i + 20]} x{i}.", i
    assert [got[i] for i in (20, 21, 22, 23)] == ["", "", "", "Not found"]
    assert got[24] == f"{words[0]}\nWritten for readers of this site\n{words[20]} x0.\nKeep in touch"


def test_copies_of_a_page_are_no_evidence(spark):
    rows = [(i, "http://copies.example/", article(f"<h1>Same {i if i < 4 else 4}</h1><p>Text {i if i < 4 else 4}")) for i in range(60)]
    got = {r.page_id: r.text for r in H.extract_main_text(pages(spark, rows)).collect()}
    assert got[2] == "Same 2\nText 2" and got[50] == "Same 4\nText 4"
