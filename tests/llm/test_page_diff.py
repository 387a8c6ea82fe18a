import random
import re
from html import unescape

import brute
import pytest

from ledgerline.llm import page_diff as P


@pytest.mark.parametrize("bits", [1 << 28, 8])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(P, "STATE_BITS", bits)
    rnd = random.Random(1)
    for _ in range(1500):
        a = [rnd.choice("abcd") for _ in range(rnd.randint(0, 12))]
        b = [rnd.choice("abcde") for _ in range(rnd.randint(0, 12))]
        shared = [x for x, s in zip(a, P.common(a, b), strict=True) if s]
        left = iter(b)
        assert len(shared) == brute.lcs(a, b) and all(x in left for x in shared)


def test_article_without_its_surroundings():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header class="site"><h1>Site</h1></header>
    <nav><ul><li>a</ul></nav><div id="cookieNotice">We use cookies</div><!-- <p>no</p> --><article><header><h1>Ti&amp;tle &eacute;</h1></header>
    <p><b>One<br><p>two  \n &#116;hree<div class="ad-box">buy</div><aside>side</aside><ul><li>i1<li>i2</ul><script>var x="</p>";</script>
    <form><label>mail</label><input></form><blockquote>q &lt;b&gt;</blockquote><section class="comments"><p>first!</p></section>
    <p hidden>h</p><p>a<span class="ad">b</span>c</p></article><div class="sidebar"><p>s</p></div><footer>&copy; f</footer></body></html>"""
    lines, is_open = P.candidate_lines(html)
    assert lines == ["Ti&tle é", "One", "two three", "i1", "i2", "q <b>", "ac"] and not is_open


def test_pages_without_structure(spark):
    top, foot = "<div>Home</div><div>Prices</div>", "<div>Imprint</div>"
    own = lambda k: f"{top}<div>text {k}</div><p>more of {k}</p>{foot}"
    rows = [(i, f"https://h{i % 2}.example.org/a/{i}", own(i)) for i in range(8)]
    rows += [(20, "http://h0.example.org/a/0?x=1", own(0)), (20, "http://h0.example.org/a/0?x=1", own(0)), (21, None, None), (22, "bad", "<p>x"), (23, "http://solo.example.org/", ""),
             (24, "http://solo2.example.org/", own("z")), (None, "http://solo3.example.org/x", "<p>" + "long " * 50000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS row", "2 AS lines", "3 AS open")
    got = P.main_text(df).collect()
    assert len(got) == len(rows)
    text = {r["id"]: r["text"] for r in got}
    for k in range(8):
        assert text[k] == f"text {k}\nmore of {k}"
    assert text[20] == "text 0\nmore of 0" and text[21] == "" and text[22] == "x" and text[23] == ""
    assert text[24] == "Home\nPrices\ntext z\nmore of z\nImprint"  # no neighbour to differ from
    assert text[None] == " ".join(["long"] * 50000)
    assert P.main_text(df.limit(0)).count() == 0


def test_given_pages(spark, sf_dir):
    """On the given pages the article element is the truth."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["id"]: r["text"] for r in P.main_text(pages).collect()}
    for r in pages.collect():
        inner = r["html"][r["html"].index("<article>") + 9:r["html"].index("</article>")]
        parts = (" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inner.replace("<br>", " ")))
        assert got[r["page_id"]] == "\n".join(x for x in parts if x)


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["id"]: r["text"] for r in P.main_text(df).collect()}


def test_template_inside_articles(spark):
    """Unmarked lists go; a passage that some neighbours quote, or all at another place, stays."""
    share = "<ul><li>Send to a friend</li><li>More of this</li></ul>"
    quote = lambda i: "<p>a quoted passage</p>" if i in (3, 4) else ""
    motto = lambda i: "<p>motto</p>" if i == 2 else "<h2>motto</h2>"
    rows = [(i, f"http://h.example.org/a/{i}", f"<article><h1>title {i}</h1>{quote(i)}{motto(i)}<p>text {i}</p>{share}</article>") for i in range(8)]
    rows += [(20 + i, f"http://m.example.org/a/{i}", f"<main><div>Home</div><p>text {i}</p></main>") for i in range(5)]
    rows += [(40 + i, f"http://two.example.org/a/{i}", f"<article><p>same</p><p>text {i}</p></article>") for i in range(2)]
    got = texts(spark, rows)
    assert got[3] == "title 3\na quoted passage\nmotto\ntext 3" and got[2] == "title 2\nmotto\ntext 2"
    assert all("friend" not in got[i] and "More" not in got[i] and f"text {i}" in got[i] for i in range(8))
    assert [got[20 + i] for i in range(5)] == [f"text {i}" for i in range(5)]
    assert got[40] == "same\ntext 0"  # one neighbour is not several


def test_partners_beyond_copies(spark):
    """Equal pages under many addresses, and pages that hold another one whole, don't hide the template."""
    page = lambda *own: "<div>Home</div><div>Prices</div>" + "".join(f"<p>{x}</p>" for x in own) + "<div>Imprint</div>"
    rows = [(100 * k + i, f"http://h.example.org/a/{k}/print/{i}?s={i}", page(f"text {k}", f"more of {k}")) for k in range(3) for i in range(20)]
    log = [f"entry {k}" for k in range(30)]
    rows += [(1000 + k, f"http://log.example.org/a/{k:02}", page(*log[:k + 1])) for k in range(30)] + [(2000, "http://log.example.org/z", page("last"))]
    got = texts(spark, rows)
    assert all(got[100 * k + i] == f"text {k}\nmore of {k}" for k in range(3) for i in range(20))
    assert got[1000] == "entry 0" and got[2000] == "last"


def test_a_heavy_template_is_no_copy(spark):
    menu = "".join(f"<div>menu entry number {k:03} of the whole site</div>" for k in range(40))
    rows = [(i, f"http://h.example.org/a/{i}", f"{menu}<p>t{i}</p>") for i in range(6)]
    rows += [(10 + i, f"http://two.example.org/a/{i}", f"{menu}<p>t{i}</p>") for i in range(2)]
    body = "".join(f"<p>sentence {k} of a copied text</p>" for k in range(20))
    rows += [(20 + i, f"http://h.example.org/a/c{i}", f"{menu}{body}<p>edit {i}</p>") for i in range(2)]
    got = texts(spark, rows)
    assert all(got[i] == f"t{i}" for i in range(6)) and got[10] == "t0" and got[11] == "t1"
    for i in range(2):  # an edited copy of one page is none of its template
        assert got[20 + i].split("\n") == [f"sentence {k} of a copied text" for k in range(20)] + [f"edit {i}"]


def test_a_form_or_a_telling_class_costs_no_article_text():
    """A form around the page is no form; inside an article a class counts by its whole name."""
    assert P.candidate_lines('<form id="aspnetForm"><input><article><p>The whole story.</p></article></form>')[0] == ["The whole story."]
    assert P.candidate_lines("<form><p>mail</p></form><article><form><p>vote</p></form><p>x</p></article>")[0] == ["x"]
    html = ('<article><div class="related-work"><p>a</p></div><p class="social-policy">b</p><div class="share-buttons">c</div>'
            '<div class="ad-box lead">d</div><div id="commentList">e</div></article>')
    assert P.candidate_lines(html)[0] == ["a", "b"]


@pytest.mark.parametrize("html", ["<a " * 700_000, "<div>x" * 300_000, "<b>" * 300_000 + "</i>" * 300_000, ">" + "<a " * 600_000, "<form>" * 300_000,
                                  "<p>" + "<span class='ad'>" * 100_000, "<li>x" * 400_000])
def test_two_megabytes_of_tags_are_read_in_seconds(html):
    from time import process_time
    start = process_time()
    P.placed_blocks(html)
    assert process_time() - start < 15


def plain(pages):
    """``main_text`` by comparing every page with its nearest ones in order, without any pruning: {id: text}."""
    from urllib.parse import urlsplit
    seen = {}
    for i, url, html in pages:
        found = P.placed_blocks(html)
        inner = max((p for _, p, _ in found), default=0)
        seen[i] = (urlsplit(url).hostname, urlsplit(url).path, found, inner)
    out = {}
    for host in {h for h, *_ in seen.values()}:
        first = {}
        for i, (h, path, found, inner) in sorted(seen.items(), key=lambda x: (x[1][1], x[0])):
            if h == host and any(p >= inner for _, p, _ in found):
                first.setdefault((not inner, *[x for x, p, _ in found if p >= inner]), i)
        order = sorted(first.values(), key=lambda i: (seen[i][1], i))
        hold = {}
        for i in order:
            for x in {x for x, _, _ in seen[i][2]}:
                hold.setdefault(x, set()).add(i)
        drops = {}
        for g, i in enumerate(order):
            _, path, found, inner = seen[i]
            mine = [(x, at) for x, p, at in found if p >= inner]
            need, good, nearest, width = 1 if not inner else P.SEVERAL, [], 1, P.REACH
            while len(good) < need:
                near = [(k, order[k]) for d in range(nearest, nearest + width) for k in (g - d, g + d) if 0 <= k < len(order)]
                if not near:
                    break

                def rank(k):
                    a, b = path.split("/"), seen[order[k]][1].split("/")
                    same = next((n for n, (u, v) in enumerate(zip(a, b)) if u != v), min(len(a), len(b)))
                    return (nearest, -same, len(a) + len(b), k)

                for k, other in sorted(near, key=lambda x: rank(x[0])):
                    theirs = [(x, at) for x, _, at in seen[other][2]]
                    shared = P._shared([x for x, _ in mine], [x for x, _ in theirs])
                    one, two = ({x for x, s in hold.items() if len(s) == n} for n in (1, 2))
                    if not P.is_copy([x for x, _ in mine], shared, [len(x) for x, _ in mine], one, two, len(order) == 2):
                        good.append(P._shared(mine, theirs) if inner else shared)
                nearest, width = nearest + width, 2 * width
            good = good[:P.SEVERAL]
            drops[i] = (good[0] if not inner else [all(v) for v in zip(*good)]) if len(good) >= need else [False] * len(mine)
        for i, (h, _, found, inner) in seen.items():
            if h == host:
                lines = [x for x, p, _ in found if p >= inner]
                own = first.get((not inner, *lines))
                out[i] = "\n".join(x for x, d in zip(lines, drops[own], strict=True) if not d) if own is not None else ""
    return out


def test_equals_the_unpruned_search_on_small_hosts(spark):
    rnd, rows = random.Random(5), []
    for host in range(12):
        style = rnd.choice(["<article>{}</article>", "<main>{}</main>", "{}"])
        menu = [f"<div>menu {rnd.randrange(4)}</div>" for _ in range(rnd.randint(0, 3))]
        for k in range(rnd.randint(1, 12)):
            own = [rnd.choice([f"<p>text {host} {rnd.randrange(25)}</p>", f"<li>quote {rnd.randrange(3)}</li>", "<h2>more</h2>"]) for _ in range(rnd.randint(0, 5))]
            body = style.format("".join((menu if rnd.random() < .8 else []) + own + ["<div>foot</div>"] * (rnd.random() < .7)))
            rows.append((len(rows), f"http://h{host}.example.org/{rnd.choice('ab')}/{rnd.choice('xy')}/{k}", body))
    got = texts(spark, rows)
    want = plain(rows)
    assert got == want
    assert any(want[i] != "\n".join(P.candidate_lines(h)[0]) for i, _, h in rows)


def test_parsed_pages_are_staged_small(spark, monkeypatch):
    """The table of all texts is written with zstd and has its content keys as 16 bytes."""
    seen, own = {}, P.stage_table
    monkeypatch.setattr(P, "stage_table", lambda df, name, **o: seen.setdefault(name, (df, o)) and own(df, name, **o))
    df = spark.createDataFrame([(1, "http://a.com/x", "<p>one</p><p>two</p>")], "page_id long, url string, html string")
    assert [r.text for r in P.main_text(df).collect()] == ["one\ntwo"]
    lines, options = seen["lines"]
    assert options == {"compression": "zstd"} and {len(r.key) for r in lines.select("key").collect()} == {16}
