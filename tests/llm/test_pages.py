import gzip
import html.parser
import io

import pytest

from lodestack.llm import html_text as h
from lodestack.llm import warc
from lodestack.llm.registry import LISTED_HOSTS, URL_RULES
from lodestack.llm.url_filter import Rule, build, cascades, host_list, judge

from .conftest import multiset

URLS = ["http://a.example.com/en/7x?q", "HTTPS://M.Free-Bets.example.NET/en/27#top", "https://x.example.net/de/8", "https://x.example.net/de/9", "http://org/es/", "http://EXAMPLE.com", "http://example.com/en/", "http://notexample.com/en/70", "http://xcom/en/1", "no scheme", None, "", "a://b://c/d", "http://?x", "http://casino-win.example.org#f", "http://É.com/en/1", "x\n://h.com/en/\nz"]


def brute_host(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    k = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:k])
    path = rest[k:]
    return host, path[: min([path.index(c) for c in "?#" if c in path] or [len(path)])]


def brute_judge(url):
    host, path = brute_host(url)
    best = None
    for verdict, rule in URL_RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith(f".{name}")) and path.startswith(f"/{start}") and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    listed = [k for k in LISTED_HOSTS if host == k or host.endswith(f".{k}")]
    return host, path, best and best[1], best[0] if best else "block" if listed else "allow", listed[0] if listed else None


def test_urls(spark):
    frame = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate([*URLS, URLS[0]])] + [(None, URLS[1], None, None)], "page_id long, url string, host string, verdict string")
    got = judge(frame, [Rule(*r) for r in URL_RULES], host_list(spark, [*LISTED_HOSTS, LISTED_HOSTS[0], None]))
    want = [(r.page_id, *brute_judge(r.url)) for r in frame.collect()]
    assert multiset(map(tuple, got.collect())) == multiset(want)
    none = judge(frame.limit(0), [], host_list(spark, []))
    assert none.count() == 0
    assert {r.verdict for r in judge(frame, [], host_list(spark, [])).collect()} == {"allow"}


def test_long_lists_are_worked_off_in_parts(spark):
    """With filters of at most 256 bits, a list of 150 hosts needs several parts; the verdicts are the same."""
    hosts = [f"{'sub.' * (i % 3)}h{i}.{'com' if i % 2 else 'co.uk'}" for i in range(900)]
    listed = [f"h{i}.{'com' if i % 2 else 'co.uk'}" for i in range(0, 900, 6)] + [None, "uk2"]
    pages = spark.createDataFrame([(i, f"https://{h}/x") for i, h in enumerate(hosts)] + [(900, None), (901, "no host")], "page_id long, url string")
    keys = spark.createDataFrame([(h,) for h in listed], "key string")
    want = multiset(map(tuple, judge(pages, [], keys).collect()))
    assert multiset(map(tuple, judge(pages, [], keys, most_bits=256).collect())) == want
    assert sum(r[4] == "block" for r in judge(pages, [], keys).collect()) == 150
    assert len(list(cascades(pages.selectExpr("concat('h', page_id, '.com') as key"), keys, 256))) > 1


def test_cascade_is_exact_over_its_universe(spark):
    import numpy as np

    universe = spark.range(20_000).selectExpr("concat('k', id) as key")
    listed = universe.where("cast(substr(key, 2) as int) % 20 = 3")
    cascade = build(universe, listed)
    assert len(cascade.levels) > 2 and cascade.size_bytes < 100_000
    rows = universe.selectExpr("key", "xxhash64(key) as low", "xxhash64('second', key) as high").toPandas()
    hit = cascade.listed(rows.low.to_numpy(), rows.high.to_numpy())
    assert (hit == (rows.key.str[1:].astype(int) % 20 == 3).to_numpy()).all()
    assert isinstance(hit, np.ndarray)


# HTML

CASES = [
    ("<body><nav>menu</nav><article><h1>T &amp; t</h1><p>One\n two<p>Three <b>x</b>y</article><footer>f</footer>", "T & t\n\nOne two\n\nThree xy"),
    ("<div class='post-12'><p>Text of the article, long enough.</p><div class=ad>buy</div><form>x<input></form></div><div id=comments><p>first!</p></div>", "Text of the article, long enough."),
    ("<body><script>var t='</p><article>'</script><style>p{}</style><article><p>A<br>B<!-- c --><p hidden>no</article>", "A B"),
    ("<article><p>caf&eacute; &#233;&#x1F642; &nosuch; a < b", "café é🙂 &nosuch; a < b"),
    ("plain text only", "plain text only"),
    ("<ul><li>a<li>b</ul>", "a\n\nb"),
    ("<article><header><h1>Own</h1></header><p>Body of text</p><aside>side</aside></article><header>site</header>", "Own\n\nBody of text"),
    ("<p><b>Bold.<br><p>Next</p>", "Bold.\n\nNext"),
    ("<article><p title=\"a>b\">q</p><p class='x>y'>r</p><p title=\"open>s</article>", "q\n\nr\n\ns"),
    ("", ""),
    ("<!-- never closed <p>x", ""),
    ("<article><p>x<script>never closed", "x"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_main_text(page, text):
    assert h.main_text(page, None) == text


BODY = "words of the long body " * 30
WHOLE = [
    ("<article><h1>Title</h1><p>lead</p><div class=body><p>{0}</p></div></article>", "Title\n\nlead\n\n{0}"),
    ("<div class=post><h1>Title</h1><div class=body><p>{0}</p></div></div>", "Title\n\n{0}"),
    ("<div class=post><div class=head><h1>Title</h1></div><div class=body><p>{0}</p></div></div>", "Title\n\n{0}"),
    ("<article><p>lead</p><ul><li>{0}<li>b</ul><p>end</p></article>", "lead\n\n{0}\n\nb\n\nend"),
    ("<div><p>lead</p><blockquote>{0}</blockquote></div>", "lead\n\n{0}"),
    ("<div><p>lead</p><table><tr><td>{0}</td></tr><tr><td>b</td></tr></table></div>", "lead\n\n{0}\n\nb"),
    ("<div><section><p>one</p></section><section><p>{0}</p></section></div>", "one\n\n{0}"),
    ("<div><div class=intro><p>lead</p></div><ul><li>{0}</ul></div>", "lead\n\n{0}"),
    ("<main>lead<div><p>{0}</p></div></main><div><p>beside</p></div>", "lead\n\n{0}"),
    ("<div class=top><h1><a href=/>Site</a></h1></div><div class=body><p>{0}</p></div><div class=end><p>all rights</p></div>", "{0}"),
]


@pytest.mark.parametrize(("page", "text"), WHOLE)
def test_the_article_is_kept_whole(spark, page, text):
    page, text = (x.format(BODY.strip()) for x in (f"<body>{page}</body>", text))
    assert h.main_text(page, None) == text
    frame = spark.createDataFrame([(i, f"http://h.com/{i}", page) for i in range(3)], "page_id long, url string, html string")
    assert {r.text for r in h.extract(frame).collect()} == {text}


SIGNED = [
    ("<div class='site-content has-sidebar'><article><h1>T</h1><p>{0}</p></article><div class=sidebar>side</div></div>", "T\n\n{0}"),
    ("<div class='no-comments'><p>{0}</p></div><p class=share>Share</p>", "{0}"),
    ("<article class='related-topic'><p>{0}</p></article>", "{0}"),
    ("<span class=widget>{0}</span>", "{0}"),
    ("<article><p title='the hidden lake' data-x=hidden data-class='ad'>{0}</p></article>", "{0}"),
    ("<article><p hidden=''>no</p><p aria-hidden=true>no</p><p>{0}</p></article>", "{0}"),
    ("<div class=promo><p>one</p></div><div class=promo><p>two</p></div><div class=promo><p>six</p></div>", "one\n\ntwo\n\nsix"),
    ("<div class='has-sidebar'><article><p>{0}</p></article><div id=comments><p>{0}</p><p>{0}</p></div></div>", "{0}"),
    ("<article><p>{0}</p></article><div id=comments><p>{0}</p><p>{0}</p></div>", "{0}"),
]


@pytest.mark.parametrize(("page", "text"), SIGNED)
def test_signs_never_discard_most_of_a_page(page, text):
    page, text = (x.format(BODY.strip()) for x in (f"<body>{page}</body>", text))
    assert h.main_text(page, None) == text


WRAPPERS = [
    "<div class='content no-sidebar'>{0}</div>", "<div class='container has-sidebar'>{0}</div>", "<div class='post comments-enabled'>{0}</div>", "<div class='wrapper right-sidebar'>{0}</div>", "<div class='search-results'>{0}</div>",
    "<form action=x>{0}</form>", "<form id=f class=search><div class='main-nav-layout'><div class=page>{0}</div></div></form>", "<div class='overlay'><div class='content no-comments'><div id='ads-free'>{0}</div></div></div>", "<main class='menu-open'>{0}</main>",
]
BESIDES = "<nav><a href=a>home</a></nav>{0}<aside><p>side</p></aside><div class=sidebar><p>links and more</p></div><form class=login><label>Name</label><input><button>Go</button> sign in</form><div class=comments><p>reader says bla</p></div>"


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("all_inside", [False, True])
def test_wrappers_with_signs(wrapper, all_inside):
    """Signs and forms around the article, or around all that the page shows."""
    article = f"<h1>T</h1><p>{BODY.strip()}</p><p>{BODY.strip()}</p>"
    page = wrapper.format(BESIDES.format(article)) if all_inside else BESIDES.format(wrapper.format(article))
    assert h.main_text(f"<body>{page}<footer>end</footer></body>", None) == "\n\n".join(["T", BODY.strip(), BODY.strip()])


def test_beside_the_article_far_below():
    deep = "<div>" * 700
    page = f"{deep}<p>{BODY}</p><nav>menu <b>more</b></nav><div class=sidebar><p>side</p></div><p>end</p>{'</div>' * 700}"
    assert h.main_text(page, None) == f"{BODY.strip()}\n\nend"


def test_long_and_deep_pages():
    assert h.main_text("<div>" * 3000 + "deep" + "</div>" * 3000, None) == "deep"
    assert h.main_text("<div class='a b'>" * 100_000 + "deep", None) == "deep"
    assert len(h.parse("<div>x" * 2000)[1]) == 2000
    assert len(h.main_text("<article>" + "<p>word " * 20_000, None).split("\n\n")) == 20_000
    for page in ("<" * 50_000, "<a " + "x" * 100_000, "<p title='" + "a" * 100_000, "&" * 50_000):
        h.main_text(page, None)


def test_hosts_vote(spark):
    """One page has more text beside the article than in it; its host's other pages tell where the article is."""
    good = "<body><div class='story n{0}'><p>{1}</p></div><div class='misc'><p>tiny</p></div>"
    rows = [(i, f"http://h.com/{i}", good.format(i, "a long article text " * 10)) for i in range(5)]
    rows.append((9, "http://h.com/9", "<body><div class='story n9'><p>short</p></div><div class='misc'><p>" + "other text " * 30 + "</p></div>"))
    rows += [(10, None, "<p>alone</p>"), (11, "http://h.com/x", None), (12, "http://h.com/y", ""), (9, "http://h.com/9", rows[-1][2])]
    frame = spark.createDataFrame([(*r, "p", 1) for r in rows], "page_id long, url string, html string, path string, host int")
    got = {r.page_id: r.text for r in h.extract(frame).collect()}
    assert got[9] == "short" and got[10] == "alone" and got[11] == got[12] == ""
    assert h.extract(frame).count() == 10 and h.extract(frame.limit(0)).count() == 0
    assert all(r.n_chars == len(r.text) for r in h.extract(frame).collect())


def test_real_pages(pages):
    import html
    import re

    got = {r.page_id: r.text for r in h.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|<footer|$)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split("</?p>|</?h1>", body)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


# WARC


def test_warc_round_trip():
    source = warc.response((0, 1), "http://x.com/a\r\nb", "<title>T</title><p>é &amp; x</p><script>no</script>".encode())
    data = warc.member(warc.serialise(source)) + b"".join(warc.member(warc.serialise(r)) for r in warc.derive(source))
    back = list(warc.read(io.BytesIO(data)))
    assert back[0] == source and gzip.decompress(data).startswith(b"WARC/1.1\r\n")
    meta, text = back[1:]
    assert source.get("warc-target-uri") == "http://x.com/a%0D%0Ab"
    assert meta.get("WARC-Refers-To") == text.get("WARC-Refers-To") == source.get("WARC-Record-ID")
    assert text.block.decode() == "é & x" and text.get("WARC-Block-Digest") == warc.digest(text.block)
    assert text.get("WARC-Source-Payload-Digest") == source.get("WARC-Payload-Digest")
    fields = dict(x.split(": ", 1) for x in meta.block.decode().strip().split("\r\n"))
    assert fields["title"] == "T" and fields["http-header-content-type"] == "text/html; charset=utf-8" and fields["source-payload-digest"] == source.get("WARC-Payload-Digest")
    for broken in (data[:-1], data[: len(data) // 2]):
        with pytest.raises(warc.Malformed):
            list(warc.read(io.BytesIO(broken)))
    with pytest.raises(warc.Malformed):
        warc.parse(warc.serialise(source).replace(b"no</script>", b"NO</script>"))


def test_source_headers_are_kept():
    source = warc.response((0, 1), "http://x.com/", b"<p>a</p>")
    more = [("WARC-IP-Address", "192.0.2.7"), ("WARC-Concurrent-To", "<urn:a>"), ("WARC-Concurrent-To", "<urn:b>"), ("WARC-Warcinfo-ID", "<urn:w>"), ("X-Crawl", "7: b")]
    meta, text = warc.derive(warc.Record([*source.headers, *more], source.block))
    assert [h for h in meta.headers if h in more] == more[:4] and [h for h in text.headers if h in more] == more[3:4]
    lines = meta.block.decode().split("\r\n")
    assert [x for x in lines if x.startswith("warc-header-")] == ["warc-header-warc-ip-address: 192.0.2.7", "warc-header-warc-concurrent-to: <urn:a>", "warc-header-warc-concurrent-to: <urn:b>", "warc-header-warc-warcinfo-id: <urn:w>", "warc-header-x-crawl: 7: b"]


class Shown(html.parser.HTMLParser):
    """The text that a page shows, block by block."""

    blocks = frozenset("address article aside blockquote body br center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section select table tbody td th thead tr ul".split())
    hidden = frozenset("script style noscript template iframe title head".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.depth = [], 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.hidden
        self.parts += ["\0"] * (tag in self.blocks) + [" "] * (tag in self.hidden)

    def handle_endtag(self, tag):
        self.depth -= tag in self.hidden
        self.parts += ["\0"] * (tag in self.blocks)

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


def test_derivatives_of_real_pages(spark, pages):
    """Every page's text, and the digests of text and payload, against a parser of the standard library."""
    got = {r.page_id: r for r in warc.derivatives(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        parser = Shown()
        parser.feed(r.html)
        parser.close()
        text = "\n".join(x for x in (" ".join(b.split()) for b in "".join(parser.parts).split("\0")) if x)
        found = got[r.page_id]
        assert found.n_chars == len(text) and found.text_digest == warc.digest(text.encode()), r.page_id
        assert found.linked and found.url == r.url and found.payload_digest == warc.digest(r.html.encode())


def test_derivatives(spark):
    rows = [(1, "http://a/", "<p>one</p>"), (1, "http://a/", "<p>one</p>"), (2, None, None), (None, "x", ""), (5, "u", "<p>" + "long " * 60_000)]
    frame = spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, key string")
    got = warc.derivatives(frame).collect()
    assert multiset((r.page_id, r.url, r.n_chars) for r in got) == multiset([(1, "http://a/", 3), (1, "http://a/", 3), (2, None, 0), (None, "x", 0), (5, "u", 299_999)])
    assert all(r.linked for r in got)
    assert len({x for r in got for x in (r.response_id, r.metadata_id, r.conversion_id)}) == 15
    assert warc.derivatives(frame.limit(0)).count() == 0
