import random
import time

import pytest

from registrylake.llm import wrapper as wr

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>no";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Home</a></li><li>{r}</li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy {r}</div><div id="cookie-notice">We use cookies</div>
<{box}><h1>Title {i}</h1><p>First   paragraph {i} &amp; more<br>next <b>bold</b>ly {r}.<p>Second {i}&#233;</p>
<p>Read more on our site</p><ul><li>item {i}</li><li>other {r}</li></ul><form><input name="q"><button>Go</button>ask</form>
<div class="comments"><p>reader says {r}</p></div></{box}>
<aside>side {r}</aside><footer>&copy; host {r}</footer></body></html>"""


def page(i, box="article", seed=0):
    r = random.Random(seed * 1000 + i)
    return PAGE.format(i=i, r=f"w{r.randrange(10**6)}", box=box)


def want(i, seed=0):
    r = random.Random(seed * 1000 + i)
    w = f"w{r.randrange(10**6)}"
    return f"Title {i} First paragraph {i} & more next boldly {w}. Second {i}é item {i} other {w}"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, host string").repartition(3)


@pytest.mark.parametrize("ship", [wr.SHIP_BYTES, 0])
@pytest.mark.parametrize("box", ["article", "main", "div"])
def test_main_text(spark, box, ship):
    rows = [(i, f"https://Example.org:80/{i}?x=1", page(i, box)) for i in range(30)]
    got = {r.page_id: r for r in wr.main_texts(frame(spark, rows), ship).collect()}
    assert len(got) == 30
    for i in range(30):
        assert got[i].text == want(i) and got[i].n_chars == len(want(i)) and got[i].host == "example.org"


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "no url", ""), (3, "http://a/", "plain a < b &am"), (4, "http://a/x", "<article><p>cut <b>off in a <i>ta"), (4, "http://a/x", "<article><p>cut <b>off in a <i>ta"), (5, "http://a/y", "<article>" + "<p>x</p>" * 5000 + "</article>"), (None, "http://a/z", "<div hidden>no</div><p>yes"), (8, "http://a/deep", "<article>" + "<div>" * 20000 + "deep" + "</div>" * 20000 + "<p>end</p></article>"), (6, "http://a/q", "<article><p title=\"a>b\">t</p><a class='share'>no</a><span>in</span>side")]
    got = {}
    for r in wr.main_texts(frame(spark, rows)).collect():
        got.setdefault(r.page_id, r.text)
    assert got == {1: "", 2: "", 3: "plain a < b &am", 4: "cut off in a ta", 5: " ".join("x" * 5000), None: "yes", 8: "deep end", 6: "t inside"}


def test_copies_keep_their_text(spark):
    rows = [(i, "http://copies.example/", "<article><h1>Same</h1><p>The same text</p></article>") for i in range(20)]
    assert {r.text for r in wr.main_texts(frame(spark, rows)).collect()} == {"Same The same text"}


def test_empty_table(spark):
    assert wr.main_texts(frame(spark, [])).collect() == []


def test_matching_is_the_largest_in_order():
    def tree(spec):
        return wr.Template(spec[0], 1, [tree(k) for k in spec[1:]])

    def brute(a, b):
        if not a or not b:
            return 0
        best = max(brute(a[1:], b), brute(a, b[1:]))
        if a[0].sig == b[0].sig:
            best = max(best, 1 + brute(a[0].kids, b[0].kids) + brute(a[1:], b[1:]))
        return best

    r = random.Random(3)

    def any_tree(depth):
        return (r.choice("abc"), *(any_tree(depth - 1) for _ in range(r.randrange(0, 4 if depth else 1))))

    for _ in range(200):
        a, b = tree(("r", *(any_tree(2) for _ in range(r.randrange(5))))), tree(("r", *(any_tree(2) for _ in range(r.randrange(5)))))
        size, pairs = wr.matching(a.kids, b.kids)
        assert size == brute(a.kids, b.kids) == sum(1 + brute(a.kids[i].kids, b.kids[j].kids) for i, j in pairs)
        assert pairs == sorted(pairs) and [j for _, j in pairs] == sorted({j for _, j in pairs}) and all(a.kids[i].sig == b.kids[j].sig for i, j in pairs)


def test_templates_survive_their_file():
    t = wr.as_template(wr.Group("#", [wr.parse(page(1))]))
    again = wr.Template.load(t.dump())
    assert [(x.sig, x.pages, len(x.kids), x.shape, x.size) for x in t.nodes()] == [(x.sig, x.pages, len(x.kids), x.shape, x.size) for x in again.nodes()]


def alternating(n, k):
    return "<div>" + "".join(f"<h2>part {i} {k}</h2><p>text {i} {k}</p>" + ("<ul><li>x</li></ul>" if (i * k) % 7 == 3 else "") for i in range(n)) + "</div>"


def test_long_alternating_siblings_merge_fast():
    a, b = (wr.as_template(wr.Group("#", [wr.parse(alternating(1600, k))])) for k in (1, 2))
    began = time.time()
    wr.merge(a, b)
    assert time.time() - began < 1.5
    known = wr.loaded(a.dump(), None, None, 2)
    assert wr.extract(alternating(1600, 2), known).split()[:3] == ["part", "0", "2"] and len(wr.extract(alternating(1600, 2), known).split()) == 1600 * 6 + sum((2 * i) % 7 == 3 for i in range(1600))


NEUTRAL = "<body><div class='q1'><div>Start</div><div>All parts</div></div><div class='q2'><div class='q3'>Title {i}</div><div class='q4'>Own text {i}</div><div class='q4'>As ever</div><div class='q4'>More {i}</div></div><div class='q5'>Made by hand</div></body>"


def test_the_template_decides_where_names_are_neutral(spark):
    rows = [(i, "http://plain.example/", NEUTRAL.format(i=i)) for i in range(9)]
    for r in wr.main_texts(frame(spark, rows)).collect():
        assert r.text == f"Title {r.page_id} Own text {r.page_id} More {r.page_id}"
        assert wr.extract(NEUTRAL.format(i=r.page_id), None) == f"Start All parts Title {r.page_id} Own text {r.page_id} As ever More {r.page_id} Made by hand"


def test_two_pages_are_enough_outside_an_article(spark):
    rows = [(i, "http://two.example/", NEUTRAL.format(i=i)) for i in range(2)]
    assert {r.text for r in wr.main_texts(frame(spark, rows)).collect()} == {f"Title {i} Own text {i} More {i}" for i in range(2)}
    rows = [(i, "http://near.example/", f"<div>Frame</div><article><h1>Same</h1><p>Nearly the same</p><p>but for {i}</p></article>") for i in range(2)]
    assert {r.text for r in wr.main_texts(frame(spark, rows)).collect()} == {f"Same Nearly the same but for {i}" for i in range(2)}


@pytest.mark.parametrize("ship", [wr.SHIP_BYTES, 0])
def test_against_exact_counts_of_texts_by_place(spark, ship):
    """Brute force: on pages whose blocks all have names of their own, a text is template if 70 % of the differing pages have it in its block."""
    r = random.Random(11)
    rows, want = [], {}
    for host in range(4):
        kinds = [(f"k{chr(97 + b)}x", r.choice(["fixed", "own", "some"])) for b in range(8)] + [("last", "own")]
        pages = []
        for i in range(12):
            blocks = []
            for name, kind in kinds:
                if name != "last" and r.random() < 0.15:
                    continue
                blocks.append((name, f"{name} constant" if kind == "fixed" or (kind == "some" and r.random() < 0.5) else f"{name} own {host} {i}"))
            pages.append(blocks)
        pages += pages[:3]  # copies count once
        differing = {tuple(p) for p in pages}
        share = {x: sum(x in p for p in differing) / len(differing) for p in differing for x in p}
        for n, blocks in enumerate(pages):
            rows.append((host * 100 + n, f"http://h{host}.example/", "<body>" + "".join(f"<div class='{k}'><p>{t}</p></div>" for k, t in blocks) + "</body>"))
            want[host * 100 + n] = " ".join(t for k, t in blocks if share[k, t] < wr.SHARE)
    assert {r.page_id: r.text for r in wr.main_texts(frame(spark, rows), ship).collect()} == want


def test_rare_nodes_are_forgotten_and_frequent_ones_kept(spark):
    rows = [(i, "http://wild.example/", f"<div class='q'><p>Frame</p></div><div class='w{chr(97 + i % 26)}{chr(97 + i // 26)}'><p>own {i}</p></div>") for i in range(300)]
    frame_ = frame(spark, rows).select("host", "html").repartition(1)
    (made,) = wr.induce(frame_).collect()
    assert wr.Template.load(made.template).size < 40
    assert {r.page_id: r.text for r in wr.main_texts(frame(spark, rows)).collect()} == {i: f"own {i}" for i in range(300)}


def test_clashing_columns(spark):
    rows = spark.createDataFrame([(i, "http://c.example/", NEUTRAL.format(i=i), "t", "x", 1, 2) for i in range(6)], "page_id long, url string, html string, text string, template string, pages int, fixed int")
    assert {r.text for r in wr.main_texts(rows).collect()} == {f"Title {i} Own text {i} More {i}" for i in range(6)}


@pytest.mark.parametrize("page, text", [
    ("<body class='has-sidebar header-fixed'><div class='content-sidebar-wrap'><article class='post'>yes</article><div class='sidebar'>no</div></div></body>", "yes"),
    ("<form id=f><div>no</div><article>yes</article></form>", "yes"),
    ("<article>a long enough main text<section id='comments'><article>short no</article></section></article>", "a long enough main text"),
    ("<article>main text here</article><div class='comments'><article class='c'>as long as that</article></div>", "main text here"),
    ("<main class='with-nav'><p>yes</p><nav>no</nav></main>", "yes"),
    ("<article class='comment'>no</article><article>yes</article>", "yes"),
    ("<nav><article>no</article></nav><article>yes</article>", "yes"),
    ("<div class='no-header'><p>yes</p></div>", "yes"),
    ("<article><header><h2>no</h2></header><p>one</p>two<p>three&nbsp;four", "one two three four"),
])
def test_frames_and_names(page, text):
    assert wr.extract(page, None) == text


@pytest.mark.parametrize("ship", [wr.SHIP_BYTES, 0])
def test_constant_texts_among_many_at_one_node(spark, ship):
    menu = "".join(f"<li>entry {k}</li>" for k in range(45))
    rows = [(i, "http://long.example/", f"<article><ul>{menu}</ul>" + "".join(f"<p>own {i} {k}</p>" for k in range(40)) + "<p>Constant notice</p></article>") for i in range(20)]
    for r in wr.main_texts(frame(spark, rows), ship).collect():
        assert r.text == " ".join(f"own {r.page_id} {k}" for k in range(40))


@pytest.mark.parametrize("same", [True, False])
def test_copies_of_a_longer_article_keep_it(spark, same):
    rows = [(i, "http://big.example/", f"<article><h1>Title {i}</h1><p>Own {i}</p></article>") for i in range(30)]
    long = "<article><h1>Long</h1><p>Lead {}</p><h2>Part</h2><p>More</p><ul><li>a</li><li>b</li></ul></article>"
    rows += [(100 + i, "http://big.example/", long.format(0 if same else i)) for i in range(6 if same else 10)]
    got = {r.page_id: r.text for r in wr.main_texts(frame(spark, rows)).collect()}
    assert all(got[i] == f"Title {i} Own {i}" for i in range(30))
    assert all(t == f"Long Lead {0 if same else i - 100} Part More a b" for i, t in got.items() if i >= 100)


def test_copies_count_once(spark):
    rows = [(i, "http://most.example/", f"<article><p>Notice</p><p>Own {i}</p></article>") for i in range(10)]
    rows += [(100 + i, "http://most.example/", "<article><p>Notice</p><p>Copied</p><h2>Text</h2></article>") for i in range(90)]
    got = {r.page_id: r.text for r in wr.main_texts(frame(spark, rows)).collect()}
    assert got == {i: f"Own {i}" for i in range(10)} | {100 + i: "Copied Text" for i in range(90)}


@pytest.mark.parametrize("page, text", [
    ("<article>" + "long " * 50 + "</article><article>short</article>", "long " * 50 + "short"),
    ("<main>" + "long " * 50 + "</main><main>short</main>", "long " * 50 + "short"),
    ("<div><h1>Head</h1></div><div>Lead</div><div>" + "<p>long</p>" * 50 + "</div><div class='share'>no</div><div>Last</div>", "Head Lead " + "long " * 50 + "Last"),
])
def test_no_text_is_left_out_for_its_size(page, text):
    assert wr.extract(page, None) == text


def varying(i, kind):
    """A page whose menu, advert and footer carry other words on every page; ``kind`` ``div``: all blocks are plain div elements."""
    r = random.Random(i)
    words = lambda n: " ".join(f"w{r.randrange(10**5)}" for _ in range(n))
    head, para, item = ("div", "div", "div") if kind == "div" else ("h1", "p", "li")
    title, paras = words(4), [words(r.randrange(20, 90)) for _ in range(1 + i % 5)]
    menu = "".join(f"<{item}><a href='/{k}'>{words(1)}</a></{item}>" for k in range(6))
    page = f"<body><div><div>{menu}</div></div>" + (f"<div>{words(9)}</div>" if i % 9 else "")
    page += f"<div><{head}>{title}</{head}>" + "".join(f"<{para}>{p}</{para}>" for p in paras) + f"</div><div>&copy; {words(8)}</div></body>"
    return page, " ".join([title, *paras])


@pytest.mark.parametrize("ship", [wr.SHIP_BYTES, 0])
@pytest.mark.parametrize("kind", ["div", "p"])
def test_the_template_decides_where_boilerplate_varies_and_has_no_name(spark, kind, ship):
    pages = [varying(i, kind) for i in range(60)]
    got = {r.page_id: r.text for r in wr.main_texts(frame(spark, [(i, f"http://v{i % 3}.example/", p) for i, (p, _) in enumerate(pages)]), ship).collect()}
    assert got == {i: t for i, (_, t) in enumerate(pages)}
    assert all(wr.extract(p, None) != t for p, t in pages)


@pytest.mark.parametrize("n, own", [(2, False), (2, True), (4, True), (12, True)])
def test_near_copies_are_told_by_what_pages_have_of_their_own(spark, n, own):
    """Two pages that share most of an article are near copies; pages of one host with a notice inside articles of their own are not, however few they are."""
    notice = "Notice of this house"
    text = lambda i: f"Text {i} of this page alone, with more words than the notice has {i}" if own else f"But for {i}"
    rows = [(i, "http://n.example/", f"<article><h1>{'Title ' + str(i) if own else 'Same'}</h1><p>{text(i)}</p><p>{notice}</p></article>") for i in range(n)]
    want = {i: f"Title {i} {text(i)}" if own else f"Same {text(i)} {notice}" for i in range(n)}
    assert {r.page_id: r.text for r in wr.main_texts(frame(spark, rows)).collect()} == want


def test_partial_templates_are_folded_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(wr, "FAN_IN", 4)
    rows = [(i, "http://hot.example/", varying(i, "p")[0]) for i in range(90)]
    (made,) = wr.induce(frame(spark, rows).select("host", "html").repartition(18)).collect()
    monkeypatch.undo()
    (once,) = wr.induce(frame(spark, rows).select("host", "html").repartition(1)).collect()
    folded, whole = wr.Template.load(made.template), wr.Template.load(once.template)
    assert folded.pages == whole.pages == 90
    assert [(t.sig, t.pages) for t in folded.nodes() if t.pages > 60] == [(t.sig, t.pages) for t in whole.nodes() if t.pages > 60]


def test_named_comments_are_no_content_root(spark):
    rows = [(i, "http://talk.example/", f"<body><div class='text'><h1>Title {i}</h1><p>own {i}</p></div><div class='comments'>" + "".join(f"<p>reader {i} {k} says very much</p>" for k in range(2 + i % 4)) + "</div></body>") for i in range(12)]
    assert {r.page_id: r.text for r in wr.main_texts(frame(spark, rows)).collect()} == {i: f"Title {i} own {i}" for i in range(12)}
