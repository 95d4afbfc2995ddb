import html
import random
import re

from millrace.llm.wrappers import Page, Places, Wrapper, extract_main_text, fold, infer, loosened, op5_main_text, wrappers_of


def accepts(pages):
    made = infer(pages)
    return lambda p: re.compile(made["pattern"]).fullmatch("".join(made["codes"].get(s, "?") for s in Page(p).symbols)) is not None


def test_groups_and_options_are_inferred():
    first = "<ul><li><b>a</b></li><li><b>b</b></li></ul><p>x</p>"
    second = "<ul><li><b>c</b></li></ul><i>new</i><p>y</p>"
    accept = accepts([first, second])
    assert accept(first) and accept(second)
    assert accept("<ul>" + "<li><b>q</b></li>" * 9 + "</ul><p>z</p>")
    assert not accept("<ul></ul><p>z</p>")
    assert fold(list("<abababc")) == ["<", ("+", ("a", "b")), "c"]


def test_all_sampled_pages_are_accepted():
    pick = random.Random(6)
    pages = []
    for _ in range(12):
        body = "".join(pick.choice(["<p>t</p>", "<p>t</p><p>u</p>", "<h2>h</h2><p>t</p>", "<ul><li>a<li>b</ul>"]) for _ in range(pick.randrange(1, 9)))
        pages.append(f"<html><body><nav><a href=x>m</a></nav><article>{body}</article>" + ("<footer>f</footer>" if pick.random() < 0.5 else "") + "</body>")
    wrapper = Wrapper([(e, 0) for e in fold(Page(pages[0]).symbols)])
    for page in pages[1:]:
        wrapper = wrapper.aligned(Page(page).symbols)
        codes = {}
        pattern = re.compile(wrapper.pattern(codes))
        assert pattern.fullmatch("".join(codes[s] for s in Page(page).symbols))


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p><p>no";</script></head>
<body class="has-sidebar"><header class=top><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><!-- <p>no</p> -->
<div class="ad banner">Buy</div><div id="cookie-notice">Cookies</div><form><p>Mail</p></form><aside><p>Side</p></aside>
<article><h1>{0}</h1><p>One <b>bo</b>ld
 {0} &eacute;&#33; a&nbsp;b<p>Two<br>lines<div class="share-buttons">Share</div><ul><li>x<li>y</ul><table><tr><td>c1<td>c2</table>
<noscript>no</noscript><div>Same on all pages</div></article>
<section class="comments"><article class="comment"><p>First!</p></article></section><footer>&copy; me</footer></body></html>"""
WANT = "{0}\nOne bold {0} é! a b\nTwo lines\nx\ny\nc1\nc2\nSame on all pages"


def test_what_is_left_out(spark):
    rows = [(i, f"https://User@Www.Site.example:80/{i}?q", PAGE.format(f"Title {i}"), 1) for i in range(6)]
    rows += [(20, None, None, 2), (21, "x", "", 3), (22, "http://other.example/", "no tags &amp; <text", 4), (23, None, "<p>a<p>b", 5), (None, rows[0][1], rows[0][2], 6),
             (1, *rows[1][1:]), (24, "http://long.example", "<article>" + "<p>w w</p>" * 20_000 + "</article>", 7)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = extract_main_text(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["url"] and "Site" in r["url"]:
            i = 0 if r["page_id"] is None else r["page_id"]
            assert r["text"] == WANT.format(f"Title {i}")
            assert r["matched"]
    texts = {r["page_id"]: r["text"] for r in got}
    assert (texts[20], texts[21], texts[22], texts[23]) == ("", "", "no tags & <text", "a\nb")
    assert texts[24] == "\n".join(["w w"] * 20_000)
    assert extract_main_text(frame.where("false")).count() == 0


def test_region_without_an_article():
    page = "<body><div class=menu>m m m</div><div class=top>t</div><div class=content><p>long text here {0}</p><p>and more of it</p></div><div>Legal</div></body>"
    made = infer([page.format(i) for i in range(5)])
    assert made["region"] == "/body/div" or made["region"] == "/body"
    assert [tuple(t) for t in made["template"]] == [("/body/div", "Legal"), ("/body/div", "m m m"), ("/body/div", "t")]


def test_given_pages_equal_a_plain_reading(spark):
    folder = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = op5_main_text(spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in re.split("</?p>|</?h1>|<br>", article))
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def texts_by_id(spark, pages):
    frame = spark.createDataFrame([(i, "http://one.example/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    rows = extract_main_text(frame).collect()
    assert len(rows) == len(pages)
    assert all(r["matched"] for r in rows)
    return {r["page_id"]: r["text"] for r in rows}


def test_every_page_of_a_host_has_a_wrapper(spark):
    # Forty layouts, most of them on one page only, and a second template without an article.
    pages = [f"<body><div class=top>Site</div><article><h1>t {i}</h1>{''.join(f'<{x}>w {i}</{x}>' for x in f'{i:06b}'.replace('0', 'p').replace('1', 'u'))}"
             "</article></body>" for i in range(40)]
    second = [f"<html><body><table><tr><td><span>left {i}</span></td></tr></table><section><pre>long words of the page numbered {i}</pre></section></body></html>"
              for i in range(3)]
    got = texts_by_id(spark, pages + second)
    for i in range(40):
        assert got[i].replace("\n", "").replace(" ", "") == f"t{i}" + f"w{i}" * 6
    assert all(f"long words of the page numbered {i}" in got[40 + i] for i in range(3))


def test_constants_are_told_by_their_place_on_all_pages(spark):
    # "Legal" stands in front of every text and is once an author's own word, in the slot.
    page = "<body><div><div>Legal</div><hr><div>{0}</div></div></body>"
    got = texts_by_id(spark, [page.format(t) for t in ["Legal", *(f"some words that differ {i}" for i in range(30))]])
    assert got[0] == "Legal"
    assert all(got[i + 1] == f"some words that differ {i}" for i in range(30))
    # A text that one page of many lacks is still the template's.
    page = "<body><div>{1}<div>{0}</div></div></body>"
    got = texts_by_id(spark, [page.format(f"some words that differ {i}", "" if i == 7 else "<section>Legal</section>") for i in range(12)])
    assert all(got[i] == f"some words that differ {i}" for i in range(12))


def test_copies_and_headings_are_not_the_templates(spark):
    body = "<article><div>The whole body set in a div</div>and bare text<br>after it<section>and a section</section></article>"
    copies = texts_by_id(spark, [f"<body><div class=ad>{i}</div>{body}<div class=comments>c {i}</div></body>" for i in range(15)])
    assert set(copies.values()) == {"The whole body set in a div\nand bare text after it\nand a section"}
    page = ("<body><article><h1>Title {0}</h1><table><tr><th>Size<td>{0}</table><dl><dt>Term<dd>Same</dl><figure><figcaption>Photo</figcaption></figure>"
            "<section>Summary</section>bare</article></body>")
    got = texts_by_id(spark, [page.format(i) for i in range(8)])
    assert got[3] == "Title 3\nSize\n3\nTerm\nSame\nPhoto\nSummary\nbare"


def test_constants_and_marked_names_inside_the_article_stay(spark):
    page = ("<body><nav>m</nav><article><div class=post-header><h1>Dish {0}</h1></div><div>Ingredients</div><p>flour {0}</p><div>Method</div><p>stir {0} times</p>"
            "<p class=response-text>Answer {0}</p><div class='related-work'>Chapter {0}</div><div class=ad>Buy {0}</div><div class='share-buttons'>Share</div>"
            "<div class=comments><p>First {0}</p></div></article></body>")
    got = texts_by_id(spark, [page.format(i) for i in range(8)])
    for i, text in got.items():
        assert text == f"Dish {i}\nIngredients\nflour {i}\nMethod\nstir {i} times\nAnswer {i}\nChapter {i}"


def test_a_marked_name_does_not_hide_most_of_a_page(spark):
    page = "<body><div class=menu>Menu</div><div>x</div><div id=search-results-study><p>a long study of things, number {0}</p><div class=ad>buy {0}</div></div></body>"
    got = texts_by_id(spark, [page.format(i) for i in range(6)])
    assert all(f"a long study of things, number {i}" in got[i] and "Menu" not in got[i] and "buy" not in got[i] for i in got)


def test_long_pages_of_a_template_have_few_wrappers(spark):
    pick = random.Random(8)
    blocks = ["<p>{0}</p>", "<h2>{0}</h2>", "<ul><li>{0}</li><li>{0}</li></ul>", "<p>{0} <b>{0}</b></p>", "<pre>{0}</pre>", "<blockquote><p>{0}</p></blockquote>"]
    pages, want = [], []
    for i in range(120):
        body = [pick.choice(blocks) for _ in range(pick.choice((5, 100, 400)))]
        pages.append("<html><body><nav><a>m</a></nav><article>" + "".join(b.format(f"w{i}") for b in body) + "</article><footer>f</footer></body></html>")
        want.append("\n".join("\n".join([f"w{i}"] * 2) if "<ul>" in b else f"w{i} w{i}" if "<b>" in b else f"w{i}" for b in body))
    frame = spark.createDataFrame([("h", p) for p in pages], "host string, html string")
    made = wrappers_of(frame).first()["wrappers"]
    assert len(made) <= 4 and max(map(len, made)) < 20_000
    assert [t for _, t in sorted(texts_by_id(spark, pages).items())] == want


def test_helper_names_may_be_taken(spark):
    frame = spark.createDataFrame([(1, "http://a.example/", "<article><p>x</p></article>", "h", "w", "k", "m")],
                                  "page_id long, url string, html string, host string, wrappers string, known string, host_ string")
    row = extract_main_text(frame).first()
    assert (row["text"], row["host"], row["wrappers"], row["known"], row["host_"]) == ("x", "h", "w", "k", "m")


def test_loosened_runs_accept_any_order():
    shape = loosened(["<article>", *["<p>", "#", "</p>", "<hr>", "<h2>", "#", "</h2>"] * 3, "</article>", "</div>"], 4)
    assert shape[0] == "<article>" and shape[1][0] == "*" and shape[2:] == ["</article>", "</div>"]
    reader = Places([(e, 0) for e in shape])
    assert reader.read(["<article>", "<h2>", "#", "</h2>", "<hr>", "<hr>", "<p>", "#", "</p>", "</article>", "</div>"]) is not None
    assert reader.read(["<article>", "</article>", "</div>"]) is not None
    assert reader.read(["<article>", "<p>", "</p>", "</article>", "</div>"]) is None
