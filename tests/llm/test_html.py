import time

from prepspark.llm.html_text import Page, extract_text, host_paths

HEAD = "<!DOCTYPE html><html><head><title>t</title><style>p{x:'</p>'}</style><script>var a='<p>no</p>';</script></head><body>"


def text_of(html):
    page = Page(html)
    node = page.best()
    return page.text(node) if node >= 0 else ""


def test_boilerplate_is_left_out():
    html = (
        HEAD + "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></ul></nav><div class='cookie-notice'>We use</div>"
        "<div class='ad'>Buy</div><article><h1>Title &amp; more</h1><p>One <b>bold</b>\n  two&nbsp;three.<p>Second<br>line"
        "<!-- hidden --><form><p>Name</p></form><aside>More</aside><ul><li>first<li>second</ul>"
        "<section class='comments'><p>Nice post</p></section><p hidden>not shown</p></article><footer>&copy; x</footer>"
    )
    assert text_of(html) == "Title & more\nOne bold two three.\nSecond line\nfirst\nsecond"


def test_broken_pages():
    assert text_of(HEAD + "<article><p><b>One.<br><p>Two &am") == "One.\nTwo &am"
    assert text_of(HEAD + "<article><p>One</p></i></p><p>a < b <p cla") == "One\na < b"
    assert text_of("<article><p>x<script>never ends <p>y") == "x"
    assert text_of('<article><p title="a > b">x</p><p title=it\'s>y</p></article>') == "x\ny"
    assert text_of("") == "" and text_of("<p>") == "" and text_of("no markup") == "no markup"


def test_tables_and_containers_without_article():
    html = "<body><div id='menu'><a>x</a></div><div class='page c9'><h1>T</h1><div class='t'><p>Long enough text, here.</p><p>More of it.</p></div></div></body>"
    assert text_of(html) == "T\nLong enough text, here.\nMore of it."
    assert text_of("<body><table><tr><td>a b c<td>d<tr><td>e</table></body>") == "a b c\nd\ne"


def test_path_of_the_host_wins(spark):
    page = "<body><div class='post-{0}'><p>{1}</p></div><div class='extra'><p>{2}</p></div></body>"
    rows = [(i, f"http://h.example/{i}", page.format(i, "body text " * 5, "x")) for i in range(5)]
    rows.append((9, "http://h.example/9", page.format(9, "short", "a much longer piece beside it " * 9)))
    rows.append((10, "http://h.example/10", "<body><main><p>other layout</p></main></body>"))
    rows.append((11, "https://user@H.example:8080/z", page.format(1, "upper host", "")))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    best = host_paths(frame).collect()
    assert [(r.host, r.path, r.pages) for r in best] == [("h.example", "body>div.post-N", 8)]
    found = {r.page_id: r.text for r in extract_text(frame).collect()}
    assert found[9] == "short" and found[10] == "other layout" and found[11] == "upper host"


def test_odd_rows(spark):
    rows = [(1, None, None), (None, None, "<p>a</p>"), (2, "x", ""), (2, "x", ""), (3, "http://h/", "<p>" + "w\t " * 50_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'y' AS host", "1 AS path", "2 AS text", "3 AS id")
    found = sorted(((str(r.page_id), r.url, r.text, r.n_chars) for r in extract_text(frame).collect()), key=str)
    long = " ".join(["w"] * 50_000)
    assert found == sorted([("1", None, "", 0), ("None", None, "a", 1), ("2", "x", "", 0), ("2", "x", "", 0), ("3", "http://h/", long, len(long))], key=str)
    assert extract_text(frame.where("false")).count() == 0


def test_words_are_evidence_only():
    body = "<p>A long enough text of the article itself.</p>"
    for outer in ("content with-sidebar", "site has-menu", "sidebar-layout"):
        html = f"<body><div class='{outer}'><div class='post'>{body}</div><div class='sidebar'><p>beside</p></div></div></body>"
        assert text_of(html) == "A long enough text of the article itself."
    html = f"<article>{body}<h2 id='related-work'>Related work</h2><section id='search-and-rescue'><h2>Search and rescue</h2><p>x<math><mi>y</mi></math></p></section></article>"
    assert text_of(html) == "A long enough text of the article itself.\nRelated work\nSearch and rescue\nxy"
    assert text_of(f"<article>{body}</article><div class='comments'><p>{'many words ' * 50}</p></div>") == "A long enough text of the article itself."


def test_containers_beside_the_best_one():
    html = "<body><div class='page'><div class='a'><div class='b'><p>{}</p></div></div><div class='c'><p>{}</p></div></div><div class='d'><p>x</p></div></body>"
    assert text_of(html.format("one two " * 9, "three " * 5)) == ("one two " * 9).strip() + "\n" + ("three " * 5).strip()


def test_names_count_as_a_whole():
    body = "<p>A long enough text of the article itself.</p>"
    inner = "<div class='share-price'><p>Up by two.</p></div><div class='notice-board-history'><p>Since 1900.</p></div>"
    dropped = "<div class='share-buttons'><p>Tell</p></div><div class='discussion'><p>Nice post</p></div><div id='comments-list'><p>Me too</p></div>"
    assert text_of(f"<article>{body}{inner}{dropped}</article>") == "A long enough text of the article itself.\nUp by two.\nSince 1900."


def test_title_and_lead_before_the_container():
    html = "<body><h1>Title</h1><p>The lead.</p><div class='content'><p>Text of the page, which is long enough to be found.</p></div><p>after</p></body>"
    assert text_of(html) == "Title\nThe lead.\nText of the page, which is long enough to be found."
    html = "<body><p>Lead.</p><div class='a'>{}</div><div class='b'>{}</div></body>"
    assert text_of(html.format("<p>One sentence.</p>" * 5, "<p>One sentence.</p>" * 4)) == "\n".join(["Lead."] + ["One sentence."] * 9)


def test_many_marked_elements_are_read_once():
    began = time.time()
    html = "<body>" + "<div class='sidebar'><p>x y</p>" * 2000 + "<p>the text of the page</p>" + "</div>" * 2000
    assert text_of(html).startswith("x y")
    assert text_of("<article><p>kept</p></article>" + html) == "kept"
    assert time.time() - began < 1.5
