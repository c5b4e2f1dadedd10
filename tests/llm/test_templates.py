"""Templates of a host's pages, within articles and without."""

from quarterbill.llm import dom, wrappers


def texts(spark, htmls, host="http://a.example"):
    rows = [(i, f"{host}/{i}", h) for i, h in enumerate(htmls)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return [r.text for r in wrappers.extract(table).orderBy("page_id").collect()]


def test_template_lines_go_from_articles_and_every_article_stays(shipped):
    page = (
        "<body><p>Top of all</p><article><h1>Title {0}</h1><p>Send this to a friend</p><p>Body <b>Note</b> {0}</p>"
        "Read us daily<p>own line {0}</p>tail {0}</article><div>between</div><article><p>Second part {0}</p><p>Longer notice that each page repeats</p></article>"
    )
    got = texts(shipped, [page.format(i) for i in range(6)])
    assert got == [f"Title {i}\nBody Note {i}\nown line {i}\ntail {i}\nSecond part {i}" for i in range(6)]


def test_copies_of_an_article_are_no_template(shipped):
    page = "<body><nav>{0}</nav><article><h1>Title {1}</h1><p>Same text {1}</p></article>"
    got = texts(shipped, [page.format(i, i // 9) for i in range(10)])
    assert got == [f"Title {i // 9}\nSame text {i // 9}" for i in range(10)]


def test_an_empty_article_does_not_hide_the_rest():
    assert wrappers.main_text("<article> </article><main><p>a</p></main><p>b") == "a"
    assert wrappers.main_text("<article></article><p>b") == "b"


def test_short_texts_lose_a_long_template_and_first_pages_of_other_kinds_do_no_harm(shipped):
    notice = "This long notice stands on every page of the host, above whatever the page is about. " * 5
    page = f"<body><div class=a><p>{notice}</p></div><div class=b><p>Short {{0}}</p></div><div class=c>About all of us</div>"
    other = "<body><section><h2>Listing {0}</h2><i>All of our listings are here</i></section>"
    htmls = ["", "<script>location='/x'</script>", other.format(0), "<body><table><tr><td>moved</table>"]
    htmls += [page.format(i) for i in range(6)] + [other.format(i) for i in range(1, 4)]
    got = texts(shipped, htmls)
    assert got == ["", "", "Listing 0", "moved", *(f"Short {i}" for i in range(6)), *(f"Listing {i}" for i in range(1, 4))]


def test_a_written_tree_is_read_back():
    shape = wrappers.Shape(dom.parse("<div class='b a'>x<p>1<p>2<u>é</u>3</div><div></div>y<p><i>z"))
    again = wrappers.Shape.read(shape.written())
    assert again.written() == shape.written() and again.layout() == shape.layout()
    assert list(wrappers.repeated(again, shape)) == [(x, True) for x, _ in wrappers.repeated(shape, shape)]


def test_marks_in_an_article_are_a_hint_only():
    body = (
        "<article><header><h2>Title</h2><p>Lead</p></header><p class='social-history'>Social history</p><p id='share-prices'>Prices</p>"
        "<div class='widgets'>About widgets, with <a href=/x>one link</a></div>"
        "<div class='related'><a href=/1>Other story</a> <a href=/2>And one more</a></div><div class='sidebar'>Aside</div>"
        "<div class='comment-list'>Nice post</div></article>"
    )
    want = "Title\nLead\nSocial history\nPrices\nAbout widgets, with one link"
    assert wrappers.main_text(body) == want
    assert wrappers.main_text(f"<form id=aspnetForm><input name=q>{body}</form>") == want
    assert wrappers.main_text("<form>Your name</form><div class='share-buttons'>Share</div><p>text") == "text"


def test_the_template_takes_marked_texts_that_repeat(shipped):
    """What the plain reader keeps of an article's marked parts goes where the host repeats it, and stays where it varies."""
    page = (
        "<body><article><h1>Title {0}</h1><p class='notice'>We changed our terms</p><p class='promo'>Offer of the day</p>"
        "<p class='social-history'>History {0}</p><p>Body {0}</p><div class='share'>Tell your friends</div></article>"
    )
    pages = [page.format(i) for i in range(12)]
    got = texts(shipped, pages)
    assert got == [f"Title {i}\nHistory {i}\nBody {i}" for i in range(12)]
    assert all(wrappers.main_text(p) != text for p, text in zip(pages, got))


def test_tree_matching_against_every_matching():
    """The size of the matching equals that of the best of all order-preserving ones, tried one by one."""
    import itertools
    import random

    def tree(rng, depth):
        inner = "".join(tree(rng, depth - 1) for _ in range(rng.randint(0, 3))) if depth else ""
        tag = rng.choice(("div", "section", "span"))
        return f"<{tag}>{inner}</{tag}>"

    def exhaustive(a, b):
        x, y = [r[0] for r in a.runs], [r[0] for r in b.runs]
        best = 0
        for n in range(min(len(x), len(y)) + 1):
            for i in itertools.combinations(x, n):
                for j in itertools.combinations(y, n):
                    if all(p.label == q.label for p, q in zip(i, j)):
                        best = max(best, sum(exhaustive(p, q) for p, q in zip(i, j)))
        return best + 1

    rng = random.Random(8)
    for _ in range(150):
        a, b = (wrappers.Shape(dom.parse(tree(rng, 3) + tree(rng, 3))) for _ in range(2))
        assert wrappers._matching(a, b, {})[0] == exhaustive(a, b)
