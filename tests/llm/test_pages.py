"""Pages and vectors against brute force."""

import gzip
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterbill.llm import ann, dom, warc, wrappers

PAGES = "page_id long, url string, html string, digest string, file string"


@pytest.fixture(scope="module")
def pages(shipped):
    def page(title, body, extra=""):
        return (
            f"<html><head><title>{title}</title><script>var a='<p>no</p>'</script></head><body><nav><a href=/>Home</a></nav>"
            f"<div class=top>Daily Site</div><div class=text><h1>{title}</h1><p>{body}<p>More &amp; {body}<br>end</div>{extra}"
            "<div id='comments'>nice post</div><footer>&copy; us</footer></body></html>"
        )

    rows = [(i, f"http://Site.example/{i}", page(f"Title {i}", f"Body {i} text"), "d", "f") for i in range(6)]
    rows += [
        (10, "https://other.example/a?x#y", "<article><h1>A</h1>x\n y<ul><li>1<li>2</ul><aside>no</aside></article><p>out", "d", "f"),
        (11, "https://other.example/b", None, None, None),
        (12, None, "", None, None),
        (13, "no url", "<p>only <b>this<p>and <!-- not > --> that", None, None),
        (None, "http://x.example/é b", rows[0][2], None, None),
        (20, "http://dup.example", rows[1][2], None, None),
        (21, "http://dup.example", rows[1][2], None, None),
    ]
    return shipped.createDataFrame(rows, PAGES).repartition(3, "page_id")


def test_archives_give_back_what_was_written(pages):
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    want = []
    for page, data in rows:
        first = min((p for p, d in rows if d == data and p is not None), default=None)
        again = len(data) >= 100 and first is not None and page != first
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    got = warc.round_trip(pages).collect()
    assert sorted(map(repr, want)) == sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
    assert {r.url for r in got} == {r.url for r in pages.collect()}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_selected_records_only(pages, shipped):
    folder = warc.new_folder(shipped, "warc")
    index = warc.write(pages, folder)
    got = warc.read(index, folder, F.col("page_id").isin(3, 10)).collect()
    assert {r.page_id: bytes(r.payload) for r in got} == {r.page_id: r.html.encode() for r in pages.where("page_id in (3, 10)").collect()}


def test_reading_tasks_grow_with_the_bytes(shipped, monkeypatch):
    monkeypatch.setattr(warc, "TASK_BYTES", 20_000)
    monkeypatch.setattr(warc, "MOST_RANGE", 2_000)
    random = np.random.default_rng(5)
    used = []
    for n in (300, 1200):
        rows = [(i, f"http://a.example/{i}", random.bytes(400).hex()) for i in range(n)]
        folder = warc.new_folder(shipped, "warc")
        index = warc.write(shipped.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
        assert index.select("file").distinct().count() == 1
        read = warc.read(index, folder)
        counts = [r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(counts) == n and max(counts) < n / 4
        used.append(read.rdd.getNumPartitions())
    assert used[1] >= 2 * used[0] - 1


def test_revisits_name_the_record_they_refer_to(shipped):
    html = "<p>" + "same " * 40
    rows = [(5, "http://b.example/x y", html), (3, "http://a.example/z", html), (3, None, html), (None, "http://c.example", html)]
    folder = warc.new_folder(shipped, "warc")
    index = warc.write(shipped.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
    store, path = warc._store(folder)
    heads = []
    for r in index.collect():
        with store.open_input_file(f"{path}/{r.file}") as file:
            data = gzip.decompress(file.read_at(r.length, r.offset))
        heads.append(dict(line.split(": ", 1) for line in data.split(b"\r\n\r\n")[0].decode().split("\r\n")[1:]))
    responses = {h["WARC-Record-ID"]: h for h in heads if h["WARC-Type"] == "response"}
    revisits = [h for h in heads if h["WARC-Type"] == "revisit"]
    assert len(responses) == 2 and len(revisits) == 2
    for h in revisits:  # of the two rows of the smallest id, the one without a URL
        assert "WARC-Target-URI" not in responses[h["WARC-Refers-To"]] and "WARC-Refers-To-Target-URI" not in h
    one = [r for r in rows if r[1]]
    roles = warc.with_roles(shipped.createDataFrame(one, "page_id long, url string, html string")).where("refers_to IS NOT NULL")
    assert {(r.refers_to, r.first_url) for r in roles.collect()} == {(3, "http://a.example/z")}
    head = warc.record(5, "http://b.example", None, "d", 9, 3, "http://a.example/z q").decode()
    assert "WARC-Refers-To-Target-URI: http://a.example/z%20q\r\nWARC-Refers-To-Date: 1970" in head


def test_ranges_join_neighbours():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 40, 5), ("b", 45, 5), ("b", 50, 100)]
    assert list(warc.ranges(iter(rows), gap=20, most=40)) == [
        ("a", 0, 15, [(0, 10), (10, 5)]), ("a", 40, 45, [(40, 5)]), ("b", 45, 50, [(45, 5)]), ("b", 50, 150, [(50, 100)]),
    ]


def test_main_text(pages):
    got = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    for i in (0, 2, 5):
        assert got[i] == f"Title {i}\nBody {i} text\nMore & Body {i} text end"
    assert got[10] == "A\nx y\n1\n2" and got[11] == got[12] == "" and got[13] == "only this\nand that"
    assert all(r.n_chars == len(r.text) for r in wrappers.extract(pages).collect())
    assert wrappers.extract(pages.limit(0)).count() == 0


def test_reader_and_alignment():
    root = dom.parse("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><p>x<div>y</p></div><script>if (a<b) '</p>'</SCRIPT >z")
    assert [n.tag for n in root.elements()] == ["#root", "ul", "li", "li", "ul", "li", "li", "p", "div", "p", "script"]
    assert dom.tidy(" a&nbsp;&lt;b&#33; &amp;lt; \n c ") == "a <b! &lt; c"
    a = wrappers.Shape(dom.parse("<div><p>same</p><i>one</i><p>x</p></div>"))
    b = wrappers.Shape(dom.parse("<div><p>same</p><u>new</u><i>two</i><p>y</p></div>"))
    assert sorted(same for _, same in wrappers.repeated(a, b)) == [False, False, True]
    assert dom.parse("<div>" * 3000 + "deep") and "deep" in wrappers.main_text("<div>" * 3000 + "deep")


def test_nearest(shipped):
    random = np.random.default_rng(2)
    x = random.standard_normal((600, 16)).astype(np.float32)
    x[100:130] = x[50]  # many copies of a query
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1), (950, [1.0, 2.0], 1), (None, x[0].tolist(), 1)]
    table = shipped.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = ann.search(table, F.col("vec_id") % 50 == 0).toPandas()
    x = x.astype(np.float64)
    hits = 0
    for q in range(0, 600, 50):
        score = x @ x[q] / np.linalg.norm(x, axis=1) / np.linalg.norm(x[q])
        best = sorted((-s, i) for i, s in enumerate(score) if i != q)[:5]
        part = got[got.query_id == q].sort_values("rank")
        assert part["rank"].tolist() == [1, 2, 3, 4, 5]
        assert np.allclose(part.score, [score[i] for i in part.vec_id], atol=1e-12)
        hits += len({i for _, i in best} & set(part.vec_id))
        if q == 50:
            assert part.vec_id.tolist() == [100, 101, 102, 103, 104]
    assert hits >= 0.9 * 60 and set(got.query_id) == set(range(0, 600, 50))
    assert ann.search(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_few_vectors_and_probe_order(shipped):
    table = shipped.createDataFrame([(i * 50, [float(i % 2) + 0.1, float(i)]) for i in range(3)], "vec_id long, embedding array<double>")
    assert ann.search(table, F.col("vec_id") % 50 == 0).count() == 6
    place = np.array([0.1, 0.45, 2.8])
    cells = ann.probes(place, 20)
    cost = lambda c: sum((p - np.floor(p)) ** 2 if d < 0 else (1 - p + np.floor(p)) ** 2 for p, d in zip(place, c - np.floor(place)) if d)
    costs = [cost(c) for c in cells]
    assert costs == sorted(costs) and len({tuple(c) for c in cells}) == 20


def test_rows_that_share_an_id(shipped):
    """Ten rows of one id, equal or near each other, hide no other id; the best pair counts."""
    random = np.random.default_rng(9)
    x = random.standard_normal((40, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(7, x[0].tolist())] * 10 + [(8, x[0].tolist()), (9, x[0].tolist())]
    rows += [(11, (x[0] + 0.01 * random.standard_normal(8)).tolist()) for _ in range(10)] + [(0, x[30].tolist())]
    table = shipped.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows]
    best: dict[int, float] = {}
    for q, v in unit:
        for i, u in unit:
            if q == 0 and i != 0:
                best[i] = max(best.get(i, -2.0), float(u @ v))
    got = ann.search(table, F.col("vec_id") == 0, k=6).orderBy("rank").collect()
    assert [r.rank for r in got] == [1, 2, 3, 4, 5, 6]
    assert {r.vec_id for r in got[:5]} == {7, 8, 9, 11, 30}
    assert all(abs(r.score - best[r.vec_id]) < 1e-12 for r in got)
