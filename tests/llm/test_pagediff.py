import random

from hypothesis import given, settings, strategies as st

from duoscope.llm import pagediff as P

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice">We use cookies</div><!-- <p>hidden</p> --><script>var a = "</p><p>x";</script>
{open}<article class="post"><header><h2>{title}</h2></header><p>One &amp; two&nbsp;&#233;
 <b>bold</b><i>er</i> text<p>Second <a title="a>b" href=x>link</a>.<div class="ad-slot">Buy</div>
<ul><li>i</li><li>ii</ul><blockquote>Quote</blockquote><form><input><button>Go</button></form></article>
<aside>Side</aside><section id="comments"><article><p>First!</p></article></section><footer>&copy; me</footer></body></html>"""


def test_article_without_furniture():
    lines = P.lines_of(PAGE.format(title="Title &lt;3", open=""))
    assert P.main_text(lines, set()) == "Title <3\nOne & two é bolder text\nSecond link.\ni\nii\nQuote"


def test_broken_markup():
    for html, want in [("", ""), ("plain <b>text", "plain text"), ("<p>a<p>b</p></div>c", "a\nb\nc"), ("a < b <3 & c", "a < b <3 & c"),
                       ("<article><p>x<script>var y", "x"), ("<article><p>x <!-- never closed <p>y", "x"), ("<p>a<br>b", "a\nb"),
                       ('<p title="open>text', 'text'), ("<nav><p>m</nav><p>t", "t"), ("<p hidden>h</p><p style='display: none'>i</p>j", "j")]:
        assert P.main_text(P.lines_of(html), set()) == want, html


def test_pathological_pages_end():
    for html in ("<a \"" * 20000, "<" * 50000, "<p>" * 20000 + "x", "<!--" * 20000, "<b><i>" * 2000 + "y" + "</p>" * 5000):
        P.lines_of(html)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=9, unique=True), st.lists(st.sampled_from("abcde"), max_size=9, unique=True))
def test_shared_is_a_longest_common_subsequence(a, b):
    x, y = P.shared(a, b)
    assert [a[i] for i in sorted(x)] == [b[j] for j in sorted(y)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, p in enumerate(a):
        for j, q in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if p == q else max(best[i][j + 1], best[i + 1][j])
    assert len(x) == best[-1][-1]


def page(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, "y") for i, u, h in rows],
                                 "page_id long, url string, html string, text string, n int, host string")


def test_differencing_deletes_what_neighbours_share(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(300):            # one host holds most pages; no marked article
        host = "big.example" if i % 3 else f"h{i}.example"
        own = [f"w{rng.randrange(10**9)} story" for _ in range(3)]
        body = f"<div>Welcome to {host}</div><div>{own[0]}</div><p>{own[1]}</p><p>{own[2]}</p><div>Imprint</div>"
        rows.append((i, f"https://{host}/news/{i % 7}/{i}.html", f"<body>{body}</body>"))
        want[i] = "\n".join(own) if i % 3 else "\n".join([f"Welcome to {host}", *own, "Imprint"])
    got = {r.page_id: r for r in P.extract(page(spark, rows), part=16).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert got[1].n_template == 2 and got[0].n_template == 0


def test_copies_of_a_marked_article_stay(spark):
    html = "<body><div>Menu of site</div><article><p>Same story</p><p><a href=x>Read more</a></p></article></body>"
    rows = [(i, f"http://x.example/a/{i}", html) for i in range(3)] + [(None, None, None), (7, None, "<p>k"), (7, "no url", ""), (8, "http://x.example/a/0", html)]
    got = sorted((r.page_id is None, r.page_id or 0, r.url, r.text, r.n_chars) for r in P.extract(page(spark, rows)).collect() if r.url or r.page_id is None)
    assert [g[3] for g in got if g[1] in (0, 1, 2, 8) and not g[0]] == ["Same story"] * 4
    out = P.extract(page(spark, rows))
    assert out.count() == len(rows) and out.where("page_id = 7 AND url IS NULL").first().text == "k"
    assert P.extract(page(spark, rows).limit(0)).count() == 0


def whole_order(rows):
    """Each page against the page before and after it in the whole order."""
    texts = [[line for line, _, _ in P.lines_of(h)] for _, _, h in rows]
    found = [set() for _ in rows]
    for i in range(len(rows) - 1):
        a, b = P.shared(texts[i], texts[i + 1])
        found[i] |= a
        found[i + 1] |= b
    return sorted((r[0], "\n".join(t for j, t in enumerate(x) if j not in f)) for r, x, f in zip(rows, texts, found))


def test_neighbours_are_nearest_in_groups_of_any_size(spark):
    """One directory, one path with queries, and null URLs: the cuts change nothing."""
    many = [[(i, f"http://x.example/a/{i:04}", i) for i in range(150)], [(i, f"http://x.example/index.php?id={i:04}", i) for i in range(1000, 1150)],
            [(i, None, i) for i in range(2000, 2150)]]
    many = [[(i, u, f"<p>site</p><p>section {i // 10}</p><p>own {i}</p><p>with next {i // 2}</p>") for i, u, _ in g] for g in many]
    want = sorted(x for g in many for x in whole_order(g))
    rows = [r for g in many for r in g]
    random.Random(4).shuffle(rows)
    for part in (16, 1000):
        assert sorted((r.page_id, r.text) for r in P.extract(page(spark, rows), part=part).collect()) == want
    keys = spark.createDataFrame([("h", "/", "/i", u or "", i, 0) for i, u, _ in rows], "host string, near string, path string, at string, ident long, tie long")
    first, also, heavy = P.cuts(keys, 16)
    order = sorted(tuple(r) for r in keys.collect())
    at = [0, *map(order.index, first), len(order)]
    assert max(b - a for a, b in zip(at, at[1:])) <= 17 and not heavy
    assert also == {order[a - 1]: n + 1 for n, a in enumerate(at[1:-1])}


def test_equal_rows_beyond_a_run(spark):
    html = "<p>same</p><p>same too</p>"
    rows = [(None, None, html)] * 100 + [(1, None, "<p>same</p><p>mine</p>"), (2, "http://x.example/a/1", "<p>k</p>")]
    got = P.extract(page(spark, rows), part=8).collect()
    # copies keep their text; only what the page after them shares would go
    assert len(got) == 102 and [r.text for r in got if r.page_id is None] == ["same\nsame too"] * 100
    assert sorted(r.text for r in got if r.page_id) == ["k", "mine"]


STORY = "".join(f"<p>Paragraph {k} of the story tells what happened on day {k}.</p>" for k in range(6))
OTHER = "".join(f"<p>Note {k} on something else that was never told before.</p>" for k in range(6))
SITE = "<div>Welcome to the site</div>{}<div>Imprint and contact</div>"


def test_near_copies_lose_no_text(spark):
    """http and https, ?utm= twins, equal rows: compared with the next page that is none of them."""
    story = SITE.format(STORY)
    rows = [(i, u, story) for i, u in enumerate(["http://x.example/a/1", "https://x.example/a/1", "http://x.example/a/1?utm=feed",
                                                 "http://x.example/a/1#top"])]
    rows += [(10, "http://x.example/a/2", SITE.format(OTHER)), (11, "http://x.example/a/2?utm=feed", SITE.format(OTHER + "<p>Ad</p>"))]
    rows += [(20, "http://y.example/a/1", story), (21, "http://y.example/a/2", story)]
    rows += [(30, "http://z.example/a/1", story)] * 3
    lines = lambda html: [t for t, _, _ in P.lines_of(html)]
    for r in P.extract(page(spark, rows), part=2).collect():
        assert set(lines(OTHER if r.page_id in (10, 11) else STORY)) <= set(r.text.split("\n"))
    got = {}
    for r in P.extract(page(spark, rows)).collect():
        got.setdefault(r.page_id, set()).add(r.text)
    assert all(got[i] == {"\n".join(lines(STORY))} for i in range(4))
    assert got[10] == {"\n".join(lines(OTHER))} and got[11] == {"\n".join(lines(OTHER + "<p>Ad</p>"))}
    for i in (20, 21, 30):      # nothing but copies beside them
        assert got[i] == {"\n".join(lines(story))}


def test_template_goes_although_copies_lie_between(spark):
    rows = []
    for i in range(40):
        body = SITE.format("".join(f"<p>Own sentence {i} {k} of this very page.</p>" for k in range(5)))
        rows += [(10 * i + k, f"http://x.example/n/{i:03}{q}", body) for k, q in enumerate(["", "?a", "?b"])]
    for r in P.extract(page(spark, rows), part=1000).collect():
        assert r.text == "\n".join(f"Own sentence {r.page_id // 10} {k} of this very page." for k in range(5))
        assert r.n_template == 2


def test_all_of_many_copies_meet_the_page_after_them(spark):
    """1,500 near copies in a row: the first ones too lose what the next other page shares."""
    story = "<p>Only the next page has this line too.</p>" + STORY
    rows = [(i, f"http://x.example/a/1?v={i:05}", story) for i in range(1500)]
    rows.append((5000, "http://x.example/a/2", "<p>Only the next page has this line too.</p>" + OTHER))
    got = P.extract(page(spark, rows), part=4000).select("page_id", "text", "n_template").collect()
    want = "\n".join(t for t, _, _ in P.lines_of(STORY))
    assert len(got) == 1501
    assert {(r.text, r.n_template) for r in got if r.page_id < 5000} == {(want, 1)}
