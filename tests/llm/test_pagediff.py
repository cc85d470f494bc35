"""Main text by page differencing: the parser, the alignment, and neighbours across partitions."""

import random

import pytest

from orderlens.llm import pagediff
from orderlens.llm.markup import lines_of


def kept(page):
    lines = lines_of(page)
    return " ".join(lines[n].text for n, _ in pagediff.article_lines(lines))


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain &lt;text&gt; a < b &amp c &nbsp; d", "plain <text> a < b & c d"),
        ("<p>one<p>two<br>three</p>four", "one two three four"),
        ("<p>in<b>li</b>ne <i>tags</i></p>", "inline tags"),
        ("<script>var t='</p>';if(a<b){}</script><style>p{}</style><!-- <p>no</p> --><p>yes", "yes"),
        ("<title>no</title><nav>menu</nav><article><h1>T</h1><p>text</p></article><footer>end", "T text"),
        ("<nav><ul><li>a<li>b</ul><article><p>text</article>tail</nav>", "text"),
        ("<div class='wrap sidebar-left'><main><p>text</p><aside>no</aside></main></div><p>outside", "text"),
        ("<article><header><h1>T</h1></header><p>text</p><form><input><p>sign up</p></form><div id=comments><p>nice</p></div></article>", "T text"),
        ("<article>text</article><article class='comment'>no</article><aside><article>teaser</article></aside>", "text"),
        ("<div class='cookieNotice'>ok?</div><p>text</p><div class=\"ad-slot\">buy</div><div class=has-ads>more</div>", "text more"),
        ("<p>a <span hidden>no</span> b <span class='ad'>no</span> c", "a b c"),
        ("<p class=ad>no<p>yes", "yes"),
        ("<ul><li class=ad>no<li>yes</ul>", "yes"),
        ("<article><p>cut off &am", "cut off &am"),
        ("<article><p>cut off</p><a hre", "cut off"),
        ("<p title='a > b' data-x=\"</p>\">text</p>", "text"),
        ("<textarea>no</textarea><select><option>no</select><button>no</button>yes", "yes"),
        ("</div></p>stray<table><tr><td>a<td>b<tr><td>c</table>", "stray a b c"),
    ],
)
def test_markup(page, text):
    assert kept(page) == text


def test_deep_and_broken_markup_takes_linear_time():
    assert kept("<div>" * 50_000 + "text" + "</p>" * 50_000) == "text"
    assert kept("<a \"" * 20_000 + "text") in ("", "text")
    assert kept("<!-- " * 50_000) == ""
    assert kept("<b>" * 50_000 + "x" + "</div>" * 50_000) == "x"


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_alignment_is_a_longest_one():
    rng = random.Random(3)
    for letters in (2, 5, 60):
        for _ in range(150):
            a, b = ([rng.randrange(letters) for _ in range(rng.randrange(40))] for _ in range(2))
            pairs = pagediff.aligned(a, b)
            assert all(a[i] == b[j] for i, j in pairs)
            assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
            assert len(pairs) == lcs_length(a, b)
    long = pagediff.aligned([n % 7 for n in range(5000)], [n % 5 for n in range(5000)])
    assert len(long) > 2000


def place(url):
    return pagediff.place_of(url)


def test_places():
    assert place("http://User@Example.org:80/a/b/?q=1#x") == ("example.org:80", "a\x01b")
    assert place("//h/x") == ("h", "x") and place("https://h") == ("h", "") and place("https://h?x=/y") == ("h", "")
    assert place(None) is place("") is place("no url") is None


MENU = "<div>Home</div><div>All topics</div>"
END = "<div>Imprint of this house</div>"


def site(n, words=("sun", "moon", "star", "sea", "wind")):
    rng = random.Random(n)
    text = "".join(f"<p>{' '.join(rng.choice(words) + str(rng.randrange(999)) for _ in range(rng.randint(3, 9)))} {n}</p>" for _ in range(4))
    return text, f"<html><body>{MENU}{text}<div>Read more of this</div>{END}</body></html>"


def rows_of(df):
    return sorted(((r.page_id, r.url, r.text, r.n_chars, r.n_lines, r.n_marked, r.n_shared) for r in df.collect()), key=str)


SCHEMA = "page_id long, url string, html string, digest string, shared string, text string"


def extracted(spark, rows, partitions=None):
    df = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return rows_of(pagediff.main_text(df))


def test_lines_of_the_site_go(spark):
    pages = [(n, f"http://{'ab'[n % 2]}.org/{n % 3}/{n}", site(n)[1]) for n in range(40)]
    want = sorted(
        ((i, u, kept(site(i)[0]), len(kept(site(i)[0])), 8, 0, 4) for i, u, _ in pages),
        key=str,
    )
    for partitions in (1, 3, 25, 200):  # neighbours in one partition, and nearly all across borders
        assert extracted(spark, pages, partitions) == want


def test_copies_articles_and_odd_rows(spark):
    own = "<article><h1>One</h1><p>A line that both hold</p><p><a href=x>Share this</a></p><p>own 1</p></article>"
    other = "<article><h1>Two</h1><p>A line that both hold</p><p><a href=x>Share this</a></p><p>own 2</p></article>"
    pages = [
        (1, "http://c.org/1", site(1)[1]), (2, "http://c.org/2", site(1)[1]), (2, "http://c.org/2", site(1)[1]),
        (3, "http://c.org/3", site(1)[1].replace("Read more of this", "Read it")),
        (4, "http://d.org/1", own), (5, "http://d.org/2", other),
        (6, None, site(2)[1]), (7, "odd", site(2)[1]), (8, "http://e.org/", None), (9, "http://e.org/x", ""), (None, "http://f.org", site(3)[1]),
    ]
    got = {r[0]: (r[2], r[6]) for r in extracted(spark, pages)}
    whole = kept(site(1)[1])
    assert got[1] == got[2] == (whole, 0)  # copies, and a page that differs in one line, tell nothing
    assert got[3] == (whole.replace("Read more of this", "Read it"), 0)
    assert got[4] == ("One A line that both hold own 1", 1) and got[5] == ("Two A line that both hold own 2", 1)
    assert got[6] == got[7] == (kept(site(2)[1]), 0)
    assert got[8] == got[9] == ("", 0) and got[None] == (kept(site(3)[1]), 0)
    assert len(extracted(spark, pages)) == len(pages)


def test_very_long_page_and_empty_table(spark):
    body = "".join(f"<p>line {n % 5000} of the page</p>" for n in range(20_000))
    pages = [(n, f"http://l.org/{n}", f"{MENU}{body if n else body[: len(body) // 3]}<p>own {n}</p>") for n in range(2)]
    got = extracted(spark, pages)
    assert len(got) == 2 and all(f"own {r[0]}" in r[2] for r in got)
    assert extracted(spark, []) == []
