import pytest
from pyspark.sql import functions as F

from tapemill.llm.html_extraction import extract_text, main_text

LONG = "A paragraph that is long enough to stand out from what surrounds it on the page."


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("just text", "just text"),
        ("<article><h1>T</h1><p>a&amp;b<br>c</p><p> x \n y&nbsp;z</p></article><footer>f</footer>", "T\n\na&b c\n\nx y z"),
        ("<nav><ul><li><a href=x>menu</a></li></ul></nav><div class='ad'>buy</div><article><p>b</p></article>", "b"),
        ("<nav>left open<article><p>b</p></article>", "b"),
        ("<article><p>a</p><p>b &am", "a\n\nb &am"),
        ("<article><p>a</p><!-- never closed <p>b</p>", "a"),
        ("<article><p>a</p><script>var t='</p>';</script><style>p{}</style></article>", "a"),
        ("<article><p>a</p><div class='comments'><p>nice</p></div></article>", "a"),
        (f"<div id=menu><a>x</a></div><div><p>{LONG}</p><p>b</p><p>{LONG}</p></div><form>q</form>", f"{LONG}\n\nb\n\n{LONG}"),
        (f"<body class='with-sidebar'><p>{LONG}</p></body>", LONG),
        ("3 < 4 and 5 > 2", "3 < 4 and 5 > 2"),
    ],
)
def test_main_text(html, text):
    assert main_text(html) == text


def test_a_passage_ends_where_text_dives():
    far = "<nav>x</nav>" * 3
    assert main_text(f"<p>short</p>{far}<p>{LONG}</p><p>{LONG}</p>{far}<p>end</p>") == f"{LONG}\n\n{LONG}"


@pytest.mark.parametrize("left_out", ["<aside>buy</aside>", "<div class='ad'>buy</div>", "<aside>x</aside>" * 3])
def test_text_goes_on_after_an_element_left_out(left_out):
    page = f"<body><div><p>{LONG}</p><p>{LONG}</p>{left_out}<p>last</p></div><nav>x</nav><div><p>other</p></div></body>"
    assert main_text(page) == f"{LONG}\n\n{LONG}\n\nlast"
    apart = f"<body><div><p>{LONG}</p><p>{LONG}</p></div>{left_out}<div><p>other</p></div></body>"
    assert main_text(apart) == f"{LONG}\n\n{LONG}"


def test_a_marked_article_keeps_blocks_that_are_links():
    page = "<article><p><a href=x>first</a></p><p>text</p><p><a href=y>last</a></p></article><p>out</p>"
    assert main_text(page) == "first\n\ntext\n\nlast"


def test_long_page():
    assert main_text("<article>" + "<p>word</p>" * 20_000 + "</article>").count("word") == 20_000


def test_frame(spark):
    rows = [(1, "u", None, "n"), (1, "u", "<p>a</p>", "n"), (2, None, "", None), (None, "u", "<p>b</p>", "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = pages.select("page_id", extract_text(F.col("html")).alias("text")).collect()
    assert sorted(row["text"] for row in found) == ["", "", "a", "b"]
    assert pages.limit(0).select(extract_text(F.col("html"))).collect() == []
