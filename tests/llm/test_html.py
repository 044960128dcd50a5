import math
import re

import pytest

from tidemark.llm import html_text
from tidemark.llm.html_text import main_text

A = ("<h1>Title</h1><p>First, a longer paragraph with words; and more of them, indeed.</p>"
     "<p>Second one, last, it is, and on it goes.</p>")
TEXT = "Title First, a longer paragraph with words; and more of them, indeed. Second one, last, it is, and on it goes."
PROMO = "<p>long promo text, which goes on, and on, for very many words indeed.</p>"


@pytest.mark.parametrize("page", [
    f"<body><div class=x9>Home World Sport</div><article>{A}</article><div class=bottom>{PROMO}</div></body>",
    f"<body><div class='post no-sidebar'>{A}</div></body>",
    f"<body><nav><a href=/>Home</a></nav><div class='layout-widget'>{A}</div><footer>Us, too.</footer></body>",
    f"<body><form id=f><nav>Home, x</nav>{A}<div class=comments><p>I say, no, to it all.</p></div></form></body>",
    f"<article><header>{A[:14]}</header>{A[14:]}<footer>By us</footer></article>",
    f"<article>{A}<div class=discussion><p>I say, no, to it all, no no, no.</p></div></article>",
    f"<body><div class=popup><div class=widget>{A}</div></div></body>",
    f"<body><ul><li><a href=/>Home</a><li><a href=/w>World</a></ul><div>{A}</div></body>",
    f"<div class=footer-page><article>{A}</article>{PROMO}</div>"])
def test_names_do_not_decide_alone(page):
    assert main_text(page) == TEXT


@pytest.mark.parametrize("page", ["<nav><p>Home, and more.</p></nav>", "<div class=menu>a, b</div>", "<div hidden><p>a, b</p></div>",
                                  "<footer><p>Us.</p></footer>", "</div></p>", "<!-- x", "<script>a"])
def test_pages_without_an_article(page):
    assert main_text(page) == ""


def test_containers_between_content_belong_to_it():
    page = f"<body><div>x y</div><div>{A}<div>Short</div>{A}</div><div><b>end</b></div></body>"
    assert main_text(page).startswith("Title First") and "Short Title" in main_text(page)


def test_ratios_match_a_plain_recomputation(spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        _, nodes = html_text.read_page(row["html"])
        size = [len(n.text.strip()) for n in nodes]
        marks = [len(re.findall("[.,;:!?…。，、]", n.text)) for n in nodes]

        def smooth(values):
            near = [[(j, math.exp(-0.5 * (i - j) ** 2)) for j in range(max(0, i - 2), min(len(nodes), i + 3))] for i in range(len(nodes))]
            return [sum(w * values[j] for j, w in ws) / sum(w for _, w in ws) for ws in near]

        def ratio(values):
            of = {}
            for n, v in zip(nodes, values):
                of.setdefault(n.path, []).append(v)
            return [sum(of[n.path]) / len(of[n.path]) for n in nodes]

        fused = [a * (1 + b) for a, b in zip(smooth(ratio(size)), smooth(ratio(marks)))]
        mean = {p: sum(f * max(s, 1) for n, f, s in zip(nodes, fused, size) if n.path == p)
                / sum(max(s, 1) for n, s in zip(nodes, size) if n.path == p) for p in {n.path for n in nodes}}
        middle = sum(fused) / len(fused)
        deviation = math.sqrt(sum((f - middle) ** 2 for f in fused) / len(fused))
        limit = min(0.8 * deviation, max(mean.values()))
        plain = [a * (1 + b) for a, b in zip(ratio(size), ratio(marks))]
        good = {n.path for n in nodes if mean[n.path] >= limit}
        good = {n.path for n, x in zip(nodes, plain) if n.path in good and x >= limit / 2} or good
        expected = [n.path in good and s > 0 for n, s in zip(nodes, size)]
        assert html_text.content_nodes(nodes, html_text.np.ones(len(nodes)), 1.0, 0.8).tolist() == expected


def test_very_deep_and_very_long_pages():
    assert main_text("<div>" * 20_000 + A + "</div>" * 20_000) == TEXT
    assert main_text("<b>" * 20_000 + "</i>" * 20_000 + "a, b") == "a, b"
    long = "<p>" + "words, and more. " * 20 + "</p>"
    assert main_text(f"<nav>Home</nav><article>{long * 5_000}</article>") == " ".join(["words, and more."] * 100_000)


def test_rows_of_every_kind(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    rows = [(1, "u", f"<article>{A}</article>", 1, "x")] * 2 + [(None, None, None, 2, "y"), (3, "v", "", 3, None), (None, "w", "a", 4, "z")]
    got = html_text.extract(spark.createDataFrame(rows, schema)).collect()
    key = str
    assert sorted(map(tuple, got), key=key) == sorted(
        [(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0), (3, "v", "", 0), (None, "w", "a", 1)], key=key)
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []
