from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import final_plan, rows
from forecourt.operators import text

PAGE = """<html><head><title> A &amp; B </title><style>p{x}</style><script>var t="<p>no</p>";</script></head>
<body><!-- <p>hidden</p> --><h1 class="x">Head</h1><p>one <b>bold</b>
line<p>two<br>more</p><P>  </P><div>loose</div><h2>Sub &lt;1&gt;</h2></body></html>"""


def test_elements(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, ""), (3, None), (4, "<p>open")], "page_id int, html string")
    assert rows(text.page_elements(pages, "page_id")) == [
        (1, 0, "title", "A & B"),
        (1, 1, "h1", "Head"),
        (1, 2, "p", "one bold line"),
        (1, 3, "p", "twomore"),
        (1, 4, "h2", "Sub <1>"),
        (4, 0, "p", "open"),
    ]


def test_control_characters_in_a_page_are_not_marks(spark):
    pages = spark.createDataFrame([(1, "<p>one\x1ftwo</p><p>aa\x1ebb</p>")], "page_id int, html string")
    assert rows(text.page_elements(pages, "page_id")) == [(1, 0, "p", "onetwo"), (1, 1, "p", "aabb")]


def test_parsed_pages_keep_pages_without_elements(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "")], "page_id int, html string")
    out = text.parse_pages(pages)
    assert rows(out.select("page_id", "title", "n_headings", "n_paragraphs")) == [(1, "A & B", 2, 2), (2, None, 0, 0)]
    assert rows(out.selectExpr("try_variant_get(tree, '$[1].text', 'string')")) == [("Head",), (None,)]


def pieces(value: str, size: int, overlap: int) -> list[str]:
    step, out, start = size - overlap, [], 0
    while True:
        out.append(value[start : start + size])
        start += step
        if start + overlap >= len(value):
            return out


TEXTS = ["a", "x" * 9, "日本語の文章です。" * 3, "line\n\r\nline 😀😀 end " * 4, " " * 12, "0123456789"]


@pytest.mark.parametrize(("size", "overlap"), [(10, 2), (10, 0), (10, 9), (7, 5), (1000, 100), (1, 0)])
def test_chunks_cover_the_whole_text(spark, size, overlap):
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(98, ""), (99, None)], "id long, body string")
    got = {}
    for r in text.chunk(df, "id", "body", size, overlap).collect():
        assert r["chunk_id"] == f"{r['id']}-{r['pos']}" and r["n_chars"] == len(r["chunk_to_embed"])
        got.setdefault(r["id"], {})[r["pos"]] = r["chunk_to_embed"]
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == {
        i: pieces(value, size, overlap) for i, value in enumerate(TEXTS)
    }


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"]), min_size=1, max_size=60), min_size=1, max_size=5))
def test_chunks_of_any_text(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id long, body string")
    got = sorted((r["id"], r["pos"], r["chunk_to_embed"]) for r in text.chunk(df, "id", "body", 8, 3).collect())
    assert got == [(i, n, p) for i, v in enumerate(values) for n, p in enumerate(pieces(v, 8, 3))]


def test_chunk_sizes_are_checked(spark):
    with pytest.raises(ValueError):
        text.chunk(spark.createDataFrame([(1, "a")], "id int, t string"), "id", "t", 10, 10)


LABELS = {"price": ("price", "discount", "c++"), "test drive": ("drive", "test")}


def test_topics(spark):
    df = spark.createDataFrame(
        [(1, "Price? PRICE, discount; one drive"), (2, "testing driver"), (3, "price drive"), (4, None), (5, "c++ c++")],
        "id int, memo string",
    )
    out = text.classify(df, "memo", LABELS)
    assert rows(out.select("id", "topic", "topic_score")) == [
        (1, "price", 3), (2, "other", 0), (3, "price", 1), (4, None, None), (5, "price", 2),
    ]


def test_topics_without_word_boundaries(spark):
    df = spark.createDataFrame([("試乗の予約をしたい。試乗希望",), ("値引きは可能か",)], "memo string")
    out = text.classify(df, "memo", {"試乗": ("試乗",), "価格": ("値引", "価格")}, "その他", whole_words=False)
    assert rows(out.select("topic", "topic_score")) == [("試乗", 2), ("価格", 1)]


def test_profile_takes_the_latest_value_of_each_attribute(spark):
    notes = spark.createDataFrame(
        [(1, 1, "年収600万円、家族4人"), (1, 2, "家族5人"), (1, 3, "また来ます"), (2, 1, "なし")],
        "customer long, n int, memo string",
    )
    rules = {"income": r"年収(\d+)万円", "family": r"家族(\d+)人"}
    out = text.extract_profile(notes, "customer", "n", "memo", rules)
    assert rows(out) == [(1, "600", "5"), (2, None, None)]


def tree_of(elements):
    """Sections by a stack: (section, level, heading, parent, path, paragraphs)."""
    out, stack = {}, []
    for kind, value in elements:
        if kind != "p":
            level = 0 if kind == "title" else int(kind[1])
            while stack and stack[-1][0] >= level:
                stack.pop()
            n = max(out, default=0) + 1
            stack.append((level, value, n))
            out[n] = (level, value, stack[-2][2] if len(stack) > 1 else None, " > ".join(v for _, v, _ in stack), [])
        else:
            out.setdefault(stack[-1][2] if stack else 0, (None, None, None, "", []))[4].append(value)
    return [(n, *parts[:4], len(parts[4]), "\n".join(parts[4])) for n, parts in out.items()]


def test_sections_form_a_tree(spark):
    rng = random.Random(11)
    kinds = ["title", "h1", "h2", "h3", "h4", "h5", "h6", "p", "p", "p"]
    pages = [[(rng.choice(kinds), f"e{i}") for i in range(rng.randint(0, 40))] for _ in range(30)]
    html = [(i, "".join(f"<{k}>{v}</{k}>" for k, v in page)) for i, page in enumerate(pages)] + [(98, ""), (99, None)]
    got = text.sections(spark.createDataFrame(html, "page_id int, html string"), "page_id")
    assert rows(got) == [(i, *section) for i, page in enumerate(pages) for section in tree_of(page)]
    assert final_plan(got).count("Exchange") <= 2 * 2  # one shuffle, shown in the final and the first plan


def test_section_chunks_stay_within_their_section(spark):
    body = "<title>T</title><p>abcdefgh</p><h1>A</h1><h2>B</h2><p>12345678</p><p>9</p><h1>C</h1>"
    pages = spark.createDataFrame([(1, body), (2, "<p>loose")], "page_id int, html string")
    got = text.section_chunks(pages, "page_id", size=6, overlap=2)
    assert rows(got.select("chunk_id", "chunk_to_embed", "n_chars")) == [
        ("1-1-0", "T\nabcdef", 6), ("1-1-1", "T\nefgh", 4), ("1-3-0", "T > A > B\n123456", 6),
        ("1-3-1", "T > A > B\n5678\n9", 6), ("2-0-0", "loose", 5),
    ]
