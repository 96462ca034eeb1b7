import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomdex.llm import html_text

LONG = "A paragraph with enough words to be the dense part of a page, and then some more of them."
ARTICLE = f"<article><h1>Head</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></article>"
WANT = f"Head {LONG} Short. {LONG}"


@pytest.mark.parametrize("page", [
    f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href=/>x</a></ul></nav>{ARTICLE}<footer>f</footer></body></html>",
    f"<body><div class='ad'>Buy now {LONG}</div>{ARTICLE}<div class='comments'><article><p>{LONG}</p></article></div></body>",
    f"<body><div id=side-bar class='sidebar'>{LONG}</div><form><p>{LONG}</p><input></form>{ARTICLE}<script>var a='<p>{LONG}</p>'</script>",
    f"<body><div class=cookie-notice>{LONG}</div><div role=navigation>{LONG}</div><header>{LONG}</header>{ARTICLE}<aside>{LONG}</aside>",
    f"<body><nav>unclosed menu {ARTICLE}</body>",
    f"<body><ul><li><a>one</a></li><li><a>two</a></li><li><a>three</a></li></ul>{ARTICLE}<ul><li><a>4</a><li><a>5</a><li><a>6</a></ul>",
])
def test_main_text(page):
    assert html_text.main_text(page) == WANT


def test_blocks_spaces_and_references():
    page = "<article><p>a&amp;b &copy;&#8212;&nbsp; x\n\t y</p><p>in<b>li</b>ne<br>break</p><p></p> tail</article>"
    assert html_text.main_text(page) == "a&b ©— x y inline break tail"


def test_malformed_pages():
    assert html_text.main_text("<article><p><b>one<br><p>two</b></i></article></div>") == "one two"
    assert html_text.main_text("a < b and c") == "a < b and c"
    assert html_text.main_text("<p>only text") == "only text"


def test_page_without_semantic_tags_keeps_its_densest_region():
    body = "".join(f"<p>{LONG}</p>" for _ in range(6)) + "<p>brief</p>"
    page = f"<body><div><a>a</a> | <a>b</a></div><div><h2>Title</h2>{body}</div><div><span>x</span><span>y</span></div></body>"
    assert html_text.main_text(page) == f"Title {' '.join([LONG] * 6)} brief"


UNEVEN = [("h1", "Head"), ("div class=lead", LONG), ("div class=body", "".join(f"<p>{LONG}</p>" for _ in range(12))), ("blockquote", LONG), ("p", "Short."), ("section", f"<p>{LONG}</p><p>end</p>")]


@pytest.mark.parametrize("outer", ["article", "main", "div"])
def test_uneven_sections_are_whole(outer):
    inner = "".join(f"<{tag}>{text}</{tag.split()[0]}>" for tag, text in UNEVEN)
    page = f"<body><div><a>a</a> | <a>b</a></div><{outer}>{inner}</{outer}><div><span>x</span><span>y</span></div></body>"
    got = html_text.main_text(page)
    assert got == " ".join(["Head", *[LONG] * 14, "Short.", LONG, "end"])


def test_every_article_with_dense_text_is_kept():
    page = f"<body><article>{''.join(f'<p>{LONG}</p>' for _ in range(9))}</article><article><h2>Next</h2><div><p>{LONG}</p></div></article></body>"
    assert html_text.main_text(page) == " ".join([*[LONG] * 9, "Next", LONG])


@pytest.mark.parametrize("page", [
    f"<body><nav><ul>{'<li>item ' * 100}</ul></nav><div><p>{LONG}</p></div></body>",
    f"<body><form><select>{'<option>o' * 100}</select></form><div><p>{LONG}</p></div></body>",
    f"<body><div><p>{LONG}<form><select>{'<option>o' * 100}</select></form><p></div></body>",
    f"<body><nav>{'<b>' * 100}</nav><p>{LONG}</body>",
    f"<head><title>t</title><body><p>{LONG}",
    f"<body><nav><dl>{'<dt>a<dd>b' * 100}</dl></nav><nav><table>{'<tr><td>x<th>y' * 100}</table></nav><p>{LONG}</body>",
])
def test_omitted_end_tags_do_not_swallow_what_follows(page):
    assert html_text.main_text(page) == LONG


@pytest.mark.parametrize("open_tags", ["<p>x" * 100, "<b>x" * 100, "<ul>" + "<li>x" * 100])
def test_an_article_ends_after_many_open_elements(open_tags):
    reader = html_text.LineReader()
    reader.feed(f"<body><article>{open_tags}</article>after</body>")
    reader.close()
    assert reader.lines[-1][0] == "after" and reader.parents[reader.lines[-1][3]] == 0 and reader.lines[0][3] != reader.lines[-1][3]


def test_lists_and_cells_nest_and_inline_ends_leave_blocks_open():
    assert html_text.main_text("<article><ul><li>a<ul><li>b<li>c</ul>d<li>e</ul><p>f</article>") == "a b c d e f"
    assert html_text.main_text(f"<body><b><article><p>{LONG}</p></b><p>{LONG}</p></article></body>") == f"{LONG} {LONG}"


def test_end_tags_take_linear_time():
    page = "<i><div>" + "<b>" * 30_000 + "</i><i></u></i>" * 30_000 + f"<p>{LONG}"
    started = time.perf_counter()
    assert html_text.main_text(page) == LONG
    assert time.perf_counter() - started < 10


def test_edge_rows(spark):
    big = "<article>" + "".join(f"<p>word {i}</p>" for i in range(20_000)) + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<script>x</script>"), (4, "u", big), (4, "u", big), (None, "u", "<p>x</p>"), (5, "u", "<" * 2000), (6, "u", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'old' as text", "7 as n_chars")
    got = html_text.extract(df)
    assert got.columns == ["page_id", "url", "n_chars", "text"]
    texts = {r.page_id: r.text for r in got.collect()}
    assert texts[1] == texts[2] == texts[3] == "" and texts[None] == "x" and texts[6] == "deep"
    assert texts[4] == " ".join(f"word {i}" for i in range(20_000))
    assert got.count() == len(rows) and html_text.extract(df.limit(0)).count() == 0


def slow_content_lines(lines, wholes, parents):
    """The same choice over whole paths of regions, copied and compared as they are."""
    def path(r):
        return (*path(parents[r]), r) if r else ()

    sizes = np.array([len(t) for t, _, _, _ in lines], float)
    own = sizes / np.array([max(1, n) for _, _, n, _ in lines])
    ratios = html_text.smooth(own)
    least = min(ratios.std(), ratios.max())
    dense, core = ratios >= least, own >= least
    paths = [path(r) for _, _, _, r in lines]
    every = {p[:i] for p in paths for i in range(len(p) + 1)}
    held = {q: sum(s for p, s, d in zip(paths, sizes, dense) if d and p[: len(q)] == q) for q in every}
    region = max((q for q in every if held[q] >= html_text.MOST * sizes[dense].sum()), key=len, default=())
    outer = [next((r for r in p if r in wholes), 0) for p in paths]
    if any(r in wholes for r in region):
        found = {o for o, c in zip(outer, core) if c} | {next(r for r in region if r in wholes)}
        return [o in found and o != 0 for o in outer]
    above = region
    while not all(p[: len(above)] == above for p, c in zip(paths, core) if c):
        above = above[:-1]
    n = len(above)
    held_here = [i for i, p in enumerate(paths) if p[:n] == above and (dense[i] or core[i])]
    parts = {paths[i][: n + 1] for i in held_here}
    return [
        p[: len(region)] == region
        or p[:n] == above and (len(p) == n or p[: n + 1] in parts or bool(held_here) and held_here[0] <= i <= held_here[-1])
        for i, p in enumerate(paths)
    ]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<div>", "</div>", "<section>", "</section>", "<article>", "</article>", "<p>", "<br>", "<b>x</b>", "few words ", LONG, "<main>", "</main>", "<td>"]), max_size=60))
def test_content_is_chosen_as_over_whole_paths(parts):
    reader = html_text._read("".join(parts), wrappers=False)
    if reader.lines:
        assert html_text.content_lines(reader.lines, reader.wholes, reader.parents) == slow_content_lines(reader.lines, reader.wholes, reader.parents)


def test_text_at_every_level_takes_linear_time():
    spent = []
    for n in (2_000, 16_000):
        began = time.process_time()
        text = html_text.main_text("<div>word here " * n)
        spent.append(time.process_time() - began)
        assert text == " ".join(["word here"] * n)
    assert spent[1] < 30 * max(spent[0], 0.02)


BODY = "".join(f"<p>{LONG}</p>" for _ in range(5))
ALL = " ".join([LONG] * 5)


@pytest.mark.parametrize("page", [
    f"<body><div class='content has-sidebar'>{BODY}</div></body>",
    f"<body><div class='legal-notice-article'>{BODY}</div></body>",
    f"<body><form id=aspnetForm action=/><input><select><option>pick one</option></select><div>{BODY}</div><button>Send</button></form></body>",
    f"<body class=no-sidebar><div class='widget'><div class=sidebar></div>{BODY}</div></body>",
    f"<body><nav><a>menu</a></nav><div id=share-page>{BODY}</div><div class=sidebar>A note at the side</div></body>",
])
def test_wrappers_with_a_marked_name_keep_the_article(page):
    assert html_text.main_text(page) == ALL


def test_marked_parts_beside_an_article_still_go():
    note = f"<div class=cookie-notice>{BODY}</div><form>{BODY}</form>"
    assert html_text.main_text(f"<body>{note}{ARTICLE}</body>") == WANT
    assert html_text.main_text(f"<body><div>{BODY}</div><div class='notice'>{LONG}</div><div class=comments>{BODY}{BODY}{BODY}</div></body>") == ALL
