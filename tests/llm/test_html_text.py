import pytest

from riskframe.llm import html_text as ht

PROSE = ("The thing of the matter is that it was not to be with the others, and for this reason they have been on their way to the "
         "house by the sea, as he said, in an hour or so, but not at once and not with all of them.")
MORE = "Die Sache mit dem Haus ist nicht so einfach, denn der Weg zu ihm ist lang und das Wetter ist schlecht, und sie hat es mit dem Hund."


def page(body, head="<title>The title of the page</title><style>p{}</style><script>var x='<p>no</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


CASES = [
    (None, ""), ("", ""), ("   ", ""), ("<html><body></body></html>", ""),
    # chrome around an article
    (page(f"""<header><h1>Site</h1><p>{PROSE}</p></header><nav><ul><li><a href=/a>The home</a></li></ul></nav>
      <div id="cookie-notice"><p>{PROSE}</p></div><div class="ad">{PROSE}</div><aside><p>{PROSE}</p></aside>
      <article><header><h1>A headline</h1></header><p>{PROSE}</p><p>Short.</p><script>x()</script><div class="adBox ads">{MORE}</div>
      <p>{MORE}<br>and &amp; so &lt;on&gt; &eacute;&#233;&#xe9;&nbsp;x</p><form><p>{PROSE}</p><input></form><p>End.</p></article>
      <section id="comments"><div class="comment"><p>{PROSE}</p></div></section><div role="complementary"><p>{PROSE}</p></div>
      <div>{MORE}</div><footer><p>&copy; {PROSE}</p></footer>"""),
     f"A headline\n\n{PROSE}\n\nShort.\n\n{MORE} and & so <on> ééé x\n\nEnd."),
    # no article element: text features and neighbours
    (page(f"<div>Menu item</div><ul><li><a href=/x>{PROSE}</a></li></ul><h2>On the way</h2><p>{PROSE}</p><p>Quite so.</p><p>{PROSE}</p>"
          f"<div><a href=/l>more</a></div><p>Share this</p>"), f"On the way\n\n{PROSE}\n\nQuite so.\n\n{PROSE}"),
    # an article inside a form that wraps the page, and left-open elements
    (f"<form><main><p><b>{PROSE}<p>{MORE}<ul><li>one<li>two</main></form><footer>the end of it", f"{PROSE}\n\n{MORE}\n\none\n\ntwo"),
    # broken quotes, stray ends, comments, upper case, no closing tags at all
    (f"<ARTICLE></div><P CLASS='x\">{PROSE}</P><!-- <p>hidden</p> --><p title=\"a > b\">{MORE}</p></b>", f"{PROSE}\n\n{MORE}"),
    (f"<article><p>{PROSE}<script>never closed <p>{MORE}", PROSE),
    (f"<article><p>{PROSE}<br><br>{MORE}</p></article>", f"{PROSE}\n\n{MORE}"),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_cases(case):
    html, want = CASES[case]
    assert ht.main_text(html) == want


def test_short_blocks_inherit_from_nearest_decided_neighbours():
    found = ht.classify(ht.blocks(f"<div>{PROSE}</div><div>tiny</div><div>bits</div><div>{PROSE}</div><ul><li><a>a link that is here</a></li></ul><div>last</div>"))
    assert [b.label for b in found] == ["good", "good", "good", "good", "bad", "bad"]


def test_query_shape_nulls_long_and_clashing_columns(spark):
    rows = [(1, "u", page(f"<article><p>{PROSE}</p></article>"), "x", 1), (2, None, None, "x", 1), (2, None, None, "x", 1),
            (None, "v", "<p>" * 20_000 + "<div>" * 3000 + "word " * 200_000, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = ht.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = {r.page_id: r for r in got.collect()}
    assert got[1].text == PROSE and got[1].n_chars == len(PROSE) and (got[2].text, got[2].n_chars) == ("", 0)
    assert ht.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("html, want", [
    (f'<article class="post category-promotion tag-popular no-comments"><p>{PROSE}</p></article>', PROSE),
    (f'<main><article class="post popular"><p>{PROSE}</p></article></main>', PROSE),
    (f'<div class="layout has-sidebar"><article><p>{PROSE}</p></article><div class="sidebar"><p>{MORE}</p></div></div>', PROSE),
    (f'<div class="sidebar"><article><p>{PROSE}</p><p>{PROSE}</p></article><p>{MORE}</p></div><div>{MORE}</div>', f"{PROSE}\n\n{PROSE}"),
    (f'<div class="no-comments"><p>{PROSE}</p><p>{PROSE}</p></div>', f"{PROSE}\n\n{PROSE}"),
    # what classes and elements rightly mark stays boilerplate
    (f'<article><p>{PROSE}</p></article><ol class="comment-list"><li><article class="comment"><p>{PROSE} {PROSE}</p></article></ol>', PROSE),
    (f'<div><p>{PROSE}</p><p>{PROSE}</p></div><div class="related"><article><p>{MORE}</p></article></div>', f"{PROSE}\n\n{PROSE}"),
    (f'<div><p>{PROSE}</p><p>{PROSE}</p></div><div class="site-footer"><p>{PROSE}</p></div><aside><article>{PROSE}</article></aside>', f"{PROSE}\n\n{PROSE}"),
    (f'<article style="display:none"><p>{PROSE}</p></article>', ""),
    # raw elements that are empty or have no end
    (f"<article><svg/><math /><p>{PROSE}</p></article>", PROSE),
    (f"<article><button><p>{PROSE}</p><button>x</button><p>{MORE}</p></article>", f"{PROSE}\n\n{MORE}"),
    *[(f"<article><{t}><p>{PROSE}</p></article>", PROSE) for t in ("button", "noscript", "select", "object", "canvas", "video")],
    *[(f"<article><p>{PROSE}</p><{t}><p>{MORE}</p></article>", PROSE) for t in ("script", "style", "textarea", "template")],
])
def test_articles_are_not_lost(html, want):
    assert ht.main_text(page(html, "")) == want


def test_many_open_raw_elements_are_read_once():
    assert ht.main_text("<article>" + f"<button><p>{PROSE}</p>" * 5000 + "</article>").count(PROSE) == 5000
