from stockloom.llm.op1_html import blocks_of, evidence_of, extracted, home_share, labelled, main_text, op1_html_extraction


def lowest_cost(pull, ties):
    """Cost of the best labelling, by trying all of them."""
    n = len(pull)
    costs = []
    for mask in range(1 << n):
        content = [mask >> i & 1 for i in range(n)]
        cost = sum(-p if c and p < 0 else p if not c and p > 0 else 0 for p, c in zip(pull, content, strict=True))
        cost += sum(c for i in range(n) for j, c in ties[i].items() if i < j and content[i] != content[j])
        costs.append(cost)
    return min(costs)


def test_minimum_cut_is_the_best_labelling():
    import random

    from stockloom.llm.op1_html import _source_side

    rnd = random.Random(3)
    for _ in range(200):
        n = rnd.randint(1, 7)
        pull = [rnd.randint(-20, 20) for _ in range(n)]
        ties = [{} for _ in range(n)]
        for i in range(n):
            for j in range(i):
                if rnd.random() < 0.6:
                    ties[i][j] = ties[j][i] = rnd.randint(1, 15)
        side = _source_side(list(range(n)), pull, ties)
        cost = sum(-p if i in side and p < 0 else p if i not in side and p > 0 else 0 for i, p in enumerate(pull))
        cost += sum(c for i in range(n) for j, c in ties[i].items() if i < j and (i in side) != (j in side))
        assert cost == lowest_cost(pull, ties)


def test_parts_of_a_page():
    page = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <nav><ul><li><a href="/">Home</a><li><a>More</a></ul></nav><main><article><h1>Head &amp; tail</h1>
    <p>First  paragraph\twith\n words &lt;b&gt; and <b>bold</b>.<p>Second <a href=x>one</a><br>line.
    <div class="ad">Buy this and that and many other things that nobody needs today</div><p>x</p><script>var a="</p>";</script></article>
    <section class="comments"><article class="comment"><p>I liked this text so much that I have to write a long comment about it</p></article></section></main>
    <aside>Beside the text stands some more text with many words in it</aside><form><p>Your name and some words</p></form>
    <div id="cookie-notice"><p>We use cookies to make this page better for all of us, every day and night</p></div><footer>&copy; Site</footer>"""
    assert main_text(page) == "Head & tail\nFirst paragraph with words <b> and bold.\nSecond one line.\nx"


def test_page_without_semantic_elements():
    page = '<div id=menu><a href=a>Home</a> | <a href=b>About</a></div><div id=content><p>A long paragraph that has more than a few words in it and goes on.<p>Yes.<p>Another paragraph with a good number of words that ends here.</div><div class=sidebar>See also these pages that have many words as well</div>'
    assert main_text(page).split("\n") == ["A long paragraph that has more than a few words in it and goes on.", "Yes.", "Another paragraph with a good number of words that ends here."]


def test_empty_and_broken_pages(spark):
    assert main_text(None) == main_text("") == main_text("<p> <!-- open") == main_text("<script>x") == ""
    assert labelled(blocks_of("")) == []
    rows = [(1, None, "a"), (2, "", "b"), (3, "<p>Some words that stand alone on a page of their own", "c"), (3, "<p>Some words that stand alone on a page of their own", "c")]
    found = extracted(spark.createDataFrame(rows, "page_id long, html string, text string")).orderBy("page_id").collect()
    assert [r.text for r in found] == ["", "", "Some words that stand alone on a page of their own", "Some words that stand alone on a page of their own"]
    assert extracted(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_very_long_page():
    page = "<article>" + "<p>words in a paragraph of a long page</p>" * 5000 + "</article>"
    assert len(main_text(page).split("\n")) == 5000


def test_given_pages(spark):
    import html as entities
    import re

    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = op1_html_extraction(spark, folder).collect()
    assert len(found) == len(pages)
    for r in found:
        body = pages[r.page_id].partition("<article>")[2].partition("</article>")[0]
        parts = [" ".join(entities.unescape(re.sub("<[^>]+>", "", p)).split()) for p in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n".join(filter(None, parts)) and r.n_chars == len(r.text)


def test_unseen_elements_end():
    article = "<article><h1>Head</h1><p>Some words that stand in an article of their own.</article>"
    wanted = "Head\nSome words that stand in an article of their own."
    assert main_text(f"<html><head><title>T</title><meta charset=x><body>{article}") == wanted
    assert main_text(f"<head><title>T</title><style>p</style><script>q</script>{article}") == wanted
    for icon in ("<svg class=icon/>", "<svg/>", '<svg class="a/b" d=\'x>y\' />', "<math display=block/>", "<svg><path d=a/>unseen</svg>", "<svg a=b/c>unseen</svg>"):
        assert main_text(f"<body>{icon}{article}") == wanted
    assert main_text(f"<video-player src=x></video-player><button-bar>{article}</button-bar>") == wanted


LONG = "A body paragraph that goes on for a while and says a number of things about its subject in plain words."


def labels_and_evidence(page):
    blocks = blocks_of(page)
    share = home_share(blocks)
    return labelled(blocks), [evidence_of(b, share) >= 0 for b in blocks]


def test_teaser_in_an_article_does_not_take_the_page():
    page = f"<body><article class='card'><h3><a href=x>Related story one</a></h3><p>Teaser text of another story with several words.</p></article><div><p>{LONG} {LONG}</p><p>{LONG}</p></div>"
    assert main_text(page) == f"{LONG} {LONG}\n{LONG}"
    labels, alone = labels_and_evidence(page)
    assert labels == [False, False, True, True] and alone == [False, True, True, True]  # the heading's tie takes the teaser


def test_ties_decide_blocks_of_weak_evidence():
    page = f"<div><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><div><p><a href=a>One</a></p><p><a href=b>Two</a></p><p>More of these to read</p><p><a href=c>Three</a></p></div>"
    labels, alone = labels_and_evidence(page)
    assert labels == [True, True, True, False, False, False, False]
    assert alone[1] is False


def test_weak_evidence_without_ties_stands_alone(monkeypatch):
    from stockloom.llm import op1_html

    page = f"<div><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div>"
    assert main_text(page) == f"{LONG}\nYes.\n{LONG}"
    monkeypatch.setattr(op1_html, "NEXT", 0.0)
    monkeypatch.setattr(op1_html, "SIBLING", 0.0)
    assert main_text(page) == f"{LONG}\n{LONG}"


def test_long_comments_and_asides_stay_out_of_a_short_article():
    comment = f"<div class='comment'><p>{LONG} {LONG}</p></div>"
    page = f"<main><h1>Head</h1><p>{LONG}</p><div id='comments'>{comment * 12}</div></main><aside><p>{LONG} {LONG}</p></aside><footer><p>{LONG}</p></footer>"
    assert main_text(page) == f"Head\n{LONG}"
