"""Main texts of generated pages, whose article is known, and of pages that are easily misread."""

import random
from html import escape

import pytest

from tideline.llm import op4_consensus_html as pages

LONG = "long words here " * 30


@pytest.mark.parametrize("html", [
    f'<body><div class="content with-sidebar"><p>{LONG}</p></div></body>', f'<body><article class="post no-sidebar"><p>{LONG}</p></article></body>',
    f'<article class="post comments-open"><p>{LONG}</p></article>', f'<div title="a hidden gem"><p>{LONG}</p></div>', f'<div aria-hidden="false" data-role="menu"><p>{LONG}</p></div>',
    f'<div class="banner"><p>{LONG}</p></div>', f'<main class="widget"><p>{LONG}</p></main>', f'<div id="search-story"><section class="related"><p>{LONG}</p></section></div>'])
def test_articles_that_names_make_suspect(html):
    assert pages.extract(html, None) == LONG.strip()


@pytest.mark.parametrize("html", [
    f'<div class="story"><p>{LONG}</p></div><div class="comments"><p>{"reader says " * 100}</p></div>', f'<div><p>{LONG}</p></div><div class="sidebar-left"><p>{LONG}</p></div>',
    f'<div><p>{LONG}</p></div><div aria-hidden="true"><p>{LONG}</p></div>', f'<div><p>{LONG}</p></div><div hidden><p>no</p></div><form><p>{LONG}</p></form>'])
def test_what_is_not_the_article_stays_out(html):
    assert pages.extract(html, None) == LONG.strip()


def test_lists_of_links_by_their_place():
    refs = "<ul>" + "".join(f"<li><a href=x>Reference {i}</a></li>" for i in range(4)) + "</ul>"
    inside = pages.extract(f"<article><p>{LONG}</p>{refs}<p>{LONG}</p></article>", None).split("\n")
    assert inside == [LONG.strip(), *[f"Reference {i}" for i in range(4)], LONG.strip()]
    menu = f"<div><div>{refs}</div><p>{LONG}</p><p>{LONG}</p></div>"
    assert pages.extract(menu, None).split("\n") == [LONG.strip()] * 2


def test_a_winner_that_holds_little_of_the_page_is_passed_over():
    html = f'<div class="teaser"><p>short teaser text</p></div><div class="body#"><p>{LONG}</p></div>'
    small, own = ">div.teaser", ">div.body#"
    assert pages.extract(html, [small]) == LONG.strip()
    assert pages.extract(html, [small, own]) == LONG.strip()
    two = f'<div class="a"><p>{LONG}</p></div><div class="b"><p>{LONG}</p></div>'
    assert pages.extract(two, [">div.b", ">div.a"]) == pages.extract(two, [">div.a"]) == LONG.strip()  # equal ones: the order of the winners decides
    assert pages.extract(two, None) == LONG.strip()


def generated(rng, host):
    """A page of a host's template, and its article."""
    words = lambda n: " ".join("".join(rng.choice("abcdefgh&<é") for _ in range(rng.randint(2, 8))) for _ in range(n))
    article = [words(rng.randint(8, 60)) for _ in range(rng.randint(2, 9))]
    inner = "".join(rng.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<div>{}</div>", "<ul><li>{}</li></ul>"]).format(escape(a).replace(" ", rng.choice([" ", "\n  ", "&nbsp;"]), 1)) for a in article)
    menu = "<nav>" + "".join(f"<a href=/{i}>{escape(words(2))}</a>" for i in range(5)) + "</nav>"
    side = f'<div class="sidebar"><h3>{escape(words(3))}</h3><p>{escape(words(rng.randint(1, 40)))}</p></div>'
    notes = f'<div class="comments"><p>{escape(words(rng.randint(1, 20)))}</p></div><footer>{escape(words(9))}</footer><script>if (a < b) {{ "{words(4)}" }}</script>'
    frame = (f'<div id="wrap"><div class="post-{rng.randint(1, 999)} entry">{inner}</div>{side}</div>', f"<main>{inner}</main>{side}", f'<table><tr><td class="text">{inner}</td><td>{side}</td></tr></table>')[host]
    return f"<!DOCTYPE html><html><head><title>{escape(words(3))}</title></head><body><header>{menu}</header>{frame}{notes}</body></html>", "\n".join(" ".join(a.split()) for a in article)


def test_generated_pages_give_their_articles(spark):
    rng = random.Random(5)
    made = [(i, f"https://h{i % 3}.org/{i}", *generated(rng, i % 3)) for i in range(240)]
    rows = [(i, u, h) for i, u, h, _ in made]
    longest = f"<article>{''.join(f'<p>word{i} and more</p>' for i in range(60_000))}</article>"
    df = spark.createDataFrame([*rows, (1000, "https://long.org", longest)], "page_id long, url string, html string")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    found = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert spark.conf.get(name) == before
    wrong = [i for i, _, _, text in made if found[i] != text]
    assert not wrong, (len(wrong), found[wrong[0]], made[wrong[0]][3])
    assert found[1000].count("\n") == 59_999 and len(found) == 241
