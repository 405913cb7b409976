"""Main text of pages: parsing by hand, the chain against enumeration, and held-out layouts."""

import html as entities
import itertools
import random
import re

import numpy as np
import pytest

from tests.llm.conftest import SF_DIR
from tillhouse.llm import extraction as x
from tillhouse.llm import queries
from tillhouse.llm.common import ROW


def texts(page):
    return [b.text for b in x.blocks(page)]


def test_blocks_of_untidy_pages():
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body><!-- no <p>no</p> -->
    <nav><ul><li><a href="/">Home<li>News</ul></nav><article><h1>A &amp; B &copy 2</h1>
    <p><b>One\n two<br>three<br><p>Four &lt;p&gt; <i>five</i>six</p>loose <a href='x>y'>link</a> text
    <script>var p = "<p>no</p>";</script><table><tr><td>left<td>right</table><pre>  a
      b </pre><p>1 < 2 &nbsp; &am</p></article><footer>&#169; end</footer><p title="cut"""
    assert texts(page) == [
        "Home", "News", "A & B © 2", "One two three", "Four <p> fivesix", "loose link text", "left", "right", "a b", "1 < 2 &am", "© end",
    ]


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!--", "</p>", "<script>", "&", "<p></p><div> </div>", "<a href='", '<p class="'])
def test_pages_without_text(page):
    assert texts(page) in ([], ["<"], ["&"])


def test_deep_and_long_pages_are_linear():
    deep = "<div class='a'>" * 5_000 + "x" + "</div>" * 5_000
    assert texts(deep) == ["x"]
    assert len(texts("<p>a</p>" * 100_000)) == 100_000
    assert len(texts("<p>a <b \"" * 2_000)) > 0


def test_ancestors_reach_the_block():
    (block,) = x.blocks('<div class="post-content"><section id="readerComments"><p>hello</p></section></div>')
    assert {"in=div", "in=section", "in=p", "word=post", "word=comments", "mark=comment", "mark=article"} <= block.marks
    assert block.nearest == "comment" and block.tag == "p"


def some_field(rng):
    names = "abcd"
    return x.Field({n: rng.uniform(-2, 2) for n in names}, rng_array(rng, (2, 2, 2)), rng_array(rng, 2))


def rng_array(rng, shape):
    return np.array([rng.uniform(-2, 2) for _ in range(int(np.prod(shape)))]).reshape(shape)


def worth(field, page, labels):
    total = field.first[labels[0]] + sum(s for s, y in zip(field.scores(page), labels) if y)
    return total + sum(field.pairs[k, a, b] for k, (a, b) in zip(x.neighbours(page), itertools.pairwise(labels)))


def test_viterbi_against_all_labelings():
    rng = random.Random(3)
    for _ in range(60):
        field = some_field(rng)
        page = [[rng.choice("xy"), *(n for n in "abcd" if rng.random() < 0.5)] for _ in range(rng.randrange(1, 8))]
        best = max(worth(field, page, y) for y in itertools.product((0, 1), repeat=len(page)))
        assert worth(field, page, field.decode(page)) == pytest.approx(best)


def test_fit_climbs_to_the_maximum():
    """At the fitted weights no small change of one of them raises the penalised likelihood."""
    rng = random.Random(8)
    pages = []
    for _ in range(6):
        labels = [rng.randrange(2) for _ in range(rng.randrange(2, 6))]
        pages.append(([[rng.choice("xy"), "ab"[y if rng.random() < 0.7 else 1 - y], "any"] for y in labels], labels))

    def likelihood(field):
        total = 0.0
        for page, labels in pages:
            every = [worth(field, page, y) for y in itertools.product((0, 1), repeat=len(page))]
            total += worth(field, page, labels) - np.logaddexp.reduce(every)
        values = np.concatenate([list(field.weights.values()), field.pairs.ravel(), field.first])
        return total - 0.1 * (values**2).sum()

    best = x.fit(pages, rounds=600, ridge=0.2, rate=0.05)
    top = likelihood(best)
    for name in best.weights:
        for by in (-0.05, 0.05):
            moved = x.Field({**best.weights, name: best.weights[name] + by}, best.pairs, best.first)
            assert likelihood(moved) < top + 1e-6
    for place in itertools.product((0, 1), repeat=3):
        pairs = best.pairs.copy()
        pairs[place] += 0.05
        assert likelihood(x.Field(best.weights, pairs, best.first)) < top + 1e-6


@pytest.fixture(scope="module")
def model(spark):
    return x.train(queries.table(spark, SF_DIR, "pages"))


def test_layouts_never_seen(spark, model):
    """Pages dressed anew with another seed, from articles that are not in the sample."""
    rng = random.Random(99)
    words = "silver river north market quiet harbour engine letter window garden stone paper".split()
    made = [[" ".join(rng.choices(words, k=rng.randrange(3, 40))).capitalize() + "." for _ in range(rng.randrange(2, 9))] for _ in range(200)]
    right = total = exact = 0
    for article in made:
        page, labels = x._golden(x.dress(article, [t for a in made[:20] for t in a], rng))
        found = model.decode(page)
        right += sum(a == b for a, b in zip(found, labels))
        total += len(labels)
        exact += found == labels
    assert right / total > 0.97 and exact / len(made) > 0.85


HAND_MADE = [
    ("""<html><body><div id="cookieConsent"><p>We value your privacy. This site uses cookies. <button>OK</button></p></div>
     <header class="site-header"><a href="/">The Valley Post</a></header><ul class="main-menu"><li><a href="/a">World</a></li><li><a href="/b">Sport</a></li></ul>
     <div class="post-content"><h1>Bridge reopens</h1><p>The bridge across the valley opened again on Monday after two years of work.</p>
     <div class="ad-slot"><p>Buy two tyres and get two free this week only.</p></div>
     <p>Drivers had to take a detour of twenty miles, and many shops lost customers.</p></div>
     <div class="sidebar"><h3>Most read</h3><ul><li><a href="/c">Storm ahead</a></li></ul></div>
     <section id="comments"><h3>2 comments</h3><p>I am glad that it is open again, it took far too long.</p><p>Reply</p></section>
     <footer><p>Copyright 2024 The Valley Post. All rights reserved.</p></footer></body></html>""",
     ["Bridge reopens", "The bridge across the valley opened again on Monday after two years of work.",
      "Drivers had to take a detour of twenty miles, and many shops lost customers."]),
    ("""<body><nav>Inicio Noticias</nav><main><h1>El mercado</h1><p>El mercado del barrio abre este sábado con veinte puestos nuevos.</p>
     <aside>Lea también: la feria</aside><p>Los vecinos esperan que vuelva la vida a la plaza.</p>
     <form action="/s"><label>Correo</label><input><button>Enviar</button></form></main><div class="comments"><div class="comment"><p>Qué buena noticia, allí estaré con mi familia.</p></div></div>
     <footer>Aviso legal</footer></body>""",
     ["El mercado", "El mercado del barrio abre este sábado con veinte puestos nuevos.", "Los vecinos esperan que vuelva la vida a la plaza."]),
]


@pytest.mark.parametrize("page, expected", HAND_MADE)
def test_hand_made_pages(model, page, expected):
    assert x.main_text(page, model).split("\n") == expected


def template_text(page):
    """The article of the tables' own pages, cut out by their markup."""
    inside = re.search(r"(?s)<article>(.*?)(?:</article>|$)", page).group(1)
    parts = re.split(r"(?i)</?(?:p|h1|div|ul|li)[^>]*>", inside)
    parts = [" ".join(entities.unescape(re.sub(r"<br>", " ", p).replace("<b>", "").replace("</b>", "")).split()) for p in parts]
    return "\n".join(p for p in parts if p)


def test_every_page_of_the_table(spark):
    found = {r.page_id: r for r in queries.op13_main_text(spark, SF_DIR).collect()}
    rows = queries.table(spark, SF_DIR, "pages").collect()
    assert len(found) == len(rows)
    for r in rows:
        assert found[r.page_id].text == template_text(r.html)
        assert found[r.page_id].n_chars == len(found[r.page_id].text)


def test_training_pages_of_any_number(spark):
    """No pages, or none that names an article, still give a model."""
    empty = queries.table(spark, SF_DIR, "pages").limit(0)
    found = x.extract(spark.createDataFrame([(1, HAND_MADE[1][0])], "page_id long, html string"), x.train(empty)).first()
    assert found["text"].split("\n") == HAND_MADE[1][1] and found[ROW]["page_id"] == 1
