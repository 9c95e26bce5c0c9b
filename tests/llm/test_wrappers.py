from tripmill.llm import wrappers

FRAME = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/">Menu %d</a><li>More</ul></nav>
<div id="side-bar" class="sidebar">side %d</div><div class="cookie-notice">We use cookies</div>
%s<form><input value="x">Search</form><aside>aside</aside>
<section class="comments"><p>Great post %d!</p></section><footer>&copy; us %d</footer></body></html>"""


def page(number, body):
    return FRAME % (number, number, body, number, number)


def text_of(html):
    return "\n\n".join(wrappers.located(html, None)[0])


def test_article_of_a_page():
    body = """<article><header class="entry-header"><h1>A &amp; B</h1></header><!-- <p>no</p> -->
      <p>One<br>two <b>three</b>&nbsp;\n four<p><i>Five</i>&#33;<ul><li>a<li>b</ul>
      <table><tr><td>c1<td>c2</table><div class="share">Share</div><footer>tags</footer></article>"""
    assert text_of(page(1, body)) == "A & B\n\nOne two three four\n\nFive!\n\na\n\nb\n\nc1\n\nc2"


def test_pages_without_landmarks_keep_their_blocks():
    assert text_of(page(1, "<div><p>First.</p>loose<p>Second.</div>")) == "First.\n\nloose\n\nSecond."


def test_broken_markup():
    assert text_of("") == ""
    assert text_of("plain < text > & more") == "plain < text > & more"
    assert text_of("<p>a</div></b><p>b<!-- open") == "a\n\nb"
    assert text_of("<p title='x>y'>a<b class=\"q'>c</p>") in ("a", "ac", "a\n\nc", "a<b class=\"q'>c")
    assert text_of("<script>x") == ""
    assert text_of("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text_of("<p>" + "word " * 50_000 + "</p>") == " ".join(["word"] * 50_000)
    assert text_of("<" * 20_000) == "<" * 20_000


def test_simple_tree_matching():
    a, b = "(html(body(nav div.x(p) article(h1 p))))", "(html(body(nav article(h1 p ul) div.x)))"
    matched = wrappers.align(a, b)
    # html, body, nav and the larger of the two subtrees that cross: article with its two children.
    assert len(matched) == 1 + 3 + 3
    assert wrappers.align(a, a) == {i: i for i in range(9)}


def test_shapes_can_be_read_again():
    root, _ = wrappers.parse(page(3, "<main><h2>x</h2><p>y</p><h2>z</h2></main>"))
    shape = wrappers.shape_of(root)
    assert wrappers.shape_of(wrappers.read_shape(shape)) == shape


def test_constant_slots_are_template(spark):
    def body(i):
        return f"<div class=main><p>Story number {i} is its own.</p><p>All rights remain with the paper.</p></div>"

    rows = [(i, f"http://News.example:80/{i}", page(i, body(i))) for i in range(12)]
    rows += [(100 + i, f"http://other.example/{i}", page(1, "<p>Always the same story.</p>")) for i in range(9)]
    rows += [(200, None, page(1, body(200))), (201, "not a url", None), (202, "http://x.example", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    found = {r["page_id"]: r for r in wrappers.extract(pages).collect()}
    assert len(found) == len(rows)
    assert all(found[i]["text"] == f"Story number {i} is its own." for i in range(12))
    # Copies of one page are one page: nothing shows that their text is template.
    assert all(found[100 + i]["text"] == "Always the same story." for i in range(9))
    assert found[200]["text"] == "Story number 200 is its own.\n\nAll rights remain with the paper."
    assert found[201]["text"] == found[202]["text"] == "" and found[201]["n_chars"] == 0
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


def test_empty_table_and_clashing_columns(spark):
    schema = "page_id bigint, url string, html string, host string, shape int, text string"
    assert wrappers.extract(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "http://a.example/", "<p>x</p>", "h", 1, "t")] * 2 + [(None, None, None, None, None, None)]
    found = wrappers.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r["text"] for r in found) == ["", "x", "x"]


def test_the_template_decides_before_articles(spark):
    def body(i, card):
        return f"<div class=card><article><p>{card}</p></article></div><div class=story><p>Story number {i} is its own.</p><p>All rights.</p></div>"

    rows = [(i, f"http://fixed.example/{i}", page(i, body(i, "Our app is out now."))) for i in range(12)]
    rows += [(100 + i, f"http://varied.example/{i}", page(i, body(i, f"Read on in part {i}."))) for i in range(12)]
    odd = "<article><p>The whole of the article.</p></article><div class=date><p>May {i}</p></div>"
    rows += [(200, "http://few.example/0", page(1, odd)), (201, "http://few.example/1", page(1, body(1, "Card.")))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    found = {r["page_id"]: r["text"] for r in wrappers.extract(pages).collect()}
    assert all(found[i] == f"Story number {i} is its own." for i in range(12))
    assert all(found[100 + i] == f"Read on in part {i}.\n\nStory number {i} is its own." for i in range(12))
    # No template: the article breaks the tie if it is the longer part, and loses nothing if not.
    assert found[200] == "The whole of the article."
    assert found[201] == "Card.\n\nStory number 1 is its own.\n\nAll rights."


ARTICLE = """<article><h1>Title</h1><p>One.</p><h2 id="related-work">Related work</h2><p>Two.</p>
<section id="social-impact"><h3>Social impact</h3><p>Three.</p></section><p class="ad-hoc-note">Four.</p>
<div class="share-price">Five.</div><p class="share">Six.</p><div class="share-buttons">Tweet</div>
<div class="ad ad-300x250">Buy</div></article>"""


def test_slugs_and_chance_names_cost_no_text():
    kept = ["Title", "One.", "Related work", "Two.", "Social impact", "Three.", "Four.", "Five.", "Six."]
    assert text_of(page(1, ARTICLE)).split("\n\n") == kept
    outside = ARTICLE.replace("article", "div").replace('<p class="share">Six.</p>', "")
    assert text_of(page(1, outside)).split("\n\n") == kept[:-1]
    named = '<div id="sidebar">x</div><div id="site-header">x</div><ul class="related-posts"><li>x</ul><h2 id="comments">Kept</h2>'
    assert text_of(page(1, named)) == "Kept"


def test_a_menu_without_a_telling_name_is_template(spark):
    menu = "<div class=x1><div>Home</div><div>World</div><div>Contact us</div></div>"
    rows = [(i, f"http://plain.example/{i}", f"<body>{menu}<div class=x2><p>Story {i}.</p><p>More of {i}.</p></div></body>") for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r["page_id"]: r["text"] for r in wrappers.extract(pages).collect()} == {i: f"Story {i}.\n\nMore of {i}." for i in range(8)}


def random_tree(rng, depth):
    node = wrappers.Node("")
    for _ in range(rng.randint(0, 4) if depth else 0):
        label = rng.choice("abcdef")
        if label not in node.children:
            child = random_tree(rng, depth - 1)
            child.label = label
            node.children[label] = child
    return node


def largest(a, b):
    """Nodes in the largest match of two trees with equal roots, by plain recursion over all choices."""

    def pairs(left, right):
        if not left or not right:
            return 0
        skip = max(pairs(left[1:], right), pairs(left, right[1:]))
        return max(skip, pairs(left[1:], right[1:]) + largest(left[0], right[0])) if left[0].label == right[0].label else skip

    return 1 + pairs(list(a.children.values()), list(b.children.values()))


def test_matches_are_the_largest():
    import random

    rng = random.Random(6)
    for _ in range(300):
        a, b = random_tree(rng, 3), random_tree(rng, 3)
        shapes = wrappers.shape_of(a), wrappers.shape_of(b)
        matched = wrappers.align(*shapes)
        assert len(matched) == largest(a, b)
        assert len(set(matched.values())) == len(matched)
