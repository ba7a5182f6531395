"""SentencePiece coding, HTML extraction, fingerprints."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tracklight.llm import html_text, merkle
from tracklight.llm.sentencepiece_codec import Codec, encode_decode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_agenda_gives_the_ids_of_the_library(library):
    with open(MODEL, "rb") as file:
        codec = Codec(file.read(), check=False)
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "▁", "é", "😀", "\x00", "​", "the", "<s>", "ﬁ", "\t", "ing", "中", "文", "\r\n", "0x0A>", "<", "token"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["", " ", "x" * 500, "".join(rng.choice("abcdefgh") for _ in range(30_000))]
    offsets, ids = codec.encode_batch(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == library.encode(texts)
    assert codec.decode_batch(offsets, ids) == [library.decode(i) if i else "" for i in library.encode(texts)]


def test_a_difference_from_the_library_is_an_error():
    with open(MODEL, "rb") as file:
        codec = Codec(file.read())
    codec.pair_places, codec.by_place = len(codec.by_place) - 1 - codec.pair_places, codec.by_place[::-1]  # merges in the wrong order
    with pytest.raises(ValueError, match="differ"):
        codec.encode_batch(["the wrong order of merges is noticed"])


def test_chunks_survive_a_full_table(library):
    with open(MODEL, "rb") as file:
        codec = Codec(file.read())
    codec.known.most = 5
    for begin in range(60):
        texts = [f"hello world {begin + i} and, well: {'old' * i}" for i in range(5)]
        offsets, ids = codec.encode_batch(texts)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == library.encode(texts)
        assert len(codec.known.young.place) < 40


def test_encode_edge_rows(edge_docs, no_docs, library):
    coded = encode_decode(edge_docs, MODEL)
    assert sorted(coded.columns) == sorted(edge_docs.columns)
    rows = coded.collect()
    assert len(rows) == edge_docs.count()
    for row in rows:
        expected = library.encode(row["text"] or "")
        assert row["ids"] == expected and row["decoded"] == (library.decode(expected) if expected else "")
    assert encode_decode(no_docs, MODEL).count() == 0


PAGES = [
    (
        "<html><head><title>t</title></head><body><div id='cookie-notice'>We use cookies</div><header><h1>Site</h1></header>"
        "<div class='menu'><a href=x>Home</a></div><div class='content'><h2>Title &amp; more</h2><p>First <b>bold</b> and <a href=y>a link</a> words."
        "<p>Second one.<div class=ad>Buy now</div><ul><li>one item<li>two item</ul><p>Last paragraph of it all.</div>"
        "<div id='comments'><p>I disagree with all of this text, says a reader.</p></div><footer>&copy; 2020</footer>",
        ["Title & more", "First bold and a link words.", "Second one.", "one item", "two item", "Last paragraph of it all."],
    ),
    ("<article><header><h1>T</h1></header><p>Body text here<section class='comments'><article class='comment'><p>Hi</p></article></section></article>", ["T", "Body text here"]),
    ("", []),
    (None, []),
    ("<p>x", ["x"]),
    ("no tags", ["no tags"]),
    ("<nav><a>b</a>", []),
    ("<nav>menu <article><p>Text in here</p></article>", ["Text in here"]),
    ("<main><p>A<br>B</p><form><p>Mail</p></form><p class='notice'>Note</p><p>C</p></main>", ["A B", "C"]),
    ("<p>a &lt; b &#x41;&nbsp;z</p><script>if (a<b) x('</p>')", ["a < b A z"]),
    ("<aside>side words</aside><article><p>" + "long " * 50_000 + "</p></article><div>beyond</div>", [("long " * 50_000).strip()]),
]


def test_extraction_of_hand_made_pages():
    for page, blocks in PAGES:
        assert html_text.extract(page or "", html_text.DEFAULTS) == blocks


def test_cards_do_not_replace_the_text():
    long = "Main text of the page goes on for many words in a row here."
    for page, blocks in [
        (f"<div><p>{long}</p></div><aside><article><p>Teaser one</p></article></aside>", [long]),
        (f"<div><p>{long}</p></div><div class=related><article><p>Card</p></article><article><p>Other</p></article></div>", [long]),
        (f"<nav><article><p>Card</p></article></nav><article><p>{long}</p></article><footer><article><p>Card</p></article></footer>", [long]),
        (f"<div><p>{long}</p></div><section><article><p>Card</p></article><article><p>Other</p></article></section>", [long]),
        (f"<div class='has-sidebar'><main><p>{long}</p></main><aside>side</aside></div>", [long]),
        (f"<nav>menu <article><p>{long}</p></article><nav>more</nav>", [long]),
    ]:
        assert html_text.extract(page, html_text.DEFAULTS) == blocks


def test_names_of_sections_do_not_drop_them():
    posting = "itemtype='http://schema.org/SocialMediaPosting'"
    for page, blocks in [
        ("<section id='discussion'><h2 id='related-work'>Related work</h2><p>Long text of it.</p></section>", ["Related work", "Long text of it."]),
        ("<section id='side-effects'><p>Headache.</p></section><h2 id='search'>Search</h2><p>How to.</p>", ["Headache.", "Search", "How to."]),
        (f"<div {posting}><p>Post.</p></div>", ["Post."]),
        ("<section class='discussion'><p>A reader.</p></section><section id='related'><a href=x>More of this</a></section>", []),
        ("<div id='social-share'>Send it</div><div id='newsletter'>Mail</div><div id='related'><a href=x>More of this</a> too</div>", []),
    ]:
        assert html_text.extract(f"<article><p>Begin here.</p>{page}<p>End of it.</p></article>", html_text.DEFAULTS) == ["Begin here.", *blocks, "End of it."]


def test_best_run_is_the_maximum():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.choice([-2.0, -1.0, -0.5, 0.5, 1.0, 3.0]) for _ in range(rng.randint(0, 12))]
        begin, end = html_text.best_run(scores)
        best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0)
        assert sum(scores[begin:end]) == max(best, 0)


def test_extraction_learns_from_marked_pages(spark, folder):
    import re
    from html import unescape

    pages = spark.read.parquet(f"{folder}/pages.parquet")
    weight = html_text.learn(pages)
    assert weight["word plain"] > 0 > weight["word furniture"] and weight["marker inside"] > 0 > weight["marker beyond"]
    assert all(value < 0 for view, value in weight.items() if view.startswith("tag"))
    for row in html_text.main_text(pages).collect():
        article = re.search(r"<article>(.*)</article>", row["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<(?!br)[^>]*>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert row["text"] == "\n\n".join(b for b in blocks if b)


def test_extraction_of_edge_rows(spark):
    schema = "page_id long, url string, html string, text string, n_blocks string"
    rows = [(k, None, page, "old", "old") for k, (page, _) in enumerate(PAGES)] + [(0, None, PAGES[0][0], None, None), (None, None, None, None, None)]
    found = html_text.main_text(spark.createDataFrame(rows, schema), html_text.DEFAULTS).collect()
    assert len(found) == len(rows)
    for row in found:
        blocks = PAGES[row["page_id"]][1] if row["page_id"] is not None else []
        assert (row["text"], row["n_blocks"]) == ("\n\n".join(blocks), len(blocks))
    empty = spark.createDataFrame([], schema)
    assert html_text.main_text(empty).count() == 0 and html_text.learn(empty) == html_text.DEFAULTS


def test_fingerprints_tell_texts_apart_and_locate_edits():
    lines = [f"paragraph number {k} has words of its own, and {k * k} more." for k in range(40)]
    text = "\n".join(lines)
    other = "\n".join([*lines[:20], "an inserted line", *lines[20:]])
    a, b = str(merkle.Tree(text.encode())), str(merkle.Tree(other.encode()))
    assert a == str(merkle.Tree(text.encode())) and a != b
    one, two = merkle.Tree.parse(a), merkle.Tree.parse(b)
    assert str(one) == a and merkle.likeness(one, merkle.Tree(text.encode())) == 1.0
    assert 0.9 < merkle.likeness(one, two) < 1 and merkle.likeness(one, two) == merkle.likeness(two, one)
    assert merkle.edits(a, a) == []
    found = merkle.edits(a, b)
    flat = [(s, k) for s, (_, own) in enumerate(two.sections) for k in range(len(own))]
    assert [flat.index(place) for place in found] == [20]
    assert merkle.likeness(one, merkle.Tree(b"nothing in common here whatsoever")) < 0.1
    swapped = "\n".join(lines[::-1])
    assert merkle.likeness(one, merkle.Tree(swapped.encode())) < 1


def expected_edits(rows):
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        out.append((i, text, following, text[: len(text) - len(text) // 4] + following[: len(text) // 4]))
    return out


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_edited_texts_by_brute_force(edge_docs, edge_texts, buckets):
    found = merkle.compare_with_edited(edge_docs, buckets).collect()
    key = lambda r: (str(r[0]), r[1], r[2])
    ours = sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in found), key=key)
    theirs = []
    for i, text, following, edited in expected_edits(edge_texts):
        tree = merkle.Tree(text.encode())
        theirs.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), merkle.likeness(tree, merkle.Tree(edited.encode())), merkle.likeness(tree, merkle.Tree(following.encode()))))
    assert ours == sorted(theirs, key=key)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)


def test_fingerprints_of_one_and_no_document(spark, no_docs, edge_docs):
    one = merkle.compare_with_edited(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and one["near_next"] == 1.0
    assert merkle.compare_with_edited(no_docs).count() == 0
    rows = merkle.fingerprints(edge_docs).collect()
    assert len({r["fingerprint"] for r in rows}) == len({r["text"] or "" for r in rows})


@pytest.mark.parametrize(
    "page, blocks",
    [
        ('<article><p>one two three four</p><svg class="i"/><p>five six seven</p></article>', ["one two three four", "five six seven"]),
        ("<article><p>a b c d</p><video-player src=x></video-player><p>e f g</p><svg-icon></svg-icon> h</article>", ["a b c d", "e f g", "h"]),
        ("<article><p>a b c d</p><object data=x><p>e f g</p></article>", ["a b c d", "e f g"]),
        ("<article><p>a b c</p><svg><text>x</text></svg><select><option>1</select><script>x</script><p>d e</p></article>", ["a b c", "d e"]),
        ("<article><p>energy <math>E</math> holds in all of it</p></article>", ["energy E holds in all of it"]),
        ('<article><div class="elementor-widget"><p>words that are the whole article of this page</p></div></article>', ["words that are the whole article of this page"]),
        ('<body><div class="page has-sidebar"><p>the words of the page go on for long</p><div class="sidebar"><a href=x>a link</a></div></div></body>', ["the words of the page go on for long"]),
        (
            '<article><p>first words of it are here</p><div class="side-by-side"><p>two pictures</p></div><div class="related-work"><p>others did this</p></div></article>',
            ["first words of it are here", "two pictures", "others did this"],
        ),
        ('<body><div><p>long text of the page is here</p><section id="discussion"><h2>Discussion</h2><p>we talk</p></section></div></body>', ["long text of the page is here", "Discussion", "we talk"]),
        ('<article><p>words of the article are here</p><div class="ad"><p>buy now</p></div><div class="share-buttons"><a href=x>tweet this</a></div></article>', ["words of the article are here"]),
    ],
)
def test_tags_and_class_names_that_lose_no_text(page, blocks):
    assert html_text.extract(page, html_text.DEFAULTS) == blocks
