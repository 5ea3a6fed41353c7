"""Pages whose head is never closed, and attributes with longer names."""

from carledger.llm import pages

BODY = '<article><h1>Title words</h1><p>One long sentence, with a comma, that is the article of this page.</p></article><div class="comments"><p>me too</p></div>'


def names(html):
    return [(b.text, b.tag) for b in pages.blocks(html)]


def test_open_head_ends_where_content_begins():
    want = names(f"<html><head><title>T</title></head><body>{BODY}</body></html>")
    assert len(want) == 3
    for head in ("<title>T</title>", "<title>T</title><meta charset=utf-8><link rel=x><script>var a = '<p>no</p>';</script>", ""):
        assert names(f"<html><head>{head}<body>{BODY}</body></html>") == want
        assert names(f"<html><head>{head}{BODY}") == want
        assert names(f"<head>{head}{BODY}</html>") == want
    assert names("<html><head><title>T</title>plain words") == [("plain words", "html")]


def test_closed_head_hides_what_it_holds():
    assert names("<html><head><title>T</title><style>p {}</style></head><body><p>x</p></body></html>") == [("x", "p")]


def test_only_whole_attribute_names_count():
    (block,) = pages.blocks('<div data-class="footer"><p class="lead">words</p></div>')
    assert ".footer" not in block.names and ".lead" in block.names
