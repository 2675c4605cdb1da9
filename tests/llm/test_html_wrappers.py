"""A hint word on a wrapper does not lose the article."""

import pytest

from packlift.llm import html_text

ARTICLE = "".join(f"<p>Paragraph {k}, with some commas, and enough plain text to count for a paragraph of its own.</p>" for k in range(4))
WANT = "\n\n".join(f"Paragraph {k}, with some commas, and enough plain text to count for a paragraph of its own." for k in range(4))


@pytest.mark.parametrize("wrapper", ["div id='page' class='site has-sidebar'", "div class='content no-sidebar'", "div class='post-body share-enabled'",
                                     "section class='story related-open'", "div class='has-sidebar'"])
def test_wrapper_with_a_bad_word(wrapper):
    tag = wrapper.split()[0]
    page = f"<html><body><div class='ad'><p>Buy, buy, buy now</p></div><{wrapper}>{ARTICLE}</{tag}><div class='sidebar'><p>Short, aside</p></div></body></html>"
    assert html_text.main_text(page) == WANT


def test_wrapper_around_an_article():
    assert html_text.main_text(f"<div class='overlay'><article>{ARTICLE}</article></div>") == WANT
