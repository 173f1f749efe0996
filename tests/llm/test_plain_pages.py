"""Pages whose containers say little or something misleading."""

import pytest

from vitrine.llm.html_blocks import main_text, trained

TEXT = "Some words of plain text that are an ordinary sentence which goes on for a while and then it ends here with some more words so it is long."
TWO = f"<p>{TEXT}</p><p>{TEXT}</p>"
BOTH = f"{TEXT}\n\n{TEXT}"


@pytest.mark.parametrize("name", ["social-science", "post-tags-page", "layout has-sidebar", "legal-news", "with-sidebar"])
def test_misleading_names_keep_the_text(name):
    assert main_text(f'<div class="{name}">{TWO}</div>', trained()) == BOTH


@pytest.mark.parametrize("name", ["site-nav", "comments-list", "cookie-banner", "sidebar", "related-links"])
def test_furniture_goes(name):
    assert main_text(f'<div id="{name}">{TWO}</div>', trained()) == ""


def test_plain_paragraphs_stay_and_lone_links_go():
    tree = trained()
    assert main_text(f"<div>{f'<p>{TEXT}</p>' * 12}</div>", tree) == "\n\n".join([TEXT] * 12)
    assert main_text(f"<p>{TEXT} {TEXT}</p>", tree) == f"{TEXT} {TEXT}"
    assert main_text(f"{TWO}<p><a href=x>Related story one</a></p>", tree) == BOTH
    assert main_text(f"<div class=sidebar><main>{TWO}</main></div>", tree) == BOTH
