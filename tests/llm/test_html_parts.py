"""What must not vanish from a page: wrappers with telling names, parts beside the longest one."""

import pytest

from likeness.llm.html_extract import main_text

SAID = " ".join(f"Sentence {i}, of some length, which goes on for a while." for i in range(6))
BODY = "".join(f"<p>Sentence {i}, of some length, which goes on for a while.</p>" for i in range(6))


@pytest.mark.parametrize(
    "wrapper",
    [
        'div style="overflow:hidden"', 'div class="overflow-hidden"', 'article data-title="Hidden lake"',
        'div class="layout has-sidebar"', 'div class="no-sidebar"', 'section class="comments-open"',
        'div class="share-price"', 'div class="content-sidebar-wrap"', 'div data-x="display:none"',
        'div aria-hidden="false"',
    ],
)
def test_wrappers_that_hold_the_text(wrapper):
    tag = wrapper.split()[0]
    page = f"<body><div class=menu><p>Menu, here.</p></div><{wrapper}>{BODY}</{tag}></body>"
    assert main_text(page) == SAID
    inner = f"<body><{wrapper}><main>{BODY}</main><div class=sidebar><p>Aside, that.</p></div></{tag}></body>"
    assert main_text(inner) == SAID


@pytest.mark.parametrize(
    "wrapper",
    ["div hidden", 'div aria-hidden="true"', 'div style="color:red; display : none"', 'div class="ad"',
     'section class="comments"'],
)
def test_hidden_and_named_parts_go(wrapper):
    tag = wrapper.split()[0]
    page = f"<body><article>{BODY}</article><{wrapper}><p>Not shown, at all.</p></{tag}></body>"
    assert main_text(page) == SAID


LEAD = "This is the lead of the article, which says, in short, what all of it is about."
END = "In the end, all of it was said, and there is nothing more to add to it, really."


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_parts_beside_the_longest(tag):
    many = BODY * 5
    page = (
        f"<body><div><a href=x>Home</a></div><{tag}><h1>Head</h1><p class=lead>{LEAD}</p><div class=body>{many}</div>"
        f"<h2><a href=y>Linked heading</a></h2><div class=closing><p>{END}</p></div></{tag}><p><a>Next</a></p></body>"
    )
    assert main_text(page) == " ".join(["Head", LEAD, *[SAID] * 5, "Linked heading", END])


def test_linked_references_of_an_article():
    page = f"<article>{BODY}<ul><li><a href=1>First source</a><li><a href=2>Second source</a></ul></article><ul><li><a>x</a></ul>"
    assert main_text(page) == f"{SAID} First source Second source"
