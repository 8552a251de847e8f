"""The fixed word lists have the sizes and members that the survey counted.

The SQL side takes its lists from the package, so these are checked apart.
"""

import pytest

from likeness import lexicon as lx

SIZES = {
    "STRICT_BAD_STARTS": 28, "STRICT_GENERIC_HEADS": 9, "CLEANUP_HEADS": 11, "CLAUSE_STARTS": 9,
    "STOP_TAIL_TOKENS": 36, "VARIANT_BAD_STARTS": 102, "DEFINITE_ARTICLES": 4,
    "ARTICLE_REJECT_HEADS": 13, "COMPLEMENT_PREPOSITIONS": 3, "VARIANT_GENERIC_HEADS": 12,
    "ROLE_HEADS": 29, "VISUAL_HEADS": 17,
}
MEMBERS = {
    "STRICT_GENERIC_HEADS": "tema", "CLEANUP_HEADS": "luva", "CLAUSE_STARTS": "é",
    "VARIANT_BAD_STARTS": "seu agora quando mais se", "ARTICLE_REJECT_HEADS": "mesmo",
    "VARIANT_GENERIC_HEADS": "sistema", "ROLE_HEADS": "jogador parceiro", "VISUAL_HEADS": "água",
}


@pytest.mark.parametrize("name", sorted(SIZES))
def test_sizes(name):
    words = list(getattr(lx, name))
    assert len(words) == len(set(words)) == SIZES[name]


@pytest.mark.parametrize("name", sorted(MEMBERS))
def test_members(name):
    assert set(MEMBERS[name].split()) <= set(getattr(lx, name))


def test_grounds():
    rows = lx.ground_rows()
    quality = [r for r in rows if r[2] == lx.QUALITY_ADJECTIVE]
    assert (len(quality), len(rows) - len(quality)) == (102, 33)
    assert len({r[1] for r in quality}) == 31
    assert len({r[1] for r in rows}) == 40
    assert {"forte", "leve", "fria", "caiu"} <= {r[0] for r in rows}
