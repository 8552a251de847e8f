"""Names of any letters after a title."""

import unicodedata

import pytest

from cases import docs_of
from likeness.llm import pii

NAMED = {
    "Dr Dvořák came": ["Dvořák"], "Mr Łukasz, then": ["Łukasz"], "Mme Lebœuf": ["Lebœuf"],
    "Mr Jan Dvořák and": ["Jan", "Dvořák"], "Dr Παπαδόπουλος ": ["Παπαδόπουλος"],
    "Dr أحمد علي قال هذا": ["أحمد", "علي"], "Mr 王伟 said": ["王伟"], "Ms 김민수.": ["김민수"],
    "Mr Dvořák": ["Dvořák"], "Mr and Mrs Smith": ["Smith"],
    "Mr Smith's dog": ["Smith"], "Ms O'Brien-Łoś": ["O'Brien-Łoś"], "г-н Иванов": ["Иванов"],
    "Dr अमिताभ": ["अमिताभ"], "Mr McDonald": ["McDonald"],
}


@pytest.mark.parametrize("text", NAMED)
def test_names_are_found(text):
    assert [text[a:b] for a, b, *_ in pii.entities(text)] == NAMED[text]


@pytest.mark.parametrize("text", ["Mr smith", "M. is a letter", "Dr 12", "Mr John2", "M. B", "Sir, yes"])
def test_other_words_are_not(text):
    assert pii.entities(text) == []


def test_scripts_are_kept(spark):
    texts = list(NAMED)
    out = {r.doc_id: r.text for r in pii.replace_entities(docs_of(spark, texts)).collect()}
    for i, text in enumerate(texts):
        for name in NAMED[text]:
            assert name not in out[i]
        def scripts(t):
            return {unicodedata.name(c).split()[0] for c in t if c.isalpha()}
        assert scripts(out[i]) == scripts(text)
    short = "".join(chr(0x5F20 + i) for i in range(60))
    many = docs_of(spark, [f"Mr {c}" for c in short])
    assert len({r.text for r in pii.replace_entities(many).collect()} - {f"Mr {c}" for c in short}) == 60
