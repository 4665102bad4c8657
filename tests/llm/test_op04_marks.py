"""Operator 4: typographic marks that stick to a notice's words."""

import pytest

from clickwin.llm.license_scan import Scanner


@pytest.mark.parametrize("text, errors", [
    ("released undr the mit license” and more", 2),
    ("released under the mit license—see the file", 1),
    ("released under the mit license。", 1),
    ("released under the mit” license and more", 1),
    ("“under the bsd license” and more", 1)])
def test_marks_count_as_edits(text, errors):
    hit, = Scanner().scan(text)
    assert hit.errors == errors and hit.label in ("mit", "bsd")


def test_marks_beyond_the_bound_and_longer_words_are_no_notice():
    for text in ("released undr th mit license” and", "under the mit licenseabc and",
                 "apache license version 2é"):
        assert not Scanner().scan(text), text
