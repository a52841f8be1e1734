"""The gate before the transducer changes no span."""

from unittest import mock

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii

PIECES = ["one", "Four", "oh", "ſix", "fıve", "bone", "111", "1", "192", ".", ",", " ", "-", "(", ")", "+", "plus", "pluſ", " dot ", " at ", "@", "a", "com", "\n", "é", "[", "]", "​", "l", "O"]


@given(st.lists(st.sampled_from(PIECES), max_size=30).map("".join))
@settings(max_examples=3000, deadline=None)
def test_the_gate_changes_no_span(text):
    found = pii.find_spans(text)
    with mock.patch.object(pii, "_may_be_disguised", lambda text: True):
        assert pii.find_spans(text) == found


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("four 111 one 111 one 111 one 111", "card", "four 111 one 111 one 111 one 111"), ("at 192.168.one.1 there", "ip", "192.168.one.1"), ("4111 1111 1111 111 one", "card", "4111 1111 1111 111 one"),
        ("nr four one one one one one one one one one one one one one one one", "card", "four one one one one one one one one one one one one one one one"),
        ("nr ſix one one one one one one one one one one one one one one six", "card", "ſix one one one one one one one one one one one one one one six"),
    ],
)
def test_alternating_digits(text, kind, found):
    assert [(k, text[a:b]) for k, a, b, hidden in pii.find_spans(text) if hidden] == [(kind, found)]


def test_plus_without_a_space():
    assert ("phone", 0, 16, True) in pii.find_spans("plus491761234567 z")
