"""Disguises in the corpus's languages and in codes of pages, found with their offsets; prose of the same words is left alone."""

import time

import pytest

from tidemark.llm.pii import find_spans

FOUND = [
    ("hans punkt meier at firma punkt de", "email", "hans punkt meier at firma punkt de"),
    ("Mail: hans (at) firma (punkt) de bitte", "email", "hans (at) firma (punkt) de"),
    ("juan arroba correo punto com", "email", "juan arroba correo punto com"),
    ("écrivez à marie arobase exemple point fr merci", "email", "marie arobase exemple point fr"),
    ("marie arobase exemple.fr", "email", "marie arobase exemple.fr"),
    ("uwe@firma punkt co punkt uk", "email", "uwe@firma punkt co punkt uk"),
    ("ana arroba uno.com", "email", "ana arroba uno.com"),
    ("see jane&#64;example.com now", "email", "jane&#64;example.com"),
    ("?to=jane%40example.com", "email", "jane%40example.com"),
    ("jane&#64;example&#46;com", "email", "jane&#64;example&#46;com"),
    ("john.smith at example.com", "email", "john.smith at example.com"),
    ("plus vier neun eins fünf eins zwei drei vier fünf sechs sieben", "phone", "plus vier neun eins fünf eins zwei drei vier fünf sechs sieben"),
    ("Tel. +34 seis uno dos tres cuatro cinco seis siete ocho", "phone", "+34 seis uno dos tres cuatro cinco seis siete ocho"),
    ("tél +33 six un deux trois quatre cinq six sept huit", "phone", "+33 six un deux trois quatre cinq six sept huit"),
]
CLEAN = [
    "look at example.com for more", "Stop at the point of no return", "arrive at this point or leave at that point in time", "We met at the point where one road ends.", "Der Punkt ist, dass zwei und drei fünf sind.", "le point de vue de la ville un deux trois",
    "el punto de partida es uno y dos", "Zu einem Punkt at home", "100%40 off", "a &#64; b", "Un arroba de vino pesa once kilos", "dos arroba de trigo", "null null sieben",
]


@pytest.mark.parametrize("text, kind, span", FOUND)
def test_found(text, kind, span):
    at = text.index(span)
    assert [(k, a, b) for k, a, b, disguised in find_spans(text) if disguised] == [(kind, at, at + len(span))], find_spans(text)


@pytest.mark.parametrize("text", CLEAN)
def test_clean(text):
    assert find_spans(text) == []


def test_address_stays():
    text = "john@example.fr point final, hans@firma.de punkt Ende, +1 (848) 555-1373 Un jour"
    assert [(text[a:b], d) for _, a, b, d in find_spans(text)] == [("john@example.fr", False), ("hans@firma.de", False), ("+1 (848) 555-1373", False)]


@pytest.mark.parametrize("piece", ["a punkt ", "punkt ", "a at b punkt ", "x.", "a%40", "arroba a ", "a_at ", "a.b at c", "un ", "a point b@", "(punkt)", "&#64;"])
def test_linear(piece):
    text = piece * (400_000 // len(piece))
    begun = time.perf_counter()
    find_spans(text)
    assert time.perf_counter() - begun < 20
