"""A million characters of anything take the detector a few seconds at most."""

import time

import pytest

from tidemark.llm import pii

N = 1_000_000


@pytest.mark.parametrize(
    "run",
    [" " * N, "(" * N, "[ " * (N // 2), "1" * N, "1 " * (N // 2), "1." * (N // 2), "+1(" * (N // 3), "." * N, "-" * N, "a@" * (N // 2), "a" * N, "one " * (N // 4), " at a" * (N // 5), " dot " * (N // 5), "l O" * (N // 3), "​ " * (N // 2)],
    ids=lambda s: repr(s[:6]),
)
def test_time_is_linear(run):
    text = "a @ b\xa0one 1 [at] " + run + " john [at] example [dot] com"
    began = time.process_time()
    short = time.process_time()
    pii.find_spans(text[: N // 10])
    short, began = time.process_time() - short, time.process_time()
    pii.find_spans(text)
    assert time.process_time() - began < max(4.0, 25 * short)


def test_spaces_before_brackets_are_part_of_the_token():
    for gap in ("", " ", " " * 7):
        text = f"mail john{gap}[at]{gap}example{gap}(dot){gap}com now"
        assert [(k, text[a:b]) for k, a, b, hidden in pii.find_spans(text) if hidden] == [("email", f"john{gap}[at]{gap}example{gap}(dot){gap}com")]


def test_many_plain_and_disguised_spans():
    text = "a@b.cc " * 20_000 + "x [at] y [dot] zz " * 20_000
    began = time.process_time()
    found = pii.find_spans(text)
    assert len(found) == 40_000 and sum(s[3] for s in found) == 20_000 and time.process_time() - began < 6
