"""Personal data in whole texts, disguised or not, with offsets into the source.

The plain patterns run on the text as it is. Then two transducers rewrite it:
look-alike characters become the ASCII ones they imitate, and letters that stand for digits
within a run of digits become these, one for one; and at/dot disguises, spelled digits, "plus" and invisible characters become the
character they stand for (in the words of English, German, French and Spanish, and the codes of pages and links), with a list of where each rewritten piece came from.
The same patterns run on the result, and what they find is mapped back to the
characters of the source that it was made of.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches
from .tokens import portions

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind: string, start: long, end: long, disguised: boolean>>"

# Letters of other scripts that look like ASCII ones.
LOOK_ALIKES = dict(zip("аеорсухіјѕԁһӏԛԝАВЕКМНОРСТУХІЈЅαοερνικυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdhlqwABEKMHOPCTYXIJSaoepvikuxABEZHIKMNOPTYX", strict=True))
# Characters that stand for a full stop, an at sign, a hyphen or a space.
SIGNS = dict(zip("。․‧∙﹒﹫‐‑‒–—−﹣      　", "....." + "@" + "-------" + "       ", strict=True))
INVISIBLE = "­​‌‍⁠﻿"
# Digits spelled in English, German, French and Spanish, from 0 on.
SPELLED = {"oh": "0"} | {
    w: str(d)
    for words in ("zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve")
    for d, w in enumerate(words.split())
}
# What the at sign and the full stop are called in those languages, beside at and dot, and how pages write them.
AT_WORDS, DOT_WORDS = "arroba|arobase|arobas|klammeraffe", "punkt|point|punto"
AT_CODES, DOT_CODES = "&[#]64;|&[#]x40;|&commat;|%40", "&[#]46;|&[#]x2e;|&period;|%2e"


def _single_forms() -> dict[int, str]:
    """By rule: decimal digits of all scripts, and forms whose compatibility mapping is one ASCII character."""
    out = {}
    for code in (*range(0x660, 0x1000), *range(0x2070, 0x2090), *range(0x2100, 0x2150), *range(0x2460, 0x2500), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)):
        c = chr(code)
        plain = str(unicodedata.decimal(c)) if unicodedata.decimal(c, None) is not None else unicodedata.normalize("NFKC", c)
        if len(plain) == 1 and " " <= plain <= "~":
            out[code] = plain
    return out


_FORMS = _single_forms() | {ord(a): b for a, b in (LOOK_ALIKES | SIGNS).items()}
_FOREIGN = re.compile("[\xa0\u0180-\U0010ffff]")  # a superset of what _FORMS maps; Latin letters with accents stay out
_DIGIT = re.compile("[0-9]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_ARTICLE = "un"  # a digit only before another one
_OTHERS = "|".join(w for w in SPELLED if w != _ARTICLE)
_WORDS = rf"{_OTHERS}|{_ARTICLE}(?=[ ,-]+(?:{_OTHERS})\b)"
_SPACES = r"(?:(?<![ ])[ ]*|)"  # a whole run of spaces or none, so that a long run is gone through once
_ANY_DOT = f"(?:dot|{DOT_WORDS})"
_TOKEN = re.compile(
    rf"""(?P<at> {_SPACES} [\[({{<] [ ]* (?:at|@|{AT_WORDS}) [ ]* [\])}}>] [ ]* | (?<=[a-z0-9]) (?:[ ]+@[ ]*|[ ]*@[ ]+) (?=[a-z0-9])
            | (?<=[a-z0-9]) [ ]+ at [ ]+ (?= [a-z0-9-]+ (?: [ ]+(?:dot|punkt)[ ]+ | [ ]*[\[({{<][ ]*{_ANY_DOT} ) )
            | (?<=[a-z0-9]) [ ]+ (?:{AT_WORDS}) [ ]+ (?= [a-z0-9-]+ (?: [ ]+{_ANY_DOT}[ ]+ | [ ]*[\[({{<][ ]*{_ANY_DOT} | \.[a-z0-9] ) )
            | (?<=[a-z0-9]) (?:{AT_CODES}) (?=[a-z0-9]) )
      | (?P<name> (?<=[a-z0-9]) [ ]+ at [ ]+ (?= [a-z0-9-]+ \. [a-z0-9] ) )
      | (?P<dot> {_SPACES} [\[({{<] [ ]* (?:dot|\.) [ ]* [\])}}>] [ ]* | (?<=[a-z0-9]) [ ]+ dot [ ]+ (?=[a-z0-9]) | (?<=[a-z0-9]) (?:{DOT_CODES}) (?=[a-z0-9]) )
      | (?P<word> {_SPACES} [\[({{<] [ ]* (?:{DOT_WORDS}) [ ]* [\])}}>] [ ]* | (?<=[a-z0-9]) [ ]+ (?:{DOT_WORDS}) [ ]+ (?=[a-z0-9]) )
      | (?P<plus> \b plus [ -]* (?= [0-9] | (?:{_WORDS}) \b ) )
      | (?P<digit> \b (?:{_WORDS}) \b (?: [ ,-]+ (?= (?:{_WORDS}) \b ) )? )
      | (?P<none> [{INVISIBLE}]+ )""",
    re.X | re.I,
)
_BRACKETED = re.compile(rf"[\[({{<] *(?:at|dot|@|\.|{AT_WORDS}|{DOT_WORDS}) *[\])}}>]")
_BARE = re.compile(r"\bdot\b|\bplus")
_CODED = re.compile(f"{AT_CODES}|{DOT_CODES}")
#: "at" before a written domain is an at sign only after a name with a full stop or underscore in it: "look at example.com" is prose.
_NAMED = re.compile(r"[a-z0-9][._][a-z0-9]+ +at +[a-z0-9-]+\.[a-z0-9]")
_NAME = re.compile(r"(?<![A-Za-z0-9])[A-Za-z][A-Za-z0-9]*[._][A-Za-z0-9._]*$")
#: Words for the full stop that are common in prose count between names of one address only: behind an at sign and a name, or before a name, or a few, and an at sign.
_BEHIND_AT = re.compile(r"@[A-Za-z0-9-]+$")
_BEFORE_AT = re.compile(
    rf"[a-z0-9_-]{{1,64}}(?: {{1,4}}(?:{DOT_WORDS}) {{1,4}}[a-z0-9_-]{{1,64}}){{0,3}}(?: {{0,4}}[\[({{<] {{0,4}}(?:at|@|{AT_WORDS}) {{0,4}}[\])}}>]| {{0,4}}@| {{1,4}}(?:at|{AT_WORDS}) {{1,4}}[a-z0-9-]{{1,64}}(?: {{1,4}}{_ANY_DOT} | {{0,4}}[\[({{<]|\.))",
    re.I,
)
_LABEL = re.compile("[A-Za-z0-9-]+")
#: How far back a name is looked for: the longest that an address or a label of a domain can have.
_BACK = 66
_BESIDE = re.compile(rf"\b(?:{_WORDS})[ ().,-]+(?:[0-9]|(?:{_WORDS})\b)|[0-9][ ().,-]+(?:{_WORDS})\b")  # what may stand between the digits of a span
_CASES = str.maketrans("ſıİ", "sii")  # other than A-Z, what re.I takes for letters of the tokens
_UNSEEN = re.compile(f"[{INVISIBLE}]")
_TLD = re.compile(r"\.[A-Za-z]{2,}$")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """What the plain patterns find: leftmost, without overlap within a kind; a match that
    fails its check is dropped and the search goes on behind it. Time is linear in the text."""
    out, free = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append(("email", start, m.end()))
                free = m.end()
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


_MIXED = re.compile(r"(?<![A-Za-z0-9])[0-9OolI](?:[ .-]?[0-9OolI])+(?![A-Za-z0-9])")
_AS_DIGITS = str.maketrans("OolI", "0011")


def _letters_as_digits(m: re.Match[str]) -> str:
    """A run of digits in which O or l stand for some of them; runs of few digits are words."""
    run = m.group()
    return run.translate(_AS_DIGITS) if len(_digits(run)) >= 6 else run


def _may_be_disguised(text: str) -> bool:
    """Whether the text may have a token that shows a span; cheap tests for its letters come before patterns.
    A spelled digit does so only beside a numeral or another spelled one."""
    low = text.translate(_CASES).lower() if any(c in text for c in "ſıİ") else text.lower()
    return bool(
        " @" in low or "@ " in low
        or (("dot" in low or "plus" in low) and _BARE.search(low))
        or (any(c in low for c in "[({<") and _BRACKETED.search(low))
        or (any(c in low for c in "&%") and _CODED.search(low))
        or "arroba" in low or "arobas" in low or "klammeraffe" in low
        or (("punkt" in low or "point" in low or "punto" in low) and ("@" in low or " at " in low))
        or (" at " in low and _NAMED.search(low))
        or (any(w in low for w in SPELLED) and _BESIDE.search(low))
        or (not text.isascii() and _UNSEEN.search(text))
    )


def rewrite(text: str) -> tuple[str, list[int], list[tuple[int, int]]] | None:
    """The text with its disguises undone, the places in it where pieces begin, and each
    piece's start in the source with 1 if it was copied (so that offsets run along), or
    0 if it stands for a whole token; None if nothing was undone."""
    plain = text.translate(_FORMS) if not text.isascii() and _FOREIGN.search(text) else text
    if _DIGIT.search(plain):
        plain = _MIXED.sub(_letters_as_digits, plain)
    if plain == text and not _may_be_disguised(text):
        return None
    parts, begins, sources, at, size, in_domain = [], [], [], 0, 0, False

    def add(piece: str, source: int, copied: int) -> None:
        nonlocal size
        if piece:
            begins.append(size)
            sources.append((source, copied))
            parts.append(piece)
            size += len(piece)

    for m in _TOKEN.finditer(plain):
        kind = m.lastgroup
        if kind == "name" and not _NAME.search(plain[max(m.start() - _BACK, 0) : m.start()]):
            continue
        if kind == "word" and not _BEFORE_AT.match(plain, m.end()):
            between = plain[max(at, m.start() - _BACK) : m.start()]  # since the last token undone, which may be the at sign or another full stop of the domain
            if not (_BEHIND_AT.search(between) or (in_domain and m.start() - at <= _BACK and _LABEL.fullmatch(between))):
                continue
        in_domain = kind in ("at", "name") or (kind in ("dot", "word") and in_domain) or (kind == "word" and bool(_BEHIND_AT.search(plain[max(at, m.start() - _BACK) : m.start()])))
        add(plain[at : m.start()], at, 1)
        stands = "" if kind == "none" else {"at": "@", "name": "@", "dot": ".", "word": ".", "plus": "+"}.get(kind) or SPELLED[re.match(r"[^\W\d_]+", m.group()).group().translate(_CASES).lower()]
        add(stands, m.start(), 0)
        at = m.end()
    add(plain[at:], at, 1)
    return "".join(parts), begins, sources


def find_spans(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, disguised) of all spans in code points, by start and then by kind."""
    base = plain_spans(text)
    out = {(k, a, b): False for k, a, b in base}
    if (undone := rewrite(text)) is not None:
        normal, begins, sources = undone
        ends = [*[s for s, _ in sources[1:]], len(text)]
        plain = {kind: sorted((a, b) for k, a, b in base if k == kind) for kind in KINDS}
        starts = {kind: [a for a, _ in spans] for kind, spans in plain.items()}

        def source(i: int, last: bool) -> int:
            piece = bisect_right(begins, i) - 1
            start, copied = sources[piece]
            if copied:
                return start + i - begins[piece] + last
            if not last:
                return start
            return start + len(text[start : ends[piece]].rstrip(" ,-" + INVISIBLE))

        for kind, a, b in plain_spans(normal):
            start, end = source(a, False), source(b - 1, True)
            if text[start:end] == normal[a:b] or (kind == "email" and not _TLD.search(normal[a:b])):
                continue
            at = bisect_right(starts[kind], start) - 1
            if at < 0 or plain[kind][at][1] < end:
                out.setdefault((kind, start, end), True)
    return [(*span, out[span]) for span in sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))]


def detect_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with pii, the spans of each text: kind, start, end (code points, end exclusive)
    and whether only the undone text shows it.

    A null or empty text has an empty list. Rows come back once each, without a
    shuffle; an empty table gives an empty result. A column of docs named pii is
    replaced.
    """
    docs = docs.drop("pii")
    where = docs.columns.index(text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("disguised", pa.bool_())]))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = [[dict(zip(("kind", "start", "end", "disguised"), s, strict=True)) for s in find_spans(t.as_py() or "")] for t in batch.column(where)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, "pii"])

    return text_batches(docs).mapInArrow(scan, docs.withColumn("pii", F.lit(None).cast(SPANS)).schema)


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
