"""The words of one text, for the Arrow functions of ``text``: normalised, numbers folded, compared.

Number words can name any number, so they are added up in Python's integers; every step is linear in the text but for the
digits of such a number.
"""
from __future__ import annotations

import re

UNITS = {"zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
         "ten": 10, "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16,
         "seventeen": 17, "eighteen": 18, "nineteen": 19, "twenty": 20, "thirty": 30, "forty": 40, "fifty": 50,
         "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90}
SCALES = {"hundred": 100, "thousand": 1000, "million": 1000000}
MARK = "\x01"  # leads a word that punctuation, not a space, split from the word before

_PRICE_COMMAS = re.compile(r"\$ *[0-9]*,(?:[0-9]*,)*")
_PRICE = re.compile(r"\$ *([0-9]+)")
_HOUR = re.compile(r"\b(?:0([0-9])|([1-9]?[0-9])):00\b")
_CLOCK = re.compile(r"\b(?:0([0-9])|([1-9]?[0-9])):(?:0([0-9])|([1-9][0-9]))\b")
_GROUPED = re.compile(r"([0-9]),([0-9]{3})")
_PUNCTUATION = re.compile("[^a-z0-9' ]+")
_OTHER = re.compile("[^a-z0-9']")
_STARTS = {m + w for m in ("", MARK) for w in ("a", *UNITS, *SCALES)}
_NUMBERS = _STARTS | {"and", MARK + "and"}
_STEP = 4_000  # digits; Python writes no more than 4,300 of a number at once
_LONG = 10 ** _STEP


def spelled(text: str) -> list[str]:
    """Words before folding; one that punctuation split from the word before is led by ``MARK``."""
    t = text.lower()
    for old, new in (("’", "'"), ("‘", "'"), ("—", " "), ("–", " "), (MARK, " ")):
        t = t.replace(old, new)
    t = " ".join(t.split())
    if "$" in t:
        t = _PRICE.sub(r"\1 dollars", _PRICE_COMMAS.sub(lambda m: m[0].replace(",", ""), t))
    if ":" in t:
        t = _CLOCK.sub(r"\1\2 \3\4", _HOUR.sub(r"\1\2", t))
    if "," in t:
        t = _GROUPED.sub(r"\1\2", t)
    # A run of punctuation becomes one mark; beside a space or at an end it is a space, between letters it glues.
    t = _PUNCTUATION.sub("\x02", t).replace(" \x02", " ").replace("\x02 ", " ").strip("\x02 ")
    return t.replace("\x02", " " + MARK).split()


def _digits(n: int) -> str:
    parts = []
    while n >= _LONG:
        n, low = divmod(n, _LONG)
        parts.append(str(low).zfill(_STEP))
    return "".join([str(n), *reversed(parts)])


def _kind(unit: int) -> str:
    return "ten" if unit >= 20 else "teen" if unit >= 10 else "unit"


def _fold_run(run: list[str]) -> list[str]:
    """Number words of one run to digits, everything else in it as it is."""
    bare = [w.removeprefix(MARK) for w in run]
    out, open_, total, cur, prev, mark = [], False, 0, 0, "", ""

    def close() -> None:
        if open_:
            out.append(mark + _digits(total + cur))

    for raw, w, nx in zip(run, bare, [*bare[1:], ""], strict=True):
        unit, scale, own = UNITS.get(w), SCALES.get(w), MARK if raw.startswith(MARK) else ""
        if scale is not None:
            if not open_:
                open_, total, cur, mark = True, 0, 0, own
            if scale == 100:
                cur = (cur or 1) * 100
            else:
                total, cur = total + (cur or 1) * scale, 0
            prev = "scale"
        elif open_ and w == "and" and prev in ("scale", "ten") and (nx in UNITS or nx in SCALES):
            continue
        elif unit is not None:
            kind = _kind(unit)
            if open_ and not (prev in ("unit", "teen") or prev == "ten" and kind != "unit"):
                cur += unit
            else:
                close()
                open_, total, cur, mark = True, 0, unit, own
            prev = kind
        elif w == "a" and nx in SCALES:
            close()
            open_, total, cur, prev, mark = True, 0, 0, "", own
        else:
            close()
            out.append(raw)
            open_, total, cur, prev, mark = False, 0, 0, "", ""
    close()
    return out


def marked(text: str | None) -> list[str] | None:
    """Words with numbers folded. Only runs of number words are folded one by one."""
    if text is None:
        return None
    words = spelled(text)
    out, done = [], 0
    for i in [i for i, w in enumerate(words) if w in _STARTS]:
        if i >= done:
            j = i + 1
            while j < len(words) and words[j] in _NUMBERS:
                j += 1
            out += words[done:i]
            out += _fold_run(words[i:j])
            done = j
    return out + words[done:] if done else words


def plain(words: list[str] | None) -> list[str] | None:
    return None if words is None else [w.replace(MARK, "") for w in words]


def _borders(words: list[str]) -> tuple[str, dict[int, str]]:
    """Letters, and after how many of them a word ends: g by punctuation alone, s by a space, d between two digits."""
    bodies, at, n, kind = [], {}, 0, "g"
    for w in words:
        if not w.startswith(MARK):
            kind = "s"
        body = _OTHER.sub("", w.replace(MARK, "").strip("'"))
        if body:
            if n:
                at[n] = "d" if bodies[-1][-1].isdigit() and body[0].isdigit() else kind
            bodies.append(body)
            n, kind = n + len(body), "g"
    return "".join(bodies), at


def split_only(a: list[str] | None, b: list[str] | None) -> bool | None:
    """Whether two marked word lists differ only where punctuation splits a word, never between two digits."""
    if a is None or b is None:
        return None
    if a == b:
        return True
    (la, at), (lb, bt) = _borders(a), _borders(b)
    return la == lb and all((at.get(i) or bt.get(i)) == "g" for i in at.keys() ^ bt.keys())


def verdict(a: str | None, b: str | None) -> str:
    """MATCH, MATCH (split), MISMATCH, or NOTHING COMPARED when a side is missing or holds no word."""
    x, y = marked(a), marked(b)
    if not x or not y:
        return "NOTHING COMPARED"
    if plain(x) == plain(y):
        return "MATCH"
    return "MATCH (split)" if split_only(x, y) else "MISMATCH"


def numbers(text: str | None) -> list[str] | None:
    words = plain(marked(text))
    return None if words is None else [w for w in words if w.isdecimal()]


def numbers_equal(a: str | None, b: str | None) -> bool | None:
    """Digit tokens agree exactly and in order; NULL when a side is NULL."""
    return None if a is None or b is None else a == b or numbers(a) == numbers(b)
