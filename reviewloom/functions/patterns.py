"""Literals that a regular expression requires, for looking patterns up by them."""

from __future__ import annotations

import re

#: A bracket class, a quantifier, an escape, or any one character.
_ITEM = re.compile(r"\[\^?\]?(?:\\.|\[:\w+:\]|[^\]\\])*\]|[*+?]|\{\d+(?:,\d*)?\}|\\.|.", re.DOTALL)
#: Escapes that stand for one literal character; all others end a literal.
_PLAIN_ESCAPE = re.compile(r"\\[^a-zA-Z0-9]")
#: Settings and assertions, quotations, escapes that take what follows them, classes inside classes.
_UNREAD = re.compile(r"\(\?(?!:)|\\(?![bBdDwWsSAzZtnrfvhHGRX])[a-zA-Z0-9]|&&|\[[^\]]*\[")


def required_literals(pattern: str) -> list[str] | None:
    """Lower-case strings of which every match of the pattern, taken without regard to case, holds one; None if unknown.

    Each alternative at the top gives its longest run of plain characters. Groups, classes and what is optional give none, so
    an answer is never wrong, only missing. Patterns with settings of their own, quotations, classes inside classes or other
    than ASCII letters give none.
    """
    if _UNREAD.search(pattern):
        return None
    found, longest, run, depth = [], "", "", 0

    def ended() -> str:
        return max(longest, run, key=len)

    for item in _ITEM.findall(pattern):
        if item in ("(", ")"):
            longest, run = ended() if depth == 0 else longest, ""
            depth += 1 if item == "(" else -1
        elif depth:
            continue
        elif item == "|":
            found.append(ended())
            longest = run = ""
        elif item[0] in "*+?{" and len(item) == 1 or item[0] == "{" and len(item) > 1:
            # The character before may be missing, or be there several times.
            kept = run if item == "+" else run[:-1]
            longest, run = max(longest, kept, key=len), ""
        elif _PLAIN_ESCAPE.fullmatch(item):
            run += item[1]
        elif len(item) > 1 or item in ".^$\\":
            longest, run = ended(), ""
        elif item.isascii():
            run += item.lower()
        else:
            longest, run = ended(), ""
    found.append(ended())
    return sorted(set(found)) if depth == 0 and all(found) else None
