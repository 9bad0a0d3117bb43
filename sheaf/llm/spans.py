"""Patterns with fixed results: base spans of secrets and of personal data.

Each finder returns ``(start, end)`` pairs in code points, end exclusive, leftmost and
non-overlapping. All take time in proportion to the text, also on texts that are one
long run of digits or letters.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable

Span = tuple[str, int, int]

# -- secrets --------------------------------------------------------------------------
# fixed values: the base patterns
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")


def assignments(text: str) -> list[tuple[int, int]]:
    if ":" not in text and "=" not in text:
        return []
    return [m.span() for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]


def access_keys(text: str) -> list[tuple[int, int]]:
    if "AKIA" not in text:
        return []
    return [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]


def hex_runs(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in HEX.finditer(text)]


SECRETS: dict[str, Callable[[str], list[tuple[int, int]]]] = {
    "assign": assignments, "access": access_keys, "hex": hex_runs,
}

# -- personal data --------------------------------------------------------------------
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits that does not lead to a match does not lead to one from its middle either
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """From each @ to the left as far as a local part reaches, to the right as a domain."""
    found = []
    free = 0  # everything before is part of a match or cannot be in a local part
    at = text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at) if start < at else None
        free = at + 1
        if domain:
            free = domain.end()
            found.append((start, free))
        at = text.find("@", free)
    return found


def addresses(text: str) -> list[tuple[int, int]]:
    def small(part: str) -> bool:
        part = part.lstrip("0")
        return len(part) <= 3 and int(part or 0) <= 255

    if "." not in text:
        return []
    return [m.span() for m in IP.finditer(text) if all(map(small, m[0].split(".")))]


def passes_luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGITS.sub("", m[0])
            if 13 <= len(digits) <= 19 and passes_luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(NOT_DIGITS.sub("", m[0])) <= 15]


PERSONAL: dict[str, Callable[[str], list[tuple[int, int]]]] = {
    "email": emails, "ip": addresses, "card": cards, "phone": phones,
}


# -- both -----------------------------------------------------------------------------
def find(text: str, finders: dict[str, Callable[[str], list[tuple[int, int]]]]) -> list[Span]:
    """Spans of every kind, by kind as listed, then start."""
    return [(kind, a, b) for kind, finder in finders.items() for a, b in finder(text)]


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class InOrder:
    """Spans, asked for in the order of their places, so that all questions together take linear time."""

    def __init__(self, spans: list[Span]):
        self.spans = spans
        self._order = sorted(range(len(spans)), key=lambda k: spans[k][1])
        self._next = 0
        self._near: list[int] = []

    def touching(self, start: int, end: int) -> list[int]:
        """Places in ``spans`` of those that overlap; ``start`` must not fall from one call to the next."""
        while self._next < len(self._order) and self.spans[self._order[self._next]][1] < end:
            self._near.append(self._order[self._next])
            self._next += 1
        self._near = [k for k in self._near if self.spans[k][2] > start]
        return [k for k in self._near if self.spans[k][1] < end]


def replaced(text: str, spans: Iterable[Span], by: Callable[[str], str]) -> str:
    """The text with each span's characters replaced; overlapping spans are replaced together by the first."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], by(kind)]
        done = max(done, b)
    return "".join(out) + text[done:]
