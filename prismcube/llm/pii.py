"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text in a single pass:
at-signs, plus signs, digits, schemes and identifier cues. At each anchor a
local parser expands to the left and right by fixed character classes and
validates what it found. Nothing but the surroundings of anchors is looked at
twice, so the cost is that of the automaton.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from prismcube.llm.common import text_chunks, texts_of

#: Kinds in the order in which spans are listed; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "account", "ipv6", "login")
BASE_KINDS = KINDS[:4]

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Between a cue and what it names: blanks, a few marks, and a word for "number".
GAP = r"[ \t]{0,3}(?:number|no\.?|nr\.?|code)?[ \t]{0,3}[:#=]?[ \t]{0,3}"
SSN = re.compile(GAP + r"(?P<id>(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9-])", re.IGNORECASE)
IBAN = re.compile(GAP + r"(?P<id>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
ACCOUNT = re.compile(GAP + r"(?P<id>[0-9]{6,18})(?![0-9.])", re.IGNORECASE)
LOGIN = re.compile(r"[A-Za-z0-9._%+-]{1,64}:[^\s/@:]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
IPV6_MARKS = frozenset("0123456789abcdefABCDEF:")

CUES = {
    "ssn": ("ssn", "social security"),
    "iban": ("iban",),
    "account": ("account", "acct", "konto", "cuenta", "compte"),
}


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for mark, kind in {"@": "email", "+": "phone", "::": "ipv6", ":": "colon", "://": "login"}.items():
        found.add_word(mark, kind)
    for digit in "0123456789":
        found.add_word(digit, "digit")
    for kind, cues in CUES.items():
        for cue in cues:
            for form in (cue, cue.upper(), cue.capitalize(), cue.title()):
                found.add_word(form, kind)
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """Whether the digits pass the check sum of card numbers."""
    doubled = [2 * int(d) - 9 * (d > "4") for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def iban_valid(text: str) -> bool:
    compact = text.replace(" ", "")
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _is_octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


class _Parsers:
    """Expand the anchors of one text, left to right; ``spans`` holds what was valid."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
        self.done = dict.fromkeys(KINDS, 0)  # where the last match of a kind ended
        self.run_end = 0  # where the last run of hex digits and colons ended

    def digit(self, at: int) -> None:
        text = self.text
        if at and "0" <= text[at - 1] <= "9":
            return  # a run of digits is expanded from its first one
        if at >= self.done["ip"] and (m := DOTTED.match(text, at)):
            self.done["ip"] = m.end()
            if all(map(_is_octet, m.groups())):
                self.spans["ip"].append(m.span())
        if at >= self.done["card"] and (m := CARD.match(text, at)):
            self.done["card"] = m.end()
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                self.spans["card"].append(m.span())

    def email(self, at: int) -> None:
        domain = DOMAIN.match(self.text, at + 1)
        if not domain:
            return
        begin, least, text = at, self.done["email"], self.text
        while begin > least and text[begin - 1] in LOCAL_PART:
            begin -= 1
        if begin < at:
            self.done["email"] = domain.end()
            self.spans["email"].append((begin, domain.end()))

    def phone(self, at: int) -> None:
        if m := PHONE.match(self.text, at):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                self.spans["phone"].append(m.span())

    def named(self, kind: str, after: int) -> None:
        """An identifier that follows its cue."""
        m = {"ssn": SSN, "iban": IBAN, "account": ACCOUNT}[kind].match(self.text, after)
        if m and m.start("id") >= self.done[kind] and (kind != "iban" or iban_valid(m["id"])):
            self.done[kind] = m.end("id")
            self.spans[kind].append(m.span("id"))

    def login(self, after: int) -> None:
        if m := LOGIN.match(self.text, after):
            self.spans["login"].append(m.span())

    def ipv6(self, at: int) -> None:
        begin, end, text = at, at, self.text
        if at < self.done["ipv6"]:
            return
        while begin > max(self.done["ipv6"], at - 40) and text[begin - 1] in IPV6_MARKS:
            begin -= 1
        while end < min(len(text), at + 40) and text[end] in IPV6_MARKS:
            end += 1
        self.done["ipv6"] = end
        try:
            ipaddress.IPv6Address(text[begin:end])
        except ValueError:
            return
        if end - begin > 4 and any("0" <= c <= "9" for c in text[begin:end]):
            self.spans["ipv6"].append((begin, end))

    def colon(self, at: int) -> None:
        """An IPv6 address written in full: eight groups, in a run without two colons side by side."""
        begin, end, text = at, at, self.text
        if at < self.run_end:
            return  # a run is expanded from its first colon
        while begin > self.run_end and text[begin - 1] in IPV6_MARKS:
            begin -= 1
        while end < len(text) and text[end] in IPV6_MARKS:
            end += 1
        self.run_end = end
        # Letters and digits beside the run belong to a word, as in IPv6:2001:..., and so does the group they touch.
        if begin and text[begin - 1].isalnum():
            begin = text.index(":", begin)
        if end < len(text) and text[end].isalnum():
            end = text.rindex(":", 0, end) + 1
        if begin < end and text[begin] == ":":
            begin += 1
        if begin < end and text[end - 1] == ":":
            end -= 1
        run = text[begin:end]
        if run.count(":") != 7 or "::" in run or not any("0" <= c <= "9" for c in run):
            return
        if all(1 <= len(group) <= 4 for group in run.split(":")):
            self.spans["ipv6"].append((begin, end))


def find_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, in code points, end exclusive; added kinds never overlap a base span."""
    parsers = _Parsers(text)
    for end, kind in _anchors().iter(text):
        if kind == "digit":
            parsers.digit(end)
        elif kind == "email":
            parsers.email(end)
        elif kind == "phone":
            parsers.phone(end)
        elif kind == "ipv6":
            parsers.ipv6(end - 1)
        elif kind == "colon":
            parsers.colon(end)
        elif kind == "login":
            parsers.login(end + 1)
        else:
            parsers.named(kind, end + 1)
    spans = parsers.spans
    if any(spans[k] for k in KINDS[4:]):
        starts, ends = covered([s for k in BASE_KINDS for s in spans[k]])
        for kind in KINDS[4:]:
            spans[kind] = [(a, b) for a, b in spans[kind] if (i := bisect_right(ends, a)) == len(ends) or starts[i] >= b]
    return spans


def covered(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the spans cover, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def listed(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by kind, then start, joined by commas."""
    return ",".join(f"{kind}:{a}:{b}" for kind in kinds for a, b in sorted(spans[kind]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches):
        found = [find_spans(t) for t in texts_of(batch)]
        counts = [pa.array([len(s[k]) for s in found], pa.int64()) for k in BASE_KINDS]
        digests = [hashlib.sha256(listed(s, BASE_KINDS).encode()).hexdigest() for s in found]
        spans = [listed(s, KINDS) for s in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast("int64"), *counts, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"],
        )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of personal data for each row of ``docs``.

    Reads ``doc_id`` and ``text``; a NULL text is empty. Base kinds follow
    fixed patterns, leftmost and without overlap within a kind; the others
    need a cue or scheme beside them and are dropped where they overlap a
    base span.
    """
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return docs.select("doc_id", "text").mapInArrow(_rows, f"doc_id long, {counts}, base_sha256 string, spans string")
