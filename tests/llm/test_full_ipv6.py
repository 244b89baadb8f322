"""IPv6 addresses that are written in full."""

import pytest

from prismcube.llm import pii

FULL = "2001:0db8:85a3:0001:0000:8a2e:0370:7334"


@pytest.mark.parametrize(
    "text",
    ["{}", "at {} there", "[{}]:80", "IPv6:{}", "node:{}", "host={}/64", "see {}: down", "({}).", "{}:up", "a::1 and {}", "{}, 12:30:45"],
)
def test_full_addresses_are_found(text):
    begin = text.index("{}")
    assert (begin, begin + len(FULL)) in pii.find_spans(text.format(FULL))["ipv6"]


@pytest.mark.parametrize(
    "text",
    ["12:30:45", "00:1a:2b:3c:4d:5e", ":".join(["aa"] * 22), ":".join(["1a"] * 22), "a:b:c:d:e:f:a:b", f"{FULL}:1", f"{FULL}0", f"{FULL}g", "1:2:3:4:5:6:7", ":" * 20],
)
def test_other_runs_are_not(text):
    assert pii.find_spans(text)["ipv6"] == []


def test_several_addresses_and_short_forms():
    text = f"{FULL} {FULL.upper()} 1:2:3:4:5:6:7:8 2001:db8::1"
    found = [text[a:b] for a, b in sorted(pii.find_spans(text)["ipv6"])]
    assert found == text.split()
