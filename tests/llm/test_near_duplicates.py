"""SimHash with covering hashing, and components."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from prismcube.llm import simhash
from prismcube.llm.components import components
from prismcube.llm.queries import op7_simhash
from tests.llm.helpers import documents, groups, no_documents


def plain_fingerprint(text, shingle=4):
    words = text.encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("shingle", [1, 4, 5])
def test_fingerprints(shingle):
    draw = random.Random(3)
    texts = ["", " \t\x0b", "One", "one two three", "a b c d", "A  b\nc\x0cd", "é É x y z", "a\xa0b c d e f"]
    texts += [" ".join(draw.choice("abcdefgh") for _ in range(n)) for n in (5, 6, 255, 256, 257, 600)]
    for text in texts:
        assert simhash.fingerprint(text, shingle) == plain_fingerprint(text, shingle)


@pytest.mark.parametrize(("radius", "level"), [(1, 0), (2, 0), (4, 0), (4, 1), (4, 2)])
def test_every_pair_within_the_radius_collides(radius, level):
    masks = simhash.masks(radius, level)
    assert len(masks) == 2 ** (radius + 1) - 1
    draw = np.random.default_rng(radius)
    chosen = itertools.combinations(range(64), radius) if radius <= 2 else (draw.choice(64, radius, replace=False) for _ in range(30_000))
    for bits in chosen:
        difference = sum(1 << int(b) for b in bits)
        assert any(not difference & m for m in masks)


def test_forest_connects_what_links_connect():
    draw = np.random.default_rng(1)
    members = np.unique(draw.integers(0, 1 << 12, 300, dtype=np.uint64))
    left, right = simhash.forest(members, 1)
    place = {int(m): i for i, m in enumerate(members)}
    edges = {(place[int(a)], place[int(b)]) for a, b in zip(left, right, strict=True)}
    assert all((int(a) ^ int(b)).bit_count() <= 1 for a, b in zip(left, right, strict=True)) and len(left) < len(members)
    whole = groups(len(members), lambda i, j: (int(members[i]) ^ int(members[j])).bit_count() <= 1)
    assert groups(len(members), lambda i, j: (i, j) in edges or (j, i) in edges) == whole


def test_components(spark):
    draw = random.Random(9)
    links = [(draw.randint(-50, 50), draw.randint(-50, 50)) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(300, 500)]
    nodes = sorted({x for link in links for x in link})
    place = {x: i for i, x in enumerate(nodes)}
    pairs = {(place[a], place[b]) for a, b in links}
    wanted = groups(len(nodes), lambda i, j: (i, j) in pairs or (j, i) in pairs)
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {x: nodes[w] for x, w in zip(nodes, wanted, strict=True) if nodes[w] != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_buckets_that_are_dealt_out_again(spark):
    """Over 2000 fingerprints that differ in few bits, with room for 16 in a bucket."""
    draw = np.random.default_rng(4)
    base = draw.integers(0, 1 << 63, 3, dtype=np.uint64)
    near = {int(b) ^ sum(1 << int(i) for i in draw.choice(18, draw.integers(0, 6), replace=False)) for b in base for _ in range(300)}
    far = {int(x) for x in draw.integers(0, 1 << 63, 200, dtype=np.uint64)}
    members = sorted(near | far)
    found = simhash.links(spark.createDataFrame([(m,) for m in members], "fp long"), 4, most=16).collect()
    assert all((r["a"] ^ r["b"]).bit_count() <= 4 for r in found)
    place = {m: i for i, m in enumerate(members)}
    edges = {(place[r["a"]], place[r["b"]]) for r in found}
    whole = groups(len(members), lambda i, j: (members[i] ^ members[j]).bit_count() <= 4)
    assert groups(len(members), lambda i, j: (i, j) in edges or (j, i) in edges) == whole


def test_groups_of_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [plain_fingerprint(r["text"] or "") for r in docs]
    top = groups(len(docs), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    got = {r["doc_id"]: r for r in op7_simhash(spark, folder).collect()}
    assert len(got) == len(docs)
    for r, p, t in zip(docs, prints, top, strict=True):
        assert got[r["doc_id"]]["fingerprint"] == f"{p:016x}"
        assert got[r["doc_id"]]["component_id"] == docs[t]["doc_id"]


def test_awkward_rows(spark):
    rows = sorted(simhash.near_duplicates(documents(spark)).collect(), key=repr)
    assert len(rows) == 10
    wordless = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in wordless} == {2, 3, 4} and {r["component_id"] for r in wordless} == {2}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] or 0, (r["text"] or "")[:7]) for r in kept.collect())
    # Of the two equal rows one stays, of the three texts without words the one with the smallest id.
    assert ids == [(0, "Words w"), (1, "The cat"), (2, ""), (4, "Another"), (5, "Ünïcödé"), (6, "long lo"), (7, "xxxxxxx")]
    assert simhash.one_of_each(no_documents(spark)).count() == 0
