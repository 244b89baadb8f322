"""M-trees and decontamination against brute force."""

import numpy as np
import pytest
from conftest import plan

from prismcube.llm import decontamination as deco
from prismcube.llm import mtree
from prismcube.llm.queries import op6_decontamination
from tests.llm.helpers import documents, no_documents

VECTOR = "vec_id long, embedding array<float>"


def plain_top(rows, every=20, k=20):
    usable = [(i, np.floor(64 * np.array(v, dtype=np.float32).astype(float))) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for a, (i, q) in enumerate(usable):
        if i is None or i % every:
            continue
        scored = []
        for b, (j, x) in enumerate(usable):
            if a != b:
                n = min(len(q), len(x))
                scored.append((-int(q[:n] @ x[:n]), j if j is not None else mtree.NO_ID))
        for rank, (s, j) in enumerate(sorted(scored)[:k], 1):
            out.append((i, rank, None if j == mtree.NO_ID else j, -s))
    return sorted(out, key=repr)


def test_tree_finds_what_brute_force_finds():
    draw = np.random.default_rng(0)
    centres = draw.normal(0, 1, (12, 16))
    vectors = np.floor(64 * (centres[draw.integers(0, 12, 3000)] + draw.normal(0, 0.1, (3000, 16))))
    vectors[500:900] = vectors[500]
    ids = draw.permutation(3000)
    tree = mtree.MTree(ids, vectors)
    assert sum(len(p.objects) for p in tree.pages if p.children is None) == 3000
    assert max(len(p.objects) for p in tree.pages) <= mtree.LEAF
    assert sorted(zip(tree.ids.tolist(), map(tuple, tree.vectors), strict=True)) == sorted(zip(ids.tolist(), map(tuple, vectors), strict=True))
    ids, vectors = tree.ids, tree.vectors
    for place in (0, 1, 500, 700, 2999):
        scores = vectors @ vectors[place]
        order = [i for i in np.lexsort((ids, -scores)) if i != place][:20]
        found, got = tree.search(vectors[place], 20, place)
        assert found.tolist() == ids[order].tolist() and got.tolist() == scores[order].tolist()


def test_tree_covers_its_pages():
    draw = np.random.default_rng(1)
    tree = mtree.MTree(np.arange(2000), np.floor(draw.normal(0, 60, (2000, 8))))

    def below(number):
        page = tree.pages[number]
        return page.objects if page.children is None else np.concatenate([below(c) for c in page.children])

    for page in tree.pages:
        for routing, radius, child in zip(page.objects, page.radii, page.children, strict=True) if page.children else ():
            assert tree._distances(int(routing), below(child)).max() <= radius + 1e-9
            assert np.allclose(tree.pages[child].parent_distances, tree._distances(int(routing), tree.pages[child].objects))


def test_top_products_of_awkward_vectors(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(x) for x in draw.integers(-3, 4, 4) / 8]) for i in range(60)]
    rows += [(i, [0.25, 0.25, 0.25, 0.25]) for i in range(100, 140)]
    rows += [(20, [0.1, 0.2, 0.3, 0.4]), (20, [0.1, 0.2, 0.3, 0.4]), (200, None), (220, [0.1, None]), (240, [float("nan")]), (260, [float("inf")])]
    rows += [(None, [0.5, 0.5, 0.5, 0.5]), (280, []), (300, [1.0]), (320, [0.5] * 6)]
    df = spark.createDataFrame(rows, VECTOR).selectExpr("*", "'clash' as score", "1 as rank", "2 as part")
    found = mtree.top_products(df, block=16)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_top(rows)


def test_queries_meet_trees_without_the_driver(spark):
    # Copies of queries, one per tree, were small by Spark's estimate and therefore broadcast.
    draw = np.random.default_rng(4)
    rows = [(i, [float(x) for x in draw.integers(-8, 9, 6) / 16]) for i in range(300)]
    df = spark.createDataFrame(rows, VECTOR)
    found = mtree.top_products(df, every=5, k=7, block=32)
    text = plan(found)
    assert "CartesianProduct" in text and "Broadcast" not in text
    assert sorted(map(tuple, found.collect()), key=repr) == plain_top(rows, 5, 7)
    small_groups = mtree.top_products(df, every=5, k=7, block=32, group=4)
    assert sorted(map(tuple, small_groups.collect()), key=repr) == plain_top(rows, 5, 7)


def test_search_leaves_out_what_is_below_the_floor():
    draw = np.random.default_rng(5)
    vectors = np.floor(draw.normal(0, 4, (3000, 6)))
    tree = mtree.MTree(np.arange(3000), vectors)
    for place in (0, 7, 2999):
        every, scores = tree.search(tree.vectors[place], 20, place)
        for floor in (scores[-1], scores[5], scores[0], scores[0] + 1, 1e9):
            found, got = tree.search(tree.vectors[place], 20, place, floor)
            assert found.tolist() == every[scores >= floor].tolist() and got.tolist() == scores[scores >= floor].tolist()


def test_top_products_of_few_or_no_vectors(spark):
    rows = [(0, [0.5]), (1, [0.25]), (2, [-0.5])]
    found = mtree.top_products(spark.createDataFrame(rows, VECTOR))
    assert sorted(map(tuple, found.collect())) == [(0, 1, 1, 512), (0, 2, 2, -1024)]
    assert mtree.top_products(spark.createDataFrame(rows[:1], VECTOR)).count() == 0
    assert mtree.top_products(spark.createDataFrame([], VECTOR)).count() == 0


def plain_distance(pattern, text):
    """Least edit distance of a word list to any part of another."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (p != t)))
    return min(row)


def whole_distance(a, b):
    row = list(range(len(b) + 1))
    for i, p in enumerate(a, 1):
        last, row = row, [i]
        for j, t in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (p != t)))
    return row[-1]


def test_closest_part():
    draw = np.random.default_rng(3)
    for _ in range(300):
        pattern = draw.integers(0, 4, draw.integers(1, 80)).tolist()
        text = draw.integers(0, 4, draw.integers(0, 100)).tolist()
        best, end = deco.closest(pattern, text)
        assert best == plain_distance(pattern, text)
        back, size = deco.closest(pattern[::-1], text[:end][::-1], anchored=True)
        assert back == best == whole_distance(pattern, text[end - size : end])


def test_walks_of_equal_windows_are_equal():
    words = np.arange(100, 160, dtype=np.uint64)
    both = np.concatenate((words, [np.uint64(7)], words))
    ends = np.repeat([60, 121], [60, 61])
    for keys in deco.walk_keys(both, ends, 0, 3):
        assert (keys[:60] == keys[61:]).all() and len(set(keys[:60].tolist())) > 20  # walks that begin side by side may meet


def made_corpus(seed, edits):
    draw = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    common = [" ".join(draw.choice(vocabulary[:20], 30)) for _ in range(2)]
    items = [draw.choice(vocabulary, n).tolist() for n in draw.integers(1, 60, 60)]
    docs = []
    for i in range(240):
        text = draw.choice(vocabulary, draw.integers(20, 200)).tolist()
        if i % 2:
            item = list(items[int(draw.integers(len(items)))])
            for _ in range(int(len(item) * edits)):
                at = int(draw.integers(len(item)))
                item[at : at + 1] = [[], ["new"], ["new", item[at]]][int(draw.integers(3))]
                item = item or ["new"]
            at = int(draw.integers(len(text)))
            text[at:at] = item
        docs.append((i, " ".join(text) + ". " + common[i % 2]))
    return docs, [(k, " ".join(words)) for k, words in enumerate(items)]


@pytest.mark.parametrize(("edits", "least"), [(0.0, 1.0), (0.1, 0.98), (0.2, 0.95)])
def test_matches_against_brute_force(spark, edits, least):
    docs, items = made_corpus(int(edits * 10), edits)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = deco.find_contamination(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    wanted = {}
    for i, text in docs:
        words = text.replace(".", "").split()
        for k, item in items:
            distance = plain_distance(item.split(), words)
            if distance <= deco.edits_allowed(len(item.split()), deco.SIMILARITY):
                wanted[i, k] = distance
    got = {(r["doc_id"], r["item_id"]): r for r in found}
    assert len(got) == len(found) and set(got) <= set(wanted)
    assert len(got) >= least * len(wanted)
    exact = {key for key, d in wanted.items() if d == 0}
    assert exact <= set(got) and all(got[key]["distance"] == 0 for key in exact)
    texts = dict(docs)
    for (i, k), r in got.items():
        part = texts[i].replace(".", "").split()[r["first_word"] : r["end_word"]]
        assert whole_distance(items[k][1].split(), part) == r["distance"] >= wanted[i, k]


def test_case_punctuation_and_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(deco, "PASS_WORDS", 5)
    items = [(1, "Alpha beta, gamma delta!"), (2, "one two three four five six"), (3, "ALPHA (beta) gamma - delta"), (None, "x"), (4, None), (5, "...")]
    docs = [(10, "so alpha BETA gamma... delta is here"), (11, "one two three four five six"), (12, "x"), (13, None)]
    found = deco.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(10, 1), (10, 3), (11, 2)]
    clean = deco.without_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r["doc_id"] for r in clean.collect()) == [12, 13]


def test_awkward_rows(spark):
    items = spark.createDataFrame([(1, "the dog watched"), (2, "")], "item_id long, text string")
    docs = documents(spark)
    found = deco.find_contamination(docs, items)
    assert sorted((r["doc_id"], r["item_id"], r["first_word"]) for r in found.collect()) == [(1, 1, 7), (1, 1, 7)]
    clean = deco.without_contamination(docs, items)
    assert clean.columns == docs.columns and clean.count() == 8
    assert deco.find_contamination(no_documents(spark), items).count() == 0
    assert deco.find_contamination(docs, items.limit(0)).count() == 0
    assert deco.without_contamination(docs, items.limit(0)).count() == 10


def test_benchmark_passages_are_found(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    found = {(r["doc_id"], r["item_id"]) for r in op6_decontamination(spark, folder).collect()}
    assert found >= {(d["doc_id"], b["item_id"]) for d in docs for b in items if b["text"] in d["text"]}
