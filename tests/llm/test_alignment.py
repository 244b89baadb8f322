"""Alignment of two tokenizers against a plain walk over both."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from prismcube.llm import alignment
from prismcube.llm.queries import op13_token_alignment
from tests.llm.helpers import ROWS, documents, no_documents

FIRST, SECOND = public_tokenizers.path(alignment.BYTE_LEVEL), public_tokenizers.path(alignment.PIECES)
TEXTS = [
    None, "", " ", "  lead", "\n line", "a  b   c ", "x▁y", "'s 't don't", "<|endoftext|> a<s></s><unk>", "x" * 3000, "東京都" * 40,
    "\U0001f600 é́ ﬁ a\xa0b", "a\x00b\r\nc\td", "ÀÉß 12,345.67 --- (ok)", " ".join("word%d" % i for i in range(300)),
]


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(FIRST, SECOND)


@pytest.fixture(scope="module")
def plain():
    first, second = Tokenizer.from_file(FIRST), sentencepiece.SentencePieceProcessor(model_file=SECOND)
    first.encode_special_tokens = True
    letters = alignment.byte_alphabet()

    def second_bytes(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(text):
        """Groups of ids, by walking both sides a token at a time."""
        if not text:
            return []
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        raw = (" " + text).encode()
        own = [bytes(letters[c] for c in first.id_to_token(i)) for i in a], [second_bytes(i) for i in b]
        if b"".join(own[0]) != raw or b"".join(own[1]) != raw:
            return []
        out, i, j, at = [([], [])], 0, 0, [0, 0]
        while i < len(a) or j < len(b):
            if at[0] <= at[1] and i < len(a):
                out[-1][0].append(a[i])
                at[0] += len(own[0][i])
                i += 1
            else:
                out[-1][1].append(b[j])
                at[1] += len(own[1][j])
                j += 1
            if at[0] == at[1] and out[-1][0] and out[-1][1]:
                out.append(([], []))
        return out[:-1]

    return groups


def digests(texts, groups):
    """Every document's row but its id, by counting links one by one."""
    each = [groups(t) for t in texts]
    links = [Counter((x, y) for xs, ys in g for x in xs for y in ys) for g in each]
    counts = Counter(p for c in links for p in c)
    highest = {}
    for (x, _), n in counts.items():
        highest[x] = max(highest.get(x, 0), n)
    out = []
    for g, c in zip(each, links, strict=True):
        shown = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in g)
        out.append((
            sum(len(xs) for xs, _ in g), sum(len(ys) for _, ys in g), len(g), c.total(),
            sum(n for p, n in c.items() if counts[p] == highest[p[0]]), sum(n * counts[p] for p, n in c.items()),
            hashlib.sha256(shown.encode()).hexdigest() if g else "",
        ))
    return out


def test_bytes_of_tokens(pair):
    assert sorted(alignment.byte_alphabet().values()) == list(range(256))
    assert pair.first_bytes[pair.tokenizer.token_to_id("Ġthe")] == b" the" and pair.by_word
    assert sorted(b for i, b in enumerate(pair.second_bytes) if pair.second.is_byte(i)) == [bytes([i]) for i in range(256)]


def test_shared_cuts_against_sets():
    draw = np.random.default_rng(1)
    for share in (0.0, 0.02, 0.5, 1.0):
        sizes = draw.integers(1, 400, 12)
        first = np.cumsum(draw.integers(1, 5, sizes.sum()))
        second = np.unique(np.concatenate((first[draw.random(len(first)) < share], first[draw.random(len(first)) < 0.4] + 1, first[np.cumsum(sizes) - 1])))
        ends = np.cumsum(sizes)
        cut = alignment.shared_cuts(first, second, ends - sizes, ends)
        assert cut.tolist() == np.isin(first, second).tolist()
    none = np.zeros(0, dtype=np.int64)
    assert alignment.shared_cuts(none, none, none, none).tolist() == []


def test_no_end_is_looked_up_twice(monkeypatch):
    first, second = np.arange(1, 2001) * 2, np.concatenate((np.arange(1, 4000, 2), [4000]))
    seen = []
    search = np.searchsorted
    monkeypatch.setattr(alignment.np, "searchsorted", lambda a, v, *rest, **named: (seen.extend(v.tolist()), search(a, v, *rest, **named))[1])
    alignment.shared_cuts(first, second, np.array([0]), np.array([2000]))
    assert len(seen) == len(set(seen)) == 2000


@pytest.mark.parametrize("large", [1, 4096])
@pytest.mark.parametrize("held", [50, 1 << 22])
def test_groups_and_links_of_texts(pair, plain, monkeypatch, large, held):
    monkeypatch.setattr(alignment, "LARGE_GROUP", large)
    monkeypatch.setattr(alignment, "HELD_LINKS", held)
    texts = [t or "" for t in TEXTS]
    found = alignment.aligned(pair, texts)
    of, pairs, times = alignment.linked_pairs(found, 32_000)
    for k, (text, shown) in enumerate(zip(texts, alignment.shown_groups(pair, found), strict=True)):
        wanted = plain(text)
        assert shown == ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in wanted)
        links = Counter(x * 32_000 + y for xs, ys in wanted for x in xs for y in ys)
        assert dict(zip(pairs[of == k].tolist(), times[of == k].tolist(), strict=True)) == links


def test_texts_are_encoded_as_a_whole(pair):
    """Word by word or not, the ids are those of whole texts, by both."""
    draw = random.Random(6)
    pieces = [" ", " ", " ", "  ", "\n", " \n", "\t", "a", "the", "'s", "é", "東", "　", "12", "!!", "\U0001f600", "<|endoftext|>", "Ġ", ",", "don't", "ÀÉß", "ª", "▁", "</s>"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(1, 25))) for _ in range(3000)]
    tokenizer = Tokenizer.from_file(FIRST)
    tokenizer.encode_special_tokens = True
    found = [pair.encode_both(texts[i : i + 100]) for i in range(0, len(texts), 100)]
    first, second = ([ids for chunk in found for ids in chunk[side]] for side in (0, 1))
    spelled = 0
    for text, a, b in zip(texts, first, second, strict=True):
        whole = tokenizer.encode(" " + text, add_special_tokens=False).ids, pair.second.encode(text)
        if pair._spells(*whole, text):
            spelled += 1
            assert (a.tolist(), b.tolist()) == whole, text
        else:
            assert len(a) == len(b) == 0
    assert 1000 < spelled < 3000


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_awkward_texts(spark, plain, most):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a null id"), (3, "a null id"), (3, "a null id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as pair", "2 as n", "3 as row", "4 as n_a").repartition(3)
    got = sorted((tuple(r) for r in alignment.alignment_digests(frame, most=most).collect()), key=repr)
    assert got == sorted(((i, *d) for (i, _), d in zip(rows, digests([t for _, t in rows], plain), strict=True)), key=repr)


def test_awkward_rows(spark, plain):
    got = sorted((tuple(r) for r in alignment.alignment_digests(documents(spark)).collect()), key=repr)
    assert got == sorted(((i, *d) for (i, *_), d in zip(ROWS, digests([t for _, t, *_ in ROWS], plain), strict=True)), key=repr)
    assert alignment.alignment_digests(no_documents(spark)).count() == 0
    assert alignment.align_documents(no_documents(spark)).count() == 0


def test_aligned_documents(spark, plain):
    rows = list(enumerate(TEXTS))
    for r in alignment.align_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        groups, a, b = [], 0, 0
        for x, y in zip(r["first_ends"], r["second_ends"], strict=True):
            groups.append((r["first_ids"][a:x], r["second_ids"][b:y]))
            a, b = x, y
        assert groups == plain(TEXTS[r["doc_id"]]) and (a, b) == (len(r["first_ids"]), len(r["second_ids"]))


def test_query_against_brute_force(spark, plain):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = [tuple(r) for r in op13_token_alignment(spark, folder).orderBy("doc_id").collect()]
    assert got == [(r["doc_id"], *d) for r, d in zip(docs, digests([r["text"] for r in docs], plain), strict=True)]
