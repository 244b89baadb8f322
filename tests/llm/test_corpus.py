"""Token shards, source mixing, and the pipeline."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from prismcube.llm import mixing, queries, wavelet
from prismcube.llm.common import written
from tests.llm.helpers import ROWS, documents, groups, no_documents
from tests.llm.test_near_duplicates import plain_fingerprint

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# --- Token shards ---------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 63, 64, 5000, 70_000])
def test_matrix_answers_like_the_plain_list(n, monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 1 << 10)
    draw = np.random.default_rng(n)
    ids = draw.choice([0, 1, 7, 7, 7, 1000, 40_000, 50_256], n).astype(np.uint32)
    shard = wavelet.Shard(wavelet.pack(ids, [3, None], np.array([n, 0]), 16))
    assert (shard.decode() == ids).all()
    assert shard.documents()[0] == [3, None] and shard.documents()[1].tolist() == [n, 0]
    for i in draw.integers(0, n, 30).tolist():
        assert shard.access(i) == ids[i]
    for token in (0, 7, 2, 50_256, 65_535, 70_000):
        places = np.flatnonzero(ids == token)
        a, b = sorted(draw.integers(0, n + 1, 2).tolist())
        assert shard.count(token) == len(places) and shard.count(token, a, b) == ((places >= a) & (places < b)).sum()
        for k in draw.integers(0, len(places), 5).tolist() if len(places) else ():
            assert shard.select(token, k) == places[k]
        if len(places) < 300:
            assert shard.occurrences(token) == places.tolist()
    with pytest.raises(IndexError):
        shard.access(n)
    with pytest.raises(IndexError):
        shard.select(2, 0)


def test_words_are_encoded_as_in_their_text():
    draw = random.Random(6)
    pieces = [" ", " ", " ", "  ", "\n", " \n", "\t", "a", "the", "'s", "é", "東", "　", "\x1c", "​", "12", "!!", "\U0001f600", "<|endoftext|>", "Ġ", "x" * 300, ",", "#.", "don't", "'ll", "ÀÉß", "ŉ", "ª", "a_b", "ɐ", "\n\n"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 25))) for _ in range(3000)]
    encoder = wavelet.Encoder(VOCABULARY)
    encoder.WORDS = 200
    plain = Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)
    for i in range(0, len(texts), 100):
        got = encoder.encode(texts[i : i + 100])
        assert [g.tolist() for g in got] == [p.ids for p in plain[i : i + 100]]


def test_letters_are_encoded_once_for_all_marks():
    texts = ["a stone stone, stone. stone\nstone\nstone; Stone", "stone! Ġstone stone), straße straße."]
    encoder, seen = wavelet.Encoder(VOCABULARY), []
    encoder.tokenize = lambda text, real=encoder.tokenize: seen.append(text) or real(text)
    plain = [p.ids for p in Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)]
    assert [g.tolist() for g in encoder.encode(texts)] == plain
    assert seen.count("Ġstone") == seen.count("stone") == 1 and len(seen) == len(set(seen))
    encoder.RUNS = 1
    encoder._forget()
    assert [g.tolist() for g in encoder.encode(texts)] == plain
    assert max(map(len, encoder.runs.values())) == 1


def test_a_distinct_word_is_looked_up_once_for_all_texts():
    class Counted(wavelet._Numbers):
        asked = 0

        def __getitem__(self, word):
            Counted.asked += 1
            return super().__getitem__(word)

    encoder = wavelet.Encoder(VOCABULARY)
    encoder.places = Counted()
    texts = ["so stone, and stone; or stone\nand stone 12 |" + " stone, or 12" * 200] * 3
    plain = Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)
    assert [g.tolist() for g in encoder.encode(texts)] == [p.ids for p in plain]
    # stone, and, or, 12 and |; and behind a line end; and no mark, a comma, a semicolon.
    assert sorted(encoder.places) == sorted(["stone", "and", "or", "12", "|", "\nand", "\n", "\n,", "\n;"])
    assert Counted.asked == len(encoder.places)


def test_lines_and_marks_are_encoded_as_in_their_text():
    draw = random.Random(7)
    pieces = ["\n", "\n", " ", " ", "stone", "Straße", "東", "'s", "don't", "ª", "12", ",", ").", "%%%", "_", "|", "\t", "\r", "\x85", "\u2028", "\x1c", "<|endoftext|>"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 12))) for _ in range(20_000)]
    plain = Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)
    encoder = wavelet.Encoder(VOCABULARY)
    assert [g.tolist() for g in encoder.encode(texts)] == [p.ids for p in plain]


def test_extended_keeps_what_was_held():
    held, whole = np.zeros(0, dtype=np.int64), []
    for n in (3, 0, 1, 40, 2, 500):
        before, more = held, np.arange(n)
        held = wavelet.extended(held, more)
        assert before.tolist() == whole
        whole += more.tolist()
        assert held.tolist() == whole and held.dtype == np.int64


def plain_places(rows):
    """``doc_id, start, n_tokens, crc`` of ``(doc_id, text)`` in the given order."""
    tokenizer, start, out = Tokenizer.from_file(VOCABULARY), 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_places_of_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    rows = queries.op2_token_shards(spark, folder).orderBy("start").collect()
    assert [tuple(r) for r in rows] == plain_places([tuple(d) for d in docs])


def test_awkward_documents_in_small_shards(spark, tmp_path):
    wavelet.write_shards(documents(spark), str(tmp_path / "s"), shard_ids=50)
    shards = spark.read.parquet(str(tmp_path / "s"))
    assert shards.where("n_tokens > 50 and n_docs > 1").count() == 0 and shards.count() > 3
    rows = [tuple(r) for r in wavelet.read_documents(shards).orderBy("start").collect()]
    assert [r[0] for r in rows] == sorted((r[0] for r in ROWS), key=lambda i: (i is not None, i))
    alone = sorted((plain_places([(i, t)])[0] for i, t, *_ in ROWS), key=repr)
    assert sorted(((i, 0, n, c) for i, _, n, c in rows), key=repr) == alone
    assert [r[1] for r in rows] == [sum(r[2] for r in rows[:i]) for i in range(len(rows))]
    row = shards.where("n_docs > 1").first()
    shard = wavelet.Shard(row["payload"])
    assert shard.count(0) >= row["n_docs"]
    assert wavelet.encode_documents(no_documents(spark)).count() == 0


# --- Mixing ---------------------------------------------------------------


def plain_targets(sizes, weights=(3, 1, 2), share=1.5):
    """Share by weight and share the excess again, until nothing is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        level = left / max(1, sum(weight[s] for s in open_))
        above = [s for s in open_ if level * weight[s] >= 2 * sizes[s]]
        if not above:
            return full | {s: level * weight[s] for s in open_}
        for s in above:
            full[s] = 2 * sizes[s]
            left -= full[s]


def words(text):
    return len((text or "").encode().split())


def held_against_plain(rows, docs, alike=True):
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + words(text)
    targets = plain_targets(sizes)
    assert len(rows) == len(docs)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    same_id = {}
    for i, text, source in docs:
        same_id[i, source] = (same_id.get((i, source), 0) if alike else 0) + words(text)
    for (i, _, source), n in zip(docs, (same_id[i, s] for i, _, s in docs), strict=True):
        largest[source] = max(largest[source], n)
    by_key = {}
    for i, text, source in docs:
        by_key.setdefault((i, words(text)), []).append(source)
    for r in rows:
        source = by_key[r["doc_id"], r["size"]].pop()
        assert r["source_size"] == sizes[source] and math.isclose(r["target"], targets[source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= largest[source]


def test_mix_of_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows = queries.op9_source_mix(spark, folder).collect()
    held_against_plain(rows, docs)
    assert sorted(rows) == sorted(queries.op9_source_mix(spark, folder).collect())


def test_mix_where_one_source_holds_almost_all(spark):
    draw = random.Random(8)
    rows = [(i, "w " * draw.randint(0, 30), None, "a" if i % 50 else draw.choice(["b", "c", None]), 0) for i in range(2000)]
    got = mixing.mix_sources(documents(spark, rows)).collect()
    held_against_plain(got, [(i, t, s) for i, t, _, s, _ in rows])


def test_mix_of_awkward_rows(spark):
    rows = mixing.mix_sources(documents(spark)).collect()
    assert len(rows) == 10
    assert {r["taken"] for r in rows if r["doc_id"] == 2} == {0}
    assert len({r["taken"] for r in rows if r["doc_id"] == 1}) == 1
    assert mixing.mix_sources(no_documents(spark)).count() == 0
    docs = documents(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = mixing.mix_copies(docs).agg({"copies": "sum"}).first()[0]
    assert mixed.count() == copies
    assert mixing.mixed_documents(no_documents(spark)).count() == 0


def test_document_hash_is_that_of_id_and_text(spark):
    rows = [(1, "a"), (1, "b"), (None, "é"), (None, None)]
    got = spark.createDataFrame(rows, "doc_id long, text string").select(mixing.document_hash(F.col("doc_id"), F.col("text"))).collect()
    plain = [f"{'' if i is None else i}:{t or ''}" for i, t in rows]
    assert [r[0] for r in got] == [int(hashlib.md5(p.encode()).hexdigest()[:15], 16) for p in plain]


def test_mix_where_ids_are_missing_or_repeated(spark):
    """Half of a source has no id and a third of the rest one id; texts tell them apart."""
    rows = [(None if i % 2 else (7 if i % 3 else i), f"w{i} " + "x " * (2 * (i % 17) + (i % 5 == 0)), None, "a" if i % 5 else "b", 0) for i in range(900)]
    got = mixing.mix_sources(documents(spark, rows)).collect()
    held_against_plain(got, [(i, t, s) for i, t, _, s, _ in rows], alike=False)


def test_mixed_documents_with_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "c", "s")], "doc_id long, text string, source string")
    docs = docs.withColumns({c: F.lit(c) for c in ("whole", "below", "row", "col", "_mix_source", "_mix_copy")})
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.select("whole", "row").distinct().collect() == [("whole", "row")]


# --- Pipeline -------------------------------------------------------------


def test_stages_against_plain_versions(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "tokens"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, before, folder), name)
        kept[name] = (before.collect(), docs.collect())
        assert name == "tokens" or docs.columns == columns

    before, after = kept["quality"]
    accepted = {r["doc_id"] for r in queries.op10_quality(spark, folder).where("predicted = 1").collect()}
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if r["doc_id"] in accepted)

    before, after = kept["near_dedup"]
    before.sort(key=lambda r: r["doc_id"])
    prints = [plain_fingerprint(r["text"]) for r in before]
    top = groups(len(before), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert sorted(r["doc_id"] for r in after) == sorted({before[t]["doc_id"] for t in top})

    before, after = kept["decontamination"]
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    dirty = {r["doc_id"] for r in before if any(i in r["text"] for i in items)}
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == dirty

    before, after = kept["mixing"]
    sizes = {}
    for r in before:
        sizes[r["source"]] = sizes.get(r["source"], 0) + words(r["text"])
    taken = dict.fromkeys(sizes, 0)
    for r in after:
        taken[r["source"]] += words(r["text"])
    longest = {s: max(words(r["text"]) for r in before if r["source"] == s) for s in sizes}
    assert all(abs(taken[s] - t) <= longest[s] for s, t in plain_targets(sizes).items())
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}

    before, after = kept["tokens"]
    before.sort(key=lambda r: r["doc_id"])
    after.sort(key=lambda r: r["start"])
    assert [tuple(r) for r in after] == plain_places([(r["doc_id"], r["text"]) for r in before])
    assert sorted(corpus_pipeline.run(spark, folder).collect()) == sorted(after)


def test_stages_of_awkward_rows(spark, tmp_path):
    for name, rows in (("benchmark", [(1, "the dog watched")]), ("labels", [(1, 1, 0), (6, 0, 0)])):
        schema = "item_id long, text string" if name == "benchmark" else "doc_id long, quality int, toxic int"
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        docs = documents(spark)
        assert stage(spark, docs, str(tmp_path)).columns[0] == "doc_id"
        stage(spark, docs, str(tmp_path)).collect()
        assert stage(spark, no_documents(spark), str(tmp_path)).count() == 0
