"""Language id, quality classifier, URL models."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from prismcube.llm import language_id, quality, queries, url_model
from prismcube.llm.common import word_hashes
from tests.llm.helpers import documents, no_documents

SMALL = "/root/testdata/sf0.001"


def plain_words(text, marks):
    out, kind = [], None
    for byte in text.encode():
        c = chr(byte) if byte < 128 else "a"
        k = 0 if c in " \t\n\x0b\x0c\r" else 1 if byte < 128 and byte > 32 and not c.isalnum() and byte < 127 else 2
        if k == 1 and marks == "dropped":
            k = 0
        if k == 1 and marks == "inside":
            k = 2
        if k and k == kind:
            out[-1] += bytes([byte])
        elif k:
            out.append(bytes([byte]))
        kind = k
    return [w.lower() for w in out]


@pytest.mark.parametrize("marks", ["inside", "apart", "dropped"])
def test_word_hashes_are_those_of_the_words(marks):
    texts = ["", "One two, TWO  one!!", " ", "é ÉÉ,x\ty", "a" * 500, "two\n\none"]
    hashes, counts = word_hashes([t.encode() for t in texts], marks)
    words = [w for t in texts for w in plain_words(t, marks)]
    assert counts.tolist() == [len(plain_words(t, marks)) for t in texts]
    by_word = {}
    for word, h in zip(words, hashes.tolist(), strict=True):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_grams_are_those_of_runs_of_letters():
    texts = ["Ab, c", "", "1 2", "ab c", "abc"]
    found = language_id.gram_buckets(texts)
    assert [c.tolist() for _, c in found] == [[3, 0, 0, 3, 3], [5, 0, 0, 5, 4], [4, 0, 0, 4, 3]]
    for buckets, counts in found:
        parts = np.split(buckets, np.cumsum(counts)[:-1])
        assert parts[0].tolist() == parts[3].tolist()
    assert found[1][0][:5].tolist() != found[1][0][-4:].tolist()


def test_language_of_held_out_documents(spark):
    rows = queries.op1_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(lang)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)


def plain_mix(x):
    for _ in range(2):
        x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 % (1 << 64)
    return x ^ x >> 32


def plain_grams(text):
    """Buckets of the n-grams of a text, one by one."""
    symbols = [0]
    for c in (text or "").lower():
        if c.isalpha():
            symbols.append(ord(c))
        elif symbols[-1]:
            symbols.append(0)
    symbols += [0] if symbols[-1] else []
    out = []
    for n in language_id.LENGTHS if len(symbols) > 1 else ():
        for i in range(len(symbols) - n + 1):
            if n == 1 and not symbols[i]:
                continue
            rolling = 0
            for k in range(n):
                rolling = (rolling * 0x100000001B3 + symbols[i + k] + k + 1) % (1 << 64)
            out.append(plain_mix(rolling) >> 64 - language_id.BUCKET_BITS)
    return out


def test_language_query_against_plain_naive_bayes(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()
    grams = {r["doc_id"]: Counter(plain_grams(r["text"])) for r in docs}
    learned = [r for r in docs if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    counts, rows = {}, Counter(r["lang"] for r in learned)
    for r in learned:
        counts.setdefault(r["lang"], Counter()).update(grams[r["doc_id"]])
    size = 1 << language_id.BUCKET_BITS
    total = {k: c.total() + language_id.SMOOTHING * size for k, c in counts.items()}
    got = {r["doc_id"]: r for r in queries.op1_language_id(spark, SMALL).collect()}
    assert got.keys() == grams.keys()
    for i, own in grams.items():
        if not own:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        logs = {
            k: math.log(rows[k] / rows.total()) + sum(n * math.log((c[g] + language_id.SMOOTHING) / total[k]) for g, n in own.items())
            for k, c in counts.items()
        }
        best = max(logs, key=logs.get)
        assert got[i]["lang_pred"] == best
        assert got[i]["score"] == pytest.approx(1 / sum(math.exp(x - logs[best]) for x in logs.values()), abs=2e-3)


def plain_ftrl(rows, options):
    """Follow the regularised leader, weight by weight."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= options.l1:
            return 0.0
        step = (options.beta + math.sqrt(n.get(i, 0.0))) / options.alpha + options.l2
        return -(z[i] - math.copysign(options.l1, z[i])) / step

    for _ in range(options.passes):
        for row, label in rows:
            w = {i: weight(i) for i in row}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(w[i] * x for i, x in row.items())))))
            for i, x in row.items():
                g = (p - label) * x
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / options.alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_quality_query_against_plain_ftrl(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", F.xxhash64("doc_id").alias("place")).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    bias = 1 << quality.BUCKET_BITS

    def row(text):
        buckets, counts = quality.features([text or ""])
        scale = float(np.sqrt(max(1, counts[0])))
        return {int(b): np.float32(k / scale) for b, k in Counter(buckets.tolist()).items()} | {bias: 1.0}

    learned = sorted((r["place"], row(r["text"]), labels[r["doc_id"]]) for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["doc_id"] in labels)
    weights = plain_ftrl([(x, y) for _, x, y in learned], quality.Ftrl())
    got = {r["doc_id"]: r for r in queries.op10_quality(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for r in docs:
        total = sum(weights.get(i, 0.0) * float(x) for i, x in row(r["text"]).items())
        assert got[r["doc_id"]]["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-4)


def test_language_ignores_labels_of_what_it_predicts(spark):
    docs = documents(spark).select("doc_id", "text", "lang")
    model = language_id.train(docs)
    changed = docs.withColumn("lang", F.lit("xx"))
    a = language_id.identify(docs.withColumn("held_out", F.lit(False)), model)
    b = language_id.identify(changed.withColumn("held_out", F.lit(False)), model)
    assert sorted(a.collect(), key=repr) == sorted(b.collect(), key=repr)


def test_language_of_awkward_rows(spark):
    docs = queries.held_out(documents(spark), 4, 2)
    rows = language_id.identify(docs, language_id.train(docs)).collect()
    assert len(rows) == 10
    by_id = {(r["doc_id"], r["lang_pred"]) for r in rows}
    assert {(2, "und"), (3, "und"), (4, "und"), (6, "en"), (1, "en")} <= by_id
    assert all(0 <= r["score"] <= 1 for r in rows)
    empty = queries.held_out(no_documents(spark), 4, 2)
    model = language_id.train(empty)
    assert language_id.identify(empty, model).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, model).collect()} == {"und"}


def test_quality_of_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in queries.op10_quality(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert r["predicted"] == (r["score"] >= 0.5)
    held = [r for r in labels if rows[r["doc_id"]]["held_out"]]
    assert sum(rows[r["doc_id"]]["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)


def test_quality_learns_from_bounded_sample_in_any_partitioning(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = queries.quality_labels(spark, SMALL)
    a = quality.train(docs, labels, most=50)
    b = quality.train(docs.repartition(7), labels.repartition(3), most=50)
    assert np.array_equal(a, b) and np.count_nonzero(a)


def test_quality_of_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (6, 0), (7, None), (99, 1), (None, 1)], "doc_id long, label int")
    weights = quality.train(docs, labels)
    scored = quality.score_quality(queries.held_out(docs, 3, 1), weights).collect()
    assert len(scored) == 10 and all(0 <= r["score"] <= 1 for r in scored)
    kept = quality.keep_good(docs, weights)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in scored)
    nothing = quality.train(no_documents(spark), labels)
    assert not nothing.any()
    assert quality.score_quality(queries.held_out(no_documents(spark), 3, 1), nothing).count() == 0


URLS = [
    ("https://A.Example.ORG/en/12?x", "a.example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/es/", "example.org", "/es/", "example.org/es/", "block"),
    ("x://badexample.org/es/1", "badexample.org", "/es/1", "org/", "allow"),
    ("http://www.org", "www.org", "", None, None),
    ("http://shop.com/fr/1#a", "shop.com", "/fr/1", "com/fr/", "allow"),
    ("http://com/de/#a", "com", "/de/", "com/de/", "block"),
    ("http://x.com?u=http://y.org/", "x.com", "", None, None),
    ("HTTP://É.org/://b", "É.org", "/://b", "org/", "allow"),
    ("no scheme.org/", "", "", None, None),
    (None, "", "", None, None),
    ("", "", "", None, None),
    ("http://", "", "", None, None),
]


def test_rules_of_urls(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, (u, *_) in enumerate(URLS)], "page_id long, url string, verdict string")
    rows = url_model.filter_urls(pages.drop("verdict")).orderBy("page_id").collect()
    for row, (_, host, path, rule, verdict) in zip(rows, URLS, strict=True):
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == (verdict or row["verdict"]) and row["verdict"] in ("allow", "block")
    assert url_model.filter_urls(pages).count() == len(URLS)
    assert url_model.filter_urls(pages.limit(0)).count() == 0


def plain_scores(learned, texts):
    """The same models with contexts in dictionaries."""
    counts = {"allow": {}, "block": {}}
    for t, verdict in learned:
        s = b"\x02" * url_model.ORDER + t + b"\x03"
        own = counts[verdict]
        for i in range(url_model.ORDER, len(s)):
            for k in range(url_model.ORDER + 1):
                for key in ((k, s[i - k : i]), (k, s[i - k : i], s[i])):
                    own[key] = own.get(key, 0) + 1

    def likelihood(own, text):
        s, total = b"\x02" * url_model.ORDER + text + b"\x03", 0.0
        for i in range(url_model.ORDER, len(s)):
            p = 1 / 257
            for k in range(url_model.ORDER + 1):
                n = own.get((k, s[i - k : i]), 0)
                p = (own.get((k, s[i - k : i], s[i]), 0) + url_model.BACKOFF * p) / (n + url_model.BACKOFF)
            total += np.log(p)
        return total

    return [(likelihood(counts["allow"], t) - likelihood(counts["block"], t)) / (len(t) + 1) if t else 0.0 for t in texts]


def taught(texts):
    return [(t, verdict) for t, verdict in texts if zlib.crc32(t) % url_model.FOLDS]


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_url_scores_against_plain_contexts(spark, most):
    """All URLs of a table, with the contexts broadcast and joined."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").unionByName(
        spark.createDataFrame([(-1, None, "h"), (-2, "", "h"), (-3, "http://É.org/" + "x" * 5000, "h")], "page_id long, url string, html string")
    )
    rows = pages.select("page_id", url_model.model_text(F.col("url"), url_model.host_and_path(F.col("url"))[0]).alias("said")).collect()
    got = {r["page_id"]: r for r in url_model.filter_urls(pages, most=most).collect()}
    assert len(got) == len(rows)
    texts = {r["page_id"]: r["said"].encode() for r in rows}
    learned = taught([(texts[i], r["verdict"]) for i, r in got.items() if r["rule"]])
    wanted = dict(zip(texts, plain_scores(learned, texts.values()), strict=True))
    assert all(r["score"] == pytest.approx(wanted[i], abs=1e-9) for i, r in got.items())
    judged = [i for i, r in got.items() if r["rule"] is None]
    threshold = url_model.train(url_model.judged_by_rules(pages), most)[1]
    assert all(got[i]["verdict"] == ("allow" if wanted[i] >= threshold else "block") for i in judged)


def test_contexts_never_share_a_name():
    draw = random.Random(4)
    texts = [bytes(draw.choice(b"ab\x00\x02\x03\xff") for _ in range(draw.randint(0, 9))) for _ in range(4000)]
    found, _ = url_model.contexts(texts)
    seen = {}
    at = 0
    for t in texts:
        s = b"\x02" * url_model.ORDER + t + b"\x03"
        for i in range(url_model.ORDER, len(s)):
            for k, (context, joint) in enumerate(found):
                assert seen.setdefault(int(context[at]), (k, s[i - k : i])) == (k, s[i - k : i])
                assert seen.setdefault(int(joint[at]), (k, s[i - k : i], s[i])) == (k, s[i - k : i], s[i])
            at += 1


def test_threshold_divides_best():
    assert url_model.best_threshold([(True, 10, 5), (True, 12, 5), (False, 2, 5), (False, 4, 1)]) == pytest.approx(0.07)
    assert url_model.best_threshold([(True, 3, 1)]) == 0.0


def test_url_models_tell_held_out_labels(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = url_model.filter_urls(pages).where("rule is not null").collect()
    threshold = url_model.train(url_model.judged_by_rules(pages))[1]
    right = sum((r["score"] >= threshold) == (r["verdict"] == "allow") for r in rows)
    assert right >= 0.9 * len(rows)
