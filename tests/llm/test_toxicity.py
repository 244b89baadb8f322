"""The subsequence kernel, the machine over it, and toxicity of documents."""

import itertools
import random
import zlib

import numpy as np
import pytest

from prismcube.llm import queries, toxicity
from tests.llm.helpers import documents, no_documents

LABELS = "doc_id long, label int"


def plain_profile(text):
    """All choices of letters in order, one by one."""
    letters = "".join(c if "a" <= c <= "z" else " " for c in text.lower())
    out = {}
    for i in range(len(letters)):
        for rest in itertools.combinations(range(i + 1, min(len(letters), i + toxicity.REACH)), toxicity.ORDER - 1):
            word = "".join(letters[k] for k in (i, *rest))
            if " " not in word:
                out[word] = out.get(word, 0) + toxicity.DECAY ** (rest[-1] - i + 1)
    return out


@pytest.mark.parametrize("text", ["", "abc", "idiot", "i d i o t", "A-b.c d1e", "aaaaaaa", "the quick brown fox"])
def test_profile_holds_every_sequence(text):
    wanted = plain_profile(text)
    coded = {tuple(ord(c) - 96 for c in u): v for u, v in wanted.items()}
    found = {tuple(u >> 5 * k & 31 for k in reversed(range(4))): v for u, v in toxicity.profile(text).items()}
    assert found.keys() == coded.keys() and all(abs(found[u] - v) < 1e-9 for u, v in coded.items())


def test_kernel_bears_gaps_and_letters_put_in():
    same = toxicity.kernel("idiot", "idiot")
    near = [toxicity.kernel(t, "idiot") / np.sqrt(toxicity.kernel(t, t) * same) for t in ("i d i o t", "id-iot", "idxiot", "IDIÓT")]
    far = [toxicity.kernel(t, "idiot") / np.sqrt(toxicity.kernel(t, t) * same) for t in ("station", "within", "editor")]
    assert min(near) > 2 * max(far) and abs(near[3] - 1) < 1e-9


def test_letters_of_other_scripts():
    codes = toxicity.coded("aZé ß9東\U0001f600")
    assert codes.tolist()[:4] == [1, 26, 5, 0] and codes[5] == 0 and codes[6] >= 27


def plain_decision(machine, text):
    codes, best = toxicity.coded(text).tolist(), machine.offset
    for begin in range(len(codes)):
        held = squares = 0.0
        for i in range(begin, min(begin + toxicity.STRETCH, len(codes))):
            for shape in itertools.combinations(range(1, toxicity.REACH), toxicity.ORDER - 1):
                places = [i, *(i + s for s in shape)]
                if places[-1] < len(codes) and all(codes[p] for p in places):
                    u = 0
                    for p in places:
                        u = u << 5 | codes[p]
                    held += toxicity.DECAY ** (shape[-1] + 1) * machine.weights[u]
                    squares += toxicity.DECAY ** (2 * (shape[-1] + 1))
        own = held / np.sqrt(max(squares, toxicity.LEAST_SQUARES)) + machine.offset
        best = own if begin == 0 else max(best, own)
    return max(best, machine.offset)


def test_decisions_against_brute_force(monkeypatch):
    landmarks = toxicity.Landmarks.of(["idiot", "trash", "thing", "station"])
    machine = toxicity.Machine(landmarks.weights(np.array([1.0, 0.7, -0.4, -0.3])), -0.5)
    texts = ["", "ab", "a thing of trash", "you i d i o t", "xx " * 9 + "stationing trash idiots and things", "z" * 40]
    wanted = [plain_decision(machine, t) for t in texts]
    assert np.allclose(machine.decision(texts), wanted, atol=1e-6)
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert np.allclose(machine.decision(texts), wanted, atol=1e-6)
    assert machine.decision([]).tolist() == []
    assert np.allclose(machine.decision(["the", "idiot", "", "trash"] * 3), [machine.decision([t])[0] for t in ["the", "idiot", "", "trash"] * 3])


def test_machine_equals_landmark_kernels():
    """The weights of sequences say the same as kernels with landmarks, whitened and weighted."""
    landmarks = toxicity.Landmarks.of(["idiot", "moron", "others", "another", "ab"])
    assert landmarks.words == ["idiot", "moron", "others", "another"]
    own = landmarks.strength.T @ landmarks.strength
    assert np.allclose(landmarks.whitening @ own @ landmarks.whitening, np.eye(4), atol=1e-6)
    weights = np.array([0.3, -1.0, 2.0, 0.5])
    machine = toxicity.Machine(landmarks.weights(landmarks.whitening @ weights), 0.25)
    codes = toxicity.coded("the idiots and other morons")
    for at, got in enumerate(machine.stretches(codes)):
        kernels = landmarks.kernels(codes, at, min(at + toxicity.STRETCH, len(codes)))
        assert abs(kernels @ landmarks.whitening @ weights + 0.25 - got) < 1e-5


def test_support_vectors_reach_the_least_loss():
    draw = np.random.default_rng(2)
    labels = np.where(draw.random(400) < 0.2, 1, -1)
    rows = draw.normal(0, 1, (400, 5)) + 0.8 * labels[:, None]
    w, b = toxicity.support_vectors(rows, labels, 1.0)
    side = np.where(labels > 0, 400 / (2 * (labels > 0).sum()), 400 / (2 * (labels < 0).sum()))

    def loss(w, b):
        return 0.5 * w @ w + (side * np.maximum(0, 1 - labels * (rows @ w + b)) ** 2).sum()

    least = loss(w, b)
    assert all(least <= loss(w + draw.normal(0, s, 5), b + draw.normal(0, s)) for s in (1e-3, 1e-2, 0.1) for _ in range(50))


def made(n, seed):
    """Documents of made-up words, of which a fifth holds an insult, often pulled apart."""
    draw = random.Random(seed)
    syllables = ["tha", "er", "on", "tion", "ing", "re", "st", "ha", "ou", "en", "ble", "an"]
    rows = []
    for i in range(n):
        words = ["".join(draw.choice(syllables) for _ in range(draw.randint(1, 3))) for _ in range(draw.randint(20, 90))]
        toxic = int(draw.random() < 0.2)
        if toxic:
            insult = draw.choice(["idiot", "moron", "stupid", "scumbag"])
            words.insert(draw.randrange(len(words)), draw.choice([insult, insult.upper() + "!!", " ".join(insult), "-".join(insult), insult[:2] + "x" + insult[2:]]))
        rows.append((i, " ".join(words) + ".", toxic))
    return rows


def test_held_out_documents_and_pulled_apart_insults(spark):
    rows = made(1500, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], LABELS)
    machine = toxicity.train(docs, labels)
    fresh = made(600, 2)
    scores = machine.probability(machine.decision([t for _, t, _ in fresh]))
    toxic = np.array([y for _, _, y in fresh]) == 1
    assert (scores[toxic] >= 0.5).mean() > 0.85 and (scores[~toxic] < 0.5).mean() > 0.97
    again = toxicity.train(docs.repartition(7), labels.repartition(2))
    assert np.allclose(machine.weights, again.weights) and machine.scale == pytest.approx(again.scale)


def test_query_learns_only_from_its_fold(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op11_toxicity(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert queries.toxic_labels(spark, folder).where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").count() == 0
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    flagged = [toxic[r["doc_id"]] for r in rows if r["predicted"] and r["doc_id"] in toxic]
    assert len(flagged) >= 15 and sum(flagged) >= 0.9 * len(flagged)


def test_awkward_rows(spark):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(1, 1), (1, 1), (6, 0), (2, 0), (None, 1), (7, None), (99, 1), (3, 5)], LABELS)
    docs = documents(spark)
    machine = toxicity.train(docs, labels)
    scored = toxicity.score_toxicity(docs.withColumn("held_out", F.lit(False)), machine).collect()
    assert len(scored) == 10 and all(0 <= r["score"] <= 1 for r in scored)
    assert len({r["score"] for r in scored if r["doc_id"] == 1}) == 1
    wordless = {r["score"] for r in scored if r["doc_id"] in (2, 3)}
    assert len(wordless) == 1
    # Nothing stands out where all labels are alike: the smoothed share of toxic ones.
    alike = toxicity.train(docs, labels.where("label = 0"))
    assert alike.probability(alike.decision(["you idiot", ""])).tolist() == pytest.approx([1 / 4] * 2)
    nothing = toxicity.train(docs, labels.limit(0))
    assert nothing.probability(nothing.decision(["you idiot", ""])).max() < 1e-9
    assert toxicity.score_toxicity(no_documents(spark).withColumn("held_out", F.lit(True)), machine).count() == 0
    assert toxicity.train(no_documents(spark), labels).scale == 0
