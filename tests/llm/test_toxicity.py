"""The pattern grammar, and held-out accuracy on the labelled documents."""

import math
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import SF, documents, frame, row, texts
from wardlake.llm import toxicity as tox

READER = tox.Reader({"idiot": 5.0, "vequ*": 4.0})


@pytest.mark.parametrize(
    "text, events",
    [
        ("a fine day", []),
        ("what an idiot", [{"I": 5.0}]),
        ("the word idiot is rude", [{"I": 5.0}]),
        ("you are an idiot", [{"I@": 5.0}]),
        ("You're such an idiot", [{"I@": 5.0}]),
        ("you idiot", [{"I@": 5.0}]),
        ("an idiot like you", [{"I": 5.0, "t=": 5.0}]),
        ("he is not an idiot", [{"I-": 5.0}]),
        ("you aren't an idiot", [{"I-": 5.0}]),
        ("you aren’t an idiot", [{"I-": 5.0}]),
        ("I don't think you are an idiot", [{"I-": 5.0}]),
        ("tu n'es idiot", [{"I-": 5.0}]),
        ("she said he is an idiot", [{"I'": 5.0}]),
        ("someone wrote \"idiot\" there", [{"I'": 5.0}]),
        ("not today. an idiot. nothing", [{"I": 5.0}]),
        ("vequille idiot; idiots", [{"I": 9.0}, {"I": 5.0}]),
        ("vequ idio", []),
        ("i will kill it", [{"V+": 1.0}]),
        ("will kill the process", [{"V+": 1.0}]),
        ("kill the process", [{"V": 1.0}]),
        ("you will hurt it", [{"V+": 1.0}]),
        ("I will kill you", [{"V+": 1.0, "t!": 1.0}]),
        ("I'll kill you", [{"V+": 1.0, "t!": 1.0}]),
        ("I won't kill you", [{"V-": 1.0}]),
        ("you should be shot", [{"V!": 1.0}]),
        ("ich werde dich töten", [{"V!": 1.0}]),
        ("te voy a matar", [{"V!": 1.0}]),
        ("he said he will kill you", [{"V'": 1.0}]),
        ("", []),
    ],
)
def test_clauses(text, events):
    assert READER.clauses(text) == events


def test_contractions_and_elisions_come_apart():
    assert tox.parts("won't") == ["will", "n't"] and tox.parts("you'll've") == ["you", "'ll", "'ve"]
    assert tox.parts("n’es") == ["n'", "es"] and tox.parts("plain") == ["plain"]


def run(transducer, symbols):
    state, out = transducer.start, []
    for symbol in symbols:
        state, result = transducer.arcs[state, symbol]
        out.append(result)
    return out


def test_composition_runs_like_one_after_another():
    """All four, over random strings of all classes."""
    rng = random.Random(3)
    symbols = ["o", "n", "r", "t", "p", "b", "k", "m", "q", "I", "V"]
    for _ in range(300):
        given = [rng.choice(symbols) for _ in range(rng.randrange(1, 14))]
        expected, known = given, symbols
        for part in (tox.negation, tox.report, tox.insult, tox.threat):
            transducer = part(known)
            expected, known = run(transducer, expected), transducer.outputs
        state, found = 0, []
        for symbol in given:
            state, event = tox.ARCS[state, symbol]
            found.append(event)
        assert found == expected
    assert {"I", "I-", "I'", "I@", "t=", "V", "V-", "V'", "V+", "V!", "t!"} == set(tox.EVENTS)


def test_events_keep_their_order_whatever_is_learned():
    """Weights learned from any labels: a step up never scores less, and more where it is a step from a bare occurrence."""
    rng = np.random.default_rng(5)
    ladders = (["I-", "I'", "I", "I@"], ["V", "V+", "V!"])
    for _ in range(20):
        texts = [[{rng.choice(tox.EVENTS): float(rng.uniform(1, 9))} for _ in range(rng.integers(0, 4))] for _ in range(200)]
        rows = np.array([tox.features(t) for t in texts])
        scorer = tox.Scorer({}, tox.fit_curve(rows, rng.integers(0, 2, 200).astype(float)))
        for ladder in ladders:
            scores = [scorer.score([]), *(scorer.score([{event: 4.0}]) for event in ladder)]
            assert scores == sorted(scores)
            assert scores[-1] > scores[1]


def test_beginnings_are_left_out_for_what_is_longer():
    counts = {"path*": (9, 9), "pathe*": (9, 9), "pathetic": (9, 9), "blix*": (9, 9), "blixa": (4, 4), "blixe": (5, 5)}
    assert tox.closed(counts) == {"pathetic", "blix*", "blixa", "blixe"}


@pytest.fixture(scope="module")
def scorer(spark):
    folder = str(SF).replace("sf0.001", "sf0.1")
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return tox.learn(rows, tox.labelled(spark.read.parquet(f"{folder}/labels.parquet")))


def test_scores_follow_the_grammar(scorer):
    reader = tox.Reader(scorer.lexicon)
    of = {text: scorer.score(reader.clauses(text)) for text in (
        "", "you are an idiot", "the word idiot is rude", "you aren't an idiot", "I don't think you are an idiot", "she said he is an idiot",
        "I will kill you", "will kill the process", "the path", "it is worth it", "das Wort", "what an idiot", "an idiot, a moron and a loser",
    )}
    assert of["you are an idiot"] > of["the word idiot is rude"] > of["she said he is an idiot"] >= of["you aren't an idiot"] >= of[""]
    assert of["I don't think you are an idiot"] == of["you aren't an idiot"] < 0.1
    assert of["I will kill you"] > 0.4 > 0.1 > of["will kill the process"]
    assert of["the path"] == of["it is worth it"] == of["das Wort"] == of[""]
    assert of["an idiot, a moron and a loser"] > of["what an idiot"] >= 0.7


def plain_score(lexicon, weights, text):
    """The whole score again, by regular expressions over a class string instead of transducers, for insults only."""
    total, best, many = weights[-1], [0.0] * 4, [0] * 4
    reader = tox.Reader(lexicon)
    for clause in re.split(r"[.!?;:\n]", text.lower()):
        classes = [c for token in tox.TOKEN.findall(clause) for c in reader.classify(token)]
        string = "".join(c for c, _ in classes)
        levels = {}
        for i, symbol in enumerate(string):
            if symbol == "I" and re.search(r"n[^nk]{0,2}(k[^nk]{0,3})*$", string[:i]):
                levels[i] = 0
            elif symbol == "I" and ("r" in string[:i] or string[:i].count("q") % 2):
                levels[i] = 1
        left = "".join("o" if i in levels else c for i, c in enumerate(string))
        sums = [0.0] * 4
        for i, (symbol, weight) in enumerate(classes):
            if symbol != "I":
                continue
            said_of = re.search(r"[tp][^Itpb]?(b[^Itp]{0,3})?$", left[:i])
            level = levels.get(i, 3 if said_of else 2)
            for k in range(level + 1):
                sums[k] += weight
            if level == 2 and re.match(r"[^Itp]?[tp]", left[i + 1 :]):
                weights_of = classes[max(j for j in range(len(classes)) if j <= i + 2 and string[j] == "I" and j >= i)][1]
                if string[i + 1 : i + 2] in ("t", "p"):
                    weights_of = weight
                for k in range(4):
                    sums[k] += weights_of
        for k in range(4):
            best[k] = max(best[k], sums[k])
            many[k] += sums[k] > 0
    n = len(tox.LEVELS)
    for k in range(4):
        total += weights[k] * math.log1p(best[k]) + weights[n + k] * math.log1p(many[k])
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, total))))


def test_whole_scores_equal_a_plain_version(spark, scorer):
    folder = str(SF).replace("sf0.001", "sf0.01")
    texts = [r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    rng = random.Random(8)
    some = ["you", "are", "an", "idiot", "not", "moron", "said", "word", "think", "he", "is", "\"", ".", "te", "loser", "don't"]
    texts += [" ".join(rng.choice(some) for _ in range(rng.randrange(1, 15))) for _ in range(1500)]
    texts = [t for t in texts if not any(w in tox.THREAT for w in tox.TOKEN.findall(t.lower()))]
    reader = tox.Reader(scorer.lexicon)
    wrong = [t for t in texts if abs(scorer.score(reader.clauses(t)) - plain_score(scorer.lexicon, scorer.weights, t)) > 1e-9]
    assert not wrong, wrong[:3]


def test_learning_finds_words_and_beginnings(spark):
    rows, labels = [], []
    for i in range(200):
        toxic = i % 4 == 0
        bad = ["zorgon", f"blix{'aeiou'[i % 5]}{i}"][i // 4 % 2] if toxic else f"plain{i}"
        rows.append(row(i, f"some words {bad} and more of them. nothing here"))
        labels.append((i, int(toxic)))
    docs = frame(spark, rows)
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = tox.toxicity(docs, marked)
    assert found.columns == ["doc_id", "held_out", "score", "predicted", "matched_clauses"]
    for r in found.collect():
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == int(r["doc_id"] % 4 == 0) == int(r["score"] >= 0.7)


def test_awkward_rows(spark):
    rows = documents(seed=6, groups=4)
    labels = spark.createDataFrame([(9003, 1), (9004, 0), (9003, 0), (None, 1), (9005, None)], "doc_id long, toxic int")
    found = tox.toxicity(frame(spark, rows), labels).collect()
    assert sorted((r["doc_id"] for r in found), key=repr) == sorted((i for i, _ in texts(rows)), key=repr)
    assert all(0 <= r["score"] <= 1 for r in found)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r["score"], r["predicted"]) for r in tox.toxicity(frame(spark, rows), none).collect()} == {(0.0, 0)}
    assert tox.toxicity(frame(spark, []), labels).count() == 0


def test_a_repeated_id_is_learned_from_once(spark, monkeypatch):
    rows, labels, seen = [], [], []
    for i in range(120):
        word = "zorgon" if i % 4 == 0 else f"plain{i}"
        rows.append((i, f"some words {word} and more of them"))
        labels.append((i, int(i % 4 == 0)))
    fitted = tox.fit_curve
    monkeypatch.setattr(tox, "fit_curve", lambda x, y, **more: seen.append(len(y)) or fitted(x, y, **more))
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = [spark.createDataFrame(r, "doc_id long, text string") for r in (rows, rows + [rows[0]] * 500 + [rows[1]] * 500)]
    once, again = (tox.learn(d, marked) for d in docs)
    assert seen == [120, 120] and once.lexicon == again.lexicon
    assert once.weights == pytest.approx(again.weights)
    tox.learn(docs[1], marked, sample_rows=50)
    assert seen[2] <= 50


def test_held_out_documents(spark):
    folder = str(SF).replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = tox.toxicity(docs, labels).where("held_out").join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id")
    counts = scored.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()
    n = {(r["toxic"], r["predicted"]): r["n"] for r in counts}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85  # the others hold none of the ten insults: label noise
    held = scored.where((F.col("toxic") == 1) & F.col("text").rlike(r"(?i)\b(idiot|moron|loser|scum|trash|clown|pathetic|stupid|worthless|disgusting)\b"))
    assert held.count() > 50 and held.where("predicted = 0").isEmpty()
    assert n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.01
