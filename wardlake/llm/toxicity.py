"""Operator 8: toxicity by a weighted finite-state pattern grammar over clauses.

Texts are cut into words, contractions and elisions apart ("aren't" is "are" and "n't", "n'es" is
"n'" and "es"), and words are read as classes: learned insults, and fixed lists of threat verbs, targets,
object pronouns, forms of "be", modal verbs, verbs of belief, negations and words of reported speech.
Four small transducers, each with a state, rewrite the class string of a clause, each reading what
the one before wrote:

* *negation* marks insults and threat verbs up to three words after a negation; a verb of belief
  within that reach ("don't think ...") passes it on;
* *report* marks what stands between quotes or behind a reporting verb;
* *insult* tells insults that are said of somebody (right behind a target, or behind a target and a form of
  "be", or with a target right after) from those that only occur;
* *threat* tells threat verbs behind a modal, and those of them that are aimed at somebody: a target or
  object pronoun between or after, an object pronoun before, or a passive with a target as its subject.

``compose`` makes one transducer of them. Its events have levels: an insult is negated, reported,
bare or targeted, a threat is a mere verb, one with a modal, or a targeted one. For each level the strongest
clause that reaches it and the number of such clauses enter a logistic curve, with weights of at least 0.
An event counts on all levels up to its own, so a targeted insult never scores less than a bare one,
nor that less than a reported or a negated one, whatever the labels are; each step up from a bare
occurrence adds at least a little. Where the labels show no targeted threat, one weighs as much as makes a
document undecided.

What is learned, from at most ``sample_rows`` labelled rows (those with the least hash of their id, and
of several texts of an id one): insults, which are words, and beginnings shared by several words, that toxic documents hold
far more often than others; and the curve's weights. Beginnings whose documents are those of one longer
beginning or word are left out for it, so "pathetic" does not make an insult of "path". A
learned word also matches with an ending of ``ENDINGS``. The share of toxic documents an insult needs
bounds their number. Only the text is an input.

Defined cases: NULL and empty texts match nothing and get the score of a text without
matches; repeated rows each give a row; NULL ids take no part in learning; without labels
of both kinds every score is the prior 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from wardlake.llm.common import give_back, id_and_text, tidy, written

SAMPLE_ROWS = 20_000
THRESHOLD = 0.7
ROWS = 512  # texts that are Python objects at a time
STEM = range(4, 8)  # lengths of word beginnings that may be insults
# An insult is in so many toxic documents (at least, and as a share of them), and so much likelier there.
LEAST_DOCS, LEAST_SHARE, LEAST_ODDS = 5, 0.005, 3.5
REACH = 3  # words over which a negation or a modal verb holds

# Words of the classes, in English, German, French and Spanish.
NEGATION = frozenset(
    "not no never neither nor cannot without hardly n't nicht kein keine keinen nie ohne ne n' pas jamais sans ni nunca sin".split()
)
REPORT = frozenset(
    "said says say saying called calls wrote writes quoted quotes claimed claims reported reports according alleged "
    "sagte sagt schrieb laut dit disait selon dijo dice escribió según".split()
)
TARGET = frozenset(
    "you your yours yourself u he she him her they them everyone people those guys du dein deine ihr sie tu toi ton ta "
    "vous votre vos tú ti usted ustedes ellos".split()
)
OBJECT = frozenset("dich dir euch t' te os le".split())
BE = frozenset("is are am was were be been being 're 'm 's get got bin bist ist sind seid war wirst es est suis êtes sont eres soy son".split())
BELIEF = frozenset("think believe say mean suppose consider glaube denke meine pense crois creo pienso".split())
THREAT = frozenset(
    "kill kills killed hurt destroy beat beaten shoot shot stab stabbed burn burnt hang hanged strangle murder murdered crush punch töten "
    "umbringen tuer frapper matar morir golpear".split()
)
MODAL = frozenset(
    "will 'll would shall should must gonna going want deserve deserves hope werde werden wird vais allez va voy vas vamos".split()
)
ENDINGS = ("s", "es", "e", "en", "er", "n")
CONTRACTED = {"ca": "can", "wo": "will", "sha": "shall"}
SUFFIXES = ("'re", "'m", "'s", "'ve", "'ll", "'d")
TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n]|[\"“”«»]")
QUOTES = frozenset("\"“”«»")
STOPS = frozenset(".!?;:\n")


def parts(word: str) -> list[str]:
    """A lower-case word without its contractions and elisions, and these."""
    if "'" not in word and "’" not in word:
        return [word]
    word = word.replace("’", "'")
    if word.endswith("n't"):
        return [CONTRACTED.get(word[:-3], word[:-3]), "n't"]
    for suffix in SUFFIXES:
        if word.endswith(suffix):
            return [*parts(word[: -len(suffix)]), suffix]
    before, _, rest = word.partition("'")
    return [before + "'", *parts(rest)]


# Symbols: o other, n negation, r report, t target, p object pronoun, b form of be, k belief, m modal, q quote
# mark, I insult, V threat verb. Marks behind I and V: "-" negated, "'" reported, "@" said of a target, "+"
# with a modal, "!" aimed at a target. A target that completes a pattern becomes "t=" or "t!".
Arc = tuple[object, str]


class Transducer:
    """A deterministic transducer: ``arcs[state, symbol] = (next state, output symbol)``."""

    def __init__(self, start: object, arcs: dict[tuple[object, str], Arc]):
        self.start, self.arcs = start, arcs

    @classmethod
    def reachable(cls, start: object, symbols: list[str], step) -> Transducer:
        """All arcs from the start by ``step(state, symbol)``."""
        arcs, seen, queue = {}, {start}, [start]
        while queue:
            state = queue.pop()
            for symbol in symbols:
                arcs[state, symbol] = after, _ = step(state, symbol)
                if after not in seen:
                    seen.add(after)
                    queue.append(after)
        return cls(start, arcs)

    @property
    def outputs(self) -> list[str]:
        return sorted({out for _, out in self.arcs.values()})

    def compose(self, other: Transducer) -> Transducer:
        """The transducer that feeds this one's outputs to the other."""

        def step(state, symbol):
            mine, out = self.arcs[state[0], symbol]
            theirs, result = other.arcs[state[1], out]
            return (mine, theirs), result

        symbols = sorted({symbol for _, symbol in self.arcs})
        return Transducer.reachable((self.start, other.start), symbols, step)

    def numbered(self) -> dict[tuple[int, str], tuple[int, str]]:
        """Its arcs with the states as numbers, the start as 0."""
        number = {self.start: 0}
        for state, _ in self.arcs:
            number.setdefault(state, len(number))
        return {(number[s], a): (number[t], b) for (s, a), (t, b) in self.arcs.items()}


def negation(symbols: list[str]) -> Transducer:
    def step(left: int, symbol: str) -> Arc:
        if symbol == "n" or symbol == "k" and left:
            return REACH + (symbol == "k"), symbol
        marked = symbol + "-" if left and symbol in "IV" else symbol
        return max(0, left - 1), marked

    return Transducer.reachable(0, symbols, step)


def report(symbols: list[str]) -> Transducer:
    def step(state: tuple[bool, bool], symbol: str) -> Arc:
        quoted, said = state
        if symbol == "q":
            return (not quoted, said), symbol
        if symbol == "r":
            return (quoted, True), symbol
        return state, symbol + "'" if symbol in ("I", "V") and (quoted or said) else symbol

    return Transducer.reachable((False, False), symbols, step)


def insult(symbols: list[str]) -> Transducer:
    nothing, target, predicate, said = range(4)  # what the last words were

    def step(state: tuple[int, int], symbol: str) -> Arc:
        phase, left = state
        if symbol in ("t", "p"):
            return (target, 2), "t=" if phase == said else symbol
        if symbol == "b" and phase == target:
            return (predicate, REACH + 1), symbol
        if symbol == "I":
            return ((nothing, 0), "I@") if phase in (target, predicate) else ((said, 2), "I")
        return ((phase, left - 1) if left > 1 else (nothing, 0)), symbol

    return Transducer.reachable((nothing, 0), symbols, step)


def threat(symbols: list[str]) -> Transducer:
    def step(state: tuple[int, bool, bool, str, int, int], symbol: str) -> Arc:
        # Words a modal still holds for; whether an aim, or a passive, came since; the last target or
        # pronoun and the words it holds for; the words for which a threat waits for its target.
        modal, aimed, passive, last, near, waits = state
        out = symbol
        if symbol in ("t", "p", "t="):
            if waits and symbol != "t=":
                out, waits = "t!", 0
            aimed = aimed or modal > 0
            return (max(0, modal - 1), aimed, passive, "p" if symbol == "p" else "t", REACH, max(0, waits - 1)), out
        if symbol == "m":
            return (REACH + 2, near > 0 and last == "p", False, last, max(0, near - 1), 0), out
        if symbol == "b" and modal:
            passive = True
        if symbol == "V" and modal:
            subject = passive and last == "t"
            out = "V!" if aimed or subject else "V+"
            return (0, False, False, last if near else "", max(0, near - 1), 0 if out == "V!" else REACH), out
        modal, waits, near = max(0, modal - 1), max(0, waits - 1), max(0, near - 1)
        return (modal, aimed and modal > 0, passive and modal > 0, last if near or modal else "", near, waits), out

    return Transducer.reachable((0, False, False, "", 0, 0), symbols, step)


def grammar() -> Transducer:
    """The four transducers as one."""
    whole = negation(["o", "n", "r", "t", "p", "b", "k", "m", "q", "I", "V"])
    for part in (report, insult, threat):
        whole = whole.compose(part(whole.outputs))
    return whole


GRAMMAR = grammar()
ARCS = GRAMMAR.numbered()
# The level of each event in its family; every step up is more toxic.
INSULTS = {"I-": 0, "I'": 1, "I": 2, "I@": 3, "t=": 3}
THREATS = {"V-": 0, "V'": 0, "V": 0, "V+": 1, "V!": 2, "t!": 2}
FAMILIES = (INSULTS, THREATS)
EVENTS = [out for out in GRAMMAR.outputs if out in INSULTS or out in THREATS]
LEVELS = [(family, level) for family in FAMILIES for level in range(max(family.values()) + 1)]
# Penalties of the levels' weights: what is negated or reported, or a mere verb, takes the least of a common weight.
PENALTIES = [5.0 if level < (2 if family is INSULTS else 1) else 0.3 for family, level in LEVELS]
LEAST_STEP = 0.05  # the least weight of the levels above the lowest


OTHER = [("o", 0.0)]  # one object for nearly all words


class Reader:
    """Texts to the events of their clauses, for one lexicon of insults (word or beginning: weight)."""

    def __init__(self, lexicon: dict[str, float]):
        self.whole = {k: w for k, w in lexicon.items() if not k.endswith("*")}
        self.stems = {k[:-1]: w for k, w in lexicon.items() if k.endswith("*")}
        self.seen: dict[str, list[tuple[str, float]]] = {}

    def classify(self, token: str) -> list[tuple[str, float]]:
        """Classes and weights of a lower-case token's parts; a bounded number is remembered."""
        if token not in self.seen:
            if len(self.seen) >= 100_000:
                self.seen.clear()
            found = [self._classify(word) for word in parts(token)]
            self.seen[token] = OTHER if found == OTHER else found
        return self.seen[token]

    def _insult(self, word: str) -> float:
        found = [self.whole.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in STEM if len(word) > n)]
        found += [self.whole.get(word[: -len(e)], 0.0) for e in ENDINGS if word.endswith(e) and len(word) > len(e) + 2]
        return max(found)

    def _classify(self, word: str) -> tuple[str, float]:
        for words, symbol in (
            (THREAT, "V"), (NEGATION, "n"), (REPORT, "r"), (OBJECT, "p"), (TARGET, "t"), (BE, "b"), (BELIEF, "k"), (MODAL, "m"),
            (QUOTES, "q"), (STOPS, "."),
        ):
            if word in words:
                return symbol, 1.0
        weight = self._insult(word)
        return ("I", weight) if weight else ("o", 0.0)

    def clauses(self, text: str) -> list[dict[str, float]]:
        """For each matched clause its events and their weights."""
        read = [part for token in TOKEN.findall(text.lower()) for part in self.classify(token)]
        hits = [i for i, (symbol, _) in enumerate(read) if symbol in "IV"]
        out, done = [], -1
        for hit in hits:
            if hit <= done:
                continue
            begin = end = hit
            while begin > 0 and read[begin - 1][0] != ".":
                begin -= 1
            while end < len(read) and read[end][0] != ".":
                end += 1
            done, state, events, insulted = end, 0, defaultdict(float), 0.0
            for symbol, weight in read[begin:end]:
                state, event = ARCS[state, symbol]
                if symbol == "I":
                    insulted = weight
                if event == "t=":  # the target of the insult before it
                    events[event] += insulted
                elif event in INSULTS or event in THREATS:
                    events[event] += weight
            out.append(dict(events))
        return out


def features(clauses: list[dict[str, float]]) -> list[float]:
    """Per level its strongest clause, and the logarithm of the number of clauses that reach it."""
    strong, many = [], []
    for family, level in LEVELS:
        weights = [sum(w for event, w in c.items() if family.get(event, -1) >= level) for c in clauses]
        strong.append(math.log1p(max(weights, default=0.0)))
        many.append(math.log1p(sum(w > 0 for w in weights)))
    return strong + many


@dataclass(frozen=True)
class Scorer:
    """A lexicon and the weights of the curve; the last weight stands alone."""

    lexicon: dict[str, float]
    weights: tuple[float, ...]

    def score(self, clauses: list[dict[str, float]]) -> float:
        total = self.weights[-1] + float(np.dot(self.weights[:-1], features(clauses)))
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, total))))


def fit_curve(rows: np.ndarray, labels: np.ndarray, steps: int = 40) -> tuple[float, ...]:
    """Logistic regression by Newton's steps; the levels' weights are kept from falling below 0."""
    x = np.hstack([rows, np.ones((len(rows), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.array([*PENALTIES, *PENALTIES, 1e-6])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hessian, x.T @ (labels - p) - ridge * w)
        w[:-1] = np.maximum(w[:-1] + step[:-1], 0.0)
        w[-1] += step[-1]
        if np.abs(step).max() < 1e-6:
            break
    for i, (family, level) in enumerate(LEVELS):
        if level:
            w[i] = max(w[i], LEAST_STEP)
        if family is THREATS and level == max(THREATS.values()) and not rows[:, i].any():
            # No labelled document has a targeted threat: one alone leaves a document undecided.
            w[i] = max(w[i], -w[-1] / math.log1p(1.0))
    return tuple(w.tolist())


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) to the distinct words and beginnings of each text."""
    for batch in batches:
        keys, labels = [], []
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = {w for token in set(TOKEN.findall(text.lower())) for w in parts(token) if w.isalpha()}
            found |= {w[:n] + "*" for w in found for n in STEM if len(w) > n}
            keys.extend(found)
            labels.extend([toxic] * len(found))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(labels, pa.int64())], names=["key", "toxic"])


def closed(counts: dict[str, tuple[int, int]]) -> set[str]:
    """Words, and those beginnings that more documents hold than any one longer beginning or word of theirs."""
    longer: dict[str, set[tuple[int, int]]] = defaultdict(set)
    for key, count in counts.items():
        text = key.rstrip("*")
        for n in STEM:
            if len(text) > n:
                longer[text[:n] + "*"].add(count)
    return {key for key, count in counts.items() if not key.endswith("*") or count not in longer[key]}


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Scorer | None:
    """A scorer from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0/1).

    The sample is the labelled ids with the least hash; of several labels of an id the
    highest counts.
    """
    one = labels.groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    ids = one.where("doc_id is not null and toxic is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # One text of each id, that with the least hash, so that repeated ids neither grow the sample nor count twice.
    of_ids = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id")
    sample = of_ids.agg(F.max("toxic").alias("toxic"), F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    sample = written(sample.select("toxic", "text"), "sample")
    n_toxic, n = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).head()
    if not 0 < n_toxic < n:
        return None
    counted = sample.mapInArrow(tidy(_evidence), "key string, toxic long").groupBy("key").agg(
        F.sum("toxic").alias("toxic"), F.count("*").alias("n")
    )
    odds = F.log((F.col("toxic") + 0.1) / (n_toxic + 0.2)) - F.log((F.col("n") - F.col("toxic") + 0.1) / (n - n_toxic + 0.2))
    kept = counted.withColumn("weight", odds).where((F.col("toxic") >= max(LEAST_DOCS, LEAST_SHARE * n_toxic)) & (F.col("weight") >= LEAST_ODDS))
    # A share of the toxic documents holds each of them, so there are only so many.
    found = {r["key"]: r for r in kept.collect()}
    keys = closed({key: (r["toxic"], r["n"]) for key, r in found.items()})
    lexicon = {key: found[key]["weight"] for key in sorted(keys)}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for batch in batches:
            rows = [features(reader.clauses(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "x"])

    found = sample.mapInArrow(tidy(read), "toxic long, x array<double>").toPandas()  # at most sample_rows short rows
    weights = fit_curve(np.array(found["x"].tolist()), found["toxic"].to_numpy(dtype=float))
    return Scorer(lexicon, weights)


def toxicity_scores(docs: DataFrame, scorer: Scorer | None, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs`` (which has ``text``), score, predicted and the number of matched clauses."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(scorer.lexicon if scorer else {})
        for batch in batches:
            matched = [reader.clauses(t or "") if scorer else [] for t in batch.column("text").to_pylist()]
            scores = [scorer.score(m) if scorer else 0.0 for m in matched]
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name not in new]
            yield pa.RecordBatch.from_arrays(
                [
                    *kept, pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()),
                    pa.array([len(m) for m in matched], pa.int32()),
                ],
                names=[*(n for n in batch.schema.names if n not in new), *new],
            )

    new = ("score", "predicted", "matched_clauses")
    kept = docs.drop(*new)
    schema = StructType([
        *kept.schema, StructField("score", DoubleType()), StructField("predicted", IntegerType()),
        StructField("matched_clauses", IntegerType()),
    ])
    return kept.mapInArrow(tidy(score), schema)


def score_of(scorer: Scorer, text: Column) -> Column:
    """The score as a column: only texts go to Python, the other columns stay where they are."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(scorer.lexicon)
        for batch in batches:
            # A few texts at a time become Python objects.
            slices = (batch.slice(at, ROWS).to_pylist() for at in range(0, len(batch), ROWS))
            yield pa.array([scorer.score(reader.clauses(t)) for texts in slices for t in texts], pa.float64())
        reader.seen.clear()
        give_back()

    return score(text)


def labelled(labels: DataFrame) -> DataFrame:
    """Label rows that may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1).select("doc_id", "toxic")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, held_out, score, predicted and matched_clauses, one row for each row of ``docs``."""
    rows = id_and_text(docs, id_col, text_col)
    scorer = learn(rows, labelled(labels), **options)
    scored = toxicity_scores(rows, scorer).drop("text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "matched_clauses")
