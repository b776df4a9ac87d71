"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lexloom.llm.common import pieces, sampled_texts, saved

#: Labelled documents that the lexicon and the weights are fitted on, at most.
TRAIN_ROWS = 20_000
#: Learned entries: toxic documents that hold one at least, and least log-odds.
SUPPORT = 4
ODDS = 2.5
#: Lengths of word beginnings that may stand for inflected forms.
STEMS = (4, 5, 6, 7)
#: Words within which a negation or a target takes effect.
REACH = 4
TOXIC = 0.5

# Seed words of each class, in English, German, French and Spanish.
INSULTS = (
    "idiot idiots moron morons stupid dumb loser losers scum trash garbage worthless pathetic disgusting clown clowns "
    "imbecile fool fools jerk bastard vermin filth dummkopf idioten trottel abschaum arschloch versager widerlich dumm "
    "imbécile crétin connard abruti ordure minable dégoûtant idiote estúpido estúpida imbécil basura escoria asqueroso inútil"
).split()
THREATS = (
    "kill murder hurt destroy beat shoot stab burn hang crush töten umbringen vernichten schlagen erschießen "
    "tuer frapper détruire brûler matar golpear destruir quemar"
).split()
TARGETS = (
    "you your yours yourself u ya they them he she him her people du dich dir ihr euch dein deine sie "
    "tu te toi ton ta vous votre vos tú ti usted ustedes vosotros"
).split()
NEGATIONS = (
    "not no never nor neither without isn't aren't don't doesn't didn't wasn't won't nicht kein keine nie niemals ohne "
    "ne pas jamais sans non nunca jamás sin ni"
).split()
REPORTS = (
    "said says say wrote writes claimed claims reported reports quoted quotes according called calls alleged "
    "sagte schrieb behauptete laut zitierte dit écrit selon déclaré dijo escribió según declaró"
).split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;\n]+")
_BREAK = -1
WIDTH = 7


def _counter(start: int, classes: int = 6) -> np.ndarray:
    """Next states by class: state k > 0 says that a word of class `start` was read at most REACH words ago."""
    step = np.zeros((REACH + 1, classes), np.int64)
    for s in range(REACH + 1):
        step[s] = max(0, s - 1)
        step[s, start] = REACH
    return step


def _flag(start: int, classes: int = 6) -> np.ndarray:
    """State 1 from a word of class `start` on to where the reading ends."""
    step = np.array([[0] * classes, [1] * classes])
    step[0, start] = 1
    return step


def _product(machines: list[np.ndarray]) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """All machines run at once: next states, and what states of theirs a state stands for."""
    sizes = [len(m) for m in machines]
    parts = [tuple(int(p) for p in np.unravel_index(s, sizes)) for s in range(int(np.prod(sizes)))]
    step = [[np.ravel_multi_index([m[p, c] for m, p in zip(machines, at)], sizes) for c in range(6)] for at in parts]
    return np.array(step), parts


#: What modifiers make of a match, and what a threat weighs whose target stands farther off.
NEGATED, REPORTED, TARGETED, FAR = 0.3, 0.5, 1.5, 0.5


def compose() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The grammar as tables: next states from the left and from the right, weights of insults and of threats.

    A clause is read in both directions, as what modifies a match may stand before or after it. Forwards
    run transducers for targets (near, and anywhere), negation and reported speech, backwards those for
    targets and reported speech. A match is weighed by the pair of states that meet at it: less after a
    negation within REACH words or in a clause of reported speech; an insult more with a target within
    REACH words; a threat in full with such a target, by FAR with one elsewhere in its clause, and
    else not at all. Modifiers multiply, so a negated or reported threat always weighs less than a plain one.
    """
    left_step, left = _product([_counter(TARGET), _flag(TARGET), _counter(NEGATION), _flag(REPORT)])
    right_step, right = _product([_counter(TARGET), _flag(TARGET), _flag(REPORT)])
    insult, threat = np.zeros((len(left), len(right))), np.zeros((len(left), len(right)))
    for i, (near, aimed, negated, reported) in enumerate(left):
        for j, (near_after, aimed_after, reported_after) in enumerate(right):
            scale = (NEGATED if negated else 1) * (REPORTED if reported or reported_after else 1)
            close = near or near_after
            insult[i, j] = scale * (TARGETED if close else 1)
            threat[i, j] = scale * (1 if close else FAR if aimed or aimed_after else 0)
    return left_step, right_step, insult, threat


_LEFT, _RIGHT, _INSULT_OUT, _THREAT_OUT = (t.tolist() for t in compose())


@dataclass
class Grammar:
    """Word classes with weights, and the logistic weights of the clause scores."""

    words: dict[str, tuple[int, float]]
    stems: dict[str, tuple[int, float]]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH + 1))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    scale: np.ndarray = field(default_factory=lambda: np.ones(WIDTH))
    seen: dict[str, tuple[int, float]] = field(default_factory=dict, repr=False)

    def look(self, word: str) -> tuple[int, float]:
        found = self.words.get(word)
        if found is None:
            known = [self.stems[word[:n]] for n in STEMS if len(word) >= n and word[:n] in self.stems]
            found = max(known, key=lambda k: (k[1], -k[0]), default=(OTHER, 0.0))
        if len(self.seen) > 200_000:
            self.seen.clear()
        self.seen[word] = found
        return found

    def __getstate__(self):
        return {**self.__dict__, "seen": {}}

    def clauses(self, text: str | None) -> tuple[list[tuple[float, float]], int]:
        """(insult weight, threat weight) of each clause with a match, and the number of words."""
        if not text:
            return [], 0
        tokens = _WORD.findall(text.lower())
        seen, look = self.seen, self.look
        classes = [seen.get(t) or look(t) for t in tokens]
        hits = [i for i, (c, _) in enumerate(classes) if c in (INSULT, THREAT)]
        out, done = [], -1
        for i in hits:
            if i < done:
                continue
            a = i
            while a and not _is_break(tokens[a - 1]):
                a -= 1
            b = i
            while b < len(tokens) and not _is_break(tokens[b]):
                b += 1
            done = b
            out.append(_weigh(classes[a:b]))
        return out, len(tokens)

    def features(self, text: str | None) -> np.ndarray:
        """What the clauses weigh: the heaviest two and the sum, threats among them, and the sum by length."""
        found, n = self.clauses(text)
        clauses = sorted((f[0] + f[1] for f in found), reverse=True) + [0.0, 0.0]
        threat = [f[1] for f in found]
        return np.array([
            clauses[0], clauses[1], math.log1p(sum(clauses)), max(threat, default=0.0), math.log1p(sum(threat)),
            math.log1p(100 * sum(clauses) / max(n, 1)), math.log1p(n),
        ])

    def matrix(self, texts) -> np.ndarray:
        return np.stack([self.features(t) for t in texts]) if len(texts) else np.zeros((0, WIDTH))

    def score(self, texts) -> np.ndarray:
        z = (self.matrix(texts) - self.centre) / self.scale
        return 1 / (1 + np.exp(-np.clip(z @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _weigh(classes: list[tuple[int, float]]) -> tuple[float, float]:
    """Insult and threat weight of a clause of (class, weight) words."""
    after, state = [0] * len(classes), 0
    for i in range(len(classes) - 1, -1, -1):
        after[i] = state
        state = _RIGHT[state][classes[i][0]]
    state, insult, threat = 0, 0.0, 0.0
    for i, (c, w) in enumerate(classes):
        if c == INSULT:
            insult += w * _INSULT_OUT[state][after[i]]
        elif c == THREAT:
            threat += w * _THREAT_OUT[state][after[i]]
        state = _LEFT[state][c]
    return insult, threat


def _is_break(token: str) -> bool:
    return token[0] in ".!?;\n"


def seed_words() -> dict[str, tuple[int, float]]:
    out = {w: (TARGET, 0.0) for w in TARGETS}
    out |= {w: (NEGATION, 0.0) for w in NEGATIONS} | {w: (REPORT, 0.0) for w in REPORTS}
    return out | {w: (THREAT, 2.0) for w in THREATS} | {w: (INSULT, 2.0) for w in INSULTS}


def _kind(term: str) -> int:
    return THREAT if term.startswith(tuple(THREATS)) else INSULT


def terms(text: str | None) -> set[str]:
    """The words of a text, and their beginnings marked with a star."""
    words = {t for t in _WORD.findall((text or "").lower()) if not _is_break(t)}
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Newton's method on the mean log loss."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], l2)
    pull[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) / len(y) + pull * w
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(pull)
        change = np.linalg.solve(curve, gradient)
        w -= change * min(1.0, 4 / (np.abs(change).max() + 1e-12))
        if np.abs(change).max() < 1e-7:
            break
    return w


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    bound: int = TRAIN_ROWS,
) -> Grammar:
    """Learn lexicon and weights from at most `bound` labelled documents that are not held out.

    A word, or a word beginning, joins the matches if at least SUPPORT toxic documents
    hold it and its smoothed log-odds against the others reach ODDS: as a threat if it is
    one of the seeds or begins with one, else as an insult. Executors count the
    terms of toxic documents, partly summed inside tasks; only those with support, a number
    that the sample bounds, are then counted in the others. Without both labels in the
    sample the seeds stay, and the weights are those of the share of ones.
    """
    sample = saved(sampled_texts(docs, key, text, labels, label, bound), "toxic")
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    grammar = Grammar(seed_words(), {})
    if not sizes.get(1) or not sizes.get(0):
        share = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 1)
        grammar.weights[-1] = math.log(share / (1 - share))
        return grammar

    bad = _document_counts(sample.where("y = 1"), None).where(F.col("n") >= SUPPORT)
    bad = {r["term"]: r["n"] for r in bad.collect()}
    fine = {r["term"]: r["n"] for r in _document_counts(sample.where("y = 0"), frozenset(bad)).collect()}
    chosen = []
    for term, n in sorted(bad.items()):
        rates = (n + 0.5) / (sizes[1] + 1), (fine.get(term, 0) + 0.5) / (sizes[0] + 1)
        odds = math.log(rates[0] / rates[1])
        if odds >= ODDS:
            chosen.append((term, n, min(odds, 6.0)))
    known = grammar.words
    # Beginnings need twice the support of words: each stands for many of them.
    for term, n, weight in chosen:
        if not term.endswith("*"):
            if known.get(term, (INSULT, 0))[0] in (INSULT, THREAT):
                known[term] = (_kind(term), weight)
        elif n >= 2 * SUPPORT:
            grammar.stems[term[:-1]] = (_kind(term[:-1]), weight)

    def measure(batches):
        for b in pieces(batches, "text"):
            yield pd.DataFrame({"x": list(grammar.matrix(list(b["text"]))), "y": b["y"].to_numpy()})

    rows = sorted((r["y"], r["x"]) for r in sample.mapInPandas(measure, "x array<double>, y int").collect())
    x, y = np.array([r[1] for r in rows]), np.array([r[0] for r in rows], float)
    grammar.centre, grammar.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    grammar.weights = _logistic((x - grammar.centre) / grammar.scale, y)
    return grammar


def _document_counts(sample: DataFrame, among: frozenset[str] | None) -> DataFrame:
    """(term, n): documents that hold each term, of all terms or of those given."""

    def run(batches):
        found: Counter = Counter()
        for b in pieces(batches, "text"):
            for t in b["text"]:
                held = terms(t)
                found.update(held if among is None else held & among)
                if len(found) > 50_000:
                    yield frame(found)
                    found.clear()
        yield frame(found)

    def frame(found: Counter) -> pd.DataFrame:
        return pd.DataFrame({"term": pd.Series([*found], dtype=object), "n": pd.Series([*found.values()], dtype="int64")})

    return sample.mapInPandas(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def score_toxicity(docs: DataFrame, grammar: Grammar, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) of every row from its whole text.

    Null and empty texts hold no clause and get the score of that. Repeated rows are
    scored each; other columns are not read.
    """

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([*grammar.score(list(texts))], dtype=float)

    out = docs.select(F.col(key), run(F.col(text)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))
