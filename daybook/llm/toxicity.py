"""Toxicity (4): a weighted finite-state pattern grammar over clauses.

A lexicon transducer turns the words of a clause into symbols (insult, threat,
target, negation, report, quote, future, other). Transducers for negation scope,
reported speech, targets and threats are composed into one machine that reads
the symbols and writes, for every insult or threat, the pattern that it matches
(negated? reported? with a target in the clause?). Patterns are counted per
document, not words; their weights are the coefficients of a logistic regression on the labels.

The insults of the lexicon are a fixed list plus words and word stems learned
from labelled rows: those that many distinct toxic documents hold and hardly any other.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import bounded_sample, broadcast_if_small, crc_fold, stored
from daybook.llm.words import column_shingles

#: The default lexicon. Words are matched whole, letters in either case.
LEXICON = {
    "insult": "idiot idiots idiotic moron morons moronic imbecile stupid dumbass dimwit fool fools clown clowns loser losers scum scumbag trash garbage vermin "
    "pathetic worthless disgusting despicable repulsive filthy bastard bastards asshole bitch whore slut retard retarded pig pigs freak freaks "
    "abruti abrutis connard connasse salaud salope imbécile crétin ordure minable idiota imbécil estúpido estúpida basura asqueroso gilipollas "
    "idioten dummkopf abschaum arschloch wertlos erbärmlich widerlich trottel",
    "threat": "kill murder hurt destroy shoot stab strangle beat burn hang tuer frapper matar golpear töten umbringen schlagen",
    "target": "you your you're youre yours u he she they them him her these those everyone people vous toi tu ils elles usted ustedes tú du ihr sie",
    "negation": "not no never neither nor isn't aren't wasn't don't doesn't didn't won't pas jamais nunca nicht kein keine niemals",
    "report": "said says say called calls claimed wrote writes quoted quote according reported dit selon dijo según sagte laut",
    "future": "will gonna shall going 'll should werde wird voy",
}
#: Words after a negation that it still covers.
NEGATION_SCOPE = 3
#: A pattern counts at most so often per document; more adds nothing to the score.
MOST = 3

#: Learning words: labelled rows looked at per label (the smallest digests of their ids; copies count
#: as one), distinct toxic documents that must hold a word or stem, and how many others may, per toxic one.
TRAIN_ROWS = 20_000
LEAST_TOXIC = 8
MOST_OTHERS = 0.02
STEMS = (3, 4, 5, 6, 7)

_KINDS = ("insult", "threat")
PATTERNS = tuple(f"{kind}{how}" for kind in _KINDS for how in ("", "+target", "+negated", "+reported"))
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”«»]")
_CLAUSE = re.compile(r"[.!?;\n]+")


class Transducer:
    """A finite-state transducer: ``(state, symbol) -> (state, mark)``; unlisted symbols keep the state."""

    def __init__(self, start: int, moves: dict[tuple[int, str], tuple[int, str]], default: dict[int, int] | None = None):
        self.start, self.moves, self.default = start, moves, default or {}

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.moves.get((state, symbol), (self.default.get(state, state), ""))


def negation(scope: int = NEGATION_SCOPE) -> Transducer:
    """States count the words that a negation still covers."""
    moves = {(s, "negation"): (scope, "") for s in range(scope + 1)}
    moves |= {(s, kind): (s - 1, "negated") for s in range(1, scope + 1) for kind in _KINDS}
    return Transducer(0, moves, {s: s - 1 for s in range(1, scope + 1)})


def reported() -> Transducer:
    """State 1: after a verb of speech; 2: inside quotes."""
    moves = {(0, "report"): (1, ""), (0, "quote"): (2, ""), (1, "quote"): (2, ""), (2, "quote"): (0, "")}
    moves |= {(s, kind): (s, "reported") for s in (1, 2) for kind in _KINDS}
    return Transducer(0, moves)


def targets() -> Transducer:
    """State 1: a target stood in the clause."""
    return Transducer(0, {(0, "target"): (1, "target")} | {(1, kind): (1, "target") for kind in _KINDS})


def threats() -> Transducer:
    """A threat verb counts after a future word or at the start of the clause (an order)."""
    return Transducer(0, {(0, "threat"): (1, "meant"), (2, "threat"): (2, "meant"), (0, "future"): (2, ""), (1, "future"): (2, "")}, {0: 1})


class Composed:
    """The product of some transducers, its states made as they are met."""

    def __init__(self, *parts: Transducer):
        self.parts, self.table = parts, {}

    def run(self, symbols: list[str]) -> list[tuple[str, frozenset[str]]]:
        """The symbols with the marks that all parts write on them."""
        state, out = tuple(p.start for p in self.parts), []
        for symbol in symbols:
            key = (state, symbol)
            if key not in self.table:
                steps = [p.step(s, symbol) for p, s in zip(self.parts, state, strict=True)]
                self.table[key] = tuple(s for s, _ in steps), frozenset(m for _, m in steps if m)
            state, marks = self.table[key]
            out.append((symbol, marks))
        return out


class Grammar:
    """The lexicon transducer and the composed machine, with a fast search for clauses that can match.

    A lexicon word that ends in ``*`` is a stem: every word that begins with it has its symbol.
    """

    def __init__(self, lexicon: dict[str, str]):
        import ahocorasick

        words = {w: kind for kind, text in lexicon.items() for w in text.split()}
        self.words = {w: k for w, k in words.items() if w[-1] != "*"}
        self.stems = {w[:-1]: k for w, k in words.items() if w[-1] == "*"}
        self.lengths = sorted({len(w) for w in self.stems})
        self.machine = Composed(negation(), reported(), targets(), threats())
        self.search = ahocorasick.Automaton()
        for table, whole in ((self.words, True), (self.stems, False)):
            for w, kind in table.items():
                if kind in _KINDS:
                    # a stem also finds the word that it is, so a word needs no second entry
                    self.search.add_word(w, (len(w), whole and w not in self.stems))
        self.empty = not len(self.search)
        if not self.empty:
            self.search.make_automaton()

    def symbol(self, word: str) -> str:
        if word in "\"“”«»":
            return "quote"
        word = word.replace("’", "'")
        if word in self.words:
            return self.words[word]
        return next((self.stems[word[:n]] for n in self.lengths if word[:n] in self.stems), "other")

    def patterns(self, text: str | None) -> list[int]:
        """How often each of ``PATTERNS`` matches, at most ``MOST`` times each."""
        counts = [0] * len(PATTERNS)
        low = (text or "").lower()
        hit = not self.empty and any(
            not (whole and end + 1 < len(low) and low[end + 1].isalpha()) and not (end - size >= 0 and low[end - size].isalpha())
            for end, (size, whole) in self.search.iter(low)
        )
        if not hit:
            return counts
        for clause in _CLAUSE.split(low):
            symbols = [self.symbol(w) for w in _WORD.findall(clause)]
            if not any(s in _KINDS for s in symbols):
                continue
            read = self.machine.run(symbols)
            aimed = any("target" in marks for _, marks in read)
            for symbol, marks in read:
                if symbol == "insult" or symbol == "threat" and ("meant" in marks or aimed):
                    how = 3 if "reported" in marks else 2 if "negated" in marks else 1 if aimed else 0
                    counts[4 * _KINDS.index(symbol) + how] += 1
        return [min(MOST, c) for c in counts]


@cache
def grammar(lexicon: tuple[tuple[str, str], ...]) -> Grammar:
    return Grammar(dict(lexicon))


def word_features(text: str) -> set[str]:
    """The words of a text and, with a ``*``, their stems."""
    words = set(re.findall(r"[^\W\d_]+", text.lower()))
    return {w for w in words if len(w) > 2} | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def learn_words(labelled: DataFrame, train_rows: int = TRAIN_ROWS, least: int = LEAST_TOXIC, others: float = MOST_OTHERS) -> list[str]:
    """Words and stems of toxic documents, from ``labelled(id, text, y)``, shortest stems only.

    Documents that share their smallest shingle count as one. The counts cover a bounded sample
    (``train_rows`` per label), so the learned list is bounded too.
    """

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = [int(s.min().astype(np.int64)) if len(s) else 0 for s in column_shingles(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(kind, pa.int64())], names=["at", "y", "kind"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[Counter] = [Counter(), Counter()]
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[y].update(word_features(text))
        words = list(seen[0].keys() | seen[1].keys())
        for i in range(0, len(words), 10_000):
            part = words[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([c[w] for w in part], pa.int64()) for c in seen)], names=["word", "clean", "toxic"])

    rows = labelled.where("text IS NOT NULL").select(F.md5(F.col("id").cast("string")).alias("at"), "text", "y")
    one = rows.mapInArrow(kinds, "at string, y int, kind long").groupBy("kind", "y").agg(F.min("at").alias("at"))
    one = stored(one, "kinds")
    taken = bounded_sample(one.where("y = 1"), "at", train_rows).unionByName(bounded_sample(one.where("y = 0"), "at", train_rows))
    taken = stored(taken.select("at", "y"), "taken")
    held = rows.join(broadcast_if_small(taken), ["at", "y"]).select("text", "y")
    found = held.mapInArrow(count, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    words = {r["word"] for r in found.where((F.col("toxic") >= least) & (F.col("clean") <= others * F.col("toxic"))).select("word").collect()}
    shorter = lambda w: any(w[:n] + "*" in words and w != w[:n] + "*" for n in STEMS if n <= len(w.rstrip("*")))
    return sorted(w for w in words if not shorter(w))


def match_patterns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lexicon: dict[str, str] = LEXICON) -> DataFrame:
    """``(id, patterns)`` per row; a null text matches nothing."""
    words = tuple(lexicon.items())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grammar(words).patterns(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int8()))], names=["id", "patterns"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(rows, f"id {id_type}, patterns array<tinyint>")


def fit_weights(counted: list[tuple[list[int], int, int]], ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps on ``(patterns, label, rows)``; the last weight is the constant.

    Patterns share the weights of their parts, so a rare combination is scored by what it is made of.
    """
    if not counted:
        return np.zeros(N_WEIGHTS)
    x = np.array([_design(p) for p, _, _ in counted])
    y, n = (np.array([float(r[k]) for r in counted]) for k in (1, 2))
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(keep), x.T @ (n * (y - p)) - keep * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


def _design(patterns) -> list[float]:
    """Whether insults and threats match, more than once, at a target, negated, reported; and a constant."""
    insults, threat = patterns[:4], patterns[4:]
    by = [float(insults[i] + threat[i] > 0) for i in (1, 2, 3)]
    return [float(sum(insults) > 0), float(min(MOST, max(0, sum(insults) - 1))), float(sum(threat) > 0), *by, 1.0]


N_WEIGHTS = 7


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``.

    Labels of the rows whose ``crc32(id) mod folds`` is not 0 fit the weights: all of them, counted by
    pattern vector (at most ``(MOST + 1) ** 8`` vectors) before anything leaves the executors. Null
    labels teach nothing; a null or empty text matches no pattern and gets the score of such texts;
    a null id is never held out and has no label. Labels and other columns are no input of a score.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y")).where("y IN (0, 1)")
    known = stored(known.where(crc_fold("_id", folds) != 0), "labels")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    learned = learn_words(texts.join(broadcast_if_small(known), F.col("id") == F.col("_id")).select("id", "text", "y"))
    found = stored(match_patterns(docs, id_col, text_col, LEXICON | {"insult": " ".join([LEXICON["insult"], *learned])}), "patterns")
    train = found.join(broadcast_if_small(known), F.col("id") == F.col("_id"))
    counted = train.groupBy("patterns", "y").agg(F.count("*").alias("n")).collect()
    w = fit_weights(sorted((list(r[0]), r[1], r[2]) for r in counted))
    c = [F.col("patterns")[i].cast("int") for i in range(len(PATTERNS))]
    insults, threat = c[0] + c[1] + c[2] + c[3], c[4] + c[5] + c[6] + c[7]
    parts = [(insults > 0).cast("double"), F.least(F.lit(MOST), F.greatest(F.lit(0), insults - 1)).cast("double"), (threat > 0).cast("double")]
    parts += [(c[i] + c[i + 4] > 0).cast("double") for i in (1, 2, 3)]
    logit = sum((F.lit(float(x)) * p for x, p in zip(w, parts, strict=False)), F.lit(float(w[-1])))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    return found.select(
        F.col("id").alias(id_col), F.coalesce(crc_fold("id", folds) == 0, F.lit(False)).alias("held_out"), score.alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
