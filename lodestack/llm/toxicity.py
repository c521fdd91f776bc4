"""Toxicity: a weighted finite-state pattern grammar over clauses.

A text is read as clauses of words.  Five transducers, composed into one machine,
read a clause from left to right, each what the one before has written:

- insult: writes a learned word, or two learned words in a row, as one insult;
- threat: marks a word of harm that follows a word of intent, or opens a clause;
- negation and reported speech: mark insults and words of harm that they reach;
- target: marks those that follow a person or group spoken to or of; a second
  reading of the clause, backwards, marks those before one.

Matched clauses are scored, not words: a match counts its weight times the
factors of its marks, so that an insult has its full weight only if it is aimed
at someone, and a word of harm none without target and intent.  The insults and
their weights are learned from labelled rows, and so are the factors; a logistic
curve over the best clause and over the sum of all clauses makes the probability.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import docs_of, list_array, release, stored, text_parts
from .sampling import labelled
from .textwords import Words, shingles

#: Rows of each class that the lexicon, the factors and the curve are fitted on, about.
SAMPLE_ROWS = 4000
#: A term needs so many toxic documents of the sample and such a log-odds ratio.
LEAST_DOCS, LEAST_RATIO = 4, 3.0
#: Its log-likelihood gain must exceed the logarithm of the number of terms tried by so much.
LEAST_GAIN = 4.0
#: Beginnings of words, in characters, that may be learned beside whole words.
STEMS = (4, 5, 6, 7)
#: Distinct words that a worker remembers at most.
WORDS_KEPT = 400_000

# Small closed word classes in English, German, French and Spanish.
TARGETS = "you your yours yourself u ur he she they them these those people du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre tú ti tu usted ustedes vosotros".split()
NEGATIONS = "not no never without nobody isn't aren't wasn't don't doesn't didn't nicht kein keine nie niemals ohne ne pas jamais sans aucun ni nunca sin ningún".split()
REPORTS = "said says say told tells quoted quotes wrote writes claimed claims called reported reports according sagte sagt schrieb zitierte dit disait écrit selon dijo dice escribió según".split()
INTENTS = "will shall gonna going must should want wants i'll we'll he'll they'll werde werden wird soll sollte muss vais va vont doit devrait voy va vamos van debe quiero".split()
HARMS = "kill murder hurt destroy beat stab shoot punish burn töten umbringen verletzen zerstören tuer frapper détruire brûler matar herir destruir golpear quemar".split()

#: What a word is to the grammar.
OTHER, INSULT, HARM, TARGET, NEGATION, REPORT, INTENT = range(7)
#: Marks that the transducers add to an insult or a word of harm; a symbol is MARKS times a place in the lexicon, and its marks.
INTENDED, NEGATED, REPORTED, AIMED, MARKS = 1, 2, 4, 8, 16
#: How far, in words, each class reaches; a report reaches to the clause's end.
INTENT_REACH, NEGATION_REACH, TARGET_REACH = 4, 3, 5
#: After so many other words every machine has come to rest.
REST = 1 + max(INTENT_REACH, NEGATION_REACH, TARGET_REACH)


@dataclass(frozen=True)
class Factors:
    """Of a match's weight: insult without target; negated; reported; and the weight of an intended, aimed word of harm, of which ``loose`` is left if it is not both."""

    bare: float = 0.8
    negated: float = 0.5
    reported: float = 0.7
    harm: float = 1.0
    loose: float = 0.5

    def table(self) -> np.ndarray:
        """The factor of each kind (insult 0, harm 1) times MARKS plus marks."""
        out = np.zeros(2 * MARKS)
        for harm, m in product((0, 1), range(MARKS)):
            f = (self.negated if m & NEGATED else 1.0) * (self.reported if m & REPORTED else 1.0)
            if harm:
                f *= self.harm * (1.0 if m & AIMED and m & INTENDED else self.loose if m & AIMED else 0.0)
            else:
                f *= 1.0 if m & AIMED else self.bare
            out[harm * MARKS + m] = f
        return out


#: The settings of the factors that are tried; without evidence the default stands.
SETTINGS = [Factors(), *(Factors(b, n, r, h) for b, n, r, h in product((0.5, 0.8, 1.0), (0.25, 0.5, 1.0), (0.4, 0.7, 1.0), (0.5, 1.0, 3.0)) if (b, n, r, h) != (0.8, 0.5, 0.7, 1.0))]


class Lexicon:
    """Words with their kind and weight by place (place 0: any other word), and pairs of places that are insults together."""

    def __init__(self, insults: dict[bytes, float]):
        self.kind, self.weight = [OTHER], [0.0]
        self.place: dict[bytes, int] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        for kind, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (INTENT, INTENTS), (HARM, HARMS)):
            for w in words:
                self.put(w.encode(), kind, 1.0 if kind == HARM else 0.0)
        for term, weight in insults.items():
            if b" " not in term:
                self.put(term, INSULT, weight)
        for term, weight in insults.items():
            if b" " in term:
                a, b = (self.place.get(w) or self.put(w, OTHER, 0.0) for w in term.split(b" "))
                self.pairs[a, b] = self.put(term, INSULT, weight)

    def put(self, word: bytes, kind: int, weight: float) -> int:
        self.place[word] = len(self.kind)
        self.kind.append(kind)
        self.weight.append(weight)
        return self.place[word]


class Transducer:
    """Reads and writes symbols one by one; ``step`` gives the next state and what is written.  States are whole numbers, ``start`` the first."""

    start = 0

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        raise NotImplementedError

    def then(self, other: Transducer) -> Transducer:
        return Composed(self, other)


class Composed(Transducer):
    """The machine that feeds what the first writes to the second; its pairs of states are numbered, and its arcs kept, as they are met."""

    def __init__(self, first: Transducer, second: Transducer):
        self.first, self.second = first, second
        self.states: list[tuple[int, int]] = []
        self.number: dict[tuple[int, int], int] = {}
        self.arcs: dict[tuple[int, int], tuple[int, int]] = {}
        self.start = self._state((first.start, second.start))

    def _state(self, pair: tuple[int, int]) -> int:
        if pair not in self.number:
            self.number[pair] = len(self.states)
            self.states.append(pair)
        return self.number[pair]

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        arc = self.arcs.get((state, symbol))
        if arc is None:
            a, b = self.states[state]
            a, between = self.first.step(a, symbol)
            b, out = self.second.step(b, between)
            arc = self.arcs[state, symbol] = self._state((a, b)), out
        return arc


class Insults(Transducer):
    """Writes the second word of a learned pair as the pair's insult; the state is the last word's place if it opens a pair."""

    def __init__(self, lexicon: Lexicon):
        self.pairs, self.opens = lexicon.pairs, {a for a, _ in lexicon.pairs}

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        place = symbol // MARKS
        both = self.pairs.get((state, place)) if state else None
        return place if place in self.opens else 0, symbol if both is None else both * MARKS


class Marker(Transducer):
    """Adds ``mark`` to the ``kinds`` within ``reach`` words after a trigger (None: up to the end); the state is how far it still reaches."""

    def __init__(self, lexicon: Lexicon, trigger: int, mark: int, reach: int | None, kinds: tuple[int, ...] = (INSULT, HARM), open_at_start: bool = False):
        self.kind, self.trigger, self.mark, self.reach, self.kinds = lexicon.kind, trigger, mark, reach, kinds
        self.start = 1 if open_at_start else 0

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        kind = self.kind[symbol // MARKS]
        written = symbol | self.mark if state and kind in self.kinds else symbol
        if kind == self.trigger:
            return self.reach or 1, written
        return state if self.reach is None else max(0, state - 1), written


class Grammar:
    """The five transducers composed, and the target's alone for the way back."""

    def __init__(self, lexicon: Lexicon):
        threat = Marker(lexicon, INTENT, INTENDED, INTENT_REACH, (HARM,), open_at_start=True)
        negation, report = Marker(lexicon, NEGATION, NEGATED, NEGATION_REACH), Marker(lexicon, REPORT, REPORTED, None)
        self.back = Marker(lexicon, TARGET, AIMED, TARGET_REACH)
        self.forth = Insults(lexicon).then(threat).then(negation).then(report).then(self.back)
        self.kind = lexicon.kind

    def matches(self, at: list[int], places: list[int]) -> list[tuple[int, int]]:
        """Lexicon place and marks of each insult and word of harm in a clause that has ``places`` at the words ``at``, in ascending order, and other words elsewhere."""
        written = self._run(self.forth, at, [p * MARKS for p in places])
        turned = self._run(self.back, [-x for x in reversed(at)], written[::-1], at_start=True)[::-1]
        return [divmod(s, MARKS) for s in turned if self.kind[s // MARKS] in (INSULT, HARM)]

    @staticmethod
    def _run(machine: Transducer, at: list[int], symbols: list[int], at_start: bool = False) -> list[int]:
        state, last, out = machine.start, at[0] - 1 if at_start and at else -1, []
        for here, symbol in zip(at, symbols, strict=True):
            for _ in range(min(here - last - 1, REST)):
                state, _ = machine.step(state, 0)
            state, written = machine.step(state, symbol)
            out.append(written)
            last = here
        return out


_STOPS = b".!?;:"
_STRIP = b".,;:!?\"'()[]{}<>*_~-"
_LINE = b"\x00"


def _words(text: str | None) -> list[bytes]:
    return (text or "").replace("\x00", " ").replace("\n", " \x00 ").lower().encode().split()


def terms(words: list[bytes]) -> set[bytes]:
    """Whole words, their beginnings followed by an asterisk, and pairs of words in a row of one clause."""
    out = set()
    for w in set(words):
        if w := w.strip(_STRIP):
            out.add(w)
            s = w.decode()
            out.update(f"{s[:n]}*".encode() for n in STEMS if len(s) > n)
    for a, b in set(zip(words, words[1:], strict=False)):
        if a[-1] not in _STOPS and (a := a.strip(_STRIP)) and (b := b.strip(_STRIP)) and _LINE not in (a, b):
            out.add(a + b" " + b)
    return out


class _Codes(dict):
    """Each word's code: twice its place in the lexicon, and 1 if it ends a clause."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.known, self.weight = lexicon.place, lexicon.weight

    def __missing__(self, word: bytes) -> int:
        if word == _LINE:
            code = 1
        else:
            w = word.strip(_STRIP)
            at = self.known.get(w)
            if at is None:
                s = w.decode()
                at = max((self.known.get(f"{s[:n]}*".encode(), 0) for n in STEMS if len(s) > n), key=lambda i: self.weight[i], default=0)
            code = 2 * at + (word[-1] in _STOPS)
        if len(self) < WORDS_KEPT:
            self[word] = code
        return code


@dataclass
class ToxicityModel:
    lexicon: dict[bytes, float]
    curve: tuple[float, float, float] = (1.0, 0.5, -4.0)
    factors: Factors = Factors()

    def __getstate__(self):
        return {"lexicon": self.lexicon, "curve": self.curve, "factors": self.factors}

    def _tools(self) -> tuple[Lexicon, Grammar, _Codes, np.ndarray]:
        if "_made" not in self.__dict__:
            lexicon = Lexicon(self.lexicon)
            hit = np.array([k in (INSULT, HARM) for k in lexicon.kind])
            hit[[b for _, b in lexicon.pairs]] = True  # may end a pair
            self.__dict__["_made"] = lexicon, Grammar(lexicon), _Codes(lexicon), hit
        return self.__dict__["_made"]

    def matches(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each match in the text: the number of its clause, its weight, and its kind and marks as in Factors.table()."""
        lexicon, grammar, codes, hit = self._tools()
        words = _words(text)
        code = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
        place = code >> 1
        hits = np.flatnonzero(hit[place])
        clause: list[int] = []
        found: list[tuple[int, int]] = []
        if len(hits):
            stops, some = np.flatnonzero(code & 1), np.flatnonzero(place)
            for c in np.unique(np.searchsorted(stops, hits)).tolist():
                a = int(stops[c - 1]) + 1 if c else 0
                b = int(stops[c]) + 1 if c < len(stops) else len(code)
                at = some[np.searchsorted(some, a) : np.searchsorted(some, b)]
                own = grammar.matches((at - a).tolist(), place[at].tolist())
                found += own
                clause += [c] * len(own)
        weight = np.array([lexicon.weight[p] for p, _ in found], float)
        kind = np.array([(lexicon.kind[p] == HARM) * MARKS + m for p, m in found], np.int64)
        return np.array(clause, np.int64), weight, kind

    def evidence(self, texts: list[str | None], tables: np.ndarray | None = None) -> np.ndarray:
        """Of each text: the best clause's score and the logarithm of 1 + the sum of all clauses' scores; with ``tables`` for each of these factor tables."""
        some = self.factors.table()[None, :] if tables is None else tables
        out = np.zeros((len(texts), len(some), 2))
        for k, text in enumerate(texts):
            clause, weight, kind = self.matches(text)
            if len(clause):
                first = np.flatnonzero(np.concatenate([[True], clause[1:] != clause[:-1]]))
                each = np.add.reduceat(weight * some[:, kind], first, axis=1)
                out[k] = np.column_stack([each.max(axis=1), np.log1p(each.sum(axis=1))])
        return out[:, 0] if tables is None else out

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = self.evidence(texts)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.curve[:2]) + self.curve[2], -30, 30)))


def learn_lexicon(found: list[tuple[bytes, int, int]], clean: int, toxic: int) -> dict[bytes, float]:
    """Terms with (term, clean documents, toxic documents) that mark toxic documents, and their smoothed log-odds ratios.

    A beginning must stand for more than one word, and a pair of words is only
    learned if neither word is.
    """
    out, base = {}, toxic / (clean + toxic)
    most: dict[bytes, int] = {}
    for term, _, t in found:
        if term[-1:] != b"*" and b" " not in term:
            s = term.decode()
            for stem in (f"{s[:n]}*".encode() for n in STEMS if len(s) > n):
                most[stem] = max(most.get(stem, 0), t)
    least = math.log(1 + len(found)) + LEAST_GAIN
    known = lambda w: w in out or any(f"{w.decode()[:n]}*".encode() in out for n in STEMS if len(w.decode()) > n)
    for term, c, t in sorted(found, key=lambda r: (b" " in r[0], r[0])):  # words before pairs
        ratio = math.log((t + 0.1) / (toxic - t + 0.1)) - math.log((c + 0.1) / (clean - c + 0.1))
        share = t / (t + c)
        gain = t * math.log(share / base) + (c * math.log((1 - share) / (1 - base)) if c else 0.0)
        if t >= max(LEAST_DOCS, 1.2 * most.get(term, 0)) and ratio >= LEAST_RATIO and gain >= least and not (b" " in term and any(map(known, term.split(b" ")))):
            out[term] = ratio
    return out


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on two columns, by damped Newton steps, with a small ridge."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.array([0.1, 0.1, -2.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ ((y - p) * weight) - 0.05 * w
        hess = (z * (p * (1 - p) * weight)[:, None]).T @ z + 0.05 * np.eye(3)
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1]), float(w[2])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learns the insults, the factors and the curve from about ``sample_rows`` labelled rows of each class.

    Of near copies in the sample (equal smallest shingle hash) one counts, lest
    their common words pass for marks.  The lexicon comes from three quarters of
    the rows, factors and curve from the rest, at the classes' ratio in all labels.
    Without labels of both classes the lexicon is empty.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_parts(batches):
            sets = shingles(Words(texts))
            yield pa.record_batch([*(part.column(i) for i in range(3)), pa.array([int(x[0] >> np.uint64(1)) if len(x) else 0 for x in sets], pa.int64())], ["doc_id", "text", "label", "sign"])

    rows, rates = labelled(docs, labels, label, sample_rows)
    signed = stored(rows.select("doc_id", "text", "label").mapInArrow(sign, "doc_id long, text string, label int, sign long"), "toxic-sample")
    one = signed.groupBy("sign").agg(F.min("doc_id").alias("doc_id"))
    sample = signed.join(one, ["sign", "doc_id"]).select("doc_id", "text", "label", (F.pmod(F.xxhash64("sign"), F.lit(4)) == 3).alias("held"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        docs_seen = [0, 0]
        for part, texts in text_parts(batches):
            for text, y in zip(texts, part.column(2).to_pylist(), strict=True):
                docs_seen[y] += 1
                seen[y].update(terms(_words(text)))
        rows = [(b"", docs_seen[0], docs_seen[1])] + [(t, seen[0][t], n) for t, n in seen[1].items()] + [(t, n, 0) for t, n in seen[0].items() if t not in seen[1]]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], ["term", "clean", "toxic"])

    counted = sample.where("NOT held").mapInArrow(count, "term binary, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    found = [(bytes(r["term"]), r["clean"], r["toxic"]) for r in counted.where((F.length("term") == 0) | (F.col("toxic") >= LEAST_DOCS)).collect()]  # from the bounded sample
    totals = next(((c, t) for term, c, t in found if not term), (0, 0))
    if not min(totals):
        return ToxicityModel({})
    model = ToxicityModel(learn_lexicon([r for r in found if r[0]], *totals))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # its terms are each in LEAST_DOCS rows of the sample
    tables = np.array([f.table() for f in SETTINGS])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_parts(batches):
            x = sent.value.evidence(texts, tables)
            yield pa.record_batch([list_array(x.ravel(), np.full(len(texts), 2 * len(tables)), pa.float64()), part.column(2)], ["x", "label"])

    seen = sample.where("held").mapInArrow(measure, "x array<double>, label int").toArrow()  # a few hundred numbers for a row of the bounded sample
    y = seen["label"].to_numpy().astype(float)
    if len(set(y.tolist())) == 2:
        x = np.concatenate([c.flatten().to_numpy() for c in seen["x"].chunks]).reshape(len(y), len(tables), 2)
        weight = np.where(y == 1, 1 / rates[1], 1 / rates[0]) * min(rates)
        model.factors, model.curve = fit_factors(x, y, weight)
    release(signed)
    return model


def fit_factors(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[Factors, tuple[float, float, float]]:
    """The setting whose curve has the least logistic loss, if it gains 2 on the default's; and its curve.  x: rows by SETTINGS by 2."""
    best = None
    for k, setting in enumerate(SETTINGS):
        curve = fit_curve(x[:, k], y, weight)
        z = x[:, k] @ np.array(curve[:2]) + curve[2]
        loss = float((weight * np.logaddexp(0, np.where(y == 1, -z, z))).sum()) + (2.0 if k else 0.0)
        if best is None or loss < best[0]:
            best = loss, setting, curve
    return best[1], best[2]


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score, the probability of label 1, of every whole text.

    Null and empty texts, and texts without a matched clause, get the curve's
    value at 0.  Repeated rows stay; other columns are left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # its terms are each in LEAST_DOCS rows of the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_parts(batches):
            yield pa.record_batch([part.column(0), pa.array(sent.value.score(texts))], ["doc_id", "score"])

    return docs_of(docs).mapInArrow(run, "doc_id long, score double")
