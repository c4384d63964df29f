"""Toxicity: a lexicon learned from labels, met through Levenshtein automata.

The lexicon has words and stems (word beginnings) that labelled toxic texts hold
and clean ones rarely do, each with its log-odds.  Its trie and the automaton "at most one edit" are intersected
once: a state is the set of (trie node, edits so far) that a word read up to here
can be in, so the table of states holds every misspelling of every term without
listing one.  All words of a slice of texts step through the table at once, one
character for each step, and most are dead after a few.  Each code point of the
lexicon has its own class, those of no term share one.  Words of labelled clean texts
that are one edit from a term are ordinary words, not misspellings; a term that has more
of these than misspellings in toxic texts is matched as it is written only.

Each hit is looked at in a window of words around it: a hit between quotation marks
in its line counts as quoted, others as abuse.  A document's score is a logistic
model over the log-odds of its hits (a misspelling counts half), the strongest of
them, their number and share, misspellings and quotations, fitted on labelled rows
that the lexicon wasn't chosen from.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import prepare, slices, stored, utf8, word_runs

STEMS = (4, 5, 6, 7, 8)
WINDOW = 8
EXACT, STEM, FUZZY = 1, 2, 3
FUZZY_FROM = 4  # letters
CODES = 0x250  # letters from here on have sparse columns in the table of states
FEATURES = ("evidence", "strongest", "hits", "share", "fuzzy", "quoted")
# Pairs of quotation marks.
QUOTES = [('"', '"'), ("“", "”"), ("„", "“"), ("«", "»"), ("‘", "’")]
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


class Automaton:
    """Words and stems with their weights; a word of ``fuzzy`` and the stem in a word that
    begins like one of ``fuzzy_stems`` may have one edit.  Words of ``ordinary`` aren't misspellings.

    ``near``: for each state that a misspelling ends in, the words and stems (with a
    star) it may stand for."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], fuzzy: Iterable[str] = (), fuzzy_stems: Iterable[str] = (), ordinary: Iterable[str] = ()):
        children: list[dict[str, int]] = [{}]
        ends: list[str | None] = [None]  # the word that ends here

        def node(term: str) -> int:
            at = 0
            for c in term:
                if c not in children[at]:
                    children.append({}), ends.append(None)
                    children[at][c] = len(children) - 1
                at = children[at][c]
            return at

        for w in sorted(words):
            ends[node(w)] = w
        stem_at = {node(s): s for s in sorted(stems)}
        plain = {node(w) for w in sorted(ordinary)}
        bent, bent_stems = {w for w in fuzzy if w in words}, {x for x in fuzzy_stems if x in stems}
        on_way = {node(w[:k]) for w in bent | bent_stems for k in range(len(w) + 1)}

        letters = sorted({c for n in children for c in n})
        self.classes = np.zeros(max([CODES, *(ord(c) + 1 for c in letters)]) + 1, np.int32)  # 0: any other character
        for k, c in enumerate(letters):
            self.classes[ord(c)] = k + 1
        self.width = len(letters) + 1
        self.dense = sum(ord(c) < CODES for c in letters)  # the last class with a column of its own

        def closed(items: set[tuple[int, int]]) -> frozenset:
            out = set(items)
            for n, e in items:
                if e == 0:  # a letter of the term left out
                    out |= {(m, 1) for m in children[n].values() if m in on_way}
            return frozenset(x for x in out if x[1] == 0 or (x[0], 0) not in out)

        def step(state: frozenset, c: str | None) -> frozenset:
            out = set()
            for n, e in state:
                if c in children[n] and (e == 0 or children[n][c] in on_way):
                    out.add((children[n][c], e))
                if e == 0:
                    out |= {(m, 1) for k, m in children[n].items() if m in on_way and k != c}
                    if n in on_way:
                        out.add((n, 1))
            return closed(out)

        def heaviest(found: list[str], before: str | None) -> str | None:
            return max(found + ([] if before is None else [before]), key=lambda x: (stems[x], x), default=None)

        # a state of the table: where the word can be, the heaviest stem it has passed, and those it has passed with an edit
        none: frozenset = frozenset()
        start = (closed({(0, 0)}), None, none)
        index: dict = {(none, None, none): 0, start: 1}
        self.near: dict[int, list[str]] = {}
        table, kind, weight = [[0] * (self.dense + 1)], [0], [0.0]
        keys, targets = [], []  # moves by the other classes: state * width + class, where they lead
        todo = [start]
        for at, (state, stem, passed) in enumerate(todo, 1):
            exact = [words[ends[n]] for n, e in state if e == 0 and ends[n] is not None]
            near = sorted(ends[n] for n, e in state if e == 1 and ends[n] in bent)
            whole = [(w, EXACT) for w in exact] + ([] if stem is None else [(stems[stem], STEM)])
            some = [(words[x], FUZZY) for x in near] + [(stems[x], FUZZY) for x in sorted(passed)]
            if whole or any(n in plain for n, e in state if e == 0):
                some = []
            elif some:
                self.near[at] = near + [x + "*" for x in sorted(passed)]
            best = max(whole or some or [(0.0, 0)])
            weight.append(best[0]), kind.append(best[1])
            row = []
            follow = {c for n, _ in state for c in children[n]}  # any other letter moves as None
            for c in [None, *sorted(follow)]:
                nxt = step(state, c)
                met = [(stem_at[n], e) for n, e in nxt if n in stem_at]
                key = (nxt, heaviest([x for x, e in met if e == 0], stem), passed | {x for x, e in met if e == 1 and x in bent_stems})
                if key not in index:
                    index[key] = len(index)
                    todo.append(key)
                if c is None:
                    row = [index[key]] * (self.dense + 1)
                elif (k := int(self.classes[ord(c)])) <= self.dense:
                    row[k] = index[key]
                else:
                    keys.append(at * self.width + k), targets.append(index[key])
            table.append(row)
        self.table, self.kind, self.weight = np.array(table, np.int32), np.array(kind, np.int8), np.array(weight)
        self.keys, self.targets = np.array(keys, np.int64), np.array(targets, np.int32)  # keys rise: states in order, letters sorted
        self.settled = (self.table == np.arange(len(table))[:, None]).all(1)  # no letter leads away
        self.settled[self.keys[self.targets != self.keys // self.width] // self.width] = False

    def match(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Kind (0: none) and weight of each word of the classes of a slice's characters."""
        state = self.states(letters, starts, ends)
        return self.kind[state], self.weight[state]

    def states(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The state that each word ends in, or one that no letter leads away from."""
        state = np.ones(len(starts), np.int32)
        live, k = np.arange(len(starts)), 0
        while len(live):
            live = live[starts[live] + k < ends[live]]
            before, c = state[live], letters[starts[live] + k]
            after = self.table[before, np.where(c <= self.dense, c, 0)]
            far = np.flatnonzero(c > self.dense)
            if len(far):
                key = before[far].astype(np.int64) * self.width + c[far]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                there = self.keys[at] == key
                after[far[there]] = self.targets[at[there]]
            state[live] = after
            live = live[~self.settled[state[live]]]
            k += 1
        return state

    def neighbours(self, words: list[str]) -> list[list[str]]:
        """For each word the terms (stems with a star) that it is a misspelling of."""
        codes, offsets = characters(words)
        return [self.near.get(x, []) for x in self.states(self.letters(codes), offsets[:-1], offsets[1:]).tolist()]

    def letters(self, codes: np.ndarray) -> np.ndarray:
        return self.classes[np.minimum(codes, len(self.classes) - 1)]


def lower_ascii(codes: np.ndarray) -> np.ndarray:
    return codes + np.where((codes >= 65) & (codes <= 90), 32, 0).astype(codes.dtype)


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, A-Z lowered, and the n + 1 offsets; null counts as empty."""
    codes = [np.frombuffer((t or "").encode("utf-32-le", "replace"), np.uint32) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype(np.int64)
    return lower_ascii(np.concatenate(codes)) if codes else np.zeros(0, np.uint32), offsets


def is_word(codes: np.ndarray) -> np.ndarray:
    return (codes >= 128) | ((codes >= 97) & (codes <= 122)) | ((codes >= 48) & (codes <= 57))


def reach(text: str, at: int, step: int) -> int:
    """The place that ends the line, or ``WINDOW`` words, going from ``at`` by ``step``."""
    gaps, blank = 0, False
    while 0 <= at < len(text) and text[at] != "\n":
        if text[at] not in " \t":
            blank = False
        elif not blank:
            gaps, blank = gaps + 1, True
            if gaps == WINDOW:
                break
        at += step
    return at


def quoted(text: str, at: int, end: int) -> bool:
    """Whether quotation marks of one pair stand on both sides, in the same line and
    at most ``WINDOW`` words away, with the nearest one on the left opening."""
    left, right = text[reach(text, at - 1, -1) + 1:at], text[end:reach(text, end, 1)]
    for a, b in QUOTES:
        if a == b:
            line = text[text.rfind("\n", 0, at) + 1:at]
            if a in left and b in right and line.count(a) % 2 == 1:
                return True
        elif left.rfind(a) > left.rfind(b) and b in right:
            return True
    return False


def text_features(automaton: Automaton, texts: list[str | None]) -> np.ndarray:
    """One row of FEATURES for each text."""
    data, offsets = characters(texts)
    inside = is_word(data)
    starts, ends = word_runs(inside.astype(np.uint8), offsets, np.array([False, True] + [False] * 254))
    kind, weight = automaton.match(automaton.letters(data), starts, ends)
    out = np.zeros((len(texts), len(FEATURES)))
    n_words = np.diff(np.searchsorted(starts, offsets))
    hits = np.flatnonzero(kind)
    for h, d in zip(hits.tolist(), (np.searchsorted(offsets, starts[hits], "right") - 1).tolist()):
        w = weight[h] * (0.5 if kind[h] == FUZZY else 1.0)
        if quoted(texts[d], int(starts[h] - offsets[d]), int(ends[h] - offsets[d])):
            out[d, 5] += w
        else:
            out[d, 0] += w
            out[d, 1] = max(out[d, 1], w)
            out[d, 2] += 1
            out[d, 4] += kind[h] == FUZZY
    out[:, 3] = np.minimum(1.0, 20 * out[:, 2] / np.maximum(n_words, 1))
    out[:, [0, 2, 4, 5]] = np.log1p(out[:, [0, 2, 4, 5]])
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Weights, the constant last, by Newton's method; the constant isn't shrunk."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    share = min(max(y.mean() if len(y) else 0.1, 1e-3), 1 - 1e-3)
    w[-1] = np.log(share / (1 - share))
    if not len(y):
        return w
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), grad)
        w -= move * min(1.0, 5.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-6:
            break
    # more abuse never lowers a score
    w[:4] = np.maximum(w[:4], 0)
    return w


def learned_lexicon(rows: DataFrame, max_terms: int, precision: float, least: int, crowd: float) -> tuple[dict[str, float], dict[str, float], list[str], list[str], list[str]]:
    """(words, stems, words and stems that may be misspelled, ordinary words) with log-odds, from rows (text, toxic).

    Terms of toxic texts first; clean texts are then counted for these alone.  Each
    different text counts once.  A term needs ``least`` toxic texts and ``precision``.
    Words that are one edit from a term, but occur in clean texts too
    often for ``precision``, are ordinary.  A word may be misspelled if it has at most ``crowd``
    such neighbours for each one that toxic texts hold; a stem, which many words begin like, if it has none.
    """
    texts = rows.distinct()
    words = F.array_distinct(F.regexp_extract_all(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(WORD), F.lit(0)))
    split = texts.select("toxic", words.alias("words"))
    starts = F.filter(F.flatten(F.array(*(F.transform("words", _start(n)) for n in STEMS))), lambda x: x.isNotNull())
    terms = split.select("toxic", F.explode(F.array_union("words", starts)).alias("term"))
    toxic = stored(terms.where("toxic = 1").groupBy("term").agg(F.count("*").alias("bad")).where(F.col("bad") >= least), "terms")
    clean = terms.where("toxic = 0").join(toxic.select("term"), "term", "left_semi").groupBy("term").agg(F.count("*").alias("good"))
    n_toxic, n_clean = (texts.where(f"toxic = {k}").count() for k in (1, 0))
    if not n_toxic or not n_clean:
        return {}, {}, [], [], []
    odds = F.log((F.col("bad") + 0.5) / (n_toxic + 1)) - F.log((F.col("good") + 0.5) / (n_clean + 1))
    found = (toxic.join(clean, "term", "left").select("term", "bad", F.coalesce("good", F.lit(0)).alias("good")).withColumn("odds", odds)
             .where(F.col("bad") >= precision * (F.col("bad") + F.col("good")))
             .orderBy(F.desc(F.col("bad") * F.col("odds")), F.length("term").desc(), "term").limit(max_terms).collect())  # the lexicon's size is a parameter
    weights = {r["term"]: float(r["odds"]) for r in found}
    words_, stems = {t: w for t, w in weights.items() if not t.endswith("*")}, {t[:-1]: w for t, w in weights.items() if t.endswith("*")}
    whole, whole_stems = [t for t in words_ if len(t) >= FUZZY_FROM], [t for t in stems if len(t) > FUZZY_FROM]
    shared = rows.sparkSession.sparkContext.broadcast(Automaton(words_, stems, whole, whole_stems))

    def misspellings(batches):
        for b in batches:
            words = b.column("term").to_pylist()
            near = shared.value.neighbours(words)
            found = pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.list_(pa.string()))], names=["term", "ordinary", "near"])
            yield found.filter(pa.array([len(x) > 0 for x in near], pa.bool_()))

    vocabulary = split.select("toxic", F.explode("words").alias("term")).groupBy("term").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    seen = vocabulary.select("term", (F.col("bad") < precision * F.col("n")).alias("ordinary")).mapInArrow(misspellings, "term string, ordinary boolean, near array<string>")
    seen = seen.collect()  # words one edit from max_terms terms in a part of sample_rows
    ordinary, bent = (Counter(t for r in seen if r["ordinary"] == kind for t in r["near"]) for kind in (True, False))
    return (words_, stems, [t for t in whole if ordinary[t] <= crowd * bent[t]], [t for t in whole_stems if not ordinary[t + "*"]], sorted(r["term"] for r in seen if r["ordinary"]))


def _start(n: int):
    return lambda w: F.when(F.length(w) > n, F.concat(F.left(w, F.lit(n)), F.lit("*")))


def train(docs: DataFrame, labels: DataFrame, use: Column, sample_rows: int = 20_000, max_terms: int = 600, precision: float = 0.5, least: int = 4, crowd: float = 1.0):
    """(automaton, weights) from at most about ``sample_rows`` labelled rows for which
    ``use`` holds, those with the smallest hashes of their ids; the bound is on
    training rows only."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & use).select("doc_id", "toxic").distinct()
    n = marks.count()
    if n > sample_rows:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < max(1, 1_000_000 * sample_rows // n))
    rows = stored(docs.select("doc_id", "text").where("text is not null").join(marks, "doc_id").select("text", "toxic", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0).alias("weigh")), "toxic-train")
    automaton = Automaton(*learned_lexicon(rows.where("not weigh").select("text", "toxic"), max_terms, precision, least, crowd))
    shared = docs.sparkSession.sparkContext.broadcast(automaton)  # its size follows max_terms

    def features(batches):
        for b in batches:
            for i, j in slices(utf8(b.column("text"))[1]):
                part = b.slice(i, j - i)
                x = text_features(shared.value, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["toxic", "x"])

    got = rows.where("weigh").select("text", "toxic").mapInArrow(features, "toxic int, x array<double>").collect()  # a part of sample_rows
    x = np.array([r["x"] for r in got]).reshape(-1, len(FEATURES))
    return automaton, fit_logistic(x, np.array([r["toxic"] for r in got], float))


def toxicity(docs: DataFrame, labels: DataFrame, use: Column, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, score, predicted for each row of ``docs`` (doc_id, text), learned from
    ``labels`` (doc_id, toxic 0 or 1) where ``use`` holds.

    Null and empty texts have no hit and get the score of such texts.  Labels that
    are null, of other values or without document teach nothing; without labels of
    both kinds the lexicon is empty and all scores are the toxic share.  Very long texts
    are scored whole, in slices of their own; each row is scored by its text alone, so
    repeated rows and rows that share an id, or have none, get a score each (labels go by
    id).  Other columns aren't read, whatever their names.
    """
    prepare(docs.sparkSession)
    automaton, weights = train(docs, labels, use, **options)
    shared = docs.sparkSession.sparkContext.broadcast((automaton, weights))

    def score(batches):
        found, w = shared.value
        for b in batches:
            for i, j in slices(utf8(b.column("text"))[1]):
                part = b.slice(i, j - i)
                x = text_features(found, part.column("text").to_pylist())
                p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
