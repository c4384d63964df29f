"""Language-model scores: corpus counts and a gated recurrent network in numpy.

Counts.  Blocks of documents send each different word hash once, with its count in
training documents, to buckets; buckets add the counts of all blocks and answer
each block for its words.  So every count covers the whole corpus, while a word,
however frequent, is one entry from a block.

Network.  Symbols are the ``WORDS`` most frequent words and, for all others, classes
by a word's last bytes.  A gated recurrent unit reads the symbols; the softmax is
factored: first a class of ``MEMBERS`` symbols, then a symbol of it.  A word without
a symbol of its own gets its class's probability times its share of the class by
counts, so a text's probability is over all words and is comparable with the base
score.  Its output starts at the corpus's frequencies.

Training is truncated backpropagation on all training documents, each in one of
``ROUNDS`` rounds: in each round trainers start from the same weights, each learns
from its documents, and the weights are averaged in two levels.  Scoring carries
the state from window to window to a document's end.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import LOWER, SPACED, block_count, prepare, slices, stored, utf8, word_hashes, word_runs

UNITS = 32
CLASSES, MEMBERS = 64, 32
SUFFIXES = 64
WORDS = CLASSES * MEMBERS - SUFFIXES
ROUNDS = 3
LANES, WINDOW = 32, 16
MOST_LANES = 192
RATE = 0.05
LEAST_UPDATES, ENOUGH_UPDATES = 200, 600
# Sizes of work that stays in the processor's cache: bytes of text, documents scored side by side, the least and most
# steps whose inputs are read at once and how many they are together, states held for a pass of the softmax, and its pieces.
TEXT_PIECE, SIDE, STEPS, AT_ONCE, HELD, PIECE = 1 << 17, 512, (16, 256), 1 << 13, 1 << 15, 1024
END = np.uint64(0xE0D0E0D0E0D0E0D1)  # the end's place among word hashes
MESSAGE = "target long, origin long, kind int, a binary, b binary, c binary"
_FIELDS = pa.schema([("target", pa.int64()), ("origin", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
COUNTS, TOTALS = 0, 1


def tokens(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, an end behind each text, the suffix class
    of each (0 for ends), and the offsets of the texts."""
    data, offsets = utf8(column)
    hashes, classes, counts = [], [], []
    for i, j in slices(offsets, TEXT_PIECE):
        part = LOWER[data[offsets[i]:offsets[j]]]
        at = offsets[i:j + 1] - offsets[i]
        s, e = word_runs(part, at, SPACED)
        first = np.searchsorted(s, at)
        h = word_hashes(part, s, e)
        h[h == END] ^= np.uint64(1)
        last = part[e - 1].astype(np.int64) if len(e) else np.zeros(0, np.int64)
        before = np.where(e - s > 1, part[np.maximum(e - 2, 0)], 0).astype(np.int64) if len(e) else last
        hashes.append(np.insert(h, first[1:], END))
        classes.append(np.insert((last * 31 + before * 7) % SUFFIXES, first[1:], 0))
        counts.append(np.diff(first) + 1)
    if not counts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    return np.concatenate(hashes), np.concatenate(classes), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def _message(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in _FIELDS]
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, _FIELDS)], schema=_FIELDS)


def _by_bucket(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted different hashes by bucket, and the buckets' cuts."""
    bucket = (h % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def _of_value(value: np.ndarray, inverse: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """The suffix class of each different hash: all its tokens have the same."""
    out = np.empty(len(value), np.uint8)
    out[inverse] = cls
    return out


def corpus_counts(blocks, n: int) -> DataFrame:
    """COUNTS messages (target: block, origin: bucket, a: counts of the hashes that the
    block has in that bucket, in order) and one TOTALS message of each bucket (a: its
    most frequent hashes, the end's always among them, b: their counts, c: for each
    suffix class the count and number of different words, those with symbols of their
    own included, the end not)."""

    def send(key, table):
        h, cls, first = tokens(table.column("text"))
        train = np.repeat(~np.array(table.column("held_out").to_pylist(), bool), np.diff(first))
        value, inverse = np.unique(h, return_inverse=True)
        count = np.bincount(inverse, weights=train, minlength=len(value)).astype(np.int64)
        order, cuts = _by_bucket(value, n)
        value, count, cls = value[order], count[order], _of_value(value, inverse, cls)[order]
        return _message([(k, key[0].as_py(), COUNTS, value[x:y].tobytes(), count[x:y].tobytes(), cls[x:y].tobytes()) for k, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if y > x])

    def answer(key, table):
        origin = table.column("origin").to_pylist()
        parts = [np.frombuffer(x, np.uint64) for x in table.column("a").to_pylist()]
        count = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("b").to_pylist()])
        cls = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("c").to_pylist()])
        value, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        cls = _of_value(value, inverse, cls)
        total = np.zeros(len(value), np.int64)
        np.add.at(total, inverse, count)
        ends = np.cumsum([len(p) for p in parts])
        out = [(o, key[0].as_py(), COUNTS, total[inverse[e - len(p):e]].tobytes(), None, None) for o, p, e in zip(origin, parts, ends.tolist())]
        seen = total > 0
        word = seen & (value != END)
        sums = np.concatenate([np.bincount(cls[word], weights=total[word], minlength=SUFFIXES), np.bincount(cls[word], minlength=SUFFIXES)]).astype(np.int64)
        top = np.lexsort((value, -total, value != END))[:WORDS]
        top = top[seen[top]]
        return _message(out + [(-1, key[0].as_py(), TOTALS, value[top].tobytes(), total[top].tobytes(), np.concatenate([sums, cls[top].astype(np.int64)]).tobytes())])

    sent = blocks.applyInArrow(send, MESSAGE)
    return stored(sent.groupBy("target").applyInArrow(answer, MESSAGE), "lm-counts")


class Vocabulary:
    """The symbols and the corpus's totals.  Symbols are numbered by falling count;
    the suffix classes are symbols among them."""

    def __init__(self, top: list[tuple[int, int, int]], class_counts: np.ndarray, class_words: np.ndarray):
        end = [t for t in top if t[0] == int(END)]
        words = [t for t in top if t[0] != int(END)][:WORDS - 1]
        self.total = int(class_counts.sum()) + sum(t[1] for t in end)
        self.distinct = int(class_words.sum()) + len(end)
        rest_counts, rest_words = class_counts.astype(float), class_words.astype(float)
        for _, n, c in words:
            rest_counts[c] -= n
            rest_words[c] -= 1
        #: weight of a suffix class: the base formula's, with one unseen word
        self.class_weight = rest_counts + 0.5 * rest_words + 0.5
        names = [(t[1] + 0.5, int(t[0]), -1) for t in words] + [((end[0][1] if end else 0) + 0.5, int(END), -1)] + [(w, 0, k) for k, w in enumerate(self.class_weight)]
        names.sort(key=lambda t: (-t[0], t[2], t[1]))
        self.weight = np.array([t[0] for t in names])
        self.suffix_symbol = np.zeros(SUFFIXES, np.int64)
        own = []
        for k, (_, h, c) in enumerate(names):
            if c >= 0:
                self.suffix_symbol[c] = k
            else:
                own.append((h, k))
        own.sort()
        self.hashes = np.array([h for h, _ in own], np.uint64)
        self.symbols = np.array([k for _, k in own], np.int64)

    def symbol(self, h: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of each token, and whether it is a word's own."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        own = self.hashes[at] == h
        return np.where(own, self.symbols[at], self.suffix_symbol[cls]), own


def vocabulary(counts: DataFrame, n: int) -> Vocabulary:
    """From the buckets' TOTALS: sums of fixed size, and the WORDS most frequent words,
    the end before all: the totals need its count, however rare it is."""
    totals = counts.where(F.col("kind") == TOTALS)

    def merged(key, table):
        h = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("a").to_pylist()])
        c = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("b").to_pylist()])
        rest = [np.frombuffer(x, np.int64) for x in table.column("c").to_pylist()]
        cls = np.concatenate([x[2 * SUFFIXES:] for x in rest])
        top = np.lexsort((h, -c, h != END))[:WORDS]
        return _message([(-1, 0, TOTALS, h[top].tobytes(), c[top].tobytes(), np.concatenate([np.sum([x[:2 * SUFFIXES] for x in rest], 0), cls[top]]).tobytes())])

    while n > 64:  # levels of merging, so that few rows reach the driver
        n = max(64, n // 64)
        totals = totals.withColumn("target", F.pmod("origin", F.lit(n))).groupBy("target").applyInArrow(merged, MESSAGE).withColumn("origin", F.monotonically_increasing_id())
    rows = totals.collect()
    top, sums = [], np.zeros(2 * SUFFIXES, np.int64)
    for r in rows:
        rest = np.frombuffer(r["c"], np.int64)
        sums = sums + rest[:2 * SUFFIXES]
        top += zip(np.frombuffer(r["a"], np.uint64).tolist(), np.frombuffer(r["b"], np.int64).tolist(), rest[2 * SUFFIXES:].tolist())
    top.sort(key=lambda t: (t[0] != int(END), -t[1], t[0]))
    return Vocabulary(top[:WORDS], sums[:SUFFIXES], sums[SUFFIXES:])


# ---- the network --------------------------------------------------------------

SHAPES = {"inputs": (CLASSES * MEMBERS + 1, 3 * UNITS), "state": (UNITS, 3 * UNITS), "class_w": (UNITS, CLASSES), "class_b": (CLASSES,),
          "word_w": (CLASSES, MEMBERS, UNITS), "word_b": (CLASSES, MEMBERS)}


def initial_weights(vocab: Vocabulary, seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
    w["inputs"] = rng.normal(0, 0.3, SHAPES["inputs"]).astype(np.float32)
    w["state"] = rng.normal(0, 0.5 / np.sqrt(UNITS), SHAPES["state"]).astype(np.float32)
    weight = np.full(CLASSES * MEMBERS, 1e-3)
    weight[:len(vocab.weight)] = vocab.weight
    weight = weight.reshape(CLASSES, MEMBERS)
    w["class_b"] = np.log(weight.sum(1) / weight.sum()).astype(np.float32)
    w["word_b"] = np.log(weight / weight.sum(1, keepdims=True)).astype(np.float32)
    return w


def flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES])


def unflat(x: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = x[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


def _gates(rows: np.ndarray) -> np.ndarray:
    """Rows of (z, r, n) weights, z's and r's with their signs changed: ``step`` takes 1 / (1 + exp(-x))."""
    out = rows.reshape(-1, 3, UNITS).copy()
    np.negative(out[:, :2], out=out[:, :2])
    return out


def _read(rows: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Of rows of three parts, those of the symbols, part by part: (..., lanes) to (..., 3, lanes, UNITS)."""
    return np.take(rows.reshape(-1, UNITS), symbols[..., None, :] * 3 + np.arange(3)[:, None], axis=0)


def step(state, x, h, out):
    """One step of the unit from states h to ``out``: x, the inputs' parts (3, lanes, UNITS)
    with signs as in ``_gates``, becomes z, r and n; returns the states' part of n.
    ``state``: the states' weights, part by part."""
    g = np.matmul(h, state)
    zr, n = x[:2], x[2]
    zr += g[:2]
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    np.multiply(zr[1], g[2], out=out)
    n += out
    np.tanh(n, out=n)
    np.subtract(h, n, out=out)
    out *= zr[0]
    out += n
    return g[2]


def _chances(x):
    """Of scores (symbols, places): exp of each less its place's largest, and their sums."""
    x -= x.max(0)
    np.exp(x, out=x)
    return x, x.sum(0)


def _log_chance(x, at):
    """The log of the softmax over the rows of x (symbols, places), at row ``at`` of each place."""
    x -= x.max(0)
    own = x[at, np.arange(len(at))]
    return own - np.log(np.exp(x, out=x).sum(0))


def log_probabilities(w, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Natural log probability of each symbol given the state before it; class by
    class, in pieces that stay in the processor's cache."""
    cls, member = symbols // MEMBERS, symbols % MEMBERS
    order = np.argsort(cls.astype(np.uint8), kind="stable")
    cuts = np.searchsorted(cls[order], np.arange(CLASSES + 1)).tolist()
    states, member = states[order], member[order]
    found = np.empty(len(order), states.dtype)
    for i in range(0, len(order), PIECE):
        found[i:i + PIECE] = _log_chance(w["class_w"].T @ states[i:i + PIECE].T + w["class_b"][:, None], cls[order[i:i + PIECE]])
    for c, (a, b) in enumerate(zip(cuts, cuts[1:])):
        for i in range(a, b, PIECE):
            j = min(b, i + PIECE)
            found[i:j] += _log_chance(w["word_w"][c] @ states[i:j].T + w["word_b"][c][:, None], member[i:j])
    out = np.empty_like(found)
    out[order] = found
    return out


def gradients(w, x, y, new, real, h):
    """Of one truncated window, x, y, new and real of shape (steps, lanes): the
    gradients of the sum of the real symbols' negative log probabilities, by lane, and
    the state after the window.  Those of ``inputs`` are by row that was read (x's order)."""
    steps, lanes = x.shape
    kind = w["state"].dtype
    fresh = new.any(1).tolist()  # steps at which some document begins
    state = np.ascontiguousarray(_gates(w["state"]).transpose(1, 0, 2))
    gates = _read(w["inputs"], x)  # becomes z, r and n
    np.negative(gates[:, :2], out=gates[:, :2])
    before, states, u = (np.empty((steps, lanes, UNITS), kind) for _ in range(3))
    for t in range(steps):
        np.multiply(h, ~new[t][:, None], out=before[t]) if fresh[t] else np.copyto(before[t], h)
        u[t] = step(state, gates[t], before[t], states[t])
        h = states[t]
    target = y.ravel()
    order = np.argsort((target // MEMBERS).astype(np.uint8), kind="stable")  # class by class: one product for all symbols of a class
    hs, cls, member, place = states.reshape(-1, UNITS)[order], target[order] // MEMBERS, target[order] % MEMBERS, np.arange(target.size)
    counts = (real.ravel()[order] / lanes).astype(kind)  # places behind the material's end teach nothing
    d_class, total = _chances(w["class_w"].T @ hs.T + w["class_b"][:, None])
    d_class *= counts / total
    d_class[cls, place] -= counts
    d_sorted = d_class.T @ w["class_w"].T
    grad = {"class_w": (d_class @ hs).T, "class_b": d_class.sum(1), "word_w": np.zeros_like(w["word_w"]), "word_b": np.zeros_like(w["word_b"])}
    cuts = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist()
    present = [(c, slice(cuts[c], cuts[c + 1])) for c in range(CLASSES) if cuts[c + 1] > cuts[c]]
    d_word = np.empty((MEMBERS, len(cls)), kind)
    for c, own in present:
        np.matmul(w["word_w"][c], hs[own].T, out=d_word[:, own])
    d_word += w["word_b"].T[:, cls]
    d_word, total = _chances(d_word)
    d_word *= counts / total
    d_word[member, place] -= counts
    for c, own in present:
        np.matmul(d_word[:, own], hs[own], out=grad["word_w"][c])
        d_sorted[own] += d_word[:, own].T @ w["word_w"][c]
    grad["word_b"][[c for c, _ in present]] = np.add.reduceat(d_word, [own.start for _, own in present], axis=1).T
    d_states = np.empty_like(d_sorted)
    d_states[order] = d_sorted
    d_states = d_states.reshape(steps, lanes, UNITS)
    z, r, n = gates[:, 0], gates[:, 1], gates[:, 2]
    # what one unit of a state's gradient is to z, r and the states' part of n: all steps at once
    d_gates = np.empty((steps, lanes, 3, UNITS), kind)
    d_n = (1 - z) * (1 - n * n)
    d_gates[:, :, 0] = (before - n) * z * (1 - z)
    d_gates[:, :, 1] = d_n * u * r * (1 - r)
    d_gates[:, :, 2] = d_n * r
    d_h = np.zeros((lanes, UNITS), kind)
    back = w["state"].T.copy()
    for t in range(steps - 1, -1, -1):
        d = d_states[t]
        d += d_h
        d_gates[t] *= d[:, None]
        np.matmul(d_gates[t].reshape(lanes, -1), back, out=d_h)
        d_h += d * z[t]
        if fresh[t]:
            d_h *= ~new[t][:, None]
    grad["state"] = before.reshape(-1, UNITS).T @ d_gates.reshape(-1, 3 * UNITS)
    np.multiply(d_states, d_n, out=d_gates[:, :, 2])
    return grad, d_gates.reshape(steps, lanes, 3 * UNITS), h


def _learn(memory, g, rate, clip):
    """The step of weights with gradients g; adds to their sums of squares in ``memory``."""
    np.clip(g, -clip, clip, out=g)
    by = g * g
    memory += by
    np.sqrt(memory, out=by)
    np.divide(g, by, out=by)
    by *= rate
    return by


def update(w, memory, x, y, new, real, h, rate: float = 0.05, clip: float = 5.0):
    """One window's step: changes w and its sums of squared gradients in ``memory``;
    returns the state after the window."""
    grad, d_x, h = gradients(w, x, y, new, real, h)
    for k, g in grad.items():
        w[k] -= _learn(memory[k], g, rate, clip)
    # rows of inputs: only those that were read
    order = np.argsort(x.ravel().astype(np.uint16), kind="stable")
    read = x.ravel()[order]
    at = np.flatnonzero(np.concatenate([[True], read[1:] != read[:-1], [True]]))
    times, at = np.diff(at), at[:-1]
    used, d_x = read[at], d_x.reshape(-1, 3 * UNITS)
    g, several = d_x[order[at]], times > 1  # reduceat is slow on rows read once
    if several.any():
        begin = np.cumsum(times[several]) - times[several]
        pairs = np.result_type(g, np.complex64)  # two numbers are added as one: half the calls
        g[several] = np.add.reduceat(d_x[order[np.repeat(several, times)]].view(pairs), begin, axis=0).view(g.dtype)
    squares = memory["inputs"][used]
    w["inputs"][used] -= _learn(squares, g, rate, clip)
    memory["inputs"][used] = squares
    return h


def train_on(w, symbols: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Weights after all documents (symbols, offsets), dealt to lanes one behind the
    other, have been read window by window to their last symbol; the last lane is
    filled up with places that don't count.  Material of fewer than LEAST_UPDATES
    windows is read again until there are as many.  More lanes are used where
    ENOUGH_UPDATES windows remain, with longer steps."""
    w = {k: v.copy() for k, v in w.items()}
    if not len(symbols):
        return w
    start, symbols = CLASSES * MEMBERS, symbols.astype(np.int32)
    previous = np.concatenate([symbols[:1], symbols[:-1]])
    new = np.zeros(len(symbols), bool)
    new[first[:-1]] = True
    previous[new] = start
    lanes = min(max(LANES, len(symbols) // (WINDOW * ENOUGH_UPDATES)), MOST_LANES, len(symbols))
    rate = RATE * max(1, lanes / LANES) ** (2 / 3)
    n = -(-len(symbols) // lanes)
    fill = n * lanes - len(symbols)
    x, y, z, real = (np.ascontiguousarray(np.concatenate([a, np.full(fill, v, a.dtype)]).reshape(lanes, n).T) for a, v in ((previous, start), (symbols, 0), (new, True), (np.ones(len(symbols), np.float32), 0)))
    memory = {k: np.full(s, 1e-2, np.float32) for k, s in SHAPES.items()}
    done = 0
    while done < LEAST_UPDATES:
        h = np.zeros((lanes, UNITS), np.float32)
        for t in range(0, n, WINDOW):
            h = update(w, memory, x[t:t + WINDOW], y[t:t + WINDOW], z[t:t + WINDOW], real[t:t + WINDOW], h, rate)
            done += 1
    return w


def score_documents(w, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Natural log probability of each symbol; documents of about one length run side
    by side, SIDE at a time, and each keeps its state until its end.  The inputs of
    some steps are read at once; what is behind a document's end in them isn't kept."""
    out = np.zeros(len(symbols))
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    rows = _gates(w["inputs"])
    state = np.ascontiguousarray(_gates(w["state"]).transpose(1, 0, 2))
    states, places, held = np.empty((HELD + max(SIDE * STEPS[0], AT_ONCE), UNITS), np.float32), [], 0

    def flush():
        at = np.concatenate(places)
        inside = np.flatnonzero(at >= 0)
        out[at[inside]] = log_probabilities(w, states[inside], symbols[at[inside]])

    for i in range(0, len(order), SIDE):
        begin, size = first[order[i:i + SIDE]], sizes[order[i:i + SIDE]]
        h, t, last = np.zeros((len(size), UNITS), np.float32), 0, int(size[0])
        while t < last:
            live = int(np.searchsorted(-size, -t, "left"))  # documents of more than t symbols
            steps = min(last - t, max(STEPS[0], min(STEPS[1], AT_ONCE // live)))
            step_of = np.arange(t, t + steps)[:, None]
            at = np.where(step_of < size[:live], begin[:live] + step_of, -1)
            x = _read(rows, np.where(step_of > 0, symbols[at - 1], CLASSES * MEMBERS))
            to = states[held:held + steps * live].reshape(steps, live, UNITS)
            h = h[:live]
            for k in range(steps):
                step(state, x[k], h, to[k])
                h = to[k]
            h = h.copy()
            places.append(at.ravel())
            held, t = held + steps * live, t + steps
            if held >= HELD:
                flush()
                places, held = [], 0
    if held:
        flush()
    return out


def trained(docs: DataFrame, vocab: Vocabulary, n_blocks: int) -> dict[str, np.ndarray]:
    """The network after ROUNDS rounds over (doc_id, text, held_out)."""
    spark = docs.sparkSession
    w = initial_weights(vocab)
    trainers = max(1, n_blocks // 4)
    mark = F.xxhash64("doc_id", "text")
    for k in range(ROUNDS):
        shared = spark.sparkContext.broadcast((vocab, w))  # of fixed size

        def learn(key, table):
            known, start = shared.value
            column = pc.take(table.column("text"), pc.sort_indices(table.column("mark")))  # the same order in every attempt
            h, cls, first = tokens(column)
            symbols, _ = known.symbol(h, cls)
            got = train_on(start, symbols, first)
            return pa.table({"n": [len(symbols)], "w": [flat(got).astype(np.float32).tobytes()]}, schema=pa.schema([("n", pa.int64()), ("w", pa.binary())]))

        def mean(key, table):
            n = np.array(table.column("n").to_pylist(), float)
            total = sum(m * np.frombuffer(x, np.float32).astype(float) for m, x in zip(n, table.column("w").to_pylist())) / max(n.sum(), 1)
            return pa.table({"n": [int(n.sum())], "w": [total.astype(np.float32).tobytes()]}, schema=pa.schema([("n", pa.int64()), ("w", pa.binary())]))

        part = docs.where(~F.col("held_out") & (F.pmod(mark, F.lit(ROUNDS)) == k)).select("text", mark.alias("mark"), F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(trainers)).alias("trainer"))
        models = part.groupBy("trainer").applyInArrow(learn, "n long, w binary")
        wide = max(1, int(trainers ** 0.5))
        averaged = models.withColumn("g", F.pmod(F.xxhash64("w"), F.lit(wide))).groupBy("g").applyInArrow(mean, "n long, w binary").collect()
        total = sum(r["n"] for r in averaged)
        if total:
            w = unflat(sum(r["n"] * np.frombuffer(r["w"], np.float32).astype(float) for r in averaged) / total)
    return w


def scores(docs: DataFrame, held_out: Column, block_bytes: int = 14 << 20) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score and score (log10), learned from rows where
    ``held_out`` is false or null.

    Null and empty texts are the end alone.  Long texts are read to their end.  Rows
    that repeat are each learned from and scored alike; a null doc_id is held out as
    ``held_out`` says (null: it isn't), and rows spread over blocks and trainers by id
    and text.  Without training rows all counts are zero and each token has the base
    formula's probability of an unseen word.  Other columns are not read; an empty
    table gives no rows.
    """
    prepare(docs.sparkSession)
    n = block_count(docs, block_bytes=block_bytes)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))).groupBy("block")
    counts = corpus_counts(blocks, n)
    vocab = vocabulary(counts, n)
    shared = docs.sparkSession.sparkContext.broadcast((vocab, trained(rows, vocab, n)))

    def score(key, table, answers):
        known, w = shared.value
        h, cls, first = tokens(table.column("text"))
        value, inverse = np.unique(h, return_inverse=True)
        order, cuts = _by_bucket(value, n)
        count = np.zeros(len(value), np.int64)
        for bucket, raw in zip(answers.column("origin").to_pylist(), answers.column("a").to_pylist()):
            count[order[cuts[bucket]:cuts[bucket + 1]]] = np.frombuffer(raw, np.int64)
        c = count[inverse]
        base = np.log10((count + 0.5) / (known.total + 0.5 * (known.distinct + 1)))[inverse]
        symbol, own = known.symbol(value, np.zeros(len(value), np.int64))  # different words are looked up once
        own = own[inverse]
        symbols = np.where(own, symbol[inverse], known.suffix_symbol[cls])
        log10 = score_documents(w, symbols, first) / np.log(10)
        log10[~own] += np.log10((c[~own] + 0.5) / known.class_weight[cls[~own]])
        sums = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731 - no document is without tokens
        return pa.table({"doc_id": table.column("doc_id"), "held_out": table.column("held_out"), "n_tokens": np.diff(first), "n_known": sums((c > 0).astype(np.int64)),
                         "train_tokens": np.full(len(first) - 1, known.total), "base_score": sums(base), "score": sums(log10)})

    answers = counts.where(F.col("kind") == COUNTS).groupBy("target")
    return blocks.cogroup(answers).applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
