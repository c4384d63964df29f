"""Ranked search, whitening and token counts against brute-force versions on small
fixtures with nulls, empty and long texts, ties, repeated rows and clashing columns."""
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardsentry.llm import lexical, tokencount, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def low(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x or "")


def fixture():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdé1Ж漢") for _ in range(rng.randint(1, 5))) for _ in range(150)]
    texts = [None, "", " \n\t ", "-- !?", "one", "ONE one oNe", "x" * 3000, "漢字 漢字 Жук", "a\x1cb\x85c d  e\r\n\n f", "<|endoftext|> mark  <|endoftext|><|endoftext|>x", "don't we'll 's 'sh I'M 1234 ½³ ⅷ՘ ok",
             "\U00010940 odd letters ₏ here", "tail space   ", "\n\n\n", "é"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(3, 120))) for _ in range(80)]
    texts += [texts[20]] * 30  # ties
    texts.append(" ".join(rng.choice(words) for _ in range(50_000)) + "\n" + "y" * 100_000)
    rows = list(enumerate(texts))
    return rows + [(20, texts[20]), (None, texts[20]), (None, None), (25, texts[26])], words


ROWS, WORDS = fixture()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "x", 1, 2, 3, "y") for d, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, piece string, n long, rank int, item int, row string").repartition(4)


def ranked(rows, items, k):
    """item number -> [(doc_id, score)]"""
    terms = [TERM.findall(low(t)) for _, t in rows]
    tfs = [Counter(t) for t in terms]
    n_docs, n_all = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(t for c in tfs for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for (d, _), c, t in zip(rows, tfs, terms):
            m = 75 + 25 * len(t) * n_docs // n_all if n_all else 75
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[q] + 1))) * (10**9 * c[q] // (1000 * c[q] + 12 * m)) for q in TERM.findall(low(text)) if c[q])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item_id, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def key(rows):
    return sorted(tuple((x is None, 0 if x is None else x) for x in r) for r in rows)


def test_search_against_brute_force(spark, docs):
    items = [(1, " ".join(WORDS[:40])), (2, ROWS[20][1]), (2, "ONE " + WORDS[3]), (3, None), (4, "!!"), (None, WORDS[5] + " " + WORDS[5]), (7, "absent"), (8, "漢字 жук Жук"), (9, " ".join(WORDS * 3))]
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, score long")
    for k in (1, 7, 20):
        got = [tuple(r) for r in lexical.search(docs, asked, k).select("item_id", "rank", "doc_id", "score").collect()]
        assert key(got) == key(ranked(ROWS, items, k))
    # many rounds of few items give the same rows
    assert key([tuple(r) for r in lexical.search(docs, asked, 7, round_bytes=900).collect()]) == key(ranked(ROWS, items, 7))
    named = spark.createDataFrame([("a", WORDS[0])], "item_id string, text string")
    assert {r[0] for r in lexical.search(docs, named, 5).collect()} == {"a"}


def test_search_empty_tables(spark, docs):
    asked = spark.createDataFrame([(1, WORDS[0])], "item_id long, text string")
    assert lexical.search(docs.limit(0), asked).collect() == []
    assert lexical.search(docs, asked.limit(0)).collect() == []
    assert lexical.search(docs.where("doc_id = 1"), asked).collect() == []


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(lexical, "SCAN_BYTES", 50)
    for _, t in ROWS[:-5]:
        got = [x.decode() for part in lexical.terms((t or "").encode()) for x in part]
        assert got == TERM.findall(low(t))


def test_weights_above_the_bound_are_spread_over_tiles():
    rng = random.Random(1)
    items = [Counter({t: rng.randint(1, 40) for t in rng.sample(range(30), rng.randint(1, 20))}) for _ in range(9)]
    weight = {t: rng.randint(0, 50) for t in range(30)}
    tiles = lexical.weight_tiles(items, weight, most=700, n_items=4, n_terms=6)
    counts = [([t for t in range(30) if rng.random() < 0.6], None) for _ in range(25)]
    counts = [(ts, [rng.randint(1, 9) for _ in ts]) for ts, _ in counts]
    lengths = np.array([rng.randint(75, 400) for _ in counts], np.int64)
    scores = np.zeros((9, 25), np.int64)
    for first, part in lexical.score_block(tiles, counts, lengths, 30):
        scores[first:first + len(part)] += part
    for tile in tiles:
        assert np.bincount(tile.row, tile.value).max() <= 700 and len(tile.terms) <= 6
    for i, item in enumerate(items):
        for d, (ts, fs) in enumerate(counts):
            want = sum(item[t] * weight[t] * (10**9 * f // (1000 * f + 12 * int(lengths[d]))) for t, f in zip(ts, fs) if t in item)
            assert scores[i, d] == want
    assert 10**9 * 10**9 // (1000 * 10**9 + 12 * 75) < lexical.MOST_IMPACT and lexical.MOST_WEIGHT * lexical.MOST_IMPACT < 1 << 53


def test_best_keeps_ties_by_id():
    best = lexical.Best(1, 3)
    for ids in ([9, 8, 7, 6, 5], [4, 3, 2, 1, 0]):
        best.offer(0, np.full((1, 5), 10), np.array(ids), np.array([i == 0 for i in ids]))
    (_, score, doc, nameless), = best.rows()
    assert doc.tolist() == [1, 2, 3] and score.tolist() == [10] * 3 and not nameless.any()


# --- whitening ---


def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 6)) * np.array([3, 2, 1, 0.5, 0.2, 0.1])
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(500 + k, base[7].tolist()) for k in range(40)] + [(None, base[3].tolist()), (3, base[3].tolist()), (600, (base[9] + 1e-9).tolist())]
    return rows + [(700, None), (701, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (702, [float("nan")] * 6), (703, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (704, []), (705, [1.0, -2.0])]


def spread(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, n long, packed string").repartition(3)


def expected(rows, most=4):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max(len(v) for _, v in kept)
    xs = [tuple(math.floor(256 * c) for c in v) + (0,) * (d - len(v)) for _, v in kept]
    fit = sorted(set(xs))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    v = np.array([[float(Fraction(n * sum(x[i] * x[j] for x in fit) - s[i] * s[j], n * n)) for j in range(d)] for i in range(d)])
    return kept, xs, n, s, v


def test_whitening_against_brute_force(spark):
    rows = vectors()
    kept, xs, n, s, v = expected(rows)
    fit = whitening.fit_whitening(spread(spark, rows))
    assert (fit.n, fit.sums) == (n, s) and np.allclose(np.sort(np.linalg.eigvalsh(v))[::-1][:4], fit.values, rtol=1e-10)
    got = whitening.whiten(spread(spark, rows)).collect()
    assert len(got) == 4 * len(kept)
    dev = {x: sum((n * a - b) ** 2 for a, b in zip(x, s)) for x in xs}
    assert sorted((r.vec_id is None, r.vec_id or 0, r.deviation) for r in got if r.component == 1) == sorted((i is None, i or 0, dev[x]) for (i, _), x in zip(kept, xs))
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    for r in got:
        assert r.n == n and abs(r.explained / (values[r.component - 1] / np.trace(v)) - 1) < 1e-9 and r.identity_error < 1e-9
    # whitened values, up to one sign for each component
    e, axes = np.linalg.eigh(v)
    want = (np.array([[float(Fraction(n * a - b, n)) for a, b in zip(x, s)] for x in xs]) @ axes[:, ::-1][:, :4]) / np.sqrt(e[::-1][:4])
    for c in range(4):
        by = {}
        for (i, _), x, w in zip(kept, xs, want):
            by.setdefault(i, []).append(w[c])
        mine = {}
        for r in got:
            if r.component == c + 1:
                mine.setdefault(r.vec_id, []).append(r.whitened)
        assert any(all(np.allclose(sorted(sign * y for y in mine[i]), sorted(by[i]), atol=1e-8) for i in by) for sign in (1, -1))


def test_whitening_edges(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], kind)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], kind)).collect()
    assert len(one) == 4 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.n == 1 for r in one)
    flat = whitening.whiten(spark.createDataFrame([(k, [float(k), 2.0, 3.0]) for k in range(5)], kind)).collect()
    assert {(r.component, r.whitened is None, r.explained) for r in flat} == {(1, False, 1.0), (2, True, 0.0), (3, True, 0.0)}
    # values beyond what products of longs hold stay exact
    large = [[2.0**44 * (k % 7) + k, -(2.0**42) * k, float(k * k)] for k in range(40)]
    out = whitening.whiten(spark.createDataFrame(list(enumerate(large)), "vec_id long, embedding array<double>"))
    _, xs, n, s, _ = expected(list(enumerate(large)))
    assert {r.vec_id: int(r.deviation) for r in out.collect()} == {k: sum((n * a - b) ** 2 for a, b in zip(x, s)) for k, x in enumerate(xs)}
    assert out.schema["deviation"].dataType.simpleString() == "decimal(38,0)"


def test_plane_products_are_exact():
    rng = np.random.default_rng(0)
    for bits in ([3, 0, 9, 1], [33, 5, 0, 40], [64, 1, 64, 12]):
        u = np.stack([rng.integers(0, 1 << b, 300, dtype=np.uint64, endpoint=False) if 0 < b < 64 else rng.integers(0, 2**64 - 1, 300, dtype=np.uint64) if b else np.zeros(300, np.uint64) for b in bits], 1)
        big = u.astype(object)
        want = [[sum(big[:, i] * big[:, j]) if i <= j else 0 for j in range(4)] for i in range(4)]
        assert whitening.plane_products(u, np.array(bits)).tolist() == want


# --- token counts ---


def library_counts():
    fresh = Tokenizer.from_file(PATH)
    return sorted((d is None, d or 0, len((t or "").encode()), len(fresh.encode(t or "", add_special_tokens=False).ids)) for d, t in ROWS)


@pytest.mark.parametrize("head_bytes", [0, 3000, 32 << 20])
def test_token_counts_equal_the_library(docs, head_bytes):
    got = tokencount.token_counts(docs, PATH, 512, head_bytes).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == library_counts()
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_pieces_are_counted_once(docs):
    pieces = [r.piece for r in tokencount.piece_counts(docs, PATH).collect()]
    assert len(pieces) == len(set(pieces)) > 100


def test_token_counts_of_empty_table(docs):
    assert tokencount.token_counts(docs.limit(0), PATH).collect() == []


def test_stretches_cut_where_pre_tokens_end(monkeypatch):
    monkeypatch.setattr(tokencount, "SCAN_CHARS", 20)
    cutter = tokencount.Cutter(PATH)
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "b1", " ", " ", "\n", "'s", "é", "!", " ", "\x1c", "½", "<|endoftext|>", "՘", "漢"]) for _ in range(rng.randint(0, 60)))
        found, n = cutter.frequencies(text)
        assert n + sum(f * cutter.count(p) for p, f in found.items()) == len(cutter.library.encode(text, add_special_tokens=False).ids)


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tokencount.Cutter(public_tokenizers.path("word_bpe_49k.json"))
