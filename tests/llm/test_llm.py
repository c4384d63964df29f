"""The training-data operators against brute-force versions on a small fixture
with nulls, empty and long texts, ties, repeated rows and clashing columns."""
import hashlib
import random
import re
import struct
import zlib
from collections import Counter
from math import log10

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardsentry.llm import (decontaminate, lm, mixing, neardup, quality, sharding, suffixdedup, tokens, toxicity, warc)
from cardsentry.llm import queries as q

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def low(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x or "")


def fixture():
    """(doc_id, text): prose with copies, near copies, shared passages and odd rows."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéß1") for _ in range(rng.randint(1, 7)))
    passage = " ".join(word() for _ in range(40))
    texts = [None, "", "   \n\t", "one", "Two words", "a b c d", "x" * 70, " nbsp  double\r\n\nlines", "<|endoftext|> mark"]
    for k in range(30):
        body = [word() for _ in range(rng.randint(20, 120))]
        if k % 3 == 0:
            body[5:5] = passage.split()
        texts.append(" ".join(body) + ("\nSame line here\nSame line here" if k % 4 == 0 else ""))
    base = texts[12].split(" ")
    texts += [texts[12], texts[12], " ".join(base[:-1] + ["changed"]), " ".join(["Changed"] + base[1:])]
    texts.append(" ".join(word() for _ in range(60_000)))
    rows = [(k, t) for k, t in enumerate(texts)]
    return rows + [(11, texts[11]), (None, texts[12]), (None, None)], passage


ROWS, PASSAGE = fixture()


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns with names that the operators use inside
    rows = [(d, t, "en", f"src{(d or 0) % 5}", len(t or ""), 1, "x") for d, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, q_words int, key string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_codec_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1001):
        x = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32) >> rng.integers(0, 32, n).astype(np.uint32)
        assert (tokens.unpack(*tokens.pack(x), n) == x).all()


def test_token_files(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = tokens.token_output(docs, path, lists=True).orderBy("start").collect()
    library = tokens.Encoder(path).library
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
        start += r.n_tokens
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert [key(r)[:2] for r in got] == sorted(key(r)[:2] for r in got)
    want = sorted((d, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in ROWS if d is not None)
    assert sorted((r.doc_id, r.ids) for r in got if r.doc_id is not None) == want
    assert tokens.token_output(empty, path).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 24, 200])
def test_decontamination(spark, docs, empty, block_bytes):
    items = [("7", PASSAGE), ("70", PASSAGE.upper()), ("3", "two WORDS"), ("x", None), ("e", "  "), (None, "a b c d"), ("9", " ".join(PASSAGE.split()[5:25]) + " else")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    windows = {}
    for name, text in items:
        w = ALNUM.findall(low(text))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k:k + 13]), set()).update([name] if name else [])
    want = []
    for d, t in ROWS:
        w = ALNUM.findall(low(t))
        hit, names = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (found := windows.get(tuple(w[k:k + size]))) is not None:
                    names |= found
                    hit |= set(range(k, k + size))
        want.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    out = decontaminate.contamination(docs, bench, block_bytes=block_bytes)
    got = [tuple(r) for r in out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(r[-1] for r in got)
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_near_duplicates(docs, empty):
    sets = {}
    for d, t in ROWS:
        w = SPACED.findall(low(t))
        sets[d, t] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    root = {d: d for d, _ in ROWS if d is not None}
    find = lambda x: x if root[x] == x else find(root[x])
    named = [(d, s) for (d, _), s in sets.items() if d is not None and s]
    for i, (a, x) in enumerate(named):
        for b, y in named[:i]:
            if 100 * len(x & y) >= 85 * len(x | y):
                p, r = sorted((find(a), find(b)))
                root[r] = p
    got = neardup.near_duplicates(docs).collect()
    want = [(d, len(sets[d, t]), None if d is None else find(d), d is None or find(d) == d) for d, t in ROWS]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert any(not r.kept for r in got)
    assert neardup.near_duplicates(empty).count() == 0


def test_star_links_against_all_pairs():
    rng = np.random.default_rng(3)
    base = np.arange(100, 220, dtype=np.uint64)
    family = []
    for k in range(8):  # clusters around texts that differ from the centre's by 0 to 28 of 120
        middle = np.concatenate([np.delete(base, rng.choice(120, 2 * k, replace=False)), np.arange(2 * k, dtype=np.uint64) + 1000 * k])
        family += [np.unique(np.concatenate([np.delete(middle, rng.choice(len(middle), rng.integers(0, 7), replace=False)), rng.integers(0, 90, rng.integers(0, 5)).astype(np.uint64)])) for _ in range(10)]
    near = lambda x, y: 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y))
    linked = np.array([near(base, x) for x in family])
    got = neardup.star_links(list(range(80)), np.array([len(x) for x in family]), [np.setxor1d(base, x) for x in family], linked, np.ones(80, bool), 85, 100)
    want = {(i, j) for i in range(80) for j in range(80) if i < j and not (linked[i] and linked[j]) and near(family[i], family[j])}
    assert {tuple(sorted(x)) for x in got} == want and want


def test_quality_measures(docs, empty):
    got = quality.judged(docs, []).select("doc_id", "text", *("q_" + c for c in quality.COUNTS[:5]), "q_base_failed").collect()
    assert len(got) == len(ROWS)
    for r in got:
        t = r.text or ""
        w = SPACED.findall(t)
        lines = [x for x in t.split("\n") if SPACED.search(x)]
        seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        repeated = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        assert tuple(r[2:]) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated), len(w) < 50 or 100 * len(repeated) > 50 * len(w))
    assert quality.judged(empty, []).count() == 0


def test_quality_learns_a_conjunction(spark):
    rng = random.Random(1)
    rows = []
    for k in range(600):
        x, y = rng.random(), rng.random()
        rows.append((0 if x > 0.7 and y > 0.6 else 1, int(k % 3 == 0), *([x, y] + [0.5] * 6)))
    table = spark.createDataFrame(rows, "label int, part int, " + ", ".join(f + " double" for f in quality.FEATURES))
    rules = quality.learn(table)
    assert rules and sum(r.bad for r in rules) > 0.7 * sum(r[0] == 0 for r in rows) and sum(r.good for r in rules) <= 0.03 * len(rows)
    assert quality.learn(table.limit(0)) == []


def test_mixing_matches_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    got = sorted(map(tuple, q.QUERIES["op4_mixing"](spark, SF).collect()))
    assert got == sorted(con.sql(q.SQL["op4_mixing"]).fetchall()) and got


def test_mixing_edges(docs, empty):
    weights = mixing.Weights(source={"src0": 0})
    out = mixing.mixed(docs, F.lit("d"), weights, budget_permille=1000)
    assert out.columns == docs.columns
    assert out.where("source = 'src0' and length(trim(text)) > 60").count() == 0
    assert mixing.mixture(empty, F.lit("d"), weights).count() == 0


@pytest.mark.parametrize("data", [b"", b"a", b"aaaa", b"mississippi", b"abracadabra" * 9, bytes(range(1, 200)) * 2])
def test_two_stage_suffix_array(data):
    text = np.frombuffer(data, np.uint8)
    sa = suffixdedup.suffix_array(text, 500)
    assert sa.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    lcp = suffixdedup.common_prefixes(sa, suffixdedup._words(text), 50).tolist()
    for k in range(1, len(data)):
        x, y = data[sa[k - 1]:] + b"\0" * 50, data[sa[k]:] + b"\0" * 50
        assert lcp[k] == next((m for m in range(50) if x[m] != y[m]), 50)


def test_repeated_bytes(docs, empty):
    first, want = {}, []
    for d, t in ROWS:
        if d is not None:
            b = (t or "").encode()
            for k in range(len(b) - 49):
                first[b[k:k + 50]] = min(d, first.get(b[k:k + 50], d))
    for d, t in ROWS:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - 49 if d is not None else 0):
            if first[b[k:k + 50]] < d:
                gone[k] += 1
                gone[k + 50 if k + 50 <= len(b) else len(b)] -= 1
        c = np.cumsum(gone[:-1]) > 0
        spans = int(c[:1].sum() + (c[1:] & ~c[:-1]).sum())
        want.append((d, len(b), int(c.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~c].tobytes()).hexdigest()))
    for size in (10 << 20, 3000):
        got = [tuple(r) for r in suffixdedup.repeated_bytes(docs, block_bytes=size).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert any(r[2] for r in want)
    assert suffixdedup.repeated_bytes(empty).count() == 0


def test_byte_shards(docs, empty):
    got = sharding.byte_shards(docs, 4).orderBy("start").collect()
    total, at, slots = sum(r.size for r in got), 0, Counter()
    for r in got:
        assert r.start == at and r.shard == min(3, (2 * at + r.size) * 4 // (2 * total)) and r.slot == slots[r.shard]
        slots[r.shard] += 1
        at += r.size
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in ROWS)
    assert sharding.byte_shards(empty).count() == 0


def test_lm_counts_and_scores(docs, empty):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1
    rows = [(d, SPACED.findall(low(t)) + ["\n"], d is not None and zlib.crc32(str(d).encode()) % 5 == 1) for d, t in ROWS]
    c = Counter(w for _, t, h in rows if not h for w in t)
    n, size = sum(c.values()), sum(c.values()) + 0.5 * (len(c) + 1)
    got = lm.scores(docs, held, block_bytes=40_000).collect()
    want = sorted(((d, h, len(t), sum(c[w] > 0 for w in t), n, round(sum(log10((c[w] + 0.5) / size) for w in t), 4)) for d, t, h in rows), key=str)
    assert sorted((tuple(r[:5]) + (round(r.base_score, 4),) for r in got), key=str) == want
    assert all(r.score < 0 for r in got)
    assert lm.scores(empty, held).count() == 0


def test_lm_network_reads_every_training_document(spark):
    texts = [f"word{k} some more words" for k in range(6)]
    docs = spark.createDataFrame([(k, t, False) for k, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    h, cls, _ = lm.tokens(pa.array(texts))
    top = [(int(x), int((h == x).sum()), int(c)) for x, c in dict(zip(h.tolist(), cls.tolist())).items()]
    sums = [np.bincount(cls[h != lm.END], minlength=lm.SUFFIXES), np.bincount([c for x, _, c in top if x != int(lm.END)], minlength=lm.SUFFIXES)]
    vocab = lm.Vocabulary(top, *sums)
    before = lm.flat(lm.initial_weights(vocab))
    for k in range(6):  # a table of this one document must change the weights
        assert not np.array_equal(lm.flat(lm.trained(docs.where(f"doc_id = {k}"), vocab, 1)), before), k


def test_lm_counts_an_end_rarer_than_the_most_frequent_words(spark, monkeypatch):
    monkeypatch.setattr(lm, "trained", lambda docs, vocab, n: lm.initial_weights(vocab))  # counts only
    rng, texts = random.Random(3), []
    for _ in range(3):
        words = [f"w{k}" for k in range(2500)] * 10
        rng.shuffle(words)
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)) + [(3, "w1 unseen")], "doc_id long, text string")
    n, size = 3 * 25_001, 3 * 25_001 + 0.5 * 2502
    for block_bytes in (40_000, 2_000):  # a few buckets, and levels of merging
        got = {r.doc_id: r for r in lm.scores(docs, F.col("doc_id") == 3, block_bytes=block_bytes).collect()}
        assert all(r.train_tokens == n for r in got.values())
        assert got[3].n_known == 2 and abs(got[3].base_score - log10(30.5 / size) - log10(0.5 / size) - log10(3.5 / size)) < 1e-9
        assert abs(got[0].base_score - 25_000 * log10(30.5 / size) - log10(3.5 / size)) < 1e-6


def test_lm_probabilities_sum_to_one():
    class Flat:
        weight = np.arange(2048, 0, -1)

    w = lm.initial_weights(Flat())
    h = np.random.default_rng(0).normal(size=(1, lm.UNITS)).astype(np.float32)
    p = np.exp(lm.log_probabilities(w, np.repeat(h, 2048, 0), np.arange(2048)))
    assert abs(p.sum() - 1) < 1e-4


def test_warc_round_trip(spark, tmp):
    page = "<html>" + "y" * 200
    rows = [(5, "http://a", page), (2, None, page), (9, "u\r\nx", page), (7, "b", "short"), (1, "c", "short"), (8, "d", None), (3, "e", ""), (4, "f", "\x1f\x8b\x08 é" * 400), (None, "n", page), (6, "g", "z" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    want = sorted(((i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), *(("revisit", 2) if h == page and i != 2 else ("response", None))) for i, _, h in rows), key=str)
    names = spark.createDataFrame(warc.write_archives(pages, f"{tmp}/w").collect())
    for split in (1 << 20, 97):
        got = warc.read_archives(spark, f"{tmp}/w", split, names).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").coalesce(4).collect()
        assert sorted(map(tuple, got), key=str) == want
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, old = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[j] + 1, old[j + 1] + 1, old[j] + (x != y)))
    return row[-1]


def test_levenshtein_automaton():
    rng = random.Random(2)
    words, stems = {"abcab": 2.0, "abcde": 3.0, "ba": 1.0, "éabcd": 4.0}, {"cabd": 0.5}
    fuzzy = [w for w in words if len(w) >= 5]
    auto = toxicity.Automaton(words, stems, fuzzy)
    for _ in range(4000):
        w = list(rng.choice(list(words) + ["cabdab", "zzzz"]))
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "é", "x"])
        w = "".join(w) or "a"
        codes = np.frombuffer(w.encode("utf-32-le"), np.uint32)
        kind = int(auto.match(auto.classes[np.minimum(codes, toxicity.CODES)], np.array([0]), np.array([len(codes)]))[0][0])
        want = toxicity.EXACT if w in words else toxicity.STEM if any(w.startswith(s) for s in stems) else toxicity.FUZZY if any(_distance(w, x) <= 1 for x in fuzzy) else 0
        assert kind == want, w


def test_automaton_in_other_scripts():
    words = {"дурак": 2.0, "笨蛋": 3.0, "đồngốc": 1.5, "moron": 1.0}
    auto = toxicity.Automaton(words, {"ненав": 0.5, "滚开滚开": 4.0}, ["дурак", "đồngốc", "moron"])
    texts = {"дурак": (toxicity.EXACT, 2.0), "дурачук": (0, 0.0), "дурок": (toxicity.FUZZY, 2.0), "друрак": (toxicity.FUZZY, 2.0), "дура": (toxicity.FUZZY, 2.0), "д笨рак": (toxicity.FUZZY, 2.0), "дудак𝒳": (0, 0.0),
             "笨蛋": (toxicity.EXACT, 3.0), "笨": (0, 0.0), "笨人": (0, 0.0), "ненавижу": (toxicity.STEM, 0.5), "滚开滚开了": (toxicity.STEM, 4.0), "滚开": (0, 0.0), "đồngốc": (toxicity.EXACT, 1.5), "đồngóc": (toxicity.FUZZY, 1.5), "mдron": (toxicity.FUZZY, 1.0), "🙂": (0, 0.0)}
    for w, want in texts.items():
        codes = np.frombuffer(w.encode("utf-32-le"), np.uint32)
        kind, weight = auto.match(auto.classes[np.minimum(codes, len(auto.classes) - 1)], np.array([0]), np.array([len(codes)]))
        assert (int(kind[0]), float(weight[0])) == want, w
    x = toxicity.text_features(auto, ["ты дурак", "你 笨蛋", "ты кот", "🙂 你 好", None])
    assert (x[:2, 2] > 0).all() and not x[2:].any()


def test_toxicity_learns_terms_of_other_scripts(spark):
    rows = [(k, f"текст{k} {'дурак 笨蛋' if k % 2 else 'хорошо 你好'} слово", k % 2) for k in range(80)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    new = spark.createDataFrame([(100, "ты дурак"), (101, "他 笨蛋"), (102, "все хорошо")], "doc_id long, text string")
    docs = table.select("doc_id", "text").union(new)
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, table.select("doc_id", "toxic"), F.lit(True)).collect()}
    assert min(got[100], got[101]) > got[102] + 0.2


def test_quotation():
    assert toxicity.quoted('he said "you idiot" to', 13, 18) and not toxicity.quoted("you idiot", 4, 9)
    assert not toxicity.quoted('"a" idiot "b"', 4, 9) and toxicity.quoted("«an idiot then»", 4, 9)


def test_quotation_windows_are_words():
    long = "x" * 2_000
    assert toxicity.quoted(f'"{long} idiot {long}"', 2_002, 2_007)
    assert not toxicity.quoted('"a b c d e f g h i idiot"', 19, 24) and toxicity.quoted('"c d e f g h i idiot"', 15, 20)
    assert not toxicity.quoted('"one\nidiot"', 5, 10)


def test_misspelled_stems_and_ordinary_words_by_brute_force():
    words, stems, fuzzy, bent, plain = {"idiot": 2.0, "scum": 3.0}, {"moro": 1.0, "stupi": 1.5}, ["idiot", "scum"], ["moro", "stupi"], ["sum", "idiom", "studio"]
    auto = toxicity.Automaton(words, stems, fuzzy, bent, plain)
    rng = np.random.default_rng(5)
    base = [*words, *stems, *plain, "morons", "stupidly"]
    tries = set(base)
    for _ in range(4_000):
        w = list(base[rng.integers(len(base))])
        for _ in range(rng.integers(1, 3)):
            at, c = int(rng.integers(len(w) + 1)), "abdimorstuz"[rng.integers(11)]
            w[at:at + int(rng.integers(2))] = [c] if rng.random() < 0.7 else []
        tries.add("".join(w))
    tries = sorted(t for t in tries if t)
    near = auto.neighbours(tries)
    for w, got in zip(tries, near):
        whole = w in words or any(w.startswith(x) for x in stems) or w in plain
        want = set() if whole else {x for x in fuzzy if _distance(w, x) <= 1}
        begins = [] if whole else [x for x in bent if any(_distance(w[:k], x) <= 1 for k in range(len(w) + 1))]
        assert set(got) == want | {x + "*" for x in begins}, w


def test_misspelled_terms_are_caught_on_held_out_rows(spark):
    """Terms of the lexicon with one edit, in sentences of their own; neighbours that clean texts use stay clean."""
    rng = np.random.default_rng(6)
    terms = ["scumbag", "idiot", "moron", "vermin", "loser"]
    rows = [(k, f"text {k} you {terms[k % 5]} go away" if k % 2 else f"text {k} a vermil and a pleasant day", k % 2) for k in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    bent = []
    for t in terms:
        for _ in range(20):
            at = int(rng.integers(1, len(t)))
            bent.append(t[:at] + "qxz"[rng.integers(3)] + t[at + int(rng.integers(2)):])
    new = [(1_000 + k, f"text {k} you {w} go far") for k, w in enumerate(bent)] + [(5_000, "a vermil is nice"), (5_001, None), (5_001, "")]
    docs = table.select("doc_id", "text").union(spark.createDataFrame(new, "doc_id long, text string"))
    got = toxicity.toxicity(docs, table.select("doc_id", "toxic"), F.lit(True), precision=0.9).collect()
    score = {r.doc_id: r.score for r in got}
    assert sum(score[1_000 + k] > score[5_000] + 0.1 for k in range(len(bent))) >= 0.95 * len(bent)
    assert abs(score[5_000] - score[5_001]) < 0.05 and len(got) == 503


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = q.QUERIES["op10_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    toxic = [r for r in got if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic)
    assert sum(r.predicted for r in got if not r.toxic) <= 0.05 * (len(got) - len(toxic))


def test_toxicity_without_labels(spark, docs, empty):
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    out = toxicity.toxicity(docs, labels, F.lit(True)).collect()
    assert len(out) == len(ROWS) and all(r.predicted == 0 and 0 <= r.score <= 1 for r in out)
    assert toxicity.toxicity(empty, labels, F.lit(True)).count() == 0
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() > 0


def test_pipeline_stages(spark):
    """Each stage against its operator's own answer on that stage's input."""
    import corpus_pipeline as cp

    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"key": F.lit(1), "gone": F.lit(2), "mix_copies": F.lit(3), "q_kept": F.lit(4)})
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    steps = dict(cp.STAGES)
    one = steps["quality_rules"](spark, docs, SF)
    assert one.columns == docs.columns
    assert ids(one) == ids(quality.quality(docs, labels).where("kept"))
    two = steps["near_duplicates"](spark, docs, SF)
    assert two.columns == docs.columns and ids(two) == ids(neardup.near_duplicates(docs).where("kept"))
    three = steps["decontamination"](spark, docs, SF)
    assert three.columns == docs.columns and ids(three) == ids(decontaminate.contamination(docs, bench).where("not contaminated"))
    four = steps["mix_sources"](spark, docs, SF)
    assert four.columns == docs.columns and four.count() > 0


def test_joined_pieces_encode_as_the_library_does():
    texts = ["", None, " ", "\n", " a", "a \n b", "x y z", " \n", "don't stop <|endoftext|> now", "é è\tü", " a\0b c", "tail ", "日本語 テキスト 𝒳 y", "a\xa0b c", "word " * 500]
    enc = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = [x.ids + [70_000] for x in enc.library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):  # once learning the pieces, once from those kept
        ids, n = enc.encode(pa.array(texts), 70_000)
        assert ids.tolist() == [i for w in want for i in w] and n.tolist() == [len(w) for w in want]
    enc.width[:] = 1  # lengths that don't fit: pieces are encoded singly
    enc._clear()
    assert enc.encode(pa.array(texts), 70_000)[0].tolist() == ids.tolist()


def test_added_tokens_encode_as_a_fresh_library_does(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    fresh, end = Tokenizer.from_file(path), "<|endoftext|>"
    texts = [f"hello {end} world", end, f" {end}", f"{end} ", f"a{end}b c", f"a {end}{end}\nb", f"x\n{end}", f"a  {end}  b", "<|endoftext|", "< |endoftext|>", "plain words here"]
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [31373, 220, 50256, 995]
    enc = tokens.Encoder(path)
    for _ in range(2):
        ids, n = enc.encode(pa.array(texts), 70_000)
        assert [x[:-1].tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want
    rows = tokens.token_output(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, end_id=2, lists=True).collect()
    assert [r.ids for r in sorted(rows)] == [w + [2] for w in want]


def test_token_files_with_ids_beyond_two_bytes(spark):
    docs = spark.createDataFrame([(3, "a b"), (1, None), (None, "c"), (2, ""), (2, "")], "doc_id long, text string")
    rows = tokens.token_output(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=70_000, lists=True).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 2, 3]
    assert all(r.ids[-1] == 70_000 and len(r.ids) == r.n_tokens for r in rows) and [r.n_tokens for r in rows[1:4]] == [1, 1, 1]
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(5)]


def near(x, y):
    return 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y))


def joined(n, links):
    """For each of n members the smallest member that the links join it with."""
    root = list(range(n))
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in links:
        p, r = sorted((find(a), find(b)))
        root[r] = p
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("seed", range(8))
def test_spanning_links_join_what_all_links_join(seed):
    rng = np.random.default_rng(seed)
    base = np.arange(100, 220, dtype=np.uint64)
    family = []
    for k in range(10):
        middle = np.concatenate([np.delete(base, rng.choice(120, 3 * k, replace=False)), np.arange(3 * k, dtype=np.uint64) + 1000 * (k // 2)])
        family += [np.unique(np.concatenate([np.delete(middle, rng.choice(len(middle), rng.integers(0, 11), replace=False)), rng.integers(0, 90, rng.integers(0, 5)).astype(np.uint64)])) for _ in range(12)]
    order = rng.permutation(len(family))
    family = [family[k] for k in order]
    n, sizes, diffs = len(family), np.array([len(x) for x in family]), [np.setxor1d(base, x) for x in family]
    linked = np.array([near(base, x) for x in family])
    centre = [(int(np.flatnonzero(linked)[0]), int(k)) for k in np.flatnonzero(linked)] if linked.any() else []
    every = neardup.star_links(list(range(n)), sizes, diffs, linked, np.ones(n, bool), 85, 100)
    got = neardup.spanning_links(list(range(n)), sizes, diffs, linked, np.ones(n, bool), 85, 100)
    assert joined(n, centre + got) == joined(n, centre + every) and len(got) < n and set(map(frozenset, got)) <= set(map(frozenset, every))
    # met as two halves, as block pairs do
    half = np.arange(n) < n // 2
    parts = neardup.spanning_links(list(range(n)), sizes, diffs, linked, half, 85, 100) + neardup.spanning_links(list(range(n)), sizes, diffs, linked, ~half, 85, 100)
    assert joined(n, centre + parts) == joined(n, centre + every)


def test_a_large_star_without_its_centre_gives_a_link_for_each_member():
    """20,000 members near each other, none near the centre."""
    rng = np.random.default_rng(1)
    core, centre = np.arange(60, dtype=np.uint64), np.arange(12, 72, dtype=np.uint64)
    family = [np.concatenate([np.delete(core, rng.choice(60, 2, replace=False)), np.array([1000 + k], np.uint64)]) for k in range(20_000)]
    diffs, sizes = [np.setxor1d(centre, x) for x in family], np.full(20_000, 59)
    assert not near(centre, family[0])
    got = neardup.spanning_links(list(range(20_000)), sizes, diffs, np.zeros(20_000, bool), np.ones(20_000, bool), 85, 100)
    assert len(got) == 19_999 and set(joined(20_000, got)) == {0}


def test_two_texts_under_one_id(spark):
    """A row is judged by its own text: no text loses its last row."""
    rng = random.Random(4)
    t, u, v, w = (" ".join(f"{k}{rng.randint(0, 10**6)}" for _ in range(60)) for k in "tuvw")
    rows = [(1, t), (5, t), (5, u), (7, u), (5, v), (8, v), (3, w), (9, w + " more"), (5, w), (None, t)]
    docs = spark.createDataFrame([(d, x, "k") for d, x in rows], "doc_id long, text string, gone_text string").repartition(3)
    got = {(r.doc_id, r.text): r for r in neardup.judged(docs).join(docs.select(F.col("doc_id").alias("d"), "text", neardup.text_key().alias("k")), F.expr("text_key = k and doc_id <=> d")).select("doc_id", "text", "component_id", "kept").collect()}
    assert {k: r.component_id for k, r in got.items()} == {(1, t): 1, (5, t): 1, (5, u): 5, (7, u): 5, (5, v): 5, (8, v): 5, (3, w): 3, (5, w): 3, (9, w + " more"): 3, (None, t): None}
    left = neardup.distinct_documents(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(1, t), (5, u), (5, v), (3, w), (0, t)])


def test_repeated_ids_are_cut_for_their_own_text(spark):
    rng = random.Random(5)
    a, b = (" ".join(f"{k}{rng.randint(0, 10**6)}" for _ in range(40)) for k in "ab")
    rows = [(2, a), (5, a), (5, b), (5, b), (7, b), (None, a), (9, "")]
    got = suffixdedup.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    n = {"a": len(a), "b": len(b)}
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in got) == sorted([(2, n["a"], 0), (5, n["a"], n["a"]), (5, n["b"], 0), (5, n["b"], 0), (7, n["b"], n["b"]), (0, n["a"], 0), (9, 0, 0)])


def test_items_without_id_are_found(spark):
    words = [f"w{k}" for k in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "other text here"), (None, " ".join(words[:20]))], "doc_id long, text string")
    bench = spark.createDataFrame([(None, " ".join(words)), ("b", " ".join(words[10:24]))], "item_id string, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    assert (got[1].n_hit, got[1].n_items, got[1]["items"], got[1].contaminated) == (40, 1, ["b"], True)
    assert (got[None].n_hit, got[None].n_items, got[None].contaminated, got[2].contaminated) == (20, 0, True, False)
    assert [r.doc_id for r in decontaminate.clean(docs, bench).collect()] == [2]


def test_rows_that_share_hashes_of_their_parts(spark):
    """Nulls in different columns make different rows; 10,000 rows without id spread over hash ranges."""
    from cardsentry.llm.common import row_hash

    rows = [(1, None, "x", "s"), (1, "x", None, "s"), (1, "x", "x", None), (None, "x", None, "s"), (1, "x", "", "s"), (1, "", "x", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert docs.select(row_hash(*docs.columns)).distinct().count() == len(rows)
    many = spark.range(10_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"), F.lit("s1").alias("source"))
    out = mixing.mixture(many, F.lit("0"), mixing.Weights(), budget_permille=500, max_epochs=1)
    taken = out.where("copies > 0")
    assert out.count() == 10_000 and taken.count() == 5_000 and taken.select("key").distinct().count() == 5_000
    assert mixing.mixed(many, F.lit("0"), mixing.Weights(), budget_permille=500, max_epochs=1).count() == 5_000


def small_network(seed=0):
    rng = np.random.default_rng(seed)
    return {k: rng.normal(0, 0.4, s) for k, s in lm.SHAPES.items()}


def window(rng, steps, lanes):
    x, y = rng.integers(0, lm.CLASSES * lm.MEMBERS, (2, steps, lanes))
    return x, y, rng.random((steps, lanes)) < 0.3, (rng.random((steps, lanes)) < 0.8).astype(float)


def loss(w, x, y, new, real, h):
    """The window's loss step by step, one lane at a time, from the unit's formulas."""
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    total, u = 0.0, lm.UNITS
    for lane in range(x.shape[1]):
        s = h[lane]
        for t in range(x.shape[0]):
            s = np.zeros(u) if new[t, lane] else s
            i, g = w["inputs"][x[t, lane]], s @ w["state"]
            z, r = sigmoid(i[:u] + g[:u]), sigmoid(i[u:2 * u] + g[u:2 * u])
            n = np.tanh(i[2 * u:] + r * g[2 * u:])
            s = (1 - z) * n + z * s
            c, m = divmod(int(y[t, lane]), lm.MEMBERS)
            a, b = s @ w["class_w"] + w["class_b"], w["word_w"][c] @ s + w["word_b"][c]
            total -= real[t, lane] * (a[c] - np.log(np.exp(a).sum()) + b[m] - np.log(np.exp(b).sum()))
    return total / x.shape[1]


def test_network_gradients_against_differences():
    rng, w = np.random.default_rng(4), small_network()
    x, y, new, real = window(rng, 5, 3)
    h = rng.normal(0, 0.3, (3, lm.UNITS))
    grad, d_x, _ = lm.gradients(w, x, y, new, real, h.copy())
    full = np.zeros(lm.SHAPES["inputs"])
    np.add.at(full, x.ravel(), d_x.reshape(-1, 3 * lm.UNITS))
    for name, g in {**grad, "inputs": full}.items():
        # the largest entries and some others
        places = np.unique(np.concatenate([np.argsort(-np.abs(g).ravel())[:12], rng.integers(0, g.size, 6)]))
        for k in places.tolist():
            at, e = np.unravel_index(k, g.shape), 1e-5
            was = w[name][at]
            w[name][at] = was + e
            up = loss(w, x, y, new, real, h)
            w[name][at] = was - e
            down = loss(w, x, y, new, real, h)
            w[name][at] = was
            assert abs((up - down) / (2 * e) - g[at]) < 2e-4, (name, at)


def test_network_scores_whole_documents_with_carried_state():
    rng, w = np.random.default_rng(6), small_network(2)
    sizes = [1, 300, 7, 64, 0, 2]
    first = np.concatenate([[0], np.cumsum(sizes)])
    symbols = rng.integers(0, lm.CLASSES * lm.MEMBERS, first[-1])
    got = lm.score_documents({k: v.astype(np.float32) for k, v in w.items()}, symbols, first)
    for a, b in zip(first[:-1], first[1:]):
        if b > a:
            x = np.concatenate([[lm.CLASSES * lm.MEMBERS], symbols[a:b - 1]])[:, None]
            want = -loss(w, x, symbols[a:b][:, None], np.zeros((b - a, 1), bool), np.ones((b - a, 1)), np.zeros((1, lm.UNITS)))
            assert abs(got[a:b].sum() - want) < 1e-2 * (b - a)
    # a class's probabilities and those of its symbols each add up to one
    states = rng.normal(0, 1, (1, lm.UNITS)).repeat(lm.CLASSES * lm.MEMBERS, 0)
    assert abs(np.exp(lm.log_probabilities(w, states, np.arange(lm.CLASSES * lm.MEMBERS))).sum() - 1) < 1e-9


def test_training_reads_to_the_last_symbol():
    """The last symbols of a length that lanes don't divide change the weights."""
    rng = np.random.default_rng(1)
    n = lm.LANES * 40 + 7
    symbols = rng.integers(0, 50, n)
    w = {k: v.astype(np.float32) for k, v in small_network(3).items()}
    a = lm.train_on(w, symbols, np.array([0, n]))
    other = symbols.copy()
    other[-1] = 1999
    b = lm.train_on(w, other, np.array([0, n]))
    assert np.abs(a["word_w"][1999 // lm.MEMBERS] - b["word_w"][1999 // lm.MEMBERS]).max() > 0


def test_large_material_is_read_once_in_fewer_steps(monkeypatch):
    """Each symbol once, in windows of more lanes; small material keeps its lanes."""
    rng, w = np.random.default_rng(2), {k: v.astype(np.float32) for k, v in small_network(3).items()}
    for n, lanes, most in ((2_100_003, lm.MOST_LANES, 1_030), (110_000, 32, 220)):
        symbols, seen, steps = rng.integers(0, 2048, n), np.zeros(2048), []

        def update(w, memory, x, y, new, real, h, rate):
            seen[:] += np.bincount(y.ravel(), weights=real.ravel(), minlength=2048)
            steps.append(y.shape)
            return h

        monkeypatch.setattr(lm, "update", update)
        lm.train_on(w, symbols, np.array([0, 700, n]))
        assert len(steps) <= most and steps[0] == (lm.WINDOW, lanes)
        assert (seen == np.bincount(symbols, minlength=2048)).all()


def test_more_lanes_learn_as_well():
    """Held-out log probability of a chain of symbols: with the lanes of large material, no worse than with few."""
    rng = np.random.default_rng(5)
    follower, jumps = rng.integers(0, 300, 300), rng.random(1_100_000) < 0.3
    symbols = rng.integers(0, 300, len(jumps))
    for k in np.flatnonzero(~jumps[1:]) + 1:
        symbols[k] = follower[symbols[k - 1]]
    w = {k: np.zeros(s, np.float32) for k, s in lm.SHAPES.items()} | {"inputs": rng.normal(0, 0.3, lm.SHAPES["inputs"]).astype(np.float32), "state": rng.normal(0, 0.1, lm.SHAPES["state"]).astype(np.float32)}
    train, rest = symbols[:1_060_000], symbols[1_060_000:]
    ends = lambda x: np.append(np.arange(0, len(x), 500), len(x))
    found = {}
    for most in (lm.LANES, lm.MOST_LANES):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(lm, "MOST_LANES", most)
            found[most] = lm.score_documents(lm.train_on(w, train, ends(train)), rest, ends(rest)).mean()
    assert found[lm.MOST_LANES] > found[lm.LANES] - 0.01 and found[lm.LANES] > -4


def test_scores_do_not_depend_on_batches(monkeypatch):
    rng, w = np.random.default_rng(8), {k: v.astype(np.float32) for k, v in small_network(5).items()}
    first = np.concatenate([[0], np.cumsum(rng.integers(0, 60, 200))])
    symbols = rng.integers(0, lm.CLASSES * lm.MEMBERS, first[-1])
    whole = lm.score_documents(w, symbols, first)
    for side, held, piece, steps, at_once in ((3, 10, 4, (2, 5), 8), (1, 1, 1, (1, 1), 1), (64, 1000, 7, (16, 256), 1 << 13)):
        for k, v in (("SIDE", side), ("HELD", held), ("PIECE", piece), ("STEPS", steps), ("AT_ONCE", at_once), ("TEXT_PIECE", held)):
            monkeypatch.setattr(lm, k, v)
        assert np.abs(lm.score_documents(w, symbols, first) - whole).max() < 1e-4
    assert len(lm.score_documents(w, symbols[:0], np.zeros(1, int))) == 0 and len(lm.score_documents(w, symbols[:0], np.zeros(3, int))) == 0
