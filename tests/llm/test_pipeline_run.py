"""``corpus_pipeline.run`` against a brute-force version of its stages, and on odd tables."""
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cardsentry.llm import quality, queries

SF = "/root/testdata/sf0.001"
SPACED, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x or "")


def tables(folder):
    """sf0.001 with a repeated row, a second text under an id, rows without id, text or language."""
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    long = max(docs, key=lambda r: len(r["text"] or ""))
    extra = [dict(docs[3]), dict(docs[5], text=docs[8]["text"]), dict(docs[9], doc_id=None), dict(docs[10], doc_id=900_001, text=None), dict(docs[11], doc_id=900_002, text=""),
             dict(docs[12], doc_id=900_003, lang=None), dict(long, doc_id=900_004, text=((long["text"] or "") + "\n") * 3)]
    pq.write_table(pa.Table.from_pylist(docs + extra, schema=pq.read_schema(f"{SF}/documents.parquet")), f"{folder}/documents.parquet")
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    pq.write_table(pa.Table.from_pylist(items + [dict(items[0], item_id=None, text=" ".join((docs[20]["text"] or "x").split()[:15]))], schema=pq.read_schema(f"{SF}/benchmark.parquet")), f"{folder}/benchmark.parquet")
    pq.write_table(pq.read_table(f"{SF}/labels.parquet"), f"{folder}/labels.parquet")
    return docs + extra, [x["text"] for x in items] + [" ".join((docs[20]["text"] or "x").split()[:15])]


def distinct(rows):
    """Rows of the smallest id of each component; rows of one id and text are one."""
    sets = []
    for r in rows:
        w = SPACED.findall(low(r["text"]))
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))
    find = lambda x: x if root[x] == x else find(root[x])
    for i, x in enumerate(sets):
        for j in range(i):
            if rows[i]["doc_id"] is not None and rows[j]["doc_id"] is not None and x and sets[j] and 100 * len(x & sets[j]) >= 85 * len(x | sets[j]):
                root[find(i)] = find(j)
    smallest = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            smallest[find(i)] = min(smallest.get(find(i), r["doc_id"]), r["doc_id"])
    return [r for i, r in enumerate(rows) if r["doc_id"] is None or not sets[i] or r["doc_id"] == smallest[find(i)]]


def clean(rows, items):
    windows = {tuple(w[k:k + 13]) for t in items for w in [ALNUM.findall(low(t))] if w for k in range(max(1, len(w) - 12))}
    out = []
    for r in rows:
        w = ALNUM.findall(low(r["text"]))
        hit = {j for n in {len(x) for x in windows} for k in range(len(w) - n + 1) if tuple(w[k:k + n]) in windows for j in range(k, k + n)}
        if not hit or 20 * len(hit) < len(w):
            out.append(r)
    return out


def mixed(rows):
    """By the mixing query's SQL with the stage's budget; rows without id and repeated ones don't occur here."""
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([dict(r, lang=r["lang"] or "unknown") for r in rows]))
    copies = {r[0]: r[5] for r in con.sql(queries.SQL["op4_mixing"].replace("* 600 // 1000", "* 900 // 1000")).fetchall()}
    return [r for r in rows for _ in range(copies.get(r["doc_id"], 0))]


def test_run_against_brute_force(spark, tmp_path):
    rows, items = tables(tmp_path)
    folder = str(tmp_path)
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality.learned_rules(docs, labels)
    kept = Counter((r.doc_id, r.text) for r in quality.judged(docs, rules).where("q_kept").select("doc_id", "text").collect())
    want = [r for r in rows if kept[r["doc_id"], r["text"]]]
    assert sum(kept.values()) == len(want) and len(want) > 100
    stages = dict(corpus_pipeline.STAGES)
    now = docs
    for name, brute in (("quality_rules", lambda x: x), ("near_duplicates", distinct), ("decontamination", lambda x: clean(x, items))):
        now, want = stages[name](spark, now, folder), brute(want)
        assert now.columns == docs.columns
        assert Counter((r.doc_id, r.text, r.lang) for r in now.select("doc_id", "text", "lang").collect()) == Counter((r["doc_id"], r["text"], r["lang"]) for r in want), name
    # the mixture of rows with an id of their own, as SQL can tell them apart
    once = Counter(r["doc_id"] for r in want)
    some = [r for r in want if r["doc_id"] is not None and once[r["doc_id"]] == 1]
    assert len(some) > 60
    one = now.where("doc_id is not null").join(spark.createDataFrame([(r["doc_id"],) for r in some], "doc_id long"), "doc_id", "left_semi").select(docs.columns)
    expected = mixed(some)
    mixture = stages["mix_sources"](spark, one, folder)
    assert Counter(r.doc_id for r in mixture.select("doc_id").collect()) == Counter(r["doc_id"] for r in expected)
    got = stages["token_ids"](spark, mixture, folder).orderBy("start").collect()
    check_tokens(got, expected)
    # run() itself: the same stages one behind the other
    whole = corpus_pipeline.run(spark, folder).collect()
    chained = now
    for name in ("mix_sources", "token_ids"):
        chained = stages[name](spark, chained, folder)
    assert sorted(map(str, whole)) == sorted(map(str, chained.collect())) and len(whole) > 60


def check_tokens(got, expected):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids + [2] for r in expected}
    assert Counter(r.doc_id for r in got) == Counter(r["doc_id"] for r in expected)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids[r.doc_id]), zlib.crc32(np.array(ids[r.doc_id], "<u4").tobytes()))
        at += r.n_tokens


def test_run_on_empty_tables(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        pq.write_table(pq.read_table(f"{SF}/{t}.parquet").slice(0, 0), f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_return_columns_with_clashing_names(spark):
    clash = {"key": F.lit(1), "gone": F.lit(2), "gone_text": F.lit(3), "mix_copies": F.lit(4), "q_kept": F.lit(5), "node": F.lit(6), "row": F.lit(7)}
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40).withColumns(clash)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.where("gone <> 2 or node <> 6").count() == 0, name
