"""Benchmark decontamination with suffix arrays over the training documents.

Documents are cut into shards (about ``shard_bytes`` of text within a task).
Each shard gets a word-level suffix array: its suffixes are sorted on the words
of the benchmark's vocabulary, and every suffix of every benchmark item is
searched in it by bisection, all at once in numpy.  The neighbours of the place
found give the longest verbatim match; the range of suffixes that begin with a
whole window gives all places of that window.

A suffix can only hold a window if at least as many words as the shortest window
has follow one another that the benchmark knows, so other suffixes don't enter
the array.  The first test of a word is its 64-bit hash (which never misses a
known word); documents with a long enough run are then read word by word and the
array is built on exact word numbers.

The benchmark reaches the tasks in blocks of at most ``block_bytes``: one
broadcast and one pass over the rows (chained in the same job, no shuffle) for
each block, so its size is bounded however large the benchmark is.
"""
from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ALNUM, LOWER, prepare, row_hash, slices, utf8, whole_rows, word_hashes, word_runs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = {c: c + 32 for c in range(65, 91)}
PACK, BITS = 2, 31  # words of a sort key, and bits of each


def words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(_UPPER)) if text else []


@dataclass
class Benchmark:
    """One block of items as word numbers (1 and up; 0: not in the benchmark); an item's id may be null."""

    vocabulary: dict[str, int]
    hashes: np.ndarray  # sorted, of the vocabulary
    tokens: np.ndarray  # all items, each followed by PACK * depth zeros
    item_at: np.ndarray  # item of each token
    suffixes: np.ndarray  # start of each suffix in tokens
    windows: list[tuple[int, int, list[str]]]  # start in tokens, words, ids of the items with that window
    items: list[str | None]
    shortest: int
    longest: int


def benchmark_index(rows: list[tuple[str, str | None]], width: int) -> Benchmark:
    vocabulary: dict[str, int] = {}
    tokens: list[int] = []
    item_at: list[int] = []
    suffixes: list[int] = []
    found: dict[tuple[int, ...], list] = {}
    items: list[str] = []
    texts = [(name, [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)]) for name, text in rows]
    longest = max((len(w) for _, w in texts), default=0)
    for name, w in texts:
        if not w:
            continue
        start, size = len(tokens), min(width, len(w))
        for k in range(len(w) - size + 1):
            entry = found.setdefault(tuple(w[k:k + size]), [start + k, size, []])
            if entry[2][-1:] != [name]:
                entry[2].append(name)  # an item without id is found, but has no name to report
        suffixes += range(start, start + len(w))
        tokens += w + [0] * PACK
        item_at += [len(items)] * (len(w) + PACK)
        items.append(name)
    blob = "".join(vocabulary).encode()
    ends = np.cumsum([len(w.encode()) for w in vocabulary], dtype=np.int64)
    hashes = np.sort(word_hashes(np.frombuffer(blob, np.uint8), ends - np.diff(ends, prepend=0), ends)) if vocabulary else np.zeros(0, np.uint64)
    return Benchmark(vocabulary, hashes, np.array(tokens + [0] * PACK, np.int64), np.array(item_at, np.int64), np.array(suffixes, np.int64),
                     [tuple(x) for x in found.values()], items, min((x[1] for x in found.values()), default=0), longest)


def packed(tokens: np.ndarray) -> np.ndarray:
    """For each place, the next PACK word numbers in one integer; places past the end count as 0."""
    t = np.concatenate([tokens, np.zeros(PACK, np.int64)])
    key = np.zeros(len(tokens), np.int64)
    for k in range(PACK):
        key = (key << BITS) | t[k:k + len(tokens)]
    return key


def suffix_array(tokens: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of their suffixes' first ``depth`` words.

    Sorted on PACK words first; only suffixes that still tie are sorted again,
    on the PACK words that follow.
    """
    key = packed(tokens)
    at = starts[np.argsort(key[starts], kind="stable")]
    group = np.cumsum(np.diff(key[at], prepend=key[at[:1]] if len(at) else 0) != 0)
    for step in range(PACK, depth, PACK):
        same = np.zeros(len(at) + 1, bool)
        same[1:-1] = group[1:] == group[:-1]
        tied = np.flatnonzero(same[:-1] | same[1:])
        if not len(tied):
            break
        where = at[tied] + step
        nxt = np.where(where < len(key), key[np.minimum(where, len(key) - 1)], 0)
        order = np.lexsort((nxt, group[tied]))
        at[tied] = at[tied][order]
        g, nxt = group[tied][order], nxt[order]
        cut = np.zeros(len(at), np.int64)
        cut[tied[1:]] = (g[1:] != g[:-1]) | (nxt[1:] != nxt[:-1])
        cut[1:] |= group[1:] != group[:-1]
        group = np.cumsum(cut)
    return at


def _compare(keys: np.ndarray, at: np.ndarray, wanted: np.ndarray, where: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """-1, 0 or 1 for suffixes ``at`` against the first ``n_words`` words of queries."""
    out = np.zeros(len(at), np.int8)
    live, step = np.arange(len(at)), 0
    while len(live):
        left = n_words[live] - step
        live = live[left > 0]
        left = left[left > 0]
        if not len(live):
            break
        cut = BITS * np.maximum(0, PACK - left)
        p, q = at[live] + step, where[live] + step
        a = np.where(p < len(keys), keys[np.minimum(p, len(keys) - 1)], 0) >> cut
        b = np.where(q < len(wanted), wanted[np.minimum(q, len(wanted) - 1)], 0) >> cut
        out[live] = np.sign(a - b)
        live, step = live[a == b], step + PACK
    return out


def bisect(keys: np.ndarray, sa: np.ndarray, wanted: np.ndarray, where: np.ndarray, n_words: np.ndarray, right: bool) -> np.ndarray:
    """For each query the first place in ``sa`` not before it (right: behind it)."""
    lo, hi = np.zeros(len(where), np.int64), np.full(len(where), len(sa), np.int64)
    while len(open_ := np.flatnonzero(lo < hi)):
        mid = (lo[open_] + hi[open_]) // 2
        c = _compare(keys, sa[mid], wanted, where[open_], n_words[open_])
        up = c < 0 if not right else c <= 0
        lo[open_[up]] = mid[up] + 1
        hi[open_[~up]] = mid[~up]
    return lo


def common_words(tokens: np.ndarray, at: np.ndarray, other: np.ndarray, where: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of suffix pairs, in words."""
    out = np.zeros(len(at), np.int64)
    live, k = np.arange(len(at)), 0
    while len(live) and k < most:
        p, q = at[live] + k, where[live] + k
        a = np.where(p < len(tokens), tokens[np.minimum(p, len(tokens) - 1)], 0)
        b = np.where(q < len(other), other[np.minimum(q, len(other) - 1)], 0)
        live = live[(a == b) & (a > 0)]
        out[live] += 1
        k += 1
    return out


def known_runs(known: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word, how many known words follow one another from it on, within its document."""
    n = len(known)
    stop = np.full(n + 1, n, np.int64)
    unknown = np.where(~known, np.arange(n), n)
    stop[:n] = np.minimum.accumulate(unknown[::-1])[::-1]
    doc_end = np.repeat(first[1:], np.diff(first))
    return np.where(known, np.minimum(stop[:n], doc_end) - np.arange(n), 0)


def match_shard(bench: Benchmark, texts: list[str | None], width: int) -> list[tuple[list[tuple[int, int]], list[str], tuple]]:
    """For each text: merged runs of hit words, items found, (words, item, word in the document, word in the item) of its longest match."""
    ids = [np.array([bench.vocabulary.get(w, 0) for w in words(t)], np.int64) for t in texts]
    first = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    run = known_runs(flat > 0, first)
    # a word of 0 behind each document keeps matches inside it
    shift = np.repeat(np.arange(len(ids)), np.diff(first))
    tokens = np.zeros(len(flat) + len(ids), np.int64)
    tokens[np.arange(len(flat)) + shift] = flat
    doc_first = first[:-1] + np.arange(len(ids))
    out = [([], [], (0, None, None, None)) for _ in texts]
    starts = np.flatnonzero(run >= bench.shortest)
    if not len(starts) or not len(bench.suffixes):
        return out
    starts = starts + shift[starts]
    sa = suffix_array(tokens, starts, bench.longest)
    keys, wanted = packed(tokens), packed(bench.tokens)

    q = bench.suffixes
    place = bisect(keys, sa, wanted, q, np.full(len(q), bench.longest), right=False)
    best: dict[int, tuple] = {}
    for near in (place - 1, place):
        ok = (near >= 0) & (near < len(sa))
        n = np.zeros(len(q), np.int64)
        n[ok] = common_words(tokens, sa[near[ok]], bench.tokens, q[ok], bench.longest)
        for k in np.flatnonzero(n >= bench.shortest):
            at = int(sa[near[k]])
            d = int(np.searchsorted(doc_first, at, "right")) - 1
            item = int(bench.item_at[q[k]])
            origin = int(np.searchsorted(bench.item_at, item))
            new = (int(n[k]), bench.items[item], at - int(doc_first[d]), int(q[k]) - origin)
            if new[0] > best.get(d, (0,))[0]:
                best[d] = new

    at = np.array([w[0] for w in bench.windows], np.int64)
    size = np.array([w[1] for w in bench.windows], np.int64)
    lo, hi = bisect(keys, sa, wanted, at, size, False), bisect(keys, sa, wanted, at, size, True)
    covered = np.zeros(len(tokens) + 1, np.int64)
    found: dict[int, set[str]] = {}
    for k in np.flatnonzero(hi > lo):
        where = sa[lo[k]:hi[k]]
        np.add.at(covered, where, 1)
        np.add.at(covered, where + size[k], -1)
        for d in np.unique(np.searchsorted(doc_first, where, "right") - 1).tolist():
            found.setdefault(d, set()).update(x for x in bench.windows[k][2] if x is not None)
    hit = np.cumsum(covered[:-1]) > 0
    for d, names in found.items():
        a = int(doc_first[d])
        h = np.concatenate([[False], hit[a:a + len(ids[d])], [False]])
        edge = np.flatnonzero(h[1:] != h[:-1])
        out[d] = (list(zip(edge[::2].tolist(), edge[1::2].tolist())), sorted(names), best.get(d, (0, None, None, None)))
    return out


RUNS = "array<struct<first:int,last:int>>"


def _pass(bench, width: int, shard_bytes: int, schema: pa.Schema):
    """One benchmark block over Arrow batches: adds its runs, items and longest match to those so far."""

    def search(batches):
        b = bench.value
        shortest = b.shortest

        def flagged(data, offsets):
            """Texts with a run of known words (by hash) as long as the shortest window; words of each text."""
            data = LOWER[data]
            s, e = word_runs(data, offsets, ALNUM)
            first = np.searchsorted(s, offsets)
            if not len(b.hashes):
                return np.zeros(len(offsets) - 1, bool), np.diff(first)
            h = word_hashes(data, s, e)
            at = np.searchsorted(b.hashes, h)
            known = b.hashes[np.minimum(at, len(b.hashes) - 1)] == h
            run = known_runs(known, first) >= shortest
            return np.add.reduceat(np.concatenate([run, [False]]).astype(np.int64), first[:-1]) * (np.diff(first) > 0) > 0, np.diff(first)

        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            n_words = np.zeros(batch.num_rows, np.int64)
            look = np.zeros(batch.num_rows, bool)
            for i, j in slices(offsets):
                look[i:j], n_words[i:j] = flagged(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            rows = np.flatnonzero(look)
            runs, items, longest = [c.to_pylist() for c in (batch.column("runs"), batch.column("items"), batch.column("longest"))]
            sizes = np.concatenate([[0], np.cumsum((offsets[1:] - offsets[:-1])[rows])])
            for i, j in slices(sizes, shard_bytes):
                texts = batch.column("text").take(pa.array(rows[i:j])).to_pylist()
                for r, (new, names, best) in zip(rows[i:j].tolist(), match_shard(b, texts, width)):
                    runs[r] = (runs[r] or []) + [{"first": x, "last": y} for x, y in new]
                    items[r] = (items[r] or []) + names
                    if best[0] > (longest[r]["words"] or 0):
                        longest[r] = dict(zip(("words", "item_id", "doc_word", "item_word"), best))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), batch.column("text"), pa.array(n_words), pa.array(runs, schema.field("runs").type), pa.array(items, schema.field("items").type), pa.array(longest, schema.field("longest").type)], schema=schema)

    return search


def benchmark_blocks(benchmark: DataFrame, block_bytes: int):
    """Lists of (item id, text), each of at most ``block_bytes`` of text (or one item)."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-2 * size // block_bytes))
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(F.col("text").isNotNull())
    for k in range(n):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()]


def row_key():
    """Equal for rows with equal id and text."""
    return row_hash("doc_id", "text")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated rows."""
    found = contamination(docs, benchmark, **options).where("contaminated").select("key").distinct()
    return docs.select(whole_rows(docs), row_key().alias("key")).join(found, "key", "left_anti").select("row.*")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13, one_in: int = 20,
                  shard_bytes: int = 4 << 20, block_bytes: int = 16 << 20) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): n_words, n_hit, items,
    items_sha256, contaminated, runs (hit words as half-open ranges), longest, key (row_key).

    A window is ``width`` consecutive words of an item, or all words of a shorter
    one.  Contaminated: some word is hit and the hit words times ``one_in``
    are at least all.  A null or empty text has no words and isn't contaminated; items with
    null text hold nothing; an item without item_id is searched like any other, but
    has no name in ``items``.  Rows that repeat give equal results.  Long texts are
    matched whole; of ``docs`` only doc_id and text are read.  An empty benchmark or document table gives no hits or no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    kinds = "doc_id long, key string, text string, n_words long, runs " + RUNS + ", items array<string>, longest struct<words:int,item_id:string,doc_word:int,item_word:int>"
    schema = spark.createDataFrame([], kinds).schema
    arrow = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("text", pa.string()), ("n_words", pa.int64()),
                       ("runs", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), ("items", pa.list_(pa.string())),
                       ("longest", pa.struct([("words", pa.int32()), ("item_id", pa.string()), ("doc_word", pa.int32()), ("item_word", pa.int32())]))])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text", F.lit(0).cast("long").alias("n_words"),
                       *(F.lit(None).cast(schema[c].dataType).alias(c) for c in ("runs", "items")),
                       F.struct(F.lit(0).alias("words"), F.lit(None).cast("string").alias("item_id"), F.lit(None).cast("int").alias("doc_word"), F.lit(None).cast("int").alias("item_word")).alias("longest"))
    for block in benchmark_blocks(benchmark, block_bytes):
        index = spark.sparkContext.broadcast(benchmark_index(block, width))
        rows = rows.mapInArrow(_pass(index, width, shard_bytes, arrow), schema)
    empty_runs = F.coalesce("runs", F.array().cast(RUNS))
    # runs of several blocks may overlap: count words behind the furthest end so far
    hit = F.aggregate(F.array_sort(empty_runs), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                      lambda acc, r: F.struct((acc["n"] + F.greatest(F.lit(0), r["last"] - F.greatest(r["first"], acc["end"]))).alias("n"), F.greatest(acc["end"], r["last"]).alias("end")),
                      lambda acc: acc["n"].cast("long"))
    names = F.array_sort(F.array_distinct(F.coalesce("items", F.array().cast("array<string>"))))
    out = rows.select("doc_id", "key", "n_words", hit.alias("n_hit"), names.alias("items"), empty_runs.alias("runs"), "longest")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      ((F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "items", "runs", "longest", "key")
