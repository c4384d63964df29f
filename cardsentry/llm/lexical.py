"""Ranked lexical search: all documents against each item of a stated query set.

Terms are runs of digits, letters and non-ASCII characters, ASCII letters lower-cased.
The score of a document is a sum over the item's terms of an integer term weight
times an integer impact, so scores are exact and ties are real ties.

1. A first pass counts, for the terms of the items only, the documents that hold
   each, and over all documents the number with a term and all their terms.
2. Items are cut into tiles, each with the compact vocabulary of its own terms, and
   that vocabulary into tiles whose products can't leave the integers of a double:
   an impact is below ``MOST_IMPACT``, so a tile ends before an item's weights in it
   reach ``2**53 / MOST_IMPACT``; a heavier weight is spread over several tiles.
3. A second pass turns each block of documents into dense impact tiles and multiplies
   them with the items' weight tiles (BLAS, float64).  Every partial sum is an integer
   below 2**53, hence exact in any order of additions; tiles are added as int64.
4. Each task keeps an item's ``k`` best (score, id).  A block's candidates are all
   scores that reach the block's k-th and the task's k-th, ties included, and only
   then cut by id.  The tasks' lists meet in two steps, so no task reads them all.

Items are met in rounds of ``round_bytes`` of text, each one pass over the
documents; what goes to the workers in a round is bounded by that.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import prepare

TERM, BREAK = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")
SCAN_BYTES = 1 << 20
#: Impacts are below it: tf * 10**9 div (1000 * tf + 12 * m) with m of at least 75.
MOST_IMPACT = 1_000_000
MOST_WEIGHT = ((1 << 53) - 1) // MOST_IMPACT
TILE_ITEMS, TILE_TERMS, TILE_DOCS = 256, 4096, 512
SALTS = 64


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in order, a stretch of about ``SCAN_BYTES`` at a time."""
    text = text.lower()  # of bytes: A-Z only
    at = 0
    while at < len(text):
        cut = BREAK.search(text, at + SCAN_BYTES)
        end = cut.start() if cut else len(text)
        yield TERM.findall(text, at, end)
        at = end


def as_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


@dataclass
class Tile:
    """Some items with the part of their weights that one product takes: weight
    ``value[k]`` of item ``row[k]`` for the term in column ``column[k]``."""

    first: int
    rows: int
    terms: np.ndarray
    row: np.ndarray
    column: np.ndarray
    value: np.ndarray


def weight_tiles(items: list[Counter], weight: dict[int, int], most: int = MOST_WEIGHT, n_items: int = TILE_ITEMS, n_terms: int = TILE_TERMS) -> list[Tile]:
    """Tiles over items given as counts of their term numbers; ``weight``: by term number."""
    tiles: list[Tile] = []
    at = 0
    while at < len(items):
        seen: set[int] = set()
        end = at
        while end < len(items) and end - at < n_items and (end == at or len(seen | items[end].keys()) <= n_terms):
            seen |= items[end].keys()
            end += 1
        columns: dict[int, list[tuple[int, int]]] = {t: [] for t in sorted(seen)}
        for r in range(at, end):
            for t, n in items[r].items():
                if n * weight[t]:
                    columns[t].append((r - at, n * weight[t]))
        room = np.full(end - at, most)
        taken: list[int] = []
        entries: list[tuple[int, int, int]] = []

        def close() -> None:
            if entries:
                row, column, value = np.array(entries, np.int64).T
                tiles.append(Tile(at, end - at, np.array(taken, np.int64), row, column, value.astype(np.float64)))  # noqa: B023
            room[:] = most  # noqa: B023
            taken.clear(), entries.clear()  # noqa: B023

        for t, left in columns.items():
            while left:
                part = [(r, min(w, most)) for r, w in left]
                if len(taken) == n_terms or any(room[r] < w for r, w in part):
                    close()
                for r, w in part:
                    room[r] -= w
                    entries.append((r, len(taken), w))
                taken.append(t)
                left = [(r, w - most) for r, w in left if w > most]
        close()
        at = end
    return tiles


class Best:
    """The k best (score, document) of each item so far; equal scores by id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, np.int64)
        self.kept: dict[int, tuple[np.ndarray, ...]] = {}

    def offer(self, first: int, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """``scores``: items from ``first`` on by documents."""
        k, (rows, docs) = self.k, scores.shape
        least = self.least[first:first + rows]
        if docs > k:
            least = np.maximum(least, np.partition(scores, docs - k, 1)[:, docs - k])
        row, col = np.nonzero(scores >= least[:, None])
        if not len(row):
            return
        score, doc, nameless = scores[row, col], ids[col], no_id[col]
        if old := self.kept.get(first):
            row, score, doc, nameless = (np.concatenate(x) for x in zip(old, (row, score, doc, nameless)))
        order = np.lexsort((doc, nameless, -score, row))
        row = row[order]
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        rank = np.arange(len(row)) - np.repeat(starts, np.diff(starts, append=len(row)))
        stay = order[rank < k]
        row, rank = row[rank < k], rank[rank < k]
        self.kept[first] = (row, score[stay], doc[stay], nameless[stay])
        self.least[first + row[rank == k - 1]] = score[stay][rank == k - 1]

    def rows(self) -> Iterator[tuple[np.ndarray, ...]]:
        for first, (row, *rest) in self.kept.items():
            yield first + row, *rest


def score_block(tiles: list[Tile], counts: list[tuple[list[int], list[int]]], lengths: np.ndarray, n_terms: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first item, scores) of each run of tiles over the same items, for a block of
    documents given by (term numbers, occurrences) and their m."""
    sizes = np.fromiter((len(t) for t, _ in counts), np.int64, len(counts))
    term = np.fromiter((t for ts, _ in counts for t in ts), np.int64, int(sizes.sum()))
    tf = np.fromiter((f for _, fs in counts for f in fs), np.int64, len(term))
    doc = np.repeat(np.arange(len(counts)), sizes)
    impact = ((1_000_000_000 * tf) // (1000 * tf + 12 * lengths[doc])).astype(np.float64)
    local = np.full(n_terms, -1)
    done, total = None, None
    for tile in tiles:
        if done != tile.first:
            if total is not None:
                yield done, total
            done, total = tile.first, np.zeros((tile.rows, len(counts)), np.int64)
        local[tile.terms] = np.arange(len(tile.terms))
        column = local[term]
        local[tile.terms] = -1
        here = column >= 0
        impacts = np.zeros((len(tile.terms), len(counts)))
        impacts[column[here], doc[here]] = impact[here]
        weights = np.zeros((tile.rows, len(tile.terms)))
        weights[tile.row, tile.column] = tile.value
        total += (weights @ impacts).astype(np.int64)
    if total is not None:
        yield done, total


def item_rounds(items: DataFrame, round_bytes: int) -> Iterator[list[tuple]]:
    """Lists of (item_id, text bytes), of about ``round_bytes`` of text (or one item)."""
    size, n = items.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    rounds = max(1, -(-2 * (size or 0) // round_bytes), -(-2 * n * 64 // round_bytes))
    rows = items.select("item_id", F.col("text").cast("binary").alias("text")).where("text is not null")
    for r in range(rounds):
        yield [tuple(x) for x in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == r).collect()]


def search(docs: DataFrame, items: DataFrame, k: int = 20, round_bytes: int = 16 << 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each row of ``items``
    (item_id, text) among all rows of ``docs`` (doc_id, text), with scores above 0.

    Equal scores rank by ascending doc_id, null ids last; rows with equal id and
    score hold places of their own, in any order, as each row is a document.  Each
    row of ``items`` is an item: a repeated one is answered again, a null item_id is
    returned as null.  Null and empty texts have no terms: such a document is not
    counted and never found, such an item has no rows.  An empty table gives no
    rows.  Texts are read whole, a stretch at a time; other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = items.schema["item_id"].dataType
    fields = StructType([StructField("round", IntegerType()), StructField("part", IntegerType()), StructField("item", IntegerType()), StructField("item_id", kind), StructField("doc_id", LongType()), StructField("score", LongType())])
    found = spark.createDataFrame([], fields)
    for number, block in enumerate(item_rounds(items, round_bytes)):
        part = _round(narrow, number, block, fields, k)
        found = part if number == 0 and part is not None else found if part is None else found.union(part)
    ahead = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["round", "item", F.pmod("part", F.lit(SALTS))], ["round", "item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*ahead))).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")


def _round(narrow: DataFrame, number: int, block: list[tuple], fields: StructType, k: int) -> DataFrame | None:
    """The best documents of some items in each task; None if no item has a term."""
    spark = narrow.sparkSession
    vocabulary: dict[bytes, int] = {}
    counted = []
    for _, text in block:
        c: Counter = Counter()
        for found in terms(bytes(text)):
            c.update(vocabulary.setdefault(t, len(vocabulary)) for t in found)
        counted.append(c)
    if not vocabulary:
        return None
    words = spark.sparkContext.broadcast(vocabulary)

    def document_counts(batches):
        """Term -1: documents with a term; -2: all terms; others: documents that hold them."""
        get, held, all_terms, with_terms = words.value.get, np.zeros(len(words.value), np.int64), 0, 0
        for b in batches:
            for text in as_bytes(b.column("text")):
                mine, n = set(), 0
                for found in terms(text):
                    n += len(found)
                    mine.update(map(get, found))
                mine.discard(None)
                held[list(mine)] += 1
                all_terms, with_terms = all_terms + n, with_terms + (n > 0)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], some]), pa.int64()), pa.array(np.concatenate([[with_terms, all_terms], held[some]]), pa.int64())], names=["term", "n"])

    sums = dict(narrow.select("text").mapInArrow(document_counts, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    n_docs, n_all = sums.pop(-1, 0), sums.pop(-2, 0)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sums.get(t, 0) + 1))) for t in range(len(vocabulary))}
    plan = spark.sparkContext.broadcast(weight_tiles(counted, weight))
    ids, item_type = [x[0] for x in block], to_arrow_type(fields["item_id"].dataType)

    def best(batches):
        get, tiles, top = words.value.get, plan.value, Best(len(ids), k)
        for b in batches:
            texts, names = as_bytes(b.column("text")), b.column("doc_id")
            no_id = names.is_null().to_numpy(zero_copy_only=False)
            doc_ids = names.fill_null(0).to_numpy()
            for at in range(0, len(texts), TILE_DOCS):
                counts, lengths = [], []
                for text in texts[at:at + TILE_DOCS]:
                    c, n = Counter(), 0
                    for found in terms(text):
                        n += len(found)
                        c.update(map(get, found))
                    c.pop(None, None)
                    counts.append((list(c), list(c.values())))
                    lengths.append(100 - 25 + 25 * n * n_docs // max(n_all, 1))
                for first, scores in score_block(tiles, counts, np.array(lengths, np.int64), len(words.value)):
                    top.offer(first, scores, doc_ids[at:at + TILE_DOCS], no_id[at:at + TILE_DOCS])
        part = TaskContext.get().partitionId()
        for item, score, doc, nameless in top.rows():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(item), number), pa.int32()), pa.array(np.full(len(item), part), pa.int32()), pa.array(item, pa.int32()),
                                              pa.array([ids[i] for i in item.tolist()], item_type), pa.array(doc, pa.int64(), mask=nameless), pa.array(score, pa.int64())],
                                             names=["round", "part", "item", "item_id", "doc_id", "score"])

    return narrow.mapInArrow(best, fields)
