"""Token counts from pre-tokens: no ids of a text are ever made.

A byte-level tokenizer never joins across the pre-tokens that its pattern cuts, so
a text's count is the sum of its pre-tokens' counts.

1. A first pass cuts all texts and gives each task's different pre-tokens with their
   number; Spark adds them up to one row for each pre-token of the corpus.
2. The tokenizer's model counts the pieces of each of these rows, once.
3. A second pass cuts the texts again, into each document's pre-token frequencies,
   and joins them with the counts.  Pre-tokens used often enough to fit ``HEAD_BYTES``
   meet the documents through a broadcast; the others (most words, few uses) leave
   the task as (document, pre-token, frequency) and are joined by a shuffle, on a
   key that is never hot, as hot ones are in the broadcast part.
4. Both parts are summed for each document.

Texts are cut with the tokenizer's own pattern by ``regex``, after each of their
characters has been found to be of the same class (letter, number, space, other) in
the tokenizer; a text with a character that is not goes to the tokenizer's
pre-tokenizer whole.
"""
from __future__ import annotations

import functools
import itertools
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import prepare, stored

#: The byte-level pre-tokenizer's pattern (fixed value).
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
HEAD_BYTES = 32 << 20
#: What a broadcast pre-token takes besides its own bytes.
ENTRY_BYTES = 80
PART_BYTES = 64 << 20
SCAN_CHARS = 1 << 18
OUT_ROWS = 1 << 16


class Cutter:
    """Pre-tokens and their token counts as the tokenizer file has them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") or model.get("dropout"):
            raise ValueError(f"{path}: a byte-level tokenizer without normalizer and prefix space is expected")
        added = self.library.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError(f"{path}: added tokens are expected to match as they are")
        # the longest of those that start at a place
        names = sorted((t.content for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, names))) if names else None
        self.same: set[str] = set()
        self.other: set[str] = set()
        for c in map(chr, range(128)):
            self._probe(c)

    def _probe(self, c: str) -> None:
        """Whether the tokenizer cuts around a character where ``PATTERN`` does."""
        s = f"a{c}1{c}!{c}{c} {c}x"
        cuts = [a for _, (a, _) in self.library.pre_tokenizer.pre_tokenize_str(s)]
        (self.same if cuts == [m.start() for m in PATTERN.finditer(s)] else self.other).add(c)

    def stretches(self, text: str) -> Iterator[tuple[str, bool]]:
        """Stretches that pre-tokens don't cross, of about ``SCAN_CHARS``, and whether each is an added token."""
        at = 0
        for m in itertools.chain(self.added.finditer(text) if self.added else (), [None]):
            end = m.start() if m else len(text)
            while at < end:
                cut = end
                if end - at > SCAN_CHARS:
                    # a letter or digit before a single space or newline always ends a pre-token
                    close = _CLOSE.search(text, at + SCAN_CHARS, end)
                    cut = close.start() + 1 if close else end
                yield text[at:cut], False
                at = cut
            if m:
                yield m[0], True
                at = m.end()

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a stretch that is no added token."""
        if not text.isascii():
            for c in set(text) - self.same - self.other:
                self._probe(c)
        if self.other and not self.other.isdisjoint(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return PATTERN.findall(text)

    def frequencies(self, text: str) -> tuple[Counter, int]:
        """How often each pre-token occurs, and the added tokens."""
        found: Counter = Counter()
        added = 0
        for part, special in self.stretches(text):
            if special:
                added += 1
            else:
                found.update(self.pieces(part))
        return found, added

    def count(self, piece: str) -> int:
        """The tokens of one pre-token, from the tokenizer's model."""
        return len(self.library.model.tokenize("".join(mapped for mapped, _ in self.library.pre_tokenizer.pre_tokenize_str(piece))))


_CLOSE = re.compile(r"[^\W_](?=[ \n][^\W_])")


@functools.lru_cache(1)
def _cutter(path: str) -> Cutter:
    return Cutter(path)


def _pieces_of_tasks(path: str):
    def scan(batches):
        cutter, seen, held = _cutter(path), Counter(), 0
        for b in batches:
            for text in b.column("text").to_pylist():
                before = len(seen)
                for part, special in cutter.stretches(text or ""):
                    if not special:
                        seen.update(cutter.pieces(part))
                        held += len(part) // 8
                if len(seen) > before:
                    held += (len(seen) - before) * ENTRY_BYTES
                if held > PART_BYTES:
                    yield from _batches(seen)
                    seen, held = Counter(), 0
        yield from _batches(seen)
    return scan


def _batches(seen: Counter) -> Iterator[pa.RecordBatch]:
    items = iter(seen.items())
    while some := list(itertools.islice(items, OUT_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], names=["piece", "uses"])


def piece_counts(docs: DataFrame, path: str) -> DataFrame:
    """(piece, uses, n): every pre-token of the texts, how often it occurs and its number of tokens."""

    def measure(batches):
        cutter = _cutter(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("piece"), b.column("uses"), pa.array(list(map(cutter.count, b.column("piece").to_pylist())), pa.int32())], names=["piece", "uses", "n"])

    used = docs.select("text").mapInArrow(_pieces_of_tasks(path), "piece string, uses long").groupBy("piece").agg(F.sum("uses").alias("uses"))
    return stored(used.mapInArrow(measure, "piece string, uses long, n int"), "pieces")


def head_uses(pieces: DataFrame, head_bytes: int) -> int:
    """The least power of two of uses from which on all pieces fit ``head_bytes``."""
    by = pieces.groupBy(F.floor(F.log2("uses")).cast("int").alias("power")).agg(F.sum(F.octet_length("piece") + ENTRY_BYTES).alias("bytes"))
    left, least = head_bytes, 62
    for power, size in sorted(map(tuple, by.collect()), reverse=True):
        left -= size
        if left < 0:
            break
        least = power
    return 1 << least


def token_counts(docs: DataFrame, path: str, limit: int = 512, head_bytes: int = HEAD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs`` (doc_id, text).

    The counts are those of the tokenizer file's library for the whole text without
    begin, end or other added special tokens; special strings inside a text count as
    it loads them.  Null and empty texts have 0 bytes and tokens.  Each row has an
    answer, repeated rows and null ids too.  Long texts are cut a stretch at a time;
    other columns are not read.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    pieces = piece_counts(narrow, path)
    least = head_uses(pieces, head_bytes)
    often = pieces.where(F.col("uses") >= least).select("piece", "n").toArrow()
    head = spark.sparkContext.broadcast(dict(zip(often["piece"].to_pylist(), often["n"].to_pylist())))

    def frequencies(batches):
        cutter, known, task, at = _cutter(path), head.value, TaskContext.get().partitionId(), 0
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            rows, sums, firsts, names, uses = [], [], [0], [], []
            for text in texts:
                found, n = cutter.frequencies(text)
                for piece, f in found.items():
                    if (count := known.get(piece)) is None:
                        names.append(piece)
                        uses.append(f)
                    else:
                        n += f * count
                rows.append(task << 40 | at)
                at += 1
                sums.append(n)
                firsts.append(len(names))
            rare = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(uses, pa.int64())], ["piece", "f"]))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), b.column("doc_id"), b.column("n_bytes"), pa.array(sums, pa.int64()), rare], names=["row", "doc_id", "n_bytes", "n_head", "rare"])

    # written once: the rows' numbers hold for both uses
    counted = stored(narrow.mapInArrow(frequencies, "row long, doc_id long, n_bytes long, n_head long, rare array<struct<piece:string,f:long>>"), "counted")
    rare = counted.select("row", F.explode("rare").alias("r")).select("row", "r.piece", "r.f")
    sums = rare.join(pieces.where(F.col("uses") < least).select("piece", "n"), "piece").groupBy("row").agg(F.sum(F.col("f") * F.col("n")).alias("n_rare"))
    n_tokens = F.col("n_head") + F.coalesce("n_rare", F.lit(0))
    return counted.drop("rare").join(sums, "row", "left").select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))
