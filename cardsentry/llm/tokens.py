"""Token-id output: frequency-ranked ids in a byte-aligned variable-length code.

Every whole text is encoded with a public tokenizer and ends with ``end_id``.
A first pass encodes the texts, once, into a table of compressed ids and counts
the ids of the corpus; an id's code is its rank by falling count (ties by id), so
frequent ids take one byte.  A second pass sorts the documents' ids by range,
writes one file for each range and the files are read back and decoded to give
the result.

File format ``.tok`` (integers little-endian), blocks one after another::

    b"FRVB"  u32 n_docs  u64 n_ids  u64 n_data
    n_docs * i64   document ids          (0 where null)
    n_docs * u8    1 where the id is null
    n_docs * u32   ids of each document, the end id included
    ceil(n_ids / 4) control bytes: two bits for each code, its bytes less one,
                   the first code in the lowest bits; unused ones are 0
    n_data bytes:  the codes, 1 to 4 bytes each

``ranks.tok`` beside the files holds the ids in order of rank as u32.  Control
bytes are separate from the data, so a reader finds all lengths of a block with
one lookup in a table of 256 * 4 entries and all codes with four gathers.
"""
from __future__ import annotations

import functools
import itertools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import block_count, fresh_dir, prepare, slices, stored, utf8
from .files import open_fs, written

MAGIC = b"FRVB"
HEAD = struct.Struct("<4sIQQ")
#: Lengths of the four codes of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1
PIECE_CACHE = 600_000
BLOCK_IDS = 1 << 20
JOINED = 100
CALL_CHARS = 1 << 18
# White space other than space and newline, or a run of two: such a text isn't cut into pieces,
# nor one with an added token.
_ODD_SPACE = r"[\x00\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n][ \n]"


class Encoder:
    """Texts to ids.  The pre-tokenizer never joins across the end of a word, so
    a text is cut before each single space or newline and each different piece is
    encoded once by the library; texts with other white space or with an added token
    (which may take white space around it) go to it whole.
    The pieces kept are a cache: past ``PIECE_CACHE`` it starts anew."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = sorted(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values())
        self.added = re.compile("|".join(added)) if added else None
        self.whole = "|".join([_ODD_SPACE, *added])
        # byte-level vocabulary: one character for each byte of a token
        self.width = np.zeros(self.library.get_vocab_size() + 1, np.int64)
        for token, i in self.library.get_vocab().items():
            self.width[i] = len(token)
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)

    def _call(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and how many each has.  The library's results take many
        times the memory of the ids, so it gets about ``CALL_CHARS`` characters at a time."""
        at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        ids, n = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i, j in slices(at, CALL_CHARS):
            got = [x.ids for x in self.library.encode_batch_fast(texts[i:j], add_special_tokens=False)]
            n.append(np.fromiter(map(len, got), np.int64, len(got)))
            ids.append(np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(n[-1].sum())))
        return np.concatenate(ids), np.concatenate(n)

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_call`` for pieces that start with their only white space: the library
        gets ``JOINED`` of them as one text, and the tokens' byte lengths tell where
        each piece ends.  If a piece ends inside a token, they are encoded singly."""
        ids, _ = self._call(["".join(pieces[i:i + JOINED]) for i in range(0, len(pieces), JOINED)])
        at = np.concatenate([[0], np.cumsum(self.width[ids])])
        ends = np.cumsum(pc.binary_length(pa.array(pieces, pa.string())).to_numpy(), dtype=np.int64)
        cut = np.minimum(np.searchsorted(at, ends), len(at) - 1)
        if at[-1] != (ends[-1] if len(ends) else 0) or not np.array_equal(at[cut], ends):
            return self._call(pieces)
        return ids, np.diff(cut, prepend=0)

    def _learn(self, new: list[str]) -> None:
        follows = [p[:1] in " \n" and p[1:].split() == [p[1:]] and not (self.added and self.added.search(p)) for p in new]
        some, alone = list(itertools.compress(new, follows)), [p for p, f in zip(new, follows) if not f]
        new = some + alone
        (ids, n), (more, n_more) = self._joined(some), self._call(alone)
        ids, n = np.concatenate([ids, more]), np.concatenate([n, n_more])
        k = len(self.at)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while k + len(new) > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.size[k:k + len(new)] = n
        self.first[k:k + len(new)] = self.used + np.cumsum(n) - n
        self.used += len(ids)
        self.at.update(zip(new, range(k, k + len(new))))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: empty), each followed by ``end_id``; ids of each text."""
        if len(self.at) > PIECE_CACHE:
            self._clear()
        texts = pc.fill_null(texts, "")
        cut = pc.replace_substring(pc.replace_substring(texts, "\n", "\0\n"), " ", "\0 ")
        odd = pc.match_substring_regex(texts, self.whole)
        if pc.any(odd).as_py():
            whole = pa.array([""] * len(texts), texts.type)
            cut = pc.split_pattern(pc.if_else(odd, whole, cut), "\0")
            alone = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        else:
            cut, alone = pc.split_pattern(cut, "\0"), np.zeros(0, np.int64)
        counts = np.diff(cut.offsets.to_numpy())
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        which = coded.indices.to_numpy()
        if len(alone):  # the one empty piece of such a text stands for all of it
            which = which.copy()
            at = np.cumsum(counts) - counts
            which[at[alone]] = len(pieces) + np.arange(len(alone))
            pieces += texts.take(pa.array(alone)).to_pylist()
        where = np.fromiter(map(self.at.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(where < 0)
        if len(unknown):
            missing = [pieces[i] for i in unknown]
            self._learn(list(dict.fromkeys(missing)))
            where[unknown] = np.fromiter(map(self.at.__getitem__, missing), np.int64, len(missing))
        lens, first = self.size[where][which], self.first[where][which]
        ends = np.concatenate([[0], np.cumsum(lens)])
        ids = self.flat[np.repeat(first - ends[:-1], lens) + np.arange(ends[-1])]
        text_ends = ends[np.cumsum(counts)]
        return np.insert(ids, text_ends, end_id).astype(np.uint32), np.diff(text_ends, prepend=0) + 1


@functools.lru_cache(1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pack(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of codes below 2**32."""
    codes = codes.astype(np.uint32)
    extra = (codes > 0xFF).astype(np.uint8) + (codes > 0xFFFF) + (codes > 0xFFFFFF)
    four = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    four[:len(codes)] = extra
    control = (four.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    used = np.arange(4) <= extra[:, None]
    return control, codes.astype("<u4").view(np.uint8).reshape(-1, 4)[used]


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n codes of a block."""
    lens = LENGTHS[control].reshape(-1)[:n]
    ends = np.cumsum(lens)
    starts = ends - lens
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    out = padded[starts].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(lens > k)
        if len(more):
            out[more] |= padded[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_block(out, doc_ids: list[int | None], counts: np.ndarray, codes: np.ndarray) -> None:
    control, data = pack(codes)
    out.write(HEAD.pack(MAGIC, len(doc_ids), len(codes), len(data)))
    out.write(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    out.write(np.array([d is None for d in doc_ids], np.uint8).tobytes())
    out.write(np.asarray(counts, "<u4").tobytes())
    out.write(control.tobytes())
    out.write(data.tobytes())


def read_blocks(source) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, ids of each document, codes) of each block of a stream."""
    while head := source.read(HEAD.size):
        magic, n_docs, n, n_data = HEAD.unpack(head)
        if magic != MAGIC:
            raise ValueError("not a block of a token file")
        ids = np.frombuffer(source.read(8 * n_docs), "<i8")
        null = np.frombuffer(source.read(n_docs), np.uint8)
        counts = np.frombuffer(source.read(4 * n_docs), "<u4")
        control = np.frombuffer(source.read(-(-n // 4)), np.uint8)
        data = np.frombuffer(source.read(n_data), np.uint8)
        yield [None if z else int(d) for d, z in zip(ids, null)], counts, unpack(control, data, n)


def _parts(batches, size: int = 4 << 20):
    """Parts of Arrow batches with about ``size`` bytes of text."""
    for b in batches:
        for i, j in slices(utf8(b.column("text"))[1], size):
            yield b.slice(i, j - i)


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, tie, row, n, ids) of each row, written and read back: its number of
    ids and their unsigned little-endian integers, of 2 bytes where they fit, compressed.
    Rows with equal doc_id are told apart by ``tie``, a hash of the text, and ``row``."""

    def encode(batches):
        for part in _parts(batches):
            ids, n = _encoder(tokenizer).encode(part.column("text"), end_id)
            ids = ids.astype("<u2" if ids.max(initial=0) < 1 << 16 else "<u4")
            ends = np.cumsum(n)
            packed = [pa.compress(ids[i:j].tobytes(), "zstd", asbytes=True) for i, j in zip((ends - n).tolist(), ends.tolist())]
            width = pa.array(np.full(len(n), ids.itemsize, np.int32))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "tie", "row")), pa.array(n), width, pa.array(packed, pa.binary())],
                                             names=["doc_id", "tie", "row", "n", "width", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"), "text")
    return stored(rows.mapInArrow(encode, "doc_id long, tie long, row long, n long, width int, ids binary"), "encoded")


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    """Row ranges of a batch of ``encoded`` with their ids, about ``BLOCK_IDS`` each or one document."""
    n = batch.column("n").to_numpy()
    for i, j in slices(np.concatenate([[0], np.cumsum(n)]), BLOCK_IDS):
        part = batch.slice(i, j - i)
        rows = zip(part.column("n").to_pylist(), part.column("width").to_pylist(), part.column("ids"))
        yield i, j, np.concatenate([np.frombuffer(pa.decompress(x.as_buffer(), k * w, "zstd"), f"<u{w}") for k, w, x in rows])


def id_counts(rows: DataFrame) -> DataFrame:
    """(token_id, n) over all rows of ``encoded``; one row for each id that occurs."""

    def count(batches):
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            for _, _, ids in _unpacked(b):
                got = np.bincount(ids)
                if len(got) > len(total):
                    total = np.concatenate([total, np.zeros(len(got) - len(total), np.int64)])
                total[:len(got)] += got
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["token_id", "n"])

    return rows.select("n", "width", "ids").mapInArrow(count, "token_id long, n long").groupBy("token_id").agg(F.sum("n").alias("n"))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, file_bytes: int = 16 << 20) -> DataFrame:
    """Writes the files below ``path``; returns (part, first_doc, n_docs, n_ids) of each."""
    spark = docs.sparkSession
    rows = encoded(docs, tokenizer, end_id)
    # The ranking has one entry for each id of the vocabulary that occurs: its size is the tokenizer's, not the corpus's.
    ranked = [r[0] for r in id_counts(rows).orderBy(F.desc("n"), "token_id").select("token_id").collect()]
    rank = np.zeros(max(ranked, default=0) + 1, np.uint32)
    rank[ranked] = np.arange(len(ranked))
    with written(f"{path}/ranks.tok") as out:
        out.write(np.array(ranked, "<u4").tobytes())
    shared = spark.sparkContext.broadcast(rank)

    def write(batches):
        part, n_docs, n_ids = TaskContext.get().partitionId(), 0, 0
        with written(f"{path}/part-{part:06d}.tok") as out:
            ids: list[int | None] = []
            counts: list[np.ndarray] = []
            codes: list[np.ndarray] = []

            def flush():
                if ids:
                    write_block(out, ids, np.concatenate(counts), np.concatenate(codes))
                    ids.clear(), counts.clear(), codes.clear()

            for b in batches:
                for i, j, got in _unpacked(b):
                    ids += b.column("doc_id").slice(i, j - i).to_pylist()
                    counts.append(b.column("n").slice(i, j - i).to_numpy())
                    codes.append(shared.value[got])
                    n_docs, n_ids = n_docs + j - i, n_ids + len(got)
                    if sum(map(len, codes)) >= BLOCK_IDS:
                        flush()
            flush()
        yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [n_docs], "n_ids": [n_ids]})

    n = block_count(docs, block_bytes=file_bytes)
    # Equal ids are spread by the text, then by where the row was read.
    return (rows.repartitionByRange(n, "doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row")
            .select("doc_id", "n", "width", "ids").mapInArrow(write, "part long, n_docs long, n_ids long"))


def read_tokens(spark: SparkSession, path: str, files: DataFrame, lists: bool = False) -> DataFrame:
    """Documents of the files that ``files`` (part, n_ids) names: doc_id, start,
    n_tokens, ids_crc32, first_id, and with ``lists`` also the ids."""
    # One row for each file: a bounded list, by which each file gets its start.
    listing = sorted((r["part"], r["n_ids"]) for r in files.select("part", "n_ids").collect())
    rows, start = [], 0
    for part, n_ids in listing:
        rows.append((part, start))
        start += n_ids
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64(), "part": pa.int64()} | ({"ids": pa.list_(pa.int32())} if lists else {})

    def read(batches):
        store, folder = open_fs(path)
        with store.open_input_stream(f"{folder}/ranks.tok", compression=None) as f:
            back = np.frombuffer(f.read(), "<u4")
        for b in batches:
            for part, at in zip(b.column("part").to_pylist(), b.column("start").to_pylist()):
                with store.open_input_stream(f"{folder}/part-{part:06d}.tok", compression=None, buffer_size=1 << 20) as f:
                    for doc_ids, counts, codes in read_blocks(f):
                        ids = back[codes]
                        ends = np.cumsum(counts, dtype=np.int64)
                        raw = ids.astype("<u4").tobytes()
                        crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), counts.tolist())]
                        cols = {"doc_id": doc_ids, "start": at + ends - counts, "n_tokens": counts.astype(np.int64), "ids_crc32": crc, "part": [part] * len(crc)}
                        if lists:
                            cols["ids"] = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids.astype(np.int32))
                        at += int(ends[-1]) if len(ends) else 0
                        yield pa.RecordBatch.from_pydict(cols, schema=pa.schema(kinds))

    n = max(1, len(rows))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, part long" + (", ids array<int>" if lists else "")
    return (spark.createDataFrame(rows, "part long, start long").repartitionByRange(n, "part").mapInArrow(read, schema))


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None, lists: bool = False) -> DataFrame:
    """Encodes ``docs`` (doc_id, text; other columns are not read), writes the
    files and returns what reading them back gives.

    A null text is an empty one: its only id is the end id.  Rows with equal
    doc_id stay apart, in order of their texts' hashes; null ids come first.
    An empty table gives files without blocks and no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    path = path or fresh_dir(spark, "tokens")
    files = [tuple(r) for r in write_tokens(docs, path, tokenizer, end_id).collect()]  # one row for each file
    return read_tokens(spark, path, spark.createDataFrame(files, "part long, n_docs long, n_ids long"), lists)
