"""Removal of byte strings that a document with a smaller id also holds.

The corpus is cut into blocks of documents and into buckets of content, and
messages go between them; both are bounded, so no task and no driver holds more.

1. blocks -> buckets.  Each window of ``length`` bytes has an anchor, the smallest
   hash of the ``gram``-byte strings in it (the leftmost of equal ones): equal
   windows have equal anchors at equal places.  A block sends each anchor hash
   once, marked if two of its documents hold it.
2. buckets -> blocks.  A hash from two blocks, or marked, is shared.
3. blocks -> buckets.  For shared anchors the block sends the piece of text that
   the anchor's windows cover, each different piece once with its smallest id.
   So a passage or group of copies, however frequent, is one piece from a block.
4. buckets -> blocks.  The bucket joins its pieces to one byte string, builds its
   suffix array by two-stage sorting and the adjacent common prefixes.  A run of
   prefixes of ``length`` bytes or more is one window content; its smallest id goes
   back to each block for the windows where it is smaller than the block's own.
5. Blocks mark the windows whose content has a smaller id and cut their bytes.

Documents equal to one with a smaller id are found by their hash first; they take
no part in 1 to 4, because the first of them does.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from .common import block_count, mix, powers, prepare, slices, utf8

GRAM = 18
PIECE = 1 << 22
SORT_BYTES = 1 << 21
SEPARATOR = 0xFF  # no UTF-8 text holds this byte
MESSAGE = "target long, origin long, kind int, a binary, b binary, c binary, d binary, e binary"
_FIELDS = pa.schema([("target", pa.int64()), ("origin", pa.int64()), ("kind", pa.int32())] + [(x, pa.binary()) for x in "abcde"])


# ---- two-stage suffix sorting -------------------------------------------------

def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one big-endian number; zeros behind the end."""
    t = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | t[k:k + len(text)]
    return out


def _word_at(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.where(at < len(words), words[np.minimum(at, len(words) - 1)], np.uint64(0))


def ascending(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one behind it (the last one isn't)."""
    n = len(text)
    differs = np.ones(n, bool)
    differs[:-1] = text[:-1] != text[1:]
    less = np.zeros(n, bool)
    less[:-1] = text[:-1] < text[1:]
    # in a run of equal bytes all are as its last one
    decided = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]
    return less[decided]


def sorted_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the first ``depth`` bytes from them on (eights of
    bytes: only places that still tie are compared on the next eight)."""
    key = words[at]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    group = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))
    for step in range(8, depth, 8):
        same = np.concatenate([[False], group[1:] == group[:-1], [False]])
        tied = np.flatnonzero(same[:-1] | same[1:])
        if not len(tied):
            break
        nxt = _word_at(words, at[tied] + step)
        order = np.lexsort((nxt, group[tied]))
        at[tied] = at[tied][order]
        g, nxt = group[tied][order], nxt[order]
        cut = np.concatenate([[False], group[1:] != group[:-1]])
        cut[tied[1:]] |= (g[1:] == g[:-1]) & (nxt[1:] != nxt[:-1])
        group = np.cumsum(cut)
    return at


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in order of their first ``depth`` bytes at least.

    Only suffixes smaller than their successors are sorted.  Every other suffix
    starts with a byte not smaller than the next one, so a scan over the sorted
    suffixes, bucket by bucket of the first byte, finds it behind the suffix that
    follows it in the text; each bucket is scanned as a whole array.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    up = ascending(text)
    direct = sorted_directly(np.flatnonzero(up), _words(text), depth)
    edges = np.searchsorted(text[direct], np.arange(257)) if len(direct) else np.zeros(257, np.int64)
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[n - 1]].append(np.array([n - 1]))  # the empty suffix comes first of all
    out = []
    for c in range(256):
        # suffixes of this bucket that are found from it: one more equal byte in front each time
        for part in induced[c]:
            front = part[part > 0] - 1
            front = front[text[front] == c]
            if len(front):
                induced[c].append(front)
        whole = np.concatenate([*induced[c], direct[edges[c]:edges[c + 1]]])
        induced[c] = []
        out.append(whole)
        front = whole[whole > 0] - 1
        letters = text[front]
        front, letters = front[letters > c], letters[letters > c]
        if len(front):
            order = np.argsort(letters, kind="stable")
            front, letters = front[order], letters[order]
            cuts = np.flatnonzero(letters[1:] != letters[:-1]) + 1
            for part, letter in zip(np.split(front, cuts), letters[np.concatenate([[0], cuts])].tolist()):
                induced[letter].append(part)
    return np.concatenate(out)


def common_prefixes(at: np.ndarray, words: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix of an ordered list has in common with the one before it, up to ``most``."""
    out = np.zeros(len(at), np.int64)
    live = np.arange(1, len(at))
    for step in range(0, most, 8):
        if not len(live):
            break
        x = _word_at(words, at[live] + step) ^ _word_at(words, at[live - 1] + step)
        equal = x == 0
        part = live[~equal]
        if len(part):
            # bytes of the number from its highest: the first that isn't zero differs
            out[part] = step + (x[~equal].astype(">u8").view(np.uint8).reshape(-1, 8) != 0).argmax(1)
        live = live[equal]
        out[live] = step + 8
    return np.minimum(out, most)


def least_ids(pieces: list[bytes], ids: np.ndarray, length: int) -> list[np.ndarray]:
    """For each piece the smallest id of all windows with the content of each of its windows."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    text = np.frombuffer(b"".join(x for p in pieces for x in (p, bytes([SEPARATOR]))), np.uint8)
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)
    left = first[owner] + sizes[owner] - np.arange(len(text))
    sa = suffix_array(text, length)
    sa = sa[left[sa] >= length]  # places where a window starts
    group = np.flatnonzero(common_prefixes(sa, _words(text), length) < length)
    least = np.zeros(len(text), np.int64)
    if len(sa):
        smallest = np.minimum.reduceat(ids[owner[sa]], group)
        least[sa] = np.repeat(smallest, np.diff(np.append(group, len(sa))))
    return [least[a:a + n - length + 1] for a, n in zip(first.tolist(), sizes.tolist())]


# ---- anchors ------------------------------------------------------------------

def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """For each run of windows with one anchor: document, first and last window
    start in the document, the anchor's place after the first start, and its hash."""
    wide = length - gram + 1
    parts = []
    for i, j in slices(offsets):
        pieces = [(i, j, int(offsets[i]), int(offsets[j]))]
        if offsets[j] - offsets[i] > PIECE:  # one long document, in overlapping pieces
            pieces = [(i, j, a, min(int(offsets[j]), a + PIECE + length - 1)) for a in range(int(offsets[i]), int(offsets[j]), PIECE)]
        for i, j, lo, hi in pieces:
            n = hi - lo
            if n < length:
                continue
            part = data[lo:hi]
            pw = powers(n + 1)
            total = np.zeros(n + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * pw[:n], out=total[1:])
            m = n - gram + 1
            h = total[gram:] - total[:m]
            h *= pw[n - np.arange(m)]
            h *= np.uint64(pow(int(pw[1]) if n else 1, -n, 1 << 64))
            h = mix(h)
            low = (h & ~np.uint64(0xFFFFFF)) | np.arange(m, dtype=np.uint64)  # leftmost of equal hashes
            best, span = low, 1
            while span * 2 <= wide:
                best = np.minimum(best[:len(best) - span], best[span:])
                span *= 2
            if span < wide:
                best = np.minimum(best[:n - length + 1], best[wide - span:wide - span + n - length + 1])
            at = np.maximum(offsets[i:j], lo) - lo
            end = np.minimum(offsets[i + 1:j + 1], hi) - lo
            ok = np.zeros(n + 1, np.int64)
            some = end - at >= length
            np.add.at(ok, at[some], 1)
            np.add.at(ok, end[some] - length + 1, -1)
            starts = np.flatnonzero(np.cumsum(ok[:n - length + 1]) > 0)
            if not len(starts):
                continue
            anchor = (best[starts] & np.uint64(0xFFFFFF)).astype(np.int64)
            new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1])]))
            first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1]
            doc = np.searchsorted(offsets, first + lo, "right") - 1
            parts.append((doc, first + lo - offsets[doc], last + lo - offsets[doc], anchor[new] - first, h[anchor[new]]))
    if not parts:
        return [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64)]
    return [np.concatenate(x) for x in zip(*parts)]


class Block:
    """The documents of a block in a fixed order, without copies of smaller ids."""

    def __init__(self, table: pa.Table, copies: set[tuple[int, bytes]], length: int, gram: int):
        rows = sorted(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        self.rows = rows
        some = {d for d, _ in copies}
        self.copied = [d in some and (d, text_key(t)) in copies for d, t in rows]
        taking = [k for k, (d, _) in enumerate(rows) if d is not None and not self.copied[k]]
        self.place = np.array(taking, np.int64)
        self.ids = np.array([rows[k][0] for k in taking], np.int64)
        self.data, self.offsets = utf8(pa.array([rows[k][1] for k in taking], pa.large_string()))
        self.length, self.gram = length, gram

    def runs(self):
        return anchor_runs(self.data, self.offsets, self.length, self.gram)

    def pieces(self, shared: np.ndarray):
        """Runs with a shared anchor: document, first start, last start, and the
        number of their piece; of each piece: hash, place of the anchor, smallest id, bytes."""
        doc, first, last, at, h = self.runs()
        here = np.searchsorted(shared, h)
        keep = np.flatnonzero(shared[np.minimum(here, len(shared) - 1)] == h) if len(shared) else np.zeros(0, np.int64)
        doc, first, last, at, h = (x[keep] for x in (doc, first, last, at, h))
        raw = self.data.tobytes()
        a = (self.offsets[doc] + first).tolist()
        b = (self.offsets[doc] + last + self.length).tolist()
        number: dict[tuple[int, bytes], int] = {}
        which = np.fromiter((number.setdefault((p, raw[x:y]), len(number)) for p, x, y in zip(at.tolist(), a, b)), np.int64, len(a))
        least = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(least, which, self.ids[doc])
        hashes = np.zeros(len(number), np.uint64)
        hashes[which] = h
        return doc, first, last, which, hashes, [p for p, _ in number], least, [t for _, t in number]


def _message(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in _FIELDS]
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, _FIELDS)], schema=_FIELDS)


COPY, SHARED, LEAST = 0, 1, 2


def _read(messages: pa.Table, kind: int):
    rows = messages.filter(pa.compute.equal(messages.column("kind"), kind))
    return zip(*(rows.column(c).to_pylist() for c in ("origin", "a", "b", "c", "d", "e")))


#: An id and the first 16 bytes of its text's SHA-256: a row that copies a smaller id's text.
_COPY = np.dtype([("id", "<i8"), ("text", "V16")])


def text_key(text: str) -> bytes:
    return hashlib.sha256(text.encode()).digest()[:16]


def _copies(messages: pa.Table) -> set[tuple[int, bytes]]:
    return {(int(d), t.tobytes()) for _, a, *_ in _read(messages, COPY) for d, t in np.frombuffer(a, _COPY)}


def _shared(messages: pa.Table) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(a, np.uint64) for _, a, *_ in _read(messages, SHARED))]))


def repeated_bytes(docs: DataFrame, length: int = 50, gram: int = GRAM, block_bytes: int = 10 << 20, texts: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed,
    n_spans, kept_sha256, and with ``texts`` the bytes kept.

    A byte goes if a string of ``length`` bytes that covers it also starts in a
    document with a smaller id.  Null texts are empty.  A null doc_id is smaller
    than none and larger than none: such a row keeps all.  Rows with equal ids are
    equals: neither is a reason to cut the other, and each is cut for its own text
    only.  Empty texts keep nothing and lose nothing; other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    n = block_count(docs, block_bytes=block_bytes)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # by id and text, so rows that share an id, or have none, spread over the blocks
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).alias("block")
    blocks = rows.select("doc_id", "text", block).groupBy("block")

    def to(messages: DataFrame):
        return messages.groupBy("target")

    # copies: rows whose text a smaller id has too
    hashed = rows.where("doc_id is not null").select("doc_id", block, F.unhex(F.sha2("text", 256)).alias("h"))
    first = hashed.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("h", "first")
    copies = (hashed.join(first, "h").where(F.col("doc_id") > F.col("first"))
              .select(F.col("block").alias("target"), F.lit(0).cast("long").alias("origin"), F.lit(COPY).alias("kind"), "doc_id", F.substring("h", 1, 16).alias("h")).distinct())

    def pack_ids(key, table):
        return _message([(key[0].as_py(), 0, COPY, np.array(list(zip(table.column("doc_id").to_pylist(), table.column("h").to_pylist())), _COPY).tobytes(), None, None, None, None)])

    copies = copies.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4))).groupBy("target", "part").applyInArrow(lambda key, t: pack_ids(key, t), MESSAGE)

    def send_anchors(key, table, messages):
        b = Block(table, _copies(messages), length, gram)
        doc, _, _, _, h = b.runs()
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        several = doc[new] != doc[np.append(new[1:], len(h)) - 1] if len(h) else np.zeros(0, bool)
        h = h[new]
        bucket = (h % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        h, several, bucket = h[order], several[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(n + 1))
        return _message([(k, key[0].as_py(), SHARED, h[x:y].tobytes(), several[x:y].tobytes(), None, None, None) for k, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if y > x])

    def answer_shared(key, messages):
        parts = list(_read(messages, SHARED))
        h = np.concatenate([np.frombuffer(a, np.uint64) for _, a, *_ in parts])
        several = np.concatenate([np.frombuffer(b, bool) for _, _, b, *_ in parts])
        origin = np.repeat(np.arange(len(parts)), [len(b) for _, _, b, *_ in parts])
        value, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
        shared = count > 1
        np.logical_or.at(shared, inverse, several)
        keep = shared[inverse]
        h, origin = h[keep], origin[keep]
        cuts = np.searchsorted(origin, np.arange(len(parts) + 1))
        return _message([(parts[k][0], key[0].as_py(), SHARED, h[x:y].tobytes(), None, None, None, None) for k, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if y > x])

    def send_pieces(key, table, messages):
        b = Block(table, _copies(messages), length, gram)
        *_, h, at, least, texts_ = b.pieces(_shared(messages))
        bucket = (h % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(n + 1))
        out = []
        for k, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if y > x:
                own = order[x:y]
                out.append((k, key[0].as_py(), LEAST, h[own].tobytes(), bytes(at[i] for i in own), least[own].tobytes(),
                            np.array([len(texts_[i]) for i in own], np.uint8).tobytes(), b"".join(texts_[i] for i in own)))
        return _message(out)

    def answer_least(key, messages):
        number: dict[tuple[int, int, bytes], int] = {}
        ids: list[int] = []
        asked = []
        for origin, a, b, c, d, e in _read(messages, LEAST):
            ends = np.cumsum(np.frombuffer(d, np.uint8), dtype=np.int64).tolist()
            own = np.frombuffer(c, np.int64)
            which = np.zeros(len(own), np.int64)
            start = 0
            for k, (h, at, end, doc) in enumerate(zip(np.frombuffer(a, np.uint64).tolist(), b, ends, own.tolist())):
                piece = (h, at, e[start:end])
                start = end
                i = number.setdefault(piece, len(number))
                if i == len(ids):
                    ids.append(doc)
                elif doc < ids[i]:
                    ids[i] = doc
                which[k] = i
            asked.append((origin, np.frombuffer(a, np.uint64), own, which))
        names = list(number)
        order = sorted(range(len(names)), key=lambda i: names[i][:2])
        found: list = [None] * len(names)
        least_of = np.array(ids, np.int64)
        group: list[int] = []
        size = 0
        for k, i in enumerate(order + [-1]):
            # pieces of one anchor stay together; SORT_BYTES bounds the string that is sorted
            if i < 0 or (size > SORT_BYTES and names[i][0] != names[order[k - 1]][0]):
                for j, got in zip(group, least_ids([names[j][2] for j in group], least_of[group], length) if group else []):
                    found[j] = got
                group, size = [], 0
            if i >= 0:
                group.append(i)
                size += len(names[i][2]) + 1
        out = []
        smallest = np.array([f.min() for f in found], np.int64)
        digest: dict[int, bytes] = {}
        for origin, hashes, own, which in asked:
            told = np.flatnonzero(smallest[which] < own)
            if len(told):
                some = which[told].tolist()
                for i in some:
                    if i not in digest:
                        digest[i] = _digests([names[i][2]])
                out.append((origin, key[0].as_py(), LEAST, hashes[told].tobytes(), bytes(names[i][1] for i in some),
                            b"".join(digest[i] for i in some), np.array([len(found[i]) for i in some], np.uint8).tobytes(),
                            np.concatenate([found[i] for i in some]).tobytes()))
        return _message(out)

    def cut(key, table, messages):
        b = Block(table, _copies(messages), length, gram)
        told: dict[tuple[int, int, bytes], np.ndarray] = {}
        for _, a, at, digests, sizes, flat in _read(messages, LEAST):
            ends = np.cumsum(np.frombuffer(sizes, np.uint8), dtype=np.int64)
            values = np.frombuffer(flat, np.int64)
            for k, h in enumerate(np.frombuffer(a, np.uint64).tolist()):
                told[(h, at[k], digests[16 * k:16 * k + 16])] = values[ends[k] - sizes[k]:ends[k]]
        doc, first, last, which, hashes, at, own, texts_ = b.pieces(_shared(messages))
        digests = [hashlib.blake2b(t, digest_size=16).digest() for t in texts_]
        least = [told.get((h, p, g)) for h, p, g in zip(hashes.tolist(), at, digests)]
        # windows to be cut, by their start; a byte is covered by those that start in the last ``length`` bytes
        starts = np.zeros(len(b.data), bool)
        ids, begin = b.ids[doc], b.offsets[doc] + first
        mine = own[which] < ids
        for x, y in zip(begin[mine].tolist(), (b.offsets[doc] + last + 1)[mine].tolist()):
            starts[x:y] = True
        asked = np.array([x is not None for x in least], bool)
        asked = np.flatnonzero(asked[which] & ~mine) if len(which) else which
        for x, w, i in zip(begin[asked].tolist(), which[asked].tolist(), ids[asked].tolist()):
            hit = least[w] < i
            starts[x:x + len(hit)] |= hit
        so_far = np.cumsum(starts, dtype=np.int64)
        covered = so_far > 0
        covered[length:] = so_far[length:] > so_far[:-length]
        result = {}
        for k, place in enumerate(b.place.tolist()):
            x, y = int(b.offsets[k]), int(b.offsets[k + 1])
            c = covered[x:y]
            spans = int(c[:1].sum()) + int((c[1:] & ~c[:-1]).sum())
            result[place] = (int(c.sum()), spans, b.data[x:y][~c].tobytes())
        out = []
        for place, (d, text) in enumerate(b.rows):
            raw = text.encode()
            gone, spans, kept = result.get(place) or ((len(raw), 1, b"") if b.copied[place] and len(raw) >= length else (0, 0, raw))
            out.append((d, len(raw), gone, spans, hashlib.sha256(kept).hexdigest()) + ((kept,) if texts else ()))
        kinds = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())] + [("kept", pa.binary())] * texts
        return pa.table([pa.array(list(c), t) for c, (_, t) in zip(zip(*out), kinds)] if out else [pa.array([], t) for _, t in kinds], schema=pa.schema(kinds))

    shared = to(blocks.cogroup(to(copies)).applyInArrow(send_anchors, MESSAGE)).applyInArrow(answer_shared, MESSAGE).union(copies)
    least = to(blocks.cogroup(to(shared)).applyInArrow(send_pieces, MESSAGE)).applyInArrow(answer_least, MESSAGE).union(shared)
    return blocks.cogroup(to(least)).applyInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if texts else ""))


def _digests(texts: list[bytes]) -> bytes:
    return b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts)
