"""Near-duplicates: one-permutation MinHash with optimal densification.

1. Each document's set of word shingles is hashed once; the hash range is cut into
   ``bins`` and each bin keeps its smallest hash.  An empty bin takes the value of
   the first full bin that a hash of (bin, attempt) names, the same for all
   documents, so two signatures agree in a bin as often as the sets are similar.
2. Rows with equal sets form a class.  Its node is its smallest id with 62 bits of
   the set's key behind it: ordered by id, and different for two texts under one id.
3. ``bands`` of ``rows`` bins give buckets.  A bucket's smallest node is its centre
   and each other member one candidate edge, so edges grow with the members.
4. Each edge is confirmed on the full sets.  The task also keeps the symmetric
   difference D of member and centre.  Two members x, y of a star differ by
   D(x) ^ D(y), and if their centre is linked with neither, they can be linked only
   if D(x) and D(y) share enough elements; an inverted index over the differences
   finds such links.  A link inside a component that is already joined adds nothing:
   members of the largest component are only met with those outside it, and each
   component found gives one link, so a block gives fewer links than it has members.
5. Links are contracted to components.

With 42 bands of 6 rows, two sets of similarity 0.85 miss every bucket with a
probability of about 2e-9, at 0.9 of about 1e-14.
"""
from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import LOWER, SPACED, mix, prepare, shingle_hashes, slices, stored, utf8, whole_rows, word_hashes, word_runs
from .components import components

#: Members of a star, and bytes of their differences, that meet in one task.
STAR_BLOCK, STAR_BYTES = 20_000, 32 << 20
NODE = "decimal(38,0)"
_NODE_SPAN = 1 << 62


def shingle_sets(column, width: int = 5):
    """The sorted distinct shingle hashes of each text, in order."""
    data, offsets = utf8(column)
    for i, j in slices(offsets):
        part = LOWER[data[offsets[i]:offsets[j]]]
        at = offsets[i:j + 1] - offsets[i]
        s, e = word_runs(part, at, SPACED)
        hashes, first = shingle_hashes(word_hashes(part, s, e), np.searchsorted(s, at), width)
        for k in range(j - i):
            yield np.unique(hashes[first[k]:first[k + 1]])


def signature(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of ``bins`` values for each set that isn't empty."""
    sig = np.zeros((len(sets), bins), np.uint64)
    full = np.zeros((len(sets), bins), bool)
    for r, s in enumerate(sets):
        h = mix(s + np.uint64(0x5851F42D4C957F2D))
        h.sort()
        b = ((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        got, at = np.unique(b, return_index=True)
        sig[r, got], full[r, got] = h[at], True
    row, col = np.nonzero(~full)
    attempt = 0
    while len(row):
        donor = (mix(col.astype(np.uint64) * np.uint64(1 << 32) + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        ok = full[row, donor]
        sig[row[ok], col[ok]] = sig[row[ok], donor[ok]]
        row, col, attempt = row[~ok], col[~ok], attempt + 1
    return sig


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit bucket key of each band, the band's number mixed in."""
    bands = sig.shape[1] // rows
    key = np.tile(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(sig), 1))
    for k in range(rows):
        key = mix(key * np.uint64(0x2545F4914F6CDD1D) + sig[:, k:bands * rows:rows])
    return key


def _sketch(width: int, bins: int, rows: int):
    def sketch(batches):
        for b in batches:
            for i, j in slices(utf8(b.column("text"))[1], 4 << 20):
                part = b.slice(i, j - i)
                sets = list(shingle_sets(part.column("text"), width))
                some = [k for k, s in enumerate(sets) if len(s)]
                keys = band_keys(signature([sets[k] for k in some], bins), rows).astype(np.int64)
                n = np.zeros(len(sets), np.int64)
                n[some] = keys.shape[1] if len(some) else 0
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(keys.reshape(-1)))], names=["doc_id", "text_key", "n_shingles", "set_key", "bands"])
    return sketch


def _confirm(width: int, num: int, den: int):
    """Edges (center, member, center_text, member_text) with their sets' sizes and, as bytes, the difference."""

    def confirm(batches):
        for b in batches:
            sizes = utf8(b.column("a_text"))[1] + utf8(b.column("b_text"))[1]
            for i, j in slices(sizes, 4 << 20):
                part = b.slice(i, j - i)
                linked, na, nb, diff = [], [], [], []
                for x, y in zip(shingle_sets(part.column("a_text"), width), shingle_sets(part.column("b_text"), width)):
                    d = np.setxor1d(x, y, assume_unique=True)
                    both = (len(x) + len(y) - len(d)) // 2
                    linked.append(den * both >= num * (len(x) + len(y) - both) and both > 0)
                    na.append(len(x)), nb.append(len(y)), diff.append(d.tobytes())
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(linked, pa.bool_()), pa.array(na, pa.int64()), pa.array(nb, pa.int64()), pa.array(diff, pa.binary())],
                                                 names=["a", "b", "linked", "na", "nb", "diff"])
    return confirm


def _postings(diffs: list[np.ndarray], some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Elements of the differences of some members in order, and whose each is."""
    elements = np.concatenate([np.zeros(0, np.uint64), *(diffs[k] for k in some.tolist())])
    owner = np.repeat(some, [len(diffs[k]) for k in some.tolist()])
    order = np.argsort(elements, kind="stable")
    return elements[order], owner[order]


def _shared(diff: np.ndarray, elements: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many elements of ``diff`` each of the n members has, of those in the postings."""
    lo, hi = np.searchsorted(elements, diff, "left"), np.searchsorted(elements, diff, "right")
    spans = hi - lo
    at = np.repeat(lo - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
    return np.bincount(owner[at], minlength=n)


def spanning_links(ids: list, sizes: np.ndarray, diffs: list[np.ndarray], linked: np.ndarray, left: np.ndarray, num: int, den: int) -> list[tuple]:
    """Of ``star_links`` so many that, with the links to the centre, the same members
    are joined: each is between two components of those before it."""
    n = np.array([len(d) for d in diffs], np.int64)
    label = np.arange(len(diffs))
    label[linked] = np.flatnonzero(linked)[0] if linked.any() else 0
    everything = np.arange(len(diffs))
    full = _postings(diffs, everything)
    rest, inner, outside = full, -1, len(diffs)  # postings of those outside the component ``inner``
    out = []
    for k in np.flatnonzero(left & ~linked).tolist():
        away = label != label[k]
        if not away.any():
            break  # all are joined
        shared = _shared(diffs[k], *(rest if label[k] == inner else full), len(diffs))
        near = (n[k] + n - 2 * shared) * (den + num) <= (den - num) * (sizes[k] + sizes)
        near &= (shared > 0) & away
        if not near.any():
            continue
        joined, first = np.unique(label[near], return_index=True)
        out += [(ids[k], ids[y]) for y in np.flatnonzero(near)[first].tolist()]
        label[np.isin(label, joined)] = label[k]
        counts = np.bincount(label)
        largest = int(counts.argmax())
        if len(diffs) - int(counts[largest]) < outside // 2:
            inner, outside = largest, len(diffs) - int(counts[largest])
            rest = _postings(diffs, everything[label != inner])
        elif counts[inner] == 0:  # it was joined to a smaller one's label
            inner = int(label[k])
    return out


def star_links(ids: list[int], sizes: np.ndarray, diffs: list[np.ndarray], linked: np.ndarray, left: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links between members of one star of which the first isn't linked with the centre.

    |x ^ y| = |D(x)| + |D(y)| - 2 * shared, and similarity >= num/den means
    |x ^ y| * (den + num) <= (den - num) * (|x| + |y|).  Posting lists over the
    elements of the differences count what is shared; members without a shared
    element can't be linked (see the module's text).
    """
    n = np.array([len(d) for d in diffs], np.int64)
    elements, owner = _postings(diffs, np.arange(len(diffs)))
    out = []
    for k in np.flatnonzero(left & ~linked).tolist():
        shared = _shared(diffs[k], elements, owner, len(diffs))
        near = (n[k] + n - 2 * shared) * (den + num) <= (den - num) * (sizes[k] + sizes)
        # of two members that aren't linked with the centre, the smaller id finds the link
        near &= (shared > 0) & (np.arange(len(diffs)) != k)
        out += [(ids[k], ids[y]) for y in np.flatnonzero(near).tolist() if linked[y] or not left[y] or ids[k] < ids[y]]
    return out


def near_links(docs: DataFrame, similarity: Fraction = Fraction(85, 100), width: int = 5, bins: int = 252, rows: int = 6) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, classes, links): rows with n_shingles, set_key and the text's hash,
    the node of each set, and confirmed links between nodes, as many as join
    what is linked."""
    spark = docs.sparkSession
    prepare(spark)
    num, den = similarity.numerator, similarity.denominator
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = stored(narrow.withColumn("text_key", text_key()).mapInArrow(_sketch(width, bins, rows), "doc_id long, text_key string, n_shingles long, set_key binary, bands array<long>"), "sketches")
    low = F.conv(F.substring(F.hex("set_key"), 1, 16), 16, 10).cast(NODE)
    classes = stored(sketches.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
                     .withColumn("node", (F.col("rep").cast(NODE) * F.lit(_NODE_SPAN).cast(NODE) + F.pmod(low, F.lit(_NODE_SPAN).cast(NODE))).cast(NODE)), "classes")
    speakers = sketches.join(classes, [sketches.set_key == classes.set_key, sketches.doc_id == classes.rep])
    members = speakers.select(F.col("node").alias("rep"), F.explode("bands").alias("bucket"))
    stars = members.groupBy("bucket").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a <> last").select("bucket", "a")
    edges = stored(members.join(stars, "bucket").where("rep <> a").select("a", F.col("rep").alias("b")).distinct(), "edges")
    # texts of both ends; every other document is left out before its text is shuffled
    # one text of each set, under its smallest id, speaks for it
    ends = (edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            .join(speakers.select("node", "doc_id", "text_key"), "node").groupBy("node", "doc_id").agg(F.min("text_key").alias("text_key")))
    # the same joins at every size: what is small here grows with the corpus
    keyed = narrow.withColumn("text_key", text_key())
    texts = stored(keyed.join(ends.hint("merge"), ["doc_id", "text_key"]).dropDuplicates(["node"]).select("node", "text"), "ends")
    pairs = (edges.hint("merge").join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
             .hint("merge").join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a").select("a", "b", "a_text", "b_text"))
    tested = stored(pairs.mapInArrow(_confirm(width, num, den), f"a {NODE}, b {NODE}, linked boolean, na long, nb long, diff binary"), "tested")

    def siblings(key, table):
        flip = table.to_pydict()
        diffs = [np.frombuffer(x, np.uint64) for x in flip["diff"]]
        i, j = key[1].as_py(), key[2].as_py()
        mine = np.array([x == i for x in flip["salt"]], bool)
        found = spanning_links(flip["b"], np.array(flip["nb"], np.int64), diffs, np.array(flip["linked"], bool), mine, num, den)
        return pa.table({"a": pa.array([x for x, _ in found], pa.decimal128(38)), "b": pa.array([y for _, y in found], pa.decimal128(38))})

    # Stars without an unlinked member are done.  The others are met in blocks of about
    # STAR_BLOCK members or STAR_BYTES of differences: block pair (i, j) has the members of i and j,
    # so no group is whole in one task.
    open_stars = (tested.groupBy("a").agg(F.count("*").alias("n"), F.count(F.expr("if(not linked, 1, null)")).alias("free"), F.sum(F.octet_length("diff")).alias("bytes"))
                  .where("free > 0 and n > 1").select("a", F.greatest(F.ceil(F.col("n") / STAR_BLOCK), F.ceil(F.col("bytes") / STAR_BYTES)).cast("int").alias("blocks")))
    salted = tested.join(open_stars, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int"))
    met = (salted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("a", "b", "linked", "nb", "diff", "salt", F.explode(F.array_distinct(F.array(F.struct(F.col("salt").alias("i"), F.col("other").alias("j")), F.struct(F.col("other").alias("i"), F.col("salt").alias("j"))))).alias("pair"))
           .select("a", "b", "linked", "nb", "diff", "salt", "pair.i", "pair.j"))
    between = met.groupBy("a", "i", "j").applyInArrow(siblings, f"a {NODE}, b {NODE}")
    links = stored(tested.where("linked").select("a", "b").union(between.distinct()), "near-links")
    return sketches.select("doc_id", "text_key", "n_shingles", "set_key"), classes, links


def text_key() -> Column:
    """128 bits of a text; null counts as empty."""
    return F.md5(F.coalesce(F.col("text"), F.lit("")))


def near_duplicates(docs: DataFrame, similarity: Fraction = Fraction(85, 100), width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text).

    kept: the document is the smallest id of its component.  Null and empty texts
    and texts of white space have no shingles and are linked with nothing.  A null
    doc_id can't be named as a partner: such a row is kept, in a component without
    id.  A row is judged by its own text: rows that repeat have the same answer, and
    two texts under one doc_id have an answer each, so neither goes with the other.
    Long texts count whole; other columns are not read.  An empty table gives no rows.
    """
    return judged(docs, similarity, width).drop("text_key")


def judged(docs: DataFrame, similarity: Fraction = Fraction(85, 100), width: int = 5) -> DataFrame:
    """``near_duplicates`` with text_key, which tells the texts of one doc_id apart."""
    rows, classes, links = near_links(docs, similarity, width)
    # a component's id is in front of its smallest node's 62 bits
    of = components(links).select(F.col("id").alias("node"), F.expr(f"cast((component - pmod(component, {_NODE_SPAN}BD)) as {NODE}) div {_NODE_SPAN}BD").alias("component"))
    named = classes.join(of, "node", "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    return (rows.join(named, "set_key", "left")
            .select("doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def distinct_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the rows of each component's smallest document; a row goes by its id and its text."""
    gone = judged(docs, **options).where(~F.col("kept")).select(F.col("doc_id").alias("gone"), F.col("text_key").alias("gone_text")).distinct()
    rows = docs.select(whole_rows(docs), F.col("doc_id").cast("long").alias("gone"), text_key().alias("gone_text"))
    return rows.join(gone, ["gone", "gone_text"], "left_anti").select("row.*")
