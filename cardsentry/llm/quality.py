"""Quality rules as a learned decision list, in DataFrame expressions only.

``measures`` gives the base counts of each text; ``ratios`` derives scale-free
features from them.  ``learn`` grows an ordered list of rules for the label
"bad" by sequential covering:

* thresholds come from approximate quantiles of each feature over labelled rows;
  each labelled row is then the vector of its thresholds' numbers (``bins``);
* a rule starts empty and takes the condition (feature above or below a
  threshold) with the best gain, up to ``max_conditions``;
* conditions are dropped again while that doesn't lower the rule's precision on
  the pruning rows, which growing doesn't see;
* the rule is kept if it is precise enough on both parts, the rows it covers
  leave the table, and the next rule is grown on the rest.

Each growing step is one histogram over the labelled rows (feature, threshold
number, part, label), from which the counts of all candidate conditions follow;
only these counts reach the driver.  ``verdict``
turns the list into one chain of conditional expressions.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import prepare, stored, whole_rows

WHITE = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = ("word_length", "symbol_share", "dup_line_share", "repeat_share", "capital_share", "mark_share", "distinct_share", "line_words")


def _without(text: Column, chars: str) -> Column:
    """Code points left when ``chars`` are taken out."""
    return F.length(F.translate(text, chars, ""))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(words: Column, n: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Most texts have no such window: as many distinct hashes as windows shows it.
    Otherwise the windows are sorted by hash, neighbours with equal hashes give
    the places, and each place adds the words not covered by the one before it.
    """
    places = F.sequence(F.lit(0), n - 3)
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    by_hash = F.sort_array(F.transform(places, lambda i: F.struct(window(i).alias("h"), i.alias("i"))))

    def found(b: Column) -> Column:
        twin = F.filter(F.sequence(F.lit(1), n - 3), lambda k: F.get(b, k)["h"] == F.get(b, k - 1)["h"])
        return _let(twin, lambda t: F.sort_array(F.array_distinct(F.concat(F.transform(t, lambda k: F.get(b, k)["i"]), F.transform(t, lambda k: F.get(b, k - 1)["i"])))))

    words_in = F.aggregate(_let(by_hash, found), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                           lambda acc, i: F.struct((acc["n"] + i + 3 - F.greatest(i, acc["end"])).alias("n"), (i + 3).alias("end")), lambda acc: acc["n"])
    return F.when(n < 4, 0).when(F.size(F.array_distinct(F.transform(places, window))) == n - 2, 0).otherwise(words_in)


def _fixed(df: DataFrame, *columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row: a generator's output is
    neither inlined into its uses nor recomputed by a filter pushed below it."""
    return df.select("*", F.inline(F.array(F.struct(*columns))))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks", "n_distinct")


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of each whole text (null: none) as columns ``q_<count>``;
    columns of these names that ``docs`` has are replaced."""
    docs = docs.drop("q_words", "q_lines", *("q_" + c for c in COUNTS))
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0)
    cut = _fixed(docs, words.alias("q_words"), lines.alias("q_lines"))
    n = F.size("q_words")
    counts = (n, _without(text, WHITE), F.length(text) - _without(text, SYMBOLS), F.size("q_lines") - F.size(F.array_distinct("q_lines")),
              _repeated(F.col("q_words"), n), F.size("q_lines"), F.length(text) - _without(text, CAPITALS), F.length(text) - _without(text, "!?"),
              F.size(F.array_distinct("q_words")))
    return _fixed(cut, *(c.cast("long").alias("q_" + name) for name, c in zip(COUNTS, counts))).drop("q_words", "q_lines")


def ratios() -> dict[str, Column]:
    """Features of a row of ``measures``; 0 where there is nothing to divide by."""
    q = lambda name: F.col("q_" + name).cast("double")
    share = lambda a, b: F.when(q(b) > 0, q(a) / q(b)).otherwise(0.0)
    return {"word_length": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"), "capital_share": share("n_capitals", "word_chars"), "mark_share": share("n_marks", "n_words"),
            "distinct_share": share("n_distinct", "n_words"), "line_words": share("n_words", "n_lines")}


def base_failed() -> Column:
    return (F.col("q_n_words") < 50) | (100 * F.col("q_n_repeat_words") > 50 * F.col("q_n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > cut, else feature <= cut
    cut: float

    def holds(self, value: Column) -> Column:
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    bad: int
    good: int


def _all(conditions, columns: dict[str, Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.holds(columns[c.feature])
    return out


def _grown_counts(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[dict[Condition, tuple[int, int]], tuple[int, int]]:
    """(bad, good) growing rows for each condition, and of all of them."""
    below = lambda f: lambda c: c < F.col(f)
    number = [F.struct(F.lit(f).alias("f"), F.size(F.filter(F.array(*map(F.lit, at)), below(f))).alias("bin")) for f, at in cuts.items()]
    seen = rows.where("part = 0").select("label", F.explode(F.array(*number)).alias("x")).groupBy("x.f", "x.bin", "label").count().collect()
    table = {f: [[0] * (len(at) + 1), [0] * (len(at) + 1)] for f, at in cuts.items()}
    for r in seen:
        table[r["f"]][r["label"]][r["bin"]] = r["count"]
    out = {}
    for f, at in cuts.items():
        bad, good = table[f]
        for k, c in enumerate(at):  # bin > k: above the k-th threshold
            out[Condition(f, True, c)] = sum(bad[k + 1:]), sum(good[k + 1:])
            out[Condition(f, False, c)] = sum(bad[:k + 1]), sum(good[:k + 1])
    some = next(iter(table.values()))
    return out, (sum(some[0]), sum(some[1]))


def learn(labelled: DataFrame, max_rules: int = 8, max_conditions: int = 3, cuts: int = 16, precision: float = 0.97, least: int = 8) -> list[Rule]:
    """The ordered rules for label 0 from rows (label, part, the features).

    part 0 grows and part 1 prunes.  ``least``: bad rows of both parts that a rule
    covers at least.  Without labelled rows, or with one label only, there are none.
    """
    at = [(k + 1) / (cuts + 1) for k in range(cuts)]
    # both labels' quantiles: the rarer label shapes the thresholds as much as the other
    marks = labelled.groupBy("label").agg(*(F.percentile_approx(f, at, 1000).alias(f) for f in FEATURES)).collect()
    if {r["label"] for r in marks} != {0, 1}:
        return []
    thresholds = {f: sorted({float(x) for r in marks for x in r[f]}) for f in FEATURES}
    value = {f: F.col(f) for f in FEATURES}
    rules: list[Rule] = []
    rest = labelled

    def parts(tests: list[tuple[Condition, ...]]) -> list[tuple[int, int, int, int]]:
        """For each conjunction: bad and good rows of the growing part, then of the pruning part."""
        sums = [F.count_if(_all(t, value) & (F.col("part") == p) & (F.col("label") == label)).alias(f"c{k}_{p}_{label}") for k, t in enumerate(tests) for p in (0, 1) for label in (0, 1)]
        row = rest.agg(*sums).first()
        return [tuple(row[4 * k:4 * k + 4]) for k in range(len(tests))]

    while len(rules) < max_rules:
        chosen: tuple[Condition, ...] = ()
        while len(chosen) < max_conditions:
            found, (b0, g0) = _grown_counts(rest.where(_all(chosen, value)), thresholds)
            if not b0 or not g0:
                break
            best, gain = None, 0.0
            for c, (b, g) in found.items():
                if b < max(1, least // 2):
                    continue
                # Laplace-corrected precision weighed by the square root of the bad rows kept
                now = ((b + 1) / (b + g + 2) - (b0 + 1) / (b0 + g0 + 2)) * b ** 0.5
                if now > gain + 1e-12:
                    best, gain = c, now
            if best is None:
                break
            chosen += (best,)
        if not chosen:
            break
        while len(chosen) > 1:  # prune
            shorter = [tuple(c for c in chosen if c != d) for d in chosen]
            score = [(b + 1) / (b + g + 2) for _, _, b, g in parts([chosen, *shorter])]
            k = max(range(1, len(score)), key=lambda k: score[k])
            if score[k] < score[0]:
                break
            chosen = shorter[k - 1]
        b, g, bp, gp = parts([chosen])[0]
        if b + bp < least or b + bp < precision * (b + bp + g + gp) or bp < precision * (bp + gp):
            break
        rules.append(Rule(chosen, b + bp, g + gp))
        rest = rest.where(~_all(chosen, value))
    return rules


def rejected_by(rules: list[Rule], columns: dict[str, Column]) -> Column:
    """Number of the first rule that holds, from 1; null if none does."""
    out = None
    for k, r in enumerate(rules):
        test = _all(r.conditions, columns)
        out = F.when(test, k + 1) if out is None else out.when(test, k + 1)
    return F.lit(None).cast("int") if out is None else out


def labelled_features(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """Rows (label, part, features) of at most about ``sample_rows`` labelled documents,
    those with the smallest hashes of their ids; the bound is on training rows only."""
    marks = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", F.col("quality").alias("label")).distinct()
    n = marks.count()
    if n > sample_rows:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < max(1, 1_000_000 * sample_rows // n))
    # at most about sample_rows ids, so they go to the texts, not the texts to them
    rows = measures(docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id"))
    part = (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 2).cast("int").alias("part")
    return stored(rows.select("label", part, base_failed().alias("failed"), *(c.alias(f) for f, c in ratios().items())), "labelled").where("not failed")


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with the counts, q_base_failed, q_rule (the first that holds) and q_kept."""
    out = measures(docs.drop("q_base_failed", "q_rule", "q_kept"))
    return out.select("*", base_failed().alias("q_base_failed"), rejected_by(rules, ratios()).alias("q_rule")).withColumn("q_kept", ~F.col("q_base_failed") & F.col("q_rule").isNull())


def learned_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = 50_000) -> list[Rule]:
    prepare(docs.sparkSession)
    return learn(labelled_features(docs, labels, sample_rows))


def quality(docs: DataFrame, labels: DataFrame, sample_rows: int = 50_000) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text), judged by rules learned
    from ``labels`` (doc_id, quality: 1 good, 0 bad).

    Null and empty texts have no words and fail the base rules.  Labels without
    document, with other values or null teach nothing; a document with both labels
    counts once for each.  Without labels the list is empty and only base rules hold.
    """
    out = judged(docs.select("doc_id", "text"), learned_rules(docs, labels, sample_rows))
    return out.select("doc_id", *(F.col("q_" + c).alias(c) for c in COUNTS[:5]), *(F.col("q_" + c).alias(c) for c in ("base_failed", "kept", "rule")))


def accepted(docs: DataFrame, labels: DataFrame, sample_rows: int = 50_000) -> DataFrame:
    """``docs`` without the rows that the base rules or the learned ones reject."""
    rules = learned_rules(docs, labels, sample_rows)
    return judged(docs.select(whole_rows(docs), "text"), rules).where("q_kept").select("row.*")
