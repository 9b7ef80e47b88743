"""Quality rules as a learned decision list, in DataFrame expressions only.

Statistics of a text are Spark expressions over its array of words. From the statistics of a bounded sample of labelled
documents sequential covering learns threshold conjunctions for both verdicts: in each round a rule for either grows by
the condition that raises its gain the most and is pruned on rows that it did not grow from; the surer of the two joins
the list and takes the rows that it covers out of play. The rules become one ordered CASE expression, of which the first
match decides and the default keeps, so scoring stays inside generated code and nothing is shuffled.

A null or empty text has no words and all its statistics are zero; it fails the base rules. Ties between conditions go
to the one named first, between rules to the one that rejects. Of rows that repeat a labelled doc_id the one with the
least text is learned from; labels that repeat it are bad if one is. Without labels there are no rules, and the base
rules decide alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import quoted

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WORD = "[^\\x20\\x09-\\x0D]"
#: Labelled documents that are learned from at most.
SAMPLE = 8000
MIN_WORDS = 50
FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "capital_share", "shout_share", "distinct_share")
#: Thresholds tried for each feature.
STEPS = 24
MADE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *(f for f in FEATURES if f != "n_words"))


def _without(text: Column, signs: str) -> Column:
    return F.length(F.translate(text, signs, ""))


def _once(x: Column) -> Column:
    """x, marked so that the optimizer neither copies it into the expressions that use it nor moves filters below it:
    within a lambda a copy would be computed again for each element."""
    return F.when(F.monotonically_increasing_id() >= 0, x)


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the learner's shares.

    n_repeat_words counts the words that stand in a 3-word window which is found twice or more in the text. A window is
    known by a 64-bit hash of its words. Texts without a repeated window are told by one distinct count; only the others
    sort their windows.
    """
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    flat = F.trim(F.translate(own, SPACES, " " * len(SPACES)))
    df = docs.withColumn("_t", own).withColumn("_w", _once(F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " +"))))
    word = lambda i: F.get("_w", i)
    windows = F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))
    df = df.withColumn("n_words", F.size("_w").cast("long")).withColumn("_h", _once(F.when(F.size("_w") >= 3, windows)))
    df = df.withColumn("_d", _once(F.size(F.array_distinct("_h")) < F.size("_h")))
    df = df.withColumn("_s", _once(F.when(F.col("_d"), F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))))
    at = lambda k: F.get("_s", k)
    twice = F.transform("_s", lambda x, k: F.when((at(k - 1)["h"] == x["h"]) | (at(k + 1)["h"] == x["h"]), x["i"]))
    covered = F.aggregate(
        F.sort_array(F.array_compact(twice)),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"].cast("long"),
    )
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD))
    df = df.withColumn("n_repeat_words", F.coalesce(F.when(F.col("_d"), covered), F.lit(0).cast("long")))
    df = df.withColumn("_l", _once(lines))
    length = F.length("_t")
    df = df.withColumns({
        "word_chars": _once(_without(F.col("_t"), SPACES).cast("long")),
        "n_symbols": (length - _without(F.col("_t"), SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_lines": F.size("_l"),
        "_capitals": length - _without(F.col("_t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "_shouts": length - _without(F.col("_t"), "!?"),
        "_distinct": F.size(F.array_distinct("_w")),
    })
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    df = df.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "mean_word": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "capital_share": F.col("_capitals") / chars,
        "shout_share": F.col("_shouts") / chars,
        "distinct_share": F.col("_distinct") / words,
    })
    return df.drop("_t", "_w", "_h", "_d", "_s", "_l", "_lines", "_capitals", "_shouts", "_distinct")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """What rows that meet all conditions get; precision and covered: of the training rows that no rule before it took."""

    conditions: tuple[Condition, ...]
    keeps: bool
    precision: float
    covered: int

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return f"if {' and '.join(map(str, self.conditions))}: {'keep' if self.keeps else 'reject'} ({self.precision:.3f} of {self.covered})"


def _bits(flags) -> int:
    return int("".join("1" if x else "0" for x in flags) or "0", 2)


def _best(items, key):
    """The first of the greatest."""
    out, most = None, None
    for x in items:
        k = key(x)
        if most is None or k > most:
            out, most = x, k
    return out


def _centred(rule: list[Condition], rows: list[dict], bad: bool) -> list[Condition]:
    """The conditions with thresholds midway between what they let through of the class and what they hold back, so that
    a value a little beyond what was seen does not decide."""
    out = []
    hit = [r for r in rows if r["bad"] == bad and all(c.holds(r) for c in rule)]
    for c in rule:
        inside = [r[c.feature] for r in hit]
        outside = [r[c.feature] for r in rows if not c.holds(r)]
        if inside and outside:
            near = (max(outside), min(inside)) if c.above else (max(inside), min(outside))
            c = Condition(c.feature, c.above, sum(near) / 2)
        out.append(c)
    return out


def learn(rows: list[dict], reject_precision: float = 0.95, keep_precision: float = 0.995, least_covered: int = 8, most_rules: int = 16, most_conditions: int = 4) -> list[Rule]:
    """An ordered list of rules from rows with the features and ``bad``. Rows are bit positions of whole numbers, so that a
    condition's count is one ``and``. Two rows of three grow rules, every third prunes them."""
    from math import log2

    if not rows or not any(r["bad"] for r in rows):
        return []
    every = (1 << len(rows)) - 1
    grow = _bits(i % 3 != 2 for i in range(len(rows)))
    bad = _bits(r["bad"] for r in rows)
    covers: dict[Condition, int] = {}
    for f in FEATURES:
        for own in (True, False):  # thresholds at quantiles of either class
            values = sorted({r[f] for r in rows if r["bad"] == own})
            for cut in sorted({values[len(values) * i // STEPS] for i in range(STEPS)}) if values else []:
                for above in (True, False):
                    c = Condition(f, above, float(cut))
                    if c not in covers:
                        covers[c] = _bits(c.holds(r) for r in rows)
    open_ = every

    def grown(rejects: bool) -> tuple[Rule, int] | None:
        """The best rule for a class over the rows in play, and what it covers of them."""
        target, least = (bad, reject_precision) if rejects else (every & ~bad, keep_precision)

        def counts(mask: int) -> tuple[int, int]:
            p = (mask & target).bit_count()
            return p, mask.bit_count() - p

        mask, chosen = open_ & grow, []
        while len(chosen) < most_conditions:
            p0, n0 = counts(mask)
            if not p0 or not n0:
                break
            base = log2(p0 / (p0 + n0))

            def gain(c: Condition) -> float:
                p, n = counts(mask & covers[c])
                return p * (log2(p / (p + n)) - base) if p >= least_covered // 2 else -1.0

            c = _best(covers, gain)
            if gain(c) <= 0:
                break
            chosen.append(c)
            mask &= covers[c]
        if not chosen:
            return None

        def worth(n_conditions: int) -> float:
            m = open_ & ~grow
            for c in chosen[:n_conditions]:
                m &= covers[c]
            p, n = counts(m)
            return (p - n) / (p + n) if p + n else -1.0

        pruned = chosen[: _best(range(1, len(chosen) + 1), worth)]
        # a rule is tested as it will be used: pruned before whole, with centred thresholds before those it grew with
        for own in (_centred(pruned, rows, rejects), pruned, _centred(chosen, rows, rejects), chosen):
            mask = open_
            for c in own:
                mask &= covers[c] if c in covers else _bits(c.holds(r) for r in rows)
            p, n = counts(mask)
            if p >= least_covered and p / (p + n) >= least:
                return Rule(tuple(own), not rejects, p / (p + n), p + n), mask
        return None

    out: list[Rule] = []
    while len(out) < most_rules:
        rejects = grown(True)
        if rejects is None:
            break  # the default keeps what is left
        found = [x for x in (rejects, grown(False)) if x is not None]
        rule, mask = _best(found, lambda x: x[0].precision)
        out.append(rule)
        open_ &= ~mask
    while out and out[-1].keeps:
        out.pop()  # as the default does
    return out


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> list[dict]:
    """Statistics of at most ``sample`` labelled documents that pass the base rules: those whose ids hash lowest."""
    chosen = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.min(label) == 0).alias("bad"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.max("bad").alias("bad"), F.min("text").alias("text"))
    stats = with_stats(texts).filter(~F.col("base_failed")).select("doc_id", "bad", *FEATURES)
    return [r.asDict() for r in stats.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]


def kept_column(rules: list[Rule]) -> Column:
    """The ordered conditional expression: false if the base rules reject, else what the first rule that matches says."""
    out = F.when(F.col("base_failed"), F.lit(False))
    for r in rules:
        out = out.when(r.column(), F.lit(r.keeps))
    return out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """docs with the statistics, base_failed and kept; columns of docs that have one of these names are replaced."""
    rules = learn(labelled_rows(docs, labels, sample=sample))
    return apart(docs).withColumn("kept", kept_column(rules)).select(*[F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in MADE], *MADE)


def passed(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that are kept, with their columns as they are, whatever their names."""
    rules = learn(labelled_rows(docs, labels, sample=sample))
    return apart(docs).filter(kept_column(rules)).select("_row.*")


def apart(docs: DataFrame) -> DataFrame:
    """Every row as one column _row, with the statistics of its text beside it: no name can clash."""
    return with_stats(docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row"), "text"))
