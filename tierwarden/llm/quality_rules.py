"""Quality rules whose cutoffs are chosen with a guarantee on false rejections.

Counts of every text (words, characters, symbols, repeated lines, repeated three-word windows) feed
``RULES``. A rule compares a ratio with one of its cutoffs, listed from lenient to strict, so what a
cutoff rejects is rejected by all stricter ones. Labelled rows decide which cutoffs may be used: with n
good rows in a stratum, a cutoff that rejects k of them is certified if, were its true rate of false rejections
above ``risk``, so few rejections would have a probability of at most ``doubt``: P(Bin(n, risk) <= k) <= doubt
(the exact, Clopper-Pearson, bound). ``false_rejection`` is shared out among the rules and ``error`` among all
pairs of stratum and rule (Bonferroni); along a rule's cutoffs the tests run from lenient to strict and stop at the first failure, which needs
no further correction. So with probability 1 - ``error``, in every stratum at once, all rules together reject at most the
share ``false_rejection`` of good rows. Of the certified cutoffs the one with the greatest excess of rejected bad rows
over rejected good rows (as shares) is used, if there is an excess, and the most lenient of equals. A stratum
with too few good rows gets no cutoffs, only the base checks.

DataFrame functions only. Counts of all rows are stored once; calibration aggregates them to strata x rules x cutoffs.

Defined results: null and empty texts have no words and fail the base checks; words are compared exactly; a text of n
words costs a sort of n windows, only if some window occurs twice; repeated rows are kept and count
each; an id labelled more than once takes its largest label; null ids and labels are not learned from; a null stratum is a stratum; no labels, no cutoffs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwarden.llm.storage import stored

BLANK = r"\x20\x09-\x0D"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_with_words"]


@dataclass(frozen=True)
class Rule:
    """Rejects where ``scale * count`` is above (or below) ``cutoff * base``; cutoffs go from lenient to strict."""

    name: str
    count: str
    base: str
    scale: int
    cutoffs: tuple[int, ...]
    above: bool = True

    def rejected_from(self) -> Column:
        """Place of the first cutoff that rejects the row; the number of cutoffs if none does."""
        value = F.col(self.count) * self.scale
        passed = [(value <= F.col(self.base) * c) if self.above else (value >= F.col(self.base) * c) for c in self.cutoffs]
        return sum((p.cast("int") for p in passed), F.lit(0))


RULES = (
    Rule("symbols", "n_symbols", "n_words", 1000, (1000, 700, 500, 350, 250, 180, 130, 90, 60, 40, 25)),
    Rule("dup_lines", "n_dup_lines", "n_lines_with_words", 100, (90, 80, 70, 60, 50, 40, 30, 20, 10)),
    Rule("repeat_words", "n_repeat_words", "n_words", 100, (45, 40, 35, 30, 25, 20, 15, 10, 5)),
    Rule("long_words", "word_chars", "n_words", 10, (200, 150, 120, 100, 90, 80, 75, 70, 65)),
    Rule("short_words", "word_chars", "n_words", 10, (10, 15, 20, 25, 30, 33, 36, 39), above=False),
)


def counted(df: DataFrame, text: str, *keep: Column) -> DataFrame:
    """The columns ``keep`` and ``COUNTS`` of every text."""
    names = [f"k{i}" for i in range(len(keep))]
    kept_names = df.select(*keep).columns
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = df.select(*[c.alias(n) for c, n in zip(keep, names, strict=True)], whole.alias("t"))
    out = out.select(*names, "t", F.regexp_extract_all("t", F.lit(f"[^{BLANK}]+"), F.lit(0)).alias("w"),
                     F.filter(F.split("t", "\n", -1), lambda x: x.rlike(f"[^{BLANK}]")).alias("l"))
    windows = F.when(F.size("w") >= 3, F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.concat_ws(
        " ", F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))))
    out = out.select(
        *names, F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.size("l").cast("long").alias("n_lines_with_words"), windows.alias("x"))
    sort = F.when(F.size("x") > F.size(F.array_distinct("x")), F.sort_array(F.transform("x", lambda w, i: F.struct(w.alias("w"), i.alias("i")))))
    out = out.withColumn("s", sort).drop("x")
    # a window that equals its neighbour in the sorted list occurs twice
    twice = F.filter(F.transform("s", lambda x, j: F.when(
        x["w"].eqNullSafe(F.get("s", j - 1)["w"]) | x["w"].eqNullSafe(F.get("s", j + 1)["w"]), x["i"])), lambda i: i.isNotNull())
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda i: F.array(i, i + 1, i + 2)))))
    out = out.withColumn("n_repeat_words", F.when(F.col("s").isNotNull(), covered).otherwise(0).cast("long"))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, kept_names, strict=True)], *COUNTS)


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def most_rejections(n: Column, risk: float, doubt: Column) -> Column:
    """The greatest k with P(Bin(n, risk) <= k) <= doubt; -1 if there is none. A fold over n * risk terms in logarithms."""
    odds = F.log(F.lit(risk / (1 - risk)))
    start = F.struct((n * F.log(F.lit(1 - risk))).alias("log"), F.lit(0.0).alias("below"), F.lit(-1).cast("long").alias("k"))

    def term(state: Column, i: Column) -> Column:
        below = state["below"] + F.exp(state["log"])
        return F.struct((state["log"] + odds + F.log((n - i).cast("double") / (i + 1))).alias("log"), below.alias("below"),
                        F.when(below <= doubt, i).otherwise(state["k"]).alias("k"))

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.floor(n * risk)), start, term, lambda s: s["k"])


def certified(rows: DataFrame, false_rejection: float, error: float, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(stratum, rule, cutoff): the place of the cutoff to use; pairs without one are left out.

    ``rows`` has stratum, good (boolean) and rejected_from, an array with a place for each rule.
    """
    each = rows.select("stratum", "good", F.posexplode("rejected_from").alias("rule", "at"))
    tally = stored(each.groupBy("stratum", "rule", "at")
                   .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")), "tally")
    group = Window.partitionBy("stratum", "rule")      # at most one row for each cutoff
    tests = max(1, tally.select("stratum").distinct().count()) * len(rules)
    so_far = (tally.withColumn("n_good", F.sum("good").over(group)).withColumn("n_bad", F.sum("bad").over(group))
              .withColumn("k_good", F.sum("good").over(group.orderBy("at"))).withColumn("k_bad", F.sum("bad").over(group.orderBy("at"))))
    limit = most_rejections(F.col("n_good"), false_rejection / len(rules), F.lit(error / tests))
    sizes = F.element_at(F.array(*[F.lit(len(r.cutoffs)) for r in rules]), F.col("rule") + 1)
    gain = F.col("k_bad") * F.col("n_good") - F.col("k_good") * F.col("n_bad")
    # places without rows equal the next more lenient one, so they are never needed
    return (so_far.withColumn("most", limit).withColumn("gain", gain)
            .filter((F.col("at") < sizes) & (F.col("k_good") <= F.col("most")) & (F.col("gain") > 0))
            .groupBy("stratum", "rule").agg(F.max_by("at", F.struct("gain", (-F.col("at")).alias("lenient"))).cast("int").alias("cutoff")))


def judged(df: DataFrame, labels: DataFrame, false_rejection: float = 0.02, error: float = 0.05, stratum: str = "lang",
           text: str = "text", doc_id: str = "doc_id", label: str = "quality", rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, stratum, ``COUNTS``, base_failed, failed (names of the rules that reject the row) and kept.

    ``labels`` has doc_id and a label, 1 for good rows and 0 for bad ones; only rows that pass the base checks are learned from.
    """
    rows = counted(df, text, F.col(doc_id).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"))
    rows = stored(rows.withColumn("base_failed", base_failed())
                  .withColumn("rejected_from", F.array(*[r.rejected_from() for r in rules])), "counts")
    known = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
             .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1)).groupBy("id").agg((F.max("label") == 1).alias("good")))
    learned = rows.filter("not base_failed").join(known, F.col("doc_id") == F.col("id"))
    chosen = certified(learned, false_rejection, error, rules)
    # one row for each stratum, stored: its size is known, and Spark broadcasts it only below its threshold
    cutoffs = stored(chosen.groupBy(F.coalesce("stratum", F.lit("")).alias("of"), F.col("stratum").isNull().alias("none"))
                     .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")), "cutoffs")
    joined = rows.join(cutoffs, (F.coalesce("stratum", F.lit("")) == F.col("of")) & (F.col("stratum").isNull() == F.col("none")), "left")
    names = F.array(*[F.lit(r.name) for r in rules])
    failed = F.filter(F.transform("rejected_from", lambda at, i: F.when(at <= F.element_at("cutoffs", i), F.get(names, i))),
                      lambda x: x.isNotNull())
    return (joined.withColumn("failed", F.when(F.col("cutoffs").isNull(), F.array().cast("array<string>")).otherwise(failed))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
            .select("doc_id", "stratum", *COUNTS, "base_failed", "failed", "kept"))
