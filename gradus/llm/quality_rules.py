"""Quality rules with risk-controlled thresholds.

A rule rejects a document whose share of something (in thousandths) is above a cut-off.
Cut-offs are chosen per stratum on labelled documents that were held out for it: a cut-off
is certified when the exact binomial (Clopper-Pearson) upper bound of its false rejection,
at the corrected level, is within the rule's part of ``RISK``.  Cut-offs of one rule are
tested from the loosest on and end at the first failure, which needs no correction;
over rules and strata the level is divided (Bonferroni).  With probability ``1 - DELTA`` all
certified cut-offs hold at once, so that one may be picked freely among them: the one that
rejects the largest share of bad documents less the share of good ones, the loosest of equals.

That choice is made for each rule by itself.  Where documents are dropped for good (``accepted``),
rules are chosen in turn instead: of the certified cut-offs of all rules left, the one that
rejects most bad documents that no chosen rule rejects yet, less ``WORTH`` times the good
ones, as long as that is above 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradus.llm.columns import SPACE, let, packed, text_of, words
from gradus.sources.tables import materialise

#: Good documents of a stratum that the rules together may reject, and the chance of being wrong about it.
RISK = 0.12
DELTA = 0.05
#: Bad documents that a rule chosen in turn must newly reject for each good one.
WORTH = 2
#: Rules: numerator and denominator of the share.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5


def repeated_words(ws: Column, width: int = WINDOW) -> Column:
    """Words of the array that lie in a window of ``width`` words found twice or more in it.

    Hashed windows that are all distinct settle most texts.  In the others the windows
    themselves are sorted, those with an equal neighbour are put back in order, and each
    adds the words up to the next one.
    """
    places = F.sequence(F.lit(1), F.size(ws) - (width - 1))
    hashed = F.transform(places, lambda i: F.xxhash64(*[F.element_at(ws, i + j) for j in range(width)]))
    windows = F.sort_array(F.transform(places, lambda i: F.struct(F.concat_ws(" ", F.slice(ws, i, width)).alias("g"), i.alias("p"))))

    def twice(w: Column) -> Column:
        def beside(i: Column) -> Column:
            here = F.element_at(w, i)["g"]
            before = F.when(i > 1, F.element_at(w, F.greatest(i - 1, F.lit(1)))["g"] == here).otherwise(False)
            after = F.when(i < F.size(w), F.element_at(w, F.least(i + 1, F.size(w)))["g"] == here).otherwise(False)
            return before | after

        kept = F.filter(F.sequence(F.lit(1), F.size(w)), beside)
        return F.sort_array(F.transform(kept, lambda i: F.element_at(w, i)["p"]))

    def covered(at: Column) -> Column:
        def step(total: Column, i: Column) -> Column:
            following = F.when(i < F.size(at), F.element_at(at, F.least(i + 1, F.size(at))) - F.element_at(at, i)).otherwise(F.lit(width))
            return total + F.least(F.lit(width), following)

        return F.when(F.size(at) == 0, F.lit(0)).otherwise(F.aggregate(F.sequence(F.lit(1), F.size(at)), F.lit(0), step))

    slow = let(windows, lambda w: let(twice(w), covered))
    found = let(hashed, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(ws) < width, F.lit(0)).when(found, slow).otherwise(F.lit(0)).cast("long")


def measures(text: Column) -> Column:
    """Struct of the counts that base and rules need, from a text that isn't null."""
    with_word = F.filter(F.split(text, "\n", -1), lambda line: F.trim(line, F.lit(" \t\n\x0b\f\r")) != "")
    lines = let(with_word, lambda a: F.struct(F.size(a).cast("long").alias("all"), F.size(F.array_distinct(a)).cast("long").alias("distinct")))
    counted = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words"),
    ))
    return F.struct(
        counted.alias("w"), lines.alias("l"),
        F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.char_length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
    )


def measured(docs: DataFrame) -> DataFrame:
    """``row`` (all columns), stratum and the counts of each document, base_failed included."""
    flat = packed(docs).select("row", measures(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("m"))
    return flat.select(
        "row", F.col("m.w.n_words").alias("n_words"), F.col("m.w.word_chars").alias("word_chars"), F.col("m.n_symbols").alias("n_symbols"),
        (F.col("m.l.all") - F.col("m.l.distinct")).alias("n_dup_lines"), F.col("m.w.n_repeat_words").alias("n_repeat_words"),
        F.col("m.n_capitals").alias("n_capitals"), F.col("m.l.all").alias("n_lines"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT))


def share(rule: str) -> Column:
    """The rule's share in thousandths, rounded down; 0 where the denominator is 0."""
    over, under = (F.col(c) for c in RULES[rule])
    return F.when(under > 0, F.expr(f"({RULES[rule][0]} * 1000) div {RULES[rule][1]}")).otherwise(F.lit(0)).cast("long")


def allowed(n: Column, risk: float, level: Column) -> Column:
    """Most of ``n`` that may be rejected for the upper bound to be within ``risk``; -1 if none may be.

    The bound is within ``risk`` just when a binomial of that rate stays at or below the
    count with probability ``level`` at most.  Terms follow each other in logarithms.
    """
    odds = math.log(risk) - math.log1p(-risk)
    steps = F.sequence(F.lit(0).cast("long"), F.ceil(n * F.lit(risk)).cast("long"))
    start = F.struct((n * F.lit(math.log1p(-risk))).alias("term"), F.lit(0.0).alias("mass"), F.lit(-1).cast("long").alias("most"))

    def step(s: Column, i: Column) -> Column:
        mass = s["mass"] + F.exp(s["term"])
        following = s["term"] + F.log((n - i).cast("double") / (i + 1).cast("double")) + F.lit(odds)
        return F.struct(
            F.when(i < n, following).otherwise(s["term"]).alias("term"), mass.alias("mass"),
            F.when(mass <= level, i).otherwise(s["most"]).alias("most"),
        )

    return F.aggregate(steps, start, step, lambda s: s["most"])


def _labelled(found: DataFrame, labels: DataFrame) -> DataFrame:
    """stratum, good and the rules' shares of labelled documents that base does not reject."""
    marks = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("good"))
    return found.where(~F.col("base_failed")).join(marks, "doc_id").select("stratum", "good", *[share(r).alias(f"share_{r}") for r in RULES])


def _lost(labelled: DataFrame) -> DataFrame:
    """Of each stratum and rule, documents in all and above each share as a cut-off."""
    shares = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"share_{r}").alias("v")) for r in RULES])
    cells = (
        labelled.select("stratum", "good", F.explode(shares).alias("s"))
        .groupBy("stratum", "s.rule", "s.v")
        .agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((1 - F.col("good")).cast("long")).alias("bad"))
    )
    group = Window.partitionBy("stratum", "rule")
    above = group.orderBy(F.col("v").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return cells.select(
        "stratum", "rule", "v",
        F.sum("good").over(group).alias("n_good"), F.sum("bad").over(group).alias("n_bad"),
        F.coalesce(F.sum("good").over(above), F.lit(0)).alias("good_lost"), F.coalesce(F.sum("bad").over(above), F.lit(0)).alias("bad_lost"),
    )


def _tried(labelled: DataFrame, risk: float, delta: float) -> tuple[DataFrame, DataFrame]:
    """What each cut-off loses, and the good documents that a rule may lose per stratum."""
    tried = _lost(labelled)
    sizes = tried.groupBy("stratum").agg(F.max("n_good").alias("n_good"))
    strata = sizes.agg(F.count(F.lit(1)).alias("strata"))
    part = risk / len(RULES)
    level = F.lit(delta) / (F.col("strata") * F.lit(len(RULES)))
    quota = sizes.join(F.broadcast(strata)).select(F.col("stratum").alias("q_stratum"), allowed(F.col("n_good"), part, level).alias("quota"))
    return tried, quota


def cutoffs(found: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """stratum and one column ``cut_<rule>`` each, null where no cut-off is certified or of use.

    ``found`` has doc_id, stratum, base_failed and the counts.  Rows that base rejects are left
    out, as are labels other than 0 and 1; of several labels of one id the lower counts.
    """
    tried, quota = _tried(_labelled(found, labels), risk, delta)
    gain = F.col("bad_lost") * F.col("n_good") - F.col("good_lost") * F.col("n_bad")
    certified = tried.join(quota, F.col("stratum").eqNullSafe(F.col("q_stratum"))).where((F.col("good_lost") <= F.col("quota")) & (gain > 0))
    best = certified.groupBy("stratum", "rule").agg(F.max(F.struct(gain.alias("gain"), F.col("v").alias("cut"))).alias("best"))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("best.cut"))).alias(f"cut_{r}") for r in RULES])


def cutoffs_in_turn(found: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Like ``cutoffs``, with each rule chosen for what it adds to the ones before it."""
    labelled = materialise(_labelled(found, labels))
    tried, quota = _tried(labelled, risk, delta)
    certified = tried.join(quota, F.col("stratum").eqNullSafe(F.col("q_stratum"))).where(F.col("good_lost") <= F.col("quota"))
    # What is lost only falls with the cut-off, so all from this one on are certified.
    least = materialise(certified.groupBy(F.col("stratum").alias("l_stratum"), F.col("rule").alias("l_rule")).agg(F.min("v").alias("least")))
    chosen = []
    for _ in RULES:
        left = labelled
        for cut in chosen:
            rejects = F.lit(False)
            for rule in RULES:
                rejects = rejects | ((F.col("c_rule") == rule) & (F.col(f"share_{rule}") > F.col("c_cut")))
            left = left.join(cut, F.col("stratum").eqNullSafe(F.col("c_stratum")), "left").where(~F.coalesce(rejects, F.lit(False))).select(*labelled.columns)
        worth = F.col("bad_lost") - WORTH * F.col("good_lost")
        open_ = _lost(left).join(least, F.col("stratum").eqNullSafe(F.col("l_stratum")) & (F.col("rule") == F.col("l_rule"))).where((F.col("v") >= F.col("least")) & (worth > 0))
        best = open_.groupBy("stratum").agg(F.max(F.struct(worth.alias("worth"), F.col("v").alias("cut"), F.col("rule").alias("rule"))).alias("best"))
        chosen.append(materialise(best.select(F.col("stratum").alias("c_stratum"), F.col("best.rule").alias("c_rule"), F.col("best.cut").alias("c_cut"))))
    together = chosen[0]
    for cut in chosen[1:]:
        together = together.unionByName(cut)
    return together.groupBy(F.col("c_stratum").alias("stratum")).agg(*[F.min(F.when(F.col("c_rule") == r, F.col("c_cut"))).alias(f"cut_{r}") for r in RULES])


def judge(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None, stratum: str = "lang", risk: float = RISK, delta: float = DELTA, in_turn: bool = False) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``, or all), the counts, base_failed and kept.

    A null or empty text has no words and fails base.  Null is a stratum of its own; one with
    too few labels to certify anything loses nothing beyond base.  Rows that repeat a doc_id are
    judged each by its own text.  Documents are measured once, into a written table.
    """
    kept_columns = docs.columns if carry is None else carry
    found = measured(docs).select(
        F.struct(*[F.col("row")[c].alias(c) for c in kept_columns]).alias("row"), F.col("row.doc_id").alias("doc_id"),
        F.col("row")[stratum].cast("string").alias("stratum"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_lines", "base_failed",
    )
    found = materialise(found)
    choose = cutoffs_in_turn if in_turn else cutoffs
    cuts = materialise(choose(found.drop("row"), labels, risk, delta)).withColumnRenamed("stratum", "c_stratum")
    passed = F.lit(True)
    for rule in RULES:
        passed = passed & (F.col(f"cut_{rule}").isNull() | (share(rule) <= F.col(f"cut_{rule}")))
    return found.join(cuts, F.col("stratum").eqNullSafe(F.col("c_stratum")), "left").select(
        "row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & passed).alias("kept"),
    )


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows of ``docs``, all columns, that the rules keep; rules are chosen in turn."""
    return judge(docs, labels, **{"in_turn": True, **options}).where("kept").select("row.*")
