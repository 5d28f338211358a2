"""Quality rules: a decision list learned by sequential covering, in built-in functions only.

Each text is reduced to counts in one narrow pass. A rule is a conjunction of thresholds on shares
of these counts; it is grown on labelled rows, literal by literal, by information gain for the bad
label, and pruned on rows it has not seen. Rows it covers leave, and the next rule is grown. The
driver only sees counts per feature, bin and label: a fixed number of rows, whatever the input.
The list becomes one conditional expression.

Edge cases: a null text has no words, so it fails the base check, as an empty one does. Labels
that are null, repeated or without a document don't disturb learning (a document with several
labels counts once for each); without labels there are no rules and the base check decides alone.
Repeated rows get equal results. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.scratch import written

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS, MARKS, UPPER = r"[#*$%&|<>]", "[!?]", r"\p{Lu}"
FEATURES = ("symbol_share", "repeat_share", "upper_share", "mark_share", "dup_line_share",
            "mean_word_chars")
LEVELS = [k / 100 for k in range(101)]  # quantiles of bad and of good rows between thresholds


def let(value: Column, body) -> Column:
    """`body` over `value`, which is evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in a three-word window that occurs twice or more.

    Most texts repeat no window, which hashes prove. In the others equal windows stand side by
    side once sorted, and the covered words follow from the gaps between their positions.
    """
    hashes = F.slice(F.transform(words, lambda x, i: F.xxhash64(
        x, F.get(words, i + 1), F.get(words, i + 2))), 1, F.greatest(F.size(words) - 2, F.lit(0)))

    def covered(ordered: Column) -> Column:
        repeated = F.filter(ordered, lambda s, k: (
            s["h"] == F.get(ordered, k - 1)["h"]) | (s["h"] == F.get(ordered, k + 1)["h"]))
        windows = F.array_sort(F.transform(repeated, lambda s: F.struct(
            F.concat_ws(" ", words[s["i"]], words[s["i"] + 1], words[s["i"] + 2]).alias("w"),
            s["i"].alias("i"))))
        return let(windows, lambda w: let(
            F.array_sort(F.transform(F.filter(w, lambda s, k: (
                s["w"] == F.get(w, k - 1)["w"]) | (s["w"] == F.get(w, k + 1)["w"])),
                lambda s: s["i"])),
            lambda at: F.aggregate(
                F.transform(at, lambda p, k: F.least(
                    F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))),
                F.lit(0), lambda a, x: a + x)))

    return let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(
            F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
            covered)))


def text_counts(text: Column) -> Column:
    """Struct of the counts of a text: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_upper, n_marks."""
    text = F.coalesce(text.cast("string"), F.lit(""))

    def of(t: Column) -> Column:
        trimmed = F.btrim(t, F.lit(WHITE))
        words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
            F.split(trimmed, "[ \\t-\\r]+"))
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")

        def count(pattern: str) -> Column:
            return F.regexp_count(t, F.lit(pattern)).cast("bigint")

        return let(words, lambda w: let(lines, lambda x: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.regexp_replace(t, "[ \\t-\\r]+", "")).cast("bigint").alias("word_chars"),
            count(SYMBOLS).alias("n_symbols"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(w).cast("bigint").alias("n_repeat_words"),
            F.size(x).cast("bigint").alias("n_lines"),
            count(UPPER).alias("n_upper"), count(MARKS).alias("n_marks"))))

    return let(text, of)


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def features(c: Column) -> dict[str, Column]:
    """What rules test; 0 where the share has no base."""
    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(c[part], c[whole]), F.lit(0.0))
    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "mark_share": share("n_marks", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "mean_word_chars": share("word_chars", "n_words"),
    }


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def test(self, values: dict[str, Column]) -> Column:
        value, at = values[self.feature], F.lit(self.threshold)
        return value > at if self.above else value <= at

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order; a text is rejected by the first whose literals all hold."""

    rules: list[tuple[Literal, ...]] = field(default_factory=list)

    def rule_number(self, values: dict[str, Column]) -> Column:
        """The number, from 1, of the first rule that holds, else 0."""
        out = None
        for number, rule in enumerate(self.rules, 1):
            holds = all_of(rule, values)
            out = F.when(holds, number) if out is None else out.when(holds, number)
        return F.lit(0) if out is None else out.otherwise(0)

    def __str__(self) -> str:
        return "; ".join(" and ".join(map(str, r)) for r in self.rules) or "no rule"


def all_of(rule: tuple[Literal, ...], values: dict[str, Column]) -> Column:
    holds = F.lit(True)
    for literal in rule:
        holds = holds & literal.test(values)
    return holds


def halfway(quantiles: list[float]) -> list[float]:
    """Thresholds between the quantiles, away from the values themselves."""
    steps = sorted(set(quantiles))
    return [(a + b) / 2 for a, b in zip(steps, steps[1:], strict=False)]


def _bin(feature: str, cuts: list[float]) -> Column:
    """How many of the ascending `cuts` the value exceeds, by halving."""
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    listed = ", ".join(f"double('{c!r}')" for c in cuts)
    return F.expr(
        f"aggregate(array({', '.join(map(str, steps))}), 0, (at, step) -> if("
        f"at + step <= {len(cuts)} and {feature} > get(array({listed}), at + step - 1), "
        "at + step, at))" if cuts else "0")


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    """Information that a literal adds about the bad rows it still covers."""
    if not after[0]:
        return 0.0
    return after[0] * (log2(after[0] / sum(after)) - log2(before[0] / sum(before)))


def learn(labelled: DataFrame, max_rules: int = 8, max_literals: int = 3,
          precision: float = 0.75, support: int = 5) -> DecisionList:
    """A decision list from rows of `FEATURES`, bad (boolean) and prune (boolean).

    A rule stays if, on rows kept for pruning, at least `support` are covered and `precision`
    of them are bad. A literal is chosen by two aggregates over the rows that earlier rules left and
    the growing rule covers: quantiles of its bad and good rows apart, so that a rare class has
    thresholds among its own values, then counts between the thresholds.
    """
    values = {f: F.col(f) for f in FEATURES}
    grown, left = DecisionList(), labelled
    while len(grown.rules) < max_rules:
        rule: tuple[Literal, ...] = ()
        while len(rule) < max_literals:
            covers = left.where(~F.col("prune") & all_of(rule, values))
            steps = covers.groupBy("bad").agg(*[
                F.percentile_approx(f, LEVELS, 10_000).alias(f) for f in FEATURES]).collect()
            if not any(r["bad"] for r in steps):
                break
            cuts = {f: halfway([x for r in steps for x in r[f] or []]) for f in FEATURES}
            bins = F.explode(F.array(*[F.struct(
                F.lit(f).alias("feature"), _bin(f, cuts[f]).alias("bin")) for f in FEATURES]))
            counts = covers.select("bad", bins).groupBy("col.feature", "col.bin").agg(
                F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()
            best, best_gain, before = None, 0.0, (0, 0)
            for f in FEATURES:
                by_bin = {r["bin"]: (r["bad"], r["good"]) for r in counts if r["feature"] == f}
                before = tuple(sum(x[k] for x in by_bin.values()) for k in (0, 1))
                if not before[0]:
                    break
                for k, threshold in enumerate(cuts[f]):
                    above = tuple(sum(x[j] for b, x in by_bin.items() if b > k) for j in (0, 1))
                    below = (before[0] - above[0], before[1] - above[1])
                    for covered, side in ((above, True), (below, False)):
                        gain = _gain(before, covered)
                        if gain > best_gain + 1e-9:
                            best, best_gain = Literal(f, side, threshold), gain
            if best is None:
                break
            rule += (best,)
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        if not prefixes:
            break
        seen = left.where("prune").agg(*[
            F.count_if(all_of(p, values) & (F.col("bad") == bad)).alias(f"{k}_{bad}")
            for k, p in enumerate(prefixes) for bad in (True, False)]).first()
        kept, worth = None, -1.0
        for k, prefix in enumerate(prefixes):
            bad, good = seen[f"{k}_True"], seen[f"{k}_False"]
            value = (bad - good) / (bad + good) if bad + good else -1.0
            if bad + good >= support and bad >= precision * (bad + good) and value > worth:
                kept, worth = prefix, value
        if kept is None:
            break
        grown.rules.append(kept)
        left = left.where(~all_of(kept, values))
    return grown


def learned(table: DataFrame, labels: DataFrame) -> DecisionList:
    """The rules learned from the rows of `table` (doc_id, base_failed, FEATURES) with a quality
    label."""
    known = labels.where("doc_id is not null and quality is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("quality") == 0).alias("bad"),
        (F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(3)) == 0).alias("prune"))
    # rows that the base check rejects anyway need no rule
    labelled = written(table.where("not base_failed").select("doc_id", *FEATURES).join(
        known, "doc_id").select(*FEATURES, "bad", "prune"), "quality-labelled")
    return learn(labelled)


def measured(counted: DataFrame, counts: str) -> DataFrame:
    """doc_id, the features and base_failed of rows that carry their counts."""
    c = F.col(counts)
    return counted.select(F.col("doc_id").cast("bigint").alias("doc_id"), c.alias("c"),
                          *[v.alias(f) for f, v in features(c).items()],
                          base_failed(c).alias("base_failed"))


def scored(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DecisionList]:
    """The counts and features of all documents, written once, and the rules learned from
    those with a quality label."""
    table = written(measured(docs.select("doc_id", text_counts(F.col("text")).alias("c")), "c"),
                    "quality-counts")
    return table, learned(table, labels)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept, and the number of the rule
    that rejects it (0: none)."""
    table, rules = scored(docs, labels)
    number = rules.rule_number({f: F.col(f) for f in FEATURES})
    return table.select(
        "doc_id", *[F.col(f"c.{n}").alias(n) for n in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed", (~F.col("base_failed") & (number == 0)).alias("kept"),
        number.cast("int").alias("rule"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without those the base check or a rule rejects; all columns stay as they are.

    Each text is counted once: documents and counts are written together.
    """
    own = "__quality_counts"
    while own.lower() in map(str.lower, docs.columns):
        own += "_"
    counted = written(docs.withColumn(own, text_counts(F.col("text"))), "quality-documents")
    rules = learned(measured(counted, own), labels)
    number = rules.rule_number(features(F.col(own)))
    return counted.where(~base_failed(F.col(own)) & (number == 0)).drop(own)
