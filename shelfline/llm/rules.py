"""Quality rules: text statistics in Spark expressions, and decision lists learned from labelled rows.

``learn`` is sequential covering. A rule is a conjunction of thresholds; it grows by the condition of highest gain on two
thirds of the rows, is pruned on the last third, and the rows it covers are set aside for the next rule. Every step
is one grouped count over binned values, so what the driver sees is a table of features by bins. The rules come out as
one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.plans.staging import Stage, WrittenTables

BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[ \t-\r]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: labelled rows that rules are learned from, at most: those of smallest hash of doc_id
TRAIN_ROWS = 20_000
BINS, MAX_RULES, MAX_CONDITIONS, MIN_COVER, MIN_PRECISION = 48, 12, 4, 5, 0.9
FEATURES = ["n_words", "mean_word", "symbol_share", "mark_share", "capital_share", "digit_share", "dup_line_share",
            "repeat_share", "distinct_share", "line_words"]


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the shares in FEATURES.

    Columns of these names are replaced. Words are cut at ASCII blanks. word_chars counts the characters in words,
    n_symbols those of ``#*$%&|<>``, n_dup_lines the lines with a word that equal an earlier line, n_repeat_words the
    words in windows of five that occur twice or more in the text. Null and empty texts have zeros throughout.
    Window repeats are found by 64-bit hashes within one text; only texts that have any are sorted.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = docs.withColumn("_t", whole)
    trimmed = F.btrim("_t", F.lit(BLANKS))
    out = out.withColumn("_w", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_CLASS + "+")))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    out = out.withColumn("_lines", lines)
    n = F.size("_w")
    hashes = F.transform("_w", lambda x: F.xxhash64(x))
    out = out.withColumn("_h", hashes)
    out = out.withColumn("_h2", F.zip_with("_h", F.slice("_h", 2, n), lambda a, b: F.xxhash64(a, b)))
    out = out.withColumn("_h4", F.zip_with("_h2", F.slice("_h2", 3, n), lambda a, b: F.xxhash64(a, b)))
    out = out.withColumn("_h5", F.slice(F.zip_with("_h4", F.slice("_h", 5, n), lambda a, b: F.xxhash64(a, b)), 1,
                                        F.greatest(n - (WINDOW - 1), F.lit(0))))
    twice = F.size(F.array_distinct("_h5")) < F.size("_h5")
    out = out.withColumn("_s", F.when(twice, F.array_sort(F.transform("_h5", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    same = lambda x, j: F.coalesce(F.get("_s", j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("_s", j + 1)["h"] == x["h"], F.lit(False))
    out = out.withColumn("_at", F.array_sort(F.transform(F.filter("_s", same), lambda x: x["i"])))
    steps = F.transform("_at", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", j + 1), p + WINDOW) - p))
    repeat = F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x), F.lit(0).cast("long"))
    out = out.withColumns({
        "n_words": n.cast("long"), "word_chars": F.length(F.translate("_t", BLANKS, "")).cast("long"),
        "n_symbols": _count_of(F.col("_t"), SYMBOLS), "_marks": _count_of(F.col("_t"), "!?"),
        "_capitals": _count_of(F.col("_t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "_digits": _count_of(F.col("_t"), "0123456789"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"), "n_repeat_words": repeat,
        "_distinct": F.size(F.array_distinct("_w"))})
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), b), F.lit(0.0))
    chars, words, count = F.col("word_chars"), F.col("n_words"), F.size("_lines")
    out = out.withColumns({
        "mean_word": share("word_chars", words), "symbol_share": share("n_symbols", chars), "mark_share": share("_marks", chars),
        "capital_share": share("_capitals", chars), "digit_share": share("_digits", chars),
        "dup_line_share": share("n_dup_lines", count), "repeat_share": share("n_repeat_words", words),
        "distinct_share": share("_distinct", words), "line_words": share("n_words", count)})
    return out.drop("_t", "_w", "_lines", "_h", "_h2", "_h4", "_h5", "_s", "_at", "_marks", "_capitals", "_digits", "_distinct")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def verdict(rules: list[Rule]) -> Column:
    """The decision list: false at the first rule that holds, else true."""
    out = None
    for rule in rules:
        out = F.when(holds(rule), False) if out is None else out.when(holds(rule), False)
    return F.lit(True) if out is None else out.otherwise(True)


def _gain(p: float, n: float, before: float) -> float:
    return p * (math.log2(p / (p + n)) - before) if p else 0.0


def learn(rows: DataFrame, label: str = "bad", features: list[str] = FEATURES, key: str = "doc_id",
          stage: Stage | None = None) -> list[Rule]:
    """Rules for ``label`` = 1 from rows of statistics. Few labelled rows, or none of one kind, give few or no rules.

    Thresholds are quantiles of the growing rows. A rule is taken if it covers MIN_COVER rows it is meant for and is
    right for MIN_PRECISION of the pruning rows it covers; the first that is not ends the list. Values that are null
    count as zero.
    """
    stage = stage or WrittenTables(rows.sparkSession)
    table = rows.where(F.col(label).isNotNull()).select(
        F.pmod(F.xxhash64(F.col(key), F.lit("part")), F.lit(3)).alias("_part"), F.col(label).cast("int").alias("_bad"),
        *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    table = stage(table.repartition(4), "labelled")  # a shuffle of numbers, so the texts are read in parallel
    grow, prune = table.where("_part <> 0"), table.where("_part = 0")
    probes = [i / BINS for i in range(BINS + 1)]
    cuts = {f: sorted(set(q)) for f, q in zip(features, grow.approxQuantile(features, probes, 0.001), strict=True)}
    if not any(cuts.values()):
        return []
    # value bins, so that one grouped count serves all thresholds of all features
    def place(f: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda cut: cut < F.col(f)))

    bins = F.array(*[F.struct(F.lit(f).alias("feature"), place(f).alias("bin")) for f in features])
    grow = stage(grow.withColumn("_bins", bins).coalesce(4), "binned")
    rules: list[Rule] = []
    rest = F.lit(True)
    while len(rules) < MAX_RULES:
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            counts = (grow.where(rest & holds(rule)).select(F.explode("_bins").alias("b"), "_bad").groupBy("b.feature", "b.bin")
                      .agg(F.sum("_bad").alias("p"), F.sum(1 - F.col("_bad")).alias("n")).collect())
            best = _best_condition(counts, cuts)
            if best is None:
                break
            rule += (best[1],)
            if not best[2]:
                break
        if not rule:
            break
        rule, right, wrong, covered = _pruned(prune.where(rest), grow.where(rest), rule)
        if covered < MIN_COVER or right < MIN_PRECISION * (right + wrong) or not right:
            break
        rules.append(rule)
        rest = rest & ~holds(rule)
    return rules


def _best_condition(counts: list, cuts: dict[str, list[float]]) -> tuple[float, Condition, int] | None:
    """(gain, condition, rows it wrongly covers) of the best threshold; ties go to the first by name and threshold."""
    by: dict[str, dict[int, tuple[int, int]]] = {}
    for row in counts:
        by.setdefault(row["feature"], {})[row["bin"]] = (row["p"], row["n"])
    best = None
    for feature in sorted(by):
        found = by[feature]
        p_all, n_all = (sum(x[k] for x in found.values()) for k in (0, 1))
        if not p_all or not n_all:
            continue
        before = math.log2(p_all / (p_all + n_all))
        p_low = n_low = 0
        for k, cut in enumerate(cuts[feature]):
            p, n = found.get(k, (0, 0))
            p_low, n_low = p_low + p, n_low + n
            for above, good, wrong in ((True, p_all - p_low, n_all - n_low), (False, p_low, n_low)):
                gain = _gain(good, wrong, before)
                if good >= MIN_COVER and gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = gain, Condition(feature, above, cut), wrong
    return best


def _pruned(prune: DataFrame, grow: DataFrame, rule: Rule) -> tuple[Rule, int, int, int]:
    """The beginning of ``rule`` that is best on the pruning rows, its right and wrong rows there, and its cover."""
    sums = []
    for k in range(1, len(rule) + 1):
        inside = holds(rule[:k])
        sums += [F.coalesce(F.sum(F.when(inside, F.col("_bad"))), F.lit(0)).alias(f"p{k}"),
                 F.coalesce(F.sum(F.when(inside, 1 - F.col("_bad"))), F.lit(0)).alias(f"n{k}")]
    row = prune.agg(*sums).first()
    worth = [(row[f"p{k}"] - row[f"n{k}"]) / max(1, row[f"p{k}"] + row[f"n{k}"]) for k in range(1, len(rule) + 1)]
    k = worth.index(max(worth)) + 1
    covered = grow.where(holds(rule[:k])).agg(F.coalesce(F.sum("_bad"), F.lit(0))).first()[0]
    return rule[:k], row[f"p{k}"], row[f"n{k}"], covered


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS, stage: Stage | None = None) -> list[Rule]:
    """Rules from docs (doc_id, text) and labels (doc_id, quality 0 or 1); at most ``most`` labelled rows are used."""
    drawn = (labels.where("doc_id is not null and quality is not null").select("doc_id", "quality")
             .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most))
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # at most ``most`` rows of two numbers
    return learn(text_statistics(rows).withColumn("bad", 1 - F.col("quality")), stage=stage)


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``docs`` with its statistics, base_failed (under ten words, or over a fifth of the words in repeats) and kept."""
    out = text_statistics(docs, text)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns.

    The filter also looks at a row number, so that it stays above the statistics: pushed below them it would hold
    all their expressions in one, each as often as it is used.
    """
    judged = judge(docs, rules).withColumn("_at", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("_at") >= 0)).select(docs.columns)
