"""Quality rules: text statistics, and an ordered list of rejecting rules learned from labels.

A rule is a conjunction of thresholds on statistics. Rules are learned one after the other on the
labelled documents that no earlier rule covers: a rule grows on two thirds of them by the condition
of the highest information gain, is pruned on the other third to the prefix that separates best,
and enters the list when it is precise enough there; learning ends with the first that is not. Each
step needs one grouped count per statistic and threshold, and only those leave the executors.

The list becomes one Spark conditional expression. Only built-in functions are used.

Defined results: a null or empty text has no words and fails the base rule; without labels, or with
labels of one class, the list is empty; labels with a null id or quality are ignored, and of several
labels of a document the lowest counts; beyond `MOST_LABELLED` labelled documents a sample by hash
is learned from; rows that repeat a document are judged each; other columns
do not matter.
"""

from dataclasses import dataclass
from math import log2

from pyspark.sql import functions as F

from pagetide.llm.expressions import BLANK, NOT_BLANK, bound, words
from pagetide.llm.tables import stored

WINDOW = 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_chars_all", "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_marks")
# Thresholds tried per statistic: so many quantiles of the labelled documents.
THRESHOLDS = 32
# Rules are fitted on at most so many labelled documents, the first by a hash of their ids.
MOST_LABELLED = 500_000
# What a rule has to reach on the documents it was not grown on.
PRECISION = 0.98
SUPPORT = 3
# Every third labelled document, by a hash, prunes.
FOLDS = 3


def _repeat_words(hashes):
    """Words inside windows found twice or more. Windows are compared by 64-bit hashes."""
    windows = F.transform(
        F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
        lambda at: F.xxhash64(F.slice(hashes, at, F.lit(WINDOW))),
    )

    def covered(sorted_windows):
        def start(one, at):
            twin = (one["hash"] == F.get(sorted_windows, at + 1)["hash"]) | (
                one["hash"] == F.get(sorted_windows, at - 1)["hash"]
            )
            return F.when(twin, one["start"])

        starts = F.array_sort(F.array_compact(F.transform(sorted_windows, start)))
        # Each start covers up to the next one, a window at most.
        return bound(
            starts,
            lambda known: F.aggregate(
                F.transform(
                    known,
                    lambda one, at: F.least(
                        F.lit(WINDOW), F.coalesce(F.get(known, at + 1) - one, F.lit(WINDOW))
                    ),
                ),
                F.lit(0),
                lambda total, part: total + part,
            ),
        )

    def count(found):
        with_starts = F.transform(
            found, lambda one, at: F.struct(one.alias("hash"), at.alias("start"))
        )
        repeated = bound(F.sort_array(with_starts), covered)
        # Most texts repeat nothing and need no sorting.
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(repeated)

    return F.when(F.size(hashes) < WINDOW, 0).otherwise(bound(windows, count))


def _word_counts(found):
    hashes = F.transform(found, lambda word: F.xxhash64(word))

    def counts(known):
        return F.struct(
            F.size(known).cast("bigint").alias("n_words"),
            _repeat_words(known).cast("bigint").alias("n_repeat_words"),
            F.size(F.array_distinct(known)).cast("bigint").alias("n_distinct_words"),
        )

    return bound(hashes, counts)


def _line_counts(text):
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(NOT_BLANK))
    return bound(
        lines,
        lambda known: F.struct(
            F.size(known).cast("bigint").alias("n_lines"),
            (F.size(known) - F.size(F.array_distinct(known))).cast("bigint").alias("n_dup_lines"),
        ),
    )


def statistics(text):
    """A struct of counts of a text column."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("bigint")
    return F.struct(
        _word_counts(words(text)).alias("by_word"),
        _line_counts(text).alias("by_line"),
        F.char_length(F.regexp_replace(text, f"{BLANK}+", "")).cast("bigint").alias("word_chars"),
        count("[#*$%&|<>]").alias("n_symbols"),
        F.char_length(text).cast("bigint").alias("n_chars_all"),
        count("[A-Z]").alias("n_upper"),
        count("[0-9]").alias("n_digits"),
        count("[!?]").alias("n_marks"),
    )


def with_statistics(docs):
    """The documents with their counts, worked out once each."""
    rows = docs.withColumn("_counts", F.explode(F.array(statistics(F.col("text")))))
    counts = F.col("_counts")
    found = {
        name: counts["by_word"][name]
        if name in ("n_words", "n_repeat_words", "n_distinct_words")
        else counts["by_line"][name]
        if name in ("n_lines", "n_dup_lines")
        else counts[name]
        for name in (*BASE, *EXTRA)
    }
    return rows.withColumns(found).drop("_counts")


def _share(count, total):
    return F.col(count) / F.greatest(F.col(total), F.lit(1))


def measures():
    """What rules compare: numbers that do not depend on a text's length, and the length."""
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word_chars": _share("word_chars", "n_words"),
        "symbols_per_word": _share("n_symbols", "n_words"),
        "marks_per_word": _share("n_marks", "n_words"),
        "distinct_word_share": _share("n_distinct_words", "n_words"),
        "repeat_word_share": _share("n_repeat_words", "n_words"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "upper_share": _share("n_upper", "n_chars_all"),
        "digit_share": _share("n_digits", "n_chars_all"),
        "words_per_line": _share("n_words", "n_lines"),
    }


def base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def expression(self, known):
        value = known[self.measure]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self):
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple

    def expression(self, known):
        result = F.lit(True)
        for condition in self.conditions:
            result = result & condition.expression(known)
        return result

    def __str__(self):
        return " and ".join(map(str, self.conditions))


def rejecting_rule(rules, known=None):
    """The first rule of the list that holds, as text; null where none does."""
    known = known or measures()
    result = F.lit(None).cast("string")
    for rule in reversed(rules):
        result = F.when(rule.expression(known), F.lit(str(rule))).otherwise(result)
    return result


# Learning.


def _gain(bad, good, all_bad, all_good):
    """Information gained about the bad documents by a condition; zero when it covers none."""
    if not bad:
        return 0.0
    return bad * (log2(bad / (bad + good)) - log2(all_bad / (all_bad + all_good)))


def _thresholds(rows, names):
    shares = [at / THRESHOLDS for at in range(THRESHOLDS)]
    found = rows.agg(*[F.percentile_approx(name, shares, 10_000).alias(name) for name in names])
    row = found.first()
    return {name: sorted(set(row[name] or [])) for name in names}


def _best_condition(rows, thresholds, used):
    """The condition of the highest gain, from one grouped count over all measures."""
    names = list(thresholds)
    bins = [
        F.struct(
            F.lit(name).alias("measure"),
            F.size(
                F.filter(
                    F.array(*[F.lit(float(limit)) for limit in thresholds[name]]),
                    lambda limit: limit < F.col(name),
                )
            ).alias("bin"),
        )
        for name in names
    ]
    counts = (
        rows.select("bad", F.inline(F.array(*bins)))
        .groupBy("measure", "bin")
        .agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("all"))
        .collect()
    )
    best = (0.0, None)
    for name in names:
        found = {row.bin: (row.bad, row["all"] - row.bad) for row in counts if row.measure == name}
        all_bad = sum(bad for bad, _ in found.values())
        all_good = sum(good for _, good in found.values())
        below_bad = below_good = 0
        for at, limit in enumerate(thresholds[name]):
            bad, good = found.get(at, (0, 0))
            below_bad, below_good = below_bad + bad, below_good + good
            for above, covered in (
                (False, (below_bad, below_good)),
                (True, (all_bad - below_bad, all_good - below_good)),
            ):
                condition = Condition(name, above, float(limit))
                gain = _gain(*covered, all_bad, all_good)
                if condition not in used and gain > best[0]:
                    best = (gain, condition)
    return best[1]


def _columns(names):
    return {name: F.col(name) for name in names}


def _grow(rows, thresholds):
    known, conditions = _columns(thresholds), []
    while True:
        covered = rows.filter(Rule(tuple(conditions)).expression(known))
        totals = covered.agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("all")).first()
        if not totals.bad or totals.bad == totals["all"]:
            break
        condition = _best_condition(covered, thresholds, conditions)
        if condition is None:
            break
        conditions.append(condition)
    return conditions


def _prune(rows, conditions, known):
    """The prefix that separates best on rows it was not grown on, with its two counts there."""
    prefixes = [Rule(tuple(conditions[:length])) for length in range(1, len(conditions) + 1)]
    sums = []
    for at, rule in enumerate(prefixes):
        held = rule.expression(known).cast("int")
        sums += [F.sum(held * F.col("bad")).alias(f"bad{at}"), F.sum(held).alias(f"all{at}")]
    row = rows.agg(*sums).first()
    scored = []
    for at, rule in enumerate(prefixes):
        bad, total = row[f"bad{at}"] or 0, row[f"all{at}"] or 0
        scored.append(((2 * bad - total) / total if total else -1.0, -at, rule, bad, total))
    _, _, rule, bad, total = max(scored, key=lambda one: one[:2])
    return rule, bad, total


def learn(labelled, names=None):
    """Rules from rows of measures and `bad`, 1 for a document to reject and 0 for one to keep."""
    names = list(names or measures())
    rows = stored(
        labelled.select(
            *names, F.col("bad").cast("int").alias("bad"),
            (F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0).alias("prunes"),
        ),
        "labelled",
    )
    known, rules = _columns(names), []
    while True:
        left = rows
        for rule in rules:
            left = left.filter(~rule.expression(known))
        growing, pruning = left.filter(~F.col("prunes")), left.filter("prunes")
        thresholds = _thresholds(growing, names)
        conditions = _grow(growing, thresholds) if all(thresholds.values()) else []
        if not conditions:
            break
        rule, bad, total = _prune(pruning, conditions, known)
        if bad < SUPPORT or bad < PRECISION * total:
            break
        rules.append(rule)
    return rules


def chosen_labels(labels, most=MOST_LABELLED):
    """`doc_id` and `bad` of at most `most` labelled documents; a document is bad by any label."""
    quality = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
        .dropna()
        .groupBy("doc_id")
        .agg((F.min("quality") == 0).cast("int").alias("bad"))
    )
    return stored(quality.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "chosen-labels")


def labelled_rows(with_counts, chosen):
    """Measures of the labelled documents that pass the base rule; the others need no more rules."""
    values = [value.alias(name) for name, value in measures().items()]
    passed = with_counts.filter(~base_failed())
    # A bounded number of ids, so they are brought to the documents.
    return passed.select("doc_id", *values).join(F.broadcast(chosen), "doc_id")


def counted(docs):
    """`doc_id` and the counts of each document, kept so that texts are read once."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stored(with_statistics(rows).drop("text"), "text-statistics")


def judged(docs, labels):
    """Per document: its counts, the base rule, the learned rule that rejects it, and `kept`."""
    rows = counted(docs)
    rules = learn(labelled_rows(rows, chosen_labels(labels)))
    rule = rejecting_rule(rules)
    return rows.withColumns(
        {"base_failed": base_failed(), "rejected_by": rule}
    ).withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())


def kept_documents(docs, labels):
    """The documents that pass, with their own columns.

    Labelled documents are counted first, to learn from; then all are, to judge them. Texts are
    read twice and never shuffled.
    """
    chosen = chosen_labels(labels)
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = known.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    rules = learn(labelled_rows(counted(known), chosen))
    rows = docs.select(F.struct("*").alias("_row"), "text")
    passes = ~base_failed() & rejecting_rule(rules).isNull()
    return with_statistics(rows).filter(passes).select("_row.*")
