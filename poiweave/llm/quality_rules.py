"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Native: only SQL functions touch the documents. The driver sees one row per vote pattern (at most
``3 ** len(RULES)``, whatever the input's size) and fits the label model on their counts.

Results in odd cases: a null or empty text has no words and all counts 0 (base rule fails); a null id is judged like any other;
very long texts are measured as a whole; repeated rows are judged alike; an empty table gives no rows; extra columns are left
alone, and helper columns take names that the caller does not use.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.llm.columns import unused
from poiweave.storage import materialise

#: Each rule: name, then the conditions to vote good and to vote bad over the measures; else it abstains.
RULES: list[tuple[str, str, str]] = [
    ("length", "n_words between 60 and 100000", "n_words < 20"),
    ("word_length", "10 * word_chars between 30 * n_words and 90 * n_words", "word_chars > 14 * n_words or word_chars < 2 * n_words"),
    ("symbols", "20 * n_symbols <= n_words", "4 * n_symbols > n_words"),
    ("symbol_share", "200 * n_symbols <= word_chars and word_chars > 0", "20 * n_symbols > word_chars"),
    ("case", "10 * n_upper <= 2 * n_letters and n_letters > 0", "10 * n_upper > 6 * n_letters and n_letters > 0"),
    ("repetition", "20 * n_repeat_words <= n_words", "10 * n_repeat_words > 3 * n_words"),
    ("lines", "n_dup_lines = 0", "10 * n_dup_lines > 3 * n_lines"),
    ("prose", "n_marks * 100 >= n_words and n_marks * 2 <= n_words", "n_marks = 0 or n_marks > n_words"),
    ("letters", "10 * n_letters >= 8 * word_chars and word_chars > 0", "10 * n_letters < 6 * word_chars"),
]
#: Prior probability of a good document, and the weight of all priors as a share of the rows.
PRIOR_GOOD, PRIOR_WEIGHT = 0.7, 0.02


def with_measures(docs: DataFrame, text_col: str = "text", into: str = "p__measures") -> DataFrame:
    """Add ``into``: a struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and more."""
    words, windows, places, twice, lines = unused(docs, "p__words", "p__windows", "p__places", "p__twice", "p__lines")
    t = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.withColumn(words, F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    step = step.withColumn(windows, F.expr(f"case when size(`{words}`) >= 3 then transform(sequence(0, size(`{words}`) - 3), i -> xxhash64(`{words}`[i], `{words}`[i + 1], `{words}`[i + 2])) else cast(array() as array<bigint>) end"))
    # Windows found twice: sort (window, place) and compare neighbours; texts without any skip the sort.
    step = step.withColumn(places, F.expr(
        f"case when size(array_distinct(`{windows}`)) = size(`{windows}`) then cast(array() as array<struct<w:bigint,i:int>>) "
        f"else sort_array(transform(`{windows}`, (w, i) -> named_struct('w', w, 'i', i))) end"
    ))
    step = step.withColumn(twice, F.expr(f"transform(filter(`{places}`, (x, k) -> (k > 0 and get(`{places}`, k - 1).w = x.w) or coalesce(get(`{places}`, k + 1).w = x.w, false)), x -> x.i)"))
    step = step.withColumn(lines, F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    left = lambda pattern: F.length(F.regexp_replace(t, pattern, "")).cast("long")
    return step.withColumn(
        into,
        F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.expr(f"case when size(`{twice}`) = 0 then 0 else size(array_distinct(flatten(transform(`{twice}`, i -> array(i, i + 1, i + 2))))) end").cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            left(r"[^\p{Lu}]+").alias("n_upper"),
            left(r"\P{L}+").alias("n_letters"),
            left(r"[^.!?]+").alias("n_marks"),
        ),
    ).drop(words, windows, places, twice, lines)


def votes(measure: str = "p__measures") -> Column:
    """A string with one character for each rule: ``+`` good, ``-`` bad, ``0`` abstains."""

    def of(condition: str) -> str:
        return re.sub(r"\b(n_\w+|word_chars)\b", rf"`{measure}`.\1", condition)

    return F.concat(*[F.expr(f"case when {of(bad)} then '-' when {of(good)} then '+' else '0' end") for _, good, bad in RULES])


def base_failed(measure: str = "p__measures") -> Column:
    """Fewer than 50 words, or over half of the words in windows found twice or more."""
    m = F.col(measure)
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def fit_label_model(patterns: Sequence[tuple[str, int]], rounds: int = 50) -> dict:
    """EM for a binary label and conditionally independent votes, from counts of vote patterns.

    A rule has P(+|good), P(-|good), P(+|bad), P(-|bad); abstaining takes the rest. Pseudo-counts
    start and hold each rule at better than chance, which also fixes which class is called good.
    """
    m = len(RULES)
    total = sum(n for _, n in patterns) or 1
    weight = max(1.0, PRIOR_WEIGHT * total)
    p_good = PRIOR_GOOD
    like = [{1: {"+": 0.7, "-": 0.02, "0": 0.28}, 0: {"+": 0.35, "-": 0.35, "0": 0.3}} for _ in range(m)]
    start = [{k: dict(v) for k, v in x.items()} for x in like]
    for _ in range(rounds):
        sums = [{1: {"+": 0.0, "-": 0.0, "0": 0.0}, 0: {"+": 0.0, "-": 0.0, "0": 0.0}} for _ in range(m)]
        good = 0.0
        for pattern, n in patterns:
            logit = math.log(p_good / (1 - p_good)) + sum(math.log(like[k][1][v] / like[k][0][v]) for k, v in enumerate(pattern))
            q = 1 / (1 + math.exp(-max(-50.0, min(50.0, logit))))
            good += n * q
            for k, v in enumerate(pattern):
                sums[k][1][v] += n * q
                sums[k][0][v] += n * (1 - q)
        p_good = (good + weight * PRIOR_GOOD) / (total + weight)
        for k in range(m):
            for c in (0, 1):
                size = sum(sums[k][c].values()) + weight
                for v in "+-0":
                    like[k][c][v] = (sums[k][c][v] + weight * start[k][c][v]) / size
    return {"prior": p_good, "like": like}


def posterior(votes_col: str, model: dict) -> Column:
    """P(good | votes) under the fitted model, as an expression of literals."""
    total = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for k, like in enumerate(model["like"]):
        v = F.substring(F.col(votes_col), k + 1, 1)
        w = {x: math.log(like[1][x] / like[0][x]) for x in "+-0"}
        total = total + F.when(v == "+", F.lit(w["+"])).when(v == "-", F.lit(w["-"])).otherwise(F.lit(w["0"]))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def judge(measured: DataFrame, cut: float = 0.5, votes_col: str = "p__votes", failed_col: str = "p__failed") -> tuple[DataFrame, Column, Column]:
    """The table of ``measured`` (rows with a string of votes and whether the base rule failed), and two expressions over it: the posterior
    probability of good, and the verdict: the base rule has not failed and the posterior is ``cut`` or more.

    The rows are written once; the vote patterns and the verdicts come from that table.
    """
    voted = materialise(measured, "voted")
    counts = voted.groupBy(votes_col).count().collect()  # one row per pattern: bounded by the rules, not the rows
    quality = posterior(votes_col, fit_label_model(sorted((r[0], r[1]) for r in counts)))
    return voted, quality, ~F.col(failed_col) & (quality >= cut)


def op9_query(spark, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measures of the base rules, base_failed, kept, votes, quality (posterior) and n_lines, n_upper, n_letters, n_marks."""
    measured = with_measures(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).drop("text")
    voted, quality, kept = judge(measured.withColumn("p__votes", votes()).withColumn("p__failed", base_failed()))
    return voted.select("doc_id", "p__measures.*", F.col("p__failed").alias("base_failed"), kept.alias("kept"), F.col("p__votes").alias("votes"), quality.alias("quality"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go."""
    measures, voted, failed = unused(docs, "p__measures", "p__votes", "p__failed")
    step = with_measures(docs, into=measures).withColumn(voted, votes(measures)).withColumn(failed, base_failed(measures)).drop(measures)
    rows, _, kept = judge(step, votes_col=voted, failed_col=failed)
    return rows.where(kept).select(*docs.columns)
