"""Quality rules whose cutoffs are chosen from labelled documents with a guaranteed limit of false rejections.

A rule rejects a document whose measure is above a cutoff.  For each stratum
(language) and rule, cutoffs are tried from the mildest to the strictest on
the labelled good documents, up to the strictest before the first failure.  Of
these the mildest is taken that rejects all labelled bad documents which the
strictest one rejects, so that no good document is lost for nothing.
A cutoff passes if the exact binomial (Clopper-Pearson) upper bound of its
false-rejection rate is at most the rule's share of the risk.  Testing in a
fixed order needs no correction along the grid; over strata and rules the
confidence is divided by their number (Bonferroni), and the risk of a stratum
is divided among its rules.  Together: with the given confidence, no stratum
loses more than ``risk`` of its good documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import SPACE, stage, text_of, unwrapped, wrapped

#: Rules: name, measure, and width of a step of the cutoff grid.  All measures grow with badness.
RULES: tuple[tuple[str, str, float], ...] = (
    ("symbols", "n_symbols / greatest(n_words, 1)", 0.05),
    ("repeated_words", "n_repeat_words / greatest(n_words, 1)", 0.01),
    ("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", 0.01),
    ("long_words", "word_chars / greatest(n_words, 1)", 0.25),
)
#: Cutoff grids end here; measures beyond fall into the last step.
STEPS = 400
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measures of one whole text, in the order of ``MEASURES``; a missing text is empty."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words), len(text) - len(raw) + len(raw.translate(None, SPACE)), len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)), _repeated(words), len(lines),
    )


def _repeated(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in the text."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    often = counts[which] > 1
    if not often.any():
        return 0
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= often
    return int(covered.sum())


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the measures of each whole text; ``base_failed`` marks short and repetitive texts."""
    inner = [f"k{i}" for i in range(len(keep))]
    source = docs.select(*(F.col(c).alias(i) for c, i in zip(keep, inner, strict=True)), text_of().alias("t"))
    schema = ", ".join(f"{i} {docs.schema[c].dataType.simpleString()}" for c, i in zip(keep, inner, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measure_text(t) for t in batch.column("t").to_pylist()], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in inner] + [pa.array(found[:, k]) for k in range(len(MEASURES))], names=[*inner, *MEASURES]
            )

    out = source.mapInArrow(run, f"{schema}, {', '.join(f'{m} bigint' for m in MEASURES)}")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select(*(F.col(i).alias(c) for c, i in zip(keep, inner, strict=True)), *MEASURES, failed.alias("base_failed"))


def false_rejection_bound(wrong: int, of: int, confidence_left: float) -> float:
    """Clopper-Pearson upper bound of a rate after ``wrong`` events in ``of`` trials, by bisection."""
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if at_most(wrong, of, middle) > confidence_left else (low, middle)
    return high


def at_most(wrong: int, of: int, rate: float) -> float:
    """Binomial probability of at most ``wrong`` events in ``of`` trials."""
    if wrong >= of or rate <= 0:
        return 1.0
    if rate >= 1:
        return 0.0
    k = np.arange(wrong + 1)
    choose = math.lgamma(of + 1) - np.array([math.lgamma(i + 1) + math.lgamma(of - i + 1) for i in k])
    logs = choose + k * math.log(rate) + (of - k) * math.log1p(-rate)
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def strictest(good: np.ndarray, risk: float, confidence_left: float) -> int:
    """The lowest passing step: documents in higher steps are rejected.  ``good`` counts good documents by step."""
    total, wrong, passed = int(good.sum()), 0, len(good) - 1
    if not total:
        return passed
    for step in range(len(good) - 1, 0, -1):
        wrong += int(good[step])
        if at_most(wrong, total, risk) > confidence_left:
            break
        passed = step - 1
    return passed


def mildest(bad: np.ndarray, step: int) -> int:
    """The highest step whose cutoff rejects as many bad documents, counted by step, as that at ``step``."""
    above = np.flatnonzero(bad[step + 1:])
    return step + int(above[0]) if len(above) else len(bad) - 1


def _step(expression: str, width: float) -> Column:
    return F.least(F.ceil(F.expr(expression) / width), F.lit(STEPS)).cast("int")


def choose_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = 0.05, confidence: float = 0.95) -> DataFrame:
    """Cutoffs by stratum: ``(stratum, cutoffs map<rule, step>)`` from measured and labelled documents.

    All labelled good documents that pass the base rules are the holdout.  A document with labels that disagree is not
    used; a missing label, id or table gives no cutoff, so nothing is rejected, as by a rule that meets no bad document.
    """
    labelled = (
        labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("most"))
        .where("q = 1 or most = 0").select("doc_id", (F.col("q") == 1).alias("good"))
    )
    steps = F.explode(F.array(*(
        F.struct(F.lit(name).alias("rule"), _step(how, width).alias("step")) for name, how, width in RULES
    )))
    counts = (
        measured.where("not base_failed").join(labelled, "doc_id")
        .select(F.coalesce("lang", F.lit("")).alias("stratum"), "good", steps.alias("s"))
        .groupBy("stratum", "s.rule", "s.step").agg(F.count_if("good").alias("n"), F.count_if(~F.col("good")).alias("n_bad"))
    )
    strata = max(1, counts.where("n > 0").select("stratum").distinct().count())

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        good, bad = np.zeros((2, STEPS + 1), np.int64)
        np.add.at(good, rows["step"].to_numpy(), rows["n"].to_numpy())
        np.add.at(bad, rows["step"].to_numpy(), rows["n_bad"].to_numpy())
        left = (1 - confidence) / (strata * len(RULES))
        step = mildest(bad, strictest(good, risk / len(RULES), left))
        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]], "rule": [rows["rule"].iloc[0]], "step": [step]})

    chosen = counts.groupBy("stratum", "rule").applyInPandas(choose, "stratum string, rule string, step int")
    return chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "step"))).alias("cutoffs"))


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Measured documents with ``failed_rules`` and ``kept``; a stratum without cutoffs fails the base rules only."""
    failed = F.array(*(F.when(_step(how, width) > F.get(F.array(F.col("cutoffs")[name]), F.lit(0)), F.lit(name)) for name, how, width in RULES))
    return (
        measured.withColumn("stratum", F.coalesce("lang", F.lit(""))).join(cutoffs, "stratum", "left")
        .withColumn("failed_rules", F.array_compact(failed))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
        .drop("stratum", "cutoffs")
    )


def keep_good(docs: DataFrame, labels: DataFrame, **limits: float) -> DataFrame:
    """The documents that the rules keep, with their own columns.  Rows with equal content share their verdict."""
    rows = wrapped(docs)
    cutoffs = stage(choose_cutoffs(stage(measure(rows, ["doc_id", "lang"]), "measures"), labels, **limits), "cutoffs")
    return unwrapped(judge(measure(rows, ["row", "lang", "text"]), cutoffs).where("kept"), docs.columns)
