"""Quality rules by weak supervision.

Method: rules vote good (1), bad (-1) or abstain (0) on each document. The
votes of all documents are counted by vote pattern (at most 3**rules of them,
a bounded table whatever the corpus), expectation-maximisation over those
counts estimates how often each rule votes how on good and on bad documents,
and each document gets the posterior probability of being good. A document
fails by its posterior, not by any single rule. Two base limits fail outright.

Cases: null or empty texts have zero counts and fail the word limit; an empty
table gives an empty result; repeated rows are scored alike; only doc_id and
text are read, so further columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flocklens.llm.common import Run, slices
from flocklens.llm.text_stats import text_stats

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
    "n_digits",
    "n_loud",
    "n_bare",
    "n_marked",
    "n_stutter",
)
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_POSTERIOR = 0.7


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def rule_votes() -> dict[str, Column]:
    """Each rule's vote on the counts of a document."""

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    mean = _share("word_chars", "n_words")
    symbols, bare = _share("n_symbols", "n_words"), _share("n_bare", "n_words")
    upper, loud = _share("n_upper", "n_letters"), _share("n_loud", "n_words")
    return {
        "length": F.when(F.col("n_words") >= 40, 1).otherwise(0),
        "word_length": vote((mean < 2.5) | (mean > 14), (mean >= 3.5) & (mean <= 10)),
        "symbols": vote(symbols > 0.12, symbols < 0.04),
        "marked": vote(_share("n_marked", "n_words") > 0.1, F.col("n_marked") == 0),
        "bare": vote(bare > 0.15, bare < 0.06),
        "letters": vote(_share("n_letters", "word_chars") < 0.8, _share("n_letters", "word_chars") > 0.9),
        "upper": vote(upper > 0.4, upper < 0.15),
        "loud": vote(loud > 0.25, loud < 0.04),
        "digits": vote(_share("n_digits", "word_chars") > 0.2, _share("n_digits", "word_chars") < 0.05),
        "stutter": vote(_share("n_stutter", "n_words") > 0.3, _share("n_stutter", "n_words") < 0.05),
        "lines": vote(_share("n_dup_lines", "n_lines") > 0.3, _share("n_dup_lines", "n_lines") < 0.1),
        "repeats": vote(
            100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
            10 * F.col("n_repeat_words") < F.col("n_words"),
        ),
    }


def fit(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray]:
    """EM over vote patterns: (log prior odds of good, log-odds weight of each
    rule's bad and good vote, [rules, 2]). An abstention says nothing. Starts
    from the view that a bad vote is right three times out of four."""
    good = 0.97 * 0.25 ** (votes < 0).sum(axis=1)
    hit = np.stack([votes < 0, votes > 0], axis=2).astype(np.float64)  # pattern, rule, vote
    odds, weights = 0.0, np.zeros((votes.shape[1], 2))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        prior = weight.sum(axis=1) + 1
        table = np.einsum("cp,prv->crv", weight, hit) + 0.5
        table /= table.sum(axis=2, keepdims=True)
        odds = np.log(prior[1] / prior[0])
        weights = np.log(table[1]) - np.log(table[0])
        # a rule may not count against its own vote
        weights[:, 0] = np.minimum(weights[:, 0], 0)
        weights[:, 1] = np.maximum(weights[:, 1], 0)
        total = odds + np.einsum("prv,rv->p", hit, weights)
        new = 1 / (1 + np.exp(-np.clip(total, -500, 500)))
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    return float(odds), weights


def _counts(batches):
    schema = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in COUNTS])
    for batch in batches:
        for part in slices(batch, "text"):
            stats, _, _ = text_stats(part.column("text"))
            yield pa.record_batch(
                [part.column("doc_id").cast(pa.int64()), *(pa.array(stats[c], pa.int64()) for c in COUNTS)], schema=schema
            )


def score(docs: DataFrame, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, the counts, each
    rule's vote (vote_<rule>), base_failed, posterior and kept."""
    run = Run(docs.sparkSession, "rules")
    rules = rule_votes()
    rows = docs.select("doc_id", "text").mapInArrow(_counts, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))
    rows = run.keep(rows.withColumns({f"vote_{k}": v.cast("int") for k, v in rules.items()}), "votes")
    names = [f"vote_{k}" for k in rules]
    patterns = rows.groupBy(names).count().collect()  # at most 3 ** len(rules) rows
    votes = np.array([r[:-1] for r in patterns], dtype=np.int64).reshape(len(patterns), len(names))
    odds, weights = fit(votes, np.array([r["count"] for r in patterns], dtype=np.float64))
    total = F.lit(odds)
    for name, w in zip(names, weights):
        total = total + F.when(F.col(name) < 0, float(w[0])).when(F.col(name) > 0, float(w[1])).otherwise(0.0)
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return (
        rows.withColumn("base_failed", base_failed)
        .withColumn("posterior", 1 / (1 + F.exp(-total)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= min_posterior))
    )
