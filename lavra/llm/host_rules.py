"""Quality rules per document, and verdicts on whole hosts from shrunken failure rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import WORD, free_name
from lavra.runtime import bounded, materialize

REPEAT_WORDS = 8
LEAST_WORDS = 20
MOST_REPEATED = 0.30
# Rules that a host is judged by: measure over words (or lines) and its limit in a document.
MOST_SYMBOLS = 0.10
MOST_DUPLICATE_LINES = 0.30
# A host fails a rule if its shrunken failure rate exceeds this.
MOST_FAILURES = 0.75

# Documents that the prior weighs at most; as many if rates do not vary beyond chance.
MOST_PRIOR = 1000.0

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LINES = "n_lines"
RULES = ("short", "repetitive", "symbols", "duplicate_lines")
_NEW = {*METRICS, LINES, "base_failed", "host_failed", "kept", *(f"{rule}_rate" for rule in RULES)}


def with_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the columns of `METRICS`, and `n_lines`, the lines that have a word, for its
    whole texts; null text is empty."""
    whole = F.coalesce(docs[text], F.lit(""))
    found, lines, hashes = (free_name(docs, name) for name in ("words", "lines", "hashes"))
    n = F.size(found)
    length = F.lit(REPEAT_WORDS)
    windows = F.when(
        n >= REPEAT_WORDS,
        F.transform(
            F.sequence(F.lit(1), n - REPEAT_WORDS + 1),
            lambda i: F.xxhash64(F.slice(found, i, length)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    several = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return (
        docs.withColumn(found, F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)))
        .withColumn(lines, F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(WORD)))
        .withColumn(hashes, windows)
        .withColumns(
            {
                "n_words": n.cast("bigint"),
                "word_chars": F.char_length(F.array_join(found, "")).cast("bigint"),
                "n_symbols": F.char_length(
                    F.regexp_replace(whole, r"[^#*$%&|<>]+", "")
                ).cast("bigint"),
                LINES: F.size(lines).cast("bigint"),
                "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
                # Equal windows have equal hashes, so only texts with equal hashes are compared.
                "n_repeat_words": F.when(several, _covered(found, hashes))
                .otherwise(F.lit(0))
                .cast("bigint"),
            }
        )
        .drop(found, lines, hashes)
    )


def _covered(found: str, hashes: str) -> Column:
    """Words covered by windows that stand in the text more than once, compared as texts.

    Windows sorted by text have their equals next to them. The starts of those, in order,
    cover the window's length each, or up to the next start if that is nearer.
    """
    placed = F.transform(
        F.col(hashes),
        lambda _, i: F.struct(
            F.array_join(F.slice(found, i + 1, F.lit(REPEAT_WORDS)), " ").alias("window"),
            i.alias("at"),
        ),
    )

    def starts(ordered: Column) -> Column:
        def equal(i: Column, other: Column) -> Column:
            return F.coalesce(
                F.get(ordered, other)["window"] == F.get(ordered, i)["window"], F.lit(False)
            )

        marked = F.filter(ordered, lambda _, i: equal(i, i - 1) | equal(i, i + 1))
        return F.sort_array(F.transform(marked, lambda w: w["at"]))

    def covered(at: Column) -> Column:
        each = F.transform(
            at,
            lambda start, i: F.least(
                F.coalesce(F.get(at, i + 1) - start, F.lit(REPEAT_WORDS)), F.lit(REPEAT_WORDS)
            ),
        )
        return F.aggregate(each, F.lit(0), lambda total, n: total + n)

    return _let(_let(F.sort_array(placed), starts), covered)


def _let(value: Column, body) -> Column:
    """`body(value)`, with `value` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def base_failed() -> Column:
    too_repetitive = 100 * F.col("n_repeat_words") > round(100 * MOST_REPEATED) * F.col("n_words")
    return (F.col("n_words") < LEAST_WORDS) | too_repetitive


def rule_failures() -> dict[str, Column]:
    """Whether a document fails each of `RULES`."""
    words = F.col("n_words")
    return {
        "short": words < LEAST_WORDS,
        "repetitive": 100 * F.col("n_repeat_words") > round(100 * MOST_REPEATED) * words,
        "symbols": F.col("n_symbols") > MOST_SYMBOLS * F.col("word_chars"),
        "duplicate_lines": F.col("n_dup_lines") > MOST_DUPLICATE_LINES * F.col(LINES),
    }


def host_verdicts(measured: DataFrame, host: str = "host") -> DataFrame:
    """Per host: a shrunken failure rate per rule, and `host_failed`. `measured` has the columns
    of `METRICS`, `n_lines` and the host's, under a name that none of the new ones has.

    A rule's rates over hosts are given a beta prior by the method of moments: with the mean
    rate m and the rates' variance v beyond what chance alone explains, the prior weighs
    s = m (1 - m) / v - 1 documents. A host's rate is (failures + s m) / (n + s), so hosts with
    few documents move to the mean and need much evidence to fail. Mean, variance and chance
    weigh hosts by documents alike, so many tiny hosts do not hide a large one. The prior weighs
    at most `MOST_PRIOR` documents, also where rates vary no more than by chance, so evidence
    of many documents always counts.
    """
    counts = measured.groupBy(host).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(failed).alias(f"{rule}_failures") for rule, failed in rule_failures().items()],
    )
    hosts = materialize(counts.where(F.col(host).isNotNull()), "hosts")
    moments = [F.count(F.lit(1)).alias("hosts")]
    for rule in RULES:
        rate = F.col(f"{rule}_failures") / F.col("n")
        moments += [
            (F.sum(f"{rule}_failures") / F.sum("n")).alias(f"{rule}_mean"),
            (F.sum(rate * F.col(f"{rule}_failures")) / F.sum("n")).alias(f"{rule}_square"),
        ]
    # One row of moments; the number of hosts does not matter to the driver.
    row = hosts.agg(*moments, (F.count(F.lit(1)) / F.sum("n")).alias("chance")).first()
    shrunk = {}
    for rule in RULES:
        mean = row[f"{rule}_mean"] or 0.0
        spread = (row[f"{rule}_square"] or 0.0) - mean**2
        chance = mean * (1 - mean) * (row["chance"] or 0.0)
        beyond = spread - chance
        weight = MOST_PRIOR
        if beyond > 0:
            weight = min(max(mean * (1 - mean) / beyond - 1, 0.0), MOST_PRIOR)
        rate = (F.col(f"{rule}_failures") + weight * mean) / (F.col("n") + weight)
        shrunk[f"{rule}_rate"] = rate
    rated = hosts.withColumns(shrunk)
    worst = F.greatest(*[F.col(f"{rule}_rate") for rule in RULES])
    rates = [f"{rule}_rate" for rule in RULES]
    return rated.select(host, *rates, (worst > MOST_FAILURES).alias("host_failed"))


def judge(docs: DataFrame, host: str, text: str = "text") -> DataFrame:
    """`docs` without `text`, with the metrics, `base_failed`, the host's rates and `kept`.

    A document is kept if it passes the base rules and its host does not fail. A null host is
    nobody's: its documents stand for themselves. Host verdicts are joined back by broadcast
    if they were measured to fit, else by a shuffle in which Spark splits a hot host. A column
    of `docs` named like a new one, in either case, is replaced; that goes for the host's too.
    """
    own = free_name(docs, "host_key")
    kept = [c for c in docs.columns if c != text and c.lower() not in _NEW]
    measured = with_metrics(docs.withColumn(own, docs[host]), text)
    measured = measured.select(*kept, own, *METRICS, LINES).withColumn("base_failed", base_failed())
    measured = materialize(measured, "metrics")
    verdicts = host_verdicts(measured.select(F.col(own).alias("host"), *METRICS, LINES))
    of = free_name(measured, "host")
    verdicts = bounded(materialize(verdicts.withColumnRenamed("host", of), "hosts", measured=True))
    failed = F.coalesce("host_failed", F.lit(False))
    return (
        measured.join(verdicts, measured[own] == verdicts[of], "left")
        .drop(own, of)
        .withColumn("kept", ~F.col("base_failed") & ~failed)
    )
