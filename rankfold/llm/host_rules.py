"""Quality rules of documents, and verdicts on the hosts they come from.

Each document is measured once. A host's failures are counted, and its rate is drawn towards
that of all hosts by a beta prior fitted to the hosts' rates by their mean and variance, so
a host with few documents is not judged by chance. Verdicts go back to the documents by a
join. A document of a host whose rate is high beside that of all must pass stricter rules than
others; a clean one stays wherever it comes from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.functions.names import fresh
from rankfold.llm.common import column, map_texts, spread_join, written

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[bytes]) -> int:
    """Words within a three-word window that stands twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, n)
    size = len(numbers)
    pairs = ids[:-1] * size + ids[1:]
    if size**3 >= 1 << 63:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * size + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def measure(texts: list[bytes]) -> dict:
    rows = []
    for text in texts:
        words = text.split()
        rows.append(
            (
                len(words),
                len(text.decode()) - sum(text.count(space) for space in SPACES),
                sum(text.count(symbol) for symbol in SYMBOLS),
                duplicate_lines(text),
                repeat_words(words),
            )
        )
    return {name: (values, pa.int64()) for name, values in zip(MEASURES, zip(*rows))}


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def strict_failed() -> Column:
    """What a document of a suspect host must not show, besides the base rules."""
    words = F.col("n_words")
    return (
        (20 * F.col("n_symbols") > words)
        | (10 * F.col("n_dup_lines") > words)
        | (100 * F.col("n_repeat_words") > 20 * words)
        | (F.col("word_chars") < 2 * words)
        | (F.col("word_chars") > 15 * words)
    )


def host_rates(measured: DataFrame) -> DataFrame:
    """One row per host: ``host, n_docs, n_failed, rate, pooled``, the rate drawn towards the pooled one.

    The prior's mean is the pooled rate ``m``. Its weight ``a + b`` follows from the variance
    between hosts beyond that of counting, ``m (1 - m) / v - 1``; without such variance all hosts
    have the pooled rate. The prior is two numbers, whatever the input.
    """
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")
    )
    pooled = hosts.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"),
        F.sum("n_failed").alias("failed"),
        F.count(F.lit(1)).alias("hosts"),
        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("squares"),
    ).head()
    mean, weight = beta_prior(*pooled)
    rate = F.lit(mean)
    if weight is not None:
        rate = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.withColumns({"rate": rate, "pooled": F.lit(mean)})


def beta_prior(docs: int, failed: int | None, hosts: int, squares: float | None) -> tuple[float, float | None]:
    """Mean and weight of the prior; ``squares`` sums failures times rate over the hosts.

    No weight stands for an unlimited one: the hosts differ by no more than chance.
    """
    if not docs:
        return 0.0, None
    mean = failed / docs
    between = squares / docs - mean * mean - mean * (1 - mean) * hosts / docs
    if between <= 0:
        return mean, None
    return mean, max(0.0, mean * (1 - mean) / between - 1)


def judge(
    docs: DataFrame, host: str = "source", suspect: float = 2.0, keys: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Measures and verdicts of every row: its keys, ``host, n_words, ..., base_failed, kept``.

    A host is suspect if the odds of its rate, drawn in, are over ``suspect`` times the pooled
    odds. A null text has no words and fails. Documents without a host share one, the null host; an empty table gives
    no rows. Columns other than keys, host and text are not read.
    """
    named = docs.select(*[column(key).alias(key) for key in keys], column(host).alias("host"), column("text").alias("text"))
    measures = ", ".join(f"{name} bigint" for name in MEASURES)
    measured = map_texts(named, lambda: measure, measures, keys=(*keys, "host"))
    measured = written(measured.withColumn("base_failed", base_failed()), "measures")
    rates = written(host_rates(measured), "rates")
    name = fresh("host")
    not_null = F.coalesce(F.concat(F.lit("+"), F.col("host").cast("string")), F.lit("")).alias(name)
    rate, pooled = F.col("rate"), F.col("pooled")
    high = rate * (1 - pooled) > suspect * pooled * (1 - rate)
    verdicts = rates.select(not_null, high.alias("suspect"), F.col("n_docs").alias("n_met"))
    judged = spread_join(measured.select("*", not_null), verdicts, [name], measured.count()).drop(name)
    return judged.withColumn("kept", ~F.col("base_failed") & ~(F.col("suspect") & strict_failed())).drop("suspect")
