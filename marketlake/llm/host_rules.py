"""Quality rules at host level (operator 3).

Every document is judged by rules of its own (word count, repeated words, symbols,
repeated lines, shouting, separators). Failures are counted per host, the hosts' rates
are shrunk with a beta prior fitted to all hosts, and the host verdicts are joined
back: in a host whose shrunk rate of a rule is too high, documents are held to
that rule strictly. A document that fails no rule is kept on any host.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.text import SPACED, batch_bytes, bound_batches, by_batch, by_bytes, fresh, gram_codes, scan_places, utf8, with_fields
from marketlake.operators.common import join_per_key
from marketlake.session import cut_lineage

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouted", "n_marked"]


@dataclass(frozen=True)
class Rules:
    """Limits as whole-number ratios, so that no result hangs on rounding."""

    least_words: int = 50
    most_repeat_pct: int = 50  # words in repeated 3-word windows
    # A document clearly fails on its own above ``hard``; in a host with a bad verdict already above ``soft``.
    hard_symbol_pct: int = 25  # words that carry two symbols, or are one
    soft_symbol_pct: int = 10
    hard_dup_line_pct: int = 60
    soft_dup_line_pct: int = 30
    hard_shout_pct: int = 60  # words in capitals, or ending in two exclamation marks
    soft_shout_pct: int = 30
    host_rate: float = 0.5  # shrunk failure rate above which a host is bad
    host_documents: int = 20  # hosts of fewer documents get no verdict of their own


def repeated_words(codes: np.ndarray) -> int:
    """Words that lie in a 3-word window found at least twice, the first one included."""
    grams = gram_codes(codes, 3)
    _, kind, count = np.unique(grams, return_inverse=True, return_counts=True)
    if len(count) == len(grams):
        return 0
    covered = np.zeros(len(codes), bool)
    again = np.flatnonzero(count[kind] > 1)
    for j in range(3):
        covered[again + j] = True
    return int(covered.sum())


def _flags(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


SYMBOL, UPPER, LOWER = _flags("#*$%&|<>"), _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("abcdefghijklmnopqrstuvwxyz")


def measure(texts: pa.Array) -> list[np.ndarray]:
    """The METRICS of a batch of texts. A word is shouted if its ASCII letters are all capitals
    (and it is longer than one byte) or it ends in two exclamation marks; it is marked if it consists of
    symbols or ends in the same symbol twice."""
    data, at = batch_bytes(texts)
    codes, begin, start, stop = scan_places(data, at, SPACED)

    number = np.int32 if len(data) < 1 << 31 else np.int64

    def upto(flag: np.ndarray) -> np.ndarray:
        out = np.zeros(len(flag) + 1, number)
        np.cumsum(flag, out=out[1:])
        return out

    def per_text(flag: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return np.diff(upto(flag)[bounds])

    symbols, upper, lower = upto(SYMBOL[data]), upto(UPPER[data]), upto(LOWER[data])
    size = stop - start
    last, before = data[stop - 1], data[np.maximum(stop - 2, 0)]
    twice = (last == before) & (size > 1)
    within = (lambda sums: sums[stop] - sums[start])
    shouted = (size > 1) & (within(upper) > 0) & (within(lower) == 0) | twice & (last == ord("!"))
    marked = (within(symbols) == size) | twice & SYMBOL[last]
    points = per_text(((data & 0xC0) != 0x80) & (SPACED[data] != 0), at)
    lines, dups = [], []
    for t in utf8(texts):
        own = [x for x in t.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
        lines.append(len(own))
        dups.append(len(own) - len(set(own)))
    repeats = [repeated_words(codes[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]
    return [np.diff(begin), points, np.diff(symbols[at]), np.array(dups, np.int64), np.array(repeats, np.int64), np.array(lines, np.int64), per_text(shouted, begin), per_text(marked, begin)]


def measure_batch(texts: pa.Array) -> list[np.ndarray]:
    """``measure`` slice by slice: its tables take some fifty times the bytes that it is given."""
    parts = [measure(part) for part in by_bytes(texts)] or [measure(texts)]
    return [np.concatenate(m) for m in zip(*parts)]


def document_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """Appends the METRICS (long) of each whole text; a null text counts as empty."""
    bound_batches(df.sparkSession)

    def make():
        def each(batch: pa.Array) -> pa.Array:
            return pa.StructArray.from_arrays([pa.array(m, pa.int64()) for m in measure_batch(batch)], METRICS)

        return each

    kind = "struct<" + ",".join(f"{m}:bigint" for m in METRICS) + ">"
    return with_fields(df, F.arrow_udf(by_batch(make), kind, F.ArrowUDFType.SCALAR_ITER)(F.col(text)), METRICS)


def _over(part: str, whole: str, pct: int) -> Column:
    return F.col(part) * 100 > F.col(whole) * pct


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.least_words) | _over("n_repeat_words", "n_words", rules.most_repeat_pct)


def _failures(rules: Rules, hard: bool) -> dict[str, Column]:
    pick = (lambda name: getattr(rules, f"{'hard' if hard else 'soft'}_{name}_pct"))
    return {
        "symbols": _over("n_marked", "n_words", pick("symbol")),
        "lines": _over("n_dup_lines", "n_lines", pick("dup_line")),
        "shout": _over("n_shouted", "n_words", pick("shout")),
    }


def host_key(host: str) -> Column:
    """Null hosts are one host of their own, apart from the empty string."""
    return F.when(F.col(host).isNull(), F.lit("null")).otherwise(F.concat(F.lit("host:"), F.col(host).cast("string")))


def host_verdicts(measured: DataFrame, host: str, rules: Rules) -> DataFrame:
    """One row per host: documents, shrunk rate per rule, and its verdict per rule.

    Failures are pre-aggregated before the shuffle, so a host with a third of all
    rows is one row per task. The prior of a rule is a beta distribution fitted by
    moments to the hosts' rates (its strength at most 1,000 documents and at least
    1; the mean rate if the hosts do not differ). An empty table gives no rows.
    """
    key, fails = fresh("host"), _failures(rules, hard=False) | {"base": base_failed(rules)}
    counts = cut_lineage(measured.groupBy(host_key(host).alias(key)).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c.cast("long")).alias(f"k_{r}") for r, c in fails.items()]))
    prior = counts.agg(
        *[x for r in fails for x in (
            (F.sum(f"k_{r}") / F.sum("n")).alias(f"mean_{r}"),
            F.coalesce(F.var_samp(F.when(F.col("n") >= rules.host_documents, F.col(f"k_{r}") / F.col("n"))), F.lit(0.0)).alias(f"var_{r}"))]).first()
    out = counts
    for r in fails:
        mean, var = prior[f"mean_{r}"] or 0.0, prior[f"var_{r}"] or 0.0
        strength = min(1000.0, max(1.0, mean * (1 - mean) / var - 1)) if var > 0 else 1000.0
        rate = (F.col(f"k_{r}") + mean * strength) / (F.col("n") + strength)
        out = out.withColumn(f"rate_{r}", rate).withColumn(f"bad_{r}", (F.col("n") >= rules.host_documents) & (rate > rules.host_rate))
    return out.select(F.col(key), F.col("n").alias("host_documents"), *[f"rate_{r}" for r in fails], *[f"bad_{r}" for r in fails])


def judge(df: DataFrame, rules: Rules = Rules(), text: str = "text", host: str = "source", reuse_measures: bool = False) -> DataFrame:
    """Appends the METRICS, base_failed and kept (boolean).

    kept is false where base_failed, where a rule fails clearly, or where the
    host's verdict on a rule is bad and the document fails it strictly. Null or
    empty texts have no words and fail; null hosts form one host; ties at a limit
    do not fail; repeated rows are judged alike; other columns pass through, and
    those named like a result are replaced. ``reuse_measures`` writes the measured
    rows once (set it where the table carries no long columns beyond the text's
    metrics); else the texts are measured again for the second pass, which is
    cheaper than to write them.
    """
    measured = document_metrics(df, text)
    if reuse_measures:
        measured = cut_lineage(measured.drop(text))
    hosts = host_verdicts(measured, host, rules)
    key = hosts.columns[0]
    names = {f"bad_{r}": fresh(r) for r in (*_failures(rules, False), "base")}
    hosts = hosts.select(key, *[F.col(a).alias(b) for a, b in names.items()])
    joined = join_per_key(measured.withColumn(key, host_key(host)), hosts, key, "left")
    strict = [F.col(names[f"bad_{r}"]) & soft for r, soft in _failures(rules, hard=False).items()]
    failed = F.coalesce(base_failed(rules), F.lit(False))
    for c in (*_failures(rules, hard=True).values(), *strict):
        failed = failed | F.coalesce(c, F.lit(False))
    return (joined.withColumn("base_failed", base_failed(rules)).withColumn("kept", ~failed)
            .drop(key, *names.values()))
