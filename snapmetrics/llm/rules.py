"""Quality rules with host verdicts.

Every document gets counts and base rules from its own words.  The failures
of each rule are summed by host (combined before the shuffle).  Each rule has
its own empirical beta prior over the hosts, which shrinks their rates, and
its own verdict: a host is bad for a rule if its shrunk rate, less
``host_sigmas`` posterior deviations, is still ``host_factor`` times the
corpus rate, or if the rate reaches ``host_limit`` outright.  Verdicts are
joined back: documents of a host that is bad for any rule must also pass the
stricter soft rules.  Clean documents of a bad host therefore stay, and where
all hosts fail alike, no host is bad.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm.arrays import SPACE, counts_by_row, mix, repeated, windows, words
from snapmetrics.llm.common import stored, table, text_chunks

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rules:
    """Limits; ``soft_*`` hold only for documents of a bad host."""

    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    soft_repeat_percent: int = 10
    soft_symbol_percent: int = 10
    soft_dup_line_count: int = 3
    #: A bad host: a rule's shrunk failure rate of at least ``host_limit``, or
    #: surely above ``host_factor`` times the rate of the corpus.
    host_limit: float = 0.5
    host_factor: float = 1.5
    host_sigmas: float = 2.0


#: The rules whose failures are summed by host.
RULES = ["words", "repeats", "symbols", "lines"]


def text_counts(raw: np.ndarray, off: np.ndarray, window: int = 5) -> dict[str, np.ndarray]:
    """The five counts of each row of a byte array."""
    n = len(off) - 1
    row, _, h = words(raw, off)
    inside = ~SPACE[raw]
    out = {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": counts_by_row(inside & ((raw & 0xC0) != 0x80), off),
        "n_symbols": counts_by_row(_SYMBOL[raw], off),
    }
    at, hw = windows(h, row, window)
    again = at[repeated(mix(hw ^ (row[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))))]
    edge = np.zeros(len(row) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    out["n_repeat_words"] = np.bincount(row[np.cumsum(edge[:-1]) > 0], minlength=n)
    dup = np.zeros(n, np.int64)
    data = raw.tobytes()
    for i in np.flatnonzero(counts_by_row(raw == 10, off)):
        lines = [x for x in data[off[i] : off[i + 1]].split(b"\n") if x and not x.isspace()]
        dup[i] = len(lines) - len(set(lines))
    out["n_dup_lines"] = dup
    return out


def rule_failures(c: dict, rules: Rules) -> dict:
    """Whether each rule fails, in its soft form where it has one."""
    return {
        "words": c["n_words"] < rules.min_words,
        "repeats": 100 * c["n_repeat_words"] > rules.soft_repeat_percent * c["n_words"],
        "symbols": 100 * c["n_symbols"] > rules.soft_symbol_percent * c["n_words"],
        "lines": c["n_dup_lines"] >= rules.soft_dup_line_count,
    }


def failures(c: dict, rules: Rules):
    """(a base rule fails, a soft rule fails), for columns or for arrays."""
    base = (c["n_words"] < rules.min_words) | (100 * c["n_repeat_words"] > rules.max_repeat_percent * c["n_words"])
    each = rule_failures(c, rules)
    return base, each["repeats"] | each["symbols"] | each["lines"]


def _measure(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in text_chunks(batches):
            c = text_counts(raw, off, window)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("host"), *(pa.array(c[k], pa.int64()) for k in COUNTS)], names=["doc_id", "host", *COUNTS]
            )

    return run


def measure(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(doc_id, host, counts, base_failed, soft_failed) of each document."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    got = src.mapInArrow(_measure(rules.window), "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS))
    base, soft = failures({c: F.col(c) for c in COUNTS}, rules)
    return got.withColumn("base_failed", base).withColumn("soft_failed", base | soft)


def host_rates(measured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(host, n_docs, rule, n_failed, corpus_rate, shrunk, deviation, bad): a
    row for each host with a name and each rule.

    A rule's beta prior has the corpus rate as its mean; its strength comes
    from the hosts' spread about that mean beyond what sampling alone gives
    (method of moments, hosts weighted by their documents).
    """
    fails = rule_failures({c: F.col(c) for c in COUNTS}, rules)
    hosts = (
        measured.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n_docs"), *[F.sum(fails[r].cast("long")).alias(r) for r in RULES])
    )
    # One row per host and rule; one row per rule for the prior.
    long = stored(hosts.unpivot(["host", "n_docs"], RULES, "rule", "n_failed"), "host-failures")
    n, f = F.col("n_docs"), F.col("n_failed")
    sums = long.groupBy("rule").agg(
        F.sum(n).alias("docs"), F.count(F.lit(1)).alias("hosts"), (F.sum(f) / F.sum(n)).alias("corpus_rate"), F.sum(f * f / n).alias("squares")
    )
    m = F.col("corpus_rate")
    noise = m * (1 - m)
    spread = F.col("squares") / F.col("docs") - m * m - noise * F.col("hosts") / F.col("docs")
    strength = F.when(spread > 1e-12, F.greatest(F.least(noise / spread - 1, F.lit(1e4)), F.lit(1.0))).otherwise(1e4)
    priors = sums.select("rule", "corpus_rate", strength.alias("strength"))
    got = long.join(F.broadcast(priors), "rule")  # one row per rule
    total = n + F.col("strength")
    shrunk = (f + m * F.col("strength")) / total
    deviation = F.sqrt(F.col("shrunk") * (1 - F.col("shrunk")) / (total + 1))
    surely = F.col("shrunk") - rules.host_sigmas * F.col("deviation") >= rules.host_factor * m
    got = got.withColumn("shrunk", shrunk).withColumn("deviation", deviation)
    bad = (f > 0) & (surely | (F.col("shrunk") >= rules.host_limit))
    return got.withColumn("bad", bad).drop("strength")


def host_verdicts(measured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(host, n_docs, bad, bad_rules, shrunk) for each host with a name;
    ``shrunk`` maps rules to rates."""
    return host_rates(measured, rules).groupBy("host", "n_docs").agg(
        F.bool_or("bad").alias("bad"), F.array_sort(F.collect_set(F.when(F.col("bad"), F.col("rule")))).alias("bad_rules"),
        F.map_from_entries(F.collect_list(F.struct("rule", "shrunk"))).alias("shrunk"),
    )


def judge(docs: DataFrame, rules: Rules = Rules(), **columns: str) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every document.

    Null or empty text has no words and fails; a document without a host is
    judged by the base rules alone.  Repeated rows are judged row by row.
    The counts are written to the shared folder once, as both the host sums
    and the verdicts read them; only hosts found bad are joined, and Spark
    broadcasts them only if they are measured to be small.
    """
    got = stored(measure(docs, rules, **columns), "rule-counts")
    bad = stored(host_verdicts(got, rules).where("bad").select("host", "bad"), "bad-hosts")
    return got.join(bad, "host", "left").withColumn(
        "kept", ~F.col("base_failed") & ~(F.coalesce(F.col("bad"), F.lit(False)) & F.col("soft_failed"))
    )


def _flag(rules: Rules):
    """Each row as it is, with its two failures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in text_chunks(batches):
            base, soft = failures(text_counts(raw, off, rules.window), rules)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(base), pa.array(soft)], names=[*part.schema.names, "__base", "__soft"])

    return run


def keep_good(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    Counts are taken twice, for the host sums and for the verdicts, so that
    no text is shuffled.
    """
    hosts = host_verdicts(measure(docs.withColumn("__id", F.lit(0)), rules, "__id", text_col, host_col), rules)
    bad = stored(hosts.where("bad").select(F.col("host").alias("__host"), F.col("bad").alias("__bad")), "bad-hosts")
    named = docs if text_col == "text" else docs.withColumnRenamed(text_col, "text")
    schema = T.StructType([*named.schema.fields, T.StructField("__base", T.BooleanType()), T.StructField("__soft", T.BooleanType())])
    flagged = named.mapInArrow(_flag(rules), schema)
    joined = flagged.join(bad, F.col(host_col).cast("string") == F.col("__host"), "left")
    good = joined.where(~F.col("__base") & ~(F.coalesce("__bad", F.lit(False)) & F.col("__soft")))
    return good.select(*[F.col(f"`{n}`").alias(o) for n, o in zip(named.columns, docs.columns, strict=True)])


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdicts of every document; hosts are its sources."""
    return judge(table(spark, sf_dir, "documents")).select("doc_id", *COUNTS, "base_failed", "kept")
