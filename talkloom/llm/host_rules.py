"""Quality rules at the level of hosts.

Rules are checked on each text; each rule's failures are counted for each host (``source``), each host's rate under each
rule is shrunk towards all hosts by a beta prior that is fitted to the hosts' rates by moments, and the host's verdicts
are joined back. A host is *refused* if its shrunk rate of base failures is high beside all hosts: none of its documents
stay. It is *strict* on one of RULES if its shrunk rate there is clearly above that of all hosts: documents of it that
break the rule go. What breaks such a rule on a host that is not strict on it stays, as the odd case that it is there.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import cut, type_of, utf8

#: Production parameters: fewest words and most repeated words in percent.
LEAST_WORDS = 50
MOST_REPEATED = 50
#: Rules that hosts decide on, as SQL over METRICS: one symbol in ten words, a repeated line in 200 words, a tenth of the
#: words repeated, and words that are short or long on average.
RULES = {
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "200 * n_dup_lines > n_words",
    "repeats": "10 * n_repeat_words > n_words",
    "word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
}
#: A host is refused from the lesser of the last and so many times the rate of all hosts, but never below the first.
REFUSED_FROM = (0.3, 3.0, 0.5)
#: A host is strict on a rule from so many times the rate of all hosts.
STRICT_FROM = 1.25
#: Strength of the prior in documents where hosts do not differ enough to fit one, and its limits.
STRENGTH = (10.0, 1.0, 1e6)

SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(text: bytes | None) -> tuple[int, int, int, int, int]:
    """The figures METRICS of a UTF-8 text; null counts as empty."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    solid = text.translate(None, SPACES)
    chars = len(solid) if solid.isascii() else len(solid.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often, open_until = Counter(windows), 0
        for i, w in enumerate(windows):
            if often[w] > 1:
                repeated += i + 3 - max(i, open_until)
                open_until = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """id, host, METRICS and base_failed for each row of docs."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pa.array(x, pa.int64()) for x in zip(*map(measure, utf8(batch.column(2))))] or [pa.array([], pa.int64())] * len(METRICS)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], names=[id_col, host_col, *METRICS])

    schema = f"`{id_col}` {type_of(docs, id_col)}, `{host_col}` {type_of(docs, host_col)}, {', '.join(f'{m} long' for m in METRICS)}"
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return docs.select(id_col, host_col, text_col).mapInArrow(each, schema).withColumn("base_failed", failed)


def host_rates(measured: DataFrame, host_col: str = "source") -> DataFrame:
    """host, n, and for "base" and each rule the shrunk rate: rate_base, rate_symbols, ... of every host that is not null.

    One row for each host; the mean rate of all hosts goes with it as mean_base, ...
    """
    rules = {"base": F.col("base_failed"), **{name: F.expr(rule) for name, rule in RULES.items()}}
    hosts = measured.where(F.col(host_col).isNotNull()).groupBy(F.col(host_col).alias("host"))
    hosts = cut(hosts.agg(F.count("*").alias("n"), *(F.count_if(rule).alias(name) for name, rule in rules.items())), "hosts")
    rate = lambda name: F.col(name) / F.col("n")
    fit = hosts.agg(F.count("*").alias("k"), *(f(rate(x)).alias(f"{y}_{x}") for x in rules for f, y in ((F.avg, "m"), (F.var_samp, "v")))).first()  # one row
    out = hosts
    for name in rules:
        m, v = fit[f"m_{name}"] or 0.0, fit[f"v_{name}"] or 0.0
        strength = min(STRENGTH[2], max(STRENGTH[1], m * (1 - m) / v - 1 if fit["k"] > 1 and v > 0 else STRENGTH[0]))
        shrunk = (F.col(name) + m * strength) / (F.col("n") + strength)
        out = out.withColumn(f"rate_{name}", shrunk).withColumn(f"mean_{name}", F.lit(m))
    return out.select("host", "n", *(f"{kind}_{x}" for x in rules for kind in ("rate", "mean")))


def refused(rate: Column, mean: Column, limits: tuple[float, float, float] = REFUSED_FROM) -> Column:
    return rate >= F.greatest(F.lit(limits[0]), F.least(F.lit(limits[2]), limits[1] * mean))


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", refused_from: tuple[float, float, float] = REFUSED_FROM, strict_from: float = STRICT_FROM
) -> DataFrame:
    """id, METRICS, base_failed, host_rate, host_refused, host_broken and kept for each row of docs.

    host_rate is the host's shrunk rate of base failures; host_broken the rules on which the host is strict and which the
    row breaks. A row is kept if its own base rules hold, its host is not refused, and host_broken is empty. Null hosts
    have no verdict: their rows are judged by the base rules alone (host_rate null). Null and empty texts have no words and
    fail. Repeated rows count and are returned as often as they come; ties do not arise; a null id is passed through. An
    empty table gives an empty result. Columns other than those named are ignored.
    """
    measured = cut(metrics(docs, id_col, text_col, host_col), "metrics")
    rates = host_rates(measured, host_col)
    strict = [F.when(F.col(f"rate_{x}") > strict_from * F.col(f"mean_{x}"), F.lit(x)) for x in RULES]
    verdicts = rates.select(
        "host", F.col("rate_base").alias("host_rate"), refused(
            F.col("rate_base"), F.col("mean_base"), refused_from
        ).alias("host_refused"), F.array_compact(F.array(*strict)).alias("strict")
    )
    joined = measured.join(cut(verdicts, "host_verdicts"), F.col(host_col) == F.col("host"), "left")
    none = F.array().cast("array<string>")
    broken = F.array_compact(F.array(*(F.when(F.expr(rule), F.lit(name)) for name, rule in RULES.items())))
    broken = F.array_intersect(F.coalesce("strict", none), broken)
    out = joined.select(
        id_col,
        *METRICS,
        "base_failed",
        "host_rate",
        F.coalesce("host_refused", F.lit(False)).alias("host_refused"),
        broken.alias("host_broken"),
    )
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_refused") & (F.size("host_broken") == 0))
