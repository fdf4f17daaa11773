"""Quality rules with host-level verdicts.

Each document is tried against the base rules. Failures are summed by host (the source), a beta prior
is fitted to the hosts' rates by the method of moments, each host's rate is shrunk towards it, and
hosts whose shrunk rate is above HOST_RATE lose all their documents: a host of few documents can't be
condemned by one of them.

Everything is DataFrame functions. Repeats are found inside a row: the hashes of the 8-word windows are
sorted with their positions, equal neighbours are repeats, and the covered words follow from the gaps
between their positions. Nothing is shuffled but one row a host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, small, text_of, unused, words_of, written

LEAST_WORDS = 20
WINDOW = 8
#: Most hundredths of the words that may lie in repeated windows.
REPEAT_PERCENT = 30
#: A host whose shrunk failure rate is above this is dropped.
HOST_RATE = 0.8
SYMBOLS = r"[#*$%&|<>]"


def window_hashes(words: Column, window: int = WINDOW) -> Column:
    """A hash for each full window of words."""
    return F.when(
        F.size(words) >= window,
        F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)), lambda i: F.xxhash64(*[F.get(words, i + k - 1) for k in range(window)])),
    ).otherwise(F.array().cast("array<long>"))


def repeated_words(hashes: Column, window: int = WINDOW) -> Column:
    """Words covered by windows whose hash occurs more than once; hashes must be a plain column."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    def twin(p: Column, x: Column, k: Column) -> Column:
        before, after = F.get(p, k - 1)["h"], F.get(p, k + 1)["h"]
        return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

    # let-binding: a one-element array is transformed, so that the sorted array is made once
    at = F.get(F.transform(F.array(placed), lambda p: F.array_sort(F.transform(F.filter(p, lambda x, k: twin(p, x, k)), lambda x: x["i"]))), F.lit(0))
    covered = F.transform(F.array(at), lambda a: F.aggregate(
        F.transform(a, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(a, k + 1) - x, F.lit(window)))), F.lit(0).cast("long"), lambda s, x: s + x
    ))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.get(covered, F.lit(0))).otherwise(0).cast("long")


def base_figures(docs: DataFrame, names: dict[str, str], all_figures: bool = True) -> DataFrame:
    """docs with n_words, n_repeat_words and base_failed, and with word_chars, n_symbols and n_dup_lines where asked for.

    names: what the new columns are called.
    """
    words, hashes = unused(docs, "words_", "hashes_")
    text = text_of(F.col("text"))
    out = docs.withColumn(words, words_of(F.col("text")))
    out = out.withColumn(names["n_words"], F.size(words).cast("long")).withColumn(hashes, window_hashes(F.col(words)))
    out = out.withColumn(names["n_repeat_words"], repeated_words(F.col(hashes))).drop(words, hashes)
    if all_figures:
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
        out = out.withColumns({
            names["word_chars"]: F.char_length(F.regexp_replace(text, SPACE, "")).cast("long"),
            names["n_symbols"]: F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            names["n_dup_lines"]: F.get(F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)).cast("long"),
        })
    n, repeat = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    return out.withColumn(names["base_failed"], (n < LEAST_WORDS) | (repeat * 100 > n * REPEAT_PERCENT))


def host_verdicts(hosts: DataFrame, most: float = HOST_RATE) -> DataFrame:
    """hosts (host, n, failed: one row a host) with rate, the shrunk rate, and host_failed.

    Method of moments over hosts: mean m and variance v of the rates give a prior of strength
    m(1-m)/v - 1, at least 1; where the rates don't vary, the strength is the mean number of documents.
    """
    rates = hosts.withColumn("rate", F.col("failed") / F.col("n"))
    m, v, mean_n = rates.agg(F.avg("rate"), F.var_pop("rate"), F.avg("n")).first()
    m = m or 0.0
    strength = max(1.0, m * (1 - m) / v - 1) if v else mean_n or 1.0
    shrunk = (F.col("failed") + F.lit(m * strength)) / (F.col("n") + F.lit(strength))
    return rates.withColumn("host_rate", shrunk).withColumn("host_failed", F.col("host_rate") > most)


def judge(docs: DataFrame, host: str = "source", all_figures: bool = True, most: float = HOST_RATE, names: dict[str, str] | None = None) -> DataFrame:
    """docs with the base figures, base_failed, host_rate and kept.

    The figures are written to the shared folder once with the rows, summed by host, and the hosts'
    verdicts joined back (broadcast where counted as small). Null texts have no words and fail; null
    hosts are one host; repeated rows count each; an empty table stays empty. Columns of the same
    names are kept apart by `names`.
    """
    names = names or {n: n for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate", "kept")}
    kept = written(base_figures(docs, names, all_figures), "quality")
    hosts = kept.groupBy(F.col(f"`{host}`").alias("host")).agg(F.count("*").alias("n"), F.count_if(names["base_failed"]).alias("failed"))
    key, rate, bad = unused(kept, "host_key", "rate_", "host_failed")
    verdicts = small(host_verdicts(hosts, most).select(F.col("host").alias(key), F.col("host_rate").alias(rate), F.col("host_failed").alias(bad)))
    out = kept.join(verdicts, F.col(f"`{host}`").eqNullSafe(F.col(key))).withColumn(names["kept"], ~F.col(names["base_failed"]) & ~F.col(bad))
    return out.withColumnRenamed(rate, names["host_rate"]).drop(key, bad)


def quality_digest(docs: DataFrame) -> DataFrame:
    """doc_id, the base figures, base_failed and kept of every document; texts are read once and not kept."""
    light = base_figures(docs.select("doc_id", "source", "text"), {n: n for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")}).drop("text")
    kept = written(light, "quality")
    hosts = kept.groupBy(F.col("source").alias("host")).agg(F.count("*").alias("n"), F.count_if("base_failed").alias("failed"))
    verdicts = small(host_verdicts(hosts).select("host", "host_failed"))
    joined = kept.join(verdicts, F.col("source").eqNullSafe(F.col("host")))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"))


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns only."""
    wanted = ("n_words", "n_repeat_words", "base_failed", "host_rate", "kept")
    names = dict(zip(wanted, unused(docs, *wanted)))
    return judge(docs, all_figures=False, names=names).where(F.col(names["kept"])).select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8),
h AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS s FROM g),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM h) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY rid),
f AS (SELECT d.rid, doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN cov ON d.rid = cov.rid),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS failed FROM b GROUP BY source),
m AS (SELECT avg(failed / n) AS m, var_pop(failed / n) AS v, avg(n) AS mean_n FROM hosts),
p AS (SELECT m, CASE WHEN v > 0 THEN greatest(1.0, m * (1 - m) / v - 1) ELSE mean_n END AS s FROM m),
verdict AS (SELECT source, (failed + m * s) / (n + s) > 0.8 AS host_failed FROM hosts, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT host_failed AS kept
FROM b JOIN verdict ON b.source IS NOT DISTINCT FROM verdict.source
"""
