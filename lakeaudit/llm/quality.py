"""Host-level quality rules, in DataFrame functions only.

1. ``measures`` computes every document's figures inside its own row; no word leaves its row.
2. ``host_rates`` counts, per host, the documents and the failures of every rule. The counts are
   combined before the shuffle, so a host with a third of the documents is one row per task.
3. Each rule's failure rates are shrunk towards the corpus with a beta prior whose mean and strength
   come from the hosts themselves (method of moments): ``(failed + mean * strength) / (docs +
   strength)``. Hosts with few documents keep near the mean, large ones near their own rate.
4. A host is condemned if the shrunk rate of any rule exceeds ``limit``. Verdicts join the documents
   through a salted key, so a hot host is spread over tasks.

Defined results
  * A null text has no words, fails the length rule and is counted. An empty table gives an empty one.
  * Documents with a null host are judged alone: they are on no host, so no host condemns them.
  * Repeated rows are documents each. Only the named columns are read, so others cannot clash.
  * Three-word windows are compared by 64-bit hashes of their words within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import durable, salted_join, table

_SPACE = "[\\x20\\x09-\\x0D]+"
_SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: A host is condemned when more than this part of its documents is expected to fail one rule.
LIMIT = 0.5


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once; lambdas would compute it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """How many words lie in three-word windows found twice or more in the array."""
    def covered(starts: Column) -> Column:
        # windows are three words wide, so a start covers what is left before the next start
        parts = F.transform(starts, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - p, F.lit(3))))
        return F.aggregate(parts, F.lit(0), lambda total, x: total + x)

    def repeats(ordered: Column) -> Column:
        def same(x: Column, i: Column) -> Column:
            return (F.get(ordered, i - 1)["gram"] == x["gram"]) | (F.get(ordered, i + 1)["gram"] == x["gram"])
        twice = F.filter(ordered, same)
        return _let(F.sort_array(F.transform(twice, lambda x: x["at"])), covered)

    def windows(w: Column) -> Column:
        grams = F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

        def judged(g: Column) -> Column:
            ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("gram"), i.alias("at"))))
            return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(_let(ordered, repeats))
        return _let(grams, judged)

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(words, windows))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the figures of every document that the rules look at."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, _SPACE_CHARS, "") != "")
    return docs.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(text, _SPACE_CHARS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(words).cast("long"),
    })


#: Rules on a document's figures. The first two are fixed by the contract of the query.
RULES = {
    "too_short": "n_words < 50",
    "repetitive": "n_repeat_words * 100 > n_words * 50",
    "symbols": "n_symbols * 10 > n_words",
    "odd_word_length": "word_chars < n_words * 3 or word_chars > n_words * 10",
    "repeated_lines": "n_dup_lines * 10 > n_words",
}
BASE_RULES = ("too_short", "repetitive")


def host_rates(judged: DataFrame, host: str, rules: list[str]) -> DataFrame:
    """(host, docs, failed_<rule>, rate_<rule>): failure rates shrunk by a beta prior per rule.

    The prior's mean m is the rate of the whole corpus. Its strength is m(1 - m) / v - 1, where v is
    the variance of the hosts' rates weighted by documents, less what sampling adds to it. Hosts that
    agree give a strong prior (at most ``10**6`` documents), hosts that differ a weak one (at least 1).
    """
    counted = judged.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count(F.lit(1)).alias("docs"), *[F.sum(F.col(r).cast("long")).alias(f"failed_{r}") for r in rules])
    counted = durable(counted)  # a row per host, read by the prior and by the verdicts
    docs = F.col("docs").cast("double")
    sums = [F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("hosts")]
    for r in rules:
        failed = F.col(f"failed_{r}").cast("double")
        sums += [F.sum(failed).alias(f"f_{r}"), F.sum(failed * failed / docs).alias(f"q_{r}")]
    total = counted.agg(*sums).first()  # one row
    rates = {}
    for r in rules:
        n = float(total["docs"] or 1)
        mean = float(total[f"f_{r}"] or 0.0) / n
        spread = mean * (1 - mean)
        variance = max(float(total[f"q_{r}"] or 0.0) / n - mean * mean, 0.0)
        between = max(variance - spread * float(total["hosts"] - 1) / n, 0.0) if total["docs"] else 0.0
        strength = min(max(spread / between - 1, 1.0), 1e6) if between > 0 else 1e6
        rates[f"rate_{r}"] = (F.col(f"failed_{r}") + F.lit(mean * strength)) / (docs + F.lit(strength))
    return counted.withColumns(rates)


def host_rules(docs: DataFrame, host: str = "source", text_col: str = "text", limit: float = LIMIT,
               keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, the figures, ``base_failed``, ``host_failed`` and ``kept`` of every document."""
    rules = list(RULES)
    slim = docs.select(*keep, F.col(host).alias("_host"), F.col(text_col).alias("_text"))
    figures = measures(slim, "_text").drop("_text").withColumns({r: F.expr(test) for r, test in RULES.items()})
    figures = durable(figures)  # numbers only; the texts are read once
    rates = host_rates(figures, "_host", rules)
    condemned = F.greatest(*[F.col(f"rate_{r}") for r in rules]) > F.lit(limit)
    verdicts = rates.select("_host", condemned.alias("host_failed"))
    joined = salted_join(figures, verdicts, ["_host"], "left", spread=F.xxhash64(*keep))
    base_failed = F.greatest(*[F.col(r) for r in BASE_RULES])
    host_failed = F.coalesce("host_failed", F.lit(False))
    return joined.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & ~host_failed).alias("kept"), host_failed.alias("host_failed"))


def op3(spark, sf_dir: str) -> DataFrame:
    return host_rules(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT row_no, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), grams AS (
  SELECT row_no, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT row_no, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), twice AS (
  SELECT row_no, i FROM (SELECT *, count(*) OVER (PARTITION BY row_no, a, b, c) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT row_no, count(DISTINCT i + j) AS n_repeat_words FROM twice, range(3) AS r(j) GROUP BY row_no
), lines AS (
  SELECT row_no, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT row_no, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_no
), m AS (
  SELECT d.row_no, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN w USING (row_no) LEFT JOIN covered USING (row_no) LEFT JOIN lines USING (row_no)
), j AS (
  SELECT *, n_words < 50 AS r1, 100 * n_repeat_words > 50 * n_words AS r2, 10 * n_symbols > n_words AS r3,
         word_chars < 3 * n_words OR word_chars > 10 * n_words AS r4, 10 * n_dup_lines > n_words AS r5 FROM m
), fails AS (
  UNPIVOT (SELECT row_no, source, r1, r2, r3, r4, r5 FROM j) ON r1, r2, r3, r4, r5 INTO NAME rule VALUE failed
), h AS (
  SELECT source, rule, count(*) AS docs, sum(CAST(failed AS BIGINT)) AS f FROM fails WHERE source IS NOT NULL
  GROUP BY ALL
), p AS (
  SELECT rule, CAST(sum(docs) AS DOUBLE) AS n, sum(f) / sum(docs) AS mean, count(*) AS hosts,
         sum(f * f / docs) / sum(docs) - (sum(f) / sum(docs)) ** 2 AS var FROM h GROUP BY rule
), s AS (
  SELECT *, greatest(greatest(var, 0) - mean * (1 - mean) * (hosts - 1) / n, 0) AS between_hosts FROM p
), strength AS (
  SELECT rule, mean, CASE WHEN between_hosts > 0
         THEN least(greatest(mean * (1 - mean) / between_hosts - 1, 1), 1e6) ELSE 1e6 END AS k FROM s
), verdict AS (
  SELECT source, bool_or((f + mean * k) / (docs + k) > 0.5) AS host_failed FROM h JOIN strength USING (rule)
  GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r1 OR r2 AS base_failed,
       NOT (r1 OR r2) AND NOT coalesce(host_failed, false) AS kept, coalesce(host_failed, false) AS host_failed
FROM j LEFT JOIN verdict USING (source)
"""
