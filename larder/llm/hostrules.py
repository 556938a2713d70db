"""Quality rules judged by host: document rule failures, shrunk host rates, host verdicts.

Everything is built-in expressions: counts come from array functions inside one row, the
host table is one partial aggregate, the verdicts join back on the host. A host's failure
rate for a rule is shrunk towards all hosts by a beta prior whose mean and strength are
fitted to the hosts' rates (method of moments), so a host with few documents is not
condemned on thin evidence.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, quoted, table

BLANK = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Document rules over the feature columns; true means the document fails the rule.
RULES = {
    "short": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
}
#: Rules that reject a document whatever its host is.
BASE_RULES = ("short", "repeats")
#: A host is rejected if its shrunk failure rate for any rule is above this.
MAX_HOST_RATE = 0.5
#: Bounds of the prior's strength, in documents.
PRIOR_STRENGTH = (2.0, 10_000.0)


def _repeat_words(hashes: Column, ordered: Column) -> Column:
    """Words in windows found twice: ``ordered`` holds (hash, start) sorted by hash."""
    twice = F.filter(ordered, lambda x, i: F.coalesce(x["h"] == F.get(ordered, i - 1)["h"], F.lit(False))
                     | F.coalesce(x["h"] == F.get(ordered, i + 1)["h"], F.lit(False)))
    starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(starts, zero, lambda a, p: F.struct(
        (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")))
    return covered["n"]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row for each row of ``docs``: id, host and the counts the rules are about.

    A null text has no words and no lines. Windows are compared by a 64-bit hash of their
    words, within one text only.
    """
    text = F.coalesce(quoted(text_col), F.lit(""))
    trimmed = F.btrim(F.col("text"), F.lit(BLANK))
    blank_run = f"[{BLANK}]+"
    none = F.array().cast("array<string>")
    bare = F.regexp_replace("text", blank_run, "")
    df = docs.select(quoted(id_col).alias("id"), quoted(host_col).alias("host"), text.alias("text"))
    df = df.select(
        "id", "host",
        F.when(trimmed == "", none).otherwise(F.split(trimmed, blank_run)).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "").alias("lines"),
        F.char_length(bare).cast("bigint").alias("word_chars"),
        F.char_length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
    )
    word = lambda i: [F.get(F.col("words"), i + k) for k in range(WINDOW)]
    df = df.select(
        "id", "host", "word_chars", "n_symbols", F.size("words").cast("bigint").alias("n_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("words") >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size("words") - WINDOW), lambda i: F.xxhash64(*word(i)))).alias("hashes"))
    df = df.select("*", F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("ordered"))
    return df.select("id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                     F.coalesce(_repeat_words(F.col("hashes"), F.col("ordered")), F.lit(0)).cast("bigint").alias("n_repeat_words"))


def host_rates(found: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """(host, n, <rule>...) failures of each rule by non-null host."""
    fails = [F.sum(F.expr(sql).cast("bigint")).alias(name) for name, sql in rules.items()]
    return found.where("host IS NOT NULL").groupBy("host").agg(F.count("*").alias("n"), *fails)


def beta_priors(hosts: DataFrame, rules: Mapping[str, str] = RULES) -> dict[str, tuple[float, float]]:
    """(alpha, beta) of each rule's prior, from one row of sums over the host table.

    The mean is the failure rate over all documents. The strength comes from the spread of
    host rates beyond what sampling alone gives; without such spread it is the upper bound.
    """
    sums = [F.count("*").alias("hosts"), F.sum("n").alias("n"), F.sum(1 / F.col("n")).alias("inv")]
    for r in rules:
        rate = F.col(r) / F.col("n")
        sums += [F.sum(r).alias(f"{r}_f"), F.sum(rate).alias(f"{r}_r"), F.sum(rate * rate).alias(f"{r}_rr")]
    row = hosts.agg(*sums).first()
    priors = {}
    for r in rules:
        if not row["hosts"]:
            priors[r] = (1.0, 1.0)
            continue
        mean = (row[f"{r}_f"] + 0.5) / (row["n"] + 1.0)
        spread = row[f"{r}_rr"] / row["hosts"] - 2 * mean * row[f"{r}_r"] / row["hosts"] + mean * mean
        between = spread - mean * (1 - mean) * row["inv"] / row["hosts"]
        strength = mean * (1 - mean) / between - 1 if between > 0 else PRIOR_STRENGTH[1]
        strength = min(max(strength, PRIOR_STRENGTH[0]), PRIOR_STRENGTH[1])
        priors[r] = (mean * strength, (1 - mean) * strength)
    return priors


def host_verdicts(found: DataFrame, rules: Mapping[str, str] = RULES, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, host_docs, host_rate, host_rejected): the largest shrunk failure rate of each host."""
    hosts = host_rates(found, rules)
    priors = beta_priors(hosts, rules)
    shrunk = [(F.col(r) + F.lit(a)) / (F.col("n") + F.lit(a + b)) for r, (a, b) in priors.items()]
    worst = F.greatest(*shrunk) if len(shrunk) > 1 else shrunk[0]
    return hosts.select("host", F.col("n").alias("host_docs"), worst.alias("host_rate"), (worst > max_rate).alias("host_rejected"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          rules: Mapping[str, str] = RULES, base: tuple[str, ...] = BASE_RULES, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Features, ``base_failed``, ``host_rejected`` and ``kept`` for each row of ``docs``.

    A null host is no host: such rows count for no host and are judged by the base rules
    alone. Null and empty texts fail the rule on short texts. Repeated rows are judged and
    counted as often as they come; an empty table gives no rows; other columns are not read.
    """
    found = materialise(features(docs, id_col, text_col, host_col), "hostrules-features")
    verdicts = host_verdicts(found, rules, max_rate)
    failed = F.expr(" OR ".join(f"({rules[r]})" for r in base))
    rejected = F.coalesce("host_rejected", F.lit(False))
    return (found.join(verdicts, "host", "left")
            .select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), rejected.alias("host_rejected"), (~failed & ~rejected).alias("kept")))


def op9_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


#: The same rows in SQL. The prior is refitted there from the same sums.
OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
         row_number() OVER () AS u
  FROM documents),
win AS (SELECT u, w, unnest(range(1, len(w) - 3)) AS i FROM d),
rep AS (SELECT u, i, count(*) OVER (PARTITION BY u, w[i:i+4]) AS c FROM win),
cov AS (SELECT u, count(DISTINCT i + k) AS n FROM (SELECT u, i, unnest(range(0, 5)) AS k FROM rep WHERE c > 1) GROUP BY u),
f AS (
  SELECT d.doc_id, d.source, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN cov USING (u)),
r AS (SELECT *, n_words < 10 AS short, 100 * n_repeat_words > 20 * n_words AS repeats,
             10 * n_symbols > n_words AS symbols, 10 * n_dup_lines > 3 * n_lines AS dup_lines FROM f),
long AS (SELECT source, rule, count(*) AS n, sum(fail::INT) AS f
         FROM (SELECT source, unnest(['short', 'repeats', 'symbols', 'dup_lines']) AS rule,
                      unnest([short, repeats, symbols, dup_lines]) AS fail FROM r WHERE source IS NOT NULL) GROUP BY ALL),
m AS (SELECT rule, (sum(f) + 0.5) / (sum(n) + 1.0) AS mean, avg((f / n) * (f / n)) AS rr, avg(f / n) AS rt, avg(1.0 / n) AS inv
      FROM long GROUP BY rule),
s AS (SELECT rule, mean, rr - 2 * mean * rt + mean * mean - mean * (1 - mean) * inv AS btw FROM m),
p AS (SELECT rule, mean, CASE WHEN btw > 0 THEN least(greatest(mean * (1 - mean) / btw - 1, 2.0), 10000.0) ELSE 10000.0 END AS st FROM s),
v AS (SELECT source, max((f + mean * st) / (n + st)) > 0.5 AS bad FROM long JOIN p USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (short OR repeats) AS base_failed,
       coalesce(bad, false) AS host_rejected, NOT (short OR repeats) AND NOT coalesce(bad, false) AS kept
FROM r LEFT JOIN v USING (source)
"""
