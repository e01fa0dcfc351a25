"""Quality rules as a bitmask ledger.

`ledger` evaluates every rule once per document and stores the measurements with one failure bit per rule.
A policy is a versioned mask over those bits: applying it, or a changed version of it, reads the ledger only.
`ablations` aggregates the bitmasks: what each rule of a policy removes, and what it alone removes.

Everything is built-in functions over the row's own text; nothing is shuffled to measure a document.

Defined results: a null text has no words and counts as empty; repeated rows each keep a row; extra columns
are left out; a null doc_id stays null; an empty table gives no rows. A text of any length is measured whole by one
task, in the JVM; windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

#: Rules in the order of their bits: name, and its failure as SQL over the measurements.
RULES = (
    ("too_few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("many_symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("capital_words", "2 * n_capital_words > n_words"),
)
BASE = ("too_few_words", "repeated_windows")
#: Versioned policies: the rules that reject a document.
POLICIES = {
    1: BASE,
    2: (*BASE, "many_symbols", "duplicate_lines"),
    3: (*BASE, "many_symbols", "duplicate_lines", "short_words", "long_words", "capital_words"),
}

_SPACE = r"[ \t-\r]+"


def mask(rules: tuple[str, ...]) -> int:
    bits = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    return sum(bits[r] for r in rules)


def _removed(text: Column, characters: str) -> Column:
    """How many of these single-byte characters the text holds."""
    return F.length(text) - F.length(reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, text))


def _repeated(window: int) -> str:
    """SQL for the number of words in windows found twice or more, over `n_words` and the windows' hashes `hashes`.

    Windows are sorted by hash and position; those equal to a neighbour give the covered positions, whose
    lengths are cut where the next one begins.
    """
    return f"""
    CASE WHEN size(array_distinct(hashes)) = size(hashes) THEN 0L ELSE
      aggregate(
        array_sort(flatten(map_values(map('p', transform(
          filter(
            transform(
              array(array_sort(transform(hashes, (h, i) -> struct(h AS h, i AS i)))),
              s -> transform(
                filter(sequence(0, size(s) - 1), k -> (k > 0 AND s[k].h = s[greatest(k - 1, 0)].h) OR (k < size(s) - 1 AND s[k].h = s[least(k + 1, size(s) - 1)].h)),
                k -> s[k].i
              )
            ),
            x -> size(x) > 0
          ),
          x -> x
        ))))[0]),
        struct(CAST(0 AS BIGINT) AS total, CAST(-{window} AS INT) AS last),
        (acc, p) -> struct(acc.total + least({window}, p - acc.last) AS total, p AS last),
        acc -> acc.total
      )
    END"""


def measure(documents: DataFrame, window: int = 8, whole_rows: bool = False) -> DataFrame:
    """doc_id and the measurements of the whole text; `whole_rows` adds the row itself as the struct `row`."""
    row = [F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row")] * whole_rows
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *row)
    rows = rows.withColumn("words", F.filter(F.split("text", _SPACE), lambda w: w != ""))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = rows.withColumn(
        "hashes",
        F.expr(f"CASE WHEN n_words < {window + 1} THEN CAST(array() AS ARRAY<BIGINT>) ELSE transform(sequence(1, CAST(n_words AS INT) - {window - 1}), i -> xxhash64(slice(words, i, {window}))) END"),
    )
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0))
    return rows.select(
        *["row"] * whole_rows,
        "doc_id",
        "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _removed(F.col("text"), "#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(_repeated(window)).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("words", lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) > 1))).cast("long").alias("n_capital_words"),
    )


def ledger(documents: DataFrame, window: int = 8, whole_rows: bool = False) -> DataFrame:
    """The measurements and `fail_bits`, one bit for each failed rule."""
    bits = [F.when(F.expr(test), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, test) in enumerate(RULES)]
    return measure(documents, window, whole_rows).withColumn("fail_bits", reduce(lambda a, b: a.bitwiseOR(b), bits))


def apply_policy(book: DataFrame, version: int) -> DataFrame:
    """The ledger with base_failed, and kept under a version of the policy."""
    failed = lambda rules: F.col("fail_bits").bitwiseAND(F.lit(mask(rules)).cast("long")) != 0
    return book.withColumns({"base_failed": failed(BASE), "kept": ~(failed(POLICIES[version]) | failed(BASE))})


def keep(documents: DataFrame, version: int) -> DataFrame:
    """The documents that a policy keeps, with all their columns."""
    # a filter on the bits themselves would be pushed below them, where every rule's text work would run again
    rejecting = F.lit(mask(POLICIES[version]) | mask(BASE)).cast("long")
    rows = ledger(documents, whole_rows=True).select("row", F.explode(F.array("fail_bits")).alias("bits"))
    return rows.where(F.col("bits").bitwiseAND(rejecting) == 0).select("row.*")


def ablations(book: DataFrame, version: int) -> DataFrame:
    """Per rule of a policy: the documents that fail it, and those kept if this rule alone were dropped.

    Documents are first counted by bitmask, so at most two to the number of rules rows are looked at.
    """
    counts = book.groupBy("fail_bits").count()
    whole = mask(POLICIES[version])
    rules = [(name, 1 << i) for i, (name, _) in enumerate(RULES) if name in POLICIES[version]]
    tests = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in rules]))
    rows = counts.select("fail_bits", "count", tests.alias("r")).select("fail_bits", "count", "r.*")
    seen = F.col("fail_bits").bitwiseAND(F.lit(whole).cast("long"))
    return rows.groupBy("rule", "bit").agg(
        F.sum(F.when(seen.bitwiseAND(F.col("bit")) != 0, F.col("count")).otherwise(0)).alias("failed"),
        F.sum(F.when(seen == F.col("bit"), F.col("count")).otherwise(0)).alias("failed_alone"),
    )


#: The policy of the query and the pipeline.
VERSION = 2


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger and verdict of every row of `documents`."""
    rows = apply_policy(ledger(common.table(spark, sf_dir, "documents")), VERSION)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


def _sql() -> str:
    bits = " + ".join(f"CASE WHEN {test} THEN {1 << i} ELSE 0 END" for i, (_, test) in enumerate(RULES))
    space = r"[^\x20\x09-\x0D]+"
    return f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, r, text, regexp_extract_all(text, '{space}') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{space}')) AS lines FROM d),
p AS (
  SELECT r, unnest(range(1, len(words) - 6)) AS i, words FROM w WHERE len(words) > 8),
g AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS g FROM p),
q AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g),
x AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS j FROM q WHERE c > 1),
n AS (SELECT r, sum(CASE WHEN j IS NULL THEN 8 ELSE least(8, j - i) END) AS n_repeat_words FROM x GROUP BY r),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(list_filter(words, lambda x: x = upper(x) AND x <> lower(x) AND length(x) > 1)) AS BIGINT) AS n_capital_words
  FROM w LEFT JOIN n ON w.r = n.r),
l AS (SELECT *, CAST({bits} AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  fail_bits & {mask(BASE)} <> 0 AS base_failed, fail_bits & {mask(POLICIES[VERSION]) | mask(BASE)} = 0 AS kept, fail_bits
FROM l"""


QUERIES = {"op7_rules": op7_rules}
SQL = {"op7_rules": _sql()}
