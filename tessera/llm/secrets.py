"""Secret scans as an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. A ledger is a folder of Parquet with one row for each blob and scan:
which rules, by name and version, were run on the blob, and the spans they found. `update` looks for the pairs of blob and rule version that
the ledger lacks, and scans only these: each text once, however many paths and versions hold it; a new rule or version runs alone over the old blobs. `findings` joins the ledger's spans back
to every row.

Everything is built-in functions. A rule is one pass of `regexp_extract_all`; only a text with matches is split at them too, and the lengths of pieces and matches add up to
code point positions. Running sums go by chunks of 512 matches, so that a text with very many costs little more than one with few.

Copies are folded by hash before the texts are shuffled (a task sends a blob once), texts that the ledger knows aren't shuffled where the unknown hashes are few
(adaptive execution then broadcasts these, by size), and the join back is one that adaptive execution can split where a blob has very many rows. A row's ledger entry grows with its own text only.

Appending is one Spark write: a lost executor's tasks run again, and a failed write leaves the ledger as it was. One writer at a time.

Defined results: a null text is empty; empty tables give no rows; repeated rows, rows of one path and rows without an id each keep a row; extra columns stay in `findings`, unless they
are called as its own two; spans are in code points, end exclusive, ordered by start and then by the order of RULES; spans of different rules may overlap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """`least` characters of group `part` of a match make it a finding; `needs` is a text that every match holds."""

    kind: str
    version: int
    pattern: str
    part: int = 0
    least: int = 1
    needs: str | None = None

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


_KEYWORDS = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
BASE = (
    Rule("assign", 1, f"""({_KEYWORDS})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, "AKIA"),
    # runs of less than 24 characters fail: a run is found from its start, so they needn't be matched at all
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
#: Formats of tokens that are published by those who issue them.
RULES = (
    *BASE,
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", needs="PRIVATE KEY-----"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", needs="gh"),
    Rule("slack", 1, r"xox[abeprs]-[A-Za-z0-9-]{20,}", needs="xox"),
    Rule("google", 1, r"AIza[A-Za-z0-9_-]{35}", needs="AIza"),
    Rule("stripe", 1, r"[rs]k_live_[A-Za-z0-9]{24,}", needs="k_live_"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}", needs="eyJ"),
    Rule("url_login", 1, r"[A-Za-z][A-Za-z0-9+.-]*://[^\s/:@]+:[^\s/:@]{3,}@[A-Za-z0-9]", needs="://"),
)
_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"
_LEDGER = "blob binary, rules array<string>, found array<struct<rule:string,start:bigint,end:bigint>>"
_CHUNK = 512


def blob(text: Column) -> Column:
    """The address of a text: its SHA-256."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _positions(rule: Rule, hits: str) -> str:
    """SQL for the spans of the matches `hits` of `text`, from the lengths of the pieces between them."""
    steps = f"zip_with({hits}, slice(split(text, {_sql(rule.pattern)}, -1), 1, size({hits})), (m, gap) -> struct(CAST(length(gap) AS BIGINT) AS gap, CAST(length(m) AS BIGINT) AS len, m AS m))"
    chunks = f"transform(sequence(0, (size(s) - 1) div {_CHUNK}), b -> slice(s, b * {_CHUNK} + 1, {_CHUNK}))"
    total = "aggregate({}, 0L, (a, x) -> a + x.gap + x.len)"
    starts = f"transform(c, (x, b) -> aggregate(slice(c, 1, b), 0L, (a, y) -> a + {total.format('y')}))"
    inside = f"transform(c[b], (x, i) -> struct(x.m AS m, z + x.gap + {total.format('slice(c[b], 1, i)')} AS start, x.len AS len))"
    # one-element arrays name a value that is used more than once
    spans = f"flatten(transform(array({steps}), s -> flatten(flatten(transform(array({chunks}), c -> transform({starts}, (z, b) -> {inside}))))))"
    enough = f"length(regexp_extract(x.m, {_sql(rule.pattern)}, {rule.part})) >= {rule.least}" if rule.part else f"x.len >= {rule.least}"
    return f"transform(filter({spans}, x -> {enough}), x -> struct({_sql(rule.key)} AS rule, x.start AS start, x.start + x.len AS end))"


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of (blob, text, todo): the rules whose keys `todo` lists are run."""
    none = "CAST(array() AS array<string>)"
    for i, rule in enumerate(rules):
        wanted = f"array_contains(todo, {_sql(rule.key)})" + (f" AND contains(text, {_sql(rule.needs)})" if rule.needs else "")
        blobs = blobs.withColumn(f"hits{i}", F.expr(f"CASE WHEN {wanted} THEN regexp_extract_all(text, {_sql(rule.pattern)}, 0) ELSE {none} END"))
    found = [F.expr(f"CASE WHEN size(hits{i}) > 0 THEN {_positions(rule, f'hits{i}')} ELSE CAST(array() AS array<struct<rule:string,start:bigint,end:bigint>>) END") for i, rule in enumerate(rules)]
    return blobs.select("blob", F.col("todo").alias("rules"), F.concat(*found).alias("found"))


def exists(spark: SparkSession, ledger: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(_LEDGER).parquet(ledger)


def unseen(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """(blob, text, todo): every text that has rules to be run on it, once, with their keys."""
    spark = versions.sparkSession
    keys = F.array(*(F.lit(r.key) for r in rules))
    rows = versions.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).select(blob(F.col("text")).alias("blob"), "text")
    if not exists(spark, ledger):
        return rows.dropDuplicates(["blob"]).withColumn("todo", keys)
    seen = read(spark, ledger).select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    open_ = rows.select("blob").distinct().join(seen, "blob", "left").withColumn("todo", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))))
    return rows.join(open_.where(F.size("todo") > 0).select("blob", "todo"), "blob").dropDuplicates(["blob"])


def update(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
    """Scan what the ledger lacks of these versions and append it."""
    common.without_old_shuffles(versions.sparkSession)
    scan(unseen(versions, ledger, rules, text), rules).write.mode("append").option("compression", "zstd").parquet(ledger)


def findings(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Every row of `versions` with `blob` and `spans`, array of (start, kind as its place in `rules`, end) in order."""
    kinds = F.map_from_arrays(F.array(*(F.lit(r.key) for r in rules)), F.array(*(F.lit(i) for i in range(len(rules)))))
    each = read(versions.sparkSession, ledger).select("blob", F.explode("found").alias("f"))
    each = each.withColumn("kind", F.try_element_at(kinds, F.col("f.rule"))).where(F.col("kind").isNotNull())
    by_blob = each.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("f.start", "kind", "f.end"))).alias("spans"))
    own = [F.col(f"`{c}`") for c in versions.columns if c not in ("blob", "spans")]
    rows = versions.select(F.struct(*own).alias("row"), blob(F.col(f"`{text}`")).alias("blob"))
    return rows.join(by_blob, "blob", "left").select("row.*", "blob", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(documents: DataFrame, ledger: str) -> DataFrame:
    """doc_id, counts of base kinds, the digest of base spans, all spans."""
    rows = findings(documents.select(F.col("doc_id").cast("long"), "text"), ledger).drop("text")
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = {i})) AS BIGINT)").alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    base = listed(F.filter("spans", lambda s: s["kind"] < len(BASE)))
    return rows.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in every text of `documents`, by a ledger that begins empty."""
    docs, ledger = common.table(spark, sf_dir, "documents"), common.fresh_path(spark, "secrets")
    update(docs, ledger)
    return report(docs, ledger)


def _oracle() -> str:
    def spans(i: int, r: Rule) -> str:
        enough = f"length(regexp_extract(m, $${r.pattern}$$, {r.part})) >= {r.least}"
        return f"""
  SELECT r, {i} AS k, '{r.kind}' AS kind, start, start + length(m) AS stop FROM (
    SELECT r, m, i, sum(length(gap) + length(m)) OVER (PARTITION BY r ORDER BY i) - length(m) AS start FROM (
      SELECT r, unnest(h) AS m, unnest(g[:len(h)]) AS gap, unnest(range(len(h))) AS i FROM (
        SELECT r, regexp_extract_all(text, $${r.pattern}$$) AS h, string_split_regex(text, $${r.pattern}$$) AS g FROM d WHERE regexp_matches(text, $${r.pattern}$$))))
  WHERE {enough}"""

    every = " UNION ALL ".join(spans(i, r) for i, r in enumerate(RULES))
    joined = lambda where: f"coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k){where}, '')"
    base = f" FILTER (WHERE k < {len(BASE)})"
    counts = ", ".join(f"count(*) FILTER (WHERE k = {i}) AS n_{r.kind}" for i, r in enumerate(BASE))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({every})
SELECT any_value(d.doc_id) AS doc_id, {counts}, sha256({joined(base)}) AS base_sha256, {joined('')} AS spans
FROM d LEFT JOIN s ON d.r = s.r GROUP BY d.r"""


QUERIES = {"op13_secrets": op13_secrets}
SQL = {"op13_secrets": _oracle()}
