"""Secret scans over every version of every document, kept in an incremental blob ledger.

A text is addressed by its SHA-256 (a *blob*). The ledger has, for each blob, the rule versions it
has been scanned for and the spans they found. A scan hashes all versions, takes the (blob, rule
version) pairs that the ledger lacks, runs only those, appends them, and joins the findings back to all
paths that hold the blob, so a text on a thousand paths or in ten commits is scanned once for each rule
version. DataFrame functions only.

Spans are in code points, end exclusive. An assignment counts by the length of its value alone, without keyword and sign. ``split`` by a rule's pattern gives the texts between its leftmost
non-overlapping matches, ``regexp_extract_all`` the matches; a running sum of their lengths gives the positions.

Results for odd input: a NULL text counts as empty; empty texts have no spans; rows with equal or
NULL ids give a row each; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_names, table, written


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches one character at least. ``value``: a pattern whose group 1 is, in a match, the part that
    must have ``least`` characters; without it every match counts."""
    kind: str
    pattern: str
    value: str = ""
    least: int = 0
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def keeps(self, m: Column) -> Column:
        return F.length(F.regexp_extract(m, self.value, 1)) >= self.least if self.value else F.lit(True)


# fixed values of the scan: kinds in the order that breaks ties, patterns, least lengths
_VALUE = "[A-Za-z0-9+/_.=-]+"
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
RULES = (
    Rule("assign", _ASSIGN + _VALUE, f"^{_ASSIGN}({_VALUE})", 8, version=2),
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}"),
    # added to the base kinds
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")
SPAN = "struct<start:int,rank:int,end:int,kind:string>"      # sorts by start, then by the rule's place
LEDGER = f"blob string, scanned array<string>, spans array<{SPAN}>"
MASK = "[SECRET]"


def _paths(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("blob"))


def _matches(rule: Rule, rank: int) -> Column:
    """The matches and the lengths of the gaps before them; NULL without a match, or if not due."""
    m = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    hit = F.array_contains("todo", rule.key) & F.col("text").rlike(rule.pattern)
    return F.when(hit, F.struct(
        F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"),
        F.transform(F.split("text", rule.pattern, -1), lambda g: F.length(g)).alias("gaps"),
        m.alias("ms")))


def scan_blobs(paths: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None) -> DataFrame:
    """New ledger rows: for each blob with pairs the ledger lacks, those pairs and their spans."""
    due = F.array(*(F.lit(r.key) for r in rules))
    blobs = paths.groupBy("blob").agg(F.first("text").alias("text"))     # copies meet map-side first
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("seen"))
        blobs = (blobs.join(seen, "blob", "left")
                 .withColumn("todo", F.array_except(due, F.coalesce("seen", F.array().cast("array<string>"))))
                 .filter(F.size("todo") > 0))
    else:
        blobs = blobs.withColumn("todo", due)
    hits = F.array_compact(F.array(*(_matches(r, i) for i, r in enumerate(rules))))
    scanned = written(blobs.select("blob", F.col("todo").alias("scanned"), hits.alias("hits")), "scanned")

    keep = F.lit(False)
    for r in rules:
        keep = keep | ((F.col("kind") == r.kind) & r.keeps(F.col("m")))
    so_far = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (scanned.select("blob", F.explode("hits").alias("h"))
             .select("blob", "h.rank", "h.kind", F.posexplode(F.arrays_zip("h.gaps", "h.ms")).alias("i", "z"))
             .select("blob", "rank", "kind", "i", F.col("z.gaps").alias("gap"), F.col("z.ms").alias("m"))
             .filter("m is not null")                                    # the gap after the last match
             .withColumn("end", F.sum(F.col("gap") + F.length("m")).over(so_far).cast("int"))
             .filter(keep)
             .groupBy("blob").agg(F.sort_array(F.collect_list(F.struct(
                 (F.col("end") - F.length("m")).alias("start"), "rank", "end", "kind").cast(SPAN))).alias("spans")))
    return (scanned.select("blob", "scanned").join(spans, "blob", "left")
            .withColumn("spans", F.coalesce("spans", F.array().cast(f"array<{SPAN}>"))))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
         id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, blob, spans) of each row of ``docs``, and the ledger rows that the scan adds.

    ``docs`` may hold any number of versions of a path. Keep the added rows and pass them, with the earlier
    ones, as ``ledger`` next time. Spans come from the rule versions passed, whenever they ran.
    """
    paths = _paths(docs, id_col, text_col)
    added = written(scan_blobs(paths, rules, ledger), "ledger")
    rows = added if ledger is None else ledger.select("blob", "scanned", "spans").unionByName(added)
    # a row's spans of a kind are those of the version that the row was scanned for
    passed = [F.when(F.array_contains("scanned", r.key), F.lit(r.kind)) for r in rules]
    found = (rows.filter(F.size("spans") > 0)
             .withColumn("kinds", F.array_compact(F.array(*passed)))
             .withColumn("spans", F.filter("spans", lambda s: F.array_contains("kinds", s["kind"])))
             .groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")))
    return (paths.select("doc_id", "blob").join(found, "blob", "left")
            .select("doc_id", "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans")), added)


def mask(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mark, and ``n_chars`` to match; no row goes, and no column
    is lost, whatever its name. NULL stays NULL; repeated rows and rows without a doc_id are masked like any other."""
    b, blob, spans, m = free_names(docs, "own_blob", "blob", "spans", "merged")
    found, _ = scan(docs, ledger, rules)
    found = found.filter(F.size("spans") > 0).select(F.col("blob").alias(blob), F.col("spans").alias(spans)).dropDuplicates([blob])
    merged = F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] < F.element_at(acc, -1)["end"]),
        F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"),
            F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    starts = F.concat(F.transform(m, lambda s: s["start"]), F.array(F.length("text")))
    ends = F.concat(F.array(F.lit(0)), F.transform(m, lambda s: s["end"]))
    parts = F.zip_with(ends, starts, lambda e, s: F.substring(F.col("text"), e + 1, s - e))
    cols = docs.columns
    out = (docs.withColumn(b, F.sha2(F.coalesce("text", F.lit("")), 256))
           .join(found, F.col(b) == F.col(blob), "left")
           .withColumn(m, F.when(F.col(spans).isNotNull(), merged))
           .withColumn("text", F.when(F.col(m).isNotNull(), F.concat_ws(MASK, parts)).otherwise(F.col("text"))))
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.when(F.col(m).isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*(F.col(f"`{c}`") for c in cols))


def written_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole document; the ledger starts empty."""
    found, _ = scan(table(spark, sf_dir, "documents"))
    count = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(F.col("doc_id").cast("bigint").alias("doc_id"), *count,
                        F.sha2(written_spans(base), 256).alias("base_sha256"),
                        written_spans(F.col("spans")).alias("spans"))


_FIND = "\n".join(f"""UNION ALL SELECT doc_id, {i} AS rank, '{kind}' AS kind,
       unnest(range(1, len(m) + 1)) AS i, g, m
  FROM (SELECT doc_id, regexp_split_to_array(text, '{pat}') AS g, regexp_extract_all(text, '{pat}') AS m FROM d) WHERE len(m) > 0"""
                  for i, (kind, pat) in enumerate((r.kind, r.pattern.replace("'", "''")) for r in RULES)).removeprefix("UNION ALL ")

#: DuckDB: positions from the lengths of what lies between the matches.
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({_FIND}),
p AS (SELECT doc_id, rank, kind, m[i] AS m,
             list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s
      FROM f),
k AS (SELECT doc_id, rank, kind, CAST(s AS BIGINT) AS s, CAST(s + length(m) AS BIGINT) AS e FROM p
      WHERE kind <> 'assign' OR length(regexp_extract(m, '{RULES[0].value.replace("'", "''")}', 1)) >= {RULES[0].least}),
a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
      FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""
