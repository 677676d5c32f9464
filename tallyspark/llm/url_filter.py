"""URL filters: rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens that every URL it fits must hold. Tokens are counted
over all URLs, and each rule is filed under its rarest one. A URL's tokens fetch the rules filed under
them, and only those run their expression. Host rules win by length; where none fits, the general pattern
rules decide (one that fits blocks), else the URL is allowed. Rules are parameters, not data; the driver gets one count for each
rule token.

Results for odd input: a NULL URL, or one without ``://``, has empty host and path, no rule, and is allowed unless a pattern
fits it; each row gives a row, NULL and repeated ids included; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table

# fixed rules of the query: host and path, verdict
HOST_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
              ("com/fr/", "allow"), ("com/de/", "block"))
# the method's own: a token that must occur, and the pattern on the lower-case URL
PATTERN_RULES = (("casino", r"[./-]casino[./-]"), ("xxx", r"[./-]xxx[./-]"), ("doubleclick", r"[./]doubleclick\."),
                 ("adserver", r"[./]adserver\."), ("sessionid", r"[?&;]sessionid="), ("phpsessid", r"[?&;]phpsessid="),
                 ("login", r"/wp-login\.php"), ("exe", r"\.exe(?:[?#]|$)"), ("zip", r"\.zip(?:[?#]|$)"))
_TOKEN = re.compile(r"[a-z0-9]+")
SCHEMA = "page_id bigint, host string, path string, rule string, verdict string"


@dataclass(frozen=True)
class Rule:
    name: str | None            # of a host rule
    verdict: str
    pattern: str                # of a host rule on host + path, else on the lower-case URL
    tokens: tuple[str, ...]     # whole tokens that a URL it fits must hold; none: always run


def rules_of(hosts=HOST_RULES, patterns=PATTERN_RULES) -> list[Rule]:
    out = []
    for name, verdict in hosts:
        # the last token may go on in the URL, unless the rule ends in a separator
        whole = [m[0] for m in _TOKEN.finditer(name.lower()) if m.end() < len(name)]
        out.append(Rule(name, verdict, r"(?:[^/?#]*\.)?" + re.escape(name), tuple(whole)))
    return out + [Rule(None, "block", p, (tok,)) for tok, p in patterns]


def parts_of(url: str | None) -> tuple[str, str]:
    """Host, A-Z in lower case, and path."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = re.search(r"[/?#]", rest)
    host = rest if end is None else rest[:end.start()]
    path = "" if end is None else re.split(r"[?#]", rest[end.start():], maxsplit=1)[0]
    return host.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"), path


def tokens_of(url: str | None) -> set[str]:
    return set(_TOKEN.findall((url or "").lower()))


def token_counts(urls: DataFrame, wanted: set[str]) -> dict[str, int]:
    """How many URLs hold each of the rules' tokens."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = Counter(t for u in batch.column(0).to_pylist() for t in tokens_of(u) & wanted)
        return pa.record_batch([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["t", "n"])
    return {r["t"]: r["n"] for r in map_arrow(urls, run, "t string, n bigint").groupBy("t").agg(F.sum("n").alias("n")).collect()}


def judge(pages: DataFrame, rules: list[Rule] | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row."""
    rules = rules_of() if rules is None else rules
    src = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    counts = token_counts(src.select("url"), {t for r in rules for t in r.tokens})
    filed: dict[str, list[tuple[Rule, re.Pattern]]] = defaultdict(list)
    for r in rules:
        filed[min(r.tokens, key=lambda t: (counts.get(t, 0), t), default="")].append((r, re.compile(r.pattern)))
    filed = dict(filed)

    def one(url: str | None) -> tuple[str, str, str | None, str]:
        host, path = parts_of(url)
        where, low = host + path, (url or "").lower()
        fits, blocked = [], False
        for token in [*(tokens_of(url) & filed.keys()), ""]:
            for r, pattern in filed.get(token, ()):
                if r.name is None:
                    blocked = blocked or bool(pattern.search(low))
                elif pattern.match(where) and host:
                    fits.append((len(r.name), r.name, r.verdict))
        if fits:
            _, name, verdict = max(fits)
            return host, path, name, verdict
        return host, path, None, "block" if blocked else "allow"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols = list(zip(*map(one, batch.column(1).to_pylist())))
        return pa.record_batch([batch.column(0), *(pa.array(c, pa.string()) for c in cols)],
                               names=["page_id", "host", "path", "rule", "verdict"])
    return map_arrow(src, run, SCHEMA)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the URL of every page."""
    return judge(table(spark, sf_dir, "pages"))


_FITS = "\n".join(f"UNION ALL SELECT '{n.split('/', 1)[0]}', '/{n.split('/', 1)[1]}', '{v}', '{n}'" for n, v in HOST_RULES).removeprefix("UNION ALL ")
_BLOCKED = " OR ".join(f"regexp_matches(lower(coalesce(url, '')), '{p}')" for _, p in PATTERN_RULES)

#: DuckDB: every rule against every URL.
ORACLE = f"""
WITH rules(rh, rp, rv, rule) AS ({_FITS}),
u AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(rv, length(rule)) AS rv
      FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT p.page_id, host, path, f.rule AS rule, coalesce(f.rv, CASE WHEN {_BLOCKED} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN f USING (page_id)
"""
