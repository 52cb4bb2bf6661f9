"""URL filter: an index of pattern rules by their rarest literal token.

A pattern is written as in block lists: ``*`` stands for anything, ``^`` for one character that separates tokens (or the
end), ``||`` at the start for the start of a host or of one of its labels; all else is literal. A token is a run of letters and
digits that the pattern holds whole, so every URL it matches has that token. Each rule is filed under the one of its
tokens that the fewest URLs have, counted over all URLs. A URL's tokens fetch the rules filed under them; only those
run their regular expression. A rule without a token is filed under the empty token, which every URL has.

Listed host rules come first: a rule of a host and the start of a path fits the host and its subdomains, the longest
that fits wins. Where none fits the patterns judge: block if any matches, else allow.

All of it is DataFrame operations. URLs are judged once each, however many pages have them, and joined back; the rules
are a list of the program, so Spark sees their size and sends them whole. Null URLs and those without ``://`` have
an empty host and path. Repeated rows and null ids each get their own result; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import LOWER, UPPER

# Host, path, verdict.
HOST_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

PATTERNS = (
    "||ads.*",
    "||adserver.*",
    "||track.*",
    "||tracking.*",
    "||casino.*",
    "||porn.*",
    "^ads^",
    "^banner^",
    "^login^",
    "^signin^",
    "^logout^",
    "^cart^",
    "^checkout^",
    "^wp-admin^",
    "^wp-json^",
    "^xmlrpc.php^",
    "^cgi-bin^",
    "^utm_source=spam^",
    "?sessionid=",
    "&sessionid=",
    "?utm_source=feed*&ref=",
    "?replytocom=",
    "?print=1^",
    "^print.html^",
)
SEPARATOR = r"(?:[^0-9a-z%_.\-]|$)"
TOKEN = r"[0-9a-z]+"


def lowered(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


@dataclass(frozen=True)
class Pattern:
    text: str
    regex: str
    tokens: tuple[str, ...]

    @classmethod
    def of(cls, text: str) -> Pattern:
        """The pattern as a regular expression over a lower-cased URL, and its whole tokens."""
        body, start = text.lower(), ""
        if body.startswith("||"):
            body, start = body[2:], r"^[a-z0-9+.\-]*://(?:[^/?#]*\.)?"
        parts = {"*": ".*", "^": SEPARATOR}
        regex = start + "".join(parts.get(c) or re.sub(r"([^0-9a-z_/])", r"\\\1", c) for c in body)
        whole = []
        for token in re.finditer(TOKEN, body):
            left, right = body[: token.start()][-1:], body[token.end() :][:1]
            if (left or ("^" if start else "*")) != "*" and (right or "*") != "*":
                whole.append(token[0])
        return cls(text, regex, tuple(dict.fromkeys(whole)) or ("",))


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lowered(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def host_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """Struct of rule and verdict of the longest rule that fits; null if none does."""
    fitting = None
    for name, start, verdict in sorted(rules, key=lambda rule: -len(rule[0] + rule[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, found) if fitting is None else fitting.when(fits, found)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if fitting is None else fitting


def tokens_of(url: Column) -> Column:
    found = F.regexp_extract_all(lowered(url), F.lit(f"({TOKEN})"), 1)
    return F.array_distinct(F.concat(F.array(F.lit("")), found))


def rule_index(urls: DataFrame, patterns: tuple[str, ...]) -> DataFrame:
    """``rule, regex, token``: each pattern under its token that the fewest of the URLs have."""
    rows = [(p.text, p.regex, token) for p in map(Pattern.of, patterns) for token in p.tokens]
    rules = urls.sparkSession.createDataFrame(rows, "rule string, regex string, token string")
    counts = (
        urls.select(F.explode(tokens_of(F.col("url"))).alias("token"))
        .filter(F.col("token").isin(sorted({token for _, _, token in rows})))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("urls"))
    )
    rarest = F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), F.col("token")))
    return rules.join(counts, "token", "left").groupBy("rule", "regex").agg(rarest["token"].alias("token"))


def pattern_hits(urls: DataFrame, patterns: tuple[str, ...] = PATTERNS) -> DataFrame:
    """``url, pattern``: each distinct URL that a pattern matches, with the first of them by name."""
    index = rule_index(urls, patterns)
    fetched = urls.select("url", F.explode(tokens_of(F.col("url"))).alias("token")).join(index, "token")
    matched = fetched.filter(F.rlike(lowered(F.col("url")), F.col("regex")))
    return matched.groupBy("url").agg(F.min("rule").alias("pattern"))


def judge(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    host_rules: tuple[tuple[str, str, str], ...] = HOST_RULES,
    patterns: tuple[str, ...] = PATTERNS,
) -> DataFrame:
    """Key, host, path, host rule, verdict and the first pattern of each row."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(key), F.col(url).alias("url"))
    distinct = rows.filter(F.col("url").isNotNull()).select("url").distinct()
    # The hits get a shuffle of their own, so that a URL many pages have can be split in the join.
    hits = pattern_hits(distinct, patterns).select(F.concat("url", F.lit("")).alias("hit"), "pattern")
    judged = rows.join(hits, rows["url"] == hits["hit"], "left").select(
        F.col(key), host.alias("host"), path.alias("path"), "pattern"
    )
    fixed = host_rule(F.col("host"), F.col("path"), host_rules)
    verdict = F.when(F.col("fixed").isNotNull(), F.col("fixed")["verdict"]).when(
        F.col("pattern").isNotNull(), F.lit("block")
    )
    return judged.withColumn("fixed", fixed).select(
        F.col(key),
        "host",
        "path",
        F.col("fixed")["rule"].alias("rule"),
        verdict.otherwise(F.lit("allow")).alias("verdict"),
        "pattern",
    )
