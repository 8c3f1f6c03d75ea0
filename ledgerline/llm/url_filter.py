"""URL filters: pattern rules found through their rarest literal token, in DataFrame functions alone.

A rule is (host, path, verdict): it fits its host and all subdomains where the URL's path starts with its own,
and the longest fitting rule decides. Each rule is compiled to a regular expression on ``host + path`` and to its
literal tokens: the labels of its host and those segments of its path that end in a slash, each with its
kind, since every URL that the rule fits has all of them. Its index token is the one that occurs in the fewest
URLs of the table. The distinct tokens of a URL fetch the candidate rules by join, and only candidates run their
expressions. URLs without a candidate run none.

A URL without a fitting rule is judged by the method's default.

Parts of a URL: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
the path goes on from there up to ``?``, ``#`` or the end. NULL and URLs without ``://`` have empty parts
and fit no rule. Of two rules of equal length that fit, block goes before allow. Rows are judged one by one: repeated rows and
NULL ids are as others; an empty table or rule list gives no candidates; other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: rules up to this number may be broadcast with their expressions
BROADCAST_RULES = 200_000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        return rf"\A(?s)([^/]*\.)?{_literal(self.host)}{_literal(self.path)}"

    def tokens(self) -> list[str]:
        """The tokens that every fitting URL has."""
        whole = [s for s in self.path.split("/")[:-1] if s]
        return sorted({f"h:{x}" for x in self.host.split(".")} | {f"p:{x}" for x in whole})


def _literal(s: str) -> str:
    """A pattern for ``s`` itself."""
    return r"\Q" + s.replace(r"\E", r"\E\\E\Q") + r"\E"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    after = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"\A[^/?#]*", 0)
    rest = F.regexp_extract(after, r"(?s)\A[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), rest


def url_tokens(host: Column, path: Column) -> Column:
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    pieces = F.split(path, "/")
    whole = F.filter(F.slice(pieces, 1, F.size(pieces) - 1), lambda x: x != "")
    return F.array_distinct(F.concat(labels, F.transform(whole, lambda x: F.concat(F.lit("p:"), x))))


def judge(pages: DataFrame, rules: list[Rule], *, default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """Per row: the id, host, path, rule (the deciding rule's text, else NULL) and verdict."""
    spark = pages.sparkSession
    host, path = parts(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    tokens = url_tokens(F.col("host"), F.col("path"))

    table = spark.createDataFrame(
        [(r.text, r.pattern, r.verdict, len(r.text), r.tokens()) for r in rules],
        "rule string, pattern string, verdict string, length int, tokens array<string>")
    needed = table.select(F.explode("tokens").alias("token")).distinct()
    small = len(rules) <= BROADCAST_RULES
    known = F.broadcast(needed) if small else needed
    # how many URLs hold each token that some rule could be indexed by
    often = (urls.select(F.explode(tokens).alias("token")).join(known, "token")
             .groupBy("token").agg(F.count("*").alias("often")))
    index = (table.select("rule", "pattern", "verdict", "length", F.explode("tokens").alias("token"))
             .join(often, "token", "left")
             .groupBy("rule", "pattern", "verdict", "length")
             .agg(F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "token")).alias("rarest"))
             .select(F.col("rarest.token").alias("token"), F.struct(
                 "length", (F.col("verdict") == "block").alias("block"), "rule", "verdict", "pattern").alias("candidate")))
    # candidates of a token, then of a URL; a URL has at most as many rows as tokens
    by_token = index.groupBy("token").agg(F.collect_list("candidate").alias("candidates"))
    return _decided(urls, tokens, F.broadcast(by_token) if small else by_token, default, id_col)


def _decided(urls: DataFrame, tokens: Column, by_token: DataFrame, default: str, id_col: str) -> DataFrame:
    distinct = urls.select("host", "path").distinct().withColumn("tokens", tokens)
    address = F.concat("host", "path")
    best = (distinct.select("host", "path", F.explode("tokens").alias("token")).join(by_token, "token")
            .withColumn("fits", F.filter("candidates", lambda c: F.rlike(address, c["pattern"])))
            .where(F.size("fits") > 0)
            .groupBy("host", "path").agg(F.max(F.array_max("fits")).alias("best")))
    return (urls.join(best, ["host", "path"], "left")
            .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
