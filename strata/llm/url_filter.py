"""URL filters: host and path rules, indexed by their rarest literal token.

A rule is ``host/path-prefix`` with an action.  It fits its host and all
subdomains when the URL's path starts with the rule's path; of several that
fit, the longest rule string wins (ties: the greater string, then action).

Method.  Host labels and complete path segments are a rule's literal tokens.
Each rule is filed under the one of its tokens that is rarest among the URLs.
A URL's tokens fetch the rules filed under them, and only those candidates run
their regular expression.  DataFrame functions only.

Defined cases: a null URL or one without ``://`` has empty host and path and
matches nothing but rules without a host; repeated rows are kept as they are;
repeated rules count once; null rules are ignored; an empty table gives an
empty result; very long URLs are judged whole; of rules of one length that fit, the greater text wins; input columns named
like an output column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, others

#: Characters that a regular expression reads as its own.
_SPECIAL = r"([\\.\[\]{}()*+?^$|#&~<>=!:\- ])"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3, F.length(url)))


def _tokens(host: Column, segments: Column) -> Column:
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("."), x))
    parts = F.transform(segments, lambda x: F.concat(F.lit("/"), x))
    return F.array_distinct(F.filter(F.concat(labels, parts), lambda x: F.length(x) > 1))


def compile_rules(rules: DataFrame, rule_col: str = "rule", action_col: str = "action") -> DataFrame:
    """(rule, action, pattern, tokens) of each distinct rule."""
    r = rules.select(F.col(rule_col).alias("rule"), F.col(action_col).alias("action")).dropna().distinct()
    slash = F.instr("rule", "/")
    r = r.select("rule", "action",
                 ascii_lower(F.when(slash > 0, F.substr("rule", F.lit(1), slash - 1)).otherwise(F.col("rule"))).alias("h"),
                 F.when(slash > 0, F.substr("rule", slash, F.length("rule"))).otherwise(F.lit("")).alias("p"))
    quoted = {c: F.regexp_replace(c, _SPECIAL, r"\\$1") for c in ("h", "p")}
    host = F.when(F.col("h") == "", F.lit(r"^[^/]*")).otherwise(F.concat(F.lit(r"^(?:[^/]*\.)?"), quoted["h"]))
    segments = F.split("p", "/")
    # what follows the last slash is only the beginning of a segment, so it cannot be looked up
    complete = F.slice(segments, F.lit(1), F.greatest(F.size(segments) - 1, F.lit(0)))
    return r.select("rule", "action", F.concat(host, F.when(F.col("p") == "", F.lit(r"(?:/|\z)")).otherwise(quoted["p"])).alias("pattern"),
                    _tokens(F.col("h"), complete).alias("tokens"))


def url_filter(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
               host_col: str = "host", path_col: str = "path", rule_col: str = "rule",
               verdict_col: str = "verdict") -> DataFrame:
    """``pages`` with host, path, the winning rule (or null) and its verdict (``default`` where none fits).

    Every distinct URL is judged once; the verdicts are joined back to the
    pages, so a URL on a third of all rows costs one look-up.
    """
    urls = pages.select(F.col(url_col).alias("url")).where(F.instr("url", "://") > 0).distinct()
    urls = urls.select("url", url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p"))
    ready = compile_rules(rules)
    unfiled = not ready.where(F.size("tokens") == 0).isEmpty()  # such rules have to be tried on every URL
    found = _tokens(F.col("h"), F.split("p", "/"))
    tokens = urls.select("url", F.concat("h", "p").alias("key"),
                         F.explode(F.array_append(found, F.lit("*")) if unfiled else found).alias("token"))
    filed = ready.select("rule", "action", "pattern", F.explode_outer("tokens").alias("token")).fillna("*", "token")
    seen = tokens.join(filed.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("rule", "action").orderBy(F.coalesce("n", F.lit(0)), "token")
    index = filed.join(seen, "token", "left").withColumn("k", F.row_number().over(rarest)).where("k = 1").drop("k", "n")
    best = (tokens.join(index, "token").where(F.expr("key rlike pattern"))
            .groupBy("url").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "action")).alias("best")))
    made = {host_col: url_host(F.col("p." + url_col)), path_col: url_path(F.col("p." + url_col)),
            rule_col: F.col("best.rule"), verdict_col: F.coalesce("best.action", F.lit(default))}
    return (pages.alias("p").join(best.alias("b"), F.col(f"p.`{url_col}`") == F.col("b.url"), "left")
            .select(*(F.col(f"p.`{c}`") for c in others(pages, made)), *(c.alias(n) for n, c in made.items())))
