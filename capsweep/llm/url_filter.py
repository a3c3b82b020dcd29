"""URL filters: block and allow rules, spread over pages that redirect or canonical links call the same.

DataFrame functions only. Defined results: a null url, or one without ``://``, has an empty host and path, meets no
rule, has no aliases and is allowed. Repeated rows are judged each for itself, alike. Extra columns of the pages are
ignored. An empty table gives an empty result. Urls and pages of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import connected_components

#: (verdict, host, path prefix): fixed by the query's contract.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Targets that a page names for itself: a canonical link, or a refresh that sends the reader on.
CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls if none does. Rules are a list in the program, not a table."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, of, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(prefix)
        rule, verdict = F.when(fits, of + prefix).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def node_of(url: Column) -> Column:
    """What two urls share if they fetch the same: host, path and query; the scheme and fragment drop out."""
    query = F.regexp_extract(url, r"://[^?#]*(\?[^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), F.when(path_of(url) == "", "/").otherwise(path_of(url)), query))


def folded(path: Column) -> Column:
    """A path that begins with a slash, without its "." and ".." segments."""
    segments = F.split(F.substr(path, F.lit(2)), "/")
    step = lambda kept, x: F.when(x == ".", kept).when(x == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(x)))
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise(""))


def resolve(base: Column, target: Column) -> Column:
    """A target against the page's url; schemes without ``//`` (mailto:) and mere fragments are no evidence."""
    scheme = F.regexp_extract(base, r"^(?s:(.*?))://", 1)
    clean = F.replace(target, F.lit("&amp;"), F.lit("&"))
    site = F.concat(scheme, F.lit("://"), host_of(base))
    own, path, rest = path_of(base), F.regexp_extract(clean, r"^([^?#]*)", 1), F.regexp_extract(clean, r"^[^?#]*((?s:.*))", 1)
    folder = F.when(own == "", "/").otherwise(F.regexp_replace(own, r"[^/]*$", ""))
    return (
        F.when(clean.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), clean)
        .when(clean.startswith("//"), F.concat(scheme, F.lit(":"), clean))
        .when(clean.startswith("/"), F.concat(site, folded(path), rest))
        .when(clean.startswith("?"), F.concat(site, F.when(own == "", "/").otherwise(own), clean))
        .when(~clean.rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:|#)") & (clean != ""), F.concat(site, folded(F.concat(folder, path)), rest))
    )


def page_edges(pages: DataFrame) -> DataFrame:
    """(u, v) urls' nodes that a page's own canonical links and refreshes join, all of them."""
    every = F.concat(F.regexp_extract_all("html", F.lit(CANONICAL), F.lit(1)), F.regexp_extract_all("html", F.lit(REFRESH), F.lit(1)))
    p = pages.where(F.col("url").contains("://")).select("url", F.explode(every).alias("t")).where("t <> ''")
    return p.select(node_of(F.col("url")).alias("u"), node_of(resolve(F.col("url"), F.col("t"))).alias("v")).where("u <> v")


def filter_urls(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, via) for every page.

    redirects: further (source, target) urls, such as a crawler's log of them. A page with a rule keeps the rule's
    verdict. Any other takes its component's: allow if a rule allows some url of the component, else block if a rule
    blocks one, else allow. via: ``rule``, ``alias`` or ``default``. Every url of a component is judged, linked
    targets that are no page included. Without links no component is built.
    """
    url = F.col("url")
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("source")).alias("u"), node_of(F.col("target")).alias("v")).where("u <> v"))
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    judged = judged.withColumns(dict(zip(("rule", "own"), matched_rule(F.col("host"), F.col("path"), rules), strict=True)))
    parts = connected_components(edges)
    fake = F.concat(F.lit("x://"), F.col("node"))
    votes = parts.withColumn("said", matched_rule(host_of(fake), path_of(fake), rules)[1]).groupBy("component").agg(F.bool_or(F.col("said") == "allow").alias("allowed"), F.bool_or(F.col("said") == "block").alias("blocked"))
    spread = parts.join(votes, "component").select("node", F.when(F.coalesce("allowed", F.lit(False)), "allow").when(F.coalesce("blocked", F.lit(False)), "block").alias("spread")).where("spread is not null")
    out = judged.join(spread, "node", "left")
    return out.select(
        "page_id", "host", "path", "rule",
        F.coalesce("own", "spread", F.lit("allow")).alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule").when(F.col("spread").isNotNull(), "alias").otherwise("default").alias("via"),
    )
