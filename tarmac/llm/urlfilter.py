"""op7: url filter rules with redirect equivalence.

A rule (host, path) fits the urls of its host and all subdomains whose path starts with
its path; the longest fitting rule decides, allow before block between equally long ones.
Urls without a rule take the verdict of their aliases: redirect edges (meta refresh) and
canonical-link edges of the pages join urls into components, found distributed, and a
component with a blocked url is blocked unless it holds an explicitly allowed one. What
no rule reaches is allowed.

Links are resolved against the page's url, or its first ``<base href>``, by RFC 3986: dot
segments are removed, and links of a scheme without ``//`` lead nowhere. Urls are one node
of the graph when they are equal after that, the case of scheme and host, the default port
and the fragment aside. With ``forms=True`` those that differ in scheme, a leading ``www.``
or ``m.`` or a tracking parameter only are one node too.

DataFrame functions only. Up to ``IN_EXPRESSION`` rules are looked through row by row; of
more, a table is made and joined with the host's suffixes and the path's beginnings, with
the same result. Their number is not bounded.

Defined results for odd input: a null url or one without ``://`` has empty host and path,
no rule and no aliases (allowed); null html has no edges; repeated rows get the same
verdict each; an empty table gives no rows; chains and cycles of any length are followed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import native_components, once, staged, table

# Fixed values: (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
IN_EXPRESSION = 100      # rules held in an expression; more are joined
BROADCAST_ROWS = 100_000  # rows (a host and a length) of a rule table sent to every task


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments; one that does not begin with / is as it is."""
    parts = F.split(path, "/", -1)
    none = F.array().cast("array<string>")
    kept = F.aggregate(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), none,
        lambda to, part: F.when(part == "..", F.slice(to, F.lit(1), F.greatest(F.size(to) - 1, F.lit(0))))
        .when(part == ".", to).otherwise(F.concat(to, F.array(part))))
    # A path that ends in a dot segment ends in its folder.
    folder = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(none)
    return F.when(F.regexp_like(path, F.lit(r"(?s)^/(.*/)?\.\.?(/|$)")), F.concat(
        F.lit("/"), F.array_join(F.concat(kept, folder), "/"))).otherwise(path)


def parsed(df: DataFrame, url: str, prefix: str = "", forms: bool = False) -> DataFrame:
    """``df`` plus ``host``, ``path`` and ``node``, the url's place in the graph (null
    without ``://``)."""
    rest, host, path, query, kept, node = (prefix + n for n in ("rest", "host", "path", "query", "kept", "node"))
    df = once(df, **{rest: F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, r"(?s)^.*?://", ""))})
    df = once(df, **{
        host: F.coalesce(ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.lit("")),
        path: F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit("")),
        query: F.regexp_extract(rest, r"(?s)^[^?#]*(\?[^#]*)", 1)})
    scheme = ascii_lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    port = F.when(scheme == "http", r":(80)?$").when(scheme == "https", r":(443)?$").otherwise(r":$")
    place = F.regexp_replace(F.col(host), port, F.lit(""))
    if forms:
        df = once(df, **{kept: F.filter(F.split(F.substring(query, 2, 1 << 30), "&"), lambda p: (
            p != "") & ~F.regexp_like(p, F.lit(r"(?i)^(utm_[a-z]*|gclid|fbclid|ref)(=|$)")))})
        front = F.regexp_replace(place, r"^(www|m)\.", "")
        tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    else:
        front, tail = F.concat(scheme, F.lit("://"), place), F.col(query)
    whole = F.when(F.col(path) == "", "/").otherwise(without_dots(F.col(path)))
    return once(df, **{node: F.when(F.col(rest).isNotNull(), F.concat(front, whole, tail))}).drop(rest, query, kept)


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The deciding rule as a struct (length, allows, rule, verdict); null when none fits."""
    known = F.array(*[F.struct(F.lit(len(h) + len(p)).alias("length"), F.lit(v == "allow").alias("allows"),
                               F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"), F.lit(h).alias("host"),
                               F.lit(p).alias("path")) for h, p, v in rules])
    fits = F.filter(known, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
                    & F.startswith(path, r["path"]))
    return F.array_max(fits)


def with_rule(df: DataFrame, host: str, path: str, rules: list[tuple[str, str, str]] | DataFrame,
              out: str) -> DataFrame:
    """``df`` plus the deciding rule as a struct (length, allows, rule, verdict), null when
    none fits. ``rules`` is a list, or a table (host, path, verdict), of (host, path, verdict)."""
    if isinstance(rules, list) and len(rules) <= IN_EXPRESSION:
        return once(df, **{out: matched_rule(F.col(host), F.col(path), rules)}) if rules else df.withColumn(
            out, F.lit(None).cast("struct<length:int,allows:boolean,rule:string,verdict:string>"))
    if isinstance(rules, list):
        rules = df.sparkSession.createDataFrame(rules, "host string, path string, verdict string")
    known = rules.select(F.col("host").alias("_of"), F.col("path").alias("_begin"), F.struct(
        (F.length("host") + F.length("path")).alias("length"), (F.col("verdict") == "allow").alias("allows"),
        F.concat("host", "path").alias("rule"), "verdict").alias("_rule"))
    known = staged(known.groupBy("_of", "_begin").agg(F.max("_rule").alias("_rule")), "url-rules")
    # A url can only meet rules of its host's suffixes, and there beginnings of lengths that occur.
    lengths = staged(known.select("_of", F.length("_begin").alias("_length")).distinct(), "url-rule-lengths")
    lengths = F.broadcast(lengths) if lengths.count() <= BROADCAST_ROWS else lengths
    urls = df.select(F.col(host).alias("_host"), F.col(path).alias("_path")).distinct()
    parts = F.split("_host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    met = (urls.select("_host", "_path", F.explode(suffixes).alias("_of")).join(lengths, "_of")
           .filter(F.length("_path") >= F.col("_length"))
           .withColumn("_begin", F.substring("_path", F.lit(1), F.col("_length"))).join(known, ["_of", "_begin"])
           .groupBy("_host", "_path").agg(F.max("_rule").alias(out)))
    return df.join(met, (F.col(host) == F.col("_host")) & (F.col(path) == F.col("_path")), "left").drop("_host", "_path")


def absolute(df: DataFrame, link: str, base: str, out: str) -> DataFrame:
    """``df`` plus ``out``: the url that a link names on a page of url ``base``; null for
    none, one within the page, or one of a scheme without ``//``."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?:)//", 1)
    start = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*([^?#]*/)", 1)
    link, rooted = F.col(link), lambda p: F.when(p == "", "/").otherwise(p)
    whole = (F.when(F.regexp_like(link, F.lit(r"(?i)^[a-z][a-z0-9+.-]*:")),
                    F.when(F.regexp_like(link, F.lit(r"(?i)^[a-z][a-z0-9+.-]*://")), link))
             .when((link == "") | F.startswith(link, F.lit("#")) | (start == ""), F.lit(None))
             .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
             .when(F.startswith(link, F.lit("/")), F.concat(start, link))
             .when(F.startswith(link, F.lit("?")), F.concat(start, rooted(path), link))
             .otherwise(F.concat(start, rooted(folder), link)))
    df = once(df, _whole=whole)
    return once(df, **{out: F.concat(
        F.regexp_extract("_whole", r"(?s)^(.*?://[^/?#]*)", 1),
        without_dots(F.regexp_extract("_whole", r"(?s)^.*?://[^/?#]*([^?#]*)", 1)),
        F.regexp_extract("_whole", r"(?s)^.*?://[^?#]*(.*)$", 1))}).drop("_whole")


def _attribute(tag: Column, name: str) -> Column:
    got = [F.regexp_extract(tag, rf"(?is)[\s\"']{name}\s*=\s*{form}", 1)
           for form in ('"([^"]*)"', "'([^']*)'", r"([^\s\"'>]+)")]
    found = F.coalesce(*[F.nullif(g, F.lit("")) for g in got], F.lit(""))
    return F.trim(F.replace(F.replace(found, F.lit("&amp;"), F.lit("&")), F.lit("&#38;"), F.lit("&")))


def link_edges(pages: DataFrame) -> DataFrame:
    """(url, target): canonical links and meta refreshes, outside comments and scripts.
    ``pages`` has url and html."""
    hopeful = pages.filter(F.regexp_like("html", F.lit(r"(?i)<link[^>]*canonical|<meta[^>]*refresh")))
    bare = F.regexp_replace(F.regexp_replace("html", r"(?s)<!--.*?-->", " "),
                            r"(?is)<(script|style|noscript|textarea)\b.*?</\1\s*>", " ")
    bare = once(hopeful, bare=bare).select("url", "bare")
    based = once(bare, base_href=_attribute(F.regexp_extract("bare", r"(?is)(<base\b[^>]*\bhref\s*=[^>]*>)", 1), "href"))
    based = absolute(based, "base_href", "url", "base").withColumn("base", F.coalesce("base", "url"))
    tags = once(based.select("url", "base", F.explode(F.regexp_extract_all(
        "bare", F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"), F.lit(1))).alias("tag")),
        rel=_attribute(F.col("tag"), "rel"), href=_attribute(F.col("tag"), "href"),
        equiv=_attribute(F.col("tag"), "http-equiv"), content=_attribute(F.col("tag"), "content"))
    canonical = (F.regexp_like("tag", F.lit(r"(?i)^<link\b"))
                 & F.regexp_like("rel", F.lit(r"(?i)(^|\s)canonical(\s|$)")))
    refresh = F.regexp_like("tag", F.lit(r"(?i)^<meta\b")) & (F.lower("equiv") == "refresh")
    place = F.trim(F.regexp_extract("content", r"(?is)url\s*=\s*['\"]?([^'\"]*)", 1))
    links = once(tags, link=F.when(canonical, F.col("href")).when(refresh, place)).filter("link is not null")
    return absolute(links, "link", "base", "target").filter("target is not null").select("url", "target")


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame = RULES, id_col: str = "page_id",
           url_col: str = "url", html_col: str = "html", forms: bool = False) -> DataFrame:
    """Per page row: (page_id, host, path, rule, verdict). ``forms`` and ``rules``: see above."""
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
    edges = parsed(parsed(link_edges(named), "url", "a_", forms), "target", "b_", forms)
    edges = staged(with_rule(edges, "b_host", "b_path", rules, "b_rule").select(
        F.col("a_node").alias("a"), F.col("b_node").alias("b"), F.col("b_rule.verdict").alias("b_verdict")), "url-edges")
    ruled = with_rule(parsed(named.select("page_id", "url"), "url", forms=forms), "host", "path", rules, "r")
    direct = ruled.select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                          F.col("r.verdict").alias("verdict"), "node")
    # Only urls that some edge touches have aliases beyond their own forms. A target that
    # is no page of the table speaks through its own rule.
    groups = staged(native_components(edges), "url-components")
    told = (direct.filter("verdict is not null and node is not null").select("node", "verdict")
            .unionByName(edges.filter("b_verdict is not null").select(F.col("b").alias("node"),
                                                                         F.col("b_verdict").alias("verdict"))))
    spoken = told.groupBy("node").agg(F.max(F.col("verdict") == "allow").alias("allowed"),
                                      F.max(F.col("verdict") == "block").alias("blocked"))
    known = spoken.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    verdicts = known.groupBy("component").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked"))
    blocked = staged(verdicts.filter("blocked and not allowed").select("component"), "url-blocked")
    # Blocked nodes: those of blocked components, and blocked urls' own other forms.
    nodes = groups.join(blocked, "component").select("node").union(
        blocked.select(F.col("component").alias("node"))).distinct().withColumn("alias_blocked", F.lit(True))
    unruled = direct.filter("verdict is null and node is not null")
    rest = direct.filter("verdict is not null or node is null")
    heard = unruled.drop("verdict").join(nodes, "node", "left").withColumn(
        "verdict", F.when(F.col("alias_blocked"), "block").otherwise("allow")).drop("alias_blocked")
    return (rest.withColumn("verdict", F.coalesce("verdict", F.lit("allow"))).unionByName(heard)
            .select("page_id", "host", "path", "rule", "verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))
