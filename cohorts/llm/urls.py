"""Url filters: host and path rules, and block decisions carried to aliases along redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorts.functions.columns import col
from cohorts.functions.skew import numbered
from cohorts.llm.graph import components
from cohorts.llm.tables import ascii_lower, table
from cohorts.session import materialize

# The rules of the registered query: host and path, and what is decided.
RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
]
# Hosts that sites redirect to their bare name.
HOST_ALIASES = ("www", "m")
# Rule lists of up to so many rows are broadcast; longer ones are joined by shuffle.
BROADCAST_RULES = 100_000

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
# A tag with its attributes (values in quotes may hold ">"), its attributes one by one, and the target of a refresh.
TAG = r"""(?i)<(?:link|meta)(?=[\s/])(?:[^<>"']|"[^"]*"|'[^']*')*>"""
ATTRIBUTES = r"""[^\s"'<>/=]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>]+)"""
VALUE = r"""(?s)^[^=]*=\s*["']?\s*(.*?)\s*["']?$"""
TARGET = r"""(?is)^[^;,]*[;,]\s*url\s*=\s*["']?\s*([^"']*?)\s*(?:["'].*)?$"""
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def key_of(url: Column) -> Column:
    """What names a resource: host, path and query. Scheme and fragment don't; null for what is no url."""
    key = F.concat(host_of(url), path_of(url), F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit("")))
    return F.when(url.contains("://"), key)


def attribute(tag: Column, name: str) -> Column:
    """Value of a tag's first attribute of that very name, without quotes and blanks around it; null if it has none."""
    found = F.filter(F.regexp_extract_all(tag, F.lit(ATTRIBUTES), F.lit(0)), lambda a: a.rlike(rf"(?i)^{name}\s*="))
    return F.replace(F.regexp_extract(F.get(found, F.lit(0)), VALUE, 1), F.lit("&amp;"), F.lit("&"))


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved (RFC 3986, 5.2.4)."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))  # the first part, before the leading slash, stays
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.slice(parts, 1, 1), step)
    folder = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    whole = F.concat(F.array_join(kept, "/"), folder)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), whole).otherwise(path)


def resolved(to: Column, url: Column) -> Column:
    """Absolute url of a reference found on the page ``url`` (RFC 3986, 5.2.2); null for schemes without a host, such as ``mailto:``."""
    scheme, host = F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.regexp_extract(url, PARTS, 1)
    own_path, own_query = F.regexp_extract(url, PARTS, 2), F.regexp_extract(url, PARTS, 3)
    root = F.concat(scheme, F.lit("://"), host)
    path, rest = F.regexp_extract(to, "(?s)^[^?#]*", 0), F.regexp_extract(to, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.when(own_path == "", F.lit("/")).otherwise(F.regexp_replace(own_path, "[^/]*$", ""))
    absolute = to.rlike(SCHEME + "//") | to.startswith("//")
    full = F.when(to.startswith("//"), F.concat(scheme, F.lit(":"), to)).otherwise(to)
    clean = F.concat(
        F.regexp_extract(full, r"(?s)^.*?://[^/?#]*", 0), without_dots(F.regexp_extract(full, PARTS, 2)),
        F.regexp_extract(full, r"(?s)^.*?://[^/?#]*[^?#]*(.*)$", 1),
    )
    return (
        F.when(absolute, clean)
        .when(to.rlike(SCHEME), F.lit(None))
        .when(path == "", F.concat(root, own_path, F.when(to.startswith("?"), rest).otherwise(own_query)))
        .when(to.startswith("/"), F.concat(root, without_dots(path), rest))
        .otherwise(F.concat(root, without_dots(F.concat(folder, path)), rest))
    )


def declared_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges ``(source, target)`` of resource keys: canonical links and refresh redirects in the pages' markup.

    A link counts if ``canonical`` is one of the words of its ``rel``. Targets are resolved against the page's own url; only
    targets are freed of dot segments, as urls of pages are keys as they stand.
    """
    tags = F.explode(F.regexp_extract_all(col(html_col), F.lit(TAG), F.lit(0))).alias("tag")
    found = pages.select(col(url_col).alias("url"), tags)
    tag = F.col("tag")
    words = F.split(ascii_lower(attribute(tag, "rel")), r"\s+")
    is_link = ascii_lower(F.substring(tag, 2, 4)) == "link"
    target = F.when(is_link & F.array_contains(words, "canonical"), attribute(tag, "href")).when(
        ~is_link & (ascii_lower(attribute(tag, "http-equiv")) == "refresh"), F.regexp_extract(attribute(tag, "content"), TARGET, 1)
    )
    found = found.withColumn("to", target).where("to <> ''")
    return found.select(key_of(F.col("url")).alias("source"), key_of(resolved(F.col("to"), F.col("url"))).alias("target"))


def alias_links(keys: DataFrame, aliases: tuple[str, ...] = HOST_ALIASES) -> DataFrame:
    """Edges from keys whose host starts with a label of ``aliases`` to the same key on the bare host."""
    if not aliases:
        return keys.select(F.col("key").alias("source"), F.col("key").alias("target")).limit(0)
    bare = F.regexp_extract("key", rf"(?s)^(?:{'|'.join(aliases)})\.([^./?]+\..*)$", 1)
    return keys.select(F.col("key").alias("source"), bare.alias("target")).where("target <> ''")


def decide_by_rules(keys: DataFrame, rules: DataFrame, n_rules: int, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """``(key, rule, verdict)`` for every key that a rule fits; the longest rule wins, and allow among equal texts."""
    parts = rules.select(
        "rule", "verdict", F.substring_index("rule", "/", 1).alias("host"),
        F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("start"),
    )
    host, path = F.regexp_extract("key", "^[^/?]*", 0), F.regexp_extract("key", r"(?s)^[^/?]*([^?]*)", 1)
    labels = F.split(F.col("name"), r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    spread = keys.select("key", host.alias("name"), path.alias("path")).select("key", "path", F.explode(ends).alias("host"))
    small = F.broadcast(parts) if n_rules <= broadcast_rules else parts
    fits = spread.join(small, "host").where(F.col("path").startswith(F.col("start")))
    best = F.max(F.struct(F.length("rule").alias("n"), (F.col("verdict") == "allow").alias("allow"), F.col("rule"), F.col("verdict")))
    return fits.groupBy("key").agg(best.alias("best")).select("key", "best.rule", "best.verdict")


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]] | DataFrame,
    url_col: str = "url",
    html_col: str | None = "html",
    links: DataFrame | None = None,
    aliases: tuple[str, ...] = HOST_ALIASES,
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """Rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` added.

    A url with a fitting rule has that rule's verdict. Any other url is blocked if its
    component holds a blocked url, and allowed otherwise: resources are connected by canonical
    links and refresh redirects in ``html_col``, by the redirects of ``aliases`` to bare hosts, and
    by further edges ``links`` (columns ``source`` and ``target``, urls). An explicit allow thus always
    stands, also inside a blocked component; it doesn't unblock others. Targets that are no
    pages themselves take part.

    Null urls, and texts without ``://``, have empty host and path, no rule, no aliases, and are
    allowed. Null or empty markup has no links. Equal rows are judged alike. Input columns with the names of results
    are replaced.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(rules, "rule string, verdict string")
    rules = materialize(rules.select("rule", "verdict").distinct(), "rules")
    n_rules = rules.count()

    own = pages.select(key_of(col(url_col)).alias("key")).where(F.col("key").isNotNull()).distinct()
    own = materialize(own, "keys")
    edges = alias_links(own, aliases)
    if html_col:
        edges = edges.union(declared_links(pages, url_col, html_col))
    if links is not None:
        edges = edges.union(links.select(key_of(F.col("source")), key_of(F.col("target"))))
    edges = materialize(edges.where("source <> target").distinct(), "links")

    ends = edges.select(F.col("source").alias("key")).union(edges.select(F.col("target").alias("key"))).distinct()
    names = materialize(numbered(ends, "key", "node"), "nodes")
    ruled = materialize(decide_by_rules(own.union(ends).distinct(), rules, n_rules, broadcast_rules), "ruled")

    by_id = edges.join(names.select(F.col("key").alias("source"), F.col("node").alias("u")), "source").join(
        names.select(F.col("key").alias("target"), F.col("node").alias("v")), "target"
    )
    member = materialize(components(by_id.select("u", "v")).select(F.col("vertex").alias("node"), "root").join(names, "node"), "members")
    blocked = ruled.where("verdict = 'block'").select("key").join(member, "key").select("root").distinct()
    tainted = materialize(member.join(blocked, "root").select("key", F.lit(True).alias("_tainted")), "tainted")

    facts = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c not in facts]
    out = pages.select(*[col(c) for c in kept], host_of(col(url_col)).alias("host"), path_of(col(url_col)).alias("path"),
                       key_of(col(url_col)).alias("_key"))
    known = ruled.select(F.col("key").alias("_key"), "rule", F.col("verdict").alias("_ruled"))
    out = out.join(known, "_key", "left").join(tainted.withColumnRenamed("key", "_key"), "_key", "left")
    verdict = F.coalesce("_ruled", F.when(F.col("_tainted"), "block"), F.lit("allow"))
    return out.select(*[col(c) for c in kept], "host", "path", "rule", verdict.alias("verdict"))


def op2_redirects(spark: SparkSession, base: str) -> DataFrame:
    pages = table(spark, base, "pages").select("page_id", "url", "html")
    return judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


URL_SQL = """
WITH RECURSIVE rules(host, start, verdict, rule) AS (
  VALUES ('com', '/', 'allow', 'com/'), ('example.com', '/en/', 'block', 'example.com/en/'),
         ('www.example.com', '/en/', 'allow', 'www.example.com/en/'), ('net', '/es/', 'block', 'net/es/'), ('net', '/fr/', 'block', 'net/fr/')
), pages2 AS (
  SELECT page_id, html, coalesce(url LIKE '%://%', false) AS is_url,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*[^?#]*(\\?[^#]*)?', 1, 's'), '') AS query
  FROM pages
), declared AS (
  SELECT host || path || query AS source, unnest(
    list_transform(list_filter(regexp_extract_all(html, '(?i)<link\\b[^<>]*>'), lambda t: regexp_matches(t, '(?i)\\brel\\s*=\\s*["'']?\\s*canonical')),
                   lambda t: regexp_extract(t, '(?i)\\bhref\\s*=\\s*["'']?\\s*([^"''\\s<>]+)', 1)) ||
    list_transform(list_filter(regexp_extract_all(html, '(?i)<meta\\b[^<>]*>'), lambda t: regexp_matches(t, '(?i)\\bhttp-equiv\\s*=\\s*["'']?\\s*refresh')),
                   lambda t: regexp_extract(t, '(?i)["''\\s;]url\\s*=\\s*["'']?\\s*([^"''\\s<>;]+)', 1))) AS url
  FROM pages2 WHERE is_url
), edges AS (
  SELECT source, regexp_extract(url, '://([^#]*)', 1) AS target FROM declared
  UNION
  SELECT host || path || query, regexp_extract(host || path || query, '^(www|m)\\.([^./?]+\\..*)$', 2, 's') FROM pages2
  WHERE is_url AND regexp_matches(host || path || query, '^(www|m)\\.([^./?]+\\..*)$', 's')
), both_ways AS (
  SELECT source, target FROM edges UNION SELECT target, source FROM edges
), keys AS (
  SELECT host || path || query AS key FROM pages2 WHERE is_url UNION SELECT source FROM both_ways
), fits AS (
  SELECT key, rule, verdict FROM (
    SELECT key, rule, verdict, row_number() OVER (PARTITION BY key ORDER BY length(rule) DESC) AS place
    FROM (SELECT key, regexp_extract(key, '^[^/?]*') AS host, regexp_extract(key, '^[^/?]*([^?]*)', 1, 's') AS path FROM keys) k
    JOIN rules r ON (k.host = r.host OR k.host LIKE '%.' || r.host) AND starts_with(k.path, r.start))
  WHERE place = 1
), tainted(key) AS (
  SELECT key FROM fits WHERE verdict = 'block'
  UNION
  SELECT b.target FROM tainted t JOIN both_ways b ON b.source = t.key
)
SELECT p.page_id, p.host, p.path, f.rule, CASE WHEN f.rule IS NOT NULL THEN f.verdict WHEN t.key IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM pages2 p LEFT JOIN fits f ON p.is_url AND f.key = p.host || p.path || p.query
LEFT JOIN tainted t ON p.is_url AND t.key = p.host || p.path || p.query
"""

QUERIES = {"op2_redirects": op2_redirects}
SQL = {"op2_redirects": URL_SQL}
