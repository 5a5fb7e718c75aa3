r"""URL filters: host and path rules, with decisions that pass to a page's aliases.

**Rules.** A rule names a host and the beginning of a path, and allows or
blocks. It fits its host and all subdomains of it; of the rules that fit the
longest (host and path together) counts, among equally long ones an allowing
one, then the smaller text. A short list of rules (``INLINE``) becomes one compiled
expression; a longer one is joined by equality on (host ending, path
beginning), once per distinct host and path.

**Redirect equivalence.** Pages that redirect to each other or name each other
as canonical are one resource under several addresses. Edges come from each
page's HTML (``<link rel=canonical>``, ``<meta http-equiv=refresh>``) and from a table
of redirects if there is one. Addresses are compared without scheme and
fragment, the host in lower case. Connected components over the edges
(distributed; nothing of them reaches the driver) are the groups of aliases: an
address without a rule of its own is blocked if an address of its component,
in the table or only linked to, is blocked by a rule - unless another is
allowed by one: an explicit allow goes first. A rule of an address always
decides for the address itself. Addresses without edges and rules are allowed.

Joins on host, address or component may meet a value with a third of all
rows: rows are aggregated first, and the at most ``HOT`` values that hold more than
``1 / HOT`` of the rows are joined by broadcast, the others by shuffle.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
fits no rule, has no alias and is allowed; null or empty HTML has no links; a
very long URL or HTML is read whole; relative links are put together with the
page's address without resolving dots, links with another scheme than http(s) are no
edges; a page that links to itself has no edge; repeated rows are judged
alike, each of them; an empty table gives no rows; columns named like a
result, in any case, are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecraft.llm.components import components
from lakecraft.llm.tools import documents, stored, without

#: Fixed rules of the contract: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
INLINE = 64
HOT = 64

_CANONICAL = r"""(?is)<link\s[^>]*?\brel\s*=\s*["']?\s*canonical\b[^>]*>"""
_REFRESH = r"""(?is)<meta\s[^>]*?\bhttp-equiv\s*=\s*["']?\s*refresh\b[^>]*>"""
_HREF = r"""(?is)\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_CONTENT_URL = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>;]+)"""


def _lower(c: Column) -> Column:
    """A-Z in lower case, other characters as they are."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))


def host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, in lower case; empty without ``://``."""
    return F.coalesce(_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """The URL without scheme and fragment, its host in lower case; null without ``://``."""
    rest = _rest(url)
    return F.concat(host(url), F.regexp_extract(rest, r"(?s)^[^/?#]*([^#]*)", 1))


# ---------------------------------------------------------------- rules

def _ordered(rules: Sequence[tuple]) -> list[tuple]:
    """Rules, the one that wins first; of rules equal in host and path only the allowing one."""
    best = {}
    for verdict, h, p in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"no verdict: {verdict}")
        best[h + p] = min(best.get(h + p, ("block", h, p)), (verdict, h, p))
    return sorted(best.values(), key=lambda r: (-len(r[1] + r[2]), r[0], r[1] + r[2]))


def _inline(rules: Sequence[tuple]) -> Column:
    """The winning rule as struct (rule, verdict) of the columns ``host`` and ``path``."""
    found = None
    for verdict, h, p in _ordered(rules):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        one = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("_llm_by_rule"))
        found = F.when(fits, one) if found is None else found.when(fits, one)
    return F.lit(None).cast("struct<rule:string,_llm_by_rule:string>") if found is None else found


def _looked_up(places: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (host, path) rows of ``places`` that a rule fits, with rule and _llm_by_rule: the endings of the host
    and the beginnings of the path that are as long as those of some rule meet the rules by equality."""
    shape = rules.agg(F.max(F.size(F.split("h", r"\."))).alias("labels"), F.collect_set(F.length("p")).alias("lengths")).first()
    if not shape.lengths:                                       # no rules; else at most one entry per path length
        return places.where("false").select("host", "path", F.lit("").alias("rule"), F.lit("").alias("_llm_by_rule"))
    ending = F.expr(f"explode(transform(sequence(1, {shape.labels}), i -> substring_index(host, '.', -i)))")
    lengths = F.array(*[F.lit(n) for n in sorted(shape.lengths)])
    start = F.explode(F.filter(lengths, lambda n: n <= F.length("path")))
    keys = (places.select("host", "path").distinct().withColumn("_h", ending).dropDuplicates(["host", "path", "_h"])
            .withColumn("_n", start).withColumn("_p", F.expr("substring(path, 1, _n)")))
    # a host ending like a country may hold most rows: the rules are dealt to SALT places each, and rows to one of them
    salt = 16
    keys = keys.withColumn("_s", F.pmod(F.xxhash64("host", "path"), F.lit(salt)).cast("int"))
    dealt = rules.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    met = keys.join(dealt, (keys["_h"] == dealt["h"]) & (keys["_p"] == dealt["p"]) & (keys["_s"] == dealt["_s"]))
    text = F.concat("h", "p")
    best = F.min(F.struct((-F.length(text)).alias("l"), F.col("verdict").alias("_llm_by_rule"), text.alias("rule"))).alias("b")
    return met.groupBy("host", "path").agg(best).select("host", "path", "b.rule", "b._llm_by_rule")


def with_rule(rows: DataFrame, rules) -> DataFrame:
    """``rows`` (with host and path) plus rule and _llm_by_rule (null where none fits). ``rules`` is a list of
    (verdict, host, path) or a DataFrame with these columns."""
    if not isinstance(rules, DataFrame) and len(rules) <= INLINE:
        return rows.withColumn("_llm_r", _inline(rules)).select(*[F.col(f"`{c}`") for c in rows.columns], "_llm_r.rule", "_llm_r._llm_by_rule")
    table = rules if isinstance(rules, DataFrame) else rows.sparkSession.createDataFrame(_ordered(rules), "verdict string, host string, path string")
    table = table.select("verdict", F.col("host").alias("h"), F.col("path").alias("p")).groupBy("h", "p").agg(F.min("verdict").alias("verdict"))
    return join_hot(rows, stored(_looked_up(rows, table), "url-rules"), ["host", "path"])


def join_hot(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of ``rows`` with ``table`` (one row per key). The keys that more than ``1 / HOT`` of the rows
    hold, at most ``HOT`` of them, are joined by broadcast; the others by shuffle."""
    counts = rows.select(*keys).join(table.select(*keys), list(keys), "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counts = stored(counts, "url-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.where(F.col("_n") * HOT > total).select(*keys, F.lit(True).alias("_llm_hot"))
    tagged = rows.join(F.broadcast(hot), list(keys), "left")                       # at most HOT rows
    some = F.broadcast(table.join(F.broadcast(hot), list(keys)).drop("_llm_hot"))
    first = tagged.where("_llm_hot").drop("_llm_hot").join(some, list(keys), "left")
    rest = tagged.where("_llm_hot IS NULL").drop("_llm_hot").join(table, list(keys), "left")
    names = [*rows.columns, *[c for c in table.columns if c not in keys]]
    return first.select(*names).unionByName(rest.select(*names))


# ---------------------------------------------------------------- aliases

def links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(source, target) URLs of canonical links and refreshes in the pages' HTML."""
    html = F.col(f"`{html_col}`")
    tags = lambda kind: F.regexp_extract_all(html, F.lit(kind), F.lit(0))
    inside = lambda tag, where: F.trim(F.regexp_replace(F.regexp_extract(tag, where, 1), "^[\"']|[\"']$", ""))
    found = F.concat(F.transform(tags(_CANONICAL), lambda t: inside(t, _HREF)), F.transform(tags(_REFRESH), lambda t: inside(t, _CONTENT_URL)))
    rows = pages.where(html.contains("<")).select(F.col(f"`{url_col}`").alias("source"), F.explode(found).alias("link"))
    rows = rows.where((F.col("link") != "") & F.col("source").contains("://"))
    scheme, site = F.substring_index("source", "://", 1), F.concat(F.substring_index("source", "://", 1), F.lit("://"), host(F.col("source")))
    target = (F.when(F.col("link").rlike(r"(?i)^https?://"), F.col("link")).when(F.col("link").rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), None)
              .when(F.col("link").startswith("//"), F.concat(scheme, F.lit(":"), "link"))
              .when(F.col("link").startswith("/"), F.concat(site, "link"))
              .when(F.col("link").startswith("#"), None)
              .when(F.col("link").startswith("?"), F.concat(site, path(F.col("source")), "link"))
              .otherwise(F.concat(site, F.regexp_extract(F.concat(F.lit("/"), F.ltrim(path(F.col("source")), F.lit("/"))), "^.*/", 0), "link")))
    return rows.select("source", target.alias("target")).where("target IS NOT NULL")


def alias_verdicts(edges: DataFrame, rules) -> DataFrame:
    """(source, target) URLs to one row per address with an edge: address, _llm_by_alias (``block``, or null where its
    component is not blocked or some address of it is allowed)."""
    ends = edges.select(address(F.col("source")).alias("a"), address(F.col("target")).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    named = lambda c: F.unhex(F.md5(F.col(c)))
    pairs = stored(ends.select("a", "b", named("a").alias("u"), named("b").alias("v")).distinct(), "url-edges")
    if pairs.isEmpty():
        return edges.sparkSession.createDataFrame([], "address string, _llm_by_alias string")
    groups = stored(components(pairs.select("u", "v")), "url-groups")
    nodes = pairs.select(F.col("a").alias("address"), F.col("u").alias("node")).unionByName(
        pairs.select(F.col("b").alias("address"), F.col("v").alias("node"))).distinct()
    url = F.concat(F.lit("x://"), "address")
    judged = with_rule(nodes.select("address", "node", host(url).alias("host"), path(url).alias("path")), rules)
    grouped = stored(judged.join(groups, "node").select("address", "component", "_llm_by_rule"), "url-aliases")
    # one value per component, combined before the shuffle: a component may hold a third of all addresses
    decided = grouped.groupBy("component").agg(F.min("_llm_by_rule").alias("_llm_by_alias"))     # "allow" sorts before "block"
    decided = decided.where("_llm_by_alias = 'block'")
    return join_hot(grouped.select("address", "component"), decided, ["component"]).select("address", "_llm_by_alias")


def judge(pages: DataFrame, rules, url_col: str = "url", html_col: str | None = "html", redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` plus host, path, rule (text of the rule that fits; else null), verdict (``allow`` or ``block``) and
    reason (``rule``, ``alias``, or ``none`` for what is allowed without either). ``redirects`` has source and target URLs."""
    base = without(pages, "host", "path", "rule", "verdict", "reason")
    url = F.col(f"`{url_col}`")
    edges = links(pages, url_col, html_col) if html_col else None
    if redirects is not None:
        more = redirects.select("source", "target")
        edges = more if edges is None else edges.unionByName(more)
    placed = base.withColumns({"host": host(url), "path": path(url), "_llm_a": address(url)})
    rows = with_rule(placed, rules)
    if edges is None:
        rows = rows.withColumn("_llm_by_alias", F.lit(None).cast("string"))
    else:
        known = stored(alias_verdicts(edges, rules).where("_llm_by_alias IS NOT NULL"), "url-blocked").withColumnRenamed("address", "_llm_a")
        rows = rows.withColumn("_llm_by_alias", F.lit(None).cast("string")) if known.isEmpty() else join_hot(rows, known, ["_llm_a"])
    verdict = F.coalesce("_llm_by_rule", "_llm_by_alias", F.lit("allow"))
    reason = F.when(F.col("_llm_by_rule").isNotNull(), "rule").when(F.col("_llm_by_alias").isNotNull(), "alias").otherwise("none")
    return rows.select(*[F.col(f"`{c}`") for c in base.columns], "host", "path", "rule", verdict.alias("verdict"), reason.alias("reason"))


#: Contract op12 in DuckDB: rules by comparison, aliases by a recursive walk over the links.
OP12_SQL = r"""
WITH RECURSIVE law(verdict, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<link\s[^>]*?\brel\s*=\s*["'']?\s*canonical\b[^>]*>')) AS tag, 'href' AS kind FROM pages
  UNION ALL
  SELECT url, unnest(regexp_extract_all(html, '(?is)<meta\s[^>]*?\bhttp-equiv\s*=\s*["'']?\s*refresh\b[^>]*>')), 'url' FROM pages),
hits AS (
  SELECT url, trim(CASE kind WHEN 'href' THEN regexp_replace(regexp_extract(tag, '(?is)\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '^["'']|["'']$', '', 'g')
                             ELSE regexp_extract(tag, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>;]+)', 1) END) AS link FROM tags WHERE contains(url, '://')),
goals AS (
  SELECT url, split_part(url, '://', 1) AS scheme, split_part(url, '://', 1) || '://' || lower(regexp_extract(url, '^.*?://([^/?#]*)', 1)) AS site,
         regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1) AS way, link FROM hits WHERE link <> ''),
edge AS (
  SELECT url AS a, CASE WHEN regexp_matches(link, '(?i)^https?://') THEN link WHEN regexp_matches(link, '(?i)^[a-z][a-z0-9+.-]*:') THEN NULL
                        WHEN starts_with(link, '//') THEN scheme || ':' || link WHEN starts_with(link, '/') THEN site || link
                        WHEN starts_with(link, '#') THEN NULL WHEN starts_with(link, '?') THEN site || way || link
                        ELSE site || regexp_extract('/' || ltrim(way, '/'), '^.*/') || link END AS b FROM goals),
named AS (
  SELECT lower(regexp_extract(a, '^.*?://([^/?#]*)', 1)) || regexp_extract(a, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS a,
         lower(regexp_extract(b, '^.*?://([^/?#]*)', 1)) || regexp_extract(b, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS b FROM edge WHERE b IS NOT NULL),
two_way AS (SELECT a, b FROM named UNION SELECT b, a FROM named),
walk(a, b) AS (SELECT a, a FROM two_way UNION SELECT walk.a, two_way.b FROM walk JOIN two_way ON walk.b = two_way.a),
place AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN lower(regexp_extract(url, '^.*?://([^/?#]*)', 1)) ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
         CASE WHEN contains(url, '://') THEN lower(regexp_extract(url, '^.*?://([^/?#]*)', 1)) || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) END AS node
  FROM pages),
node AS (SELECT DISTINCT b AS name, regexp_extract(b, '^[^/?#]*') AS h0, regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS p0 FROM walk),
decided AS (
  SELECT name, (SELECT arg_max(verdict, length(h || p)) FROM law WHERE (h0 = h OR ends_with(h0, '.' || h)) AND starts_with(p0, p)) AS v FROM node),
alias AS (SELECT a AS name, min(v) AS v FROM walk JOIN decided ON decided.name = walk.b GROUP BY a),
ruled AS (
  SELECT place.*, (SELECT arg_max({'rule': h || p, 'verdict': verdict}, length(h || p)) FROM law
                   WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS r FROM place)
SELECT page_id, host, path, r.rule AS rule, CASE WHEN r IS NOT NULL THEN r.verdict WHEN alias.v = 'block' THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN r IS NOT NULL THEN 'rule' WHEN alias.v = 'block' THEN 'alias' ELSE 'none' END AS reason
FROM ruled LEFT JOIN alias ON alias.name = ruled.node
"""


def op12_url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract op12: the verdict on every page."""
    return judge(documents(spark, sf_dir, "pages").select("page_id", "url", "html"), RULES).drop("url", "html")
