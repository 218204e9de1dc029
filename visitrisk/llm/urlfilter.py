"""URL filters with redirect equivalence: block decisions reach every alias of a blocked URL.

**Rules.** A rule has a host, a path and a verdict. It fits a URL whose host is the rule's or a subdomain of it and
whose path begins with the rule's; the longest rule that fits decides.

**Aliases.** A URL's node is its host, path and query, without scheme, the scheme's own port and fragment; an empty path
is ``/``. A link is absolute if it begins with a scheme and ``://``, ``&amp;`` in it is ``&``; ``.`` and ``..`` in paths
and a page's ``<base>`` are not resolved. A page's canonical link and
its meta refresh, and redirects given as a table, are edges between nodes. Connected components of the edges
are computed by distributed star steps. A page that no rule fits is blocked if any node of its component,
crawled or not, is blocked by a rule. A rule's own verdict, an explicit allow above all, always stands, also
within a blocked component. Pages that neither rule nor component decides are allowed.

DataFrame functions only. Defined cases: NULL URLs, and those without ``://``, have empty host and path, no node
and no rule; NULL pages have no links; links to the page itself say nothing; repeated rows are judged alike;
an empty table gives none; extra columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitrisk.llm.common import lower_ascii, stored
from visitrisk.llm.components import components

Rule = tuple[str, str, str]

ALLOW, BLOCK = "allow", "block"

LINK_TAG = r"(?i)<link\b[^>]*>"
CANONICAL = r"""(?i)[\s"']rel\s*=\s*["']?canonical["'\s/>]"""
HREF = r"""(?i)[\s"']href\s*=\s*["']?([^"'\s>]+)"""
META_TAG = r"(?i)<meta\b[^>]*>"
REFRESH = r"""(?i)[\s"']http-equiv\s*=\s*["']?refresh["'\s/>]"""
TARGET = r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)"""
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.-]*://"
OWN_PORT = r"(?i)^(http://[^/?#]*):80([/?#]|$)|^(https://[^/?#]*):443([/?#]|$)"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def without_own_port(url: Column) -> Column:
    return F.regexp_replace(url, OWN_PORT, "$1$2$3$4")


def host(rest: Column) -> Column:
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def node(rest: Column) -> Column:
    """Host, path and query; NULL where nothing follows the scheme."""
    query = F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)
    return F.when(rest != "", F.concat(host(rest), F.when(path(rest) == "", "/").otherwise(path(rest)), query))


def decision(rules: list[Rule], of_host: Column, of_path: Column) -> Column:
    """Struct of rule (host and path) and verdict of the longest rule that fits; NULL if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((of_host == name) | of_host.endswith("." + name)) & of_path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def links(pages: DataFrame) -> DataFrame:
    """(a, b): nodes of pages and of the URLs that their canonical links and meta refreshes name."""
    of = lambda tag, mark, value: F.transform(F.filter(F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda t: t.rlike(mark)), lambda t: F.regexp_extract(t, value, 1))
    named = F.explode(F.concat(of(LINK_TAG, CANONICAL, HREF), of(META_TAG, REFRESH, TARGET)))
    rows = pages.filter("html IS NOT NULL").select(after_scheme(without_own_port(F.col("url"))).alias("rest"), named.alias("to")).filter("rest <> '' AND `to` <> ''")
    site = F.regexp_extract("rest", r"^[^/?#]*", 0)
    folder = F.regexp_extract("rest", r"^[^/?#]*(/(?:[^?#]*/)?)?", 0)
    to = F.replace(F.col("to"), F.lit("&amp;"), F.lit("&"))
    target = (
        F.when(to.rlike(ABSOLUTE), after_scheme(without_own_port(to)))
        .when(to.startswith("//"), F.substr(to, F.lit(3)))
        .when(to.startswith("/"), F.concat(site, to))
        .when(to.startswith("?") | to.startswith("#"), F.concat(site, path(F.col("rest")), to))
        .otherwise(F.concat(folder, F.when(folder.endswith("/"), "").otherwise("/"), to))
    )
    return rows.select(node(F.col("rest")).alias("a"), node(target).alias("b")).filter("a <> b")


def blocked_nodes(edges: DataFrame, rules: list[Rule]) -> DataFrame:
    """The nodes (column node) of ``edges`` whose component has a node that a rule blocks."""
    member = stored(components(edges), "aliases")
    verdict = decision(rules, host(F.col("node")), path(F.col("node")))["verdict"]
    roots = member.filter(verdict == BLOCK).select("root").distinct().select("root", F.xxhash64("root").alias("own"))
    return member.withColumn("own", F.xxhash64("root")).join(roots, ["root", "own"], "left_semi").select("node")


def judge(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule (NULL if none fits), verdict and alias_blocked of each row of ``pages`` (page_id,
    url, html). ``redirects`` (from_url, to_url) adds edges."""
    edges = links(pages)
    if redirects is not None:
        ends = redirects.select(*[node(after_scheme(without_own_port(F.col(c)))).alias(n) for c, n in (("from_url", "a"), ("to_url", "b"))])
        edges = edges.unionByName(ends.filter("a <> b"))
    edges = stored(edges.distinct(), "edges")
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    own = pages.select("page_id", after_scheme(url).alias("rest"), after_scheme(without_own_port(url)).alias("plain"))
    own = own.select("page_id", host(F.col("rest")).alias("host"), path(F.col("rest")).alias("path"), node(F.col("plain")).alias("node"))
    own = own.withColumn("own", decision(rules, F.col("host"), F.col("path")))
    if edges.isEmpty():  # no aliases to ask
        own = own.withColumn("alias_blocked", F.lit(False))
    else:
        # Many pages may share a node; the second key gives both sides an exchange that can be split.
        aliases = blocked_nodes(edges, rules).select(F.col("node").alias("of"), F.xxhash64("node").alias("key"), F.lit(True).alias("hit"))
        own = own.join(aliases, (F.col("node") == F.col("of")) & (F.xxhash64("node") == F.col("key")), "left")
        own = own.withColumn("alias_blocked", F.coalesce("hit", F.lit(False)))
    verdict = F.coalesce("own.verdict", F.when(F.col("alias_blocked"), BLOCK).otherwise(ALLOW))
    return own.select("page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"), "alias_blocked")
