"""URL filtering with redirect equivalence.

A rule (host, path, verdict) fits its host and all subdomains when the URL's path
starts with the rule's; the longest rule wins. URLs without a rule take the verdict
of their equivalence class: connected components over redirect and canonical-link
edges carry block decisions to all aliases, unless an alias is explicitly allowed.
So precedence is: the URL's own rule, an alias's allow, an alias's block, allow.

Edges come from the pages' whole markup (``<link rel=canonical href>`` and
``<meta http-equiv=refresh content="...url=...">``), and from an optional table of
redirects. Markup is read as a browser does: what stands in comments, scripts, styles
and other raw text is no link, ``rel`` is a list of words, attributes count by their
whole names, character references are decoded, and the first ``<base href>`` is what
references are relative to. References are resolved by RFC 3986 (dot segments, those of
a query alone, of a host without scheme). Links that lead nowhere on the web (other
schemes, broken hosts) make no edge.

A URL is a node without its fragment, scheme and host lower-cased, without its scheme's
usual port, dot segments taken out. Components are found by distributed star rounds.

Defined results: the host is what follows the first ``://`` up to ``/ ? #``, A-Z
lower-cased; the path what follows up to ``? #``. Both are empty for a null URL or
one without ``://``; then only the default holds, as such a URL has no node.
Repeated rows and URLs are judged alike; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagdiff.llm.common import arrow_column, ascii_lower, attach_by_key, chunks, materialize
from bagdiff.llm.components import components

ALLOW, BLOCK = "allow", "block"

#: Rules in order of the contract.
RULES = [
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules) -> Column:
    """struct(size, rule, verdict) of the longest rule that fits, null if none."""
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    table = F.array(
        *[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    )

    def fits(r):
        below = F.concat(F.lit("."), host).endswith(F.concat(F.lit("."), r["host"]))
        return below & path.startswith(r["path"])

    def sized(r):
        rule = F.concat(r["host"], r["path"])
        return F.struct(F.length(rule).alias("size"), rule.alias("rule"), r["verdict"].alias("verdict"))

    return F.array_max(F.transform(F.filter(table, fits), sized))


#: Ports that a URL of the scheme need not name.
USUAL_PORTS = {"http": "80", "https": "443"}


def node_of(url: Column) -> Column:
    """The URL without its fragment, scheme and host lower-cased, without a usual port; null without a host."""
    bare = F.regexp_extract(url, r"(?s)^[^#]*", 0)
    scheme = ascii_lower(F.regexp_extract(bare, r"(?s)^(.*?)://", 1))
    after = F.regexp_extract(bare, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    host = host_of(bare)
    for name, port in USUAL_PORTS.items():
        host = F.when(scheme == name, F.regexp_replace(host, f":({port})?$", "")).otherwise(host)
    after = F.when(after.startswith("/"), after).otherwise(F.concat(F.lit("/"), after))
    return F.when(host != "", F.concat(scheme, F.lit("://"), host, _without_dots(after)))


def _without_dots(after: Column) -> Column:
    """Path and query without the path's dot segments; a path without any stays as it is."""
    path, query = F.regexp_extract(after, r"(?s)^[^?]*", 0), F.regexp_extract(after, r"(?s)^[^?]*(.*)$", 1)
    names = F.split(path, "/")  # the first is empty: paths begin with a slash

    def step(held: Column, name: Column) -> Column:
        up = F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0)))
        return F.when(name == "..", up).when(name == ".", held).otherwise(F.concat(held, F.array(name)))

    held = F.aggregate(F.slice(names, 2, F.size(names)), F.array().cast("array<string>"), step)
    held = F.when(F.element_at(names, -1).isin(".", ".."), F.concat(held, F.array(F.lit("")))).otherwise(held)
    whole = F.concat(F.lit("/"), F.array_join(held, "/"), query)
    return F.when(path.rlike(r"/\.\.?(/|$)"), whole).otherwise(after)


def _patterns():
    import re

    # no "<" outside quotes, so a tag that never ends costs no more than up to the next one
    attributes = r"""(?:[^<>"']|"[^"<]*+"|'[^'<]*+')*+"""
    return {
        # raw text first, so that tags inside it are passed over
        "tag": re.compile(
            rf"<!--.*?(?:-->|\Z)"
            rf"|<(?:script|style|textarea|title|iframe|xmp|noembed|noframes|template)\b{attributes}>"
            rf"|<(link|meta|base)\b({attributes})>",
            re.S | re.I,
        ),
        "name": re.compile(r"<([A-Za-z]+)"),
        "attribute": re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?"""),
        "web": re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://"),
        "refresh": re.compile(r"""^[\s\d.]*[;,\s]\s*url\s*=\s*(?:"([^"]*)|'([^']*)|(.*))""", re.S | re.I),
    }


def _tags(page: str, patterns):
    """(name, values of attributes) of each link, meta and base element outside comments and raw text."""
    import re
    from html import unescape

    at = 0
    while m := patterns["tag"].search(page, at):
        at = m.end()
        if m.group(1):
            values: dict[str, str] = {}
            for a in patterns["attribute"].finditer(m.group(2)):
                values.setdefault(a.group(1).lower(), unescape(a.group(2) or a.group(3) or a.group(4) or "").strip())
            yield m.group(1).lower(), values
        elif raw := patterns["name"].match(m.group()):
            end = re.compile(rf"</{raw.group(1)}\b", re.I).search(page, at)
            at = end.end() if end else len(page)


def links_of(url: str | None, page: str | None, patterns=None) -> list[str]:
    """Absolute targets of a page's canonical links and refreshes, in page order."""
    from urllib.parse import urljoin

    patterns = patterns or _patterns()
    base, refs = None, []
    for name, values in _tags(page or "", patterns):
        if name == "base":
            base = values.get("href") if base is None else base
        elif name == "link":
            if "canonical" in values.get("rel", "").lower().split():
                refs.append(values.get("href"))
        elif values.get("http-equiv", "").lower() == "refresh":
            found = patterns["refresh"].match(values.get("content", ""))
            refs.append(next((g for g in found.groups() if g), None) if found else None)
    out = []
    for ref in refs:
        if ref and ref.strip():
            try:
                target = urljoin(urljoin(url or "", base or ""), ref.strip())
            except ValueError:  # a host in broken brackets
                continue
            if patterns["web"].match(target):
                out.append(target)
    return out


def _links(url: Column, html: Column) -> Column:
    """The targets of ``links_of`` as an array of strings."""

    def run(batches):
        import pyarrow as pa

        patterns = _patterns()
        for batch in batches:
            held, found = batch.flatten(), []
            urls = held[0].to_pylist()
            for first, pages in chunks(held[1]):
                found += [links_of(u, p, patterns) for u, p in zip(urls[first : first + len(pages)], pages, strict=True)]
            yield pa.array(found, pa.list_(pa.string()))

    return arrow_column(run, "array<string>", F.struct(url.alias("url"), html.alias("html")))


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): nodes that a page's canonical link or refresh declares equal to the page's URL; null for one without host.

    Only pages with an element that may declare one reach Python.
    """
    declared = F.col(html).rlike(r"(?i)<(?:link|meta)\b")
    found = pages.filter(declared).select(F.col(url).alias("url"), F.col(html).alias("html"))
    found = found.select("url", F.explode(_links(F.col("url"), F.col("html"))).alias("target"))
    return found.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b"))


def judge(
    pages: DataFrame,
    rules=RULES,
    redirects: DataFrame | None = None,
    id: str = "page_id",
    url: str = "url",
    html: str | None = "html",
) -> DataFrame:
    """One row per row of ``pages``: ``id``, host, path, rule, verdict. ``redirects``: (from, to) URLs."""
    place = F.col("url")
    rows = pages.select(F.col(id).alias("id"), place if url == "url" else F.col(url).alias("url"))
    rows = rows.select(
        "id",
        node_of(place).alias("node"),
        host_of(place).alias("host"),
        path_of(place).alias("path"),
    ).withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    edges = None
    if html:
        edges = link_edges(pages, url, html)
    if redirects is not None:
        a, b = redirects.columns[:2]
        more = redirects.select(node_of(F.col(a)).alias("a"), node_of(F.col(b)).alias("b"))
        edges = more if edges is None else edges.unionByName(more)
    if edges is None:
        edges = rows.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"))
    joined = components(materialize(edges, "url-links"))
    parts = joined.select("*", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    ruled = parts.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)["verdict"])
    verdicts = ruled.groupBy("component").agg(
        F.max(F.col("r") == ALLOW).alias("allowed"), F.max(F.col("r") == BLOCK).alias("blocked")
    )
    blocked = verdicts.filter("blocked and not coalesce(allowed, false)").select("component")
    blocked = materialize(blocked, "url-blocked", narrow=True)  # so that the join can split a hub's component
    aliases = joined.join(blocked, "component", "left_semi").select("node")
    counted = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).join(aliases, "node")
    counted = materialize(counted.withColumn("alias", F.lit(BLOCK)), "url-aliases", narrow=True)
    total = counted.agg(F.sum("n")).first()[0] or 0
    found = attach_by_key(rows, counted, "node", "n", total)
    return found.select(
        F.col("id").alias(id),
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "alias", F.lit(ALLOW)).alias("verdict"),
    )
