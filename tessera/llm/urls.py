"""URL rules, spread over redirects and canonical links."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint, let, small, spread_join
from tessera.llm.components import connected_components

#: Fixed rules of the query: action, host and path.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What is no markup of the page: comments, and what scripts and the like hold.
UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|textarea|title)\b.*?(?:</\1\s*>|\z)"
TAG = r"(?is)<(?:link|meta|base)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
ATTRIBUTE = r"(?is)([^\s\"'<>/=]+)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
REFRESH = r"(?is)^\s*[0-9.]*\s*[;,]?\s*(?:url\s*=\s*)?(?:\"([^\"]*)|'([^']*)|(.*))"
#: The named character references that a url is written with, the ampersand last.
NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
#: Default ports.
PORTS = (("http", ":80"), ("https", ":443"))


def host(url: Column) -> Column:
    """From after the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; empty for a null or without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``? #`` or the end; empty for a null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "action string, host string, path string")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, action) for each url that a rule fits; the longest rule wins, and of equally long ones an allow.

    Each url looks up the suffixes of its host at label borders, so the work doesn't grow with the number of rules.
    """
    h, labels = host(F.col("url")), F.split(host(F.col("url")), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    r = small(rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), "action"))
    rule = F.concat("suffix", "prefix")
    best = F.max(F.struct(F.length(rule).alias("n"), (F.col("action") == "allow").alias("allow"), rule.alias("rule"), F.col("action").alias("action")))
    return (
        urls.where(h != "").select("url", path(F.col("url")).alias("path"), F.explode(suffixes).alias("suffix"))
        .join(r, "suffix").where(F.col("path").startswith(F.col("prefix")))
        .groupBy("url").agg(best.alias("b")).select("url", "b.rule", "b.action")
    )


def unescaped(text: Column) -> Column:
    """The text with its numeric character references and the named ones of ``NAMED`` read."""

    def read(part: Column, whole: Column, code: Column) -> Column:
        letter = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        fits = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(fits, F.concat(letter, F.substring(part, F.length(whole) + 1, F.length(part)))).otherwise(F.concat(F.lit("&#"), part))

    def number(digits: Column) -> Column:
        return F.when(F.lower(F.substring(digits, 1, 1)) == "x", F.conv(F.substring(digits, 2, 8), 16, 10)).otherwise(digits).try_cast("int")

    def one(part: Column) -> Column:
        found = F.regexp_extract(part, r"^([xX][0-9A-Fa-f]{1,6}|[0-9]{1,7});?", 0)
        return let(found, lambda w: let(number(F.rtrim(w, F.lit(";"))), lambda code: read(part, w, code)))

    parts = let(F.split(text, "&#"), lambda p: F.concat(p[0], F.array_join(F.transform(F.slice(p, 2, F.size(p)), one), "")))
    out = F.when(F.contains(text, F.lit("&#")), parts).otherwise(text)
    for name, letter in NAMED:
        out = F.replace(out, F.lit(name), F.lit(letter))
    return out


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's first attribute of that name, with its character references read; empty if there is none."""
    found = F.filter(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 0), lambda a: F.lower(F.regexp_extract(a, r"^([^\s=]+)", 1)) == name)
    value = F.regexp_replace(F.coalesce(F.get(found, F.lit(0)), F.lit("")), r"(?s)^[^\s=]+\s*=\s*[\"']?|[\"']$", "")
    return let(value, unescaped)


def without_dots(p: Column) -> Column:
    """A path that begins with a slash, its segments ``.`` and ``..`` resolved."""
    none = F.array().cast("array<string>")

    def step(acc: Column, x: Column) -> Column:
        return F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.array_append(acc, x))

    def whole(segments: Column) -> Column:
        kept = F.aggregate(F.slice(segments, 2, F.size(segments)), none, step)
        end = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(none)
        return F.concat(F.lit("/"), F.array_join(F.concat(kept, end), "/"))

    return F.when(F.contains(p, F.lit("/.")), let(F.split(p, "/"), whole)).otherwise(p)


def canonical(url: Column) -> Column:
    """The url as the name of a vertex: scheme and host in lower case, no default port, no fragment, an empty path as ``/``, dots resolved.

    Null for a url that has no ``scheme://host``.
    """
    def named(u: Column, scheme: Column, h: Column, p: Column) -> Column:
        for name, port in PORTS:
            h = F.when((scheme == name) & h.endswith(port), F.substring(h, 1, F.length(h) - len(port))).otherwise(h)
        query = F.regexp_extract(u, r"(?s)^[^?#]*(\?[^#]*)", 1)
        whole = F.concat(scheme, F.lit("://"), h, F.when(p == "", F.lit("/")).otherwise(without_dots(p)), query)
        return F.when((scheme != "") & (h != ""), whole)

    scheme = lambda u: F.lower(F.regexp_extract(u, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    return let(url, lambda u: let(scheme(u), lambda a: let(host(u), lambda h: let(path(u), lambda p: named(u, a, h, p)))))


def resolved(base: Column, target: Column) -> Column:
    """What a link's target names on a page at ``base``, by RFC 3986, as a vertex; null if that is no ``scheme://host`` url.

    A target is absolute only if it begins with a scheme. An empty one, and one that is only a fragment, names the page itself.
    """
    def whole(page: Column, t: Column) -> Column:
        scheme = F.regexp_extract(page, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*:)//", 1)
        root = F.regexp_extract(page, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
        folder = F.regexp_replace(path(page), r"(?s)[^/]*$", "")
        return (
            F.when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), t)
            .when(t.startswith("//"), F.concat(scheme, t))
            .when(t.startswith("/"), F.concat(root, t))
            .when(t.rlike(r"^(#|$)"), page)
            .when(t.startswith("?"), F.concat(root, path(page), t))
            .otherwise(F.concat(root, let(folder, lambda f: F.when(f == "", F.lit("/")).otherwise(f)), t))
        )

    trimmed = F.regexp_replace(F.regexp_replace(target, r"^[\x00-\x20]+|[\x00-\x20]+$", ""), r"[\t\n\r]", "")
    return canonical(let(base, lambda page: let(trimmed, lambda t: whole(page, t))))


def alias_edges(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(src, dst): vertices that stand for the same page, from canonical links, refresh redirects and ``redirects`` (src, dst).

    Every ``link`` whose rel names ``canonical`` and every ``meta`` refresh counts, wherever it stands outside of comments, scripts and the like. Targets are
    read with their character references and resolved against the page, or against its first ``base``. Both ends are ``canonical``.
    """
    tags = (
        pages.where("url IS NOT NULL AND html IS NOT NULL").where(F.col("html").rlike(r"(?i)\bcanonical\b|http-equiv"))
        .select("url", F.regexp_extract_all(F.regexp_replace("html", UNREAD, " "), F.lit(TAG), 0).alias("tags"))
    )
    refresh = lambda c: F.concat(*(F.coalesce(F.regexp_extract(c, REFRESH, k), F.lit("")) for k in (1, 2, 3)))
    is_link = lambda t: F.array_contains(F.split(F.lower(F.trim(attribute(t, "rel"))), r"\s+"), "canonical")
    is_meta = lambda t: F.lower(F.trim(attribute(t, "http-equiv"))) == "refresh"

    def target(t: Column) -> Column:
        link, meta = F.when(is_link(t), attribute(t, "href")), F.when(is_meta(t), let(attribute(t, "content"), refresh))
        return F.when(t.rlike(r"(?i)^<link\b"), link).when(t.rlike(r"(?i)^<meta\b"), meta)

    def targets(ts: Column, url: Column) -> Column:
        bases = F.filter(F.transform(F.filter(ts, lambda t: t.rlike(r"(?i)^<base\b")), lambda t: attribute(t, "href")), lambda x: x != "")
        base = F.coalesce(let(F.get(bases, F.lit(0)), lambda b: F.when(b.isNotNull(), resolved(url, b))), url)
        found = F.filter(F.transform(ts, target), lambda x: x != "")
        return let(base, lambda b: F.transform(found, lambda t: resolved(b, t)))

    edges = tags.select(canonical(F.col("url")).alias("src"), F.explode(let(F.col("tags"), lambda ts: targets(ts, F.col("url")))).alias("dst"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(canonical(F.col("src")).alias("src"), canonical(F.col("dst")).alias("dst")))
    return edges.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")


def judge_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """The columns of ``pages`` and ``u_host``, ``u_path``, ``u_rule`` and ``u_verdict`` for each row.

    A url that a rule fits has that rule's verdict. Any other takes the verdict of its aliases, the urls that
    redirects and canonical links connect it with: allow if a rule allows one of them (an explicit allow goes before any block), else block
    if a rule blocks one, else allow. Urls of links that are no pages themselves count among the aliases.

    ``pages`` needs url and html. A null url or one without ``://`` has an empty host and path, no rule and no aliases, and is
    allowed. Null or empty html gives no links. Repeated rows stay repeated; an empty table gives an empty result; existing ``u_...`` columns are
    replaced. Rules are looked up once per distinct url and joined back, components are computed on urls that have links only, and a url
    that a large share of the rows has is joined without a shuffle.
    """
    parts = checkpoint(connected_components(alias_edges(pages, redirects)))
    seen = pages.groupBy(F.coalesce("url", F.lit("")).alias("u_id")).agg(F.count(F.lit(1)).alias("u_n"))
    seen = checkpoint(seen.withColumn("u_vertex", canonical(F.col("u_id"))))
    urls = seen.select(F.col("u_id").alias("url")).unionByName(parts.select(F.col("id").alias("url"))).distinct()
    own = checkpoint(matched(urls, rules).select(F.col("url").alias("u_id"), F.col("rule").alias("u_rule"), F.col("action").alias("u_action")))
    named = parts.select(F.col("id").alias("u_vertex"), "component")
    of_pages = seen.select("u_id", "u_vertex").join(named, "u_vertex").join(own, "u_id")
    of_links = named.join(own, F.col("u_vertex") == F.col("u_id"))
    spread = (
        of_pages.select("component", "u_action").unionByName(of_links.select("component", "u_action"))
        .groupBy("component").agg(F.max(F.col("u_action") == "allow").alias("allowed"))
        .select("component", F.when(F.col("allowed"), "allow").otherwise("block").alias("u_alias"))
    )
    aliased = named.join(spread, "component").select("u_vertex", "u_alias")
    known = checkpoint(
        seen.join(own, "u_id", "left").join(aliased, "u_vertex", "left")
        .select("u_id", "u_n", "u_rule", F.coalesce("u_action", "u_alias", F.lit("allow")).alias("u_verdict"))
    )
    kept = [c for c in pages.columns if c not in ("u_host", "u_path", "u_rule", "u_verdict")]
    inner = [c if c == "url" else f"k{k}" for k, c in enumerate(kept)]
    rows = pages.select(*kept).toDF(*inner).select(*inner, host(F.col("url")).alias("u_host"), path(F.col("url")).alias("u_path"), F.coalesce("url", F.lit("")).alias("u_id"))
    total = known.agg(F.sum("u_n")).first()[0] or 0
    return spread_join(rows, known, "u_id", "u_n", total).select(*inner, "u_host", "u_path", "u_rule", "u_verdict").toDF(*kept, "u_host", "u_path", "u_rule", "u_verdict")


def url_table(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) under the fixed rules, for each row of ``pages``; nulls, repeats and an empty table are as in ``judge_urls``."""
    links = checkpoint(alias_edges(pages.select("url", "html")))
    out = judge_urls(pages.select("page_id", "url", F.lit(None).cast("string").alias("html")), rules_frame(pages.sparkSession), links)
    return out.select("page_id", *(F.col(f"u_{c}").alias(c) for c in ("host", "path", "rule", "verdict")))


def _oracle() -> str:
    rules = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in RULES)

    def value(name: str) -> str:
        found = rf"""regexp_extract(tag, '(?is)[\s"'']{name}\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1)"""
        return f"""replace(trim({found}, '"'''), '&amp;', '&')"""

    def vertex(url: str) -> str:
        top = r"^[^:]*://[^/?#]*"
        return rf"regexp_replace(lower(regexp_extract({url}, '{top}', 0)) || regexp_replace({url}, '{top}|#.*$', '', 'gs'), '^([^:]*://[^/?#]*)($|[?])', '\1/\2')"

    return rf"""WITH RECURSIVE rules(action, rhost, rpath) AS (VALUES {rules}),
p AS (SELECT page_id, url, html, lower(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')) AS host,
coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
tags AS (SELECT url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>', ' ', 'g'), '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM p WHERE url LIKE '%://%'),
t AS (SELECT url, CASE WHEN regexp_matches({value("rel")}, '(?i)(^|\s)canonical(\s|$)') THEN {value("href")}
WHEN lower({value("http-equiv")}) = 'refresh' THEN regexp_extract({value("content")}, '(?is)url\s*=\s*[''"]?(.*)$', 1) END AS dst FROM tags),
r AS (SELECT url, regexp_extract(url, '^([^:]*:)//', 1) AS scheme, regexp_extract(url, '^[^:]*://[^/?#]*', 0) AS root,
regexp_extract(url, '^[^:]*://[^/?#]*(/(?:[^?#]*/)?)', 1) AS folder, dst FROM t WHERE dst <> ''),
v AS (SELECT url, CASE WHEN regexp_matches(dst, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN dst WHEN dst LIKE '//%' THEN scheme || dst WHEN dst LIKE '/%' THEN root || dst
WHEN dst LIKE '#%' THEN url WHEN dst LIKE '?%' THEN regexp_extract(url, '^[^?#]*', 0) || dst ELSE root || CASE WHEN folder = '' THEN '/' ELSE folder END || dst END AS dst FROM r),
w AS (SELECT {vertex("url")} AS src, {vertex("dst")} AS dst FROM v WHERE dst LIKE '%://%'),
e AS (SELECT src, dst FROM w UNION SELECT dst, src FROM w),
reach(a, b) AS (SELECT src, dst FROM e UNION SELECT reach.a, e.dst FROM reach JOIN e ON reach.b = e.src),
u AS (SELECT url, {vertex("url")} AS id FROM p WHERE host <> '' UNION SELECT src, src FROM e),
h AS (SELECT url, id, lower(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')) AS host,
coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM u),
m AS (SELECT url, id, rhost || rpath AS rule, action, row_number() OVER (PARTITION BY url, id ORDER BY length(rhost || rpath) DESC, action) AS k
FROM h JOIN rules ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath)),
own AS (SELECT url, id, rule, action FROM m WHERE k = 1),
alias AS (SELECT a, CASE WHEN bool_or(action = 'allow') THEN 'allow' ELSE 'block' END AS verdict FROM reach JOIN own ON own.id = reach.b GROUP BY a)
SELECT page_id, host, path, o.rule, coalesce(o.action, alias.verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT DISTINCT url, rule, action FROM own) o ON o.url = p.url LEFT JOIN alias ON p.host <> '' AND alias.a = {vertex("p.url")}"""


#: DuckDB SQL for ``url_table``. Its rules for links are written apart from those above and are simpler: no ``base``, no dots in paths, no numeric references.
ORACLE = _oracle()
