"""URL filter by path-template trees (operator 8), DataFrame functions only.

A url's path becomes a template: per host, a segment that varies is a wildcard.  A segment varies if its
shape says so (digits, digits with an extension, long tokens with digits) or if, below the same parent, its literal is
rare: fewer than KEEP rows and under 1/SPREAD of the parent's rows.  The tree is generalised level by level
from its root, and branches of one host that have the same generalised segments merge by that.  Branches of different hosts
merge if they are statistically similar: a host's template takes the purity of the same template over its registered
domain (the last two labels), and that the one over all hosts, unless its own labelled share
differs by more than DIFFER standard errors.

Labels come from the rules: a row that an allow or block rule fits counts as good or bad.  The purity of a
template is its bad share, smoothed by WEIGHT rows of the next wider template's purity.  A url that no rule
fits is blocked if the purity of its template is 1/2 or more.

Edge cases: a null url or one without ``://`` has an empty host and path; an empty path has the empty template; repeated rows
count as often as they come; urls of any length are read, their segments beyond DEPTH fall under one wildcard; without any
labelled row the purity is 0 and the verdict allow; other columns of the input pass through, but for those of the output's names, which are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse.llm.common import packed, shared_checkpoint, unpacked

#: Depth of the tree, and the limits above.
DEPTH, KEEP, SPREAD, WEIGHT, DIFFER = 6, 20, 50, 8.0, 3.0
#: Fixed values: (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def split_url(url) -> tuple:
    """Host and path columns of a url column."""
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host, path) -> tuple:
    """The longest rule that fits, and its verdict (null if none)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _shape(segment):
    """Wildcard of a segment whose form varies, else the segment itself."""
    return (
        F.when(segment.rlike("^[0-9]+$"), F.lit("{n}"))
        .when(segment.rlike("^[0-9]+[.][A-Za-z]{1,5}$"), F.lit("{n}.x"))
        .when((F.length(segment) >= 16) & segment.rlike("[0-9]"), F.lit("{id}"))
        .otherwise(segment)
    )


def shaped(path):
    """The path's segments by shape, joined by slashes."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    deep = F.when(F.size(segments) > DEPTH, F.concat(F.slice(segments, 1, DEPTH), F.array(F.lit("{rest}")))).otherwise(segments)
    return F.array_join(F.transform(deep, _shape), "/")


def grow(paths: DataFrame) -> DataFrame:
    """Adds ``template`` to rows (host, shape, n, ...), one for each shaped path of a host."""
    out = shared_checkpoint(paths.withColumns({"_s": F.split("shape", "/"), "template": F.lit("")}))
    depth = out.agg(F.max(F.size("_s"))).first()[0] or 0  # DEPTH + 1 at most
    for level in range(1, depth + 1):
        out = out.withColumn("_at", F.when(F.col("shape") != "", F.try_element_at("_s", F.lit(level))))
        nodes = out.where("_at is not null").groupBy("host", "template", "_at").agg(F.sum("n").alias("_child"))
        parents = nodes.groupBy("host", "template").agg(F.sum("_child").alias("_parent"))
        rare = (F.col("_child") < KEEP) & (F.col("_child") * SPREAD < F.col("_parent")) & ~F.col("_at").startswith("{")
        nodes = nodes.join(parents, ["host", "template"]).select("host", "template", "_at", F.when(rare, F.lit("{s}")).otherwise(F.col("_at")).alias("_as"))
        out = out.join(nodes, ["host", "template", "_at"], "left")
        out = out.withColumn("template", F.when(F.col("_as").isNotNull(), F.concat("template", F.lit("/"), "_as")).otherwise(F.col("template"))).drop("_at", "_as")
        out = shared_checkpoint(out)  # each level reads the one before three times
    return out.drop("_s")


def _purity(bad, n, wider):
    """Purity of a branch beside the wider one that it may merge with."""
    own = (bad + WEIGHT * wider) / (n + WEIGHT)
    apart = (bad - n * wider) * (bad - n * wider) > DIFFER * DIFFER * n * wider * (1.0 - wider)
    return F.when((n > 0) & apart, own).otherwise(wider)


def judge(pages: DataFrame, url: str = "url") -> DataFrame:
    """pages without ``url``, with host, path, rule, template, purity and verdict."""
    host, path = split_url(F.col(url))
    made = ["host", "path", "rule", "template", "purity", "verdict"]
    pages = pages.drop(*[c for c in made if c != url])
    rows = packed(pages, [url]).withColumns({"host": host, "path": path}).drop(url)
    rule, ruled = rule_of(F.col("host"), F.col("path"))
    rows = rows.withColumns({"rule": rule, "_ruled": ruled, "shape": shaped(F.col("path"))})
    count = {"n": F.count("*"), "bad": F.count_if(F.col("_ruled") == "block"), "known": F.count("_ruled")}
    tree = grow(rows.groupBy("host", "shape").agg(*(c.cast("double").alias(k) for k, c in count.items())))
    tree = tree.withColumn("domain", F.substring_index("host", ".", -2))
    wide = tree.groupBy("template").agg(F.sum("bad").alias("g_bad"), F.sum("known").alias("g_n"))
    domains = tree.groupBy("template", "domain").agg(F.sum("bad").alias("d_bad"), F.sum("known").alias("d_n"))
    hosts = tree.groupBy("template", "domain", "host").agg(F.sum("bad").alias("h_bad"), F.sum("known").alias("h_n"))
    total = tree.agg(F.sum("bad"), F.sum("known")).first()
    share = F.lit(float(total[0]) / float(total[1]) if total[1] else 0.0)
    wide = wide.withColumn("_g", (F.col("g_bad") + WEIGHT * share) / (F.col("g_n") + WEIGHT)).select("template", "_g")
    domains = domains.join(wide, "template").withColumn("_d", _purity(F.col("d_bad"), F.col("d_n"), F.col("_g"))).select("template", "domain", "_d")
    hosts = hosts.join(domains, ["template", "domain"]).withColumn("purity", _purity(F.col("h_bad"), F.col("h_n"), F.col("_d"))).select("template", "host", "purity")
    known = tree.select("host", "shape", "template").join(hosts, ["template", "host"])
    method = F.when(F.col("purity") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    out = rows.join(known, ["host", "shape"], "left").withColumn("verdict", F.coalesce("_ruled", method))
    return unpacked(out, pages.drop(url), *made)


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "template")


def _oracle() -> str:
    """The same in DuckDB's SQL, with one step for each level of the tree."""
    rules = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in rules]
    rule = " ".join(f"WHEN {c} THEN '{h}{p}'" for c, (h, p, _) in zip(fits, rules, strict=True))
    ruled = " ".join(f"WHEN {c} THEN '{v}'" for c, (_, _, v) in zip(fits, rules, strict=True))
    sql = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), segs AS (
  SELECT *, CASE {rule} END AS rule, CASE {ruled} END AS ruled, list_filter(string_split(path, '/'), lambda s: s <> '') AS s FROM parsed
), page_rows AS (
  SELECT page_id, host, path, rule, ruled,
    list_transform(CASE WHEN len(s) > {DEPTH} THEN list_append(s[1:{DEPTH}], '{{rest}}') ELSE s END,
      lambda x: CASE WHEN regexp_matches(x, '^[0-9]+$') THEN '{{n}}' WHEN regexp_matches(x, '^[0-9]+[.][A-Za-z]{{1,5}}$') THEN '{{n}}.x'
                WHEN len(x) >= 16 AND regexp_matches(x, '[0-9]') THEN '{{id}}' ELSE x END) AS shape FROM segs
), tree0 AS (
  SELECT host, shape, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (ruled = 'block') AS DOUBLE) AS bad, CAST(count(ruled) AS DOUBLE) AS known, '' AS template
  FROM page_rows GROUP BY host, shape
)"""
    for k in range(1, DEPTH + 2):
        sql += f""", nodes{k} AS (
  SELECT host, template, shape[{k}] AS at, sum(n) AS child, sum(sum(n)) OVER (PARTITION BY host, template) AS parent
  FROM tree{k - 1} WHERE shape[{k}] IS NOT NULL GROUP BY host, template, shape[{k}]
), tree{k} AS (
  SELECT t.host, t.shape, t.n, t.bad, t.known, t.template || CASE WHEN b.at IS NULL THEN '' ELSE '/' ||
    CASE WHEN b.child < {KEEP} AND b.child * {SPREAD} < b.parent AND NOT starts_with(b.at, '{{') THEN '{{s}}' ELSE b.at END END AS template
  FROM tree{k - 1} t LEFT JOIN nodes{k} b ON t.host = b.host AND t.template = b.template AND t.shape[{k}] = b.at
)"""
    purity = "CASE WHEN {n} > 0 AND ({b} - {n} * {w}) * ({b} - {n} * {w}) > " + f"{DIFFER * DIFFER} * {{n}} * {{w}} * (1.0 - {{w}}) THEN ({{b}} + {WEIGHT} * {{w}}) / ({{n}} + {WEIGHT}) ELSE {{w}} END"
    last = f"tree{DEPTH + 1}"
    return sql + f""", tree AS (
  SELECT *, CASE WHEN len(string_split(host, '.')) > 2 THEN array_to_string(string_split(host, '.')[-2:], '.') ELSE host END AS domain FROM {last}
), total AS (SELECT CASE WHEN coalesce(sum(known), 0) > 0 THEN sum(bad) / sum(known) ELSE 0.0::DOUBLE END AS share FROM tree
), wide AS (SELECT template, (sum(bad) + {WEIGHT} * any_value(share)) / (sum(known) + {WEIGHT}) AS g FROM tree, total GROUP BY template
), domains AS (
  SELECT template, domain, {purity.format(n="x.n", b="x.b", w="wide.g")} AS d
  FROM (SELECT template, domain, sum(bad) AS b, sum(known) AS n FROM tree GROUP BY ALL) x JOIN wide USING (template)
), hosts AS (
  SELECT template, host, {purity.format(n="x.n", b="x.b", w="domains.d")} AS purity
  FROM (SELECT template, domain, host, sum(bad) AS b, sum(known) AS n FROM tree GROUP BY ALL) x JOIN domains USING (template, domain)
)
SELECT page_id, r.host, path, rule, coalesce(ruled, CASE WHEN purity >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict, template
FROM page_rows r JOIN {last} t ON r.host = t.host AND r.shape = t.shape JOIN hosts USING (template) WHERE hosts.host = r.host
"""


ORACLE_OP8 = _oracle()
