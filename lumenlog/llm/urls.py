"""URL filters: explicit host/path rules, then a path-template tree per host.

Rules come first: a rule ``host/path`` fits its host and every subdomain where
the url's path starts with the rule's path; the longest rule that fits decides.
For the other urls the tree decides.  Urls are pre-aggregated to (host, segment
shapes) with their label counts, so the tree works on distinct shapes and no
host is ever one group of rows.  Level by level:

* numbers, hexadecimal ids and digit-laden slugs become wildcards by shape;
* a literal segment becomes ``*`` where its parent has more than
  ``MAX_CHILDREN`` children and it holds under ``MIN_SHARE`` of them;
* a literal branch becomes ``*`` where its distribution over the remaining
  shapes does not differ significantly from the parent's (chi-square) and its
  share of good labels does not either (z test).

A template is rejected if its share of good labels, smoothed by ``ALPHA``
pseudo-labels of the overall share, is below ``MIN_PURITY``.

Defined results: a null url or one without ``://`` has empty host and path, no
rule, and the root template's verdict for the empty host; unlabelled templates
take the overall share; every row gives one row, also rows that repeat and those
with a null id, and each row counts in the tree with its own url's labels; labels
with null quality count as none and several labels of one document count each.
Segments below ``DEPTH`` keep their shapes: a documented bound of the tree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored, table

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DEPTH = 4
MAX_CHILDREN = 20
MIN_SHARE = 0.01
ALPHA = 8.0
MIN_PURITY = 0.5
Z = 2.58


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host, path of every row."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(coalesce(url, ''), instr(coalesce(url, ''), '://') + 3)")).otherwise("")
    return pages.select("page_id", lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)).alias("host"),
                        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"))


def rule_of(rules=RULES):
    """(rule, its verdict) of the longest rule that fits, or nulls."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        host, _, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(kind)).otherwise(verdict)
    return found, verdict


def shapes(path):
    """The path's segments, variable ones as wildcards."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: (
        F.when(s.rlike(r"^[0-9]+$"), "{n}")
        .when(s.rlike(r"^[0-9]+\.[A-Za-z0-9]{1,5}$"), F.concat(F.lit("{n}."), F.regexp_extract(s, r"\.([A-Za-z0-9]+)$", 1)))
        .when(s.rlike(r"^[0-9A-Fa-f-]{12,}$"), "{x}")
        .when(F.length(F.regexp_replace(s, r"[^0-9]", "")) >= 4, "{s}")
        .otherwise(s)))


def _from(d: int):
    """The segments from ``d`` (0-based) on, to the path's end."""
    return F.slice("segs", d + 1, F.greatest(F.size("segs"), F.lit(1)))


def _generalise(a: DataFrame, d: int) -> DataFrame:
    """``a`` (host, segs, tmpl, n, m, g) with segment ``d`` (0-based) moved from
    ``segs`` to ``tmpl``, as a wildcard where it varies or its branch is like its siblings."""
    up = ["host", "tmpl"]
    a = a.withColumn("seg", F.coalesce(F.get("segs", F.lit(d)), F.lit("")))
    a = a.withColumn("below", F.array_join(_from(d + 1), "/"))
    parent = a.groupBy(*up).agg(F.sum("n").alias("pn"), F.sum("m").alias("pm"), F.sum("g").alias("pg"), F.count_distinct("seg").alias("kids"))
    pooled = a.groupBy(*up, "below").agg(F.sum("n").alias("rn"))
    child = a.groupBy(*up, "seg", "below").agg(F.sum("n").alias("o"), F.sum("m").alias("m"), F.sum("g").alias("g"))
    child = (child.join(pooled, [*up, "below"]).groupBy(*up, "seg")
             .agg(F.sum("o").alias("cn"), F.sum("m").alias("cm"), F.sum("g").alias("cg"),
                  F.sum(F.col("o") * F.col("o") / F.col("rn")).alias("o2"), F.count("*").alias("k"))
             .join(parent, up))
    chi2 = F.col("o2") * F.col("pn") / F.col("cn") - F.col("cn")
    like = chi2 <= F.col("k") + Z * F.sqrt(2.0 * F.col("k"))
    share = (F.col("pg") + 1.0) / (F.col("pm") + 2.0)
    same_labels = F.abs((F.col("cg") + share) / (F.col("cm") + 1.0) - share) <= Z * F.sqrt(share * (1.0 - share) / (F.col("cm") + 1.0))
    rare = (F.col("kids") > MAX_CHILDREN) & (F.col("cn") < MIN_SHARE * F.col("pn"))
    named = (F.col("seg") == "") | F.col("seg").startswith("{")
    wild = ~named & (rare | ((F.col("kids") > 1) & like & same_labels))
    child = child.select(*up, "seg", F.when(wild, "*").otherwise(F.col("seg")).alias("to"))
    return (a.join(child, [*up, "seg"])
            .withColumn("tmpl", F.when(F.col("seg") == "", F.col("tmpl")).otherwise(F.concat("tmpl", F.lit("/"), F.col("to"))))
            .drop("seg", "below", "to"))


def templates(urls: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(host, shape, template, purity) of every distinct shape of ``urls``
    (host, path, n, m, g: rows, labels and good labels).  Segments below ``depth`` keep
    their shapes."""
    a = (urls.withColumn("segs", shapes(F.col("path"))).groupBy("host", "segs")
         .agg(*(F.sum(c).alias(c) for c in ("n", "m", "g")))
         .withColumn("tmpl", F.lit("")))
    a = stored(a, "url-shapes")
    for d in range(depth):
        a = stored(_generalise(a, d), "url-tree")
    a = a.withColumn("tmpl", F.concat("tmpl", F.lit("/"), F.array_join(_from(depth), "/")))
    overall = a.agg(((F.coalesce(F.sum("g"), F.lit(0)) + 1.0) / (F.coalesce(F.sum("m"), F.lit(0)) + 1.0)).alias("prior"))
    purity = (a.groupBy("host", "tmpl").agg(F.sum("m").alias("tm"), F.sum("g").alias("tg"))
              .join(F.broadcast(overall))        # one row
              .select("host", "tmpl", ((F.col("tg") + ALPHA * F.col("prior")) / (F.col("tm") + ALPHA)).alias("purity")))
    return a.select("host", F.array_join("segs", "/").alias("shape"), "tmpl").join(purity, ["host", "tmpl"])


def judge(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """Per row of ``pages``: host, path, rule and verdict; with the template and
    its purity.  ``labels`` has a row per label, (url, good) or (page_id, good): every row of
    that url or page has them all.  Rows and labels are counted per url or page before
    they meet, so a page that is repeated a thousand times is one row of the tree's input."""
    found, verdict = rule_of(rules)
    by = "url" if "url" in labels.columns else "page_id"
    rows = pages.groupBy(*dict.fromkeys((by, "url"))).agg(F.count(F.lit(1)).alias("rows"))
    said = labels.where(F.col("good").isNotNull() & F.col(by).isNotNull()).groupBy(F.col(by).alias("__by")).agg(F.count(F.lit(1)).alias("lm"), F.sum(F.col("good").cast("long")).alias("lg"))
    known = rows.join(said, F.col(by) == F.col("__by"), "left").na.fill(0, ["lm", "lg"])
    known = known.withColumn("__id", F.struct((F.col("rows") * F.greatest(F.lit(1), F.col("lm"))).alias("n"), (F.col("rows") * F.col("lm")).alias("m"), (F.col("rows") * F.col("lg")).alias("g")))
    counted = parsed(known.select(F.col("__id").alias("page_id"), "url"))
    t = templates(counted.select("host", "path", "page_id.n", "page_id.m", "page_id.g"))
    p = parsed(pages).withColumn("rule", found).withColumn("by_rule", verdict).withColumn("shape", F.array_join(shapes(F.col("path")), "/"))
    return (p.join(t, ["host", "shape"], "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("by_rule", F.when(F.col("purity") < MIN_PURITY, "block").otherwise("allow")).alias("verdict"),
                    F.col("tmpl").alias("template"), F.round("purity", 9).alias("purity")))


def document_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, good): the labels of every url's document, whose number its path ends in."""
    number = F.regexp_extract(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^?#]*", 0), r"/([0-9]{1,18})(?:/|\.[a-z]+)?$", 1)
    p = pages.select("url").distinct().select("url", F.when(number != "", number.cast("long")).alias("doc_id"))
    return p.join(labels.where(F.col("quality").isNotNull()).select("doc_id", F.col("quality").alias("good")), "doc_id").select("url", "good")


def op7_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, document_labels(pages, table(spark, sf_dir, "labels"))).drop("purity")


def _oracle() -> str:
    """The same tree in DuckDB SQL, one block of tables per level."""
    ctes = [r"""
u AS (SELECT page_id, url, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
      regexp_extract(regexp_extract(coalesce(url, ''), '^[^?#]*', 0), '/([0-9]{1,18})(?:/|\.[a-z]+)?$', 1) AS number FROM u),
segs AS (SELECT page_id, host, path, list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s:
         CASE WHEN regexp_matches(s, '^[0-9]+$') THEN '{n}'
              WHEN regexp_matches(s, '^[0-9]+\.[A-Za-z0-9]{1,5}$') THEN '{n}.' || regexp_extract(s, '\.([A-Za-z0-9]+)$', 1)
              WHEN regexp_matches(s, '^[0-9A-Fa-f-]{12,}$') THEN '{x}'
              WHEN length(regexp_replace(s, '[^0-9]', '', 'g')) >= 4 THEN '{s}' ELSE s END) AS segs,
         CASE WHEN number <> '' THEN CAST(number AS BIGINT) END AS doc_id FROM p),
known AS (SELECT segs.host, segs.segs, labels.quality AS good FROM segs LEFT JOIN labels ON labels.doc_id = segs.doc_id AND labels.quality IS NOT NULL),
a0 AS (SELECT host, segs, '' AS tmpl, count(*) AS n, count(good) AS m, coalesce(sum(good), 0) AS g FROM known GROUP BY host, segs)"""]
    for d in range(4):
        ctes.append(f"""
x{d} AS (SELECT *, coalesce(segs[{d + 1}], '') AS seg, array_to_string(segs[{d + 2}:], '/') AS below FROM a{d}),
up{d} AS (SELECT host, tmpl, sum(n) AS pn, sum(m) AS pm, sum(g) AS pg, count(DISTINCT seg) AS kids FROM x{d} GROUP BY host, tmpl),
pool{d} AS (SELECT host, tmpl, below, sum(n) AS rn FROM x{d} GROUP BY host, tmpl, below),
each{d} AS (SELECT host, tmpl, seg, below, sum(n) AS o, sum(m) AS m, sum(g) AS g FROM x{d} GROUP BY host, tmpl, seg, below),
kid{d} AS (SELECT host, tmpl, seg, sum(o) AS cn, sum(m) AS cm, sum(g) AS cg, sum(CAST(o AS DOUBLE) * o / rn) AS o2, count(*) AS k
           FROM each{d} JOIN pool{d} USING (host, tmpl, below) GROUP BY host, tmpl, seg),
test{d} AS (SELECT host, tmpl, seg, cn, cm, cg, k, kids, pn, o2 * pn / cn - cn AS chi2, (pg + 1.0::DOUBLE) / (pm + 2.0::DOUBLE) AS share
            FROM kid{d} JOIN up{d} USING (host, tmpl)),
to{d} AS (SELECT host, tmpl, seg, CASE WHEN seg <> '' AND NOT starts_with(seg, '{{') AND ((kids > 20 AND cn < 0.01::DOUBLE * pn)
            OR (kids > 1 AND chi2 <= k + 2.58::DOUBLE * sqrt(2.0::DOUBLE * k)
                AND abs((cg + share) / (cm + 1.0::DOUBLE) - share) <= 2.58::DOUBLE * sqrt(share * (1.0::DOUBLE - share) / (cm + 1.0::DOUBLE)))) THEN '*' ELSE seg END AS into_
          FROM test{d}),
a{d + 1} AS (SELECT host, segs, CASE WHEN seg = '' THEN tmpl ELSE tmpl || '/' || into_ END AS tmpl, n, m, g FROM x{d} JOIN to{d} USING (host, tmpl, seg))""")
    ctes.append("""
t AS (SELECT host, segs, tmpl || '/' || array_to_string(segs[5:], '/') AS tmpl, m, g FROM a4),
prior AS (SELECT (coalesce(sum(good), 0) + 1.0::DOUBLE) / (count(good) + 1.0::DOUBLE) AS prior FROM known),
pure AS (SELECT host, tmpl, (sum(g) + 8.0::DOUBLE * any_value(prior)) / (sum(m) + 8.0::DOUBLE) AS purity FROM t, prior GROUP BY host, tmpl)""")
    return "WITH" + ",".join(ctes) + """
SELECT page_id, segs.host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN purity < 0.5 THEN 'block' ELSE 'allow' END AS verdict, t.tmpl AS template
FROM (SELECT *, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                     WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                     WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                     WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM segs) segs
LEFT JOIN t ON t.host = segs.host AND t.segs = segs.segs LEFT JOIN pure ON pure.host = t.host AND pure.tmpl = t.tmpl
"""


ORACLE = _oracle()
