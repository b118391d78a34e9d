"""URL filters: rules on hosts and paths, and trust and distrust over the link graph for the rest.

Hosts are seeded by the share of their pages that rules allow or block. Trust
spreads along links and distrust against them, each as a personalised PageRank
whose seeds keep 1 - DAMPING of the mass. Beside each runs one that starts from
all hosts alike; what a host gets of the one over what it gets of the other is a
share from 0 to 1, however many hosts link to a seed and whatever mass is lost
where links end. A host's own start counts in it only where rules judge the host.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, small_join

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
ITERATIONS = 10
#: A host is blocked where its share of distrust exceeds its share of trust by more: one with two links that are alike,
#: one of them to a blocked host, has 0.5; one that only links to unjudged hosts has less, the further away blocked ones are.
MARGIN = 0.4
#: (action, host, path): the rules of the registered query.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def split_url(pages: DataFrame) -> DataFrame:
    """(page_id, host, path); both empty for a null url or one without ``://``."""
    part = lambda k: F.coalesce(F.regexp_extract("url", URL, k), F.lit(""))
    return pages.select("page_id", F.translate(part(1), _UPPER, _LOWER).alias("host"), part(2).alias("path"))


def _rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): every rule whose host is the host or a parent domain, as an array."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = hosts.select("host", F.explode(suffixes).alias("rule_host"))
    hits = small_join(each, rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action"), ["rule_host"])
    rule = F.struct((-F.length(F.concat("rule_host", "rule_path"))).alias("order"), F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_path").alias("path"), "action")
    return hits.groupBy("host").agg(F.sort_array(F.collect_set(rule)).alias("rules"))


def links(pages: DataFrame) -> DataFrame:
    """(src, dst, w): pages of host src with a link to another host dst."""
    found = F.explode(F.array_distinct(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1))))
    host = F.translate(F.regexp_replace("to", r"^[^@]*@", ""), _UPPER, _LOWER)
    edges = pages.select("src", found.alias("to")).select("src", host.alias("dst")).where("src <> dst and src <> '' and dst <> ''")
    return edges.groupBy("src", "dst").agg(F.count("*").alias("w"))


def propagate(seeds: DataFrame, edges: DataFrame, scratch: Scratch, iterations: int = ITERATIONS) -> DataFrame:
    """(host, score) from (host, seed, judged) along (src, dst, w): a host's part of the mass from seeds in the mass from all hosts.

    Both masses: (1 - d) times the start, and d times what links bring. Of the
    latter's own start only ``judged`` (0 or 1) of it counts. Hosts that only links
    name start with nothing of the seeds. A host that nothing reaches has 0.
    """
    out = edges.groupBy("src").agg(F.sum("w").alias("all_w"))
    edges = scratch.store(edges.join(out, "src").select("src", "dst", (F.col("w") / F.col("all_w")).alias("share")), "shares")
    named = edges.select(F.col("src").alias("host")).union(edges.select("dst")).distinct()
    start = seeds.join(named, "host", "full_outer").select("host", *[(F.coalesce(c, F.lit(0.0)) * (1 - DAMPING)).alias(c) for c in ("seed", "judged")])
    start = scratch.store(start, "start")
    rank = start.select("host", F.col("seed").alias("x"), F.lit(1 - DAMPING).alias("y"), F.lit(0.0).alias("got"))
    for k in range(iterations):
        came = rank.join(edges, rank["host"] == edges["src"]).groupBy("dst").agg(*[F.sum(F.col(c) * F.col("share")).alias("in_" + c) for c in ("x", "y")])
        new = start.join(came.withColumnRenamed("dst", "host"), "host", "left")
        x, y = (DAMPING * F.coalesce("in_" + c, F.lit(0.0)) for c in ("x", "y"))
        new = scratch.store(new.select("host", (F.col("seed") + x).alias("x"), (F.lit(1 - DAMPING) + y).alias("y"), y.alias("got")), "rank")
        if k:
            scratch.drop(rank)
        rank = new
    return rank.join(start, "host").select("host", F.coalesce(F.try_divide("x", F.col("got") + F.col("judged")), F.lit(0.0)).alias("score"))


def judge(pages: DataFrame, rules: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), one row for every row of ``pages`` (page_id, url, html).

    ``rules``: (action, host, path). The longest rule that fits decides; ``rule`` is
    its host and path. Without one, ``rule`` is null and the host's shares decide:
    block where that of distrust exceeds that of trust by more than MARGIN, else allow. Null urls
    and html, no links and no pages are fine; other columns are ignored.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    pages = pages.select("page_id", "url", "html")
    own = split_url(pages)
    hosts = own.select("host").distinct()
    ruled = scratch.store(_rules_of_hosts(hosts, rules), "rules")
    fits = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    own = small_join(own, ruled, ["host"], "left").withColumn("hit", F.try_element_at(fits, F.lit(1)))
    own = scratch.store(own.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.action").alias("action")), "pages")

    share = lambda a: F.avg(F.when(F.col("action") == a, 1.0).otherwise(0.0))
    judged = F.max(F.when(F.col("action").isNotNull(), 1.0).otherwise(0.0))
    seeds = scratch.store(own.groupBy("host").agg(share("allow").alias("allow"), share("block").alias("block"), judged.alias("judged")), "seeds")
    src = F.translate(F.coalesce(F.regexp_extract("url", URL, 1), F.lit("")), _UPPER, _LOWER)
    edges = scratch.store(links(pages.select(src.alias("src"), "html")), "links")
    if edges.isEmpty():
        iterations = 0
    trust = propagate(seeds.select("host", F.col("allow").alias("seed"), "judged"), edges, scratch, iterations)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    distrust = propagate(seeds.select("host", F.col("block").alias("seed"), "judged"), back, scratch, iterations)
    scores = seeds.select("host").join(trust.withColumnRenamed("score", "trust"), "host", "left").join(distrust.withColumnRenamed("score", "distrust"), "host", "left")
    scores = scratch.store(scores.fillna(0.0, ["trust", "distrust"]), "scores")
    scratch.keep(own, scores)
    method = F.when(F.round(F.col("distrust") - F.col("trust"), 9) > MARGIN, "block").otherwise("allow")
    out = small_join(own, scores, ["host"], "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("action", method).alias("verdict"), "trust", "distrust")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "action string, host string, path string")


def _oracle(iterations: int = ITERATIONS) -> str:
    """The same in SQL, one subquery an iteration."""
    rules = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in RULES)
    link = LINK.replace("'", "''")
    sql = f"""
WITH u AS (SELECT page_id, html, translate(coalesce(regexp_extract(url, '{URL}', 1), ''), '{_UPPER}', '{_LOWER}') AS host, coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages),
rl(action, rhost, rpath) AS (VALUES {rules}),
m AS (SELECT u.page_id, u.host, u.path, rl.action, rl.rhost || rl.rpath AS rule, row_number() OVER (PARTITION BY u.page_id ORDER BY length(rl.rhost || rl.rpath) DESC NULLS LAST) AS k
  FROM u LEFT JOIN rl ON (u.host = rl.rhost OR ends_with(u.host, '.' || rl.rhost)) AND starts_with(u.path, rl.rpath)),
o AS (SELECT page_id, host, path, action, rule FROM m WHERE k = 1),
s AS (SELECT host, avg(CASE WHEN action = 'allow' THEN 1.0 ELSE 0.0 END)::DOUBLE AS a, avg(CASE WHEN action = 'block' THEN 1.0 ELSE 0.0 END)::DOUBLE AS b, max(CASE WHEN action IS NULL THEN 0.0 ELSE 1.0 END)::DOUBLE AS j FROM o GROUP BY host),
l AS (SELECT DISTINCT page_id, host AS src, translate(regexp_replace(t, '^[^@]*@', ''), '{_UPPER}', '{_LOWER}') AS dst FROM (SELECT page_id, host, unnest(regexp_extract_all(html, '{link}', 1)) AS t FROM u)),
e AS (SELECT src, dst, count(*) AS w FROM l WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY src, dst),
f AS (SELECT src, dst, w::DOUBLE / sum(w) OVER (PARTITION BY src) AS share FROM e),
g AS (SELECT dst AS src, src AS dst, w::DOUBLE / sum(w) OVER (PARTITION BY dst) AS share FROM e),
h AS (SELECT host FROM s UNION SELECT dst FROM e UNION SELECT src FROM e),
t0 AS (SELECT h.host, coalesce(a, 0) * {1 - DAMPING} AS own, coalesce(j, 0) * {1 - DAMPING} AS judged, coalesce(a, 0) * {1 - DAMPING} AS x, {1 - DAMPING}::DOUBLE AS y, 0.0::DOUBLE AS got FROM h LEFT JOIN s ON h.host = s.host),
d0 AS (SELECT h.host, coalesce(b, 0) * {1 - DAMPING} AS own, coalesce(j, 0) * {1 - DAMPING} AS judged, coalesce(b, 0) * {1 - DAMPING} AS x, {1 - DAMPING}::DOUBLE AS y, 0.0::DOUBLE AS got FROM h LEFT JOIN s ON h.host = s.host)"""
    for i in range(iterations):
        for t, e in (("t", "f"), ("d", "g")):
            sql += f""",
{t}{i + 1} AS (SELECT p.host, p.own, p.judged, p.own + {DAMPING} * coalesce(c.x, 0) AS x, {1 - DAMPING} + {DAMPING} * coalesce(c.y, 0) AS y, {DAMPING} * coalesce(c.y, 0) AS got FROM {t}{i} p LEFT JOIN (SELECT {e}.dst, sum(q.x * {e}.share) AS x, sum(q.y * {e}.share) AS y FROM {t}{i} q JOIN {e} ON q.host = {e}.src GROUP BY {e}.dst) c ON p.host = c.dst)"""
    return sql + f"""
SELECT o.page_id, o.host, o.path, o.rule, coalesce(o.action, CASE WHEN round(coalesce(d.x / nullif(d.got + d.judged, 0), 0) - coalesce(t.x / nullif(t.got + t.judged, 0), 0), 9) > {MARGIN} THEN 'block' ELSE 'allow' END) AS verdict
FROM o LEFT JOIN t{iterations} t ON o.host = t.host LEFT JOIN d{iterations} d ON o.host = d.host"""


ORACLE = _oracle()
