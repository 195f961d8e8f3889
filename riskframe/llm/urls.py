"""URL verdicts: rules first, else trust and distrust propagated over links between hosts.

Hosts that pages link to form a graph (links of equal ends folded into one weighted edge before any
join). Pages that a rule allows make their host a trusted seed, pages that a rule blocks a
distrusted one, in proportion to their number. Trust is a personalised PageRank along the edges,
distrust one against them: who links to the distrusted is distrusted. Both are held in pages. A host
is blocked if distrust is at least ``threshold`` of distrust, trust and ``neutral`` times its pages.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialise

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ADDRESS = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
#: Links of one host that one piece holds.
HUB_LINKS = 200_000
#: Rounds whose written tables are summed at once.
ROUNDS_HELD = 20
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)"""


def lowered(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return F.coalesce(lowered(F.regexp_extract(url, ADDRESS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def _summed(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))


@dataclass(frozen=True)
class Filter:
    """Rules are (verdict, host and path); a rule fits its host and all hosts below it."""

    rules: tuple
    damping: float = 0.85
    neutral: float = 0.5
    threshold: float = 0.5
    precision: float = 1e-6

    def rule_for(self, host: Column, path: Column) -> Column:
        """struct(rule, verdict) of the longest rule that fits, else NULL."""
        found = F.lit(None).cast("struct<rule:string,verdict:string>")
        for verdict, rule in sorted(self.rules, key=lambda r: len(r[1])):
            name, _, rest = rule.partition("/")
            fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
            found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
        return found

    def links(self, pages: DataFrame) -> DataFrame:
        """(src, dst, n): links between different hosts, from ``host`` and ``html``."""
        targets = F.array_distinct(F.transform(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1)), lowered))
        return (
            pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
            .where("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("n"))
        )

    def enough(self, mass: float) -> float:
        """What is on its way (in pages) when propagation may end.

        A round passes on at most ``damping`` of it, and scaling multiplies by at most
        1 / (1 - ``damping``), so all later rounds together move the share that a verdict compares
        by less than ``precision`` (or by rounding errors).
        """
        return max(self.precision * self.neutral, 1e-13 * mass) * (1 - self.damping) ** 2 / self.damping

    def propagate(self, seeds: DataFrame, links: DataFrame) -> DataFrame:
        """(host, trust, distrust) in pages, from seeds (host, allowed, blocked) and folded links.

        Each round passes on only what arrived in the round before; ranks are the sums over rounds,
        which go on until too little is on its way, however long the chains are. What a host without
        links would pass on goes back to the seeds: that scales all ranks alike, to the pages of the
        seeds. Each round is written, so lineage stays short. The links of a hub are cut into pieces
        of about ``HUB_LINKS``, each met by a copy of its one row.
        """
        both = links.select(F.col("src").alias("at"), F.col("dst").alias("to"), F.col("n").alias("nt"), F.lit(0.0).alias("nd")).unionByName(
            links.select(F.col("dst").alias("at"), F.col("src").alias("to"), F.lit(0.0).alias("nt"), F.col("n").alias("nd"))
        )
        totals = materialise(
            both.groupBy("at").agg(
                F.sum("nt").alias("all_t"), F.sum("nd").alias("all_d"),
                (1 + F.floor(F.count(F.lit(1)) / HUB_LINKS)).cast("int").alias("pieces"),
            ),
            "host-totals",
        )
        share = lambda n, total: F.when(F.col(total) > 0, F.col(n) / F.col(total)).otherwise(F.lit(0.0))
        steps = materialise(
            both.join(totals, "at").select(
                "at", "to", F.pmod(F.xxhash64("to"), F.col("pieces")).cast("int").alias("piece"),
                share("nt", "all_t").alias("t"), share("nd", "all_d").alias("d"),
            ),
            "host-steps",
        )
        a = self.damping
        pieces = totals.select(F.col("at").alias("host"), "pieces")
        begin = seeds.select("host", ((1 - a) * F.col("allowed")).alias("t"), ((1 - a) * F.col("blocked")).alias("d"))
        sums = [F.sum(c) for c in ("t", "d")]
        moving = materialise(begin, "moving")
        mass_t, mass_d = (float(x or 0) / (1 - a) for x in moving.agg(*sums).first())
        ranks, held = None, [moving]
        while sum(float(x or 0) for x in moving.agg(*sums).first()) > self.enough(mass_t + mass_d):
            sent = moving.join(pieces, "host").select(
                F.col("host").alias("at"), F.col("t").alias("mt"), F.col("d").alias("md"),
                F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"),
            )
            passed = sent.join(steps, ["at", "piece"]).groupBy(F.col("to").alias("host")).agg(
                (a * F.sum(F.col("mt") * F.col("t"))).alias("t"), (a * F.sum(F.col("md") * F.col("d"))).alias("d")
            )
            moving = materialise(passed.where("t > 0 or d > 0"), "moving")
            held.append(moving)
            if len(held) == ROUNDS_HELD:
                ranks = materialise(_summed(held + ([ranks] if ranks else [])), "ranks")
                held = []
        ranks = materialise(_summed(held + ([ranks] if ranks else [])), "ranks")
        got_t, got_d = (float(x or 0) for x in ranks.agg(*sums).first())
        scale = lambda c, mass, got: (F.col(c) * (mass / got if got else 0.0))
        return ranks.select("host", scale("t", mass_t, got_t).alias("trust"), scale("d", mass_d, got_d).alias("distrust"))

    def judge(self, pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
        """Per page: key, host, path, rule (NULL if none fits), verdict, trust, distrust.

        Defined results: a missing url, or one without ``://``, has an empty host and path, fits no
        rule and is allowed; a missing html links to nothing; repeated pages count each time.
        """
        host, path = host_of(F.col(url)), path_of(F.col(url))
        read = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"), F.col(html).alias("html"))
        links = materialise(self.links(read), "links")
        ruled = read.drop("html").withColumn("r", self.rule_for(F.col("host"), F.col("path")))
        is_ = lambda v: F.coalesce(F.sum((F.col("r.verdict") == v).cast("double")), F.lit(0.0))
        counted = materialise(
            ruled.where("host <> ''").groupBy("host").agg(F.count(F.lit(1)).cast("double").alias("pages"), is_("allow").alias("allowed"), is_("block").alias("blocked")),
            "page-counts",
        )
        ranks = self.propagate(counted.select("host", "allowed", "blocked").where("allowed + blocked > 0"), links)
        share = F.col("distrust") / (F.col("distrust") + F.col("trust") + self.neutral * F.col("pages"))
        scored = counted.select("host", "pages").join(ranks, "host", "left").na.fill(0.0, ["trust", "distrust"])
        hosts = scored.select("host", "trust", "distrust", (F.round(share, 9) >= self.threshold).alias("bad"))
        judged = ruled.join(hosts, "host", "left")
        other = F.when(F.col("bad"), "block").otherwise("allow")
        return judged.select(
            F.col("key").alias(key), "host", "path", F.col("r.rule").alias("rule"),
            F.coalesce(F.col("r.verdict"), other).alias("verdict"),
            F.round(F.coalesce("trust", F.lit(0.0)), 6).alias("trust"), F.round(F.coalesce("distrust", F.lit(0.0)), 6).alias("distrust"),
        )


def equivalent_sql(f: Filter) -> str:
    """The same verdicts over ``pages`` in SQL; the rounds are a recursive table."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    address = quoted(r"(?s)^.*?://([^/?#]*)([^?#]*)")
    lower = lambda c: f"translate({c}, '{UPPER}', '{LOWER}')"
    tests = []
    for verdict, rule in sorted(f.rules, key=lambda r: -len(r[1])):
        name, _, rest = rule.partition("/")
        fits = f"(host = {quoted(name)} OR ends_with(host, {quoted('.' + name)})) AND starts_with(path, {quoted('/' + rest)})"
        tests.append((fits, quoted(rule), quoted(verdict)))
    case = lambda i: "CASE " + " ".join(f"WHEN {t[0]} THEN {t[i]}" for t in tests) + " END"
    a = f.damping
    enough = (
        f"greatest({f.precision * f.neutral}::DOUBLE, 1e-13::DOUBLE * (SELECT sum(a + b) FROM seeds)) * {(1 - a) ** 2 / a}::DOUBLE"
    )
    return f"""WITH RECURSIVE raw AS (
  SELECT page_id, html, coalesce({lower(f"regexp_extract(url, {address}, 1)")}, '') AS host,
         coalesce(regexp_extract(url, {address}, 2), '') AS path
  FROM pages),
ruled AS MATERIALIZED (SELECT page_id, html, host, path, {case(1)} AS rule, {case(2)} AS v FROM raw),
counted AS MATERIALIZED (
  SELECT host, count(*)::DOUBLE AS pages, (count(*) FILTER (v = 'allow'))::DOUBLE AS a,
         (count(*) FILTER (v = 'block'))::DOUBLE AS b
  FROM ruled WHERE host <> '' GROUP BY host),
found AS (
  SELECT host AS src,
         unnest(list_distinct(list_transform(regexp_extract_all(html, {quoted(LINK)}, 1), lambda x: {lower("x")}))) AS dst
  FROM ruled WHERE host <> ''),
links AS MATERIALIZED (SELECT src, dst, count(*)::DOUBLE AS n FROM found WHERE src <> dst GROUP BY 1, 2),
steps AS MATERIALIZED (
  SELECT src AS start, dst AS goal, n / sum(n) OVER (PARTITION BY src) AS t, 0::DOUBLE AS d FROM links
  UNION ALL SELECT dst, src, 0::DOUBLE, n / sum(n) OVER (PARTITION BY dst) FROM links),
seeds AS MATERIALIZED (SELECT host, a, b FROM counted WHERE a + b > 0),
moving AS (
  SELECT 0 AS i, host, {1 - a}::DOUBLE * a AS t, {1 - a}::DOUBLE * b AS d, {1 - a}::DOUBLE * sum(a + b) OVER () AS mass FROM seeds
  UNION ALL
  SELECT i + 1, goal, t, d, sum(t + d) OVER () FROM (
    SELECT i, goal, {a}::DOUBLE * sum(m.t * s.t) AS t, {a}::DOUBLE * sum(m.d * s.d) AS d
    FROM moving m JOIN steps s ON m.host = s.start WHERE mass > {enough} GROUP BY i, goal)
  WHERE t > 0 OR d > 0),
summed AS (SELECT host, sum(t) AS t, sum(d) AS d FROM moving GROUP BY host),
last AS (
  SELECT host, t * (SELECT sum(a) FROM seeds) / nullif((SELECT sum(t) FROM summed), 0) AS t,
         d * (SELECT sum(b) FROM seeds) / nullif((SELECT sum(d) FROM summed), 0) AS d
  FROM summed),
hosts AS (
  SELECT c.host, coalesce(t, 0) AS t, coalesce(d, 0) AS d,
         round(coalesce(d, 0) / (coalesce(d, 0) + coalesce(t, 0) + {f.neutral}::DOUBLE * pages), 9) >= {f.threshold} AS bad
  FROM counted c LEFT JOIN last r ON c.host = r.host)
SELECT page_id, p.host, path, rule, coalesce(v, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict,
       round(coalesce(t, 0), 6) AS trust, round(coalesce(d, 0), 6) AS distrust
FROM ruled p LEFT JOIN hosts h ON p.host = h.host"""
