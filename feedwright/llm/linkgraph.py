"""URL filters: rules first, then propagation over the link graph of hosts.

A rule names a host and a path start; it fits its host and all subdomains, and
the longest fitting rule decides. Hosts form a graph: links found in the pages'
HTML (absolute, or with the scheme left out) lead from the page's host to the
link's host, and a subdomain and its parent domain (down to two labels) link to
each other. Trust flows along links by personalised PageRank from the hosts of
pages that rules allow; distrust flows against them from the hosts of pages that
rules block. Both start from the same total of pages, so they compare; a host
whose distrust holds more than ``BLOCK_ABOVE`` of both is blocked, any other is
allowed.

Both move until they settle: no host is newly reached and no host's trust or
distrust changes by more than ``TOLERANCE`` of itself over ``STEPS`` steps, so a
chain of links counts whatever its length.

Everything is DataFrame work. Edges are counted per pair of hosts before they
are joined, and every ``STEPS`` steps are a stored table. Null urls and urls without
``://`` have an empty host and path, fit no rule and are allowed; null HTML has no
links. Repeated pages are judged row by row and link as often as they occur.
Pages of any length are read whole, an empty table gives no rows, and columns
other than ``page_id``, ``url`` and ``html`` are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import stored

DAMPING = 0.85
#: Steps that propagation takes where no tolerance is given.
ITERATIONS = 10
#: Largest change of a score, as a share of itself, over the steps of one stored table that counts as settled.
TOLERANCE = 1e-6
STEPS = 5
#: Share of distrust in a host's trust and distrust beyond which it is blocked.
BLOCK_ABOVE = 0.6
#: Rules are compiled into one expression; longer lists are refused.
MAX_RULES = 1_000
LINK = r"(?i)\b(?:href|src)\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The production rules.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def parsed(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule and the rule's verdict."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("rule_verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst and weight over all links between different hosts."""
    rows = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host, _ = host_and_path(F.col("url"))
    links = rows.select(host.alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("dst"))
    links = links.select("src", ascii_lower(F.col("dst")).alias("dst")).where("src <> '' and src <> dst")
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    hosts = rows.select(host.alias("host")).union(links.select("dst")).where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    parents = hosts.where(F.size(labels) > 2).select(
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size(labels) - 2),
                lambda i: F.struct(
                    F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("src"),
                    F.array_join(F.slice(labels, i + 1, F.size(labels)), ".").alias("dst"),
                ),
            )
        ).alias("e")
    )
    up = parents.select("e.src", "e.dst").distinct().withColumn("weight", F.lit(1.0))
    down = up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    every = links.unionByName(up).unionByName(down)
    return every.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(
    edges: DataFrame,
    seeds: DataFrame,
    iterations: int = ITERATIONS,
    damping: float = DAMPING,
    tolerance: float | None = None,
) -> DataFrame:
    """host, trust and distrust after so many steps; with a tolerance, after as many as they need to settle.

    ``seeds`` holds host, kind (trust, distrust) and a positive weight. Both
    kinds move in one join per step, distrust over the reversed edges.
    """
    arcs = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    out = arcs.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    arcs = stored(
        arcs.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("share")),
        "arcs",
    )
    total = seeds.agg(F.coalesce(F.sum("weight"), F.lit(1.0)).alias("total")).first()["total"]
    start = stored(seeds.select("kind", "host", (F.col("weight") / F.lit(total)).alias("score")), "seeds")
    arcs = arcs.withColumnRenamed("src", "host")
    again = start.select("kind", "host", (F.lit(1 - damping) * F.col("score")).alias("score"))
    stay, score, done = F.lit(0.0).alias("before"), start, 0
    while tolerance is not None or done < iterations:
        steps = STEPS if tolerance is not None else min(STEPS, iterations - done)
        before = score.select("kind", "host", F.lit(0.0).alias("score"), F.col("score").alias("before"))
        for i in range(steps):
            moved = score.where("score > 0").join(arcs, ["kind", "host"]).select(
                "kind", F.col("dst").alias("host"), (F.lit(damping) * F.col("score") * F.col("share")).alias("score")
            )
            moved = moved.unionByName(again).select("kind", "host", "score", stay)
            if i == steps - 1:
                moved = moved.unionByName(before)
            score = moved.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("before").alias("before"))
        score = stored(score, "score")
        done += steps
        if tolerance is not None:
            change = F.abs(F.col("score") - F.col("before"))
            if not score.where(change > F.lit(tolerance) * F.col("score")).limit(1).count():
                break
    return score.groupBy("host").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    )


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust."""
    rows = parsed(pages, rules)
    kind = F.when(F.col("rule_verdict") == "allow", "trust").when(F.col("rule_verdict") == "block", "distrust")
    seeds = rows.where("rule is not null").groupBy("host", kind.alias("kind"))
    seeds = stored(seeds.agg(F.count(F.lit(1)).cast("double").alias("weight")), "host-seeds")
    hosts = stored(propagate(stored(host_edges(pages), "host-edges"), seeds, tolerance=TOLERANCE), "hosts")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    own = F.when(distrust > F.lit(BLOCK_ABOVE) * (trust + distrust), "block").otherwise("allow")
    return rows.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
