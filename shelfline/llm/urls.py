"""URL filters: rules first, then trust and distrust carried along links between hosts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import written

# Host, path and verdict of the rules of the query.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
# What a host hands on of what it got, and how often.
DAMPING = 0.85
ROUNDS = 20
# Rounds between two written states.
STRIDE = 5
# Mass of one page under a rule; masses are whole numbers, so that sums do not depend on their order.
UNIT = 1_000_000
# Share of a host's pages that its distrust, less its trust, must outweigh.
THRESHOLD = 0.5
HOST = r"://([^/?#]*)([^?#]*)"
SPACE = r"[\x20\x09-\x0D]"
# Addresses in anchors that name a host.
LINK = rf"(?i)<a(?:rea)?{SPACE}[^<>]*?href{SPACE}*={SPACE}*[\"']?{SPACE}*((?:https?:)?//[^\"'\x20\x09-\x0D<>]*)"


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What stands behind the first ``://``, up to a slash, question mark or hash; else empty."""
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 2)


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """The rows with ``host``, ``path`` and the longest fitting rule: ``rule`` and ``ruled``.

    A rule fits its host and the hosts below it where the path starts with the rule's. Rules
    are a list in the plan, some hundred at most; of rules of one length the longer host wins.
    """
    named = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    best = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r)):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        best = F.when(fits, F.lit(host + path)).otherwise(best[0]), F.when(fits, F.lit(verdict)).otherwise(best[1])
    return named.withColumns({"rule": best[0], "ruled": best[1]})


def host_links(pages: DataFrame) -> DataFrame:
    """Links between different hosts and their number: ``src, dst, n``."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("to"))
    # An address without a scheme has that of its page.
    to = F.when(F.startswith("to", F.lit("//")), F.concat(F.lit("http:"), "to")).otherwise(F.col("to"))
    named = links.select("src", host_of(to).alias("dst")).where("src <> '' AND dst <> '' AND src <> dst")
    return named.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagated(
    links: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, stride: int = STRIDE
) -> DataFrame:
    """Trust and distrust of hosts: ``host, trust, distrust``, as whole masses.

    ``seeds`` has ``host, trust, distrust``. Trust follows links, shared out by their numbers,
    as in personalised PageRank; distrust goes against them, from the linked to the linking
    host. Both are summed over ``rounds`` steps. Each step is a join with the links and a sum
    by host; every ``stride`` steps the state is written to the shared folder.
    """
    out = links.groupBy(F.col("src").alias("host")).agg(F.sum("n").alias("all"))
    into = links.groupBy(F.col("dst").alias("host")).agg(F.sum("n").alias("all"))
    ahead = links.join(out, F.col("src") == F.col("host")).select("host", F.col("dst").alias("to"), "n", "all", F.lit(1).alias("kind"))
    back = links.join(into, F.col("dst") == F.col("host")).select("host", F.col("src").alias("to"), "n", "all", F.lit(-1).alias("kind"))
    # Every host also hands its sums on to itself, so that a step reads the state once.
    hosts = ahead.select("host").union(back.select("host")).distinct()
    stay = hosts.select("host", F.col("host").alias("to"), F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("all"), F.lit(0).alias("kind"))
    ways = written(ahead.unionByName(back).unionByName(stay).withColumnRenamed("host", "at"), "host-ways")
    moved = seeds.join(hosts, "host", "left_semi")
    state = moved.select("host", F.lit(0).cast("long").alias("trust"), F.lit(0).cast("long").alias("distrust"), F.col("trust").alias("t"), F.col("distrust").alias("d"))

    def part(mass: str) -> Column:
        return F.floor(F.col(mass).cast("double") * F.lit(damping) * F.col("n") / F.col("all")).cast("long")

    none = F.lit(0).cast("long")
    for step in range(rounds):
        met = state.join(ways, F.col("host") == F.col("at"))
        stays = F.col("kind") == 0
        met = met.select(
            F.col("to").alias("host"),
            F.when(stays, F.col("trust") + F.col("t")).otherwise(none).alias("trust"),
            F.when(stays, F.col("distrust") + F.col("d")).otherwise(none).alias("distrust"),
            F.when(F.col("kind") == 1, part("t")).otherwise(none).alias("t"),
            F.when(F.col("kind") == -1, part("d")).otherwise(none).alias("d"),
        )
        state = met.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("trust", "distrust", "t", "d")])
        if (step + 1) % stride == 0 or step + 1 == rounds:
            state = written(state, "host-state")
            if state.where("t > 0 OR d > 0").isEmpty():
                break
    linked = state.select("host", (F.col("trust") + F.col("t")).alias("trust"), (F.col("distrust") + F.col("d")).alias("distrust"))
    # Hosts without links keep what they have.
    return linked.unionByName(seeds.join(hosts, "host", "left_anti"))


def url_verdicts(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, damping: float = DAMPING, rounds: int = ROUNDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """A verdict for every address: ``page_id, host, path, rule, verdict``.

    The longest fitting rule decides. Where none fits, the host does: its pages that a rule
    allows are its seed of trust, those that a rule blocks its seed of distrust; both are
    carried along the links between hosts (``propagated``), and a host is blocked when its
    distrust, less its trust, weighs more than ``threshold`` of its pages.

    A null address, or one without ``://``, has an empty host and path, which no rule fits
    and no link reaches: allowed. Null pages hold no links; repeated rows each have a row and
    count as pages; other columns are ignored; an empty table gives no rows.
    """
    ruled = judged(pages.select("page_id", "url"), rules)
    mass = lambda verdict: (F.count_if(F.col("ruled") == verdict) * UNIT).cast("long")
    hosts = ruled.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("n_pages"), mass("allow").alias("trust"), mass("block").alias("distrust")
    )
    hosts = written(hosts, "hosts")
    links = written(host_links(pages.select("url", "html")), "host-links")
    masses = propagated(links, hosts.where("trust > 0 OR distrust > 0").select("host", "trust", "distrust"), damping, rounds)
    weighed = hosts.select("host", "n_pages").join(masses, "host")
    blocked = weighed.where(F.col("distrust") - F.col("trust") > F.col("n_pages") * F.lit(float(UNIT * threshold)))
    blocked = written(blocked.select(F.col("host").alias("bad")), "blocked-hosts")
    met = ruled.join(blocked, F.col("host") == F.col("bad"), "left")
    return met.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("bad").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )
