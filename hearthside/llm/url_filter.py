"""URL verdicts: explicit rules first, then trust and distrust propagated over the graph of hosts.

Two personalised PageRanks run side by side on distinct host edges. Trust starts from hosts with allowed pages and
follows links. Distrust starts from hosts whose pages are mostly blocked and follows links backwards: who links to bad
hosts is suspect. A host without a rule is blocked when its distrust exceeds its trust by a threshold.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthside.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?i)<(?:a|area|link|frame|iframe)\b[^>]*?\s(?:href|src)\s*=\s*[\"']?(?:https?:)?//([^/?#\"'\s>]+)"
TRUST, DISTRUST = "allow", "block"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, ADDRESS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, _, rest = rule.partition("/")
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")


def rule_for(rules: dict[str, str], host: Column, path: Column) -> Column:
    """The longest fitting rule, or null. ``rules``: a short list held by the caller, verdict by rule."""
    ordered = sorted(rules, key=lambda r: (-len(r), r))
    return reduce(lambda w, r: w.when(_fits(r, host, path), F.lit(r)), ordered, F.when(F.lit(False), F.lit(None).cast("string")))


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct (source, target) of links between different hosts, and both ways between a host and its parent domains.

    ``pages``: host, html. Links without a host lead to the own one and make no edge. A domain of two labels or more is a
    node whether or not it has pages, so hosts of one domain are neighbours by way of it. Edges are made distinct in each
    task before the shuffle.
    """
    targets = F.array_distinct(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1)))
    linked = pages.where(F.col("html").contains("//")).select(F.col("host").alias("source"), F.explode(targets).alias("target"))
    linked = linked.select("source", F.translate("target", UPPER, LOWER).alias("target")).distinct()
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(2), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    hosts = pages.select("host").union(linked.select("target")).distinct().where(F.size(labels) > 2)
    parents = hosts.select(F.col("host").alias("source"), F.explode(above).alias("target"))
    both = linked.union(parents).union(parents.select(F.col("target").alias("source"), F.col("source").alias("target")))
    return both.where("source != target and source != '' and target != ''").distinct()


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int = 20, keep_every: int = 5) -> DataFrame:
    """host, trust, distrust after ``rounds`` steps. ``seeds``: host, trust, distrust at the start.

    Each step sums what arrives per host with partial sums before the shuffle; a hub's edges are many rows, never one.
    Every ``keep_every`` steps the scores are written, so a lost executor repeats a few steps at most.
    """
    out = edges.groupBy("source").count().withColumnRenamed("count", "out")
    into = edges.groupBy("target").count().withColumnRenamed("count", "inn")
    moves = edges.join(out, "source").join(into, "target")
    forth = moves.select(F.col("source").alias("host"), F.col("target").alias("to"), (1 / F.col("out")).alias("t"), F.lit(0.0).alias("d"))
    back = moves.select(F.col("target").alias("host"), F.col("source").alias("to"), F.lit(0.0).alias("t"), (1 / F.col("inn")).alias("d"))
    moves = stored(forth.union(back).groupBy("host", "to").agg(F.sum("t").alias("t"), F.sum("d").alias("d")), "host-moves")
    start = stored(seeds.select("host", F.col("trust").cast("double").alias("trust"), F.col("distrust").cast("double").alias("distrust")), "seeds")
    scores = start
    for step in range(1, rounds + 1):
        sent = scores.join(moves, "host").select(
            F.col("to").alias("host"), (damping * F.col("trust") * F.col("t")).alias("trust"), (damping * F.col("distrust") * F.col("d")).alias("distrust")
        )
        base = start.select("host", ((1 - damping) * F.col("trust")).alias("trust"), ((1 - damping) * F.col("distrust")).alias("distrust"))
        scores = base.union(sent).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if step % keep_every == 0 or step == rounds:
            scores = stored(scores, "host-scores")
    return scores


def judge(pages: DataFrame, rules: dict[str, str], threshold: float = 0.05, rounds: int = 20) -> DataFrame:
    """page_id, host, path, rule, verdict, host_score for every row of ``pages`` (page_id, url, html).

    A null url or one without ``://`` has an empty host and path and is allowed; a null html has no links. Rows that
    repeat are judged each for itself; a null page_id passes through; other columns are not read. An empty table gives
    no rows. Of rules of equal length the alphabetically first one counts.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path"), "html").withColumn("rule", rule_for(rules, F.col("host"), F.col("path")))
    verdict = reduce(lambda w, r: w.when(F.col("rule") == r, F.lit(rules[r])), rules, F.when(F.lit(False), F.lit(None).cast("string")))
    seen = seen.withColumn("ruled", verdict)
    shares = seen.where("host != ''").groupBy("host").agg(
        F.sum((F.col("ruled") == TRUST).cast("int")).alias("good"),
        F.sum((F.col("ruled") == DISTRUST).cast("int")).alias("bad"),
        F.count("*").alias("n"),
    )
    good, bad = F.coalesce("good", F.lit(0)), F.coalesce("bad", F.lit(0))
    seeds = shares.select("host", (good > bad).cast("double").alias("trust"), (bad * 2 > F.col("n")).cast("double").alias("distrust"))
    scores = propagate(seeds, host_edges(seen), rounds=rounds)
    by_host = scores.select("host", (F.col("trust") - F.col("distrust")).alias("host_score"))
    return seen.drop("html").join(by_host, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("host_score") < -threshold, F.lit(DISTRUST)).otherwise(F.lit(TRUST))).alias("verdict"),
        "host_score",
    )
