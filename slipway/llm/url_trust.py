"""URL filters: rules first, then trust and distrust that spread over links between hosts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipway.llm.frames import stored
from slipway.session import remove

DAMPING = 0.85
# Rounds go on until none changes any host's score by more than this part of it.
TOLERANCE = 1e-9
# Written tables take the place of a growing plan each so many rounds; then it is seen whether scores still change.
ROUNDS_PER_TABLE = 6
# Links of one host that a round takes as one: a host with more is split, so that none fills a task.
LINKS_PER_SLOT = 100_000
# The SQL for another engine has no loop that ends by itself. It follows links over six hops, in lower case only.
ORACLE_ROUNDS = 6
# A host is blocked if its distrust is more than so many times its trust.
DISTRUST_RATIO = 1.0

_ORACLE_LINK = r"""(?:href|src)\s*=\s*["']?(?:https?:)?//([^/?#"'\s<>]+)"""
_LINK = "(?i)" + _ORACLE_LINK


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def _ascii_lower(text: Column) -> Column:
    """A-Z alone: ``lower`` would change other letters too, some of them into ASCII."""
    letters = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(text, letters, letters.lower())


def _parts(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; path: from there up to ``?``, ``#`` or the
    end. Both are empty without ``://``."""
    known = F.coalesce(url, F.lit(""))
    at = F.instr(known, "://")
    rest = F.when(at > 0, F.substring(known, at + 3, F.length(known))).otherwise(F.lit(""))
    return _ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _rule(rules: tuple[Rule, ...], field: str) -> Column:
    """``field`` of the longest rule that fits ``host`` and ``path``, of equally long ones the first, else null."""
    fitting = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda rule: len(rule.text)):
        host = (F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))
        fitting = F.when(host & F.startswith("path", F.lit(rule.path)), F.lit(getattr(rule, field))).otherwise(fitting)
    return fitting


def _spread(seeds: DataFrame, edges: DataFrame, totals: DataFrame) -> DataFrame:
    """``host`` and ``score``: personalised PageRank of ``edges`` (see `_shares`) from ``seeds`` (``host``, ``seed``).

    A round is one join and one sum, which is combined before its shuffle. A host's score meets its links in as many
    slots as these call for. Scores begin at the seeds' own and only grow, by what came one link further; a host that a
    round reaches for the first time has changed by all of its score, so rounds go on at least until no more hosts are
    reached. Rank that reaches a host without links ends there. Hosts that nothing reaches have no row.
    """
    spark = seeds.sparkSession
    begun = seeds.join(totals.select(F.col("by").alias("host"), "slots"), "host", "left")
    started = stored(
        begun.select("host", (F.col("seed") * (1 - DAMPING)).alias("score"), F.coalesce("slots", F.lit(1)).alias("slots")), "started"
    )
    held, moving = started, True
    while moving:
        ranks = held.select("host", "score", "slots")
        for turn in range(ROUNDS_PER_TABLE):
            before = ranks
            dealt = ranks.select("host", "score", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
            sent = edges.join(dealt, (edges["src"] == dealt["host"]) & (edges["slot"] == dealt["slot"])).select(
                F.col("dst").alias("host"), (F.col("share") * F.col("score") * DAMPING).alias("score"), F.col("dst_slots").alias("slots")
            )
            parts = sent.union(started)
            if turn < ROUNDS_PER_TABLE - 1:
                ranks = parts.groupBy("host").agg(F.sum("score").alias("score"), F.max("slots").alias("slots"))
            else:
                old = before.select("host", F.lit(0.0).alias("score"), "slots", F.col("score").alias("old"))
                parts = parts.select("host", "score", "slots", F.lit(0.0).alias("old")).union(old)
                ranks = parts.groupBy("host").agg(
                    F.sum("score").alias("score"), F.max("slots").alias("slots"), F.sum("old").alias("old")
                )
        ranks = stored(ranks, "ranks")
        if held is not started:
            for path in {file.rpartition("/")[0] for file in held.inputFiles()}:
                remove(spark, path)
        held = ranks
        moving = not ranks.where(F.abs(F.col("score") - F.col("old")) > F.col("score") * TOLERANCE).isEmpty()
    return held.select("host", "score")


def _shares(links: DataFrame, by: str, to: str) -> tuple[DataFrame, DataFrame]:
    """Edges ``src``, ``dst``, ``share`` (of ``src``'s links), ``slot`` and ``dst_slots``, and ``slots`` of each host.

    The sums are written before links meet them, so adaptive execution splits the partition of a host with very many.
    """
    totals = links.groupBy(F.col(by).alias("by")).agg(
        F.sum("n").alias("total"), F.ceil(F.count("*") / LINKS_PER_SLOT).cast("int").alias("slots")
    )
    totals = stored(totals, "totals")
    ends = totals.select(F.col("by").alias("to"), F.col("slots").alias("to_slots"))
    edges = links.join(totals, links[by] == totals["by"]).select(
        F.col(by).alias("src"), F.col(to).alias("dst"), (F.col("n") / F.col("total")).alias("share"),
        F.pmod(F.xxhash64(to), F.col("slots")).cast("int").alias("slot"),
    )
    edges = edges.join(ends, edges["dst"] == ends["to"], "left")
    return stored(edges.select("src", "dst", "share", "slot", F.coalesce("to_slots", F.lit(1)).alias("dst_slots")), "shares"), totals


def host_scores(judged: DataFrame, links: DataFrame) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` of every host that either one reaches.

    Trust starts at hosts with pages that a rule allows, by their number, and follows links. Distrust starts at those
    with pages that a rule blocks and goes against links: who links to blocked hosts is distrusted. ``judged`` has one
    row per page with ``host`` and ``ruled`` (allow, block or null); ``links`` has ``src``, ``dst`` and ``n``.
    """
    counts = judged.where("ruled is not null and host <> ''").groupBy("host").agg(
        F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked")
    )
    counts = stored(counts, "seeds")
    total = counts.agg(F.sum("allowed").alias("all_allowed"), F.sum("blocked").alias("all_blocked"))
    seeds = counts.join(F.broadcast(total))  # one row

    def start(count: str) -> DataFrame:
        return seeds.where(f"{count} > 0").select("host", (F.col(count) / F.col(f"all_{count}")).alias("seed"))

    trust = _spread(start("allowed"), *_shares(links, "src", "dst")).withColumnRenamed("score", "trust")
    distrust = _spread(start("blocked"), *_shares(links, "dst", "src")).withColumnRenamed("score", "distrust")
    return trust.join(distrust, "host", "full").select(
        "host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")
    )


def url_verdicts(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``pages`` (``page_id``, ``url``, ``html``): ``page_id``, ``host``, ``path``, ``rule`` and
    ``verdict`` (allow or block).

    The longest rule that fits decides, of equally long ones the first. Other pages are judged by their host: blocked if its distrust is more than
    ``DISTRUST_RATIO`` times its trust. Hosts that no link ties to a rule are allowed, and so are pages without a host.
    The html is read once for links to other hosts, counted per pair of hosts before the shuffle; pages meet only their
    host's verdict again, and only blocked hosts are listed for that. A null url has no host, a null html no links.
    Repeated rows come back each and count each; an empty table gives no rows; other columns are left out.
    """
    host, path = _parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    links = F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1)), _ascii_lower)
    links = parts.where("host <> ''").select(F.col("host").alias("src"), F.explode(links).alias("dst")).where("src <> dst")
    links = stored(links.groupBy("src", "dst").agg(F.count("*").alias("n")), "links")
    judged = parts.drop("html").withColumns({"rule": _rule(rules, "text"), "ruled": _rule(rules, "verdict")})
    scores = host_scores(judged, links)
    blocked = stored(scores.where(F.col("distrust") > F.col("trust") * DISTRUST_RATIO).select(F.col("host").alias("_host")), "blocked")
    joined = judged.join(blocked, judged["host"] == blocked["_host"], "left")
    own = F.when(F.col("_host").isNotNull(), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"))


def _oracle(rules: tuple[Rule, ...] = RULES, rounds: int = ORACLE_ROUNDS) -> str:
    """The same for another engine, round by round."""

    def lowered(text: str) -> str:
        letters = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
        return f"translate({text}, '{letters}', '{letters.lower()}')"

    def chosen(field: str) -> str:
        cases = " ".join(
            f"when (host = '{rule.host}' or ends_with(host, '.{rule.host}')) and starts_with(path, '{rule.path}') then '{getattr(rule, field)}'"
            for rule in sorted(rules, key=lambda rule: -len(rule.text))
        )
        return f"case {cases} end"

    def rounds_of(name: str, src: str, dst: str) -> str:
        steps = [f"{name}0 as (select host, {name}_seed as score from seeds where {name}_seed > 0)"]
        for turn in range(1, rounds + 1):
            steps.append(
                f"""{name}{turn} as (select host, sum(score) as score from (
  select {dst} as host, n / sum(n) over (partition by {src}) * coalesce(score, 0) * {DAMPING} as score from links left join {name}{turn - 1} on host = {src}
  union all select host, {name}_seed * {1 - DAMPING} from seeds where {name}_seed > 0) group by host)"""
            )
        return ",\n".join(steps)

    link = _ORACLE_LINK.replace("'", "''")
    return f"""
with parts as (
  select page_id, html, {lowered("regexp_extract(rest, '^[^/?#]*')")} as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from (select *, case when contains(coalesce(url, ''), '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages)
),
judged as (select page_id, host, path, {chosen("text")} as rule, {chosen("verdict")} as ruled from parts),
links as (
  select src, dst, count(*) as n from (
    select host as src, {lowered(f"unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1))")} as dst from parts where host <> ''
  ) where src <> dst group by all
),
seeds as (
  select host, count(*) filter (ruled = 'allow') / sum(count(*) filter (ruled = 'allow')) over () as trust_seed,
    count(*) filter (ruled = 'block') / sum(count(*) filter (ruled = 'block')) over () as distrust_seed
  from judged where ruled is not null and host <> '' group by host
),
{rounds_of("trust", "src", "dst")},
{rounds_of("distrust", "dst", "src")},
blocked as (
  select d.host from distrust{rounds} d left join trust{rounds} t using (host) where d.score > coalesce(t.score, 0) * {DISTRUST_RATIO}
)
select page_id, host, path, rule, coalesce(ruled, case when host in (select host from blocked) then 'block' else 'allow' end) as verdict
from judged
"""


URL_ORACLE = _oracle()
