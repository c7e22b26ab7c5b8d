"""URL filter: rules first, link-graph trust for the rest.

A url's host and path are cut out natively; the longest rule that fits decides. A url
without a rule is decided by its host: trust starts at hosts in proportion to the
pages that an allow rule covers and follows links (personalised PageRank); distrust
starts at hosts with blocked pages and follows links backwards, from a page to those
that link to it. Both start with a total of 1 and are compared per host: block if
distrust exceeds trust by more than ``THRESHOLD``. Scores that differ by less than
``SAME`` of the larger one are equal, however small the table makes both.

Edges run between hosts and are weighted by the number of pages that link; links
within a host and relative ones add none. Everything is DataFrame code: links are
combined to host pairs before the shuffle and written once, so html is parsed once; a
round is one join and one partial sum, and every ``CUT`` rounds the scores become a
Parquet table in the shared checkpoint folder. Scores only grow from round to round;
they are final when no host's grew by more than ``TOLERANCE`` of itself, so hosts at any
distance count (about 160 rounds and one for each link on the longest way).

Mass of hosts without links out (for distrust: in) goes back to the start hosts, in the
proportion they start with. That multiplies every score of a side by one number, so the
rounds leave it out and each side is brought to a total of 1 at the end. The SQL twin
sums the mass of the ways of each length, up to ``LONGEST`` links, instead of iterating
the scores.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no
rule and is allowed by the method unless ``empty`` says otherwise; null html has no
links; repeated pages count each; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrid.session import cut_lineage

DAMPING, CUT = 0.85, 8
LONGEST = 400
THRESHOLD = 0.0
SAME, TOLERANCE = 1e-9, 1e-11
#: Fixed rules: verdict, host, start of the path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\shref\s*=\s*["']?([^"'\s>]+)"""


def host(url) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path(url) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _rule(rules: Sequence[tuple[str, str, str]], value) -> Column:
    """value(verdict, rule) of the longest rule that fits; a CASE of len(rules) branches."""
    chosen = None
    for verdict, of, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((F.col("host") == of) | F.col("host").endswith("." + of)) & F.col("path").startswith(start)
        chosen = (F if chosen is None else chosen).when(fits, F.lit(value(verdict, of + start)))
    return F.lit(None).cast("string") if chosen is None else chosen.otherwise(F.lit(None).cast("string"))


def edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, pages): how many pages of host src link to another host dst."""
    links = F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))
    absolute = F.filter(links, lambda x: x.startswith("//") | x.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"))
    hosts = F.array_distinct(F.transform(absolute, lambda x: host(F.concat(F.lit(":"), F.regexp_replace(x, "^[^/]*", "")))))
    return (pages.where(F.col(html).contains("//")).select(host(F.col(url)).alias("src"), F.explode(hosts).alias("dst"))
            .where("src <> '' and dst <> '' and src <> dst")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("pages")))


def propagate(starts: DataFrame, links: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) from (host, trust0, distrust0), each of total 1, and
    edges (src, dst, pages). Each score has a total of 1, or 0 without starts."""
    links = cut_lineage(links, "links")
    out = links.groupBy("src").agg(F.sum("pages").alias("all_out"))
    into = links.groupBy("dst").agg(F.sum("pages").alias("all_in"))
    shares = links.join(out, "src").join(into, "dst")
    zero = F.lit(0.0)
    ways = cut_lineage(
        shares.select(F.col("src").alias("host"), F.col("dst").alias("to"), (F.col("pages") / F.col("all_out")).alias("give"), zero.alias("blame"))
        .unionByName(shares.select(F.col("dst").alias("host"), F.col("src").alias("to"), zero.alias("give"), (F.col("pages") / F.col("all_in")).alias("blame"))),
        "ways")
    nodes = starts.unionByName(ways.select("host", zero.alias("trust0"), zero.alias("distrust0")))
    nodes = cut_lineage(nodes.groupBy("host").agg(F.sum("trust0").alias("trust0"), F.sum("distrust0").alias("distrust0")), "hosts")
    start = lambda c: (1 - damping) * F.col(c)
    if ways.isEmpty():
        return nodes.select("host", F.col("trust0").alias("trust"), F.col("distrust0").alias("distrust"))
    base = nodes.select("*", start("trust0").alias("trust"), start("distrust0").alias("distrust"))
    while True:
        at = base
        for _ in range(CUT):
            moved = (at.join(ways, "host").groupBy(F.col("to").alias("host"))
                     .agg(F.sum(F.col("trust") * F.col("give")).alias("t"), F.sum(F.col("distrust") * F.col("blame")).alias("d")))
            at = base.join(moved, "host", "left").select(
                "host", "trust0", "distrust0", F.col("trust").alias("trust_was"), F.col("distrust").alias("distrust_was"),
                (start("trust0") + damping * F.coalesce("t", zero)).alias("trust"),
                (start("distrust0") + damping * F.coalesce("d", zero)).alias("distrust"))
        at = cut_lineage(at, "trust")
        grew = lambda c: F.col(c) - F.col(f"{c}_was") > tolerance * F.col(c)
        if at.where(grew("trust") | grew("distrust")).isEmpty():
            total = at.agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")).first()
            return at.select("host", *[(F.col(c) / F.lit(total[c] or 1.0)).alias(c) for c in ("trust", "distrust")])
        base = at.drop("trust_was", "distrust_was")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, page_id: str = "page_id", url: str = "url",
          html: str = "html", threshold: float = THRESHOLD, empty: str = "allow") -> DataFrame:
    """page_id, host, path, rule (or null) and verdict of every row."""
    parted = pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    judged = parted.withColumns({"rule": _rule(rules, lambda verdict, rule: rule), "ruled": _rule(rules, lambda verdict, rule: verdict)})
    seeds = cut_lineage(judged.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked")), "seeds")
    total = seeds.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    share = lambda c, n: (F.col(c) / F.lit(n) if n else F.lit(0.0)).cast("double")
    starts = seeds.select("host", share("allowed", total["a"]).alias("trust0"), share("blocked", total["b"]).alias("distrust0"))
    scores = propagate(starts, edges(pages, url, html))
    # relative, so neither the order of the sums nor the size of the table can turn a verdict
    over = F.col("distrust") - F.col("trust") - threshold
    bad = scores.select("host", (over > SAME * F.greatest("trust", "distrust")).alias("bad"))
    verdict = F.coalesce("ruled", F.when(F.col("host") == "", F.lit(empty)), F.when(F.col("bad"), "block").otherwise("allow"))
    return judged.join(cut_lineage(bad, "verdicts"), "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def oracle_sql(rules: Sequence[tuple[str, str, str]] = RULES) -> str:
    """The same as one DuckDB statement."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    fits = lambda of, start: f"(host = '{of}' OR ends_with(host, '.{of}')) AND starts_with(path, '{start}')"
    case = lambda pick: "CASE " + " ".join(f"WHEN {fits(of, start)} THEN '{pick(v, of + start)}'" for v, of, start in order) + " END"
    lower = lambda x: f"translate({x}, '{_UPPER}', '{_LOWER}')"
    return rf"""
        WITH RECURSIVE parted AS (
            SELECT page_id, html, {lower("regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1)")} AS host,
                regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        judged AS (SELECT *, {case(lambda v, rule: rule)} AS rule, {case(lambda v, rule: v)} AS ruled FROM parted),
        found AS (SELECT page_id, host AS src, unnest(list_distinct(regexp_extract_all(html, '(?i)\shref\s*=\s*["'']?([^"''\s>]+)', 1))) AS link FROM judged),
        linked AS (SELECT DISTINCT page_id, src, {lower("regexp_extract(link, '^[^/]*//([^/?#]*)', 1)")} AS dst FROM found
            WHERE link LIKE '//%' OR regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://')),
        edges AS (SELECT src, dst, count(*) AS n FROM linked WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
        shares AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS give, n / sum(n) OVER (PARTITION BY dst) AS blame FROM edges),
        ways AS (SELECT src, dst, give, 0::DOUBLE AS blame FROM shares UNION ALL SELECT dst, src, 0::DOUBLE, blame FROM shares),
        seeds AS (SELECT host, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b FROM judged WHERE host <> '' GROUP BY host),
        starts AS (SELECT host, coalesce(a / nullif(sum(a) OVER (), 0), 0) AS trust0, coalesce(b / nullif(sum(b) OVER (), 0), 0) AS distrust0
            FROM seeds UNION ALL SELECT DISTINCT src, 0::DOUBLE, 0::DOUBLE FROM ways),
        nodes AS (SELECT host, sum(trust0) AS trust0, sum(distrust0) AS distrust0 FROM starts GROUP BY host),
        walks AS (SELECT 0 AS links, host, trust0 AS trust, distrust0 AS distrust FROM nodes
            UNION ALL SELECT any_value(links) + 1, w.dst, {DAMPING} * sum(trust * give), {DAMPING} * sum(distrust * blame)
            FROM walks JOIN ways w ON w.src = walks.host WHERE links < {LONGEST} AND (trust * give > 0 OR distrust * blame > 0) GROUP BY w.dst),
        sums AS (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM walks GROUP BY host),
        scores AS (SELECT host, coalesce(trust / nullif(sum(trust) OVER (), 0), 0) AS trust,
            coalesce(distrust / nullif(sum(distrust) OVER (), 0), 0) AS distrust FROM sums)
        SELECT j.page_id, j.host, j.path, j.rule,
            coalesce(j.ruled, CASE WHEN s.distrust - s.trust - {THRESHOLD} > {SAME} * greatest(s.trust, s.distrust) THEN 'block' ELSE 'allow' END) AS verdict
        FROM judged j LEFT JOIN scores s ON s.host = j.host"""
