"""URL rules, and trust and distrust spread over the links between hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import stage

#: (verdict, host and path) of the fixed rules.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
#: Steps of propagation in the SQL, the share that goes on at each in per cent, and the mass of a seed.
STEPS, DAMPING, UNIT = 4, 85, 10**12
#: Propagation ends when no mass changes by more in a step.
TOLERANCE = 10**6
#: Steps between two looks at the masses, each of which is staged.
ROUNDS = 6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Absolute link targets in a page, as the SQL takes them.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*([a-z][a-z0-9+.\-]*://[^"'\s>]*)"""
#: The same and those that name a host but no scheme; others lead to the page's own host.
ANY_LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^"'\s>]*)"""


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """verdict and rule of the longest rule that fits, else null."""
    found = None
    for verdict, rule in sorted(rules, key=lambda x: -len(x[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def _target(link: Column) -> Column:
    """The host that a link names, with a scheme or without."""
    return host_of(F.regexp_replace(link, "^//", "://"))


def _share(mass: Column, ways: Column) -> Column:
    """What a host hands on to each of its targets, in whole numbers; decimal all along."""
    whole = "decimal(38,0)"
    sent, parts = (mass.cast(whole) * DAMPING).cast(whole), (ways.cast("decimal(19,0)") * 100).cast("decimal(21,0)")
    return ((sent - F.pmod(sent, parts)) / parts).cast(whole)


def _spread(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """host and mass: personalised PageRank of the seeds over edges (source, target, ways).

    ways is the number of targets of the source.  Masses start from what the seeds keep and only
    grow; they are passed on until none changes by more than TOLERANCE in a step.  Whole numbers,
    so that the order of addition is without effect, and decimal, so that none overflows.  A host
    without mass has no row.
    """
    whole, none = "decimal(38,0)", F.lit(0).cast("decimal(38,0)")
    edges = stage(edges, "ways")
    kept = seeds.select("host", F.lit(UNIT * (100 - DAMPING) // 100).cast(whole).alias("mass"), none.alias("before"))
    masses = stage(kept, "masses")
    while True:
        for _ in range(ROUNDS):
            sent = edges.join(masses, edges["source"] == masses["host"]).select(
                F.col("target").alias("host"),
                _share(F.col("mass"), F.col("ways")).alias("mass"),
                none.alias("before"),
            )
            old = masses.select("host", none.alias("mass"), F.col("mass").alias("before"))
            masses = kept.unionByName(sent).unionByName(old).groupBy("host").agg(
                F.sum("mass").cast(whole).alias("mass"), F.sum("before").cast(whole).alias("before")
            )
        masses = stage(masses, "masses")
        change = masses.agg(F.max(F.col("mass") - F.col("before"))).first()[0]
        if change is None or change <= TOLERANCE:
            return masses.select("host", "mass").where("mass > 0")


def judge_urls(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust (in seeds) of each row of pages.

    The longest rule that fits decides.  For the other pages their host does: it is blocked if
    more distrust than trust reaches it.  Trust starts from the hosts that have an allowed page
    and are no seeds of distrust, and follows the links; distrust starts from the hosts more than
    half of whose pages are blocked by a rule, and follows the links backwards, to those who link
    to them.  A null url, or one without `://`, has an empty host and path; pages without a host
    are allowed, and no seeds.  A null html has no links; `//host` is a link to that host.  Repeated rows are judged each and count
    each as a page; links of a host to itself do not count, and several to one host count once.
    An empty table gives no rows; other columns of pages are left out.

    Pages are read once, into narrow staged rows; counts and masses are added up before every
    shuffle, so a hot host or a hub leaves each task as one row, and the joins have one row for
    each host on a side, so that Spark can split the other.
    """
    read = stage(
        pages.select(
            pages["page_id"].alias("page_id"),
            host_of(pages["url"]).alias("host"),
            path_of(pages["url"]).alias("path"),
            F.transform(
                F.array_distinct(F.coalesce(
                    F.regexp_extract_all(pages["html"], F.lit(ANY_LINK), 1), F.array().cast("array<string>")
                )),
                _target,
            ).alias("targets"),
        ).withColumn("found", rule_of(F.col("host"), F.col("path"))),
        "pages",
    )
    edges = (
        read.where("host <> ''")
        .select(F.col("host").alias("source"), F.explode(F.array_distinct("targets")).alias("target"))
        .where("target <> '' AND target <> source")
        .distinct()
    )
    edges = stage(edges, "edges")
    hosts = stage(
        read.where("host <> ''").groupBy("host").agg(
            F.count("*").alias("pages"),
            F.count_if(F.col("found.verdict") == "block").alias("blocked"),
            F.count_if(F.col("found.verdict") == "allow").alias("allowed"),
        ),
        "hosts",
    )
    bad = hosts.where("2 * blocked > pages")
    good = hosts.where("allowed > 0 AND 2 * blocked <= pages")

    def ways(one: str, other: str) -> DataFrame:
        turned = edges.select(F.col(one).alias("source"), F.col(other).alias("target"))
        counts = turned.groupBy("source").agg(F.count("*").alias("ways"))
        return turned.join(counts, "source")

    trust = _spread(good, ways("source", "target")).select("host", F.col("mass").alias("trust"))
    distrust = _spread(bad, ways("target", "source")).select("host", F.col("mass").alias("distrust"))
    scores = trust.join(distrust, "host", "full").na.fill(0)
    return (
        read.join(scores, "host", "left")
        .select(
            "page_id", "host", "path",
            F.col("found.rule").alias("rule"),
            F.coalesce(
                F.col("found.verdict"),
                F.when(F.coalesce("distrust", F.lit(0)) > F.coalesce("trust", F.lit(0)), "block").otherwise("allow"),
            ).alias("verdict"),
            *[(F.coalesce(name, F.lit(0)).cast("double") / UNIT).alias(name) for name in ("trust", "distrust")],
        )
    )


def oracle_sql() -> str:
    """The same rows in plain SQL."""
    when = []
    for verdict, rule in sorted(RULES, key=lambda x: -len(x[1])):
        domain, slash, rest = rule.partition("/")
        when.append((
            f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash}{rest}')", verdict, rule
        ))
    case = lambda k: "CASE " + " ".join(f"WHEN {w[0]} THEN '{w[k]}'" for w in when) + " END"
    host = f"coalesce(translate(regexp_extract({{}}, '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '')"
    link = LINK.replace("'", "''")
    ctes = [
        f"p AS (SELECT page_id, {host.format('url')} AS host,"
        " coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path, html FROM pages)",
        f"r AS (SELECT *, {case(1)} AS given, {case(2)} AS rule FROM p)",
        "l AS (SELECT host AS source, unnest(regexp_extract_all(html, '" + link + "', 1)) AS url FROM p WHERE host <> '')",
        f"e AS (SELECT DISTINCT source, {host.format('url')} AS target FROM l"
        f" WHERE {host.format('url')} NOT IN ('', source))",
        "h AS (SELECT host, count(*) AS pages, count(*) FILTER (WHERE given = 'block') AS blocked,"
        " count(*) FILTER (WHERE given = 'allow') AS allowed FROM r WHERE host <> '' GROUP BY host)",
    ]
    for name, one, other, seeds in (
        ("trust", "source", "target", "allowed > 0 AND 2 * blocked <= pages"),
        ("distrust", "target", "source", "2 * blocked > pages"),
    ):
        ctes.append(f"{name}w AS (SELECT {one} AS source, {other} AS target,"
                    f" count(*) OVER (PARTITION BY {one}) AS ways FROM e)")
        ctes.append(f"{name}s AS (SELECT host FROM h WHERE {seeds})")
        ctes.append(f"{name}0 AS (SELECT host, {UNIT}::HUGEINT AS mass FROM {name}s)")
        for i in range(STEPS):
            ctes.append(
                f"{name}{i + 1} AS (SELECT host, sum(mass) AS mass FROM (SELECT host,"
                f" {UNIT * (100 - DAMPING) // 100} AS mass FROM {name}s UNION ALL SELECT w.target,"
                f" m.mass * {DAMPING} // (100 * w.ways) FROM {name}w w JOIN {name}{i} m ON w.source = m.host)"
                " GROUP BY host)"
            )
    value = lambda name: f"coalesce({name}{STEPS}.mass, 0)"
    return (
        "WITH " + ", ".join(ctes) + " SELECT page_id, r.host AS host, path, rule, coalesce(given,"
        f" CASE WHEN {value('distrust')} > {value('trust')} THEN 'block' ELSE 'allow' END) AS verdict,"
        f" {value('trust')}::DOUBLE / {UNIT}::DOUBLE AS trust, {value('distrust')}::DOUBLE / {UNIT}::DOUBLE AS distrust FROM r"
        f" LEFT JOIN trust{STEPS} ON trust{STEPS}.host = r.host"
        f" LEFT JOIN distrust{STEPS} ON distrust{STEPS}.host = r.host"
    )
