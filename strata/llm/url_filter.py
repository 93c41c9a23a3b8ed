"""URL filter: listed rules first, else a tree of path templates judged by labelled purity.

1. Every path is cut into segments, and runs of digits become ``<n>``.  Pages with the same host and
   shape fold into one row of counts, on the map side, so a host that holds a third of all pages is a
   few rows from here on.
2. Level by level, from the host down: where a branch fans out into many segments that hardly
   repeat, these are variable and become ``*``, while a sibling that repeats does not join them.  Of
   the others, those whose labelled purity does not differ from their siblings' (two-proportion z
   test) merge into ``~``; the rest stay themselves.
3. A template's purity is its share of good labels, smoothed towards its host's, and that towards the
   corpus'.  Templates below ``MIN_PURITY`` are blocked.

Paths may be of any depth: a chain of segments without a fork is passed in one step, so there are as
many rounds as real forks below one another.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.store import stored

#: More distinct segments than this under a branch, each of them less often than this: variable.
FAN, REPEATS = 8, 4
Z = 1.96
#: Labels that the smoothing towards the parent counts for, and the least purity that is allowed.
SMOOTH, MIN_PURITY = 10.0, 0.5
#: (host, path, verdict) in the order they are given; a host stands for its subdomains as well.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path: both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits.  ``rules`` is a short list."""
    longest = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for h, p, _ in longest]
    pick = lambda values: reduce(lambda rest, x: F.when(x[0], F.lit(x[1])).otherwise(rest), reversed([*zip(fits, values)]), F.lit(None).cast("string"))
    return pick([h + p for h, p, _ in longest]), pick([v for *_, v in longest])


def shape_of(path: Column) -> Column:
    """Segments below the host with digit runs as ``<n>``."""
    pieces = F.split(F.regexp_replace(path, "[0-9]+", "<n>"), "/", -1)
    return F.slice(pieces, F.lit(2), F.greatest(F.lit(0), F.size(pieces) - 1))


def _chains(tree: DataFrame) -> DataFrame:
    """Rows that have gone on over the segments below their branch up to its first real fork.

    Any longest row of a branch parts from some other row at the first fork, and from none before it; rows
    that end on the way are no fork.  ``at`` counts the segments that are in the template.
    """
    own = tree.withColumn("rest", F.slice("shape", F.col("at") + 1, F.size("shape") - F.col("at")))
    own = own.join(own.groupBy("host", "template").agg(F.max(F.struct(F.size("rest").alias("k"), "rest")).alias("longest")), ["host", "template"])
    apart = F.array_position(F.zip_with("rest", "longest.rest", lambda a, b: a != b), True)  # 0 if nowhere; a row's end is null
    own = own.withColumn("apart", F.when(apart > 0, apart - 1).cast("int")).drop("longest")
    own = own.join(own.groupBy("host", "template").agg(F.min("apart").alias("fork")), ["host", "template"])
    step = F.least(F.size("rest"), F.coalesce("fork", F.size("rest")))
    grown = F.concat_ws("/", "template", F.when(step > 0, F.array_join(F.slice("rest", F.lit(1), step), "/")))
    return own.select("host", "shape", "n", "l", "g", grown.alias("template"), (F.col("at") + step).alias("at"))


def templates(pages: DataFrame) -> DataFrame:
    """From rows (host, path, good) to (host, shape, template, purity); ``good`` is 1, 0 or null."""
    seen = F.col("good").isNotNull().cast("long")
    tree = pages.groupBy("host", shape_of(F.col("path")).alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(seen).alias("l"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("g"))
    tree = stored(tree.withColumn("template", F.lit("")).withColumn("at", F.lit(0)), "paths")
    sums = [F.sum(c).alias(c) for c in ("n", "l", "g")]
    more = F.col("at") < F.size("shape")
    done = [tree.where(~more)]
    while not (tree := tree.where(more)).isEmpty():
        tree = stored(_chains(tree), "paths")
        done.append(tree.where(~more))
        own = tree.where(more).withColumn("s", F.get("shape", F.col("at")))
        branch = own.groupBy("host", "template", "s").agg(*sums)
        rare = F.col("n") < REPEATS
        fork = branch.groupBy("host", "template").agg(F.count(F.lit(1)).alias("fan"), F.sum(rare.cast("long")).alias("n_rare"),
                                                      *[F.sum(c).alias(f"all_{c}") for c in ("l", "g")])
        branch = branch.join(fork, ["host", "template"])
        variable = rare & (F.col("n_rare") > FAN)
        new = F.when(variable, "*").when((F.col("fan") > 1) & _similar(), "~").otherwise(F.col("s"))
        named = branch.select("host", "template", "s", new.alias("new"))
        tree = own.join(named, ["host", "template", "s"])
        tree = stored(tree.select("host", "shape", "n", "l", "g", F.concat("template", F.lit("/"), "new").alias("template"),
                                  (F.col("at") + 1).alias("at")), "paths")
        done.append(tree.where(~more))
    tree = stored(reduce(DataFrame.unionAll, done).drop("at"), "paths")
    by_template = tree.groupBy("host", "template").agg(F.sum("l").alias("l"), F.sum("g").alias("g"))
    by_host = tree.groupBy("host").agg(F.sum("l").alias("hl"), F.sum("g").alias("hg"))
    whole = tree.agg(F.coalesce(F.sum("g") / F.nullif(F.sum("l"), F.lit(0)), F.lit(1.0)))
    prior = (F.col("hg") + SMOOTH * whole.scalar()) / (F.col("hl") + SMOOTH)
    judged = by_template.join(by_host, "host").withColumn("purity", (F.col("g") + SMOOTH * prior) / (F.col("l") + SMOOTH))
    return tree.select("host", "shape", "template").join(judged.select("host", "template", "purity"), ["host", "template"])


def _similar() -> Column:
    """Whether a branch's share of good labels is that of the other branches of its fork."""
    l, g = F.col("l"), F.col("g")  # noqa: E741
    rest_l, rest_g = F.col("all_l") - l, F.col("all_g") - g
    p = F.col("all_g") / F.nullif("all_l", F.lit(0))
    gap = g / F.nullif(l, F.lit(0)) - rest_g / F.nullif(rest_l, F.lit(0))
    z2 = gap * gap / F.nullif(p * (1 - p) * (1 / F.nullif(l, F.lit(0)) + 1 / F.nullif(rest_l, F.lit(0))), F.lit(0.0))
    return F.coalesce(z2 < Z * Z, F.lit(True))


def filter_urls(pages: DataFrame, good: Column | None = None, rules=RULES, url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``purity``.

    ``good`` labels pages: 1, 0, or null where unknown; without any label every purity is 1.  A null
    url, or one without ``://``, has an empty host and path and is judged as such a host.  Repeated
    rows count as often as they stand.  Kept columns with the name of a new one are replaced.
    """
    new = ["host", "path", "rule", "verdict", "template", "purity"]
    names = [c for c in (pages.columns if keep is None else keep) if c.lower() not in new]
    host, path = parts(pages[f"`{url}`"].cast("string"))
    label = F.lit(None).cast("int") if good is None else good.cast("int")
    rows = pages.select(F.struct(F.lit(1).alias("_"), *[pages[f"`{c}`"] for c in names]).alias("row"), host.alias("host"),
                        path.alias("path"), label.alias("good"))
    found = templates(rows.select("host", "path", "good"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    out = rows.withColumn("shape", shape_of(F.col("path"))).join(found, ["host", "shape"])
    out = out.withColumn("rule", rule).withColumn(
        "verdict", F.coalesce(verdict, F.when(F.col("purity") < MIN_PURITY, "block").otherwise("allow")))
    return out.select(*[F.col("row").getField(c).alias(c) for c in names], *new)
