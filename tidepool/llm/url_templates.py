"""Operator 1: URL filter by a tree of path templates [DataFrame functions
only].

Level by level below each host, a path segment stays literal if it holds a
fair share of its parent's pages, or, whatever its share, ``SUPPORT`` labelled
pages: as many as can be judged on their own. All other values of that level
become ``*``. So identifiers turn into wildcards and sections stay, also the
many small ones of a large host. Below level ``LEVELS`` a node is split
further, by support alone, while its deeper pages have support; what is left
is ``**``. Then, from the deepest level up, sibling branches are merged as long
as their rates of bad labels do not differ (two-proportion test): the closest
clusters first, each tested by its pooled counts and by its outermost members,
so that near steps do not chain unlike ends. All of a node are ``*``.
A template is blocked if its smoothed share of bad labels,
(bad + WEIGHT * overall share) / (labelled + WEIGHT), reaches ``LIMIT``.

Rules (host, path, verdict) go before: a rule fits its host and all its
subdomains if the url's path starts with the rule's path; the longest wins.
The rules are a short list in the plan. Pages are joined only with segments
that stay and with templates, both aggregated: they are written and measured, and
up to ``SIDE_ROWS`` and ``SIDE_BYTES`` broadcast, so a hot host stays where it
is; beyond that the join is shuffled and AQE splits it.

Defined cases: null urls and urls without ``://`` have empty host and path
and share one template; an empty path (no slash) starts with no rule's path;
null labels and labels of unknown keys are ignored, a key labelled more than
once is bad if any label is; without labels nothing is blocked by templates;
rows that repeat count as often as they come; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.shared import pick, written

LEVELS = 3  # deeper segments are split only where labels support it
SHARE, LEAST = 0.05, 3  # a literal child holds this share, and rows, of its parent
CHI2 = 3.841  # two-proportion test at 5 %
WEIGHT, LIMIT = 10.0, 0.5
SUPPORT = 10  # or this many labelled pages, which weigh as much as the overall share does
SHOWN = 21  # branches named in a merged template: all of a node that has no literals by support
SIDE_ROWS, SIDE_BYTES = 500_000, 32 << 20  # of segments or templates that are broadcast
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, PARTS, 1), UPPER, LOWER), F.regexp_extract(text, PARTS, 2)


def split_rule(rule: str) -> tuple[str, str]:
    """'example.net/en/' -> ('example.net', '/en/')."""
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest fitting rule (ties: the alphabetically first), or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):  # the strongest is asked first
        h, p = split_rule(rule)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _levels(n: int, stem: str = "t") -> list[str]:
    return [f"{stem}{i}" for i in range(1, n + 1)]


def _segments(path: str = "path") -> Column:
    return F.filter(F.split(path, "/"), lambda x: x != "")


def _attach(pages: DataFrame, side: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """``pages`` joined with a written, aggregated ``side``, which is broadcast
    if it is measured to be small."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in side.columns), F.lit(0))
    n, size = side.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return pages.join(F.broadcast(side) if n <= SIDE_ROWS and size <= SIDE_BYTES else side, keys, how)


def _literals(pages: DataFrame, level: int) -> DataFrame:
    """(host, t1 .. t(level-1), s_level) of the segments that stay."""
    parent = ["host", *_levels(level - 1)]
    seg = f"s{level}"
    values = pages.groupBy(*parent, seg).agg(F.count("*").alias("_n"), F.count("bad").alias("_labelled"))
    total = values.groupBy(*parent).agg(F.sum("_n").alias("_all"))
    return (values.where((F.col("_n") >= LEAST) & (F.col(seg) != "")).join(total, parent)
            .where((F.col("_n") >= F.col("_all") * SHARE) | (F.col("_labelled") >= SUPPORT))
            .select(*parent, seg, F.lit(True).alias("_lit")))


def templated(pages: DataFrame) -> DataFrame:
    """``pages`` (host, path, bad or null) with t1 .. t3 (a segment, '*' or ''
    if none) and ``deep`` (more segments follow)."""
    out = pages.withColumn("_segs", _segments())
    for i in range(1, LEVELS + 1):
        out = out.withColumn(f"s{i}", F.coalesce(F.get("_segs", F.lit(i - 1)), F.lit("")))
    out = out.withColumn("deep", F.size("_segs") > LEVELS).drop("_segs")
    for i in range(1, LEVELS + 1):
        keys = ["host", *_levels(i - 1), f"s{i}"]
        out = (_attach(out, written(_literals(out, i), "url-literals"), keys)
               .withColumn(f"t{i}", F.when(F.col(f"s{i}") == "", "").when(F.col("_lit"), F.col(f"s{i}")).otherwise("*"))
               .drop("_lit"))
    return out.drop(*_levels(LEVELS, "s"))


def deeper(spots: DataFrame) -> tuple[DataFrame, int]:
    """``spots`` with t4, t5, ... as deep as any node's deeper pages hold
    ``SUPPORT`` labels, and the number of levels. A round writes only the pages
    of such nodes; ``deep`` stays where segments below the last level remain."""
    rest, level, parts = spots, LEVELS, []
    while True:
        node = ["host", *_levels(level)]
        split = written(rest.where("deep").groupBy(*node).agg(F.count("bad").alias("_n")).where(F.col("_n") >= SUPPORT)
                        .select(*node, F.lit(True).alias("_split")), "url-split")
        if split.isEmpty():
            break
        flagged = _attach(rest, split, node)
        goes = F.col("deep") & F.coalesce("_split", F.lit(False))
        parts.append((flagged.where(~goes).drop("_split"), level))
        level += 1
        own = flagged.where(goes).drop("_split").withColumn("_seg", F.get(_segments(), F.lit(level - 1)))
        stays = (own.groupBy(*node, "_seg").agg(F.count("bad").alias("_n")).where(F.col("_n") >= SUPPORT)
                 .select(*node, "_seg", F.lit(True).alias("_lit")))
        rest = written(_attach(own, written(stays, "url-stays"), [*node, "_seg"])
                       .withColumn(f"t{level}", F.when(F.col("_lit"), F.col("_seg")).otherwise("*"))
                       .withColumn("deep", F.size(_segments()) > level).drop("_seg", "_lit"), "url-deeper")
    out = rest
    for part, have in parts:
        out = out.unionByName(part.withColumns({f"t{i}": F.lit("") for i in range(have + 1, level + 1)}))
    return out, level


def _unlike(n: Column, bad: Column, n0: Column, bad0: Column) -> Column:
    """Chi-square of two proportions; 0 where there is nothing to compare."""
    gap, both = bad * n0 - bad0 * n, bad + bad0
    scale = both * (n + n0 - both) * n * n0
    return F.when(scale > 0, gap * gap * (n + n0) / scale).otherwise(F.lit(0.0))


def _cluster_starts(branches: Column) -> Column:
    """Lowest rate of each cluster of ``branches``, structs (rate, n, bad) in
    order of rate. The neighbouring clusters that differ least are joined
    first, until all that are left differ: by their pooled counts, or by the
    first member of the one and the last of the other."""
    first = F.transform(branches, lambda x: F.struct(
        x["rate"].alias("rate"), x["n"].alias("n"), x["bad"].alias("bad"), x["n"].alias("n1"), x["bad"].alias("bad1"),
        x["n"].alias("n2"), x["bad"].alias("bad2")))

    def unlike(a: Column, b: Column) -> Column:
        return F.greatest(_unlike(a["n"], a["bad"], b["n"], b["bad"]), _unlike(a["n1"], a["bad1"], b["n2"], b["bad2"]))

    def joined(a: Column, b: Column) -> Column:
        return F.struct(a["rate"].alias("rate"), (a["n"] + b["n"]).alias("n"), (a["bad"] + b["bad"]).alias("bad"),
                        a["n1"].alias("n1"), a["bad1"].alias("bad1"), b["n2"].alias("n2"), b["bad2"].alias("bad2"))

    def step(acc: Column, _: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(acc) - 1), lambda j: F.struct(
            unlike(F.get(acc, j - 1), F.get(acc, j)).alias("unlike"), j.alias("at")))
        merge = lambda p: F.when(p["unlike"] <= CHI2, F.concat(
            F.slice(acc, 1, p["at"] - 1), F.array(joined(F.get(acc, p["at"] - 1), F.get(acc, p["at"]))),
            F.slice(acc, p["at"] + 2, F.size(acc)))).otherwise(acc)
        closest = F.transform(F.array(F.array_min(pairs)), merge)  # names the pair, so that it is sought once
        return F.when(F.size(acc) > 1, F.get(closest, F.lit(0))).otherwise(acc)

    return F.transform(F.aggregate(F.sequence(F.lit(1), F.size(branches)), first, step), lambda c: c["rate"])


def merged_templates(counts: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Template counts (host, t1.., deep, labelled, bad) with m1.. after
    merging similar branches. Branches of equal rate are pooled before a
    node's rates are put in order in one row, so the row is as long as the
    node has distinct rates, whatever the number of pages."""
    out = counts
    for i in range(1, levels + 1):
        out = out.withColumn(f"m{i}", F.col(f"t{i}"))
    for i in range(levels, 0, -1):
        own = f"m{i}"
        names = ["host", "deep", *[f"m{j}" for j in range(1, levels + 1) if j != i]]
        siblings = [*names, "_self"]  # the node itself is not a branch
        branch = out.groupBy(*names, own).agg(F.sum("labelled").alias("_n"), F.sum("bad").alias("_bad"))
        branch = branch.withColumn("_self", F.col(own) == "").withColumn("_rate", F.col("_bad") / F.when(F.col("_n") > 0, F.col("_n")))
        rates = (branch.where("_n > 0").groupBy(*siblings, F.col("_rate").alias("rate"))
                 .agg(F.sum("_n").cast("double").alias("n"), F.sum("_bad").cast("double").alias("bad"))
                 .groupBy(*siblings).agg(F.sort_array(F.collect_list(F.struct("rate", "n", "bad"))).alias("_rates")))
        starts = rates.select(*siblings, _cluster_starts(F.col("_rates")).alias("_starts"))
        # branches without labels join the cleanest
        at = F.coalesce(F.array_max(F.filter("_starts", lambda x: x <= F.col("_rate"))), F.get("_starts", F.lit(0)), F.lit(-1.0))
        cluster = (branch.join(starts, siblings, "left").select(*siblings, own, at.alias("_cluster"))
                   .groupBy(*siblings, "_cluster").agg(F.sort_array(F.collect_list(own)).alias("_own")))
        size, every = F.size("_own"), F.sum(F.size("_own")).over(Window.partitionBy(*siblings))
        whole = F.array_join("_own", "|")
        # a long list of names is cut in the name alone, the digest keeps it unique
        name = F.when(size <= SHOWN, whole).otherwise(
            F.concat(F.array_join(F.slice("_own", 1, SHOWN), "|"), F.lit("|+"), (size - SHOWN).cast("string"), F.lit("#"), F.md5(whole)))
        named = (F.when(size == 1, F.get("_own", F.lit(0))).when(size == every, "*")
                 .otherwise(F.concat(F.lit("{"), name, F.lit("}"))))
        branch = (cluster.withColumn("_named", named).select(*names, F.explode("_own").alias(own), "_named"))
        out = out.join(branch, [*names, own]).drop(own).withColumnRenamed("_named", own)
        # a plan holds one level: each names the one before three times
        out = written(out, "url-merged")
    return out


def filter_urls(pages: DataFrame, labels: DataFrame, rules: dict[str, str], label_key: Column | None = None,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template). ``labels`` has key and
    bad (0 or 1); ``label_key`` gives a page's key from host and path (by
    default its page_id); verdicts are 'allow' and 'block'."""
    host, path = host_path(F.col("url"))
    base = pick(pages, {"page_id": id_col, "url": url_col}).select("page_id", host.alias("host"), path.alias("path"))
    lab = (labels.where("key is not null and bad is not null").groupBy("key").agg(F.max("bad").cast("long").alias("bad")))
    keyed = base.withColumn("key", label_key if label_key is not None else F.col("page_id"))
    keyed = written(keyed.join(lab, "key", "left").drop("key"), "url-labels")
    spots, levels = deeper(written(templated(keyed), "url-templates"))
    names = ["host", *_levels(levels), "deep"]
    counts = spots.groupBy(*names).agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    merged = merged_templates(written(counts, "url-counts"), levels)
    own = Window.partitionBy("host", "deep", *_levels(levels, "m"))
    all_n, all_b = merged.agg(F.coalesce(F.sum("labelled"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    prior = all_b / all_n if all_n else 0.0
    purity = ((F.sum("bad").over(own) + F.lit(WEIGHT * prior)) / (F.sum("labelled").over(own) + F.lit(WEIGHT)))
    parts = [F.when(F.col(f"m{i}") == "", "").otherwise(F.concat(F.lit("/"), F.col(f"m{i}"))) for i in range(1, levels + 1)]
    judged = merged.select(*names, F.when(purity >= LIMIT, "block").otherwise("allow").alias("_method"),
                           F.concat("host", *parts, F.when(F.col("deep"), "/**").otherwise("")).alias("template"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    by_rule = F.lit(None).cast("string")
    for r, v in rules.items():
        by_rule = F.when(F.col("rule") == r, v).otherwise(by_rule)
    return (_attach(spots, written(judged, "url-judged"), names, "inner").withColumn("rule", rule)
            .select("page_id", "host", "path", "rule", F.coalesce(by_rule, F.col("_method")).alias("verdict"), "template"))
