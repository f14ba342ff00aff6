"""URL filters: rules of hosts and paths first, then a tree of path templates judged by labelled purity.

Native: DataFrame expressions only. The tree is built level by level from aggregated paths, top down:
1. numbers, hexadecimal runs and UUIDs in a segment become a wildcard by their form (an extension stays);
2. below one host and prefix, a segment becomes a wildcard if it has fewer than ``least_share`` of the rows or than
   ``least_rows`` of them, fewer than ``least_labels`` labels, and a rate of bad labels that does not differ from that of all its siblings (G-test,
   at ``z`` corrected for the number of labelled siblings). So rows or labels enough always bring a segment back;
3. sibling branches, in the order of their smoothed rates, are merged to one while their rates of bad labels differ
   neither from the pooled rate of those merged so far nor from the first of these (two-proportion z-tests);
4. a template is rejected if its rate of bad labels, smoothed towards its host's, which is smoothed towards that of
   all pages, is over ``reject_over``.

All sums are grouped before they are shuffled, and windows see at most the children of one node: 1 / least_share + 1
and those that labels single out. A merged template names its first NAMES branches and the number of the others.

Rows: a null url, or one without ``://``, has an empty host and path and is judged as the template of those. Pages
without labels count for shares, not for rates. Labels that repeat count each; ties in rates are ordered by segment.
The tree is as deep as the longest path; a node that one path alone passes is left at once. An empty table gives no rows. Extra
columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from umbra.llm.shared import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NAMES = 101
NONE = ""
WILD = "*"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """pages (with host, path) and the rule that fits, its text and verdict; rules are (verdict, host, path)."""
    if len(rules) > 64:
        return _rules_joined(pages, rules)
    which, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        which = F.when(fits, F.lit(host + path)).otherwise(which)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return pages.withColumn("rule", which).withColumn("rule_verdict", verdict)


def _rules_joined(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Many rules: a join on each suffix of the host; Spark broadcasts the rules only below its size limit. Of rules of
    one length the last listed wins, as with few."""
    table = pages.sparkSession.createDataFrame([(*r, k) for k, r in enumerate(rules)], "what string, of string, prefix string, place int")
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    near = pages.select("page", "path", F.explode(suffixes).alias("of")).join(table, "of").where(F.col("path").startswith(F.col("prefix")))
    best = near.groupBy("page").agg(F.max_by(F.struct(F.concat("of", "prefix").alias("rule"), F.col("what").alias("rule_verdict")), F.struct(F.length(F.concat("of", "prefix")), "place")).alias("best"))
    return pages.join(best.select("page", "best.*"), "page", "left")


def _form(segment: Column) -> Column:
    extension = F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z][A-Za-z0-9]{0,4}$", "")
    wild = stem.rlike(r"^[0-9][0-9_.-]*$") | (stem.rlike(r"^[0-9a-fA-F-]{8,}$") & stem.rlike("[0-9]"))
    return F.when(wild, F.concat(F.lit(WILD), extension)).otherwise(segment)


def _counts_term(part: Column, whole: Column, share: Column) -> Column:
    """part * ln(part / (whole * share)), 0 for no part."""
    return F.when(part > 0, part * F.ln(part / (whole * share))).otherwise(0.0)


def _differs(l: Column, b: Column, l_rest: Column, b_rest: Column, siblings: Column, z: float) -> Column:  # noqa: E741
    """Whether b bad of l labels differ from those of the rest: valid for few labels and for many siblings tested."""
    bad = (b + b_rest) / (l + l_rest)
    g = 2 * (_counts_term(b, l, bad) + _counts_term(l - b, l, 1 - bad) + _counts_term(b_rest, l_rest, bad) + _counts_term(l_rest - b_rest, l_rest, 1 - bad))
    return F.when((l > 0) & (l_rest > 0), g > z * z + 2 * F.ln(siblings)).otherwise(False)


def _apart(l: Column, b: Column, l_other: Column, b_other: Column, z: float) -> Column:  # noqa: E741
    pooled = (b + b_other) / (l + l_other)
    deviation = F.sqrt(pooled * (1 - pooled) * (1 / l + 1 / l_other))
    return F.when((l > 0) & (l_other > 0), F.abs(b / l - b_other / l_other) > z * deviation).otherwise(False)


def _starts(branches: Column, z: float) -> Column:
    """The members that begin a new cluster, of branches ((rate, l, b), how many of these) in order.

    A branch joins the cluster before it unless it differs from that cluster's pooled labels or from its first member.
    """
    none = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in ("l", "b", "l_first", "b_first")], F.expr("cast(array() as array<struct<rate:double,l:bigint,b:bigint>>)").alias("starts"))

    def step(c: Column, x: Column) -> Column:
        me, l, b = x["me"], x["me"]["l"], x["me"]["b"]  # noqa: E741
        new = _apart(l, b, c["l"], c["b"], z) | _apart(l, b, c["l_first"], c["b_first"], z)
        first = lambda k: F.when(new | (c["l_first"] == 0), me[k]).otherwise(c[f"{k}_first"]).alias(f"{k}_first")
        pooled = lambda k: (F.when(new, F.lit(0)).otherwise(c[k]) + me[k] * x["many"]).alias(k)
        return F.struct(pooled("l"), pooled("b"), first("l"), first("b"), F.when(new, F.concat(c["starts"], F.array(me))).otherwise(c["starts"]).alias("starts"))

    return F.aggregate(branches, none, step, lambda c: c["starts"])


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", least_share: float = 0.01, z: float = 1.96, smooth: float = 10.0, reject_over: float = 0.5, least_labels: int = 20, least_rows: int = 3) -> DataFrame:
    """(id_col, host, path, rule, verdict, template, n_labelled, bad_rate) of every page.

    labels: (id_col, bad) with bad 1 or 0; several labels of a page count each.
    """
    source = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"))
    host, path = host_and_path(F.col("url"))
    parsed = rule_of(source.select("page", host.alias("host"), path.alias("path")), rules)
    segments = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), _form)
    parsed = parsed.select("page", "host", "path", "rule", "rule_verdict", segments.alias("segments"))

    marks = labels.select(F.col(id_col).alias("page"), F.col("bad").cast("long").alias("bad")).where("bad is not null").groupBy("page").agg(F.count("*").alias("labelled"), F.sum("bad").alias("bad"))
    tree = cut(parsed.join(marks, "page", "left").groupBy("host", "segments").agg(F.count("*").alias("n"), F.coalesce(F.sum("labelled"), F.lit(0)).alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    row = tree.agg(F.sum("labelled"), F.sum("bad"), F.max(F.size("segments"))).first()
    overall = ((row[1] or 0) + 1.0) / ((row[0] or 0) + 2.0)

    above = ["host", "node"]  # node: the template so far
    tree = tree.withColumn("node", F.lit(NONE))
    done: list[DataFrame] = []
    # one level more than the longest path has, for the paths that end there
    for k in range((row[2] if row[2] is not None else -1) + 1):
        segment = F.coalesce(F.get("segments", k), F.lit(NONE))
        child = tree.groupBy(*above, segment.alias("segment")).agg(F.count("*").alias("paths"), F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
        parent = child.groupBy(*above).agg(F.sum("paths").alias("paths_above"), F.sum("n").alias("n_above"), F.sum("labelled").alias("l_above"), F.sum("bad").alias("b_above"), F.count_if(F.col("labelled") > 0).alias("siblings"))
        child = child.join(parent, above)
        common = (F.col("n") >= F.greatest(F.lit(least_share) * F.col("n_above"), F.lit(least_rows))) | (F.col("labelled") >= least_labels)
        differs = _differs(F.col("labelled"), F.col("bad"), F.col("l_above") - F.col("labelled"), F.col("b_above") - F.col("bad"), F.col("siblings"), z)
        branch = F.when((F.col("segment") == NONE) | common | differs, F.col("segment")).otherwise(F.lit(WILD))
        placed = child.withColumn("branch", branch)
        nodes = placed.groupBy(*above, "branch").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"), F.first("l_above").alias("la"), F.first("b_above").alias("ba"))
        prior = (F.col("ba") + smooth * overall) / (F.col("la") + smooth)
        nodes = nodes.withColumn("rate", (F.col("b") + smooth * prior) / (F.col("l") + smooth))
        nodes = nodes.withColumn("me", F.struct("rate", "l", "b")).withColumn("ended", F.col("branch") == NONE)
        # branches of equal counts share a place, so the list is short even where a node has very many
        alike = nodes.groupBy(*above, "ended", "me").agg(F.count("*").alias("many"))
        listed = alike.groupBy(*above, "ended").agg(_starts(F.array_sort(F.collect_list(F.struct("me", "many"))), z).alias("starts"))
        nodes = nodes.join(listed, [*above, "ended"]).withColumn("cluster", F.size(F.filter("starts", lambda s: s <= F.col("me"))))
        members = F.array_sort(F.collect_list("branch"))
        more = F.when(F.size(members) > NAMES, F.concat(F.lit("|+"), (F.size(members) - NAMES).cast("string"))).otherwise("")
        clusters = nodes.groupBy(*above, "ended", "cluster").agg(F.concat(F.array_join(F.slice(members, 1, NAMES), "|"), more).alias("template"))
        merged = nodes.join(clusters, [*above, "ended", "cluster"]).select(*above, "branch", "template")
        names = placed.select(*above, "segment", "branch", "paths_above").join(merged, [*above, "branch"])
        # below a node with one path nothing is left to tell apart: its segments would all stay as they are
        lone = F.col("paths_above") == 1
        rest = F.when(lone, F.expr(f"slice(segments, {k + 1}, greatest(size(segments) - {k}, 0))")).when(F.col("template") == NONE, F.expr("cast(array() as array<string>)")).otherwise(F.array("template"))
        node = F.array_join(F.concat(F.when(F.col("node") == NONE, F.expr("cast(array() as array<string>)")).otherwise(F.array("node")), rest), "/")
        tree = tree.withColumn("segment", segment).join(names, [*above, "segment"])
        tree = cut(tree.select("host", "segments", node.alias("node"), "n", "labelled", "bad", (lone | (F.col("segment") == NONE)).alias("finished")))
        done.append(tree.where("finished").drop("finished"))
        tree = tree.where("not finished").drop("finished")
        if tree.isEmpty():
            break
    tree = reduce(DataFrame.unionByName, done) if done else tree

    hosts = tree.groupBy("host").agg(F.sum("labelled").alias("l_host"), F.sum("bad").alias("b_host"))
    leaves = tree.groupBy(*above).agg(F.sum("labelled").alias("l_leaf"), F.sum("bad").alias("b_leaf")).join(hosts, "host")
    host_rate = (F.col("b_host") + smooth * overall) / (F.col("l_host") + smooth)
    leaves = leaves.withColumn("bad_rate", (F.col("b_leaf") + smooth * host_rate) / (F.col("l_leaf") + smooth))
    judged = tree.select("segments", *above).join(leaves, above)
    judged = judged.select("host", "segments", F.concat_ws("/", "host", "node").alias("template"), F.col("l_leaf").alias("n_labelled"), "bad_rate")
    return parsed.join(judged, ["host", "segments"]).select(
        F.col("page").alias(id_col), "host", "path", "rule", F.coalesce("rule_verdict", F.when(F.col("bad_rate") > reject_over, "block").otherwise("allow")).alias("verdict"), "template", "n_labelled", "bad_rate"
    )
