"""URL filters: per-host path templates, judged by rules where one fits and by smoothed purity elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, drop_stage, table

#: (verdict, host, path prefix)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
         ("block", "com", "/de/")]
#: A literal segment stays in a template unless it has less than LEAST_SHARE of the mean rows of its siblings.  Where siblings
#: have under VARIABLE_ROWS rows on average (most occur once, as slugs do) only those with VARIABLE_ROWS times the mean stay.
#: Both compare siblings with each other, so a url's template doesn't change as the table grows.
LEAST_SHARE, VARIABLE_ROWS = 0.5, 2.0
#: Levels of the tree; literals below are wildcards.
MAX_DEPTH = 12
#: Rows that a parent's purity counts for when a template's own is smoothed.
PRIOR_ROWS = 20.0
#: Two branches whose blocked shares differ by fewer standard errors are merged.
SIMILAR_Z = 1.96


def host_and_path(url):
    """Columns (host, path) of a url column; both empty where it is null or has no ://."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", ""))
    host = F.coalesce(F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def _rule(rules, host, path):
    """Struct (rule, verdict) of the longest rule that fits; null where none does.  Of two as long the one listed last holds."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _shape(segment):
    """What kind of variable a path segment is; null for a plain literal."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    return (F.when(F.length(stem) == 0, F.lit(""))
            .when(stem.rlike(r"^\d+$"), F.lit("{number}"))
            .when(stem.rlike(r"(?i)^(?=.*\d)[0-9a-f]{8,}$"), F.lit("{hex}"))
            .when(stem.rlike(r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"), F.lit("{uuid}"))
            .when(stem.rlike(r"\d{4}") | (F.length(stem) > 40), F.lit("{mixed}")))


def _branches(literals: DataFrame, similar_z: float) -> DataFrame:
    """(host, node, name, branch): the literal children that stay under each node, and the branch each belongs to.

    Children that are labelled and whose blocked share is statistically that of their siblings, above it or below it are one
    branch each; a child that is alone in its branch, or unlabelled, keeps its own."""
    children = cut_lineage(literals.groupBy("host", "node", "name").agg(F.sum("n").alias("rows"), F.sum("b").alias("b"), F.sum("m").alias("m")), "children")
    mean = children.groupBy("host", "node").agg((F.sum("rows") / F.count("*")).alias("mean"))
    least = F.col("mean") * F.when(F.col("mean") < VARIABLE_ROWS, F.lit(VARIABLE_ROWS)).otherwise(F.lit(LEAST_SHARE))
    kept = children.join(mean, ["host", "node"]).where(F.col("rows") >= least)
    pooled = kept.groupBy("host", "node").agg(F.sum("b").alias("all_b"), F.sum("m").alias("all_m"))
    rest_b, rest_m = F.col("all_b") - F.col("b"), F.col("all_m") - F.col("m")
    share = F.try_divide("all_b", "all_m")
    error = F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1.0), "m") + F.try_divide(F.lit(1.0), rest_m)))
    apart = F.try_divide("b", "m") - F.try_divide(rest_b, rest_m)
    side = F.when(apart > similar_z * error, F.lit("{+}")).when(apart < -similar_z * error, F.lit("{-}")).when(apart.isNotNull(), F.lit("{=}"))
    sided = kept.join(pooled, ["host", "node"]).select("host", "node", "name", side.alias("side"))
    sizes = sided.where("side is not null").groupBy("host", "node", "side").agg(F.count("*").alias("members"))
    return sided.join(sizes, ["host", "node", "side"], "left").select("host", "node", "name", F.when(F.col("members") > 1, F.col("side")).otherwise(F.col("name")).alias("branch"))


def with_templates(urls: DataFrame, similar_z: float = SIMILAR_Z) -> DataFrame:
    """``urls`` (host, path, n, judged: one row a url) with ``template`` and ``leaf``: its place in its host's path-template tree.

    The tree grows depth by depth.  The segments under one node are counted together, whatever other nodes hold: numbers, hashes and
    the like generalise by their form, literals that are rare among their siblings to *, and statistically similar branches are
    merged, so that what is below them is counted together too.  ``template`` names the segments, ``leaf`` the
    merged branches.  Each level is one grouped table of (host, node, segment) and is written; a finished url isn't read again."""
    blocked = F.when(F.col("judged.verdict") == "block", F.col("n")).otherwise(0)
    labelled = F.when(F.col("judged").isNotNull(), F.col("n")).otherwise(0)
    state = urls.select("host", "path", "n", "judged", blocked.alias("b"), labelled.alias("m"), F.split(F.regexp_replace("path", "^/|/$", ""), "/").alias("segments"),
                        F.lit("").alias("node"), F.lit("").alias("template"))
    state = cut_lineage(state, "tree")
    levels, done = [state], []
    deepest = state.agg(F.max(F.size("segments"))).first()[0] or 0
    for depth in range(min(deepest, MAX_DEPTH)):
        segment = F.get("segments", F.lit(depth))
        at = state.withColumns({"form": _shape(segment), "name": F.when(_shape(segment).isNull(), segment)})
        moved = at.join(_branches(at.where("name is not null"), similar_z), ["host", "node", "name"], "left")
        label = F.coalesce("form", F.when(F.col("branch").isNotNull(), F.col("name")), F.lit("*"))
        moved = moved.select("host", "path", "n", "judged", "b", "m", "segments", F.concat_ws("/", "node", F.coalesce("form", "branch", F.lit("*"))).alias("node"),
                             F.concat_ws("/", "template", label).alias("template"))
        levels.append(cut_lineage(moved, "tree"))
        done.append(levels[-1].where(F.size("segments") == depth + 1))
        state = levels[-1].where(F.size("segments") > depth + 1)
    below = F.array_join(F.transform(F.slice("segments", MAX_DEPTH + 1, F.greatest(F.size("segments") - MAX_DEPTH, F.lit(0))), lambda s: F.concat(F.lit("/"), F.coalesce(_shape(s), F.lit("*")))), "")
    out = state.withColumns({"node": F.concat("node", below), "template": F.concat("template", below)})
    for part in done:
        out = out.unionByName(part)
    out = cut_lineage(out.select("host", "path", "n", "judged", "b", "m", "template", F.col("node").alias("leaf")), "templates")
    for level in levels:
        drop_stage(level)
    return out


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, prior_rows: float = PRIOR_ROWS,
               similar_z: float = SIMILAR_Z) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every url.

    A url that a rule fits has that rule's verdict (the longest rule's).  The rules' verdicts are
    the labels from which the others are judged: each url falls into a leaf of its host's
    template tree (``with_templates``); the leaf's blocked share is smoothed towards
    that of the same template over all hosts, which is smoothed towards the overall share.
    A url is blocked if the smoothed share is over one half.

    Null and malformed urls have empty host and path, no rule, and are judged as the empty
    template.  Repeated rows come back repeated; without any label all are allowed."""
    host, path = host_and_path(F.col(f"`{url_col}`"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    judged = rows.select("*", _rule(rules, F.col("host"), F.col("path")).alias("judged"))
    distinct = with_templates(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.first("judged").alias("judged")), similar_z)
    purity = _purities(distinct, prior_rows)
    # one row for each distinct (host, path) comes back to the pages; a frequent url's pages are split by the skew join
    verdicts = distinct.join(purity, ["host", "leaf", "template"]).select(
        "host", "path", F.col("judged.rule").alias("rule"),
        F.coalesce("judged.verdict", F.when(F.col("purity") > 0.5, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "template", "purity")
    return rows.join(verdicts, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def _purities(distinct: DataFrame, prior_rows: float) -> DataFrame:
    """(host, leaf, template, purity): the smoothed blocked share of every leaf, for each template that falls into it."""
    each = cut_lineage(distinct.groupBy("host", "leaf", "template").agg(F.sum("b").alias("b"), F.sum("m").alias("m")), "leaves")
    own = each.groupBy("host", "leaf").agg(F.sum("b").alias("own_b"), F.sum("m").alias("own_m"))
    shared = each.groupBy("template").agg(F.sum("b").alias("tb"), F.sum("m").alias("tm"))
    overall = each.agg(F.struct(F.sum("b").alias("b"), F.sum("m").alias("m"))).scalar()
    prior = F.coalesce((overall["b"] + 0.5) / (overall["m"] + 1), F.lit(0.5))
    template = (F.col("tb") + prior_rows * prior) / (F.col("tm") + prior_rows)
    return (each.join(own, ["host", "leaf"]).join(shared, "template")
            .select("host", "leaf", "template", ((F.col("own_b") + prior_rows * template) / (F.col("own_m") + prior_rows)).alias("purity")))


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "template", "purity")
