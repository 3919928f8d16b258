"""URL filters: curated rules, and a path-template tree that learns from them.

A URL is split into host and path. Curated rules ``(verdict, host, path)`` fit a
host and its subdomains and paths with that prefix; the longest rule decides.

What no rule decides is judged by its host's path templates. Path segments become
shapes: runs of digits are ``{n}``, long mixed identifiers ``{id}``; the tree has
``max_depth`` levels, and all shapes beyond them are together one segment of a last
level. Per host the shapes form a tree, walked level by level from grouped counts:
sibling branches whose share of bad labels does not differ significantly from their
parent's pooled share are merged into one wildcard branch. A branch with too few
labels of its own, but as many URLs, is judged by structure: it joins the wildcard
if at least half of its URLs continue below it in a way that a merged sibling's do.
Other branches stay apart. A template's purity is its share of good labels, smoothed towards the
share of all labels; templates below ``min_purity`` are rejected. Labels come from
any table; the rules' own verdicts serve as labels here, so a template is rejected
only on evidence within its host.

URLs are first counted per host and shape, so a host or template of a third of
all rows is one row in the tree; only DataFrame functions are used.

Defined results: a null URL or one without ``://`` has empty host and path; rows
that share an id are judged each; unlabelled templates have the smoothed purity
of no labels and pass; ties between rules of one length go to the later rule;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_side, stage

MAX_DEPTH = 8
MIN_LABELS = 5
Z = 1.96
STRENGTH = 10.0
MIN_PURITY = 0.2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """``(host, path)`` of a URL."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule, ``struct(length, place, rule, verdict)`` or null.
    ``rules``: a short curated list; it becomes one expression."""
    fits = []
    for k, (verdict, rule_host, rule_path) in enumerate(rules):
        ok = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        own = F.struct(F.lit(len(rule_host) + len(rule_path)).alias("length"), F.lit(k).alias("place"),
                       F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        fits.append(F.when(ok, own))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,place:int,rule:string,verdict:string>")


def shapes(path: Column, max_depth: int = MAX_DEPTH) -> Column:
    """Generalised segments of a path: ``max_depth``, and what is beyond as one."""
    def shape(s: Column) -> Column:
        mixed = (F.char_length(s) >= 16) & s.rlike(r"^[0-9A-Za-z_-]*[0-9][0-9A-Za-z_-]*$") & s.rlike("[A-Za-z]")
        return F.when(mixed, "{id}").otherwise(F.regexp_replace(s, "[0-9]+", "{n}"))

    parts = F.transform(F.split(F.regexp_replace(path, "^/", ""), "/", -1), shape)
    deep = F.array_join(F.slice(parts, max_depth + 1, F.greatest(F.size(parts) - max_depth, F.lit(0))), "/")
    return F.when(F.size(parts) > max_depth, F.concat(F.slice(parts, 1, max_depth), F.array(deep))).otherwise(parts)


def template_tree(counted: DataFrame, depth: int, min_labels: int = MIN_LABELS, z: float = Z) -> DataFrame:
    """``host, shape, template`` and the counts. ``counted``: staged ``host, shape,
    n, labels, bad`` with one row per host and shape."""
    tree = counted.withColumn("template", F.lit(""))
    for level in range(1, depth + 1):
        here = tree.withColumn("branch", F.get("shape", F.lit(level - 1)))
        branches = here.where("branch is not null").groupBy("host", "template", "branch").agg(
            F.sum("n").alias("n"), F.sum("labels").alias("l"), F.sum("bad").alias("b"))
        pooled = branches.groupBy("host", "template").agg(F.try_divide(F.sum("b"), F.sum("l")).alias("p"))
        merged = branches.join(pooled, ["host", "template"]).where(
            (F.col("l") >= min_labels)
            & (F.abs(F.col("b") - F.col("l") * F.col("p")) <= z * F.sqrt(F.col("l") * F.col("p") * (1 - F.col("p"))) + 0.5))
        merged = merged.select("host", "template", "branch")
        merged = merged.unionByName(_alike(here, branches.where((F.col("l") < min_labels) & (F.col("n") >= min_labels)), merged, level)).withColumn("wild", F.lit("*"))
        tree = here.join(merged, ["host", "template", "branch"], "left").withColumn(
            "template", F.when(F.col("branch").isNull(), F.col("template"))
            .otherwise(F.concat("template", F.lit("/"), F.coalesce("wild", "branch")))).drop("branch", "wild")
        if level % 2 == 0:  # keeps the plan short
            tree = stage(tree, "url-tree")
    return tree


def _alike(here: DataFrame, few: DataFrame, merged: DataFrame, level: int) -> DataFrame:
    """Branches of ``few`` at least half of whose URLs go on below ``level`` as some
    URL of a ``merged`` sibling does."""
    keys = ["host", "template", "branch"]
    below = here.where("branch is not null").select(*keys, "n", F.slice("shape", level + 1, F.size("shape")).alias("below"))
    seen = below.join(merged, keys, "left_semi").select("host", "template", "below").distinct().withColumn("seen", F.lit(True))
    found = below.join(few, keys, "left_semi").join(seen, ["host", "template", "below"], "left")
    return (found.groupBy(*keys).agg(F.sum("n").alias("all"), F.sum(F.when(F.col("seen"), F.col("n")).otherwise(0)).alias("known"))
            .where(2 * F.col("known") >= F.col("all")).select(*keys))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
          max_depth: int = MAX_DEPTH, min_purity: float = MIN_PURITY, strength: float = STRENGTH) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of every page."""
    host, path = split_url(F.col("url"))
    urls = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
            .select("page_id", host.alias("host"), path.alias("path"))
            .withColumns({"fit": rule_of(F.col("host"), F.col("path"), rules), "shape": shapes(F.col("path"), max_depth)}))
    counted = stage(urls.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count("fit").alias("labels"),
        F.count_if(F.col("fit.verdict") == "block").alias("bad")), "url-shapes")
    total = counted.agg(F.sum("labels").alias("l"), F.sum("bad").alias("b"), F.max(F.size("shape")).alias("d")).first()
    good = (total["l"] - total["b"] + 1) / (total["l"] + 2) if total["l"] is not None else 0.5
    tree = template_tree(counted, total["d"] or 0)
    purity = (F.sum("labels") - F.sum("bad") + F.lit(strength * good)) / (F.sum("labels") + F.lit(strength))
    pure = tree.groupBy("host", "template").agg(purity.alias("purity"))
    known = small_side(tree.select("host", "shape", "template").join(pure, ["host", "template"]), "url-templates")
    learned = F.when(F.col("purity") < min_purity, "block").otherwise("allow")
    return urls.join(known, ["host", "shape"]).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", learned).alias("verdict"),
        "template", "purity")
