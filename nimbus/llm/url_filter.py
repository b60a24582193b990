"""URL filter: a tree of path templates per host, rejected by smoothed labelled purity; rules come first.

Hand-written rules (host and path prefix, allow or block) decide the urls they fit; the longest rule wins. The urls they
decide, and any labelled urls given, are the labels from which the tree learns about all others.

The tree: a path is its segments; digits inside a segment stand for their class, so most numbers and dates fall together
at once. Urls are first folded to (host, shape) with counts; then, level by level, a segment stays a literal
branch if it holds at least ``LEAST`` urls and its labelled rate differs from its siblings' (two-proportion test, ``Z``),
however small its share. Other labelled segments, the variable ones and the branches that are statistically alike, merge into
the wildcard ``*``; segments without labels beside labelled ones merge into ``?`` (no sign of a path), so that they don't
take the others' labels. Segments from ``DEPTH`` on are one ``**``.

A url's purity is the rate of blocked labels in its template, smoothed by ``WEIGHT`` pseudo-labels of the rate that its
shape has on all hosts, which is smoothed by the rate of all labels: a template without labels follows its shapes.
Urls of ``REJECT`` or more are blocked.

Everything is counted and joined in DataFrames; hosts that hold a third of all urls are aggregated before any join.

Defined results: a null url or one without ``://`` has empty host and path, no rule and the verdict of the empty template;
repeated rows are judged each; a null id stays null; extra columns are kept by ``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import cut, work_folder

LEAST, Z = 20, 2.58
DEPTH = 6
WEIGHT, REJECT = 5.0, 0.5

#: (host, path, verdict) of the registered query
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_columns(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits columns ``host`` and ``path``; null if none does."""
    rule = verdict = None
    for host, path, what in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (rule, verdict) if rule is not None else (none, none)


def segments() -> Column:
    """Shapes of the path's segments: runs of digits as ``0``, what follows the last ``.`` kept."""
    shape = F.regexp_replace(F.regexp_replace("path", r"\d+", "0"), r"[0-9a-fA-F]{16,}", "0")
    return F.split(F.regexp_replace(shape, r"^/", ""), "/")


def tree(shapes: DataFrame, root: str) -> DataFrame:
    """``host, shape, template`` of each shape; ``shapes``: ``host, shape`` (array), ``n, labels, bad``, one row each."""
    now = shapes.withColumn("template", F.array().cast("array<string>"))
    for level in range(DEPTH):
        # one row a shape: a bounded piece of work per distinct path shape, whatever the number of urls
        part = F.when(F.size("shape") > level, F.get("shape", F.lit(level)))
        now = now.withColumn("part", part)
        sums = [F.sum(c).alias(c) for c in ("n", "labels", "bad")]
        branch = now.filter("part IS NOT NULL").groupBy("host", "template", "part").agg(*sums)
        parent = branch.groupBy("host", "template").agg(*[F.sum(c).alias(f"{c}_") for c in ("n", "labels", "bad")])
        pooled = F.expr("bad_ / labels_")
        differs = F.expr("labels > 0 AND labels_ > labels AND bad_ > 0 AND bad_ < labels_") & (
            F.abs(F.expr("bad / labels") - F.expr("(bad_ - bad) / (labels_ - labels)"))
            > Z * F.sqrt(pooled * (1 - pooled) * F.expr("1 / labels + 1 / (labels_ - labels)")))
        own = F.when((F.col("n") >= LEAST) & differs, F.col("part")).when(F.expr("labels = 0 AND labels_ > 0"), F.lit("?"))
        kept = (branch.join(parent, ["host", "template"])
                .select("host", "template", "part", own.alias("own")).filter("own IS NOT NULL"))
        more = F.when(F.col("part").isNull(), F.array().cast("array<string>")).otherwise(F.array(F.coalesce("own", F.lit("*"))))
        now = now.join(kept, ["host", "template", "part"], "left").withColumn("template", F.concat("template", more)).drop("part", "own")
        now = cut(now, root, f"level-{level}")
    tail = F.when(F.size("shape") > DEPTH, F.array(F.lit("**"))).otherwise(F.array().cast("array<string>"))
    return now.withColumn("template", F.concat(F.lit("/"), F.array_join(F.concat("template", tail), "/")))


def judge(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """``pages`` (with ``url``) and ``host, path, rule, template, purity, verdict``.

    ``labelled``: more labels, ``url, bad`` (0 or 1).
    """
    root = work_folder(pages.sparkSession, "urls")
    own = [c for c in ("host", "path", "rule", "template", "purity", "verdict") if c in pages.columns]
    pages = pages.drop(*own)

    def parsed(df: DataFrame) -> DataFrame:
        url = F.coalesce(F.col("url").cast("string"), F.lit(""))
        df = df.withColumn("host", host_of(url)).withColumn("path", path_of(url))
        return df.withColumn("shape_", segments())

    rule, verdict = rule_columns(rules)
    pages = parsed(pages).withColumn("rule", rule).withColumn("by_rule", verdict)
    label = F.when(F.col("by_rule").isNotNull(), (F.col("by_rule") == "block").cast("int"))
    rows = pages.select("host", "shape_", label.alias("bad_"))
    if labelled is not None:
        rows = rows.unionByName(parsed(labelled).select("host", "shape_", F.col("bad").cast("int").alias("bad_")))
    shapes = rows.groupBy("host", F.col("shape_").alias("shape")).agg(
        F.count("*").alias("n"), F.count("bad_").alias("labels"), F.coalesce(F.sum("bad_"), F.lit(0)).alias("bad"))
    leaves = cut(tree(cut(shapes, root, "shapes"), root), root, "leaves")

    every = leaves.agg(((F.sum("bad") + 1) / (F.sum("labels") + 2))).first()[0]
    every = 0.5 if every is None else every
    # the same shape on all hosts, whichever branches a host's tree has merged
    by_shape = (leaves.groupBy("shape").agg(F.sum("labels").alias("l"), F.sum("bad").alias("b"))
                .select("shape", ((F.col("b") + WEIGHT * every) / (F.col("l") + WEIGHT)).alias("prior")))
    of_template = leaves.groupBy("host", "template").agg(F.sum("labels").alias("l"), F.sum("bad").alias("b"))
    purity = (F.col("b") + WEIGHT * F.col("prior")) / (F.col("l") + WEIGHT)
    verdicts = cut(leaves.select("host", "shape", "template").join(of_template, ["host", "template"]).join(by_shape, "shape")
                   .select("host", F.col("shape").alias("shape_"), "template", purity.alias("purity")), root, "verdicts")
    found = pages.join(verdicts, ["host", "shape_"], "left")
    learned = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return found.withColumn("verdict", F.coalesce("by_rule", learned)).drop("by_rule", "shape_")
