"""URL filter: rules by host and path, and a tree of path templates for the pages that no rule fits.

The rules' verdicts are the labels.  Per host, paths grow a tree level by level:

* a segment's digits become ``<n>`` and long hexadecimal names ``<h>``, so most variable segments are one branch before anything is shuffled;
* of a node with more than ``most_branches`` branches, those with less than ``rare`` of its pages become the wildcard ``*``; so a node has
  1 / ``rare`` + ``most_branches`` branches at most, however many pages its host has;
* sibling branches are merged where their pages end, go on with a fixed or with a variable segment in like shares, and where their labelled shares are
  alike, all within Hoeffding's bound at ``alpha``.  The most frequent branch is looked at first and each joins the first group that it is like.

A template is blocked if its smoothed share of blocked labels, (blocked + ``prior_rows`` x share of all pages) / (labelled + ``prior_rows``), is at least
``purity`` and at least ``labelled_share`` of its pages are labelled.  Pages with like paths are one row of the tree, so a hot host or path costs little more than
its distinct templates; segments behind ``levels`` are one ``<deep>`` segment.

Edges: a null url or one without ``://`` has an empty host and path, fits no rule and has the template ``/`` of the empty host; repeated rows and page_ids are
judged alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.llm.common import discard, table, written
from ionloom.llm.spelling import LOWER, UPPER

#: host, start of the path, verdict
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
WILD, DEEP = "*", "<deep>"
#: Counts of a branch: pages, labelled, blocked; pages that end here, and that go on with a variable segment.
COUNTS = ["n", "labelled", "blocked", "ending", "variable"]


@dataclass(frozen=True)
class TemplateParams:
    levels: int = 8
    most_branches: int = 32
    rare: float = 0.01
    alpha: float = 0.05
    prior_rows: float = 8.0
    purity: float = 0.8
    labelled_share: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else nulls; the rules stand in the plan, so they are meant to be few."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def segments(path: Column, levels: int) -> Column:
    """The path's non-empty segments with variable parts as ``<n>`` or ``<h>``; those behind ``levels`` are one."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    kind = lambda s: F.when(s.rlike("^(?=.*[0-9])[0-9a-fA-F-]{8,}$") & ~s.rlike("^[0-9-]+$"), "<h>").otherwise(F.regexp_replace(s, "[0-9]+", "<n>"))
    return F.when(F.size(parts) > levels, F.concat(F.transform(F.slice(parts, 1, levels - 1), kind), F.array(F.lit(DEEP)))).otherwise(F.transform(parts, kind))


def alike(a: dict, b: dict, alpha: float) -> bool:
    """Whether two branches differ by chance only in where their pages go on and in their labels."""

    def near(x: str, of: str) -> bool:
        if not a[of] or not b[of]:
            return True
        return abs(a[x] / a[of] - b[x] / b[of]) <= math.sqrt(math.log(2 / alpha) / 2) * (a[of] ** -0.5 + b[of] ** -0.5)

    return near("ending", "n") and near("variable", "n") and near("blocked", "labelled")


def merged(branches: list[dict], alpha: float) -> list[tuple[str, str]]:
    """Each branch's label with the label of its group, the most frequent one of it; ties by label."""
    groups, out = [], []
    for b in sorted(branches, key=lambda b: (-b["n"], b["label"])):
        group = next((g for g in groups if alike(g, b, alpha)), None)
        if group is None:
            groups.append(group := dict(b))
        else:
            for c in COUNTS:
                group[c] += b[c]
        out.append((b["label"], group["label"]))
    return out


def template_tree(paths: DataFrame, p: TemplateParams) -> DataFrame:
    """host, segs, n, labelled, blocked and node (its template) of each row (host, segs, n, labelled, blocked)."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, node, *x) for h, node, b in zip(*(batch.column(c).to_pylist() for c in ("host", "node", "branches")), strict=True) for x in merged(b, p.alpha)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(4)], ["host", "node", "label", "kept"])

    rows = written(paths.withColumn("node", F.lit("")), "url-paths")
    depth = rows.agg(F.max(F.size("segs"))).first()[0] or 0  # at most ``levels``
    for level in range(depth):
        here, onward = F.get("segs", F.lit(level)), F.get("segs", F.lit(level + 1))
        kids = rows.where(F.size("segs") > level).groupBy("host", "node", here.alias("seg")).agg(
            *(F.sum(c).alias(c) for c in COUNTS[:3]), F.sum(F.when(onward.isNull(), F.col("n")).otherwise(0)).alias("ending"), F.sum(F.when(F.contains(onward, F.lit("<")), F.col("n")).otherwise(0)).alias("variable")
        )
        kids = written(kids, "url-branches")
        sums = kids.groupBy("host", "node").agg(F.count(F.lit(1)).alias("branches"), F.sum("n").alias("pages"))
        wild = (F.col("branches") > p.most_branches) & (F.col("n") < p.rare * F.col("pages"))
        named = kids.join(sums, ["host", "node"]).withColumn("label", F.when(wild, WILD).otherwise(F.col("seg")))
        pooled = named.groupBy("host", "node", "label").agg(*(F.sum(c).alias(c) for c in COUNTS))
        lists = pooled.groupBy("host", "node").agg(F.collect_list(F.struct("label", *COUNTS)).alias("branches"))  # bounded: see above
        kept = lists.mapInArrow(merge, "host string, node string, label string, kept string")
        names = named.join(kept, ["host", "node", "label"]).select("host", "node", "seg", F.concat("node", F.lit("/"), "kept").alias("below"))
        down = rows.withColumn("seg", here).join(names, ["host", "node", "seg"], "left")
        down = written(down.select("host", "segs", *COUNTS[:3], F.coalesce("below", "node").alias("node")), "url-paths")
        discard(rows, kids)
        rows = down
    return rows


def judged(pages: DataFrame, rules: tuple = RULES, p: TemplateParams = TemplateParams()) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity of every page; template and purity are null where a rule fits."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, by_rule = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "by_rule": by_rule}).withColumn("segs", segments(F.col("path"), p.levels))
    paths = rows.groupBy("host", "segs").agg(F.count(F.lit(1)).alias("n"), F.count("by_rule").alias("labelled"), F.count_if(F.col("by_rule") == "block").alias("blocked"))
    tree = template_tree(paths, p)
    seen = tree.agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")).first()
    prior = seen.blocked / seen.labelled if seen.labelled else 0.0
    sums = tree.groupBy("host", "node").agg(*(F.sum(c).alias(c) for c in COUNTS[:3]))
    purity = (F.col("blocked") + p.prior_rows * prior) / (F.col("labelled") + p.prior_rows)
    bad = (purity >= p.purity) & (F.col("labelled") > 0) & (F.col("labelled") >= p.labelled_share * F.col("n"))
    verdicts = tree.select("host", "segs", "node").join(sums.select("host", "node", purity.alias("purity"), bad.alias("bad")), ["host", "node"])
    out = rows.join(verdicts, ["host", "segs"], "left")
    verdict = F.coalesce("by_rule", F.when(F.col("bad"), "block").otherwise("allow"))
    free = F.col("rule").isNull()
    template = F.when(free, F.when(F.col("node") == "", "/").otherwise(F.col("node")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), template.alias("template"), F.when(free, F.col("purity")).alias("purity"))


def op11_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every page."""
    return judged(table(spark, sf_dir, "pages"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule and the rule's verdict, the part of the filter that SQL can check."""
    host, path = host_and_path(F.col("url"))
    rows = table(spark, sf_dir, "pages").select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


_FITS = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p} {v}'" for h, p, v in sorted(RULES, key=lambda r: -len(r[0] + r[1])))
RULES_ORACLE = f"""WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
  parts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h, rest FROM cut),
  named AS (SELECT page_id, translate(h, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM parts),
  fit AS (SELECT *, CASE {_FITS} END AS r FROM named)
SELECT page_id, host, path, split_part(r, ' ', 1) AS rule, split_part(r, ' ', 2) AS verdict FROM fit"""
