"""Merged QA reports: audits from several sources to action items, fix plans and gates per page."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Viewports audited, share of differing pixels that counts as critical.
VIEWPORTS = ("desktop", "tablet", "mobile")
DIFF_LIMIT = 10.0
# Check to (fix action, scope of one call).
FIX_ACTIONS = {
    "img-alt": ("add-alt-text", "page"), "contrast": ("fix-contrast", "page"), "meta-desc-missing": ("generate-meta", "page"), "title-missing": ("generate-meta", "page"),
    "title-length": ("generate-meta", "page"), "og-title": ("generate-meta", "page"), "og-description": ("generate-meta", "page"), "g06": ("patch-style", "element"),
    "g11": ("patch-style", "element"), "g13": ("patch-style", "element"), "g12": ("patch-image", "element"), "g05": ("bind-class", "element"),
}


def page_http_checks(observations: DataFrame) -> DataFrame:
    """Pages where a viewport fails one of its checks: `observations` (page_id, viewport, name, ok)."""
    per_view = observations.groupBy("page_id", "viewport").agg(F.count("*").alias("checks"), F.count(F.when(~F.col("ok"), 1)).alias("failed"))
    return per_view.withColumn("passed", F.col("failed") == 0)


def visual_diff_gate(diffs: DataFrame, limit: float = DIFF_LIMIT) -> DataFrame:
    """Largest difference per page over its viewports: `diffs` (page_id, viewport, diff_pct)."""
    g = diffs.groupBy("page_id").agg(F.max("diff_pct").alias("max_diff"), F.count("*").alias("viewports"))
    return g.withColumn("severity", F.when(F.col("max_diff") >= limit, "critical").otherwise("ok"))


def a11y_rollup(findings: DataFrame) -> DataFrame:
    """Findings (page_id, viewport, check_id, severity, amount) summed over viewports, each violation counted once per page."""
    per = findings.groupBy("page_id", "check_id", "severity").agg(F.sum("amount").alias("amount"), F.count("*").alias("viewports"))
    return per.groupBy("page_id").agg(
        F.count("*").alias("violations"), F.sum(F.when(F.col("severity") == "fail", F.col("viewports")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("severity") != "fail", F.col("viewports")).otherwise(0)).alias("warns"), F.min("check_id").alias("first_violation"))


def action_items(issues: DataFrame, contrast: DataFrame, http: DataFrame, visual: DataFrame) -> DataFrame:
    """One list of (page_id, source, check_id, priority) from five audits; 1 is most urgent.

    `issues` holds the SEO and accessibility audits together, so the pages are read once for both.
    """
    def rows(df, source, check, priority):
        return df.select("page_id", F.lit(source).alias("source"), check.alias("check_id"), priority.alias("priority"))

    by_sev = F.when(F.col("severity") == "fail", 2).otherwise(3)
    return (
        issues.select("page_id", "source", "check_id", by_sev.alias("priority"))
        .unionByName(rows(contrast, "contrast", F.lit("contrast"), F.when(F.col("verdict") == "FAIL", 2).otherwise(3)))
        .unionByName(rows(http.filter("not passed"), "http", F.concat(F.lit("http-"), "viewport"), F.lit(1)))
        .unionByName(rows(visual.filter("severity = 'critical'"), "visual", F.lit("visual-diff"), F.lit(1)))
    )


def qa_report(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Items per page and source with the overall status from the most urgent one."""
    g = items.groupBy("page_id").agg(
        F.count("*").alias("items"), F.min("priority").alias("top_priority"),
        *[F.count(F.when(F.col("source") == s, 1)).alias(s) for s in ("seo", "a11y", "contrast", "http", "visual")])
    j = pages.select("page_id").join(g, "page_id", "left").fillna(0, ["items", "seo", "a11y", "contrast", "http", "visual"])
    p = F.col("top_priority")
    return j.withColumn("status", F.when(p == 1, "critical").when(p == 2, "needs-work").when(p == 3, "minor").otherwise("passed"))


def autofix_plan(issues: DataFrame) -> DataFrame:
    """Issues (page_id, node_ix, check_id) to fix calls: one per page or one per element, the first issue naming it."""
    action, scope = F.lit(None).cast("string"), F.lit(None).cast("string")
    for check, (a, s) in FIX_ACTIONS.items():
        action = F.when(F.col("check_id") == check, a).otherwise(action)
        scope = F.when(F.col("check_id") == check, s).otherwise(scope)
    i = issues.withColumn("action", action).withColumn("scope", scope).filter("action is not null")
    target = F.when(F.col("scope") == "element", F.col("node_ix"))
    return i.groupBy("page_id", "action", "scope", target.alias("node_ix")).agg(F.count("*").alias("issues"), F.min("check_id").alias("first_check"))


def gate_report(items: DataFrame, pages: DataFrame) -> DataFrame:
    """PASS, WARNINGS or BLOCKED per page from the steps' worst results."""
    g = items.groupBy("page_id").agg(
        F.countDistinct(F.when(F.col("priority") == 1, F.col("source"))).alias("failed_steps"), F.countDistinct(F.when(F.col("priority") > 1, F.col("source"))).alias("warned_steps"))
    j = pages.select("page_id").join(g, "page_id", "left").fillna(0)
    return j.withColumn("gate", F.when(F.col("failed_steps") > 0, "BLOCKED").when(F.col("warned_steps") > 0, "WARNINGS").otherwise("PASS"))
