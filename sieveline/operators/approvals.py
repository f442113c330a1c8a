"""Approvals bound to content, and figures bound to what is on disk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gates(order: DataFrame, decisions: DataFrame, current: DataFrame) -> DataFrame:
    """(flow, place, gate, decision, by, unchanged, valid) of the ordered gates (flow, place, gate, subject) of flows.

    ``decisions`` is a ledger that is only appended to (seq, flow, gate, decision, by, fingerprint): the last one of a gate counts.
    ``current`` has the fingerprint of each subject (subject, fingerprint) as it is now. A gate is valid if it was approved for
    the content that its subject still has, and all gates before it are: the conjunction runs along the order.
    """
    last = decisions.groupBy("flow", "gate").agg(F.max_by(F.struct("decision", "by", "fingerprint"), "seq").alias("d"))
    rows = order.join(last, ["flow", "gate"], "left").join(current.withColumnRenamed("fingerprint", "now"), "subject", "left")
    unchanged = F.coalesce(F.col("d.fingerprint") == F.col("now"), F.lit(False))
    holds = F.coalesce(F.col("d.decision") == "APPROVED", F.lit(False)) & unchanged
    so_far = Window.partitionBy("flow").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("flow", "place", "gate", F.col("d.decision").alias("decision"), F.col("d.by").alias("by"), unchanged.alias("unchanged"), F.every(holds).over(so_far).alias("valid"))


def _told(*tests: tuple[Column, str]) -> Column:
    """The texts of the tests that hold, in their order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(text)) for t, text in tests]))


def difference_registry(entries: DataFrame, most_examples: int = 5) -> DataFrame:
    """(difference, revisions, first_decision, decision, issues) of a registry that is only appended to.

    ``entries`` (seq, difference, decision, cause, measured, n_examples): the last of a difference counts, none goes. Issues, comma-separated:
    ``unmeasured`` where a justified difference lacks a cause that was measured, ``examples`` where more than ``most_examples`` are kept,
    ``reopened`` where a decision was taken back.
    """
    row = F.struct("decision", "cause", "measured", "n_examples")
    per = entries.groupBy("difference").agg(F.count(F.lit(1)).alias("revisions"), F.min_by("decision", "seq").alias("first_decision"), F.max_by(row, "seq").alias("x"), F.count_if(F.col("decision") == "JUSTIFIED").alias("justified"))
    justified = F.col("x.decision") == "JUSTIFIED"
    grounded = (F.coalesce(F.col("x.cause"), F.lit("")) != "") & F.coalesce(F.col("x.measured"), F.lit(False))
    issues = _told((justified & ~grounded, "unmeasured"), (F.col("x.n_examples") > most_examples, "examples"), (~F.coalesce(justified, F.lit(False)) & (F.col("justified") > 0), "reopened"))
    return per.select("difference", "revisions", "first_decision", F.col("x.decision").alias("decision"), F.concat_ws(",", issues).alias("issues"))


#: Results of comparing a rule in both codes, and the classes of what differs.
RULE_RESULTS, RULE_CLASSES = ("SAME", "EQUIVALENT", "DIFFERENT", "ONLY_SOURCE", "ONLY_TARGET"), ("PLATFORM", "ORIGIN", "LOGIC")


def rule_gaps(rules: DataFrame) -> DataFrame:
    """(rule, gaps) of compared code rules (rule, result, class, why, measured, open_points): why one can't be registered, comma-separated.

    What isn't the same needs a class (an equivalent rule's is the platform), a reason and figures; a difference of the platform
    alone is an equivalent rule; and an equivalent rule leaves nothing unmeasured.
    """
    result, differs = F.col("result"), F.col("result") != "SAME"
    known = result.isin(*RULE_RESULTS)
    lacks = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    equal = result == "EQUIVALENT"
    gaps = _told(
        (~F.coalesce(known, F.lit(False)), "unknown_result"), (known & differs & ~equal & ~F.coalesce(F.col("class").isin(*RULE_CLASSES), F.lit(False)), "class"), (known & differs & ~equal & (F.col("class") == "PLATFORM"), "platform_is_equivalent"),
        (known & differs & lacks("why"), "why"), (known & differs & lacks("measured"), "measured"), (equal & ~lacks("open_points"), "open_points"),
    )
    return rules.select("rule", F.concat_ws(",", gaps).alias("gaps"))


def missing_fields(reports: DataFrame, required: Sequence[str]) -> DataFrame:
    """(report, pointer) of the required fields that a JSON report (report, document) lacks or holds empty: what keeps it from being published."""
    empty = lambda c: F.col("v").isNull() | c.isNull() | c.isin("", "[]", "{}")
    gaps = F.array(*[F.when(empty(F.try_variant_get(F.col("v"), f"$.{p}", "string")), F.lit(p)) for p in required])
    return reports.select("report", F.try_parse_json("document").alias("v")).select("report", F.explode(F.array_compact(gaps)).alias("pointer"))


def cited_figures(reports: DataFrame, pointers: Sequence[str], cited: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """(report, pointer, cited, found, state) of the figures that texts cite from JSON reports (report, document).

    ``pointers`` like ``a.b[0].c`` are resolved in the reports' documents as variants, all of them in one pass; ``cited`` (report, pointer,
    cited as text) is what texts say stands there. State: MATCHES, FALSIFIED, or MISSING where the report has nothing at the pointer. Numbers
    compare as numbers, within ``tolerance``.
    """
    document = F.parse_json("document")
    rows = F.array(*[F.struct(F.lit(p).alias("pointer"), F.try_variant_get(F.col("v"), f"$.{p}", "string").alias("found")) for p in pointers])
    found = reports.select("report", document.alias("v")).select("report", F.explode(rows).alias("x")).select("report", "x.*")
    number = lambda c: F.col(c).try_cast("decimal(38,10)")
    near: Column = F.coalesce(F.abs(number("cited") - number("found")) <= tolerance, F.col("cited") == F.col("found"))
    state = F.when(F.col("found").isNull(), "MISSING").when(near, "MATCHES").otherwise("FALSIFIED")
    return cited.join(found, ["report", "pointer"], "left").select("report", "pointer", "cited", "found", state.alias("state"))
