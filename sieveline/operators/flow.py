"""Checks of flows before and after a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Findings from the worst to the best.
SEVERITY = ["BLOCKER", "WARNING", "SKIPPED", "OK"]


def baseline_compare(before: DataFrame, after: DataFrame, drop_pct: float = 30.0) -> DataFrame:
    """(path, outcome) of outputs (path, readable, n_rows, schema_digest, fingerprint, write_confirmed) before and after.

    created, missing, unreadable, empty, schema_changed, identical (unless a write was confirmed: rewritten), dropped
    (more than ``drop_pct`` of the rows) or updated.
    """
    b = before.select("path", *[F.col(c).alias(f"b_{c}") for c in ("readable", "n_rows", "schema_digest", "fingerprint")])
    a = after.select("path", "write_confirmed", *[F.col(c).alias(f"a_{c}") for c in ("readable", "n_rows", "schema_digest", "fingerprint")])
    both = b.join(a, "path", "full_outer")
    same = F.col("b_fingerprint").eqNullSafe(F.col("a_fingerprint")) & (F.col("b_n_rows") == F.col("a_n_rows"))
    outcome = (
        F.when(F.col("a_readable").isNull(), "missing").when(~F.col("a_readable"), "unreadable").when(F.col("a_n_rows") == 0, "empty")
        .when(F.col("b_readable").isNull() | ~F.col("b_readable"), "created").when(F.col("b_schema_digest") != F.col("a_schema_digest"), "schema_changed")
        .when(same, F.when(F.coalesce("write_confirmed", F.lit(False)), "rewritten").otherwise("identical"))
        .when(F.col("a_n_rows") < F.col("b_n_rows") * (1 - drop_pct / 100), "dropped").otherwise("updated")
    )
    return both.select("path", outcome.alias("outcome"))


def copy_reconcile(copies: DataFrame) -> DataFrame:
    """(activity, outcome) of copies (activity, rows_read, rows_copied, n_rows): BALANCED, LOST, GAINED, UNKNOWN."""
    r, c, n = (F.col(x) for x in ("rows_read", "rows_copied", "n_rows"))
    outcome = F.when(r.isNull() | c.isNull(), "UNKNOWN").when((c < r) | (n < c), "LOST").when((c > r) | (n > c), "GAINED").otherwise("BALANCED")
    return copies.select("activity", outcome.alias("outcome"))


def input_check(inputs: DataFrame) -> DataFrame:
    """(path, severity, reason): an input has to exist, be readable and have rows; unreadable isn't absent."""
    reason = F.when(~F.col("exists"), "absent").when(~F.col("readable"), "unreadable").when(F.col("n_rows") == 0, "empty").otherwise("ok")
    return inputs.select("path", F.when(reason == "ok", "OK").when(reason == "unreadable", "SKIPPED").when(reason == "empty", "WARNING").otherwise("BLOCKER").alias("severity"), reason.alias("reason"))


def output_check(outputs: DataFrame, margin_s: int = 60) -> DataFrame:
    """(path, outcome): WRITTEN, EMPTY, ABSENT or BEFORE_RUN by the last write (written_at) and the run's start."""
    early = F.col("written_at") < F.col("run_start") - F.expr(f"INTERVAL {int(margin_s)} SECONDS")
    outcome = F.when(F.col("written_at").isNull(), "ABSENT").when(early, "BEFORE_RUN").when(F.coalesce("n_rows", F.lit(-1)) == 0, "EMPTY").otherwise("WRITTEN")
    return outputs.select("path", outcome.alias("outcome"))


def transformation_review(pairs: DataFrame) -> DataFrame:
    """(flow, outcome, delta, pct_kept, kept, dropped, derived) from (flow, n_in, n_out, columns_in, columns_out)."""
    i, o = F.col("n_in"), F.col("n_out")
    outcome = F.when(i.isNull() | o.isNull(), "NOT_MEASURABLE").when(o == 0, "EMPTY_OUTPUT").when(o == i, "SAME_COUNT").when(o < i, "SMALLER_OUTPUT").otherwise("LARGER_OUTPUT")
    names = lambda c: F.concat_ws(",", F.array_sort(c))
    return pairs.select(
        "flow", outcome.alias("outcome"), (o - i).alias("delta"), F.when(i > 0, F.round(100.0 * o / i, 4)).alias("pct_kept"),
        names(F.array_intersect("columns_in", "columns_out")).alias("kept"), names(F.array_except("columns_in", "columns_out")).alias("dropped"),
        names(F.array_except("columns_out", "columns_in")).alias("derived"),
    )


def worst_of(findings: DataFrame) -> DataFrame:
    """(flow, worst, verdict) from findings (flow, severity): FAILS, PASSES_WITH_WARNINGS, PASSES_WITH_OMISSIONS or PASSES."""
    place = F.array_position(F.array(*[F.lit(s) for s in SEVERITY]), F.col("severity"))
    out = findings.groupBy("flow").agg(F.element_at(F.array(*[F.lit(s) for s in SEVERITY]), F.min(place).cast("int")).alias("worst"))
    verdict = F.when(F.col("worst") == "BLOCKER", "FAILS").when(F.col("worst") == "WARNING", "PASSES_WITH_WARNINGS").when(F.col("worst") == "SKIPPED", "PASSES_WITH_OMISSIONS").otherwise("PASSES")
    return out.select("flow", "worst", verdict.alias("verdict"))


# What in a path shows that it is known at run time only.
UNRESOLVED = {
    "expression": r"@\{|@[a-zA-Z]+\(", "variable": r"\$\{[^}]*\}|\$\([^)]*\)", "template": r"\{\{[^}]*\}\}", "placeholder": r"<[A-Za-z_][^>]*>", "hole": r"\?\?",
}


def unresolved_paths(paths: DataFrame) -> DataFrame:
    """(path, traces): the kinds of unresolved parts, comma-separated, of the paths that have any."""
    traces = F.filter(F.array(*[F.when(F.col("path").rlike(p), F.lit(k)) for k, p in sorted(UNRESOLVED.items())]), lambda x: x.isNotNull())
    return paths.select("path", F.concat_ws(",", traces).alias("traces")).where("traces <> ''")


def preflight(flows: DataFrame) -> DataFrame:
    """(flow, P1..P5, verdict) from (flow, environment, entry_point, paths array, outputs, expected_environment).

    P1 the environment is known, P2 there is an entry point, P3 every path is resolved, P4 no path belongs to another
    environment, P5 outputs are declared. P1, P2 and P4 block; the others warn.
    """
    unresolved = F.exists("paths", lambda p: p.rlike("|".join(UNRESOLVED.values())))
    foreign = F.exists("paths", lambda p: p.rlike(r"(^|[/_-])(dev|qa|prod)([/_-]|\z)") & (F.regexp_extract(p, r"(?:^|[/_-])(dev|qa|prod)(?:[/_-]|\z)", 1) != F.col("expected_environment")))
    tests = {"P1": F.col("environment").eqNullSafe(F.col("expected_environment")), "P2": F.coalesce(F.col("entry_point") != "", F.lit(False)), "P3": ~unresolved, "P4": ~foreign, "P5": F.coalesce(F.col("outputs") > 0, F.lit(False))}
    out = flows.select("flow", *[F.coalesce(t, F.lit(False)).alias(k) for k, t in tests.items()])
    blocked = ~(F.col("P1") & F.col("P2") & F.col("P4"))
    return out.withColumn("verdict", F.when(blocked, "BLOCKER").when(~(F.col("P3") & F.col("P5")), "WARNING").otherwise("OK"))


def cp05(tables: DataFrame) -> DataFrame:
    """(table_name, state) of the run-window control from (table_name, has_window, has_log, n_commits)."""
    state = F.when(~F.col("has_window"), "NOT_EVALUATED").when(~F.col("has_log"), "NOT_APPLICABLE").when(F.col("n_commits") > 0, "OK").otherwise("ERROR")
    return tables.select("table_name", state.alias("state"))


def flow_checks(runs: DataFrame) -> DataFrame:
    """(flow, check, word) of a run's evidence, long: run completed, activities, copies, commits, windows, versions."""
    ok = lambda c: F.when(c.isNull(), "not_evaluated").when(c, "ok").otherwise("fails")
    tests = {
        "run_completed": F.col("run_state") == "Completed", "activities_succeeded": F.col("failed_activities") == 0,
        "copies_balanced": F.col("rows_read") == F.col("rows_copied"), "outputs_have_rows": F.col("output_rows") > 0,
        "output_committed_in_window": (F.col("commit_ts") >= F.col("start")) & (F.col("commit_ts") <= F.col("end")),
        "input_unchanged_after_start": F.col("input_commit_ts") <= F.col("start"), "measured_version_written": F.col("measured_version") == F.col("written_version"),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("check"), ok(t).alias("word")) for k, t in tests.items()])
    return runs.select("flow", F.explode(rows).alias("x")).select("flow", "x.*")


def layer(path: Column) -> Column:
    """The medallion layer that a path names, as its own segment or a word of one; else unknown."""
    found = F.regexp_extract(F.lower(path), r"(?:^|[/_.-])(bronze|silver|gold|landing|raw|staging)(?:[/_.-]|\z)", 1)
    return F.when(found == "", "unknown").otherwise(found)


def masked(text: Column) -> Column:
    """Identity numbers (001d and six digits) and quoted free text of ten or more characters, masked."""
    text = F.regexp_replace(text, r"\b(001\d)\d{6}\b", "$1******")
    return F.regexp_replace(text, r"\"[^\"]{10,}\"", "\"***\"")
