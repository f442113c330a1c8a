"""Checks of a flow's run against its measured evidence, and the flow's next step.

Evidence comes as tables with a row per run, activity, input, output and place in the orchestrator's chain; a check counts, per
flow, the rows it applies to and those that break it, in one aggregation per table.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions import scale

OK, FAILS, JUSTIFIED, UNKNOWN = "ok", "fails", "justified", "not_evaluated"


def _counted(df: DataFrame, tests: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """(flow, check, n_rows, n_bad) of the checks that have any row: name -> (what it applies to, what holds there)."""
    sums = []
    for i, (applies, holds) in enumerate(tests.values()):
        sums += [F.count_if(applies).alias(f"n{i}"), F.count_if(applies & ~F.coalesce(holds, F.lit(False))).alias(f"b{i}")]
    rows = F.array(*[F.struct(F.lit(k).alias("check"), F.col(f"n{i}").alias("n_rows"), F.col(f"b{i}").alias("n_bad")) for i, k in enumerate(tests)])
    return df.groupBy("flow").agg(*sums).select("flow", F.explode(rows).alias("x")).select("flow", "x.*").where("n_rows > 0")


def _word(bad: Column) -> Column:
    return F.when(bad, FAILS).otherwise(OK)


def tested_by(runs: DataFrame) -> DataFrame:
    """(flow, way): how the validator tested the run: executed, orchestrated, waived or not at all.

    Its report has to be later than the run's end. It ran that very run itself; or an orchestrator did and its static tests
    pass; or a person waived the run, which completed, and its static tests pass but for blockers marked as false.
    """
    later = F.coalesce(F.col("validator_ts") >= F.col("run_end"), F.lit(False))
    static = F.col("validator_ran").eqNullSafe(False)
    passes = F.coalesce(F.col("validator_passes"), F.lit(False))
    waived = F.coalesce(F.col("waiver"), F.lit(False)) & (F.col("run_state") == "Completed") & (passes | ((F.col("false_blockers") > 0) & (F.col("false_blockers") == F.col("blockers"))))
    way = (
        F.when(later & F.coalesce(F.col("validator_matches"), F.lit(False)) & ~static, "executed")
        .when(later & static & F.coalesce(F.col("orchestrated"), F.lit(False)) & passes, "orchestrated")
        .when(later & static & waived, "waived").otherwise("not_tested")
    )
    return runs.select("flow", way.alias("way"))


def run_checks(runs: DataFrame, activities: DataFrame, inputs: DataFrame, outputs: DataFrame, chain: DataFrame) -> DataFrame:
    """(flow, check, word, n_rows, n_bad): every check that applies to a flow.

    runs (flow, kind, run_state, run_end, validator_ts, validator_ran, validator_matches, validator_passes, orchestrated, waiver,
    blockers, false_blockers, orchestrator_state); activities (flow, activity, kind, state, rows_read, rows_copied, in_scope);
    inputs (flow, input, kind, version_read, producer_state, changed_after, files_after); outputs (flow, output, kind,
    committed, measured_version, written_versions, commits_after, files_in_run); chain (flow, place, own_place, state).
    """
    runs, activities, inputs, outputs, chain = scale.together("flow", runs, activities, inputs, outputs, chain)
    good, copy = F.col("state") == "Succeeded", F.col("kind") == "Copy"
    scope = F.coalesce(F.col("in_scope"), F.lit(False)) & copy
    of_activities = _counted(activities, {"activities_succeeded": (F.lit(True), good), "scope_succeeded": (scope, good), "copies_complete": (scope, F.col("rows_read") == F.col("rows_copied"))})
    ingest = runs.where("kind = 'ingest'").select("flow")
    loads = of_activities.where("check <> 'activities_succeeded'").join(ingest, "flow", "left_semi")
    delta = F.col("kind") == "delta"
    of_inputs = _counted(inputs, {
        "input_commits_found": (delta, F.col("version_read").isNotNull()),
        "producers_succeeded": (delta, F.coalesce(F.col("producer_state") == "Succeeded", F.lit(True))),
        "inputs_unchanged": (F.col("kind").isin("delta", "folder"), ~F.when(delta, F.coalesce("changed_after", F.lit(False))).otherwise(F.coalesce("files_after", F.lit(0)) > 0)),
    })
    of_outputs = _counted(outputs, {
        "outputs_committed": (delta, F.col("committed")),
        "measured_version_written": (delta, F.col("measured_version").isNull() | F.array_contains("written_versions", F.coalesce("measured_version", F.lit(-1)))),
        "outputs_not_rewritten": (delta, F.coalesce("commits_after", F.lit(0)) == 0),
        "folders_received_files": (F.col("kind") == "folder", F.col("files_in_run") > 0),
    })
    fine = good & (F.col("rows_copied").isNull() | (F.col("rows_copied") > 0))
    copies = activities.where(copy).groupBy("flow").agg(F.count(F.lit(1)).alias("copies"), F.count_if(fine).alias("fine"), F.count_if(fine & (F.col("rows_copied") > 0)).alias("full"))
    tables = outputs.where("kind = 'database'").groupBy("flow").agg(F.count(F.lit(1)).alias("n_rows")).join(copies, "flow", "left")
    written = F.coalesce((F.col("fine") == F.col("copies")) & (F.col("full") >= F.col("n_rows")), F.lit(False))
    of_tables = tables.select("flow", F.lit("database_outputs_copied").alias("check"), "n_rows", F.when(written, 0).otherwise(F.col("n_rows")).cast("long").alias("n_bad"))
    of_chain = _counted(chain, {"earlier_flows_succeeded": (F.col("place") < F.col("own_place"), good)})
    first = chain.where(F.col("own_place") == 1).select("flow").distinct().select("flow", F.lit("earlier_flows_succeeded").alias("check"), F.lit(0).cast("long").alias("n_rows"), F.lit(0).cast("long").alias("n_bad"))
    broken = chain.where("state = 'Failed'").groupBy("flow").agg(F.min("place").alias("failed"), F.max("own_place").alias("own_place")).where("own_place is not null")
    stopped = runs.where("orchestrator_state <> 'Completed'").select("flow").join(broken, "flow")
    of_stop = stopped.select("flow", F.lit("orchestrator_failed_later").alias("check"), F.lit(1).cast("long").alias("n_rows"), F.when(F.col("failed") > F.col("own_place"), 0).otherwise(1).cast("long").alias("n_bad"))
    tables = [of_activities.where("check = 'activities_succeeded'"), loads, of_inputs, of_outputs, of_tables, of_chain, first, of_stop]
    counted = reduce(DataFrame.unionByName, [scale.apart(x, "flow") for x in tables])
    words = counted.select("flow", "check", _word(F.col("n_bad") > 0).alias("word"), "n_rows", "n_bad")
    one = lambda check, word: F.struct(F.lit(check).alias("check"), word.alias("word"))
    blocks = F.coalesce("blockers", F.lit(0)) - F.coalesce("false_blockers", F.lit(0))
    known = runs.join(tested_by(runs), "flow").join(activities.select("flow").distinct().withColumn("has", F.lit(True)), "flow", "left")
    singles = known.select("flow", F.explode(F.array(
        one("run_identified", _word(F.col("run_state").isNull())), one("run_completed", _word(~F.coalesce(F.col("run_state") == "Completed", F.lit(False)))),
        one("validator_tested_run", _word(F.col("way") == "not_tested")), one("validator_has_no_blockers", F.when(blocks > 0, FAILS).when(F.col("false_blockers") > 0, JUSTIFIED).otherwise(OK)),
        F.when(F.col("has").isNull(), one("activities_succeeded", F.lit(UNKNOWN))),
    )).alias("x")).where("x is not null").select("flow", "x.check", "x.word")
    singles = singles.withColumns({"n_rows": F.lit(1).cast("long"), "n_bad": F.when(F.col("word") == FAILS, 1).otherwise(0).cast("long")})
    return words.unionByName(scale.apart(singles, "flow"))


def next_step(flows: DataFrame) -> DataFrame:
    """(flow, step, lanes) from (flow, kind, state, validated, quick, light, light_waived, measured, compared, analysed, code_reviewed,
    other_side_downloaded, other_side_measured, reused_unchecked).

    The first step that is not done yet; ``lanes`` are those that may go on at the same time, since they don't depend on the run.
    """
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    done = F.coalesce(F.col("state").isin("APPROVED", "APPROVED_WITH_JUSTIFICATION"), F.lit(False))
    sent_back, chief = F.col("state").eqNullSafe("SENT_BACK"), F.col("kind").eqNullSafe("orchestrator")
    step = (
        F.when(F.coalesce(F.col("reused_unchecked"), F.lit(False)), "check_reused").when(done, "report").when(sent_back, "new_cycle").when(chief & no("validated"), "run_orchestrator").when(chief, "approve_by_run")
        .when(no("validated"), "run_and_validate").when(no("quick") & F.col("light").isNull(), "quick_levels").when(F.col("light").isNull(), "traffic_light")
        .when((F.col("light") == "RED") & no("light_waived"), "report_red").when(no("measured"), "measure").when(no("compared"), "compare").when(no("analysed"), "analyse").otherwise("decide")
    )
    open_ = ~done & ~sent_back & ~chief
    early = step.isin("run_and_validate", "quick_levels", "traffic_light") & open_
    lanes = F.array_compact(F.array(F.when(open_ & no("code_reviewed"), "review_code"), F.when(early & no("other_side_downloaded"), "download_other_side").when(early & no("other_side_measured"), "measure_other_side")))
    return flows.select("flow", step.alias("step"), F.concat_ws(",", lanes).alias("lanes"))


def plain_number(c: Column) -> Column:
    """A catalogue's number without NaN: NULL for it, else the whole number."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double")).cast("long")


def resolve_table(names: DataFrame, listing: DataFrame) -> DataFrame:
    """(name, path): the folder of a table that is named in any case, from a storage listing (path of schema/table folders).

    Names are schema.table, Tables/schema/table or a table of schema dbo; of folders that differ by case only, the first.
    """
    bare = F.regexp_replace(F.regexp_replace("name", "`", ""), "^Tables/", "")
    parts = F.when(F.col("name").startswith("Tables/"), F.split(bare, "/")).otherwise(F.split(bare, "[.]"))
    want = names.select("name", parts.alias("p")).select("name", F.lower(F.when(F.size("p") == 1, F.lit("dbo")).otherwise(F.element_at("p", 1))).alias("s"), F.lower(F.element_at("p", -1)).alias("t"))
    there = listing.select("path", F.split("path", "/").alias("q")).select("path", F.lower(F.element_at("q", -2)).alias("s"), F.lower(F.element_at("q", -1)).alias("t"))
    return want.join(there.groupBy("s", "t").agg(F.min("path").alias("path")), ["s", "t"], "left").select("name", "path")
