"""Comparing two measured sides: pairing of columns, profile and contract differences, verdicts and states."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.types import change_class
from sieveline.operators.rules import CONTROLS

#: How bad a state is, for regressions.
RANK = {"OK": 0, "INFO": 0, "NOT_EVALUATED": 0, "NOT_APPLICABLE": 0, "PENDING_LEVEL_2": 0, "ALERT": 1, "ERROR": 2}


def normalised(name: str) -> str:
    """A column name without case, accents and everything that is no letter or digit."""
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().lower()
    return re.sub(r"[^a-z0-9]", "", plain)


def pair_columns(source: Sequence[str], target: Sequence[str]) -> tuple[dict[str, str], list[str], list[str]]:
    """Pairs by exact name, then by normalised name (each target once), and what is left on either side."""
    pairs = {n: n for n in source if n in set(target)}
    free = [n for n in target if n not in pairs]
    for n in source:
        if n not in pairs and (match := next((x for x in free if normalised(x) == normalised(n)), None)):
            pairs[n] = match
            free.remove(match)
    return pairs, [n for n in source if n not in pairs], free


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """(column_name, target_name, status, source_type, target_type, type_change) for all columns of both sides."""
    pairs, only_s, only_f = pair_columns(source.columns, target.columns)
    s, f = ({x.name: x.dataType.simpleString() for x in side.schema.fields} for side in (source, target))
    rows = [(a, b, "same_name" if a == b else "renamed", s[a], f[b], change_class(s[a], f[b])) for a, b in pairs.items()]
    rows += [(a, None, "only_source", s[a], None, None) for a in only_s] + [(None, b, "only_target", None, f[b], None) for b in only_f]
    return source.sparkSession.createDataFrame(rows, "column_name string, target_name string, status string, source_type string, target_type string, type_change string")


def profile_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """(column_name, metric, source, target) where two long profiles (column_name, metrics...) differ, null-safe."""
    metrics = [c for c in source.columns if c != "column_name" and c in target.columns]

    def long(df: DataFrame, name: str) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias(name)) for m in metrics])
        return df.select("column_name", F.explode(cells).alias("x")).select("column_name", "x.*")

    both = long(source, "source").join(long(target, "target"), ["column_name", "metric"])
    return both.where(~F.col("source").eqNullSafe(F.col("target")))


def contract_breaks(source: DataFrame, target: DataFrame) -> DataFrame:
    """(column_name, rule) where the target's observed contract is weaker than the source's.

    Columns are joined by name in any case; contracts have a row per column, so both sides are small.
    """
    key = F.lower("column_name")
    s = source.select(key.alias("k"), *[F.col(c).alias(f"s_{c}") for c in source.columns])
    f = target.select(key.alias("k"), *[F.col(c).alias(f"f_{c}") for c in target.columns])
    both = s.join(f, "k", "full_outer")
    tests = {
        "column_missing_in_target": F.col("f_column_name").isNull(), "column_new_in_target": F.col("s_column_name").isNull(),
        "type": F.col("s_data_type") != F.col("f_data_type"), "no_longer_mandatory": ~F.col("s_nullable") & F.col("f_nullable"),
        "no_longer_key": F.col("s_candidate_key") & ~F.col("f_candidate_key"), "max_length_grew": F.col("f_max_length") > F.col("s_max_length"),
    }
    broken = F.filter(F.array(*[F.when(t, F.lit(r)) for r, t in tests.items()]), lambda x: x.isNotNull())
    return both.select(F.coalesce("s_column_name", "f_column_name").alias("column_name"), F.explode(broken).alias("rule"))


def data_verdict(n_source: Column, n_target: Column, same_rows: Column, same_set: Column, n_pairs: Column, n_equal: Column, n_different: Column, one_sided: Column, measured: Column) -> Column:
    """What fingerprints say about the data, from the closest match to the loosest."""
    same_n = n_source == n_target
    share = F.round(100.0 * n_equal / F.greatest(n_pairs, F.lit(1)), 2)
    return (
        F.when(~measured, "NOT_MEASURED")
        .when(same_n & same_rows, "IDENTICAL")
        .when(same_n & same_set, "SAME_DATA_OTHER_ORDER_OR_NAMES")
        .when(same_n & (n_different == 0) & (n_pairs > 0) & (one_sided == 0), "SAME_DATA_BY_COLUMN")
        .when(same_n & (n_different > 0) & (share >= 90), "ALMOST_IDENTICAL")
        .when((n_different > 0) | ~same_n, "DIFFERENT")
        .otherwise("NO_PARITY")
    )


def quick_result(code: Column, level: Column, criterion: Column, source_state: Column, target_state: Column, equal: Column, new_empty: Column) -> Column:
    """A control's quick result from both sides' states; ``equal`` is what CP-01 and CP-02 found."""
    rank = lambda c: F.when(c == "ERROR", 2).when(c == "ALERT", 1).otherwise(0)
    base = (
        F.when(level == 2, "PENDING_LEVEL_2")
        .when(criterion == "not_applicable", "NOT_APPLICABLE")
        .when((code == "CP-01") & (criterion != "equal"), "INFORMATIVE")
        .when(code.isin("CP-01", "CP-02"), F.when(equal, "MET").otherwise("NOT_MET"))
        .when(code == "CP-05", F.when(target_state == "OK", "MET").when(target_state == "ERROR", "NOT_MET").when(target_state == "NOT_APPLICABLE", "NOT_APPLICABLE").otherwise("NOT_EVALUATED"))
        .when(criterion == "no_failures", F.when((target_state == "ERROR") & (F.coalesce(source_state, F.lit("")) != "ERROR"), "NOT_MET").when(target_state == "ERROR", "INHERITED").otherwise("MET"))
        .when(criterion == "no_regression", F.when(rank(target_state) > rank(source_state), "NOT_MET").otherwise("MET"))
        .otherwise("INFORMATIVE")
    )
    return F.when((code == "ID-03") & F.coalesce(new_empty, F.lit(False)), "NOT_MET").otherwise(base)


def quick_compare(states: DataFrame, group: str) -> DataFrame:
    """(code, level, criterion, source, target, result) from states (code, source, target, equal, new_empty)."""
    place = 1 if group == "ingestion" else 2
    rows = [(c, x[0], x[place] if group in ("ingestion", "analytics") else "not_applicable") for c, x in CONTROLS.items()]
    catalogue = states.sparkSession.createDataFrame(rows, "code string, level int, criterion string")
    both = catalogue.join(states, "code", "left")
    result = quick_result(F.col("code"), F.col("level"), F.col("criterion"), F.col("source"), F.col("target"), F.col("equal"), F.col("new_empty"))
    return both.select("code", "level", "criterion", "source", "target", result.alias("result"))


def control_regressions(states: DataFrame) -> DataFrame:
    """(code, change): regression if an OK source has a target that is not OK, improvement the other way round."""
    s, f = F.col("source"), F.col("target")
    change = F.when((s == "OK") & (f != "OK"), "regression").when((s != "OK") & (f == "OK"), "improvement").when((s == "ERROR") & (f == "ERROR"), "inherited")
    return states.select("code", change.alias("change")).where("change is not null")


def control_rollup(results: DataFrame) -> DataFrame:
    """(family, n, met, pct) of controls by family, the code's letters."""
    family = F.substring_index("code", "-", 1)
    met = F.count(F.when(F.col("result").isin("MET", "INHERITED"), 1))
    rated = F.count(F.when(F.col("result").isin("MET", "INHERITED", "NOT_MET"), 1))
    return results.groupBy(family.alias("family")).agg(F.count(F.lit(1)).alias("n"), met.alias("met"), F.when(rated > 0, F.round(100.0 * met / rated, 2)).alias("pct"))


def comparison_outcome(group: Column, same_rows: Column, same_hash: Column, same_columns: Column, type_change: Column, vg_failures: Column, id_regressions: Column, verdict: Column, renamed: Column, justified: Column, cut_declared: Column) -> Column:
    """APPROVED, APPROVED_WITH_JUSTIFICATION or REVIEW of one table.

    ``type_change`` is the worst class of changed types; ingestion asks for equal rows and fingerprints, analytics for no
    regression of the integrity controls; both for equal columns, types and no new schema failure.
    """
    same_types = type_change.isin("SAME", "TEXT_EQUIVALENT")
    shape = same_columns & (vg_failures == 0)
    ingestion, data = group == "ingestion", same_rows & same_hash
    base = shape & same_types & F.when(ingestion, data).otherwise(id_regressions == 0)
    clean = ~renamed & ~justified
    approved = F.when(ingestion, F.when(clean & (verdict == "IDENTICAL"), "APPROVED").otherwise("APPROVED_WITH_JUSTIFICATION")).otherwise(F.when(clean, "APPROVED").otherwise("APPROVED_WITH_JUSTIFICATION"))
    cut = cut_declared & shape & same_types & (ingestion | (id_regressions == 0))
    widened = type_change.isin("WIDENING", "PRECISION") & shape & F.when(ingestion, data).otherwise(id_regressions == 0)
    return F.when(base, approved).when(cut | widened, "APPROVED_WITH_JUSTIFICATION").otherwise("REVIEW")


def control_word(result: Column, decided: Column, warned: Column) -> Column:
    """The word for a control: a failure that a person decided on is justified, one not decided on has to be verified."""
    return (
        F.when(result == "NOT_APPLICABLE", "not_applicable")
        .when(result == "NOT_EVALUATED", "not_evaluated")
        .when(result == "PENDING_LEVEL_2", "pending")
        .when(result == "NOT_MET", F.when(decided == "justified", "justified").when(decided == "to_verify", "to_verify").otherwise("fails"))
        .when((result == "INFORMATIVE") | warned, F.when(warned, "warning").otherwise("ok"))
        .otherwise("ok")
    )


#: Words that keep a table from being approved.
BLOCKING = ("fails", "pending", "not_evaluated")


def table_state(words: DataFrame, by: Sequence[str]) -> DataFrame:
    """A table's state from its controls' words: the first that applies."""
    n = lambda *w: F.count(F.when(F.col("word").isin(*w), 1))
    state = (
        F.when(n("pending") > 0, "IN_PROGRESS").when(n("fails") > 0, "RETURNED").when(n("not_evaluated") > 0, "IN_REVIEW")
        .when(n("to_verify") > 0, "APPROVED_WITH_VERIFICATION").when(n("justified") > 0, "APPROVED_WITH_JUSTIFICATION").otherwise("APPROVED")
    )
    return words.groupBy(*by).agg(state.alias("state"))


#: Flow and table states from the worst to the best.
STATE_ORDER = ["RETURNED", "IN_PROGRESS", "IN_REVIEW", "APPROVED_WITH_VERIFICATION", "APPROVED_WITH_JUSTIFICATION", "APPROVED"]


def worst(column: str, order: Sequence[str]) -> Column:
    """The worst of a group's states, by an order from the worst to the best; unknown states are the best."""
    place = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in order]), F.col(column)), F.lit(0))
    place = F.when(place == 0, len(order)).otherwise(place)
    return F.element_at(F.array(*[F.lit(x) for x in order]), F.min(place).cast("int"))


def flow_state(tables: DataFrame, checks: DataFrame) -> DataFrame:
    """(flow, state): the worst of its tables' states, RETURNED if one of its checks fails, IN_REVIEW without evidence."""
    of_tables = tables.groupBy("flow").agg(worst("state", STATE_ORDER).alias("tables"))
    of_checks = checks.groupBy("flow").agg(F.count(F.when(F.col("word") == "fails", 1)).alias("fails"), F.count(F.when(F.col("word") == "not_evaluated", 1)).alias("open"))
    both = of_tables.join(of_checks, "flow", "full_outer")
    state = F.when((F.col("fails") > 0) | (F.col("tables") == "RETURNED"), "RETURNED").when(F.col("tables") == "IN_PROGRESS", "IN_PROGRESS").when((F.col("open") > 0) | F.col("tables").isNull(), "IN_REVIEW").otherwise(F.col("tables"))
    return both.select("flow", state.alias("state"))


def traffic_light(findings: DataFrame) -> DataFrame:
    """(flow, light, n_red, n_yellow) from findings (flow, kind, detail).

    Red: a run that didn't complete, a blocker of the validator, outputs without a commit, or an empty table (ID-01).
    Yellow: any other control that isn't met, swapped roles, a missing comparison, an unevaluated window, differing nulls,
    an open code review. Orchestrators have run states only.
    """
    red = F.col("kind").isin("run_not_completed", "validator_blocker", "output_without_commit", "child_not_completed") | ((F.col("kind") == "control_not_met") & (F.col("detail") == "ID-01"))
    yellow = ~red & F.col("kind").isin("control_not_met", "roles_swapped", "comparison_missing", "cp05_not_evaluated", "nulls_differ", "code_review_open", "no_run")
    out = findings.groupBy("flow").agg(F.count(F.when(red, 1)).alias("n_red"), F.count(F.when(yellow, 1)).alias("n_yellow"))
    return out.select("flow", F.when(F.col("n_red") > 0, "RED").when(F.col("n_yellow") > 0, "YELLOW").otherwise("GREEN").alias("light"), "n_red", "n_yellow")


def normalised_profile(source: DataFrame, target: DataFrame, metrics: Iterable[str], tolerance: float = 0.5) -> DataFrame:
    """(column_name, metric, source_pct, target_pct): shares of rows that differ by more than ``tolerance`` points."""
    def shares(df: DataFrame, name: str) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.when(F.col("n_rows") > 0, 100.0 * F.col(m) / F.col("n_rows")).alias(name)) for m in metrics])
        return df.select("column_name", F.explode(cells).alias("x")).select("column_name", "x.*")

    both = shares(source, "source_pct").join(shares(target, "target_pct"), ["column_name", "metric"])
    out = both.where(F.abs(F.col("source_pct") - F.col("target_pct")) > tolerance)
    return out.select("column_name", "metric", F.round("source_pct", 4).alias("source_pct"), F.round("target_pct", 4).alias("target_pct"))


def load_stamps(source: DataFrame, target: DataFrame) -> DataFrame:
    """(column_name, source_value, target_value): columns constant on both sides with different values, as load stamps are.

    Takes bounds per column (column_name, low, high).
    """
    s = source.where("low = high").select("column_name", F.col("low").alias("source_value"))
    f = target.where("low = high").select("column_name", F.col("low").alias("target_value"))
    return s.join(f, "column_name").where("source_value <> target_value")
