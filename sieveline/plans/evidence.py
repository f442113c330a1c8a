"""Queries on a run's evidence, next steps, table lookup and transcripts, with SQL that computes the rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.operators import evidence, ops
from sieveline.plans import common as C
from sieveline.sources import scans

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Registers a query under its function's name, with its oracle."""
    def keep(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return keep


_FLOW = "'f' || o_orderkey as flow, "
_TIME = "cast(null as timestamp)"
RUNS = C.Derived(
    f"select {_FLOW}{C.pick('o_custkey % 3', 'analytic', 'ingest', 'ingest')} as kind, {C.pick('o_orderkey % 7', 'Failed', None, 'Completed')} as run_state, case when o_orderkey % 7 <> 1 then o_orderdate + interval 30 minutes end as run_end, "
    f"{C.pick('o_orderkey % 5', '=' + _TIME, '=o_orderdate', '=o_orderdate + interval 60 minutes')} as validator_ts, {C.pick('o_orderkey % 4', True, False, None, False)} as validator_ran, o_custkey % 5 > 0 as validator_matches, case when o_custkey % 11 > 0 then o_custkey % 4 > 0 end as validator_passes, "
    f"o_orderkey % 3 = 0 as orchestrated, o_orderkey % 3 = 1 as waiver, cast({C.pick('o_custkey % 6', '=2', '=1', '=3', None, '=0', '=0')} as int) as blockers, cast({C.pick('o_custkey % 7', '=2', '=1', None, '=0', '=0', '=0', '=0')} as int) as false_blockers, {C.pick('o_custkey % 5', 'Completed', 'Failed', 'Cancelled', None, 'Completed')} as orchestrator_state from orders"
)
_ACTIVITY = "select " + _FLOW + "'{n}' as activity, " + C.pick("(o_orderkey + {i}) % 4", "Copy", "Notebook", "Copy", "Wait") + " as kind, " + C.pick("(o_custkey + {i}) % 8", "Failed", "Inactive", "Succeeded") + " as state, "
_ACTIVITY += C.pick("(o_orderkey + {i}) % 9", None, "=o_custkey") + " as rows_read, " + C.pick("(o_orderkey + {i}) % 11", None, "=o_custkey - 1", "=cast(0 as bigint)", "=o_custkey") + " as rows_copied, " + C.pick("(o_custkey + {i}) % 5", None, False, True) + " as in_scope from orders where o_orderkey % 9 > {i}"
ACTIVITIES = C.Derived(" union all ".join(_ACTIVITY.format(n=n, i=i) for i, n in enumerate("ab")))
_INPUT = "select " + _FLOW + "'s{i}' as input, " + C.pick("(o_orderkey + {i}) % 4", "delta", "folder", "delta", "copy") + " as kind, " + C.pick("(o_custkey + {i}) % 6", None, "=o_custkey") + " as version_read, " + C.pick("(o_custkey + {i}) % 7", "Failed", None, "Succeeded") + " as producer_state, "
_INPUT += C.pick("(o_orderkey + {i}) % 5", None, True, False) + " as changed_after, cast(" + C.pick("(o_custkey + {i}) % 5", None, "=3", "=0") + " as int) as files_after from orders where o_orderkey % 7 > {i}"
INPUTS = C.Derived(" union all ".join(_INPUT.format(i=i) for i in range(2)))
_OUTPUT = "select " + _FLOW + "'g{i}' as output, " + C.pick("(o_orderkey + {i}) % 4", "delta", "database", "delta", "folder") + " as kind, " + C.pick("(o_custkey + {i}) % 6", None, False, True) + " as committed, " + C.pick("(o_custkey + {i}) % 5", None, "=o_orderkey % 4") + " as measured_version, "
_OUTPUT += "array(cast(0 as bigint), 2, 3) as written_versions, cast(" + C.pick("(o_orderkey + {i}) % 6", None, "=1", "=0") + " as int) as commits_after, cast(" + C.pick("(o_custkey + {i}) % 4", None, "=0", "=5") + " as int) as files_in_run from orders where o_orderkey % 7 > {i}"
OUTPUTS = C.Derived(" union all ".join(_OUTPUT.format(i=i) for i in range(3)), {"array(cast(0 as bigint), 2, 3)": "[0::bigint, 2, 3]"})
_LINK = "select " + _FLOW + "cast({i} as int) as place, cast(o_custkey % 3 + 1 as int) as own_place, " + C.pick("(o_orderkey * 3 + o_custkey + {i}) % 11", "Failed", "Cancelled", "Succeeded") + " as state from orders where o_orderkey % 4 > 0"
CHAIN = C.Derived(" union all ".join(_LINK.format(i=i) for i in (1, 2, 3)))
_EVIDENCE = f"""with r as (select * from {RUNS.sql}), a as (select * from {ACTIVITIES.sql}), i as (select * from {INPUTS.sql}), o as (select * from {OUTPUTS.sql}), c as (select * from {CHAIN.sql}),
w as (select flow, case when validator_ts >= run_end and validator_matches and validator_ran is distinct from false then 'executed' when validator_ts >= run_end and validator_ran = false and orchestrated and validator_passes then 'orchestrated'
  when validator_ts >= run_end and validator_ran = false and waiver and run_state = 'Completed' and (validator_passes or (false_blockers > 0 and false_blockers = blockers)) then 'waived' else 'not_tested' end as way from r),
k as (select flow, count(*) as copies, count(*) filter (where state = 'Succeeded' and (rows_copied is null or rows_copied > 0)) as fine, count(*) filter (where state = 'Succeeded' and rows_copied > 0) as "full" from a where kind = 'Copy' group by 1) """
_CHECKS = {
    "activities_succeeded": "select flow, state = 'Succeeded' as fine from a",
    "scope_succeeded": "select flow, state = 'Succeeded' as fine from a where kind = 'Copy' and in_scope and flow in (select flow from r where kind = 'ingest')",
    "copies_complete": "select flow, rows_read = rows_copied as fine from a where kind = 'Copy' and in_scope and flow in (select flow from r where kind = 'ingest')",
    "input_commits_found": "select flow, version_read is not null as fine from i where kind = 'delta'",
    "producers_succeeded": "select flow, producer_state is null or producer_state = 'Succeeded' as fine from i where kind = 'delta'",
    "inputs_unchanged": "select flow, not coalesce(case kind when 'delta' then changed_after else files_after > 0 end, false) as fine from i where kind <> 'copy'",
    "outputs_committed": "select flow, committed as fine from o where kind = 'delta'",
    "measured_version_written": "select flow, measured_version is null or list_contains(written_versions, measured_version) as fine from o where kind = 'delta'",
    "outputs_not_rewritten": "select flow, coalesce(commits_after, 0) = 0 as fine from o where kind = 'delta'",
    "folders_received_files": "select flow, files_in_run > 0 as fine from o where kind = 'folder'",
    "earlier_flows_succeeded": "select flow, state = 'Succeeded' as fine from c where place < own_place",
    "run_identified": "select flow, run_state is not null as fine from r",
    "run_completed": "select flow, run_state = 'Completed' as fine from r",
    "validator_tested_run": "select flow, way <> 'not_tested' as fine from w",
    "orchestrator_failed_later": "select flow, min(place) filter (where state = 'Failed') > max(own_place) as fine from c where flow in (select flow from r where orchestrator_state <> 'Completed') group by 1 having count(*) filter (where state = 'Failed') > 0",
}


@query(
    _EVIDENCE + " union all ".join(f"select flow, '{k}' as \"check\", case when count(*) filter (where not coalesce(fine, false)) > 0 then 'fails' else 'ok' end as word, count(*) as n_rows, count(*) filter (where not coalesce(fine, false)) as n_bad from ({q}) group by 1" for k, q in _CHECKS.items())
    + " union all select distinct flow, 'earlier_flows_succeeded', 'ok', 0, 0 from c where own_place = 1 "
    "union all select d.flow, 'database_outputs_copied', case when fine = copies and \"full\" >= n then 'ok' else 'fails' end, n, case when fine = copies and \"full\" >= n then 0 else n end from (select flow, count(*) as n from o where kind = 'database' group by 1) d left join k using (flow) "
    "union all select flow, 'validator_has_no_blockers', case when coalesce(blockers, 0) > coalesce(false_blockers, 0) then 'fails' when false_blockers > 0 then 'justified' else 'ok' end, 1, (coalesce(blockers, 0) > coalesce(false_blockers, 0))::int from r "
    "union all select flow, 'activities_succeeded', 'not_evaluated', 1, 0 from r where flow not in (select flow from a)"
)
def run_evidence_checks(spark, d):
    return evidence.run_checks(*[x.df(spark, d) for x in (RUNS, ACTIVITIES, INPUTS, OUTPUTS, CHAIN)])


_SOME = lambda n, m: C.pick(f"(o_orderkey * {n} + o_custkey) % {m}", True, True, False, None, True)
STAGES = C.Derived(
    f"select {_FLOW}{C.pick('o_custkey % 5', 'orchestrator', 'analytic', 'ingest')} as kind, {C.pick('o_orderkey % 11', 'APPROVED', 'APPROVED_WITH_JUSTIFICATION', 'SENT_BACK', None)} as state, {_SOME(3, 9)} as validated, {_SOME(5, 7)} as quick, "
    f"{C.pick('o_custkey % 7', 'RED', 'YELLOW', None, 'GREEN')} as light, {_SOME(7, 5)} as light_waived, {_SOME(11, 8)} as measured, {_SOME(13, 9)} as compared, {_SOME(17, 7)} as analysed, {_SOME(19, 5)} as code_reviewed, "
    f"{_SOME(23, 6)} as other_side_downloaded, {_SOME(29, 5)} as other_side_measured, {C.pick('o_orderkey % 17', True, False, None)} as reused_unchecked from orders"
)
_STEP = """case when reused_unchecked then 'check_reused' when state like 'APPROVED%' then 'report' when state = 'SENT_BACK' then 'new_cycle' when kind = 'orchestrator' then if(validated, 'approve_by_run', 'run_orchestrator')
 when validated is not true then 'run_and_validate' when light is null then if(quick, 'traffic_light', 'quick_levels') when light = 'RED' and light_waived is not true then 'report_red' when measured is not true then 'measure'
 when compared is not true then 'compare' when analysed is not true then 'analyse' else 'decide' end"""


@query(
    f"with s as (select *, {_STEP} as step, coalesce(state, '') = '' and kind <> 'orchestrator' as going from {STAGES.sql}) select flow, step, concat_ws(',', case when going and code_reviewed is not true then 'review_code' end, "
    "case when going and step in ('run_and_validate', 'quick_levels', 'traffic_light') then case when other_side_downloaded is not true then 'download_other_side' when other_side_measured is not true then 'measure_other_side' end end) as lanes from s"
)
def next_step(spark, d):
    return evidence.next_step(STAGES.df(spark, d))


NAMES = C.Derived(
    "select distinct " + C.pick("c_custkey % 5", "='silver.sap_T' || c_nationkey", "='Tables/Gold/Sales' || c_nationkey", "='plain' || c_nationkey", "=chr(96) || 'silver' || chr(96) || '.' || chr(96) || 'missing' || c_nationkey || chr(96)", "='silver.twice' || c_nationkey")
    + " as name from customer"
)
LISTING = C.Derived(
    "select distinct " + C.pick("c_custkey % 6", "='Tables/Silver/SAP_t' || c_nationkey", "='Tables/gold/SALES' || c_nationkey", "='Tables/dbo/Plain' || c_nationkey", "='Tables/silver/twice' || c_nationkey", "='Tables/silver/Twice' || c_nationkey", "='Tables/gold/missing' || c_nationkey")
    + " as path from customer"
)


@query(
    f"select name, (select min(path) from {LISTING.sql} l where lower(path) = 'tables/' || lower(case when starts_with(name, 'Tables/') then substr(name, 8) when contains(name, '.') then replace(replace(name, '`', ''), '.', '/') else 'dbo/' || name end)) as path from {NAMES.sql}"
)
def resolve_table(spark, d):
    return evidence.resolve_table(NAMES.df(spark, d), LISTING.df(spark, d))


LENGTHS = C.Derived("select 'c' || c_custkey as column_name, case when c_custkey % 3 = 0 then cast('NaN' as double) when c_custkey % 3 = 1 then cast(c_nationkey as double) end as max_length from customer")


@query(f"select column_name, case when not isnan(max_length) then max_length::bigint end as max_length from {LENGTHS.sql}")
def catalogue_numbers(spark, d):
    return LENGTHS.df(spark, d).select("column_name", evidence.plain_number(F.col("max_length")).alias("max_length"))


#: Transcript lines: (file, seconds, request id, model, input, cache write, cache read, output).
#: Transcript lines: of each event one call, some logged twice, some without a request or a real model.
LINES = C.Derived(
    "select 's' || (user_id % 40) as file, cast(event_id % 3600 as int) as ts, case when event_id % 17 > 0 then 'r' || (event_id - event_id % 3) end as request_id, " + C.pick("user_id % 9", "<none>", "big-1", "big-1", "small", "small", "big-2")
    + " as model, event_id % 100 as input, user_id * 1000 % 150000 as written, event_id * 977 % 300000 as read, event_id % 50 as output from events"
)


def _transcripts(spark, d):
    """The lines as JSON files, each with one line that is no JSON."""
    path = f"{C.folder(spark, 'transcripts')}/logs"
    usage = F.struct(F.col("input").alias("input_tokens"), F.col("written").alias("cache_creation_input_tokens"), F.col("read").alias("cache_read_input_tokens"), F.col("output").alias("output_tokens"))
    stamp = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = F.to_json(F.struct(F.lit("assistant").alias("type"), stamp.alias("timestamp"), F.col("request_id").alias("requestId"), F.struct("model", usage.alias("usage")).alias("message")))
    rows = LINES.df(spark, d).select("file", line.alias("value"))
    rows = rows.unionByName(rows.select("file", F.lit("{broken").alias("value")).distinct())
    rows.repartition(8, "file").write.mode("overwrite").partitionBy("file").text(path)
    return scans.transcripts(spark, path)


_FIRST = f"(select * from {LINES.sql} where request_id is not null and not starts_with(model, '<') qualify row_number() over (partition by file, request_id order by ts) = 1)"


@query(f"select file as session, model, count(*) as n_calls, sum(input)::bigint as input_tokens, sum(written)::bigint as cache_write_tokens, sum(read)::bigint as cache_read_tokens, sum(output)::bigint as output_tokens, max(input + written + read) as max_context from {_FIRST} group by 1, 2")
def transcript_usage(spark, d):
    calls = _transcripts(spark, d)
    sums = [F.sum(c).alias(c) for c in ("input_tokens", "cache_write_tokens", "cache_read_tokens", "output_tokens")]
    return calls.groupBy(F.element_at(F.split(F.element_at(F.split("file", "/"), -2), "="), -1).alias("session"), "model").agg(F.count(F.lit(1)).alias("n_calls"), *sums, F.max("context_tokens").alias("max_context"))


SESSIONS = C.Derived(
    f"select 's' || o_orderkey as session, {C.pick('o_custkey % 5', 'COORDINATOR', 'meter', 'general', 'judge', 'COORDINATOR')} as actor, {C.pick('o_orderkey % 5', 'big-1', 'small-1', 'small-2', 'big-2', 'big-1')} as model, {C.pick('o_custkey % 4', None, 'small', 'big', None)} as declared_model, "
    "cast(o_orderkey % 20 as int) as ended, cast(o_custkey % 15 as int) as declared_since, cast(o_custkey % 40 as int) as calls, o_custkey * 331 % 300000 as context_tokens, o_orderkey * 577 % 150000 as rewrite_tokens, o_orderkey * 91 % 90000 as result_bytes, "
    "cast(o_custkey % 50 + 1 as int) as tool_calls, cast(case when o_orderkey % 4 > 0 then o_custkey % 50 + 1 else 0 end as int) as pipeline_tool_calls, cast(case when o_orderkey % 3 = 0 then o_custkey % 50 else 0 end as int) as errors, cast(o_custkey % 8 as double) / 4 as cost from orders"
)
_FOUND = [
    ("large_context", "session", "actor = 'COORDINATOR' and context_tokens > 200000", "max(context_tokens)"), ("cache_rewrites", "actor", "rewrite_tokens >= 100000", "sum(rewrite_tokens)"),
    ("other_model", "actor", "declared_model is not null and not contains(model, declared_model) and ended >= declared_since", "count(*)"), ("generic_actor", "actor", "actor in ('general', 'search')", "sum(cost)"), ("large_results", "session", "actor = 'COORDINATOR' and result_bytes >= 30000", "sum(result_bytes)"),
]


@query(
    " union all ".join(f"select '{k}' as finding, {by} as subject, round(({v})::double, 6) as figure from {SESSIONS.sql} where {w} group by {by}" for k, by, w, v in _FOUND)
    + f" union all select 'alias_of_several', declared_model, count(distinct model)::double from {SESSIONS.sql} where contains(model, declared_model) group by declared_model having count(distinct model) > 1"
    + f" union all select 'mechanical_work', actor, round(100.0 * sum(pipeline_tool_calls) / sum(tool_calls), 6)::double from {SESSIONS.sql} where declared_model = 'big' group by actor having 100.0 * sum(pipeline_tool_calls) / sum(tool_calls) >= 70"
    + f" union all select 'many_errors', actor, round(100.0 * sum(errors) / sum(tool_calls), 6)::double from {SESSIONS.sql} where declared_model = 'small' group by actor having sum(tool_calls) > 20 and 100.0 * sum(errors) / sum(tool_calls) >= 20"
)
def usage_findings(spark, d):
    return ops.usage_findings(SESSIONS.df(spark, d), generic=["general", "search"], strong="big", weak="small", error_percent=20)


@query("select lower(replace(n_name, ' ', '_')) || '.csv' as name, octet_length(encode(n_name)) as n_bytes from nation where lower(n_name) >= 'c' and n_nationkey % 5 > 0")
def matching_files(spark, d):
    """Files of a folder by a pattern, with their size and time."""
    path = f"{C.folder(spark, 'listing')}/files"
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for key, nation in C.table(spark, d, "nation").select("n_nationkey", "n_name").collect():  # a name of a file each
        name, body = f"{nation.lower().replace(' ', '_')}.{'csv' if key % 5 else 'txt'}", nation
        where = fs.Path(f"{path}/{name}")
        out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
        out.write(bytearray(body.encode()))
        out.close()
    return scans.matching_files(spark, path, r"^[c-z].*\.csv$").where("modified is not null").select("name", "n_bytes")
