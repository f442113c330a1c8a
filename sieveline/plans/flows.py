"""Queries on flows: lineage, windows, checks before and after a run, and operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.operators import flow, lineage, ops
from sieveline.plans import common as C

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its oracle."""
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return keep


#: Inputs and outputs of 60 flows: table folders in several spellings, files in nested folders.
IO = C.Derived(
    "select 'f' || (c_custkey % 60) as flow, case when c_nationkey % 2 = 0 then 'input' else 'output' end as role, "
    + C.pick("c_custkey % 6", "='abfss://ws@host/Tables/T' || (c_nationkey % 17) || '/'", "='/Tables/t' || (c_nationkey % 17)", "='Files/out/' || (c_nationkey % 5) || '/' || (c_custkey % 23)", "='Files/out/' || (c_nationkey % 5)", "='Tables//t' || (c_nationkey % 17) || '/part=' || (c_custkey % 3)", "='Files/in/' || (c_custkey % 31)")
    + " as path from customer"
)
_NORM = "lower(regexp_replace(regexp_replace(regexp_replace(trim(path, ' '), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/?', ''), '/+', '/', 'g'), '^/|/$', '', 'g'))"
_EDGES = (
    f"with io as (select distinct flow, role, {_NORM} as path from {IO.sql}), e as (select distinct o.flow as producer, i.flow as consumer, o.path as w, i.path as r from io o join io i on o.role = 'output' and i.role = 'input' and o.flow <> i.flow "
    "and (o.path = i.path or starts_with(i.path, o.path || '/') or starts_with(o.path, i.path || '/'))) "
)


@query(f"{_EDGES} select producer, consumer, case when w = r then 'exact' else 'prefix' end as kind, r as path from e")
def lineage_edges(spark, d):
    return lineage.edges(IO.df(spark, d))


FLOWS = C.Derived("select distinct 'n' || c_custkey as flow from customer")
#: In every block of 8 flows some wait for up to three places earlier; two flows in each 64 wait for each other.
LINKS = C.Derived(
    "select 'n' || (c_custkey - 1 - c_custkey % 3) as producer, 'n' || c_custkey as consumer from customer where c_custkey % 8 >= 3 and c_custkey % 64 >= 8 "
    "union all select 'n' || (c_custkey + 1), 'n' || c_custkey from customer where c_custkey % 64 = 1 union all select 'n' || (c_custkey - 1), 'n' || c_custkey from customer where c_custkey % 64 = 2"
)


@query(
    f"with recursive l as (select * from {LINKS.sql}), dep as (select flow, 0 as wave from {FLOWS.sql} where flow not in (select consumer from l) union select l.consumer, dep.wave + 1 from dep join l on l.producer = dep.flow where dep.wave < 20), "
    f"done as (select flow, max(wave) as wave from dep group by 1), top as (select max(wave) as m from done) select flow, wave::int as wave from done union all select flow, (m + row_number() over (order by flow))::int from {FLOWS.sql}, top where flow not in (select flow from done)"
)
def topo_waves(spark, d):
    return lineage.waves(FLOWS.df(spark, d), LINKS.df(spark, d))


DEPENDS = C.Derived(f"select consumer as activity, producer as depends_on from {LINKS.sql} l")


@query(f"with recursive l as (select * from {DEPENDS.sql}), r(activity, before) as (select activity, depends_on from l union select r.activity, l.depends_on from r join l on l.activity = r.before) select distinct activity, before from r")
def dependency_closure(spark, d):
    return lineage.closure(DEPENDS.df(spark, d))


KNOWN = C.Derived("select distinct 'Files/in/' || (c_custkey % 31) as path from customer where c_custkey % 31 < 9")


@query(
    f"with io as (select distinct flow, role, {_NORM} as path from {IO.sql}), i as (select flow, path from io where role = 'input'), o as (select flow as who, path as w from io where role = 'output') "
    "select flow, path, case when exists (select 1 from o where w = path and who <> flow) then 'direct' when exists (select 1 from o where w = path and who = flow) then 'self_read' "
    f"when exists (select 1 from o where who <> flow and (starts_with(path, w || '/') or starts_with(w, path || '/'))) then 'indirect' when path in (select lower(path) from {KNOWN.sql}) then 'external' else 'no_producer' end as class from i"
)
def dependency_class(spark, d):
    io = IO.df(spark, d)
    return lineage.dependency_class(io.where("role = 'input'"), io.where("role = 'output'"), KNOWN.df(spark, d))


FLAGS = C.Derived(f"select distinct {C.pick('p_partkey % 9', '=chr(45) || chr(45) || lower(p_brand) || chr(45) || chr(105) || chr(110) || chr(112) || chr(117) || chr(116)', '--output', '=chr(45) || chr(45) || p_size || chr(95) || chr(111) || chr(117) || chr(116)', '--target-dir', '--save-mode', '=chr(45) || chr(45) || p_brand', '-destination', '--source_table', '--ruta-salida')} as flag from part")


@query(f"with t as (select flag, lower(ltrim(flag, '-')) as f from {FLAGS.sql}) select flag, case when regexp_matches(f, '(^|[_-])(mode|modo|savemode)([_-]|$)') then 'mode' when regexp_matches(f, '(^|[_-])(out|output|target|dest|destination|sink|salida|destino|write)([_-]|$)') then 'output' when regexp_matches(f, '(^|[_-])(in|input|source|src|origin|origen|entrada|read)([_-]|$)') then 'input' else 'unknown' end as role from t")
def flag_roles(spark, d):
    return lineage.flag_roles(FLAGS.df(spark, d))


def _events(spark, d):
    return C.table(spark, d, "events")


@query("with r as (select event_id as run_id, ts - interval 120 seconds as lo, ts + interval 720 seconds as hi from events where event_type = 'error'), c as (select ts from events where event_type = 'signup') select run_id, count(c.ts) as n_commits, strftime(min(c.ts), '%Y-%m-%d %H:%M:%S') as first_ts, strftime(max(c.ts), '%Y-%m-%d %H:%M:%S') as last_ts from r left join c on c.ts between lo and hi group by 1")
def commits_in_window(spark, d):
    ev = _events(spark, d)
    runs = ev.where("event_type = 'error'").select(F.col("event_id").alias("run_id"), F.col("ts").alias("start"), (F.col("ts") + F.expr("INTERVAL 600 SECONDS")).alias("end"))
    out = lineage.in_windows(ev.where("event_type = 'signup'").select("ts"), runs)
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_ts", "last_ts")})


@query("with r as (select event_id as run_id, user_id, ts as start from events where event_type = 'error'), c as (select event_id as version, user_id, ts from events where event_type <> 'error') select run_id, (select max(c.ts) from c where c.user_id = r.user_id and c.ts <= r.start)::varchar is not null as has_commit, (select c.version from c where c.user_id = r.user_id and c.ts <= r.start order by c.ts desc, c.version desc limit 1) as version from r")
def asof_commit(spark, d):
    ev = _events(spark, d)
    runs = ev.where("event_type = 'error'").select(F.col("event_id").alias("run_id"), "user_id", F.col("ts").alias("start"))
    commits = ev.where("event_type <> 'error'").select(F.col("event_id").alias("version"), "user_id", "ts")
    return lineage.asof(runs, commits, ["user_id"]).select("run_id", F.col("commit_ts").isNotNull().alias("has_commit"), "version")


ROLES = C.Derived("select 'f' || o_orderkey as flow, 't' || (o_custkey % 50) as path, case when o_orderkey % 2 = 0 then 'output' else 'input' end as role from orders where o_orderkey % 3 = 0")
RUNS = C.Derived("select 'f' || o_orderkey as flow, o_orderdate as start, o_orderdate + interval 30 minutes as until from orders where o_orderkey % 3 = 0", until="end")
COMMITS = C.Derived("select 't' || (o_custkey % 50) as path, o_orderdate + interval 20 minutes as ts from orders where o_orderkey % 4 = 0")


@query(f"with r as (select ro.flow, ro.path, ro.role, ru.start - interval 120 seconds as lo, ru.until + interval 120 seconds as hi from {ROLES.sql} ro join {RUNS.sql} ru using (flow)) select flow, path, role, (role = 'output') = exists (select 1 from {COMMITS.sql} c where c.path = r.path and c.ts between lo and hi) as confirmed from r")
def role_confirmation(spark, d):
    return lineage.role_confirmation(ROLES.df(spark, d), COMMITS.df(spark, d), RUNS.df(spark, d))


ORIGINS = C.Derived(f"select 'p' || (o_custkey % 300) as path, {C.pick('(o_orderkey * 3 + o_custkey) % 12', 'copy', 'variable', 'code', 'code', 'note')} as origin from orders")


@query(f"select path, case when bool_or(origin = 'copy') then 'INGESTION' when bool_or(origin = 'variable') then 'VARIABLE' when bool_or(origin = 'code') then 'CODE' else 'MANUAL' end as verdict from {ORIGINS.sql} group by 1")
def lineage_verdict(spark, d):
    return lineage.lineage_verdict(ORIGINS.df(spark, d))


@query(f"with recursive l as (select producer as a, consumer as b from {LINKS.sql} union select consumer, producer from {LINKS.sql}), r(node, hop) as (select 'n13', 0 union select l.b, r.hop + 1 from r join l on l.a = r.node where r.hop < 2) select node, min(hop)::int as hop from r group by 1")
def graph_context(spark, d):
    links = LINKS.df(spark, d).select(F.col("producer").alias("src"), F.col("consumer").alias("dst"))
    return lineage.context(FLOWS.df(spark, d).select(F.col("flow").alias("node")), links, "n13", 2)


_LAYER = C.pick("c_nationkey % 6", "bronze", "silver", "gold", "raw", "landing", "plain")
PATHS = C.Derived(
    "select distinct " + C.pick("c_custkey % 6", f"='abfss://ws' || c_nationkey || '@host.dfs/lake/Tables/' || {_LAYER} || '/x' || (c_custkey % 40)", f"='lh.' || {_LAYER} || '.sales' || (c_custkey % 40)", f"={_LAYER} || '.orders' || (c_custkey % 40)", f"='/Files/' || {_LAYER} || '/2024/a' || (c_custkey % 40) || '.csv'", "='Tables/other' || (c_custkey % 40)", f"='Files/' || {_LAYER} || 'ish/'")
    + " as path from customer"
)


@query(f"select path, case when regexp_matches(lower(path), '(^|[/_.-])(bronze|silver|gold|landing|raw|staging)([/_.-]|$)') then regexp_extract(lower(path), '(?:^|[/_.-])(bronze|silver|gold|landing|raw|staging)(?:[/_.-]|$)', 1) else 'unknown' end as layer from {PATHS.sql}")
def layer_from_path(spark, d):
    return PATHS.df(spark, d).select("path", flow.layer(F.col("path")).alias("layer"))


@query(f"select path as raw, case when regexp_matches(path, '^abfss://') then regexp_extract(path, '^abfss://([^@]+)@', 1) end as workspace, case when regexp_matches(path, '^abfss://') then regexp_extract(path, '^abfss://[^@]+@[^/]+/([^/]+)/', 1) when regexp_matches(path, '^\\w+[.]\\w+[.]\\w+$') then split_part(path, '.', 1) end as item, case when regexp_matches(path, '^abfss://') then regexp_extract(path, '^abfss://[^@]+@[^/]+/[^/]+/(.*)$', 1) when regexp_matches(path, '^\\w+[.]\\w+[.]\\w+$') then 'Tables/' || split_part(path, '.', 2) || '/' || split_part(path, '.', 3) when regexp_matches(path, '^\\w+[.]\\w+$') then 'Tables/' || replace(path, '.', '/') else trim(path, '/') end as path from {PATHS.sql}")
def path_parts(spark, d):
    return PATHS.df(spark, d).select(F.col("path").alias("raw"), *[e.alias(k) for k, e in lineage.path_parts(F.col("path")).items()])


_SIDE = "path string, readable boolean, n_rows long, schema_digest string, fingerprint string"
_AT = "'p' || c_custkey as path, "
BEFORE = C.Derived(f"select {_AT}c_custkey % 17 > 0 as readable, case when c_custkey % 17 > 0 then 100 + c_nationkey end as n_rows, case when c_custkey % 17 > 0 then 's' end as schema_digest, case when c_custkey % 17 > 0 then 'f' || c_custkey end as fingerprint from customer where c_custkey % 10 > 0")
AFTER = C.Derived(
    f"select {_AT}c_custkey % 13 > 0 as readable, case when c_custkey % 13 > 0 then {C.pick('c_custkey % 7', '=100 + c_nationkey', '=100 + c_nationkey', '=60', '=150 + c_nationkey', '=0', '=100 + c_nationkey', '=101 + c_nationkey')} end as n_rows, "
    f"case when c_custkey % 13 > 0 then case when c_custkey % 11 = 0 then 't' else 's' end end as schema_digest, case when c_custkey % 13 > 0 then case when c_custkey % 7 in (0, 1, 5) then 'f' || c_custkey else 'g' || c_custkey end end as fingerprint, "
    f"case when c_custkey % 13 > 0 then c_custkey % 7 = 1 end as write_confirmed from customer where c_custkey % 9 > 0"
)


@query(f"select path, case when a.readable is null then 'missing' when not a.readable then 'unreadable' when a.n_rows = 0 then 'empty' when b.readable is null or not b.readable then 'created' when a.schema_digest <> b.schema_digest then 'schema_changed' when a.fingerprint is not distinct from b.fingerprint and a.n_rows = b.n_rows then case when coalesce(write_confirmed, false) then 'rewritten' else 'identical' end when a.n_rows < 0.7 * b.n_rows then 'dropped' else 'updated' end as outcome from {BEFORE.sql} b full join {AFTER.sql} a using (path)")
def baseline_compare(spark, d):
    return flow.baseline_compare(BEFORE.df(spark, d), AFTER.df(spark, d))


COPIES = C.Derived(f"select 'c' || o_orderkey as activity, case when o_orderkey % 19 > 0 then o_custkey end as rows_read, {C.pick('o_orderkey % 9', '=o_custkey - 1', '=o_custkey + 1', None, '=o_custkey')} as rows_copied, {C.pick('o_orderkey % 7', '=o_custkey - 2', '=o_custkey + 2', None, '=o_custkey')} as n_rows from orders")


@query(f"select activity, case when rows_read is null or rows_copied is null then 'UNKNOWN' when rows_copied < rows_read or coalesce(n_rows < rows_copied, false) then 'LOST' when rows_copied > rows_read or coalesce(n_rows > rows_copied, false) then 'GAINED' else 'BALANCED' end as outcome from {COPIES.sql}")
def copy_reconcile(spark, d):
    return flow.copy_reconcile(COPIES.df(spark, d))


INPUTS = C.Derived("select 'p' || c_custkey as path, c_custkey % 7 > 0 as exists, c_custkey % 7 > 0 and c_custkey % 5 > 0 as readable, case when c_custkey % 7 > 0 and c_custkey % 5 > 0 then cast(c_nationkey % 4 as bigint) end as n_rows from customer")


@query(f"select path, case when not \"exists\" then 'BLOCKER' when not readable then 'SKIPPED' when n_rows = 0 then 'WARNING' else 'OK' end as severity, case when not \"exists\" then 'absent' when not readable then 'unreadable' when n_rows = 0 then 'empty' else 'ok' end as reason from {INPUTS.sql}")
def input_check(spark, d):
    return flow.input_check(INPUTS.df(spark, d))


OUTPUTS = C.Derived(f"select 'p' || o_orderkey as path, {C.pick('o_orderkey % 6', '=o_orderdate + interval 5 minutes', '=o_orderdate - interval 30 seconds', '=o_orderdate - interval 2 minutes', '=o_orderdate - interval 60 seconds', '=o_orderdate', '=cast(null as timestamp)')} as written_at, o_orderdate as run_start, case when o_orderkey % 5 > 0 then o_custkey % 3 end as n_rows from orders")


@query(f"select path, case when written_at is null then 'ABSENT' when written_at < run_start - interval 60 seconds then 'BEFORE_RUN' when n_rows = 0 then 'EMPTY' else 'WRITTEN' end as outcome from {OUTPUTS.sql}")
def output_check(spark, d):
    return flow.output_check(OUTPUTS.df(spark, d))


TRANSFORMS = C.Derived(f"select 'f' || o_orderkey as flow, case when o_orderkey % 11 > 0 then o_custkey % 50 end as n_in, case when o_orderkey % 13 > 0 then {C.pick('o_orderkey % 5', '=o_custkey % 50', '=o_custkey % 20', '=o_custkey % 50 + 3', '=0', '=o_custkey % 50')} end as n_out, split({C.pick('o_custkey % 3', 'x,y', 'x', 'b,a,x')}, ',') as columns_in, split({C.pick('o_orderkey % 4', 'x,z', 'x', 'y', 'a,x,c')}, ',') as columns_out from orders")


@query(
    f"select flow, case when n_in is null or n_out is null then 'NOT_MEASURABLE' when n_out = 0 then 'EMPTY_OUTPUT' when n_out = n_in then 'SAME_COUNT' when n_out < n_in then 'SMALLER_OUTPUT' else 'LARGER_OUTPUT' end as outcome, n_out - n_in as delta, case when n_in > 0 then round(100.0 * n_out / n_in, 4)::double end as pct_kept, "
    f"array_to_string(list_sort(list_filter(columns_in, lambda x: list_contains(columns_out, x))), ',') as kept, array_to_string(list_sort(list_filter(columns_in, lambda x: not list_contains(columns_out, x))), ',') as dropped, array_to_string(list_sort(list_filter(columns_out, lambda x: not list_contains(columns_in, x))), ',') as derived from {TRANSFORMS.sql}"
)
def transformation_review(spark, d):
    return flow.transformation_review(TRANSFORMS.df(spark, d))


SEVERITIES = C.Derived(f"select 'f' || (o_custkey % 200) as flow, {C.pick('(o_orderkey * 7 + o_custkey) % 30', 'BLOCKER', 'WARNING', 'SKIPPED', 'OK')} as severity from orders")


@query(f"with w as (select flow, min(case severity when 'BLOCKER' then 1 when 'WARNING' then 2 when 'SKIPPED' then 3 else 4 end) as r from {SEVERITIES.sql} group by 1) select flow, case r when 1 then 'BLOCKER' when 2 then 'WARNING' when 3 then 'SKIPPED' else 'OK' end as worst, case r when 1 then 'FAILS' when 2 then 'PASSES_WITH_WARNINGS' when 3 then 'PASSES_WITH_OMISSIONS' else 'PASSES' end as verdict from w")
def worst_of(spark, d):
    return flow.worst_of(SEVERITIES.df(spark, d))


RAW_PATHS = C.Derived(
    "select distinct " + C.pick("c_custkey % 7", "='Files/@{x' || (c_custkey % 30) || '}/y'", "='Files/' || chr(36) || '{day}/z' || (c_custkey % 30)", "='Files/{{name' || (c_custkey % 30) || '}}'", "='Tables/ok' || (c_custkey % 30)", "='Files/<hole>/@concat(a' || (c_custkey % 30) || ')'", "='a/??/b' || (c_custkey % 30)", "=chr(36) || '(dir)/{{t}}/' || (c_custkey % 30)")
    + " as path from customer"
)


@query(f"select * from (select path, concat_ws(',', case when regexp_matches(path, '@\\{{|@[a-zA-Z]+\\(') then 'expression' end, case when contains(path, '??') then 'hole' end, case when regexp_matches(path, '<[A-Za-z_][^>]*>') then 'placeholder' end, case when regexp_matches(path, '\\{{\\{{[^}}]*\\}}\\}}') then 'template' end, case when regexp_matches(path, '\\$\\{{[^}}]*\\}}|\\$\\([^)]*\\)') then 'variable' end) as traces from {RAW_PATHS.sql}) t where traces <> ''")
def unresolved_paths(spark, d):
    return flow.unresolved_paths(RAW_PATHS.df(spark, d))


FLIGHTS = C.Derived(
    f"select 'f' || c_custkey as flow, {C.pick('c_custkey % 9', 'prod', None, 'qa')} as environment, {C.pick('c_custkey % 7', '', None, 'main')} as entry_point, split('Tables/x' || c_nationkey || ',' || {C.pick('c_custkey % 8', 'Tables/prod/x', 'Files/@{x}', 'Tables/qa/x', 'Tables/x_dev_y', 'Tables/products')}, ',') as paths, "
    "cast(c_nationkey % 4 as int) as outputs, 'qa' as expected_environment from customer"
)


@query(f"with t as (select flow, environment is not distinct from expected_environment as p1, coalesce(entry_point <> '', false) as p2, not regexp_matches(array_to_string(paths, ','), '@\\{{') as p3, not regexp_matches(array_to_string(paths, ','), '(^|[/_,-])(dev|prod)([/_,-]|$)') as p4, outputs > 0 as p5 from {FLIGHTS.sql}) select flow, p1 as \"P1\", p2 as \"P2\", p3 as \"P3\", p4 as \"P4\", p5 as \"P5\", case when not (p1 and p2 and p4) then 'BLOCKER' when not (p3 and p5) then 'WARNING' else 'OK' end as verdict from t")
def preflight(spark, d):
    return flow.preflight(FLIGHTS.df(spark, d))


WINDOWS = C.Derived("select 't' || c_custkey as table_name, c_custkey % 7 > 0 as has_window, c_custkey % 5 > 0 as has_log, cast(c_nationkey % 3 as int) as n_commits from customer")


@query(f"select table_name, case when not has_window then 'NOT_EVALUATED' when not has_log then 'NOT_APPLICABLE' when n_commits > 0 then 'OK' else 'ERROR' end as state from {WINDOWS.sql}")
def cp05(spark, d):
    return flow.cp05(WINDOWS.df(spark, d))


EVIDENCE = C.Derived(
    f"select 'f' || o_orderkey as flow, {C.pick('o_orderkey % 5', 'Failed', 'Completed', 'Completed', None, 'Completed')} as run_state, cast({C.pick('o_custkey % 4', '=1', '=0', None, '=0')} as int) as failed_activities, "
    f"case when o_orderkey % 7 > 0 then o_custkey end as rows_read, case when o_orderkey % 8 = 0 then o_custkey - 1 else o_custkey end as rows_copied, {C.pick('o_custkey % 6', '=0', None, '=o_custkey')} as output_rows, "
    f"{C.pick('o_orderkey % 6', '=cast(null as timestamp)', '=o_orderdate + interval 10 minutes', '=o_orderdate + interval 40 minutes', '=o_orderdate - interval 1 minutes', '=o_orderdate')} as commit_ts, o_orderdate as start, o_orderdate + interval 30 minutes as until, "
    f"{C.pick('o_orderkey % 4', '=cast(null as timestamp)', '=o_orderdate - interval 5 minutes', '=o_orderdate + interval 5 minutes', '=o_orderdate')} as input_commit_ts, case when o_orderkey % 9 > 0 then o_custkey % 5 end as measured_version, case when o_custkey % 9 > 0 then o_orderkey % 5 end as written_version from orders",
    until="end",
)
_CHECKS = {
    "run_completed": "run_state = 'Completed'", "activities_succeeded": "failed_activities = 0", "copies_balanced": "rows_read = rows_copied", "outputs_have_rows": "output_rows > 0",
    "output_committed_in_window": "(commit_ts >= start and commit_ts <= until)", "input_unchanged_after_start": "input_commit_ts <= start", "measured_version_written": "measured_version = written_version",
}


@query(" union all ".join(f"select flow, '{k}' as \"check\", case when {c} is null then 'not_evaluated' when {c} then 'ok' else 'fails' end as word from {EVIDENCE.sql}" for k, c in _CHECKS.items()))
def flow_checks(spark, d):
    return flow.flow_checks(EVIDENCE.df(spark, d))


NOTES = C.Derived(f"select o_orderkey as id, {C.pick('o_orderkey % 6', '=chr(105) || chr(32) || chr(48) || chr(48) || chr(49) || lpad(cast(o_custkey as string), 7, chr(48)) || chr(32) || o_orderpriority', '=o_orderpriority || chr(34) || o_orderpriority || o_orderstatus || chr(32) || o_custkey || chr(34) || o_orderstatus', '=chr(48) || chr(48) || chr(50) || lpad(cast(o_custkey as string), 7, chr(48))', None, '=chr(34) || o_orderstatus || chr(34)', '=o_orderpriority')} as note from orders")


@query(f"""select id, regexp_replace(regexp_replace(note, '\\b(001\\d)\\d{{6}}\\b', '\\1******', 'g'), '"[^"]{{10,}}"', '"***"', 'g') as masked from {NOTES.sql}""")
def mask_pii(spark, d):
    return NOTES.df(spark, d).select("id", flow.masked(F.col("note")).alias("masked"))


CALLS = C.Derived(f"select 'r' || (o_orderkey % 3000 - o_orderkey % 2) as request_id, cast(o_orderkey as int) as ts, {C.pick('o_custkey % 4', 'qa', 'dev', 'ops', 'qa')} as actor, {C.pick('o_orderkey % 3000 % 10', 'big-1', 'big-1', 'big-2-fast', 'big-2-fast', 'small', 'small', 'other')} as model, 'x' || (o_custkey % 9) as run_id, o_custkey as input_tokens, o_orderkey % 100 as output_tokens from orders")
#: The price list: a prefix per size of part.
PRICES = C.Derived("select distinct case when p_size < 10 then 'big' when p_size < 20 then 'big-2' else 'small' end as prefix, cast(case when p_size < 10 then 3 when p_size < 20 then 5 else 1 end as double) as input_price, cast(case when p_size < 10 then 15 when p_size < 20 then 25 else 5 end as double) as output_price from part")


@query(
    f"with c as (select * from {CALLS.sql} qualify row_number() over (partition by request_id order by ts desc) = 1), s as (select actor, model, count(*) as n_calls, count(distinct run_id) as n_runs, sum(input_tokens)::bigint as input_tokens, sum(output_tokens)::bigint as output_tokens from c group by 1, 2) "
    f"select s.*, round((s.input_tokens * p.input_price + s.output_tokens * p.output_price) / 1000000, 6) as cost from s left join lateral (select * from {PRICES.sql} p where starts_with(s.model, p.prefix) order by length(prefix) desc limit 1) p on true"
)
def usage_by_actor(spark, d):
    return ops.usage_by_actor(CALLS.df(spark, d), PRICES.df(spark, d))


@query("select event_type as action, count(value) as n, round(median(value), 6) as median_s from events group by 1")
def median_duration(spark, d):
    return ops.median_duration(_events(spark, d).select(F.col("event_type").alias("action"), F.col("value").alias("seconds")))


EXPECTED = C.Derived("select 'd=' || (o_orderkey % 90) as part, 'f' || o_orderkey as file from orders")
PRESENT = C.Derived("select 'f' || o_orderkey as file from orders where o_orderkey % 90 > 9 and (o_orderkey % 90 % 2 = 0 or o_custkey % 3 > 0) union all select 'f' || o_orderkey from orders where o_orderkey % 50 = 0 and o_orderkey % 90 > 9 and o_orderkey % 90 % 2 = 0")


@query(f"with j as (select e.part, count(*) as n_expected, count(p.file) as n_present from {EXPECTED.sql} e left join (select distinct file from {PRESENT.sql}) p using (file) group by 1) select *, case when n_present = n_expected then 'COMPLETE' when n_present = 0 then 'MISSING' else 'PARTIAL' end as state from j")
def partition_completeness(spark, d):
    return ops.partition_completeness(EXPECTED.df(spark, d), PRESENT.df(spark, d))


SIZES = C.Derived("select 't' || c_custkey as table_name, case when c_custkey % 9 = 0 then c_custkey * 5000000 else c_custkey * 100 end as n_rows, cast(c_nationkey * 4 + 1 as int) as n_columns, case when c_custkey % 8 = 0 then 6442450944 + c_custkey else c_custkey * 1000 end as n_bytes from customer")
RATES = C.Derived("select cast(1000000 * (n_nationkey % 3 + 1) as double) as rate from nation where n_nationkey < 24")


@query(f"select table_name, (2 + ceil(n_columns / 14.0))::bigint as passes, round(n_rows * (2 + ceil(n_columns / 14.0)) / 2000000.0, 3)::double as seconds, n_rows > 100000000 or n_bytes > {5 * 2**30} as big from {SIZES.sql}")
def estimate_cost(spark, d):
    return ops.estimate_cost(SIZES.df(spark, d), RATES.df(spark, d))
