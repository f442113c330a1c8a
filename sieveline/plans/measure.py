"""Queries on one table: scans, canonical text, fingerprints, profiles, rules, contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import canon
from sieveline.operators import compare, fingerprint, profile, rules
from sieveline.plans import common as C
from sieveline.sources import scans

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


L, O, CU = C.columns("lineitem"), C.columns("orders"), C.columns("customer")


@query("select l_returnflag, l_linestatus, count(*) as n, cast(sum(l_quantity) as bigint) as quantity from lineitem where l_shipdate >= timestamp '1995-01-01' group by 1, 2")
def scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    df = scans.parquet_folder(spark, f"{d}/lineitem.parquet").where("l_shipdate >= timestamp_ntz'1995-01-01'")
    return df.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


@query("select * from (values (0,'o_orderkey','bigint',true),(1,'o_custkey','bigint',true),(2,'o_orderstatus','string',true),(3,'o_totalprice','double',true),(4,'o_orderdate','timestamp_ntz',true),(5,'o_orderpriority','string',true)) t(position,column_name,data_type,nullable)")
def schema_catalog(spark, d):
    return fingerprint.schema_table(C.source(spark, d))


_ORDERS_TYPES = {"o_custkey": "bigint", "o_orderdate": "timestamp_ntz", "o_orderkey": "bigint", "o_orderpriority": "string", "o_orderstatus": "string", "o_totalprice": "double"}
_join = lambda f: "||".join(f(n, t) for n, t in sorted(_ORDERS_TYPES.items()))


@query(f"select sha256('{_join(lambda n, t: f'{n}|{t}|true')}') as strict, sha256('{_join(lambda n, t: f'{n}|{t}')}') as types, sha256('{_join(lambda n, t: n)}') as names")
def schema_fingerprints(spark, d):
    return fingerprint.schema_fingerprints(C.source(spark, d))


@query(f"select {', '.join(f'{C.canon_sql(c, k)} as {c}' for c, k in O)} from orders")
def canonical_rows(spark, d):
    df = C.source(spark, d)
    return df.select(*[e.alias(n) for n, e in canon.canonical_columns(df).items()])


@query(f"select o_orderkey, {C.digest_sql(O)} as h from orders")
def row_digest(spark, d):
    return fingerprint.row_digests(C.source(spark, d)).select("o_orderkey", "h")


def _fingerprint_sql(table: str, cols, extra: str = "") -> str:
    return (
        f"with {extra + ',' if extra else ''} h as (select {C.digest_sql(cols)} as h from {table}), t as (select count(*) as n_rows, count(distinct h) as n_distinct, {C.sums_sql('h')} from h) "
        f"select n_rows, n_distinct, n_rows - n_distinct as n_duplicates, s1, s2, s3, s4, {C.final_sql('n_rows', 's1', 's2', 's3', 's4')} as fingerprint from t"
    )


@query(_fingerprint_sql("lineitem", L))
def dataset_fingerprint(spark, d):
    return fingerprint.dataset_fingerprint(C.table(spark, d, "lineitem"))


@query(f"with {C.TARGET_SQL}, h as (select {C.digest_sql(O)} as h from tgt) select count(*) as n_rows, count(distinct h) as n_distinct, count(*) - count(distinct h) as n_duplicates from h")
def dup_rows(spark, d):
    return fingerprint.duplicate_rows(C.target(spark, d))


@query(f"with {C.TARGET_SQL} select count(*) as n_rows, count(distinct md5(concat_ws(chr(1), {', '.join(C.canon_sql(c, k) for c, k in O)}))) as n_distinct from tgt")
def dup_rows_md5(spark, d):
    df = C.target(spark, d)
    h = F.md5(F.concat_ws(canon.SEPARATOR, *canon.canonical_columns(df).values()))
    return df.groupBy(h.alias("h")).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))


_COLUMN_PRINTS = " union all ".join(f"select '{c}' as column_name, count(*) as n_rows, {C.column_final_sql(c, k)} as fingerprint from lineitem" for c, k in L)


@query(_COLUMN_PRINTS)
def column_fingerprints(spark, d):
    return fingerprint.column_fingerprints(C.table(spark, d, "lineitem"))


@query(f"with c as ({_COLUMN_PRINTS}) select count(*) as n_columns, sha256(string_agg(fingerprint, '|' order by fingerprint)) as fingerprint from c")
def column_set_fingerprint(spark, d):
    return fingerprint.column_set_fingerprint(C.table(spark, d, "lineitem"))


_BAD = " or ".join(f"{c} is null or trim({c}, ' ') = '' or regexp_matches({c}, '[^\\x00-\\x7F]|[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]')" for c in ("text", "lang", "source"))


@query(
    f"with h as (select {C.digest_sql(C.columns('documents'))} as h, ({_BAD}) as bad from documents), "
    f"t as (select 'clean' as part, count(*) filter (where not bad) as n_rows, {C.sums_sql('h', 'not bad')} from h union all select 'affected', count(*) filter (where bad), {C.sums_sql('h', 'bad')} from h) "
    f"select part, n_rows, {C.final_sql('n_rows', 's1', 's2', 's3', 's4')} as fingerprint from t"
)
def segregation(spark, d):
    return fingerprint.segregation(C.table(spark, d, "documents"))


# CRC-32 as its definition has it: a table of 256 words made by eight steps each, then a step per character (ASCII: per byte)
_CRC_WORD = "list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)"


def _crc_sql(table: str, kinds: dict[str, str]) -> str:
    text = f"concat_ws(chr(1), {', '.join(C.canon_sql(c, k) for c, k in sorted(C.columns(table)))})"
    return (
        f"with t as (select {text} as text from {table}), words as (select list({_CRC_WORD} order by x) as w from (select unnest(range(256)) as x)), "
        "c as (select xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(text, ''), lambda ch: ascii(ch)::bigint)), lambda crc, ch: xor(crc >> 8, words.w[(xor(crc, ch) & 255) + 1])), 4294967295) as crc from t, words) "
        f"select count(*) as n_rows, cast(sum(crc) as varchar) as crc_sum, substr(sha256('{'|'.join(f'{c}:{kinds.get(k, k)}' if c not in kinds else f'{c}:{kinds[c]}' for c, k in sorted(C.columns(table)))}'), 1, 16) as schema_digest from c"
    )


@query(_crc_sql("lineitem", {"i": "bigint", "f": "double", "s": "string", "t": "timestamp_ntz", "l_linenumber": "int"}))
def crc_fingerprint(spark, d):
    return fingerprint.crc_fingerprint(C.table(spark, d, "lineitem"))


def _each(cols, body: str, table: str, head: str = "") -> str:
    return head + " union all ".join(f"select '{c}' as column_name, {body.replace('{c}', c)} from {table}" for c, *_ in cols)


_WITH = f"with {C.TARGET_SQL} "


@query(_each(O, "count(*) as n_rows, count({c}) as non_null, count(*) - count({c}) as nulls, round(100.0 * (count(*) - count({c})) / count(*), 4)::double as pct_null", "tgt", _WITH))
def profile_nulls(spark, d):
    return profile.nulls(C.target(spark, d))


@query(_each(L, "count(distinct {c}) as n_distinct", "lineitem"))
def profile_distinct(spark, d):
    return profile.distincts(C.table(spark, d, "lineitem"))


def _decimal(c: str, k: str) -> str:
    return f"cast(cast({c} as varchar) as decimal(38,10))" if k == "f" else f"cast({c} as decimal(38,0))"


def _number(c: str, k: str) -> str:
    """Ten decimals where they are the number, else its shortest text, in the form 1.0E30."""
    if k != "f":
        return f"cast({c} as varchar)"
    fixed = f"try_cast(cast({c} as varchar) as decimal(38,10))"
    plain = f"cast({c} as varchar)"
    mantissa, exponent = f"split_part({plain}, 'e', 1)", f"cast(cast(split_part({plain}, 'e', 2) as integer) as varchar)"
    return f"case when isinf({c}) then case when {c} > 0 then 'Infinity' else '-Infinity' end when cast({fixed} as double) = {c} then cast({fixed} as varchar) when contains({plain}, 'e') then {mantissa} || case when contains({mantissa}, '.') then '' else '.0' end || 'E' || {exponent} else {plain} end"


def _numeric_sql(cols, table: str) -> str:
    parts = []
    for c, k in cols:
        fine = f"case when not isnan({c}) and not isinf({c}) then {c} end" if k == "f" else c
        fixed = f"try_cast(cast({fine} as varchar) as decimal(38,10))" if k == "f" else f"cast({c} as decimal(38,0))"
        inexact = f"count(*) filter (where coalesce(cast({fixed} as double) <> {fine}, {fine} is not null))" if k == "f" else "0::bigint"
        parts.append(
            f"select '{c}' as column_name, {_number(f'min({fine})', k)} as minimum, {_number(f'max({fine})', k)} as maximum, cast(sum({fixed}) as varchar) as exact_sum, count(*) filter (where {c} = 0) as zeros, count(*) filter (where {c} < 0) as negatives, "
            f"{f'count(*) filter (where isnan({c}))' if k == 'f' else '0::bigint'} as nans, {f'count(*) filter (where isinf({c}))' if k == 'f' else '0::bigint'} as infinities, {inexact} as inexact, "
            f"case when {inexact} = 0 then round(cast(sum({fixed}) as double) / count({fine}), 6) else avg({fine}) end as mean from {table}"
        )
    return " union all ".join(parts)


@query(_numeric_sql([c for c in L if c[1] in "if"], "lineitem"))
def profile_numeric(spark, d):
    return profile.numeric(C.table(spark, d, "lineitem"))


#: Values whose sums are exact in doubles in any order: large and tiny powers of two, whole numbers beyond 2**53, NaN, infinities.
EXTREMES = C.Derived(
    f"select {C.pick('l_orderkey % 4', '=cast(1180591620717411303424 as double) * l_linenumber', None, '=cast(-1180591620717411303424 as double)', '=cast(0 as double)')} as wide, "
    f"{C.pick('l_orderkey % 3', '=cast(l_linenumber as double) / 1152921504606846976', '=cast(0.125 as double)', None)} as tiny, "
    f"{C.pick('l_orderkey % 3', '=9007199254740993', '=l_orderkey - 9007199254740993', '=l_partkey')} as big, "
    f"{C.pick('l_partkey % 5', '=cast(chr(78) || chr(97) || chr(78) as double)', '=cast(l_linenumber as double)', '=l_quantity', None, '=l_quantity')} as few, "
    f"{C.pick('l_linenumber % 3', '=cast(1 as double)', '=cast(chr(73) || chr(110) || chr(102) || chr(105) || chr(110) || chr(105) || chr(116) || chr(121) as double)')} as far from lineitem"
)


EXTREME_COLUMNS = [("wide", "f"), ("tiny", "f"), ("big", "i"), ("few", "f"), ("far", "f")]


@query(f"select * replace (round(mean, 0) as mean) from ({_numeric_sql(EXTREME_COLUMNS, EXTREMES.sql)})")
def profile_numeric_extremes(spark, d):
    return profile.numeric(EXTREMES.df(spark, d)).withColumn("mean", F.round("mean", 0))


def _quartiles_sql(cols, table: str) -> str:
    parts = []
    for c, k in cols:
        value = f"case when not isnan({c}) then {c} end" if k == "f" else c
        parts.append(f"select '{c}' as column_name, " + ", ".join(f"{_number(f'quantile_disc({value}, {p})', k)} as p{round(100 * p)}" for p in (0.25, 0.5, 0.75)) + f" from {table}")
    return " union all ".join(parts)


@query(_quartiles_sql([c for c in L if c[1] in "if"], "lineitem"))
def profile_quartiles(spark, d):
    return profile.quartiles(C.table(spark, d, "lineitem"))


@query(_quartiles_sql(EXTREME_COLUMNS, EXTREMES.sql))
def profile_quartiles_extremes(spark, d):
    return profile.quartiles(EXTREMES.df(spark, d))


_SENT = ", ".join(C._literal(x) for x in profile.SENTINEL_TEXTS)


def _text_sql(cols, table: str, head: str = "") -> str:
    return _each(
        cols,
        "min(length({c}))::int as min_length, max(length({c}))::int as max_length, min({c}) as min_value, max({c}) as max_value, count(*) filter (where length({c}) = 0) as empty, "
        "count(*) filter (where length({c}) > 0 and length(trim({c}, ' ')) = 0) as only_spaces, count(*) filter (where {c} <> trim({c}, ' ')) as edge_spaces, "
        f"count(*) filter (where trim({{c}}, ' ') in ({_SENT})) as sentinels, count(*) filter (where {{c}} = upper({{c}}) and length(trim({{c}}, ' ')) > 0) as all_capital",
        table, head,
    )


@query(_text_sql([c for c in O if c[1] == "s"], "tgt", _WITH))
def profile_text(spark, d):
    return profile.text(C.target(spark, d))


_K = "lpad(cast(p_partkey as string), 5, '0')"
MIXED = C.Derived(
    f"select {C.pick('p_partkey % 6', '001', '12', 'ab', None, '00', '=cast(p_size as string)')} as code, {C.pick('p_partkey % 6', '1.50', '-3', '1,5', '.5', '1.', '=cast(p_size as string)')} as amount, "
    f"{C.pick('p_partkey % 6', '2024-01-05', '20240105', '05/01/2024', '2024/01/05', 'x', '2024-1-5')} as day, case when p_partkey % 6 <> 3 then 'p' || p_partkey || '@x.org' end as mail, "
    f"{C.pick('p_partkey % 6', '=upper(p_name)', '= chr(32) || p_name', '=p_name || chr(233)', '', 'N/A', '=chr(9) || p_name')} as name, {_K} as zero, cast(p_size as string) as whole, '2024-01-' || lpad(cast(p_size % 28 + 1 as string), 2, '0') as dated from part"
)


MIXED_NAMES = ["code", "amount", "day", "mail", "name", "zero", "whole", "dated"]


def _forensics_sql(cols, table: str) -> str:
    rx = {k: p.replace("\\z", "$") for k, p in profile.FORENSICS.items()}
    return _each(cols, ", ".join(f"count(*) filter (where regexp_matches({{c}}, {C._literal(p)})) as {k}" for k, p in rx.items()), table)


@query(_forensics_sql([(n,) for n in MIXED_NAMES], MIXED.sql) + " union all " + _forensics_sql([("lang",), ("source",), ("text",)], "documents"))
def profile_text_forensics(spark, d):
    return profile.text_forensics(MIXED.df(spark, d)).unionByName(profile.text_forensics(C.table(spark, d, "documents")))


@query(
    _each([("o_orderdate",)], "strftime(min({c}), '%Y-%m-%d %H:%M:%S') as minimum, strftime(max({c}), '%Y-%m-%d %H:%M:%S') as maximum, count(distinct cast({c} as date)) as n_days, "
    "count(*) filter (where cast({c} as date) > date '1998-01-01') as future, count(*) filter (where cast({c} as date) < date '1900-01-01') as before_1900, "
    "count(*) filter (where strftime({c}, '%Y-%m-%d') in ('0001-01-01', '1900-01-01', '1970-01-01', '9999-12-31', '2099-12-31')) as sentinels", "orders")
)
def profile_date(spark, d):
    return profile.dates(C.source(spark, d), "1998-01-01")


@query(_each([("high",), ("late",)], "count(*) filter (where {c}) as n_true, count(*) filter (where not {c}) as n_false", "(select o_totalprice > 150000 as high, case when o_orderkey % 5 > 0 then o_orderdate > timestamp '1996-01-01' end as late from orders)"))
def profile_bool(spark, d):
    late = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderdate") > F.lit("1996-01-01").cast("timestamp_ntz"))
    return profile.booleans(C.source(spark, d).select((F.col("o_totalprice") > 150000).alias("high"), late.alias("late")))


@query("select 'raw' as column_name, min(octet_length(encode(text)))::int as min_bytes, max(octet_length(encode(text)))::int as max_bytes from documents")
def profile_binary(spark, d):
    return profile.binaries(C.table(spark, d, "documents").select(F.col("text").cast("binary").alias("raw")))


SIGNED = C.Derived("select case when l_linenumber % 3 = 0 then cast(0 as double) * -1 when l_linenumber % 3 = 1 then cast(0 as double) else l_quantity end as zero from lineitem")


@query(f"select 'zero' as column_name, count(distinct zero) as n_distinct from (select case when zero = 0 then 0 else zero end as zero from {SIGNED.sql})")
def distinct_signed_zeros(spark, d):
    """0.0 and -0.0 are one value."""
    return profile.distincts(SIGNED.df(spark, d))


@query(f"with n as (select cast(zero as varchar) as value, count(*) as frequency from (select case when zero = 0 then cast(0 as double) else zero end as zero from {SIGNED.sql}) group by 1) select 'zero' as column_name, (row_number() over (order by frequency desc, value))::int as place, value, frequency, round(100.0 * frequency / sum(frequency) over (), 4)::double as pct from n order by frequency desc, value limit 5")
def frequent_signed_zeros(spark, d):
    return profile.frequent_values(SIGNED.df(spark, d))


def _derived_sql(cols, table: str, head: str = "") -> str:
    return _each(cols, "count(distinct {c}) as n_distinct, case when count({c}) > 0 then round(100.0 * count(distinct {c}) / count({c}), 4)::double end as pct_distinct, coalesce(min({c}) = max({c}), count(distinct {c}) = 1) as is_constant, count({c}) = count(*) and count(*) > 0 and count(distinct {c}) = count(*) as candidate_key", table, head)


@query(_derived_sql(O, "tgt", _WITH))
def profile_derived(spark, d):
    return profile.derived(C.target(spark, d))


@query(
    "with f as (" + " union all ".join(f"select '{n}' as column_name, {n} as v from {MIXED.sql}" for n in MIXED_NAMES) + "), "
    "t as (select column_name, count(*) - count(v) + count(*) filter (where length(v) = 0) + count(*) filter (where length(v) > 0 and trim(v, ' ') = '') as effective_nulls, count(v) as nn, "
    + ", ".join(f"count(*) filter (where regexp_matches(v, {C._literal(p.replace(chr(92) + 'z', '$'))})) as {k}" for k, p in profile.FORENSICS.items())
    + " from f group by 1) select column_name, effective_nulls, case when nn > 0 and integer_text = nn and leading_zero = 0 then 'NUMBER_AS_TEXT' when nn > 0 and leading_zero > 0.9 * nn then 'CODE_WITH_LEADING_ZEROS' when nn > 0 and date_text = nn then 'DATE_AS_TEXT' when nn > 0 and email = nn then 'EMAIL' else 'TEXT' end as semantic_type from t"
)
def semantic_types(spark, d):
    return profile.semantic_types(MIXED.df(spark, d))


# the oracle chooses the columns too: at most 1000 distinct values, the 25 with the fewest first
@query(
    "with v as (" + " union all ".join(f"select '{c}' as column_name, {C.canon_sql(c, k) if k == 't' else f'cast({c} as varchar)'} as value from lineitem" for c, k in L) + "), "
    "n as (select column_name, value, count(*) as frequency from v group by 1, 2), s as (select column_name from n group by 1 having count(value) <= 1000 order by count(value), column_name limit 25), "
    "r as (select n.*, sum(frequency) over (partition by column_name) as n_rows, row_number() over (partition by column_name order by frequency desc, value nulls first) as place from n join s using (column_name)) "
    "select column_name, place::int as place, value, frequency, round(100.0 * frequency / n_rows, 4)::double as pct from r where place <= 5"
)
def frequent_values(spark, d):
    return profile.frequent_values(C.table(spark, d, "lineitem"))


def _names(cond: str, of: str) -> str:
    return f"(select coalesce(string_agg(column_name, ',' order by column_name) filter (where {cond}), '') from {of})"


@query(
    f"with {C.TARGET_SQL}, n as ({_each(O, 'count(*) as n_rows, count({c}) as nn', 'tgt')}), d as ({_derived_sql(O, 'tgt')}), h as (select count(*) - count(distinct {C.digest_sql(O)}) as dup, count(*) as n from tgt) "
    "select 'ID-01' as code, case when n > 0 then 'OK' else 'ERROR' end as state, cast(n as varchar) as evidence from h "
    "union all select 'ID-02', case when dup = 0 then 'OK' else 'ALERT' end, cast(dup as varchar) from h "
    f"union all select 'ID-03', case when {_names('nn = 0', 'n')} = '' then 'OK' else 'ALERT' end, {_names('nn = 0', 'n')} "
    f"union all select 'ID-04', 'INFO', {_names('nn < n_rows', 'n')} "
    f"union all select 'ID-05', case when {_names('candidate_key', 'd')} = '' then 'ALERT' else 'OK' end, {_names('candidate_key', 'd')} "
    f"union all select 'ID-06', case when {_names('is_constant', 'd')} = '' then 'OK' else 'INFO' end, {_names('is_constant', 'd')}"
)
def rules_integrity(spark, d):
    return rules.integrity(C.target(spark, d))


def _odd_schema(spark: SparkSession, d: str) -> DataFrame:
    customers = C.table(spark, d, "customer")
    return customers.selectExpr("c_custkey as `a b`", "c_name as ok", "c_nationkey as `OK_`", "cast(c_acctbal as decimal(38,2)) as num", "null as nothing", "array(c_custkey) as list", f"c_mktsegment as `{'x' * 130}`")


@query(f"select * from (values ('VG-01','OK',''),('VG-02','ERROR','a b'),('VG-03','ERROR','nothing'),('VG-04','OK',''),('VG-05','INFO','list'),('VG-06','ALERT','{'x' * 130}')) t(code,state,evidence)")
def rules_schema(spark, d):
    return rules.schema_rules(_odd_schema(spark, d))


@query("select 2::bigint as n_ok, 1::bigint as n_alert, 2::bigint as n_error, 1::bigint as n_info, 'ERROR' as state")
def rules_overall(spark, d):
    return rules.overall(rules.schema_rules(_odd_schema(spark, d)))


_DUCK_TYPES = {"i": "bigint", "s": "string", "f": "double", "t": "timestamp_ntz"}


def contract_sql(table: str, cols, kinds: dict[str, str]) -> str:
    """A table's observed contract; ``kinds`` are types that the categories don't tell."""
    return " union all ".join(
        f"select {i} as position, '{c}' as column_name, '{kinds.get(c, _DUCK_TYPES[k])}' as data_type, count(*) > count({c}) as nullable, round(100.0 * (count(*) - count({c})) / count(*), 4)::double as pct_null, "
        f"count(distinct {c}) as n_distinct, {f'max(length({c}))::int' if k == 's' else 'null::int'} as max_length, count(distinct {c}) = count(*) as candidate_key, {C.column_final_sql(c, k)} as fingerprint from {table}"
        for i, (c, k) in enumerate(cols)
    )


@query(contract_sql("customer", CU, {"c_nationkey": "int"}))
def contract(spark, d):
    return rules.contract(C.table(spark, d, "customer"))


@query(
    f"with {C.TARGET_SQL}, s as ({_each(O, 'count(*) as n, count(*) - count({c}) as nulls', 'orders')}), f as ({_each(O, 'count(*) as n, count(*) - count({c}) as nulls', 'tgt')}) "
    "select s.column_name, 'nulls' as metric, round(100.0 * s.nulls / s.n, 4)::double as source_pct, round(100.0 * f.nulls / f.n, 4)::double as target_pct from s join f using (column_name) where abs(100.0 * s.nulls / s.n - 100.0 * f.nulls / f.n) > 0.5"
)
def profile_normalised(spark, d):
    return compare.normalised_profile(profile.nulls(C.source(spark, d)), profile.nulls(C.target(spark, d)), ["nulls"])


@query("select 'loaded_at' as column_name, '2024-01-01' as source_value, '2024-02-01' as target_value")
def load_stamp(spark, d):
    s, f = (C.source(spark, d).select("o_orderkey", F.lit(v).alias("loaded_at"), F.lit("x").alias("same")) for v in ("2024-01-01", "2024-02-01"))
    return compare.load_stamps(profile.bounds(s), profile.bounds(f))


@query(f"select * from (select {', '.join(f'{C.canon_sql(c, k)} as {c}' for c, k in O)} from orders) order by {C.digest_sql([(c, 's') for c, _ in O])} limit 10")
def sample10(spark, d):
    """Ten rows by the order of their digests: the same rows however the table is stored."""
    return fingerprint.sample(C.source(spark, d), 10)
