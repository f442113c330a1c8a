"""Lineage over flow inputs and outputs: edges, waves, closures, roles, and what a run read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normal_path(c: Column) -> Column:
    """A path without scheme and host, doubled or closing slashes and case, as lineage compares it."""
    c = F.regexp_replace(F.trim(c), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/?", "")
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"/+", "/"), r"^/|/\z", ""))


def path_parts(c: Column) -> dict[str, Column]:
    """workspace, item and path of a storage URL, a lakehouse path, or a table name."""
    url = r"^abfss://([^@]+)@[^/]+/([^/]+)/(.*)\z"
    table = r"^(?:([A-Za-z0-9_]+)\.)?([A-Za-z0-9_]+)\.([A-Za-z0-9_]+)\z"
    is_url, is_table = c.rlike(url), c.rlike(table)
    none = F.lit(None).cast("string")
    return {
        "workspace": F.when(is_url, F.regexp_extract(c, url, 1)),
        "item": F.when(is_url, F.regexp_extract(c, url, 2)).when(is_table, F.nullif(F.regexp_extract(c, table, 1), F.lit(""))).otherwise(none),
        "path": F.when(is_url, F.regexp_extract(c, url, 3)).when(is_table, F.concat(F.lit("Tables/"), F.regexp_extract(c, table, 2), F.lit("/"), F.regexp_extract(c, table, 3))).otherwise(F.regexp_replace(c, r"^/|/\z", "")),
    }


def prefixes(path: Column) -> Column:
    """A path and all its parent folders."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat_ws("/", F.slice(parts, F.lit(1), i)))


def edges(io: DataFrame) -> DataFrame:
    """(producer, consumer, kind, path) from (flow, role, path): a flow reads what another writes.

    ``exact`` if the paths are equal, ``prefix`` if one is a folder of the other. Every path is exploded into its parent
    folders, so this is two equi-joins instead of a comparison of all pairs.
    """
    io = io.select("flow", "role", normal_path(F.col("path")).alias("path")).where("path <> ''").distinct()
    out = io.where("role = 'output'").select(F.col("flow").alias("producer"), F.col("path").alias("written"))
    inp = io.where("role = 'input'").select(F.col("flow").alias("consumer"), F.col("path").alias("read"))
    below = out.join(inp.withColumn("written", F.explode(prefixes(F.col("read")))), "written")
    above = inp.join(out.withColumn("read", F.explode(prefixes(F.col("written")))), "read").select("written", "producer", "consumer", "read")
    pairs = below.select("written", "producer", "consumer", "read").unionByName(above).where("producer <> consumer").distinct()
    return pairs.select("producer", "consumer", F.when(F.col("written") == F.col("read"), "exact").otherwise("prefix").alias("kind"), F.col("read").alias("path"))


def waves(flows: DataFrame, links: DataFrame, limit: int = 1000) -> DataFrame:
    """(flow, wave): the waves in which flows can run; flows of a cycle follow one by one after the others.

    One round per wave: what has no unfinished producer runs. A graph of flows is small, but it stays distributed; only
    the number of flows left is asked for.
    """
    left = flows.select("flow").distinct()
    links = links.select("producer", "consumer").where("producer <> consumer").distinct()
    done, wave, n = None, 0, left.count()
    while n and wave < limit:
        open_links = links.join(left.select(F.col("flow").alias("producer")), "producer", "left_semi").join(left.select(F.col("flow").alias("consumer")), "consumer", "left_semi")
        ready = left.join(open_links.select(F.col("consumer").alias("flow")), "flow", "left_anti")
        if left.sparkSession.sparkContext.getCheckpointDir():  # else the plan grows by a wave each round
            ready = ready.checkpoint()
        found = ready.count()
        if not found:  # a cycle: the rest one by one, by name
            from pyspark.sql import Window

            ready, found = left.withColumn("wave", F.row_number().over(Window.orderBy("flow")) - 1 + wave), n
        else:
            ready = ready.withColumn("wave", F.lit(wave))
        done = ready.select("flow", F.col("wave").cast("int").alias("wave")) if done is None else done.unionByName(ready.select("flow", F.col("wave").cast("int").alias("wave")))
        left, wave, n = left.join(ready.select("flow"), "flow", "left_anti"), wave + 1, n - found
    return done if done is not None else flows.select("flow", F.lit(0).alias("wave")).limit(0)


def closure(links: DataFrame, depth: int = 64) -> DataFrame:
    """(activity, before): everything that runs before an activity, over (activity, depends_on).

    By doubling: paths of length 1, 2, 4, ... until nothing is new, so a chain of n needs log n joins; cycles end too.
    """
    reach = links.select("activity", F.col("depends_on").alias("before")).dropna().distinct()
    n, step = reach.count(), 1
    while step < depth:
        nxt = reach.select("activity", F.col("before").alias("mid")).join(reach.select(F.col("activity").alias("mid"), "before"), "mid").select("activity", "before")
        grown = reach.unionByName(nxt).distinct()
        m = grown.count()
        if m == n:
            break
        reach, n, step = grown, m, step * 2
    return reach


def dependency_class(inputs: DataFrame, outputs: DataFrame, known: DataFrame) -> DataFrame:
    """(flow, path, class) of each input: self_read, direct, indirect (a folder of it is written), external or no_producer.

    ``known`` has the paths (path) that are known to come from outside.
    """
    inp = inputs.select("flow", normal_path(F.col("path")).alias("path")).distinct()
    out = outputs.select(F.col("flow").alias("by"), normal_path(F.col("path")).alias("written")).distinct()
    exact = inp.join(out, F.col("path") == F.col("written"), "left").groupBy("flow", "path").agg(F.max((F.col("by") == F.col("flow")).cast("int")).alias("own"), F.max((F.col("by") != F.col("flow")).cast("int")).alias("other"))
    folders = out.where("written <> ''").select(F.explode(prefixes(F.col("written"))).alias("p"), "by").distinct()
    near = inp.withColumn("p", F.explode(prefixes(F.col("path")))).join(out.withColumnRenamed("written", "p"), "p").where("by <> flow").select("flow", "path", F.lit(1).alias("near"))
    near = near.unionByName(inp.withColumn("p", F.col("path")).join(folders, "p").where("by <> flow").select("flow", "path", F.lit(1).alias("near"))).distinct()
    ext = known.select(normal_path(F.col("path")).alias("path"), F.lit(1).alias("ext")).distinct()
    all_ = exact.join(near, ["flow", "path"], "left").join(ext, "path", "left")
    kind = F.when(F.col("other") == 1, "direct").when(F.col("own") == 1, "self_read").when(F.col("near") == 1, "indirect").when(F.col("ext") == 1, "external").otherwise("no_producer")
    return all_.select("flow", "path", kind.alias("class"))


def in_windows(commits: DataFrame, runs: DataFrame, slack_s: int = 120, by: str | None = None) -> DataFrame:
    """(run_id, n_commits, first_ts, last_ts): commits (ts) within each run's window (start, end) and a slack on both ends.

    Commits and windows meet on time buckets of an hour (and on ``by``, such as the table), so the range join becomes an
    equi-join; runs without a commit have a count of 0.
    """
    bucket = lambda t: F.floor(F.unix_seconds(t.cast("timestamp")) / 3600)
    slack = F.expr(f"INTERVAL {int(slack_s)} SECONDS")
    w = runs.withColumns({"lo": F.col("start") - slack, "hi": F.col("end") + slack})
    keys = ["b"] + ([by] if by else [])
    spread = w.withColumn("b", F.explode(F.sequence(bucket(F.col("lo")), bucket(F.col("hi"))))).select(*keys, "run_id", "lo", "hi")
    hits = commits.select(bucket(F.col("ts")).alias("b"), "ts", *([by] if by else [])).join(spread, keys).where("ts between lo and hi")
    found = hits.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_commits"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return runs.select("run_id").join(found, "run_id", "left").fillna(0, ["n_commits"])


def asof(runs: DataFrame, commits: DataFrame, by: list[str], bucket_s: int = 86_400) -> DataFrame:
    """Each run with the last commit (ts, version) of its keys at or before its start: the version that it read.

    Both are put on one time line, which is cut into buckets: within a key's bucket the last commit is carried forward by a
    window, and over the borders the last one of all buckets before is, by a window over one row per key and bucket. So no
    task holds more of a hot key than a bucket of its history, and there is no range join. Commits of equal time count as
    before the run; of those, the highest version wins.
    """
    from pyspark.sql import Window

    commit = F.struct(F.col("ts").alias("commit_ts"), F.col("version").alias("version"))
    bucket = lambda t: F.floor(F.unix_seconds(F.col(t).cast("timestamp")) / bucket_s)
    c = commits.select(*by, F.col("ts").alias("at"), bucket("ts").alias("bucket"), F.lit(0).alias("kind"), commit.alias("commit"), F.lit(None).cast("long").alias("run_id"))
    r = runs.select(*by, F.col("start").alias("at"), bucket("start").alias("bucket"), F.lit(1).alias("kind"), F.lit(None).cast(c.schema["commit"].dataType).alias("commit"), F.col("run_id").cast("long").alias("run_id"))
    line = Window.partitionBy(*by, "bucket").orderBy("at", "kind", F.col("commit.version").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    inside = c.unionByName(r).withColumn("last", F.last("commit", ignorenulls=True).over(line)).where("kind = 1")
    ends = c.unionByName(r).groupBy(*by, "bucket").agg(F.max("commit").alias("commit"))
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*[F.col(k).alias(f"_{k}") for k in by], F.col("bucket").alias("_bucket"), F.last("commit", ignorenulls=True).over(before).alias("carried"))
    same = F.col("bucket").eqNullSafe(F.col("_bucket"))
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    out = inside.join(carried, same, "left").withColumn("last", F.coalesce("last", "carried"))
    return out.select("run_id", *by, F.col("at").alias("start"), F.col("last.commit_ts").alias("commit_ts"), F.col("last.version").alias("version"))


def flag_roles(flags: DataFrame) -> DataFrame:
    """(flag, role) by the name of a command-line flag: output words win over input words."""
    low = F.lower(F.regexp_replace("flag", r"^-+", ""))
    out = low.rlike(r"(^|[_-])(out|output|target|dest|destination|sink|salida|destino|write)([_-]|\z)")
    inp = low.rlike(r"(^|[_-])(in|input|source|src|origin|origen|entrada|read)([_-]|\z)")
    mode = low.rlike(r"(^|[_-])(mode|modo|savemode)([_-]|\z)")
    return flags.select("flag", F.when(mode, "mode").when(out, "output").when(inp, "input").otherwise("unknown").alias("role"))


def role_confirmation(roles: DataFrame, commits: DataFrame, runs: DataFrame) -> DataFrame:
    """(flow, path, role, confirmed): an output is confirmed by a commit in its run's window, an input by none."""
    hits = in_windows(commits.withColumnRenamed("path", "by_path"), roles.join(runs, "flow").select(F.concat_ws("|", "flow", "path").alias("run_id"), F.col("path").alias("by_path"), "start", "end"), by="by_path")
    both = roles.withColumn("run_id", F.concat_ws("|", "flow", "path")).join(hits, "run_id", "left")
    wrote = F.coalesce("n_commits", F.lit(0)) > 0
    return both.select("flow", "path", "role", F.when(F.col("role") == "output", wrote).otherwise(~wrote).alias("confirmed"))


def lineage_verdict(rows: DataFrame) -> DataFrame:
    """(path, verdict) from (path, origin): INGESTION over VARIABLE over CODE, else MANUAL."""
    has = lambda k: F.max((F.col("origin") == k).cast("int")) == 1
    return rows.groupBy("path").agg(F.when(has("copy"), "INGESTION").when(has("variable"), "VARIABLE").when(has("code"), "CODE").otherwise("MANUAL").alias("verdict"))


def context(nodes: DataFrame, links: DataFrame, start: str, hops: int = 2) -> DataFrame:
    """(node, hop) within ``hops`` steps of a node, in either direction."""
    both = links.select("src", "dst").unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    found = nodes.where(F.col("node") == start).select("node", F.lit(0).alias("hop"))
    for hop in range(1, hops + 1):
        step = found.where(F.col("hop") == hop - 1).join(both, F.col("node") == F.col("src")).select(F.col("dst").alias("node"), F.lit(hop).alias("hop")).distinct()
        found = found.unionByName(step.join(found, "node", "left_anti"))
    return found
