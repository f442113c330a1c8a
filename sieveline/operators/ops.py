"""Operations: cost estimates, completeness of partitions, token usage, durations, resource presets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Planning defaults: rows a pass and second, columns a pass, and what makes a table big.
ROWS_PER_SECOND, COLUMNS_PER_PASS, BIG_ROWS, BIG_BYTES = 3_000_000, 14, 100_000_000, 5 * 2**30


def estimate_cost(tables: DataFrame, rates: DataFrame | None = None, least_samples: int = 3) -> DataFrame:
    """(table_name, passes, seconds, big) of a full measurement of (table_name, n_rows, n_columns, n_bytes).

    Two passes for counting and fingerprints and one per block of columns. Measured rates (rate) replace the default once
    there are ``least_samples`` of them.
    """
    passes = F.lit(2) + F.ceil(F.col("n_columns") / COLUMNS_PER_PASS)
    rate = F.lit(float(ROWS_PER_SECOND))
    if rates is not None:
        mean = rates.agg(F.when(F.count("rate") >= least_samples, F.avg("rate")).alias("measured"))
        tables = tables.join(F.broadcast(mean))  # one row
        rate = F.coalesce("measured", rate)
    big = (F.col("n_rows") > BIG_ROWS) | (F.col("n_bytes") > BIG_BYTES)
    return tables.select("table_name", passes.cast("long").alias("passes"), F.round(F.col("n_rows") * passes / rate, 3).alias("seconds"), big.alias("big"))


def partition_completeness(expected: DataFrame, present: DataFrame) -> DataFrame:
    """(part, n_expected, n_present, state): COMPLETE, PARTIAL or MISSING partitions of a download, by file."""
    both = expected.select("part", "file").join(present.select("file", F.lit(1).alias("here")).distinct(), "file", "left")
    out = both.groupBy("part").agg(F.count(F.lit(1)).alias("n_expected"), F.count("here").alias("n_present"))
    return out.withColumn("state", F.when(F.col("n_present") == F.col("n_expected"), "COMPLETE").when(F.col("n_present") == 0, "MISSING").otherwise("PARTIAL"))


def usage_by_actor(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """(actor, model, n_calls, n_runs, input_tokens, output_tokens, cost) of calls, one per request id.

    A request that was logged repeatedly counts once, as its last line. Prices (prefix, input_price, output_price per
    million) match by the longest prefix of the model's name: each name meets the list by all its prefixes, an equi-join.
    """
    last = Window.partitionBy("request_id").orderBy(F.desc("ts"))
    once = calls.withColumn("__r", F.row_number().over(last)).where("__r = 1").drop("__r")
    sums = once.groupBy("actor", "model").agg(F.count(F.lit(1)).alias("n_calls"), F.countDistinct("run_id").alias("n_runs"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))
    models = sums.select("model").distinct()
    models = models.select("model", F.explode(F.transform(F.sequence(F.lit(0), F.length("model")), lambda n: F.substr("model", F.lit(1), n))).alias("prefix"))
    hit = models.join(prices, "prefix")
    best = hit.groupBy("model").agg(F.max_by(F.struct("input_price", "output_price"), F.length("prefix")).alias("p"))
    cost = (F.col("input_tokens") * F.col("p.input_price") + F.col("output_tokens") * F.col("p.output_price")) / 1_000_000
    return sums.join(best, "model", "left").select("actor", "model", "n_calls", "n_runs", "input_tokens", "output_tokens", F.round(cost, 6).alias("cost"))


def usage_findings(sessions: DataFrame, *, coordinator: str = "COORDINATOR", generic: Sequence[str] = (), strong: str, weak: str, context_limit: int = 200_000, rewrite_limit: int = 100_000, result_limit: int = 30_000, mechanical_percent: float = 70, error_percent: float = 25) -> DataFrame:
    """(finding, subject, figure) from sessions (session, actor, model, declared_model, ended, declared_since, calls, context_tokens,
    rewrite_tokens, result_bytes, tool_calls, pipeline_tool_calls, errors, cost).

    Large mean contexts and large tool results of the coordinator by session; large cache rewrites, models other than the one declared
    at the time, and generic actors by actor; names of models that several models answer to; strong models at mechanical work and
    weak ones with many errors, by actor.
    """
    chief, declared = F.col("actor") == coordinator, F.col("declared_model")
    named = F.col("model").contains(declared)
    percent = lambda part: 100.0 * F.sum(part) / F.sum("tool_calls")

    def found(name: str, by: str, where: Column, figure: Column, having: Column | None = None) -> DataFrame:
        out = sessions.where(where).groupBy(F.col(by).alias("subject")).agg(figure.cast("double").alias("figure"), F.sum("tool_calls").alias("tools"), F.lit(True).alias("any"))
        out = out if having is None else out.where(having)
        return out.select(F.lit(name).alias("finding"), "subject", F.round("figure", 6).alias("figure"))

    figure = F.col("figure")
    parts = [
        found("large_context", "session", chief & (F.col("context_tokens") > context_limit), F.max("context_tokens")),
        found("cache_rewrites", "actor", F.col("rewrite_tokens") >= rewrite_limit, F.sum("rewrite_tokens")),
        found("other_model", "actor", declared.isNotNull() & ~named & (F.col("ended") >= F.col("declared_since")), F.count(F.lit(1))),
        found("generic_actor", "actor", F.col("actor").isin(list(generic)), F.sum("cost")),
        found("large_results", "session", chief & (F.col("result_bytes") >= result_limit), F.sum("result_bytes")),
        found("alias_of_several", "declared_model", named, F.countDistinct("model"), figure > 1),
        found("mechanical_work", "actor", declared == strong, percent("pipeline_tool_calls"), figure >= mechanical_percent),
        found("many_errors", "actor", declared == weak, percent("errors"), (figure >= error_percent) & (F.col("tools") > 20)),
    ]
    return reduce(DataFrame.unionByName, parts)


def median_duration(log: DataFrame) -> DataFrame:
    """(action, n, median_s) of logged actions (action, seconds); the mean of the middle two for even counts."""
    return log.groupBy("action").agg(F.count("seconds").alias("n"), F.round(F.expr("percentile(seconds, 0.5)"), 6).alias("median_s"))


def combine_chunks(chunks: DataFrame, collation: str | None = None) -> DataFrame:
    """Exact totals from partial aggregates (column_name, n, non_null, low, high, total) of disjoint chunks.

    Bounds are text bounds again by the ``collation`` that the columns declare: chunks' own bounds have to be by it too.
    """
    as_declared = (lambda c: F.collate(c, collation)) if collation else F.col
    back = (lambda c: F.collate(c, "UTF8_BINARY")) if collation else (lambda c: c)
    return chunks.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.sum("non_null").alias("non_null"), back(F.min(as_declared(F.col("low") if collation else "low"))).alias("low"), back(F.max(as_declared(F.col("high") if collation else "high"))).alias("high"), F.sum("total").alias("total")
    )


#: Session settings by how much of a machine may be used.
PRESETS = {
    "light": {"spark.sql.shuffle.partitions": "64", "spark.sql.files.maxPartitionBytes": "32m"},
    "normal": {"spark.sql.shuffle.partitions": "400", "spark.sql.files.maxPartitionBytes": "128m"},
    "full": {"spark.sql.shuffle.partitions": "4000", "spark.sql.files.maxPartitionBytes": "256m"},
}
