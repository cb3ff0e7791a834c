"""Threshold gate over metrics, and its report."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# The header of the metric table.
HEADER = ("metric_name", "candidate", "baseline")

RUN_MODES = ("disabled", "dry_run", "enabled")


class GateFailed(Exception):
    """A metric misses its threshold."""


@dataclass(frozen=True)
class Threshold:
    metric_name: str
    threshold: float
    higher_is_better: bool = True


# The thresholds a classifier has to reach.
DEFAULT_THRESHOLDS = (Threshold("accuracy", 0.8), Threshold("f1_score", 0.5))


def gate_report(metrics: DataFrame, rules: Iterable[Threshold] = DEFAULT_THRESHOLDS) -> DataFrame:
    """``(metric_name, candidate, baseline, threshold, higher_is_better, passed)``.

    ``metrics`` has ``metric_name``, ``candidate`` and perhaps ``baseline``.
    Equality passes. A metric that is NaN, null or not there fails its rule; a
    metric without a rule has a null verdict.
    """
    rule_rows = [(r.metric_name, float(r.threshold), r.higher_is_better) for r in rules]
    # As many rows as there are rules in the caller's code.
    table = metrics.sparkSession.createDataFrame(
        rule_rows, "metric_name string, threshold double, higher_is_better boolean"
    )
    if "baseline" not in metrics.columns:
        metrics = metrics.withColumn("baseline", F.lit(None).cast("double"))
    joined = metrics.select("metric_name", "candidate", "baseline").join(table, "metric_name", "full_outer")
    value, bound = F.col("candidate"), F.col("threshold")
    # Spark orders NaN above every number, so it is tested by itself.
    usable = value.isNotNull() & ~F.isnan(value)
    reached = F.when(F.col("higher_is_better"), value >= bound).otherwise(value <= bound)
    passed = F.when(bound.isNotNull(), F.coalesce(usable & reached, F.lit(False)))
    return joined.select(
        "metric_name", "candidate", "baseline", "threshold", "higher_is_better", passed.alias("passed")
    )


def enforce(report: DataFrame, run_mode: str = "enabled") -> list[Row]:
    """Failed rules by metric name; in mode ``enabled`` the first one raises.

    ``dry_run`` only reports, ``disabled`` does not evaluate anything. What is
    collected is one row per failed rule.
    """
    if run_mode not in RUN_MODES:
        raise ValueError(f"run mode must be one of {RUN_MODES}, not {run_mode!r}")
    if run_mode == "disabled":
        return []
    failed = report.filter(~F.col("passed")).orderBy("metric_name").collect()
    if failed and run_mode == "enabled":
        first = failed[0]
        raise GateFailed(
            f"{first['metric_name']} is {first['candidate']}, threshold {first['threshold']}"
            f" ({'at least' if first['higher_is_better'] else 'at most'})"
        )
    return failed


def report_lines(report: DataFrame) -> DataFrame:
    """The report as fixed-width text, one line per metric; ``N/A`` for no baseline."""
    shown = F.coalesce(F.col("baseline").cast("string"), F.lit("N/A"))
    value = F.coalesce(F.col("candidate").cast("string"), F.lit("N/A"))
    return report.select(F.format_string("%-30s  %-30s  %s", F.col("metric_name"), value, shown).alias("line"))


def report_text(report: DataFrame) -> DataFrame:
    """``(part, place, line)``: the text of the threshold list and of the metric table with its header.

    Lines of a part are read by ``place`` and then by their text. A rule without
    a metric is in the first part only, a metric without a rule in the second only.
    """
    known = report.filter("candidate is not null or threshold is null")
    header = report.sparkSession.range(1).select(F.format_string("%-30s  %-30s  %s", *map(F.lit, HEADER)).alias("line"))
    rule = F.format_string("%-30s  %s", F.col("metric_name"), F.col("threshold").cast("string"))
    rules = report.filter("threshold is not null").select(rule.alias("line"))
    parts = [("thresholds", 1, rules), ("metrics", 0, header), ("metrics", 1, report_lines(known))]
    return reduce(DataFrame.unionByName, [p.select(F.lit(name).alias("part"), F.lit(place).alias("place"), "line") for name, place, p in parts])
