"""Run rules and complete their violations to the exception report."""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime, timezone
from functools import reduce
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.rules import violations as v
from tidyledger.rules.registry import RULE_IDS, SEVERITY_RANK, UNKNOWN_SEVERITY_RANK, registry
from tidyledger.rules.staging import Staging
from tidyledger.schemas import EXCEPTIONS, conform


def find_violations(stg: Staging, wanted: Collection[str] = RULE_IDS) -> DataFrame:
    """(rule_id, record_key, issue_description, dataset) of the wanted rules, tables scanned once where rules allow."""
    unknown = set(wanted) - set(RULE_IDS)
    if unknown or not wanted:
        raise ValueError(f"rules must be a non-empty part of {RULE_IDS}, not {sorted(wanted)}")
    pieces: list[tuple[str, DataFrame]] = []
    if "DQ001" in wanted:
        pieces.append(("customers", v.customer_duplicates(stg)))
    if {"DQ002", "DQ003"} & set(wanted):
        pieces.append(("customers", v.customer_rows(stg, wanted)))
    if "DQ004" in wanted:
        pieces.append(("orders", v.order_duplicates(stg)))
    if {"DQ005", "DQ006", "DQ007", "DQ008"} & set(wanted):
        pieces.append(("orders", v.order_rows(stg, wanted)))
    if {"DQ009", "DQ010"} & set(wanted):
        pieces.append(("payments", v.payment_rows(stg, wanted)))
    if {"DQ011", "DQ012"} & set(wanted):
        pieces.append(("support_tickets", v.ticket_rows(stg, wanted)))
    # A literal per branch lets a filter on dataset remove the other branches from the plan.
    return reduce(DataFrame.unionByName, [df.withColumn("dataset", F.lit(name)) for name, df in pieces])


def run_rules(
    stg: Staging,
    wanted: Collection[str] = RULE_IDS,
    rules: DataFrame | None = None,
    detected_at: datetime | None = None,
) -> DataFrame:
    """The exception report. ``detected_at`` is one UTC moment for the whole run, now by default."""
    found = find_violations(stg, wanted)
    moment = detected_at or datetime.now(timezone.utc)
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    if rules is None:
        known = registry(found.sparkSession).select("rule_id", "severity", "suggested_action")
    else:  # one row per rule of this module, whatever the given table holds, so the broadcast cannot grow
        of_rule = F.min(F.struct("severity", "suggested_action")).alias("r")
        known = rules.filter(F.col("rule_id").isin(*RULE_IDS)).groupBy("rule_id").agg(of_rule).select("rule_id", "r.*")
    report = found.join(F.broadcast(known), "rule_id").withColumn(
        "detected_at", F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    )
    return conform(report, EXCEPTIONS)


def with_severity_rank(exceptions: DataFrame) -> DataFrame:
    """Add the rank the report sorts by. Sort when reading: a stored table has no row order."""
    ranks = F.create_map(*[F.lit(x) for x in chain.from_iterable(SEVERITY_RANK.items())])
    rank = F.coalesce(F.try_element_at(ranks, F.col("severity")), F.lit(UNKNOWN_SEVERITY_RANK))
    return exceptions.withColumn("severity_rank", rank)
