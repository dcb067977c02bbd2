"""The daily run (M13): three marts, then the data check.

The three loads are independent, the check runs after them and reads the
*written* kit-sales mart by its table name, so it never recomputes the mart's
lineage. Marts are catalog tables and carry their description; each refresh is
published as a new version (``martcraft.operators.publish``), so a mart stays
readable while it is rebuilt and after a build that fails; its files are sorted
by month, so a year's check skips the rest; v1 retail keeps its
table and refreshes the rows. The check log is append-only, keeps what earlier
sessions wrote and holds a run once.

A run has an id. Repeated with the same id, it goes on after the marts that it
has published (the mark of each version is the run's manifest) and adds no
second check row. With ``gate`` the check comes first: it reads the kit-sales
version before that is published, records its row, and a total off the target
ends the run with the mart before still in place.

``as_of`` is resolved once, so marts built around midnight (or by a repeated
run) share a calendar. Stage tables live in one run folder that is removed at
the end.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martcraft.operators import checks as K
from martcraft.operators import sinks as SK
from martcraft.operators.publish import adopt, point, published, remove_old
from martcraft.plans import marts as M
from martcraft.rules import Rules
from martcraft.session import stage_run
from martcraft.sources.inputs import Inputs

COMMENTS = {
    "kit_sales": "Kit sales from ERP and realization",
    "retail_sales": "Vehicle retail sales",
    "balance": "Finished vehicle stock",
    "stage_checks": "Results of the data checks, one row a check",
}


class CheckFailed(RuntimeError):
    """The gate's check found a total off its target."""


@dataclass
class Run:
    """Table names by mart, the rows left out of the v2 series because they
    belong to no calendar month, and the marts that an earlier try of the same
    run had published."""

    tables: dict[str, str]
    as_of: dt.date
    run_id: str
    off_calendar_rows: dict[str, int] = field(default_factory=dict)
    resumed: list[str] = field(default_factory=list)


def _today(spark: SparkSession) -> dt.date:
    return spark.sql("SELECT current_date()").first()[0]


def run_marts(spark: SparkSession, inputs: Inputs, rules: Rules, out_dir: str,
              version: str = "v2", checked_at=None, database: str = "default",
              run_id: str | None = None, gate: bool = False) -> Run:
    """Build and publish the marts of ``version`` ('v1', 'interim' or 'v2') as
    tables ``database.<mart>_<version>`` with their versions below ``out_dir``;
    append one check row to ``database.stage_checks``."""
    run_id = run_id or uuid.uuid4().hex
    paths = {name: f"{out_dir}/{name}_{version}" for name in M.MARTS[version]}
    done = {name: v for name, p in paths.items() if (v := published(spark, p, run_id))}
    if rules.as_of is None:
        days = [dt.date.fromisoformat(v.info["as_of"]) for v in done.values()]
        rules = rules.with_(as_of=days[0] if days else _today(spark))
    tables = {name: f"{database}.{name}_{version}" for name in paths}
    run = Run(tables, rules.as_of, run_id)
    log = f"{database}.stage_checks"

    def record(mart: DataFrame) -> DataFrame:
        row = K.check_target(mart, f"kit_sales_{version}", rules.check_year, rules.check_target,
                             prefix=rules.check_name_prefix, checked_at=checked_at)
        SK.create_table(spark, log, row.withColumn("run_id", F.lit("")), f"{out_dir}/stage_checks")
        SK.comment_on_table(spark, log, COMMENTS["stage_checks"])
        SK.append_once(row, log, K.CHECK_COLUMNS, run_id)
        return spark.table(log).where(F.col("run_id") == run_id)

    def target_met(mart: DataFrame) -> None:
        # its own run's rows are the verdict, also of a repeated run
        if not all(r["check_result"] for r in record(mart).collect()):  # one row
            raise CheckFailed(f"kit_sales_{version}: total of {rules.check_year} off the target {rules.check_target}")

    with stage_run(spark):
        base, codes = cache(lambda: M.retail_base(inputs, rules)), cache(lambda: M.retail_codes(inputs))
        for name, build in M.MARTS[version].items():
            if name in done:
                run.resumed.append(name)
                point(spark, tables[name], done[name].path, spark.read.parquet(done[name].path).schema)
                remove_old(spark, paths[name])
                run.off_calendar_rows |= {name: n for n in [done[name].info.get("off_calendar_rows")] if n is not None}
            else:
                shared, counted = {}, None
                if version == "v2" and name != "kit_sales":
                    shared = {"base": base(), "codes": codes()}
                if version == "v2" and name != "balance":
                    counted = shared["dropped"] = Observation()
                mart = build(inputs, rules, **shared)
                info = lambda o=counted: {"as_of": rules.as_of.isoformat(), **({"off_calendar_rows": o.get["off_calendar_rows"]} if o else {})}
                check = target_met if gate and name == "kit_sales" else None
                if (version, name) == ("v1", "retail_sales"):
                    if not adopt(spark, tables[name], paths[name]):
                        SK.create_table(spark, tables[name], mart, paths[name])
                    made = SK.insert_overwrite(mart, tables[name], mart.columns, run_id, check, info, sort_by=["month"])
                else:
                    made = SK.replace_table(spark, tables[name], mart, paths[name], run_id, check, info, sort_by=["month"])
                if counted:
                    run.off_calendar_rows[name] = made.info["off_calendar_rows"]
            SK.comment_on_table(spark, tables[name], COMMENTS[name])
    record(spark.table(tables["kit_sales"]))
    tables["stage_checks"] = log
    return run
