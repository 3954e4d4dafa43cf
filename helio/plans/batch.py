"""The batch run: observations in, tables and documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.aggregates import (
    daily_speed,
    disturbance_breakdown,
    hourly_speed,
    monthly_speed,
    rollup,
    statistics,
    storm_events,
)
from ..operators.clean import prepare_observations, rejected_observations
from ..session import materialize
from ..sources.layout import DOCUMENTS, OutputLayout
from ..sources.writers import write_document, write_table

ROLLED_TABLES = {
    "daily_speed": daily_speed,
    "monthly_speed": monthly_speed,
    "hourly_speed": hourly_speed,
    "disturbance_breakdown": disturbance_breakdown,
}


def write_batch_outputs(observations: DataFrame, base: str, keep_rejects: bool = True) -> None:
    """Write the five tables and three documents below ``base``.

    The observations are read three times however many outputs there are: for the
    hourly rollup behind four of the tables, for the storms (the speed filter reaches
    the scan), and for the statistics behind the documents. Nothing the size of the
    input is cached.
    """
    layout = OutputLayout(base)
    prepared = prepare_observations(observations)
    hours = materialize(rollup(prepared), "rollup")
    for name, build in ROLLED_TABLES.items():
        write_table(build(hours), layout.table(name))
    write_table(storm_events(prepared), layout.table("storm_events"))
    figures = materialize(statistics(prepared), "statistics")
    for name in DOCUMENTS:
        write_document(figures.select(f"{name}.*"), layout.document(name))
    if keep_rejects:
        write_table(rejected_observations(observations), layout.rejects)
