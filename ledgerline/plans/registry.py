"""The registered queries, and SQL that gives the same rows in DuckDB.

The SQL says what the operators mean in the plainest way, with ranks and full
joins; the operators compute it with maxima of pairs and semi-joins.
"""

from collections.abc import Callable
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.lookups import source_code
from ledgerline.functions.pinning import new_folder
from ledgerline.operators import latest, refresh, report
from ledgerline.plans.refresh_report import refresh_stored, refresh_then_report
from ledgerline.plans.standin import SOURCE_NAME, read_view, with_views
from ledgerline.schemas import LOAD_BATCHES
from ledgerline.sources.versions import VersionedTable

# The entity that the one-entity report asks for.
ENTITY = 50
# The priority whose code is looked up.
PRIORITY = "HIGH"

Query = Callable[[SparkSession, str], DataFrame]


class _Views:
    """The views of one folder, with the arguments the operators take."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._read = partial(read_view, spark, sf_dir)

    @cached_property
    def batches(self) -> DataFrame:
        return self._read("load_batches")

    @cached_property
    def balances(self) -> DataFrame:
        return self._read("general_balances")

    @cached_property
    def microfinance(self) -> DataFrame:
        return self._read("microfinance_balances")

    @cached_property
    def entities(self) -> DataFrame:
        return self._read("entity_sources")

    @cached_property
    def codes(self) -> DataFrame:
        return self._read("source_codes")

    @property
    def priorities(self) -> DataFrame:
        return self._read("priority_codes")

    @property
    def eligible(self) -> DataFrame:
        return latest.eligible_batches(
            self.batches, source_code(self.codes, SOURCE_NAME)
        )

    @property
    def latest(self) -> DataFrame:
        return latest.latest_batches(
            self.batches, source_code(self.codes, SOURCE_NAME)
        )

    @property
    def refresh_arguments(self) -> tuple:
        return (
            self.batches,
            self.balances,
            self.microfinance,
            self.codes,
            SOURCE_NAME,
        )

    @property
    def report_arguments(self) -> tuple:
        return self.batches, self.balances, self.entities, self.codes, SOURCE_NAME


_QUERIES: dict[str, Callable[[_Views], DataFrame]] = {
    "source_code_lookup": lambda v: v.priorities.where(
        F.col("code") == source_code(v.priorities, PRIORITY)
    ),
    "scan_eligible_batches": lambda v: v.eligible,
    "max_period_per_entity": lambda v: latest.with_entity_maximum(v.eligible),
    "latest_period_batches": lambda v: latest.at_entity_maximum(v.eligible),
    "latest_batch_per_entity": lambda v: v.latest,
    "join_batch_balances": lambda v: report.latest_balances(v.latest, v.balances),
    "global_period_by_entity": lambda v: report.global_periods(v.latest, v.balances),
    "active_entity_join": lambda v: report.active_descriptions(v.latest, v.entities),
    "latest_batch_report": lambda v: report.latest_batch_report(*v.report_arguments),
    "latest_batch_report_one": lambda v: report.latest_batch_report(
        *v.report_arguments, entity=ENTITY
    ),
    "balances_in_microfinance": lambda v: refresh.newest_covered_periods(
        v.batches, v.balances, v.microfinance
    ),
    "refresh_source": lambda v: refresh.batch_periods(*v.refresh_arguments),
    "refresh_source_correlated": lambda v: refresh.batch_periods_sql(
        *v.refresh_arguments
    ),
    "refresh_merged_table": lambda v: refresh.refresh_batch_periods(
        *v.refresh_arguments
    ),
    "refresh_then_report": lambda v: refresh_then_report(
        v.batches, v.balances, v.microfinance, v.entities, v.codes, SOURCE_NAME
    ),
    "stored_refresh": lambda v: _stored_refresh(v),
    "stored_refresh_report": lambda v: _stored_refresh_report(v),
}


def _stored_refresh(v: _Views) -> DataFrame:
    """The refreshed table, stored as the second version of a table and read back."""
    store, first = _stored(v)
    return store.read(refresh_stored(store, first, *v.refresh_arguments[1:]))


def _stored_refresh_report(v: _Views) -> DataFrame:
    """The report on the refreshed table, as it is read back from the store."""
    store, first = _stored(v)
    return refresh_then_report(
        store.read(first), v.balances, v.microfinance, v.entities, v.codes, SOURCE_NAME, store=store, base=first
    )


def _stored(v: _Views) -> tuple[VersionedTable, int]:
    spark = v.batches.sparkSession
    store = VersionedTable(spark, new_folder(spark), LOAD_BATCHES)
    return store, store.write(v.batches, base=None)


def queries() -> dict[str, Query]:
    """Every query by name, as a function of the session and the data folder."""

    def bind(query: Callable[[_Views], DataFrame]) -> Query:
        return lambda spark, sf_dir: query(_Views(spark, sf_dir))

    return {name: bind(query) for name, query in _QUERIES.items()}


_CODE = f"(SELECT code FROM source_codes WHERE name = '{SOURCE_NAME}')"


def _eligible(table: str, entity: int | None = None) -> str:
    only = f" AND entity_id = {entity}" if entity is not None else ""
    return f"""
        SELECT batch_id, entity_id, period_date, file_name,
               rank() OVER (PARTITION BY entity_id
                            ORDER BY period_date DESC NULLS LAST) AS place
          FROM {table}
         WHERE cancelled_at IS NULL AND source_type = {_CODE}{only}"""


def _newest(table: str, entity: int | None = None) -> str:
    return f"""
        SELECT batch_id, entity_id, period_date, file_name
          FROM ({_eligible(table, entity)})
         WHERE place = 1 AND period_date IS NOT NULL"""


def _latest(table: str, entity: int | None = None) -> str:
    return f"""
        SELECT entity_id, max(batch_id) AS batch_id, max(file_name) AS file_name
          FROM ({_newest(table, entity)}) GROUP BY entity_id"""


def _report(table: str, entity: int | None = None) -> str:
    return f"""
        SELECT l.entity_id, e.description, max(g.period_date) AS global_period,
               l.file_name, l.batch_id
          FROM ({_latest(table, entity)}) l
          JOIN general_balances g ON g.batch_id = l.batch_id
          JOIN entity_sources e ON e.entity_id = l.entity_id
         WHERE e.status = 1
         GROUP BY l.entity_id, e.description, l.file_name, l.batch_id
         ORDER BY l.entity_id, e.description"""


_COVERED = """
        SELECT g.batch_id, m.entity_id, max(g.period_date) AS period_date
          FROM general_balances g
          JOIN microfinance_balances m USING (person_id, balance_id)
         GROUP BY g.batch_id, m.entity_id"""

_SOURCE = f"""
        SELECT b.batch_id, c.period_date
          FROM load_batches b
          LEFT JOIN ({_COVERED}) c
            ON c.batch_id = b.batch_id AND c.entity_id = b.entity_id
         WHERE b.source_type = {_CODE}"""

_REFRESHED = f"""
        SELECT b.batch_id, b.entity_id,
               CASE WHEN s.batch_id IS NOT NULL THEN s.period_date
                    ELSE b.period_date END AS period_date,
               b.cancelled_at, b.source_type, b.file_name
          FROM load_batches b LEFT JOIN ({_SOURCE}) s ON s.batch_id = b.batch_id"""

_ORACLE: dict[str, str] = {
    "source_code_lookup": f"""
        SELECT name, code FROM priority_codes
         WHERE code = (SELECT code FROM priority_codes WHERE name = '{PRIORITY}')""",
    "scan_eligible_batches": f"""
        SELECT batch_id, entity_id, period_date, file_name
          FROM load_batches
         WHERE cancelled_at IS NULL AND source_type = {_CODE}""",
    "max_period_per_entity": f"""
        SELECT batch_id, entity_id, period_date,
               first_value(period_date) OVER (PARTITION BY entity_id
                                              ORDER BY place) AS max_period
          FROM ({_eligible("load_batches")})""",
    "latest_period_batches": _newest("load_batches"),
    "latest_batch_per_entity": _latest("load_batches"),
    "join_batch_balances": f"""
        SELECT l.entity_id, l.batch_id, g.person_id, g.balance_id, g.period_date
          FROM ({_latest("load_batches")}) l
          JOIN general_balances g ON g.batch_id = l.batch_id""",
    "global_period_by_entity": f"""
        SELECT l.entity_id, l.batch_id, max(g.period_date) AS global_period
          FROM ({_latest("load_batches")}) l
          JOIN general_balances g ON g.batch_id = l.batch_id
         GROUP BY l.entity_id, l.batch_id""",
    "active_entity_join": f"""
        SELECT DISTINCT l.entity_id, l.batch_id, e.description
          FROM ({_latest("load_batches")}) l
          JOIN entity_sources e ON e.entity_id = l.entity_id AND e.status = 1""",
    "latest_batch_report": _report("load_batches"),
    "latest_batch_report_one": _report("load_batches", ENTITY),
    "balances_in_microfinance": f"""
        SELECT c.batch_id, c.entity_id, c.period_date
          FROM ({_COVERED}) c
          JOIN (SELECT DISTINCT batch_id, entity_id FROM load_batches) b
            ON b.batch_id = c.batch_id AND b.entity_id = c.entity_id""",
    "refresh_source": _SOURCE,
    "refresh_source_correlated": _SOURCE,
    "refresh_merged_table": _REFRESHED,
    "refresh_then_report": f"""
        SELECT * FROM ({_report(f"({_REFRESHED})")})""",
    "stored_refresh": _REFRESHED,
    "stored_refresh_report": f"""
        SELECT * FROM ({_report(f"({_REFRESHED})")})""",
}


def oracle_sql() -> dict[str, str]:
    """The SQL of every query, over the test tables."""
    return {name: with_views(query) for name, query in _ORACLE.items()}
