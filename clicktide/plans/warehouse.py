"""Full build: sources to facts, session theme, marts and quality report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clicktide.operators.anomaly import daily_anomaly
from clicktide.operators.cleanse import cleanse_events, cleanse_items
from clicktide.operators.funnel import CHECKOUT_STEPS, funnel_of, step_times
from clicktide.operators.kpi import build_metadata, daily_kpi
from clicktide.operators.presence import build_summary_of, channels_of, summary_of, users_of
from clicktide.operators.products import product_summary
from clicktide.operators.quality import FIXTURE, Bounds, quality_report
from clicktide.operators.retention import retention_of, user_weeks
from clicktide.operators.sessions import session_summary
from clicktide.operators.users import scored_users
from clicktide.operators.visits import condense
from clicktide.plans.presence import Store, count_all, current
from clicktide.schemas import DATE, FIRST_VISIT
from clicktide.session import delete_folder, require_strict, scratch_scope
from clicktide.sources.flat import items_beside, read_events, read_items
from clicktide.sources.tables import CONTRACT, is_foldered, rewrite_table, write_table

# Fixed value: data mode of a real build.
OFFICIAL = "official_bigquery_export"

# Tables kept for later steps but not part of the contract, with their folder column.
INTERNAL = {
    "visits": DATE,
    "step_times": DATE,
    "user_weeks": "cohort_week",
    "session_summary": None,
    "cohort_retention": "cohort_week",
    "daily_anomaly": None,
    "build_metadata": None,
    "build_summary": None,
    "summary": None,
    "quality_report": None,
}


@dataclass(frozen=True)
class JobConfig:
    """``base`` receives the tables; fixture runs write to folders of their own.

    ``bounds`` are the first and last day that the quality rules expect.
    """

    base: str
    events_path: str
    bounds: Bounds
    items_path: str | None = None
    fixture: bool = False
    prefix: str = ""
    first_visit: str = FIRST_VISIT
    steps: tuple[tuple[str, str], ...] = CHECKOUT_STEPS

    @property
    def mode(self) -> str:
        return FIXTURE if self.fixture else OFFICIAL

    @property
    def items_source(self) -> str:
        return self.items_path or items_beside(self.events_path)


def out_dir(cfg: JobConfig, kind: str) -> str:
    return f"{cfg.base.rstrip('/')}/{kind}" + ("_fixture" if cfg.fixture else "")


def table_path(cfg: JobConfig, name: str) -> str:
    if name in CONTRACT:
        return f"{out_dir(cfg, 'platform')}/{cfg.prefix}{name}"
    return f"{out_dir(cfg, 'warehouse')}/{name}"


def keep(cfg: JobConfig, done: dict[str, DataFrame], name: str, df: DataFrame) -> None:
    """Write a table in its place and note it as read back from there."""
    done[name] = write_table(df, table_path(cfg, name), {**CONTRACT, **INTERNAL}[name])


def keep_items(spark: SparkSession, cfg: JobConfig, done: dict[str, DataFrame]) -> None:
    """Write the item facts. Cleansing keeps every line on its day, so a source in folders by day needs no shuffle."""
    items = cleanse_items(read_items(spark, cfg.items_source))
    if is_foldered(spark, cfg.items_source, DATE):
        done["items"] = rewrite_table(items, table_path(cfg, "items"), CONTRACT["items"])
    else:
        keep(cfg, done, "items", items)


def presence_root(cfg: JobConfig) -> str:
    return f"{out_dir(cfg, 'warehouse')}/presence"


def stored_counts(spark: SparkSession, cfg: JobConfig, visits: DataFrame) -> Store:
    """The store of distinct counts; where there is none yet, all visits are counted into one."""
    store = current(spark, presence_root(cfg))
    if store:
        return store
    with scratch_scope(spark):
        return count_all(spark, presence_root(cfg), visits)


def dependent_marts(spark: SparkSession, cfg: JobConfig, done: dict[str, DataFrame]) -> None:
    """Write every table that is made anew from facts, visits, stored counts, step times, daily KPI and cohorts, quality last.

    Channels, users and both summaries come from the stored counts, sessions from
    visits, the row rules from event facts, the others from step times, items or marts. The
    scratch tables of a mart go as soon as it is written.
    """
    items, condensed = done["items"], done["visits"]
    store = stored_counts(spark, cfg, condensed)
    totals = store.totals(spark)
    made = {
        "session_summary": lambda: session_summary(condensed),
        "funnel": lambda: funnel_of(done["step_times"], cfg.steps),
        "channel_summary": lambda: channels_of(totals),
        "user_value": lambda: scored_users(users_of(totals)),
        "product_summary": lambda: product_summary(items),
        "daily_anomaly": lambda: daily_anomaly(done["daily_kpi"]),
        "build_metadata": lambda: build_metadata(spark, cfg.mode),
        "build_summary": lambda: build_summary_of(totals, items, cfg.mode),
        "summary": lambda: summary_of(totals, store.entities(spark), cfg.mode),
        "quality_report": lambda: quality_report(done, cfg.bounds, cfg.mode),
    }
    for name, table in made.items():
        with scratch_scope(spark):
            keep(cfg, done, name, table())


def run(spark: SparkSession, cfg: JobConfig) -> dict[str, DataFrame]:
    """Build every table and return each as read back from where it was written.

    Each table is written once: the contract tables in their final place, the
    others beside them. The event facts are read three times: for the step times,
    for the row checks, and once to condense them into visits, which all other
    marts and the stored distinct counts are derived from.
    """
    require_strict(spark)
    done: dict[str, DataFrame] = {}
    delete_folder(spark, presence_root(cfg))  # counts of the visits that are about to be replaced
    keep(cfg, done, "events", cleanse_events(read_events(spark, cfg.events_path)))
    keep_items(spark, cfg, done)
    keep(cfg, done, "visits", condense(done["events"], cfg.first_visit))
    with scratch_scope(spark):
        count_all(spark, presence_root(cfg), done["visits"])
    keep(cfg, done, "step_times", step_times(done["events"], cfg.steps))
    keep(cfg, done, "daily_kpi", daily_kpi(done["visits"]))
    keep(cfg, done, "user_weeks", user_weeks(done["visits"]))
    keep(cfg, done, "cohort_retention", retention_of(done["user_weeks"]))
    dependent_marts(spark, cfg, done)
    return done
