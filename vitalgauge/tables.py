"""The input tables, looked up by logical name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

#: Logical table name -> columns the plans read.
TABLE_COLUMNS: dict[str, tuple[str, ...]] = {
    "solution_monthly": (
        "solution_uid", "date", "plan_uid", "owner_uid", "users_hvt", "workflows", "wt_complexity",
        "department", "external", "api_integrations", "api_apps", "integrations", "quarters_active",
        "users_active", "users_external", "users_external_view",
    ),
    "solution_plan_monthly": (
        "plan_uid", "account_id", "date", "work_type", "premium_apps", "integrations", "connectors",
        "assets", "days_edit", "days_edit_hvt", "days_edit_non_hvt", "quarters_active", "total_count",
        "users_active", "users_edit", "users_external", "users_hvt", "users_hvt_editor",
        "users_hvt_viewer", "users_non_hvt_editor", "users_non_hvt_viewer", "users_view", "days_view",
        "days_view_hvt", "days_view_non_hvt",
    ),
    "plan": ("plan_uid", "account_id", "arr", "licenses", "first_paid"),
    "plan_daily": (
        "plan_uid", "date", "users_licensed", "users_licensed_active", "users_collab_internal",
        "users_collab_internal_active", "users_collab_external", "users_collab_external_active",
        "licenses", "plan_arr",
    ),
    "account": (
        "account_id", "name", "arr", "territory_type", "territory", "company", "first_paid",
        "session_first", "users_licensed_paid", "users_licensed_paid_active", "licenses_paid",
    ),
    "date_dim": ("date", "year_fiscal", "year", "month_calendar", "day_of_month"),
    "addon_plan": ("account_id",),
    "workapp_interval": (
        "container_uid", "effective_from", "effective_to", "owner_plan_uid", "owner_user_uid",
        "status", "changes",
    ),
    "user_plan": ("user_uid", "plan_uid"),
    "session": ("session_uid", "user_uid", "device"),
}


class Tables:
    """Named input tables, each opened on first use: ``tables.plan`` or ``tables["plan"]``."""

    def __init__(self, loaders: Mapping[str, Callable[[], DataFrame]]):
        self._loaders = dict(loaders)
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._loaders[name]()
        return self._opened[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._loaders:
            raise AttributeError(name)
        return self[name]

    def names(self) -> list[str]:
        return list(self._loaders)

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> Tables:
        """Tables kept as ``<folder>/<name>.parquet`` (a file or a partitioned folder each)."""

        def loader(name: str) -> Callable[[], DataFrame]:
            return lambda: spark.read.parquet(f"{folder}/{name}.parquet")

        return cls({name: loader(name) for name in TABLE_COLUMNS})

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str]) -> Tables:
        """Tables registered in the session catalog: logical name -> catalog name."""

        def loader(full_name: str) -> Callable[[], DataFrame]:
            return lambda: spark.table(full_name)

        return cls({name: loader(full) for name, full in names.items()})
