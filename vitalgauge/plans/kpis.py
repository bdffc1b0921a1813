"""The KPI catalogue and the editions of the adoption scorecard, as data."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Kpi:
    """A guarded ratio of two sums over an account month; without a denominator, the sum itself."""

    name: str
    numerator: str
    denominator: str | None
    scale: int = 1

    @property
    def short(self) -> str:
        """Name used in ``pct_rank_…`` and ``score_…``."""
        return self.name.removeprefix("pct_").removeprefix("avg_")


_SOLUTIONS = "total_solutions_per_account"

# KPI names with their numerators, denominators and scales.
LICENSED_USERS = Kpi("pct_licensed_users", "users_licensed_active", "users_licensed", 100)
ACTIVE_USERS_HVT = Kpi("pct_active_users", "users_hvt", "users_licensed_active", 100)
ACTIVE_USERS = Kpi("pct_active_users", "total_active_users", "users_licensed_active", 100)
INTERNAL_COLLABORATOR_ALL = Kpi("pct_internal_collaborator", "users_collab_internal", "total_active_users", 100)
INTERNAL_COLLABORATOR = Kpi("pct_internal_collaborator", "users_collab_internal_active", "total_active_users", 100)
EXTERNAL_COLLABORATOR_ALL = Kpi("pct_external_collaborator", "users_collab_external", "total_active_users", 100)
EXTERNAL_COLLABORATOR = Kpi("pct_external_collaborator", "users_collab_external_active", "total_active_users", 100)
ACTIVE_CREATORS = Kpi("pct_active_creators", "unique_solution_owners", _SOLUTIONS, 100)
POWER_DEVELOPER = Kpi("pct_power_developer", "power_developers", "users_licensed", 100)
SOLUTION_CREATORS = Kpi("pct_solution_creators", "unique_solution_owners", "users_licensed", 100)
INTERNAL_COLLAB = Kpi("avg_internal_collab_per_solution", "unique_internal_collaborators", _SOLUTIONS)
UNIQUE_EXTERNAL_COLLAB = Kpi("avg_unique_external_collab_per_solution", "solutions_with_external_users", _SOLUTIONS)
EXTERNAL_COLLAB = Kpi("avg_external_collab_per_solution", "unique_external_collaborators", _SOLUTIONS)
UNIQUE_HVT_COLLAB = Kpi("avg_unique_hvt_collab_per_solution", "solutions_with_hvt", _SOLUTIONS)
HVT_PER_SOLUTION = Kpi("pct_hvt_per_solution", "unique_hvt_collaborators", _SOLUTIONS)
MONTHLY_CREATION = Kpi("monthly_solution_creation_rate", "solutions_created_monthly", _SOLUTIONS)
EXTERNAL_INTEGRATION = Kpi("external_integration_pct", "external_integrations", _SOLUTIONS, 100)
INTERNAL_INTEGRATION = Kpi("internal_integration_pct", "internal_integrations", _SOLUTIONS, 100)
COMPLEXITY = Kpi("avg_complexity_per_solution", "total_complexity_score", _SOLUTIONS)
AUTOMATION_V1 = Kpi("pct_solution_automation", "solutions_with_automation", _SOLUTIONS, 100)
AUTOMATION = Kpi("pct_solution_automation", "automated_rows", _SOLUTIONS, 100)
AUTOMATION_COMPLEXITY = Kpi("pct_automation_complexity", "total_workflows", _SOLUTIONS)
DEPARTMENTS = Kpi("avg_departments_per_solution", "num_departments_per_solution", _SOLUTIONS)
QUARTERLY_CREATION = Kpi("quarterly_solution_creation_rate", "solutions_created_last_90_days", _SOLUTIONS)
ADDON = Kpi("brandfolder_presence", "brandfolder_presence", None)
LOW_CODE = Kpi("pct_low_code", "work_app_count", _SOLUTIONS, 100)
LOW_CODE_EXTERNAL = Kpi("pct_low_code_external_collab", "external_views_with_work_app", "work_app_count", 100)
MOBILE_ANY_CASE = Kpi("pct_mobile_sessions", "mobile_users", "total_active_users", 100)
MOBILE = Kpi("pct_active_users_mobile_sessions", "mobile_users", "total_active_users", 100)


@dataclass(frozen=True)
class Edition:
    """One edition of the adoption scorecard.

    ``active_columns``: total active users count the active collaborators only.
    ``integrations_by_flag``: integrations are told by the external flag and a non-empty
    integrations array, instead of non-NULL API columns.
    ``mobile``: None, ``"any_case"`` (all users of a plan, device contains "mobile") or
    ``"prefix"`` (users with mobile sessions only, device starts with "Mobile").
    """

    name: str
    kpis: tuple[Kpi, ...]
    active_columns: bool = True
    integrations_by_flag: bool = False
    work_apps: bool = False
    profile: bool = False
    ranked: bool = False
    mobile: str | None = None


_V1_HEAD = (
    LICENSED_USERS, ACTIVE_USERS_HVT, INTERNAL_COLLABORATOR_ALL, EXTERNAL_COLLABORATOR_ALL,
    ACTIVE_CREATORS, POWER_DEVELOPER, SOLUTION_CREATORS, INTERNAL_COLLAB, UNIQUE_EXTERNAL_COLLAB,
    EXTERNAL_COLLAB, UNIQUE_HVT_COLLAB, HVT_PER_SOLUTION, MONTHLY_CREATION, EXTERNAL_INTEGRATION,
    INTERNAL_INTEGRATION, COMPLEXITY,
)
_HEAD = (
    LICENSED_USERS, ACTIVE_USERS, INTERNAL_COLLABORATOR, EXTERNAL_COLLABORATOR, ACTIVE_CREATORS,
    POWER_DEVELOPER, SOLUTION_CREATORS, INTERNAL_COLLAB, UNIQUE_EXTERNAL_COLLAB, EXTERNAL_COLLAB,
    UNIQUE_HVT_COLLAB, HVT_PER_SOLUTION, DEPARTMENTS, QUARTERLY_CREATION,
)
_INNOVATION = (INTERNAL_INTEGRATION, COMPLEXITY)
_TAIL = (AUTOMATION, AUTOMATION_COMPLEXITY, ADDON, LOW_CODE, LOW_CODE_EXTERNAL)

EDITIONS: dict[str, Edition] = {
    e.name: e
    for e in (
        Edition(
            "adoption_kpis_v1", (*_V1_HEAD, AUTOMATION_V1, AUTOMATION_COMPLEXITY, ADDON),
            active_columns=False, integrations_by_flag=True,
        ),
        Edition(
            "adoption_kpis_v2", (*_V1_HEAD, ADDON), active_columns=False, integrations_by_flag=True,
        ),
        Edition("adoption_kpis_active", (*_HEAD, *_INNOVATION, ADDON)),
        Edition("adoption_kpis_workapps", (*_HEAD, *_INNOVATION, *_TAIL), work_apps=True),
        Edition("adoption_kpis_profiled", (*_HEAD, *_TAIL), work_apps=True, profile=True),
        Edition("adoption_scorecard", (*_HEAD, *_TAIL), work_apps=True, profile=True, ranked=True),
        Edition(
            "adoption_scorecard_mobile_ci", (*_HEAD, *_TAIL, MOBILE_ANY_CASE),
            work_apps=True, profile=True, ranked=True, mobile="any_case",
        ),
        Edition(
            "adoption_scorecard_mobile", (*_HEAD, *_TAIL, MOBILE),
            work_apps=True, profile=True, ranked=True, mobile="prefix",
        ),
    )
}
