"""One run over the four forms."""

from __future__ import annotations

import datetime as dt
from functools import cached_property
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterbill.functions.periods import Period
from quarterbill.functions.policy import Policy
from quarterbill.operators import checks, events, members, pricing, projects, terms
from quarterbill.operators.asof import as_of_join
from quarterbill.operators.spread import stage, stage_by
from quarterbill.plans import reports
from quarterbill.sources.event_tables import EventTables
from quarterbill.sources.forms import Forms

# Fixed value: bills are dated in this zone.
TIME_ZONE = ZoneInfo("America/Toronto")


def today() -> dt.date:
    """The date that bills carry unless told otherwise."""
    return dt.datetime.now(tz=TIME_ZONE).date()


class QuarterBilling:
    """All results for one period, from forms or from tables of events. Every property and method is a DataFrame.

    The reports per project are lazy plans over the forms. The reports per person read
    the power users several times and so stage them first (see `stage`).
    """

    def __init__(
        self, forms: Forms | EventTables, period: Period, policy: Policy | None = None
    ) -> None:
        self.forms = forms.as_forms() if isinstance(forms, EventTables) else forms
        self.period = period
        self.policy = policy or Policy()

    # -- state ---------------------------------------------------------------------

    @cached_property
    def user_events(self) -> DataFrame:
        """The user log in replay order."""
        return events.user_events(self.forms, self.period)

    @cached_property
    def log(self) -> projects.ProjectLog:
        """The reduced project log."""
        return projects.read_log(self.forms, self.period)

    @cached_property
    def walked(self) -> DataFrame:
        """The user log by person and day, with the terms numbered."""
        return terms.walk_days(terms.day_states(self.user_events))

    @cached_property
    def replayed_segments(self) -> DataFrame:
        """Validity intervals of all terms kept for the period, before closures."""
        return terms.kept_for(terms.segments(self.walked), self.period)

    @cached_property
    def segments(self) -> DataFrame:
        """Validity intervals after project closures ended their PIs' terms."""
        return terms.apply_closures(self.replayed_segments, self.log.pis)

    @cached_property
    def segments_in_period(self) -> DataFrame:
        """The same, without the intervals that were over before the period."""
        return terms.apply_closures(self._recent(self.replayed_segments), self.log.pis)

    def _recent(self, replayed: DataFrame) -> DataFrame:
        # Closures fall into the period, so they cut no earlier interval.
        return replayed.where(
            f"to_date IS NULL OR to_date >= date'{self.period.start}'"
        )

    @cached_property
    def projects(self) -> DataFrame:
        """Projects kept for the period."""
        return projects.projects(self.log, self.period)

    # -- members -------------------------------------------------------------------

    @cached_property
    def members(self) -> DataFrame:
        """Everybody with a day under each PI that has a kept project, one row per PI.

        These are the users of each of the PI's projects; `users_of` gives one project's.
        """
        everybody = stage(members.all_members(self.segments_in_period, self.period))
        return members.of_pis_with_projects(everybody, self.log.pis)

    @cached_property
    def power_members(self) -> DataFrame:
        """Power users per PI."""
        return members.power_members(self.segments_in_period, self.period)

    def users_of(self, project_id: str) -> DataFrame:
        """Everybody with a day under one project's PI, one row per term."""
        pi = self.projects.where(F.col("project_id") == project_id).select("pi")
        rows = members.all_members(self.segments_in_period, self.period)
        return members.one_row_per_term(rows.join(pi, "pi", "left_semi"))

    def power_user_list(self) -> DataFrame:
        """Name and email of every power user, per project and term."""
        staged = stage(self.power_members)
        return reports.power_user_list(members.members_of_kept(staged, self.log.pis))

    # -- lookups -------------------------------------------------------------------

    def projects_at(self, lookups: DataFrame, day: str = "day") -> DataFrame:
        """`lookups` (project_id and a day) with storage and speed code of that day."""
        history = projects.project_history(self.log)
        return as_of_join(lookups, history, "project_id", day, ["storage", "speed_code"])

    def people_at(self, lookups: DataFrame, day: str = "day") -> DataFrame:
        """`lookups` (email and a day) with term, PI and privilege of that day."""
        return as_of_join(lookups, self.segments, "email", day, ["term_no", "pi_name", "power_user"])

    # -- prices --------------------------------------------------------------------

    @cached_property
    def candidates(self) -> DataFrame:
        """Power users per PI with the mark whether they used enough days."""
        return pricing.charged(self.power_members, self.period)

    @cached_property
    def staged_candidates(self) -> DataFrame:
        """The same, written once for the reports per person."""
        return stage(self.candidates)

    @cached_property
    def priced_members(self) -> DataFrame:
        """One row per power user of each billable project."""
        return pricing.priced_members(
            self.staged_candidates, self.log.pis, self.period, self.policy
        )

    def charges_from(self, candidates: DataFrame) -> DataFrame:
        """All prices of billable projects, from power users that may be staged."""
        per_pi = pricing.compute_per_pi(candidates, self.policy).drop("first_charged")
        kept = projects.projects(self.log, self.period, per_holder=per_pi)
        return pricing.quarter_charges(kept, self.period, self.policy)

    @cached_property
    def storage_charges(self) -> DataFrame:
        """Storage amount and price of billable projects."""
        return pricing.storage_charges(self.projects, self.period, self.policy)

    @cached_property
    def charges(self) -> DataFrame:
        """All prices of billable projects."""
        return self.charges_from(self.candidates)

    # -- reports -------------------------------------------------------------------

    def summary(self) -> DataFrame:
        """The quarter summary."""
        return reports.summary(self.charges)

    def totals(self) -> DataFrame:
        """Grand totals and means."""
        return reports.totals(self.charges)

    def _heads(self, bill_date: dt.date | None) -> DataFrame:
        return reports.bill_heads(
            self.charges_from(self.staged_candidates),
            self.period,
            self.policy,
            bill_date or today(),
        )

    def bill_lines(self, bill_date: dt.date | None = None) -> DataFrame:
        """All bills, one row per line."""
        return reports.bill_lines(
            self._heads(bill_date),
            reports.bill_users(self.priced_members, self.period, self.policy),
            self.policy,
        )

    def bills(
        self,
        bill_date: dt.date | None = None,
        users_in_part: int = reports.USERS_IN_PART,
    ) -> DataFrame:
        """Nested bills, one row per project and part."""
        return reports.bills(
            self._heads(bill_date),
            reports.bill_users(self.priced_members, self.period, self.policy),
            users_in_part,
        )

    def bill_documents(
        self,
        bill_date: dt.date | None = None,
        users_in_part: int = reports.USERS_IN_PART,
    ) -> DataFrame:
        """Rendered bills, one row per project and part."""
        return reports.bill_documents(self.bills(bill_date, users_in_part), self.policy)

    def bill_of(
        self,
        project_id: str,
        bill_date: dt.date | None = None,
        users_in_part: int = reports.USERS_IN_PART,
    ) -> DataFrame:
        """The rendered bill of one project; no row where it is not billable."""
        pi = self.projects.where(F.col("project_id") == project_id).select("pi")
        candidates = stage(self.candidates.join(pi, "pi", "left_semi"))
        charges = self.charges_from(candidates).where(F.col("project_id") == project_id)
        priced = pricing.priced_members(
            candidates, self.log.pis, self.period, self.policy
        ).where(F.col("project_id") == project_id)
        nested = reports.bills(
            reports.bill_heads(charges, self.period, self.policy, bill_date or today()),
            reports.bill_users(priced, self.period, self.policy),
            users_in_part,
        )
        return reports.bill_documents(nested, self.policy)

    # -- checks --------------------------------------------------------------------

    def violations(self, *, strict: bool = False) -> DataFrame:
        """All findings of the data-quality rules."""
        walked = stage_by(self.walked, "email")
        replayed = terms.kept_for(terms.segments(walked), self.period)
        log = projects.staged_log(self.log)
        power = stage(members.power_members(terms.apply_closures(self._recent(replayed), log.pis), self.period))
        found = (
            checks.form_findings(self.forms, self.period)
            .unionByName(checks.replay_findings(walked))
            .unionByName(checks.project_findings(log, projects.projects(log, self.period), self.period))
            .unionByName(checks.closure_findings(replayed, log.pis))
            .unionByName(checks.unattached(power, log.pis))
        )
        return checks.raise_if_any(found) if strict else found
