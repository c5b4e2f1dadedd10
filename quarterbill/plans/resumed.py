"""Billing that starts from the last quarter's snapshot and reads newer forms only."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from quarterbill.functions.periods import Period
from quarterbill.functions.policy import Policy
from quarterbill.operators import events, projects, snapshot
from quarterbill.operators.spread import stage
from quarterbill.plans.billing import QuarterBilling
from quarterbill.sources.form_store import FormStore
from quarterbill.sources.publish import publish, read_note, read_report


def take_snapshot(spark: SparkSession, store: FormStore, before: dt.date, folder: str) -> None:
    """Write the state of all people and projects at the start of a day, as one.

    It notes the last batch of forms that it has seen.
    """
    last = max(store.batches(), default=0)
    forms = store.forms(upto=last)
    tables = {"people": snapshot.people(snapshot.events_before(forms, before)), **snapshot.project_state(forms, before)}
    publish(spark, tables, before, folder, note={"batch": last})


class ResumedBilling(QuarterBilling):
    """All results for a period that starts on or after a snapshot's day.

    Newer batches are replayed on top of the snapshot. Where they hold events from before its
    day, or older batches hold events from after it, those are added: people and PIs with late events
    are replayed from all batches, and nobody else is.
    """

    def __init__(
        self,
        spark: SparkSession,
        store: FormStore,
        folder: str,
        before: dt.date,
        period: Period,
        policy: Policy | None = None,
    ) -> None:
        if period.start < before:
            raise ValueError(f"the snapshot of {before} cannot tell what was before it")
        self._spark, self._store, self._folder, self._before = spark, store, folder, before
        self._batch = read_note(spark, folder, before)["batch"]
        super().__init__(store.forms(after=self._batch), period, policy)

    def _table(self, name: str) -> DataFrame:
        return read_report(self._spark, self._folder, name, self._before).drop("quarter_start")

    @cached_property
    def _whole(self) -> object:
        return self._store.forms()

    def _late(self, newer: DataFrame, key: str) -> DataFrame | None:
        """The keys with newer rows from before the snapshot's day; None if there are none."""
        late = newer.where(f"date < date'{self._before}'").select(key).distinct()
        staged = stage(late.where(f"{key} IS NOT NULL"))
        return None if staged.isEmpty() else staged

    @cached_property
    def walked(self) -> DataFrame:
        """The user log by person and day, with the terms numbered."""
        newer, days = self.user_events, self._table("people")
        late = self._late(newer, "email")
        if late is not None:
            again = events.user_events(self._whole, self.period).join(late, "email", "left_semi")
            newer = newer.join(late, "email", "left_anti").unionByName(again)
            days = days.join(late, "email", "left_anti")
        return snapshot.resume_people(days, newer)

    @cached_property
    def log(self) -> projects.ProjectLog:
        """The reduced project log."""
        asked = events.pi_requests(self.forms, self.period).select("pi", "date")
        late = self._late(asked.unionByName(events.pi_updates(self.forms, self.period).select("pi", "date")), "pi")
        state = {name: self._table(name) for name in ("opened", "closed", "days")}
        return snapshot.resume_projects(state, self.forms, self.period, self._before, late, None if late is None else self._whole)
