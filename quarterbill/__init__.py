"""Quarterly tenure-and-usage billing as Spark DataFrame jobs."""

from quarterbill.functions.periods import Period
from quarterbill.functions.policy import Policy
from quarterbill.plans.billing import QuarterBilling
from quarterbill.plans.jobs import bill_quarter, list_power_users
from quarterbill.sources.event_tables import EventTables
from quarterbill.sources.forms import Forms, read_form, read_forms
from quarterbill.sources.publish import publish, read_report

__all__ = ["EventTables", "Forms", "Period", "Policy", "QuarterBilling", "bill_quarter", "list_power_users",
           "publish", "read_form", "read_forms", "read_report"]
