"""The four form tables: source headers, canonical names and types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class FormField:
    """One column: canonical name, header in the source form, type, how text is read."""

    name: str
    header: str
    type: T.DataType
    reading: str = "plain"  # plain | yes | power_user


TEXT = T.StringType()
TIME = T.TimestampNTZType()
NUMBER = T.DoubleType()
FLAG = T.BooleanType()

# Headers of the source forms and the names they get.
USER_FORM = (
    FormField("start_timestamp", "Completion time", TIME),
    FormField("email", "UWO.CA email address", TEXT),
    FormField("first_name", "First name", TEXT),
    FormField("last_name", "Last name", TEXT),
    FormField("pi_last_name", "PI last name", TEXT),
    FormField("end_timestamp", "Contract end date", TIME),
    FormField(
        "power_user",
        "Do you need your account to be a Power User account",
        FLAG,
        "yes",
    ),
)
USER_UPDATE_FORM = (
    FormField("timestamp", "Completion time", TIME),
    FormField("email", "UWO.CA email address", TEXT),
    FormField("first_name", "First name", TEXT),
    FormField("last_name", "Last name", TEXT),
    FormField("pi_last_name", "PI Last name (e.g., Smith)", TEXT),
    FormField("additional_datashare", "Request access to additional datashare ", TEXT),
    FormField("new_end_timestamp", "Update contract end date", TIME),
    FormField("new_power_user", "Change account type", FLAG, "power_user"),
    FormField(
        "new_projects", "List projects for which you need security access", TEXT
    ),
    FormField("agree", "Consent", FLAG, "yes"),
    FormField("feedback", "Please feel free to leave any feedback", TEXT),
)
PI_FORM = (
    FormField("start_timestamp", "Completion time", TIME),
    FormField("email", "UWO email address", TEXT),
    FormField("first_name", "First Name", TEXT),
    FormField("last_name", "Last Name", TEXT),
    FormField(
        "pi_is_power_user",
        "Would you like your account to be a power user account?",
        FLAG,
        "yes",
    ),
    FormField("speed_code", "Speed code", TEXT),
    FormField("storage", "Required storage needs (in TB)", NUMBER),
)
PI_UPDATE_FORM = (
    FormField("timestamp", "Completion time", TIME),
    FormField("email", "UWO.CA email address", TEXT),
    FormField("first_name", "First name", TEXT),
    FormField("last_name", "Last name", TEXT),
    FormField("new_storage", "Additional storage needs (in TB)", NUMBER),
    FormField("speed_code", "New speed code", TEXT),
    FormField("access_groups", "New secure project spaces names", TEXT),
    FormField("agree", "Consent", FLAG, "yes"),
    FormField("feedback", "Please feel free to leave any feedback", TEXT),
    FormField("account_closed", "Account closure2", FLAG, "yes"),
)

FORMS = {
    "pi": PI_FORM,
    "pi_update": PI_UPDATE_FORM,
    "user": USER_FORM,
    "user_update": USER_UPDATE_FORM,
}

# A form may also carry a running number; it breaks ties between equal timestamps.
SUBMISSION_ID = "submission_id"

# Reading a form from text adds this column.
UNREADABLE = "unreadable"
