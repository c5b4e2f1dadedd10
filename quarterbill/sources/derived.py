"""Form tables derived from a star schema (supplier, orders, lineitem).

Stand-in input for tests and benchmarks: suppliers act as PIs, customers as users, line
items as storage updates. Rows grow with the given tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbill.sources.schemas import FORMS

QUARTER = "1998-07-01"


def _first_start(key: str) -> str:
    """When a supplier's first project opens."""
    return f"""CASE {key} % 10 WHEN 8 THEN timestamp_ntz'1998-08-15 09:00:00'
                    WHEN 7 THEN timestamp_ntz'1998-11-01 09:00:00'
               ELSE timestamp_ntz'1994-01-01 09:00:00'
                    + make_dt_interval(cast({key} % 300 AS int)) END"""


class DerivedForms:
    """The four forms, already canonical; each is made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark = spark
        self._sf_dir = sf_dir

    def _table(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._sf_dir}/{name}.parquet")

    @cached_property
    def _supplier(self) -> DataFrame:
        return self._table("supplier").selectExpr(
            "*",
            "concat('pi', s_suppkey, '@x.org') AS email",
            "concat('pi', s_suppkey) AS last_name",
            "s_acctbal > 5000 AS pi_is_power_user",
        )

    @cached_property
    def pi(self) -> DataFrame:
        """One project per supplier, a second one for every tenth."""
        first = self._supplier.selectExpr(
            f"{_first_start('s_suppkey')} AS start_timestamp",
            "email",
            "last_name",
            "pi_is_power_user",
            "concat('sc', s_suppkey) AS speed_code",
            "cast(1 + s_suppkey % 8 AS double) AS storage",
        )
        second = self._supplier.where("s_suppkey % 10 = 3").selectExpr(
            "timestamp_ntz'1998-07-20 09:00:00' AS start_timestamp",
            "email",
            "last_name",
            "pi_is_power_user",
            "concat('sc2-', s_suppkey) AS speed_code",
            "0.214D AS storage",
        )
        return first.unionByName(second)

    @cached_property
    def pi_update(self) -> DataFrame:
        """Storage and code changes from line items; closures of every tenth supplier.

        Three in four closures come from another person's email.
        """
        changes = (
            self._table("lineitem")
            .selectExpr(
                # the line's number in microseconds keeps the order of an order's lines
                """l_shipdate + make_dt_interval(0, 0, 0,
                     cast(l_orderkey % 86400 AS decimal(18,6)) + l_linenumber * 0.000001)
                   AS timestamp""",
                "concat('pi', l_suppkey, '@x.org') AS email",
                "concat('pi', l_suppkey) AS last_name",
                "CASE WHEN l_returnflag = 'A' THEN concat('sc', l_partkey) END AS speed_code",
                "CASE WHEN l_linestatus = 'F' THEN l_quantity / 8 END AS new_storage",
                "false AS account_closed",
            )
        )
        closures = self._supplier.where("s_suppkey % 10 = 9").selectExpr(
            """if(s_suppkey % 20 = 9, timestamp_ntz'1998-08-20 10:00:00',
                  timestamp_ntz'1998-09-15 10:00:00') AS timestamp""",
            "if(s_suppkey % 40 = 9, email, concat('office', s_suppkey, '@x.org')) AS email",
            "last_name",
            "cast(NULL AS string) AS speed_code",
            "cast(NULL AS double) AS new_storage",
            "true AS account_closed",
        )
        return changes.unionByName(closures)

    @cached_property
    def _orders(self) -> DataFrame:
        """Orders as submissions; microseconds keep one person's replay order unique."""
        suppliers = self._table("supplier").select(F.count(F.lit(1))).scalar()
        return (
            self._table("orders")
            .withColumn(
                "k", (F.col("o_custkey") + F.col("o_orderkey") % 3) % suppliers
            )
            .selectExpr(
                "o_custkey",
                "o_orderkey",
                """o_orderdate + make_dt_interval(0, 0, 0,
                     cast(o_orderkey % 86400000000 AS decimal(18,0)) / 1000000) AS ts""",
                "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS hi",
                "if(k % 10 IN (7, 9), k - 5, k) AS pk",
            )
            .selectExpr(
                "*",
                """CASE WHEN o_custkey % 5 <> 0
                     THEN ts + make_dt_interval(cast(400 + o_orderkey % 200 AS int)) END
                   AS end""",
            )
        )

    @cached_property
    def _first_orders(self) -> DataFrame:
        first = F.min(F.struct("ts", "o_orderkey", "hi", "pk", "end")).alias("first")
        return self._orders.groupBy("o_custkey").agg(first).select("o_custkey", "first.*")

    @cached_property
    def user(self) -> DataFrame:
        """A customer's first order is the account request."""
        return self._first_orders.selectExpr(
            "ts AS start_timestamp",
            "concat('c', o_custkey, '@x.org') AS email",
            "concat('c', o_custkey) AS last_name",
            "concat('pi', pk) AS pi_last_name",
            "hi AS power_user",
            "end AS end_timestamp",
        )

    @cached_property
    def user_update(self) -> DataFrame:
        """Every further order is an account update; some PIs end their own term.

        Where another person closes such a PI's project, the term is over by then, or a
        later one has begun.
        """
        further = self._orders.join(
            self._first_orders.select("o_orderkey"), "o_orderkey", "left_anti"
        )
        asked = further.selectExpr(
            "ts AS timestamp",
            "concat('c', o_custkey, '@x.org') AS email",
            "concat('c', o_custkey) AS last_name",
            "CASE WHEN o_orderkey % 4 = 0 THEN concat('pi', pk) END AS pi_last_name",
            "CASE WHEN o_orderkey % 3 <> 1 THEN hi END AS new_power_user",
            "end AS new_end_timestamp",
        )
        own = self._supplier.selectExpr(
            """explode(CASE s_suppkey % 40
                 WHEN 29 THEN array(
                   struct(timestamp_ntz'1998-06-01 10:00:00' AS timestamp,
                          timestamp_ntz'1998-08-01 00:00:00' AS end))
                 WHEN 39 THEN array(
                   struct(timestamp_ntz'1998-01-10 10:00:00' AS timestamp,
                          timestamp_ntz'1998-03-01 00:00:00' AS end),
                   struct(timestamp_ntz'1998-09-20 10:00:00' AS timestamp,
                          timestamp_ntz'1999-06-30 00:00:00' AS end)) END) AS change""",
            "email",
            "last_name",
        ).selectExpr(
            "change.timestamp",
            "email",
            "last_name",
            "cast(NULL AS string) AS pi_last_name",
            "cast(NULL AS boolean) AS new_power_user",
            "change.end AS new_end_timestamp",
        )
        return asked.unionByName(own)


class DerivedEvents:
    """Tables of events: suppliers and line items as those of projects, orders as those of users."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._forms = DerivedForms(spark, sf_dir)

    @cached_property
    def project_events(self) -> DataFrame:
        """Openings, changes and closures."""
        opened = self._forms.pi.selectExpr(
            "'open' AS kind", "start_timestamp AS ts", "email", "last_name AS pi", "speed_code",
            "storage", "pi_is_power_user AS power_user",
        )
        later = self._forms.pi_update.selectExpr(
            "if(account_closed, 'close', 'update') AS kind", "timestamp AS ts", "email", "last_name AS pi",
            "speed_code", "new_storage AS storage", "cast(NULL AS boolean) AS power_user",
        )
        return opened.unionByName(later)

    @cached_property
    def user_events(self) -> DataFrame:
        """Requests and changes."""
        asked = self._forms.user.selectExpr(
            "'request' AS kind", "start_timestamp AS ts", "email", "last_name AS name", "pi_last_name AS pi_name",
            "power_user", "cast(end_timestamp AS date) AS end_date",
        )
        later = self._forms.user_update.selectExpr(
            "'update' AS kind", "timestamp AS ts", "email", "last_name AS name", "pi_last_name AS pi_name",
            "new_power_user AS power_user", "cast(new_end_timestamp AS date) AS end_date",
        )
        return asked.unionByName(later)


class DirtyForms:
    """The derived forms with faults in them, for the checks."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._clean = DerivedForms(spark, sf_dir)

    _NUMBER = r"cast(regexp_extract(last_name, '(\\d+)$', 1) AS bigint)"

    @cached_property
    def pi(self) -> DataFrame:
        """Some requests lack storage, a speed code, a PI or an email."""
        return self._clean.pi.selectExpr(
            "* EXCEPT (storage, speed_code, last_name, email)",
            f"if({self._NUMBER} % 20 <> 6, last_name, NULL) AS last_name",
            f"if({self._NUMBER} % 20 <> 1, email, NULL) AS email",
            f"if({self._NUMBER} % 10 <> 2, storage, NULL) AS storage",
            f"if({self._NUMBER} % 10 <> 4, speed_code, NULL) AS speed_code",
        )

    @cached_property
    def pi_update(self) -> DataFrame:
        """Some updates name an unknown PI, some come before the first request."""
        clean = self._clean.pi_update
        strays = clean.where(f"{self._NUMBER} % 10 = 5").withColumn(
            "last_name", F.concat(F.lit("no"), "last_name")
        )
        early = clean.where("account_closed").selectExpr(
            "* EXCEPT (timestamp, account_closed)",
            "timestamp_ntz'1990-01-01 00:00:00' AS timestamp",
            "false AS account_closed",
        )
        return clean.unionByName(strays).unionByName(early)

    @cached_property
    def user(self) -> DataFrame:
        """Some requests lack an email, a PI, a privilege or a time, or have an unreadable cell."""
        return self._clean.user.selectExpr(
            "* EXCEPT (email, pi_last_name, power_user, start_timestamp)",
            f"if({self._NUMBER} % 59 = 7, 'end_timestamp', NULL) AS unreadable",
            f"if({self._NUMBER} % 47 <> 5, power_user, NULL) AS power_user",
            f"if({self._NUMBER} % 53 <> 6, start_timestamp, NULL) AS start_timestamp",
            f"if({self._NUMBER} % 41 <> 3, email, NULL) AS email",
            f"if({self._NUMBER} % 43 <> 4, pi_last_name, NULL) AS pi_last_name",
        )

    @cached_property
    def user_update(self) -> DataFrame:
        """Some updates end long ago, some reinstate without an end, some name nobody."""
        return self._clean.user_update.selectExpr(
            "* EXCEPT (new_end_timestamp, pi_last_name)",
            f"""CASE WHEN {self._NUMBER} % 37 = 5
                       THEN timestamp - make_dt_interval(4000)
                     WHEN {self._NUMBER} % 31 = 6 THEN NULL
                     ELSE new_end_timestamp END AS new_end_timestamp""",
            """if(date_diff(timestamp, date'1990-01-01') % 29 = 0, 'nobody', pi_last_name)
               AS pi_last_name""",
        )


def as_submitted(form_rows: DataFrame, form: str) -> DataFrame:
    """The same rows as a person would type them: headers, text cells, stray blanks."""
    columns = []
    for field in FORMS[form]:
        if field.name not in form_rows.columns:
            continue
        if field.reading == "yes":
            typed = f"if({field.name}, ' YES ', 'no')"
        elif field.reading == "power_user":
            typed = f"if({field.name}, 'Power User\\t', 'Regular user')"
            typed = f"if({field.name} IS NULL, NULL, {typed})"
        elif field.type.typeName() == "string":
            typed = f"concat('  ', upper({field.name}), '  ')"
        else:
            typed = f"cast({field.name} AS string)"
        columns.append(f"{typed} AS `{field.header}`")
    return form_rows.selectExpr(*columns)
