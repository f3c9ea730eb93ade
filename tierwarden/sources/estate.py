"""A catalog, tag history, roles and access requests that grow with the data.

The reference's own catalog has 81 columns; an estate big enough to matter has
millions.  Here every part is one governed column (16 to a table), every line
item is one SET TAG statement on such a column, every supplier is one team role
modelled on one of the seven base roles, and every event is one access request.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwarden.model import (
    MASK_BINDINGS, RANKS, ROLE_NAMES, ROLE_TIERS, ROLES, SCHEMA, TAG_FIELDS, local_df,
)
from tierwarden.operators import catalog as C
from tierwarden.operators.durable import scratch_path, write_through
from tierwarden.sources.raw import read_raw

WIDTH = 16                       # columns per derived table
SNAPSHOT_CUT = "2000-01-01"      # the stored snapshot knows assignments before this day
ORDER = ["assigned_at", "statement_id", "line"]
TEAMS = ["Compliance Team", "Finance Team", "HR Team", "Security Team", "Risk & Fraud Team"]


def pick(index: Column, values: list[str | None]) -> Column:
    """values[index] as a CASE expression (stays inside generated code)."""
    out = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], 1):
        out = out.when(index == i, F.lit(v))
    return out


def table_of(key: str) -> Column:
    return F.concat(F.lit("T"), F.lpad(F.floor(F.col(key) / WIDTH).cast("string"), 10, "0"))


def column_of(key: str) -> Column:
    return F.concat(F.lit("C"), F.lpad((F.col(key) % WIDTH).cast("string"), 2, "0"))


class Estate:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_raw(self.spark, self.dir, name)

    @cached_property
    def inventory(self) -> DataFrame:
        """Column inventory: one row per part."""
        return self.inventory_of(self.raw("part"))

    @staticmethod
    def inventory_of(part: DataFrame) -> DataFrame:
        kind = (F.when(F.col("p_type") == "ECONOMY", "TEXT").when(F.col("p_type") == "SMALL", "NUMBER")
                .when(F.col("p_type") == "MEDIUM", "DATE").when(F.col("p_type") == "PROMO", "BOOLEAN")
                .when(F.col("p_type") == "STANDARD", "TIMESTAMP_NTZ").otherwise(""))
        return part.select(
            F.lit(SCHEMA).alias("table_schema"),
            table_of("p_partkey").alias("table_name"), column_of("p_partkey").alias("column_name"),
            kind.alias("data_type"),
            F.when(F.col("p_size") % 2 == 0, "NO").when(F.col("p_size") % 5 != 0, "YES").alias("is_nullable"),
            (F.col("p_partkey") % WIDTH + 1).cast("int").alias("ordinal_position"))

    @cached_property
    def live_inventory(self) -> DataFrame:
        """The inventory without retired columns (size 50)."""
        return self.inventory_of(self.raw("part").where(F.col("p_size") < 50))

    @cached_property
    def history(self) -> DataFrame:
        """SET TAG statements: one row per line item."""
        return self.history_of(self.raw("lineitem"))

    @staticmethod
    def history_of(lineitem: DataFrame) -> DataFrame:
        n = F.col("l_linenumber")
        qty = F.col("l_quantity").cast("int")
        tag = (F.when(n <= 3, "data_classification").when(n == 4, "data_category")
               .when(n == 5, "encryption_required").when(n == 6, "retention_policy")
               .otherwise("data_owner"))
        value = (F.when(n <= 3, pick(qty % 10, ["Restricted", "Restricted", "PII", "PII", "Internal",
                                                 " Internal ", "Internal", "Public", "", "Secret"]))
                 .when(n == 4, pick(qty % 4, ["Personal", "Financial", "Operational", ""]))
                 .when(n == 5, pick(qty % 3, ["Yes", "No", ""]))
                 .when(n == 6, pick(qty % 5, ["30_days", "1_year", "7_years", "Indefinite", ""]))
                 .otherwise(pick(qty % 7, TEAMS + ["", None])))
        return lineitem.select(
            table_of("l_partkey").alias("table_name"), column_of("l_partkey").alias("column_name"),
            tag.alias("tag_name"), value.alias("tag_value"),
            F.col("l_shipdate").alias("assigned_at"), F.col("l_orderkey").alias("statement_id"),
            n.alias("line"))

    @cached_property
    def assigned(self) -> DataFrame:
        """Current long-form tags (column, tag, value)."""
        return C.assign_tags(self.history, ORDER)

    @cached_property
    def tags(self) -> DataFrame:
        """Current wide-form tags."""
        return C.current_tags(self.history, ORDER)

    @cached_property
    def old_tags(self) -> DataFrame:
        """Wide-form tags as the last snapshot saw them."""
        return C.current_tags(
            self.history.where(F.col("assigned_at") < F.lit(SNAPSHOT_CUT).cast("timestamp_ntz")), ORDER)

    @cached_property
    def catalog(self) -> DataFrame:
        """Stored catalog: inventory + tags, defaults filled, whitespace removed."""
        return C.fill_tag_defaults(C.column_catalog(self.tags, self.inventory), trim=True)

    @cached_property
    def stored_catalog(self) -> DataFrame:
        """The catalog as it was stored when the snapshot was taken."""
        return C.fill_tag_defaults(C.column_catalog(self.old_tags, self.inventory), trim=True)

    @cached_property
    def incoming_catalog(self) -> DataFrame:
        """What a sync reads now: live columns, tags as they are."""
        return C.column_catalog(self.tags, self.live_inventory)

    @cached_property
    def policy_refs(self) -> DataFrame:
        """Policy bound to a derived column: masks on sizes 1-24, row rules on 25-27."""
        names = sorted({p for cols in MASK_BINDINGS.values() for p in cols.values()})
        rules = ["CUSTOMER_ROW_POLICY", "EMPLOYEE_ROW_POLICY", "TRANSACTION_FRAUD_POLICY"]
        size = F.col("p_size")
        return self.raw("part").where(size <= 27).select(
            table_of("p_partkey").alias("table_name"), column_of("p_partkey").alias("column_name"),
            F.when(size <= 24, pick(size % 6, names)).otherwise(pick(size - 25, rules)).alias("policy_name"),
            F.when(size <= 24, "MASKING_POLICY").otherwise("ROW_ACCESS_POLICY").alias("policy_kind"),
            F.when(size % 8 == 0, "INACTIVE").otherwise("ACTIVE").alias("policy_status"))

    # -- roles ---------------------------------------------------------------

    @cached_property
    def _base_role(self) -> Column:
        return pick(F.col("s_suppkey") % len(ROLE_NAMES), ROLE_NAMES)

    @cached_property
    def teams(self) -> DataFrame:
        """One team role per supplier; description and rights follow its base role."""
        base = local_df(self.spark, ROLES, "base string, description string, base_level int, "
                                           "can_manage_policies boolean")
        return (self.raw("supplier")
                .select(F.concat(F.lit("TEAM_"), F.lpad(F.col("s_suppkey").cast("string"), 10, "0")).alias("name"),
                        self._base_role.alias("base"))
                .join(base, "base")
                .select("name", "description", F.col("base_level").alias("hierarchy_level"),
                        "can_manage_policies", "base"))

    @cached_property
    def team_access(self) -> DataFrame:
        """CAN_ACCESS pairs of the team roles (at most four per role)."""
        pairs = local_df(self.spark, [(r, t) for r, ts in ROLE_TIERS.items() for t in ts],
                         "base string, classification string")
        return self.teams.join(pairs, "base").select(F.col("name").alias("role"), "classification")

    @cached_property
    def team_tree(self) -> DataFrame:
        """INHERITS_FROM: a four-way tree over the team roles."""
        def team(key: Column) -> Column:
            return F.concat(F.lit("TEAM_"), F.lpad(key.cast("string"), 10, "0"))
        k = F.col("s_suppkey")
        return (self.raw("supplier").where(k > 0)
                .select(team(F.floor((k - 1) / 4)).alias("parent"), team(k).alias("child")))

    # -- requests ------------------------------------------------------------

    @cached_property
    def requests(self) -> DataFrame:
        """One access request per event; one reader in eight holds no known role."""
        tier = pick(F.col("event_id") % 4, list(RANKS))
        return self.raw("events").select(
            F.col("event_id").alias("request_id"),
            pick(F.col("user_id") % 8, ROLE_NAMES + ["GUEST"]).alias("role"),
            tier.alias("classification"))


class Drifting(Estate):
    """The estate for questions about both states: now and at the last snapshot.

    The statements are read once for the two, and the states are stored.
    """

    @cached_property
    def _states(self) -> DataFrame:
        cut = F.col("assigned_at") < F.lit(SNAPSHOT_CUT).cast("timestamp_ntz")
        return write_through(C.tags_before(self.history, ORDER, cut), scratch_path(self.spark, "states"))

    @cached_property
    def tags(self) -> DataFrame:
        return self._states.select(*C.KEY, *TAG_FIELDS)

    @cached_property
    def old_tags(self) -> DataFrame:
        return self._states.where("known").select(*C.KEY, *[F.col(f"was_{f}").alias(f) for f in TAG_FIELDS])
