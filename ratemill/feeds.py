"""The three feeds: columns, merge keys and rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from ratemill.operators.merge import MergeRule

MAX_TEXT = 50
ID = "ID"
# Names of a field's metadata: Spark's for the default of new and of missing values, and our own.
DEFAULT_KEYS = ("CURRENT_DEFAULT", "EXISTS_DEFAULT")
LENGTH_KEY = "max_length"

# kind -> (Spark type, default as SQL text). `code` is text that must hold an integer and is
# stored without leading zeros.
KINDS = {
    "string": (T.StringType(), "''"),
    "code": (T.StringType(), "''"),
    "int": (T.IntegerType(), "0"),
    "double": (T.DoubleType(), "0.0D"),
    "date": (T.DateType(), "DATE'1900-01-01'"),
}


@dataclass(frozen=True)
class Column:
    name: str
    kind: str
    nullable: bool = False
    has_default: bool = True
    default_sql: str | None = None  # else the default of the kind

    @property
    def spark_type(self) -> T.DataType:
        return KINDS[self.kind][0]

    @property
    def default(self) -> str:
        if not self.has_default:
            return "NULL"
        return self.default_sql or KINDS[self.kind][1]

    @property
    def is_text(self) -> bool:
        return self.kind in ("string", "code")


@dataclass(frozen=True)
class FeedSpec:
    """What a feed looks like and how it merges into its table."""

    name: str
    table: str
    signature: tuple[str, ...]
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    mode: str = "strict"  # strict: a bad value is a violation; lenient: it becomes the default
    update_when: str = "always"  # always | changed
    insert_only: tuple[str, ...] = ()
    key_collation: str | None = None
    names: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "names", tuple(c.name for c in self.columns))

    @property
    def rule(self) -> MergeRule:
        return MergeRule(
            key=self.key,
            columns=self.names,
            insert_only=self.insert_only,
            update_when=self.update_when,
            key_collation=self.key_collation,
            integer_keys=tuple(
                c.name for c in self.columns if c.kind == "code" and c.name in self.key
            ),
            text_keys=tuple(
                c.name for c in self.columns if c.kind == "string" and c.name in self.key
            ),
        )

    @property
    def schema(self) -> T.StructType:
        """The table: the feed's columns and the generated ID, with what a value may be.

        A default is metadata that Spark's readers know: files written before the column was
        added give it for every row.
        """

        def table_field(c: Column) -> T.StructField:
            about = dict.fromkeys(DEFAULT_KEYS, c.default) if c.has_default else {}
            if c.is_text:
                about[LENGTH_KEY] = MAX_TEXT
            return T.StructField(c.name, c.spark_type, c.nullable, about)

        return T.StructType([*map(table_field, self.columns), T.StructField(ID, T.LongType(), False)])


def _columns(text: str) -> tuple[Column, ...]:
    """Columns from ``NAME kind`` lines; ``null`` marks a nullable one without a default."""
    out = []
    for line in text.split("\n"):
        if line.strip():
            name, kind, *rest = line.split()
            nullable = "null" in rest
            out.append(Column(name, kind, nullable, has_default=not nullable))
    return tuple(out)


# Column names, order, types, signatures and keys of the three feeds.

STUMPAGE = FeedSpec(
    name="stumpage",
    table="stumpage_rates",
    signature=("PRODUCT_TYPE_CODE", "PRODUCT_TYPE_NAME"),
    columns=_columns("""
        TYPE                string
        RATE_ID             int
        PRODUCT_TYPE_CODE   string
        PRODUCT_TYPE_NAME   string
        SPECIES_GROUP_CODE  string
        SPECIES_GROUP_NAME  string
        RATE_TYPE_CODE      string
        RATE_TYPE_NAME      string
        RATE                double
        EFFECTIVE_DATE      date
        EXPIRY_DATE         date
    """),
    key=("RATE_ID", "PRODUCT_TYPE_CODE"),
)

RENEWAL = FeedSpec(
    name="renewal",
    table="renewal_rates",
    signature=("MANAGEMENT_UNIT_CODE", "MANAGEMENT_UNIT_NAME"),
    columns=_columns("""
        TYPE                  string
        RATE_ID               int
        MANAGEMENT_UNIT_CODE  code
        MANAGEMENT_UNIT_NAME  string
        SPECIES_GROUP_CODE    string
        SPECIES_GROUP_NAME    string
        RATE_TYPE_CODE        string
        RATE_TYPE_NAME        string
        RATE                  double
        EFFECTIVE_DATE        date
        EXPIRY_DATE           date
    """),
    key=("RATE_ID", "MANAGEMENT_UNIT_CODE"),
    insert_only=("SPECIES_GROUP_CODE",),
)

FACTOR = FeedSpec(
    name="factor",
    table="factor_rates",
    signature=("FACTOR_ID", "TALLY_DESTINATION_CODE"),
    columns=_columns("""
        TYPE                    string
        FACTOR_ID               int
        APPROVAL_NUMBER         string
        SCALING_METHOD_CODE     string
        TALLY_DESTINATION_CODE  string
        TALLY_SPECIES_CODE      string
        TALLY_GRADE             string
        CONTAINER_CODE          string
        CHARGE_TYPE             string
        LICENCE_NUMBER          string
        ACCOUNT_CODE            string
        MANAGEMENT_UNIT         string
        REDUCTION_RATE          double
        EFFECTIVE_DATE          date
        EXPIRY_DATE             date
        DESTINATION_CODE        string
        PRODUCT_TYPE            string
        DESTINATION_TYPE        string
        TAX_CODE                string
        TAX_RATE                double
        SPECIES_CODE            string
        SPECIES_GROUP           string
        GRADE                   string
        DESTINATION_SHARE       double null
        SPECIES_SHARE           double
        GRADE_SHARE             double
        MASS_VOLUME_RATIO       double
        TREE_LENGTH_TABLE       double
        CONTAINER_VOLUME        double
        UNDERSIZE_DEDUCTION     double
        CULL_DEDUCTION          double
    """),
    key=("FACTOR_ID", "TALLY_DESTINATION_CODE", "DESTINATION_CODE", "SPECIES_CODE"),
    mode="lenient",
    update_when="changed",
)

# Order matters: the first feed whose signature columns are all in the header wins.
FEEDS: tuple[FeedSpec, ...] = (RENEWAL, STUMPAGE, FACTOR)
