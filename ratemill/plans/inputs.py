"""The driver's tables rendered as feed text: the inputs of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill.feeds import STUMPAGE

# Lines of one rendered file; the number of files grows with the table.
FILE_LINES = 50_000

STUMPAGE_HEADER = ",".join(STUMPAGE.names)
# Lower case, another column order, and one column the table does not have.
FACTOR_HEADER = (
    "factor_id,type,tally_destination_code,destination_code,species_code,reduction_rate,"
    "tax_rate,effective_date,expiry_date,grade,note,mass_volume_ratio"
)
# The day that parts history from the new batch: both halves of the table are used.
SHIP_CUT = "1998-05-24"
EVENT_CUT = "2024-01-16 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def quoted(col: Column | str) -> Column:
    return F.concat(F.lit('"'), text(col), F.lit('"'))


def csv_line(*fields: Column | str) -> Column:
    return F.concat_ws(",", *[text(f) for f in fields])


def write_files(rows: DataFrame, header: str, folder: str, lines: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write ``rows(file_no, ord, value)`` as one file per number, each with the header first.

    A file is one task's output, so ``file_no`` must bound its lines; the files are compressed. ``lines`` makes ``ord`` and
    ``value`` of other rows, after these were dealt to their files.
    """
    heads = rows.select("file_no").distinct().withColumn("_head", F.lit(True))
    dealt = rows.withColumn("_head", F.lit(False)).unionByName(heads, allowMissingColumns=True).repartition("file_no")
    made = lines(dealt) if lines else dealt
    named = made.select(
        _six_digits("file_no").alias("file_no"),
        F.when(~F.col("_head"), F.col("ord")).alias("ord"),
        F.when(F.col("_head"), header).otherwise(F.col("value")).alias("value"),
    )
    (
        named.sortWithinPartitions("file_no", "ord")
        .select("file_no", "value")
        .write.partitionBy("file_no")
        .text(folder, compression="gzip")
    )
    return folder


def _six_digits(number: str) -> Column:
    """``%06d``, which is made from its pattern again for every row, without the pattern where digits do."""
    plain = F.lpad(text(number), 6, "0")
    return F.when(F.col(number).between(0, 999_999), plain).otherwise(F.format_string("%06d", number))


def file_no(key: str) -> Column:
    return F.floor(F.col(key) / FILE_LINES).cast("long")


def part_lines(part: DataFrame) -> DataFrame:
    """Quoted names, prices with thousands commas, every seventh row short, blank lines."""
    price = quoted(F.format_number(F.col("p_retailprice") * 10, 2))
    whole = csv_line("p_partkey", quoted("p_name"), "p_brand", "p_type", "p_size", price)
    short = csv_line("p_partkey", quoted("p_name"), "p_brand", "p_type")
    line = F.when(F.col("p_partkey") % 7 == 0, short).otherwise(whole)
    line = F.when(F.col("p_partkey") % 5 == 0, F.concat(line, F.lit("\n  "))).otherwise(line)
    return part.select(file_no("p_partkey").alias("file_no"), F.col("p_partkey").alias("ord"), line.alias("value"))


def part_lines_reversed(part: DataFrame) -> DataFrame:
    """The fields of :func:`part_lines` in the opposite order, all rows whole."""
    price = quoted(F.format_number(F.col("p_retailprice") * 10, 2))
    line = csv_line(price, "p_size", "p_type", "p_brand", quoted("p_name"), "p_partkey")
    return part.select(file_no("p_partkey").alias("file_no"), F.col("p_partkey").alias("ord"), line.alias("value"))


def part_dates() -> tuple[Column, Column]:
    start = F.date_add(F.lit("2026-04-01").cast("date"), F.col("p_size"))
    return start, F.date_add(start, 365)


def stumpage_columns() -> dict[str, Column]:
    """Raw text of the stumpage columns from ``part``."""
    start, end = part_dates()
    return {
        "TYPE": F.col("p_type"),
        "RATE_ID": text("p_partkey"),
        "PRODUCT_TYPE_CODE": F.col("p_brand"),
        "PRODUCT_TYPE_NAME": F.col("p_name"),
        "SPECIES_GROUP_CODE": text("p_size"),
        "SPECIES_GROUP_NAME": F.concat(F.lit("size, "), text("p_size")),
        "RATE_TYPE_CODE": F.substring("p_type", 1, 1),
        "RATE_TYPE_NAME": F.lower("p_type"),
        "RATE": F.format_number(F.col("p_retailprice") * 10, 2),
        "EFFECTIVE_DATE": F.date_format(start, "dMMyyyy"),
        "EXPIRY_DATE": F.date_format(end, "yyyy-MM-dd"),
    }


def stumpage_lines(part: DataFrame, changed: dict[str, Column] = {}, names: tuple[str, ...] = ()) -> DataFrame:
    """Lines of the stumpage columns, some of them ``changed`` or added, in the order of ``names``."""
    columns = stumpage_columns() | changed
    line = csv_line(*[quoted(columns[n]) for n in names or columns])
    return part.select(file_no("p_partkey").alias("file_no"), F.col("p_partkey").alias("ord"), line.alias("value"))


def renewal_columns() -> dict[str, Column]:
    """Raw text of the renewal columns from ``supplier``."""
    start = F.date_add(F.lit("2026-04-01").cast("date"), F.col("s_nationkey"))
    return {
        "TYPE": F.lit("R"),
        "RATE_ID": F.concat(F.lit("+"), text("s_suppkey")),
        "MANAGEMENT_UNIT_CODE": F.lpad(text("s_nationkey"), 4, "0"),
        "MANAGEMENT_UNIT_NAME": F.col("s_name"),
        "SPECIES_GROUP_CODE": text("s_nationkey"),
        "SPECIES_GROUP_NAME": F.upper("s_name"),
        "RATE_TYPE_CODE": F.lit("A"),
        "RATE_TYPE_NAME": F.lit("all"),
        "RATE": text(F.col("s_acctbal").cast("decimal(18,2)")),
        "EFFECTIVE_DATE": F.date_format(start, "MM/dd/yyyy"),
        "EXPIRY_DATE": F.date_format(start, "dd-MMM-yyyy"),
    }


# Numbers of customers as a factor feed: some are no numbers, some are blank.
CUSTOMER_HEADER = "FACTOR_ID,TALLY_DESTINATION_CODE,TAX_RATE,CULL_DEDUCTION,EFFECTIVE_DATE,EXPIRY_DATE"


def customer_lines(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    number = F.when(key % 5 == 0, F.concat(F.lit("x"), text(key))).otherwise(text(key))
    rate = F.when(key % 3 == 0, F.lit("n/a")).when(key % 3 == 1, F.lit(" ")).otherwise(text(F.col("c_nationkey")))
    cull = F.when(key % 7 == 0, F.lit("1e999")).otherwise(F.lit("0"))
    line = csv_line(number, quoted("c_mktsegment"), rate, cull, F.lit("01042026"), F.lit("2027-03-31"))
    return customer.select(file_no("c_custkey").alias("file_no"), key.alias("ord"), line.alias("value"))


# Of ``lineitem``: the columns that the factor feed shows.
FACTOR_COLUMNS = (
    "l_orderkey",
    "l_returnflag",
    "l_linestatus",
    "l_linenumber",
    "l_extendedprice",
    "l_tax",
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
)


def factor_rows(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` dealt to files: the columns that :func:`factor_lines` needs."""
    # A run of order keys is dealt to two files, so that keys come again in another file.
    run = F.floor(F.col("l_orderkey") * 4 / FILE_LINES).cast("long")
    return lineitem.select((2 * run + F.col("l_suppkey") % 2).alias("file_no"), *FACTOR_COLUMNS)


def factor_lines(rows: DataFrame) -> DataFrame:
    """``lineitem`` as a factor feed: key (order, flag, status, line); one row per input row."""
    ship = F.col("l_shipdate").cast("date")
    day = text(ship)
    money = F.format_number(F.col("l_extendedprice"), 2)
    line = csv_line(
        "l_orderkey",
        "l_returnflag",
        "l_returnflag",
        "l_linestatus",
        "l_linenumber",
        quoted(money),
        text(F.col("l_tax").cast("decimal(18,2)")),
        F.concat(day.substr(9, 2), day.substr(6, 2), day.substr(1, 4)),
        text(F.date_add(ship, 30)),
        F.concat(F.lit("G"), text("l_partkey")),
        quoted(F.concat(F.lit("supplier, "), text("l_suppkey"))),
        text(F.col("l_quantity").cast("int")),
    )
    order = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax")
    return rows.withColumns({"ord": F.struct("l_orderkey", order.alias("o")), "value": line})


def spoiled_value() -> Column:
    """``events.value`` as number text in eight shapes, good and bad."""
    dec = F.col("value").cast("decimal(18,2)")
    whole = text(F.floor("value"))
    shapes = [
        text(dec),
        F.concat(F.lit(" "), whole, F.lit(" ")),
        F.concat(F.lit("+"), whole),
        F.format_number(F.col("value") * 1000, 2),
        F.concat(text(dec), F.lit("e3")),
        F.concat(text(dec), F.lit("d")),
        F.lit(""),
        F.lit(None).cast("string"),
    ]
    out = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        out = F.when(F.col("event_id") % 8 == i, shape).otherwise(out)
    return out


def spoiled_date() -> Column:
    """``o_orderdate`` as date text in eighteen shapes, the last five of them no date."""
    day = F.col("o_orderdate").cast("date")
    shapes = [
        F.date_format(day, "dMMyyyy"),
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "MM/dd/yyyy"),
        F.date_format(day, "M/d/yyyy"),
        F.date_format(day, "dd-MMM-yyyy"),
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"),
        F.concat(F.lit("  "), F.date_format(day, "ddMMyyyy"), F.lit(" ")),
        F.date_format(day, "yyyy-M-d"),
        F.date_format(day, "yyyy/MM/dd HH:mm:ss"),
        F.date_format(day, "d-MMM-yyyy"),
        F.concat(F.date_format(day, "M/d/yyyy"), F.lit(" 0:00")),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T23:59:59.5+05:30")),
        F.concat(F.date_format(day, "M/d/yyyy"), F.lit(" 2:30 PM")),
        F.concat(F.date_format(day, "M/d/yyyy"), F.lit(" 13:30 AM")),
        F.concat(F.lit("3102"), F.date_format(day, "yyyy")),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 99:99")),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T25:00:00")),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:00:00+99:99")),
    ]
    out = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        out = F.when(F.col("o_orderkey") % len(shapes) == i, shape).otherwise(out)
    return out


def feed_header() -> Column:
    """A header line per customer, in six shapes."""
    shapes = [
        "type,rate_id,MANAGEMENT_UNIT_CODE,MANAGEMENT_UNIT_NAME,PRODUCT_TYPE_CODE,PRODUCT_TYPE_NAME",
        'TYPE,RATE_ID,product_type_code,"Product_Type_Name"',
        "FACTOR_ID,X, TALLY_DESTINATION_CODE ",
        "MANAGEMENT_UNIT_CODE,TYPE",
        "PRODUCT_TYPE_CODE,FACTOR_ID",
        "FACTOR_ID,TALLY_DESTINATION_CODE,PRODUCT_TYPE_CODE,PRODUCT_TYPE_NAME",
    ]
    out = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        out = F.when(F.col("c_custkey") % 6 == i, F.concat_ws(",", "c_mktsegment", F.lit(shape))).otherwise(out)
    return out
