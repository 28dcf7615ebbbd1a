"""Text renderings of the parquet test tables.

The jobs read text records; the test data is parquet. Each function here turns
a table into the line frame ``spark.read.text`` would give for such a file,
built with ``concat_ws`` so it stays one narrow projection over the scan
(Catalyst prunes the unused parquet columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.sources import lines_from_columns, read_table

LINEITEM_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)

# Deterministic "first k rows" order of lineitem (unique at every scale).
LINEITEM_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def lineitem_tab_lines(spark: SparkSession, sf_dir: str, position: bool = False) -> DataFrame:
    """All lineitem columns, tab-separated, in schema order (fields 0..10)."""
    return lines_from_columns(read_table(spark, sf_dir, "lineitem", position), LINEITEM_COLUMNS, "\t")


def lineitem_flag_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma records: 0 orderkey, 1 partkey, 2 suppkey, 3 quantity,
    4 returnflag, 5 linestatus, 6 ship year, 7 linenumber, 8 flag.

    The flag is true for discounts of at least 0.05 and false otherwise, in
    mixed case; records with no tax end with a trailing comma.
    """
    li = read_table(spark, sf_dir, "lineitem")
    flag = (
        F.when(F.col("l_discount") >= 0.05, F.lit("true"))
        .when(F.col("l_tax") >= 0.04, F.lit("FALSE"))
        .otherwise(F.lit("False"))
    )
    line = F.concat_ws(
        ",",
        *[
            F.col(c).cast("string")
            for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
        ],
        F.year("l_shipdate").cast("string"),
        F.col("l_linenumber").cast("string"),
        flag,
    )
    line = F.when(F.col("l_tax") == 0, F.concat(line, F.lit(","))).otherwise(line)
    return li.select(line.alias("value"))


def lineitem_station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """93-character fixed-width records: [0,15) orderkey, [15,19) ship year,
    [19,87) blanks, 87 sign ('-' for returned items), [88,92) reading,
    92 quality (the line number). The reading is the price in hundreds, or
    the missing sentinel 9999 for quantity 50."""
    li = read_table(spark, sf_dir, "lineitem")
    magnitude = F.when(F.col("l_quantity") == 50, F.lit(9999)).otherwise(
        F.floor(F.col("l_extendedprice") / 100).cast("int")
    )
    sign = F.when(F.col("l_returnflag") == "R", F.lit("-")).otherwise(F.lit("+"))
    line = F.concat(
        F.lpad(F.col("l_orderkey").cast("string"), 15, "0"),
        F.year("l_shipdate").cast("string"),
        F.lit(" " * 68),
        sign,
        F.lpad(magnitude.cast("string"), 4, "0"),
        F.col("l_linenumber").cast("string"),
    )
    return li.select(line.alias("value"))


def orders_song_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma records: 0 orderkey, 1 priority, 2 custkey, 3 totalprice, 4 year.
    Pending orders write the year as ``1998.0`` (not an integer)."""
    o = read_table(spark, sf_dir, "orders")
    year = F.year("o_orderdate").cast("string")
    year = F.when(F.col("o_orderstatus") == "P", F.concat(year, F.lit(".0"))).otherwise(year)
    return o.select(
        F.concat_ws(
            ",",
            F.col("o_orderkey").cast("string"),
            F.col("o_orderpriority"),
            F.col("o_custkey").cast("string"),
            F.col("o_totalprice").cast("string"),
            year,
        ).alias("value")
    )


def customer_balance_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma records: 0 custkey, 1 name, 2 ``segment#nation`` key, 3 balance - 9500."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.concat_ws(
            ",",
            F.col("c_custkey").cast("string"),
            F.col("c_name"),
            F.concat(F.col("c_mktsegment"), F.lit("#"), F.col("c_nationkey").cast("string")),
            (F.col("c_acctbal") - F.lit(9500.0)).cast("string"),
        ).alias("value")
    )


def part_price_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma records: 0 partkey, 1 brand, 2 name, 3 retail price - 975."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.concat_ws(
            ",",
            F.col("p_partkey").cast("string"),
            F.col("p_brand"),
            F.col("p_name"),
            (F.col("p_retailprice") - F.lit(975.0)).cast("string"),
        ).alias("value")
    )


def customer_unigram_lines(spark: SparkSession, sf_dir: str, short: bool = False) -> DataFrame:
    """Unigram records ``word year count volumes`` (single blanks): the market
    segment, 1990 + nation (zero-padded to five digits for BUILDING), the
    customer key, the floored balance. With ``short``, every customer adds a record
    of one word that no substring of the query matches."""
    c = read_table(spark, sf_dir, "customer")
    year = (F.lit(1990) + F.col("c_nationkey")).cast("string")
    year = F.when(F.col("c_mktsegment") == "BUILDING", F.lpad(year, 5, "0")).otherwise(year)
    line = F.concat_ws(" ", F.col("c_mktsegment"), year, F.col("c_custkey").cast("string"), F.floor(F.col("c_acctbal")).cast("bigint").cast("string"))
    if short:
        return c.select(F.explode(F.array(line, F.lit("xyz"))).alias("value"))
    return c.select(line.alias("value"))


def part_bigram_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram records ``word word year count volumes`` (runs of blanks): the two
    name words, 1950 + size, the part key, the floored price; PROMO parts write
    the price with decimals (not an integer)."""
    p = read_table(spark, sf_dir, "part")
    volumes = F.when(F.col("p_type") == "PROMO", F.col("p_retailprice").cast("string")).otherwise(
        F.floor(F.col("p_retailprice")).cast("bigint").cast("string")
    )
    return p.select(
        F.concat_ws(
            "   ",
            F.col("p_name"),
            (F.lit(1950) + F.col("p_size")).cast("string"),
            F.col("p_partkey").cast("string"),
            volumes,
        ).alias("value")
    )


def lineitem_whitespace_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank-separated numeric records: orderkey, linenumber, quantity, discount, tax."""
    li = read_table(spark, sf_dir, "lineitem")
    return lines_from_columns(li, ("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"), "  ")


def part_padded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part records padded with blanks: leading and trailing blanks, three
    blanks between fields (the name holds one more)."""
    p = read_table(spark, sf_dir, "part")
    body = F.concat_ws(
        "   ",
        F.col("p_partkey").cast("string"),
        F.col("p_name"),
        F.col("p_brand"),
        F.col("p_type"),
        F.col("p_size").cast("string"),
    )
    return p.select(F.concat(F.lit("  "), body, F.lit(" ")).alias("value"))


PART_HEADER = "p_partkey\tp_name\tp_retailprice"


def headed_part_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two text files of tab records (partkey, name, price), as ``line_no, value``
    frames that begin with the same header line: ``small`` has a tenth of the parts,
    ``large`` the others and one data row that equals the header."""
    p = read_table(spark, sf_dir, "part")
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_retailprice").cast("string"))
    numbered = p.select(F.col("p_partkey").alias("line_no"), line.alias("value"))
    header = spark.range(1).select(F.lit(-1).cast("long").alias("line_no"), F.lit(PART_HEADER).alias("value"))
    small = F.col("line_no") % 10 == 0
    again = header.withColumn("line_no", F.lit(0).cast("long"))
    return {
        "small": header.unionByName(numbered.where(small)),
        "large": header.unionByName(again).unionByName(numbered.where(~small)),
    }


def first_rows(df: DataFrame, order_cols, k: int) -> list:
    """The first k rows in a unique order (k is a parameter: bounded)."""
    return df.orderBy(*order_cols).limit(k).collect()
