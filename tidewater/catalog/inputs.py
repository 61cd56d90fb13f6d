"""Driver tables shaped into the inputs the jobs expect.

Each function reads whole driver tables and renames / derives columns so a
job sees the data it was written for (sensor readings, orders documents,
engine readings, messages).  Everything here is a Spark expression over
the given tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.plans.delivery import DELIVERED
from tidewater.operators.nested import pack_rows, xml_escape
from tidewater.operators.partitioning import spread


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    """A driver table.  ``spread_rows`` (for inputs that feed heavy per-row
    text work) spreads a scan with fewer splits than task slots so that
    work uses every core; it is a no-op on large inputs."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_rows else df


def money(col: str) -> Column:
    return F.col(col).cast("decimal(18,2)")


# ------------------------------ orders ------------------------------------


def delivery_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as typed delivery orders (marts M9)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        money("o_totalprice").alias("order_amount"),
        F.col("o_orderdate").alias("order_time"),
    )


def supplier_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as restaurant orders: supplier = restaurant, return flag
    'N' = delivered (mart M10)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("restaurant_id"),
        F.col("l_orderkey").alias("order_id"),
        money("l_extendedprice").alias("order_amount"),
        F.when(F.col("l_returnflag") == "N", F.lit(DELIVERED)).otherwise(F.col("l_returnflag")).alias("status"),
    )


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a raw collection with dirt injected by expression: missing
    and placeholder customer ids, bad, tiny, huge and three-decimal amounts,
    missing status, a list
    column, and every document present twice (``_v`` 0 and 1)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    doc = o.select(
        k.cast("string").alias("order_id"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .when(k % 11 == 0, F.lit("Unknown"))
        .when(k % 13 == 0, F.lit(" unknown "))
        .when(k % 31 == 0, F.lit("NULL"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        (F.col("o_custkey") % 100 + 1).cast("string").alias("restaurant_id"),
        F.when(k % 17 == 0, F.lit("abc"))
        .when(k % 19 == 0, F.lit("-1"))
        .when(k % 23 == 0, F.lit("NaN"))
        .when(k % 37 == 0, F.lit("0"))
        .when(k % 41 == 0, F.lit("0.004"))
        .when(k % 43 == 0, F.lit("99999999999999999.5"))
        .when(k % 47 == 0, F.lit("12.345"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("order_amount"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("o_orderdate").alias("order_time"),
        F.array(F.col("o_orderpriority")).alias("tags"),
    )
    return doc.withColumn("_v", F.lit(0)).unionByName(doc.withColumn("_v", F.lit(1)))


def keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, and for every order of the lowest priority an equal row
    without a key."""
    o = table(spark, sf_dir, "orders")
    blank = {"o_orderkey": None, "o_custkey": None, "o_orderstatus": "N", "o_totalprice": 0.0, "o_orderdate": "1999-01-01", "o_orderpriority": "none"}
    types = dict(o.dtypes)
    keyless = o.where(F.col("o_orderpriority") == "5-LOW").select(*[F.lit(v).cast(types[c]).alias(c) for c, v in blank.items()])
    return o.unionByName(keyless)


def text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents whose dates arrived as text (some unreadable)
    and whose id is an extended-JSON object id."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.struct(F.lpad(F.hex(k), 24, "0").alias("$oid")).alias("_id"),
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").cast("string").alias("order_amount"),
        F.col("o_orderstatus").alias("status"),
        F.when(k % 29 == 0, F.lit("not a date"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("order_time"),
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd").alias("created_at"),
    )


# ------------------------------ engines -----------------------------------


def engine_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as engine readings."""
    li = table(spark, sf_dir, "lineitem")
    q, p, d, t = (F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    return li.select(
        F.col("l_returnflag").alias("EngineType"),
        F.col("l_linestatus").alias("Generalized_Weight"),
        (p / q).alias("Engine_RPM_RPM"),
        (q * 3).alias("Vehicle_Speed_km_per_h"),
        (p / 1000).alias("MAF_g_per_sec"),
        F.ln(p / 1000).alias("log_MAF"),
        (d * 1000).alias("Absolute_Load_pct"),
        (t * 500 - 10).alias("OAT_DegC"),
        ((t - 0.04) * 400).alias("Short_Term_Fuel_Trim_Bank_1_pct"),
        ((d - 0.05) * 200).alias("Long_Term_Fuel_Trim_Bank_1_pct"),
        ((t - 0.04) * -300).alias("Short_Term_Fuel_Trim_Bank_2_pct"),
        ((d - 0.05) * -100).alias("Long_Term_Fuel_Trim_Bank_2_pct"),
    )


# ------------------------------ documents ---------------------------------


def pet_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations packed into JSON documents: ``{"pets": [...]}`` with
    one element per turn (name = role, favFoods = the lines of the text,
    birthYear = turn, photo = the whole text; species absent)."""
    conv = table(spark, sf_dir, "conversations")
    pets = conv.select(
        "conv_id",
        "turn",
        F.col("role").alias("name"),
        F.split(F.col("text"), "\n").alias("favFoods"),
        F.col("turn").alias("birthYear"),
        F.col("text").alias("photo"),
    )
    packed = pack_rows(pets, ["conv_id"], "turn", ["name", "favFoods", "birthYear", "photo"], "pets")
    return packed.select("conv_id", F.to_json(F.struct("pets")).alias("json_data"))


def food_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts packed into XML documents ``<nutrition><food>..</food>..``, 64
    foods per document.  Each food repeats <name> (the first with a text
    wins, spelt in five ways), has escaped markup in <mfr>, and leaves out fiber, vitamin C and iron (NULL) and the fat attribute on odd
    sizes (NULL, not 0)."""
    part = table(spark, sf_dir, "part", spread_rows=True)
    size = F.col("p_size")
    price = F.col("p_retailprice")

    def el(tag: str, value: Column) -> Column:
        return F.concat(F.lit(f"<{tag}>"), xml_escape(value), F.lit(f"</{tag}>"))

    def spelt(tag: str, value: Column) -> Column:
        """A text in the ways XML may spell it: plain, escaped, CDATA, and
        followed by a child element or a comment that is not part of it."""
        escaped = xml_escape(value)
        ways = [
            F.concat(F.lit("&lt;"), escaped, F.lit("&gt; 2")),
            F.concat(F.lit("<![CDATA[a <tag> "), value, F.lit("]]>")),
            F.concat(escaped, F.lit("<i>x</i>tail")),
            F.concat(escaped, F.lit("<!-- c -->tail")),
        ]
        text = escaped
        for i, way in enumerate(ways, 1):
            text = F.when(size % 5 == i, way).otherwise(text)
        return F.concat(F.lit(f"<{tag}>"), text, F.lit(f"</{tag}>"))

    fat_attr = F.when(size % 2 == 0, F.concat(F.lit(' fat="'), size.cast("string"), F.lit('"'))).otherwise(F.lit(""))
    food = F.concat(
        F.lit("<food>"),
        F.lit("<name/>"),
        spelt("name", F.col("p_name")),
        el("name", F.col("p_brand")),
        el("mfr", F.concat(F.col("p_brand"), F.lit(" <b>& co</b> "))),
        F.concat(F.lit('<serving units="'), xml_escape(F.col("p_type")), F.lit('">'), size.cast("string"), F.lit("</serving>")),
        F.concat(F.lit('<calories total="'), (size * 10).cast("string"), F.lit('"'), fat_attr, F.lit("/>")),
        el("total-fat", price.cast("string")),
        el("saturated-fat", (price / 4).cast("string")),
        el("cholesterol", size.cast("string")),
        el("sodium", (size * 5).cast("string")),
        el("carb", (price / 10).cast("string")),
        el("protein", (size / 2).cast("string")),
        F.concat(F.lit("<vitamins>"), el("a", size.cast("string")), F.lit("</vitamins>")),
        F.concat(F.lit("<minerals>"), el("ca", (size + 1).cast("string")), F.lit("</minerals>")),
        F.lit("</food>"),
    )
    foods = part.select(F.col("p_partkey"), food.alias("xml"))
    packed = pack_rows(foods, [], "p_partkey", ["xml"], "foods", chunk=64)
    doc = F.concat(F.lit("<nutrition>"), F.array_join(F.transform("foods", lambda x: x["xml"]), ""), F.lit("</nutrition>"))
    return packed.select(doc.alias("xml_content"))


def action_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations packed as customer documents: customer = conversation,
    one action per turn (action = role, timestamp text = 2024-01-01 plus
    ``turn`` minutes); the third action of a list is there twice."""
    conv = table(spark, sf_dir, "conversations")
    acts = conv.select(
        "conv_id",
        "turn",
        F.col("role").alias("action"),
        F.date_format(F.expr("timestampadd(MINUTE, turn, TIMESTAMP_NTZ'2024-01-01 00:00:00')"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )
    packed = pack_rows(acts, ["conv_id"], "turn", ["action", "timestamp"], "actions")
    again = F.filter(F.slice("actions", 3, 1), lambda a: F.size("actions") >= 3)
    return packed.select(F.col("conv_id").alias("customer_id"), F.concat("actions", again).alias("actions"))


# ------------------------------ messages ----------------------------------

# Event fields carried in an event message, as (output column, JSON path).
EVENT_PATHS = (
    ("event_id", "$.event_id"),
    ("user_id", "$.user_id"),
    ("event_type", "$.event_type"),
    ("amount", "$.value"),
    ("k", "$.props.k"),
)


def event_message(df: DataFrame) -> Column:
    """An event row as a JSON message (props parsed into an object)."""
    return F.to_json(
        F.struct(
            "event_id",
            "user_id",
            "event_type",
            "value",
            F.from_json("props", "k BIGINT").alias("props"),
        )
    )


def loan_layout() -> dict:
    """Order + customer + nation columns shaped as a loan application.

    Money and ratios are JSON numbers; a text flatten (``get_json_object``)
    returns them as Spark prints a double (``9295.3`` for ``9295.30``)."""
    return {
        "application_id": F.col("o_orderkey").cast("string"),
        "customer": {
            "customer_id": F.col("c_custkey").cast("string"),
            "region": F.col("n_name"),
            "age": F.col("c_nationkey"),
            "income": money("c_acctbal"),
            "employment": F.col("c_mktsegment"),
        },
        "loan": {
            "amount": money("o_totalprice"),
            "term_months": F.datediff(F.lit("1999-01-01").cast("date"), F.col("o_orderdate")),
            "purpose": F.col("o_orderpriority"),
            "currency": F.upper(F.substring("n_name", 1, 3)),
        },
        "scoring": {
            "score": F.col("o_orderkey") % 97,
            "risk_level": F.substring("o_orderpriority", 1, 1),
            "pd": (F.abs(F.col("c_acctbal")) / 100000 + 0.001).cast("decimal(10,4)"),
            "lgd": (F.col("o_totalprice") / 1000000 + 0.001).cast("decimal(10,4)"),
        },
        "documents": F.array(
            F.struct(F.lit("status").alias("type"), F.col("o_orderstatus").alias("status")),
            F.struct(F.lit("priority").alias("type"), F.col("o_orderpriority").alias("status")),
        ),
        "decision_status": F.col("o_orderstatus"),
        "submitted_at": F.date_format("o_orderdate", "dd.MM.yyyy"),
        "notes": F.col("c_name"),
    }


# --------------------------- delivery documents ----------------------------

# Order status texts of the delivery documents (own choice).
IN_TRANSIT = "Передан курьеру"
CANCELLED = "Снят"


def _oid(key: str) -> Column:
    return F.struct(F.lpad(F.hex(F.col(key)), 24, "0").alias("$oid"))


def _minutes_after(base: str, minutes: Column) -> Column:
    """A time of day and year for any long (an interval's minutes are an
    int; from 2**31 on they start again)."""
    start = F.lit(base).cast("timestamp_ntz")
    return F.date_format(start + F.make_dt_interval(mins=(minutes % (1 << 31)).cast("int")), "yyyy-MM-dd HH:mm:ss")


def restaurant_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as restaurant documents (ratings as text, some cuisines
    missing)."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        _oid("s_suppkey").alias("_id"),
        k.cast("string").alias("restaurant_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("city"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("cuisine_"), (k % 7).cast("string"))).alias("cuisine"),
        # Rounded first: of itself the format cuts 3.215, a little less in binary, to 3.21.
        F.format_number(F.round(F.col("s_acctbal") / 2000 + 2.5, 2), 2).alias("rating"),
        _minutes_after("2024-01-01 00:00:00", k).alias("created_at"),
    )


def customer_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as documents with two actions each (the second has no
    action name for every fourth customer)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    registered = _minutes_after("2023-06-01 00:00:00", k % 100000)
    second = F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.lower(F.col("c_mktsegment")))
    return c.select(
        _oid("c_custkey").alias("_id"),
        k.cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("street "), k.cast("string")).alias("address"),
        F.col("c_nationkey").cast("string").alias("city"),
        registered.alias("registered_at"),
        F.array(
            F.struct(F.lit("registered").alias("action"), registered.alias("timestamp")),
            F.struct(second.alias("action"), _minutes_after("2024-01-01 00:00:00", k % 100000).alias("timestamp")),
        ).alias("actions"),
    )


def driver_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as delivery drivers."""
    p = table(spark, sf_dir, "part")
    return p.select(
        _oid("p_partkey").alias("_id"),
        F.col("p_partkey").cast("string").alias("driver_id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 6 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("vehicle_type"),
        (F.col("p_retailprice") / 400).cast("string").alias("rating"),
        (F.col("p_size") > 25).alias("active"),
    )


def order_status(status: Column) -> Column:
    return (
        F.when(status == "F", F.lit(DELIVERED))
        .when(status == "O", F.lit(IN_TRANSIT))
        .when(status == "P", F.lit(CANCELLED))
    )


def order_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as delivery order documents, with the same dirt as
    :func:`dirty_orders` and an ``items`` list."""
    o = table(spark, sf_dir, "orders", spread_rows=True)
    k = F.col("o_orderkey")
    return o.select(
        _oid("o_orderkey").alias("_id"),
        k.cast("string").alias("order_id"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .when(k % 11 == 0, F.lit("Unknown"))
        .when(k % 13 == 0, F.lit(" unknown "))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        (F.col("o_custkey") % 100 + 1).cast("string").alias("restaurant_id"),
        (k % 2000 + 1).cast("string").alias("driver_id"),
        F.array(F.struct(F.col("o_orderpriority").alias("name"), money("o_totalprice").alias("price"), F.lit(1).alias("qty"))).alias("items"),
        F.when(k % 17 == 0, F.lit("abc"))
        .when(k % 19 == 0, F.lit("-1"))
        .when(k % 41 == 0, F.lit("0.004"))
        .when(k % 43 == 0, F.lit("99999999999999999.5"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("order_amount"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(order_status(F.col("o_orderstatus"))).alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_time"),
    )


def review_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as order reviews (rating text, some comments missing)."""
    li = table(spark, sf_dir, "lineitem", spread_rows=True)
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("review_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        (F.col("l_quantity").cast("int") % 5 + 1).cast("string").alias("rating"),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("string")).otherwise(F.col("l_returnflag")).alias("comment"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )
