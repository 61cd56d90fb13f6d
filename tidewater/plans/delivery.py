"""Food-delivery documents to tables and marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from tidewater.functions.exprs import NUMBER_PRECISION, NUMBER_SCALE, key_default, surrogate_id, try_timestamp, year_of
from tidewater.operators.analytics import count_where, money_mean, union_all
from tidewater.operators.cleaning import clean_collection, drop_array_columns, drop_if_present, type_by_name
from tidewater.operators.ids import dense_ids
from tidewater.operators.nested import explode_structs
from tidewater.operators.quality import fk_orphan_counts, key_violations
from tidewater.sinks.tables import create_tables, replace_table, replicate, skip_if_empty
from tidewater.sources.files import preview, read_collection, rejected_documents

# The status that counts as a delivered order.
DELIVERED = "Доставлен"

# Target table layouts.
TARGET_TABLES = {
    "orders": "order_id STRING, customer_id STRING, restaurant_id STRING, driver_id STRING, "
    "order_amount DECIMAL(38,18), status STRING, order_time TIMESTAMP_NTZ, order_year STRING",
    "restaurants": "restaurant_id STRING, name STRING, city STRING, cuisine STRING, "
    "rating DECIMAL(38,18), created_at TIMESTAMP_NTZ",
    "customers": "customer_id STRING, name STRING, email STRING, address STRING, city STRING, "
    "registered_at TIMESTAMP_NTZ",
    "delivery_drivers": "driver_id STRING, name STRING, vehicle_type STRING, rating DECIMAL(38,18), active BOOLEAN",
    "orderreviews": "review_id STRING, order_id STRING, rating INT, comment STRING, created_at TIMESTAMP_NTZ",
    "customer_actions": "action_id BIGINT, customer_id STRING, action_type STRING, action_timestamp TIMESTAMP_NTZ",
}


# Partition column of a target, and the timestamp whose year it holds
# ("default" without one), so a filter on the year prunes the table.
TARGET_PARTITIONS = {"orders": ("order_year", "order_time")}

# Keys of the targets, and the columns that point at another target's key.
TARGET_KEYS = {
    "orders": "order_id", "restaurants": "restaurant_id", "customers": "customer_id",
    "delivery_drivers": "driver_id", "orderreviews": "review_id", "customer_actions": "action_id",
}
TARGET_REFERENCES = (
    ("orders", "customer_id", "customers"), ("orders", "restaurant_id", "restaurants"), ("orders", "driver_id", "delivery_drivers"),
    ("orderreviews", "order_id", "orders"), ("customer_actions", "customer_id", "customers"),
)

# The source collections, their target tables and keys.
COLLECTIONS = (
    ("Restaurants", "restaurants", "restaurant_id"),
    ("Customers", "customers", "customer_id"),
    ("DeliveryDrivers", "delivery_drivers", "driver_id"),
    ("Orders", "orders", "order_id"),
    ("OrderReviews", "orderreviews", "review_id"),
)

# Document layouts as read from JSON lines (extended-JSON ids;
# numbers and times may arrive as text and are typed by the load).
_OID = "_id STRUCT<`$oid`: STRING>"
COLLECTION_SCHEMAS = {
    "Restaurants": f"{_OID}, restaurant_id STRING, name STRING, city STRING, cuisine STRING, rating STRING, created_at STRING",
    "Customers": f"{_OID}, customer_id STRING, name STRING, email STRING, address STRING, city STRING, "
    "registered_at STRING, actions ARRAY<STRUCT<action: STRING, timestamp: STRING>>",
    "DeliveryDrivers": f"{_OID}, driver_id STRING, name STRING, vehicle_type STRING, rating STRING, active BOOLEAN",
    "Orders": f"{_OID}, order_id STRING, customer_id STRING, restaurant_id STRING, driver_id STRING, "
    "items ARRAY<STRUCT<name: STRING, price: STRING, qty: BIGINT>>, order_amount STRING, status STRING, order_time STRING",
    "OrderReviews": f"{_OID}, review_id STRING, order_id STRING, rating STRING, comment STRING, created_at STRING",
}

# Per-collection types that the name rule does not give.
COLLECTION_TYPES = {"OrderReviews": {"rating": "int"}}


def ids_to_text(df: DataFrame) -> DataFrame:
    """object ids to their 24-hex text.  In extended JSON an id is a
    struct with one ``$oid`` field; such columns become that string."""
    out = []
    for f in df.schema.fields:
        dt = f.dataType
        if isinstance(dt, StructType) and [x.name for x in dt.fields] == ["$oid"]:
            out.append(F.col(f.name)["$oid"].alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def prepare_collection(
    df: DataFrame,
    key: str | None = None,
    order_by: Sequence[Column | str] | None = None,
    types: Mapping[str, str] | None = None,
    numbers: tuple[int, int] = (NUMBER_PRECISION, NUMBER_SCALE),
) -> DataFrame:
    """M7 without the write: ids to text, ``_id`` dropped, cleaned (M6),
    typed by schema or by column name; ``numbers`` is the precision and scale
    of numbers that come as text."""
    df = drop_if_present(ids_to_text(df), ["_id"])
    df = clean_collection(df, key, order_by, numbers)
    return type_by_name(df, types, numbers)


def customer_actions(customers: DataFrame, key: str = "customer_id", ids: str = "hash") -> DataFrame:
    """M8: one row per action of each customer.  A missing action name
    gives "unknown"; customers with empty or NULL action lists give no rows.

    ``action_id`` with ``ids="hash"`` is a stable id from the row's content
    and its position in the list, so equal actions of a customer differ; with
    ``ids="dense"`` it counts the actions by customer and position, from 1 on
    and without gaps, as a sequence does (one more pass; never collides)."""
    numbered = customers.select(key, F.transform("actions", lambda a, i: F.struct(a.alias("a"), i.alias("at"))).alias("actions"))
    item = F.col("_item")["a"]
    rows = explode_structs(
        numbered,
        key,
        "actions",
        {
            "action_type": key_default(item["action"]),
            "action_timestamp": try_timestamp(item["timestamp"]),
            "_at": F.col("_item")["at"],
        },
    )
    if ids == "dense":
        rows = dense_ids(rows, "action_id", [key, "_at"])
    else:
        rows = rows.withColumn("action_id", surrogate_id(key, "_at", "action_type", "action_timestamp"))
    return rows.select("action_id", key, "action_type", "action_timestamp")


def _decimals(kind: DecimalType) -> int:
    """Decimals of a total: with ten more digits before the point than the
    column has, as Spark's sums have, what is left of 38; six at least."""
    return min(kind.scale, max(38 - (kind.precision - kind.scale) - 10, 6))


def _parts(col: str, whole_digits: int) -> tuple[Column, Column]:
    """Exact sums of the whole units and of the fractions of a decimal
    column; the sum of the column itself has no digit more than a value."""
    one = F.lit(1).cast("decimal(1,0)")
    return F.sum(F.floor(col)).cast(f"decimal({whole_digits},0)"), F.sum(F.pmod(F.col(col), one))


def _money_total(df: DataFrame, col: str) -> Column:
    """Exact sum with the scale of the column, or with as many decimals as
    leave room for the total; it is rounded once, in the end."""
    kind = df.schema[col].dataType
    if not isinstance(kind, DecimalType) or _decimals(kind) == kind.scale:
        return F.sum(col).cast(f"decimal(38,{getattr(kind, 'scale', 2)})")
    scale = _decimals(kind)
    whole, fraction = _parts(col, 37 - scale)
    return (whole + fraction.cast(f"decimal({scale + 11},{scale})")).cast(f"decimal(38,{scale})")


def _money_mean(df: DataFrame, col: str) -> Column:
    """Mean with six decimals, and as many digits before them as the column
    has; of a wide column by long division of the exact parts of its sum."""
    kind = df.schema[col].dataType
    if not isinstance(kind, DecimalType):
        return money_mean(col, "decimal(38,6)")
    digits = kind.precision - kind.scale
    if _decimals(kind) == kind.scale:
        return money_mean(col, f"decimal({min(38, digits + 6)},6)")
    n = F.count(col).cast("decimal(19,0)")
    whole, fraction = _parts(col, 37 - _decimals(kind))
    left = (whole % n).cast("decimal(19,0)")
    units = ((whole - left) / n).cast(f"decimal({digits},0)")
    return (units + ((left + fraction) / n).cast("decimal(7,6)")).cast(f"decimal({min(38, digits + 6)},6)")


def customer_activity(orders: DataFrame) -> DataFrame:
    """M9: per customer: orders, total spent, mean check, last order time
    (orders with a positive amount only)."""
    paid = orders.where(F.col("order_amount") > 0)
    return paid.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        _money_total(paid, "order_amount").alias("total_spent"),
        _money_mean(paid, "order_amount").alias("avg_check"),
        F.max("order_time").alias("last_order_timestamp"),
    )


def restaurant_performance(orders: DataFrame, delivered: str = DELIVERED) -> DataFrame:
    """Per restaurant: orders, revenue, delivered orders."""
    paid = orders.where(F.col("order_amount") > 0)
    return paid.groupBy("restaurant_id").agg(
        F.count("order_id").alias("total_orders"),
        _money_total(paid, "order_amount").alias("total_revenue"),
        count_where(F.col("status") == F.lit(delivered)).alias("successful_orders"),
    )


@dataclass
class Collection:
    """One source collection and where it goes."""

    df: DataFrame
    table: str
    key: str | None = None
    order_by: Sequence[Column | str] | None = None
    types: Mapping[str, str] | None = None
    columns: Sequence[str] | None = None
    numbers: tuple[int, int] = (NUMBER_PRECISION, NUMBER_SCALE)
    extra: dict = field(default_factory=dict)


def replicate_collection(c: Collection, path: str | None = None, keep: bool = False) -> DataFrame | None:
    """M7: prepare a collection and replace its table's rows (K12).  An
    empty source leaves the table as it was (K15) and returns None.

    With ``keep`` the prepared rows are persisted (memory, then disk) for a
    second output such as the customer actions, so the source is not read
    and deduplicated twice; the caller unpersists them."""
    if skip_if_empty(c.df):
        return None
    prepared = prepare_collection(c.df, c.key, c.order_by, c.types, c.numbers)
    if keep:
        prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    main = drop_array_columns(prepared)
    if c.columns:
        main = main.select(*c.columns)
    base = c.table.rsplit(".", 1)[-1]
    if base in TARGET_PARTITIONS:
        column, ts = TARGET_PARTITIONS[base]
        main = main.withColumn(column, F.coalesce(year_of(ts).cast("string"), F.lit("default")))
    try:
        c.extra["rows"] = replicate(main, c.table, path=path)
    except Exception:
        if keep:
            prepared.unpersist()
        raise
    return prepared


def load_all(
    spark: SparkSession,
    collections: Sequence[Collection],
    customers_table: str | None = "customers",
    actions_table: str = "customer_actions",
    orders_table: str = "orders",
    marts: tuple[str, str] = ("mart_customer_activity", "mart_restaurant_performance"),
    location: str | None = None,
    tables: Mapping[str, str] | None = None,
    parallel: int = 4,
) -> DataFrame:
    """Create the targets if absent, load every collection, explode
    customer actions, then rebuild both marts from the loaded orders.

    The collection loads do not depend on each other, so up to ``parallel``
    of them run as concurrent Spark jobs (a small collection's one-task job
    no longer leaves the cluster idle); customer actions follow their
    customers in the same thread, and both marts are built, concurrently,
    once every load is done.  The first failure is raised after the running
    loads finish.

    Returns one row per table: ``table_name``, ``row_count``.
    """
    tables = tables or TARGET_TABLES
    by = {name: TARGET_PARTITIONS[name.rsplit(".", 1)[-1]][0] for name in tables if name.rsplit(".", 1)[-1] in TARGET_PARTITIONS}
    create_tables(spark, tables, location=location, replace=False, partitions=by)

    def where(name: str) -> str | None:
        return f"{location}/{name}" if location else None

    # Rows are counted while they are written; a table that was not written
    # is counted in the end.
    written: dict[str, int] = {}

    def load_one(c: Collection) -> list[str]:
        with_actions = c.table == customers_table and "actions" in c.df.columns
        prepared = replicate_collection(c, where(c.table), keep=with_actions)
        done = [c.table]
        if prepared is not None:
            written[c.table] = c.extra["rows"]
        if with_actions and prepared is not None:
            try:
                # No actions leave the table as it was.
                if not skip_if_empty(customer_actions(prepared)):
                    actions = customer_actions(prepared, ids="dense")
                    written[actions_table] = replicate(actions, actions_table, path=where(actions_table))
            finally:
                prepared.unpersist()
            done.append(actions_table)
        return done

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        loaded = list(pool.map(load_one, collections))
    names = [name for group in loaded for name in group]

    written.update(rebuild_marts(spark, orders_table, marts, location, parallel))
    names.extend(marts)
    counts = [(n, written[n] if n in written else spark.table(n).count()) for n in names]
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


def key_report(spark: SparkSession, prefix: str = "") -> DataFrame:
    """K18 over the loaded targets: ``check_name, bad_rows`` for every key
    and every reference between them."""
    checks = []
    for name, key in TARGET_KEYS.items():
        checks.append((f"{name}.{key} is a key", key_violations(spark.table(f"{prefix}{name}"), [key])))
    for child, col, parent in TARGET_REFERENCES:
        checks.append((f"{child}.{col} in {parent}", fk_orphan_counts(spark.table(f"{prefix}{child}"), spark.table(f"{prefix}{parent}"), col, TARGET_KEYS[parent])))
    bad = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("bad_rows")
    return union_all(*[df.agg(bad).select(F.lit(name).alias("check_name"), "bad_rows") for name, df in checks])


def rebuild_marts(spark: SparkSession, orders_table: str = "orders", marts: Sequence[str] = ("mart_customer_activity", "mart_restaurant_performance"), location: str | None = None, parallel: int = 2) -> dict[str, int]:
    """Both marts from the loaded orders, concurrently; the rows of
    each."""
    orders = spark.table(orders_table)
    builds = [(customer_activity(orders), marts[0]), (restaurant_performance(orders), marts[1])]
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(builds)))) as pool:
        rows = pool.map(lambda b: replicate(b[0], b[1], path=f"{location}/{b[1]}" if location else None), builds)
        return dict(zip(marts, rows, strict=True))


def preview_marts(spark: SparkSession, tables: Sequence[str], n: int = 10, order_by: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame | Exception]:
    """The first ``n`` rows of each mart (by key when ``order_by``
    names one); a table that fails is reported and the rest still run."""
    return preview(spark, tables, n=n, order_by=order_by)


def read_collections(spark: SparkSession, folder: str, schemas: Mapping[str, str] | None = None, database: str | None = None, bad: str = "fail") -> list[Collection]:
    """The five collections as JSON lines under ``folder/<Collection>``,
    read with their declared layouts, each paired with its target table.  A
    bad line raises, or is left out (``bad="reject"``)."""
    schemas = schemas or COLLECTION_SCHEMAS
    prefix = f"{database}." if database else ""
    out = []
    for name, table, key in COLLECTIONS:
        df = read_collection(spark, f"{folder.rstrip('/')}/{name}", schemas[name], bad=bad)
        out.append(Collection(df, f"{prefix}{table}", key=key, types=COLLECTION_TYPES.get(name)))
    return out


def rejected_lines(spark: SparkSession, folder: str, schemas: Mapping[str, str] | None = None) -> DataFrame:
    """The lines of all collections that cannot be read: ``collection``,
    ``file``, ``line``, ``reason``."""
    schemas = schemas or COLLECTION_SCHEMAS
    parts = [rejected_documents(spark, f"{folder.rstrip('/')}/{name}", schemas[name]).select(F.lit(name).alias("collection"), "*") for name, _, _ in COLLECTIONS]
    return union_all(*parts)


def run_replication(spark: SparkSession, folder: str, database: str | None = None, location: str | None = None, rejects: str | None = None) -> DataFrame:
    """M18 end to end: create the target tables if absent, replicate the five
    collections read from ``folder`` (customer actions exploded on the way),
    then rebuild both marts.  A bad line stops the load before any table is
    changed by its collection; with ``rejects`` the bad lines are that
    table's rows and the others are loaded.  Returns the row count per
    table."""
    prefix = f"{database}." if database else ""
    if rejects:
        replace_table(rejected_lines(spark, folder), f"{prefix}{rejects}")
    return load_all(
        spark,
        read_collections(spark, folder, database=database, bad="reject" if rejects else "fail"),
        customers_table=f"{prefix}customers",
        actions_table=f"{prefix}customer_actions",
        orders_table=f"{prefix}orders",
        marts=(f"{prefix}mart_customer_activity", f"{prefix}mart_restaurant_performance"),
        location=location,
        tables={f"{prefix}{k}": v for k, v in TARGET_TABLES.items()},
    )
