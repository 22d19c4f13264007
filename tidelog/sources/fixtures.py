"""Change logs derived from the relational test tables.

Every record is computed from its base row by fixed arithmetic (documented in
FIXTURES.md), so an independent SQL query over the base tables can say what the
engine must produce. The whole table is used, and all work is row-local.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelog.functions.times import timestamp_to_ms
from tidelog.operators.project import metric_rows
from tidelog.operators.parse import document_size
from tidelog.session import prepare
from tidelog.spec import CollectionSpec, Target

ORDERS_TOPIC = "poc.mydb.orders"
PRODUCTS_TOPIC = "poc.mydb.products"
CUSTOMERS_TOPIC = "poc.mydb.customers"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# The record texts are composed as SQL expressions: one expression string per
# column keeps the plan quick to build.


def _text(value: str) -> str:
    """A JSON string literal; the derived texts need no other escapes."""
    return f"concat('\"', {value}, '\"')"


def _quoted(json: str) -> str:
    """JSON text as a JSON string literal (the connector's stringified form)."""
    return _text(f"replace({json}, '\"', '\\\\\"')")


def _object(*entries: tuple[str, str]) -> str:
    parts = [f"concat('\"{name}\":', {value})" for name, value in entries]
    return f"concat('{{', concat_ws(',', {', '.join(parts)}), '}}')"


def _constant(value: str) -> str:
    return f"'{value}'"


def _versions(*of: tuple[int, str]) -> str:
    """The numbers whose condition holds, one row each. The texts are composed behind it: inside a generator, Spark
    evaluates every expression by interpretation."""
    return f"explode(filter(array({', '.join(f'IF({when}, {n}L, NULL)' for n, when in of)}), n -> n IS NOT NULL))"


def _by_version(number: str, values: dict[int, str]) -> str:
    return f"CASE {number} " + " ".join(f"WHEN {n} THEN {value}" for n, value in values.items()) + " END"


def _as_source(log: DataFrame) -> DataFrame:
    """End the code-generation stage that builds the texts, as a real source would.

    More partitions than there are is a no-op for ``coalesce``: nothing moves.
    """
    return log.coalesce(1 << 20)


def object_id(k: str) -> str:
    return f"lpad(lower(hex({k})), 24, '0')"


def _oid_json(oid: str) -> str:
    return _object(("$oid", _text(oid)))


def record_key(oid: str) -> str:
    return _object(("id", _quoted(_oid_json(oid))))


def envelope(op: str, ts: str, after: str) -> str:
    return _object(("op", _text(op)), ("ts_ms", f"cast({ts} AS STRING)"), ("after", after), ("source", "'{}'"))


def order_log(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Change log of ``orders``: inserts, updates, deletes, tombstones and nine kinds of odd records.

    ``partitions`` deals the orders out anew before the texts are built, for
    inputs of few files.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice")
    orders = (orders.repartition(partitions) if partitions else orders).selectExpr(
        "o_orderkey AS k",
        "unix_millis(cast(o_orderdate AS TIMESTAMP)) AS t0",
        f"{object_id('o_orderkey')} AS oid",
        "concat('cust-', o_custkey) AS customer",
        "concat('city-', o_orderkey % 50) AS city",
        "cast(o_totalprice AS STRING) AS total",
        "element_at(array('PAID', 'SHIPPED', 'CANCELLED'), cast((o_orderkey div 3) % 3 AS INT) + 1) AS paid",
    )

    def doc(status: str, total: str, *more: tuple[str, str], city=True, customer=True) -> str:
        entries = [("_id", _oid_json("oid"))]
        if customer:
            entries.append(("customer_id", _text("customer")))
        entries.append(("status", _text(status)))
        if city:
            entries.append(("city", _text("city")))
        return _object(*entries, ("total", total), *more)

    pending, shipped = _constant("PENDING"), _constant("SHIPPED")
    insert = envelope("IF(k % 5 = 0, 'r', 'c')", "t0", _quoted(doc(pending, "total")))
    decimal = _object(("$numberDecimal", _text("total")))
    odd_ts = "t0 + 300000"
    drifted = doc(shipped, "total", ("loyalty", "'7'"), ("source_app", _text(_constant("web"))))
    truncated = """'{"_id": tru'"""
    odd_values = {
        97: "'not-valid-json'",
        89: envelope("'u'", odd_ts, _quoted(doc(shipped, "total", customer=False))),
        83: envelope("'x'", odd_ts, _quoted(doc(shipped, "total"))),
        79: envelope("'x'", odd_ts, "'null'"),
        73: envelope("'u'", odd_ts, _quoted(truncated)),
        71: envelope("'u'", odd_ts, _quoted(doc(shipped, _text(_constant("abc"))))),
        67: envelope("'u'", odd_ts, _quoted(drifted)),
        61: """'{"op":"c"} trailing'""",
        59: "'[1]'",
    }
    odd = "CASE " + " ".join(f"WHEN k % {n} = 0 THEN {value}" for n, value in odd_values.items()) + " END"
    # Slot, condition, delay, value.
    slots = [
        (0, "true", 0, insert),
        (1, "k % 3 = 0", 60000, envelope("'u'", "t0 + 60000", _quoted(doc("paid", decimal)))),
        (2, "k % 7 = 0", 30000, envelope("'u'", "t0 + 30000", _quoted(doc(_constant("PAID"), "'null'", city=False)))),
        (3, "k % 10 = 0", 180000, envelope("'d'", "t0 + 180000", "'null'")),
        (4, "k % 10 = 0", 180000, "cast(NULL AS STRING)"),
        (5, "k % 20 = 0", 240000, envelope("'c'", "t0 + 240000", doc(pending, _text("total")))),
        (6, " OR ".join(f"k % {n} = 0" for n in odd_values), 300000, odd),
    ]
    # Re-delivery of slot 0 at its own offset.
    again = (0, "k % 53 = 0")
    records = orders.selectExpr("*", f"{_versions(*(slot[:2] for slot in slots), again)} AS slot")
    value = _by_version("slot", {n: text for n, _, _, text in slots})
    delay = _by_version("slot", {n: f"{ms}" for n, _, ms, _ in slots})
    return _as_source(
        records.selectExpr(
            f"cast({record_key('oid')} AS BINARY) AS key",
            f"cast({value} AS BINARY) AS value",
            f"'{ORDERS_TOPIC}' AS topic",
            "cast(k % 4 AS INT) AS partition",
            "k * 8 + slot AS offset",
            f"timestamp_millis(t0 + {delay} + (k * 7) % 200 - IF(k % 50 = 0, 220, 0)) AS timestamp",
            "CASE WHEN slot = 6 THEN array(named_struct("
            "'key', 'retry_count', 'value', cast(cast(k % 5 AS STRING) AS BINARY))) END AS headers",
        )
    )


_NO_HEADERS = "cast(NULL AS ARRAY<STRUCT<key: STRING, value: BINARY>>) AS headers"


def product_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert records of ``part``; every eleventh document lacks its price."""
    base = [("_id", _text("cast(p_partkey AS STRING)")), ("sku", _text("p_brand")), ("name", _text("p_name"))]
    priced = _object(*base, ("price", "cast(p_retailprice AS STRING)"))
    doc = f"IF(p_partkey % 11 = 0, {_object(*base)}, {priced})"
    # Midnight of 2024-01-01 UTC plus one second per key.
    ts = "1704067200000 + p_partkey * 1000"
    return table(spark, sf_dir, "part").selectExpr(
        f"cast({record_key(object_id('p_partkey'))} AS BINARY) AS key",
        f"cast({envelope(_constant('c'), ts, _quoted(doc))} AS BINARY) AS value",
        f"'{PRODUCTS_TOPIC}' AS topic",
        "0 AS partition",
        "p_partkey AS offset",
        f"timestamp_millis({ts}) AS timestamp",
        _NO_HEADERS,
    )


def item_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``items`` arrays, one document per (order, line number) of ``lineitem``.

    Each document appears with one item, is replaced on even line numbers by
    one with two items (plus a non-object entry when the order key is a
    multiple of 13), and line 1 of every tenth order is deleted. Rows sharing
    both numbers are reduced with aggregates of fixed size, never collected.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("bigint").alias("line"))
        .agg(
            F.min("l_partkey").alias("p1"),
            F.max("l_partkey").alias("p2"),
            F.min("l_quantity").alias("q1"),
            F.max("l_quantity").alias("q2"),
            F.min("l_extendedprice").alias("u1"),
            F.max("l_extendedprice").alias("u2"),
            timestamp_to_ms(F.min("l_shipdate").cast("timestamp")).alias("t0"),
        )
        .selectExpr("*", f"concat({object_id('k')}, '-', line) AS doc_id")
    )

    def item(n: int) -> str:
        return _object(
            ("sku", _text(f"concat('sku-', p{n})")),
            ("qty", f"cast(q{n} AS STRING)"),
            ("unit_price", f"cast(u{n} AS STRING)"),
        )

    def doc(items: str) -> str:
        return _object(
            ("_id", _text("doc_id")),
            ("customer_id", _text(_constant("c"))),
            ("status", _text(_constant("PENDING"))),
            ("items", f"concat('[', {items}, ']')"),
        )

    two = f"""concat_ws(',', IF(k % 13 = 0, '"gift"', NULL), {item(1)}, {item(2)})"""
    versions = [
        (0, "true", envelope("'c'", "t0", _quoted(doc(item(1))))),
        (1, "line % 2 = 0", envelope("'u'", "t0 + 60000", _quoted(doc(two)))),
        (2, "k % 10 = 0 AND line = 1", envelope("'d'", "t0 + 90000", "'null'")),
    ]
    records = lines.selectExpr("*", f"{_versions(*(version[:2] for version in versions))} AS n")
    return _as_source(
        records.selectExpr(
            f"cast({_object(('id', _quoted(_text('doc_id'))))} AS BINARY) AS key",
            f"cast({_by_version('n', {n: value for n, _, value in versions})} AS BINARY) AS value",
            f"'{ORDERS_TOPIC}' AS topic",
            "cast(k % 4 AS INT) AS partition",
            "(k * 8 + line) * 4 + n AS offset",
            "timestamp_millis(t0 + n * 60000) AS timestamp",
            _NO_HEADERS,
        )
    )


def event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows of ``events``: each event as one processed change."""
    n = F.col("event_id")
    mongo = timestamp_to_ms(F.col("ts").cast("timestamp"))
    processed = table(spark, sf_dir, "events").select(
        F.concat(F.lit("doc-"), n.cast("string")).alias("doc_id"),
        F.col("event_type").alias("collection"),
        F.element_at(F.array(*map(F.lit, "cudr")), (n % 4 + 1).cast("int")).alias("op"),
        document_size(F.col("props")).alias("doc_size_bytes"),
        mongo.alias("ts_ms"),
        (mongo + (n * 7) % 200 - F.when(n % 50 == 0, 220).otherwise(0)).alias("kafka_ts_ms"),
        F.col("ts").cast("timestamp").alias("recorded_at"),
        F.concat(F.lit("poc.mydb."), F.col("event_type")).alias("topic"),
        (n % 4).cast("int").alias("partition"),
        n.alias("offset"),
    )
    recv = F.col("kafka_ts_ms") + (F.col("offset") * 13) % 500
    stored = recv + (F.col("offset") * 3) % 100
    return metric_rows(processed, recv, stored, F.col("recorded_at"))


def offset_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed, low and high offsets: orders lag by 25 per partition number,
    products are caught up, customers have no commit at all."""
    orders = (
        order_log(spark, sf_dir, partitions=spark.sparkContext.defaultParallelism)
        .groupBy("topic", "partition")
        .agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))
        .withColumn("committed", F.col("high") - F.col("partition") * 25)
    )
    products = (
        product_log(spark, sf_dir)
        .groupBy("topic", "partition")
        .agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))
        .withColumn("committed", F.col("high"))
    )
    customers = (
        table(spark, sf_dir, "customer")
        .agg(F.min("c_custkey").alias("low"), (F.max("c_custkey") + 1).alias("high"))
        .select(
            F.lit(CUSTOMERS_TOPIC).alias("topic"),
            F.lit(0).alias("partition"),
            "low",
            "high",
            F.lit(None).cast("bigint").alias("committed"),
        )
    )
    return orders.unionByName(products).unionByName(customers)


def extreme_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order document per customer, most with a time or a quantity at the limits of its type.

    By key modulo 6: the largest and a 20-digit ``ts_ms``, the largest that a
    timestamp holds, the same before 1970, a fractional and a huge quantity.
    """
    times = {
        0: "'9223372036854775807'", 1: "'99999999999999999999'", 2: "'9223372036854775'", 3: "'-9223372036854775'",
    }
    ts = "CASE c_custkey % 6 " + " ".join(f"WHEN {n} THEN {text}" for n, text in times.items()) + " ELSE '1704067200000' END"
    quantity = "CASE c_custkey % 6 WHEN 4 THEN '2.5' WHEN 5 THEN '3000000000' ELSE '1' END"
    item = _object(("sku", _text(_constant("s"))), ("qty", quantity), ("unit_price", "'1.5'"))
    doc = _object(
        ("_id", _oid_json(object_id("c_custkey"))), ("customer_id", _text("concat('cust-', c_custkey)")),
        ("status", _text(_constant("PENDING"))), ("total", "'1.0'"), ("items", f"concat('[', {item}, ']')"),
    )
    return table(spark, sf_dir, "customer").selectExpr(
        f"cast({record_key(object_id('c_custkey'))} AS BINARY) AS key",
        f"cast({envelope(_constant('c'), ts, _quoted(doc))} AS BINARY) AS value",
        f"'{ORDERS_TOPIC}' AS topic",
        "cast(c_custkey % 4 AS INT) AS partition",
        "c_custkey AS offset",
        "timestamp_millis(1704067200000 + c_custkey) AS timestamp",
        _NO_HEADERS,
    )


#: Customers as a second collection, with names of its own for key and columns.
CUSTOMERS = CollectionSpec(
    name="customers",
    required=("name",),
    known=("_id", "name", "balance"),
    fields=(("name", "string"), ("balance", "double")),
    targets=(
        Target(
            database="crm",
            table="accounts",
            key="account_key",
            reads=("name", "balance"),
            columns=(("label", "concat(account_key, '/', name)"), ("balance", "balance")),
            inserted_at="opened_at",
            changed_at="changed_at",
        ),
    ),
)


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts of ``customer``; every third balance is set to zero later, and every tenth customer deleted."""

    def doc(balance: str) -> str:
        return _object(("_id", _oid_json("oid")), ("name", _text("c_name")), ("balance", balance))

    t0 = "1704067200000 + k * 1000"
    versions = [
        (0, "true", envelope("'c'", t0, _quoted(doc("cast(c_acctbal AS STRING)")))),
        (1, "k % 3 = 0", envelope("'u'", f"{t0} + 60000", _quoted(doc("'0'")))),
        (2, "k % 10 = 0", envelope("'d'", f"{t0} + 90000", "'null'")),
    ]
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_name", "c_acctbal", f"{object_id('c_custkey')} AS oid")
    records = rows.selectExpr("*", f"{_versions(*(version[:2] for version in versions))} AS n")
    return records.selectExpr(
        f"cast({record_key('oid')} AS BINARY) AS key",
        f"cast({_by_version('n', {n: value for n, _, value in versions})} AS BINARY) AS value",
        f"'{CUSTOMERS_TOPIC}' AS topic",
        "0 AS partition",
        "k * 4 + n AS offset",
        f"timestamp_millis({t0} + n * 60000) AS timestamp",
        _NO_HEADERS,
    )


def foreign_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine messages of another producer, one per customer, most of them odd.

    By key modulo 7: no JSON, no object, no source topic, an empty one, a
    retry count that is no number, one that is used up, and a good message
    without any.
    """
    topic = ("source_topic", _text(_constant(CUSTOMERS_TOPIC)))
    raw = ("raw_value", _text("concat('v', c_custkey)"))
    values = [
        "concat('oops ', c_custkey)", "'[1]'", _object(raw), _object(("source_topic", _text("''")), raw),
        _object(topic, ("retry_count", _text("'x'")), raw), _object(topic, ("retry_count", "'3'"), raw), _object(topic, raw),
    ]
    value = "CASE c_custkey % 7 " + " ".join(f"WHEN {n} THEN {v}" for n, v in enumerate(values)) + " END"
    return table(spark, sf_dir, "customer").selectExpr("cast(c_custkey % 3 AS INT) AS partition", "c_custkey AS offset", f"cast({value} AS BINARY) AS value")


def live_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents left in the source collection after the whole log, with their status."""
    k = F.col("o_orderkey")
    earlier_odd = F.lit(False)
    for n in (97, 89, 83, 79, 73, 71):
        earlier_odd = earlier_odd | (k % n == 0)
    shipped = (k % 67 == 0) & ~earlier_odd
    status = (
        F.when(shipped, "SHIPPED")
        .when(k % 20 == 0, "PENDING")
        .when(k % 7 == 0, "PAID")
        .when(
            k % 3 == 0,
            F.element_at(
                F.array(*map(F.lit, ("PAID", "SHIPPED", "CANCELLED"))), ((F.floor(k / 3) % 3) + 1).cast("int")
            ),
        )
        .otherwise("PENDING")
    )
    return (
        table(spark, sf_dir, "orders")
        .filter(shipped | (k % 20 == 0) | (k % 10 != 0))
        .select(F.expr(object_id("o_orderkey")).alias("order_id"), status.alias("status"))
    )
