"""Named queries over the given tables, each of which exercises some operators.

Every query reads its tables whole. Those that write use a database of their
own in the shared folder and return what they read back from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tableferry as tf
from tableferry.plans import fixtures
from tableferry.session import fresh_path, scratch_database
from tableferry.sources.workbooks import parse_workbooks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _register(spark: SparkSession, sf: str, *names: str) -> None:
    for name in names:
        _load(spark, sf, name).createOrReplaceTempView(name)


def _fresh_table(spark: SparkSession, name: str) -> str:
    return f"{scratch_database(spark)}.{name}"


def _saved(spark: SparkSession, sf: str, name: str) -> str:
    """A copy of a given table that a query may change."""
    table = _fresh_table(spark, name)
    tf.save_table(_load(spark, sf, name), table)
    return table


# -- reads --------------------------------------------------------------------


@_query
def read_table(spark, sf):
    _register(spark, sf, "customer")
    return tf.read_relation(spark, "customer")


@_query
def read_select(spark, sf):
    _register(spark, sf, "orders")
    return tf.read_relation(
        spark,
        "orders",
        "Select o_orderkey, o_custkey, o_totalprice FROM orders "
        "WHERE o_orderstatus = 'F' AND o_totalprice > 100000;",
    )


@_query
def read_where(spark, sf):
    _register(spark, sf, "customer")
    return tf.read_relation(
        spark, "customer", "where c_acctbal > 0 AND c_mktsegment = 'BUILDING'"
    )


@_query
def read_where_tail(spark, sf):
    _register(spark, sf, "orders")
    tail = "WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 25"
    return tf.read_relation(spark, "orders", tail)


@_query
def read_cte(spark, sf):
    _register(spark, sf, "orders")
    return tf.read_relation(
        spark,
        "orders",
        "WITH n AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus) "
        "SELECT * FROM n",
    )


@_query
def read_where_subselect(spark, sf):
    _register(spark, sf, "customer", "nation")
    return tf.read_relation(
        spark,
        "customer",
        "WHERE c_nationkey IN (select n_nationkey FROM nation WHERE n_regionkey = 1)",
    )


@_query
def filter_frame(spark, sf):
    return tf.filter_frame(_load(spark, sf, "lineitem"), "WHERE l_quantity >= 45 AND l_discount = 0")


@_query
def materialize(spark, sf):
    return tf.materialize(_load(spark, sf, "events"))


@_query
def sql_join_agg(spark, sf):
    _register(spark, sf, "orders", "customer", "nation")
    return tf.run_query(
        spark,
        """
        SELECT n.n_name, count(*) AS order_count,
               CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        GROUP BY n.n_name
        """,
    )


@_query
def sql_window_topk(spark, sf):
    _register(spark, sf, "orders")
    return tf.run_query(
        spark,
        """
        SELECT o_custkey, o_orderkey, rn FROM (
          SELECT o_custkey, o_orderkey,
                 row_number() OVER (PARTITION BY o_custkey
                                    ORDER BY o_totalprice DESC, o_orderkey) AS rn
          FROM orders) t
        WHERE rn <= 3
        """,
    )


@_query
def sql_set_ops(spark, sf):
    _register(spark, sf, "customer", "orders")
    return tf.run_query(
        spark,
        "SELECT c_custkey AS k FROM customer "
        "EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'",
    )


@_query
def sql_params(spark, sf):
    _register(spark, sf, "orders")
    sql = "SELECT * FROM orders WHERE o_orderpriority = :priority AND o_totalprice >= :least"
    return tf.run_query(spark, sql, {"priority": "1-URGENT", "least": 250000.0})


@_query
def list_tables(spark, sf):
    _register(spark, sf, "customer", "orders", "lineitem")
    listed = {r["table_name"] for r in tf.list_tables(spark).collect()}
    wanted = [t for t in ("customer", "lineitem", "no_such_table", "orders") if t in listed]
    counts = [
        tf.read_relation(spark, t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n"))
        for t in wanted
    ]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


@_query
def list_columns(spark, sf):
    _register(spark, sf, "lineitem")
    columns = tf.list_columns(spark, "lineitem").collect()
    held = [F.struct(F.lit(c["position"]).alias("position"),
                     F.lit(c["column_name"]).alias("column_name"),
                     F.count(c["column_name"]).alias("n")) for c in columns]
    return tf.read_relation(spark, "lineitem").agg(F.inline(F.array(*held)))


# -- save modes ---------------------------------------------------------------


@_query
def write_append_name(spark, sf):
    table = _saved(spark, sf, "customer")
    owing = _load(spark, sf, "customer").where("c_acctbal < 0")
    tf.save_table(owing.select(*reversed(owing.columns)), table)
    return spark.table(table)


@_query
def write_append_position(spark, sf):
    table = _fresh_table(spark, "party")
    tf.save_table(_load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), table)
    suppliers = _load(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    tf.save_table(suppliers, table, match="position")
    return spark.table(table)


@_query
def write_replace(spark, sf):
    table = _saved(spark, sf, "orders")
    doubled = spark.table(table).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    tf.save_table(doubled, table, mode="replace")
    return spark.table(table)


@_query
def write_fail_existing(spark, sf):
    table = _saved(spark, sf, "supplier")
    try:
        tf.save_table(_load(spark, sf, "part"), table, mode="fail")
    except ValueError:
        return spark.table(table)
    raise AssertionError("the table was there, so the write had to fail")


@_query
def write_ignore_existing(spark, sf):
    table = _saved(spark, sf, "part")
    tf.save_table(_load(spark, sf, "supplier"), table, mode="ignore")
    return spark.table(table)


# -- uploads ------------------------------------------------------------------


@_query
def upload_lite(spark, sf):
    table = _fresh_table(spark, "customers")
    customers = _load(spark, sf, "customer").select(
        F.col("c_custkey").alias("Cust Key?"), F.col("c_name").alias("Name!")
    )
    tf.upload_lite(customers, table, clean=True)
    return spark.table(table)


@_query
def upload_typed(spark, sf):
    table = _fresh_table(spark, "parts")
    parts = _load(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    tf.upload_typed(parts, table, order_by="p_partkey", unique_order=True)
    return spark.table(table).withColumn("p_retailprice", F.col("p_retailprice").cast("double"))


@_query
def upload_full(spark, sf):
    table = _fresh_table(spark, "customers")
    segment = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment"))
    customers = _load(spark, sf, "customer").select(
        F.col("c_custkey").alias("Cust Key"), segment.alias("Market Segment (*)")
    )
    tf.upload(customers, table, mode="fail", order_by="Cust Key", unique_order=True)
    return spark.table(table)


@_query
def upload_wkt(spark, sf):
    table = _fresh_table(spark, "customers")
    customers = _load(spark, sf, "customer").select("c_custkey", _point().alias("Place"))
    tf.upload(customers, table, order_by="c_custkey", unique_order=True, wkt_column="Place")
    point = F.col("geometry.coords")[0][0]
    return spark.table(table).select(
        "id", "c_custkey", F.col("geometry.srid").alias("srid"),
        point["x"].alias("x"), point["y"].alias("y"),
    )


@_query
def upload_wkt_append(spark, sf):
    table = _fresh_table(spark, "customers")
    customers = _load(spark, sf, "customer").select("c_custkey", _point().alias("place"))
    low = F.col("c_custkey") % 3 == 0
    for part in (customers.where(low), customers.where(~low)):
        tf.upload(part, table, order_by="c_custkey", unique_order=True, wkt_column="place")
    point = F.col("geometry.coords")[0][0]
    return spark.table(table).select("id", "c_custkey", point["x"].alias("x"), point["y"].alias("y"))


@_query
def upload_typed_geometry(spark, sf):
    table = _fresh_table(spark, "customers")
    customers = _load(spark, sf, "customer").select("c_custkey", _point().alias("place"))
    tf.upload_typed(customers, table, "place", order_by="c_custkey", unique_order=True)
    point = F.col("place.coords")[0][0]
    return spark.table(table).select("id", "c_custkey", point["x"].alias("x"), point["y"].alias("y"))


@_query
def insert_values(spark, sf):
    table = _fresh_table(spark, "amounts")
    orders = _load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
    )
    tf.upload(orders, table, order_by="k", unique_order=True)
    tf.insert_values(spark, table, "k, status, price", "(70, 'new', 12.5), (80, 'old', 25.0)")
    return spark.table(table)


@_query
def create_empty(spark, sf):
    table = _fresh_table(spark, "balances")
    tf.create_empty(spark, table, "(k bigint, balance real, name text)")
    customers = _load(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_acctbal").cast("float").alias("balance"),
        F.col("c_name").alias("name"),
    )
    tf.upload(customers, table, order_by="k", unique_order=True)
    return spark.table(table).withColumn("balance", F.col("balance").cast("double"))


@_query
def create_if_absent_keeps_rows(spark, sf):
    table = _saved(spark, sf, "supplier")
    tf.create_empty(spark, table, "a bigint")
    return spark.table(table)


# -- statements ---------------------------------------------------------------


@_query
def delete_where(spark, sf):
    table = _fresh_table(spark, "orders")
    status = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus"))
    orders = _load(spark, sf, "orders")
    tf.save_table(orders.select("o_orderkey", status.alias("o_orderstatus")), table)
    tf.delete_where(spark, table, "o_orderstatus = 'P'")
    return spark.table(table)


def _lines_in_files(spark, sf):
    """A table of 16 files, each of which holds a range of orders."""
    table = _fresh_table(spark, "lines")
    lines = _load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    ranged = lines.repartitionByRange(16, "l_orderkey").sortWithinPartitions("l_orderkey")
    ranged.write.saveAsTable(table)
    return table


@_query
def delete_where_files(spark, sf):
    """Few of the files hold such orders."""
    table = _lines_in_files(spark, sf)
    tf.delete_where(spark, table, "l_orderkey BETWEEN 1000 AND 2999 AND l_quantity > 20")
    return spark.table(table)


@_query
def update_where_files(spark, sf):
    table = _lines_in_files(spark, sf)
    tf.update_where(spark, table, {"l_quantity": "-l_quantity", "l_suppkey": "NULL"}, "l_orderkey < 1500")
    return spark.table(table)


@_query
def rewrite_in_one_step(spark, sf):
    """A new column, then other values, each by one switch; an append goes to the last folder."""
    table = _saved(spark, sf, "orders")
    tf.rewrite_table(spark.table(table).withColumn("double_price", F.col("o_totalprice") * 2), table)
    tf.rewrite_table(spark.table(table).withColumn("o_orderstatus", F.lower("o_orderstatus")), table)
    tf.save_table(_load(spark, sf, "orders").where("o_totalprice > 300000"), table)
    return spark.table(table).select("o_orderkey", "o_orderstatus", "double_price")


@_query
def delete_where_partitioned(spark, sf):
    table = _fresh_table(spark, "orders")
    _load(spark, sf, "orders").write.partitionBy("o_orderstatus").saveAsTable(table)
    tf.delete_where(spark, table, "o_orderstatus = 'P' AND o_totalprice < 200000")
    return spark.table(table)


@_query
def delete_where_many_partitions(spark, sf):
    """1,501 partitions change, the one for NULL among them; 100 do not."""
    table = _fresh_table(spark, "lines")
    part = F.col("l_orderkey") % 1601
    lines = _load(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.when(part < 1600, part).alias("part")
    )
    lines.repartition(8, "part").write.partitionBy("part").saveAsTable(table)
    tf.delete_where(spark, table, "(part < 1500 OR part IS NULL) AND l_linenumber < 7")
    return spark.table(table)


@_query
def run_statement(spark, sf):
    table = _saved(spark, sf, "orders")
    _register(spark, sf, "orders")
    tf.run_statement(
        spark,
        f"""INSERT INTO {table} SELECT -o_orderkey, o_custkey, 'N', o_totalprice, o_orderdate,
            o_orderpriority FROM orders WHERE o_totalprice > :least""",
        {"least": 200000},
    )
    return spark.table(table).select("o_orderkey", "o_orderstatus", "o_totalprice")


@_query
def update_where(spark, sf):
    table = _saved(spark, sf, "customer")
    tf.update_where(spark, table, {"c_acctbal": "0"}, "c_acctbal < 0")
    return spark.table(table).select("c_custkey", "c_acctbal")


@_query
def add_drop_column(spark, sf):
    table = _saved(spark, sf, "part")
    tf.add_column(spark, table, "note", "string")
    tf.update_where(spark, table, {"note": "p_name"})
    tf.drop_column(spark, table, "p_name")
    return spark.table(table)


# -- row ids ------------------------------------------------------------------


@_query
def add_id_new(spark, sf):
    return tf.assign_ids(_load(spark, sf, "orders"), "o_orderkey", unique_order=True)


@_query
def add_id_copies(spark, sf):
    lines = _load(spark, sf, "lineitem")
    return tf.assign_ids(lines, lines.columns)


@_query
def add_id_frame_order(spark, sf):
    ordered = _load(spark, sf, "orders").orderBy("o_orderkey")
    return tf.assign_ids(ordered).select("id", "o_orderkey")


@_query
def add_id_by_file(spark, sf):
    """The ids of rows as they stand in Parquet files, without a copy of them."""
    path = fresh_path(spark, "orders")
    _load(spark, sf, "orders").orderBy("o_orderkey").write.parquet(path)
    return tf.assign_ids(spark.read.parquet(path), by_file=True)


@_query
def add_id_reserved(spark, sf):
    """Two appends, the second after a block that was reserved and not used."""
    table = _fresh_table(spark, "orders")
    orders = _load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    tf.upload(orders.where("o_orderkey % 3 = 0"), table, order_by="o_orderkey", unique_order=True)

    def reserve(count):
        return tf.reserve_ids(spark, table, count)

    for part in (1, 2):
        some = orders.where(f"o_orderkey % 3 = {part}")
        tf.append_numbered(some, table, "o_orderkey", unique_order=True, reserve=reserve)
        tf.reserve_ids(spark, table, 100)
    return spark.table(table)


@_query
def append_once(spark, sf):
    """Each batch is written twice and is there once."""
    table = _fresh_table(spark, "orders")
    orders = _load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    for run in range(2):
        for batch in range(3):
            tf.append_once(orders.where(f"o_orderkey % 3 = {batch}"), table, f"batch '{batch}'")
    return spark.table(table)


@_query
def append_unique(spark, sf):
    """What an append is refused for, and the rows of the table that has taken another one."""
    table = _fresh_table(spark, "lines")
    lines = _load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    keys = ["l_orderkey", "l_linenumber"]
    tf.save_table(lines.where("l_orderkey % 10 < 8"), table)
    tf.append_unique(lines.where("l_orderkey % 10 = 8"), table, keys)
    late = lines.where("l_orderkey % 10 = 9 OR l_orderkey % 100 = 8")
    nameless = F.when(F.col("l_orderkey") % 100 != 19, F.col("l_linenumber")).alias("l_linenumber")
    refused = tf.append_unique(late.select("l_orderkey", nameless), table, keys)
    return refused.crossJoin(spark.table(table).agg(F.count("*").alias("n_rows")))


@_query
def add_id_append(spark, sf):
    table = _fresh_table(spark, "orders")
    orders = _load(spark, sf, "orders")
    for batch in ("o_orderkey % 10 <> 0", "o_orderkey % 10 = 0"):
        tf.upload(orders.where(batch), table, order_by="o_orderkey", unique_order=True)
    return spark.table(table)


@_query
def add_id_position(spark, sf):
    table = _fresh_table(spark, "customers")
    customers = _load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    owing = _load(spark, sf, "customer").where("c_acctbal < 0").select(customers.columns)
    tf.save_table(tf.assign_ids(customers, "c_custkey", position=2, unique_order=True), table)
    tf.upload(owing, table, order_by="c_custkey", unique_order=True)
    return spark.table(table)


@_query
def add_id_missing_column(spark, sf):
    table = _fresh_table(spark, "customers")
    customers = _load(spark, sf, "customer")
    tf.save_table(customers.where("c_custkey % 4 <> 0"), table)
    new = customers.where("c_custkey % 4 = 0")
    tf.upload(new, table, order_by="c_custkey", unique_order=True)
    return spark.table(table)


@_query
def add_id_all_null(spark, sf):
    table = _fresh_table(spark, "suppliers")
    suppliers = _load(spark, sf, "supplier")
    old = suppliers.where("s_suppkey % 5 <> 0")
    tf.save_table(old.select(F.lit(None).cast("bigint").alias("id"), "*"), table)
    new = suppliers.where("s_suppkey % 5 = 0")
    tf.upload(new, table, order_by="s_suppkey", unique_order=True)
    return spark.table(table)


@_query
def add_id_partial_null(spark, sf):
    table = _fresh_table(spark, "suppliers")
    suppliers = _load(spark, sf, "supplier")
    some_id = F.when(F.col("s_suppkey") % 7 != 0, F.col("s_suppkey") + 1)
    tf.save_table(suppliers.select(some_id.alias("id"), "s_suppkey"), table)
    owing = suppliers.where("s_acctbal < 0").select("s_suppkey")
    tf.upload(owing, table, order_by="s_suppkey", unique_order=True)
    return spark.table(table)


@_query
def max_id(spark, sf):
    return tf.max_value(_load(spark, sf, "orders"), "o_orderkey")


@_query
def max_id_empty(spark, sf):
    return tf.max_value(_load(spark, sf, "orders").where("o_totalprice < 0"), "o_orderkey")


@_query
def next_id(spark, sf):
    table = _fresh_table(spark, "orders")
    tf.upload(_load(spark, sf, "orders"), table)
    following = tf.next_id(spark, table)
    return spark.table(table).agg(
        F.count("*").alias("n"), F.lit(following).cast("bigint").alias("next_id")
    )


@_query
def max_id_footers(spark, sf):
    """The largest id as the footers of the table's files tell it, before and after a delete."""
    table = _fresh_table(spark, "orders")
    tf.upload(_load(spark, sf, "orders"), table, order_by="o_orderkey", unique_order=True)
    before = tf.table_max(spark, table)
    tf.delete_where(spark, table, "id % 10 > 6 OR o_totalprice < 1000")
    found = F.lit(tf.table_max(spark, table)).cast("bigint").alias("max_after")
    return spark.table(table).agg(
        F.count("*").alias("n"), F.lit(before).cast("bigint").alias("max_before"), found
    )


@_query
def key_violations(spark, sf):
    return tf.key_violations(_load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- cleaning -----------------------------------------------------------------


@_query
def clean_names(spark, sf):
    customers = _load(spark, sf, "customer").select(
        F.col("c_custkey").alias("Cust[ Key]"),
        F.col("c_name").alias("Customer\t Name?!"),
        F.col("c_acctbal").alias("Acctbal USD（$）"),
    )
    return tf.clean_names(customers)


@_query
def clean_names_collision(spark, sf):
    lines = _load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("A"), F.col("l_partkey").alias("a."), F.col("l_suppkey").alias("a!")
    )
    return tf.clean_names(lines)


@_query
def escape_quotes(spark, sf):
    note = F.concat(F.lit("it's \""), F.col("p_name"), F.lit('"'))
    return tf.escape_quotes(_load(spark, sf, "part").select("p_partkey", note.alias("note")))


@_query
def escape_quotes_html(spark, sf):
    return tf.escape_quotes(_load(spark, sf, "pages").select("page_id", "html"))


@_query
def escape_quotes_nulls(spark, sf):
    text = F.when(F.col("doc_id") % 5 != 0, F.col("text"))
    return tf.escape_quotes(_load(spark, sf, "documents").select("doc_id", text.alias("text")))


@_query
def strip_unsafe(spark, sf):
    wrapped = F.concat(F.lit("["), F.col("props"), F.lit("\\"), F.lit("]"))
    return tf.strip_unsafe(_load(spark, sf, "events").select("event_id", wrapped.alias("props")))


@_query
def null_geometry_placeholder(spark, sf):
    table = _fresh_table(spark, "places")
    suppliers = _load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"),
        F.concat(F.lit("POINT("), "s_nationkey", F.lit(" 0)")).alias("wkt"),
    )
    tf.upload(suppliers, table, add_id=False, wkt_column="wkt")
    customers = _load(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    tf.upload(customers, table, add_id=False)
    return spark.table(table).select("key", F.col("geometry.wkt").alias("geometry"))


# -- files --------------------------------------------------------------------


@_query
def load_csv(spark, sf):
    path = fixtures.csv_folder(_load(spark, sf, "customer"))
    table = _fresh_table(spark, "customers")
    tf.load_csv(spark, path, table, order_by="c_custkey", unique_order=True)
    return spark.table(table)


@_query
def load_csv_na(spark, sf):
    status = F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_orderstatus"))
    price = F.when(F.col("o_orderkey") % 3 == 0, "null").otherwise(
        F.col("o_totalprice").cast("string")
    )
    orders = _load(spark, sf, "orders").select(
        "o_orderkey", status.alias("o_orderstatus"), price.alias("o_totalprice")
    )
    return tf.read_csv(spark, fixtures.csv_folder(orders))


@_query
def load_csv_line_breaks(spark, sf):
    documents = _load(spark, sf, "documents").select("doc_id", "text", "source")
    return tf.read_csv(spark, fixtures.csv_folder(documents))


def _small_blocks(spark):
    """A session that reads files in small blocks, as if they were large ones."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return own


@_query
def load_csv_file_order(spark, sf):
    note = F.concat("o_orderstatus", F.lit("\n"), "o_orderpriority").alias("note")
    orders = _load(spark, sf, "orders").select("o_orderkey", note).orderBy("o_orderkey")
    table = _fresh_table(spark, "orders")
    tf.load_csv(_small_blocks(spark), fixtures.csv_folder(orders), table)
    return spark.table(table)


@_query
def load_json_file_order(spark, sf):
    parts = _load(spark, sf, "part").select("p_partkey", "p_name").orderBy("p_partkey")
    table = _fresh_table(spark, "parts")
    tf.load_json(_small_blocks(spark), fixtures.json_arrays(parts), table)
    return spark.table(table)


@_query
def load_csv_stray_quotes(spark, sf):
    key, name = F.col("p_partkey"), F.col("p_name")
    bare, quoted = F.concat(F.lit(',5" '), name), F.concat(F.lit(',"6""\n'), name, F.lit('"'))
    lines = F.concat(key.cast("string"), F.when(key % 2 == 0, bare).otherwise(quoted))
    path = fixtures.headed_lines(_load(spark, sf, "part").select(lines), "p_partkey,v")
    return tf.read_csv(_small_blocks(spark), path)


@_query
def load_json_lines_auto(spark, sf):
    path = fresh_path(spark, "json")
    turns = _load(spark, sf, "conversations")
    turns.select(F.struct("conv_id", "turn").alias("at"), F.struct("role", "text").alias("said")).write.json(path)
    found = tf.read_json(spark, path)
    return found.select("at.conv_id", "at.turn", "said.role", "said.text")


@_query
def load_json_records(spark, sf):
    parts = _load(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    table = _fresh_table(spark, "parts")
    tf.load_json(spark, fixtures.json_arrays(parts), table, add_id=False)
    return spark.table(table)


@_query
def load_json_lines(spark, sf):
    path = fresh_path(spark, "json")
    _load(spark, sf, "conversations").write.json(path)
    return tf.read_json(spark, path, layout="lines")


@_query
def load_json_columns(spark, sf):
    customers = _load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = fixtures.json_column_files(customers, F.col("c_custkey"))
    return tf.read_json(spark, path)


@_query
def load_xlsx(spark, sf):
    customers = _load(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal"
    )
    return parse_workbooks(fixtures.workbooks(customers, F.col("c_custkey")))


@_query
def pipe_csv_roundtrip(spark, sf):
    documents = _load(spark, sf, "documents").select("doc_id", "text")
    path = fresh_path(spark, "csv")
    tf.write_delimited(documents, path)
    return tf.read_delimited(spark, path, documents.schema)


@_query
def empty_to_null(spark, sf):
    lang = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang"))
    documents = _load(spark, sf, "documents").select("doc_id", lang.alias("lang"))
    path = fresh_path(spark, "csv")
    tf.write_delimited(documents, path)
    return tf.read_delimited(spark, path, documents.schema)


# -- geometry -----------------------------------------------------------------


def _point():
    return F.concat(
        F.lit("POINT ("), F.col("c_nationkey"), F.lit(" "), F.col("c_custkey") % 90, F.lit(")")
    )


def _xy(point):
    return [point["x"].alias("x"), point["y"].alias("y")]


@_query
def geo_point(spark, sf):
    geometry = _load(spark, sf, "customer").select("c_custkey", tf.parse_wkt(_point()).alias("g"))
    return geometry.select("c_custkey", *_xy(F.col("g.coords")[0][0]), F.col("g.srid").alias("srid"))


@_query
def geo_line(spark, sf):
    line = F.concat(
        F.lit("linestring("), "l_linenumber", F.lit(" 0, 1.5 -2e1,"), "l_suppkey", F.lit(" 7)")
    )
    lines = _load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", tf.parse_wkt(line).alias("g")
    )
    points = F.col("g.coords")[0]
    return lines.select(
        "l_orderkey",
        F.size(points).alias("n_points"),
        F.element_at(points, 1)["x"].alias("first_x"),
        F.element_at(points, -1)["x"].alias("last_x"),
    )


@_query
def geo_polygon(spark, sf):
    outer = F.concat(F.lit("(0 0, 0 "), "p_size", F.lit(", 9 9, 0 0)"))
    hole = F.when(F.col("p_partkey") % 2 == 0, ", (1 1, 1 2, 2 2, 1 1)").otherwise("")
    polygon = F.concat(F.lit("POLYGON ("), outer, hole, F.lit(")"))
    parts = _load(spark, sf, "part").select("p_partkey", tf.parse_wkt(polygon).alias("g"))
    return parts.select(
        "p_partkey",
        F.size("g.coords").alias("n_rings"),
        F.col("g.coords")[0][1]["y"].alias("second_y"),
        tf.is_valid(F.col("g"), "POLYGON").alias("is_valid"),
    )


@_query
def geo_valid(spark, sf):
    bad = F.element_at(
        F.array(F.lit("POINT (1)"), F.lit("LINESTRING (0 0, 1 1)")),
        (F.col("c_custkey") % 3).cast("int"),
    )
    wkt = F.when(F.col("c_custkey") % 3 == 0, _point()).otherwise(bad)
    geometry = tf.parse_wkt(wkt)
    return _load(spark, sf, "customer").select(
        "c_custkey", tf.is_valid(geometry, "POINT").alias("is_valid")
    )


@_query
def geo_add_column(spark, sf):
    table = _fresh_table(spark, "customers")
    customers = _load(spark, sf, "customer")
    tf.save_table(customers.select("c_custkey", "c_name", _point().alias("wkt")), table)
    tf.add_geometry_column(spark, table, "wkt", "POINT")
    return spark.table(table).select(
        "c_custkey", "c_name",
        F.col("geometry.type").alias("geom_type"), F.col("geometry.srid").alias("srid"),
    )


@_query
def geo_reject_all(spark, sf):
    table = _fresh_table(spark, "customers")
    wkt = F.when(F.col("c_custkey") == 0, "POINT (1 2").otherwise(_point())
    tf.save_table(_load(spark, sf, "customer").withColumn("wkt", wkt), table)
    refused = tf.add_geometry_column(spark, table, "wkt", "POINT")
    return spark.table(table).withColumn("refused", F.lit(refused.invalid).cast("bigint"))


@_query
def geo_roundtrip(spark, sf):
    table = _fresh_table(spark, "customers")
    customers = _load(spark, sf, "customer")
    tf.upload_geo(customers.select("c_custkey", tf.parse_wkt(_point()).alias("geometry")), table)
    text = spark.table(table).select("c_custkey", tf.to_wkt(F.col("geometry")).alias("geometry"))
    text.createOrReplaceTempView("ferry_places")
    decoded = tf.read_geometry(spark, "SELECT c_custkey, geometry FROM ferry_places")
    return decoded.select(
        "c_custkey", F.col("geometry.wkt").alias("wkt"), *_xy(F.col("geometry.coords")[0][0])
    )


@_query
def geo_ewkb(spark, sf):
    """Binary cells of all six shapes, some of them NULL and some cut off."""
    # 0, 1.5, -2.25, 0.1 and 1e10 as doubles, least significant byte first.
    numbers = F.array(*map(F.lit, (
        "0000000000000000", "000000000000F83F", "00000000000002C0", "9A9999999999B93F", "000000205FA00242",
    )))
    key = F.col("o_orderkey").cast("int")
    x, y = F.get(numbers, key % 5), F.get(numbers, F.floor(key / 5).cast("int") % 5)
    # one task reads a row group, which may be a whole file; decoding costs far more than to deal out the keys
    orders = _load(spark, sf, "orders").select("o_orderkey")
    orders = orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    # each column is worked out once for a row, and only the row's own shape
    orders = orders.select("o_orderkey", x.alias("x"), y.alias("y"))
    orders = orders.select("o_orderkey", F.concat("x", "y").alias("there"), F.concat("y", "x").alias("back"))
    there, back = F.col("there"), F.col("back")
    line = F.concat(F.lit("0102000000" "02000000"), there, back)
    ring = F.concat(F.lit("01000000" "04000000"), there, back, there, there)
    point = F.concat(F.lit("0101000000"), there)
    shapes = (
        F.concat(F.lit("0101000020" "110F0000"), there),
        line,
        F.concat(F.lit("0103000020" "110F0000"), ring),
        F.concat(F.lit("0104000000" "02000000"), point, F.lit("0101000000"), back),
        F.concat(F.lit("0105000000" "02000000"), line, line),
        F.concat(F.lit("0106000020" "110F0000" "02000000" "0103000000"), ring, F.lit("0103000000"), ring),
    )
    cell = F.coalesce(*[F.when(key % 6 == i, shape) for i, shape in enumerate(shapes)])
    orders = orders.select("o_orderkey", F.when(key % 7 != 0, cell).alias("cell"))
    cell = F.col("cell")
    cell = F.when(key % 11 == 0, F.substr(cell, F.lit(1), F.length(cell) - 2)).otherwise(cell)
    orders = orders.select("o_orderkey", cell.alias("geometry"))
    orders.createOrReplaceTempView("ferry_binary_cells")
    read = tf.read_geometry(spark, "SELECT * FROM ferry_binary_cells")
    coords = F.col("geometry.coords")
    last = F.element_at(coords, -1)
    return read.select(
        "o_orderkey",
        F.col("geometry.type").alias("shape"),
        F.col("geometry.srid").alias("srid"),
        F.size(coords).alias("n_rings"),
        F.size("geometry.parts").alias("n_parts"),
        coords[0][0]["x"].alias("first_x"),
        F.element_at(last, -1)["y"].alias("last_y"),
        tf.is_valid(F.col("geometry")).alias("is_valid"),
    )
