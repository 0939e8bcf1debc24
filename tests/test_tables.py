"""Reading by name, save modes, statements and uploads on catalog tables."""

from __future__ import annotations

import duckdb
import pytest
from helpers import rows
from pyspark.sql import functions as F

import tableferry as tf
from tableferry.sinks.tables import column_ddl, save_mode, table_layout
from tableferry.sources.relation import classify, depth_predicates, depth_query


@pytest.fixture
def table(spark, database):
    name = f"{database}.t"
    tf.save_table(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k bigint, v string"), name)
    return name


# -- reads --------------------------------------------------------------------


@pytest.mark.parametrize(
    "cmd, kind",
    [
        ("", "table"),
        ("  ;", "table"),
        ("Select 1;", "query"),
        ("with a as (select 1) select * from a", "query"),
        ("(select 1)", "query"),
        ("WhErE x in (select 1)", "tail"),
    ],
)
def test_classify(cmd, kind):
    assert classify(cmd)[0] == kind


@pytest.mark.parametrize("cmd", ["delete from t", "selection", "join b on a where x", "wherever"])
def test_classify_refuses(cmd):
    with pytest.raises(ValueError):
        classify(cmd)


def test_read_relation(spark, table):
    assert tf.read_relation(spark, table).count() == 3
    assert rows(tf.read_relation(spark, table, "where v like '{%' or k = 2;")) == [(2, "b")]
    assert rows(tf.read_relation(spark, "ignored", f"SELECT max(k) AS k FROM {table}")) == [(3,)]


def test_filters_and_columns_reach_the_scan(spark, table):
    df = tf.read_relation(spark, table, "WHERE k > 1").select("v")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(k), GreaterThan(k,1)]" in plan
    assert "ReadSchema: struct<k:bigint,v:string>" in plan
    assert "ReadSchema: struct<v:string>" in (
        tf.read_relation(spark, table).select("v")._jdf.queryExecution().executedPlan().toString()
    )


def test_run_query_binds_values(spark, table):
    got = tf.run_query(spark, f"SELECT v FROM {table} WHERE v = :v;", {"v": "a' OR 'x'='x"})
    assert got.columns == ["v"] and got.collect() == []


def test_lists(spark, table, database):
    assert rows(tf.list_tables(spark, database)) == [("t", False)]
    assert rows(tf.list_columns(spark, table)) == [(1, "k", "bigint"), (2, "v", "string")]
    assert tf.table_exists(spark, table) and not tf.table_exists(spark, table + "x")


def test_get_session_is_the_running_one(spark):
    assert tf.get_session() is spark or tf.get_session().sparkContext is spark.sparkContext
    assert spark.conf.get("spark.sql.execution.arrow.pyspark.enabled") == "true"


def test_jdbc_options_keep_credentials_out_of_the_url():
    source = tf.TableSource("jdbc:postgresql://h/db", {"user": "u", "password": "p", "fetchsize": "5"})
    options = source.jdbc_options(dbtable="t", numPartitions=4, lowerBound=None)
    assert options == {
        "preferTimestampNTZ": "true", "fetchsize": "5", "batchsize": "10000", "user": "u",
        "password": "p", "url": "jdbc:postgresql://h/db", "dbtable": "t", "numPartitions": "4",
    }


class Recorder:
    """Stands in for a session whose reads go to a database."""

    def __init__(self, bounds=(1, 100)):
        self.bounds, self.seen = bounds, []
        self.read = self
        self.sparkContext = type("Context", (), {"defaultParallelism": 8})

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.seen.append(options)
        return self

    def load(self):
        return self

    def first(self):
        return self.bounds


SOURCE = tf.TableSource("jdbc:postgresql://h/db")


@pytest.mark.parametrize(
    "cmd, relation",
    [
        ("", "t"),
        ("select a from t;", "(select a from t) tmp"),
        ("WHERE st_x(geom) > 0", "(SELECT * FROM t WHERE st_x(geom) > 0) tmp"),
    ],
)
def test_jdbc_reads_send_the_text(cmd, relation):
    session = Recorder()
    tf.read_relation(session, "t", cmd, SOURCE)
    assert [o["dbtable"] for o in session.seen] == [relation]


def test_jdbc_reads_split_between_the_bounds():
    session = Recorder()
    tf.read_relation(session, "t", "WHERE a > 0", SOURCE, partition_column="k")
    bounds, scan = session.seen
    relation = "(SELECT * FROM t WHERE a > 0) tmp"
    assert bounds["dbtable"] == f"(SELECT min(k) AS low, max(k) AS high FROM {relation}) bounds"
    assert scan["dbtable"] == relation
    wanted = ("k", "1", "100", "8")
    keys = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
    assert tuple(scan[k] for k in keys) == wanted
    empty = Recorder(bounds=(None, None))
    tf.read_relation(empty, "t", "", SOURCE, partition_column="k")
    assert "partitionColumn" not in empty.seen[-1]


class Parts(Recorder):
    """Bounds as the database would give them, and the scan that follows."""

    def collect(self):
        return [{"low": low} for low in self.bounds]

    def jdbc(self, url, relation, predicates, properties):
        assert "url" not in properties
        self.scan = (url, relation, predicates)
        return self


def test_jdbc_reads_split_by_depth():
    session = Parts(bounds=(40, 1, 7, 7))
    tf.read_relation(session, "t", "WHERE a > 0", SOURCE, "k", 4, split="depth")
    relation = "(SELECT * FROM t WHERE a > 0) tmp"
    assert session.seen[0]["dbtable"] == (
        "(SELECT part, min(v) AS low FROM (SELECT k AS v, ntile(4) OVER (ORDER BY k) AS part "
        f"FROM {relation} WHERE k IS NOT NULL) dealt GROUP BY part) bounds"
    )
    url, read, predicates = session.scan
    assert (url, read) == (SOURCE.url, relation)
    assert predicates == ["k < 7 OR k IS NULL", "k >= 7 AND k < 40", "k >= 40"]


def test_jdbc_reads_split_by_hash():
    session = Parts()
    tf.read_relation(session, "t", "", SOURCE, "name", 3, split="hash")
    number = "abs(mod(hashtext(CAST(name AS text)), 3))"
    assert session.scan[2] == [f"{number} = 0 OR name IS NULL", f"{number} = 1", f"{number} = 2"]
    with pytest.raises(ValueError):
        tf.read_relation(session, "t", "", SOURCE, "name", 3, split="sideways")


@pytest.mark.parametrize("values", [[None, None], [], [5], [1, 1, 1, 2], list(range(50)) + [7] * 40 + [None] * 3])
@pytest.mark.parametrize("parts", [1, 4, 9])
def test_depth_splits_cover_each_row_once(values, parts):
    sql = duckdb.connect()
    sql.execute("CREATE TABLE t (k INTEGER)")
    sql.executemany("INSERT INTO t VALUES (?)", [[v] for v in values] or [[0]])
    lows = [r[1] for r in sql.sql(f"SELECT * FROM {depth_query('t', 'k', parts)}").fetchall()]
    found = [sql.sql(f"SELECT count(*) FROM t WHERE {p}").fetchall()[0][0] for p in depth_predicates("k", lows)]
    assert sum(found) == sql.sql("SELECT count(*) FROM t").fetchall()[0][0]
    if len(values) > 50 and parts == 9:
        assert max(found) <= 41 + 12
    words = sql.sql("SELECT CASE WHEN k IS NOT NULL THEN 'it''s ' || k END AS k FROM t")
    words.create_view("w")
    lows = [r[1] for r in sql.sql(f"SELECT * FROM {depth_query('w', 'k', parts)}").fetchall()]
    found = [sql.sql(f"SELECT count(*) FROM w WHERE {p}").fetchall()[0][0] for p in depth_predicates("k", lows)]
    assert sum(found) == sql.sql("SELECT count(*) FROM t").fetchall()[0][0]


def test_jdbc_maximum_runs_in_the_database():
    session = Recorder(bounds=(41,))
    assert tf.next_id(session, "t", "k", SOURCE) == 42
    assert session.seen[0]["dbtable"] == "(SELECT max(k) AS max_id FROM t) tmp"


def test_postgresql_settings():
    source = tf.postgresql("10.0.0.1:5433/my db", user="u", password="p")
    assert source.url == "jdbc:postgresql://10.0.0.1:5433/my%20db"
    assert (source.options["user"], source.options["password"]) == ("u", "p")
    assert set(tf.postgresql("h/d").options) == {"driver"}


def test_jdbc_catalog_settings(spark):
    tf.register_jdbc_catalog(spark, "pg", tf.TableSource("jdbc:postgresql://h/db", {"user": "u"}))
    assert spark.conf.get("spark.sql.catalog.pg.url") == "jdbc:postgresql://h/db"
    assert spark.conf.get("spark.sql.catalog.pg.user") == "u"
    for key in ("", ".url", ".user", ".pushDownAggregate", ".fetchsize", ".batchsize", ".preferTimestampNTZ"):
        spark.conf.unset(f"spark.sql.catalog.pg{key}")


# -- save modes ---------------------------------------------------------------


def test_append_by_name_fills_and_refuses(spark, table):
    tf.save_table(spark.createDataFrame([("z",)], "V string"), table)
    assert spark.table(table).where("v = 'z' AND k IS NULL").count() == 1
    with pytest.raises(ValueError, match="no column w"):
        tf.save_table(spark.createDataFrame([(1,)], "w int"), table)


def test_append_by_position(spark, table):
    tf.save_table(spark.createDataFrame([(9, "z")], "x bigint, y string"), table, match="position")
    assert spark.table(table).where("k = 9 AND v = 'z'").count() == 1
    with pytest.raises(ValueError, match="do not fit"):
        tf.save_table(spark.createDataFrame([(9,)], "x bigint"), table, match="position")


def test_name_and_position_agree_when_the_order_does(spark, database):
    df = spark.createDataFrame([(1, "a")], "k bigint, v string")
    for match in ("name", "position"):
        tf.save_table(df, f"{database}.{match}")
        tf.save_table(df, f"{database}.{match}", match=match)
    assert rows(spark.table(f"{database}.name")) == rows(spark.table(f"{database}.position"))


def test_replace_may_read_its_own_table(spark, table):
    tf.save_table(spark.table(table).where("k = 2").select("v"), table, mode="overwrite")
    assert rows(spark.table(table)) == [("b",)]


def test_failed_replace_leaves_the_table(spark, table):
    bad = spark.table(table).select(F.raise_error(F.lit("boom")).cast("string").alias("v"))
    with pytest.raises(Exception, match="boom"):
        tf.save_table(bad, table, mode="replace")
    assert spark.table(table).count() == 3


def test_fail_and_ignore(spark, table):
    other = spark.createDataFrame([(9, "z")], "k bigint, v string")
    for mode in ("fail", "error", "errorifexists"):
        with pytest.raises(ValueError, match="exists"):
            tf.save_table(other, table, mode=mode)
    assert tf.save_table(other, table, mode="ignore") is False
    assert spark.table(table).count() == 3
    with pytest.raises(ValueError, match="unknown save mode"):
        save_mode("upsert")


def test_rewrite_keeps_the_layout(spark, database):
    name = f"{database}.parted"
    spark.range(6).selectExpr("id AS k", "id % 2 AS p").write.partitionBy("p").saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('kept by' = 'it\\'s me')")
    tf.delete_where(spark, name, "k < 2")
    tf.update_where(spark, name, {"k": "k * 10"}, "p = 1")
    layout = table_layout(spark, name)
    assert (layout.provider, layout.partitions) == ("parquet", ("p",))
    assert dict(layout.properties)["kept by"] == "it's me"
    assert rows(spark.table(name)) == [(2, 0), (30, 1), (4, 0), (50, 1)]
    tf.upload(spark.createDataFrame([(9, 1)], "k bigint, p bigint"), name, order_by="k")
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 3, 4, 5]
    assert table_layout(spark, name).partitions == ("p",)


def partition_files(spark, name):
    files = spark.table(name).selectExpr("concat_ws('/', p, q) AS part", "_metadata.file_path AS f")
    return {r.part: r.f for r in files.distinct().collect()}


def test_only_changed_partitions_are_written(spark, database):
    name = f"{database}.parted"
    rows_in = spark.range(12).selectExpr("id AS k", "'x' AS v", "id % 2 AS p", "concat('it''s ', id % 3) AS q")
    rows_in.repartition("p", "q").write.partitionBy("p", "q").saveAsTable(name)
    before = partition_files(spark, name)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")

    tf.delete_where(spark, name, "k = 3 OR q = 'it\\'s 1'")  # all of two partitions, part of one
    after = partition_files(spark, name)
    assert sorted(r.k for r in spark.table(name).collect()) == [0, 2, 5, 6, 8, 9, 11]
    assert sorted(after) == ["0/it's 0", "0/it's 2", "1/it's 0", "1/it's 2"]
    assert [k for k in after if after[k] != before[k]] == ["1/it's 0"]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 4

    tf.update_where(spark, name, {"v": "concat(v, k)"}, "k IN (0, 6)")
    assert [k for k, f in partition_files(spark, name).items() if f != after[k]] == ["0/it's 0"]
    assert sorted(r.v for r in spark.table(name).where("k IN (0, 6, 2)").collect()) == ["x", "x0", "x6"]
    tf.delete_where(spark, name, "k = 77")
    tf.update_where(spark, name, {"p": "7"}, "k = 0")  # moves a row to another partition
    assert spark.table(name).where("p = 7").count() == 1 and spark.table(name).count() == 7
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    left = tf.list_tables(spark, database).collect()
    assert [r.table_name for r in left] == ["parted"]


def test_a_null_partition_is_rewritten_too(spark, database):
    name = f"{database}.nulls"
    df = spark.range(6).selectExpr("id AS k", "nullif(id % 3, 0) AS p")
    df.write.partitionBy("p").saveAsTable(name)
    tf.delete_where(spark, name, "k < 3")
    assert rows(spark.table(name)) == [(3, None), (4, 1), (5, 2)]


def test_rewrite_keeps_buckets(spark, database):
    name = f"{database}.bucketed"
    spark.range(6).selectExpr("id AS k").write.bucketBy(2, "k").saveAsTable(name)
    tf.delete_where(spark, name, "k < 2")
    layout = table_layout(spark, name)
    assert (layout.buckets, layout.bucket_columns) == (2, ("k",))
    assert rows(spark.table(name)) == [(2,), (3,), (4,), (5,)]


def test_column_ddl():
    assert column_ddl("(k bigint, share real, label text)") == "k bigint, share real, label string"
    assert column_ddl("text text, d double precision not null") == (
        "text string, d double not null"
    )


def test_create_empty_and_insert(spark, database):
    name = f"{database}.sample"
    tf.create_empty(spark, name, "(k bigint, share real, label text)")
    tf.create_empty(spark, name, "z int")
    assert spark.table(name).dtypes == [
        ("id", "bigint"), ("k", "bigint"), ("share", "float"), ("label", "string"),
    ]
    tf.insert_values(spark, name, "k, share, label", "(5, 0.5, 'half'), (6, 0.25, 'less');")
    tf.insert_values(spark, name, ["label", "k"], [("x", 7)])
    assert rows(spark.table(name)) == [(1, 5, 0.5, "half"), (2, 6, 0.25, "less"), (3, 7, None, "x")]


# -- statements ---------------------------------------------------------------


def test_delete_keeps_rows_with_a_null_predicate(spark, table):
    tf.delete_where(spark, table, "v = 'a'")
    assert rows(spark.table(table)) == [(2, "b"), (3, None)]


def test_update_reads_the_old_row(spark, table):
    tf.update_where(spark, table, {"k": "k + 1", "v": "concat(v, k)"}, "k >= 2")
    assert rows(spark.table(table)) == [(1, "a"), (3, "b2"), (4, None)]
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        tf.update_where(spark, table, {"nope": "1"})


def test_add_and_drop_column(spark, table):
    tf.add_column(spark, table, "w", "double")
    assert rows(spark.table(table)) == [(1, "a", None), (2, "b", None), (3, None, None)]
    tf.drop_column(spark, table, "v")
    assert spark.table(table).columns == ["k", "w"]
    with pytest.raises(ValueError):
        tf.drop_column(spark, table, "v")


def test_run_statement(spark, table):
    tf.run_statement(spark, f"INSERT INTO {table} VALUES (:k, :v);", {"k": 4, "v": "d"})
    assert spark.table(table).count() == 4


def test_statement_errors_are_not_swallowed(spark, table):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        tf.delete_where(spark, table, "nope = 1")


# -- uploads ------------------------------------------------------------------


def test_upload_modes_judge_the_table_as_it_was(spark, database):
    name = f"{database}.u"
    df = spark.createDataFrame([("x",), ("y",)], ["V"])
    report = tf.upload(df, name, mode="fail")
    assert (report.first_id, report.next_id) == (1, 3)
    with pytest.raises(ValueError, match="exists"):
        tf.upload(df, name, mode="fail")
    assert not tf.upload(df, name, mode="ignore").written
    assert tf.upload(df, name, order_by="V").next_id == 5
    tf.upload(df, name, mode="replace", order_by="V")
    assert rows(spark.table(name)) == [(1, "x"), (2, "y")]
    assert spark.table(name).columns == ["id", "v"]


def test_upload_options(spark, database):
    name = f"{database}.u"
    df = spark.createDataFrame([(5, "it's \"\"", "")], "id bigint, Q string, E string")
    with pytest.raises(ValueError, match="replace_id"):
        tf.upload(df, name)
    tf.upload(df, name, replace_id=True, escape=True)
    assert rows(spark.table(name)) == [(1, "it''s ''''", None)]
    tf.upload(df, f"{database}.v", add_id=False, clean=False, empty_as_null=False)
    assert spark.table(f"{database}.v").columns == ["id", "Q", "E"]
    assert rows(spark.table(f"{database}.v")) == [(5, "it's \"\"", "")]


def test_upload_then_read_is_identity(spark, database):
    df = spark.sql(
        "SELECT 1L AS a, 2.5D AS b, DATE'2024-01-02' AS c, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS d, "
        "CAST(1.20 AS DECIMAL(10,2)) AS e, true AS f, array(1, 2) AS g, map('k', 1) AS h, X'00ff' AS i"
    )
    tf.upload(df, f"{database}.u")
    back = spark.table(f"{database}.u").drop("id")
    assert back.dtypes == df.dtypes
    assert back.collect() == df.collect()


def test_upload_by_position(spark, database):
    name = f"{database}.u"
    tf.upload(spark.createDataFrame([("a", 1)], "v string, n bigint"), name)
    tf.upload(spark.createDataFrame([("b", 2)], "x string, y bigint"), name, match="position")
    assert rows(spark.table(name)) == [(1, "a", 1), (2, "b", 2)]


def test_upload_with_bad_wkt_keeps_the_rows(spark, database):
    name = f"{database}.u"
    df = spark.createDataFrame([(1, "POINT(1 2)"), (2, "POINT(1")], "k bigint, Shape string")
    report = tf.upload(df, name, order_by="k", wkt_column="Shape")
    assert spark.table(name).columns == ["id", "k", "shape"]
    assert [r.k for r in report.bad_geometry.collect()] == [2]


def test_append_to_a_table_with_geometry(spark, database):
    name = f"{database}.u"
    df = spark.createDataFrame([(1, "POINT(1 2)")], "k bigint, wkt string")
    tf.upload(df, name, wkt_column="wkt")
    tf.upload(df, name, wkt_column="wkt")
    tf.upload(df.select("k"), name)
    report = tf.upload(df.withColumn("wkt", F.lit("no")), name, wkt_column="wkt")
    assert report.bad_geometry.count() == 1
    got = spark.table(name).orderBy("id").select("id", "geometry.wkt", "geometry.srid").collect()
    assert [tuple(r) for r in got] == [
        (1, "POINT(1 2)", 4326), (2, "POINT(1 2)", 4326), (3, None, None), (4, None, None),
    ]


def test_append_adds_geometry_to_the_whole_table(spark, database):
    name = f"{database}.u"
    df = spark.createDataFrame([(1, "POINT(1 2)")], "k bigint, wkt string")
    tf.upload(df, name)
    tf.upload(df, name, wkt_column="wkt")
    assert spark.table(name).where("geometry.type = 'POINT'").count() == 2
    with pytest.raises(ValueError, match="no table"):
        tf.add_geometry_column(spark, f"{database}.nope", "wkt")


def test_upload_typed(spark, database):
    name = f"{database}.u"
    df = spark.createDataFrame(
        [(1, 0.1, 7, "it's \"[x]\\", "POINT(1 2)")], "A bigint, b double, c int, D string, g string"
    )
    tf.upload_typed(df, name, geometry_column="g")
    row = spark.table(name).first()
    assert spark.table(name).columns == ["id", "A", "b", "c", "D", "g"]
    assert (row.id, row.A, row.c, row.D, row.g.type) == (1, 1, "7", "it's 'x", "POINT")
    tf.upload_typed(df, name, geometry_column="g", check=False)
    assert spark.table(name).where("id = 2").first().D == "it's x"
    with pytest.raises(ValueError, match="malformed"):
        tf.upload_typed(df.withColumn("g", F.lit("x")), name, geometry_column="g")


def test_upload_geo_needs_its_column(spark, database):
    with pytest.raises(ValueError):
        tf.upload_geo(spark.range(1), f"{database}.u")


def test_load_csv_numbers_in_file_order(spark, database, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("Name,V\n" + "".join(f"n{i},{i}\n" for i in range(100, 0, -1)))
    report = tf.load_csv(spark, str(path), f"{database}.u")
    assert report.next_id == 101
    got = spark.table(f"{database}.u").orderBy("id").collect()
    assert [(r.id, r.name, r.v) for r in got] == [
        (i, f"n{101 - i}", 101 - i) for i in range(1, 101)
    ]
    with pytest.raises(ValueError, match="exists"):
        tf.load_csv(spark, str(path), f"{database}.u")


def test_load_json_and_excel(spark, database, tmp_path):
    import pandas as pd

    from tableferry.plans.fixtures import workbook_bytes

    (tmp_path / "a.json").write_text('{"k": {"0": 5, "1": 6}, "v": {"0": "x", "1": null}}')
    tf.load_json(spark, str(tmp_path / "a.json"), f"{database}.j", order_by="k")
    assert rows(spark.table(f"{database}.j")) == [(1, 5, "x"), (2, 6, None)]
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes(pd.DataFrame({"K": [5, 6]})))
    tf.load_excel(spark, str(tmp_path / "a.xlsx"), f"{database}.x")
    assert rows(spark.table(f"{database}.x")) == [(1, 5), (2, 6)]
