"""CSV, JSON and workbooks, small and cut into blocks."""

from __future__ import annotations

import json
import os
import random
import zipfile
from contextlib import contextmanager

import pandas as pd
import pytest
from helpers import rows

import tableferry as tf
from tableferry.plans.fixtures import workbook_bytes
from tableferry.sources.pieces import csv_records, json_records, spans_lines


@contextmanager
def small_blocks(spark, size=4096):
    """Read files in blocks of a few kilobytes, as a large file would be."""
    settings = {
        "spark.sql.files.maxPartitionBytes": str(size),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "64",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def test_csv_types_and_missing_values(spark, tmp_path):
    path = write(
        tmp_path, "a.csv", "k,real,flag,word,none\n1,1.5,True,NA,\n2,,False,\"a,\"\"b\"\"\",NaN\n\n3,2,,x,\n"
    )
    df = tf.read_csv(spark, path)
    assert df.dtypes == [
        ("k", "bigint"), ("real", "double"), ("flag", "boolean"), ("word", "string"), ("none", "double"),
    ]
    assert rows(df) == [
        (1, 1.5, True, None, None), (2, None, False, 'a,"b"', None), (3, 2.0, None, "x", None),
    ]


def test_csv_titles_blank_or_repeated(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a,,a\n1,2,3\n")
    assert tf.read_csv(spark, path).columns == ["a", "unnamed_1", "a_2"]


def test_csv_short_rows_fill_and_long_rows_raise(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a,b\n1\n2,3\n")
    assert rows(tf.read_csv(spark, path)) == [(1, None), (2, 3)]
    path = write(tmp_path, "b.csv", "a,b\n1,2\n2,3,4\n")
    with pytest.raises(Exception, match="more cells than titles"):
        tf.read_csv(spark, path).collect()


def test_csv_with_a_schema_refuses_bad_cells(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a,b\n1,x\n")
    assert rows(tf.read_csv(spark, path, schema="a int, b string")) == [(1, "x")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tf.read_csv(spark, path, schema="a int, b int").collect()


def test_csv_byte_order_mark_and_line_ends(spark, tmp_path):
    want = [(1, "a\r\nb"), (2, "c")] * 50
    path = write(tmp_path, "a.csv", "\ufeffk,v\r\n" + '1,"a\r\nb"\r\n2,c\r\n' * 50)
    assert rows(tf.read_csv(spark, path)) == sorted(want)
    with small_blocks(spark, 64):
        assert rows(tf.read_csv(spark, path)) == sorted(want)
    path = write(tmp_path, "b.csv", "\ufeffk,v\r\n1,x\r\n2,c\r\n")
    assert rows(tf.read_csv(spark, path)) == [(1, "x"), (2, "c")]


def test_csv_packed(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.csv.gz", "wt") as out:
        out.write('k,v\n1,"a\nb"\n2,c\n')
    assert rows(tf.read_csv(spark, str(tmp_path / "a.csv.gz"))) == [(1, "a\nb"), (2, "c")]


def messy_table(count, seed=7):
    pick = random.Random(seed)
    words = ["plain", 'say "hi"', "two\nlines", "a,b", "tail\r\nend", '"', "é{}[]\\", " pad ", "x" * 300]
    return [(i, "".join(pick.choices(words, k=pick.randint(1, 4)))) for i in range(count)]


def as_csv(table):
    quote = lambda t: '"' + t.replace('"', '""') + '"'
    return "k,text\n" + "".join(f"{k},{quote(t)}\n" for k, t in table)


def test_csv_records_that_span_blocks(spark, tmp_path):
    table = messy_table(900)
    path = write(tmp_path, "a.csv", as_csv(table))
    assert os.path.getsize(path) > 20 * 4096
    with small_blocks(spark):
        assert spark.read.text(path).rdd.getNumPartitions() > 20
        assert csv_records(spark, path, ",").count() == len(table)
        got = rows(tf.read_csv(spark, path, na_tokens=()))
    assert got == sorted(table, key=lambda r: tuple(map(str, r)))


def test_csv_records_of_several_files(spark, tmp_path):
    table = messy_table(300)
    write(tmp_path, "a.csv", as_csv(table[:100]))
    write(tmp_path, "b.csv", as_csv(table[100:]))
    with small_blocks(spark):
        got = rows(tf.read_csv(spark, str(tmp_path), na_tokens=()))
    assert got == sorted(table, key=lambda r: tuple(map(str, r)))
    assert rows(tf.read_csv(spark, str(tmp_path), na_tokens=())) == got


def test_csv_files_with_different_headers_are_refused(spark, tmp_path):
    for name, titles in (("a.csv", "k,v"), ("b.csv", "v,k")):
        write(tmp_path, name, titles + "\n" + "".join(f'{i},"{i}\n"\n' for i in range(500)))
    with small_blocks(spark, 1024), pytest.raises(ValueError, match="different headers"):
        tf.read_csv(spark, str(tmp_path))
    with pytest.raises(ValueError, match="different headers"):
        tf.read_csv(spark, str(tmp_path))


def test_csv_stray_quotes(spark, tmp_path):
    lines = "".join(f'{i},5" pipe {i}\n' for i in range(400))
    path = write(tmp_path, "a.csv", "k,v\n" + lines)
    with small_blocks(spark, 1024):
        assert not spans_lines(spark, path, ",")
        got = tf.read_csv(spark, path)
        assert got.count() == 400
        assert got.where("k = 7").first().v == '5" pipe 7'
    mixed = "".join(f'{i},5" pipe\n{i},"two\n5"" lines"\n{i},plain"\n' for i in range(300))
    path = write(tmp_path, "b.csv", "k,v\n" + mixed)
    want = sorted(x for i in range(300) for x in ((i, '5" pipe'), (i, 'two\n5" lines'), (i, 'plain"')))
    for size in (512, 1 << 20):
        with small_blocks(spark, size):
            assert spans_lines(spark, path, ",")
            assert sorted(map(tuple, tf.read_csv(spark, path).collect())) == want


@pytest.mark.parametrize("titles", [("a,a,b", "b,a,a"), ("a,,b", "a,b,")])
def test_csv_headers_are_compared_when_titles_change(spark, tmp_path, titles):
    write(tmp_path, "a.csv", titles[0] + "\n1,2,3\n")
    write(tmp_path, "b.csv", titles[1] + "\n9,8,7\n")
    with pytest.raises(ValueError, match="different headers"):
        tf.read_csv(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("size", [1024, 1 << 20])
def test_ids_follow_the_files(spark, database, tmp_path, size):
    texts = {f"{i:02}": "".join(f'{i * 1000 + k},"x\ny"\n' for k in range(300)) for i in range(3)}
    for name, text in texts.items():
        write(tmp_path, f"{name}.csv", "k,v\n" + text)
    arrays = tmp_path / "arrays"
    arrays.mkdir()
    for i in range(3):
        write(arrays, f"{i}.json", json.dumps([{"k": i * 1000 + k} for k in range(300)], indent=1))
    with small_blocks(spark, size):
        tf.load_csv(spark, str(tmp_path / "*.csv"), f"{database}.c{size}")
        tf.load_json(spark, str(arrays), f"{database}.j{size}")
    for name in ("c", "j"):
        table = spark.table(f"{database}.{name}{size}")
        got = [r.k for r in table.orderBy("id").collect()]
        assert got == sorted(got) and len(got) == 900


def test_csv_without_line_breaks_is_split(spark, tmp_path):
    path = write(tmp_path, "a.csv", "k,v\n" + "".join(f'{i},"a, b"\n' for i in range(3000)))
    with small_blocks(spark):
        df = tf.read_csv(spark, path)
        assert df.rdd.getNumPartitions() > 5
        assert [r.k for r in tf.assign_ids(df).orderBy("id").collect()] == list(range(3000))


def test_pipe_roundtrip(spark, tmp_path):
    table = messy_table(200)
    df = spark.createDataFrame(table + [(200, None), (201, "")], "k bigint, text string")
    tf.write_delimited(df, str(tmp_path / "out"))
    back = tf.read_delimited(spark, str(tmp_path / "out"), df.schema)
    assert back.schema == df.schema
    assert rows(back) == rows(tf.empty_as_null(df))


def json_table(count, seed=3):
    pick = random.Random(seed)
    words = ["x", "},{", '"', "\\", "[", "]", "{", "}", ",", ":", "\n", "é", "\\\"}"]
    return [
        {
            "k": i,
            "text": "".join(pick.choices(words, k=pick.randint(0, 40))),
            "real": i / 4 if i % 5 else None,
            "flag": i % 2 == 0,
        }
        for i in range(count)
    ]


def by_key(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: r["k"])


@pytest.mark.parametrize("indent", [None, 2])
def test_json_records(spark, tmp_path, indent):
    table = json_table(500)
    path = write(tmp_path, "a.json", json.dumps(table, indent=indent))
    assert by_key(tf.read_json(spark, path)) == table
    with small_blocks(spark):
        assert json_records(spark, path).count() == len(table)
        assert by_key(tf.read_json(spark, path)) == table


def test_json_records_with_nested_values(spark, tmp_path):
    table = [{"k": i, "in": {"a": [{"b": "}"}, {"b": "]"}]}} for i in range(300)]
    path = write(tmp_path, "a.json", json.dumps(table) + "\n")
    with small_blocks(spark, 1024):
        got = tf.read_json(spark, path)
        assert got.count() == 300
        assert {r[0] for r in got.selectExpr("`in`.a[0].b").collect()} == {"}"}


def test_json_dates(spark, tmp_path):
    rows = [
        {
            "created_at": "2024-01-02T03:04:05", "date": "2024-01-02", "modified": "2024-01-02T03:04:05+02:00",
            "timestamp_ms": 1704164645000, "run_time": 1704164645, "timestamp_us": 1704164645000001,
            "start_time": "soon", "end_time": 5, "other": "2024-01-02",
        },
        {"created_at": None, "start_time": "2024-01-02", "modified": "2024-01-02T01:04:05Z"},
    ]
    path = write(tmp_path, "a.json", json.dumps(rows))
    df = tf.read_json(spark, path)
    assert dict(df.dtypes) == {
        "created_at": "timestamp_ntz", "date": "timestamp_ntz", "modified": "timestamp",
        "timestamp_ms": "timestamp_ntz", "run_time": "timestamp_ntz", "timestamp_us": "timestamp_ntz",
        "start_time": "string", "end_time": "bigint", "other": "string",
    }
    row = df.where("end_time = 5").first()
    assert str(row.created_at) == str(row.timestamp_ms) == str(row.run_time) == "2024-01-02 03:04:05"
    assert str(row.timestamp_us) == "2024-01-02 03:04:05.000001" and str(row.date) == "2024-01-02 00:00:00"
    assert df.select("modified").distinct().count() == 1


def test_json_empty_array(spark, tmp_path):
    path = write(tmp_path, "a.json", "[]")
    assert tf.read_json(spark, path).count() == 0


@pytest.mark.parametrize("size", [256, 1 << 20])
@pytest.mark.parametrize(
    "text",
    [
        '[{"a":1}]\n[{"a":2}]', '[{"a":1}] x', '{"a":{"0":1},"b":{"0":2}}\n{"b":{"0":4}}',
        '{"a":{"0":1},"b":{"0":2}} x', '{"a":{"0":1}}, 5',
    ],
)
def test_json_trailing_content_is_refused(spark, tmp_path, size, text):
    path = write(tmp_path, "a.json", text)
    layout = "records" if text.startswith("[") else "columns"
    with small_blocks(spark, size), pytest.raises(Exception):  # noqa: B017
        tf.read_json(spark, path, layout).collect()


def test_json_lines_are_recognised(spark, tmp_path):
    text = "".join(json.dumps({"in": {"k": i}, "more": {"k": -i}}) + "\n" for i in range(20))
    got = tf.read_json(spark, write(tmp_path, "a.json", text))
    assert sorted(r["in"].k for r in got.collect()) == list(range(20))
    one = tf.read_json(spark, write(tmp_path, "b.json", '{"k": 1, "v": "x"}\n'))
    assert rows(one) == [(1, "x")]


def test_json_quoted_numbers_have_types(spark, tmp_path):
    records = write(tmp_path, "a.json", '[{"a":"1","b":"x"},{"a":"2","b":"y"}]')
    columns = write(tmp_path, "b.json", '{"a":{"0":"1","1":"2"},"b":{"0":"x","1":"y"}}')
    lines = write(tmp_path, "c.json", '{"a":"1","b":"x"}\n{"a":"2","b":"y"}')
    for path in (records, columns, lines):
        df = tf.read_json(spark, path)
        assert dict(df.dtypes) == {"a": "bigint", "b": "string"}
        assert rows(df) == [(1, "x"), (2, "y")]


def test_json_lines_and_bad_layout(spark, tmp_path):
    table = json_table(50)
    path = write(tmp_path, "a.json", "\n".join(json.dumps(r) for r in table))
    assert by_key(tf.read_json(spark, path, layout="lines")) == table
    with pytest.raises(ValueError):
        tf.read_json(spark, path, layout="split")


@pytest.mark.parametrize("indent", [None, 1])
def test_json_columns(spark, tmp_path, indent):
    table = json_table(400)
    columns = {c: {str(r["k"]): r[c] for r in table} for c in table[0]}
    columns["t,{\"x"] = {str(r["k"]): [r["k"], {"z": 1}] for r in table}
    path = write(tmp_path, "a.json", json.dumps(columns, indent=indent))
    want = [{**r, "t,{\"x": f'[{r["k"]},{{"z":1}}]'} for r in table]
    strip = lambda d: {**d, "t,{\"x": d["t,{\"x"].replace(" ", "").replace("\n", "")}
    assert [strip(r) for r in by_key(tf.read_json(spark, path))] == want
    with small_blocks(spark):
        assert [strip(r) for r in by_key(tf.read_json(spark, path))] == want


def test_workbooks(spark, tmp_path):
    first = pd.DataFrame({"k": [1, 2], "v": ["a", None], "x": [1.5, 2.0]})
    second = pd.DataFrame({"v": ["<c>&", "NA"], "k": [3, 4], "extra": [True, False]})
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes(first))
    (tmp_path / "b.xlsx").write_bytes(workbook_bytes(second.astype({"extra": str})))
    (tmp_path / "notes.txt").write_text("not a workbook")
    df = tf.read_excel(spark, str(tmp_path))
    assert dict(df.dtypes) == {"k": "bigint", "v": "string", "x": "double", "extra": "boolean"}
    got = sorted((r.k, r.v, r.x, r.extra) for r in df.collect())
    assert got == [
        (1, "a", 1.5, None), (2, None, 2.0, None), (3, "<c>&", None, True), (4, None, None, False),
    ]


def test_workbook_dates_shared_strings_and_gaps(spark, tmp_path):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/'
        'officeDocument/2006/relationships"><sheets><sheet name="s" sheetId="1" r:id="r1"/>'
        "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/'
        'package/2006/relationships"><Relationship Id="r1" Target="/xl/worksheets/s.xml"/>'
        "</Relationships>",
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="170" '
        'formatCode="yyyy\\-mm"/><numFmt numFmtId="171" formatCode="0.0 &quot;days&quot;"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/>'
        "</cellXfs></styleSheet>",
        "xl/sharedStrings.xml": f'<sst xmlns="{main}"><si><t>day</t></si><si><r><t>wo</t></r><r>'
        "<t>rd</t></r></si><si><t>n</t></si></sst>",
        "xl/worksheets/s.xml": f'<worksheet xmlns="{main}"><sheetData>'
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c>'
        '<c r="C1" t="s"><v>2</v></c></row>'
        '<row r="2"><c r="A2" s="1"><v>45292</v></c><c r="C2" s="3"><v>7</v></c></row>'
        '<row r="3"><c r="A3" s="2"><v>45292.5</v></c><c r="B3" t="s"><v>1</v></c>'
        '<c r="C3" t="e"><v>#N/A</v></c></row><row r="4"/></sheetData></worksheet>',
    }
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)
    df = tf.read_excel(spark, str(tmp_path / "a.xlsx"))
    assert df.dtypes == [("day", "timestamp_ntz"), ("word", "string"), ("n", "bigint")]
    got = [(str(r.day), r.word, r.n) for r in df.orderBy("day").collect()]
    assert got == [("2024-01-01 00:00:00", None, 7), ("2024-01-01 12:00:00", "word", None)]
