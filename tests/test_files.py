"""Small awkward files: tokeniser, stitching, delimiters, JSON, whole scans."""

import csv
import json
import random
import time

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cellmend.operators.file_stages import clean_files, scan_schemas, write_cleaned_files
from cellmend.operators.integrity_scan import scan_files
from cellmend.operators.inventory import categorize, number_inventory
from cellmend.operators.tables import add_lineage
from cellmend.sources import delimited, json as J, sinks
from cellmend.sources.listing import scan_inventory
from cellmend.sources.text import fields_of, read_lines


@pytest.fixture
def folder(tmp_path):
    def write(name, text):
        (tmp_path / name).write_bytes(text.encode())
        return str(tmp_path)
    write.root = str(tmp_path)
    return write


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.minPartitionNum", "64")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.minPartitionNum")


def python_rows(path):
    with open(path, newline="", encoding="utf-8") as fh:
        return list(csv.reader(fh))


csv.field_size_limit(1 << 20)
AWKWARD = ['"a,b",c', 'a"b,c"d', '"a"b,c', '"a ""x"", y",b', ",,", ",a", "", '""', '"",""',
           "a b, c ", '"x";y,z', '"' + "q" * 150_000 + '",z', '"""",a', "a,\"b\"\"\""]


@pytest.mark.parametrize("sep", [",", ";", "|", "\t"])
def test_fields_equal_csv_reader(spark, sep):
    lines = [line.replace(",", sep) for line in AWKWARD]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    got = [r[0] for r in df.orderBy("i").select(fields_of(F.col("line"), sep)).collect()]
    want = [next(csv.reader([line], delimiter=sep), []) for line in lines]
    assert got == want


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text(alphabet='ab,"\n;é ', max_size=6), min_size=1, max_size=4),
                min_size=1, max_size=12))
def test_written_rows_come_back(spark, tmp_path_factory, rows):
    root = tmp_path_factory.mktemp("h")
    with open(root / "t.csv", "w", newline="", encoding="utf-8") as fh:
        csv.writer(fh, lineterminator="\n").writerows(rows)
    got = delimited.records(read_lines(spark, str(root)), ",").orderBy("block", "line_no").collect()
    assert [r.fields for r in got] == python_rows(root / "t.csv")


def test_quoted_newlines_across_splits(spark, folder, tiny_splits):
    rng = random.Random(1)
    cells = ["a", "b\nc", '"q"', "x,y", "", '5" pipe', 'm""n', "\n\n"]
    with open(folder.root + "/big.csv", "w", newline="") as fh:
        csv.writer(fh, lineterminator="\n").writerows(
            [[rng.choice(cells) for _ in range(3)] for _ in range(300)])
    lines = ['a"b,c\n', '"x\n', 'y",z\n', "1,2\n", '"",""\n', '""",\n']
    folder("stray.csv", "".join(rng.choice(lines) for _ in range(200)) + '"')
    for name in ("big.csv", "stray.csv"):
        read = read_lines(spark, folder.root, name)
        assert read.select("block").distinct().count() > 10
        got = delimited.records(read, ",").orderBy("block", "line_no").collect()
        assert [r.fields for r in got] == python_rows(f"{folder.root}/{name}")


def test_delimiters(spark, folder):
    folder("semi.csv", "id;n\n1;2\n"), folder("pipe.csv", "id|n\n1|2\n")
    folder("tab.csv", "id\tn\n1\t2\n"), folder("one.csv", "id\n1\n")
    folder("mixed.csv", "a,b;c\n1,2;3;4\n5,6\n")
    got = delimited.detect_delimiter(read_lines(spark, folder.root)).collect()
    assert {r.file_path.rsplit("/", 1)[1]: r.sep for r in got} == {
        "semi.csv": ";", "pipe.csv": "|", "tab.csv": "\t", "one.csv": ",", "mixed.csv": ","}


def test_first_rows_in_file_order(spark, folder, tiny_splits):
    folder("n.csv", "".join(f"{i}\n" for i in range(200)))
    rows = delimited.first_rows(read_lines(spark, folder.root), 6).orderBy("row_id").collect()
    assert [(r.row_id, r.line) for r in rows] == [(i, str(i)) for i in range(6)]


def inventory(spark, rows):
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)],
        "serial_number int, filename string, file_type string, file_path string, has_header string")


def test_scan(spark, folder):
    root = folder.root
    files = {
        "ragged.csv": 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n\n"x\ny",2,3\n',
        "header_only.csv": "a,b\n",
        "nulls.csv": 'v,w\nNA,1\n"n a",2\n",",3\nx,4\n',
        "tab.tsv": "id\tn\n1\t2\n3\tx\n",
        "plain.dat": "1;2\n3;4\n",
        "lines.json": '{"id":1,"v":"a"}\n{"id":2,"v":"a"}\n',
        "array.json": '[{"a":1,"b":{"c":2}},{"a":1},\n{"a":null,"b":1,"z":[1]}]',
        "scalars.json": '[1,"x"]', "empty.json": "[]", "root.json": "7", "bad.json": '[{"a":',
        "same +%name.csv": "a\n1\n",
    }
    for name, text in files.items():
        folder(name, text)
    rows = [(n, n.rsplit(".", 1)[1].upper(), f"{root}/{n}", "no" if n == "plain.dat" else None)
            for n in files]
    rows += [("gone.csv", "csv", f"{root}/gone.csv", None), ("none", "csv", " ", None),
             ("a.zip", "ARCHIVES/ZIP", f"{root}/bad.json", None)]
    got = {r.filename: r for r in scan_files(spark, inventory(spark, rows), root).collect()}
    assert len(got) == len(rows)

    def metrics(name):
        r = got[name]
        return (r.null_pct, r.field_deviation_pct, r.type_deviation_pct, r.entropy_delta_pct,
                r.total_rows, r.total_cells, r.error)

    assert metrics("ragged.csv") == (8.333, 60.0, 9.091, 4.51, 4, 12, "")
    assert metrics("header_only.csv") == (0.0, 0.0, 0.0, 0.0, 0, 0, "")
    assert metrics("nulls.csv") == (37.5, 0.0, 0.0, 0.0, 4, 8, "")
    assert metrics("tab.tsv") == (0.0, 0.0, 25.0, 0.0, 2, 4, "")
    assert metrics("plain.dat") == (0.0, 0.0, 0.0, 0.0, 2, 4, "")
    assert metrics("lines.json") == (0.0, 0.0, 0.0, 50.0, 2, 4, "")
    assert metrics("array.json") == (58.333, 66.667, 0.0, 100.0, 3, 12, "")
    assert metrics("scalars.json") == (0.0, 0.0, 50.0, 0.0, 2, 2, "")
    assert metrics("empty.json") == (0.0, 0.0, 0.0, 0.0, 0, 0, "")
    assert metrics("same +%name.csv")[4:] == (1, 1, "")
    assert got["root.json"].error == "Unsupported JSON root type"
    assert got["bad.json"].error == "Malformed JSON"
    assert got["gone.csv"].error == f"File not found or empty: {root}/gone.csv"
    assert got["none"].error == "file_path is empty"
    assert got["a.zip"].null_pct is None and "zip" in got["a.zip"].error or got["a.zip"].error


def test_scan_does_not_depend_on_splits(spark, folder, tiny_splits):
    rng = random.Random(4)
    with open(folder.root + "/big.csv", "w", newline="") as fh:
        csv.writer(fh, lineterminator="\n").writerows(
            [["k", "v", "w"]] + [[rng.choice(["a", "b\nc", "", "1"]) for _ in range(3 + (i % 9 == 0))]
                                 for i in range(300)])
    inv = inventory(spark, [("big.csv", "csv", folder.root + "/big.csv", "true")])
    split = tuple(scan_files(spark, inv, folder.root).first())
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.minPartitionNum")
    assert tuple(scan_files(spark, inv, folder.root).first()) == split
    assert split[-1] == "" and split[-3] == 300


def test_key_counts(spark):
    docs = spark.createDataFrame(
        [("f", json.dumps(d)) for d in ({"a": 1, "b": {"c": 2}}, {"a": 1}, {"a": None, "b": 1, "z": [1]})],
        "file_path string, record string")
    cells = J.flatten_cells(docs).collect()
    assert sorted(r.value for r in cells if r.column_name is None) == ["1", "2", "3"]
    assert {r.column_name for r in cells} == {None, "a", "b", "b.c", "z"}


def test_deep_json(spark):
    doc = '{"a":{"b":{"c":{"d":{"e":1}}}},"x":{}}'
    df = spark.createDataFrame([("f", doc)], "file_path string, record string")
    cells = {r.column_name: r.value for r in J.flatten_cells(df).collect() if r.column_name}
    assert cells == {"a.b.c.d.e": "1"}
    deep = '{"k":' * 15 + "1e3" + "}" * 15
    df = spark.createDataFrame([("f", deep), ("g", '{"k":"{{{"}')], "file_path string, record string")
    cells = {r.column_name: r.value for r in J.flatten_cells(df).collect() if r.column_name}
    assert cells == {".".join("k" * 15): "1000.0", "k": "{{{"}


def test_json_is_strict(spark):
    texts = ['{"a":1}', '[1,2]', ' 7 ', '"x"', '{"a":1} junk', '1,2', '{"a":1},{"b":2}', '{"a":1,"a":2}',
             '["{oops","{x"]', '[', '1],[2', '1,"w":2', 'null', '']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    good = {r.t for r in df.filter(J.is_json(F.col("t"))).collect()}
    assert good == {'{"a":1}', '[1,2]', ' 7 ', '"x"', '["{oops","{x"]', 'null'}


def test_a_bad_json_file_is_an_error_row(spark, folder):
    (folder("good.json", '{"a":1e10}\n\n  {"a":2.0}\n \n'), folder("bad.json", '{"a":1}\n{"a":2} junk\n'),
     folder("twice.json", '{"a":1,"a":2}\n'), folder("texts.json", '["{oops","{x"]'), folder("none.json", "[]"))
    inventory = scan_inventory(spark, folder.root).select(
        "filename", F.lit("json").alias("file_type"), F.col("path").alias("file_path"))
    got = {r.filename: r for r in scan_files(spark, inventory, folder.root).collect()}
    assert {n: r.error for n, r in got.items()} == {
        "good.json": "", "bad.json": "Malformed JSON", "twice.json": "Malformed JSON",
        "texts.json": "", "none.json": ""}
    assert got["good.json"].type_deviation_pct == 0 and got["good.json"].total_cells == 2
    assert got["texts.json"].total_rows == 2 and got["none.json"].total_rows == 0


def test_cleaning_and_schemas_of_odd_files(spark, folder, tmp_path):
    (folder("a.csv", "Phone,Note\n(415) 555-2671,x\n12,\"y,\nz\",more\n"), folder("b.csv", "4155552671\n"),
     folder("c.json", '[{"phone":"+1 415 555 2671","k":{"a":1}},{"phone":null}]'), folder("d.json", '{"a":'),
     folder("e.csv", "only,header\n"))
    root = folder.root
    rows = [("a.csv", "csv", f"{root}/a.csv", "true", None), ("b.csv", "csv", f"{root}/b.csv", "no", '["phone"]'),
            ("c.json", "json", f"{root}/c.json", None, None), ("d.json", "json", f"{root}/d.json", None, None),
            ("e.csv", "csv", f"{root}/e.csv", None, None), ("gone", "csv", f"{root}/gone.csv", None, None)]
    inventory = spark.createDataFrame(
        rows, "filename string, file_type string, file_path string, has_header string, generated_headers string")
    cleaned, outcome = clean_files(spark, inventory, root)
    got = sorted(((r.file_path.rsplit("/", 1)[1], tuple(zip(r.names, r.values))) for r in cleaned.collect()), key=str)
    assert got == sorted([
        ("a.csv", (("Phone", "415-555-2671"), ("Note", "x"))),
        ("a.csv", (("Phone", None), ("Note", "y,\nz"), ("column_2", "more"))),
        ("b.csv", (("phone", "415-555-2671"),)),
        ("c.json", (("phone", "415-555-2671"), ("k", '{"a":1}'))), ("c.json", (("phone", None),))], key=str)
    assert {r.filename: r.error for r in outcome.collect() if r.error} == {
        "d.json": "Malformed JSON", "gone": f"File not found or empty: {root}/gone.csv"}
    write_cleaned_files(cleaned, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 5 and back.select("file_id").distinct().count() == 3
    schemas = {r.filename: r for r in scan_schemas(spark, inventory.drop("has_header", "generated_headers"), root).collect()}
    assert json.loads(schemas["c.json"].schema) == [
        {"name": "k.a", "type": "int", "nullable": True}, {"name": "phone", "type": "string", "nullable": True}]
    assert json.loads(schemas["d.json"].schema) == [{"error": "Malformed JSON"}]
    assert schemas["gone"].has_header and schemas["gone"].detection_reason.startswith("File not found")


def test_widths_beyond_a_million(spark):
    """Two records of 3 * 2**20 and 2 fields: half of them are off."""
    from cellmend.operators.file_profile import _per_column
    counts = spark.createDataFrame(
        [("f", str(3 * 2**20), 1), ("f", "2", 1)], "file_path string, key_text string, n long").selectExpr(
        "*", "CAST(NULL AS BIGINT) AS key_int", "CAST(NULL AS DOUBLE) AS key_float", "'text' AS kind",
        "CAST(NULL AS STRING) AS long_type", "CAST(NULL AS BIGINT) AS place", "true AS is_width")
    row = _per_column(counts, ["file_path"]).first()
    assert row.top_n == 1 and row.top_is_tie and row.n_cells == 2


def test_a_long_cell_is_searched_quickly(spark):
    from cellmend.functions.classify import looks_like_data
    cells = spark.createDataFrame([("a" * 1_000_000,), ("a@" * 100_000,), ("x a.b@c.de",)], "c string")
    start = time.time()
    assert [r[0] for r in cells.select(looks_like_data(F.col("c"))).collect()] == [False, False, True]
    assert time.time() - start < 5


def test_listing_and_numbering(spark, folder):
    (folder("x.CSV", "a\n"), folder("noext", "x"), folder("b c.json", "[]"))
    files = scan_inventory(spark, folder.root)
    got = {r.filename: (r.ext, r.path, r.length) for r in files.collect()}
    assert got == {"x.CSV": ("csv", f"{folder.root}/x.CSV", 2),
                   "noext": ("noext", f"{folder.root}/noext", 1),
                   "b c.json": ("json", f"{folder.root}/b c.json", 2)}
    numbered = number_inventory(categorize(files)).orderBy("serial_number").collect()
    assert [(r.serial_number, r.filename, r.file_type) for r in numbered] == [
        (1, "x.CSV", "CSV"), (2, "b c.json", "JSON")]


def test_listing_opens_no_file(spark, folder):
    folder("x.csv", "a\n")
    plan = scan_inventory(spark, folder.root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_quoted_csv_keeps_json(spark, tmp_path):
    schema = '[{"name": "a", "type": "int"}]'
    df = spark.createDataFrame([(1, schema, 'x\n"y" ')], "serial_number int, schema string, note string")
    path = str(tmp_path / "out")
    sinks.write_quoted_csv(df.coalesce(1), path)
    assert sinks.read_inventory_csv(spark, path).first().asDict() == {
        "serial_number": "1", "schema": schema, "note": 'x\n"y" '}
    text = next((tmp_path / "out").glob("*.csv")).read_bytes()
    assert text.startswith(b'"serial_number","schema","note"\n"1","[{""name"": ""a""')


def test_lineage(spark, folder):
    folder("x.csv", "a\n1\n")
    df = delimited.read_delimited_table(spark, folder.root)
    row = add_lineage(df, F.col("_metadata.file_path")).first()
    assert row._file_source.endswith("x.csv") and row._cleaned_at is not None


# --- Documents cut into elements, files with open quotes ------------------------------

def _value(rnd, depth=0):
    kind = rnd.randrange(8 if depth < 3 else 5)
    if kind < 3:
        return "".join(rnd.choice('a,"[]{}\\\n :é') for _ in range(rnd.randrange(8)))
    if kind < 5:
        return rnd.choice([None, True, 7, -1.5])
    if kind == 5:
        return [_value(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return {f"k{i}": _value(rnd, depth + 1) for i in range(rnd.randrange(4))}


def _plainly(value):
    """An element of a list that is not all objects, as its record has it."""
    if value is None:
        return {}
    return {"value": value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)}


def _documents(spark, root, line_sep):
    found = J.document_records(read_lines(spark, root, line_sep=line_sep), line_sep or "\n").collect()
    files = {}
    for r in found:
        records, errors = files.setdefault(r.file_path.split("/")[-1], ([], []))
        if r.record is not None:
            records.append(json.loads(r.record))
        if r.error:
            errors.append(r.error)
    return files


@pytest.mark.parametrize("line_sep", [None, ","])
def test_documents_against_the_json_module(spark, folder, tiny_splits, line_sep):
    rnd = random.Random(9)
    want = {}
    for i in range(30):
        objects = i % 2
        items = [({"a": _value(rnd), "b": _value(rnd)} if objects else _value(rnd)) for _ in range(rnd.randrange(12))]
        text = json.dumps(items, ensure_ascii=bool(i % 3), indent=rnd.choice([None, None, 1]))
        folder(f"f{i}.json", rnd.choice(["", " \n"]) + text + rnd.choice(["", "\n", " \n\n"]))
        as_objects = items and all(isinstance(x, dict) for x in items)
        want[f"f{i}.json"] = items if as_objects else [_plainly(x) for x in items]
    folder("object.json", json.dumps({"x": [1, {"y": ", ]"}], "z": "}"}, indent=1))
    want["object.json"] = [{"x": [1, {"y": ", ]"}], "z": "}"}]
    got = _documents(spark, folder.root, line_sep)
    assert got.keys() == want.keys()
    key = lambda x: json.dumps(x, sort_keys=True)
    for name, items in want.items():
        # Python and Spark write inner lists with other blanks.
        tidy = lambda rows: sorted(key({k: json.loads(v) if k == "value" and v[:1] in "[{" and v else v
                                        for k, v in r.items()} if "value" in r and _is_json(r["value"]) else r) for r in rows)
        assert not got[name][1] and tidy(got[name][0]) == tidy(items), name


def _is_json(text):
    try:
        json.loads(text)
        return True
    except (ValueError, TypeError):
        return False


BROKEN = ['[1,2', '[1,"a', '[1,2]]', '[1],[2]', '[1]\n[2]', '[1,2] x', '[1,,2]', '[1,]', '[,1]', '[{"a":1},{"a"}]',
          '[{"a":1]', '{"a":1', '["a\\"]', 'x', ',', '[1,"a\n']


@pytest.mark.parametrize("line_sep", [None, ","])
def test_broken_documents_are_errors(spark, folder, tiny_splits, line_sep):
    for i, text in enumerate(BROKEN):
        folder(f"b{i:02}.json", text)
    folder("good.json", '[{"a":1},{"a":2}]')
    folder("scalar.json", "7\n")
    got = _documents(spark, folder.root, line_sep)
    for i, text in enumerate(BROKEN):
        assert got[f"b{i:02}.json"][1] and set(got[f"b{i:02}.json"][1]) == {"Malformed JSON"}, text
    assert sorted(r["a"] for r in got["good.json"][0]) == [1, 2] and not got["good.json"][1]
    assert got["scalar.json"] == ([], ["Unsupported JSON root type"])


def test_a_document_without_line_ends_is_cut_by_many_tasks(spark, folder):
    rows = [{"id": i, "s": "x, ]" * (i % 3)} for i in range(4000)]
    folder("one.json", json.dumps(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        lines = read_lines(spark, folder.root, line_sep=",")
        assert lines.select("block").distinct().count() > 5
        records = J.document_records(lines, ",")
        assert sorted(json.loads(r.record)["id"] for r in records.collect()) == list(range(4000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_wide_objects_are_parsed_once_a_level(spark):
    one = spark.createDataFrame([("f", json.dumps({f"k{i}": i for i in range(4000)}))], "file_path string, record string")
    start = time.time()
    assert J.flatten_cells(one).count() == 4001
    assert time.time() - start < 20


def test_open_quotes_and_long_records_are_error_rows(spark, folder, tiny_splits):
    folder("good.csv", 'a,b\n1,"x\ny"\n2,z\n')
    folder("open.csv", "a,b\n" + "1,x\n" * 50 + '2,"lost\n' + "3,y\n" * 50)
    folder("late.csv", 'a,b\n1,"x\n')
    folder("long.csv", 'a,b\n1,x\n2,"' + "q\n" * 300 + '"\n')
    rows, problems = delimited.read_delimited(spark, folder.root, max_bytes=500)
    assert {(r.file_path.split("/")[-1], r.error) for r in problems.collect()} == {
        ("open.csv", "Unclosed quote from line 52"), ("late.csv", "Unclosed quote from line 2"),
        ("long.csv", "Record of over 500 bytes from line 3")}
    assert sorted(r.fields for r in rows.collect()) == [["1", "x\ny"], ["2", "z"], ["a", "b"]]


def test_a_stray_quote_does_not_stop_a_scan(spark, folder):
    root = folder("good.csv", 'a,b\n1,"x\ny"\n2,z\n')
    folder("open.csv", 'a,b\n1,x\n2,"lost\n3,y\n')
    inventory = scan_inventory(spark, root).select(
        "filename", F.lit("csv").alias("file_type"), F.col("path").alias("file_path"))
    got = {r.filename: r for r in scan_files(spark, inventory, root).collect()}
    assert got["good.csv"].error == "" and got["good.csv"].total_rows == 2
    assert got["open.csv"].error == "Unclosed quote from line 3" and got["open.csv"].total_rows is None
    rows, outcome = clean_files(spark, inventory, root)
    assert {r.filename: r.error for r in outcome.collect()} == {"good.csv": "", "open.csv": "Unclosed quote from line 3"}
    assert {r.file_path.split("/")[-1] for r in rows.collect()} == {"good.csv"}
    schemas = {r.filename: r.schema for r in scan_schemas(spark, inventory, root).collect()}
    assert json.loads(schemas["open.csv"]) == [{"error": "Unclosed quote from line 3"}]


@pytest.mark.parametrize("line_sep", [None, ","])
def test_long_lines_and_splits_give_the_same_elements(spark, folder, line_sep):
    rnd = random.Random(4)
    want = []
    for i in range(1500):
        want.append({"id": i, "s": rnd.choice(["x, ]", '"', "\\", "{,", ""]) * (i % 3), "t": [[], [1, {"u": 2}], i][i % 3]})
    text = json.dumps(want)
    for i in range(20):  # line ends between tokens, some right behind a comma
        at = text.index(', {"id": %d,' % rnd.randrange(1500)) + rnd.choice([0, 1])
        text = text[:at] + "\n  \n" + text[at:]
    folder("one.json", text)
    folder("none.json", "[]")
    for size in ("1000", "9000", "10000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = J.document_records(read_lines(spark, folder.root, line_sep=line_sep), line_sep or "\n").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert not [r for r in found if r.error]
        assert sorted((json.loads(r.record) for r in found if r.record), key=lambda r: r["id"]) == want
        assert [r.file_path.split("/")[-1] for r in found if r.record is None] == ["none.json"]


def test_lines_of_a_document_are_shuffled_once(spark):
    lines = spark.range(3000).selectExpr("'f' AS file_path", "id div 100 AS block", "id AS line_no",
                                         "concat(if(id = 0, '[', ','), '{\"a\":', id, if(id = 2999, '}]', '}')) AS line")
    reads = spark.sparkContext.accumulator(0)
    counted = spark.createDataFrame(lines.rdd.map(lambda r: (reads.add(1), tuple(r))[1]), lines.schema)
    found = J.json_records(counted)
    assert found.filter("error IS NOT NULL").count() == 0
    assert sorted(json.loads(r.record)["a"] for r in found.collect()) == list(range(3000))
    # Which files are documents, the states of splits, the elements; not once more per action.
    assert reads.value == 3 * 3000


def test_names_are_read_once_a_file_or_member(spark, folder, monkeypatch):
    from cellmend.operators import file_stages
    root = folder("a.csv", "id,Phone,price\n1,(212) 555-0001,$5\n2,123,\"(7)\",x@y.zz\n")
    folder("b.json", '{"phone":"2125550001","k":"v","Price":"$5"}\n')
    inventory = scan_inventory(spark, root).select(
        "filename", "ext", F.col("ext").alias("file_type"), F.col("path").alias("file_path"))
    uses, real = [], file_stages.semantic_type
    monkeypatch.setattr(file_stages, "semantic_type", lambda name: (uses.append(1), real(name))[1])
    rows, _ = clean_files(spark, inventory, root)
    got = sorted((dict(zip(r["names"], r["values"])) for r in rows.collect()), key=str)
    assert got == sorted([
        {"id": "1", "Phone": "212-555-0001", "price": "5.0"},
        {"id": "2", "Phone": None, "price": "-7.0", "column_3": "x@y.zz"},
        {"phone": "212-555-0001", "k": "v", "Price": "5.0"}], key=str)
    # The names of a file, names by number, members: none of them inside the choice of a cleaner.
    assert len(uses) == 3
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("currency") <= 6


def test_nesting_with_and_without_a_walk(spark):
    texts = {'{"a":1}': 1, '{"a":{"b":1},"c":{}}': 2, '{"a":[{"b":{"c":"{{{"}}]}': 3,
             '{"a":{"b":{"c":{"d":1}}},"e":{}}': 4, "{}": 1}
    rows = spark.createDataFrame([(t, d) for t, d in texts.items()], "t string, d int")
    assert [r for r in rows.select("t", "d", J.nesting(F.col("t")).alias("n")).collect() if r.d != r.n] == []


def test_a_line_of_json_is_parsed_once_for_its_facts(spark, folder):
    from cellmend.operators.integrity_scan import file_facts
    folder("good.json", '\n {"a":1}\n{"a":{"b":2}}\r\n')
    folder("twice.json", '{"a":1}\n{"a":1,"a":2}\n')
    folder("junk.json", '{"a":1} x\n')
    folder("array.json", '[{"a":1}]\n')
    lines = read_lines(spark, folder.root).withColumn("reader", F.lit("json"))
    got = {r.file_path.split("/")[-1]: (r.by_line, r.filled, r.bad, r.depth) for r in file_facts(lines).collect()}
    assert got == {"good.json": (True, True, False, 2), "twice.json": (True, True, True, 1),
                   "junk.json": (True, True, True, 1), "array.json": (False, False, False, None)}
