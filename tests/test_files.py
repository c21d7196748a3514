import json
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerfold import schemas
from ledgerfold.functions.documents import from_document
from ledgerfold.functions.text import same_text, strip_crlf
from ledgerfold.plans.exports import EXPORTED, export_array_files, export_documents
from ledgerfold.sinks.files import (
    to_documents,
    write_delimited,
    write_documents,
    write_json_array,
)
from ledgerfold.sources.files import (
    read_delimited,
    read_json_array,
    scan_columns,
    unwrap_id,
    wrap_id,
)

# Fixed values that reading and writing must give back as they are.
BRANDS = r'[{"BrandID":1,"BrandName":"N\/A"},{"BrandID":2,"BrandName":"Northwind"}]'
TAX_RATES = [(1, "2.00"), (2, "3.00"), (3, "7.00"), (4, "12.00"), (5, "14.00"), (6, "20.00")]
LOGISTIC = [
    ("63f3dce1d3a48d2d7fd831f7", "DHL"),
    ("63f3dce1d3a48d2d7fd831f8", "UPS"),
    ("63f3dce1d3a48d2d7fd831f9", "CTT"),
]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def array_texts(path) -> list[str]:
    return [f.read_text().rstrip("\n") for f in sorted(Path(path).rglob("part-*"))]


@pytest.mark.parametrize("split", [False, True])
def test_json_array_file(spark, tmp_path, split):
    file = tmp_path / "brands"
    file.write_text(BRANDS + "\n")
    df = read_json_array(spark, str(file), schemas.BRAND, split)
    assert rows(df) == [(1, "N/A"), (2, "Northwind")]


@pytest.mark.parametrize("split", [False, True])
def test_json_decimals_keep_their_scale(spark, tmp_path, split):
    text = ",".join(f'{{"TaxRateID":{i},"TaxRate":{rate}}}' for i, rate in TAX_RATES)
    (tmp_path / "rates").write_text(f"[{text}]")
    df = read_json_array(spark, str(tmp_path / "rates"), schemas.TAX_RATE, split)
    assert rows(df) == [(i, Decimal(rate)) for i, rate in TAX_RATES]


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("text", ["[]", " [ ]\n"])
def test_json_array_without_documents(spark, tmp_path, split, text):
    (tmp_path / "none.json").write_text(text)
    assert rows(read_json_array(spark, str(tmp_path / "none.json"), schemas.BRAND, split)) == []


def test_split_read_cuts_a_file_into_many_tasks(spark, tmp_path):
    file = tmp_path / "lines.json"
    text = ",".join(json.dumps({"BrandID": i, "BrandName": "é" * (i % 50)}, ensure_ascii=False, separators=(",", ":")) for i in range(20000))
    file.write_text(f"[{text}]", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        df = read_json_array(spark, str(file), schemas.BRAND, split=True)
        assert df.rdd.getNumPartitions() > 8
        assert rows(df) == [(i, "é" * (i % 50)) for i in range(20000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    "text",
    [
        '[{"BrandID":1,"BrandName":"a},{b"},{"BrandID":2,"BrandName":"c"}]',
        '[{"BrandID":1,"x":[{"y":1},{"y":2}]}]',
        '[{"BrandID":1,"BrandName":"x"}] trailing {{{',
        '[{"BrandID":1}] trailing',
        '[{"BrandID":1},{"BrandID":2}] [{"BrandID":3}]',
        '[{"BrandID":1}], [{"BrandID":3}]',
        '[{"BrandID":1},{"BrandID":2}] "',
    ],
)
def test_split_read_raises_where_the_cut_is_wrong(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_array(spark, str(tmp_path / "bad.json"), schemas.BRAND, split=True).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_array(spark, str(tmp_path / "bad.json"), schemas.BRAND, split=True).count()
    read_json_array(spark, str(tmp_path / "bad.json"), schemas.BRAND).collect()


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize(
    "text",
    [
        '[{"BrandID":1}, {"BrandID":2}, {"BrandID":3}]',
        '[{"BrandID":1},\n{"BrandID":2},\r\n {"BrandID":3}]\n',
        '[{"BrandID":1},{"BrandID":2}, {"BrandID":3}]',
        '[\n  { "BrandID" : 1 } ,\n\t{ "BrandID": 2},{"BrandID":3 }\n]',
        '[{"BrandID":1,"x":[1,[2]]},{"BrandID":2,"x":{"y":"]}"}},{"BrandID":3,"x":"\\"["}]',
    ],
)
def test_blanks_between_documents_lose_none(spark, tmp_path, split, text):
    (tmp_path / "spaced.json").write_text(text)
    df = read_json_array(spark, str(tmp_path / "spaced.json"), schemas.BRAND, split)
    assert [r[0] for r in rows(df)] == [1, 2, 3]
    assert df.count() == 3


@pytest.mark.parametrize("split", [False, True])
def test_a_flag_written_as_a_number_raises(spark, tmp_path, split):
    (tmp_path / "flags.json").write_text('[{"IsChillerStock":0},{"IsChillerStock":1}]')
    path = str(tmp_path / "flags.json")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_array(spark, path, "IsChillerStock BOOLEAN", split).collect()
    numbers = read_json_array(spark, path, "IsChillerStock INT", split)
    flags = numbers.select(F.col("IsChillerStock").cast("boolean"))
    assert rows(flags) == [(False,), (True,)]


def test_malformed_json_raises(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"BrandID":1')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_array(spark, str(tmp_path / "bad.json"), schemas.BRAND).collect()


def test_wrapped_ids_there_and_back(spark, tmp_path):
    plain = spark.createDataFrame(LOGISTIC, "_id STRING, name STRING")
    write_json_array(wrap_id(plain), str(tmp_path / "out"), files=1)
    texts = array_texts(tmp_path / "out")
    assert len(texts) == 1
    found = sorted(json.loads(texts[0]), key=lambda d: d["_id"]["$oid"])
    assert found == [{"_id": {"$oid": i}, "name": n} for i, n in LOGISTIC]
    stored = read_json_array(spark, str(tmp_path / "out"), schemas.LOGISTIC)
    assert stored.columns == ["_id", "name"]
    assert wrap_id(stored).schema == stored.schema
    assert rows(unwrap_id(stored)) == sorted(LOGISTIC)


@pytest.mark.parametrize("n", [10_000, 10_001])
@pytest.mark.parametrize("files", [None, 1, 3])
def test_array_files_are_as_many_as_asked_for(spark, tmp_path, n, files):
    df = spark.range(0, n, 1, 5).select(F.col("id").alias("BrandID"), F.lit("é").alias("BrandName"))
    write_json_array(df, str(tmp_path / "out"), files)
    texts = array_texts(tmp_path / "out")
    assert len(texts) == (files or 5)
    assert sum(len(json.loads(t)) for t in texts) == n
    for split in (False, True):
        read = read_json_array(spark, str(tmp_path / "out"), schemas.BRAND, split)
        assert read.columns == ["BrandID", "BrandName"]
        assert rows(read) == [(i, "é") for i in range(n)]


def test_empty_collection_is_one_empty_array(spark, tmp_path):
    for files in (None, 1):
        out = str(tmp_path / f"out{files}")
        write_json_array(spark.createDataFrame([], schemas.BRAND), out, files)
        assert array_texts(out) == ["[]"]
        assert rows(read_json_array(spark, out, schemas.BRAND)) == []


def test_delimited_file_with_header(spark, tmp_path):
    # Three of the 57 codes, among them the one with a comma.
    file = tmp_path / "codes"
    file.write_text("Code;Name\nAL;Alabama\nDC;District of Columbia\nVI;Virgin Islands, U.S.")
    df = read_delimited(spark, str(file), schemas.STATES)
    assert rows(df) == [
        ("AL", "Alabama"),
        ("DC", "District of Columbia"),
        ("VI", "Virgin Islands, U.S."),
    ]
    write_delimited(df, str(tmp_path / "again"))
    assert rows(read_delimited(spark, str(tmp_path / "again"), schemas.STATES)) == rows(df)


def test_delimited_values_come_back_as_they_are(spark, tmp_path):
    values = ["  x ", "", None, "a\nb", 'say "hi"', "a;b", "\\", " "]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], schemas.STATES)
    write_delimited(df, str(tmp_path / "out"))
    assert [tuple(r) for r in read_delimited(spark, str(tmp_path / "out"), schemas.STATES).orderBy("Code").collect()] == [
        (str(i), v) for i, v in enumerate(values)
    ]


def test_a_header_with_other_names_raises(spark, tmp_path):
    (tmp_path / "codes").write_text("Name;Code\nAlabama;AL\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path / "codes"), schemas.STATES).collect()


def test_delimited_line_that_does_not_fit_raises(spark, tmp_path):
    (tmp_path / "bad.txt").write_text("Code;Name\nAL;Alabama;more\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_delimited(spark, str(tmp_path / "bad.txt"), schemas.STATES).collect()


def test_documents_leave_out_nulls_and_keep_scale(spark):
    df = spark.createDataFrame(
        [(1, None, Decimal("2.00"), True)], "a INT, b STRING, c DECIMAL(18,2), d BOOLEAN"
    )
    text = to_documents(df, df.columns).head()[0]
    assert text == '{"a":1,"c":2.00,"d":true}'


def test_document_text_to_struct(spark):
    df = spark.createDataFrame([('{"BrandID":1,"BrandName":"N\\/A"}',)], "t STRING")
    got = df.select(from_document(F.col("t"), schemas.BRAND).alias("d")).select("d.*")
    assert rows(got) == [(1, "N/A")]


def test_exports_have_the_listed_columns_and_no_password(spark, tmp_path):
    customer = spark.createDataFrame(
        [(404, 1, 1, "c", "Nome", "email", "password", "20913", False, "2023-02-21")],
        schemas.CUSTOMER,
    )
    text = export_documents(customer, "Customer").head()[0]
    assert list(json.loads(text)) == EXPORTED["Customer"]
    assert "password" not in text.lower()
    export_array_files(customer, "Customer", str(tmp_path / "c"), files=1)
    assert [json.loads(t) for t in array_texts(tmp_path / "c")] == [[json.loads(text)]]


def test_export_has_no_raw_line_breaks(spark):
    brand = spark.createDataFrame([(1, "a\r\nb")], schemas.BRAND)
    text = export_documents(brand, "Brand").head()[0]
    assert "\r" not in text and json.loads(text)["BrandName"] == "a\r\nb"


def test_documents_as_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, "N/A"), (2, None)], schemas.BRAND)
    write_documents(df, str(tmp_path / "out"))
    assert rows(spark.read.schema(schemas.BRAND).json(str(tmp_path / "out")))[0] == (1, "N/A")


def test_strip_crlf_leaves_lone_breaks(spark):
    df = spark.createDataFrame([("a\r\nb\nc\rd\r\n",), (None,)], "t STRING")
    assert [r[0] for r in df.select(strip_crlf(F.col("t"))).collect()] == ["ab\nc\rd", None]


def test_equality_with_and_without_case(spark):
    df = spark.createDataFrame([("email",), ("EMAIL",), (None,)], "e STRING")
    assert df.where(same_text(F.col("e"), "email")).count() == 1
    assert df.where(same_text(F.col("e"), "email", ignore_case=True)).count() == 2


def test_scan_reads_listed_columns_and_pushes_the_filter(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "CAST(id AS STRING) AS e", "id AS x").write.parquet(path)
    text = plan(scan_columns(spark, path, ["id", "e"]).where(same_text(F.col("e"), "3")))
    assert "ReadSchema: struct<id:bigint,e:string>" in text
    assert "EqualTo(e,3)" in text
