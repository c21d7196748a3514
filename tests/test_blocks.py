"""Files read in many blocks against the same files read whole."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerfold import schemas
from ledgerfold.sinks.files import write_json_array
from ledgerfold.sources.blocks import Malformed, read_array_blocks, read_delimited_blocks
from ledgerfold.sources.files import read_delimited, read_json_array

NESTED = (
    "_id STRING, name STRING, flag BOOLEAN, transport ARRAY<STRUCT<saleid: BIGINT, note: STRING, "
    "tags: ARRAY<STRING>, inner: ARRAY<STRUCT<a: INT>>>>"
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=[60, 1500])
def blocks(spark, request):
    """Files in blocks of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, (request.param, 1)):
        spark.conf.set(name, str(value))
    yield request.param
    for name, value in zip(names, before):
        spark.conf.set(name, value)


@pytest.fixture
def few_bytes(spark):
    """Blocks of 20 bytes."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def document(rng, i):
    awkward = ["},{", '"', "\\", '\\"', "[{", "}]", "é", "\n", "a,b", "", "{", "\\\\", ']},{"']
    transport = [
        {
            "saleid": rng.randint(0, 99),
            "note": "".join(rng.choices(awkward, k=rng.randint(0, 6))),
            "tags": rng.choices(awkward, k=rng.randint(0, 3)),
            "inner": [{"a": n} for n in range(rng.randint(0, 3))],
        }
        for _ in range(rng.randint(0, 5))
    ]
    out = {"_id": f"{i:03}", "name": rng.choice(awkward) * rng.randint(0, 4), "flag": i % 2 == 0}
    if rng.random() < 0.8:
        out["transport"] = transport
    if rng.random() < 0.2:
        out["_id" if i % 3 else "name"] = None
    return out


STYLES = [
    {"separators": (",", ":")},
    {"separators": (", ", ": "), "ensure_ascii": False},
    {"indent": 2},
    {"indent": "\t", "separators": (" ,", " : "), "ensure_ascii": False},
]


@pytest.mark.parametrize("style", range(len(STYLES)))
def test_nested_documents_equal_the_whole_read(spark, tmp_path, blocks, style):
    rng = random.Random(style)
    folder = tmp_path / "carriers"
    (folder / "below").mkdir(parents=True)
    for n, size in enumerate([4, 1, 0, 2]):
        text = json.dumps([document(rng, i) for i in range(size)], **STYLES[style])
        lead, tail = rng.choice(["", " \n"]), rng.choice(["", "\n", " \r\n\t"])
        place = folder / "below" if n % 2 else folder
        (place / f"{n}.json").write_text(lead + text + tail, encoding="utf-8")
    got = read_array_blocks(spark, str(folder), NESTED)
    want = read_json_array(spark, str(folder), NESTED)
    assert got.dtypes == want.dtypes
    assert rows(got) == rows(want) and got.count() == 7


def test_one_file_is_many_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rng = random.Random(1)
    file = tmp_path / "one.json"
    file.write_text(json.dumps([document(rng, i) for i in range(3000)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        pieces = spark.read.option("lineSep", "}").text(str(file))
        assert pieces.rdd.getNumPartitions() > 20
        assert read_array_blocks(spark, str(file), NESTED).count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_documents_much_longer_than_blocks(spark, tmp_path, blocks):
    texts = ["}" * 300, "x" * 400, '"},{"' * 60]
    docs = [{"_id": str(i), "name": t, "transport": [{"note": t}] * 2} for i, t in enumerate(texts)]
    (tmp_path / "long.json").write_text(json.dumps(docs))
    path = str(tmp_path / "long.json")
    assert rows(read_array_blocks(spark, path, NESTED)) == rows(read_json_array(spark, path, NESTED))


def test_a_compressed_file_is_one_block(spark, tmp_path, few_bytes):
    docs = [document(random.Random(4), i) for i in range(20)]
    with gzip.open(tmp_path / "c.json.gz", "wt") as file:
        json.dump(docs, file)
    path = str(tmp_path / "c.json.gz")
    assert rows(read_array_blocks(spark, path, NESTED)) == rows(read_json_array(spark, path, NESTED))


def test_reads_what_is_written(spark, tmp_path, blocks):
    docs = spark.range(0, 30, 1, 2).selectExpr(
        "CAST(id AS STRING) AS name",
        "transform(sequence(0, id % 4), i -> named_struct('saleid', id, 'shippingDate', '},{', "
        "'deliveryDate', CAST(NULL AS STRING), 'trackingNumber', CAST(i AS STRING))) AS transport",
    )
    write_json_array(docs, str(tmp_path / "out"))
    got = read_array_blocks(spark, str(tmp_path / "out"), schemas.LOGISTIC_TRANSPORT)
    assert rows(got.select("name", "transport")) == rows(docs)


@pytest.mark.parametrize(
    "text",
    [
        '[{"BrandID":1}',
        '[{"BrandID":1',
        '{"BrandID":1}',
        '[{"BrandID":1}]]',
        '[{"BrandID":1}] trailing',
        '[{"BrandID":1}] [{"BrandID":3}]',
        '[{"BrandID":1}], {"BrandID":3}',
        'x [{"BrandID":1}]',
        '[{"BrandID":1},]',
        '[{"BrandID":1},,{"BrandID":2}]',
        '[{"BrandID":1}{"BrandID":2}]',
        '[{"BrandID":1} x]',
        '[1, 2]',
        '[[{"BrandID":1}]]',
        '[{"BrandID":1, "BrandName":"open}]',
        '[{"BrandID":"text"}]',
        '[{"BrandID":1}}, {"BrandID":2}{]',
        '{[]}',
        '["a"]',
        "[,]",
    ],
)
@pytest.mark.parametrize("act", ["collect", "count"])
def test_raises_on_what_is_no_array_of_documents(spark, tmp_path, few_bytes, text, act):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        getattr(read_array_blocks(spark, str(tmp_path / "bad.json"), schemas.BRAND), act)()


@pytest.mark.parametrize("text", ["[]", " [ ]\n", "[\n]"])
def test_arrays_without_documents(spark, tmp_path, text):
    (tmp_path / "none.json").write_text(text)
    assert rows(read_array_blocks(spark, str(tmp_path / "none.json"), schemas.BRAND)) == []


TABLE = "Code STRING, Name STRING, `Not e` STRING, Size INT"


def delimited(rng, n, line_end):
    awkward = ["", "a", "é;", 'say "x"', "two\nlines", "\n", "crlf\r\nin", " blanks ", "Côte d'Ivoire, x"]

    def value():
        text = "".join(rng.choices(awkward, k=rng.randint(0, 3)))
        if any(c in text for c in ';"\n\r') or rng.random() < 0.3:
            return '"' + text.replace('"', '""') + '"'
        return text

    lines = ["Code;name;Not e;Size"]
    for i in range(n):
        lines.append(f"{i};{value()};{value()};{rng.choice(['', str(i)])}")
        if rng.random() < 0.1:
            lines.append("")
    return line_end.join(lines)


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_delimited_equals_the_whole_read(spark, tmp_path, blocks, line_end):
    rng = random.Random(blocks)
    folder = tmp_path / "states"
    folder.mkdir()
    for n, size in enumerate([20, 0, 3]):
        text = delimited(rng, size, line_end) + rng.choice(["", line_end])
        (folder / f"{n}.csv").write_bytes(text.encode())
    got = read_delimited_blocks(spark, str(folder), TABLE)
    want = read_delimited(spark, str(folder), TABLE)
    assert got.dtypes == want.dtypes
    # The whole read takes line breaks in values for plain ones where lines end in CR and LF.
    plain = {c: F.replace(c, F.lit("\r\n"), F.lit("\n")) for c in ("Name", "`Not e`")}
    plain = {k.strip("`"): v for k, v in plain.items()}
    assert rows(got.withColumns(plain)) == rows(want.withColumns(plain)) and got.count() == 23


def test_delimited_without_header(spark, tmp_path, blocks):
    (tmp_path / "t.csv").write_text('1,"a\n\nb"\n2,c\n\n3,""\n4,\n')
    got = read_delimited_blocks(spark, str(tmp_path / "t.csv"), "a INT, b STRING", ",", header=False)
    assert rows(got) == [(1, "a\n\nb"), (2, "c"), (3, ""), (4, None)]


@pytest.mark.parametrize(
    "text",
    [
        "Code;Name;Not e;Size\n1;a;b",
        "Code;Name;Not e;Size\n1;a;b;c",
        "Code;Nam;Not e;Size\n1;a;b;1",
        "Code;Name;Not e\n1;a;b;1",
        'Code;Name;Not e;Size\n1;"a;b;1\n',
        'Code;Name;Not e;Size\n1;5" pipe;b;1\n2;6" pipe;b;1',
        'Code;Name;Not e;Size\n1;"a"x;b;1',
    ],
)
@pytest.mark.parametrize("act", ["collect", "count"])
def test_delimited_raises(spark, tmp_path, few_bytes, text, act):
    (tmp_path / "bad.csv").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        getattr(read_delimited_blocks(spark, str(tmp_path / "bad.csv"), TABLE), act)()


def test_errors_of_whole_files_are_raised_at_once(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"BrandID":1}')
    with pytest.raises(Malformed):
        read_array_blocks(spark, str(tmp_path / "bad.json"), schemas.BRAND)
