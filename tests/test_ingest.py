import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import strip_whitespace
from tallyhouse.plans.registry import QUERIES
from tallyhouse.sources import ingest
from tallyhouse.sources.seeds import country_region, read_country_region
from tallyhouse.sources.star import shop_scan
from tallyhouse.sources.tables import write_csv

LOADED_AT = dt.datetime(2020, 1, 2, 3, 4, 5)
TEXT = "invoice string, stock_code string, description string, country string"
RAW = (
    TEXT + ", quantity string, price string, invoice_date string, customer_id string,"
    " _source_sheet string"
)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def line(**given):
    values = {
        "invoice": "7031",
        "stock_code": "K-44",
        "description": "brass hook",
        "country": "Portugal",
        "quantity": "6",
        "price": "2.75",
        "invoice_date": "2013-09-18",
        "customer_id": "812",
        "_source_sheet": "first",
    }
    return tuple({**values, **given}.values())


def test_headers_of_both_spellings(spark):
    old = [" UNITPRICE", "country ", "invoiceno", "Till No"]
    new = ["price", "CUSTOMER ID", "Invoice", "stockCODE", "customerid "]
    got = [
        ingest.normalize_columns(spark.createDataFrame([tuple("abcde"[: len(h)])], h)).columns
        for h in (old, new[:4], new[2:])
    ]
    assert got == [
        ["price", "country", "invoice", "till no"],
        ["price", "customer_id", "invoice", "stock_code"],
        ["invoice", "stock_code", "customer_id"],
    ]


def test_types(spark):
    df = spark.createDataFrame(
        [
            ("77", " lamp-9 ", "desk lamp", "Chile", "12", "0.75", "2019-07-04 23:59:01", 41.0),
            ("C78", "cup", None, "Peru", "-40", "11", "2019-07-05 00:00:00", None),
        ],
        TEXT + ", quantity string, price string, invoice_date string, customer_id double",
    )
    out = ingest.coerce_types(df)
    kinds = dict(out.dtypes)
    assert (kinds["invoice_date"], kinds["quantity"], kinds["price"]) == ("timestamp_ntz", "bigint", "double")
    rows = {r.invoice: r for r in out.collect()}
    assert rows["77"].stock_code == "lamp-9" and rows["77"].customer_id == "41"
    assert (rows["77"].quantity, rows["77"].price) == (12, 0.75)
    assert rows["77"].invoice_date == dt.datetime(2019, 7, 4, 23, 59, 1)
    assert (rows["C78"].quantity, rows["C78"].price, rows["C78"].customer_id) == (-40, 11.0, None)


@pytest.mark.parametrize(
    "given, column, expected",
    [
        ({"quantity": "many"}, "quantity", None),
        ({"quantity": "6.0"}, "quantity", 6),
        ({"quantity": "6.5"}, "quantity", None),
        ({"price": "2.5d"}, "price", None),
        ({"price": "nan"}, "price", None),
        ({"price": "inf"}, "price", None),
        ({"price": "-Infinity"}, "price", None),
        ({"invoice_date": "3/13/2011 2:30"}, "invoice_date", dt.datetime(2011, 3, 13, 2, 30)),
        ({"invoice_date": "2/30/2011 2:30"}, "invoice_date", None),
        ({"price": "1e3"}, "price", 1000.0),
        ({"customer_id": "41.5"}, "customer_id", None),
        ({"customer_id": "41.0"}, "customer_id", "41"),
        ({"customer_id": ""}, "customer_id", None),
        ({"invoice_date": "7/4/2019 23:59"}, "invoice_date", dt.datetime(2019, 7, 4, 23, 59)),
        ({"invoice_date": "yesterday"}, "invoice_date", None),
        ({"country": "\t France \n"}, "country", "France"),
    ],
)
def test_bad_and_odd_values(spark, given, column, expected):
    out = ingest.coerce_types(raw(spark, line(**given))).first()
    assert out[column] == expected


def test_rejected_values_are_counted(spark):
    lines = raw(spark, line(quantity="x"), line(customer_id="1.5"), line(customer_id=None))
    assert ingest.rejected_values(lines).first().asDict() == {
        "quantity": 1,
        "price": 0,
        "invoice_date": 0,
        "customer_id": 1,
    }


def test_dedupe_removes_copies_only(spark):
    rows = [line(), line(price="2.70"), line(), line(), line(invoice="7032")]
    assert ingest.dedupe(ingest.coerce_types(raw(spark, *rows))).count() == 3


def test_dedupe_keeps_the_same_copy_in_any_order(spark):
    copies = [
        line(customer_id=None, description=d, _source_sheet=s)
        for s in ("b", "a")
        for d in ("y", "x")
    ]
    for rows in (copies, copies[::-1]):
        kept = ingest.dedupe(ingest.coerce_types(raw(spark, *rows))).collect()
        assert [(r._source_sheet, r.description) for r in kept] == [("a", "x")]


def test_many_copies_are_combined_before_the_shuffle(spark):
    plan = ingest.dedupe(ingest.coerce_types(raw(spark, line())))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("functions=[min(") < text.index("Exchange") < text.index("partial_min(")


def test_full_load_from_files(spark, tmp_path):
    old = spark.createDataFrame(
        [("1", "A", " d ", "3", "2010-01-01 10:00:00", "1.5", "7.0", "UK")] * 2,
        ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
         "Customer ID", "Country"],
    )
    new = spark.createDataFrame(
        [("C2", "B", 'a "quoted", text', "-1", "2011-01-01 10:00:00", "2", None, "EIRE")],
        "InvoiceNo string, StockCode string, Description string, Quantity string,"
        " InvoiceDate string, UnitPrice string, CustomerID string, Country string",
    )
    paths = {
        "old": write_csv(old, f"{tmp_path}/old"),
        "new": write_csv(new, f"{tmp_path}/new"),
    }
    assert ingest.load(spark, paths, f"{tmp_path}/raw", LOADED_AT).landed == 2
    rows = ingest.read_landed(spark, f"{tmp_path}/raw").orderBy("invoice").collect()
    assert rows[0].asDict() == {
        "invoice": "1",
        "stock_code": "A",
        "description": "d",
        "quantity": 3,
        "invoice_date": dt.datetime(2010, 1, 1, 10),
        "price": 1.5,
        "customer_id": "7",
        "country": "UK",
        "_source_sheet": "old",
        "_loaded_at": LOADED_AT,
    }
    assert rows[1].description == 'a "quoted", text'
    assert rows[1].customer_id is None and rows[1]._source_sheet == "new"
    # a second load replaces the first
    assert ingest.load(spark, {"old": paths["old"]}, f"{tmp_path}/raw", LOADED_AT).landed == 1
    assert ingest.read_landed(spark, f"{tmp_path}/raw").count() == 1


def test_no_time_zone_moves_a_time(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = ingest.coerce_types(raw(spark, line(invoice_date="3/13/2011 2:30"))).selectExpr("string(invoice_date)").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row[0] == "2011-03-13 02:30:00"


def test_a_load_keeps_line_breaks_and_reports(spark, tmp_path):
    rows = raw(spark, line(description='two\n"lines"'), line(price="inf"), line(price="inf"))
    path = write_csv(rows.drop("_source_sheet"), f"{tmp_path}/part")
    report = ingest.load(spark, {"part": path}, f"{tmp_path}/raw", LOADED_AT)
    assert (report.lines, report.landed, report.dropped) == ({"part": 3}, 2, 1)
    assert report.rejected == {"quantity": 0, "price": 2, "invoice_date": 0, "customer_id": 0}
    landed = {r.description: r.price for r in ingest.read_landed(spark, f"{tmp_path}/raw").collect()}
    assert landed == {'two\n"lines"': 2.75, "brass hook": None}


def test_readers_of_new_days_skip_the_rest_of_the_landing(spark, tmp_path):
    """The scan hands on the lines of the months that can hold a new day, and no others."""
    rows = [line(invoice=str(i), invoice_date=f"20{10 + i // 1200}-{i % 12 + 1:02d}-{i % 28 + 1:02d}") for i in range(2400)]
    ingest.write_raw(ingest.coerce_types(raw(spark, *rows, line(invoice_date=None))), f"{tmp_path}/raw", LOADED_AT)
    landed = ingest.read_landed(spark, f"{tmp_path}/raw")
    assert landed.count() == 2401 and landed.filter("invoice_date IS NULL").count() == 1
    new = ingest.read_landed(spark, f"{tmp_path}/raw", since=dt.date(2011, 12, 9)).select("invoice")
    assert len(new.collect()) == 100
    plan = new._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() == 100
    assert scan.metrics().apply("numPartitions").value() == 1


def test_parquet_part_and_line_breaks(spark, tmp_path):
    typed = spark.createDataFrame([("1", "two\nlines")], "Invoice string, Description string")
    typed.write.parquet(f"{tmp_path}/part.parquet")
    write_csv(typed, f"{tmp_path}/part")
    for path in ("part.parquet", "part"):
        part = ingest.read_part(spark, f"{tmp_path}/{path}", multi_line=True)
        assert part.first().Description == "two\nlines"


def test_sample_load_keeps_copies(spark, tmp_path):
    rows = raw(spark, line(), line()).drop("_source_sheet")
    path = write_csv(rows, f"{tmp_path}/sample")
    assert ingest.load_sample(spark, path, f"{tmp_path}/raw", LOADED_AT) == 2
    landed = ingest.read_landed(spark, f"{tmp_path}/raw")
    assert {r._source_sheet for r in landed.collect()} == {"sample"}


def test_parts_with_different_columns(spark):
    parts = {
        "a": spark.createDataFrame([("1", "UK")], ["Invoice", "Country"]),
        "b": spark.createDataFrame([("2",)], ["InvoiceNo"]),
    }
    rows = ingest.union_parts(parts).orderBy("invoice").collect()
    assert [(r.invoice, r.country, r._source_sheet) for r in rows] == [
        ("1", "UK", "a"),
        ("2", None, "b"),
    ]


def test_seed(spark, tmp_path):
    seed = country_region(spark)
    assert seed.count() == 43
    assert seed.select("region").distinct().count() == 12
    path = write_csv(seed, f"{tmp_path}/seed")
    assert sorted(read_country_region(spark, path).collect()) == sorted(seed.collect())


def test_one_shuffle_serves_the_dedupe_and_the_months_of_the_landing(spark):
    plan = ingest.dedupe(ingest.deal_by_time(ingest.coerce_types(raw(spark, line(), line(price="-0.0"), line(price="0.0")))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange (\w+)", text) == ["rangepartitioning"]
    assert plan.count() == 2


def test_the_landing_is_sorted_once(spark):
    dealt = ingest.deal_by_time(ingest.coerce_types(raw(spark, line(), line(price="-0.0"), line(price="0.0"))))
    written = ingest.dedupe(dealt).sortWithinPartitions(*ingest.LANDED_ORDER[:2])
    text = written._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bSort \[", text)) == 1
    assert sorted(str(r.price) for r in written.collect()) == ["0.0", "2.75"]
    # the month is told by the time and not shuffled with it
    assert text.index("AS _landed_month") < text.index("Exchange rangepartitioning")


def test_dealt_lines_keep_the_same_copy(spark):
    copies = [line(description=d, _source_sheet=s, country=c) for s in "ba" for d in ("y", None, "x") for c in ("P", " ")]
    for rows in (copies, copies[::-1]):
        dealt = ingest.deal_by_time(ingest.coerce_types(raw(spark, *rows, line(price=None), line(price=None))))
        kept = ingest.dedupe(dealt).orderBy("price").collect()
        assert [(r.price, r._source_sheet, r.description, r.country) for r in kept] == [
            (None, "first", "brass hook", "Portugal"), (2.75, "a", None, "")]


def test_lines_are_shuffled_with_what_the_parts_need_of_them(spark, small):
    join = re.search(r"Join Inner, \(l_orderkey.*?\n\s*:- (Project \[[^\n]*)", shop_scan(spark, small)._jdf.queryExecution().optimizedPlan().toString())
    columns = join[1]
    assert "AS is_free" in columns and "AS is_sent_back" in columns
    assert not re.search(r"[\[ ]l_(discount|tax|returnflag)#\d+[,\]]", columns)


def test_lines_are_not_sorted_to_meet_their_orders(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = shop_scan(spark, small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"ShuffledHashJoin \[l_orderkey#\d+L\], \[o_orderkey#\d+L\]", text)


def test_texts_are_read_as_by_a_search_for_patterns(spark):
    numbers = ["5", " 7.0 ", "5d", "5.F \t", "5d\x00", "1e3", "-Infinity", "NaN", "nan", "0x1p3", "0x1p3f", "d", "", " ", "12,50", "many", None]
    times = [
        "3/13/2011 2:30", "13/3/2011 2:30", " 03/04/2011 02:30:15 \n", "2/30/2011 1:00", "3/4/2011 25:00", "0/4/2011 1:00",
        "3/4/2011", "2011-02-30 10:00:00", "2011-03-04 10:00:00", "2011-03-04", "a/b", "", None,
    ]
    texts = ["a", "~", " a", "a ", " a ", "~a~", "\ta\n", "é ", " é", "", " ", None]

    def column(values, name):
        return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")

    suffixed = F.col("n").rlike(r"[0-9.][dDfF]\s*$")
    read = ingest._parsed_number(column(numbers, "n"), "n")
    both = column(numbers, "n").select("n", read.alias("new"), F.when(~suffixed, F.col("n").try_cast("double")).alias("old"))
    assert [r for r in both.collect() if str(r["new"]) != str(r["old"])] == []
    found = column(times, "t").orderBy("i").select(ingest._timestamp(column(times, "t"), "t").cast("string").alias("t"))
    day = "2011-03-04 "
    assert [r["t"] for r in found.collect()] == [
        "2011-03-13 02:30:00", None, day + "02:30:15", None, None, None, None, None, day + "10:00:00", day + "00:00:00", None, None, None,
    ]
    stripped = column(texts, "x").orderBy("i").select(strip_whitespace(F.col("x")).alias("x")).collect()
    assert [r["x"] for r in stripped] == [x if x is None else x.strip() for x in texts]


def test_load_report_joins_the_lines_once(spark, small, monkeypatch):
    plans, land = [], ingest.land

    def seen(raw, *more):
        plans.append(raw._jdf.queryExecution().optimizedPlan().toString())
        return land(raw, *more)

    monkeypatch.setattr(ingest, "land", seen)
    rows = QUERIES["load_report"](spark, small).collect()
    assert [r["part"] for r in rows] == ["Year A", "Year B", "Year C", "Damaged"]
    # orders, customers, nations and parts, once; each of three parts joined them before
    assert plans[0].count("Join ") == 4
