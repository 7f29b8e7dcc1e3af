import csv
import random
import datetime as dt

import pytest
from pyspark.sql import functions as F

from stallbook import RetailConfig
from stallbook.checks import cleaning as checks
from stallbook.operators import rows
from stallbook.plans import cleaning
from stallbook.schemas import (
    BALANCE_FILE,
    FILES,
    LEDGER_FILE,
    MOVEMENT_FILE,
    PURCHASE_REPORT,
    RETURNS_FILE,
    SALES_FILE,
    schema_for,
)
from stallbook.sources import inference, metrics, readers, records, writers
from stallbook.sources.catalog import Tables

CFG = RetailConfig()


def csv_file(folder, names, *lines, header=None, preamble=()):
    """A CSV file whose header texts differ from the column names."""
    header = header or [f"Col {i}" for i in range(len(names))]
    out = [*preamble, ",".join(header)]
    for line in lines:
        out.append(",".join(str(line.get(n, "")) for n in names))
    path = folder / "file.csv"
    path.write_text("\n".join(out) + "\n")
    return str(path)


SALE = dict(
    company_name="A", voucher_type="Sales", voucher_date="05-02-2026 10:15:00", voucher_no="v1",
    particulars="Someone", stock_no="0012", product="saree", brand=" ab ", retail_price="100",
    sales_qty="2", net_amount="150",
)


def test_file_widths():
    assert [len(FILES[t]) for t in ("sales", "sales_returns", "stock_balance", "stock_movement")] == [
        18, 17, 19, 22,
    ]


def test_clean_sales(spark, tmp_path):
    path = csv_file(
        tmp_path, SALES_FILE,
        SALE,
        SALE | {"company_name": '" A "', "voucher_type": "B2B Sale", "net_amount": "0.125"},
        SALE | {"company_name": "a"},
        SALE | {"stock_no": ""},
        SALE | {"stock_no": "NA"},
        SALE | {"voucher_no": "v6", "sales_qty": "0"},
    )
    out = cleaning.clean_sales(readers.read_csv(spark, path, SALES_FILE), CFG).collect()
    assert len(out) == 3
    first, b2b, zero = out
    assert (first.company_name, first.stock_no, first.product, first.brand) == ("A", "0012", "SAREE", "AB")
    assert (first.full_mrp_value, first.discount_given, first.discount_pct) == (200, 50, 25)
    assert first.sale_date == dt.date(2026, 2, 5) and first.sale_month_name == "Feb"
    assert first.sale_dow == "Thursday" and first.customer_ref == "Someone"
    assert b2b.company_name == "A" and b2b.is_b2b and b2b.line_revenue == 0.12
    assert not first.is_b2b and zero.discount_pct is None


def test_bad_sales_date_fails(spark, tmp_path):
    path = csv_file(tmp_path, SALES_FILE, SALE | {"voucher_date": "xx"})
    with pytest.raises(Exception, match="not a date"):
        cleaning.clean_sales(readers.read_csv(spark, path, SALES_FILE), CFG).collect()


def test_clean_returns(spark, tmp_path):
    line = dict(
        company_name="B", voucher_date="1/3/2026", stock_no="s", return_qty="0", net_amount="10",
        voucher_type="sales return",
    )
    path = csv_file(
        tmp_path, RETURNS_FILE,
        line, line | {"return_qty": "3", "particulars": "C"}, line | {"particulars": " "},
    )
    out = cleaning.clean_sales_returns(readers.read_csv(spark, path, RETURNS_FILE), CFG).collect()
    assert [r.return_value_per_unit for r in out] == [None, 3.33, None]
    assert [r.has_customer_name for r in out] == [False, True, True]
    assert out[0].return_date == dt.date(2026, 3, 1) and out[0].voucher_type == "SALES RETURN"


def test_clean_balance(spark, tmp_path):
    line = dict(
        company_name="A", stock_no="s", hsn_code="6109.0", cost_price="60", retail_price="100",
        closing_qty="2", closing_value="120.125", item_type="goods",
    )
    path = csv_file(
        tmp_path, BALANCE_FILE,
        line, line | {"closing_qty": "0"}, line | {"closing_qty": "-1"},
        line | {"hsn_code": "0610900", "retail_price": "0"}, line | {"company_name": "Z"},
    )
    out = cleaning.clean_stock_balance(readers.read_csv(spark, path, BALANCE_FILE), CFG).collect()
    assert [r.hsn_code for r in out] == ["6109", "0610900"]
    assert [r.margin_pct for r in out] == [40.0, None]
    assert (out[0].retail_value, out[0].capital_locked, out[0].item_type) == (200, 120.12, "GOODS")


def test_clean_movement(spark, tmp_path):
    line = dict(
        company_name="A", stock_no="s", inwards_qty="10", outwards_qty="4", closing_qty="6",
        closing_val="60", cost_price="5", retail_price="0",
    )
    path = csv_file(tmp_path, MOVEMENT_FILE, line, line | {"inwards_qty": "0", "outwards_qty": "0"})
    out = cleaning.clean_stock_movement(readers.read_csv(spark, path, MOVEMENT_FILE), CFG).collect()
    assert [r.sell_through_pct for r in out] == [40.0, None]
    assert [r.movement_status for r in out] == ["Partially sold", "Other"]
    assert out[0].margin_pct is None and out[0].capital_locked == 60


VOUCHER = dict(
    company_name="A", city="c", voucher_date="05-02-2026 10:15:00", voucher_no="1",
    voucher_type="Sales", particulars="cash", debit_amount="100", credit_amount="",
)


def ledger(spark, tmp_path, *lines):
    header = [f" {n.replace('_', ' ').title()} " for n in LEDGER_FILE]
    path = csv_file(tmp_path, LEDGER_FILE, *lines, header=header)
    return readers.read_csv_by_header(spark, path)


def test_ledger_rows_kept_and_dropped(spark, tmp_path):
    file = ledger(
        spark, tmp_path,
        VOUCHER,
        VOUCHER | {"company_name": "  "},
        VOUCHER | {"company_name": ""},
        VOUCHER | {"particulars": "sub total"},
        VOUCHER | {"voucher_type": "Sales (VOID)"},
        VOUCHER | {"voucher_type": "Stock Journal"},
        VOUCHER | {"voucher_type": '"Stock Journal "', "voucher_no": "padded"},
        VOUCHER | {"voucher_type": "", "voucher_no": "untyped"},
        VOUCHER | {"voucher_date": "xx"},
    )
    out = cleaning.clean_ledger(file, CFG).collect()
    assert [r.voucher_no for r in out] == ["1", "padded", "untyped"]
    assert [r.voucher_type for r in out] == ["Sales", "Stock Journal", ""]
    counts = {r.step: r.rows for r in metrics.step_counts(file, cleaning.ledger_drops(CFG)).collect()}
    assert counts == {
        "raw": 9, "no_branch": 7, "sub_total": 6, "void": 5, "not_financial": 4, "no_date": 3,
    }
    watched, seen = metrics.with_counts(file, cleaning.ledger_drops(CFG))
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get == counts


def test_ledger_amounts(spark, tmp_path):
    def voucher(kind, debit, credit):
        return VOUCHER | {"voucher_type": kind, "debit_amount": debit, "credit_amount": credit}

    file = ledger(
        spark, tmp_path,
        voucher("Retail Credit Note", "", "40"),
        voucher("Journal", "9", ""),
        voucher("Payment", "30", "7"),
        voucher("Transfer In", "1", "2"),
        voucher("Sales", "abc", "5"),
        VOUCHER | {"company_name": "HO"},
        VOUCHER | {"company_name": "A-old"},
    )
    out = cleaning.clean_ledger(file, CFG).collect()
    assert [(r.voucher_type, r.amount) for r in out[:5]] == [
        ("Sales Return", 40), ("Journal", 0), ("Payment", 30), ("Transfer In", 2), ("Sales", 0),
    ]
    assert [(r.branch_type, r.is_active) for r in out[4:]] == [
        ("Active Branch", True), ("Head Office", False), ("Inactive", False),
    ]
    assert out[0].particulars == "CASH" and out[0].narration == ""


def test_report_with_header_on_row_five(spark, tmp_path):
    header = [n.replace("_", " ").title() for n in PURCHASE_REPORT]
    commas = "," * (len(PURCHASE_REPORT) - 1)
    line = dict(
        company_name="HO", stock_no="s1", item_description="x", voucher_date="2026-02-05",
        purchase_qty="2.5", item_rate="10.5",
    )
    path = csv_file(
        tmp_path, PURCHASE_REPORT, line, line | {"voucher_date": "xx", "stock_no": "s2"},
        dict(stock_no="total", purchase_qty="9", item_rate="1", item_description="y"),
        header=header, preamble=["Purchase Report" + commas, "HO" + commas, commas, "2026" + commas],
    )
    out = cleaning.clean_purchase(readers.read_report(spark, path, PURCHASE_REPORT))
    assert [(r.stock_no, r.voucher_date, r.purchase_qty) for r in out.orderBy("stock_no").collect()] == [
        ("s1", dt.date(2026, 2, 5), 2.5), ("s2", None, 2.5),
    ]


def test_report_columns_by_name_and_titles_of_many_cells(spark, tmp_path):
    names = ["company_name", "stock_no", "item_description"]
    top = "Branch,Period,Jan\nA,B,C\n,,\n2026,x,y\n"
    (tmp_path / "one.csv").write_text(
        top + 'Item Description,Stock No,Extra,Company Name\n"two\nlines",s1,9,HO\nx,s2,,HO\nx,s3,1,\n'
    )
    (tmp_path / "two.csv").write_text(top + "Company Name,Stock No,Item Description\nA,s4,\n")
    out = readers.read_report(spark, str(tmp_path / "*.csv"), names)
    assert sorted(map(tuple, out.collect())) == [
        ("A", "s4", None), ("HO", "s1", "two\nlines"), ("HO", "s2", "x"),
    ]
    (tmp_path / "two.csv").write_text(top + "Company Name,Item Description\nA,z\n")
    with pytest.raises(Exception, match="no column stock_no in row 5"):
        readers.read_report(spark, str(tmp_path / "*.csv"), names).collect()


def test_line_breaks_in_cells_fail_or_are_read_whole(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('a,b,c\n1,"x\ny",3\n4,"say ""hi""",6\n')
    names = ["k", "t", "n"]
    out = readers.read_csv(spark, str(path), names, multi_line=True)
    assert [tuple(r) for r in out.collect()] == [("1", "x\ny", "3"), ("4", 'say "hi"', "6")]
    with pytest.raises(Exception, match="record of another width"):
        readers.read_csv(spark, str(path), names).select("k").collect()
    assert [r.records for r in readers.broken_records(spark, str(path), names).collect()] == [2]


def test_width_is_checked_in_every_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="expected 3 columns, file has 2"):
        readers.read_csv(spark, str(tmp_path / "a.csv"), ["x", "y", "z"])
    (tmp_path / "b.csv").write_text("a,b,c\n1,2,3\n")
    with pytest.raises(Exception, match="record of another width|expected 2 columns"):
        readers.read_csv(spark, str(tmp_path), ["x", "y"]).collect()
    both = readers.broken_records(spark, str(tmp_path), ["x", "y"]).collect()
    assert [(r._file.rsplit("/")[-1], r.records) for r in both] == [("b.csv", 1)]


def test_positional_names_check_the_width(frame):
    df = frame("a string, b string", {"a": "1", "b": "2"})
    assert rows.apply_positional(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError, match="expected 3 columns"):
        rows.apply_positional(df, ["x", "y", "z"])


def test_exclusion_keeps_null_but_keep_drops_it(frame):
    df = frame("c string", {"c": "x"}, {"c": "y"}, {"c": None})
    assert [r.c for r in rows.exclude_values(df, "c", ["x"]).collect()] == ["y", None]
    assert [r.c for r in rows.keep_values(df, "c", ["x"]).collect()] == ["x"]
    assert rows.drop_blank(frame("c string", {"c": " "}, {"c": None}, {"c": "a"}), "c").count() == 1


def test_typed_rounds_to_integers(frame):
    df = frame("company_name string, sale_year double", {"sale_year": 2.5}, {"sale_year": 3.5})
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("sale_year", T.LongType())])
    assert [r.sale_year for r in rows.typed(df, schema).collect()] == [3, 4]


def test_load_and_read_back(spark, tmp_path):
    path = csv_file(tmp_path, SALES_FILE, SALE, SALE | {"voucher_date": "05-03-2026"})
    clean = cleaning.clean_sales(readers.read_csv(spark, path, SALES_FILE), CFG)
    report = writers.load_all({"sales": clean}, str(tmp_path / "raw"))
    assert report == {"sales": {"rows_written": 2, "rows_loaded": 2}}
    again = writers.load_all({"sales": clean}, str(tmp_path / "raw"))  # full refresh, no append
    assert again == report
    tables = Tables.load(spark, str(tmp_path / "raw"), ("sales",))
    tables.register()
    assert spark.sql("select count(*) as n from raw_sales where sale_month = 3").first().n == 1
    stored = rows.typed(tables["sales"], schema_for("sales"))
    assert stored.schema == schema_for("sales")


def test_catalog_table_is_replaced(spark, frame):
    writers.ensure_namespace(spark, "retail_test")
    writers.ensure_namespace(spark, "retail_test")
    df = frame("k string, v bigint", {"k": "a", "v": 1}, {"k": "b", "v": 2})
    for _ in range(2):
        writers.load_table(df, "retail_test.t", bucket_by=(2, ["k"]))
    assert spark.table("retail_test.t").count() == 2
    broken = df.withColumn("v", F.when(F.col("k") == "b", F.raise_error(F.lit("died")).cast("long")).otherwise(0))
    for _ in range(2):
        with pytest.raises(Exception, match="died"):
            writers.load_table(broken, "retail_test.t", bucket_by=(2, ["k"]))
        assert sorted(r.v for r in spark.table("retail_test.t").collect()) == [1, 2]
    begun = spark.table("retail_test.t")
    writers.load_table(df.limit(1), "retail_test.t", partition_by=["k"])
    assert begun.count() == 2 and spark.table("retail_test.t").count() == 1
    assert len([t for t in spark.catalog.listTables("retail_test") if "__" in t.name]) == 2
    df.write.saveAsTable("retail_test.plain")
    writers.load_table(df.limit(1), "retail_test.plain")
    assert spark.table("retail_test.plain").count() == 1
    spark.sql("drop database retail_test cascade")


def test_a_folder_keeps_its_rows_when_a_load_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    writers.save_table(spark.range(5), path)
    fails = F.when(F.col("id") == 3, F.raise_error(F.lit("died")).cast("long")).otherwise(F.col("id"))
    with pytest.raises(Exception, match="died"):
        writers.save_table(spark.range(4).select(fails.alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    # it dies between the two renames: the next load finds the old rows again
    rename = writers.files.rename
    with monkeypatch.context() as m:
        def once(spark, a, b):
            if "_new-" in a:
                raise RuntimeError("died")
            rename(spark, a, b)

        m.setattr(writers.files, "rename", once)
        with pytest.raises(RuntimeError):
            writers.save_table(spark.range(7), path)
    with pytest.raises(Exception, match="died"):
        writers.save_table(spark.range(4).select(fails.alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    writers.save_table(spark.range(6), path)
    assert spark.read.parquet(path).count() == 6


def test_types_are_the_narrowest_that_all_cells_fit(spark):
    cells = {
        "flag": ["true", "FALSE", None], "whole": ["1", "-20", " 3 "], "code": ["007", "1", "2"],
        "number": ["1", "2.5", "-1e3"], "day": ["2026-02-28", "2024-02-29", ""],
        "no_day": ["2026-02-30", "2026-01-01", ""], "time": ["2026-01-01", "2026-01-01 10:15:00", None],
        "mixed": ["1", "2026-01-01", None], "none": [None, "", " "], "long": ["1234567890123456789012", "1", "2"],
        "dot": [".", "1", "2"], "a b": ["x", "1", "true"],
    }
    schema = ", ".join(f"`{c}` string" for c in cells)
    df = spark.createDataFrame(list(zip(*cells.values())), schema)
    assert inference.infer_types(df) == {
        "flag": "boolean", "whole": "bigint", "code": "string", "number": "double", "day": "date",
        "no_day": "string", "time": "timestamp", "mixed": "string", "none": "string", "long": "double",
        "dot": "string", "a b": "string",
    }
    row = inference.typed(df).collect()[2]
    assert (row.whole, row.number, row.day, row.code) == (3, -1000.0, None, "2")
    empty = spark.createDataFrame([], df.schema)
    assert set(inference.infer_types(empty).values()) == {"string"}


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_quoted_line_breaks_at_split_borders(spark, tmp_path):
    """Equal to a reader that takes each file as a whole, whatever cells cross."""
    rng = random.Random(11)
    cells = ["", "x", "a,b", 'say "hi"', "two\nlines", "\n", 'q"\n"', "long " * 40, "l\n" * 60, " s ", "é日\n本"]
    expected = []
    for f in range(3):
        rows = [[f"{f}-{i}", rng.choice(cells), rng.choice(cells)] for i in range(120)]
        with open(tmp_path / f"f {f}%.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator="\r\n" if f == 1 else "\n")
            writer.writerows([["k", "t", "n"], *rows])
            out.write("" if f else "\n\n")
        with open(tmp_path / f"f {f}%.csv", newline="") as back:
            expected += [tuple(c or None for c in r) for r in list(csv.reader(back))[1:] if r]
    df = readers.read_csv(spark, str(tmp_path / "*.csv"), ["k", "t", "n"], True, split_bytes=64)
    key = lambda r: tuple(c or "" for c in r)
    assert records._lines(spark, str(tmp_path / "*.csv"), 64).rdd.getNumPartitions() > 20
    # another size of splits in the session, set between the passes, changes nothing
    spark.conf.set("spark.sql.files.maxPartitionBytes", "777")
    try:
        assert sorted(map(tuple, df.collect()), key=key) == sorted(expected, key=key)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_quote_that_is_never_closed_fails(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('a,b\n1,"x\ny,2\n3,4\n')
    assert [r.value for r in records.records(spark, str(path)).collect()] == ['1,"x\ny,2\n3,4\n'.strip()]
    with pytest.raises(Exception, match="record of another width"):
        readers.read_csv(spark, str(path), ["k", "t"], multi_line=True).collect()


@pytest.mark.parametrize("multi_line", [False, True])
def test_every_file_has_its_own_header(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b c.csv").write_text(" Y ,X\n3,4\n")
    df = readers.read_csv_by_header(spark, str(tmp_path), multi_line=multi_line)
    assert df.columns == ["x", "y"] and _rows(df) == [("1", "2"), ("4", "3")]
    (tmp_path / "d.csv").write_text("x,z\n5,6\n")
    with pytest.raises(ValueError, match="d.csv: has columns"):
        readers.read_csv_by_header(spark, str(tmp_path), multi_line=multi_line)
    with pytest.raises(ValueError, match="expected 3 columns, file has 2"):
        readers.read_csv(spark, str(tmp_path), ["p", "q", "r"], multi_line=multi_line)


def test_reports_of_any_width_split_over_tasks(spark, tmp_path):
    names = ["company_name", "stock_no"]
    for f, width in (("one", 200), ("two", 150)):
        header = [f"Col {i}" for i in range(width)]
        header[width - 3], header[width - 1] = "Stock No", "Company Name"
        if f == "two":
            header.reverse()
        place = {h: i for i, h in enumerate(header)}
        lines = [["T"], [], ["P", "x"], header]
        for i in range(30):
            row = [f"{i}\nz" if j % 50 == 0 else "" for j in range(width)]
            row[place["Company Name"]], row[place["Stock No"]] = f, f"s{i}"
            lines.append(row)
        with open(tmp_path / f"{f}.csv", "w", newline="") as out:
            csv.writer(out, lineterminator="\n").writerows(lines)
    # a header has to fit into the first split
    df = readers.read_report(spark, str(tmp_path / "*.csv"), names, header_row=3, split_bytes=4096)
    assert _rows(df) == sorted((f, f"s{i}") for f in ("one", "two") for i in range(30))


def test_a_header_beyond_the_first_split_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("T\n" + "x" * 100 + "\n" + "y" * 100 + "\nk\n1\n")
    with pytest.raises(Exception, match="end beyond the first split"):
        readers.read_report(spark, str(tmp_path / "a.csv"), ["k"], anchor="k", header_row=4, split_bytes=64).collect()


def test_small_splits_share_tasks(spark, tmp_path):
    """A thousand splits are no thousand tasks, and a record is parsed once."""
    path = tmp_path / "a.csv"
    path.write_text("k,t\n" + "".join(f'"{i}","two\nlines"\n' for i in range(2000)))
    assert records._lines(spark, str(path), 32).rdd.getNumPartitions() > 1000
    texts = records.records(spark, str(path), split_bytes=32)
    # whole records and joined pieces
    assert texts.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism + 4
    df = readers.read_csv(spark, str(path), ["k", "t"], True, split_bytes=32)
    assert _rows(df) == sorted((str(i), "two\nlines") for i in range(2000))
    plan = df.where("k > '1' and t <> ''")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv(") == 1


def test_rows_of_a_landed_file_are_made_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).selectExpr("'A' as name", "id").mapInArrow(count, "name string, id long")
    checks._land(df, "name", ["name,id"], str(tmp_path / "out"))
    assert seen.value == 100
    assert spark.read.text(str(tmp_path / "out")).count() == 101


def test_reports_of_stock_share_their_totals(spark, monkeypatch):
    made = []
    totals = checks.b.movement_totals
    monkeypatch.setattr(checks.b, "movement_totals", lambda *a: made.append(1) or totals(*a))
    checks.report_stock_scan(spark, "/root/testdata/sf0.001")
    assert len(made) == 1


@pytest.mark.parametrize("most", [16, 1])
def test_orders_of_columns_without_a_join(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(records, "LAYOUTS", most)
    for f, head in (("a", "K,Company Name,N"), ("b b", "K,Company Name,N"), ("c%", "N,K,Company Name")):
        row = {"K": f"k{f}", "Company Name": f"n{f}", "N": f"{len(f)}"}
        (tmp_path / f"{f}.csv").write_text(head + "\n" + ",".join(row[h] for h in head.split(",")) + "\n")
    df = readers.read_report(spark, str(tmp_path), ["n", "company_name", "k"], header_row=1)
    assert _rows(df) == sorted((str(len(f)), f"n{f}", f"k{f}") for f in ("a", "b b", "c%"))
    assert ("Join" in df._jdf.queryExecution().executedPlan().toString()) == (most == 1)


def test_the_balance_scan_returns_whole_rows_and_branch_totals(spark):
    df = checks.csv_balance_scan(spark, "/root/testdata/sf0.001")
    whole = checks.clean_stock_balance(spark, "/root/testdata/sf0.001")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, df.select(*whole.columns).collect()), key=key) == sorted(
        map(tuple, whole.collect()), key=key
    )
    for name in {r.company_name for r in df.collect()}:
        own = [r for r in df.collect() if r.company_name == name]
        assert {(r["items"], r.codes, r.pieces) for r in own} == {
            (len(own), len({r.hsn_code for r in own}), sum(r.closing_qty for r in own))
        }


def test_each_cell_is_stripped_once_for_all_kinds(spark):
    df = spark.createDataFrame([(" 1 ", "x"), ("+2", " "), (None, "e5")], "a string, b string")
    plan = inference._fits(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == len(df.columns)
    assert inference.infer_types(df) == {"a": "bigint", "b": "string"}
    cells = ["+5", "-.5", "5.", "-", ".", "e5", "1e5", "00", "2020-02-30", "2020-02-28 10:00", "TRUE"]
    kinds = [inference.infer_types(spark.createDataFrame([(c,)], "a string"))["a"] for c in cells]
    assert kinds == ["bigint", "double", "double", "string", "string", "string", "double", "string",
                     "string", "timestamp", "boolean"]
