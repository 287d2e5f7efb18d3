import os
import tempfile

from pyspark.sql import functions as F

from estatespark.config import LONDON
from estatespark.plans import ingest as I
from estatespark.sources import files as SF
from conftest import raw_rows


def test_area_filter_is_case_sensitive_and_untrimmed(spark):
    rows = [dict(postcode=p) for p in ["E14 5AB", "e14 5ab", "SWA 1AA", "EX1 1AA", None]]
    df = raw_rows(spark, rows).withColumnRenamed("sale_date", "date")
    kept = [r.postcode for r in I.filter_areas(df, LONDON).collect()]
    assert kept == ["E14 5AB"]


def test_yearly_csv_roundtrip_keeps_spaces_and_tags_year(spark):
    rows = [dict(postcode=" e14 5ab ", source_year=2021), dict(postcode="E14 5AB", source_year=2022,
                                                                  saon=None)]
    df = raw_rows(spark, rows).withColumnRenamed("sale_date", "date") \
        .select(*SF.RAW_COLUMNS, "source_year")
    root = tempfile.mkdtemp(prefix="csv-") + "/raw"
    SF.write_yearly_csv(df, root)
    back = SF.read_yearly_csv(spark, f"{root}/pp=*", LONDON.year_in_path_pattern)
    got = sorted((r.postcode, r.source_year, r.saon) for r in back.collect())
    assert got == [(" e14 5ab ", 2021, None), ("E14 5AB", 2022, None)]


def test_year_from_reference_file_names(spark):
    d = tempfile.mkdtemp(prefix="pp-")
    with open(os.path.join(d, "pp-2023.csv"), "w") as fh:
        fh.write('"{1}",450000,"2023-05-01 00:00","E14 5AB","F","N","L",,,,,"LONDON",'
                 '"TOWER HAMLETS","GREATER LONDON","A","A"\n')
    df = SF.read_yearly_csv(spark, f"{d}/pp-*.csv", LONDON.year_in_path_pattern)
    r = df.first()
    assert (r.source_year, r.price, r.postcode, r.saon) == (2023, 450000, "E14 5AB", None)


def test_profile_and_top_k(spark):
    rows = [dict(postcode="E1 1AA", price=10, sale_date="2021-01-02 00:00"),
            dict(postcode="E2 1AA", price=30, sale_date="2021-03-02 00:00"),
            dict(postcode="SW1 1AA", price=20, sale_date="2021-02-02 00:00")]
    df = raw_rows(spark, rows).withColumnRenamed("sale_date", "date")
    p = I.profile_summary(df).first()
    assert (p.rows, p.min_price, p.max_price, p.min_date[:10]) == (3, 10, 30, "2021-01-02")
    top = [(r.postcode_area, r.n) for r in I.top_areas(df, 1).collect()]
    assert top == [("E", 2)]


def test_streaming_ingest_matches_batch(spark):
    rows = [dict(postcode="E14 5AB", source_year=2021), dict(postcode="e14 5ab", source_year=2021),
            dict(postcode="N1 1AA", source_year=2022)]
    df = raw_rows(spark, rows).withColumnRenamed("sale_date", "date") \
        .select(*SF.RAW_COLUMNS, "source_year")
    base = tempfile.mkdtemp(prefix="stream-")
    SF.write_yearly_csv(df, f"{base}/raw")
    from estatespark.streaming.ingest import ingest_available
    ingest_available(spark, f"{base}/raw", f"{base}/silver", f"{base}/ckpt", LONDON)
    got = sorted((r.postcode, r.source_year) for r in spark.read.parquet(f"{base}/silver").collect())
    assert got == [("E14 5AB", 2021), ("N1 1AA", 2022)]
    # a rerun finds no new file and appends nothing
    ingest_available(spark, f"{base}/raw", f"{base}/silver", f"{base}/ckpt", LONDON)
    assert spark.read.parquet(f"{base}/silver").count() == 2


def test_export_headers_and_lake_totals(spark):
    df = spark.createDataFrame([(2021, 3, 1.5), (2022, 4, None)], "year int, n bigint, pct double")
    out = tempfile.mkdtemp(prefix="export-") + "/x"
    SF.export_csv(df, out)
    header = [l for l in open(next(os.path.join(out, f) for f in sorted(os.listdir(out))
                                    if f.endswith(".csv") and os.path.getsize(os.path.join(out, f))))][0]
    assert header.strip() == "YEAR,N,PCT"
    back = SF.read_export(spark, out, df)
    assert sorted(map(tuple, back.collect())) == [(2021, 3, 1.5), (2022, 4, None)]


LINE = '"{%d}",%s,"%s-05-01 00:00","E14 5AB","F","N","L",%s,,"X",,"LONDON","HACKNEY","GREATER LONDON","A","A"\n'


def yearly(tmp_path, name, *lines):
    tmp_path.mkdir(parents=True, exist_ok=True)
    (tmp_path / name).write_text("".join(lines))


def test_csv_fields_follow_rfc_4180(spark, tmp_path):
    odd = ['"FLAT ""A"", NORTH"', '"ends with \\"', '"""quoted"""', '"a, b"', "plain"]
    yearly(tmp_path, "pp-2021.csv", *[LINE % (i, 5, 2021, f) for i, f in enumerate(odd)])
    df = SF.read_yearly_csv(spark, str(tmp_path), LONDON.year_in_path_pattern)
    expected = ['FLAT "A", NORTH', "ends with \\", '"quoted"', "a, b", "plain"]
    assert [r.paon for r in df.orderBy("transaction_id").collect()] == expected
    assert {(r.saon, r.street, r.district) for r in df.collect()} == {(None, "X", "HACKNEY")}
    out = str(tmp_path / "out")
    SF.write_yearly_csv(df, out)
    back = SF.read_yearly_csv(spark, f"{out}/pp=*", LONDON.year_in_path_pattern)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    export = str(tmp_path / "export")
    SF.export_csv(df, export)
    assert sorted(map(str, map(tuple, SF.read_export(spark, export, df).collect()))) == sorted(map(str, map(tuple, df.collect())))


def test_malformed_lines_are_counted(spark, tmp_path):
    yearly(tmp_path, "pp-2021.csv", LINE % (1, 5, 2021, ""), LINE % (2, "n/a", 2021, ""), "too,few\n")
    yearly(tmp_path, "pp-2022.csv", LINE % (3, 5, 2022, ""))
    got = SF.malformed_rows(spark, str(tmp_path), LONDON.year_in_path_pattern).collect()
    assert sorted(map(tuple, got)) == [(2021, 3, 1, 2), (2022, 1, 1, 0)]


def test_line_breaks_in_fields_on_request(spark, tmp_path):
    yearly(tmp_path, "pp-2021.csv", LINE % (1, 5, 2021, '"two\nlines"'))
    df = SF.read_yearly_csv(spark, str(tmp_path), LONDON.year_in_path_pattern, multi_line=True)
    assert [r.paon for r in df.collect()] == ["two\nlines"]


def test_year_is_that_of_the_file_not_of_its_path(spark, tmp_path):
    yearly(tmp_path / "pp-1999-archive", "pp-2021.csv", LINE % (1, 5, 2021, ""))
    yearly(tmp_path / "pp-1999-archive" / "pp=2015", "part-0.csv", LINE % (2, 5, 2015, ""))
    yearly(tmp_path / "pp-1999-archive" / "loose", "part-0.csv", LINE % (3, 5, 2015, ""))
    paths = [str(tmp_path / "pp-1999-archive" / x) for x in ("pp-2021.csv", "pp=2015", "loose")]
    df = SF.read_yearly_csv(spark, paths, LONDON.year_in_path_pattern)
    assert sorted((r.transaction_id, r.source_year) for r in df.collect()) == [("{1}", 2021), ("{2}", 2015), ("{3}", None)]


def test_union_of_batches_has_every_year(spark):
    years = [1999, 2015, None, 2000, 2015]
    rows = raw_rows(spark, [dict(postcode="E1 1AA", source_year=y) for y in years])
    odd = F.col("source_year") % 2 == 1
    batches = [rows.where(~odd), rows.where(odd), rows.where(F.col("source_year").isNull())]
    got = {r.source_year: r.rows for r in I.rows_per_year(I.union_years(batches)).collect()}
    assert got == {1999: 1, 2015: 2, 2000: 1, None: 1}


def test_rebuild_drops_old_years_under_dynamic_mode(spark, tmp_path):
    df = raw_rows(spark, [dict(source_year=y) for y in (2021, 2022)]).withColumnRenamed("sale_date", "date") \
        .select(*SF.RAW_COLUMNS, "source_year")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for write in (SF.write_silver, lambda x, to: SF.write_yearly_csv(x, to)):
            to = str(tmp_path / str(id(write)))
            write(df, to)
            write(df.where("source_year = 2022"), to)
            assert len([p for p in os.listdir(to) if "=" in p]) == 1
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_lake_inventory_lists_files(spark, tmp_path):
    yearly(tmp_path, "pp-2021.csv", "x" * 100)
    yearly(tmp_path, "pp-2022.csv", "x" * 1_048_576)
    assert sorted(r.size_bytes for r in SF.lake_inventory(spark, str(tmp_path)).collect()) == [100, 1_048_576]
    got = SF.lake_totals(spark, str(tmp_path), LONDON.year_in_path_pattern).collect()
    assert {(r.source_year, r.is_total, r.size_bytes, r.size_mb) for r in got} == {
        (2021, False, 100, 0.0), (2022, False, 1_048_576, 1.0), (None, True, 1_048_676, 1.0)}


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    import pytest
    from estatespark import session as S

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()
    monkeypatch.setattr(S, "_context", lambda s: None)
    monkeypatch.setattr(S, "app_id", lambda s: "app-of-this-test")
    with pytest.raises(ValueError):
        S.shared_dir(Session())
