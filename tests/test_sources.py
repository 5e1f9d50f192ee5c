import datetime as dt

from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.plans import sizing
from shelfline.sources import readers as rd, sinks as sk


def test_csv_round_trip(spark, tmp_path):
    rows = [(dt.date(2020, 1, 1), 1, "LIQUOR,WINE,BEER", 2.5, 0), (dt.date(2020, 1, 2), 1, "EGGS", None, 3)]
    path = str(tmp_path / "sales")
    spark.createDataFrame(rows, schemas.SALES).write.csv(path, header=True)
    back = rd.read_sales(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(rows) and back.schema == schemas.SALES


def test_every_csv_reader(spark, tmp_path):
    samples = {
        rd.read_stores: ("store_nbr,city,state,type,cluster\n1,Quito,P,D,13\n", (1, "Quito", "P", "D", 13)),
        rd.read_holidays: ("date,type,locale,description,transferred\n2012-03-02,Holiday,Local,x,False\n",
                           ("2012-03-02", "Holiday", "Local", "x", False)),
        rd.read_oil: ("date,dcoilwtico\n2013-01-01,\n", (dt.date(2013, 1, 1), None)),
        rd.read_cpi: ("date,year,month,item_id,item_name,national_avg_price,pct_change,city,city_price\n"
                      "2019-01-01,2019,1,3,Wheat,1.5,,L,2\n",
                      (dt.date(2019, 1, 1), 2019, 1, 3, "Wheat", 1.5, None, "L", 2.0)),
    }
    for k, (reader, (text, want)) in enumerate(samples.items()):
        path = tmp_path / f"f{k}.csv"
        path.write_text(text)
        assert tuple(reader(spark, str(path)).first()) == want


def test_absent_cpi_is_empty(spark, tmp_path):
    assert rd.read_cpi(spark, str(tmp_path / "none.csv")).count() == 0


def test_first_available(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "b"))
    assert rd.read_first_available(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).count() == 3
    assert rd.read_first_available(spark, [str(tmp_path / "a")]) is None


def test_star_query_and_jdbc_options():
    text = rd.star_query()
    assert text.count("JOIN") == 3 and "f.date_key" in text
    assert sum(len(c) for c in rd.STAR_COLUMNS.values()) + 1 == 53
    options = rd.jdbc_options("jdbc:x", 20130101, 20171231, 8, driver="d")
    assert options["partitionColumn"] == "date_key" and options["numPartitions"] == "8" and options["driver"] == "d"


def test_write_panel_partitions_by_year(spark, series, tmp_path):
    panel = series({(1, "A"): list(range(800))})
    path = str(tmp_path / "panel")
    sk.write_panel(panel, path)
    back = spark.read.parquet(path)
    assert back.count() == 800 and {r.year for r in back.select("year").distinct().collect()} == {2020, 2021, 2022}
    plan = back.where("year = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    sk.write_panel(panel, str(tmp_path / "csv"), "csv")
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 800


def test_exports(spark, series, tmp_path):
    panel = series({(1, "A"): [1] * 800, (2, "A"): [1] * 800})
    stable = sk.export_subset_stable(panel, 2022)
    assert stable.where("year(date) >= 2022").count() == panel.where("year(date) >= 2022").count()
    old = stable.where("year(date) < 2022").count() / panel.where("year(date) < 2022").count()
    assert 0.1 < old < 0.2
    assert sk.export_subset_stable(panel.repartition(7), 2022).exceptAll(stable).count() == 0
    assert sk.export_subset(panel, 2022).where("year(date) >= 2022").count() == stable.where("year(date) >= 2022").count()
    folder = str(tmp_path / "r")
    sk.write_results({"one": panel}, folder)
    assert sk.export_small_results(spark, folder, str(tmp_path / "out"), ["one", "two"]) == ["two"]
    sk.export_alerts_csv(panel, str(tmp_path / "alerts"))
    sk.export_model_metrics(spark, {"MAE": 1.0, "R2": 0.5}, str(tmp_path / "m"))
    assert spark.read.csv(str(tmp_path / "m"), header=True).columns == ["MAE", "R2"]
    sk.full_reload(panel, f"{folder}/one")
    assert spark.read.parquet(f"{folder}/one").count() == 1600


def test_ensure_columns(spark):
    out = schemas.ensure_columns(spark.range(1).select(F.lit(1).alias("store_nbr")), schemas.STORES).first()
    assert out.cluster == 0 and out.city is None
    assert schemas.missing_columns(spark.range(1), ["id", "x"]) == ["x"]


def test_broadcast_only_under_the_limit(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    big = spark.range(10)
    assert sizing.is_small(dim) and not sizing.is_small(None)
    assert "ResolvedHint" in sizing.join_dim(big, dim, "id", bound=dim)._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(sizing, "BROADCAST_LIMIT_BYTES", 100)
    assert "ResolvedHint" not in sizing.join_dim(big, dim, "id", bound=dim)._jdf.queryExecution().analyzed().toString()


def test_closed_stages_leave_no_files(spark, tmp_path):
    from shelfline.plans.staging import WrittenTables

    with WrittenTables(spark, str(tmp_path)) as stage:
        assert stage(spark.range(3), "some").count() == 3 and list(tmp_path.iterdir())
    assert not list(tmp_path.iterdir())
