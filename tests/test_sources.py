import json

import pytest
from pyspark.errors import AnalysisException

from conftest import rows
from lenstrail.config import ROIS
from lenstrail.plans.full_run import run_all
from lenstrail.sources import raw_json
from lenstrail.sources.tables import cut_lineage, read_or_empty, roi_table, spread, standard_names, write_table

RECORDS = [
    {
        "id": str(i),
        "owner": {"id": f"u{i % 6}"},
        "title": f"photo {i}",
        "dateTaken": f"2010-0{1 + i % 9}-01 10:0{i % 6}:00",
        "geoData": {"latitude": ROIS[i % 9].centre[0], "longitude": ROIS[i % 9].centre[1]},
        "tags": [{"value": "Sunny"}, {"value": f"t{i}"}, {"value": "roma"}],
    }
    for i in range(90)
]


@pytest.fixture
def files(tmp_path):
    (tmp_path / "lines.json").write_text("\n\n" + "\n".join(json.dumps(r) for r in RECORDS))
    (tmp_path / "array.json").write_text("\n " + json.dumps(RECORDS, indent=2))
    (tmp_path / "dirty.json").write_text("x" + json.dumps(RECORDS[0]))
    (tmp_path / "bom.json").write_text("\ufeff" + json.dumps(RECORDS[0]))
    return tmp_path


def test_layouts(spark, files):
    got = {r.path.rsplit("/", 1)[1]: r.layout for r in raw_json.json_layout(spark, str(files)).collect()}
    assert got == {
        "lines.json": "json_lines",
        "array.json": "json_array",
        "dirty.json": "unknown",
        "bom.json": "json_lines",
    }


def test_layout_of_a_file_in_many_splits(spark, files):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    got = {r.path.rsplit("/", 1)[1]: (r.layout, r.records) for r in raw_json.json_layout(spark, str(files)).collect()}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got["lines.json"] == ("json_lines", 90)
    assert got["array.json"] == ("json_array", 90)


@pytest.mark.parametrize("layout, name", [("json_lines", "lines.json"), ("json_array", "array.json")])
def test_read_both_layouts(spark, files, layout, name):
    path = str(files / name)
    df = raw_json.read_raw(spark, path, layout=layout)
    assert df.count() == 90
    assert df.filter("id = '3'").first().owner.id == "u3"
    report = dict(rows(raw_json.schema_report(spark, path, layout=layout)))
    assert report == {
        "dateTaken": "string",
        "geoData.latitude": "double",
        "geoData.longitude": "double",
        "id": "string",
        "owner.id": "string",
        "tags[].value": "string",
        "title": "string",
    }


def test_missing_table_is_empty_but_typed(spark, tmp_path):
    df = read_or_empty(spark, str(tmp_path / "none"), "a int, b string")
    assert df.dtypes == [("a", "int"), ("b", "string")] and df.isEmpty()
    write_table(spark.range(3), str(tmp_path / "t"))
    assert read_or_empty(spark, str(tmp_path / "t"), "id bigint").count() == 3


def test_write_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "0001"), (2, "2010")], "v int, year string")
    back = write_table(df, path, partition_by=["year"])
    assert rows(back) == [(1, "0001"), (2, "2010")]
    assert write_table(df.limit(0), path, skip_empty=True) is None
    assert rows(write_table(df.limit(1), path)) == [(1, "0001")]


def test_names_and_dimension(spark):
    df = spark.createDataFrame([("A", 1, 2.0)], "roi_name string, prediction int, lat double")
    assert standard_names(df).columns == ["roi", "cluster", "latitude"]
    dim = roi_table(spark).orderBy("priority").collect()
    assert [r.roi for r in dim] == [r.name for r in ROIS]
    assert dim[0].centre_lat == (41.889 + 41.891) / 2


def test_cut_lineage_and_spread(spark):
    df = spark.range(10).repartition(1)
    assert rows(cut_lineage(df)) == [(i,) for i in range(10)]
    assert spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_full_run(spark, files, tmp_path):
    out = run_all(spark, str(files / "lines.json"), str(tmp_path / "out"), k=3)
    counts = {name: df.count() for name, df in out.items()}
    assert counts["photos_clean"] == counts["photos_enriched"] == counts["photos_time"] == 90
    assert counts["photo_clusters"] == 90
    assert counts["user_profiles"] == counts["user_transactions"] == 6
    assert counts["view_hidden_gems"] == 9
    assert rows(out["roi_tags"].select("word").distinct()) == [("sunny",)]
    assert out["photos_time"].columns[-1] == "year"
    assert out["photo_clusters"].select("cluster").distinct().count() == 3
    with pytest.raises(AnalysisException):
        run_all(spark, str(tmp_path / "nothing.json"), str(tmp_path / "out2"))
    with pytest.raises(ValueError):
        raw = raw_json.read_photos(spark, str(files / "lines.json"))
        run_all(spark, raw.drop("dateTaken"), str(tmp_path / "out3"))
