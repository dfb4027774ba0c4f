import gzip
import json
import os
import shutil
import threading
import time

import pytest
from pyspark.sql import functions as F

from lenstrail.plans import stages
from lenstrail.sources.tables import file_listing, shared_folder

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not there")


def files(spark):
    root = f"{shared_folder(spark)}/stages-{spark.sparkContext.applicationId}".removeprefix("file:")
    return sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names)


def test_changed_input_is_derived_anew_and_unchanged_input_is_not(spark, tmp_path):
    for name in stages.SOURCES:
        shutil.copy(f"{FOLDER}/{name}.parquet", tmp_path)
    folder = str(tmp_path)
    n = stages.stored(spark, folder, "raw").count()
    before = files(spark)
    assert stages.stored(spark, folder, "raw").count() == n and files(spark) == before
    half = spark.read.parquet(f"{FOLDER}/events.parquet").where("event_id % 2 = 0").toPandas()
    half["ts"] = half["ts"].astype("datetime64[us]")
    time.sleep(0.01)
    half.to_parquet(tmp_path / "events.parquet")
    assert stages.stored(spark, folder, "raw").count() == len(half) < n
    assert len(files(spark)) > len(before)


def test_one_writer(spark, tmp_path):
    calls = []

    def write(path):
        calls.append(path)
        time.sleep(0.2)
        return spark.range(1).schema

    found = []
    threads = [threading.Thread(target=lambda: found.append(stages._once(spark, str(tmp_path), "x", write)[0])) for _ in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(calls) == 1 and set(found) == set(calls)


def test_listing(spark, tmp_path):
    assert file_listing(spark, str(tmp_path / "none")) == ()
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a").write_text("xy")
    ((name, length, _),) = file_listing(spark, str(tmp_path / "d"))
    assert name.endswith("/d/a") and length == 2


def test_json_forms_are_compressed_and_arrays_hold_every_record(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stages, "RECORDS_A_FILE", 7)
    raw = spark.range(60).select(
        F.col("id").cast("string").alias("id"), F.lit("2010-01-01 00:00:00").alias("dateTaken"), F.lit("a}b").alias("title"),
        F.struct(F.lit(41.9).alias("latitude"), F.lit(12.5).alias("longitude")).alias("geoData"),
    )
    raw.union(raw.limit(3)).repartition(4).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    for form, write in stages._FORMS.items():
        write(raw, str(tmp_path / form))
        names = [os.path.join(d, f) for d, _, names in os.walk(tmp_path / form) for f in names if f.startswith("part-")]
        assert names and all(n.endswith(".gz") for n in names), form
    arrays = []
    for name in tmp_path.glob("json_array/**/part-*"):
        text = gzip.decompress(name.read_bytes()).decode()
        assert "\n" not in text
        arrays.append(json.loads(text))
    assert max(map(len, arrays)) <= 7
    want = sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in raw.collect())
    assert sorted(json.dumps(r, sort_keys=True) for a in arrays for r in a) == want
    none = str(tmp_path / "none")
    stages._write_arrays(raw.limit(0), none)
    assert spark.read.text(none).count() == 0

