"""Plan properties the design relies on (checked on physical plans)."""

import dcmwrite as W
from medframe.operators import deid
from medframe.plans.parallel import spread, target_partitions
from medframe.sources import dicom


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_has_no_exchange_and_reads_no_bytes_header_only(spark, write_files):
    d = write_files({f"{i}.dcm": W.ct_slice() for i in range(3)})
    df = dicom.read(spark, d, columns=["PatientID", "StudyDate"], where="length > 10", header_only=True)
    plan = _plan(df)
    assert "Exchange" not in plan and "MapInArrow" in plan
    assert "ReadSchema: struct<path:string,length:bigint>" in plan
    assert "GreaterThan(length,10)" in plan


def test_content_scan_has_no_exchange(spark, write_files):
    d = write_files({"a.dcm": W.ct_slice()})
    plan = _plan(dicom.read(spark, d, columns=["PatientID"], header_only=False))
    assert "Exchange" not in plan and "content" in plan


def test_deidentify_is_one_projection(spark, write_files):
    d = write_files({"a.dcm": W.ct_slice()})
    scanned = dicom.read(spark, d, columns=["PatientName", "StudyDate", "Modality"])
    before, after = _plan(scanned), _plan(deid.deidentify(scanned))
    assert after.count("MapInArrow") == before.count("MapInArrow") == 1
    assert "Exchange" not in after and "Join" not in after


def test_spread_only_when_under_partitioned(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == target_partitions(one)
    many = spark.range(0, 1000, numPartitions=target_partitions(one))
    assert spread(many).rdd.getNumPartitions() == many.rdd.getNumPartitions()
    assert "Exchange" not in _plan(spread(many))
