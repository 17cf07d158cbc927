"""Streaming scan (S2): a folder of files read as a stream, run once."""

import dcmwrite as W
from medframe.sources import dicom
from medframe.streaming.dicom_stream import read_stream


def test_stream_counts_every_file(spark, write_files, tmp_path):
    files = {f"series/1-{i:03d}.dcm": W.ct_slice() for i in range(79)}
    files["series/readme.txt"] = b"not dicom"
    d = write_files(files)
    df = read_stream(spark, d + "/series/*", schema=dicom.schema()).select(
        "path", "isDicom", "PatientName.Alphabetic", "StudyDate", "StudyTime")
    q = (df.writeStream.trigger(availableNow=True).format("memory").queryName("stream_dicom")
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    out = spark.table("stream_dicom")
    assert out.count() == 80
    assert out.where("isDicom").count() == 79
    assert out.where("Alphabetic = 'Pancreas-CT-CB_001' and StudyDate = '2012-07-06'").count() == 79


def test_stream_short_name(spark, write_files, tmp_path):
    from medframe.sources import register

    register.install()
    d = write_files({f"s/{i}.dcm": W.ct_slice() for i in range(5)})
    df = spark.readStream.schema(dicom.schema()).format("dicomFile").load(d + "/s").select("path", "PatientID")
    q = (df.writeStream.trigger(availableNow=True).format("memory").queryName("stream_short")
         .option("checkpointLocation", str(tmp_path / "ckpt2")).start())
    q.processAllAvailable()
    q.stop()
    assert spark.table("stream_short").count() == 5


def test_stream_header_only(spark, write_files, tmp_path):
    d = write_files({f"h/{i}.dcm": W.ct_slice(32, 32) for i in range(7)})
    df = read_stream(spark, d + "/h", columns=["PatientID", "Rows"], header_only=True)
    q = (df.writeStream.trigger(availableNow=True).format("memory").queryName("stream_hdr")
         .option("checkpointLocation", str(tmp_path / "ckpt3")).start())
    q.processAllAvailable()
    q.stop()
    rows = spark.table("stream_hdr").collect()
    assert len(rows) == 7 and all(r.Rows == [32] and r.PatientID == "Pancreas-CT-CB_001" for r in rows)


def test_stream_throttled_delivers_each_file_once(spark, write_files, tmp_path):
    d = write_files({f"t/{i}.dcm": W.ct_slice() for i in range(9)})
    df = read_stream(spark, d + "/t", columns=["path", "PatientID"], max_files_per_trigger=2)
    q = (df.writeStream.trigger(availableNow=True).format("memory").queryName("stream_thr")
         .option("checkpointLocation", str(tmp_path / "ckpt4")).start())
    q.processAllAvailable()
    batches = len(q.recentProgress)
    q.stop()
    out = spark.table("stream_thr")
    assert out.count() == 9 and out.select("path").distinct().count() == 9
    assert batches >= 5  # two files per trigger


def test_stream_lists_and_reads_many_files_in_few_tasks(spark, write_files, tmp_path):
    most = 8 * spark.sparkContext.defaultParallelism
    n = most + 20
    d = write_files({f"m/{i}.dcm": W.ct_slice(2, 2) for i in range(n)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1b")  # a split per file
    try:
        q = (read_stream(spark, d + "/m", columns=["path", "PatientID"]).writeStream.trigger(availableNow=True)
             .format("memory").queryName("stream_many").option("checkpointLocation", str(tmp_path / "ckpt5")).start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    out = spark.table("stream_many")
    assert out.count() == n and out.select("path").distinct().count() == n
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(str(q.runId)) for s in tracker.getJobInfo(j).stageIds]
    tasks = [info.numTasks for info in map(tracker.getStageInfo, stages) if info]
    assert tasks and max(tasks) <= most
