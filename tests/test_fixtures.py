import tracemalloc
import zipfile

import pyarrow as pa

from tickloom.catalog import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_archives_are_written_batch_by_batch_in_order(spark, conf, tmp_path):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    ticks = fx.raw_ticks(spark, SF)
    ids = fx.write_archives(ticks, f"{tmp_path}/{{id}}/LOG.zip")
    want = {}
    for r in ticks.select("source_id", fx._log_line().alias("line"), "seq").orderBy("source_id", "seq").collect():
        want.setdefault(r["source_id"], [fx.LOG_HEADER]).append(r["line"])
    assert sorted(ids) == sorted(want)
    for file_id, lines in want.items():
        with zipfile.ZipFile(f"{tmp_path}/{file_id}/LOG.zip") as archive:
            assert archive.namelist() == ["readme.md", f"{file_id}.csv"]
            assert archive.read(f"{file_id}.csv").decode() == "\n".join(lines) + "\n"


def test_a_large_source_takes_the_memory_of_a_batch(tmp_path):
    def batches():
        for _ in range(300):
            yield pa.RecordBatch.from_arrays([pa.array([1] * 1000, pa.int32()), pa.array(["x" * 100] * 1000)], ["source_id", "line"])

    tracemalloc.start()
    try:
        ids = [b.column("file_id").to_pylist() for b in fx._write_archives(batches(), f"{(tmp_path / 'a.zip').as_uri()}")]
        assert ids == [[1]] and tracemalloc.get_traced_memory()[1] < 5_000_000
    finally:
        tracemalloc.stop()
    with zipfile.ZipFile(tmp_path / "a.zip") as archive:
        assert archive.getinfo("1.csv").file_size == 300_000 * 101 + len(fx.LOG_HEADER) + 1
