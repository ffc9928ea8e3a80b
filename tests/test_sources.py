import io
import os
import random
import subprocess
import sys
import zipfile

import pyarrow as pa
import pytest
from conftest import as_set, plan_of
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tickloom.schemas import TICK, TICK_COLUMNS
from tickloom.sources import read_tick_csv, read_tick_zips, split_bad_rows, text, tick_paths, zips

HEADER = ",".join(TICK_COLUMNS)


def archive(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    return str(path)


def log(*lines, header=HEADER):
    return "\n".join([header, *lines]) + "\n"


GOOD = "A,F,20251201,090000,10.5,3"


@pytest.mark.parametrize("known", [True, False])
def test_first_csv_or_txt_member_is_read(spark, tmp_path, known):
    archive(tmp_path / "6076.zip", {"readme.md": "x", "T.csv": log(GOOD), "U.csv": log("B,F,20251201,1,1,1")})
    archive(tmp_path / "6077.zip", {"T.txt": log("C,F,20251202,000059,2,4")})
    columns = list(TICK_COLUMNS) if known else None
    good, bad = split_bad_rows(read_tick_zips(spark, f"{tmp_path}/*.zip", columns))
    assert good.schema.names == TICK.names
    assert as_set(good) == {
        ("A", "F", 20251201, 90000, 10.5, 3, 6076, 1), ("C", "F", 20251202, 59, 2.0, 4, 6077, 1),
    }
    assert bad.isEmpty()


def test_paths_from_a_template():
    assert tick_paths("/landing/{id}/T.zip", [7, 9]) == ["/landing/7/T.zip", "/landing/9/T.zip"]


def test_archive_without_a_log_is_an_error(spark, tmp_path):
    path = archive(tmp_path / "1.zip", {"readme.md": "x"})
    with pytest.raises(Exception, match="no .csv or .txt member"):
        read_tick_zips(spark, path, list(TICK_COLUMNS)).collect()


def test_unreadable_archives_can_be_quarantined(spark, tmp_path):
    archive(tmp_path / "1.zip", {"readme.md": "x"})
    (tmp_path / "2.zip").write_bytes(b"not a zip")
    archive(tmp_path / "3.zip", {"T.csv": log(GOOD)})
    archive(tmp_path / "4.zip", {"T.csv": "\n"})
    good, bad = split_bad_rows(read_tick_zips(spark, f"{tmp_path}/*.zip", on_error="quarantine"))
    assert as_set(good, "source_id") == {(3,)}
    assert as_set(bad, "source_id", "reason") == {(i, "unreadable archive") for i in (1, 2, 4)}


BAD = {
    GOOD + ",surplus": "too many fields",
    GOOD + ",": "too many fields",
    "A,F,20251201": "missing or non-numeric integer",
    "A,F,yesterday,090000,10.5,3": "missing or non-numeric integer",
    "A,F,20251201,090000,10.5,3.5": "missing or non-numeric integer",
    "A,F,20251201,NA,10.5,3": "missing or non-numeric integer",
    "A,F,20251201,090000,ten,3": "non-numeric price",
    "A,F,-20251201,090000,10.5,3": "not a date",
    "A,F,20251201,-5,10.5,3": "not a time of day",
    "A,F,20251201,93015123,10.5,3": "not a time of day",
    "A,F,20251201,999999,10.5,3": "not a time of day",
    "A,F,20251201,250000,10.5,3": "not a time of day",
    "A,F,20251201,096000,10.5,3": "not a time of day",
    "A,F,20251201,090000,10.5,-3": "negative volume",
    ",F,20251201,090000,10.5,3": "missing code",
    "NA,F,20251201,090000,10.5,3": "missing code",
}


def test_bad_lines_are_quarantined_with_their_text(spark, tmp_path):
    path = archive(tmp_path / "5.zip", {"T.csv": log(GOOD, "", "  ", *BAD, "B,F,20251201,090001,,2")})
    good, bad = split_bad_rows(read_tick_zips(spark, path))
    assert as_set(bad, "line", "reason") == set(BAD.items())
    # A missing price is no parse error; the price filter drops it later.
    assert as_set(good, "Comm", "Price") == {("A", 10.5), ("B", None)}
    # Whatever columns are read, the same lines count as good.
    assert good.count() == 2 and good.select("Comm").count() == 2


def test_order_of_columns_comes_from_each_file(spark, tmp_path):
    archive(tmp_path / "1.zip", {"T.csv": log(GOOD)})
    swapped = "Comm,Month,Log_Time,Trade_Date,Volume,Price,Contract_Type"
    archive(tmp_path / "2.zip", {"T.csv": log('"A,B",Z,090000,20251201,3,10.5,F', header=swapped)})
    good, bad = split_bad_rows(read_tick_zips(spark, f"{tmp_path}/*.zip"))
    assert bad.isEmpty()
    assert as_set(good, "Comm", "Trade_Date", "Log_Time", "Price", "Volume", "source_id") == {
        ("A", 20251201, 90000, 10.5, 3, 1), ("A,B", 20251201, 90000, 10.5, 3, 2),
    }
    # With one declared layout, files of another are kept aside whole, not misread.
    good, bad = split_bad_rows(read_tick_zips(spark, f"{tmp_path}/*.zip", list(TICK_COLUMNS)))
    assert as_set(good, "source_id") == {(1,)}
    assert as_set(bad, "source_id", "reason") == {(2, "unknown header")}


def test_short_row_that_lacks_only_optional_cells_is_good(spark, tmp_path):
    header = "Trade_Date,Log_Time,Volume,Comm,Price,Contract_Type"
    path = archive(tmp_path / "1.zip", {"T.csv": log("20251201,090000,3,A,10.5", header=header)})
    good, bad = split_bad_rows(read_tick_zips(spark, path))
    assert as_set(good, "Comm", "Contract_Type", "Price") == {("A", None, 10.5)} and bad.isEmpty()


def test_header_without_a_tick_column_is_refused(spark, tmp_path):
    path = archive(tmp_path / "1.zip", {"T.csv": "Comm,Price\nA,1\n"})
    with pytest.raises(Exception, match="lacks"):
        read_tick_zips(spark, path).collect()


def test_unusable_header_fails_its_own_file_only(spark, tmp_path):
    archive(tmp_path / "1.zip", {"T.csv": "Comm,Price\nA,1\n"})
    archive(tmp_path / "2.zip", {"T.csv": log(GOOD)})
    good, bad = split_bad_rows(read_tick_zips(spark, f"{tmp_path}/*.zip", on_error="quarantine"))
    assert as_set(good, "source_id") == {(2,)}
    assert as_set(bad, "source_id", "reason", "line") == {(1, "unknown header", "A,1")}


def test_plain_log_without_a_header_is_an_error(spark, tmp_path):
    (tmp_path / "1.csv").write_text(log(GOOD))
    (tmp_path / "2.csv").write_text(GOOD + "\n")
    with pytest.raises(ValueError, match="1 files without a header"):
        read_tick_csv(spark, str(tmp_path))


def test_quoted_cells(spark, tmp_path):
    lines = ['"A,1","F",20251201,"090000",10.5,"3"', '"B ""x""",F,20251201,090000,,1', '"C",F,20251201,090000,1,2,3']
    path = archive(tmp_path / "1.zip", {"T.csv": log(*lines)})
    good, bad = split_bad_rows(read_tick_zips(spark, path))
    assert as_set(good, "Comm", "Log_Time", "Price", "Volume") == {("A,1", 90000, 10.5, 3), ('B "x"', 90000, None, 1)}
    assert as_set(bad, "reason") == {("too many fields",)}


def test_windows_line_ends_and_byte_order_mark(spark, tmp_path):
    text = "﻿" + "\r\n".join([HEADER, GOOD, ""])
    path = archive(tmp_path / "1.zip", {"T.csv": text.encode()})
    good, bad = split_bad_rows(read_tick_zips(spark, path))
    assert as_set(good, "Volume") == {(3,)} and bad.isEmpty()


def test_long_members_are_read_in_blocks(spark, tmp_path):
    lines = [f"A,F,20251201,{i % 60:06d},1.0,{i}" for i in range(120_000)]
    path = archive(tmp_path / "1.zip", {"T.csv": log(*lines)})
    good, bad = split_bad_rows(read_tick_zips(spark, path, list(TICK_COLUMNS)))
    assert good.filter("seq = Volume + 1").count() == 120_000 and good.count() == 120_000
    assert bad.isEmpty()


def test_line_without_end_and_lines_longer_than_a_block(spark, tmp_path):
    long = "A,F,bad," + "x" * 3_000_000
    path = archive(tmp_path / "1.zip", {"T.csv": "\n" + log(GOOD, long, GOOD).rstrip("\n")})
    good, bad = split_bad_rows(read_tick_zips(spark, path))
    assert as_set(good, "seq") == {(1,), (3,)}
    assert as_set(bad, "line", "seq") == {(long, 2)}


@pytest.mark.parametrize("known", [True, False])
def test_plain_logs(spark, tmp_path, known):
    (tmp_path / "6076.csv").write_text(log(GOOD, *BAD))
    (tmp_path / "6077.txt").write_text(log("C,F,20251202,000059,2,4"))
    good, bad = split_bad_rows(read_tick_csv(spark, str(tmp_path), list(TICK_COLUMNS) if known else None))
    assert as_set(good, "Comm", "Log_Time", "Volume", "source_id") == {("A", 90000, 3, 6076), ("C", 59, 4, 6077)}
    assert as_set(bad, "line", "reason") == set(BAD.items())


def test_plain_logs_of_several_layouts(spark, tmp_path):
    (tmp_path / "1.csv").write_text(log(GOOD))
    (tmp_path / "2.csv").write_text(log("3,10.5,20251201,090000,B,F", header="Volume,Price,Trade_Date,Log_Time,Comm,Contract_Type"))
    good, bad = split_bad_rows(read_tick_csv(spark, str(tmp_path)))
    assert as_set(good, "Comm", "Trade_Date", "source_id") == {("A", 20251201, 1), ("B", 20251201, 2)}
    assert bad.isEmpty()


def test_a_path_without_an_id_is_an_error(spark, tmp_path):
    archive(tmp_path / "LOG.zip", {"T.csv": log(GOOD)})
    archive(tmp_path / "20251201123456.zip", {"T.csv": log(GOOD)})
    for name in ("LOG.zip", "20251201123456.zip"):
        with pytest.raises(Exception, match="no file id"):
            read_tick_zips(spark, str(tmp_path / name)).collect()


def test_undecodable_bytes_are_quarantined(spark, tmp_path):
    text = log(GOOD).encode() + b"A\xff,F,20251201,090000,10.5,3\n"
    good, bad = split_bad_rows(read_tick_zips(spark, archive(tmp_path / "1.zip", {"T.csv": text})))
    assert as_set(good, "Comm") == {("A",)} and as_set(bad, "reason") == {("undecodable bytes",)}


def test_plain_logs_are_read_by_their_own_header(spark, tmp_path):
    swapped = "Comm,Contract_Type,Trade_Date,Log_Time,Volume,Price"
    (tmp_path / "1.csv").write_text(log("A,F,20251201,090000,3,10", header=swapped))
    (tmp_path / "2.csv").write_text("B,F,20251201,090000,10,3\n")
    good, bad = split_bad_rows(read_tick_csv(spark, str(tmp_path), list(TICK_COLUMNS)))
    assert as_set(good, "Comm", "Price", "Volume") == {("A", 10.0, 3), ("B", 10.0, 3)} and bad.isEmpty()


def test_rows_of_a_folder_of_parts_have_numbers_of_their_own(spark, tmp_path):
    folder = tmp_path / "7.csv"
    folder.mkdir()
    for part in range(3):
        (folder / f"part-{part}").write_text("".join(f"A,F,20251201,090000,1,{part * 10 + i}\n" for i in range(10)))
    good, _ = split_bad_rows(read_tick_csv(spark, str(folder), list(TICK_COLUMNS)))
    rows = good.orderBy("seq").select("Volume", "seq").collect()
    assert [r.Volume for r in rows] == list(range(30)) and len({r.seq for r in rows}) == 30


def test_row_numbers_follow_file_order_across_splits(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "4000")
    conf("spark.sql.files.openCostInBytes", "100")
    for name, n in (("1.csv", 3000), ("2.csv", 40), ("3.csv", 10)):
        (tmp_path / name).write_text(log(*[f"A,F,20251201,090000,1.0,{i}" for i in range(n)]))
    parsed = read_tick_csv(spark, str(tmp_path), list(TICK_COLUMNS))
    assert parsed.rdd.getNumPartitions() > 10
    rows = split_bad_rows(parsed)[0].orderBy("source_id", "seq").select("source_id", "Volume").collect()
    assert [tuple(r) for r in rows] == [(s, i) for s, n in ((1, 3000), (2, 40), (3, 10)) for i in range(n)]


def test_ranges_of_any_size_give_every_line_once(tmp_path):
    """Lines longer than a range or a block, empty ones, both line ends, and none at the end of the file."""
    dice = random.Random(4)
    for case in range(30):
        lines = ["x" * dice.choice([0, 1, 5, 40, 700]) + str(i) for i in range(dice.choice([0, 1, 3, 60]))]
        end = dice.choice([b"\n", b"\r\n"])
        content = end.join(line.encode() for line in lines) + dice.choice([b"", end])
        path = tmp_path / f"{case}.csv"
        path.write_bytes(content)
        size = dice.choice([1, 7, 64, 500, 10_000])
        found, places = [], []
        for start in range(0, max(len(content), 1), size):
            for at, block in text._whole_lines(str(path.as_uri()), start, min(start + size, len(content))):
                assert content[at : at + len(block)] == block
                found += [(at, i, line) for i, line in enumerate(block.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n"))]
                places.append(at)
        assert places == sorted(places) and found == sorted(found, key=lambda f: f[:2])
        assert [line.decode() for _, _, line in found if line] == [line for line in lines if line]


def test_lines_of_plain_logs_are_not_shuffled(spark, conf, tmp_path, monkeypatch):
    """Several ranges to a file, two headers: the lines stay in the task that reads them."""
    monkeypatch.setattr(text, "RANGE_BYTES", 2000)
    first = "\n".join([",".join(TICK_COLUMNS), *[f"A,F,20251201,{90000 + i % 60},{i}.5,{i}" for i in range(1, 400)]])
    second = "\r\n".join(["Volume,Price,Log_Time,Trade_Date,Contract_Type,Comm", *[f"{i},{i}.25,90000,20251202,F,B" for i in range(1, 300)], "broken"])
    (tmp_path / "1.csv").write_text(first)
    (tmp_path / "2.csv").write_bytes(second.encode())
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    parsed = read_tick_csv(spark, str(tmp_path))
    plan = plan_of(parsed)
    assert "Join" not in plan and plan.count("Exchange") <= 2 and plan.rindex("Exchange") > plan.rindex("MapInArrow")
    good, bad = split_bad_rows(parsed)
    assert as_set(good, "source_id", "Comm", "Volume", "Price") == {(1, "A", i, i + 0.5) for i in range(1, 400)} | {
        (2, "B", i, i + 0.25) for i in range(1, 300)}
    assert as_set(bad, "source_id", "line") == {(2, "broken")}
    order = [r["Volume"] for r in good.filter("source_id = 1").orderBy("seq").collect()]
    assert order == list(range(1, 400)) and parsed.select("source_id", "seq").distinct().count() == parsed.count()
    assert parsed.select(F.spark_partition_id()).distinct().count() > 4


@pytest.mark.parametrize("what", ["zip", "csv"])
def test_workers_need_not_have_the_package(tmp_path, what):
    """The functions that tasks run, unpickled where the package cannot be imported."""
    content = ",".join(TICK_COLUMNS) + "\nA,F,20251201,090000,10,3\n"
    if what == "zip":
        archive(tmp_path / "1.zip", {"T.csv": content})
        run, batch = zips._block_reader(None), pa.RecordBatch.from_pydict({"path": [f"file:{tmp_path}/1.zip"]})
    else:
        (tmp_path / "1.csv").write_text(content)
        run = text._read_ranges
        batch = pa.RecordBatch.from_pydict({
            "file": [f"file:{tmp_path}/1.csv"], "start": [0], "stop": [len(content)], "source_id": pa.array([1], pa.int32()),
            "before": [0], "header": ["h"], "positions": [[0]], "width": pa.array([6], pa.int32())})
    (tmp_path / "f").write_bytes(cloudpickle.dumps((run, batch)))
    script = ("import importlib.util, pickle, sys; assert importlib.util.find_spec('tickloom') is None; import pyspark.cloudpickle; "
              "f, b = pickle.load(open('f', 'rb')); print(sum(x.column('block').to_pylist()[0] is not None for x in f(iter([b]))))")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=100)
    assert done.stdout.strip() == "1", done.stderr


def test_a_hot_archive_is_parsed_by_many_tasks(spark, conf, tmp_path, monkeypatch):
    monkeypatch.setattr(zips, "BLOCK_CHARS", 2000)
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2KB")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1KB")
    conf("spark.sql.shuffle.partitions", "16")
    for i, n in ((1, 4000), (2, 20), (3, 30)):
        archive(tmp_path / f"{i}.zip", {"T.csv": log(*[f"A,F,20251201,{90000 + k % 60},{k}.5,{k}" for k in range(n)])})
    good, bad = split_bad_rows(read_tick_zips(spark, str(tmp_path)))
    hot = good.filter("source_id = 1")
    assert hot.select(F.spark_partition_id()).distinct().count() > 4
    assert as_set(good, "source_id", "seq", "Volume") == {(i, k + 1, k) for i, n in ((1, 4000), (2, 20), (3, 30)) for k in range(n)}
    assert bad.isEmpty()
