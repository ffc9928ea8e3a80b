from datetime import timedelta

from conftest import as_set

from tickloom.operators import rollups
from tickloom.schemas import STG_HOURLY_STATS
from tickloom.streaming import HourlyTable


def parts(make_ticks):
    """Three batches: day 1 and 2, day 4, and ticks of all days; with a lateness of a day those of day 1 and 2 are late."""
    return [
        make_ticks(("A", 20250101, 90000, 10.0, 1, 1), ("A", 20250102, 93000, 11.0, 2, 1), ("B", 20250102, 235959, 5.0, 1, 1)),
        make_ticks(("A", 20250104, 90000, 12.0, 3, 1)),
        make_ticks(("A", 20250101, 95959, 9.0, 7, 1), ("B", 20250102, 230000, 4.0, 1, 1), ("A", 20250103, 90000, 8.0, 1, 1),
                   ("A", 20250103, 85959, 7.0, 1, 1), ("A", 20250104, 100000, 6.0, 1, 1)),
    ]


def test_late_ticks_are_set_aside_and_nothing_is_lost(spark, tmp_path, make_ticks):
    table, batches = HourlyTable(spark, str(tmp_path / "t")), parts(make_ticks)
    assert table.hours().isEmpty() and table.late().isEmpty() and table.mark() is None
    write = table.writer()
    for n, batch in enumerate(batches):
        for _ in range(1 + (n == 2)):  # the last one is run again, as after a crash
            write(batch, n)
    # The mark is 9:00 of day 4, so hours that ended by 9:00 of day 3 are closed.
    late = {("A", 20250101, 95959), ("B", 20250102, 230000), ("A", 20250103, 85959)}
    assert as_set(table.late(), "Comm", "Trade_Date", "Log_Time") == late
    everything = batches[0].unionByName(batches[1]).unionByName(batches[2])
    whole = as_set(rollups.hourly_stats(everything).select(*STG_HOURLY_STATS.names))
    assert as_set(table.corrected().select(*STG_HOURLY_STATS.names)) == whole
    assert (20250103, 1) in as_set(table.hours().filter("Hour = 9"), "Trade_Date", "Total_Volume")
    before = as_set(table.hours())
    table.compact()
    table.compact()
    assert as_set(table.hours()) == before
    write(batches[1].withColumn("Trade_Date", batches[1]["Trade_Date"] + 1), 3)
    table.compact()
    assert table.store.partitions("hours") == ["3"] and table.store.partitions("base") == ["2", "3"]
    assert table.hours().count() == len(before) + 1
    # A batch without its mark does not count.
    table._put("hours", 4, table.hours())
    assert table.hours().count() == len(before) + 1


def test_the_lateness_decides(spark, tmp_path, make_ticks):
    table = HourlyTable(spark, str(tmp_path / "t"), timedelta(days=30))
    for n, batch in enumerate(parts(make_ticks)):
        table.writer()(batch, n)
    assert table.late().isEmpty()
