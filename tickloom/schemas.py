"""Column layouts of every table the library reads or writes.

All fields are nullable: files carry no constraints, uniqueness and foreign keys
are checked by :mod:`tickloom.operators.quality`.
"""

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STR, INT, LONG, DBL = StringType(), IntegerType(), LongType(), DoubleType()


def _schema(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


#: Columns of the raw log, in the order a file without a header would have them.
TICK_COLUMNS = ("Comm", "Contract_Type", "Trade_Date", "Log_Time", "Price", "Volume")

TICK = _schema(
    ("Comm", STR), ("Contract_Type", STR), ("Trade_Date", INT), ("Log_Time", INT),
    ("Price", DBL), ("Volume", LONG), ("source_id", INT), ("seq", LONG),
)

STG_HOURLY_STATS = _schema(
    ("Comm", STR), ("Trade_Date", INT), ("Hour", INT), ("Total_Volume", LONG),
    ("Total_Turnover", DBL), ("Low", DBL), ("High", DBL), ("source_id", INT),
)

STG_SESSION_SUMMARY = _schema(
    ("Comm", STR), ("Trade_Date", INT), ("Total_Volume", LONG), ("Total_Turnover", DBL),
    ("Low", DBL), ("High", DBL), ("Open", DBL), ("Close", DBL), ("source_id", INT),
)

STG_TRADE_DISTRIBUTION = _schema(
    ("Comm", STR), ("Trader_Type", STR), ("Trade_Count", LONG), ("Total_Volume", LONG),
    ("source_id", INT),
)

DIM_COMMODITY = _schema(("Comm_id", INT), ("Comm_Code", STR))

DIM_TRADER_TYPE = _schema(("Trader_Type_id", INT), ("Trader_Type_Name", STR))

DIM_DATE = _schema(
    ("Date_id", INT), ("Full_Date", DateType()), ("Year", INT), ("Month", INT),
    ("Quarter", INT), ("Week_Num", INT), ("Day_Name", STR),
)

# Facts carry the load that wrote them, and lie in the segment of the attempt that did: a
# folder of its own, seen once the ledger's SUCCESS row names it (see plans.publish).
FACT_SESSION_SUMMARY = _schema(
    ("Comm_id", INT), ("Date_id", INT), ("Total_Volume", LONG), ("Total_Turnover", DBL),
    ("Low", DBL), ("High", DBL), ("Open", DBL), ("Close", DBL),
    ("source_id", INT), ("load_id", LONG), ("segment", STR),
)

FACT_HOURLY_STATS = _schema(
    ("Comm_id", INT), ("Date_id", INT), ("Hour", INT), ("Total_Volume", LONG),
    ("Total_Turnover", DBL), ("Low", DBL), ("High", DBL),
    ("source_id", INT), ("load_id", LONG), ("segment", STR), ("year", INT),
)

FACT_TRADE_DISTRIBUTION = _schema(
    ("Comm_id", INT), ("Trader_Type_id", INT), ("Trade_Count", LONG), ("Total_Volume", LONG),
    ("source_id", INT), ("load_id", LONG), ("segment", STR),
)

# Append-only transitions; the mutable status row is a fold over them. ``segment`` is where the attempt
# puts its facts, ``txn`` the micro-batch that wrote the row, if one did.
FILE_STATUS_LOG = _schema(
    ("file_id", INT), ("status", STR), ("changed_at", TimestampNTZType()),
    ("etl_sec", INT), ("seq", LONG), ("load_id", LONG), ("segment", STR), ("txn", STR),
)

# What all transitions of a file up to some point amount to. ``last_at`` and ``ok_at`` order its last transition
# and its last success; ``open_segment`` belongs to the one, ``load_id`` and ``segment`` to the other.
ORDER = DecimalType(38, 0)
LEDGER_STATE = _schema(
    ("file_id", INT), ("last_at", ORDER), ("code", INT), ("etl_sec", INT), ("created_at", TimestampNTZType()),
    ("updated_at", TimestampNTZType()), ("retry_count", LONG), ("open_segment", STR), ("ok_at", ORDER),
    ("load_id", LONG), ("segment", STR),
)

# Sources whose rows a compaction has moved: from the segment the ledger names to the one they are in now.
FACT_MANIFEST = _schema(("source_id", INT), ("segment", STR), ("stored", STR))
RETIRED = _schema(("segment", STR), ("retired_at", TimestampNTZType()))

# Closes of staged sessions, and for every code its last close before a month began.
STATE_CLOSES = _schema(("Comm", STR), ("Trade_Date", INT), ("source_id", INT), ("Close", DBL), ("month", INT))
STATE_OPENING = _schema(("Comm", STR), ("Trade_Date", INT), ("Close", DBL), ("month", INT))

# ``log_id`` is given out when an entry is appended, and stays.
JOB_LOG = _schema(
    ("log_id", LONG), ("dag_id", STR), ("task_id", STR), ("run_id", STR), ("file_id", STR), ("status", STR),
    ("execution_time", TimestampNTZType()), ("row_count", LONG), ("error_message", STR), ("txn", STR),
)

QUARANTINE = _schema(("source_id", INT), ("seq", LONG), ("reason", STR), ("line", STR))

JOB_ENTRY = StructType(JOB_LOG.fields[1:])

#: name -> (schema, partition columns)
TABLES = {
    "stg_hourly_stats": (STG_HOURLY_STATS, ("source_id",)),
    "stg_session_summary": (STG_SESSION_SUMMARY, ("source_id",)),
    "stg_trade_distribution": (STG_TRADE_DISTRIBUTION, ("source_id",)),
    "quarantine": (QUARANTINE, ("source_id",)),
    "dim_commodity": (DIM_COMMODITY, ()),
    "dim_trader_type": (DIM_TRADER_TYPE, ()),
    "dim_date": (DIM_DATE, ()),
    "fact_session_summary": (FACT_SESSION_SUMMARY, ("segment",)),
    "fact_hourly_stats": (FACT_HOURLY_STATS, ("segment", "year")),
    "fact_trade_distribution": (FACT_TRADE_DISTRIBUTION, ("segment",)),
    "state_closes": (STATE_CLOSES, ("month",)),
    "state_opening": (STATE_OPENING, ("month",)),
    "retired_segments": (RETIRED, ()),
    # Written under an era: a number that grows with every snapshot of the ledger.
    "file_status_log": (FILE_STATUS_LOG, ("era",)),
    "etl_job_logs": (JOB_LOG, ("era",)),
}
