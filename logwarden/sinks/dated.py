"""Tables that streams write exactly once, split by contract and by date, and their compaction.

A table is a folder of parts, one for each query that writes it.  A part is written by the file
sink: its log commits a batch as a whole, so a batch's accepted and refused rows appear together, a
batch that is run again adds nothing, and readers see no file of an unfinished batch.  Rows lie in
`accepted=true|false/date=...`, so a time range reads only its days.

Streams leave many small files.  `compact` writes the accepted rows of closed days into few large
ones beside the parts; readers then take those days from there.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from logwarden.sources.shared import child_folders

_PARTS, _COMPACTED = "parts", "compacted"


def part_folder(path: str, part: str) -> str:
    return f"{path}/{_PARTS}/{part}"


def judged(rows: DataFrame, refused: Column, time: str) -> DataFrame:
    """Adds the two columns by which a table is split."""
    return rows.withColumns(
        {"accepted": ~refused, "date": F.to_date(F.col(time)).cast("string")}
    )


def part_stream(rows: DataFrame, folder: str) -> DataStreamWriter:
    """Writes judged rows as one part of a table."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("accepted", "date")
        .option("path", folder)
    )


def written_rows(session: SparkSession, folder: str, ddl: str) -> DataFrame:
    """What has been committed to a folder; none where it does not exist yet."""
    try:
        return session.read.schema(ddl).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return session.createDataFrame([], ddl)


def within(rows: DataFrame, first_date: str | None, last_date: str | None) -> DataFrame:
    if first_date is not None:
        rows = rows.where(F.col("date") >= first_date)
    if last_date is not None:
        rows = rows.where(F.col("date") <= last_date)
    return rows


def read_parts(
    session: SparkSession, path: str, ddl: str, accepted: bool = True,
    first_date: str | None = None, last_date: str | None = None,
) -> DataFrame:
    """The rows that streams have written: accepted ones, or the refused with their `violations`."""
    stored = f"{ddl}, violations string, accepted boolean, date string"
    result = session.createDataFrame([], stored)
    for folder in child_folders(session, f"{path}/{_PARTS}"):
        rows = written_rows(session, folder, stored).where(F.col("accepted") == F.lit(accepted))
        result = result.unionByName(within(rows, first_date, last_date))
    return result.drop("accepted", "violations") if accepted else result.drop("accepted")


def compacted_dates(session: SparkSession, path: str) -> list[str]:
    """Days that `compact` has written; as many as there are folders."""
    folders = child_folders(session, f"{path}/{_COMPACTED}")
    return [folder.rpartition("date=")[2] for folder in folders if "/date=" in folder]


def compact(session: SparkSession, path: str, ddl: str, before: str) -> None:
    """Writes the accepted rows of all days before `before` into few files.

    Only days on which no more rows can come may be given: a watermark later than their last
    window's end.  Running it again replaces the same days by the same rows.
    """
    rows = read_parts(session, path, ddl).where(F.col("date") < before)
    (
        rows.hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(f"{path}/{_COMPACTED}")
    )


def read_table(
    session: SparkSession, path: str, ddl: str,
    first_date: str | None = None, last_date: str | None = None,
) -> DataFrame:
    """All accepted rows and their date; compacted days come from the compacted files."""
    live = read_parts(session, path, ddl, True, first_date, last_date)
    done = compacted_dates(session, path)
    if not done:
        return live
    compacted = written_rows(session, f"{path}/{_COMPACTED}", f"{ddl}, date string")
    compacted = within(compacted, first_date, last_date)
    return live.where(~F.col("date").isin(*done)).unionByName(compacted)
