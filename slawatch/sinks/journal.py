"""A journal beside a day-partitioned table: what was staged, what is done.

Changing several partitions takes several steps, and plain Parquet tables
have no transaction over them. So a change is first staged whole, as Parquet
under the table's own ``_journal`` folder, and then entered in the journal
(one row: the stage, the days it replaces, the stream batches it holds).
From that row on the change counts: it is applied, and applied again at the
start of the next run if the first attempt was lost on the way, until a
second row says it is done. Applying replaces whole partitions by the staged
rows, so doing it twice is the same as once. A stage without a row in the
journal never counted and is not looked at.

The journal is also the ledger of the stream: ``merged_batches`` lists the
(query, batch) pairs that the table holds, so a batch is merged once and a
run without new batches touches nothing.

``snapshot`` reads the table as of its journal: days under an unfinished
change come from the stage, so a reader never sees an id on two days, or on
none, whatever step a lost run had reached. One writer per table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import on_days
from .tables import empty_partitions, overwrite_partitions

STAGED, DONE = "staged", "done"
#: Journal rows; a null among the days stands for rows without a day.
SCHEMA = ("entry string, state string, kind string, days array<date>, "
          "batches array<struct<query:string,batch_id:bigint>>, at timestamp")


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a catalog table."""
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    return told["data_type"].rstrip("/")


class TableJournal:
    """The journal of one table partitioned by ``day_col``."""

    def __init__(self, spark: SparkSession, table: str, day_col: str = "date"):
        self.spark, self.table, self.day_col = spark, table, day_col
        # Another session (a stream's, say) may have replaced files since.
        spark.catalog.refreshTable(table)
        self.path = f"{table_location(spark, table)}/_journal"
        # The log exists from the first use on, so reading it never fails.
        spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(f"{self.path}/log")

    def log(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/log")

    def _record(self, entry: str, state: str, kind: str, days: list, batches: list) -> None:
        row = (entry, state, kind, days, batches, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def stage_path(self, entry: str) -> str:
        return f"{self.path}/stage/{entry}"

    def write_stage(self, rows: DataFrame) -> str:
        """Write ``rows`` to a stage of their own; its entry, which does not
        count yet."""
        entry = uuid.uuid4().hex
        rows.write.parquet(self.stage_path(entry))
        return entry

    def enter(self, entry: str, days: list, batches: list | None = None, kind: str = "replace") -> None:
        """Enter a written stage. ``days``: the partitions that its rows
        replace (``kind`` "replace") or join (any other)."""
        self._record(entry, STAGED, kind, days, batches or [])

    def stage(self, rows: DataFrame, days: list, batches: list | None = None, kind: str = "replace") -> str:
        """Write ``rows`` and enter them; the entry."""
        entry = self.write_stage(rows)
        self.enter(entry, days, batches, kind)
        return entry

    def staged(self, entry: str) -> DataFrame:
        """The staged rows of an entry, in the table's own schema."""
        return self.spark.read.schema(self.spark.table(self.table).schema).parquet(self.stage_path(entry))

    def open_entries(self) -> list[Row]:
        """Entries that are staged and not done, the oldest first: one, after
        a run that was lost, if the table has one writer."""
        log = self.log()
        done = log.filter(F.col("state") == DONE).select("entry")
        return log.filter(F.col("state") == STAGED).join(done, "entry", "left_anti").orderBy("at").collect()

    def replace_days(self, row: Row) -> None:
        """Replace the entry's days by its staged rows; days that no staged
        row is on are emptied."""
        staged = self.staged(row["entry"])
        overwrite_partitions(staged, self.table)
        filled = {r[0] for r in staged.select(self.day_col).distinct().collect()}
        empty_partitions(self.spark, self.table, self.day_col, [d for d in row["days"] if d not in filled])

    def apply(self, row: Row, how: Callable[[Row], None] | None = None) -> None:
        """Carry out an entry and mark it done."""
        (how or self.replace_days)(row)
        self._record(row["entry"], DONE, row["kind"], row["days"], row["batches"])

    def recover(self, how: Callable[[Row], None] | None = None) -> int:
        """Finish what an earlier run left; number of entries."""
        left = self.open_entries()
        for row in left:
            self.apply(row, how)
        return len(left)

    def note_batches(self, batches: list) -> None:
        """Enter batches that changed nothing."""
        self._record(uuid.uuid4().hex, DONE, "replace", [], batches)

    def merged_batches(self) -> DataFrame:
        """(``query``, ``batch_id``) of all batches that the table holds."""
        done = self.log().filter(F.col("state") == DONE)
        return done.select(F.inline("batches")).distinct()

    def snapshot(self) -> DataFrame:
        """The rows of the table with every entry of the journal carried
        out, whether its partitions have been replaced yet or not."""
        rows = self.spark.table(self.table)
        for row in self.open_entries():
            if row["kind"] == "replace":
                rows = rows.filter(~on_days(self.day_col, row["days"])).unionByName(self.staged(row["entry"]))
        return rows
