"""One load of a table at a time: a lease taken by compare and set, with an end."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from clicklake.plans.ingest import Clock, Ledger, Run, incremental_load, utc_now
from clicklake.sinks.versions import Dataset, Outdated
from clicklake.sources.relational import Source


class LeaseHeld(RuntimeError):
    """Somebody else loads the table."""


class Lease:
    """Lease of one pipeline and table, as a context.

    Taking it makes the next version of a small record, which only one of several can. It ends when it is
    given back, or by its time if the holder dies. ``renew`` before the result is made known: who has lost the lease
    meanwhile learns it there, and makes nothing known.
    """

    def __init__(self, spark: SparkSession, lake: str, pipeline: str, table: str, seconds: float = 3_600, clock: Clock = utc_now):
        self.record = Dataset(spark, f"{lake}/control/leases/{pipeline}.{table}")
        self.what, self.seconds, self.clock, self.owner = f"{pipeline}.{table}", seconds, clock, uuid.uuid4().hex

    def _put(self, base, owner: str | None) -> None:
        until = self.clock() + timedelta(seconds=self.seconds)
        try:
            self.version = self.record.commit(base, {}, {"owner": owner, "until": until.isoformat()})
        except Outdated as err:
            raise LeaseHeld(f"{self.what} was taken by another load") from err

    def __enter__(self) -> Lease:
        base = self.record.current()
        if base.notes.get("owner") and datetime.fromisoformat(base.notes["until"]) > self.clock():
            raise LeaseHeld(f"{self.what} is loaded by {base.notes['owner']} until {base.notes['until']}")
        self._put(base, self.owner)
        return self

    def renew(self) -> None:
        """Hold it for its whole time again; ``LeaseHeld`` if it ran out and somebody took it."""
        self._put(self.version, self.owner)

    def __exit__(self, kind, value, trace) -> None:
        try:
            self._put(self.version, None)
        except LeaseHeld:
            if kind is None:
                raise
        self.record.vacuum(keep=2)


def leased_load(source: Source, lake: str, ledger: Ledger, pipeline: str, table: str, seconds: float = 3_600, **options) -> Run:
    """``incremental_load`` that no other load of the table runs beside.

    The watermark is read under the lease, so of two loads the second begins where the first ended, or is told
    that the table is being loaded. A load that outlives its lease records a failure, not a watermark.
    """
    with Lease(ledger.spark, lake, pipeline, table, seconds, ledger.clock) as lease:
        return incremental_load(source, lake, ledger, pipeline, table, still_ours=lease.renew, **options)
