"""One driver per stream name: a lease under a folder that all drivers reach.

A lease is a row of claims, numbered files that appear whole or not at all (``create_once``). The claim with the
largest number counts until its time is up. Whoever takes, renews or gives back writes the next number, and of several
that try the same number one succeeds. So two drivers never hold a lease by the same claim, and a driver that was away for
too long finds that another number came after its own. Clocks of the drivers should agree to well within the term.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from headway.sinks.files import create_once, folders, read_text, remove

TERM = 60.0
KEPT = 8


@dataclass(frozen=True)
class Claim:
    """Who holds a lease, until when (seconds since 1970), and the stream's run if it has begun."""

    number: int
    holder: str
    until: float
    run_id: str | None = None


class Lease:
    """The lease of one name, as one holder sees it."""

    def __init__(self, spark: SparkSession, root: str, name: str, holder: str | None = None, term: float = TERM, clock=time.time) -> None:
        self.spark, self.path, self.term, self.clock = spark, f"{root.rstrip('/')}/lease-{name}", term, clock
        self.holder = holder or uuid.uuid4().hex
        self.mine: Claim | None = None

    def _numbers(self) -> list[int]:
        return sorted(int(entry) for entry in folders(self.spark, self.path) if entry.isdigit())

    def current(self) -> Claim | None:
        """The claim that counts, or None where nobody holds the lease."""
        last = self._last()
        return last if last and last.until > self.clock() else None

    def _last(self) -> Claim | None:
        numbers = self._numbers()
        return Claim(numbers[-1], **json.loads(read_text(self.spark, f"{self.path}/{numbers[-1]:012d}"))) if numbers else None

    def _write(self, after: int, until: float, run_id: str | None) -> bool:
        claim = Claim(after + 1, self.holder, until, run_id)
        body = {k: v for k, v in asdict(claim).items() if k != "number"}
        if not create_once(self.spark, f"{self.path}/{claim.number:012d}", json.dumps(body)):
            return False
        self.mine = claim
        for number in self._numbers()[:-KEPT]:
            remove(self.spark, f"{self.path}/{number:012d}")
        return True

    def take(self) -> bool:
        """Take the lease if nobody holds it."""
        last = self._last()
        if last and last.until > self.clock():
            return False
        return self._write(last.number if last else 0, self.clock() + self.term, None)

    def renew(self, run_id: str | None = None) -> bool:
        """Hold it for another term; False if another claim came after the own one."""
        if self.mine is None:
            return False
        held = self._write(self.mine.number, self.clock() + self.term, run_id or self.mine.run_id)
        self.mine = self.mine if held else None
        return held

    def give_back(self) -> None:
        """Free the lease, unless another holds it by now."""
        if self.mine is not None:
            self._write(self.mine.number, 0.0, self.mine.run_id)
            self.mine = None


def _keep(query: StreamingQuery, lease: Lease) -> None:
    """Renew while the stream runs; stop it when the lease is lost, give the lease back when it ends or fails.

    A renewal that fails otherwise (a file system that does not answer) is tried again until the term is over.
    """
    try:
        while not query.awaitTermination(lease.term / 3):
            try:
                held = lease.renew()
            except Py4JJavaError:
                held = lease.mine is not None and lease.mine.until > lease.clock()
            if not held:
                query.stop()
                return
    except StreamingQueryException:
        pass  # the caller of start_leased holds the stream and sees its failure there
    lease.give_back()


def start_leased(
    spark: SparkSession, writer: DataStreamWriter, name: str, root: str, holder: str | None = None, term: float = TERM
) -> tuple[StreamingQuery | None, Claim]:
    """Start a named stream unless some driver runs one of that name: (query, own claim) or (None, the other's claim).

    ``root`` is a folder that all drivers of the stream share, such as that of its checkpoint.
    """
    lease = Lease(spark, root, name, holder, term)
    while not lease.take():
        other = lease.current()
        if other:
            return None, other
    try:
        query = writer.queryName(name).start()
    except Exception:
        lease.give_back()
        raise
    if not lease.renew(str(query.runId)):
        query.stop()
        raise RuntimeError(f"the lease of {name} was lost while its stream started")
    claim = lease.mine
    threading.Thread(target=_keep, args=(query, lease), name=f"lease-{name}", daemon=True).start()
    return query, claim

