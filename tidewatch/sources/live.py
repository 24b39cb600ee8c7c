"""Live venue feeds as a streaming source: ``spark.readStream.format("venue").option("feed", "coinbase")``.

A message can be had from a venue only once, so the reader keeps what it has received until its batch is committed, and
gives the same rows again if a batch is repeated. It runs on the driver; the raw topic is what survives a restart.
"""

from __future__ import annotations

import threading
from collections import deque
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from tidewatch.sources.feeds import FEEDS, messages

SCHEMA = "raw string, ts_ingest long"


#: Messages that wait on the driver for a batch, at most; beyond that nothing is received until batches are committed.
CAPACITY = 1_000_000


def websocket() -> tuple[Callable[[str], Iterable[str]], tuple[type[BaseException], ...]]:
    """What opens a connection, and the exceptions by which one is lost; ImportError without a websocket client."""
    from websockets.exceptions import WebSocketException
    from websockets.sync.client import connect

    return connect, (OSError, WebSocketException)


class MessageBuffer:
    """Messages numbered in the order of receipt, filled by a thread of its own, which waits while the buffer is full."""

    def __init__(self, source: Callable[[], Iterator[tuple[int, str]]], capacity: int = CAPACITY):
        self.rows: deque[tuple[str, int]] = deque()
        self.first = self.next = 0
        self.capacity = capacity
        self.ended: BaseException | None = None
        self.changed = threading.Condition()
        threading.Thread(target=self._fill, args=(source,), daemon=True).start()

    def _fill(self, source) -> None:
        try:
            for at, text in source():
                with self.changed:
                    self.changed.wait_for(lambda: len(self.rows) < self.capacity)
                    self.rows.append((text, at))
                    self.next += 1
            raise EOFError("the feed has ended")
        except BaseException as why:  # noqa: BLE001
            self.ended = why

    def between(self, start: int, end: int | None = None) -> tuple[list[tuple[str, int]], int]:
        """The rows from ``start`` on; once they are used up, RuntimeError if nothing more will come."""
        with self.changed:
            end = self.next if end is None else end
            if self.ended is not None and start >= self.next:
                raise RuntimeError("the feed's thread has died") from self.ended
            return [self.rows[k - self.first] for k in range(max(start, self.first), min(end, self.next))], end

    def forget(self, end: int) -> None:
        with self.changed:
            while self.first < min(end, self.next):
                self.rows.popleft()
                self.first += 1
            self.changed.notify_all()


class VenueReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict[str, str], client=websocket):
        feed, symbols = FEEDS[options["feed"]](), options.get("symbols", "BTC-USD,ETH-USD").split(",")
        connect, lost = client()
        self.buffer = MessageBuffer(lambda: messages(feed, symbols, connect, lambda: False, lost=lost))

    def initialOffset(self) -> dict:
        return {"n": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = self.buffer.between(start["n"])
        return iter(rows), {"n": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self.buffer.between(start["n"], end["n"])[0])

    def commit(self, end: dict) -> None:
        self.buffer.forget(end["n"])


class VenueSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "venue"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> VenueReader:
        return VenueReader(self.options)


def live_trades(spark: SparkSession, feed: str, symbols: list[str]) -> DataFrame:
    """The records of a live feed, as a stream."""
    spark.dataSource.register(VenueSource)
    raw = spark.readStream.format("venue").option("feed", feed).option("symbols", ",".join(symbols)).load()
    return FEEDS[feed]().parse(raw)
