"""REST providers as a stream: a list of symbols whose offset is the place in it.

``spark.readStream.format("rest_stream")`` takes the options of ``rest_payloads`` and also ``spool``, a folder that the driver and all executors
share, and ``symbolsPerBatch``. A batch is a stretch of the list. An offset has the place behind the stretch and the
times of the calls made before it that still count towards the provider's rate, so a stream that starts again keeps to the rate.

Each answer is kept in the spool as soon as it is there, a failure too. A batch or task that is run again takes it from there, so the same offsets give
the same rows and nothing is asked for twice, but for a call under way when its task is lost. Once Spark has committed a batch, the place
and the times go into the spool's mark and the batch's answers are deleted. One stream at a time uses a spool, without speculative
execution. Symbols that are added to the list's end are read when the stream is started with them; an empty list has no batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidebook.functions.workers import ship
from tidebook.sources import rest
from tidebook.sources.payload_files import system_of

MARK = "mark.json"
SYMBOLS_PER_BATCH = 50


class Spool:
    """Answers by their symbols' places, and the mark: the place up to which batches are committed, with the times of the last calls."""

    def __init__(self, folder: str, limit: int):
        self.system, self.root = system_of(folder.rstrip("/"))
        self.limit = limit

    def _get(self, name: str) -> dict | list | None:
        try:
            with self.system.open_input_stream(f"{self.root}/{name}") as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def _put(self, name: str, value: dict | list) -> None:
        """A whole file or none."""
        self.system.create_dir(self.root, recursive=True)
        with self.system.open_output_stream(f"{self.root}/.{name}") as f:
            f.write(json.dumps(value).encode())
        self.system.move(f"{self.root}/.{name}", f"{self.root}/{name}")

    def mark(self) -> dict:
        return self._get(MARK) or {"place": 0, "calls": []}

    def answer(self, place: int) -> list | None:
        return self._get(f"{place}.json")

    def keep(self, place: int, row: tuple) -> None:
        self._put(f"{place}.json", list(row))

    def places(self) -> list[int]:
        """Of the kept answers, in order: those of a batch at most."""
        from pyarrow import fs

        found = self.system.get_file_info(fs.FileSelector(self.root, allow_not_found=True))
        return sorted(int(n) for n in (x.base_name.removesuffix(".json") for x in found) if n.isdigit())

    def last_calls(self, times: list[float]) -> list[float]:
        return sorted(times)[-self.limit :] if self.limit > 0 else []

    def now(self) -> dict:
        """The mark, moved on by what is kept behind it."""
        mark = self.mark()
        behind = [p for p in self.places() if p >= mark["place"]]
        times = mark["calls"] + [t for p in behind for t in json.loads(self.answer(p)[-1])]
        return {"place": max([mark["place"], *[p + 1 for p in behind]]), "calls": self.last_calls(times)}

    def commit(self, place: int) -> None:
        """Move the mark to ``place``; doing it again changes nothing."""
        mark = self.mark()
        if place > mark["place"]:
            done = [p for p in self.places() if mark["place"] <= p < place]
            times = mark["calls"] + [t for p in done for t in json.loads(self.answer(p)[-1])]
            self._put(MARK, {"place": place, "calls": self.last_calls(times)})
        for p in self.places():
            if p < place:
                self.system.delete_file(f"{self.root}/{p}.json")


class Stretch(InputPartition):
    def __init__(self, first: int, symbols: list[str], calls: list[float]):
        self.first, self.symbols, self.calls = first, symbols, calls


class PayloadStream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], transports: dict[str, rest.Transport]):
        self.payloads = rest.PayloadReader(options, transports)
        self.folder = self.payloads.options["spool"]
        self.size = int(self.payloads.options.get("symbolsperbatch", SYMBOLS_PER_BATCH))
        if self.size < 1:
            raise ValueError("symbolsPerBatch must be 1 or more")

    def _spool(self) -> Spool:
        return Spool(self.folder, self.payloads.limit)

    @staticmethod
    def _offset(place: int, calls: list[float]) -> dict:
        return {"place": place, "calls": json.dumps(calls)}

    def initialOffset(self) -> dict:
        mark = self._spool().mark()
        return self._offset(mark["place"], mark["calls"])

    def latestOffset(self) -> dict:
        """The next stretch's end; at the end of the list what the last one's calls were, so that a last batch without rows records them."""
        now = self._spool().now()
        return self._offset(max(now["place"], min(now["place"] + self.size, len(self.payloads.symbols))), now["calls"])

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        """One task for a provider with a rate, else as many as ``symbolsPerTask`` makes."""
        first, calls = start["place"], json.loads(end["calls"])
        symbols = self.payloads.symbols[first : end["place"]]
        size = len(symbols) if self.payloads.limit > 0 else max(1, int(self.payloads.options.get("symbolspertask", "1")))
        return [Stretch(first + k, symbols[k : k + size], calls) for k in range(0, len(symbols), max(1, size))]

    def read(self, partition: Stretch) -> Iterator[tuple]:
        spool = self._spool()
        kept = [spool.answer(partition.first + k) for k in range(len(partition.symbols))]
        calls = self.payloads.call_times(partition.calls + [t for a in kept if a for t in json.loads(a[-1])])
        for k, (symbol, answer) in enumerate(zip(partition.symbols, kept, strict=True)):
            if answer is None:
                answer = self.payloads.ask(symbol, calls)
                spool.keep(partition.first + k, answer)
            yield tuple(answer)

    def commit(self, end: dict) -> None:
        self._spool().commit(end["place"])


def register(spark: SparkSession, **transports: rest.Transport) -> None:
    """Make the format known to a session, with ``transports`` of one's own beside http and replay."""
    ship(spark)
    known = {"http": rest.http, "replay": rest.replay, **transports}

    class PayloadStreams(DataSource):
        @classmethod
        def name(cls) -> str:
            return "rest_stream"

        def schema(self) -> str:
            return rest.SCHEMA

        def streamReader(self, schema) -> PayloadStream:
            return PayloadStream(self.options, known)

    spark.dataSource.register(PayloadStreams)
