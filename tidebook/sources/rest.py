"""REST providers as a Python data source.

``spark.read.format("rest_payloads")`` with options ``provider``, ``kind`` and ``symbols`` gives a row per symbol:
provider, key, payload, error. What fetches is a transport, a function of (kind, symbol, options) that returns JSON
text: "http" asks the provider at the option ``base``, with the key in the environment variable that ``keyEnv``
names; "replay" reads payloads kept in ``folder``; others are given to ``register`` by name.

A limited source makes ``perMinute`` calls in any minute at most, counting those that ``calledAt`` says were made before, so it is
read by one task; without a limit, by as many as ``symbolsPerTask`` makes. A row has the times of its calls, from which the next read
goes on. A call that fails is tried again ``attempts`` times in all, and prices again once if they say that a rate limit was
reached; what they said is kept as ``earlier``. A symbol that still fails is a row with its error, not a failed job, and Spark doesn't spend calls again.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidebook.functions.workers import ship

Transport = Callable[[str, str, dict[str, str]], str]
SCHEMA = "provider string, key string, payload string, error string, earlier string, calls string"
#: Seconds that a request may take, calls for one payload, and seconds before each further one, times its number.
TIMEOUT = 30
ATTEMPTS = 2
BACKOFF = 2.0
#: Seconds to wait once a provider says that its rate limit was reached.
PAUSE = 60.0
MINUTE = 60.0


def url(kind: str, base: str, symbol: str, key: str, options: dict[str, str]) -> str:
    """A request's address; parameter names are the providers' own."""
    asked = {
        "bar_list": {"symbol": symbol, "interval": options.get("interval", "1day"), "outputsize": options.get("outputsize", "5000"), "apikey": key},
        "bar_map": {"function": "TIME_SERIES_DAILY", "symbol": symbol, "outputsize": options.get("outputsize", "compact"), "apikey": key},
        "macro": {"series_id": symbol, "api_key": key, "file_type": "json", "sort_order": "asc"},
        "news": {"symbol": symbol, "from": options.get("from", ""), "to": options.get("to", ""), "token": key},
        "listing": {"exchange": symbol, "apikey": key},
    }[kind]
    return f"{base}?{urlencode(asked)}"


class CallTimes:
    """When a provider was called, and when it may be called again: the call ``limit`` places back must be ``seconds`` old. 0 or less: at any time."""

    def __init__(self, limit: int, seconds: float = MINUTE, times: Iterable[float] = (), clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.limit, self.seconds, self.clock, self.sleep = limit, seconds, clock, sleep
        self.times = sorted(times)

    def slot(self) -> float:
        """The time of the next call, be it now or later."""
        now = self.clock()
        return now if self.limit <= 0 or len(self.times) < self.limit else max(now, self.times[-self.limit] + self.seconds)

    def take(self) -> None:
        """Wait for the next slot and note the call."""
        at = self.slot()
        while (early := at - self.clock()) > 0:
            self.sleep(early)
        self.times.append(max(at, self.clock()))


def schedule(attempts: int, backoff: float) -> list[float]:
    """Seconds to wait before each attempt."""
    if attempts < 1:
        raise ValueError("attempts must be 1 or more")
    return [backoff * k for k in range(attempts)]


def fetch(get: Callable[[], str], waits: Iterable[float], calls: CallTimes, sleep: Callable[[float], None] = time.sleep) -> str:
    """What ``get`` gives at the first of the attempts that doesn't fail."""
    said: list[Exception] = []
    for wait in waits:
        if wait:
            sleep(wait)
        calls.take()
        try:
            return get()
        except Exception as e:  # whatever a transport may raise
            said.append(e)
    raise RuntimeError(f"no answer after {len(said)} attempts: {said[-1]}") from said[-1]


def rate_limited(payload: str) -> bool:
    """Whether a payload of prices says, instead of values, that a rate limit was reached."""
    try:
        said = json.loads(payload)
    except ValueError:
        return False
    if not isinstance(said, dict) or isinstance(said.get("values"), list):
        return False
    return "rate limit" in str(said.get("message") or said.get("status") or "").lower()


def asked_again(get: Callable[[], str], sleep: Callable[[float], None] = time.sleep, pause: float = PAUSE) -> tuple[str, str | None]:
    """A payload, and the one before it if that said that a rate limit was reached: then ``get`` is called once more after ``pause`` seconds."""
    first = get()
    if not rate_limited(first):
        return first, None
    sleep(pause)
    return get(), first


# --- transports -----------------------------------------------------------------


def replay(kind: str, symbol: str, options: dict[str, str]) -> str:
    """A payload kept as <folder>/<symbol with / as _>.json."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(options["folder"])
    with system.open_input_stream(f"{path}/{symbol.replace('/', '_')}.json") as f:
        return f.read().decode()


def http(kind: str, symbol: str, options: dict[str, str]) -> str:
    """The provider's answer. Options come in lower case; the key itself is in none."""
    key = os.environ.get(options.get("keyenv", ""), "")
    request = Request(url(kind, options["base"], symbol, key, options), headers={"User-Agent": "tidebook"})
    with urlopen(request, timeout=float(options.get("timeout", TIMEOUT))) as answer:
        return answer.read().decode()


# --- the source -----------------------------------------------------------------


class SymbolPartition(InputPartition):
    def __init__(self, symbols: list[str]):
        self.symbols = symbols


class PayloadReader(DataSourceReader):
    def __init__(self, options: dict[str, str], transports: dict[str, Transport]):
        self.options = dict(options)
        self.transport = transports[self.options.get("transport", "replay")]
        self.symbols = json.loads(self.options["symbols"])
        self.limit = int(self.options.get("perminute", "0"))

    def partitions(self) -> list[SymbolPartition]:
        size = len(self.symbols) if self.limit > 0 else max(1, int(self.options.get("symbolspertask", "1")))
        return [SymbolPartition(self.symbols[k : k + size]) for k in range(0, len(self.symbols), max(1, size))]

    def call_times(self, times: Iterable[float]) -> CallTimes:
        return CallTimes(self.limit, float(self.options.get("windowseconds", MINUTE)), times)

    def ask(self, symbol: str, calls: CallTimes) -> tuple:
        """A symbol's row, whatever becomes of it; its calls are added to ``calls``."""
        said = self.options
        provider, kind = said.get("provider", ""), said.get("kind", "bar_list")
        waits, pause = schedule(int(said.get("attempts", ATTEMPTS)), float(said.get("backoff", BACKOFF))), float(said.get("pause", PAUSE))
        before, payload, earlier, error = len(calls.times), None, None, None

        def get() -> str:
            return fetch(lambda: self.transport(kind, symbol, said), waits, calls)

        try:
            payload, earlier = asked_again(get, pause=pause) if kind == "bar_list" else (get(), None)
        except Exception as e:  # a symbol's failure is a row
            error = f"{type(e).__name__}: {e}"
        return provider, symbol, payload, error, earlier, json.dumps(calls.times[before:])

    def read(self, partition: SymbolPartition) -> Iterator[tuple]:
        calls = self.call_times(json.loads(self.options.get("calledat", "[]")))
        for symbol in partition.symbols:
            yield self.ask(symbol, calls)


def register(spark: SparkSession, **transports: Transport) -> None:
    """Make the format known to a session, with ``transports`` of one's own beside http and replay."""
    ship(spark)
    known = {"http": http, "replay": replay, **transports}

    class PayloadSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "rest_payloads"

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> PayloadReader:
            return PayloadReader(self.options, known)

    spark.dataSource.register(PayloadSource)
