"""Sinks: rows {data, samplerate, time}, as tables, JSON text, or batches posted over HTTP."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.transforms import drop_unsampled

#: Events in a batch; statuses that are tried again.
BATCH = 50
RETRY = (429, 500)


def outgoing(events: DataFrame) -> DataFrame:
    """(time, samplerate, data) of events that were not sampled out."""
    rows = drop_unsampled(events)
    return rows.select(F.col("timestamp").alias("time"), F.greatest(F.coalesce("sample_rate", F.lit(1)), F.lit(1)).alias("samplerate"), "data")


def as_json(events: DataFrame) -> DataFrame:
    """One JSON object a row: the debugging form."""
    return outgoing(events).select(F.to_json(F.struct("data", "samplerate", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("time"))).alias("value"))


def post(url: str, body: bytes, headers: dict[str, str], timeout: float = 30) -> tuple[int, str]:
    request = urllib.request.Request(url, body, headers | {"Content-Type": "application/json"}, method="POST")
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return r.status, r.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")


def batch_url(api_host: str, dataset: str) -> str:
    """Where batches of a dataset are posted."""
    return f"{api_host.rstrip('/')}/1/batch/{urllib.parse.quote(dataset, safe='')}"


def _statuses(status: int, text: str, n: int) -> list[int]:
    """A status for each of n events: the answer's list of them if it has one, else the batch's."""
    try:
        told = json.loads(text)
        if isinstance(told, list) and len(told) == n:
            return [int(x.get("status", status)) for x in told]
    except (ValueError, AttributeError, TypeError):
        pass
    return [status] * n


def send(events: DataFrame, url: str, headers: dict[str, str] | None = None, batch: int = BATCH, backoff: bool = False, delay: float = 0.012, most_tries: int | None = None, poster: Callable | None = None) -> DataFrame:
    """Posts batches and returns the last response for each event (at, status, body, err, duration_ns), lazily: an action sends.

    With ``backoff``, events whose own status, or whose batch's, is in RETRY are posted again after a growing delay (3 seconds at most), until they have
    another one; most_tries limits that. A task that is run again posts again: delivery is at least once.
    """
    headers, poster = headers or {}, poster or post

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for i in range(0, len(f), batch):
                left, tries = f["value"].iloc[i : i + batch].tolist(), 0
                while left:
                    began = time.time_ns()
                    try:
                        status, text = poster(url, ("[" + ",".join(left) + "]").encode(), headers)
                        err = ""
                    except OSError as e:
                        status, text, err = 0, "", str(e)
                    tries += 1
                    again = backoff and (most_tries is None or tries < most_tries)
                    each = list(zip(left, _statuses(status, text, len(left)), strict=True))
                    done = [(x, n) for x, n in each if not again or n not in RETRY]
                    left = [x for x, n in each if again and n in RETRY]
                    if done:
                        yield pd.DataFrame({"at": pd.Timestamp(began // 1000, unit="us"), "status": [n for _, n in done], "body": text, "err": err, "duration_ns": time.time_ns() - began, "event": [x for x, _ in done]})
                    if left:
                        time.sleep(min(delay * 2 ** min(tries, 8), 3.0))

    return as_json(events).mapInPandas(run, "at timestamp, status int, body string, err string, duration_ns long, event string")


def write_table(events: DataFrame, path: str, mode: str = "append") -> None:
    """The default sink: Parquet, data as JSON text."""
    outgoing(events).withColumn("data", F.to_json("data")).write.mode(mode).parquet(path)
