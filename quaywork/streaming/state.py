"""Keyed state for the jobs that fold events as they arrive.

A processor sees the rows of one micro-batch that belong to one key or, where
keys are many, to one bucket of keys: a call costs far more than a row, and so
would be most of the work if every key had its own.  The size of a micro-batch
is bounded by the source (``maxFilesPerTrigger`` or ``maxBytesPerTrigger``),
and the state kept per key is one small row; those of a bucket are read and
written together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _row(**fields: type[DataType]) -> StructType:
    # Built from types: parsing DDL text needs a session, which workers lack.
    return StructType([StructField(name, kind()) for name, kind in fields.items()])


def _ordered(chunks: Iterator[pd.DataFrame]) -> pd.DataFrame:
    rows = list(chunks)
    return (rows[0] if len(rows) == 1 else pd.concat(rows)).sort_values(["EventMicros", "EventId"])


#: Column that holds the bucket of a key.
BUCKET = "Bucket"
def _by_key(chunks: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[str | None, pd.DataFrame]]:
    """The rows of each key of a bucket in order of time; keys come as text or None."""
    batch = _ordered(chunks)
    codes, keys = pd.factorize(batch[key], use_na_sentinel=False)
    batch = batch.iloc[np.argsort(codes, kind="stable")]
    ends = np.cumsum(np.bincount(codes, minlength=len(keys))).tolist()
    for name, low, high in zip(keys, [0, *ends], ends):
        yield (None if pd.isna(name) else name), batch.iloc[low:high]


def _ids(keys: Iterable[str | None]) -> pd.Series:
    return pd.Series(pd.array([None if k is None else int(k) for k in keys], dtype="Int64"))


class _Known:
    """State of the keys of one bucket, one row a key; read and written as a whole."""

    def __init__(self, handle: StatefulProcessorHandle, value: StructType):
        self._rows = handle.getListState("known", StructType([StructField("key", StringType()), *value.fields]))

    def load(self) -> dict[str | None, tuple]:
        return {key: tuple(value) for key, *value in self._rows.get()}

    def save(self, rows: dict[str | None, tuple]) -> None:
        if rows:
            self._rows.put([(key, *value) for key, value in rows.items()])
        else:
            self._rows.clear()


class OrderState(StatefulProcessor):
    """Current status of an order under its transition events."""

    KEY = "WMSOrderHeaderStagingId"
    STATE = _row(
        status=StringType, attempts=IntegerType, attempt=LongType, processed=LongType, error=StringType
    )
    OUTPUT = (
        "WMSOrderHeaderStagingId bigint, IntegrationStatus string, AttemptCount int, "
        "LastAttemptMicros bigint, ProcessedMicros bigint, ErrorMessage string"
    )

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._orders = _Known(handle, self.STATE)

    def handleInputRows(self, key, rows, timerValues):
        known, found = self._orders.load(), {}
        for order, batch in _by_key(rows, self.KEY):
            status, attempts, attempt, processed, error = known.get(order, ("READY", 0, None, None, None))
            events = zip(batch["Action"].tolist(), batch["EventMicros"].tolist(), batch["Message"].tolist())
            for action, when, message in events:
                if action == "SENT":
                    if status not in ("READY", "FAILED"):
                        continue
                    status, attempts, attempt, error = "SENT", attempts + 1, int(when), None
                elif action == "SUCCESS":
                    status, processed, error = "SUCCESS", int(when), None
                else:
                    status, attempt, error = "FAILED", int(when), message
            found[order] = (status, attempts, attempt, processed, error)
        self._orders.save(known | found)
        status, attempts, attempt, processed, error = zip(*found.values())
        yield pd.DataFrame(
            {
                "WMSOrderHeaderStagingId": _ids(found),
                "IntegrationStatus": status,
                "AttemptCount": pd.array(attempts, dtype="Int32"),
                "LastAttemptMicros": pd.array(attempt, dtype="Int64"),
                "ProcessedMicros": pd.array(processed, dtype="Int64"),
                "ErrorMessage": error,
            }
        )

    def close(self) -> None:
        pass


class RateWindow(StatefulProcessor):
    """Open rate window of a key: its start and the requests in it."""

    STATE = _row(start=LongType, count=LongType)

    def __init__(self, seconds: int, limit: int):
        self._width = seconds * 1_000_000
        self._limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._window = handle.getValueState("window", self.STATE)

    def handleInputRows(self, key, rows, timerValues):
        batch = _ordered(rows)
        start, count = self._window.get() if self._window.exists() else (None, 0)
        times = batch["EventMicros"].to_numpy()
        ranks = np.empty(len(times), np.int64)
        low = 0
        while low < len(times):
            if start is None or times[low] - start > self._width:
                start, count = int(times[low]), 0
            # All requests up to the end of the open window at once.
            high = int(np.searchsorted(times, start + self._width, "right"))
            ranks[low:high] = np.arange(count + 1, count + 1 + high - low)
            count, low = count + high - low, high
        self._window.update((start, count))
        yield pd.DataFrame({"Key": key[0], "EventId": batch["EventId"], "Denied": ranks > self._limit})

    def close(self) -> None:
        pass


class StaleStay(StatefulProcessor):
    """One alert per stay in a monitored gate that outlasts the threshold."""

    KEY = "ItemId"
    STATE = _row(entered=LongType, alerted=BooleanType)
    OUTPUT = "ItemId bigint, EnteredMicros bigint"

    def __init__(self, minutes: int):
        self._patience = minutes * 60_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._stays = _Known(handle, self.STATE)

    def _alerts(self, due):
        items, entered = zip(*due)
        return pd.DataFrame({"ItemId": _ids(items), "EnteredMicros": entered})

    def _deadline(self, entered):
        # Timers know milliseconds; round up so none fires early.
        return (entered + self._patience) // 1000 + 1

    def _keep(self, stays):
        """Write the stays and set the bucket's timer to the next deadline."""
        self._stays.save(stays)
        waiting = [self._deadline(entered) for entered, alerted in stays.values() if not alerted]
        if waiting:
            self._handle.registerTimer(min(waiting))

    def handleInputRows(self, key, rows, timerValues):
        due, stays = [], self._stays.load()
        for item, batch in _by_key(rows, self.KEY):
            entered, alerted = stays.pop(item, (None, False))
            for when, enters in zip(batch["EventMicros"].tolist(), batch["Enters"].tolist()):
                if entered is not None and not alerted and when - entered > self._patience:
                    due.append((item, entered))
                    alerted = True
                if enters and entered is None:
                    entered, alerted = int(when), False
                elif not enters:
                    entered, alerted = None, False
            if entered is not None:
                stays[item] = (entered, alerted)
        self._keep(stays)
        if due:
            yield self._alerts(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # One timer serves all stays of the bucket that are due by now; those that have ended are gone.
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        stays = self._stays.load()
        due = [(i, entered) for i, (entered, alerted) in stays.items() if not alerted and self._deadline(entered) <= now]
        if due:
            self._keep(stays | {item: (entered, True) for item, entered in due})
            yield self._alerts(due)
        else:
            self._keep(stays)

    def close(self) -> None:
        pass


class SessionProgress(StatefulProcessor):
    """Latest progress of a build session, folded event by event."""

    KEY = "CRNumber"
    STATE = _row(
        session=StringType,
        tokens=LongType,
        action=StringType,
        cost=DoubleType,
        subtype=StringType,
        updated=LongType,
    )
    OUTPUT = (
        "CRNumber bigint, SessionId string, TokensSoFar bigint, LastAction string, CostUsd double, "
        "ResultSubtype string, UpdatedMicros bigint"
    )

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._progress = _Known(handle, self.STATE)

    def _fold(self, known, batch):
        session, tokens, action, cost, subtype, updated = known
        columns = ("EventType", "Subtype", "SessionId", "InputTokens", "OutputTokens", "StatusDetail", "TotalCostUsd")
        for kind, sub, named, taken, given, detail, total in zip(*[batch[c].tolist() for c in columns]):
            if not pd.isna(named):
                session = named
            if kind == "assistant":
                tokens += sum(int(n) for n in (taken, given) if not pd.isna(n))
            elif kind == "system" and sub == "post_turn_summary":
                action = detail or ""
            elif kind == "result":
                cost, subtype = float("nan" if total is None else total), sub
        return session, tokens, action, cost, subtype, max(updated, int(batch["EventMicros"].iloc[-1]))

    def handleInputRows(self, key, rows, timerValues):
        known, found = self._progress.load(), {}
        for request, batch in _by_key(rows, self.KEY):
            found[request] = self._fold(known.get(request, (None, 0, None, None, None, 0)), batch)
        self._progress.save(known | found)
        session, tokens, action, cost, subtype, updated = zip(*found.values())
        yield pd.DataFrame(
            {
                "CRNumber": _ids(found),
                "SessionId": session,
                "TokensSoFar": tokens,
                "LastAction": action,
                "CostUsd": pd.array(cost, dtype="Float64"),
                "ResultSubtype": subtype,
                "UpdatedMicros": updated,
            }
        )

    def close(self) -> None:
        pass
