"""Per-client sliding rate limit: at most ``limit`` accepted requests per window.

A request is accepted when fewer than ``limit`` accepted requests of its client
lie within the last ``window`` seconds; rejected ones leave no trace. That is a
running decision, not a count over a frame, so batch and stream share one small
function over sorted times.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import fixed


#: Buckets of clients whose requests of a micro-batch are decided together; a checkpoint keeps the number for life.
BUCKETS = 4096


def admit(times: np.ndarray, accepted: deque, window: int, limit: int) -> np.ndarray:
    """Decide sorted times one by one; ``accepted`` is carried over and updated.

    While the record is full everything up to the moment its oldest entry
    expires is rejected at once, so the work goes with the accepted requests,
    however many are turned away.
    """
    verdicts = np.zeros(len(times), dtype=bool)
    i = 0
    while i < len(times):
        now = int(times[i])
        while accepted and accepted[0] <= now - window:
            accepted.popleft()
        if len(accepted) < limit:
            accepted.append(now)
            verdicts[i] = True
            i += 1
        elif not accepted:
            break
        else:
            i += int(np.searchsorted(times[i:], accepted[0] + window, side="left"))
    return verdicts


def in_order(at: np.ndarray, who: np.ndarray, us: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Those rows ``at`` by client number, time and key, null keys last."""
    exact = us[at].astype("int64")
    if keys.dtype.kind == "i":
        return at[np.lexsort((keys[at], exact, who[at]))]
    rows = pd.DataFrame({"who": who[at], "us": exact, "key": keys[at]})
    return at[rows.sort_values(["who", "us", "key"], na_position="last", kind="stable").index.to_numpy()]


def _micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def rate_limit(
    df: DataFrame,
    client: str,
    timestamp: str,
    key: str,
    window_seconds: int = fixed.RATE_WINDOW_SECONDS,
    limit: int = fixed.RATE_LIMIT,
) -> DataFrame:
    """Add ``accepted``; ties in time are decided in key order.

    Requests without a client count as those of one unknown client. A request
    without a time cannot be placed in a window and is not accepted. A client
    without pauses is decided in one task, in the order of time, as the rule
    asks for; its rows stream through.

    A pause of a full window empties a client's record, so a client's history
    falls apart into independent runs there. Runs are found from one row per
    client and window-long time cell. Runs of at most ``limit`` requests are
    accepted as they are; the others are sorted per run and streamed through
    ``admit`` in Arrow batches, which keeps no more than ``limit`` times.
    """
    window = int(window_seconds * 1_000_000)
    who = F.concat(F.when(F.col(client).isNull(), "unknown").otherwise("known:"), F.coalesce(F.col(client).cast("string"), F.lit("")))
    placed = df.withColumn("__us", _micros(timestamp)).withColumn("__who", who)
    timeless = placed.where(F.col("__us").isNull()).select(*df.columns, F.lit(False).alias("accepted"))
    timed = placed.where(F.col("__us").isNotNull()).withColumn("__cell", F.floor(F.col("__us") / F.lit(window)))
    cells = timed.groupBy("__who", "__cell").agg(
        F.min("__us").alias("a"), F.max("__us").alias("b"), F.count(F.lit(1)).alias("n")
    )
    along = Window.partitionBy("__who").orderBy("__cell")
    starts = F.coalesce(F.col("a") - F.lag("b").over(along) >= window, F.lit(True)).cast("int")
    marked = cells.withColumn("starts", starts)
    runs = marked.withColumn("__run", F.sum("starts").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = runs.withColumn("__n", F.sum("n").over(Window.partitionBy("__who", "__run"))).select(
        "__who", "__cell", "__run", "__n"
    )
    tagged = timed.join(sizes, ["__who", "__cell"])
    calm = tagged.where(F.col("__n") <= limit).select(*df.columns, F.lit(True).alias("accepted"))
    busy = tagged.where(F.col("__n") > limit).select(*df.columns, "__who", "__run", "__us")

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, accepted = None, deque()
        for pdf in batches:
            verdicts = np.empty(len(pdf), dtype=bool)
            clients, run_ids, times = pdf["__who"].to_numpy(), pdf["__run"].to_numpy(), pdf["__us"].to_numpy()
            changes = np.flatnonzero((clients[1:] != clients[:-1]) | (run_ids[1:] != run_ids[:-1])) + 1
            bounds = [0, *changes.tolist(), len(pdf)]
            for a, b in zip(bounds, bounds[1:]):
                if a == b:
                    continue
                if (clients[a], run_ids[a]) != current:
                    current, accepted = (clients[a], run_ids[a]), deque()
                verdicts[a:b] = admit(times[a:b], accepted, window, limit)
            yield pdf.drop(columns=["__who", "__run", "__us"]).assign(accepted=verdicts)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", accepted boolean"
    decided = (
        busy.repartition("__who", "__run")
        .sortWithinPartitions("__who", "__run", "__us", key)
        .mapInPandas(decide, schema)
    )
    return calm.unionByName(decided).unionByName(timeless)


def stream_rate_limit(
    stream: DataFrame,
    client: str,
    timestamp: str,
    key: str,
    window_seconds: int = fixed.RATE_WINDOW_SECONDS,
    limit: int = fixed.RATE_LIMIT,
    tolerance_seconds: int | None = None,
    exempt: Column | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The same decision with the accepted times of the clients in the state store.

    Gives client, key, us, accepted, late and the columns ``carry`` for every
    request. One that comes in a later batch than a later request of its
    client is marked late and is decided as if it came when that one did, as a
    live service would. A request without a time is not accepted; those
    without a client are one unknown client's. Requests that are ``exempt``
    pass by: they use up nothing and their ``accepted`` is null.

    Forgetting goes by the times of the requests alone, however fast or slow
    they are processed: a client is forgotten when the latest request of all
    clients is more than a window and ``tolerance_seconds`` (by default
    another window) behind its own last one. Only a request that is later than
    that finds its client forgotten.

    Clients are dealt to ``BUCKETS`` buckets that are decided in one call and
    kept in one state row each, for a call costs as much as thousands of rows;
    a bucket is called when the first of its clients may be forgotten. A
    bucket's rows of one micro-batch are held and sorted in memory at once.
    """
    window = int(window_seconds * 1_000_000)
    kinds = dict(stream.dtypes)
    out = ["client", "key", "us", "accepted", "late", *carry]

    def decide(group, batches, state: GroupState):
        known, now = {r[0]: tuple(r[1:]) for r in state.get[0]} if state.exists else {}, state.getCurrentWatermarkMs()
        fresh = {}
        if not state.hasTimedOut:
            # The Arrow batches of a group come in no order: all of the micro-batch are sorted together.
            found = list(batches)
            pdf = found[0] if len(found) == 1 else pd.concat(found, ignore_index=True)
            free, us = pdf["exempt"].to_numpy(dtype=bool), pdf["us"].to_numpy()
            who, clients = pd.factorize(pdf["client"], use_na_sentinel=False)
            clients = [None if pd.isna(c) else c for c in clients.tolist()]
            at = in_order(np.flatnonzero(~(free | pd.isna(us))), who, us, pdf["key"].to_numpy())
            times = us[at].astype("int64")
            late, verdicts = np.zeros(len(pdf), dtype=bool), np.zeros(len(pdf), dtype=bool)
            bounds = [0, *(np.flatnonzero(np.diff(who[at])) + 1).tolist(), len(at)]
            for a, b in zip(bounds, bounds[1:]):
                if a == b:
                    continue
                client, exact, rows = clients[who[at[a]]], times[a:b], at[a:b]
                held, last, _ = known.pop(client, ((), None, None))
                accepted = deque(held)
                if last is not None:
                    late[rows] = exact < last
                    exact = np.maximum(exact, last)
                verdicts[rows] = admit(exact, accepted, window, limit)
                last = int(exact[-1])
                fresh[client] = (list(accepted), last, max((last + window) // 1000 + 1, now + 1))
            # Requests without a time and exempt ones keep their client from being forgotten in this batch.
            seen = {*clients}
            known = {
                c: (held, last, max((last + window) // 1000 + 1, now + 1) if c in seen else until)
                for c, (held, last, until) in known.items() if until >= now or c in seen
            }
            pdf["accepted"], pdf["late"] = pd.arrays.BooleanArray(verdicts, free), late
            yield pdf[out]
        else:
            known = {c: r for c, r in known.items() if r[2] >= now}
        known.update(fresh)
        if known:
            state.update(([(c, *r) for c, r in known.items()],))
            state.setTimeoutTimestamp(max(min(r[2] for r in known.values()), now))
        elif state.exists:
            state.remove()

    # The watermark follows the times of the requests. A request itself goes on without that time, beside a copy that ends
    # here with it: so none is dropped for being behind the watermark.
    time = F.col(timestamp).cast("timestamp")
    unset = F.lit(None).cast("timestamp")
    rows = stream.select(
        F.col(client).alias("client"), F.col(key).alias("key"), F.unix_micros(time).alias("us"),
        F.coalesce(F.lit(False) if exempt is None else exempt, F.lit(False)).alias("exempt"), *carry,
        F.explode(F.when(time.isNull(), F.array(unset)).otherwise(F.array(unset, time))).alias("clock"),
    )
    tolerance = window_seconds if tolerance_seconds is None else tolerance_seconds
    rows = rows.withWatermark("clock", f"{int(tolerance * 1000)} milliseconds").where(F.col("clock").isNull())
    carried = "".join(f", `{c}` {kinds[c]}" for c in carry)
    # Numbers that may be null are read as doubles, so clients that are null stay apart from the others.
    bucket = F.when(F.col("client").isNull(), -1).otherwise(F.pmod(F.xxhash64("client"), F.lit(BUCKETS)).cast("int"))
    return rows.withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(
        decide,
        outputStructType=f"client {kinds[client]}, key {kinds[key]}, us bigint, accepted boolean, late boolean{carried}",
        stateStructType=f"clients array<struct<client: {kinds[client]}, accepted: array<bigint>, last: bigint, until: bigint>>",
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )
