"""Linear recurrences over long series as a parallel scan."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.operators import series, sizing
from gridweave.session import stage

#: Rows of a chunk, in whole blocks of the longest lag.
CHUNK_BLOCKS = 1024


def block_maps(weights: Sequence[float], lags: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """(M, L) with `block = M @ block_before + L @ inputs` for the recurrence `y[t] = u[t] + sum(w * y[t - lag])`.

    A block has as many values as the longest lag, so it is the whole state the next one needs.
    """
    width = max(lags)
    rows = np.zeros((width, 2 * width))  # each value of the block in terms of the block before and the inputs
    for t in range(width):
        rows[t, width + t] = 1.0
        for weight, lag in zip(weights, lags, strict=True):
            if lag > t:
                rows[t, width + t - lag] += weight
            else:
                rows[t] += weight * rows[t - lag]
    return rows[:, :width], rows[:, width:]


def run_block(maps: tuple[np.ndarray, np.ndarray], state: np.ndarray, inputs: np.ndarray) -> np.ndarray:
    """Values for inputs in order, from the block of values before them."""
    through, own = maps
    width, n = len(state), len(inputs)
    padded = np.zeros(-(-n // width) * width)
    padded[:n] = inputs
    driven = padded.reshape(-1, width) @ own.T
    for block in driven:
        block += through @ state
        state = block
    return driven.ravel()[:n]


def recur(
    rows: DataFrame, starts: DataFrame, keys: Sequence[str], order: Sequence[str], inputs: str, lags: Sequence[int], *,
    out: str = "value", chunk_blocks: int = CHUNK_BLOCKS, row_bound: int | None = None,
) -> DataFrame:
    """Add `out`, the recurrence `y[t] = inputs[t] + sum(weights * y[t - lag])` along each series of `rows`.

    `starts` has a row per series: `keys`, `weights` (an array as long as `lags`) and `start` (the values before the first row,
    oldest first, as many as the longest lag). Rows without a start or an input give null from there on.

    A series is cut into chunks. Each chunk's own response to its inputs, from a state of zeros, is worked out in
    parallel; the map through a chunk is a power of the block map, so the state at the beginning of every chunk follows from a
    few numbers per chunk; then all chunks are run in parallel from their states. The result is that of one pass in order.
    """
    keys, lags, columns = list(keys), list(lags), rows.columns
    width = max(lags)
    size = width * chunk_blocks
    indexed = series.series_index(rows, keys, order, name="__pos", size="__n", row_bound=row_bound)
    prepared = sizing.attach_lookup(indexed, starts.select(*keys, "weights", "start"), keys)
    prepared = prepared.withColumn("__chunk", F.floor(F.col("__pos") / size)).withColumn("__input", F.col(inputs).cast("double"))
    prepared = stage(prepared, "recurrence")
    by_chunk = [*keys, "__chunk"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    key_schema = "".join(f"`{k}` {kinds[k]}, " for k in keys)

    def response(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("__pos")
        first = frame.iloc[0]
        maps = block_maps(first["weights"], lags)
        last = run_block(maps, np.zeros(width), frame["__input"].to_numpy())[-width:]
        return pd.DataFrame([[*[first[k] for k in keys], first["__chunk"], first["weights"], first["start"], last.tolist()]], columns=[*keys, "__chunk", "weights", "start", "last"])

    # The last chunk of a series hands no state on.
    through = prepared.where((F.col("__chunk") < F.floor((F.col("__n") - 1) / size)) & F.col("weights").isNotNull())
    responses = through.select(*by_chunk, "__pos", "__input", "weights", "start").groupBy(*by_chunk).applyInPandas(
        response, f"{key_schema}__chunk long, weights array<double>, start array<double>, last array<double>")

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        """A few numbers per chunk, in order."""
        frame = frame.sort_values("__chunk")
        whole = np.linalg.matrix_power(block_maps(frame.iloc[0]["weights"], lags)[0], chunk_blocks)
        state, states = np.array(frame.iloc[0]["start"], float), []
        for last in frame["last"]:
            state = whole @ state + np.array(last)
            states.append(state.tolist())
        return pd.DataFrame({**{k: frame[k] for k in keys}, "__chunk": frame["__chunk"] + 1, "__state": states})

    states = responses.groupBy(*keys).applyInPandas(combine, f"{key_schema}__chunk long, __state array<double>")
    begun = prepared.join(stage(states, "states"), by_chunk, "left").withColumn("__state", F.coalesce("__state", "start"))
    types = ", ".join(f"`{c}` {kinds[c]}" for c in columns)

    def replay(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("__pos")
        first = frame.iloc[0]
        if first["weights"] is None or first["__state"] is None:
            values = np.full(len(frame), np.nan)
        else:
            values = run_block(block_maps(first["weights"], lags), np.array(first["__state"], float), frame["__input"].to_numpy())
        return frame[columns].assign(**{out: values})

    replayed = begun.select(*columns, *[c for c in ("__pos", "__chunk", "__input", "weights", "__state")])
    made = replayed.groupBy(*by_chunk).applyInPandas(replay, f"{types}, `{out}` double")
    return made.withColumn(out, F.nanvl(out, F.lit(None).cast("double")))


def dot(weights: Column, terms: Sequence[Column], first: int = 0) -> Column:
    """Sum of terms times the elements of an array, from its element `first` on."""
    total = F.lit(0.0)
    for k, term in enumerate(terms):
        total = total + F.get(weights, F.lit(first + k)) * term
    return total
