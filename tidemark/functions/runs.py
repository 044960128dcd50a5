"""Python aggregates called by tasks for one key after the other."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd


def latest_states(keys: list[str], latest: Callable, newest: Callable):
    """The aggregate over the runs of equal keys in sorted rows; a run's state goes on over the borders of batches."""
    def states(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # key, time and status of the run that may go on
        for frame in frames:
            if not len(frame):
                continue
            owners = list(zip(*(frame[k].tolist() for k in keys)))
            at, status = frame["_at"].to_numpy(), frame["_status"].to_numpy()
            begins = [0, *(i for i in range(1, len(owners)) if owners[i] != owners[i - 1]), len(owners)]
            found = []
            for begin, end in zip(begins, begins[1:]):
                own, times, values = owners[begin], at[begin:end], status[begin:end]
                if held is not None and held[0] == own:
                    times, values = np.append(times, held[1]), np.append(values, held[2])
                elif held is not None:
                    found.append((*held[0], *held[1:]))
                held = own, newest(times), latest(times, values)
            yield pd.DataFrame(found, columns=[*keys, "_at", "_status"])
        if held is not None:
            yield pd.DataFrame([(*held[0], *held[1:])], columns=[*keys, "_at", "_status"])

    return states
