"""Sliding windows by the time at which rows arrive, in a stream."""

from pyspark.sql.streaming.state import GroupStateTimeout

from tidegauge.operators.stats import BY, milliseconds

_SUMS = ("count", "sum", "max", "min")


def arrival_windows(rows, metrics=("psi",), length="6 seconds", slide="2 seconds", by=BY):
    """Count and extremes of the rows of each group that arrived in the last ``length``.

    Rows belong to the pane of ``slide`` in which their batch begins, by the clock. A group gives a
    row for the window that ends with the present pane, in every batch with rows of its own and in
    the first batch of each later pane until its rows are older than ``length``; then nothing is kept
    of it. So with a batch every ``slide`` a window is the last ``length / slide`` batches. A later
    row for one window replaces an earlier one (update mode).

    Each task adds up its rows by group first, so a group with a third of all rows sends no more
    than any other. The state of a group is one entry for each pane, ``length / slide`` at most.
    Null metrics are left out as in ``sensor_stats``, rows without resid are not counted.
    """
    step, span = milliseconds(slide), milliseconds(length)
    if span % step:
        raise ValueError("the length must be a multiple of the slide")
    depth, metrics, by = span // step, list(metrics), list(by)
    names = ["rows"] + [f + m for m in metrics for f in _SUMS]
    kinds = ["long"] + ["long", "double", "double", "double"] * len(metrics)
    keys = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by)
    sums = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))
    merge = {n: "max" if n.startswith("max") else "min" if n.startswith("min") else "sum"
             for n in names}

    # Both functions stand by themselves, so that they travel to the workers without the package.
    def add_up(frames):
        for frame in frames:
            if not len(frame):
                continue
            groups = frame.groupby(by, dropna=False, sort=False)
            out = groups["resid"].count().rename("rows").to_frame()
            for m in metrics:
                out["count" + m] = groups[m].count()
                out["sum" + m] = groups[m].sum()
                out["max" + m] = groups[m].max()
                out["min" + m] = groups[m].min()
            yield out.reset_index()[[*by, *names]]

    def slide_on(key, frames, state):
        import json

        import pandas as pd

        now_ms = state.getCurrentProcessingTimeMs()
        pane = now_ms // step
        held = json.loads(state.get[0]) if state.exists else []
        held = [h for h in held if h[0] > pane - depth]
        if not state.hasTimedOut:
            mine = [pd.DataFrame([h[1] for h in held if h[0] == pane], columns=names)]
            whole = pd.concat([f for f in [*mine, *(f[names] for f in frames)] if len(f)])
            total = whole.agg(merge)
            held = [h for h in held if h[0] != pane]
            held.append([pane, [None if pd.isna(total[n]) else float(total[n]) for n in names]])
        if not held:
            state.remove()
            return
        state.update((json.dumps(held),))
        state.setTimeoutDuration(int((pane + 1) * step - now_ms) or 1)
        window = pd.DataFrame([h[1] for h in held], columns=names).astype(float).agg(merge)
        row = {c: [v] for c, v in zip(by, key, strict=True)}
        row["w_start"] = [pd.Timestamp((pane + 1) * step - span, unit="ms")]
        row["total"] = [int(window["rows"])]
        for m in metrics:
            n = window["count" + m]
            row["max" + m], row["min" + m] = [window["max" + m]], [window["min" + m]]
            row["avg" + m] = [window["sum" + m] / n if n else None]
        yield pd.DataFrame(row)[["w_start", *by, "total", *[
            p + m for m in metrics for p in ("max", "min", "avg")]]]

    partial = rows.select(*by, *metrics).mapInPandas(add_up, f"{keys}, {sums}")
    found = partial.groupBy(*by).applyInPandasWithState(
        slide_on,
        f"w_start timestamp, {keys}, total long" + "".join(
            f", `{p}{m}` double" for m in metrics for p in ("max", "min", "avg")),
        "panes string", "update", GroupStateTimeout.ProcessingTimeTimeout)
    return found
