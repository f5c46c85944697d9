"""Readings out of line with what is normal for their source: spikes, stuck values, impossible values.

The differences of every component follow a second-order autoregression whose coefficients and noise
are fitted robustly per source (histograms of absolute differences and winsorised covariances, summed
over all readings of the source).  The residuals of each series are then tested for additive outliers
and level shifts, whose effects are removed and the rest tested again until nothing is left.  Where the
effects leave a level and come back to it within three readings, by far more than the noise of the source
and of the residuals around, is a spike if the values themselves agree (an exact check); a level shift
that stays is normal.

A series is cut into chunks of successive sequence numbers with a margin on both sides, so one long
series or one large source is spread over many tasks.  The values are exchanged once, by chunk, for the
fit and the tests; a second, light scan (without the values) tells the source of each chunk, by which
the fitted parameters come back to the chunks in a join, never by way of the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillframe.session import broadcast_if_small, floor_div

MARGIN = 1024  # sequence numbers of context on either side of a chunk
RUN = 20  # successive equal values that make a stuck run
LONGEST = 3  # readings of the longest spike
_PER_OCTAVE, _LOW, _BINS = 8, -24, 8 * 64  # histograms of log2 |x| from 2**-24 to 2**40
_FIT = 5  # parameters per component: noise, spread, share of repeats, phi1, phi2

_STATS = "source string, topic string, comp int, n bigint, same bigint, steps array<int>, widths array<int>, cov array<double>"
_PARAMS = "source string, topic string, fit array<double>"


def _bin(x: np.ndarray) -> np.ndarray:
    return np.clip(((np.log2(x) - _LOW) * _PER_OCTAVE).astype(np.int64), 0, _BINS - 1)


def _quantile(counts: np.ndarray, zeros: float = 0, share: float = 0.5) -> float:
    """Quantile of a histogram with so many further zeros."""
    total = counts.sum() + zeros
    if total <= 0 or zeros > total * share:
        return 0.0
    at = int(np.searchsorted(np.cumsum(counts) + zeros, total * share))
    return float(2.0 ** (_LOW + (at + 0.5) / _PER_OCTAVE))


class Block:
    """Series of one Arrow table sorted by (bag, topic, chunk, seq), padded to the widest."""

    def __init__(self, rows: pa.Table):
        self.rows = rows
        code = [rows[c].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False) for c in ("bag", "topic")]
        chunk, seq = rows["chunk"].to_numpy(), rows["seq"].to_numpy()
        n = len(seq)
        fresh = np.ones(n, bool)
        fresh[1:] = (code[0][1:] != code[0][:-1]) | (code[1][1:] != code[1][:-1]) | (chunk[1:] != chunk[:-1])
        keep = fresh.copy()
        keep[1:] |= seq[1:] != seq[:-1]  # repeated rows count once
        self.at = np.flatnonzero(keep)
        self.fresh = fresh[keep]
        self.group = np.cumsum(self.fresh) - 1
        self.head = np.flatnonzero(self.fresh)
        self.tail = np.r_[self.head[1:], len(self.at)]
        values = rows["v"].combine_chunks()
        start = values.offsets.to_numpy()[self.at]
        size = (values.offsets.to_numpy()[1:] - values.offsets.to_numpy()[:-1])[self.at]
        flat = values.values.to_numpy(zero_copy_only=False).astype(float)
        self.width = int(size.max()) if len(size) else 0
        col = np.arange(self.width)
        inside = col < size[:, None]
        self.x = np.where(inside, flat[np.minimum(start[:, None] + col, len(flat) - 1)], np.nan) if len(flat) else np.full((len(size), self.width), np.nan)
        self.inside = inside

    def levels(self) -> np.ndarray:
        """Median of each series and component, on its rows; 0 where nothing is finite."""
        x = np.where(np.isfinite(self.x), self.x, np.nan)
        out = np.zeros_like(x)
        for a, b in zip(self.head, self.tail):
            part = np.sort(x[a:b], axis=0)  # not a number sorts last
            n = np.sum(~np.isnan(part), axis=0)
            out[a:b] = np.where(n > 0, part[np.maximum(n - 1, 0) // 2, np.arange(self.width)], 0.0)
        return out

    def steps(self, x: np.ndarray) -> np.ndarray:
        d = np.zeros_like(x)
        d[1:] = x[1:] - x[:-1]
        d[self.fresh] = np.nan
        return d


def _blocks(batches: Iterator[pa.RecordBatch], least: int = 1 << 16) -> Iterator[Block]:
    """Whole series only: rows of the last one wait for the next batch."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n < least:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        last = len(rows) - 1
        same = np.ones(len(rows), bool)
        for c in ("chunk", "topic", "bag"):
            same &= np.asarray(pa.compute.equal(rows[c], rows[c][last]).to_numpy(zero_copy_only=False), bool)
        cut = int(np.argmax(same))
        if cut:
            yield Block(rows.slice(0, cut).combine_chunks())
        rest = rows.slice(cut)
        held, n = rest.to_batches(), len(rest) if not cut else 0
        least = max(least, 2 * n)
    if held and sum(map(len, held)):
        yield Block(pa.Table.from_batches(held).combine_chunks())


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple, list] = {}

    def flush() -> pa.RecordBatch:
        keys = list(sums)
        cols = list(zip(*sums.values()))
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array([k[2] for k in keys], pa.int32()),
                pa.array([int(x) for x in cols[0]]), pa.array([int(x) for x in cols[1]]),
                *(pa.array([x.astype(np.int32) for x in c], pa.list_(pa.int32())) for c in cols[2:4]), pa.array(cols[4], pa.list_(pa.float64())),
            ],
            names=[x.split()[0] for x in _STATS.split(", ")],
        )
        sums.clear()
        return out

    for block in _blocks(batches):
        core = block.rows["core"].to_numpy(zero_copy_only=False)[block.at].astype(bool)
        d, wide = block.steps(block.x), np.abs(block.x - block.levels())
        source = block.rows["source"].combine_chunks().take(pa.array(block.at[block.head])).to_pylist()
        topic = block.rows["topic"].combine_chunks().take(pa.array(block.at[block.head])).to_pylist()
        for g, (a, b) in enumerate(zip(block.head, block.tail)):
            for j in range(int(block.inside[a].sum())):
                step, width = np.abs(d[a:b, j][core[a:b]]), wide[a:b, j][core[a:b]]
                step, width = step[np.isfinite(step)], width[np.isfinite(width)]
                s = sums.setdefault((source[g], topic[g], j), [0, 0, np.zeros(_BINS), np.zeros(_BINS), np.zeros(3)])
                moved = step[step > 0]
                s[0] += len(step)
                s[1] += len(step) - len(moved)
                s[2] += np.bincount(_bin(moved), minlength=_BINS)
                s[3] += np.bincount(_bin(width[width > 0]), minlength=_BINS)
                scale = np.median(step) if len(step) else 0.0
                if scale > 0:
                    w = np.clip(np.nan_to_num(d[a:b, j], posinf=0, neginf=0) / scale, -4, 4)
                    s[4] += [w @ w, w[1:] @ w[:-1], w[2:] @ w[:-2]]
        if len(sums) > 5000:
            yield flush()
    if sums:
        yield flush()


def fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    """Parameters of one source from its summed histograms and covariances."""
    fit = []
    for j in range(int(pdf.comp.max()) + 1):
        part = pdf[pdf.comp == j]
        if not len(part):
            fit += [0.0, 0.0, 1.0, 0.0, 0.0]
            continue
        n, same = part.n.sum(), part.same.sum()
        steps, widths, cov = (np.sum(np.stack(part[c].to_list()).astype(float), axis=0) for c in ("steps", "widths", "cov"))
        repeats = same / n if n else 1.0
        spread = _quantile(widths, share=0.95) / 2  # a source may rest at several levels
        noise = 1.4826 * _quantile(steps, same) if repeats < 0.5 else _quantile(widths, share=0.75)  # held values have no noise but a range
        phi = np.zeros(2)
        if cov[0] > 0:
            r1, r2 = cov[1] / cov[0], cov[2] / cov[0]
            if 1 - r1 * r1 > 1e-6:
                phi = np.clip([r1 * (1 - r2) / (1 - r1 * r1), (r2 - r1 * r1) / (1 - r1 * r1)], -0.95, 0.95)
        fit += [noise, spread, repeats, *phi]
    return pd.DataFrame({"source": [pdf.source.iloc[0]], "topic": [pdf.topic.iloc[0]], "fit": [fit]})


def _shifted(e: np.ndarray, group: np.ndarray, j: int) -> np.ndarray:
    """e at t + j within the same series, else 0."""
    out = np.zeros_like(e)
    if j < len(e):
        ok = group[j:] == group[: len(e) - j]
        out[: len(e) - j] = np.where(ok[:, None], e[j:], 0.0)
    return out


def interventions(x: np.ndarray, group: np.ndarray, noise: np.ndarray, phi: np.ndarray, critical: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """What additive outliers and level shifts add to each reading, by iterative testing and removal, and the residuals left.

    ``x`` (readings by components, no gaps), ``group`` (series of each reading), ``noise`` (of the
    differences; components without any are not tested) and ``phi`` (two coefficients) in the shape of x.
    Tested are outliers of one to three readings (a level shift and its cancellation) and lasting level
    shifts, each by the least-squares size of its pattern in the residuals of the autoregression.  Each
    series is tested until nothing is left in it, whatever its neighbours: the largest statistic of a
    series is always a find, finds are so far apart that their effects do not overlap, and each removal
    lowers the sum of squared residuals.
    """
    rows, y = np.arange(len(x)), x.copy()  # of the series with finds left
    clean, rest = x.copy(), np.zeros_like(x)
    p1, p2 = phi
    least = 1e-12 * np.max(np.abs(x), axis=0, initial=0.0)  # what rounding leaves is no find
    while len(rows):
        fresh = np.r_[True, group[1:] != group[:-1]]
        spread = _residual_share(p1, p2) * np.maximum(noise, 1e-300)
        d = np.zeros_like(y)
        d[1:] = y[1:] - y[:-1]
        d[fresh] = 0
        e = d.copy()
        for lag, p in ((1, p1), (2, p2)):
            ok = np.r_[np.zeros(min(lag, len(y)), bool), group[lag:] == group[:-lag]]
            e[lag:] -= np.where(ok[lag:, None], p[lag:] * d[:-lag], 0.0)
        rest[rows] = e
        ahead = [_shifted(e, group, j) for j in range(LONGEST + 3)]
        one, none = np.ones_like(p1), np.zeros_like(p1)
        shift = [one, -p1, -p2, *[none] * LONGEST]  # of the residuals after a lasting shift by one
        best, size, kind = none, none, np.zeros(y.shape, np.int8)
        for length in range(LONGEST + 1):  # 0: the shift lasts
            w = [shift[j] - (shift[j - length] if 0 < length <= j else 0.0) for j in range(LONGEST + 3)]
            power = sum(c * c for c in w)
            by = sum(c * a for c, a in zip(w, ahead)) / power
            stat = np.where((noise > 0) & (np.abs(by) > least), np.abs(by) * np.sqrt(power) / spread, 0.0)
            more = stat > best
            best, size, kind = np.where(more, stat, best), np.where(more, by, size), np.where(more, length, kind)
        best[fresh] = 0
        hit = best > critical
        for j in range(1, min(LONGEST + 3, len(rows))):
            same = (group[j:] == group[:-j])[:, None]
            hit[j:] &= ~same | (best[j:] > best[:-j])  # of equal ones the first
            hit[:-j] &= ~same | (best[:-j] >= best[j:])
        if not hit.any():
            break
        moves = np.where(hit & (kind == 0), size, 0.0)
        level = np.cumsum(moves, axis=0)
        first = np.flatnonzero(fresh)
        y = y - (level - level[first][np.cumsum(fresh) - 1])
        for length in range(1, LONGEST + 1):
            pulse = np.where(hit & (kind == length), size, 0.0)
            for j in range(length):
                y = y - _shifted(pulse[::-1], group[::-1], j)[::-1]
        clean[rows] = y
        live = np.isin(group, np.unique(group[hit.any(axis=1)]))  # series without a find are done
        if not live.all():
            rows, y, group, noise, p1, p2 = rows[live], y[live], group[live], noise[live], p1[live], p2[live]
    return x - clean, rest


def _residual_share(p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """Standard deviation of the autoregression's residuals as a share of that of the differences."""
    r1 = p1 / (1 - p2)
    return np.sqrt(np.maximum(1 - p1 * r1 - p2 * (p1 * r1 + p2), 0.05))


def _fill(x: np.ndarray, ok: np.ndarray, fresh: np.ndarray, forward: bool) -> np.ndarray:
    """Values that are not ok replaced by the nearest earlier (or later) ok value of their series; nan if none."""
    n = len(x)
    if not forward:
        back = np.r_[fresh[1:], True][::-1]
        return _fill(x[::-1], ok[::-1], back, True)[::-1]
    at = np.arange(n)[:, None]
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))[:, None]
    last = np.maximum.accumulate(np.where(ok, at, -1), axis=0)
    filled = np.take_along_axis(x, np.maximum(last, 0), axis=0)
    return np.where(last >= start, filled, np.nan)


def flags(block: Block, fit: np.ndarray, limits: np.ndarray, may_hold: np.ndarray, far: float, beyond: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(impossible, spike, stuck) per reading of a block; ``fit`` is (readings, components, parameters)."""
    x, inside, fresh, group = block.x, block.inside, block.fresh, block.group
    noise, spread, repeats, p1, p2 = (fit[:, :, i] for i in range(_FIT))
    finite = np.isfinite(x)
    level = block.levels()
    slack = 3 * np.where(repeats < 0.5, noise, 0.0)
    with np.errstate(invalid="ignore"):
        out = (x < limits[:, :1] - slack) | (x > limits[:, 1:] + slack) | ((np.abs(x - level) > beyond * spread) & (spread > 0))
    bad = inside & (~finite | out)
    ok = inside & ~bad
    before, after = _fill(x, ok, fresh, True), _fill(x, ok, fresh, False)
    y = np.where(np.isfinite(before), before, after)
    y = np.where(np.isfinite(y), y, 0.0)
    effect, rest = interventions(y, group, noise, (p1, p2))
    rest = np.abs(rest) / _residual_share(p1, p2)
    rest[fresh] = np.nan

    n = len(x)
    spike = np.zeros(n, bool)
    for length in range(1, LONGEST + 1):
        if n < length + 2:
            continue
        i = np.arange(1, n - length)
        whole = group[i - 1] == group[i + length]
        # an excursion is where the effects found leave a level and come back to it
        e0, e1 = effect[i - 1], effect[i + length]
        away = np.stack([np.where(bad[i + j], np.nan, effect[i + j] - (e0 + e1) / 2) for j in range(length)])
        with np.errstate(invalid="ignore"):
            up, down = np.all(np.isnan(away) | (away > 0), axis=0), np.all(np.isnan(away) | (away < 0), axis=0)
            least = np.min(np.where(np.isnan(away), np.inf, np.abs(away)), axis=0)
            hit = whole[:, None] & (up | down) & np.isfinite(least) & (least > far * noise[i]) & (noise[i] > 0) & (np.abs(e0 - e1) < 0.5 * least)
        for r, c in zip(*np.nonzero(hit)):
            t = i[r]
            a, b = max(block.head[group[t]], t - 10), min(block.tail[group[t]], t + length + 11)
            # far from the local noise, too: the residuals of the calmer side
            sides = [w[np.isfinite(w)] for w in (rest[a:t, c], rest[t + length + 1 : b, c])]
            local = min((1.4826 * np.median(w) for w in sides if len(w) >= 3), default=0.0)
            if least[r, c] <= far * max(noise[t, c], local):
                continue
            # the exact check: the values themselves stand away on one side of neighbours that agree
            p, q = before[t - 1, c], after[t + length, c]
            part = np.where(bad[t : t + length, c], np.nan, x[t : t + length, c] - (p + q) / 2) * (1 if up[r, c] else -1)
            if np.all(np.isnan(part) | (part > 0)) and abs(p - q) < 0.5 * np.nanmin(part):
                spike[t : t + length] |= ~bad[t : t + length, c]

    equal = np.zeros(x.shape, bool)
    equal[1:] = x[1:] == x[:-1]
    equal[fresh] = False
    run = np.cumsum(~equal, axis=0)
    stuck = np.zeros(n, bool)
    for c in range(x.shape[1]):
        size = np.bincount(run[:, c])[run[:, c]]
        stuck |= (size >= RUN) & ok[:, c] & (repeats[:, c] < 0.5) & ~may_hold
    return bad.any(axis=1), spike, stuck


def _tests(limits: dict[str, tuple[float, float]], may_hold: list[str], far: float, beyond: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            n, k = block.x.shape
            first = pa.array(block.at[block.head])
            topic = block.rows["topic"].combine_chunks().take(first).to_pylist()
            fits = block.rows["fit"].combine_chunks().take(first).to_pylist()
            fit = np.zeros((len(fits), k, _FIT))
            for g, f in enumerate(fits):
                part = np.asarray(f or [], float).reshape(-1, _FIT)[:k]
                fit[g, : len(part)] = part
            bound = np.array([limits.get(t, (-np.inf, np.inf)) for t in topic], float).reshape(-1, 2)
            hold = np.isin(topic, may_hold)
            bad, spike, stuck = flags(block, fit[block.group], bound[block.group], hold[block.group], far, beyond)
            late = block.rows["outside"].combine_chunks().fill_null(False).to_numpy(zero_copy_only=False)[block.at].astype(bool)
            core = block.rows["core"].to_numpy(zero_copy_only=False)[block.at].astype(bool)
            hit = np.flatnonzero(core & (late | bad | spike | stuck))
            if len(hit):
                rows = block.rows.select(["bag", "topic", "seq"]).take(pa.array(block.at[hit])).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [*(rows[c].combine_chunks() for c in ("bag", "topic", "seq")), *(pa.array(f[hit]) for f in (late, bad, spike, stuck))],
                    names=["bag", "topic", "seq", "outside", "impossible", "spike", "stuck"],
                )

    return run


def implausible_readings(
    messages: DataFrame, windows: DataFrame, entity: str, source: str, topic: str, seq: str, time: str, value: str,
    limits: dict[str, tuple[float, float]] | None = None, may_hold: list[str] | None = None,
    far: float = 7.5, beyond: float = 40.0, chunk: int = 32_768, max_broadcast_rows: int = 500_000,
) -> DataFrame:
    """Readings that are outside their recording, impossible, part of a spike, or stuck.

    A source is one ``topic`` of one ``source`` (say, a device); a series is one topic of one
    ``entity`` in the order of ``seq``.  ``windows`` has (entity, low, high), the times [low, high)
    of an entity.  Out come (entity, topic, seq, outside, impossible, spike, stuck), one row per
    reading with at least one flag.

    * outside: the time is not in the entity's window (entities without one have no such readings);
    * impossible: a component is not finite, outside ``limits`` of its topic by more than three times
      the noise, or ``beyond`` times the source's spread away from the middle of its series;
    * spike: at most three successive readings whose effects, in a component, are ``far`` times the noise
      (of the source, and of the residuals on the calmer side) while those of both neighbours agree, and whose
      values stand away from both, which agree; where values are usually held the spread stands for the noise;
    * stuck: at least 20 successive equal values of a component that otherwise changes from reading to
      reading (not for the topics in ``may_hold``).

    A series is cut every ``chunk`` sequence numbers, with ``MARGIN`` numbers of context on either side: an
    excursion or run right at a cut is seen whole unless nearly that many messages in a row are lost there.

    Readings with null times, null or empty values, or a null entity, topic or number are none; a
    null source is a source of its own; repeated rows (same entity, topic and number) count once;
    components may differ in number; empty tables give an empty result; other columns are ignored.
    """
    size, margin = F.lit(chunk).cast("bigint"), F.lit(MARGIN).cast("bigint")
    rows = messages.select(
        F.col(entity).cast("string").alias("bag"), F.col(topic).cast("string").alias("topic"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.col(seq).cast("bigint").alias("seq"), F.col(time).cast("bigint").alias("t"), F.col(value).cast("array<double>").alias("v"),
    ).where("bag is not null and topic is not null and seq is not null and t is not null and size(v) > 0")
    # a null component is not a number
    rows = rows.withColumn("v", F.when(F.exists("v", lambda c: c.isNull()), F.transform("v", lambda c: F.coalesce(c, F.lit(float("nan"))))).otherwise(F.col("v")))
    spans = windows.select(F.col(entity).cast("string").alias("bag"), F.col("low").cast("bigint").alias("low"), F.col("high").cast("bigint").alias("high")).dropna()
    spans = spans.groupBy("bag").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    rows = rows.join(broadcast_if_small(spans, windows.count(), max_broadcast_rows), "bag", "left")
    own = floor_div(F.col("seq"), size)
    start = F.when(F.col("seq") >= 0, F.greatest(F.col("seq") - margin, F.lit(0))).otherwise(F.col("seq") - margin)  # usual numbers start at 0: no chunk before
    near = F.explode(F.sequence(floor_div(start, size), floor_div(F.col("seq") + margin, size))).alias("chunk")
    rows = rows.select("bag", "topic", "source", "seq", "v", ((F.col("t") < F.col("low")) | (F.col("t") >= F.col("high"))).alias("outside"), own.alias("own"), near)
    rows = rows.select("bag", "topic", "chunk", "source", "seq", "v", "outside", (F.col("own") == F.col("chunk")).alias("core"))
    keys = ["bag", "topic", "chunk"]
    spread = rows.repartition(*keys)  # the fit and the tests read the same columns of it, so there is one exchange
    fitted = spread.sortWithinPartitions(*keys, "seq").mapInArrow(_statistics, _STATS).groupBy("source", "topic").applyInPandas(fit_source, _PARAMS)
    # a chunk's parameters; its rows have one source, as an entity has
    heads = rows.groupBy(*keys).agg(F.max("source").alias("source")).join(fitted, ["source", "topic"]).select(*keys, "fit")
    tested = spread.join(heads, keys, "left").sortWithinPartitions(*keys, "seq")
    found = tested.mapInArrow(_tests(limits or {}, may_hold or [], far, beyond), "bag string, topic string, seq bigint, outside boolean, impossible boolean, spike boolean, stuck boolean")
    return found.select(F.col("bag").alias(entity), F.col("topic").alias(topic), F.col("seq").alias(seq), "outside", "impossible", "spike", "stuck")
