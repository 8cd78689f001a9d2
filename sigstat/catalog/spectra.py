"""Queries over spectra, filters, peaks and coupling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.filters import butterworth
from ..operators.coupling import Stream, plv, plv_events, plv_from_phases, plv_streams, plv_summary, plv_table
from ..operators.filters import detect_peaks, detect_r_peaks, filter_signal
from ..operators.spectral import band_power, band_power_summary, channel_covariance, coherence, mean_spectrum, pca_variance, welch_spectrum
from .base import EPOCHS, WAVES, epochs, lines, query, rounded, rsql, signal, table, waves

K = ["participant_id"]
BANDS = {"low": (1.0, 7.0), "mid": (8.0, 16.0), "none": (40.0, 44.0)}

_PSD = """seg AS (SELECT participant_id, condition, epoch_id, channel, s, seq - s * {step} AS pos, v FROM (SELECT * FROM waves UNPIVOT (v FOR channel IN (x, y))), (SELECT unnest(range({nseg})) AS s)
  WHERE seq >= s * {step} AND seq < s * {step} + {np}),
d AS (SELECT participant_id, condition, epoch_id, channel, s, pos, (v - avg(v) OVER (PARTITION BY participant_id, epoch_id, channel, s)) * (0.5 - 0.5 * cos(2 * pi() * pos / {np})) AS v FROM seg),
f AS (SELECT participant_id, condition, epoch_id, channel, s, k, sum(v * cos(2 * pi() * ((k * pos) % {np}) / {np})) AS re, sum(v * sin(2 * pi() * ((k * pos) % {np}) / {np})) AS im
  FROM d, (SELECT unnest(range({np} // 2 + 1)) AS k) GROUP BY ALL),
w AS (SELECT sum(pow(0.5 - 0.5 * cos(2 * pi() * i / {np}), 2)) AS w2 FROM (SELECT unnest(range({np})) AS i)),
psd AS (SELECT participant_id, condition, epoch_id, channel, k * 64.0 / {np} AS frequency, avg((re * re + im * im) / w2 * CASE WHEN k = 0 OR 2 * k = {np} THEN 1 ELSE 2 END) / 64.0 AS power
  FROM f, w GROUP BY participant_id, condition, epoch_id, channel, k)"""
_W32 = _PSD.format(step=16, nseg=3, np=32)
_W64 = _PSD.format(step=32, nseg=1, np=64)


@query("welch_spectrum", rsql(f"WITH {WAVES}, {_W32} SELECT * FROM psd WHERE frequency BETWEEN 1 AND 20", "frequency, power", 8))
def welch(spark, folder):
    return rounded(welch_spectrum(waves(spark, folder), K, ["x", "y"], 20.0), 8)


@query("welch_spectrum_relational", rsql(f"WITH {WAVES}, {_W32} SELECT * FROM psd WHERE frequency BETWEEN 1 AND 20", "frequency, power", 8))
def welch_relational(spark, folder):
    return rounded(welch_spectrum(waves(spark, folder), K, ["x", "y"], 20.0, method="relational"), 8)


_BAND = """SELECT {g}, 'low' AS band, coalesce(avg(power) FILTER (frequency BETWEEN 1 AND 7), 0) AS power FROM {t} GROUP BY ALL
UNION ALL SELECT {g}, 'mid', coalesce(avg(power) FILTER (frequency BETWEEN 8 AND 16), 0) FROM {t} GROUP BY ALL
UNION ALL SELECT {g}, 'none', coalesce(avg(power) FILTER (frequency BETWEEN 40 AND 44), 0) FROM {t} GROUP BY ALL"""
_G = "participant_id, condition, epoch_id, {}"


@query("band_power", rsql(f"WITH {WAVES}, {_W64} " + _BAND.format(g=_G.format("channel"), t="psd"), "power", 8))
def bands(spark, folder):
    return rounded(band_power(waves(spark, folder), K, BANDS, ["x", "y"]), 8)


_REG = "reg AS (SELECT participant_id, condition, epoch_id, region, frequency, avg(power) AS power FROM (SELECT *, unnest(CASE WHEN channel = 'x' THEN ['all', 'first'] ELSE ['all'] END) AS region FROM psd) GROUP BY ALL)"


@query("band_power_regions", rsql(f"""WITH {WAVES}, {_W64}, {_REG} SELECT participant_id, condition, epoch_id, region, coalesce(avg(power) FILTER (frequency BETWEEN 1 AND 7), 0) AS low,
  coalesce(avg(power) FILTER (frequency BETWEEN 8 AND 16), 0) AS mid, coalesce(avg(power) FILTER (frequency BETWEEN 40 AND 44), 0) AS "none" FROM reg GROUP BY ALL""", 'low, mid, "none"', 8))
def region_bands(spark, folder):
    return rounded(band_power(waves(spark, folder), K, BANDS, ["x", "y"], {"all": ["x", "y"], "first": ["x", "absent"]}, wide=True), 8)


@query("band_power_summary", rsql(f"""WITH {WAVES}, {_W64}, b AS ({_BAND.format(g=_G.format("channel"), t="psd")}), e AS (SELECT participant_id, condition, epoch_id, band, avg(power) AS v FROM b GROUP BY ALL)
SELECT condition, band, avg(v) AS mean, stddev_pop(v) / sqrt(count(v)) AS sem, count(v) AS n FROM e GROUP BY ALL""", "mean, sem", 8))
def bands_summary(spark, folder):
    return rounded(band_power_summary(band_power(waves(spark, folder), K, BANDS, ["x", "y"])), 8)


_MEAN = f"""WITH {WAVES}, c AS (SELECT condition, epoch_id, seq, unnest([(x + y) / 2, y]) AS v, unnest(['both', 'square']) AS region FROM waves),
f AS (SELECT condition, epoch_id, region, k, sum(v * cos(2 * pi() * ((k * seq) % 64) / 64)) AS re, sum(v * sin(2 * pi() * ((k * seq) % 64) / 64)) AS im FROM c, (SELECT unnest(range(33)) AS k) GROUP BY ALL),
p AS (SELECT condition, epoch_id, region, k::DOUBLE AS frequency, (re * re + im * im) / (64 * 64.0) * CASE WHEN k = 0 OR k = 32 THEN 1 ELSE 2 END AS p FROM f)
SELECT condition, region, frequency, avg(p) AS mean, coalesce(stddev_samp(p) / sqrt(count(p)), 0) AS sem FROM p WHERE frequency BETWEEN 1 AND 45 GROUP BY ALL"""


@query("mean_spectrum", rsql(_MEAN, "frequency, mean, sem", 8))
def spectrum(spark, folder):
    return rounded(mean_spectrum(waves(spark, folder), K, ["x", "y"], {"both": ["x", "y"], "square": ["y"]}), 8)


@query("mean_spectrum_relational", rsql(_MEAN, "frequency, mean, sem", 8))
def spectrum_relational(spark, folder):
    return rounded(mean_spectrum(waves(spark, folder), K, ["x", "y"], {"both": ["x", "y"], "square": ["y"]}, method="relational"), 8)


_CROSS = f"""WITH {WAVES}, seg AS (SELECT epoch_id, s, seq - s * 8 AS pos, x, y FROM waves, (SELECT unnest(range(7)) AS s) WHERE seq >= s * 8 AND seq < s * 8 + 16),
d AS (SELECT epoch_id, s, pos, (x - avg(x) OVER w) * (0.5 - 0.5 * cos(2 * pi() * pos / 16)) AS x, (y - avg(y) OVER w) * (0.5 - 0.5 * cos(2 * pi() * pos / 16)) AS y FROM seg WINDOW w AS (PARTITION BY epoch_id, s)),
f AS (SELECT epoch_id, s, k, sum(x * cos(2 * pi() * ((k * pos) % 16) / 16)) AS xr, -sum(x * sin(2 * pi() * ((k * pos) % 16) / 16)) AS xi,
  sum(y * cos(2 * pi() * ((k * pos) % 16) / 16)) AS yr, -sum(y * sin(2 * pi() * ((k * pos) % 16) / 16)) AS yi FROM d, (SELECT unnest(range(1, 5)) AS k) GROUP BY ALL)
SELECT epoch_id, 'x-y' AS pair, avg(v) AS value FROM (SELECT epoch_id, k, {{}} AS v FROM f GROUP BY ALL) GROUP BY epoch_id"""
_COH = "sqrt(pow(avg(xr * yr + xi * yi), 2) + pow(avg(xi * yr - xr * yi), 2)) / sqrt(avg(xr * xr + xi * xi) * avg(yr * yr + yi * yi))"
_WPLI = "abs(avg(xi * yr - xr * yi)) / avg(abs(xi * yr - xr * yi))"


@query("coherence", rsql(_CROSS.format(_COH), "value"))
def coherent(spark, folder):
    return rounded(coherence(waves(spark, folder), ["epoch_id"], ["x", "y"], 64.0, 0.25, 0.125, 1.0, 16.0))


@query("coherence_wpli", rsql(_CROSS.format(_WPLI), "value"))
def wpli(spark, folder):
    return rounded(coherence(waves(spark, folder), ["epoch_id"], ["x", "y"], 64.0, 0.25, 0.125, 1.0, 16.0, "wpli"))


@query("channel_covariance", rsql("""
WITH c AS (SELECT l_suppkey, covar_samp(l_quantity, l_quantity) AS aa, covar_samp(l_quantity, l_discount) AS ab, covar_samp(l_discount, l_discount) AS bb FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, 'l_quantity' AS channel_a, 'l_quantity' AS channel_b, aa AS cov FROM c UNION ALL SELECT l_suppkey, 'l_discount', 'l_discount', bb FROM c
UNION ALL SELECT l_suppkey, 'l_quantity', 'l_discount', ab FROM c UNION ALL SELECT l_suppkey, 'l_discount', 'l_quantity', ab FROM c""", "cov"))
def covariance(spark, folder):
    return rounded(channel_covariance(lines(spark, folder), ["l_suppkey"], ["l_quantity", "l_discount"]))


@query("pca_variance", rsql("""
WITH c AS (SELECT l_suppkey, var_samp(l_quantity) AS a, var_samp(l_tax * 200) AS b, covar_samp(l_quantity, l_tax * 200) AS c FROM lineitem GROUP BY l_suppkey),
e AS (SELECT l_suppkey, (a + b) / 2 + sqrt(pow((a - b) / 2, 2) + c * c) AS e0, (a + b) / 2 - sqrt(pow((a - b) / 2, 2) + c * c) AS e1 FROM c)
SELECT l_suppkey, 0 AS component, e0 AS variance, e0 / (e0 + e1) AS share FROM e UNION ALL SELECT l_suppkey, 1, e1, e1 / (e0 + e1) FROM e WHERE e0 / (e0 + e1) < 0.99""", "variance, share", 5))
def pca(spark, folder):
    li = lines(spark, folder).withColumn("tax", F.col("l_tax") * 200)
    return rounded(pca_variance(li, ["l_suppkey"], ["l_quantity", "tax", "l_discount"], 0.99, ["l_discount"]), 5)


def _zero_phase_sql(order: int, low: float, high: float, rate: float, pad: int, n: int, source: str, name: str, lists: str) -> str:
    """``name``: the lists of ``source`` (n samples each) filtered forward and backward, as convolutions with the impulse response.

    The response follows from the difference equation; a pass starts in the steady state of its first value.
    """
    zeros, poles, gain = butterworth(order, low, high, rate)
    b, a = np.real(np.poly(zeros)) * gain, np.real(np.poly(poles))
    size = n + 2 * pad
    at_zero = float(b.sum() / a.sum())
    text = lambda v: "[" + ", ".join(f"{x:.17e}" for x in v) + "]"

    def run(column, made):
        return f"[list_dot_product([{column}[k_] - {column}[1] FOR k_ IN range(1, i_ + 1)], hr[{size} - i_ + 1:{size}]) + {column}[1] * {at_zero:.17e} FOR i_ IN range(1, {size + 1})] AS {made}"

    out = [f"""co AS (SELECT {text(b)} AS b, {text(a)} AS a),
im AS (SELECT 1 AS m, [b[1]] AS h FROM co UNION ALL SELECT m + 1, h || [coalesce(b[m + 1], 0e0) - list_sum([a[k_ + 1] * h[m + 1 - k_] FOR k_ IN range(1, least({len(a) - 1}, m) + 1)])] FROM im, co WHERE m < {size}),
hr AS (SELECT list_reverse(h) AS hr FROM im WHERE m = {size})"""]
    columns = lists.split(", ")
    for c in columns:
        long = f"[2 * {c}[1] - {c}[{pad + 1} - i_] FOR i_ IN range({pad})] || {c} || [2 * {c}[{n}] - {c}[{n - 1} - i_] FOR i_ IN range({pad})]"
        out.append(f"""{name}_{c}0 AS (SELECT * EXCLUDE ({lists}), {long} AS v0 FROM {source}),
{name}_{c}1 AS (SELECT * EXCLUDE (hr, v0), list_reverse({run('v0', 'v1').removesuffix(' AS v1')}) AS v1 FROM {name}_{c}0, hr),
{name}_{c} AS (SELECT * EXCLUDE (hr, v1), list_reverse({run('v1', 'v2').removesuffix(' AS v2')})[{pad + 1}:{pad + n}] AS {c} FROM {name}_{c}1, hr)""")
    return ", ".join(out)


def _phase_sql(column: str, n: int) -> str:
    """Angles of the analytic signal of an even number of samples; its imaginary part is a circular convolution."""
    kernel = f"CASE WHEN (i_ - j_) % 2 = 0 THEN 0e0 ELSE 2e0 / {n} / tan(pi() * (i_ - j_) / {n}) END"
    return f"[atan2(list_dot_product({column}, [{kernel} FOR j_ IN range({n})]), {column}[i_ + 1]) FOR i_ IN range({n})]"


def _locked_sql(a: str, b: str, n: int) -> str:
    d = f"[{a}[i_] - {b}[i_] FOR i_ IN range(1, {n + 1})]"
    return f"sqrt(pow(list_avg([cos(d_) FOR d_ IN {d}]), 2) + pow(list_avg([sin(d_) FOR d_ IN {d}]), 2))"


@query("filter_signal", rsql(f"""WITH RECURSIVE {WAVES}, src AS (SELECT epoch_id, list(time ORDER BY seq) AS t, list(x ORDER BY seq) AS x FROM waves GROUP BY epoch_id),
{_zero_phase_sql(2, 4.0, 12.0, 64.0, 15, 64, "src", "flt", "x")}
SELECT epoch_id, unnest(t) AS time, unnest(x) AS x, 64e0 AS sfreq FROM flt_x""", "time, x"))
def bandpassed(spark, folder):
    """The twin convolves with the impulse response of the difference equation."""
    return rounded(filter_signal(waves(spark, folder), ["epoch_id"], "x", 4.0, 12.0, 64.0))


@query("filter_signal_unchanged", rsql(f"WITH {WAVES} SELECT epoch_id, time, x, 64e0 AS sfreq FROM waves", "time, x"))
def unfiltered(spark, folder):
    """A band that does not fit the rate leaves the signal as it is."""
    return rounded(filter_signal(waves(spark, folder), ["epoch_id"], "x", 4.0, 40.0, 64.0))


_RUNS = """r AS (SELECT *, row_number() OVER w - 1 AS i, lag(v) OVER w AS p FROM src WINDOW w AS (PARTITION BY k ORDER BY o)),
s AS (SELECT *, lag(v) OVER w AS b, lead(v) OVER w AS a, lead(i) OVER w AS n FROM r WHERE p IS NULL OR v <> p WINDOW w AS (PARTITION BY k ORDER BY i)),
t AS (SELECT k, (i + n - 1) // 2 AS peak_sample FROM s WHERE v > b AND v > a AND v >= {h})"""


@query("detect_peaks", rsql(f"""
WITH src AS (SELECT user_id AS k, event_id AS o, round(value / 10) AS v, epoch_us(ts) / 1e6 AS time FROM events), {_RUNS.format(h=2)}
SELECT t.k AS participant_id, 'level' AS channel, peak_sample, time, 250e0 AS sfreq FROM t JOIN r ON t.k = r.k AND t.peak_sample = r.i""", "time"))
def peaks(spark, folder):
    s = signal(spark, folder).withColumn("level", F.round(F.col("value") / 10))
    return rounded(detect_peaks(s, K, "level", 250.0, height=2.0, order=["seq"]))


def _apart(distance: int) -> str:
    """kept: of the peaks ``c`` (k, i, h) those at least ``distance`` apart, one after the other from the highest."""
    return f"""o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY h DESC, i DESC) AS place FROM c),
st AS (SELECT k, 0::BIGINT AS place, []::BIGINT[] AS own FROM (SELECT DISTINCT k FROM o)
  UNION ALL SELECT o.k, o.place, CASE WHEN len(list_filter(st.own, lambda x: abs(x - o.i) < {distance})) = 0 THEN list_append(st.own, o.i) ELSE st.own END
  FROM st JOIN o ON o.k = st.k AND o.place = st.place + 1),
kept AS (SELECT k, unnest(own) AS i FROM (SELECT k, arg_max(own, place) AS own FROM st GROUP BY k))"""


@query("detect_peaks_distance", rsql(f"""
WITH RECURSIVE src AS (SELECT user_id AS k, event_id AS o, value AS v, epoch_us(ts) / 1e6 AS time FROM events), {_RUNS.format(h=0).replace("AND v >= 0", "").replace("SELECT k, (i", "SELECT k, v, (i").replace("r AS", "r1 AS").replace("FROM r ", "FROM r1 ")},
c AS (SELECT k, peak_sample::BIGINT AS i, v AS h FROM t), {_apart(5)}
SELECT kept.k AS participant_id, 'value' AS channel, kept.i AS peak_sample, time, 1e0 AS sfreq FROM kept JOIN r1 ON r1.k = kept.k AND r1.i = kept.i""", "time"))
def peaks_apart(spark, folder):
    return rounded(detect_peaks(signal(spark, folder), K, "value", 1.0, distance=5.0, order=["seq"]))


@query("detect_r_peaks", rsql(f"""
WITH RECURSIVE src AS (SELECT user_id AS k, row_number() OVER w - 1 AS i, value AS x, epoch_us(ts) / 1e6 AS time, coalesce((lead(value) OVER w - lag(value) OVER w) / 2, lead(value) OVER w - value, value - lag(value) OVER w) AS g
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
a AS (SELECT *, avg(abs(g)) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS s FROM src),
b AS (SELECT *, s > 1.5 * avg(s) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS up FROM a),
m AS (SELECT *, up AND NOT coalesce(lag(up) OVER (PARTITION BY k ORDER BY i), false) AS first FROM b),
n AS (SELECT *, count(*) FILTER (first) OVER (PARTITION BY k ORDER BY i) AS beat FROM m),
e AS (SELECT k, beat, count(*) AS len, arg_min(i, (-x, i)) AS i, max(x) AS h FROM n WHERE up GROUP BY k, beat),
c AS (SELECT * FROM e QUALIFY len >= 0.4 * avg(len) OVER (PARTITION BY k)), {_apart(6)}
SELECT kept.k AS participant_id, 'value' AS channel, kept.i AS peak_sample, time, 20e0 AS sfreq FROM kept JOIN src ON src.k = kept.k AND src.i = kept.i""", "time"))
def r_peaks(spark, folder):
    return rounded(detect_r_peaks(signal(spark, folder), K, "value", 20.0, order=["seq"]))


@query("plv", rsql(f"""WITH RECURSIVE {WAVES}, src AS (SELECT participant_id, condition, epoch_id, list(x ORDER BY seq) AS x, list(y ORDER BY seq) AS y FROM waves GROUP BY ALL),
{_zero_phase_sql(4, 4.0, 12.0, 64.0, 27, 64, "src", "flt", "x, y")},
ph AS (SELECT participant_id, condition, epoch_id, {_phase_sql("x", 64)} AS pa, {_phase_sql("y", 64)} AS pb FROM flt_x JOIN flt_y USING (participant_id, condition, epoch_id))
SELECT participant_id, condition, epoch_id, 'x-y' AS pair, {_locked_sql("pa", "pb", 64)} AS value FROM ph""", "value"))
def locking(spark, folder):
    w = waves(spark, folder)
    return rounded(plv(w, w, K, ["x"], ["y"], (4.0, 12.0), (4.0, 12.0), 64.0, 64.0))


_EVERY = "[half[1 + least(30, i_ * 31 // 63)] + (i_ * 31 / 63e0 - least(30, i_ * 31 // 63)) * (half[2 + least(30, i_ * 31 // 63)] - half[1 + least(30, i_ * 31 // 63)]) FOR i_ IN range(64)]"


@query("plv_streams", rsql(f"""WITH {WAVES}, src AS (SELECT participant_id, condition, epoch_id, list(x ORDER BY seq) AS x, list(y ORDER BY seq) AS y, list(x * x + y ORDER BY seq) FILTER (seq % 2 = 0) AS half FROM waves GROUP BY ALL),
ph AS (SELECT participant_id, condition, epoch_id, {_phase_sql("x", 64)} AS x, {_phase_sql("y", 64)} AS y, {_phase_sql("half", 32)} AS half FROM src), g AS (SELECT * REPLACE ({_EVERY} AS half) FROM ph)
SELECT participant_id, condition, epoch_id, 0 AS stream_a, 1 AS stream_b, 'x-y' AS pair, {_locked_sql("x", "y", 64)} AS value FROM g
UNION ALL SELECT participant_id, condition, epoch_id, 0, 2, 'x-half', {_locked_sql("x", "half", 64)} FROM g WHERE condition = 'A'
UNION ALL SELECT participant_id, condition, epoch_id, 1, 2, 'y-half', {_locked_sql("y", "half", 64)} FROM g WHERE condition = 'A'""", "value"))
def many_streams(spark, folder):
    """Three streams; the third has half the rate and only epochs of one condition."""
    w = waves(spark, folder)
    half = w.where("seq % 2 = 0 AND condition = 'A'").withColumn("half", F.col("x") * F.col("x") + F.col("y"))
    return rounded(plv_streams([Stream(w, ["x"], 64.0), Stream(w, ["y"], 64.0), Stream(half, ["half"], 32.0)], K))


def _phase_table(spark, folder, channel, name, every=1):
    """Phases made of a column: angle of (value, next value) would be one; here pi times the value."""
    w = waves(spark, folder).where(F.col("seq") % every == 0)
    idx = F.floor(F.col("seq") / every)
    return w.select(*K, "condition", "epoch_id", F.lit(name).alias("channel"), idx.alias("idx"), F.lit(64 // every).cast("long").alias("n"), "time", (F.col(channel) * 3.0).alias("phase"))


@query("plv_from_phases", rsql(f"""
WITH {WAVES}, b AS (SELECT *, lead(y) OVER (PARTITION BY participant_id, epoch_id ORDER BY seq) AS ny FROM waves WHERE seq % 2 = 0),
j AS (SELECT a.participant_id, a.condition, a.epoch_id, a.x * 3.0 AS pa, a.seq * 31.0 / 63.0 AS pos, b.y * 3.0 AS p0, coalesce(b.ny, b.y) * 3.0 AS p1, floor(a.seq * 31.0 / 63.0) AS jx
  FROM waves a JOIN b ON a.participant_id = b.participant_id AND a.epoch_id = b.epoch_id AND b.seq // 2 = CAST(floor(a.seq * 31.0 / 63.0) AS BIGINT)),
d AS (SELECT participant_id, condition, epoch_id, pa - (p0 + (pos - jx) * (p1 - p0)) AS d FROM j)
SELECT participant_id, condition, epoch_id, 'x-y' AS pair, sqrt(pow(avg(cos(d)), 2) + pow(avg(sin(d)), 2)) AS value FROM d GROUP BY ALL""", "value"))
def from_phases(spark, folder):
    return rounded(plv_from_phases(_phase_table(spark, folder, "x", "x"), _phase_table(spark, folder, "y", "y", 2).drop("time"), K))


@query("plv_events", rsql(f"""
WITH {EPOCHS}, ph AS (SELECT participant_id, condition, epoch_id, time, value / 30.0 AS phase FROM epochs),
ev AS (SELECT participant_id, condition, epoch_id, time AS et, count(*) OVER (PARTITION BY participant_id, condition, epoch_id ORDER BY time) AS no FROM epochs WHERE seq % 6 = 0),
h AS (SELECT ph.participant_id, ph.condition, ph.epoch_id, ph.time, any_value(phase) AS phase, arg_max(et, et) FILTER (et <= ph.time) AS p, max(no) FILTER (et <= ph.time) AS n, min(et) FILTER (et > ph.time) AS nx
  FROM ph LEFT JOIN ev USING (participant_id, condition, epoch_id) GROUP BY ph.participant_id, ph.condition, ph.epoch_id, ph.time),
d AS (SELECT participant_id, condition, epoch_id, phase - CASE WHEN p IS NULL OR nx IS NULL THEN 0 ELSE 2 * pi() * (n + (time - p) / (nx - p)) END AS d FROM h)
SELECT participant_id, condition, epoch_id, 'value-beats' AS pair, sqrt(pow(avg(cos(d)), 2) + pow(avg(sin(d)), 2)) AS value FROM d GROUP BY ALL""", "value", 5))
def with_events(spark, folder):
    e = epochs(spark, folder)
    ph = e.select(*K, "condition", "epoch_id", "time", F.lit("value").alias("channel"), (F.col("value") / 30.0).alias("phase"))
    return rounded(plv_events(ph, e.where("seq % 6 = 0"), K, event_name="beats"), 5)


def _pair_values(spark, folder):
    return table(spark, folder, "lineitem").groupBy(
        F.col("l_returnflag").alias("condition"), F.col("l_suppkey").alias("epoch_id"), F.concat_ws("-", "l_linestatus", F.lit("x")).alias("pair")
    ).agg(F.avg("l_discount").alias("value"))


_PAIRS = "p AS (SELECT l_returnflag AS condition, l_suppkey AS epoch_id, l_linestatus || '-x' AS pair, avg(l_discount) AS value FROM lineitem GROUP BY ALL)"


@query("plv_table", rsql(f"""WITH {_PAIRS} SELECT condition, epoch_id, avg(value) FILTER (pair = 'F-x') AS "F-x", avg(value) FILTER (pair = 'O-x') AS "O-x", condition AS trial_id FROM p GROUP BY condition, epoch_id""", '"F-x", "O-x"'))
def pair_table(spark, folder):
    return rounded(plv_table(_pair_values(spark, folder), [], ["F-x", "O-x"]))


@query("plv_summary", rsql(f"WITH {_PAIRS} SELECT condition, pair, avg(value) AS plv_mean, coalesce(stddev_samp(value) / sqrt(count(*)), 0) AS plv_sem, count(*) AS n FROM p GROUP BY ALL", "plv_mean, plv_sem"))
def pair_summary(spark, folder):
    return rounded(plv_summary(_pair_values(spark, folder)))
