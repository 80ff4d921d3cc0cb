"""The registered queries over the sequence operators, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import audit, catalog, evaluate, landmarks, postprocess, resample, scoring, smoothing, stats, timeline, windows
from . import assemble, evaluation
from .adapters import C, D, E, V, conversation_frames, document_catalog, event_frames, runs, table, vector_frames

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}
FPS = 15.0


def _query(sql: str | None = None):
    def register(fn):
        _QUERIES[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return register


def queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _r(c, name: str | None = None, digits: int = 6):
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits).alias(name) if name else F.round(c.cast("double"), digits)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: _r(c) for c in columns})


# ---- runs of the timeline -------------------------------------------------


@_query(f"WITH {E}, {runs('e', 'label', 's')} SELECT video_id, seg_id, label, seg_start, seg_end FROM s")
def segments_rle(spark, sf):
    return timeline.segments(event_frames(spark, sf))


@_query(f"WITH {C}, {runs('c', 'label', 's')} SELECT video_id, seg_id, label, seg_start, seg_end FROM s")
def segments_rle_conversations(spark, sf):
    return timeline.segments(conversation_frames(spark, sf))


@_query(f"WITH {E}, {runs('e', 'label', 's')} SELECT video_id, label, seg_start, seg_end FROM s WHERE label <> 14")
def action_spans(spark, sf):
    return timeline.action_spans(timeline.segments(event_frames(spark, sf))).select("video_id", "label", "seg_start", "seg_end")


_P = "CAST(quantile_disc(n, {q}) AS INT)"


@_query(f"""WITH {E}, {runs('e', 'label', 's')}, a AS (SELECT *, CAST(seg_end - seg_start AS INT) n FROM s WHERE label <> 14),
g AS (SELECT label AS class_id, count(*) AS segments, CAST(sum(n) AS BIGINT) AS frames_total, avg(n) AS mean_frames, {_P.format(q=.5)} AS p50_frames, {_P.format(q=.9)} AS p90_frames, {_P.format(q=.95)} AS p95_frames, {_P.format(q=.99)} AS p99_frames, max(n) AS max_frames, count(*) FILTER (n > 2) AS over_window FROM a GROUP BY label)
SELECT class_id, segments, frames_total, round(mean_frames, 6) AS mean_frames, p50_frames, p90_frames, p95_frames, p99_frames, max_frames, over_window, round(segments / sum(segments) OVER (), 6) AS share, round(over_window / segments, 6) AS over_window_share, greatest(2 - p50_frames + 1, 0) AS starts_p50, round(p50_frames / 15.0, 6) AS p50_sec, round(p95_frames / 15.0, 6) AS p95_sec FROM g""")
def class_run_stats(spark, sf):
    out = stats.class_run_stats(timeline.segments(event_frames(spark, sf)), window=2, fps=FPS)
    return _rounded(out, "mean_frames", "share", "over_window_share", "p50_sec", "p95_sec")


_GAPS = f"WITH {E}, {runs('e', 'label', 's')}, g AS (SELECT video_id, lead(seg_start) OVER (PARTITION BY video_id ORDER BY seg_start) - seg_end AS gap FROM s WHERE label <> 14)"


@_query(f"{_GAPS} SELECT video_id, gap FROM g WHERE gap IS NOT NULL")
def action_gaps(spark, sf):
    return stats.action_gaps(timeline.segments(event_frames(spark, sf)))


@_query(f"{_GAPS} SELECT CAST(quantile_disc(gap, 0.05) AS INT) AS p05, CAST(quantile_disc(gap, 0.25) AS INT) AS p25, CAST(quantile_disc(gap, 0.5) AS INT) AS p50 FROM g WHERE gap IS NOT NULL")
def gap_percentiles(spark, sf):
    return stats.gap_percentiles(stats.action_gaps(timeline.segments(event_frames(spark, sf))))


@_query(f"WITH {E}, {runs('e', 'label', 's')} SELECT CAST(x AS INT) AS class_id FROM range(15) t(x) WHERE x <> 14 AND x NOT IN (SELECT label FROM s)")
def missing_classes(spark, sf):
    return stats.missing_classes(timeline.segments(event_frames(spark, sf)))


@_query(f"WITH {D} SELECT scene, coalesce(polarity, 'unknown') AS polarity, count(*) AS videos FROM d GROUP BY 1, 2")
def scene_polarity_counts(spark, sf):
    return stats.scene_counts(document_catalog(spark, sf))


@_query(f"WITH {D} SELECT source AS grp, count(*) AS videos, count(*) FILTER (status IS NULL) AS unlabelled, count(DISTINCT subject_id) AS subjects FROM d GROUP BY source")
def group_stats(spark, sf):
    d = document_catalog(spark, sf).withColumn("labelled", F.col("status").isNotNull())
    return stats.group_stats(stats.source_groups(d))


@_query(f"WITH {D} SELECT 'src1+src2' AS grp, count(*) AS videos, count(*) FILTER (status IS NULL) AS unlabelled, count(DISTINCT subject_id) AS subjects FROM d WHERE source IN ('src1', 'src2')")
def merged_group_stats(spark, sf):
    d = document_catalog(spark, sf).withColumn("labelled", F.col("status").isNotNull())
    return stats.group_stats(stats.source_groups(d, ["src1", "src2"]))


_LONGEST = f"WITH {E}, {runs('e', 'valid', 's')}"


@_query(f"{_LONGEST} SELECT video_id, CAST(max(CASE WHEN label = 0 THEN seg_end - seg_start ELSE 0 END) AS INT) AS longest_missing_frames, round(max(CASE WHEN label = 0 THEN seg_end - seg_start ELSE 0 END) / 15.0, 6) AS longest_missing_seconds FROM s GROUP BY video_id")
def longest_missing_run(spark, sf):
    return _rounded(timeline.longest_missing(event_frames(spark, sf), FPS), "longest_missing_seconds")


@_query(f"""{_LONGEST}, g AS (SELECT video_id, seg_start, seg_end - seg_start n, row_number() OVER (PARTITION BY video_id ORDER BY seg_end - seg_start DESC, seg_start) r FROM s WHERE label = 0),
o AS (SELECT video_id, frame, row_number() OVER (PARTITION BY video_id ORDER BY frame) - 1 AS pos, count(*) OVER (PARTITION BY video_id) AS n FROM e WHERE valid = 1)
SELECT DISTINCT video_id, CAST(trunc(seg_start + (n - 1) * i / 3.0) AS INT) AS frame FROM g, range(4) t(i) WHERE r = 1
UNION SELECT video_id, frame FROM o WHERE pos = 0 OR pos = n - 1""")
def diagnostic_positions(spark, sf):
    return timeline.diagnostic_positions(event_frames(spark, sf))


@_query(f"WITH {E} SELECT video_id, frame, round(coalesce(last_value(CASE WHEN valid = 1 THEN value END IGNORE NULLS) OVER (PARTITION BY video_id ORDER BY frame ROWS UNBOUNDED PRECEDING), 0.0), 6) AS value FROM e")
def forward_fill(spark, sf):
    return timeline.forward_fill(event_frames(spark, sf), {"value": F.lit(0.0)}).select("video_id", "frame", _r("value", "value"))


# ---- intervals --------------------------------------------------------------

_QUANT = "ceil((seg_start / 15.0::DOUBLE + 1e-4) * 1e4) / 1e4 AS qs, floor((seg_end / 15.0::DOUBLE - 1e-4) * 1e4) / 1e4 AS qe, floor(seg_end / 15.0::DOUBLE * 1e4) / 1e4 AS qp"
_NOVA = f"WITH {E}, {runs('e', 'label', 's')}, q AS (SELECT *, {_QUANT} FROM s WHERE label <> 14), i AS (SELECT video_id, seg_id, label, CASE WHEN qe < qs THEN qp ELSE qs END AS start_sec, CASE WHEN qe < qs THEN qp ELSE qe END AS end_sec FROM q)"


def _intervals(spark, sf):
    return timeline.frames_to_intervals(event_frames(spark, sf), FPS, "label")


@_query(f"WITH {E}, {runs('e', 'pred', 's')}, c AS (SELECT s.video_id, s.seg_id, avg(1 / (1 + exp(-value / 100))) AS c FROM s JOIN e ON e.video_id = s.video_id AND e.frame >= seg_start AND e.frame < seg_end GROUP BY 1, 2) SELECT video_id, round(seg_start / 15.0::DOUBLE, 6) AS start_sec, round(seg_end / 15.0::DOUBLE, 6) AS end_sec, label, round(c, 6) AS confidence FROM s JOIN c USING (video_id, seg_id) WHERE label <> 14")
def frames_to_intervals(spark, sf):
    probability = 1 / (1 + F.exp(-F.col("value") / 100))
    return _rounded(timeline.frames_to_intervals(event_frames(spark, sf), FPS, probability=probability), "start_sec", "end_sec", "confidence")


@_query(f"{_NOVA} SELECT video_id, label, round(start_sec, 6) AS start_sec, round(end_sec, 6) AS end_sec FROM i")
def nova_timestamps(spark, sf):
    return _rounded(timeline.annotation_times(_intervals(spark, sf)).select("video_id", "label", "start_sec", "end_sec"), "start_sec", "end_sec")


@_query(f"WITH {E} SELECT video_id, frame, label FROM e")
def intervals_to_frames(spark, sf):
    """The round trip: frames to written intervals and back gives the frames."""
    f = event_frames(spark, sf)
    i = timeline.annotation_times(timeline.frames_to_intervals(f, FPS, "label")).withColumn("line_no", F.monotonically_increasing_id())
    videos = windows.lengths(f).withColumn("fps", F.lit(FPS))
    return timeline.intervals_to_frames(videos, i)


@_query(f"""WITH {E}, {runs('e', 'label', 's')}, m AS (SELECT *, CAST(seg_id AS BIGINT) l, CAST(floor((seg_start + 1) / 15.0::DOUBLE * 10) AS INT) lo, CAST(ceil((seg_end + 2) / 15.0::DOUBLE * 10) AS INT) hi FROM s WHERE label <> 14), n AS (SELECT video_id, CAST(max(frame) + 1 AS INT) num_frames FROM e GROUP BY 1),
x AS (SELECT m.video_id, label, l, unnest(range(greatest(lo, 0), least(hi, num_frames))) AS frame FROM m JOIN n USING (video_id)),
y AS (SELECT video_id, frame, max_by(label, l) AS label FROM x GROUP BY ALL),
z AS (SELECT video_id, unnest(range(num_frames)) AS frame FROM n)
SELECT z.video_id, CAST(z.frame AS INT) AS frame, coalesce(y.label, 14) AS label FROM z LEFT JOIN y ON z.video_id = y.video_id AND z.frame = y.frame""")
def overlapping_intervals(spark, sf):
    """Intervals that overlap: a later line wins."""
    f = event_frames(spark, sf)
    s = timeline.action_spans(timeline.segments(f))
    i = s.select("video_id", F.col("seg_id").cast("long").alias("line_no"), "label", ((F.col("seg_start") + 1) / F.lit(FPS)).alias("start_sec"), ((F.col("seg_end") + 2) / F.lit(FPS)).alias("end_sec"))
    return timeline.intervals_to_frames(windows.lengths(f).withColumn("fps", F.lit(10.0)), i)


_TS = "CASE WHEN {ms} // 3600000 < 10 THEN '0' ELSE '' END || ({ms} // 3600000) || ':' || lpad(CAST({ms} // 60000 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({ms} // 1000 % 60 AS VARCHAR), 2, '0') || ',' || lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0')"


@_query(f"""{_NOVA}, t AS (SELECT *, CAST(round_even(start_sec * 1000, 0) AS BIGINT) AS a, CAST(round_even(end_sec * 1000, 0) AS BIGINT) AS b, CAST(row_number() OVER (PARTITION BY video_id ORDER BY start_sec, end_sec, label) AS INT) AS block_no FROM i)
SELECT video_id, block_no, block_no || chr(10) || {_TS.format(ms='a')} || ' --> ' || {_TS.format(ms='b')} || chr(10) || 'class ' || label AS block FROM t""")
def srt_blocks(spark, sf):
    return timeline.srt_blocks(timeline.annotation_times(_intervals(spark, sf)))


# ---- resampling and landmarks -----------------------------------------------


def _bucket_sql(ratio: str) -> str:
    return f"CAST(ceil((frame + 1) / ({ratio}::DOUBLE)) - 1 AS INT)"


@_query(f"WITH {E} SELECT video_id, {_bucket_sql('2.0')} AS frame, round(avg(value), 6) AS value FROM e GROUP BY 1, 2")
def downsample_mean(spark, sf):
    return _rounded(resample.downsampled(event_frames(spark, sf), 30.0, 15.0, {"value": F.avg("value")}), "value")


def _robust_sql(x: str) -> str:
    return f"CASE WHEN count({x}) < 5 THEN avg({x}) ELSE (sum({x}) - min({x}) - max({x})) / (count({x}) - 2) END"


@_query(f"WITH {E} SELECT video_id, {_bucket_sql('8.0')} AS frame, round({_robust_sql('value')}, 6) AS value, round(greatest(coalesce(median(CASE WHEN value > 1e-3 THEN value END), 1.0), 1e-3), 6) AS scale FROM e GROUP BY 1, 2")
def robust_mean(spark, sf):
    out = resample.downsampled(event_frames(spark, sf), 120.0, 15.0, {"value": resample.robust_mean(F.col("value")), "scale": resample.median_scale(F.col("value"))})
    return _rounded(out, "value", "scale")


@_query(f"""WITH {E}, n AS (SELECT video_id, {_bucket_sql('(29.97/15.0)')} AS frame, label, count(*) AS n FROM e GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY video_id, frame ORDER BY n DESC, label) AS k FROM n)
SELECT video_id, frame, label FROM r WHERE k = 1""")
def label_mode(spark, sf):
    return resample.mode_labels(event_frames(spark, sf), 29.97, 15.0)


@_query(f"""WITH {V}, x AS (SELECT video_id, {_bucket_sql('6.0')} AS frame, palm, quality, valid, unnest(range(63)) AS i, unnest(coords) AS c FROM v),
g AS (SELECT video_id, frame, i, {_robust_sql('c')} AS c, greatest(coalesce(median(CASE WHEN palm > 1e-3 THEN palm END), 1.0), 1e-3) AS s, avg(quality) AS quality, CAST(avg(valid) > 0.5 AS INT) AS valid FROM x GROUP BY ALL)
SELECT video_id, frame, CAST(i AS INT) AS channel, round(c / s, 6) AS coord, round(quality, 6) AS quality, valid FROM g""")
def aggregate_tracks(spark, sf):
    out = resample.tracks_aggregated(vector_frames(spark, sf), 90.0, 15.0, 63)
    return _rounded(out.select("video_id", "frame", F.posexplode("coords").alias("channel", "coord"), "quality", "valid"), "coord", "quality")


@_query(f"""WITH {V}, l AS (SELECT video_id, frame, coords, lag(coords) OVER (PARTITION BY video_id ORDER BY frame) AS p FROM v), x AS (SELECT video_id, frame, p IS NULL AS f, unnest(range(63)) AS i, unnest(coords) AS a, unnest(coalesce(p, coords)) AS b FROM l)
SELECT video_id, frame, CAST(i AS INT) AS channel, round((a - b) * 15.0, 6) + 0.0 AS velocity FROM x""")
def velocity(spark, sf):
    out = resample.with_velocity(vector_frames(spark, sf), FPS).select("video_id", "frame", F.posexplode("velocity").alias("channel", "velocity"))
    return out.withColumn("velocity", _r("velocity") + F.lit(0.0))


def _channels(df: DataFrame, name: str, out: str) -> DataFrame:
    return df.select("video_id", "frame", F.posexplode(name).alias("channel", out)).withColumn(out, _r(out) + F.lit(0.0))


_XYZ = f"WITH {V}, x AS (SELECT video_id, frame, unnest(range(63)) AS i, unnest(coords) AS c, coords AS p FROM v)"


@_query(f"{_XYZ} SELECT video_id, frame, CAST(i AS INT) AS channel, round(c - p[CAST(i % 3 AS INT) + 1], 6) + 0.0 AS coord FROM x")
def wrist_center(spark, sf):
    return _channels(vector_frames(spark, sf).withColumn("o", landmarks.centred(F.col("coords"))), "o", "coord")


_BONES = " + ".join(f"sqrt((coords[{3 * k + 1}] - coords[1]) ^ 2 + (coords[{3 * k + 2}] - coords[2]) ^ 2 + (coords[{3 * k + 3}] - coords[3]) ^ 2)" for k in (5, 9, 13, 17))


@_query(f"WITH {V} SELECT video_id, frame, round(greatest(({_BONES}) / 4, 1e-3), 6) AS palm FROM v")
def palm_size(spark, sf):
    return vector_frames(spark, sf).select("video_id", "frame", _r(landmarks.palm_size(F.col("coords")), "palm"))


@_query(f"{_XYZ} SELECT video_id, frame, CAST(i AS INT) AS channel, round((CASE WHEN i % 3 <> 1 THEN c * 1.5 ELSE c END), 6) + 0.0 AS coord FROM x")
def aspect_correct(spark, sf):
    return _channels(vector_frames(spark, sf).withColumn("o", landmarks.aspect_corrected(F.col("coords"), 1.5)), "o", "coord")


@_query(f"{_XYZ} SELECT video_id, frame, CAST(i AS INT) AS channel, round((CASE WHEN i % 3 = 0 THEN 1 - c ELSE c END), 6) + 0.0 AS coord FROM x")
def mirror_landmarks(spark, sf):
    return _channels(vector_frames(spark, sf).withColumn("o", landmarks.mirrored(F.col("coords"))), "o", "coord")


@_query(f"{_XYZ[:-len(' FROM v)')]}, greatest(({_BONES}) / 4, 1e-3) AS s FROM v) SELECT video_id, frame, CAST(i AS INT) AS channel, round((c - p[CAST(i % 3 AS INT) + 1]) / s, 5) + 0.0 AS coord FROM x")
def normalize_landmarks(spark, sf):
    df = vector_frames(spark, sf).withColumn("o", landmarks.normalised(F.col("coords")))
    return df.select("video_id", "frame", F.posexplode("o").alias("channel", "coord")).withColumn("coord", _r("coord", digits=5) + F.lit(0.0))


@_query(f"""WITH {V}, l AS (SELECT *, lag(coords) OVER (PARTITION BY video_id ORDER BY frame) AS p FROM v), f AS (SELECT video_id, frame, list_concat([quality, CAST(valid AS DOUBLE)], coords, list_transform(range(1, 64), lambda i: coalesce((coords[i] - p[i]) * 15.0, 0.0))) AS x FROM l), u AS (SELECT video_id, frame, unnest(range(128)) AS i, unnest(x) AS c FROM f)
SELECT video_id, frame, CAST(i AS INT) AS channel, round(CASE WHEN (i >= 2 AND i < 65 AND (i - 2) % 3 = 0) OR (i >= 65 AND (i - 65) % 3 = 0) THEN -c ELSE c END, 6) + 0.0 AS feature FROM u""")
def mirror_features(spark, sf):
    v = resample.with_velocity(vector_frames(spark, sf), FPS)
    x = resample.feature_vector(F.col("quality"), F.col("valid"), F.col("coords"), F.col("velocity"))
    return _channels(v.withColumn("o", landmarks.mirrored_features(x)), "o", "feature")


_HANDS = f"WITH {V}, h AS (SELECT video_id, frame, CAST(i AS INT) AS hand_no, CASE WHEN (frame + i) % 3 = 0 THEN -1 ELSE 1 END AS side, logits[CAST(i AS INT) + 1] AS score FROM v, range(3) t(i)), g AS (SELECT * FROM h WHERE score >= 0)"


def _hands(spark, sf):
    v = vector_frames(spark, sf).select("video_id", "frame", "logits", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("hand_no"))
    return v.select("video_id", "frame", "hand_no", F.when((F.col("frame") + F.col("hand_no")) % 3 == 0, -1).otherwise(1).alias("side"), F.get("logits", F.col("hand_no")).alias("score"))


@_query(f"{_HANDS}, r AS (SELECT *, row_number() OVER (PARTITION BY video_id, frame ORDER BY score DESC, hand_no) AS k FROM g WHERE side = 1) SELECT video_id, frame, hand_no, round(score, 6) AS score FROM r WHERE k = 1")
def strict_hand(spark, sf):
    return _rounded(landmarks.strict_hand(_hands(spark, sf), 1, 0.0), "score")


@_query(f"""{_HANDS}, r AS (SELECT *, row_number() OVER (PARTITION BY video_id, frame, side ORDER BY score DESC, hand_no) AS k FROM g), b AS (SELECT * FROM r WHERE k = 1),
o AS (SELECT *, count(*) OVER (PARTITION BY video_id, frame) AS sides, row_number() OVER (PARTITION BY video_id, frame ORDER BY score DESC, hand_no) AS z FROM b),
n AS (SELECT video_id, frame, max(sides) AS sides, max(side) FILTER (z = 1) AS top, row_number() OVER (PARTITION BY video_id ORDER BY frame) AS i FROM o GROUP BY 1, 2),
q AS (SELECT video_id, i, frame, top AS side FROM n WHERE i = 1 UNION ALL SELECT n.video_id, n.i, n.frame, CASE WHEN n.sides = 1 THEN n.top ELSE q.side END FROM q JOIN n ON n.video_id = q.video_id AND n.i = q.i + 1)
SELECT o.video_id, o.frame, o.hand_no, o.side, round(o.score, 6) AS score FROM o JOIN q ON q.video_id = o.video_id AND q.frame = o.frame AND q.side = o.side""".replace("WITH", "WITH RECURSIVE", 1))
def auto_hand(spark, sf):
    return _rounded(landmarks.auto_hand(_hands(spark, sf), 0.0), "score")


@_query(f"WITH {V}, f AS (SELECT video_id, CASE WHEN valid = 0 THEN 0 WHEN frame % 4 = 0 THEN -1 ELSE 1 END AS side FROM v), g AS (SELECT video_id, coalesce(avg(CASE WHEN side <> 0 THEN CAST(side = -1 AS INT) END), 0) AS r FROM f GROUP BY 1) SELECT video_id, round(r, 6) AS left_hand_ratio, CASE WHEN r = 0 THEN 'physical_right' WHEN r = 1 THEN 'physical_left_mirrored' ELSE 'mixed_mirrored' END AS hand_side FROM g")
def hand_sides(spark, sf):
    f = vector_frames(spark, sf).select("video_id", F.when(F.col("valid") == 0, 0).when(F.col("frame") % 4 == 0, -1).otherwise(1).alias("side"))
    return _rounded(landmarks.hand_sides(f), "left_hand_ratio")


def _gain_sql(cutoff: str) -> str:
    return f"(2 * pi() / 15 * ({cutoff})) / (2 * pi() / 15 * ({cutoff}) + 1)"


@_query(f"""WITH RECURSIVE {E}, r AS (SELECT video_id, frame, CASE WHEN valid = 1 THEN CAST(value AS DOUBLE) END AS v, 0.0::DOUBLE AS d FROM e WHERE frame = 0 UNION ALL
SELECT video_id, frame, CASE WHEN valid = 0 THEN v WHEN v IS NULL THEN x ELSE v + {_gain_sql('1.0 + 0.007 * abs(m)')} * (x - v) END, CASE WHEN valid = 0 OR v IS NULL THEN d ELSE m END
FROM (SELECT e.video_id, e.frame, e.valid, CAST(e.value AS DOUBLE) AS x, v, d, d + {_gain_sql('1.0')} * ((e.value - v) * 15 - d) AS m FROM r JOIN e ON e.video_id = r.video_id AND e.frame = r.frame + 1))
SELECT video_id, frame, round(CAST(CAST(coalesce(v, 0) AS FLOAT) AS DOUBLE), 6) AS value FROM r""")
def one_euro(spark, sf):
    return _rounded(smoothing.one_euro(event_frames(spark, sf), FPS, value="value"), "value")


# ---- audit --------------------------------------------------------------------

_CORE = f"WITH {E}, {runs('e', 'label', 's')}, z AS (SELECT e.video_id, e.frame, e.label, e.valid, (e.label <> 14 AND e.frame >= s.seg_start + floor((s.seg_end - s.seg_start) * 0.2) AND e.frame <= s.seg_end - floor((s.seg_end - s.seg_start) * 0.2) - 1) AS core FROM e JOIN s ON e.video_id = s.video_id AND e.frame >= s.seg_start AND e.frame < s.seg_end)"


@_query(f"{_CORE} SELECT video_id, round(coalesce(avg(valid) FILTER (label <> 14), avg(valid)), 6) AS detection_rate, round(coalesce(avg(valid) FILTER (core), avg(valid)), 6) AS core_detection_rate FROM z GROUP BY 1")
def detection_rates(spark, sf):
    return _rounded(audit.detection_rates(event_frames(spark, sf)), "detection_rate", "core_detection_rate")


_CLASS_RATES = f"{_CORE}, q AS (SELECT video_id, label AS class_id, avg(valid) AS detection_rate, avg(valid) FILTER (core) AS core_detection_rate FROM z WHERE label <> 14 GROUP BY 1, 2)"


@_query(f"{_CLASS_RATES} SELECT video_id, class_id, round(detection_rate, 6) AS detection_rate, round(core_detection_rate, 6) AS core_detection_rate FROM q")
def class_detection_rates(spark, sf):
    return _rounded(audit.class_rates(event_frames(spark, sf)), "detection_rate", "core_detection_rate")


@_query(f"{_CLASS_RATES}, r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY detection_rate, class_id) AS k FROM q) SELECT video_id, class_id AS min_class_id, round(detection_rate, 6) AS min_class_rate FROM r WHERE k = 1")
def worst_class(spark, sf):
    return _rounded(audit.worst_class(audit.class_rates(event_frames(spark, sf))), "min_class_rate")


@_query(f"WITH {V}, m AS (SELECT video_id, median(CASE WHEN palm > 1e-3 THEN palm END) AS m FROM v GROUP BY 1) SELECT video_id, round(CASE WHEN max(m) IS NULL THEN 1.0 ELSE avg(CAST(abs(palm - m) > greatest(3 * m, 1e-3) AS INT)) END, 6) AS palm_outlier_rate FROM v JOIN m USING (video_id) GROUP BY 1")
def palm_outliers(spark, sf):
    return _rounded(audit.palm_outliers(vector_frames(spark, sf)), "palm_outlier_rate")


@_query(f"""WITH {V}, l AS (SELECT *, lag(coords) OVER w AS p, lag(valid) OVER w AS pv FROM v WINDOW w AS (PARTITION BY video_id ORDER BY frame)),
s AS (SELECT video_id, palm, CASE WHEN valid = 1 AND pv = 1 THEN list_distance(coords, p) END AS d FROM l), m AS (SELECT video_id, greatest(coalesce(median(CASE WHEN palm > 1e-3 THEN palm END), 1.0), 1e-3) AS s, median(d) AS m, count(d) AS n FROM s GROUP BY 1),
t AS (SELECT s.video_id, s.d / m.s AS d, m.m / m.s AS m, n FROM s JOIN m USING (video_id)), k AS (SELECT video_id, median(abs(d - m)) AS mad FROM t GROUP BY 1)
SELECT t.video_id, round(CASE WHEN max(n) >= 10 THEN avg(CAST(d > m + 6 * greatest(mad, 0.1 * m, 1e-6) AS INT)) ELSE 0.0 END, 6) AS trajectory_jump_rate, max(n) >= 10 AS trajectory_jump_reliable FROM t JOIN k USING (video_id) GROUP BY 1""")
def jump_rate(spark, sf):
    return _rounded(audit.jump_rate(vector_frames(spark, sf)), "trajectory_jump_rate")


_GATE = {"detection_rate": "CASE WHEN n % 7 <> 0 THEN detection_rate END", "min_class_detection_rate": "CASE WHEN n % 3 <> 0 THEN (n % 53) / 53.0::DOUBLE END", "core_detection_rate": "CASE WHEN n % 5 <> 0 THEN (n % 47) / 47.0::DOUBLE END", "min_class_core_detection_rate": "CASE WHEN n % 4 <> 0 THEN (n % 59) / 59.0::DOUBLE END"}


@_query(f"""WITH {D}, n AS (SELECT *, CAST(string_split(video_id, '__')[2] AS BIGINT) AS n FROM d), g AS (SELECT video_id, CASE WHEN n % 11 = 0 THEN 'unknown' ELSE polarity END AS polarity, {', '.join(f'{sql} AS r_{c}' for c, sql in _GATE.items())} FROM n),
f AS (SELECT *, coalesce(r_core_detection_rate, r_detection_rate, 0) AS a, coalesce(r_min_class_core_detection_rate, r_min_class_detection_rate, r_detection_rate, 0) AS b, polarity IS DISTINCT FROM 'unknown' AS scene_valid FROM g)
SELECT video_id, scene_valid, scene_valid AND a >= 0.5 AND b >= 0.4 AS quality_passed, CASE WHEN scene_valid AND a >= 0.5 AND b >= 0.4 THEN 'passed' ELSE 'rejected' END AS status FROM f""")
def quality_gate(spark, sf):
    d = document_catalog(spark, sf).withColumn("n", F.split("video_id", "__")[1].cast("long"))
    n = F.col("n")
    rates = {"detection_rate": F.when(n % 7 != 0, F.col("detection_rate")), "min_class_detection_rate": F.when(n % 3 != 0, (n % 53) / 53.0), "core_detection_rate": F.when(n % 5 != 0, (n % 47) / 47.0), "min_class_core_detection_rate": F.when(n % 4 != 0, (n % 59) / 59.0)}
    d = d.withColumns(rates).withColumn("polarity", F.when(n % 11 == 0, "unknown").otherwise(F.col("polarity")))
    return audit.quality_gate(d, 0.5, 0.4).select("video_id", "scene_valid", "quality_passed", "status")


@_query(f"WITH {E}, m AS (SELECT video_id, avg(valid) AS r FROM e GROUP BY 1) SELECT video_id, round(CASE WHEN video_id % 4 = 0 THEN 0.25 ELSE r END, 6) AS detection_rate, CASE WHEN video_id % 4 = 0 THEN 0.25 ELSE r END < 0.9 AS low_quality FROM m")
def quality_verdict(spark, sf):
    f = event_frames(spark, sf)
    rows = f.select("video_id").distinct().withColumn("detection_rate", F.when(F.col("video_id") % 4 == 0, 0.25))
    return _rounded(audit.quality_verdict(rows, f, 0.9), "detection_rate")


@_query(f"WITH {E}, n AS (SELECT video_id, label, count(*) AS n, sum(valid) AS ok FROM e GROUP BY 1, 2) SELECT video_id, CAST(sum(n) AS BIGINT) AS num_frames, round(sum(ok) / sum(n), 6) AS valid_ratio, string_agg(concat(label, ':', n), ',' ORDER BY label) AS labels FROM n GROUP BY 1")
def sequence_summary(spark, sf):
    out = audit.sequence_summary(event_frames(spark, sf))
    pairs = F.array_sort(F.map_entries("label_counts"))
    labels = F.array_join(F.transform(pairs, lambda x: F.concat_ws(":", x["key"], x["value"])), ",")
    return _rounded(out.select("video_id", "num_frames", "valid_ratio", labels.alias("labels")), "valid_ratio")


_V_CLASS = _CLASS_RATES.replace(E, V).replace("FROM e ", "FROM v ").replace("FROM e)", "FROM v)").replace("e.", "v.").replace("(SELECT v.video_id, v.frame", "(SELECT v.video_id, v.frame")


@_query(f"""{_V_CLASS}, a AS (SELECT video_id, coalesce(avg(valid) FILTER (label <> 14), avg(valid)) AS dr, coalesce(avg(valid) FILTER (core), avg(valid)) AS cr FROM z GROUP BY 1),
wd AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY detection_rate, class_id) AS k FROM q), wc AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY core_detection_rate, class_id) AS k FROM q WHERE core_detection_rate IS NOT NULL),
{runs('v', 'valid', 'mr')}, lm AS (SELECT video_id, CAST(max(CASE WHEN label = 0 THEN seg_end - seg_start ELSE 0 END) AS INT) AS longest_missing_frames FROM mr GROUP BY 1),
pm AS (SELECT video_id, median(CASE WHEN palm > 1e-3 THEN palm END) AS m FROM v GROUP BY 1), po AS (SELECT video_id, CASE WHEN max(m) IS NULL THEN 1.0 ELSE avg(CAST(abs(palm - m) > greatest(3 * m, 1e-3) AS INT)) END AS po FROM v JOIN pm USING (video_id) GROUP BY 1),
jl AS (SELECT *, lag(coords) OVER w AS p, lag(valid) OVER w AS pv FROM v WINDOW w AS (PARTITION BY video_id ORDER BY frame)), js AS (SELECT video_id, palm, CASE WHEN valid = 1 AND pv = 1 THEN list_distance(coords, p) END AS d FROM jl),
jm AS (SELECT video_id, greatest(coalesce(median(CASE WHEN palm > 1e-3 THEN palm END), 1.0), 1e-3) AS s, median(d) AS m, count(d) AS n FROM js GROUP BY 1), jt AS (SELECT js.video_id, js.d / jm.s AS d, jm.m / jm.s AS m, n FROM js JOIN jm USING (video_id)), jk AS (SELECT video_id, median(abs(d - m)) AS mad FROM jt GROUP BY 1),
jr AS (SELECT jt.video_id, CASE WHEN max(n) >= 10 THEN avg(CAST(d > m + 6 * greatest(mad, 0.1 * m, 1e-6) AS INT)) ELSE 0.0 END AS jr, max(n) >= 10 AS ok FROM jt JOIN jk USING (video_id) GROUP BY 1)
SELECT a.video_id, round(dr, 6) AS detection_rate, round(cr, 6) AS core_detection_rate, wd.class_id AS min_class_id, round(coalesce(wd.detection_rate, dr), 6) AS min_class_detection_rate, wc.class_id AS min_class_core_id, round(coalesce(wc.core_detection_rate, cr), 6) AS min_class_core_detection_rate,
longest_missing_frames, round(longest_missing_frames / 15.0, 6) AS longest_missing_seconds, round(po, 6) AS palm_outlier_rate, round(jr, 6) AS trajectory_jump_rate, ok AS trajectory_jump_reliable
FROM a LEFT JOIN wd ON wd.video_id = a.video_id AND wd.k = 1 LEFT JOIN wc ON wc.video_id = a.video_id AND wc.k = 1 JOIN lm ON lm.video_id = a.video_id JOIN po ON po.video_id = a.video_id JOIN jr ON jr.video_id = a.video_id""")
def sequence_audit(spark, sf):
    out = audit.sequence_audit(vector_frames(spark, sf), FPS)
    return _rounded(out, *(c for c, t in out.dtypes if t == "double"))


# ---- windows and fusion ----------------------------------------------------------

_N = "n AS (SELECT video_id, CAST(max(frame) + 1 AS INT) AS num_frames FROM {src} GROUP BY 1)"


def _windows_sql(src: str, size: int, stride: int) -> str:
    last = f"greatest(num_frames - {size}, 0)"
    return f"{_N.format(src=src)}, w AS (SELECT DISTINCT video_id, CAST(st AS INT) AS win_start, CAST(least(st + {size}, num_frames) AS INT) AS win_end, num_frames FROM (SELECT video_id, num_frames, unnest(list_append(range(0, {last} + 1, {stride}), {last})) AS st FROM n))"


@_query(f"WITH {E}, {_windows_sql('e', 60, 12)} SELECT video_id, win_start, win_end FROM w")
def sliding_windows(spark, sf):
    return windows.sliding_windows(windows.lengths(event_frames(spark, sf)), 60, 12)


def _unit_sql(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE"


_LABELLED = f"WITH {E}, {_windows_sql('e', 4, 2)}, b AS (SELECT w.video_id, win_start, win_end, bool_and(label = 14) AS is_background FROM w JOIN e ON w.video_id = e.video_id AND e.frame >= win_start AND e.frame < win_end GROUP BY 1, 2, 3)"


@_query(f"{_LABELLED} SELECT video_id, win_start, win_end, is_background, CASE WHEN is_background THEN 'background' ELSE 'action' END AS window_role FROM b WHERE NOT is_background OR {_unit_sql('0', 'video_id', 'win_start')} <= 0.5")
def window_labels(spark, sf):
    return windows.labelled_windows(event_frames(spark, sf), 4, 2, keep_background=0.5)


@_query(f"""WITH {E}, {runs('e', 'label', 's')}, {_N.format(src='e')}, a AS (SELECT s.video_id, seg_start, num_frames, greatest(0, seg_end - 8) AS lo, least(seg_start, greatest(num_frames - 8, 0)) AS hi, least(greatest(CAST(floor((seg_start + seg_end - 8) / 2.0) AS INT), 0), greatest(num_frames - 8, 0)) AS mid FROM s JOIN n USING (video_id) WHERE label <> 14),
b AS (SELECT *, i, round_even(lo + (hi - lo) * i / 2.0::DOUBLE, 0) + floor({_unit_sql('0', 'video_id', 'seg_start', 'i')} * 5) - 2 AS st FROM a, range(3) t(i)),
c AS (SELECT DISTINCT video_id, num_frames, CAST(CASE WHEN hi < lo THEN mid ELSE least(greatest(st, lo), hi) END AS INT) AS win_start FROM b)
SELECT video_id, win_start, CAST(least(win_start + 8, num_frames) AS INT) AS win_end FROM c""")
def action_windows(spark, sf):
    return windows.action_windows(event_frames(spark, sf), size=8, per_segment=3, stride=4)


@_query(f"""{_LABELLED}, k AS (SELECT *, {_unit_sql('0', 'video_id', 'win_start')} AS h FROM b WHERE is_background), r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY h, win_start) AS q FROM k),
o AS (SELECT *, row_number() OVER (ORDER BY h, video_id, win_start) AS z FROM r WHERE q <= 3)
SELECT video_id, win_start, win_end FROM o WHERE z <= (SELECT greatest(1, ceil(round(count(*) * 0.05, 9))) FROM b WHERE NOT is_background)""")
def hard_negative_sample(spark, sf):
    w = windows.labelled_windows(event_frames(spark, sf), 4, 2)
    actions = w.where(~F.col("is_background")).agg(F.count("*").alias("n"))
    return windows.hard_negatives(w.where("is_background"), actions, ratio=0.05, per_video=3).select("video_id", "win_start", "win_end")


@_query(f"""WITH {E}, {_windows_sql('e', 90, 30)}, p AS (SELECT video_id, win_start, win_end, CAST(pos AS INT) AS pos FROM w, range(90) t(pos))
SELECT p.video_id, win_start, pos, round(value, 6) AS value, CASE WHEN win_start + pos < win_end THEN label ELSE -100 END AS label, CASE WHEN win_start + pos < win_end THEN CAST(valid AS DOUBLE) ELSE 0.0 END AS valid FROM p JOIN e ON e.video_id = p.video_id AND e.frame = least(win_start + pos, win_end - 1)""")
def padded_windows(spark, sf):
    f = event_frames(spark, sf)
    return _rounded(windows.padded(windows.sliding_windows(windows.lengths(f), 90, 30), f, 90, ["value"]), "value")


@_query(f"WITH {E}, {_windows_sql('e', 90, 30)} SELECT label, count(*) AS n FROM w JOIN e ON e.video_id = w.video_id AND e.frame >= win_start AND e.frame < win_end GROUP BY 1")
def window_label_counts(spark, sf):
    f = event_frames(spark, sf)
    return windows.window_label_counts(windows.padded(windows.sliding_windows(windows.lengths(f), 90, 30), f, 90, []))


_FUSED = f"WITH {V}, {_windows_sql('v', 20, 6)}, x AS (SELECT w.video_id, frame, frame - win_start AS pos, unnest(range(15)) AS class_id, unnest(logits) AS logit FROM w JOIN v ON v.video_id = w.video_id AND v.frame >= win_start AND v.frame < win_end), g AS (SELECT video_id, frame, CAST(class_id AS INT) AS class_id, sum(logit * (0.54 - 0.46 * cos(2 * pi() * pos / 19))) / greatest(sum(0.54 - 0.46 * cos(2 * pi() * pos / 19)), 1e-8) AS score FROM x GROUP BY ALL)"


def _fused(spark, sf):
    v = vector_frames(spark, sf)
    return windows.fused(windows.window_scores(windows.sliding_windows(windows.lengths(v), 20, 6), v), 20)


@_query(f"{_FUSED} SELECT video_id, frame, class_id, round(score, 6) AS score FROM g")
def hamming_fusion(spark, sf):
    return _rounded(_fused(spark, sf), "score")


@_query(f"{_FUSED}, h AS (SELECT video_id, frame, class_id, round(score, 9) AS score FROM g), r AS (SELECT *, row_number() OVER (PARTITION BY video_id, frame ORDER BY score DESC, class_id) AS k FROM h) SELECT video_id, frame, class_id AS pred FROM r WHERE k = 1")
def fused_argmax(spark, sf):
    return windows.fused_labels(_rounded_to(_fused(spark, sf), 9))


def _rounded_to(df: DataFrame, digits: int) -> DataFrame:
    return df.withColumn("score", F.round("score", digits))


# ---- post-processing ---------------------------------------------------------------


@_query(f"WITH {V}, m AS (SELECT video_id, frame, list_transform(logits, lambda x: exp(x - list_max(logits))) AS p FROM v), u AS (SELECT video_id, frame, unnest(range(15)) AS i, unnest(p) AS x, list_sum(p) AS s FROM m) SELECT video_id, frame, CAST(i AS INT) AS channel, round(x / s, 6) AS p FROM u")
def softmax(spark, sf):
    return _rounded(vector_frames(spark, sf).select("video_id", "frame", F.posexplode(S.softmax(F.col("logits"))).alias("channel", "p")), "p")


@_query(f"WITH {V} SELECT video_id, frame, CAST(list_position(logits, list_max(logits)) - 1 AS INT) AS pred FROM v")
def argmax(spark, sf):
    return vector_frames(spark, sf).select("video_id", "frame", S.first_argmax(F.col("logits")).alias("pred"))


@_query(f"WITH {V}, u AS (SELECT video_id, frame, unnest(range(15)) AS i, unnest(logits) AS x FROM v), r AS (SELECT *, row_number() OVER (PARTITION BY video_id, frame ORDER BY x DESC, i) AS k FROM u WHERE i IN (2, 5, 9, 14)) SELECT video_id, frame, CAST(i AS INT) AS pred FROM r WHERE k = 1")
def masked_argmax(spark, sf):
    v = postprocess.with_allowed_classes(vector_frames(spark, sf), S.resolve_class_ids([9, 5, 2], [f"c{i}" for i in range(15)]))
    return v.select("video_id", "frame", "pred")


_CONF = f"WITH {E}, {runs('e', 'pred', 's')}, m AS (SELECT s.video_id, s.seg_start, s.seg_end, s.label, avg(least(value / 60.0::DOUBLE, 1.0)) AS p FROM s JOIN e ON e.video_id = s.video_id AND e.frame >= seg_start AND e.frame < seg_end GROUP BY ALL)"


@_query(f"{_CONF} SELECT e.video_id, e.frame, CASE WHEN m.label <> 14 AND m.p < 0.4 THEN 14 ELSE m.label END AS pred FROM e JOIN m ON e.video_id = m.video_id AND e.frame >= m.seg_start AND e.frame < m.seg_end")
def filter_confidence(spark, sf):
    p = F.least(F.col("value") / F.lit(60.0), F.lit(1.0))
    return postprocess.filter_confidence(event_frames(spark, sf), 0.4, p).select("video_id", "frame", "pred")


_DUR = f"WITH {E}, {runs('e', 'pred', 's')}, t AS (SELECT *, lag(label) OVER w AS b, lead(label) OVER w AS a FROM s WINDOW w AS (PARTITION BY video_id ORDER BY seg_start)), m AS (SELECT *, CASE WHEN label <> 14 AND seg_end - seg_start < 2 THEN CASE WHEN b = a AND b <> 14 THEN b ELSE 14 END ELSE label END AS new_label FROM t), f AS (SELECT e.video_id, e.frame, e.pred AS old, m.new_label AS pred FROM e JOIN m ON e.video_id = m.video_id AND e.frame >= m.seg_start AND e.frame < m.seg_end)"


@_query(f"{_DUR} SELECT video_id, seg_id, label, seg_start, seg_end, CAST(new_label AS INT) AS new_label FROM m")
def filter_duration_runs(spark, sf):
    return postprocess.filter_duration_runs(timeline.segments(event_frames(spark, sf), "pred"), 2)


@_query(f"{_DUR} SELECT video_id, frame, CAST(pred AS INT) AS pred FROM f")
def filter_duration(spark, sf):
    return postprocess.filter_duration(event_frames(spark, sf), 2).select("video_id", "frame", "pred")


@_query(f"{_DUR}, {runs('f', 'pred', 'x')} SELECT c.video_id, 'duration' AS stage, changed_frames, actions_before, actions_after FROM (SELECT video_id, count(*) FILTER (old IS DISTINCT FROM pred) AS changed_frames FROM f GROUP BY 1) c JOIN (SELECT video_id, count(*) FILTER (label <> 14) AS actions_before FROM s GROUP BY 1) b USING (video_id) JOIN (SELECT video_id, count(*) FILTER (label <> 14) AS actions_after FROM x GROUP BY 1) a USING (video_id)")
def postprocess_stages(spark, sf):
    _, reports = postprocess.postprocess(event_frames(spark, sf), postprocess.Postprocess(min_seconds=2 / FPS), FPS)
    return reports[0]


_CHAIN = f"""WITH {V}, u AS (SELECT video_id, frame, logits, unnest(range(15)) AS i, unnest(logits) AS x FROM v), r AS (SELECT *, row_number() OVER (PARTITION BY video_id, frame ORDER BY x DESC, i) AS k FROM u WHERE i IN (0, 1, 2, 14)),
p AS (SELECT video_id, frame, CAST(i AS INT) AS pred, exp(x) / list_sum(list_transform(logits, lambda y: exp(y))) AS prob FROM r WHERE k = 1), {runs('p', 'pred', 's')},
c AS (SELECT s.video_id, seg_start, seg_end, label, avg(prob) AS m FROM s JOIN p ON p.video_id = s.video_id AND p.frame >= seg_start AND p.frame < seg_end GROUP BY ALL),
b AS (SELECT p.video_id, p.frame, CASE WHEN label <> 14 AND m < 0.07 THEN 14 ELSE label END AS pred FROM p JOIN c ON p.video_id = c.video_id AND p.frame >= seg_start AND p.frame < seg_end), {runs('b', 'pred', 't')},
d AS (SELECT *, lag(label) OVER w AS bf, lead(label) OVER w AS af FROM t WINDOW w AS (PARTITION BY video_id ORDER BY seg_start))
SELECT b.video_id, b.frame, CAST(CASE WHEN label <> 14 AND seg_end - seg_start < 2 THEN CASE WHEN bf = af AND bf <> 14 THEN bf ELSE 14 END ELSE label END AS INT) AS pred FROM b JOIN d ON b.video_id = d.video_id AND b.frame >= seg_start AND b.frame < seg_end"""


@_query(_CHAIN)
def postprocess_chain(spark, sf):
    config = postprocess.Postprocess(allowed=[0, 1, 2, 14], min_confidence=0.07, min_seconds=2 / FPS)
    raw = vector_frames(spark, sf).withColumn("pred", S.first_argmax(F.col("logits")))
    return postprocess.postprocess(raw, config, FPS)[0].select("video_id", "frame", "pred")


# ---- evaluation --------------------------------------------------------------------


@_query(f"WITH {E} SELECT video_id, round(avg(CAST(pred = label AS INT)), 6) AS frame_accuracy FROM e GROUP BY 1")
def frame_accuracy(spark, sf):
    return _rounded(evaluate.frame_accuracy(event_frames(spark, sf)), "frame_accuracy")


_PT = f"WITH {E}, {runs('e', 'pred', 'p')}, {runs('e', 'label', 't')}"


@_query(f"{_PT}, a AS (SELECT video_id, string_agg(chr(97 + label), '' ORDER BY seg_start) AS x FROM p GROUP BY 1), b AS (SELECT video_id, string_agg(chr(97 + label), '' ORDER BY seg_start) AS y FROM t GROUP BY 1) SELECT video_id, round((1 - levenshtein(x, y) / greatest(length(x), length(y))) * 100, 6) AS edit FROM a JOIN b USING (video_id)")
def edit_score(spark, sf):
    return _rounded(evaluate.edit_score(event_frames(spark, sf)), "edit")


_INTER = "least(p.seg_end, t.seg_end) - greatest(p.seg_start, t.seg_start)"
_HIT = f"{_PT}, h AS (SELECT p.video_id, p.label AS class_id, count(*) AS tp FROM p JOIN t ON p.video_id = t.video_id AND p.label = t.label AND p.seg_start < t.seg_end AND t.seg_start < p.seg_end WHERE p.label <> 14 AND ({_INTER}) / (p.seg_end - p.seg_start + t.seg_end - t.seg_start - ({_INTER})) >= 0.5 GROUP BY 1, 2), np AS (SELECT video_id, label AS class_id, count(*) AS n FROM p WHERE label <> 14 GROUP BY 1, 2), nt AS (SELECT video_id, label AS class_id, count(*) AS m FROM t WHERE label <> 14 GROUP BY 1, 2), k AS (SELECT video_id, class_id, coalesce(tp, 0) AS tp, coalesce(n, 0) - coalesce(tp, 0) AS fp, coalesce(m, 0) - coalesce(tp, 0) AS fn FROM np FULL JOIN nt USING (video_id, class_id) LEFT JOIN h USING (video_id, class_id))"
_F1 = "CASE WHEN tp + fp + fn = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 2.0 * tp / (2.0 * tp + fp + fn) END"


@_query(f"{_HIT} SELECT video_id, class_id, tp, fp, fn FROM k")
def segment_matches_50(spark, sf):
    return evaluate.match_counts_unique(event_frames(spark, sf), 0.5)


@_query(f"{_HIT}, s AS (SELECT video_id, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM k GROUP BY 1) SELECT video_id, round({_F1}, 6) AS f1 FROM s")
def segment_f1_50(spark, sf):
    counts = evaluate.match_counts_unique(event_frames(spark, sf), 0.5).withColumn("threshold", F.lit(0.5))
    return _rounded(evaluate.f1_by_video(counts).select("video_id", "f1"), "f1")


@_query(f"{_HIT} SELECT video_id, class_id, tp, fp, fn FROM k")
def segment_matches_greedy(spark, sf):
    """The order-dependent matcher, which has to agree with the join at 0.5."""
    return evaluate.match_counts(event_frames(spark, sf), [0.5]).drop("threshold")


_GREEDY = f"""{_PT}, pl AS (SELECT video_id, label AS class_id, list([seg_start, seg_end] ORDER BY seg_start) AS p FROM p WHERE label <> 14 GROUP BY 1, 2), tl AS (SELECT video_id, label AS class_id, list([seg_start, seg_end] ORDER BY seg_start) AS t FROM t WHERE label <> 14 GROUP BY 1, 2),
gk AS (SELECT video_id, class_id, threshold, coalesce(p, []) AS p, coalesce(t, []) AS t FROM pl FULL JOIN tl USING (video_id, class_id) CROSS JOIN (VALUES (0.1::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE)) x(threshold)),
g AS (SELECT video_id, class_id, threshold, 0 AS i, CAST([] AS BIGINT[]) AS used FROM gk UNION ALL
SELECT video_id, class_id, threshold, i + 1, CASE WHEN best > 0 AND best >= threshold THEN list_append(used, CAST(list_position(ious, best) AS BIGINT)) ELSE used END FROM (SELECT *, list_max(ious) AS best FROM (SELECT g.video_id, g.class_id, g.threshold, i, used,
list_transform(t, lambda s, j: CASE WHEN list_contains(used, CAST(j AS BIGINT)) THEN -1.0::DOUBLE ELSE CAST(greatest(0, least(p[i + 1][2], s[2]) - greatest(p[i + 1][1], s[1])) / ((p[i + 1][2] - p[i + 1][1]) + (s[2] - s[1]) - greatest(0, least(p[i + 1][2], s[2]) - greatest(p[i + 1][1], s[1]))) AS DOUBLE) END) AS ious
FROM g JOIN gk ON gk.video_id = g.video_id AND gk.class_id = g.class_id AND gk.threshold = g.threshold WHERE i < len(p)))),
gc AS (SELECT video_id, class_id, threshold, max(len(used)) AS tp, max(len(p)) - max(len(used)) AS fp, max(len(t)) - max(len(used)) AS fn FROM g JOIN gk USING (video_id, class_id, threshold) GROUP BY 1, 2, 3)""".replace("WITH", "WITH RECURSIVE", 1)
_VIDEO_F1 = f"vf AS (SELECT video_id, threshold, {_F1} AS f1 FROM (SELECT video_id, threshold, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM gc GROUP BY 1, 2))"


@_query(f"{_GREEDY} SELECT video_id, threshold, class_id, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn FROM gc")
def segment_matches_all(spark, sf):
    return evaluate.match_counts(event_frames(spark, sf), [0.1, 0.25, 0.5])


@_query(f"{_GREEDY}, {_VIDEO_F1} SELECT video_id, threshold, round(f1, 6) AS f1 FROM vf WHERE threshold < 0.5")
def segment_f1_10_25(spark, sf):
    return _rounded(evaluate.f1_by_video(evaluate.match_counts(event_frames(spark, sf), [0.1, 0.25])), "f1")


@_query(f"{_HIT}, c AS (SELECT class_id, CAST(sum(tp) AS BIGINT) tp, CAST(sum(fp) AS BIGINT) fp, CAST(sum(fn) AS BIGINT) fn FROM k GROUP BY 1), a AS (SELECT avg({_F1}) AS macro, CAST(sum(tp) AS BIGINT) tp, CAST(sum(fp) AS BIGINT) fp, CAST(sum(fn) AS BIGINT) fn FROM c) SELECT 0.5::DOUBLE AS threshold, round({_F1}, 6) AS micro_f1, round(macro, 6) AS macro_class_f1 FROM a")
def micro_macro_f1(spark, sf):
    counts = evaluate.match_counts_unique(event_frames(spark, sf), 0.5).withColumn("threshold", F.lit(0.5))
    return _rounded(evaluate.micro_macro(counts), "micro_f1", "macro_class_f1")


@_query(f"{_HIT}, c AS (SELECT class_id, CAST(sum(tp) AS BIGINT) tp, CAST(sum(fp) AS BIGINT) fp, CAST(sum(fn) AS BIGINT) fn FROM k GROUP BY 1) SELECT class_id, tp + fn AS support_segments, tp + fp AS predicted_segments, tp, fp, fn, round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS segment_precision, round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS segment_recall, round({_F1}, 6) AS segment_f1 FROM c")
def segment_report(spark, sf):
    return _rounded(evaluate.segment_report(evaluate.match_counts_unique(event_frames(spark, sf), 0.5)), "segment_precision", "segment_recall", "segment_f1")


_VIDEO = f"""{_GREEDY}, {_VIDEO_F1}, ra AS (SELECT video_id, string_agg(chr(97 + label), '' ORDER BY seg_start) AS x FROM p GROUP BY 1), rb AS (SELECT video_id, string_agg(chr(97 + label), '' ORDER BY seg_start) AS y FROM t GROUP BY 1),
vm AS (SELECT fa.video_id, frame_accuracy, edit, coalesce(f1_10, 1) AS f1_10, coalesce(f1_25, 1) AS f1_25, coalesce(f1_50, 1) AS f1_50 FROM (SELECT video_id, avg(CAST(pred = label AS INT)) AS frame_accuracy FROM e GROUP BY 1) fa
JOIN (SELECT video_id, (1 - levenshtein(x, y) / greatest(length(x), length(y))) * 100 AS edit FROM ra JOIN rb USING (video_id)) ed USING (video_id)
LEFT JOIN (SELECT video_id, max(f1) FILTER (threshold = 0.1) AS f1_10, max(f1) FILTER (threshold = 0.25) AS f1_25, max(f1) FILTER (threshold = 0.5) AS f1_50 FROM vf GROUP BY 1) sf USING (video_id))"""
_METRICS = ("frame_accuracy", "edit", "f1_10", "f1_25", "f1_50")


@_query(f"{_VIDEO} SELECT video_id, {', '.join(f'round({m}, 6) AS {m}' for m in _METRICS)} FROM vm")
def video_metrics(spark, sf):
    return _rounded(evaluate.video_metrics(event_frames(spark, sf)), *_METRICS)


@_query(f"{_VIDEO} SELECT {', '.join(f'round(avg({m}), 6) AS {m}' for m in _METRICS)} FROM vm")
def mean_metrics(spark, sf):
    return _rounded(evaluate.mean_metrics(evaluate.video_metrics(event_frames(spark, sf))), *_METRICS)


_CONFUSION = f"WITH {E}, m AS (SELECT CAST(a AS INT) AS true_id, CAST(b AS INT) AS pred_id, count(e.frame) AS n FROM range(15) x(a) CROSS JOIN range(15) y(b) LEFT JOIN e ON e.label = a AND e.pred = b GROUP BY 1, 2)"


@_query(f"{_CONFUSION} SELECT true_id, pred_id, n FROM m")
def confusion(spark, sf):
    return evaluate.confusion(event_frames(spark, sf))


_FRAME_REPORT = f"""{_CONFUSION}, r AS (SELECT true_id AS class_id, CAST(sum(n) AS BIGINT) AS s, CAST(sum(n) FILTER (true_id = pred_id) AS BIGINT) AS tp FROM m GROUP BY 1), c AS (SELECT pred_id AS class_id, CAST(sum(n) AS BIGINT) AS p FROM m GROUP BY 1), o AS (SELECT true_id AS class_id, pred_id, n, row_number() OVER (PARTITION BY true_id ORDER BY n DESC, pred_id) AS k FROM m WHERE true_id <> pred_id AND n > 0),
b AS (SELECT r.class_id, s, p, tp, p - tp AS fp, s - tp AS fn, o.pred_id, o.n FROM r JOIN c USING (class_id) LEFT JOIN o ON o.class_id = r.class_id AND k = 1),
fr AS (SELECT class_id, s AS support_frames, p AS predicted_frames, round(CASE WHEN s + p = 0 THEN NULL WHEN p = 0 THEN 0.0 ELSE tp / p END, 6) AS frame_precision, round(CASE WHEN s + p = 0 THEN NULL WHEN s = 0 THEN 0.0 ELSE tp / s END, 6) AS frame_recall, round(CASE WHEN s + p = 0 THEN NULL ELSE {_F1} END, 6) AS frame_f1, coalesce(pred_id, -1) AS top_confusion, coalesce(n, 0) AS top_confusion_frames FROM b)"""


@_query(f"{_FRAME_REPORT} SELECT * FROM fr")
def frame_prf(spark, sf):
    return _rounded(evaluate.frame_report(evaluate.confusion(event_frames(spark, sf))), "frame_precision", "frame_recall", "frame_f1")


@_query(f"{_FRAME_REPORT} SELECT class_id, frame_f1, CAST(row_number() OVER (ORDER BY frame_f1, class_id) AS INT) AS place FROM fr WHERE support_frames > 0")
def worst_classes(spark, sf):
    from pyspark.sql import Window

    r = _rounded(evaluate.frame_report(evaluate.confusion(event_frames(spark, sf))), "frame_f1")
    return evaluate.ranking(r).select("class_id", "frame_f1", F.row_number().over(Window.orderBy("frame_f1", "class_id")).alias("place"))


@_query(f"WITH {E}, {runs('e', 'label', 's')}, f AS (SELECT label, count(*) AS n, count(DISTINCT video_id) AS v FROM e GROUP BY 1), g AS (SELECT label, count(*) AS m FROM s GROUP BY 1) SELECT CAST(x AS INT) AS class_id, coalesce(n, 0) AS gt_frames, coalesce(m, 0) AS gt_segments, coalesce(v, 0) AS videos FROM range(15) t(x) LEFT JOIN f ON f.label = x LEFT JOIN g ON g.label = x")
def class_coverage(spark, sf):
    return evaluate.coverage(event_frames(spark, sf))


_REPORT = f"""{_GREEDY}, {_FRAME_REPORT.replace(f'WITH {E}, ', '', 1)}, cs AS (SELECT class_id, threshold, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM gc GROUP BY 1, 2),
cr AS (SELECT class_id, threshold, {_F1} AS f1, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall, tp + fp AS predicted FROM cs),
cw AS (SELECT class_id, {', '.join(f"max({m if m == 'predicted' else f'round({m}, 6)'}) FILTER (threshold = {x}) AS segment_{m}_{round(x * 100)}" for x in (0.1, 0.25, 0.5) for m in ('f1', 'precision', 'recall', 'predicted'))} FROM cr GROUP BY 1),
cv AS (SELECT CAST(x AS INT) AS class_id, coalesce(m, 0) AS gt_segments, coalesce(v, 0) AS videos FROM range(15) y(x) LEFT JOIN (SELECT label, count(DISTINCT video_id) AS v FROM e GROUP BY 1) f ON f.label = x LEFT JOIN (SELECT label, count(*) AS m FROM t GROUP BY 1) h ON h.label = x)
SELECT * FROM fr JOIN cv USING (class_id) LEFT JOIN cw USING (class_id)"""


@_query(_REPORT)
def per_class_report(spark, sf):
    f = event_frames(spark, sf)
    out = evaluate.per_class_report(f, evaluate.match_counts(f, [0.1, 0.25, 0.5]), [0.1, 0.25, 0.5])
    return _rounded(out, *(c for c, t in out.dtypes if t == "double"))


_NEG = f"WITH {E}, {runs('e', 'pred', 's')}, a AS (SELECT video_id, count(*) FILTER (label <> 14) AS k, sum(CASE WHEN label <> 14 THEN seg_end - seg_start ELSE 0 END) AS b, max(seg_end) AS n FROM s GROUP BY 1)"


@_query(f"{_NEG} SELECT video_id, round(b / n, 6) AS false_positive_frame_rate, k AS predicted_action_segments, round(k / (n / 900.0), 6) AS false_actions_per_minute FROM a")
def negative_video_metrics(spark, sf):
    return _rounded(evaluate.negative_metrics(event_frames(spark, sf), FPS), "false_positive_frame_rate", "false_actions_per_minute")


@_query(f"{_NEG} SELECT video_id, label AS class_id, count(*) AS n FROM s WHERE label <> 14 GROUP BY 1, 2")
def false_actions_by_class(spark, sf):
    return evaluate.false_actions_by_class(event_frames(spark, sf))


_GROUPED = f"WITH {E}, a AS (SELECT video_id, avg(CAST(pred = label AS INT)) AS acc FROM e GROUP BY 1), b AS (SELECT video_id, 'src' || video_id % 3 AS source, 'sc' || video_id % 4 AS scene, CASE WHEN video_id % 5 = 0 THEN 'negative' ELSE 'positive' END AS polarity, acc, CASE WHEN video_id % 5 = 0 THEN acc END AS neg FROM a)"


@_query(f"{_GROUPED} SELECT CASE WHEN grouping(source) = 0 THEN 'source' WHEN grouping(scene) = 0 THEN 'scene' ELSE 'polarity' END AS field, coalesce(source, scene, polarity) AS value, count(*) AS video_count, round(avg(acc), 6) AS acc, round(avg(neg), 6) AS neg FROM b GROUP BY GROUPING SETS ((source), (scene), (polarity))")
def grouped_metrics(spark, sf):
    a = evaluate.frame_accuracy(event_frames(spark, sf))
    v = F.col("video_id")
    b = a.select(v, F.concat(F.lit("src"), v % 3).alias("source"), F.concat(F.lit("sc"), v % 4).alias("scene"), F.when(v % 5 == 0, "negative").otherwise("positive").alias("polarity"), F.col("frame_accuracy").alias("acc"), F.when(v % 5 == 0, F.col("frame_accuracy")).alias("neg"))
    return _rounded(evaluate.grouped_metrics(b, ["source", "scene", "polarity"], ["acc", "neg"]), "acc", "neg")


@_query(f"WITH {E}, a AS (SELECT video_id, avg(valid) AS r, avg(CAST(pred = label AS INT)) AS acc FROM e GROUP BY 1) SELECT count(*) AS videos, count(*) FILTER (r < 0.9) AS low_quality, count(*) FILTER (video_id % 2 = 1) AS changed, round(avg(acc) FILTER (video_id % 2 = 1), 6) AS raw_accuracy, round(avg(acc / 2) FILTER (video_id % 2 = 1), 6) AS filtered_accuracy FROM a")
def annotate_report(spark, sf):
    a = event_frames(spark, sf).groupBy("video_id").agg(F.avg("valid").alias("detection_rate"), F.avg((F.col("pred") == F.col("label")).cast("int")).alias("raw_accuracy"))
    a = a.withColumn("filtered_accuracy", F.col("raw_accuracy") / 2).withColumn("changed", F.col("video_id") % 2)
    return _rounded(evaluate.run_report(a, 0.9), "raw_accuracy", "filtered_accuracy")


# ---- catalogue -----------------------------------------------------------------------

_FIELDS = ("status", "source", "subject_id", "scene", "polarity")


_ERROR = "CASE CAST(string_split(video_id, '__')[2] AS BIGINT) % 4 WHEN 0 THEN 'missing_video;invalid_name' WHEN 1 THEN 'invalid_name' WHEN 2 THEN '' END"


@_query(f"WITH {D} " + " UNION ALL ".join(f"SELECT '{f}' AS field, coalesce({f}, 'unknown') AS value, count(*) AS n FROM d GROUP BY 2" for f in _FIELDS) + f" UNION ALL SELECT 'error', c, count(*) FROM (SELECT unnest(string_split({_ERROR}, ';')) AS c FROM d) WHERE c <> '' GROUP BY 2")
def inventory_summary(spark, sf):
    n = F.split("video_id", "__")[1].cast("long") % 4
    d = document_catalog(spark, sf).withColumn("error", F.when(n == 0, "missing_video;invalid_name").when(n == 1, "invalid_name").when(n == 2, ""))
    return catalog.inventory_summary(d, _FIELDS)


@_query(f"WITH {D} SELECT coalesce(status, 'unknown') AS status, count(*) AS n FROM d GROUP BY 1")
def status_summary(spark, sf):
    return catalog.status_summary(document_catalog(spark, sf))


@_query("SELECT p_partkey, replace(lower(trim(p_name)), '_', '-') AS scene FROM part")
def normalize_scene(spark, sf):
    return table(spark, sf, "part").select("p_partkey", catalog.normal_scene(F.col("p_name")).alias("scene"))


TAXONOMY = {"exact": {"EN": {"polarity": "positive", "category": "posture"}, "de": "negative", "fr": {"polarity": "negative", "category": "confounder", "hard_negative": True}}, "aliases": {"es": "fr"}}


_KNOWN = "scene IN ('en', 'de', 'fr', 'es') AND n % 10 <> 0"


@_query(f"""WITH {D}, n AS (SELECT *, CAST(string_split(video_id, '__')[2] AS BIGINT) AS n FROM d)
SELECT video_id, CASE WHEN {_KNOWN} THEN CASE scene WHEN 'en' THEN 'en' WHEN 'de' THEN 'de' ELSE 'fr' END END AS scene, CASE WHEN {_KNOWN} THEN CASE scene WHEN 'en' THEN 'positive' ELSE 'negative' END END AS polarity, CASE WHEN {_KNOWN} THEN CASE scene WHEN 'en' THEN 'posture' ELSE 'confounder' END ELSE 'unknown' END AS scene_category, coalesce({_KNOWN} AND scene <> 'en', false) AS hard_negative_eligible FROM n""")
def scene_resolve(spark, sf):
    """Every tenth scene has a name that isn't listed."""
    n = F.split("video_id", "__")[1].cast("long")
    rows = document_catalog(spark, sf).select("video_id", F.when(n % 10 == 0, F.concat("scene", F.lit("-other"))).otherwise(F.col("scene")).alias("scene_raw"))
    return catalog.resolved_scenes(rows, catalog.taxonomy_frame(spark, TAXONOMY)).drop("scene_raw")


@_query("""WITH n AS (SELECT page_id, replace(replace(replace(url, '://', '_'), '/', '_'), '.', '_') AS name FROM pages), s AS (SELECT page_id, string_split(name, '_') AS p FROM n), g AS (SELECT *, len(p) >= 4 AND NOT list_contains(p[1:4], '') AS ok FROM s)
SELECT page_id, CASE WHEN ok THEN p[1] END AS subject_id, CASE WHEN ok THEN p[2] END AS gender, CASE WHEN ok THEN p[3] END AS field3, CASE WHEN ok THEN p[4] END AS scene_raw, CASE WHEN NOT ok THEN 'invalid_name' END AS name_error, CASE WHEN upper(p[3]) IN ('L', 'R') THEN upper(p[3]) END AS side FROM g""")
def name_parse(spark, sf):
    name = F.replace(F.replace(F.replace("url", F.lit("://"), F.lit("_")), F.lit("/"), F.lit("_")), F.lit("."), F.lit("_"))
    n = table(spark, sf, "pages").select("page_id", name.alias("name"))
    return n.withColumns(catalog.name_parts(F.col("name"))).withColumn("side", catalog.hand_side(F.col("name"))).drop("name")


@_query(f"WITH {D}, r AS (SELECT video_id, source, row_number() OVER (PARTITION BY source ORDER BY video_id) AS k FROM d WHERE polarity IN ('positive', 'negative')) SELECT video_id, source FROM r WHERE k <= 5")
def top_n_per_source(spark, sf):
    return catalog.selected(document_catalog(spark, sf), limit=5).select("video_id", "source")


@_query(f"WITH {D} SELECT video_id FROM d WHERE quality_passed AND video_id NOT IN (SELECT video_id FROM d WHERE dirty)")
def dirty_anti_join(spark, sf):
    d = document_catalog(spark, sf)
    return catalog.without_dirty(d.where("quality_passed"), d.where("dirty")).select("video_id")


@_query(f"WITH {D} SELECT video_id FROM d WHERE quality_passed AND dirty")
def excluded_report(spark, sf):
    d = document_catalog(spark, sf)
    return catalog.excluded(d.where("quality_passed"), d.where("dirty")).select("video_id")


_SPLIT = f"WITH {D}, k AS (SELECT subject_id, row_number() OVER (ORDER BY h, subject_id) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT subject_id, {_unit_sql('0', 'subject_id')} AS h FROM d)), s AS (SELECT subject_id, CASE WHEN r <= greatest(1, round_even(n * 0.7, 0)) THEN 'train' WHEN r <= greatest(1, round_even(n * 0.7, 0)) + greatest(1, round_even(n * 0.15, 0)) THEN 'validation' ELSE 'test' END AS split FROM k)"


@_query(f"{_SPLIT} SELECT subject_id, split FROM s")
def subject_split(spark, sf):
    return catalog.hashed_splits(document_catalog(spark, sf), "subject_id", (0.7, 0.15, 0.15))


@_query(f"WITH {D}, k AS (SELECT video_id, row_number() OVER (ORDER BY h, video_id) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT video_id, {_unit_sql('5', 'video_id')} AS h FROM d)) SELECT video_id, CASE WHEN r <= greatest(1, round_even(n * 0.8, 0)) THEN 'train' WHEN r <= greatest(1, round_even(n * 0.8, 0)) + greatest(1, round_even(n * 0.1, 0)) THEN 'validation' ELSE 'test' END AS split FROM k")
def video_split(spark, sf):
    return catalog.hashed_splits(document_catalog(spark, sf), "video_id", (0.8, 0.1, 0.1), 5)


@_query(f"""WITH {D}, z AS (SELECT subject_id, count(*) AS n, {_unit_sql('3', 'subject_id')} AS h FROM d GROUP BY 1), k AS (SELECT subject_id, row_number() OVER w AS r, count(*) OVER () AS c, (sum(n) OVER w - n / 2) / sum(n) OVER () AS m FROM z WINDOW w AS (ORDER BY h, subject_id))
SELECT subject_id, CASE WHEN r = 1 THEN 'train' WHEN r = c THEN 'test' WHEN r = c - 1 THEN 'validation' WHEN m < 0.6::DOUBLE THEN 'train' WHEN m < 0.6::DOUBLE + 0.2::DOUBLE THEN 'validation' ELSE 'test' END AS split FROM k""")
def grouped_split(spark, sf):
    return catalog.grouped_splits(document_catalog(spark, sf), "subject_id", (0.6, 0.2, 0.2), 3)


@_query(f"{_SPLIT} SELECT subject_id, split FROM s")
def registered_split(spark, sf):
    d = document_catalog(spark, sf)
    return catalog.registered_splits(d, "subject_id", catalog.hashed_splits(d, "subject_id", (0.7, 0.15, 0.15)))


@_query(f"{_SPLIT} SELECT video_id, split, source, subject_id, scene, polarity FROM d JOIN s USING (subject_id) WHERE quality_passed AND NOT dirty AND scene IN ('en', 'de') AND (split = 'test' OR source <> 'src0')")
def manifest_records(spark, sf):
    d = document_catalog(spark, sf)
    splits = catalog.hashed_splits(d, "subject_id", (0.7, 0.15, 0.15))
    names = [f"src{i}" for i in range(1, 40)]
    return catalog.manifest_records(d, splits, d.where("dirty"), scenes=["en", "de"], train_sources=names).select("video_id", "split", "source", "subject_id", "scene", "polarity")


@_query("SELECT CAST(l_orderkey AS VARCHAR) AS video_id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def leakage_check(spark, sf):
    return catalog.leaks(table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("video_id")))


@_query(f"WITH {E}, n AS (SELECT CAST(x AS INT) AS class_id, count(e.frame) AS n FROM range(15) t(x) LEFT JOIN e ON e.label = x GROUP BY 1), r AS (SELECT class_id, CASE WHEN n > 0 THEN sum(n) OVER () / (count(*) FILTER (n > 0) OVER () * n) END AS w FROM n), m AS (SELECT *, min(w) OVER () * 2 AS top FROM r) SELECT class_id, round(coalesce(least(w, top), top), 6) AS weight FROM m")
def class_weights(spark, sf):
    return _rounded(catalog.class_weights(event_frames(spark, sf), max_ratio=2.0), "weight")


@_query(f"WITH {V}, l AS (SELECT video_id, frame, logits, valid, lag(logits) OVER w AS p, lag(valid) OVER w AS pv FROM v WINDOW w AS (PARTITION BY video_id ORDER BY frame)), u AS (SELECT unnest(logits) AS a, unnest(p) AS b FROM l WHERE valid = 1 AND pv = 1) SELECT round(avg(least((a - b) ^ 2, 0.05)), 6) AS tmse FROM u")
def tmse(spark, sf):
    return _rounded(catalog.smoothness(vector_frames(spark, sf), "logits", clamp=0.05), "tmse")


def _print_sql(*columns: str) -> str:
    text = ", ".join(f"coalesce(concat(length(CAST({c} AS VARCHAR)), ':' || CAST({c} AS VARCHAR)), '-')" for c in columns).replace("concat(length", "(length").replace(")), ':' ||", ")) || ':' ||")
    return f"substr(sha256(concat({text})), 1, 16)"


@_query(f"SELECT doc_id, {_print_sql('source', 'lang', 'n_chars')} AS fingerprint FROM documents")
def fingerprints(spark, sf):
    return table(spark, sf, "documents").select("doc_id", catalog.row_fingerprint(F.col("source"), F.col("lang"), F.col("n_chars")).alias("fingerprint"))


@_query(f"WITH {D}, o AS (SELECT video_id, {_print_sql('source', 'scene')} AS f FROM d WHERE quality_passed) SELECT d.video_id FROM d LEFT JOIN o USING (video_id) WHERE {_print_sql('source', 'scene')} IS DISTINCT FROM o.f")
def cache_misses(spark, sf):
    d = document_catalog(spark, sf).withColumn("fingerprint", catalog.row_fingerprint(F.col("source"), F.col("scene")))
    return catalog.stale(d, d.where("quality_passed").select("video_id", "fingerprint")).select("video_id")


@_query(f"WITH {E}, {D.replace('d AS', 'dd AS', 1)} SELECT DISTINCT video_id FROM e WHERE video_id % 5 = 0 AND label <> 14")
def annotation_conflicts(spark, sf):
    f = event_frames(spark, sf)
    entries = f.select("video_id").distinct().withColumn("polarity", F.when(F.col("video_id") % 5 == 0, "negative").otherwise("positive"))
    return catalog.conflicts(f, entries)


@_query(f"WITH {E}, q AS (SELECT video_id FROM e GROUP BY 1 HAVING bool_and(label = 14 OR video_id % 4 = 0)) SELECT video_id FROM q WHERE video_id % 3 = 0 AND video_id % 2 = 0")
def hard_negative_videos(spark, sf):
    """A fourth of the videos stand for recordings without any action."""
    v = F.col("video_id")
    f = event_frames(spark, sf).withColumn("label", F.when(v % 4 == 0, 14).otherwise(F.col("label")))
    entries = f.select("video_id").distinct().select(v, F.when(v % 3 == 0, " Negative ").otherwise("positive").alias("polarity"), F.when(v % 2 == 0, "Yes").otherwise("no").alias("hard_negative_eligible"))
    return windows.hard_negative_videos(f, entries)


@_query(f"WITH {E}, {_windows_sql('e', 90, 30)} SELECT label, count(*) AS n, round(avg(CAST(pred = label AS INT)), 6) AS accuracy FROM w JOIN e ON e.video_id = w.video_id AND e.frame >= win_start AND e.frame < win_end GROUP BY 1")
def window_accuracy(spark, sf):
    f = event_frames(spark, sf)
    return _rounded(windows.window_accuracy(windows.padded(windows.sliding_windows(windows.lengths(f), 90, 30), f, 90, ["pred"])), "accuracy")


@_query(f"WITH {E} SELECT video_id, frame, pred, label FROM e")
def aligned_predictions(spark, sf):
    f = event_frames(spark, sf)
    return evaluate.aligned(f.select("video_id", "frame", "pred"), f.select("video_id", "frame", "label"))


@_query(f"WITH {D} SELECT video_id, CASE WHEN quality_passed THEN coalesce(status, 'none') ELSE 'missing_track' END AS status FROM d")
def missing_tracks(spark, sf):
    d = document_catalog(spark, sf).withColumn("status", F.coalesce("status", F.lit("none")))
    return catalog.with_state(d, d.where("quality_passed")).select("video_id", "status")


@_query(f"WITH {D} SELECT video_id, CASE WHEN NOT dirty THEN concat(source, '/', video_id) END AS annotation_path, concat(source, CASE WHEN dirty THEN '/NOVA project/gestures.annotation~' ELSE '/NOVA project/gestures.pred.annotation~' END) AS output_path, NOT dirty AS shadowed FROM d")
def annotation_outputs(spark, sf):
    """Annotations that are the engine's own are forgotten; beside the others, the output gets another name."""
    d = document_catalog(spark, sf).withColumn("annotation_path", F.concat("source", F.lit("/"), "video_id")).withColumn("directory_path", F.col("source"))
    out = catalog.annotation_output(catalog.own_annotations_forgotten(d, d.where("dirty").select("annotation_path")))
    return out.select("video_id", "annotation_path", "output_path", "shadowed")


@_query(f"WITH {D} SELECT video_id FROM d WHERE status IS NULL OR status <> 'passed'")
def incompatible_records(spark, sf):
    d = document_catalog(spark, sf).withColumnsRenamed({"status": "preprocess_fingerprint"}).withColumn("preprocess_config_fingerprint", F.lit(None).cast("string"))
    return catalog.incompatible(d, ["passed"]).select("video_id")


@_query(f"WITH {E} SELECT video_id, frame, ['click', 'purchase', 'signup'][label + 1] AS name FROM e WHERE label < 3")
def class_names(spark, sf):
    return event_frames(spark, sf).where("label < 3").select("video_id", "frame", S.class_name(F.col("label"), ["click", "purchase", "signup"]).alias("name"))


@_query(f"WITH {E}, {runs('e', 'pred', 'p')}, {runs('e', 'label', 't')}, {runs('e', 'valid', 'k')}, {runs('e', 'CAST(pred <> label AS INT)', 'x')} SELECT video_id, 'prediction' AS strip, seg_start, seg_end, label AS value FROM p UNION ALL SELECT video_id, 'truth', seg_start, seg_end, label FROM t UNION ALL SELECT video_id, 'tracking', seg_start, seg_end, label FROM k UNION ALL SELECT video_id, 'errors', seg_start, seg_end, label FROM x")
def timeline_strips(spark, sf):
    from ..sources import sinks

    return sinks.timeline_strips(event_frames(spark, sf))


@_query(f"WITH {E} SELECT label, count(*) AS n FROM e GROUP BY 1")
def label_counts(spark, sf):
    return catalog.label_interval_counts(event_frames(spark, sf))


_EV_FRAMES = f"{_FUSED}, hh AS (SELECT video_id, frame, class_id, round(score, 9) AS score FROM g), rr AS (SELECT *, row_number() OVER (PARTITION BY video_id, frame ORDER BY score DESC, class_id) AS k FROM hh), e AS (SELECT v.video_id, v.frame, v.label, rr.class_id AS pred FROM rr JOIN v ON v.video_id = rr.video_id AND v.frame = rr.frame WHERE k = 1)"


@_query(f"{_EV_FRAMES.replace('g AS (', 'fg AS (').replace('FROM g)', 'FROM fg)')}, {_VIDEO.split(E + ', ', 1)[1]} SELECT video_id, {', '.join(f'round({m}, 6) AS {m}' for m in _METRICS)} FROM vm".replace("WITH ", "WITH RECURSIVE ", 1))
def full_video_evaluation(spark, sf):
    """Window scores, fusion, labels and the metrics of each video."""
    v = vector_frames(spark, sf)
    config = evaluation.Evaluation(size=20, stride=6)
    scores = windows.fused(windows.window_scores(windows.sliding_windows(windows.lengths(v), 20, 6), v), 20)
    return _rounded(evaluation.full_videos(_rounded_to(scores, 9), v.select("video_id", "frame", "label"), config), *_METRICS)


@_query(f"""WITH {V}, x AS (SELECT video_id, frame, list_transform(coords, lambda c: floor(c * 64)) AS f FROM v), s AS (SELECT video_id, frame, CAST(c AS INT) AS class_id, f, c FROM x, range(15) y(c))
SELECT video_id, frame, class_id, round(list_sum(list_transform(f, lambda a, i: a * ((c * 7 + (i - 1) * 3) % 11 - 5))), 3) + 0.0 AS score FROM s""")
def linear_model_scores(spark, sf):
    """A model with whole weights over whole features, through windows and fusion."""
    v = vector_frames(spark, sf).withColumn("features", F.transform("coords", lambda c: F.floor(c * 64).cast("double")))
    weights = [[(c * 7 + k * 3) % 11 - 5 for k in range(63)] for c in range(15)]
    out = evaluation.scored(v, scoring.build("linear", weights=weights), evaluation.Evaluation(size=20, stride=6))
    return out.withColumn("score", _r("score", digits=3) + F.lit(0.0))


def _assembled(spark, sf):
    v = vector_frames(spark, sf)
    tracks = v.select("video_id", "frame", F.col("coords").alias("landmarks"), "valid", F.col("quality"), F.when(F.col("valid") == 0, 0).when(F.col("frame") % 4 == 0, -1).otherwise(1).alias("side"))
    spans = timeline.action_spans(timeline.segments(v))
    notes = spans.select("video_id", F.col("seg_id").alias("line_no"), (F.col("seg_start") / 30.0).alias("start_sec"), (F.col("seg_end") / 30.0).alias("end_sec"), "label")
    return assemble.assembled(tracks, notes, 30.0)


@_query(f"""WITH RECURSIVE {V}, m AS (SELECT video_id, frame, valid, CASE WHEN valid = 1 AND frame % 4 = 0 THEN list_transform(coords, lambda c, i: CASE WHEN (i - 1) % 3 = 0 THEN -c ELSE c END) ELSE coords END AS p FROM v),
z AS (SELECT video_id, frame, valid, CAST(p[4] - p[1] AS DOUBLE) AS x FROM m), """ + """r AS (SELECT video_id, frame, CASE WHEN valid = 1 THEN x END AS v, 0.0::DOUBLE AS d FROM z WHERE frame = 0 UNION ALL
SELECT video_id, frame, CASE WHEN valid = 0 THEN v WHEN v IS NULL THEN x ELSE v + GAIN2 * (x - v) END, CASE WHEN valid = 0 OR v IS NULL THEN d ELSE w END FROM (SELECT z.video_id, z.frame, z.valid, x, v, d, d + GAIN1 * ((x - v) * 30 - d) AS w FROM r JOIN z ON z.video_id = r.video_id AND z.frame = r.frame + 1))
SELECT video_id, frame, round(CAST(CAST(coalesce(v, 0) AS FLOAT) AS DOUBLE), 5) + 0.0 AS x FROM r""".replace("GAIN1", _gain_sql("1.0").replace("15", "30")).replace("GAIN2", _gain_sql("1.0 + 0.007 * abs(w)").replace("15", "30")))
def assembled_channel(spark, sf):
    """One channel of the tracks that the assembly makes at the source rate: mirrored, centred, smoothed and filled."""
    v = vector_frames(spark, sf)
    tracks = v.select("video_id", "frame", F.col("coords").alias("landmarks"), "valid", "quality", F.when(F.col("valid") == 0, 0).when(F.col("frame") % 4 == 0, -1).otherwise(1).alias("side"))
    return assemble.source_tracks(tracks, 30.0, assemble.Assembly()).select("video_id", "frame", (_r(F.get("coords", F.lit(3)), digits=5) + F.lit(0.0)).alias("x"))


@_query(f"WITH {V}, n AS (SELECT video_id, frame // 2 AS b, label, count(*) AS n, min(frame) AS f FROM v GROUP BY 1, 2, 3), k AS (SELECT *, row_number() OVER (PARTITION BY video_id, b ORDER BY n DESC, label) AS k FROM n) SELECT video_id, CAST(b AS INT) AS frame, label FROM k WHERE k = 1")
def assembled_labels(spark, sf):
    """The labels of assembled sequences at half the source rate."""
    return _assembled(spark, sf)[0].select("video_id", "frame", "label")


@_query(f"WITH {V} SELECT video_id, 'ready' AS status FROM v WHERE video_id % 3 > 0 GROUP BY 1 HAVING bool_and(label = 14 OR video_id % 2 = 0) UNION ALL SELECT video_id, 'annotation_conflict' FROM v WHERE video_id % 3 > 0 GROUP BY 1 HAVING NOT bool_and(label = 14 OR video_id % 2 = 0) UNION ALL SELECT DISTINCT video_id, 'missing_track' FROM v WHERE video_id % 3 = 0")
def assembly_outcomes(spark, sf):
    """Every third video has no track; odd ones are of negative scenes."""
    v = vector_frames(spark, sf)
    i = F.col("video_id")
    entries = v.select(i).distinct().select(i, F.lit("s").alias("source"), F.when(i % 2 == 0, "positive").otherwise("negative").alias("polarity"), F.lit("ready").alias("status"))
    return assemble.outcome(entries, entries.where(i % 3 > 0), v.where(i % 3 > 0).select("video_id", "frame", "label")).select("video_id", "status")
