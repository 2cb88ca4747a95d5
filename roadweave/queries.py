"""Registered queries of the road-mapping operators and their SQL.

The driver's tables stand in for surveys: ``events`` are poses and log rows,
``lineitem`` pixels seen by frames (orders) and edges, ``embeddings`` points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadweave.functions import camera, geo
from roadweave.functions import geometry as g
from roadweave.operators import blend, boxparser, graphs, grid, lanes, linegraph, lineorder, placement, poses
from roadweave.operators.components import near_components
from roadweave.sources import store
from roadweave.storage import parts

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with its SQL where there is one."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column) -> Column:
    """Six decimals, no negative zero."""
    return F.round(c, 6) + F.lit(0.0)


def trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as poses: t in microseconds, x the value, y the second within an hour."""
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", t.alias("t"), F.col("value").alias("x"), (F.floor(t / 1_000_000) % 3600).cast("double").alias("y"))


SQL_TRAJECTORY = "traj as (select event_id, user_id, event_type, epoch_us(ts) as t, value as x, (epoch_us(ts) // 1000000 % 3600)::double as y from events)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", *[e[k].cast("double").alias(n) for k, n in enumerate(("x", "y", "z", "dx", "dy"))])


SQL_POINTS = "pts as (select vec_id, label, embedding[1]::double as x, embedding[2]::double as y, embedding[3]::double as z, embedding[4]::double as dx, embedding[5]::double as dy from embeddings)"


def seen_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One class per (frame, pixel), weight 1."""
    li = table(spark, sf_dir, "lineitem")
    seen = li.select(F.col("l_orderkey").alias("frame"), (F.col("l_partkey") % 50).cast("int").alias("row"), (F.col("l_suppkey") % 50).cast("int").alias("col"), F.col("l_linenumber").alias("cls"))
    # dealt by frame, so that what is grouped or joined by frame later is in place
    return seen.repartition(parts(li), "frame").groupBy("frame", "row", "col").agg(F.min("cls").alias("cls")).withColumn("weight", F.lit(1.0))


SQL_PIXELS = "px as (select l_orderkey as frame, (l_partkey % 50)::int as row, (l_suppkey % 50)::int as col, min(l_linenumber) as cls, 1.0::double as weight from lineitem group by 1, 2, 3)"

R_GRAPH = 0.03


# Poses and trajectories


@query(f"""
with {SQL_TRAJECTORY}, u as (
  select event_id, user_id, t, x, case event_type when 'view' then 0 else 1 end as k from traj
), w as (
  select *, case when k = 0 then {{'t': t, 'x': x}} end as p from u
), n as (
  select *, last_value(p ignore nulls) over (partition by user_id order by t, k, event_id rows between unbounded preceding and current row) as b,
         first_value(p ignore nulls) over (partition by user_id order by t, k, event_id rows between current row and unbounded following) as a
  from w
)
select event_id, user_id, round(case when b is null then a.x when a is null or b.t = t then b.x
  else b.x + (a.x - b.x) * coalesce((t - b.t)::double / nullif(a.t - b.t, 0), 0) end, 6) + 0.0 as aligned_x
from n where k = 1""")
def pose_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All other events aligned to a log of views, user by user."""
    t = trajectory(spark, sf_dir)
    frames = t.where("not event_type <=> 'view'").select("event_id", "user_id", "t")
    log = t.where("event_type = 'view'").select("event_id", "user_id", "t", "x")
    out = poses.align(frames, log, ["x"], on="t", by=["user_id"], order="event_id")
    return out.select("event_id", "user_id", r6(F.col("x")).alias("aligned_x"))


@query(f"""
with {SQL_TRAJECTORY}, w as (select *, lag(x) over p as px, lag(y) over p as py from traj window p as (partition by user_id order by t, event_id))
select event_id, round(atan2(y - py, x - px), 6) + 0.0 as heading from w""")
def motion_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3, F8."""
    return poses.motion_heading(trajectory(spark, sf_dir), ["t", "event_id"], ["user_id"]).select("event_id", r6(F.col("heading")).alias("heading"))


@query(f"""
with {SQL_TRAJECTORY}, w as (select *, x - lag(x) over p as dx, y - lag(y) over p as dy from traj window p as (partition by user_id order by t, event_id)),
n as (select *, dx / nullif(sqrt(dx * dx + dy * dy), 0) as ux, dy / nullif(sqrt(dx * dx + dy * dy), 0) as uy from w),
s as (select *, sum(ux) over p as sx, sum(uy) over p as sy from n window p as (partition by user_id order by t, event_id rows between 2 preceding and current row))
select event_id, round(sx / nullif(sqrt(sx * sx + sy * sy), 0), 6) + 0.0 as dir_x, round(sy / nullif(sqrt(sx * sx + sy * sy), 0), 6) + 0.0 as dir_y from s""")
def robust_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4, F9."""
    out = poses.robust_direction(trajectory(spark, sf_dir), ["t", "event_id"], ["user_id"])
    return out.select("event_id", r6(F.col("dir_x")).alias("dir_x"), r6(F.col("dir_y")).alias("dir_y"))


def chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = poses.frame_numbers(trajectory(spark, sf_dir), ["t", "event_id"], ["user_id"])
    return framed.withColumn("chunk", poses.chunk_of(F.col("frame"), 20))


SQL_CHUNKS = "ch as (select *, ((row_number() over (partition by user_id order by t, event_id) - 1) // 20)::int as chunk from traj)"


@query(f"with {SQL_TRAJECTORY}, {SQL_CHUNKS} select user_id, chunk, min(x) as min_x, min(y) as min_y, max(x) as max_x, max(y) as max_y, count(*) as n from ch group by 1, 2")
def chunk_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, J3."""
    return poses.extents(chunked(spark, sf_dir), ["user_id", "chunk"])


@query(f"""with {SQL_TRAJECTORY}, {SQL_CHUNKS}, e as (select user_id, chunk, min(x) as a, min(y) as b, max(x) as c, max(y) as d, count(*) as n from ch group by 1, 2)
select user_id, min(a) as min_x, min(b) as min_y, max(c) as max_x, max(d) as max_y, sum(n)::bigint as n from e group by 1""")
def map_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: extents of a set of chunks."""
    return poses.merge_extents(poses.extents(chunked(spark, sf_dir), ["user_id", "chunk"]), ["user_id"])


@query(f"""with {SQL_TRAJECTORY}, {SQL_CHUNKS}, e as (select user_id, chunk, min(x) as a, min(y) as b, max(x) as c, max(y) as d from ch group by 1, 2)
select event_id, count(*) as chunks, min(e.chunk) as first_chunk from traj join e on traj.user_id = e.user_id and x between a and c and y between b and d group by 1""")
def point_in_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks whose extents hold each position."""
    hit = grid.points_in_boxes(trajectory(spark, sf_dir), poses.extents(chunked(spark, sf_dir), ["user_id", "chunk"]), 500.0, ["user_id"])
    return hit.groupBy(F.col("p.event_id").alias("event_id")).agg(F.count("*").alias("chunks"), F.min("b.chunk").alias("first_chunk"))


@query(f"""with {SQL_TRAJECTORY}, f as (select *, (row_number() over (partition by user_id order by t, event_id) - 1)::int as frame from traj)
select event_id, user_id, frame - 5 as frame from f where frame >= 5 and frame < 45 and (frame - 5) % 3 = 0""")
def frame_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice, then every third frame."""
    framed = poses.frame_numbers(trajectory(spark, sf_dir), ["t", "event_id"], ["user_id"])
    return poses.every(poses.frame_slice(framed, 5, 45), 0, 40, 3).select("event_id", "user_id", "frame")


@query(f"""with {SQL_TRAJECTORY}, e as (select user_id, min(x) as a, min(y) as b, max(x) as c, max(y) as d from traj group by 1), m as (select *, trunc(30 * 0.05) as off from e)
select user_id, a - off as tl_x, d + off as tl_y, c + off as br_x, b - off as br_y, ceil((d + off - (b - off)) / 0.05)::int as h_px, ceil((c + off - (a - off)) / 0.05)::int as w_px from m""")
def anchored_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchored extents in metres and pixels."""
    e = poses.extents(trajectory(spark, sf_dir), ["user_id"])
    x = e.select("user_id", poses.anchored(0.05, F.col("min_x"), F.col("min_y"), F.col("max_x"), F.col("max_y"), 30).alias("e"))
    return x.select("user_id", *[F.col(f"e.{k}").alias(k) for k in ("tl_x", "tl_y", "br_x", "br_y", "h_px", "w_px")])


@query(f"""with {SQL_TRAJECTORY} select user_id, round(avg(x), 6) + 0.0 as x, round(avg(y), 6) + 0.0 as y, count(*) as cameras from traj group by 1""")
def multi_camera_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as cameras of a frame."""
    t = trajectory(spark, sf_dir).select(F.col("user_id").alias("frame"), F.col("event_type").alias("camera"), "x", "y", F.lit(0.0).alias("z"), F.lit("").alias("path"), F.col("y").alias("heading"))
    return poses.multi_camera(t).select(F.col("frame").alias("user_id"), r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"), F.size("cameras").cast("long").alias("cameras"))


@query("""with a as (select user_id as frame, count(*) as n, max(value) as top from events where event_type = 'view' group by 1), b as (select user_id as frame, count(*) as n, max(value) as top from events where event_type is distinct from 'view' group by 1)
select a.frame, a.n as main_n, b.n as other_n, round(a.top - b.top, 6) + 0.0 as apart from a join b using (frame)""")
def paired_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames that two sources share."""
    e = table(spark, sf_dir, "events")
    of = lambda kind: e.where(kind).groupBy(F.col("user_id").alias("frame")).agg(F.count("*").alias("n"), F.max("value").alias("top"))
    x = poses.paired(of("event_type = 'view'"), of("not event_type <=> 'view'"))
    return x.select("frame", F.col("main.n").alias("main_n"), F.col("other.n").alias("other_n"), r6(F.col("main.top") - F.col("other.top")).alias("apart"))


@query("select event_id, epoch(strptime(strftime(ts, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S')) + (event_id % 1000) / 1000.0::double as seconds from events")
def survey_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a clock reading and its milliseconds as epoch seconds."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", poses.epoch_seconds(F.date_format("ts", "yyyyMMddHHmmss"), millis=F.col("event_id") % 1000).alias("seconds"))


# Rasters


@query(f"with {SQL_PIXELS} select row, col, cls, sum(weight) as weight from px group by 1, 2, 3")
def blend_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3."""
    return blend.blend(seen_pixels(spark, sf_dir), "sum")


@query(f"""with {SQL_PIXELS}, r as (select *, row_number() over (partition by row, col order by frame) as k from px)
select row, col, cls, sum(weight * case when k = 1 then 1 else 2 end) as weight from r group by 1, 2, 3""")
def blend_enhance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, W1."""
    return blend.blend(seen_pixels(spark, sf_dir), "enhance")


@query(f"""with {SQL_PIXELS}, r as (select *, row_number() over (partition by row, col order by frame) as k, count(*) over (partition by row, col) as n from px)
select row, col, cls, round(sum(pow(0.5, case when k = 1 then n - 1 else n - k + 1 end)), 6) + 0.0 as weight from r group by 1, 2, 3""")
def blend_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, W2."""
    return blend.blend(seen_pixels(spark, sf_dir), "average").withColumn("weight", r6(F.col("weight")))


SQL_SUMS = "sums as (select row, col, cls, sum(weight) as weight from px group by 1, 2, 3)"


@query(f"with {SQL_PIXELS}, {SQL_SUMS}, r as (select *, row_number() over (partition by row, col order by weight desc, cls) as k from sums) select row, col, cls from r where k = 1")
def pixel_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5."""
    return blend.best_class(blend_sum(spark, sf_dir))


@query(f"""with {SQL_PIXELS}, {SQL_SUMS}, r as (select *, row_number() over (partition by row, col order by weight desc, cls) as k from sums)
select row, col, coalesce(max(case when k = 2 and weight > 0 then cls end), 0) as cls from r group by 1, 2""")
def pixel_second_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6."""
    return blend.second_best_class(blend_sum(spark, sf_dir))


@query(f"""with {SQL_PIXELS}, c as (select frame % 4 as chunk, row, col, cls, sum(weight) as weight from px group by 1, 2, 3, 4), m as (select chunk, row + (chunk * 3)::int as row, col + (chunk * 2)::int as col, cls, weight from c),
d as (select *, dense_rank() over (partition by row, col order by chunk) as k from m), n as (select *, max(k) over (partition by row, col) as n from d)
select row, col, cls, round(sum(weight * pow(0.5, case when k = 1 then n - 1 else n - k + 1 end)), 6) + 0.0 as weight from n group by 1, 2, 3""")
def stitch_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four chunks moved to one anchor, half and half where they overlap."""
    chunks = blend.blend(seen_pixels(spark, sf_dir).withColumn("chunk", F.col("frame") % 4), "sum", ["chunk"])
    anchors = spark.range(4).select(F.col("id").alias("chunk"), (F.col("id") * 3).cast("int").alias("d_row"), (F.col("id") * 2).cast("int").alias("d_col"))
    return blend.stitch(chunks, anchors, "average").withColumn("weight", r6(F.col("weight")))


@query("""select l_orderkey, l_linenumber, case when l_linenumber = 3 then case when p_size % 12 in (1, 2, 5) then p_size % 12 else 7 end else l_linenumber end as cls
from lineitem join part on l_partkey = p_partkey""")
def class_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9, G12."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select("l_orderkey", "l_linenumber", F.col("l_linenumber").alias("cls"), (F.col("p_size") % 12).alias("fallback"))
    return blend.remap_fallback(rows, 3, [1, 2, 5], 7).select("l_orderkey", "l_linenumber", "cls")


@query("""with c as (select l_orderkey, (l_suppkey % 6)::int as cls, count(*) as n from lineitem where l_suppkey % 6 <> 0 group by 1, 2), r as (select *, row_number() over (partition by l_orderkey order by n desc, cls) as k from c)
select l_orderkey, cls from r where k = 1""")
def group_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The majority class of each group, background left out."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 6).cast("int").alias("cls"))
    return blend.majority(rows, ["l_orderkey"], without_background=True)


@query(f"""with {SQL_PIXELS}, {SQL_SUMS}, m as (select r.range::int as row, c.range::int as col, ((r.range + c.range) % 3) / 2.0::double as alpha from range(50) r, range(50) c)
select row, col, cls, weight * alpha as weight from sums join m using (row, col) where weight * alpha <> 0""")
def mask_multiply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5, P7."""
    cells = spark.range(2500).select(F.floor(F.col("id") / 50).cast("int").alias("row"), (F.col("id") % 50).cast("int").alias("col"))
    return blend.mask(blend_sum(spark, sf_dir), cells.withColumn("alpha", ((F.col("row") + F.col("col")) % 3) / 2.0)).select("row", "col", "cls", "weight")


@query(f"""with {SQL_PIXELS}, a as (select row, col, cls, sum(weight) as weight from px where frame % 2 = 0 group by 1, 2, 3), b as (select row, col, cls, sum(weight) as weight from px where frame % 2 = 1 group by 1, 2, 3)
select coalesce(a.row, b.row) as row, coalesce(a.col, b.col) as col, coalesce(a.cls, b.cls) as cls, coalesce(nullif(a.weight, 0), b.weight, 0) as weight
from a full join b on a.row = b.row and a.col = b.col and a.cls = b.cls""")
def merge_rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: a second raster, of odd frames, where the first, of even ones, is empty."""
    part = lambda k: blend.blend(seen_pixels(spark, sf_dir).where(F.col("frame") % 2 == k), "sum")
    return blend.fill_empty(part(0), part(1))


@query(f"""with {SQL_PIXELS}, {SQL_SUMS} select row, col, cls, weight from sums where cls <= 3 union all select 99 - row, 49 - col, cls, weight from sums where cls > 3""")
def stack_rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One view above another turned by half a turn."""
    s = blend_sum(spark, sf_dir)
    return blend.stack_halves(s.where("cls <= 3"), s.where("cls > 3"), 50, 50)


@query(f"with {SQL_PIXELS}, {SQL_SUMS} select floor(row * 0.3)::int as row, floor(col * 0.3)::int as col, cls, sum(weight) as weight from sums group by 1, 2, 3")
def coarse_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R11."""
    return blend.coarsen(blend_sum(spark, sf_dir), 0.3)


@query(f"""with {SQL_PIXELS}, {SQL_SUMS}, r as (select *, row_number() over (partition by row, col order by weight desc, cls) as k from sums),
p(cls, r, g, b) as (values (0, 0, 0, 0), (1, 255, 153, 51), (2, 255, 51, 255), (3, 0, 255, 0), (4, 255, 0, 0), (5, 190, 189, 127), (6, 116, 18, 29), (7, 149, 95, 32), (8, 184, 183, 153), (9, 0, 0, 255))
select row, col, cls, coalesce(p.r, 0) as r, coalesce(p.g, 0) as g, coalesce(p.b, 0) as b from r left join p using (cls) where k = 1""")
def colour_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R12."""
    return blend.colours(pixel_argmax(spark, sf_dir)).select("row", "col", "cls", "r", "g", "b")


@query(f"""with {SQL_PIXELS}, {SQL_SUMS}, t as (select r.range::int as row, c.range::int as col, floor(r.range * 0.8 + c.range * -0.6 + (10.0 + 0.5))::int as sr, floor(r.range * 0.6 + c.range * 0.8 + (-4.0 + 0.5))::int as sc from range(40) r, range(60) c)
select t.row, t.col, cls, weight from t join sums on sr = sums.row and sc = sums.col""")
def warp_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turned and moved, nearest pixel."""
    return blend.affine(blend_sum(spark, sf_dir), 40, 60, (0.8, -0.6, 10.0, 0.6, 0.8, -4.0)).select("row", "col", "cls", "weight")


SQL_HOMOGRAPHY = "t as (select r.range::int as row, c.range::int as col, c.range * 0.001 + r.range * 0.002 + 1.0 as d, c.range * 0.9 + r.range * 0.1 + 2.0 as nx, c.range * -0.1 + r.range * 1.1 + 1.0 as ny from range(50) r, range(50) c)"


@query(f"with {SQL_PIXELS}, {SQL_SUMS}, {SQL_HOMOGRAPHY} select t.row, t.col, cls, weight from t join sums on floor(ny / d + 0.5)::int = sums.row and floor(nx / d + 0.5)::int = sums.col")
def bird_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A perspective warp, nearest pixel."""
    return blend.homography(blend_sum(spark, sf_dir), 50, 50, [[0.9, 0.1, 2.0], [-0.1, 1.1, 1.0], [0.001, 0.002, 1.0]]).select("row", "col", "cls", "weight")


@query(f"""with {SQL_PIXELS}, {SQL_SUMS}, b as (select row, col, sum(weight) as weight from sums group by 1, 2)
select o_orderkey, count(*) as pixels, sum(weight) as weight from orders join b on b.row between (o_orderkey % 50) - 2 and (o_orderkey % 50) + 2 and b.col between (o_custkey % 50) - 2 and (o_custkey % 50) + 2 group by 1""")
def region_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies round each position."""
    flat = blend_sum(spark, sf_dir).groupBy("row", "col").agg(F.sum("weight").alias("weight"))
    at = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 50).cast("int").alias("row"), (F.col("o_custkey") % 50).cast("int").alias("col"))
    return blend.window_around(at, flat, 2).groupBy("o_orderkey").agg(F.count("*").alias("pixels"), F.sum("weight").alias("weight"))


SQL_TURNS = "h as (select frame, 0.9013579::double + frame % 3 * 0.0512347::double as a, 0.1024681::double - frame % 5 * 0.0213579::double as b, 0.0123457::double + frame % 7 * 0.4987651::double as c, 0.0031415::double + frame % 4 * 0.0214763::double as d, 0.9987653::double - frame % 3 * 0.0397531::double as e, 0.0271829::double + frame % 2 * 0.2513579::double as f, 0.0002357::double + frame % 6 * 0.0011131::double as g from (select distinct frame from px))"


@query(f"""with {SQL_PIXELS}, q as (select frame, row, col, cls, sum(weight) as weight from px group by 1, 2, 3, 4), {SQL_TURNS},
t as (select frame, r as row, c2 as col, (a * c2 + b * r + c) / (g * c2 + 1) as u, (d * c2 + e * r + f) / (g * c2 + 1) as v from h, range(50) as x(r), range(50) as y(c2)),
n as (select frame, row, col, floor(v)::int + i as sr, floor(u)::int + j as sc, (case i when 1 then v - floor(v) else 1 - v + floor(v) end) * (case j when 1 then u - floor(u) else 1 - u + floor(u) end) as w from t, (values (0, 0), (0, 1), (1, 0), (1, 1)) as k(i, j)),
o as (select n.frame, n.row, n.col, cls, sum(weight * w) as weight from n join q on q.frame = n.frame and q.row = sr and q.col = sc where w > 0 group by 1, 2, 3, 4)
select frame, cls, count(*) as pixels, round(sum(weight), 4) + 0.0 as weight, round(sum(weight * (row + 2 * col)), 2) + 0.0 as moment from o group by 1, 2""")
def frame_warps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frame's pixels through a homography of its own, interpolated."""
    px = seen_pixels(spark, sf_dir).groupBy("frame", "row", "col", "cls").agg(F.sum("weight").alias("weight"))
    k = F.col("frame")
    h = F.array(0.9013579 + k % 3 * 0.0512347, 0.1024681 - k % 5 * 0.0213579, 0.0123457 + k % 7 * 0.4987651, 0.0031415 + k % 4 * 0.0214763, 0.9987653 - k % 3 * 0.0397531, 0.0271829 + k % 2 * 0.2513579, 0.0002357 + k % 6 * 0.0011131, F.lit(0.0), F.lit(1.0))
    out = blend.warp(px, px.select("frame").distinct().withColumn("h", h), (50, 50), parts=parts(table(spark, sf_dir, "lineitem")))
    return out.groupBy("frame", "cls").agg(F.count("*").alias("pixels"), (F.round(F.sum("weight"), 4) + 0.0).alias("weight"), (F.round(F.sum(F.col("weight") * (F.col("row") + 2 * F.col("col"))), 2) + 0.0).alias("moment"))


@query(f"""with {SQL_PIXELS}, {SQL_SUMS}, s(slice, a, b) as (values (0, 0, 20), (1, 14, 34), (2, 28, 50))
select slice, count(*) as pixels, sum(weight) as weight from sums join s on row >= a and row < b group by 1""")
def window_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three windows of 20 rows, 6 of them shared, the last one to row 49."""
    return blend.in_slices(blend_sum(spark, sf_dir), 50, 20, 6).groupBy("slice").agg(F.count("*").alias("pixels"), F.sum("weight").alias("weight"))


SQL_RECTANGLES = "re as (select p_partkey as box, (p_partkey * 7919 % 4800 / 100.0)::double as cx, (p_partkey * 104729 % 4700 / 100.0)::double as cy, (1 + p_size % 9)::double as width, (1 + p_partkey % 13)::double as height, radians(p_partkey * 31 % 180) as turn from part)"


def part_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as rotated rectangles on a raster of 50 rows and columns; the angle in degrees."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(k.alias("box"), (k * 7919 % 4800 / 100).alias("cx"), (k * 104729 % 4700 / 100).alias("cy"), (1 + F.col("p_size") % 9).cast("double").alias("width"), (1 + k % 13).cast("double").alias("height"), (k * 31 % 180).cast("double").alias("angle"))


@query(f"""with {SQL_PIXELS}, {SQL_SUMS}, {SQL_RECTANGLES}, k as (select row, col, cls, row_number() over (partition by row, col order by weight desc, cls) as k from sums), l as (select row, col, cls from k where k = 1 and cls <> 0),
h as (select box, cls, count(*) as n from re join l on abs((col - cx) * cos(turn) + (row - cy) * sin(turn)) <= width / 2 + 1e-6 and abs((row - cy) * cos(turn) - (col - cx) * sin(turn)) <= height / 2 + 1e-6 group by 1, 2)
select box, arg_max(cls, n * 1000 - cls) as cls, sum(n)::bigint as pixels from h group by 1""")
def rectangle_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class that most pixels under each rotated rectangle have, background left out."""
    # the rows that rectangles become say nothing about their number, so the raster is named as the side to hold
    raster = pixel_argmax(spark, sf_dir).where("cls <> 0").hint("shuffle_hash")
    under = blend.under_rectangles(part_rectangles(spark, sf_dir)).join(raster, ["row", "col"])
    return blend.majority(under, ["box"], total="pixels").select("box", "cls", "pixels")


@query(f"""with {SQL_PIXELS}, {SQL_SUMS}, w as (select row, col, cls, case when cls = 7 then weight * 0.2::double when cls = 1 then 0.1::double else weight end as weight from sums), r as (select *, row_number() over (partition by row, col order by weight desc, cls) as k from w)
select row, col, case when cls in (2, 5) then 0 else cls end as cls from r where k = 1""")
def region_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Background and drivable weights set, best class, ignored classes out."""
    s = blend_sum(spark, sf_dir).withColumn("cls", F.col("cls") - 1)
    picked = blend.best_class(blend.weigh_background(s, 0.1, 6, 0.2)).withColumn("cls", F.col("cls") + 1)
    return blend.ignore_classes(picked, [2, 5])


@query("select l_orderkey, l_linenumber, case when l_linenumber % 3 = 0 then case when l_suppkey % 2 <> 0 then 11 else 0 end else l_linenumber % 3 end as cls from lineitem")
def merge_line_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two heads of a model in one label."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", blend.merge_heads(F.col("l_linenumber") % 3, F.col("l_suppkey") % 2, 11).alias("cls"))


@query(f"""with recursive {SQL_PIXELS}, {SQL_SUMS}, k as (select row, col, cls, row_number() over (partition by row, col order by weight desc, cls) as k from sums), p as (select row, col, case when cls >= 2 then cls else 0 end as cls from k where k = 1),
f as (select row * 50 + col as id, row, col from p where cls <> 0), e as (select a.id as a, b.id as b from f a join f b on a.id <> b.id and abs(a.row - b.row) <= 1 and abs(a.col - b.col) <= 1),
w(id, root) as (select id, id from f union select e.b, w.root from w join e on e.a = w.id where w.root < e.b), r as (select id, min(root) as blob from w group by 1), n as (select blob, count(*) as n from r group by 1)
select row, col, case when cls <> 0 and n <= 3 then 0 else cls end as cls from p left join r on r.id = row * 50 + col left join n using (blob)""")
def junk_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small foreground blobs become background."""
    labels = pixel_argmax(spark, sf_dir).withColumn("cls", F.when(F.col("cls") >= 2, F.col("cls")).otherwise(0))
    return graphs.clean_junk(labels, 3)


@query(f"""with {SQL_PIXELS}, {SQL_SUMS}, k as (select row, col, cls, row_number() over (partition by row, col order by weight desc, cls) as k from sums), p as (select row, col, cls from k where k = 1 and cls < 6)
select p.row, p.col, p.cls from p join p q on abs(p.row - q.row) <= 1 and abs(p.col - q.col) <= 1 group by 1, 2, 3 having count(*) = 9""")
def eroded_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreground pixels whose neighbours are all foreground."""
    return graphs.erode(pixel_argmax(spark, sf_dir).where("cls < 6"))


# Spatial joins


@query(f"with {SQL_POINTS} select a.vec_id as a, b.vec_id as b, round(sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)), 6) + 0.0 as d from pts a join pts b on a.vec_id < b.vec_id and sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) <= 0.05")
def radius_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7."""
    p = points(spark, sf_dir)
    return grid.pairs_within(p, p, 0.05).where("l.vec_id < r.vec_id").select(F.col("l.vec_id").alias("a"), F.col("r.vec_id").alias("b"), r6(F.col("d")).alias("d"))


@query(f"""with {SQL_POINTS}, q as (select a.vec_id as a, b.vec_id as b, sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) as d from pts a join pts b on a.vec_id <> b.vec_id), r as (select *, row_number() over (partition by a order by d, b) as rank from q where d <= 0.05)
select a, b, rank::int as rank from r where rank <= 3""")
def knn3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6."""
    p = points(spark, sf_dir)
    return grid.nearest_k(p, p, 0.05, 3, "vec_id", "vec_id").select(F.col("l.vec_id").alias("a"), F.col("r.vec_id").alias("b"), "rank")


@query(f"with {SQL_POINTS}, q as (select a.vec_id as a, b.vec_id as b, sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) as d from pts a, pts b) select a, count(*) as n from q where d between 0.02 and 0.06 group by 1")
def annulus_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10."""
    p = points(spark, sf_dir)
    return grid.annulus(p, p, 0.02, 0.06).groupBy(F.col("l.vec_id").alias("a")).agg(F.count("*").alias("n"))


@query(f"""with {SQL_POINTS}, q as (select a.vec_id as a, b.vec_id as b, sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) as d from pts a join pts b on a.label = b.label and a.vec_id <> b.vec_id), r as (select *, row_number() over (partition by a order by d, b) as k from q)
select a as vec_id, b as nearest, round(d, 6) + 0.0 as d from r where k = 1""")
def nearest_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J12."""
    p = points(spark, sf_dir)
    return grid.nearest_in_group(p, p, ["label"], "vec_id", "vec_id").withColumn("d", r6(F.col("d")))


@query(f"""with {SQL_POINTS}, l as (select *, dx / sqrt(dx*dx+dy*dy) as ux, dy / sqrt(dx*dx+dy*dy) as uy from pts),
s as (select a.vec_id as a, b.vec_id as b, b.x as px, b.y as py, a.x - a.uy * 0.08 as ax, a.y + a.ux * 0.08 as ay, a.x + a.uy * 0.08 as bx, a.y - a.ux * 0.08 as y1, sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) as d from l a, l b),
t as (select *, greatest(0.0, least(1.0, coalesce(((px-ax)*(bx-ax)+(py-ay)*(y1-ay)) / nullif((bx-ax)*(bx-ax)+(y1-ay)*(y1-ay), 0), 0))) as k from s where d between 0.02 and 0.08)
select a, b from t where sqrt(pow(ax + k*(bx-ax) - px, 2) + pow(ay + k*(y1-ay) - py, 2)) <= 0.01""")
def scanline_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11, F10, F11."""
    p = points(spark, sf_dir)
    return grid.scan_line(p, p, 0.02, 0.08, 0.01).select(F.col("l.vec_id").alias("a"), F.col("r.vec_id").alias("b"))


@query(f"""with {SQL_POINTS}, q as (select n.vec_id as node, c.vec_id as car, cos(-atan2(c.dy, c.dx)) * (n.x - c.x) - sin(-atan2(c.dy, c.dx)) * (n.y - c.y) as u, sin(-atan2(c.dy, c.dx)) * (n.x - c.x) + cos(-atan2(c.dy, c.dx)) * (n.y - c.y) as v from pts n, pts c),
h as (select *, row_number() over (partition by node order by car desc) as k from q where (abs(u) < 0.06 and v > -0.03 and v < 0) or (abs(u) < 0.05 and v > 0 and v < 0.02))
select node, car, case when v > 0 then 'left' else 'right' end as side from h where k = 1""")
def side_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side of the last car whose box holds a node."""
    p = points(spark, sf_dir)
    return lanes.annotate_side(p, p.withColumn("heading", g.angle(F.col("dx"), F.col("dy"))), (0.03, 0.12), (0.02, 0.1), 0.08, "vec_id", "vec_id")


@query(f"""with {SQL_POINTS}, q as (select n.vec_id as node, c.vec_id as car, c.z, n.x + 0.004 - c.x as ox, n.y - 0.003 - c.y as oy, atan2(c.dy, c.dx) as h from pts n, pts c),
r as (select *, sqrt(ox * ox + oy * oy) as d, cos(-h) * ox - sin(-h) * oy as u, sin(-h) * ox + cos(-h) * oy as v from q),
m as (select node, sum(z / d) / sum(1 / d) as z from r where d <= 0.1 and (car < 2 or (abs(u) < 0.05 and abs(v) < 0.03)) group by 1)
select vec_id, round(m.z, 6) + 0.0 as ele from pts left join m on node = vec_id""")
def elevation_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevation of nodes from the frames whose box holds them, from frames 0 and 1 by distance alone."""
    p = points(spark, sf_dir)
    nodes = p.withColumns({"x": F.col("x") + 0.004, "y": F.col("y") - 0.003})
    cars = p.withColumns({"heading": g.angle(F.col("dx"), F.col("dy")), "frame": F.col("vec_id")})
    return lanes.annotate_elevation(nodes, cars, (0.06, 0.1), "vec_id", 1.0, "frame").select("vec_id", r6(F.col("ele")).alias("ele"))


@query(f"""with {SQL_POINTS}, q as (select n.vec_id as node, c.z, sqrt((n.x-c.x)*(n.x-c.x)+(n.y-c.y)*(n.y-c.y)) as d, cos(-atan2(c.dy, c.dx)) * (n.x - c.x) - sin(-atan2(c.dy, c.dx)) * (n.y - c.y) as u, sin(-atan2(c.dy, c.dx)) * (n.x - c.x) + cos(-atan2(c.dy, c.dx)) * (n.y - c.y) as v from pts n, pts c)
select node, round(sum(z / d) / sum(1 / d), 6) + 0.0 as value from q where d > 0 and abs(u) < 0.05 and abs(v) < 0.05 group by 1""")
def idw_elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevation of nodes from the cars around them."""
    p = points(spark, sf_dir)
    hit = grid.in_oriented_box(p, p.withColumn("heading", g.angle(F.col("dx"), F.col("dy"))), 0.05, 0.05)
    out = grid.inverse_distance_mean(hit.where("d > 0"), F.col("l.vec_id"), F.col("r.z"))
    return out.withColumn("value", r6(F.col("value")))


SQL_BOXES = "bx as (select p_partkey as id, (p_partkey * 7 % 997)::double as min_x, (p_partkey * 13 % 991)::double as min_y, (p_partkey * 7 % 997)::double + 2 + p_size as max_x, (p_partkey * 13 % 991)::double + 3 + p_partkey % 11 as max_y from part)"


def part_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = (F.col("p_partkey") * 7 % 997).cast("double"), (F.col("p_partkey") * 13 % 991).cast("double")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), x.alias("min_x"), y.alias("min_y"), (x + 2 + F.col("p_size")).alias("max_x"), (y + 3 + F.col("p_partkey") % 11).alias("max_y"))


@query(f"""with {SQL_BOXES}, a as (select *, (max_x-min_x)*(max_y-min_y) as area from bx)
select id from a where not exists (select 1 from a b where a.area > b.area and
greatest(0, least(a.max_x, b.max_x) - greatest(a.min_x, b.min_x)) * greatest(0, least(a.max_y, b.max_y) - greatest(a.min_y, b.min_y)) > 0.3 * b.area)""")
def box_overlap_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J17, L7."""
    return grid.prune_overlaps(part_boxes(spark, sf_dir), 40.0).select("id")


@query(f"""with {SQL_BOXES} select a.id as a, b.id as b from bx a join bx b on a.id < b.id and a.min_x < b.max_x and b.min_x < a.max_x and a.min_y < b.max_y and b.min_y < a.max_y
where not (a.min_x >= b.min_x and a.min_y >= b.min_y and a.max_x <= b.max_x and a.max_y <= b.max_y) and not (b.min_x >= a.min_x and b.min_y >= a.min_y and b.max_x <= a.max_x and b.max_y <= a.max_y)""")
def box_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes that overlap in part; one inside the other does not count."""
    sides = lambda s: tuple(F.col(s)[k] for k in ("min_x", "min_y", "max_x", "max_y"))
    b = part_boxes(spark, sf_dir)
    # the boxes lie in a field of fixed size, so pairs grow with the square of the table
    return grid.box_pairs(b, b, 40.0, parts(b, 10_000)).where("l.id < r.id").where(g.boxes_overlap(sides("l"), sides("r"))).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))


def turned_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as rotated boxes, spread in proportion to their number."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(k.alias("id"), (k * 3).cast("double").alias("cx"), (k * 91 % 60).cast("double").alias("cy"), (2 + F.col("p_size")).cast("double").alias("width"), (3 + k % 17).cast("double").alias("height"), F.radians((k * 31 % 180).cast("double")).alias("angle"))


@query("""with co as (select p_partkey as id, (p_partkey * 3)::double as cx, (p_partkey * 91 % 60)::double as cy, (2 + p_size) / 2.0::double as w, (3 + p_partkey % 17) / 2.0::double as h, cos(radians(p_partkey * 31 % 180)) as c, sin(radians(p_partkey * 31 % 180)) as s from part),
k as (select id, cx, cy, w, h, c, s, cx + x * w * c - y * h * s as px, cy + x * w * s + y * h * c as py from co, (values (1, 1), (1, -1), (-1, 1), (-1, -1)) as v(x, y)),
p as (select a.id as a, b.id as b, a.cx as acx, a.cy as acy, a.c as ac, a.s as as_, a.w as aw, a.h as ah, b.cx as bcx, b.cy as bcy, b.c as bc, b.s as bs, b.w as bw, b.h as bh from co a join co b on a.id < b.id and abs(a.cx - b.cx) < 70 and abs(a.cy - b.cy) < 70),
q as (select p.a, p.b, max(case when k.id = p.a then (px - bcx) * bc + (py - bcy) * bs end) as a1, min(case when k.id = p.a then (px - bcx) * bc + (py - bcy) * bs end) as a0, max(case when k.id = p.a then (py - bcy) * bc - (px - bcx) * bs end) as a3, min(case when k.id = p.a then (py - bcy) * bc - (px - bcx) * bs end) as a2,
max(case when k.id = p.b then (px - acx) * ac + (py - acy) * as_ end) as b1, min(case when k.id = p.b then (px - acx) * ac + (py - acy) * as_ end) as b0, max(case when k.id = p.b then (py - acy) * ac - (px - acx) * as_ end) as b3, min(case when k.id = p.b then (py - acy) * ac - (px - acx) * as_ end) as b2,
any_value(aw) as aw, any_value(ah) as ah, any_value(bw) as bw, any_value(bh) as bh from p join k on k.id in (p.a, p.b) group by 1, 2)
select a, b from q where a0 < bw - 1e-9 and a1 > -bw + 1e-9 and a2 < bh - 1e-9 and a3 > -bh + 1e-9 and b0 < aw - 1e-9 and b1 > -aw + 1e-9 and b2 < ah - 1e-9 and b3 > -ah + 1e-9
and not (a0 >= -bw - 1e-9 and a1 <= bw + 1e-9 and a2 >= -bh - 1e-9 and a3 <= bh + 1e-9) and not (b0 >= -aw - 1e-9 and b1 <= aw + 1e-9 and b2 >= -ah - 1e-9 and b3 <= ah + 1e-9)""")
def rotated_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rotated boxes that overlap in part, by separating axes."""
    b = turned_boxes(spark, sf_dir)
    return grid.rotated_pairs(b, b, 64.0).where("l.id < r.id").select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))


@query("""with b as (select p_partkey as id, (p_partkey * 3)::double as cx, (p_partkey * 91 % 60)::double as cy, (2 + p_size) / 2.0::double as w, (3 + p_partkey % 17) / 2.0::double as h, cos(radians(p_partkey * 31 % 180)) as c, sin(radians(p_partkey * 31 % 180)) as s from part),
h as (select p.id, b.id as box, row_number() over (partition by p.id order by b.id) as k from b p join b on p.id <> b.id and abs(p.cx - b.cx) < 40 and abs(p.cy - b.cy) < 40 and abs((p.cx - b.cx) * b.c + (p.cy - b.cy) * b.s) < b.w - 1e-9 and abs((p.cy - b.cy) * b.c - (p.cx - b.cx) * b.s) < b.h - 1e-9)
select id, box from h where k = 1""")
def centre_in_rotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rotated box that holds another's centre, its edge not counted."""
    b = turned_boxes(spark, sf_dir)
    hit = grid.points_in_rotated(b.select("id", F.col("cx").alias("x"), F.col("cy").alias("y")), b, 64.0).where("p.id <> b.id")
    return hit.groupBy(F.col("p.id").alias("id")).agg(F.min("b.id").alias("box"))


@query(f"""with {SQL_BOXES}, c as (select id, (min_x+max_x)/2 as x, (min_y+max_y)/2 as y from bx), h as (select c.id, b.id as box, row_number() over (partition by c.id order by b.id) as k from c join bx b on c.id <> b.id and c.x > b.min_x and c.x < b.max_x and c.y > b.min_y and c.y < b.max_y)
select id, box from h where k = 1""")
def centre_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first box that holds another's centre, its edge not counted."""
    b = part_boxes(spark, sf_dir)
    centres = b.select("id", ((F.col("min_x") + F.col("max_x")) / 2).alias("x"), ((F.col("min_y") + F.col("max_y")) / 2).alias("y"))
    return grid.first_box(centres, b, 40.0).select("id", "box")


# Graphs


def supply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders (even) and suppliers (odd) as nodes of one graph."""
    return table(spark, sf_dir, "lineitem").select(F.lit(0).alias("graph"), (F.col("l_orderkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst"))


SQL_EDGES = "ed as (select distinct l_orderkey * 2 as src, l_suppkey * 2 + 1 as dst from lineitem), bo as (select src, dst from ed union all select dst, src from ed), dg as (select src as node, count(*) as degree from bo group by 1)"


@query(f"with {SQL_EDGES} select node, degree from dg where degree > 2")
def degree_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forks."""
    return graphs.degrees(supply_edges(spark, sf_dir), parts(table(spark, sf_dir, "lineitem"))).where("degree > 2").select("node", "degree")


@query("with n as (select l_orderkey as graph, count(*) as n from lineitem group by 1) select l_orderkey as graph, l_linenumber as node from lineitem join n on graph = l_orderkey where n >= 4")
def short_graph_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10, G10."""
    nodes = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("graph"), F.col("l_linenumber").alias("node"))
    return graphs.drop_small_graphs(nodes, 4)


@query(f"""with {SQL_EDGES}, s as (select b.src, b.dst, f.degree, row_number() over (partition by b.src order by b.dst) as k from bo b join dg f on f.node = b.src and f.degree > 2 join dg l on l.node = b.dst and l.degree = 1),
cut as (select dst from s where k <= degree - 2)
select src, dst from bo where src < dst and src not in (select dst from cut) and dst not in (select dst from cut)""")
def dead_end_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7."""
    return graphs.remove_dead_ends(supply_edges(spark, sf_dir)).select("src", "dst")


SQL_NEAR = f"ne as (select a.vec_id as a, b.vec_id as b from pts a join pts b on a.vec_id <> b.vec_id and sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) <= {R_GRAPH})"


@query(f"with recursive {SQL_POINTS}, {SQL_NEAR}, w(node, root) as (select vec_id, vec_id from pts union select ne.b, w.root from w join ne on ne.a = w.node where w.root < ne.b) select node, min(root) as component from w group by 1")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G13, CC: points linked when near; a point alone is its own component."""
    p = points(spark, sf_dir).select(F.col("vec_id").alias("node"), "x", "y")
    return p.join(near_components(p, R_GRAPH), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


SQL_ROADS = """ev as (select user_id, event_id, value as x, (epoch_us(ts) // 1000000 % 3600)::double as y, row_number() over w as k, lead(event_id) over w as nxt from events window w as (partition by user_id order by event_id)),
ed as (select event_id as a, nxt as b from ev where nxt is not null union select f.event_id, t.event_id from ev f join ev t on f.k = 1 and t.user_id = f.user_id // 2 and t.user_id <> f.user_id and t.k = 1 + f.user_id % 3),
ar as (select a, b from ed union select b, a from ed), de as (select a as node, count(*) as degree from ar group by 1)"""


def road_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a road network of one graph: a user's events are a line, which begins at one of the user of half the number."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", F.row_number().over(w).alias("k"), F.lead("event_id").over(w).alias("nxt"))
    along = ev.where("nxt is not null").select(F.col("event_id").alias("src"), F.col("nxt").alias("dst"))
    half = ev.where("k = 1").select(F.col("event_id").alias("src"), F.floor(F.col("user_id") / 2).cast("long").alias("__u"), (1 + F.col("user_id") % 3).alias("__k"), "user_id")
    to = ev.select(F.col("user_id").alias("__u"), F.col("k").alias("__k"), F.col("event_id").alias("dst"))
    roads = along.unionByName(half.join(to, ["__u", "__k"]).where("user_id <> __u").select("src", "dst"))
    return roads.select(F.lit(0).cast("long").alias("graph"), F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))


SQL_WALK = "wa(first, second, prev, here, k) as (select ar.a, ar.b, ar.a, ar.b, 1 from ar join de on de.node = ar.a and degree <> 2 union all select first, second, here, ar.b, wa.k + 1 from wa join de on de.node = here and degree = 2 join ar on ar.a = here and ar.b <> prev)"


@query(f"""with recursive {SQL_ROADS}, {SQL_WALK}, z as (select first, second, here as last, prev as before from wa join de on node = here and degree <> 2 where row(first, second) < row(here, prev)),
o as (select wa.first, wa.second, wa.k, wa.here as node from wa join z on z.first = wa.first and z.second = wa.second)
select first, second, k::bigint as k, node from o union all select first, second, 0, first from z""")
def line_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the network's lines in order, by pointer doubling; a ring would be missing in the SQL, and the network has none."""
    return lineorder.line_order(road_edges(spark, sf_dir)).select("first", "second", "k", "node")


@query(f"""with recursive {SQL_ROADS}, {SQL_WALK}, e as (select wa.first as fork, wa.second as "to", greatest(1, wa.k - case when d.degree > 2 then 1 else 0 end)::bigint as nodes from wa join de d on d.node = here and d.degree <> 2 join de f on f.node = wa.first and f.degree > 2),
k as (select *, row_number() over (partition by fork order by nodes desc, "to") as k from e)
select distinct least(fork, "to") as src, greatest(fork, "to") as dst from k where k > 2 and nodes <= 12""")
def fork_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges that fork removal cuts, of branches of at most twelve nodes."""
    return lineorder.fork_cuts(road_edges(spark, sf_dir), 12).select("src", "dst")


@query(f"""with recursive {SQL_ROADS}, pa as (select event_id as a, lead(event_id, 5) over (partition by user_id order by event_id) as b from ev union select e.event_id, o.event_id from ev e join ev o on o.user_id = e.user_id // 2 and o.k = e.k),
r(a, node, d) as (select distinct a, a, 0 from pa where b is not null union select r.a, ar.b, d + 1 from r join ar on ar.a = node where d < 12)
select pa.a, pa.b, min(d)::bigint as hop from pa join r on r.a = pa.a and r.node = pa.b group by 1, 2""")
def pair_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps between given pairs of the network's nodes, of those at most twelve apart."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    ev = table(spark, sf_dir, "events").select("user_id", F.col("event_id").cast("long").alias("a"), F.row_number().over(w).alias("k"), F.lead(F.col("event_id").cast("long"), 5).over(w).alias("b"))
    half = ev.select(F.floor(F.col("user_id") / 2).cast("long").alias("__u"), "k", "a").join(ev.select(F.col("user_id").alias("__u"), "k", F.col("a").alias("b")), ["__u", "k"])
    return graphs.pair_hops(road_edges(spark, sf_dir), ev.select("a", "b").unionByName(half.select("a", "b")), 12).select("a", "b", F.col("hop").cast("long").alias("hop"))


@query(f"""with recursive {SQL_ROADS}, sh as (select event_id as a, event_id // 2 as b from events where event_id > 0), al as (select a, b from ar union select a, b from sh union select b, a from sh), w(node, hop) as (select min(event_id), 0 from events union select al.b, w.hop + 1 from w join al on al.a = w.node where w.hop < 40)
select node, min(hop) as hop from w group by 1""")
def hop_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fewest steps from the first event in a network with short cuts; the SQL ends at 40, more than its depth."""
    k = F.col("event_id").cast("long")
    short = table(spark, sf_dir, "events").where("event_id > 0").select(k.alias("src"), F.floor(k / 2).cast("long").alias("dst"))
    return graphs.hops(road_edges(spark, sf_dir).select("src", "dst").unionByName(short), table(spark, sf_dir, "events").agg(F.min(k).alias("node")))


@query("with r as (select *, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber)::int as rank from lineitem) select l_orderkey, l_linenumber, rank from r where rank <= 2")
def keep_two_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4, O5."""
    return graphs.keep_longest(table(spark, sf_dir, "lineitem"), ["l_orderkey"], F.col("l_extendedprice"), ["l_linenumber"]).select("l_orderkey", "l_linenumber", "rank")


@query("""with w as (select *, lag(role) over (partition by conv_id order by turn) as before, row_number() over (partition by conv_id order by turn) as k from conversations)
select conv_id, turn, sum(case when k > 1 and before is distinct from role then 1 else 0 end) over (partition by conv_id order by turn rows unbounded preceding)::bigint as segment from w""")
def segment_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new segment at each change of class."""
    return graphs.segments(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], "role").select("conv_id", "turn", "segment")


@query(f"""with {SQL_POINTS}, u as (select label, vec_id, dx / sqrt(dx*dx+dy*dy) as dx, dy / sqrt(dx*dx+dy*dy) as dy from pts),
c as (select a.label, a.vec_id, count(b.vec_id) as n from u a left join u b on a.label = b.label and a.vec_id <> b.vec_id and abs(a.dx*b.dx+a.dy*b.dy) > 0.95 group by 1, 2),
t as (select label, max(n) as votes from c group by 1)
select label, votes, case when count(*) = 1 then min(vec_id) end as winner from c join t using (label) where n = votes group by 1, 2""")
def direction_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The direction that most others share."""
    p = points(spark, sf_dir)
    ux, uy = g.unit(F.col("dx"), F.col("dy"))
    return graphs.consensus(p.select("label", "vec_id", ux.alias("dx"), uy.alias("dy")), ["label"], "vec_id").select("label", "votes", "winner")


@query(f"""with {SQL_POINTS}, c as (select label, avg(x) as cx, avg(y) as cy from pts group by 1), a as (select label, degrees(atan2(y - cy, x - cx)) as a from pts join c using (label)),
w as (select label, a, coalesce(lead(a) over (partition by label order by a) - a, min(a) over (partition by label) + 360 - a) as gap from a)
select label, round(360 - max(gap), 6) + 0.0 as sector from w group by 1""")
def sector_angle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9, A15."""
    p = points(spark, sf_dir)
    c = p.groupBy("label").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    return graphs.sector_degrees(p.join(c, "label"), ["label"]).withColumn("sector", r6(F.col("sector")))


@query("""with e as (select vec_id, embedding[1]::double as ax, embedding[2]::double as ay, embedding[3]::double as bx, embedding[4]::double as y1, embedding[5]::double as cx, embedding[6]::double as cy from embeddings),
d as (select *, nullif(2*(ax*(y1-cy)+bx*(cy-ay)+cx*(ay-y1)), 0) as d, ax*ax+ay*ay as a2, bx*bx+y1*y1 as b2, cx*cx+cy*cy as c2 from e), c as (select *, (a2*(y1-cy)+b2*(cy-ay)+c2*(ay-y1))/d as x, (a2*(cx-bx)+b2*(ax-cx)+c2*(bx-ax))/d as y from d)
select vec_id, round(x, 4) + 0.0 as x, round(y, 4) + 0.0 as y, round(sqrt((x-ax)*(x-ax)+(y-ay)*(y-ay)), 4) + 0.0 as radius from c""")
def circle3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12."""
    e = [F.col("embedding")[k].cast("double") for k in range(6)]
    x, y, r = g.circle_through(*e)
    four = lambda c: F.round(c, 4) + 0.0
    return table(spark, sf_dir, "embeddings").select("vec_id", four(x).alias("x"), four(y).alias("y"), four(r).alias("radius"))


# Lanes and the map


def supply_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as linestrings between the graphs of their first and last supplier."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("ls")).agg(F.min("l_suppkey").alias("start_graph"), F.max("l_suppkey").alias("end_graph"), F.avg("l_quantity").alias("cx"), F.avg("l_discount").alias("cy"))


@query("""with l as (select l_orderkey as ls, min(l_suppkey) as s, max(l_suppkey) as e, avg(l_quantity) as cx, avg(l_discount) as cy from lineitem group by 1)
select a.ls as right_ls, b.ls as left_ls from l a join l b on a.ls < b.ls and least(a.s, a.e) = least(b.s, b.e) and greatest(a.s, a.e) = greatest(b.s, b.e)
where sqrt((a.cx-b.cx)*(a.cx-b.cx)+(a.cy-b.cy)*(a.cy-b.cy)) >= 2""")
def pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linestrings between the same two ends make a lane unless they are too near."""
    return lanes.pair(supply_lines(spark, sf_dir), 2.0)


@query("""with k as (select distinct l_suppkey as graph, l_partkey as node from lineitem)
select graph, node, row_number() over (partition by graph order by node)::int as point from k""")
def shared_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point for a node that several linestrings share."""
    return lanes.shared_points(table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("graph"), F.col("l_partkey").alias("node")))


@query("""with ok as (select o_orderkey as ls from orders where o_orderstatus = 'F')
select l_orderkey as right_ls, l_partkey as left_ls from lineitem where l_orderkey in (select ls from ok) and l_partkey in (select ls from ok)""")
def surviving_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lanes both of whose sides were converted."""
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("right_ls"), F.col("l_partkey").alias("left_ls"))
    return lanes.both_sides(pairs, table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("ls")))


@query("""select l_orderkey, l_linenumber,
  case l_partkey % 15 when 1 then 'line_thin' when 2 then 'line_thin' when 3 then 'line_thin' when 4 then 'line_thin' when 9 then 'pedestrian_marking' when 13 then 'traffic_sign' when 14 then 'stop_line' end as type,
  case l_partkey % 15 when 1 then 'solid_solid' when 2 then 'solid_dashed' when 3 then 'solid' when 4 then 'dashed' when 9 then '' when 13 then 'de205' when 14 then '' end as subtype from lineitem""")
def line_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type and subtype of a class."""
    return lanes.typed(table(spark, sf_dir, "lineitem").withColumn("cls", (F.col("l_partkey") % 15).cast("int"))).select("l_orderkey", "l_linenumber", "type", "subtype")


@query(f"""with {SQL_POINTS} select vec_id, round(x, 6) + 0.0 as x, round(y, 6) + 0.0 as y, round(case when label % 3 = 0 then 0.0 else z end + 1.5, 6) + 0.0 as ele from pts""")
def elevated_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevation with a default, and the car's height."""
    p = points(spark, sf_dir).withColumn("ele", F.when(F.col("label") % 3 != 0, F.col("z")))
    return lanes.elevated(p, 0.0, 1.5).select("vec_id", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"), r6(F.col("ele")).alias("ele"))


@query("select event_id, (props::json->>'k')::bigint as k, to_json({'type': event_type, 'k': (props::json->>'k')::bigint})::varchar as attributes from events")
def metadata_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes read from JSON and written again."""
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), F.to_json(F.struct(F.col("event_type").alias("type"), k.alias("k"))).alias("attributes"))


# Names


@query(r"""select page_id, list_aggregate(list_transform(regexp_extract_all(lower(url), '(\d+|\D+)'), lambda p: case when regexp_matches(p, '^\d+$') then lpad(p, 20, '0') else p end), 'string_agg', '') as key from pages""")
def natural_sort_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1."""
    return table(spark, sf_dir, "pages").select("page_id", g.natural_key(F.col("url")).alias("key"))


@query(r"""select page_id, try_cast(nullif(regexp_extract(regexp_extract(url, '([^/]*?)(\.[^./]*)?$', 1), '(\d+)', 1), '') as bigint) as sequence, ends_with(lower(url), '.html') as is_page from pages""")
def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in a name, and its extension."""
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", g.image_sequence(u, r"(\d+)").alias("sequence"), g.has_extension(u, "html").alias("is_page"))


# Geodesy

LAT, LON, H = "((c_custkey * 37 % 16000) / 100.0::double - 80)", "((c_custkey * 91 % 36000) / 100.0::double - 180)", "(c_custkey % 500)::double"


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", (k * 37 % 16000 / 100.0 - 80).alias("lat"), (k * 91 % 36000 / 100.0 - 180).alias("lon"), (k % 500).cast("double").alias("h"))


SQL_PLACES = f"""pl as (select c_custkey, radians({LAT}) as la, radians({LON}) as lo, {H} as h from customer),
ec as (select c_custkey, la, lo, ({geo.A} / sqrt(1 - {geo.E2!r} * sin(la) * sin(la))) as n, h from pl),
ee as (select c_custkey, la, lo, (h + n) * cos(la) * cos(lo) as x, (h + n) * cos(la) * sin(lo) as y, (h + (1 - {geo.E2!r}) * n) * sin(la) as z from ec)"""


@query(f"""with {SQL_PLACES}, r as (select radians(45.5::double) as la0, radians(9.2::double) as lo0, {geo.A} / sqrt(1 - {geo.E2!r} * sin(radians(45.5::double)) * sin(radians(45.5::double))) as n0),
d as (select c_custkey, la0, lo0, x - (120 + n0) * cos(la0) * cos(lo0) as dx, y - (120 + n0) * cos(la0) * sin(lo0) as dy, z - (120 + (1 - {geo.E2!r}) * n0) * sin(la0) as dz from ee, r)
select c_custkey, round(-sin(lo0) * dx + cos(lo0) * dy, 3) + 0.0 as e, round(-cos(lo0) * sin(la0) * dx - sin(la0) * sin(lo0) * dy + cos(la0) * dz, 3) + 0.0 as n, round(cos(la0) * cos(lo0) * dx + cos(la0) * sin(lo0) * dy + sin(la0) * dz, 3) + 0.0 as u from d""")
def enu_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """degrees to a local frame, millimetres."""
    e, n, u = geo.latlon_to_enu(F.col("lat"), F.col("lon"), F.col("h"), 45.5, 9.2, 120.0)
    mm = lambda c: F.round(c, 3) + 0.0
    return places(spark, sf_dir).select("c_custkey", mm(e).alias("e"), mm(n).alias("n"), mm(u).alias("u"))


@query(f"select c_custkey, round({LAT}, 6) + 0.0 as lat, round({LON}, 6) + 0.0 as lon from customer")
def geodetic_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To the local frame and back."""
    enu = geo.latlon_to_enu(F.col("lat"), F.col("lon"), F.col("h"), 45.5, 9.2, 120.0)
    x = places(spark, sf_dir).select("c_custkey", *[c.alias(k) for c, k in zip(enu, ("e", "n", "u"), strict=True)])
    lat, lon, _ = geo.enu_to_latlon(F.col("e"), F.col("n"), F.col("u"), 45.5, 9.2, 120.0)
    return x.select("c_custkey", r6(lat).alias("lat"), r6(F.when(F.round(lon, 6) == 180, -lon).otherwise(lon)).alias("lon"))


SQL_UTM = f"""with pl as (select c_custkey, radians({LAT}) as la, {LAT} as lat, {LON} as lon, (floor(({LON} + 180) / 6)::bigint % 60 + 1)::int as zone from customer),
a as (select *, {geo.A} / sqrt(1 - {geo.E2!r} * sin(la) * sin(la)) as n, pow(tan(la), 2) as t, {geo.EP2!r} * cos(la) * cos(la) as k, cos(la) * radians(lon - (zone * 6 - 183)) as a,
  {geo.A} * ({1 - geo.E2 / 4 - 3 * geo.E2**2 / 64 - 5 * geo.E2**3 / 256!r} * la - {3 * geo.E2 / 8 + 3 * geo.E2**2 / 32 + 45 * geo.E2**3 / 1024!r} * sin(2 * la) + {15 * geo.E2**2 / 256 + 45 * geo.E2**3 / 1024!r} * sin(4 * la) - {35 * geo.E2**3 / 3072!r} * sin(6 * la)) as m from pl)
select c_custkey, zone, round(0.9996 * n * (a + (1 - t + k) * pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * k - 58 * {geo.EP2!r}) * pow(a, 5) / 120) + 500000.0, 3) + 0.0 as east,
  round(0.9996 * (m + n * tan(la) * (a * a / 2 + (5 - t + 9 * k + 4 * k * k) * pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * k - 330 * {geo.EP2!r}) * pow(a, 6) / 720)) + case when lat < 0 then 10000000.0 else 0 end, 3) + 0.0 as north from a"""


@query(SQL_UTM)
def utm_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7, G11."""
    east, north = geo.latlon_to_utm(F.col("lat"), F.col("lon"))
    mm = lambda c: F.round(c, 3) + 0.0
    return places(spark, sf_dir).select("c_custkey", geo.utm_zone(F.col("lon")).alias("zone"), mm(east).alias("east"), mm(north).alias("north"))


@query(f"select c_custkey as id, round({LAT}, 8) + 0.0 as lat, round({LON}, 8) + 0.0 as lon from customer")
def map_file_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places as UTM metres, written as elements of an OSM file and read from them: the degrees they began with."""
    zone = geo.utm_zone(F.col("lon"))
    east, north = geo.latlon_to_utm(F.col("lat"), F.col("lon"))
    at = places(spark, sf_dir).select(F.col("c_custkey").alias("id"), (F.col("lat") >= 0).alias("up"), zone.alias("zone"), east.alias("x"), north.alias("y"))
    lat, lon = geo.utm_to_latlon(F.col("x"), F.col("y"), F.col("zone"), F.col("up"))
    points = at.select("id", lat.alias("lat"), lon.alias("lon"), F.lit(None).cast("double").alias("ele"))
    ways = spark.createDataFrame([], "id long, nodes array<long>, type string, subtype string")
    file = store.osm_elements(points, ways, spark.createDataFrame([], "id long, left_way long, right_way long, subtype string"))
    part = lambda k: F.regexp_extract("value", f' {k}="([^"]*)"', 1)
    return file.where("part = 1").select(part("id").cast("long").alias("id"), *[(F.round(part(k).cast("double"), 8) + 0.0).alias(k) for k in ("lat", "lon")])


# Line graphs, lanes and cameras over the driver's tables


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with ``k``, a line's place in its order; line numbers repeat."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    li = table(spark, sf_dir, "lineitem")
    return li.repartition(parts(li), "l_orderkey").withColumn("k", F.row_number().over(w))


SQL_LINES = "li as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)::int as k from lineitem)"


def order_paths(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Each order a path of its lines, classes by supplier."""
    w = Window.partitionBy("graph").orderBy("node")
    nodes = numbered_lines(spark, sf_dir).select(F.col("l_orderkey").alias("graph"), F.col("k").alias("node"), F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"), (F.col("l_suppkey") % 3).cast("int").alias("cls"), (F.col("l_partkey") % 4).cast("int").alias("fallback"))
    edges = nodes.withColumn("dst", F.lead("node").over(w)).where("dst is not null").select("graph", F.col("node").alias("src"), "dst")
    return nodes, edges


SQL_PATHS = f"{SQL_LINES}, pa as (select l_orderkey as graph, k as node, k, (l_suppkey % 3)::int as cls, count(*) over (partition by l_orderkey) as n, lead((l_suppkey % 3)::int) over (partition by l_orderkey order by k) as next_cls, lag((l_suppkey % 3)::int) over (partition by l_orderkey order by k) as prev_cls from li)"


@query(f"""with {SQL_PATHS} select graph, node, 'end' as reason from pa where n > 1 and (k = 1 or k = n) union all
select graph, node, 'class' from pa where (next_cls is not null and next_cls <> cls) or (prev_cls is not null and prev_cls <> cls)""")
def points_of_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: ends and class changes of every graph."""
    return linegraph.points_of_interest(*order_paths(spark, sf_dir), parts=parts(table(spark, sf_dir, "lineitem")))


@query(f"with {SQL_PATHS} select graph, 1 + sum(case when k > 1 and next_cls is not null and next_cls <> cls then 1 else 0 end)::bigint as lines from pa where n > 1 group by 1")
def linestring_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linestrings that each graph is cut into."""
    out = lineorder.linestrings(*order_paths(spark, sf_dir))
    return out.groupBy("graph").agg(F.count("*").alias("lines"))


@query(f"with {SQL_LINES} select l_orderkey as ls, count(*) as n, arg_min(l_partkey, k) as first, arg_max(l_partkey, k) as last, round((arg_min(l_quantity, k) + arg_max(l_quantity, k)) / 2, 6) + 0.0 as cx, round((arg_min(l_discount, k) + arg_max(l_discount, k)) / 2, 6) + 0.0 as cy from li group by 1")
def line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ends and centre of linestrings."""
    rows = numbered_lines(spark, sf_dir).select(F.col("l_orderkey").alias("ls"), "k", F.col("l_partkey").alias("node"), F.col("l_quantity").alias("x"), F.col("l_discount").alias("y"))
    return lanes.line_ends(rows).select("ls", "n", "first", "last", r6(F.col("cx")).alias("cx"), r6(F.col("cy")).alias("cy"))


@query(f"""with {SQL_BOXES}, c as (select *, max_x - min_x as w, max_y - min_y as h, (min_x + max_x) / 2 as cx, (min_y + max_y) / 2 as cy from bx)
select id, case when w > h then max_x when h > w then cx else cx end as ax, case when w > h then cy when h > w then min_y else max_y end as ay,
  case when w > h then min_x when h > w then cx else min_x end as bx, case when w > h then cy when h > w then max_y else cy end as by_ from c""")
def crossing_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle line of 4-node shapes."""
    b = part_boxes(spark, sf_dir)
    at = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    corners = F.array(at("min_x", "min_y"), at("max_x", "min_y"), at("max_x", "max_y"), at("min_x", "max_y"))
    m = lanes.rectangle_lines(b.select(F.col("id").alias("graph"), corners.alias("corners")))
    return m.select(F.col("graph").alias("id"), *[F.col("middle")[k][c].alias(n) for k, c, n in ((0, "x", "ax"), (0, "y", "ay"), (1, "x", "bx"), (1, "y", "by_"))])


SQL_ENDS = f"{SQL_LINES}, le as (select l_orderkey as ls, arg_min(l_quantity, k) as sx, arg_min(l_discount, k) as sy, arg_max(l_quantity, k) as ex, arg_max(l_discount, k) as ey, avg(l_quantity) as cx, avg(l_discount) as cy from li group by 1)"


@query(f"""with {SQL_ENDS}, p as (select ls as a, ls + 1 as b from le),
j as (select p.a, p.b, (l.ex - l.sx) * (o.cy - l.sy) - (l.ey - l.sy) * (o.cx - l.sx) as across from p join le l on l.ls = p.a join le o on o.ls = p.b)
select case when round(across, 9) < 0 then b else a end as right_ls, case when round(across, 9) < 0 then a else b end as left_ls from j""")
def lane_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sides of a lane swapped where the other is to the right."""
    lines = numbered_lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("ls")).agg(
        *[F.min_by(c, "k").alias(n) for c, n in (("l_quantity", "sx"), ("l_discount", "sy"))],
        *[F.max_by(c, "k").alias(n) for c, n in (("l_quantity", "ex"), ("l_discount", "ey"))],
        F.avg("l_quantity").alias("cx"), F.avg("l_discount").alias("cy"),
    )
    pairs = lines.select(F.col("ls").alias("right_ls"), (F.col("ls") + 1).alias("left_ls"))
    return lanes.orient(pairs, lines)


@query("""with l as (select distinct l_orderkey as ls, unnest([l_suppkey, l_partkey + 1000000]) as node from lineitem)
select node, array_to_string(list_sort(list(distinct ls)), ',') as linestrings, array_to_string(list_sort(list(distinct ls // 2)), ',') as lanelets from l group by 1""")
def node_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linestrings and lanes of every node; orders 2k and 2k+1 are the sides of lane k."""
    ends = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ls"), F.explode(F.array(F.col("l_suppkey"), F.col("l_partkey") + 1000000)).alias("node"))
    lines = ends.groupBy("ls").agg(F.lit(0).alias("graph"), F.collect_set("node").alias("nodes"))
    lane = F.floor(F.col("ls") / 2)
    sides = lines.select(lane.alias("lane"), (lane * 2).alias("right_ls"), (lane * 2 + 1).alias("left_ls")).distinct()
    nodes = lines.select("graph", F.explode("nodes").alias("node")).distinct()
    return lanes.annotate(nodes, lines, sides).select("node", F.array_join(F.col("linestrings").cast("array<string>"), ",").alias("linestrings"), F.array_join(F.col("lanelets").cast("array<string>"), ",").alias("lanelets"))


CAMERA = camera.Pinhole(500, 480, 320, 240, (0.5, 0.1, 1.6), 0.02, 0.05, 0.01)
_P = [[repr(float(v)) for v in row] for row in CAMERA.projection]
_DOT = [f"(x * 20 + 5) * {r[0]} + y * 10 * {r[1]} + z * {r[2]} + {r[3]}" for r in _P]


@query(f"with {SQL_POINTS}, p as (select vec_id, {_DOT[0]} as a, {_DOT[1]} as b, {_DOT[2]} as c from pts) select vec_id, round(case when c > 0 then a / c end, 3) + 0.0 as u, round(case when c > 0 then b / c end, 3) + 0.0 as v from p")
def image_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """World points in an image; none behind the camera."""
    u, v = camera.project_columns(CAMERA, F.col("x") * 20 + 5, F.col("y") * 10, F.col("z"))
    return points(spark, sf_dir).select("vec_id", (F.round(u, 3) + 0.0).alias("u"), (F.round(v, 3) + 0.0).alias("v"))


@query()
def graph_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stack of processors over near-point graphs (sequential inside a graph: fixtures in tests)."""
    p = points(spark, sf_dir)
    e = grid.pairs_within(p, p, 0.05).where("l.label = r.label and l.vec_id < r.vec_id").select(F.col("l.label").alias("graph"), F.col("l.vec_id").alias("src"), F.col("r.vec_id").alias("dst"))
    nodes = p.select(F.col("label").alias("graph"), F.col("vec_id").alias("node"), "x", "y", (F.col("label") % 5).alias("cls"))
    lg = linegraph
    rows = lg.process(lg.to_rows(nodes, e), lg.box_replace(), lg.fit_replace(sample_dist=0.01), lg.cycle_flatten(), lg.auto_circle(threshold=0.02, resample_distance=0.01), lg.line_smooth(1.0), lg.fork_remove(), lg.drop_short(2))
    return lg.nodes_of(lg.renumber(rows)).drop("part")


@query(f"""with recursive {SQL_POINTS}, n as (select label as graph, vec_id as node, x, y, count(*) over (partition by label) as size, row_number() over (partition by label order by vec_id) as k from pts),
h as (select * from n where size > 1 and (k = 1 or k = size)),
c as (select a.graph, a.node, b.graph as g, row_number() over (partition by a.graph, a.node order by b.graph, b.node) as r from h a join n b on a.graph <> b.graph and sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) <= 0.02),
e as (select graph as a, g as b from c where r = 1 union select g, graph from c where r = 1),
w(graph, root) as (select distinct graph, graph from n union select e.b, w.root from w join e on e.a = w.graph where w.root < e.b), m as (select graph, min(root) as merged from w group by 1)
select graph as old_graph, node, merged as graph from n join m using (graph)""")
def head_connection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of lines joined until none is in range."""
    p = points(spark, sf_dir).select(F.col("label").alias("graph"), F.col("vec_id").alias("node"), "x", "y", F.lit(1).alias("cls"))
    w = Window.partitionBy("graph").orderBy("node")
    edges = p.withColumn("dst", F.lead("node").over(w)).where("dst is not null").select("graph", F.col("node").alias("src"), "dst")
    nodes, _ = linegraph.connect_heads(p, edges, 0.02)
    return nodes.select("old_graph", "node", "graph")


@query()
def split_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3, L4: splits spread across graphs (iterative: fixtures in tests)."""
    p = points(spark, sf_dir).select(F.col("label").alias("graph"), F.col("vec_id").alias("node"), "x", "y", "dx", "dy")
    w = Window.partitionBy("graph").orderBy("node")
    edges = p.withColumn("dst", F.lead("node").over(w)).where("dst is not null").select("graph", F.col("node").alias("src"), "dst")
    seen, _ = lanes.propagate_splits(p, p.groupBy("graph").agg(F.min("node").alias("node")), 0.01, 0.05, 0.01, edges=edges, with_relations=False)
    return seen


@query(f"""with recursive {SQL_POINTS}, {SQL_NEAR}, w(node, hop) as (select vec_id, 0 from pts where label % 2 = 0 union select ne.b, w.hop + 1 from w join ne on ne.a = w.node join pts on vec_id = ne.b where label % 2 <> 0 and w.hop < 60),
h as (select node, min(hop) as hop from w group by 1), p as (select h.node, h.hop, min(q.node) as parent from h join ne on ne.a = h.node join h q on q.node = ne.b and q.hop = h.hop - 1 where h.hop > 0 group by 1, 2),
v(node, hop, z) as (select vec_id, 0, z from pts where label % 2 = 0 union all select p.node, p.hop, v.z from v join p on p.parent = v.node and p.hop = v.hop + 1)
select vec_id as node, round(v.z, 6) + 0.0 as ele from pts left join v on v.node = vec_id""")
def elevation_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevations spread to a fixed point; the SQL ends at 60 rounds, more than the test tables need."""
    p = points(spark, sf_dir).select(F.col("vec_id").alias("node"), "x", "y", F.when(F.col("label") % 2 == 0, F.col("z")).alias("ele"))
    return lanes.fill_elevation(p, 0.03).select("node", r6(F.col("ele")).alias("ele"))


@query()
def region_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of a class raster folded into line graphs (sequential in a drive: fixtures in tests)."""
    seen = seen_pixels(spark, sf_dir).select((F.col("frame") % 3).alias("drive"), (F.floor(F.col("frame") / 3) % 4).alias("at"), F.col("frame"), "row", "col", "cls", "weight")
    sums = seen.groupBy("drive", F.col("at").alias("frame"), "row", "col", "cls").agg(F.sum("weight").alias("weight"))
    by = ["drive", "frame"]
    region = blend.best_class(sums, by).withColumnRenamed("cls", "best").join(blend.second_best_class(sums, by).withColumnRenamed("cls", "second"), [*by, "row", "col"])
    o = boxparser.ParserOptions(window=16, overlap=8)
    region = region.select("drive", "frame", "row", "col", "best", "second", F.lit(0.0).alias("tl_x"), (F.col("frame") * 0.4).alias("tl_y"))
    return boxparser.fold_drives(boxparser.find_boxes(region, o), o)


# Frames on the map


MAP = {"resolution": 0.25, "shape": (50, 50), "centre": (24.3, 25.4), "offset": 1.0}


def survey_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as frames with a pose."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(k.alias("frame"), (F.col("o_custkey") % 97 * 0.31 + 0.013).alias("x"), (k % 89 * 0.29 + 0.007).alias("y"), F.radians(k * 7 % 360 + 3.3).alias("heading"))


SQL_FRAMES = "fr as (select o_orderkey as frame, (o_custkey % 97) * 0.31::double + 0.013::double as x, (o_orderkey % 89) * 0.29::double + 0.007::double as y, radians((o_orderkey * 7 % 360) + 3.3::double) as heading from orders)"


def sql_placed(chunk: str) -> str:
    """The map by ``chunk``: every pixel near where a frame's pixel falls that reads this one."""
    return f"""fc as (select *, {chunk} as chunk, heading + radians(-90.0::double) as angle from fr),
an as (select chunk, min(x) - 7 as tl_x, max(y) + 7 as tl_y, max(x) + 7 as br_x, min(y) - 7 as br_y, trunc((max(y) + 7 - (min(y) - 7)) / 0.25)::int as h_px, trunc((max(x) + 7 - (min(x) - 7)) / 0.25)::int as w_px from fc group by 1),
pl as (select chunk, px.row as v, px.col as u, cls, weight, cos(angle) as c, sin(angle) as s, (x - tl_x) / 0.25 as dx, (tl_y - y) / 0.25 as dy, h_px, w_px from px join fc using (frame) join an using (chunk)),
cd as (select *, floor(c * (u - 24.3) + s * (v - 25.4) + dx)::int + a - 1 as i, floor(c * (v - 25.4) - s * (u - 24.3) + dy)::int + b - 1 as j from pl, (select range as a from range(4)), (select range as b from range(4))),
mp as (select chunk, j::int as row, i::int as col, cls, sum(weight) as weight from cd where floor(c * (i - dx) - s * (j - dy) + 24.3::double + 0.5) = u and floor(s * (i - dx) + c * (j - dy) + 25.4::double + 0.5) = v and i >= 0 and i < w_px and j >= 0 and j < h_px group by 1, 2, 3, 4)"""


def placed_frames(spark: SparkSession, sf_dir: str, chunk: Column) -> tuple[DataFrame, DataFrame]:
    frames = placement.frame_angles(survey_frames(spark, sf_dir), "gps", -90.0).withColumn("chunk", chunk)
    chunks = placement.anchors(frames, ["chunk"], *MAP["shape"], MAP["resolution"], MAP["offset"])
    at = frames.select("frame", "chunk", "x", "y", "angle").join(chunks.drop("br_x", "br_y"), "chunk")
    return blend.blend(placement.on_map(seen_pixels(spark, sf_dir), at, MAP["resolution"], MAP["centre"]), "sum", ["chunk"]), chunks


@query(f"with {SQL_PIXELS}, {SQL_FRAMES}, {sql_placed('frame // 400')} select * from mp")
def frames_on_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames turned by their heading, moved to their position, blended by chunk."""
    return placed_frames(spark, sf_dir, F.floor(F.col("frame") / 400))[0]


@query(f"""with {SQL_PIXELS}, {SQL_FRAMES}, {sql_placed('frame % 2')}, cu as (select c_custkey as frame, (c_custkey % 83) * 0.37::double + 0.003::double as x, (c_custkey % 71) * 0.33::double + 0.011::double as y from customer),
hi as (select cu.*, an.*, min(tl_x) over w as lef, max(br_x) over w as rig, min(br_y) over w as low, max(tl_y) over w as hig from cu join an on x between tl_x and br_x and y between br_y and tl_y window w as (partition by frame)),
wi as (select *, greatest(lef, least(x - 2.0, rig - 4.0)) as wx, least(hig, greatest(y + 2.0, low + 4.0)) as wy from hi),
cu2 as (select frame, chunk, wx, wy, trunc((hig - wy) / 0.25 + 1e-9)::int - trunc((hig - tl_y) / 0.25 + 1e-9)::int as r0, trunc((wx - lef) / 0.25 + 1e-9)::int - trunc((tl_x - lef) / 0.25 + 1e-9)::int as c0 from wi),
rg as (select frame, mp.row - r0 as row, mp.col - c0 as col, cls, wx, wy, sum(weight) as weight from cu2 join mp on mp.chunk = cu2.chunk and mp.row between r0 and r0 + 15 and mp.col between c0 and c0 + 15 group by 1, 2, 3, 4, 5, 6),
bs as (select frame, row, col, wx, wy, arg_max(cls, (weight * case when cls = 7 then 0.2::double else 1.0::double end) * 1000 - cls) as cls from rg group by 1, 2, 3, 4, 5)
select frame, count(*) as pixels, sum(case when cls in (2, 5) then 0 else cls end)::bigint as classes, sum(row * 31 + col)::bigint as places, round(min(wx), 6) + 0.0 as tl_x, round(min(wy), 6) + 0.0 as tl_y from bs group by 1""")
def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled windows of the map round positions, over the chunks that hold them."""
    pixels, chunks = placed_frames(spark, sf_dir, F.col("frame") % 2)
    k = F.col("c_custkey")
    at = table(spark, sf_dir, "customer").select(k.alias("frame"), (k % 83 * 0.37 + 0.003).alias("x"), (k % 71 * 0.33 + 0.011).alias("y"), F.lit(0.0).alias("angle"))
    x = placement.labelled_regions(pixels, chunks, at, (4.0, 4.0), MAP["resolution"], [2, 5], drivable=7)
    return x.groupBy("frame").agg(F.count("*").alias("pixels"), F.sum("cls").cast("long").alias("classes"), F.sum(F.col("row") * 31 + F.col("col")).cast("long").alias("places"), r6(F.min("tl_x")).alias("tl_x"), r6(F.min("tl_y")).alias("tl_y"))


@query(f"with {SQL_PIXELS} select frame // 4 as frame, row, col, cls, max(weight) as weight from px group by 1, 2, 3, 4")
def camera_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes that any of a frame's cameras sees; four frames stand for cameras."""
    seen = seen_pixels(spark, sf_dir).withColumn("frame", F.floor(F.col("frame") / 4))
    return placement.combine_cameras(seen.repartition(parts(table(spark, sf_dir, "lineitem")), "frame"))


@query(f"""with {SQL_PIXELS}, {SQL_FRAMES}, m as (select px.*, floor(cos(heading) * (col - 25) - sin(heading) * (row - 25) + 25.5) as mc, floor(sin(heading) * (col - 25) + cos(heading) * (row - 25) + 25.5) as mr from px join fr using (frame))
select frame, row, col, cls from m where mc between 0 and 49 and mr between 0 and 49 and not (mr between 10 and 39 and mc between 18 and 31)""")
def vehicle_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vehicle's own shape, turned by each frame's heading, hides what is under it."""
    frames = survey_frames(spark, sf_dir).withColumn("angle", F.col("heading"))
    return placement.mask_vehicle(seen_pixels(spark, sf_dir), frames, (50, 50), [(10, 40, 18, 32)]).select("frame", "row", "col", "cls")


@query(f"""with recursive {SQL_PIXELS}, q as (select distinct frame % 20 as frame, row, col, cls from px), f as (select distinct frame, row, col, frame * 2500 + row * 50 + col as id from q where cls not in (7)),
e as (select a.id as a, b.id as b from f a join f b on a.frame = b.frame and a.id <> b.id and abs(a.row - b.row) <= 1 and abs(a.col - b.col) <= 1),
w(id, root) as (select id, id from f union select e.b, w.root from w join e on e.a = w.id where w.root < e.b), r as (select id, min(root) as blob from w group by 1), n as (select blob, count(*) as n from r group by 1),
k as (select id from r join n using (blob) where n >= 4)
select frame, row, col, cls from q where cls = 7 or frame * 2500 + row * 50 + col in (select id from k)""")
def frame_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blobs of fewer than four pixels go from each frame, the drivable class stays."""
    px = seen_pixels(spark, sf_dir).select((F.col("frame") % 20).alias("frame"), "row", "col", "cls").distinct()
    return placement.clean_frames(px, 4, 7)


@query(f"""with {SQL_TRAJECTORY}, e as (select user_id, min(x) as a, min(y) as b, max(x) as c, max(y) as d from traj group by 1)
select user_id, a as left_x, d as top_y, c as right_x, b as bottom_y, trunc((d - b) / 0.5)::int as h_px, trunc((c - a) / 0.5)::int as w_px, 0.5::double as resolution from e""")
def extents_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16: extents as a JSON document, and read from it again."""
    e = poses.extents(trajectory(spark, sf_dir), ["user_id"])
    doc = e.select("user_id", poses.extents_json(0.5, F.col("min_x"), F.col("max_y"), F.col("max_x"), F.col("min_y")).alias("doc"))
    back = doc.select("user_id", poses.extents_from_json(F.col("doc")).alias("e"))
    return back.select("user_id", F.col("e.tl_x").alias("left_x"), F.col("e.tl_y").alias("top_y"), F.col("e.br_x").alias("right_x"), F.col("e.br_y").alias("bottom_y"), "e.h_px", "e.w_px", "e.resolution")


@query("""with l as (select l_orderkey as ls, l_orderkey % 7 as graph, min(l_partkey) as first, max(l_partkey) as last, avg(l_quantity) as cx, avg(l_tax) as cy from lineitem group by 1, 2),
d as (select distinct l_suppkey % 7 as graph, l_partkey as node, (l_suppkey * 3 + 1) % 7 as other_graph, l_partkey + 1 as other_node from lineitem), r as (select * from d union select other_graph, other_node, graph, node from d),
b as (select distinct l.ls, a.other_graph as g, a.other_node as f, z.other_node as t from l join r a on a.graph = l.graph and a.node = l.first join r z on z.graph = l.graph and z.node = l.last and z.other_graph = a.other_graph),
p as (select distinct least(b.ls, m.ls) as right_ls, greatest(b.ls, m.ls) as left_ls from b join l m on m.graph = b.g and m.ls <> b.ls and ((m.first = b.f and m.last = b.t) or (m.first = b.t and m.last = b.f)))
select right_ls, left_ls from p join l a on a.ls = right_ls join l b on b.ls = left_ls where sqrt((a.cx-b.cx)*(a.cx-b.cx)+(a.cy-b.cy)*(a.cy-b.cy)) >= 2""")
def lanes_by_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose ends are split-related to the ends of another line."""
    li = table(spark, sf_dir, "lineitem")
    lines = li.groupBy(F.col("l_orderkey").alias("ls"), (F.col("l_orderkey") % 7).alias("graph")).agg(F.min("l_partkey").alias("first"), F.max("l_partkey").alias("last"), F.avg("l_quantity").alias("cx"), F.avg("l_tax").alias("cy"))
    rel = li.select((F.col("l_suppkey") % 7).alias("graph"), F.col("l_partkey").alias("node"), ((F.col("l_suppkey") * 3 + 1) % 7).alias("other_graph"), (F.col("l_partkey") + 1).alias("other_node"))
    return lanes.pair_by_relations(lines, lanes.symmetric(rel), 2.0)


@query(f"""with {SQL_BOXES}, a as (select *, (max_x-min_x)*(max_y-min_y) as area from bx)
select id from a where not exists (select 1 from a b where a.area > b.area and
greatest(0, least(a.max_x, b.max_x) - greatest(a.min_x, b.min_x)) * greatest(0, least(a.max_y, b.max_y) - greatest(a.min_y, b.min_y)) > 0.3 * b.area + 1e-9)""")
def lane_overlap_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lanes as polygons between two lines; of two that overlap the larger goes, of equal ones none."""
    b = part_boxes(spark, sf_dir)
    at = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    side = lambda k, y: b.select((F.col("id") * 2 + k).alias("ls"), F.array(at("min_x", y), at("max_x", y)).alias("xy"))
    lines = side(0, "min_y").unionByName(side(1, "max_y"))
    kept = lanes.prune_lanes(b.select((F.col("id") * 2).alias("right_ls"), (F.col("id") * 2 + 1).alias("left_ls")), lines, 0.3 + 1e-9, 40.0)
    return kept.select((F.col("right_ls") / 2).cast("long").alias("id"))


@query()
def lane_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines side by side, searched for lanes, as elements of the map (iterative: fixtures in tests)."""
    li = numbered_lines(spark, sf_dir)
    nodes = li.select(F.col("l_orderkey").alias("graph"), F.col("k").cast("long").alias("node"), (F.col("k") * 3.0 + F.col("l_discount")).alias("x"), (F.col("l_orderkey") * 3.5 + F.col("l_tax")).alias("y"), F.lit(3).alias("cls"))
    w = Window.partitionBy("graph").orderBy("node")
    edges = nodes.withColumn("dst", F.lead("node").over(w)).where("dst is not null").select("graph", F.col("node").alias("src"), "dst")
    found = lanes.find_lanes(nodes, edges, 1.5, 5.0, 0.5)
    _, _, lanelets = lanes.map_elements(found, nodes, (0.0, 0.0, 0.0))
    return lanelets


@query(f"""with {SQL_BOXES}, c as (select id, case when id % 3 = 0 then 9 when id % 3 = 1 then 14 else 3 end as cls from bx)
select id as graph, cls, case cls when 9 then 2 when 14 then 1 end::bigint as ways, case cls when 9 then 4 when 14 then 2 end::bigint as points, case cls when 9 then 1 else 0 end::bigint as lanelets from c where cls <> 3""")
def shape_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crosswalks as two lines and a walkway, stop lines as one line."""
    b = part_boxes(spark, sf_dir)
    at = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    corners = F.array(at("min_x", "min_y"), at("max_x", "min_y"), at("max_x", "max_y"), at("min_x", "max_y"))
    cls = F.when(F.col("id") % 3 == 0, 9).when(F.col("id") % 3 == 1, 14).otherwise(3)
    shapes = b.select(F.col("id").alias("graph"), cls.alias("cls"), corners.alias("corners"))
    _, ways, lets = lanes.shape_elements(shapes, (0.0, 0.0, 0.0))
    key = lambda k: F.shiftrightunsigned(F.xxhash64(F.lit("shape"), F.col("graph"), F.lit(k)), 1)
    named = shapes.select("graph", "cls", F.explode(F.array(key(0), key(1))).alias("id")).join(ways, "id")
    left = lets.select(F.col("left_way").alias("id"), F.lit(1).alias("one"))
    return named.join(left, "id", "left").groupBy("graph", "cls").agg(F.count("*").alias("ways"), F.sum(F.size("nodes")).cast("long").alias("points"), F.count("one").alias("lanelets"))
