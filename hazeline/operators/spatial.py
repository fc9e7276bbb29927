"""Sensors to wards: distances, semivariogram, ordinary kriging, ward join, GeoJSON."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.air import aqi_category, aqi_label, first_truthy
from ..functions.geo import haversine_km
from ..session import stored
from .chunks import as_list, spread_by

#: Targets that travel together.
TARGET_BLOCK = 512


def target_blocks(targets: DataFrame, columns: Sequence[str], size: int = TARGET_BLOCK) -> tuple[DataFrame, int]:
    """(rows (_t, targets) of about ``size`` targets each, their number): any number of targets, no row holds many."""
    blocks = max(1, -(-targets.count() // size))
    numbered = targets.select(F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int").alias("_t"), F.struct(*columns).alias("target"))
    return numbered.groupBy("_t").agg(F.collect_list("target").alias("targets")), blocks


def with_targets(df: DataFrame, targets: DataFrame, size: int = TARGET_BLOCK) -> DataFrame:
    """Every row with every target, block by block; adds ward_* and distance."""
    cells, blocks = target_blocks(targets.select("ward_id", F.col("lat").alias("ward_lat"), F.col("lon").alias("ward_lon")), ["ward_id", "ward_lat", "ward_lon"], size)
    each = df.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    out = each.join(cells, "_t").select(*df.columns, F.inline("targets"))
    return out.withColumn("distance_km", haversine_km(F.col("lat"), F.col("lon"), F.col("ward_lat"), F.col("ward_lon")))


def location_means(df: DataFrame, by: Sequence[str], value: str = "pm25", count: str | None = None) -> DataFrame:
    """One row per (moment, location): copies and co-located sensors are averaged map-side.

    Kriging groups are therefore bounded by the number of places, not of rows.
    """
    return df.where(F.col(value).isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()).groupBy(
        *by, "lat", "lon").agg(F.avg(value).alias(value), *([F.count(F.lit(1)).alias(count)] if count else []))


#: Places of a cell that meet in one task, and rows of a distance table.
CELL_PLACES, TABLE_CELLS = 2000, 4_000_000


def in_cell_blocks(means: DataFrame, sent: DataFrame, cell: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of the pair join with the pairs of blocks a row belongs to, if any cell is too full for one task.

    A place has one block of its cell and meets all blocks of the other side:
    it is repeated once per block, and each pair of blocks is a join key.
    """
    means = stored(means, "cell-places")
    counts = means.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / CELL_PLACES).cast("int").alias("_b")).where("_b > 1")
    if counts.isEmpty():
        return means, sent, []
    counts = stored(counts, "full-cells")

    def dealt(rows: DataFrame, own: str, other: str, place: list[str]) -> DataFrame:
        b = F.coalesce("_b", F.lit(1))
        numbered = rows.join(counts, cell, "left").withColumn(own, F.pmod(F.xxhash64(*place), b).cast("int"))
        return numbered.withColumn(other, F.explode(F.sequence(F.lit(0), b - 1))).drop("_b")

    return dealt(means, "_i", "_j", ["lat", "lon"]), dealt(sent, "_j", "_i", ["_lat", "_lon"]), ["_i", "_j"]


def semivariogram(df: DataFrame, by: str | Sequence[str], value: str, bin_width: float, n_bins: int) -> DataFrame:
    """Empirical semivariogram (bin, n_pairs, gamma, distance) over pairs within each moment.

    Only pairs nearer than all bins together count, so location means meet in
    cells of that size: each is sent to its own and the neighbouring cells, pairs
    are joined by moment and cell, and sums per bin combine map-side. A cell of
    more than ``CELL_PLACES`` places is split into hash blocks, whose pairs are
    dealt to tasks one by one.
    """
    keys = as_list(by)
    reach = bin_width * n_bins
    means = location_means(df, keys, value).select(*keys, "lat", "lon", F.col(value).alias("_z"), F.floor(F.col("lon") / reach).alias("_x"), F.floor(F.col("lat") / reach).alias("_y"))
    around = F.explode(F.array(*[F.struct((F.col("_x") + dx).alias("_x"), (F.col("_y") + dy).alias("_y")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]))
    sent = means.select(*keys, "lat", "lon", "_z", around.alias("_c")).select(*keys, "_c._x", "_c._y", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.col("_z").alias("_w"))
    meet = [*keys, "_x", "_y"]
    means, sent, blocks = in_cell_blocks(means, sent, meet)
    pairs = means.join(sent, [*meet, *blocks]).where("lat < _lat or lat = _lat and lon < _lon")
    d = F.sqrt(F.pow(F.col("lat") - F.col("_lat"), 2) + F.pow(F.col("lon") - F.col("_lon"), 2))
    rows = pairs.select(d.alias("d"), F.pow(F.col("_z") - F.col("_w"), 2).alias("s")).withColumn("bin", F.floor(F.col("d") / bin_width + 1e-9).cast("int"))
    return rows.where(F.col("bin") < n_bins).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n_pairs"), (F.avg("s") / 2).alias("gamma"), F.avg("d").alias("distance"))


@dataclass(frozen=True)
class Variogram:
    model: str = "spherical"
    sill: float = 1.0
    range_: float = 0.1
    nugget: float = 0.0

    def __call__(self, h: np.ndarray) -> np.ndarray:
        return self.nugget + self.sill * shape(self.model, h, self.range_)


def shape(model: str, h: np.ndarray, range_: float) -> np.ndarray:
    """Unit variogram forms; exponential and gaussian use the effective range."""
    r = h / range_
    if model == "spherical":
        return np.where(r < 1, 1.5 * r - 0.5 * r**3, 1.0)
    if model == "exponential":
        return 1 - np.exp(-3 * r)
    if model == "gaussian":
        return 1 - np.exp(-((7 * r / 4) ** 2))
    raise ValueError(model)


def fit_variogram(bins: DataFrame, model: str = "spherical", steps: int = 40) -> Variogram:
    """Least squares over the bins, weighted by pairs: a range grid, sill and nugget in closed form."""
    rows = bins.orderBy("bin").collect()  # as many as the caller asked bins for
    h = np.array([r["distance"] for r in rows])
    g = np.array([r["gamma"] for r in rows])
    w = np.sqrt(np.array([r["n_pairs"] for r in rows], float))
    best = None
    for range_ in np.linspace(h.max() / steps, h.max() * 1.5, steps):
        design = np.column_stack([shape(model, h, range_), np.ones_like(h)])
        for columns in ((0, 1), (0,), (1,)):
            solution = np.zeros(2)
            solution[list(columns)] = np.linalg.lstsq(design[:, columns] * w[:, None], g * w, rcond=None)[0]
            if (solution < 0).any():
                continue
            loss = float((((design @ solution) - g) * w) @ (((design @ solution) - g) * w))
            if best is None or loss < best[0] - 1e-12:
                best = (loss, Variogram(model, max(float(solution[0]), 1e-9), float(range_), float(solution[1])))
    return best[1]


def krige_all(xy: np.ndarray, z: np.ndarray, goal: np.ndarray, variogram: Variogram) -> tuple[np.ndarray, np.ndarray]:
    """(estimates, variances) at the goals from all places."""
    n = len(z)
    system = np.ones((n + 1, n + 1))
    system[:n, :n] = variogram(np.hypot(xy[:, None, 0] - xy[None, :, 0], xy[:, None, 1] - xy[None, :, 1]))
    np.fill_diagonal(system, 0.0)
    reach = np.hypot(xy[:, None, 0] - goal[None, :, 0], xy[:, None, 1] - goal[None, :, 1])
    right = np.ones((n + 1, len(goal)))
    right[:n] = np.where(reach > 1e-10, variogram(reach), 0.0)
    try:
        w = np.linalg.solve(system, right)
    except np.linalg.LinAlgError:
        w = np.linalg.lstsq(system, right, rcond=None)[0]
    return z @ w[:n], (w * right).sum(axis=0)


def krige_nearest(xy: np.ndarray, z: np.ndarray, goal: np.ndarray, variogram: Variogram, neighbours: int) -> tuple[np.ndarray, np.ndarray]:
    """The same from each goal's nearest places, goals in slices so that no table exceeds ``TABLE_CELLS`` numbers."""
    order = np.lexsort((xy[:, 0], xy[:, 1]))
    xy, z = xy[order], z[order]
    step = max(1, TABLE_CELLS // len(z))
    estimate, variance = np.empty(len(goal)), np.empty(len(goal))
    for lo in range(0, len(goal), step):
        some = goal[lo:lo + step]
        far = np.hypot(xy[None, :, 0] - some[:, None, 0], xy[None, :, 1] - some[:, None, 1])
        for i, near in enumerate(np.argsort(far, axis=1, kind="stable")[:, :neighbours]):
            found = krige_all(xy[near], z[near], some[i:i + 1], variogram)
            estimate[lo + i], variance[lo + i] = found[0][0], found[1][0]
    return estimate, variance


def krige(
    df: DataFrame, targets: DataFrame, variogram: Variogram, by: str, *, value: str = "pm25",
    minimum: int = 3, floor_at_zero: bool = False, size: int = TARGET_BLOCK, neighbours: int | None = None,
) -> DataFrame:
    """Ordinary kriging of each moment's sensors onto any number of targets: value and variance.

    Moments with fewer than ``minimum`` readings give nothing. Distances are
    Euclidean in degrees. A group is one moment's places and one block of targets.
    All of the moment's places enter a target's system unless ``neighbours``
    says how many, the nearest (ties by latitude, then longitude): systems of
    that size then, however many places there are.
    """
    names = ["ward_id", "ward_name", "lat", "lon"]
    kinds = dict(targets.dtypes)
    blocks, n_blocks = target_blocks(targets, names, size)

    def solve(sensors: pd.DataFrame, places: pd.DataFrame) -> pd.DataFrame:
        places = places[names]
        goal, n = places[["lon", "lat"]].to_numpy(float), len(sensors)
        xy, z = sensors[["lon", "lat"]].to_numpy(float), sensors[value].to_numpy(float)
        if neighbours is not None and neighbours < n:
            estimate, variance = krige_nearest(xy, z, goal, variogram, neighbours)
        else:
            estimate, variance = krige_all(xy, z, goal, variogram)
        if floor_at_zero:
            estimate = np.maximum(estimate, 0.0)
        return places.assign(**{by: sensors[by].iloc[0], "pm25": estimate, "kriging_variance": variance})

    places = stored(location_means(df, [by], value, count="readings"), "kriging-places")
    moments = places.groupBy(by).agg(F.sum("readings").alias("_n")).where(F.col("_n") >= minimum)
    each = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_t")
    ready = spread_by(places.join(moments, by, "left_semi").select("*", each), by, "_t")
    goals = spread_by(moments.select(F.col(by).alias("_moment"), each).join(blocks, "_t").select("_moment", "_t", F.inline("targets")), "_moment", "_t")
    estimates = ready.groupBy(by, "_t").cogroup(goals.groupBy("_moment", "_t")).applyInPandas(
        solve, f"ward_id {kinds['ward_id']}, ward_name string, lat double, lon double, {by} {dict(df.dtypes)[by]}, pm25 double, kriging_variance double")
    return estimates.select(
        F.concat(F.lit("ward_"), F.col("ward_id")).alias("station_id"), F.lit("kriging_interpolated").alias("source"),
        "lat", "lon", F.col(by), "pm25", "kriging_variance", "ward_name", "ward_id")


def ward_values(wards: DataFrame, latest: DataFrame) -> DataFrame:
    """All wards with their latest features; 0 and missing values have category ``Unknown``."""
    features = latest.select(F.col("station_id").alias("_s"), F.col("pm25").alias("_pm25"), F.col("pm25_1h_mean").alias("_mean"))
    joined = wards.join(features, F.concat(F.lit("ward_"), F.col("ward_id")) == F.col("_s"), "left")
    value = F.when(F.col("_s").isNotNull(), first_truthy(F.col("_pm25"), F.coalesce("_mean", F.lit(0.0))))
    label = F.when(F.nullif("pm25", F.lit(0.0)).isNull(), F.lit("Unknown")).otherwise(aqi_label(aqi_category(F.col("pm25"), missing=0)))
    return joined.withColumn("pm25", value).select("ward_id", "ward_name", "lat", "lon", "pm25", label.alias("aqi_category"))


def heatmap_geojson(values: DataFrame, generated_at) -> DataFrame:
    """One FeatureCollection document; the wards are a bounded set, ordered by id."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("ward_id", "ward_name", "pm25", "aqi_category").alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"))
    ordered = F.array_sort(F.collect_list(F.struct("ward_id", feature.alias("f"))))
    doc = F.struct(F.lit("FeatureCollection").alias("type"), F.transform(ordered, lambda x: x["f"]).alias("features"),
                   generated_at.alias("generated_at"))
    return values.agg(F.to_json(doc, {"ignoreNullFields": "false"}).alias("geojson"))
