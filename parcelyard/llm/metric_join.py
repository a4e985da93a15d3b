"""Near-duplicate embeddings by an exact metric range join.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c), the range r.
Each label's vectors are parted among pivots: a vector's home cell is that of its nearest
pivot. Of two vectors within r, one in cell p, the other is within r of the plane halfway
between p and its own pivot (the segment between the two crosses it), so copying each
vector into the cells whose plane is that near loses no pair. Cells then join on their
own: every vector at home meets all vectors in its cell, so each link is seen once from
each side. Equal vectors fold into one first, with the number they stand for.

A cell is compared in blocks of ``CHUNK`` by ``CHUNK`` vectors, each a task's group of
bounded size; a block returns link counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelyard.llm.components import components
from parcelyard.llm.workspace import Workspace

COSINE = 0.98
CHUNK = 4096

# Left vectors compared at a time, and room for rounding when a vector is copied.
SLAB, SLACK = 256, 1e-9

CELL = ["label", "size"]


def _usable(vector: Column) -> Column:
    """Not null or empty, every component a finite number, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def _units(vectors) -> np.ndarray:
    """Rows of unit length, in double precision."""
    rows = np.stack([np.asarray(v, np.float64) for v in vectors])
    # Components are brought near 1 first, so that their squares neither vanish nor overflow.
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


HOMES = "label long, size int, cell int, home boolean, id long, weight long, vector array<double>"


def _assign(vectors: pd.DataFrame, pivots: pd.DataFrame, reach: float) -> pd.DataFrame:
    """Home cell of each vector, and the cells it has to be copied into."""
    if not len(vectors):
        return pd.DataFrame(columns=["label", "size", "cell", "home", "id", "weight", "vector"])
    rows = vectors.reset_index(drop=True)
    if len(pivots):
        points, centres = _units(rows["vector"]), _units(pivots.sort_values("id")["vector"])
        squared = 2 - 2 * points @ centres.T
        apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
        home = squared.argmin(axis=1)
        behind = squared - squared[np.arange(len(rows)), home][:, None]
        near = behind <= 2 * apart[home] * (reach + SLACK) + SLACK
        near[np.arange(len(rows)), home] = True
        row, cell = np.nonzero(near)
    else:
        row = np.arange(len(rows))
        cell, home = np.zeros_like(row), np.zeros_like(row)
    out = rows.loc[row, ["label", "size", "id", "weight", "vector"]].reset_index(drop=True)
    out["cell"], out["home"] = cell.astype(np.int32), home[row] == cell
    return out[["label", "size", "cell", "home", "id", "weight", "vector"]]


def _least_linked(mark: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Least node that each row and column of a block's link matrix is connected with."""
    while True:
        new_left, new_right = left.copy(), right.copy()
        for start in range(0, len(left), SLAB):
            part = mark[start : start + SLAB]
            far = np.where(part, right, np.iinfo(np.int64).max).min(axis=1)
            np.minimum(new_left[start : start + SLAB], far, out=new_left[start : start + SLAB])
            back = np.where(part, new_left[start : start + SLAB, None], np.iinfo(np.int64).max)
            np.minimum(new_right, back.min(axis=0), out=new_right)
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def _compare(block: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of one chunk at home with one chunk of the cell: counts, and the forest."""
    sides = [block[block["left_side"] == side] for side in (True, False)]
    if not len(sides[0]) or not len(sides[1]):
        return pd.DataFrame({"id": [], "links": [], "root": []}, dtype="int64")
    ids = [side["id"].to_numpy(np.int64) for side in sides]
    left, right = (_units(side["vector"]) for side in sides)
    weights = sides[1]["weight"].to_numpy(np.int64)
    mark = np.empty((len(left), len(right)), bool)
    for start in range(0, len(left), SLAB):
        mark[start : start + SLAB] = left[start : start + SLAB] @ right.T >= cosine
    mark &= ids[0][:, None] != ids[1]
    links = mark @ weights
    if not links.any():
        return pd.DataFrame({"id": [], "links": [], "root": []}, dtype="int64")
    roots = _least_linked(mark, *ids)
    out = pd.DataFrame(
        {
            "id": np.concatenate(ids),
            "links": np.concatenate([links, np.zeros(len(right), np.int64)]),
            "root": np.concatenate(roots),
        }
    )
    return out[(out["links"] > 0) | (out["root"] != out["id"])]


def _parts(count: Column) -> Column:
    return F.ceil(count / CHUNK).cast("int")


def _cell_count(count: Column) -> Column:
    """Pivots of a label with so many vectors: cells of ``CHUNK`` or so, at most the root.

    Each vector is held against every pivot, so beyond ``CHUNK`` squared vectors cells grow as
    the root does, which keeps both steps at the power 1.5.
    """
    return F.least(_parts(count), F.ceil(F.sqrt(count)).cast("int"))


def _cells(work: Workspace, classes: DataFrame, reach: float) -> DataFrame:
    """Classes in the cells they belong to or are near."""
    sized = classes.groupBy(*CELL).agg(F.count("*").alias("count"))
    sized = sized.select(
        *CELL, "count", _cell_count(F.col("count")).alias("cells")
    )
    parted = classes.join(sized, CELL)
    # About four times as many as needed, evenly drawn; then the first of these.
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = parted.where((F.col("cells") > 1) & (draw < 4 * F.col("cells") / F.col("count")))
    order = Window.partitionBy(*CELL).orderBy(F.xxhash64("id"), "id")
    pivots = work.write(
        drawn.withColumn("place", F.row_number().over(order))
        .where("place <= cells")
        .select(*CELL, "id", "vector", _parts(F.col("count")).alias("parts")),
        "pivots",
    )
    dealt = parted.withColumn("chunk", F.pmod(F.hash("id"), _parts(F.col("count"))))
    spread = pivots.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ).drop("parts")
    keys = [*CELL, "chunk"]
    homes = (
        dealt.select(*keys, "id", "weight", "vector")
        .groupBy(*keys)
        .cogroup(spread.groupBy(*keys))
        .applyInPandas(partial(_assign, reach=reach), HOMES)
    )
    return work.write(homes, "cells")


def _links(cells: DataFrame, cosine: float) -> DataFrame:
    """``id, links, root`` from every block of every cell."""
    cell = [*CELL, "cell"]
    sized = cells.groupBy(*cell).agg(_parts(F.count("*")).alias("parts"))
    rows = cells.join(sized, cell).withColumn("own", F.pmod(F.hash("id"), "parts"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    both = [
        frame.select(*cell, *(F.col(c).alias(n) for n, c in names), "id", "weight", "vector", side)
        for frame, names, side in (
            (rows.where("home"), (("a", "own"), ("b", "other")), F.lit(True).alias("left_side")),
            (rows, (("a", "other"), ("b", "own")), F.lit(False).alias("left_side")),
        )
    ]
    return (
        both[0]
        .unionByName(both[1])
        .groupBy(*cell, "a", "b")
        .applyInPandas(partial(_compare, cosine=cosine), "id long, links long, root long")
    )


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    ``vectors`` needs vec_id (long), embedding and label; other columns are ignored. Rows
    whose label or vec_id is null, or whose vector is null, empty, zero or holds a null or
    a number that is not finite, link with nothing and are their own component (null if
    vec_id is). Vectors of different lengths are never linked. Rows that repeat a vec_id
    and vector count as vectors of their own. An empty table gives an empty result.
    """
    work = Workspace(vectors.sparkSession, "metric-join")
    reach = math.sqrt(2 - 2 * cosine)
    rows = vectors.select(
        "vec_id",
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    rows = rows.withColumn("size", F.size("vector"))
    able = F.coalesce(
        _usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull(),
        F.lit(False),
    )
    classes = work.write(
        rows.where(able)
        .groupBy("label", "size", "vector")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")),
        "classes",
    )
    links = work.write(_links(_cells(work, classes, reach), cosine), "links")
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    found = components(
        work, links.select(F.col("id").alias("a"), F.col("root").alias("b")), "components"
    )
    named = (
        classes.join(counted, "id", "left")
        .join(found, F.col("id") == F.col("node"), "left")
        .select(
            *CELL,
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    linked = (
        rows.where(able)
        .join(named, ["label", "size", "vector"])
        .select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    )
    alone = rows.where(~able).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
