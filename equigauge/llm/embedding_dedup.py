"""Near-duplicate vectors by randomised-rotation binary codes.

Equal vectors are one class. A class lies in the cell of its nearest sampled centroid, its home, and asks in a few cells
more; a pair is found if the home of one is among the cells of the other. What asks is a code: the vector is rotated at
random and coded by the signs of its coordinates, and beside the code stands the inner product of the vector with it,
which corrects the estimate: the inner product of another, rotated vector with the code, divided by that factor, is an
unbiased estimate of the cosine, with an error whose bound follows from the factor. Several rotations narrow the bound.
Only classes with a pair whose bound reaches the threshold are sent again, as whole vectors, to the cells where they have
one, and their pairs are computed exactly, in double precision.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.llm.caches import cache_of
from equigauge.llm.components import connected_components
from equigauge.llm.joins import with_group
from equigauge.session import settle

#: Classes per cell aimed at, centroids drawn at most, cells of a vector at least, classes that live in a cell, and that
#: ask there, compared in one task.
CELL, CENTROIDS, NEAREST, PART, ASKING = 128, 16_384, 6, 2_048, 8
#: A vector asks in two more cells at this many cells, and at every doubling of them.
FEW_CELLS = 24
#: Centroids more alike than this are one.
APART = 0.5
#: Rotations of a code, and width of the confidence bound in standard errors.
ROTATIONS, SURE = 2, 3.0
#: Error of a cosine of vectors in single precision, and of factors in half precision.
ROUNDED = 0.002
STRIPE = 256


def rotation(dimension: int) -> np.ndarray:
    """`ROTATIONS` random rotations side by side."""
    held = cache_of("embedding_dedup")
    if dimension not in held:
        draw = np.random.Generator(np.random.PCG64(97 + dimension))
        parts = [np.linalg.qr(draw.standard_normal((dimension, dimension))) for _ in range(ROTATIONS)]
        held[dimension] = np.concatenate([q * np.sign(np.diag(r)) for q, r in parts], axis=1)
    return held[dimension]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; the largest component goes first, so no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits of the rotated rows, and per rotation the inner product of each row with its code."""
    dimension = units.shape[1]
    turned = units @ rotation(dimension)
    factors = np.abs(turned).reshape(len(units), ROTATIONS, dimension).sum(axis=2) / np.sqrt(dimension)
    return np.packbits(turned >= 0, axis=1), factors


def estimate(turned: np.ndarray, codes: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of rotated rows with coded ones, and the bound of the error of each coded one."""
    dimension = turned.shape[1] // ROTATIONS
    signs = np.unpackbits(codes, axis=1, count=ROTATIONS * dimension).astype(np.float32) * 2 - 1
    scaled = signs / np.repeat(factors, dimension, axis=1).astype(np.float32)
    about = turned.astype(np.float32) @ scaled.T / np.float32(ROTATIONS * np.sqrt(dimension))
    spread = (np.maximum(1 - factors**2, 0) / factors**2).sum(axis=1) / max(dimension - 1, 1)
    return about, SURE * np.sqrt(spread) / ROTATIONS


def _stack(rows: list) -> np.ndarray:
    return np.array(rows, np.float64)


def draw_centroids(vectors: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Centroids by dimension: at most `CENTROIDS` of the n `vectors` (embedding), without those close to another."""
    wanted = min(n // CELL + 1, CENTROIDS)
    drawn = vectors if n <= wanted else vectors.sample(min(1.0, 1.2 * wanted / n), seed=3)
    found: dict[int, list] = {}
    for vector in drawn.select("embedding").limit(wanted).toArrow()["embedding"].to_pylist():
        found.setdefault(len(vector), []).append(vector)
    out = {}
    for dimension, rows in found.items():
        units, kept = unit(_stack(rows)), np.empty((len(rows), dimension))
        n_kept = 0
        for v in units:
            if not n_kept or (kept[:n_kept] @ v).max() < APART:
                kept[n_kept] = v
                n_kept += 1
        out[dimension] = kept[:n_kept]
    return out


def cells_of(units: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The cells of each row, nearest first. More as centroids get more, or close vectors would share ever fewer."""
    near = min(NEAREST + 2 * (len(centroids) // FEW_CELLS).bit_length(), len(centroids))
    out = []
    for a in range(0, len(units), STRIPE):
        away = -(units[a:a + STRIPE] @ centroids.T)
        some = np.argpartition(away, near - 1, axis=1)[:, :near]
        out.append(np.take_along_axis(some, np.argsort(np.take_along_axis(away, some, axis=1), axis=1), axis=1))
    return np.concatenate(out).astype("<i4")


def _digested(sent):
    """Of each row its id and the digest of its vector, and cells and vector where a task sees the vector for the first time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            vectors = batch["embedding"].to_pylist()
            digests: list = [None] * len(vectors)
            dimensions, homes, cells, kept = ([None] * len(vectors) for _ in range(4))
            by_length: dict[int, list[int]] = {}
            for k, v in enumerate(vectors):
                if v is not None:
                    by_length.setdefault(len(v), []).append(k)
            for dimension, at in by_length.items():
                raw = _stack([vectors[k] for k in at]) + 0.0  # -0.0 becomes 0.0
                fresh = []
                for k, row in zip(at, raw):
                    data = row.tobytes()
                    digests[k] = hashlib.blake2b(data, digest_size=16).digest()
                    if digests[k] not in seen:
                        seen.add(digests[k])
                        fresh.append((k, data, row))
                if fresh:
                    centroids = sent.value.get(dimension)
                    units = unit(np.stack([row for _, _, row in fresh]))
                    mine = np.zeros((len(fresh), 1), "<i4") if centroids is None else cells_of(units, centroids)
                    for (k, data, _), c in zip(fresh, mine):
                        dimensions[k], homes[k], cells[k], kept[k] = dimension, int(c[0]), c.tobytes(), data
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(digests, pa.binary()), pa.array(dimensions, pa.int32()), pa.array(homes, pa.int32()), pa.array(cells, pa.binary()), pa.array(kept, pa.binary())],
                ["vec_id", "digest", "dimension", "home", "cells", "vector"])
    return run


def _asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The codes of the classes that ask in a cell, packed by batch: (dimension, cell, entries)."""
    for batch in batches:
        frame = batch.to_pandas()
        for dimension, rows in frame.groupby("dimension"):
            units = unit(np.frombuffer(b"".join(rows["vector"]), np.float64).reshape(-1, dimension))
            codes, factors = encode(units)
            cells = np.frombuffer(b"".join(rows["cells"]), "<i4").reshape(len(rows), -1)
            entry = _entry(codes.shape[1])
            of, cell = np.repeat(np.arange(len(rows)), cells.shape[1]), cells.ravel()
            order = np.argsort(cell, kind="stable")
            of, cell = of[order], cell[order]
            packed = np.zeros(len(of), entry)
            packed["num"], packed["home"] = rows["num"].to_numpy(np.int64)[of], cells[of, 0]
            packed["code"], packed["factors"] = codes[of], factors[of].astype("<f2")
            names, starts = np.unique(cell, return_index=True)
            ends = [*starts[1:], len(of)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(names), dimension, np.int32)), pa.array(names.astype(np.int32)), pa.array(np.diff([*starts, len(of)]).astype(np.int64)),
                pa.array([packed[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())], ["dimension", "cell", "many", "entries"])


def _entry(code_bytes: int) -> np.dtype:
    return np.dtype([("num", "<i8"), ("home", "<i4"), ("factors", "<f2", (ROTATIONS,)), ("code", "u1", (code_bytes,))])


def _candidates(threshold: float):
    """Of a block: the numbers of the classes at home, and of those that ask, that have a pair whose bound reaches the threshold."""
    def run(block: pd.DataFrame) -> pd.DataFrame:
        dimension = int(block["dimension"].iloc[0])
        home, asks = block[block["num"].notna()], block[block["num"].isna()]
        out = pd.DataFrame(columns=["dimension", "cell", "part", "with", "num", "asks"])
        if not len(home) or not len(asks):
            return out
        nums = home["num"].to_numpy(np.int64)
        turned = np.frombuffer(b"".join(home["vector"]), np.float32).reshape(-1, dimension) @ rotation(dimension).astype(np.float32)
        entries = np.frombuffer(b"".join(asks["entries"]), _entry(-(-ROTATIONS * dimension // 8)))
        at_home, asking = np.zeros(len(nums), bool), np.zeros(len(entries), bool)
        for a in range(0, len(entries), 8 * STRIPE):
            mine = entries[a:a + 8 * STRIPE]
            about, bound = estimate(turned, mine["code"], mine["factors"].astype(np.float64))
            i, j = np.nonzero(about + bound + ROUNDED >= threshold)
            other = nums[i] != mine["num"][j]
            at_home[i[other]] = True
            asking[a + j[other]] = True
        found = np.concatenate([nums[at_home], entries["num"][asking]])
        keys = {c: block[c].iloc[0] for c in ("dimension", "cell", "part", "with")}
        return pd.DataFrame({**keys, "num": found, "asks": np.arange(len(found)) >= at_home.sum()}, columns=out.columns)
    return run


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place that each place is linked to, at any distance."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(threshold: float):
    """Of the candidates of a block: rows (num, linked, copies of those linked), and (id, root) of a spanning forest."""
    def run(block: pd.DataFrame) -> pd.DataFrame:
        dimension, cell = int(block["dimension"].iloc[0]), int(block["cell"].iloc[0])
        block = block.sort_values(["asks", "num"], ignore_index=True)
        units = unit(np.frombuffer(b"".join(block["vector"]), np.float64).reshape(-1, dimension))
        codes, factors = encode(units)
        cells = np.frombuffer(b"".join(block["cells"]), "<i4").reshape(len(block), -1)
        nums, ids, copies = (block[c].to_numpy(np.int64) for c in ("num", "id", "copies"))
        asks = block["asks"].to_numpy(bool)
        left, right = np.flatnonzero(~asks), np.flatnonzero(asks)
        turned = units[left] @ rotation(dimension)
        linked, ends = np.zeros(len(block), np.int64), [(np.zeros(0, np.int64),) * 2]
        for at in range(0, len(right), STRIPE):
            mine = right[at:at + STRIPE]
            about, bound = estimate(turned, codes[mine], factors[mine])
            i, j = np.nonzero(about + bound + ROUNDED >= threshold)
            x, y = left[i], mine[j]
            # A pair that both homes find counts in the lesser of them, and within one home from the lesser number.
            elsewhere = cells[y, 0]
            also = (cells[x] == elsewhere[:, None]).any(axis=1)
            counts = np.where(elsewhere == cell, nums[x] < nums[y], ~also | (cell < elsewhere))
            x, y = x[counts], y[counts]
            true = np.einsum("ij,ij->i", units[x], units[y]) >= threshold
            x, y = x[true], y[true]
            np.add.at(linked, x, copies[y])
            np.add.at(linked, y, copies[x])
            ends.append((x, y))
        x, y = (np.concatenate(c) for c in zip(*ends))
        root = _forest(len(block), x, y)
        some, moved = np.flatnonzero(linked), np.flatnonzero(root != np.arange(len(block)))
        none = [None] * len(moved)
        return pd.DataFrame({
            "num": pd.array([*nums[some], *none], "Int64"), "linked": np.concatenate([linked[some], np.zeros(len(moved), np.int64)]),
            "u": pd.array([*[None] * len(some), *ids[moved]], "Int64"), "v": pd.array([*[None] * len(some), *ids[root[moved]]], "Int64")})
    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `vectors` (vec_id, embedding).

    Two vectors link if the home cell of one is among the cells of the other and their cosine is at least `threshold`.
    Vectors that are NULL, empty or zero or hold a NULL or a value that is not finite link with nothing, nor do vectors of
    different lengths, nor rows with a NULL vec_id, whose component is NULL. Rows that share a vec_id are one node of the
    graph, each with the links of its own vector. Equal vectors link without being compared. A cell of any size is compared
    part by part. An empty table gives no rows; other columns, labels included, are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    n = rows.count()
    sent = spark.sparkContext.broadcast(draw_centroids(rows.filter(good), n))
    told = settle(rows.select("vec_id", F.when(good, F.col("embedding")).alias("embedding")).mapInArrow(
        _digested(sent), "vec_id long, digest binary, dimension int, home int, cells binary, vector binary"))
    one = F.first(F.when(F.col("vector").isNotNull(), F.struct("vec_id", "dimension", "home", "cells", "vector")), ignorenulls=True)
    grouped = told.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), one.alias("one"))
    classes = settle(grouped.select(
        F.monotonically_increasing_id().alias("num"), "digest", "copies", "least", F.col("one.vec_id").alias("id"), "one.dimension", "one.home", "one.cells", "one.vector"))

    asking = settle(classes.select("num", "dimension", "cells", "vector").mapInArrow(_asking, "dimension int, cell int, many long, entries binary"))
    at_home = classes.select("num", "dimension", F.col("home").alias("cell"), "vector")
    sizes = at_home.groupBy("dimension", "cell").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    asked = asking.groupBy("dimension", "cell").agg(F.ceil(F.sum("many") / (ASKING * PART)).cast("int").alias("asked"))
    # One row per cell, of which there are at most `CENTROIDS` per dimension.
    parts = F.broadcast(sizes.join(asked, ["dimension", "cell"]))
    homes = at_home.join(parts, ["dimension", "cell"]).select(
        "dimension", "cell", F.pmod(F.xxhash64("num"), F.col("parts")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("asked") - 1)).alias("with"),
        "num", F.lit(None).cast("binary").alias("entries"), "vector")
    guests = asking.join(parts, ["dimension", "cell"]).select(
        "dimension", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("entries"), F.col("asked")).cast("int").alias("with"),
        F.lit(None).cast("long").alias("num"), "entries", F.lit(None).cast("binary").alias("vector"))
    halved = homes.mapInArrow(_single, homes.schema)
    block = ["dimension", "cell", "part", "with"]
    candidates = settle(halved.union(guests).groupBy(*block).applyInPandas(_candidates(threshold), "dimension int, cell int, part int, with int, num long, asks boolean"))
    whole = candidates.join(classes.select("num", "id", "copies", "cells", "vector"), "num")
    found = settle(whole.groupBy(*block).applyInPandas(_links(threshold), "num long, linked long, u long, v long"))

    links = found.filter("num IS NOT NULL").groupBy("num").agg(F.sum("linked").alias("linked"))
    components = connected_components(found.filter("u IS NOT NULL").select("u", "v"))
    named = classes.select("num", "digest", "copies", "least", "id").join(links, "num", "left").join(components, F.col("id") == F.col("node"), "left").select(
        "digest", "copies", "least", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("label"))
    named = settle(named)
    least = named.groupBy(F.col("label").alias("of")).agg(F.min("least").alias("component_id"))
    groups = settle(named.join(least, F.col("label") == F.col("of")).select("digest", "copies", "n_links", "component_id"))
    linked = with_group(told.filter("digest IS NOT NULL").select("vec_id", "digest"), groups, "digest", "copies", n).select("vec_id", "n_links", "component_id")
    alone = told.filter("digest IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors in single precision, of length 1."""
    for batch in batches:
        vectors = [unit(np.frombuffer(v, np.float64)[None, :]).astype(np.float32).tobytes() for v in batch["vector"].to_pylist()]
        yield batch.set_column(batch.schema.get_field_index("vector"), "vector", pa.array(vectors, pa.binary()))
