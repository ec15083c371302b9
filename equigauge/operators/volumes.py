"""Volumes as voxel tables `(patient, x, y, z, value)`: overlap, spacing, slices, orientation, normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equigauge.functions.ratios import ratio
from equigauge.operators.running import scan
from equigauge.session import attach, settle

# Class index of each spine level.
LEVEL_INDEX = {
    "C1": 41, "C2": 40, "C3": 39, "C4": 38, "C5": 37, "C6": 36, "C7": 35,
    "T1": 34, "T2": 33, "T3": 32, "T4": 31, "T5": 30, "T6": 29, "T7": 28, "T8": 27, "T9": 26, "T10": 25, "T11": 24,
    "T12": 23,
    "L1": 22, "L2": 21, "L3": 20, "L4": 19, "L5": 18,
    "SACRUM": 92,
}
SPINE_CLASSES = tuple(range(18, 42)) + (92,)


def overlap_scores(voxels: DataFrame, patient: str, pred: str, truth: str, prob: str) -> DataFrame:
    """Volume, mean confidence inside the mask, Dice and Jaccard per patient; 0 when empty. Masks are 0/1.

    Sums only, so a patient with very many voxels is combined before the shuffle.
    """
    p, g = F.col(pred), F.col(truth)
    sums = voxels.groupBy(patient).agg(
        F.sum(p * g).alias("both"), F.sum(p).alias("vol"), F.sum(g).alias("truth_vol"),
        F.avg(F.when(p == 1, F.col(prob))).alias("mean_prob"),
    )
    total = F.col("vol") + F.col("truth_vol")
    return sums.select(
        patient, F.col("vol").cast("bigint").alias("volume"), F.coalesce("mean_prob", F.lit(0.0)).alias("confidence"),
        ratio(2 * F.col("both"), total, 0.0).alias("dice"), ratio("both", total - F.col("both"), 0.0).alias("jaccard"),
    )


def _label_rule(text: Column) -> Column:
    rule = None
    for name, index in LEVEL_INDEX.items():
        test = F.regexp_like(text, F.lit(rf"\b{name}\b"))
        rule = F.when(test, F.lit(index)) if rule is None else rule.when(test, F.lit(index))
    return rule


def label_index(label: Column | str) -> Column:
    """Class index of the first level that occurs in the label as a whole word, else NULL."""
    return _label_rule(F.upper(F.col(label) if isinstance(label, str) else label))


def annotated_classes(labels: DataFrame, patient: str, label: str) -> DataFrame:
    """Sorted distinct class indices per patient. The list is no longer than the dictionary."""
    found = labels.select(patient, label_index(label).alias("i")).filter(F.col("i").isNotNull())
    return found.groupBy(patient).agg(F.array_sort(F.collect_set("i")).alias("classes"))


def spine_mask(predicted_class: Column | str, classes: Sequence[int] | Column | None = None) -> Column:
    """1 inside the chosen classes; an empty or missing choice means the whole spine."""
    c = F.col(predicted_class) if isinstance(predicted_class, str) else predicted_class
    default = F.array(*[F.lit(i) for i in SPINE_CLASSES])
    if classes is None:
        return c.isin(*SPINE_CLASSES).cast("int")
    if isinstance(classes, Column):
        chosen = F.when(F.size(F.coalesce(classes, F.array().cast("array<int>"))) > 0, classes).otherwise(default)
        return F.array_contains(chosen, c).cast("int")
    return c.isin(*classes).cast("int") if classes else c.isin(*SPINE_CLASSES).cast("int")


def gaps(rows: DataFrame, series: str, at: str, pieces: int | None = None) -> DataFrame:
    """Distinct positions of each series with their multiplicity and the gap to the previous position.

    Equal positions are counted before the shuffle, so neither a hot position nor a long series gathers in a task.
    """
    known = rows.filter(F.col(series).isNotNull() & F.col(at).isNotNull())
    counted = known.groupBy(series, at).agg(F.count(F.lit(1)).alias("multiplicity"))
    placed = scan(counted, [series], [at], previous={"_before": at}, pieces=pieces)
    return placed.select(series, at, "multiplicity", (F.col(at) - F.col("_before")).alias("gap"))


def spacing_stats(rows: DataFrame, series: str, at: str, pieces: int | None = None) -> DataFrame:
    """Mean, population deviation, least and largest gap per series, and flags for uneven or repeated positions.

    A position that occurs c times adds c - 1 gaps of 0.
    """
    per_position = gaps(rows, series, at, pieces)
    repeats = F.col("multiplicity") - 1
    sums = per_position.groupBy(series).agg(
        F.sum("multiplicity").alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"),
        F.count("gap").alias("_gaps"), F.avg(F.col("gap").cast("double")).alias("_center"), F.var_pop(F.col("gap").cast("double")).alias("_spread"),
        F.min("gap").alias("_least"), F.max("gap").alias("_most"), F.max(repeats).alias("_repeats"),
    ).filter(F.col("n") > 1)
    mean = (F.col("last_at") - F.col("first_at")).cast("double") / (F.col("n") - 1)
    # The gaps of 0 between repeats join the others in closed form, each part about the common mean.
    off = F.col("_center") - mean
    among = F.col("_gaps") * F.coalesce(F.col("_spread") + off * off, F.lit(0.0))
    zeros = F.col("n") - 1 - F.col("_gaps")
    spread = F.sqrt((among + zeros * mean * mean) / (F.col("n") - 1))
    least = F.when(F.col("_repeats") > 0, F.lit(0).cast("double")).otherwise(F.col("_least").cast("double"))
    return sums.select(
        series, "n", mean.alias("mean_gap"), spread.alias("std_gap"), least.alias("min_gap"),
        F.coalesce(F.col("_most").cast("double"), F.lit(0.0)).alias("max_gap"),
    ).withColumn("uneven", F.col("std_gap") > 0.1).withColumn("repeated", F.col("min_gap") < 0.01)


def mean_step(rows: DataFrame, series: str, at: str, thickness: str | None = None) -> DataFrame:
    """Average step from first and last position; for a single row the header thickness, and never 0."""
    header = F.coalesce(F.min_by(thickness, at), F.lit(1.0)) if thickness else F.lit(1.0)
    one = rows.groupBy(series).agg(
        F.count(F.lit(1)).alias("n"),
        F.abs(F.max(at) - F.min(at)).cast("double").alias("reach"), header.cast("double").alias("header"),
    )
    step = F.when(F.col("n") > 1, ratio("reach", F.col("n") - 1)).otherwise(F.col("header"))
    return one.select(series, "n", F.when((step == 0) | step.isNull(), F.lit(1.0)).otherwise(step).alias("step"))


def slice_index(rows: DataFrame, series: str, at: str, tie: str, pieces: int | None = None) -> DataFrame:
    """Zero-based rank of each row in its series by position (unreadable counts as 0), ties by `tie`.

    Ranges of the order are numbered by themselves and shifted by the rows of the series in earlier ones; `tie` splits a
    position that very many rows share.
    """
    named = rows.withColumns({"_at": F.coalesce(F.col(at).cast("double"), F.lit(0.0)), "_one": F.lit(1).cast("long")})
    ranked = scan(named, [series], ["_at", tie], sums={"_rank": "_one"}, pieces=pieces)
    return ranked.select(*rows.columns, (F.col("_rank") - 1).cast("bigint").alias("slice"))


def mask_to_slices(mask: DataFrame, slices: DataFrame, uid: str, series: str) -> DataFrame:
    """Voxel mask from mask pixels tied to slices by a source UID: overlaps are OR-ed, unmatched frames drop out."""
    placed = mask.join(slices.select(uid, series, "slice"), uid)
    return placed.groupBy(series, "x", "y", F.col("slice").alias("z")).agg(F.max("mask").alias("mask"))


def first_file(files: DataFrame, patient: str, path: str) -> DataFrame:
    return files.groupBy(patient).agg(F.min(path).alias("first_path"), F.count(F.lit(1)).alias("n_files"))


#: Voxels of a line in one word of a packed mask.
WORD = 64


def packed(voxels: DataFrame, patient: str, masks: Mapping[str, Column]) -> DataFrame:
    """Masks as bits: a row per (patient, z, y, word) with one 64-bit number per mask, and the last x and y seen there.

    One aggregate for all masks; bits of a line combine before the shuffle. Any other operation on them is a bitwise
    expression on a sixty-fourth of the rows.
    """
    x = F.col("x").cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(x, F.lit(WORD)))
    line = [F.col(patient), F.col("z"), F.col("y").cast("int").alias("y"), F.floor(x / WORD).cast("int").alias("word")]
    return voxels.groupBy(*line).agg(
        F.max(x).alias("last_x"), *(F.coalesce(F.bit_or(F.when(test, bit)), F.lit(0).cast("long")).alias(name) for name, test in masks.items())
    )


def _mirrored(lines: DataFrame, name: str) -> DataFrame:
    """Packed lines read from the other end: bit x of a line becomes bit width - 1 - x. A word falls on two words at most."""
    turned = F.conv(F.reverse(F.lpad(F.bin(name), WORD, "0")), 2, -10).cast("long")
    base = F.col("width") - (F.col("word") + 1) * WORD
    shift = F.pmod(base, F.lit(WORD)).cast("int")
    low = F.call_function("shiftleft", F.col("_turned"), shift)
    high = F.when(shift > 0, F.call_function("shiftrightunsigned", F.col("_turned"), F.lit(WORD) - shift)).otherwise(F.lit(0).cast("long"))
    first = F.floor(base / WORD).cast("int")
    halves = F.explode(F.array(F.struct(first.alias("word"), low.alias(name)), F.struct((first + 1).alias("word"), high.alias(name)))).alias("half")
    keys = [c for c in lines.columns if c not in ("word", name)]
    return lines.withColumn("_turned", turned).select(*keys, halves).select(*keys, "half.*").filter(F.col(name) != 0).groupBy(
        *keys, "word").agg(F.bit_or(name).alias(name))


# The orientations in the order they are tried, as (number, name, flip x, flip y).
FLIPS = ((0, "original", False, False), (1, "flip_y", False, True), (2, "flip_x", True, False), (3, "flip_xy", True, True))


def best_flip(dense: DataFrame, mask: DataFrame, patient: str, extent: DataFrame, above: float = 200.0) -> DataFrame:
    """For each patient the flip of the mask (0 or 1) that lies most on dense tissue; the first one wins ties.

    `extent` has the image size per patient as `width` and `height`. A patient with an empty mask scores 0.
    """
    none = F.lit(None)
    both = dense.select(patient, "x", "y", "z", F.col("value").cast("double").alias("value"), none.cast("double").alias("mask")).union(
        mask.select(patient, "x", "y", "z", none.cast("double"), F.col("mask").cast("double")))
    return flips_of(packed(both, patient, {"bone": F.col("value") > above, "seg": F.col("mask") > 0}), patient, extent)


def flips_of(lines: DataFrame, patient: str, extent: DataFrame | None = None) -> DataFrame:
    """The same of packed `bone` and `seg`. Without an extent the image ends at the last voxels that were packed.

    The four flips are moves of lines and mirrored bits; a flip's hits are the bits of `bone AND seg`.
    """
    lines = settle(lines)
    if extent is None:
        extent = lines.groupBy(patient).agg((F.max("last_x") + 1).alias("width"), (F.max("y") + 1).alias("height"))
    sized = lines.filter("seg <> 0").select(patient, "z", "y", "word", "seg").join(extent, patient)
    straight = sized.select(patient, "z", "y", "height", "word", "seg")
    turned = _mirrored(sized.select(patient, "z", "y", "height", "width", "word", "seg"), "seg").select(patient, "z", "y", "height", "word", "seg")
    moved = straight.withColumn("fx", F.lit(False)).union(turned.withColumn("fx", F.lit(True)))
    variants = F.filter(F.array(*[
        F.struct(F.lit(number).alias("flip_no"), F.lit(name).alias("flip"), F.lit(fx).alias("of"),
                 (F.col("height") - 1 - F.col("y") if fy else F.col("y")).cast("int").alias("y"))
        for number, name, fx, fy in FLIPS
    ]), lambda v: v["of"] == F.col("fx"))
    tried = moved.select(patient, "z", "word", "seg", F.explode(variants).alias("v")).select(
        patient, "z", "word", "seg", F.col("v.flip_no").alias("flip_no"), F.col("v.flip").alias("flip"), F.col("v.y").alias("y"))
    bone = lines.filter("bone <> 0").select(patient, "z", "y", "word", "bone")
    hits = F.bit_count(F.col("seg").bitwiseAND(F.coalesce("bone", F.lit(0).cast("long"))))
    scores = tried.join(bone, [patient, "z", "y", "word"], "left").groupBy(patient, "flip_no", "flip").agg(
        ratio(F.sum(hits), F.sum(F.bit_count("seg")), 0.0).alias("score")
    )
    best = scores.groupBy(patient).agg(
        F.max_by(F.struct("flip_no", "flip", "score"), F.struct("score", -F.col("flip_no"))).alias("b")
    )
    first = FLIPS[0]
    chosen = extent.select(patient).join(best, patient, "left").select(
        patient,
        F.coalesce("b.flip_no", F.lit(first[0])).alias("flip_no"), F.coalesce("b.flip", F.lit(first[1])).alias("flip"),
        F.coalesce("b.score", F.lit(0.0)).alias("score"),
    )
    return chosen.withColumn("low_overlap", F.col("score") < 0.3)


def squared_difference(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Mean squared difference of two arrays over the coordinates they share."""
    both = a.select(*keys, F.col(value).alias("_a")).join(b.select(*keys, F.col(value).alias("_b")), list(keys))
    d = F.col("_a").cast("double") - F.col("_b").cast("double")
    return both.agg(F.avg(d * d).alias("mse"), F.count(F.lit(1)).alias("n"))


def normalized(voxels: DataFrame, patient: str, value: str, low: float = -1.0, high: float = 1.0) -> DataFrame:
    """z-score of the nonzero values of each volume, then stretched to [low, high].

    The limits after the z-score follow from the same sums, so one aggregate and one join do; no window holds a volume.
    """
    v = F.col(value).cast("double")
    lit = F.when(v != 0, v)
    stats = voxels.groupBy(patient).agg(
        F.avg(lit).alias("_mean"), F.stddev_pop(lit).alias("_std"), F.min(lit).alias("_min"), F.max(lit).alias("_max"),
        F.count_if(v == 0).alias("_zeros"),
    )
    std = F.when(F.col("_std") == 0, F.lit(1.0)).otherwise(F.col("_std"))
    z_lo, z_hi = (F.col("_min") - F.col("_mean")) / std, (F.col("_max") - F.col("_mean")) / std
    ends = stats.select(
        patient, "_mean", std.alias("_std"),
        F.coalesce(F.when(F.col("_zeros") > 0, F.least(z_lo, F.lit(0.0))).otherwise(z_lo), F.lit(0.0)).alias("_lo"),
        F.coalesce(F.when(F.col("_zeros") > 0, F.greatest(z_hi, F.lit(0.0))).otherwise(z_hi), F.lit(0.0)).alias("_hi"),
    )
    z = F.when(v != 0, (v - F.col("_mean")) / F.col("_std")).otherwise(0.0)
    span = F.col("_hi") - F.col("_lo")
    scaled = F.when(span == 0, z * low).otherwise((z - F.col("_lo")) / span * (high - low) + low)
    return attach(voxels, ends, [patient]).select(*voxels.columns, scaled.alias("normalized"))
