"""Repeated passages by longest-previous-factor arrays, over suffixes dealt out by what they begin with.

A suffix matters only by its first `DEPTH` bytes. Each such window names its least hashed 20-gram, so equal windows name
the same one, wherever they stand, and neighbouring windows mostly share it: a run of windows with one name travels as
one string. Names that occur once in all documents are left behind, since their windows have no second place. The runs of
a name meet in one bucket, equal strings combined on the way. There the windows are put in suffix order; for each the
previous and next suffix in that order that start earlier in the corpus (PSV, NSV) are found, and if either agrees on
the whole depth, the window's longest previous factor is at least that long: it is a later copy, and its bytes go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.llm.batches import BUCKET_KEYS, NO_ID, in_order, looked_up, received, reduced, repeated_keys, text_batches

#: Length of a repeated string in bytes, of the grams that name a window, and how many grams a window has.
DEPTH = 100
GRAM = 20
GRAMS = DEPTH - GRAM + 1
#: Window starts worked on at once; their place within takes this many bits below the gram's hash.
STEP, PLACE_BITS = 1 << 18, np.uint64(19)
#: Names of more windows' runs than this are dealt by window instead of by name.
BUSY = 8_192
#: Bytes of text per bucket, and windows sorted at once.
BUCKET_BYTES = 8 << 20
SORTED = 100_000
RUN = np.dtype([("key", "<u8"), ("id", "<i8"), ("start", "<i8"), ("row", "<i4"), ("length", "<i4"), ("inner", "?")])
MARK = np.dtype([("row", "<i8"), ("first", "<i8"), ("last", "<i8")])


def _gram_hashes(part: np.ndarray) -> np.ndarray:
    words = np.ndarray((len(part) - 7,), "<u8", np.ascontiguousarray(part), strides=(1,)).copy()
    h = words[:-12] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h += words[8:-4]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h += words[12:]
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def _least(part: np.ndarray) -> np.ndarray:
    """For every window of `part`: hash of its least gram above the gram's place in `part`, the first of equal ones."""
    low = (_gram_hashes(part) >> PLACE_BITS << PLACE_BITS) | np.arange(len(part) - GRAM + 1, dtype=np.uint64)
    width = 1
    while 2 * width <= GRAMS:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = GRAMS - width
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def window_runs(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows of one document and one name: first start, last start, name, row, distinct places of the gram."""
    for at in range(0, max(0, len(data) - DEPTH + 1), STEP):
        part = data[at:at + STEP + DEPTH - 1]
        low = _least(part)
        starts = np.arange(at, at + len(low))
        row = np.searchsorted(bounds, starts, "right") - 1
        inside = starts + DEPTH <= bounds[row + 1]
        starts, row, low = starts[inside], row[inside], low[inside]
        if not len(starts):
            continue
        name = low >> PLACE_BITS
        new = np.concatenate([[True], (name[1:] != name[:-1]) | (row[1:] != row[:-1])])
        moved = np.concatenate([[True], low[1:] != low[:-1]]) | new
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts)) - 1
        yield starts[first], starts[last], name[first], row[first], np.add.reduceat(moved.astype(np.int64), first)


def _all_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    parts = list(window_runs(data, bounds))
    return tuple(map(np.concatenate, zip(*parts))) if parts else tuple(np.zeros(0, np.int64) for _ in range(5))


def _laid_out(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    sizes = batch["bytes"].map(len).to_numpy(np.int64)
    return np.frombuffer(b"".join(batch["bytes"]), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def names_of(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    _, _, name, _, places = _all_runs(*_laid_out(batch))
    distinct, at = np.unique(name.astype(np.uint64), return_inverse=True)
    return distinct, np.bincount(at, weights=places, minlength=len(distinct)).astype(np.int64)


def _later_copies(run: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Marks for whole runs given by place in `run`."""
    out = np.zeros(len(later), MARK)
    out["row"], out["first"] = run["row"][later], run["start"][later]
    out["last"] = out["first"] + run["length"][later] - DEPTH
    return out


def _runs_out(buckets: int, key_buckets: int):
    """Of a batch: its runs of repeated names by bucket; runs that repeat an earlier one of the batch are marked at once."""
    def run(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "batch", "runs", "data"]
        if not len(batch) or not len(answers):
            return pd.DataFrame(columns=columns)
        number, batch = batch["batch"].iloc[0], in_order(batch)
        data, bounds = _laid_out(batch)
        first, last, name, row, places = _all_runs(data, bounds)
        total = looked_up(reduced(name, key_buckets), *received(answers))
        busy = total > BUSY
        single = np.flatnonzero(busy)
        spread = np.repeat(single, last[single] - first[single] + 1)
        step = np.arange(len(spread)) - np.repeat(np.cumsum(last[single] - first[single] + 1) - (last[single] - first[single] + 1), last[single] - first[single] + 1)
        usual = np.flatnonzero((total > 1) & ~busy)
        of = np.concatenate([usual, spread])
        start = np.concatenate([first[usual], first[spread] + step])
        length = np.concatenate([last[usual] - first[usual], np.zeros(len(spread), np.int64)]) + DEPTH
        order = np.argsort(start, kind="stable")
        of, start, length = of[order], start[order], length[order]
        runs = np.zeros(len(of), RUN)
        runs["key"], runs["row"], runs["length"] = name[of], row[of], length
        runs["id"] = batch["id"].to_numpy(np.int64)[row[of]]
        runs["start"] = start - bounds[row[of]]
        runs["inner"] = (places[of] > 1) & (length > DEPTH)
        text, seen, keep, again = data.tobytes(), set(), [], []
        for k, (a, n) in enumerate(zip(start.tolist(), length.tolist())):
            piece = text[a:a + n]
            if piece in seen:
                again.append(k)
            else:
                seen.add(piece)
                keep.append(k)
        keep, again = np.array(keep, np.int64), np.array(again, np.int64)
        at = runs["key"] % np.uint64(buckets)
        for k in np.flatnonzero(busy[of]).tolist():
            at[k] = hash_of(text[start[k]:start[k] + DEPTH]) % buckets
        at = at.astype(np.int64)
        by_bucket = keep[np.argsort(at[keep], kind="stable")]
        names, starts = np.unique(at[by_bucket], return_index=True)
        out = []
        for bucket, a, b in zip(names, starts, [*starts[1:], len(by_bucket)]):
            mine = by_bucket[a:b]
            out.append((bucket, number, runs[mine].tobytes(), b"".join(text[s:s + n] for s, n in zip(start[mine].tolist(), length[mine].tolist()))))
        if len(again):
            out.append((-1 - number, number, _later_copies(runs, again).tobytes(), b""))
        return pd.DataFrame(out, columns=columns)
    return run


def hash_of(piece: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little")


def earlier_factor(position: np.ndarray, agrees: np.ndarray) -> np.ndarray:
    """Which suffixes, given in suffix order, have a longest previous factor of at least the depth.

    `agrees[i]`: suffix i agrees with the one before it in suffix order on the whole depth. Pointers jump over suffixes
    that start later until they reach the previous (next) smaller position or a suffix that does not agree.
    """
    n = len(position)
    found = np.zeros(n, bool)
    for back in (True, False):
        place = position if back else position[::-1]
        same = agrees if back else np.concatenate([[False], agrees[1:][::-1]])
        to, reach = np.arange(n) - 1, same.copy()
        while True:
            on = np.flatnonzero(reach & (to >= 0))
            on = on[place[to[on]] > place[on]]
            if not len(on):
                break
            over = to[on]
            reach[on] &= reach[over]
            to[on] = to[over]
        hit = reach & (to >= 0)
        found |= hit if back else hit[::-1]
    return found


def _window_marks(runs: np.ndarray, data: bytes, starts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Marks of the windows of the chosen runs, which are in corpus order, that repeat an earlier one of them."""
    counts = (runs["length"][chosen] - DEPTH + 1).astype(np.int64)
    of = np.repeat(chosen, counts)
    step = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = np.frombuffer(data, np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(flat, DEPTH)[starts[of] + step]
    suffixes = np.ascontiguousarray(windows).view(f"V{DEPTH}").ravel()
    order = np.argsort(suffixes, kind="stable")
    ordered = windows[order]
    agrees = np.concatenate([[False], (ordered[1:] == ordered[:-1]).all(axis=1)])
    later = np.zeros(len(order), bool)
    later[order] = earlier_factor(order, agrees)
    hit = np.flatnonzero(later)
    if not len(hit):
        return np.zeros(0, MARK)
    begins = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (of[hit[1:]] != of[hit[:-1]])])
    a = hit[begins]
    b = hit[np.append(np.flatnonzero(begins)[1:], len(hit)) - 1]
    out = np.zeros(len(a), MARK)
    out["row"], out["first"], out["last"] = runs["row"][of[a]], runs["start"][of[a]] + step[a], runs["start"][of[b]] + step[b]
    return np.rec.fromarrays([runs["batch"][of[a]], out], names="batch,mark")


def _marked(bucket: pd.DataFrame) -> pd.DataFrame:
    """Marks per batch from the runs of one bucket."""
    out: list[tuple] = []
    if bucket["bucket"].iloc[0] < 0:
        return pd.DataFrame({"batch": bucket["batch"], "marks": bucket["runs"]})
    parts = [np.frombuffer(x, RUN) for x in bucket["runs"]]
    runs = np.zeros(sum(map(len, parts)), np.dtype([*RUN.descr, ("batch", "<i4")]))
    for name in RUN.names:
        runs[name] = np.concatenate([x[name] for x in parts])
    runs["batch"] = np.repeat(bucket["batch"].to_numpy(), list(map(len, parts)))
    data = b"".join(bucket["data"])
    starts = np.cumsum(runs["length"], dtype=np.int64) - runs["length"]
    order = np.lexsort((runs["start"], runs["row"], runs["id"]))
    runs, starts = runs[order], starts[order]
    seen, again, first = set(), [], []
    for k, (a, n) in enumerate(zip(starts.tolist(), runs["length"].tolist())):
        piece = data[a:a + n]
        if piece in seen:
            again.append(k)
        else:
            seen.add(piece)
            first.append(k)
    del seen
    again, first = np.array(again, np.int64), np.array(first, np.int64)
    marks = [(runs["batch"][again], _later_copies(runs, again))]
    _, name, many = np.unique(runs["key"][first], return_inverse=True, return_counts=True)
    long = np.bincount(name, weights=runs["length"][first] > DEPTH) > 0
    inner = np.bincount(name, weights=runs["inner"][first]) > 0
    chosen = first[((many > 1) & long | inner)[name]]
    chosen = chosen[np.argsort(runs["key"][chosen], kind="stable")]
    keys = runs["key"][chosen]
    ends = np.flatnonzero(np.append(keys[1:] != keys[:-1], True)) + 1 if len(chosen) else []
    windows = np.cumsum(runs["length"][chosen].astype(np.int64) - DEPTH + 1)
    begin = done = 0
    for k, end in enumerate(ends):
        if k + 1 == len(ends) or windows[ends[k + 1] - 1] - done > SORTED:
            found = _window_marks(runs, data, starts, chosen[begin:end])
            if len(found):
                marks.append((found["batch"], found["mark"]))
            begin, done = end, windows[end - 1]
    batches = np.concatenate([b for b, _ in marks])
    every = np.concatenate([m for _, m in marks])
    order = np.argsort(batches, kind="stable")
    names, at = np.unique(batches[order], return_index=True)
    for batch, a, b in zip(names, at, [*at[1:], len(order)]):
        out.append((batch, every[order[a:b]].tobytes()))
    return pd.DataFrame(out, columns=["batch", "marks"])


def _cut_out(batch: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
    batch = in_order(batch)
    every = np.frombuffer(b"".join(marks["marks"]), MARK)
    every = every[np.argsort(every["row"], kind="stable")]
    bounds = np.searchsorted(every["row"], np.arange(len(batch) + 1))
    out = []
    for k, (doc, text) in enumerate(zip(batch["id"], batch["bytes"])):
        mine = every[bounds[k]:bounds[k + 1]]
        kept, removed, spans = text, 0, 0
        if len(mine):
            edge = np.zeros(len(text) + 1, np.int64)
            np.add.at(edge, mine["first"], 1)
            np.add.at(edge, mine["last"] + DEPTH, -1)
            gone = np.cumsum(edge)[:-1] > 0
            removed = int(gone.sum())
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        out.append((doc, len(text), removed, spans, kept, hashlib.sha256(kept).hexdigest()))
    return pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])


def _cut_out_figures(batch: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
    return _cut_out(batch, marks).drop(columns="kept")


def remove_repeats(docs: DataFrame, texts: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (UTF-8, may cut a character; only if `texts`), kept_sha256 per row.

    A byte of `docs` (doc_id, text) goes if some string of `DEPTH` bytes that covers it also starts earlier: in a lesser
    doc_id, or earlier in the same text. Strings are judged on the input and may overlap; matches never cross documents.
    NULL and shorter texts keep all they have. NULL doc_ids come first. Rows that share a doc_id are texts of their own,
    in the order of their bytes; of equal rows any one counts as first. An empty table gives no rows; other columns are
    ignored.
    """
    batches, total = text_batches(docs)
    key_buckets = total // (GRAMS // 2) // BUCKET_KEYS + 1
    repeats = repeated_keys(batches, names_of, key_buckets)
    runs = batches.groupBy("batch").cogroup(repeats.groupBy("batch")).applyInPandas(
        _runs_out(total // BUCKET_BYTES + 1, key_buckets), "bucket int, batch int, runs binary, data binary")
    marks = runs.groupBy("bucket").applyInPandas(_marked, "batch int, marks binary")
    figures = "n_bytes long, n_removed long, n_spans long"
    done = batches.groupBy("batch").cogroup(marks.groupBy("batch")).applyInPandas(
        _cut_out if texts else _cut_out_figures, f"id long, {figures}, {'kept binary, ' if texts else ''}kept_sha256 string")
    return done.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), *done.columns[1:])
