"""Boosting in one run, stopped by patience (M1).

The features are cut into bins once and lie in blocks of rows (a byte for each
feature; a block is a row of a DataFrame) that stay on the executors with their
margins.  A level of a tree is one pass: each task adds up the gradients of its
blocks by node, feature and bin, one task adds up these sums, and the driver
chooses the splits from their total.  Of two new nodes only the smaller is
summed, the other is what remains of the one above.  The pass that adds a
finished tree to the margins also gives the loss of the stopping side and the
sums of the next tree's root, so a tree of depth d takes d passes and the run is
looked at after each tree.  What reaches the driver grows with nodes and bins,
and by a number for each block, never with the rows.

A large frame is not sent through its tasks for each pass: one job with a task
for each core (a barrier stage) holds the blocks through ``RELIABLE`` trees.
Its tasks leave their sums as files in the shared folder and read those of the
others, so each knows the totals and chooses the same splits; the trees are
those of the passes.  The next job starts from the trees so far.

The run ends when ``patience`` trees in a row brought no lower loss, and the
model is the trees up to the lowest: nothing is fitted twice.

Weights (the first tree's is 1, that of later ones the learning rate), the
gradients of the logistic loss, the choice of splits by variance and the means
as leaf values are those of Spark's classifier, so the result is one of its
models.  Gradients are whole multiples of 1/``UNIT``, whose sums are exact in
any order; rows are drawn by block.  So a tree depends on the rows and their
layout, the seed and the trees before it only, never on the tasks or on where
the run ends.
"""

from __future__ import annotations

import json
import math
import pickle
import sys
import time
import uuid
import zlib
from dataclasses import dataclass, field
from types import SimpleNamespace

import numpy as np
from pyarrow.fs import FileSystem, FileType
from pyspark import BarrierTaskContext, StorageLevel, TaskContext, cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from ..config import BoostParams
from ..session import checkpoint_dir, default_parallelism

OPENING = 16  # trees fitted before the losses may end the run
CHUNK = 1  # trees between two later looks
RELIABLE = 50  # trees after which the blocks are written to the shared folder, or of a job that holds them
MAX_BINS = 128  # of every fit, whatever the data; wider categories become rates
BLOCK = 1 << 16  # rows of a block
UNIT = 1 << 16  # gradients (4 at most) are counted in 1/UNIT
HOLD = 1 << 12  # fewer rows to fit on go through passes, which ask for no tasks at the same time
HELD = 1 << 23  # rows that a task holds at most (about 60 bytes each); more go through passes, which may spill
CHUNK_ROWS = 1 << 18  # rows that a task adds up together
JOINT = 1024  # bins of features that are counted together
_ONE = float(1 << 36)  # a row, above the sum of a block's gradients (2**34 at most)
_LEAST_GAIN = 1e-3  # per row, in 1/UNIT squared: what rounding can't bring about


# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Boosted:
    model: GBTClassificationModel
    losses: list = field(default_factory=list)  # of the stopping side, after each fitted tree

    @property
    def fitted(self) -> int:
        return len(self.losses)


def stopping_point(losses: list[float], patience: int) -> tuple[int, bool]:
    """Trees up to the lowest loss, and whether ``patience`` more trees brought no lower one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        if i - best >= patience:
            return best + 1, True
    return best + 1, False


# ---------------------------------------------------------------------------
# bins and blocks
# ---------------------------------------------------------------------------
@dataclass
class Bins:
    """How many categories a feature has (0: a number), and where a number's bins end."""

    arity: list
    ends: list

    @property
    def widths(self) -> list:
        return [n or len(e) + 1 for n, e in zip(self.arity, self.ends)]


def bins_of(values: np.ndarray, arity: list, ends: list) -> np.ndarray:
    out = np.empty(values.shape, np.uint8)
    for f, (n, upper) in enumerate(zip(arity, ends)):
        column = values[:, f]
        if n and len(column) and not ((column >= 0) & (column < n) & (column == np.floor(column))).all():
            raise ValueError(f"feature {f} has a value that is none of its {n} categories")
        out[:, f] = column if n else np.searchsorted(upper, column)
    return out


def find_bins(feats: DataFrame, width: int, max_bins: int) -> Bins:
    """Categories by the column's attributes, bins of numbers by their quantiles over all rows."""
    arity = [0] * width
    for kind, attributes in feats.schema["features"].metadata.get("ml_attr", {}).get("attrs", {}).items():
        for a in attributes if kind in ("nominal", "binary") else ():
            arity[a["idx"]] = int(a.get("num_vals") or len(a.get("vals", ())) or 2)
    if max(arity) > max_bins or max_bins > 256:
        raise ValueError(f"a feature has {max(arity)} categories, more than {max_bins} bins (256 at most)")
    numbers = [f for f in range(width) if not arity[f]]
    ends = [np.empty(0)] * width
    if numbers:
        array = vector_to_array("features")
        columns = feats.select(*[array[f].alias(f"n{f}") for f in numbers])
        found = columns.approxQuantile(columns.columns, [i / max_bins for i in range(max_bins + 1)], 0.1 / max_bins)
        for f, q in zip(numbers, found):
            ends[f] = np.unique(q)[:-1][-(max_bins - 1):]
    return Bins(arity, ends)


def _packer(bins: Bins):
    """Rows as blocks: (part and place of the block, bins, labels as -1 or 1, the two flags)."""

    def pack(batches):
        import pyarrow as pa

        def block(parts, place):
            made = [np.concatenate(p).tobytes() for p in zip(*parts)]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in (part, place, *made)], ["part", "place", "bins", "y", "fits", "stops"])

        part = TaskContext.get().partitionId()
        parts, held, place = [], 0, 0
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            fits, stops = (batch.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (2, 3))
            rows = [bins_of(x, arity, ends), (2 * y - 1).astype(np.int8), fits, stops]
            while len(rows[1]):
                room = BLOCK - held
                parts.append([c[:room] for c in rows])
                held += len(parts[-1][1])
                rows = [c[room:] for c in rows]
                if held == BLOCK:
                    yield block(parts, place)
                    parts, held, place = [], 0, place + 1
        if held:
            yield block(parts, place)

    arity, ends = bins.arity, bins.ends
    return pack


def _schema(names: str, **others) -> StructType:
    """Binary columns, but for ``others``; made once, as a text would be parsed anew in each pass."""
    return StructType([StructField(n, others.get(n, BinaryType())) for n in names.split()])


# A block with its margins, as a row: the two sides (what trees are fitted on, and what says when to stop).
_STATE = _schema("part place fit fit_y fit_margin gradient drawn stop stop_y stop_margin loss stopping squares",
                 part=LongType(), place=LongType(), loss=DoubleType(), stopping=LongType())
_SUMS = _schema("counts sums losses stopping squares", stopping=LongType())
_KINDS = {"bins": np.uint8, "y": np.int8, "fits": bool, "stops": bool, "fit": np.uint8, "fit_y": np.int8, "fit_margin": np.float64,
          "gradient": np.int32, "drawn": bool, "stop": np.uint8, "stop_y": np.int8, "stop_margin": np.float64,
          "counts": np.float64, "sums": np.float64, "losses": np.float64, "squares": np.float64}


def _records(batches):
    """Each row of Arrow batches, its binary columns as arrays."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}
            yield {name: np.frombuffer(v, _KINDS[name]) if name in _KINDS else v for name, v in row.items()}


def _record(row: dict, schema: StructType):
    """One row as an Arrow batch."""
    import pyarrow as pa

    columns = [pa.array([row[n].tobytes() if n in _KINDS else row[n]]) for n in schema.names]
    return pa.RecordBatch.from_arrays(columns, schema.names)


def _sides(row: dict, width: int) -> dict:
    """A packed block as its two sides, with margins of nought."""
    bins = row["bins"].reshape(-1, width)
    out = {"part": row["part"], "place": row["place"]}
    for name, on in (("fit", row["fits"]), ("stop", row["stops"])):
        out |= {name: bins[on], f"{name}_y": row["y"][on], f"{name}_margin": np.zeros(int(on.sum()))}
    return out


# ---------------------------------------------------------------------------
# trees
# ---------------------------------------------------------------------------
# A tree in tasks is (feature of each node, next node of each node and bin, depth),
# nodes in the order in which they were made; a leaf's next node is itself.
def _tree(feature: list, following: list, depth: int) -> tuple:
    return np.array(feature, np.intp), np.array(following).astype(np.min_scalar_type(len(feature))), depth


def _leaves(tree: tuple, bins: np.ndarray) -> np.ndarray:
    """The node that each row ends in."""
    feature, following, depth = tree
    node = np.zeros(len(bins), np.intp)
    if len(bins):
        flat, first, wide = bins.ravel(), np.arange(0, bins.size, bins.shape[1]), following.shape[1]
        following = following.ravel()
        for _ in range(depth):
            node = following[node * wide + flat[first + feature[node]]].astype(np.intp)
    return node


def _moved(block: dict, tree: tuple, values: np.ndarray, step: float) -> dict:
    """The margins after a tree, and the node that each fit row ends in."""
    at = _leaves(tree, block["fit"])
    return {"at": at, "fit_margin": block["fit_margin"] + step * values[at],
            "stop_margin": block["stop_margin"] + step * values[_leaves(tree, block["stop"])]}


def _gradient(y: np.ndarray, margin: np.ndarray, number: int) -> np.ndarray:
    """What tree ``number`` is fitted to, in 1/UNIT."""
    with np.errstate(over="ignore"):
        target = 4.0 * y / (1.0 + np.exp(2.0 * y * margin)) if number else y.astype(np.float64)
    return np.rint(target * UNIT).astype(np.int32)


def _draw(rows: int, share: float, seed: int, number: int, part: int, place: int) -> np.ndarray:
    return np.random.default_rng((seed, number, part, place)).random(rows) < share if share < 1.0 else np.ones(rows, bool)


def _loss(y: np.ndarray, margin: np.ndarray) -> float:
    return math.fsum(np.logaddexp(0.0, -2.0 * y * margin))


def _advance(block: dict, tree: tuple | None, values: np.ndarray, step: float, number: int, share: float, seed: int) -> dict:
    """The block after a tree (None: before the first), ready for tree ``number``.

    ``gradient`` is that of the fit rows in 1/UNIT, ``drawn`` which of them
    the next tree is fitted on, ``loss`` the sum over the ``stopping`` rows,
    ``squares`` those of the last tree's drawn gradients by its leaves.
    """
    out = {**block, "squares": np.zeros(0)}
    if tree is not None:
        out |= _moved(block, tree, values, step)
        drawn = block["drawn"]
        out["squares"] = np.bincount(out["at"][drawn], block["gradient"][drawn].astype(np.float64) ** 2, len(values))
    out["gradient"] = _gradient(out["fit_y"], out["fit_margin"], number)
    out["drawn"] = _draw(len(out["fit_y"]), share, seed, number, block["part"], block["place"])
    out["loss"], out["stopping"] = _loss(out["stop_y"], out["stop_margin"]), len(out["stop_y"])
    return out


def _stepper(sent, width: int, step: float, number: int, share: float, seed: int):
    """Blocks after the tree that ``sent`` (a broadcast) holds."""

    def advance(batches):
        for row in _records(batches):
            block = _sides(row, width) if "bins" in row else {**row, "fit": row["fit"].reshape(-1, width), "stop": row["stop"].reshape(-1, width)}
            yield _record(_advance(block, *sent.value, step, number, share, seed), _STATE)

    return advance


def _summer(tree: tuple, slot: np.ndarray, slots: int, widths: list):
    """A task's drawn rows and their gradients by slot of their node (-1: none) and bin, and what its blocks tell."""

    def add(batches):
        counts, sums = np.zeros((slots, sum(widths))), np.zeros((slots, sum(widths)))
        losses, stopping, squares = [], 0, np.zeros(0)
        for block in _records(batches):
            drawn = block["drawn"]
            bins, gradient = block["fit"].reshape(-1, len(widths))[drawn], block["gradient"][drawn]
            place, at = slot[_leaves(tree, bins)], 0
            rows = np.flatnonzero(place >= 0)
            if len(rows) < len(place):
                place, gradient, bins = place[rows], gradient[rows], bins[rows]
            weight = _ONE + gradient
            for f, wide in enumerate(widths):
                both = np.bincount(place * wide + bins[:, f], weight, slots * wide).reshape(slots, wide)
                n = np.floor(both / _ONE + 0.5)
                counts[:, at:at + wide] += n
                sums[:, at:at + wide] += both - n * _ONE
                at += wide
            if "loss" in block:
                losses.append(block["loss"])
                stopping += block["stopping"]
                squares = block["squares"] + squares if len(squares) else block["squares"]
        yield _record({"counts": counts, "sums": sums, "losses": np.array(losses, np.float64), "stopping": stopping, "squares": squares}, _SUMS)

    return add


def _total(batches):
    """The sums of all tasks as one row."""
    out = None
    for row in _records(batches):
        if out is None:
            out = dict(row)
            continue
        for name in ("counts", "sums", "stopping"):
            out[name] = out[name] + row[name]
        out["losses"] = np.concatenate([out["losses"], row["losses"]])
        if len(row["squares"]):
            out["squares"] = out["squares"] + row["squares"] if len(out["squares"]) else row["squares"]
    if out:
        yield _record(out, _SUMS)


def _summed(blocks: DataFrame, tree: tuple, slot: np.ndarray, slots: int, widths: list) -> dict:
    total = blocks.mapInArrow(_summer(tree, slot, slots, widths), _SUMS).repartition(1).mapInArrow(_total, _SUMS)
    # the aggregate reads the one row to its end: a worker that is left in the midst of its rows is lost to the next pass
    found = total.agg(F.first(F.struct("*"))).first()[0]
    out = {name: np.frombuffer(v, np.float64) if name in _KINDS else v for name, v in found.asDict().items()}
    return {**out, "counts": out["counts"].reshape(slots, -1), "sums": out["sums"].reshape(slots, -1)}


def _best_splits(counts: np.ndarray, sums: np.ndarray, bins: Bins, asked: np.ndarray):
    """For each node (row): the gain, and its best split as (feature, which bins go left, rows and gradients there)."""
    widths = bins.widths
    n, s = counts[:, :widths[0]].sum(1), sums[:, :widths[0]].sum(1)
    gains, splits, at = np.full(len(n), -np.inf), [None] * len(n), 0
    for f, wide in enumerate(widths):
        c, g = counts[:, at:at + wide], sums[:, at:at + wide]
        at += wide
        if wide < 2:
            continue
        order = np.broadcast_to(np.arange(wide), c.shape)
        if bins.arity[f]:  # categories by their mean, those without rows last
            order = np.argsort(np.where(c > 0, g / np.maximum(c, 1), np.inf), axis=1, kind="stable")
            c, g = np.take_along_axis(c, order, 1), np.take_along_axis(g, order, 1)
        left, below = np.cumsum(c, 1)[:, :-1], np.cumsum(g, 1)[:, :-1]
        right, above = n[:, None] - left, s[:, None] - below
        some = (left > 0) & (right > 0) & asked[:, f:f + 1]
        score = np.where(some, below**2 / np.maximum(left, 1) + above**2 / np.maximum(right, 1), -np.inf)
        k = np.argmax(score, 1)
        gain = score[np.arange(len(n)), k] - s**2 / np.maximum(n, 1)
        for i in np.flatnonzero(gain > gains):
            goes = np.zeros(wide, bool)
            goes[order[i, :k[i] + 1]] = True
            gains[i], splits[i] = gain[i], (f, goes, left[i, k[i]], below[i, k[i]])
    return gains, splits


def _grow(summed, root: dict, bins: Bins, params: BoostParams, number: int):
    """Tree ``number`` level by level, with the counts, sums, gains and splits of its nodes.

    ``summed`` gives the sums of a tree's nodes by slot, for the number of slots.
    """
    widths, width, wide = bins.widths, len(bins.arity), max(bins.widths)
    some = min(width, max(1, math.ceil(float(params.colsample_bytree) * width)))
    counts, sums = root["counts"], root["sums"]
    feature, following = [0], [np.zeros(wide, np.int32)]
    stats = [[counts[0, :widths[0]].sum(), sums[0, :widths[0]].sum(), 0.0, None]]  # rows, gradients, gain, (split, left, right)
    level, depth = [0], 0
    while depth < int(params.max_depth):
        rng = np.random.default_rng((int(params.seed), number, depth, 1))
        asked = np.zeros((len(level), width), bool)
        np.put_along_axis(asked, rng.random((len(level), width)).argsort(1)[:, :some], True, 1)
        gains, splits = _best_splits(counts, sums, bins, asked)
        small, large, above = [], [], []
        for i, node in enumerate(level):
            n, s = stats[node][:2]
            if splits[i] is None or gains[i] <= _LEAST_GAIN * n:
                continue
            f, goes, n_left, s_left = splits[i]
            left, right = len(feature), len(feature) + 1
            stats[node][2:] = gains[i] / n, (f, goes, left, right)
            feature[node] = f
            following[node] = np.full(wide, right, np.int32)
            following[node][:len(goes)][goes] = left
            for child, of in ((left, (n_left, s_left)), (right, (n - n_left, s - s_left))):
                feature.append(0)
                following.append(np.full(wide, child, np.int32))
                stats.append([*of, 0.0, None])
            less = left if n_left <= n - n_left else right
            small.append(less)
            large.append(left + right - less)
            above.append(i)
        if not small:
            break
        depth += 1
        if depth == int(params.max_depth):
            break
        slot = np.full(len(feature), -1, np.intp)
        slot[small] = np.arange(len(small))
        below = summed(_tree(feature, following, depth), slot, len(small))
        c, g = below["counts"], below["sums"]
        level, counts, sums = small + large, np.concatenate([c, counts[above] - c]), np.concatenate([g, sums[above] - g])
    return _tree(feature, following, depth), stats


def _nodes(stats: list, squares: np.ndarray, bins: Bins) -> list:
    """A tree's nodes as Spark ML saves them; their stats are rows, gradients and squared gradients."""
    squares = np.array(squares, np.float64)
    out = [None] * len(stats)
    for node in range(len(stats) - 1, -1, -1):  # children come after their parents
        n, s, gain, split = stats[node]
        if split:
            squares[node] = squares[split[2]] + squares[split[3]]
        mean, square = float(s / n / UNIT), float(squares[node] / UNIT**2)
        known = (node, mean, max(0.0, square / float(n) - mean**2), [float(n), float(s / UNIT), square], int(n))
        if not split:
            out[node] = (*known, -1.0, -1, -1, (-1, [], -1))
            continue
        f, goes, left, right = split
        if bins.arity[f]:
            where = (f, [float(c) for c in np.flatnonzero(goes)], bins.arity[f])
        else:
            where = (f, [float(bins.ends[f][int(goes.sum()) - 1])], -1)
        out[node] = (*known, float(gain / UNIT**2), left, right, where)
    return out


# ---------------------------------------------------------------------------
# tasks that hold their rows
# ---------------------------------------------------------------------------
def _folder(path: str) -> tuple:
    """The file system of a shared folder and its path there."""
    scheme, colon, rest = path.partition(":")
    return FileSystem.from_uri(f"file://{'/' + rest.lstrip('/')}" if colon and scheme == "file" else path)


def _slots(spark: SparkSession) -> int:
    """Tasks that can run at the same time and share their sums; 0: none can be sure to."""
    conf = spark.sparkContext.getConf()
    if conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0  # a barrier stage needs executors that stay
    try:
        _folder(checkpoint_dir(spark))
    except (OSError, ValueError, NotImplementedError, ImportError):  # no such file system in Python
        return 0
    context = spark.sparkContext._jsc.sc()
    return int(context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()))


class _Shared:
    """What each task of a barrier stage tells the others, as files of a shared folder, round after round."""

    def __init__(self, folder: str):
        context = BarrierTaskContext.get()
        self.part, self.parts, self.round = context.partitionId(), len(context.getTaskInfos()), 0
        attempt = context.allGather(uuid.uuid4().hex)[0]  # a repeated stage shares nothing with the one before
        self.files, path = _folder(folder)
        self.path, self.last = f"{path}/{attempt}", None
        self.files.create_dir(self.path, recursive=True)

    def all(self, own) -> list:
        """``own`` of every task, in the order of the tasks."""
        self.round += 1
        paths = [f"{self.path}/{self.round}-{i}" for i in range(self.parts)]
        with self.files.open_output_stream(f"{paths[self.part]}.new") as out:
            out.write(pickle.dumps(own, 5))
        self.files.move(f"{paths[self.part]}.new", paths[self.part])
        found, missing = {}, list(range(self.parts))
        while missing:
            infos = self.files.get_file_info([paths[i] for i in missing])
            here = [i for i, info in zip(missing, infos) if info.type == FileType.File]
            for i in here:
                with self.files.open_input_stream(paths[i]) as file:
                    found[i] = pickle.loads(file.read())
            missing = [i for i in missing if i not in found]
            if missing and not here:
                time.sleep(0.002)
        if self.last:  # every task has begun this round, so all have read the one before
            self.files.delete_file(self.last)
        self.last = paths[self.part]
        return [found[i] for i in range(self.parts)]


def _joint(widths: list) -> list:
    """Features in groups of at most ``JOINT`` bins together (a feature alone may have more)."""
    groups: list = []
    for f in sorted(range(len(widths)), key=lambda f: -widths[f]):
        for g in groups:
            if math.prod(widths[i] for i in g) * widths[f] <= JOINT:
                g.append(f)
                break
        else:
            groups.append([f])
    return groups


def _small(a: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as they need."""
    most = int(np.abs(a).max(initial=0))
    return a.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


class _Held:
    """The rows of a task in chunks, with their margins."""

    def __init__(self, rows, widths: list):
        self.widths, self.groups = widths, _joint(widths)
        self.chunks, held, size = [], [], 0
        for row in rows:
            held.append(_sides(row, len(widths)))
            size += len(held[-1]["fit_y"])
            if size >= CHUNK_ROWS:
                self._add(held)
                held, size = [], 0
        if held:
            self._add(held)

    def _add(self, blocks: list) -> None:
        chunk = {name: np.concatenate([b[name] for b in blocks]) for name in ("fit", "fit_y", "fit_margin", "stop", "stop_y", "stop_margin")}
        chunk["blocks"] = [(b["part"], b["place"], len(b["fit_y"]), len(b["stop_y"])) for b in blocks]
        chunk["codes"] = []
        for group in self.groups:
            code = np.zeros(len(chunk["fit"]), np.uint16)
            for f in group:
                code = code * np.uint16(self.widths[f]) + chunk["fit"][:, f]
            chunk["codes"].append(code)
        self.chunks.append(chunk)

    def move(self, tree: tuple, values: np.ndarray, step: float) -> np.ndarray:
        """Add a tree to the margins; the squares of its drawn gradients by leaf."""
        squares = np.zeros(len(values))
        for c in self.chunks:
            c |= _moved(c, tree, values, step)
            at = c.pop("at")
            if "weight" in c:
                squares += np.bincount(at[c["rows"]], c["weight"] ** 2, len(values))
        return squares

    def begin(self, number: int, share: float, seed: int) -> list:
        """Get ready for tree ``number``; the loss of each block."""
        losses = []
        for c in self.chunks:
            c["rows"] = np.flatnonzero(np.concatenate([_draw(n, share, seed, number, part, place) for part, place, n, _ in c["blocks"]]))
            c["weight"] = _gradient(c["fit_y"], c["fit_margin"], number)[c["rows"]].astype(np.float64)
            c["drawn"], c["first"] = [code[c["rows"]] for code in c["codes"]], c["rows"] * len(self.widths)
            c["node"], at = np.zeros(len(c["rows"]), np.intp), 0
            for *_, n in c["blocks"]:
                losses.append(_loss(c["stop_y"][at:at + n], c["stop_margin"][at:at + n]))
                at += n
        return losses

    def sums(self, tree: tuple, slot: np.ndarray, slots: int) -> dict:
        """Drawn rows and their gradients by slot and bin; ``tree`` is that of the last call, a level deeper."""
        feature, following, depth = tree
        sizes = [math.prod(self.widths[f] for f in g) for g in self.groups]
        counts, sums = ([np.zeros(slots * n) for n in sizes] for _ in range(2))
        wide, following = following.shape[1], following.ravel()
        for c in self.chunks:
            if depth:
                node = c["node"]
                c["node"] = following[node * wide + c["fit"].ravel()[c["first"] + feature[node]]].astype(np.intp)
            place, weight, drawn = slot[c["node"]], c["weight"], c["drawn"]
            some = np.flatnonzero(place >= 0)
            if len(some) < len(place):
                place, weight, drawn = place[some], weight[some], [code[some] for code in drawn]
            for code, n, count, total in zip(drawn, sizes, counts, sums):
                at = place * n + code
                count += np.bincount(at, minlength=slots * n)
                total += np.bincount(at, weight, slots * n)
        out = {}
        for name, joint in (("counts", counts), ("sums", sums)):
            by = [None] * len(self.widths)
            for group, table in zip(self.groups, joint):
                table = table.reshape(slots, *[self.widths[f] for f in group])
                for i, f in enumerate(group):
                    by[f] = table.sum(axis=tuple(k + 1 for k in range(len(group)) if k != i))
            out[name] = _small(np.concatenate(by, axis=1))
        return out


def _holder(sent, folder: str, bins: Bins, params: BoostParams, patience: int, most: int, opening: int, some: bool):
    """Trees beyond those that ``sent`` holds, ``RELIABLE`` at most, by tasks that hold their rows."""
    widths, rate, seed, share = bins.widths, float(params.learning_rate), int(params.seed), float(params.subsample)
    stump, asked = _tree([0], [np.zeros(max(widths))], 0), SimpleNamespace(**params.as_dict())  # tasks don't know this package

    def added(parts: list) -> dict:
        return {name: sum(p[name].astype(np.float64) for p in parts) for name in ("counts", "sums")}

    def fit(batches):
        import pyarrow as pa

        held, shared = _Held(_records(batches), widths), _Shared(folder)
        known, losses = sent.value
        first = number = len(known)
        for i, (tree, values) in enumerate(known):
            held.move(tree, values, rate if i else 1.0)
        made, tree, values, stats, squares = [], None, None, None, np.zeros(0)
        while True:
            if tree is not None:
                squares = held.move(tree, values, rate if number > 1 else 1.0)
            own = {"losses": held.begin(number, share, seed), "stopping": sum(len(c["stop_y"]) for c in held.chunks), "squares": squares}
            parts = shared.all({**held.sums(stump, np.zeros(1, np.intp), 1), **own})
            if tree is not None:
                losses = [*losses, math.fsum(x for p in parts for x in p["losses"]) / sum(p["stopping"] for p in parts) if some else 0.0]
                if not shared.part:
                    made.append((_nodes(stats, sum(p["squares"] for p in parts), bins), tree, values))
            ended = number == most or some and number >= opening and stopping_point(losses, patience)[1]
            if ended or number == first + RELIABLE:
                break
            tree, stats = _grow(lambda *level: added(shared.all(held.sums(*level))), added(parts), bins, asked, number)
            values = np.array([s / n / UNIT for n, s, *_ in stats])
            number += 1
        shared.all(None)
        if not shared.part:
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(pickle.dumps((made, losses, ended), 5), 1)])], ["fitted"])

    return fit


def _run_held(blocks: DataFrame, bins: Bins, params: BoostParams, patience: int, most: int, opening: int, some: bool) -> tuple:
    """The trees to keep, as nodes, and the losses after each fitted one."""
    spark = blocks.sparkSession
    folder, known, trees, losses, ended = f"{checkpoint_dir(spark).rstrip('/')}/sums-{uuid.uuid4().hex}", [], [], [], False
    while not ended:
        sent = spark.sparkContext.broadcast((known, losses))
        fitted = blocks.mapInArrow(_holder(sent, folder, bins, params, patience, most, opening, some), "fitted binary", barrier=True)
        made, losses, ended = pickle.loads(zlib.decompress(fitted.agg(F.first("fitted")).first()[0]))
        sent.unpersist()
        trees += [nodes for nodes, *_ in made]
        known = [*known, *[(tree, values) for _, tree, values in made]]
    return trees[:stopping_point(losses, patience)[0] if some else most], losses


_SAVED = """treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint,
gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"""


def ensemble(spark: SparkSession, trees: list, weights: list[float], width: int, params: BoostParams) -> GBTClassificationModel:
    """The classifier of these trees (lists of nodes), read from Spark ML's format: a JVM call for each node takes far longer."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/boosted-{uuid.uuid4().hex}"

    def about(kind: str, name: str, **more) -> str:
        settings = {"impurity": "variance", "maxDepth": int(params.max_depth), "seed": int(params.seed)}
        return json.dumps({"class": f"org.apache.spark.ml.{kind}", "timestamp": 0, "sparkVersion": spark.version, "uid": name,
                           "paramMap": settings, "defaultParamMap": {}, **more})

    name = f"gbt_{uuid.uuid4().hex[:12]}_{len(trees)}"
    whole = about("classification.GBTClassificationModel", name, numFeatures=width, numTrees=len(trees))
    each = [(i, about("regression.DecisionTreeRegressionModel", f"dtr_{name}_{i}"), float(w)) for i, w in enumerate(weights)]
    nodes = [(i, node) for i, tree in enumerate(trees) for node in tree]
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, _SAVED, verifySchema=False).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


# ---------------------------------------------------------------------------
# scoring many rows for a loss
# ---------------------------------------------------------------------------
def _trees_of(model: GBTClassificationModel, spark: SparkSession) -> tuple:
    """A classifier's trees for tasks: (bins of its features, [(tree, leaf values, weight)])."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/scorer-{uuid.uuid4().hex}"
    model.write().save(path)
    width = int(model.numFeatures)
    node = F.struct("id", "prediction", "leftChild", "rightChild", "featureIndex", "leftCategoriesOrThreshold", "numCategories")
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").select("*", "split.*")
    by_tree = saved.groupBy("treeID").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    trees = by_tree.agg(F.sort_array(F.collect_list(F.struct("treeID", "nodes"))).alias("trees")).first()["trees"]
    arity, ends = [0] * width, [set() for _ in range(width)]
    for _, nodes in trees:
        for _, _, left, _, f, cut, n in nodes:
            if left >= 0 and n >= 0:
                arity[f] = n
            elif left >= 0:
                ends[f].add(cut[0])
    ends = [np.array(sorted(e), np.float64) for e in ends]
    bins = Bins(arity, ends)
    out, wide = [], max(bins.widths)
    for (_, nodes), weight in zip(trees, model.treeWeights):
        feature, following, depth = [], [], np.zeros(len(nodes), int)
        for node, _, left, right, f, cut, n in nodes:
            feature.append(max(f, 0))
            following.append(np.full(wide, node if left < 0 else right))
            if left >= 0:
                goes = np.array(cut, int) if n >= 0 else np.arange(np.searchsorted(ends[f], cut[0]) + 1)
                following[-1][goes] = left
                depth[left] = depth[right] = depth[node] + 1
        out.append((_tree(feature, following, depth.max()), np.array([node[1] for node in nodes]), float(weight)))
    return bins, out


def with_probability(model: GBTClassificationModel, df: DataFrame, *keep: str, features: str = "features", p: str = "p") -> DataFrame:
    """``keep`` and the probability ``p`` of label 1, as the model's own up to rounding; NULL where ``features`` is.

    Batches of rows run through a tree together; Spark's classifier walks its
    nodes row by row, which took most of an evaluation's time.
    """
    if not hasattr(model, "_for_tasks"):
        bins, trees = _trees_of(model, df.sparkSession)
        model._for_tasks = bins, df.sparkSession.sparkContext.broadcast(trees)  # made once, however often the model scores
    bins, sent = model._for_tasks
    if max(bins.widths) > 256:  # not of this fit
        own = {model.featuresCol: features, model.rawPredictionCol: "__raw", model.probabilityCol: "__probability", model.predictionCol: "__prediction"}
        return model.transform(df, own).select(*keep, vector_to_array("__probability")[1].alias(p))
    arity, ends, names = bins.arity, bins.ends, [*keep, p]

    def score(batches):
        import pyarrow as pa

        for batch in batches:
            own = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(own.sum(), -1 if own.any() else len(arity))
            cut, margin = bins_of(x, arity, ends), np.zeros(len(x))
            for tree, values, weight in sent.value:
                margin += weight * values[_leaves(tree, cut)]
            out = np.zeros(len(own))
            with np.errstate(over="ignore"):
                out[own] = 1.0 / (1.0 + np.exp(-2.0 * margin))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out, mask=~own)], names)

    rows = df.select(F.when(F.col(features).isNotNull(), vector_to_array(features)).alias("__x"), *keep)
    return rows.mapInArrow(score, StructType([*rows.schema.fields[1:], StructField(p, DoubleType())]))


# ---------------------------------------------------------------------------
# the run
# ---------------------------------------------------------------------------
def boost(feats: DataFrame, label: str, params: BoostParams, stop_on: str = "is_valid", fit_on: str = "is_fit",
          max_bins: int = MAX_BINS, opening: int = OPENING) -> Boosted:
    """Boost on the rows of ``fit_on`` until the loss on those of ``stop_on`` has not fallen for
    ``early_stopping_rounds`` trees.

    ``feats`` has ``features``, the label and the two flags.  Without rows to
    stop on, all trees are fitted and kept.
    """
    spark = feats.sparkSession
    checkpoint_dir(spark)
    patience, most = max(1, int(params.early_stopping_rounds)), max(1, int(params.n_estimators))
    fits, stops = (F.coalesce(F.col(c).cast("boolean"), F.lit(False)).alias(c) for c in (fit_on, stop_on))
    size = feats.agg(F.count_if(fits).alias("fits"), F.count_if(stops).alias("stops"), F.max(F.size(vector_to_array("features"))).alias("width")).first()
    if not size["fits"]:
        raise ValueError("there are no rows to fit on")
    bins = find_bins(feats.where(fits), size["width"], max_bins)
    used = feats.where(fits | stops).select(vector_to_array("features").alias("x"), F.col(label).cast("double"), fits, stops)
    width = size["width"]
    slots = _slots(spark) if size["fits"] >= HOLD else 0
    held = 0 < size["fits"] <= slots * HELD
    tasks = max(1, min(slots if held else default_parallelism(spark), -(-size["fits"] // BLOCK)))
    path = f"{checkpoint_dir(spark).rstrip('/')}/blocks-{uuid.uuid4().hex}"
    used.mapInArrow(_packer(bins), "part long, place long, bins binary, y binary, fits binary, stops binary").write.parquet(path)
    # every task gets as many blocks, whatever the parts they come from
    blocks = _own(spark).read.parquet(path).repartitionById(tasks, F.expr(f"cast(pmod(place + cast(part * 0.618D * {tasks} as long), {tasks}) as int)"))
    trees, losses = (_run_held if held else _run)(blocks, bins, params, patience, most, opening, bool(size["stops"]))
    rate = float(params.learning_rate)
    return Boosted(ensemble(spark, trees, [1.0] + [rate] * (len(trees) - 1), width, params), losses)


def _own(spark: SparkSession) -> SparkSession:
    """A session of the run's own: its few shuffles are known beforehand, so adaptive planning would only
    cut each pass into two jobs; a row is a block, so few make a batch."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return own


def _run(blocks: DataFrame, bins: Bins, params: BoostParams, patience: int, most: int, opening: int, some: bool) -> tuple:
    """The trees to keep, as nodes, and the losses after each fitted one."""
    sc, width, widths = blocks.sparkSession.sparkContext, len(bins.arity), bins.widths
    rate, seed, share = float(params.learning_rate), int(params.seed), float(params.subsample)
    rows, kept, sent, trees, losses = blocks, None, [], [], []
    tree, values, stats = None, None, None
    stump = _tree([0], [np.zeros(max(widths))], 0)
    try:
        for number in range(most + 1):
            after, step = sc.broadcast((tree, values)), rate if number > 1 else 1.0  # sent apart: the blocks' lineage stays small
            sent.append(after)
            rows = rows.mapInArrow(_stepper(after, width, step, number, share, seed), _STATE).persist(StorageLevel.MEMORY_AND_DISK)
            before, kept = kept, rows
            if number and number % RELIABLE == 0:
                rows = rows.checkpoint()
            root = _summed(rows.select("fit", "gradient", "drawn", "loss", "stopping", "squares"), stump, np.zeros(1, np.intp), 1, widths)
            if before is not None:
                before.unpersist()
            if number:
                trees.append(_nodes(stats, root["squares"], bins))
                losses.append(math.fsum(root["losses"]) / root["stopping"] if some else 0.0)
            if number == most or some and number >= opening and stopping_point(losses, patience)[1]:
                break
            drawn = rows.select("fit", "gradient", "drawn")
            tree, stats = _grow(lambda *asked, of=drawn: _summed(of, *asked, widths), root, bins, params, number)
            values = np.array([s / n / UNIT for n, s, *_ in stats])
        return trees[:stopping_point(losses, patience)[0] if some else most], losses
    finally:
        if kept is not None:
            kept.unpersist()
        for b in sent:
            b.unpersist()
