"""A small fully connected regressor trained data-parallel on Spark.

The rows are written once as blocks of numbers, dealt evenly over as many files as
tasks run at a time.  Each epoch is one pass over them: every partition deals its rows
over up to ``SIDE`` networks, which take 64-row Adam steps side by side with numpy
inside ``mapInArrow``, from the same weights and moments, and emits what they
arrived at, times their rows.  Those are added up on the executors and divided by
the rows, so the driver receives one number per entry however many partitions there
are, and the average starts the next pass.
Rows never leave their executors.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.operators.ml import split_bucket
from skyfare.session import ship_package, write_once

# Layer widths and training settings of the reference network.
HIDDEN_UNITS = 32
HIDDEN_LAYERS = 3
LEARNING_RATE = 1e-3
EARLY_STOP_PATIENCE = 10
LR_PATIENCE = 3
LR_FACTOR = 0.2
VALIDATION_TENTHS = 2
BATCH_ROWS = 64
MAX_EPOCHS = 500
#: Networks that a task trains side by side, and rows of a network at least: fewer make too few steps between two averages.
SIDE, PART_ROWS = 4, 20_000
BETA_1, BETA_2, EPSILON = 0.9, 0.999, 1e-7


def layer_sizes(n_inputs: int) -> list[int]:
    return [n_inputs] + [HIDDEN_UNITS] * HIDDEN_LAYERS + [1]


def init_weights(sizes: Sequence[int], seed: int = 42) -> list[np.ndarray]:
    """Glorot-uniform weights, zero biases, as a flat list [W1, b1, W2, b2, ...]."""
    rng = np.random.default_rng(seed)
    out = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        limit = np.sqrt(6.0 / (a + b))
        out += [rng.uniform(-limit, limit, size=(a, b)), np.zeros(b)]
    return out


def _flatten(ws: Sequence[np.ndarray]) -> np.ndarray:
    return np.concatenate([w.ravel() for w in ws])


def _unflatten(flat: np.ndarray, like: Sequence[np.ndarray]) -> list[np.ndarray]:
    out, i = [], 0
    for w in like:
        out.append(flat[i:i + w.size].reshape(w.shape))
        i += w.size
    return out


def forward(ws: Sequence[np.ndarray], x: np.ndarray) -> np.ndarray:
    h = x
    for k in range(0, len(ws), 2):
        h = np.maximum(h @ ws[k] + ws[k + 1], 0.0)
    return h[:, 0]


def loss_and_grad(ws: Sequence[np.ndarray], x: np.ndarray, y: np.ndarray):
    """Sum of squared errors and its gradient (ReLU on every layer, output included)."""
    acts, pres = [x], []
    h = x
    for k in range(0, len(ws), 2):
        z = h @ ws[k] + ws[k + 1]
        pres.append(z)
        h = np.maximum(z, 0.0)
        acts.append(h)
    err = h[:, 0] - y
    g = (2.0 * err)[:, None] * (pres[-1] > 0)
    grads = [None] * len(ws)
    for layer in reversed(range(len(pres))):
        grads[2 * layer] = acts[layer].T @ g
        grads[2 * layer + 1] = g.sum(axis=0)
        if layer > 0:
            g = (g @ ws[2 * layer].T) * (pres[layer - 1] > 0)
    return float((err ** 2).sum()), grads


def _augmented(flat: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    """Views of networks, a row [W1, b1, W2, b2, ...] each: a layer as one matrix, the bias as its last row."""
    out, i = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        out.append(flat[:, i:i + (a + 1) * b].reshape(len(flat), a + 1, b))
        i += (a + 1) * b
    return out


class _Adam:
    """Adam steps of several networks side by side, each on batches of its own.

    Steps are in single precision, as in the reference's framework, by the gradient
    of ``loss_and_grad`` written into arrays that all steps share.
    """

    def __init__(self, sizes: Sequence[int], w, m, v, step: int, lr: float, batch: int):
        self.w, self.m, self.v, self.step, self.lr, self.batch = w, m, v, step, lr, batch
        self.grad, self.move = np.empty_like(w), np.empty_like(w)
        self.own, self.grads = _augmented(w, sizes), _augmented(self.grad, sizes)
        self.turned = [x.transpose(0, 2, 1) for x in self.own]
        # a column for each row of a batch; below a layer's units a row of ones for the next one's bias
        self.full = [np.ones((len(w), b + 1, batch), np.float32) for b in sizes[1:]]
        self.units = [x[:, :-1] for x in self.full]
        self.backs, self.live = ([np.empty_like(x) for x in self.units] for _ in range(2))

    def take(self, x: np.ndarray, y: np.ndarray) -> float:
        """A step of each network on its rows: features and ones (networks, rows, columns), labels; summed squared errors."""
        full, units, backs, live, grad, move = self.full, self.units, self.backs, self.live, self.grad, self.move
        h = x.transpose(0, 2, 1)
        for k, weights in enumerate(self.turned):
            np.matmul(weights, h, out=units[k])
            np.maximum(units[k], np.float32(0), out=units[k])
            np.sign(units[k], out=live[k])
            h = full[k]
        err = units[-1][:, 0] - y
        np.multiply(err[:, None], live[-1], out=backs[-1])
        backs[-1] *= np.float32(2 / self.batch)
        for k in range(len(units) - 1, -1, -1):
            np.matmul(full[k - 1] if k else x.transpose(0, 2, 1), backs[k].transpose(0, 2, 1), out=self.grads[k])
            if k:
                join = np.multiply if backs[k].shape[1] == 1 else np.matmul
                join(self.own[k][:, :-1], backs[k], out=backs[k - 1])
                backs[k - 1] *= live[k - 1]
        self.step += 1
        root_2 = np.sqrt(1 - BETA_2 ** self.step)
        self.m *= np.float32(BETA_1)
        self.m += np.multiply(grad, np.float32(1 - BETA_1), out=move)
        self.v *= np.float32(BETA_2)
        grad *= grad
        grad *= np.float32(1 - BETA_2)
        self.v += grad
        # lr * (m / (1 - b1^t)) / (sqrt(v / (1 - b2^t)) + eps), the constants taken out
        np.sqrt(self.v, out=grad)
        grad += np.float32(EPSILON * root_2)
        np.divide(self.m, grad, out=move)
        move *= np.float32(self.lr * root_2 / (1 - BETA_1 ** self.step))
        self.w -= move
        return float(np.einsum("ij,ij->", err, err))


def _adam_pass(sizes: Sequence[int], state: np.ndarray, step: int, lr: float, blocks, seed: int, side: int = 1):
    """64-row Adam steps over a partition's blocks by ``side`` networks, all from the shared ``state`` (weights, both moments).

    Returns (sum of the networks' states times their rows, rows, summed loss, networks
    that had rows, validation rows, their summed squared error under the shared weights).
    A block is (rows to train on, rows held out), each with columns features, 1, label;
    ``side`` blocks at a time are shuffled and dealt over the networks, so memory is bounded.
    Losses are summed, and held-out rows scored, in double precision.
    """
    n_weights = len(state) // 3
    given = [x for layer in _augmented(state[None, :n_weights], sizes) for x in (layer[0, :-1], layer[0, -1])]
    states = [np.repeat(state[None, i * n_weights:(i + 1) * n_weights].astype(np.float32), side, axis=0) for i in range(3)]
    adam = _Adam(sizes, *states, step, lr, BATCH_ROWS)
    rng, total, val_rows, val_total = np.random.default_rng(seed), 0.0, 0, 0.0
    rows, waiting, here = np.zeros(side, np.int64), [], 0

    def dealt():
        """Shuffled rows in whole steps of all networks; what is left over waits for the blocks that follow."""
        nonlocal waiting, here, total
        held_back = np.concatenate(waiting) if waiting else np.empty((0, sizes[0] + 2))
        held_back = held_back[rng.permutation(len(held_back))]
        steps = len(held_back) // (BATCH_ROWS * side)
        taken = steps * BATCH_ROWS * side
        part = held_back[:taken].astype(np.float32).reshape(steps, side, BATCH_ROWS, sizes[0] + 2)
        x, y = np.ascontiguousarray(part[..., :-1]), np.ascontiguousarray(part[..., -1])
        for i in range(steps):
            total += adam.take(x[i], y[i])
        rows[:] += steps * BATCH_ROWS
        waiting, here = [held_back[taken:]], 0

    for block, held in blocks:
        if len(held):
            val_rows += len(held)
            val_total += float(((forward(given, held[:, :-2].astype(np.float64)) - held[:, -1]) ** 2).sum())
        waiting.append(block)
        here += 1
        if here == side:
            dealt()
    dealt()
    last = waiting[0].astype(np.float32)
    for i, at in enumerate(range(0, len(last), BATCH_ROWS)):  # fewer batches than networks, the last one shorter
        part, one = last[None, at:at + BATCH_ROWS], slice(i, i + 1)
        total += _Adam(sizes, adam.w[one], adam.m[one], adam.v[one], adam.step, lr, part.shape[1]).take(part[..., :-1], part[..., -1])
        rows[i] += part.shape[1]
    found = np.concatenate([adam.w, adam.m, adam.v], axis=1).astype(np.float64)
    return rows @ found, int(rows.sum()), total, int((rows > 0).sum()), val_rows, val_total


def _blocks(rows: DataFrame, feats: list[str], label: str, scale: float, parts: int) -> DataFrame:
    """The rows dealt evenly over ``parts`` files as blocks: rows to train on and rows held out, little-endian doubles."""
    def task(batches):
        for batch in batches:
            columns = [np.asarray(batch.column(c), dtype=np.float64) for c in feats]
            label_ = np.asarray(batch.column(label), dtype=np.float64) / scale
            matrix = np.stack([*columns, np.ones(batch.num_rows), label_], axis=1).astype("<f8")
            held = batch.column("_is_val").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pydict({"train": [matrix[~held].tobytes()], "held": [matrix[held].tobytes()]},
                                             pa.schema([("train", pa.binary()), ("held", pa.binary())]))

    return write_once(rows.repartition(parts).mapInArrow(task, "train binary, held binary"), "mlp-blocks")


def _epoch(blocks: DataFrame, sizes: list[int], state, step: int, lr: float, scale: float, seed: int,
           side: int = 1):
    """One pass: every partition trains ``side`` networks on its rows, the states are averaged by row count.

    Returns (state, steps so far, training loss, validation loss of the state that was given).
    """
    columns = sizes[0] + 2

    def part(batches):
        from pyspark import TaskContext

        def matrices():
            for batch in batches:
                for row in zip(batch.column("train").to_pylist(), batch.column("held").to_pylist(), strict=True):
                    yield [np.frombuffer(x, "<f8").reshape(-1, columns) for x in row]

        out, *sums = _adam_pass(sizes, state, step, lr, matrices(), seed + TaskContext.get().partitionId(), side)
        if sums[0] or sums[3]:  # rows to train on or held out
            yield pa.RecordBatch.from_pydict({"v": [np.concatenate([out, np.array(sums, float)])]},
                                             pa.schema([("v", pa.list_(pa.float64()))]))

    # the states are added up on the executors: one number for each entry reaches the
    # driver, however many partitions there are
    summed = (blocks.mapInArrow(part, "v array<double>").select(F.posexplode("v").alias("i", "v"))
              .groupBy("i").agg(F.sum("v").alias("v")).collect())
    acc = np.zeros(len(state) + 5)
    for r in summed:
        acc[r["i"]] = r["v"]
    rows, total, parts, val_rows, val_total = acc[len(state):]
    steps = int(np.ceil(rows / max(parts, 1) / BATCH_ROWS))
    after = acc[:len(state)] / rows if rows else state
    val = val_total / val_rows * scale ** 2 if val_rows else float("nan")
    return after, step + steps, total / max(rows, 1) * scale ** 2, val


def mean_squared_error(df: DataFrame, ws: Sequence[np.ndarray], feats: Sequence[str], label: str) -> float:
    err = F.col(label) - F.col("prediction")
    value = batch_predict(df, ws, feats).agg(F.avg(err * err)).first()[0]
    return float("nan") if value is None else value


def train_mlp(train: DataFrame, feats: Sequence[str], label: str, key_cols: Sequence[str],
              epochs: int = MAX_EPOCHS, seed: int = 42):
    """Fit the network; returns (best weights, history rows).

    20% of the training rows (by key hash) are held out for validation.  The
    best weights by validation loss are kept; the learning rate drops x0.2
    after 3 epochs without improvement and training stops after 10.  A pass also
    scores the weights it starts from, so an epoch's validation loss is known
    one pass later and no pass is for validation alone.  The label
    is divided by its largest value while training, and the weights returned
    give it back in its own unit.
    """
    feats = list(feats)
    ship_package(train.sparkSession)
    rows = (train.select(*key_cols, *feats, label).dropna(subset=feats + [label])
            .select(*feats, label, (split_bucket(key_cols, "val") < VALIDATION_TENTHS).alias("_is_val")))
    rows = write_once(rows, "mlp-rows")
    top, mean, n = rows.agg(F.max(F.abs(label)), F.avg(label), F.count(F.lit(1))).first()
    scale = float(top or 1.0)
    parts = max(1, min(train.sparkSession.sparkContext.defaultParallelism, n // PART_ROWS))
    side = max(1, min(SIDE, n // PART_ROWS // parts))
    blocks = _blocks(rows, feats, label, scale, parts)
    ws = init_weights(layer_sizes(len(feats)), seed)
    # start the output unit at the label mean: with a zero bias the output ReLU can
    # begin dead for every row, and then no gradient ever flows
    ws[-1] = ws[-1] + float(mean or 0.0) / scale
    sizes = layer_sizes(len(feats))
    flat = _flatten(ws)
    state = np.concatenate([flat, np.zeros(2 * len(flat))])
    lr, step, best, best_loss, since_best, since_lr, history = LEARNING_RATE, 0, ws, float("inf"), 0, 0, []

    def in_unit(state):
        out = _unflatten(state[:len(flat)].copy(), ws)
        return [*out[:-2], out[-2] * scale, out[-1] * scale]

    last = None
    for epoch in range(epochs + 1):
        after, steps, loss, val = _epoch(blocks, sizes, state, step, lr, scale, seed * 1009 + epoch, side)
        if last is not None:  # ``state`` is what the epoch before arrived at
            history.append((epoch - 1, *last, val))
            if val < best_loss:
                best, best_loss, since_best, since_lr = in_unit(state), val, 0, 0
            else:
                since_best, since_lr = since_best + 1, since_lr + 1
                if since_best >= EARLY_STOP_PATIENCE:
                    break
        last = (loss, lr)
        state, step = after, steps
        if since_lr >= LR_PATIENCE:
            lr, since_lr = lr * LR_FACTOR, 0
    return best, history


def save_weights(spark, ws: Sequence[np.ndarray], path: str) -> None:
    """Write a network as a small table: one row for each tensor."""
    spark.createDataFrame([(i, [int(n) for n in w.shape], [float(x) for x in w.ravel()]) for i, w in enumerate(ws)],
                          "tensor INT, shape ARRAY<INT>, items ARRAY<DOUBLE>").coalesce(1).write.parquet(path)


def load_weights(spark, path: str) -> list[np.ndarray]:
    return [np.array(r["items"]).reshape(r["shape"]) for r in spark.read.parquet(path).orderBy("tensor").collect()]


def history_frame(spark, history) -> DataFrame:
    return spark.createDataFrame([(int(e), float(l), float(r), float(v)) for e, l, r, v in history],
                                 "epoch INT, loss DOUBLE, lr DOUBLE, val_loss DOUBLE")


def batch_predict(df: DataFrame, ws: Sequence[np.ndarray], feats: Sequence[str],
                  out: str = "prediction") -> DataFrame:
    """Score every row with the trained weights (Arrow batches, weights in the closure)."""
    feats = list(feats)
    ship_package(df.sparkSession)
    flat, shapes = _flatten(ws), [w.shape for w in ws]
    schema = df.schema.simpleString()[len("struct<"):-1] + f",{out}:double"

    def part(batches):
        w, i = [], 0
        for s in shapes:
            n = int(np.prod(s))
            w.append(flat[i:i + n].reshape(s))
            i += n
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype=float)
            ok = ~np.isnan(x).any(axis=1)
            pred = np.full(len(pdf), np.nan)
            if ok.any():
                pred[ok] = forward(w, x[ok])
            pdf[out] = pred
            yield pdf

    return df.mapInPandas(part, schema).withColumn(out, F.nanvl(F.col(out), F.lit(None)))
