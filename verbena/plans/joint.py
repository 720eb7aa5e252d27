"""One shared layer under several heads, trained jointly (M2, M3, M4).

Rows are bags of hashed words; their TF-IDF goes through a shared projection
(``features`` x ``hidden``, tanh) into one softmax head for each label.  The
loss is the weighted sum of the heads' cross entropies (0.45 / 0.55 in the
reference), so both heads pull on the shared layer: a gradient, not a report.

A step is one Spark job over one mini-batch: the training rows are written once,
dealt by a hash of their key into ``slots`` folders, and step ``s`` reads the
folder ``s mod slots`` (partition pruning).  Every task adds up the gradient of
its rows and sends it in pieces; the pieces are summed in two rounds by
``Summarizer`` (inside the JVM).  Only the parameters, a bounded array, pass
through the driver, where Adam moves them.

Early stopping (M4): every ``eval_every`` steps the validation rows are scored,
the state (step, parameters, optimiser, history) is written to the shared
folder, and the search stops after ``patience`` evaluations without a strict
improvement; the best state is read back.  A run that finds states in its folder
goes on from the newest: gradients are rounded to a fixed grid before they are
summed, so sums do not depend on the order in which tasks end, and a resumed
run gives the parameters of the uninterrupted one.

Rows with a null label count for the other heads only; a null text is empty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.text import tokens
from ..llm.common import small_batches
from ..session import shared_dir

#: Gradients are rounded to multiples of this, so that sums of up to 2^21 are exact in a double.
GRID = 2.0 ** -32
PIECE = 1 << 14  # numbers in one piece of a gradient
PART_WORDS = 1 << 17  # words that a task works on at once: each takes a row of the shared layer
FAN_IN = 64      # tasks that one first-round sum takes in


@dataclass(frozen=True)
class Settings:
    features: int = 1 << 12
    hidden: int = 32
    heads: tuple = (("sentiment", 3, 0.45), ("task", 9, 0.55))  # name, classes, weight of its loss
    rate: float = 0.02
    decay: float = 1e-5
    slots: int = 2
    max_steps: int = 60
    eval_every: int = 6
    patience: int = 3
    seed: int = 42


def shapes(s: Settings) -> list[tuple[str, tuple]]:
    out = [("w", (s.features, s.hidden)), ("b", (s.hidden,))]
    for name, classes, _ in s.heads:
        out += [(f"v_{name}", (s.hidden, classes)), (f"c_{name}", (classes,))]
    return out


def views(flat: np.ndarray, s: Settings) -> dict[str, np.ndarray]:
    """The parameters by name, as views into one flat array."""
    out, at = {}, 0
    for name, shape in shapes(s):
        n = int(np.prod(shape))
        out[name] = flat[at: at + n].reshape(shape)
        at += n
    return out


def start(s: Settings) -> np.ndarray:
    rng = np.random.default_rng(s.seed)
    flat = np.zeros(sum(int(np.prod(x)) for _, x in shapes(s)))
    p = views(flat, s)
    p["w"][:] = rng.normal(0, 1, p["w"].shape)
    for name, _, _ in s.heads:
        p[f"v_{name}"][:] = rng.normal(0, s.hidden ** -0.5, p[f"v_{name}"].shape)
    return flat


def hashed_words(text: Column, features: int) -> Column:
    """One bucket for each token of the text (null counts as empty)."""
    return F.transform(tokens(F.coalesce(text, F.lit(""))), lambda w: F.pmod(F.xxhash64(w), F.lit(features)).cast("int"))


def idf(rows: DataFrame, features: int, words: str = "words") -> np.ndarray:
    """``log((n + 1) / (df + 1))`` of every bucket (at most ``features`` rows are collected)."""
    counts = np.zeros(features)
    n = rows.count()
    for r in rows.select(F.explode(F.array_distinct(words)).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.w] = r.n
    return np.log((n + 1) / (counts + 1))


def parts(batch: pa.RecordBatch, words: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``PART_WORDS`` words, or of one row."""
    ends = np.cumsum(np.asarray(batch.column(words).value_lengths().fill_null(0), dtype=np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PART_WORDS, side="right"))
        hi = max(hi, lo + 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


class Bags:
    """TF-IDF of some rows, each of unit length, as flat arrays: ``row``, ``bucket``, ``value`` (sorted by row, bucket)."""

    def __init__(self, words: pa.Array, weights: np.ndarray):
        lengths = np.asarray(words.value_lengths().fill_null(0))
        self.n = len(lengths)
        key = np.repeat(np.arange(self.n), lengths) * len(weights) + np.asarray(words.flatten(), dtype=np.int64)
        key, count = np.unique(key, return_counts=True)
        self.row, self.bucket = key // len(weights), key % len(weights)
        value = (1 + np.log(count)) * weights[self.bucket]
        norm = np.sqrt(np.bincount(self.row, value * value, minlength=self.n))
        self.value = value / np.where(norm == 0, 1, norm)[self.row]

    def times(self, w: np.ndarray) -> np.ndarray:
        """The rows times a matrix with one row for each bucket."""
        out = np.zeros((self.n, w.shape[1]))
        if len(self.row):
            first = np.flatnonzero(np.append(True, self.row[1:] != self.row[:-1]))
            out[self.row[first]] = np.add.reduceat(w[self.bucket] * self.value[:, None], first, axis=0)
        return out

    def add_outer(self, out: np.ndarray, d: np.ndarray) -> None:
        """Add the transposed rows times ``d`` to ``out``."""
        if len(self.row):
            order = np.argsort(self.bucket, kind="stable")
            b = self.bucket[order]
            first = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
            out[b[first]] += np.add.reduceat(d[self.row[order]] * self.value[order, None], first, axis=0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def forward(flat: np.ndarray, bags: Bags, s: Settings) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The shared layer's output, and each head's class probabilities."""
    p = views(flat, s)
    h = np.tanh(bags.times(p["w"]) + p["b"])
    return h, {name: softmax(h @ p[f"v_{name}"] + p[f"c_{name}"]) for name, _, _ in s.heads}


def loss_and_gradient(flat: np.ndarray, bags: Bags, targets: dict[str, np.ndarray], s: Settings) -> tuple[float, np.ndarray]:
    """Weighted cross entropy summed over the rows, and its gradient; a target of -1 counts for nothing."""
    p, grad = views(flat, s), np.zeros_like(flat)
    g = views(grad, s)
    h, probs = forward(flat, bags, s)
    loss, dh = 0.0, np.zeros_like(h)
    for name, _, weight in s.heads:
        y, pr = targets[name], probs[name]
        known = np.flatnonzero(y >= 0)
        loss -= weight * float(np.log(np.maximum(pr[known, y[known]], 1e-300)).sum())
        d = np.zeros_like(pr)
        d[known] = pr[known]
        d[known, y[known]] -= 1
        d *= weight
        g[f"v_{name}"] += h.T @ d
        g[f"c_{name}"] += d.sum(axis=0)
        dh += d @ p[f"v_{name}"].T
    dz = dh * (1 - h * h)
    g["b"] += dz.sum(axis=0)
    bags.add_outer(g["w"], dz)
    return loss, grad


def _targets(batch: pa.RecordBatch, s: Settings) -> dict[str, np.ndarray]:
    return {name: np.asarray(batch.column(f"y_{name}").fill_null(-1), dtype=np.int64) for name, _, _ in s.heads}


def prepare(df: DataFrame, text: str, targets: dict[str, Column], key: str, s: Settings) -> DataFrame:
    """Rows ``(slot, words, y_<head>...)``: hashed words, 0-based classes (null where unknown), and the mini-batch."""
    known = {name: F.when(targets[name].between(0, classes - 1), targets[name]).cast("int").alias(f"y_{name}")
             for name, classes, _ in s.heads}
    slot = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(s.seed)), F.lit(s.slots)).cast("int")
    return df.select(slot.alias("slot"), hashed_words(F.col(text), s.features).alias("words"), *known.values())


def gradient(rows: DataFrame, flat: np.ndarray, weights: np.ndarray, s: Settings) -> tuple[np.ndarray, float, int]:
    """Gradient and loss summed over ``rows``, and how many rows there are."""
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast((flat, weights))  # bounded by the settings
    size = len(flat) + 2
    schema = StructType([StructField("piece", IntegerType()), StructField("part", IntegerType()), StructField("g", ArrayType(DoubleType()))])

    def run(batches):
        import pyspark
        flat, weights = shared.value
        total = None
        for batch in (p for b in batches for p in parts(b, "words")):
            bags = Bags(batch.column("words"), weights)
            loss, g = loss_and_gradient(flat, bags, _targets(batch, s), s)
            g = np.append(g, [loss, bags.n])
            g[:-1] = np.round(g[:-1] / GRID) * GRID
            total = g if total is None else total + g
        if total is not None:
            part = pyspark.TaskContext.get().partitionId()
            pieces = [total[i: i + PIECE].tolist() for i in range(0, size, PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), pa.array([part] * len(pieces), pa.int32()),
                                              pa.array(pieces, pa.list_(pa.float64()))], names=["piece", "part", "g"])

    sent = rows.select("words", *[f"y_{name}" for name, _, _ in s.heads]).mapInArrow(run, schema)
    sent = sent.select("piece", (F.col("part") / FAN_IN).cast("int").alias("part"), array_to_vector("g").alias("g"))
    first = sent.groupBy("piece", "part").agg(Summarizer.sum(F.col("g")).alias("g"))
    pieces = first.groupBy("piece").agg(Summarizer.sum(F.col("g")).alias("g")).select("piece", vector_to_array("g").alias("g")).collect()
    shared.destroy()
    out = np.zeros(size)
    for r in pieces:
        out[r.piece * PIECE: r.piece * PIECE + len(r.g)] = r.g
    return out[:-2], float(out[-2]), int(out[-1])


def score(df: DataFrame, text: str, model: "JointModel") -> DataFrame:
    """``df`` with ``pred_<head>`` (0-based) and ``prob_<head>`` of a fitted model."""
    s = model.settings
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((model.flat, model.weights))
    kept = [f for f in df.schema if not any(f.name in (f"pred_{n}", f"prob_{n}") for n, _, _ in s.heads)]
    extra = [StructField(c, t) for n, _, _ in s.heads for c, t in ((f"pred_{n}", IntegerType()), (f"prob_{n}", ArrayType(DoubleType())))]

    def run(batches):
        flat, weights = shared.value
        for batch in (p for b in batches for p in parts(b, "__vb_words")):
            _, probs = forward(flat, Bags(batch.column("__vb_words"), weights), s)
            cols = [batch.column(f.name) for f in kept]
            for n, _, _ in s.heads:
                cols += [pa.array(probs[n].argmax(axis=1), pa.int32()), pa.array(probs[n].tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in kept + extra])

    words = df.select(*[F.col(f"`{f.name}`") for f in kept], hashed_words(F.col(text), s.features).alias("__vb_words"))
    return words.mapInArrow(run, StructType(kept + extra))


def weighted_f1(counts: dict[tuple[int, int], int]) -> float:
    """Support-weighted F1 from ``(actual, predicted) -> n``; 0 without rows."""
    total, out = sum(counts.values()), 0.0
    for c in {a for a, _ in counts}:
        support = sum(n for (a, _), n in counts.items() if a == c)
        guessed = sum(n for (_, p), n in counts.items() if p == c)
        hit = counts.get((c, c), 0)
        out += support * (2 * hit / (support + guessed) if hit else 0.0)
    return out / total if total else 0.0


def validate(rows: DataFrame, model: "JointModel") -> dict[str, float]:
    """Weighted F1 of each head over prepared rows: the confusion counts are all that is collected."""
    s, flat, weights = model.settings, model.flat, model.weights
    shared = rows.sparkSession.sparkContext.broadcast((flat, weights))
    schema = StructType([StructField("head", StringType()), *[StructField(c, IntegerType()) for c in ("actual", "predicted")], StructField("n", LongType())])

    def run(batches):
        flat, weights = shared.value
        for batch in (p for b in batches for p in parts(b, "words")):
            _, probs = forward(flat, Bags(batch.column("words"), weights), s)
            y = _targets(batch, s)
            for name, classes, _ in s.heads:
                known = y[name] >= 0
                pairs, n = np.unique(y[name][known] * classes + probs[name][known].argmax(axis=1), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(n), pa.string()), pa.array(pairs // classes, pa.int32()),
                                                  pa.array(pairs % classes, pa.int32()), pa.array(n, pa.int64())], names=schema.names)

    found = rows.drop("slot").mapInArrow(run, schema).groupBy("head", "actual", "predicted").agg(F.sum("n").alias("n")).collect()
    return {name: weighted_f1({(r.actual, r.predicted): r.n for r in found if r["head"] == name}) for name, _, _ in s.heads}


@dataclass
class JointModel:
    settings: Settings
    flat: np.ndarray
    weights: np.ndarray
    step: int = 0


def decide(history: Sequence[dict], found: float, patience: int) -> tuple[bool, int, bool]:
    """``(improved, waited, stop)`` of one more evaluation: only a strict improvement counts."""
    best = max([h["score"] for h in history], default=float("-inf"))
    improved = found > best
    waited = 0 if improved else (history[-1]["waited"] + 1 if history else 1)
    return improved, waited, waited >= patience


_STATE = "name string, at int, data array<double>"
_HISTORY = "step int, loss double, scores map<string,double>, score double, improved boolean, waited int, stop boolean"


def _save(spark: SparkSession, path: str, step: int, arrays: dict[str, np.ndarray], history: list[dict], s: Settings) -> None:
    """Arrays first, then the history row that makes the state count: a half-written state is never read."""
    rows = [(name, i, a[i: i + PIECE].tolist()) for name, a in arrays.items() for i in range(0, max(len(a), 1), PIECE)]
    spark.createDataFrame(rows, _STATE).coalesce(1).write.mode("overwrite").parquet(f"{path}/state-{step}")
    spark.createDataFrame([tuple(h[f] for f in ("step", "loss", "scores", "score", "improved", "waited", "stop")) for h in history], _HISTORY) \
        .withColumn("settings", F.lit(repr(asdict(s)))).coalesce(1).write.mode("overwrite").parquet(f"{path}/history/at={step}")


def _arrays(spark: SparkSession, path: str, step: int) -> dict[str, np.ndarray]:
    out: dict[str, list] = {}
    for r in sorted(spark.read.parquet(f"{path}/state-{step}").collect(), key=lambda r: r.at):
        out.setdefault(r["name"], []).extend(r.data)
    return {k: np.array(v) for k, v in out.items()}


def history_of(spark: SparkSession, path: str) -> DataFrame:
    """The evaluations so far: step, loss since the last one, F1 by head, their mean, and what was decided."""
    at = spark.read.parquet(f"{path}/history")
    return at.where(F.col("at") == at.agg(F.max("at")).first()[0]).drop("at").orderBy("step")


def _found(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/history")
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def fit_joint(train: DataFrame, val: DataFrame, s: Settings, path: str | None = None, stop_at: int | None = None) -> JointModel:
    """Train on prepared rows; states and history go to ``path`` (a shared folder), from which a later call goes on.

    ``stop_at`` ends the call after the first evaluation at or past that step
    (a maintenance stop); calling again without it gives the same model as one
    uninterrupted call.
    """
    spark = train.sparkSession
    path = (path or shared_dir(spark, "joint")).rstrip("/")
    if _found(spark, path):
        told = history_of(spark, path).collect()
        if told[0]["settings"] != repr(asdict(s)):
            raise ValueError("the states in this folder were trained with other settings")
        history = [r.asDict() for r in told]
        a = _arrays(spark, path, history[-1]["step"])
        step = history[-1]["step"]
    else:
        train.write.mode("overwrite").partitionBy("slot").parquet(f"{path}/train")
        a = {"flat": start(s), "weights": idf(spark.read.parquet(f"{path}/train"), s.features)}
        a |= {"m": np.zeros_like(a["flat"]), "v": np.zeros_like(a["flat"])}
        history, step = [], 0
    slots = spark.read.schema(train.schema).parquet(f"{path}/train")
    loss, rows = 0.0, 0
    while step < s.max_steps and not (history and history[-1]["stop"]) and not (stop_at and history and step >= stop_at):
        g, part_loss, n = gradient(slots.where(F.col("slot") == step % s.slots), a["flat"], a["weights"], s)
        step, loss, rows = step + 1, loss + part_loss, rows + n
        g = g / max(n, 1) + s.decay * a["flat"]
        a["m"] = 0.9 * a["m"] + 0.1 * g
        a["v"] = 0.999 * a["v"] + 0.001 * g * g
        a["flat"] = a["flat"] - s.rate * (a["m"] / (1 - 0.9 ** step)) / (np.sqrt(a["v"] / (1 - 0.999 ** step)) + 1e-8)
        if step % s.eval_every == 0 or step == s.max_steps:
            scores = validate(val, JointModel(s, a["flat"], a["weights"], step))
            mean = sum(scores.values()) / len(scores)
            improved, waited, stop = decide(history, mean, s.patience)
            history.append({"step": step, "loss": loss / max(rows, 1), "scores": scores, "score": mean, "improved": improved, "waited": waited, "stop": stop})
            loss, rows = 0.0, 0
            _save(spark, path, step, a, history, s)
    best = max(history, key=lambda h: (h["score"], -h["step"]))["step"]
    a = _arrays(spark, path, best)
    return JointModel(s, a["flat"], a["weights"], best)


def train_joint(labelled: DataFrame, s: Settings = Settings(), path: str | None = None, abbreviations: dict | None = None) -> dict:
    """Check, preprocess, split 70 / 15 / 15, train jointly, report on the test part."""
    from ..functions.text import preprocess_multitask
    from ..operators.split import stratified_split
    from ..operators.validate import validate_domain
    from .training import SENTIMENT, TOPIC, _materialize, evaluate_heads, joint_loss
    checked = validate_domain(labelled, "label", "task", mode="fail")
    data = checked.withColumn("processed_text", preprocess_multitask(F.col("comment"), abbreviations))
    split = _materialize(stratified_split(data, ["label", "task"], "id", 0.15, 0.15, s.seed))
    targets = {"sentiment": F.col("label").cast("int"), "task": F.col("task").cast("int") - 1}
    part = {p: split.where(F.col("split") == p) for p in ("train", "val", "test")}
    prepared = {p: prepare(part[p], "processed_text", targets, "id", s) for p in ("train", "val")}
    model = fit_joint(prepared["train"], prepared["val"], s, path)
    scored = score(part["test"], "processed_text", model).withColumn("pred_task", F.col("pred_task") + 1)
    cols = {"sentiment": "label", "task": "task"}
    ev = evaluate_heads(scored, [SENTIMENT, TOPIC], cols, {"sentiment": [0, 1, 2], "task": list(range(1, 10))})
    return {"model": model, "joint_loss": joint_loss(ev["summary"]), **ev}


def train_joint_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.derived import labelled_comments
    lab = labelled_comments(spark, sf_dir).select("id", "comment", "label", "task")
    return train_joint(lab)["summary"].select("head", "accuracy", "precision", "recall", "f1", "support", "loss")
