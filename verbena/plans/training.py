"""Classifiers (M1-M5, M12, M13) on Spark ML.

Features: whitespace tokens -> hashed term counts -> IDF (one fit pass).
Heads: multinomial logistic regression, one per label (sentiment 3 classes,
topic 9 classes).  The heads share the feature stages but no weights, so the
reference's loss weights (0.45 / 0.55) cannot steer a shared encoder here:
the joint loss (M3) and the joint score (A8, mean of the weighted F1s) are
reported and used to pick the best candidate, not as a gradient.

Model selection (M4): candidates are tried in order; a candidate replaces the
best only on a strict improvement of the validation score, and the search
stops after ``patience`` candidates in a row without one.  Every fit and
evaluation is a distributed job; the driver only keeps a handful of scores.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import WS, preprocess_multitask, preprocess_sentiment
from ..operators import metrics as M
from ..operators.split import stratified_split
from ..operators.validate import validate_domain

NUM_FEATURES = 1 << 14
DEFAULT_GRID = ({"regParam": 0.01, "maxIter": 25}, {"regParam": 0.1, "maxIter": 25},
                {"regParam": 0.001, "maxIter": 25}, {"regParam": 0.3, "maxIter": 25},
                {"regParam": 0.03, "maxIter": 25})


def feature_stages(text: str = "processed_text", num_features: int = NUM_FEATURES):
    tok = RegexTokenizer(inputCol=text, outputCol="tokens", pattern=WS + "+", gaps=True,
                         toLowercase=False, minTokenLength=1)
    tf = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=num_features)
    idf = IDF(inputCol="tf", outputCol="features")
    return [tok, tf, idf]


def fit_features(train: DataFrame, text: str = "processed_text",
                 num_features: int = NUM_FEATURES) -> PipelineModel:
    return Pipeline(stages=feature_stages(text, num_features)).fit(train)


def _head(name: str, label: str, params: dict) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features", labelCol=label, family="multinomial",
        predictionCol=f"pred_{name}", probabilityCol=f"prob_{name}",
        rawPredictionCol=f"raw_{name}", **params)


@dataclass
class HeadSpec:
    name: str          # output prefix
    label: str         # label column (0-based class index, double)
    offset: int = 0    # added back to the predicted index (topic: 1)


SENTIMENT = HeadSpec("sentiment", "__vb_y_sentiment", 0)
TOPIC = HeadSpec("task", "__vb_y_task", 1)


def _with_targets(df: DataFrame, heads: Sequence[HeadSpec], cols: dict) -> DataFrame:
    return df.withColumns({h.label: (F.col(cols[h.name]).cast("int") - h.offset).cast("double")
                           for h in heads})


def fit_heads(feats: DataFrame, heads: Sequence[HeadSpec], params: dict) -> list:
    """One LR per head on already computed features.

    The heads do not depend on each other, so their fits are submitted from
    separate driver threads and Spark runs their jobs side by side.
    """
    if len(heads) == 1:
        return [_head(heads[0].name, heads[0].label, params).fit(feats)]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(heads)) as pool:
        futures = [pool.submit(_head(h.name, h.label, params).fit, feats) for h in heads]
        return [f.result() for f in futures]


def train_heads(features: PipelineModel, train: DataFrame, heads: Sequence[HeadSpec],
                params: dict) -> PipelineModel:
    """M1 / M2: fit one LR per head on shared, already fitted features."""
    feats = features.transform(train)
    return PipelineModel(stages=list(features.stages) + fit_heads(feats, heads, params))


def _finish(out: DataFrame, heads: Sequence[HeadSpec]) -> DataFrame:
    for h in heads:
        out = out.withColumns({
            f"pred_{h.name}": (F.col(f"pred_{h.name}").cast("int") + h.offset),
            f"prob_{h.name}": vector_to_array(F.col(f"prob_{h.name}")),
        })
    return out.drop("tokens", "tf", "features", *[f"raw_{h.name}" for h in heads])


def predictions(model: PipelineModel, df: DataFrame, heads: Sequence[HeadSpec]) -> DataFrame:
    """Scored rows with ``pred_<head>`` in the original coding and the probability array."""
    return _finish(model.transform(df), heads)


def evaluate_heads(scored: DataFrame, heads: Sequence[HeadSpec], actual: dict,
                   domains: dict) -> dict:
    """Confusion, report and summary for all heads in one pass."""
    mh = [M.Head(h.name, actual[h.name], f"pred_{h.name}", domains[h.name],
                 prob=f"prob_{h.name}", offset=h.offset) for h in heads]
    return M.evaluate(scored, mh)


def joint_score(summary: DataFrame) -> float:
    """A8 over the heads present (one small collect of a few rows)."""
    f1s = [r["f1"] for r in summary.select("f1").collect()]
    return float(sum(f1s) / len(f1s)) if f1s else 0.0


@dataclass
class Selection:
    model: PipelineModel
    params: dict
    score: float
    history: list = field(default_factory=list)


def select_best(features: PipelineModel, train: DataFrame, val: DataFrame,
                heads: Sequence[HeadSpec], actual: dict, domains: dict,
                grid: Sequence[dict] = DEFAULT_GRID, patience: int = 3,
                parallelism: int = 1) -> Selection:
    """M4: strict improvement, counter reset on improvement, stop after ``patience``.

    Train and validation features are computed once and kept without the texts
    and tokens (memory, spilling to disk) for all candidates; every fit and evaluation is distributed.
    With ``parallelism > 1`` that many candidates are fitted at once (their
    jobs share the cluster); the patience rule is then applied to the scores
    in grid order, so the chosen model is the same as one at a time.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import StorageLevel
    targets = [h.label for h in heads]
    tr = features.transform(train).select("features", *targets).persist(StorageLevel.MEMORY_AND_DISK)
    va = features.transform(val).select("features", *dict.fromkeys([*targets, *(actual[h.name] for h in heads)])) \
        .persist(StorageLevel.MEMORY_AND_DISK)

    def attempt(params: dict):
        models = fit_heads(tr, heads, params)
        scored = va
        for m in models:
            scored = m.transform(scored)
        ev = evaluate_heads(_finish(scored, heads), heads, actual, domains)
        return models, joint_score(ev["summary"])

    best, best_score, best_params, waited, history = None, float("-inf"), None, 0, []
    try:
        grid = list(grid)
        step = max(1, int(parallelism))
        stop = False
        for start in range(0, len(grid), step):
            chunk = grid[start:start + step]
            if step == 1:
                results = [attempt(chunk[0])]
            else:
                with ThreadPoolExecutor(max_workers=len(chunk)) as pool:
                    results = list(pool.map(attempt, chunk))
            for params, (models, score) in zip(chunk, results):
                history.append((dict(params), score))
                if score > best_score:
                    best, best_score, best_params, waited = models, score, dict(params), 0
                else:
                    waited += 1
                    if waited >= patience:
                        stop = True
                        break
            if stop:
                break
    finally:
        tr.unpersist()
        va.unpersist()
    model = PipelineModel(stages=list(features.stages) + list(best))
    return Selection(model, best_params, best_score, history)


def save_model(model: PipelineModel, path: str) -> None:
    """M5 (a shared folder on a cluster)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- experiments

def _materialize(df: DataFrame) -> DataFrame:
    """The split is read by every fit and evaluation: checkpoint it once to the
    shared checkpoint folder (reliable, survives lost executors)."""
    from ..session import shared_dir
    shared_dir(df.sparkSession, "split")  # ensures a checkpoint folder is set
    return df.checkpoint(eager=True)


def run_multitask(labelled: DataFrame, abbreviations: dict | None = None,
                  grid: Sequence[dict] = DEFAULT_GRID, patience: int = 3,
                  model_path: str | None = None, parallelism: int = 2) -> dict:
    """Load -> check -> preprocess -> split -> fit -> select -> test -> report."""
    checked = validate_domain(labelled, "label", "task", mode="fail")
    data = checked.withColumn("processed_text", preprocess_multitask(F.col("comment"), abbreviations))
    split = stratified_split(data, ["label", "task"], "id", 0.15, 0.15, 42)
    heads = [SENTIMENT, TOPIC]
    cols = {"sentiment": "label", "task": "task"}
    split = _materialize(_with_targets(split, heads, cols).drop("comment"))
    train = split.filter(F.col("split") == "train")
    val = split.filter(F.col("split") == "val")
    test = split.filter(F.col("split") == "test")
    features = fit_features(train)
    domains = {"sentiment": [0, 1, 2], "task": list(range(1, 10))}
    sel = select_best(features, train, val, heads, cols, domains, grid, patience, parallelism)
    if model_path:
        save_model(sel.model, model_path)
    ev = evaluate_heads(predictions(sel.model, test, heads), heads, cols, domains)
    return {"selection": sel, "joint_loss": joint_loss(ev["summary"]), **ev}


def run_sentiment(sources: DataFrame, abbreviations: dict | None = None,
                  grid: Sequence[dict] = DEFAULT_GRID, patience: int = 3,
                  key: str = "doc_id", test: DataFrame | None = None,
                  parallelism: int = 2) -> dict:
    """The one-head experiment: union of sources, 10 % validation by label.

    Rows whose label could not be recoded (null, D11) are left out of the
    split and counted in ``unlabelled``.  The best model (not the last) is
    evaluated on ``test`` when given (D13), else on the validation part.
    """
    data = sources.withColumn("processed_text", preprocess_sentiment(F.col("text"), abbreviations))
    split = stratified_split(data, ["label"], key, 0.0, 0.1, 42)
    heads = [SENTIMENT]
    cols = {"sentiment": "label"}
    split = _materialize(_with_targets(split, heads, cols))
    train = split.filter(F.col("split") == "train")
    val = split.filter(F.col("split") == "val")
    features = fit_features(train)
    domains = {"sentiment": [0, 1, 2]}
    sel = select_best(features, train, val, heads, cols, domains, grid, patience, parallelism)
    target = val if test is None else _with_targets(
        test.withColumn("processed_text", preprocess_sentiment(F.col("text"), abbreviations)),
        heads, cols)
    ev = evaluate_heads(predictions(sel.model, target, heads), heads, cols, domains)
    unlabelled = split.filter(F.col("split").isNull())
    return {"selection": sel, "unlabelled": unlabelled, **ev}


LOSS_WEIGHTS = {"sentiment": 0.45, "task": 0.55}


def joint_loss(summary: DataFrame, weights: dict = LOSS_WEIGHTS) -> DataFrame:
    """M3: ``sum(weight * loss)`` over the heads, as one row."""
    w = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(v))])
    return summary.agg(F.sum(F.col("loss") * F.try_element_at(w, F.col("head"))).alias("joint_loss"))


def train_multitask_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.derived import labelled_comments
    lab = labelled_comments(spark, sf_dir).select("id", "comment", "label", "task")
    res = run_multitask(lab, grid=DEFAULT_GRID)
    return res["summary"].select("head", "accuracy", "precision", "recall", "f1", "support", "loss")


def train_sentiment_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..queries import _sources_table
    from ..sources.adapters import adapter_a, adapter_b, adapter_c, union_sources
    a, b, c = _sources_table(spark, sf_dir)
    src = union_sources(adapter_a(a, "sentence", "sentiment", keep=["doc_id"]),
                        adapter_b(b, keep=["doc_id"]), adapter_c(c, keep=["doc_id"]))
    res = run_sentiment(src, grid=DEFAULT_GRID)
    return res["summary"].select("head", "accuracy", "precision", "recall", "f1", "support", "loss")
