"""A fraud model on the feature mart, with Spark ML, per user and in time.

The prose plans a scikit-learn model; here it is Spark ML so training runs
on the cluster (logistic regression aggregates gradients with
``treeAggregate`` across partitions; nothing is collected to the driver).
Labels come from the rules themselves (D7), so the model learns to imitate
the rule set — useful as a smooth risk score, not as independent evidence.

``temporal_training`` asks a question about the future instead: from what is known
of a user at a transaction, will one of their later transactions within the
horizon be labelled fraud? Features end at the transaction, labels begin after it,
and the split is by time with a gap of one horizon, so no training label looks into
the test period.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.columns import event_time, interval_micros
from txnguard.operators import behaviour as B
from txnguard.operators.parts import tasks_for
from txnguard.session import checkpoint_root

ROWS_PER_PARTITION = 500_000

FEATURES = [
    "n_txn",
    "total_amount",
    "avg_amount",
    "max_amount",
    "n_devices",
    "n_locations",
    "n_merchants",
    "n_international",
]


def user_labels(scored: DataFrame) -> DataFrame:
    """1 when any of the user's transactions is labelled fraud."""
    return scored.groupBy("user_id").agg(F.max("is_fraud").cast("double").alias("label"))


def training_set(features: DataFrame, labels: DataFrame) -> DataFrame:
    own = labels.withColumnRenamed("user_id", "_user")
    out = features.join(own, features["user_id"].eqNullSafe(own["_user"]), "left").withColumn("label", F.coalesce("label", F.lit(0.0)))
    return out.select("user_id", *[F.col(c).cast("double").alias(c) for c in FEATURES], "label").na.fill(0.0)


def fit_and_score(train: DataFrame, max_iter: int = 20, reg: float = 0.01) -> DataFrame:
    """Fit scaler + logistic regression, return per-user fraud probability.

    The optimiser passes over the training set once per iteration, so the
    set is first written to the shared checkpoint folder (reliable
    ``checkpoint``): iterations read it back instead of recomputing the
    feature joins, and a lost executor does not restart the lineage.
    """
    train = _compact(train)
    scaled, model = _fitted(train, FEATURES, max_iter, reg)
    scored = model.transform(scaled.transform(_assembled(train, FEATURES)))
    return scored.select(
        "user_id",
        "label",
        vector_to_array("probability")[1].alias("fraud_probability"),
        F.col("prediction"),
    )


def _compact(train: DataFrame) -> DataFrame:
    """``train`` written to the shared checkpoint folder and read back in few enough partitions."""
    checkpoint_root(train.sparkSession)
    train = train.checkpoint(eager=True)
    # each iteration schedules one task per partition: keep ~ROWS_PER_PARTITION
    # rows per task (only ever fewer partitions; large sets keep theirs)
    n = train.count()
    parts = train.rdd.getNumPartitions()
    wanted = max(1, -(-n // ROWS_PER_PARTITION))
    if wanted < parts:
        train = train.coalesce(wanted)
    return train


def _assembled(rows: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="raw").transform(rows)


def _fitted(train: DataFrame, features: list[str], max_iter: int, reg: float):
    """A fitted scaler and logistic regression."""
    assembled = _assembled(train, features)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(assembled)
    return scaler, LogisticRegression(maxIter=max_iter, regParam=reg, labelCol="label").fit(scaler.transform(assembled))


# --- in time -----------------------------------------------------------------------------

TEMPORAL_FEATURES = [
    "transaction_amount",
    "international",
    "trailing_count",
    "trailing_amount",
    "trailing_devices",
    "prior_n",
    "prior_sum",
    "since_prev",
]


def next_event(rows: DataFrame, events: DataFrame, horizon: str, tasks: int | None = None) -> DataFrame:
    """``rows`` with ``next_us``: the time of the user's first of ``events`` after the row and within ``horizon``, in microseconds.

    Rows and events meet by (user, bucket of one horizon): a row looks at its own bucket and the next one, so every event
    is in two. In descending time the nearest later event is a running minimum, one sort per bucket.
    ``tasks``: partitions of that pass (default: by the number of rows).
    """
    from pyspark.sql import Window

    h = interval_micros(horizon)
    own = lambda df: B.timed(df).withColumn("_b", F.floor(F.col("_us") / F.lit(h)))
    marks = own(events).select("user_id", "_us", F.explode(F.array("_b", F.col("_b") - 1)).alias("_b"), F.col("_us").alias("_event"))
    left = own(rows).select("user_id", "_us", "_b", F.lit(None).cast("long").alias("_event"), F.struct(*[c for c in rows.columns if c != "user_id"]).alias("_row"))
    both = left.unionByName(marks, allowMissingColumns=True).repartition(tasks or tasks_for(rows), "user_id", "_b")
    later = Window.partitionBy("user_id", "_b").orderBy(F.desc("_us")).rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("next_us", F.min("_event").over(later)).where("_row is not null")
    near = F.when(F.col("next_us") <= F.col("_us") + F.lit(h), F.col("next_us")).alias("next_us")
    return found.select(*[F.col(c if c == "user_id" else f"_row.{c}").alias(c) for c in rows.columns], near)


def temporal_training(silver: DataFrame, flagged: DataFrame, horizon: str = "5 minutes", trailing: str = "60 seconds", split: float = 0.7) -> DataFrame:
    """One row per transaction: transaction_id, user_id, features known at its time, ``label`` and ``split``.

    ``flagged``: transactions labelled fraud (D7). ``label`` is 1.0 if the user has one in (t, t + horizon]. ``split`` is
    train where t + horizon is at most the cut at ``split`` of the time line, test where t is after the cut; rows in the gap,
    and those whose horizon goes beyond the data, are in neither and left out.
    """
    at = F.unix_micros(event_time("transaction_time"))
    low, high = silver.agg(F.min(at), F.max(at)).first()
    low, high = low or 0, high or 0
    cut, h = low + int((high - low) * split), interval_micros(horizon)
    tasks = tasks_for(silver)
    rows = next_event(B.transaction_features(silver, trailing=trailing, tasks=tasks), flagged, horizon, tasks).withColumn("_at", at)
    part = F.when(F.col("_at") + F.lit(h) <= F.lit(cut), "train").when((F.col("_at") > F.lit(cut)) & (F.col("_at") + F.lit(h) <= F.lit(high)), "test")
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    since = F.coalesce("seconds_since_prev", F.lit(interval_micros(trailing) / 1e6)).alias("since_prev")
    features = [since if c == "since_prev" else F.coalesce(F.col("is_international").cast("double"), F.lit(0.0)).alias(c) if c == "international" else zero(c) for c in TEMPORAL_FEATURES]
    return rows.withColumn("split", part).where("split is not null").select("transaction_id", "user_id", *features, F.col("next_us").isNotNull().cast("double").alias("label"), "split")


def fit_temporal(rows: DataFrame, max_iter: int = 30, reg: float = 0.01) -> DataFrame:
    """Fit on the training period; (transaction_id, user_id, label, fraud_probability) of the test period."""
    rows = _compact(rows)
    train = rows.where("split = 'train'")
    scaler, model = _fitted(train, TEMPORAL_FEATURES, max_iter, reg)
    scored = model.transform(scaler.transform(_assembled(rows.where("split = 'test'"), TEMPORAL_FEATURES)))
    return scored.select("transaction_id", "user_id", "label", vector_to_array("probability")[1].alias("fraud_probability"))


def pr_auc(scored: DataFrame) -> float:
    """Area under precision and recall of scored rows (a model without skill has the share of label 1)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    return BinaryClassificationEvaluator(rawPredictionCol="fraud_probability", labelCol="label", metricName="areaUnderPR").evaluate(scored)
