"""Forecasting on the feature frames: gradient-boosted trees, one model per coin and horizon.

Everything up to the learner is DataFrame code: clean rows, a chronological split per
series, standardisation on train statistics only, metrics as grouped aggregates.  All
horizons of all coins are stacked into one frame keyed by coin and horizon and fitted in one
job (see ``boosting``): the price model learns the price ``h`` days on, the trend model the
three classes jointly with softmax margins.
"""

from __future__ import annotations

from dataclasses import replace
from typing import NamedTuple

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebars.functions.exprs import TREND_CLASSES, safe_div
from pricebars.operators import boosting
from pricebars.operators.boosting import Params
from pricebars.operators.features import feature_columns, price_features, trend_features
from pricebars.session import materialize

KEY = "coin_id"
MIN_CLEAN_ROWS = 50     # fixed value: rows a model needs after cleaning
MIN_RAW_ROWS = 60       # fixed value: rows a coin needs before any forecast
# Boosting parameters of the two models.
PRICE_ROUNDS = 200
TREND_ROUNDS = 150
PRICE_PARAMS = Params(rounds=PRICE_ROUNDS, depth=6, alpha=0.1)
TREND_PARAMS = Params(rounds=TREND_ROUNDS, depth=5, classes=len(TREND_CLASSES))


# ---------------------------------------------------------------- data preparation


def clean_rows(frame: DataFrame, cols: list[str], target: str) -> DataFrame:
    """Rows where every feature and the target are present."""
    return frame.na.drop(subset=list(cols) + [target])


def clean_counts(clean: DataFrame, minimum: int = MIN_CLEAN_ROWS) -> DataFrame:
    return (clean.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_clean"))
            .withColumn("enough", F.col("n_clean") >= F.lit(minimum)))


def chrono_split(clean: DataFrame, test_size: float = 0.2, gap: int = 0, keys: tuple = (KEY,)) -> DataFrame:
    """Per series (coin), the first ``floor(n * (1 - test_size))`` rows by date are train,
    the rest test.  ``gap`` drops that many train rows before the cut so train
    labels cannot look into the test span (0 = reference behaviour)."""
    w = Window.partitionBy(*keys).orderBy("event_date")
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    cut = F.floor(n * F.lit(1.0 - test_size))
    rn = F.row_number().over(w)
    out = clean.select("*", rn.alias("_rn"), cut.alias("_cut"))
    out = out.withColumn("split", F.when(F.col("_rn") <= F.col("_cut") - F.lit(gap), F.lit("train"))
                         .when(F.col("_rn") > F.col("_cut"), F.lit("test")))
    return out.where(F.col("split").isNotNull()).drop("_rn", "_cut")


def scaler_stats(split: DataFrame, cols: list[str], keys: tuple = (KEY,)) -> DataFrame:
    """Mean and population std of each feature over each series' train rows."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_mu_{c}"), F.stddev_pop(c).alias(f"_sd_{c}")]
    return split.where(F.col("split") == "train").groupBy(*keys).agg(*aggs)


def standardize(df: DataFrame, stats: DataFrame, cols: list[str], keys: tuple = (KEY,)) -> DataFrame:
    """``(x - mean) / std`` with train statistics; a zero std scales by 1.
    ``stats`` has one row per series; the planner picks the join by its size."""
    j = df.join(stats, [k for k in keys if k in df.columns])
    scaled = []
    for c in cols:
        sd = F.col(f"_sd_{c}")
        scaled.append(((F.col(c) - F.col(f"_mu_{c}")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)).alias(c))
    keep = [c for c in [*keys, *df.columns] if c not in cols]
    return j.select(*dict.fromkeys(keep), *scaled)


def impute_latest(frame: DataFrame, cols: list[str]) -> DataFrame:
    """Each coin's newest row with NULL features replaced by that coin's column
    means over all its rows: one partially aggregated ``groupBy``, joined back on
    the newest date.  ``frame`` is read twice, so stage it first (``materialize``)."""
    means = frame.groupBy(KEY).agg(F.max("event_date").alias("event_date"),
                                   *[F.avg(c).alias(f"_m_{c}") for c in cols])
    keep = [c for c in frame.columns if c not in cols]
    return (frame.join(means, [KEY, "event_date"])
            .select(*keep, *[F.coalesce(F.col(c), F.col(f"_m_{c}")).alias(c) for c in cols]))


# ---------------------------------------------------------------- metrics


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                       keys: tuple = (KEY,)) -> DataFrame:
    """MAE, RMSE and R2 per series (coin) and split; MAPE on test rows (zero labels skipped)."""
    err = F.col(label) - F.col(prediction)
    g = pred.groupBy(*keys, "split").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"), F.avg(err * err).alias("_mse"),
        F.var_pop(label).alias("_var"),
        F.avg(F.abs(safe_div(err, F.col(label)))).alias("_ape"))
    r2 = (F.when(F.col("_var") == 0, F.when(F.col("_mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("_mse") / F.col("_var")))
    return g.select(*keys, "split", "n", "mae", F.sqrt("_mse").alias("rmse"), r2.alias("r2"),
                    F.when(F.col("split") == "test", F.col("_ape") * F.lit(100.0)).alias("mape"))


def accuracy(pred: DataFrame, label: str = "trend_label", prediction: str = "predicted") -> DataFrame:
    return pred.groupBy(KEY, "split").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def confusion(pred: DataFrame, label: str = "trend_label", prediction: str = "predicted") -> DataFrame:
    """The whole confusion matrix of each coin: a row for every true class, also one
    that does not occur, with the counts of the predicted classes."""
    counts = {(t, p): F.count(F.when((F.col(label) == t) & (F.col(prediction) == p), 1)).alias(f"{t}_{p}")
              for t in TREND_CLASSES for p in TREND_CLASSES}
    wide = pred.groupBy(KEY).agg(*counts.values())
    grid = F.array(*[F.struct(F.lit(t).alias("true_label"), *[F.col(f"{t}_{p}").alias(f"pred_{p.lower()}") for p in TREND_CLASSES])
                     for t in TREND_CLASSES])
    return wide.select(KEY, F.inline(grid))


def class_distribution(split: DataFrame, label: str = "trend_label") -> DataFrame:
    return (split.where(F.col("split") == "test")
            .groupBy(KEY, F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- models


class Fit(NamedTuple):
    """The model table (one row per tree), its feature columns, the scored train and test rows,
    and the metrics per coin and split (see ``regression_metrics``, ``accuracy``)."""

    model: DataFrame
    cols: list[str]
    scored: DataFrame
    metrics: DataFrame

    def importance(self, top: int | None = 10, by_coin: bool = False) -> DataFrame:
        return feature_importance(self.model, self.cols, top, by_coin)


def _prepared(frame: DataFrame, cols: list[str], target: str, test_size: float, minimum: int,
              keys: tuple = (KEY,)) -> DataFrame:
    """Clean rows of series that have at least ``MIN_RAW_ROWS`` rows and
    ``minimum`` clean rows, split chronologically.  Counts are window aggregates
    on the partitioning the split uses anyway (no extra shuffle or join)."""
    whole = Window.partitionBy(*keys)
    raw = frame.withColumn("_n_raw", F.count(F.lit(1)).over(whole))
    clean = clean_rows(raw, cols, target).withColumn("_n_clean", F.count(F.lit(1)).over(whole))
    ok = (F.col("_n_raw") >= F.lit(MIN_RAW_ROWS)) & (F.col("_n_clean") >= F.lit(minimum))
    return chrono_split(clean.where(ok).drop("_n_raw", "_n_clean"), test_size, keys=keys)


class Inputs(NamedTuple):
    """Scaled learner input: split rows and newest rows of each series, with ``features``."""

    split: DataFrame
    newest: DataFrame


def _packed(df: DataFrame, cols: list[str], *keep) -> DataFrame:
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in cols]).alias("features"))


def _inputs(frame: DataFrame, stacked: DataFrame, cols: list[str], target: str, keys: tuple, test_size: float, *more: str) -> Inputs:
    """Split, scale and pack ``stacked`` (``frame`` by series) and the newest row of each coin."""
    split = materialize(_prepared(stacked, cols, target, test_size, MIN_CLEAN_ROWS, keys))
    stats = materialize(scaler_stats(split, cols, keys))
    rows = _packed(standardize(split, stats, cols, keys), cols, *keys, "event_date", "split", *more)
    latest = impute_latest(frame, cols).withColumn("_close", F.col("close_price_usd"))
    newest = _packed(standardize(latest.drop(*[k for k in keys if k != KEY]), stats, cols, keys), cols, *keys, "_close")
    return Inputs(materialize(rows), materialize(newest))


def price_inputs(metrics: DataFrame, horizons=(1, 7, 30), test_size: float = 0.2) -> tuple[DataFrame, list[str], Inputs]:
    """``(feature frame, feature columns, inputs)`` of the price model, all horizons stacked."""
    frame = materialize(price_features(metrics))
    cols = feature_columns(frame, "price")
    targets = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"target_{h}d").alias("label")) for h in horizons]))
    stacked = frame.select(KEY, "event_date", *cols, targets.alias("_t")).select(KEY, "event_date", *cols, "_t.horizon", "_t.label")
    return frame, cols, _inputs(frame, stacked, cols, "label", (KEY, "horizon"), test_size, "label")


def trend_inputs(metrics: DataFrame, horizon_days: int = 7, threshold_pct: float = 2.0,
                 test_size: float = 0.2) -> tuple[DataFrame, list[str], Inputs]:
    """As ``price_inputs`` for the trend model; ``label`` is the place of the class in ``TREND_CLASSES``."""
    frame = materialize(trend_features(metrics, horizon_days, threshold_pct))
    cols = feature_columns(frame, "trend")
    place = F.array_position(F.array(*[F.lit(c) for c in TREND_CLASSES]), F.col("trend_label")) - 1
    labelled = frame.select(KEY, "event_date", *cols, "trend_label", place.cast("double").alias("label"))
    return frame, cols, _inputs(frame, labelled, cols, "trend_label", (KEY,), test_size, "trend_label", "label")


def in_range(metrics: DataFrame, start=None, end=None) -> DataFrame:
    """Inclusive date range of the input, applied *before* features when the
    reference's filter-first behaviour is wanted (features then only see the
    range, so look-back windows start inside it)."""
    if start is not None:
        metrics = metrics.where(F.col("event_date") >= F.lit(start).cast("date"))
    if end is not None:
        metrics = metrics.where(F.col("event_date") <= F.lit(end).cast("date"))
    return metrics


def forecast_price(metrics: DataFrame, horizons=(1, 7, 30), max_iter: int = PRICE_ROUNDS, max_depth: int = PRICE_PARAMS.depth,
                   test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, dict[int, Fit]]:
    """Price forecast per coin and horizon.

    Returns ``(forecasts, fits)``: ``forecasts`` has ``coin_id, horizon,
    current_price, prediction, confidence, change_pct`` (``confidence`` = the
    coin's test RMSE); a coin with too few clean rows gets NULLs for that horizon.
    ``fits[h]`` is a ``Fit``; its metrics are MAE / RMSE / R2 per coin and split and
    MAPE on test.  All models are fitted in one job.
    """
    frame, cols, data = price_inputs(metrics, horizons, test_size)
    keys = [KEY, "horizon"]
    params = replace(PRICE_PARAMS, rounds=max_iter, depth=max_depth, seed=seed)
    trees = materialize(boosting.fit(data.split.where(F.col("split") == "train"), keys, params))
    price = F.col("margins")[0].alias("prediction")
    scored = materialize(boosting.predict(data.split, trees, keys, params).select(*keys, "event_date", "split", "label", price))
    judged = regression_metrics(scored, keys=(KEY, "horizon"))
    rmse = judged.where(F.col("split") == "test").select(*keys, F.col("rmse").alias("confidence"))
    pred = boosting.predict(data.newest, trees, keys, params).select(*keys, F.col("_close").alias("current_price"), price)
    asked = frame.select(KEY).distinct().select(KEY, F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon"))
    out = materialize(asked.join(pred, keys, "left").join(rmse, keys, "left")
                      .select(*keys, "current_price", "prediction", "confidence",
                              (safe_div(F.col("prediction") - F.col("current_price"), F.col("current_price"))
                               * F.lit(100.0)).alias("change_pct")))

    def of(df: DataFrame, h: int) -> DataFrame:
        return df.where(F.col("horizon") == h)

    return out, {h: Fit(of(trees, h), cols, of(scored, h).drop("horizon"), of(judged, h)) for h in horizons}


def feature_importance(trees: DataFrame, cols: list[str], top: int | None = 10, by_coin: bool = False) -> DataFrame:
    """Top features (all with ``top=None``) of the models of one horizon: each coin's own
    (``by_coin``), or the mean of the coins' shares."""
    shares = boosting.importance(trees, [KEY], cols)
    if not by_coin:
        shares = shares.groupBy("feature").agg(F.avg("importance").alias("importance"))
        return shares if top is None else shares.orderBy(F.col("importance").desc(), "feature").limit(top)
    place = F.row_number().over(Window.partitionBy(KEY).orderBy(F.col("importance").desc(), "feature"))
    return shares if top is None else shares.withColumn("_rn", place).where(F.col("_rn") <= top).drop("_rn")


def label_indexer(labelled: DataFrame, label: str = "trend_label"):
    """The fitted label index: classes that occur, in alphabetical order, from 0."""
    return StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(labelled)


def probabilities(margins: str = "margins") -> list:
    """Softmax of the margins, one column per class."""
    top = F.array_max(margins)
    e = F.transform(margins, lambda m: F.exp(m - top))
    total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return [(e[i] / total).alias(f"p_{c.lower()}") for i, c in enumerate(TREND_CLASSES)]


def likeliest() -> Column:
    """The class of the largest probability, the first of equals."""
    top = F.greatest(*[F.col(f"p_{c.lower()}") for c in TREND_CLASSES])
    out = F.lit(TREND_CLASSES[-1])
    for c in reversed(TREND_CLASSES[:-1]):
        out = F.when(F.col(f"p_{c.lower()}") == top, F.lit(c)).otherwise(out)
    return out


def forecast_trend(metrics: DataFrame, horizon_days: int = 7, threshold_pct: float = 2.0,
                   max_iter: int = TREND_ROUNDS, max_depth: int = TREND_PARAMS.depth, test_size: float = 0.2,
                   seed: int = 42) -> tuple[DataFrame, Fit]:
    """Trend class forecast (DOWN / FLAT / UP) per coin.

    Returns ``(forecast, fit)``: ``forecast`` has ``coin_id, trend, confidence,
    p_down, p_flat, p_up, current_price``, all NULL for a coin with too few clean
    rows; ``fit.metrics`` has the train and test accuracy per coin, and
    ``trend_metrics(fit.scored)`` adds the confusion matrix and class counts.  The
    probabilities are a softmax over the margins of one model of three classes."""
    frame, cols, data = trend_inputs(metrics, horizon_days, threshold_pct, test_size)
    params = replace(TREND_PARAMS, rounds=max_iter, depth=max_depth, seed=seed)
    trees = materialize(boosting.fit(data.split.where(F.col("split") == "train"), [KEY], params))
    scored = boosting.predict(data.split, trees, [KEY], params).select(KEY, "event_date", "split", "trend_label", *probabilities())
    scored = materialize(scored.select(KEY, "event_date", "split", "trend_label", likeliest().alias("predicted")))
    p = [f"p_{c.lower()}" for c in TREND_CLASSES]
    newest = boosting.predict(data.newest, trees, [KEY], params).select(KEY, F.col("_close").alias("current_price"), *probabilities())
    fc = newest.select(KEY, likeliest().alias("trend"), F.greatest(*p).alias("confidence"), *p, "current_price")
    fc = materialize(frame.select(KEY).distinct().join(fc, KEY, "left"))
    return fc, Fit(trees, cols, scored, accuracy(scored))


# ---------------------------------------------------------------- public wrappers

score_row = impute_latest


def trend_metrics(scored: DataFrame, label: str = "trend_label", prediction: str = "predicted"):
    """``(accuracy per coin and split, confusion rows on test, test class counts)``."""
    test = scored.where(F.col("split") == "test")
    return accuracy(scored, label, prediction), confusion(test, label, prediction), class_distribution(scored, label)


def predict_multiple_horizons(metrics: DataFrame, horizons=(1, 7, 30), max_iter: int = PRICE_ROUNDS,
                              start=None, end=None) -> tuple[DataFrame, dict[int, Fit]]:
    """Forecast rows and fit of each horizon (a coin without enough rows gets NULLs).
    ``start`` / ``end`` restrict the input first, as the reference's date picker does."""
    return forecast_price(in_range(metrics, start, end), horizons, max_iter=max_iter)


def train_and_predict(metrics: DataFrame, target_days: int = 30, max_iter: int = PRICE_ROUNDS, start=None,
                      end=None) -> tuple[DataFrame, Fit]:
    out, fits = forecast_price(in_range(metrics, start, end), (target_days,), max_iter=max_iter)
    return out, fits[target_days]


def predict_trend(metrics: DataFrame, horizon_days: int = 7, threshold_pct: float = 2.0,
                  max_iter: int = TREND_ROUNDS, start=None, end=None) -> tuple[DataFrame, Fit]:
    return forecast_trend(in_range(metrics, start, end), horizon_days, threshold_pct, max_iter=max_iter)
