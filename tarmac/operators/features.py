"""Features, labels, split and encodings for the delay models."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.clock import clock_hour
from tarmac.operators.keys import row_number_of, smallest_per_group
from tarmac.operators.lookup import LOOKUP_ROWS, counted, join_lookup
from tarmac.session import ensure_checkpoint_dir

# Feature names in model order.
NUMERIC_FEATURES = ["DEP_HOUR", "DEP_DOW", "DEP_MONTH", "FLIGHT_DISTANCE", "SCHED_ELAPSED_MIN"]
WEATHER_FEATURES = [
    "ORIGIN_TEMP_C", "ORIGIN_PRECIP_MM", "ORIGIN_SNOWFALL_CM", "ORIGIN_WIND_KMH",
    "ORIGIN_GUST_KMH", "ORIGIN_VIS_M", "ORIGIN_CLOUD_PCT", "ORIGIN_WX_CODE",
    "DEST_TEMP_C", "DEST_WIND_KMH", "DEST_VIS_M", "DEST_WX_CODE",
]
CATEGORICAL_FEATURES = ["OP_CARRIER", "ORIGIN", "DEST"]
LABELS = ["LABEL_CLASS", "LABEL_REG"]

# Weather feature, flight column, value when the weather is missing.
WEATHER_SOURCES = [
    ("ORIGIN_TEMP_C", "ORIGIN_TEMP_C", 15.0),
    ("ORIGIN_PRECIP_MM", "ORIGIN_PRECIP_MM", 0.0),
    ("ORIGIN_SNOWFALL_CM", "ORIGIN_SNOWFALL_CM", 0.0),
    ("ORIGIN_WIND_KMH", "ORIGIN_WIND_SPEED_KMH", 10.0),
    ("ORIGIN_GUST_KMH", "ORIGIN_WIND_GUST_KMH", 12.0),
    ("ORIGIN_VIS_M", "ORIGIN_VISIBILITY_M", 10000.0),
    ("ORIGIN_CLOUD_PCT", "ORIGIN_CLOUD_COVER_PCT", 50.0),
    ("ORIGIN_WX_CODE", "ORIGIN_WEATHER_CODE", 0),
    ("DEST_TEMP_C", "DEST_TEMP_C", 15.0),
    ("DEST_WIND_KMH", "DEST_WIND_SPEED_KMH", 10.0),
    ("DEST_VIS_M", "DEST_VISIBILITY_M", 10000.0),
    ("DEST_WX_CODE", "DEST_WEATHER_CODE", 0),
]
# Training range (end excluded), label ceiling, split.
TRAIN_FROM = dt.date(2000, 1, 1)
TRAIN_UNTIL = dt.date(2025, 1, 1)
MAX_DELAY = 300.0
TRAIN_PERCENT = 80
SEED = 42


def weather_features() -> list[Column]:
    return [
        F.coalesce(F.col(source), F.lit(default)).cast("int" if name.endswith("CODE") else "double").alias(name)
        for name, source, default in WEATHER_SOURCES
    ]


def has_weather(flights: DataFrame) -> bool:
    return all(source in flights.columns for _, source, _ in WEATHER_SOURCES)


def model_features(
    flights: DataFrame,
    use_weather: bool = True,
    start: dt.date | None = TRAIN_FROM,
    end: dt.date | None = TRAIN_UNTIL,
) -> DataFrame:
    """Features and both labels of flown flights in a half-open date range.

    Without the weather columns the plain feature set is built.
    """
    rows = flights.where(~F.col("IS_CANCELLED"))
    if start is not None:
        rows = rows.where(F.col("FLIGHT_DATE") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("FLIGHT_DATE") < F.lit(end))
    return rows.select(
        clock_hour("SCHEDULED_DEP").alias("DEP_HOUR"),
        F.dayofweek("FLIGHT_DATE").alias("DEP_DOW"),
        F.col("MONTH").cast("int").alias("DEP_MONTH"),
        F.coalesce("DISTANCE", F.lit(0.0)).alias("FLIGHT_DISTANCE"),
        F.coalesce("SCHEDULED_ELAPSED", F.lit(0.0)).alias("SCHED_ELAPSED_MIN"),
        *(weather_features() if use_weather and has_weather(flights) else []),
        F.col("AIRLINE_CODE").alias("OP_CARRIER"),
        "ORIGIN",
        "DEST",
        F.col("IS_DEP_DELAYED").cast("int").alias("LABEL_CLASS"),
        F.greatest(F.lit(0.0), F.coalesce("DEP_DELAY_MIN", F.lit(0.0))).alias("LABEL_REG"),
    )


def feature_names(rows: DataFrame) -> list[str]:
    """The known features that exist, in model order."""
    known = NUMERIC_FEATURES + WEATHER_FEATURES + CATEGORICAL_FEATURES
    return [name for name in known if name in rows.columns]


def clip_minutes(minutes: str | Column) -> Column:
    minutes = F.col(minutes) if isinstance(minutes, str) else minutes
    return F.least(F.greatest(minutes, F.lit(0.0)), F.lit(MAX_DELAY))


def labelled(rows: DataFrame) -> DataFrame:
    """Rows with both labels; minutes clipped."""
    return rows.dropna(subset=LABELS).withColumn("LABEL_REG", clip_minutes("LABEL_REG"))


def class_balance(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.avg("LABEL_CLASS").alias("POSITIVE_RATE"),
        F.sum("LABEL_CLASS").alias("DELAYED"),
        F.count("LABEL_CLASS").alias("TOTAL"),
    )


def class_weight(rows: DataFrame) -> DataFrame:
    """Negatives per positive."""
    negative, positive = F.count_if(F.col("LABEL_CLASS") == 0), F.count_if(F.col("LABEL_CLASS") == 1)
    return rows.agg(
        negative.alias("NEGATIVE"),
        positive.alias("POSITIVE"),
        (negative / F.greatest(positive, F.lit(1))).alias("SCALE_POSITIVE"),
    )


def with_split(rows: DataFrame, percent: int = TRAIN_PERCENT, label: str = "LABEL_CLASS") -> DataFrame:
    """IS_VALIDATION, with ``percent`` of every class in training, to the row.

    Within a class the rows with the smallest numbers by ``row_number_of`` are
    for training.  The border is an exact quantile, found by counting; of equal
    rows at the border as many go to either side as are needed.  The same rows
    give the same split in any order and partitioning.  Nothing is sorted.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    spread = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << 60) - 1))
    # written once: the numbers of equal rows must not change between the passes
    numbered = rows.withColumns({"_number": row_number_of(rows.columns), "_place": spread}).checkpoint()
    sizes = {row[0]: row[1] for row in numbered.groupBy(label).count().collect()}
    wanted = {name: (n * percent + 50) // 100 for name, n in sizes.items()}
    borders = smallest_per_group(numbered, label, "_number", wanted)
    training = F.lit(False)
    for name, (border, n) in borders.items():
        of_class, at = F.col(label).eqNullSafe(F.lit(name)), F.col("_number") == F.lit(border)
        equal = numbered.where(of_class & at)
        last = F.lit((1 << 60) - 1)
        if equal.count() > n:
            last = F.lit(smallest_per_group(equal, label, "_place", {name: n})[name][0])
        training = training | (of_class & ((F.col("_number") < F.lit(border)) | (at & (F.col("_place") <= last))))
    return numbered.withColumn("IS_VALIDATION", ~training).drop("_number", "_place")


def split_summary(rows: DataFrame) -> DataFrame:
    """Rows and share per class and side."""
    return rows.groupBy("LABEL_CLASS").agg(
        F.count_if(~F.col("IS_VALIDATION")).alias("TRAIN_ROWS"),
        F.count_if("IS_VALIDATION").alias("VALIDATION_ROWS"),
    )


def category_values(rows: DataFrame) -> DataFrame:
    """Distinct values per categorical feature, one row each."""
    pairs = F.array(*[F.struct(F.lit(name).alias("FEATURE"), F.col(name).alias("VALUE")) for name in CATEGORICAL_FEATURES])
    return rows.select(F.inline(pairs)).where(F.col("VALUE").isNotNull()).distinct().orderBy("FEATURE", "VALUE")


def feature_rows(requests: DataFrame, names: Sequence[str]) -> DataFrame:
    """Scoring rows in model order.

    Missing weather takes the defaults; a feature the requests do not carry and
    that has no default is 0.
    """
    defaults = {name: default for name, _, default in WEATHER_SOURCES}

    def value(name: str) -> Column:
        if name in CATEGORICAL_FEATURES and name in requests.columns:
            return F.col(name).cast("string")
        kind = "int" if name.endswith("CODE") or name in ("DEP_HOUR", "DEP_DOW", "DEP_MONTH") else "double"
        if name not in requests.columns:
            return F.lit(defaults.get(name, 0)).cast(kind)
        return F.coalesce(F.col(name).cast(kind), F.lit(defaults[name]).cast(kind)) if name in defaults else F.col(name).cast(kind)

    return requests.select([value(name).alias(name) for name in names])


# -- target means ------------------------------------------------------------

FOLDS = 5


def with_fold(rows: DataFrame, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    return rows.withColumn("FOLD", F.pmod(F.xxhash64(*rows.columns, F.lit(seed + 1)), F.lit(folds)).cast("int"))


def out_of_fold_means(rows: DataFrame, label: str) -> DataFrame:
    """Mean label per feature, value and fold, taken over the other folds.

    ``rows`` carry FOLD.  One pass folds the three categoricals at once; the
    rest works on values × folds.  The mean is shrunk to the overall mean by
    count × variance, and a value seen in one fold only gets the overall mean.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("FEATURE"), F.col(name).alias("VALUE")) for name in CATEGORICAL_FEATURES])
    y = F.col(label).cast("double")
    sums = [F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q")]
    own = rows.select("FOLD", y.alias("y"), F.inline(pairs)).groupBy("FEATURE", "VALUE", "FOLD").agg(*sums)
    own, _ = counted(own)  # values × folds; read by the three aggregates below

    def others(per: list[str], prefix: str) -> DataFrame:
        merged = [F.sum(name).alias(f"{prefix}{name}") for name in "nsq"]
        return own.groupBy(*per).agg(*merged)

    by_value = others(["FEATURE", "VALUE"], "v")
    by_fold = others(["FEATURE", "FOLD"], "f")
    overall = others(["FEATURE"], "t")
    spread = by_fold.join(overall, "FEATURE").select(
        "FEATURE",
        "FOLD",
        *[(F.col(f"t{name}") - F.col(f"f{name}")).alias(f"g{name}") for name in "nsq"],
    )
    joined = own.join(by_value, ["FEATURE", "VALUE"]).join(spread, ["FEATURE", "FOLD"])
    n, s, q = [F.col(f"v{name}") - F.col(name) for name in "nsq"]
    level = F.col("gs") / F.nullif(F.col("gn"), F.lit(0))
    overall_variance = F.col("gq") / F.nullif(F.col("gn"), F.lit(0)) - level * level
    mean = s / F.nullif(n, F.lit(0))
    variance = F.greatest(q / F.nullif(n, F.lit(0)) - mean * mean, F.lit(0.0))
    trust = overall_variance * n / F.nullif(overall_variance * n + variance, F.lit(0.0))
    shrunk = F.coalesce(trust * mean + (F.lit(1.0) - trust) * level, mean, level)
    return joined.select("FEATURE", "VALUE", "FOLD", shrunk.alias("ENCODING"))


def with_out_of_fold_means(rows: DataFrame, label: str, suffix: str, limit: int = LOOKUP_ROWS) -> DataFrame:
    """Add one encoded column per categorical feature."""
    encodings, _ = counted(out_of_fold_means(rows, label))
    for name in CATEGORICAL_FEATURES:
        one = encodings.where(F.col("FEATURE") == name).select(
            F.col("VALUE").alias(name), "FOLD", F.col("ENCODING").alias(f"{name}{suffix}")
        )
        rows = join_lookup(rows, one, [name, "FOLD"], limit)
    return rows
