"""Feature operators and the fit / transform pair.

``CohortFeatures.fit`` runs a few small aggregations on the training split
only and keeps their results as bounded state; ``FittedFeatures.transform``
reads that state back as literal lookups (a handful of values each, bound
proven at fit time), so it never recomputes a statistic from its input and
works unchanged on one row, a batch table or a streaming DataFrame.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.ranks import exact_quantiles

# Fixed values of the feature rules (must equal the reference behaviour).
RARE_MIN_COUNT = 10
TITLE_MAP = {"Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs"}
KNOWN_TITLES = ["Mr", "Mrs", "Miss", "Master", "Rare"]
TITLE_PATTERN = r",\s*([^\.]+)\."
RARE_LABEL = "Rare"
DECK_UNKNOWN = "U"
DECK_OTHER = "Other"
AGE_BINS = [0, 12, 18, 59, 120]
AGE_LABELS = ["Child", "Teen", "Adult", "Senior"]
ENGINEERED = ["title", "has_cabin", "family_size", "is_alone", "fare_per_person", "deck", "age_group"]
FEATURES_VERSION = "1.1.0"

# Raw titles whose rare/frequent status can change the final title: the
# known buckets and the keys of the normalisation map. Any other raw title
# ends as "Rare" whatever its count, so the fitted state is at most 8 rows.
TITLE_CANDIDATES = sorted(set(KNOWN_TITLES) | set(TITLE_MAP))

MAX_STATE_VALUES = 10_000


# F1 ---------------------------------------------------------------------------------------
def extract_title(name: Column) -> Column:
    """First match of the title pattern; no match gives NULL."""
    return F.nullif(F.regexp_extract(name, TITLE_PATTERN, 1), F.lit(""))


# F3 / F4 ----------------------------------------------------------------------------------
def normalize_title(raw: Column, rare: list[str]) -> Column:
    """Rare collapse, then the fixed map, then anything outside the known
    buckets (unseen, null) becomes Rare.

    ``rare``: titles seen at least once but fewer than RARE_MIN_COUNT times
    in training. A title never seen at all is not rare and goes through the
    map (an unseen ``Mme`` becomes ``Mrs``), as in the reference.
    """
    collapsed = F.when(raw.isin(rare), F.lit(RARE_LABEL)).otherwise(raw) if rare else raw
    mapped = F.coalesce(F.create_map(*[F.lit(x) for kv in TITLE_MAP.items() for x in kv])[collapsed],
                        collapsed)
    return F.when(mapped.isin(KNOWN_TITLES), mapped).otherwise(F.lit(RARE_LABEL))


def _title_expr(raw: Column, rare_candidates: list[str]) -> Column:
    return normalize_title(raw, rare_candidates)


# F8-F11 -----------------------------------------------------------------------------------
def presence_flag(c: Column) -> Column:
    return c.isNotNull().cast("int")


def missing_flag(c: Column) -> Column:
    """F18."""
    return c.isNull().cast("int")


def family_size(a: Column, b: Column) -> Column:
    return a + b + F.lit(1)


def is_alone(size: Column) -> Column:
    return (size == 1).cast("int")


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den with den 0 replaced by 1 (negative divisors allowed)."""
    return num.cast("double") / F.when(den != 0, den).otherwise(F.lit(1)).cast("double")


# F12 --------------------------------------------------------------------------------------
def first_letter(c: Column) -> Column:
    return F.nullif(F.substring(c, 1, 1), F.lit(""))


def deck_bucket(c: Column, known: list[str]) -> Column:
    """First letter; NULL/empty -> U; a letter not seen at fit -> Other."""
    raw = first_letter(c)
    seen = raw.isin(known) if known else F.lit(False)
    return F.when(raw.isNull(), F.lit(DECK_UNKNOWN)).when(seen, raw).otherwise(F.lit(DECK_OTHER))


# F13 --------------------------------------------------------------------------------------
def bin_right_closed(x: Column, edges: list[float], labels: list[str]) -> Column:
    """``(edges[i], edges[i+1]]`` gets ``labels[i]``; outside (or null) gives NULL."""
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


# F15 / F16 --------------------------------------------------------------------------------
def log1p_feature(c: Column) -> Column:
    return F.log1p(c.cast("double"))


def coerce_numeric(c: Column) -> Column:
    """Text to number; a value that does not parse becomes NULL."""
    return c.cast("string").try_cast("double")


# F2 / F5 / F7 (fit-time aggregations) ------------------------------------------------------
def rare_values(df: DataFrame, col: Column | str, min_count: int = RARE_MIN_COUNT) -> DataFrame:
    """Values (non-null) with a count below ``min_count``."""
    c = F.col(col) if isinstance(col, str) else col
    return (df.select(c.alias("value")).where(F.col("value").isNotNull())
            .groupBy("value").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") < min_count))


def group_median(df: DataFrame, value: str, group: str) -> DataFrame:
    """Exact median of ``value`` per group (nulls skipped), distributed."""
    q = exact_quantiles(df.select(group, value), value, [0.5], [group])
    return q.select(group, F.col("value").alias("median"))


def mode_value(df: DataFrame, col: str) -> DataFrame:
    """Most frequent non-null value, ties to the smallest (pandas ``mode``).
    Counts first, so a column of any cardinality is handled by the shuffle."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min_by(col, F.struct(-F.col("n"), F.col(col))).alias("mode"))


def _collect_bounded(df: DataFrame, what: str, limit: int = MAX_STATE_VALUES) -> list:
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"fitted state '{what}' has more than {limit} values")
    return rows


# F17 --------------------------------------------------------------------------------------
@dataclass
class FeatureColumns:
    name: str = "name"
    age: str = "age"
    sibsp: str = "sibsp"
    parch: str = "parch"
    fare: str = "fare"
    cabin: str = "cabin"
    embarked: str = "embarked"


@dataclass
class FittedFeatures:
    """Fitted state (all bounded) and the transform that reads it."""
    rare_candidates: list[str]
    age_median_by_title: dict[str, float]
    age_median_overall: float | None
    embarked_mode: str | None
    known_decks: list[str]
    n_train_rows: int
    cols: FeatureColumns = field(default_factory=FeatureColumns)
    version: str = FEATURES_VERSION

    def transform(self, df: DataFrame, check_contract: bool = True) -> DataFrame:
        """Engineered columns appended in fixed order; input columns keep
        their place (age and embarked are imputed in place). A table that breaks
        the contract is refused; the rows of a stream have their own rules."""
        if check_contract and not df.isStreaming:
            from strata.operators.contracts import assert_contract
            assert_contract(df)
        c = self.cols
        title = _title_expr(extract_title(F.col(c.name)), self.rare_candidates)
        med_map = F.create_map(*[x for k, v in sorted(self.age_median_by_title.items())
                                 for x in (F.lit(k), F.lit(float(v)))]) \
            if self.age_median_by_title else None
        age_num = coerce_numeric(F.col(c.age)) if dict(df.dtypes).get(c.age) == "string" \
            else F.col(c.age).cast("double")
        fills = [age_num]
        if med_map is not None:
            fills.append(med_map[F.col("title")])
        fills.append(F.lit(self.age_median_overall).cast("double"))
        fsize = family_size(F.col(c.sibsp), F.col(c.parch))
        original = [x for x in df.columns]
        out = (df.withColumn("title", title)
               .withColumn(c.age, F.coalesce(*fills))
               .withColumn(c.embarked, F.coalesce(F.col(c.embarked), F.lit(self.embarked_mode)))
               .withColumn("has_cabin", presence_flag(F.col(c.cabin)))
               .withColumn("family_size", fsize)
               .withColumn("is_alone", is_alone(F.col("family_size")))
               .withColumn("fare_per_person", guarded_ratio(F.col(c.fare), F.col("family_size")))
               .withColumn("deck", deck_bucket(F.col(c.cabin), self.known_decks))
               .withColumn("age_group", bin_right_closed(F.col(c.age), AGE_BINS, AGE_LABELS)))
        appended = [x for x in ENGINEERED if x not in original]
        return out.select(*original, *appended)

    # S4 -----------------------------------------------------------------------------------
    def to_json(self) -> str:
        d = asdict(self)
        return json.dumps(d, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "FittedFeatures":
        d = json.loads(text)
        d["cols"] = FeatureColumns(**d["cols"])
        return FittedFeatures(**d)

    def save(self, spark: SparkSession, path: str, run_id: str = "") -> None:
        """Write the state as a one-row table with provenance columns."""
        spark.createDataFrame(
            [(self.to_json(), self.version, self.n_train_rows, run_id)],
            "state string, version string, n_train_rows long, run_id string",
        ).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, expect_version: str | None = FEATURES_VERSION) -> "FittedFeatures":
        row = spark.read.parquet(path).first()
        if expect_version and row["version"] != expect_version:
            raise ValueError(f"state version {row['version']} != {expect_version}")
        return FittedFeatures.from_json(row["state"])

    def state_table(self, spark: SparkSession) -> DataFrame:
        """Long view of the state: (kind, key, value)."""
        rows = [("age_median", k, float(v)) for k, v in self.age_median_by_title.items()]
        rows.append(("age_median_overall", None, self.age_median_overall))
        rows += [("known_deck", d, None) for d in self.known_decks]
        rows += [("rare_candidate", t, None) for t in self.rare_candidates]
        return spark.createDataFrame(rows, "kind string, key string, value double")


class CohortFeatures:
    """Estimator: ``fit`` on the training split only."""

    def __init__(self, cols: FeatureColumns | None = None, round_digits: int | None = 2):
        self.cols = cols or FeatureColumns()
        self.round_digits = round_digits

    def fit(self, train: DataFrame, check_contract: bool = True) -> FittedFeatures:
        if check_contract:
            from strata.operators.contracts import assert_contract
            assert_contract(train)
        c = self.cols
        raw = train.select(extract_title(F.col(c.name)).alias("raw_title"),
                           F.col(c.age).cast("double").alias("age"), F.col(c.embarked).alias("emb"),
                           first_letter(F.col(c.cabin)).alias("deck")).cache()
        try:
            # one job: candidate-title counts, deck letters and row count
            # (bounded: at most 9 title values x distinct first letters)
            summary = _collect_bounded(
                raw.groupBy(F.when(F.col("raw_title").isin(TITLE_CANDIDATES), F.col("raw_title")).alias("t"),
                            "deck").agg(F.count(F.lit(1)).alias("n")), "title / deck counts")
            counts: dict[str, int] = {}
            for r in summary:
                if r["t"] is not None:
                    counts[r["t"]] = counts.get(r["t"], 0) + r["n"]
            rare = sorted(t for t, k in counts.items() if k < RARE_MIN_COUNT)
            decks = sorted({r["deck"] for r in summary if r["deck"] is not None})
            n = sum(r["n"] for r in summary)
            # medians per title and overall in one distributed quantile pass
            titled = raw.select(_title_expr(F.col("raw_title"), rare).alias("g"), "age")
            both = titled.unionByName(raw.select(F.lit(None).cast("string").alias("g"), "age")
                                      .withColumn("g", F.lit("\u0000overall")))
            med = exact_quantiles(both, "age", [0.5], ["g"], n_groups=len(KNOWN_TITLES) + 1)
            if self.round_digits is not None:
                med = med.withColumn("value", F.round("value", self.round_digits))
            meds = {r["g"]: r["value"] for r in _collect_bounded(med, "age medians")}
            overall_v = meds.pop("\u0000overall", None)
            by_title = {k: v for k, v in meds.items() if v is not None}
            mode_row = mode_value(raw, "emb").first()
        finally:
            raw.unpersist()
        return FittedFeatures(rare, by_title, overall_v, mode_row["mode"] if mode_row else None,
                              decks, n, c)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


# F6b --------------------------------------------------------------------------------------
def impute_window_median(df: DataFrame, value: str, group: Column | str, out: str | None = None) -> DataFrame:
    """Fill ``value`` with its group median computed from the same table
    (profiling form; leaky for modelling). The medians are an aggregate
    joined back, not a window, so a hot group is not one task."""
    g = F.col(group) if isinstance(group, str) else group
    tagged = df.withColumn("_g", g)
    med = exact_quantiles(tagged.select("_g", value), value, [0.5], ["_g"]).select(
        "_g", F.col("value").alias("_med"))
    return (tagged.join(med, "_g", "left")
            .withColumn(out or value, F.coalesce(F.col(value).cast("double"), F.col("_med")))
            .drop("_g", "_med"))


# F21 / F22 / F23 -------------------------------------------------------------------------
def standardize(df: DataFrame, cols: list[str], fit_df: DataFrame | None = None) -> DataFrame:
    """Population-std scaling (zero variance -> scale 1) fitted on ``fit_df``."""
    src = fit_df if fit_df is not None else df
    stats = src.agg(*[F.avg(c).alias(f"{c}__mu") for c in cols],
                    *[F.stddev_pop(c).alias(f"{c}__sd") for c in cols])
    out = df.crossJoin(F.broadcast(stats))  # one row
    for c in cols:
        sd = F.when(F.col(f"{c}__sd") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__sd"))
        out = out.withColumn(f"{c}_scaled", (F.col(c) - F.col(f"{c}__mu")) / sd)
    return out.drop(*[f"{c}__mu" for c in cols], *[f"{c}__sd" for c in cols])


def one_hot(df: DataFrame, col: str, levels: list[str], prefix: str | None = None) -> DataFrame:
    """Wide 0/1 columns for the given (fitted) levels; unknown -> all zeros."""
    p = prefix or col
    return df.withColumns({f"{p}_{lv}": F.coalesce((F.col(col).cast("string") == F.lit(str(lv))).cast("int"),
                                                   F.lit(0))
                           for lv in levels})


def fitted_levels(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct non-null levels (bounded) for one-hot / label codes."""
    rows = _collect_bounded(df.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("v"))
                            .distinct(), f"levels of {col}")
    return sorted(r["v"] for r in rows)


def _long(df: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols]))
    return df.select(*key, pairs.alias("_p")).select(*key, "_p.feature", "_p.value").where(F.col("value").isNotNull())


def level_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fitted levels of any number as a written table ``(feature, value, n, code)``: how many rows
    have the value, and its place among the feature's values in the order of their text."""
    from strata.functions.ranks import cumulative, materialize

    counts = _long(df, [], cols).groupBy("feature", "value").agg(F.count("*").alias("n")).withColumn("_one", F.lit(1))
    return materialize(cumulative(counts, "value", ["_one"], ["feature"], n_groups=len(cols)).select(
        "feature", "value", "n", (F.col("cum__one") - 1).cast("long").alias("code")))


def one_hot_sparse(df: DataFrame, key: list[str], cols: list[str], levels: DataFrame, heavy: int = 1000) -> DataFrame:
    """The ones of a one-hot matrix in long form, ``(*key, feature, value, code)``, for levels from ``level_table``.

    Nulls and values that were not fitted give no row. Levels that hold at least one ``heavy``-th of
    their feature's fitted rows (so at most ``heavy`` a feature) are broadcast; only rows of
    other values are shuffled to their level, so no task gets a hot one.
    """
    from strata.functions.ranks import bounded_broadcast

    total = bounded_broadcast(levels.groupBy("feature").agg(F.sum("n").alias("_all")), known_rows=len(cols))
    hot = F.col("n") * heavy >= F.col("_all")
    ranked = levels.join(total, "feature")
    often = bounded_broadcast(ranked.where(hot).select("feature", "value", F.col("code").alias("_hot")),
                              known_rows=heavy * len(cols))
    rows = _long(df, key, cols).join(often, ["feature", "value"], "left")
    seldom = ranked.where(~hot).select("feature", "value", "code")
    out = [*key, "feature", "value", "code"]
    return (rows.where(F.col("_hot").isNotNull()).withColumnRenamed("_hot", "code").select(*out)
            .unionByName(rows.where(F.col("_hot").isNull()).join(seldom, ["feature", "value"]).select(*out)))


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Integer code = position of the value in alphabetical order of the
    distinct values (as text). Distinct values are ranked with the bucketed
    prefix sum and joined back, so no single task sees all of them."""
    from strata.functions.ranks import cumulative

    distinct = (df.select(F.col(col).cast("string").alias("_v")).where(F.col("_v").isNotNull())
                .distinct().withColumn("cnt", F.lit(1)))
    codes = cumulative(distinct, "_v", ["cnt"]).select(
        "_v", (F.col("cum_cnt") - 1).cast("int").alias("_code"))
    return (df.withColumn("_v", F.col(col).cast("string")).join(codes, "_v", "left")
            .withColumnRenamed("_code", out or f"{col}_code").drop("_v"))
