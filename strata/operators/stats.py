"""Statistical tests and association measures.

Every statistic is an aggregation over the data (cells, moments, ranks);
only the final per-feature rows (a few dozen) get p-values, through the
Arrow UDFs of ``functions.special``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.ranks import cumulative, exact_quantiles, label_counts, materialize, midranks
from strata.functions.special import chi2_sf_udf, f_sf_udf, norm_sf2_udf, t_sf2_udf
from strata.operators.information import knn_information
from strata.operators.profile import _long_numeric, contingency


# T1-T3 ------------------------------------------------------------------------------------
def chi_square_cells(cells: DataFrame, group: str, row: str, col: str, n: str = "n") -> DataFrame:
    """Chi-square of independence per ``group`` from a long table of cell
    counts that already holds the zero cells. Yates correction when
    dof = 1 (scipy default). Returns group, chi2, dof, n, min_expected,
    expected_lt5, cramers_v."""
    rows = cells.groupBy(group, row).agg(F.sum(n).alias("_r"))
    cols = cells.groupBy(group, col).agg(F.sum(n).alias("_c"))
    tot = cells.groupBy(group).agg(F.sum(n).alias("_n"))
    shape = (rows.groupBy(group).agg(F.count(F.lit(1)).alias("_nrows"))
             .join(cols.groupBy(group).agg(F.count(F.lit(1)).alias("_ncols")), group))
    e = (cells.join(rows, [group, row]).join(cols, [group, col]).join(tot, group).join(shape, group)
         .withColumn("_e", F.col("_r").cast("double") * F.col("_c") / F.col("_n"))
         .withColumn("_dof", (F.col("_nrows") - 1) * (F.col("_ncols") - 1)))
    diff = F.abs(F.col(n) - F.col("_e"))
    adj = F.when(F.col("_dof") == 1, diff - F.least(F.lit(0.5), diff)).otherwise(diff)
    out = e.groupBy(group).agg(
        F.sum(adj * adj / F.col("_e")).alias("chi2"), F.first("_dof").alias("dof"),
        F.first("_n").alias("n"), F.min("_e").alias("min_expected"),
        F.bool_or(F.col("_e") < 5).alias("expected_lt5"),
        F.first(F.least("_nrows", "_ncols")).alias("_k"))
    # a feature with one level has no association measure (NULL, not an error)
    return out.withColumn(
        "cramers_v", F.sqrt(F.try_divide(F.col("chi2") / F.col("n"), (F.col("_k") - 1).cast("double")))).drop("_k")


def chi_square(df: DataFrame, features: list[str], label: str, with_p: bool = False) -> DataFrame:
    """T1/T2/T3 for several categorical features in one aggregation."""
    cells = materialize(contingency(df, features, label))  # read five times: counted once
    out = chi_square_cells(cells, "feature", "level", label)
    if with_p:
        out = out.withColumn("p_value", chi2_sf_udf(F.col("chi2"), F.col("dof").cast("double")))
    return out


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson r over the rows where both are present; NULL if one of them is constant there."""
    both = a.isNotNull() & b.isNotNull()
    sd = F.stddev_pop(F.when(both, a)) * F.stddev_pop(F.when(both, b))
    r = F.try_divide(F.covar_pop(a, b), sd)
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


# T4 ---------------------------------------------------------------------------------------
def point_biserial(df: DataFrame, features: list[str], label: str, with_p: bool = False) -> DataFrame:
    """Pearson r of each numeric with a 0/1 label (pairwise non-null), t
    statistic with n - 2 dof."""
    long = _long_numeric(df, features, [label]).where(
        F.col("value").isNotNull() & F.col(label).isNotNull())
    agg = long.groupBy(F.col("column").alias("feature")).agg(
        safe_corr(F.col(label).cast("double"), F.col("value")).alias("r"), F.count(F.lit(1)).alias("n"))
    out = agg.withColumn("t", F.col("r") * F.sqrt(F.try_divide((F.col("n") - 2).cast("double"),
                                                              1 - F.col("r") * F.col("r"))))
    if with_p:
        out = out.withColumn("p_value", t_sf2_udf(F.col("t"), (F.col("n") - 2).cast("double")))
    return out


# T6 / T7 / T14 ----------------------------------------------------------------------------
def decide(p: str = "p_value", caveat: str = "has_caveat", nonlinear_p: str = "nonlinear_p",
           alpha: float = 0.05):
    """keep / keep-with-caveat / drop rule as a column expression."""
    sig = F.col(p) < alpha
    nl = F.col(nonlinear_p).isNotNull() & (F.col(nonlinear_p) < alpha)
    return (F.when(sig & ~F.col(caveat), "keep")
            .when(sig | F.col(caveat) | nl, "keep-with-caveat")
            .otherwise("drop"))


def feature_audit(df: DataFrame, categorical: list[str], numeric: list[str], label: str,
                  with_p: bool = False, count_features: list[str] | None = None,
                  caveats: dict[str, str] | None = None, alpha: float = 0.05) -> DataFrame:
    """One row per feature, the largest effect first: test, statistic, effect size, expected<5
    flag; with ``with_p`` also p-value, non-linear re-check of count
    features (chi-square on the count as categories), decision, and the
    Bonferroni-adjusted significance over all tested features."""
    chi = chi_square(df, categorical, label, with_p).select(
        "feature", F.lit("chi-square").alias("test"), F.col("chi2").alias("statistic"),
        F.col("cramers_v").alias("effect_size"), F.lit("Cramer's V").alias("effect_label"),
        "expected_lt5", *(["p_value"] if with_p else []))
    pb = point_biserial(df, numeric, label, with_p).select(
        "feature", F.lit("point-biserial").alias("test"), F.col("r").alias("statistic"),
        F.abs("r").alias("effect_size"), F.lit("|r|").alias("effect_label"),
        F.lit(None).cast("boolean").alias("expected_lt5"), *(["p_value"] if with_p else []))
    out = chi.unionByName(pb)
    if not with_p:
        return out.orderBy(F.desc_nulls_last("effect_size"), "feature")
    counts = count_features or []
    if counts:
        nl = chi_square(df, counts, label, True).select("feature", F.col("p_value").alias("nonlinear_p"))
        out = out.join(F.broadcast(nl), "feature", "left")  # one row per count feature
    else:
        out = out.withColumn("nonlinear_p", F.lit(None).cast("double"))
    cav = caveats or {}
    has_cav = F.col("feature").isin(list(cav)) if cav else F.lit(False)
    m = len(categorical) + len(numeric)
    return (out.withColumn("has_caveat", has_cav)
            .withColumn("decision", decide(alpha=alpha))
            .withColumn("bonferroni_alpha", F.lit(alpha / m))
            .withColumn("significant_bonferroni", F.col("p_value") < F.lit(alpha / m))
            .orderBy(F.desc_nulls_last("effect_size"), "feature"))


# T8-T10, T13 ------------------------------------------------------------------------------
def group_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    return (df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(group)
            .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(value).cast("double")).alias("mean"),
                 F.var_samp(F.col(value).cast("double")).alias("var")))


def levene(df: DataFrame, group: str, value: str, with_p: bool = False) -> DataFrame:
    """Brown-Forsythe (median-centred Levene) W over the groups."""
    base = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).select(
        group, F.col(value).cast("double").alias("x"))
    med = exact_quantiles(base, "x", [0.5], [group]).select(group, F.col("value").alias("_med"))
    # one row per group: left to adaptive execution, which broadcasts it
    # after measuring (the number of groups is not bounded in general)
    z = base.join(med, group).withColumn("z", F.abs(F.col("x") - F.col("_med")))
    per = z.groupBy(group).agg(F.count(F.lit(1)).alias("n_j"), F.avg("z").alias("zbar_j"))
    zz = z.join(per, group)
    tot = zz.agg(F.count(F.lit(1)).alias("N"), F.avg("z").alias("zbar"),
                 F.sum((F.col("z") - F.col("zbar_j")) ** 2).alias("ssw"),
                 F.countDistinct(group).alias("k"))
    ssb = per.crossJoin(tot).groupBy("N", "k", "ssw").agg(
        F.sum(F.col("n_j") * (F.col("zbar_j") - F.col("zbar")) ** 2).alias("ssb"))
    out = ssb.select(F.try_divide((F.col("N") - F.col("k")) * F.col("ssb"),
                                  (F.col("k") - 1) * F.col("ssw")).alias("w"),
                     (F.col("k") - 1).alias("df1"), (F.col("N") - F.col("k")).alias("df2"))
    if with_p:
        out = out.withColumn("p_value", f_sf_udf("w", F.col("df1").cast("double"), F.col("df2").cast("double")))
    return out


def two_group_moments(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """One row with n, mean, var of the two groups ``a`` and ``b``."""
    st = group_stats(df.where(F.col(group).isin([a, b])), group, value)
    g = F.col(group)
    return st.agg(*[F.first(F.when(g == v, F.col(c)), ignorenulls=True).alias(f"{c}_{s}")
                    for v, s in ((a, "a"), (b, "b")) for c in ("n", "mean", "var")])


def t_test(df: DataFrame, group: str, value: str, a, b, with_p: bool = False) -> DataFrame:
    """Welch and pooled two-sample t (mean_a - mean_b) with their dof."""
    m = two_group_moments(df, group, value, a, b)
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    va, vb = F.col("var_a"), F.col("var_b")
    diff = F.col("mean_a") - F.col("mean_b")
    se_w = F.sqrt(va / na + vb / nb)
    sp2 = ((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)
    out = m.select(
        F.try_divide(diff, se_w).alias("t_welch"),
        ((va / na + vb / nb) ** 2 / ((va / na) ** 2 / (na - 1) + (vb / nb) ** 2 / (nb - 1))).alias("df_welch"),
        F.try_divide(diff, F.sqrt(sp2 * (1 / na + 1 / nb))).alias("t_pooled"),
        (na + nb - 2).alias("df_pooled"))
    if with_p:
        out = (out.withColumn("p_welch", t_sf2_udf("t_welch", "df_welch"))
               .withColumn("p_pooled", t_sf2_udf("t_pooled", "df_pooled")))
    return out


def t_test_auto(df: DataFrame, group: str, value: str, a, b, alpha: float = 0.05) -> DataFrame:
    """T9 as in the reference: Welch when Levene p <= alpha, else pooled."""
    lev = levene(df.where(F.col(group).isin([a, b])), group, value, True).select(
        F.col("p_value").alias("levene_p"))
    t = t_test(df, group, value, a, b, True)
    eq = F.col("levene_p") > alpha
    return t.crossJoin(lev).select(
        "levene_p", eq.alias("equal_var"),
        F.when(eq, F.col("t_pooled")).otherwise(F.col("t_welch")).alias("t"),
        F.when(eq, F.col("p_pooled")).otherwise(F.col("p_welch")).alias("p_value"))


def cohens_d(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """(mean_a - mean_b) / pooled sample std."""
    m = two_group_moments(df, group, value, a, b)
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    sp = F.sqrt(((na - 1) * F.col("var_a") + (nb - 1) * F.col("var_b")) / (na + nb - 2))
    return m.select(F.try_divide(F.col("mean_a") - F.col("mean_b"), sp).alias("cohens_d"))


def anova(df: DataFrame, group: str, value: str, with_p: bool = False) -> DataFrame:
    """One-way ANOVA F over all groups. Values are taken relative to the
    overall mean, so a large common offset costs no digits."""
    rows = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).select(
        F.col(group).alias("g"), F.col(value).cast("double").alias("x"))
    mean = rows.agg(F.avg("x").alias("m"))  # one row
    st = rows.crossJoin(F.broadcast(mean)).groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("x") - F.col("m")).alias("d"), F.var_pop("x").alias("v"))
    n = F.col("n").cast("double")
    tot = st.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"), F.sum(n * F.col("d") * F.col("d")).alias("ssb"),
                 F.sum(n * F.col("v")).alias("ssw"))
    ssb, ssw = F.col("ssb"), F.col("ssw")
    out = tot.select(F.try_divide(ssb / (F.col("k") - 1), ssw / (F.col("N") - F.col("k"))).alias("f"),
                     (F.col("k") - 1).alias("df1"), (F.col("N") - F.col("k")).alias("df2"))
    if with_p:
        out = out.withColumn("p_value", f_sf_udf("f", F.col("df1").cast("double"), F.col("df2").cast("double")))
    return out


# T11 --------------------------------------------------------------------------------------
def normality_jb(df: DataFrame, cols: list[str], with_p: bool = False) -> DataFrame:
    """Jarque-Bera on the full column: n/6 (S^2 + K^2 / 4), S and K the
    population skewness and excess kurtosis."""
    long = _long_numeric(df, cols).where(F.col("value").isNotNull())
    agg = long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.skewness("value").alias("s"),
                                     F.kurtosis("value").alias("k"))
    out = agg.select("column", "n", (F.col("n") / 6.0 * (F.col("s") ** 2 + F.col("k") ** 2 / 4.0)).alias("jb"))
    if with_p:
        out = out.withColumn("p_value", chi2_sf_udf("jb", F.lit(2.0)))
    return out


# T12 --------------------------------------------------------------------------------------
def mann_whitney(df: DataFrame, group: str, value: str, a, b, with_p: bool = False) -> DataFrame:
    """Two-sided Mann-Whitney U with tie correction and continuity
    correction (normal approximation). ``u`` is U of sample ``a``."""
    base = df.where(F.col(group).isin([a, b]) & F.col(value).isNotNull()).select(
        F.col(value).alias("v"), (F.col(group) == F.lit(a)).cast("int").alias("_is_a"))
    mr = midranks(base, "v", label_col="_is_a")  # pos = rows of a
    agg = mr.agg(F.sum(F.col("pos") * F.col("midrank")).alias("r_a"), F.sum("pos").alias("n_a"),
                 F.sum("neg").alias("n_b"),
                 F.sum(F.col("cnt").cast("double") ** 3 - F.col("cnt")).alias("ties"))
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = na + nb
    u = F.col("r_a") - na * (na + 1) / 2
    mu = na * nb / 2
    sigma = F.sqrt(na * nb / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    u_max = F.greatest(u, na * nb - u)
    out = agg.select(u.alias("u"), F.try_divide(u_max - mu - 0.5, sigma).alias("z"))
    if with_p:
        out = out.withColumn("p_value", F.least(F.lit(1.0), norm_sf2_udf("z")))
    return out


# T15 / T16 --------------------------------------------------------------------------------
def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(a, b, n, r)`` for every pair of columns, a column with itself included, over the rows where both are present.

    One pass whatever the number of columns (after the means, which the values
    are taken from first): a task adds up p x p products of its Arrow batches
    for counts, sums, squares and products, and hands on a row for each column.
    ``r`` is NULL where one of the two is constant.
    """
    p = len(cols)
    dd = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    means = dd.agg(*[F.avg(f"c{i}") for i in range(p)]).first()
    shift = np.array([0.0 if m is None else m for m in means])

    def run(batches):
        total = np.zeros((4, p, p))
        for b in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1) - shift
            here = ~np.isnan(x)
            x[~here] = 0.0
            m = here.astype(np.float64)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        n, s, q, xy = total
        rows = np.concatenate([n, s, s.T, q, q.T, xy], axis=1)
        yield pa.record_batch({"i": pa.array(np.arange(p)), "v": pa.array(rows.tolist(), pa.list_(pa.float64()))})

    def finish(pdf):
        i = int(pdf["i"].iloc[0])
        n, s, t, q, r, xy = (v[i:] for v in np.sum(np.stack(pdf["v"].tolist()), axis=0).reshape(6, p))
        with np.errstate(invalid="ignore", divide="ignore"):
            va, vb = n * q - s * s, n * r - t * t
            flat = (va <= 1e-12 * n * q) | (vb <= 1e-12 * n * r) | (n == 0)
            rho = np.where(flat, np.nan, np.clip((n * xy - s * t) / np.sqrt(np.where(flat, 1, va * vb)), -1, 1))
        return pd.DataFrame({"a": cols[i], "b": cols[i:], "n": n.astype(np.int64),
                             "r": pd.Series(rho).astype(object).where(~flat, None)})

    sums = dd.mapInArrow(run, "i long, v array<double>")
    return sums.groupBy("i").applyInPandas(finish, "a string, b string, n long, r double")


def pearson_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-deletion Pearson r for every pair a < b, in one pass."""
    return correlations(df, cols).where(F.col("a") != F.col("b")).select("a", "b", "r")


def spearman_matrix(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """Spearman rho = Pearson r of mid-ranks, ranks recomputed on the rows
    where both columns of a pair are present (pairwise deletion)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    parts = [df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
             .select(F.lit(f"{a}|{b}").alias("pair"), F.col(key).alias("_k"),
                     F.col(a).cast("double").alias("va"), F.col(b).cast("double").alias("vb"))
             for a, b in pairs]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    # both sides of every pair ranked in one distributed pass, grouped by (pair, side)
    sides = (long.select("pair", F.lit("a").alias("side"), F.col("va").alias("v"))
             .unionByName(long.select("pair", F.lit("b").alias("side"), F.col("vb").alias("v"))))
    mr = midranks(sides, "v", ["pair", "side"])
    ra = mr.where(F.col("side") == "a").select("pair", F.col("v").alias("va"), F.col("midrank").alias("ra"))
    rb = mr.where(F.col("side") == "b").select("pair", F.col("v").alias("vb"), F.col("midrank").alias("rb"))
    ranked = long.join(ra, ["pair", "va"]).join(rb, ["pair", "vb"])
    out = ranked.groupBy("pair").agg(safe_corr(F.col("ra"), F.col("rb")).alias("rho"))
    return out.select(F.split("pair", r"\|")[0].alias("a"), F.split("pair", r"\|")[1].alias("b"), "rho")


# T17 --------------------------------------------------------------------------------------
def vif(df: DataFrame, cols: list[str]) -> DataFrame:
    """Variance inflation factors 1 / (1 - R^2) of each column regressed on
    the others, over the complete cases. The p x p correlation matrix takes one
    pass; each regression is solved on the driver by least squares that
    allow for collinear regressors (p is the number of columns). 1 - R^2 below 1e-10 gives
    infinity for the columns concerned only; a constant column has no factor
    (NULL) and does not enter the others."""
    spark = df.sparkSession
    cc = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).na.drop()
    r = {(x["a"], x["b"]): x["r"] for x in correlations(cc, cols).collect()}  # p (p + 1) / 2 rows
    varies = [c for c in cols if r.get((c, c)) is not None]
    m = np.array([[r[(a, b)] if (a, b) in r else r[(b, a)] for b in varies] for a in varies])
    rows = []
    for c in cols:
        if c not in varies:
            rows.append((c, None))
            continue
        i = varies.index(c)
        rest = [j for j in range(len(varies)) if j != i]
        r = m[rest, i]
        left = 1.0 - float(r @ np.linalg.pinv(m[np.ix_(rest, rest)], rcond=1e-10, hermitian=True) @ r) if rest else 1.0
        rows.append((c, float("inf") if left < 1e-10 else 1.0 / left))
    return spark.createDataFrame(rows, "feature string, vif double").withColumn(
        "high", F.col("vif") > 5)


# T18 --------------------------------------------------------------------------------------
def mutual_information(df: DataFrame, discrete: list[str], continuous: list[str], label: str, k: int = 3) -> DataFrame:
    """MI (nats) of each feature with the label, largest first: discrete
    features from their cells, continuous ones by their ``k`` nearest neighbours."""
    cells = materialize(contingency(df, discrete, label))
    tot = cells.groupBy("feature").agg(F.sum("n").alias("_n"))
    px = cells.groupBy("feature", "level").agg(F.sum("n").alias("_nx"))
    py = cells.groupBy("feature", label).agg(F.sum("n").alias("_ny"))
    j = cells.where(F.col("n") > 0).join(tot, "feature").join(px, ["feature", "level"]).join(py, ["feature", label])
    n, n_x, n_y = (F.col(c).cast("double") for c in ("_n", "_nx", "_ny"))  # products pass 2^63
    term = F.col("n") / n * F.log(F.col("n") * n / (n_x * n_y))
    out = j.groupBy("feature").agg(F.sum(term).alias("mi"))
    return out.unionByName(knn_information(df, continuous, label, k)).orderBy(F.desc("mi"), "feature")


def _normal_cdf(x: Column) -> Column:
    @F.pandas_udf("double")
    def cdf(z: pd.Series) -> pd.Series:
        return pd.Series([0.5 * math.erfc(-v / math.sqrt(2.0)) for v in z], dtype="float64")

    return cdf(x)


def _modified(d, n):
    """Stephens' form of the statistic, whose null distribution hardly depends on ``n``."""
    root = np.sqrt(n)
    return d * (root - 0.01 + 0.85 / root)


def null_distance(draw: int, n: int) -> float:
    """Modified distance of the ``draw``-th normal sample of ``n`` rows from its own fitted normal distribution."""
    z = np.sort(np.random.default_rng([7, draw]).standard_normal(n))
    z = (z - z.mean()) / z.std(ddof=1)
    p = np.array([0.5 * math.erfc(-v / math.sqrt(2.0)) for v in z])
    k = np.arange(n)
    return float(_modified(max(((k + 1) / n - p).max(), (p - k / n).max()), n))


def normality_ks(df: DataFrame, col: str, draws: int = 2000, draw_rows: int = 1000) -> DataFrame:
    """``(column, n, statistic, p_value)``: Kolmogorov-Smirnov distance of a column from the normal
    distribution with its own mean and sample deviation, and its p-value given that both are estimated (Lilliefors).

    The distance comes from the running counts of the distinct values (written
    ranges, no window over all rows). The p-value is the share of ``draws`` normal samples of
    ``min(n, draw_rows)`` rows, seeded by their number, whose modified statistic is as large. NULL and NaN are left out;
    a constant column has neither statistic nor p-value.
    """
    x = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    moments = x.agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mu"), F.stddev_samp("x").alias("sd"))
    cum = cumulative(label_counts(x, "x"), "x", ["cnt"]).crossJoin(F.broadcast(moments))  # one row
    p = _normal_cdf((F.col("x") - F.col("mu")) / F.col("sd"))
    gap = (cum.where(F.col("sd") > 0).select("cum_cnt", "cnt", "n", p.alias("p"))
           .agg(F.max(F.greatest(F.col("cum_cnt") / F.col("n") - F.col("p"),
                                 F.col("p") - (F.col("cum_cnt") - F.col("cnt")) / F.col("n"))).alias("statistic")))
    one = moments.crossJoin(F.broadcast(gap)).select("n", "statistic")
    size = F.least(F.col("n"), F.lit(draw_rows))

    def draw(batches):
        for b in batches:
            out = [null_distance(i, n) for i, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.record_batch({"drawn": pa.array(out, pa.float64())})

    sizes = (df.sparkSession.range(draws).crossJoin(F.broadcast(one.select(size.alias("size"))))
             .where("size > 1").select("id", "size"))
    root = F.sqrt(F.col("n").cast("double"))
    seen = one.withColumn("seen", F.col("statistic") * (root - 0.01 + 0.85 / root))
    share = (sizes.mapInArrow(draw, "drawn double").crossJoin(F.broadcast(seen.select("seen")))
             .agg(((F.count_if(F.col("drawn") >= F.col("seen")) + 1) / (F.count(F.lit(1)) + 1)).alias("share")))
    return one.crossJoin(F.broadcast(share)).select(
        F.lit(col).alias("column"), "n", "statistic", F.when(F.col("statistic").isNotNull(), F.col("share")).alias("p_value"))
