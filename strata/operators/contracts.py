"""Table contracts and row constraints (V1-V3).

V1 reports every problem of a table at once as rows ``(column, problem,
detail)``: schema problems come from ``df.schema`` on the driver, null
counts and non-null counts from one aggregation over the data.
V2 tags each row with the list of rules it breaks and splits the table into
valid rows and a quarantine (no row is dropped).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dtype_kind(dt: T.DataType) -> str:
    """numpy-style kind letter of a Spark type."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "i"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "f"
    if isinstance(dt, T.BooleanType):
        return "b"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "M"
    return "O"


@dataclass
class Contract:
    required: list[str]
    nullable: set[str] = field(default_factory=set)
    optional: set[str] = field(default_factory=set)
    kinds: dict[str, str] = field(default_factory=dict)


# The raw passenger-table contract, in the cohort's column names.
COHORT_CONTRACT = Contract(
    required=["pclass", "name", "sex", "age", "sibsp", "parch", "fare", "cabin", "embarked"],
    nullable={"age", "cabin", "embarked"},
    optional={"id", "label", "ticket", "split", "fold"},
    kinds={"pclass": "iu", "name": "O", "sex": "O", "age": "fiu", "sibsp": "iu", "parch": "iu",
           "fare": "fiu", "cabin": "O", "embarked": "O"},
)

REPORT_SCHEMA = "column string, problem string, detail string"


def contract_report(df: DataFrame, contract: Contract = COHORT_CONTRACT) -> DataFrame:
    """V1: all contract problems as rows (empty when the table conforms)."""
    spark = df.sparkSession
    cols = set(df.columns)
    schema_rows = [(c, "missing", "must be present") for c in contract.required if c not in cols]
    schema_rows += [(c, "unexpected", "not among the columns of the contract")
                    for c in sorted(cols - set(contract.required) - contract.optional)]
    present = [c for c in contract.required if c in cols]
    fixed = spark.createDataFrame(schema_rows, REPORT_SCHEMA)
    if not present:
        return fixed
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count_if(F.col(c).isNull()).alias(f"nulls__{c}") for c in present]
    aggs += [F.count(F.col(c)).alias(f"nonnull__{c}") for c in present]
    wide = df.agg(*aggs)
    rows = []
    for c in present:
        if c not in contract.nullable:
            rows.append(F.when(F.col(f"nulls__{c}") > 0, F.struct(
                F.lit(c).alias("column"), F.lit("nulls").alias("problem"),
                F.concat(F.col(f"nulls__{c}").cast("string"), F.lit(" rows without a value")).alias("detail"))))
        want = contract.kinds.get(c)
        kind = dtype_kind(types[c])
        if want and kind not in want:
            rows.append(F.when(F.col(f"nonnull__{c}") > 0, F.struct(
                F.lit(c).alias("column"), F.lit("dtype").alias("problem"),
                F.lit(f"is {types[c].simpleString()}, one of {', '.join(want)} is due").alias("detail"))))
    if not rows:
        return fixed
    found = wide.select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")
    return fixed.unionByName(found)


def assert_contract(df: DataFrame, contract: Contract = COHORT_CONTRACT) -> None:
    """Raise one ValueError naming every problem (bounded: a few per column)."""
    problems = contract_report(df, contract).collect()
    if problems:
        lines = [f"{r['column']}: {r['problem']} ({r['detail']})" for r in problems]
        raise ValueError("contract check failed:\n- " + "\n- ".join(lines))


# V2 / V3 ----------------------------------------------------------------------------------
@dataclass
class Rule:
    column: str
    allowed: list | None = None
    ge: float | None = None
    le: float | None = None
    required: bool = True
    default: object = None


# The scoring request record.
REQUEST_RULES = [
    Rule("pclass", allowed=[1, 2, 3]),
    Rule("sex", allowed=["male", "female"]),
    Rule("age", ge=0, le=100),
    Rule("sibsp", ge=0),
    Rule("parch", ge=0),
    Rule("fare", ge=0),
    Rule("embarked", allowed=["C", "Q", "S"], required=False, default="S"),
    Rule("has_cabin", required=False, default=False),
    Rule("title", allowed=["Mr", "Mrs", "Miss", "Master", "Rare"], required=False, default="Mr"),
]


def _rule_checks(rule: Rule) -> list[Column]:
    c = F.col(rule.column)
    out = []
    if rule.required:
        out.append(F.when(c.isNull(), F.lit(f"{rule.column}: required")))
    if rule.allowed is not None:
        out.append(F.when(c.isNotNull() & ~c.isin(rule.allowed), F.lit(f"{rule.column}: not allowed")))
    if rule.ge is not None:
        out.append(F.when(c < F.lit(rule.ge), F.lit(f"{rule.column}: below {rule.ge:g}")))
    if rule.le is not None:
        out.append(F.when(c > F.lit(rule.le), F.lit(f"{rule.column}: above {rule.le:g}")))
    return out


def apply_defaults(df: DataFrame, rules: list[Rule] = REQUEST_RULES) -> DataFrame:
    """V3: omitted optional fields take their default (missing column or NULL)."""
    out = df
    for r in rules:
        if r.default is None:
            continue
        if r.column in df.columns:
            out = out.withColumn(r.column, F.coalesce(F.col(r.column), F.lit(r.default)))
        else:
            out = out.withColumn(r.column, F.lit(r.default))
    return out


def row_violations(df: DataFrame, rules: list[Rule] = REQUEST_RULES,
                   out_col: str = "violations") -> DataFrame:
    """V2: array of broken rules per row (empty array = valid)."""
    checks = [x for r in rules if r.column in df.columns for x in _rule_checks(r)]
    missing = [F.lit(f"{r.column}: required") for r in rules if r.required and r.column not in df.columns]
    return df.withColumn(out_col, F.array_compact(F.array(*missing, *checks)))


def split_valid(df: DataFrame, rules: list[Rule] = REQUEST_RULES) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their violations)."""
    tagged = row_violations(apply_defaults(df, rules), rules)
    return (tagged.where(F.size("violations") == 0).drop("violations"),
            tagged.where(F.size("violations") > 0))
