"""What a model needs to score raw rows, kept as one object: encoding, missing values, feature order, scalings, trees."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from agroflow.operators.boosting import LeafwiseModel
from agroflow.operators.encoding import apply_encoding, encode, fit_encode, read_dictionary, write_dictionary
from agroflow.operators.rows import require_columns
from agroflow.operators.targets import TargetScaling

MISSING_FLAG = "_missing"


def assemble_features(df: DataFrame, columns: Sequence[str], missing: str = "error") -> DataFrame:
    """Feature vector column; ``missing="keep"`` lets NULLs through as NaN instead of failing."""
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid=missing).transform(df)


def _value(column: str):
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None))


@dataclass(frozen=True)
class Imputation:
    """What stands in for a missing value of each feature, and the features that get a 0/1 column beside them."""

    means: Mapping[str, float]
    flagged: tuple[str, ...]

    def flags(self) -> list[str]:
        return [f"{c}{MISSING_FLAG}" for c in self.flagged]

    def apply(self, df: DataFrame, known: bool = False) -> DataFrame:
        """Missing values filled, and a 0/1 column beside each feature that had any when the means were taken.

        With ``known`` the rows are among those that the flags were taken from: no other feature misses a value, and the
        others are not looked at, which would make the generated code too long for the JVM to compile.
        """
        flags = {f"{c}{MISSING_FLAG}": _value(c).isNull().cast("int") for c in self.flagged}
        filled = {
            c: F.col(f"`{c}`").cast("double") if known and c not in self.flagged else F.coalesce(_value(c), F.lit(float(m)))
            for c, m in self.means.items()
        }
        return df.withColumns(flags).withColumns(filled) if self.means else df


@dataclass(frozen=True)
class ColumnStats:
    """Rows, values, mean and greatest value of each column, of one part of a table."""

    rows: int
    counts: Mapping[str, int]
    means: Mapping[str, float]
    tops: Mapping[str, float]

    def gaps(self) -> tuple[str, ...]:
        return tuple(c for c, n in self.counts.items() if n < self.rows)

    @classmethod
    def merged(cls, parts: Sequence[ColumnStats]) -> ColumnStats:
        """The statistics of several parts together: nothing is subtracted, so no digits are lost."""
        columns = list(parts[0].counts) if parts else []
        counts = {c: sum(p.counts[c] for p in parts) for c in columns}
        means = {c: sum(p.means[c] * (p.counts[c] / counts[c]) for p in parts) if counts[c] else 0.0 for c in columns}
        tops = {c: max(p.tops[c] for p in parts) for c in columns}
        return cls(sum(p.rows for p in parts), counts, means, tops)

    def imputation(self, columns: Sequence[str], flagged: Sequence[str]) -> Imputation:
        """Means of these columns; a feature without any value gets 0."""
        return Imputation({c: self.means[c] for c in columns}, tuple(c for c in flagged if c in columns))


def column_stats(df: DataFrame, columns: Sequence[str], by: str | None = None) -> dict[int, ColumnStats]:
    """The statistics of each part, all in one pass; without ``by`` there is one part, 0. Few parts, such as folds."""
    part = F.lit(0) if by is None else F.col(f"`{by}`")
    aggregates = [f(_value(c)).alias(f"{k}_{i}") for i, c in enumerate(columns) for k, f in (("n", F.count), ("mean", F.avg), ("top", F.max))]
    found = df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), *aggregates).collect()
    missing = float("-inf")
    return {
        r["part"]: ColumnStats(
            r["rows"], {c: r[f"n_{i}"] for i, c in enumerate(columns)}, {c: r[f"mean_{i}"] or 0.0 for i, c in enumerate(columns)},
            {c: missing if r[f"top_{i}"] is None else float(r[f"top_{i}"]) for i, c in enumerate(columns)},
        )
        for r in found
    }


def fit_imputation(df: DataFrame, columns: Sequence[str]) -> Imputation:
    """Means of the features, in one pass; those with missing values are flagged, too."""
    stats = ColumnStats.merged(list(column_stats(df, columns).values()))
    return Imputation({c: stats.means[c] for c in stats.gaps()}, stats.gaps())


def nominal_codes(tops: Mapping[str, float], bins: int) -> dict[str, int]:
    """The number of codes, the missing one included, of each category column that has at most ``bins``.

    Codes start at -1 for a missing value; a learner counts categories from 0, so they move up by one.
    A column with more codes stays a number.
    """
    codes = {c: 1 if top == float("-inf") else int(top) + 2 for c, top in tops.items()}
    return {c: n for c, n in codes.items() if n <= bins}


def mark_codes(df: DataFrame, codes: Mapping[str, int]) -> DataFrame:
    """Tell the learner which columns hold category codes; a code it was not told of counts as missing."""
    for c, n in codes.items():
        attribute = {"ml_attr": {"type": "nominal", "name": c, "vals": [str(i - 1) for i in range(n)]}}
        moved = F.coalesce(F.col(f"`{c}`"), F.lit(-1)).cast("double") + 1
        df = df.withColumn(c, F.when(moved.between(0, n - 1), moved).otherwise(0.0)).withMetadata(c, attribute)
    return df


@dataclass(frozen=True)
class FeaturePreparation:
    """From raw rows to the feature vector, the same for rows that come later.

    ``columns`` are the raw features in the vector's order, ``dictionary`` encodes those that hold text, ``nominal``
    are codes that the learner knows as categories. Without ``imputation`` missing values stay missing.
    """

    columns: tuple[str, ...]
    dictionary: DataFrame | None = None
    nominal: Mapping[str, int] | None = None
    imputation: Imputation | None = None

    @property
    def names(self) -> list[str]:
        """The names of the vector's values."""
        return [*self.columns, *(self.imputation.flags() if self.imputation else [])]

    def nominal_places(self) -> dict[int, int]:
        return {self.columns.index(c): n for c, n in (self.nominal or {}).items()}

    def fills(self) -> tuple[tuple[str, float], ...]:
        """What takes the place of missing values in rows that the preparation was made from."""
        return tuple((c, self.imputation.means[c]) for c in self.imputation.flagged) if self.imputation else ()

    def encode(self, df: DataFrame, unseen: str = "error") -> DataFrame:
        """Codes in place of text. ``unseen="error"`` refuses values that the dictionary lacks, ``"missing"`` gives
        them the code of a missing one."""
        if unseen not in {"error", "missing"}:
            raise ValueError(f"unseen is 'error' or 'missing', not {unseen!r}")
        if self.dictionary is None:
            return df
        return apply_encoding(df, self.dictionary) if unseen == "error" else encode(df, self.dictionary)

    def finish(self, encoded: DataFrame, known: bool = False) -> DataFrame:
        """The vector column ``features`` of rows whose text is encoded; ``known`` rows are those it was made from."""
        df = mark_codes(encoded, self.nominal or {})
        df = self.imputation.apply(df, known) if self.imputation else df
        return assemble_features(df, self.names, "error" if self.imputation else "keep")

    def apply(self, df: DataFrame, unseen: str = "error") -> DataFrame:
        require_columns(df, self.columns)
        return self.finish(self.encode(df, unseen))

    def save(self, path: str, spark: SparkSession) -> None:
        record = {
            "columns": self.columns, "nominal": dict(self.nominal or {}), "encoded": self.dictionary is not None,
            "imputation": None if self.imputation is None else asdict(self.imputation),
        }
        _write_record(spark, record, f"{path}/preparation")
        if self.dictionary is not None:
            write_dictionary(self.dictionary, f"{path}/dictionary")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> FeaturePreparation:
        record = _read_record(spark, f"{path}/preparation")
        given = record["imputation"]
        return cls(
            tuple(record["columns"]), read_dictionary(spark, f"{path}/dictionary") if record["encoded"] else None, record["nominal"],
            given and Imputation(given["means"], tuple(given["flagged"])),
        )


def text_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, StringType)]


def encode_texts(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Codes in place of the feature columns that hold text, and their dictionary."""
    texts = text_columns(df, columns)
    return fit_encode(df, texts) if texts else (df, None)


@dataclass(frozen=True)
class ScoringModel:
    """The fitted models of all targets with all that raw rows go through."""

    family: str
    preparation: FeaturePreparation
    scalings: Mapping[str, TargetScaling]
    models: Mapping[str, object]

    def score(self, df: DataFrame, keep: Sequence[str] = ("id",), unseen: str = "error") -> DataFrame:
        """(``keep``, target, y_pred): one row per row of ``df`` and target, in the original scale.

        Features may be missing; targets are not needed. An unseen category is an error or, with
        ``unseen="missing"``, counts as missing.
        """
        return self.predictions(self.preparation.apply(df, unseen), [c for c in keep if c in df.columns])

    def predictions(self, rows: DataFrame, keep: Sequence[str], known: bool = False) -> DataFrame:
        """Predictions of rows that have their vector; with ``known``, y beside them."""
        for model in self.models.values():
            rows = model.transform(rows)
        entries = F.array(*[
            F.struct(F.lit(t).alias("target"), *([F.col(t).cast("double").alias("y")] if known else []), s.invert(F.col(f"{t}_pred_t")).alias("y_pred"))
            for t, s in self.scalings.items()
        ])
        return rows.select(*keep, F.explode(entries).alias("e")).select(*keep, "e.*")

    def save(self, path: str, spark: SparkSession) -> None:
        """Everything below ``path``: models/<target>, preparation, dictionary, scoring."""
        self.preparation.save(path, spark)
        for target, model in self.models.items():
            model.save(f"{path}/models/{target}")
        own = [t for t, m in self.models.items() if isinstance(m, LeafwiseModel)]
        _write_record(spark, {"family": self.family, "scalings": {t: asdict(s) for t, s in self.scalings.items()}, "leafwise": own}, f"{path}/scoring")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> ScoringModel:
        record = _read_record(spark, f"{path}/scoring")
        models = {
            t: (LeafwiseModel if t in record["leafwise"] else GBTRegressionModel).load(f"{path}/models/{t}") for t in record["scalings"]
        }
        scalings = {t: TargetScaling(**s) for t, s in record["scalings"].items()}
        return cls(record["family"], FeaturePreparation.load(path, spark), scalings, models)


def _write_record(spark: SparkSession, record: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _read_record(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])
