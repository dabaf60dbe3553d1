"""The flagship run: raw lines to test metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.catalogue.data import LINES, lines
from tabloom.catalogue.transforms import CONFIG, TEXT
from tabloom.operators.linear import collect_moments, fit_linear
from tabloom.operators.metrics import metrics
from tabloom.operators.split import with_split
from tabloom.operators.validate import validate
from tabloom.plans.features import fit_features


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    raw = lines(spark, sf)
    validate(raw, required=("l_extendedprice", "p_size"), min_columns=10)
    marked = with_split(raw, LINES)
    plan = fit_features(marked.where("split = 'train'"), CONFIG, ignore=[*TEXT, "split"])
    ready = plan.transform(marked, keep=["split"])
    moments = collect_moments(ready.where("split = 'train'"), plan.features, CONFIG.transformed_target)[0]
    model = fit_linear(moments, "ridge", 1.0)
    return metrics(model.transform(ready), CONFIG.transformed_target, "prediction", ["split"])
