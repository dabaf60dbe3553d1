"""The feature plan: bins, one-hot columns, target transform, pruning, scaling, with kept parameters."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.binning import Bins, apply_bins, fit_categories, one_hot
from tabloom.operators.correlation import Prune, correlations, prune_of
from tabloom.operators.frames import name, numeric_columns
from tabloom.operators.moments import collect_cells
from tabloom.operators.powerlaw import BoxCox, fit_boxcox
from tabloom.operators.scaling import Scaler, scaler_of

# Columns the bins produce and the prefix of the one-hot columns.
ELEMENT_BIN = "num_elements_simplified"
VALENCE_BIN = "rangeValence_simplified"
VALENCE_PREFIX = "rangeValence"


@dataclass(frozen=True)
class FeatureConfig:
    target: str
    transformed_target: str
    bins: tuple[Bins, ...]
    one_hot_column: str | None
    one_hot_prefix: str
    drop_raw: tuple[str, ...]
    correlation_threshold: float
    protected: tuple[str, ...]
    drop_listed: tuple[str, ...]
    skip_scaling: tuple[str, ...]


def from_config(cfg: Mapping) -> FeatureConfig:
    fe = cfg["feature_engineering"]
    element, valence = fe["element_bins"], fe["valence_bins"]
    return FeatureConfig(
        target=fe["target_column"],
        transformed_target=fe["engineered_target_column"],
        bins=(
            Bins(
                element["column"],
                ELEMENT_BIN,
                (
                    ("lte", element["low_threshold"], element["low_value"]),
                    ("gte", element["high_threshold"], element["high_value"]),
                ),
            ),
            Bins(
                valence["column"],
                VALENCE_BIN,
                (
                    ("eq", 0, valence["merge_zero_to"]),
                    ("gte", valence["high_threshold"], valence["high_value"]),
                ),
            ),
        ),
        one_hot_column=VALENCE_BIN,
        one_hot_prefix=VALENCE_PREFIX,
        drop_raw=(element["column"], valence["column"]),
        correlation_threshold=fe["correlation_threshold"],
        protected=tuple(fe["protected_columns"]),
        drop_listed=tuple(fe["drop_low_mi_columns"]),
        skip_scaling=tuple(cfg["preprocessing"]["columns_to_skip_scaling"]),
    )


@dataclass(frozen=True)
class FeaturePlan:
    """Fitted parameters; `transform` is one projection and works on batches and streams."""

    config: FeatureConfig
    categories: tuple
    boxcox: BoxCox
    prune: Prune
    scaler: Scaler

    features: tuple[str, ...]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Feature columns in fitted order, then the transformed target if the table has either form of it,
        then the `keep` columns.
        """
        out = apply_bins(df, self.config.bins)
        if self.config.one_hot_column in out.columns:
            out = one_hot(out, self.config.one_hot_column, self.categories, self.config.one_hot_prefix)
        out = out.drop(*[c for c in self.config.drop_raw if c not in keep])
        if self.config.target in out.columns:
            out = self.boxcox.apply(out)
        out = self.scaler.apply(self.prune.apply(out))
        has_target = self.config.transformed_target in out.columns
        tail = [self.config.transformed_target] if has_target else []
        return out.select(*[name(c) for c in [*self.features, *tail, *keep]])

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=2)

    @staticmethod
    def from_json(text: str) -> FeaturePlan:
        d = json.loads(text)
        c = dict(d["config"])
        c["bins"] = tuple(
            Bins(b["column"], b["output"], tuple(tuple(r) for r in b["rules"])) for b in c["bins"]
        )
        for k in ("drop_raw", "protected", "drop_listed", "skip_scaling"):
            c[k] = tuple(c[k])
        p, s = d["prune"], d["scaler"]
        return FeaturePlan(
            FeatureConfig(**c),
            tuple(d["categories"]),
            BoxCox(**d["boxcox"]),
            Prune(p["threshold"], tuple(p["correlated"]), tuple(p["listed"])),
            Scaler(tuple(s["columns"]), tuple(s["mean"]), tuple(s["sd"])),
            tuple(d["features"]),
        )


def fit_features(df: DataFrame, config: FeatureConfig, ignore: Sequence[str] = ()) -> FeaturePlan:
    """Fit every step on `df`: categories, exponent, correlations, scales, each a job whose result is
    a few numbers per column. `ignore` columns (keys, split marks) are no features.
    """
    binned = apply_bins(df.drop(*ignore), config.bins)
    categories: tuple = ()
    if config.one_hot_column in binned.columns:
        categories = tuple(fit_categories(binned, config.one_hot_column))
        binned = one_hot(binned, config.one_hot_column, categories, config.one_hot_prefix)
    raw = binned.drop(*config.drop_raw)
    boxcox = fit_boxcox(raw, config.target, config.transformed_target)
    with_target = boxcox.apply(raw)
    # one scan of second moments serves the pruning and the scales
    columns = [c for c in numeric_columns(with_target) if c != config.transformed_target]
    cells = collect_cells(with_target, columns)
    free = [c for c in columns if c not in config.protected]
    pairs = correlations(cells, columns).where(F.col("feature_i").isin(free) & F.col("feature_j").isin(free))
    listed = [c for c in config.drop_listed if c in with_target.columns]
    prune = prune_of(pairs, config.correlation_threshold, listed)
    kept = prune.apply(with_target).drop(config.transformed_target).columns
    scaler = scaler_of(cells, columns, [c for c in columns if c in config.skip_scaling or c not in kept])
    return FeaturePlan(config, categories, boxcox, prune, scaler, tuple(kept))
