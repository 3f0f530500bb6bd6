"""The composed jobs: split, describe, test, rank features, select, train, score, all."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.config import ImportanceConfig, SplitConfig, TestConfig, TrainConfig
from winnow.functions.scalar import temporal_buckets
from winnow.operators import describe as D
from winnow.operators import importance as I
from winnow.operators import stat_tests as ST
from winnow.operators.calibration import bin_stats, choose_calibrator, compare_sets
from winnow.operators.cleaning import BasicCleaner, CleanerModel
from winnow.operators.evaluation import evaluate_all, lift_table
from winnow.operators.features import FeatureEngineer, fit_account_totals, top_sources, vector_encoder
from winnow.operators.imbalance import add_class_weights, needs_balancing, oversample
from winnow.operators.models import (
    GRIDS, add_probabilities, estimator, fit_family, fit_source_experts, model_importances, optimize_weights, positive_probability, search,
    vector_names,
)
from winnow.operators.selection import SelectorModel, SmartFeatureSelector
from winnow.operators.splits import split_report, time_group_split
from winnow.operators.synthetic import smote
from winnow.operators.tuning import space_of, tune
from winnow.plans.scoring import Scorer, ScoringSpec
from winnow.roles import TEST_EXCLUDED, ColumnRoles, categorical_columns, exclude_columns, measure_columns, numeric_columns
from winnow.session import pin, stored
from winnow.sources.files import split_metadata, write_split


def only(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("split") == name)


# ---------------------------------------------------------------- split and clean


def split_and_clean(
    df: DataFrame, roles: ColumnRoles, config: SplitConfig = SplitConfig(), cleaner: BasicCleaner = BasicCleaner(),
    path: str | None = None,
) -> tuple[DataFrame, CleanerModel, dict]:
    """Group-safe split, cleaning learned on train; optionally stored by partition."""
    dated = time_group_split(
        df, roles.time, roles.group, config.train_cutoff, config.val_cutoff,
        config.test_cutoff if config.truncate_future else None, config.force_balance,
    )
    model = cleaner.fit(only(dated, "train").drop("split"), roles)
    cleaned = model.transform(dated)
    if path:
        write_split(cleaned, path)
        cleaned = df.sparkSession.read.parquet(path)
    cutoffs = {"train": config.train_cutoff, "validation": config.val_cutoff, "test": config.test_cutoff}
    return cleaned, model, split_metadata(cleaned, cutoffs)


# ---------------------------------------------------------------- statistics


def describe_job(df: DataFrame, roles: ColumnRoles) -> dict[str, DataFrame]:
    """Basic tables, target analysis, source conversion and cohorts."""
    numeric = list(roles.numeric) or numeric_columns(df, roles.reserved)
    categorical = list(roles.categorical) or categorical_columns(df, roles.reserved)
    out = {"missing": D.missing_stats(df)}
    if numeric:
        out |= {"numeric": D.describe_numeric(df, numeric), "top_variance": D.top_variance(df, numeric)}
    if categorical:
        out["categorical"] = D.value_counts(df, categorical)
    if roles.target:
        out["target"] = D.target_distribution(df, roles.target)
        if numeric:
            out["target_correlation"] = ST.target_correlations(df, numeric, roles.target, 0.0)
        cohorts = {c: F.col(c) for c in categorical if c == roles.source or "segment" in c.lower() or c in ("Industry", "Country")}
        cohorts |= {
            f"{f.name}_month": F.date_format(F.col(f.name), "yyyy-MM") for f in df.schema
            if f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
        }
        if roles.source:
            out["source"] = D.conversion_by(df, roles.source, roles.target)
        if cohorts:
            out["cohorts"] = D.cohort_analysis(df, cohorts, roles.target)
            out["top_cohorts"] = D.top_cohorts(out["cohorts"])
    return out


def run_tests(df: DataFrame, roles: ColumnRoles, config: TestConfig = TestConfig(), group: str | None = None,
              train_only: bool = True, drop: Sequence[str] = TEST_EXCLUDED) -> dict[str, DataFrame]:
    """The test battery over every column, one table per family."""
    if train_only and "split" in df.columns:
        df = only(df, "train")
    df = df.drop("split")
    usable = exclude_columns(df, (*roles.ids, *drop, *([roles.group] if roles.group else [])))
    numeric = numeric_columns(usable, [roles.target])
    categorical = categorical_columns(usable)
    chosen = ST.choose_groups(df, categorical, roles.target)
    out: dict[str, DataFrame] = {}
    if "chi_square" in config.kinds and categorical:
        out["chi_square"] = ST.chi_square(df, categorical, roles.target)
    if "conversion" in config.kinds and categorical:
        out["conversion"] = ST.conversion_rates(df, categorical, roles.target, config.min_rows)
    if "ttest" in config.kinds and (group or chosen["ttest"]):
        out["ttest"] = ST.compare_means(df, numeric, group or chosen["ttest"], config.equal_var)
    if "anova" in config.kinds and (group or chosen["anova"]):
        out["anova"] = ST.anova(df, numeric, group or chosen["anova"])
    if "correlation" in config.kinds and len(numeric) > 1:
        corr = ST.correlation_matrix(df, numeric, config.corr_method, roles.ids[0] if roles.ids else None)
        out["correlation"] = corr
        out["high_correlation"] = ST.high_corr_pairs(corr, config.min_corr)
        out["target_correlation"] = ST.target_correlations(df, numeric, roles.target, config.min_corr)
    return out


# ---------------------------------------------------------------- importance and selection


def auto_select(df: DataFrame, roles: ColumnRoles, selector: SmartFeatureSelector = SmartFeatureSelector()
                ) -> tuple[DataFrame, SelectorModel, DataFrame]:
    """Selector fitted on train; the transformed table, the model and the report."""
    train = only(df, "train") if "split" in df.columns else df
    model = selector.fit(train.drop("split"), roles)
    kept = model.transform(df)
    return kept, model, model.report(train)


def importance_job(df: DataFrame, roles: ColumnRoles, config: ImportanceConfig = ImportanceConfig()) -> dict[str, DataFrame]:
    """Date features, filtering, encoding, importance by each method, comparison and selection."""
    train = only(df, "train").drop("split") if "split" in df.columns else df
    if roles.time:
        train = train.select("*", *temporal_buckets(F.col(roles.time), roles.time))
    if config.filter_features:
        train = SmartFeatureSelector().fit(train, roles).transform(train)
    numeric, categorical = numeric_columns(train, roles.reserved), categorical_columns(train, roles.reserved)
    row_id = roles.ids[0]
    encoder = vector_encoder(numeric, categorical).fit(train)
    rows = encoder.transform(train).select(row_id, "features", F.col(roles.target).cast("double").alias("label"))
    names = vector_names(rows)
    tables: dict[str, DataFrame] = {}
    if "attribution" in config.methods:
        folds = I.fold_importances(rows, config.family, names, row_id, folds=config.folds, **config.params)
        stable = I.importance_stability(folds)
        tables["attribution"] = stable
        tables["selected"] = I.select_features(stable, config.stability_threshold, config.top_k)
    if "permutation" in config.methods:
        raw = [c for c in numeric]
        on_numbers = vector_encoder(raw, []).fit(train)
        fitted = estimator(config.family, train.count(), label="label", **config.params).fit(
            on_numbers.transform(train).withColumn("label", F.col(roles.target).cast("double"))
        )
        score = lambda d: fitted.transform(on_numbers.transform(d)).withColumn("p", positive_probability(fitted))
        tables["permutation"] = I.permutation_importance(train, raw, score, roles.target, row_id)
    if len(tables) > 1 and "permutation" in tables and "attribution" in tables:
        tables["combined"] = I.combine_methods({
            "attribution": tables["attribution"].select("feature", F.col("mean_importance").alias("importance")),
            "permutation": tables["permutation"],
        })
    return tables


# ---------------------------------------------------------------- train and score


@dataclass
class Trained:
    scorer: Scorer
    selector: SelectorModel | None
    importances: DataFrame
    calibrator: str | None


def train_job(df: DataFrame, roles: ColumnRoles, config: TrainConfig = TrainConfig(),
              cleaner: BasicCleaner | None = None) -> Trained:
    """One fit: clean, derive, select, encode, balance, train, calibrate.

    The fitted chain is the one that scores later: training and scoring share every stage.
    Train rows are cached between the steps (memory, then disk) and released at the end.
    """
    train, validation = only(df, "train").drop("split"), only(df, "validation").drop("split")
    train = train.persist()
    clean_model = (cleaner or BasicCleaner()).fit(train, roles)
    measures = [c for c in measure_columns(train) if c not in roles.reserved]
    spec = ScoringSpec(
        ids=[*roles.ids], time=roles.time, account=roles.group, ratio_columns=measures if config.ratio_pairs and len(measures) > 1 else [],
    )
    engineered = totals = None
    if config.engineer and roles.source and roles.group and roles.time and roles.ids:
        cleaned = clean_model.transform(train)
        present = lambda c: c if c in train.columns else None
        engineered = FeatureEngineer(
            roles.time, roles.group, roles.source, roles.ids[0], present(config.channel), present(config.record_type), windows=config.windows,
        ).fit(cleaned)
    elif roles.group:
        totals = fit_account_totals(train, roles.group)
    scorer = Scorer(spec, None, clean_model, totals, engineered=engineered)
    # some twenty scans of a few columns each follow
    derived = stored(scorer.features(train), "derived")
    selector = None
    if config.select:
        selector = SmartFeatureSelector().fit(derived, roles, keep_cached=True)
        inputs = selector.kept
    else:
        inputs = [c for c in derived.columns if c not in roles.reserved]
    numeric = [c for c in numeric_columns(derived) if c in inputs]
    categorical = [c for c in categorical_columns(derived) if c in inputs]
    rows = derived.withColumn("label", F.col(roles.target).cast("double"))
    weight = None
    if config.balance != "none" and needs_balancing(rows, "label", config.balance_below):
        if config.balance == "class_weight":
            rows, weight = add_class_weights(rows, "label"), "weight"
        elif config.balance == "oversample":
            rows = oversample(rows, "label", roles.ids[0], config.seed)
        elif config.balance == "smote":
            rows = smote(rows, "label", roles.ids[0], numeric, categorical, seed=config.seed)
        else:
            raise ValueError(f"unknown balance method {config.balance}")
    encoder = vector_encoder(numeric, categorical).fit(derived)
    row_key = [roles.ids[0]] if config.search_trials else []
    encoded = encoder.transform(rows).select(*row_key, "features", "label", *([weight] if weight else [])).persist()
    params = dict(config.params)
    if config.search_trials:
        common = dict(trials=config.search_trials, metric=config.metric, seed=config.seed, weight=weight, **config.params)
        grid = {k: v for k, v in GRIDS[config.family].items() if k not in config.params}
        if config.search_pruner == "grid":
            params |= search(encoded, config.family, grid, row_key[0], **common)[0]
        else:
            params |= tune(encoded, config.family, space_of(grid), row_key[0], pruner=config.search_pruner, timeout=config.search_timeout, **common).params
    fitted = estimator(config.family, encoded.count(), weight=weight, seed=config.seed, **params).fit(encoded)
    names = vector_names(encoded)
    scorer.model = PipelineModel([*encoder.stages, fitted])
    if config.ensemble:
        scorer.model = PipelineModel(encoder.stages)
        scorer.members = {f: fit_family(encoded, f, weight=weight, seed=config.seed) for f in config.ensemble}
        held_out = encoder.transform(scorer.features(validation)).withColumn("label", F.col(roles.target).cast("double"))
        probed, columns = add_probabilities(held_out.select("features", "label"), scorer.members)
        scorer.weights, _ = optimize_weights(pin(probed.select("label", *columns)), columns, "label", seed=config.seed)
    for held in (encoded, train):
        held.unpersist()
    kind = None
    if config.calibrate:
        raw = scorer.transform(validation, [roles.target]).select("raw_score", roles.target).persist()
        scorer.calibrator, kind = choose_calibrator(raw, "raw_score", roles.target)
        raw.unpersist()
    return Trained(scorer, selector, model_importances(fitted, names, df.sparkSession), kind)


def evaluate_job(df: DataFrame, roles: ColumnRoles, scorer: Scorer) -> dict[str, DataFrame]:
    """Metrics, bins and lift for validation and test, each on its own rows.

    The scored rows are narrow and read many times, so they are written once.
    """
    out, sets = {}, {}
    for name in ("validation", "test"):
        sets[name] = scored = pin(scorer.transform(only(df, name).drop("split"), [roles.target]))
        out[name] = evaluate_all(scored, "conversion_probability", roles.target, roles.ids[0], scorer.spec.edges, scorer.spec.labels)
        out[f"{name}_bins"] = bin_stats(scored, "conversion_probability", roles.target)
        out[f"{name}_lift"] = lift_table(scored, "segment", roles.target)
    out["comparison"] = compare_sets(sets, "raw_score", "conversion_probability", roles.target)
    return out


def score(df: DataFrame, scorer: Scorer, keep: Sequence[str] = ()) -> DataFrame:
    return scorer.transform(df, keep)


def train_experts(df: DataFrame, roles: ColumnRoles, family: str = "lightgbm", min_rows: int = 50, **params):
    """Source-wise experts over one shared encoding; returns (encoder, experts)."""
    train = only(df, "train").drop("split")
    numeric, categorical = numeric_columns(train, roles.reserved), categorical_columns(train, roles.reserved)
    encoder = vector_encoder(numeric, categorical).fit(train)
    rows = encoder.transform(train).withColumn("label", F.col(roles.target).cast("double"))
    return encoder, fit_source_experts(rows, roles.source, top_sources(train, roles.source), family, min_rows=min_rows, **params)


def run_all(df: DataFrame, roles: ColumnRoles, split: SplitConfig = SplitConfig(), tests: TestConfig = TestConfig(),
            importance: ImportanceConfig = ImportanceConfig(), train: TrainConfig = TrainConfig(), skip: Sequence[str] = (),
            path: str | None = None) -> dict:
    """Every step in order; steps named in ``skip`` are left out."""
    cleaned, cleaner, metadata = split_and_clean(df, roles, split, path=path)
    out: dict = {"data": cleaned, "cleaner": cleaner, "metadata": metadata,
                 "report": split_report(cleaned, roles.group, roles.target, roles.time)}
    if "statistics" not in skip:
        out["statistics"] = describe_job(only(cleaned, "train").drop("split"), roles)
    if "tests" not in skip:
        out["tests"] = run_tests(cleaned, roles, tests)
    if "importance" not in skip:
        out["importance"] = importance_job(cleaned, roles, importance)
    if "select" not in skip:
        out["selection"] = auto_select(cleaned, roles)
    if "train" not in skip:
        out["training"] = train_job(cleaned, roles, train)
        out["evaluation"] = evaluate_job(cleaned, roles, out["training"].scorer)
    return out
