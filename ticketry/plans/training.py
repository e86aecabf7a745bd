"""Blocks of experiments, and the retraining on mined errors."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.columns import training_columns
from ..operators.kernel import Store
from ..operators.models import FOLDS, ModelSpec, TextModel, prepared, registry_row, score_lot, train_model, tune
from ..operators.training_sets import augmented
from ..sources import sinks
from ..sources.files import read_exported
from .lots import publish_scores

BLOCKS = {
    "E1_texto": {"meta": False},
    "E2_texto_meta": {"meta": True},
    "E2_meta_log": {"meta": True, "sublinear": True},
}


def read_training(spark: SparkSession, path: str) -> DataFrame:
    """A training set from an exported file, under whatever of its known headers."""
    return training_columns(read_exported(spark, path))


def _registered(spark, folder: str, version: str, text: str, model: TextModel):
    spec = model.spec
    sinks.write_json(registry_row(spark, version, text, spec, model.labels), f"{folder}/registry")
    sinks.write_json(
        spark.createDataFrame(
            [(spec.kind, spec.parameter, model.labels)],
            "modelo string, parametro double, etiquetas array<string>",
        ),
        f"{folder}/best_params",
    )


def block_store(train: DataFrame) -> Store:
    """The features that all blocks and kinds share: texts are taken apart and counted once."""
    return prepared(train, ModelSpec("nb"), FOLDS, meta=True)


def run_block(
    train: DataFrame, valid: DataFrame, name: str, out: str, kinds=("nb", "lr", "svm"), store: Store | None = None
) -> DataFrame:
    """Tune each kind of model, keep model, predictions, figures and report; rank by macro F1."""
    spark, rows = train.sparkSession, []
    store = store or block_store(train)
    for kind in kinds:
        model, chosen, cv = tune(train, replace(ModelSpec(kind), **BLOCKS[name]), store)
        folder = f"{out}/{name}_{kind}"
        model.save(f"{folder}/model")
        figures = publish_scores(score_lot(model, valid), folder).first()
        _registered(spark, folder, f"{name}_{kind}", f"{kind} de {name}, F1 macro {cv:.4f} en los pliegues", model)
        rows.append((kind, chosen.parameter, cv, figures.f1_macro, figures.accuracy))
    ranking = spark.createDataFrame(
        rows, "modelo string, parametro double, cv_f1_macro double, f1_macro double, accuracy double"
    )
    sinks.write_ranking(ranking, f"{out}/{name}_ranking")
    return ranking.orderBy(F.desc("f1_macro"))


def run_blocks(
    train: DataFrame, valid: DataFrame, out: str, names=tuple(BLOCKS), kinds=("nb", "lr", "svm")
) -> dict[str, DataFrame]:
    """Blocks by name, each with its ranking; one feature store serves them all."""
    store = block_store(train)
    return {name: run_block(train, valid, name, out, kinds, store) for name in names}


def run_block_from_files(
    spark: SparkSession, train: str, valid: str, name: str, out: str, kinds=("nb", "lr", "svm")
) -> DataFrame:
    return run_block(read_training(spark, train), read_training(spark, valid), name, out, kinds)


def retrain(
    train: DataFrame, errors: DataFrame, valid: DataFrame, out: str,
    spec: ModelSpec | None = None, version: str = "SVM_v1.1", earlier: TextModel | None = None,
) -> DataFrame:
    """Fit on training rows plus mined errors; write model, labels, predictions, figures and
    report under ``out``. Returns the run's sizes and its macro F1.

    The solver starts where ``earlier``, a model of the training rows, ended: what each row adds is
    kept by its id, so it holds for the new vocabulary, and the errors add nothing yet.
    """
    spark = train.sparkSession
    spec = spec or ModelSpec("svm", 1.0)
    model = train_model(augmented(train, errors), spec, earlier)
    model.save(f"{out}/model")
    figures = publish_scores(score_lot(model, valid), out)
    _registered(spark, out, version, "Entrenamiento con errores minados", model)
    sizes = train.agg(F.count("*").alias("train")).join(
        errors.agg(F.count("*").alias("extra"))
    ).join(valid.agg(F.count("*").alias("valid")))  # one row each
    run = sizes.join(figures.select("f1_macro", "accuracy"))
    sinks.write_json(run, f"{out}/run")
    return run
