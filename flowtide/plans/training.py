"""Raw flows to a fitted and evaluated classifier, in one application."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from flowtide.operators.combine import train_val_and_test
from flowtide.operators.encode import fit_stos_fill, preprocess_flows
from flowtide.operators.learning import evaluate_flows, train_flow_classifier


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    stos_fill: float
    evaluation: DataFrame


def train_from_flows(
    flows: DataFrame, key: str | None = None, seed: int = 42, **options
) -> Trained:
    """Encode, split 70/15/15, fit on train and validation, evaluate on the test rows.

    The fitted fill for the service byte belongs to the model: pass it to the preprocessing stream.
    """
    fill = fit_stos_fill(flows)
    if key is None and "flow_id" in flows.columns:
        key = "flow_id"
    encoded = preprocess_flows(flows, fill, layout="training", keep=[key] if key else [])
    fitted, test = train_val_and_test(encoded, key, seed)
    model = train_flow_classifier(fitted, seed=seed, **options)
    return Trained(model, fill, evaluate_flows(test, model))
