from .ingest import load_json, load_lines, read_loaded, read_rejected, rejected_lines, sample_json
from .jobs import run
from .model import (
    PurchaseModel,
    load_features,
    load_purchase_model,
    predict,
    save_features,
    save_purchase_model,
)
from .preparation import prepare, score_run
from .training import (
    batch_predict,
    collapse_examples,
    evaluate,
    predictions,
    save_model,
    train_gbt,
)

__all__ = [
    "PurchaseModel",
    "batch_predict",
    "collapse_examples",
    "evaluate",
    "load_features",
    "load_json",
    "load_lines",
    "load_purchase_model",
    "predict",
    "predictions",
    "prepare",
    "read_loaded",
    "read_rejected",
    "rejected_lines",
    "run",
    "sample_json",
    "save_features",
    "save_model",
    "save_purchase_model",
    "score_run",
    "train_gbt",
]
