from .parquet import append_load, run_path, write_parquet, write_sample, write_train_val

__all__ = ["append_load", "run_path", "write_parquet", "write_sample", "write_train_val"]
