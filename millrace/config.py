"""Layered configuration: defaults, default.yaml, tasks/<task>.yaml, worker.yaml, command line, environment; the right-most wins."""

from __future__ import annotations

import argparse
import dataclasses
import os
from collections.abc import Mapping
from typing import Any


@dataclasses.dataclass(frozen=True)
class Config:
    task: str = "etl"
    worker_id: int = 0
    total_workers: int = 1
    seed: int = 42
    input_file: str | None = None
    input_dir: str = "data/raw"
    output_dir: str = "outputs"
    cache_dir: str = "cache"
    max_rows: int = -1
    id_column: str = "id"
    target_column: str | None = "target"
    group_column: str | None = None
    text_columns: tuple[str, ...] = ()
    image_column: str | None = None
    split_method: str = "random"
    val_fraction: float = 0.2
    model: str = "logistic"
    model_params: Mapping[str, Any] = dataclasses.field(default_factory=dict)
    metric: str = "f1_macro"
    batch_size: int = 1024
    embedding_model: str | None = None
    embedding_dim: int = 384
    ocr_backend: str = "tesseract"
    enable_ocr: bool = False
    enable_embeddings: bool = False
    er_profile: str = "v3"
    er_block_cap: int = 50
    er_folds: int = 3
    shuffle_partitions: int | None = None
    dry_run: bool = False

    def __post_init__(self):
        if not 0 <= self.worker_id < self.total_workers:
            raise ValueError(f"worker {self.worker_id} is not in 0..{self.total_workers - 1}")


def deep_merge(a: Mapping, b: Mapping) -> dict:
    """A new dict; b wins, nested dicts are merged."""
    out = dict(a)
    for k, v in b.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def read_yaml(path: str) -> dict:
    """{} for a missing file."""
    if not os.path.exists(path):
        return {}
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="millrace")
    for f in dataclasses.fields(Config):
        if f.name == "model_params":
            continue
        flag, default = f"--{f.name.replace('_', '-')}", f.default
        if isinstance(default, bool):
            p.add_argument(flag, action=argparse.BooleanOptionalAction, default=None)
        elif f.name == "text_columns":
            p.add_argument(flag, nargs="*", default=None)
        else:
            p.add_argument(flag, type=type(default) if isinstance(default, (int, float)) else int if f.name == "shuffle_partitions" else str, default=None)
    p.add_argument("--config-dir", default="configs")
    return p


def load(argv: list[str] | None = None, env: Mapping[str, str] | None = None) -> Config:
    """Unknown keys of YAML files are ignored. The task file is that of the task that wins over all layers."""
    env = os.environ if env is None else env
    args = {k: v for k, v in vars(parser().parse_args(argv or [])).items() if v is not None}
    folder = args.pop("config_dir")
    base, worker = read_yaml(f"{folder}/default.yaml"), read_yaml(f"{folder}/worker.yaml")
    over = {k: kind(env[n]) for n, k, kind in (("WORKER_ID", "worker_id", int), ("TOTAL_WORKERS", "total_workers", int), ("WORKER_TASK", "task", str)) if n in env}
    top = deep_merge(deep_merge(worker, args), over)
    task = top.get("task", base.get("task", Config.task))
    merged = deep_merge(deep_merge(base, read_yaml(f"{folder}/tasks/{task}.yaml")), top)
    names = {f.name for f in dataclasses.fields(Config)}
    known = {k: tuple(v) if k == "text_columns" else v for k, v in merged.items() if k in names}
    return Config(**known)
